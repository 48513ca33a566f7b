"""Chat formatting by prefix-target expansion, DataFrame operations only.

Every assistant turn becomes an example of its own: all turns before it are the context, and only its own text
is trainable. A conversation that does not end with an assistant turn also gives one closing example without a
trainable part, so that no turn is lost.

The template of a turn is ``<turn>role<newline>text</turn><newline>``. Inside roles and texts ``&`` becomes
``&amp;`` and ``<`` becomes ``&lt;`` (in roles a line feed also becomes ``&#10;``), so no mark can stand
inside a text and the escapes read back exactly.

The loss mask is a span of code points, [loss_start, loss_end), of the formatted text; an example has one span.

Defined results: null role, null text are empty; null turns come first; rows of equal (conversation, turn) are
ordered by role and text and all count; null conversation ids form one conversation; an empty table gives an
empty result; other columns play no role. A conversation is one row of the result by contract (its digest covers
all its turns), so its own turns meet in one row; examples of one conversation share nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def format_chats(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """Examples: conv_id, example (0-based), n_turns in it, formatted, loss_start, loss_end (equal: nothing trainable)."""
    rows = conversations.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    turns = (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
             .withColumn("pieces", F.transform("turns", lambda t: F.struct(
                 F.concat(F.lit(OPEN), _escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"))))
             .withColumn("n", F.size("turns")))
    last = F.col("n") - 1
    targets = F.filter(F.transform("turns", lambda t, i: F.when((t["role"] == "assistant") | (i == last), i)), lambda i: i.isNotNull())
    one = turns.select("conv_id", "turns", "pieces", F.posexplode(targets).alias("example", "target"))
    before = F.slice("pieces", F.lit(1), F.col("target"))
    context = F.concat_ws("", F.transform(before, lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))))
    own = F.element_at("pieces", F.col("target") + 1)
    trained = F.element_at("turns", F.col("target") + 1)["role"] == "assistant"
    out = one.select("conv_id", "example", (F.col("target") + 1).alias("n_turns"), trained.alias("trained"),
                     F.concat(context, own["head"]).alias("prompt"), own["body"].alias("reply"))
    start = F.length("prompt")
    return out.select("conv_id", "example", "n_turns", F.concat("prompt", "reply", F.lit(CLOSE)).alias("formatted"),
                      start.alias("loss_start"), F.when(F.col("trained"), start + F.length("reply")).otherwise(start).alias("loss_end"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: array of (role, text)."""
    parts = F.split(formatted, CLOSE)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(parts, lambda p: F.struct(
        _unescape_role(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, F.lit("\n")) + 1)).alias("text")))


def read_loss(formatted: Column, start: Column, end: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return unescape(F.substr(formatted, start + 1, end - start))


def chat_report(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted examples: the longest example holds every turn, and the loss
    texts of the examples in order are the assistant's texts."""
    read = examples.select(
        "conv_id", "example", "n_turns", "formatted", F.length("formatted").alias("chars"),
        read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss"))
    per = read.groupBy("conv_id").agg(
        F.max_by("formatted", "n_turns").alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum("chars").alias("formatted_chars"))
    per = per.select("conv_id", "formatted_chars", read_turns(F.col("whole")).alias("turns"),
                     F.concat_ws("", F.transform("losses", lambda x: x["loss"])).alias("loss"))
    joined = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return per.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.col("formatted_chars").cast("long"))


PROBE_TEXT = "\\### Assistant: </turn> ok"


def with_probe(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The conversations plus number -7, whose texts hold control strings."""
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
