"""Exact deduplication by skew-safe combining, DataFrame operations only.

1. Local: every map task reduces its own rows to one per content (the partial aggregation; the salt is the
   task's number modulo ``salts``, so all copies of one task share a salt).
2. Salted: rows of equal (digest, salt, content) merge, so a content that makes up a third of all rows is
   spread over ``salts`` tasks, each of which receives at most one row per map task.
3. Global: the salt winners of a digest meet; at most ``salts`` rows per content and text length.

Every stage groups on the full normalised content, the digest only distributes the rows. Rows find their
group again through (SHA-256, second hash, length) of the content, so the texts travel twice, not four times.

Defined results: null text is the empty text; texts of blanks only equal the empty text; a null id loses
against any other id of the same text length, and a group of null ids only has a null keep_id; repeated rows
(same id, same text) all count in group_size and all carry kept = true, ``keep_one`` returns one of them;
an empty table gives an empty result; other columns of the input play no role, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.llm.common import BLANKS, text_of

SALTS = 32
_KEY = ["_d_sha", "_d_hash", "_d_len"]
# The winner as one number: longer original text first, then the smaller id; fixed width, so the
# aggregations below stay hash aggregations. Ids are shifted into 0 .. 2^64 - 1; 2^64 stands for null.
_STEP = 2 ** 65
_SHIFT = 2 ** 63


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, "")


def _dec(c) -> Column:
    return (F.lit(str(c)) if isinstance(c, int) else c).cast("decimal(38,0)")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    out = docs.select(F.col(id_col).cast("long").alias("_d_id"), text_of(text_col).alias("_d_text"))
    out = out.select("_d_id", F.length("_d_text").alias("_d_chars"), normalised(F.col("_d_text")).alias("_d_body"))
    return out.select("*", F.unhex(F.sha2("_d_body", 256)).alias("_d_sha"), F.xxhash64("_d_body").alias("_d_hash"),
                      F.length("_d_body").alias("_d_len"))


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per content: its key, keep_id, keep_chars and group_size."""
    rows = _keyed(docs, id_col, text_col).withColumn("_d_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    rank = _dec(F.col("_d_chars")) * _dec(_STEP) - F.coalesce(_dec(F.col("_d_id")) + _dec(_SHIFT), _dec(2 ** 64))
    merged = (rows.withColumn("_d_rank", rank.cast("decimal(38,0)"))
              .groupBy(*_KEY, "_d_salt", "_d_body")
              .agg(F.max("_d_rank").alias("_d_rank"), F.max("_d_chars").alias("_d_chars"), F.count(F.lit(1)).alias("_d_n")))
    best = (merged.groupBy(*_KEY, "_d_body")
            .agg(F.max("_d_rank").alias("_d_rank"), F.max("_d_chars").alias("keep_chars"), F.sum("_d_n").alias("group_size")))
    shifted = (_dec(F.col("keep_chars")) * _dec(_STEP) - F.col("_d_rank")).cast("decimal(38,0)")
    keep = F.when(shifted < _dec(2 ** 64), (shifted - _dec(_SHIFT)).cast("long"))
    return best.select(*_KEY, keep.alias("keep_id"), "keep_chars", "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    members = _keyed(docs, id_col, text_col).select("_d_id", *_KEY)
    joined = members.join(content_groups(docs, id_col, text_col, salts), _KEY)
    return joined.select(F.col("_d_id").alias("doc_id"), "keep_id", "group_size",
                         F.col("_d_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         F.lower(F.hex("_d_sha")).alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The input's rows and columns with one row left of each content. Rows meet the winners by id and length beside the content's key,
    so the copies of one content spread over all tasks."""
    body, own = normalised(text_of(text_col)), F.col(id_col).cast("long")
    rows = (docs.withColumn("_d_body", body)
            .withColumns({"_d_sha": F.unhex(F.sha2("_d_body", 256)), "_d_hash": F.xxhash64("_d_body"), "_d_len": F.length("_d_body"),
                          "_d_id": F.coalesce(own, F.lit(0)), "_d_null": own.isNull(), "_d_chars": F.length(text_of(text_col))})
            .drop("_d_body"))
    row_key = [*_KEY, "_d_id", "_d_null", "_d_chars"]
    win = content_groups(docs, id_col, text_col, salts).select(
        *_KEY, F.coalesce("keep_id", F.lit(0)).alias("_d_id"), F.col("keep_id").isNull().alias("_d_null"), F.col("keep_chars").alias("_d_chars"))
    return rows.join(win, row_key).dropDuplicates(row_key).select(*docs.columns)
