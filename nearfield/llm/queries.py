"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole
table. ``ORACLES`` holds DuckDB SQL where SQL can express the result; the rest is tested by brute force in tests/llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.llm import (bpe, chat, decontaminate, exact_dedup, hard_negatives, language_id, license_scan, near_dedup, quality, secret_scan, token_count,
                           toxicity, vector_codes)
from nearfield.llm.common import documents

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


def vocabulary() -> str:
    """Path of the byte-level tokenizer file; the package that holds it is installed on every worker."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_exact_dedup", r"""
    WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                      regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
    r AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size
          FROM d WINDOW w AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST))
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256 FROM r""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


@query("op4_license_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(documents(spark, sf_dir))


@query("op6_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_table(documents(spark, sf_dir), vocabulary(), ("n_tokens", "ids_sha256", "decoded_sha256"))


@query("op7_chat_format", r"""
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    p AS (SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS turns,
                 sum(length('<turn></turn>') + 2
                     + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), chr(10), '&#10;'))
                     + length(replace(replace(text, '&', '&amp;'), '<', '&lt;'))) OVER w AS upto
          FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
           (sum(upto) FILTER (role = 'assistant' OR n = turns))::BIGINT AS formatted_chars
    FROM p GROUP BY conv_id""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_probe(spark, documents(spark, sf_dir, "conversations"))
    return chat.chat_report(chat.format_chats(rows))


@query("op10_secret_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(secret_scan.secret_scan(documents(spark, sf_dir)))


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


@query("op3_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(documents(spark, sf_dir))


@query("op8_token_count")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(documents(spark, sf_dir), vocabulary())


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.toxicity(docs, toxicity.fit(docs, documents(spark, sf_dir, "labels")))


@query("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.quality(docs, quality.fit(docs, documents(spark, sf_dir, "labels")))


# Embedding rows that take part, with whole-number components.
_INTEGER_ROWS = """
    ok AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""


def _codes_sql() -> str:
    """Two rounds over 64 entries for each of 16 parts; a distance and its entry are compared as one number."""
    parts, entries = vector_codes.PARTS, vector_codes.ENTRIES
    floor = "(({s} - (({s} % count(*)) + count(*)) % count(*)) // count(*))"
    steps = [f"""WITH {_INTEGER_ROWS.strip()},
    numbered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r FROM ok),
    cells AS MATERIALIZED (SELECT r, part, list_slice(v, part * (len(v) // {parts}) + 1, (part + 1) * (len(v) // {parts})) AS c
              FROM numbered, (SELECT unnest(range({parts})) AS part)),
    book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, c FROM cells WHERE r <= {entries})"""]
    for k in range(vector_codes.ROUNDS + 1):
        steps.append(f"""near{k} AS MATERIALIZED (SELECT r, x.part, any_value(x.c) AS c,
              min(list_sum(list_transform(list_zip(x.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {entries} + b.entry) AS best
              FROM cells x JOIN book{k} b USING (part) GROUP BY r, x.part)""")
        if k < vector_codes.ROUNDS:
            steps.append(f"""sums{k} AS (SELECT part, entry, list(m ORDER BY pos) AS c FROM (
              SELECT part, best % {entries} AS entry, pos, {floor.format(s="sum(c[pos])::BIGINT")} AS m
              FROM near{k}, (SELECT unnest(range(1, (SELECT max(len(c)) FROM cells) + 1)) AS pos) GROUP BY part, best % {entries}, pos) GROUP BY part, entry),
    book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(s.c, b.c) AS c FROM book{k} b LEFT JOIN sums{k} s USING (part, entry))""")
    last = vector_codes.ROUNDS
    steps.append(f"""coded AS (SELECT r, string_agg(lower(lpad(to_hex(best % {entries}), 2, '0')), '' ORDER BY part) AS code, sum(best // {entries})::BIGINT AS error
              FROM near{last} GROUP BY r)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM book{last}) AS codebooks_sha256
    FROM coded JOIN numbered USING (r)""")
    return ",\n    ".join(steps)


@query("op11_vector_codes", _codes_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_report(*vector_codes.vector_codes(documents(spark, sf_dir, "embeddings")))


@query("op12_language_id")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    aside = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
    found = language_id.language_id(docs, language_id.fit(docs, ~aside))
    return found.select("doc_id", aside.alias("held_out"), "lang_pred", "score", "accepted")


@query("op13_hard_negatives", f"""
    WITH {_INTEGER_ROWS.strip()},
    rows AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v FROM ok WHERE label IS NOT NULL AND vec_id IS NOT NULL),
    anchors AS (SELECT row_number() OVER () AS a, * FROM rows WHERE vec_id % 100 = 0),
    scored AS MATERIALIZED (SELECT a, x.vec_id AS anchor_id, r.vec_id, x.label = r.label AS same,
               list_sum(list_transform(list_zip(x.v, r.v), lambda z: z[1] * z[2]))::BIGINT AS score
               FROM anchors x JOIN rows r ON r.vec_id <> x.vec_id),
    positives AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS p FROM scored WHERE same
                  QUALIFY p <= {hard_negatives.POSITIVES}),
    hits AS (SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
                    row_number() OVER (PARTITION BY p.a, p.p ORDER BY n.score DESC, n.vec_id) AS rank
             FROM positives p JOIN scored n ON n.a = p.a AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
             QUALIFY rank <= {hard_negatives.NEGATIVES})
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM hits""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
