"""A mergeable quantile sketch (E3 / I4 at scale): counts per logarithmic bucket.

A bucket is an octave's 64th part, taken from the value's exponent and the top of its mantissa, so both ends of a bucket are exact
doubles and every engine puts a value into the same one. A state is (groups, bucket, c) rows; states merge by adding counts, over
batches, minutes and windows alike, in any order. A group has at most 64 buckets an octave, however many values it has.

An estimate is the middle of its bucket: off by at most ``RELATIVE_ERROR`` of the value, and never by a rank outside the bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = 64                       # of an octave
RELATIVE_ERROR = 1 / (2 * PARTS)
_SHIFT = 1100                    # makes every exponent of a double positive
_INFINITE = 2200 * PARTS         # bucket of infinity; that of NaN, which sorts last, is one more


def with_bucket(df: DataFrame, value_col: str, out: str = "bucket") -> DataFrame:
    """Adds the bucket of a value: ordered as the values are, 0 for zero, null for null."""
    v = F.col(value_col).cast("double")
    finite = ~F.isnan(v) & (F.abs(v) < float("inf")) & (v != 0.0)
    df = df.withColumn("_sk_a", F.when(finite, F.abs(v))).withColumn("_sk_e", F.floor(F.log2("_sk_a")))
    a, e = F.col("_sk_a"), F.col("_sk_e")
    # The logarithm may be rounded over a power of two; the powers themselves are exact.
    df = df.withColumn("_sk_e", F.when(a < F.pow(F.lit(2.0), e), e - 1).when(a >= F.pow(F.lit(2.0), e + 1), e + 1).otherwise(e))
    part = F.floor((a / F.pow(F.lit(2.0), F.col("_sk_e")) - 1.0) * PARTS)
    size = (F.col("_sk_e") + _SHIFT) * PARTS + part + 1
    bucket = (F.when(F.isnan(v), F.lit(_INFINITE + 1)).when(v == float("inf"), F.lit(_INFINITE)).when(v == float("-inf"), F.lit(-_INFINITE))
              .when(v == 0.0, F.lit(0)).when(v > 0.0, size).when(v < 0.0, -size))
    return df.withColumn(out, bucket.cast("int")).drop("_sk_a", "_sk_e")


def bucket_value(bucket: Column) -> Column:
    """The middle of a bucket."""
    b = F.abs(bucket) - 1
    middle = F.pow(F.lit(2.0), F.floor(b / PARTS) - _SHIFT) * (F.lit(1.0) + ((b % PARTS) + 0.5) / PARTS)
    return (F.when(bucket == 0, F.lit(0.0)).when(bucket > _INFINITE, F.lit(float("nan"))).when(bucket == _INFINITE, F.lit(float("inf")))
            .when(bucket == -_INFINITE, F.lit(float("-inf"))).when(bucket > 0, middle).otherwise(-middle))


def sketch(df: DataFrame, group_cols: list[str], value_col: str, weight_col: str | None = None) -> DataFrame:
    """The states (groups, bucket, c) of the values that are not null; a partial aggregation."""
    weight = F.col(weight_col) if weight_col else F.lit(1)
    return with_bucket(df.filter(F.col(value_col).isNotNull()), value_col).groupBy(*group_cols, "bucket").agg(
        F.sum(weight).cast("long").alias("c"))


def merge(states: DataFrame, group_cols: list[str]) -> DataFrame:
    """States of fewer groups, or of several writes, as one."""
    return states.groupBy(*group_cols, "bucket").agg(F.sum("c").cast("long").alias("c"))


def sketch_quantiles(states: DataFrame, group_cols: list[str], probs: dict[str, float]) -> DataFrame:
    """Groups, n, and an estimate of each probability's percentile, interpolated between neighbours as the exact one is."""
    group = Window.partitionBy(*group_cols)  # the buckets of a group
    upto = F.sum("c").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = merge(states, group_cols).select("*", upto.alias("_upto"), F.sum("c").over(group).alias("_n"))
    picks = []
    for name, p in probs.items():
        low = F.floor((F.col("_n") - 1) * F.lit(p))
        picks += [F.min(F.when(F.col("_upto") > low, F.col("bucket"))).alias(f"_{name}_a"),
                  F.min(F.when(F.col("_upto") > F.least(low + 1, F.col("_n") - 1), F.col("bucket"))).alias(f"_{name}_z")]
    found = ranked.groupBy(*group_cols).agg(F.max("_n").alias("n"), *picks)

    def estimate(name, p):
        a, z = bucket_value(F.col(f"_{name}_a")), bucket_value(F.col(f"_{name}_z"))
        h = (F.col("n") - 1) * F.lit(p)
        return F.when(F.col(f"_{name}_a") == F.col(f"_{name}_z"), a).otherwise(a + (z - a) * (h - F.floor(h))).alias(name)

    return found.select(*group_cols, "n", *[estimate(name, p) for name, p in probs.items()])
