"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.session import ensure_checkpoint_dir, ship, work_dir

# White space and words as every operator here understands them (ASCII blanks only).
BLANKS = r"[\x20\x09-\x0D]+"
BATCH_ROWS = 1_000


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: str) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def running_sums(values: Column) -> Column:
    """The sums of an array of integers from its start to each place, by doubling: round k adds the sum that ends 2^k places before, so
    n values take n log n additions and no array grows by copies of itself."""
    rounds = F.when(F.size(values) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(values))).cast("int"))).otherwise(F.array().cast("array<int>"))

    def double(sums, k):
        return F.transform(sums, lambda x, i: x + F.coalesce(F.get(sums, i - F.call_function("shiftleft", F.lit(1), k)), F.lit(0)))
    return F.aggregate(rounds, values.cast("array<int>"), double)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder of the session; partitions stay as they are."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Cuts the lineage: the table is written as Parquet to the shared folder of the session and read back. Compressed columns take
    less of the disk than checkpointed rows, and readers take only the columns they need."""
    path = work_dir(df.sparkSession, f"cut-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(id_col: str) -> Column:
    """True for the rows no model may learn from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """mapInArrow whose function may import this package, in batches of ``BATCH_ROWS`` rows: texts may be long, and a batch lies
    in the memory of the executor and of its Python worker at once."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(run, schema)
