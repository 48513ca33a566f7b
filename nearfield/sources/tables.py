"""Reading the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GIVEN_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; column pruning and filters reach the Parquet scan."""
    if name not in GIVEN_TABLES:
        raise ValueError(f"unknown table {name}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
