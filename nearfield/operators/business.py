"""What a client sees of businesses (B13): the view of a row, look-ups of single ids and of many."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.operators.validate import lookup

VIEW_COLUMNS = ["id", "owner_id", "name", "category", "phone", "address", "latitude", "longitude", "status", "updated_at"]


def business_view(df: DataFrame) -> DataFrame:
    """The columns that a client sees, without geohash and created_at."""
    return df.select(*VIEW_COLUMNS)


def get_many(business: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Views of the active businesses among the ids, each once; ids without one are left out."""
    found, _ = lookup(business, ids, id_col)
    return business_view(found)


def get_one(business: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """A row per distinct id asked for: the view of its active business, or ``error``. Equal ids are merged before the shuffle,
    so an id that most requests ask for is one row of the join. A null id is not found."""
    found, missing = lookup(business, ids.filter(F.col(id_col).isNotNull()), id_col)
    none = ids.filter(F.col(id_col).isNull()).select(F.col(id_col).alias("id")).distinct()
    missing = missing.select("id").unionByName(none)
    views = business_view(found).withColumn("error", F.lit(None).cast("string"))
    kinds = {f.name: f.dataType for f in views.schema.fields}
    error = F.concat(F.lit("business not found: "), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    return views.unionByName(missing.select(
        "id", *[F.lit(None).cast(kinds[c]).alias(c) for c in VIEW_COLUMNS[1:]], error.alias("error")))
