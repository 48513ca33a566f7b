"""Row validation and simple predicates (C1-C8). Bad rows are kept with a reason, never dropped silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.functions.cursor import decode_cursor

# Fixed request rules of the search endpoint.
LAT_MIN, LAT_MAX = -90.0, 90.0
LON_MIN, LON_MAX = -180.0, 180.0
RADIUS_MIN, RADIUS_MAX, RADIUS_DEFAULT = 100, 50000, 5000
LIMIT_MIN, LIMIT_MAX, LIMIT_DEFAULT = 1, 100, 20
# Column length limits of the business table: name 120, category 40, phone 32, address 255.
MAX_LEN = {"name": 120, "category": 40, "phone": 32, "address": 255}


def reasons(*checks: tuple[Column, str]) -> Column:
    """'; '-joined messages of the checks that fail (null when all pass)."""
    msgs = [F.when(bad, F.lit(msg)) for bad, msg in checks]
    joined = F.concat_ws("; ", *msgs)
    return F.when(joined == "", F.lit(None).cast("string")).otherwise(joined)


def validate_search(df: DataFrame, limit_col: str | None = "limit", cursor_col: str | None = "cursor") -> DataFrame:
    """Resolve defaults and check every request. Adds resolved_radius, resolved_limit,
    offset, ok and reason (null when ok)."""
    lat, lon = F.col("latitude"), F.col("longitude")
    radius = F.coalesce(F.col("radius_m"), F.lit(RADIUS_DEFAULT))
    limit = F.col(limit_col) if limit_col else F.lit(None).cast("int")
    cur = decode_cursor(F.col(cursor_col) if cursor_col else F.lit(None).cast("string"))
    out = df.withColumn("_cur", cur)
    why = reasons(
        (lat.isNull() | (lat < LAT_MIN) | (lat > LAT_MAX), "latitude out of range"),
        (lon.isNull() | (lon < LON_MIN) | (lon > LON_MAX), "longitude out of range"),
        ((radius < RADIUS_MIN) | (radius > RADIUS_MAX), "radius out of range"),
        (limit.isNotNull() & ((limit < LIMIT_MIN) | (limit > LIMIT_MAX)), f"limit must be between {LIMIT_MIN} and {LIMIT_MAX}"),
        (F.col("_cur.error").isNotNull(), "invalid cursor"),
    )
    return (out.withColumn("resolved_radius", radius.cast("int"))
            .withColumn("resolved_limit", F.coalesce(limit, F.lit(LIMIT_DEFAULT)).cast("int"))
            .withColumn("offset", F.col("_cur.offset"))
            .withColumn("reason", why)
            .withColumn("ok", F.col("reason").isNull())
            .drop("_cur"))


def active_only(df: DataFrame) -> DataFrame:
    """C2."""
    return df.filter(F.col("status") == "ACTIVE")


def lookup(business: DataFrame, ids: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Active rows for a set of ids (semi join) and the ids not found (anti join)."""
    wanted = ids.select(F.col(id_col).alias("id")).distinct()
    found = active_only(business).join(wanted, "id", "left_semi")
    missing = wanted.join(active_only(business).select("id"), "id", "left_anti").withColumn("reason", F.lit("not found"))
    return found, missing


# White space as blanks of a text field: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE_SPACE = " \t\n\x0b\x0c\r"


def _blank(c: Column) -> Column:
    return c.isNull() | c.rlike(r"^[\x09-\x0D\x20]*$")


def business_reasons(columns=None) -> Column:
    """C6 rules for a create/replace payload; with ``columns``, only the rules of those columns."""
    lat, lon = F.col("latitude"), F.col("longitude")
    rules = [("owner_id", lambda: F.col("owner_id").isNull(), "owner_id required")]
    rules += [(c, lambda c=c: _blank(F.col(c)), f"{c} blank") for c in ("name", "category", "address")]
    rules += [("latitude", lambda: lat.isNull() | (lat < LAT_MIN) | (lat > LAT_MAX), "latitude out of range"),
              ("longitude", lambda: lon.isNull() | (lon < LON_MIN) | (lon > LON_MAX), "longitude out of range")]
    rules += [(c, lambda c=c, n=n: F.length(c) > n, f"{c} too long") for c, n in MAX_LEN.items()]
    return reasons(*[(bad(), message) for c, bad, message in rules if columns is None or c in columns])


def validate_business(df: DataFrame) -> DataFrame:
    """Adds reason (null when the row is valid)."""
    return df.withColumn("reason", business_reasons())


def unprocessed(log: DataFrame) -> DataFrame:
    """C7."""
    return log.filter(~F.col("processed"))


def retention_delete(df: DataFrame, ts_col: str, cutoff) -> DataFrame:
    """Rows whose timestamp is at or after the cutoff (location data past its keep period goes)."""
    return df.filter(F.col(ts_col) >= F.lit(cutoff))
