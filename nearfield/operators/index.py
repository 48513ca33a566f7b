"""Geo index: build, hot-zone routing, zone moves, audit, density.

The index is one DataFrame with one row per indexed business:
``business_id, geohash, latitude, longitude, zone, gh4``. ``zone`` ('hot' / 'normal') and
``gh4`` (first four geohash characters) are the storage partition columns (see
``nearfield.sources.index_store``), so hot and normal rows are partition values of one table; a read
without a zone filter is the union of both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfield.functions import geo

STORAGE_PRECISION = 8
ZONE_HOT = "hot"
ZONE_NORMAL = "normal"
HOT_PREFIX_LEN = 4
MAX_PREFIX_LEN = 10  # fixed: the width of the configuration's prefix column
BROADCAST_ZONES = 1 << 20

INDEX_COLUMNS = ["business_id", "geohash", "latitude", "longitude", "zone", "gh4"]


def active_configs(config: DataFrame) -> DataFrame:
    """Active hot-zone rows of 4-character prefixes; other lengths never match. One row per prefix of a 32-letter
    alphabet, i.e. at most 32^4 = 1,048,576 rows, so broadcasting it is safe."""
    prefix = F.col("geohash_prefix").rlike(f"^[{geo.GEOHASH_ALPHABET}]{{{HOT_PREFIX_LEN}}}$")
    return config.filter(F.col("is_active") & prefix).select(
        F.col("geohash_prefix").alias("hz_prefix"),
        F.col("radius_limit").alias("hz_radius_limit"),
        F.col("description").alias("hz_description"),
    ).dropDuplicates(["hz_prefix"])


def attach_hot_zone(df: DataFrame, config: DataFrame | None, geohash_col: str = "geohash") -> DataFrame:
    """Add hz_prefix, hz_radius_limit and is_hot by the exact 4-character prefix.

    Shorter or null geohashes never match. A missing config means no hot zones.
    """
    gh = F.col(geohash_col)
    key = F.when(F.length(gh) >= HOT_PREFIX_LEN, F.substring(gh, 1, HOT_PREFIX_LEN))
    if config is None:
        return df.withColumn("hz_prefix", F.lit(None).cast("string")).withColumn(
            "hz_radius_limit", F.lit(None).cast("int")).withColumn("is_hot", F.lit(False))
    zones = F.broadcast(active_configs(config).drop("hz_description"))
    out = df.withColumn("_hz_key", key).join(zones, F.col("_hz_key") == F.col("hz_prefix"), "left").drop("_hz_key")
    return out.withColumn("is_hot", F.col("hz_prefix").isNotNull())


def longest_zones(config: DataFrame) -> DataFrame:
    """Active hot-zone rows of prefixes of 1 to ``MAX_PREFIX_LEN`` letters: hz_prefix, hz_radius_limit; the least limit where a prefix
    stands twice."""
    prefix = F.col("geohash_prefix").rlike(f"^[{geo.GEOHASH_ALPHABET}]{{1,{MAX_PREFIX_LEN}}}$")
    return config.filter(F.col("is_active") & prefix).groupBy(F.col("geohash_prefix").alias("hz_prefix")).agg(
        F.min("radius_limit").alias("hz_radius_limit"))


def attach_longest_zone(df: DataFrame, config: DataFrame, geohash_col: str = "geohash") -> DataFrame:
    """S8 with longest prefixes: hz_prefix, hz_radius_limit and is_hot of the longest configured prefix of a geohash.

    One equi-join per prefix length in the configuration. Its rows and lengths are read before the plan is made: up to ``BROADCAST_ZONES``
    zones are broadcast, so the rows stay where they are; beyond, the joins shuffle. A null geohash has no zone.
    """
    zones = longest_zones(config)
    few = zones.limit(BROADCAST_ZONES + 1).count() <= BROADCAST_ZONES
    lengths = sorted((r[0] for r in zones.select(F.length("hz_prefix")).distinct().collect()), reverse=True)  # MAX_PREFIX_LEN at most
    gh, found = F.col(geohash_col), []
    for n in lengths:
        side = zones.filter(F.length("hz_prefix") == n).select(
            F.col("hz_prefix").alias(f"_hz_key{n}"), F.struct("hz_prefix", "hz_radius_limit").alias(f"_hz{n}"))
        key = F.when(F.length(gh) >= n, F.substring(gh, 1, n))
        df = df.join(F.broadcast(side) if few else side, key == F.col(f"_hz_key{n}"), "left").drop(f"_hz_key{n}")
        found.append(F.col(f"_hz{n}"))
    best = F.coalesce(*found) if found else F.lit(None).cast("struct<hz_prefix:string,hz_radius_limit:int>")
    df = df.withColumn("_hz", best).withColumns({"hz_prefix": F.col("_hz.hz_prefix"), "hz_radius_limit": F.col("_hz.hz_radius_limit")})
    return df.withColumn("is_hot", F.col("hz_prefix").isNotNull()).drop("_hz", *[f"_hz{n}" for n in lengths])


def index_rows(df: DataFrame, config: DataFrame | None, id_col: str = "id", longest_prefix: bool = False) -> DataFrame:
    """Index rows for business rows: geohash(8) from coordinates rounded to the stored 6 decimals. ``longest_prefix`` takes zones of any
    prefix length in place of exactly four letters."""
    rows = df.select(
        F.col(id_col).alias("business_id"),
        F.round(F.col("latitude"), 6).alias("latitude"),
        F.round(F.col("longitude"), 6).alias("longitude"),
    )
    rows = geo.with_geohash(rows, "latitude", "longitude", STORAGE_PRECISION).select(
        "business_id", "geohash", "latitude", "longitude")
    rows = attach_longest_zone(rows, config) if longest_prefix and config is not None else attach_hot_zone(rows, config)
    return rows.select(
        "business_id", "geohash", "latitude", "longitude",
        F.when(F.col("is_hot"), F.lit(ZONE_HOT)).otherwise(F.lit(ZONE_NORMAL)).alias("zone"),
        F.substring("geohash", 1, HOT_PREFIX_LEN).alias("gh4"),
    )


def full_reindex(business: DataFrame, config: DataFrame | None = None, longest_prefix: bool = False) -> DataFrame:
    """Rebuild the index from every ACTIVE business (deleted ones are never indexed)."""
    return index_rows(business.filter(F.col("status") == "ACTIVE"), config, longest_prefix=longest_prefix)


def is_empty(df: DataFrame) -> bool:
    """Emptiness test that reads at most one row."""
    return len(df.limit(1).take(1)) == 0


def zone_move(index: DataFrame, upserts: DataFrame) -> DataFrame:
    """Write upserted rows into their zone and remove the ids everywhere else.

    Both sides are keyed by business_id; the anti join keeps exactly one row per business.
    """
    keep = index.join(upserts.select("business_id"), "business_id", "left_anti")
    return keep.unionByName(upserts.select(*INDEX_COLUMNS))


def delete_ids(index: DataFrame, ids: DataFrame) -> DataFrame:
    """Drop index rows of the given business ids from both zones."""
    return index.join(ids.select("business_id"), "business_id", "left_anti")


def prefix_lookup(index: DataFrame, prefix: str) -> DataFrame:
    """Distinct business ids whose geohash starts with ``prefix``.

    Over a stored index the ``gh4`` partition predicate prunes folders, whatever the prefix's length, in both zones.
    """
    head = prefix[:HOT_PREFIX_LEN]
    part = F.col("gh4") == head if len(head) == HOT_PREFIX_LEN else F.col("gh4").startswith(head)
    cond = part & F.col("geohash").startswith(prefix)
    return index.filter(cond).select("business_id").distinct()


def audit_index(business: DataFrame, index: DataFrame, config: DataFrame | None = None) -> DataFrame:
    """One row per business id that is wrong in the index, with the problem found.

    Classes: missing (active business not indexed), not_active (indexed but deleted),
    unknown (indexed id with no business), duplicate (several rows), wrong_geohash,
    wrong_zone. Built from one aggregation of the index and one full outer join on id.
    """
    expected = index_rows(business.filter(F.col("status") == "ACTIVE"), config).select(
        "business_id", F.col("geohash").alias("exp_geohash"), F.col("zone").alias("exp_zone"))
    per_id = index.groupBy("business_id").agg(
        F.count(F.lit(1)).alias("index_rows"),
        F.min("geohash").alias("idx_geohash"),
        F.max("geohash").alias("idx_geohash_max"),
        F.min("zone").alias("idx_zone"),
        F.max("zone").alias("idx_zone_max"),
    )
    status = business.select(F.col("id").alias("business_id"), F.col("status"))
    j = per_id.join(status, "business_id", "full").join(expected, "business_id", "left")
    problem = (
        F.when(F.col("index_rows").isNull() & (F.col("status") == "ACTIVE"), F.lit("missing"))
        .when(F.col("index_rows").isNotNull() & F.col("status").isNull(), F.lit("unknown"))
        .when(F.col("index_rows").isNotNull() & (F.col("status") != "ACTIVE"), F.lit("not_active"))
        .when(F.col("index_rows") > 1, F.lit("duplicate"))
        .when(F.col("idx_geohash") != F.col("exp_geohash"), F.lit("wrong_geohash"))
        .when(F.col("idx_zone") != F.col("exp_zone"), F.lit("wrong_zone"))
    )
    return j.select("business_id", problem.alias("problem"), F.coalesce("index_rows", F.lit(0)).cast("long").alias("index_rows")).filter(
        F.col("problem").isNotNull())


def cell_density(index: DataFrame, precision: int, threshold: int) -> DataFrame:
    """Businesses per cell at ``precision`` and a hot-zone proposal flag (count >= threshold).

    A partial aggregation; no global ordering, so no single task sees every cell.
    """
    cells = index.groupBy(F.substring("geohash", 1, precision).alias("cell")).agg(
        F.count(F.lit(1)).alias("businesses"))
    return cells.withColumn("propose_hot", F.col("businesses") >= F.lit(threshold))


def densest_cells(index: DataFrame, precision: int, k: int) -> DataFrame:
    """Top-k report of the densest cells (ties by cell); a distributed take-ordered, not a sort of all cells."""
    return cell_density(index, precision, 0).drop("propose_hot").orderBy(F.desc("businesses"), F.asc("cell")).limit(k)


def zone_proposals(index: DataFrame, threshold: int, finest: int = 7, coarsest: int = 4) -> DataFrame:
    """E7 over several precisions: (cell, precision, own) of the dense cells, each with the businesses that no dense cell below it
    explains, where those are at least ``threshold``.

    The index is counted once, by its finest cells; each coarser precision adds up the cells that were not dense, so the
    rows shrink from level to level and a hot place is merged before any shuffle.
    """
    cells = index.filter(F.length("geohash") >= finest).groupBy(F.substring("geohash", 1, finest).alias("cell")).agg(
        F.count(F.lit(1)).alias("own"))
    out = None
    for p in range(finest, coarsest - 1, -1):
        dense = cells.filter(F.col("own") >= threshold).select("cell", F.lit(p).alias("precision"), "own")
        out = dense if out is None else out.unionByName(dense)
        cells = cells.filter(F.col("own") < threshold).groupBy(F.substring("cell", 1, p - 1).alias("cell")).agg(F.sum("own").alias("own"))
    return out


def proposed_config(proposals: DataFrame) -> DataFrame:
    """Hot-zone rows for the proposals: the radius limit is the largest radius whose search precision is the cell's."""
    limit = None
    for radius, p in geo.POLICY_PRECISION:
        limit = F.when(F.col("precision") >= p, F.lit(radius)) if limit is None else limit.when(F.col("precision") >= p, F.lit(radius))
    return proposals.select(F.col("cell").alias("geohash_prefix"), F.concat(F.lit("dense: "), F.col("own")).alias("description"),
                            limit.cast("int").alias("radius_limit"), F.lit(True).alias("is_active"))
