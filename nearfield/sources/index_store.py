"""The stored geo index (A8): versioned snapshots of index rows and of their tree.

Layout below a root folder::

    points/zone=<zone>/gh4=<gh4>/version=<n>/...   index rows with the level, x, y of their leaf, sorted by geohash
    cells/gh4=<gh4>/version=<n>/...                the quadtree's cells (level, x, y, n, leaf), sorted by level
    manifest/<n>.json                              which version of each folder is live; written last, in one rename

A reader takes the newest manifest and reads the folders that it names, so it sees a whole snapshot whatever a writer is
doing, and a writer that dies leaves the last one live. What lies below a geohash prefix of four characters is one tree, so a merge
(I2) writes the prefixes that its batch touches and no others; all other folders stay live as they are. Filters on zone and gh4
select folders, and row groups are selected by geohash. One writer at a time is expected. Folders of versions that no manifest
names any more may be dropped by ``vacuum`` once no reader is on them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.functions import geo
from nearfield.operators.index import HOT_PREFIX_LEN, INDEX_COLUMNS, full_reindex, is_empty
from nearfield.operators.quadtree import CELL, ROOT, Tree, cell_counts, deep_cells, leaf_points, tree_cells
from nearfield.session import Scratch, path_of

SPREAD = 16  # files that a dense gh4 cell is spread over, by its next geohash character

_POINTS = "business_id long, geohash string, latitude double, longitude double, level int, x long, y long, zone string, gh4 string, version long"
_CELLS = "level int, x long, y long, n long, leaf boolean, gh4 string, version long"


@dataclass
class Snapshot:
    """A live version: ``points`` maps (zone, gh4) to the version of its folder, ``cells`` maps gh4."""

    version: int
    points: dict[tuple[str, str], int]
    cells: dict[str, int]


class IndexStore:
    """The index under a root folder, which all executors can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------ reading

    def snapshot(self) -> Snapshot | None:
        """The newest snapshot, or None before the first."""
        fs, folder = path_of(self.spark, f"{self.path}/manifest")
        if not fs.exists(folder):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        found = sorted(n for n in names if n.endswith(".json") and not n.startswith(("_", ".")))
        if not found:
            return None
        said = json.loads(self.spark.read.text(f"{self.path}/manifest/{found[-1]}", wholetext=True).first()[0])
        return Snapshot(said["version"], {tuple(k.split("/")): v for k, v in said["points"].items()}, said["cells"])

    def _rows(self, kind: str, schema: str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}")
        return reader.parquet(*[f"{self.path}/{kind}/{f}" for f in folders])

    def _points(self, live: dict[tuple[str, str], int]) -> DataFrame:
        return self._rows("points", _POINTS, [f"zone={z}/gh4={g}/version={v}" for (z, g), v in sorted(live.items())])

    def tree(self) -> Tree:
        """The live index as a search reads it: its points with their leaves, and the stored counts."""
        now = self.snapshot() or Snapshot(0, {}, {})
        cells = self._rows("cells", _CELLS, [f"gh4={g}/version={v}" for g, v in sorted(now.cells.items())])
        return Tree(self._points(now.points).drop("version"), cells.drop("version", "gh4"))

    def rows(self) -> DataFrame:
        """The live index rows."""
        return self.tree().points.select(*INDEX_COLUMNS)

    # ------------------------------------------------------------ writing

    def _write(self, rows: DataFrame, version: int) -> tuple[dict, dict]:
        """Writes rows of whole gh4 prefixes and their trees as one version; returns the folders written."""
        work = Scratch(self.spark, "index-rows")
        points = deep_cells(rows.select(*INDEX_COLUMNS))
        counts = work.written(cell_counts(points), "level")
        # A cell's rows go to up to SPREAD tasks by their fifth character, so a dense cell is not one task's.
        part = F.pmod(F.xxhash64(F.substring("geohash", 5, 1)), F.lit(SPREAD))
        out = leaf_points(points, counts).withColumns({"version": F.lit(version).cast("long"), "_part": part}).repartition("zone", "gh4", "_part")
        out = out.sortWithinPartitions("zone", "gh4", "geohash", "business_id")
        out.select("business_id", "geohash", "latitude", "longitude", *CELL, "zone", "gh4", "version").write.mode("append").partitionBy(
            "zone", "gh4", "version").parquet(f"{self.path}/points")
        up = lambda c: F.call_function("shiftright", F.col(c), F.col("level") - F.lit(ROOT))
        cells = tree_cells(counts).withColumns({"_rx": up("x"), "_ry": up("y"), "version": F.lit(version).cast("long")})
        cells = cells.withColumn("gh4", geo.geohash_from_cell("_rx", "_ry", HOT_PREFIX_LEN)).drop("_rx", "_ry")
        cells.repartition("gh4", "level").sortWithinPartitions("gh4", *CELL).write.mode("append").partitionBy("gh4", "version").parquet(f"{self.path}/cells")
        # Prefixes are at most 32^4; the roots of the counts name them.
        names = counts.filter(F.col("level") == ROOT).select(geo.geohash_from_cell("x", "y", HOT_PREFIX_LEN).alias("gh4")).distinct().collect()
        new_cells = {r["gh4"]: version for r in names}
        fs, _ = path_of(self.spark, self.path)
        zones = {z for z in ("hot", "normal")}
        new_points = {(z, g): version for g in new_cells for z in zones if fs.exists(path_of(self.spark, f"{self.path}/points/zone={z}/gh4={g}/version={version}")[1])}
        work.drop(counts)
        return new_points, new_cells

    def _publish(self, new: Snapshot) -> None:
        said = {"version": new.version, "points": {"/".join(k): v for k, v in sorted(new.points.items())}, "cells": dict(sorted(new.cells.items()))}
        fs, temporary = path_of(self.spark, f"{self.path}/manifest/_writing-{new.version:012d}")
        out = fs.create(temporary, True)
        out.write(bytearray(json.dumps(said).encode()))
        out.close()
        if not fs.rename(temporary, path_of(self.spark, f"{self.path}/manifest/{new.version:012d}.json")[1]):
            raise RuntimeError(f"version {new.version} exists already: another writer is on {self.path}")

    def _next(self, now: Snapshot | None) -> int:
        """A version number that no folder has: a writer that died may have left folders behind."""
        taken = [now.version if now else 0]
        for kind in ("points", "cells"):
            fs, folder = path_of(self.spark, f"{self.path}/{kind}")
            if fs.exists(folder):
                # Folders left by a dead writer are at most one version ahead of the last manifest, since every writer looks first.
                found = fs.globStatus(path_of(self.spark, f"{self.path}/{kind}/" + ("zone=*/gh4=*/" if kind == "points" else "gh4=*/") + "version=*")[1])
                taken += [int(s.getPath().getName().split("=")[1]) for s in found]
        return max(taken) + 1

    def rebuild(self, index: DataFrame) -> None:
        """Replaces the whole index by a new snapshot."""
        version = self._next(self.snapshot())
        self._publish(Snapshot(version, *self._write(index, version)))

    def merge(self, deletes: DataFrame, upserts: DataFrame) -> list[str]:
        """Takes the ids of ``deletes`` out and puts the rows of ``upserts`` in, one row per business; returns the gh4 prefixes renewed.

        Only prefixes that hold an affected row, before or after, are read in full and written."""
        now = self.snapshot() or Snapshot(0, {}, {})
        work = Scratch(self.spark, "merge")
        rows = work.written(upserts.select(*INDEX_COLUMNS))
        ids = work.written(deletes.select("business_id").unionByName(rows.select("business_id")).distinct())
        held = self._points(now.points).select("business_id", "gh4").join(ids, "business_id", "left_semi").select("gh4")
        touched = sorted(r["gh4"] for r in held.unionByName(rows.select("gh4")).distinct().collect())  # at most 32^4
        if touched:
            reach = set(touched)
            old = self._points({k: v for k, v in now.points.items() if k[1] in reach}).select(*INDEX_COLUMNS)
            version = self._next(now)
            points, cells = self._write(old.join(ids, "business_id", "left_anti").unionByName(rows), version)
            self._publish(Snapshot(version, {k: v for k, v in now.points.items() if k[1] not in reach} | points,
                                   {g: v for g, v in now.cells.items() if g not in reach} | cells))
        return touched

    def vacuum(self) -> int:
        """Drops the folders that the live snapshot does not name, and older manifests; returns how many folders went."""
        now, gone = self.snapshot(), 0
        if now is None:
            return 0
        live = {f"zone={z}/gh4={g}/version={v}" for (z, g), v in now.points.items()}, {f"gh4={g}/version={v}" for g, v in now.cells.items()}
        for kind, pattern, keep in (("points", "zone=*/gh4=*/version=*", live[0]), ("cells", "gh4=*/version=*", live[1])):
            fs, glob = path_of(self.spark, f"{self.path}/{kind}/{pattern}")
            for status in fs.globStatus(glob) or []:
                if status.getPath().toString().split(f"/{kind}/", 1)[1] not in keep:
                    fs.delete(status.getPath(), True)
                    gone += 1
        fs, folder = path_of(self.spark, f"{self.path}/manifest")
        for status in fs.listStatus(folder):
            if status.getPath().getName() != f"{now.version:012d}.json":
                fs.delete(status.getPath(), False)
        return gone


def write_index(index: DataFrame, path: str) -> None:
    """Writes index rows as a new snapshot."""
    IndexStore(index.sparkSession, path).rebuild(index)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The stored index rows; filters on zone and gh4 select folders."""
    return IndexStore(spark, path).rows()


def bootstrap_index(spark: SparkSession, path: str, business: DataFrame, config: DataFrame | None = None) -> IndexStore:
    """The stored index; built from the active businesses first if it is absent or empty."""
    store = IndexStore(spark, path)
    if store.snapshot() is None or is_empty(store.rows()):
        store.rebuild(full_reindex(business, config))
    return store
