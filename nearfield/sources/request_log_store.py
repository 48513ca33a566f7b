"""The stored request log (C8): a folder per day, so that data past its keep period goes by metadata.

Layout: ``day=<date>/batch=<n>/...``. A batch that is written again replaces its own folders. ``retain`` deletes the folders
of the days before the cutoff without reading a row; only the day that the cutoff cuts is written anew, and days after it keep
their files. A day of any size is spread over tasks by the rebalancing of the write. Rows without a time lie in a day of their own and
go at the first ``retain``: nothing shows that they may be kept.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearfield.operators.index import is_empty
from nearfield.session import path_of

_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class RequestLogStore:
    """The log below a root folder, which all executors can reach; ``schema`` is that of its rows."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, ts_col: str = "ts"):
        if {"day", "batch"} & set(schema.fieldNames()):
            raise ValueError("day and batch are columns of the store")
        self.spark, self.path, self.schema, self.ts_col = spark, path.rstrip("/"), schema, ts_col
        fs, root = path_of(spark, self.path)
        fs.mkdirs(root)

    def append(self, rows: DataFrame, batch: int) -> None:
        """Writes a batch; the same number again replaces what it wrote before, for a stream's replayed batch."""
        tagged = rows.select(*self.schema.fieldNames()).withColumns(
            {"day": F.to_date(self.ts_col), "batch": F.lit(batch).cast("long")})
        self._write(tagged)

    def _write(self, tagged: DataFrame) -> None:
        (tagged.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch").parquet(self.path))

    def rows(self) -> DataFrame:
        """All rows with their day and batch; a filter on day reads only its folders."""
        kinds = T.StructType([*self.schema.fields, T.StructField("day", T.DateType()), T.StructField("batch", T.LongType())])
        return self.spark.read.schema(kinds).parquet(self.path)

    def _folders(self, path: str, name: str) -> list[str]:
        fs, root = path_of(self.spark, path)
        found = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(n.split("=", 1)[1] for n in found if n.startswith(f"{name}="))

    def days(self) -> list[str]:
        """The days that are stored, as text, ascending; a list of folders, not a scan."""
        return [d for d in self._folders(self.path, "day") if d != _NO_DAY]

    def _drop(self, folder: str) -> None:
        fs, where = path_of(self.spark, f"{self.path}/{folder}")
        fs.delete(where, True)

    def retain(self, cutoff: dt.datetime) -> list[str]:
        """Drops all rows before the cutoff; returns the days dropped whole. Run again after a loss, it ends what it began."""
        cut = cutoff.date().isoformat()
        gone = [d for d in self._folders(self.path, "day") if d == _NO_DAY or d < cut]
        for day in gone:
            self._drop(f"day={day}")
        if cutoff.time() > dt.time() and cut in self.days():
            of_day = self.rows().filter(F.col("day") == F.lit(cutoff.date()))
            late = F.col(self.ts_col) >= F.lit(cutoff)
            if not is_empty(of_day.filter(~late)):
                batches = [str(r[0]) for r in of_day.filter(late).select("batch").distinct().collect()]  # at most the day's folders
                if batches:
                    self._write(of_day.filter(late))
                for batch in set(self._folders(f"{self.path}/day={cut}", "batch")) - set(batches):
                    self._drop(f"day={cut}/batch={batch}")
                if not batches:
                    self._drop(f"day={cut}")
        return [d for d in gone if d != _NO_DAY]
