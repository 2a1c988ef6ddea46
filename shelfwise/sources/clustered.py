"""The gold table clustered by SKU while it grows.

Each batch of the append stream becomes a run: its rows range-partitioned and
sorted by key, so a file holds a narrow range of keys.  A zone map, a small
table with the least and greatest key of each file, is the table's content: a
file counts when the map names it, and the map is replaced in one step.  A
lookup reads the files whose range holds one of its keys.  When there are more
than ``RUNS`` runs, the smallest are merged into one, so a lookup meets a
bounded number of runs and each row is rewritten a logarithmic number of times.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import VersionedTable, drop_folders

#: runs before the smallest are merged, and rows of a run's file at most
RUNS, FILE_ROWS = 8, 1_000_000
ZONES = "run string, file string, low string, high string, rows long"


class ClusteredTable:
    """The table below ``path``, clustered by ``key``; ``within`` orders the
    rows of a key, which may span files."""

    def __init__(self, spark: SparkSession, path: str, key: str = "sku_id", within: tuple[str, ...] = (),
                 file_rows: int = FILE_ROWS, runs: int = RUNS):
        self.spark, self.path, self.key, self.within = spark, path.rstrip("/"), key, list(within)
        self.file_rows, self.runs = file_rows, runs
        self.zones = VersionedTable(spark, f"{self.path}/zones")

    def zone_map(self) -> DataFrame:
        return self.zones.read() if self.zones.current() else self.spark.createDataFrame([], ZONES)

    def append(self, df: DataFrame, batch: int | None = None) -> None:
        """Add ``df`` as a run; a ``batch`` that isn't after the last one was
        added already."""
        last = self.zones.current()
        if last and batch is not None and last["batch"] is not None and batch <= last["batch"]:
            return
        zones = self.zone_map().unionByName(self._written(df))
        self.zones.replace(zones.coalesce(1), batch if batch is not None else (last["batch"] if last else None))
        self._merge()

    def _written(self, df: DataFrame) -> DataFrame:
        run = f"data-{uuid.uuid4().hex[:12]}"
        order = [self.key, *self.within]
        # in ranges whose number Spark fits to their size; a long one is cut into files as it is written, in order,
        # so the rows needn't be counted before
        (df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", self.file_rows)
         .parquet(f"{self.path}/{run}"))
        rows = self.spark.read.schema(df.schema).parquet(f"{self.path}/{run}")
        return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count("*").alias("rows")).select(
            F.lit(run).alias("run"), "file", "low", "high", "rows")

    def _merge(self) -> None:
        zones = self.zone_map()
        sizes = sorted((r["n"], r["run"]) for r in zones.groupBy("run").agg(F.sum("rows").alias("n")).collect())
        if len(sizes) <= self.runs:
            return
        some = [run for _, run in sizes[:max(2, self.runs // 2 + 1)]]
        files = [r["file"] for r in zones.where(F.col("run").isin(some)).select("file").collect()]
        rest = zones.where(~F.col("run").isin(some))
        merged = self._written(self.spark.read.option("mergeSchema", "true").parquet(*files))
        self.zones.replace(rest.unionByName(merged).coalesce(1), self.zones.current()["batch"])

    def read(self, keys: list | None = None) -> DataFrame:
        """All rows, or those of ``keys`` from the files that may hold them."""
        zones = self.zone_map()
        if keys is not None:
            hit = F.lit(False)
            for k in keys:
                hit = hit | F.lit(k).between(F.col("low"), F.col("high"))
            zones = zones.where(hit)
        files = [r["file"] for r in zones.select("file").collect()]
        if not files:
            everything = [r["file"] for r in self.zone_map().select("file").limit(1).collect()]
            if not everything:
                raise FileNotFoundError(f"{self.path} has no rows yet")
            return self.spark.read.parquet(*everything).limit(0)
        rows = self.spark.read.option("mergeSchema", "true").parquet(*files)
        return rows.where(F.col(self.key).isin(keys)) if keys is not None else rows

    def drop_old(self) -> list[str]:
        """Delete runs the current zone map doesn't name."""
        kept = {r["run"] for r in self.zone_map().select("run").distinct().collect()}
        return drop_folders(self.spark, self.path, kept)
