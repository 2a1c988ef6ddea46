"""Tables that are replaced in one step.

A version is a folder of its own, written whole before anyone is told of it.
For a catalog table the location is moved to it (one change in the catalog);
for a table that is known by its path, a row naming the folder is added to a
small log table, and readers take the last row.  A write that fails leaves the
old version in place, and whoever is reading it goes on, as its files stay
until :func:`drop_old` removes them.  One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

LOG = "version long, folder string, batch long, written timestamp"


class VersionedTable:
    """The table below ``path``: ``data-*`` folders and ``versions``, the log."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[Row]:
        """The committed versions, oldest first (one row a version)."""
        try:
            log = self.spark.read.schema(LOG).parquet(f"{self.path}/versions")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted(log.collect(), key=lambda r: r["version"])

    def current(self) -> Row | None:
        return (self.versions() or [None])[-1]

    def read(self, version: Row | None = None) -> DataFrame:
        """A version's rows, by default the current one's."""
        row = version or self.current()
        if row is None:
            raise FileNotFoundError(f"{self.path} has no version yet")
        return self.spark.read.parquet(f"{self.path}/{row['folder']}")

    def replace(self, df: DataFrame, batch: int | None = None) -> DataFrame:
        """Write ``df`` as the next version; ``batch`` is noted beside it."""
        last = self.current()
        folder = f"data-{uuid.uuid4().hex[:12]}"
        df.write.parquet(f"{self.path}/{folder}")
        row = (last["version"] + 1 if last else 0, folder, batch)
        (self.spark.createDataFrame([row], "version long, folder string, batch long").coalesce(1)
         .withColumn("written", F.current_timestamp()).write.mode("append").parquet(f"{self.path}/versions"))
        return self.read()

    def drop_old(self, keep: int = 2) -> list[str]:
        """Delete the data folders of all but the last ``keep`` versions and of
        writes that failed; returns their names."""
        kept = {r["folder"] for r in self.versions()[-keep:]}
        return drop_folders(self.spark, self.path, kept)


def drop_folders(spark: SparkSession, path: str, kept: set[str]) -> list[str]:
    """Delete the ``data-*`` folders of ``path`` that aren't in ``kept``."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(root) if s.isDirectory()]
    old = sorted(n for n in names if n.startswith("data-") and n not in kept)
    for name in old:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    return old


def replace_catalog_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Write ``df`` to a new folder below ``path`` and make it the location of
    catalog table ``name``, in one step where the columns stay or are added to.
    A table whose columns change otherwise is declared anew: its name is
    missing for a moment, its old files are not."""
    spark = df.sparkSession
    folder = f"{path.rstrip('/')}/data-{uuid.uuid4().hex[:12]}"
    df.write.parquet(folder)
    new = spark.read.parquet(folder).schema
    if spark.catalog.tableExists(name):
        old = {f.name: f.dataType for f in spark.table(name).schema.fields}
        if all(f.name in [n.name for n in new.fields] and new[f.name].dataType == f.dataType for f in spark.table(name).schema.fields):
            added = [f for f in new.fields if f.name not in old]
            if added:  # null in the old files, until the location moves
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
            return spark.table(name)
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=folder, source="parquet", schema=new)
    return spark.table(name)
