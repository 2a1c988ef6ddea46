"""Catalog tables: namespaces (A9), batch scans (A2) and overwrite sinks (A3).

Tables live in the session catalog under ``spark.sql.warehouse.dir`` (point it
at shared storage on a cluster).  ``write_table`` can lay the rows out
clustered by a key (A8): range-partitioned and sorted, so Parquet min/max
statistics let later scans skip files by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.gold import clustered
from .versions import replace_catalog_table

LAYERS = ["raw", "bronze", "silver", "gold", "ml"]


def ensure_namespaces(spark: SparkSession, names: list[str] = LAYERS,
                      root: str | None = None) -> None:
    """Create the layer schemas when they are missing (optionally under
    ``root`` instead of the warehouse directory)."""
    for name in names:
        where = f" LOCATION '{root}/{name}.db'" if root else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A2: batch scan of a catalog table."""
    return spark.table(name)


def write_table(df: DataFrame, name: str, cluster_by: str | None = None,
                path: str | None = None) -> DataFrame:
    """A3: replace a table's rows and schema in one step; optionally clustered
    (A8) and stored below an explicit (shared) path."""
    if cluster_by:
        df = clustered(df, cluster_by)
    warehouse = df.sparkSession.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return replace_catalog_table(df, name, path or f"{warehouse}/{name.replace('.', '.db/')}-versions")


RAW_TABLES = ("product_catalog", "inventory_events", "competitor_prices", "daily_sales",
              "customer_behavior", "promotions", "supplier_cost_changes", "macro_signals")


class SourceTables:
    """A1 + A2: the eight raw tables of a deployment, by catalog name or path.

    ``namespace`` gives ``<namespace>.<table>`` for each; ``names`` overrides
    single tables (a name with ``/`` is a Parquet folder).  Batch reads are
    attributes, streams come from :meth:`stream`.
    """

    def __init__(self, spark: SparkSession, as_of, namespace: str = "raw", names: dict[str, str] | None = None):
        self.spark, self.as_of = spark, as_of
        self.names = {t: f"{namespace}.{t}" for t in RAW_TABLES} | (names or {})

    def __getattr__(self, table: str) -> DataFrame:
        if table not in RAW_TABLES:
            raise AttributeError(table)
        name = self.names[table]
        return self.spark.read.parquet(name) if "/" in name else read_table(self.spark, name)

    def stream(self, table: str) -> DataFrame:
        name = self.names[table]
        if "/" in name:
            return self.spark.readStream.schema(self.spark.read.parquet(name).schema).parquet(name)
        return self.spark.readStream.table(name)
