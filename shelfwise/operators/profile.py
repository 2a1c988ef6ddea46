"""Table verification profile (E6): rows, latest timestamp, distinct keys,
computed in ONE aggregate per table (the pricing pipeline runs two or three
jobs per table for the same numbers).

A table that grows by files can be profiled by file: each file's rows, latest
time and a sketch of its keys are kept in a ledger, and a profile merges them,
so a file is read once in its life.  The distinct keys are exact up to about
``2 ** SKETCH`` of them and an estimate beyond (within about 0.4%)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: raw tables with their time column and key, where they have one
RAW = [
    ("product_catalog", None, "sku_id"),
    ("inventory_events", "event_timestamp", "sku_id"),
    ("competitor_prices", "event_timestamp", "sku_id"),
    ("daily_sales", "sale_date", "sku_id"),
    ("customer_behavior", "snapshot_date", "sku_id"),
    ("promotions", "start_date", "sku_id"),
    ("supplier_cost_changes", "event_timestamp", "sku_id"),
    ("macro_signals", "signal_week", None),
]


def profile(df: DataFrame, name: str, ts_col: str | None, key_col: str | None = "sku_id") -> DataFrame:
    latest = F.max(ts_col).cast("timestamp") if ts_col else F.lit(None).cast("timestamp")
    keys = F.count_distinct(key_col) if key_col else F.lit(None).cast("long")
    return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                  latest.alias("latest_ts"), keys.alias("distinct_keys"))


def profile_two(df: DataFrame, one: tuple[str, str], two: tuple[str, str], key_col: str) -> DataFrame:
    """Two tables with the same rows, each with a (name, time column) of its
    own, in one aggregate."""
    sums = df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(key_col).alias("distinct_keys"),
                  *[F.max(ts).cast("timestamp").alias(f"_{i}") for i, (_, ts) in enumerate((one, two))])
    both = F.array(*[F.struct(F.lit(name).alias("table_name"), F.col(f"_{i}").alias("latest_ts")) for i, (name, _) in enumerate((one, two))])
    return sums.select("row_count", "distinct_keys", F.inline(both)).select("table_name", "row_count", "latest_ts", "distinct_keys")


def profiles(tables: list[tuple[DataFrame, str, str | None, str | None]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile(*t) for t in tables])


# --- by file ----------------------------------------------------------------------
SKETCH = 16
FILES = "file string, rows long, latest timestamp, keys binary"


def file_states(spark: SparkSession, files: list[str], schema: T.StructType, ts_col: str, key_col: str) -> DataFrame:
    """FILES rows of ``files``, in one pass over their two columns; a file
    without rows has none."""
    path = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    return (spark.read.schema(schema).parquet(*files).groupBy(path.alias("file"))
            .agg(F.count("*").alias("rows"), F.max(ts_col).cast("timestamp").alias("latest"),
                 F.theta_sketch_agg(key_col, SKETCH).alias("keys")))


def profile_by_file(spark: SparkSession, folder: str, schema: T.StructType, ledger: str, name: str, ts_col: str,
                    key_col: str = "sku_id") -> DataFrame:
    """The profile of the Parquet table ``folder``; only files that the ledger
    doesn't hold are read, and then enter it.  Files that are gone don't count."""
    # one way of writing the paths of local files
    files = [re.sub("^file:/+", "file:/", f) for f in spark.read.schema(schema).parquet(folder).inputFiles()]

    def known() -> DataFrame | None:
        try:
            return spark.read.schema(FILES).parquet(ledger)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
    held = known()
    seen = {r["file"] for r in held.select("file").collect()} if held is not None else set()
    new = sorted(set(files) - seen)
    if new:
        found = file_states(spark, new, schema, ts_col, key_col)
        listed = spark.createDataFrame([(f,) for f in new], "_file string")  # files without rows enter too
        listed.join(found, F.col("_file") == F.col("file"), "left").select(
            F.col("_file").alias("file"), F.coalesce("rows", F.lit(0)).alias("rows"), "latest", "keys").write.mode("append").parquet(ledger)
    now = spark.createDataFrame([(f,) for f in files], "_file string")
    states = (known() if files else spark.createDataFrame([], FILES)).join(now, F.col("file") == F.col("_file"), "left_semi").dropDuplicates(["file"])
    keys = F.theta_sketch_estimate(F.theta_union_agg("keys", SKETCH))
    return states.agg(F.lit(name).alias("table_name"), F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
                      F.max("latest").alias("latest_ts"), F.coalesce(keys, F.lit(0)).cast("long").alias("distinct_keys"))
