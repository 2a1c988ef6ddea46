"""Structured Streaming jobs: raw -> bronze -> silver -> gold.

Sources are append-only Parquet directories read with an explicit schema (A1);
sinks are Parquet directories with one checkpoint per sink (A4, I6), written in
append mode (I4) with a bounded ``availableNow`` trigger (A5): each run
processes whatever is pending and stops, and a rerun with the same
checkpoint resumes exactly where the previous one ended.

Every table a job writes is a native file sink: its metadata log names the
files of committed micro-batches, and both streaming and batch readers of the
folder follow that log, so a micro-batch that is run again changes nothing
downstream and half-written files are never read.  The static side of a join
(catalog, sales velocity, SKU dimension) is written once per run to the shared
folder.

Columns that appear in newly landed files are added to bronze and silver
(additive evolution); the gold table has its fixed columns.  A ledger beside
each checkpoint holds the files met so far, so a run reads the footers of new
files only, and the same new files give the sketch of frequent SKUs by which a
join is salted.

A backlog can be admitted in slices of event time: each slice is a run of its
own, so the watermark moves between them and the state holds about one slice,
and as no slice holds an earlier event than the one before, none is late that
wasn't at the start.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import bronze, gold, silver, skew
from ..operators.joins import write_and_read
from ..operators.unique import one_per_key
from ..session import state_on_disk
from ..sources import ledger, schemas
from ..sources.clustered import ClusteredTable
from ..sources.versions import VersionedTable


def land(df: DataFrame, path: str) -> None:
    """Append a batch of raw rows to an append-only landing directory."""
    df.write.mode("append").parquet(path)


def read_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A1: unbounded read of an append-only Parquet folder or a file sink."""
    return spark.readStream.schema(schema).parquet(path)


def run_available_now(df: DataFrame, path: str, checkpoint: str, name: str | None = None) -> int:
    """A4 + A5: append everything pending to ``path`` and stop; the most rows
    the state held at once.  State lies on the executors' disks, whatever the
    session's default (:func:`~shelfwise.session.state_on_disk`)."""
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    if name:
        writer = writer.queryName(name)
    with state_on_disk(df.sparkSession):  # a stream takes the settings at its start
        query = writer.start(path)
    return _finish(query, name or path)


def _finish(query, name: str) -> int:
    query.awaitTermination()
    err = query.exception()
    if err is not None:
        raise RuntimeError(f"stream {name} failed: {err}")
    return max((sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress), default=0)


def arrivals(spark: SparkSession, folder: str, declared: T.StructType, checkpoint: str) -> ledger.Arrivals:
    """Schema and new files of a folder, by the ledger beside ``checkpoint``."""
    path = f"{checkpoint.rstrip('/')}-files"
    new = ledger.arrivals(spark, folder, declared, path)
    new.enter(spark, path)
    return new


def hot_skus(spark: SparkSession, new: ledger.Arrivals) -> list[str]:
    """Frequent SKUs of the files about to be read (one column of them)."""
    return skew.frequent_keys(spark.read.schema(new.schema).parquet(*new.files), "sku_id") if new.files else []


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Batch read of a table folder (a file sink's log is followed).  With a
    declared ``schema`` no file footer is merged."""
    return spark.read.schema(schema).parquet(path) if schema else spark.read.option("mergeSchema", "true").parquet(path)


def bronze_job(spark: SparkSession, landing: str | DataFrame, table: str, out: str, checkpoint: str,
               run_ts: dt.datetime | None = None) -> None:
    """Raw landing directory, or a table's stream -> bronze (B1 metadata)."""
    raw = landing
    if not isinstance(landing, DataFrame):
        raw = read_stream(spark, landing, arrivals(spark, landing, schemas.RAW[table], checkpoint).schema)
    run_available_now(bronze.to_bronze(raw, f"raw.{table}", run_ts), out, checkpoint, f"bronze_{table}")


def silver_prices_job(spark: SparkSession, bronze_dir: str, catalog: DataFrame, out: str, checkpoint: str,
                      run_ts: dt.datetime | None = None, salts: int = 0) -> int:
    """Bronze prices -> silver prices (watermark dedup, catalog join).  With
    ``salts``, copies of a hot key are first dropped in that many tasks and hot
    SKUs are spread over as many in the join; a running stream keeps its
    number."""
    new = arrivals(spark, bronze_dir, schemas.bronze_schema(schemas.COMPETITOR_PRICES), checkpoint)
    hot = hot_skus(spark, new) if salts else []
    lookup = write_and_read(silver.catalog_lookup(catalog), "catalog_lookup")
    events = silver.dedup_prices(read_stream(spark, bronze_dir, new.schema), salts)
    return run_available_now(silver.enrich_prices(events, lookup, run_ts, hot, salts), out, checkpoint, "silver_competitor_prices")


def silver_inventory_job(spark: SparkSession, bronze_dir: str, velocity: DataFrame, out: str, checkpoint: str,
                         run_ts: dt.datetime | None = None, salts: int = 0) -> int:
    """Bronze inventory -> silver inventory (watermark dedup, velocity join);
    ``salts`` as for prices."""
    new = arrivals(spark, bronze_dir, schemas.bronze_schema(schemas.INVENTORY_EVENTS), checkpoint)
    hot = hot_skus(spark, new) if salts else []
    events = silver.dedup_inventory(read_stream(spark, bronze_dir, new.schema), salts)
    return run_available_now(silver.enrich_inventory(events, velocity, run_ts, hot, salts), out, checkpoint, "silver_inventory")


def gold_job(spark: SparkSession, silver_dir: str, dim: DataFrame, out: str, checkpoint: str,
             run_ts: dt.datetime | None = None, salts: int = 0) -> None:
    """The gold streaming table: silver price stream x SKU dimension."""
    hot = hot_skus(spark, arrivals(spark, silver_dir, schemas.SILVER_PRICES, checkpoint)) if salts else []
    stream = read_stream(spark, silver_dir, schemas.SILVER_PRICES)
    run_available_now(gold.pricing_features(stream, dim, run_ts, hot, salts), out, checkpoint, "gold_pricing_features")


def admit(spark: SparkSession, landing: str, declared: T.StructType, source: str, slices: int, run,
          time: str = "event_timestamp") -> list[int]:
    """A5 + I3: admit the files of ``landing`` that are new to the stream whose
    source folder is ``source``, in up to ``slices`` slices of event time, each
    followed by ``run()``; what the runs return.

    The cuts are quantiles of the new files' event times; rows without one go
    with the first slice.  What is still to be admitted is kept in a plan table:
    a call that failed is taken up by the next, whose first slice may then be
    admitted twice, which deduplication undoes."""
    plan, files = VersionedTable(spark, f"{source.rstrip('/')}-plan"), f"{source.rstrip('/')}-files"
    waiting = sorted(map(tuple, plan.read().collect())) if plan.current() else []
    new = ledger.arrivals(spark, landing, declared, files)
    rows, planned = spark.read.schema(new.schema), {f for *_, names in waiting for f in names}
    fresh = sorted(set(new.files) - planned)
    if fresh:
        share = F.array(*[F.lit(i / slices) for i in range(1, slices)])
        cuts = rows.parquet(*fresh).agg(F.percentile_approx(F.unix_micros(time), share, 10_000)).first()[0] if slices > 1 else None
        edges = [None, *sorted(set(cuts or [])), None]
        first = waiting[-1][0] + 1 if waiting else 0
        waiting += [(first + i, a, b, fresh) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
        plan.replace(spark.createDataFrame(waiting, SLICES))
    new.enter(spark, files)
    out, at = [], F.unix_micros(time)
    while waiting:
        _, low, high, names = waiting.pop(0)
        inside = F.lit(True) if high is None else F.coalesce(at < high, F.lit(low is None))
        if low is not None:
            inside = inside & (at >= low)
        rows.parquet(*names).where(inside).write.mode("append").parquet(source)
        out.append(run())
        plan.replace(spark.createDataFrame(waiting, SLICES))
    return out


SLICES = "place long, low long, high long, files array<string>"


def refresh_mart(spark: SparkSession, gold_dir: str, out: str, checkpoint: str | None = None) -> DataFrame:
    """A7 + A8 + A3: bring the mart up to date with the gold table.

    The latest row of a SKU is the latest of any rows that hold it, so the mart
    is a state that merges: a stream over the gold files takes those that are
    new, cuts them to one row a SKU and merges that with the mart.  Its
    checkpoint is the log of files merged already; merging a file again changes
    nothing, so a replay is harmless.  Each merge is a new version of the mart,
    clustered by SKU and put in place in one step."""
    table = VersionedTable(spark, out)

    def merge(rows: DataFrame, number: int) -> None:
        # the new rows are cut to one a SKU, each task's before the shuffle; only those meet the mart's
        latest = gold.feature_mart(rows)
        if table.current():
            latest = one_per_key(table.read().unionByName(latest), "sku_id", gold.mart_order())
        table.replace(gold.clustered(latest), number)
    stream = read_stream(spark, gold_dir, schemas.GOLD_FEATURES)
    _finish(stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint or f"{out.rstrip('/')}-merged")
            .trigger(availableNow=True).queryName("gold_feature_mart").start(), out)
    if not table.current():
        table.replace(spark.createDataFrame([], schemas.GOLD_FEATURES))
    return table.read()


def cluster_gold(spark: SparkSession, gold_dir: str, out: str, checkpoint: str | None = None) -> ClusteredTable:
    """The gold table clustered by SKU: what was appended since the last
    call becomes a sorted run.  ``out`` belongs to its checkpoint: a batch that
    is run again is recognised by its number."""
    table = ClusteredTable(spark, out, "sku_id", ("source_event_timestamp", "competitor"))
    stream = read_stream(spark, gold_dir, schemas.GOLD_FEATURES)
    _finish(stream.writeStream.foreachBatch(table.append).option("checkpointLocation", checkpoint or f"{out.rstrip('/')}-clustered")
            .trigger(availableNow=True).queryName("gold_clustered").start(), out)
    return table
