"""Structured Streaming behaviour: watermark dedup across two availableNow runs
(late rows dropped, duplicates dropped, state resumed from the checkpoint),
and streaming == batch on the stand-in data."""

import datetime as dt
import os

from pyspark.sql import functions as F

from shelfwise.plans.pipeline import PricingPipeline
from shelfwise.session import run_dir
from shelfwise.sources import schemas
from shelfwise.streaming import runner

D = dt.date(2001, 5, 31)


def _t(h, m=0):
    return dt.datetime.combine(D, dt.time(h, m))


def _bronze_rows(spark, rows, tag):
    return spark.createDataFrame(
        [(f"{tag}{i}", "SKU-00001", "C1", 10.0, None, ts, _t(0), "raw.competitor_prices")
         for i, ts in enumerate(rows)],
        schemas.bronze_schema(schemas.COMPETITOR_PRICES))


def test_late_data_two_runs(spark):
    base = run_dir(spark, "late")
    catalog = spark.createDataFrame(
        [("SKU-00001", "n", "CAT", "CAT-1", "T", "B", 5.0, 1.0, True, None, "SUP-001", None)],
        schemas.PRODUCT_CATALOG)
    # run 1: 10:00 twice, 8:00, NULL
    _bronze_rows(spark, [_t(10), _t(10), _t(8), None], "a").write.parquet(f"{base}/bronze")
    runner.silver_prices_job(spark, f"{base}/bronze", catalog, f"{base}/silver", f"{base}/chk")
    got1 = sorted(r[0] for r in runner.read_table(spark, f"{base}/silver").select("event_timestamp").collect())
    assert got1 == [_t(8), _t(10)]
    # run 2, same checkpoint: 8:00 late, 9:45 new, 10:00 duplicate, 12:00 new
    _bronze_rows(spark, [_t(8), _t(9, 45), _t(10), _t(12)], "b").write.mode("append").parquet(f"{base}/bronze")
    runner.silver_prices_job(spark, f"{base}/bronze", catalog, f"{base}/silver", f"{base}/chk")
    got2 = sorted(r[0] for r in runner.read_table(spark, f"{base}/silver").select("event_timestamp").collect())
    assert got2 == [_t(8), _t(9, 45), _t(10), _t(12)]
    # a third run with nothing new appends nothing (exactly-once resume)
    runner.silver_prices_job(spark, f"{base}/bronze", catalog, f"{base}/silver", f"{base}/chk")
    assert runner.read_table(spark, f"{base}/silver").count() == 4
    assert os.path.isdir(f"{base}/chk/commits")


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_stream_equals_batch_prices(spark, sf_small):
    from shelfwise.plans.queries import SILVER_PRICE_STREAM_COLS, stream_bronze_silver_prices
    batch = PricingPipeline(spark, sf_small).silver_prices
    stream = stream_bronze_silver_prices(spark, sf_small)
    assert _rows(stream, SILVER_PRICE_STREAM_COLS) == _rows(batch, SILVER_PRICE_STREAM_COLS)


def test_stream_gold_and_mart_equal_batch(spark, sf_small):
    from shelfwise.plans.queries import stream_feature_mart
    p = PricingPipeline(spark, sf_small)
    cols = [c for c in p.feature_mart.columns]
    assert _rows(stream_feature_mart(spark, sf_small), cols) == _rows(p.feature_mart, cols)


def test_bronze_metadata_stream(spark, sf_small):
    p = PricingPipeline(spark, sf_small, run_ts=None)
    base = run_dir(spark, "bronze")
    runner.land(p.raw.inventory_events, f"{base}/landing")
    runner.bronze_job(spark, f"{base}/landing", "inventory_events", f"{base}/bronze", f"{base}/chk")
    out = spark.read.parquet(f"{base}/bronze")
    assert out.count() == p.raw.inventory_events.count()
    assert out.filter(F.col("_ingested_at").isNull()).count() == 0
    assert {r[0] for r in out.select("_source").distinct().collect()} == {"raw.inventory_events"}


def test_gold_stream_is_incremental(spark, sf_small):
    """A second availableNow run appends only the newly landed silver rows,
    and the refreshed mart picks up the newer events."""
    p = PricingPipeline(spark, sf_small)
    base = run_dir(spark, "gold-incr")
    silver = p.silver_prices
    cutoff = "1998-01-01"
    early = silver.filter(F.col("event_timestamp") < cutoff)
    late = silver.filter(F.col("event_timestamp") >= cutoff)
    early.write.parquet(f"{base}/silver")
    runner.gold_job(spark, f"{base}/silver", p.sku_dimension, f"{base}/gold", f"{base}/chk", p.run_ts)
    n1 = runner.read_table(spark, f"{base}/gold").count()
    assert n1 == early.count()
    late.write.mode("append").parquet(f"{base}/silver")
    runner.gold_job(spark, f"{base}/silver", p.sku_dimension, f"{base}/gold", f"{base}/chk", p.run_ts)
    assert runner.read_table(spark, f"{base}/gold").count() == silver.count()
    mart = runner.refresh_mart(spark, f"{base}/gold", f"{base}/mart")
    cols = p.feature_mart.columns
    assert _rows(mart, cols) == _rows(p.feature_mart, cols)


def test_run_all_jobs_end_to_end(spark, sf_small):
    from shelfwise.sources.testdata import RawTables
    from shelfwise.streaming import jobs
    raw = RawTables(spark, sf_small)
    root = run_dir(spark, "jobs")
    jobs.land_raw(raw, root)
    out = jobs.run_all(spark, raw, root, run_ts=PricingPipeline(spark, sf_small).run_ts, train_model=True)
    p = PricingPipeline(spark, sf_small)
    mart = jobs.read(spark, out.feature_mart)
    # stream dedup keeps the first arrival among duplicate keys; compare on
    # the columns the dedup key and the SKU determine
    cols = ["sku_id", "competitor", "source_event_timestamp", "current_stock", "units_sold_30d",
            "discount_pct", "promo_type", "cost_delta_pct", "ppi_steel", "current_price"]
    assert _rows(mart, cols) == _rows(p.feature_mart, cols)
    assert jobs.read(spark, out.recommendations).count() == mart.count()
    assert jobs.read(spark, out.model_scores).count() == mart.count()
    # a second run with nothing new appends nothing to the streaming tables
    n_gold = jobs.read(spark, out.gold_features).count()
    jobs.run_all(spark, raw, root, run_ts=p.run_ts, train_model=False)
    assert jobs.read(spark, out.gold_features).count() == n_gold
