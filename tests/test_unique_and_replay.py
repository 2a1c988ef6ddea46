"""One row per SKU whatever the inputs hold; streams that survive replays and
new columns; the pipeline over catalog tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.operators import gold, silver
from shelfwise.plans.pipeline import PricingPipeline
from shelfwise.session import run_dir
from shelfwise.sources.tables import RAW_TABLES, SourceTables
from shelfwise.sources.testdata import RawTables
from shelfwise.streaming import jobs, runner


class Doubled:
    """The stand-ins with a second, older row per SKU where a table should have one."""

    def __init__(self, raw):
        self.raw, self.as_of = raw, raw.as_of

    def __getattr__(self, name):
        df = getattr(self.raw, name)
        if name == "customer_behavior":
            old = df.withColumn("snapshot_date", F.date_sub("snapshot_date", 9)).withColumn("view_count", F.col("view_count") + 1)
            return df.union(old).union(df)
        if name == "product_catalog":
            return df.union(df).union(df.withColumn("product_name", F.lit("zzz")))
        return df


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_one_row_per_sku(spark, sf_small):
    plain = PricingPipeline(spark, sf_small)
    p = PricingPipeline(spark, Doubled(RawTables(spark, sf_small)))
    mart = p.feature_mart
    assert mart.count() == mart.select("sku_id").distinct().count()
    assert rows(mart) == rows(gold.feature_mart(p.gold_features)) == rows(plain.feature_mart)
    assert rows(p.silver_prices) == rows(plain.silver_prices)


def test_latest_inventory_forms_agree(spark, sf_small):
    p = PricingPipeline(spark, sf_small)
    events = silver.dedup_inventory(p.bronze_inventory)
    assert rows(gold.latest_inventory_of_events(events, p.velocity)) == rows(gold.latest_inventory(p.silver_inventory))


def test_supplier_events_of_the_day_count(spark):
    day = config.AS_OF
    at = [dt.datetime.combine(day, dt.time(9)), dt.datetime.combine(day + dt.timedelta(days=1), dt.time()),
          dt.datetime.combine(day - dt.timedelta(days=90), dt.time())]
    events = spark.createDataFrame([("S", t, 0.1 * (i + 1)) for i, t in enumerate(at)],
                                   "sku_id string, event_timestamp timestamp, cost_delta_pct double")
    assert [tuple(r) for r in gold.supplier_pressure(events, day).collect()] == [("S", pytest.approx(0.2))]


def test_changed_input_changes_the_output(spark, sf_small):
    base = run_dir(spark, "tables")
    part = spark.read.parquet(f"{sf_small}/part.parquet")
    for t in ("lineitem", "orders", "events"):
        spark.read.parquet(f"{sf_small}/{t}.parquet").write.parquet(f"{base}/{t}.parquet")
    part.write.parquet(f"{base}/part.parquet")
    from shelfwise.plans.queries import QUERIES
    before = QUERIES["feature_mart"](spark, base).agg(F.sum("unit_cost")).first()[0]
    part.withColumn("p_retailprice", F.col("p_retailprice") * 2).write.mode("overwrite").parquet(f"{base}/part.parquet")
    spark.catalog.refreshByPath(base)
    assert QUERIES["feature_mart"](spark, base).agg(F.sum("unit_cost")).first()[0] == pytest.approx(2 * before, rel=1e-9)


def test_replayed_silver_batch_leaves_gold_unchanged(spark, sf_small):
    """A silver micro-batch whose commit was lost is run again after gold has
    read it: same rows, no new ones for gold."""
    import os
    p = PricingPipeline(spark, sf_small)
    base = run_dir(spark, "replay")
    p.bronze_prices.limit(400).write.parquet(f"{base}/bronze")
    args = (spark, f"{base}/bronze", p.raw.product_catalog, f"{base}/silver", f"{base}/chk")
    runner.silver_prices_job(*args, p.run_ts)
    dim = p.sku_dimension
    runner.gold_job(spark, f"{base}/silver", dim, f"{base}/gold", f"{base}/gold_chk", p.run_ts)
    n = runner.read_table(spark, f"{base}/gold").count()
    commits = sorted(x for x in os.listdir(f"{base}/chk/commits") if x.isdigit())
    os.remove(f"{base}/chk/commits/{commits[-1]}")  # crash between write and commit
    crc = f"{base}/chk/commits/.{commits[-1]}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    runner.silver_prices_job(*args, p.run_ts)
    runner.gold_job(spark, f"{base}/silver", dim, f"{base}/gold", f"{base}/gold_chk", p.run_ts)
    assert n > 0 and runner.read_table(spark, f"{base}/gold").count() == n
    assert runner.read_table(spark, f"{base}/silver").count() == n


def test_new_column_reaches_bronze_and_silver(spark, sf_small):
    p = PricingPipeline(spark, sf_small)
    base = run_dir(spark, "evolve")
    first = p.raw.competitor_prices.limit(50)
    runner.land(first, f"{base}/landing")
    later = dt.datetime(2030, 1, 1)
    runner.land(first.withColumn("event_timestamp", F.lit(later)).withColumn("promo_flag", F.lit("x")), f"{base}/landing")
    runner.bronze_job(spark, f"{base}/landing", "competitor_prices", f"{base}/bronze", f"{base}/c1")
    runner.silver_prices_job(spark, f"{base}/bronze", p.raw.product_catalog, f"{base}/silver", f"{base}/c2")
    for layer in ("bronze", "silver"):
        got = runner.read_table(spark, f"{base}/{layer}")
        assert got.filter("promo_flag = 'x'").count() > 0 and got.filter("promo_flag IS NULL").count() > 0
    bad = first.withColumn("competitor_price", F.lit("cheap"))
    bad.write.parquet(f"{base}/bad")
    with pytest.raises(ValueError, match="competitor_price"):
        runner.bronze_job(spark, f"{base}/bad", "competitor_prices", f"{base}/b2", f"{base}/c3")


def test_jobs_over_catalog_tables(spark, sf_small):
    raw = RawTables(spark, sf_small)
    base = run_dir(spark, "catalog")
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_test")
    for t in RAW_TABLES:
        getattr(raw, t).write.mode("overwrite").option("path", f"{base}/{t}").saveAsTable(f"raw_test.{t}")
    try:
        source = SourceTables(spark, config.AS_OF, "raw_test", {"daily_sales": f"{base}/daily_sales"})
        want = rows(PricingPipeline(spark, sf_small).feature_mart)
        assert rows(PricingPipeline(spark, source).feature_mart) == want
        out = jobs.run_all(spark, source, f"{base}/run", run_ts=config.RUN_TS, train_model=False)
        assert jobs.read(spark, out.feature_mart).count() == len(want)
    finally:
        spark.sql("DROP DATABASE raw_test CASCADE")
