"""Named queries: ``(spark, sf_dir) -> DataFrame``, one per operator group.

Each runs over the whole stand-in tables of ``sf_dir``.  The matching SQL
statements live in ``shelfwise.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, model, profile, recommend, rolling, silver, skew, target
from ..session import run_dir
from ..operators.joins import write_and_read
from ..sources import schemas, tables
from ..streaming import runner
from .pipeline import PricingPipeline


def _p(spark: SparkSession, sf_dir: str) -> PricingPipeline:
    """A pipeline of its own for every query: nothing is kept between queries,
    so each reads the tables as they are and pays for all its steps."""
    return PricingPipeline(spark, sf_dir)


# --- layers -----------------------------------------------------------------------
def bronze_prices(spark, sf_dir):
    return _p(spark, sf_dir).bronze_prices


def bronze_inventory(spark, sf_dir):
    return _p(spark, sf_dir).bronze_inventory


def silver_prices(spark, sf_dir):
    return _p(spark, sf_dir).silver_prices


def silver_inventory(spark, sf_dir):
    return _p(spark, sf_dir).silver_inventory


def demand_window(spark, sf_dir):
    p = _p(spark, sf_dir)
    return gold.demand_window(p.raw.daily_sales, p.as_of)


def supplier_pressure(spark, sf_dir):
    p = _p(spark, sf_dir)
    return gold.supplier_pressure(p.raw.supplier_cost_changes, p.as_of)


def macro_trailing(spark, sf_dir):
    p = _p(spark, sf_dir)
    return gold.macro_trailing(p.raw.macro_signals, p.as_of)


def latest_inventory(spark, sf_dir):
    p = _p(spark, sf_dir)
    return gold.latest_inventory_of_events(silver.dedup_inventory(p.bronze_inventory), p.velocity)


def best_promo(spark, sf_dir):
    return gold.best_promo(_p(spark, sf_dir).raw.promotions)


def sku_dimension(spark, sf_dir):
    return _p(spark, sf_dir).sku_dimension


def gold_features(spark, sf_dir):
    return _p(spark, sf_dir).gold_features


def feature_mart(spark, sf_dir):
    return _p(spark, sf_dir).feature_mart


def mart_clustered(spark, sf_dir):
    """A8 + A3: write the mart range-clustered by sku_id, read it back."""
    out = run_dir(spark, "feature_mart")
    gold.clustered(_p(spark, sf_dir).feature_mart).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


# --- recommendations -----------------------------------------------------------
def elasticity(spark, sf_dir):
    return recommend.with_elasticity(_p(spark, sf_dir).feature_mart)


def price_flags(spark, sf_dir):
    return _p(spark, sf_dir).price_flags


def action_counts(spark, sf_dir):
    return recommend.action_counts(_p(spark, sf_dir).price_flags)


def top_flags(spark, sf_dir):
    return recommend.top_flags(_p(spark, sf_dir).price_flags)


def sample_skus(spark, sf_dir):
    return recommend.sample_skus(_p(spark, sf_dir).feature_mart)


def mart_preview(spark, sf_dir):
    """A five-row preview of the mart (first SKUs, deterministic)."""
    return _p(spark, sf_dir).feature_mart.orderBy("sku_id").limit(5)


def recommendations_table(spark, sf_dir):
    """A9 + A3 + J3 + B12: write the flags as gold.pricing_recommendations."""
    root = run_dir(spark, "warehouse")
    tables.ensure_namespaces(spark, ["gold"], root=root)
    return tables.write_table(_p(spark, sf_dir).price_flags, "gold.pricing_recommendations",
                              cluster_by="sku_id", path=f"{root}/gold.db/pricing_recommendations")


def price_target(spark, sf_dir):
    return target.price_target_rows(_p(spark, sf_dir).feature_mart)


def price_target_noisy(spark, sf_dir):
    """J1 with its noise terms, drawn per SKU."""
    return target.with_price_target(_p(spark, sf_dir).feature_mart, noise=True).select("sku_id", "discount_pct", "optimal_price")


def target_summary(spark, sf_dir):
    return target.target_summary(_p(spark, sf_dir).labelled_mart)


def _formula_scores(spark, sf_dir) -> DataFrame:
    """The J1 target used as the recommended price (oracle-checkable)."""
    return recommend.score_compare(_p(spark, sf_dir).labelled_mart, prediction="optimal_price")


def score_compare(spark, sf_dir):
    return _formula_scores(spark, sf_dir)


def score_summary(spark, sf_dir):
    return recommend.score_summary(_formula_scores(spark, sf_dir))


def model_metrics(spark, sf_dir):
    """K4 on the test split, with the shelf price as a fixed predictor."""
    labelled = model.feature_frame(_p(spark, sf_dir).labelled_mart)
    _, test = model.split(labelled)
    return model.regression_metrics(test.withColumn("prediction", F.col("current_price")))


def gbt_score_compare(spark, sf_dir):
    """K1-K6 end to end: fit GBT, save + reload it, score the whole mart."""
    return _p(spark, sf_dir).model_scores


def gbt_score_summary(spark, sf_dir):
    """E8 over the fitted model's recommendations."""
    return recommend.score_summary(_p(spark, sf_dir).model_scores)


def gbt_metrics(spark, sf_dir):
    """K4 for the fitted GBT on the hash test split (values engine-specific)."""
    fitted, test, _ = _p(spark, sf_dir).price_model
    return model.regression_metrics(fitted.transform(test))


def gbt_checks(spark, sf_dir):
    """K1 + K3 + K5: facts about the fitted and the reloaded model."""
    p = _p(spark, sf_dir)
    fitted, test = model.train(p.materialized_mart)
    path = run_dir(spark, "price_model")
    model.save(fitted, path)
    return model.checks(fitted, model.load(path), test)


def table_profile(spark, sf_dir):
    """Every raw table, bronze by ingestion, silver by validation, gold and
    the mart.  Each layer is computed once: silver and gold are written, gold
    comes from the written silver and the mart from the written gold.  Silver
    prices need neither inventory nor dimension and are written beside them, so
    the tasks of one fill the cores that the last tasks of the other leave."""
    p = _p(spark, sf_dir)
    r = p.raw
    with ThreadPoolExecutor(1) as beside:
        written = beside.submit(write_and_read, p.silver_prices, "silver_prices")
        inventory = write_and_read(p.silver_inventory, "silver_inventory")
        dim = write_and_read(gold.sku_dimension(r.product_catalog, inventory, p.demand, r.customer_behavior, r.promotions,
                                                r.supplier_cost_changes, r.macro_signals, p.as_of), "sku_dimension")
        prices = written.result()
    features = write_and_read(gold.pricing_features(prices, dim, p.run_ts), "gold_features")
    bronze = {"competitor_prices": (p.bronze_prices, "bronze.competitor_prices_raw"),
              "inventory_events": (p.bronze_inventory, "bronze.inventory_events_raw")}
    raw = [(getattr(r, t), f"raw.{t}", ts, key) for t, ts, key in profile.RAW if t not in bronze]
    return reduce(DataFrame.unionByName, [
        profile.profiles(raw + [
            (prices, "silver.competitor_prices", "_validated_at", "sku_id"),
            (inventory, "silver.inventory", "_validated_at", "sku_id"),
            (features, "gold.gold_pricing_features", "source_event_timestamp", "sku_id"),
            (gold.feature_mart(features), "gold.gold_feature_mart", "source_event_timestamp", "sku_id")]),
        # raw and bronze hold the same rows: one pass for both
        *[profile.profile_two(rows, (f"raw.{t}", "event_timestamp"), (name, "_ingested_at"), "sku_id")
          for t, (rows, name) in bronze.items()]])


def rolling_demand(spark, sf_dir):
    """E1-E3 moved on day by day from sums that are added and taken back; the
    sales of half of the stores arrive two days late."""
    p = _p(spark, sf_dir)
    sales = p.raw.daily_sales
    late = F.when(F.substring("store_id", -1, 1).cast("int") % 2 == 1, 2).otherwise(0)
    sales = write_and_read(sales.withColumn("arrives", F.date_add("sale_date", late)), "sales")
    table = rolling.RollingDemand(spark, run_dir(spark, "rolling"))
    days = [p.as_of - dt.timedelta(days=n) for n in (3, 2, 1)]
    since = F.lit(True)
    for day in days:
        table.advance(sales.where(since & (F.col("arrives") <= F.lit(day))), day)
        since = F.col("arrives") > F.lit(day)
    return table.advance(sales.where(since), p.as_of)


def gold_lookup(spark, sf_dir):
    """The gold table grown by three appends, clustered as it grows; the
    rows of three SKUs from the files whose key range holds them.  The events
    are deduplicated once and wait as they are: only an append makes its gold
    rows, so no wide row is written or read for the other two."""
    p = _p(spark, sf_dir)
    base = run_dir(spark, "clustered")
    events = silver.dedup_prices(p.bronze_prices).select("sku_id", "competitor", "competitor_price", "event_timestamp")
    events = write_and_read(events, "price_events")
    part = F.pmod(F.xxhash64("sku_id", "competitor", "event_timestamp"), F.lit(3))
    for n in range(3):
        features = gold.pricing_features(events.where(part == n), p.sku_dimension, p.run_ts)
        features.write.mode("append").parquet(f"{base}/gold")
        table = runner.cluster_gold(spark, f"{base}/gold", f"{base}/clustered")
    return table.read(["SKU-00003", "SKU-00077", "SKU-00150"])


def profile_files(spark, sf_dir):
    """E6 from per-file states: two raw tables grown by two appends, of which
    the second profile reads the second only."""
    p = _p(spark, sf_dir)
    base = run_dir(spark, "profiles")
    out = None
    for t, ts in (("competitor_prices", "event_timestamp"), ("inventory_events", "event_timestamp")):
        rows, half = getattr(p.raw, t), F.pmod(F.xxhash64("event_id"), F.lit(2))
        for n in range(2):
            rows.where(half == n).write.mode("append").parquet(f"{base}/{t}")
            found = profile.profile_by_file(spark, f"{base}/{t}", schemas.RAW[t], f"{base}/{t}-files", f"raw.{t}", ts)
        out = out.unionByName(found) if out is not None else found
    return out


# --- streaming -------------------------------------------------------------------
SILVER_PRICE_STREAM_COLS = ["event_id", "sku_id", "competitor", "competitor_price", "scrape_url", "event_timestamp",
                            "_ingested_at", "_source", "category", "subcategory", "brand", "unit_cost",
                            "product_name", "_validated_at", "_price_to_cost"]
SILVER_INVENTORY_STREAM_COLS = ["event_id", "sku_id", "event_type", "stock_delta", "stock_after", "warehouse_id",
                                "event_timestamp", "_ingested_at", "_source", "avg_daily_units", "days_of_supply",
                                "current_stock", "_validated_at"]


def _one_payload(raw: DataFrame, deduped: DataFrame, is_valid: Column) -> DataFrame:
    """The raw events with one payload per key, each valid one twice: streaming
    dedup keeps whichever copy arrives first, so all columns can be compared.
    The invalid ones are those the rule doesn't hold for, so no row is compared
    with others to find them, and the copies come from one deduplication."""
    twice = deduped.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    return twice.unionByName(raw.where(~F.coalesce(is_valid, F.lit(False))))


def stream_bronze_silver_prices(spark, sf_dir):
    """Raw landing -> bronze stream -> silver stream (watermark dedup).

    All columns of silver prices, from a source with one payload per key.
    """
    p = _p(spark, sf_dir)
    base = run_dir(spark, "prices")
    raw = p.raw.competitor_prices
    runner.land(_one_payload(raw, silver.dedup_prices(raw), silver.price_is_valid()), f"{base}/landing")
    runner.bronze_job(spark, f"{base}/landing", "competitor_prices", f"{base}/bronze",
                      f"{base}/_chk/bronze", p.run_ts)
    runner.silver_prices_job(spark, f"{base}/bronze", p.raw.product_catalog, f"{base}/silver",
                             f"{base}/_chk/silver", p.run_ts)
    return runner.read_table(spark, f"{base}/silver").select(*SILVER_PRICE_STREAM_COLS)


def stream_silver_inventory(spark, sf_dir):
    p = _p(spark, sf_dir)
    base = run_dir(spark, "inventory")
    raw = p.raw.inventory_events
    runner.land(_one_payload(raw, silver.dedup_inventory(raw), silver.inventory_is_valid()), f"{base}/landing")
    runner.bronze_job(spark, f"{base}/landing", "inventory_events", f"{base}/bronze",
                      f"{base}/_chk/bronze", p.run_ts)
    runner.silver_inventory_job(spark, f"{base}/bronze", p.velocity, f"{base}/silver",
                                f"{base}/_chk/silver", p.run_ts)
    return runner.read_table(spark, f"{base}/silver").select(*SILVER_INVENTORY_STREAM_COLS)


def stream_late_data(spark, sf_dir):
    """Two runs with one checkpoint.  The first lands the price events of
    odd line numbers, the second the others, of which all at or behind the
    watermark are dropped as late; the keys of what is kept."""
    p = _p(spark, sf_dir)
    base = run_dir(spark, "late")
    bronze = p.bronze_prices
    odd = F.substring("event_id", -1, 1).cast("int") % 2 == 1
    for rows in (bronze.filter(odd), bronze.filter(~odd)):
        rows.write.mode("append").parquet(f"{base}/bronze")
        runner.silver_prices_job(spark, f"{base}/bronze", p.raw.product_catalog, f"{base}/silver", f"{base}/_chk", p.run_ts)
    return runner.read_table(spark, f"{base}/silver").select(*silver.PRICE_KEYS)


def stream_gold(spark, sf_dir):
    """Silver directory -> gold streaming table (stream x static dimension)."""
    p = _p(spark, sf_dir)
    base = run_dir(spark, "gold")
    p.silver_prices.write.parquet(f"{base}/silver")
    runner.gold_job(spark, f"{base}/silver", p.sku_dimension, f"{base}/gold", f"{base}/_chk/gold",
                    p.run_ts)
    return runner.read_table(spark, f"{base}/gold")


def stream_feature_mart(spark, sf_dir):
    """Gold streaming table -> mart, merged over three appends (A7).  The events
    are deduplicated once and wait as they are; each append enriches its own."""
    p = _p(spark, sf_dir)
    base = run_dir(spark, "mart")
    events = write_and_read(silver.dedup_prices(p.bronze_prices), "price_events")
    lookup = write_and_read(silver.catalog_lookup(p.raw.product_catalog), "catalog_lookup")
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for n in range(3):
        silver_rows = silver.enrich_prices(events.where(part == n), lookup, p.run_ts)
        silver_rows.write.mode("append").parquet(f"{base}/silver")
        runner.gold_job(spark, f"{base}/silver", p.sku_dimension, f"{base}/gold", f"{base}/_chk/gold", p.run_ts)
        mart = runner.refresh_mart(spark, f"{base}/gold", f"{base}/mart", f"{base}/_chk/mart")
    return mart


def stream_hot_prices(spark, sf_dir):
    """I2 + I5 + A5 on skewed events: a third of the price events are copies of
    one event, another third are one SKU's; the backlog is admitted in slices
    of event time, copies and the hot SKU are spread over tasks."""
    p = _p(spark, sf_dir)
    base = run_dir(spark, "hot")
    third = "CAST(substring(event_id, -1, 1) AS INT) % 3"
    day = p.as_of.isoformat()
    events = p.raw.competitor_prices.selectExpr(
        "event_id",
        f"CASE WHEN {third} < 2 THEN 'SKU-00001' ELSE sku_id END AS sku_id",
        f"CASE WHEN {third} = 0 THEN 'C0' ELSE competitor END AS competitor",
        f"CASE WHEN {third} = 0 THEN 10.0D ELSE competitor_price END AS competitor_price",
        "scrape_url",
        f"CASE WHEN {third} = 0 THEN TIMESTAMP '{day} 00:00:00' WHEN {third} = 1 THEN "
        "timestampadd(SECOND, CAST(split(event_id, '-')[1] AS INT) % 86400, event_timestamp) ELSE event_timestamp END AS event_timestamp")
    runner.land(events, f"{base}/landing")
    declared = schemas.bronze_schema(schemas.COMPETITOR_PRICES)
    runner.bronze_job(spark, f"{base}/landing", "competitor_prices", f"{base}/bronze", f"{base}/_chk/bronze", p.run_ts)
    runner.admit(spark, f"{base}/bronze", declared, f"{base}/admitted", 3, lambda: runner.silver_prices_job(
        spark, f"{base}/admitted", p.raw.product_catalog, f"{base}/silver", f"{base}/_chk/silver", p.run_ts, skew.SALTS))
    return runner.read_table(spark, f"{base}/silver").select(*silver.PRICE_KEYS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_prices": bronze_prices,
    "bronze_inventory": bronze_inventory,
    "silver_prices": silver_prices,
    "silver_inventory": silver_inventory,
    "demand_window": demand_window,
    "supplier_pressure": supplier_pressure,
    "macro_trailing": macro_trailing,
    "latest_inventory": latest_inventory,
    "best_promo": best_promo,
    "sku_dimension": sku_dimension,
    "gold_features": gold_features,
    "feature_mart": feature_mart,
    "mart_clustered": mart_clustered,
    "elasticity": elasticity,
    "price_flags": price_flags,
    "action_counts": action_counts,
    "top_flags": top_flags,
    "sample_skus": sample_skus,
    "mart_preview": mart_preview,
    "recommendations_table": recommendations_table,
    "price_target": price_target,
    "price_target_noisy": price_target_noisy,
    "target_summary": target_summary,
    "score_compare": score_compare,
    "score_summary": score_summary,
    "model_metrics": model_metrics,
    "table_profile": table_profile,
    "rolling_demand": rolling_demand,
    "gold_lookup": gold_lookup,
    "profile_files": profile_files,
    "stream_bronze_silver_prices": stream_bronze_silver_prices,
    "stream_silver_inventory": stream_silver_inventory,
    "stream_late_data": stream_late_data,
    "stream_gold": stream_gold,
    "stream_feature_mart": stream_feature_mart,
    "stream_hot_prices": stream_hot_prices,
    "gbt_score_compare": gbt_score_compare,
    "gbt_metrics": gbt_metrics,
    "gbt_checks": gbt_checks,
    "gbt_score_summary": gbt_score_summary,
}

# Queries whose values depend on a fitted model: checked by rows only.
NO_ORACLE = {"gbt_score_compare", "gbt_metrics", "gbt_score_summary"}

__all__ = ["QUERIES", "NO_ORACLE"]
