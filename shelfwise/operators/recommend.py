"""Recommendations over the feature mart: elasticity (J2), price flags (J3),
price-change signals (J4), their summaries (E7, E8) and listings (G1, G2).

All of it is narrow column work or a single aggregate over the mart; nothing
is brought to the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import pricing
from .bronze import stamp


def with_elasticity(mart: DataFrame) -> DataFrame:
    """J2 per SKU."""
    return mart.select("sku_id", "conversion_rate", "avg_daily_units",
                       pricing.elasticity_score().alias("elasticity_score"))


def price_flags(mart: DataFrame, target_gm: float = config.TARGET_GM,
                raise_threshold: float = config.RAISE_THRESHOLD,
                disc_threshold: float = config.DISC_THRESHOLD,
                run_ts: dt.datetime | None = None,
                model_version: str = config.MODEL_VERSION) -> DataFrame:
    """J3 + B12: one recommendation row per SKU."""
    cols = pricing.flag_columns(target_gm, raise_threshold, disc_threshold)
    return mart.select(
        "sku_id", cols["action"].alias("action"),
        cols["elasticity_score"].alias("elasticity_score"),
        cols["margin_gap_pct"].alias("margin_gap_pct"),
        cols["current_gm_pct"].alias("current_gm_pct"),
        cols["comp_gap_pct"].alias("comp_gap_pct"),
        cols["rationale"].alias("rationale"),
        stamp(run_ts).alias("generated_at"),
        F.lit(model_version).alias("model_version"))


def action_counts(flags: DataFrame) -> DataFrame:
    """Number of SKUs per action."""
    return flags.groupBy("action").agg(F.count(F.lit(1)).alias("count"))


def top_flags(flags: DataFrame, n: int = 20) -> DataFrame:
    """First n flags by (action, margin_gap_pct); sku_id breaks ties.

    A top-k report: planned as TakeOrderedAndProject (k rows per partition).
    """
    return flags.orderBy("action", "margin_gap_pct", "sku_id").limit(n)


def sample_skus(mart: DataFrame, n: int = 10, seed: int = config.SAMPLE_SEED) -> DataFrame:
    """G1 + G3: a reproducible pseudo-random sample of n SKUs.

    Ordering by md5(seed || sku_id) gives the same sample on any cluster
    layout (``rand(seed)`` depends on the partitioning).
    """
    cols = ["sku_id", "product_name", "category", "brand", "unit_cost", "current_price",
            "competitor_price", "units_sold_7d", "days_of_supply"]
    key = F.md5(F.concat(F.lit(str(seed)), F.col("sku_id")))
    return mart.select(*cols, key.alias("_k")).orderBy("_k", "sku_id").limit(n).drop("_k")


def score_compare(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Current vs recommended price per SKU, for every mart row."""
    rec = F.round(F.col(prediction), 2)
    delta = F.round(pricing.safe_ratio(F.col("recommended_price") - F.col("current_price"),
                                       "current_price") * 100, 1)
    return (scored
            .select("sku_id", "product_name", "category", "unit_cost", "current_price",
                    "competitor_price", "units_sold_7d", rec.alias("recommended_price"))
            .withColumn("delta_pct", delta)
            .withColumn("signal", pricing.signal("delta_pct"))
            .withColumn("current_gm_pct", pricing.gm_pct("current_price"))
            .withColumn("recommended_gm_pct", pricing.gm_pct("recommended_price")))


def score_summary(compare: DataFrame) -> DataFrame:
    """Totals and averages of a score comparison in one aggregate."""
    d = F.col("delta_pct")
    cut = config.SIGNAL_CUTOFF_PCT
    return compare.agg(
        F.count(F.lit(1)).alias("total_skus"),
        F.count_if(d > cut).alias("raise_count"),
        F.count_if(F.abs(d) <= cut).alias("hold_count"),
        F.count_if(d < -cut).alias("discount_count"),
        F.round(F.avg(F.when(d > cut, d)), 6).alias("avg_delta_raise"),
        F.round(F.avg(F.when(d < -cut, d)), 6).alias("avg_delta_discount"),
        F.round(F.avg("current_gm_pct"), 6).alias("avg_gm_now"),
        F.round(F.avg("recommended_gm_pct"), 6).alias("avg_gm_recommended"),
        F.round(F.avg("recommended_gm_pct") - F.avg("current_gm_pct"), 6).alias("gm_change_pts"))
