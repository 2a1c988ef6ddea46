"""Price-target label (J1) and its distribution summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pricing
from ..functions.quantiles import exact_quantiles
from .joins import materialize

QUARTILES = [0.25, 0.5, 0.75]


def with_price_target(mart: DataFrame, label: str = "optimal_price", noise: bool = False) -> DataFrame:
    """Add the synthetic optimal-price label to every mart row."""
    return mart.withColumn(label, pricing.price_target(noise=noise))


def price_target_rows(mart: DataFrame) -> DataFrame:
    """The label with the inputs that drive it (one row per SKU)."""
    return with_price_target(mart).select(
        "sku_id", "unit_cost", "competitor_price", "avg_daily_units", "days_of_supply",
        "discount_pct", "optimal_price")


def target_summary(labelled: DataFrame, label: str = "optimal_price") -> DataFrame:
    """Count, mean, std, min, quartiles, max of the label, rounded to 2.

    The label column is computed once (checkpointed); one aggregate pass and
    the exact distributed quartiles both read it.  One output row.
    """
    labelled = materialize(labelled.select(label))
    basic = labelled.agg(
        F.count(label).alias("count"),
        F.round(F.avg(label), 2).alias("mean"),
        F.round(F.stddev_samp(label), 2).alias("std"),
        F.round(F.min(label), 2).alias("min"),
        F.round(F.max(label), 2).alias("max"))
    q = exact_quantiles(labelled, label, QUARTILES)
    quartiles = q.agg(F.struct(*[
        F.round(F.max(F.when(F.col("p") == p, F.col("value"))), 2).alias(name)
        for p, name in zip(QUARTILES, ["p25", "p50", "p75"])])).scalar()
    return (basic.withColumn("_q", quartiles)
            .select("count", "mean", "std", "min", "_q.p25", "_q.p50", "_q.p75", "max"))
