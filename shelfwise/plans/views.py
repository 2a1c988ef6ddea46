"""Expose every layer of a pipeline run as a temporary view, so SQL written
against the pricing tables runs unchanged through ``spark.sql``."""

from __future__ import annotations

from .pipeline import PricingPipeline

RAW_TABLES = ["product_catalog", "competitor_prices", "inventory_events", "daily_sales",
              "customer_behavior", "promotions", "supplier_cost_changes", "macro_signals"]


def register_views(p: PricingPipeline) -> list[str]:
    """Create or replace one temp view per table; returns the view names."""
    views = {name: getattr(p.raw, name) for name in RAW_TABLES}
    views.update({
        "competitor_prices_raw": p.bronze_prices,
        "inventory_events_raw": p.bronze_inventory,
        "silver_competitor_prices": p.silver_prices,
        "silver_inventory": p.silver_inventory,
        "gold_pricing_features": p.gold_features,
        "gold_feature_mart": p.feature_mart,
        "pricing_recommendations": p.price_flags,
    })
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
