"""Gold layer: per-event pricing features (D3-D8) and the per-SKU mart.

Plan shape.  The feature row joins each silver price event to seven SKU-level
inputs.  All of them have at most one row per SKU, so they are first joined to
the product catalog into ONE SKU dimension (``sku_dimension``): those joins run
between SKU-sized, already sku-partitioned aggregates, and the large event
side meets a single dimension in a single join — broadcast when AQE measures
the written dimension as small, a shuffle join with AQE skew splitting
otherwise.  The result is identical to joining the event side seven
times, because every right side is unique per SKU (a duplicate would fan out
the same way in both forms).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import pricing
from . import skew
from .bronze import stamp, ts_literal
from .silver import unique_catalog
from .unique import one_per_key

DOUBLE_AVG_SCALE = 6   # averages of doubles are kept to 6 decimals (engine-independent)


def _avg6(c: str):
    return F.round(F.avg(c), DOUBLE_AVG_SCALE)


def _days_back(as_of: dt.date, days: int):
    return F.date_sub(F.lit(as_of), days)


def _midnight(day: dt.date):
    return ts_literal(dt.datetime.combine(day, dt.time()))


# --- F1 ----------------------------------------------------------------------
def latest_inventory(silver_inventory: DataFrame) -> DataFrame:
    """F1 + C5: latest silver inventory row per SKU (ties: event_id)."""
    order = [F.col("event_timestamp").desc(), F.col("event_id").asc()]
    rows = silver_inventory.select("sku_id", "event_timestamp", "event_id", "current_stock", "days_of_supply")
    return one_per_key(rows, "sku_id", order).select("sku_id", "current_stock", "days_of_supply")


def latest_stock(deduped: DataFrame) -> DataFrame:
    """The latest of deduplicated inventory events per SKU (a map-side top-1)."""
    order = [F.col("event_timestamp").desc(), F.col("event_id").asc()]
    rows = deduped.select("sku_id", "event_timestamp", "event_id", F.col("stock_after").alias("current_stock"))
    return one_per_key(rows, "sku_id", order).select("sku_id", "current_stock")


def latest_inventory_of_events(deduped: DataFrame, velocity: DataFrame) -> DataFrame:
    """:func:`latest_inventory` from deduplicated events: the latest per SKU
    first, then the velocity join at SKU grain, so neither step sees a hot
    SKU's events together."""
    return latest_stock(deduped).join(velocity, "sku_id", "left").select(
        "sku_id", "current_stock", pricing.days_of_supply("current_stock", "avg_daily_units").alias("days_of_supply"))


# --- E1-E3 ---------------------------------------------------------------------
def demand_window(daily_sales: DataFrame, as_of: dt.date) -> DataFrame:
    """C3 + E1-E3: 7/30-day units, mean units per sales row, mean seasonality.

    Windows are [as_of - n days, as_of], both ends inclusive.
    """
    d = F.col("sale_date")
    recent = d >= _days_back(as_of, config.DEMAND_SHORT_DAYS)
    return (daily_sales
            .filter((d >= _days_back(as_of, config.DEMAND_LONG_DAYS)) & (d <= F.lit(as_of)))
            .groupBy("sku_id")
            .agg(F.sum(F.when(recent, F.col("units_sold"))).alias("units_sold_7d"),
                 F.sum("units_sold").alias("units_sold_30d"),
                 F.avg("units_sold").alias("avg_daily_units"),
                 _avg6("seasonality_index").alias("seasonality_index")))


# --- F2 ------------------------------------------------------------------------
def best_promo(promotions: DataFrame) -> DataFrame:
    """C4 + F2: highest active discount per SKU (ties: promo_type, promo_id)."""
    order = [F.col("discount_pct").desc(), F.col("promo_type").asc(), F.col("promo_id").asc()]
    rows = promotions.filter(F.col("is_active")).select("sku_id", "discount_pct", "promo_type", "promo_id")
    return one_per_key(rows, "sku_id", order).select("sku_id", "discount_pct", "promo_type")


# --- E4 ------------------------------------------------------------------------
def supplier_pressure(supplier_cost_changes: DataFrame, as_of: dt.date) -> DataFrame:
    """C3 + E4: mean cost delta per SKU over the trailing 90 days."""
    ts = F.col("event_timestamp")
    # calendar-day bounds in wall-clock time (immune to DST in the session zone);
    # the events of as_of itself count, like its sales
    start = _midnight(as_of - dt.timedelta(days=config.SUPPLIER_WINDOW_DAYS))
    return (supplier_cost_changes
            .filter((ts >= start) & (ts < _midnight(as_of + dt.timedelta(days=1))))
            .groupBy("sku_id")
            .agg(_avg6("cost_delta_pct").alias("cost_delta_pct")))


# --- E5 ------------------------------------------------------------------------
def macro_trailing(macro_signals: DataFrame, as_of: dt.date) -> DataFrame:
    """C3 + E5: one-row trailing-28-day mean of the three PPI series."""
    wk = F.col("signal_week")
    return (macro_signals
            .filter((wk >= _days_back(as_of, config.MACRO_WINDOW_DAYS)) & (wk <= F.lit(as_of)))
            .agg(_avg6("ppi_steel").alias("ppi_steel"),
                 _avg6("ppi_copper").alias("ppi_copper"),
                 _avg6("ppi_pvc").alias("ppi_pvc")))


def customer_engagement(customer_behavior: DataFrame) -> DataFrame:
    """The latest behaviour snapshot per SKU (ties: by all values)."""
    values = ["view_count", "cart_add_rate", "conversion_rate", "return_rate"]
    order = [F.col("snapshot_date").desc_nulls_last(), *[F.col(c).asc() for c in values]]
    return one_per_key(customer_behavior.select("sku_id", "snapshot_date", *values), "sku_id", order).drop("snapshot_date")


# --- the SKU dimension (D3-D7 right sides, B7, B8) ------------------------------
def sku_dimension(catalog: DataFrame, silver_inventory: DataFrame, *rest) -> DataFrame:
    """:func:`sku_dimension_of` over a silver inventory table."""
    return sku_dimension_of(catalog, latest_inventory(silver_inventory), *rest)


def sku_dimension_of(catalog: DataFrame, inventory: DataFrame, demand: DataFrame,
                     customer_behavior: DataFrame, promotions: DataFrame,
                     supplier_cost_changes: DataFrame, macro_signals: DataFrame,
                     as_of: dt.date) -> DataFrame:
    """One row per catalog SKU with every non-competitor feature filled in:
    each side is made unique per SKU, whatever its table holds.

    ``inventory`` is the output of :func:`latest_inventory`, or that of
    :func:`latest_stock`, whose days of supply are then taken from ``demand``,
    the output of :func:`demand_window`.
    """
    # D6, the one-row PPI aggregate, attached as a scalar subquery (a struct)
    macro = macro_trailing(macro_signals, as_of).select(
        F.struct("ppi_steel", "ppi_copper", "ppi_pvc").alias("m")).scalar()
    dim = (unique_catalog(catalog).select("sku_id", "product_name", "category", "subcategory", "brand",
                          "supplier_id", "unit_cost", "weight_lbs")
           .join(inventory, "sku_id", "left")
           .join(demand, "sku_id", "left")
           .join(customer_engagement(customer_behavior), "sku_id", "left")
           .join(best_promo(promotions), "sku_id", "left")
           .join(supplier_pressure(supplier_cost_changes, as_of), "sku_id", "left")
           .withColumn("_macro", macro))
    if "days_of_supply" not in dim.columns:
        dim = dim.withColumn("days_of_supply", pricing.days_of_supply("current_stock", "avg_daily_units"))
    # B8 defaults (one SQL projection: a single driver round trip)
    return dim.selectExpr(
        "sku_id", "product_name", "category", "subcategory", "brand", "supplier_id",
        "unit_cost", "weight_lbs",
        "coalesce(current_stock, 0L) AS current_stock",
        "coalesce(days_of_supply, -1.0D) AS days_of_supply",
        "coalesce(units_sold_7d, 0L) AS units_sold_7d",
        "coalesce(units_sold_30d, 0L) AS units_sold_30d",
        "coalesce(avg_daily_units, 0.0D) AS avg_daily_units",
        "coalesce(seasonality_index, 1.0D) AS seasonality_index",
        "coalesce(view_count, 0L) AS view_count",
        "coalesce(cart_add_rate, 0.0D) AS cart_add_rate",
        "coalesce(conversion_rate, 0.0D) AS conversion_rate",
        "coalesce(return_rate, 0.0D) AS return_rate",
        "coalesce(discount_pct, 0.0D) AS discount_pct",
        "coalesce(promo_type, 'NONE') AS promo_type",
        "coalesce(cost_delta_pct, 0.0D) AS cost_delta_pct",
        "coalesce(_macro.ppi_steel, 100.0D) AS ppi_steel",
        "coalesce(_macro.ppi_copper, 100.0D) AS ppi_copper",
        "coalesce(_macro.ppi_pvc, 100.0D) AS ppi_pvc",
        f"round(unit_cost * {config.SHELF_MARKUP}D, 2) AS current_price")


# --- D8: the feature row ------------------------------------------------------------
def pricing_features(silver_prices: DataFrame, dim: DataFrame, run_ts: dt.datetime | None = None,
                     hot: list[str] | None = None, salts: int = 0) -> DataFrame:
    """Valid, deduplicated price events (batch or stream) x SKU dimension -> 30
    gold columns.  The dimension holds exactly the catalog's SKUs, so events
    need no catalog join before this one.  A stream names its ``hot`` SKUs; in
    a batch Spark splits them by itself."""
    events = silver_prices.select("sku_id", "competitor", "competitor_price", "event_timestamp")
    joined = skew.salted_join(events, dim, "sku_id", hot or [], ["sku_id", "competitor", "event_timestamp"], salts=salts)
    return joined.select(
        "sku_id", "product_name", "category", "subcategory", "brand", "supplier_id",
        "unit_cost", "weight_lbs", "competitor", "competitor_price",
        pricing.price_to_cost("competitor_price", "unit_cost").alias("competitor_markup"),
        "current_stock", "days_of_supply", "units_sold_7d", "units_sold_30d",
        "avg_daily_units", "seasonality_index", "view_count", "cart_add_rate",
        "conversion_rate", "return_rate", "discount_pct", "promo_type", "cost_delta_pct",
        "ppi_steel", "ppi_copper", "ppi_pvc", "current_price",
        F.col("event_timestamp").alias("source_event_timestamp"),
        stamp(run_ts).alias("_updated_at")).select(*config.GOLD_COLUMNS)


# --- F3: the mart -----------------------------------------------------------------
def mart_order():
    return [F.col("source_event_timestamp").desc(), F.col("_updated_at").desc(),
            F.col("competitor").asc(), F.col("competitor_price").asc()]


def feature_mart(features: DataFrame) -> DataFrame:
    """F3 + B4: latest feature row per SKU (most recently scraped competitor).

    ``rn = 1`` is planned as a partial WindowGroupLimit before the shuffle, so a
    SKU holding a large share of the events is reduced on the map side.
    """
    w = Window.partitionBy("sku_id").orderBy(*mart_order())
    return (features.withColumn("row_num", F.row_number().over(w))
            .filter(F.col("row_num") == 1)
            .drop("row_num"))


def latest_price_events(silver_prices: DataFrame) -> DataFrame:
    """F3 pushed below the feature join: the latest price event per SKU.

    Within one batch run ``_updated_at`` is the same for every row, so the
    mart order reduces to (event time desc, competitor, price).  Only the four
    event columns are shuffled, after a map-side top-1 (partial
    WindowGroupLimit), so a SKU holding a third of the events costs one row
    per map task.
    """
    order = [F.col("event_timestamp").desc(), F.col("competitor").asc(), F.col("competitor_price").asc()]
    rows = silver_prices.select("sku_id", "competitor", "competitor_price", "event_timestamp")
    return one_per_key(rows, "sku_id", order)


def feature_mart_batch(silver_prices: DataFrame, dim: DataFrame,
                       run_ts: dt.datetime | None = None) -> DataFrame:
    """The mart of one batch run: latest event per SKU, then the SKU join.

    Same rows as ``feature_mart(pricing_features(silver_prices, dim))`` —
    the dimension join is one-to-one per SKU — but the join sees one row per
    SKU instead of every event, and no window runs over 30-column rows.
    """
    return pricing_features(latest_price_events(silver_prices), dim, run_ts)


def clustered(df: DataFrame, key: str = "sku_id") -> DataFrame:
    """Range-partition and sort by key before a write (min/max skipping).

    Meant for tables with one row per key (mart, recommendations): range
    partitioning cannot split rows that share a key.
    """
    return df.repartitionByRange(key).sortWithinPartitions(key)
