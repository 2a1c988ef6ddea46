"""Explicit schemas for the eight raw tables and the derived layers.

File streams need a fixed schema, and an explicit schema also keeps batch reads
from inferring anything.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()
TS, DT = T.TimestampType(), T.DateType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PRODUCT_CATALOG = _schema(
    ("sku_id", S), ("product_name", S), ("category", S), ("subcategory", S),
    ("product_type", S), ("brand", S), ("unit_cost", D), ("weight_lbs", D),
    ("is_active", B), ("lead_time_days", L), ("supplier_id", S), ("created_date", S))

INVENTORY_EVENTS = _schema(
    ("event_id", S), ("sku_id", S), ("event_type", S), ("stock_delta", L),
    ("stock_after", L), ("warehouse_id", S), ("event_timestamp", TS))

COMPETITOR_PRICES = _schema(
    ("event_id", S), ("sku_id", S), ("competitor", S), ("competitor_price", D),
    ("scrape_url", S), ("event_timestamp", TS))

DAILY_SALES = _schema(
    ("sku_id", S), ("sale_date", DT), ("units_sold", L), ("revenue", D),
    ("store_id", S), ("seasonality_index", D))

CUSTOMER_BEHAVIOR = _schema(
    ("sku_id", S), ("view_count", L), ("cart_add_rate", D), ("conversion_rate", D),
    ("return_rate", D), ("avg_session_time_sec", L), ("snapshot_date", DT))

PROMOTIONS = _schema(
    ("promo_id", S), ("sku_id", S), ("promo_type", S), ("discount_pct", D),
    ("start_date", DT), ("end_date", DT), ("is_active", B), ("created_by", S))

SUPPLIER_COST_CHANGES = _schema(
    ("event_id", S), ("sku_id", S), ("supplier_id", S), ("cost_delta_pct", D),
    ("reason", S), ("event_timestamp", TS))

MACRO_SIGNALS = _schema(
    ("signal_week", DT), ("ppi_steel", D), ("ppi_copper", D), ("ppi_pvc", D),
    ("source", S))

RAW = {
    "product_catalog": PRODUCT_CATALOG,
    "inventory_events": INVENTORY_EVENTS,
    "competitor_prices": COMPETITOR_PRICES,
    "daily_sales": DAILY_SALES,
    "customer_behavior": CUSTOMER_BEHAVIOR,
    "promotions": PROMOTIONS,
    "supplier_cost_changes": SUPPLIER_COST_CHANGES,
    "macro_signals": MACRO_SIGNALS,
}

BRONZE_EXTRA = [("_ingested_at", TS), ("_source", S)]


def bronze_schema(raw: T.StructType) -> T.StructType:
    return T.StructType(list(raw.fields) + [T.StructField(n, t, True) for n, t in BRONZE_EXTRA])


SILVER_PRICES = T.StructType(
    list(bronze_schema(COMPETITOR_PRICES).fields) + [
        T.StructField(n, t, True) for n, t in (
            ("category", S), ("subcategory", S), ("brand", S), ("unit_cost", D),
            ("product_name", S), ("_validated_at", TS), ("_price_to_cost", D))])

SILVER_INVENTORY = T.StructType(
    list(bronze_schema(INVENTORY_EVENTS).fields) + [
        T.StructField(n, t, True) for n, t in (
            ("avg_daily_units", D), ("days_of_supply", D), ("current_stock", L),
            ("_validated_at", TS))])

GOLD_FEATURES = _schema(
    ("sku_id", S), ("product_name", S), ("category", S), ("subcategory", S), ("brand", S), ("supplier_id", S),
    ("unit_cost", D), ("weight_lbs", D), ("competitor", S), ("competitor_price", D), ("competitor_markup", D),
    ("current_stock", L), ("days_of_supply", D), ("units_sold_7d", L), ("units_sold_30d", L), ("avg_daily_units", D),
    ("seasonality_index", D), ("view_count", L), ("cart_add_rate", D), ("conversion_rate", D), ("return_rate", D),
    ("discount_pct", D), ("promo_type", S), ("cost_delta_pct", D), ("ppi_steel", D), ("ppi_copper", D), ("ppi_pvc", D),
    ("current_price", D), ("source_event_timestamp", TS), ("_updated_at", TS))


# --- test-data inputs (TPC-H-like files under /root/testdata/sf*/) -------------
# Declared so reads skip schema inference (one footer-reading job per read).
I, NTZ = T.IntegerType(), T.TimestampNTZType()

TESTDATA = {
    "part": _schema(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S),
                    ("p_size", I), ("p_retailprice", D)),
    "lineitem": _schema(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                        ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", NTZ)),
    "orders": _schema(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                      ("o_orderdate", NTZ), ("o_orderpriority", S)),
    "events": _schema(("event_id", L), ("ts", NTZ), ("user_id", L), ("event_type", S),
                      ("value", D), ("props", S)),
}
