"""Stand-in adapters: shape the TPC-H-like test tables into the eight raw
pricing tables (product_catalog, competitor_prices, inventory_events,
daily_sales, customer_behavior, promotions, supplier_cost_changes,
macro_signals).

Every adapter is a lazy DataFrame over the parquet files, so Catalyst prunes
columns and pushes the flag predicates into the scans; nothing is
collected.  The formulas only have to give the pipeline realistic shapes and
reach every branch of its rules; they are mirrored in SQL by
``shelfwise.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from . import schemas


def _reader(spark: SparkSession, path: str) -> DataFrame:
    table = path.rsplit("/", 1)[-1].removesuffix(".parquet")
    schema = schemas.TESTDATA.get(table)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def _read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    return _reader(spark, f"{sf_dir}/{table}.parquet").select(*cols)


def _lineitem(spark, sf_dir, *cols):
    return _read(spark, sf_dir, "lineitem", *cols)


# Projections are SQL expression strings (``selectExpr``): one driver round
# trip per projection instead of several per Column object.
# 'SKU-' + zero-padded key (never truncated for keys over 5 digits); the formatter, many times slower than a
# padded cast, makes only those of negative and null keys
SKU = ("coalesce(CASE WHEN {0} BETWEEN 0 AND 99999 THEN concat('SKU-', lpad(CAST({0} AS STRING), 5, '0'))"
       " WHEN {0} > 99999 THEN concat('SKU-', CAST({0} AS STRING))"
       " WHEN {0} < 0 THEN format_string('SKU-%05d', {0}) END, format_string('SKU-%05d', CAST(NULL AS BIGINT)))")


def _id(prefix: str) -> str:
    return f"concat('{prefix}-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))"


def _conform(df: DataFrame, table: str) -> DataFrame:
    """Project to the declared raw schema (order, types, missing -> NULL)."""
    have = set(df.columns)
    return df.selectExpr(*[
        f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in schemas.RAW[table].fields])


def product_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type",
                 "p_size", "p_retailprice")
    df = part.selectExpr(
        f"{SKU.format('p_partkey')} AS sku_id",
        "p_name AS product_name",
        "p_type AS category",
        "concat(p_type, '-', CAST(p_size % 3 AS STRING)) AS subcategory",
        "p_type AS product_type",
        "p_brand AS brand",
        "p_retailprice * (1 + p_size) / 100 AS unit_cost",
        "p_size * 0.5D AS weight_lbs",
        "TRUE AS is_active",
        "concat('SUP-', lpad(CAST(p_partkey % 30 + 1 AS STRING), 3, '0')) AS supplier_id")
    return _conform(df, "product_catalog")


def competitor_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lineitem(spark, sf_dir, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                   "l_quantity", "l_discount", "l_shipdate")
    part = _read(spark, sf_dir, "part", "p_partkey", "p_retailprice", "p_size")
    # quantity 1 / 2 produce out-of-range prices for the validation filter
    df = li.join(part, li.l_partkey == part.p_partkey, "inner").selectExpr(
        f"{_id('CP')} AS event_id",
        f"{SKU.format('l_partkey')} AS sku_id",
        "concat('C', CAST(l_suppkey % 5 AS STRING)) AS competitor",
        "p_retailprice * (1 + p_size) / 100 * (1.2D + 4 * l_discount)"
        " * CASE WHEN l_quantity = 1 THEN -1.0D WHEN l_quantity = 2 THEN 1000.0D ELSE 1.0D END"
        " AS competitor_price",
        "CAST(l_shipdate AS TIMESTAMP) AS event_timestamp")
    return _conform(df, "competitor_prices")


def inventory_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = (_lineitem(spark, sf_dir, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    "l_quantity", "l_returnflag", "l_shipdate")
          .filter("l_returnflag <> 'R'"))
    df = li.selectExpr(
        f"{_id('IE')} AS event_id",
        f"{SKU.format('l_partkey')} AS sku_id",
        "CASE WHEN l_returnflag = 'A' THEN 'restock' ELSE 'sale' END AS event_type",
        "CAST(l_quantity AS BIGINT) AS stock_delta",
        "CAST(l_quantity * 10 - 20 AS BIGINT) AS stock_after",
        "concat('WH-0', CAST(l_suppkey % 5 + 1 AS STRING)) AS warehouse_id",
        "CAST(l_shipdate AS TIMESTAMP) AS event_timestamp")
    return _conform(df, "inventory_events")


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lineitem(spark, sf_dir, "l_partkey", "l_suppkey", "l_quantity",
                   "l_extendedprice", "l_shipdate")
    df = li.selectExpr(
        f"{SKU.format('l_partkey')} AS sku_id",
        "to_date(l_shipdate) AS sale_date",
        "CAST(l_quantity AS BIGINT) AS units_sold",
        "l_extendedprice AS revenue",
        "concat('ST-', lpad(CAST(l_suppkey % 12 + 1 AS STRING), 2, '0')) AS store_id",
        "CASE WHEN month(l_shipdate) IN (4, 5, 6, 7) THEN 1.3D"
        " WHEN month(l_shipdate) IN (11, 12, 1) THEN 0.85D ELSE 1.0D END AS seasonality_index")
    return _conform(df, "daily_sales")


def customer_behavior(spark: SparkSession, sf_dir: str, as_of: dt.date = config.AS_OF) -> DataFrame:
    ev = _read(spark, sf_dir, "events", "user_id", "event_type")
    users = ev.groupBy("user_id").agg(
        F.expr("count_if(event_type = 'view') AS views"),
        F.expr("count_if(event_type = 'click') AS clicks"),
        F.expr("count_if(event_type = 'purchase') AS purchases"),
        F.expr("count_if(event_type = 'error') AS errors"),
        F.expr("count(1) AS n_events"))
    # number of user slots: a scalar subquery over the (one-row) aggregate
    n_slots = users.selectExpr("max(user_id) + 1 AS n_slots").scalar()
    part = (_read(spark, sf_dir, "part", "p_partkey")
            .select("p_partkey", (F.col("p_partkey") % n_slots).alias("slot")))
    df = part.join(users, part.slot == users.user_id, "inner").selectExpr(
        f"{SKU.format('p_partkey')} AS sku_id",
        "views AS view_count",
        "clicks / n_events AS cart_add_rate",
        # a third of the SKUs convert rarely, so that every price action occurs
        "purchases / n_events * CASE WHEN p_partkey % 3 = 0 THEN 0.2D ELSE 1.0D END AS conversion_rate",
        "errors / n_events AS return_rate",
        f"DATE '{as_of.isoformat()}' AS snapshot_date")
    return _conform(df, "customer_behavior")


def promotions(spark: SparkSession, sf_dir: str, as_of: dt.date = config.AS_OF) -> DataFrame:
    li = (_lineitem(spark, sf_dir, "l_orderkey", "l_linenumber", "l_partkey",
                    "l_discount", "l_returnflag", "l_shipdate")
          .filter("l_returnflag = 'A'"))
    day = f"DATE '{as_of.isoformat()}'"
    df = li.selectExpr(
        f"{_id('PR')} AS promo_id",
        f"{SKU.format('l_partkey')} AS sku_id",
        "concat('PROMO-', CAST(l_linenumber % 5 AS STRING)) AS promo_type",
        "l_discount + 0.05D AS discount_pct",
        "to_date(l_shipdate) AS start_date",
        "date_add(to_date(l_shipdate), 30) AS end_date",
        f"to_date(l_shipdate) <= {day} AND {day} <= date_add(to_date(l_shipdate), 30) AS is_active")
    return _conform(df, "promotions")


def supplier_cost_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = (_lineitem(spark, sf_dir, "l_orderkey", "l_linenumber", "l_partkey", "l_tax",
                    "l_returnflag", "l_shipdate")
          .filter("l_returnflag = 'R'"))
    df = li.selectExpr(
        f"{_id('SC')} AS event_id",
        f"{SKU.format('l_partkey')} AS sku_id",
        "concat('SUP-', lpad(CAST(l_partkey % 30 + 1 AS STRING), 3, '0')) AS supplier_id",
        "l_tax * 2.875D - 0.08D AS cost_delta_pct",
        "concat('REASON-', CAST(l_linenumber % 5 AS STRING)) AS reason",
        "CAST(l_shipdate AS TIMESTAMP) AS event_timestamp")
    return _conform(df, "supplier_cost_changes")


def macro_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders", "o_orderdate", "o_totalprice",
                   "o_orderstatus", "o_orderpriority")
    weekly = (orders
              .groupBy(F.expr("to_date(date_trunc('week', o_orderdate)) AS signal_week"))
              .agg(F.expr("count(1) AS n"),
                   # integer cents: an exact, order-independent sum
                   F.expr("sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents"),
                   F.expr("count_if(o_orderstatus = 'O') AS n_open"),
                   F.expr("count_if(o_orderpriority = '1-URGENT') AS n_urgent")))
    df = weekly.selectExpr(
        "signal_week",
        "100.0D + cents / (n * 2500000) AS ppi_steel",
        "60.0D + 160.0D * n_open / n AS ppi_copper",
        "70.0D + 110.0D * n_urgent / n AS ppi_pvc",
        "'orders' AS source")
    return _conform(df, "macro_signals")


ADAPTERS = {
    "product_catalog": product_catalog,
    "competitor_prices": competitor_prices,
    "inventory_events": inventory_events,
    "daily_sales": daily_sales,
    "customer_behavior": customer_behavior,
    "promotions": promotions,
    "supplier_cost_changes": supplier_cost_changes,
    "macro_signals": macro_signals,
}


class RawTables:
    """Lazy accessor for the eight raw tables of one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date = config.AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        fn = ADAPTERS.get(name)
        if fn is None:
            raise AttributeError(name)
        if name not in self._built:   # declare each lazy plan once
            args = (self.as_of,) if "as_of" in fn.__code__.co_varnames else ()
            self._built[name] = fn(self.spark, self.sf_dir, *args)
        return self._built[name]
