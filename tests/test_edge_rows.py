"""Hand-written edge rows for validation, dedup, joins and feature defaults."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.operators import gold, silver
from shelfwise.sources import schemas

T0 = dt.datetime(2001, 5, 31, 10, 0, 0)
AS_OF = dt.date(2001, 6, 1)


def _prices(spark, rows):
    return spark.createDataFrame(rows, schemas.bronze_schema(schemas.COMPETITOR_PRICES))


def _price_row(event_id="e1", sku="SKU-00001", comp="C1", price=10.0, ts=T0):
    return (event_id, sku, comp, price, None, ts, T0, "raw.competitor_prices")


def _catalog(spark, rows):
    return spark.createDataFrame(
        [(s, f"name {s}", "CAT", "CAT-1", "T", "B", cost, 1.0, True, None, "SUP-001", None)
         for s, cost in rows], schemas.PRODUCT_CATALOG)


def test_price_validation_bounds(spark):
    rows = [_price_row(f"e{i}", price=p, ts=T0 + dt.timedelta(hours=i))
            for i, p in enumerate([0.0, 0.01, 9999.99, 10000.0, None])]
    rows.append(_price_row("nk", sku=None))
    rows.append(_price_row("nt", ts=None))
    kept = silver.valid_prices(_prices(spark, rows)).select("competitor_price").collect()
    assert sorted(r[0] for r in kept) == [0.01, 9999.99]


def test_zero_cost_gives_null_ratio_and_unknown_sku_dropped(spark):
    bronze = _prices(spark, [_price_row("a", sku="SKU-00001"), _price_row("b", sku="SKU-99999")])
    cat = _catalog(spark, [("SKU-00001", 0.0)])
    out = silver.silver_prices(bronze, cat).collect()
    assert [r.sku_id for r in out] == ["SKU-00001"]
    assert out[0]._price_to_cost is None


def test_batch_dedup_is_deterministic(spark):
    rows = [_price_row("e2", price=12.0), _price_row("e1", price=12.0), _price_row("e3", price=11.0)]
    out = silver.deduplicate(_prices(spark, rows), silver.PRICE_KEYS, silver.PRICE_TIEBREAK).collect()
    assert [(r.event_id, r.competitor_price) for r in out] == [("e3", 11.0)]
    out = silver.deduplicate(_prices(spark, rows[:2]), silver.PRICE_KEYS, silver.PRICE_TIEBREAK).collect()
    assert [r.event_id for r in out] == ["e1"]


def _inventory(spark, rows):
    return spark.createDataFrame(
        [(f"i{i}", sku, "sale", 1, stock, "WH-01", ts, T0, "raw.inventory_events")
         for i, (sku, stock, ts) in enumerate(rows)],
        schemas.bronze_schema(schemas.INVENTORY_EVENTS))


def test_stock_bounds_and_days_of_supply(spark):
    inv = _inventory(spark, [("SKU-00001", -1, T0), ("SKU-00001", 0, T0 + dt.timedelta(minutes=1)),
                             ("SKU-00001", None, T0 + dt.timedelta(minutes=2)),
                             ("SKU-00002", 30, T0), ("SKU-00003", 5, None)])
    velocity = spark.createDataFrame([("SKU-00001", 2.0), ("SKU-00002", 4.0)],
                                     "sku_id string, avg_daily_units double")
    out = {r.sku_id: r for r in silver.silver_inventory(inv, velocity).collect()}
    assert set(out) == {"SKU-00001", "SKU-00002"}
    assert out["SKU-00001"].current_stock == 0 and out["SKU-00001"].days_of_supply == 0.0
    assert out["SKU-00002"].days_of_supply == 7.5


def _sales(spark, rows):
    return spark.createDataFrame([(s, d, u, 1.0, "ST-01", si) for s, d, u, si in rows], schemas.DAILY_SALES)


def test_demand_window_edges(spark):
    day = lambda n: AS_OF - dt.timedelta(days=n)
    sales = _sales(spark, [("S", day(7), 1, 1.0), ("S", day(8), 10, 1.0), ("S", day(30), 100, 1.3),
                           ("S", day(31), 1000, 1.0), ("S", day(-1), 5000, 1.0)])
    r = gold.demand_window(sales, AS_OF).collect()[0]
    assert r.units_sold_7d == 1
    assert r.units_sold_30d == 111
    assert r.avg_daily_units == 37.0
    assert r.seasonality_index == 1.1


def _empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_bare_sku_defaults_and_no_macro(spark):
    cat = _catalog(spark, [("SKU-00001", 10.0)])
    dim = gold.sku_dimension(
        cat, _empty(spark, schemas.SILVER_INVENTORY),
        gold.demand_window(_empty(spark, schemas.DAILY_SALES), AS_OF),
        _empty(spark, schemas.CUSTOMER_BEHAVIOR), _empty(spark, schemas.PROMOTIONS),
        _empty(spark, schemas.SUPPLIER_COST_CHANGES), _empty(spark, schemas.MACRO_SIGNALS), AS_OF)
    r = dim.collect()[0]
    assert (r.current_stock, r.days_of_supply, r.units_sold_7d, r.units_sold_30d) == (0, -1.0, 0, 0)
    assert (r.avg_daily_units, r.seasonality_index, r.view_count) == (0.0, 1.0, 0)
    assert (r.cart_add_rate, r.conversion_rate, r.return_rate) == (0.0, 0.0, 0.0)
    assert (r.discount_pct, r.promo_type, r.cost_delta_pct) == (0.0, "NONE", 0.0)
    assert (r.ppi_steel, r.ppi_copper, r.ppi_pvc) == (100.0, 100.0, 100.0)
    assert r.current_price == 13.5


def test_promo_tie_prefers_lowest_type(spark):
    promos = spark.createDataFrame(
        [("p1", "S", "VOLUME", 0.2, AS_OF, AS_OF, True, None),
         ("p2", "S", "BUNDLE", 0.2, AS_OF, AS_OF, True, None),
         ("p3", "S", "CLEARANCE", 0.3, AS_OF, AS_OF, False, None)], schemas.PROMOTIONS)
    r = gold.best_promo(promos).collect()
    assert [(x.promo_type, x.discount_pct) for x in r] == [("BUNDLE", 0.2)]


def test_mart_latest_tie_prefers_lowest_competitor(spark):
    cols = "sku_id string, competitor string, competitor_price double, source_event_timestamp timestamp, _updated_at timestamp"
    feats = spark.createDataFrame(
        [("S", "C3", 5.0, T0, T0), ("S", "C1", 6.0, T0, T0), ("S", "C0", 1.0, T0 - dt.timedelta(hours=1), T0)],
        cols)
    r = gold.feature_mart(feats).collect()
    assert [(x.competitor, x.competitor_price) for x in r] == [("C1", 6.0)]


def test_supplier_window_and_macro(spark):
    sc = spark.createDataFrame(
        [("e1", "S", "SUP-001", 0.1, None, dt.datetime(2001, 3, 3)),
         ("e2", "S", "SUP-001", 0.2, None, dt.datetime(2001, 3, 2, 23, 59)),
         ("e3", "S", "SUP-001", 0.0, None, dt.datetime(2001, 6, 1))], schemas.SUPPLIER_COST_CHANGES)
    r = gold.supplier_pressure(sc, AS_OF).collect()[0]
    assert r.cost_delta_pct == 0.05
    macro = spark.createDataFrame(
        [(dt.date(2001, 5, 4), 110.0, 100.0, 90.0, "BLS"), (dt.date(2001, 5, 3), 0.0, 0.0, 0.0, "BLS"),
         (dt.date(2001, 5, 28), 120.0, 100.0, 100.0, "BLS")], schemas.MACRO_SIGNALS)
    m = gold.macro_trailing(macro, AS_OF).collect()[0]
    assert (m.ppi_steel, m.ppi_copper, m.ppi_pvc) == (115.0, 100.0, 95.0)


def test_behavior_fanout_is_not_introduced(spark, sf_small):
    from shelfwise.sources.testdata import RawTables
    cb = RawTables(spark, sf_small).customer_behavior
    assert cb.count() == cb.select("sku_id").distinct().count()
    cat = RawTables(spark, sf_small).product_catalog
    assert cat.count() == cat.select("sku_id").distinct().count()
    assert cb.filter(F.col("cart_add_rate") > 1).count() == 0
