"""Plan properties that matter at scale: pushdown, pruning, map-side top-1,
bounded broadcasts."""

from shelfwise.plans.queries import _p


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _explain(df):
    import io
    from contextlib import redirect_stdout
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_lineitem_scan_gets_pushed_filters_and_pruned_columns(spark, sf_small):
    text = _explain(_p(spark, sf_small).raw.supplier_cost_changes)
    scan = text[text.index("Scan parquet"):]
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in scan
    read_schema = scan[scan.index("ReadSchema"):].splitlines()[0]
    assert "l_extendedprice" not in read_schema and "l_discount" not in read_schema


def test_dedup_and_mart_use_map_side_top1(spark, sf_small):
    text = _explain(_p(spark, sf_small).feature_mart)
    # partial + final WindowGroupLimit for dedup, latest inventory, best promo, mart
    assert text.count("WindowGroupLimit") >= 8
    assert "Partial" in text


def test_dimension_has_no_hints_and_no_cross_join(spark, sf_small):
    """The one-row PPI aggregate is a scalar subquery, not a cross join; the
    SKU joins carry no broadcast hint (AQE decides on measured sizes)."""
    qe = _p(spark, sf_small).sku_dimension_plan._jdf.queryExecution()
    plan = qe.optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    assert "Join Cross" not in plan
    assert "scalar-subquery" in plan


def test_mart_joins_one_row_per_sku(spark, sf_small):
    from pyspark.sql import functions as F
    from shelfwise.operators import gold
    latest = gold.latest_price_events(_p(spark, sf_small).silver_prices)
    assert latest.groupBy("sku_id").count().filter(F.col("count") > 1).count() == 0
