"""Boundary tests for the row rules: flags (J3), elasticity (J2), signal (J4),
price target (J1).  All comparisons are strict."""

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import pricing
from shelfwise.operators import recommend, target

MART_COLS = ("sku_id string, unit_cost double, current_price double, competitor_price double, "
             "conversion_rate double, avg_daily_units double, days_of_supply double, discount_pct double")


def _flags(spark, rows):
    df = spark.createDataFrame(rows, MART_COLS)
    return {r.sku_id: r for r in recommend.price_flags(df).collect()}


def test_elasticity_formula_and_clamp(spark):
    df = spark.createDataFrame([(0.5, 5.0), (0.0, 0.0), (2.0, 50.0), (0.1, 100.0)],
                               "conversion_rate double, avg_daily_units double")
    got = [r[0] for r in df.select(pricing.elasticity_score()).collect()]
    assert got == [0.5, 1.0, 0.0, 0.54]


def test_flag_raise_needs_strict_margin_gap(spark):
    # gm = (p - c)/p ; margin_gap = (gm - .42) * 100
    rows = [
        # gm = 0.37 -> gap -5.0 exactly -> not RAISE
        ("gap_eq", 63.0, 100.0, 200.0, 0.9, 10.0, 1.0, 0.0),
        # gm = 0.369 -> gap -5.1 -> RAISE (elasticity 0.46 < .5, comp gap < .05)
        ("gap_lt", 63.1, 100.0, 200.0, 0.9, 10.0, 1.0, 0.0),
    ]
    f = _flags(spark, rows)
    assert f["gap_eq"].margin_gap_pct == -5.0 and f["gap_eq"].action == "HOLD"
    assert f["gap_lt"].margin_gap_pct == -5.1 and f["gap_lt"].action == "RAISE"
    assert f["gap_lt"].rationale == "Margin -5.1pts below target; low elasticity (0.06); competitive"


def test_flag_elasticity_half_is_not_raise(spark):
    # conversion .5, velocity 5 -> 1 - (.3 + .2) = 0.5 -> not < .5
    f = _flags(spark, [("e", 80.0, 100.0, 200.0, 0.5, 5.0, 1.0, 0.0)])
    assert f["e"].elasticity_score == 0.5 and f["e"].action == "HOLD"


def test_flag_comp_gap_boundaries(spark):
    rows = [
        # comp gap exactly 0.05 with low margin and low elasticity -> not RAISE;
        # 0.05 > 0.03 and conversion < .08?  conversion .9 -> HOLD
        ("cg05", 80.0, 105.0, 100.0, 0.9, 10.0, 1.0, 0.0),
        # comp gap 0.03 exactly, conversion .01 -> not DISCOUNT (strict)
        ("cg03", 10.0, 103.0, 100.0, 0.01, 0.0, 1.0, 0.0),
        # comp gap .04, conversion .08 exactly -> not DISCOUNT
        ("cv08", 10.0, 104.0, 100.0, 0.08, 0.0, 1.0, 0.0),
        # comp gap .04, conversion .07 -> DISCOUNT
        ("disc", 10.0, 104.0, 100.0, 0.07, 0.0, 1.0, 0.0),
    ]
    f = _flags(spark, rows)
    assert f["cg05"].action == "HOLD"
    assert f["cg03"].action == "HOLD"
    assert f["cv08"].action == "HOLD"
    assert f["disc"].action == "DISCOUNT"
    assert f["disc"].comp_gap_pct == 4.0
    assert f["disc"].rationale == "Priced 4.0% above competitor; low conversion (0.070)"


def test_flag_zero_prices_do_not_divide(spark):
    f = _flags(spark, [("z", 0.0, 0.0, 0.0, 0.5, 1.0, 1.0, 0.0)])
    assert f["z"].current_gm_pct == 0.0 and f["z"].comp_gap_pct == 0.0
    assert f["z"].rationale.startswith("Margin gap -42.0pts")


@pytest.mark.parametrize("delta,expected", [(3.0, "→ HOLD"), (3.1, "↑ RAISE"),
                                            (-3.0, "→ HOLD"), (-3.1, "↓ DISCOUNT")])
def test_signal_cutoffs(spark, delta, expected):
    df = spark.createDataFrame([(delta,)], "d double")
    assert df.select(pricing.signal("d")).collect()[0][0] == expected


def test_score_compare_rounds_then_signals(spark):
    df = spark.createDataFrame([("s", "n", "c", 10.0, 13.5, 14.0, 0, 13.9049)],
                               "sku_id string, product_name string, category string, unit_cost double, "
                               "current_price double, competitor_price double, units_sold_7d long, p double")
    r = recommend.score_compare(df, prediction="p").collect()[0]
    assert r.recommended_price == 13.9
    assert r.delta_pct == 3.0 and r.signal == "→ HOLD"
    assert r.current_gm_pct == 25.9 and r.recommended_gm_pct == 28.1


def test_price_target_branches(spark):
    rows = [
        # promo branch: no 1.10*cost floor
        ("p", 100.0, 0.0, 500.0, 3.0, -1.0, 0.9),
        # no scarcity for days_of_supply -1, 0 and 14
        ("d1", 100.0, 0.0, 500.0, 3.0, -1.0, 0.0),
        ("d0", 100.0, 0.0, 500.0, 3.0, 0.0, 0.0),
        ("d14", 100.0, 0.0, 500.0, 3.0, 14.0, 0.0),
        ("d13", 100.0, 0.0, 500.0, 3.0, 13.0, 0.0),
        # demand exactly 1 and 5 -> no demand adjustment
        ("v1", 100.0, 0.0, 500.0, 1.0, -1.0, 0.0),
        ("v5", 100.0, 0.0, 500.0, 5.0, -1.0, 0.0),
        ("v6", 100.0, 0.0, 500.0, 6.0, -1.0, 0.0),
    ]
    df = spark.createDataFrame(rows, "sku_id string, unit_cost double, current_price double, "
                                     "competitor_price double, avg_daily_units double, "
                                     "days_of_supply double, discount_pct double")
    out = {r.sku_id: r for r in target.with_price_target(df)
           .withColumn("g", F.lit(0.38) + F.lit(0.17) * pricing.unit_hash("sku_id")).collect()}
    for k, r in out.items():
        floor = r.unit_cost / (1 - r.g)
        if k == "p":
            assert r.optimal_price == pytest.approx(round(floor * 0.1, 2), abs=0.011)
            assert r.optimal_price < r.unit_cost
        elif k == "d13":
            assert r.optimal_price == pytest.approx(round(floor * 1.02, 2), abs=0.011)
        elif k == "v6":
            assert r.optimal_price == pytest.approx(round(floor * 1.03, 2), abs=0.011)
        else:
            assert r.optimal_price == pytest.approx(round(floor, 2), abs=0.011), k


def test_unit_hash_range_and_stability(spark):
    df = spark.range(2000).select(F.concat(F.lit("SKU-"), F.col("id").cast("string")).alias("k"))
    stats = df.select(pricing.unit_hash("k").alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).collect()[0]
    assert 0.0 <= stats[0] and stats[1] < 1.0 and 0.45 < stats[2] < 0.55
