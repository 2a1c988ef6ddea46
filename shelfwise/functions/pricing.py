"""Column expressions for the pricing rules.

The pricing pipeline applies these rules row by row in pandas on the driver;
here each one is a native Spark column expression, so it runs inside
whole-stage codegen on the executors next to the scan that feeds it.

Rounding convention: Spark ``round`` (HALF_UP on the decimal form of the
double).  Numbers printed into rationale strings are rounded that way first and
formatted afterwards, so the text always agrees with the rounded columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise)."""
    return F.try_divide(col(num), col(den))


def clamp01(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def price_to_cost(price="competitor_price", cost="unit_cost", scale: int = 4) -> Column:
    """round(price / unit_cost, 4) with a zero guard."""
    return F.round(safe_ratio(price, cost), scale)


def days_of_supply(stock="stock_after", velocity="avg_daily_units") -> Column:
    """round(stock / velocity, 1) when velocity > 0, else NULL."""
    return (F.when(col(velocity) > 0, F.round(col(stock) / col(velocity), 1))
            .otherwise(F.lit(None).cast("double")))


def unit_hash(key: str | Column) -> Column:
    """Deterministic U[0,1) per key: first 8 hex digits of md5(key) / 2^32.

    Replaces a sequential random draw, which cannot be reproduced across the
    partitions of a cluster.
    """
    return F.conv(F.substring(F.md5(col(key)), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


# --- J2 --------------------------------------------------------------------
def elasticity_score(conversion="conversion_rate", velocity="avg_daily_units") -> Column:
    """round(clamp01(1 - (0.6*conversion + 0.4*min(velocity/10, 1))), 4)."""
    vel = F.least(col(velocity) / F.lit(10), F.lit(1.0))
    inelastic = col(conversion) * F.lit(0.6) + vel * F.lit(0.4)
    return F.round(clamp01(F.lit(1.0) - inelastic), 4)


# --- J3 --------------------------------------------------------------------
def gross_margin(price="current_price", cost="unit_cost") -> Column:
    p = col(price)
    return F.when(p > 0, (p - col(cost)) / p).otherwise(F.lit(0.0))


def competitor_gap(price="current_price", comp="competitor_price") -> Column:
    q = col(comp)
    return F.when(q > 0, (col(price) - q) / q).otherwise(F.lit(0.0))


def flag_columns(target_gm: float = config.TARGET_GM,
                 raise_threshold: float = config.RAISE_THRESHOLD,
                 disc_threshold: float = config.DISC_THRESHOLD) -> dict[str, Column]:
    """The RAISE / DISCOUNT / HOLD rule as named column expressions.

    ``disc_threshold`` is accepted for signature parity; the rule compares the
    DISCOUNT branch against ``raise_threshold``, as the pricing rule does.
    Elasticity and margin gap are tested after rounding, comp gap before.
    """
    del disc_threshold
    gm = gross_margin()
    margin_gap = F.round((gm - F.lit(target_gm)) * 100, 2)
    elasticity = elasticity_score()
    comp_gap = competitor_gap()
    conversion = F.col("conversion_rate")
    is_raise = (margin_gap < -5) & (elasticity < 0.5) & (comp_gap < 0.05)
    is_disc = (comp_gap > raise_threshold) & (conversion < config.CONVERSION_FLOOR)
    action = (F.when(is_raise, F.lit("RAISE"))
              .when(is_disc, F.lit("DISCOUNT"))
              .otherwise(F.lit("HOLD")))
    rationale = (
        F.when(is_raise, F.format_string(
            "Margin %+.1fpts below target; low elasticity (%.2f); competitive",
            F.round(margin_gap, 1), F.round(elasticity, 2)))
        .when(is_disc, F.format_string(
            "Priced %.1f%% above competitor; low conversion (%.3f)",
            F.round(comp_gap * 100, 1), F.round(conversion, 3)))
        .otherwise(F.format_string(
            "Margin gap %+.1fpts; elasticity %.2f; monitor",
            F.round(margin_gap, 1), F.round(elasticity, 2))))
    return {
        "action": action,
        "elasticity_score": elasticity,
        "margin_gap_pct": margin_gap,
        "current_gm_pct": F.round(gm * 100, 2),
        "comp_gap_pct": F.round(comp_gap * 100, 2),
        "rationale": rationale,
    }


# --- J1 --------------------------------------------------------------------
TARGET_GM_SPAN = round(config.TARGET_GM_HIGH - config.TARGET_GM_LOW, 2)   # fixed value: width of the target-margin range [0.38, 0.55]


def normal(key: str | Column, draw: str = "noise") -> Column:
    """A standard normal draw per key (Box-Muller over two hashes of it): the
    same under any partitioning, with no state to pass along."""
    u, v = (unit_hash(F.concat(F.lit(f"{draw}-{i}:"), col(key))) for i in "ab")
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u)) * F.cos(F.lit(2.0) * F.pi() * v)


def price_target(key="sku_id", noise: bool = False) -> Column:
    """Synthetic optimal price (training label) for one mart row.

    The target margin is a deterministic per-SKU draw from [0.38, 0.55], so the
    label is reproducible on any cluster.  With ``noise`` a normal draw keyed by
    the SKU is added, of a fixed spread to a promotion's price and of a share of
    the floor price to a list price, before the latter is held above cost.
    """
    g = F.lit(config.TARGET_GM_LOW) + F.lit(TARGET_GM_SPAN) * unit_hash(key)
    floor = F.col("unit_cost") / (F.lit(1.0) - g)
    comp_delta = F.col("competitor_price") - floor
    comp_adj = (F.when(F.abs(comp_delta / floor) < 0.10, F.lit(0.4) * comp_delta)
                .otherwise(F.lit(0.0)))
    avg_units = F.col("avg_daily_units")
    demand_adj = (F.when(avg_units > 5, floor * F.lit(0.03))
                  .when(avg_units < 1, -floor * F.lit(0.04))
                  .otherwise(F.lit(0.0)))
    dos = F.col("days_of_supply")
    scarcity_adj = F.when((dos > 0) & (dos < 14), floor * F.lit(0.02)).otherwise(F.lit(0.0))
    promo_price = floor * (F.lit(1.0) - F.col("discount_pct"))
    list_price = floor + comp_adj + demand_adj + scarcity_adj
    if noise:
        z = normal(key)
        promo_price, list_price = promo_price + config.PROMO_NOISE * z, list_price + floor * config.LIST_NOISE * z
    promo_price = F.round(promo_price, 2)
    list_price = F.round(F.greatest(F.col("unit_cost") * F.lit(1.10), list_price), 2)
    return F.when(F.col("discount_pct") > 0, promo_price).otherwise(list_price)


# --- J4 --------------------------------------------------------------------
def signal(delta_pct: str | Column) -> Column:
    d = col(delta_pct)
    return (F.when(d > config.SIGNAL_CUTOFF_PCT, F.lit(config.SIGNAL_RAISE))
            .when(d < -config.SIGNAL_CUTOFF_PCT, F.lit(config.SIGNAL_DISCOUNT))
            .otherwise(F.lit(config.SIGNAL_HOLD)))


def gm_pct(price: str | Column, cost: str | Column = "unit_cost") -> Column:
    """round((price - cost) / price * 100, 1); NULL for a zero price."""
    return F.round(safe_ratio(col(price) - col(cost), price) * 100, 1)
