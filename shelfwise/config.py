"""Pipeline parameters and fixed values.

Fixed values below must equal the pricing pipeline's own constants for results
to agree; they are stated here once, in natural order.
"""

from __future__ import annotations

import datetime as dt

# --- fixed values: business constants of the pricing pipeline -------------
SHELF_MARKUP = 1.35            # current_price = round(unit_cost * 1.35, 2)
TARGET_GM = 0.42               # target gross margin for flags
RAISE_THRESHOLD = 0.03         # comp-gap threshold (also used for DISCOUNT)
DISC_THRESHOLD = 0.03          # accepted, never used by the flag rule
CONVERSION_FLOOR = 0.08        # DISCOUNT needs conversion below this
MODEL_VERSION = "live_demo_v1"
WATERMARK_DELAY = "30 minutes"
PRICE_MIN_EXCLUSIVE = 0.0      # 0 < competitor_price < 10000
PRICE_MAX_EXCLUSIVE = 10000.0
DEMAND_SHORT_DAYS = 7
DEMAND_LONG_DAYS = 30
SUPPLIER_WINDOW_DAYS = 90
MACRO_WINDOW_DAYS = 28
SIGNAL_CUTOFF_PCT = 3.0        # J4: RAISE if delta > 3, DISCOUNT if < -3
SIGNAL_RAISE = "↑ RAISE"
SIGNAL_DISCOUNT = "↓ DISCOUNT"
SIGNAL_HOLD = "→ HOLD"
# Price-target label: target margin drawn from [0.38, 0.55]
TARGET_GM_LOW = 0.38
TARGET_GM_HIGH = 0.55
# Its optional noise: standard deviation of a promotion's price, and of a list price per unit of its floor
PROMO_NOISE = 0.5
LIST_NOISE = 0.01
SAMPLE_SEED = 99

# The 19 model features, in training order.
FEATURES = [
    "unit_cost", "weight_lbs",
    "competitor_price", "competitor_markup",
    "current_stock", "days_of_supply",
    "units_sold_7d", "units_sold_30d", "avg_daily_units", "seasonality_index",
    "view_count", "cart_add_rate", "conversion_rate", "return_rate",
    "discount_pct",
    "cost_delta_pct",
    "ppi_steel", "ppi_copper", "ppi_pvc",
]

# The 30 gold feature columns, in table order.
GOLD_COLUMNS = [
    "sku_id", "product_name", "category", "subcategory", "brand", "supplier_id",
    "unit_cost", "weight_lbs",
    "competitor", "competitor_price", "competitor_markup",
    "current_stock", "days_of_supply",
    "units_sold_7d", "units_sold_30d", "avg_daily_units", "seasonality_index",
    "view_count", "cart_add_rate", "conversion_rate", "return_rate",
    "discount_pct", "promo_type",
    "cost_delta_pct",
    "ppi_steel", "ppi_copper", "ppi_pvc",
    "current_price",
    "source_event_timestamp", "_updated_at",
]

# --- run parameters used by queries() / tests ---------------------------
# The stand-in data ends in late 2001, so the business date is fixed inside it.
AS_OF = dt.date(2001, 6, 1)
# Processing-time stamps (_ingested_at, _validated_at, _updated_at,
# generated_at) default to current_timestamp(); queries pass this fixed value
# so that their output is reproducible.
RUN_TS = dt.datetime(2001, 6, 1, 12, 0, 0)
