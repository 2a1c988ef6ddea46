"""Silver layer: validate, deduplicate and enrich the two event streams.

Each function is DataFrame -> DataFrame and works on batch and streaming
inputs alike.  Streaming inputs are deduplicated with a 30-minute event-time
watermark (state is evictable because the key contains the event time);
batch inputs keep one row per key by a total order, so reruns, the streaming
form and the SQL oracle agree on which row survives.

Validation runs *before* deduplication: the watermark operator cannot push a
filter through itself, and a NULL event time would otherwise sit in the state
store forever.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import pricing
from . import skew
from .bronze import stamp
from .unique import least_per_key, one_per_key

PRICE_KEYS = ["sku_id", "competitor", "event_timestamp"]
INVENTORY_KEYS = ["sku_id", "event_timestamp"]
# Batch tie-breaks among rows that share a dedup key (first wins).
PRICE_TIEBREAK = ["competitor_price", "event_id", "scrape_url"]
INVENTORY_TIEBREAK = ["stock_after", "warehouse_id", "event_id", "event_type", "stock_delta"]
# fixed values: the catalog columns of the enriched price events
CATALOG_COLUMNS = ["sku_id", "category", "subcategory", "brand", "unit_cost", "product_name"]


def price_is_valid() -> Column:
    """C1 + C2: non-null keys and 0 < competitor_price < 10000."""
    return (F.col("sku_id").isNotNull()
            & F.col("event_timestamp").isNotNull()
            & (F.col("competitor_price") > config.PRICE_MIN_EXCLUSIVE)
            & (F.col("competitor_price") < config.PRICE_MAX_EXCLUSIVE))


def valid_prices(df: DataFrame) -> DataFrame:
    return df.filter(price_is_valid())


def inventory_is_valid() -> Column:
    """C1 + C2: non-null sku and event time, stock_after >= 0."""
    return (F.col("sku_id").isNotNull()
            & F.col("event_timestamp").isNotNull()
            & (F.col("stock_after") >= 0))


def valid_inventory(df: DataFrame) -> DataFrame:
    return df.filter(inventory_is_valid())


def deduplicate(df: DataFrame, keys: list[str], tiebreak: list[str],
                delay: str = config.WATERMARK_DELAY, salts: int = 0) -> DataFrame:
    """I1 + I2: one row per key.

    Stream: watermark + dropDuplicates (rows behind the watermark are dropped,
    I3).  With ``salts`` in two levels: first by key and a salt of the input
    partition, so a key that holds a large share of a batch is spread over
    that many state tasks, then what is left of it (a row per salt) by key.
    Batch: row_number over the key with a total order; Spark plans the
    ``rn = 1`` filter as a partial WindowGroupLimit before the shuffle.
    """
    if df.isStreaming:
        df = df.withWatermark("event_timestamp", delay)
        if salts:
            salt = F.pmod(F.spark_partition_id(), F.lit(salts))
            df = df.withColumn("_salt", salt).dropDuplicates([*keys, "_salt"]).drop("_salt")
        return df.dropDuplicates(keys)
    return one_per_key(df, keys, [F.col(c).asc() for c in tiebreak])


def whole_prices(raw: DataFrame) -> DataFrame:
    """The rows of :func:`dedup_prices` of a batch by one aggregate, for tables
    that keep all columns; where few are read, the window carries fewer."""
    return least_per_key(valid_prices(raw), PRICE_KEYS, PRICE_TIEBREAK)


def whole_inventory(raw: DataFrame) -> DataFrame:
    """The rows of :func:`dedup_inventory` of a batch, likewise."""
    return least_per_key(valid_inventory(raw), INVENTORY_KEYS, INVENTORY_TIEBREAK)


def unique_catalog(catalog: DataFrame) -> DataFrame:
    """One row per SKU: the latest created, then the first by all other columns."""
    rest = [F.col(c).asc() for c in catalog.columns if c not in ("sku_id", "created_date")]
    latest = [F.col("created_date").desc_nulls_last()] if "created_date" in catalog.columns else []
    return one_per_key(catalog, "sku_id", latest + rest)


def catalog_lookup(catalog: DataFrame) -> DataFrame:
    """The six catalog columns used for enrichment, one row per SKU."""
    return unique_catalog(catalog).select(*CATALOG_COLUMNS)


def dedup_prices(bronze: DataFrame, salts: int = 0) -> DataFrame:
    """C1 + C2, then I1 + I2: valid price events, one per key."""
    return deduplicate(valid_prices(bronze), PRICE_KEYS, PRICE_TIEBREAK, salts=salts)


def enrich_prices(deduped: DataFrame, lookup: DataFrame, run_ts: dt.datetime | None = None,
                  hot: list[str] | None = None, salts: int = 0) -> DataFrame:
    """D1 + B2 + B5: inner join with :func:`catalog_lookup` (unknown SKUs
    dropped), stamps; the events of ``hot`` SKUs are spread over ``salts`` tasks."""
    enriched = skew.salted_join(deduped, lookup, "sku_id", hot or [], PRICE_KEYS, salts=salts)
    return enriched.withColumns({
        "_validated_at": stamp(run_ts),
        "_price_to_cost": pricing.price_to_cost(),
    })


def silver_prices(bronze: DataFrame, catalog: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Bronze prices -> silver prices (validate, dedup, enrich, stamp)."""
    return enrich_prices(dedup_prices(bronze), catalog_lookup(catalog), run_ts)


def dedup_inventory(bronze: DataFrame, salts: int = 0) -> DataFrame:
    """C1 + C2, then I1 + I2: valid inventory events, one per key."""
    return deduplicate(valid_inventory(bronze), INVENTORY_KEYS, INVENTORY_TIEBREAK, salts=salts)


def enrich_inventory(deduped: DataFrame, velocity: DataFrame, run_ts: dt.datetime | None = None,
                     hot: list[str] | None = None, salts: int = 0) -> DataFrame:
    """D2 + B9 + B10 + B2: left join with per-SKU velocity, days of supply."""
    joined = skew.salted_join(deduped, velocity, "sku_id", hot or [], INVENTORY_KEYS, "left", salts)
    return joined.withColumns({
        "days_of_supply": pricing.days_of_supply("stock_after", "avg_daily_units"),
        "current_stock": F.col("stock_after"),
        "_validated_at": stamp(run_ts),
    })


def silver_inventory(bronze: DataFrame, velocity: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Bronze inventory -> silver inventory (validate, dedup, velocity, DoS)."""
    return enrich_inventory(dedup_inventory(bronze), velocity, run_ts)
