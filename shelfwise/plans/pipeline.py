"""The medallion pipeline, batch form: raw -> bronze -> silver -> gold -> mart.

One lazy DataFrame lineage per layer; nothing is collected.  Every layer is a
plain function of the previous one (see ``shelfwise.operators``), so the same
functions drive the streaming jobs in ``shelfwise.streaming``.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import config
from ..operators import bronze, gold, model, recommend, silver, target
from ..operators.joins import materialize, write_and_read
from ..session import run_dir
from ..sources.testdata import RawTables


class PricingPipeline:
    """Lazily built layers over eight raw tables."""

    def __init__(self, spark: SparkSession, source, as_of: dt.date = config.AS_OF,
                 run_ts: dt.datetime | None = config.RUN_TS):
        """``source``: the eight raw tables (``sources.tables.SourceTables``), or
        the directory of the test tables to read through the stand-ins."""
        self.spark, self.as_of, self.run_ts = spark, as_of, run_ts
        self.raw = RawTables(spark, source, as_of) if isinstance(source, str) else source

    # bronze ---------------------------------------------------------------
    @cached_property
    def bronze_prices(self) -> DataFrame:
        return bronze.to_bronze(self.raw.competitor_prices, "raw.competitor_prices", self.run_ts)

    @cached_property
    def bronze_inventory(self) -> DataFrame:
        return bronze.to_bronze(self.raw.inventory_events, "raw.inventory_events", self.run_ts)

    # silver ---------------------------------------------------------------
    # a run stamps all bronze rows alike, so deduplication needn't carry the
    # stamps: the rows that stay get them
    @cached_property
    def deduped_prices(self) -> DataFrame:
        """The bronze prices that are valid, one per key."""
        return bronze.to_bronze(silver.whole_prices(self.raw.competitor_prices), "raw.competitor_prices", self.run_ts)

    @cached_property
    def deduped_inventory(self) -> DataFrame:
        """The bronze inventory events that are valid, one per key."""
        return bronze.to_bronze(silver.whole_inventory(self.raw.inventory_events), "raw.inventory_events", self.run_ts)

    @cached_property
    def silver_prices(self) -> DataFrame:
        return silver.enrich_prices(self.deduped_prices, silver.catalog_lookup(self.raw.product_catalog), self.run_ts)

    @cached_property
    def demand(self) -> DataFrame:
        """E1-E3 per SKU, written once per run (SKU-sized).

        Read back as a plain table, so the silver inventory join against it
        shuffles both sides and AQE can split a hot SKU; silver and gold both
        read this one aggregation of daily_sales.
        """
        return write_and_read(gold.demand_window(self.raw.daily_sales, self.as_of), "demand_window")

    @cached_property
    def velocity(self) -> DataFrame:
        # E1 is the demand window's mean units (same filter, same average)
        return self.demand.select("sku_id", "avg_daily_units")

    @cached_property
    def silver_inventory(self) -> DataFrame:
        return silver.enrich_inventory(self.deduped_inventory, self.velocity, self.run_ts)

    # gold -----------------------------------------------------------------
    @cached_property
    def sku_dimension_plan(self) -> DataFrame:
        # demand joins once, and is written only where silver needs it too
        r = self.raw
        inventory = gold.latest_stock(silver.dedup_inventory(self.bronze_inventory))
        return gold.sku_dimension_of(r.product_catalog, inventory, gold.demand_window(r.daily_sales, self.as_of),
                                  r.customer_behavior, r.promotions, r.supplier_cost_changes,
                                  r.macro_signals, self.as_of)

    @cached_property
    def sku_dimension(self) -> DataFrame:
        """The SKU dimension of this run, written once to the shared folder.

        SKU-sized, used by the gold row, the mart and everything after it.
        Read back as a plain table, its joins shuffle both sides, so AQE can
        broadcast it when small or split hot SKUs when not (a dimension built
        from sku-partitioned joins would leave AQE nothing to split).
        """
        return write_and_read(self.sku_dimension_plan, "sku_dimension")

    @cached_property
    def gold_features(self) -> DataFrame:
        # straight from the deduplicated events: one exchange on sku_id, one
        # join, whose hot SKUs AQE splits
        return gold.pricing_features(silver.dedup_prices(self.bronze_prices), self.sku_dimension, self.run_ts)

    @cached_property
    def feature_mart(self) -> DataFrame:
        # F3 pushed below the join (same rows; see gold.feature_mart_batch)
        return gold.feature_mart_batch(silver.dedup_prices(self.bronze_prices), self.sku_dimension, self.run_ts)

    # recommendations ------------------------------------------------------
    @cached_property
    def price_flags(self) -> DataFrame:
        return recommend.price_flags(self.feature_mart, run_ts=self.run_ts)

    @cached_property
    def labelled_mart(self) -> DataFrame:
        return target.with_price_target(self.feature_mart)

    # model ------------------------------------------------------------------
    @cached_property
    def materialized_mart(self) -> DataFrame:
        """The mart, checkpointed: boosting scans it once per round."""
        return materialize(self.feature_mart)

    @cached_property
    def price_model(self):
        """K1-K5: fit once per run, persist to the shared folder, reload.

        Returns (model, labelled test split, saved path).
        """
        fitted, test = model.train(self.materialized_mart)
        path = run_dir(self.spark, "price_model")
        model.save(fitted, path)
        return model.load(path), test, path

    @cached_property
    def model_scores(self) -> DataFrame:
        """K6: the reloaded model scored over the whole mart, as J4 rows."""
        fitted, _, _ = self.price_model
        return recommend.score_compare(model.score(fitted, self.materialized_mart))
