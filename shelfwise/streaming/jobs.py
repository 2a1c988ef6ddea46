"""The pricing jobs end to end, in the order the pipeline runs them.

    raw landing -> bronze (stream) -> silver prices + silver inventory (streams)
    -> gold features (stream x SKU dimension) -> feature mart (refresh,
    clustered) -> recommendations table -> price model (fit, save, score)

Every layer is a directory under ``root`` (shared storage on a cluster), every
stream keeps its own checkpoint there, and rerunning ``run_all`` with the same
``root`` after new raw files land processes only the new files; the mart merges
them, recommendations and model are computed anew from it, and each of these
tables is replaced in one step.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import gold, model, recommend, skew
from ..operators.joins import write_and_read
from ..sources.tables import SourceTables
from ..sources.testdata import RawTables
from ..sources.versions import VersionedTable
from . import runner


@dataclass
class RunOutputs:
    root: str
    bronze_prices: str
    bronze_inventory: str
    silver_prices: str
    silver_inventory: str
    gold_features: str
    feature_mart: str
    recommendations: str
    model: str
    model_scores: str


def paths(root: str) -> RunOutputs:
    return RunOutputs(
        root=root,
        bronze_prices=f"{root}/bronze/competitor_prices_raw",
        bronze_inventory=f"{root}/bronze/inventory_events_raw",
        silver_prices=f"{root}/silver/competitor_prices",
        silver_inventory=f"{root}/silver/inventory",
        gold_features=f"{root}/gold/gold_pricing_features",
        feature_mart=f"{root}/gold/gold_feature_mart",
        recommendations=f"{root}/gold/pricing_recommendations",
        model=f"{root}/ml/pricing_model",
        model_scores=f"{root}/gold/price_model_scores",
    )


def land_raw(raw: RawTables, root: str) -> None:
    """Append the current raw event rows to the append-only landing folders."""
    runner.land(raw.competitor_prices, f"{root}/raw/competitor_prices")
    runner.land(raw.inventory_events, f"{root}/raw/inventory_events")


def run_all(spark: SparkSession, raw: RawTables | SourceTables, root: str,
            run_ts: dt.datetime | None = None, train_model: bool = True, salts: int = skew.SALTS) -> RunOutputs:
    """Run every layer once (bounded streams), reading raw events from the
    landing folders under ``root``; hot keys and SKUs are spread over ``salts``
    tasks."""
    out = paths(root)
    chk = f"{root}/_checkpoints"
    # 01 · bronze
    # raw events: table streams where the source has them, else the landing folders
    source = raw.stream if isinstance(raw, SourceTables) else lambda table: f"{root}/raw/{table}"
    runner.bronze_job(spark, source("competitor_prices"), "competitor_prices",
                      out.bronze_prices, f"{chk}/bronze_prices", run_ts)
    runner.bronze_job(spark, source("inventory_events"), "inventory_events",
                      out.bronze_inventory, f"{chk}/bronze_inventory", run_ts)
    # 02 · silver (statics re-read every run)
    demand = write_and_read(gold.demand_window(raw.daily_sales, raw.as_of), "demand_window")
    runner.silver_prices_job(spark, out.bronze_prices, raw.product_catalog, out.silver_prices,
                             f"{chk}/silver_prices", run_ts, salts)
    runner.silver_inventory_job(spark, out.bronze_inventory, demand.select("sku_id", "avg_daily_units"),
                                out.silver_inventory, f"{chk}/silver_inventory", run_ts, salts)
    # 03 · gold streaming table over the silver price stream
    dim = gold.sku_dimension(raw.product_catalog, runner.read_table(spark, out.silver_inventory), demand,
                             raw.customer_behavior, raw.promotions, raw.supplier_cost_changes,
                             raw.macro_signals, raw.as_of)
    runner.gold_job(spark, out.silver_prices, write_and_read(dim, "sku_dimension"), out.gold_features, f"{chk}/gold", run_ts, salts)
    # 03 · mart (materialised view), clustered by sku_id
    mart = runner.refresh_mart(spark, out.gold_features, out.feature_mart, f"{chk}/mart")
    # 05 · recommendations
    flags = recommend.price_flags(mart, run_ts=run_ts)
    VersionedTable(spark, out.recommendations).replace(gold.clustered(flags))
    # 04 · model: fit, persist, score the whole mart
    if train_model:
        fitted, _ = model.train(mart)
        model.save(fitted, out.model)
        scores = recommend.score_compare(model.score(model.load(out.model), mart))
        VersionedTable(spark, out.model_scores).replace(scores)
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    """A layer's rows: the current version where it is replaced, else the whole
    appended table."""
    table = VersionedTable(spark, path)
    return table.read() if table.current() else runner.read_table(spark, path)

