"""Rolling demand (E1-E3) by sums that can be taken back.

Sales are summed by SKU and day as they arrive, whatever day they are dated to.
The window's sums per SKU are a state; moving the window on adds the days that
enter, takes off those that leave and adds what arrived since for days inside.
So a step reads what is new, the entering and leaving days and the state, not
the window.  Seasonality is summed in decimals, so taking back is exact.

Each step writes its daily sums to a folder of its own and then replaces the
state in one step; daily sums of a step that wasn't committed don't count, and
a step that is run again writes them anew.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..sources.versions import VersionedTable

SUMS = ["short_units", "short_n", "units", "n", "rows", "season", "season_n"]
DAYS = "sku_id string, sale_date date, rows long, units long, n long, season decimal(38,12), season_n long, step int"


def daily(sales: DataFrame) -> DataFrame:
    """The sums of one SKU's sales of one day."""
    season = F.col("seasonality_index").cast("decimal(38,12)")
    return (sales.where(F.col("sale_date").isNotNull()).groupBy("sku_id", "sale_date")
            .agg(F.count("*").alias("rows"), F.coalesce(F.sum("units_sold"), F.lit(0)).alias("units"), F.count("units_sold").alias("n"),
                 F.coalesce(F.sum(season), F.lit(0)).cast("decimal(38,12)").alias("season"), F.count(season).alias("season_n")))


def within(day: dt.date, days: int) -> Column:
    """Whether ``sale_date`` lies in [day - days, day]."""
    return F.col("sale_date").between(F.lit(day - dt.timedelta(days=days)), F.lit(day))


def _signed(days: DataFrame, short: Column, whole: Column) -> DataFrame:
    """Contributions of daily sums: ``short`` and ``whole`` are 1, 0 or -1."""
    return days.select("sku_id", (short * F.col("units")).alias("short_units"), (short * F.col("n")).alias("short_n"),
                       (whole * F.col("units")).alias("units"), (whole * F.col("n")).alias("n"), (whole * F.col("rows")).alias("rows"),
                       (whole * F.col("season")).cast("decimal(38,12)").alias("season"), (whole * F.col("season_n")).alias("season_n"))


class RollingDemand:
    """The state and daily sums below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.state = VersionedTable(spark, f"{self.path}/state")

    def _days(self, last_step: int) -> DataFrame:
        if last_step < 0:
            return self.spark.createDataFrame([], DAYS)
        return self.spark.read.schema(DAYS).parquet(f"{self.path}/days").where(F.col("step") <= last_step)

    def advance(self, sales: DataFrame, day: dt.date) -> DataFrame:
        """Take in ``sales``, rows that weren't taken in before and may be dated
        to any day, and move the window on to ``day``; the demand then."""
        last = self.state.current()
        step = last["batch"] + 1 if last else 0
        folder = f"{self.path}/days/step={step}"
        order = ["sale_date", "sku_id"]  # so that a range of days is found by the files' statistics
        daily(sales).repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(folder)
        fresh = self.spark.read.schema(DAYS).parquet(f"{self.path}/days").where(F.col("step") == step)
        short, whole = (within(day, n).cast("int") for n in (config.DEMAND_SHORT_DAYS, config.DEMAND_LONG_DAYS))
        parts = [_signed(fresh.where(within(day, config.DEMAND_LONG_DAYS)), short, whole)]
        if last:
            before = self.state.read()
            old = before.select(F.max("as_of")).first()[0]
            old = old if old is not None else day
            was_short, was = (within(old, n).cast("int") for n in (config.DEMAND_SHORT_DAYS, config.DEMAND_LONG_DAYS))
            # the days that a window loses or gains: ranges, which reach the scan
            ahead, back = sorted((old, day))
            edges = [(ahead + dt.timedelta(days=1), back)] + [
                (ahead - dt.timedelta(days=n), back - dt.timedelta(days=n + 1)) for n in (config.DEMAND_SHORT_DAYS, config.DEMAND_LONG_DAYS)]
            between = F.lit(False)
            for a, b in edges:
                between = between | F.col("sale_date").between(F.lit(a), F.lit(b))
            moved = self._days(step - 1).where(between & ((short != was_short) | (whole != was)))
            parts += [before.where(F.col("sku_id").isNotNull()).select("sku_id", *SUMS), _signed(moved, short - was_short, whole - was)]
        sums = parts[0]
        for part in parts[1:]:
            sums = sums.unionByName(part)
        sums = sums.groupBy("sku_id").agg(*[F.sum(c).cast("decimal(38,12)" if c == "season" else "long").alias(c) for c in SUMS])
        # one more row holds the day when no SKU has sales
        mark = self.spark.createDataFrame([(None,)], "sku_id string")
        state = sums.where("rows > 0").unionByName(mark, allowMissingColumns=True).withColumn("as_of", F.lit(day))
        return self.demand(self.state.replace(state, step))

    @staticmethod
    def demand(state: DataFrame) -> DataFrame:
        """The rows of :func:`gold.demand_window`."""
        return state.where(F.col("sku_id").isNotNull()).select(
            "sku_id", F.when(F.col("short_n") > 0, F.col("short_units")).alias("units_sold_7d"),
            F.when(F.col("n") > 0, F.col("units")).alias("units_sold_30d"),
            F.when(F.col("n") > 0, F.col("units") / F.col("n")).alias("avg_daily_units"),
            F.when(F.col("season_n") > 0, F.round(F.col("season").cast("double") / F.col("season_n"), 6)).alias("seasonality_index"))
