"""Joins of events with a SKU-level table where few SKUs hold many events.

A sketch of the events names the frequent keys (at most ``MOST`` of them, so
what reaches the driver is bounded).  Their rows of the small side are repeated
once per salt and their events are dealt over the salts; all other keys are
joined as they are.  It works inside a streaming plan, where Spark doesn't
split skewed partitions by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: frequent keys at most; share of all rows that makes a key frequent; parts its rows are dealt into
MOST, SHARE, SALTS = 64, 1 / 64, 16


def frequent_keys(events: DataFrame, key: str, share: float = SHARE, most: int = MOST) -> list:
    """Keys that hold at least about ``share`` of ``events``, by a sketch of
    fixed size.  A key that is missed is joined unsalted, which is slower only."""
    counted = events.where(F.col(key).isNotNull()).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {most * 64})").alias("top")).first()
    return sorted(r["item"] for r in counted["top"] or [] if r["count"] >= share * counted["n"])


def salted_join(events: DataFrame, side: DataFrame, key: str, hot: list, spread: list[str], how: str = "inner",
                salts: int = SALTS) -> DataFrame:
    """``events.join(side, key, how)`` with the events of ``hot`` keys dealt
    over ``salts`` tasks by the hash of ``spread``."""
    if not hot:
        return events.join(side, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    dealt = F.when(is_hot, F.pmod(F.xxhash64(*spread), F.lit(salts))).otherwise(0).cast("int")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return (events.withColumn("_salt", dealt)
            .join(side.withColumn("_salt", F.explode(copies)), [key, "_salt"], how).drop("_salt"))
