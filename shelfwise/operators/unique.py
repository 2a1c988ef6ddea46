"""One row per key by a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: str | list[str], order: list[Column]) -> DataFrame:
    """The first row of each key.  Spark plans the ``rn = 1`` filter as a
    partial WindowGroupLimit before the shuffle, so a hot key costs one row
    per map task."""
    w = Window.partitionBy(*([keys] if isinstance(keys, str) else keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def least_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes first by ``order``, all ascending, and
    then by its other columns.  One aggregate: it also leaves a hot key one row
    per map task, but sorts by the keys alone and runs no window.  It carries
    all columns, so constants are better added afterwards."""
    rest = [f.name for f in df.schema if f.name not in {*keys, *order}]
    if any("map<" in kind or "variant" in kind for c, kind in df.dtypes if c in rest):  # these have no order
        return one_per_key(df, keys, [F.col(c).asc() for c in order])
    quoted = {c: "`" + c.replace("`", "``") + "`" for c in df.columns}
    least = F.min(F.struct(*[quoted[c] for c in [*order, *rest]])).alias("_least")
    return df.groupBy(*[quoted[c] for c in keys]).agg(least).select(
        *[F.col(quoted[c]) if c in keys else F.col("_least").getField(c).alias(c) for c in df.columns])
