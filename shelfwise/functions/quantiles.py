"""Exact, distributed quantiles with linear interpolation (pandas ``describe``
semantics: position p * (n - 1) between the two neighbouring order statistics).

No single task ever holds the whole column:

1. values are pre-aggregated to (value, count) pairs (map-side combine, so a
   value shared by a third of the rows is one pair);
2. ``percentile_approx`` (bounded memory) proposes ``buckets`` - 1 cut points
   (one per ``PAIRS_PER_BUCKET`` distinct values, read on the driver);
   ``Bucketizer`` gives each pair the bucket of its value, so buckets are
   ordered value ranges;
3. per-bucket totals (``buckets`` rows at most) give each bucket's starting
   rank, and a running count inside each bucket gives every distinct value's
   rank interval;
4. the two order statistics around each requested position are picked by a
   range predicate on those intervals, in one pass.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import materialize


PAIRS_PER_BUCKET = 250_000


def exact_quantiles(df: DataFrame, column: str, probs: list[float],
                    buckets: int | None = None) -> DataFrame:
    """Return one row per probability: (p, value).

    ``buckets`` defaults to one per ~250k distinct values (16 at least), so the
    per-bucket ranking stays task-sized as the data grows.
    """
    vals = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    # the input is evaluated once; every later step reads the checkpointed pairs
    pairs = materialize(vals.groupBy("v").agg(F.count(F.lit(1)).alias("c")))
    if buckets is None:
        buckets = max(16, pairs.count() // PAIRS_PER_BUCKET + 1)
    cut_probs = [i / buckets for i in range(1, buckets)]
    # cut points over distinct values: any increasing cuts give exact results,
    # these only balance the buckets
    # one cut point per bucket reaches the driver; its accuracy grows with the
    # buckets, so they stay balanced; Bucketizer binary-searches the cuts
    cuts = pairs.agg(F.percentile_approx("v", cut_probs, max(2000, 20 * buckets))).first()[0] or []
    inner = sorted(set(float(c) for c in cuts)) or [0.0]   # empty input: any one cut
    splits = [float("-inf")] + inner + [float("inf")]
    bucketed = (Bucketizer(splits=splits, inputCol="v", outputCol="bf").transform(pairs)
                .withColumn("b", F.col("bf").cast("int")).drop("bf"))
    totals = bucketed.groupBy("b").agg(F.sum("c").alias("bucket_n"))   # <= buckets rows
    starts = totals.select(
        "b", (F.sum("bucket_n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("start"))
    ranked = (bucketed.join(F.broadcast(starts), "b")
              .withColumn("upto", F.coalesce(F.col("start"), F.lit(0))
                          + F.sum("c").over(Window.partitionBy("b").orderBy("v")
                                             .rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("from_", F.col("upto") - F.col("c")))   # ranks [from_, upto)
    n = pairs.agg(F.sum("c").alias("n"))
    # one row per requested probability, built in SQL (no Python worker)
    prob_list = ", ".join(f"{float(p)!r}D" for p in probs)
    wanted = (n.selectExpr("n", f"explode(array({prob_list})) AS p")
              .withColumn("pos", F.col("p") * (F.col("n") - 1))
              .select("p", "pos", F.explode(F.array(F.floor("pos"), F.ceil("pos"))).alias("at")))
    # two rows per probability: broadcasting them is bounded
    found = (ranked.select("v", "from_", "upto")
             .join(F.broadcast(wanted), (F.col("at") >= F.col("from_")) & (F.col("at") < F.col("upto"))))
    return (found.groupBy("p").agg(F.min("v").alias("v_lo"), F.max("v").alias("v_hi"), F.first("pos").alias("pos"))
            .select("p", (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("pos") - F.floor("pos")))
                    .alias("value")))
