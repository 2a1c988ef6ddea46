"""Hot keys in streams: two-level dedup, salted joins, ordered admission."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import silver, skew
from shelfwise.session import run_dir
from shelfwise.sources import schemas
from shelfwise.streaming import runner

START = dt.datetime(2001, 1, 1)
BRONZE = schemas.bronze_schema(schemas.COMPETITOR_PRICES)


def event(i, sku, minute, competitor="C"):
    return (f"e{i}", sku, competitor, 10.0, None, START + dt.timedelta(minutes=minute), START, "raw")


def catalog(spark, n):
    return spark.createDataFrame([(f"S{i}", "n", "CAT", "CAT-1", "T", "B", 5.0, 1.0, True, None, "SUP", None) for i in range(n)],
                                 schemas.PRODUCT_CATALOG)


def keys(df):
    return sorted(tuple(r) for r in df.select(*silver.PRICE_KEYS).collect())


def test_frequent_keys(spark):
    df = spark.createDataFrame([("hot",)] * 400 + [(f"k{i}",) for i in range(600)] + [(None,)] * 500, "k string").repartition(5)
    assert skew.frequent_keys(df, "k") == ["hot"]
    assert skew.frequent_keys(df.where("k IS NULL"), "k") == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(spark, how):
    events = spark.createDataFrame([("hot" if i % 2 else f"k{i % 40}", i) for i in range(2000)] + [(None, 1)], "k string, i long").repartition(6)
    side = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 40, 4)], "k string, v long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = skew.salted_join(events, side, "k", ["hot"], ["k", "i"], how)
        assert sorted(map(tuple, got.select("k", "i", "v").collect()), key=repr) == sorted(
            map(tuple, events.join(side, "k", how).select("k", "i", "v").collect()), key=repr)
        tasks = got.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 500  # of 1000 in 8 partitions
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_two_level_dedup_spreads_copies(spark):
    """A batch of which most rows are copies of one event: same rows out, and
    the second level's state task meets one row per salt only."""
    base = run_dir(spark, "copies")
    rows = [event(i, "S1", 5) for i in range(3000)] + [event(i, f"S{i % 50}", i) for i in range(300)]
    spark.createDataFrame(rows, BRONZE).repartition(12).write.parquet(f"{base}/bronze")
    out = {}
    for salts in (0, 8):
        runner.silver_prices_job(spark, f"{base}/bronze", catalog(spark, 50), f"{base}/silver{salts}", f"{base}/chk{salts}", None, salts)
        out[salts] = keys(runner.read_table(spark, f"{base}/silver{salts}"))
    assert out[0] == out[8] == sorted({(r[1], r[2], r[5]) for r in rows})
    # the same copies again, and later ones: the first level lets them pass under other salts, the second doesn't
    again = rows[:50] + [event(9, "S2", 400)]
    spark.createDataFrame(again, BRONZE).repartition(3).write.mode("append").parquet(f"{base}/bronze")
    runner.silver_prices_job(spark, f"{base}/bronze", catalog(spark, 50), f"{base}/silver8", f"{base}/chk8", None, 8)
    assert keys(runner.read_table(spark, f"{base}/silver8")) == sorted([*out[8], ("S2", "C", again[-1][5])])


def test_admission_by_time_keeps_the_state_small(spark):
    """A shuffled backlog in slices: same rows as in one batch, less state."""
    base = run_dir(spark, "backlog")
    rows = [event(i, f"S{i % 7}", i * 3) for i in range(600)] + [event(i, f"S{i % 7}", i * 3) for i in range(0, 600, 5)]
    rows.append(("null", "S1", "C", 10.0, None, None, START, "raw"))
    spark.createDataFrame(rows, BRONZE).repartition(4).write.parquet(f"{base}/bronze")
    whole = runner.silver_prices_job(spark, f"{base}/bronze", catalog(spark, 7), f"{base}/one", f"{base}/chk1")

    def run():
        return runner.silver_prices_job(spark, f"{base}/admitted", catalog(spark, 7), f"{base}/many", f"{base}/chk2")
    states = runner.admit(spark, f"{base}/bronze", BRONZE, f"{base}/admitted", 5, run)
    assert keys(runner.read_table(spark, f"{base}/many")) == keys(runner.read_table(spark, f"{base}/one"))
    assert len(states) == 5 and max(states) < 0.5 * whole
    assert runner.admit(spark, f"{base}/bronze", BRONZE, f"{base}/admitted", 5, run) == []  # nothing new


def test_admission_is_taken_up_after_a_failure(spark):
    base = run_dir(spark, "failure")
    rows = [event(i, f"S{i % 3}", i * 5) for i in range(90)]
    spark.createDataFrame(rows, BRONZE).write.parquet(f"{base}/bronze")
    calls = []

    def run():
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return runner.silver_prices_job(spark, f"{base}/admitted", catalog(spark, 3), f"{base}/silver", f"{base}/chk")
    with pytest.raises(RuntimeError, match="lost"):
        runner.admit(spark, f"{base}/bronze", BRONZE, f"{base}/admitted", 3, run)
    late = [event(500 + i, "S1", 1000 + i) for i in range(5)]
    spark.createDataFrame(late, BRONZE).write.mode("append").parquet(f"{base}/bronze")
    runner.admit(spark, f"{base}/bronze", BRONZE, f"{base}/admitted", 1, run)
    assert keys(runner.read_table(spark, f"{base}/silver")) == sorted({(r[1], r[2], r[5]) for r in rows + late})
