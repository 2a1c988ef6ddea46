"""Work on what is new only: rolling demand, the clustered table, the profile by file."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import gold, profile, rolling
from shelfwise.session import run_dir
from shelfwise.sources import schemas
from shelfwise.sources.clustered import ClusteredTable

DAY = dt.date(2001, 6, 1)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def sales(n, seed=1):
    """(row, day of arrival): some late by up to 40 days, some dated ahead, nulls, a hot SKU."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        day = DAY + dt.timedelta(days=r.randrange(-45, 8))
        row = (r.choice(["hot", "hot", f"S{i % 9}", "only late"]) if i % 50 else None, day if i % 40 else None,
               r.choice([None, 0, 1, 7]), 1.0, "ST", r.choice([None, 0.85, 1.0, 1.3]))
        out.append((row, DAY + dt.timedelta(days=r.randrange(-6, 8)) if i % 3 else DAY - dt.timedelta(days=6)))
    return out


def test_rolling_demand_equals_the_whole_window(spark):
    every = sales(700)
    table = rolling.RollingDemand(spark, run_dir(spark, "rolling"))
    before = DAY - dt.timedelta(days=400)
    for day in [DAY + dt.timedelta(days=n) for n in (-6, -5, -3, 0, 1, 7)]:  # days may be skipped
        new = [s for s, at in every if before < at <= day]
        so_far = [s for s, at in every if at <= day]
        got = table.advance(spark.createDataFrame(new, schemas.DAILY_SALES), day)
        want = gold.demand_window(spark.createDataFrame(so_far, schemas.DAILY_SALES), day)
        want = want.where("sku_id IS NOT NULL")
        # a mean of doubles may fall on the other side of a half in its last place
        season = {r.sku_id: r.seasonality_index for r in want.collect()}
        assert rows(got.drop("seasonality_index")) == rows(want.drop("seasonality_index")), day
        assert {r.sku_id: r.seasonality_index for r in got.collect()} == pytest.approx(season, abs=1.1e-6)
        before = day
    # a far day: everything leaves
    assert table.advance(spark.createDataFrame([], schemas.DAILY_SALES), DAY + dt.timedelta(days=90)).count() == 0
    late = [("S1", DAY + dt.timedelta(days=80), 3, 1.0, "ST", 1.3)]
    assert table.advance(spark.createDataFrame(late, schemas.DAILY_SALES), DAY + dt.timedelta(days=90)).collect()[0].units_sold_30d == 3


def test_a_step_run_again_counts_once(spark, monkeypatch):
    table = rolling.RollingDemand(spark, run_dir(spark, "again"))
    one = spark.createDataFrame([("S", DAY, 5, 1.0, "ST", 1.0)], schemas.DAILY_SALES)
    table.advance(one, DAY)
    replace = table.state.replace
    monkeypatch.setattr(table.state, "replace", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.advance(one, DAY)
    monkeypatch.setattr(table.state, "replace", replace)
    assert table.advance(one, DAY).collect()[0].units_sold_30d == 10
    assert table.advance(one.limit(0), DAY + dt.timedelta(days=8)).collect()[0].units_sold_7d is None


def test_clustered_lookup_reads_few_files(spark):
    table = ClusteredTable(spark, run_dir(spark, "clustered"), within=("t",), file_rows=100, runs=3)
    with pytest.raises(FileNotFoundError):
        table.read()
    every = []
    for n in range(6):
        part = [(f"S{(i * 37 + n) % 400:03d}" if i % 3 else "S200", n * 1000 + i) for i in range(600)]  # a hot key
        every += part
        df = spark.createDataFrame(part, "sku_id string, t long").repartition(5)
        table.append(df, n)
        table.append(df, n)  # a replay
        assert table.read().count() == len(every)
        assert table.zone_map().select("run").distinct().count() <= 3
    assert rows(table.read()) == sorted(every, key=repr)
    files = table.zone_map().count()
    got = table.read(["S003", "S399"])
    assert rows(got) == sorted([x for x in every if x[0] in ("S003", "S399")], key=repr)
    assert files >= 30 and len(got.inputFiles()) <= 2 * 3 * 2
    hot = table.read(["S200"])
    assert hot.count() == sum(k == "S200" for k, _ in every) and len(hot.inputFiles()) > 6  # spans files
    assert table.read(["none"]).count() == 0
    assert len(table.drop_old()) > 0 and table.read().count() == len(every)


def test_profile_reads_each_file_once(spark, monkeypatch):
    base = run_dir(spark, "profile")
    read = []
    whole = profile.file_states
    monkeypatch.setattr(profile, "file_states", lambda s, files, *a: read.append(len(files)) or whole(s, files, *a))
    schema = "sku_id string, event_timestamp timestamp, x long"
    at = F.timestamp_seconds(F.col("id"))

    def land(a, b, files):
        (spark.range(a, b).repartition(files).select(F.concat(F.lit("S"), (F.col("id") % 700).cast("string")).alias("sku_id"),
                                                     at.alias("event_timestamp"), F.col("id").alias("x")).write.mode("append").parquet(f"{base}/t"))

    def now():
        got = profile.profile_by_file(spark, f"{base}/t", spark.createDataFrame([], schema).schema, f"{base}/ledger", "t", "event_timestamp")
        want = profile.profile(spark.read.parquet(f"{base}/t"), "t", "event_timestamp")
        assert rows(got) == rows(want)
    land(0, 500, 3)
    now()
    land(400, 2000, 2)
    now()
    now()
    assert read == [3, 2]
    spark.createDataFrame([], schema).write.mode("append").parquet(f"{base}/t")
    now()
    now()
    assert len(read) == 3


def test_profile_of_an_empty_table(spark):
    base = run_dir(spark, "profile")
    empty = spark.createDataFrame([], "sku_id string, event_timestamp timestamp")
    empty.write.parquet(f"{base}/t")
    got = profile.profile_by_file(spark, f"{base}/t", empty.schema, f"{base}/ledger", "t", "event_timestamp")
    assert [tuple(r) for r in got.collect()] == [("t", 0, None, 0)]
