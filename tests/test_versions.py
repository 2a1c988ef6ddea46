"""Tables replaced in one step, the incremental mart, and the file ledger."""

import os

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import gold
from shelfwise.plans.pipeline import PricingPipeline
from shelfwise.session import run_dir
from shelfwise.sources import ledger, schemas, tables
from shelfwise.sources.versions import VersionedTable
from shelfwise.streaming import runner


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def failing(spark):
    """A table that fails while it is being written, after some rows."""
    df = spark.range(1000).repartition(4)
    return df.select("id", F.when(F.col("id") == 999, F.raise_error(F.lit("broken"))).otherwise(F.lit("x")).cast("string").alias("v"))


def test_versions(spark):
    table = VersionedTable(spark, run_dir(spark, "versions"))
    assert table.current() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.replace(spark.createDataFrame([(1, "a")], "id long, v string"))
    with pytest.raises(Exception, match="broken"):
        table.replace(failing(spark))
    assert rows(table.read()) == [(1, "a")] and len(table.versions()) == 1
    second = table.replace(table.read().union(first.withColumn("v", F.lit("b"))), batch=7)  # reads what it replaces
    assert rows(second) == [(1, "a"), (1, "b")] and rows(first) == [(1, "a")]
    assert [(r.version, r.batch) for r in table.versions()] == [(0, None), (1, 7)]
    table.replace(second.where("v = 'b'"))
    dropped = table.drop_old(keep=1)
    assert len(dropped) == 3 and rows(table.read()) == [(1, "b")]  # two old versions and the failed write


def test_catalog_table_is_replaced_in_one_step(spark):
    path = run_dir(spark, "replaced")
    spark.sql("CREATE DATABASE IF NOT EXISTS replaced_test")
    name = "replaced_test.t"
    try:
        tables.write_table(spark.createDataFrame([(1, "a")], "id long, v string"), name, path=path)
        reader = spark.table(name)
        with pytest.raises(Exception, match="broken"):
            tables.write_table(failing(spark), name, path=path)
        assert rows(spark.table(name)) == [(1, "a")]
        # rows, an added column, then another type
        tables.write_table(spark.table(name).withColumn("v", F.lit("b")), name, cluster_by="id", path=path)
        assert rows(spark.table(name)) == [(1, "b")] and rows(reader) == [(1, "a")]
        tables.write_table(spark.table(name).withColumn("w", F.lit(2)), name, path=path)
        assert spark.table(name).columns == ["id", "v", "w"] and spark.table(name).count() == 1
        tables.write_table(spark.createDataFrame([("x",)], "id string"), name, path=path)
        assert rows(spark.table(name)) == [("x",)]
    finally:
        spark.sql("DROP DATABASE replaced_test CASCADE")


def test_mart_merges_appends(spark, sf_small, monkeypatch):
    """Equal to the full recompute after each append; reads new gold files and
    the old mart only; a replay changes nothing."""
    p = PricingPipeline(spark, sf_small)
    base = run_dir(spark, "mart")
    features = p.gold_features.cache()
    part = F.pmod(F.hash("sku_id", "competitor", "source_event_timestamp"), F.lit(4))
    seen = []
    whole = gold.feature_mart

    def counted(df):
        seen.append(df.count())
        return whole(df)
    monkeypatch.setattr(gold, "feature_mart", counted)
    for n in range(3):
        features.where(part == n).write.mode("append").parquet(f"{base}/gold")
        seen.clear()
        mart = runner.refresh_mart(spark, f"{base}/gold", f"{base}/mart", f"{base}/chk")
        assert rows(mart) == rows(whole(features.where(part <= n)))
        new = features.where(part == n).count()
        assert seen[0] == new and all(x <= new + 2 * mart.count() for x in seen)
    before = VersionedTable(spark, f"{base}/mart").versions()
    assert rows(runner.refresh_mart(spark, f"{base}/gold", f"{base}/mart", f"{base}/chk")) == rows(mart)  # nothing new
    assert VersionedTable(spark, f"{base}/mart").versions() == before
    # the last batch again, as after a crash before its commit; then all of gold again
    commits = sorted((x for x in os.listdir(f"{base}/chk/commits") if x.isdigit()), key=int)
    for name in (commits[-1], f".{commits[-1]}.crc"):
        if os.path.exists(f"{base}/chk/commits/{name}"):
            os.remove(f"{base}/chk/commits/{name}")
    assert rows(runner.refresh_mart(spark, f"{base}/gold", f"{base}/mart", f"{base}/chk")) == rows(mart)
    assert rows(runner.refresh_mart(spark, f"{base}/gold", f"{base}/mart", f"{base}/chk2")) == rows(mart)
    features.unpersist()


def test_mart_of_empty_gold(spark):
    base = run_dir(spark, "empty")
    spark.createDataFrame([], schemas.GOLD_FEATURES).write.parquet(f"{base}/gold")
    assert runner.refresh_mart(spark, f"{base}/gold", f"{base}/mart").count() == 0


def test_ledger_reads_each_footer_once(spark, monkeypatch):
    base = run_dir(spark, "ledger")
    read = []
    whole = ledger.footers
    monkeypatch.setattr(ledger, "footers", lambda s, files: read.append(len(files)) or whole(s, files))
    declared = spark.createDataFrame([], "id long, v string").schema

    def land(columns, files):
        spark.range(files).repartition(files).selectExpr("id", *columns).write.mode("append").parquet(f"{base}/data")

    def arrive():
        new = ledger.arrivals(spark, f"{base}/data", declared, f"{base}/ledger")
        new.enter(spark, f"{base}/ledger")
        return new
    land(["'a' AS v"], 3)
    assert arrive().schema == declared and read == [3]
    assert arrive().files == [] and read == [3]
    land(["'a' AS v", "1.5D AS extra"], 2)
    got = arrive()
    assert read == [3, 2] and len(got.files) == 2 and got.schema.names == ["id", "v", "extra"]
    land(["'a' AS v"], 1)
    assert arrive().schema.names == ["id", "v", "extra"] and read == [3, 2, 1]
    land(["'a' AS v", "'text' AS extra"], 1)
    with pytest.raises(ValueError, match="extra"):
        arrive()
    with pytest.raises(ValueError, match="extra"):
        arrive()  # not entered
