"""Steps that read or shuffle less: same rows as the plain form, and the plan or the number of passes."""

import datetime as dt
import threading

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise import config
from shelfwise.operators import gold, silver
from shelfwise.operators.unique import least_per_key
from shelfwise.plans import queries
from shelfwise.plans.pipeline import PricingPipeline
from shelfwise.plans.queries import _one_payload
from shelfwise.session import run_dir
from shelfwise.sources import schemas
from shelfwise.sources.clustered import ClusteredTable
from shelfwise.sources.testdata import SKU
from shelfwise.streaming import runner

DAY = dt.datetime(2001, 6, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_one_payload_without_comparing_rows(spark):
    events = [("a", "S1", "C0", 5.0, None, DAY), ("b", "S1", "C0", 4.0, None, DAY), ("c", "S1", None, 4.0, None, DAY),
              ("d", None, "C0", 5.0, None, DAY), ("e", "S2", "C0", None, None, DAY), ("f", "S2", "C0", -1.0, None, DAY),
              ("f", "S2", "C0", -1.0, None, DAY), ("g", "S2", "C0", 1e4, None, DAY), ("h", "S2", "C0", 7.0, "u", None)]
    raw = spark.createDataFrame(events, schemas.COMPETITOR_PRICES)
    deduped = silver.dedup_prices(raw)
    got = _one_payload(raw, deduped, silver.price_is_valid())
    assert rows(got) == rows(deduped.unionByName(deduped).unionByName(raw.exceptAll(silver.valid_prices(raw))))
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning") == 1


def test_run_files_hold_no_more_rows_than_asked(spark):
    table = ClusteredTable(spark, run_dir(spark, "clustered"), within=("t",), file_rows=100)
    df = spark.range(950).select(F.format_string("S%03d", F.col("id") % 7).alias("sku_id"), F.col("id").alias("t")).repartition(3)
    table.append(df, 0)
    zones = table.zone_map().collect()
    assert max(z["rows"] for z in zones) <= 100 and sum(z["rows"] for z in zones) == 950
    assert rows(table.read(["S003"])) == rows(df.where("sku_id = 'S003'"))


def test_mart_is_merged_in_one_top_1(spark, monkeypatch):
    base, calls = run_dir(spark, "mart"), []
    whole = gold.feature_mart
    monkeypatch.setattr(gold, "feature_mart", lambda df: calls.append(1) or whole(df))
    every = None
    for n in range(3):
        some = spark.range(9).selectExpr(f"concat('S', (id + {n}) % 6) AS sku_id", "concat('C', id % 2) AS competitor",
                                         f"CAST(id + {n} AS DOUBLE) AS competitor_price",
                                         f"timestamp_seconds((id * 7 + {n} * 5) % 11) AS source_event_timestamp")
        have = set(some.columns)
        some = some.selectExpr(*[f"CAST({c if c in have else 'NULL'} AS {schemas.GOLD_FEATURES[c].dataType.simpleString()}) AS {c}"
                                 for c in config.GOLD_COLUMNS])
        some.write.mode("append").parquet(f"{base}/gold")
        every = some if every is None else every.unionByName(some)
        mart = runner.refresh_mart(spark, f"{base}/gold", f"{base}/mart")
    assert rows(mart) == rows(whole(every)) and len(calls) == 3


def test_sku_is_the_formatted_key(spark):
    keys = [None, -123456, -1, 0, 1, 99999, 100000, 12345678901]
    got = spark.createDataFrame([(k,) for k in keys], "k long").selectExpr(f"{SKU.format('k')} AS sku", "format_string('SKU-%05d', k) AS want")
    assert all(r.sku == r.want for r in got.collect()) and not got.schema["sku"].nullable
    # only the rare keys go through the formatter
    assert "BETWEEN 0 AND 99999" in SKU


def _by_window(df, keys, order):
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def test_deduplication_is_one_aggregate(spark):
    later = DAY + dt.timedelta(days=1)
    events = [(i, s, c, p, u, t) for s in ("S1", "S2") for c in ("C0", None) for t in (DAY, later)
              for i, p, u in [("b", 2.0, None), ("a", 2.0, "y"), ("a", 2.0, "x"), (None, 3.0, None), ("b", 2.0, None), (None, 2.0, "z")]]
    raw = spark.createDataFrame(events, schemas.COMPETITOR_PRICES).repartition(5)
    deduped = silver.whole_prices(raw)
    assert deduped.columns == raw.columns and deduped.count() == 8
    assert rows(deduped) == rows(_by_window(raw, silver.PRICE_KEYS, silver.PRICE_TIEBREAK))
    plan = deduped._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_least_per_key_of_any_columns(spark):
    df = spark.range(40).selectExpr("id % 7 AS k", "CAST(NULLIF(id % 3, 0) AS STRING) AS o", "id AS `a.b`", "id * 2 AS `c``d`")
    every = ["o", "`a.b`", "`c``d`"]
    got = least_per_key(df, ["k"], ["o"])
    assert got.columns == df.columns and rows(got) == rows(_by_window(df, ["k"], every))
    held = df.withColumn("m", F.create_map(F.lit("x"), F.col("k")))  # a map has no order
    assert sorted(least_per_key(held, ["k"], ["o"]).select("k").toPandas()["k"]) == list(range(7))
    assert least_per_key(df.limit(0), ["k"], ["o"]).count() == 0


def test_stamps_are_put_on_after_deduplication(spark, sf_small):
    p = PricingPipeline(spark, sf_small)
    assert rows(p.deduped_prices) == rows(silver.dedup_prices(p.bronze_prices))
    assert rows(p.deduped_inventory) == rows(silver.dedup_inventory(p.bronze_inventory))
    assert rows(p.silver_prices) == rows(silver.silver_prices(p.bronze_prices, p.raw.product_catalog, p.run_ts))
    plan = p.deduped_prices._jdf.queryExecution().executedPlan().toString()
    shuffled = [x for x in plan.splitlines() if "Aggregate" in x]
    assert shuffled and not any("_ingested_at" in x for x in shuffled)


def test_table_profile_writes_silver_prices_beside_inventory(spark, sf_small, monkeypatch):
    begun, write = threading.Event(), queries.write_and_read

    def watched(df, name):
        if name == "silver_inventory":
            begun.set()
        if name == "silver_prices":
            assert begun.wait(60), "inventory waits for the prices"
        return write(df, name)
    monkeypatch.setattr(queries, "write_and_read", watched)
    got = {r["table_name"]: r["row_count"] for r in queries.table_profile(spark, sf_small).collect()}
    assert len(got) == 14 and got["silver.competitor_prices"] == queries.silver_prices(spark, sf_small).count()
