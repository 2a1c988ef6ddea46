"""Where streams keep their state."""

import datetime as dt
import os
from pathlib import Path

import pytest

from shelfwise import session
from shelfwise.session import run_dir
from shelfwise.sources import schemas
from shelfwise.streaming import runner

START = dt.datetime(2001, 1, 1)
HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.fixture
def bare(spark):
    """The session as a cluster gives it: nothing said about state."""
    keys = [k for k in {*session.DEFAULT_CONF, *session.STATE_CONF} if "stateStore" in k]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.unset(k)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run(spark, base, rows):
    spark.createDataFrame(rows, schemas.bronze_schema(schemas.COMPETITOR_PRICES)).write.mode("append").parquet(f"{base}/bronze")
    catalog = spark.createDataFrame([("S1", "n", "CAT", "CAT-1", "T", "B", 5.0, 1.0, True, None, "SUP", None)], schemas.PRODUCT_CATALOG)
    held = runner.silver_prices_job(spark, f"{base}/bronze", catalog, f"{base}/silver", f"{base}/chk", None, 4)
    state = Path(base.removeprefix("file:"), "chk", "state")
    return held, {os.path.splitext(p)[1] for p in map(str, state.rglob("[0-9]*.*"))}, sorted(
        r[0] for r in runner.read_table(spark, f"{base}/silver").select("event_timestamp").collect())


def event(minute):
    return (f"e{minute}", "S1", "C", 10.0, None, START + dt.timedelta(minutes=minute), START, "raw")


def test_state_lies_on_disk(bare):
    """Without a word in the session, no state is a map on the heap; the
    session's settings are as before."""
    base = run_dir(bare, "state")
    held, kinds, times = run(bare, base, [event(m) for m in (0, 0, 1, 2)])
    assert held >= 6  # three keys on two levels, the first by key and input partition
    assert ".zip" in kinds and not kinds & {".delta", ".snapshot", ".changelog"}
    assert all(bare.conf.get(k, None) is None for k in session.STATE_CONF)
    # taken up by the same checkpoint: known events and late ones are dropped
    *_, again = run(bare, base, [event(2), event(90)])
    assert again == times + [START + dt.timedelta(minutes=90)]
    *_, late = run(bare, base, [event(3), event(90), event(100)])
    assert late == again + [START + dt.timedelta(minutes=100)]


def test_the_sessions_provider_is_kept(bare):
    bare.conf.set(session.PROVIDER, HEAP)
    _, kinds, times = run(bare, run_dir(bare, "state"), [event(m) for m in (0, 1, 1)])
    assert ".delta" in kinds and ".zip" not in kinds and len(times) == 2
    assert bare.conf.get(session.PROVIDER) == HEAP
