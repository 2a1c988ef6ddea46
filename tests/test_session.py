"""Shared-folder handling: the cluster's spark.checkpoint.dir is honoured and
every run gets its own folder below it."""

from shelfwise.session import run_dir, shared_dir


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured.rstrip("/")


def test_run_dirs_are_unique_and_below_the_shared_dir(spark):
    a, b = run_dir(spark, "x"), run_dir(spark, "x")
    assert a != b
    assert a.startswith(shared_dir(spark) + "/x-")
