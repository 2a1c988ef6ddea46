"""Bronze layer: raw events plus ingest metadata (B1)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ts_literal(value: dt.datetime, ntz: bool = False) -> Column:
    """A wall-clock timestamp literal read in the session time zone.

    Built from text, so it does not depend on the Python process's zone.
    """
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz" if ntz else "timestamp")


def stamp(run_ts: dt.datetime | None) -> Column:
    """Processing-time stamp: current_timestamp(), or a fixed run time."""
    if run_ts is None:
        return F.current_timestamp()
    return ts_literal(run_ts)


def to_bronze(raw: DataFrame, source: str, run_ts: dt.datetime | None = None) -> DataFrame:
    """B1: add ``_ingested_at`` and ``_source``; works on batch and streams."""
    return raw.withColumns({"_ingested_at": stamp(run_ts), "_source": F.lit(source)})
