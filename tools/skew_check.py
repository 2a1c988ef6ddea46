"""Skew check: one SKU holds a third of the *raw* price and inventory events,
at distinct times; broadcasts are off.  Reports, per query, the joins that AQE
split and the largest per-task shuffle read, from the event log.

    python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from shelfwise import config  # noqa: E402
from shelfwise.plans.pipeline import PricingPipeline  # noqa: E402
from shelfwise.session import build_session  # noqa: E402
from shelfwise.sources.testdata import RawTables  # noqa: E402

HOT = "SKU-00001"


class HotRaw:
    """The stand-ins with a third of both event tables on one SKU."""

    def __init__(self, raw):
        self.raw, self.as_of = raw, raw.as_of

    def __getattr__(self, name):
        df = getattr(self.raw, name)
        if name not in ("competitor_prices", "inventory_events"):
            return df
        h = F.abs(F.xxhash64(*df.columns))
        hot = h % 3 == 0
        return (df.withColumn("event_timestamp", F.when(hot, F.col("event_timestamp") + F.make_dt_interval(secs=h % 86400))
                              .otherwise(F.col("event_timestamp")))
                .withColumn("sku_id", F.when(hot, F.lit(HOT)).otherwise(F.col("sku_id"))))


def _events(path: str):
    import zstandard
    for f in sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)):
        with open(f, "rb") as fh:
            stream = fh if not f.endswith(".zstd") else zstandard.ZstdDecompressor().stream_reader(fh)
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                yield line


def measure(sf_dir: str, name: str) -> str:
    log_dir = tempfile.mkdtemp(prefix="skew-events-", dir="/tmp")
    spark = build_session(shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        # keep all 16 reduce partitions so a hot partition is visible
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        # thresholds lowered to this data size
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128KB"})
    p = PricingPipeline(spark, HotRaw(RawTables(spark, sf_dir, config.AS_OF)))
    getattr(p, name).write.format("noop").mode("overwrite").save()
    spark.stop()
    split, reads = 0, {}
    for line in _events(log_dir):
        split = max(split, line.count("SortMergeJoin(skew=true)"))
        e = json.loads(line)
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            n = e["Task Metrics"].get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            reads.setdefault(e["Stage ID"], []).append(n)
    largest = sorted((max(r), sum(r), len(r)) for r in reads.values() if sum(r))[-1]
    return (f"{name}: split joins {split > 0}, largest task read {largest[0]} of {largest[1]} rows "
            f"of its stage ({largest[2]} tasks)")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    for name in ("gold_features", "feature_mart", "sku_dimension_plan"):
        print(measure(sf_dir, name), flush=True)


if __name__ == "__main__":
    main()
