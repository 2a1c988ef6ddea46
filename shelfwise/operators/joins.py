"""Lineage cuts in shared storage.

SKU-level tables are written once per run (``write_and_read``) and joined
plainly.  AQE measures the written table's real shuffle size and broadcasts it
only below ``spark.sql.adaptive.autoBroadcastJoinThreshold``; above that the
join stays a sort-merge join whose hot-SKU partitions AQE splits
(``spark.sql.adaptive.skewJoin.enabled``), which it can do because both sides
are plain shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir, run_dir


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by checkpointing into the shared checkpoint folder.

    Reliable (not local) checkpoint: the data survives the loss of the
    executors that computed it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_and_read(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing a table into the shared checkpoint folder.

    Unlike ``checkpoint()``, the re-read table carries no partitioning, so a
    join against it shuffles both sides under ENSURE_REQUIREMENTS — which is
    what lets AQE split a skewed key's partition (or broadcast the table when
    its measured size is small).
    """
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
