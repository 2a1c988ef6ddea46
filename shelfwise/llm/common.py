"""Helpers shared by the operators: tables, shared folders, binary files.

Every intermediate table and file lies below the folder the cluster names in
``spark.checkpoint.dir``; a task that is run again writes files of a new name,
and only files named by a committed manifest are ever read.
"""

from __future__ import annotations

import contextlib
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import run_dir

#: ASCII white space, in the form of a Java character class without escapes
SPACES = " \t-\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: computed once,
    and nothing above it is run again when an executor is lost.  With
    ``partition_by``, a filter on that column reads its files only."""
    path = run_dir(df.sparkSession, name)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """``n`` rows of ``df`` (all, if fewer) by the order of their key's hash.
    Of a larger table only a hash range with about ``2 n`` rows is sorted, so
    what meets in one task doesn't grow with the table."""
    total = df.count()
    h = F.xxhash64(*key)
    if total > 4 * n:
        df = df.where(h < int(-2**63 + 2**64 * (2 * n / total)))
    return df.orderBy(h, *key).limit(n)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint for a *stored* table, only if it has at most ``max_rows``
    rows; beyond that Spark joins by shuffle (AQE splits hot keys)."""
    return F.broadcast(df) if df.count() <= max_rows else df


def broadcast_if_light(df: DataFrame, row_bytes: Column, most: int) -> DataFrame:
    """Broadcast hint for a *stored* table whose rows differ in size, only if
    ``row_bytes`` (and 64 for each row) add up to at most ``most`` bytes."""
    size = df.agg(F.sum(F.coalesce(row_bytes, F.lit(0)).cast("long") + 64)).first()[0] or 0
    return F.broadcast(df) if size <= most else df


#: bits of a filter for each key, and its blocks of 64 bits at most
BITS_PER_KEY, MAX_BLOCKS = 16, 1 << 20


def _block(h: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h, 18), F.lit(blocks))


def _bits(h: Column) -> Column:
    """Three bits of a block, from the low bits of a key's hash."""
    one = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, s).bitwiseAND(F.lit(63)).cast("int"))
           for s in (0, 6, 12)]
    return one[0].bitwiseOR(one[1]).bitwiseOR(one[2])


def possible(rows: DataFrame, h: str, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_possible``: whether column ``h`` may be among the hashes
    ``key`` of ``keys``.  A blocked Bloom filter of a bounded size is broadcast;
    beyond ``MAX_BLOCKS`` blocks it lets more pass, but never misses a key."""
    blocks = min(MAX_BLOCKS, max(1, -(-keys.count() * BITS_PER_KEY // 64)))
    table = stored(keys.groupBy(_block(F.col(key), blocks).alias("_block")).agg(F.bit_or(_bits(F.col(key))).alias("_filter")), "filter")
    own = _bits(F.col(h))
    return (rows.join(F.broadcast(table), _block(F.col(h), blocks) == F.col("_block"), "left")
            .withColumn("_possible", F.coalesce(F.col("_filter").bitwiseAND(own) == own, F.lit(False))).drop("_block", "_filter"))


def shared_file_system(uri: str):
    """(pyarrow file system, path in it) of a folder in shared storage."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        return fs.LocalFileSystem(), uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, chunks) -> tuple[str, int]:
    """Write the byte strings ``chunks`` as one file below ``folder``.

    The name gets a unique part per attempt, so a task that is run again or
    twice at once never touches another attempt's file.  Returns (name, size).
    """
    files, path = shared_file_system(folder)
    stem, ext = os.path.splitext(name)
    full = f"{stem}-{uuid.uuid4().hex[:12]}{ext}"
    files.create_dir(path, recursive=True)
    size = 0
    with files.open_output_stream(f"{path}/{full}") as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    return full, size


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Within the block, Arrow batches of at most ``rows`` rows; what is meant by
    it must run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` rows, unless the session names a size:
    with whole texts in a batch, the default of 10,000 rows is too many."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(rows))
