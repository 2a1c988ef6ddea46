"""Resharding by minimum-cost flow: move the fewest bytes to new capacities.

A table lies in shards (folders ``shard=i/class=c``, a class being the power
of two of a row's size).  From the shards' sizes and the new capacities a
minimum-cost flow gives the bytes each old shard keeps and sends to each new
one; a byte that stays costs nothing, one that moves costs one.  Rows of a
shard have a fixed order, large classes first and by hash within a class (of
the row and the number it was stored with, so that equal rows lie apart), and
each flow takes the next stretch of it, what stays first.  So the cuts fall
among small rows, which makes the sizes near equal; only the classes a cut
touches or passes are rewritten, the rest of each shard's files stay as they
are.

The driver sees sums per shard and class and per hash range of the classes
with a cut: a fixed number of rows at any size of the table.  Rows reach their
shard by comparing (class, hash) with the cuts, without a join.

Defined results: a null text has size 1 and checksum 0 and stays null; rows
equal in id and text are dealt out like any others; an empty table has no rows;
a null id is an id like any other.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.session import run_dir

from . import common

OLD_SHARDS, NEW_SHARDS = 12, 16
#: hash ranges a class with a cut is summed by, and those slots are counted by
RANGES, SLOT_RANGES = 1024, 4096


# --- plan --------------------------------------------------------------------------
def min_cost_flow(supply: list[int], capacity: list[int], cost) -> dict[tuple[int, int], int]:
    """Flows (i, j) -> bytes that ship all supply at least cost (successive
    shortest paths).  ``cost(i, j)`` is the price per byte; capacities must
    hold the supply."""
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    left: dict[int, dict[int, int]] = defaultdict(dict)
    price: dict[tuple[int, int], int] = {}

    def edge(a, b, room, c):
        left[a][b], left[b][a] = room, 0
        price[a, b], price[b, a] = c, -c
    for i, s in enumerate(supply):
        edge(source, i, s, 0)
        for j in range(m):
            edge(i, n + j, s, cost(i, j))
    for j, c in enumerate(capacity):
        edge(n + j, sink, c, 0)
    if sum(capacity) < sum(supply):
        raise ValueError("capacities are too small")
    while True:
        far, via = {source: 0}, {}
        for _ in range(n + m + 2):  # Bellman-Ford; the graph is tiny
            changed = False
            for a in list(far):
                for b, room in left[a].items():
                    if room and far[a] + price[a, b] < far.get(b, 1 << 62):
                        far[b], via[b], changed = far[a] + price[a, b], a, True
            if not changed:
                break
        if sink not in far:
            break
        path, at = [], sink
        while at != source:
            path.append((via[at], at))
            at = via[at]
        push = min(left[a][b] for a, b in path)
        for a, b in path:
            left[a][b] -= push
            left[b][a] += push
    return {(i, j): left[n + j][i] for i in range(n) for j in range(m) if left[n + j][i]}


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def stretches(flows: dict[tuple[int, int], int], shard: int) -> list[tuple[int, int]]:
    """(new shard, bytes) in the order they are taken: what stays first."""
    own = [(j, f) for (i, j), f in flows.items() if i == shard]
    return sorted(own, key=lambda x: (x[0] != shard, x[0]))


# --- rows --------------------------------------------------------------------------
def row_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def size_class(size: Column) -> Column:
    return (F.length(F.bin(size)) - 1).cast("int")


def row_hash(doc_id: Column, text: Column, row: Column) -> Column:
    return F.xxhash64(doc_id, text, row)


def hash_range(h: Column, ranges: int) -> Column:
    """Number of the range of equal width that holds a signed 64-bit hash."""
    bits = ranges.bit_length() - 1
    return F.shiftright(h, 64 - bits) + F.lit(ranges // 2)


#: the number a row is stored with; it only tells equal rows apart
ROW = "_row"


def write_shards(docs: DataFrame, shard: Column, folder: str) -> None:
    """``docs`` as files below shard=i/class=c; large ones are split.  ``shard``
    may use the number of the row."""
    rows = docs.withColumn(ROW, F.monotonically_increasing_id()).withColumn("shard", shard).withColumn("class", size_class(row_size(F.col("text"))))
    rows.hint("rebalance", "shard", "class").write.option("compression", "zstd").partitionBy("shard", "class").parquet(folder)


def read_shards(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, {ROW} long, shard int, class int").parquet(folder)


def plan_cuts(keys: DataFrame, capacity: list[int]) -> tuple[dict, dict[int, list[tuple[int, tuple[int, int] | None]]]]:
    """Flows, and for each old shard its new shards in order, each with the
    (class, hash) at which its stretch begins (None: from the start).

    ``keys``: stored table (shard, class, h, size)."""
    sums = {(r["shard"], r["class"]): r["s"] for r in
            keys.groupBy("shard", "class").agg(F.sum("size").alias("s")).collect()}
    shards = max([s for s, _ in sums], default=-1) + 1
    supply = [sum(v for (s, _), v in sums.items() if s == i) for i in range(shards)]
    flows = min_cost_flow(supply, capacity, lambda i, j: int(i != j))
    # the class that holds each cut, and how far into it the cut is
    todo: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)  # (shard, class) -> (bytes in, new shard)
    out: dict[int, list] = {}
    for i in range(shards):
        at, out[i] = 0, []
        for n, (j, size) in enumerate(stretches(flows, i)):
            if n == 0:
                out[i].append((j, None))
            else:
                done = 0
                for c in sorted({c for s, c in sums if s == i}, reverse=True):
                    if at < done + sums[i, c]:
                        todo[i, c].append((at - done, j))
                        break
                    done += sums[i, c]
            at += size
    if todo:
        for (i, _), j, where in _locate(keys, todo):
            out[i].append((j, where))
    order = {i: {j: n for n, (j, _) in enumerate(stretches(flows, i))} for i in out}
    return flows, {i: sorted(x, key=lambda y: order[i][y[0]]) for i, x in out.items()}


def _locate(keys: DataFrame, todo: dict):
    """The first row of each cut: first its hash range, then the row, which is
    the one whose middle lies beyond the cut."""
    spark = keys.sparkSession
    cells = ", ".join(f"({i}, {c})" for i, c in todo)
    cells = F.broadcast(spark.sql(f"SELECT * FROM VALUES {cells} AS t(_shard, _class)"))
    ranged = keys.withColumn("range", hash_range(F.col("h"), RANGES))
    sums: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for r in (ranged.join(cells, (F.col("shard") == F.col("_shard")) & (F.col("class") == F.col("_class")))
              .groupBy("shard", "class", "range").agg(F.sum("size").alias("s")).collect()):
        sums[r["shard"], r["class"]].append((r["range"], r["s"]))
    wanted = []
    for (i, c), cuts in todo.items():
        for at, j in cuts:
            done = 0
            for r, s in sorted(sums[i, c]):
                if at < done + s:
                    wanted.append((i, c, r, at - done, j))
                    break
                done += s
    rows = ", ".join(f"({i}, {c}, {r}, {at}L, {j})" for i, c, r, at, j in wanted)
    cuts = F.broadcast(spark.sql(f"SELECT * FROM VALUES {rows} AS t(_shard, _class, _range, _at, _to)"))
    before = Window.partitionBy("shard", "class", "range").orderBy("h").rangeBetween(Window.unboundedPreceding, -1)
    in_cut = ranged.join(F.broadcast(cuts.select("_shard", "_class", "_range").distinct()),
                         (F.col("shard") == F.col("_shard")) & (F.col("class") == F.col("_class"))
                         & (F.col("range") == F.col("_range")), "left_semi")
    placed = in_cut.groupBy("shard", "class", "range", "h").agg(F.sum("size").alias("size")).withColumn(
        "before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    found = {(r["_shard"], r["_class"], r["_to"]): r["h"] for r in
             placed.join(cuts, (F.col("shard") == F.col("_shard")) & (F.col("class") == F.col("_class"))
                         & (F.col("range") == F.col("_range")) & (F.col("before") + F.col("size") / 2 >= F.col("_at")))
             .groupBy("_shard", "_class", "_to").agg(F.min("h").alias("h")).collect()}
    for i, c, r, _, j in wanted:
        # past the range's last row: the next range begins the stretch
        begin = found.get((i, c, j), ((r + 1 - RANGES // 2) << (64 - RANGES.bit_length() + 1)))
        yield (i, c), j, (c, begin)


def new_shard(cuts: dict, shard: Column, cls: Column, h: Column) -> Column:
    """The shard a row goes to: that of the last stretch that begins at or
    before its (class, hash); larger classes come first."""
    out = shard
    for i, own in cuts.items():
        to = F.lit(own[0][0]) if own else shard
        for j, (c, begin) in own[1:]:
            to = F.when((cls < c) | ((cls == c) & (h >= F.lit(begin))), F.lit(j)).otherwise(to)
        out = F.when(shard == i, to).otherwise(out)
    return out


def reshard(spark: SparkSession, old: str, new: str, schema: str, capacity: list[int] | int):
    """Move the table in folder ``old`` to new capacities (a number of shards
    means equal ones).  Rows that move, and those that share a class with a
    cut, are written below ``new``; returns (table over both folders with the
    new shard and the old one, flows)."""
    rows = read_shards(spark, old, schema)
    rows = rows.withColumn("h", row_hash(F.col("doc_id"), F.col("text"), F.col(ROW)))
    keys = common.stored(rows.select("shard", "class", "h", row_size(F.col("text")).alias("size")), "shard-keys")
    if isinstance(capacity, int):
        capacity = equal_capacities(keys.agg(F.sum("size")).first()[0] or 0, capacity)
    flows, cuts = plan_cuts(keys, capacity)
    # a shard's files of classes above its first cut stay
    touched = F.lit(False)
    for i, own in cuts.items():
        if own and own[0][0] != i:
            touched = touched | (F.col("shard") == i)
        elif len(own) > 1:
            touched = touched | ((F.col("shard") == i) & (F.col("class") <= max(c for _, (c, _) in own[1:])))
    moved = (rows.where(touched).withColumn("old_shard", F.col("shard"))
             .withColumn("shard", new_shard(cuts, F.col("shard"), F.col("class"), F.col("h"))))
    (moved.drop("h").hint("rebalance", "shard", "class").write.option("compression", "zstd")
     .partitionBy("shard", "class").parquet(new))
    back = spark.read.schema(f"{schema}, {ROW} long, old_shard int, shard int, class int").parquet(new)
    stayed = read_shards(spark, old, schema).where(~touched).withColumn("old_shard", F.col("shard"))
    return stayed.unionByName(back), flows


def slots(rows: DataFrame) -> DataFrame:
    """``slot``: place of each row in its shard, without gaps from 0.  Counted
    by hash range first, so that no task numbers a whole shard."""
    rows = common.stored(rows.withColumn("range", hash_range(F.col("h"), SLOT_RANGES)), "shard-rows")
    counts = rows.groupBy("shard", "range").count()
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("shard").alias("_shard"), F.col("range").alias("_range"),
                           F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "range").orderBy("h", "doc_id", "text_crc32", "size")
    return (rows.withColumn("n", F.row_number().over(inside) - 1)
            .join(counts, (F.col("shard") == F.col("_shard")) & (F.col("range") == F.col("_range")))
            .withColumn("slot", (F.col("first") + F.col("n")).cast("long")))


def shard_table(docs: DataFrame, old_shards: int = OLD_SHARDS, new_shards: int = NEW_SHARDS) -> DataFrame:
    """``docs``, laid out in ``old_shards`` shards by hash, resharded; one row
    per document, read back from the files."""
    spark = docs.sparkSession
    folder = run_dir(spark, "shards")
    docs = docs.select("doc_id", "text")
    by_hash = F.pmod(F.xxhash64("doc_id", ROW, F.lit("shard")), F.lit(old_shards)).cast("int")
    write_shards(docs, by_hash, f"{folder}/old")
    table, _ = reshard(spark, f"{folder}/old", f"{folder}/new", "doc_id long, text string", new_shards)
    rows = table.select("doc_id", row_size(F.col("text")).alias("size"),
                        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"), "shard", "old_shard",
                        row_hash(F.col("doc_id"), F.col("text"), F.col(ROW)).alias("h"))
    return slots(rows).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                              F.lit(None).cast("int").alias("grown_shard"), "old_shard")
