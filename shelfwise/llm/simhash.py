"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint's bit is 1 if it is set in over half the XXH64 hashes (seed 42)
of the text's word shingles.  Two fingerprints link when at most ``DISTANCE``
bits differ.  The distinct fingerprints form a binary trie; the join walks
pairs of its nodes from the top, adds one to a pair's error wherever the two
sides take different branches, and drops a pair once its error passes the
budget.  To spread the walk, the 64 bits are cut into ``DISTANCE + SHARED``
bands: two linked fingerprints agree in all bits of at least ``SHARED`` of
them.  For each choice of so many bands the trie is built over the bits with
these bands first, so it falls into independent subtries below them, and each
subtrie is walked with the whole budget for the bits that are left.  With two
shared bands, 15 orders of the bits have 20 bits or more in front, so a subtrie
of evenly spread fingerprints stays within ``MAX_SUBTRIE`` up to four billion
of them, and what is shuffled grows with their number.  A subtrie with more
than ``MAX_SUBTRIE`` fingerprints is dealt into parts, and every pair of parts
is a walk of its own, so no task holds a hot subtrie.

A walk reports a spanning forest of the links it finds, not all pairs, and the
forests are joined into components.  Equal texts meet earlier, in one
fingerprint, so copies are never paired.

Defined results: a null text, an empty one and one without words have
fingerprint zero, which links like any other; fewer words than a shingle are
one shingle; component ids are the smallest id that isn't null (null if all
are); repeated documents are documents of their own.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

SHINGLE, DISTANCE, SEED = 4, 4, 42
#: bands that two linked fingerprints are sure to agree in, and that subtries hang below
SHARED = 2
MAX_SUBTRIE = 4096
ROWS_PER_TASK = 50_000
#: node pairs walked at once, and hashes unpacked at once
MAX_PAIRS, MAX_HASHES = 1 << 20, 1 << 16
MAX_BROADCAST_ROWS = 10_000


def text_fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Fingerprint of one text as an unsigned integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # A-Z and ASCII space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = ends[size - 1:] if len(words) >= size else ends[-1:]
    set_bits, n = np.zeros(64, np.int64), len(last)
    for i in range(0, n, MAX_HASHES):
        spans = zip(starts[i:min(n, i + MAX_HASHES)].tolist(), last[i:i + MAX_HASHES].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint's 64 bits as a (signed) long column."""
    @F.pandas_udf("long")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([text_fingerprint(t, size) for t in texts], np.uint64).view(np.int64))
    return udf.asNondeterministic()(text)


# --- walk --------------------------------------------------------------------------
def orders(budget: int, shared: int) -> list[list[tuple[int, int]]]:
    """Each choice of ``shared`` out of ``budget + shared`` bands that cover the
    64 bits, as all bands (first bit, width) with the chosen ones in front."""
    n = budget + shared
    cuts = [round(64 * i / n) for i in range(n + 1)]
    bands = [(a, b - a) for a, b in itertools.pairwise(cuts)]
    return [[*chosen, *(x for x in bands if x not in chosen)] for chosen in itertools.combinations(bands, shared)]


def arranged(values: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    """The bits of ``values`` with their bands in another order."""
    out = np.zeros_like(values)
    for first, width in order:
        out = (out << np.uint64(width)) | (values << np.uint64(first) >> np.uint64(64 - width))
    return out


def subtrie_of(fp: Column, chosen: list[tuple[int, int]]) -> Column:
    """The bits of the chosen bands as one number: the subtrie's place."""
    out = F.lit(0).cast("long")
    for first, width in chosen:
        band = F.shiftrightunsigned(F.shiftleft(fp, first), 64 - width)
        out = F.shiftleft(out, width).bitwiseOR(band)
    return out


def linked_pairs(values: np.ndarray, roots: np.ndarray | list[tuple[int, int, int, int]], budget: int, depth: int):
    """Pairs of positions in ``values`` that differ in at most ``budget`` bits.

    ``values`` is sorted within each range of ``roots`` (a_low, a_high, b_low,
    b_high); the values of a root's two ranges share their first ``depth``
    bits.  A root of two equal ranges is joined with itself.  Yields arrays of
    positions, a bounded number at a time."""
    ones: dict[int, np.ndarray] = {}
    stack = [(depth, np.array(roots, np.int64).reshape(-1, 4), np.zeros(len(roots), np.int64))]
    while stack:
        level, pairs, error = stack.pop()
        if len(pairs) > MAX_PAIRS:
            half = len(pairs) // 2
            stack += [(level, pairs[:half], error[:half]), (level, pairs[half:], error[half:])]
            continue
        # pairs of leaves need no further walk: count what is left of their bits
        leaf = (pairs[:, 1] - pairs[:, 0] == 1) & (pairs[:, 3] - pairs[:, 2] == 1)
        if leaf.any():
            a, b = pairs[leaf, 0], pairs[leaf, 2]
            near = (np.bitwise_count(values[a] ^ values[b]) <= budget) & (a != b)
            if near.any():
                yield a[near], b[near]
            pairs, error = pairs[~leaf], error[~leaf]
        if not len(pairs) or level == 64:
            continue
        if level not in ones:
            bit = (values >> np.uint64(63 - level)) & np.uint64(1)
            ones[level] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        count = ones[level]
        a0, a2, b0, b2 = pairs.T
        a1, b1 = a2 - (count[a2] - count[a0]), b2 - (count[b2] - count[b0])  # where the one-branches begin
        own = a0 == b0
        children = [np.stack([a0, a1, b0, b1], 1), np.stack([a1, a2, b1, b2], 1),
                    np.stack([a0, a1, b1, b2], 1), np.stack([a1, a2, b0, b1], 1)[~own]]
        errors = [error, error, error + 1, error[~own] + 1]
        pairs, error = np.concatenate(children), np.concatenate(errors)
        live = (error <= budget) & (pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3])
        live &= (pairs[:, 0] != pairs[:, 2]) | (pairs[:, 1] - pairs[:, 0] > 1)  # a leaf with itself
        stack.append((level + 1, pairs[live], error[live]))


class Forest:
    """Union-find over positions, fed with arrays of links."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def _settle(self) -> None:
        while (nxt := self.up[self.up]).tobytes() != self.up.tobytes():
            self.up = nxt

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.up[a], self.up[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))
            self._settle()


def _walk(budget: int, shared: int):
    every = orders(budget, shared)

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        """One bucket of subtries: (band, subtrie, part_a, part_b, side, fp),
        band being the number of the order."""
        out = []
        for band, own in rows.groupby("band", sort=False):
            depth = sum(width for _, width in every[band][:shared])
            value = arranged(own["fp"].to_numpy(np.int64).view(np.uint64), every[band])
            task = own.groupby(["subtrie", "part_a", "part_b"], sort=False).ngroup().to_numpy()
            side = own["side"].to_numpy()
            order = np.lexsort((value, side, task))
            value, task, side = value[order], task[order], side[order]
            edges = np.flatnonzero(np.concatenate([[True], (task[1:] != task[:-1]) | (side[1:] != side[:-1]), [True]]))
            low, high = edges[:-1], edges[1:]
            alone = (side[low] == 0) & (high - low > 1)
            both = np.flatnonzero((side[low[:-1]] == 1) & (task[low[:-1]] == task[low[1:]]))
            roots = np.concatenate([np.stack([low, high, low, high], 1)[alone],
                                    np.stack([low[both], high[both], low[both + 1], high[both + 1]], 1)])
            forest = Forest(len(value))
            for a, b in linked_pairs(value, roots, budget, depth):
                forest.add(a, b)
            child = np.flatnonzero(forest.up != np.arange(len(value)))
            fp = own["fp"].to_numpy(np.int64)[order]
            out.append(pd.DataFrame({"a": fp[forest.up[child]], "b": fp[child]}))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    return walk


def links(fps: DataFrame, budget: int = DISTANCE, shared: int = SHARED) -> DataFrame:
    """Spanning edges (a, b) of the graph that links the distinct fingerprints
    ``fp`` of a stored table at ``budget`` or fewer differing bits."""
    subtrie = [subtrie_of(F.col("fp"), order[:shared]) for order in orders(budget, shared)]
    rows = fps.select("fp", F.posexplode(F.array(*subtrie)).alias("band", "subtrie"))
    hot = (rows.groupBy("band", "subtrie").count().where(F.col("count") > MAX_SUBTRIE)
           .select(F.col("band").alias("_b"), F.col("subtrie").alias("_s"),
                   F.ceil(F.col("count") / MAX_SUBTRIE).cast("int").alias("parts")))
    hot = common.broadcast_if_small(common.stored(hot, "simhash-hot"), MAX_BROADCAST_ROWS)
    rows = rows.join(hot, (F.col("band") == F.col("_b")) & (F.col("subtrie") == F.col("_s")), "left")
    part = F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int")
    rows = rows.withColumn("part", part).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    # side 0: the part with itself; 1 and 2: the two parts of a pair
    side = F.when(F.col("part") == F.col("other"), 0).when(F.col("part") < F.col("other"), 1).otherwise(2)
    rows = rows.select("band", "subtrie", F.least("part", "other").alias("part_a"),
                       F.greatest("part", "other").alias("part_b"), side.alias("side"), "fp")
    buckets = max(1, -(-fps.count() * len(subtrie) // ROWS_PER_TASK))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("band", "subtrie", "part_a", "part_b"), F.lit(buckets)))
    return rows.groupBy("bucket").applyInPandas(
        lambda got: _walk(budget, shared)(got), "a long, b long")


def groups(prints: DataFrame, budget: int = DISTANCE) -> DataFrame:
    """(fp, root, component_id) for each distinct ``fp`` of the stored table
    ``prints`` (doc_id, fp)."""
    fps = common.stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(links(fps, budget)).withColumnRenamed("root", "_root")
    fps = common.stored(fps.join(roots, F.col("fp") == F.col("node"), "left")
                        .select("fp", "first", F.coalesce("_root", "fp").alias("root")), "simhash-roots")
    # stored, so that the join can split a root with many fingerprints
    least = common.stored(fps.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("component_id")), "simhash-least")
    return fps.join(least, F.col("root") == F.col("_root")).select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, budget: int = DISTANCE) -> DataFrame:
    """One row per document: id, fingerprint as 16 hex digits, component."""
    common.small_batches(docs.sparkSession)
    prints = common.stored(docs.select("doc_id", fingerprint(F.col("text"), size).alias("fp")), "simhash-prints")
    found = groups(prints, budget).withColumnRenamed("fp", "_fp")
    return (prints.join(found, F.col("fp") == F.col("_fp"))
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, size: int = SHINGLE, budget: int = DISTANCE) -> DataFrame:
    """One document of each component, with the columns it had: the one of the
    smallest (id, text hash), rows without an id last; of rows equal in both,
    one."""
    common.small_batches(docs.sparkSession)
    key = F.xxhash64("text")
    prints = common.stored(docs.select("doc_id", key.alias("h"), fingerprint(F.col("text"), size).alias("fp")),
                           "simhash-prints")
    found = groups(prints, budget).withColumnRenamed("fp", "_fp")
    placed = common.stored(prints.join(found, F.col("fp") == F.col("_fp")).groupBy("root", "doc_id", "h")
                           .agg(F.count("*").alias("n")), "simhash-placed")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "h")
    first = common.stored(placed.groupBy(F.col("root").alias("_root")).agg(F.min(order).alias("k")), "simhash-kept")
    keeps = F.col("doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("h") == F.col("k.h"))
    # (id, hash) of what goes, and of what stays once though it is there more often
    special = (placed.join(first, F.col("root") == F.col("_root")).withColumn("repeated", keeps)
               .where(~F.col("repeated") | (F.col("n") > 1))
               .select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "repeated"))
    return _without(docs, common.stored(special, "simhash-special"))


def _without(docs: DataFrame, special: DataFrame) -> DataFrame:
    """``docs`` without the rows (id, text hash) of the stored table ``special``,
    of those marked ``repeated`` with one.  Only rows that a Bloom filter of
    them lets pass are shuffled."""
    held = docs.select(F.struct("*").alias("_doc")).withColumn("_key", F.xxhash64("_doc.text"))
    held = held.withColumn("_both", F.xxhash64("_doc.doc_id", "_key"))
    held = common.possible(held, "_both", special.select(F.xxhash64("_id", "_h").alias("k")), "k")
    checked = held.where("_possible").join(
        special, F.col("_doc.doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_h")), "left")
    checked = checked.where(F.coalesce("repeated", F.lit(True)))
    if not special.where("repeated").isEmpty():
        once = F.when(F.col("repeated"), F.struct("_id", "_h", F.lit(0).cast("long").alias("row"))).otherwise(
            F.struct(F.lit(None).cast("long").alias("_id"), F.lit(None).cast("long").alias("_h"),
                     F.monotonically_increasing_id().alias("row")))
        checked = checked.withColumn("_once", once).dropDuplicates(["_once"])
    columns = [F.col("_doc")[c].alias(c) for c in docs.columns]
    return held.where("NOT _possible").select(*columns).unionByName(checked.select(*columns))
