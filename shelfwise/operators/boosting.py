"""Gradient-boosted regression trees grown leaf by leaf (K3), on Spark.

A tree grows best first: of all leaves the one whose split gains most is split
next, until the tree has ``leaves`` of them.  Rows are kept as blocks (binned
features, label, score), one table in the shared folder.  A round begins by
adding the last tree to the scores and drawing its rows; the blocks with its
gradients are kept until the next round has made its own, so a pass reads
what it sums and nothing is scored twice.  A pass sums the gradient histograms
of all nodes that growth is waiting for, following only the branches that lead
to them, and the driver sees one histogram a node: a number for each bin of the
features drawn, however many rows there are.  Growth doesn't wait for one split at a time: it goes on with the leaves
whose histograms are known, gathers all it would split, and one pass then
serves them together; once all are known, the order of splits is exactly best
first.  A pass sums only the smaller child of a node, the other is the
difference.  A pass takes a job however few rows its nodes have, so what grows
below a node of at most ``LOCAL_ROWS`` rows is left to one task: the rows of
all such nodes are dealt out by node, and each task grows its subtree best
first, from the same sums, as far as the tree can want it.

Gradients are whole numbers (``UNIT`` parts of one), so every sum is exact and
the same trees grow under any partitioning; rows and features are drawn by
hashes of the row's key and the round.  After each round the error on the
validation rows is known from the next round's first pass; training ends when
``patience`` rounds bring nothing better, and the trees after the best round
are cut off.

The passes run as RDD jobs over blocks, as Spark's own tree trainers do: a tree
of them per round is too many to plan, and what each sends is one numpy array,
added up in a tree (``treeReduce``) where there are many.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_dir

#: parts of one unit of the label that gradients are counted in; accuracy of the cut points
UNIT, QUANTILE_ACCURACY = 1 << 14, 20_000
#: rounds after which the scores in the blocks' table are brought up to date; rows that a task of a pass takes on at
#: most, and at least while there are cores; rows of a block; tasks whose sums are added up by the driver
ROUNDS_PER_TABLE, ROWS_PER_TASK, ROWS_LEAST, BLOCK_ROWS, SUMS = 25, 200_000, 4_000, 50_000, 16
#: rows of a node whose subtree one task grows, at most
LOCAL_ROWS = 50_000


@dataclass(frozen=True)
class Params:
    """The trainer's settings; the defaults are those of the price model."""
    rounds: int = 300
    leaves: int = 63
    rate: float = 0.05
    feature_share: float = 0.8
    row_share: float = 0.8
    rows_drawn_every: int = 5
    min_rows: int = 20
    bins: int = 255
    patience: int = 30
    seed: int = 42


@dataclass
class Tree:
    """Nodes in order of their making; a leaf has feature -1.  Rows with
    ``value <= threshold`` go left."""
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, threshold: float) -> tuple[int, int]:
        first = len(self.feature)
        for _ in range(2):
            for column, empty in ((self.feature, -1), (self.cut, 0), (self.threshold, 0.0), (self.left, 0), (self.right, 0),
                                  (self.value, 0.0)):
                column.append(empty)
        self.feature[node], self.cut[node], self.threshold[node] = feature, cut, threshold
        self.left[node], self.right[node] = first, first + 1
        return first, first + 1

    def reached(self, columns: np.ndarray, rows: np.ndarray, by: str, wanted: list[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """Each wanted leaf, by default all, with those of ``rows`` that end in
        it; ``columns`` [feature, row], ``by`` cut (bins) or threshold (values)."""
        limits = getattr(self, by)
        leaves = {n for n, f in enumerate(self.feature) if f < 0}
        leaves = leaves if wanted is None else leaves & set(wanted)
        needed = set(leaves)
        for n in range(len(self.feature) - 1, -1, -1):  # children come after their parent
            if self.feature[n] >= 0 and (self.left[n] in needed or self.right[n] in needed):
                needed.add(n)
        waiting = [(0, rows)] if 0 in needed else []
        while waiting:
            node, rows = waiting.pop()
            if node in leaves:
                yield node, rows
                continue
            low = columns[self.feature[node]][rows] <= limits[node]
            if self.left[node] in needed:
                waiting.append((self.left[node], rows[low]))
            if self.right[node] in needed:
                waiting.append((self.right[node], rows[~low]))

    def values(self, columns: np.ndarray, by: str) -> np.ndarray:
        """The value of each row's leaf."""
        out = np.zeros(columns.shape[1])
        for node, rows in self.reached(columns, np.arange(len(out)), by):
            out[rows] = self.value[node]
        return out


# --- blocks ------------------------------------------------------------------------
BLOCK = "bins binary, label binary, score binary, key binary, train binary"


def cut_points(rows: DataFrame, features: int, bins: int) -> list[np.ndarray]:
    """Upper bounds of all bins but the last, for each feature: quantiles of
    the training rows, in one aggregate of bounded size."""
    share = [F.lit((i + 1) / bins) for i in range(bins - 1)]
    found = rows.agg(*[F.percentile_approx(F.col("x")[i], F.array(*share), QUANTILE_ACCURACY).alias(f"q{i}")
                       for i in range(features)]).first()
    return [np.unique(np.array(q or [], np.float64)) for q in found]


def to_blocks(rows: DataFrame, cuts: list[np.ndarray], start: float) -> DataFrame:
    """One row per ``BLOCK_ROWS`` rows about: features as bins, label, score,
    key, and whether the row trains (1) or validates (0)."""
    def joined(batches):
        some, n = [], 0
        for batch in batches:
            some, n = [*some, batch], n + batch.num_rows
            if n >= BLOCK_ROWS:
                yield pa.concat_batches(some)
                some, n = [], 0
        if n:
            yield pa.concat_batches(some)

    def run(batches):
        for batch in joined(batches):
            n = batch.num_rows
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            bins = np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)]).astype(np.uint8)
            column = [bins.tobytes(), batch["y"].to_numpy(zero_copy_only=False).astype("<f8").tobytes(),
                      np.full(n, start, "<f8").tobytes(), batch["key"].to_numpy().astype("<i8").tobytes(),
                      batch["train"].to_numpy(zero_copy_only=False).astype("u1").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in column],
                                             names=["bins", "label", "score", "key", "train"])
    return rows.mapInArrow(run, BLOCK)


def rescored(blocks: DataFrame, trees: list[Tree], rate: float) -> DataFrame:
    def run(batches):
        for batch in batches:
            out = [_score(row, trees, rate).astype("<f8").tobytes() for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()) if c == "score" else batch[c] for c in
                                              batch.schema.names], names=batch.schema.names)
    return blocks.mapInArrow(run, BLOCK)


def _score(row, trees: list[Tree], rate: float) -> np.ndarray:
    score = np.frombuffer(row["score"], "<f8")
    bins = np.frombuffer(row["bins"], "u1").reshape(-1, len(score))
    for tree in trees:
        score = score + rate * tree.values(bins, "cut")
    return score


def mixed(key: np.ndarray, salt: int) -> np.ndarray:
    """Uniform in [0, 1) from keys and a salt (splitmix64)."""
    with np.errstate(over="ignore"):
        z = key.astype(np.uint64) + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        z ^= z >> np.uint64(31)
    return z / 2.0 ** 64


@dataclass
class Block:
    """A block at the beginning of a round: its rows, those drawn for the
    round's tree, and the gradients of these."""
    bins: np.ndarray
    label: np.ndarray
    score: np.ndarray
    key: np.ndarray
    train: np.ndarray
    drawn: np.ndarray | None = None
    gradient: np.ndarray | None = None

    @classmethod
    def opened(cls, row) -> Block:
        label = np.frombuffer(row["label"], "<f8")
        return cls(np.frombuffer(row["bins"], "u1").reshape(-1, len(label)), label, np.frombuffer(row["score"], "<f8"),
                   np.frombuffer(row["key"], "<i8"), np.frombuffer(row["train"], "u1") > 0)

    def begun(self, tree: Tree | None, rate: float, salt: int, share: float) -> Block:
        """The block with the last round's ``tree`` in its scores, and the rows
        drawn for the next."""
        score = self.score + rate * tree.values(self.bins, "cut") if tree else self.score
        drawn = np.flatnonzero(self.train & (mixed(self.key, salt) < share))
        # whole numbers below 2**53: sums are exact
        return Block(self.bins, self.label, score, self.key, self.train, drawn, np.rint((score - self.label)[drawn] * UNIT))

    def members(self, tree: Tree, wanted: list[int], features: list[int]) -> Iterator[tuple[int, tuple]]:
        """The drawn rows of each wanted leaf: bins of ``features``, gradients."""
        gradient = np.zeros(len(self.label))
        gradient[self.drawn] = self.gradient
        for node, rows in tree.reached(self.bins, self.drawn, "cut", wanted):
            if len(rows):
                yield node, (self.bins[features][:, rows], gradient[rows])


def block_sums(block: Block, tree: Tree, wanted: list[int], features: list[int], widths: list[int]) -> np.ndarray:
    """What one block adds: two numbers of the validation error (with the root
    or without nodes only), then for each wanted node two rows, of gradients
    and of row counts, with ``widths`` bins for each of ``features``."""
    out = np.zeros(2 + len(wanted) * 2 * sum(widths), np.int64)
    if wanted in ([], [0]):
        held = ~block.train
        out[0] = np.rint(np.abs(block.score - block.label)[held] * UNIT).astype(np.int64).sum()
        out[1] = np.count_nonzero(held)
    place = {node: i for i, node in enumerate(wanted)}
    at = np.full(len(block.label), -1)
    for node, rows in tree.reached(block.bins, block.drawn, "cut", wanted):
        at[rows] = place[node]
    node = at[block.drawn]
    inside = np.flatnonzero(node >= 0)
    node, rows, gradient = node[inside], block.drawn[inside], block.gradient[inside]
    hist, first = out[2:].reshape(len(wanted), 2, sum(widths)), 0
    for f, width in zip(features, widths, strict=True):
        slot, n = node * width + block.bins[f][rows], len(wanted) * width
        hist[:, 0, first:first + width] = np.rint(np.bincount(slot, gradient, n)).astype(np.int64).reshape(-1, width)
        hist[:, 1, first:first + width] = np.bincount(slot, minlength=n).reshape(-1, width)
        first += width
    return out


def added(blocks, tree: Tree, wanted: list[int], features: list[int], widths: list[int]) -> Iterator[np.ndarray]:
    """The sums of all blocks of a task."""
    total = None
    for block in blocks:
        sums = block_sums(block, tree, wanted, features, widths)
        total = sums if total is None else np.add(total, sums, out=total)
    if total is not None:
        yield total


# --- one tree ----------------------------------------------------------------------
def best_split(hist: np.ndarray, features: list[int], min_rows: int) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the split that reduces the squared error most;
    of equal ones the first feature and bin.  ``hist`` [2, feature, bin] has
    ``features`` in order."""
    g, n = hist[0].astype(np.float64), hist[1]
    total, rows = g[0].sum(), n[0].sum()
    low, below = np.cumsum(g, axis=1)[:, :-1], np.cumsum(n, axis=1)[:, :-1]
    least = max(1, min_rows)
    fits = (below >= least) & (rows - below >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, low ** 2 / below + (total - low) ** 2 / (rows - below) - total ** 2 / rows, -np.inf)
    if not gain.size:
        return None
    f, b = np.unravel_index(np.argmax(gain), gain.shape)
    return (float(gain[f, b]), features[f], int(b)) if gain[f, b] > 0 else None


def subtree(bins: np.ndarray, gradient: np.ndarray, features: list[int], widths: list[int], most: int,
            min_rows: int) -> list[tuple]:
    """Up to ``most`` splits below a node with these rows (``bins`` [feature,
    row] of ``features``), best first: (node, (gain, feature, bin), (gradient
    and rows of the left child), (those of the right)); the node is 0 and a
    split's children are numbered on in order."""
    def summed(rows: np.ndarray) -> np.ndarray:
        hist, g = np.zeros((2, len(features), max(widths)), np.int64), gradient[rows]
        for i, width in enumerate(widths):
            hist[0, i, :width] = np.rint(np.bincount(bins[i][rows], g, width)).astype(np.int64)
            hist[1, i, :width] = np.bincount(bins[i][rows], minlength=width)
        return hist
    nodes = [np.arange(len(gradient))]
    hists, out, heap = {0: summed(nodes[0])}, [], []

    def offered(node: int) -> None:
        split = best_split(hists[node], features, min_rows)
        if split:
            heapq.heappush(heap, (-split[0], node, split))
        else:
            del hists[node]
    offered(0)
    while heap and len(out) < most:
        _, node, split = heapq.heappop(heap)
        f = features.index(split[1])
        low = bins[f][nodes[node]] <= split[2]
        first, hist = len(nodes), hists.pop(node)
        nodes += [nodes[node][low], nodes[node][~low]]
        nodes[node] = None
        small = first + int(len(nodes[first]) > len(nodes[first + 1]))
        hists[small] = summed(nodes[small])
        hists[2 * first + 1 - small] = hist - hists[small]
        out.append((node, split, *[(int(hists[n][0, 0].sum()), len(nodes[n])) for n in (first, first + 1)]))
        offered(first)
        offered(first + 1)
    return out


def grow(sums, subtrees, features: list[int], cuts: list[np.ndarray], params: Params) -> tuple[Tree, np.ndarray]:
    """A tree by best-first growth.  ``sums(tree, wanted)`` gives validation
    sums and the histograms of some of the tree's leaves, ``subtrees(tree,
    wanted)`` for each wanted leaf as many splits below it, best first, as the
    number that stands beside it.

    ``known`` is the tree of all nodes looked at so far; the result repeats
    its splits in best-first order."""
    known, hists, kids, splits, totals = Tree(), {}, {}, {}, {}

    def met(node: int, hist: np.ndarray) -> None:
        hists[node], totals[node] = hist, (int(hist[0, 0].sum()), int(hist[1, 0].sum()))
        splits[node] = best_split(hist, features, params.min_rows)

    def parted(node: int) -> tuple[int, int]:
        _, f, b = splits[node]
        kids[node] = known.split(node, f, b, float(cuts[f][b]))
        return kids[node]
    error, found = sums(known, [0])
    met(0, found[0])
    while True:
        # best first over what is known; leaves to split whose children aren't, and the splits before them
        order, waiting = [], {}
        heap = [(-splits[0][0], 0)] if splits[0] else []
        while heap and len(order) < params.leaves - 1:
            _, node = heapq.heappop(heap)
            if node not in kids:
                waiting[node] = len(order)
            order.append(node)
            for child in kids.get(node, ()):
                if splits.get(child):
                    heapq.heappush(heap, (-splits[child][0], child))
        if not waiting:
            break
        large = [node for node in waiting if totals[node][1] > LOCAL_ROWS]
        if not large:
            # the tree can't want more than the splits that the ones before leave
            most = {node: params.leaves - 1 - before for node, before in waiting.items()}
            below = subtrees(known, most)
            for node in waiting:
                names = [node]
                for at, split, *of in below[node]:
                    splits[names[at]] = split
                    names += parted(names[at])
                    totals.update(zip(names[-2:], of, strict=True))
            continue
        small, pairs = [], []
        for node in large:
            _, f, b = splits[node]
            both, rows = parted(node), hists[node][1, features.index(f)]
            first = int(rows[:b + 1].sum() * 2 > rows.sum())  # sum the child with fewer rows
            small.append(both[first])
            pairs.append((node, both[first], both[1 - first]))
        _, found = sums(known, small)
        for (node, summed, other), hist in zip(pairs, found, strict=True):
            met(summed, hist)
            met(other, hists.pop(node) - hist)
    tree, names = Tree(), {0: 0}
    for node in order:
        _, f, b = splits[node]
        names.update(zip(kids[node], tree.split(names[node], f, b, float(cuts[f][b])), strict=True))
    for node, name in names.items():
        g, n = totals[node]
        tree.value[name] = -g / n / UNIT if n else 0.0
    return tree, error


# --- model -------------------------------------------------------------------------
@dataclass
class Booster:
    """A fitted ensemble: ``start`` plus ``rate`` times the trees' values."""
    start: float
    rate: float
    trees: list[Tree]
    best_round: int
    rounds: int
    errors: list[float]  # mean absolute error on the validation rows after 0, 1, 2, ... rounds

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        columns = np.ascontiguousarray(x.T)
        for tree in self.trees:
            out = out + self.rate * tree.values(columns, "threshold")
        return out

    def column(self, features: str = "features") -> Column:
        """The prediction from a column of feature vectors, batch by batch."""
        @F.pandas_udf("double")
        def udf(rows: pd.Series) -> pd.Series:
            return pd.Series(self.predict(np.stack(rows.to_numpy())) if len(rows) else [], dtype="float64")
        return udf(vector_to_array(F.col(features)))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.column())

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per tree and one (tree -1) for what holds for all."""
        head = {k: getattr(self, k) for k in ("start", "rate", "best_round", "rounds", "errors")}
        rows = [(-1, json.dumps(head))] + [(i, json.dumps(asdict(t))) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, "tree int, json string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Booster:
        rows = spark.read.schema("tree int, json string").parquet(path).orderBy("tree").collect()
        return cls(trees=[Tree(**json.loads(r["json"])) for r in rows[1:]], **json.loads(rows[0]["json"]))


def fit(rows: DataFrame, features: str, label: str, key: str, validation: str, params: Params = Params()) -> Booster:
    """Fit on the rows of ``rows`` whose ``validation`` is false; the others
    choose the number of rounds.  Rows without a label are left out; without
    any row to train on the model is the constant 0, without a row to validate
    all rounds are kept."""
    spark = rows.sparkSession
    rows = rows.where(F.col(label).isNotNull()).select(
        vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"), F.xxhash64(key).alias("key"),
        (~F.coalesce(F.col(validation), F.lit(False))).alias("train"))
    table = run_dir(spark, "boosting-rows")
    rows.write.parquet(table)
    rows = spark.read.schema(rows.schema).parquet(table)
    training = rows.where("train")
    width, mean, count = training.agg(F.max(F.size("x")), F.avg("y"), F.count("*")).first()
    if width is None:
        return Booster(0.0, params.rate, [], 0, 0, [])
    # all sums but this one are exact; it is rounded so that it is the same in any order
    start = round(mean, 6)
    cuts = cut_points(training, width, params.bins)
    # as many tasks as there are cores while each has rows enough; sums are exact, so any deal gives the same trees
    tasks = max(-(-count // ROWS_PER_TASK), min(spark.sparkContext.defaultParallelism, -(-count // ROWS_LEAST)))
    blocks = _stored(to_blocks(rows.repartition(tasks), cuts, start), "boosting-blocks0")
    now, kept = blocks.rdd.coalesce(tasks).map(Block.opened), None
    trees, errors, fresh, best = [], [], 0, 0
    for number in range(params.rounds + 1):
        drawn = np.random.Generator(np.random.PCG64([params.seed, number])).permutation(width)
        chosen = sorted(drawn[:max(1, round(params.feature_share * width))].tolist())
        widths = [len(cuts[f]) + 1 for f in chosen]
        inside = np.arange(max(widths)) < np.array(widths)[:, None]
        salt = params.seed * 1_000_003 + number // params.rows_drawn_every
        last = trees[-1] if len(trees) > fresh else None
        now = now.map(lambda block, last=last, salt=salt: block.begun(last, params.rate, salt, params.row_share))
        now = now.persist(StorageLevel.MEMORY_AND_DISK)

        def sums(tree: Tree, wanted: list[int], now=now, chosen=chosen, widths=widths, inside=inside):
            parts = now.mapPartitions(lambda blocks: added(blocks, tree, wanted, chosen, widths))
            total = parts.reduce(np.add) if parts.getNumPartitions() <= SUMS else parts.treeReduce(np.add)
            hists = np.zeros((len(wanted), 2, *inside.shape), np.int64)
            hists[:, :, inside] = total[2:].reshape(len(wanted), 2, sum(widths))
            return total[:2], hists

        def subtrees(tree: Tree, most: dict[int, int], now=now, chosen=chosen, widths=widths):
            place, min_rows = {node: i for i, node in enumerate(most)}, params.min_rows
            rows = now.flatMap(lambda block: block.members(tree, list(most), chosen))
            return dict(rows.groupByKey(len(most), place.get).map(lambda group: (group[0], subtree(
                *[np.concatenate(x, axis=-1) for x in zip(*group[1], strict=True)], chosen, widths, most[group[0]], min_rows))).collect())
        if number == params.rounds:  # only the error of the last round is wanted
            error, tree = sums(Tree(), [])[0], None
        else:
            tree, error = grow(sums, subtrees, chosen, cuts, params)
        if kept:  # the first pass has made this round's blocks
            kept.unpersist()
        kept = now
        errors.append(int(error[0]) / int(error[1]) / UNIT if error[1] else 0.0)
        if errors[-1] < errors[best] or not error[1]:
            best = number
        if tree is None or number - best >= params.patience:
            break
        trees.append(tree)
        if len(trees) - fresh >= ROUNDS_PER_TABLE:
            blocks = _stored(rescored(blocks, trees[fresh:], params.rate), f"boosting-blocks{number + 1}")
            now, fresh = blocks.rdd.coalesce(tasks).map(Block.opened), len(trees)
    kept.unpersist()
    return Booster(start, params.rate, trees[:best], best, len(trees), errors)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(BLOCK).parquet(path)
