"""Leaf-wise boosting against a plain best-first version, row by row."""

import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from shelfwise.operators import boosting
from shelfwise.session import run_dir


def plain_tree(x, g, leaves, min_rows, cuts):
    """Best-first growth, one split at a time, on whole-number gradients."""
    def split_of(rows):
        best = None
        total, n = int(g[rows].sum()), len(rows)
        for f in range(x.shape[1]):
            for b, c in enumerate(cuts[f]):
                low = rows[x[rows, f] <= c]
                if min(len(low), n - len(low)) < max(1, min_rows):
                    continue
                s = float(g[low].sum())
                gain = s ** 2 / len(low) + (total - s) ** 2 / (n - len(low)) - float(total) ** 2 / n
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, f, b)
        return best
    nodes = [np.arange(len(x))]
    splits, order, open_leaves = {0: split_of(nodes[0])}, [], {0}
    while len(open_leaves) < leaves:
        able = [(-splits[n][0], n) for n in open_leaves if splits[n]]
        if not able:
            break
        _, at = min(able)
        _, f, b = splits[at]
        low = x[nodes[at], f] <= cuts[f][b]
        open_leaves.remove(at)
        kids = []
        for rows in (nodes[at][low], nodes[at][~low]):
            nodes.append(rows)
            kids.append(len(nodes) - 1)
            splits[kids[-1]] = split_of(rows)
            open_leaves.add(kids[-1])
        order.append((at, f, b, *kids))
    return order, {n: -int(g[nodes[n]].sum()) / len(nodes[n]) / boosting.UNIT for n in open_leaves}


def data(n, seed=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = r.random() * 10, r.randrange(6), r.choice([0.0, 1.0])
        y = 3 * (a > 4) + b * (2 if c else -1) + (a > 8) * b * 1.5 + r.random()
        out.append((f"k{i}", a, float(b), c, y, i % 5 == 0))
    return out


def frame(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, a double, b double, c double, y double, v boolean").repartition(parts)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


EXACT = dict(feature_share=1.0, row_share=1.0, bins=32)


def test_first_tree_equals_plain(spark):
    rows = data(240)
    p = boosting.Params(rounds=1, leaves=9, min_rows=5, rate=1.0, patience=5, **EXACT)
    got = boosting.fit(frame(spark, rows, 3), "features", "y", "k", "v", p)
    train = [r for r in rows if not r[5]]
    x, y = np.array([r[1:4] for r in train]), np.array([r[4] for r in train])
    start = round(float(y.mean()), 6)
    assert got.start == pytest.approx(start, abs=2e-6)
    cuts = boosting.cut_points(frame(spark, rows, 2).where("not v").selectExpr("array(a, b, c) AS x"), 3, 32)
    assert len(cuts[1]) == 6 and len(cuts[2]) == 2 and len(cuts[0]) == 31
    g = np.rint((got.start - y) * boosting.UNIT).astype(np.int64)
    order, values = plain_tree(x, g, 9, 5, cuts)
    tree = got.trees[0]
    assert [(n, tree.feature[n], tree.cut[n], tree.left[n], tree.right[n]) for n, *_ in order] == order
    assert {n for n, f in enumerate(tree.feature) if f < 0} == set(values)
    assert all(tree.value[n] == pytest.approx(v, abs=1e-12) for n, v in values.items())


def test_any_partitioning_gives_the_same_model(spark):
    rows = data(200)
    p = boosting.Params(rounds=6, leaves=7, min_rows=4, rate=0.3, bins=16)
    models = [boosting.fit(frame(spark, rows, n), "features", "y", "k", "v", p) for n in (1, 5)]
    assert models[0] == models[1]


def test_patience_keeps_the_best_prefix(spark, monkeypatch):
    monkeypatch.setattr(boosting, "ROUNDS_PER_TABLE", 2)
    rows = data(150)
    p = boosting.Params(rounds=40, leaves=6, min_rows=3, rate=0.9, patience=4, bins=16)
    m = boosting.fit(frame(spark, rows, 2), "features", "y", "k", "v", p)
    assert m.best_round == int(np.argmin(m.errors)) == len(m.trees)
    assert m.rounds == min(40, m.best_round + 4) and len(m.errors) == m.rounds + 1
    # errors are those of the prefixes, and predictions those of the trees
    held = [r for r in rows if r[5]]
    x, y = np.array([r[1:4] for r in held]), np.array([r[4] for r in held])
    for n in (0, m.best_round):
        part = boosting.Booster(m.start, m.rate, m.trees[:n], n, n, [])
        assert np.abs(part.predict(x) - y).mean() == pytest.approx(m.errors[n], abs=1e-3)
    path = run_dir(spark, "booster")
    m.save(spark, path)
    again = boosting.Booster.load(spark, path)
    assert again == m
    scored = {r.k: r.prediction for r in again.transform(frame(spark, rows, 3)).collect()}
    assert [scored[r[0]] for r in held] == m.predict(x).tolist()


def test_edge_tables(spark):
    p = boosting.Params(rounds=3, min_rows=2, bins=8, leaves=4)
    empty = boosting.fit(frame(spark, [("k", 1.0, 1.0, 1.0, 2.0, True)], 1), "features", "y", "k", "v", p)
    assert empty.trees == [] and empty.start == 0.0
    same = boosting.fit(frame(spark, [(f"k{i}", 1.0, 1.0, 1.0, 5.0, False) for i in range(9)], 2), "features", "y", "k", "v", p)
    assert same.predict(np.ones((1, 3))).tolist() == [5.0]
    rows = [("a", 1.0, 1.0, 1.0, 1.0, False)] * 4 + [("b", 2.0, 1.0, 1.0, 3.0, None)] * 4 + [("n", 2.0, 1.0, 1.0, None, False)]
    some = boosting.fit(frame(spark, rows, 2), "features", "y", "k", "v", boosting.Params(
        rounds=60, min_rows=1, bins=8, leaves=4, rate=0.5, **{"row_share": 1.0, "feature_share": 1.0}))
    assert some.rounds == 60 and some.predict(np.array([[1.0, 1, 1], [2.0, 1, 1]])) == pytest.approx([1, 3], abs=1e-3)


def test_subtrees_grown_by_one_task_change_nothing_and_spare_jobs(spark, monkeypatch):
    rows = data(400)
    p = boosting.Params(rounds=5, leaves=20, min_rows=3, rate=0.3, bins=16)
    models, jobs = [], []
    for most in (0, 60, 50_000):
        monkeypatch.setattr(boosting, "LOCAL_ROWS", most)
        spark.sparkContext.setJobGroup(f"boosting-{most}", "")
        models.append(boosting.fit(frame(spark, rows, 3), "features", "y", "k", "v", p))
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"boosting-{most}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert models[0] == models[1] == models[2]
    # two jobs a round, the last round's error, and the tables before the first
    assert jobs[2] < jobs[0] and jobs[2] <= 2 * 5 + 1 + 12
