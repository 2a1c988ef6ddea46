"""The block-max search against plain cosines, and scores on held-out rows."""

import random
import zlib

import numpy as np
import pytest

from shelfwise.llm import toxicity


def vectors(seed, n, terms):
    r = random.Random(seed)
    idf = np.array([1 + r.random() * 3 for _ in range(terms)])
    bags = [{r.randrange(terms): r.randrange(1, 4) for _ in range(r.randrange(0, 6))} for _ in range(n)]
    return idf, bags + bags[:n // 5], [toxicity.unit(b, idf) for b in bags + bags[:n // 5]]


@pytest.mark.parametrize("block", [3, 64])
def test_search_is_exact(block):
    idf, bags, units = vectors(1, 300, 40)
    index = toxicity.BlockMaxIndex(units, 40, block)
    for q in range(0, len(units), 7):
        if not len(units[q][0]):
            continue
        dense = np.zeros((len(units), 40))
        for i, (t, w) in enumerate(units):
            dense[i, t] = w
        cos = np.round(dense @ dense[q], 12)
        want = sorted(((c, i) for i, c in enumerate(cos) if c > 0 and i != q), key=lambda x: (-x[0], x[1]))[:9]
        got = index.search(*units[q], 9, skip=q)
        assert [c for c, _ in got] == pytest.approx([c for c, _ in want], abs=1e-9)
        close = {i for c, i in want if c > want[-1][0] + 1e-9}
        assert close <= {i for _, i in got}
    assert index.visited < len(range(0, len(units), 7)) * index.n_blocks  # blocks were skipped


def test_isotonic():
    xs, ys = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.8, 0.9]), np.array([0, 1, 0, 1, 1]))
    assert (np.diff(ys) >= 0).all() and ys[0] == 0 and 0.3 < np.interp(0.2, xs, ys) < 0.7 and ys[-1] > 0.9


CLEAN = [f"plain{i}" for i in range(400)]
BAD = ["grobtor", "scheusal", "vile", "lump"]


def corpus(seed, n):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = i % 8 == 0
        words = [r.choice(CLEAN) for _ in range(r.randrange(20, 60))]
        for _ in range(3 * toxic):
            words.insert(r.randrange(len(words)), r.choice(BAD) + r.choice(["", "s", "en"]))
        rows.append((i, " ".join(words).upper() if i % 3 else " ".join(words), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(2, 1600)
    extra = [(5000, None, None), (5001, "", None), (None, "null id vile scheusal lump", 1), (5002, "plain1 " * 20_000, 0), (7, rows[7][1], 0)]
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t, _ in rows + extra], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows + extra] + [(99_999, 1), (8, None)], "doc_id long, toxic int")
    got = toxicity.toxicity_table(docs, labels).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: y for i, _, y in rows}
    held = [x for x in got if x.held_out and x.doc_id in truth]
    assert 250 < len(held) < 550
    wrong = sum(x.predicted != truth[x.doc_id] for x in held)
    assert wrong <= 0.02 * len(held)
    assert all(0 <= x.score <= 1 for x in got) and all(x.predicted == (x.score >= 0.3) for x in got)
    by = {x.doc_id: x for x in got}
    assert by[5000].score == by[5001].score < 0.3 and not by[None].held_out
    assert by[0].evidence and set(by[0].evidence) <= {i for i in truth if not by[i].held_out}
    kept = toxicity.filter_documents(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(x.doc_id) for x in kept.collect()) == sorted(str(x.doc_id) for x in got if not x.predicted)


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [x.score for x in toxicity.toxicity_table(docs, labels).collect()] == [0.0, 0.0]
    assert toxicity.toxicity_table(docs.limit(0), labels).collect() == []


def test_language_with_a_hundredth_of_the_labels(spark):
    r = random.Random(3)
    ids = iter(range(100_000))
    shown = {i for i in range(100_000) if zlib.crc32(str(i).encode()) % 4 != 2}

    def some(n, words, bad, held):
        """``n`` documents of either the examples or the held-out ones."""
        own = [next(i for i in ids if (i in shown) != held) for _ in range(n)]
        return [(i, " ".join([*r.sample(words, 8), *([bad] if bad else [])])) for i in own]

    rare = [f"seltsam{i}" for i in range(300)]
    toxic = some(495, CLEAN, "scheusal", False) + some(5, rare, "zhlobnik", False)
    clean = some(3000, CLEAN, None, False) + some(300, rare, None, False)
    asked = some(20, rare, "zhlobnik", True)
    docs = spark.createDataFrame(toxic + clean + asked, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in toxic] + [(i, 0) for i, _ in clean], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    assert b"zhlobnik" in model.terms
    assert all(model.score(t)[0] >= toxicity.THRESHOLD for _, t in asked)


def test_all_associated_terms_are_kept(spark):
    bags = [(1, [f"bad{w:03}".encode() for w in range(700) if w % 7 == i % 7]) for i in range(70)] + [(0, [b"plain"])] * 700
    got = toxicity.select_terms(spark.createDataFrame(bags, "label int, terms array<binary>"), 70, 700)
    assert sorted(got) == sorted(f"bad{w:03}".encode() for w in range(700))


@pytest.mark.parametrize("most", [toxicity.MAX_BROADCAST_BYTES, 0])
def test_only_near_copies_of_one_label_merge(spark, monkeypatch, most):
    monkeypatch.setattr(toxicity, "MAX_BROADCAST_BYTES", most)

    def sketch(text):
        return toxicity.sketch(toxicity.words(text))

    passage = " ".join(f"shared{i}" for i in range(20))
    texts = (passage + " " + " ".join(f"{k}own{j}" for j in range(60)) for k in range(400))
    one, two = [t for t in texts if sketch(t) == sketch(passage) == sketch(t + " x")][:2]
    rows = [(one, 0), (two, 0), (one, 1), (one, 0), (one + " x", 0), (two, 1)]
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2][:len(rows)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in zip(ids, rows, strict=True)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in zip(ids, rows, strict=True)], "doc_id long, toxic int")
    assert toxicity.learn(docs, labels).ids == [ids[0], ids[1], ids[2], ids[5]]
