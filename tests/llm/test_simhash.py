"""Fingerprints, links and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from shelfwise.llm import simhash
from shelfwise.llm.components import components


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ")
             .replace("\t", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_components(prints, budget):
    up = list(range(len(prints)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= budget:
                up[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            ids[find(i)] = min(ids.get(find(i), d), d)
    return [ids.get(find(i)) for i in range(len(prints))]


def test_fingerprint():
    r = random.Random(1)
    for n in [0, 1, 2, 3, 4, 5, 50, 400]:
        text = " ".join(r.choice(["Äpfel", "THE", "the", "x\n", "\tq", "z "]) for _ in range(n))
        assert simhash.text_fingerprint(text) == plain_fingerprint(text)
    assert simhash.text_fingerprint(None) == 0


def near(r, value, bits):
    for b in r.sample(range(64), bits):
        value ^= 1 << b
    return value


@pytest.mark.parametrize("most", [4096, 7])
def test_components_of_prints(spark, monkeypatch, most):
    """Also with subtries dealt into parts of 7 fingerprints."""
    monkeypatch.setattr(simhash, "MAX_SUBTRIE", most)
    monkeypatch.setattr(simhash, "ROWS_PER_TASK", 300)
    r = random.Random(2)
    prints = [(None, 0), (5, 0), (6, 1)]
    for c in range(12):
        centre = r.getrandbits(64)
        prints += [(1000 + 100 * c + i, near(r, centre, r.randrange(7))) for i in range(20)]
    hub = r.getrandbits(64)
    prints += [(5000 + i, hub ^ (i << 20)) for i in range(120)]  # one hot subtrie
    prints += [(9000, hub), (9001, hub)]
    signed = [(d, v - (1 << 64) if v >> 63 else v) for d, v in prints]
    table = spark.createDataFrame(signed, "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.groups(table, 4).collect()}
    assert [got[v] for _, v in signed] == plain_components(prints, 4)


def test_linked_pairs_are_all_pairs():
    r = random.Random(3)
    values = np.array(sorted({near(r, 0xF0F0 << 30, r.randrange(6)) for _ in range(300)}), np.uint64)
    got = {(min(a, b), max(a, b)) for x, y in simhash.linked_pairs(values, [(0, len(values), 0, len(values))], 4, 0)
           for a, b in zip(x.tolist(), y.tolist())}
    want = {(i, j) for j in range(len(values)) for i in range(j) if bin(int(values[i] ^ values[j])).count("1") <= 4}
    assert got == want


@pytest.mark.parametrize("shared", [1, 2, 3])
def test_orders(shared):
    """Every order holds each bit once; a pair within the budget meets in a subtrie."""
    r = random.Random(4)
    every = simhash.orders(4, shared)
    values = np.array([r.getrandbits(64) for _ in range(200)], np.uint64)
    others = np.array([near(r, int(v), r.randrange(5)) for v in values], np.uint64)
    met = np.zeros(len(values), bool)
    for order in every:
        depth = sum(w for _, w in order[:shared])
        a, b = simhash.arranged(values, order), simhash.arranged(others, order)
        assert (np.bitwise_count(a) == np.bitwise_count(values)).all()
        assert (np.bitwise_count(a ^ b) == np.bitwise_count(values ^ others)).all()
        met |= a >> np.uint64(64 - depth) == b >> np.uint64(64 - depth)
    assert met.all()


@pytest.mark.parametrize("shared", [1, 3])
def test_links_do_not_depend_on_the_bands(spark, shared):
    r = random.Random(5)
    prints = [(i, near(r, c, r.randrange(5))) for i, c in enumerate([r.getrandbits(64) for _ in range(8)] * 15)]
    prints = list({v: (i, v) for i, v in prints}.values())
    table = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for _, v in prints], "fp long")
    root = {x.node % (1 << 64): x.root for x in components(simhash.links(table, 4, shared)).collect()}
    want = plain_components(prints, 4)
    got = [root.get(v, ("alone", v)) for _, v in prints]
    assert len(set(got)) == len(set(want)) == len(set(zip(got, want)))


def test_documents(spark):
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(3, base, "k"), (1, base.upper(), "k"), (2, base + " extra", "k"), (7, "other words here now " * 3, None),
            (8, None, "k"), (9, "", "k"), (None, " \n", "k"), (4, base, "k"), (4, base, "k"), (None, "alone text", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((tuple(x) for x in simhash.near_duplicates(docs).collect()), key=str)
    prints = [(d, plain_fingerprint(t)) for d, t, _ in rows]
    want = sorted(((d, f"{p:016x}", c) for (d, p), c in zip(prints, plain_components(prints, 4))), key=str)
    assert got == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((x.doc_id, x.text) for x in kept.collect()), key=str) == sorted(
        [(1, base.upper()), (7, rows[3][1]), (8, None), (None, "alone text")], key=str)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == [] and simhash.keep_one(docs).collect() == []


def test_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (None, 3), (200, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 200: 100}
