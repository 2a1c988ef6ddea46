"""Phrase counts and scores against plain counting."""

import random
import re
from collections import Counter

import pytest

from shelfwise.llm import collocations


def plain_pieces(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[ \t]+", p) if w] for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", text)]


def plain_counts(rows, longest, threshold):
    counts = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in plain_pieces(text):
            counts[lang, 0, ""] += len(piece)
            for k in range(1, longest + 1):
                for i in range(len(piece) - k + 1):
                    counts[lang, k, " ".join(piece[i:i + k])] += 1
    return {x: n for x, n in counts.items() if x[1] == 0 or n >= threshold}


def plain_table(frequent, top):
    f = {(lang, p): n for (lang, k, p), n in frequent.items() if k}
    out = []
    for lang in {x[0] for x in frequent}:
        rows = []
        mine = [(k, p, n) for (g, k, p), n in frequent.items() if g == lang and k >= 2]
        for k, p, a in mine:
            words = p.split(" ")
            low = min((2_000_000 * a // (f[lang, " ".join(words[:c])] + f[lang, " ".join(words[c:])]), c) for c in range(1, k))
            within = [n for j, q, n in mine if j > k and any(q.split(" ")[i:i + k] == words for i in range(j - k + 1))]
            if not any(100 * n >= 80 * a for n in within):
                l, r = f[lang, " ".join(words[:low[1]])], f[lang, " ".join(words[low[1]:])]
                rows.append((low[0], a, p, l, r))
        rows.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, l, r, frequent.get((lang, 0, ""), 0), s) for i, (s, a, p, l, r) in enumerate(rows[:top])]
    return sorted(out)


def corpus(seed, n, words=12):
    r = random.Random(seed)
    vocabulary = ["The", "the", "of", "New", "York", "é", "中文", "\x1c", "x-y", "12", "ß", "\x00", "\xa0a", "'s"][:words]
    def text():
        out = []
        for _ in range(r.randrange(60)):
            out.append(r.choice(["in the end of", "New York city"]) if r.random() < 0.2 else r.choice(vocabulary))
            out.append(r.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", "  "]))
        return "".join(out)
    return [(r.choice(["en", "en", "en", "de", None, "und", ""]), r.choice([text(), text(), text(), None, "", "same of the same"]))
            for _ in range(n)]


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, g, 1, "s") for i, (g, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n long, shard string").repartition(3)
    return docs, {(r.lang, r.k, r.phrase): r.n for r in collocations.frequent_phrases(docs, **options).collect()}


@pytest.mark.parametrize("options", [{"threshold": 4, "size": 200}, {"threshold": 9, "shards": 3, "longest": 3},
                                     {"threshold": 2, "shards": 1, "size": 50}])
def test_counts(spark, options):
    rows = corpus(5, 160)
    _, got = run(spark, rows, **options)
    want = plain_counts(rows, options.get("longest", 4), options["threshold"])
    assert {x: n for x, n in got.items() if x[1] or n} == {x: n for x, n in want.items() if x[1] or n}


def test_late_phrases(spark):
    """Phrases whose words come late: activated after the first cycle of words."""
    rows = [("en", "a b c d")] * 3 + [("en", "filler words here")] * 300 + [("en", "a b c d")] * 6
    _, got = run(spark, rows, threshold=9)
    assert got["en", 4, "a b c d"] == 9 and got["en", 3, "filler words here"] == 300
    assert got == plain_counts(rows, 4, 9)


def test_filters_only_spare_work(spark, monkeypatch):
    """With bitmaps that let everything pass, the counts are the same."""
    monkeypatch.setattr(collocations.Bitmap, "has", lambda self, h: collocations.np.ones(len(h), bool))
    rows = corpus(3, 80)
    _, got = run(spark, rows, threshold=5)
    assert {x: n for x, n in got.items() if x[1] or n} == {x: n for x, n in plain_counts(rows, 4, 5).items() if x[1] or n}


def test_scores(spark):
    rows = corpus(7, 200)
    docs, _ = run(spark, rows, threshold=3)
    got = sorted(tuple(x) for x in collocations.collocation_table(docs, top=15, threshold=3).collect())
    assert got == plain_table(plain_counts(rows, 4, 3), 15)


def test_huge_counts(spark):
    """Products beyond 64 bits stay exact."""
    big = 9_000_000_000_000_000_001
    rows = [("en", 0, "", big), ("en", 1, "a", big), ("en", 1, "b", big - 2), ("en", 2, "a b", big - 4)]
    frequent = spark.createDataFrame(rows, "lang string, k int, phrase string, n long")
    got = collocations.collocations(frequent).collect()
    assert [(r.a, r.score) for r in got] == [(big - 4, 2_000_000 * (big - 4) // (2 * big - 2))]


def test_blocks():
    """However a text is cut, the same phrases end in its blocks."""
    text = " ".join(random.Random(1).choice(["a", "bb", "c.", "dd,ee", "\nf"]) for _ in range(300))
    whole = collocations.split_words(text.encode())
    for size in (1, 7, 50, 10_000):
        parts = list(collocations.blocks(iter([("en", text)]), size))
        assert [w for _, words, held in parts for w in words[held:]] == whole
        assert all(p[1][p[2] - 3:p[2]] == whole[at - 3:at] for p, at in zip(
            parts[1:], [sum(len(w) - h for _, w, h in parts[:i + 1]) for i in range(len(parts) - 1)], strict=True) if at >= 3)


def test_blocks_by_language():
    """Blocks hold one language each and are full, however languages alternate;
    with many languages what waits stays bounded."""
    texts = [("en", "a b"), ("de", "cc dd"), (None, "e")] * 200
    parts = list(collocations.blocks(iter(texts), 100))
    assert len(parts) <= 25 and all(held == 0 for *_, held in parts)
    for lang, words in (("en", [b"a", b"b"]), ("de", [b"cc", b"dd"]), (None, [b"e"])):
        assert [w for g, some, _ in parts if g == lang for w in some if w != collocations.GAP] == words * 200
    taken = 0

    def many():
        nonlocal taken
        for i in range(5000):
            taken += 1
            yield f"l{i}", "word" * 5
    seen = [(taken, lang) for lang, _, _ in collocations.blocks(many(), 100)]
    assert seen[0][0] < 50 and sorted(lang for _, lang in seen) == sorted(f"l{i}" for i in range(5000))


def test_tables_sent(spark):
    """A task sends one table a bucket for many blocks, not one for each."""
    rows = corpus(9, 300)
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    texts = collocations.token_blocks(docs, 1, 4, 40).coalesce(1)
    assert texts.count() > 100
    sent = collocations.scan(texts, {}, True, 4, 5).collect()
    assert sorted(r["bucket"] for r in sent) == list(range(5))
    got = Counter()
    for r in collocations.unpacked([r["block"] for r in sent], collocations.SENT).to_pylist():
        got[r["lang"], r["k"], r["phrase"].decode()] += r["new"]
    want = plain_counts(rows, 1, 1)
    assert {x: n for x, n in got.items() if x[1] or n} == {x: n for x, n in want.items() if x[1] or n}
    small = collocations.scan(texts, {}, True, 4, 5, sent=4000).collect()
    assert len(small) > len(sent)


def test_phrases_that_share_a_hash():
    """Equal hashes of different phrases don't merge them."""
    import numpy as np
    parts = [np.array([1, 1, 2, 1, 2, 3]), np.array([5, 6, 5, 5, 5, 5])]
    for h in (np.zeros(6, np.uint64), np.array([7, 8, 9, 7, 9, 9], np.uint64), np.array([7, 8, 9, 7, 9, 4], np.uint64)):
        first, counts = collocations.alike(h, parts)
        assert {(parts[0][i], parts[1][i]): n for i, n in zip(first, counts.tolist(), strict=True)} == {
            (1, 5): 2, (1, 6): 1, (2, 5): 2, (3, 5): 1}
    first, counts = collocations.alike(np.zeros(1, np.uint64), [np.array([4])])
    assert first.tolist() == [0] and counts.tolist() == [1]


def test_bitmaps_hold_all(spark):
    words = [f"w{i}" for i in range(3000)]
    reached = spark.createDataFrame([("en", 1, w, i % 3) for i, w in enumerate(words)], "lang string, k int, phrase string, reach int")
    ever, late, last = collocations.bitmaps(reached, {1: 3000}, 3, 2)[1]  # since scans 1 and 2
    import numpy as np
    h = collocations._rotated(collocations.hash_of("en")) ^ np.array([collocations.hash_of(w) for w in words])
    assert ever.has(h).all() and late.has(h)[1::3].all() and late.has(h)[2::3].all() and last.has(h)[2::3].all()
    assert late.has(h).mean() < 0.75 and last.has(h).mean() < 0.45
    other = collocations._rotated(collocations.hash_of("de")) ^ np.array([collocations.hash_of(w) for w in words])
    assert ever.has(other).mean() < 0.1


def test_empty(spark):
    assert collocations.collocation_table(spark.createDataFrame([], "text string, lang string")).collect() == []
    assert collocations.collocation_table(spark.createDataFrame([(None, None)], "text string, lang string")).collect() == []
