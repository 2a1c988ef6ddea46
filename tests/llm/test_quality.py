"""Signals against plain counts, and the statistics against exact sums."""

import random
from fractions import Fraction
from math import comb

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import quality, queries


def plain(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


def texts(seed, n=60):
    r = random.Random(seed)
    bits = ["a", "b", "é", "#x", " ", "  ", "\n", "\t", "\x0b", "\x85", "\xa0", "🙂", "B", "a b c", "\r"]
    return [None, "", " \n ", "a\na\na", "a b c a b c", "a a a a"] + ["".join(r.choice(bits) + r.choice(["", " "]) for _ in range(r.randrange(80)))
                                                                      for _ in range(n)]


def test_signals():
    for t in texts(1):
        assert quality.text_signals(t)[:5] == plain(t), t


def test_binomial():
    for n, p in [(5, Fraction(1, 3)), (40, Fraction(1, 50)), (300, Fraction(1, 100))]:
        for k in range(0, min(n, 12)):
            exact = float(sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)))
            if k < n * p:
                assert quality.binomial_tail(k, n, float(p)) == pytest.approx(exact, rel=1e-9)
    # Clopper-Pearson for no failures: 1 - level ** (1 / n)
    assert quality.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** 0.01, rel=1e-6)


def test_certified_cutoffs():
    rows = pd.DataFrame({"cutoff": [3.0, 2.0, 1.0], "good": 5000, "bad": 400, "good_dropped": [0, 1, 400], "bad_dropped": [10, 200, 390]})
    got = quality.certified_cutoffs(rows, 0.004, 0.01)
    assert got["certified"].tolist() == [True, True, False]  # testing stops at the first failure
    assert got["used"].tolist() == [False, True, False] and got["bound"][1] < 0.004
    few = rows.assign(good=100)
    assert not quality.certified_cutoffs(few, 0.004, 0.01)["certified"].any()


def test_guarantee_holds():
    """The chance to certify a cutoff whose true rate is above alpha is small."""
    r = random.Random(3)
    wrong = 0
    for _ in range(200):
        k = sum(r.random() < 0.02 for _ in range(1000))
        rows = pd.DataFrame({"cutoff": [1.0], "good": [1000], "bad": [10], "good_dropped": [k], "bad_dropped": [10]})
        wrong += bool(quality.certified_cutoffs(rows, 0.02, 0.05)["certified"][0])
    assert wrong <= 20


def good(i):
    return " ".join(f"word{i}x{k}" for k in range(60))


def test_table_and_filter(spark):
    rows = [(i, good(i), "en", 1, "q") for i in range(3000)]
    rows += [(10_000 + i, " ".join(f"w{i}{k}#" for k in range(60)), "en", 0, "q") for i in range(200)]
    rows += [(20_000, None, None, None, "q"), (20_001, "", "xx", 1, "q"), (None, good(1), "en", None, "q"),
             (20_002, "few words", "en", 1, "q"), (20_003, "same three words " * 40, "en", None, "q"), (3, good(3), "en", 1, "q")]
    docs = spark.createDataFrame([(r[0], r[1], r[2], r[4]) for r in rows], "doc_id long, text string, lang string, _q string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows[:3200]] + [(None, 1), (99_999, 1), (5, 1), (6, None)],
                                   "doc_id long, quality int")
    got = quality.quality_table(docs, labels).collect()
    assert len(got) == len(rows)
    for x in got:
        text = next(r[1] for r in rows if r[0] == x.doc_id)
        want = plain(text)
        assert tuple(x[1:6]) == want
        assert x.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert x.kept == (not x.base_failed and not 10_000 <= (x.doc_id or 0) < 20_000)
    kept = quality.filter_documents(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(map(str, (x.doc_id for x in kept.collect()))) == sorted(map(str, (x.doc_id for x in got if x.kept)))


def test_query_equals_sql_where_rules_fire(spark, tmp_path):
    r = random.Random(5)

    def text(i, kind):
        words = [f"word{i}x{k}" for k in range(60)]
        if kind == "symbols":
            words = [w + "#" * r.randrange(1, 5) for w in words]
        elif kind == "repeats":
            words[20:20 + r.randrange(6, 25)] = words[:6] * 4
        elif kind == "capitals":
            words = [w.upper() if r.random() < 0.7 else w for w in words]
        return " ".join(words) if kind != "copied_lines" else "\n".join([*words, *words[:r.randrange(5, 60)]])

    kinds = ["symbols", "repeats", "capitals", "copied_lines"]
    rows = [(i, text(i, "plain"), lang, 1) for lang, first, n in (("en", 0, 2500), ("de", 5000, 2500), (None, 10_000, 40))
            for i in range(first, first + n)]
    rows += [(20_000 + i, text(i, kinds[i % 4]), ["en", "de", None][i % 3], int(i % 50 == 0)) for i in range(600)]
    rows += [(30_000 + i, text(i, kinds[i % 4]), "en", None) for i in range(40)]
    spark.createDataFrame([x[:3] for x in rows], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(x[0], x[3]) for x in rows], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op2_quality_rules(spark, str(tmp_path))
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL['op2_quality_rules']})").fetchall()
    got = sorted(map(tuple, got.collect()), key=str)
    assert got == sorted(want, key=str)
    fired = {rule for x in got for rule in x[-1].split(",")}
    assert len(fired - {""}) >= 2 and any(x[-1] and x[0] >= 30_000 for x in got), fired


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.quality_table(docs, labels).collect() == []
    some = spark.createDataFrame([(1, good(1), "en")], "doc_id long, text string, lang string")
    assert [x.kept for x in quality.quality_table(some, labels).collect()] == [True]
    assert quality.filter_documents(some.where(F.lit(False)), labels).collect() == []
