"""Windows in documents against a plain search."""

import hashlib
import random
import re

import pytest

from shelfwise.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, size):
    w, hit, found = words(text), set(), set()
    for i, t in items:
        v = words(t)
        for s in range(max(1, len(v) - size + 1)) if v else ():
            win = v[s:s + size]
            for p in range(len(w) - len(win) + 1):
                if w[p:p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    found.add(i)
    names = ",".join(sorted(str(i) for i in found if i is not None))
    return len(w), len(hit), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("size, most", [(3, 1 << 25), (5, 0), (13, 0)])
def test_against_plain(spark, monkeypatch, size, most):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_BYTES", most)
    r = random.Random(size)
    vocabulary = ["Über", "straße", "the", "THE", "a", "É", "x1", "中文", "b", "c", "d", "e"]

    def text(n):
        return "".join(r.choice(vocabulary) + r.choice([" ", ", ", "\n", "_"]) for _ in range(n))
    items = [(i, text(r.randrange(1, 25))) for i in range(25)] + [(100, None), (101, ""), (102, "?!"), (103, "a"), (104, "a"), (None, "x1 a")]
    items.append((105, items[3][1]))
    docs = [(i, text(r.randrange(80)), "z") for i in range(60)] + [(200, None, "z"), (201, "", "z"), (None, text(40), "z")]
    docs += [(300 + i, text(5) + items[i][1].upper() + " " + text(5), "z") for i in range(20)]
    docs += [(300, docs[3][1], "z"), docs[0]]
    table = spark.createDataFrame(docs, "doc_id long, text string, window string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination_table(table, bench, size).collect()
    key = lambda x: (str(x[0]), x[1:])
    have = sorted(((x.doc_id, x.n_words, x.n_hit, x.items_sha256, x.contaminated) for x in got), key=key)
    assert have == sorted(((d, *plain(t, items, size)) for d, t, _ in docs), key=key)
    kept = decontaminate.filter_documents(table, bench, size)
    assert kept.columns == table.columns
    assert sorted(map(str, kept.collect())) == sorted(
        str(x) for x in table.collect() if not plain(x.text, items, size)[3])


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [x.contaminated for x in decontaminate.contamination_table(docs, none).collect()] == [False]
    assert decontaminate.contamination_table(docs.limit(0), none).collect() == []
    assert decontaminate.filter_documents(docs, none).count() == 1


def test_plan_has_no_python(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        decontaminate.contamination_table(docs, bench).explain()
    assert "Python" not in out.getvalue() and "Cartesian" not in out.getvalue() and "NestedLoop" not in out.getvalue()


def test_one_prefix_in_many_windows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_BYTES", 100)
    broadcast, sizes = decontaminate.F.broadcast, []
    ends = [f"a{i} b{i}" for i in range(400)]
    bench = spark.createDataFrame(list(enumerate([f"{w} {e}" for w in ("rare", "absent") for e in ends])), "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join(2 * ends)), (2, "rare a7 b7")], "doc_id long, text string")
    windows, _ = decontaminate.benchmark_windows(bench, 3)
    prefixed = decontaminate.prefixes(docs, windows)
    monkeypatch.setattr(decontaminate.F, "broadcast", lambda df: sizes.append(df.count()) or broadcast(df))
    assert [(r.doc_id, r.start, r.end) for r in decontaminate.occurrences(docs, prefixed).collect()] == [(2, 0, 3)]
    assert max(sizes) <= 150  # the filter; the windows are shuffled
