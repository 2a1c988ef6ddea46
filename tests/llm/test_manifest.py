"""Trees, proofs and tampering against a plain recursive version."""

import hashlib
import random
import zlib

import pytest

from shelfwise.llm import manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves):
    """(top, proof steps of each leaf as (before, after))."""
    steps, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i in range(len(leaves)):
            first = at[i] // 8 * 8
            run = nodes[first:first + 8]
            steps[i].append(("".join(run[:at[i] - first]), "".join(run[at[i] - first + 1:])))
            at[i] //= 8
        nodes = [digest(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], steps


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    groups = {}
    for g in langs:
        some = sorted(by[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        groups[g] = (some, *tree([leaf(r) for r in some]))
    root, over = tree([groups[g][1] for g in langs])
    out = []
    for g, high in zip(langs, over, strict=True):
        some, top, steps = groups[g]
        for r, path in zip(some, steps, strict=True):
            path = path + high
            now = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                now = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            node = leaf(now)
            for before, after in path:
                node = digest(before, node, after)
            out.append((r[0], leaf(r), top, root, digest(*[b + a for b, a in path]), node, node == root))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, n int, lo string")
    got = [tuple(x) for x in manifest.manifest_table(docs.repartition(4)).collect()]
    order = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(got, key=order) == sorted(plain(rows), key=order)


def rows_of(seed, n, langs):
    r = random.Random(seed)
    return [(r.choice([i, i, i, 5, -i]), r.choice(["web", "", None]), r.choice(langs), r.choice([None, i]),
             r.choice(["Some Text", "no capitals", "", None, "É ÀB 中", "x" * 3000])) for i in range(n)]


@pytest.mark.parametrize("n, langs", [(700, ["en", "de", None, "", "é"]), (64, ["en"]), (65, ["en"]), (9, ["a"]),
                                      (600, ["en", *[f"l{i}" for i in range(70)]])])
def test_manifest(spark, n, langs):
    rows = rows_of(n, n, langs)
    rows += [rows[0]] * 40 + [(None, None, None, None, None)] * 3  # repeated rows
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, "s", "en", 4, "Text")], [(1, "s", "en", 4, "Text"), (2, "s", "de", 4, "Text")]])
def test_small(spark, rows):
    if rows:
        check(spark, rows)
    else:
        docs = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
        assert manifest.manifest_table(docs).collect() == []


def test_intervals_nest(spark):
    docs = spark.range(200).selectExpr("id AS doc_id", "'s' AS source", "'en' AS lang", "id AS n_chars", "'T' AS text")
    found, _ = manifest.manifest(docs)
    leaves = manifest.ranked(docs.selectExpr("lang AS `group`", "doc_id AS key", "sha2(string(doc_id), 256) AS digest"), "group", ["key", "digest"])
    assert sorted((r.key, r.lo, r.hi) for r in leaves.collect()) == [(i, i, i + 1) for i in range(200)]
    nodes = manifest.levels(leaves, "group")
    assert [sorted((r.lo, r.hi) for r in level.collect()) for level in nodes] == [
        [(i, min(200, i + 8)) for i in range(0, 200, 8)], [(0, 64), (64, 128), (128, 192), (192, 200)], [(0, 200)]]
    assert found.count() == 200


def test_a_change_elsewhere_is_seen(spark):
    """A root of other rows doesn't verify against this one's."""
    rows = rows_of(1, 50, ["en"])
    other = [*rows[:-1], (*rows[-1][:4], "changed")]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    roots = {manifest.manifest(spark.createDataFrame(x, schema))[1] for x in (rows, other)}
    assert len(roots) == 2
