"""Toxicity by the nearest labelled examples.

The examples are a bounded sample of the labelled rows (``MAX_EXAMPLES``), one
per text and label; of texts with equal sketch and label, those that share
``SIMILAR`` of their words with the one of smallest id give way to it.  Their words, and word beginnings of STEMS bytes (written
``abcd*``), are the candidates for the TF-IDF space: all that are associated
with the label (MIN_CHI2, MIN_RATIO), each in at least ``MIN_EXAMPLES`` toxic
examples, however many there are in other languages.  The search runs over
these terms only; README has the figures of a search over all words.
Inverse document frequencies are counted over all documents.  Every whole text becomes a unit TF-IDF vector; an
inverted index of the examples, cut into blocks with the largest weight of
each term per block, finds the ``K`` examples of highest cosine exactly:
blocks are visited by falling upper bound and the search ends when no block
can hold a better example.  The neighbours vote with weight
``1 / (EPSILON + 1 - cosine)``, against ``K`` clean votes at cosine PRIOR so
that far neighbours count for little; isotonic regression over leave-one-out votes of
the examples turns the share into a probability.  The index is bounded by its
parameters and goes to every task; scoring shuffles no text.

Defined results: a text without any term (null and empty texts too) gets the
rate of toxic examples without any term, smoothed by one clean example; if
nothing is labelled, scores are 0; ties in cosine go to the smaller example
number; of several labels of one id the largest holds, and of several texts
the one of smallest sketch is the example; equal texts
with both labels are two examples; repeated documents get equal scores.  A null id is not held out and never an example.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

MAX_EXAMPLES = 8192
#: lengths in bytes of word beginnings
STEMS = range(4, 9)
#: toxic examples that must hold a term
MIN_EXAMPLES = 3
#: association a term must show: chi-square, and ratio of its rates in both classes
MIN_CHI2, MIN_RATIO = 30.0, 20.0
#: share of the words of two examples together that both must hold to be one
SIMILAR = 0.8
MAX_BROADCAST_BYTES = 32 << 20
K, EPSILON, PRIOR, BLOCK = 25, 0.05, 0.25, 64
THRESHOLD = 0.3

#: ASCII letters in lower case; digits and bytes above 127 stay; all else separates
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 32
              for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def stems(tokens: list[bytes], size: int) -> list[bytes]:
    """Word beginnings of ``size`` bytes, as keys without the closing star."""
    return [t[:size] for t in tokens if len(t) >= size]


def sketch(tokens: list[bytes], size: int = 5) -> int:
    """Smallest hash of any five words: mostly equal for near-equal texts."""
    n = max(1, len(tokens) - size + 1)
    return min(xxhash.xxh64_intdigest(b" ".join(tokens[i:i + size])) for i in range(n)) >> 1


# --- index -------------------------------------------------------------------------
class BlockMaxIndex:
    """Inverted index over unit vectors, in blocks with per-term maxima."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        # examples with the same leading term go side by side: blocks get unlike maxima
        lead = [int(t[np.argmax(w)]) if len(t) else -1 for t, w in vectors]
        self.example = np.array(sorted(range(len(vectors)), key=lambda i: (lead[i], i)), np.int64)
        self.block, self.n_blocks = block, -(-len(vectors) // block)
        term, slot, weight = [], [], []
        for s, e in enumerate(self.example):
            t, w = vectors[e]
            term.append(t), weight.append(w), slot.append(np.full(len(t), s))
        term, slot, weight = (np.concatenate(x) if x else np.zeros(0) for x in (term, slot, weight))
        term, slot = term.astype(np.int64), slot.astype(np.int64)
        order = np.lexsort((slot, term))
        term, self.slot, self.weight = term[order], slot[order], weight[order].astype(np.float64)
        cell = term * max(1, self.n_blocks) + self.slot // block
        cells = n_terms * max(1, self.n_blocks)
        self.begin = np.searchsorted(cell, np.arange(cells + 1))  # postings of (term, block)
        self.maxima = np.zeros(cells)
        np.maximum.at(self.maxima, cell, self.weight)
        self.maxima = self.maxima.reshape(n_terms, max(1, self.n_blocks))
        self.visited = 0

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> list[tuple[float, int]]:
        """The ``k`` examples of highest positive cosine, ties to the smaller
        number; ``skip`` leaves one example out."""
        bounds = weights @ self.maxima[terms]
        found: list[tuple[float, int]] = []
        least = 0.0
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or (len(found) >= k and bounds[b] < least - 1e-12):
                break
            self.visited += 1
            scores = np.zeros(self.block)
            for t, q in zip(terms, weights, strict=True):
                i, j = self.begin[t * self.n_blocks + b], self.begin[t * self.n_blocks + b + 1]
                if i < j:
                    scores[self.slot[i:j] - b * self.block] += q * self.weight[i:j]
            hit = np.flatnonzero(scores > 0)
            found += [(float(round(scores[h], 12)), int(e)) for h in hit
                      if (e := self.example[b * self.block + h]) != skip]
            if len(found) >= k:
                found.sort(key=lambda x: (-x[0], x[1]))
                del found[k:]
                least = found[-1][0]
        return sorted(found, key=lambda x: (-x[0], x[1]))


class Model:
    """What a task needs to score texts: terms, idf, index, labels, calibration."""

    def __init__(self, terms: list[bytes], idf: np.ndarray, vectors, labels, ids):
        self.terms = terms
        self.words, self.stems = lookups(terms)
        self.idf = idf
        self.labels, self.ids = np.asarray(labels, np.float64), list(ids)
        self.index = BlockMaxIndex(vectors, max(1, len(terms)))
        none = np.array([not len(t) for t, _ in vectors], bool)
        self.no_terms = float(self.labels[none].sum() / (none.sum() + 1)) if len(none) else 0.0
        self.curve = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def counts(self, text: str | None) -> dict[int, int]:
        found: dict[int, int] = {}
        tokens = words(text)
        for keys, known in ((tokens, self.words), *((stems(tokens, n), t) for n, t in self.stems.items())):
            for t in map(known.get, keys):
                if t is not None:
                    found[t] = found.get(t, 0) + 1
        return found

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        return unit(counts, self.idf)

    def vote(self, vector, skip: int = -1) -> tuple[float | None, list[tuple[float, int]]]:
        near = self.index.search(*vector, K, skip) if len(vector[0]) else []
        if not near:
            return None, []
        w = np.array([1 / (EPSILON + 1 - min(1.0, s)) for s, _ in near])
        y = self.labels[[e for _, e in near]]
        return float((w * y).sum() / (w.sum() + K / (EPSILON + 1 - PRIOR))), near

    def score(self, text: str | None):
        counts = self.counts(text)
        raw, near = self.vote(self.vector(counts))
        p = self.no_terms if raw is None else float(np.interp(raw, *self.curve))
        return p, near, counts


def lookups(terms: list[bytes]) -> tuple[dict[bytes, int], dict[int, dict[bytes, int]]]:
    """Numbers of the terms that are words, and of the beginnings by length."""
    begun: dict[int, dict[bytes, int]] = {}
    for i, t in enumerate(terms):
        if t.endswith(b"*"):
            begun.setdefault(len(t) - 1, {})[t[:-1]] = i
    return {t: i for i, t in enumerate(terms) if not t.endswith(b"*")}, begun


def unit(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    terms = np.array(sorted(counts), np.int64)
    weights = np.array([(1 + math.log(counts[t])) * idf[t] for t in terms])
    return terms, weights / np.linalg.norm(weights) if len(terms) else weights


def isotonic(raw: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators; knots of a rising curve from vote to probability."""
    pools: list[list[float]] = []  # [sum of raw, sum of labels, count]
    for x, y in sorted(zip(raw, labels, strict=True)):
        pools.append([x, y, 1.0])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    # one pseudo-example of either kind at the ends keeps rates off 0 and 1
    knots = [(x / n, (y + 0.5 * y / n) / (n + 0.5)) for x, y, n in pools]
    xs = np.array([0.0, *[min(max(k[0], 1e-9), 1 - 1e-9) for k in knots], 1.0])
    ys = np.maximum.accumulate(np.array([0.0, *[k[1] for k in knots], knots[-1][1] if knots else 1.0]))
    return xs, ys


# --- learning ----------------------------------------------------------------------
def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def examples_of(docs: DataFrame, labels: DataFrame, limit: int = MAX_EXAMPLES) -> DataFrame:
    """At most ``limit`` labelled documents (by hash of the id): id, label, text.
    The sampled ids are bounded, so they are broadcast and no text is shuffled."""
    ids = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
           .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_label")))
    ids = common.hash_sample(ids, ["_id"], limit)
    return (docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
            .select(F.col("_id").alias("id"), (F.col("_label") == 1).cast("int").alias("label"), "text"))


BAGS = "id long, label int, digest binary, sketch long, words array<long>, terms array<binary>, tfs array<int>"


def _example_terms(batches):
    for rows in batches:
        out = []
        for i, y, text in zip(rows["id"], rows["label"], rows["text"], strict=True):
            tokens = words(text)
            tf: dict[bytes, int] = {}
            for t in [*tokens, *(t + b"*" for n in STEMS for t in stems(tokens, n))]:
                tf[t] = tf.get(t, 0) + 1
            digest = xxhash.xxh128_digest((text or "").encode("utf-8", "surrogatepass"))
            held = [xxhash.xxh64_intdigest(t) >> 1 for t in set(tokens)]
            out.append((i, y, digest, sketch(tokens), held, list(tf), list(tf.values())))
        yield pd.DataFrame(out, columns=["id", "label", "digest", "sketch", "words", "terms", "tfs"])


def distinct_examples(bags: DataFrame) -> DataFrame:
    """One row per id, then per text and label, then without the near copies of
    the first of their sketch and label.  The firsts of groups are broadcast
    if their word hashes take at most ``MAX_BROADCAST_BYTES``; beyond, groups (of
    at most ``MAX_EXAMPLES`` rows) are joined by shuffle."""
    for key in (["id"], ["digest", "label"]):  # also bounds the examples if ids repeat
        bags = bags.groupBy(*key).agg(F.min_by(F.struct(*bags.columns), F.struct("id", "sketch", "label")).alias("e")).select("e.*")
    bags = common.stored(bags, "toxic-texts")
    first = (bags.groupBy(F.col("sketch").alias("_sketch"), F.col("label").alias("_label"))
             .agg(F.min("id").alias("_id"), F.min_by("words", "id").alias("_words"), F.count("*").alias("_n"))
             .where("_n > 1"))
    first = common.broadcast_if_light(common.stored(first, "toxic-firsts"), 8 * F.size("_words"), MAX_BROADCAST_BYTES)
    both = F.size(F.array_intersect("words", "_words"))
    near = ((F.col("sketch") == F.col("_sketch")) & (F.col("label") == F.col("_label")) & (F.col("id") != F.col("_id"))
            & (both >= SIMILAR * (F.size("words") + F.size("_words") - both)))
    return common.stored(bags.join(first, near, "left_anti"), "toxic-distinct")


def select_terms(bags: DataFrame, positives: int, negatives: int) -> list[bytes]:
    """All terms of the examples associated with the label, by falling
    chi-square, ties in byte order; bounded by the words of the toxic examples."""
    n1, n0, n = positives, negatives, positives + negatives
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    chi2 = n * F.pow(a * n0 - b * n1, 2) / ((a + b) * (n - a - b) * n1 * n0)
    chosen = (bags.select("label", F.explode("terms").alias("term")).groupBy("term")
              .agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
              .where((F.col("a") >= MIN_EXAMPLES) & (a / n1 > MIN_RATIO * b / n0) & (a + b < n))
              .withColumn("chi2", chi2).where(F.col("chi2") >= MIN_CHI2)
              .orderBy(F.desc("chi2"), "term"))
    return [bytes(r.term) for r in chosen.select("term").collect()]


def document_frequencies(docs: DataFrame, terms: list[bytes]) -> tuple[np.ndarray, int]:
    """(documents with each term, documents), over whole texts of all rows; each
    task sends one count a term."""
    whole, begun = lookups(terms)

    def count(batches):
        df, n = np.zeros(len(terms), np.int64), 0
        for rows in batches:
            n += len(rows)
            for text in rows["text"]:
                tokens = words(text)
                for t in whole.keys() & set(tokens):
                    df[whole[t]] += 1
                for size, known in begun.items():
                    for t in known.keys() & set(stems(tokens, size)):
                        df[known[t]] += 1
        yield pd.DataFrame({"term": [*range(len(terms)), -1], "n": [*df, n]})

    got = {r.term: r.n for r in docs.select("text").mapInPandas(count, "term int, n long")
           .groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return np.array([got.get(i, 0) for i in range(len(terms))], np.float64), int(got.get(-1, 0))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    bags = distinct_examples(common.stored(examples_of(docs, labels).mapInPandas(_example_terms, BAGS), "toxic-examples"))
    sizes = bags.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    n1, n0 = int(sizes[0]), int(sizes[1] - sizes[0])
    terms = select_terms(bags, n1, n0) if n1 and n0 else []
    df, n = document_frequencies(docs, terms) if terms else (np.zeros(0), 0)
    idf = 1 + np.log((1 + n) / (1 + df))
    known = {t: i for i, t in enumerate(terms)}

    def restricted(batches):
        for rows in batches:
            pairs = [[(known[t], f) for t, f in zip(ts, fs, strict=True) if t in known]
                     for ts, fs in zip(rows["terms"], rows["tfs"], strict=True)]
            yield pd.DataFrame({"id": rows["id"], "label": rows["label"], "terms": [[t for t, _ in x] for x in pairs],
                                "tfs": [[f for _, f in x] for x in pairs]})

    # bounded: MAX_EXAMPLES rows of the terms they hold
    rows = bags.mapInPandas(restricted, "id long, label int, terms array<int>, tfs array<int>").collect()
    rows.sort(key=lambda r: (r.id, r.label))
    vectors = [unit(dict(zip(r.terms, r.tfs, strict=True)), idf) for r in rows]
    model = Model(terms, idf, vectors, [r.label for r in rows], [r.id for r in rows])
    model.curve = calibrate(docs.sparkSession, model, vectors)
    return model


def calibrate(spark, model: Model, vectors):
    """Isotonic curve over the leave-one-out votes of the examples."""
    todo = [i for i, (t, _) in enumerate(vectors) if len(t)]
    if not todo:
        return model.curve

    def votes(batches):
        for rows in batches:
            raw = [model.vote(vectors[i], skip=i)[0] for i in rows["id"]]
            yield pd.DataFrame({"raw": raw, "y": model.labels[rows["id"]]})

    ids = spark.range(len(vectors)).where(F.col("id").isin(todo)) if len(todo) < 100 else \
        spark.range(len(vectors)).where(F.element_at(F.lit([bool(len(t)) for t, _ in vectors]), (F.col("id") + 1).cast("int")))
    got = ids.mapInPandas(votes, "raw double, y double").where("raw IS NOT NULL").collect()
    return isotonic(np.array([r.raw for r in got]), np.array([r.y for r in got])) if got else model.curve


# --- scoring -----------------------------------------------------------------------
JUDGEMENT = T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("evidence", T.ArrayType(T.LongType())),
    T.StructField("evidence_cosines", T.ArrayType(T.DoubleType())),
    T.StructField("evidence_terms", T.ArrayType(T.StringType())),
])
#: neighbours and terms shown as evidence
SHOWN = 5


def judgement(model: Model, text: Column) -> Column:
    """Struct JUDGEMENT of a text column."""
    names = {i: t.decode("utf-8", "replace") for i, t in enumerate(model.terms)}

    @F.pandas_udf(JUDGEMENT)
    def udf(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            p, near, counts = model.score(text)
            top = sorted(counts, key=lambda t: (-(1 + math.log(counts[t])) * model.idf[t], t))[:SHOWN]
            out.append((p, [model.ids[e] for _, e in near[:SHOWN]], [s for s, _ in near[:SHOWN]], [names[t] for t in top]))
        return pd.DataFrame(out, columns=JUDGEMENT.names)

    return udf.asNondeterministic()(text)


def toxicity_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: id, held_out, score, predicted, evidence."""
    common.small_batches(docs.sparkSession)
    model = learn(docs, labels)
    return (docs.select("doc_id", held_out().alias("held_out"), judgement(model, F.col("text")).alias("j"))
            .select("doc_id", "held_out", F.col("j.score").alias("score"),
                    (F.col("j.score") >= THRESHOLD).cast("int").alias("predicted"),
                    "j.evidence", "j.evidence_cosines", "j.evidence_terms"))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored below THRESHOLD, with the columns they had."""
    common.small_batches(docs.sparkSession)
    model = learn(docs, labels)
    judged = docs.select(F.struct("*").alias("_doc")).withColumn("_j", judgement(model, F.col("_doc.text")))
    return judged.where(F.col("_j.score") < THRESHOLD).select(*[F.col("_doc")[c].alias(c) for c in docs.columns])
