"""Quality rules with risk-controlled thresholds.

Each rule compares one signal of a text with a cutoff.  Cutoffs are not set by
hand: for every stratum (by default the language) and rule, labelled documents
that played no part in writing the candidate grid are the holdout.  A cutoff is
*certified* when the exact binomial test rejects "this rule drops more than
``alpha / rules`` of the good documents of the stratum".  Within a rule the
cutoffs are tested from the mildest to the strictest and testing stops at the
first that isn't rejected (fixed-sequence testing, so the grid costs nothing);
across rules and strata the level is divided by their number (Bonferroni).  So
with probability ``1 - delta`` at once for all strata, the union of the rules
drops at most ``alpha`` of each stratum's good documents.  Of the certified
cutoffs the one with the best trade of bad against good documents is used; a
rule without certified or useful cutoff is off in that stratum.

Defined results: a null text has no words; a null stratum is a stratum of its
own; a label for a document that isn't there, a null label and a null id count
for nothing; of several labels of one id the smallest holds; repeated
documents are judged one by one (and counted one by one); without labels only
the base rules reject.  Input columns are kept whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import common

#: characters of ``[#*$%&|<>]``
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))

SIGNALS = T.StructType([T.StructField(n, T.LongType()) for n in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")])

#: rule -> (signal as SQL over SIGNALS, cutoffs from mild to strict); a text is
#: dropped when the signal is at least the cutoff
RULES = {
    "symbols": ("n_symbols / word_chars", [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03]),
    "repeats": ("n_repeat_words / n_words", [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05]),
    "copied_lines": ("n_dup_lines / n_lines", [0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1]),
    "capitals": ("n_upper / word_chars", [0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15]),
    "long_words": ("word_chars / n_words", [40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 10.0]),
}
ALPHA, DELTA = 0.02, 0.05
#: a cutoff must drop this many bad documents for every good one
BAD_PER_GOOD = 10
MAX_BROADCAST_ROWS = 10_000
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def text_signals(text: str | None) -> tuple[int, ...]:
    """The counts of SIGNALS for one text."""
    if not text:
        return (0,) * len(SIGNALS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly space and \x09-\x0D
    word_bytes = sum(map(len, words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), len(text) - (len(raw) - word_bytes), len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines),
            len(raw) - len(raw.translate(None, UPPER)))


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words inside a window of ``size`` words that occurs twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    if len(index) == len(words):
        return 0
    key = ids[:n]
    for k in range(1, size):  # rank the prefix, so that keys never overflow
        key = key * len(index) + ids[k:n + k]
        if k + 1 < size and len(index) > 2_000_000:
            key = np.unique(key, return_inverse=True)[1]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    inside = np.zeros(len(words) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + size, -1)
    return int(np.count_nonzero(np.cumsum(inside)[:-1]))


def signals(text: Column) -> Column:
    """Struct SIGNALS of a text column (Arrow batches; other columns stay in the JVM)."""
    @F.pandas_udf(SIGNALS)
    def udf(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_signals(t) for t in texts], columns=SIGNALS.names, dtype="int64")
    return udf.asNondeterministic()(text)  # keeps Spark from computing it twice


def rate(rule: str, struct: str) -> Column:
    expr = RULES[rule][0]
    for n in SIGNALS.names:
        expr = expr.replace(n, f"{struct}.{n}") if f"{struct}.{n}" not in expr else expr
    above, below = expr.split(" / ")
    return F.expr(f"CASE WHEN {below} > 0 THEN {above} / {below} ELSE 0D END")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed exactly in logarithms."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    if k >= n * p:
        return 1.0  # never significant; spares long sums
    j = np.arange(k, dtype=np.float64)
    logs = np.concatenate([[0.0], np.cumsum(np.log(n - j) - np.log(j + 1))])
    logs += n * np.log1p(-p) + np.arange(k + 1) * (np.log(p) - np.log1p(-p))
    top = logs.max()
    return float(min(1.0, np.exp(top) * np.exp(logs - top).sum()))


def upper_bound(k: int, n: int, level: float) -> float:
    """Clopper-Pearson upper bound: the rate at which P(X <= k) falls to ``level``."""
    low, high = k / n if n else 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if _tail(k, n, mid) > level else (low, mid)
    return high


def _tail(k: int, n: int, p: float) -> float:
    return 1.0 if n == 0 else binomial_tail(k, n, p)


def certified_cutoffs(counts: pd.DataFrame, alpha: float, level: float) -> pd.DataFrame:
    """One rule in one stratum.  ``counts``: cutoff (mild to strict), good, bad,
    good_dropped, bad_dropped.  Marks the certified cutoffs and the used one."""
    counts = counts.reset_index(drop=True)
    tails = [_tail(int(k), int(n), alpha) if n else 1.0
             for k, n in zip(counts["good_dropped"], counts["good"], strict=True)]
    counts["certified"] = np.logical_and.accumulate(np.array(tails) <= level)
    counts["gain"] = counts["bad_dropped"] - BAD_PER_GOOD * counts["good_dropped"]
    best = counts[counts["certified"] & (counts["gain"] > 0)]
    counts["used"] = False
    if len(best):
        counts.loc[best["gain"].idxmax(), "used"] = True  # the mildest of the best
    counts["bound"] = [upper_bound(int(k), int(n), level) if used else None for k, n, used in
                       zip(counts["good_dropped"], counts["good"], counts["used"], strict=True)]
    return counts


CUTOFFS = "stratum string, rule string, cutoff double, good long, bad long, good_dropped long, bad_dropped long, certified boolean, gain long, used boolean, bound double"


def learn_cutoffs(judged: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Table CUTOFFS from labelled documents: ``stratum``, ``good`` (boolean)
    and the struct ``signals``.  What is gathered is one histogram per stratum
    and rule; its size doesn't depend on the number of documents."""
    hits = [F.struct(F.lit(r).alias("rule"), sum((rate(r, "signals") >= c).cast("int") for c in cuts).alias("hits"))
            for r, (_, cuts) in RULES.items()]
    grid = (judged.where(F.col("good").isNotNull())
            .select("stratum", "good", F.explode(F.array(*hits)).alias("h"))
            .groupBy("stratum", F.col("h.rule").alias("rule"), F.col("h.hits").alias("hits"))
            .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")))
    grid = common.stored(grid, "quality-grid")
    strata = grid.select("stratum").distinct().count()
    level, share = delta / max(1, strata * len(RULES)), alpha / len(RULES)

    def one(key, rows):
        cuts = RULES[key[1]][1]
        good, bad = np.zeros(len(cuts) + 1, np.int64), np.zeros(len(cuts) + 1, np.int64)
        np.add.at(good, rows["hits"].to_numpy(), rows["good"].to_numpy())
        np.add.at(bad, rows["hits"].to_numpy(), rows["bad"].to_numpy())
        out = pd.DataFrame({"cutoff": cuts, "good": good.sum(), "bad": bad.sum(),
                            # a text that hits h cutoffs hits the h strictest
                            "good_dropped": good[::-1].cumsum()[:-1], "bad_dropped": bad[::-1].cumsum()[:-1]})
        out = certified_cutoffs(out, share, level)
        out.insert(0, "rule", key[1])
        out.insert(0, "stratum", key[0])
        return out

    return grid.groupBy("stratum", "rule").applyInPandas(one, CUTOFFS)


def judge(rows: DataFrame, cutoffs: DataFrame, stratum: Column) -> DataFrame:
    """``rows`` (with struct ``_q``) plus ``_fired``, the rules that reject, and
    ``_kept``."""
    used = (cutoffs.where("used").groupBy(F.col("stratum").alias("_s"))
            .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cuts")))
    used = common.broadcast_if_small(common.stored(used, "quality-cutoffs"), MAX_BROADCAST_ROWS)
    rows = rows.join(used, stratum.eqNullSafe(F.col("_s")), "left")
    fired = F.filter(F.array(*[F.when(rate(r, "_q") >= F.col("_cuts")[r], F.lit(r)) for r in RULES]),
                     lambda x: x.isNotNull())
    base = F.expr(BASE_FAILED.replace("n_", "_q.n_"))
    return (rows.withColumn("_fired", fired).withColumn("_base_failed", base)
            .withColumn("_kept", ~F.col("_base_failed") & (F.size("_fired") == 0)).drop("_s", "_cuts"))


def clean_labels(labels: DataFrame, label: str) -> DataFrame:
    """(_label_id, _label): one row per id, the smallest label of the id."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
            .groupBy(F.col("doc_id").alias("_label_id")).agg(F.min(label).alias("_label")))


def judged_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Signals of labelled documents, for :func:`learn_cutoffs`."""
    marked = clean_labels(labels, "quality")
    return (rows.join(marked, F.col("doc_id") == F.col("_label_id"))
            .select("stratum", (F.col("_label") == 1).alias("good"), "signals"))


def quality_table(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """One row per document: id, signals, fired rules, verdict.  The texts are
    read once; what is stored and shuffled is counts."""
    common.small_batches(docs.sparkSession)
    rows = common.stored(docs.select("doc_id", F.col(stratum).cast("string").alias("stratum"),
                                     signals(F.col("text")).alias("signals")), "quality-signals")
    cutoffs = common.stored(learn_cutoffs(judged_labels(rows, labels)), "quality-learnt")
    return (judge(rows.withColumnRenamed("signals", "_q"), cutoffs, F.col("stratum"))
            .select("doc_id", "_q.*", F.col("_base_failed").alias("base_failed"),
                    F.col("_kept").alias("kept"), F.col("_fired").alias("fired_rules")))


def filter_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The documents that pass, with the columns they had.  Each text is read
    once; it is stored beside its counts, and no text is shuffled."""
    common.small_batches(docs.sparkSession)
    held = docs.select(F.struct("*").alias("_doc")).withColumn("_q", signals(F.col("_doc.text")))
    held = common.stored(held, "quality-held")
    own = F.col("_doc")[stratum].cast("string")
    rows = held.select(F.col("_doc.doc_id").alias("doc_id"), own.alias("stratum"), F.col("_q").alias("signals"))
    cutoffs = common.stored(learn_cutoffs(judged_labels(rows, labels)), "quality-learnt")
    return judge(held, cutoffs, own).where("_kept").select(*[F.col("_doc")[c].alias(c) for c in docs.columns])
