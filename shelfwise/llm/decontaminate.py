"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions.

Every benchmark item gives its windows: ``WINDOW`` consecutive words, or the
whole item if it has fewer.  A window's words are ordered by rarity, counted
over all documents; as a window must occur whole, its prefix is the rarest
word alone.  Documents' words are joined with the prefixes only, in the stage
that reads them.  A candidate must lie inside the document (length and
positional bound) and hold the window's second rarest word in its place before
the whole window is compared.  Covered words are counted by joining the
intervals of a document, so nothing is paired within a group.

Equal windows are one window, however many items share them.  Documents are
read twice, once to count words and once to look for windows, however large the
benchmark is.  Up to ``MAX_BROADCAST_BYTES`` its words and windows are
broadcast.  Beyond, a Bloom filter of bounded size is, and only what passes it
leaves its task: word counts, added up first, and places with the words around
them, which meet the windows in a shuffled join.

Defined results: null and empty texts have no words and are not contaminated;
an item without words has no window; an item id that is null isn't listed;
repeated rows (same id and text) each get the result; rows of one id with
different texts are kept apart; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WINDOW = 13
MAX_BROADCAST_BYTES = 32 << 20
MAX_BROADCAST_ROWS = 100_000
#: share of a document's words inside windows, as 1 / this
CONTAMINATED = 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: what stands between words: all ASCII but digits and letters
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; lower() does the same, faster, where all is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    # split, not regexp_extract_all: that copies the text for every match
    return split_words(lower_ascii(F.coalesce(text, F.lit(""))))


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Stored tables (wid, window) of distinct windows, and (wid, item_id)."""
    item = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    item = item.where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    every = (item.withColumn("s", F.explode(starts))
             .select("item_id", F.slice("w", F.col("s"), size).alias("window")).distinct())
    every = common.stored(every, "windows-all")
    distinct = common.stored(every.select("window").distinct()
                             .select(F.monotonically_increasing_id().alias("wid"), "window"), "windows")
    owners = every.join(distinct.withColumnRenamed("window", "_w"), F.col("window") == F.col("_w"))
    return distinct, common.stored(owners.select("wid", "item_id"), "windows-items")


def small(table: DataFrame, words: str) -> bool:
    """Whether a stored table can be broadcast, by the bytes of its words (and
    64 for each word and row)."""
    size = F.aggregate(words, F.lit(64).cast("long"), lambda n, w: n + F.octet_length(w) + 64)
    return (table.agg(F.sum(size)).first()[0] or 0) <= MAX_BROADCAST_BYTES


def word_counts(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(word, count) over all documents of the words in the stored table
    ``known``."""
    every = docs.select(F.explode(words(F.col("text"))).alias("_word"))
    if small(known.select(F.array("word").alias("word")), "word"):
        return every.join(F.broadcast(known), F.col("_word") == F.col("word")).groupBy("word").count()
    some = common.possible(every.withColumn("_h", F.xxhash64("_word")), "_h", known.select(F.xxhash64("word").alias("k")), "k")
    counts = some.where("_possible").groupBy("_word").count()  # before the shuffle
    return counts.join(known, F.col("_word") == F.col("word")).select("word", "count")


def prefixes(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Stored table of windows with their prefix: the rarest word and its place
    in the window, the second rarest and its place.  Ties in word order.
    Windows with a word that no document holds can't occur and are left out."""
    entries = windows.select("wid", F.posexplode("window").alias("at", "word"))
    known = common.stored(entries.select("word").distinct(), "window-words")
    counts = common.stored(word_counts(docs, known), "window-word-counts").withColumnRenamed("word", "_word")
    ranked = (entries.join(counts, F.col("word") == F.col("_word"), "left")
              .groupBy("wid").agg(F.array_sort(F.collect_list(F.struct(
                  F.coalesce("count", F.lit(0)).alias("n"), "word", "at"))).alias("rare")))
    ranked = ranked.withColumn("second", F.coalesce(F.get("rare", F.lit(1)), F.get("rare", F.lit(0))))
    return common.stored(
        windows.join(ranked.withColumnRenamed("wid", "_wid"), F.col("wid") == F.col("_wid"))
        .where(F.col("rare")[0].n > 0)
        .select("wid", "window", F.col("rare")[0].word.alias("prefix"), F.col("rare")[0]["at"].alias("prefix_at"),
                F.col("second.word").alias("second"), F.col("second.at").alias("second_at")), "windows-prefixes")


def occurrences(docs: DataFrame, prefixed: DataFrame, size: int = WINDOW) -> DataFrame:
    """Stored table (doc_id, h, start, end, wid) of the windows in documents;
    h, the text's hash, keeps texts of one id apart."""
    place = (docs.select("doc_id", F.xxhash64("text").alias("h"), words(F.col("text")).alias("w"))
             .select("doc_id", "h", "w", F.posexplode("w").alias("pos", "word")))
    if small(prefixed, "window"):
        found = place.join(F.broadcast(prefixed), _occurs("w", F.col("pos")))
    else:
        place = common.possible(place.withColumn("_h", F.xxhash64("word")), "_h", prefixed.select(F.xxhash64("prefix").alias("k")), "k")
        # what a window around the word can reach
        first = F.greatest(F.col("pos") - (size - 1), F.lit(0))
        near = place.where("_possible").select("doc_id", "h", "pos", "word", (F.col("pos") - first).alias("own"),
                                               F.slice("w", first + 1, F.lit(2 * size - 1)).alias("around"))
        found = near.join(prefixed, _occurs("around", F.col("own")))
    start = F.col("pos") - F.col("prefix_at")
    found = found.select("doc_id", "h", start.alias("start"), (start + F.size("window")).alias("end"), "wid")
    return common.stored(found.distinct(), "window-occurrences")


def _occurs(held: str, at: Column) -> Column:
    """Whether the window lies in the words ``held`` with its prefix at ``at``."""
    start = at - F.col("prefix_at")
    return ((F.col("word") == F.col("prefix")) & (start >= 0)
            & (start + F.size("window") <= F.size(held))
            & (F.get(held, start + F.col("second_at")) == F.col("second"))
            & (F.slice(held, start + 1, F.size("window")) == F.col("window")))


def judge(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per (doc_id, h) that holds a window: n_hit and the items."""
    windows, owners = benchmark_windows(benchmark, size)
    found = occurrences(docs, prefixes(docs, windows), size)
    key = ["doc_id", "h"]
    before = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    covered = (found.groupBy(*key, "start").agg(F.max("end").alias("end"))
               .withColumn("done", F.coalesce(F.max("end").over(before), F.lit(0)))
               .groupBy(*key).agg(F.sum(F.greatest(F.col("end") - F.greatest("start", "done"), F.lit(0)))
                                  .alias("n_hit")))
    owners = common.broadcast_if_small(owners.withColumnRenamed("wid", "_wid"), MAX_BROADCAST_ROWS)
    items = (found.select(*key, "wid").distinct().join(owners, F.col("wid") == F.col("_wid"))
             .groupBy(*key).agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    items = items.select(F.col("doc_id").alias("_i"), F.col("h").alias("_j"), "items")
    return covered.join(items, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("h") == F.col("_j"))).drop("_i", "_j")


def contamination_table(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document: words, words hit, items and the verdict."""
    hits = judge(docs, benchmark, size).withColumnsRenamed({"doc_id": "_i", "h": "_j"})
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"),
                       F.size(split_words(F.coalesce("text", F.lit("")))).cast("long").alias("n_words"))
    rows = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("h") == F.col("_j")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                       F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                       ((n_hit > 0) & (CONTAMINATED * n_hit >= F.col("n_words"))).alias("contaminated"), items.alias("items"))


def filter_documents(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents that aren't contaminated, with the columns they had."""
    hits = common.stored(judge(docs, benchmark, size).select(
        F.col("doc_id").alias("_i"), F.col("h").alias("_j"), "n_hit"), "contaminated")
    hits = common.broadcast_if_small(hits, MAX_BROADCAST_ROWS)
    held = docs.select(F.struct("*").alias("_doc"), F.xxhash64("text").alias("_h"))
    n_words = F.size(split_words(F.coalesce("_doc.text", F.lit(""))))
    bad = (F.col("_doc.doc_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_j")))
    return (held.join(hits, bad, "left").where(F.col("n_hit").isNull() | (CONTAMINATED * F.col("n_hit") < n_words))
            .select(*[F.col("_doc")[c].alias(c) for c in docs.columns]))
