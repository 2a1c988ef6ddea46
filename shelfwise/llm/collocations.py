"""Phrase collocations by dynamic itemset counting.

The texts are dealt into ``SHARDS`` shards that are scanned in turn, round and
round.  Phrases of all lengths are counted in the same scan: words from the
start, a longer phrase from the scan after both the phrase without its last
word and the one without its first have reached the threshold.  Each phrase is
counted for one full cycle of shards, whatever shard it begins at, so its
count is exact; mining ends when no phrase is left to begin or to complete.

Texts are lower-cased (A-Z), cut into pieces and words and stored once as blocks
of word numbers, each of about ``BLOCK`` bytes of text in one language; a block
that begins inside a text begins with the last words of the one before, so
memory doesn't grow with a text.  A shard is every ``SHARDS``-th block.

The state holds, by language and phrase, the count so far, the shards counted,
the scan at which counting began and the one at which the threshold was
reached.  It lies in buckets by the phrase's hash, and a task merges a bucket.  A
bucket takes on about ``BUCKET_BYTES`` of text, up to ``MOST_BUCKETS`` buckets.  A
scan sends each bucket packed tables, not a row a phrase: a task gathers what its
blocks count up to ``SENT_BYTES`` and then sends one table a bucket, so their
number doesn't grow with blocks times buckets.

A scan is given bitmaps for each length, of the hashes of phrases that have
reached the threshold, ever and within the last scans of a cycle.  They have a
fixed largest size (``MAX_BITS``) and never miss a phrase.  A phrase that only
seems active is counted for nothing: it stays below the threshold, as no shard
is added twice.

Defined results: null and empty texts have no words; a null language is
``und``; repeated documents count each time; ties rank by count, then by the
phrase's UTF-8 bytes; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from shelfwise.session import run_dir

from . import common

SHARDS, LONGEST, THRESHOLD, TOP = 2, 4, 30, 2000
#: bytes of text tallied at once; bits of a bitmap for each phrase in it, and at least and most
BLOCK, BITS_EACH, MIN_BITS, MAX_BITS = 4 << 20, 32, 1 << 16, 1 << 26
BITMAP_ROW = 1 << 15  # bits of one row of bitmap_construct_agg
BUCKET_BYTES, MOST_BUCKETS, ROW_GROUP = 8 << 20, 1 << 16, 16 << 20
#: bytes of counted phrases a task gathers before it sends them; blocks' worth of text, of all languages, that waits to be cut
SENT_BYTES, WAITING = 16 << 20, 4
#: bytes of word numbers a scan's task reads, where that leaves so many tasks
TASK_BYTES, LEAST_TASKS = 64 << 20, 48

#: what parts pieces becomes a word of its own, which no text holds
GAP = b"."
_GAPS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", GAP * 10)
_END = re.compile(rb"[ .,;:!?\t-\r]")
COUNTS_COLUMNS = ["lang", "k", "phrase", "n"]
BLOCKS = "shard int, lang string, names binary, hashes binary, ids binary, held int"
#: rows of the state: the packed phrases still counted of a bucket; a phrase that has reached the threshold; one whose cycle is over
LIVE, REACHED, DONE = 0, 1, 2
STATE = "bucket int, block binary, lang string, k int, phrase string, n long, reach int"


# --- one block of text -------------------------------------------------------------
def split_words(raw: bytes) -> list[bytes]:
    return raw.lower().translate(_GAPS).replace(GAP, b" . ").split()


def _rotated(h):
    return (h << np.uint64(21)) | (h >> np.uint64(43))


def hash_of(word: str | bytes) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(word, 42))


class Bitmap:
    """Membership by the leading bits of a 64-bit hash; never misses a member."""

    def __init__(self, bits: int):
        self.shift, self.bytes = np.uint64(64 - (bits.bit_length() - 1)), np.zeros(bits // 8, np.uint8)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> self.shift
        return (self.bytes[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def numbered(words: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words, their hashes, and the number of each word's."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    names = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in names), np.uint64, len(names))
    return names, hashes, coded.indices.to_numpy()


def alike(h: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct phrase, and how often it occurs: places with
    the word numbers ``parts`` and the hash ``h`` of these.  They are sorted by
    hash, and by the words only if two phrases share a hash."""
    order = np.argsort(h)
    equal = h[order[1:]] == h[order[:-1]]
    after, before = order[1:][equal], order[:-1][equal]
    if not all(np.array_equal(part[after], part[before]) for part in parts):
        order = np.lexsort(parts)
        equal = np.logical_and.reduce([part[order[1:]] == part[order[:-1]] for part in parts])
    edges = np.flatnonzero(np.concatenate([[True], ~equal, [True]]))
    return order[edges[:-1]], np.diff(edges)


def tally(names: list[bytes], hashes: np.ndarray, ids: np.ndarray, held: int, lang: str, known: dict[int, list[Bitmap]],
          single: bool, longest: int = LONGEST) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, phrases, counts, age, hashes) of one language's block.  ``held``
    words at the start were counted with the block before: only phrases that
    end after them count.  ``known``: for each length the bitmaps of phrases
    that have reached the threshold ever, in the last cycle of scans, in the
    last but for its first scan, and so on; the age is the number of the last of
    these that holds one of the phrase's two parts.  ``single``: words are still
    being counted."""
    gap = names.index(GAP) if GAP in names else -1
    texts = pa.array(names, pa.binary())
    seed = _rotated(hash_of(lang))
    if single:
        counts = np.bincount(ids[held:], minlength=len(names))
        if gap >= 0:
            counts[gap] = 0
        some = np.flatnonzero(counts)
        yield 0, pa.array([b""], pa.binary()), counts.sum(keepdims=True), np.zeros(1, np.int64), np.zeros(1, np.uint64)
        yield 1, texts.take(pa.array(some)), counts[some], np.zeros(len(some), np.int64), seed ^ hashes[some]
    if not known:
        return
    own, inside = hashes[ids], ids != gap
    h, whole = seed ^ own, inside
    for k in range(2, longest + 1):
        if k - 1 not in known or len(whole) < 2:
            return
        age = np.full(len(whole), -1, np.int8)  # -1: hasn't reached the threshold
        at = np.flatnonzero(whole)
        for n, bitmap in enumerate(known[k - 1]):
            at = at[bitmap.has(h[at])]
            age[at] = n
        both = np.maximum(age[:-1], age[1:])
        at = np.flatnonzero((np.minimum(age[:-1], age[1:]) >= 0) & (both > 0))
        at = at[at + k > held]
        h, whole = _rotated(h[:-1]) ^ own[k - 1:], whole[:-1] & inside[k - 1:]
        if len(at):
            first, counts = alike(h[at], [ids[at + j] for j in range(k)])
            at = at[first]
            parts = [texts.take(pa.array(ids[at + j])) for j in range(k)]
            yield k, pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())), counts, both[at].astype(np.int64), h[at]


def blocks(texts: Iterator[tuple[str, str]], size: int, longest: int = LONGEST) -> Iterator[tuple[str, list[bytes], int]]:
    """(language, words, words held over) of texts joined to blocks of about
    ``size`` bytes, cut between words where a text is longer.  Of all languages
    ``WAITING`` blocks' worth waits at most; then the one with most gives a
    smaller block."""
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    total = 0
    for lang, text in texts:
        raw = text.encode("utf-8", "surrogatepass")
        if len(raw) <= size:
            waiting.setdefault(lang, []).append(raw)
            sizes[lang] = sizes.get(lang, 0) + len(raw) + 1  # empty texts count too
            total += len(raw) + 1
            full = lang if sizes[lang] >= size else max(sizes, key=sizes.get) if total >= WAITING * size else None
            if full is not None:
                total -= sizes.pop(full)
                yield full, split_words(GAP.join(waiting.pop(full))), 0
            continue
        held: list[bytes] = []
        at = 0
        while at < len(raw):
            cut = _END.search(raw, at + size)  # no word is cut
            end = cut.start() if cut else len(raw)
            words = split_words(raw[at:end])
            yield lang, held + words, len(held)
            held, at = (held + words)[-(longest - 1):], end
    for lang, some in waiting.items():
        yield lang, split_words(GAP.join(some)), 0


#: the packed tables: what a scan has counted, and the phrases still counted
_PHRASE = [("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.binary())]
SENT = pa.schema([*_PHRASE, ("new", pa.int64()), ("age", pa.int32())])
HELD = pa.schema([*_PHRASE, ("n", pa.int64()), ("shards", pa.int64()), ("start", pa.int32()), ("reach", pa.int32())])


def packed(rows: pa.RecordBatch) -> bytes:
    """The rows without their schema, which a small table would mostly be."""
    raw = rows.serialize()
    return raw.size.to_bytes(8, "little") + pa.compress(raw, codec="lz4", asbytes=True)


def unpacked(blocks: Iterable[bytes], schema: pa.Schema) -> pa.Table:
    """The rows of all ``blocks`` in one piece."""
    parts = [pa.ipc.read_record_batch(pa.decompress(pa.py_buffer(b)[8:], int.from_bytes(b[:8], "little"), codec="lz4"), schema) for b in blocks]
    return pa.Table.from_batches(parts, schema).combine_chunks()


def token_blocks(docs: DataFrame, shards: int, longest: int, size: int) -> DataFrame:
    """BLOCKS of all texts."""
    def run(batches):
        texts = ((lang, text) for b in batches for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist(), strict=True))
        shard = TaskContext.get().partitionId()
        for n, (lang, words, held) in enumerate(blocks(texts, size, longest)):
            names, hashes, ids = numbered(words)
            pa.default_memory_pool().release_unused()
            yield pa.RecordBatch.from_arrays(
                [pa.array([(shard + n) % shards], pa.int32()), pa.array([lang]), pa.array([b" ".join(names)], pa.binary()),
                 pa.array([hashes.astype("<u8").tobytes()], pa.binary()), pa.array([ids.astype("<i4").tobytes()], pa.binary()),
                 pa.array([held], pa.int32())], names=["shard", "lang", "names", "hashes", "ids", "held"])

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, BLOCKS)


def scan(shard: DataFrame, known: dict[int, list[Bitmap]], single: bool, longest: int, buckets: int,
         sent: int = SENT_BYTES) -> DataFrame:
    """(bucket, block): what the blocks of a shard count, as packed tables of
    SENT rows: one a bucket for about each ``sent`` bytes that a task counts."""
    def run(batches):
        found, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                pa.default_memory_pool().release_unused()
                names = row["names"].split(b" ") if row["names"] else []
                for part in tally(names, np.frombuffer(row["hashes"], "<u8"), np.frombuffer(row["ids"], "<i4"), row["held"],
                                  row["lang"], known, single, longest):
                    found.append((row["lang"], *part))
                    size += part[1].nbytes + 32 * len(part[1])
                if size >= sent:
                    yield dealt(found, buckets)
                    found, size = [], 0
        if found:
            yield dealt(found, buckets)
    return shard.select("lang", "names", "hashes", "ids", "held").mapInArrow(run, "bucket int, block binary")


def dealt(found: list[tuple], buckets: int) -> pa.RecordBatch:
    """(bucket, block) of what :func:`tally` gave, each with its language."""
    lengths = [len(x[2]) for x in found]
    langs = list(dict.fromkeys(x[0] for x in found))
    rows = pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()).take(pa.array(np.repeat([langs.index(x[0]) for x in found], lengths))),
         pa.array(np.repeat([x[1] for x in found], lengths).astype(np.int32)),
         pa.concat_arrays([x[2] for x in found]),
         pa.array(np.concatenate([x[3] for x in found]).astype(np.int64)),
         pa.array(np.concatenate([x[4] for x in found]).astype(np.int32))], schema=SENT)
    h = np.concatenate([x[5] for x in found])
    found.clear()
    # two bytes each, which numpy sorts by radix
    bucket = (((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows.take(pa.array(order)), bucket[order].astype(np.int32)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist()
    blocks = [packed(rows.slice(a, b - a)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]]), pa.array(blocks, pa.binary())], names=["bucket", "block"])


# --- state -------------------------------------------------------------------------
def phrase_hash(lang: Column, phrase: Column) -> Column:
    """The hash of :func:`tally`, in Spark."""
    def rotated(h):
        return F.shiftleft(h, 21).bitwiseOR(F.shiftrightunsigned(h, 43))
    return F.aggregate(F.split(phrase, " "), F.xxhash64(lang), lambda h, w: rotated(h).bitwiseXOR(F.xxhash64(w)))


def bitmaps(reached: DataFrame, sizes: dict[int, int], step: int, shards: int) -> dict[int, list[Bitmap]]:
    """For each length the bitmaps :func:`tally` takes at scan ``step``: of the
    phrases in ``reached``, of those since scan ``step - shards``, and so on.
    At most ``MAX_BITS`` bits of each reach the driver, however many phrases
    there are."""
    bits = {k: min(MAX_BITS, max(MIN_BITS, 1 << (BITS_EACH * n - 1).bit_length())) for k, n in sizes.items()}
    if not bits:
        return {}
    shift = reduce(lambda out, k: out.when(F.col("k") == k, 64 - (bits[k].bit_length() - 1)), bits, F).otherwise(63)
    age = F.greatest(F.lit(0), F.col("reach") - (step - shards) + 1)
    rows = (reached.where(F.col("k").isin(list(bits)))
            .select("k", age.alias("age"), phrase_hash(F.col("lang"), F.col("phrase")).alias("h"), shift.alias("s"))
            .withColumn("at", F.expr("shiftrightunsigned(h, s)"))
            .groupBy("k", "age", F.shiftright("at", 15).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit(BITMAP_ROW - 1))).alias("bits")))
    out = {k: [Bitmap(n) for _ in range(shards + 1)] for k, n in bits.items()}
    for r in rows.collect():
        part = np.frombuffer(r["bits"], np.uint8)
        at = r["bucket"] * len(part)
        for bitmap in out[r["k"]][:r["age"] + 1]:
            end = min(len(bitmap.bytes), at + len(part))
            bitmap.bytes[at:end] |= part[:end - at]
    return out


def frequent_phrases(docs: DataFrame, shards: int = SHARDS, longest: int = LONGEST, threshold: int = THRESHOLD,
                     size: int = BLOCK) -> DataFrame:
    """(lang, k, phrase, n): phrases of ``k`` words, up to ``longest``, found
    ``threshold`` times or more, with their exact counts; ``k`` 0 is the number
    of words of each language.  At most 62 shards."""
    spark = docs.sparkSession
    folder, lengths = run_dir(spark, "phrase-state"), range(1, longest)
    with common.arrow_rows(spark, 1000):  # a block is a large row: a few make a row group
        (token_blocks(docs, shards, longest, size).write.option("parquet.block.size", ROW_GROUP)
         .partitionBy("shard").parquet(f"{folder}-blocks"))
    texts = spark.read.schema(BLOCKS).parquet(f"{folder}-blocks")
    words = texts.agg(F.sum(F.octet_length("ids"))).first()[0] or 0  # four bytes a word
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MOST_BUCKETS, max(least, 2 * words // BUCKET_BYTES))
    tasks = max(LEAST_TASKS, words // shards // TASK_BYTES)
    state = spark.createDataFrame([], f"{STATE}, step int, part int")
    known, sizes, step, last = {}, dict.fromkeys(lengths, 0), 0, shards - 1
    while step <= last:
        live = state.where((F.col("step") == step - 1) & (F.col("part") == LIVE)).select("bucket", "block", F.lit(True).alias("live"))
        found = scan(texts.where(F.col("shard") == step % shards).coalesce(tasks), known, step < shards, longest, buckets)
        rows = (live.unionByName(found.withColumn("live", F.lit(False))).groupBy("bucket")
                .applyInPandas(merging(step, shards, threshold), f"{STATE}, part int"))
        seen = Observation()
        fresh = [F.count_if((F.col("part") == REACHED) & (F.col("k") == k)).alias(f"k{k}") for k in lengths]
        with common.arrow_rows(spark, 1):
            rows.observe(seen, *fresh).write.partitionBy("part").parquet(f"{folder}/step={step}")
        state = spark.read.schema(f"{STATE}, step int, part int").parquet(folder)
        sizes = {k: sizes[k] + seen.get[f"k{k}"] for k in lengths}
        if any(seen.get[f"k{k}"] for k in lengths):
            # what has reached the threshold lets longer phrases begin at the
            # next scan, and those take one cycle
            last = max(last, step + shards)
        step += 1
        if step <= last:
            reached = state.where((F.col("part") == REACHED) & (F.col("k") < longest))
            known = bitmaps(reached, {k: n for k, n in sizes.items() if n}, step, shards)
    # a phrase that seemed active again after its cycle has a second, lower count
    return (state.where(F.col("part") == DONE).groupBy("lang", "k", "phrase").agg(F.max("n").alias("n"))
            .select(*COUNTS_COLUMNS))


def merging(step: int, shards: int, threshold: int):
    """The state of a bucket after scan ``step``, as STATE rows: what the scan
    counted is added to the phrases that hadn't counted its shard.  A phrase
    begins at the scan after its parts had reached the threshold, which its age
    tells; words begin at 0."""
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        pa.default_memory_pool().release_unused()
        live = rows["live"].to_numpy(bool)
        held, new = unpacked(rows["block"][live], HELD), unpacked(rows["block"][~live], SENT)
        k, full = new["k"].to_numpy(), np.full
        tables = [held.append_column("new", pa.array(np.zeros(len(held), np.int64)))
                  .append_column("first", pa.array(full(len(held), -1, np.int32))).select(MERGED),
                  pa.table({**{c: new[c] for c in ("lang", "k", "phrase", "new")}, "n": np.zeros(len(new), np.int64),
                            "shards": np.zeros(len(new), np.int64), "start": full(len(new), -1, np.int32),
                            "reach": full(len(new), -1, np.int32),
                            "first": np.where(k < 2, 0, new["age"].to_numpy() + (step - shards)).astype(np.int32)}).select(MERGED)]
        sums = pa.concat_tables(tables).group_by(["lang", "k", "phrase"]).aggregate(
            [("n", "sum"), ("new", "sum"), ("shards", "max"), ("start", "max"), ("reach", "max"), ("first", "max")])
        n, new, seen, start, reach, first = (sums[c].to_numpy() for c in (
            "n_sum", "new_sum", "shards_max", "start_max", "reach_max", "first_max"))
        bit = 1 << step % shards
        n = n + np.where(seen & bit == 0, new, 0)
        seen, start = np.where(new > 0, seen | bit, seen), np.where(start < 0, first, start).astype(np.int32)
        newly = (reach < 0) & (n >= threshold)
        reach, over, k = np.where(newly, step, reach).astype(np.int32), start + (shards - 1) <= step, sums["k"].to_numpy()
        whole = pa.table({"lang": sums["lang"], "k": sums["k"], "phrase": sums["phrase"], "n": n, "shards": seen,
                          "start": start, "reach": reach}, schema=HELD)
        out, bucket = [], int(rows["bucket"].iloc[0])
        left = whole.filter(pa.array(~over))
        if len(left):
            out.append(pd.DataFrame({"bucket": [bucket], "block": [packed(left.combine_chunks().to_batches()[0])], "part": [LIVE]}))
        for part, chosen in ((REACHED, newly & (k > 0)), (DONE, over & ((reach >= 0) | (k == 0)))):
            some = whole.select([*COUNTS_COLUMNS, "reach"]).filter(pa.array(chosen))
            some = some.set_column(2, "phrase", some["phrase"].cast(pa.string())).to_pandas()
            out.append(some.assign(bucket=bucket, part=part))
        return pd.concat(out, ignore_index=True).reindex(columns=["bucket", "block", *COUNTS_COLUMNS, "reach", "part"]).astype(
            {"k": "Int32", "n": "Int64", "reach": "Int32"})
    return merge


MERGED = ["lang", "k", "phrase", "n", "new", "shards", "start", "reach", "first"]


# --- collocations ------------------------------------------------------------------
def collocations(frequent: DataFrame, top: int = TOP) -> DataFrame:
    """Scores of the phrases in ``frequent`` (as :func:`frequent_phrases`
    stores them), without those that mostly occur inside a longer one; the
    first ``top`` of each language."""
    big = "decimal(38, 0)"
    candidates = frequent.where(F.col("k") >= 2).select("lang", "k", "phrase", F.col("n").alias("a"))
    cut = candidates.select("*", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    for name, part in (("l", "substring_index(phrase, ' ', cut)"), ("r", "substring_index(phrase, ' ', cut - k)")):
        side = frequent.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("n").alias(name))
        cut = cut.join(side, (F.col("lang") == F.col("_lang")) & (F.expr(part) == F.col("_phrase"))).drop("_lang", "_phrase")
    # exact beyond 64 bits; the quotient is at most a million
    cut = cut.withColumn("score", F.expr(f"(CAST(a AS {big}) * 2000000) DIV (CAST(l AS {big}) + CAST(r AS {big}))"))
    scored = (cut.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"), F.max("a").alias("a"),
                                               F.max("k").alias("k")))
    # the subphrases of longer candidates
    words = F.split("phrase", " ")
    inner = (candidates.where(F.col("k") > 2).withColumn("w", words)
             .select("lang", "a", "k", "w", F.explode(F.expr("sequence(2, k - 1)")).alias("size"))
             .select("lang", "a", "w", "size", F.explode(F.expr("sequence(1, k - size + 1)")).alias("at"))
             .groupBy(F.col("lang").alias("_lang"), F.array_join(F.expr("slice(w, at, size)"), " ").alias("_phrase"))
             .agg(F.max("a").alias("longer")))
    held = (scored.join(inner, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left")
            .where(F.expr(f"longer IS NULL OR CAST(longer AS {big}) * 100 < CAST(a AS {big}) * 80")))
    order = [F.col("low.score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    ranked = (held.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .where(F.col("rank") <= top))
    totals = frequent.where(F.col("k") == 0).select(F.col("lang").alias("_total"), F.col("n"))
    return (ranked.join(totals, F.col("lang") == F.col("_total"))
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "low.l", "low.r", "n", F.col("low.score").cast("long").alias("score")))


def collocation_table(docs: DataFrame, top: int = TOP, **options) -> DataFrame:
    return collocations(common.stored(frequent_phrases(docs, **options), "phrases"), top)
