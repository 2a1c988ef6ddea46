"""Best-fit packing of token sequences by minimum bin slack.

Documents are encoded, an end id is appended, and only those longer than a
sequence are cut, into pieces of ``CAPACITY`` ids (the last may be shorter).
Pieces of one length are alike, so bins are planned on the number of pieces of
each length: at most ``CAPACITY`` numbers, whatever the corpus.  For each bin
the longest length left is set and a bitset subset-sum over the lengths that
remain finds the fullest feasible combination beside it, which is removed as
often as its lengths last (it stays the fullest feasible one until one of them
runs out).  Pieces then look up their place by length and rank.

Ranks come from a number each encoding task gives its pieces of a length, plus
the pieces of that length in the tasks before; nothing is sorted, and pieces of
one length never meet in one task.

Encoding uses the tokenizers library.  In this vocabulary's pre-tokeniser no
match holds white space, so a text is a sequence of words between ASCII white
space that are encoded independently; each worker lets the library encode the
words it hasn't met and remembers a bounded number.  The strings of special
tokens in a text are ordinary text (``encode_special_tokens``).

Defined results: a null or empty text is a document of the end id alone;
repeated documents are packed one by one; null ids are kept; an empty table has
no pieces; other columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

CAPACITY = 4096
#: words a worker remembers; bytes of a text split at once
MAX_WORDS, BLOCK = 1_000_000, 8 << 20

_SPACE = re.compile(rb"[\t-\r ]")
#: words of lower-case letters, digits and marks of ASCII and Latin, which normalising leaves as they are
_LATIN = "".join(c for c in map(chr, range(0xA1, 0x250)) if c.islower() or c in "ßæøđłªº«»¿¡·")
_PLAIN = re.compile(f"[!-@\\[-~{_LATIN}]+")
#: characters beyond ASCII and Latin, and the one of them whose lower case isn't one character
_CASED = re.compile("[^\\x00-\\x7f\xa1-\u012f\u0131-\u024f]")


#: the end of a document, as a word that no text holds
END = b" "


def _encoded(tokenizer, texts: list[str]) -> list[list[int]]:
    return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class WordEncoder:
    """Ids of texts by way of their words."""

    def __init__(self, path: str, end_id: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token.removesuffix("</w>"))  # one character stands for one byte
        # plain words are normalised already
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.encode_special_tokens = True
        self.end = end_id
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {END: 0}
        # ids of the words in a row, and where each word's begin; both with room to grow
        self.flat, self.begin, self.used = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), 1
        self.flat[0], self.begin[1] = self.end, 1

    def _learn(self, words: list[bytes]) -> None:
        """Encode new words.  Plain ones many in a call, told apart by the
        bytes of their tokens, as normalising doesn't change them."""
        plain, other = [], []
        for w in words:
            (plain if _PLAIN.fullmatch(w.decode("utf-8", "surrogatepass")) else other).append(w)
        for i in range(0, len(plain), 256):
            some = plain[i:i + 256]
            ids = np.array(_encoded(self.plain, [b" ".join(some).decode()])[0], np.uint32)
            ends, reached = np.cumsum([len(w) for w in some]), np.cumsum(self.token_bytes[ids])
            cuts = np.searchsorted(reached, ends) + 1
            if not (reached[cuts - 1] == ends).all():
                raise ValueError("a token crosses the end of a word")
            self._add(some, ids, cuts)
        for i in range(0, len(other), 512):
            some = other[i:i + 512]
            found = _encoded(self.tokenizer, [w.decode("utf-8", "surrogatepass") for w in some])
            self._add(some, np.array([t for x in found for t in x], np.uint32), np.cumsum([len(x) for x in found]))

    def _add(self, words: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        n, used = len(self.known), self.used + len(ids)
        while used > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(words) + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.flat[self.used:used] = ids
        self.begin[n + 1:n + 1 + len(words)] = self.used + ends
        self.known.update(zip(words, range(n, n + len(words)), strict=True))
        self.used = used

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each)."""
        if len(self.known) > MAX_WORDS:
            self._forget()
        words: list[bytes] = []
        ends, parts = [], []

        def done():
            parts.append(self._ids(words))
            words.clear()
        size = count = 0
        for text in texts:
            text = text or ""
            if not _CASED.search(text):
                text = text.lower()  # as the vocabulary does; fewer words to know
            raw, at = text.encode("utf-8", "surrogatepass"), 0
            while at < len(raw):
                cut = _SPACE.search(raw, at + BLOCK) if len(raw) - at > BLOCK else None
                end = cut.start() if cut else len(raw)
                words += raw[at:end].split()  # bytes split at ASCII white space only
                size, at = size + end - at, end
                if size > BLOCK:
                    count += len(words)
                    done()
                    size = 0
            words.append(END)
            ends.append(count + len(words) - 1)
        done()
        lengths = np.concatenate([n for _, n in parts]) if parts else np.zeros(0, np.int64)
        after = np.cumsum(lengths)[np.array(ends, np.int64)] if ends else np.zeros(0, np.int64)
        return np.concatenate([ids for ids, _ in parts]), np.diff(np.concatenate([[0], after]))

    def _ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of words in a row, number of ids of each)."""
        place = np.fromiter(map(self.known.get, words, itertools.repeat(-1)), np.int64, len(words))
        missed = np.flatnonzero(place < 0).tolist()
        if missed:
            fresh = [words[i] for i in missed]
            self._learn(list(dict.fromkeys(fresh)))
            place[missed] = list(map(self.known.__getitem__, fresh))
        begin = self.begin[place]
        size = self.begin[place + 1] - begin
        after = np.cumsum(size)
        return self.flat[np.repeat(begin - (after - size), size) + np.arange(int(after[-1]) if len(after) else 0)], size


@functools.cache
def encoder(path: str, end_id: int) -> WordEncoder:
    return WordEncoder(path, end_id)


PIECES = "doc_id long, piece int, start long, length long, ids binary, task int, nth long"


def encode_pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Stored table: the pieces of every document, ``ids`` as little-endian
    unsigned 32-bit integers, with the number of the task that made each and
    its number among that task's pieces of its length."""
    common.small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task = encoder(path, end_id), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows, piece, start, length, ids, nth = [], [], [], [], [], []
            ids_all, lengths = enc.encode(batch["text"].to_pylist())
            for i, found in enumerate(np.split(ids_all.astype("<u4"), np.cumsum(lengths)[:-1])):
                for n, at in enumerate(range(0, len(found), capacity)):
                    part = found[at:at + capacity]
                    rows.append(i), piece.append(n), start.append(at), length.append(len(part))
                    ids.append(part.tobytes()), nth.append(int(seen[len(part)]))
                    seen[len(part)] += 1
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(rows, pa.int64())).cast(pa.int64()), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                 pa.repeat(pa.scalar(task, pa.int32()), len(rows)), pa.array(nth, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids", "task", "nth"])

    pieces = docs.select("doc_id", "text").mapInArrow(run, PIECES)
    return common.stored(pieces.withColumn("ids_crc32", F.crc32("ids")), "pieces")


# --- plan --------------------------------------------------------------------------
def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, uses) of the combination of at most ``counts`` that fills most
    of ``room``; long pieces first where several do."""
    reach, layers, mask = 1, [], (1 << room + 1) - 1
    for length in sorted(counts, reverse=True):
        left, step = min(counts[length], room // length), 1
        if not left:
            continue
        layers.append((length, left, reach))
        while left:  # 1, 2, 4, ... of them at once
            some = min(step, left)
            reach |= reach << some * length & mask
            left, step = left - some, 2 * step
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, []
    for length, left, before in reversed(layers):
        uses = next(u for u in range(left + 1) if u * length <= at and before >> at - u * length & 1)
        if uses:
            out.append((length, uses))
            at -= uses * length
    return out[::-1]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Minimum bin slack: (combination, number of bins it fills), in order."""
    left, out = {k: v for k, v in counts.items() if v}, []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        uses = dict(fullest(rest, capacity - longest))
        uses[longest] = uses.get(longest, 0) + 1
        times = min(left[k] // n for k, n in uses.items())
        for k, n in uses.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        out.append((sorted(uses.items(), reverse=True), times))
    return out


class Places:
    """Where the piece of a length and rank goes: runs of ranks by search."""

    def __init__(self, bins: list[tuple[list[tuple[int, int]], int]]):
        used: dict[int, int] = {}
        rows, sequence = [], 0
        for combination, times in bins:
            offset = 0
            for length, uses in combination:
                first = used.get(length, 0)
                rows.append((length, first, uses, sequence, offset))
                used[length] = first + uses * times
                offset += length * uses
            sequence += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.first, self.uses, self.sequence, self.offset = table.T
        self.key = (self.length << 48) + self.first
        self.sequences = sequence

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.key, (length << 48) + rank, side="right") - 1
        nth = rank - self.first[run]
        return self.sequence[run] + nth // self.uses[run], self.offset[run] + nth % self.uses[run] * length


# --- Spark -------------------------------------------------------------------------
def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset.  The driver sees one number per
    length; what it sends back is bounded by the lengths too."""
    counted = common.stored(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(plan(counts, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counted.select(F.col("length").alias("_length"), F.col("task").alias("_task"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places.find(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    ranked = pieces.join(firsts, (F.col("length") == F.col("_length")) & (F.col("task") == F.col("_task")))
    found = ranked.withColumn("_place", find("length", F.col("_first") + F.col("nth")))
    return found.select(*[c for c in pieces.columns if c not in ("task", "nth")], "_place.sequence_id", "_place.offset")


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: one row each, the ids of its pieces in a row and
    where each piece begins.  A sequence holds at most ``CAPACITY`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return (placed.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x.ids)).alias("ids"),
                    F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets")))


def packing_table(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    pieces = encode_pieces(docs, path, end_id, capacity)
    return place(pieces.drop("ids"), capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
