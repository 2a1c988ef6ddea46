"""Token ids in binary files, Simple-8b coded, in ascending order of document.

Documents are range-partitioned by id, text hash and row number, so that many
equal rows are dealt out like others; each task encodes its range and writes
files of about ``FILE_IDS`` ids: a header, the words of all blocks, an index
(ids and lengths of the documents, block offsets) and a trailer with checksums.
A task that is run again writes other files; the manifest, a table committed by
Spark, names the files that count and gives each its place in the id stream.

Encoding uses the tokenizers library.  White space after a character that is
none always starts a token, so a text is a sequence of units (a run of white
space and the characters up to the next) that are encoded independently; each
worker lets the library encode the units it hasn't met, many in one call, and
remembers a bounded number.  Texts with white space beyond ASCII are handed to
the library whole.

The strings of added tokens in a text are ordinary text, as the README of
``public_tokenizers`` sets it for this vocabulary (``encode_special_tokens``).

Defined results: a null or empty text has only the end id; null document ids
come first; rows of one id are ordered by their text's hash; an empty table
gives no files and no rows.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import run_dir

from . import common, simple8b

#: units a worker remembers; ids packed, and blocks unpacked, at once
MAX_UNITS, FLUSH, BLOCKS_AT_ONCE = 1_200_000, 1 << 21, 4096
#: ids after which a file ends (with the batch of documents that reaches them)
FILE_IDS = 32 << 20
MAGIC = b"S8BT"
HEADER = struct.Struct("<4sI")
TRAILER = struct.Struct("<QQQQI4s")  # documents, blocks, ids, words, checksum of the index, magic

_UNIT = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
_OTHER_SPACE = re.compile("[" + "".join(map(chr, (
    0x85, 0xA0, 0x1680, 0x180E, 0x2000, 0x2D, 0x200F, 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF))) + "]")
_SPACES = frozenset(" \t\n\x0b\x0c\r")


class UnitEncoder:
    """Ids of texts by way of their units."""

    def __init__(self, path: str, end_id: int | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)  # one character stands for one byte
        self.end = [] if end_id is None else [end_id]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str | None, int] = {None: 0}  # None: the end of a document
        # ids of the units in a row, and where each unit's begin; both with room to grow
        self.flat, self.begin, self.used = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), len(self.end)
        self.flat[:self.used] = self.end
        self.begin[1] = self.used

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, units: list[str]) -> None:
        """Encode new units: those that begin with white space and end without
        are joined, as a token starts at each of them; the bytes of the tokens
        tell whose they are."""
        plain = [u for u in units if u[0] in _SPACES and u[-1] not in _SPACES]
        other = [u for u in units if not (u[0] in _SPACES and u[-1] not in _SPACES)]
        for i in range(0, len(plain), 256):
            some = plain[i:i + 256]
            joined = "".join(some)
            ids = np.array(self._library([joined])[0], np.uint32)
            ends = np.cumsum([len(u) for u in some] if joined.isascii() else [len(u.encode()) for u in some])
            reached = np.cumsum(self.token_bytes[ids])
            cuts = np.searchsorted(reached, ends) + 1
            if not (reached[cuts - 1] == ends).all():
                raise ValueError("a token crosses the start of a unit")
            self._add(some, ids, cuts)
        if other:
            found = self._library(other)
            self._add(other, np.array([i for x in found for i in x], np.uint32), np.cumsum([len(x) for x in found]))

    def _add(self, units: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        n, used = len(self.known), self.used + len(ids)
        while used > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(units) + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.flat[self.used:used] = ids
        self.begin[n + 1:n + 1 + len(units)] = self.used + ends
        self.known.update(zip(units, range(n, n + len(units)), strict=True))
        self.used = used

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each)."""
        if len(self.known) > MAX_UNITS:
            self._forget()
        units: list[str | None] = []
        counts = []
        whole: dict[int, str] = {}
        for n, text in enumerate(texts):
            before = len(units)
            if text and not text.isascii() and _OTHER_SPACE.search(text):
                whole[n] = text
            elif text:
                units += _UNIT.findall(text)
            units.append(None)
            counts.append(len(units) - before)
        place = np.fromiter(map(self.known.get, units, itertools.repeat(-1)), np.int64, len(units))
        missed = np.flatnonzero(place < 0).tolist()
        if missed:
            fresh = [units[i] for i in missed]
            self._learn(list(dict.fromkeys(fresh)))
            place[missed] = list(map(self.known.__getitem__, fresh))
        begin = self.begin[place]
        size = self.begin[place + 1] - begin
        after = np.cumsum(size)
        ids = self.flat[np.repeat(begin - (after - size), size) + np.arange(int(after[-1]) if len(after) else 0)]
        last = np.cumsum(counts) - 1
        lengths = np.diff(np.concatenate([[0], after[last]])) if len(texts) else np.zeros(0, np.int64)
        if whole:
            ids, lengths = self._with_whole(whole, ids, lengths)
        return ids, lengths

    def _with_whole(self, whole: dict[int, str], ids, lengths):
        parts = np.split(ids, np.cumsum(lengths)[:-1])
        for n, found in zip(whole, self._library(list(whole.values())), strict=True):
            parts[n] = np.array([*found, *self.end], np.uint32)
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


@functools.cache
def encoder(path: str, end_id: int | None) -> UnitEncoder:
    return UnitEncoder(path, end_id)


# --- one file ----------------------------------------------------------------------
class Writer:
    """Chunks of bytes of one file, and what the manifest needs to know."""

    def __init__(self):
        self.docs: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.offsets: list[np.ndarray] = []
        self.words = self.n_ids = 0

    def _packed(self, ids: np.ndarray) -> bytes:
        words, offsets = simple8b.pack(ids)
        self.offsets.append(offsets + np.uint64(self.words))
        self.words += len(words)
        return words.astype("<u8").tobytes()

    def chunks(self, batches):
        """``batches``: (document ids, nulls, ids in a row, lengths)."""
        yield HEADER.pack(MAGIC, simple8b.BLOCK)
        held, waiting = [], 0
        for docs, nulls, ids, lengths in batches:
            self.docs.append(docs), self.nulls.append(nulls), self.lengths.append(lengths)
            self.n_ids += len(ids)
            held.append(ids)
            waiting += len(ids)
            if waiting >= FLUSH:
                ids = np.concatenate(held)
                full = len(ids) // simple8b.BLOCK * simple8b.BLOCK
                yield self._packed(ids[:full])
                held, waiting = [ids[full:]], len(ids) - full
        if waiting:
            yield self._packed(np.concatenate(held))
        join = lambda x, kind: (np.concatenate(x) if x else np.zeros(0)).astype(kind)
        lengths, offsets = join(self.lengths, "<u8"), join(self.offsets, "<u8")
        index = b"".join(x.tobytes() for x in (join(self.docs, "<i8"), join(self.nulls, "u1"), lengths, offsets))
        yield index + TRAILER.pack(len(lengths), len(offsets), self.n_ids, self.words, zlib.crc32(index), MAGIC)


def read_file(file, size: int):
    """Yield (document id or None, ids) of each document of an open file, some
    blocks at a time; raises ValueError on a damaged file."""
    def part(at: int, n: int) -> bytes:
        file.seek(max(0, at))
        got = file.read(n)
        if at < 0 or len(got) != n:
            raise ValueError("token file is cut off")
        return got

    magic, block = HEADER.unpack(part(0, HEADER.size))
    docs, blocks, n_ids, n_words, check, closing = TRAILER.unpack(part(size - TRAILER.size, TRAILER.size))
    if magic != MAGIC or closing != MAGIC or block != simple8b.BLOCK:
        raise ValueError("not a token file")
    begin = HEADER.size + 8 * n_words
    index = part(begin, size - TRAILER.size - begin)
    if len(index) != 17 * docs + 8 * blocks or zlib.crc32(index) != check:
        raise ValueError("token file has a damaged index")
    ids = np.frombuffer(index, "<i8", docs)
    nulls = np.frombuffer(index, "u1", docs, 8 * docs)
    lengths = np.frombuffer(index, "<u8", docs, 9 * docs).astype(np.int64)
    offsets = np.frombuffer(index, "<u8", blocks, 17 * docs)
    places = np.concatenate([offsets & ~simple8b.ESCAPED, [np.uint64(n_words)]]).astype(np.int64)

    def values():
        for i in range(0, blocks, BLOCKS_AT_ONCE):
            j = min(blocks, i + BLOCKS_AT_ONCE)
            words = np.frombuffer(part(HEADER.size + 8 * int(places[i]), 8 * int(places[j] - places[i])), "<u8")
            yield simple8b.unpack(words, offsets[i:j] - np.uint64(places[i]), min(n_ids, j * block) - i * block)

    source, held = values(), np.zeros(0, np.uint64)
    for doc, null, length in zip(ids.tolist(), nulls.tolist(), lengths.tolist(), strict=True):
        if len(held) < length:
            parts, have = [held], len(held)
            while have < length:
                parts.append(next(source))
                have += len(parts[-1])
            held = np.concatenate(parts)
        yield (None if null else doc), held[:length].astype("<u4")
        held = held[length:]


# --- Spark -------------------------------------------------------------------------
MANIFEST = "file string, bytes long, first_doc long, first_hash long, first_row long, docs long, ids long"


def write_files(docs: DataFrame, path: str, end_id: int | None, folder: str, files: int | None = None,
                file_ids: int = FILE_IDS) -> DataFrame:
    """Write ``docs`` as token files below ``folder``, from ``files`` tasks or as
    many as Spark's shuffle settings give; the stored manifest, with
    ``first_id``, the number of ids in the files before."""
    common.small_batches(docs.sparkSession)

    def write(batches):
        batches = (b for b in batches if len(b))
        first, enc = next(batches, None), encoder(path, end_id)
        while first is not None:
            out, following = Writer(), []

            def encoded(rows, out=out, following=following):
                while rows is not None:
                    null = rows["doc_id"].isna().to_numpy()
                    yield (rows["doc_id"].fillna(0).to_numpy(np.int64), null, *enc.encode(rows["text"].tolist()))
                    rows = next(batches, None)
                    if out.n_ids >= file_ids:
                        following.append(rows)
                        return
            name, size = common.write_file(folder, "tokens.s8b", out.chunks(encoded(first)))
            doc = first["doc_id"].iloc[0]
            yield pd.DataFrame({"file": [name], "bytes": [size], "first_doc": pd.array([None if pd.isna(doc) else int(doc)], "Int64"),
                                "first_hash": [first["h"].iloc[0]], "first_row": [first["row"].iloc[0]],
                                "docs": [sum(map(len, out.lengths))], "ids": [out.n_ids]})
            first = following[0] if following else None

    order = ["doc_id", "h", "row"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"), F.col("text"))
    manifest = (rows.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order)
                .mapInPandas(write, MANIFEST))
    manifest = common.stored(manifest, "token-manifest")  # one row per file
    before = Window.orderBy("first_doc", "first_hash", "first_row").rowsBetween(Window.unboundedPreceding, -1)
    return common.stored(manifest.withColumn("first_id", F.coalesce(F.sum("ids").over(before), F.lit(0))), "token-files")


def read_digests(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files of ``manifest``, decoded: id, place of
    its first id, number of ids, CRC-32 of the ids."""
    def read(batches):
        for rows in batches:
            for name, size, at in zip(rows["file"], rows["bytes"], rows["first_id"], strict=True):
                files, path = common.shared_file_system(folder)
                with files.open_input_file(f"{path}/{name}") as file:
                    found = read_file(file, size)
                    while some := list(itertools.islice(found, 4096)):
                        n = np.array([len(ids) for _, ids in some], np.int64)
                        yield pd.DataFrame({
                            "doc_id": pd.array([d for d, _ in some], "Int64"), "start": at + np.cumsum(n) - n,
                            "n_tokens": n, "ids_crc32": [zlib.crc32(ids.tobytes()) for _, ids in some]})
                        at += int(n.sum())

    files = max(1, manifest.count())
    return manifest.select("file", "bytes", "first_id").repartition(files, "file").mapInPandas(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    folder = run_dir(docs.sparkSession, "tokens")
    return read_digests(write_files(docs, path, end_id, folder), folder)
