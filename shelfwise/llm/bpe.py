"""Byte-level BPE encoding and decoding by overlapping chunks.

A text of up to ``CHUNK`` characters is one chunk and is encoded where it is
read.  A longer one is cut into chunks that overlap by ``OVERLAP`` characters;
the chunks are rows, so they are pre-tokenised in parallel.  Neighbours are
stitched at the first place in their overlap where both pre-tokenisations
start a token after a character that isn't white space: from there on both
read the same tokens, and such a cut changes no match on either side (a match
never runs from a character into white space).  Chunks whose overlap holds no
such place are joined again, so any text is encoded exactly.  The pieces
between the cuts are then encoded in parallel and put together in order;
decoding concatenates the raw bytes of the ids.

Defined results: a null or empty text has no ids; repeated documents are
encoded one by one; special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

CHUNK, OVERLAP = 32_768, 1024
#: characters at a chunk's end whose tokens may differ in the whole text
#: (the pattern looks at most three characters past a match)
MARGIN = 4
CHUNKS_PER_TASK = 64

#: white space as the encoders' pattern has it (Unicode White_Space)
_SPACE = r"\t-\r \x85\xa0" + "".join(map(chr, (0x1680, 0x2000, 0x2D, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


@functools.cache
def encoder(path: str, pattern: str):
    """The tiktoken encoding of a rank file, once per Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def _pretokens(pattern: str):
    # the same classes in this library's words, for \s differs in a few controls
    return regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{_SPACE}\p{{L}}\p{{N}}]")
                         .replace(r"(?!\S)", rf"(?![^{_SPACE}])").replace(r"\s+", f"[{_SPACE}]+"))


_BLANK = regex.compile(f"[{_SPACE}]")


def ids_bytes(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def boundaries(text: str, start: int, pattern: str, last: bool, chunk: int = CHUNK,
               overlap: int = OVERLAP) -> tuple[list[int], list[int]]:
    """Places in the overlaps with the chunk before and after where a token
    begins after a character that isn't white space, as positions in the
    document.  ``text`` is the chunk that begins at ``start``."""
    head, tail = [], []
    trusted = len(text) if last else len(text) - MARGIN
    for m in _pretokens(pattern).finditer(text):
        p = m.start()
        if p > trusted:
            break
        if 0 < p and not _BLANK.match(text[p - 1]):
            if start and p < overlap - MARGIN:
                head.append(start + p)
            if not last and p >= chunk:
                tail.append(start + p)
    return head, tail


def chunks(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, str]]:
    """(start, chunk with its overlap) covering ``text``."""
    if len(text) <= chunk + overlap:
        return [(0, text)]
    return [(s, text[s:s + chunk + overlap]) for s in range(0, max(1, len(text) - overlap), chunk)]


def cuts(heads: list[list[int]], tails: list[list[int]]) -> list[int | None]:
    """For each chunk, where the piece it begins starts: 0 for the first, the
    first place its head shares with the tail of the chunk before, or None if
    it shares none and is to be joined to the chunk before.

    A chunk's tail counts only if the chunk itself was stitched, for then its
    tokens are those of the whole text; chunks after a failed stitch are joined
    too."""
    out: list[int | None] = [0]
    for head, tail in zip(heads[1:], tails, strict=False):
        shared = set(head) & set(tail) if out[-1] is not None else ()
        out.append(min(shared) if shared else None)
    return out


def encode_text(text: str, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """The method in one process, for one text (tests, single strings)."""
    parts = chunks(text, chunk, overlap)
    bounds = [boundaries(t, s, pattern, i == len(parts) - 1, chunk, overlap) for i, (s, t) in enumerate(parts)]
    begins = [c for c in cuts([b[0] for b in bounds], [b[1] for b in bounds]) if c is not None]
    enc = encoder(path, pattern)
    return [i for a, b in zip(begins, [*begins[1:], len(text)], strict=True) for i in enc.encode_ordinary(text[a:b])]


def _encode_column(text: Column, path: str, pattern: str) -> Column:
    @F.pandas_udf("binary")
    def udf(texts: pd.Series) -> pd.Series:
        enc = encoder(path, pattern)
        return pd.Series([ids_bytes(enc.encode_ordinary(t)) if t else b"" for t in texts])
    return udf(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The bytes of a column of ids (little-endian unsigned 32-bit integers)."""
    @F.pandas_udf("binary")
    def udf(column: pd.Series) -> pd.Series:
        enc = encoder(path, pattern)
        return pd.Series([enc.decode_bytes(np.frombuffer(b, "<u4").tolist()) for b in column])
    return udf(ids)


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids): the ids of each whole text as a binary column."""
    common.small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    long_text = F.coalesce(F.length("text") > chunk + overlap, F.lit(False))
    short = docs.where(~long_text).select("doc_id", _encode_column(F.col("text"), path, pattern).alias("ids"))
    return short.unionByName(_encode_long(docs.where(long_text), path, pattern, chunk, overlap))


def _encode_long(docs: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Texts of several chunks.  The chunks are stored once, which fixes the
    row numbers that keep repeated documents apart."""
    def cut(batches):
        for rows in batches:
            for row, doc, text in zip(rows["row"], rows["doc_id"], rows["text"], strict=True):
                parts = chunks(text, chunk, overlap)
                for n in range(0, len(parts), CHUNKS_PER_TASK):  # bounded batches of a very long text
                    some = parts[n:n + CHUNKS_PER_TASK]
                    yield pd.DataFrame({
                        "row": row, "doc_id": pd.array([None if pd.isna(doc) else int(doc)] * len(some), "Int64"),
                        "n": range(n, n + len(some)), "start": [s for s, _ in some], "text": [t for _, t in some],
                        "last": [n + k == len(parts) - 1 for k in range(len(some))]})

    columns = "row long, doc_id long, n long, start long, text string, last boolean"
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInPandas(cut, columns)
    parts = common.stored(rows.repartition("row", "n"), "bpe-chunks")

    def pretokenise(batches):
        for rows in batches:
            found = [boundaries(t, s, pattern, last, chunk, overlap)
                     for t, s, last in zip(rows["text"], rows["start"], rows["last"], strict=True)]
            yield pd.DataFrame({"row": rows["row"], "n": rows["n"], "head": [h for h, _ in found],
                                "tail": [t for _, t in found]})

    bounds = parts.select("row", "n", "text", "start", "last").mapInPandas(
        pretokenise, "row long, n long, head array<long>, tail array<long>")
    by_row = Window.partitionBy("row").orderBy("n")
    shared = F.array_min(F.array_intersect("head", F.lag("tail").over(by_row)))
    # as in cuts(): once a stitch fails, the rest of the text is one piece
    stitched = F.coalesce(shared.isNotNull(), F.lit(False)) | (F.col("n") == 0)
    begins = (bounds.withColumn("cut", F.when(F.col("n") == 0, F.lit(0).cast("long")).otherwise(shared))
              .withColumn("ok", stitched).withColumn("ok", F.min("ok").over(by_row))
              .withColumn("cut", F.when(F.col("ok"), F.col("cut")))
              .withColumn("piece", F.max(F.when(F.col("ok"), F.col("n"))).over(by_row))
              .withColumn("next", F.lead("cut").over(by_row))
              .select(F.col("row").alias("_row"), F.col("n").alias("_n"), "cut", "next", "piece"))
    # what each chunk adds to its piece: from its cut (or its start, if joined)
    # to the next cut (or the next chunk's start)
    begin = F.coalesce("cut", "start")
    end = F.coalesce("next", F.when(F.col("last"), F.lit(None)).otherwise(F.col("start") + chunk))
    pieces = (parts.join(begins, (F.col("row") == F.col("_row")) & (F.col("n") == F.col("_n")))
              .select("row", "doc_id", "piece", "n", begin.alias("begin"), end.alias("end"),
                      "start", "text")
              .withColumn("text", F.when(F.col("end").isNull(), F.expr("substr(text, int(begin - start) + 1)"))
                          .otherwise(F.expr("substr(text, int(begin - start) + 1, int(end - begin))")))
              .select("row", "doc_id", "piece", "n", "text"))

    def encode_pieces(batches):
        """Rows come sorted; chunks of one piece follow each other."""
        enc, key, held, doc = encoder(path, pattern), None, [], None

        def done():
            return pd.DataFrame({"row": [key[0]], "piece": [key[1]], "doc_id": pd.array([doc], "Int64"),
                                 "ids": [ids_bytes(enc.encode_ordinary("".join(held)))]})
        for rows in batches:
            for row, d, piece, text in zip(rows["row"], rows["doc_id"], rows["piece"], rows["text"], strict=True):
                if key != (row, piece):
                    if key:
                        yield done()
                    key, held, doc = (row, piece), [], None if pd.isna(d) else int(d)
                held.append(text)
        if key:
            yield done()

    encoded = (pieces.repartition("row", "piece").sortWithinPartitions("row", "piece", "n")
               .mapInPandas(encode_pieces, "row long, piece long, doc_id long, ids binary"))
    # a document's ids are one value of one row, like its text
    return (encoded.groupBy("row").agg(F.max("doc_id").alias("doc_id"),
                                       F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("p"))
            .select("doc_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x.ids)).alias("ids")))


def bpe_table(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: number of ids, digests of the ids and of the
    bytes they decode to."""
    coded = encode(docs, path, pattern).withColumn("bytes", decode(F.col("ids"), path, pattern))
    return coded.select("doc_id", F.expr("bigint(octet_length(ids) / 4)").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
