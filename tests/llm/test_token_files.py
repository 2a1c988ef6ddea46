"""Simple-8b round trips, and token files against the library on whole texts."""

import io
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfwise.llm import common, simple8b, token_files

VOCABULARY = P.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.just(0), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=1500),
       st.integers(1, 400))
def test_round_trip(values, repeat):
    values = np.array((values * repeat)[:3000], np.uint64)
    words, offsets = simple8b.pack(values)
    assert (simple8b.unpack(words, offsets, len(values)) == values).all()


def test_sizes():
    assert len(simple8b.pack(np.zeros(512, np.uint64))[0]) == 5
    assert len(simple8b.pack(np.full(512, 50_000, np.uint64))[0]) == 171  # 3 of 20 bits
    words, offsets = simple8b.pack(np.array([1 << 63, 5], np.uint64))
    assert words.tolist()[1] == 1 << 63 and offsets[0] & simple8b.ESCAPED


def library():
    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return t


PIECES = ["word", " the", "\n", "\n\n", "  ", "\t", "'s", "'ll", "'", "é", "中文", " 12", "!?", "\x1c", "\x85", "\xa0", "\x0b",
          "<|endoftext|>", "🙂", chr(0x3000), chr(0x180E), chr(0x200B), "ß ", ".", " \t ", "\x1c \n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.lists(st.sampled_from(PIECES), max_size=40).map("".join)), max_size=8))
def test_units_equal_whole(texts):
    ids, lengths = token_files.encoder(VOCABULARY, 2).encode(texts)
    want = [[*library_ids(t), 2] for t in texts]
    assert lengths.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


_LIBRARY = library()


def library_ids(text):
    return _LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_forgetting(monkeypatch):
    monkeypatch.setattr(token_files, "MAX_UNITS", 3)
    enc = token_files.UnitEncoder(VOCABULARY, None)
    for text in ["a b c d e f", "g h i", "a b z"]:
        assert enc.encode([text, text])[0].tolist() == 2 * library_ids(text)


@pytest.mark.parametrize("files, file_ids", [(5, 1 << 20), (None, 1 << 20), (3, 1)])
def test_files(spark, files, file_ids):
    r = random.Random(4)
    rows = [(i, "".join(r.choice(PIECES) for _ in range(r.randrange(300))), 7) for i in range(60)]
    rows += [(60, None, 7), (61, "", 7), (5, "again", 7), (5, "again", 7), (None, "no id", 7), (-3, "below", 7)]
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    folder = token_files.run_dir(spark, "t")
    common.small_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    manifest = token_files.write_files(docs, VOCABULARY, 2, folder, files, file_ids)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    if file_ids == 1:  # a file a batch
        assert manifest.count() >= len(rows) / 7
    got = token_files.read_digests(manifest, folder)
    got = sorted((tuple(x) for x in got.collect()), key=lambda x: x[1])
    ordered = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0))
    assert [g[0] for g in got] == [x[0] for x in ordered]
    by_id = {}
    for d, t, _ in rows:
        by_id.setdefault(d, []).append([*library_ids(t), 2])
    at = 0
    for d, start, n, crc in got:
        assert start == at
        want = [w for w in by_id[d] if len(w) == n and zlib.crc32(np.array(w, "<u4").tobytes()) == crc]
        assert want
        by_id[d].remove(want[0])
        at += n


def test_equal_rows_are_split(spark):
    """A third of the table is one row: it spans tasks and files, and stays in place."""
    rows = [(5, "the same text")] * 300 + [(i, f"text {i}") for i in range(600)]
    folder = token_files.run_dir(spark, "t")
    manifest = token_files.write_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), VOCABULARY, 2, folder, 9)
    files = manifest.collect()
    assert sum(r.first_doc == 5 for r in files) >= 2 and max(r.docs for r in files) < 250
    got = sorted(map(tuple, token_files.read_digests(manifest, folder).collect()), key=lambda x: x[1])
    assert [g[0] for g in got] == sorted(r[0] for r in rows)
    assert all(b[1] == a[1] + a[2] for a, b in zip(got, got[1:]))


def test_very_long_text(spark):
    text = "long words and more " * 100_000
    got = token_files.token_table(spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string"), VOCABULARY, 2)
    want = np.array([*library_ids(text), 2], "<u4")
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got.collect() if r.doc_id == 1} == {(1, len(want), zlib.crc32(want.tobytes()))}


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.token_table(docs, VOCABULARY, 2).collect() == []


def test_damage():
    out = token_files.Writer()
    data = b"".join(out.chunks([(np.array([1, 2]), np.array([0, 0]), np.arange(700, dtype=np.uint32), np.array([300, 400]))]))
    assert [(d, len(x)) for d, x in token_files.read_file(io.BytesIO(data), len(data))] == [(1, 300), (2, 400)]
    index = data[-token_files.TRAILER.size - 20:-token_files.TRAILER.size]
    for bad, error in ((data[:-1], "not a token file"), (data[1:], "not a token file"), (b"", "cut off"),
                       (data.replace(index, b"\xff" * 20), "damaged index")):
        with pytest.raises(ValueError, match=error):
            list(token_files.read_file(io.BytesIO(bad), len(bad)))
