"""Encoding against the library, bins against brute force."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfwise.llm import packing

VOCABULARY = P.path("word_bpe_49k.json")
_LIBRARY = Tokenizer.from_file(VOCABULARY)
_LIBRARY.encode_special_tokens = True
PIECES = ["Word", " the", "\n", "  ", "\t", "'s", "'LL", "'", "é", "É", "é", "H̱", "́", "中文", " 12", "!?", "\x1c", "\x85",
          "\xa0", "\x0b", "\x0c", "<|endoftext|>", "🙂", chr(0x3000), chr(0x200B), "ß ", "Σ", "ΑΣ ", "İ", "ﬁ", ".", " \t ", "</w>"]


def library(text):
    return _LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.lists(st.sampled_from(PIECES), max_size=40).map("".join)), max_size=6))
def test_words_equal_whole(texts):
    ids, lengths = packing.encoder(VOCABULARY, 1).encode(texts)
    want = [[*library(t), 1] for t in texts]
    assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_blocks_and_forgetting(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 11)
    monkeypatch.setattr(packing, "MAX_WORDS", 3)
    enc = packing.WordEncoder(VOCABULARY, 1)
    texts = ["a b c d e f", "One long text, of many words! " * 9, None, "", "é è " * 20, "x" * 50, " ", "end"]
    for some in ([t] for t in texts), [texts, texts[::-1]]:
        for batch in some:
            ids, lengths = enc.encode(batch)
            want = [[*library(t), 1] for t in batch]
            assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 40))
def test_fullest(counts, room):
    got = packing.fullest(counts, room)
    assert all(n <= counts[k] for k, n in got) and len(dict(got)) == len(got)
    best = max(s for s in (sum(k * u for k, u in zip(counts, uses, strict=True)) for uses in
                           itertools.product(*[range(n + 1) for n in counts.values()])) if s <= room)
    assert sum(k * n for k, n in got) == best


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 1000), max_size=50))
def test_plan(counts):
    bins = packing.plan(counts, 50)
    used = {}
    for combination, times in bins:
        assert times > 0 and sum(k * n for k, n in combination) <= 50
        for k, n in combination:
            used[k] = used.get(k, 0) + n * times
    assert used == counts
    total, sequences = sum(k * n for k, n in counts.items()), sum(t for _, t in bins)
    assert -(-total // 50) <= sequences
    # no piece fits beside another bin's: at most one bin is half empty
    assert sum(t for c, t in bins if 2 * sum(k * n for k, n in c) <= 50) <= 1


def rows_of(seed, n):
    r = random.Random(seed)
    rows = [(i, " ".join(r.choice(["one", "two", "Three", "é", "extraordinarily"]) for _ in range(int(r.paretovariate(0.7) * 4) % 900)), 3)
            for i in range(n)]
    copies = [(1000 + i, "the very same text", 3) for i in range(n // 2)]
    return [*rows, *copies, (None, None, 3), (7, "", 3), (7, "", 3), (-1, None, 3)]


@pytest.mark.parametrize("capacity", [64, 100])
def test_pack(spark, capacity):
    rows = rows_of(3, 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(5)
    pieces = packing.encode_pieces(docs, VOCABULARY, 1, capacity)
    placed = packing.place(pieces, capacity)
    got = placed.collect()
    want = []
    for d, t, _ in rows:
        ids = [*library(t), 1]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4").tobytes()
            want.append((d, n, at, len(part) // 4, zlib.crc32(part)))
    order = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=order) == sorted(want, key=order)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == list(itertools.accumulate([0] + [n for _, n in parts[:-1]]))
        assert sum(n for _, n in parts) <= capacity
    assert set(by) == set(range(len(by)))
    total = sum(x[3] for x in want)
    assert len(by) <= -(-total // capacity) + 1  # copies and short texts fill every gap
    packed = packing.sequences(placed).collect()
    assert sum(len(r.ids) for r in packed) == 4 * total
    ids = {r.sequence_id: r.ids for r in packed}
    for r in got:
        assert ids[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packing_table(docs, VOCABULARY, 1).collect() == []
