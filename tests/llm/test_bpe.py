"""Chunked encoding against the encoder on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")

PIECES = ["word", " the", "\n", "\n\n", "  ", "\t", "'s", "'ll", "'", "l", "ll", "é", "中文", " 12", "!?", "\x1c", "\x85", "\xa0",
          "<|endoftext|>", "🙂", "　", "ß ", "."]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=80), st.integers(5, 40), st.integers(5, 24))
def test_chunks_equal_whole(parts, chunk, overlap):
    text = "".join(parts)
    whole = bpe.encoder(RANKS, P.PATTERN).encode_ordinary(text)
    assert bpe.encode_text(text, RANKS, P.PATTERN, chunk, overlap) == whole


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=300), st.integers(5, 40), st.integers(5, 24))
def test_any_text(text, chunk, overlap):
    whole = bpe.encoder(RANKS, P.PATTERN).encode_ordinary(text)
    assert bpe.encode_text(text, RANKS, P.PATTERN, chunk, overlap) == whole


@pytest.mark.parametrize("chunk, overlap", [(40, 20), (100, 30), (bpe.CHUNK, bpe.OVERLAP)])
def test_spark_equals_whole(spark, chunk, overlap):
    r = random.Random(5)
    texts = [None, "", "a", "x" * 500, " " * 300, "\n\n\n" * 50, "é" * 400]
    texts += ["".join(r.choice(PIECES) for _ in range(r.randrange(400))) for _ in range(40)]
    rows = [(i, t, "extra") for i, t in enumerate(texts)] + [(None, "null id " * 50, "x"), (3, "x" * 500, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    enc = bpe.encoder(RANKS, P.PATTERN)
    want = []
    for i, t, _ in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    coded = bpe.encode(docs, RANKS, P.PATTERN, chunk, overlap).withColumn("b", bpe.decode(bpe.F.col("ids"), RANKS, P.PATTERN))
    got = [tuple(x) for x in coded.selectExpr("doc_id", "bigint(octet_length(ids) / 4)", "sha2(ids, 256)", "sha2(b, 256)").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.bpe_table(docs, RANKS, P.PATTERN).collect() == []
