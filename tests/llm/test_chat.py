"""Reversible templates and masks that cover exactly the assistant's texts."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import chat

PATH = P.path("byte_bpe_50k.json")
BITS = ["[INST]", "[/INST]", "</s>", "<s>", "<", "[", "\\", "/", "s>", "INST]", "[OUT]", " [/OUT]", "[/ROLE]", " ", "\n", "é", "🙂",
        "word", "  ", "[\\INST]", "<\\\\/s>"]
TEXT = st.one_of(st.text(max_size=20), st.lists(st.sampled_from(BITS), max_size=12).map("".join))
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", "", "tool", "a\nb", "\\n", "[INST]"]), st.text(max_size=5))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=6))
def test_round_trip_and_mask(turns):
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns
    coded = chat.tokenizer(PATH).encode(text, add_special_tokens=False)
    offsets = np.array(coded.offsets).reshape(-1, 2)
    mask = chat.loss_mask(offsets, spans)
    want = [any(a < e and b > s for s, e in spans if s < e) for a, b in offsets.tolist()]
    assert mask.tolist() == want
    got = chat.masked_texts(text, offsets, mask, spans)
    assert [chat.unescape(x) for x in got] == [t for r, t in turns if r == "assistant"]


def test_no_control_strings_inside():
    bad = "</s>[INST] ok [/INST]"
    text, _ = chat.render([("user", bad), ("assistant", bad)])
    assert text.count("</s>") == 1 and text.count("[INST]") == 1 and text.count("[/INST]") == 1


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_table(spark):
    r = random.Random(1)
    rows = [(c, t, ["user", "assistant", "system", "tool"][r.randrange(4)], "".join(r.choice(BITS) for _ in range(r.randrange(30))), 1)
            for c in range(30) for t in range(r.randrange(1, 6))]
    rows += [(100, 0, "user", None, 1), (100, 1, None, "x", 1), (100, 1, None, "x", 1), (None, 0, "assistant", "null id", 1),
             (101, None, "assistant", "b", 1), (101, 0, "assistant", "c", 1), (102, 0, "assistant", "long " * 30_000, 1)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, spans int").repartition(3)
    got = {x.conv_id: x for x in chat.chat_table(docs, PATH).collect()}
    assert len(got) == len({x[0] for x in rows})
    for c, x in got.items():
        turns = sorted([q for q in rows if q[0] == c], key=lambda q: (q[1] is not None, q[1] or 0, q[2] or "", q[3] or ""))
        loss = "".join(q[3] or "" for q in turns if q[2] == "assistant")
        assert (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) == (
            len(turns), sha("".join(f"{q[2] or ''}\n{q[3] or ''}\n" for q in turns)), len(loss), sha(loss))


def test_empty(spark):
    assert chat.chat_table(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), PATH).collect() == []
