"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole: ``<s>``, its turns, ``</s>``.  A turn is
``[TAG] text [/TAG]``; user, assistant and system have tags of their own,
another role is named on the tag's first line.  Control strings inside texts
get a backslash after their first character (one more, if they hold some
already), which reading back removes.  The rendered text is encoded once, with
the character offsets of its tokens; a token is under the loss mask if its
span meets the span of an assistant's text, found by binary search in the
sorted spans.

Rows are partitioned by conversation and sorted by turn, so a task holds one
conversation at a time.

Defined results: a null text and a null role are empty; turns of equal number
go by role and text, null turns come first, repeated rows are repeated turns;
a conversation without assistant has no token under the mask; a null
conversation id is one conversation.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: characters of rendered conversations sent on at once
FLUSH = 1 << 18
#: role -> tag
TAGS = {"user": "INST", "assistant": "OUT", "system": "SYS"}
OTHER = "ROLE"
_ROLES = {t: r for r, t in TAGS.items()}
_CONTROL = r"(?:/?s>|/?(?:INST|OUT|SYS|ROLE)\])"
_PLAIN = re.compile(rf"([<\[])(\\*)(?={_CONTROL})")
_GUARDED = re.compile(rf"([<\[])\\(\\*)(?={_CONTROL})")
_TURN = re.compile(r"\[(INST|OUT|SYS|ROLE)\] (.*?) \[/\1\]", re.DOTALL)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _GUARDED.sub(r"\1\2", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(text, spans of the assistant's escaped texts, sorted) of a conversation
    given as (role, text)."""
    parts, spans, at = ["<s>"], [], 3
    for role, text in turns:
        tag, body = TAGS.get(role, OTHER), escape(text)
        if tag == OTHER:
            body = escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n" + body
        turn = f"[{tag}] {body} [/{tag}]"
        if role == "assistant":
            begin = at + len(tag) + 3
            spans.append((begin, begin + len(body)))
        parts.append(turn)
        at += len(turn)
    return "".join([*parts, "</s>"]), spans


def parse(text: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation; ValueError if it isn't one."""
    if not (text.startswith("<s>") and text.endswith("</s>")):
        raise ValueError("no conversation")
    turns, at, end = [], 3, len(text) - 4
    while at < end:
        m = _TURN.match(text, at, end)
        if not m:
            raise ValueError(f"no turn at {at}")
        tag, body, role = m[1], m[2], _ROLES.get(m[1])
        if tag == OTHER:
            role, _, body = body.partition("\n")
            role = re.sub(r"\\(.)", lambda x: "\n" if x[1] == "n" else x[1], unescape(role))
        turns.append((role, unescape(body)))
        at = m.end()
    return turns


@functools.cache
def tokenizer(path: str):
    from tokenizers import Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    t.post_processor = processors.ByteLevel(trim_offsets=False)  # a token's span includes its space
    return t


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """For each token span (row of ``offsets``, sorted) whether it meets one of
    the sorted ``spans``."""
    mask = np.zeros(len(offsets), bool)
    for begin, end in spans:
        if begin < end:
            first = np.searchsorted(offsets[:, 1], begin, side="right")  # first token that ends after it begins
            after = np.searchsorted(offsets[:, 0], end, side="left")
            mask[first:after] = True
    return mask


def masked_texts(text: str, offsets: np.ndarray, mask: np.ndarray, spans: list[tuple[int, int]]) -> list[str]:
    """The text of each span as its masked tokens cover it (a token may hold
    part of a character, or reach over the span's end)."""
    out = []
    for begin, end in spans:
        first = np.searchsorted(offsets[:, 1], begin, side="right")
        after = np.searchsorted(offsets[:, 0], end, side="left")
        own = offsets[first:after][mask[first:after]]
        if begin >= end or not len(own):
            out.append("")
            continue
        begins, ends = np.maximum(own[:, 0], begin), np.maximum.accumulate(np.minimum(own[:, 1], end))
        gaps = np.flatnonzero(begins[1:] > ends[:-1])  # none, if the mask covers the span
        out.append("".join(text[a:b] for a, b in zip(
            begins[np.concatenate([[0], gaps + 1])].tolist(), ends[np.concatenate([gaps, [len(ends) - 1]])].tolist(), strict=True)))
    return out


FORMATTED = "conv_id long, text string, ids array<int>, begins array<int>, ends array<int>, mask array<boolean>, spans array<array<int>>"


def format_conversations(turns: DataFrame, path: str) -> DataFrame:
    """FORMATTED: one row per conversation with its rendered text, token ids,
    their offsets, the loss mask and the assistant's spans."""
    common.small_batches(turns.sparkSession)

    def conversations(batches):
        key, held = None, []
        for rows in batches:
            for conv, role, text in zip(rows["conv_id"], rows["role"], rows["text"], strict=True):
                conv = None if pd.isna(conv) else int(conv)
                if held and conv != key:
                    yield key, held
                    held = []
                key = conv
                held.append((role or "", text or ""))
        if held:
            yield key, held

    def work(batches):
        done, size = [], 0
        for conv, held in conversations(batches):
            done.append(_formatted(conv, held, path))
            size += len(done[-1][1])
            if size >= FLUSH:
                yield _frame(done)
                done, size = [], 0
        if done:
            yield _frame(done)

    rows = turns.select("conv_id", "turn", "role", "text")
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInPandas(work, FORMATTED))


def _formatted(conv: int | None, turns: list[tuple[str, str]], path: str) -> tuple:
    text, spans = render(turns)
    coded = tokenizer(path).encode(text, add_special_tokens=False)
    offsets = np.array(coded.offsets, np.int32).reshape(-1, 2)
    return (conv, text, np.array(coded.ids, np.int32), offsets[:, 0], offsets[:, 1], loss_mask(offsets, spans),
            [list(s) for s in spans])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    got = pd.DataFrame(rows, columns=[c.split()[0] for c in FORMATTED.split(", ")])
    return got.assign(conv_id=got["conv_id"].astype("Int64"))


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, loss_tokens long"


def _digests(batches):
    for rows in batches:
        out = []
        for conv, text, begins, ends, mask, spans in zip(*(rows[c] for c in rows.columns), strict=True):
            turns, offsets = parse(text), np.stack([begins, ends], 1).astype(np.int64).reshape(-1, 2)
            loss = "".join(unescape(t) for t in masked_texts(text, offsets, mask, [tuple(s) for s in spans]))
            every = "".join(f"{r}\n{t}\n" for r, t in turns)
            out.append((None if pd.isna(conv) else int(conv), len(turns), _sha(every), len(loss), _sha(loss), len(text),
                        len(mask), int(np.sum(mask))))
        got = pd.DataFrame(out, columns=[c.split()[0] for c in DIGESTS.split(", ")])
        yield got.assign(conv_id=got["conv_id"].astype("Int64"))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def chat_table(turns: DataFrame, path: str) -> DataFrame:
    """One row per conversation, read back from its formatted text."""
    return (format_conversations(turns, path).select("conv_id", "text", "begins", "ends", "mask", "spans")
            .mapInPandas(_digests, DIGESTS))
