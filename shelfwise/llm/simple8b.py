"""Simple-8b: non-negative integers in 64-bit words.

The four high bits of a word, its selector, say how many values of how many
bits the other 60 hold.  Selector 0 escapes: the next word is one raw 64-bit
value.  Selector 1 stands for 120 zeros.  Values are packed in blocks of
``BLOCK``; a block starts a word, and its offset lets any block, or all at
once, be decoded with array operations.  A block with escapes is flagged and
read word by word.
"""

from __future__ import annotations

import numpy as np

BLOCK = 512
#: fixed by the coding: values per word and bits per value, by selector
COUNT = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPED = np.uint64(1 << 63)
#: one to eight values to a word: selectors 15 to 8, and the values each may hold
_LIMITS = np.uint64(1) << BITS[15:7:-1].astype(np.uint64)
#: selectors tried where eight values fit
_DENSE = range(7, 0, -1)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, block offsets with the flag) of ``values``; the last block may
    be short.  All blocks advance together, a word at a time."""
    n = len(values)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    pad = int(COUNT.max())  # zeros after each block, which the reader drops
    kind = np.uint32 if values.max() < 1 << 32 else np.uint64
    limits = np.minimum(_LIMITS, np.iinfo(kind).max).astype(kind)
    grid = np.zeros((blocks, BLOCK + pad), kind)
    flat = np.zeros(blocks * BLOCK, kind)
    flat[:n] = values
    grid[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    stride, flat = BLOCK + pad, grid.reshape(-1)
    size = np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    cursor, live = np.zeros(blocks, np.int64), np.arange(blocks)
    chosen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # blocks, places, selectors
    while len(live):
        at = live * stride + cursor[live]
        top, fitting = np.zeros(len(live), kind), np.zeros(len(live), np.int8)
        for k, limit in enumerate(limits):  # the largest rises and the limit falls: no gaps
            np.maximum(top, flat[at + k], out=top)
            fitting += top < limit
        selector = np.where(fitting > 0, 16 - fitting.astype(np.int64), 0)
        dense = np.flatnonzero(fitting == len(_LIMITS))
        for s in _DENSE:
            if not len(dense):
                break
            fits = flat[at[dense, None] + np.arange(COUNT[s])].max(axis=1).astype(np.uint64) >> np.uint64(BITS[s]) == 0
            dense = dense[fits]
            selector[dense] = s
        chosen.append((live, at, selector))
        cursor[live] += COUNT[selector]
        live = live[cursor[live] < size[live]]
    block, at, selector = (np.concatenate(x) for x in zip(*chosen, strict=True))
    escape = selector == 0
    if escape.any():  # an escape takes two words
        order = np.argsort(at)
        block, at, selector, escape = block[order], at[order], selector[order], escape[order]
        place = np.arange(len(at)) + np.cumsum(escape) - escape
        first = place[np.searchsorted(block, np.arange(blocks))]
    else:  # the k-th round gave each block its k-th word
        count = np.bincount(block, minlength=blocks)
        first = np.cumsum(count) - count
        place = first[block] + np.repeat(np.arange(len(chosen)), [len(x[0]) for x in chosen])
    words = np.zeros(len(at) + int(escape.sum()), np.uint64)
    for s in np.unique(selector).tolist():
        mine = selector == s
        if s == 0:
            words[place[mine] + 1] = flat[at[mine]]
        elif s > 1:
            begin = at[mine]
            body = np.full(len(begin), s << 60, np.uint64)
            for k in range(COUNT[s]):
                body |= flat[begin + k].astype(np.uint64) << np.uint64(k * BITS[s])
            words[place[mine]] = body
        else:
            words[place[mine]] = np.uint64(1 << 60)
    offsets = first.astype(np.uint64)
    offsets[np.unique(block[escape])] |= ESCAPED
    return words, offsets


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of consecutive blocks; ``offsets`` count from the
    first of ``words``."""
    flags = offsets & ESCAPED != 0
    begin = (offsets & ~ESCAPED).astype(np.int64)
    if not flags.any():
        return _unpack_plain(words, begin, n)
    out, ends = [], [*begin[1:].tolist(), len(words)]
    for i, (a, b) in enumerate(zip(begin.tolist(), ends, strict=True)):
        size = min(BLOCK, n - i * BLOCK)
        out.append(_unpack_escaped(words[a:b], size) if flags[i]
                   else _unpack_plain(words[a:b], np.zeros(1, np.int64), size))
    return np.concatenate(out)


def _unpack_plain(words: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = COUNT[selector]
    first = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint32 if (selector < 15).all() else np.uint64)
    for s in np.unique(selector).tolist():
        if s > 1:
            mine = selector == s
            own, at, mask = words[mine], first[mine], np.uint64((1 << int(BITS[s])) - 1)
            for k in range(COUNT[s]):
                out[at + k] = own >> np.uint64(k * BITS[s]) & mask
    # drop the zeros that fill each block's last word
    starts = first[begin]
    sizes = np.minimum(BLOCK, n - BLOCK * np.arange(len(begin)))
    if (np.diff(starts) == BLOCK).all():
        return out[:n]
    return out[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(n)]


def _unpack_escaped(words: np.ndarray, n: int) -> np.ndarray:
    out: list[int] = []
    rest = iter(words.tolist())
    for word in rest:
        s = word >> 60
        if s == 0:
            out.append(next(rest))
        else:
            bits = int(BITS[s])
            out += [word >> bits * k & (1 << bits) - 1 for k in range(COUNT[s])]
    return np.array(out[:n], np.uint64)
