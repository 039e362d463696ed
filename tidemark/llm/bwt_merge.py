"""Merging Burrows-Wheeler transforms by iterative interleave refinement.

Each part of a shard sorts its own suffixes once and keeps their transform: the symbol before each
suffix, in the order of the suffixes. Merging uses the transforms alone. The n-th occurrence of a symbol in a
transform belongs to the n-th suffix that starts with it, which leads from a row to that of the longer
suffix. The merged order starts as one block, the parts one after another, and is refined: after round h it
is sorted by the first h symbols. A round walks the rows in their order and sends each to the bucket of the
symbol before its suffix, which keeps the order inside a bucket; two neighbours stay in one block when
they came from one block. So the rounds yield the interleaving and all common prefixes up to the length
wanted, and no suffix of the whole shard is ever compared again. Only rows with that many symbols before them
in their text take part: they become the suffixes that long, all others run out on the way.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.fm_index import dense, suffix_order

#: Symbols of a part whose suffixes are sorted together.
PART = 1 << 16


def narrow(numbers: np.ndarray) -> np.ndarray:
    """The same numbers, none of them negative, in the smallest type that holds them all."""
    return numbers.astype(np.min_scalar_type(int(numbers.max()) if len(numbers) else 0))


def transformed(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The transform of some texts, in which 0 stands for the end mark before a text, and the order of their
    suffixes, as places in the texts laid end to end with an end mark after each."""
    lens = np.array([len(t) for t in texts])
    joined = np.zeros(int(lens.sum()) + len(texts), np.int64)
    inner = np.ones(len(joined), bool)
    ends = np.cumsum(lens + 1) - 1
    inner[ends] = False
    joined[inner] = np.concatenate(texts).astype(np.int64) + 1
    order = suffix_order(joined, ends)
    return narrow(joined[order - 1]), order.astype(np.int32)


def reaching(back: np.ndarray, reaches: np.ndarray, rounds: int) -> np.ndarray:
    """The rows that can go ``back`` so many rounds, each from a row that ``reaches`` the next. Goes by doubling."""
    rows = at = np.arange(len(back), dtype=np.int32)
    while rounds:
        if rounds & 1:
            on = reaches[at]
            rows, at = rows[on], back[at[on]]
        rounds >>= 1
        if rounds:
            reaches, back = reaches & reaches[back], back[back]
    return rows


def merged(transforms: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose suffixes share their first ``length`` symbols with another's, in merged order, and the block
    of each: those of one block share these symbols. Rows are counted through all transforms.

    A row alone in its block stays alone however its suffix is extended, so it leaves at once.
    """
    size = sum(map(len, transforms))
    back = np.empty(size, np.int32)  # the row of the suffix that is longer by one symbol
    base = 0
    for part in transforms:
        back[base + np.argsort(part, kind="stable")] = np.arange(base, base + len(part), dtype=np.int32)
        base += len(part)
    symbol = np.concatenate(transforms)
    wide = int(symbol.max()) + 1

    # Two symbols a round where the pairs fit 16 bits, which sort by radix.
    step = 2 if wide * wide <= 1 << 16 and length % 2 == 0 else 1
    reaches = symbol > 0
    code = symbol
    if step == 2:
        reaches &= symbol[back] > 0
        code, back = symbol[back].astype(np.uint16) * wide + symbol, back[back]
    code = code.astype(np.uint16 if step == 2 or wide <= 1 << 16 else np.int64, copy=False)

    order = reaching(back, reaches, length // step)
    block = np.zeros(len(order), np.int32)
    for _ in range(length // step):
        codes = code[order]
        by = np.argsort(codes, kind="stable").astype(np.int32)
        codes, block = codes[by], block[by]
        new = np.ones(len(by) + 1, bool)
        new[1:-1] = (codes[1:] != codes[:-1]) | (block[1:] != block[:-1])
        several = ~(new[:-1] & new[1:])
        order = back[order[by[several]]]
        block = np.cumsum(new[:-1], dtype=np.int32)[several]
        if not len(order):
            break
    return order, block


def repeated_intervals(texts: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes whose first ``length`` symbols occur twice or more, in merged order: text,
    offset and block. Suffixes of one block share these symbols."""
    # Symbols dense from 1, the same in all parts.
    lens = np.array([len(t) for t in texts])
    parts = np.split(narrow(dense(np.concatenate(texts)) - 1), np.cumsum(lens)[:-1])
    transforms, orders, held, size = [], [], [], 0
    for k, t in enumerate(parts):
        held.append(t)
        size += len(t)
        if size >= PART or k == len(parts) - 1:
            transform, order = transformed(held)
            transforms.append(transform)
            orders.append(order)
            held, size = [], 0
    rows, block = merged(transforms, length)
    bases = np.cumsum([0] + [len(x) for x in orders[:-1]]).tolist()
    at = np.concatenate([order + base for order, base in zip(orders, bases)])[rows]  # only now are suffixes located
    begin = (np.cumsum(lens + 1) - lens - 1).astype(np.int32)
    text = (np.searchsorted(begin, at, side="right") - 1).astype(np.int32)
    return text, at - begin[text], block
