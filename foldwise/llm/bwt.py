"""Windows of ``w`` symbols that occur more than once in a block of strings, by
threshold-bounded interval expansion on its Burrows-Wheeler transform.

Starting from the interval of the empty string, intervals are extended
backwards, breadth first: at level ``l`` every interval of a string of ``l``
symbols whose right border was found last is extended by each symbol in its
part of the transform, and the right border of the extension, if it is new, has
a common prefix of ``l`` symbols with the row before.  Borders thus come in
order of their common prefix, and the expansion stops at level ``w``: rows with
no border between them agree on at least ``w`` symbols.

A level is a handful of array operations over all its intervals.  The rows need
to be sorted to depth ``w`` only, because an extension uses nothing but counts.
"""

from __future__ import annotations

import numpy as np

PAD, SEP = 0, 1
MAX_SYMBOLS = (1 << 21) - 2  # two ranks and a position share one 63-bit sort key


def sorted_rows(s: np.ndarray, depth: int) -> np.ndarray:
    """Start positions sorted by their next ``depth`` symbols at least (prefix
    doubling; rank, rank and position are packed into one integer per round)."""
    n = s.size
    bits = int(n).bit_length()
    mask, place = np.int64((1 << bits) - 1), np.arange(n, dtype=np.int64)
    width = int(s.max()).bit_length()
    known = (63 - bits) // width
    key = np.zeros(n, np.int64)
    for j in range(min(known, n)):
        key <<= width
        key[:n - j] |= s[j:]
    key = (key << bits) | place
    while True:
        key.sort()
        rows, top = key & mask, key >> bits
        rank = np.empty(n, np.int64)
        step = np.zeros(n, np.int64)
        np.cumsum(top[1:] != top[:-1], out=step[1:])
        if known >= depth or step[-1] == n - 1:
            return rows
        rank[rows] = step
        key = rank << bits
        if known < n:
            key[:n - known] |= rank[known:] + 1
        key = (key << bits) | place
        known *= 2


def borders_below(s: np.ndarray, rows: np.ndarray, w: int) -> np.ndarray:
    """border[q]: rows q-1 and q share fewer than ``w`` symbols (strings that run
    over a separator are not told apart behind it)."""
    n = s.size
    before = s[rows - 1]  # the transform; row of position 0: the last separator
    order = np.argsort(before, kind="stable")
    to_front = np.empty(n, np.int64)
    to_front[order] = np.arange(n)
    first = s[rows]
    extends = before != SEP
    border = np.zeros(n + 1, bool)
    border[0] = border[n] = True
    lb, rb = np.zeros(1, np.int64), np.full(1, n - 1, np.int64)
    for _ in range(w):
        size = rb - lb + 1
        upto = np.cumsum(size)
        at = np.repeat(lb - (upto - size), size) + np.arange(upto[-1])
        owner = np.repeat(np.arange(lb.size), size)
        live = extends[at]
        key = (to_front[at[live]] << 22) | owner[live]
        if not key.size:
            break
        key.sort()
        row, owner = key >> 22, key & ((1 << 22) - 1)
        last = np.ones(row.size, bool)
        last[:-1] = (row[1:] != row[:-1] + 1) | (owner[1:] != owner[:-1]) | (first[row[1:]] != first[row[:-1]])
        ends = np.flatnonzero(last)
        starts = np.concatenate([[0], ends[:-1] + 1])
        new = ~border[row[ends] + 1]
        lb, rb = row[starts[new]], row[ends[new]]
        border[rb + 1] = True
        if not lb.size:
            break
    return border


def repeated_windows(texts: list[bytes], weights: list[int], w: int) -> list[np.ndarray]:
    """For each text a flag per window start: the window's occurrences in all
    texts, each counted with its text's weight, are two or more."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    used = np.zeros(256, np.int64)
    used[raw] = 1
    code = (np.cumsum(used) + SEP).astype(np.uint16)
    lengths = np.array([len(t) for t in texts])
    base = np.concatenate([[0], np.cumsum(lengths + 1)])
    s = np.full(int(base[-1]), SEP, np.uint16)
    inside = np.ones(s.size, bool)
    inside[base[1:] - 1] = False
    s[inside] = code[raw]
    rows = sorted_rows(s, w)
    border = borders_below(s, rows, w)
    weight = np.zeros(s.size, np.int64)
    for b, n, x in zip(base.tolist(), lengths.tolist(), weights):
        weight[b:b + max(0, n - w + 1)] = x
    starts = np.flatnonzero(border[:-1])
    sums = np.add.reduceat(weight[rows], starts)
    flag = np.zeros(s.size, bool)
    flag[rows] = np.repeat(sums >= 2, np.diff(np.append(starts, s.size)))
    return [flag[b:b + max(0, n - w + 1)] for b, n in zip(base.tolist(), lengths.tolist())]
