"""Suffix sorting by external induction, with common-prefix values.

Positions that start an ascending run after a descent (LMS) are ordered first: their substrings get
names, and the text of names is sorted by the same procedure unless it is small enough for doubling.
Induction then derives the order of all other suffixes: queues of (position, common prefix) tuples, one
per first symbol, are emptied in ascending order for descending-type suffixes and in descending order
for the rest. Queues append in order and give back in order, so they are priority queues whose runs lie
on disk once they exceed a number of tuples. Common prefixes travel with the tuples: that of two
induced suffixes is one more than the least one between their sources.

Orders and prefixes are exact up to a depth and undecided beyond it.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np

# Tuples all queues of a level may keep in memory.
IN_MEMORY = 4_000_000
# Texts of at most so many names are ordered by doubling instead of a further level.
BASE = 1 << 22


class Queues:
    """One first-in-first-out queue of (position, common prefix) tuples per symbol. What exceeds the
    limit is appended to a file of the task's scratch folder, removed with the object."""

    def __init__(self, limit: int):
        self.limit, self.held = limit, 0
        self.runs: dict[int, deque] = defaultdict(deque)
        self.file = None

    def push(self, symbol: int, rows: np.ndarray) -> None:
        self.runs[symbol].append(rows)
        self.held += len(rows)
        if self.held > self.limit:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for runs in self.runs.values():
            for i, rows in enumerate(runs):
                if isinstance(rows, np.ndarray):
                    runs[i] = (self.file.tell(), len(rows))
                    self.file.write(np.ascontiguousarray(rows).data)
        self.held = 0

    def _load(self, rows) -> np.ndarray:
        if isinstance(rows, np.ndarray):
            self.held -= len(rows)
            return rows
        at, n = rows
        self.file.seek(at)
        return np.frombuffer(self.file.read(16 * n), np.int64).reshape(n, 2)

    def pop(self, symbol: int) -> Iterator[np.ndarray]:
        """The tuples of a symbol, oldest first, also those pushed meanwhile; all that wait at a time,
        up to about the limit."""
        runs = self.runs[symbol]
        while runs:
            some, n = [], 0
            while runs and n < self.limit:
                some.append(self._load(runs.popleft()))
                n += len(some[-1])
            yield np.concatenate(some) if len(some) > 1 else some[0]

    def pop_last(self, symbol: int) -> Iterator[np.ndarray]:
        runs = self.runs[symbol]
        while runs:
            yield self._load(runs.pop())

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def ascending(text: np.ndarray) -> np.ndarray:
    """Type of each suffix: whether it is smaller than the next one. The last is."""
    n = len(text)
    differs = np.ones(n, bool)
    differs[:-1] = text[:-1] != text[1:]
    up = np.ones(n, bool)
    up[:-1] = text[:-1] < text[1:]
    decides = np.where(differs, np.arange(n), n)
    return up[np.minimum.accumulate(decides[::-1])[::-1]]


def _refine(rank: np.ndarray, key: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Split groups of equal rank by a key. A rank is the place of its group's first member; ``open_``
    are the members of groups that are not yet single."""
    order = open_[np.lexsort((key[open_], rank[open_]))]
    r, k = rank[order], key[order]
    same = r[1:] == r[:-1]
    head = np.ones(len(order), bool)
    head[1:] = ~same
    start = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    part = head.copy()
    part[1:] |= k[1:] != k[:-1]
    first = np.maximum.accumulate(np.where(part, np.arange(len(order)), 0))
    new = r + first - start
    rank = rank.copy()
    rank[order] = new
    single = part.copy()
    single[:-1] &= part[1:]
    return rank, order[~single]


def _names(text: np.ndarray, up: np.ndarray, lms: np.ndarray, depth: int):
    """Ranks of the substrings from each LMS position to the next, and those still equal to another.
    Symbols are compared with their types; substrings are compared to the depth at most."""
    ends = np.append(lms[1:], lms[-1]) + 1
    lengths = np.minimum(ends - lms, depth + 1)
    typed = text.astype(np.int64) * 2 + up + 1
    wide = 1 if typed.max() >= 1 << 15 else 4
    rank, open_ = np.zeros(len(lms), np.int64), np.arange(len(lms))
    for at in range(0, int(lengths.max()), wide):
        key = np.zeros(len(lms), np.int64)
        for d in range(wide):
            inside = np.flatnonzero(lengths > at + d)
            key[inside] += typed[lms[inside] + at + d] << (16 * (wide - 1 - d) if wide > 1 else 0)
        if at:
            going = np.unique(rank[open_][lengths[open_] > at])
            some = open_[np.isin(rank[open_], going)]
            if not len(some):
                break
            rank, still = _refine(rank, key, some)
            open_ = np.concatenate([np.setdiff1d(open_, some, assume_unique=True), still])
        else:
            rank, open_ = _refine(rank, key, open_)
    return rank, open_


def order_lms(text: np.ndarray, up: np.ndarray, lms: np.ndarray, depth: int, base: int, limit: int) -> np.ndarray:
    """The LMS positions in the order of their suffixes."""
    rank, open_ = _names(text, up, lms, depth)
    if len(open_) and len(lms) > base:
        inner = np.append(rank + 1, 0)
        place = np.empty(len(lms), np.int64)
        end = len(lms)
        for rows in suffixes(inner, depth // 2 + 2, base=base, limit=limit):
            place[end - len(rows) : end] = rows[:, 0]
            end -= len(rows)
        return lms[place]
    step = 1
    while len(open_) and step <= depth:
        following = np.zeros(len(lms), np.int64)
        following[:-step] = rank[step:] + 1
        rank, open_ = _refine(rank, following, open_)
        step *= 2
    return lms[np.argsort(rank, kind="stable")]


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Lengths of common prefixes of pairs of suffixes, by comparison, up to the depth. Bytes are
    compared eight at a time."""
    wide = 8 if text.dtype == np.uint8 else 1
    n = len(text)
    if wide == 8:
        padded = np.concatenate([text, np.zeros(depth + 8, np.uint8)])
        words = np.ndarray(n + depth, "<u8", padded.data, strides=(1,))
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for d in range(0, depth, wide):
        x, y = a[live] + d, b[live] + d
        if wide == 8:
            differs = words[x] ^ words[y]
            low = differs & (~differs + np.uint64(1))
            equal = np.where(differs == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8)
            # What lies beyond the end is no part of a suffix.
            equal = np.minimum(equal, np.maximum(n - np.maximum(x, y), 0))
        else:
            inside = (x < n) & (y < n)
            equal = (inside & (text[np.minimum(x, n - 1)] == text[np.minimum(y, n - 1)])).astype(np.int64)
        out[live] = np.minimum(d + equal, depth)
        live = live[equal == wide]
        if not len(live):
            break
    return out


class _Least:
    """Range minima of a batch of common prefixes."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        size = 1
        while 2 * size <= len(values):
            below = self.levels[-1]
            self.levels.append(np.minimum(below[:-size], below[size:]))
            size *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minimum over [a, b), each not empty."""
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.levels[k]
            out[at] = np.minimum(row[a[at]], row[b[at] - (1 << int(k))])
        return out


class _Inducer:
    """Puts the predecessors of scanned suffixes into queues, with their common prefixes."""

    def __init__(self, text, wanted, depth, symbols, queues):
        self.text, self.wanted, self.depth, self.queues = text, wanted, depth, queues
        self.since = np.full(symbols, depth, np.int64)
        self.used = np.zeros(symbols, bool)

    def __call__(self, rows: np.ndarray) -> None:
        at, common = rows[:, 0], rows[:, 1]
        source = np.flatnonzero((at > 0) & self.wanted[at - 1])
        upto = np.minimum.accumulate(common)
        if len(source):
            symbol = self.text[at[source] - 1]
            order = np.argsort(symbol, kind="stable")
            s, c = source[order], symbol[order]
            first = np.ones(len(s), bool)
            first[1:] = c[1:] != c[:-1]
            prefix = np.zeros(len(s), np.int64)
            heads = np.flatnonzero(first)
            known = self.used[c[heads]]
            prefix[heads] = np.where(known, np.minimum(self.since[c[heads]], upto[s[heads]]) + 1, 0)
            rest = np.flatnonzero(~first)
            if len(rest):
                prefix[rest] = _Least(common)(s[rest - 1] + 1, s[rest] + 1) + 1
            np.minimum(prefix, self.depth, out=prefix)
            tuples = np.stack([at[s] - 1, prefix], axis=1)
            np.minimum(self.since, upto[-1], out=self.since)
            after = np.append(np.minimum.accumulate(common[::-1])[::-1], self.depth)
            ends = np.append(heads[1:], len(s))
            for a, b in zip(heads.tolist(), ends.tolist()):
                k = int(c[a])
                self.queues.push(k, tuples[a:b])
                self.since[k], self.used[k] = after[s[b - 1] + 1], True
        else:
            np.minimum(self.since, upto[-1], out=self.since)


def suffixes(text: np.ndarray, depth: int, base: int = BASE, limit: int = IN_MEMORY) -> Iterator[np.ndarray]:
    """All suffixes but the last in ascending order, as arrays of (position, prefix shared with the one
    before it). The text ends with its least symbol, one 0. Arrays come from the largest first symbol down;
    inside an array the order ascends, and its first row shares nothing with what comes before it."""
    up = ascending(text)
    lms = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    if not len(lms):
        return
    sorted_lms = order_lms(text, up, lms, depth, base, limit)
    shared = np.append(0, common_prefix(text, sorted_lms[:-1], sorted_lms[1:], depth))
    seeds = np.stack([sorted_lms, shared], axis=1)
    heads = text[sorted_lms]
    top = int(text.max()) + 1
    present = np.flatnonzero(np.bincount(text, minlength=top))
    down_queues, done, up_queues = Queues(limit), Queues(limit), Queues(limit)
    try:
        meet = lambda a, b: int(common_prefix(text, np.array([a]), np.array([b]), depth)[0])
        induce = _Inducer(text, ~up, depth, top, down_queues)
        for c in present.tolist():
            last = None
            for rows in down_queues.pop(c):
                done.push(c, rows)
                induce(rows)
                last = rows[-1, 0]
            a, b = np.searchsorted(heads, [c, c + 1])
            if b > a:
                rows = seeds[a:b].copy()
                rows[0, 1] = 0 if last is None else meet(last, rows[0, 0])
                induce(rows)
        induce = _Inducer(text, up, depth, top, up_queues)
        for c in present[::-1].tolist():
            out, last, carried = [], None, None
            for rows in up_queues.pop(c):
                induce(rows)
                last = rows[-1, 0]
                out.append(rows)
            for rows in done.pop_last(c):
                back = rows[::-1].copy()
                # Each row's prefix belongs to the pair with its smaller neighbour; going down, it is
                # the next row's.
                back[1:, 1] = rows[::-1][:-1, 1]
                if carried is not None:
                    back[0, 1] = carried
                else:
                    back[0, 1] = 0 if last is None else meet(back[0, 0], last)
                induce(back)
                out.append(back)
                carried = rows[0, 1]
            if out:
                falling = np.concatenate(out)
                rising = falling[::-1].copy()
                rising[1:, 1] = falling[::-1][:-1, 1]
                rising[0, 1] = 0
                yield rising
    finally:
        for q in (down_queues, done, up_queues):
            q.close()
