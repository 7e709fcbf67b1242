"""Runs that hold their owner's gram exactly once, as columns.

Every window of such a run holds the gram, so a run is what stands before and behind it: two rows of bytes of at most
``window - gram``, counted from the gram outwards. Equal windows have the gram at the same place, so what two runs share on either side
decides how far their common windows reach. All steps here work on whole columns: equal runs become one row, groups are the
rows of one owner and one check of the gram.

A side is stored plus one with zeros where nothing is: UTF-8 has no byte above 0xF4, so this fits, and order and equality of
the rows are those of the bytes.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

NO_ID = np.iinfo(np.int64).max


def side(raw: np.ndarray, first: np.ndarray, sign: int, length: np.ndarray, wide: int) -> np.ndarray:
    """``length`` bytes from ``first`` on, forwards or backwards, as rows of ``wide``."""
    step = np.arange(wide)
    inside = step < length[:, None]
    return np.where(inside, raw[np.where(inside, first[:, None] + sign * step, 0)] + np.uint8(1), np.uint8(0))


def as_rows(*columns: np.ndarray) -> np.ndarray:
    """Columns side by side as byte strings whose order is that of the columns, numbers by size."""
    parts = []
    for c in columns:
        if c.ndim == 1:
            c = np.ascontiguousarray(c.astype(c.dtype.newbyteorder(">"))).view(np.uint8).reshape(len(c), c.itemsize)
        parts.append(c)
    rows = np.concatenate(parts, axis=1)
    return rows.view(f"S{rows.shape[1]}").ravel()


def expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first``, ``first + 1``, ... of every row, ``count`` of them."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


@dataclass
class Runs:
    """Distinct runs: owner, check of the gram, both sides, smallest id, and where they start (``count`` places each)."""

    owner: np.ndarray
    check: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    count: np.ndarray
    starts: np.ndarray

    def pack(self, a: int, b: int, starts: np.ndarray, planes: Callable[[np.ndarray], bytes]) -> bytes:
        text = np.concatenate([self.left[a:b, ::-1], self.right[a:b]], axis=1)
        lengths = np.concatenate([(s[a:b] > 0).sum(axis=1) for s in (self.left, self.right)]).astype(np.uint8)
        columns = (self.owner[a:b].astype("<u8"), self.check[a:b].astype("<u2"), self.value[a:b].astype("<i8"))
        body = [struct.pack("<2q", b - a, len(starts)), *map(planes, columns), planes(self.count[a:b].astype("<u4"))]
        return b"".join([*body, planes(starts.astype("<u4")), lengths.tobytes(), text[text > 0].tobytes()])

    @staticmethod
    def unpack(raw: bytes, wide: int, planes: Callable[[bytes, str, int, int], tuple[np.ndarray, int]]) -> "Runs":
        n, m = struct.unpack_from("<2q", raw)
        at, columns = 16, []
        for kind, size in (("<u8", n), ("<u2", n), ("<i8", n), ("<u4", n), ("<u4", m)):
            column, at = planes(raw, kind, size, at)
            columns.append(column)
        owner, check, value, count, starts = columns
        lengths = np.frombuffer(raw, np.uint8, 2 * n, at).reshape(2, n, 1)
        step = np.arange(wide)
        text = np.zeros((n, 2 * wide), np.uint8)
        text[np.concatenate([step >= wide - lengths[0].astype(np.int64), step < lengths[1]], axis=1)] = np.frombuffer(raw, np.uint8, -1, at + 2 * n)
        left, right = np.ascontiguousarray(text[:, :wide][:, ::-1]), np.ascontiguousarray(text[:, wide:])
        return Runs(owner, check, left, right, value, count.astype(np.int64), starts.astype(np.int64))

    def text(self, k: int) -> bytes:
        """A run as one text: the check, the gram's place, what stands before and behind."""
        left, right = (row[row > 0] - np.uint8(1) for row in (self.left[k, ::-1], self.right[k]))
        return int(self.check[k]).to_bytes(2, "little") + bytes((len(left),)) + left.tobytes() + right.tobytes()

    def without(self, some: list[int]) -> "Runs":
        keep = np.ones(len(self.owner), bool)
        keep[some] = False
        starts = self.starts[np.repeat(keep, self.count)]
        return Runs(*(c[keep] for c in (self.owner, self.check, self.left, self.right, self.value, self.count)), starts)


def gather(chunk, some: np.ndarray, first: np.ndarray, check: np.ndarray, ids: np.ndarray, buckets: int) -> tuple[Runs, np.ndarray]:
    """These runs of a chunk, equal ones once and in order of their bucket; and ranges that an equal run of a smaller id decides here."""
    rule = chunk.rule
    start, doc = chunk.start[some], ids[chunk.of[some]]
    size = chunk.length[some] - 1 + rule.window
    wide, owner = rule.window - rule.gram, chunk.owner[some]
    left = side(chunk.raw, first - 1, -1, first - start, wide)
    right = side(chunk.raw, first + rule.gram, 1, start + size - first - rule.gram, wide)
    _, at, index = np.unique(as_rows(owner, check, left, right), return_index=True, return_inverse=True)
    least = np.full(len(at), NO_ID, dtype=np.int64)
    np.minimum.at(least, index, doc)
    smallest = doc == least[index]
    order = np.lexsort((at, owner[at] % np.uint64(buckets)))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    place = rank[index[smallest]]
    starts = start[smallest][np.argsort(place, kind="stable")]
    count = np.bincount(place, minlength=len(order))
    at = at[order]
    echo = np.stack([start, start + size], axis=1)[~smallest]
    return Runs(owner[at], check[at], left[at], right[at], least[order], count, starts), echo


def longest_shared(rows: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For every row, the length of the longest prefix that another row of its group has too; zeros fill up short rows."""
    keyed = as_rows(group.astype(np.uint32), rows)
    order = np.argsort(keyed, kind="stable")
    group, rows = group[order], rows[order]
    differ = rows[1:] != rows[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    shared[group[1:] != group[:-1]] = 0
    best = np.zeros(len(rows), np.int64)
    best[order[1:]] = shared
    best[order[:-1]] = np.maximum(best[order[:-1]], shared)
    return np.minimum(best, (rows[np.argsort(order)] > 0).sum(axis=1))


def smallest_of_windows(left, right, group, least, wide, by_window) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows that share a window with another row of their group; one after the other their windows' smallest ids; how many each has.

    A row is cut to the longest reach of a window it shares; what is left is sorted once per group, the gram as one symbol of its own.
    """
    size_left, size_right = (left > 0).sum(axis=1), (right > 0).sum(axis=1)
    reach_left, reach_right = longest_shared(left, group), longest_shared(right, group)
    live = np.flatnonzero(reach_left + reach_right >= wide)
    windows = (size_left + size_right - wide + 1)[live]
    if not len(live):
        return live, np.zeros(0, np.int64), windows
    step = np.arange(wide)
    short_left = np.where(step < reach_left[live, None], left[live], np.uint8(0))
    short_right = np.where(step < reach_right[live, None], right[live], np.uint8(0))
    _, first, index = np.unique(as_rows(group[live].astype(np.uint32), short_left, short_right), return_index=True, return_inverse=True)
    known = np.full(len(first), NO_ID, dtype=np.int64)
    np.minimum.at(known, index, least[live])
    zero = np.zeros((len(first), 1), np.int64)
    symbols = np.concatenate([short_left[first, ::-1], zero + 257 + group[live[first], None], short_right[first], zero], axis=1)
    there = symbols > 0
    there[:, -1] = True  # the end of each
    found = by_window(symbols[there], np.full(len(first), wide + 1), known)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    found, begin = np.concatenate(found), np.cumsum(sizes) - sizes
    # Windows beyond the reach are in no other row.
    out = np.repeat(least[live], windows)
    inner = np.cumsum(windows) - windows + (size_left - reach_left)[live]
    out[expand(inner, sizes[index])] = found[expand(begin[index], sizes[index])]
    return live, out, windows


def decide(parts: list[tuple[int, Runs]], rule, by_window) -> dict[int, list[int]]:
    """By chunk the ranges (start, end, start, ...) that go: windows that also are in a row of a smaller id."""
    if not parts:
        return {}
    one = lambda name: np.concatenate([getattr(runs, name) for _, runs in parts])
    owner, check, left, right, value, count, starts = map(one, ("owner", "check", "left", "right", "value", "count", "starts"))
    if not len(owner):
        return {}
    chunk = np.repeat([number for number, _ in parts], [len(runs.owner) for _, runs in parts])
    wide = rule.window - rule.gram
    _, at, index = np.unique(as_rows(owner, check, left, right), return_index=True, return_inverse=True)
    known = np.full(len(at), NO_ID, dtype=np.int64)
    np.minimum.at(known, index, value)
    head = (owner[at], check[at])  # rows of one owner and check are neighbours now
    new = np.append(True, (head[0][1:] != head[0][:-1]) | (head[1][1:] != head[1][:-1]))
    group = np.cumsum(new) - 1
    several = np.flatnonzero(np.bincount(group)[group] > 1)
    live, smallest, windows = smallest_of_windows(left[at[several]], right[at[several]], group[several], known[several], wide, by_window)
    place = np.full(len(at), -1)
    place[several[live]] = np.arange(len(live))
    first = np.cumsum(count) - count
    begin = np.cumsum(windows) - windows
    place = place[index]
    # Rows that are judged as a whole.
    whole = np.flatnonzero((place < 0) & (known[index] < value))
    units = (left[whole] > 0).sum(axis=1) + (right[whole] > 0).sum(axis=1) + rule.gram
    row, low, high = whole, np.zeros(len(whole), np.int64), units
    # The others by window: runs of windows that go.
    some = np.flatnonzero(place >= 0)
    size = windows[place[some]]
    gone = smallest[expand(begin[place[some]], size)] < np.repeat(value[some], size)
    within, of = expand(np.zeros(len(some), np.int64), size), np.repeat(some, size)
    edge = np.append(of[1:] != of[:-1], True)[: len(of)]
    opens = np.flatnonzero(gone & ~(np.append(False, (gone & ~edge)[:-1])[: len(gone)]))
    closes = np.flatnonzero(gone & (edge | ~np.append(gone[1:], False)[: len(gone)]))
    row = np.concatenate([row, of[opens]])
    if not len(row):
        return {}
    low, high = np.concatenate([low, within[opens]]), np.concatenate([high, within[closes] + rule.window])
    # One range for every place of a row.
    times = count[row]
    place = starts[expand(first[row], times)]
    pairs = np.stack([place + np.repeat(low, times), place + np.repeat(high, times)], axis=1)
    number = np.repeat(chunk[row], times)
    order = np.argsort(number, kind="stable")
    number, pairs = number[order], pairs[order]
    there, cuts = np.unique(number, return_index=True)
    return {n: some.ravel().tolist() for n, some in zip(there.tolist(), np.split(pairs, cuts[1:]), strict=True)}
