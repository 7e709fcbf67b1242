"""Suffix-array deduplication: suffixes are grouped by Lyndon prefix, then emitted in order.

:func:`suffix_array` works in two passes without recursion or renaming. First, groups of suffixes (at the start: by first
symbol) are taken from the largest to the smallest. Every suffix of a group points to the previous suffix in a smaller group;
those it points to have a longer common prefix than the rest of their own group and move to a new group right behind it, the
further the more often they are pointed to. In the end a group holds the suffixes with one Lyndon prefix. Second, suffixes
are emitted from the smallest on: each lets the suffix before it, and those that this one points back to in turn, take the next
place in their groups.

Equal byte strings stand side by side in that order, so one pass over neighbours finds, for each, the smallest document it is in.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tracklake.llm.repeats import NO_ID, Chunk, Rule, byte_grams, find_repeats


def suffix_array(symbols: bytes | list[int]) -> list[int]:
    """Starts of all suffixes in ascending order; a suffix that is a prefix of another comes first."""
    n = len(symbols)
    if not n:
        return []
    # Groups as ranges of ``order``; a group is named by its first place.
    order = np.argsort(np.frombuffer(bytes(symbols), np.uint8) if isinstance(symbols, bytes) else np.array(symbols), kind="stable")
    order = order.tolist()
    place = [0] * n
    group = [0] * n
    size = [0] * n
    first = 0
    for k, i in enumerate(order):
        if symbols[i] != symbols[order[first]]:
            size[first] = k - first
            first = k
        place[i] = k
        group[i] = first
    size[first] = n - first
    before = [-1] * n
    end = n
    while end > 0:  # groups from the largest on
        g = group[order[end - 1]]
        members = order[g:end]
        end = g
        if len(members) > 1:
            members.sort()
        pointed: dict[int, int] = {}
        for i in members:
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = before[p]
            before[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if not pointed:
            continue
        if len(pointed) == 1:
            ((p, _),) = pointed.items()
            h = group[p]
            m = size[h]
            if m > 1:  # one suffix moves behind its group
                at, last = place[p], h + m - 1
                other = order[last]
                order[at], order[last] = other, p
                place[other], place[p] = at, last
                size[h] = m - 1
                group[p] = last
                size[last] = 1
            continue
        by_group: dict[int, list[int]] = {}
        for p in pointed:
            by_group.setdefault(group[p], []).append(p)
        for h, some in by_group.items():
            m = size[h]
            if len(some) > 1:
                counts = {pointed[p] for p in some}
                if len(counts) > 1:
                    some.sort(key=pointed.__getitem__, reverse=True)
                elif len(some) == m:
                    continue  # the whole group alike
            elif m == 1:
                continue
            last = h + m
            k = 0
            while k < len(some):  # the most often pointed to go last
                count = pointed[some[k]]
                stop = last
                while k < len(some) and pointed[some[k]] == count:
                    p = some[k]
                    last -= 1
                    at, other = place[p], order[last]
                    order[at], order[last] = other, p
                    place[other], place[p] = at, last
                    k += 1
                for q in range(last, stop):
                    group[order[q]] = last
                size[last] = stop - last
            if last > h:
                size[h] = last - h
    out = [0] * n
    nxt = list(range(n))  # the next free place of the group named by this one
    placed = bytearray(n)
    j = n - 1
    for k in range(-1, n - 1):
        if k >= 0:
            j = out[k] - 1
        while j >= 0 and not placed[j]:
            placed[j] = 1
            g = group[j]
            out[nxt[g]] = j
            nxt[g] += 1
            j = before[j]
    return out


def rebuilt(groups: list[list[tuple]], rule: Rule) -> list[np.ndarray]:
    """The texts of owners that have a text with the gram several times (kind 0) as symbols, each ended by a zero.

    Texts that hold the gram once come without it (kind 2: a check, the gram's place, what stands before and behind); it is put back.
    """
    parts: list[np.ndarray] = []
    byte = lambda raw: np.frombuffer(raw, np.uint8).astype(np.int64) + 1
    end = np.zeros(1, np.int64)
    for group in groups:
        whole = next(t for kind, _, t in group if kind == 0)
        raw = np.frombuffer(whole[2:], np.uint8)
        at = int(np.flatnonzero(byte_grams(raw, rule.gram) == np.uint64(group[0][1]))[0])
        mark = byte(whole[2 + at : 2 + at + rule.gram])
        for kind, _, text in group:
            if kind == 0:
                parts += (byte(text[2:]), end)
            else:
                cut = 3 + text[2]
                parts += (byte(text[3:cut]), mark, byte(text[cut:]), end)
    return parts


def smallest_by_window(symbols: np.ndarray, width: np.ndarray, least: np.ndarray) -> list[np.ndarray]:
    """For every window (of ``width`` symbols) of every text, the smallest id of the texts it occurs in; a zero ends each text."""
    begin = np.concatenate([[0], np.flatnonzero(symbols == 0) + 1])
    sizes = np.diff(begin)
    text = np.repeat(np.arange(len(sizes)), sizes)
    order = np.array(suffix_array(symbols.tolist()), dtype=np.int64)
    windows = sizes - width  # one symbol of each text is its end
    order = order[order - begin[text[order]] < windows[text[order]]]  # suffixes that start with a window
    by_place = np.full(len(symbols), NO_ID, dtype=np.int64)
    for size in np.unique(width):
        some = order[width[text[order]] == size]
        seen = np.lib.stride_tricks.sliding_window_view(symbols, size)
        new = np.ones(len(some), dtype=bool)
        for at in range(1, len(some), 16384):
            stop = min(len(some), at + 16384)
            new[at:stop] = (seen[some[at:stop]] != seen[some[at - 1 : stop - 1]]).any(axis=1)
        start = np.flatnonzero(new)
        smallest = np.minimum.reduceat(least[text[some]], start)
        by_place[some] = np.repeat(smallest, np.diff(np.append(start, len(some))))
    return [by_place[a : a + n] for a, n in zip(begin[:-1].tolist(), windows.tolist(), strict=True)]


def smallest_ids(groups: list[list[tuple]], least: list[int], rule: Rule) -> list[np.ndarray]:
    """For every window of every text, the smallest id of the texts it occurs in."""
    symbols = np.concatenate(rebuilt(groups, rule))
    return smallest_by_window(symbols, np.full(len(least), rule.window), np.array(least, dtype=np.int64))


BYTE_RULE = Rule(words=False, window=50, gram=24, earlier_only=True, resolve=smallest_ids, by_window=smallest_by_window)


def _finish(chunk: Chunk, a: int, b: int, doc: object, gone: np.ndarray) -> tuple:
    spans = int(gone[:1].sum()) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    raw = chunk.data[a:b] if not spans else chunk.raw[a:b][~gone].tobytes()
    return doc, b - a, int(gone.sum()), spans, raw


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = BYTE_RULE) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (bytes).

    A byte goes if a string of ``rule.window`` bytes that covers it also starts in a document with a smaller id. Strings are judged on
    the input and never cross documents. NULL and empty texts have no bytes. A NULL id is larger than all others; rows of
    equal (or NULL) ids do not remove each other's bytes. An empty table gives an empty result. Other columns are not read.
    """
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    return find_repeats(docs, rule, id_col, text_col, schema, _finish)
