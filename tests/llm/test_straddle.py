"""Runs as columns: what goes is what brute force over the texts says."""

from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tracklake.llm.repeats import _from_planes, _planes
from tracklake.llm.straddle import Runs, decide, longest_shared, side
from tracklake.llm.suffixes import BYTE_RULE, smallest_by_window

WIDE = BYTE_RULE.window - BYTE_RULE.gram
GRAM = bytes(range(200, 200 + BYTE_RULE.gram))
text = st.text("ab\0", max_size=WIDE).map(str.encode)
run = st.tuples(st.integers(0, 1), text, text, st.integers(0, 4), st.integers(0, 2), st.integers(0, 900))


def columns(rows):
    """Rows (owner, before, behind, id, start) as columns."""
    owner, before, behind, ids, starts = zip(*rows, strict=True)

    def of(texts, sign):
        raw = np.frombuffer(b"".join(texts) + b"\0", np.uint8)
        size = np.array([len(t) for t in texts])
        at = np.cumsum(size) - size
        return side(raw, at if sign > 0 else at + size - 1, sign, size, WIDE)

    check = np.zeros(len(rows), "<u2")
    return Runs(np.array(owner, np.uint64), check, of(before, -1), of(behind, 1), np.array(ids), np.ones(len(rows), np.int64), np.array(starts))


@settings(max_examples=200, deadline=None)
@given(st.lists(run, max_size=12))
def test_decide_matches_brute_force(found):
    found = [r for r in found if len(r[1]) + len(r[2]) >= WIDE]
    windows = lambda before, behind: [(before + GRAM + behind)[i : i + 50] for i in range(len(before) + len(behind) - WIDE + 1)]
    least: dict = {}
    for owner, before, behind, doc, _, _ in found:
        for w in windows(before, behind):
            least[owner, w] = min(least.get((owner, w), doc), doc)
    want: dict = {}
    for owner, before, behind, doc, chunk, start in found:
        for i, w in enumerate(windows(before, behind)):
            if least[owner, w] < doc:
                want.setdefault(chunk, set()).update(range(start + i, start + i + 50))
    parts = [(c, columns([(r[0], r[1], r[2], r[3], r[5]) for r in found if r[4] == c])) for c in sorted({r[4] for r in found})]
    got = {}
    for chunk, flat in decide(parts, BYTE_RULE, smallest_by_window).items():
        got[chunk] = {k for a, b in zip(flat[::2], flat[1::2], strict=True) for k in range(a, b)}
    assert got == want


@settings(max_examples=100, deadline=None)
@given(st.lists(run, min_size=1, max_size=8))
def test_packed_columns_come_back(found):
    runs = columns([(r[0], r[1], r[2], r[3], r[5]) for r in found])
    back = Runs.unpack(runs.pack(0, len(found), runs.starts, _planes), WIDE, _from_planes)
    for name in ("owner", "check", "left", "right", "value", "count", "starts"):
        assert np.array_equal(getattr(back, name), getattr(runs, name)), name
    for k, r in enumerate(found):
        assert back.text(k) == b"\0\0" + bytes((len(r[1]),)) + r[1] + r[2]
    rest = back.without([0])
    assert len(rest.owner) == len(rest.starts) == len(found) - 1


def test_longest_shared():
    rows = np.array([[1, 2, 3, 0], [1, 2, 0, 0], [1, 2, 3, 4], [1, 2, 3, 4], [9, 9, 9, 9], [9, 0, 0, 0]], np.uint8)
    assert longest_shared(rows, np.array([0, 0, 0, 1, 1, 2])).tolist() == [3, 2, 3, 0, 0, 0]
    assert longest_shared(np.zeros((0, 4), np.uint8), np.zeros(0, np.int64)).tolist() == []
