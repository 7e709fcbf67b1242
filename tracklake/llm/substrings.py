"""Substring deduplication by relative Lempel-Ziv factors.

The candidate texts that share an owner (see :mod:`tracklake.llm.repeats`) are the reference blocks. Every text that is not a copy is
factored against all of them: at each word the index of ``window``-word sequences names a place elsewhere, and the factor is
extended from there word by word as far as it agrees. Factors of at least ``window`` words are repeated spans. A greedy
factor may end where another source would go on, so the windows across every factor boundary are looked up as well.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tracklake.llm.repeats import Chunk, Rule, find_repeats


def factor(groups: list[list[tuple]], times: list[int], rule: Rule) -> list[np.ndarray]:
    """Whether each window of each text occurs at more than one place; a text that occurs twice is a repeat throughout."""
    window = rule.window
    texts = [text.split(b" ") for group in groups for _, _, text in group]
    index: dict[tuple, list] = {}  # window -> first place, and whether there are others
    shared: list[list[tuple]] = []
    for t, words in enumerate(texts):
        keys = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
        shared.append(keys)
        for i, key in enumerate(keys):
            place = index.get(key)
            if place is None:
                index[key] = [(t, i), None]
            elif place[1] is None:
                place[1] = (t, i)
    out = []
    for t, words in enumerate(texts):
        keys = shared[t]
        flags = np.zeros(len(keys), dtype=bool)
        if times[t] > 1:
            flags[:] = True
            out.append(flags)
            continue
        i = 0
        while i < len(keys):
            first, second = index[keys[i]]
            source = second if first == (t, i) else first
            if source is None:
                i += 1
                continue
            other, at = texts[source[0]], source[1]
            size = window
            while i + size < len(words) and at + size < len(other) and words[i + size] == other[at + size]:
                size += 1
            flags[i : i + size - window + 1] = True
            # Windows across the factor's end may have another source: go on at the first that this factor does not hold.
            i += size - window + 1
        out.append(flags)
    return out


WORD_RULE = Rule(words=True, window=35, gram=12, earlier_only=False, resolve=factor)


def _finish(chunk: Chunk, a: int, b: int, doc: object, gone: np.ndarray) -> tuple:
    words = chunk.words[a:b]
    if not gone.any():
        kept, spans = words, 0
    else:
        kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    return doc, b - a, int(gone.sum()), spans, b" ".join(kept).decode("utf-8")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = WORD_RULE) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``, ``n_spans`` and ``kept_text`` (kept words joined by one space).

    A word goes if a window of ``rule.window`` words that covers it also starts anywhere else, in the same document too. Windows are
    judged on the input. NULL and empty texts have no words; ids are whole numbers or NULL and play no part; repeated rows are
    repeats of each other; an empty table gives an empty result. Other columns are not read.
    """
    schema = "doc_id bigint, n_words bigint, n_removed bigint, n_spans bigint, kept_text string"
    return find_repeats(docs, rule, id_col, text_col, schema, _finish)
