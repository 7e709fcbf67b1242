from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tests.conftest import SMALL
from tracklake.llm import spelling
from tracklake.llm.common import read
from tracklake.llm.queries import QUERIES

from .helpers import no_documents, odd_documents, sorted_rows

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_counts(rows, slip, least=7, occurrences=2):
    total = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += len(run) >= least
    return {w: n for w, n in total.items() if n >= occurrences}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, times=10):
    """Every word against every other."""
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    best = {w: min(vs, key=lambda v: (-counts[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if counts[v] >= times * counts[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()), key=repr)


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in read(spark, SMALL, "documents").select("doc_id", "text").collect()]
    counts = brute_counts(rows, 31)
    some = {w for w in counts if len(w) < 9}
    found = sorted_rows(QUERIES["op12_spelling"](spark, SMALL))
    assert {r[0]: r[3] for r in found} == counts
    expected = {r[0]: r for r in brute({w: counts[w] for w in some})}
    for row in found:  # shorter words cannot see all their longer neighbours here, so compare those of up to 7
        if len(row[0]) <= 7:
            assert row == expected[row[0]] or row[2] not in some


def test_words_around_ranges_and_alphabets(spark):
    rng = random.Random(3)
    words = {"", "a", "aa", "aaa", "ab", "ba", "é", "日本", "日", "\U0001f600x", "x"}
    while len(words) < 700:
        words.add("".join(rng.choices("abc", k=rng.randint(3, 7))))
    words |= {w + "tail" for w in list(words)[:100]} | {"same" * 30 + c for c in "abcdefgh"}
    counts = {w: 10 ** rng.randint(0, 6) * rng.randint(1, 3) for w in words}
    frame = spark.createDataFrame([(w, n, "x") for w, n in counts.items()] + [(None, 5, "x")], "word string, n long, form string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        for coalesce in ("true", "false"):  # one range, and several with shared prefixes over their ends
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
            assert sorted_rows(spelling.group_variants(frame)) == brute(counts)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_nodes_are_prefixes(spark):
    words = [f"{a}{b}{c}" for a in "xy" for b in "mnop" for c in ("", "q", "qr", "z")]
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paths = spelling.trie_paths(frame, "word")
        rows = paths.collect()
        stands = spelling.boundary_nodes(paths, "word")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r["range"] for r in rows}) > 1 and stands
    names = {}
    for r in rows:
        for depth, node in enumerate(r["path"]):
            assert names.setdefault(stands.get(node, node), r["word"][:depth]) == r["word"][:depth]
    assert len(set(names.values())) == len(names)
    assert [r["word"] for r in sorted(rows, key=lambda r: r["path"][-1])] == sorted(words)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    text = "Wordlist wordlist wordlisÀ ×÷ÀÁÂÃÄ ×÷ÀÁÂÃÄ 日本wordlist\U0001f600wordlist"
    docs = docs.unionByName(docs.limit(1).selectExpr("doc_id + 90 AS doc_id", f"'{text}' AS text", *docs.columns[2:]))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    for slip in (0, 1, 3):
        expected = brute_counts(rows, slip)
        assert {r["word"]: r["n"] for r in spelling.word_counts(docs, slip=slip).collect()} == expected
        assert sorted_rows(spelling.group_variants(spelling.word_counts(docs, slip=slip))) == brute(expected)


def test_empty_and_wrong(spark):
    empty = spelling.group_variants(spelling.word_counts(no_documents(spark)))
    assert empty.collect() == [] and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    with pytest.raises(ValueError):
        spelling.group_variants(spelling.word_counts(no_documents(spark)), times=1)
