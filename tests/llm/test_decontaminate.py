from __future__ import annotations

import re

import pytest

from tracklake.llm import decontaminate

from .helpers import no_documents, odd_documents, sorted_rows

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, window=13):
    grams = {}
    for item, text in items:
        w = split(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if w else ():
            grams.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[tuple(w[i : i + n])]
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def fixture():
    filler = [f"f{i}" for i in range(400)]
    item = [f"Q{i}" for i in range(30)]
    docs = [
        (1, " ".join(filler[:50] + item[3:16] + filler[50:90])),
        (2, " ".join(filler[:50] + item[3:15] + filler[50:90])),  # twelve words only
        (3, "SHORT,item!"),
        (4, "x short  item y short item"),
        (5, " ".join(filler + item)),
        (6, "one É short ITEM"),
        (7, " ".join(item[:20] + item[10:30])),
        (8, None),
        (9, ""),
        (None, " ".join(item)),
        (1, "short item"),
    ]
    items = [(10, " ".join(item)), (2, "Short item"), (3, ""), (None, "É"), (4, None), (2, "Short item"), (11, " ".join(item[:14]))]
    return docs, items


@pytest.mark.parametrize("set_limit", [50_000, 0])
def test_matches_brute_force_by_hash_set_and_by_join(spark, set_limit):
    docs, items = fixture()
    found = decontaminate.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
        set_limit=set_limit, broadcast_limit=set_limit,
    )
    assert sorted_rows(found, "doc_id", "n_words", "n_hit", "items", "contaminated") == brute(docs, items)


def test_removed_spans(spark):
    docs = spark.createDataFrame([(1, "<< Keep this, a b C! and d.")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.remove_spans(decontaminate.decontaminate(docs, items)).first()["text"] == "<< Keep this, and d."


def test_edge_rows_empty_tables_and_clashing_columns(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    found = decontaminate.decontaminate(odd_documents(spark), items)
    assert found.count() == 10 and found.where("contaminated").count() == 3
    assert found.where("text IS NULL AND n_words = 0 AND NOT contaminated").count() == 2
    assert decontaminate.decontaminate(odd_documents(spark), items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decontaminate(no_documents(spark), items).count() == 0


def test_main_path_is_native(spark):
    docs, items = fixture()
    found = decontaminate.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
