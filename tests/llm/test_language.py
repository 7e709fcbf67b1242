from __future__ import annotations

import unicodedata
import zlib

import numpy as np
import pytest

from tests.conftest import SMALL
from tracklake.llm import language
from tracklake.llm.common import read
from tracklake.llm.queries import QUERIES

from .helpers import no_documents, odd_documents, sorted_rows


def grams(text, longest):
    """Distinct n-grams as strings, by plain loops."""
    clean = "".join(
        (c.lower() if len(c.lower()) == 1 else c) if unicodedata.category(c)[0] in "LM" else " " for c in text or ""
    ).split()
    padded = f" {' '.join(clean)} " if clean else ""
    found = {padded[i : i + n] for n in range(1, longest + 1) for i in range(len(padded) - n + 1)}
    return found - {" "}


def named(codes):
    out = set()
    for code in codes.tolist():
        units = [code >> 16 * k & 0xFFFF for k in (3, 2, 1, 0)]
        out.add("".join(map(chr, [u for u in units if u])))
    return out


TEXTS = ["Hello, WORLD", "", "  \n", "a", "ÀÉî straße İx", "日本語 テスト", "नमस्ते दुनिया", "123 456", "x y—z", "aa aa aa"]


def test_grams_are_those_of_plain_loops():
    for text in TEXTS:
        for longest in (1, 2, 3, 4):
            assert named(language.grams_of(text, longest)) == grams(text, longest)
    assert len(language.grams_of(None, 3)) == 0
    # Letters beyond the first plane are two units, other signs there are spaces.
    assert np.array_equal(language.grams_of("a\U0001f600b", 3), language.grams_of("a b", 3))
    assert len(language.grams_of("\U00020000", 3)) > 0


def test_long_texts_are_cut_without_loss(monkeypatch):
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(700))
    whole = language.grams_of(text, 4)
    monkeypatch.setattr(language, "SLICE", 50)
    assert np.array_equal(language.grams_of(text, 4), whole)


def test_kernel_and_regression_match_plain_formulas():
    texts = ["the cat and the hat", "der hund und die katze", "le chat et le chien", "the dog", "die maus", "un chien", "qqq"]
    sets = [grams(t, 3) for t in texts]
    codes = [language.grams_of(t, 3) for t in texts]
    marks = language.Landmarks.of(codes[:4], 3)
    values = marks.kernel(codes, marks.matrix())
    plain = [[len(a & b) / (len(a) * len(b)) ** 0.5 for b in sets[:4]] for a in sets]
    assert np.allclose(values, plain)
    assert np.allclose(np.vstack([marks.kernel([c], marks.matrix()) for c in codes]), values)
    # With every text a landmark, the Nyström features give plain kernel ridge regression (centred).
    k = np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in sets] for a in sets])
    y = np.where(np.arange(7)[:, None] % 3 == np.arange(3)[None, :], 1.0, -1.0)
    weights = language.ridge(k, k, y, 0.3)
    centre = np.eye(7) - 1 / 7
    dual = np.linalg.solve(centre @ k @ centre + 0.3 * np.eye(7), centre @ y)
    expected = centre @ k @ centre @ dual + y.mean(0)
    assert np.allclose(k @ weights[:-1] + weights[-1], expected)


def test_held_out_accuracy(spark):
    found = QUERIES["op13_language"](spark, SMALL).collect()
    docs = {r["doc_id"]: r for r in read(spark, SMALL, "documents").collect()}
    assert len(found) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    judged = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in found if r["held_out"]]
    assert len(judged) > 40 and sum(judged) / len(judged) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_held_out_labels_do_not_matter(spark):
    docs = read(spark, SMALL, "documents")
    out = language.held_out("doc_id")
    first = language.fit_language(docs.where(~out))
    second = language.fit_language(docs.where(~out).repartition(5))
    assert first.languages == second.languages and np.allclose(first.weights, second.weights, atol=1e-6)


def test_odd_rows(spark):
    docs = odd_documents(spark).selectExpr("*", "'c' AS lang_pred", "1 AS place")
    more = [(100 + i, f"{t} {i}", lang) for i in range(12) for t, lang in (("der hund und die katze", "de"), ("the cat and the hat", "en"))]
    train = spark.createDataFrame([*more, (None, "il gatto", "it"), (7, None, "it"), (8, "123", "it"), (9, "x", None)], "doc_id long, text string, lang string")
    model = language.fit_language(train, landmarks=5)
    assert model.languages == ("de", "en")
    found = language.predict_language(docs, model)
    assert len(found.columns) == len(docs.columns) + 0 and found.count() == docs.count()
    for r in found.collect():
        assert (r["lang_pred"] == "und") == (not language.has_letter(r["text"]))
        assert 0 <= r["score"] <= 1
    again = language.predict_language(train.select("text"), model).collect()
    assert {r["lang_pred"] for r in again if r["text"] and "hund" in r["text"]} == {"de"}
    assert {r["lang_pred"] for r in again if r["text"] and "hat" in r["text"]} == {"en"}


def test_empty_tables(spark):
    model = language.fit_language(no_documents(spark))
    assert model.languages == ()
    assert {r["lang_pred"] for r in language.predict_language(odd_documents(spark), model).collect()} == {"und"}
    assert language.predict_language(no_documents(spark), model).collect() == []
    with pytest.raises(ValueError):
        language.fit_language(no_documents(spark), longest=5)


def test_one_language_and_copies(spark):
    rows = [(1, "the same text", "en")] * 50
    model = language.fit_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ("en",)
    assert sorted_rows(language.predict_language(spark.createDataFrame([("abc",)], "text string"), model), "lang_pred") == [("en",)]
