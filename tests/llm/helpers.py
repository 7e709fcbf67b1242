"""Small tables with the awkward rows every operator must bear."""

from __future__ import annotations

CLASHING = "n_words long, fp string, score string, predicted string, rule string, host string, key string, label string"


def odd_documents(spark):
    """NULLs in every column, an empty and a very long text, ties, repeated rows, and extra columns of clashing names."""
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000))
    rows = [
        (1, "alpha beta gamma delta", "en", "s", 22),
        (1, "alpha beta gamma delta", "en", "s", 22),
        (2, "alpha beta gamma delta", None, None, None),
        (3, None, "en", "s", 0),
        (4, "", "en", "s", 0),
        (None, "no id here at all", "en", "s", 17),
        (None, None, None, None, None),
        (5, long, "en", "s", len(long)),
        (6, "  white \t space\n\nonly here  ", "en", "s", 28),
        (7, "ünï cödé 日本 \u00a0 x", "en", "s", 16),
    ]
    extra = (9, "x", "y", "z", "r", "h", "k", "l")
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
    return spark.createDataFrame([r + extra for r in rows], schema)


def no_documents(spark):
    return odd_documents(spark).limit(0)


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
