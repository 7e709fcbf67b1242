from __future__ import annotations

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tracklake.llm import urlfilter
from tracklake.llm.queries import SITE_RULES

from .helpers import sorted_rows


def as_regex(glob):
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            out, i = out + "[^\x00]*", i + 2
        elif glob[i] == "*":
            out, i = out + "[^/?]*", i + 1
        else:
            out, i = out + re.escape(glob[i]), i + 1
    return re.compile(out)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.text("ab/?*", max_size=9), min_size=1, max_size=30), st.lists(st.text("abc/?é", max_size=12), min_size=1, max_size=10)
)
def test_automaton_matches_regular_expressions(globs, urls):
    hits = urlfilter.Automaton(globs).match(urls)
    want = np.array([[bool(as_regex(g).fullmatch(u)) for g in globs] for u in urls])
    assert (hits == want).all()


URLS = {
    "https://Sub.Example.ORG/es/1?q#f": ("sub.example.org", "/es/1", "example.org/es/", "block"),
    "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
    "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
    "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
    "http://a.com/de/casino": ("a.com", "/de/casino", "com/de/", "block"),
    "http://casino.com/fr/": ("casino.com", "/fr/", "com/fr/", "allow"),
    "http://x.org": ("x.org", "", None, "allow"),
    "http://evil.net/a.example.org/es/1": ("evil.net", "/a.example.org/es/1", None, "allow"),
    "http://my-casino-x.net/p": ("my-casino-x.net", "/p", None, "block"),
    "http://casino.net?x": ("casino.net", "", None, "block"),
    "http://fine.net/casino?casino": ("fine.net", "/casino", None, "allow"),
    "no scheme": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "x://" + "a" * 5000 + "/": ("a" * 5000, "/", None, "allow"),
}


def test_rules_and_edge_rows(spark):
    rows = [(k, u, "old") for k, u in enumerate(URLS)] * 2 + [(None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string")
    got = urlfilter.filter_urls(df, SITE_RULES + urlfilter.DEFAULT_RULES)
    seen = {r["url"]: (r["host"], r["path"], r["rule"] if r["tier"] == 0 else None, r["verdict"]) for r in got.collect()}
    assert seen == URLS and got.count() == len(rows)
    assert urlfilter.filter_urls(df.limit(0), SITE_RULES).count() == 0


def test_canonical_form(spark):
    df = spark.createDataFrame([("HTTP://A.B/P?utm_source=x&b=1&ref=y#z",), ("x://h/p?fbclid=1",)], "url string")
    assert sorted_rows(urlfilter.filter_urls(df, SITE_RULES), "canonical_url") == [("a.b/P?b=1",), ("h/p",)]
