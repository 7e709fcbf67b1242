from __future__ import annotations

import re

from tests.conftest import SMALL
from tracklake.llm import privacy

from .helpers import no_documents, odd_documents

KEY = b"test"


def replaced(text):
    return privacy.replace_in(text, lambda kind, value: privacy.surrogate(KEY, kind, value, 0))[0]


def test_every_kind_keeps_its_format():
    cases = {
        "ana.b-7@mail.example.com": r"[a-z]{3}\.[a-z]-\d@[a-z]+\.example\.com",
        "+1 (017) 555-7713": r"\+1 \(\d{3}\) \d{3}-\d{4}",
        "+49 30 901820": r"\+49 \d{2} \d{6}",
        "4111 1111 1111 1111": r"4\d{3} \d{4} \d{4} \d{4}",
        "4845168114407329": r"4\d{15}",
        "97.51.17.173": r"\d+\.\d+\.\d+\.\d+",
        "192.168.1.7": r"192\.168\.\d+\.\d+",
        "2001:db8:85a3:0:0:8a2e:370:7334": r"[0-9a-f:]+",
        "00:1A:2b:3c:4d:5e": r"(?:[0-9a-fA-F]{2}:){5}[0-9a-fA-F]{2}",
        "123-45-6789": r"\d{3}-\d{2}-\d{4}",
        "GB82 WEST 1234 5698 7654 32": r"GB\d{2} [A-Z]{4} \d{4} \d{4} \d{4} \d{2}",
        "04dbebab91ab85687d33eeaaf9ac699e1188f962": r"[0-9a-f]{40}",
    }
    for old, shape in cases.items():
        new = replaced(f"see {old} there")
        assert re.fullmatch(f"see {shape} there", new) and old not in new, (old, new)
    card = re.sub(r"\D", "", replaced("4111 1111 1111 1111"))
    assert privacy.luhn(card) == 0
    iban = replaced("GB82 WEST 1234 5698 7654 32").replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert replaced('password: "hunter22x!"') != 'password: "hunter22x!"'


def test_names_keep_gender_script_case_and_reference():
    new = replaced("Mr John Smith met Frau Müller and г-жа Анна Петрова. MR SMITH, Mr Smith and John Smith left.")
    m = re.fullmatch(r"Mr (\S+) (\S+) met Frau (\S+) and г-жа (\S+) (\S+)\. MR SMITH, Mr (\S+) and (\S+) (\S+) left\.", new)
    first, last, mueller, anna, petrova, again, first2, last2 = m.groups()
    assert first in privacy.NAMES["latin", "m"] and anna in privacy.NAMES["cyrillic", "f"]
    assert last in privacy.NAMES["latin", "last"] and petrova in privacy.NAMES["cyrillic", "last"]
    assert (again, first2, last2) == (last, first, last) and mueller != "Müller"


def test_plain_text_is_left_alone():
    for text in ("On 2024-01-02 at 12:30 version 1.2.3 cost 3.14159 or 12,500.", "The Mr is. Don't. page 12-13", "a = b: c"):
        assert replaced(text) == text


def test_surrogates_stay_distinct_and_never_occur(spark):
    people = [(k, f"Mr {a}{b} spoke, 10.0.0.{k % 250} too") for k, (a, b) in enumerate((a, b) for a in "ABCDEFGH" for b in "aeiouy" * 2)]
    taken = privacy.surrogate(KEY, "card", "4111111111111111", 0)
    people += [(900, "4111111111111111"), (901, taken)]
    docs = spark.createDataFrame(people, "doc_id long, text string")
    few = {r["doc_id"]: r["text"] for r in privacy.pseudonymise(docs, KEY).collect()}
    joined = {r["doc_id"]: r["text"] for r in privacy.pseudonymise(docs, KEY, exception_limit=0).collect()}
    assert few == joined
    old = [{(k, v) for _, t in people for _, _, k, v in privacy.find_entities(t)}][0]
    new = {(k, v) for t in few.values() for _, _, k, v in privacy.find_entities(t)}
    assert len(old) == len(new) and not old & new


def test_edge_rows(spark):
    got = privacy.pseudonymise(odd_documents(spark), KEY)
    assert got.count() == 10 and got.where("text IS NULL AND n_entities = 0").count() == 2
    assert privacy.pseudonymise(no_documents(spark), KEY).count() == 0


def test_small_documents_hold_none_of_what_was_found(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    old = {v for t in before.values() for _, _, _, v in privacy.find_entities(t)}
    assert old
    for r in privacy.pseudonymise(docs, KEY).collect():
        assert not old & {v for _, _, _, v in privacy.find_entities(r["text"])}
        if not r["n_entities"]:
            assert r["text"] == before[r["doc_id"]]


def test_what_is_checked_is_what_is_written():
    mentions = ["+1 (017) 555-7713", "+1 830 555 1234", "+49 30 901820", "+49 (30) 901820", "+358 40 123 4567", "(017) 555-7713", "017-555-7713",
                "fe80::1", "FE80::1FF:FE23:4567:890A", "2001:db8::1", "::1", "::ffff:10.1.2.3", "fd12:3456::7", "2001:0db8:85a3:0000:0000:8a2e:0370:7334"]
    for mention in mentions:
        (_, _, kind, value), = privacy.find_entities(f"see {mention} there")
        for attempt in range(20):
            new = privacy.surrogate(KEY, kind, value, attempt)
            written = privacy.dress(kind, mention, new)
            assert privacy.find_entities(f"see {written} there") == [(4, 4 + len(written), kind, new)], (mention, written)
            if mention.startswith("+"):
                assert written.startswith(mention.split()[0])


def test_short_forms_of_ipv6_are_one_entity():
    for short, full in (("fe80::1", "fe80:0:0:0:0:0:0:1"), ("2001:DB8::1", "2001:db8:0:0:0:0:0:1"), ("::1", "0:0:0:0:0:0:0:1")):
        values = [privacy.find_entities(f"from {x}: up, ip:{x}.")[k][2:] for x in (short, full) for k in (0, 1)]
        assert len(set(values)) == 1 and values[0][0] == "ipv6", short
    for text in ("std::vector", "a :: b", "at 12:30:45 or 12:30:45:10", "f(x)::y", "1:2:3:4:5:6:7:8:9", "::"):
        assert not [e for e in privacy.find_entities(text) if e[2] == "ipv6"], text


def test_phones_of_one_country_stay_distinct(spark):
    """Few digits are left beside the country code, so that many draws meet."""
    import pytest

    rows = [(k, f"call +49 30 {k:02d}") for k in range(60)] + [(k, f"call +358 {k:03d} 12") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = [r["text"] for r in privacy.pseudonymise(docs, KEY).collect()]
    assert len(set(texts)) == len(rows) and not set(texts) & {t for _, t in rows}
    crowded = spark.createDataFrame([(k, f"call +358 {k:02d} 1{k % 10}") for k in range(100)], "doc_id long, text string")
    with pytest.raises(RuntimeError, match="phone"):
        privacy.assign_exceptions(crowded, "text", KEY, rounds=1).count()


def test_a_private_range_that_is_used_up_gives_way():
    taken = {privacy.surrogate(KEY, "ipv4", "192.168.1.7", attempt).split(".")[0] for attempt in range(24)}
    assert taken == {"192", "172", "10"}
    assert privacy.surrogate(KEY, "secret", "********", privacy.WIDER) != "********"
