from __future__ import annotations

import struct
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tracklake.llm import packing
from tracklake.llm.queries import QUERIES, tokenizer_files

from .helpers import no_documents, odd_documents


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, texts, tokenizer, length=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        pieces = sorted(by_doc[doc], key=lambda r: r["start"])
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert b"".join(bytes(p["ids"]) for p in pieces) == struct.pack(f"<{len(ids)}I", *ids)
        at = 0
        for p in pieces:
            assert (p["start"], p["doc_tokens"], len(p["ids"])) == (at, len(ids), 4 * p["length"])
            at += p["length"]
    sizes = []
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= length
        sizes.append(at)
    assert all(s & (s - 1) == 0 for s in sizes)  # no padding at all
    return sizes


def test_small_documents_round_trip(spark, tokenizer):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = packing.pack(docs, *tokenizer_files(), window_tokens=50_000).collect()
    sizes = check(rows, texts, tokenizer)
    assert sum(s == 1024 for s in sizes) > 0.8 * len(sizes)
    digest = QUERIES["op1_packing"](spark, SMALL)
    assert digest.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert digest.agg({"length": "sum"}).first()[0] == sum(r["length"] for r in rows)


def test_odd_texts_have_the_ids_of_the_tokenizer(tokenizer):
    parts = packing.PartIds(*tokenizer_files())
    odd = ["", " ", "  a  b", " x", "x ", "a\n b", "é ü  x", "it's 's x's", "a\tb  c\n\nd", "12 345abc", "日本 語 😀", "a\u00a0 b", "\x1c x", "x \x85y"]
    for text in odd:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert parts.ids(text) == struct.pack(f"<{len(ids)}I", *ids), repr(text)


def test_edge_rows(spark, tokenizer):
    rows = packing.pack(odd_documents(spark).coalesce(1), *tokenizer_files()).collect()
    total = sum(len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in odd_documents(spark).collect())
    assert sum(r["length"] for r in rows) == total
    assert packing.pack(no_documents(spark), *tokenizer_files()).count() == 0


def test_balanced_by_cost():
    rests = [(k, n) for k, n in enumerate([1000] * 4 + [500] * 8 + [24] * 90)]
    placed = packing.deal(rests, 1024, 1.0, 1 / 1024)
    full = [s for s in placed if sum(n for _, n in s) == 1024]
    cost = [sum(n + n * n / 1024 for _, n in s) for s in full]
    assert len(full) == sum(n for _, n in rests) // 1024
    assert max(cost) - min(cost) < 1024


def test_added_tokens_have_the_ids_of_the_tokenizer(tokenizer):
    parts = packing.PartIds(*tokenizer_files())
    end = "<|endoftext|>"
    for text in (f"a {end} b", end, f"{end}{end}", f"x{end}y", f"  {end}  z", f"a\n{end}\n", "<|endoftext|", f"it's{end}'s {end}"):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert parts.ids(text) == struct.pack(f"<{len(ids)}I", *ids), repr(text)


def test_cut_only_if_no_sequence_has_room():
    # Twenty sequences of three rests of 300 are cheaper than the two of 700, but only those have room for the last of 300.
    rests = [(k, n) for k, n in enumerate([700] * 2 + [300] * 62 + [24] * 105 + [8])]
    placed = packing.deal(rests, 1024, 1.0, 1 / 1024)
    pieces = [doc for s in placed for doc, _ in s if rests[doc][1] >= 300]
    assert len(pieces) == len(set(pieces)) == 64
    assert all(sum(n for _, n in s) == 1024 for s in placed)


def test_two_vocabularies_in_one_session(spark):
    """Workers are reused: a second vocabulary must not get the ids that the first has cached."""
    ranks, pattern, added = tokenizer_files()
    docs = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")

    def size(added):
        return packing.pack(docs, ranks, pattern, added).collect()[0]["doc_tokens"]

    assert [size(added), size({}), size({"a ": 7}), size(added)] == [5, 10, 10, 5]


def test_deal_is_a_plain_least_cost_loop():
    import random

    for seed in range(20):
        rng = random.Random(seed)
        rests = [(k, rng.randint(1, 63)) for k in range(rng.randint(1, 120))]
        placed = packing.deal(rests, 64, 1.0, 1 / 64)
        count = sum(n for _, n in rests) // 64
        room, cost, plain = [64] * count, [0.0] * count, [[] for _ in range(count)]
        queue = sorted(((-n, k, doc) for k, (doc, n) in enumerate(rests)))
        serial = len(rests)
        while queue and any(room):
            n, _, doc = queue.pop(0)
            fits = [j for j in range(count) if room[j] >= -n] or [j for j in range(count) if room[j]]
            j = min(fits, key=lambda j: (cost[j], j))
            take = min(-n, room[j])
            plain[j].append((doc, take))
            room[j] -= take
            cost[j] += take + take * take / 64
            if take < -n:
                queue = sorted([*queue, (take + n, serial, doc)])
                serial += 1
        assert placed[:count] == plain


def test_frequent_parts_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_PARTS", 3)
    parts, encoded = packing.PartIds(*tokenizer_files()), []
    whole = parts.whole
    monkeypatch.setattr(parts, "whole", lambda text: encoded.append(text) or whole(text))
    for k in range(20):
        assert parts.ids(f"x often rare{k}") == whole(f"x often rare{k}")
    assert encoded.count(" often") == 1 and len(parts) + len(parts.older) <= 6
