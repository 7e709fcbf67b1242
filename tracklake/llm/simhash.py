"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 21, 21 and 22 bits, each read as a word of the perfect [23, 12, 7] Golay code. Every word
decodes to one codeword. The *keys* of a word are the codewords that it and its 23 neighbours decode to, one or six; so of
two words that differ in at most one bit, the codeword of either is among the keys of the other.

Of three bits in error, some go to each segment. Either a segment is free of errors, and then one of the other two has at most one
(rule ij: segment i equal, segment j by its keys), or every segment has exactly one (rule 'all': all three by keys). One side of the
join is stored under few keys, the other looks up many, and a candidate counts only under the one rule that its own errors
select, so every pair comes out once. Each is verified by its number of differing bits.

Copies are one fingerprint before anything is joined. A fingerprint has at most 43,744 others within three bits, so links
grow with the number of fingerprints, whatever the groups of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import by_sorting, drop_named, extended, fresh, stored, text_key
from tracklake.llm.components import component_roots

GENERATOR = 0xAE3  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
SEGMENTS = ((0, 21), (21, 21), (42, 22))  # first bit, bits
LOOK_UPS = ((0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1))
ALL = 6


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word divided by the generator."""
    rest = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    return rest


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error pattern of at most three bits, and the patterns that lead to all keys (padded by the first)."""
    bits = 1 << np.arange(23)
    patterns = [np.array([0]), bits]
    patterns.append(np.array([a | b for k, a in enumerate(bits) for b in bits[k + 1 :]]))
    patterns.append(np.array([a | b for a in patterns[2] for b in bits if b > a]))
    every = np.concatenate(patterns)
    error = np.zeros(2048, np.int64)
    error[_syndrome(every)] = every
    single = _syndrome(bits)
    keys = np.zeros((2048, 6), np.int64)
    for s in range(2048):
        reach = list(dict.fromkeys([int(error[s]), *(int(bits[k] ^ error[s ^ single[k]]) for k in range(23))]))
        keys[s] = reach + reach[:1] * (6 - len(reach))
    return error, keys


ERROR, KEYS = _tables()


def codeword(words: np.ndarray) -> np.ndarray:
    """Index (12 information bits) of the codeword nearest to each word."""
    return (words ^ ERROR[_syndrome(words)]) >> 11


def codewords_near(words: np.ndarray) -> np.ndarray:
    """Indices of all keys of each word: six columns, repeated where a word has one key only."""
    return (words[:, None] ^ KEYS[_syndrome(words)]) >> 11


def segments(prints: np.ndarray) -> list[np.ndarray]:
    raw = prints.view(np.uint64)
    return [((raw >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]


def print_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, whether it looks up) of all keys: rule, exact segment and codeword indices in one long."""
    seg = segments(prints)
    one = [codeword(s) for s in seg]
    near = [codewords_near(s) for s in seg]
    rows = np.arange(len(prints))
    out = []
    for rule, (i, j) in enumerate(LOOK_UPS):
        head = (rule << 36) | (seg[i] << 12)
        out.append((rows, head | one[j], False))
        out += [(rows, head | near[j][:, k], True) for k in range(6)]
    head = ALL << 36
    for k in range(6):
        out.append((rows, head | (near[0][:, k] << 24) | (one[1] << 12) | one[2], True))
        out += [(rows, head | (one[0] << 24) | (near[1][:, k] << 12) | near[2][:, m], False) for m in range(6)]
    row = np.concatenate([o[0] for o in out])
    key = np.concatenate([o[1] for o in out])
    looks = np.concatenate([np.full(len(o[0]), o[2]) for o in out])
    # Words with a single key repeat it.
    _, first = np.unique((key * 2 + looks) ^ (row << 40), return_index=True)
    return row[first], key[first], looks[first]


def _segment_errors(a: Column, b: Column) -> list[Column]:
    x = a.bitwiseXOR(b)
    return [F.bit_count(F.shiftrightunsigned(x, at).bitwiseAND(F.lit((1 << n) - 1).cast("bigint"))) for at, n in SEGMENTS]


def _own_rule(a: Column, b: Column) -> Column:
    """The one rule under which a pair counts: the first whose exact segment is equal and whose other has one error at most."""
    e = _segment_errors(a, b)
    rule = F.lit(ALL)
    for k in range(len(LOOK_UPS) - 1, -1, -1):
        i, j = LOOK_UPS[k]
        rule = F.when((e[i] == 0) & (e[j] <= 1), k).otherwise(rule)
    return rule


def links_within(prints: DataFrame, column: str, bits: int = 3) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints (longs) that differ in at most ``bits`` (three at most) bits, each once."""
    numbered = prints.select(F.lit(0).alias("which"), F.col(column).alias("fp"))
    return numbered_links(numbered, bits).select("a", "b")


def numbered_links(prints: DataFrame, bits: int = 3) -> DataFrame:
    """As :func:`links_within` for rows (``which``, ``fp``): fingerprints are compared under the same number only."""
    if bits > 3:
        raise ValueError("the keys find pairs of at most three differing bits")
    distinct = prints.dropna().distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            fp = batch.column(1).to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 2048):
                some = fp[at : at + 2048]
                row, key, looks = print_keys(some)
                key = key | number[at : at + 2048][row] << 40
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(some[row]), pa.array(looks)], names=["key", "fp", "looks"]
                )

    keyed = distinct.mapInArrow(run, "key bigint, fp bigint, looks boolean")
    left = keyed.where("looks").select("key", F.col("fp").alias("a"))
    right = keyed.where("NOT looks").select("key", F.col("fp").alias("b"))
    a, b = F.col("a"), F.col("b")
    near = (a < b) & (F.bit_count(a.bitwiseXOR(b)) <= bits)
    rule = F.shiftright("key", 36).bitwiseAND(F.lit(7).cast("bigint")).cast("int") == _own_rule(a, b)
    found = left.join(by_sorting(right), "key").where(near & rule)  # some 40 keys per fingerprint
    return found.select(F.shiftright("key", 40).cast("int").alias("which"), "a", "b")


def majority(hashes: np.ndarray, k: int = 0) -> int:
    """Bits set in over half of the hashes, as a signed long; with ``k`` those of the hashes mixed anew."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        if k:
            with np.errstate(over="ignore"):
                part = part + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)
                part = (part ^ (part >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                part = (part ^ (part >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                part = part ^ (part >> np.uint64(31))
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, shingle: int, count: int = 1) -> list[int]:
    """``count`` fingerprints as signed longs, all zero without words.

    The first is the majority of the XXH64 (seed 42) bits of all word shingles; each further one is that of the same hashes
    mixed anew.
    """
    import xxhash

    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return [0] * count
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - np.fromiter((len(w) + 1 for w in words), np.int64, len(words))).tolist()
    size = min(shingle, len(words))
    ends = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], 42) for s, e in zip(starts, ends, strict=False)], dtype=np.uint64)
    return [majority(hashes, k) for k in range(count)]


def fingerprints(
    docs: DataFrame, text_col: str = "text", name: str = "prints", shingle: int = 3, count: int = 1
) -> DataFrame:
    """All columns but the text, and ``count`` fingerprints as an array of longs."""
    text = fresh([*docs.columns, name], "text_now")
    base = drop_named(docs.withColumn(text, F.col(f"`{text_col}`").cast("string")), (text_col, name))
    at = base.columns.index(text)
    schema = extended(base.drop(text).schema, f"`{name}` array<bigint>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle, count) for t in batch.column(at)]
            rest = [c for k, c in enumerate(batch.columns) if k != at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(prints, pa.list_(pa.int64()))], names=schema.names)

    return base.mapInArrow(run, schema)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 3
) -> DataFrame:
    """Per row of ``docs``: the id, ``fp`` (long), ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id reachable over links, the row's own included. NULL ids take part in links but
    are never the smallest; a component of NULL ids alone has NULL. Repeated rows stay repeated. Other columns are not read.
    """
    ids = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    prints = stored(fingerprints(ids, "text", "prints", shingle).select("id", F.col("prints")[0].alias("fp")), "fingerprints")
    each = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = component_roots(links_within(prints, "fp", bits), "a", "b")
    rooted = each.join(roots, F.col("fp") == F.col("node"), "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    out = by_sorting(prints).join(rooted.join(named, "root").select("fp", "component_id"), "fp")
    hexadecimal = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return out.select(F.col("id").alias(id_col), "fp", hexadecimal, "component_id")


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 3, prints: int = 4
) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest id (NULL ids last). Columns as in ``docs``.

    Two texts are linked if one of their ``prints`` fingerprints is equal or differs in at most ``bits`` bits; the first is that of
    :func:`near_duplicates`. A single one misses many texts that differ in a word or two, as those few shingles
    move about as many bits as are allowed; independent ones miss the same pair rarely. Texts without words are one group.
    """
    key = fresh(docs.columns, "key_now")
    named = F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("-")), F.lit(":"), text_key(text_col))
    keyed = docs.withColumn(key, named)
    ids = keyed.select(F.col(f"`{id_col}`").alias("id"), F.col(key).alias("key"), F.col(f"`{text_col}`").alias("text"))
    table = stored(fingerprints(ids, "text", "prints", shingle, prints), "fingerprints")
    each = table.select(F.col("prints")[0].alias("fp0"), F.posexplode("prints").alias("which", "fp")).distinct()
    links = stored(numbered_links(each.select("which", "fp"), bits), "print-links")
    # Every fingerprint value stands for the smallest first fingerprint it occurs with: one graph, without further nodes.
    stands = each.groupBy("which", "fp").agg(F.min("fp0").alias("rep"), F.count("*").alias("n"))
    of = stands.select("which", "fp", "rep")
    linked = links.join(of.withColumnsRenamed({"fp": "a", "rep": "x"}), ["which", "a"])
    linked = linked.join(of.withColumnsRenamed({"fp": "b", "rep": "y"}), ["which", "b"]).select("x", "y")
    shared = each.join(stands.where("n > 1"), ["which", "fp"]).select(F.col("fp0").alias("x"), F.col("rep").alias("y"))
    edges = linked.unionByName(shared).where("x <> y").distinct()
    roots = component_roots(edges, "x", "y")
    at = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    least = table.groupBy(F.col("prints")[0].alias("fp0")).agg(F.min(at).alias("least"))
    rooted = least.join(roots, F.col("fp0") == F.col("node"), "left")
    winners = rooted.groupBy(F.coalesce("root", "fp0").alias("root")).agg(F.min("least").alias("least"))
    kept = keyed.join(winners.select(F.col("least.key").alias(key)), key, "left_semi")
    repeated = not table.groupBy("key").count().where("count > 1").isEmpty()
    return (kept.dropDuplicates([key]) if repeated else kept).drop(key)
