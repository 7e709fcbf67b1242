"""URL filter: every glob rule simulated at once by a bit-parallel Shift-And automaton.

All rules are laid side by side in 64-bit words, one bit per pattern character. A step over one URL character shifts
all states of all rules together, masks them by the character, and keeps the states that stand in a wildcard.
The batch is the second dimension: numpy steps all URLs of an Arrow batch at once, longest first, so a long URL costs
only its own steps. Nothing is shuffled.

Glob syntax: ``*`` any run without ``/`` and ``?``; ``**`` any run; everything else itself (``?`` starts a query).
A rule must match the whole canonical URL.

Canonical URL: host (A-Z lower-cased) + path + query without tracking parameters. Scheme, fragment, and an empty query
go. A NULL url or one without ``://`` has the empty canonical URL.

Which rule wins: the smallest ``tier`` first, then the longest rule text, then the earlier rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import drop_named, extended, fresh

TRACKING = "utm_[^&]*|ref=[^&]*|fbclid=[^&]*|gclid=[^&]*"


@dataclass(frozen=True)
class UrlRule:
    """``name`` is reported; ``globs`` all belong to the rule; ``tier`` 0 beats 1."""

    name: str
    action: str
    globs: tuple[str, ...]
    tier: int = 0


def site_rule(action: str, host: str, path: str) -> UrlRule:
    """A rule for a host, all its subdomains, and every path that starts with ``path``."""
    return UrlRule(f"{host}{path}", action, (f"{host}{path}**", f"*.{host}{path}**"))


#: What the filter thinks of a URL no site rule speaks about: hosts that advertise betting, pills and the like.
BLOCKED_HOST_PARTS = ("casino", "free-bets", "cheap-pills", "porn", "malware")
DEFAULT_RULES = tuple(
    UrlRule(f"*{part}*", "block", (f"*{part}*", f"*{part}*/**", f"*{part}*?**"), tier=1) for part in BLOCKED_HOST_PARTS
)


def host_of(url: Column) -> Column:
    """The text between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; '' without ``://``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), upper, lower)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_of(url: Column) -> Column:
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.trim(F.regexp_replace(F.regexp_replace(query, f"(?<![^&])({TRACKING})", ""), "&+", "&"), F.lit("&"))
    return F.concat(host_of(url), path_of(url), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def _parse(glob: str) -> list[str]:
    """Single characters and the wildcards '*' and '**'."""
    items, i = [], 0
    while i < len(glob):
        step = 2 if glob.startswith("**", i) else 1
        items.append(glob[i : i + step])
        i += step
    return items


class Automaton:
    """Masks of all globs. A bit stands for 'everything up to here is matched'; bit 0 of a glob is its start."""

    def __init__(self, globs: list[str]) -> None:
        parsed = [_parse(g) for g in globs]
        chars = sorted({c for items in parsed for c in items if c not in ("*", "**")} | {"/", "?"})
        self.codes = np.array([ord(c) for c in chars], dtype=np.uint32)
        n_bits = sum(1 + sum(c not in ("*", "**") for c in items) for items in parsed)
        self.words = max(1, -(-n_bits // 64))
        classes = len(chars) + 1  # the last class: a character in no rule
        enter = np.zeros((classes, self.words), np.uint64)  # states a character may shift into
        stay = np.zeros((classes, self.words), np.uint64)  # states a character may stay in: wildcards
        start = np.zeros(self.words, np.uint64)
        self.final = []
        at = {c: k for k, c in enumerate(chars)}
        bit = 0
        for items in parsed:
            start[bit // 64] |= np.uint64(1 << (bit % 64))
            for c in items:
                if c in ("*", "**"):
                    for k in range(classes):
                        if c == "**" or k not in (at["/"], at["?"]):
                            stay[k, bit // 64] |= np.uint64(1 << (bit % 64))
                    continue
                bit += 1
                enter[at[c], bit // 64] |= np.uint64(1 << (bit % 64))
            self.final.append(bit)
            bit += 1
        self.enter, self.stay, self.start = enter, stay, start

    def match(self, urls: list[str]) -> np.ndarray:
        """Which globs match each URL as a whole: booleans, (URLs, globs)."""
        n = len(urls)
        lengths = np.array([len(u) for u in urls], dtype=np.int64)
        flat = np.frombuffer("".join(urls).encode("utf-32-le"), dtype=np.uint32)
        slot = np.searchsorted(self.codes, flat)
        known = self.codes[np.minimum(slot, len(self.codes) - 1)] == flat
        classes = np.where(known, slot, len(self.codes))
        offsets = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        state = np.tile(self.start, (n, 1))
        for j in range(int(lengths.max()) if n else 0):
            active = order[: int(np.count_nonzero(lengths > j))]
            c = classes[offsets[active] + j]
            now = state[active]
            carry = np.zeros_like(now)
            carry[:, 1:] = now[:, :-1] >> np.uint64(63)
            state[active] = (((now << np.uint64(1)) | carry) & self.enter[c]) | (now & self.stay[c])
        final = np.array(self.final, dtype=np.int64)
        return ((state[:, final // 64] >> (final % 64).astype(np.uint64)) & np.uint64(1)).astype(bool)


def filter_urls(
    df: DataFrame, rules: tuple[UrlRule, ...], url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """Add ``host``, ``path``, ``canonical_url``, ``rule`` (the winner's name or NULL), ``tier`` and ``verdict``.

    Columns of those names in the input are replaced. NULL, empty or odd URLs are judged by their canonical URL, which is
    then empty. Repeated rows stay repeated; an empty table gives an empty result.
    """
    added = ("host", "path", "canonical_url", "rule", "tier", "verdict")
    owners = [k for k, r in enumerate(rules) for _ in r.globs]
    machine = Automaton([g for r in rules for g in r.globs])
    # Rules from the weakest to the strongest: the last one that matches wins.
    rank = sorted(range(len(rules)), key=lambda k: (-rules[k].tier, len(rules[k].name), -k))
    names, tiers = [r.name for r in rules], [r.tier for r in rules]
    url = F.col(f"`{url_col}`").cast("string")
    judged = fresh(df.columns, "canonical_now")
    base = df.withColumn(judged, canonical_of(url)).withColumn(fresh(df.columns, "host_now"), host_of(url))
    base = base.withColumn(fresh(df.columns, "path_now"), path_of(url))
    host, path = base.columns[-2], base.columns[-1]
    base = drop_named(base, added)
    schema = base.schema

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = batch.column(batch.schema.get_field_index(judged)).to_pylist()
            hits = machine.match(urls)
            best = np.full(len(urls), -1, dtype=np.int64)
            for k in rank:
                best[hits[:, [g for g, owner in enumerate(owners) if owner == k]].any(axis=1)] = k
            picked = best.tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([names[k] if k >= 0 else None for k in picked], pa.string()),
                    pa.array([tiers[k] if k >= 0 else None for k in picked], pa.int32()),
                    pa.array([rules[k].action if k >= 0 else default for k in picked], pa.string()),
                ],
                names=[*batch.schema.names, "rule", "tier", "verdict"],
            )

    out_schema = extended(schema, "rule string, tier int, verdict string")
    out = base.mapInArrow(judge, out_schema)
    return out.withColumnsRenamed({host: "host", path: "path", judged: "canonical_url"})
