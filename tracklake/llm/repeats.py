"""Find all windows of a corpus that occur more than once, without sorting or shuffling the corpus.

A window is ``window`` consecutive units (bytes or words) of one document. Its *owner* is the smallest hash among its k-grams, so
equal windows have equal owners wherever they stand, and neighbouring windows share an owner in runs. Steps, all on chunks of
about ``chunk_bytes`` of whole documents that are written once, compressed:

ask     every chunk sends its distinct owners with their counts, packed by bucket of the owner
answer  a bucket tells each chunk which of its owners occur elsewhere (a few percent of all)
cut     a chunk sends the text of the runs of those owners; owners that very many runs share (``hot``) are cut further into
        single windows that are sent by a 128-bit hash, so no bucket gathers a common passage
judge   a bucket compares what it got: runs that differ go through the caller's ``resolve``; it sends back ranges of units
finish  a chunk removes the ranges from its documents

What repeats inside a chunk is decided there, so a bucket gets each text once a chunk, however many copies there are. Sizes of a
bucket and of a chunk are bounded by parameters; every step may be recomputed from the written chunks.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import process_cache, stored
from tracklake.llm.straddle import NO_ID, Runs, decide, gather

U = np.uint64
OWNER_BITS = 48
BLOCK = 1 << 14  # hashes computed at a time, so that they stay in the processor's cache


@dataclass(frozen=True)
class Rule:
    """What counts as a repeat.

    ``words``: units are words, else bytes. ``earlier_only``: a window goes if it also starts in a document with a smaller id; else
    if it also starts anywhere else. ``resolve`` gets the texts of
    each owner that need comparing, as (kind, owner, text), what is known of each as a whole, and this rule; it returns one array per text: for ``earlier_only`` the smallest id in which each window occurs, else whether
    each occurs more than once. ``by_window`` (bytes) does the same for runs that came as columns: texts as symbols with a zero behind
    each, symbols of a window and smallest known id of each.
    """

    words: bool
    window: int
    gram: int
    earlier_only: bool
    resolve: Callable[[list[list[tuple]], list[int], "Rule"], list[np.ndarray]]
    by_window: Callable[[np.ndarray, np.ndarray, np.ndarray], list[np.ndarray]] | None = None
    hot: int = 300
    chunk_bytes: int = 1 << 20
    buckets: tuple[int, int] = (256, 1024)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def gram_hashes(units: np.ndarray, size: int, factor: int) -> np.ndarray:
    """Polynomial hash of every ``size`` consecutive units, by doubling."""
    n = len(units) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    out, have, power = None, 0, U(factor)
    block, width = units, 1
    with np.errstate(over="ignore"):
        while size:
            if size & 1:  # this block stands behind what is there
                part = block[have : have + n] if out is not None else block[:n]
                out = part.copy() if out is None else out * power + part
                have += width
            size >>= 1
            if size:
                block = block[:-width] * power + block[width:]
                power = power * power
                width *= 2
        return out


def byte_grams(raw: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` (eight at least) consecutive bytes."""
    n = max(0, len(raw) - size + 1)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 8,), dtype="<u8", buffer=padded, strides=(1,))
    out = np.empty(n, U)
    with np.errstate(over="ignore"):
        for a in range(0, n, BLOCK):
            b = min(n, a + BLOCK)
            x = mix(eight[a:b])
            for at in [*range(8, size - 7, 8), *([size - 8] if size % 8 else [])]:
                x ^= eight[a + at : b + at]
                x *= U(0x9E3779B97F4A7C15)
                x = mix(x)
            out[a:b] = x >> U(64 - OWNER_BITS)
    return out


def gram_checks(raw: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Two more bytes of hash of the grams of 24 bytes or more at these places; with the owner they make 64 bits."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 8,), dtype="<u8", buffer=padded, strides=(1,))
    with np.errstate(over="ignore"):
        x = mix(eight[places] * U(0xD6E8FEB86659FD93))
        for at in (8, 16):
            x = mix((x ^ eight[places + at]) * U(0xD6E8FEB86659FD93))
    return (x >> U(48)).astype("<u2")


class Chunk:
    """Documents of one chunk as units, with the runs of windows that share an owner."""

    def __init__(self, rule: Rule, data: bytes, lens: np.ndarray) -> None:
        self.rule, self.data = rule, data
        edges = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
        if rule.words:
            import xxhash

            digest = xxhash.xxh3_64_intdigest
            per_doc = [data[a:b].split() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            self.words = [w for doc in per_doc for w in doc]
            self.sizes = np.array([len(doc) for doc in per_doc], dtype=np.int64)
            self.units = np.fromiter(map(digest, self.words), dtype=U, count=len(self.words))
        else:
            self.sizes = np.asarray(lens, dtype=np.int64)
            self.raw = np.frombuffer(data, dtype=np.uint8)
            self.units = self.raw
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def _grams(self) -> np.ndarray:
        if not self.rule.words:
            return byte_grams(self.raw, self.rule.gram)
        with np.errstate(over="ignore"):
            return mix(gram_hashes(self.units, self.rule.gram, 0x9E3779B97F4A7C15)) >> U(64 - OWNER_BITS)

    def runs(self) -> None:
        """``owner``, ``start``, ``length`` (in windows) and ``of`` (document) of every run."""
        rule, n = self.rule, len(self.units)
        if n < rule.window:
            self.owner, self.start, self.length, self.of = np.zeros(0, U), *[np.zeros(0, np.int64)] * 3
            return
        x = low = self._grams()
        wide, span = rule.window - rule.gram + 1, 1
        while span * 2 <= wide:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < wide:
            low = np.minimum(low[: len(low) - (wide - span)], low[wide - span :])
        m = n - rule.window + 1
        inside = self.doc[:m] == self.doc[rule.window - 1 :]
        change = np.ones(m, dtype=bool)
        change[1:] = (low[1:m] != low[: m - 1]) | (self.doc[1:m] != self.doc[: m - 1]) | ~inside[:-1]
        starts = np.flatnonzero(change & inside)
        stops = np.flatnonzero(inside & np.append(change[1:] | ~inside[1:], True))
        self.start, self.length = starts, stops - starts + 1
        self.owner, self.of = low[starts], self.doc[starts]
        self.grams, self.low = x, low

    def owners(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct owners and the index of each run's owner."""
        return np.unique(self.owner, return_inverse=True)

    def counts(self, distinct: np.ndarray, index: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Of each distinct owner the count of ids or places, at most 255."""
        if self.rule.earlier_only:
            _, doc = np.unique(ids, return_inverse=True)
            pairs = np.sort(index * (len(ids) + 1) + doc[self.of])
            pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]]
            count = np.bincount(pairs // (len(ids) + 1), minlength=len(distinct))
        else:
            values, times = np.unique(self.grams, return_counts=True) if len(distinct) else (distinct, distinct)
            count = times[np.searchsorted(values, distinct)] if len(distinct) else np.zeros(0, np.int64)
        return np.minimum(count, 255).astype(np.uint8)

    def held(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For these runs, where the owner's gram first stands and how often it stands in the run."""
        wide = self.rule.window - self.rule.gram + 1
        # A gram is the smallest of some window exactly if the largest of its windows' minima is its own hash.
        top = np.concatenate([np.zeros(wide - 1, U), self.low, np.zeros(max(0, len(self.grams) - len(self.low)), U)])
        span = 1
        while span * 2 <= wide:
            top = np.maximum(top[:-span], top[span:])
            span *= 2
        if span < wide:
            top = np.maximum(top[: len(top) - (wide - span)], top[wide - span :])
        chosen = np.flatnonzero(top[: len(self.grams)] == self.grams)
        start, stop = self.start[some], self.start[some] + self.length[some] - 1 + wide
        at, to = np.searchsorted(chosen, start), np.searchsorted(chosen, stop)
        run = np.repeat(np.arange(len(some)), to - at)
        place = chosen[np.arange(len(run)) + np.repeat(at - np.cumsum(to - at) + (to - at), to - at)]
        hit = self.grams[place] == self.owner[some][run]
        run, place = run[hit], place[hit]
        first = np.full(len(some), -1)
        first[run[::-1]] = place[::-1]  # the last one written is the first one there
        times = np.bincount(run, minlength=len(some))
        return first, times

    def text(self, start: int, units: int) -> bytes:
        return b" ".join(self.words[start : start + units]) if self.rule.words else self.data[start : start + units]

    def window_hashes(self, at: np.ndarray) -> np.ndarray:
        """128-bit hashes of the windows at these places, two columns."""
        out = np.empty((len(at), 2), U)
        with np.errstate(over="ignore"):
            if self.rule.words:
                for k, factor in enumerate((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)):
                    out[:, k] = mix(gram_hashes(mix(self.units + U(k)), self.rule.window, factor))[at]
                return out
            padded = np.concatenate([self.raw, np.zeros(8, np.uint8)])
            eight = np.ndarray((len(padded) - 8,), dtype="<u8", buffer=padded, strides=(1,))
            size = self.rule.window
            for k, factor in enumerate((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)):
                x = np.full(len(at), k, U)
                for step in [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]:
                    x = mix((x ^ eight[at + step]) * U(factor))
                out[:, k] = x
        return out


def _open(rule: Rule, row: pd.Series) -> tuple[Chunk, np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=int(np.sum(row["lens"])) + 1)
    ids = np.array([NO_ID if v is None or v != v else int(v) for v in row["ids"]], dtype=np.int64)
    return Chunk(rule, data, np.asarray(row["lens"], dtype=np.int64)), ids


def _chunks(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    source = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        squeeze = zstandard.ZstdCompressor(level=7)
        ids, texts, held = [], [], 0

        def flush() -> pa.RecordBatch:
            columns = [
                pa.array([number], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                pa.array([squeeze.compress(b"".join(texts))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "lens", "data"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = text.encode("utf-8")
                if texts and held + len(raw) > size:
                    yield flush()
                    number += 1
                    ids, texts, held = [], [], 0
                ids.append(doc)
                texts.append(raw)
                held += len(raw)
        if texts:
            yield flush()

    chunks = source.mapInArrow(make, "chunk bigint, ids array<bigint>, lens array<bigint>, data binary")
    return stored(chunks, "chunks")


def _split(sorted_owner: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by bucket (then owner), the buckets there, and where each begins (with the end)."""
    bucket = (sorted_owner % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    there, first = np.unique(bucket[order], return_index=True)
    return order, there, np.append(first, len(order))


def _runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of every run of True."""
    edge = np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


COLUMNS = ("u1", "<u8", "<u4", "<i8", "<u4")  # kind, owner, size of the text, id or multiplicity, number of starts


def _planes(column: np.ndarray) -> bytes:
    """Bytes of a column by their place in the number: high bytes are mostly equal and then take no room."""
    return column.view(np.uint8).reshape(len(column), column.itemsize).T.tobytes()


def _from_planes(raw: bytes, kind: str, count: int, at: int) -> tuple[np.ndarray, int]:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(raw, np.uint8, count * width, at).reshape(width, count)
    return np.ascontiguousarray(planes.T).view(kind).ravel(), at + count * width


def _squeezer() -> tuple[Callable[[bytes], bytes], Callable[[bytes], bytes]]:
    def make() -> tuple:
        import zstandard

        return zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress

    return process_cache("squeezer", make)


def _pack(items: list[tuple], echo: np.ndarray, runs: bytes = b"") -> bytes:
    """Items: (kind, owner, text, id or multiplicity, starts); ``runs``: those that travel as columns."""
    kinds, owners, texts, values, starts = zip(*items, strict=True) if items else ((),) * 5
    counts = [len(s) for s in starts]
    flat = np.array([s for some in starts for s in some], dtype="<u4")
    columns = (kinds, owners, [len(t) for t in texts], values, counts)
    body = [struct.pack("<4q", len(items), len(flat), len(echo), len(runs)), runs]
    body += [_planes(np.array(c, dtype=kind)) for c, kind in zip(columns, COLUMNS, strict=True)]
    body += [_planes(flat), echo.astype("<i8").tobytes(), *texts]
    return _squeezer()[0](b"".join(body))


def _unpack(data: bytes) -> tuple[list[tuple], np.ndarray, bytes]:
    raw = _squeezer()[1](data)
    n, m, e, r = struct.unpack_from("<4q", raw)
    runs = raw[32 : 32 + r]
    at, columns = 32 + r, []
    for kind in COLUMNS:
        column, at = _from_planes(raw, kind, n, at)
        columns.append(column.tolist())
    flat, at = _from_planes(raw, "<u4", m, at)
    flat = flat.tolist()
    echo = np.frombuffer(raw, "<i8", e, at)
    at += 8 * e
    items, s = [], 0
    for kind, owner, size, value, count in zip(*columns, strict=True):
        items.append((kind, owner, raw[at : at + size], value, flat[s : s + count]))
        at += size
        s += count
    return items, echo, runs


def find_repeats(docs: DataFrame, rule: Rule, id_col: str, text_col: str, finish_schema: str, finish: Callable) -> DataFrame:
    """Apply ``finish(chunk, document number, id, flags of its units)`` -> row to every document."""
    chunks = _chunks(docs, id_col, text_col, rule.chunk_bytes)
    low, high = rule.buckets
    buckets = max(low, min(high, chunks.count() // 2))
    window = rule.window

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, row in frame.iterrows():
                chunk, ids = _open(rule, row)
                chunk.runs()
                owner, index = chunk.owners()
                count = chunk.counts(owner, index, ids)
                order, there, edge = _split(owner, buckets)
                short = (owner[order] // U(buckets)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                packed = np.concatenate([short[:, ::-1], count[order][:, None]], axis=1)
                squeeze = _squeezer()[0]
                out = [squeeze(packed[a:b].T.tobytes()) for a, b in zip(edge[:-1], edge[1:], strict=True)]
                yield pd.DataFrame({"bucket": there.astype(np.int32), "chunk": np.full(len(there), row["chunk"]), "data": out})

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(_squeezer()[1](d), np.uint8).reshape(6, -1).T for d in frame["data"]]
        every = np.concatenate(parts)
        wide = np.zeros((len(every), 8), np.uint8)
        wide[:, :5] = every[:, 4::-1]
        distinct, index = np.unique(wide.view("<u8").ravel(), return_inverse=True)
        total = np.bincount(index, every[:, 5], len(distinct))
        code = np.where(total > rule.hot, 2, np.where(total > 1, 1, 0)).astype(np.uint8)[index]
        edge = np.cumsum([0, *map(len, parts)])
        rows = [
            (c, b, code[i:j].tobytes())
            for c, b, i, j in zip(frame["chunk"], frame["bucket"], edge[:-1], edge[1:], strict=True)
            if code[i:j].any()
        ]
        return pd.DataFrame(rows, columns=["chunk", "bucket", "codes"])

    def cut(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"bucket": [], "chunk": [], "data": []}).astype({"bucket": "int32", "chunk": "int64"})
        if right.empty or left.empty:
            return empty
        chunk, ids = _open(rule, left.iloc[0])
        chunk.runs()
        owner, index = chunk.owners()
        order, there, edge = _split(owner, buckets)
        code = np.zeros(len(owner), np.uint8)
        where = {int(b): k for k, b in enumerate(there)}
        for b, codes in zip(right["bucket"], right["codes"], strict=True):
            k = where[int(b)]
            code[order[edge[k] : edge[k + 1]]] = np.frombuffer(codes, np.uint8)
        run_code = code[index]
        echo: list[tuple[int, int]] = []
        out: dict[int, list] = {}
        columns: Runs | None = None

        def settle(groups: dict, kind: int, bucket_of: Callable) -> None:
            """Decide what this chunk can; send one representative of each text."""
            for (head, text), places in groups.items():
                if type(places) is tuple:  # once in this chunk, as nearly all
                    value = places[0] if rule.earlier_only else 1
                    to = out.get(b := bucket_of(head))
                    if to is None:
                        to = out[b] = []
                    to.append((kind, head if kind != 1 else 0, text, value, (places[1],)))
                    continue
                if rule.earlier_only:
                    value = min(p[0] for p in places)
                    open_ = [p[1] for p in places if p[0] == value]
                    echo.extend((p[1], p[1] + p[2] - 1 + window) for p in places if p[0] > value)
                else:
                    value = min(len(places), 2)
                    open_ = [places[0][1]] if value == 1 else []
                    if value > 1:
                        echo.extend((p[1], p[1] + p[2] - 1 + window) for p in places)
                out.setdefault(bucket_of(head), []).append((kind, head if kind != 1 else 0, text, value, open_))

        def add(groups: dict, key: tuple, place: tuple) -> None:
            there = groups.get(key)
            if there is None:
                groups[key] = place
            elif type(there) is tuple:
                groups[key] = [there, place]
            else:
                there.append(place)

        groups: dict = {}
        text_of = chunk.text
        some = np.flatnonzero(run_code == 1)
        doc_id = ids[chunk.of[some]].tolist()
        runs = (doc_id, chunk.start[some].tolist(), chunk.length[some].tolist(), chunk.owner[some].tolist())
        if rule.words:
            for d, s, n, o in zip(*runs, strict=True):
                add(groups, (o, text_of(s, n - 1 + window)), (d, s, n))
            settle(groups, 0, lambda o: o % buckets)
        else:
            first, times = chunk.held(some)
            check = gram_checks(chunk.raw, first)
            once = times == 1
            columns, decided = gather(chunk, some[once], first[once], check[once], ids, buckets)
            echo.extend(decided.tolist())
            whole: dict = {}
            data = chunk.data
            for k in np.flatnonzero(~once).tolist():
                d, s, n, o = (column[k] for column in runs)
                add(whole, (o, int(check[k]).to_bytes(2, "little") + data[s : s + n - 1 + window]), (d, s, n))
            settle(whole, 0, lambda o: o % buckets)
        some = np.flatnonzero(run_code == 2)
        if len(some):
            at = np.repeat(chunk.start[some] - np.cumsum(chunk.length[some]) + chunk.length[some], chunk.length[some])
            at = at + np.arange(len(at))
            hashes = chunk.window_hashes(at)
            doc_id = ids[chunk.doc[at]].tolist()
            groups = {}
            for d, s, h in zip(doc_id, at.tolist(), map(bytes, hashes.view(np.uint8).reshape(-1, 16)), strict=True):
                add(groups, (0, h), (d, s, 1))
            regrouped: dict = {}
            for (_, h), places in groups.items():
                regrouped[(int.from_bytes(h[:6], "little") % buckets, h)] = places
            settle(regrouped, 1, lambda b: b)
        number = int(left["chunk"].iloc[0])
        home = int(mix(np.array([number], U))[0]) % buckets  # numbers of first chunks share their low bits
        if echo:
            out.setdefault(home, [])
        flat = np.array(echo, dtype=np.int64).ravel()
        none = np.zeros(0, np.int64)
        packed: dict[int, bytes] = {}
        if columns is not None:
            _, there, edge = _split(columns.owner, buckets)  # in order of their bucket already
            places = np.append(0, np.cumsum(columns.count))
            for b, i, j in zip(there.tolist(), edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                packed[b] = columns.pack(i, j, columns.starts[places[i] : places[j]], _planes)
                out.setdefault(b, [])
        rows = [(b, number, _pack(items, flat if b == home else none, packed.get(b, b""))) for b, items in out.items()]
        return pd.DataFrame(rows, columns=["bucket", "chunk", "data"]) if rows else empty

    def judge(frame: pd.DataFrame) -> pd.DataFrame:
        ranges: dict[int, list[int]] = {}
        known: dict = {}  # (kind, owner, text) -> what is known of the text as a whole
        owners: dict[tuple, list[tuple]] = {}
        waiting = []

        def take(number: int, items: list[tuple]) -> None:
            for kind, owner, text, value, starts in items:
                key = (kind, owner, text)
                if key in known:
                    known[key] = min(known[key], value) if rule.earlier_only else known[key] + value
                else:
                    known[key] = value
                    if kind != 1:
                        owners.setdefault(owner if rule.words else (owner, text[:2]), []).append(key)
                if starts:
                    waiting.append((number, key, value, starts))

        parts: list[tuple[int, Runs]] = []
        for number, data in zip(frame["chunk"].tolist(), frame["data"], strict=True):
            items, echo, runs = _unpack(data)
            if len(echo):
                ranges.setdefault(number, []).extend(echo.tolist())
            take(number, items)
            if runs:
                parts.append((number, Runs.unpack(runs, window - rule.gram, _from_planes)))
        if owners and parts:  # an owner that has a text with its gram several times is compared as texts
            several = np.array([owner for owner, _ in owners], dtype=U)
            mixed = {(owner, int.from_bytes(check, "little")) for owner, check in owners}
            for k, (number, runs) in enumerate(parts):
                some = [i for i in np.flatnonzero(np.isin(runs.owner, several)).tolist() if (int(runs.owner[i]), int(runs.check[i])) in mixed]
                if some:
                    ends = np.cumsum(runs.count)
                    starts = [runs.starts[ends[i] - runs.count[i] : ends[i]].tolist() for i in some]
                    take(number, [(2, int(runs.owner[i]), runs.text(i), int(runs.value[i]), at) for i, at in zip(some, starts, strict=True)])
                    parts[k] = (number, runs.without(some))
        for number, flat in decide(parts, rule, rule.by_window).items():
            ranges.setdefault(number, []).extend(flat)
        groups = [g for g in owners.values() if len(g) > 1 or not rule.earlier_only and known[g[0]] < 2]
        doubtful = [key for group in groups for key in group]
        detail: dict[tuple, np.ndarray] = {}
        if doubtful:
            detail = dict(zip(doubtful, rule.resolve(groups, [known[key] for key in doubtful], rule), strict=True))
        for number, key, value, starts in waiting:
            kind, _, text = key
            units = window if kind == 1 else text.count(b" ") + 1 if rule.words else len(text) - 2 + (kind == 2) * (rule.gram - 1)
            runs = [(0, units - window)]
            if key in detail:
                flags = detail[key] < value if rule.earlier_only else detail[key]
                found = np.count_nonzero(flags)
                if not found:
                    continue
                if found < len(flags):
                    runs = list(zip(*(x.tolist() for x in _runs_of(flags)), strict=True))
            elif not (known[key] < value if rule.earlier_only else known[key] > 1):
                continue
            to = ranges.setdefault(number, [])
            for s in starts:
                for a, b in runs:
                    to += (a + s, b + s + window)
        rows = [(n, np.array(r, dtype="<i8").tobytes()) for n, r in ranges.items()]
        return pd.DataFrame(rows, columns=["chunk", "ranges"])

    def end(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame()
        row = left.iloc[0]
        chunk, _ = _open(rule, row)
        step = np.zeros(len(chunk.units) + 1, dtype=np.int64)
        for data in right["ranges"]:
            pairs = np.frombuffer(data, "<i8").reshape(-1, 2)
            np.add.at(step, pairs[:, 0], 1)
            np.add.at(step, pairs[:, 1], -1)
        gone = np.cumsum(step[:-1]) > 0
        edge = np.concatenate([[0], np.cumsum(chunk.sizes)]).tolist()
        rows = [finish(chunk, a, b, doc, gone[a:b]) for a, b, doc in zip(edge[:-1], edge[1:], row["ids"], strict=True)]
        return pd.DataFrame(rows, columns=names)

    names = [f.split()[0] for f in finish_schema.split(",")]
    asked = chunks.mapInPandas(ask, "bucket int, chunk bigint, data binary")
    answered = asked.groupBy("bucket").applyInPandas(answer, "chunk bigint, bucket int, codes binary")
    parts = chunks.groupBy("chunk").cogroup(answered.groupBy("chunk"))
    parts = parts.applyInPandas(cut, "bucket int, chunk bigint, data binary")
    judged = parts.groupBy("bucket").applyInPandas(judge, "chunk bigint, ranges binary")
    return chunks.groupBy("chunk").cogroup(judged.groupBy("chunk")).applyInPandas(end, finish_schema)
