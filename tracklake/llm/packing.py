"""Packing: whole documents into fixed-length sequences, balanced by attention cost, without padding.

A piece of n tokens costs ``linear * n + quadratic * n**2`` (attention inside a piece). Every task packs what it scans, so
nothing is shuffled: documents are cut into full sequences first; the rests go, longest first, to the cheapest
sequence with remaining capacity. A rest is cut only if no open sequence has room for it. A window of documents gets
exactly as many open sequences as its rests fill, and what is left over (less than one sequence a window) becomes sequences of
powers of two, which need no padding either.

Tokens: byte-level BPE. Text is split at single spaces (a token never crosses one) and each part is looked up in a
bounded cache of encoded parts; the ids equal those of the ``tokenizers`` file of the same vocabulary. That file's added tokens
are one id wherever a text spells them out.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tracklake.llm.common import extended, process_cache

CACHED_PARTS = 150_000


class PartIds(dict):
    """What follows a space, to its ids with that space, as little-endian unsigned 32-bit bytes.

    When it is full it starts anew beside what it held, from where parts that come again are taken over: frequent parts stay, and at
    most twice ``CACHED_PARTS`` are held.
    """

    def __init__(self, ranks: bytes, pattern: str, added: dict[str, int] | None = None) -> None:
        super().__init__()
        import tiktoken

        self.older: dict[str, bytes] = {}
        self.added = {token: struct.pack("<I", number) for token, number in (added or {}).items()}
        longest = sorted(self.added, key=len, reverse=True)
        self.split_added = re.compile(f"({'|'.join(map(re.escape, longest))})").split if longest else None

        pairs = (line.split() for line in ranks.splitlines() if line)
        self.encoding = tiktoken.Encoding(
            "bpe", pat_str=pattern, mergeable_ranks={base64.b64decode(t): int(i) for t, i in pairs}, special_tokens={}
        )
        # A space that has white space beside it may belong to a longer run; such texts are encoded whole.
        self.odd = re.compile(r" \s|\s |^\s| $").search

    def whole(self, text: str) -> bytes:
        ids = self.encoding.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, part: str) -> bytes:
        if len(self) >= CACHED_PARTS:
            self.older = dict(self)
            self.clear()
        out = self[part] = self.older.get(part) or self.whole(" " + part)
        return out

    def ids(self, text: str) -> bytes:
        if self.split_added:
            plain, *rest = self.split_added(text)
            if rest:  # added tokens and plain texts in turn
                pieces = [self.added[t] if k % 2 == 0 else self.plain(t) for k, t in enumerate(rest)]
                return b"".join([self.plain(plain), *pieces])
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        if self.odd(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        return self.whole(first) + b"".join(map(self.__getitem__, rest))


class OpenSequences:
    """Open sequences by room: a heap of (cost, sequence) for each room, and the least of every range of rooms in a tree."""

    NONE = (float("inf"), -1)

    def __init__(self, length: int) -> None:
        self.width = 1 << length.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(length + 1)]
        self.least = [self.NONE] * (2 * self.width)

    def _renew(self, room: int) -> None:
        k = self.width + room
        self.least[k] = self.heaps[room][0] if self.heaps[room] else self.NONE
        while k > 1:
            k //= 2
            self.least[k] = min(self.least[2 * k], self.least[2 * k + 1])

    def put(self, cost: float, j: int, room: int) -> None:
        heapq.heappush(self.heaps[room], (cost, j))
        self._renew(room)

    def cheapest(self, n: int) -> tuple[float, int]:
        """The cheapest with room for ``n`` tokens, NONE if no sequence has it."""
        best, low, high = self.NONE, self.width + n, 2 * self.width
        while low < high:
            if low & 1:
                best = min(best, self.least[low])
                low += 1
            low, high = low // 2, high // 2
        return best

    def take(self, room: int) -> None:
        """Remove the cheapest of those with this room."""
        heapq.heappop(self.heaps[room])
        self._renew(room)


def deal(rests: list[tuple[int, int]], length: int, linear: float, quadratic: float) -> list[list[tuple]]:
    """Sequences as lists of (document, tokens). ``rests``: (document, tokens), each shorter than ``length``.

    Longest first, each to the cheapest open sequence with room for it. Only if none has room, the cheapest of all is filled
    and the remainder queues again.
    """
    total = sum(n for _, n in rests)
    count = total // length
    queue = [(-n, k, doc) for k, (doc, n) in enumerate(rests)]
    heapq.heapify(queue)
    open_ = OpenSequences(length)
    for j in range(count):
        open_.put(0.0, j, length)
    room, placed = [length] * count, [[] for _ in range(count)]
    serial = len(rests)
    while queue and open_.cheapest(1)[1] >= 0:
        n, k, doc = heapq.heappop(queue)
        n = -n
        cost, j = open_.cheapest(n)
        if j < 0:
            cost, j = open_.cheapest(1)
        open_.take(room[j])
        take = min(n, room[j])
        placed[j].append((doc, take))
        room[j] -= take
        if room[j]:
            open_.put(cost + linear * take + quadratic * take * take, j, room[j])
        if take < n:
            heapq.heappush(queue, (take - n, serial, doc))
            serial += 1
    rest, left = [], 0
    while queue:
        n, _, doc = heapq.heappop(queue)
        rest.append((doc, -n))
        left -= n
    while left:  # sequences of powers of two
        size = 1 << (left.bit_length() - 1)
        left -= size
        sequence = []
        while size:
            doc, n = rest.pop(0)
            take = min(n, size)
            sequence.append((doc, take))
            size -= take
            if take < n:
                rest.insert(0, (doc, n - take))
        placed.append(sequence)
    return placed


def pack(
    docs: DataFrame, ranks: bytes, pattern: str, added: dict[str, int] | None = None, id_col: str = "doc_id", text_col: str = "text", length: int = 1024,
    end_id: int = 0, window_tokens: int = 4_000_000, linear: float = 1.0, quadratic: float = 1.0 / 1024,
) -> DataFrame:
    """Pieces: the id, ``start`` (ids of the document before it), ``length``, ``ids`` (little-endian unsigned 32 bits),
    ``doc_tokens`` (with ``end_id``), ``sequence_id``, ``offset`` in the sequence.

    A NULL or empty text is the end id alone. A NULL id stays NULL; repeated rows are packed once each. Other columns are
    not read, so their names cannot clash. An empty table has no pieces. ``ranks`` is the content of a rank file, ``added`` the
    id of each added token.
    """
    source = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    )
    id_field = StructField(id_col, source.schema["doc_id"].dataType)
    ddl = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    schema = extended(StructType([id_field]), ddl)
    end = end_id.to_bytes(4, "little")
    # Workers outlive a call: another vocabulary must not meet this one's ids.
    vocabulary = hashlib.sha256(ranks + repr((pattern, sorted((added or {}).items()))).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts = process_cache(f"part_ids_{vocabulary}", lambda: PartIds(ranks, pattern, added))
        next_id = TaskContext.get().partitionId() << 40
        names, blobs, held = [], [], 0
        id_type = None

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal next_id
            rows, rests = [], []

            def put(k: int, start: int, size: int, offset: int) -> None:
                rows.append((k, start, size, next_id, offset))

            for k, blob in enumerate(blobs):
                n = len(blob) // 4
                for start in range(0, n - length + 1, length):
                    put(k, start, length, 0)
                    next_id += 1
                if n % length:
                    rests.append((k, n % length))
            at = {k: len(blobs[k]) // 4 // length * length for k, _ in rests}
            for sequence in deal(rests, length, linear, quadratic):
                offset = 0
                for k, size in sequence:
                    put(k, at[k], size, offset)
                    at[k] += size
                    offset += size
                next_id += 1
            for i in range(0, len(rows), 4096):
                some = [
                    (names[k], start, size, blobs[k][4 * start : 4 * (start + size)], len(blobs[k]) // 4, sequence, offset)
                    for k, start, size, sequence, offset in rows[i : i + 4096]
                ]
                columns = list(zip(*some, strict=True))
                types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names
                )

        for batch in batches:
            id_type = batch.schema.field(0).type
            for name, text in zip(*batch.columns, strict=True):
                names.append(name.as_py())
                blobs.append(parts.ids(text.as_py()) + end)
                held += len(blobs[-1]) // 4
                if held >= window_tokens:
                    yield from flush()
                    names, blobs, held = [], [], 0
        if blobs:
            yield from flush()

    return source.mapInArrow(run, schema)
