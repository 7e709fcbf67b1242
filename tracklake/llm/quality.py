"""Quality classifier: histogram gradient-boosted trees over statistics of a text.

Statistics of every whole text are computed in Arrow batches beside the scan. Labels are learnt from a bounded sample of
the labelled rows (``sample_rows``, the rows smallest by a hash of their id), so the only data that reaches the driver is
that sample's feature matrix. The trees are trained on feature histograms and stored as flat arrays; a whole batch
walks down a tree together, one numpy step per level. Scoring needs no shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.llm.common import drop_named, extended

FEATURES = (
    "log_bytes", "letter", "upper", "digit", "space", "newline", "period", "comma", "pipe", "exclaim", "hash", "symbol",
    "quote", "non_ascii", "log_words", "mean_word", "distinct_words", "top_word", "repeat_next", "distinct_lines",
    "mean_line", "byte_entropy", "upper_words", "no_letter_words",
)


def text_features(text: str | None) -> list[float]:
    """Statistics of one whole text; an empty or NULL text gives zeros."""
    raw = (text or "").encode("utf-8", "replace")
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = count / n
    upper, lower, digit = share[65:91].sum(), share[97:123].sum(), share[48:58].sum()
    space = share[32] + share[9:14].sum()
    named = share[46] + share[44] + share[124] + share[33] + share[35] + share[34]
    high = share[128:].sum()
    symbol = max(0.0, 1.0 - upper - lower - digit - space - named - high)
    some = share[share > 0]
    words = raw.split()
    m = len(words) or 1
    seen = Counter(words)
    lines = [line for line in raw.split(b"\n") if line]
    return [
        np.log1p(n), upper + lower, upper, digit, space, share[10], share[46], share[44], share[124], share[33], share[35],
        symbol, share[34], high, np.log1p(len(words)), sum(map(len, words)) / m, len(seen) / m,
        max(seen.values(), default=0) / m, sum(map(bytes.__eq__, words, words[1:])) / m,
        len(set(lines)) / (len(lines) or 1), np.log1p(n / (len(lines) or 1)), float(-(some * np.log2(some)).sum()),
        sum(map(bytes.isupper, words)) / m, 1.0 - sum(n_ for w, n_ in seen.items() if w.isalpha() or not w.isascii()) / m,
    ]


@dataclass(frozen=True)
class Trees:
    """Flattened trees: node k of tree t has feature[t, k], threshold[t, k], and its children 2k+1, 2k+2.

    A node that is not split sends every row left; leaves hold the step's value.
    """

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves each row ends in."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - (2**self.depth - 1)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def train(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 1.0,
    least: int | None = None,
) -> Trees:
    """Boost trees on the log loss. No rows: every score is 0.5; one class only: its (smoothed) share.

    ``least``: rows in a leaf; by default 20, fewer (4 at least) for less than 3,000 rows.
    """
    least = max(4, min(20, len(y) // 150)) if least is None else least
    prior = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(prior / (1 - prior)))
    inner, leaves = 2**depth - 1, 2**depth
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    if len(y) < 2 * least or y.min() == y.max():
        return Trees(base, depth, feature[:0], threshold[:0], value[:0])
    # Cuts between bins: quantiles of each feature, midway between neighbouring values.
    cuts = []
    for column in x.T:
        values = np.unique(column)
        middle = (values[1:] + values[:-1]) / 2
        step = np.linspace(0, len(middle) - 1, min(bins - 1, len(middle))).astype(int)
        quantile = np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])
        cuts.append(np.unique(np.concatenate([middle[step][:: max(1, len(step) // 16)], quantile]))[: 2 * bins])
    width = max(len(c) for c in cuts) + 1
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T, strict=True)])
    margin = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            best = np.full(count, 1e-9)
            for f in range(x.shape[1]):
                slot = local * width + binned[f]
                size = count * width
                g = np.bincount(slot, gradient, size).reshape(count, width).cumsum(1)
                h = np.bincount(slot, weight, size).reshape(count, width).cumsum(1)
                k = np.bincount(slot, minlength=size).reshape(count, width).cumsum(1)
                gain = g**2 / (h + l2) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + l2) - g[:, -1:] ** 2 / (h[:, -1:] + l2)
                gain[(k < least) | (k[:, -1:] - k < least)] = 0
                gain[:, len(cuts[f]) :] = 0
                pick = gain.argmax(1)
                better = gain[np.arange(count), pick] > best
                for j in np.flatnonzero(better):
                    best[j] = gain[j, pick[j]]
                    feature[t, first + j], threshold[t, first + j] = f, cuts[f][pick[j]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, leaves), np.bincount(leaf, weight, leaves)
        value[t] = -rate * g / (h + l2)
        margin += value[t][leaf]
    return Trees(base, depth, feature, threshold, value)


def features_of(df: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """``keep`` and ``features``, one array per row."""
    base = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("features"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_features(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(rows, pa.list_(pa.float64()))], names=batch.schema.names
            )

    schema = extended(base.drop("features").schema, "features array<double>")
    return base.mapInArrow(run, schema)


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample_rows: int = 20_000, **options: int,
) -> Trees:
    """Train on at most ``sample_rows`` labelled texts.

    Labels that are NULL or belong to a NULL id are not used; a repeated id counts once, with its larger label; of
    a repeated document one text counts, the smallest by hash.
    """
    order = F.xxhash64("id")
    picked = (
        labels.select(F.col(f"`{id_col}`").alias("id"), (F.col(f"`{label_col}`") > 0).cast("int").alias("y"))
        .dropna()
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .orderBy(order, "id")
        .limit(sample_rows)
    )
    found = (
        docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
        .join(F.broadcast(picked), "id")  # bounded by sample_rows
        .withColumn("at", F.xxhash64("text"))
    )
    rows = (
        features_of(found, ["id", "y", "at"], "text")
        .groupBy("id")
        .agg(F.min(F.struct("at", "y", "features")).alias("r"))
        .orderBy(order, "id")
        .limit(sample_rows)
        .select("r.y", "r.features")
        .toArrow()
    )
    y = np.array(rows.column("y").to_pylist(), dtype=np.float64)
    x = np.array(rows.column("features").to_pylist(), dtype=np.float64).reshape(len(y), len(FEATURES))
    return train(x, y, **options)


def score_quality(
    docs: DataFrame, model: Trees, text_col: str = "text", score_col: str = "score", threshold: float = 0.3,
    predicted_col: str = "predicted",
) -> DataFrame:
    """All columns and rows of ``docs`` with the score of the whole text and ``predicted`` (1 from ``threshold`` on).

    NULL and empty texts are scored as texts with all statistics zero. Columns of the added names are replaced.
    """
    base = drop_named(docs, (score_col, predicted_col))
    schema = extended(base.schema, f"`{score_col}` double, `{predicted_col}` int")
    at = base.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_features(t.as_py()) for t in batch.column(at)]
            score = model.score(np.array(rows, dtype=np.float64).reshape(len(rows), len(FEATURES)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=schema.names
            )

    return base.mapInArrow(run, schema)


def held_out(id_col: str, folds: int = 5) -> Column:
    """Whether a row is kept from training: its id's crc32 is divisible by ``folds``. A NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds == 0, F.lit(False))
