"""Language identification by a string kernel: Nyström landmarks and one-versus-rest kernel ridge regression.

The kernel is the blended-spectrum presence kernel: the number of distinct n-grams of 1 to ``longest`` UTF-16 units that two texts
share, divided by the root of the product of their own numbers. Texts are lower-cased, and whatever is no letter or mark becomes one space, so
n-grams see where words begin and end.

A bounded sample of labelled texts is drawn, some of it as landmarks. A text's kernel values against the landmarks, mapped by the inverse root of the
landmarks' own kernel matrix (Nyström), are its features, and ridge regression on +1 and -1 per language gives the weights. Scoring needs no shuffle: a
batch of texts is a 0/1 matrix over the landmarks' n-grams, its product with the landmarks' 0/1 matrix holds all shared
counts, and a second product gives the value of every language.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.llm.common import drop_named, extended, process_cache, stored

UNDETERMINED = "und"
SPACE = 32
SLICE = 1 << 18  # units whose n-grams are sorted at once
MATRIX_BYTES = 16 << 20


def _folding() -> np.ndarray:
    """By UTF-16 unit: the lower-cased letter, a mark, or a space. Halves of pairs stay."""
    table = np.full(1 << 16, SPACE, np.uint16)
    table[0xD800:0xE000] = np.arange(0xD800, 0xE000)
    for unit in [*range(0xD800), *range(0xE000, 1 << 16)]:
        if unicodedata.category(chr(unit))[0] in "LM":
            low = chr(unit).lower()
            table[unit] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else unit
    return table


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def grams_of(text: str | None, longest: int) -> np.ndarray:
    """Distinct n-grams of a whole text, sorted. An n-gram is its units in one number; shorter ones have zeros in front."""
    if not text:
        return np.zeros(0, np.uint64)
    raw = text.encode("utf-16-le")
    if len(raw) > 2 * len(text):  # pairs of units, which are letters only in part
        raw = "".join(c if c < "\U00010000" or c.isalpha() else " " for c in text).encode("utf-16-le")
    fold = process_cache("language_folding", _folding)
    units = fold[np.frombuffer(raw, "<u2")]
    space = units == SPACE
    kept = units[~(space & np.concatenate([[True], space[:-1]]))]
    if not len(kept):
        return np.zeros(0, np.uint64)
    if kept[-1] == SPACE:
        kept = kept[:-1]
    kept = np.concatenate([[SPACE], kept, [SPACE]]).astype(np.uint64)
    found = np.zeros(0, np.uint64)
    for at in range(0, len(kept), SLICE):
        part = kept[at : at + SLICE + longest - 1]
        code, codes = part, [part]
        for n in range(1, longest):
            code = (code[:-1] << np.uint64(16)) | part[n:]
            codes.append(code)
        every = np.sort(np.concatenate(codes))
        every = every[np.concatenate([[True], every[1:] != every[:-1]])]
        found = every if at == 0 else np.union1d(found, every)
    return found[found != SPACE]


@dataclass(frozen=True)
class Landmarks:
    """Texts as columns of a 0/1 matrix over all their n-grams, the rows in packed bits."""

    grams: np.ndarray
    bits: np.ndarray
    sizes: np.ndarray
    longest: int

    @classmethod
    def of(cls, texts: list[np.ndarray], longest: int) -> Landmarks:
        grams = np.unique(np.concatenate([np.zeros(0, np.uint64), *texts]))
        present = np.zeros((len(grams), len(texts)), bool)
        for column, text in enumerate(texts):
            present[np.searchsorted(grams, text), column] = True
        return cls(grams, np.packbits(present, axis=1), np.array([len(t) for t in texts], np.float64), longest)

    def matrix(self) -> np.ndarray:
        return np.unpackbits(self.bits, axis=1, count=len(self.sizes)).astype(np.float32)

    def kernel(self, texts: list[np.ndarray], matrix: np.ndarray) -> np.ndarray:
        """Kernel values of texts (their n-grams) against the landmarks, a block of texts per matrix product."""
        out = np.zeros((len(texts), len(self.sizes)))
        step = max(1, MATRIX_BYTES // (4 * max(1, len(self.grams))))
        for at in range(0, len(texts), step):
            some = texts[at : at + step]
            present = np.zeros((len(some), len(self.grams)), np.float32)
            for row, text in enumerate(some):
                place = np.searchsorted(self.grams, text)
                place[place == len(self.grams)] = 0
                present[row, place[self.grams[place] == text]] = 1
            sizes = np.array([max(1, len(t)) for t in some], np.float64)
            out[at : at + step] = (present @ matrix) / np.sqrt(np.outer(sizes, np.maximum(self.sizes, 1)))
        return out


@dataclass(frozen=True)
class LanguageModel:
    """Landmarks, and per language one column of weights over the kernel values (the last row is added to all)."""

    landmarks: Landmarks
    languages: tuple[str, ...]
    weights: np.ndarray

    def values(self, texts: list[np.ndarray], matrix: np.ndarray) -> np.ndarray:
        return self.landmarks.kernel(texts, matrix) @ self.weights[:-1] + self.weights[-1]


def ridge(kernel: np.ndarray, own: np.ndarray, targets: np.ndarray, penalty: float) -> np.ndarray:
    """Weights over kernel values (and a last row, the mean) of ridge regression on the Nyström features of ``kernel``."""
    value, vector = np.linalg.eigh(own)
    keep = value > 1e-6 * max(value.max(), 1e-12)
    root = vector[:, keep] / np.sqrt(value[keep])
    features = kernel @ root
    middle, mean = features.mean(0), targets.mean(0)
    x, y = features - middle, targets - mean
    solved = np.linalg.solve(x.T @ x + penalty * np.eye(x.shape[1]), x.T @ y)
    return np.vstack([root @ solved, mean - middle @ solved])


def _sample(
    docs: DataFrame, id_col: str, text_col: str, lang_col: str, languages: int, texts: int, chars: int
) -> DataFrame:
    """``lang``, ``place``, ``text``: up to ``texts`` ids of each of the ``languages`` commonest languages, by a hash of the id.

    Of a repeated id one text counts, the smallest.
    """
    ids = docs.select(F.xxhash64(f"`{id_col}`").alias("at"), F.col(f"`{lang_col}`").cast("string").alias("lang")).dropna()
    size = ids.groupBy("lang").agg(F.count("*").alias("rows"), F.approx_count_distinct("at").alias("ids"))
    common = size.orderBy(F.desc("rows"), "lang").limit(languages)
    # Hashes are spread evenly: a few times the ids wanted are left of each language, whatever its size, and ranked.
    share = F.pmod("at", F.lit(1 << 31)) / float(1 << 31)
    few = ids.join(F.broadcast(common), "lang").where(share * F.col("ids") < 8 * texts).select("lang", "at").distinct()
    picked = few.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("at")))
    picked = picked.where(F.col("place") <= texts)  # decided on two narrow columns; texts are read for these rows only
    found = docs.select(
        F.xxhash64(f"`{id_col}`").alias("at"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    ).join(F.broadcast(picked), ["at", "lang"])  # at most languages times texts rows
    usable = found.where((F.length("text") <= chars) & F.col("text").rlike(r"\p{L}"))
    return usable.groupBy("lang", "place").agg(F.min("text").alias("text"))


def fit_language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", longest: int = 3, languages: int = 64,
    texts: int = 400, landmarks: int = 256, chars: int = 100_000, penalty: float = 0.1,
) -> LanguageModel:
    """Learn from a bounded sample: at most ``texts`` texts, of ``chars`` characters at most, of each of the ``languages`` commonest
    languages; the first ``landmarks`` of them, dealt over the languages, are the landmarks.

    Rows without id, text, letters or language are not used. No usable row: a model that knows no language. The driver receives the
    landmarks' n-grams and one row of kernel values per sampled text.
    """
    if not 1 <= longest <= 4:
        raise ValueError("an n-gram of more than four units does not fit a long")
    known = docs.where(F.col(f"`{id_col}`").isNotNull())
    sample = stored(_sample(known, id_col, text_col, lang_col, languages, texts, chars), "language-sample")
    chosen = sample.orderBy("place", "lang").limit(landmarks).select("text").collect()
    marks = Landmarks.of([grams_of(r["text"], longest) for r in chosen], longest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = marks.matrix()
        for batch in batches:
            values = marks.kernel([grams_of(t.as_py(), longest) for t in batch.column(1)], matrix)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(values), pa.list_(pa.float64()))], names=["lang", "kernel"]
            )

    rows = sample.select("lang", "text").mapInArrow(run, "lang string, kernel array<double>").toArrow()
    names = tuple(sorted(set(rows.column("lang").to_pylist())))
    if not names:
        return LanguageModel(marks, (), np.zeros((1, 0)))
    kernel = rows.column("kernel").combine_chunks().values.to_numpy().reshape(rows.num_rows, -1)
    lang = np.array(rows.column("lang").to_pylist())
    matrix = marks.matrix()
    own = matrix.T.astype(np.float64) @ matrix / np.sqrt(np.outer(marks.sizes, marks.sizes))
    targets = np.where(lang[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # Rows in a fixed order, so that the sums do not depend on the tasks.
    order = np.lexsort((*kernel.T[:8], lang))
    return LanguageModel(marks, names, ridge(kernel[order], own, targets[order], penalty))


def predict_language(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score"
) -> DataFrame:
    """All columns and rows of ``docs`` with the predicted language of the whole text and its score.

    The score is the regression's value for that language, brought from -1..1 to 0..1 and cut there. A NULL text, one without
    letters, and every text under a model that knows no language are ``und`` with score 0. Equal values: the first language by name.
    Columns of the added names are replaced.
    """
    base = drop_named(docs, (lang_col, score_col))
    schema = extended(base.schema, f"`{lang_col}` string, `{score_col}` double")
    at = base.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = model.landmarks.matrix()
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                texts = [t.as_py() for t in batch.column(at).cast(pa.string())]
                known = np.array([bool(model.languages) and has_letter(t) for t in texts], bool)
                lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                rows = np.flatnonzero(known)
                if len(rows):
                    values = model.values([grams_of(texts[r], model.landmarks.longest) for r in rows], matrix)
                    best = values.argmax(1)
                    score[rows] = np.clip((values[np.arange(len(rows)), best] + 1) / 2, 0, 1)
                    for r, b in zip(rows, best, strict=True):
                        lang[r] = model.languages[b]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(lang, pa.string()), pa.array(score)], names=schema.names
                )

    return base.mapInArrow(run, schema)


def held_out(id_col: str, folds: int = 3, fold: int = 1) -> Column:
    """Whether a row is kept from learning: its id's crc32 modulo ``folds`` is ``fold``. A NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds == fold, F.lit(False))
