"""Language identification with hyperdimensional profiles.

Every letter symbol has a random vector of +1 and -1. The vector of three symbols in a row is the product of their
vectors, the first shifted by two places and the second by one. A text's vector is the sum of its trigram vectors; a
language's prototype is the sum over its training texts, each weighted by the inverse of its number of trigrams. A text
gets the language whose prototype has the largest cosine with it; the cosine, at least 0, is its score.

Symbols are a word boundary and every letter by itself, of any script. A letter's vector is generated from a hash of the
letter where it is needed, so there is no table of them. Sums are taken over whole numbers, so results do not depend on the order of rows or partitions.

A text that is null or has no letter is ``und`` with score 0, and so is every text when there is nothing to learn from.
Rows with a null label or text do not train. More than ``MAX_LABELS`` labels are refused: the column is not a language
then, and one prototype per label would not be bounded. Ties go to the label that sorts first. Repeated rows count each. Extra columns
do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import column, ship, sub_batches
from changeflow.llm.ngram_join import MIX, mixed

DIMENSIONS = 1024
PLAIN = 1 + 26  # symbols of a boundary and a-z; other letters are their code points, which are larger
GROUPS = (0, 6, 12)  # 6-bit groups of a symbol, enough for code points of letters (below 1 << 18)
UNIT = 1 << 20
MAX_LABELS = 4096
CODES_AT_ONCE = 2048
TEXTS_AT_ONCE = 100
# Trigrams whose weights a task holds before it bundles them, and trigram vectors a worker keeps (4 kB each).
HELD_CODES = 400_000
KEPT_VECTORS = 12_288
UNDEFINED = "und"
CLEAR = 0.5
NOISE = 4.5
SEED = 20_240_101

_tables: dict[str, np.ndarray] = {}


def _symbols() -> np.ndarray:
    """Symbol of every code point, its groups of 6 bits 18 bits apart: three symbols fit in one code, 6 bits shifted."""
    if "symbols" not in _tables:
        symbols = np.zeros(0x110000, np.int64)
        points = np.fromiter((p for p in range(1 << 18) if chr(p).isalpha()), np.int64)  # no letters lie above
        symbols[points] = points
        symbols[ord("a") : ord("z") + 1] = np.arange(1, PLAIN)
        _tables["symbols"] = sum(((symbols >> g) & 63) << 3 * g for g in GROUPS)
    return _tables["symbols"]


def letter_vectors(symbols: np.ndarray) -> np.ndarray:
    """The vector of +1 and -1 of each symbol."""
    words = symbols.astype(np.uint64)[:, None] * np.uint64(DIMENSIONS // 64) + np.arange(DIMENSIONS // 64, dtype=np.uint64)
    bits = mixed((words + np.uint64(SEED)) * MIX[0]).astype("<u8").view(np.uint8)
    return np.unpackbits(bits, axis=1).astype(np.float32) * 2 - 1


def _letters() -> np.ndarray:
    """Vectors of the boundary and of a-z."""
    return letter_vectors(np.arange(PLAIN))


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    parts = [sum(((codes >> (place + 3 * g)) & 63) << g for g in GROUPS) for place in (12, 6, 0)]
    symbols, at = np.unique(np.concatenate(parts), return_inverse=True)
    first, second, third = at.reshape(3, -1)
    letters = letter_vectors(symbols)
    return np.roll(letters, 2, axis=1)[first] * np.roll(letters, 1, axis=1)[second] * letters[third]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Row and code of every trigram of a batch; texts without letters have none."""
    lowered = [(t or "").lower() for t in texts]
    # A boundary before and behind each text.
    joined = np.frombuffer(("\n" + "\n\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 2
    rows = np.repeat(np.arange(len(texts)), sizes)
    symbols = _symbols()[joined]
    # Runs of boundaries within a text count once.
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] > 0) | (symbols[:-1] > 0) | (rows[1:] != rows[:-1])
    rows, symbols = rows[keep], symbols[keep]
    codes = (symbols[:-2] << 12) | (symbols[1:-1] << 6) | symbols[2:]
    inside = rows[:-2] == rows[2:]
    return rows[:-2][inside], codes[inside]


def _merge(held: dict[str, list]) -> int:
    """Add up what is held per label; the number of trigrams left."""
    for name, parts in held.items():
        codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        held[name] = [(codes, np.bincount(at, weights=np.concatenate([w for _, w in parts]), minlength=len(codes)))]
    return sum(len(c) for parts in held.values() for c, _ in parts)


def _bundle(held: dict[str, list], sums: dict[str, np.ndarray]) -> None:
    """Add the vectors of all held trigrams, times their weights, to the labels' sums, and let go of them.

    Weights and sums are whole numbers below 2^53, so the order of additions does not matter. The weight stands behind
    the vector, as one more place.
    """
    for name, ((codes, weights),) in held.items():
        vector = np.zeros(DIMENSIONS)
        for start in range(0, len(codes), CODES_AT_ONCE):
            some = slice(start, start + CODES_AT_ONCE)
            vector += weights[some] @ trigram_vectors(codes[some]).astype(np.float64)
        whole = np.rint(np.append(vector, weights.sum())).astype(np.int64)
        sums[name] = sums.get(name, 0) + whole
    held.clear()


class Vectors:
    """Trigram vectors that a worker has built, one row each; a full store is emptied."""

    def __init__(self) -> None:
        self.rows, self.place, self.used = np.zeros((KEPT_VECTORS, DIMENSIONS), np.float32), {}, 0

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        if len(codes) > KEPT_VECTORS:
            return trigram_vectors(codes)
        listed = codes.tolist()
        new = [c for c in listed if c not in self.place]
        if self.used + len(new) > KEPT_VECTORS:
            self.place, self.used, new = {}, 0, listed
        for start in range(0, len(new), CODES_AT_ONCE):
            some = new[start : start + CODES_AT_ONCE]
            self.rows[self.used : self.used + len(some)] = trigram_vectors(np.asarray(some, np.int64))
            self.place.update(zip(some, range(self.used, self.used + len(some)), strict=True))
            self.used += len(some)
        return self.rows[np.fromiter(map(self.place.__getitem__, listed), np.int64, len(listed))]


def forget_vectors() -> None:
    """Let go of the vectors at the end of a task, as workers live on through later stages."""
    _tables.pop("kept", None)


def kept_vectors(codes: np.ndarray) -> np.ndarray:
    if "kept" not in _tables:
        _tables["kept"] = Vectors()
    return _tables["kept"](codes)


def prototypes(docs: DataFrame, label: Column, text_col: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Labels in order, their summed vectors and weights of trigrams, learned from all rows with a label and a text."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held, size = {}, {}, 0
        for batch in sub_batches(batches, 2 << 20):
            labels = column(batch, "_label").to_pylist()
            rows, codes = trigrams(column(batch, "_text").to_pylist())
            weight = UNIT // np.maximum(np.bincount(rows, minlength=len(labels)), 1)
            names, of_row = np.unique(np.asarray(labels, object), return_inverse=True)
            for k, name in enumerate(names.tolist()):
                own = of_row[rows] == k
                used, code = np.unique(codes[own], return_inverse=True)
                held.setdefault(name, []).append((used, np.bincount(code, weights=weight[rows[own]], minlength=len(used))))
                size += len(used)
            if size > HELD_CODES:
                size = _merge(held)
                if size > HELD_CODES // 2:
                    _bundle(held, sums)
                    size = 0
        _merge(held)
        _bundle(held, sums)
        for name, vector in sums.items():
            place = pa.array(np.arange(DIMENSIONS + 1, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(place)), place, pa.array(vector)], ["label", "k", "v"])

    learned = docs.select(label.cast("string").alias("_label"), docs[text_col].alias("_text")).where(
        F.col("_label").isNotNull() & F.col("_text").isNotNull()
    )
    sums = learned.mapInArrow(bundle, "label string, k int, v long").groupBy("label", "k").agg(F.sum("v").alias("v"))
    # One vector per label; more labels than that are not languages.
    per_label = sums.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("vs"))
    found = per_label.select("label", F.col("vs.v").alias("vector")).orderBy("label").limit(MAX_LABELS + 1).collect()
    if len(found) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    vectors = np.asarray([r.vector for r in found], np.float64).reshape(-1, DIMENSIONS + 1)
    return [r.label for r in found], vectors[:, :-1], vectors[:, -1]


def identify_batch(texts: list[str | None], names: list[str], units: np.ndarray) -> tuple[list[str], np.ndarray]:
    found, score, _ = compare_batch(texts, names, units)
    return found, score


def compare_batch(
    texts: list[str | None], names: list[str], units: np.ndarray
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language and score of each text, and how many trigrams it is worth: n, less when the same ones repeat."""
    rows, codes = trigrams(texts)
    used, code = np.unique(codes, return_inverse=True)
    dots, square = np.zeros((len(texts), len(names))), np.zeros(len(texts))
    if len(used) and names:
        vectors = np.zeros((len(texts), DIMENSIONS), np.float32)
        # Texts of very many different trigrams are taken in parts; the counts of a part are one matrix.
        order = np.argsort(code, kind="stable") if len(used) > KEPT_VECTORS else None
        for start in range(0, len(used), KEPT_VECTORS):
            some = used[start : start + KEPT_VECTORS]
            if order is None:
                row, place = rows, code
            else:
                low, high = np.searchsorted(code, [start, start + len(some)], sorter=order)
                row, place = rows[order[low:high]], code[order[low:high]] - start
            counts = np.bincount(row * len(some) + place, minlength=len(texts) * len(some))
            vectors += counts.reshape(len(texts), len(some)).astype(np.float32) @ kept_vectors(some)
        vectors = vectors.astype(np.float64)
        dots, square = vectors @ units.T, np.einsum("ij,ij->i", vectors, vectors)
    total = np.bincount(rows, minlength=len(texts))
    empty = (total == 0) | (square == 0)
    # The square of a text's vector is about DIMENSIONS times the sum of squared counts of its trigrams.
    worth = np.where(empty, 0.0, total.astype(float) ** 2 * DIMENSIONS / np.where(empty, 1, square))
    if not names:
        return [UNDEFINED] * len(texts), np.zeros(len(texts)), worth
    best = np.argmax(np.round(dots, 6), axis=1)
    cosine = dots[np.arange(len(texts)), best] / np.sqrt(np.where(empty, 1, square))
    score = np.where(empty, 0.0, np.clip(cosine, 0.0, 1.0))
    return [UNDEFINED if e else names[b] for e, b in zip(empty.tolist(), best.tolist(), strict=True)], score, worth


def unlike_all(score: np.ndarray, worth: np.ndarray, spread: float) -> np.ndarray:
    """Whether texts are clearly in none of the languages.

    A text of a language has a cosine of about sqrt(worth * share) with its profile, ``share`` being the chance that two
    trigrams of the language are equal; ``spread`` is the least share of all profiles. Where that is ``CLEAR`` or more,
    a cosine within ``NOISE`` standard deviations of that of unrelated vectors tells that the text is of another kind.
    Shorter texts may lack the common trigrams by chance, and are not judged.
    """
    return (worth * spread >= CLEAR**2) & (score < NOISE / DIMENSIONS**0.5)


def _shared_model(docs: DataFrame, train: DataFrame, text_col: str, label_col: str):
    ship(docs.sparkSession)
    names, vectors, _ = prototypes(train, train[label_col], text_col)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True) if names else np.ones((0, 1))
    return docs.sparkSession.sparkContext.broadcast((names, vectors / np.where(norms == 0, 1, norms)))


def keep_identified(docs: DataFrame, text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that may be of a known language: not ``und`` and not ``unlike_all`` profiles.

    All labelled rows train. Rows keep all their columns and do not move between partitions.
    """
    ship(docs.sparkSession)
    names, vectors, weights = prototypes(docs, docs[label_col], text_col)
    squares = np.einsum("ij,ij->i", vectors, vectors)
    units = vectors / np.sqrt(np.where(squares == 0, 1, squares))[:, None]
    # The square of a prototype is about DIMENSIONS times the sum of its trigrams' squared weights.
    shares = squares[weights > 0] / DIMENSIONS / weights[weights > 0] ** 2
    shared = docs.sparkSession.sparkContext.broadcast((names, units, float(shares.min()) if len(shares) else 0.0))

    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 2 << 20):
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(start, TEXTS_AT_ONCE)
                names, units, spread = shared.value
                found, score, worth = compare_batch(column(part, text_col).to_pylist(), names, units)
                unlike = unlike_all(score, worth, spread).tolist()
                good = [f != UNDEFINED and not u for f, u in zip(found, unlike, strict=True)]
                yield part.filter(pa.array(good, pa.bool_()))
        forget_vectors()

    return docs.mapInArrow(accept, docs.schema)


def identify(
    docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang"
) -> DataFrame:
    """All columns of ``docs`` reduced to (id, held_out, lang_pred, score), plus the row's text hash ``row_key``.

    Rows for which ``held_out`` is true do not train. Labels and ids are never inputs of a prediction.
    """
    shared = _shared_model(docs, docs.where(~held_out), text_col, label_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 2 << 20):
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(start, TEXTS_AT_ONCE)
                found, score = identify_batch(column(part, "_text").to_pylist(), *shared.value)
                arrays = [column(part, c) for c in ("_id", "_held", "row_key")]
                arrays += [pa.array(found, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(arrays, [id_col, "held_out", "row_key", "lang_pred", "score"])
        forget_vectors()

    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("row_key", T.LongType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    rows = docs.select(
        docs[id_col].alias("_id"),
        held_out.alias("_held"),
        F.xxhash64(docs[text_col]).alias("row_key"),
        docs[text_col].alias("_text"),
    )
    return rows.mapInArrow(predict, schema)
