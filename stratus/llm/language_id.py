"""Language ID: sparse multinomial logistic regression on TF-IDF character
n-grams, trained by follow-the-regularised-leader with elastic net, calibrated
by a temperature.

Features are the 1- to 3-grams of the lower-cased text's letters (anything else
is one blank), hashed into ``DIM`` columns.  Document frequencies are counted
over all documents that may be learned from (a text, a language, and crc32 of
the id's digits mod 4 other than 2).  The weights are fitted on a sample of
these of about ``PER_LANGUAGE`` documents a language, drawn by a hash of the id;
a fifth of the sample is kept back to choose the temperature.  Prediction reads
every whole text and nothing else: language, source and id are not inputs.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text if nothing can be learned from; a null id is not held out and
not learned from; repeated rows are predicted alike; an empty table gives no
rows; carried columns keep their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import bounded_batches, mix

DIM_BITS, ORDERS = 15, (1, 2, 3)
DIM = 1 << DIM_BITS
#: Expected number of sampled documents a language.
PER_LANGUAGE = 600
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.02, 0.001, 4
UNKNOWN = "und"
#: N-grams hashed at a time: bounds the working arrays of a long text.
_STRETCH = 1 << 17


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    points = np.arange(0x110000, dtype=np.uint32)
    points[0xD800:0xE000] = 32
    return np.char.isalpha(points.view("<U1"))


def gram_counts(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Counts of the hashed n-grams, or None if there is no letter.  Long texts
    are read in stretches that overlap by two code points."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    known = letters[points]
    if not known.any():
        return None
    keep = known.copy()
    keep[1:] |= known[:-1]
    blank = np.array([32], np.uint32)
    points = np.concatenate([blank, np.where(known, points, blank)[keep], blank])
    counts = np.zeros(DIM, np.int64)
    overlap = max(ORDERS) - 1
    with np.errstate(over="ignore"):
        for lo in range(0, len(points), _STRETCH):
            part = points[lo:lo + _STRETCH + overlap].astype(np.uint64)
            for order in ORDERS:
                n = min(len(part) - order + 1, _STRETCH)
                if n <= 0:
                    continue
                h = np.full(n, np.uint64(order))
                for k in range(order):
                    h = h * np.uint64(0x100000001B3) + part[k:k + n]
                counts += np.bincount((mix(h) >> np.uint64(64 - DIM_BITS)).astype(np.int64), minlength=DIM)
    return counts


def weigh(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF vector of length one, as columns and values."""
    at = np.flatnonzero(counts)
    v = (1 + np.log(counts[at])) * idf[at]
    return at, v / np.linalg.norm(v)


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters, seen, docs = letter_table(), np.zeros(DIM, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            counts = gram_counts(text.as_py() or "", letters)
            if counts is not None:
                seen += counts > 0
                docs += 1
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[at], docs))],
                                     names=["feature", "n"])


def _vectors(batches: Iterator[pa.RecordBatch], idf) -> Iterator[pa.RecordBatch]:
    letters, idf = letter_table(), idf.value
    for batch in batches:
        for row in range(batch.num_rows):
            counts = gram_counts(batch.column(2)[row].as_py() or "", letters)
            if counts is not None:
                at, v = weigh(counts, idf)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1), batch.column(1).slice(row, 1),
                     pa.array([at.astype(np.int32).tobytes()]), pa.array([v.astype(np.float32).tobytes()])],
                    names=["doc_id", "lang", "at", "v"])


class FtrlSoftmax:
    """Multinomial logistic regression by per-coordinate FTRL-proximal steps."""

    def __init__(self, classes: int, dim: int = DIM):
        self.z, self.n = np.zeros((dim, classes)), np.zeros((dim, classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, v: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(v @ w)
        p[label] -= 1
        g = v[:, None] * p[None, :]
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit(sample: list[tuple], classes: list[str]) -> tuple[np.ndarray, float]:
    """Weights and temperature from (doc_id, lang, columns, values) rows, the
    last two as packed 32-bit numbers."""
    sample = sorted(sample, key=lambda r: (mix(np.array([r[0]], np.int64).view(np.uint64))[0], *map(bytes, (r[1].encode(), *r[2:]))))
    rows = [(np.frombuffer(a, np.int32), np.frombuffer(v, np.float32).astype(np.float64), classes.index(c)) for _, c, a, v in sample]
    kept_back = rows[::5] if len(rows) >= 10 else []
    learned = [r for k, r in enumerate(rows) if k % 5] if kept_back else rows
    model = FtrlSoftmax(len(classes))
    for _ in range(EPOCHS):
        for a, v, c in learned:
            model.learn(a, v, c)
    w = model.weights()
    if not kept_back:
        return w, 1.0
    scores = [(v @ w[a], c) for a, v, c in kept_back]

    # Smoothed targets keep the temperature finite where no document is missed.
    slip = 1 / (len(scores) + 2) / len(classes)

    def loss(t: float) -> float:
        logs = [(np.log(np.maximum(softmax(s / t), 1e-12)), c) for s, c in scores]
        return -sum((1 - slip * len(classes)) * p[c] + slip * p.sum() for p, c in logs)

    return w, float(min(np.geomspace(0.05, 5, 61), key=loss))


def _predictor(model):
    """Column function of a text: lang_pred and score.  Only the texts go to
    Python and only these two come back; the rows stay where they are."""
    @F.arrow_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        classes, weights, idf, temperature = model.value
        letters = letter_table()
        for batch in batches:
            names, scores = [], []
            for text in batch:
                counts = gram_counts(text.as_py() or "", letters) if classes else None
                if counts is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                at, v = weigh(counts, idf)
                p = softmax(v @ weights[at] / temperature)
                names.append(classes[int(p.argmax())])
                scores.append(float(p.max()))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=["lang_pred", "score"])
        pa.default_memory_pool().release_unused()

    return predicted


def train(docs: DataFrame, per_language: int = PER_LANGUAGE):
    """(classes, weights, idf, temperature) from the documents to learn from."""
    spark = docs.sparkSession
    learnable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").where(
        "doc_id is not null and lang is not null and text is not null").where(~held_out(F.col("doc_id")))
    frequency = dict(learnable.select("text").mapInArrow(_document_frequency, "feature long, n long")
                     .groupBy("feature").agg(F.sum("n")).collect())  # at most DIM + 1 rows
    total = frequency.pop(-1, 0) or 0
    df = np.zeros(DIM)
    df[list(frequency)] = list(frequency.values())
    idf = np.log((1 + total) / (1 + df)) + 1
    held = spark.sparkContext.broadcast(idf)
    counts = learnable.groupBy("lang").count()
    drawn = (learnable.join(F.broadcast(counts), "lang").where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < F.lit(float(per_language << 40)) / F.col("count"))
        .select("doc_id", "lang", "text"))
    sample = [tuple(r) for r in drawn.mapInArrow(
        lambda it: _vectors(it, held), "doc_id long, lang string, at binary, v binary").collect()]
    classes = sorted({r[1] for r in sample})
    if not classes:
        return [], np.zeros((DIM, 0)), idf, 1.0
    weights, temperature = fit(sample, classes)
    return classes, weights, idf, temperature


def predict(docs: DataFrame, model, text_col: str = "text"):
    """A column of ``docs``: struct of lang_pred and score."""
    spark = docs.sparkSession
    bounded_batches(spark)
    return _predictor(spark.sparkContext.broadcast(model))(F.col(f"`{text_col}`"))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    out = docs.select("doc_id", predict(docs, train(docs)).alias("found"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "found.lang_pred", "found.score")


def known_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` without those whose language is unknown or unsure."""
    found = predict(docs, train(docs))
    return docs.where((found["lang_pred"] != UNKNOWN) & (found["score"] >= least))
