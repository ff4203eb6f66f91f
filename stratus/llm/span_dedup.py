"""Substring dedup by sliding sentence spans.

A sentence ends with ``.``, ``!`` or ``?`` before white space, with a newline,
or with the text.  From every sentence the shortest run of consecutive sentences
that follows it, and the shortest that ends with it, are hashed if they hold at
least two sentences and 20 words (one sentence of 50 words is a run by itself).
A repeated passage of that size is covered by such runs from its first to its
last sentence, wherever it stands.  The hashes are joined over all documents;
sentences covered by any run that is not the first of its kind (by document id,
then place) are removed.

Words are compared in lower case (A-Z) without ASCII punctuation, by 64-bit
hashes of whole runs.  The count and first place of every hash are aggregated
before the shuffle, so a passage that a third of all documents share costs one
row a task.

Defined cases: a null text stays null and has no sentences; empty texts stay;
rows equal in id and text count as one document and are treated alike; a null
id sorts first; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import byte_table, hash_words, mix, text_chunks, written

MIN_WORDS, MIN_SENTENCES, ALONE = 20, 2, 50
_WORDS = byte_table(bytes(b for b in range(128) if not chr(b).isalnum()))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_QINV = np.uint64(pow(int(_Q), -1, 1 << 64))


def sentences(data: np.ndarray, starts: np.ndarray):
    """Of documents back to back: per sentence with words its document, first
    and last byte (end exclusive) and words; a hash for any run of them."""
    n = len(data)
    stop = np.isin(data, np.frombuffer(b".!?", np.uint8))
    last = np.ones(n, bool)
    last[:-1] = _SPACE[data[1:]]
    ends = stop & last | (data == 10)
    ends[starts[starts > 0] - 1] = True  # a text's end ends its sentence
    if n:
        ends[-1] = True
    ends = np.flatnonzero(ends) + 1
    begin, _, h, _ = hash_words(data, starts, _WORDS)
    own = np.searchsorted(ends, begin, side="right")  # the piece each word is in
    pieces, first = np.unique(own, return_index=True)
    stop_at = ends[pieces]
    start_at = np.where(pieces > 0, ends[pieces - 1], 0)
    doc = np.searchsorted(starts, start_at, side="right") - 1
    with np.errstate(over="ignore"):
        q = np.full(len(h) + 1, _Q)
        q[0] = 1
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * np.cumprod(q)[:-1], out=total[1:])
        q[1:] = _QINV
        inverse = np.cumprod(q)
    first = np.append(first, len(h))

    def run_hash(i, j):
        a, b = first[i], first[j]
        with np.errstate(over="ignore"):
            return mix((total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64))

    return doc, start_at, stop_at, first, run_hash


def spans(doc: np.ndarray, first: np.ndarray, min_words: int, min_sentences: int, alone: int):
    """(i, j) of the runs, as indices of sentences (j exclusive)."""
    k = len(doc)
    if not k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(k)
    doc_end = np.searchsorted(doc, doc, side="right")
    doc_start = np.searchsorted(doc, doc, side="left")
    forward = np.maximum(np.searchsorted(first, first[:-1] + min_words, side="left"), at + min_sentences)
    backward = np.minimum(np.searchsorted(first, first[1:] - min_words, side="right") - 1, at + 1 - min_sentences)
    ok, back = forward <= doc_end, backward >= doc_start
    single = np.diff(first) >= alone
    i = np.concatenate([at[ok], backward[back], at[single]])
    j = np.concatenate([forward[ok], at[back] + 1, at[single] + 1])
    pairs = np.unique(np.stack([i, j], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _runs(batches: Iterator[pa.RecordBatch], rule: tuple) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, _, data, starts in text_chunks(batch.column(2)):
            doc, _, _, first, run_hash = sentences(data, starts)
            i, j = spans(doc, first, *rule)
            if not len(i):
                continue
            base = np.searchsorted(doc, doc[i])  # first sentence of the document
            rows = pa.array(lo + doc[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(run_hash(i, j).view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array((i - base).astype(np.int32)), pa.array((j - base).astype(np.int32))],
                names=["h", "doc_id", "content", "i", "j"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, texts = [], [], []
        ranges = batch.column(2)
        for lo, hi, data, starts in text_chunks(batch.column(1)):
            doc, begin, end, _, _ = sentences(data, starts)
            edges = np.searchsorted(doc, np.arange(hi - lo + 1))
            for k in range(hi - lo):
                a, b = edges[k], edges[k + 1]
                whole = batch.column(1)[lo + k]
                drop = ranges[lo + k].as_py() or []
                gone = np.zeros(b - a, bool)
                for r in drop:
                    gone[r["i"]:r["j"]] = True
                counts.append(int(b - a))
                removed.append(int(gone.sum()))
                if not gone.any():
                    texts.append(whole.as_py())
                    continue
                parts, at = [], starts[k]
                for s in np.flatnonzero(gone):
                    parts.append(data[at:begin[a + s]])
                    at = end[a + s]
                parts.append(data[at:starts[k + 1] if k + 1 < hi - lo else len(data)])
                texts.append(np.concatenate(parts).tobytes().decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
            names=["doc_id", "n_sentences", "n_removed", "text"])


def remove_repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, min_sentences: int = MIN_SENTENCES,
                          alone: int = ALONE) -> DataFrame:
    """doc_id, n_sentences, n_removed and the text without repeated spans."""
    rule = (min_words, min_sentences, alone)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("content"), "text")
    runs = docs.mapInArrow(lambda it: _runs(it, rule), "h long, doc_id long, content long, i int, j int")
    # A run repeats if its first and last places differ.  The table is written,
    # so that both sides of the join are plain exchanges and a hot run is split.
    first = runs.groupBy("h").agg(F.min(F.struct("doc_id", "content", "i")).alias("first"),
                                  F.max(F.struct("doc_id", "content", "i")).alias("final")).where("first <> final")
    later = (runs.join(written(first.select("h", "first"), "first"), "h")
             .where(F.struct("doc_id", "content", "i") != F.col("first"))
             .groupBy("doc_id", "content").agg(F.collect_set(F.struct("i", "j")).alias("ranges")))
    later = later.select(F.col("doc_id").alias("id"), F.col("content").alias("same"), "ranges")
    held = docs.join(later, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("content") == F.col("same")), "left")
    return held.select("doc_id", "text", "ranges").mapInArrow(
        _cut, "doc_id long, n_sentences long, n_removed long, text string")
