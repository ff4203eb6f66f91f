"""Shared pieces of the training-data operators: table reading, scratch
tables, vectorised word hashing over Arrow text, connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.session import scratch_path

#: ASCII white space: \x20 and \x09-\x0D.
SPACE_CLASS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back:
    lineage is cut and a lost executor costs nothing that was computed."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int, persist: bool = True) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows (counted
    first), unchanged (a shuffled join) beyond that.  ``df`` must be narrow:
    the row bound is then a byte bound."""
    return F.broadcast(df) if df.count() <= max_rows else df


def small_bytes(df: DataFrame, strings: list[str], max_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its rows, at 32 bytes each, and the bytes
    of its ``strings`` make at most ``max_bytes`` (summed first), unchanged (a
    shuffled join) beyond that."""
    size = F.lit(32)
    for c in strings:
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= max_bytes else df


#: Share of all rows beyond which a key counts as hot.
HOT_SHARE = 4096


def split_join(rows: DataFrame, facts: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """``rows`` left-joined with ``facts``, one row a key whose ``weight`` says
    how many rows have it.  Keys that hold more than 1/4096 of all rows, so fewer
    than 4096, are broadcast; the others are shuffled, and none of them is hot.
    Both sides are read twice: hand over written tables."""
    total = facts.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT_SHARE > total
    first = rows.join(F.broadcast(facts.where(hot)), keys, "left")
    return first.where(F.col(weight).isNotNull()).unionByName(
        first.where(F.col(weight).isNull()).select(*rows.columns).join(facts.where(~hot), keys, "left"))


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Smaller Arrow batches for the session's Python stages: the JVM and the
    worker each hold a batch of whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


# ---------------------------------------------------------------- word hashes

def byte_table(separators: bytes, lower: bool = True) -> np.ndarray:
    """256 entries: 0 for a separator, else the (A-Z lower-cased) byte plus 1."""
    t = np.arange(1, 257, dtype=np.uint64)
    if lower:
        t[65:91] += 32
    t[list(separators)] = 0
    return t


#: Bytes hashed at a time.
STRETCH = 1 << 18

SPACE_TABLE = byte_table(bytes([32, 9, 10, 11, 12, 13]))

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POWERS or len(_POWERS["p"]) < n:
        m = max(n, 2 * STRETCH)
        for name, base in (("p", _P), ("i", _PINV)):
            a = np.full(m, base, dtype=np.uint64)
            a[0] = 1
            _POWERS[name] = np.cumprod(a, dtype=np.uint64)
    return _POWERS["p"][:n], _POWERS["i"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (two multiply-xorshift rounds)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _hash_stretch(data: np.ndarray, doc_starts: np.ndarray, table_: np.ndarray):
    """Start, end and hash of every word in a stretch of bytes."""
    n = len(data)
    v = table_[data]
    inside = v != 0
    edge = np.zeros(n + 1, bool)
    edge[doc_starts] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:n]
    close = inside.copy()
    close[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begin), np.flatnonzero(close) + 1
    p, inv = _powers(n)
    with np.errstate(over="ignore"):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(v * p, out=total[1:])
        h = (total[end] - total[start]) * inv[start]
    return start, end, mix(h)


def hash_words(data: np.ndarray, doc_starts: np.ndarray, table_: np.ndarray):
    """Words of one byte buffer that holds documents back to back.

    Returns (word_start, word_end, hash, first): byte positions of every word,
    a 64-bit hash per word, and per document the index of its first word (one
    more entry at the end).  A word never crosses a document boundary.  A long
    buffer is hashed in stretches that end at a separator or a document's end,
    so the working arrays stay small (only one huge word makes them longer).
    """
    n, lo = len(data), 0
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    while lo < n:
        hi = min(n, lo + STRETCH)
        while hi < n:
            block = data[hi:hi + STRETCH]
            gaps = np.flatnonzero(table_[block] == 0)
            cuts = doc_starts[np.searchsorted(doc_starts, hi):]
            ends = ([hi + int(gaps[0])] if len(gaps) else []) + ([int(cuts[0])] if len(cuts) else [])
            if ends and min(ends) <= hi + len(block):
                hi = min(ends)
                break
            hi += len(block)
        a, b = np.searchsorted(doc_starts, [lo, hi])
        start, end, h = _hash_stretch(data[lo:hi], doc_starts[a:b] - lo, table_)
        parts.append((start + lo, end + lo, h))
        lo = hi
    start, end, h = (np.concatenate(x) for x in zip(*parts))
    return start, end, h, np.searchsorted(start, np.append(doc_starts, n))


def text_chunks(column: pa.Array, max_bytes: int = 1 << 19):
    """Consecutive slices of a string column as (lo, hi, bytes, doc starts),
    each of about ``max_bytes`` (one longer text makes a slice of its own), so
    the working arrays stay bounded whatever the batch holds."""
    n = len(column)
    if n == 0:
        return
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32, n + 1 + column.offset)
    offsets = offsets[column.offset:].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi] - offsets[lo]
        lo = hi


# ------------------------------------------------------- connected components

def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` as (node, component): the
    smallest node reachable.  Only nodes that have an edge to another appear.

    Alternates the two star steps (every neighbour above a node is hung on the
    smallest neighbour; then every node on its smallest lower one) until the
    edge set no longer changes.  All of it is joins and aggregations with
    map-side combine; each round is written to the checkpoint folder.
    """
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .where("u <> v").distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = state(e)
    for _ in range(max_rounds if seen[0] else 0):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low2.select("u", F.col("m").alias("v"))).distinct())
        e = written(small, "stars")
        now = state(e)
        if now == seen:
            break
        seen = now
    else:
        if seen[0]:
            raise RuntimeError("components did not settle")
    roots = e.select("v").distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component")))


__all__ = ["table", "written", "small_side", "split_join", "bounded_batches", "hash_words", "text_chunks", "components", "mix",
           "byte_table", "SPACE_TABLE", "SPACE_CLASS", "UPPER", "LOWER", "StorageLevel"]
