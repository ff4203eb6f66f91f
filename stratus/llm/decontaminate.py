"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every item is cut into windows of ten consecutive words (an item of fewer words
is one window).  Per window length a *shift table* says for each block of two
words how far the search may jump, a block that no window holds letting it jump
the most; where the shift is zero the block's *suffix bucket* names the windows
that end with it, and they are compared word by word.  A document is searched
whole; words inside any occurrence are hit.

The windows of the items are built into tables on the driver and sent to the
executors in blocks of at most ``BLOCK_BYTES`` of item text, one pass over the
documents for each block, so a large benchmark costs passes and not memory.

Defined cases: a null or empty text has no words and is clean; null or wordless
items match nothing; items with a null id are ignored; an item id counts once
however often it occurs; repeated documents are searched alike; an empty
benchmark leaves everything clean; an empty table gives no rows.  Carried
columns keep their names; the results come after them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import bounded_batches, written

WINDOW = 10
#: Most bytes of benchmark text whose tables one pass holds.
BLOCK_BYTES = 16 << 20

#: A-Z lower-cased; every ASCII byte but 0-9, a-z becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def window_table(length: int, windows: dict[tuple, set]) -> dict:
    """Shift table and suffix buckets of all windows of one length."""
    block = min(2, length)
    jump = length - block + 1
    shift: dict[tuple, int] = {}
    bucket: dict[tuple, dict[tuple, set]] = {}
    for w, ids in windows.items():
        for end in range(block, length + 1):
            key = w[end - block:end]
            shift[key] = min(length - end, shift.get(key, jump))
        bucket.setdefault(w[length - block:], {})[w] = ids
    return {"length": length, "block": block, "jump": jump, "shift": shift, "bucket": bucket}


def occurrences(table: dict, words: list[bytes]):
    """(start, items) of every occurrence of the table's windows."""
    size, block, jump, shift, bucket = (table[k] for k in ("length", "block", "jump", "shift", "bucket"))
    at, n = size, len(words)
    while at <= n:
        key = tuple(words[at - block:at])
        far = shift.get(key, jump)
        if far:
            at += far
            continue
        ids = bucket[key].get(tuple(words[at - size:at]))
        if ids is not None:
            yield at - size, ids
        at += 1


def build_tables(items: list[tuple[object, bytes]], window: int = WINDOW) -> list[dict]:
    """Plain dictionaries, which a broadcast ships as they are."""
    by_length: dict[int, dict[tuple, set]] = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            by_length.setdefault(size, {}).setdefault(tuple(words[k:k + size]), set()).add(str(item))
    return [window_table(n, w) for n, w in sorted(by_length.items())]


_FOUND = ("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "marks binary, items array<string>")


def _searcher(tables):
    """Column function of a text and what earlier blocks have found in it.  Only
    these go to Python; the rows stay where they are."""
    @F.arrow_udf(_FOUND)
    def found(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        held = tables.value
        for text, marked, named in batches:
            out = {k: [] for k in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "marks", "items")}
            for k in range(len(text)):
                words = words_of(text[k].as_buffer().to_pybytes()) if text[k].is_valid else []
                marks, items = bytearray(marked[k].as_py() or b""), set(named[k].as_py() or [])
                for t in held:
                    for start, ids in occurrences(t, words):
                        marks = marks or bytearray(len(words))
                        marks[start:start + t["length"]] = b"\x01" * t["length"]
                        items |= ids
                ids = sorted(items)
                out["n_words"].append(len(words))
                out["n_hit"].append(marks.count(1))
                out["n_items"].append(len(ids))
                out["items_sha256"].append(hashlib.sha256(",".join(ids).encode()).hexdigest())
                out["contaminated"].append(marks.count(1) > 0)
                out["marks"].append(bytes(marks))
                out["items"].append(ids)
            types = [pa.int64()] * 3 + [pa.string(), pa.bool_(), pa.binary(), pa.list_(pa.string())]
            yield pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))
        pa.default_memory_pool().release_unused()

    return found


def _searched(docs: DataFrame, benchmark: DataFrame, text: str, block_bytes: int) -> tuple[DataFrame, Column]:
    """``docs`` and the struct column of what its texts hold."""
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.col("item_id").alias("item"), F.encode("text", "UTF-8").alias("text")).where(
        "item is not null and text is not null")
    held = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-held // block_bytes))
    marks, named = F.lit(None).cast("binary"), F.lit(None).cast("array<string>")
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        tables = spark.sparkContext.broadcast(build_tables([(r[0], bytes(r[1])) for r in part]))
        found = _searcher(tables)(F.col(text), marks, named)
        if block < blocks - 1:
            docs = written(docs.withColumn("__found", found), "searched")
            marks, named = F.col("__found.marks"), F.col("__found.items")
    return docs, found


def search_benchmark(docs: DataFrame, benchmark: DataFrame, carry: list[str] | None = None,
                     text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``carry`` columns of ``docs`` (all by default) with n_words, n_hit,
    n_items, items_sha256 and contaminated."""
    inner = {c: f"__c{k}" for k, c in enumerate(docs.columns if carry is None else carry)}
    state = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()], F.col(f"`{text_col}`").alias("__text"))
    state, found = _searched(state, benchmark, "__text", block_bytes)
    out = state.select(*inner.values(), found.alias("__found"))
    return out.select(*[F.col(n).alias(c) for c, n in inner.items()],
                      *[F.col(f"__found.{c}").alias(c) for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")])


def clean_documents(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the contaminated ones, columns as they were."""
    inner = {c: f"__c{k}" for k, c in enumerate(docs.columns)}
    state = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    state, found = _searched(state, benchmark, inner["text"], block_bytes)
    return state.where(~found["contaminated"]).select(*[F.col(n).alias(c) for c, n in inner.items()])


SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
p AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS win
  FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(k) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM p),
o AS (
  SELECT r, size, k, array_to_string(w[k:k + size - 1], ' ') AS win
  FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(k) WHERE len(w) >= size),
m AS (SELECT r, k, o.size, item_id FROM o JOIN p ON p.win = o.win AND p.size = o.size),
h AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(k, k + size)) AS x FROM m) GROUP BY r),
g AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM m GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN g USING (r)
"""
