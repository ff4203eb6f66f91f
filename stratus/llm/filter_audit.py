"""Filter interaction audit over a sparse document-term matrix.

The matrix: words are counted per document and packed into CSR shards of about
``SHARD_BYTES`` of text.  A shard numbers its own words (``codes``); a global
dictionary gives every word one term (a bucket of the word's hash and the word's
rank in the bucket), and ``columns`` maps each shard's codes to terms, so a
shard keeps small indices.  A text of more than ``PIECE_BYTES`` is a row in
several pieces, which only the terms can bring together: its nonzeros are the
distinct terms over its pieces.

Row sums and nonzero counts decide filters A (under 100 words) and B (under 80
per cent of the words distinct); C (over 10 per cent of the code points A-Z), D
(any of ``#$%&*|``) and E (the text of a smaller id) are attached.  Failures are
a five-bit mask, documents are summed up by part, mask and labels, and all 120
orders of the filters are read off the sums: a document goes at the first
filter of an order that is in its mask.

E needs no join by text, which copies would make hot: a document is the first of
its text exactly if (text, id) is among the (text, smallest id) pairs.

Defined cases: a null text is empty; a text without words fails A and not B; a
null language is the part ''; a null id is never E and has no labels; an id with
several label rows is good (toxic) if any of them says so; repeated rows count
one by one and are not E for each other; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratus.llm.common import written

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER, MARKS = 100, 80, 10, "[#$%&*|]"
#: Text bytes that a shard holds, and that a piece of a row holds at most.
SHARD_BYTES, PIECE_BYTES = 16 << 20, 1 << 20
#: Words of all shards that one bucket of the dictionary ranks.
BUCKET_WORDS = 100_000

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(text: bytes, size: int) -> Iterator[bytes]:
    """``text`` cut at white space into stretches of about ``size`` bytes."""
    lo = 0
    while len(text) - lo > size and (gap := _SPACE.search(text, lo + size)):
        yield text[lo:gap.start()]
        lo = gap.start()
    yield text[lo:] if lo else text


class _Shard:
    """Rows counted so far, with the shard's own numbering of words."""

    def __init__(self):
        self.codes_of: defaultdict[bytes, int] = defaultdict()
        self.codes_of.default_factory = self.codes_of.__len__
        self.codes, self.counts, self.lengths, self.rows, self.whole, self.at = [], [], [], [], [], []
        self.bytes = 0

    def add(self, row: int, piece: bytes, whole: bool, at: int) -> None:
        # bytes.split() parts at exactly \x20 and \x09-\x0D.
        counted = Counter(piece.split())
        n = len(counted)
        self.codes.append(np.fromiter(map(self.codes_of.__getitem__, counted), np.int32, n))
        self.counts.append(np.fromiter(counted.values(), np.int32, n))
        self.lengths.append(n)
        self.rows.append(row)
        self.whole.append(whole)
        self.at.append(at)
        self.bytes += len(piece) + 64

    def record(self, number: int, carried: pa.RecordBatch | pa.Table) -> pa.RecordBatch:
        def one(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        def ints(parts: list[np.ndarray]) -> pa.Array:
            return one(pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int32), pa.int32()))

        start = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int32)
        columns = {"shard": pa.array([number], pa.int64()), "n_terms": pa.array([len(self.codes_of)], pa.int32()),
                   "n_cut": pa.array([len(self.whole) - sum(self.whole)], pa.int32()),
                   "rows": one(pa.array(self.rows, pa.int64())), "whole": one(pa.array(self.whole, pa.bool_())),
                   "start": one(pa.array(start)), "codes": ints(self.codes), "counts": ints(self.counts),
                   "words": one(pa.array(self.codes_of.keys(), pa.binary()))}
        for name, column in zip(carried.schema.names, carried.columns):
            values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            columns[name] = one(values.take(pa.array(self.at, pa.int64())))
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


_SHARD_SCHEMA = ("shard long, n_terms int, n_cut int, rows array<long>, whole array<boolean>, start array<int>, "
                 "codes array<int>, counts array<int>, words array<binary>")


def _build(batches: Iterator[pa.RecordBatch], shard_bytes: int, piece_bytes: int) -> Iterator[pa.RecordBatch]:
    """Shards of a task's documents; the text is the first column, the others are carried."""
    number = row = TaskContext.get().partitionId() << 32
    for batch in batches:
        text, carried = batch.column(0), batch.select(batch.schema.names[1:])
        shard = _Shard()
        for k in range(batch.num_rows):
            data = text[k].as_buffer().to_pybytes() if text[k].is_valid else b""
            pieces = _pieces(data, piece_bytes)
            piece = next(pieces)
            while piece is not None:
                following = next(pieces, None)
                shard.add(row, piece, len(piece) == len(data), k)
                if shard.bytes >= shard_bytes:
                    yield shard.record(number, carried)
                    number, shard = number + 1, _Shard()
                piece = following
            row += 1
        if shard.rows:
            yield shard.record(number, carried)
            number += 1


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row sums and nonzero counts of the rows that are whole."""
    for batch in batches:
        for k in range(batch.num_rows):
            lists = {n: batch.column(n)[k].values for n in batch.schema.names}
            start = lists.pop("start").to_numpy()
            total = np.concatenate([[0], np.cumsum(lists.pop("counts").to_numpy(), dtype=np.int64)])
            keep = lists.pop("whole")
            out = {n: v.filter(keep) for n, v in lists.items()}
            mask = keep.to_numpy(zero_copy_only=False)
            out["n_words"] = pa.array((total[start[1:]] - total[start[:-1]])[mask])
            out["n_distinct"] = pa.array(np.diff(start).astype(np.int64)[mask])
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


def _cut_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, row, code, n) of the rows that stand in pieces."""
    for batch in batches:
        for k in range(batch.num_rows):
            start, rows, whole = (batch.column(n)[k].values.to_numpy(zero_copy_only=False) for n in ("start", "rows", "whole"))
            codes, counts = batch.column("codes")[k].values, batch.column("counts")[k].values
            for r in np.flatnonzero(~whole.astype(bool)):
                lo, n = int(start[r]), int(start[r + 1] - start[r])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, batch.column("shard")[k].as_py())), pa.array(np.full(n, rows[r])),
                     codes.slice(lo, n), counts.slice(lo, n)], names=["shard", "row", "code", "n"])


class DocumentTermMatrix:
    """``shards``: one CSR shard a row (rows, start, codes, counts, words) with
    the carried columns as lists; ``columns``: (shard, code, term)."""

    def __init__(self, docs: DataFrame, carry: list[str], text_col: str = "text",
                 shard_bytes: int = SHARD_BYTES, piece_bytes: int = PIECE_BYTES):
        given = docs.select(F.col(f"`{text_col}`").alias("text"),
                            *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(carry)])
        self.carry = {c: f"c{k}" for k, c in enumerate(carry)}
        self.types = {f.name: f.dataType for f in given.schema.fields[1:]}
        schema = T.StructType(T._parse_datatype_string(_SHARD_SCHEMA).fields
                              + [T.StructField(n, T.ArrayType(t)) for n, t in self.types.items()])
        self.shards = written(given.mapInArrow(lambda it: _build(it, shard_bytes, piece_bytes), schema), "shards")
        self.columns = written(self.dictionary().select("shard", "code", "term"), "columns")

    def dictionary(self) -> DataFrame:
        """(shard, code, word, term): every shard's words with their terms."""
        held = self.shards.agg(F.sum("n_terms")).first()[0] or 0
        buckets = held // BUCKET_WORDS + 1
        words = self.shards.select("shard", F.posexplode("words").alias("code", "word")).withColumn(
            "bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)))
        rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("word"))
        return words.select("shard", "code", "word", (F.shiftleft(F.col("bucket"), 32) + rank).alias("term"))

    def row_totals(self) -> DataFrame:
        """The carried columns with n_words (row sum) and n_distinct (nonzeros)."""
        carried = list(self.types)
        schema = T.StructType([T.StructField(n, t) for n, t in self.types.items()]
                              + T._parse_datatype_string("n_words long, n_distinct long").fields)
        out = self.shards.select("start", "counts", "whole", *carried).mapInArrow(_sums, schema)
        cut = self.shards.where("n_cut > 0")
        if not cut.isEmpty():
            entries = cut.select("shard", "start", "rows", "whole", "codes", "counts").mapInArrow(
                _cut_entries, "shard long, row long, code int, n int")
            totals = (entries.join(self.columns, ["shard", "code"]).groupBy("row", "term").agg(F.sum("n").alias("n"))
                      .groupBy("row").agg(F.sum("n").alias("n_words"), F.count(F.lit(1)).alias("n_distinct")))
            facts = cut.select(F.inline(F.arrays_zip(F.col("rows").alias("row"), "whole", *carried))).where("not whole").drop("whole")
            out = out.unionByName(facts.dropDuplicates(["row"]).join(totals, "row").select(out.columns))
        return out.select(*[F.col(n).alias(c) for c, n in self.carry.items()], "n_words", "n_distinct")


def failure_masks(docs: DataFrame, shard_bytes: int = SHARD_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """(doc_id, part, mask, n): documents by the filters they fail, bit k for
    the k-th of ``FILTERS``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    loud = 100 * F.regexp_count(text, F.lit("[A-Z]")) > MAX_UPPER * F.char_length(text)
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"),
        (4 * loud.cast("int") + 8 * F.regexp_like(text, F.lit(MARKS)).cast("int")).alias("flags"))
    rows = DocumentTermMatrix(given, ["doc_id", "part", "digest", "flags"], "text", shard_bytes, piece_bytes).row_totals()
    short, same = F.col("n_words") < MIN_WORDS, 100 * F.col("n_distinct") < MIN_DISTINCT * F.col("n_words")
    counted = written(rows.groupBy("doc_id", "part", "digest", (F.col("flags") + short.cast("int") + 2 * same.cast("int"))
                                   .alias("mask")).agg(F.count(F.lit(1)).alias("n")), "masks")
    firsts = counted.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    later = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return (counted.join(firsts, ["digest", "doc_id"], "left")
            .groupBy("doc_id", "part", (F.col("mask") + 16 * later.cast("int")).alias("mask")).agg(F.sum("n").alias("n")))


def audit_filters(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES,
                  piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley."""
    def any_one(c):
        return F.coalesce(F.max((F.col(c) == 1).cast("long")), F.lit(0))

    labelled = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id is not null")
                .groupBy("doc_id").agg(any_one("quality").alias("good"), any_one("toxic").alias("toxic")))
    # At most 32 cells a part from here on.
    cells = failure_masks(docs, shard_bytes, piece_bytes).join(labelled, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    steps = [("".join(FILTERS[k] for k in order), step + 1, sum(1 << k for k in order[:step]), 1 << order[step])
             for order in permutations(range(len(FILTERS))) for step in range(len(FILTERS))]
    listed = F.from_json(F.lit("[" + ",".join('{"o":"%s","s":%d,"e":%d,"b":%d}' % s for s in steps) + "]"),
                         "array<struct<o:string,s:int,e:int,b:int>>")
    each = parts.select("part", "cells", F.inline(listed).alias("filter_order", "step", "earlier", "bit"))

    def over(where, value) -> F.Column:
        return F.aggregate(F.filter("cells", where), F.lit(0).cast("long"), lambda a, c: a + value(c))

    def mask(c):
        return c["mask"]

    bit, earlier = F.col("bit"), F.col("earlier")
    fails = lambda c: mask(c).bitwiseAND(bit) != 0
    gone = lambda c: mask(c).bitwiseAND(earlier) != 0
    first = lambda c: fails(c) & ~gone(c)
    orders = len(steps) // len(FILTERS)
    return each.select(
        "part", "filter_order", "step",
        over(lambda c: ~fails(c) & ~gone(c), lambda c: c["n"]).alias("kept"),
        over(first, lambda c: c["n"]).alias("removed"),
        over(lambda c: fails(c) & gone(c), lambda c: c["n"]).alias("redundant"),
        over(lambda c: mask(c) == bit, lambda c: c["n"]).alias("unique_fails"),
        over(first, lambda c: c["good"]).alias("good_lost"),
        over(first, lambda c: c["toxic"]).alias("toxic_lost"),
        # Each filter of a mask is the first of the mask in as many orders.
        over(fails, lambda c: c["n"] * (F.lit(orders) / F.bit_count(mask(c))).cast("long")).alias("shapley"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
m AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
w AS (SELECT doc_id, part, d.t, regexp_extract_all(d.t, '[^\x20\x09-\x0D]+') AS ws, first_id FROM d JOIN m ON d.t = m.t),
f AS (SELECT doc_id, part, (len(ws) < 100)::INT + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INT
        + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t))::INT
        + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first_id, false)::INT AS mask FROM w),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
x(a, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT p.a || q.a || r.a || s.a || t.a AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits
      FROM x p, x q, x r, x s, x t WHERE len(list_distinct([p.b, q.b, r.b, s.b, t.b])) = 5),
e AS (SELECT filter_order, k AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0)::INT AS earlier
      FROM o, unnest(range(1, 6)) AS u(k)),
g AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & bit = 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & bit <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, e GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM g
"""
