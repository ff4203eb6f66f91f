"""Prefix trie of conversations whose openings are rebuilt from a family's first.

Every conversation is rebuilt from the first turns of its base (the id less its
remainder by five) and its own later turns; the nodes of the trie are the
distinct sequences of first turns.

1. *Turns to segments.*  Thin turns (id, turn, digest of role and text, bytes)
   are range-partitioned and sorted; a task packs a conversation's consecutive
   turns into segments of at most ``SEGMENT``.  A conversation over several
   partitions is put together by counts per (conversation, partition), so even
   one that holds a third of all turns is spread.
2. *Prefix digests.*  A prefix's digest is the exclusive or of a 128-bit hash of
   (depth, turn) over its turns: it can be accumulated inside segments and
   carried between them.  Prefixes are told apart by depth and digest.
3. *Count-min screening.*  Two rows of cells count all prefixes.  Where one of
   a prefix's cells has a count of one, the estimate proves a singleton; so are
   all deeper prefixes of the segment.  Such tails are emitted where they stand.
   Only which cells hold more than one matters, so the sketch is sent out as a
   bitmap of at most ``2 ** (MAX_BITS + 1)`` bits; with more prefixes than cells
   it proves less and more prefixes are grouped exactly.
4. *Exact grouping.*  Possibly shared prefixes and the root are grouped with
   partial aggregation.  Sums over subtrees need no walk over the trie: every
   conversation sums up, from its end, the bytes of the nodes that it is not the
   smallest member of, and the leaves that it is the smallest member of; a
   node's figures are the sums over its members at its depth.

Defined cases: a null id is no conversation; a null role or text is empty; a null
turn comes first and turns that tie are ordered by the MD5 of
``length(role):role text``; repeated rows are turns of their own; a base without
rows lends nothing; a remainder has the sign of the id; an empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratus.llm.common import mix, split_join, written

FAMILY, MOST_LENT = 5, 8
#: Most turns in a segment; depths that a running sum covers in one task.
SEGMENT = 1024
#: The sketch has about CELLS cells a prefix, 2 ** MAX_BITS a row at most.
CELLS, MAX_BITS = 8, 27
#: Ids whose decimal list is joined in one task: 2 ** 13.
ID_BITS = 13

_C1, _C2, _ROW = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD1B54A32D192ED03), np.uint64(0xA24BAED4963EE407)


# ------------------------------------------------------------------ task code

def _segments(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Sorted turns (conv, content, size) as segments (conv, block, first,
    contents, sizes); first counts the conversation's turns in this task."""
    block, last, held = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        ids, n = batch.column(0).to_numpy(), batch.num_rows
        if not n:
            continue
        cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), n]
        at, first = [], []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            before = held if ids[lo] == last else 0
            for k in range(lo, hi, most):
                at.append(k)
                first.append(before + k - lo)
            last, held = ids[lo], before + hi - lo
        offsets = pa.array([*at, n], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[at]), pa.array(np.full(len(at), block, np.int32)), pa.array(first, pa.int64()),
             pa.ListArray.from_arrays(offsets, batch.column(1)), pa.ListArray.from_arrays(offsets, batch.column(2))],
            names=["conv", "block", "first", "contents", "sizes"])


def turn_hashes(contents: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of (depth, turn) from the turn's MD5, as two arrays."""
    a, b, d = contents[0::2], contents[1::2], depth.astype(np.uint64)
    with np.errstate(over="ignore"):
        return mix(a + mix(b ^ mix(d + _C1))), mix(b + mix(a ^ mix(d + _C2)))


def _accumulated(x: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Running exclusive or inside each of the stretches."""
    acc = np.bitwise_xor.accumulate(x) if len(x) else x
    before = np.where(starts > 0, acc[starts - 1], np.uint64(0)) if len(x) else np.zeros(len(n), np.uint64)
    return acc ^ np.repeat(before, n)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (conv, block, start, length, contents, sizes), none empty, with
    the running digests of their own turns (d1, d2) and the whole (x1, x2)."""
    for batch in batches:
        contents = batch.column("contents")
        n = contents.value_lengths().to_numpy().astype(np.int64)
        ends = np.cumsum(n)
        starts = ends - n
        depth = np.repeat(batch.column("start").to_numpy() - starts, n) + np.arange(ends[-1] if len(n) else 0) + 1
        raw = np.frombuffer(b"".join(contents.flatten().to_pylist()), np.uint64)
        d = [_accumulated(x, starts, n) for x in turn_hashes(raw, depth)]
        offsets = pa.array(np.append(0, ends), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x.view(np.int64))) for x in d]
        whole = [pa.array(x[ends - 1].view(np.int64)) for x in d]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv", "block", "start", "length", "sizes")), *lists, *whole],
            names=["conv", "block", "start", "length", "sizes", "d1", "d2", "x1", "x2"])


def _prefixes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths of a batch's pieces and the whole prefixes' digests."""
    n = batch.column("d1").value_lengths().to_numpy().astype(np.int64)
    d1, d2 = (batch.column(f"d{k}").flatten().to_numpy() ^ np.repeat(batch.column(f"p{k}").to_numpy(), n) for k in (1, 2))
    return n, d1, d2


def _cells(d1: np.ndarray, d2: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of every prefix in each of the sketch's two rows."""
    shift = np.uint64(64 - bits)
    return [(mix(d.view(np.uint64) ^ _ROW) >> shift).astype(np.int64) + (row << bits) for row, d in enumerate((d1, d2))]


def _sketch(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, d1, d2 = _prefixes(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_cells(d1, d2, bits)))], names=["cell"])


def _screen(batches: Iterator[pa.RecordBatch], several, bits: int) -> Iterator[pa.RecordBatch]:
    """Possibly shared prefixes (tail false) and, a row a piece, the tail of
    proven singletons from depth to last."""
    bitmap = several.value
    for batch in batches:
        n, d1, d2 = _prefixes(batch)
        ends = np.cumsum(n)
        starts = ends - n
        shared = np.ones(len(d1), bool)
        for cell in _cells(d1, d2, bits):
            shared &= (bitmap[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
        piece = np.repeat(np.arange(len(n)), n)
        # Within a piece: whether a singleton has been proven at or before a prefix.
        proven = np.cumsum(~shared)
        before = np.where(starts > 0, proven[starts - 1], 0) if len(n) else proven
        open_ = proven == np.repeat(before, n)
        top = np.zeros(len(d1), bool)
        top[1:] = ~open_[1:] & (open_[:-1] | (piece[1:] != piece[:-1]))
        top[:1] = ~open_[:1]
        q1, q2 = np.empty_like(d1), np.empty_like(d2)
        for q, d, p in ((q1, d1, "p1"), (q2, d2, "p2")):
            q[1:] = d[:-1]
            q[starts] = batch.column(p).to_numpy()
        depth = np.repeat(batch.column("start").to_numpy() - starts, n) + np.arange(len(d1)) + 1
        last = np.where(top, np.repeat(batch.column("start").to_numpy() + n, n), depth)
        sizes = batch.column("sizes").flatten().to_numpy()
        keep = np.flatnonzero(open_ | top)
        conv, length = (np.repeat(batch.column(c).to_numpy(), n) for c in ("conv", "length"))
        columns = [top, conv, depth, last, length, d1, d2, q1, q2, sizes]
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns],
                                         names=["tail", "conv", "depth", "last", "length", "d1", "d2", "q1", "q2", "size"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, d1, d2, ids) to one SHA-256 a node, of the lists joined
    by commas: a node's lists pass through one after the other."""
    key, state = None, None

    def done():
        return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in key), pa.array([state.hexdigest()])],
                                          names=["depth", "d1", "d2", "ends_sha256"])

    for batch in batches:
        for *node, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if node != key:
                if key is not None:
                    yield done()
                key, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(("," + ids).encode())
    if key is not None:
        yield done()


# ------------------------------------------------------------------- the jobs

def _segmented(conversations: DataFrame, most: int) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("content"),
        F.octet_length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("line"))
    order = ["conv", F.asc_nulls_first("turn"), "content", "line"]
    return written(turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "content", "size").mapInArrow(
        lambda it: _segments(it, most), "conv long, block int, first long, contents array<binary>, sizes array<long>"), "segments")


def rebuilt_pieces(conversations: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pieces (conv, block, start, length, contents, sizes) of the rebuilt
    conversations; all of them (conv, length); and the (conv, block) pairs that
    go on from an earlier block, fewer than there are blocks."""
    segments = _segmented(conversations, segment)
    by_conv = Window.partitionBy("conv")
    ahead = by_conv.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = written(segments.groupBy("conv", "block").agg(F.sum(F.size("contents")).alias("n"))
                     .select("conv", "block", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"),
                             F.sum("n").over(by_conv).alias("total")), "blocks")
    onward = blocks.where("offset > 0").select("conv", "block", "offset")

    # The first turns of every conversation, for those that borrow them.
    opening = (segments.join(F.broadcast(onward), ["conv", "block"], "left")
               .withColumn("start", F.coalesce("offset", F.lit(0)) + F.col("first")).where(F.col("start") < MOST_LENT))
    turns = F.arrays_zip(F.sequence("start", F.col("start") + F.size("contents") - 1).alias("at"), "contents", "sizes")
    heads = (opening.select("conv", F.inline(F.slice(turns, F.lit(1), (MOST_LENT - F.col("start")).cast("int")))
                            .alias("at", "content", "size"))
             .groupBy(F.col("conv").alias("base")).agg(F.array_sort(F.collect_list(F.struct("at", "content", "size"))).alias("head")))
    lent = blocks.where("offset = 0").select(
        "conv", F.col("block").alias("home"), "total", (F.col("conv") - F.col("conv") % FAMILY).alias("base"),
        (F.crc32(F.col("conv").cast("string").cast("binary")) % (MOST_LENT + 1)).cast("int").alias("h")).join(heads, "base", "left")
    lead = F.when(F.col("head").isNull(), F.slice("head", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    lent = lent.withColumn("lead", F.coalesce(lead, F.array().cast("array<struct<at:long,content:binary,size:long>>")))
    lent = written(lent.select("conv", "home", "h", "lead", F.greatest(F.col("total") - F.col("h"), F.lit(0)).alias("own"))
                   .withColumn("length", F.size("lead") + F.col("own")), "lent")

    # Nothing but what was lent, or the lent turns before the segment that holds the first own one.
    led = lent.where("own = 0 and length > 0").select(
        "conv", F.col("home").alias("block"), F.lit(0).cast("long").alias("start"), "length",
        F.col("lead.content").alias("contents"), F.col("lead.size").alias("sizes"))
    # By (conversation, block): no key holds more than a partition.
    places = blocks.join(lent.drop("home"), "conv")
    own = segments.join(places.select("conv", "block", "offset", "h", "lead", "length"), ["conv", "block"])
    own = own.withColumn("at", F.col("offset") + F.col("first") - F.col("h"))
    own = own.withColumn("skip", F.greatest(F.lit(0), -F.col("at")).cast("int")).where(F.col("skip") < F.size("contents"))
    first = F.col("at") <= 0

    def joined(own_turns, lent_turns):
        kept = F.slice(own_turns, F.col("skip") + 1, F.size(own_turns))
        return F.when(first, F.concat(lent_turns, kept)).otherwise(kept).alias(own_turns)

    own = own.select("conv", "block", F.when(first, F.lit(0)).otherwise(F.size("lead") + F.col("at")).alias("start"), "length",
                     joined("contents", "lead.content"), joined("sizes", "lead.size"))
    return led.unionByName(own), lent.select("conv", "length"), onward


def prefix_digests(pieces: DataFrame, onward: DataFrame) -> DataFrame:
    """Pieces with the digest before them (p1, p2) and their running digests."""
    made = written(pieces.mapInArrow(_digests, "conv long, block int, start long, length long, sizes array<long>, "
                                               "d1 array<long>, d2 array<long>, x1 long, x2 long"), "digests")
    spread = made.join(F.broadcast(onward.select("conv").distinct()), "conv").groupBy("conv", "block").agg(
        *[F.bit_xor(f"x{k}").alias(f"x{k}") for k in (1, 2)])
    ahead = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = spread.select("conv", "block", *[F.coalesce(F.bit_xor(f"x{k}").over(ahead), F.lit(0)).alias(f"b{k}") for k in (1, 2)])
    within = Window.partitionBy("conv", "block").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    out = made.select("*", *[F.coalesce(F.bit_xor(f"x{k}").over(within), F.lit(0)).alias(f"w{k}") for k in (1, 2)])
    out = out.join(F.broadcast(carried), ["conv", "block"], "left")
    return written(out.select("conv", "start", "length", "sizes", "d1", "d2", *[
        F.col(f"w{k}").bitwiseXOR(F.coalesce(f"b{k}", F.lit(0))).alias(f"p{k}") for k in (1, 2)]), "prefixes")


def screened_prefixes(prefixes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Possibly shared prefixes and tails of proven singletons."""
    spark = prefixes.sparkSession
    many = prefixes.agg(F.sum(F.size("d1"))).first()[0] or 0
    bits = min(max_bits, max(10, (CELLS * many).bit_length()))
    digests = prefixes.select("d1", "d2", "p1", "p2")
    several = (digests.mapInArrow(lambda it: _sketch(it, bits), "cell long").groupBy("cell").count().where("count > 1")
               .select((F.col("cell") + 1).alias("cell")))  # the bitmap functions count from 1
    maps = several.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")).collect()
    bitmap = np.zeros(max(1, (2 << bits) >> 15) << 12, np.uint8)
    for bucket, packed in maps:
        bitmap[(bucket - 1) << 12:bucket << 12] = np.frombuffer(packed, np.uint8)
    held = spark.sparkContext.broadcast(bitmap)
    return written(prefixes.mapInArrow(
        lambda it: _screen(it, held, bits), "tail boolean, conv long, depth long, last long, length long, d1 long, d2 long, "
                                            "q1 long, q2 long, size long"), "screened")


def _onward_sums(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows(conv, depth, ...)`` with ``columns`` summed from their depth to the
    conversation's end, in stretches of ``SEGMENT`` depths."""
    rows = rows.withColumn("stretch", F.floor(F.col("depth") / SEGMENT))
    after = Window.partitionBy("conv").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    deep = rows.where(F.col("length") >= SEGMENT).groupBy("conv", "stretch").agg(*[F.sum(c).alias(c) for c in columns])
    later = deep.select("conv", "stretch", *[F.coalesce(F.sum(c).over(after), F.lit(0)).alias(f"{c}_later") for c in columns])
    onward = Window.partitionBy("conv", "stretch").orderBy(F.desc("depth"))
    rows = rows.select("*", *[F.sum(c).over(onward).alias(f"{c}_here") for c in columns]).join(later, ["conv", "stretch"], "left")
    return rows.select("tail", "conv", *KEY, *[
        (F.col(f"{c}_here") + F.coalesce(f"{c}_later", F.lit(0))).alias(c) for c in columns])


KEY = ["depth", "d1", "d2"]


def conversation_trie(conversations: DataFrame, segment: int = SEGMENT, max_bits: int = MAX_BITS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 of every node."""
    pieces, convs, onward = rebuilt_pieces(conversations, segment)
    screened = screened_prefixes(prefix_digests(pieces, onward), max_bits)
    zero = F.lit(0).cast("long")
    roots = convs.select(F.lit(False).alias("tail"), "conv", zero.alias("depth"), zero.alias("last"), "length",
                         *[zero.alias(c) for c in ("d1", "d2", "q1", "q2", "size")])
    tails, exact = screened.where("tail"), screened.where("not tail").unionByName(roots)

    nodes = written(exact.groupBy(*KEY).agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("length").alias("deepest"),
        F.min("q1").alias("q1"), F.min("q2").alias("q2")), "nodes")
    smallest = nodes.select(*KEY, "conv", "deepest", F.lit(True).alias("smallest"))
    marked = exact.join(smallest, [*KEY, "conv"], "left").select(
        "tail", "conv", "length", *KEY, F.when(F.col("smallest").isNull(), F.col("size")).otherwise(0).alias("saved"),
        F.when(F.col("deepest") == F.col("depth"), 1).otherwise(0).cast("long").alias("leaves"))
    ended = tails.select("tail", "conv", "length", *KEY, zero.alias("saved"),
                         (F.col("last") == F.col("length")).cast("long").alias("leaves"))
    sums = _onward_sums(marked.unionByName(ended), ["saved", "leaves"]).where("not tail").groupBy(*KEY).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    up = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("d1"), F.col("q2").alias("d2")]
    children = (nodes.where("depth > 0").select(*up).unionAll(tails.select(*up))
                .groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_children")))

    # Ids of the conversations that end at a node, joined in ranges of ids.
    ids = exact.where("length = depth").groupBy(*KEY, F.shiftright("conv", ID_BITS).alias("range")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    ends = ids.repartition(*KEY).sortWithinPartitions(*KEY, "range").select(*KEY, "ids").mapInArrow(
        _ends, "depth long, d1 long, d2 long, ends_sha256 string")

    whole = written(nodes.join(sums, KEY).join(children, KEY, "left").join(ends, KEY, "left").select(
        *KEY, "conv", "q1", "q2", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")), "trie")
    # A node may be the parent of a third of all nodes.
    parents = whole.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("q1"), F.col("d2").alias("q2"),
                                                   F.col("conv").alias("parent"), "n_children")
    above = ["depth", "q1", "q2"]
    inner = split_join(whole.withColumnRenamed("n_children", "n"), parents, above, "n_children")
    # The parent of a singleton whose parent was itself proven a singleton is its own.
    parent = F.when(F.col("depth") > 0, F.coalesce("parent", "conv")).alias("parent_conv_id")
    inner = inner.select(F.col("conv").alias("conv_id"), "depth", parent, "n_convs", F.col("n").alias("n_children"),
                         "n_leaves", "saved_tokens", "ends_sha256")
    hung = split_join(tails, parents, above, "n_children").select(
        "conv", "depth", "length", F.coalesce("parent", "conv").alias("parent"), F.explode(F.sequence("depth", "last")).alias("at"))
    one = F.lit(1).cast("long")
    return inner.unionByName(hung.select(
        F.col("conv").alias("conv_id"), F.col("at").alias("depth"),
        F.when(F.col("at") == F.col("depth"), F.col("parent")).otherwise(F.col("conv")).alias("parent_conv_id"),
        one.alias("n_convs"), (F.col("at") < F.col("length")).cast("long").alias("n_children"), one.alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.sha2(F.when(F.col("at") == F.col("length"), F.col("conv").cast("string")).otherwise(""), 256).alias("ends_sha256")))


SQL = r"""
WITH t AS (
  SELECT conv_id, md5(strlen(role)::VARCHAR || ':' || role || text) AS m, strlen(text)::BIGINT AS size,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role)::VARCHAR || ':' || role || text)) - 1 AS j
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base,
        xor(4294967295, list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
          lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, 3988292384 * (s & 1))))) % 9 AS h
      FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, t.j AS k, m, size FROM c JOIN t ON t.conv_id = c.base AND t.j < c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + t.j - c.h, m, size
  FROM c JOIN t ON t.conv_id = c.conv_id AND t.j >= c.h LEFT JOIN c b ON b.conv_id = c.base),
p AS (
  SELECT conv_id, k + 1 AS depth, size, string_agg(m, '') OVER (PARTITION BY conv_id ORDER BY k) AS key FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
l AS (SELECT conv_id, max(depth) AS len FROM p GROUP BY conv_id),
n AS (
  SELECT depth, key, any_value(size) AS size, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(len) AS deepest,
         sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (len = depth), '')) AS ends_sha256
  FROM p JOIN l ON l.conv_id = p.conv_id GROUP BY depth, key),
s AS (
  SELECT a.key, sum((n.n_convs - 1) * n.size) AS saved_tokens, sum((n.deepest = n.depth)::INT) AS n_leaves
  FROM n JOIN p a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.key),
k AS (SELECT left(key, 32 * (depth - 1)) AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
       n.ends_sha256
FROM n JOIN s ON s.key = n.key LEFT JOIN k ON k.key = n.key
LEFT JOIN n u ON n.depth > 0 AND u.key = left(n.key, 32 * (n.depth - 1))
"""
