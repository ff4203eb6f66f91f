"""N-gram Jaccard join: groups of documents whose word-shingle sets reach a
Jaccard similarity, by prefix lists that skip with set relations.

A document's set holds the 64-bit hashes of its distinct 5-word shingles.

1. Equal sets fall into one *node* (a digest of the set); every later step
   works on nodes, so copies cost one row each.
2. Each node lists its prefix (the first ``n - ceil(s*n) + 1`` shingles in one
   global order, frequent shingles last).  Two sets that reach the similarity
   share a prefix shingle, so the lists hold every candidate.
3. *Answers from a highly similar set*: in each list the sets are first only
   compared with up to three leaders.  A set that links with a leader joins the
   leader's group, and all it could add inside that group is already answered.
   Lists that then hold several groups get six new leaders a round, until a
   round joins next to none of the groups.
4. *Skipping by position*: only lists that still hold several groups are
   probed, dealt by list and size band, and a set is entered only where a first
   common shingle with a set of the band can stand.  Lists of up to three sets
   are not probed: their pairs, known from step 3, are added.  The pairs met are
   then held to the number of prefix shingles that a linked pair has in common
   at least, before any set is fetched.  Of every pair of groups a few are
   verified at a time: what these join needs no further answers.
5. Candidates are verified on the whole sets, made again from the texts.

Groups are exact: a pair of sets in different groups has been verified or
failed a necessary bound.  (Sets are compared by 64-bit hashes; a collision of
two different shingles moves an intersection by one.)

Defined cases: null or empty text, or text without words: empty set, linked
with nothing, its own group.  One to four words: the whole sequence is one
shingle.  Repeated rows are returned once each with the same group.  An id with
several texts has a group for each.  A row with a null id shares the group of
its set, whose id comes from other rows; it is null if all ids of the group are.
An empty table gives no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratus.llm.common import SPACE_TABLE, components, hash_words, mix, small_side, text_chunks, written

#: Length of the list of frequent shingles that come last in the global order.
#: It only orders shingles: no result depends on what it holds.
FREQUENT = 65_536
#: A node set of at most this many rows (two longs each) is broadcast when the
#: texts of candidate documents are picked; a larger one is joined by shuffle.
BROADCAST_ROWS = 1_000_000
_STEP = np.uint64(0xD6E8FEB86659FD93)
_XOR = 0x5DEECE66D1234567
#: Leaders of a list in every later round; size bands between a size and the
#: least one that a set of it can link with.
LEADERS, BANDS = 6, 8
#: The first leaders come from the core of a list: steps of the logarithm by which
#: these tell sets apart (the smaller, the more sets count as equally near it).
CORE = (1000, 20, 8)
#: A set and a leader are counted on all their shingles in common if the lists that
#: it leads make at least this part of what they need.
PART = 4
#: Prefix entries that a task packs at a time, and the most buckets it deals them
#: to: a packed row holds 16 entries or more on average, at any size of the input.
PACKED, MOST_BUCKETS = 1 << 19, 1 << 15


def shingle_sets(data: np.ndarray, starts: np.ndarray, words: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every document in a byte buffer."""
    _, _, h, first = hash_words(data, starts, SPACE_TABLE)
    out = []
    with np.errstate(over="ignore"):
        if len(h) >= words:
            g = np.zeros(len(h) - words + 1, np.uint64)
            for k in range(words):
                g = g * _STEP + h[k:len(h) - words + 1 + k]
            g = mix(g)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            m = b - a
            if m >= words:
                out.append(np.unique(g[a:b - words + 1]))
            elif m:
                x = np.uint64(m)
                for v in h[a:b]:
                    x = x * _STEP + v
                out.append(mix(np.array([x ^ np.uint64(0xA5A5A5A5A5A5A5A5)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def node_of(values: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_length(n: int, percent: int) -> int:
    return n - (-(-percent * n // 100)) + 1 if n else 0


def _flush(parts: list[np.ndarray], least: int):
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    keep = counts >= least
    return values[keep].view(np.int64), counts[keep]


def _describe(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Per document its set's size and node; per task the shingles that many of
    its sets hold (kind 1), counted over about a million shingles at a time."""
    seen: set[int] = set()
    parts, held = [], 0

    def frequent():
        v, c = _flush(parts, 4)
        k = len(v)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(k, np.int32)), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
             pa.array(c.astype(np.int64)), pa.array(v)],
            names=["kind", "doc_id", "key", "n", "node"])

    for batch in batches:
        ids, keys = batch.column(0), batch.column(2)
        for lo, hi, data, starts in text_chunks(batch.column(1)):
            sets = shingle_sets(data, starts, words)
            nodes = [node_of(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(hi - lo, np.int32)), ids.slice(lo, hi - lo).cast(pa.int64()),
                 keys.slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64())],
                names=["kind", "doc_id", "key", "n", "node"])
            for s, node in zip(sets, nodes):
                if node is not None and node not in seen:
                    seen.add(node)
                    parts.append(s)
                    held += len(s)
            if held > 1_000_000:
                yield frequent()
                parts, held = [], 0
    if parts:
        yield frequent()


def _prefixes(batches: Iterator[pa.RecordBatch], words: int, percent: int, frequent):
    """(h, node, n, position, often) arrays: the prefix of every set that this
    task has not listed yet."""
    often, times = frequent.value
    seen: set[int] = set()
    for batch in batches:
        for _, _, data, starts in text_chunks(batch.column(0)):
            for s in shingle_sets(data, starts, words):
                n = len(s)
                if not n or (node := node_of(s)) in seen:
                    continue
                seen.add(node)
                p = prefix_length(n, percent)
                flag = np.zeros(n, bool)
                if len(often):
                    at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    flag = often[at] == s
                    if flag.any():
                        order = np.lexsort((s, np.where(flag, times[at], 0)))
                        s, flag = s[order], flag[order]
                yield s[:p].view(np.int64), np.full(p, node, np.int64), np.full(p, n, np.int64), np.arange(p), flag[:p]


def _often_entries(batches: Iterator[pa.RecordBatch], words: int, percent: int, frequent) -> Iterator[pa.RecordBatch]:
    """(h, node, np) of the frequent shingles in prefixes; np packs the set's
    size and the shingle's position."""
    held, parts = 0, []

    def listed():
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names=["h", "node", "np"])

    for h, node, n, at, flag in _prefixes(batches, words, percent, frequent):
        if flag.any():
            parts.append((h[flag], node[flag], (n[flag] << 32) + at[flag]))
            held += len(parts[-1][0])
        if held >= 1 << 16:
            yield listed()
            held, parts = 0, []
    if held:
        yield listed()


def _packed_entries(batches: Iterator[pa.RecordBatch], words: int, percent: int, frequent, buckets: int) -> Iterator[pa.RecordBatch]:
    """The other prefix entries, ``PACKED`` at a time, as one row a bucket of
    hashes: (bucket, hs, nodes, small, wide).  An entry takes 20 bytes: size and
    position share 32 bits (``small``); sets of 2 ** 15 shingles or more have
    rows of their own with 64 bits (``wide``)."""
    held, parts = 0, []

    def packed():
        h, node, n, at = (np.concatenate(x) for x in zip(*parts))
        for wide in (False, True):
            pick = np.flatnonzero((n >= 1 << 15) == wide)
            if not len(pick):
                continue
            bucket = h[pick] & (buckets - 1)
            order = np.argsort(bucket, kind="stable")
            pick, bucket = pick[order], bucket[order]
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            offsets = pa.array(np.append(first, len(pick)), pa.int32())
            sizes = (n[pick] << 32) + at[pick] if wide else ((n[pick] << 16) + at[pick]).astype(np.int32)
            sizes = pa.ListArray.from_arrays(offsets, pa.array(sizes))
            absent = pa.nulls(len(first), pa.list_(pa.int32() if wide else pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[first]), *(pa.ListArray.from_arrays(offsets, pa.array(x[pick])) for x in (h, node)),
                 *((absent, sizes) if wide else (sizes, absent))], names=["bucket", "hs", "nodes", "small", "wide"])

    for h, node, n, at, flag in _prefixes(batches, words, percent, frequent):
        rare = ~flag
        parts.append((h[rare], node[rare], n[rare], at[rare]))
        held += len(parts[-1][0])
        if held >= PACKED:
            yield from packed()
            held, parts = 0, []
    if held:
        yield from packed()


def _verify(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The groups of the pairs (a, b, text_a, text_b, g0, g1) whose sets reach
    the similarity."""
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        keep = []
        right = _each_set(batch.column(3), words)
        for k, (x, y, s, t) in enumerate(zip(a, b, _each_set(batch.column(2), words), right)):
            both = np.intersect1d(s, t, assume_unique=True).size
            if 100 * both >= percent * (len(s) + len(t) - both) and node_of(s) == x and node_of(t) == y:
                keep.append(k)
        yield pa.RecordBatch.from_arrays([batch.column(4).take(pa.array(keep, pa.int64())), batch.column(5).take(pa.array(keep, pa.int64()))],
                                         names=["a", "b"])


def _each_set(column: pa.Array, words: int):
    for _, _, data, starts in text_chunks(column):
        yield from shingle_sets(data, starts, words)


def _n(c):
    return F.shiftright(c, 32)


def _pos(c):
    return c.bitwiseAND(F.lit(0xFFFFFFFF))


def _possible(p, q, percent: int):
    """The position bound and the size bound for two postings of one list."""
    n, m, i, j = _n(p), _n(q), _pos(p), _pos(q)
    reach = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    return reach * (100 + percent) >= (n + m) * percent


def _first(p, q, percent: int):
    """The bound that the first common shingle of a linked pair keeps: what
    follows it in either set still holds the whole needed overlap."""
    n, m, i, j = _n(p), _n(q), _pos(p), _pos(q)
    return F.least(n - i, m - j) * (100 + percent) >= (n + m) * percent


def _enough(c, p, q, percent: int):
    """Common prefix shingles that a linked pair has at least."""
    need = F.ceil((p + q) * percent / (100 + percent))

    def of(n):
        return need - F.ceil(n * percent / 100) + 1  # prefix length - (n - need)

    return c >= F.least(of(p), of(q))


def row_key(doc_id, text):
    """A hash of id and text, also where the id is null: what tells rows apart."""
    return F.xxhash64(doc_id.cast("long"), text)


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   words: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest
    id reachable by links, itself included)."""
    return grouped_rows(docs, id_col, text_col, words, percent).select("doc_id", "n_shingles", "component_id")


def one_per_group(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` with one row of every group: of the rows with
    the group's smallest id (null if it has no other) that of the smallest key.
    Rows with an empty set stay, repeated ones once."""
    rows = written(grouped_rows(docs).where("root is not null").select("doc_id", "key", "root", "component_id"), "groups")
    first = F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), F.col("key"))
    stay = rows.groupBy("root").agg(F.min(first).alias("key")).select("key")
    gone = rows.select("key").distinct().join(stay, "key", "left_anti")
    return (docs.join(gone, row_key(docs["doc_id"], docs["text"]) == gone["key"], "left_anti")
            .select(*docs.columns).dropDuplicates(["doc_id", "text"]))


def grouped_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = 5, percent: int = 75) -> DataFrame:
    """``jaccard_groups`` with the row's key and its group's root, a set (null
    for an empty set)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("key", row_key(F.col("doc_id"), F.col("text")))

    described = written(docs.mapInArrow(
        lambda it: _describe(it, words), "kind int, doc_id long, key long, n long, node long"), "sets")
    sig = described.where("kind = 0").select("doc_id", "key", "n", "node")
    # A set's text is fetched by the key of one of its rows.
    nodes = sig.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.min("key").alias("key"))
    repeated = not sig.where("node is not null").groupBy("key").count().where("count > 1").isEmpty()

    # Frequent shingles: a bounded list that only sets the global order.
    top = (described.where("kind = 1").groupBy("node").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "node").limit(FREQUENT).collect())
    hot = np.array([r[0] for r in top], np.int64).view(np.uint64)
    order = np.argsort(hot)
    frequent = spark.sparkContext.broadcast((hot[order], np.array([r[1] for r in top], np.int64)[order]))

    # Entries of frequent shingles one a row; all others, most of them the only
    # one of their list, packed by bucket of hashes, sixteen buckets a partition.
    often = written(docs.select("text").mapInArrow(
        lambda it: _often_entries(it, words, percent, frequent), "h long, node long, np long"), "often")
    buckets = min(MOST_BUCKETS, 1 << (16 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    packed = docs.select("text").mapInArrow(
        lambda it: _packed_entries(it, words, percent, frequent, buckets),
        "bucket long, hs array<long>, nodes array<long>, small array<int>, wide array<long>").repartition("bucket")
    np_of = F.transform("small", lambda x: F.shiftleft(F.shiftright(x, 16).cast("long"), 32) + x.bitwiseAND(F.lit(0xFFFF)))
    postings = packed.select("bucket", F.inline(F.arrays_zip("hs", "nodes", F.coalesce("wide", np_of))).alias("h", "node", "np"))

    # Leaders of every list.  The lists of frequent shingles, at most FREQUENT
    # many, are summed up before the shuffle; the others are short.
    entry = F.struct("node", "np")
    swapped = F.struct(F.col("node").bitwiseXOR(F.lit(_XOR)).alias("node"), "np")
    stats = [F.min(entry).alias("l1"), F.max(entry).alias("l2"), F.min(swapped).alias("l3"),
             F.count(F.lit(1)).alias("size")]
    w = Window.partitionBy("bucket", "h")  # dealt by bucket already
    rare = postings.select("h", "node", "np", F.count(F.lit(1)).over(w).alias("size"),
                                              F.min(entry).over(w).alias("l1"), F.max(entry).over(w).alias("l2"),
                                              F.min(swapped).over(w).alias("l3")).where("size > 1")
    common = often.join(F.broadcast(often.groupBy("h").agg(*stats)), "h").where("size > 1")
    cols = ["h", "node", "np", "size", "l1", "l2", "l3"]
    live = written(rare.select(cols).unionByName(common.select(cols)).where("l1.node <> l2.node"), "lists", "zstd")

    # Pairs with leaders; in lists of up to three sets these are all pairs.
    other = F.struct(F.col("l3.node").bitwiseXOR(F.lit(_XOR)).alias("node"), F.col("l3.np").alias("np"))
    led = live.select("node", "np", "size", "l1", "l2", other.alias("l3")).select(
        "node", "np", "size", F.inline(F.filter(F.array(
            F.when(F.col("l1.node") != F.col("node"), F.col("l1")),
            F.when((F.col("l2.node") != F.col("node")) & (F.col("l1.node") != F.col("node")), F.col("l2")),
            F.when((F.col("l3.node") != F.col("l1.node")) & (F.col("l3.node") != F.col("l2.node"))
                   & (F.col("node") != F.col("l1.node")) & (F.col("node") != F.col("l2.node"))
                   & (F.col("node") != F.col("l3.node")), F.col("l3"))),
            lambda x: x.isNotNull())).alias("other", "other_np"))
    led = led.where(_possible(F.col("np"), F.col("other_np"), percent))
    pairs = written(
        _ordered(led, "node", "np", "other", "other_np", (F.col("size") <= 3).cast("long").alias("short"))
        .groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("c"), F.sum("short").alias("short")), "pairs")
    tried = written(pairs.where(_enough(F.col("c"), F.col("na"), F.col("nb"), percent)).select("a", "b"), "tried")
    linked = _linked(_texts(docs, nodes, tried, repeated), tried, words, percent, picked=True)
    groups = components(linked)

    # Lists that still hold several groups: rounds with several new leaders
    # each, since a set that misses one leader of its group seldom misses all.
    # The groups are named anew after every round, until one joins next to none.
    labelled = (live.where("size > 3").select("h", "node", "np", "size").join(small_side(groups, BROADCAST_ROWS), "node", "left")
                .select("h", "node", "np", F.coalesce("component", "node").alias("group"), "size"))
    mixed = _mixed(written(labelled, "labelled")).repartition("node").distinct()
    mixed = written(mixed.select("h", "node", "np", "group", _core(percent).alias("core")), "mixed")
    universe = mixed.select(F.col("group").alias("component"), F.col("group").alias("root")).distinct()
    universe = universe.union(groups.select("component", F.col("component").alias("root"))).distinct()
    pool = _texts(docs, nodes, mixed.select(F.col("node").alias("a"), F.col("node").alias("b")), repeated)
    prefixes = written(mixed.groupBy("node").agg(F.collect_list("h").alias("hs")), "prefixes")
    many, turn = mixed.select("group").distinct().count(), 0
    while many > 1:
        lead = mixed.groupBy("h").agg(*[
            F.min(F.struct(*_rank(k, mask), "node", "np", "group")).alias(f"l{k}")
            for k, mask in enumerate(_masks(turn))])
        led = mixed.join(lead, "h").select("node", "np", "group", F.inline(F.filter(
            F.array_distinct(F.array(*[F.struct(f"l{k}.node", f"l{k}.np", f"l{k}.group") for k in range(LEADERS)])),
            lambda x: x["group"] != F.col("group"))).alias("other", "other_np", "other_group"))
        led = led.where(_possible(F.col("np"), F.col("other_np"), percent))
        # A pair of sets always has the same groups, so either order of them does.
        named = [F.least("group", "other_group").alias("ga"), F.greatest("group", "other_group").alias("gb")]
        led = (_ordered(led, "node", "np", "other", "other_np", *named)
               .groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("c"), F.min("ga").alias("ga"), F.min("gb").alias("gb"))
               .where(_enough(F.col("c") * PART, F.col("na"), F.col("nb"), percent)).drop("c"))
        # A leader of some lists of a set is counted on all that they share.
        led = written(led.join(tried, ["a", "b"], "left_anti"), "led")
        again = written(_shared(led, prefixes).where(_enough(F.col("c"), F.col("na"), F.col("nb"), percent))
                        .select("a", "b", "ga", "gb"), "again")
        tried = tried.unionByName(again.select("a", "b"))
        links = _linked(pool, again, words, percent)
        joined = links.count()
        if joined:
            merged = _merged(links)
            universe = _renamed(universe, merged, "root")
            mixed = written(_mixed(written(_renamed(mixed, merged, "group"), "relabelled")), "mixed")
        turn += 1
        if joined * 20 < many:
            break
        many = mixed.select("group").distinct().count()

    met = written(_probe(mixed, pairs, prefixes, percent).join(tried, ["a", "b"], "left_anti"), "met")
    # Of every pair of groups a few pairs of sets at a time, more each time, first
    # those with most in common: what these join needs no further answers.  Names
    # are looked up once a pair of groups, not once a pair of sets.
    some, answers, before = 2, None, universe
    while not met.isEmpty():
        among = Window.partitionBy("ga", "gb").orderBy(F.desc("c"), F.xxhash64("a", "b"), "a", "b")
        ranked = written(met.withColumn("rank", F.row_number().over(among)), "ranked")
        links = _linked(pool, ranked.where(F.col("rank") <= some).drop("rank", "c"), words, percent)
        met = ranked.where(F.col("rank") > some).drop("rank")
        if not links.isEmpty():
            answers = links if answers is None else answers.unionByName(links)
            merged = _merged(answers)
            universe = _renamed(before, merged, "root")
            between = met.select("ga", "gb", F.col("ga").alias("root_a"), F.col("gb").alias("root_b")).distinct()
            same = _renamed(_renamed(between, merged, "root_a"), merged, "root_b").where("root_a = root_b").select("ga", "gb")
            met = met.join(small_side(written(same, "same"), BROADCAST_ROWS), ["ga", "gb"], "left_anti")
        met, some = written(met, "left"), some * 16

    # Smallest document id of every group, then back to the documents.
    rooted = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rooted = written(rooted.join(universe, "component", "left").select("node", "rep", F.coalesce("root", "component").alias("root")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.join(written(smallest, "smallest"), "root").select("node", "root", "component_id")
    return sig.join(named, "node", "left").select(
        "doc_id", "key", F.col("n").alias("n_shingles"), "root", F.coalesce("component_id", "doc_id").alias("component_id"))


def _probe(mixed: DataFrame, pairs: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, ga, gb, c) of sets of different groups that may link and that
    no leader has answered, with the number of prefix shingles they share.

    Sets are dealt by list and size band.  A set is listed once, in its own band,
    and as the smaller one of a pair it asks its own band and the higher ones that
    a linked set can be in, each up to the position that leaves the overlap with
    the least size there: the higher the band, the fewer positions.  All other
    entries are skipped before the join.
    """
    step = (100 / percent) ** (1 / BANDS)
    n, at = _n(F.col("np")), _pos(F.col("np"))
    banded = mixed.withColumn("band", F.floor(F.log(n) / F.log(F.lit(step)) + 1e-9))
    listed = banded.select("h", F.col("node").alias("y"), F.col("np").alias("py"), F.col("group").alias("gy"), "band")
    bands = F.filter(F.sequence(F.col("band"), F.col("band") + BANDS + 1), lambda b: (n - at) * (100 + percent) >= (
        n + F.greatest(n, F.floor(F.pow(F.lit(step), b) * (1 - 1e-6)))) * percent)
    probe = banded.select("h", F.col("node").alias("x"), F.col("np").alias("px"), F.col("group").alias("gx"), F.explode(bands).alias("band"))
    met = probe.join(listed, ["h", "band"]).where(
        (F.col("gx") != F.col("gy")) & _first(F.col("px"), F.col("py"), percent)
        & (F.struct(_n(F.col("px")), F.col("x")) < F.struct(_n(F.col("py")), F.col("y"))))
    named = [F.least("gx", "gy").alias("ga"), F.greatest("gx", "gy").alias("gb")]
    # The first common shingle may also stand in a list too short to be probed.
    grouped = mixed.select("node", "group").distinct()
    short = (pairs.where((F.col("short") > 0) & ~_enough(F.col("c"), F.col("na"), F.col("nb"), percent))
             .join(grouped.select(F.col("node").alias("a"), F.col("group").alias("gx")), "a")
             .join(grouped.select(F.col("node").alias("b"), F.col("group").alias("gy")), "b")
             .where("gx <> gy").select("a", "b", "na", "nb", *named))
    met = written(_ordered(met, "x", "px", "y", "py", *named).unionByName(short).distinct(), "met")
    return (_shared(met, prefixes).join(pairs.select("a", "b", "short"), ["a", "b"], "left")
            .withColumn("c", F.col("c") + F.coalesce("short", F.lit(0)))
            .where(_enough(F.col("c"), F.col("na"), F.col("nb"), percent)).select("a", "b", "ga", "gb", "c"))


def _masks(turn: int) -> list[int]:
    """Each mask orders the sets of a list anew; the first in each order leads."""
    return [((turn * LEADERS + k) * 0x1F83D9ABFB41BD6B + 0x3C6EF372FE94F82B) % (1 << 63) for k in range(LEADERS)]


def _shared(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``pairs(a, b, na, nb, ga, gb)`` with the number of prefix shingles in common."""
    return (pairs.join(prefixes.select(F.col("node").alias("a"), F.col("hs").alias("ha")), "a")
            .join(prefixes.select(F.col("node").alias("b"), F.col("hs").alias("hb")), "b")
            .select("a", "b", "na", "nb", "ga", "gb", F.size(F.array_intersect("ha", "hb")).alias("c")))


def _core(percent: int):
    """How near a set stands to the core of its near copies: the mean size of the
    lists of its prefix, a shingle in no such list counted as 0, as a logarithm.
    The copy with the fewest changes of its own has the most."""
    n = _n(F.col("np"))
    lists = F.sum("size").over(Window.partitionBy("node"))
    return F.log(lists / (n - F.ceil(n * percent / 100) + 1)).cast("float")


def _rank(k: int, mask: int) -> list:
    """What makes a set leader ``k`` of its lists: the first in the core, any of
    those near it, any set at all.  It orders sets, not entries, so a leader leads
    most of the lists that it shares with a set."""
    key = F.col("node").bitwiseXOR(F.lit(mask)).alias("key")
    if k < len(CORE):
        return [(-F.floor(F.col("core") * CORE[k])).alias("core"), key]
    return [key]


def _ordered(df: DataFrame, x: str, px: str, y: str, py: str, *more) -> DataFrame:
    """Pairs as (a, b, na, nb) with a < b."""
    low = F.col(x) < F.col(y)
    nx, ny = _n(F.col(px)), _n(F.col(py))
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"),
                     F.when(low, nx).otherwise(ny).alias("na"), F.when(low, ny).otherwise(nx).alias("nb"), *more)


def _mixed(lists: DataFrame) -> DataFrame:
    """The entries of the (written) lists that hold more than one group."""
    several = written(lists.groupBy("h").agg(F.min("group").alias("g1"), F.max("group").alias("g2"))
                      .where("g1 <> g2").select("h"), "several")
    return lists.join(small_side(several, BROADCAST_ROWS), "h")


def _merged(links: DataFrame) -> DataFrame:
    """Groups that ``links(ga, gb)`` joins, as (component, merged)."""
    return components(links.select(F.col("ga").alias("a"), F.col("gb").alias("b"))).select(
        F.col("node").alias("component"), F.col("component").alias("merged"))


def _renamed(df: DataFrame, merged: DataFrame, column: str) -> DataFrame:
    """``df`` with the groups in ``column`` under their new names."""
    return (df.join(small_side(merged.withColumnRenamed("component", column), BROADCAST_ROWS), column, "left")
            .withColumn(column, F.coalesce("merged", column)).select(*df.columns))


def _texts(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, repeated: bool) -> DataFrame:
    """(node, text) of the nodes in ``pairs(a, b)``.  Only where rows are
    ``repeated`` can a key fetch a text several times."""
    used = written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
                   .join(nodes.select("node", "key"), "node"), "candidates")
    texts = docs.join(small_side(used, BROADCAST_ROWS), "key").select("node", "text")
    return written(texts.dropDuplicates(["node"]) if repeated else texts, "texts", "zstd")


def _linked(texts: DataFrame, pairs: DataFrame, words: int, percent: int, picked: bool = False) -> DataFrame:
    """Of ``pairs(a, b, ...)`` of nodes those that reach the similarity, on whole
    sets: their groups (ga, gb), or a and b where pairs name none.  ``picked``:
    texts holds no others."""
    groups = ["ga", "gb"] if "ga" in pairs.columns else ["a", "b"]
    if not picked:
        used = written(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "used")
        texts = texts.join(small_side(used, BROADCAST_ROWS), "node", "leftsemi")
    both = (pairs.select("a", "b", *[F.col(c).alias(f"g{k}") for k, c in enumerate(groups)])
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text_a", "text_b", "g0", "g1"))
    return written(both.mapInArrow(lambda it: _verify(it, words, percent), f"{groups[0]} long, {groups[1]} long").distinct(), "links")
