"""Embedding near-dedup by spherical-cap filters.

Equal vectors of one label fall into one node.  Node vectors are scaled to
length one and turned by a fixed random rotation.  Filter directions form a
*product code*: the space is cut into four blocks, each block has ``k`` random
directions, and every choice of one direction per block is a filter, ``k**4`` in
all.  A vector belongs to all filters whose direction it exceeds by a threshold;
they are listed without looking at the others, from sorted sums of two blocks
each.  Vectors that share a filter (and label) are candidates, and their cosine
is computed in double precision.

``k`` grows with the fourth root of the number of nodes, so a filter holds about
as many vectors at any size, and the threshold is the normal quantile that gives
``PER_VECTOR`` filters to a vector on average; a vector that exceeds fewer than
``LEAST`` takes its ``LEAST`` best ones.  No bucket is capped.  Recall against
brute force is measured in the tests and stated in the README.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite
components, or whose label is null, links with nothing; vectors of different
lengths never link; equal vectors link (cosine one); rows with equal ids are
vectors of their own; a null id has a null component and is not kept; an empty
table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import components, small_side, written

BLOCKS, PER_VECTOR, LEAST, SEED = 4, 20.0, 6, 11
BROADCAST_ROWS = 1_000_000


def _code(dim: int, k: int):
    """Rotation and, per block, its first column and ``k`` directions."""
    rng = np.random.default_rng(SEED + dim)
    turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    edges = np.linspace(0, dim, BLOCKS + 1).astype(int)
    books = []
    for a, b in zip(edges[:-1], edges[1:]):
        d = rng.standard_normal((max(b - a, 1), k))
        books.append(d / np.linalg.norm(d, axis=0) * np.sqrt(max(b - a, 1)))
    return turn, edges, books


def list_filters(vector_blocks: list[np.ndarray], threshold: float, least: int) -> np.ndarray:
    """Numbers of the filters whose score exceeds ``threshold``, or of the
    ``least`` best: the sorted sums of the last two blocks are cut by binary
    search for each sum of the first two."""
    k = len(vector_blocks[0])
    left = (vector_blocks[0][:, None] + vector_blocks[1][None, :]).ravel()
    right = (vector_blocks[2][:, None] + vector_blocks[3][None, :]).ravel()
    order = np.argsort(-right)
    falling = right[order]
    while True:
        rows = np.flatnonzero(left + falling[0] >= threshold)
        counts = np.searchsorted(-falling, left[rows] - threshold, side="right")
        total = int(counts.sum())
        if total >= min(least, k ** BLOCKS):
            break
        threshold -= 0.25
    take = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    out = np.repeat(rows, counts).astype(np.int64) * (k * k) + order[take]
    return out


def _filters(batches: Iterator[pa.RecordBatch], k: int, threshold: float) -> Iterator[pa.RecordBatch]:
    codes: dict[int, tuple] = {}
    for batch in batches:
        ids, labels, found = [], [], []
        for row in range(batch.num_rows):
            v = np.array(batch.column(2)[row].values.to_numpy(zero_copy_only=False), np.float64)
            if len(v) not in codes:
                codes[len(v)] = _code(len(v), k)
            turn, edges, books = codes[len(v)]
            v = (v / np.linalg.norm(v)) @ turn
            scores = [v[a:b] @ c if b > a else np.zeros(k) for a, b, c in zip(edges[:-1], edges[1:], books)]
            f = list_filters(scores, threshold, LEAST)
            found.append(f)
            ids.append(np.full(len(f), batch.column(0)[row].as_py(), np.int64))
            labels.append(np.full(len(f), row))
        if ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ids)), batch.column(1).take(pa.array(np.concatenate(labels))),
                 pa.array(np.concatenate(found))], names=["node", "label", "filter"])


def _close(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, keep = batch.num_rows, []
        a, b = batch.column(2), batch.column(3)
        for lo in range(0, n, 4096):
            hi = min(n, lo + 4096)
            pairs = [(a[r].values.to_numpy(zero_copy_only=False), b[r].values.to_numpy(zero_copy_only=False)) for r in range(lo, hi)]
            keep += [len(x) == len(y) and _cosine(x, y) >= least for x, y in pairs]
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])


def _cosine(x, y) -> float:
    x, y = x.astype(np.float64), y.astype(np.float64)
    return float(x @ y / np.sqrt((x @ x) * (y @ y)))


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, per_vector: float = PER_VECTOR) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    e = F.col("embedding")
    usable = (F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0)
              & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
              & F.exists(e, lambda v: v != 0))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").withColumn(
        "node", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", "embedding")))
    nodes = written(rows.where("node is not null").groupBy("node").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"),
        F.first("embedding").alias("embedding")), "nodes")
    many = nodes.count()
    k = max(2, round(max(many, 1) ** (1 / BLOCKS)))
    # A block direction has the block's length, so the scores of random
    # vectors of length one have variance one per block.
    share = min(0.5, per_vector / k ** BLOCKS)
    threshold = NormalDist().inv_cdf(1 - share)
    label = vectors.schema["label"].dataType.simpleString()
    caught = nodes.select("node", "label", "embedding").mapInArrow(
        lambda it: _filters(it, k, threshold), f"node long, label {label}, filter long")
    caught = written(caught, "filters")
    pairs = (caught.withColumnRenamed("node", "a").join(caught.withColumnRenamed("node", "b"), ["label", "filter"])
             .where("a < b").select("a", "b").distinct())
    held = nodes.select("node", "embedding")
    links = written(
        pairs.join(held.select(F.col("node").alias("a"), F.col("embedding").alias("x")), "a")
        .join(held.select(F.col("node").alias("b"), F.col("embedding").alias("y")), "b").select("a", "b", "x", "y")
        .mapInArrow(lambda it: _close(it, cosine), "a long, b long"), "links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = (both.join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node"))
              .agg(F.sum("copies").alias("others")))
    groups = nodes.select("node", "rep", "copies").join(components(links), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    smallest = groups.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = (groups.join(smallest, "component").join(linked, "node", "left")
             .select("node", "component_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    named = small_side(written(named, "named"), BROADCAST_ROWS)
    return rows.join(named, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
