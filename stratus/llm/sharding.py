"""Uniform shuffle of documents into shards of exact size, by a hypergeometric
communication matrix.

Rows fall into source blocks by a hash of all their columns.  How many rows of
each block go to each shard is drawn from the multivariate hypergeometric law,
block by block against the room that is left, so that shard sizes come out
exactly (``rows`` law: counts at most one apart) and every placing of rows into
shards is equally likely.  Rows are permuted inside their block, dealt out by
the block's counts, exchanged, and permuted again inside their shard.

The matrix has ``blocks`` times ``shards`` counts whatever the input; it is the
only thing that is drawn on the driver.  Slots are numbered by ranges of the
second permutation's key, so no task holds a whole shard.

Defined cases: a null text has size 16 and a null CRC; null ids, empty texts
and other columns are carried and take part in the hash; repeated rows are
placed one by one (which of two equal rows goes where makes no difference to
the result); an empty table gives no rows.  The same rows, seed and numbers of
blocks and shards give the same result in any order of reading.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratus.llm.common import written

#: Source blocks and, per shard, ranges of the second permutation.
BLOCKS, RANGES = 256, 64


def draw(rng: random.Random, good: int, bad: int, taken: int) -> int:
    """Hypergeometric draw: how many of ``taken`` rows come from ``good`` of
    ``good + bad``.  Inversion from the mode outward, so a draw costs a few
    standard deviations of steps at any size."""
    low, high = max(0, taken - bad), min(good, taken)
    if low == high:
        return low
    mode = min(high, max(low, (good + 1) * (taken + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(log_choose(good, mode) + log_choose(bad, taken - mode) - log_choose(good + bad, taken))
    u = rng.random() - at_mode
    if u < 0:
        return mode
    up, down, p_up, p_down = mode, mode, at_mode, at_mode
    while up < high or down > low:
        if up < high:
            p_up *= (good - up) * (taken - up) / ((up + 1) * (bad - taken + up + 1))
            up += 1
            u -= p_up
            if u < 0:
                return up
        if down > low:
            p_down *= down * (bad - taken + down) / ((good - down + 1) * (taken - down + 1))
            down -= 1
            u -= p_down
            if u < 0:
                return down
    return mode


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows of every block that go to every shard; columns sum to the shards'
    sizes, which are at most one apart."""
    total = sum(counts)
    room = [total // shards + (k < total % shards) for k in range(shards)]
    rng, out = random.Random(seed), []
    for n in counts:
        rest, line = sum(room), []
        for k in range(shards):
            rest -= room[k]
            x = draw(rng, room[k], rest, n)
            line.append(x)
            n -= x
        room = [r - x for r, x in zip(room, line)]
        out.append(line)
    return out


def shard_rows(rows: DataFrame, shards: int = 40, seed: int = 20, blocks: int = BLOCKS) -> DataFrame:
    """``rows`` with the columns shard (int) and slot (long, gapless from 0)."""
    spark = rows.sparkSession
    columns = [F.col(f"`{c}`") for c in rows.columns]

    def key(k: int):
        return F.xxhash64(F.lit(seed * 3 + k), *columns)

    keyed = written(rows.select(*columns, F.pmod(key(0), F.lit(blocks)).cast("int").alias("__block"),
                                key(1).alias("__first"), key(2).alias("__second")), "keyed")
    counts = dict(keyed.groupBy("__block").count().collect())  # at most ``blocks`` rows
    lines = communication_matrix([counts.get(b, 0) for b in range(blocks)], shards, seed)
    ends = []
    for line in lines:
        ends.append([sum(line[:k + 1]) for k in range(shards)])
    matrix = spark.createDataFrame(list(enumerate(ends)), "__block int, __ends array<bigint>")
    w = Window.partitionBy("__block").orderBy("__first", *columns)
    placed = written(
        keyed.withColumn("__rank", F.row_number().over(w)).join(F.broadcast(matrix), "__block")
        .withColumn("shard", F.size(F.filter("__ends", lambda e: e < F.col("__rank"))))
        .withColumn("__range", F.shiftrightunsigned("__second", 58).cast("int"))
        .select(*columns, "shard", "__range", "__second"), "placed")
    ahead = Window.partitionBy("shard").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("shard", "__range").count()
               .select("shard", "__range", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("__ahead")))
    w = Window.partitionBy("shard", "__range").orderBy("__second", *columns)
    return (placed.withColumn("__rank", F.row_number().over(w))
            .join(F.broadcast(offsets), ["shard", "__range"])
            .select(*columns, "shard", (F.col("__ahead") + F.col("__rank") - 1).cast("long").alias("slot")))


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 20) -> DataFrame:
    """Every document with its size, text CRC, shard and slot; texts stay put."""
    thin = docs.select(
        F.col("doc_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"))
    placed = shard_rows(thin, shards, seed)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
