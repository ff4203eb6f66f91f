"""Mixing sources to target weights by systematic sampling.

Sources share all words by weight; a target stops at ``most`` times its
source's words and the excess is shared again by weight until none is above
(water filling over the sources table).  Every document then expects
``target / source words`` copies.  These are prefix-summed within the source,
one offset per source is added, and a document is emitted once for every
integer boundary that its stretch crosses.  Documents are lined up by size
(eight bands to a power of two), then by a slice of their id, so that every stretch of the line
has its share of long and short texts and the words come out near the target.

The prefix sums run over blocks (source, size band, slice): counts of blocks
give each block's start, and only a block is ranked in one task, so a source
with a third of all rows is spread like any other.

Defined cases: a null text has no words; a null source is a source of its own
and sorts last; a source without words has target 0 and gives nothing; repeated
rows are drawn one by one; an empty table gives no rows; other columns are
carried whatever their names.  The same rows give the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratus.llm.common import SPACE_CLASS, small_side, written

#: Slices that a size band of a source is ranked in.
SLICES = 16


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_CLASS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], most: int = 3) -> DataFrame:
    """``sizes(src, named, source_size)``, one row per source, with ``target``.

    Windows without a partition run over one row per source, not per document.
    """
    by_name = Window.orderBy(F.col("named").isNull(), "named")
    w = sizes.withColumn("weight", F.element_at(
        F.array(*[F.lit(x) for x in weights]),
        (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("named").isNull(), "named")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    w = w.select("*", (F.sum("source_size").over(everything)
                       - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("left"),
                 F.sum("weight").over(onward).alias("share"))
    # The first source, from the least words per weight, whose share fits under its stop.
    w = w.withColumn("fits", F.col("left") * F.col("weight") <= most * F.col("source_size") * F.col("share"))
    level = F.min(F.when(F.col("fits"), F.struct(F.col("source_size") / F.col("weight"), F.col("named").isNull(),
                                                 "named", "left", "share"))).over(everything)
    w = w.withColumn("level", level).withColumn("capped", ~F.max("fits").over(by_ratio))
    return w.select("src", "source_size", F.when(F.col("capped"), (most * F.col("source_size")).cast("double"))
                    .otherwise(F.col("level.left").cast("double") * F.col("weight") / F.col("level.share"))
                    .alias("target"))


def systematic_copies(docs: DataFrame, weights: list[int] | None = None, most: int = 3, seed: str = "mix") -> DataFrame:
    """``docs`` with the columns __size, __source_size, __target, __copies."""
    carried = [F.col(f"`{c}`") for c in docs.columns]
    sized = docs.select(
        *carried, word_count(F.col("text")).alias("__size"), F.col("source").alias("__named"),
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("__src"),
        F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(SLICES)).cast("int").alias("__slice"))
    sized = sized.withColumn("__bits", F.length(F.bin("__size"))).withColumn(
        "__band", F.expr("__bits * 8 + (shiftright(__size, greatest(__bits - 4, 0)) & 7)")).drop("__bits")
    block = ["__src", "__band", "__slice"]
    blocks = written(sized.groupBy("__named", *block).agg(F.count(F.lit(1)).alias("rows"), F.sum("__size").alias("words")),
                     "blocks")
    sizes = blocks.groupBy(F.col("__src").alias("src"), F.col("__named").alias("named")).agg(
        F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights or [1, 2, 3], most)
    ahead = Window.partitionBy("__src").orderBy("__band", "__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (blocks.withColumn("__ahead", F.coalesce(F.sum("rows").over(ahead), F.lit(0)))
              .join(targets, F.col("__src") == F.col("src"))
              .select(*block, "__ahead", F.col("source_size").alias("__source_size"), F.col("target").alias("__target")))
    starts = small_side(written(starts, "starts"), 100_000)
    rank = F.row_number().over(Window.partitionBy(*block).orderBy(
        "__size", "doc_id", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), "__src")), 1, 8), 16, 10).cast("double") / 4294967296.0
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(0.0)
    return (sized.withColumn("__rank", rank).join(starts, block)
            .withColumn("__k", (F.col("__ahead") + F.col("__rank")).cast("double"))
            .withColumn("__copies", F.floor(rate * F.col("__k") + offset) - F.floor(rate * (F.col("__k") - 1) + offset))
            .select(*carried, "__size", "__source_size", "__target", "__copies"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it was drawn, with the
    columns of ``docs``."""
    drawn = systematic_copies(docs).where("__copies > 0")
    return drawn.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def mix_report(docs: DataFrame) -> DataFrame:
    """Per document what the mix takes of it."""
    thin = docs.select("doc_id", "text", "source")
    return systematic_copies(thin).select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).cast("long").alias("taken"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(doc_id, 0) % 16 AS slice, text
  FROM documents),
s AS (SELECT src, source, sum(size)::BIGINT AS source_size FROM d GROUP BY src, source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source IS NULL, source COLLATE "binary") - 1) % 3 + 1)::BIGINT AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY source_size / weight, source IS NULL, source) AS k,
             sum(source_size) OVER () AS total FROM w),
c AS (SELECT *, total - 3 * coalesce(sum(source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
             sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM o),
f AS (SELECT min(k) AS k FROM c WHERE remaining * weight <= 3 * source_size * share),
t AS (SELECT c.src, c.source_size,
             CASE WHEN c.k < f.k THEN (3 * c.source_size)::DOUBLE
                  ELSE (l.remaining::DOUBLE * c.weight::DOUBLE) / l.share::DOUBLE END AS target
      FROM c, f JOIN c l ON l.k = f.k),
r AS (SELECT doc_id, d.src, size, row_number() OVER (PARTITION BY d.src ORDER BY length(bin(size)) * 8 + ((size >> greatest(length(bin(size)) - 4, 0)) & 7), slice, size, doc_id)::DOUBLE AS k FROM d),
u AS (SELECT r.*, source_size, target,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
             ('0x' || md5('mix' || r.src)[1:8])::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS shift
      FROM r JOIN t ON r.src = t.src)
SELECT doc_id, size, source_size, target,
       ((floor(rate * k + shift) - floor(rate * (k - 1) + shift)) * size)::BIGINT AS taken
FROM u
"""
