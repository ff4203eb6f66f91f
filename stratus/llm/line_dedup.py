"""Cross-site boilerplate lines by distinct-site spread.

Every line is hashed; a HyperLogLog sketch of the sites (sources) that show it
is kept per line hash and merged by aggregation.  Lines whose estimate is far
above the threshold are boilerplate, far below are not; for the lines near it
the distinct sites are counted exactly.  Boilerplate lines are then removed
from every document.

A line is what stands between newlines, without spaces, tabs and carriage
returns at its ends; lines are told apart by 64-bit hashes.

Defined cases: a null text has no lines and stays null; empty lines are never
boilerplate; a null source is a site of its own; repeated rows are treated one
by one and alike; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.llm.common import small_side, written
from stratus.llm.spans import let

#: A line shown by at least so many sites is boilerplate.
MIN_SITES = 8
#: Sketch size (log2 of registers) and how far, relative to the threshold and
#: two sites at least, an estimate may be off: six standard errors.
LOG_K, SLACK = 12, 0.1
#: As many line hashes (one long each) are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def _hashes(text):
    """Hashes of a text's lines, null for an empty line."""
    return F.transform(F.split(text, "\n", -1), lambda x: F.when(
        F.btrim(x, F.lit(" \t\r")) != "", F.xxhash64(F.btrim(x, F.lit(" \t\r")))))


def boilerplate_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Hashes (line) of the lines that at least ``min_sites`` sources show."""
    lines = docs.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("site"),
                        F.explode(_hashes(F.col("text"))).alias("line")).where("line is not null")
    spread = lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_K))).alias("sites"))
    slack = max(2.0, SLACK * min_sites)
    wide = written(spread.where(F.col("sites") >= min_sites - slack), "spread")
    near = small_side(wide.where(F.col("sites") <= min_sites + slack).select("line"), BROADCAST_ROWS)
    exact = (lines.join(near, "line").groupBy("line").agg(F.countDistinct("site").alias("sites"))
             .where(F.col("sites") >= min_sites).select("line"))
    return wide.where(F.col("sites") > min_sites + slack).select("line").unionByName(exact)


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, n_lines, n_removed and the text without its boilerplate lines."""
    docs = docs.select("doc_id", "text", "source")
    bad = small_side(written(boilerplate_lines(docs, min_sites), "boilerplate"), BROADCAST_ROWS)
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("content"))
    found = (keyed.select("doc_id", "content", F.posexplode(_hashes(F.col("text"))).alias("at", "line"))
             .where("line is not null").join(bad, "line")
             .groupBy("doc_id", "content").agg(F.collect_set("at").alias("drop")))
    found = found.select(F.col("doc_id").alias("id"), F.col("content").alias("same"), F.array_sort("drop").alias("drop"))
    lines = F.split("text", "\n", -1)
    # What stands between one dropped line and the next is taken as a slice.
    edges = F.concat(F.array(F.lit(-1)), "drop", F.array(F.size(lines)))
    kept = let(F.struct(lines.alias("lines"), edges.alias("edges")), lambda s: F.flatten(F.zip_with(
        F.slice(s["edges"], F.lit(1), F.size(s["edges"]) - 1), F.slice(s["edges"], F.lit(2), F.size(s["edges"]) - 1),
        lambda a, b: F.slice(s["lines"], a + 2, b - a - 1))))
    return (keyed.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("content") == F.col("same")), "left")
            .select("doc_id", F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
                    F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_removed"),
                    F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")))


SQL = r"""
WITH l AS (
  SELECT coalesce('s' || source, 'n') AS site, trim(unnest(string_split(text, chr(10))), chr(32) || chr(9) || chr(13)) AS line
  FROM documents WHERE text IS NOT NULL),
bad AS (SELECT list(line) AS lines FROM (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= 8)),
d AS (SELECT doc_id, text, string_split(text, chr(10)) AS all_lines,
             list_filter(string_split(text, chr(10)),
                         lambda x: NOT list_contains(coalesce(lines, []), trim(x, chr(32) || chr(9) || chr(13)))) AS kept
      FROM documents, bad)
SELECT doc_id, coalesce(len(all_lines), 0)::BIGINT AS n_lines,
       coalesce(len(all_lines) - len(kept), 0)::BIGINT AS n_removed,
       array_to_string(kept, chr(10)) AS text
FROM d
"""
