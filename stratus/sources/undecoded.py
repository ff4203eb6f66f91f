"""Undecoded report CSVs (``WMOIND YEAR MONTH DAY HOUR MIN REPORT``).

* header row; each column looked up by its upper-case then its lower-case
  name only, missing -> ``''``; values trimmed; empty ``MIN`` reads as ``0``
  later (lenient parse);
* ``"`` quoting with doubled quotes; malformed UTF-8 replaced; blank lines
  skipped;
* a quoted value may hold line breaks, also where a file is read in several
  splits (see ``_records``); a quote that no later line closes reaches to the
  end of its own line;
* separator per file: ``sep='auto'`` picks, among ``, ; TAB |``, the one
  that occurs most in the first 4,096 characters of the file (ties go to the
  first in that order).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratus.functions.scalars import _c, csv_fields, last_index, strip_ws
from stratus.schemas import RAW_COLUMNS
from stratus.session import fence, scratch_path

SEPARATORS = [",", ";", "\t", "|"]
SAMPLE_CHARS = 4096
#: A code point that Unicode keeps out of text.
NO_CHARACTER = "\uffff"


def detect_separators(spark: SparkSession, path: str) -> DataFrame:
    """``file_path sep`` for every file under ``path``.

    Only the first split of each file is looked at, and within it at most the
    first 4,096 lines (a line has at least one character with its newline), so
    the sample is bounded per file.  Line terminators count as one character.
    """
    lines = (spark.read.text(path)
             .where(F.col("_metadata.file_block_start") == 0)
             .select(F.col("_metadata.file_path").alias("file_path"),
                     F.monotonically_increasing_id().alias("pos"), "value"))
    starts = lines.groupBy("file_path").agg(F.min("pos").alias("first_pos"))
    head = (lines.join(starts, "file_path")
            .where(F.col("pos") - F.col("first_pos") < SAMPLE_CHARS))
    w = Window.partitionBy("file_path").orderBy("pos") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    width = F.length("value") + 1
    head = head.withColumn("offset", F.sum(width).over(w) - width) \
        .where(F.col("offset") < SAMPLE_CHARS) \
        .withColumn("part", F.expr(f"substring(value, 1, {SAMPLE_CHARS} - offset)"))
    counts = head.groupBy("file_path").agg(
        F.min_by("value", F.when(strip_ws(F.col("value")) != "", F.col("pos"))).alias("header"),
        *[F.sum(F.length("part") - F.length(F.replace(F.col("part"), F.lit(s), F.lit(""))))
          .alias(f"n{i}") for i, s in enumerate(SEPARATORS)])
    best = F.greatest(*[F.col(f"n{i}") for i in range(len(SEPARATORS))])
    choice = F.when(F.col("n0") == best, F.lit(SEPARATORS[0]))
    for i, s in enumerate(SEPARATORS[1:], start=1):
        choice = choice.when(F.col(f"n{i}") == best, F.lit(s))
    return counts.select("file_path", choice.alias("sep"), "header")


def first_lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``file_path header opens``: every file's first non-blank line and whether
    a line of it leaves a quote open, in one pass."""
    lines = (spark.read.text(path).where(strip_ws(F.col("value")) != "")
             .select(F.col("_metadata.file_path").alias("file_path"), "value",
                     F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at")))
    return lines.groupBy("file_path").agg(F.min_by("value", "at").alias("header"), F.max(_opens("value", sep)).alias("opens"))


def _opens(line, sep: str) -> Column:
    """Whether a line that starts outside quotes ends inside: after fields that
    are closed (quoted, or not starting with a quote) comes one that is not."""
    c, e = _c(line), re.escape(sep)
    field = rf'(?:"(?:[^"]++|"")*+"[^{e}]*+|[^"{e}][^{e}]*+)?+'
    return c.contains('"') & F.regexp_like(c, F.lit(rf'^(?:{field}{e})*+"(?:[^"]++|"")*+$'))


def _heads(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``file_path sep header opens`` of every file under ``path``."""
    if sep != "auto":
        return first_lines(spark, path, sep).withColumn("sep", F.lit(sep))
    opens = (spark.read.text(path).where(F.col("value").contains('"'))
             .groupBy(F.col("_metadata.file_path").alias("file_path"))
             .agg(F.array(*[F.max(_opens("value", s)) for s in SEPARATORS]).alias("by_sep")))
    at = F.array_position(F.array(*map(F.lit, SEPARATORS)), F.col("sep")).cast("int")
    return (detect_separators(spark, path).join(opens, "file_path", "left")
            .select("file_path", "sep", "header", F.coalesce(F.try_element_at("by_sep", at), F.lit(False)).alias("opens")))


def _by_separator(line: str, sep: str):
    """The fields of ``line`` by its row's separator."""
    if sep != "auto":
        return csv_fields(line, sep)
    out = csv_fields(line, SEPARATORS[0])
    for s in SEPARATORS[1:]:
        out = F.when(F.col("sep") == s, csv_fields(line, s)).otherwise(out)
    return out


def _layouts(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Per file its separator and the position (from 1) of every raw column."""
    names = F.transform(_by_separator("header", sep), lambda x, i: F.when(i == 0, F.ltrim(x, F.lit("\ufeff"))).otherwise(x))
    heads = fence(_heads(spark, path, sep).withColumn("names", names), ["names"])
    at = [(F.coalesce(last_index(F.col("names"), c.upper()), last_index(F.col("names"), c.lower())) + 1)
          .alias(f"at_{c}") for c in RAW_COLUMNS]
    return heads.select("file_path", "sep", "opens", *at)


def _data_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file_path line``: every non-blank line but each file's header, which
    the CSV source leaves out itself.  Its separator is a character that no
    text holds and quoting is off, so a line stays whole."""
    return (spark.read.schema("line STRING").option("header", True).option("enforceSchema", True)
            .option("sep", NO_CHARACTER).option("quote", "").option("escape", "").option("encoding", "UTF-8")
            .csv(path).select("line", F.col("_metadata.file_path").alias("file_path")))


def _walk(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``df`` with ``before`` and ``after``: whether a quote is open there, as
    far as it is known inside a group, and ``flips`` to add to what is not.

    Column ``fixed`` is the state a row leaves behind whatever came before it
    (null if that matters) and ``flip`` whether it then turns the state round.
    States compose: the last fixed one, turned by the flips after it.
    """
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("turned", F.sum("flip").over(upto))
    df = df.withColumn("base", F.when(F.col("fixed").isNotNull(), (F.col("fixed") + F.col("turned")) % 2))
    return df.select("*", F.last("base", True).over(ahead).alias("base_before"), F.last("base", True).over(upto).alias("base_after"),
                     (F.col("turned") - F.col("flip")).alias("turned_before"))


def _records(spark: SparkSession, path: str, layouts: DataFrame) -> DataFrame:
    """``file_path line`` of the files in which some line leaves a quote open:
    lines, and the lines of a record that a quoted line break parts joined again.

    Whether a line starts inside quotes depends on all lines before it in the
    file.  Every split is walked by one task, as a function of the state it
    starts in; the splits of a file, one row each, are then put in order, which
    gives every split its state and the record that reaches into it.  Only lines
    of parted records are brought together.
    """
    lines = (spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("pos"), F.make_valid_utf8("value").alias("line"))
        .join(layouts.where("opens").select("file_path", "sep"), "file_path"))
    outside, inside = F.lit(False), F.lit(False)
    for s in SEPARATORS:
        mine = F.col("sep") == s
        outside = F.when(mine, _opens("line", s)).otherwise(outside)
        inside = F.when(mine, _opens(F.concat(F.lit('"'), "line"), s)).otherwise(inside)
    lines = lines.select("file_path", "split", "pos", "line", outside.alias("out"), inside.alias("in"))
    lines = lines.select("*", F.when(F.col("out") == F.col("in"), F.col("out").cast("int")).alias("fixed"),
                         (F.col("out") & ~F.col("in")).cast("int").alias("flip"))
    walked = _walk(lines, ["file_path", "split"], "pos")

    # One row a split: what it makes of the state it starts in.
    ends = walked.groupBy("file_path", "split").agg(F.max_by(F.struct("base_after", "turned"), "pos").alias("end"))
    ends = ends.select("file_path", "split", ((F.col("end.base_after") + F.col("end.turned")) % 2).alias("fixed"),
                       F.when(F.col("end.base_after").isNull(), F.col("end.turned") % 2).otherwise(0).alias("flip"))
    ends = _walk(ends, ["file_path"], "split")
    state = F.coalesce("base_before", F.lit(0)) + F.col("turned_before")
    last = (F.coalesce("base_after", F.lit(0)) + F.col("turned")) % 2
    starts = ends.select("file_path", "split", (state % 2).alias("at_start"),
                         F.max_by(last, "split").over(Window.partitionBy("file_path")).alias("left_open"))

    lines = walked.join(starts, ["file_path", "split"])
    before = (F.coalesce("base_before", "at_start") + F.col("turned_before")) % 2 == 1
    at = F.struct("split", "pos")
    lines = lines.select("file_path", "split", "pos", "line", "left_open", before.alias("before"),
                         F.when(before, F.col("in")).otherwise(F.col("out")).alias("after"),
                         F.when(~before, at).alias("start"))
    here = Window.partitionBy("file_path", "split").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("record", F.last("start", True).over(here))
    reach = lines.groupBy("file_path", "split").agg(F.max("start").alias("latest"), F.min(F.when(strip_ws(F.col("line")) != "", at)).alias("first"))
    by_split = Window.partitionBy("file_path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file_path")
    reach = reach.select("file_path", "split", F.last("latest", True).over(by_split).alias("carried"),
                         F.max("latest").over(whole).alias("last"), F.min("first").over(whole).alias("header"))
    lines = lines.join(reach, ["file_path", "split"]).withColumn("record", F.coalesce("record", "carried"))
    never = (F.col("left_open") == 1) & (F.col("record") == F.col("last"))
    lines = lines.withColumn("parted", (F.col("before") | F.col("after")) & ~never)
    alone = lines.where("not parted").where(strip_ws(F.col("line")) != "").where(at != F.col("header")).select("file_path", "line")
    joined = (lines.where("parted and record <> header").groupBy("file_path", "record")
              .agg(F.array_sort(F.collect_list(F.struct("split", "pos", "line"))).alias("parts"))
              .select("file_path", F.array_join(F.col("parts.line"), "\n").alias("line")))
    return alone.unionByName(joined)


def _read(spark: SparkSession, path: str, sep: str, multiline: bool) -> DataFrame:
    """One scan of the lines, joined to the small table of layouts.  That table
    is written first (one narrow row per file), so Spark knows its size when it
    chooses the join and the lines are not shuffled while it is small.  Files in
    which a line leaves a quote open are put together from records."""
    where = scratch_path(spark, "layouts")
    made = _layouts(spark, path, sep)
    made.write.parquet(where)
    layouts = spark.read.schema(made.schema).parquet(where)
    names = layouts.drop("opens")
    if multiline and not layouts.where("opens").isEmpty():
        rows = _data_lines(spark, path).join(layouts.where("not opens").drop("opens"), "file_path").unionByName(
            _records(spark, path, layouts).join(names, "file_path").select("file_path", "line", *names.columns[1:]))
    else:
        rows = _data_lines(spark, path).join(names, "file_path")
    rows = fence(rows.withColumn("fields", _by_separator("line", sep)), ["fields"])
    return rows.select(*[strip_ws(F.coalesce(F.try_element_at("fields", F.col(f"at_{c}")), F.lit(""))).alias(c)
                         for c in RAW_COLUMNS], "file_path")


def read_undecoded_csv(spark: SparkSession, path, sep: str = "auto",
                       keep_file: bool = False, multiline: bool = True) -> DataFrame:
    """The raw report table from one or more CSV files (all strings).

    The header, a file's first non-blank line, names its columns; separator
    (detected with ``sep='auto'`` only) and column positions are found per file
    and joined to the lines, so files of any layouts are read by one scan.
    Quoted values may hold line breaks, read as newlines; with
    ``multiline=False`` every line is a record.
    """
    paths = [path] if isinstance(path, str) else list(path)
    out = _read(spark, paths[0], sep, multiline)
    for p in paths[1:]:
        out = out.unionByName(_read(spark, p, sep, multiline))
    return out if keep_file else out.drop("file_path")
