"""Raw replies of the report service, landed as text files (one reply per
file), parsed into the raw report table.

Reply rules:

* blank lines are ignored;
* a reply whose first non-blank line contains ERROR, NO DATA, NOT FOUND,
  HOST NOT or FORBIDDEN (any case) is dropped whole;
* if that line contains WMOIND or YEAR the reply is a CSV with a header
  (first line); values are looked up by trimmed header name, a missing value
  is ``''``;
* otherwise each non-blank line is split on ``,`` into at most 7 parts (the
  report keeps its commas); lines with fewer than 6 parts are skipped, 6 parts
  means an empty report;
* only rows of the requested station are kept (the service matches by prefix).

Files are read line by line, so a large file is split across tasks like any
text file; the per-reply facts (first lines, header names) are one small row
per file, joined back to the lines.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions import codes
from stratus.functions.scalars import csv_fields, last_index, strip_ws
from stratus.schemas import RAW_COLUMNS
from stratus.session import fence


def read_reply_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the landed reply files: ``reply line_order line``.

    ``line_order`` is a long that increases along the first split of a file
    (the task's row position); lines of later splits are ordered after all of
    them.  Only the first physical and the first non-blank line need an exact
    order, and they lie in the first split (128 MB by default).
    """
    pos = F.monotonically_increasing_id()
    later = F.lit(1 << 62)
    return (spark.read.text(path)
            .select(F.col("_metadata.file_path").alias("reply"),
                    F.when(F.col("_metadata.file_block_start") == 0, pos)
                    .otherwise(pos + later).alias("line_order"),
                    F.col("value").alias("line")))


def parse_replies(lines: DataFrame, stations=None, station_pattern: str | None = None,
                  keep_reply: bool = False) -> DataFrame:
    """Raw report rows (``WMOIND YEAR MONTH DAY HOUR MIN REPORT``) from reply lines.

    ``lines`` has ``reply line_order line`` (see ``read_reply_lines``);
    ``line_order`` is numeric and orders the lines of a reply.  The
    requested station is ``stations`` (one id or a list; rows must match one)
    or the first group of ``station_pattern`` applied to the reply name.  With
    both, only replies named after one of ``stations`` are looked at: the reply
    is a file's path, so other files are not opened.
    """
    if stations is not None and station_pattern is not None:
        wanted = [stations] if isinstance(stations, str) else list(stations)
        lines = lines.where(F.regexp_extract(F.col("reply"), station_pattern, 1).isin(wanted))
    nonblank = strip_ws(F.col("line")) != ""
    # per reply: order of the first line and of the first non-blank line
    # (numeric minima: a hash aggregation with map-side combine) ...
    firsts = (lines.groupBy("reply")
              .agg(F.min("line_order").alias("_first_order"),
                   F.min(F.when(nonblank, F.col("line_order"))).alias("_text_order")))
    # ... then the text of those (at most two) lines per reply
    heads = (lines.join(firsts, "reply")
             .where((F.col("line_order") == F.col("_first_order"))
                    | (F.col("line_order") == F.col("_text_order")))
             .groupBy("reply", "_first_order")
             .agg(F.max(F.when(F.col("line_order") == F.col("_first_order"), F.col("line")))
                  .alias("_first_line"),
                  F.max(F.when(F.col("line_order") == F.col("_text_order"), F.col("line")))
                  .alias("_first_text")))
    upper = F.upper(F.col("_first_text"))
    names = F.transform(csv_fields(F.col("_first_line")),
                        lambda x: strip_ws(F.coalesce(x, F.lit(""))))
    # header names are resolved to field positions once per reply
    info = heads.select(
        "reply", "_first_order",
        F.coalesce(F.greatest(*[upper.contains(w) for w in codes.REPLY_ERROR_WORDS]),
                   F.lit(True)).alias("_error"),
        F.coalesce(F.greatest(*[upper.contains(w) for w in codes.REPLY_HEADER_WORDS]),
                   F.lit(False)).alias("_header"),
        names.alias("_names"),
    ).where(~F.col("_error"))
    info = info.select("reply", "_first_order", "_header",
                       *[(last_index(F.col("_names"), c) + 1).alias(f"_at_{c}")
                         for c in RAW_COLUMNS])

    joined = lines.join(info, "reply").where(nonblank)

    # header replies: every line after the first, CSV-parsed, looked up by
    # name; other replies: every non-blank line split into at most 7 parts
    # (the report keeps its commas), lines with fewer than 6 parts skipped.
    # One projection for both, so the lines are read once.
    # The field array is made once per line and leaves through a fence:
    # otherwise it would be copied into each of the 7 lookups and into the
    # station filter pushed down from above.
    header = F.col("_header")
    joined = joined.withColumn("_fields", F.when(header, csv_fields(F.col("line")))
                               .otherwise(F.split(F.col("line"), ",", 7)))
    joined = fence(joined, ["_fields"])
    keep = F.when(header, F.col("line_order") != F.col("_first_order")) \
        .otherwise(F.size("_fields") >= 6)
    cols = {}
    for i, c in enumerate(RAW_COLUMNS):
        at = F.when(header, F.col(f"_at_{c}")).otherwise(F.lit(i + 1))
        cols[c] = strip_ws(F.coalesce(F.try_element_at(F.col("_fields"), at), F.lit("")))
    rows = joined.where(keep).select("reply", *[v.alias(k) for k, v in cols.items()])
    if stations is not None:
        ids = [stations] if isinstance(stations, str) else list(stations)
        rows = rows.where(F.col("WMOIND").isin(ids))
    elif station_pattern is not None:
        re.compile(station_pattern)
        rows = rows.where(F.col("WMOIND") == F.regexp_extract(F.col("reply"), station_pattern, 1))
    return rows if keep_reply else rows.drop("reply")


def read_replies(spark: SparkSession, path: str, stations=None,
                 station_pattern: str | None = None, keep_reply: bool = False) -> DataFrame:
    """``read_reply_lines`` + ``parse_replies``."""
    return parse_replies(read_reply_lines(spark, path), stations, station_pattern, keep_reply)
