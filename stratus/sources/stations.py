"""Station coordinate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions.scalars import strip_ws


# A decimal number as text: single underscores between digits, no type suffix.
_DIGITS = r"[0-9](?:_?[0-9])*"
_DECIMAL = rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"


def _number(col):
    """The number that a text spells, ``nan`` and infinities included; else NULL."""
    text = strip_ws(col.cast("string"))
    return (F.when(F.regexp_like(text, F.lit(_DECIMAL)), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
            .when(F.regexp_like(text, F.lit("(?i)^[+-]?nan$")), F.lit(float("nan")))
            .when(F.regexp_like(text, F.lit("(?i)^[+-]?inf(inity)?$")),
                  F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))))


def station_table(df: DataFrame, order_col: str | None = None) -> DataFrame:
    """One row per ``wmo_id`` with numeric ``lat lon``.

    ``wmo_id`` is trimmed; a row is kept only if both ``lat`` and ``lon``
    parse as numbers; for a repeated id the row that comes last in
    ``order_col`` wins (the file's line order when read by
    ``read_station_csv``).  The result is small (one row per station) and is
    what ``operators.prepare.attach_coordinates`` joins.
    """
    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    parsed = df.select(
        strip_ws(F.coalesce(F.col("wmo_id").cast("string"), F.lit(""))).alias("wmo_id"),
        _number(F.col("lat")).alias("lat"),
        _number(F.col("lon")).alias("lon"),
        order.alias("_order"),
    ).where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return (parsed.groupBy("wmo_id")
            .agg(F.max_by(F.struct("lat", "lon"), F.col("_order")).alias("_pair"))
            .select("wmo_id", F.col("_pair.lat").alias("lat"), F.col("_pair.lon").alias("lon")))


def read_station_csv(spark: SparkSession, path: str) -> DataFrame:
    """Station CSV (header ``wmo_id,lat,lon``); an absent path gives an empty
    table.  Line order (file, split, position in split) decides repeated ids."""
    from stratus.sources.files import path_exists

    if not path_exists(spark, path):
        return spark.createDataFrame([], "wmo_id string, lat double, lon double")
    raw = (spark.read.option("header", True).option("encoding", "UTF-8")
           .csv(path)
           .select("*", "_metadata.file_path", "_metadata.file_block_start"))
    cols = set(raw.columns)
    for c in ("wmo_id", "lat", "lon"):
        if c not in cols:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    ordered = raw.withColumn("_line", F.struct("file_path", "file_block_start",
                                               F.monotonically_increasing_id().alias("i")))
    return station_table(ordered, "_line")
