"""Cleaning: decoded -> analysis adapter, timestamp parse, NaN handling,
row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stratus.functions import codes
from stratus.functions.scalars import nan_to_null
from stratus.schemas import KEY_READINGS, NUMERIC_COLUMNS


def decoded_to_observations(df: DataFrame) -> DataFrame:
    """Adapter from decoder output to the analysis input.

    ``datetime = date || ' ' || time`` (NULL when the decoder wrote no date)
    and ``visibility_m`` is renamed ``visibility``; other columns pass.
    """
    dt = F.when((F.col("date") != "") & (F.col("time") != ""),
                F.concat_ws(" ", F.col("date"), F.col("time")))
    out = df.withColumn("datetime", dt)
    if "visibility_m" in df.columns:
        out = out.withColumnRenamed("visibility_m", "visibility")
    return out


def parse_timestamp(col) -> F.Column:
    """``yyyy-MM-dd HH:mm:ss``, then ``yyyy-MM-dd HH:mm``, then Spark's default
    parse; NULL if none fits (the row is kept).

    The result is a zone-less ``timestamp_ntz`` holding the civil time of the
    text (parse and conversion use the same session zone).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm")),
        F.try_to_timestamp(c),
    ).cast("timestamp_ntz")


def clean_observations(df: DataFrame) -> DataFrame:
    """Typed, cleaned observations.

    * ``ts`` from the ``datetime`` text (or an existing ``ts`` column);
    * the eight numeric columns cast to double with NaN -> NULL;
    * rows with temp, pressure, humidity and wind_speed all missing dropped;
    * missing rain -> 0.0; ``date = to_date(ts)``.
    One narrow stage: no shuffle.
    """
    cols = {}
    if "datetime" in df.columns and isinstance(df.schema["datetime"].dataType, StringType):
        cols["ts"] = parse_timestamp("datetime")
    elif "ts" not in df.columns:
        cols["ts"] = parse_timestamp(F.col("datetime").cast("string"))
    for c in NUMERIC_COLUMNS:
        if c in df.columns:
            cols[c] = nan_to_null(F.col(c).try_cast("double"))
    out = df.withColumns(cols)
    out = out.dropna(how="all", subset=[c for c in KEY_READINGS if c in out.columns])
    if "rain_3h" in out.columns:
        out = out.fillna({"rain_3h": 0.0})
    return out.withColumn("date", F.to_date(F.col("ts")))


def temperature_in_range(df: DataFrame) -> DataFrame:
    """Plausible temperatures only (inclusive band); drops NULL temperature."""
    lo, hi = codes.TEMP_RANGE
    return df.filter((F.col("temp") >= lo) & (F.col("temp") <= hi))


def wind_and_temperature_in_range(df: DataFrame) -> DataFrame:
    """Plausible wind and temperature, then rows with any NULL dropped."""
    wlo, whi = codes.WIND_RANGE
    tlo, thi = codes.TEMP_RANGE
    return (df.select("location", "wind_speed", "temp")
            .filter((F.col("wind_speed") >= wlo) & (F.col("wind_speed") <= whi)
                    & (F.col("temp") >= tlo) & (F.col("temp") <= thi))
            .dropna())
