"""Record preparation: identifiers, lenient date/time, station coordinates.

Input is the raw report table (``WMOIND YEAR MONTH DAY HOUR MIN REPORT``,
all strings).  Every input row gives exactly one output row; a row whose year
cannot be a calendar year is kept with ``decode_error = true``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions import codes
from stratus.functions.scalars import lenient_int, strip_ws
from stratus.session import fence

_P = "_prep_"


def _within(col, low: int, high: int):
    """A wide integer clamped into a range that fits an int."""
    return F.greatest(F.lit(low), F.least(F.lit(high), col)).cast("int")


def prepare_records(df: DataFrame) -> DataFrame:
    """Add ``station_id date time decode_error`` and the cleaned ``REPORT``.

    * year: first digit run, default 2000; 0 or above 9999 is an error row;
    * month 1-12, day 1-last day of that month, hour 0-23, minute 0-59, each
      the first digit run of the text (``"?8" -> 8``) clamped into range;
    * ``date`` is ``yyyy-MM-dd``, ``time`` ``HH:mm:ss``; both ``''`` on error.
    """
    # the first digit run is the same with or without surrounding whitespace,
    # so only the station id is stripped
    out = df.withColumns({
        "station_id": strip_ws(F.coalesce(F.col("WMOIND").cast("string"), F.lit(""))),
        _P + "y": lenient_int("YEAR", 2000),
        _P + "mo": _within(lenient_int("MONTH", 1), 1, 12),
        _P + "d": _within(lenient_int("DAY", 1), 0, 99),
        _P + "hh": _within(lenient_int("HOUR", 0), 0, 23),
        _P + "mi": _within(lenient_int("MIN", 0), 0, 59),
    })
    out = out.withColumns({
        "decode_error": (F.col(_P + "y") < 1) | (F.col(_P + "y") > 9999),
    })
    safe_year = _within(F.col(_P + "y"), 1, 9999)
    month_start = F.make_date(safe_year, F.col(_P + "mo"), F.lit(1))
    out = out.withColumns({
        _P + "day": F.greatest(F.lit(1), F.least(F.dayofmonth(F.last_day(month_start)),
                                                  F.col(_P + "d"))),
    })
    out = out.withColumns({
        "date": F.when(F.col("decode_error"), F.lit(""))
        .otherwise(F.date_format(F.make_date(safe_year, F.col(_P + "mo"), F.col(_P + "day")),
                                 "yyyy-MM-dd")),
        "time": F.when(F.col("decode_error"), F.lit(""))
        .otherwise(F.format_string("%02d:%02d:00", F.col(_P + "hh"), F.col(_P + "mi"))),
    })
    out = out.drop(*[c for c in out.columns if c.startswith(_P)])
    return fence(out, ["station_id", "date", "time", "decode_error"])


def builtin_coordinates(station_col: str = "station_id"):
    """(lat, lon) of the bundled stations as a literal map lookup (no join)."""
    pairs = []
    for wmo, (lat, lon) in codes.BUILTIN_STATIONS.items():
        pairs += [F.lit(wmo), F.struct(F.lit(float(lat)).alias("lat"),
                                       F.lit(float(lon)).alias("lon"))]
    return F.try_element_at(F.create_map(*pairs), F.col(station_col))


def attach_coordinates(df: DataFrame, stations: DataFrame | None = None,
                       station_col: str = "station_id") -> DataFrame:
    """Add ``lat lon``: the external station table first, then the built-in one.

    The pair is taken as a whole.  ``stations`` must already be one row per
    ``wmo_id`` (``sources.stations.station_table`` does that).  Spark's byte
    threshold decides, from the sizes it sees at run time, whether the table is
    broadcast; no job runs while the plan is built.
    """
    builtin = builtin_coordinates(station_col)
    if stations is None:
        return df.withColumns({"lat": builtin["lat"], "lon": builtin["lon"]})
    ext = stations.select(
        F.col("wmo_id").alias(_P + "wmo"),
        F.struct(F.col("lat").cast("double").alias("lat"),
                 F.col("lon").cast("double").alias("lon")).alias(_P + "ext"))
    joined = df.join(ext, F.col(station_col) == F.col(_P + "wmo"), "left")
    pair = F.coalesce(F.col(_P + "ext"), builtin)
    return joined.withColumns({"lat": pair["lat"], "lon": pair["lon"]}) \
        .drop(_P + "wmo", _P + "ext")
