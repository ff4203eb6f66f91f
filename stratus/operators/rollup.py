"""The per-location results from one pass over cleaned observations.

``statistics`` groups the observations by several grouping sets at once (day,
month, whole location).  Rows are summed up map-side, so the shuffle carries one
row per group and task; each result then reads its own level.  Averages are
Spark's own at every level, not averages of averages, so a result does not
depend on which others are asked for.  Results are sorted as the original lists
them; ``ordered=False`` skips the global sort where a result only feeds another
computation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions import codes

#: Level -> its keys and the grouping id over (location, date, month).
LEVELS = {"day": (["location", "date"], 1), "month": (["location", "month"], 2), "location": (["location"], 3)}


def statistics(clean: DataFrame, *levels: str) -> DataFrame:
    """``location date month level`` and the statistics of every group of the
    ``levels`` (all by default).  Statistics of absent columns are left out."""
    low, high = codes.TEMP_RANGE
    month = F.date_trunc("month", "ts").cast(clean.schema["ts"].dataType)
    plausible = F.when(F.col("temp").between(low, high), F.col("temp"))
    rows = clean.withColumns({"month": month, "temp": plausible})
    stats = [F.count(F.lit(1)).alias("n_rows"), F.avg("temp").alias("avg_temp"), F.min("temp").alias("min_temp"),
             F.max("temp").alias("max_temp")]
    for name, how in (("humidity", F.avg), ("rain_3h", F.sum), ("wind_speed", F.avg)):
        if name in clean.columns:
            stats.append(how(name).alias(name))
    if len(levels) == 1:  # plain grouping: no row is expanded
        keys, level = LEVELS[levels[0]]
        absent = [F.lit(None).cast(t).alias(c) for c, t in (("date", rows.schema["date"].dataType), ("month", rows.schema["month"].dataType))
                  if c not in keys]
        out = rows.groupBy(*keys).agg(F.lit(level).cast("long").alias("level"), *stats).select("*", *absent)
        return out.select("location", "date", "month", *[c for c in out.columns if c not in ("location", "date", "month")])
    keys = [LEVELS[k][0] for k in levels or LEVELS]
    return rows.groupingSets([[F.col(c) for c in k] for k in keys], "location", "date", "month").agg(
        F.grouping_id().alias("level"), *stats)


def _level(stats: DataFrame, name: str) -> DataFrame:
    return stats.where(F.col("level") == LEVELS[name][1])


def _listed(df: DataFrame, ordered: bool, *keys) -> DataFrame:
    return df.orderBy(*keys) if ordered else df


def monthly_temperature(stats: DataFrame, ordered: bool = True) -> DataFrame:
    """Average, lowest and highest plausible temperature per location and month
    that has one (2 dp)."""
    names = ("avg_temp", "min_temp", "max_temp")
    out = _level(stats, "month").where("avg_temp is not null").select(
        "location", "month", *[F.round(n, 2).alias(n) for n in names])
    return _listed(out, ordered, "location", "month")


def daily_temperature(stats: DataFrame, ordered: bool = True) -> DataFrame:
    """Average plausible temperature per location and day that has one (2 dp)."""
    out = _level(stats, "day").where("avg_temp is not null").select(
        "location", "date", F.round("avg_temp", 2).alias("avg_temp"))
    return _listed(out, ordered, "location", "date")


def daily_wind(stats: DataFrame, ordered: bool = True) -> DataFrame:
    """Average wind speed per location and day (2 dp)."""
    out = _level(stats, "day").select("location", "date", F.round("wind_speed", 2).alias("avg_wind_speed"))
    return _listed(out, ordered, "location", "date")


def average_humidity(stats: DataFrame, ordered: bool = True) -> DataFrame:
    """Average relative humidity per location (2 dp), most humid first."""
    out = _level(stats, "location").select("location", F.round("humidity", 2).alias("avg_humidity"))
    return _listed(out, ordered, F.desc("avg_humidity"))


def total_rain(stats: DataFrame, ordered: bool = True) -> DataFrame:
    """Total rain per location in mm (2 dp), wettest first."""
    out = _level(stats, "location").select("location", F.round("rain_3h", 2).alias("total_rain_mm"))
    return _listed(out, ordered, F.desc("total_rain_mm"))


def location_counts(stats: DataFrame, name: str = "rows") -> DataFrame:
    return _level(stats, "location").select("location", F.col("n_rows").alias(name))


def row_count(stats: DataFrame) -> DataFrame:
    return _level(stats, "location").agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows"))


# ------------------------------------------------- results from mergeable state

_STATE_KEYS = ["location", "date", "month"]


def partial_state(clean: DataFrame) -> DataFrame:
    """Per location and day the counts and sums that the results are made of:
    states of any landings of rows add up.  Sums are exact, of values rounded to
    a millionth, so they do not depend on what landed together."""
    low, high = codes.TEMP_RANGE
    plausible = F.when(F.col("temp").between(low, high), F.col("temp"))
    rows = clean.withColumns({"month": F.date_trunc("month", "ts").cast(clean.schema["ts"].dataType), "temp": plausible})
    stats = [F.count(F.lit(1)).alias("n_rows"), F.min("temp").alias("min_temp"), F.max("temp").alias("max_temp")]
    for c in ("temp", "humidity", "rain_3h", "wind_speed"):
        stats += [F.count(c).alias(f"{c}_n"), F.sum(F.col(c).cast("decimal(18,6)")).cast("decimal(38,6)").alias(f"{c}_sum")]
    return rows.groupBy(*_STATE_KEYS).agg(*stats)


def append_state(clean: DataFrame, path: str) -> None:
    """Add the state of newly landed rows, also of days already there, to the
    stored states; nothing that landed before is read."""
    partial_state(clean).write.mode("append").parquet(path)


def merged_state(states: DataFrame) -> DataFrame:
    """One row per location and day of stored states."""
    how = {c: F.min if c.startswith("min_") else F.max if c.startswith("max_") else F.sum
           for c in states.columns if c not in _STATE_KEYS}
    kept = {c: f(c).cast(states.schema[c].dataType).alias(c) for c, f in how.items()}
    return states.groupBy(*_STATE_KEYS).agg(*kept.values())


def statistics_from_state(states: DataFrame) -> DataFrame:
    """``statistics`` of all levels, with averages as sums over counts."""
    def mean(c):
        return F.try_divide(F.sum(f"{c}_sum").cast("double"), F.sum(f"{c}_n").cast("double"))

    stats = [F.sum("n_rows").alias("n_rows"), mean("temp").alias("avg_temp"), F.min("min_temp").alias("min_temp"),
             F.max("max_temp").alias("max_temp"), mean("humidity").alias("humidity"), F.sum("rain_3h_sum").cast("double").alias("rain_3h"),
             mean("wind_speed").alias("wind_speed")]
    keys = [keys for keys, _ in LEVELS.values()]
    return states.groupingSets([[F.col(c) for c in k] for k in keys], "location", "date", "month").agg(
        F.grouping_id().alias("level"), *stats)
