"""Reporting coverage: reports per station and fixed-length period.

Periods start on Jan 1 00:00 of ``start_year`` and step by ``days``; the last
one ends at min(Dec 31 23:59 of ``end_year``, ``now``), end minute included.
Every station gets every period; an empty period counts 0.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def period_bounds(start_year: int, end_year: int, days: int,
                  now: _dt.datetime | None = None):
    """(start, stop, number of periods) from the parameters alone."""
    if start_year > end_year:
        raise ValueError(f"start_year {start_year} must be <= end_year {end_year}")
    if days < 1:
        raise ValueError("days must be >= 1")
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    start = _dt.datetime(start_year, 1, 1)
    stop = min(_dt.datetime(end_year, 12, 31, 23, 59), now.replace(second=0, microsecond=0))
    if stop < start:
        return start, stop, 0
    minutes = int((stop - start).total_seconds() // 60)
    return start, stop, minutes // (days * 1440) + 1


def period_coverage(reports: DataFrame, start_year: int, end_year: int, days: int = 365,
                    now: _dt.datetime | None = None, station_col: str = "station_id",
                    ts_col: str = "ts", stations: DataFrame | None = None) -> DataFrame:
    """``station period period_start period_end reports`` for every station
    (``stations`` or the distinct stations of ``reports``) and period.

    Reports are bucketed by arithmetic (``minutes since start // period``), so
    counting is one partial aggregation over one scan; a second, small
    aggregation gathers each station's counts into a map (at most one entry
    per period), and the zero-filled calendar is generated per station with
    ``sequence`` -- no cross join, no join unless a station list is given.
    """
    start, stop, n = period_bounds(start_year, end_year, days, now)
    step = days * 1440
    start_c = F.lit(start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    stop_c = F.lit(stop.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    # one pass over the reports: counts per station and period, with reports
    # outside the window kept as period NULL so that a station without
    # in-window reports still gets its zero-filled calendar.  ``ts`` and the minute offset get their own projections so a long
    # timestamp expression is evaluated once, not inlined at every use.
    timed = reports.select(F.col(station_col).alias("station"),
                           F.col(ts_col).cast("timestamp_ntz").alias("_ts"))
    timed = timed.withColumn("_min", F.timestamp_diff("MINUTE", start_c, F.col("_ts")))
    in_window = (F.col("_ts") >= start_c) & (F.col("_ts") < F.timestamp_add("MINUTE", F.lit(1), stop_c))
    per = (timed
           .withColumn("period", F.when(in_window, F.floor(F.col("_min") / step).cast("int")))
           .groupBy("station", "period")
           .agg(F.count(F.lit(1)).alias("reports")))
    # per station: its in-window counts as a map {period: reports}; the map
    # holds at most one entry per period, a bound set by the parameters
    entry = F.when(F.col("period").isNotNull(), F.struct("period", "reports"))
    by_station = per.groupBy("station").agg(
        F.map_from_entries(F.collect_list(entry)).alias("_counts"))
    if stations is not None:
        listed = stations.select(F.col(station_col).alias("station")).distinct()
        by_station = listed.join(by_station, "station", "left")
    if n == 0:
        grid = by_station.withColumn("period", F.lit(None).cast("int")).limit(0)
    else:
        grid = by_station.select("station", "_counts",
                                 F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("period"))
    grid = grid.withColumn("reports", F.try_element_at(F.col("_counts"), F.col("period")))
    pstart = F.timestamp_add("MINUTE", F.col("period") * step, start_c)
    pend = F.least(F.timestamp_add("MINUTE", F.lit(step - 1), pstart), stop_c)
    return grid.select("station", "period", pstart.alias("period_start"), pend.alias("period_end"),
                       F.coalesce(F.col("reports"), F.lit(0)).cast("long").alias("reports"))
