"""Registered driver queries: a Spark builder and an independent SQL oracle
for each, over the synthetic views of ``plans.fixtures``.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables.  The oracle SQL runs in DuckDB on the same parquet tables; for
decode queries it computes the expected values from the arithmetic that built
the report text, never by parsing it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions import codes
from stratus.operators import aggregates as agg
from stratus.operators import chartdata as chart
from stratus.operators import rollup
from stratus.operators.clean import clean_observations, decoded_to_observations
from stratus.operators.coverage import period_coverage
from stratus.operators.decode import decode_reports
from stratus.operators.prepare import attach_coordinates, prepare_records
from stratus.plans import fixtures
from stratus.plans.decode_job import decode_raw, run_counts
from stratus.plans.fixtures import with_views as _with_views
from stratus.session import spread
from stratus.sources.stations import station_table

def spark_round_sql(sql: str) -> str:
    """Rewrite every ``round(x, n)`` of an oracle query into Spark's rounding
    rule: half-up on the shortest decimal text of the double (DuckDB's own
    ``round`` works on the binary value and differs on exact ``.5`` ties)."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, None
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        arg, digits = spark_round_sql(sql[j + 6:comma]), sql[comma + 1:k - 1].strip()
        out.append(sql[i:j])
        out.append(f"CAST(round(CAST(CAST(({arg}) AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)")
        i = k


def with_views(sql: str, *views: str) -> str:
    """Oracle text: the query with Spark's rounding, over the fixture views."""
    return _with_views(spark_round_sql(sql), *views)


READING_SQL = ("report_id, t AS temp, p AS pressure, h AS humidity, ws AS wind_speed, "
               "wd AS wind_dir, cc AS cloud_cover, vis AS visibility_m, rn AS rain_3h")

# Coverage parameters of the registered query: weekly periods of 2024, with
# "now" inside the data so the last period is cut short.
COVERAGE_START, COVERAGE_END, COVERAGE_DAYS = 2024, 2024, 7
COVERAGE_NOW = _dt.datetime(2024, 1, 20, 12, 0)
COVERAGE_YEAR_NOW = _dt.datetime(2024, 12, 31, 23, 59)


# --------------------------------------------------------------------------
# shared inputs
# --------------------------------------------------------------------------

def _obs(spark: SparkSession, sf: str) -> DataFrame:
    return clean_observations(fixtures.view(spark, sf, "obs"))


def _obs_month(spark: SparkSession, sf: str) -> DataFrame:
    return clean_observations(fixtures.view(spark, sf, "obs_month"))


def _decoded(spark: SparkSession, sf: str, extras: bool = False):
    return decode_raw(fixtures.view(spark, sf, "synop"), extras=extras, keep=["report_id"])


def _station_obs(spark: SparkSession, sf: str) -> DataFrame:
    """Decoded synop reports as cleaned observations, located by station."""
    dec = decoded_to_observations(_decoded(spark, sf))
    return clean_observations(dec.withColumn("location", F.col("station_id")))


# --------------------------------------------------------------------------
# decode
# --------------------------------------------------------------------------

def q_synop_decode(spark, sf):
    cols = ["report_id", "temp", "pressure", "humidity", "wind_speed", "wind_dir",
            "cloud_cover", "visibility_m", "rain_3h"]
    return decode_reports(spread(fixtures.view(spark, sf, "synop"), spark.sparkContext.defaultParallelism), "REPORT").select(*cols)


O_SYNOP_DECODE = with_views(f"SELECT {READING_SQL} FROM synop_expected", "synop_expected")


_STATION_CASE = ("CASE e%8 WHEN 0 THEN '98444' WHEN 1 THEN '98446' WHEN 2 THEN '98543' "
                 "WHEN 3 THEN '98536' WHEN 4 THEN '98427' WHEN 5 THEN '98434' "
                 "WHEN 6 THEN '98440' ELSE '98999' END")


def _coord_case(idx: int) -> str:
    parts = [f"WHEN '{k}' THEN CAST({v[idx]!r} AS DOUBLE)" for k, v in codes.BUILTIN_STATIONS.items()]
    return f"CASE station_id {' '.join(parts)} END"


def q_synop_decoded_table(spark, sf):
    return _decoded(spark, sf)


O_SYNOP_DECODED_TABLE = with_views(f"""
SELECT r.report_id, r.station_id, r.date, r.time,
 {_coord_case(0)} AS lat, {_coord_case(1)} AS lon,
 x.t AS temp, x.p AS pressure, x.h AS humidity, x.ws AS wind_speed, x.wd AS wind_dir,
 x.cc AS cloud_cover, x.vis AS visibility_m, x.rn AS rain_3h, false AS decode_error
FROM (SELECT event_id AS report_id, {_STATION_CASE.replace('e%8', 'event_id%8')} AS station_id,
        strftime(ts, '%Y-%m-%d') AS date,
        lpad(CAST(CASE WHEN event_id%37=0 THEN 8 ELSE hour(ts) END AS VARCHAR), 2, '0') || ':'
        || lpad(CAST(CASE WHEN event_id%43=0 THEN 0 ELSE minute(ts) END AS VARCHAR), 2, '0')
        || ':00' AS time
      FROM events) r
JOIN synop_expected x USING (report_id)
""", "synop_expected")


def q_synop_station_override(spark, sf):
    """Coordinates only: preparation and the station lookup, no decode."""
    ext = station_table(fixtures.view(spark, sf, "stations_ext"), "line_no")
    prepared = prepare_records(fixtures.view(spark, sf, "synop"))
    return attach_coordinates(prepared, ext).select("report_id", "station_id", "lat", "lon")


O_SYNOP_STATION_OVERRIDE = with_views(f"""
SELECT r.report_id, r.station_id,
 CASE WHEN s.wmo_id IS NOT NULL THEN s.lat ELSE {_coord_case(0)} END AS lat,
 CASE WHEN s.wmo_id IS NOT NULL THEN s.lon ELSE {_coord_case(1)} END AS lon
FROM (SELECT event_id AS report_id, {_STATION_CASE.replace('e%8', 'event_id%8')} AS station_id
      FROM events) r
LEFT JOIN (SELECT wmo_id, arg_max(TRY_CAST(lat AS DOUBLE), line_no) AS lat,
                  arg_max(TRY_CAST(lon AS DOUBLE), line_no) AS lon
           FROM stations_ext
           WHERE TRY_CAST(lat AS DOUBLE) IS NOT NULL AND TRY_CAST(lon AS DOUBLE) IS NOT NULL
           GROUP BY wmo_id) s ON s.wmo_id = r.station_id
""", "stations_ext")


def q_synop_run_counts(spark, sf):
    return run_counts(_decoded(spark, sf, extras=True))


O_SYNOP_RUN_COUNTS = with_views("""
SELECT count(*) AS rows_decoded, CAST(0 AS BIGINT) AS errors,
       count(*) FILTER (WHERE e%41<>0 AND e%19<>0 AND tdt/10e0 >
             CASE WHEN e%29=0 THEN -ttt/10e0 ELSE ttt/10e0 END) AS dewpoint_warnings
FROM (SELECT event_id AS e, (event_id*37)%500 AS ttt,
        CASE WHEN event_id%31=0 THEN (event_id*37)%500+20
             ELSE greatest((event_id*37)%500-event_id%120, 0) END AS tdt FROM events) k
""")


# --------------------------------------------------------------------------
# per-location aggregates over observations
# --------------------------------------------------------------------------

def q_avg_humidity(spark, sf):
    return rollup.average_humidity(rollup.statistics(_obs(spark, sf), "location"))


def q_total_rain(spark, sf):
    return rollup.total_rain(rollup.statistics(_obs(spark, sf), "location"))


def q_daily_temp(spark, sf):
    return rollup.daily_temperature(rollup.statistics(_obs(spark, sf), "day"))


def q_daily_wind(spark, sf):
    return rollup.daily_wind(rollup.statistics(_obs(spark, sf), "day"))


def q_monthly_temp(spark, sf):
    return rollup.monthly_temperature(rollup.statistics(_obs_month(spark, sf), "month"))


_CLEAN = """(SELECT *, coalesce(rain_3h, 0e0) AS rain, CAST(ts AS DATE) AS date FROM obs
  WHERE temp IS NOT NULL OR pressure IS NOT NULL OR humidity IS NOT NULL OR wind_speed IS NOT NULL)"""

O_AVG_HUMIDITY = with_views(f"""
SELECT location, round(avg(humidity), 2) AS avg_humidity FROM {_CLEAN} c
GROUP BY location ORDER BY avg_humidity DESC""", "obs")

O_TOTAL_RAIN = with_views(f"""
SELECT location, round(sum(rain), 2) AS total_rain_mm FROM {_CLEAN} c
GROUP BY location ORDER BY total_rain_mm DESC""", "obs")

O_DAILY_TEMP = with_views(f"""
SELECT location, date, round(avg(temp), 2) AS avg_temp FROM {_CLEAN} c
WHERE temp BETWEEN 10 AND 45 GROUP BY location, date ORDER BY location, date""", "obs")

#: The same with exact sums.
O_STATE_DAILY_TEMP = with_views(f"""
SELECT location, date, round(CAST(sum(CAST(temp AS DECIMAL(18,6))) AS DOUBLE) / count(temp), 2) AS avg_temp FROM {_CLEAN} c
WHERE temp BETWEEN 10 AND 45 GROUP BY location, date ORDER BY location, date""", "obs")
O_STATE_TOTAL_RAIN = with_views(f"""
SELECT location, round(CAST(sum(CAST(rain AS DECIMAL(18,6))) AS DOUBLE), 2) AS total_rain_mm FROM {_CLEAN} c
GROUP BY location ORDER BY total_rain_mm DESC""", "obs")

O_DAILY_WIND = with_views(f"""
SELECT location, date, round(avg(wind_speed), 2) AS avg_wind_speed FROM {_CLEAN} c
GROUP BY location, date ORDER BY location, date""", "obs")

_MONTHLY = """(SELECT location, date_trunc('month', ts) AS month, round(avg(temp), 2) AS avg_temp,
  round(min(temp), 2) AS min_temp, round(max(temp), 2) AS max_temp
  FROM obs_month WHERE temp BETWEEN 10 AND 45 GROUP BY location, date_trunc('month', ts))"""

O_MONTHLY_TEMP = with_views(f"SELECT * FROM {_MONTHLY} m ORDER BY location, month", "obs_month")


def q_clean_daily_counts(spark, sf):
    """Cleaning from text timestamps: two formats and unparsable text (kept,
    NULL date), then rows per location and day."""
    obs = fixtures.view(spark, sf, "obs")
    text = (F.when(F.col("obs_id") % 53 == 0, F.lit("not a time"))
            .when(F.col("obs_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm")))
    clean = clean_observations(obs.withColumn("datetime", text).drop("ts"))
    return clean.groupBy("location", "date").agg(F.count(F.lit(1)).alias("rows"),
                                                 F.sum("rain_3h").alias("rain_sum"))


O_CLEAN_DAILY_COUNTS = with_views("""
SELECT location, CASE WHEN obs_id%53=0 THEN NULL ELSE CAST(ts AS DATE) END AS date,
       count(*) AS rows, sum(coalesce(rain_3h, 0e0)) AS rain_sum
FROM obs WHERE temp IS NOT NULL OR pressure IS NOT NULL OR humidity IS NOT NULL OR wind_speed IS NOT NULL
GROUP BY 1, 2""", "obs")


def q_location_counts(spark, sf):
    return agg.location_counts(fixtures.view(spark, sf, "obs"), "rows")


O_LOCATION_COUNTS = with_views("SELECT location, count(*) AS rows FROM obs GROUP BY location", "obs")


# --------------------------------------------------------------------------
# chart data
# --------------------------------------------------------------------------

def q_wind_bins(spark, sf):
    return chart.wind_temperature_bins(_obs(spark, sf))


_BINS = f"""(SELECT location, floor(wind_speed / 0.5e0) * 0.5e0 AS ws_bin, avg(temp) AS avg_temp,
  count(*) AS n FROM {_CLEAN} c
  WHERE wind_speed BETWEEN 0 AND 25 AND temp BETWEEN 10 AND 45
  GROUP BY location, floor(wind_speed / 0.5e0))"""

O_WIND_BINS = with_views(f"SELECT * FROM {_BINS} b", "obs")


def q_bin_weights(spark, sf):
    return chart.bin_weights(chart.wind_temperature_bins(_obs(spark, sf))) \
        .select("location", "ws_bin", "n", "n_clipped", "weight")


O_BIN_WEIGHTS = with_views(f"""
SELECT location, ws_bin, n, n_clipped, n_clipped / max(n_clipped) OVER (PARTITION BY location) * 200e0 + 15e0 AS weight
FROM (SELECT location, ws_bin, n, least(CAST(n AS DOUBLE), quantile_cont(n, 0.95) OVER (PARTITION BY location)) AS n_clipped
      FROM {_BINS} b) w""", "obs")


def q_wind_trend(spark, sf):
    t = chart.wind_temperature_trend(chart.wind_temperature_bins(_obs(spark, sf)))
    return t.select("location", F.round("slope", 9).alias("slope"),
                    F.round("intercept", 9).alias("intercept"), "bins", "x_min", "x_max")


O_WIND_TREND = with_views(f"""
SELECT location, round(regr_slope(avg_temp, ws_bin), 9) AS slope,
       round(regr_intercept(avg_temp, ws_bin), 9) AS intercept, count(*) AS bins,
       min(ws_bin) AS x_min, max(ws_bin) AS x_max
FROM {_BINS} b GROUP BY location HAVING count(*) >= 5""", "obs")


def q_wind_fit_line(spark, sf):
    line = chart.trend_line(chart.wind_temperature_trend(chart.wind_temperature_bins(_obs(spark, sf))))
    return line.select("location", "point", "x", F.round("y", 9).alias("y"))


O_WIND_FIT_LINE = with_views(f"""
SELECT location, point, x, round(slope * x + intercept, 9) AS y
FROM (SELECT f.*, CAST(g.point AS INTEGER) AS point,
        CASE WHEN g.point = 99 THEN x_max ELSE x_min + g.point * ((x_max - x_min) / 99) END AS x
      FROM (SELECT location, regr_slope(avg_temp, ws_bin) AS slope,
                   regr_intercept(avg_temp, ws_bin) AS intercept,
                   min(ws_bin) AS x_min, max(ws_bin) AS x_max
            FROM {_BINS} b GROUP BY location HAVING count(*) >= 5) f,
           (SELECT range AS point FROM range(0, 100)) g) p""", "obs")


def q_correlation(spark, sf):
    return agg.correlation_matrix(_obs(spark, sf)).select("var_x", "var_y", "corr")


_CORR_COLS = ["temp", "pressure", "humidity", "wind_speed", "wind_dir",
              "cloud_cover", "visibility", "rain"]


def _corr_sql(lower: bool) -> str:
    names = dict(zip(_CORR_COLS, ["temp", "pressure", "humidity", "wind_speed", "wind_dir",
                                 "cloud_cover", "visibility", "rain_3h"]))
    rows = []
    for i, a in enumerate(_CORR_COLS):
        for j, b in enumerate(_CORR_COLS):
            if lower and j > i:
                continue
            v = (f"coalesce(CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE round(corr({a}, {b}), 3) + 0e0 END, 0e0)")
            if lower:
                rows.append(f"SELECT '{names[a]}' AS row_var, '{names[b]}' AS col_var, "
                            f"'{codes.CORRELATION_LABELS[names[a]]}' AS row_label, "
                            f"'{codes.CORRELATION_LABELS[names[b]]}' AS col_label, {v} AS corr FROM c")
            else:
                rows.append(f"SELECT '{names[a]}' AS var_x, '{names[b]}' AS var_y, {v} AS corr FROM c")
    return with_views(f"WITH c AS (SELECT * FROM {_CLEAN} x)\n" + "\nUNION ALL\n".join(rows), "obs") \
        .replace(")\nWITH c AS", "),\nc AS")


O_CORRELATION = _corr_sql(False)


def q_correlation_lower(spark, sf):
    return agg.correlation_lower_triangle(_obs(spark, sf))


O_CORRELATION_LOWER = _corr_sql(True)


def q_month_extremes(spark, sf):
    return chart.monthly_extremes(rollup.monthly_temperature(rollup.statistics(_obs_month(spark, sf), "month"), ordered=False))


O_MONTH_EXTREMES = with_views(f"""
SELECT location,
  arg_max(month, struct_pack(a := avg_temp, m := -epoch(month))) AS hottest_month,
  max(avg_temp) AS hottest_avg_temp,
  arg_min(month, struct_pack(a := avg_temp, m := epoch(month))) AS coldest_month,
  min(avg_temp) AS coldest_avg_temp
FROM {_MONTHLY} m GROUP BY location""", "obs_month")


def q_month_ranges(spark, sf):
    return chart.monthly_ranges(rollup.monthly_temperature(rollup.statistics(_obs_month(spark, sf), "month"), ordered=False))


O_MONTH_RANGES = with_views(f"""
SELECT location, greatest(15e0, min(avg_temp) - 2e0) AS axis_low, max(avg_temp) + 2.5e0 AS axis_high,
       min(avg_temp) - 0.5e0 AS fill_floor
FROM {_MONTHLY} m GROUP BY location""", "obs_month")


def q_humidity_ranks(spark, sf):
    return chart.humidity_ranks(rollup.average_humidity(rollup.statistics(_obs(spark, sf), "location"), ordered=False))


O_HUMIDITY_RANKS = with_views(f"""
SELECT location, avg_humidity,
  CAST(row_number() OVER (ORDER BY avg_humidity DESC NULLS LAST, location) AS INTEGER) AS rank,
  list_extract({codes.PALETTE!r}, CAST((row_number() OVER (ORDER BY avg_humidity ASC NULLS LAST, location) - 1) % 8 + 1 AS INTEGER)) AS bar_colour
FROM (SELECT location, round(avg(humidity), 2) AS avg_humidity FROM {_CLEAN} c GROUP BY location) h""", "obs")


def q_palette_slots(spark, sf):
    return chart.palette_slots(_obs(spark, sf))


O_PALETTE_SLOTS = with_views(f"""
SELECT location, CAST((dense_rank() OVER (ORDER BY location) - 1) % 8 AS INTEGER) AS palette_index,
  list_extract({codes.PALETTE!r}, CAST((dense_rank() OVER (ORDER BY location) - 1) % 8 + 1 AS INTEGER)) AS colour
FROM (SELECT DISTINCT location FROM {_CLEAN} c) l""", "obs")


# --------------------------------------------------------------------------
# end to end over decoded reports
# --------------------------------------------------------------------------

def q_station_summary(spark, sf):
    """Raw reports -> decode -> adapter -> clean -> humidity and rain per station."""
    obs = _station_obs(spark, sf)
    return (obs.groupBy("location")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.round(F.avg("humidity"), 2).alias("avg_humidity"),
                 F.round(F.sum("rain_3h"), 2).alias("total_rain_mm"))
            .orderBy("location"))


_DEC_OBS = """(SELECT CASE event_id%8 WHEN 0 THEN '98444' WHEN 1 THEN '98446' WHEN 2 THEN '98543'
   WHEN 3 THEN '98536' WHEN 4 THEN '98427' WHEN 5 THEN '98434' WHEN 6 THEN '98440' ELSE '98999' END AS location,
   x.*, make_timestamp(year(ts), month(ts), day(ts), CASE WHEN event_id%37=0 THEN 8 ELSE hour(ts) END,
                       CASE WHEN event_id%43=0 THEN 0 ELSE minute(ts) END, 0) AS obs_ts
  FROM events JOIN synop_expected x ON x.report_id = events.event_id
  WHERE x.t IS NOT NULL OR x.p IS NOT NULL OR x.h IS NOT NULL OR x.ws IS NOT NULL)"""

O_STATION_SUMMARY = with_views(f"""
SELECT location, count(*) AS rows, round(avg(h), 2) AS avg_humidity, round(sum(coalesce(rn, 0e0)), 2) AS total_rain_mm
FROM {_DEC_OBS} d GROUP BY location ORDER BY location""", "synop_expected")


def q_station_daily_temp(spark, sf):
    """Only the temperature is decoded; rows without it play no part."""
    dec = decoded_to_observations(decode_raw(fixtures.view(spark, sf, "synop"), columns=["temp"]))
    clean = clean_observations(dec.withColumn("location", F.col("station_id")))
    return rollup.daily_temperature(rollup.statistics(clean, "day"))


O_STATION_DAILY_TEMP = with_views(f"""
SELECT location, CAST(obs_ts AS DATE) AS date, round(avg(t), 2) AS avg_temp
FROM {_DEC_OBS} d WHERE t BETWEEN 10 AND 45 GROUP BY 1, 2 ORDER BY 1, 2""", "synop_expected")


def q_report_coverage(spark, sf):
    """Report times need only the preparation stage (no decode)."""
    prepared = decoded_to_observations(prepare_records(fixtures.view(spark, sf, "synop")))
    reports = prepared.withColumn("ts", F.to_timestamp_ntz(F.col("datetime")))
    return period_coverage(reports, COVERAGE_START, COVERAGE_END, COVERAGE_DAYS,
                           now=COVERAGE_NOW, station_col="station_id", ts_col="ts")


def q_report_coverage_year(spark, sf):
    """The same over the whole year, so that every report is counted."""
    prepared = decoded_to_observations(prepare_records(fixtures.view(spark, sf, "synop")))
    reports = prepared.withColumn("ts", F.to_timestamp_ntz(F.col("datetime")))
    return period_coverage(reports, COVERAGE_START, COVERAGE_END, COVERAGE_DAYS,
                           now=COVERAGE_YEAR_NOW, station_col="station_id", ts_col="ts")


def _coverage_sql(now: _dt.datetime) -> str:
    start = f"TIMESTAMP '{COVERAGE_START}-01-01 00:00:00'"
    stop = f"TIMESTAMP '{now:%Y-%m-%d %H:%M:%S}'"
    step = COVERAGE_DAYS * 1440
    return f"""
WITH r AS (
  SELECT CASE event_id%8 WHEN 0 THEN '98444' WHEN 1 THEN '98446' WHEN 2 THEN '98543'
     WHEN 3 THEN '98536' WHEN 4 THEN '98427' WHEN 5 THEN '98434' WHEN 6 THEN '98440' ELSE '98999' END AS station,
     make_timestamp(year(ts), month(ts), day(ts), CASE WHEN event_id%37=0 THEN 8 ELSE hour(ts) END,
                    CASE WHEN event_id%43=0 THEN 0 ELSE minute(ts) END, 0) AS rts
  FROM events),
c AS (SELECT station, CAST(floor(date_diff('minute', {start}, rts) / {step}) AS INTEGER) AS period, count(*) AS n
      FROM r WHERE rts >= {start} AND rts <= {stop} GROUP BY 1, 2),
g AS (SELECT s.station, p.period FROM (SELECT DISTINCT station FROM r) s,
        (SELECT CAST(range AS INTEGER) AS period FROM range(0, CAST(floor(date_diff('minute', {start}, {stop}) / {step}) AS BIGINT) + 1)) p)
SELECT g.station, g.period, {start} + to_minutes(CAST(g.period * {step} AS BIGINT)) AS period_start,
  least({start} + to_minutes(CAST(g.period * {step} + {step - 1} AS BIGINT)), {stop}) AS period_end,
  CAST(coalesce(c.n, 0) AS BIGINT) AS reports
FROM g LEFT JOIN c USING (station, period)"""


O_REPORT_COVERAGE = _coverage_sql(COVERAGE_NOW)
O_REPORT_COVERAGE_YEAR = _coverage_sql(COVERAGE_YEAR_NOW)


def q_raw_reply_parse(spark, sf):
    """Raw reply lines -> raw report table, exact station match by reply."""
    from stratus.sources.raw_reply import parse_replies

    lines = fixtures.reply_lines(spark, sf).withColumnRenamed("line_no", "line_order")
    return parse_replies(lines, station_pattern=r"^([0-9]+)/")


O_RAW_REPLY_PARSE = with_views("""
SELECT WMOIND, YEAR, MONTH, DAY, HOUR, MIN, REPORT FROM synop
WHERE CAST(DAY AS INTEGER) % 7 <> 3 AND WMOIND <> '98999'""", "synop")


def _landed(spark, sf, sep: str) -> str:
    """The synop reports landed as an undecoded CSV (separator ``sep``) in the
    shared checkpoint folder; returns the folder."""
    from stratus.session import scratch_path
    from stratus.sinks import write_raw_csv

    path = scratch_path(spark, "landed-undecoded")
    write_raw_csv(fixtures.view(spark, sf, "synop"), path, sep=sep)
    return path


def q_undecoded_csv_roundtrip(spark, sf):
    """Raw CSV sink (``;``) -> undecoded reader with separator detection."""
    from stratus.sources.undecoded import read_undecoded_csv

    return read_undecoded_csv(spark, _landed(spark, sf, ";"), sep="auto")


O_UNDECODED_CSV_ROUNDTRIP = with_views(
    "SELECT WMOIND, YEAR, MONTH, DAY, HOUR, MIN, REPORT FROM synop", "synop")


def q_decode_job_files(spark, sf):
    """The decode job from a landed CSV (``|``, detected) to Parquet, read back."""
    from stratus.plans.decode_job import run_decode
    from stratus.session import scratch_path

    out = scratch_path(spark, "decoded")
    run_decode(spark, _landed(spark, sf, "|"), out, sep="auto")
    return spark.read.parquet(out)


O_DECODE_JOB_FILES = with_views(f"""
SELECT r.station_id, r.date, r.time,
 {_coord_case(0)} AS lat, {_coord_case(1)} AS lon,
 x.t AS temp, x.p AS pressure, x.h AS humidity, x.ws AS wind_speed, x.wd AS wind_dir,
 x.cc AS cloud_cover, x.vis AS visibility_m, x.rn AS rain_3h, false AS decode_error
FROM (SELECT event_id AS report_id, {_STATION_CASE.replace('e%8', 'event_id%8')} AS station_id,
        strftime(ts, '%Y-%m-%d') AS date,
        lpad(CAST(CASE WHEN event_id%37=0 THEN 8 ELSE hour(ts) END AS VARCHAR), 2, '0') || ':'
        || lpad(CAST(CASE WHEN event_id%43=0 THEN 0 ELSE minute(ts) END AS VARCHAR), 2, '0')
        || ':00' AS time
      FROM events) r
JOIN synop_expected x USING (report_id)
""", "synop_expected")


def q_rollup_location_summary(spark, sf):
    """Humidity and rain per location from the daily rollup of one pass."""
    from stratus.operators import rollup

    r = rollup.statistics(_obs(spark, sf))
    return (rollup.average_humidity(r).join(rollup.total_rain(r), "location")
            .select("location", "avg_humidity", "total_rain_mm"))


O_ROLLUP_LOCATION_SUMMARY = with_views(f"""
SELECT location, round(avg(humidity), 2) AS avg_humidity, round(sum(rain), 2) AS total_rain_mm
FROM {_CLEAN} c GROUP BY location""", "obs")


def q_raw_preview(spark, sf):
    """The first 30 raw reports in report order."""
    from stratus.sinks import preview

    raw = fixtures.view(spark, sf, "synop").select("report_id", "WMOIND", "YEAR", "MONTH", "DAY",
                                                   "HOUR", "MIN", "REPORT")
    return preview(raw, 30, order_by=["report_id"])


O_RAW_PREVIEW = with_views("""
SELECT report_id, WMOIND, YEAR, MONTH, DAY, HOUR, MIN, REPORT FROM synop
ORDER BY report_id LIMIT 30""", "synop")


def _from_state(spark, sf):
    """The observations in three landings, days in all of them, each kept as a
    state of its own; statistics of the merged states."""
    from stratus.session import scratch_path

    path, obs = scratch_path(spark, "state"), _obs(spark, sf)
    landing = F.pmod(F.xxhash64("location", "ts"), F.lit(3))
    for k in range(3):
        rollup.append_state(obs.where(landing == k), path)
    return rollup.statistics_from_state(rollup.merged_state(spark.read.parquet(path)))


def q_state_daily_temp(spark, sf):
    return rollup.daily_temperature(_from_state(spark, sf))


def q_state_total_rain(spark, sf):
    return rollup.total_rain(_from_state(spark, sf))


def _clustered(spark, sf):
    """All observations in two landings of a clustered store: its path and schema."""
    from stratus.session import scratch_path
    from stratus.sources.clustered import append_clustered

    path, obs = scratch_path(spark, "clustered"), fixtures.view(spark, sf, "obs")
    late = F.col("obs_id") % 5 == 0
    append_clustered(obs.where(~late), path, files=16)
    append_clustered(obs.where(late), path, files=4)
    return path, obs.schema


def q_clustered_range(spark, sf):
    """Daily temperatures of one location over ten days: a range read of the
    store that holds all observations (the range is the feature)."""
    from stratus.sources.clustered import read_clustered

    path, schema = _clustered(spark, sf)
    days = (_dt.datetime(2024, 1, 10), _dt.datetime(2024, 1, 19, 23, 59, 59, 999999))
    rows = read_clustered(spark, path, schema, {"location": ("click", "click"), "ts": days})
    return rows.groupBy("location", F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("temp").alias("max_temp"), F.min("temp").alias("min_temp"))


O_CLUSTERED_RANGE = with_views("""
SELECT location, CAST(ts AS DATE) AS date, count(*) AS rows, max(temp) AS max_temp, min(temp) AS min_temp
FROM obs WHERE location = 'click' AND ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
GROUP BY location, CAST(ts AS DATE)""", "obs")


def q_footer_location_counts(spark, sf):
    """Rows per location of the observations stored by location, from footers."""
    from stratus.session import scratch_path
    from stratus.sinks import write_parquet
    from stratus.sources.clustered import footer_counts

    path = scratch_path(spark, "by-location")
    write_parquet(fixtures.view(spark, sf, "obs"), path, partition_by=["location"])
    return footer_counts(spark, path, ["location"])


def q_clustered_file_rows(spark, sf):
    """Rows of the clustered store, in all, from its file table."""
    from stratus.sources.clustered import file_rows

    path, _ = _clustered(spark, sf)
    return file_rows(spark, path).agg(F.count(F.lit(1)).alias("landings"), F.sum("rows").alias("rows"))


O_CLUSTERED_FILE_ROWS = with_views("SELECT CAST(2 AS BIGINT) AS landings, count(*) AS rows FROM obs", "obs")


def q_materialized_total_rain(spark, sf):
    """Cleaned observations written once as Parquet in the shared checkpoint
    folder (lineage cut), then the rain total read from it."""
    from stratus.plans.analysis_job import materialize

    return rollup.total_rain(rollup.statistics(materialize(_obs(spark, sf), "parquet", name="clean-obs"), "location"))


def q_stream_decode_files(spark, sf):
    """Landed CSV -> streaming decode (available-now trigger) -> Parquet."""
    from stratus.session import scratch_path
    from stratus.streaming import start_decode_stream

    out = scratch_path(spark, "stream-decoded")
    query = start_decode_stream(spark, _landed(spark, sf, ","), out,
                                checkpoint=scratch_path(spark, "stream-ckpt"))
    query.awaitTermination()
    return spark.read.parquet(out)


def q_raw_record_counts(spark, sf):
    """Records per station in the raw report table."""
    from stratus.sinks import raw_counts

    return raw_counts(fixtures.view(spark, sf, "synop"))


O_RAW_RECORD_COUNTS = with_views(
    "SELECT WMOIND, count(*) AS records FROM synop GROUP BY WMOIND", "synop")


def q_synop_decode_extras(spark, sf):
    """The optional decode outputs: dew point, cloud base, rain duration and
    the unphysical-dew-point flag."""
    raw = spread(fixtures.view(spark, sf, "synop"), spark.sparkContext.defaultParallelism)
    return decode_reports(raw, "REPORT", extras=True).select(
        "report_id", "dewpoint", "cloud_base_m", "rain_duration_h", "dewpoint_gt_temp")


def _extras_sql() -> str:
    base = " ".join(f"WHEN {k} THEN {float(v)!r}e0" .replace(".0e0", "e0")
                    for k, v in codes.CLOUD_BASE_M.items())
    return f"""
SELECT e AS report_id,
  CASE WHEN e%41<>0 THEN td END AS dewpoint,
  CASE WHEN e%41<>0 THEN CASE e%10 {base} END END AS cloud_base_m,
  CASE WHEN e%41<>0 THEN CASE WHEN ir IN (0,1) AND e%2=0 THEN 6e0 WHEN ir IN (0,2) THEN 3e0 END END
    AS rain_duration_h,
  coalesce(e%41<>0 AND t IS NOT NULL AND td > t, false) AS dewpoint_gt_temp
FROM (SELECT event_id AS e, event_id%5 AS ir,
        CASE WHEN event_id%31=0 THEN (event_id*37)%500+20
             ELSE greatest((event_id*37)%500-event_id%120, 0) END / 10e0 AS td,
        CASE WHEN event_id%19<>0 THEN CASE WHEN event_id%29=0 THEN -((event_id*37)%500)/10e0
             ELSE ((event_id*37)%500)/10e0 END END AS t
      FROM events) k"""


O_SYNOP_DECODE_EXTRAS = with_views(_extras_sql())


_FILE_NAME_SQL = """CASE event_id%4 WHEN 0 THEN 'Decoded' || event_type || '.csv'
  WHEN 1 THEN 'decoded' || upper(event_type) || '.csv'
  WHEN 2 THEN event_type || '_station.v2.csv'
  ELSE 'x' || 'DECODED' || event_type || '.csv' END"""


def q_location_from_file_names(spark, sf):
    """Location labels from file names (one name per event)."""
    from stratus.sources.observations import location_from_file

    fixtures.register_tables(spark, sf, ["events"])
    names = spark.table("events").selectExpr("event_id", f"{_FILE_NAME_SQL} AS file_name")
    return names.select("event_id", "file_name", location_from_file("file_name").alias("location"))


O_LOCATION_FROM_FILE_NAMES = with_views(f"""
SELECT event_id, file_name,
  CASE WHEN regexp_extract(stem, '(?i)Decoded(.+)', 1) <> '' THEN regexp_extract(stem, '(?i)Decoded(.+)', 1)
       ELSE stem END AS location
FROM (SELECT event_id, file_name, regexp_replace(file_name, '\\.[^./]*$', '') AS stem
      FROM (SELECT event_id, {_FILE_NAME_SQL} AS file_name FROM events) n) s""")


def q_result_csv_roundtrip(spark, sf):
    """The rain result written by the result sink and read back."""
    from stratus.session import scratch_path
    from stratus.sinks import write_result_csv

    path = scratch_path(spark, "result-total-rain")
    write_result_csv(rollup.total_rain(rollup.statistics(_obs(spark, sf), "location")), path)
    return spark.read.schema("location string, total_rain_mm double").option("header", True).csv(path)


def q_lenient_records(spark, sf):
    """Malformed date/time fields: lenient parse, clamping and error rows."""
    return decode_raw(fixtures.view(spark, sf, "lenient"), keep=["report_id"])


O_LENIENT_RECORDS = f"""
SELECT report_id, station_id,
  CASE WHEN err THEN '' ELSE strftime(make_date(y, mo, least(d, day(last_day(make_date(y, mo, 1))))), '%Y-%m-%d') END AS date,
  CASE WHEN err THEN '' ELSE lpad(CAST(h AS VARCHAR), 2, '0') || ':' || lpad(CAST(mi AS VARCHAR), 2, '0') || ':00' END AS time,
  CASE WHEN NOT err THEN {_coord_case(0)} END AS lat, CASE WHEN NOT err THEN {_coord_case(1)} END AS lon,
  CASE WHEN NOT err THEN 25.5e0 END AS temp, CAST(NULL AS DOUBLE) AS pressure, CAST(NULL AS DOUBLE) AS humidity,
  CASE WHEN NOT err THEN 4e0 END AS wind_speed, CASE WHEN NOT err THEN 120e0 END AS wind_dir,
  CASE WHEN NOT err THEN 8e0 END AS cloud_cover, CASE WHEN NOT err THEN 25000e0 END AS visibility_m,
  CASE WHEN NOT err THEN 0e0 END AS rain_3h, err AS decode_error
FROM (SELECT *, y < 1 OR y > 9999 AS err FROM (
  SELECT event_id AS report_id, CASE WHEN event_id%6=0 THEN '98444' ELSE '98446' END AS station_id,
    CASE WHEN event_id%97=0 THEN 0 WHEN event_id%89=0 THEN 10000 WHEN event_id%7=0 THEN year(ts)
         WHEN event_id%11=0 THEN 2000 ELSE year(ts) END AS y,
    CASE WHEN event_id%5=0 THEN 12 WHEN event_id%13=0 THEN 1 ELSE month(ts) END AS mo,
    CASE WHEN event_id%3=0 THEN 31 ELSE day(ts) END AS d,
    CASE WHEN event_id%4=0 THEN hour(ts) WHEN event_id%17=0 THEN 23 ELSE hour(ts) END AS h,
    CASE WHEN event_id%9=0 THEN 0 WHEN event_id%19=0 THEN 59 ELSE minute(ts) END AS mi
  FROM events) a) b"""


def q_observation_folder_summary(spark, sf):
    """Observations landed as analysis CSVs (12-column schema, header) in the
    shared folder, read back by the folder reader, cleaned and summarized by
    station."""
    from stratus.schemas import OBSERVATION_COLUMNS
    from stratus.session import scratch_path
    from stratus.sources.observations import read_observations

    obs = fixtures.view(spark, sf, "obs")
    cols = {"station_id": F.col("location"),
            "datetime": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
            "lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")}
    landed = obs.select(*[(cols[c] if c in cols else F.col(c)).alias(c) for c in OBSERVATION_COLUMNS])
    folder = scratch_path(spark, "observations")
    landed.write.option("header", True).csv(folder)
    clean = clean_observations(read_observations(spark, folder))
    return (clean.groupBy("station_id")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.round(F.avg("humidity"), 2).alias("avg_humidity"),
                 F.round(F.sum("rain_3h"), 2).alias("total_rain_mm")))


O_OBSERVATION_FOLDER_SUMMARY = with_views(f"""
SELECT location AS station_id, count(*) AS rows, round(avg(humidity), 2) AS avg_humidity,
       round(sum(rain), 2) AS total_rain_mm
FROM {_CLEAN} c GROUP BY location""", "obs")


# --------------------------------------------------------------------------
# seldom report branches and whole jobs over landed files
# --------------------------------------------------------------------------

def q_synop_hard(spark, sf):
    return decode_reports(fixtures.view(spark, sf, "synop_hard"), "REPORT").drop("REPORT")


O_SYNOP_HARD = with_views("""
SELECT e AS report_id, t AS temp, CASE WHEN e%2=0 THEN (e%300)/10e0 + 1000e0 ELSE 990e0 END AS pressure,
  greatest(0e0, least(100e0, round(100e0*exp(17.625e0*td/(243.04e0+td)-17.625e0*t/(243.04e0+t)),1))) AS humidity,
  CASE WHEN e%5 IN (2,3) THEN round(ff*0.514444e0,1) ELSE ff END AS wind_speed,
  CASE WHEN wind AND e%13>1 THEN e%37*10e0 END AS wind_dir,
  CASE WHEN wind AND e%10<>9 THEN e%9*1e0 ELSE 4e0 END AS cloud_cover,
  CASE WHEN index AND e%9<>0 THEN e%51*100e0 END AS visibility_m,
  CASE WHEN e%3=0 THEN e%989*1e0 WHEN index AND e%6 IN (0,2) AND e%19%4=1 THEN e%500*1e0
       WHEN index AND e%6=3 THEN 0e0 END AS rain_3h
FROM (SELECT *, CASE WHEN wind AND e%17>2 THEN e%60*1e0 WHEN wind AND e%17=2 THEN (100+e%50)*1e0 END AS ff
      FROM (SELECT event_id AS e, event_id%7<>0 AS index, event_id%7<>0 AND event_id%11<>0 AS wind,
                   (event_id%300)/10e0 AS t, (event_id%250)/10e0 AS td FROM events) a) b""")

_MARKED = """REPORT || ', "q" ; | end'"""


def q_undecoded_mixed_files(spark, sf):
    """Files of four separators and two column orders, values with quotes and
    separators, read in one scan with detection."""
    from stratus.schemas import RAW_COLUMNS
    from stratus.session import scratch_path
    from stratus.sources.undecoded import SEPARATORS, read_undecoded_csv

    raw = fixtures.view(spark, sf, "synop").withColumn("REPORT", F.expr(_MARKED))
    base = scratch_path(spark, "landed-mixed")
    for k, sep in enumerate(SEPARATORS):
        order = RAW_COLUMNS[::-1] if k % 2 else RAW_COLUMNS
        (raw.where(F.col("report_id") % len(SEPARATORS) == k).select(*order).write.option("header", True)
         .option("sep", sep).option("escape", '"').option("emptyValue", "").csv(f"{base}/{k}"))
    return read_undecoded_csv(spark, f"{base}/*")


O_UNDECODED_MIXED_FILES = with_views(
    f"SELECT WMOIND, YEAR, MONTH, DAY, HOUR, MIN, {_MARKED} AS REPORT FROM synop", "synop")

_BROKEN = "CASE WHEN report_id%5=0 THEN replace(REPORT, ' 333 ', chr(10) || '333 ') ELSE REPORT END"


def q_undecoded_multiline(spark, sf):
    """A fifth of the reports holds a quoted line break; default options."""
    from stratus.session import scratch_path
    from stratus.sinks import write_raw_csv
    from stratus.sources.undecoded import read_undecoded_csv

    path = scratch_path(spark, "landed-multiline")
    write_raw_csv(fixtures.view(spark, sf, "synop").withColumn("REPORT", F.expr(_BROKEN)), path)
    return read_undecoded_csv(spark, path)


O_UNDECODED_MULTILINE = with_views(
    f"SELECT WMOIND, YEAR, MONTH, DAY, HOUR, MIN, {_BROKEN} AS REPORT FROM synop", "synop")


def q_reply_files(spark, sf):
    """Reply files, one per station and day, through the reply reader."""
    from stratus.session import scratch_path
    from stratus.sources.raw_reply import read_replies

    path = scratch_path(spark, "landed-replies")
    (fixtures.reply_lines(spark, sf).repartition("reply").sortWithinPartitions("reply", "line_no")
     .select("reply", "line").write.partitionBy("reply").text(path))
    return read_replies(spark, f"{path}/*", station_pattern="reply=([0-9]+)")


_TEXT_LAT = "CASE line_no%5 WHEN 1 THEN lat || 'D' WHEN 2 THEN '1_0.5' ELSE lat END"


def q_station_csv_files(spark, sf):
    """The station CSV reader: repeated ids, numbers that are none, underscores."""
    from stratus.session import scratch_path
    from stratus.sources.stations import read_station_csv

    path = scratch_path(spark, "landed-stations")
    (fixtures.view(spark, sf, "stations_ext").withColumn("lat", F.expr(_TEXT_LAT)).orderBy("line_no")
     .select("wmo_id", "lat", "lon").write.option("header", True).csv(path))
    return read_station_csv(spark, path)


O_STATION_CSV_FILES = with_views("""
SELECT wmo_id, arg_max(number, line_no) AS lat, arg_max(CAST(lon AS DOUBLE), line_no) AS lon
FROM (SELECT *, CASE line_no%5 WHEN 1 THEN NULL WHEN 2 THEN 10.5e0 ELSE TRY_CAST(lat AS DOUBLE) END AS number
      FROM stations_ext) s
WHERE number IS NOT NULL GROUP BY wmo_id""", "stations_ext")


def q_observation_files(spark, sf):
    """One CSV per location, its name with spaces and signs: rows per file."""
    from stratus.schemas import OBSERVATION_COLUMNS
    from stratus.sources.observations import read_observations, rows_per_file

    cols = {"station_id": F.col("location"), "datetime": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
            "lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")}
    obs = fixtures.view(spark, sf, "obs").select(
        *[(cols[c] if c in cols else F.col(c)).alias(c) for c in OBSERVATION_COLUMNS])
    folder = fixtures.land_one_file_per_location(obs, "station_id", lambda place: f"Decoded {place} +50%.csv")
    return rows_per_file(read_observations(spark, folder))


O_OBSERVATION_FILES = with_views("""
SELECT 'Decoded ' || location || ' +50%.csv' AS file_name, ' ' || location || ' +50%' AS location, count(*) AS rows
FROM obs GROUP BY ALL""", "obs")


def q_decode_files_counts(spark, sf):
    """The run counts that the decode job observes while it writes CSV text."""
    from stratus.plans.decode_job import run_decode
    from stratus.session import scratch_path

    return run_decode(spark, _landed(spark, sf, "\t"), scratch_path(spark, "decoded-text"), csv_output=True)


O_DECODE_FILES_COUNTS = """
SELECT count(*) AS rows_decoded, CAST(0 AS BIGINT) AS errors, count(*) FILTER (WHERE event_id%41=0) AS nil_or_empty
FROM events"""


def q_raw_to_results(spark, sf):
    """Raw CSVs to results in one job, by way of the decoder's CSV text with
    ``NaN`` for missing numbers."""
    from stratus.plans.analysis_job import analyse_raw

    out = analyse_raw(spark, _landed(spark, sf, ";"), "station_id", csv_text=True)
    return (out["rows_per_location"].join(out["avg_humidity"], "location").join(out["total_rain"], "location")
            .select("location", "rows", "avg_humidity", "total_rain_mm"))


def q_raw_to_daily_temp(spark, sf):
    """Raw CSVs to the daily temperatures in one job, by way of Parquet."""
    from stratus.plans.analysis_job import analyse_raw

    return analyse_raw(spark, _landed(spark, sf, ","), "station_id", sep=",")["daily_avg_temp"]


QUERIES = {
    "synop_decode": (q_synop_decode, O_SYNOP_DECODE),
    "synop_decoded_table": (q_synop_decoded_table, O_SYNOP_DECODED_TABLE),
    "synop_decode_extras": (q_synop_decode_extras, O_SYNOP_DECODE_EXTRAS),
    "synop_station_override": (q_synop_station_override, O_SYNOP_STATION_OVERRIDE),
    "lenient_records": (q_lenient_records, O_LENIENT_RECORDS),
    "synop_run_counts": (q_synop_run_counts, O_SYNOP_RUN_COUNTS),
    "avg_humidity": (q_avg_humidity, O_AVG_HUMIDITY),
    "total_rain": (q_total_rain, O_TOTAL_RAIN),
    "daily_avg_temp": (q_daily_temp, O_DAILY_TEMP),
    "wind_trend_daily": (q_daily_wind, O_DAILY_WIND),
    "monthly_avg_temp": (q_monthly_temp, O_MONTHLY_TEMP),
    "clean_daily_counts": (q_clean_daily_counts, O_CLEAN_DAILY_COUNTS),
    "location_counts": (q_location_counts, O_LOCATION_COUNTS),
    "wind_temp_bins": (q_wind_bins, O_WIND_BINS),
    "wind_bin_weights": (q_bin_weights, O_BIN_WEIGHTS),
    "wind_temp_fit": (q_wind_trend, O_WIND_TREND),
    "wind_temp_fit_line": (q_wind_fit_line, O_WIND_FIT_LINE),
    "correlation_matrix": (q_correlation, O_CORRELATION),
    "correlation_lower": (q_correlation_lower, O_CORRELATION_LOWER),
    "month_extremes": (q_month_extremes, O_MONTH_EXTREMES),
    "month_axis_ranges": (q_month_ranges, O_MONTH_RANGES),
    "state_daily_temp": (q_state_daily_temp, O_STATE_DAILY_TEMP),
    "state_total_rain": (q_state_total_rain, O_STATE_TOTAL_RAIN),
    "humidity_ranks": (q_humidity_ranks, O_HUMIDITY_RANKS),
    "palette_slots": (q_palette_slots, O_PALETTE_SLOTS),
    "station_summary": (q_station_summary, O_STATION_SUMMARY),
    "station_daily_temp": (q_station_daily_temp, O_STATION_DAILY_TEMP),
    "report_coverage": (q_report_coverage, O_REPORT_COVERAGE),
    "raw_reply_parse": (q_raw_reply_parse, O_RAW_REPLY_PARSE),
    "undecoded_csv_roundtrip": (q_undecoded_csv_roundtrip, O_UNDECODED_CSV_ROUNDTRIP),
    "decode_job_files": (q_decode_job_files, O_DECODE_JOB_FILES),
    "rollup_location_summary": (q_rollup_location_summary, O_ROLLUP_LOCATION_SUMMARY),
    "raw_preview": (q_raw_preview, O_RAW_PREVIEW),
    "clustered_range": (q_clustered_range, O_CLUSTERED_RANGE),
    "clustered_file_rows": (q_clustered_file_rows, O_CLUSTERED_FILE_ROWS),
    "footer_location_counts": (q_footer_location_counts, O_LOCATION_COUNTS),
    "materialized_total_rain": (q_materialized_total_rain, O_TOTAL_RAIN),
    "stream_decode_files": (q_stream_decode_files, O_DECODE_JOB_FILES),
    "raw_record_counts": (q_raw_record_counts, O_RAW_RECORD_COUNTS),
    "location_from_file_names": (q_location_from_file_names, O_LOCATION_FROM_FILE_NAMES),
    "result_csv_roundtrip": (q_result_csv_roundtrip, O_TOTAL_RAIN),
    "observation_folder_summary": (q_observation_folder_summary, O_OBSERVATION_FOLDER_SUMMARY),
    "report_coverage_year": (q_report_coverage_year, O_REPORT_COVERAGE_YEAR),
    "synop_hard": (q_synop_hard, O_SYNOP_HARD),
    "undecoded_mixed_files": (q_undecoded_mixed_files, O_UNDECODED_MIXED_FILES),
    "undecoded_multiline": (q_undecoded_multiline, O_UNDECODED_MULTILINE),
    "reply_files": (q_reply_files, O_RAW_REPLY_PARSE),
    "station_csv_files": (q_station_csv_files, O_STATION_CSV_FILES),
    "observation_files": (q_observation_files, O_OBSERVATION_FILES),
    "decode_files_counts": (q_decode_files_counts, O_DECODE_FILES_COUNTS),
    "raw_to_results": (q_raw_to_results, O_STATION_SUMMARY),
    "raw_to_daily_temp": (q_raw_to_daily_temp, O_STATION_DAILY_TEMP),
}
