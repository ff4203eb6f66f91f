"""Aggregates and chart data on small frames."""

import datetime as dt

import pytest

from stratus.operators import aggregates as agg
from stratus.operators import rollup
from stratus.operators import chartdata as chart
from stratus.operators.clean import clean_observations
from stratus.operators.coverage import period_bounds, period_coverage

SCHEMA = ("location string, datetime string, temp double, pressure double, humidity double, "
          "wind_speed double, wind_dir double, cloud_cover double, visibility double, rain_3h double")


def frame(spark, rows):
    return clean_observations(spark.createDataFrame(rows, SCHEMA))


def test_null_timestamp_groups_are_kept(spark):
    df = frame(spark, [("A", "2024-01-01 00:00:00", 20.0, None, None, 1.0, 0.0, 0.0, 0.0, None),
                       ("A", "bad", 30.0, None, None, 3.0, 0.0, 0.0, 0.0, None)])
    monthly = [(str(r.month), r.avg_temp) for r in rollup.monthly_temperature(rollup.statistics(df, "month")).collect()]
    assert monthly == [("None", 30.0), ("2024-01-01 00:00:00", 20.0)]
    wind = [(str(r.date), r.avg_wind_speed) for r in rollup.daily_wind(rollup.statistics(df, "day")).collect()]
    assert wind == [("None", 3.0), ("2024-01-01", 1.0)]


def test_temperature_band_is_inclusive(spark):
    df = frame(spark, [("A", "2024-01-01 00:00:00", t, None, None, None, 0.0, 0.0, 0.0, None)
                       for t in (9.9, 10.0, 45.0, 45.1)])
    (r,) = rollup.monthly_temperature(rollup.statistics(df, "month")).collect()
    assert (r.avg_temp, r.min_temp, r.max_temp) == (27.5, 10.0, 45.0)


def test_all_key_readings_missing_dropped_and_rain_filled(spark):
    df = frame(spark, [("A", "2024-01-01 00:00", None, None, None, None, 1.0, 1.0, 1.0, 5.0),
                       ("A", "2024-01-01 00:00", None, None, float("nan"), 2.0, 1.0, 1.0, 1.0, None)])
    rows = df.collect()
    assert len(rows) == 1 and rows[0].rain_3h == 0.0 and rows[0].humidity is None


def test_correlation_constant_column_is_zero(spark):
    rows = [("A", "2024-01-01 00:00", float(i), 1000.0, 50.0 + i, 2.0 * i, None, 1.0, 1.0, 0.0)
            for i in range(10)]
    m = {(r.var_x, r.var_y): r.corr for r in agg.correlation_matrix(frame(spark, rows)).collect()}
    assert len(m) == 64
    assert m[("temp", "humidity")] == 1.0 and m[("temp", "wind_speed")] == 1.0
    assert m[("temp", "pressure")] == 0.0      # constant column
    assert m[("temp", "wind_dir")] == 0.0      # no pairs
    assert m[("pressure", "pressure")] == 0.0
    low = agg.correlation_lower_triangle(frame(spark, rows)).collect()
    assert len(low) == 36 and {r.row_label for r in low} >= {"Temp", "Rainfall"}


def test_bins_weights_and_trend(spark):
    rows = []
    for k in range(12):
        for _ in range(k + 1):
            rows.append(("A", "2024-01-01 00:00", 20.0 + k, 1000.0, 50.0, 0.5 * k + 0.2, 0.0, 0.0, 0.0, 0.0))
    rows.append(("A", "2024-01-01 00:00", 20.0, 1000.0, 50.0, 30.0, 0.0, 0.0, 0.0, 0.0))  # wind out of band
    rows.append(("B", "2024-01-01 00:00", 20.0, 1000.0, 50.0, 1.0, 0.0, 0.0, 0.0, 0.0))
    df = frame(spark, rows)
    bins = chart.wind_temperature_bins(df)
    a = sorted((r.ws_bin, r.avg_temp, r.n) for r in bins.where("location = 'A'").collect())
    assert a[0] == (0.0, 20.0, 1) and a[-1] == (5.5, 31.0, 12) and len(a) == 12
    w = {r.ws_bin: r.weight for r in chart.bin_weights(bins).where("location = 'A'").collect()}
    # counts 1..12: p95 = 11.45, so 12 is clipped to 11.45 and 11 stays
    assert w[5.5] == pytest.approx(215.0) and w[5.0] == pytest.approx(11 / 11.45 * 200 + 15)
    trend = chart.wind_temperature_trend(bins).collect()
    assert [r.location for r in trend] == ["A"]            # B has one bin
    assert trend[0].slope == pytest.approx(2.0) and trend[0].intercept == pytest.approx(20.0)
    line = chart.trend_line(chart.wind_temperature_trend(bins)).orderBy("point").collect()
    assert len(line) == 100 and line[0].x == 0.0 and line[-1].x == 5.5
    assert line[-1].y == pytest.approx(31.0)


def test_extremes_ranges_ranks_palette(spark):
    monthly = spark.createDataFrame(
        [("A", dt.datetime(2024, 1, 1), 20.0), ("A", dt.datetime(2024, 2, 1), 25.0),
         ("A", dt.datetime(2024, 3, 1), 25.0), ("A", dt.datetime(2024, 4, 1), 20.0),
         ("B", dt.datetime(2024, 1, 1), 14.0)], "location string, month timestamp_ntz, avg_temp double")
    ext = {r.location: r for r in chart.monthly_extremes(monthly).collect()}
    assert ext["A"].hottest_month == dt.datetime(2024, 2, 1) and ext["A"].coldest_month == dt.datetime(2024, 1, 1)
    rng = {r.location: (r.axis_low, r.axis_high, r.fill_floor) for r in chart.monthly_ranges(monthly).collect()}
    assert rng == {"A": (18.0, 27.5, 19.5), "B": (15.0, 16.5, 13.5)}
    hum = spark.createDataFrame([("A", 80.0), ("B", 90.0), ("C", None), ("D", 80.0)],
                                "location string, avg_humidity double")
    ranks = [(r.location, r.rank, r.bar_colour)
             for r in chart.humidity_ranks(hum).orderBy("rank").collect()]
    # bars in ascending order A, D, B, then the NULL: palette slots 0, 1, 2, 3
    assert ranks == [("B", 1, "#3fbf99"), ("A", 2, "#5b9bd5"), ("D", 3, "#9b72cf"),
                     ("C", 4, "#e8a838")]
    locs = spark.createDataFrame([(f"L{i:02d}",) for i in range(10)], "location string")
    pal = {r.location: (r.palette_index, r.colour) for r in chart.palette_slots(locs).collect()}
    assert pal["L00"] == (0, "#5b9bd5") and pal["L08"] == (0, "#5b9bd5") and pal["L07"][0] == 7


def test_period_bounds():
    start, stop, n = period_bounds(2000, 2001, 365, now=dt.datetime(2030, 1, 1))
    # 2000 is a leap year: the third 365-day period is Dec 31, 2001 alone
    assert start == dt.datetime(2000, 1, 1) and stop == dt.datetime(2001, 12, 31, 23, 59) and n == 3
    _, stop, n = period_bounds(2024, 2024, 7, now=dt.datetime(2024, 1, 8, 0, 0, 30))
    assert stop == dt.datetime(2024, 1, 8, 0, 0) and n == 2
    with pytest.raises(ValueError):
        period_bounds(2025, 2024, 7)


def test_period_coverage_zero_fill(spark):
    reports = spark.createDataFrame(
        [("S1", dt.datetime(2024, 1, 1, 0, 0)), ("S1", dt.datetime(2024, 1, 7, 23, 59)),
         ("S1", dt.datetime(2024, 1, 8, 0, 0)), ("S2", dt.datetime(2024, 1, 15, 12, 0)),
         ("S2", dt.datetime(2023, 12, 31, 23, 0))], "station_id string, ts timestamp_ntz")
    cov = period_coverage(reports, 2024, 2024, 7, now=dt.datetime(2024, 1, 15, 12, 0))
    got = sorted((r.station, r.period, r.reports, str(r.period_end)) for r in cov.collect())
    assert got == [("S1", 0, 2, "2024-01-07 23:59:00"), ("S1", 1, 1, "2024-01-14 23:59:00"),
                   ("S1", 2, 0, "2024-01-15 12:00:00"), ("S2", 0, 0, "2024-01-07 23:59:00"),
                   ("S2", 1, 0, "2024-01-14 23:59:00"), ("S2", 2, 1, "2024-01-15 12:00:00")]


def test_hot_location_results_whole_and_partially_aggregated(spark):
    # one location holds ~90 % of the rows: every row still counts, and each
    # aggregation combines map-side before its shuffle
    rows = [("HOT", f"2024-01-{1 + i % 28:02d} 00:00:00", 20.0 + i % 10, 1000.0, 50.0 + i % 7,
             1.0 + i % 5, 0.0, 1.0, 1.0, 0.5) for i in range(9000)]
    rows += [(f"L{i % 10}", "2024-01-01 00:00:00", 25.0, 1000.0, 60.0, 2.0, 0.0, 1.0, 1.0, 0.5)
             for i in range(1000)]
    df = frame(spark, rows).repartition(8)
    rain = {r.location: r.total_rain_mm for r in rollup.total_rain(rollup.statistics(df, "location")).collect()}
    assert rain["HOT"] == 4500.0 and sum(rain.values()) == 5000.0
    for result in (rollup.total_rain(rollup.statistics(df, "location")), rollup.average_humidity(rollup.statistics(df, "location")), rollup.daily_temperature(rollup.statistics(df, "day")),
                   chart.wind_temperature_bins(df)):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan, plan


def test_materialize_modes(spark):
    from stratus.plans.analysis_job import materialize

    df = frame(spark, [("A", "2024-01-01 00:00", 20.0, None, 50.0, 1.0, 0.0, 0.0, 0.0, 1.0),
                       ("B", "2024-01-02 00:00", 30.0, None, 60.0, 2.0, 0.0, 0.0, 0.0, 2.0)])
    want = sorted(tuple(r) for r in rollup.total_rain(rollup.statistics(df, "location")).collect())
    for mode in ("parquet", "checkpoint", "cache", "none"):
        got = sorted(tuple(r) for r in rollup.total_rain(rollup.statistics(materialize(df, mode), "location")).collect())
        assert got == want, mode


def test_period_coverage_with_station_list(spark):
    reports = spark.createDataFrame(
        [("S1", dt.datetime(2024, 1, 2, 0, 0)), ("S9", dt.datetime(2024, 1, 3, 0, 0))],
        "station_id string, ts timestamp_ntz")
    listed = spark.createDataFrame([("S1",), ("S2",)], "station_id string")
    cov = period_coverage(reports, 2024, 2024, 7, now=dt.datetime(2024, 1, 10, 0, 0), stations=listed)
    got = sorted((r.station, r.period, r.reports) for r in cov.collect())
    assert got == [("S1", 0, 1), ("S1", 1, 0), ("S2", 0, 0), ("S2", 1, 0)]
