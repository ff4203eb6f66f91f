"""Record preparation, coordinates and the decode job."""

from stratus.operators.prepare import prepare_records
from stratus.plans.decode_job import decode_raw, run_counts
from stratus.schemas import DECODED_COLUMNS, RAW_COLUMNS
from stratus.sources.stations import station_table

REPORT = "AAXX 01001 98444 32970 81204 10255 20220 30085="


def raw(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS))


def test_lenient_date_time(spark):
    rows = [("98444", "2024", "13", "31", "?8", "", REPORT),       # month clamps to 12
            ("98444", "2023", "2", "31", "YP", "75", REPORT),      # Feb 28, hour 0, minute 59
            ("98444", "2024", "2", "31", "6A", "5", REPORT),       # leap year
            ("98444", "", "", "", "", "", REPORT),                 # defaults
            ("98444", "Y2021x", "0", "0", "25", "-7", REPORT)]     # digits found, clamped
    got = [(r.date, r.time, r.decode_error)
           for r in prepare_records(raw(spark, rows)).collect()]
    assert got == [("2024-12-31", "08:00:00", False), ("2023-02-28", "00:59:00", False),
                   ("2024-02-29", "06:05:00", False), ("2000-01-01", "00:00:00", False),
                   ("2021-01-01", "23:07:00", False)]


def test_year_out_of_range_is_error_row(spark):
    rows = [(" 98444 ", "0", "1", "1", "0", "0", REPORT),
            ("98444", "123456789012345678901", "1", "1", "0", "0", REPORT)]
    out = decode_raw(raw(spark, rows)).collect()
    for r in out:
        assert r.station_id == "98444" and r.date == "" and r.time == ""
        assert r.decode_error is True
        assert r.lat is None and r.temp is None and r.pressure is None
    counts = run_counts(decode_raw(raw(spark, rows))).collect()[0]
    assert counts.rows_decoded == 2 and counts.errors == 2


def test_decoded_columns_and_builtin_coordinates(spark):
    rows = [("98444", "2024", "1", "1", "6", "0", REPORT),
            ("12345", "2024", "1", "1", "6", "0", REPORT)]
    out = decode_raw(raw(spark, rows))
    assert out.columns == DECODED_COLUMNS + ["decode_error"]
    a, b = out.collect()
    assert (a.lat, a.lon) == (13.15, 123.74) and a.temp == 25.5 and a.pressure == 1008.5
    assert b.lat is None and b.lon is None and b.temp == 25.5


def test_external_coordinates_override_last_wins(spark):
    ext = spark.createDataFrame(
        [(1, "98444", "1.0", "2.0"), (2, "98444", "bad", "3.0"), (3, "98444", "4.0", "5.0"),
         (4, " 55555 ", "6", "7"), (5, "55555", "8", "")],
        "line int, wmo_id string, lat string, lon string")
    st = station_table(ext, "line")
    rows = [("98444", "2024", "1", "1", "6", "0", REPORT), ("55555", "2024", "1", "1", "6", "0", REPORT),
            ("98446", "2024", "1", "1", "6", "0", REPORT)]
    got = [(r.station_id, r.lat, r.lon) for r in decode_raw(raw(spark, rows), st).collect()]
    assert got == [("98444", 4.0, 5.0), ("55555", 6.0, 7.0), ("98446", 13.57, 124.20)]


def test_coordinates_shuffle_join_fallback_with_hot_station(spark):
    from stratus.operators.prepare import attach_coordinates, prepare_records

    rows = [("98444", "2024", "1", "1", "6", "0", REPORT)] * 900 + \
           [(f"9{i:04d}", "2024", "1", "1", "6", "0", REPORT) for i in range(100)]
    ext = station_table(spark.createDataFrame(
        [(1, "98444", "1.5", "2.5"), (2, "90007", "3", "4")], "line int, wmo_id string, lat string, lon string"),
        "line")
    prepared = prepare_records(raw(spark, rows).repartition(8))
    for bound in ("10m", "-1"):          # Spark's byte threshold: broadcast, then the shuffle join
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        out = attach_coordinates(prepared, ext)
        got = {(r.station_id, r.lat, r.lon, r.n) for r in
               out.groupBy("station_id", "lat", "lon").count().withColumnRenamed("count", "n").collect()}
        assert ("98444", 1.5, 2.5, 900) in got and ("90007", 3.0, 4.0, 1) in got
        assert sum(n for *_, n in got) == 1000
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
