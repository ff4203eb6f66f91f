"""Readers and sinks with small files in temp folders."""

import os

import pytest

from stratus.plans.analysis_job import run_analysis
from stratus.plans.decode_job import run_decode
from stratus.sinks import write_decoded_csv, write_raw_csv
from stratus.sources.observations import read_observations, rows_per_file
from stratus.sources.raw_reply import read_replies
from stratus.sources.stations import read_station_csv
from stratus.sources.undecoded import detect_separators, read_undecoded_csv


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_raw_replies(spark, tmp_dir):
    d = os.path.join(tmp_dir, "replies")
    write(d, "r1.txt", "WMOIND,YEAR,MONTH,DAY,HOUR,MIN,REPORT\n98444,2024,01,01,00,00,AAXX 01001 98444 32970=\n"
                       "\n98445,2024,01,01,00,00,AAXX other\n 98444 , 2024,1,1,3,0,\"AAXX 01031, 98444=\"\n")
    write(d, "r2.txt", "98444,2024,01,02,06,00,AAXX 01061 98444 a,b,c=\n98444,2024,01,02,09\n"
                       "98444,2024,01,02,12,00\n\n   \n98440,2024,01,02,06,00,x\n")
    write(d, "r3.txt", "\n  Error: no data for this period\n98444,2024,01,02,06,00,x\n")
    write(d, "r4.txt", "Status: FORBIDDEN\n")
    write(d, "r5.txt", "")
    out = read_replies(spark, d, stations="98444").collect()
    got = sorted(tuple(r) for r in out)
    assert got == sorted([("98444", "2024", "01", "01", "00", "00", "AAXX 01001 98444 32970="),
                   ("98444", "2024", "1", "1", "3", "0", "AAXX 01031, 98444="),
                   ("98444", "2024", "01", "02", "06", "00", "AAXX 01061 98444 a,b,c="),
                   ("98444", "2024", "01", "02", "12", "00", "")])


def test_raw_reply_station_from_name(spark, tmp_dir):
    d = os.path.join(tmp_dir, "replies2")
    write(d, "synop_98444_2024.txt", "98444,2024,1,1,0,0,A\n98440,2024,1,1,0,0,B\n")
    write(d, "synop_98440_2024.txt", "98440,2024,1,1,0,0,C\n98444,2024,1,1,0,0,D\n")
    out = read_replies(spark, d, station_pattern=r"_(\d{5})_[^/]*$")
    assert sorted(r.REPORT for r in out.collect()) == ["A", "C"]


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_undecoded_separators(spark, tmp_dir, sep):
    d = os.path.join(tmp_dir, "undecoded")
    cols = ["WMOIND", "YEAR", "MONTH", "DAY", "HOUR", "MIN", "REPORT"]
    text = sep.join(cols) + "\n" + sep.join(["98444", "2024", "1", "2", "3", "", "AAXX 01031 98444 x="]) + "\n"
    write(d, "in.csv", text)
    seps = detect_separators(spark, d).collect()
    assert [r.sep for r in seps] == [sep]
    out = read_undecoded_csv(spark, d).collect()
    assert [tuple(r) for r in out] == [("98444", "2024", "1", "2", "3", "", "AAXX 01031 98444 x=")]


def test_undecoded_lower_case_and_missing(spark, tmp_dir):
    d = os.path.join(tmp_dir, "undecoded2")
    write(d, "a.csv", "wmoind;year;month;day;hour;report\n98444;2024;1;2;3;\"AAXX; x\"\n")
    out = read_undecoded_csv(spark, d).collect()
    assert [tuple(r) for r in out] == [("98444", "2024", "1", "2", "3", "", "AAXX; x")]


def test_station_csv(spark, tmp_dir):
    p = os.path.join(tmp_dir, "stations.csv")
    write(tmp_dir, "stations.csv", "wmo_id,lat,lon\n98444,1,2\n98444,x,3\n98444,4,5\n 77777 ,6.5,7\n")
    got = sorted(tuple(r) for r in read_station_csv(spark, p).collect())
    assert got == [("77777", 6.5, 7.0), ("98444", 4.0, 5.0)]
    assert read_station_csv(spark, os.path.join(tmp_dir, "absent.csv")).count() == 0


def test_decode_job_round_trip(spark, tmp_dir):
    d = os.path.join(tmp_dir, "undecoded3")
    write(d, "in.csv", "WMOIND|YEAR|MONTH|DAY|HOUR|MIN|REPORT\n"
                       "98444|2024|1|2|3|0|AAXX 01031 98444 32970 81204 10255 20220 30085=\n"
                       "98446|0|1|2|3|0|AAXX 01031 98446 NIL=\n")
    out = os.path.join(tmp_dir, "decoded")
    counts = run_decode(spark, d, out).collect()[0]
    assert counts.rows_decoded == 2 and counts.errors == 1
    rows = sorted(spark.read.parquet(out).collect(), key=lambda r: r.station_id)
    assert rows[0].temp == 25.5 and rows[0].date == "2024-01-02" and rows[0].time == "03:00:00"
    by_date = os.path.join(tmp_dir, "decoded_by_date")
    run_decode(spark, d, by_date, sep="auto", partition_by=["date"])
    assert any(n.startswith("date=") for n in os.listdir(by_date))
    assert spark.read.parquet(by_date).count() == 2
    csv_out = os.path.join(tmp_dir, "decoded_csv")
    write_decoded_csv(spark.read.parquet(out), csv_out)
    text = "".join(open(os.path.join(csv_out, f)).read() for f in sorted(os.listdir(csv_out))
                   if f.endswith(".csv"))
    assert "NaN" in text and text.startswith("station_id,date,time,lat,lon,temp")


def test_raw_sink(spark, tmp_dir):
    df = spark.createDataFrame([("98444", "2024", "1", "2", "3", "", "A, B")],
                               "WMOIND string, YEAR string, MONTH string, DAY string, HOUR string, MIN string, REPORT string")
    out = os.path.join(tmp_dir, "rawcsv")
    write_raw_csv(df, out)
    back = read_undecoded_csv(spark, out).collect()
    assert [tuple(r) for r in back] == [("98444", "2024", "1", "2", "3", "", "A, B")]


OBS_HEADER = "station_id,datetime,lat,lon,temp,pressure,humidity,wind_speed,wind_dir,cloud_cover,visibility,rain_3h\n"


def test_observation_folder_and_analysis(spark, tmp_dir):
    d = os.path.join(tmp_dir, "csv")
    write(d, "DecodedA.csv", OBS_HEADER
          + "98444,2024-01-01 06:00:00,13.15,123.74,25.0,1010,80,3.0,90,4,10000,1.5\n"
          + "98444,2024-01-01 09:00,13.15,123.74,27.0,1009,NaN,4.0,90,4,10000,NaN\n"
          + "98444,garbage,13.15,123.74,26.0,,,,,,,\n"
          + "98444,2024-01-02 06:00:00,13.15,123.74,NaN,NaN,,NaN,0,0,0,\n")
    write(d, "decodedB.csv", OBS_HEADER + "98446,2024-02-01 00:00:00,1,2,30.0,1000,70,2.0,0,1,100,0.5\n")
    write(d, "Other.csv", OBS_HEADER + "98446,2024-02-01 00:00:00,1,2,5.0,1000,90,2.0,0,1,100,\n")
    write(d, "notes.txt", "not read")
    obs = read_observations(spark, d)
    per_file = sorted((r.file_name, r.location, r.rows) for r in rows_per_file(obs).collect())
    assert per_file == [("DecodedA.csv", "A", 4), ("Other.csv", "Other", 1), ("decodedB.csv", "B", 1)]
    res = run_analysis(spark, d, out_dir=os.path.join(tmp_dir, "out"))
    hum = {r.location: r.avg_humidity for r in res["avg_humidity"].collect()}
    assert hum == {"A": 80.0, "B": 70.0, "Other": 90.0}
    rain = {r.location: r.total_rain_mm for r in res["total_rain"].collect()}
    assert rain == {"A": 1.5, "B": 0.5, "Other": 0.0}
    daily = [(r.location, str(r.date), r.avg_temp) for r in res["daily_avg_temp"].collect()]
    assert daily == [("A", "None", 26.0), ("A", "2024-01-01", 26.0), ("B", "2024-02-01", 30.0)]
    assert os.path.isdir(os.path.join(tmp_dir, "out", "monthly_avg_temp"))
    assert res["rows_after_cleaning"].collect()[0].rows == 5
    one = run_analysis(spark, d, materialize_mode="cache")
    assert {r.location: r.avg_humidity for r in one["avg_humidity"].collect()} == hum
    assert {r.location: r.total_rain_mm for r in one["total_rain"].collect()} == rain
    assert [(r.location, str(r.date), r.avg_temp) for r in one["daily_avg_temp"].collect()] == daily
    assert one["rows_after_cleaning"].collect()[0].rows == 5
    assert sorted(tuple(r) for r in one["rows_per_location"].collect()) == \
        sorted(tuple(r) for r in res["rows_per_location"].collect())
    assert [r.location for r in one["palette"].orderBy("palette_index").collect()] == ["A", "B", "Other"]


def test_observation_folder_errors(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        read_observations(spark, os.path.join(tmp_dir, "empty"))
    d = os.path.join(tmp_dir, "shifted")
    write(d, "DecodedX.csv", "station_id,date,time,lat,lon,temp,pressure,humidity,wind_speed,wind_dir,"
                             "cloud_cover,visibility_m,rain_3h\n98444,2024-01-01,06:00:00,1,2,3,4,5,6,7,8,9,10\n")
    with pytest.raises(Exception):
        read_observations(spark, d).collect()


def test_header_reply_short_row_reads_missing_as_empty(spark, tmp_dir):
    d = os.path.join(tmp_dir, "replies3")
    write(d, "r.txt", "WMOIND, YEAR ,MONTH,DAY,HOUR,MIN,REPORT,EXTRA\n98444,2024,01\n"
                      "98444,2024,01,02,03,04,R1,x,y\n")
    got = sorted(tuple(r) for r in read_replies(spark, d, stations=["98444"]).collect())
    assert got == [("98444", "2024", "01", "", "", "", ""),
                   ("98444", "2024", "01", "02", "03", "04", "R1")]


def test_separator_ties_and_none(spark, tmp_dir):
    d1 = os.path.join(tmp_dir, "tie")
    write(d1, "t.csv", "a;b,c\n")                 # one ';' and one ',' -> ','
    d2 = os.path.join(tmp_dir, "none")
    write(d2, "n.csv", "abc\n")                   # nothing -> ','
    d3 = os.path.join(tmp_dir, "late")
    write(d3, "l.csv", "x" * 5000 + "\n" + "|" * 50 + "\n" + "a;b\n")   # beyond 4,096 chars
    assert [r.sep for r in detect_separators(spark, d1).collect()] == [","]
    assert [r.sep for r in detect_separators(spark, d2).collect()] == [","]
    assert [r.sep for r in detect_separators(spark, d3).collect()] == [","]


def test_undecoded_files_with_different_column_orders(spark, tmp_dir):
    d = os.path.join(tmp_dir, "orders")
    write(d, "a.csv", "WMOIND,YEAR,MONTH,DAY,HOUR,MIN,REPORT\n98444,2024,1,2,3,4,R1\n")
    write(d, "b.csv", "REPORT,MIN,HOUR,DAY,MONTH,YEAR,WMOIND\nR2,5,6,7,8,2023,98446\n")
    got = sorted(tuple(r) for r in read_undecoded_csv(spark, d).collect())
    assert got == [("98444", "2024", "1", "2", "3", "4", "R1"),
                   ("98446", "2023", "8", "7", "6", "5", "R2")]


def test_package_level_usage(spark, tmp_dir):
    from pyspark.sql import functions as F

    import stratus
    from stratus.operators.clean import decoded_to_observations

    landed = os.path.join(tmp_dir, "landed")
    write(landed, "in.csv", "WMOIND;YEAR;MONTH;DAY;HOUR;MIN;REPORT\n"
                            "98444;2024;1;2;3;0;AAXX 02031 98444 32970 81204 10255 20220 30085=\n"
                            "98444;2024;1;3;3;0;AAXX 03031 98444 32970 81204 10275 20220 30085=\n")
    write(tmp_dir, "stations.csv", "wmo_id,lat,lon\n98444,1,2\n")
    out = os.path.join(tmp_dir, "decoded.parquet")
    counts = stratus.run_decode(spark, os.path.join(landed, "*.csv"), out, sep="auto",
                                stations_path=os.path.join(tmp_dir, "stations.csv")).collect()[0]
    assert counts.rows_decoded == 2 and counts.errors == 0
    obs = decoded_to_observations(spark.read.parquet(out)).withColumn("location", F.lit("A"))
    clean = stratus.clean_observations(obs)
    assert [r.lat for r in clean.collect()] == [1.0, 1.0]
    assert sorted(r.temp for r in clean.collect()) == [25.5, 27.5]



def test_wide_reply_header(spark, tmp_dir):
    """The seven names far to the right, and quoted commas, keep every field."""
    names = [f"X{i}" for i in range(60)] + ["WMOIND", "YEAR", "MONTH", "DAY", "HOUR", "MIN", "REPORT"]
    values = ["" if i % 2 else f'"a,{i}"' for i in range(60)] + ["98444", "2024", "1", "2", "3", "0", '"AAXX, ""x"" ="']
    with open(os.path.join(tmp_dir, "r.txt"), "w") as f:
        f.write(",".join(names) + "\n" + ",".join(values) + "\n,,\n")
    rows = [tuple(r) for r in read_replies(spark, tmp_dir).collect()]
    assert ("98444", "2024", "1", "2", "3", "0", 'AAXX, "x" =') in rows and len(rows) == 2


def test_undecoded_file_names_blank_lines_and_cases(spark, tmp_dir):
    from stratus.sources.undecoded import read_undecoded_csv

    files = {"a b.csv": "\nWMOIND;YEAR;REPORT\n1;2024;x y\n", "a[1].csv": "\nREPORT;WMOIND;YEAR\nz;2;2023\n",
             "50%+é.csv": "WMOIND;report;REPORT\n3;low;UP\n"}
    for name, text in files.items():
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as f:
            f.write(text)
    want = {("1", "2024", "x y"), ("2", "2023", "z"), ("3", "", "UP")}
    for sep in (";", "auto"):
        got = read_undecoded_csv(spark, os.path.join(tmp_dir, "*.csv"), sep=sep)
        assert {(r.WMOIND, r.YEAR, r.REPORT) for r in got.collect()} == want


def test_undecoded_quoted_line_break(spark, tmp_dir):
    from stratus.sources.undecoded import read_undecoded_csv

    with open(os.path.join(tmp_dir, "q.csv"), "w") as f:
        f.write('WMOIND,YEAR,MONTH,DAY,HOUR,MIN,REPORT\n1,2024,1,1,0,0,"R1\nR2="\n2,2024,1,1,0,0,R3=\n')
    got = read_undecoded_csv(spark, os.path.join(tmp_dir, "q.csv"), sep=",").collect()
    assert {(r.WMOIND, r.REPORT) for r in got} == {("1", "R1\nR2="), ("2", "R3=")}


def test_quoted_line_breaks_over_splits(spark, tmp_dir):
    """Files of several separators in splits of a few bytes against the csv
    module: quoted breaks, doubled quotes, quotes inside plain values, blank
    lines, and a quote that is never closed."""
    import collections
    import csv
    import random

    from stratus.schemas import RAW_COLUMNS
    from stratus.sources.undecoded import read_undecoded_csv

    rng, want = random.Random(4), collections.Counter()
    for k, sep in enumerate([",", ";", "\t", "|", ",", ","]):
        rows = [[str(1000 * k + i), "2024", "1", "2", "3", "4", rng.choice([
            "plain", 'in"side', '5" and 6"', "", 'say ""x""', f"a{sep}b", "one\ntwo", 'x\n"q"\ny', "m\n\n\nn", f'"{sep}\n', "\n\n"])]
                for i in range(60)]
        path = os.path.join(tmp_dir, f"f{k}.csv")
        with open(path, "w", newline="") as f:
            f.write(sep.join(RAW_COLUMNS) + "\n\n")
            for r in rows:
                cell = r[6]
                quoted = any(c in cell for c in (sep, "\n")) or cell.startswith('"')
                f.write(sep.join(r[:6] + ['"' + cell.replace('"', '""') + '"' if quoted else cell]) + "\n")
            if k == 5:
                f.write('9,2024,1,2,3,4,"open\n10,2024,1,2,3,4,next\n')
        if k < 5:
            with open(path, newline="") as f:
                read = [r for r in csv.reader(f, delimiter=sep) if r][1:]
        else:
            read = rows + [["9", "2024", "1", "2", "3", "4", "open"], ["10", "2024", "1", "2", "3", "4", "next"]]
        want.update(tuple(x.strip(" \t\n\v\f\r") for x in r) for r in read)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150b")
    try:
        assert spark.read.text(os.path.join(tmp_dir, "f0.csv")).rdd.getNumPartitions() > 8
        got = read_undecoded_csv(spark, os.path.join(tmp_dir, "*.csv"))
        assert collections.Counter(map(tuple, got.collect())) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_station_numbers(spark):
    from stratus.sources.stations import station_table

    texts = ["13.5", " 1_0 ", "nan", "-inf", "13.5D", "2f", "1__0", "", "0x1", ".5e1", "abc", None]
    df = spark.createDataFrame([(f"s{i}", t, "1") for i, t in enumerate(texts)], "wmo_id string, lat string, lon string")
    got = {r.wmo_id: str(r.lat) for r in station_table(df).collect()}
    assert got == {"s0": "13.5", "s1": "10.0", "s2": "nan", "s3": "-inf", "s9": "5.0"}


def test_location_of_a_name_with_spaces(spark, tmp_dir):
    from stratus.schemas import OBSERVATION_SCHEMA
    from stratus.sources.observations import read_observations, rows_per_file

    for name in ("Decoded Cam Norte.csv", "DecodedA+B 50%.csv"):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(",".join(OBSERVATION_SCHEMA.fieldNames()) + "\n" + "," * (len(OBSERVATION_SCHEMA) - 1) + "\n")
    got = {(r.file_name, r.location.strip()) for r in rows_per_file(read_observations(spark, tmp_dir)).collect()}
    assert got == {("Decoded Cam Norte.csv", "Cam Norte"), ("DecodedA+B 50%.csv", "A+B 50%")}


def test_raw_files_to_results(spark, tmp_dir):
    from stratus.plans.analysis_job import analyse_decoded
    from stratus.plans.decode_job import run_decode

    with open(os.path.join(tmp_dir, "raw.csv"), "w") as f:
        f.write("WMOIND,YEAR,MONTH,DAY,HOUR,MIN,REPORT\n"
                + "".join(f"9844{k},2024,1,{d},6,0,AAXX 01061 9844{k} 32470 81204 10255 20220 60012=\n" for k in (4, 6) for d in (1, 2)))
    decoded = os.path.join(tmp_dir, "decoded.parquet")
    run_decode(spark, os.path.join(tmp_dir, "raw.csv"), decoded, sep=",")
    out = analyse_decoded(spark, decoded, "station_id", out_dir=os.path.join(tmp_dir, "out"))
    assert [(r.location, r.total_rain_mm) for r in sorted(out["total_rain"].collect())] == [("98444", 2.0), ("98446", 2.0)]
    assert out["rows_after_cleaning"].first().rows == 4 and len(os.listdir(os.path.join(tmp_dir, "out"))) == len(out)


def test_release(spark, tmp_dir):
    """A scope removes the scratch tables and the persisted frames inside it, but what is handed over."""
    from stratus.plans.analysis_job import materialize
    from stratus.session import checkpoint_dir, job, stored

    scratch = os.path.join(checkpoint_dir(spark).replace("file:", ""), "stratus")
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    with job(spark):
        with job(spark) as inner:
            gone = stored(spark.range(3), "gone")
            kept = stored(gone, "kept")
            held = materialize(spark.range(5), "cache")
            assert held.count() == 5 and held.is_cached
            inner.hand_over()
        assert kept.count() == 3 and not held.is_cached
        assert {n.split("-")[0] for n in set(os.listdir(scratch)) - before} == {"kept"}
    assert set(os.listdir(scratch)) == before


def test_run_analysis_releases(spark, tmp_dir):
    from stratus.session import checkpoint_dir

    d = os.path.join(tmp_dir, "obs")
    for place in "AB":
        write(d, f"Decoded{place}.csv", OBS_HEADER + "".join(
            f"98444,2024-0{m}-0{k} 06:00:00,1,2,{20 + k}.5,1010,{60 + m},{k}.0,90,4,10000,0.5\n" for m in (1, 2) for k in range(1, 8)))
    plain = run_analysis(spark, d)
    scratch = os.path.join(checkpoint_dir(spark).replace("file:", ""), "stratus")
    before = set(os.listdir(scratch))
    released = run_analysis(spark, d, out_dir=os.path.join(tmp_dir, "out"), release=True)
    assert set(os.listdir(scratch)) == before
    for name in plain:
        assert sorted(map(str, plain[name].collect())) == sorted(map(str, released[name].collect())), name
