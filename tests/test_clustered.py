"""Clustered store: results, files opened, half-written landings, counts."""

import datetime as dt
import os

from pyspark.sql import functions as F

from stratus.plans import fixtures
from stratus.sources import clustered

SF = "/root/testdata/sf0.001"
BETWEEN = "ts between timestamp_ntz'2024-01-10' and timestamp_ntz'2024-01-12'"
DAYS = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12))
SCHEMA = "location string, ts timestamp_ntz, v int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_range_reads_are_whole_and_open_few_files(spark, tmp_dir):
    obs = fixtures.view(spark, SF, "obs")
    clustered.append_clustered(obs, tmp_dir, files=24, rows_per_file=100)
    files = clustered.clustered_files(spark, tmp_dir)
    assert files.agg(F.sum("rows")).first()[0] == obs.count() and files.agg(F.max("rows")).first()[0] <= 100
    for bounds, want in (
            ({}, obs), ({"location": ("click", "click")}, obs.where("location = 'click'")),
            ({"ts": DAYS}, obs.where(BETWEEN)), ({"ts": (DAYS[1], None)}, obs.where("ts >= timestamp_ntz'2024-01-12'")),
            ({"location": ("click", "click"), "ts": DAYS}, obs.where("location = 'click' and " + BETWEEN)),
            ({"location": ("zzz", None)}, obs.where("false"))):
        for most in (clustered.MAX_FILES, 1):
            got = clustered.read_clustered(spark, tmp_dir, obs.schema, bounds, max_files=most)
            assert rows_of(got) == rows_of(want), (bounds, most)
    one = clustered.read_clustered(spark, tmp_dir, obs.schema, {"location": ("click", "click"), "ts": DAYS})
    assert len(one.inputFiles()) <= files.count() * 0.1


def test_hot_location_is_cut_by_time(spark, tmp_dir):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("hot" if k % 3 else f"l{k}", t + dt.timedelta(minutes=k), k) for k in range(3000)], SCHEMA)
    clustered.append_clustered(df, tmp_dir, files=12)
    hot = clustered.clustered_files(spark, tmp_dir).where("lo_location <= 'hot' and hi_location >= 'hot'")
    assert hot.count() >= 6 and hot.agg(F.max("rows")).first()[0] < 600


def test_landings_nulls_ties_and_unfinished(spark, tmp_dir):
    t = DAYS[0]
    rows = [("a", t, 1), ("a", t, 1), (None, t, 2), ("a", None, 3), ("b", t, None), ("", t, 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert clustered.read_clustered(spark, tmp_dir, df.schema).count() == 0
    assert clustered.file_rows(spark, tmp_dir).count() == 0
    clustered.append_clustered(df, tmp_dir, files=3)
    clustered.append_clustered(df.where("v = 1"), tmp_dir)
    clustered.append_clustered(df.where("false"), tmp_dir)
    df.write.parquet(os.path.join(tmp_dir, "data", "landing=dead"))       # a job that died before its file table
    read = lambda **b: rows_of(clustered.read_clustered(spark, tmp_dir, df.schema, b))
    assert read() == sorted(rows + rows[:2], key=str)
    assert read(location=("a", "a")) == sorted([rows[0]] * 4 + [rows[3]], key=str)
    assert read(location=("a", "a"), ts=(t, t)) == [rows[0]] * 4
    assert read(location=("", "")) == [rows[5]]
    assert sorted(r.rows for r in clustered.file_rows(spark, tmp_dir).collect()) == [2, 6]


def test_footer_counts_read_no_column(spark, tmp_dir):
    rows = [("007", 1), ("007", 2), ("b c", None), (None, 4)]
    spark.createDataFrame(rows, "place string, v int").write.partitionBy("place").parquet(tmp_dir + "/p")
    assert rows_of(clustered.footer_counts(spark, tmp_dir + "/p", ["place"])) == rows_of(
        spark.createDataFrame([("007", 2), ("b c", 1), (None, 1)], "place string, rows long"))
    assert clustered.footer_counts(spark, tmp_dir + "/p").first().rows == 4
    plan = clustered._footer_frame(spark, tmp_dir + "/p", ["place"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "v#" not in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
