"""Plan shape: no Python in the plans, small decode plan, no shuffle in the
decode, one aggregation for the correlation, pushdown into Parquet scans."""

import os
import re

from stratus.operators import aggregates as agg
from stratus.operators import rollup
from stratus.operators.clean import clean_observations
from stratus.operators.decode import decode_reports
from stratus.plans import fixtures
from stratus.plans.catalog import QUERIES
from stratus.plans.decode_job import decode_raw

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    """Optimized plan text with expression ids removed (their digit count
    depends on how many expressions the session created before)."""
    return re.sub(r"#\d+L?", "#", df._jdf.queryExecution().optimizedPlan().toString())


def test_no_python_and_no_cross_join_in_any_registered_query(spark):
    for name, (fn, _sql) in QUERIES.items():
        plan = physical(fn(spark, SF))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                       "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert marker not in plan, (name, marker)


def test_decode_plan_is_small_and_narrow(spark):
    fixtures.register_tables(spark, SF, ["events"])      # one partition, not spread
    raw = spark.sql(fixtures.SYNOP_SQL)
    dec = decode_raw(raw, keep=["report_id"])
    assert len(optimized(dec)) < 20000
    assert "Exchange" not in physical(dec)
    # an input that is dealt out first: that is the only exchange
    spread = physical(decode_raw(raw, keep=["report_id"], partitions=4))
    assert spread.count("Exchange") == 1 and "RoundRobinPartitioning" in spread


def test_filters_after_decode_do_not_inline_layers(spark):
    raw = fixtures.view(spark, SF, "synop")
    dec = decode_reports(raw)
    filtered = dec.filter("temp IS NOT NULL OR pressure IS NOT NULL").filter("temp BETWEEN 10 AND 45")
    assert len(optimized(filtered)) < 25000


def test_correlation_is_one_aggregation(spark):
    obs = clean_observations(fixtures.view(spark, SF, "obs"))
    plan = physical(agg.correlation_matrix(obs))
    # one partial + one final aggregate, no joins, one shuffle to a single task
    assert plan.count("HashAggregate") + plan.count("ObjectHashAggregate") + \
        plan.count("SortAggregate") == 2
    assert "Join" not in plan


def test_pushdown_into_parquet(spark, tmp_dir):
    obs = clean_observations(fixtures.view(spark, SF, "obs"))
    path = os.path.join(tmp_dir, "clean")
    obs.write.parquet(path)
    back = spark.read.parquet(path)
    plan = physical(rollup.monthly_temperature(rollup.statistics(back, "month")))
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert read_schema == "struct<location:string,ts:timestamp_ntz,temp:double>"


def test_spread_is_explicit(spark):
    from stratus.session import spread

    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id")
    assert spread(ev, None) is ev
    assert "RoundRobinPartitioning(6)" in physical(spread(ev, 6))


def test_coordinates_need_no_job_to_build(spark):
    from stratus.operators.prepare import attach_coordinates

    sc = spark.sparkContext._jsc.sc()
    ext = spark.range(5).selectExpr("cast(id as string) wmo_id", "1.0 lat", "2.0 lon").repartition(3)
    before = sc.dagScheduler().nextJobId()
    attach_coordinates(ext.select(ext.wmo_id.alias("station_id")), ext)
    assert sc.dagScheduler().nextJobId() == before


def test_all_results_scan_the_observations_three_times(spark, tmp_dir):
    """The rollup and the bins, each written once, and the correlations."""
    from stratus.plans.analysis_job import results

    path = os.path.join(tmp_dir, "clean")
    clean_observations(fixtures.view(spark, SF, "obs")).write.parquet(path)
    out = results(spark.read.parquet(path))
    scans = [name for name, df in out.items() if path in physical(df)]
    assert scans == ["correlation"]


def test_only_the_readings_asked_for_are_computed(spark):
    raw = spark.range(10).selectExpr("'AAXX 01031 98444 32970 81204 10255 20220 30085=' AS REPORT")
    assert "EXP(" in physical(decode_reports(raw))
    temp = decode_reports(raw, columns=["temp"])
    assert temp.columns == ["REPORT", "temp"] and "EXP(" not in physical(temp)


def test_undecoded_files_are_read_by_one_scan_without_shuffling_lines(spark, tmp_dir):
    from stratus.sources.undecoded import read_undecoded_csv

    for k, (sep, names) in enumerate([(",", "WMOIND,REPORT"), (";", "REPORT;WMOIND"), ("|", "YEAR|WMOIND|REPORT")]):
        with open(os.path.join(tmp_dir, f"{k}.csv"), "w") as f:
            f.write(names + "\n" + sep.join(str(k) for _ in names.split(sep)) + "\n")
    for sep in ("auto", ","):
        plan = physical(read_undecoded_csv(spark, tmp_dir, sep=sep))
        assert plan.count("Scan csv") == 1 and plan.count("Scan text") == 0
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_ranks_without_a_single_task(spark):
    from stratus.operators import chartdata

    hum = spark.createDataFrame([(f"l{k:03d}", None if k % 7 == 0 else float(k % 11)) for k in range(200)], "location string, avg_humidity double")
    ranked, slots = chartdata.humidity_ranks(hum), chartdata.palette_slots(hum)
    assert "SinglePartition" not in physical(ranked) + physical(slots)
    want = sorted(hum.collect(), key=lambda r: (r.avg_humidity is None, -(r.avg_humidity or 0), r.location))
    assert [r.location for r in ranked.orderBy("rank").collect()] == [r.location for r in want]
    assert [r.palette_index for r in slots.orderBy("location").collect()] == [k % 8 for k in range(200)]
