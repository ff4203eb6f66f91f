"""Synthetic views over the driver tables (see FIXTURES.md).

One SQL text serves Spark and the DuckDB oracle.  ``synop`` builds raw report
text from ``events``; ``synop_expected`` computes the decoded values from the
same arithmetic without parsing; ``obs`` and ``obs_month`` are observation
tables for the analysis.  Their size grows with the driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SYNOP_SQL = """
WITH k AS (SELECT event_id AS e, user_id AS u, ts, (event_id*37)%500 AS ttt,
  CASE WHEN event_id%31=0 THEN (event_id*37)%500+20 ELSE greatest((event_id*37)%500-event_id%120, 0) END AS tdt,
  event_id%5 AS ir FROM events)
SELECT e AS report_id,
 CASE e%8 WHEN 0 THEN '98444' WHEN 1 THEN '98446' WHEN 2 THEN '98543' WHEN 3 THEN '98536'
          WHEN 4 THEN '98427' WHEN 5 THEN '98434' WHEN 6 THEN '98440' ELSE '98999' END AS WMOIND,
 cast(year(ts) AS string) AS YEAR, cast(month(ts) AS string) AS MONTH, cast(day(ts) AS string) AS DAY,
 CASE WHEN e%37=0 THEN '?8' ELSE cast(hour(ts) AS string) END AS HOUR,
 CASE WHEN e%43=0 THEN '' ELSE cast(minute(ts) AS string) END AS MIN,
 'AAXX ' || lpad(cast(day(ts) AS string),2,'0') || lpad(cast(hour(ts) AS string),2,'0')
  || CASE e%4 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '3' ELSE '4' END || ' 98444 '
  || CASE WHEN e%41=0 THEN 'NIL=' ELSE
     cast(ir AS string) || '1' || cast(e%10 AS string) || lpad(cast((e*7)%100 AS string),2,'0') || ' '
  || CASE WHEN e%10=9 THEN '/' ELSE cast(e%10 AS string) END
  || CASE WHEN e%17=0 THEN '99' ELSE lpad(cast((e*3)%37 AS string),2,'0') END
  || CASE WHEN e%23=0 THEN '99 00' || lpad(cast(100+e%50 AS string),3,'0') ELSE lpad(cast((e*5)%40 AS string),2,'0') END
  || CASE WHEN e%19=0 THEN ' 1////' ELSE ' 1' || CASE WHEN e%29=0 THEN '1' ELSE '0' END || lpad(cast(ttt AS string),3,'0') END
  || ' 20' || lpad(cast(tdt AS string),3,'0')
  || ' 3' || lpad(cast((9900+e%200)%10000 AS string),4,'0')
  || CASE WHEN e%3=0 THEN '' ELSE ' 4' || lpad(cast((10050+e%150)%10000 AS string),4,'0') END
  || CASE WHEN ir IN (0,1) AND e%2=0 THEN ' 6' || lpad(cast((e*11)%1000 AS string),3,'0') || '1' ELSE '' END
  || ' 8' || cast((e*3)%9 AS string) || '500'
  || ' 333 10999'
  || CASE WHEN ir IN (0,2) THEN ' 6' || lpad(cast((e*13)%1000 AS string),3,'0') || '7' ELSE '' END || '=' END AS REPORT
FROM k
"""

SYNOP_EXPECTED_SQL = """
WITH k AS (SELECT event_id AS e, (event_id*37)%500 AS ttt,
  CASE WHEN event_id%31=0 THEN (event_id*37)%500+20 ELSE greatest((event_id*37)%500-event_id%120, 0) END AS tdt,
  event_id%5 AS ir, (event_id*7)%100 AS vv,
  CASE WHEN event_id%23=0 THEN 100+event_id%50 ELSE (event_id*5)%40 END AS ff,
  (10050+event_id%150)%10000 AS p4, (9900+event_id%200)%10000 AS p3,
  CASE WHEN event_id%5 IN (0,1) AND event_id%2=0 THEN (event_id*11)%1000 WHEN event_id%5 IN (0,2) THEN (event_id*13)%1000 END AS rr FROM events),
j AS (SELECT *, CASE WHEN e%19<>0 THEN CASE WHEN e%29=0 THEN -ttt/10e0 ELSE ttt/10e0 END END AS t, tdt/10e0 AS td,
  CASE WHEN e%3=0 THEN p3 ELSE p4 END AS p FROM k)
SELECT e AS report_id, CASE WHEN e%41<>0 THEN t END AS t,
 CASE WHEN e%41<>0 THEN CASE WHEN p/10e0<500 THEN p/10e0+1000 ELSE p/10e0 END END AS p,
 CASE WHEN e%41<>0 AND t IS NOT NULL THEN greatest(0e0,least(100e0,round(100e0*exp(17.625e0*td/(243.04e0+td)-17.625e0*t/(243.04e0+t)),1))) END AS h,
 CASE WHEN e%41<>0 THEN CASE WHEN e%4>=2 THEN round(ff*0.514444e0,1) ELSE cast(ff AS double) END END AS ws,
 CASE WHEN e%41<>0 AND e%17<>0 THEN (e*3)%37*10e0 END AS wd,
 CASE WHEN e%41<>0 THEN CASE WHEN e%10=9 THEN (e*3)%9 ELSE e%10 END*1e0 END AS cc,
 CASE WHEN e%41<>0 THEN CASE WHEN vv<=50 THEN vv*100e0 WHEN vv<=80 THEN (vv-50)*1000e0+5000 WHEN vv<=89 THEN (vv-80)*5000e0+35000
   WHEN vv=91 THEN 50e0 WHEN vv=92 THEN 200e0 WHEN vv=93 THEN 500e0 WHEN vv=94 THEN 1000e0 WHEN vv=95 THEN 2000e0
   WHEN vv=96 THEN 4000e0 WHEN vv=97 THEN 10000e0 WHEN vv=98 THEN 40000e0 END END AS vis,
 CASE WHEN e%41<>0 THEN CASE WHEN rr=990 THEN 0.1e0 WHEN rr>=991 THEN (rr-990)/10e0 WHEN rr IS NOT NULL THEN rr*1e0 WHEN ir=3 THEN 0e0 END END AS rn
FROM j
"""

OBS_SQL = """
SELECT event_id AS obs_id, event_type AS location, ts,
 CASE WHEN event_id%11=0 OR event_id%50=0 THEN NULL ELSE ((event_id*37+user_id*13)%500)/10e0 END AS temp,
 CASE WHEN event_id%13=0 OR event_id%50=0 THEN NULL ELSE 1000e0+((event_id*7)%300)/10e0 END AS pressure,
 CASE WHEN event_id%9=0 OR event_id%50=0 THEN NULL ELSE 40e0+((event_id*11+user_id)%600)/10e0 END AS humidity,
 CASE WHEN event_id%7=0 OR event_id%50=0 THEN NULL ELSE ((event_id*3+user_id*7)%300)/10e0 END AS wind_speed,
 ((event_id*5)%37)*10e0 AS wind_dir, (event_id%9)*1e0 AS cloud_cover, ((event_id*19)%100)*100e0 AS visibility,
 CASE WHEN event_id%3=0 THEN NULL ELSE ((event_id*17)%200)/10e0 END AS rain_3h
FROM events
"""

OBS_MONTH_SQL = """
SELECT o_orderkey AS obs_id, o_orderpriority AS location, o_orderdate AS ts,
 CASE WHEN o_orderkey%11=0 THEN NULL ELSE ((o_orderkey*37+o_custkey*13)%500)/10e0 END AS temp FROM orders
"""


VIEWS = {
    "synop": (SYNOP_SQL, ("events",)),
    "synop_expected": (SYNOP_EXPECTED_SQL, ("events",)),
    "obs": (OBS_SQL, ("events",)),
    "obs_month": (OBS_MONTH_SQL, ("orders",)),
}


# Views whose rows are expensive to build (report text) read their base table
# spread over the cores when it arrives in fewer partitions (one row group).
SPREAD_VIEWS = {"synop"}


def register_tables(spark: SparkSession, sf_dir: str, tables, spread_input: bool = False) -> None:
    """Register the driver parquet tables as temp views."""
    from stratus.session import spread

    for t in tables:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet")
        spread(df, spark.sparkContext.defaultParallelism if spread_input else None).createOrReplaceTempView(t)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named synthetic view as a DataFrame over ``sf_dir``."""
    sql, tables = VIEWS[name]
    register_tables(spark, sf_dir, tables, spread_input=name in SPREAD_VIEWS)
    return spark.sql(sql)


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named views as CTEs (for the DuckDB oracle)."""
    if not names:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][0].strip()}\n)" for n in names)
    return f"WITH {ctes}\n{sql.strip()}"

# Station coordinate table built from ``supplier``: repeated ids (last line
# wins), ids that override built-in stations, one unknown to the built-in
# table, and unparsable latitudes that must be dropped.
STATIONS_EXT_SQL = """
SELECT s_suppkey AS line_no,
 CASE s_suppkey%9 WHEN 0 THEN '98444' WHEN 1 THEN '98999' WHEN 2 THEN '98446'
   ELSE '97' || lpad(cast(s_suppkey AS string),3,'0') END AS wmo_id,
 CASE WHEN s_suppkey%7=0 THEN 'n/a'
   ELSE cast(s_nationkey AS string) || '.' || lpad(cast(s_suppkey%100 AS string),2,'0') END AS lat,
 '12' || cast(s_suppkey%10 AS string) || '.5' AS lon
FROM supplier
"""

VIEWS["stations_ext"] = (STATIONS_EXT_SQL, ("supplier",))

# Reply lines built from ``synop``: one reply per requested station and day.
# Even days carry a header line, days = 3 (mod 7) open with a server message,
# the others open with a blank line; the unknown station's reports sit in
# another station's replies; some whitespace-only lines are mixed in.
REPLY_LINES_SQL = """
WITH s AS (SELECT report_id, WMOIND, YEAR, MONTH, DAY, HOUR, MIN, REPORT,
             CASE WHEN WMOIND = '98999' THEN '98444' ELSE WMOIND END AS req,
             cast(DAY AS int) AS d FROM synop),
r AS (SELECT DISTINCT req, d FROM s)
SELECT req || '/' || cast(d AS string) AS reply, CAST(0 AS BIGINT) AS line_no,
  CASE WHEN d%7=3 THEN 'Status: NO DATA for this period'
       WHEN d%2=0 THEN 'WMOIND,YEAR,MONTH,DAY,HOUR,MIN,REPORT' ELSE '' END AS line FROM r
UNION ALL
SELECT req || '/' || cast(d AS string), report_id*2+1,
  WMOIND || ',' || YEAR || ',' || MONTH || ',' || DAY || ',' || HOUR || ',' || MIN || ',' || REPORT FROM s
UNION ALL
SELECT req || '/' || cast(d AS string), report_id*2+2, '   ' FROM s WHERE report_id%5=0
"""


def reply_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reply line_no line`` over ``synop`` (itself over ``events``): the
    lines of ``REPLY_LINES_SQL``, with each report's lines made by one
    ``explode`` so the report text is built twice (lines, reply heads)
    rather than three times."""
    syn = view(spark, sf_dir, "synop")
    s = syn.select(
        "report_id", "WMOIND", "YEAR", "MONTH", "DAY", "HOUR", "MIN", "REPORT",
        F.when(F.col("WMOIND") == "98999", F.lit("98444")).otherwise(F.col("WMOIND")).alias("req"),
        F.col("DAY").cast("int").alias("d"))
    reply = F.concat(F.col("req"), F.lit("/"), F.col("d").cast("string"))
    csv_line = F.concat_ws(",", *[F.col(c) for c in ("WMOIND", "YEAR", "MONTH", "DAY", "HOUR",
                                                      "MIN", "REPORT")])
    entries = F.array(
        F.struct((F.col("report_id") * 2 + 1).alias("line_no"), csv_line.alias("line")),
        F.when(F.col("report_id") % 5 == 0,
               F.struct((F.col("report_id") * 2 + 2).alias("line_no"), F.lit("   ").alias("line"))))
    body = (s.select(reply.alias("reply"), F.explode(entries).alias("e"))
            .where(F.col("e").isNotNull())
            .select("reply", F.col("e.line_no").alias("line_no"), F.col("e.line").alias("line")))
    heads = (s.select("req", "d").distinct()
             .select(F.concat(F.col("req"), F.lit("/"), F.col("d").cast("string")).alias("reply"),
                     F.lit(0).cast("bigint").alias("line_no"),
                     F.when(F.col("d") % 7 == 3, F.lit("Status: NO DATA for this period"))
                     .when(F.col("d") % 2 == 0, F.lit("WMOIND,YEAR,MONTH,DAY,HOUR,MIN,REPORT"))
                     .otherwise(F.lit("")).alias("line")))
    return heads.unionByName(body)


# Raw reports with malformed date/time fields built from ``events``: years 0
# and 10000 (error rows), text around the year, an empty year, month 13 and
# 0, day 31 in every month, hours like "?8" and 99, empty and 75 minutes,
# padded station ids.
LENIENT_SQL = """
SELECT event_id AS report_id,
 CASE WHEN event_id%6=0 THEN ' 98444 ' ELSE '98446' END AS WMOIND,
 CASE WHEN event_id%97=0 THEN '0' WHEN event_id%89=0 THEN '10000'
      WHEN event_id%7=0 THEN 'Y' || cast(year(ts) AS string) WHEN event_id%11=0 THEN ''
      ELSE cast(year(ts) AS string) END AS YEAR,
 CASE WHEN event_id%5=0 THEN '13' WHEN event_id%13=0 THEN '0' ELSE cast(month(ts) AS string) END AS MONTH,
 CASE WHEN event_id%3=0 THEN '31' ELSE cast(day(ts) AS string) END AS DAY,
 CASE WHEN event_id%4=0 THEN '?' || cast(hour(ts) AS string) WHEN event_id%17=0 THEN '99'
      ELSE cast(hour(ts) AS string) END AS HOUR,
 CASE WHEN event_id%9=0 THEN '' WHEN event_id%19=0 THEN '75' ELSE cast(minute(ts) AS string) END AS MIN,
 'AAXX 01001 98444 32970 81204 10255=' AS REPORT
FROM events
"""

VIEWS["lenient"] = (LENIENT_SQL, ("events",))

# Reports with the seldom branches, built from ``events``: every message type
# and none, a four-character index group, a wind group that is none, 99 without
# its extension, slashes, repeated groups, 222 before 333, and 444 or 555 where
# section 3 would hold rain.
SYNOP_HARD_SQL = """
SELECT event_id AS report_id,
 CASE event_id%4 WHEN 0 THEN 'AAXX ' WHEN 1 THEN 'BBXX ' WHEN 2 THEN 'OOXX ' ELSE '' END
  || '0106' || CASE event_id%5 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '3' WHEN 3 THEN '4' ELSE '/' END || ' 98444 '
  || CASE WHEN event_id%7=0 THEN '1234' ELSE
     CASE event_id%6 WHEN 5 THEN '/' ELSE cast(event_id%6 AS string) END || '15'
     || CASE WHEN event_id%9=0 THEN '//' ELSE lpad(cast(event_id%51 AS string),2,'0') END END || ' '
  || CASE WHEN event_id%11=0 THEN '9' WHEN event_id%7=0 THEN '5' WHEN event_id%10=9 THEN '/' ELSE cast(event_id%9 AS string) END
  || CASE event_id%13 WHEN 0 THEN '//' WHEN 1 THEN '99' ELSE lpad(cast(event_id%37 AS string),2,'0') END
  || CASE event_id%17 WHEN 0 THEN '//' WHEN 1 THEN '99' WHEN 2 THEN '99 00' || cast(100+event_id%50 AS string)
     ELSE lpad(cast(event_id%60 AS string),2,'0') END
  || ' 11050 10' || lpad(cast(event_id%300 AS string),3,'0') || ' 1//// 123'
  || ' 20010 20' || lpad(cast(event_id%250 AS string),3,'0')
  || ' 39900 30010' || CASE WHEN event_id%2=0 THEN ' 41000 4' || lpad(cast(event_id%300 AS string),4,'0') ELSE '' END
  || ' 5/abc' || CASE WHEN event_id%3=0 THEN ' 60011 6' || lpad(cast(event_id%989 AS string),3,'0') || '2' ELSE '' END
  || ' 8/500 84500 86500'
  || CASE event_id%19%4 WHEN 0 THEN ' 222 00 61234 333 60505'
     WHEN 1 THEN ' 333 10999 6' || lpad(cast(event_id%500 AS string),3,'0') || '1 60991 444 60999'
     WHEN 2 THEN ' 333 555 60771' ELSE ' 444 60771 333 60505' END
  || CASE WHEN event_id%23=0 THEN '== ' ELSE '=' END AS REPORT
FROM events
"""

VIEWS["synop_hard"] = (SYNOP_HARD_SQL, ("events",))
SPREAD_VIEWS.add("synop_hard")


def land_one_file_per_location(df: DataFrame, location: str, name) -> str:
    """``df`` as one CSV per value of ``location`` in a folder under the shared
    checkpoint folder, each named ``name(value)``; returns the folder.  Spark
    writes them, then the files (one per location) are renamed."""
    from stratus.session import scratch_path
    from stratus.sources.files import _fs_and_path

    spark = df.sparkSession
    parts, folder = scratch_path(spark, "by-location"), scratch_path(spark, "observation-files")
    (df.withColumn("__loc", F.col(location)).repartition("__loc").write.partitionBy("__loc")
     .option("header", True).csv(parts))
    fs, root = _fs_and_path(spark, parts)
    target = _fs_and_path(spark, folder)[1]
    fs.mkdirs(target)
    for entry in fs.listStatus(root):
        label = entry.getPath().getName()
        if label.startswith("__loc="):
            for part in fs.listStatus(entry.getPath()):
                if part.getPath().getName().startswith("part-"):
                    fs.rename(part.getPath(), _fs_and_path(spark, f"{folder}/{name(label[len('__loc='):])}")[1])
    return folder
