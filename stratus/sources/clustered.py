"""Range-clustered observation store.

A store is a folder of landings, each written by one ``append_clustered``:

* ``data/landing=<id>/``: Parquet files whose rows are range-partitioned and
  sorted by the keys (location and time), so a file holds one stretch of the
  order; a location with a third of all rows is cut by time;
* ``files/landing=<id>/``: one row per data file with its row count and the
  least and greatest value of every key (``rows``, ``lo_<key>``, ``hi_<key>``).

A landing counts from the moment its ``files`` folder is committed, so a job
that dies between the two writes leaves nothing readable behind.

``read_clustered`` opens only the files whose stretch can meet the bounds;
inside them Parquet's row-group statistics prune further.  ``file_rows`` and
``footer_counts`` count without reading any column of the data.

Defined cases: null keys sort first and meet no bound, a bound of ``None`` is
open, an empty landing has no files, a store without landings reads as an empty
frame of the given schema, equal rows are all kept.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from stratus.session import scratch_path

KEYS = ("location", "ts")
#: Files beyond this number are not named one by one: the committed landings
#: are read as folders, with the bounds pushed into the scan.
MAX_FILES = 10_000


def append_clustered(df: DataFrame, path: str, keys=KEYS, files: int | None = None,
                     rows_per_file: int = 5_000_000) -> str:
    """One more landing of ``df`` in the store at ``path``; its id.

    ``files`` is the number of ranges; by default adaptive execution chooses it
    from the size of the shuffle.  No file holds more than ``rows_per_file``.
    """
    spark, landing = df.sparkSession, uuid.uuid4().hex
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    data = f"{path}/data/landing={landing}"
    ranged.sortWithinPartitions(*keys).write.option("maxRecordsPerFile", rows_per_file).parquet(data)
    ends = [f(k).alias(f"{n}_{k}") for k in keys for n, f in (("lo", F.min), ("hi", F.max))]
    (spark.read.schema(df.schema).parquet(data).select(*keys, F.col("_metadata.file_name").alias("file"))
     .groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *ends)
     .write.parquet(f"{path}/files/landing={landing}"))
    return landing


def clustered_files(spark: SparkSession, path: str) -> DataFrame | None:
    """``landing file rows lo_<key> hi_<key> ...`` of every committed file;
    None for a store without landings."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/files")
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return None
    return spark.read.parquet(f"{path}/files").withColumn("landing", F.col("landing").cast("string"))


def _within(low, high, kind, lo, hi):
    """Whether the stretch from ``low`` to ``high`` can meet the bounds, which
    are of the key's type: a plain datetime is a wall-clock time, whatever the
    zones of the session and of the driver."""
    def bound(value):
        return F.lit(str(value) if isinstance(value, _dt.datetime) else value).cast(kind)

    meets = F.lit(True)
    if lo is not None:
        meets = meets & (high >= bound(lo))
    if hi is not None:
        meets = meets & (low <= bound(hi))
    return meets


def read_clustered(spark: SparkSession, path: str, schema: StructType, bounds: dict | None = None,
                   max_files: int = MAX_FILES) -> DataFrame:
    """Rows of the store whose keys lie in ``bounds``: ``{key: (least, greatest)}``,
    both inclusive, ``None`` for open."""
    files = clustered_files(spark, path)
    if files is None:
        return spark.createDataFrame([], schema)
    asked = {k: b for k, b in (bounds or {}).items() if b != (None, None)}
    for k, b in asked.items():
        files = files.where(_within(F.col(f"lo_{k}"), F.col(f"hi_{k}"), schema[k].dataType, *b))
    named = files.select("landing", "file").limit(max_files + 1).collect()
    if not named:
        return spark.createDataFrame([], schema)
    if len(named) <= max_files:
        rows = spark.read.schema(schema).parquet(*[f"{path}/data/landing={r.landing}/{r.file}" for r in named])
    else:
        committed = [r.landing for r in clustered_files(spark, path).select("landing").distinct().collect()]
        rows = spark.read.schema(schema).parquet(*[f"{path}/data/landing={one}" for one in committed])
    for k, b in asked.items():
        rows = rows.where(F.col(k).isNotNull() & _within(F.col(k), F.col(k), schema[k].dataType, *b))
    return rows


def file_rows(spark: SparkSession, path: str) -> DataFrame:
    """``landing files rows``: what every landing holds, from the file table."""
    files = clustered_files(spark, path)
    if files is None:
        return spark.createDataFrame([], "landing string, files long, rows long")
    return files.groupBy("landing").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))


def _footer_frame(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    # settings of this one plan: they stay in a session of their own
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return own.read.parquet(path).groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def footer_counts(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    """Rows of a Parquet folder, in all or by partition columns, from the
    footers of its files: the scan is pushed the aggregation and reads no
    column.  Partition values are texts; the counts are written to a scratch
    table (one row per group) and read back."""
    by = list(by or [])
    out = scratch_path(spark, "footer-counts")
    counts = _footer_frame(spark, path, by)
    counts.write.parquet(out)
    schema = StructType()
    for c in by:
        schema = schema.add(c, StringType())
    return spark.read.schema(schema.add("rows", "long")).parquet(out)
