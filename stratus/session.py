"""Spark session helpers."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Session settings every job relies on.  Adaptive execution re-plans joins and
# coalesces small shuffle partitions at run time; skew handling splits hot keys.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "Asia/Manila",
    "spark.ui.enabled": "false",
    # HotSpot does not JIT-compile methods above 8,000 bytes of bytecode; a
    # fused stage bigger than that would run interpreted, so split it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The correlation matrix is one aggregation with ~90 statistics (~280
    # buffer fields); whole-stage codegen is skipped above this many fields.
    "spark.sql.codegen.maxFields": "400",
}


def build_session(master: str | None = None, app_name: str = "stratus",
                  shuffle_partitions: int | None = None,
                  time_zone: str = "Asia/Manila",
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs expect.

    ``master`` is only applied when given; on a cluster leave it ``None`` so the
    launcher decides.  The session time zone defaults to the one the original
    analysis used; all driver data is ``timestamp_ntz`` so it does not move
    values.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.session.timeZone"] = time_zone
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` as the cluster names it.  Where the setting
    is absent, a local master gets a scratch folder, which is recorded; any
    other master raises, since its executors could not see such a folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext
        sc = None
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="stratus-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


class Job:
    """What a job has put aside: scratch tables and persisted frames."""

    def __init__(self, spark: SparkSession, outer: Job | None):
        self.spark, self.outer = spark, outer
        self.paths: list[str] = []
        self.frames: list[DataFrame] = []

    def hand_over(self) -> None:
        """The table written last outlives this job: it passes to the job
        around it, or to nobody."""
        if self.paths:
            path = self.paths.pop()
            if self.outer:
                self.outer.paths.append(path)

    def release(self) -> None:
        for df in self.frames:
            df.unpersist()
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        self.frames, self.paths = [], []


_JOB: contextvars.ContextVar[Job | None] = contextvars.ContextVar("stratus_job", default=None)


@contextlib.contextmanager
def job(spark: SparkSession) -> Iterator[Job]:
    """A scope at whose end the scratch tables written and the frames persisted
    inside are removed.  Frames that read them end with it: write or collect
    results inside.  Outside any scope nothing is removed."""
    here = Job(spark, _JOB.get())
    token = _JOB.set(here)
    try:
        yield here
    finally:
        _JOB.reset(token)
        here.release()


def track(df: DataFrame) -> DataFrame:
    """A persisted frame, released with the job around it."""
    if _JOB.get():
        _JOB.get().frames.append(df)
    return df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written
    intermediate table; removed with the job around it, if there is one."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/stratus/{name}-{uuid.uuid4().hex}"
    if _JOB.get():
        _JOB.get().paths.append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a scratch table and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df, partitions: int | None):
    """``df`` dealt over ``partitions``, for CPU-heavy row-wise work on an input
    that arrives in too few (one large row group); unchanged for ``None``."""
    return df.repartition(partitions) if partitions else df


def fence(df, columns: list[str]):
    """Pass ``columns`` out through a one-row generator (``inline``).

    Catalyst pushes a filter below a projection by substituting the
    projection's expressions into the condition; after a long chain of
    layered projections that copies every layer into the condition (and into
    the generated code).  A predicate on a generator's output cannot be pushed
    below the generator, so filters on fenced columns stay where they are,
    while filters on other columns still reach the scan.  The generator emits
    exactly one row per input row and runs inside whole-stage codegen.
    """
    from pyspark.sql import functions as F

    names = set(columns)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*rest, fence_columns({c: F.col(f"`{c}`") for c in columns}))


def fence_columns(columns: dict):
    """The generator expression of ``fence`` for ``{name: Column}``, to use in
    a ``select`` that computes the columns in the same step."""
    from pyspark.sql import functions as F

    return F.inline(F.array(F.struct(*[v.alias(k) for k, v in columns.items()])))
