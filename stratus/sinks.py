"""Writers and run counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.schemas import DECODED_COLUMNS, RAW_COLUMNS


def write_raw_csv(raw: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    """Raw report table as CSV with header, fixed column order."""
    (raw.select(*RAW_COLUMNS).write.mode(mode)
     .option("header", True).option("sep", sep).option("escape", '"').option("emptyValue", "").csv(path))


def write_decoded_csv(decoded: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Decoded observations as CSV text: 13 columns, missing numbers as ``NaN``."""
    (decoded.select(*DECODED_COLUMNS).write.mode(mode)
     .option("header", True).option("nullValue", "NaN").option("escape", '"').option("emptyValue", "")
     .csv(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """The main storage form: columnar, with predicate pushdown and pruning."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_result_csv(result: DataFrame, path: str, mode: str = "overwrite",
                     single_file: bool = False) -> None:
    """An aggregate result as CSV with header.

    The result keeps its sort: a sorted result is range partitioned, so the
    part files in name order hold the rows in order.  ``single_file`` merges
    into one part and is meant for results known to be small.
    """
    df = result.coalesce(1) if single_file else result
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def preview(df: DataFrame, n: int = 30, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows (a preview: the limit is the point).  With ``order_by``
    the rows are the first in that order (a top-k: each task keeps only its
    best ``n``, never a full sort)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def raw_counts(raw: DataFrame) -> DataFrame:
    """Records fetched, per station and in all."""
    return raw.groupBy("WMOIND").agg(F.count(F.lit(1)).alias("records"))
