"""Folder of decoded observation CSVs, one file per location.

All ``*.csv`` directly in the folder are read by ONE scan with the explicit
12-column schema; the location comes from the file name: the text after
``Decoded`` (any case) in the name without extension, else that name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.schemas import OBSERVATION_SCHEMA
from stratus.sources.files import path_exists


def location_from_file(name_col) -> F.Column:
    """``DecodedCamNorte.csv -> CamNorte``; ``Other.csv -> Other``."""
    c = F.col(name_col) if isinstance(name_col, str) else name_col
    stem = F.regexp_replace(c, r"(?<=.)\.[^./]*$", "")
    tail = F.regexp_extract(stem, r"(?i)Decoded(.+)", 1)
    return F.when(tail != "", tail).otherwise(stem)


def read_observations(spark: SparkSession, folder: str, check_header: bool = True) -> DataFrame:
    """Observations with ``location`` and ``file_name``.

    ``check_header=True`` makes the reader compare each file's header with the
    schema and fail on a mismatch (decoder output fed in without the adapter
    would otherwise be read shifted by one column).  Raises
    ``FileNotFoundError`` when the folder holds no CSV.
    """
    pattern = folder.rstrip("/") + "/*.csv"
    if not path_exists(spark, pattern):
        raise FileNotFoundError(f"No CSV files found in '{folder}'")
    df = (spark.read.option("header", True).option("nullValue", "")
          .option("enforceSchema", not check_header)
          .schema(OBSERVATION_SCHEMA).csv(pattern))
    # File names in the metadata are percent-encoded; a plus sign is not.
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return df.select("*", name.alias("file_name")) \
        .withColumn("location", location_from_file("file_name"))


def rows_per_file(obs: DataFrame) -> DataFrame:
    """Rows loaded per file (one job for all files)."""
    return obs.groupBy("file_name", "location").agg(F.count(F.lit(1)).alias("rows"))
