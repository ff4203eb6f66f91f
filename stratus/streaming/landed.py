"""Decode undecoded report CSVs incrementally as they land in a folder.

The preparation and decode are row-wise (no state, no shuffle), so they run
unchanged on a streaming DataFrame.  The file source tracks which files were
processed in the checkpoint, and the Parquet sink commits each micro-batch
exactly once, so a restarted or failed run neither loses nor repeats rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stratus.plans.decode_job import decode_raw
from stratus.schemas import RAW_SCHEMA
from stratus.session import checkpoint_dir


def decode_stream(spark: SparkSession, input_dir: str, sep: str = ",",
                  stations: DataFrame | None = None, extras: bool = False,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming decoded observations from CSVs landing in ``input_dir``.

    Files must carry the standard header (``WMOIND,YEAR,...,REPORT``); the
    header is checked against it.  ``stations`` is a static table (one row per
    id), joined to every micro-batch.
    """
    reader = (spark.readStream.schema(RAW_SCHEMA).option("header", True)
              .option("enforceSchema", False).option("sep", sep).option("quote", '"')
              .option("escape", '"'))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(input_dir)
    return decode_raw(raw, stations, extras=extras)


def start_decode_stream(spark: SparkSession, input_dir: str, output_dir: str,
                        checkpoint: str | None = None, sep: str = ",",
                        stations: DataFrame | None = None, available_now: bool = True,
                        processing_time: str = "1 minute") -> StreamingQuery:
    """Start the stream into Parquet under ``output_dir``.

    ``checkpoint`` defaults to a folder under ``spark.checkpoint.dir`` that
    ``output_dir`` names, so a query started again goes on where it stopped;
    ``available_now`` processes what has landed and stops, otherwise the
    query keeps running with the given trigger interval.
    """
    named = hashlib.sha256(output_dir.rstrip("/").encode()).hexdigest()[:32]
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/stratus/decode-stream-{named}"
    writer = (decode_stream(spark, input_dir, sep=sep, stations=stations).writeStream
              .format("parquet").option("path", output_dir)
              .option("checkpointLocation", ckpt).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
