"""Decode job: raw reports -> decoded observations (one narrow stage).

raw table -> record preparation (ids, lenient date/time) -> coordinates ->
SYNOP decode -> the 13 decoded columns (+ ``decode_error``).  No shuffle
except the broadcast of a size-checked station table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stratus.operators.decode import decode_reports, reading_columns, without_report
from stratus.operators.prepare import attach_coordinates, prepare_records
from stratus.schemas import DECODED_COLUMNS
from stratus.session import spread


def decode_raw(raw: DataFrame, stations: DataFrame | None = None,
               extras: bool = False, keep: list[str] | None = None,
               partitions: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """Decoded observations, one output row per input row.  ``partitions``
    deals the input out first (for inputs of fewer partitions than cores);
    ``columns`` names the readings to compute (all by default).

    ``keep`` names input columns to carry along (e.g. a report id).  Rows
    with an impossible year keep their station id; their date and time are
    ``''`` and every number is NULL, flagged by ``decode_error``.
    """
    prepared = prepare_records(spread(raw, partitions))
    located = attach_coordinates(prepared, stations)
    decoded = decode_reports(located, "REPORT", extras=extras, columns=columns)
    readings = [c for c in reading_columns(extras) if columns is None or c in columns]
    err = F.col("decode_error")
    nulled = {c: F.when(err, F.lit(None).cast("double")).otherwise(F.col(c))
              for c in ["lat", "lon"] + [c for c in readings if c != "dewpoint_gt_temp"]}
    if "dewpoint_gt_temp" in readings:
        nulled["dewpoint_gt_temp"] = F.col("dewpoint_gt_temp") & ~err
    place = [c for c in DECODED_COLUMNS if c not in reading_columns()]
    return decoded.withColumns(nulled).select(
        *(keep or []), *place, *[c for c in readings if c in DECODED_COLUMNS], "decode_error",
        *[c for c in readings if c not in DECODED_COLUMNS])


def _counts(decoded: DataFrame) -> list:
    aggs = [F.count(F.lit(1)).alias("rows_decoded"),
            F.count_if(F.col("decode_error")).alias("errors")]
    if "dewpoint_gt_temp" in decoded.columns:
        aggs.append(F.count_if(F.col("dewpoint_gt_temp")).alias("dewpoint_warnings"))
    if "REPORT" in decoded.columns:
        aggs.append(F.count_if(without_report(F.col("REPORT"))).alias("nil_or_empty"))
    return aggs


def run_counts(decoded: DataFrame) -> DataFrame:
    """Rows decoded and error rows in one aggregation; unphysical dew points
    too if their flag was kept, and NIL or empty reports if ``REPORT`` was."""
    return decoded.agg(*_counts(decoded))


def run_decode(spark, input_path, output_path: str, sep: str = "auto",
               stations_path: str | None = None, csv_output: bool = False,
               extras: bool = False, partition_by: list[str] | None = None) -> DataFrame:
    """Undecoded CSV file(s) -> decoded observations written to ``output_path``
    (Parquet, optionally partitioned by ``partition_by`` columns such as
    ``date`` for partition pruning downstream; or the 13-column CSV text form).
    Returns the run counts, observed while the one pass writes."""
    from stratus.sinks import write_decoded_csv, write_parquet
    from stratus.sources.stations import read_station_csv
    from stratus.sources.undecoded import read_undecoded_csv

    raw = read_undecoded_csv(spark, input_path, sep=sep)
    stations = read_station_csv(spark, stations_path) if stations_path else None
    decoded = decode_raw(raw, stations, extras=extras, keep=["REPORT"])
    seen = Observation("decode run")
    out = decoded.observe(seen, *_counts(decoded)).drop("REPORT")
    if csv_output:
        write_decoded_csv(out, output_path)
    else:
        write_parquet(out, output_path, partition_by=partition_by)
    counts = seen.get
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} long" for k in counts))
