"""Analysis job: observation folder -> cleaned observations -> every result.

The cleaned table is materialised once (Parquet in the shared checkpoint
folder by default, so a lost executor re-reads it instead of re-parsing the
CSVs) and each result is computed from it once; column pruning makes each
result read only the columns it needs.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.operators import aggregates as agg
from stratus.operators import chartdata as chart
from stratus.operators import rollup
from stratus.operators.clean import clean_observations, decoded_to_observations
from stratus.plans.decode_job import run_decode
from stratus.schemas import DECODED_SCHEMA
from stratus.session import checkpoint_dir, job, scratch_path, track
from stratus.sinks import write_result_csv
from stratus.sources.observations import read_observations


def materialize(df: DataFrame, mode: str = "parquet", name: str = "clean") -> DataFrame:
    """Cut the lineage of ``df``.

    ``parquet``: write to the shared folder named by ``spark.checkpoint.dir``
    and read back; ``checkpoint``: reliable ``Dataset.checkpoint``;
    ``cache``: ``persist`` (recomputed from lineage if lost); ``none``.
    """
    spark = df.sparkSession
    if mode == "parquet":
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)
    if mode == "checkpoint":
        checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    if mode == "cache":
        return track(df.persist())
    return df


def results(clean: DataFrame, materialize_mode: str = "parquet") -> dict[str, DataFrame]:
    """Every result of the analysis from the cleaned observations, in three
    scans of them: the statistics by day, month and location, and the wind bins, each written once, and
    the correlations.  All other results are derived from the first two."""
    stats = materialize(rollup.statistics(clean), materialize_mode, "statistics")
    bins = materialize(chart.wind_temperature_bins(clean), materialize_mode, "bins")
    monthly = rollup.monthly_temperature(stats, ordered=False)
    humidity = rollup.average_humidity(stats, ordered=False)
    trend = chart.wind_temperature_trend(bins)
    return {
        "monthly_avg_temp": rollup.monthly_temperature(stats),
        "daily_avg_temp": rollup.daily_temperature(stats),
        "avg_humidity": rollup.average_humidity(stats),
        "total_rain": rollup.total_rain(stats),
        "wind_trend": rollup.daily_wind(stats),
        "wind_temp_bins": chart.bin_weights(bins),
        "wind_temp_fit": trend,
        "wind_temp_fit_line": chart.trend_line(trend),
        "correlation": agg.correlation_lower_triangle(clean),
        "month_extremes": chart.monthly_extremes(monthly),
        "month_axis_ranges": chart.monthly_ranges(monthly),
        "humidity_ranks": chart.humidity_ranks(humidity),
        # same location set as the cleaned table, from a small result
        "palette": chart.palette_slots(humidity),
        "rows_per_location": rollup.location_counts(stats, "rows"),
        "rows_after_cleaning": rollup.row_count(stats),
    }


def run_analysis(spark: SparkSession, folder: str, out_dir: str | None = None,
                 materialize_mode: str = "parquet", release: bool = False) -> dict[str, DataFrame]:
    """Read, clean, materialise, compute and (optionally) write every result
    as CSV under ``out_dir/<name>``.  Returns the result frames.  With
    ``release`` what the job put aside is removed once the results are written,
    and the frames read the written results."""
    if release:
        if not out_dir:
            raise ValueError("release needs out_dir: the results are read from there")
        with job(spark):
            out = run_analysis(spark, folder, out_dir, materialize_mode)
            schemas = {name: df.schema for name, df in out.items()}
        return {name: spark.read.schema(schema).option("header", True).option("escape", '"').csv(f"{out_dir.rstrip('/')}/{name}")
                for name, schema in schemas.items()}
    obs = read_observations(spark, folder)
    clean = materialize(clean_observations(obs), materialize_mode)
    return write_results(results(clean, materialize_mode), out_dir)


def analyse_decoded(spark: SparkSession, decoded_path: str, location: Column | str,
                    out_dir: str | None = None, materialize_mode: str = "parquet") -> dict[str, DataFrame]:
    """The same from decoded observations (``run_decode``'s Parquet): adapt,
    clean, compute.  ``location`` names or builds the location of a row, e.g.
    ``station_id``."""
    return _analysed(spark.read.parquet(decoded_path), location, out_dir, materialize_mode)


def analyse_decoded_csv(spark: SparkSession, decoded_path: str, location: Column | str,
                        out_dir: str | None = None, materialize_mode: str = "parquet") -> dict[str, DataFrame]:
    """The same from the decoder's CSV text form (13 columns, ``NaN`` where a
    number is missing)."""
    decoded = (spark.read.schema(DECODED_SCHEMA).option("header", True).option("enforceSchema", False)
               .option("escape", '"').csv(decoded_path))
    return _analysed(decoded, location, out_dir, materialize_mode)


def analyse_raw(spark: SparkSession, raw_path, location: Column | str, sep: str = "auto",
                stations_path: str | None = None, out_dir: str | None = None,
                csv_text: bool = False) -> dict[str, DataFrame]:
    """Raw report CSVs -> decoded observations (written once in the shared
    checkpoint folder, as Parquet or as CSV text) -> every result."""
    decoded = scratch_path(spark, "decoded")
    run_decode(spark, raw_path, decoded, sep=sep, stations_path=stations_path, csv_output=csv_text)
    analyse = analyse_decoded_csv if csv_text else analyse_decoded
    return analyse(spark, decoded, location, out_dir)


def _analysed(decoded: DataFrame, location: Column | str, out_dir: str | None,
              materialize_mode: str) -> dict[str, DataFrame]:
    place = F.col(location) if isinstance(location, str) else location
    decoded = decoded.withColumn("location", place)
    clean = clean_observations(decoded_to_observations(decoded))
    return write_results(results(materialize(clean, materialize_mode), materialize_mode), out_dir)


def write_results(out: dict[str, DataFrame], out_dir: str | None) -> dict[str, DataFrame]:
    if out_dir:
        for name, df in out.items():
            write_result_csv(df, f"{out_dir.rstrip('/')}/{name}")
    return out


def clean_row_count(clean: DataFrame) -> DataFrame:
    """Rows after cleaning."""
    return clean.agg(F.count(F.lit(1)).alias("rows"))
