"""Chart data as DataFrames: wind/temperature bins with weights and a linear
trend, monthly extremes and axis ranges, humidity ranks and palette slots.

Everything works on small aggregated tables (one row per location and bin or
month), so the windows here partition tiny inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions import codes
from stratus.operators.clean import wind_and_temperature_in_range
from stratus.session import stored


def wind_temperature_bins(df: DataFrame) -> DataFrame:
    """Per location and 0.5 m/s wind bin: mean temperature and row count.

    Plausible wind (0-25) and temperature (10-45) only;
    ``ws_bin = int(wind / 0.5) * 0.5``.
    """
    w = codes.WIND_BIN_WIDTH
    return (wind_and_temperature_in_range(df)
            .withColumn("ws_bin", (F.col("wind_speed") / w).cast("int") * w)
            .groupBy("location", "ws_bin")
            .agg(F.avg("temp").alias("avg_temp"), F.count(F.lit(1)).alias("n")))


def bin_weights(bins: DataFrame) -> DataFrame:
    """Marker weight per bin: counts clipped at the location's 95th percentile
    (linear interpolation), scaled so the largest is 200 + 15."""
    loc = Window.partitionBy("location")
    clipped = F.least(F.col("n").cast("double"), F.col("_cap"))
    return (bins
            .withColumn("_cap", F.percentile(F.col("n"), F.lit(codes.BIN_WEIGHT_QUANTILE)).over(loc))
            .withColumn("n_clipped", clipped)
            .withColumn("weight", F.col("n_clipped") / F.max("n_clipped").over(loc)
                        * codes.BIN_WEIGHT_SCALE + codes.BIN_WEIGHT_OFFSET)
            .drop("_cap"))


def wind_temperature_trend(bins: DataFrame) -> DataFrame:
    """Unweighted least-squares line of mean temperature on wind bin, per
    location with more than four bins: ``slope intercept bins x_min x_max``."""
    return (bins.groupBy("location")
            .agg(F.regr_slope("avg_temp", "ws_bin").alias("slope"),
                 F.regr_intercept("avg_temp", "ws_bin").alias("intercept"),
                 F.count(F.lit(1)).alias("bins"),
                 F.min("ws_bin").alias("x_min"), F.max("ws_bin").alias("x_max"))
            .filter(F.col("bins") >= codes.TREND_MIN_BINS))


def trend_line(trend: DataFrame, points: int = codes.TREND_POINTS) -> DataFrame:
    """The fitted line at ``points`` evenly spaced x from the first to the last
    bin (both ends included): ``location point x y``."""
    step = (F.col("x_max") - F.col("x_min")) / (points - 1)
    return (trend
            .select("location", "slope", "intercept", "x_min", "x_max",
                    F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
            .withColumn("x", F.when(F.col("point") == points - 1, F.col("x_max"))
                        .otherwise(F.col("x_min") + F.col("point") * step))
            .select("location", "point", "x",
                    (F.col("slope") * F.col("x") + F.col("intercept")).alias("y")))


def monthly_extremes(monthly: DataFrame) -> DataFrame:
    """Hottest and coldest month per location by the (rounded) monthly mean;
    ties go to the earliest month."""
    hot = Window.partitionBy("location").orderBy(F.col("avg_temp").desc(),
                                                  F.col("month").asc_nulls_last())
    cold = Window.partitionBy("location").orderBy(F.col("avg_temp").asc(),
                                                   F.col("month").asc_nulls_last())
    ranked = (monthly.filter(F.col("avg_temp").isNotNull())
              .withColumn("_hot", F.row_number().over(hot))
              .withColumn("_cold", F.row_number().over(cold)))
    return (ranked.filter((F.col("_hot") == 1) | (F.col("_cold") == 1))
            .groupBy("location")
            .agg(F.max(F.when(F.col("_hot") == 1, F.col("month"))).alias("hottest_month"),
                 F.max(F.when(F.col("_hot") == 1, F.col("avg_temp"))).alias("hottest_avg_temp"),
                 F.max(F.when(F.col("_cold") == 1, F.col("month"))).alias("coldest_month"),
                 F.max(F.when(F.col("_cold") == 1, F.col("avg_temp"))).alias("coldest_avg_temp")))


def monthly_ranges(monthly: DataFrame) -> DataFrame:
    """Axis range of each location's monthly series: low = max(15, min - 2),
    high = max + 2.5, fill floor = min - 0.5."""
    lo, hi = F.min("avg_temp"), F.max("avg_temp")
    return (monthly.groupBy("location")
            .agg(F.greatest(F.lit(codes.AXIS_FLOOR), lo - codes.AXIS_BELOW).alias("axis_low"),
                 (hi + codes.AXIS_ABOVE).alias("axis_high"),
                 (lo - codes.FILL_BELOW).alias("fill_floor")))


def global_places(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` with every row's place (from 1) in the order of the whole table.
    Rows are dealt into ranges and counted per range, one small row each; a
    place is the rows of earlier ranges and the place in its own."""
    dealt = stored(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    before, ahead = 0, []
    for r in sorted(dealt.groupBy("__range").count().collect()):  # as many rows as ranges
        ahead.append((r[0], before))
        before += r[1]
    starts = F.broadcast(df.sparkSession.createDataFrame(ahead, "__range int, __before long"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return (dealt.withColumn(name, inside).join(starts, "__range")
            .withColumn(name, (F.col(name) + F.col("__before")).cast("int")).drop("__range", "__before"))


def humidity_ranks(humidity: DataFrame) -> DataFrame:
    """Rank 1 = most humid (NULL last, ties by location), and the bar colour:
    bars are coloured by their position in ascending-humidity order."""
    ranked = global_places(humidity, [F.col("avg_humidity").desc_nulls_last(), F.col("location")], "rank")
    placed = global_places(ranked, [F.col("avg_humidity").asc_nulls_last(), F.col("location")], "__up")
    colours = F.array(*[F.lit(c) for c in codes.PALETTE])
    slot = (F.col("__up") - 1) % len(codes.PALETTE)
    return placed.withColumn("bar_colour", F.element_at(colours, (slot + 1).cast("int"))).drop("__up")


def palette_slots(locations: DataFrame) -> DataFrame:
    """Palette index (sorted position mod 8) and colour of each location."""
    colours = F.array(*[F.lit(c) for c in codes.PALETTE])
    n = len(codes.PALETTE)
    placed = global_places(locations.select("location").distinct(), [F.col("location")], "__place")
    return (placed.withColumn("palette_index", (F.col("__place") - 1) % n).drop("__place")
            .withColumn("colour", F.element_at(colours, F.col("palette_index") + 1)))
