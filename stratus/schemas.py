"""Table schemas of the surface-weather data model."""

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# Raw (undecoded) reports, as the report service delivers them: all text.
RAW_COLUMNS = ["WMOIND", "YEAR", "MONTH", "DAY", "HOUR", "MIN", "REPORT"]
RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])

# Station coordinates.
STATION_SCHEMA = StructType([
    StructField("wmo_id", StringType(), True),
    StructField("lat", DoubleType(), True),
    StructField("lon", DoubleType(), True),
])

# The eight decoded readings, in output order.
READINGS = ["temp", "pressure", "humidity", "wind_speed", "wind_dir",
            "cloud_cover", "visibility_m", "rain_3h"]

# Decoded observations (decoder output), 13 columns.
DECODED_COLUMNS = ["station_id", "date", "time", "lat", "lon"] + READINGS
DECODED_SCHEMA = StructType(
    [StructField(c, StringType(), True) for c in ("station_id", "date", "time")]
    + [StructField(c, DoubleType(), True) for c in DECODED_COLUMNS[3:]]
)

# Numeric columns of the analysis stage (visibility is called ``visibility``).
NUMERIC_COLUMNS = ["temp", "pressure", "humidity", "wind_speed", "wind_dir",
                   "cloud_cover", "visibility", "rain_3h"]

# Observations as the analysis stage reads them, 12 columns.
OBSERVATION_COLUMNS = ["station_id", "datetime", "lat", "lon"] + NUMERIC_COLUMNS
OBSERVATION_SCHEMA = StructType(
    [StructField("station_id", StringType(), True),
     StructField("datetime", StringType(), True)]
    + [StructField(c, DoubleType(), True) for c in OBSERVATION_COLUMNS[2:]]
)

# Readings whose joint absence drops an observation during cleaning.
KEY_READINGS = ["temp", "pressure", "humidity", "wind_speed"]
