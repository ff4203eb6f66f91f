"""Column functions (built-in Spark expressions only) and fixed code tables."""

from stratus.functions.scalars import (  # noqa: F401
    clamp, humidity_magnus, lenient_int, map_lookup, nan_to_null, pressure_hpa,
    rain_mm, strip_ws, tenths_signed, visibility_m,
)
