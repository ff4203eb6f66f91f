"""Fixed values of the SYNOP code tables and of the analysis.

Fixed values: these must equal the values of the original decoder and analysis
for results to match; they are stated once, here, in their natural order.
"""

# --- fixed values: built-in station coordinates (WMO id -> lat, lon) ---------
BUILTIN_STATIONS = {
    "98444": (13.15, 123.74),
    "98446": (13.57, 124.20),
    "98543": (12.36, 123.62),
    "98536": (12.58, 122.26),
    "98427": (13.96, 121.59),
    "98434": (14.74, 121.64),
    "98440": (14.12, 122.98),
}

# --- fixed values: report structure -------------------------------------------
REPORT_TYPES = ("AAXX", "BBXX", "OOXX")          # optional leading message type
SECTION_MARKERS = ("222", "333", "444", "555")   # end section 1
SECTION3_END = ("222", "444", "555")             # end section 3
KNOT_UNIT_CODES = ("3", "4")                     # last char of YYGGiw: knots
KNOT_TO_MS = 0.514444

# --- fixed values: visibility VV (metres) ------------------------------------
# 00-50 -> VV*100; 51-80 -> (VV-50)*1000+5000; 81-89 -> (VV-80)*5000+35000;
# 90 and 99 -> missing; 91-98 -> the table below.
VISIBILITY_91_98 = {91: 50.0, 92: 200.0, 93: 500.0, 94: 1000.0,
                    95: 2000.0, 96: 4000.0, 97: 10000.0, 98: 40000.0}

# --- fixed values: cloud base height h (metres); "/" -> missing --------------
CLOUD_BASE_M = {"0": 0, "1": 50, "2": 100, "3": 200, "4": 300,
                "5": 600, "6": 1000, "7": 1500, "8": 2000, "9": 2500}

# --- fixed values: precipitation duration t (hours) --------------------------
RAIN_DURATION_H = {"1": 6, "2": 12, "3": 18, "4": 24, "5": 1,
                   "6": 2, "7": 3, "8": 9, "9": 15}

# --- fixed values: Magnus humidity constants ---------------------------------
MAGNUS_A = 17.625
MAGNUS_B = 243.04

# --- fixed values: raw reply screening ---------------------------------------
REPLY_ERROR_WORDS = ("ERROR", "NO DATA", "NOT FOUND", "HOST NOT", "FORBIDDEN")
REPLY_HEADER_WORDS = ("WMOIND", "YEAR")

# --- fixed values: analysis ---------------------------------------------------
TEMP_RANGE = (10.0, 45.0)          # plausible temperature band, inclusive
WIND_RANGE = (0.0, 25.0)           # plausible wind band, inclusive
WIND_BIN_WIDTH = 0.5
BIN_WEIGHT_QUANTILE = 0.95
BIN_WEIGHT_SCALE = 200.0
BIN_WEIGHT_OFFSET = 15.0
TREND_MIN_BINS = 5                 # a trend needs more than 4 bins
TREND_POINTS = 100
AXIS_FLOOR = 15.0                  # lowest axis bottom of the monthly series
AXIS_BELOW = 2.0
AXIS_ABOVE = 2.5
FILL_BELOW = 0.5

PALETTE = ["#5b9bd5", "#9b72cf", "#3fbf99", "#e8a838",
           "#e06b8b", "#4dbdbd", "#a3c46e", "#d4745a"]

CORRELATION_LABELS = {
    "temp": "Temp",
    "pressure": "Pressure",
    "humidity": "Humidity",
    "wind_speed": "Wind Speed",
    "wind_dir": "Wind Dir",
    "cloud_cover": "Cloud Cover",
    "visibility": "Visibility",
    "rain_3h": "Rainfall",
}
