"""Property tests of small rules against plain models (test code only)."""

import datetime as dt
import os
import random
import re

from stratus.functions.scalars import lenient_int
from stratus.operators import rollup
from stratus.operators.clean import clean_observations
from stratus.operators.coverage import period_bounds
from stratus.sinks import write_result_csv


def _first_digits(text, default):
    m = re.search(r"[0-9]+", text)
    return int(m.group()) if m else default


def test_lenient_int_matches_model(spark):
    rnd = random.Random(11)
    alphabet = "0123456789 ?YPA-+.x/\t"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))) for _ in range(2000)]
    texts += ["", "0000", "007", "99999999999999999999", "?8", "YP", "6A", " 12 "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", lenient_int("t", 7).alias("v")).collect()}
    for i, t in enumerate(texts):
        want = _first_digits(t, 7)
        assert got[i] == want, (t, got[i], want)


def test_period_bounds_cover_the_range():
    """Whole periods of ``days`` from 1 January, the last cut at the end of the
    range or now: their number is the range's minutes over a period's, rounded up."""
    rnd = random.Random(5)
    for _ in range(300):
        y0 = rnd.randint(1995, 2024)
        y1 = rnd.randint(y0, 2026)
        days = rnd.choice([1, 3, 7, 30, 90, 365, 400])
        now = dt.datetime(rnd.randint(1994, 2027), rnd.randint(1, 12), rnd.randint(1, 28),
                          rnd.randint(0, 23), rnd.randint(0, 59))
        start, stop, n = period_bounds(y0, y1, days, now)
        minutes = (stop - start).total_seconds() // 60 + 1
        assert start == dt.datetime(y0, 1, 1) and stop <= now and stop <= dt.datetime(y1, 12, 31, 23, 59)
        assert stop in (now, dt.datetime(y1, 12, 31, 23, 59)) and n == max(0, -(-minutes // (days * 1440)))


def test_result_csv_keeps_order_across_parts(spark, tmp_dir):
    rows = [(f"L{i % 7}", f"2024-{1 + i % 12:02d}-{1 + i % 28:02d} 00:00:00", 10.0 + i % 30,
             None, 50.0, 1.0, 0.0, 0.0, 0.0, 0.0) for i in range(3000)]
    df = clean_observations(spark.createDataFrame(
        rows, "location string, datetime string, temp double, pressure double, humidity double, "
              "wind_speed double, wind_dir double, cloud_cover double, visibility double, rain_3h double"))
    out = os.path.join(tmp_dir, "daily")
    write_result_csv(rollup.daily_temperature(rollup.statistics(df, "day")), out)
    lines = []
    for f in sorted(os.listdir(out)):
        if f.endswith(".csv"):
            lines += open(os.path.join(out, f)).read().splitlines()[1:]
    keys = [tuple(line.split(",")[:2]) for line in lines]
    assert len(keys) == rollup.daily_temperature(rollup.statistics(df, "day")).count() and keys == sorted(keys)
