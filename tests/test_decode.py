"""SYNOP decode: one case per rule, plus a property test against a plain
sequential model of the decoding rules."""

import math
import random

import pytest

from stratus.operators.decode import decode_reports

OUT = ["temp", "pressure", "humidity", "wind_speed", "wind_dir", "cloud_cover",
       "visibility_m", "rain_3h"]


def run(spark, reports, extras=False):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(reports)], "id int, REPORT string")
    rows = decode_reports(df, extras=extras).orderBy("id").collect()
    return [r.asDict() for r in rows]


def test_full_report(spark):
    (r,) = run(spark, ["AAXX 01001 98444 32970 81204 10255 20220 30085 40102 60011 81500 333 60027="])
    assert r["temp"] == 25.5
    assert r["pressure"] == 1010.2          # last 4-group beats the 3-group
    assert r["wind_dir"] == 120.0 and r["wind_speed"] == 4.0
    assert r["cloud_cover"] == 8.0
    assert r["visibility_m"] == 25000.0     # VV=70: (70-50)*1000+5000
    assert r["rain_3h"] == 1.0              # section 1 wins over section 3


def test_nil(spark):
    (r,) = run(spark, ["AAXX 01001 98444 NIL="])
    assert all(r[c] is None for c in OUT)


def test_empty_and_null(spark):
    rows = run(spark, ["", "   ", None])
    for r in rows:
        assert all(r[c] is None for c in OUT)


@pytest.mark.parametrize("ir,expected", [("0", None), ("1", None), ("2", None),
                                         ("3", 0.0), ("4", None), ("/", None)])
def test_rain_indicator(spark, ir, expected):
    (r,) = run(spark, [f"AAXX 01001 98444 {ir}2970 81204 10255="])
    assert r["rain_3h"] == expected


def test_section3_rain_only_for_ir_0_2(spark):
    rows = run(spark, ["AAXX 01001 98444 22970 81204 10255 333 60057 60017=",
                       "AAXX 01001 98444 12970 81204 10255 333 60057=",
                       "AAXX 01001 98444 32970 81204 10255 333 60057="])
    assert rows[0]["rain_3h"] == 5.0        # first valid group of section 3
    assert rows[1]["rain_3h"] is None       # iR=1: section 3 not read
    assert rows[2]["rain_3h"] == 0.0        # iR=3 sentinel


def test_222_hides_section3(spark):
    (r,) = run(spark, ["AAXX 01001 98444 02970 81204 10255 222 00000 333 60057="])
    assert r["rain_3h"] is None


def test_rain_codes(spark):
    rows = run(spark, ["AAXX 01001 98444 12970 81204 69901=", "AAXX 01001 98444 12970 81204 69951=",
                       "AAXX 01001 98444 12970 81204 61231="])
    assert [r["rain_3h"] for r in rows] == [0.1, 0.5, 123.0]


def test_wind_extension_and_knots(spark):
    rows = run(spark, ["AAXX 01001 98444 32970 81299 00105 10255=",   # m/s, 00fff
                       "AAXX 01001 98444 32970 81299 10255=",         # ff=99, no 00fff
                       "AAXX 01003 98444 32970 81210 10255=",         # knots
                       "AAXX 01004 98444 32970 81299 00105=",         # knots + 00fff
                       "AAXX 01001 98444 32970 8//// 10255="])        # all slashes
    assert rows[0]["wind_speed"] == 105.0 and rows[0]["temp"] == 25.5
    assert rows[1]["wind_speed"] is None and rows[1]["temp"] == 25.5
    assert rows[2]["wind_speed"] == 5.1
    assert rows[3]["wind_speed"] == 54.0
    assert rows[4]["wind_speed"] is None and rows[4]["wind_dir"] is None
    assert rows[4]["cloud_cover"] == 8.0


def test_variable_direction_and_missing_cloud(spark):
    (r,) = run(spark, ["AAXX 01001 98444 32970 /9905 10255 84500="])
    assert r["wind_dir"] is None and r["wind_speed"] == 5.0
    assert r["cloud_cover"] == 4.0          # from the first 8-group


def test_pressure_order(spark):
    rows = run(spark, ["AAXX 01001 98444 32970 81204 30085 30099=",
                       "AAXX 01001 98444 32970 81204 30085 40102 30099=",
                       "AAXX 01001 98444 32970 81204 40102 30099 40099="])
    assert rows[0]["pressure"] == 1008.5    # first 3-group
    assert rows[1]["pressure"] == 1010.2    # any 4-group wins
    assert rows[2]["pressure"] == 1009.9    # last 4-group


def test_last_temperature_wins_and_negative(spark):
    (r,) = run(spark, ["AAXX 01001 98444 32970 81204 10255 11012="])
    assert r["temp"] == -1.2


def test_missing_nddff_shifts(spark):
    (r,) = run(spark, ["AAXX 01001 98444 32970 10250 20220="])
    assert r["cloud_cover"] == 1.0 and r["wind_dir"] == 20.0 and r["wind_speed"] == 50.0
    assert r["temp"] is None


def test_dewpoint_above_temp(spark):
    (r,) = run(spark, ["AAXX 01001 98444 32970 81204 10200 20250="], extras=True)
    assert r["humidity"] == 100.0 and r["dewpoint_gt_temp"] is True


def test_no_index_group(spark):
    (r,) = run(spark, ["AAXX 01001 98444 8120 10255="])
    assert r["visibility_m"] is None and r["temp"] == 25.5


def test_visibility_table(spark):
    codes = ["00", "50", "51", "80", "81", "89", "90", "91", "94", "98", "99", "6A"]
    rows = run(spark, [f"AAXX 01001 98444 321{c} 81204=" for c in codes])
    assert [r["visibility_m"] for r in rows] == [
        0.0, 5000.0, 6000.0, 35000.0, 40000.0, 80000.0, None, 50.0, 1000.0, 40000.0, None, None]


def test_extras(spark):
    (r,) = run(spark, ["AAXX 01001 98444 32470 81204 10255 20220 60012="], extras=True)
    assert r["cloud_base_m"] == 300.0 and r["rain_duration_h"] == 12.0 and r["dewpoint"] == 22.0


# ---------------------------------------------------------------------------
# generated reports: the values are drawn first and written into the text, so
# what must come out is known without reading it back
# ---------------------------------------------------------------------------

def drawn_report(rnd):
    want = dict.fromkeys(OUT)
    knots, ir = rnd.random() < 0.4, rnd.choice("01234")
    parts = [rnd.choice(["AAXX", "BBXX", "OOXX", None]), f"{rnd.randint(1000, 9999)}{4 if knots else 1}", "98444"]
    if rnd.random() < 0.9:
        metres, vv = rnd.choice([(100.0 * k, k) for k in range(51)] + [(5000.0 + 1000 * k, 50 + k) for k in range(1, 31)]
                                + [(35000.0 + 5000 * k, 80 + k) for k in range(1, 10)] + [(None, "//")])
        parts.append(f"{ir}29{vv if isinstance(vv, str) else format(vv, '02d')}")
        want["visibility_m"] = metres
    else:  # a group of another length is no index group, and no wind follows
        ir = None
        parts.append("3297")
    low_cloud = rnd.choice([None, 0, 5, 8])
    total = rnd.choice([None, *range(9)]) if ir else None
    want["cloud_cover"] = None if total is None and low_cloud is None else float(low_cloud if total is None else total)
    degrees, speed = rnd.choice([None, *range(0, 370, 10)]), rnd.choice([None, *range(99), 104, 250])
    if ir is None:
        degrees = speed = None
    want["wind_dir"] = None if degrees is None else float(degrees)
    if speed is not None:
        want["wind_speed"] = float(round(speed * 0.514444, 1)) if knots else float(speed)
    ff = "//" if speed is None else "99" if speed > 98 else f"{speed:02d}"
    if ir:
        parts.append(("/" if total is None else str(total)) + ("//" if degrees is None else f"{degrees // 10:02d}") + ff)
    if ff == "99":
        parts.append(f"00{speed:03d}")
    tenths = {"1": rnd.choice([None, rnd.randint(-300, 400)]), "2": rnd.choice([None, rnd.randint(-300, 400)])}
    groups = []
    for lead, v in tenths.items():
        if v is not None:
            if rnd.random() < 0.3:  # an earlier group of its kind: the last one holds
                groups.append(f"{lead}0111")
            groups.append(f"{lead}{int(v < 0)}{abs(v):03d}")
    t, td = (None if v is None else v / 10.0 for v in tenths.values())
    want["temp"] = t
    if t is not None and td is not None:
        share = 100.0 * math.exp(17.625 * td / (243.04 + td)) / math.exp(17.625 * t / (243.04 + t))
        want["humidity"] = min(100.0, max(0.0, round(share, 1)))
    station, sea = rnd.choice([None, rnd.randint(9000, 10499)]), rnd.choice([None, rnd.randint(9000, 10499)])
    groups += [f"{lead}{v % 10000:04d}" for lead, v in (("3", station), ("4", sea)) if v is not None]
    pressure = sea if sea is not None else station
    want["pressure"] = None if pressure is None else pressure / 10.0
    rains = [(float(k), k) for k in (0, 1, 17, 480, 989)] + [(k / 10.0, 990 + k) for k in range(1, 10)]
    first, later = rnd.choice([None, *rains]), rnd.choice([None, *rains])
    if first:
        groups.append(f"6{first[1]:03d}1")
    if low_cloud is not None:
        groups.append(f"8{low_cloud}5//")
    if rnd.random() < 0.2:
        groups.append(rnd.choice(["////", "1////", "5Z", "7AB12"]))
    end = rnd.choice(["none", "333", "222 333", "333 444"])
    if end == "333" and later:
        groups += ["333", "10250", f"6{later[1]:03d}7", "69991"]
    elif end != "none":
        groups += [*end.split(), "61231"]
    late = later[0] if end == "333" and later and ir in ("0", "2") else 123.0 if end == "333" and ir in ("0", "2") else None
    want["rain_3h"] = first[0] if first else late if late is not None else 0.0 if ir == "3" else None
    return " ".join(p for p in parts + groups if p) + rnd.choice(["", "=", "=="]), want


def test_generated_reports(spark):
    rnd = random.Random(7)
    made = [drawn_report(rnd) for _ in range(2000)]
    got = run(spark, [r for r, _ in made])
    bad = [(r, c, w[c], g[c]) for (r, w), g in zip(made, got) for c in OUT
           if w[c] != g[c] and not (c == "humidity" and g[c] is not None and abs(w[c] - g[c]) < 0.11)]
    assert not bad, bad[:10]
