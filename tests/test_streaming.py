"""Incremental decode of landing files: exactly once across runs."""

import os

from stratus.streaming import start_decode_stream

HEADER = "WMOIND,YEAR,MONTH,DAY,HOUR,MIN,REPORT\n"


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(HEADER + "".join(rows))


def test_stream_decodes_each_file_once(spark, tmp_dir):
    inp, out, ckpt = (os.path.join(tmp_dir, d) for d in ("in", "out", "ckpt"))
    land(inp, "a.csv", ["98444,2024,1,1,0,0,AAXX 01001 98444 32970 81204 10255=\n",
                        "98446,2024,1,1,3,0,AAXX 01031 98446 NIL=\n"])
    q = start_decode_stream(spark, inp, out, checkpoint=ckpt)
    q.awaitTermination(120)
    first = spark.read.parquet(out).collect()
    assert len(first) == 2
    assert {r.station_id: r.temp for r in first} == {"98444": 25.5, "98446": None}
    land(inp, "b.csv", ["98440,2024,1,2,6,0,AAXX 02061 98440 32970 81204 10301=\n"])
    q = start_decode_stream(spark, inp, out, checkpoint=ckpt)
    q.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert sorted(r.station_id for r in rows) == ["98440", "98444", "98446"]
    assert [r.temp for r in rows if r.station_id == "98440"] == [30.1]


def test_stream_with_station_table(spark, tmp_dir):
    from stratus.sources.stations import station_table

    inp, out = os.path.join(tmp_dir, "in2"), os.path.join(tmp_dir, "out2")
    land(inp, "a.csv", ["98444,2024,1,1,0,0,AAXX 01001 98444 32970 81204 10255=\n",
                        "11111,2024,1,1,0,0,AAXX 01001 11111 32970 81204 10255=\n"])
    st = station_table(spark.createDataFrame([(1, "11111", "1.5", "2.5")],
                                             "line int, wmo_id string, lat string, lon string"), "line")
    q = start_decode_stream(spark, inp, out, checkpoint=os.path.join(tmp_dir, "ck2"), stations=st)
    q.awaitTermination(120)
    got = {r.station_id: (r.lat, r.lon) for r in spark.read.parquet(out).collect()}
    assert got == {"98444": (13.15, 123.74), "11111": (1.5, 2.5)}
