"""Dataflow operators on small frames."""

import random

from pyspark.sql import functions as F

from tallygrove.operators import linking, location, marts, nearest
from tallygrove.sources import snapshot
from tallygrove.streaming import events


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_first_by_key_and_links(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 5, None)], "k string, o int, v string")
    assert rows(linking.first_by_key(df, ["k"], [F.col("o")])) == [("a", 1, "x"), ("b", 5, None)]
    linked = linking.link_repeats(df, "k", [F.col("o")]).select("k", "o", "repeat_seq")
    assert rows(linked) == [("a", 1, 1), ("a", 2, 2), ("b", 5, 1)]
    assert rows(linking.first_by_key(df.limit(0), ["k"], [F.col("o")])) == []


def test_diff_of_equal_states_is_empty(spark):
    df = spark.createDataFrame([(1, 10.0, "A"), (2, None, None)], "k int, p double, s string")
    assert rows(linking.snapshot_diff(df, df, "k", ["p"], "s")) == []
    later = spark.createDataFrame([(1, 8.0, "B"), (3, 1.0, "C")], "k int, p double, s string")
    got = linking.snapshot_diff(later, df, "k", ["p"], "s").select("k", "event", "pct")
    assert rows(got) == [(1, "cijena", -20.0), (1, "status", None), (2, "nestala", None), (3, "nova", None)]
    first = linking.snapshot_diff(later, df.limit(0), "k", ["p"], "s")
    assert rows(first) == []


def test_merge_keeps_absent_rows(spark):
    state = spark.createDataFrame([(1, "a", 1, 1, 1), (2, "b", 1, 1, 1)], "k int, v string, first_seen int, last_seen int, times_seen int")
    batch = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert rows(linking.merge_state(state, batch, "k", F.lit(9))) == [(1, "a", 1, 1, 1), (2, None, 1, 9, 2), (3, "c", 9, 9, 1)]


def test_nearest_equals_brute_force(spark):
    pts = [(i, 45 + (i * 37 % 100) / 100, 15 + (i * 61 % 100) / 100) for i in range(40)]
    far = [(i, 45 + (i * 13 % 100) / 100, 15 + (i * 7 % 100) / 100) for i in range(30)]
    got = nearest.nearest(spark.createDataFrame(pts, "point_id int, lat double, lon double"), spark.createDataFrame(far, "place_id int, lat double, lon double"), 2, 12.0)
    import math

    want = []
    for i, a, b in pts:
        near = sorted((math.hypot(a - c, (b - d) * math.cos(math.radians((a + c) / 2))) * 111.0, j) for j, c, d in far)
        want += [(i, j, r) for r, (km, j) in enumerate(near[:2], 1) if km <= 12]
    assert sorted((r["point_id"], r["place_id"], r["rank"]) for r in got.collect()) == sorted(want)


def _brute(pts, far, k, within=None):
    import math

    out = []
    for i, a, b in pts:
        near = sorted((math.hypot(a - c, (b - d) * math.cos(math.radians((a + c) / 2))) * 111.0, j) for j, c, d in far)
        out += [(i, j, r) for r, (km, j) in enumerate(near[:k], 1) if within is None or km <= within]
    return sorted(out)


def test_nearest_in_a_dense_town(spark):
    """A third of all places within metres of each other, a tenth at one point, some far away: no cell holds more than its bound."""
    rng = random.Random(4)
    far = [(i, 45.5 + rng.random() * 1e-3, 15.5 + rng.random() * 1e-3) for i in range(300)] + [(1000 + i, 45.2, 15.2) for i in range(90)]
    far += [(2000 + i, 44 + rng.random() * 3, 14 + rng.random() * 4) for i in range(500)] + [(5000, -33.0, 151.0), (5001, None, 1.0), (5002, 1.0, None)]
    pts = [(i, 45.5 + rng.random() * 2e-3, 15.5 + rng.random() * 2e-3) for i in range(20)] + [(100 + i, 45 + rng.random(), 15 + rng.random()) for i in range(30)] + [(200, 45.2, 15.2), (201, 45.2, 15.2), (202, -80.0, 170.0), (203, None, None)]
    point, place = spark.createDataFrame(pts, "point_id int, lat double, lon double"), spark.createDataFrame(far, "place_id int, lat double, lon double")
    known = [x for x in far if None not in x]
    some = [x for x in pts if None not in x]
    for k, within in ((4, None), (3, 12.0)):
        got = nearest.nearest(point, place, k, within, leaf=8)
        assert sorted((r["point_id"], r["place_id"], r["rank"]) for r in got.collect()) == _brute(some, known, k, within)
    cells = nearest.Cells(place, 4, leaf=8)
    assert cells.members.groupBy("level", "x", "y").count().agg(F.max("count")).first()[0] <= 8 and len(cells.levels) >= 3
    assert nearest.nearest(point, place.limit(0), 3).collect() == []


def test_nearest_in_a_town_of_centimetres(spark):
    """Thousands of places within some centimetres: cells split until they hold few, however close the places are."""
    rng = random.Random(6)
    far = [(i, 45.5 + rng.random() * 4e-7, 15.5 + rng.random() * 4e-7) for i in range(900)] + [(5000 + i, 45 + rng.random(), 15 + rng.random()) for i in range(100)]
    pts = [(i, 45.5 + rng.random() * 4e-7, 15.5 + rng.random() * 4e-7) for i in range(20)] + [(100 + i, 45 + rng.random(), 15 + rng.random()) for i in range(10)]
    point, place = spark.createDataFrame(pts, "point_id int, lat double, lon double"), spark.createDataFrame(far, "place_id int, lat double, lon double")
    assert nearest.Cells(place, 5).members.groupBy("level", "x", "y").count().agg(F.max("count")).first()[0] <= nearest.LEAF
    got = nearest.nearest(point, place, 5)
    assert sorted((r["point_id"], r["place_id"], r["rank"]) for r in got.collect()) == _brute(pts, far, 5)


def test_counties_spread_to_a_fixed_point(spark):
    """A chain of units, each known one round after its neighbour; rounds end when nothing changes. By brute force, with frozen rounds."""
    import math

    rng = random.Random(8)
    units = [(i, 45.0, 15.0 + i * 0.05, "A" if i < 3 else None) for i in range(16)] + [(100 + i, 46.0 + rng.random(), 16 + rng.random(), rng.choice([None, None, "A", "B"])) for i in range(60)]
    km = lambda a, b: math.hypot(a[1] - b[1], (a[2] - b[2]) * math.cos(math.radians((a[1] + b[1]) / 2))) * 111.0

    def want(rounds):
        now = {u[0]: u[3] for u in units}
        for _ in range(rounds):
            known = [u for u in units if now[u[0]]]
            near = {u[0]: sorted((km(u, v), v[0]) for v in known)[:3] for u in units if not now[u[0]]}
            new = {i: now[n[0][1]] for i, n in near.items() if len(n) == 3 and n[0][0] <= 12 and len({now[j] for _, j in n}) == 1}
            if not new:
                break
            now |= new
        return now

    frame = spark.createDataFrame(units, "unit_id int, lat double, lon double, county string")
    for rounds in (1, 3, None):
        got = {r["unit_id"]: r["county"] for r in location.assign_counties(frame, k=3, rounds=rounds).collect()}
        assert got == want(99 if rounds is None else rounds)
    assert want(99)[15] == "A" and want(3)[15] is None


def test_cascade_prefers_position_inside_a_phase(spark):
    df = spark.createDataFrame([(1, 1, 5, 0, "Z1", "a", "visoka"), (1, 1, 2, 1, "Z2", "b", "srednja"), (1, 0, 9, 0, "Z3", "c", "nema")], "item_id int, phase int, position int, step int, county string, city string, confidence string")
    assert rows(location.cascade(df)) == [(1, "Z3", "c", "nema")]
    assert rows(location.cascade(df.where("phase = 1"))) == [(1, "Z2", "b", "srednja")]


def test_assign_counties_spreads(spark):
    units = [(i, 45.0, 15.0 + i * 0.05, "A" if i < 3 else None) for i in range(6)]
    got = location.assign_counties(spark.createDataFrame(units, "unit_id int, lat double, lon double, county string"), k=2, within_km=12.0)
    assert {r["county"] for r in got.collect()} == {"A"}


def test_related_is_null_safe(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "k int, g string")
    assert rows(marts.related(df, "k", "g", 6)) == [(1, 2, 1), (2, 1, 1)]


def test_snapshot_reader(spark, tmp_path):
    raw = '﻿A;B\n"x ""q""";"two\nlines"\n;\n"y";"2"\n'
    (tmp_path / "s.csv").write_text(raw, encoding="utf-8")
    got = snapshot.read_snapshot(spark, f"file://{tmp_path}/s.csv", ["A", "B"]).drop("row_ord")
    assert rows(got) == [('x "q"', "two\nlines"), ("y", "2")]
    log = f"file://{tmp_path}/log"
    for _ in range(2):
        snapshot.append_log(got, log, 7)
    assert spark.read.parquet(log).count() == 2


def test_windows_over_a_stream(spark, tmp_path):
    """The same windows from a stream as from a batch; what comes after the watermark is left out."""
    import datetime as dt

    at = lambda day, hour=0: dt.datetime(2024, 1, day, hour)
    kinds = "ts timestamp, event_type string, value double"
    first = spark.createDataFrame([(at(1), "a", 1.0), (at(1, 5), "a", 2.0), (at(2), "b", 4.0), (at(9), "a", 8.0)], kinds)
    first.coalesce(1).write.parquet(f"{tmp_path}/in/0")
    stream = spark.readStream.schema(kinds).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    query = events.windowed_counts(stream).writeStream.format("memory").queryName("windows").outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").start()
    try:
        query.processAllAvailable()
        spark.createDataFrame([(at(1), "late", 1.0), (at(20), "a", 1.0)], kinds).coalesce(1).write.parquet(f"{tmp_path}/in/1")
        query.processAllAvailable()
        got = spark.table("windows").select("window_start", "event_type", "n", "total")
        want = events.windowed_counts(first).select("window_start", "event_type", "n", "total")
        assert rows(got) == rows(want)
    finally:
        query.stop()
