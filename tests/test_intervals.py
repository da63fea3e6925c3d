"""Interval algebra and clip plans against small known cases and a brute-force version."""

import random

import pytest

from trackloom.operators import intervals as I
from trackloom.plans import cutplan


def spans(df):
    return sorted((r.k, r.start, r.end) for r in df.collect())


def runs_of(frames):
    out = []
    for f in sorted(frames):
        if out and out[-1][1] == f:
            out[-1][1] = f + 1
        else:
            out.append([f, f + 1])
    return out


def test_algebra_matches_frame_sets(spark):
    rng = random.Random(5)
    sides = [[(k, a, a + rng.randrange(0, 6)) for k in range(12) for a in (rng.randrange(30) for _ in range(6))] for _ in range(2)]
    left, right = (spark.createDataFrame(s, "k int, start long, end long") for s in sides)
    cover = [{k: {f for q, a, z in s if q == k for f in range(a, z)} for k in range(12)} for s in sides]
    def expected(pick):
        return sorted((k, a, z) for k in range(12) for a, z in runs_of(pick(cover[0][k], cover[1][k])))

    assert spans(I.merged(left, ["k"])) == expected(lambda a, b: a)
    assert spans(I.subtracted(left, right, ["k"])) == expected(lambda a, b: a - b)
    assert spans(I.intersected(left, right, ["k"])) == expected(lambda a, b: a & b)
    frames = spark.range(40).selectExpr("id AS f").crossJoin(spark.range(12).selectExpr("cast(id AS int) AS k"))
    held = {(r.k, r.f): r.covered for r in I.masked(frames, left.filter("end > start"), ["k"]).collect()}
    assert all(held[k, f] == sum(q == k and a <= f < z for q, a, z in sides[0]) for k in range(12) for f in range(40))


def test_touching_spans_merge_and_empty_ones_go(spark):
    df = spark.createDataFrame([(1, 0, 3), (1, 3, 5), (1, 6, 6), (1, 7, 9)], "k int, start long, end long")
    assert spans(I.merged(df, ["k"])) == [(1, 0, 5), (1, 7, 9)]
    assert spans(I.merged(df.filter("k > 5"), ["k"])) == []


def test_near_groups_and_long_runs(spark):
    hits = spark.createDataFrame([(1, f) for f in (0, 6, 13, 14)], "k int, f long")
    assert [r.segment for r in I.near_groups(hits, ["k"], 6).orderBy("f").collect()] == [1, 1, 2, 2]
    flagged = spark.createDataFrame([(1, f, f not in (2, 6)) for f in range(10)], "k int, f long, flag boolean")
    assert [r.f for r in I.long_runs(flagged, ["k"], "flag", 3, "out").filter("out").orderBy("f").collect()] == [3, 4, 5, 7, 8, 9]


def test_clips_merge_adjacent_keeps(spark):
    rows = [(7, 0, 3, "keep"), (7, 3, 4, "keep"), (7, 4, 8, "reject"), (7, 8, 12, "keep")]
    df = spark.createDataFrame(rows, "ep long, start long, end long, status string").selectExpr("*", "CASE status WHEN 'keep' THEN 0 ELSE 1 END AS code")
    lengths = spark.createDataFrame([(7, 12, 4, 8)], "ep long, n long, rejected_frames long, accepted_frames long")
    plan = cutplan.cut_plan(df, lengths).orderBy("clip").collect()
    assert [(r.start, r.end, r.trainable_rows, r.whole) for r in plan] == [(0, 4, 3, False), (8, 12, 3, False)]
    assert cutplan.checked_timeline(df, lengths).isEmpty()
    gap = df.filter("start <> 4").unionByName(spark.createDataFrame([(7, 5, 8, "reject", 1)], "ep long, start long, end long, status string, code int"))
    assert {r.problem for r in cutplan.checked_timeline(gap, lengths).collect()} == {"gap or overlap", "rejected total"}
    assert {r.problem for r in cutplan.checked_timeline(df, lengths.selectExpr("ep + 1 AS ep", "n", "rejected_frames", "accepted_frames")).collect()} == {"missing"}


def test_gop_split(spark):
    clips = spark.createDataFrame([(1, "v", 0, 35, 100, False), (1, "v", 1, 61, 80, False), (1, "v", 2, 60, 90, False), (2, "v", 0, 0, 50, True)], "ep long, view string, clip long, start long, end long, whole boolean").withColumn("frames", __import__("pyspark").sql.functions.expr("end - start"))
    marks = spark.createDataFrame([(e, "v", k) for e in (1, 2) for k in range(0, 150, 30)], "ep long, view string, kf long")
    got = {(r.ep, r.clip): (r.middle_start, r.middle_end, r.head, r.tail, r.method) for r in cutplan.gop_split(clips, marks).collect()}
    assert got[1, 0] == (60, 90, 25, 10, "gop_copy_boundary_encode") and got[1, 1][4] == "full_reencode_fallback" and got[1, 2] == (60, 90, 0, 0, "gop_copy") and got[2, 0][4] == "original_reference"


@pytest.mark.parametrize("least", [1, 3])
def test_long_runs_with_missing_frames_nulls_and_ties_between_keys(spark, least):
    rng = random.Random(least)
    rows = [(k, f, rng.choice([True, True, True, False, None])) for k in range(20) for f in range(40) if rng.random() < 0.9]
    flagged = spark.createDataFrame(rows, "k int, f long, flag boolean")
    want = set()
    for k in range(20):
        for a, z in runs_of(f for q, f, x in rows if q == k and x):
            want |= {(k, f) for f in range(a, z) if z - a >= least}
    got = I.long_runs(flagged, ["k"], "flag", least, "long")
    assert got.columns == ["k", "f", "flag", "long"] and got.count() == len(rows)
    assert {(r.k, r.f) for r in got.filter("long").collect()} == want
    assert I.long_runs(flagged.limit(0), ["k"], "flag", least, "long").count() == 0


@pytest.mark.parametrize("beyond", ["", "l", "r", "lr"])
def test_frames_take_the_points_that_their_actions_aim_at(spark, beyond):
    from trackloom.operators import repair

    n = 4
    points = [(1, n, h, p, False) for h in "lr" for p in range(n)] + [(1, n, h, n, True) for h in beyond]
    rows = [(ep, n, h, p, x, [100.0 * (h == "r") + p] * 3, [0.0] * 6, p, not (x and h == "l"), p % 2 == 1) for ep, n, h, p, x in points]
    fixed = spark.createDataFrame(rows, "ep long, n long, hand string, pt long, external boolean, p2 array<double>, r62 array<double>, code int, ok boolean, repaired boolean")
    got = {r.f: r for r in repair.per_frame(fixed).collect()}
    assert sorted(got) == list(range(n))
    for f, r in got.items():
        for h in "lr":
            to = f + 1 if f + 1 < n or h in beyond else f
            base = 100.0 * (h == "r")
            assert (r[f"{h}_p"][0], r[f"{h}_ap"][0], r[f"{h}_code"], r[f"{h}_acode"]) == (base + f, base + to, f, to)
            assert (r[f"{h}_repaired"], r[f"{h}_arepaired"], r[f"{h}_beyond"]) == (f % 2 == 1, to % 2 == 1, to == n)
        assert r.s1 == (f == n - 1 and "l" in beyond)


def test_packet_times(spark):
    rows = spark.createDataFrame([(5120,), (5130,), (0,)], "pts long").select("pts", cutplan.packet_frame(__import__("pyspark").sql.functions.col("pts"), 1, 15360).alias("f"))
    assert {r.pts: r.f for r in rows.collect()} == {5120: 10, 5130: None, 0: 0}


@pytest.mark.parametrize("name", ["interval_merge", "cut_plan"])
def test_entry_lists_queries_with_sql(name):
    import __spark_entry__ as entry

    assert name in entry.queries() and name in entry.oracle_sql() and set(entry.oracle_sql()) <= set(entry.queries())
