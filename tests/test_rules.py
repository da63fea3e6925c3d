"""Closed-form recordings through every rule, all episodes in one plan."""

import pytest
from pyspark.sql import functions as F

from tests.recordings import episode, frames
from trackloom.config import Settings
from trackloom.operators import outliers, repair, rules
from trackloom.plans import timeline
from trackloom.sources.frames import wide

OFF = lambda a, z: lambda f: (-2.9, 2.9) if a <= f < z else (0.0, 0.0)
EPISODES = {
    0: dict(n=80, invalid=range(10, 12)),
    1: dict(n=80, invalid=range(35)),
    2: dict(n=80, external_bad=True),
    3: dict(n=150, step=0.015),
    4: dict(n=150, angle=1.4),
    5: dict(n=80, move=lambda f: (0.5 if 20 <= f <= 22 else 0.0, 0.0)),
    6: dict(n=80, move=lambda f: (0.5 if 20 <= f < 36 else 0.0, 0.0)),
    7: dict(n=100, invalid=(), move=OFF(20, 79)),
    8: dict(n=100, invalid=(), move=OFF(20, 80)),
    9: dict(n=120, move=lambda f: (-2.9 if f >= 10 else 0.0, 0.0)),
    10: dict(n=80, invalid=range(20, 50)),
    11: dict(n=80, invalid=range(20, 51)),
    12: dict(n=40, invalid=(10,), turn=lambda f: 0.0 if f < 10 else 50.0),
    13: dict(n=60, move=lambda f: (0.12 if f == 30 else 0.0, 0.0)),
    14: dict(n=6, step=0.05),
}


@pytest.fixture(scope="module")
def judged(spark):
    df = frames(spark, *[episode(ep, **options) for ep, options in EPISODES.items()])
    points = repair.repaired(outliers.detected(outliers.points(wide(df)), Settings()), Settings()).persist()
    fixed = repair.per_frame(points).join(wide(df).select("ep", "f", "rot", "centre", "k", "lens", "width", "height"), ["ep", "f"])
    return points, timeline.attributed(timeline.rules_on(fixed, Settings())).persist()


def pieces(judged, ep):
    rows = timeline.timeline(judged[1]).filter(F.col("ep") == ep).orderBy("start").collect()
    return [(r.start, r.end, r.code, r.reason) for r in rows], [list(r.matches) for r in rows]


def spans(df, ep, column):
    found = [r.f for r in df.filter((F.col("ep") == ep) & F.expr(column)).orderBy("f").collect()]
    return (found[0], found[-1] + 1, len(found)) if found else None


def test_short_gap_is_repaired(judged):
    points, rows = judged
    assert spans(rows, 0, "s1") is None and spans(rows, 0, "l_repaired") == (10, 12, 2) and spans(rows, 0, "l_arepaired") == (9, 11, 2)
    r = rows.filter("ep = 0 AND f = 10").first()
    assert r.l_code == 16 and r.l_p[0] == pytest.approx(-0.1, abs=1e-6)
    untouched = points.filter("ep = 0 AND code = 0")
    assert untouched.filter("NOT (p2 <=> p) OR NOT (r62 <=> r6)").isEmpty()


def test_leading_gap_and_bad_target_are_rejected(judged):
    _, rows = judged
    assert spans(rows, 1, "s1") == (0, 35, 35) and spans(rows, 2, "s1") == (79, 80, 1)
    assert spans(rows, 2, "NOT l_valid") is None and spans(rows, 2, "NOT l_avalid") == (79, 80, 1)


def test_translation_and_rotation_matched_by_both_rules(judged):
    assert pieces(judged, 3) == ([(0, 150, 4, 41)], [[41, 31]])
    assert pieces(judged, 4) == ([(0, 150, 4, 42)], [[42, 32]])
    accounts = {(r.ep, r.stage): r for r in timeline.stage_accounts(judged[1]).filter("ep = 3").collect()}
    assert accounts[3, "S3"].matched_frames == 150 and accounts[3, "S3"].removed_frames == 0 and accounts[3, "S3"].overlap_frames == 150
    assert accounts[3, "S4"].removed_frames == 150 and accounts[3, "S4"].removed_intervals == 1


def test_jump_block_is_marked_and_interpolated(judged):
    points, rows = judged
    assert spans(points.withColumnRenamed("pt", "f"), 5, "code = 1") == (20, 23, 3)
    assert all(r.l_p[0] == pytest.approx(-0.1, abs=1e-6) for r in rows.filter("ep = 5 AND f BETWEEN 20 AND 22").collect())
    assert spans(points.withColumnRenamed("pt", "f"), 6, "code <> 0") is None


def test_hands_out_of_view_long_enough(judged):
    _, rows = judged
    assert spans(rows, 7, "s2") is None and spans(rows, 8, "s2") == (20, 80, 60) and spans(rows, 9, "s2") is None


def test_longest_gap_that_is_repaired(judged):
    _, rows = judged
    assert spans(rows, 10, "s1") is None and spans(rows, 11, "s1") == (20, 51, 31)


def test_rotation_is_interpolated_along_the_arc(judged):
    points, _ = judged
    r = points.filter("ep = 12 AND hand = 'l' AND pt = 10").first()
    assert r.code == 16 and r.r62[0] == pytest.approx(0.9063078, abs=1e-5) and r.r62[2] == pytest.approx(0.4226183, abs=1e-5)


def test_spike_and_short_episode(judged):
    points, rows = judged
    assert spans(points.withColumnRenamed("pt", "f"), 13, "code = 4") == (30, 31, 1)
    assert rows.filter("ep = 14 AND code <> 0").isEmpty() and rows.filter("ep = 14").count() == 6


def test_partition_and_sums(judged):
    _, rows = judged
    lengths = rows.groupBy("ep").agg(F.max("n").alias("n"))
    assert timeline.conservation_errors(timeline.timeline(rows), lengths).isEmpty()
    assert not timeline.conservation_errors(timeline.timeline(rows).filter("NOT (ep = 1 AND start = 0)"), lengths).isEmpty()
    removed = timeline.stage_accounts(rows).agg(F.sum("removed_frames")).first()[0]
    assert removed == rows.filter("code > 0").count()


def test_windows_stay_inside_segments_and_thresholds_are_monotone(spark):
    df = wide(frames(spark, episode(0, n=80, step=0.008), episode(1, n=80, step=0.03))).withColumn("s1", F.expr("ep = 0 AND f = 40"))
    base = rules.segmented(rules.hands_at_edge(df, Settings())).persist()
    s4 = rules.stable_carry(rules.camera_motion(base, Settings(skip_s3=True)), Settings(skip_s3=True))
    assert s4.filter("ep = 0 AND s4 > 0").isEmpty() and s4.filter("s3 > 0").isEmpty()
    strict, loose = (rules.camera_motion(base, Settings(s3_translation=t, s3_rotation=r)).filter("s3 > 0").select("ep", "f") for t, r in ((0.20, 20), (0.15, 15)))
    assert strict.count() == 0 and loose.filter("ep = 1").count() == 80 and strict.exceptAll(loose).isEmpty()


@pytest.mark.parametrize("bad", [dict(s3_translation=0.0), dict(s3_translation=float("nan")), dict(s3_rotation=180.0), dict(s3_rotation=float("inf")), dict(max_gap=0), dict(edge_fraction=0.5)])
def test_settings_out_of_domain(bad):
    with pytest.raises(ValueError):
        Settings(**bad)


def test_fingerprint_follows_every_threshold():
    assert Settings().fingerprint() == Settings().fingerprint() != Settings(s3_rotation=8).fingerprint()


def test_mismatching_actions_get_their_own_codes(spark):
    df = wide(frames(spark, episode(0, n=30), episode(1, n=30))).withColumn("l_ap", F.when(F.expr("ep = 1 AND f = 12"), F.array(F.lit(0.4), F.lit(0.0), F.lit(2.0)).cast("array<float>")).otherwise(F.col("l_ap")))
    found = outliers.mismatch_codes(df, Settings()).filter("code <> 0").collect()
    assert [(r.ep, r.hand, r.f, r.code) for r in found] == [(1, "l", 12, 65)]
