"""Codes of marked rows are found without ordering all points again."""

from trackloom import queries
from trackloom.operators import outliers
from trackloom.plans import reports, store

SF = "/root/testdata/sf0.001"


def test_marked_rows_are_filtered_before_they_meet_and_no_points_are_sorted(spark):
    plan = queries.affected_episodes(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_kept_action_codes_are_those_of_the_points_aimed_at(spark):
    points = store.points(spark, SF)
    by = ["ep", "hand", "f"]
    kept, anew = (outliers.action_codes(p).orderBy(*by).collect() for p in (points, points.drop("action_code")))
    assert kept == anew and any(r.action_code for r in kept)


def test_labels_of_one_marked_hand_keep_zeros_of_the_other(spark):
    rows = [(1, hand, pt, code, False) for hand, codes in (("l", (0, 4, 0, 0)), ("r", (0, 0, 0, 8))) for pt, code in enumerate(codes)]
    found = reports.sparse_labels(spark.createDataFrame(rows, "ep long, hand string, pt long, code int, external boolean")).orderBy("f").collect()
    assert [tuple(r) for r in found] == [(1, 0, 0, 4, 0, 0), (1, 1, 4, 0, 0, 0), (1, 2, 0, 0, 0, 8), (1, 3, 0, 0, 8, 8)]
