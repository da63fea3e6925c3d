"""What a task holds is bounded by rows, and stages are written no more than once."""

import pathlib

import pytest
from pyspark.sql import functions as F

from tests.recordings import yaw6
from trackloom.config import Settings
from trackloom.functions import geometry as G
from trackloom.operators import intervals as I
from trackloom.operators import outliers, repair
from trackloom.plans import store
from trackloom.sources import frames, videos

SF = "/root/testdata/sf0.001"


def test_tasks_grow_in_number_and_not_in_rows(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(10).withColumnRenamed("id", "ep")
    assert I.dealt(rows, "ep", rows=I.ROWS).rdd.getNumPartitions() == least
    assert I.dealt(rows, "ep", rows=100 * I.ROWS + 1).rdd.getNumPartitions() == 101


def test_packets_are_counted_in_tasks_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(I, "ROWS", 10)
    packets = spark.createDataFrame([("v", i, i * 512, 512, 15360, i == 0, "avc1", 1) for i in range(30)], "path string, sample long, pts long, duration long, timescale long, key boolean, codec string, streams int")
    wanted = spark.createDataFrame([(1, "a", "v", 0, 30), (2, "a", "w", 0, 30)], "ep long, view string, path string, base long, n long")
    found = videos.packet_failures(packets, wanted, packets=100)
    assert [tuple(r) for r in found.collect()] == [(2, "a", "no video")]
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString() and ", 10)" in found._jdf.queryExecution().toString()


def test_another_s3_writes_no_frames_of_its_own(spark):
    store.frames(spark, SF)
    folder = pathlib.Path(store.shared_folder(spark).removeprefix("file://").removeprefix("file:"))
    before = sorted(p.name for p in folder.iterdir())
    sweep = store.frames(spark, SF, Settings(s3_translation=0.05, s3_rotation=5.0))
    hits = sweep.filter("s3_t").count()
    assert sorted(p.name for p in folder.iterdir()) == before
    assert hits > store.frames(spark, SF).filter("s3_t").count() > 0
    assert len([name for name in before if name.startswith("measured")]) == 0


def test_rows_without_a_share_skip_the_great_arc(spark):
    rows = spark.createDataFrame([(1, 0.5), (2, None)], "id long, share double")
    one, other = (G.vector(c, 0, s, 0, 1, 0, -s, 0, c) for c, _, s, *_ in (yaw6(0), yaw6(50)))
    made = {r.id: r.between for r in G.slerp(rows.withColumn("a", one).withColumn("b", other), "a", "b", "share", "between").collect()}
    assert made[2] is None and made[1][:6] == pytest.approx(yaw6(25))


def test_frames_meet_cameras_without_another_exchange(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with store.small_methods(spark):
            sides = [I.dealt(spark.range(9).selectExpr("id AS ep", "id AS f"), "ep", rows=6 * I.ROWS) for _ in range(2)]
            plan = sides[0].join(sides[1], ["ep", "f"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange ") == plan.count("REPARTITION_BY_NUM") == 2
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_next_states_are_taken_once_however_often_they_are_used(spark):
    rows = outliers.delay_rows(frames.wide(frames.from_lineitem(spark, SF)))
    windows = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [lead(" in line]
    assert max(line.count("lead(") for line in windows) == 4
    assert not [c for c in rows.columns if c.startswith("__")]


def test_columns_that_no_step_needs_ride_along_as_one(spark):
    rows = I.dealt(spark.range(40).selectExpr("id % 4 AS ep", "id AS f", "id % 3 = 0 AS flag", "id * 2 AS `a.b`", "CAST(NULL AS STRING) AS none", "array(id) AS many"), "ep")
    with store.small_methods(spark):
        out = I.apart(rows, ["flag"], lambda d: d.withColumn("before", F.lag("flag").over(I.over(["ep"], "f"))).drop("flag"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, out.collect()))
    window = next(line for line in plan.splitlines() if "Window [lag(" in line)
    assert "__others" in plan[plan.index(window):] and plan.count("Exchange ") == 1
    assert out.columns == ["ep", "f", "a.b", "none", "many", "before"]
    assert got == sorted((i % 4, i, i * 2, None, [i], (i - 4) % 3 == 0 if i >= 4 else None) for i in range(40))


def test_points_pass_one_window_and_one_exchange(spark):
    with store.small_methods(spark):
        rows = repair.repaired(outliers.detected(outliers.points(frames.wide(frames.from_lineitem(spark, SF))), Settings()), Settings())
        plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("+- Window ") + plan.count("Window [") - plan.count("+- Window [") == 1
    assert plan.count("Exchange ") == 1


def test_poses_with_nulls_are_invalid_and_odd_widths_raise(spark):
    shape = "ep long, hand string, pt long, n long, p array<float>, r6 array<float>"
    upright = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]
    poses = [([0.0, 0.0, 0.0], upright), (None, upright), ([0.0, None, 0.0], upright), ([0.0, 0.0, 0.0], [1.0, 0.0, 0.0, 0.0, 0.5, 0.0]), ([0.0, 0.0, float("nan")], upright), ([0.1, 0.0, 0.0], upright)]
    rows = spark.createDataFrame([(1, "l", i, len(poses), *pose) for i, pose in reversed(list(enumerate(poses)))], shape)
    fixed = {r.pt: r for r in repair.repaired(outliers.detected(rows, Settings()), Settings()).collect()}
    assert [fixed[i].code for i in range(6)] == [0, 16, 16, 32, 16, 0] and [fixed[i].action_code for i in range(6)] == [16, 16, 32, 16, 0, 0]
    assert [(fixed[i].gap_start, fixed[i].gap_end, fixed[i].repaired) for i in (0, 1, 4)] == [(None, None, False), (1, 5, True), (1, 5, True)]
    assert [fixed[i].p2[0] for i in range(6)] == pytest.approx([0, 0.02, 0.04, 0.06, 0.08, 0.1])
    with pytest.raises(Exception, match="other than 3 numbers"):
        outliers.detected(rows.withColumn("p", F.array(F.lit(0.0))), Settings()).collect()
