"""A whole run over a recording set in its own layout: labels, reports, resuming, and what must fail."""

import json

import pytest
from pyspark.sql import functions as F

from tests.recordings import episode, frames
from trackloom.config import Settings
from trackloom.plans.pipeline import run
from trackloom.sources import checks, sinks
from trackloom.sources import frames as source


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("set")
    df = frames(spark, episode(0, n=80, invalid=range(10, 12)), episode(1, n=80, invalid=range(35), at=80))
    renamed = source.renamed(df.drop("n", "k", "lens", "width", "height", "r_grip"), back=True)
    for ep in (0, 1):
        renamed.filter(F.col("episode_index") == ep).coalesce(1).write.parquet(f"{base}/data/chunk-000/file-{ep:03d}")
    view = lambda v, x: f"videos/observation.images.{v}/{x}"
    cols = {"episode_index": "ep", "length": "80L", "dataset_from_index": "ep * 80", "dataset_to_index": "ep * 80 + 80", "data/chunk_index": "0L", "data/file_index": "ep"}
    cols |= {"camera_intrinsics.camera_reference.matrix": "array(array(50D, 0D, 50D), array(0D, 50D, 50D), array(0D, 0D, 1D))", "camera_intrinsics.camera_reference.dist_coeffs": "array(0D, 0D, 0D, 0D, 0D)", "camera_intrinsics.camera_reference.stored_image_size": "named_struct('width', 100, 'height', 100)"}
    for v in source.VIEWS:
        cols |= {view(v, "chunk_index"): "0L", view(v, "file_index"): "ep", view(v, "from_timestamp"): "1.25D", view(v, "to_timestamp"): "1.25D + 80 / 30D"}
    spark.range(2).withColumnRenamed("id", "ep").select(*[F.expr(e).alias(n) for n, e in cols.items()]).coalesce(1).write.parquet(f"{base}/meta/episodes/chunk-000")
    (base / "meta/info.json").write_text(json.dumps({"fps": 30, "total_episodes": 2, "total_frames": 160}))
    return str(base)


def test_run_writes_everything_once(spark, root, tmp_path):
    out = f"{tmp_path}/out"
    summary = run(spark, root, out)
    assert summary["source_frames"] == 160 and summary["rejected_frames"] == 35 and summary["stages"]["S1"]["removed"] == 35
    labels = spark.read.parquet(f"{out}/labels")
    assert labels.count() == 160 and "observation.state.eef_valid" in labels.columns and "raw_hand_feature" in labels.columns
    row = labels.filter("episode_index = 0 AND frame_index = 10").first().asDict()
    assert row["observation.state.eef_repaired"] == [True, False] and row["observation.state.hand_features_valid"] == [False, True]
    lines = spark.read.option("header", True).csv(f"{out}/timeline.csv").orderBy("source_episode_index", F.col("start_frame").cast("int")).collect()
    assert [(r.status, r.start_frame, r.end_frame_exclusive, r.camera_reference_mp4_start_seconds) for r in lines] == [("keep", "0", "80", "1.250000"), ("reject", "0", "35", "1.250000"), ("keep", "35", "80", "2.416667")]
    assert run(spark, root, out) == summary
    with pytest.raises(ValueError, match="other settings"):
        run(spark, root, out, Settings(skip_s3=True))


def test_checks_find_broken_metadata_and_frames(spark, root):
    episodes, info = source.read_episodes(spark, root), source.read_info(spark, root)
    assert checks.episode_failures(episodes, info).filter("failures > 0").isEmpty()
    broken = {r["check"] for r in checks.episode_failures(episodes.filter("ep = 1"), info).filter("failures > 0").collect()}
    assert {"episode_count", "episode_index", "frame_total"} <= broken
    df = frames(spark, episode(0, n=5))
    bad = df.filter("f <> 2").withColumn("ts", F.when(F.col("f") == 3, 9.0).otherwise(F.col("ts"))).withColumn("cam", F.when(F.col("f") == 4, F.array(*[F.array(*[F.lit(0.0)] * 4)] * 4).cast("array<array<float>>")).otherwise(F.col("cam")))
    found = {r["check"]: r["failures"] for r in checks.frame_failures(bad).collect()}
    assert found["timestamp"] == 1 and found["frame_index"] == 2 and found["length"] == 4 and found["camera_reflection"] == 1 and found["camera_bottom_row"] == 1
    with pytest.raises(ValueError, match="timestamp"):
        checks.require(checks.frame_failures(bad))
    assert checks.failing_episodes(df).isEmpty() and checks.failing_episodes(bad).count() == 1


def test_labels_round_trip_under_dotted_names(spark, tmp_path):
    df = frames(spark, episode(0, n=5, invalid=(2,))).drop("n", "k", "lens", "width", "height")
    sinks.write_labels(df, f"{tmp_path}/labels")
    assert checks.changed_rows(df, source.renamed(spark.read.parquet(f"{tmp_path}/labels").drop("chunk")), ["ep", "f"]).isEmpty()


def test_missing_source_mapping_raises(spark, tmp_path):
    intervals = spark.createDataFrame([(1, "l", 0, 2, 0.0, 0.1, 17, 0.5, 1.0)], "ep long, hand string, start long, end long, start_seconds double, end_seconds double, code int, peak_position_step double, peak_rotation_step double")
    (tmp_path / "map.jsonl").write_text('{"episode_index": 1, "task": "t", "filter_source_start_seconds": 2.0}\n')
    mapping = source.read_source_map(spark, str(tmp_path / "map.jsonl"))
    from trackloom.config import BITS

    row = sinks.anomaly_report(intervals, mapping, BITS).first()
    assert row.reasons == "block_position_jump|nonfinite_pose" and row.original_end_seconds == pytest.approx(2.1)
    with pytest.raises(Exception, match="no source mapping"):
        sinks.anomaly_report(intervals, mapping.filter("episode_index > 1"), BITS).collect()
