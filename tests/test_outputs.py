"""What runs write beside labels, how they go on after a crash, clips from their CSV files, and the scans of single rules."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from tests.test_run import root  # noqa: F401
from trackloom import cli
from trackloom.plans import clips, pipeline, scans
from trackloom.sources import frames as source
from trackloom.sources import sinks


@pytest.fixture(scope="module")
def done(spark, root, tmp_path_factory):  # noqa: F811
    out = str(tmp_path_factory.mktemp("done") / "out")
    return out, pipeline.run(spark, root, out)


def test_plans_and_metadata(spark, done):
    out, summary = done
    plan = {r.source_episode_index: r for r in spark.read.json(f"{out}/plan.json").collect()}
    assert len(plan) == 2 and [x.stage for x in plan[1].stages] == ["S1", "S2", "S3", "S4"] and plan[1].stages[0].removed_frames == 35
    assert [(x.start, x.end) for x in plan[1].accepted_intervals] == [(35, 80)] and plan[1].timeline[0].matches == [1]
    manifest = spark.read.json(f"{out}/manifest.json")
    assert manifest.count() == 2 and not {"stages", "timeline", "accepted_intervals"} & set(manifest.columns)
    info = sinks.read_note(spark, f"{out}/labels_metadata/meta/info")
    assert info["total_frames"] == 160 and info["features"]["action.eef_anomaly_reason"]["dtype"] == "uint8" and info["trajectory_cleaning"]["partial_output"] is False
    assert spark.read.parquet(f"{out}/labels_metadata/meta/episodes").count() == 2
    assert summary["accepted_frames"] == 125 and summary["rejected_seconds"] == pytest.approx(35 / 30) and summary["repairs"]["repaired_hand_frames"] == 2
    assert len(spark.read.option("header", True).csv(f"{out}/episodes.csv").columns) == 12 and not sinks.exists(spark, f"{out}/stages")


def test_a_broken_run_is_taken_up(spark, root, done, tmp_path, monkeypatch):  # noqa: F811
    out = str(tmp_path / "out")

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "write_csv", crash)
        with pytest.raises(RuntimeError, match="lost"):
            pipeline.run(spark, root, out)
    assert sinks.written_whole(spark, f"{out}/stages/points/batch=0") and not sinks.exists(spark, f"{out}/complete")
    (tmp_path / "out/timeline.csv").mkdir()  # as if a writer had begun
    with monkeypatch.context() as m:
        m.setattr(pipeline.outliers, "detected", lambda *a: a[0].withColumn("code", F.raise_error(F.lit("made again"))))
        m.setattr(pipeline.repair, "repaired", lambda x, s: x)
        assert pipeline.run(spark, root, out) == done[1]


def test_changed_recordings_are_refused(spark, root, tmp_path):  # noqa: F811
    copy, out = str(tmp_path / "copy"), str(tmp_path / "out")
    shutil.copytree(root, copy)
    pipeline.run(spark, copy, out, first=1)
    (tmp_path / "copy/meta/info.json").write_text(json.dumps({"fps": 30, "total_episodes": 2, "total_frames": 160, "more": 1}))
    with pytest.raises(ValueError, match="has changed"):
        pipeline.run(spark, copy, out, first=1)


def test_clips_from_csv(spark, done, tmp_path):
    annotation, summary = done
    keyframes = spark.range(0, 80, 20).select(F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("ep"), F.col("id").alias("kf")).select("ep", F.explode(F.array(*map(F.lit, source.VIEWS))).alias("view"), "kf")
    found = clips.run(spark, annotation, f"{tmp_path}/a", keyframes)
    assert found["kept_frames"] == summary["accepted_frames"] and found["segments"] == 2 and found["whole_source_references"] == 1 and found["new_video_files"] == 2
    rows = spark.read.json(f"{tmp_path}/a/segments.json").collect()
    assert len(rows) == 4
    cut = next(r for r in rows if r.ep == 1 and r.view == "camera_aux_0")
    assert (cut.start, cut.end, cut.middle_start, cut.middle_end, cut.method) == (35, 80, 40, 60, "gop_copy_boundary_encode")
    assert cut.video_path == "videos/camera_aux_0/chunk-000/episode-000001-segment-0000.mp4" and cut.label_rows.trainable_end == 79
    assert found["methods"]["original_reference"]["new_files"] == 0 and clips.run(spark, annotation, f"{tmp_path}/a", keyframes) == found
    assert clips.run(spark, annotation, f"{tmp_path}/b", ids=[1])["source_frames"] == 80 and clips.run(spark, annotation, f"{tmp_path}/c", first=1)["segments"] == 1
    with pytest.raises(ValueError, match="no such episodes: 9"):
        clips.run(spark, annotation, f"{tmp_path}/d", ids=[1, 9])
    other = f"{tmp_path}/copy"
    shutil.copytree(annotation, other)
    lines = spark.read.option("header", True).csv(f"{annotation}/timeline.csv")
    sinks.write_csv(lines.withColumn("start_frame", F.when(F.col("start_frame") == "35", "36").otherwise(F.col("start_frame"))), f"{other}/timeline.csv")
    with pytest.raises(ValueError, match="has changed since"):
        clips.run(spark, other, f"{tmp_path}/e")
    note = sinks.read_note(spark, f"{other}/complete")
    note["digests"]["timeline.csv"] = sinks.digest(spark.read.option("header", True).csv(f"{other}/timeline.csv"))
    sinks.write_note(spark, f"{other}/complete", note)
    with pytest.raises(ValueError, match="episode 1: gap or overlap"):
        clips.run(spark, other, f"{tmp_path}/f")


@pytest.fixture(scope="module")
def scannable(spark, root, tmp_path_factory):  # noqa: F811
    """The recordings with videos from 0 on, as scans of anomalies want them, and one frame of episode 0 with a wrong time."""
    base = tmp_path_factory.mktemp("scan")
    shutil.copytree(f"{root}/data", base / "data")
    rows = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/meta/episodes")
    for v in source.VIEWS:
        at = f"videos/observation.images.{v}"
        rows = rows.withColumn(f"{at}/from_timestamp", F.lit(0.0)).withColumn(f"{at}/to_timestamp", F.lit(80 / 30))
    rows.coalesce(1).write.parquet(f"{base}/meta/episodes/chunk-000")
    (base / "meta/info.json").write_text(json.dumps({"fps": 30, "total_episodes": 2, "total_frames": 160, "state_action_delay": 1, "codebase_version": "v3.0"}))
    (base / "meta/episode_source_map.jsonl").write_text("".join(json.dumps({"episode_index": i, "task": "t", "filter_source_start_seconds": 2.0}) + "\n" for i in (0, 1)))
    return str(base)


def test_scan_of_anomalies(spark, root, scannable, tmp_path):  # noqa: F811
    out = f"{tmp_path}/a"
    found = cli.main(["scan-anomalies", scannable, out])
    assert found["status"] == "complete" and found["affected_episodes"] == 2 and found["state_suspect_frames"] == 37 and found["sparse_rows"] == spark.read.parquet(f"{out}/labels").count()
    spans = spark.read.option("header", True).csv(f"{out}/suspect_intervals.csv").collect()
    assert sorted((r.episode_index, r.start_frame, r.end_frame_exclusive, r.original_start_seconds) for r in spans) == [("0", "10", "12", "2.3333333333333335"), ("1", "0", "35", "2.0")]
    actions = spark.read.option("header", True).csv(f"{out}/suspect_action_rows.csv").collect()
    assert sorted((r.ep, r.start_action_row, r.end_action_row_exclusive, r.includes_external_terminal_target) for r in actions) == [("0", "9", "11", "false"), ("1", "0", "34", "false")]
    record = next(r for r in spark.read.json(f"{out}/episodes.json").collect() if r.ep == 0)
    left = next(h for h in record.hands if h.hand == "l")
    assert left.state_suspect_frames == 2 and [(x.start, x.end) for x in left.state_intervals] == [(10, 12)] and {x.reason: x.frames for x in left.state_reason_counts}["nonfinite_pose"] == 2
    with pytest.raises(ValueError, match="video_start"):
        scans.anomalies(spark, root, f"{tmp_path}/b")


def test_scans_of_edges_and_cameras(spark, scannable, tmp_path):
    assert scans.edges(spark, scannable, f"{tmp_path}/e")["bad_videos"] == 0
    assert spark.read.option("header", True).csv(f"{tmp_path}/e/bad_segments.csv").count() == 0
    found = scans.cameras(spark, scannable, f"{tmp_path}/c", sample=1)
    assert found["processed_episodes"] == 1 and found["evaluated_windows"] == 74 and found["hit_videos"] == 0
    assert cli.parser().parse_args(["scan-edges", "a", "b", "--sample", "3"]).sample == 3
