"""Batches and their ledger, runs that exclude each other, errors that are noted, and what runs share."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.test_run import root  # noqa: F401
from trackloom.config import Settings
from trackloom.plans import pipeline
from trackloom.sources import checks, sinks
from trackloom.sources import frames as source


def counted(monkeypatch, crash_at=None):
    """Episodes of each batch that is made; from batch ``crash_at`` on it breaks."""
    made, keep = [], pipeline._batch

    def batch(spark, rows, episodes, s, base, ledger, number, step):
        if number == crash_at:
            raise RuntimeError("lost")
        made.append(number)
        keep(spark, rows, episodes, s, base, ledger, number, step)

    monkeypatch.setattr(pipeline, "_batch", batch)
    return made


def test_a_killed_run_repeats_only_what_the_ledger_lacks(spark, root, tmp_path, monkeypatch):  # noqa: F811
    out = str(tmp_path / "out")
    with monkeypatch.context() as m:
        made = counted(m, crash_at=1)
        with pytest.raises(RuntimeError, match="lost"):
            pipeline.run(spark, root, out, batch_episodes=1)
    assert made == [0] and sinks.read_note(spark, f"{out}/progress")["batches_to_make"] == 2
    error = sinks.read_note(spark, f"{out}/last_error")
    assert error["status"] == "failed" and error["error"] == "RuntimeError: lost"
    assert not sinks.exists(spark, f"{out}/lock") and not sinks.exists(spark, f"{out}/complete")
    label = next((tmp_path / "out/labels/batch=0/chunk=0").glob("*.parquet"))
    at = os.stat(label).st_mtime_ns
    os.utime(label, ns=(at, at + 10**9))
    with pytest.raises(ValueError, match="labels of batch 0 have changed"):
        pipeline.run(spark, root, out, batch_episodes=1)
    os.utime(label, ns=(at, at))
    with monkeypatch.context() as m:
        m.setattr(pipeline, "ALGORITHM", "other")
        with pytest.raises(ValueError, match="other settings"):
            pipeline.run(spark, root, out, batch_episodes=1)
    with monkeypatch.context() as m:
        made = counted(m)
        summary = pipeline.run(spark, root, out, batch_episodes=1)
    assert made == [1] and not sinks.exists(spark, f"{out}/last_error")
    assert spark.read.parquet(f"{out}/labels").groupBy("batch").count().orderBy("batch").collect() == [(0, 80), (1, 80)]
    ledger = pipeline.Ledger(spark, out, "").rows().orderBy("batch").collect()
    assert [(r.batch, r.episodes, r.frames) for r in ledger] == [(0, 1, 80), (1, 1, 80)]
    paths = {r.source_episode_index: r.repaired_label_path for r in spark.read.option("header", True).csv(f"{out}/episodes.csv").collect()}
    assert paths == {"0": "labels/batch=0/chunk=0", "1": "labels/batch=1/chunk=0"}
    note = sinks.read_note(spark, f"{out}/complete")
    assert {"/stages/frames", "/labels", "/timeline.csv"} <= set(note["timings"]["steps"]) and note["timings"]["seconds"] > 0
    assert summary == note["summary"]


def test_variants_share_all_but_the_camera_rule(spark, root, tmp_path, monkeypatch):  # noqa: F811
    shared, alone = str(tmp_path / "shared"), str(tmp_path / "alone")
    first = pipeline.run(spark, root, f"{tmp_path}/a", shared=shared)
    with monkeypatch.context() as m:
        made = counted(m)
        m.setattr(pipeline, "check_frames", lambda *_: pytest.fail("frames are read again"))
        second = pipeline.run(spark, root, f"{tmp_path}/b", Settings(skip_s3=True), shared=shared)
    assert made == [] and second == pipeline.run(spark, root, alone, Settings(skip_s3=True)) and first["stages"].keys() - second["stages"].keys() == {"S3"}
    place = sinks.read_note(spark, f"{tmp_path}/b/complete")["labels"]
    assert place.startswith(shared) and spark.read.parquet(place).count() == 160 and not sinks.exists(spark, f"{tmp_path}/b/labels")
    row = spark.read.option("header", True).csv(f"{tmp_path}/b/episodes.csv").first()
    assert spark.read.parquet(row.repaired_label_path).count() == 160
    made = counted(monkeypatch)
    pipeline.run(spark, root, f"{tmp_path}/c", Settings(position_step=0.2), shared=shared)
    assert made == [0]


def test_runs_over_one_output_exclude_each_other(spark, root, tmp_path):  # noqa: F811
    out = str(tmp_path / "out")
    with sinks.exclusive(spark, f"{out}/lock") as renew:
        with pytest.raises(RuntimeError, match="another run holds"):
            pipeline.run(spark, root, out)
        renew()
        assert not sinks.exists(spark, f"{out}/last_error") and not sinks.exists(spark, f"{out}/started")
    assert not sinks.exists(spark, f"{out}/lock")
    (tmp_path / "out/lock").write_text("left by one that died")
    old = time.time() - sinks.LEASE - 60
    os.utime(tmp_path / "out/lock", (old, old))
    with sinks.exclusive(spark, f"{out}/lock"):
        assert (tmp_path / "out/lock").read_text().startswith(spark.sparkContext.applicationId)
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == []


def test_bad_cameras_and_unknown_episodes_are_refused(spark, root, tmp_path):  # noqa: F811
    episodes, nan = source.read_episodes(spark, root), float("nan")
    assert checks.camera_failures(episodes).filter("failures > 0").isEmpty()
    nine = [50.0, 0.0, 50.0, 0.0, 50.0, 50.0, 0.0, 0.0, 1.0]
    cases = {
        "intrinsics_shape": ("k", nine[:6]), "intrinsics_finite": ("k", [nan if i == 1 else x for i, x in enumerate(nine)]), "focal_length": ("k", [0.0, *nine[1:]]),
        "lens_finite": ("lens", [0.1, nan, 0.0, 0.0]), "lens_model": ("lens", [0.1] * 6), "image_size": ("width", 0),
    }
    for check, (name, value) in cases.items():
        kind = episodes.schema[name].dataType
        one = spark.createDataFrame([(1, value)], f"ep long, value {kind.simpleString()}")
        bad = episodes.join(one, "ep", "left").withColumn(name, F.coalesce("value", name))
        found = {r.check: (r.failures, r.first_ep) for r in checks.camera_failures(bad).filter("failures > 0").collect()}
        assert found[check] == (1, 1), check
    assert checks.camera_failures(episodes.withColumn("lens", F.array().cast("array<double>"))).filter("failures > 0").isEmpty()
    base = tmp_path / "more"
    source.renamed(source.read_frames(spark, root).withColumn("ep", F.when((F.col("ep") == 1) & (F.col("f") == 79), 7).otherwise(F.col("ep"))), back=True).write.parquet(f"{base}/data/chunk-000")
    spark.read.option("recursiveFileLookup", True).parquet(f"{root}/meta/episodes").write.parquet(f"{base}/meta/episodes/chunk-000")
    (base / "meta/info.json").write_text(json.dumps({"fps": 30, "total_episodes": 2, "total_frames": 160}))
    with pytest.raises(ValueError, match="unknown_episode: 1"):
        pipeline.load(spark, str(base))
