"""The rules one by one over recordings, with their reports as files; episodes that fail a check are listed, not fatal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BITS, Settings
from ..operators import intervals as I
from ..operators import outliers, rules
from ..sources import checks, frames, sinks
from . import reports
from .store import written


def sound(spark: SparkSession, root: str, sample: int | None = None, seed: int = 0, scanner: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(frames of sound episodes, episodes, errors): metadata that fails raises, frames that fail put their episode among the errors."""
    episodes, info = frames.read_episodes(spark, root), frames.read_info(spark, root)
    checks.require(checks.episode_failures(episodes, info))
    if scanner:
        checks.require(checks.scanner_failures(episodes, info))
    if sample is not None:
        episodes = reports.sampled(episodes, sample, seed)
    rows = frames.with_episodes(frames.read_frames(spark, root), episodes)
    errors = written(checks.failing_episodes(rows), "errors")
    return rows.join(errors.select("ep"), "ep", "left_anti"), episodes, errors


def _counts(episodes: DataFrame, errors: DataFrame) -> dict:
    sums = episodes.agg(F.count(F.lit(1)).alias("e"), F.sum("n").alias("n")).first()
    bad = errors.count()
    return {"status": "complete_with_errors" if bad else "complete", "processed_episodes": sums["e"], "processed_frames": sums["n"] or 0, "error_episodes": bad, "successful_episodes": sums["e"] - bad}


def _finish(spark: SparkSession, output: str, errors: DataFrame, summary: dict) -> dict:
    sinks.write_json(errors, f"{output}/errors.json", "ep")
    sinks.write_note(spark, f"{output}/summary", summary)
    return summary


def action_rows(found: DataFrame) -> DataFrame:
    """ep, hand, start_action_row, end_action_row_exclusive, code, reasons, external: runs of marked action rows; ``external`` where the last one aims beyond the last frame."""
    w = I.over(outliers.KEYS, "pt")
    aim = F.coalesce(F.lead("code").over(w), F.col("code"))
    beyond = F.coalesce(F.lead("external").over(w), F.lit(False))
    rows = found.withColumn("aimed", aim).withColumn("beyond", beyond).filter("NOT external AND aimed <> 0")
    runs = I.runs(rows, outliers.KEYS, "pt", F.bit_or("aimed").alias("code"), F.max("beyond").alias("includes_external_terminal_target"))
    return runs.select(*outliers.KEYS, F.col("start").alias("start_action_row"), F.col("end").alias("end_action_row_exclusive"), "code", outliers.bit_names(F.col("code"), BITS).alias("reasons"), "includes_external_terminal_target")


def episode_records(found: DataFrame) -> DataFrame:
    """A record for each episode: for each hand its intervals, action rows, thresholds and reason counts. Lists are bounded by one episode."""
    spans = outliers.anomaly_intervals(found).withColumn("reasons", outliers.bit_names(F.col("code"), BITS))
    listed = spans.groupBy(*outliers.KEYS).agg(F.array_sort(F.collect_list(F.struct("start", "end", "code", "reasons", "peak_position_step", "peak_rotation_step"))).alias("state_intervals"))
    rows = action_rows(found).groupBy(*outliers.KEYS).agg(F.array_sort(F.collect_list(F.struct("start_action_row", "end_action_row_exclusive", "code", "reasons", "includes_external_terminal_target"))).alias("action_row_intervals"))
    state = found.filter("NOT external")
    counts = [F.struct(F.lit(n).alias("reason"), F.count_if(F.col("code").bitwiseAND(b) != 0).alias("frames")) for b, n in BITS.items()]
    sums = state.groupBy(*outliers.KEYS).agg(F.count_if(F.col("code") != 0).alias("state_suspect_frames"), F.max("pos_threshold").alias("position_threshold"), F.max("rot_threshold").alias("rotation_threshold"), F.array(*counts).alias("state_reason_counts"))
    hands = sums.join(listed, outliers.KEYS, "left").join(rows, outliers.KEYS, "left")
    names = [c for c in hands.columns if c != "ep"]
    return hands.groupBy("ep").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("hands"))


def anomalies(spark: SparkSession, root: str, output: str, s: Settings = Settings(), sample: int | None = None, seed: int = 0) -> dict:
    """Sparse labels, affected episodes, suspect intervals and action rows, and a record for each episode."""
    rows, episodes, errors = sound(spark, root, sample, seed)
    found = written(outliers.detected(outliers.points(I.dealt(frames.wide(rows), "ep")), s), "points")
    labels = reports.sparse_labels(found)
    labels.write.option("compression", "zstd").mode("overwrite").parquet(f"{output}/labels")
    affected = reports.affected_episodes(found)
    paths = episodes.select("ep", F.col("n").alias("frames"), F.col("data_path").alias("label_data_path"), F.col("camera_reference_path").alias("video_path"))
    sinks.write_csv(affected.join(paths, "ep"), f"{output}/affected_episodes.csv", "ep")
    spans = outliers.anomaly_intervals(found)
    mapping = f"{root}/meta/episode_source_map.jsonl"
    if sinks.exists(spark, mapping):
        spans = sinks.anomaly_report(spans, frames.read_source_map(spark, mapping), BITS)
        sinks.write_csv(spans, f"{output}/suspect_intervals.csv", "episode_index", "hand", "start_frame")
    else:
        sinks.write_csv(spans.withColumn("reasons", outliers.bit_names(F.col("code"), BITS)), f"{output}/suspect_intervals.csv", "ep", "hand", "start")
    sinks.write_csv(action_rows(found), f"{output}/suspect_action_rows.csv", *outliers.KEYS, "start_action_row")
    sinks.write_json(episode_records(found).join(affected, "ep"), f"{output}/episodes.json", "ep")
    totals = affected.agg(F.count(F.lit(1)).alias("e"), F.sum("state_suspect_frames").alias("s"), F.sum("action_suspect_rows").alias("a")).first()
    summary = _counts(episodes, errors) | {"affected_episodes": totals["e"], "state_suspect_frames": totals["s"] or 0, "action_suspect_rows": totals["a"] or 0, "sparse_rows": labels.count()}
    return _finish(spark, output, errors, summary | {"suspect_video_seconds": summary["state_suspect_frames"] / s.fps})


def _seen(rows: DataFrame) -> DataFrame:
    """Frames as the rules read them, without repair: no frame is rejected before."""
    return I.dealt(frames.wide(rows), "ep").withColumn("s1", F.lit(False))


def edges(spark: SparkSession, root: str, output: str, s: Settings = Settings(), sample: int | None = None, seed: int = 0) -> dict:
    """Videos and segments in which both hands are at the image border or outside."""
    rows, episodes, errors = sound(spark, root, sample, seed, scanner=False)
    checks.require(checks.camera_failures(episodes))
    judged = written(rules.hands_at_edge(_seen(rows), s), "edges")
    paths = episodes.select("ep", F.col("camera_reference_path").alias("video_path"), F.round(F.col("n") / float(s.fps), 6).alias("video_duration_seconds"))
    videos, parts = reports.edge_videos(judged, s), rules.edge_segments(judged)
    sinks.write_csv(videos.join(paths, "ep"), f"{output}/bad_videos.csv", "ep")
    clock = [F.round(F.col(c) / float(s.fps), 6).alias(f"{c}_time_seconds") for c in ("start", "end")]
    sinks.write_csv(parts.select("*", *clock).join(paths, "ep"), f"{output}/bad_segments.csv", "ep", "start")
    nested = parts.groupBy("ep").agg(F.array_sort(F.collect_list(F.struct("start", "end", *[c for c in parts.columns if c not in ("ep", "start", "end")]))).alias("bad_intervals"))
    sinks.write_json(videos.join(paths, "ep").join(nested, "ep"), f"{output}/bad_videos.json", "ep")
    sums = videos.agg(F.count(F.lit(1)).alias("v"), F.sum("bad_segments").alias("g"), F.sum("bad_frames").alias("f")).first()
    return _finish(spark, output, errors, _counts(episodes, errors) | {"bad_videos": sums["v"], "bad_segments": sums["g"] or 0, "bad_frames": sums["f"] or 0})


def cameras(spark: SparkSession, root: str, output: str, s: Settings = Settings(), sample: int | None = None, seed: int = 0) -> dict:
    """Videos, segments and windows in which the camera moves or turns far, by kind."""
    rows, episodes, errors = sound(spark, root, sample, seed, scanner=False)
    whole = _seen(rows).withColumn("keep", F.lit(True)).withColumn("seg", F.lit(0))
    judged = written(rules.camera_motion(whole, s), "motion")
    paths = episodes.select("ep", F.col("camera_reference_path").alias("video_path"), F.round(F.col("n") / float(s.fps), 6).alias("video_duration_seconds"))
    videos, parts = reports.camera_videos(judged, s).join(paths, "ep"), reports.camera_segments(judged, s).join(paths, "ep")
    sinks.write_csv(videos, f"{output}/motion_videos.csv", "ep")
    for kind in reports.KINDS:
        sinks.write_csv(videos.filter(F.col(f"{kind}_segments") > 0), f"{output}/{kind}_videos.csv", "ep")
        sinks.write_csv(parts.filter(F.col("kind") == kind), f"{output}/{kind}_segments.csv", "ep", "segment")
    windows = reports.camera_windows(judged, s)
    sinks.write_csv(windows.join(paths, "ep"), f"{output}/motion_windows.csv", "ep", "kind", "start")
    nested = parts.groupBy("ep").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end", "hits", "max_distance", "max_angle"))).alias("intervals"))
    sinks.write_json(videos.join(nested, "ep"), f"{output}/motion_videos.json", "ep")
    sums = videos.agg(F.count(F.lit(1)).alias("v"), *[F.sum(f"{k}_segments").alias(k) for k in reports.KINDS], F.count_if(F.expr("translation_segments > 0 AND rotation_segments > 0")).alias("both")).first()
    evaluated = episodes.agg(F.sum(F.greatest(F.col("n") - s.s3_gap, F.lit(0))).alias("w")).first()["w"] or 0
    return _finish(spark, output, errors, _counts(episodes, errors) | {"hit_videos": sums["v"], "both_type_videos": sums["both"], "evaluated_windows": evaluated, **{f"{k}_segments": sums[k] or 0 for k in reports.KINDS}})
