"""Clips from a finished annotation: its CSV files are checked, read again and planned by view and segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks, videos
from ..sources.frames import VIEWS
from . import cutplan, reports

TIMELINE = "source_episode_index long, start_frame long, end_frame_exclusive long, start_seconds double, end_seconds double, duration_seconds double, status string, stage string, reason string, camera_reference_mp4_start_seconds double, camera_reference_mp4_end_seconds double, camera_aux_0_mp4_start_seconds double, camera_aux_0_mp4_end_seconds double, matched_stages string, matched_reasons string"
EPISODES = "source_episode_index long, source_frames long, duration_seconds double, repaired_label_path string, " + ", ".join(f"{v}_path string, {v}_from double, {v}_to double" for v in VIEWS) + ", rejected_frames long, accepted_frames long"


def read_annotation(spark: SparkSession, annotation: str) -> tuple[DataFrame, DataFrame, dict]:
    """(pieces, episodes, summary) of a complete annotation whose files are those that it was finished with."""
    done = sinks.read_note(spark, f"{annotation}/complete")
    if not done:
        raise ValueError(f"{annotation} is not complete")
    for name, digest in done["digests"].items():
        if sinks.digest(spark.read.option("header", True).csv(f"{annotation}/{name}")) != digest:
            raise ValueError(f"{annotation}/{name} has changed since it was written")
    lines = sinks.read_csv(spark, f"{annotation}/timeline.csv", TIMELINE)
    pieces = lines.select(F.col("source_episode_index").alias("ep"), F.col("start_frame").alias("start"), F.col("end_frame_exclusive").alias("end"), "status", F.when(F.col("status") == "keep", 0).otherwise(1).alias("code"))
    episodes = sinks.read_csv(spark, f"{annotation}/episodes.csv", EPISODES).withColumnRenamed("source_episode_index", "ep").withColumn("n", F.col("source_frames"))
    return pieces, episodes, done["summary"]


def output_path(view: Column) -> Column:
    """Where the clip of a segment goes, below the output folder."""
    return F.format_string("videos/%s/chunk-%03d/episode-%06d-segment-%04d.mp4", view, F.floor(F.col("ep") / 1000), "ep", "clip")


def segments(pieces: DataFrame, episodes: DataFrame, keyframes: DataFrame | None = None) -> DataFrame:
    """A row for each kept interval and view: source and output video, frames, rows of the labels, and how it is cut where keyframes (ep, view, kf) are known."""
    clips = cutplan.cut_plan(pieces, episodes)
    sources = F.array(*[F.struct(F.lit(v).alias("view"), F.col(f"{v}_path").alias("source_path"), F.col(f"{v}_from").alias("source_from")) for v in VIEWS])
    rows = clips.join(episodes.select("ep", "repaired_label_path", F.inline(sources)), "ep")
    if keyframes is not None:
        rows = cutplan.gop_split(rows, keyframes)
    path = F.when(F.col("whole"), F.col("source_path")).otherwise(output_path(F.col("view")))
    rows = rows.withColumn("video_path", path).withColumn("source_start_seconds", F.col("source_from") + F.col("start") / 30.0)
    # Label rows of a clip, and the last one that still has a next state.
    return rows.withColumn("label_rows", F.struct("start", "end", (F.col("end") - 1).alias("trainable_end")))


def sources(clips: DataFrame, episodes: DataFrame) -> DataFrame:
    """ep, view, path, base, n of the videos that are cut; a video that begins between frames has no base."""
    listed = F.array(*[F.struct(F.lit(v).alias("view"), F.col(f"{v}_path").alias("path"), videos.frame_offset(F.col(f"{v}_from")).alias("base")) for v in VIEWS])
    return episodes.join(clips.filter("NOT whole").select("ep").distinct(), "ep", "left_semi").select("ep", "n", F.inline(listed)).select("ep", "view", "path", "base", "n")


def inspected(spark: SparkSession, root: str, wanted: DataFrame, path: str) -> DataFrame:
    """Keyframes (ep, view, kf) of the videos below ``root``, which are read once and kept at ``path``; one that cannot be cut raises."""
    videos.packets(spark, root).drop("digest", "offset", "size", "dts").write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    odd = wanted.filter("base IS NULL").select("ep", "view", F.lit("offset").alias("problem"))
    bad = odd.unionByName(videos.packet_failures(rows, wanted.filter("base IS NOT NULL"))).orderBy("ep", "view").limit(5).collect()
    if bad:
        raise ValueError("videos cannot be cut: " + "; ".join(f"episode {r.ep}, {r.view}: {r.problem}" for r in bad))
    return videos.keyframes(rows, wanted)


def copied(spark: SparkSession, rows: DataFrame, root: str, output: str) -> int:
    """Write the clips that are whole groups of pictures, and compare every sample with its source; how many there are."""
    base = F.round(F.col("source_from") * 30).cast("long")
    cuts = rows.filter("method = 'gop_copy'").select("source_path", "video_path", (base + F.col("start")).alias("first"), (base + F.col("end")).alias("last"))
    sinks.write_json(videos.copy_groups(cuts, root, output), f"{output}/copied.json", "video_path")
    n = spark.read.schema("video_path string, samples long, bytes long").json(f"{output}/copied.json").count()
    if n:
        bad = videos.cut_differences(spark, cuts, root, output).orderBy("video_path", "position").limit(5).collect()
        if bad:
            raise IOError("copied clips differ: " + "; ".join(f"{r.video_path} at {r.position}: {r.problem}" for r in bad))
    return n


def plan_summary(pieces: DataFrame, episodes: DataFrame) -> dict:
    clips = cutplan.cut_plan(pieces, episodes).agg(F.count(F.lit(1)).alias("segments"), F.sum("frames").alias("kept"), F.count_if("whole").alias("whole")).first()
    sums = episodes.agg(F.count(F.lit(1)).alias("e"), F.sum("n").alias("n")).first()
    n, kept = sums["n"] or 0, clips["kept"] or 0
    return {"source_episodes": sums["e"], "source_frames": n, "kept_frames": kept, "rejected_frames": n - kept, "segments": clips["segments"], "whole_source_references": clips["whole"], "new_video_files": len(VIEWS) * (clips["segments"] - clips["whole"])}


def run(spark: SparkSession, annotation: str, output: str, keyframes: DataFrame | None = None, ids: list[int] | None = None, first: int | None = None, video_root: str | None = None, copy: bool = False) -> dict:
    """Write segments.json and a summary below ``output``; a timeline that is no partition, or that misses an episode, raises.

    ids, first: some episodes alone; otherwise the totals must be those of the annotation. video_root: where the source
    paths begin; keyframes come from the videos themselves then. copy: write the clips that no encoder is needed for, and verify them.
    """
    if copy and video_root is None:
        raise ValueError("clips are copied from videos: give their root")
    own = {"annotation": annotation, "ids": sorted(ids) if ids else None, "first": first, "keyframes": keyframes is not None, "video_root": video_root, "copy": copy}
    done = sinks.read_note(spark, f"{output}/complete")
    if done:
        if done["run"] != own:
            raise ValueError(f"{output} holds a run with other settings")
        return done["summary"]
    pieces, episodes, before = read_annotation(spark, annotation)
    problems = cutplan.checked_timeline(pieces, episodes).limit(5).collect()
    if problems:
        raise ValueError("no plan can be made: " + "; ".join(f"episode {r.ep}: {r.problem}" for r in problems))
    if ids is not None:
        episodes = reports.selected(episodes, ids)
    if first is not None:
        episodes = episodes.orderBy("ep").limit(first)
    pieces = pieces.join(episodes.select("ep"), "ep", "left_semi")
    if video_root is not None:
        keyframes = inspected(spark, video_root, sources(cutplan.cut_plan(pieces, episodes), episodes), f"{output}/stages/packets")
    rows = segments(pieces, episodes, keyframes)
    sinks.write_json(rows, f"{output}/segments.json", "ep", "clip", "view")
    found = plan_summary(pieces, episodes)
    if ids is None and first is None and (found["kept_frames"] != before["accepted_frames"] or found["rejected_frames"] != before["rejected_frames"]):
        raise ValueError("clips and annotation differ in their totals")
    if keyframes is not None:
        found["methods"] = {r["method"]: {k: r[k] for k in ("clips", "new_files", "kept_frames", "encoded_frames")} for r in cutplan.plan_summary(rows).collect()}  # four methods
    if copy:
        found["copied_files"] = copied(spark, rows, video_root, output)
    sinks.write_note(spark, f"{output}/complete", {"run": own, "summary": found})
    sinks.remove(spark, f"{output}/stages")
    return found
