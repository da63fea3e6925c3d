"""Clip plans: one clip for each kept interval, cut at keyframes where it can be copied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.intervals import merged, over, running


def keep_intervals(pieces: DataFrame) -> DataFrame:
    """ep, start, end: kept pieces, adjacent ones as one."""
    return merged(pieces.filter("code = 0").select("ep", "start", "end"), ["ep"])


def cut_plan(pieces: DataFrame, lengths: DataFrame) -> DataFrame:
    """ep, clip (from 0), start, end, frames, trainable_rows (one less, as the last row has no next state), whole."""
    kept = keep_intervals(pieces).withColumn("clip", F.row_number().over(over(["ep"], "start")) - 1)
    out = kept.join(lengths.select("ep", "n"), "ep")
    return out.select("ep", "clip", "start", "end", (F.col("end") - F.col("start")).alias("frames"), (F.col("end") - F.col("start") - 1).alias("trainable_rows"), ((F.col("start") == 0) & (F.col("end") == F.col("n"))).alias("whole"))


def keyframe_bounds(clips: DataFrame, keyframes: DataFrame) -> DataFrame:
    """clips (ep, view, clip, start, end, ...) with before_start, next_start, previous_end: the nearest keyframes (ep, view, kf).

    As-of both ways by running values over the clips' borders and keyframes together: one exchange, and no pairs.
    """
    keys = ["ep", "view"]
    starts = clips.select(*keys, "clip", F.col("start").alias("at"), F.lit(1).alias("side"))
    ends = clips.select(*keys, "clip", F.col("end").alias("at"), F.lit(2).alias("side"))
    marks = keyframes.select(*keys, F.lit(None).cast(clips.schema["clip"].dataType).alias("clip"), F.col("kf").alias("at"), F.lit(0).alias("side"))
    every = marks.unionByName(starts).unionByName(ends)
    kf = F.when(F.col("side") == 0, F.col("at"))
    last = F.last(kf, ignorenulls=True).over(running(keys, "at", "side"))
    following = F.last(kf, ignorenulls=True).over(running(keys, F.desc("at"), F.col("side")))
    found = every.withColumn("at_or_before", last).withColumn("at_or_after", following).filter("side > 0")
    sides = found.groupBy(*keys, "clip").agg(
        F.max(F.when(F.col("side") == 1, F.col("at_or_before"))).alias("before_start"), F.max(F.when(F.col("side") == 1, F.col("at_or_after"))).alias("next_start"),
        F.max(F.when(F.col("side") == 2, F.col("at_or_before"))).alias("previous_end"),
    )
    return clips.join(sides, [*keys, "clip"])


def gop_split(clips: DataFrame, keyframes: DataFrame) -> DataFrame:
    """Adds middle_start, middle_end (whole groups of pictures that can be copied), head and tail frames to encode, and method."""
    out = keyframe_bounds(clips, keyframes)
    out = out.withColumn("middle_start", F.greatest("start", F.coalesce("next_start", "end"))).withColumn("middle_end", F.least("end", F.coalesce("previous_end", F.lit(0).cast("long"))))
    some = F.col("middle_start") < F.col("middle_end")
    out = out.withColumn("head", F.when(some, F.col("middle_start") - F.col("start")).otherwise(F.col("end") - F.col("start")))
    out = out.withColumn("tail", F.when(some, F.col("end") - F.col("middle_end")).otherwise(F.lit(0)))
    method = F.when(F.col("whole"), "original_reference").when(~some, "full_reencode_fallback").when((F.col("head") == 0) & (F.col("tail") == 0), "gop_copy").otherwise("gop_copy_boundary_encode")
    return out.withColumn("method", method)


def plan_summary(split: DataFrame) -> DataFrame:
    """method, clips, new_files, kept_frames, trainable_rows, encoded_frames."""
    return split.groupBy("method").agg(
        F.count(F.lit(1)).alias("clips"), F.sum(F.when(F.col("whole"), 0).otherwise(1)).alias("new_files"), F.sum("frames").alias("kept_frames"),
        F.sum("trainable_rows").alias("trainable_rows"), F.sum(F.when(F.col("whole"), 0).otherwise(F.col("head") + F.col("tail"))).alias("encoded_frames"),
    )


def packet_frame(pts: Column, numerator: int, denominator: int | Column, fps: int = 30) -> Column:
    """Frame index of a packet at exactly a frame's time (to 1/1000 of a frame), else null; whole-number arithmetic only."""
    scaled, below = pts * F.lit(numerator * fps), denominator if isinstance(denominator, Column) else F.lit(denominator)
    index = F.floor((2 * scaled + below) / (2 * below)).cast("long")
    return F.when(F.abs(scaled - index * below) * 1000 <= below, index)


def checked_timeline(pieces: DataFrame, episodes: DataFrame) -> DataFrame:
    """What keeps a plan from being made: ep, problem. pieces: ep, start, end, status; episodes: ep, n, rejected_frames, accepted_frames."""
    w = over(["ep"], "start")
    rows = pieces.withColumn("before", F.coalesce(F.lag("end").over(w), F.lit(0)))
    bad = rows.select("ep", F.when(~F.col("status").isin("keep", "reject"), "status").when(F.col("end") <= F.col("start"), "empty").when(F.col("start") != F.col("before"), "gap or overlap").alias("problem")).filter("problem IS NOT NULL")
    length = F.col("end") - F.col("start")
    sums = pieces.groupBy("ep").agg(F.max("end").alias("last"), F.sum(F.when(F.col("status") == "reject", length).otherwise(0)).alias("rejected"))
    both = episodes.join(sums, "ep", "full_outer")
    totals = F.when(F.col("n").isNull() | F.col("last").isNull(), "missing").when(F.col("last") != F.col("n"), "length").when(F.col("rejected") != F.col("rejected_frames"), "rejected total").when(F.col("rejected_frames") + F.col("accepted_frames") != F.col("n"), "frame total")
    return bad.unionByName(both.select("ep", totals.alias("problem")).filter("problem IS NOT NULL")).distinct()
