"""Reports of the single rules: camera segments and videos, edge videos, affected episodes and sparse labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..operators import intervals as I
from ..operators import outliers

KINDS = {"translation": ("s3_t", "s3_distance"), "rotation": ("s3_r", "s3_angle")}


def _clock(frame: Column, fps: int) -> Column:
    return F.round(frame / F.lit(float(fps)), 6)


def camera_segments(frames: DataFrame, s: Settings = Settings()) -> DataFrame:
    """ep, kind, segment, start, end, clip_end, seconds, hits, greatest distance and angle, and the peak window (the first greatest).

    Hits at most a window apart are one segment; ``end`` is the last window's last frame.
    """
    out = None
    for kind, (flag, value) in KINDS.items():
        near = I.near_groups(frames.filter(flag), ["ep"], s.s3_gap)
        peak = F.min_by("f", F.struct(-F.col(value), F.col("f")))
        one = near.groupBy("ep", "segment").agg(
            F.min("f").alias("start"), (F.max("f") + s.s3_gap).alias("end"), F.count(F.lit(1)).alias("hits"), F.max("s3_distance").alias("max_distance"), F.max("s3_angle").alias("max_angle"), peak.alias("peak_start"),
        )
        one = one.withColumn("kind", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    out = out.withColumn("clip_end", F.col("end") + 1).withColumn("peak_end", F.col("peak_start") + s.s3_gap)
    return out.withColumn("start_seconds", _clock(F.col("start"), s.fps)).withColumn("end_seconds", _clock(F.col("end"), s.fps)).withColumn("duration_seconds", _clock(F.col("end") - F.col("start"), s.fps))


def camera_windows(frames: DataFrame, s: Settings = Settings()) -> DataFrame:
    """ep, kind, start, end, distance, angle of every hit window."""
    rows = [frames.filter(flag).select("ep", F.lit(kind).alias("kind"), F.col("f").alias("start"), (F.col("f") + s.s3_gap).alias("end"), F.col("s3_distance").alias("distance"), F.col("s3_angle").alias("angle")) for kind, (flag, _) in KINDS.items()]
    return rows[0].unionByName(rows[1])


def camera_coverage(frames: DataFrame, s: Settings = Settings()) -> DataFrame:
    """ep and how many intervals between frames hits cover: of each kind, in common, together; and the hit windows.

    Coverage leaves out each window's last frame, as it counts intervals between frames.
    """
    rows = frames
    for kind, (flag, _) in KINDS.items():
        rows = rows.withColumn(f"c_{kind}", I.spread_back(["ep"], F.col(flag), s.s3_gap - 1))
    count = {"translation_hits": "s3_t", "rotation_hits": "s3_r", "both_hits": "s3_t AND s3_r", "translation_covered": "c_translation", "rotation_covered": "c_rotation", "overlap_covered": "c_translation AND c_rotation", "union_covered": "c_translation OR c_rotation"}
    return rows.groupBy("ep").agg(*[F.count_if(F.expr(c)).alias(n) for n, c in count.items()])


def camera_videos(frames: DataFrame, s: Settings = Settings()) -> DataFrame:
    """A row for each episode with hits: hit windows and covered seconds by kind, the episode's greatest motion, its segments."""
    segments = camera_segments(frames, s).groupBy("ep").agg(*[F.count_if(F.col("kind") == k).alias(f"{k}_segments") for k in KINDS])
    peaks = frames.groupBy("ep").agg(F.max("s3_distance").alias("max_distance"), F.max("s3_angle").alias("max_angle"))
    covered = camera_coverage(frames, s)
    seconds = [_clock(F.col(f"{k}_covered"), s.fps).alias(f"{k}_seconds") for k in (*KINDS, "overlap", "union")]
    return segments.join(covered, "ep").join(peaks, "ep").select("ep", *[f"{k}_segments" for k in KINDS], *[f"{k}_hits" for k in KINDS], "max_distance", "max_angle", *seconds)


def edge_videos(frames: DataFrame, s: Settings = Settings()) -> DataFrame:
    """A row for each episode with bad segments: how many, bad frames, seconds and share."""
    new = F.col("s2") & ~F.coalesce(F.lag("s2").over(I.over(["ep"], "f")), F.lit(False))
    sums = frames.withColumn("__new", new).groupBy("ep").agg(F.count(F.lit(1)).alias("frames"), F.count_if("s2").alias("bad_frames"), F.count_if("__new").alias("bad_segments"))
    return sums.filter("bad_segments > 0").select("ep", "bad_segments", "bad_frames", _clock(F.col("bad_frames"), s.fps).alias("bad_seconds"), F.round(F.col("bad_frames") / F.col("frames"), 6).alias("bad_share"))


def sparse_labels(points: DataFrame) -> DataFrame:
    """ep, f and state and action codes of both hands, for marked rows alone."""
    codes = outliers.action_codes(points).filter("state_code <> 0 OR action_code <> 0")
    picks = [F.coalesce(F.max(F.when(F.col("hand") == h, F.col(c))), F.lit(0)).alias(f"{h}_{c}") for h in outliers.HANDS for c in ("state_code", "action_code")]
    return codes.groupBy("ep", "f").agg(*picks)


def affected_episodes(points: DataFrame) -> DataFrame:
    """ep, state_suspect_frames, action_suspect_rows, intervals of each episode with a marked row."""
    marked = sparse_labels(points).groupBy("ep").agg(F.count_if(F.expr("l_state_code + r_state_code > 0")).alias("state_suspect_frames"), F.count_if(F.expr("l_action_code + r_action_code > 0")).alias("action_suspect_rows"))
    new = (F.col("code") > 0) & (F.coalesce(F.lag("code").over(I.over(outliers.KEYS, "pt")), F.lit(0)) == 0)
    runs = points.withColumn("__new", new).groupBy("ep").agg(F.count_if("__new").alias("intervals"))
    return marked.join(runs, "ep")


def sampled(episodes: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` episodes chosen by a seeded hash of their number: the same at every run and partitioning."""
    return episodes.orderBy(F.xxhash64("ep", F.lit(seed)), "ep").limit(n)


def selected(episodes: DataFrame, ids: list[int]) -> DataFrame:
    """The episodes with these numbers; numbers that do not exist raise."""
    wanted = episodes.sparkSession.createDataFrame([(int(i),) for i in set(ids)], "ep long")
    missing = wanted.join(episodes, "ep", "left_anti")
    if not missing.isEmpty():
        raise ValueError("no such episodes: " + ", ".join(str(r.ep) for r in missing.orderBy("ep").collect()))
    return episodes.join(wanted, "ep", "left_semi")
