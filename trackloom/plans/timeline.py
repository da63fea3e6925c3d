"""From rule masks to a partition of each episode: who rejects a frame, all that matched it, and the accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import REASONS, Settings
from ..operators import intervals as I
from ..operators import outliers, repair, rules


def judged(wide: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Frames with every rule's columns, and code and reason of the first rule in the order S1, S2, S4, S3.

    wide: ep, f, n, rot, centre, k, lens, width, height and for each hand p, r6, ap, ar6.
    """
    cam = ["rot", "centre", "k", "lens", "width", "height"]
    frames = I.dealt(wide, "ep")
    fixed = repair.per_frame(repair.repaired(outliers.detected(outliers.points(frames), s), s))
    return attributed(rules_on(fixed.join(frames.select("ep", "f", *cam), ["ep", "f"]), s))


def measured(frames: DataFrame, s: Settings) -> DataFrame:
    """S2, S4 and the camera's motion: all that the thresholds of S3, and whether it runs, leave as it is."""
    return rules.stable_carry(_camera_measured(frames, s), s)


def _camera_measured(frames: DataFrame, s: Settings) -> DataFrame:
    return rules.camera_steps(rules.segmented(rules.hands_at_edge(frames, s)), s)


def rules_on(frames: DataFrame, s: Settings) -> DataFrame:
    """All rules; S4, which no rule waits for, comes last, so the windows of S3 keep the order that S2 and S3 have."""
    return rules.stable_carry(rules.camera_hits(_camera_measured(frames, s), s), s)


def attributed(frames: DataFrame) -> DataFrame:
    """Adds code (0 keep, else the stage) and reason (stage, or stage and its bits)."""
    code = F.when(F.col("s1"), 1).when(F.col("s2"), 2).when(F.col("s4") > 0, 4).when(F.col("s3") > 0, 3).otherwise(0)
    out = frames.withColumn("code", code)
    return out.withColumn("reason", F.when(F.col("code") == 4, 40 + F.col("s4")).when(F.col("code") == 3, 30 + F.col("s3")).otherwise(F.col("code")))


def timeline(frames: DataFrame) -> DataFrame:
    """ep, start, end, code, reason, s3, s4, matches: the gap-free pieces of each episode; matches lists every rule's reason."""
    watched = ["code", "reason", "s3", "s4"]
    pieces = I.change_points(frames, ["ep"], watched)
    out = pieces.groupBy("ep", "piece").agg(F.min("f").alias("start"), (F.max("f") + 1).alias("end"), *[F.first(c).alias(c) for c in watched])
    both = F.array(F.when(F.col("s4") > 0, 40 + F.col("s4")), F.when(F.col("s3") > 0, 30 + F.col("s3")))
    matches = F.when(F.col("code").isin(1, 2), F.array("code")).otherwise(F.filter(both, lambda x: x.isNotNull()))
    return out.withColumn("matches", matches).drop("piece")


def stage_of(reason: Column) -> Column:
    return F.when(reason < 10, reason).otherwise(F.floor(reason / 10)).cast("int")


def reason_name(reason: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])[reason]


def stage_accounts(frames: DataFrame, skip_s3: bool = False) -> DataFrame:
    """ep, stage and frames: input, matched, removed, overlap, kept; and matched and removed intervals.

    S3 and S4 both see the frames that S1 and S2 leave; overlap is what a stage matched and another took first.
    """
    order = [("S1", F.lit(True), F.col("s1"), 1), ("S2", ~F.col("s1"), F.col("s2"), 2), ("S4", F.col("keep"), F.col("s4") > 0, 4)]
    if not skip_s3:
        order.append(("S3", F.col("keep") & (F.col("s4") == 0), F.col("s3") > 0, 3))
    listed = F.array(*[F.struct(F.lit(n).alias("stage"), have.alias("have"), hit.alias("matched"), (F.col("code") == c).alias("removed")) for n, have, hit, c in order])
    rows = frames.select("ep", "f", F.inline(listed))
    for name in ("matched", "removed"):
        before = F.lag(name).over(I.over(["ep", "stage"], "f"))
        rows = rows.withColumn(f"{name}_new", F.col(name) & ~F.coalesce(before, F.lit(False)))
    count = lambda c: F.sum(c.cast("long"))
    return rows.groupBy("ep", "stage").agg(
        count(F.col("have")).alias("input_frames"), count(F.col("matched")).alias("matched_frames"), count(F.col("removed")).alias("removed_frames"),
        count(F.col("matched") & ~F.col("removed")).alias("overlap_frames"), count(F.col("have") & ~F.col("removed")).alias("kept_frames"),
        count(F.col("matched_new")).alias("matched_intervals"), count(F.col("removed_new")).alias("removed_intervals"),
    )


def reason_accounts(pieces: DataFrame) -> DataFrame:
    """reason, name, exclusive_frames (as first rule) and matched_frames (as any) over all episodes."""
    length = F.col("end") - F.col("start")
    first = pieces.filter("code > 0").select("reason", length.alias("exclusive"), F.lit(0).cast("long").alias("matched"))
    every = pieces.select(F.explode("matches").alias("reason"), F.lit(0).cast("long").alias("exclusive"), length.alias("matched"))
    out = first.unionByName(every).groupBy("reason").agg(F.sum("exclusive").alias("exclusive_frames"), F.sum("matched").alias("matched_frames"))
    return out.withColumn("name", reason_name(F.col("reason")))


def episode_summary(frames: DataFrame, fps: int = 30) -> DataFrame:
    """ep, source_frames, rejected_frames, accepted_frames, duration_seconds, removed_share."""
    out = frames.groupBy("ep").agg(F.count(F.lit(1)).alias("source_frames"), F.sum((F.col("code") > 0).cast("long")).alias("rejected_frames"))
    out = out.withColumn("accepted_frames", F.col("source_frames") - F.col("rejected_frames")).withColumn("duration_seconds", F.col("source_frames") / F.lit(float(fps)))
    return out.withColumn("removed_share", F.col("rejected_frames") / F.col("source_frames"))


def conservation_errors(pieces: DataFrame, lengths: DataFrame) -> DataFrame:
    """Pieces or episodes that break the partition: a first start other than 0, a gap or overlap, or an end short of the length."""
    w = I.over(["ep"], "start")
    checked = pieces.withColumn("before", F.coalesce(F.lag("end").over(w), F.lit(0))).withColumn("after", F.lead("start").over(w))
    joined = checked.join(lengths.select("ep", "n"), "ep", "full_outer")
    wrong = (F.col("start") != F.col("before")) | (F.col("end") <= F.col("start")) | (F.col("after").isNull() & (F.col("end") != F.col("n"))) | F.col("n").isNull() | F.col("start").isNull()
    return joined.filter(wrong)


def unbalanced(accounts: DataFrame, lengths: DataFrame) -> DataFrame:
    """ep, stage, problem of stage accounts that do not add up: a stage must split its input, match what it removes or leaves to another, and

    begin with what the stage before it kept, the first one with the whole episode; the order is S1, S2, S4, S3. Episodes
    without accounts, and accounts without an episode, are problems too.
    """
    place = F.array_position(F.array(*map(F.lit, ("S1", "S2", "S4", "S3"))), F.col("stage"))
    rows = accounts.join(lengths.select("ep", "n"), "ep", "full_outer").withColumn("__place", place)
    before = F.when(F.col("__place") == 1, F.col("n")).otherwise(F.lag("kept_frames").over(I.over(["ep"], "__place")))
    problem = (
        F.when(F.col("n").isNull(), "no episode").when(F.col("stage").isNull(), "no account")
        .when(F.col("removed_frames") + F.col("kept_frames") != F.col("input_frames"), "input")
        .when(F.col("removed_frames") + F.col("overlap_frames") != F.col("matched_frames"), "matches")
        .when(~F.col("input_frames").eqNullSafe(before), "order")
    )
    return rows.select("ep", "stage", problem.alias("problem")).filter("problem IS NOT NULL")
