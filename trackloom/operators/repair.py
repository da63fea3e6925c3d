"""S1 repair: short inner gaps are interpolated, position linearly and rotation along the great arc."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import geometry as G
from .intervals import over
from .outliers import HANDS, KEYS


def repaired(found: DataFrame, s: Settings) -> DataFrame:
    """The detected points with gap_start, gap_end, repaired, ok (valid after repair), p2 and r62.

    A run of marked points stays unresolved when it touches the first or last point or is longer than ``max_gap``.
    Unmarked values come through untouched.
    """
    lo, hi, marked = F.col("lo"), F.col("hi"), F.col("code") != 0
    rows = found.withColumn("gap_start", F.when(marked, F.coalesce(lo[0].cast("long") + 1, F.lit(0)))).withColumn("gap_end", F.when(marked, F.coalesce(hi[0].cast("long"), F.col("points"))))
    short = marked & lo.isNotNull() & hi.isNotNull() & (F.col("gap_end") - F.col("gap_start") <= s.max_gap)
    rows = rows.withColumn("repaired", F.coalesce(short, F.lit(False))).withColumn("ok", ~marked | F.col("repaired"))
    rows = rows.withColumn("__a", F.when(F.col("repaired"), (F.col("pt") - lo[0]) / (hi[0] - lo[0])))
    a = F.col("__a")
    line = F.when(a.isNotNull(), F.array(*[(1 - a) * lo[1 + i] + a * hi[1 + i] for i in range(3)]))
    rows = rows.withColumn("__line", line).withColumn("__from", F.when(a.isNotNull(), F.slice(lo, 5, 9))).withColumn("__to", F.when(a.isNotNull(), F.slice(hi, 5, 9)))
    out = G.slerp(rows.drop("lo", "hi", "points"), "__from", "__to", "__a", "__mid")
    kinds = {n: found.schema[n].dataType for n in ("p", "r6")}
    out = out.withColumn("p2", F.when(F.col("repaired"), F.col("__line").cast(kinds["p"])).otherwise(F.col("p")))
    out = out.withColumn("r62", F.when(F.col("repaired"), F.slice("__mid", 1, 6).cast(kinds["r6"])).otherwise(F.col("r6")))
    return out.drop("__a", "__from", "__to", "__line", "__mid")


def per_frame(fixed: DataFrame, positions_only: bool = False) -> DataFrame:
    """ep, f and, for each hand: p, r6, code, valid, repaired, and the same of its action row; ``s1`` marks rejected frames.

    An action row takes the point it aims at. A bad target beyond the last frame rejects the last frame. Every frame has a
    point of each hand, so in the order of points and hands a left point is followed by the right one and then by the
    left and right ones that they aim at: three leads in one pass, with no grouping. A last point without a target aims at itself.
    With ``positions_only`` rotations and the poses of actions, which no rule reads, are neither carried nor returned.
    """
    w, marks = over(["ep"], "pt", "hand"), ["hand", "code", "ok", "repaired", "external"]
    poses = {i: [] if positions_only and i > 1 else ["p2"] if positions_only else ["p2", "r62"] for i in range(4)}
    point = {i: F.struct(*marks, *poses[i]) for i in range(4)}
    rows = fixed.select("ep", "pt", "n", "hand", "external", point[0].alias("l"), *[F.lead(point[i], i).over(w).alias(f"__{i}") for i in (1, 2, 3)])
    rows = rows.filter((F.col("hand") == "l") & ~F.col("external")).withColumnRenamed("__1", "r")
    two, three = F.col("__2"), F.col("__3")
    own = {h: F.struct(*[F.col(f"{h}.{c}") for c in (*marks, *poses[2])]) for h in HANDS}
    rows = rows.withColumn("l_aim", F.when(two.hand == "l", two).otherwise(own["l"]))
    rows = rows.withColumn("r_aim", F.when(three.hand == "r", three).when(two.hand == "r", two).otherwise(own["r"]))
    picks = []
    for h in HANDS:
        picks += [F.col(f"{h}.{source}").alias(f"{h}_{name}") for name, source in (("p", "p2"), ("r6", "r62"), ("code", "code"), ("valid", "ok"), ("repaired", "repaired")) if source in (*marks, *poses[0])]
        picks += [F.col(f"{h}_aim.{source}").alias(f"{h}_{name}") for name, source in (("ap", "p2"), ("ar6", "r62"), ("acode", "code"), ("avalid", "ok"), ("arepaired", "repaired"), ("beyond", "external")) if source in (*marks, *poses[2])]
    wide = rows.select("ep", F.col("pt").alias("f"), "n", *picks)
    lost = [(F.col(f"{h}_beyond") & ~F.col(f"{h}_avalid")) for h in HANDS]
    return wide.withColumn("s1", ~F.col("l_valid") | ~F.col("r_valid") | lost[0] | lost[1])


def gaps(fixed: DataFrame) -> DataFrame:
    """ep, hand, start, end, frames, code, repaired of each run of marked points."""
    return fixed.filter("code <> 0").groupBy(*KEYS, F.col("gap_start").alias("start"), F.col("gap_end").alias("end")).agg(F.count(F.lit(1)).alias("frames"), F.bit_or("code").alias("code"), F.first("repaired").alias("repaired"))


def repair_counts(frames: DataFrame, fixed: DataFrame) -> DataFrame:
    """ep and the repair counts of each episode."""
    def both(name: str, negate: bool = False):
        return F.sum(sum((F.when(F.col(f"{h}_{name}") != F.lit(negate), 1).otherwise(0) for h in HANDS), F.lit(0)))

    counts = frames.groupBy("ep").agg(
        both("repaired").alias("repaired_hand_frames"), both("valid", True).alias("unresolved_hand_frames"),
        both("arepaired").alias("repaired_action_hand_rows"), both("avalid", True).alias("unresolved_action_hand_rows"), F.sum(F.col("s1").cast("int")).alias("rejected_frames"),
    )
    left = gaps(fixed).groupBy("ep").agg(F.sum(F.when(F.col("repaired"), 0).otherwise(1)).alias("unresolved_hand_intervals"))
    return counts.join(left, "ep", "left").fillna(0, ["unresolved_hand_intervals"])
