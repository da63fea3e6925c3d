"""S2, S3 and S4 on frames: ep, f, n, s1, rot (camera, nine elements), centre, l_p, r_p, k, lens, width, height.

All windows are partitioned by ep or by ep and more, so one exchange on ep serves every rule.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import geometry as G
from .intervals import apart, by_group, long_runs, numbers, over, running, runs, spread_back


def regions(frames: DataFrame, s: Settings) -> DataFrame:
    """Adds, for each hand, uv, behind, inside, safe: where the camera sees it."""
    return apart(frames, ["rot", "centre", "k", "lens", "width", "height", "l_p", "r_p"], lambda rows: _regions(rows, s))


def _regions(frames: DataFrame, s: Settings) -> DataFrame:
    # Both hands in each step, which copies the rows once.
    out = frames.withColumns({f"{h}_cam": G.in_camera(F.col("rot"), F.col("centre"), F.col(f"{h}_p")) for h in "lr"})
    for h in "lr":
        out = G.with_projection(out, f"{h}_cam", "k", "lens", f"{h}_uv")
    seen = {}
    for h in "lr":
        front = F.coalesce((F.col(f"{h}_cam")[2] > 1e-6) & ~F.isnan(F.col(f"{h}_cam")[2]), F.lit(False))
        inside, safe = G.image_region(F.col(f"{h}_uv"), front, F.col("width"), F.col("height"), s.edge_fraction)
        seen |= {f"{h}_behind": ~front, f"{h}_inside": F.coalesce(inside, F.lit(False)), f"{h}_safe": F.coalesce(safe, F.lit(False))}
    return out.withColumns(seen)


def hands_at_edge(frames: DataFrame, s: Settings) -> DataFrame:
    """Adds ``s2``: both hands outside the safe box for ``edge_frames`` or more consecutive frames that S1 kept."""
    seen = regions(frames, s).withColumn("__bad", ~F.col("s1") & ~F.col("l_safe") & ~F.col("r_safe"))
    return long_runs(seen, ["ep"], "__bad", s.edge_frames, "s2").drop("__bad")


def segmented(frames: DataFrame) -> DataFrame:
    """Adds keep (neither S1 nor S2) and ``seg``: one value for each stretch of kept frames."""
    def steps(rows: DataFrame) -> DataFrame:
        out = rows.withColumn("keep", ~F.col("s1") & ~F.col("s2"))
        return out.withColumn("seg", F.when(F.col("keep"), F.col("f") - F.sum(F.col("keep").cast("int")).over(running(["ep"], "f"))))

    return apart(frames, ["ep", "f", "s1", "s2"], steps)


SEGMENT = ["ep", "keep", "seg"]


def motion(frames: DataFrame, gap: int, prefix: str) -> DataFrame:
    """Adds the camera's distance and angle to ``gap`` frames on, within the segment; null where the window does not fit."""
    def steps(rows: DataFrame) -> DataFrame:
        ahead = F.lead(F.struct("centre", "rot"), gap).over(over(SEGMENT, "f"))
        out = rows.withColumn("__ahead", F.when(F.col("keep"), ahead))
        out = out.withColumn(f"{prefix}_distance", G.distance(F.col("centre"), F.col("__ahead.centre")))
        return G.with_angle(out, "rot", "__ahead.rot", f"{prefix}_angle").drop("__ahead")

    return apart(frames, [*SEGMENT, "f", "centre", "rot"], steps)


def camera_steps(frames: DataFrame, s: Settings) -> DataFrame:
    """Adds s3_distance and s3_angle, which no threshold of S3 changes."""
    return motion(frames, s.s3_gap, "s3")


def camera_motion(frames: DataFrame, s: Settings) -> DataFrame:
    """Adds the camera's steps and hits."""
    return camera_hits(camera_steps(frames, s), s)


def camera_hits(frames: DataFrame, s: Settings) -> DataFrame:
    """Adds s3_t and s3_r (hits), and ``s3``: bits 1 and 2 of the frames that hits cover."""
    return apart(frames, [*SEGMENT, "f", "s3_distance", "s3_angle"], lambda rows: _camera_hits(rows, s))


def _camera_hits(frames: DataFrame, s: Settings) -> DataFrame:
    out = frames.withColumn("s3_t", F.coalesce(F.col("s3_distance") > s.s3_translation, F.lit(False))).withColumn("s3_r", F.coalesce(F.col("s3_angle") > s.s3_rotation, F.lit(False)))
    if s.skip_s3:
        return out.withColumn("s3", F.lit(0))
    bits = [spread_back(SEGMENT, F.col(c), s.s3_gap).cast("int") for c in ("s3_t", "s3_r")]
    return out.withColumn("s3", F.when(F.col("keep"), bits[0] + 2 * bits[1]).otherwise(0))


def axis_cosines(frames: DataFrame) -> DataFrame:
    """Adds, for each hand, good and cos: the cosine to the optical axis, 0 where there is none."""
    out = frames
    for h in "lr":
        cam = F.col(f"{h}_cam")
        radius = G.norm(cam)
        out = out.withColumn(f"{h}_good", G.finite(cam, 3) & F.coalesce(radius > 1e-6, F.lit(False)) & ~F.col("s1"))
        out = out.withColumn(f"{h}_cos", F.when(F.col(f"{h}_good"), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(cam[2], radius)))).otherwise(0.0))
    return out


def _between(sorted_values: np.ndarray, share: float, gap: int) -> np.ndarray:
    """Linear interpolation between order statistics of the gap + 1 values, as quantiles are defined."""
    at = share * gap
    low = int(at)
    return sorted_values[:, low] + (sorted_values[:, min(low + 1, gap)] - sorted_values[:, low]) * (at - low)


def _spreads(cosines: np.ndarray, starts: np.ndarray, gap: int) -> np.ndarray:
    """The 95th less the 5th percentile of the windows that begin at ``starts``, some thousands at a time."""
    windows, parts = np.lib.stride_tricks.sliding_window_view(cosines, gap + 1), [np.empty(0)]
    for first in range(0, len(starts), 20_000):
        values = np.sort(windows[starts[first : first + 20_000]], axis=1)
        parts.append(_between(values, 0.95, gap) - _between(values, 0.05, gap))
    return np.concatenate(parts)


def _in_long_runs(flag: np.ndarray, seg: np.ndarray, least: int) -> np.ndarray:
    """The flagged rows in runs of at least ``least`` within a segment."""
    begins = flag.copy()
    begins[1:] &= ~(flag[:-1] & (seg[1:] == seg[:-1]))
    run = np.cumsum(begins)
    return flag & (np.bincount(run[flag], minlength=run[-1] + 1)[run] >= least)


def stable_carry(frames: DataFrame, s: Settings) -> DataFrame:
    """Adds l_spread, r_spread, stable, s4_distance, s4_angle, s4_t, s4_r (hits), s4_tq, s4_rq (in long runs) and ``s4`` (bits).

    Spread: the 95th less the 5th percentile of a hand's cosine over the window. Each branch needs ``s4_starts``
    consecutive window starts, and covers their windows. One recording at a time.
    """
    needed = [*SEGMENT, "f", "s1", "rot", "centre", "l_cam", "r_cam"]
    added = "s4_distance double, s4_angle double, l_spread double, r_spread double, s4_window boolean, s4_whole boolean, stable boolean, s4_t boolean, s4_r boolean, s4_tq boolean, s4_rq boolean, s4 int"

    def steps(rows: DataFrame) -> DataFrame:
        # The positions before the cosines ride along too: only what the windows read is taken apart.
        return apart(axis_cosines(rows), [*SEGMENT, "f", "rot", "centre", *(f"{h}_{x}" for h in "lr" for x in ("good", "cos"))], lambda d: by_group(d, ["ep"], "f", lambda one: _carried(one, s), added))

    return apart(frames, needed, steps)


def _carried(rows: pa.Table, s: Settings) -> dict:
    """S4 of one recording. Frames of a segment are consecutive, so a window fits where the frame ``s4_gap`` on is of the same segment."""
    gap, size = s.s4_gap, rows.num_rows
    keep, seg = rows["keep"].to_numpy(), rows["seg"].fill_null(0).to_numpy()
    (centre, known), (rot, sure) = numbers(rows["centre"], 3), numbers(rows["rot"], 9)
    window = np.zeros(size, bool)
    if size > gap:
        window[:-gap] = keep[:-gap] & keep[gap:] & (seg[gap:] == seg[:-gap])
    starts = np.flatnonzero(window)
    ends = starts + gap

    def put(values: np.ndarray, where: np.ndarray) -> pa.Array:
        out, empty = np.zeros(size), np.ones(size, bool)
        out[starts], empty[starts] = values, ~where
        return pa.array(out, mask=empty)

    everywhere = np.ones(len(starts), bool)
    moved, turned = G.apart_by(centre[starts], centre[ends]), G.turned_by(rot[starts], rot[ends])
    known, sure = known[starts] & known[ends], sure[starts] & sure[ends]
    spreads = [_spreads(rows[f"{h}_cos"].to_numpy(), starts, gap) if len(starts) else np.empty(0) for h in "lr"]
    good = np.append(0, np.cumsum(rows["l_good"].to_numpy() & rows["r_good"].to_numpy()))
    whole = good[ends + 1] - good[starts] == gap + 1
    stable = whole & (spreads[0] <= s.s4_spread) & (spreads[1] <= s.s4_spread)
    out = {"s4_distance": put(moved, known), "s4_angle": put(turned, sure), "l_spread": put(spreads[0], everywhere), "r_spread": put(spreads[1], everywhere), "s4_window": window, "s4": np.zeros(size, np.int32)}
    # NaN is more than any number in SQL, and so it is here.
    hits = {"s4_whole": whole, "stable": stable, "s4_t": stable & known & ~(moved <= s.s4_translation), "s4_r": stable & sure & ~(turned <= s.s4_rotation + s.s4_slack)}
    for name, values in hits.items():
        out[name] = np.zeros(size, bool)
        out[name][starts] = values
    at = np.arange(size)
    for bit, name in ((1, "s4_t"), (2, "s4_r")):
        out[f"{name}q"] = _in_long_runs(out[name], seg, s.s4_starts)
        last = np.maximum.accumulate(np.where(out[f"{name}q"], at, -gap - 1))
        out["s4"] += bit * (at - last <= gap).astype(np.int32)
    return {name: pa.array(values) if isinstance(values, np.ndarray) else values for name, values in out.items()}


def edge_segments(frames: DataFrame) -> DataFrame:
    """ep, start, end and, for each hand, edge, out and behind frames and the range of its image position, of each S2 run."""
    stats = []
    for h in "lr":
        inside, safe, behind = F.col(f"{h}_inside"), F.col(f"{h}_safe"), F.col(f"{h}_behind")
        stats += [F.sum((inside & ~safe).cast("int")).alias(f"{h}_edge"), F.sum((~inside).cast("int")).alias(f"{h}_out"), F.sum(behind.cast("int")).alias(f"{h}_behind_frames")]
        for i, (axis, size) in enumerate((("u", "width"), ("v", "height"))):
            seen = F.when(~F.isnan(F.col(f"{h}_uv")[i]), F.col(f"{h}_uv")[i] / F.col(size))
            stats += [F.min(seen).alias(f"{h}_{axis}_min"), F.max(seen).alias(f"{h}_{axis}_max")]
    return runs(frames.filter("s2"), ["ep"], "f", *stats)
