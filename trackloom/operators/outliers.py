"""S1: numerically invalid poses, jump blocks and Hampel spikes of hand trajectories, one trajectory at a time.

A trajectory is a row for each point: ep, hand, pt (from 0), p (position), r6 (rotation, first two rows), external
(the last action's pose, where it is a target of its own beyond the last frame).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import geometry as G
from .intervals import apart, arrays, by_group, numbers, over

HANDS = ("l", "r")
KEYS = ["ep", "hand"]


def delay_rows(wide: DataFrame, atol: float = 1e-6) -> DataFrame:
    """Adds l_matches, r_matches: the action equals the next state (or, in the last row, its own state), NaN equal to NaN."""
    # Each next value is a column before it is used: used in place, it would be taken, and carried, anew for every use.
    states = [f"{h}_{kind}" for h in HANDS for kind in ("p", "r6")]
    out = wide.select("*", *[F.lead(c).over(over(["ep"], "f")).alias(f"__next_{c}") for c in states])
    last = F.col("f") == F.col("n") - 1
    for h in HANDS:
        same = F.lit(True)
        for kind, width in (("p", 3), ("r6", 6)):
            target = F.when(last, F.col(f"{h}_{kind}")).otherwise(F.col(f"__next_{h}_{kind}"))
            for i in range(width):
                same = same & G.isclose(F.col(f"{h}_a{kind}")[i], target[i], atol)
        out = out.withColumn(f"{h}_matches", same)
    return out.drop(*[f"__next_{c}" for c in states])


def points(wide: DataFrame, atol: float = 1e-6) -> DataFrame:
    """ep, n, hand, pt, p, r6, external: the states, and the last action where it differs from the last state.

    The last row's action aims at its own state, so no row needs the one after it here.
    """
    each, beyond = [], []
    for h in HANDS:
        same = F.lit(True)
        for kind, width in (("p", 3), ("r6", 6)):
            for i in range(width):
                same = same & G.isclose(F.col(f"{h}_a{kind}")[i], F.col(f"{h}_{kind}")[i], atol)
        each.append(F.struct(F.lit(h).alias("hand"), F.col("f").alias("pt"), F.col(f"{h}_p").alias("p"), F.col(f"{h}_r6").alias("r6"), F.lit(False).alias("external")))
        beyond.append(F.when((F.col("f") == F.col("n") - 1) & ~same, F.struct(F.lit(h).alias("hand"), F.col("n").alias("pt"), F.col(f"{h}_ap").alias("p"), F.col(f"{h}_ar6").alias("r6"), F.lit(True).alias("external"))))
    return wide.select("ep", "n", F.inline(F.array(*each, *beyond))).filter("hand IS NOT NULL")


def posed(trajectory: DataFrame) -> DataFrame:
    """Adds finite, valid and the rotation matrix ``rot``; the position of an invalid row is zeroed in ``q``."""
    def steps(rows: DataFrame) -> DataFrame:
        with_rot = G.rotation_6d(rows, "r6", "rot", "__valid")
        with_rot = with_rot.withColumn("finite", G.finite(F.col("p"), 3) & G.finite(F.col("r6"), 6))
        return with_rot.withColumn("valid", F.col("finite") & F.col("__valid")).withColumn("q", G.clean(F.col("p"), 3)).drop("__valid")

    return apart(trajectory, ["p", "r6"], steps)


def whole(w):
    """All rows of the partition, in the order that ``w`` has: windows over one order are one pass, whatever their frames."""
    return w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def steps(rows: DataFrame, group: str) -> DataFrame:
    """Adds, among the rows of the same ``group`` flag: v (number from 0), m (how many), next_q, pos and rot_step per frame."""
    w = over([*KEYS, group], "pt")
    after = [F.lead(c).over(w).alias(f"__next_{c}") for c in ("pt", "q", "rot")]
    out = rows.select("*", (F.row_number().over(w) - 1).alias("v"), F.count(F.lit(1)).over(whole(w)).alias("m"), *after)
    gap = (F.col("__next_pt") - F.col("pt")).cast("double")
    out = out.withColumn("pos", G.distance(F.col("q"), F.col("__next_q")) / gap)
    return G.with_angle(out, "rot", "__next_rot", "rot_step").withColumn("rot_step", F.col("rot_step") / gap).withColumnRenamed("__next_q", "next_q").drop("__next_pt", "__next_rot")


def edges(pt: np.ndarray, q: np.ndarray, rot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position and rotation step per frame from each row to the next."""
    gap = np.diff(pt).astype(float)
    if (gap == 0).any():
        raise ZeroDivisionError("two points of a trajectory have the same number")
    return G.apart_by(q[:-1], q[1:]) / gap, G.turned_by(rot[:-1], rot[1:]) / gap


def blocks(pt: np.ndarray, q: np.ndarray, rot: np.ndarray, s: Settings) -> np.ndarray:
    """The bits of a jump away and back, of each row.

    Between two consecutive jump edges e and f (edge v joins rows v and v + 1) the rows e + 1 to f are a block when they
    are at most ``max_block`` and the trajectory comes back to within ``recovery`` of where it left.
    """
    out = np.zeros(len(pt), np.int32)
    if len(pt) < 4:
        return out
    pos, turn = edges(pt, q, rot)
    big_p, big_r = pos > s.position_step, turn > s.rotation_step
    jumps = np.flatnonzero(big_p | big_r)
    e, f = jumps[:-1], jumps[1:]
    back = (f - e <= s.max_block) & (G.apart_by(q[e], q[f + 1]) < s.recovery)
    bits = np.where(back, (big_p[e] | big_p[f]) + 2 * (big_r[e] | big_r[f]), 0)
    pair = np.searchsorted(jumps, np.arange(len(pt)))
    inside = (pair > 0) & (pair < len(jumps))
    out[inside] = bits[pair[inside] - 1]
    return out


def hampel(pt: np.ndarray, q: np.ndarray, rot: np.ndarray, s: Settings) -> tuple[np.ndarray, list[float]]:
    """``spike`` (bits 4 and 8) of five rows or more, and the thresholds of position and rotation.

    Both edges large inside; at an end, its only edge large and the one beyond it not.
    """
    spike, limits = np.zeros(len(pt), np.int32), []
    for steps, floor, bit in zip(edges(pt, q, rot), (s.hampel_position, s.hampel_rotation), (4, 8)):
        middle = np.median(steps)
        limits.append(max(floor, middle + s.hampel_k * 1.4826 * np.median(np.abs(steps - middle))))
        after = np.append(steps > limits[-1], False)
        before = np.append(False, after[:-1])
        found = before & after
        found[0], found[-1] = after[0] & ~after[1], before[-1] & ~before[-2]
        spike += bit * found.astype(np.int32)
    return spike, limits


def _marks(rows: pa.Table, s: Settings) -> dict:
    """Of one trajectory: poses, marks of valid points, codes, and the good points next to marked ones as [pt, three of q, nine of rot]."""
    pt, p, r6 = rows["pt"].to_numpy(), numbers(rows["p"], 3)[0], numbers(rows["r6"], 6)[0]
    rot, valid = G.rotations(r6)
    finite = np.isfinite(p).all(axis=1) & np.isfinite(r6).all(axis=1)
    valid, q = valid & finite, np.where(np.isfinite(p), p, 0.0)
    block, spike, limits = np.zeros(len(pt), np.int32), np.zeros(len(pt), np.int32), [None, None]
    block[valid] = blocks(pt[valid], q[valid], rot[valid], s)
    calm = valid & (block == 0)
    enough = calm.sum() >= 5
    if enough:
        spike[calm], limits = hampel(pt[calm], q[calm], rot[calm], s)
    code = block | spike | np.where(~finite, 16, np.where(~valid, 32, 0)).astype(np.int32)
    out = {"finite": finite, "valid": valid, "q": arrays(q), "rot": arrays(rot), "calm": calm, "block": block, "spike": spike, "code": code, "action_code": np.append(code[1:], code[-1:]), "points": np.full(len(pt), len(pt))}
    for name, limit in zip(("pos_threshold", "rot_threshold"), limits):
        out[name] = pa.array(np.full(len(pt), limit if enough else 0.0), mask=~(calm & enough))
    at, good, marked = np.arange(len(pt)), np.flatnonzero(code == 0), code != 0
    after = np.searchsorted(good, at)
    poses = np.column_stack([pt, q, rot]).astype(float)
    for name, place, known in (("lo", after - 1, after > 0), ("hi", after, after < len(good))):
        known &= marked
        offsets = np.append(0, np.cumsum(13 * known)).astype(np.int32)
        out[name] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(poses[good[place[known]]].ravel()), mask=pa.array(~known))
    return {name: pa.array(values) if isinstance(values, np.ndarray) else values for name, values in out.items()}


def detected(trajectory: DataFrame, s: Settings) -> DataFrame:
    """The trajectory with finite, valid, rot, q, calm, block, spike, pos_threshold, rot_threshold, ``code`` (bits of S1) and ``action_code``.

    Thresholds are those of valid rows outside blocks, where there are five or more. ``lo``, ``hi`` and ``points`` are what repair
    needs: of a marked point the good ones before and after, and how many points the trajectory has.
    """
    added = "finite boolean, valid boolean, q array<double>, rot array<double>, calm boolean, block int, spike int, pos_threshold double, rot_threshold double, code int, action_code int, lo array<double>, hi array<double>, points long"
    return apart(trajectory, [*KEYS, "pt", "p", "r6"], lambda rows: by_group(rows, KEYS, "pt", lambda one: _marks(one, s), added))


def peak_steps(found: DataFrame) -> DataFrame:
    """Adds pos_in, rot_in: the step from the point before, where both are valid."""
    w = over(KEYS, "pt")
    both = F.col("valid") & F.lag("valid").over(w)
    out = found.withColumn("__back", F.when(both, F.lag(F.struct("q", "rot")).over(w))).withColumn("pos_in", G.distance(F.col("q"), F.col("__back.q")))
    return G.with_angle(out, "__back.rot", "rot", "rot_in").drop("__back")


def anomaly_intervals(found: DataFrame, fps: int = 30) -> DataFrame:
    """ep, hand, start, end, frames, code, peak_position_step, peak_rotation_step of each run of marked points.

    Peaks take in the entry edge and the exit edge, which belongs to the row after the run.
    """
    w = over(KEYS, "pt")
    rows = peak_steps(found).withColumn("pos_out", F.lead("pos_in").over(w)).withColumn("rot_out", F.lead("rot_in").over(w)).filter("code <> 0")
    run = rows.withColumn("__run", F.col("pt") - F.row_number().over(w)).groupBy(*KEYS, "__run")
    out = run.agg(
        F.min("pt").alias("start"), (F.max("pt") + 1).alias("end"), F.count(F.lit(1)).alias("frames"), F.bit_or("code").alias("code"),
        F.max(F.greatest("pos_in", "pos_out")).alias("peak_position_step"), F.max(F.greatest("rot_in", "rot_out")).alias("peak_rotation_step"),
    )
    return out.drop("__run").withColumn("start_seconds", F.col("start") / F.lit(float(fps))).withColumn("end_seconds", F.col("end") / F.lit(float(fps)))


def with_action_codes(found: DataFrame) -> DataFrame:
    """Adds ``action_code``: an action row has the code of the point that it aims at, the next one or its own."""
    return found.withColumn("action_code", F.coalesce(F.lead("code").over(over(KEYS, "pt")), F.col("code")))


def action_codes(found: DataFrame) -> DataFrame:
    """ep, hand, f, state_code, action_code; kept points that have their action codes are not dealt and sorted for them again."""
    aimed = found if "action_code" in found.columns else with_action_codes(found)
    return aimed.filter(~F.col("external")).select("ep", "hand", F.col("pt").alias("f"), F.col("code").alias("state_code"), "action_code")


def mismatch_codes(wide: DataFrame, s: Settings) -> DataFrame:
    """ep, hand, f, code of action trajectories inspected on their own, with bit 64 where an action misses the next state."""
    tagged = delay_rows(wide)
    each = [F.struct(F.lit(h).alias("hand"), F.col("f").alias("pt"), F.col(f"{h}_ap").alias("p"), F.col(f"{h}_ar6").alias("r6"), (~F.col(f"{h}_matches") & (F.col("f") < F.col("n") - 1)).alias("missed")) for h in HANDS]
    own = tagged.select("ep", "n", F.inline(F.array(*each))).withColumn("external", F.lit(False))
    marked = own.withColumn("any", F.max("missed").over(Window.partitionBy(*KEYS)))
    found = detected(marked.filter("any"), s)
    return found.select("ep", "hand", F.col("pt").alias("f"), F.col("code").bitwiseOR(F.when(F.col("missed"), 64).otherwise(0)).alias("code"))


def bit_names(code: Column, names: dict[int, str]) -> Column:
    return F.array_join(F.filter(F.array(*[F.when(code.bitwiseAND(b) != 0, F.lit(n)) for b, n in names.items()]), lambda x: x.isNotNull()), "|")
