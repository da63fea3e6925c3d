"""Validation of frames and episodes: each check is a row predicate or an aggregate; failures come back as rows, or raise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators.outliers import delay_rows


def frame_flags(frames: DataFrame) -> dict[str, Column]:
    """Name and condition that is true where a frame (with n) fails."""
    w = Window.partitionBy("ep").orderBy("f")
    cam = F.col("cam")
    rot = F.array(*[cam[i][j].cast("double") for i in range(3) for j in range(3)])
    error, det = G.rigid_error(rot)
    flat = F.flatten(cam)
    bottom = F.greatest(*[F.abs(cam[3][j] - (1.0 if j == 3 else 0.0)) for j in range(4)])
    shape = F.lit(False)
    for name, size in (("p", 3), ("r6", 6), ("ap", 3), ("ar6", 6)):
        for h in "lr":
            shape = shape | F.coalesce(F.size(f"{h}_{name}") != size, F.lit(True))
    return {
        "frame_index": (F.row_number().over(w) - 1) != F.col("f"),
        "length": F.count(F.lit(1)).over(Window.partitionBy("ep")) != F.col("n"),
        "timestamp": ~F.coalesce(F.abs(F.col("ts") - F.col("f") / 30.0) <= 1e-3, F.lit(False)),
        "vector_width": shape,
        "camera_finite": ~G.finite(flat, 16),
        "camera_bottom_row": ~F.coalesce(bottom <= 1e-5, F.lit(False)),
        "camera_rigid": ~F.coalesce(error <= 1e-3, F.lit(False)),
        "camera_reflection": ~F.coalesce(det > 0, F.lit(False)),
    }


def frame_failures(frames: DataFrame) -> DataFrame:
    """check, failures, first_ep over all frames; a check without failures has 0 and null."""
    flags = frame_flags(frames)
    tagged = frames.select("ep", *[c.alias(f"c_{n}") for n, c in flags.items()])
    sums = tagged.agg(*[x for n in flags for x in (F.count_if(F.col(f"c_{n}")).alias(f"n_{n}"), F.min(F.when(F.col(f"c_{n}"), F.col("ep"))).alias(f"e_{n}"))])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"n_{n}").alias("failures"), F.col(f"e_{n}").alias("first_ep")) for n in flags])))


def failing_episodes(frames: DataFrame) -> DataFrame:
    """ep, problems: for collecting errors by episode instead of stopping."""
    flags = frame_flags(frames)
    tagged = frames.select("ep", *[c.alias(n) for n, c in flags.items()])
    by_ep = tagged.groupBy("ep").agg(*[F.max(n).alias(n) for n in flags])
    return by_ep.select("ep", F.concat_ws(";", *[F.when(F.col(n), F.lit(n)) for n in flags]).alias("problems")).filter("problems <> ''")


def _index_wrong() -> Column:
    return ~F.col("dataset_index").eqNullSafe(F.col("from_index") + F.col("f")) | ((F.col("f") == F.col("n") - 1) & ~F.col("to_index").eqNullSafe(F.col("from_index") + F.col("n")))


def index_failures(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """Frames whose dataset index is not the episode's first index plus the frame number, and the last where the episode's indices end elsewhere."""
    at = frames.join(episodes.select("ep", "from_index", "to_index"), "ep")
    return at.filter(_index_wrong()).select("ep", "f", "dataset_index")


def delay_tests(frames: DataFrame, atol: float = 1e-6) -> tuple[DataFrame, dict[str, Column]]:
    """Frames with what the tests need, and the tests: rows before the last whose action is not the next state, of poses and, where there are both, of grippers."""
    tagged, w = delay_rows(frames, atol), Window.partitionBy("ep").orderBy("f")
    inner = F.col("f") < F.col("n") - 1
    tests = {f"delay_{h}_pose": ~F.col(f"{h}_matches") for h in "lr"}
    for h in "lr":
        if {f"{h}_grip", f"{h}_agrip"} <= set(frames.columns):
            tagged = tagged.withColumn(f"{h}_next", F.lead(f"{h}_grip").over(w))
            tests[f"delay_{h}_gripper"] = ~G.isclose(F.get(f"{h}_agrip", F.lit(0)), F.get(f"{h}_next", F.lit(0)), atol)
    return tagged, {n: inner & t for n, t in tests.items()}


def _summed(tagged: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """check, failures: one aggregate over conditions that are columns first."""
    flags = tagged.select(*[t.alias(n) for n, t in tests.items()])
    sums = flags.agg(*[F.count_if(n).alias(n) for n in tests])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("failures")) for n in tests])))


def delay_failures(frames: DataFrame, atol: float = 1e-6) -> DataFrame:
    """check, failures of ``delay_tests``."""
    return _summed(*delay_tests(frames, atol))


def run_failures(frames: DataFrame, episodes: DataFrame, atol: float = 1e-6) -> DataFrame:
    """check, failures of all that frames must meet before a run: one pass over frames dealt by ep."""
    tagged, tests = delay_tests(frames, atol)
    tests = frame_flags(frames) | tests
    if "dataset_index" in frames.columns:
        tagged = tagged.join(episodes.select("ep", "from_index", "to_index"), "ep")
        tests["dataset_index"] = _index_wrong()
    return _summed(tagged, tests)


def episode_failures(episodes: DataFrame, info: DataFrame) -> DataFrame:
    """check, failures over the metadata: contiguous episodes, totals, own files, video durations, frame rate."""
    sums = episodes.agg(
        F.count(F.lit(1)).alias("e"), F.count_distinct("ep").alias("d"), F.min("ep").alias("lo"), F.max("ep").alias("hi"), F.sum("n").alias("frames"), F.count_distinct("data_path").alias("files"),
        *[F.count_distinct(f"{v}_path").alias(v) for v in ("camera_reference", "camera_aux_0")],
        F.count_if(F.greatest(*[F.abs(F.col(f"{v}_to") - F.col(f"{v}_from") - F.col("n") / 30.0) for v in ("camera_reference", "camera_aux_0")]) > 1e-3).alias("durations"),
        F.count_if(F.col("n") < 1).alias("empty"),
    )
    both = sums.crossJoin(info.select("fps", "total_episodes", "total_frames"))  # one row each
    tests = {
        "fps": F.col("fps") != 30, "episode_count": F.col("e") != F.col("total_episodes"), "episode_index": (F.col("lo") != 0) | (F.col("hi") != F.col("e") - 1) | (F.col("d") != F.col("e")),
        "frame_total": F.col("frames") != F.col("total_frames"), "data_files": F.col("files") != F.col("e"), "video_files": (F.col("camera_reference") != F.col("e")) | (F.col("camera_aux_0") != F.col("e")),
    }
    rows = [F.struct(F.lit(n).alias("check"), t.cast("long").alias("failures")) for n, t in tests.items()]
    rows += [F.struct(F.lit("video_duration").alias("check"), F.col("durations").alias("failures")), F.struct(F.lit("empty_episode").alias("check"), F.col("empty").alias("failures"))]
    return both.select(F.inline(F.array(*rows)))


def camera_failures(episodes: DataFrame) -> DataFrame:
    """check, failures, first_ep: episodes whose intrinsics are not nine finite numbers with positive focal lengths, whose lens has a

    coefficient that is not finite or a number of them that no model has, or whose image has no size.
    """
    k, lens = F.col("k"), F.col("lens")
    odd = lambda c: F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    tests = {
        "intrinsics_shape": ~F.coalesce(F.size(k) == 9, F.lit(False)),
        "intrinsics_finite": odd(k),
        "focal_length": ~F.coalesce((F.get(k, F.lit(0)) > 0) & (F.get(k, F.lit(4)) > 0), F.lit(False)),
        "lens_finite": F.coalesce(odd(lens), F.lit(True)),
        "lens_model": ~F.size(lens).isin(*G.LENS_SIZES) & F.exists(lens, lambda x: x != 0),
        "image_size": ~F.coalesce((F.col("width") > 0) & (F.col("height") > 0), F.lit(False)),
    }
    sums = episodes.agg(*[x for n, t in tests.items() for x in (F.count_if(t).alias(f"n_{n}"), F.min(F.when(t, F.col("ep"))).alias(f"e_{n}"))])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"n_{n}").alias("failures"), F.col(f"e_{n}").alias("first_ep")) for n in tests])))


def scanner_failures(episodes: DataFrame, info: DataFrame) -> DataFrame:
    """check, failures: what a scan of recordings asks beyond ``episode_failures``: delay 1, layout version, videos of their own from 0."""
    starts = F.count_if(F.greatest(*[F.abs(F.col(f"{v}_from")) for v in ("camera_reference", "camera_aux_0")]) != 0)
    known = info.columns
    delay = F.coalesce(F.col("state_action_delay") != 1, F.lit(True)) if "state_action_delay" in known else F.lit(True)
    version = F.coalesce(F.col("codebase_version") != "v3.0", F.lit(True)) if "codebase_version" in known else F.lit(True)
    listed = [F.struct(F.lit(n).alias("check"), F.count_if(t).alias("failures")) for n, t in (("state_action_delay", delay), ("codebase_version", version))]
    return info.select(F.inline(F.array(*listed))).unionByName(episodes.agg(F.lit("video_start").alias("check"), starts.alias("failures")))


def unrejected_invalid(judged: DataFrame) -> DataFrame:
    """Frames with an invalid state that S1 does not reject: none, or the rules are broken."""
    return judged.filter((~F.col("l_valid") | ~F.col("r_valid")) & ~F.col("s1")).select("ep", "f")


def require(failures: DataFrame) -> None:
    """Raise where a check failed; the failures are a row for each check."""
    bad = [f"{r['check']}: {r['failures']}" for r in failures.filter("failures > 0").collect()]
    if bad:
        raise ValueError("validation failed: " + "; ".join(bad))


def missing_partners(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that one side has and the other has not, or has more than once: empty for a strict one-to-one join."""
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("in_left")).join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("in_right")), keys, "full_outer")
    return counts.fillna(0).filter("in_left <> 1 OR in_right <> 1")


def changed_rows(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of rows of which any other column differs; NaN equals NaN and null equals null."""
    others = [c for c in before.columns if c not in keys]
    same = F.lit(True)
    for c in others:
        same = same & F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`"))
    joined = before.alias("a").join(after.alias("b"), [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys], "full_outer")
    return joined.filter(~same).select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys])
