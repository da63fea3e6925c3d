"""Where frames come from: recordings in their own layout, and a deterministic stand-in made of ``lineitem``.

Canonical frames: ep, f, ts, dataset_index, cam (4x4), l_p, r_p, l_r6, r_r6 and the actions l_ap, r_ap, l_ar6, r_ar6, and
any other column unchanged. ``wide`` turns them into what the rules read, with the camera as nine and three numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators.intervals import dealt

#: Column names of recordings and their canonical names.
NAMES = {
    "episode_index": "ep",
    "frame_index": "f",
    "timestamp": "ts",
    "index": "dataset_index",
    "extrinsic.camera_reference.T_Episode_CameraReference": "cam",
    "observation.state.eef.left.position": "l_p",
    "observation.state.eef.right.position": "r_p",
    "observation.state.eef.left.rotation_6d": "l_r6",
    "observation.state.eef.right.rotation_6d": "r_r6",
    "action.eef.left.position": "l_ap",
    "action.eef.right.position": "r_ap",
    "action.eef.left.rotation_6d": "l_ar6",
    "action.eef.right.rotation_6d": "r_ar6",
    "observation.state.gripper.left.closedness": "l_grip",
    "observation.state.gripper.right.closedness": "r_grip",
    "action.gripper.left.closedness": "l_agrip",
    "action.gripper.right.closedness": "r_agrip",
}
VIEWS = ("camera_reference", "camera_aux_0")


def renamed(frames: DataFrame, back: bool = False) -> DataFrame:
    """Canonical names, or the recordings' own again; other columns keep theirs (dots included)."""
    names = {v: k for k, v in NAMES.items()} if back else NAMES
    return frames.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in frames.columns])


def read_frames(spark: SparkSession, root: str) -> DataFrame:
    """All episodes of a recording set in one scan; what is not selected later is not read."""
    return renamed(spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{root}/data"))


def read_info(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(f"{root}/meta/info.json")


def read_episodes(spark: SparkSession, root: str) -> DataFrame:
    """ep, n, from_index, to_index, data_path, k, lens, width, height, and path, from_ts, to_ts of each view."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{root}/meta/episodes")
    c = lambda name: F.col(f"`{name}`")
    intrinsics = "camera_intrinsics.camera_reference"
    views = []
    for view in VIEWS:
        at = f"videos/observation.images.{view}"
        views += [F.format_string(f"{at}/chunk-%03d/file-%03d.mp4", c(f"{at}/chunk_index"), c(f"{at}/file_index")).alias(f"{view}_path"), c(f"{at}/from_timestamp").alias(f"{view}_from"), c(f"{at}/to_timestamp").alias(f"{view}_to")]
    return raw.select(
        c("episode_index").alias("ep"), c("length").alias("n"), c("dataset_from_index").alias("from_index"), c("dataset_to_index").alias("to_index"), data_path(c("data/chunk_index"), c("data/file_index")).alias("data_path"),
        F.flatten(c(f"{intrinsics}.matrix")).alias("k"), c(f"{intrinsics}.dist_coeffs").alias("lens"),
        c(f"{intrinsics}.stored_image_size").getField("width").alias("width"), c(f"{intrinsics}.stored_image_size").getField("height").alias("height"), *views,
    )


def data_path(chunk: Column, file: Column) -> Column:
    return F.format_string("data/chunk-%03d/file-%03d.parquet", chunk, file)


def read_source_map(spark: SparkSession, path: str) -> DataFrame:
    """episode_index, task, source_episode_index, filter_source_episode_index, filter_source_start_seconds."""
    return spark.read.schema("episode_index long, task string, source_episode_index long, filter_source_episode_index long, filter_source_start_seconds double").json(path)


def with_episodes(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """Frames with n, k, lens, width and height. Spark broadcasts the episodes where their size allows it, and shuffles otherwise."""
    return frames.join(episodes.select("ep", "n", "k", "lens", "width", "height"), "ep")


def wide(frames: DataFrame) -> DataFrame:
    cam = F.col("cam")
    rot = F.array(*[cam[i][j].cast("double") for i in range(3) for j in range(3)])
    centre = F.array(*[cam[i][3].cast("double") for i in range(3)])
    hands = [f"{h}_{x}" for h in "lr" for x in ("p", "r6", "ap", "ar6")]
    return frames.select("ep", "f", "n", rot.alias("rot"), centre.alias("centre"), F.col("k").cast("array<double>").alias("k"), F.col("lens").cast("array<double>").alias("lens"), "width", "height", *hands)


def frame_count(spark: SparkSession, sf_dir: str) -> int:
    """How many frames ``from_lineitem`` has, by the footers of its files alone."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical frames made of ``lineitem``: a supplier is an episode, its lines in order are frames.

    Four phases of 150 frames alternate: still; 16 mm a frame; still with hands out of view; 9 mm a frame. Odd episodes also
    turn by 1.4 degrees a frame while they move. Discounts, taxes and quantities decide spikes and invalid poses, and
    episode numbers decide long gaps and bad last targets. Rows are dealt by ep, as all that follows wants them.
    """
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    by = Window.partitionBy("ep").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    cents = lambda c: F.round(F.col(c) * 100).cast("int")
    rows = dealt(line.select(F.col("l_suppkey").alias("ep"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", cents("l_discount").alias("dc"), cents("l_tax").alias("tx"), F.col("l_quantity").cast("int").alias("qty")), "ep", rows=frame_count(spark, sf_dir))
    # One order and one pass: the next line's numbers make the next state, which is this row's action.
    everything = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ahead = [F.lead(c).over(by).alias(f"{c}2") for c in ("dc", "tx", "qty")]
    rows = rows.select("ep", "dc", "tx", "qty", (F.row_number().over(by) - 1).cast("long").alias("f"), F.count(F.lit(1)).over(everything).alias("n"), *ahead)
    end = F.col("f") == F.col("n") - 1
    rows = rows.select("ep", "f", "n", "dc", "tx", "qty", F.when(end, F.col("f")).otherwise(F.col("f") + 1).alias("f2"), *[F.when(end, F.col(c)).otherwise(F.col(f"{c}2")).alias(f"{c}2") for c in ("dc", "tx", "qty")])
    nan, zero = F.lit(float("nan")), F.lit(0.0)

    def moved(block: Column, f: Column, phase: int) -> Column:
        """How many frames up to this one are in the phase; blocks of 150 count from the episode's number, below 0 in no moving phase."""
        upto = lambda x: F.floor((F.greatest(x, F.lit(0)) + (3 - phase)) / 4)
        here = F.when((block + F.col("ep")) % 4 == phase, f - block * 150 + 1).otherwise(0)
        return F.coalesce(150 * (upto(block + F.col("ep")) - upto(F.col("ep"))), F.lit(0)) + here

    for own in ("", "2"):
        f, dc, tx, qty = (F.col(f"{c}{own}") for c in ("f", "dc", "tx", "qty"))
        rows = rows.withColumn(f"block{own}", F.floor(f / 150))
        rows = rows.withColumn(f"m1{own}", moved(F.col(f"block{own}"), f, 1)).withColumn(f"m3{own}", moved(F.col(f"block{own}"), f, 3))
        rows = rows.withColumn(f"yaw{own}", F.radians(F.when(F.col("ep") % 2 == 1, 140 * (F.col(f"m1{own}") + F.col(f"m3{own}"))).otherwise(0) / 100.0))
        rows = rows.withColumn(f"cos{own}", F.cos(f"yaw{own}")).withColumn(f"sin{own}", F.sin(f"yaw{own}")).withColumn(f"cx{own}", (16 * F.col(f"m1{own}") + 9 * F.col(f"m3{own}")) / 1000.0)
        cos, sin, cx = (F.col(f"{c}{own}") for c in ("cos", "sin", "cx"))
        rows = rows.withColumn(f"off{own}", F.when((F.col(f"block{own}") + F.col("ep")) % 4 == 2, 3.0).otherwise(0.1))
        (lx, lz), (rx, rz) = ((cx + cos * off + sin * 2.0, -sin * off + cos * 2.0) for off in (-F.col(f"off{own}"), F.col(f"off{own}")))
        jump = F.when((dc == 10) & (tx == 8), 0.5).when((dc == 8) & (tx == 2), 0.12).otherwise(0.0)
        lost = ((qty == 50) & (dc == 0)) | ((F.col("ep") % 5 == 0) & f.between(200, 239)) | ((F.col("ep") % 7 == 0) & (f < 3))
        turn = F.radians(F.when((dc == 9) & (tx == 7), 60.0).when((dc == 3) & (tx == 6), 35.0).otherwise(0.0))
        rows = rows.withColumn(f"turn{own}", turn)
        if own:
            lost = lost | (end & (F.col("ep") % 3 == 0))
        one = F.when((qty == 49) & (dc == 1), 0.0).otherwise(1.0)
        a = "a" if own else ""
        rows = rows.withColumn(f"l_{a}p", F.array(F.when(lost, nan).otherwise(lx + jump), zero, lz)).withColumn(f"r_{a}p", F.array(rx, zero, rz))
        rows = rows.withColumn(f"l_{a}r6", F.array(F.cos(f"turn{own}"), zero, F.sin(f"turn{own}"), zero, F.lit(1.0), zero)).withColumn(f"r_{a}r6", F.array(one, zero, zero, zero, F.lit(1.0), zero))
    c, s = F.col("cos"), F.col("sin")
    grid = [[c, zero, s, F.col("cx")], [zero, F.lit(1.0), zero, zero], [-s, zero, c, zero], [zero, zero, zero, F.lit(1.0)]]
    rows = rows.withColumn("cam", F.array(*[F.array(*r) for r in grid])).withColumn("ts", F.col("f") / 30.0)
    rows = rows.withColumn("k", G.vector(50, 0, 50, 0, 50, 50, 0, 0, 1)).withColumn("lens", G.vector(0, 0, 0, 0, 0)).withColumn("width", F.lit(100)).withColumn("height", F.lit(100))
    hands = [f"{h}_{x}" for h in "lr" for x in ("p", "r6", "ap", "ar6")]
    return rows.select("ep", "f", "n", "ts", "cam", *hands, "k", "lens", "width", "height")
