"""Where results go: repaired labels, plans, timelines and reports, by Spark's own writers and commit protocol."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..plans.timeline import reason_name, stage_of
from .checks import changed_rows
from .frames import renamed


def write_labels(labels: DataFrame, path: str, verify: bool = True) -> None:
    """Repaired labels under the recordings' column names, one folder for 1000 episodes; read back and compared.

    labels: canonical columns with what repair adds. Rows keep their order within an episode.
    """
    out = renamed(labels, back=True).withColumn("chunk", F.floor(F.col("`episode_index`") / 1000))
    # By ranges, so that a task writes to few folders.
    out.repartitionByRange("`episode_index`").sortWithinPartitions("`episode_index`", "`frame_index`").write.option("compression", "zstd").partitionBy("chunk").mode("overwrite").parquet(path)
    if verify and not changed_rows(labels, renamed(labels.sparkSession.read.parquet(path).drop("chunk")), ["ep", "f"]).isEmpty():
        raise IOError(f"{path} differs from what was written")


def unmarked_changes(source: DataFrame, path: str) -> DataFrame:
    """Keys of written labels that differ from ``source`` outside of the poses that they mark as repaired."""
    saved = renamed(source.sparkSession.read.parquet(path).drop("batch", "chunk"))
    marks = {f"{h}_{a}{x}": (f"{kind}.eef_repaired", i) for i, h in enumerate("lr") for a, kind in (("", "observation.state"), ("a", "action")) for x in ("p", "r6")}
    flags = saved.select("ep", "f", *[F.col(f"`{m}`")[i].alias(f"__{c}") for c, (m, i) in marks.items()])
    plain = lambda df: df.join(flags, ["ep", "f"], "left").select(*[F.when(~F.col(f"__{c}"), F.col(c)).alias(c) if c in marks else F.col(f"`{c}`") for c in source.columns])
    return changed_rows(plain(source), plain(saved), ["ep", "f"])


def label_columns(frames: DataFrame) -> DataFrame:
    """ep, f and the columns that repair adds: state and action valid, repaired and reason of both hands, and hand_features_valid."""
    def both(name: str):
        return F.array(F.col(f"l_{name}"), F.col(f"r_{name}"))

    raw = F.array(F.col("l_code") == 0, F.col("r_code") == 0)
    out = {"observation.state.eef_valid": both("valid"), "observation.state.eef_repaired": both("repaired"), "observation.state.eef_anomaly_reason": both("code").cast("array<smallint>"), "observation.state.hand_features_valid": raw}
    out |= {"action.eef_valid": both("avalid"), "action.eef_repaired": both("arepaired"), "action.eef_anomaly_reason": both("acode").cast("array<smallint>")}
    return frames.select("ep", "f", *[c.alias(n) for n, c in out.items()])


def timeline_rows(pieces: DataFrame, episodes: DataFrame) -> DataFrame:
    """The 15 columns of a timeline report. episodes: ep and camera_reference_from, camera_aux_0_from."""
    at = pieces.join(episodes.select("ep", "camera_reference_from", "camera_aux_0_from"), "ep")
    clock = lambda base, frame: F.format_string("%.6f", F.col(base) + F.col(frame) / 30.0)
    return at.select(
        F.col("ep").alias("source_episode_index"), F.col("start").alias("start_frame"), F.col("end").alias("end_frame_exclusive"),
        G.seconds(F.col("start")).alias("start_seconds"), G.seconds(F.col("end")).alias("end_seconds"), G.seconds(F.col("end") - F.col("start")).alias("duration_seconds"),
        F.when(F.col("code") > 0, "reject").otherwise("keep").alias("status"), F.when(F.col("code") > 0, F.concat(F.lit("S"), F.col("code").cast("string"))).otherwise("").alias("stage"), reason_name(F.col("reason")).alias("reason"),
        clock("camera_reference_from", "start").alias("camera_reference_mp4_start_seconds"), clock("camera_reference_from", "end").alias("camera_reference_mp4_end_seconds"),
        clock("camera_aux_0_from", "start").alias("camera_aux_0_mp4_start_seconds"), clock("camera_aux_0_from", "end").alias("camera_aux_0_mp4_end_seconds"),
        F.concat_ws(";", F.transform("matches", lambda m: F.concat(F.lit("S"), stage_of(m).cast("string")))).alias("matched_stages"), F.concat_ws(";", F.transform("matches", reason_name)).alias("matched_reasons"),
    )


def write_csv(rows: DataFrame, path: str, *order: str) -> None:
    """Gzipped CSV with a header, sorted over all parts."""
    (rows.orderBy(*order) if order else rows).write.option("header", True).option("compression", "gzip").option("emptyValue", "").mode("overwrite").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """With its header checked against the schema."""
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def write_json(rows: DataFrame, path: str, *order: str) -> None:
    (rows.orderBy(*order) if order else rows).write.option("compression", "none").mode("overwrite").json(path)


def write_note(spark: SparkSession, path: str, note: dict) -> None:
    """A small record (settings, completion) beside the results, on whatever file system they are on."""
    spark.createDataFrame([(json.dumps(note, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def written_whole(spark: SparkSession, path: str) -> bool:
    """Whether Spark committed this folder: one that a broken run left has no mark of success."""
    return exists(spark, f"{path}/_SUCCESS")


def remove(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def read_note(spark: SparkSession, path: str) -> dict | None:
    if not written_whole(spark, path):
        return None
    return json.loads(spark.read.text(path).first()["value"])


#: Seconds after which a lock that nobody renewed may be taken over.
LEASE = 6 * 3600


@contextmanager
def exclusive(spark: SparkSession, path: str, lease: float = LEASE) -> Iterator[Callable[[], None]]:
    """Hold ``path``, which is created or not at all, while the block runs; another holder raises. Gives a function that renews the hold.

    A holder that died leaves the file; after ``lease`` seconds without renewal one of those who come moves it away and takes its place.
    """
    place, system = _place(spark, path)
    owner = f"{spark.sparkContext.applicationId} {uuid.uuid4().hex}"
    for _ in range(2):
        try:
            stream = system.create(place, False)
            stream.write(bytearray(owner.encode()))
            stream.close()
            break
        except Py4JJavaError:
            if not system.exists(place):
                raise
            age = time.time() - system.getFileStatus(place).getModificationTime() / 1000
            if age <= lease:
                raise RuntimeError(f"another run holds {path}, last renewed {age:.0f} seconds ago") from None
            stale = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
            if system.rename(place, stale):
                system.delete(stale, False)
    else:
        raise RuntimeError(f"another run has just taken {path}")
    try:
        yield lambda: system.setTimes(place, int(time.time() * 1000), -1)
    finally:
        system.delete(place, False)


def digest(rows: DataFrame) -> str:
    """Rows and the sum of their hashes: the same for the same rows, in whatever files and order."""
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).cast("decimal(38)")).alias("h")).first()
    return f"{found['n']}:{found['h'] or 0}"


def label_metadata(spark: SparkSession, root: str, output: str, episodes: DataFrame, settings: dict, partial: bool) -> None:
    """What labels need beside them: their episodes, tasks, source map, info with the added features, and a policy for statistics."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{root}/meta/episodes")
    kept = raw.join(episodes.select(F.col("ep").alias("episode_index")), "episode_index", "left_semi")
    kept.sort("episode_index").write.option("compression", "zstd").mode("overwrite").parquet(f"{output}/meta/episodes")
    for name, of in (("tasks.jsonl", "text"), ("tasks.parquet", "parquet")):
        if exists(spark, f"{root}/meta/{name}"):
            spark.read.format(of).load(f"{root}/meta/{name}").write.format(of).mode("overwrite").save(f"{output}/meta/{name}")
    if exists(spark, f"{root}/meta/episode_source_map.jsonl"):
        mapping = spark.read.json(f"{root}/meta/episode_source_map.jsonl")
        mapping.join(episodes.select(F.col("ep").alias("episode_index")), "episode_index", "left_semi").write.mode("overwrite").json(f"{output}/meta/episode_source_map")
    info = json.loads("\n".join(r.value for r in spark.read.text(f"{root}/meta/info.json").collect()))  # one small document
    features = dict(info.get("features", {}))
    for prefix in ("observation.state", "action"):
        for field, kind in (("valid", "bool"), ("repaired", "bool"), ("anomaly_reason", "uint8")):
            features[f"{prefix}.eef_{field}"] = {"dtype": kind, "shape": [2], "names": ["left", "right"], "fps": 30}
    features["observation.state.hand_features_valid"] = {"dtype": "bool", "shape": [2], "names": ["left", "right"], "fps": 30}
    sums = episodes.agg(F.count(F.lit(1)).alias("e"), F.sum("n").alias("n")).first()
    info |= {"features": features, "total_episodes": sums["e"], "total_frames": sums["n"], "artifact_type": "labels_only", "source_dataset": root, "source_video_root": root}
    info |= {"statistics_status": "not exported; statistics of the source are not those of repaired labels", "trajectory_cleaning": {"method": settings, "source_modified": False, "partial_output": partial}}
    write_note(spark, f"{output}/meta/info", info)
    write_note(spark, f"{output}/meta/statistics_policy", {"status": "not_computed", "use_masks": ["observation.state.eef_valid", "action.eef_valid"], "use_timeline": True})


def anomaly_report(intervals: DataFrame, mapping: DataFrame, names: dict[int, str]) -> DataFrame:
    """Intervals with where they stand in the original recordings; an episode without a mapping raises.

    mapping: as ``read_source_map`` gives it.
    """
    from ..operators.outliers import bit_names

    joined = intervals.join(mapping, intervals["ep"] == mapping["episode_index"], "left")
    known = F.when(F.col("episode_index").isNull(), F.raise_error(F.concat(F.lit("no source mapping for episode "), F.col("ep").cast("string")))).otherwise(F.col("ep"))
    base = F.coalesce("filter_source_start_seconds", F.lit(0.0))
    return joined.select(
        known.alias("episode_index"), F.coalesce("filter_source_episode_index", "source_episode_index", "ep").alias("original_source_episode_index"), "task", "hand", F.col("start").alias("start_frame"), F.col("end").alias("end_frame_exclusive"),
        "start_seconds", "end_seconds", (base + F.col("start_seconds")).alias("original_start_seconds"), (base + F.col("end_seconds")).alias("original_end_seconds"),
        F.col("code").alias("reason_code"), bit_names(F.col("code"), names).alias("reasons"), "peak_position_step", "peak_rotation_step",
    )
