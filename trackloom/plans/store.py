"""Stage results kept as Parquet in the shared folder, so that queries over the same input share them and a rerun can resume."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ..config import Settings
from ..operators import outliers, repair, rules
from ..operators.intervals import dealt
from ..sources.frames import frame_count, from_lineitem, wide
from .timeline import attributed, rules_on

_KEPT: dict[tuple[str, str, str, str], DataFrame] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset, a temporary folder of our own on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """While writing, generated methods stay below the size up to which the JVM compiles them (8000 bytes).

    The rules' expressions are wide: beyond that size the JVM would run a whole stage's method interpreted, where Spark's
    projections are split into methods that it does compile. The session's own settings come back afterwards.
    Sides of a join by ep and f that are both dealt by ep meet as they are, where Spark would deal both anew by all keys.
    Columns that ride along as one struct (``intervals.apart``) stay so: pruning of nested fields would take them apart below the windows.
    """
    own = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.optimizer.expression.nestedPruning.enabled": "false"}
    before = {name: spark.conf.get(name) for name in own}
    for name, value in own.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def written(df: DataFrame, name: str) -> DataFrame:
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with small_methods(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget() -> None:
    """Compute stages anew from now on."""
    _KEPT.clear()


def version(spark: SparkSession, path: str) -> str:
    """The files below ``path`` with sizes and times, as one digest; tables that change get another."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(place, True)
    digest, listed = hashlib.sha256(), []
    while files.hasNext():
        one = files.next()
        listed.append(f"{one.getPath()} {one.getLen()} {one.getModificationTime()}")
    for line in sorted(listed):
        digest.update(line.encode())
    return digest.hexdigest()


def kept(spark: SparkSession, sf_dir: str, name: str, settings: Settings, make) -> DataFrame:
    """A stage's table, made once for the same input files and settings of this application."""
    key = (spark.sparkContext.applicationId, version(spark, f"{sf_dir}/lineitem.parquet"), name, settings.fingerprint())
    if key not in _KEPT:
        _KEPT[key] = written(make(), name)
    return _KEPT[key]


#: What S1 depends on: runs that differ in other settings share its points.
S1_FIELDS = ("fps", "position_step", "rotation_step", "max_block", "recovery", "hampel_k", "hampel_position", "hampel_rotation", "max_gap")


def points(spark: SparkSession, sf_dir: str, s: Settings = Settings()) -> DataFrame:
    """Trajectory points with S1 codes, those of actions and repairs; positions and rotations as they are after repair alone.

    Codes of actions come with them, so queries of codes need no order of all points anew.
    """
    s = Settings(**{name: getattr(s, name) for name in S1_FIELDS})
    return kept(spark, sf_dir, "points", s, lambda: repair.repaired(outliers.detected(outliers.points(wide(from_lineitem(spark, sf_dir))), s), s).drop("p", "r6"))


#: What S3 alone depends on: runs that differ in nothing else share the kept frames.
S3_FIELDS = ("s3_translation", "s3_rotation", "skip_s3")


def frames(spark: SparkSession, sf_dir: str, s: Settings = Settings()) -> DataFrame:
    """Frames with every rule's columns, code and reason.

    Kept once, with the hits of the usual S3. Another S3 reads of them what its windows need, and takes the place of those hits.
    """
    cam = ["ep", "f", "rot", "centre", "k", "lens", "width", "height"]
    shared = replace(s, **{name: getattr(Settings(), name) for name in S3_FIELDS})

    def make() -> DataFrame:
        fixed = repair.per_frame(dealt(points(spark, sf_dir, s), "ep", rows=frame_count(spark, sf_dir)), positions_only=True)
        seen = rules_on(fixed.join(wide(from_lineitem(spark, sf_dir)).select(*cam), ["ep", "f"]), shared)
        return attributed(seen).drop("rot", "centre", "k", "lens", "l_cam", "r_cam")

    seen = kept(spark, sf_dir, "frames", shared, make)
    if s == shared:
        return seen
    return attributed(rules.camera_hits(dealt(seen.drop("s3_t", "s3_r", "s3", "code", "reason"), "ep", rows=frame_count(spark, sf_dir)), s))
