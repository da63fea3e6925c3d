"""The whole run over recordings: read, check, judge, report; in batches of episodes that a ledger records, and that are not made twice."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import asdict, replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ALGORITHM, BITS, Settings
from ..operators import outliers, repair, rules
from ..operators.intervals import dealt
from ..sources import checks, frames, sinks
from . import cutplan, timeline
from .store import S3_FIELDS, small_methods, version, written

#: Episodes of a batch: what a broken run makes again at most, besides reports.
BATCH_EPISODES = 100_000


def load(spark: SparkSession, root: str, check: bool = True) -> tuple[DataFrame, DataFrame]:
    """(frames with n and intrinsics, episodes) of a recording set; failed checks raise, and so does input that is already repaired."""
    episodes = frames.read_episodes(spark, root)
    rows = frames.with_episodes(frames.read_frames(spark, root), episodes)
    if check:
        check_metadata(spark, root, rows, episodes)
        check_frames(rows, episodes)
    return rows, episodes


def check_metadata(spark: SparkSession, root: str, rows: DataFrame, episodes: DataFrame) -> None:
    """What episodes and their files alone show; frames of episodes without metadata are found by their numbers."""
    checks.require(checks.episode_failures(episodes, frames.read_info(spark, root)))
    checks.require(checks.camera_failures(episodes))
    if "observation.state.eef_valid" in rows.columns:
        raise ValueError("expected original labels, not an already repaired input")
    unknown = frames.read_frames(spark, root).select("ep").join(episodes.select("ep"), "ep", "left_anti")
    checks.require(unknown.agg(F.lit("unknown_episode").alias("check"), F.count(F.lit(1)).alias("failures")))


def check_frames(rows: DataFrame, episodes: DataFrame) -> None:
    """All checks of frames in one pass over frames that are dealt by episode once."""
    checks.require(checks.run_failures(dealt(rows, "ep"), episodes))


def measured(rows: DataFrame, s: Settings = Settings(), keep=written) -> tuple[DataFrame, DataFrame]:
    """(points with repairs, frames with all that no threshold of S3 changes), each written once: ``keep`` takes a table and its name."""
    wide = frames.wide(rows)
    points = keep(repair.repaired(outliers.detected(outliers.points(dealt(wide, "ep")), s), s), "points")
    cam = wide.select("ep", "f", "rot", "centre", "k", "lens", "width", "height")
    fixed = repair.per_frame(dealt(points, "ep")).join(dealt(cam, "ep"), ["ep", "f"])
    return points, keep(timeline.measured(fixed, s), "measured")


def judged(seen: DataFrame, s: Settings = Settings()) -> DataFrame:
    return timeline.attributed(rules.camera_hits(dealt(seen, "ep"), s))


def repaired_labels(rows: DataFrame, fixed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(source columns, the same with repaired poses and what repair adds); values that no repair marks stay as they were, in their own type."""
    poses = {f"{h}_{a}{x}": f"{h}_{a}repaired" for h in "lr" for a in ("", "a") for x in ("p", "r6")}
    marked = fixed.select("ep", "f", *[F.when(F.col(flag), F.col(c)).cast(rows.schema[c].dataType).alias(f"__{c}") for c, flag in poses.items()])
    source = rows.drop("n", "k", "lens", "width", "height")
    columns = [F.coalesce(f"__{c}", c).alias(c) if c in poses else F.col(f"`{c}`") for c in source.columns]
    return source, source.join(marked, ["ep", "f"]).select(*columns).join(sinks.label_columns(fixed), ["ep", "f"])


def plan_records(judged: DataFrame, pieces: DataFrame, episodes: DataFrame, s: Settings) -> DataFrame:
    """A record for each episode: length, paths, accounts of each stage, accepted intervals and the timeline with all matches.

    Lists are bounded by one episode.
    """
    stages = timeline.stage_accounts(judged, s.skip_s3).groupBy("ep").agg(F.array_sort(F.collect_list(F.struct("stage", "input_frames", "matched_frames", "removed_frames", "overlap_frames", "kept_frames", "matched_intervals", "removed_intervals"))).alias("stages"))
    listed = pieces.groupBy("ep").agg(F.array_sort(F.collect_list(F.struct("start", "end", "code", "reason", "matches"))).alias("timeline"))
    kept = cutplan.keep_intervals(pieces).groupBy("ep").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("accepted_intervals"))
    paths = episodes.select("ep", F.col("n").alias("source_length"), "data_path", *[f"{v}_{x}" for v in frames.VIEWS for x in ("path", "from", "to")])
    return paths.join(stages, "ep").join(listed, "ep").join(kept, "ep", "left").withColumnRenamed("ep", "source_episode_index")


#: What a record says beyond the labels themselves.
ANNOTATION_FIELDS = ("stages", "timeline", "accepted_intervals")


def run(spark: SparkSession, root: str, output: str, s: Settings = Settings(), first: int | None = None, shared: str | None = None, batch_episodes: int = BATCH_EPISODES) -> dict:
    """Write labels with their metadata, timeline, rejected intervals, episodes, plans, clips and a summary below ``output``; returns the summary.

    A finished output of the same settings is left as it is. One that a broken run left is taken up: batches of episodes
    that the ledger holds, and tables that were committed whole, are not made again. Other settings or another version of the
    rules, recordings or labels that have changed since, and a run over the same output that has not ended raise.
    ``first``: that many episodes. ``shared``: a folder for what the thresholds of S3 leave as it is, labels too; runs that
    differ in these alone share it.
    """
    with sinks.exclusive(spark, f"{output}/lock") as renew:
        try:
            found = _run(spark, root, output, s, first, shared, batch_episodes, renew)
        except Exception as e:
            sinks.write_note(spark, f"{output}/last_error", {"status": "failed", "at": datetime.now(UTC).isoformat(), "error": f"{type(e).__name__}: {e}"[:4000]})
            raise
        sinks.remove(spark, f"{output}/last_error")
        return found


def _refuse(known: dict | None, own: dict, source: str, root: str, where: str) -> None:
    if known and known["run"] != own:
        raise ValueError(f"{where} holds a run with other settings")
    if known and known["source"] != source:
        raise ValueError(f"{root} has changed since {where} was begun")


class Ledger:
    """Batches of episodes that are done: below ``base`` a record for each, with what it was made by and the files of its labels."""

    def __init__(self, spark: SparkSession, base: str, run: str):
        self.spark, self.base, self.run = spark, base, run

    def labels(self, batch: int) -> str:
        return f"{self.base}/labels/batch={batch}"

    def rows(self) -> DataFrame:
        """batch, run, labels, episodes, frames of what is done."""
        schema = "batch long, run string, labels string, episodes long, frames long"
        if not sinks.exists(self.spark, f"{self.base}/ledger"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).json(f"{self.base}/ledger")

    def pending(self, batches: DataFrame) -> list:
        """Batches (batch, episodes, frames) without a record; a record that does not fit what is there raises."""
        for row in self.rows().collect():  # one for each batch
            if row["run"] != self.run:
                raise ValueError(f"batch {row['batch']} was made by other settings or another version")
            if not sinks.exists(self.spark, self.labels(row["batch"])) or version(self.spark, self.labels(row["batch"])) != row["labels"]:
                raise ValueError(f"the labels of batch {row['batch']} have changed since they were written")
        return batches.join(self.rows().select("batch"), "batch", "left_anti").orderBy("batch").collect()

    def enter(self, batch) -> None:
        record = {"batch": batch["batch"], "run": self.run, "labels": version(self.spark, self.labels(batch["batch"])), "episodes": batch["episodes"], "frames": batch["frames"]}
        sinks.write_note(self.spark, f"{self.base}/ledger/batch={batch['batch']}", record)


def _batch(spark: SparkSession, rows: DataFrame, episodes: DataFrame, s: Settings, base: str, ledger: Ledger, number: int, step: Callable) -> None:
    """Check, measure and label the episodes of one batch."""

    def keep(table: DataFrame, name: str) -> DataFrame:
        path = f"{base}/stages/{name}/batch={number}"
        step(path, lambda: table.write.mode("overwrite").parquet(path))
        return spark.read.parquet(path)

    check_frames(rows, episodes)
    _, seen = measured(rows, s, keep)
    if not checks.unrejected_invalid(seen).isEmpty():
        raise ValueError("S1 keeps a frame whose state is invalid")
    source, labels = repaired_labels(rows, seen)
    path = ledger.labels(number)
    step(path, lambda: sinks.write_labels(labels, path, verify=False))
    saved = frames.renamed(spark.read.parquet(path).drop("chunk"))
    if not checks.changed_rows(labels, saved, ["ep", "f"]).isEmpty():
        raise IOError(f"{path} differs from what was written")
    if not sinks.unmarked_changes(source, path).isEmpty():
        raise IOError(f"{path} changes values that no repair marks")
    checks.require(checks.delay_failures(frames.with_episodes(saved, episodes)))


def _run(spark: SparkSession, root: str, output: str, s: Settings, first: int | None, shared: str | None, batch_episodes: int, renew: Callable) -> dict:
    began, times = time.time(), {}
    source_version = version(spark, f"{root}/data") + version(spark, f"{root}/meta")
    own = {"settings": s.fingerprint(), "root": root, "first": first, "algorithm": ALGORITHM, "batch_episodes": batch_episodes, "shared": shared}
    for note in ("complete", "started"):
        known = sinks.read_note(spark, f"{output}/{note}")
        _refuse(known, own, source_version, root, output)
        if known and note == "complete":
            return known["summary"]
    sinks.write_note(spark, f"{output}/started", {"run": own, "source": source_version})

    def step(path: str, make: Callable) -> None:
        if not sinks.written_whole(spark, path):
            at = time.time()
            with small_methods(spark):
                make()
            name = path.removeprefix(output).split("/batch=")[0]
            times[name] = round(times.get(name, 0) + time.time() - at, 3)
        renew()

    def keep(table: DataFrame, name: str) -> DataFrame:
        path = f"{output}/stages/{name}"
        step(path, lambda: table.write.mode("overwrite").parquet(path))
        return spark.read.parquet(path)

    rows, episodes = load(spark, root, check=False)
    check_metadata(spark, root, rows, episodes)
    if first is not None:
        rows, episodes = rows.filter(F.col("ep") < first), episodes.filter(F.col("ep") < first)
    # What the thresholds of S3 do not change is named by all else that it depends on.
    plain = replace(s, **{name: getattr(Settings(), name) for name in S3_FIELDS})
    key = hashlib.sha256(json.dumps([own | {"settings": plain.fingerprint(), "shared": None}, source_version], sort_keys=True).encode()).hexdigest()
    base = f"{shared}/{key[:24]}" if shared else output
    ledger = Ledger(spark, base, key)
    batches = episodes.groupBy(F.floor(F.col("ep") / batch_episodes).alias("batch")).agg(F.count(F.lit(1)).alias("episodes"), F.sum("n").alias("frames"))
    with sinks.exclusive(spark, f"{base}/batch-lock") as renew_base:
        pending = ledger.pending(batches)
        for i, batch in enumerate(pending):
            number = batch["batch"]
            of = lambda df, n=number: df.filter((F.col("ep") >= n * batch_episodes) & (F.col("ep") < (n + 1) * batch_episodes))
            _batch(spark, of(rows), of(episodes), s, base, ledger, number, step)
            ledger.enter(batch)
            sinks.write_note(spark, f"{output}/progress", {"batches_made": i + 1, "batches_to_make": len(pending), "frames": batch["frames"], "seconds": round(time.time() - began, 3)})
            renew_base()
    points, seen = (spark.read.parquet(f"{base}/stages/{name}").drop("batch") for name in ("points", "measured"))
    final = keep(judged(seen, s), "frames")
    pieces = keep(timeline.timeline(final), "timeline")
    if not timeline.conservation_errors(pieces, episodes).isEmpty():
        raise ValueError("a timeline is no partition of its episode")
    odd = timeline.unbalanced(timeline.stage_accounts(final, s.skip_s3), episodes).limit(5).collect()
    if odd:
        raise ValueError("accounts do not add up: " + "; ".join(f"episode {r.ep}, {r.stage}: {r.problem}" for r in odd))
    sinks.label_metadata(spark, root, f"{output}/labels_metadata", episodes, asdict(s), first is not None)
    report = sinks.timeline_rows(pieces, episodes)
    summary = timeline.episode_summary(final)
    if not checks.missing_partners(summary, episodes, ["ep"]).isEmpty():
        raise ValueError("episodes and their summaries do not match one to one")
    labels = F.format_string(("" if base == output else f"{base}/") + "labels/batch=%d/chunk=%d", F.floor(F.col("ep") / batch_episodes), F.floor(F.col("ep") / 1000))
    per_episode = summary.join(episodes, "ep").select(
        F.col("ep").alias("source_episode_index"), "source_frames", "duration_seconds", labels.alias("repaired_label_path"),
        *[f"{v}_{x}" for v in frames.VIEWS for x in ("path", "from", "to")], "rejected_frames", "accepted_frames",
    )
    plan = plan_records(final, pieces, episodes, s)
    tables = {
        "timeline.csv": lambda p: sinks.write_csv(report, p, "source_episode_index", "start_frame"),
        "rejected_intervals.csv": lambda p: sinks.write_csv(report.filter("status = 'reject'"), p, "source_episode_index", "start_frame"),
        "episodes.csv": lambda p: sinks.write_csv(per_episode, p, "source_episode_index"),
        "anomalies.json": lambda p: sinks.write_json(outliers.anomaly_intervals(points).withColumn("reasons", outliers.bit_names(F.col("code"), BITS)), p, "ep", "hand", "start"),
        "clips.json": lambda p: sinks.write_json(cutplan.cut_plan(pieces, episodes), p, "ep", "clip"),
        "plan.json": lambda p: sinks.write_json(plan, p, "source_episode_index"),
        "manifest.json": lambda p: sinks.write_json(plan.drop(*ANNOTATION_FIELDS), p, "source_episode_index"),
    }
    for name, write in tables.items():
        step(f"{output}/{name}", lambda write=write, name=name: write(f"{output}/{name}"))
    found = totals(final, points, summary, s)
    if version(spark, f"{root}/data") + version(spark, f"{root}/meta") != source_version:
        raise ValueError(f"{root} has changed while it was read")
    digests = {name: sinks.digest(spark.read.option("header", True).csv(f"{output}/{name}")) for name in ("timeline.csv", "episodes.csv")}
    timings = {"seconds": round(time.time() - began, 3), "steps": times}
    sinks.write_note(spark, f"{output}/complete", {"run": own, "source": source_version, "summary": found, "digests": digests, "timings": timings, "labels": f"{base}/labels"})
    sinks.remove(spark, f"{output}/stages")  # a shared folder keeps its own
    return found


def totals(judged: DataFrame, points: DataFrame, summary: DataFrame, s: Settings) -> dict:
    """Frames, seconds and shares over all episodes, by stage and together; accounts that do not add up raise."""
    listed = timeline.stage_accounts(judged, s.skip_s3).groupBy("stage").agg(*[F.sum(f"{c}_frames").alias(c) for c in ("input", "matched", "removed", "overlap", "kept")]).collect()  # four rows
    all_ = summary.agg(F.count(F.lit(1)).alias("episodes"), F.sum("source_frames").alias("n"), F.sum("rejected_frames").alias("x")).first()
    repairs = repair.repair_counts(judged, points).agg(*[F.sum(c).alias(c) for c in ("repaired_hand_frames", "unresolved_hand_frames", "repaired_action_hand_rows", "unresolved_action_hand_rows")]).first()
    n, x = all_["n"] or 0, all_["x"] or 0
    stages = {r["stage"]: {k: r[k] for k in ("matched", "removed", "overlap")} | {"removed_seconds": r["removed"] / s.fps, "removed_share": r["removed"] / max(1, n)} for r in listed}
    if sum(v["removed"] for v in stages.values()) != x or any(r["removed"] + r["kept"] != r["input"] for r in listed if r["stage"] == "S1"):
        raise ValueError("stage accounts and rejected frames differ")
    whole = {"episodes": all_["episodes"], "source_frames": n, "rejected_frames": x, "accepted_frames": n - x, "source_seconds": n / s.fps, "rejected_seconds": x / s.fps, "rejected_share": x / max(1, n)}
    return whole | {"repairs": repairs.asDict(), "stages": stages}
