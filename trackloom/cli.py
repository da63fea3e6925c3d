"""Command line: ``python -m trackloom COMMAND ...``, or ``spark-submit`` of a file that calls ``trackloom.cli.main``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .config import Settings
from .plans import clips, pipeline, scans

SCANS = {"scan-anomalies": scans.anomalies, "scan-edges": scans.edges, "scan-cameras": scans.cameras}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="trackloom", description=__doc__)
    commands = out.add_subparsers(dest="command", required=True)
    for name in ("annotate", *SCANS):
        one = commands.add_parser(name, help="a whole run" if name == "annotate" else "the reports of one rule")
        one.add_argument("root")
        one.add_argument("output")
        one.add_argument("--s3-translation", type=float, default=Settings.s3_translation)
        one.add_argument("--s3-rotation", type=float, default=Settings.s3_rotation)
        if name == "annotate":
            one.add_argument("--skip-s3", action="store_true")
            one.add_argument("--first", type=int, help="so many episodes, from 0")
            one.add_argument("--shared", help="folder for what runs with other thresholds of S3 share")
            one.add_argument("--batch-episodes", type=int, default=pipeline.BATCH_EPISODES, help="what a broken run makes again at most")
        else:
            one.add_argument("--sample", type=int, help="so many episodes, by a seeded hash")
            one.add_argument("--seed", type=int, default=0)
    cut = commands.add_parser("clips", help="clip plans from a finished annotation")
    cut.add_argument("annotation")
    cut.add_argument("output")
    cut.add_argument("--keyframes", help="Parquet with ep, view, kf")
    cut.add_argument("--episode", type=int, action="append", help="this episode alone; may repeat")
    cut.add_argument("--first", type=int)
    cut.add_argument("--videos", help="root of the recordings: keyframes come from the videos themselves")
    cut.add_argument("--copy", action="store_true", help="write and verify the clips that are whole groups of pictures")
    return out


def main(args: list[str] | None = None) -> dict:
    a = parser().parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    if a.command == "clips":
        found = clips.run(spark, a.annotation, a.output, spark.read.parquet(a.keyframes) if a.keyframes else None, a.episode, a.first, a.videos, a.copy)
    else:
        settings = Settings(skip_s3=getattr(a, "skip_s3", False), s3_translation=a.s3_translation, s3_rotation=a.s3_rotation)
        found = pipeline.run(spark, a.root, a.output, settings, a.first, a.shared, a.batch_episodes) if a.command == "annotate" else SCANS[a.command](spark, a.root, a.output, settings, a.sample, a.seed)
    print(json.dumps(found, sort_keys=True))
    return found
