"""What a run must refuse, and what its labels must leave as it was."""

import shutil

import pytest
from pyspark.sql import functions as F

from tests.test_run import root  # noqa: F401
from trackloom.plans.pipeline import load, run
from trackloom.sources import frames as source
from trackloom.sources import sinks


@pytest.fixture
def changed(spark, root, tmp_path_factory):  # noqa: F811
    def write(**columns):
        base = tmp_path_factory.mktemp("changed")
        shutil.copytree(f"{root}/meta", base / "meta")
        rows = source.read_frames(spark, root)
        for name, value in columns.items():
            rows = rows.withColumn(name, F.expr(value))
        source.renamed(rows, back=True).repartition("episode_index").write.parquet(f"{base}/data/chunk-000")
        return str(base)

    return write


def at(value, other):
    return f"CASE WHEN ep = 1 AND f = 50 THEN {value} ELSE {other} END"


def test_load_refuses_what_the_reference_refuses(spark, changed):
    moved = "transform(l_ap, x -> cast(x + 0.01 AS float))"
    agrip = "array(cast(0.5 AS float))"
    cases = [
        ({"l_ap": at(moved, "l_ap")}, "delay_l_pose: 1"),
        ({"l_agrip": at("array(cast(0.7 AS float))", agrip)}, "delay_l_gripper: 1"),
        ({"dataset_index": at("dataset_index + 1", "dataset_index")}, "dataset_index: 1"),
        ({"observation.state.eef_valid": "array(true, true)"}, "already repaired"),
    ]
    for columns, message in cases:
        with pytest.raises(ValueError, match=message):
            load(spark, changed(**columns))
    load(spark, changed(l_agrip=agrip))


def test_labels_keep_values_that_no_repair_marks(spark, changed, tmp_path):
    near = changed(r_ap="transform(r_ap, x -> cast(x + 5e-7 AS float))")
    run(spark, near, f"{tmp_path}/out")
    rows = source.read_frames(spark, near)
    labels = source.renamed(spark.read.parquet(f"{tmp_path}/out/labels").drop("chunk"))
    assert {c: labels.schema[c].dataType for c in rows.columns} == {c: rows.schema[c].dataType for c in rows.columns}
    both = rows.alias("a").join(labels.alias("b"), ["ep", "f"])
    assert both.count() == 160 and both.filter("NOT (a.r_ap <=> b.r_ap)").isEmpty() and both.filter("NOT (a.l_p <=> b.l_p)").count() == 2
    assert sinks.unmarked_changes(rows, f"{tmp_path}/out/labels").isEmpty()
    assert sinks.unmarked_changes(rows.withColumn("r_p", F.when(F.col("f") == 3, F.array(F.lit(0.0).cast("float"))).otherwise(F.col("r_p"))), f"{tmp_path}/out/labels").count() == 2
