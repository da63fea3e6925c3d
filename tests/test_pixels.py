"""Image quality next to whole numbers, against its SQL."""

import duckdb

import __spark_entry__ as entry

#: Single-precision components for which (x + 1) * 100, with a little noise, has another floor in double precision.
EDGES = [-0.39000004529953003, 0.2399999350309372, -0.40000003576278687, -0.4100000262260437]


def test_samples_have_the_floors_of_single_precision(spark, tmp_path):
    path = f"{tmp_path}/embeddings.parquet"
    rows = [(v, [EDGES[(v + i) % len(EDGES)] for i in range(8)], 0) for v in range(42)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(path)
    made = {r.vec_id: tuple(r) for r in entry.queries()["image_quality"](spark, str(tmp_path)).collect()}
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
        wanted = {r[0]: r for r in db.execute(entry.oracle_sql()["image_quality"]).fetchall()}
    assert made == wanted
