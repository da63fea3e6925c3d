"""Vector codes: product quantisation whose nearest entries are found by equal-average search.

A vector's components become integers, and the vector is cut into equal parts; each part position has a codebook of a few
entries. A round assigns every part to its nearest entry and moves entries to the mean of their parts. The entries of a
codebook are sorted by the sum of their components. A part starts at its own sum and looks at entries outwards, always at
the one whose sum is closer; as the squared gap of two sums over the dimension is never more than the squared distance,
it is done once that strictly exceeds the best distance. Entries that only tie are looked at, so the lower index wins.

Vectors stay where Spark has them: a round is one scan in which each task adds up its own parts, and what comes to the
driver is a row for each component of the codebooks (parts x entries x their length), whatever the number of vectors.

Defined results: vectors that are null or hold a null or non-finite component are dropped; the dimension is the one that
most of the others have (of equal counts the greatest), and vectors of another one have null for code and error; a dimension that ``parts`` does
not divide raises, and so do components whose scaled size reaches 2**30 over a part's length, as sums of squares then
leave 64 bits; rows that repeat a vec_id are each coded, those without one come last when the first entries are chosen
(of equal vec_ids the lesser vector first); fewer vectors than entries make smaller codebooks; equal labels, nulls together, share their label_error; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from .common import table, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) for each row of ``parts``: the nearest row of ``book``, of equal ones the first."""
    n, size = parts.shape
    by_sum = np.argsort(book.sum(1), kind="stable")
    sums, entries = book.sum(1)[by_sum], book[by_sum]
    own = parts.sum(1)
    high = np.searchsorted(sums, own)
    low = high - 1
    none = np.iinfo(np.int64).max
    best, found = np.full(n, none // size), np.full(n, len(book))
    live = np.arange(n)
    while len(live):
        a, z, s = low[live], high[live], own[live]
        below = np.where(a >= 0, s - sums[np.maximum(a, 0)], none)
        above = np.where(z < len(book), sums[np.minimum(z, len(book) - 1)] - s, none)
        up = above < below
        gap = np.where(up, above, below)
        on = gap < none
        gap = np.where(on, gap, 0)
        on &= gap * gap <= size * best[live]
        live, up = live[on], up[on]
        at = np.where(up, z[on], a[on])
        off = parts[live] - entries[at]
        far, index = (off * off).sum(1), by_sum[at]
        better = (far < best[live]) | ((far == best[live]) & (index < found[live]))
        best[live[better]], found[live[better]] = far[better], index[better]
        high[live[up]] += 1
        low[live[~up]] -= 1
    return found, best


def integer_vectors(rows: DataFrame, parts: int = PARTS, scale: int = SCALE) -> tuple[DataFrame, int]:
    """(vec_id, label, v: integers, null where the length is another; the length that most vectors have)."""
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    kept = rows.select(rows["vec_id"].cast("long").alias("vec_id"), rows["label"], rows["embedding"].cast("array<double>").alias("embedding")).filter(f"embedding IS NOT NULL AND {finite}")
    usual = kept.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    dim = usual["size"] if usual else 0
    if dim % parts:
        raise ValueError(f"{parts} parts do not divide vectors of {dim} components")
    limit = (1 << 30) // max(1, dim // parts)
    whole = f"CASE WHEN abs(x) * {scale} < {limit} THEN cast(floor(x * {scale}) AS int) ELSE raise_error('a component is too large for 64-bit sums') END"
    return written(kept.select("vec_id", "label", F.expr(f"CASE WHEN size(embedding) = {dim} THEN transform(embedding, x -> {whole}) END").alias("v")), "vectors"), dim


def _cut(batch: pa.RecordBatch, dim: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that have a vector, their parts: part position, row, component)."""
    column = batch.column("v")
    some = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)  # null lists add nothing
    return some, np.ascontiguousarray(flat.reshape(len(some), parts, dim // parts).transpose(1, 0, 2))


def trained(vectors: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebook of each part position. First entries: those of the least vec_ids."""
    first = vectors.filter("v IS NOT NULL").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, dim // parts).transpose(1, 0, 2)
    if not len(first):
        return list(books)
    for _ in range(rounds):
        shared = vectors.sparkSession.sparkContext.broadcast(books)

        def added(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            books = shared.value
            sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
            for batch in batches:
                _, cut = _cut(batch, dim, parts)
                for part, rows in enumerate(cut):
                    found, _ = nearest(rows, books[part])
                    np.add.at(sums[part], found, rows)
                    counts[part] += np.bincount(found, minlength=books.shape[1])
            part, entry = np.nonzero(counts)
            yield pa.record_batch([pa.array(part), pa.array(entry), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

        each = vectors.select("v").mapInArrow(added, "part long, entry long, n long, sums array<long>").select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
        total = each.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38)")).alias("x"))
        books = books.copy()
        for r in total.collect():  # as many rows as the codebooks have components
            books[r["part"], r["entry"], r["at"]] = int(r["x"]) // r["n"]
        shared.unpersist()
    return list(books)


def coded(vectors: DataFrame, books: list[np.ndarray], dim: int) -> DataFrame:
    """vec_id, label, code, error (null for vectors of another length)."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            some, cut = _cut(batch, dim, len(books)) if len(books) else (np.zeros(0, np.int64), [])
            codes, errors = np.zeros((len(some), len(books)), np.uint8), np.zeros(len(some), np.int64)
            for part, rows in enumerate(cut):
                found, far = nearest(rows, books[part])
                codes[:, part] = found
                errors += far
            code, error = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            code[some], error[some] = [c.tobytes().hex() for c in codes], errors
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    schema = StructType([*(vectors.schema[c] for c in ("vec_id", "label"))]).add("code", StringType()).add("error", LongType())
    return vectors.mapInArrow(run, schema)


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def compressed(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, code (two hex digits for each part), error, label_error, codebooks_sha256 of ``rows`` (vec_id, embedding, label)."""
    if not 0 < entries <= 256:
        raise ValueError("a part's code has two hex digits")
    vectors, dim = integer_vectors(rows, parts, scale)
    books = trained(vectors, dim, parts, entries, rounds)
    codes = written(coded(vectors, books, dim), "codes")
    sums = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    both = codes.join(sums, codes["label"].eqNullSafe(sums["of"]))
    return both.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    return compressed(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds one after another; every part against every entry of its codebook, which are sixteen."""
    steps = [
        "k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, row_number() OVER (ORDER BY vec_id) AS r FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"p AS MATERIALIZED (SELECT r, part, list_slice(v, part * len(v) // {PARTS} + 1, (part + 1) * len(v) // {PARTS}) AS x FROM k, (SELECT unnest(range({PARTS})) AS part))",
        f"b0 AS MATERIALIZED (SELECT part, CAST(r - 1 AS BIGINT) AS entry, x AS c FROM p WHERE r <= {ENTRIES})",
    ]
    for i in range(ROUNDS + 1):
        far = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))"
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, part, any_value(x) AS x, min({{'d': d, 'entry': entry}}) AS best FROM (SELECT r, p.part, x, entry, CAST({far} AS BIGINT) AS d FROM p JOIN b{i} b ON b.part = p.part) GROUP BY r, part)")
        if i < ROUNDS:
            steps.append(f"s{i} AS (SELECT part, entry, list(m ORDER BY i) AS c FROM (SELECT part, best.entry AS entry, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m FROM (SELECT part, best, x, unnest(range(1, len(x) + 1)) AS i FROM a{i}) GROUP BY part, best.entry, i) GROUP BY part, entry)")
            steps.append(f"b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(s.c, b.c) AS c FROM b{i} b LEFT JOIN s{i} s ON s.part = b.part AND s.entry = b.entry)")
    steps.append(f"f AS (SELECT r, string_agg(lpad(printf('%x', best.entry), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r)")
    steps.append(f"h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS digest FROM b{ROUNDS})")
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256 FROM k JOIN f USING (r), h"


OP13_SQL = _sql()
