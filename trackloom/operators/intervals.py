"""Runs, spans and their algebra as DataFrames; spans are [start, end) and never leave Spark.

``keys`` name the columns that separate episodes; everything is per key and in frame order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Rows that one task is to sort at once: stacked windows over wide rows hold some kilobytes a row, and more would be spilled.
ROWS = 50_000


def dealt(df: DataFrame, *keys: str, rows: int = 0) -> DataFrame:
    """Rows dealt by key to as many partitions as shuffles have, and to more where ``rows``, how many there are, asks for it.
    With the number given, adaptive execution does not merge them for being few bytes: windows take time by row, not by byte."""
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS)), *keys)


#: Columns by which rows are dealt and sorted: never packed, so that Spark still knows how the rows lie.
PLACES = ("ep", "hand", "pt", "f", "keep", "seg")


def apart(rows: DataFrame, needed: Sequence[str], steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``steps`` over the ``needed`` columns, while all others ride along as one struct.

    Each sort, window and projection copies its rows, field by field; a struct is copied as one block. Columns that
    ``steps`` adds come last, and those of ``needed`` that it drops are gone.
    """
    needed = [c for c in rows.columns if c in needed or c in PLACES]
    rest = [c for c in rows.columns if c not in needed]
    if not rest:
        return steps(rows)
    done = steps(rows.select(*[F.col(f"`{c}`") for c in needed], F.struct(*[F.col(f"`{c}`") for c in rest]).alias("__others")))
    old = [F.col("__others").getField(c).alias(c) if c in rest else F.col(f"`{c}`") for c in rows.columns if c in rest or c in done.columns]
    return done.select(*old, *[F.col(f"`{c}`") for c in done.columns if c != "__others" and c not in needed])


def by_group(rows: DataFrame, keys: Sequence[str], index: str, steps: Callable[[pa.Table], dict], added: str) -> DataFrame:
    """Adds the columns ``added`` (a schema) that ``steps`` makes of one group's rows in the order of ``index``.

    Spark deals and groups the rows; rows dealt by some of the keys already stay where they are. A group is held whole in its
    task, as numbers in Arrow columns: one trajectory or one recording, never more.
    """
    fields = StructType.fromDDL(added)

    def one(group: pa.Table) -> pa.Table:
        at = group[index].to_numpy()
        if len(at) > 1 and not (at[1:] > at[:-1]).all():
            group = group.take(np.argsort(at, kind="stable"))
        made = steps(group)
        for name in fields.names:
            group = group.append_column(name, made[name])
        return group

    return rows.groupBy(*keys).applyInArrow(one, StructType([*rows.schema.fields, *fields.fields]))


def numbers(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A column of arrays of ``width`` numbers as a matrix of doubles, nulls as NaN, and which rows hold no null."""
    there = column.is_valid().to_numpy()
    if (pc.list_value_length(column).drop_null().to_numpy() != width).any():
        raise ValueError(f"an array has other than {width} numbers")
    flat = pc.list_flatten(column)
    out, known = np.full((len(column), width), np.nan), there.copy()
    out[there] = flat.to_numpy().reshape(-1, width)
    if flat.null_count:
        known[there] = flat.is_valid().to_numpy().reshape(-1, width).all(axis=1)
    return out, known


def arrays(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as a column of arrays."""
    size, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * np.int32(width)), pa.array(matrix.ravel()))


def over(keys: Sequence[str], *order) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)


def running(keys: Sequence[str], *order) -> Window:
    """All rows up to this one, counted as rows."""
    return over(keys, *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def ahead(column: str, keys: Sequence[str], index: str = "f") -> Column:
    """The next value of ``column`` after this row that is not null. One pass in the order that other windows have too,
    where a frame up to the last row would be gone through anew for each row."""
    return F.expr(f"lead({column}) IGNORE NULLS OVER (PARTITION BY {', '.join(keys)} ORDER BY {index})")


def island(keys: Sequence[str], index: str = "f") -> Column:
    """The same value for rows whose index is consecutive among the rows at hand."""
    return F.col(index) - F.row_number().over(over(keys, index))


def runs(rows: DataFrame, keys: Sequence[str], index: str = "f", *aggregates: Column) -> DataFrame:
    """keys, start, end, and ``aggregates`` of each longest run of consecutive indices."""
    grouped = rows.withColumn("__run", island(keys, index)).groupBy(*keys, "__run")
    return grouped.agg(F.min(index).alias("start"), (F.max(index) + 1).alias("end"), *aggregates).drop("__run")


def merged(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overlapping or touching spans as one; empty ones are dropped."""
    w = over(keys, "start", "end").rowsBetween(Window.unboundedPreceding, -1)
    marked = spans.filter("end > start").withColumn("__new", F.coalesce((F.col("start") > F.max("end").over(w)).cast("int"), F.lit(1)))
    numbered = marked.withColumn("__group", F.sum("__new").over(running(keys, "start", "end")))
    return numbered.groupBy(*keys, "__group").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__group")


def _balance(kept: DataFrame, removed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, at, until, held, gone: the stretches between all borders, and how many spans of each side cover them."""
    sides = [(kept, 1, 0), (removed, 0, 1)]
    borders = None
    for spans, a, b in sides:
        for column, sign in (("start", 1), ("end", -1)):
            one = spans.filter("end > start").select(*keys, F.col(column).alias("at"), F.lit(a * sign).alias("a"), F.lit(b * sign).alias("b"))
            borders = one if borders is None else borders.unionByName(one)
    steps = borders.groupBy(*keys, "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return steps.select(*keys, "at", F.lead("at").over(over(keys, "at")).alias("until"), F.sum("a").over(running(keys, "at")).alias("held"), F.sum("b").over(running(keys, "at")).alias("gone"))


def _joined(stretches: DataFrame, keys: Sequence[str]) -> DataFrame:
    return merged(stretches.select(*keys, F.col("at").alias("start"), F.col("until").alias("end")).filter("end IS NOT NULL"), keys)


def subtracted(kept: DataFrame, removed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What of ``kept`` is in no span of ``removed``: one sweep over the borders, no join of spans."""
    return _joined(_balance(kept, removed, keys).filter("held > 0 AND gone = 0"), keys)


def intersected(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _joined(_balance(left, right, keys).filter("held > 0 AND gone > 0"), keys)


def near_groups(hits: DataFrame, keys: Sequence[str], gap: int, index: str = "f") -> DataFrame:
    """Adds ``segment`` (from 1): a hit begins a new one when it is more than ``gap`` after the one before."""
    new = F.coalesce((F.col(index) - F.lag(index).over(over(keys, index)) > gap).cast("int"), F.lit(1))
    return hits.withColumn("__new", new).withColumn("segment", F.sum("__new").over(running(keys, index))).drop("__new")


def long_runs(flagged: DataFrame, keys: Sequence[str], flag: str, least: int, out: str, index: str = "f") -> DataFrame:
    """Adds ``out``: the row is in a run of at least ``least`` consecutive flagged rows of its key.

    A run begins after the last row before that ends one, and ends at the next; both are marks carried along the rows in
    their own order, so nothing is sorted anew.
    """
    return apart(flagged, [*keys, index, flag], lambda rows: _long_runs(rows, keys, flag, least, out, index))


def _long_runs(flagged: DataFrame, keys: Sequence[str], flag: str, least: int, out: str, index: str) -> DataFrame:
    w, at, on = over(keys, index), F.col(index), F.coalesce(F.col(flag), F.lit(False))
    steps = flagged.select("*", F.lag(index).over(w).alias("__before"), F.lead(index).over(w).alias("__after"))
    begins = F.when(~on, at + 1).when(F.col("__before").isNull() | (at - F.col("__before") > 1), at)
    ends = F.when(~on, at).when(F.col("__after").isNull() | (F.col("__after") - at > 1), at + 1)
    steps = steps.select("*", begins.alias("__begins"), ends.alias("__ends")).drop("__before", "__after")
    steps = steps.select("*", F.last("__begins", ignorenulls=True).over(running(keys, index)).alias("__from"), ahead("__ends", keys, index).alias("__to"))
    size = F.coalesce(F.col("__ends"), F.col("__to")) - F.col("__from")
    return steps.withColumn(out, F.col(flag) & (size >= least)).drop("__begins", "__ends", "__from", "__to")


def spread_back(keys: Sequence[str], flag: Column, rows: int, index: str = "f") -> Column:
    """Any flag from ``rows`` rows before to this row: window starts as the frames their windows cover."""
    return F.coalesce(F.max(flag).over(over(keys, index).rowsBetween(-rows, 0)), F.lit(False))


def change_points(rows: DataFrame, keys: Sequence[str], watched: Sequence[str], index: str = "f") -> DataFrame:
    """Adds ``piece``: a new number at each row where a watched column differs from the row before."""
    w = over(keys, index)
    changed = F.lit(False)
    for name in watched:
        changed = changed | ~F.col(name).eqNullSafe(F.lag(name).over(w))
    first = F.row_number().over(w) == 1
    return rows.withColumn("__new", (first | changed).cast("int")).withColumn("piece", F.sum("__new").over(running(keys, index))).drop("__new")


def masked(frames: DataFrame, spans: DataFrame, keys: Sequence[str], index: str = "f") -> DataFrame:
    """Adds ``covered``: how many spans hold the frame, by borders carried along the frames rather than a range join."""
    borders = spans.select(*keys, F.col("start").alias(index), F.lit(1).alias("d")).unionByName(spans.select(*keys, F.col("end").alias(index), F.lit(-1).alias("d")))
    steps = borders.groupBy(*keys, index).agg(F.sum("d").alias("d"))
    both = frames.withColumn("__frame", F.lit(True)).unionByName(steps.withColumn("__frame", F.lit(False)), allowMissingColumns=True)
    summed = both.withColumn("covered", F.coalesce(F.sum("d").over(running(keys, index, "__frame")), F.lit(0)))
    return summed.filter("__frame").drop("__frame", "d")
