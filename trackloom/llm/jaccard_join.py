"""N-gram Jaccard join: rare-first prefixes with length, positional and suffix filters.

A document's set holds its different shingles. Documents with the same set are one class, and classes are joined:

* Shingles have one order over the whole corpus: those of a fixed part of the hash space first (COUNTED), by the number
  of classes that hold them, then by hash. Only these are counted, as that is enough to choose a prefix of rare ones; of a class
  with fewer than its prefix needs all are counted, and stand behind them in the same way.
* Two sets that reach the threshold share a shingle of their prefixes, so classes meet by equality of prefix shingles that
  two or more classes hold. A pair passes by its lengths, by where the shared shingle stands in either set (positional
  filter), and by how the sets fall between fixed pivots of the hash space (suffix filter, taken over prefix and suffix): each
  pivot between which one set has an odd and the other an even number of shingles stands for a shingle that they do not share.
* In the group of a shingle every class meets up to HUBS central ones: those with the fewest rarer shingles, which edited copies have
  more of. Only classes that are then in another component than the group's first hub meet the others of their group, but for
  pairs that the triangle inequality of the Jaccard distance rules out. So a large group of near copies costs a few pairs
  for each class and not all pairs, and no link between components is lost.
* A pair is verified once, on the whole sets: they are made again from the texts of classes that have candidates, and
  the sets that meet one hub go through tasks in runs of RUN.

Shingles are told apart by 64 bits of a hash of their words, sets by 128 bits of a hash of theirs.

Defined results: null text, and text without words, has an empty set and is linked with nothing, its like included; fewer words
than a shingle has make one of all; rows that repeat a doc_id are each reported; rows without one link like others, and the
component_id of a component of such rows alone is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Words, grams, mix, pieces, table, whole_text, written
from .components import components
from .passages import FILTER_BITS, _positions, anchor_filter

SHINGLE, PERCENT = 3, 90
#: Hashes below this are counted: a fifth, where a prefix takes a tenth of a set.
COUNTED = (1 << 64) // 5
#: Longs with a bit for each part of the hash space, for the suffix filter.
LONGS = 8
HUBS, RUN = 3, 512
_SIDE = "struct<node: bigint, d1: bigint, d2: bigint, key: bigint>"


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the different shingles of each text, in order of both."""
    words = Words(texts, lower=True)
    hashes, count = words.hashes(), np.diff(words.first)
    whole = grams(hashes, size)
    inside = words.text[: len(whole)] == words.text[size - 1 : size - 1 + len(whole)]
    text, value = [words.text[: len(whole)][inside]], [whole[inside]]
    for k in range(1, size):
        short = np.flatnonzero(count == k)
        text.append(short)
        value.append(mix(grams(hashes, k)[words.first[short]] + np.uint64(k)))
    text, value = np.concatenate(text), np.concatenate(value)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]


def _digests(text: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds of each text's values, 128 bits of them as two longs)."""
    bounds, raw = np.searchsorted(text, np.arange(rows + 1)), value.tobytes()
    made = b"".join(xxhash.xxh3_128_digest(raw[8 * a : 8 * z]) for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
    return bounds, np.frombuffer(made, np.int64).reshape(rows, 2)


def _parities(text: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """LONGS times 64 bits for each text, one for each part of the hash space that holds an odd number of its values."""
    shift = np.uint64(64 - (64 * LONGS).bit_length() + 1)
    part = value >> shift  # in order, as the values are
    word, bit = text * LONGS + (part >> np.uint64(6)).astype(np.int64), np.uint64(1) << (part & np.uint64(63))
    out = np.zeros(rows * LONGS, np.uint64)
    if len(word):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        out[word[first]] = np.bitwise_xor.reduceat(bit, first)
    return out


def _key() -> Column:
    return F.xxhash64("doc_id", "text").alias("key")


def described(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """row, doc_id, key (of doc_id and text), n (size of the set), d1, d2 (digest of the set), counted (hashes that are counted), parts (a bit for each part of the hash space: whether it has an odd number of shingles)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                text, value = shingle_sets(part.column("text"), size)
                bounds, digest = _digests(text, value, part.num_rows)
                n = np.diff(bounds)
                low = np.bincount(text[value < np.uint64(COUNTED)], minlength=part.num_rows)
                prefix = n + (-percent * n // 100) + 1
                take = np.where(100 * n < percent * (n + 1), 0, np.where(low >= prefix, low, n))  # a smaller set links with no other one
                some = np.arange(len(text)) - bounds[text] < take[text]
                listed = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(take)].astype(np.int32)), pa.array(value[some].view(np.int64)))
                parts = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * LONGS), pa.array(_parities(text, value, part.num_rows).view(np.int64)))
                own = [part.column(c) for c in ("row", "doc_id", "key")]
                yield pa.record_batch([*own, pa.array(n), pa.array(digest[:, 0]), pa.array(digest[:, 1]), listed, parts], ["row", "doc_id", "key", "n", "d1", "d2", "counted", "parts"])

    rows = whole_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", _key(), "text")
    return rows.mapInArrow(run, "row long, doc_id long, key long, n long, d1 long, d2 long, counted array<long>, parts array<long>")


class Bits:
    """A broadcast filter of bounded size that all of some 64-bit values pass, and few others."""

    def __init__(self, values: DataFrame, column: Column, most: int = FILTER_BITS):
        values = values.select(column.alias("anchor"))
        self.bits = 1 << max(20, min((16 * values.count()).bit_length(), most.bit_length() - 1))
        self.flags = values.sparkSession.sparkContext.broadcast(anchor_filter(values, self.bits))

    def passes(self, values: np.ndarray) -> np.ndarray:
        at = _positions(values, self.bits)
        return ((self.flags.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(0)

    def rows(self, df: DataFrame, column: str, wanted: bool, then: Callable | None = None, schema: str | None = None) -> DataFrame:
        """The rows whose ``column`` passes, or does not; ``then`` takes them on in the same Python worker."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            some = (batch.filter(pa.array(self.passes(batch.column(column).to_numpy()) == wanted)) for batch in batches)
            yield from then(some) if then else some

        return df.mapInArrow(run, schema or df.schema)


def representatives(sets: DataFrame, classes: DataFrame, filter_bits: int) -> Callable[..., DataFrame]:
    """Gives node, n, counted of the first row of each class, or what a function over Arrow batches makes of them.

    Only rows whose set may occur twice are shuffled.
    """
    twice = Bits(classes.filter("copies > 1"), F.xxhash64("d1", "d2"), filter_bits)
    rows = sets.filter("size(counted) > 0").select(F.col("row").alias("node"), "n", "counted", F.xxhash64("d1", "d2").alias("of"))
    several = twice.rows(rows, "of", True).join(classes.select("node"), "node", "left_semi")

    def mapped(then: Callable | None = None, schema: str | None = None) -> DataFrame:
        return twice.rows(rows, "of", False, then, schema).unionByName(several.mapInArrow(then, schema) if then else several)

    return mapped


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """While writing, Python gets so many rows at once, as whole sets may be long; the session's own setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def prefix_index(reps: Callable[..., DataFrame], percent: int, filter_bits: int) -> DataFrame:
    """h, node, n, pos, lead: the shingles of each prefix that another class holds, with their positions and that of the first."""
    shared = written(reps().select(F.explode("counted").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "shared")
    may = Bits(shared, F.col("h"), filter_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, n = batch.column("counted"), batch.column("n").to_numpy()
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            h = lists.flatten().to_numpy()
            row, later = np.repeat(np.arange(batch.num_rows), np.diff(ends)), h.view(np.uint64) >= np.uint64(COUNTED)
            upto = np.where(later, n[row], np.bincount(row[~later], minlength=batch.num_rows)[row])
            hit = np.flatnonzero(may.passes(h))
            yield pa.record_batch([batch.column("node").take(pa.array(row[hit])), pa.array(n[row[hit]]), pa.array(later[hit]), pa.array(upto[hit]), pa.array(h[hit])], ["node", "n", "later", "upto", "h"])

    held = reps(run, "node long, n long, later boolean, upto long, h long").join(shared, "h")
    of = Window.partitionBy("node", "later")  # bounded by one document
    lead = F.col("upto") - F.count(F.lit(1)).over(of)
    return held.select("h", "node", "n", lead.alias("lead"), (lead + F.row_number().over(of.orderBy("df", "h")) - 1).alias("pos")).filter(f"pos < n - ({percent} * n + 99) div 100 + 1")


def _may_link(x: str, y: str, percent: int) -> str:
    """Length, positional and suffix filter of two members (n, pos, parts) that share a prefix shingle."""
    least = f"(({percent} * ({x}.n + {y}.n) + {99 + percent}) div {100 + percent})"
    length = f"100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n)"
    positional = f"least({x}.pos, {y}.pos) + 1 + least({x}.n - {x}.pos - 1, {y}.n - {y}.pos - 1) >= {least}"
    suffix = " + ".join(f"bit_count({x}.parts[{i}] ^ {y}.parts[{i}])" for i in range(LONGS)) + f" <= {x}.n + {y}.n - 2 * {least}"
    return f"{length} AND {positional} AND {suffix}"


def _once(pairs: DataFrame) -> DataFrame:
    """pairs (hub, other) with each unordered pair once, as a, b, hub, other."""
    ends = pairs.select(F.least("hub.node", "other.node").alias("a"), F.greatest("hub.node", "other.node").alias("b"), "hub", "other")
    return ends.groupBy("a", "b").agg(F.max(F.struct("hub", "other")).alias("x")).select("a", "b", "x.hub", "x.other")


def verified(pairs: DataFrame, docs: DataFrame, size: int, filter_bits: int) -> DataFrame:
    """a, b, shared (shingles of both), either (of any of them) for each of ``pairs`` (a, b, hub, other), on the whole sets; written."""
    wanted = Bits(pairs.select(F.explode(F.array("hub.key", "other.key")).alias("key")).distinct(), F.col("key"), filter_bits)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch.filter(pa.array(wanted.passes(batch.column("key").to_numpy())))):
                text, value = shingle_sets(part.column("text"), size)
                bounds, digest = _digests(text, value, part.num_rows)
                made = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(value.view(np.int64)))
                yield pa.record_batch([pa.array(digest[:, 0]), pa.array(digest[:, 1]), made], ["d1", "d2", "values"])

    sets = whole_text(docs).select(_key(), "text").mapInArrow(again, "d1 long, d2 long, values array<long>")
    runs = pairs.groupBy(F.col("hub.node").alias("hub")).agg((F.count(F.lit(1)) / RUN + 1).cast("long").alias("runs"), F.max("hub").alias("side"))
    others = pairs.select(F.col("hub.node").alias("hub"), "other").join(runs.select("hub", "runs"), "hub")
    others = others.select("hub", F.pmod(F.xxhash64("other.node"), "runs").alias("run"), F.col("other.node").alias("other"), "other.d1", "other.d2")
    hubs = runs.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("runs") - 1)).alias("run"), F.lit(None).cast("long").alias("other"), "side.d1", "side.d2")
    sent = others.unionByName(hubs).join(sets, ["d1", "d2"]).select("hub", "run", "other", "values")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mine = None, np.zeros(0, np.int64)
        for batch in batches:
            hub, run, other = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("hub", "run", "other"))
            lists = batch.column("values")
            ends, flat = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()
            first = batch.column("other").is_null().to_numpy(zero_copy_only=False)
            new = np.flatnonzero(np.r_[True, (hub[1:] != hub[:-1]) | (run[1:] != run[:-1]) | first[1:]])
            for a, z in zip(new.tolist(), [*new[1:].tolist(), batch.num_rows], strict=True):
                if first[a]:
                    at, mine = (hub[a], run[a]), np.sort(flat[ends[a] : ends[a + 1]])
                    a += 1
                if a == z:
                    continue
                if at != (hub[a], run[a]):
                    raise RuntimeError("the first set of a run is missing")
                theirs = flat[ends[a] : ends[z]]
                same = np.r_[0, np.cumsum(mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs)]
                bounds = ends[a : z + 1] - ends[a]
                shared, n = same[bounds[1:]] - same[bounds[:-1]], np.diff(bounds)
                yield pa.record_batch([pa.array(hub[a:z]), pa.array(other[a:z].astype(np.int64)), pa.array(shared.astype(np.int64)), pa.array((len(mine) + n - shared).astype(np.int64))], ["hub", "other", "shared", "either"])

    met = sent.repartition("hub", "run").sortWithinPartitions("hub", "run", F.col("other").asc_nulls_first()).mapInArrow(compare, "hub long, other long, shared long, either long")
    with small_batches(docs.sparkSession):
        return written(met.select(F.least("hub", "other").alias("a"), F.greatest("hub", "other").alias("b"), "shared", "either"), "verified")


def links(members: DataFrame, docs: DataFrame, size: int, percent: int, filter_bits: int) -> DataFrame:
    """u, v: verified links enough to connect all classes that links connect. members: h, m (lead, node, n, pos, parts, side)."""

    def over(pairs: DataFrame) -> DataFrame:
        return pairs.filter(f"100 * shared >= {percent} * either").select(F.col("a").alias("u"), F.col("b").alias("v"))

    central = [F.min(F.when(F.pmod(F.xxhash64("m.node"), F.lit(HUBS)) == i, F.col("m"))) for i in range(HUBS)]
    groups = members.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.array(*central).alias("hubs")).filter("k > 1").withColumn("hubs", F.expr("array_sort(filter(hubs, x -> x IS NOT NULL))"))
    groups = written(groups, "groups")
    stars = members.join(groups, "h").select("m", F.explode("hubs").alias("hub")).filter("m.node <> hub.node").filter(_may_link("m", "hub", percent))
    met = verified(written(_once(stars.select(F.col("hub.side").alias("hub"), F.col("m.side").alias("other"))), "pairs"), docs, size, filter_bits)
    found = over(met)
    of = written(components(found), "star-components")
    # What the first hub of a group and its component say of the group's other members.
    rest = members.join(groups.filter("k > 2").select("h", F.col("hubs")[0]["node"].alias("hub")), "h").select("h", "hub", "m", F.least("hub", "m.node").alias("a"), F.greatest("hub", "m.node").alias("b"))
    near = f"CASE WHEN a = b OR 100 * shared >= {percent} * either THEN 2 WHEN 100 * shared < {2 * percent - 100} * either THEN 0 ELSE 1 END"
    rest = rest.join(met.select("a", "b", "shared", "either"), ["a", "b"], "left").select("h", "hub", "m", F.expr(near).alias("near"), F.col("m.node").alias("node"))
    rest = rest.join(of, "node", "left").withColumnRenamed("component", "own").join(of.select(F.col("node").alias("hub"), F.col("component").alias("main")), "hub", "left")
    rest = written(rest.select("h", "m", "near", F.coalesce("own", "node").alias("own"), F.coalesce("main", "hub").alias("main")), "groups-left")
    outside = rest.filter("own <> main")
    if outside.isEmpty():
        return found
    both = outside.alias("o").join(rest.alias("r"), (F.col("o.h") == F.col("r.h")) & F.expr(
        f"o.own <> r.own AND (r.own = r.main OR o.m.node < r.m.node) AND abs(o.near - r.near) < 2 AND {_may_link('o.m', 'r.m', percent)}"
    ))
    pairs = _once(both.select(F.col("r.m.side").alias("hub"), F.col("o.m.side").alias("other"))).join(met.select("a", "b"), ["a", "b"], "left_anti")
    return found.unionByName(over(verified(written(pairs, "pairs"), docs, size, filter_bits)))


def joined(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs``: components of documents whose sets' Jaccard similarity is ``percent`` or more."""
    sets = written(described(docs, size, percent), "sets")
    classes = written(sets.filter("n > 0").groupBy("d1", "d2").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "classes")
    index = prefix_index(representatives(sets, classes, filter_bits), percent, filter_bits)
    about = sets.select(F.col("row").alias("node"), "parts", F.struct(F.col("row").alias("node"), "d1", "d2", "key").cast(_SIDE).alias("side"))
    members = written(index.join(about, "node").select("h", F.struct("lead", "node", "n", "pos", "parts", "side").alias("m")), "members")
    of = components(written(links(members, docs, size, percent, filter_bits), "links"))
    of = classes.join(of, "node", "left").select("d1", "d2", "least", F.coalesce("component", "node").alias("group"))
    of = of.join(of.groupBy("group").agg(F.min("least").alias("component_id")), "group").select("d1", "d2", "component_id")
    rows = sets.select("doc_id", "n", "d1", "d2").join(of, ["d1", "d2"], "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.expr("CASE WHEN n = 0 THEN doc_id ELSE component_id END").alias("component_id"))


def op12_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH RECURSIVE t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - {SHINGLE} + 2), lambda i: array_to_string(list_slice(w, i, i + {SHINGLE} - 1), ' ')) END) AS x FROM t),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.r < b.r GROUP BY a.r, b.r),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * k >= {PERCENT} * (x.n + y.n - k)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c(r, to_r) AS (SELECT r, r FROM t UNION SELECT c.r, e.b FROM c JOIN e ON e.a = c.to_r)
SELECT any_value(t.doc_id) AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM t JOIN c ON c.r = t.r JOIN t o ON o.r = c.to_r LEFT JOIN n ON n.r = t.r GROUP BY t.r
"""
