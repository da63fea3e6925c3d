"""Ranked lexical search: impact vectors in buckets by their lengths, after LEMP.

A document is a vector of impacts over the terms of the items, and an item is a vector of term weights; the score is their
inner product. Vectors are written in the order of their Euclidean lengths, longest first, and runs of BUCKET of them are
the buckets. The longest vectors of all give each item a first threshold, the score of its k-th document there. Then a bucket is read

* for no item whose length times that of the bucket's longest vector stays below the item's threshold (Cauchy-Schwarz), and
  vectors that are too short for every item are not read from the files at all;
* for the others, only vectors pass whose share in each of the item's heaviest terms (FOCUS) lies where a vector at the
  threshold can have it (coordinate bounds); these are scored exactly in 64-bit integers, and thresholds rise.

A task keeps k documents for each item, and of those the best remain. Bounds are in doubles and allow for rounding; a vector whose
bound equals the threshold is scored, so ties are settled by scores and ids alone.

Items are taken in blocks of about BLOCK_TERMS terms. What is broadcast is a block: its terms, weights and thresholds. One
scan of the texts counts a block's terms; what follows reads those counts.

Defined results: null texts have no terms; documents without terms count for nothing and are never found, items without terms find none;
equal scores come by ascending doc_id, rows without one last; rows that repeat a doc_id are documents of their own, and
rows that repeat an item_id, or have none, items of their own; an empty table on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BREAKS, LOWER, UPPER, Words, pieces, range_hashes, table, whole_text, written

TOP = 10
#: Percent of a document's weight that its length has.
SLOPE = 90
#: Vectors of a bucket, heaviest terms of an item that bounds are taken of, and longest vectors that give first thresholds.
BUCKET, FOCUS, LONGEST = 1024, 3, 4096
BLOCK_TERMS = 1 << 20
#: Relative room for rounding in bounds.
ROOM = 1e-9


@dataclass
class Vocabulary:
    """The different terms of a block: their hashes in order, their bytes one after another, and how many share a hash at most."""

    hashes: np.ndarray
    data: np.ndarray
    start: np.ndarray
    size: np.ndarray
    most: int

    @classmethod
    def of(cls, terms: list[bytes]) -> tuple[Vocabulary, dict[bytes, int]]:
        data = np.frombuffer(b"".join(terms), np.uint8)
        size = np.array([len(t) for t in terms], np.int64)
        start = np.cumsum(size) - size
        hashes = range_hashes(data, start, start + size)[0]
        order = np.argsort(hashes, kind="stable")
        most = int(np.unique(hashes, return_counts=True)[1].max(initial=0))
        return cls(hashes[order], data, start[order], size[order], most), {terms[i]: at for at, i in enumerate(order.tolist())}

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word, term) for each of ``words`` that is a term; where the hashes are equal, lengths and bytes are compared."""
        hashes, found = words.hashes(), [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        first = np.searchsorted(self.hashes, hashes)
        for step in range(self.most):  # once, unless terms share a hash
            at = np.minimum(first + step, len(self.hashes) - 1)
            word = np.flatnonzero((self.hashes[at] == hashes) & (words.end - words.start == self.size[at]))
            if not len(word):
                continue
            size = self.size[at[word]]
            begin = np.cumsum(size) - size
            offset = np.arange(int(size.sum())) - np.repeat(begin, size)
            same = words.data[np.repeat(words.start[word], size) + offset] == self.data[np.repeat(self.start[at[word]], size) + offset]
            word = word[np.logical_and.reduceat(same, begin)]
            found.append((word, at[word]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def item_terms(items: DataFrame) -> DataFrame:
    """item (a number for each row), item_id, terms (different ones)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                words = Words(part.column("text"), lower=True, between=BREAKS)
                raw = words.data.tobytes()
                each = [raw[a:z] for a, z in zip(words.start.tolist(), words.end.tolist(), strict=True)]
                terms = [sorted(set(each[words.first[i] : words.first[i + 1]])) for i in range(part.num_rows)]
                yield pa.record_batch([part.column("item"), part.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], ["item", "item_id", "terms"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), items["item_id"].cast("long").alias("item_id"), F.coalesce(items["text"], F.lit("")).alias("text"))
    return rows.mapInArrow(run, "item long, item_id long, terms array<binary>")


def counted(docs: DataFrame, vocabulary) -> DataFrame:
    """doc_id, n (terms with repeats), at (terms of the broadcast ``vocabulary``), tf for each document with terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = vocabulary.value
        for batch in batches:
            for part in pieces(batch):
                words = Words(part.column("text"), lower=True, between=BREAKS)
                n = np.diff(words.first)
                word, term = terms.find(words)
                key, tf = np.unique(words.text[word] * np.int64(len(terms.hashes) or 1) + term, return_counts=True)
                ends = np.searchsorted(key, np.arange(part.num_rows + 1) * np.int64(len(terms.hashes) or 1)).astype(np.int32)
                listed = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (key % (len(terms.hashes) or 1), tf)]
                yield pa.record_batch([part.column("doc_id"), pa.array(n), *listed], ["doc_id", "n", "at", "tf"]).filter(pa.array(n > 0))

    return whole_text(docs).mapInArrow(run, "doc_id long, n long, at array<int>, tf array<int>")


def document_frequencies(counts: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term; a task adds up its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(batch.column("at").flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(held)
        yield pa.record_batch([pa.array(at), pa.array(held[at])], ["at", "n"])

    out = np.zeros(size, np.int64)
    for r in counts.select("at").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["at"]] = r["n"]
    return out


def impacts(counts: DataFrame, documents: int, terms: int) -> DataFrame:
    """doc_id, length, at, impact: the vectors over a block's terms, in order of their lengths within each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, n = batch.column("tf"), batch.column("n").to_numpy()
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            tf = lists.flatten().to_numpy().astype(np.int64)
            m = 100 - SLOPE + SLOPE * n * documents // terms
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(ends)))
            sums = np.r_[0.0, np.cumsum(impact.astype(float) ** 2)]
            length = np.sqrt(sums[ends[1:]] - sums[ends[:-1]]) * (1 + ROOM)
            made = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(impact.astype(np.int32)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(length), batch.column("at"), made], ["doc_id", "length", "at", "impact"])

    rows = counts.filter("size(at) > 0").mapInArrow(run, "doc_id long, length double, at array<int>, impact array<int>")
    return rows.sortWithinPartitions(F.desc("length"))


@dataclass
class Queries:
    """The items of a block: ids, and for each its terms and weights (heaviest first), length and first threshold."""

    ids: list[int | None]
    terms: list[np.ndarray]
    weights: list[np.ndarray]
    length: np.ndarray
    least: np.ndarray


def _bucket(queries: Queries, floor: np.ndarray, length: np.ndarray, ends: np.ndarray, at: np.ndarray, impact: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item, vectors, their scores) for each item with vectors in this bucket that may reach its threshold in ``floor``."""
    n = len(length)
    row = np.repeat(np.arange(n), np.diff(ends))
    by = np.argsort(at, kind="stable")
    row, value = row[by], impact[by]
    begin = np.searchsorted(at[by], np.arange(size + 1))
    for q in np.flatnonzero(queries.length * length.max() * (1 + ROOM) >= floor):
        terms, weights = queries.terms[q], queries.weights[q]
        share = np.minimum(1.0, floor[q] / (queries.length[q] * length))  # least cosine
        may = np.ones(n, bool)
        for term, weight in zip(terms[:FOCUS], weights[:FOCUS], strict=True):
            held, own = np.zeros(n), min(1.0, weight / queries.length[q])
            held[row[begin[term] : begin[term + 1]]] = value[begin[term] : begin[term + 1]]
            held = np.minimum(1.0, held / length)
            may &= own * held + math.sqrt(1 - own * own) * np.sqrt(1 - held * held) >= share - ROOM
        if not may.any():
            continue
        sizes = begin[terms + 1] - begin[terms]
        index = np.arange(int(sizes.sum())) + np.repeat(begin[terms] - (np.cumsum(sizes) - sizes), sizes)
        pick = may[row[index]]
        index, weight = index[pick], np.repeat(weights, sizes)[pick]
        scores = np.zeros(n, np.int64)
        np.add.at(scores, row[index], weight * value[index])
        hit = np.flatnonzero(scores >= max(1, floor[q]))
        if len(hit):
            yield int(q), hit, scores[hit]


def searched(vectors: DataFrame, queries, size: int, top: int) -> DataFrame:
    """item, item_id, doc_id, score: in each task the best ``top`` documents for each of the broadcast ``queries``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = queries.value
        floor = asked.least.copy()
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # scores, no id, ids
        for batch in batches:
            for start in range(0, batch.num_rows, BUCKET):
                part = batch.slice(start, BUCKET)
                lists = part.column("at")
                ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                none = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                ids = part.column("doc_id").fill_null(0).to_numpy()
                flat = lists.flatten().to_numpy(), part.column("impact").flatten().to_numpy().astype(np.int64)
                for q, hit, scores in _bucket(asked, floor, part.column("length").to_numpy(), ends, *flat, size):
                    found = [np.concatenate(x) for x in zip(best.get(q, (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))), (scores, none[hit], ids[hit]), strict=True)]
                    order = np.lexsort((found[2], found[1], -found[0]))[:top]
                    best[q] = tuple(x[order] for x in found)
                    if len(order) == top:
                        floor[q] = max(floor[q], best[q][0][-1])
        for q, (scores, none, ids) in best.items():
            n = len(scores)
            yield pa.record_batch([pa.array([q] * n, pa.int64()), pa.array([asked.ids[q]] * n, pa.int64()), pa.array(ids, mask=none), pa.array(scores)], ["item", "item_id", "doc_id", "score"])

    return vectors.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def best_of(found: DataFrame, top: int) -> DataFrame:
    """item, item_id, rank, doc_id, score; what many tasks found for one item is cut down in groups first."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    group = found.withColumn("group", F.pmod(F.xxhash64("doc_id", "score"), F.lit(64)))
    some = group.withColumn("rank", F.row_number().over(Window.partitionBy("item", "group").orderBy(*order))).filter(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top).select("item", "item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: for each item the ``top`` documents with the highest scores above 0."""
    spark = docs.sparkSession
    asked = written(item_terms(items), "items")
    total = asked.agg(F.sum(F.size("terms")).alias("n")).first()["n"] or 0
    blocks = -(-total // block_terms)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in range(blocks):
        own = [(r["item_id"], [bytes(t) for t in r["terms"]]) for r in asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).filter("size(terms) > 0").toLocalIterator()]  # about block_terms terms
        out = out.unionByName(written(_block(docs, own, top), "found"))
    return out


def _block(docs: DataFrame, own: list[tuple[int | None, list[bytes]]], top: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary, number = Vocabulary.of(sorted({t for _, terms in own for t in terms}))
    size = len(number)
    counts = written(counted(docs, spark.sparkContext.broadcast(vocabulary)), "counts")
    sums = counts.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    held = document_frequencies(counts, size)
    weight = np.array([math.floor(1000 * math.log((2 * sums["documents"] + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)
    terms = [np.array([number[t] for t in each], np.int64) for _, each in own]
    terms = [t[held[t] > 0] for t in terms]  # other terms are in no vector
    own, terms = [x for x, t in zip(own, terms, strict=True) if len(t)], [t for t in terms if len(t)]
    terms = [t[np.argsort(-weight[t], kind="stable")] for t in terms]
    weights = [weight[t] for t in terms]
    length = np.array([math.sqrt(float((w.astype(float) ** 2).sum())) * (1 + ROOM) for w in weights])
    queries = Queries([i for i, _ in own], terms, weights, np.maximum(length, 1e-300), np.zeros(len(own), np.int64))
    if not own:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    vectors = written(impacts(counts, sums["documents"], sums["terms"]), "impacts")
    cut = vectors.agg(F.expr(f"percentile_approx(length, {max(0.0, 1 - LONGEST / sums['documents'])}, 10000)").alias("x")).first()["x"]
    first = best_of(searched(vectors.filter(F.col("length") >= cut), spark.sparkContext.broadcast(queries), size, top), top).filter(F.col("rank") == top)
    for r in first.toLocalIterator():  # at most a row for each item of the block
        queries.least[r["item"]] = r["score"]
    reach = float((queries.least / queries.length).min()) * (1 - 2 * ROOM)
    found = searched(vectors.filter(F.col("length") >= reach), spark.sparkContext.broadcast(queries), size, top)
    return best_of(found, top).select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _sql() -> str:
    terms = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH i AS (SELECT i, item_id, unnest(list_distinct(t)) AS term FROM (SELECT row_number() OVER () AS i, item_id, {terms} AS t FROM benchmark)),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {terms} AS t FROM documents),
s AS (SELECT count(*) AS N, sum(len(t)) AS L FROM d WHERE len(t) > 0),
c AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(N) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM c, s GROUP BY term),
m AS (SELECT r, doc_id, CAST(100 - {SLOPE} + ({SLOPE} * len(t) * N) // L AS BIGINT) AS m FROM d, s),
x AS (SELECT i, item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN c USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY i, item_id, r),
o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM x WHERE score > 0)
SELECT * FROM o WHERE rank <= {TOP}
"""


OP11_SQL = _sql()
