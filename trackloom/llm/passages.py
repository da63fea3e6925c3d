"""Passages that occur more than once: anchors, candidate segments and where they go.

Every window of ``size`` words has an anchor: the least hash among its runs of ``gram`` words. Equal windows have equal
anchors, so windows can meet by anchor instead of by themselves, with one row for each stretch of windows that share it
(a segment). Anchors that one document alone holds are left out before any text moves, through a filter of bits that
lets all shared anchors pass and few others; it is broadcast up to FILTER_BITS, and beyond what that serves a join by
document takes its place. The segments of the others carry their words, joined by single spaces, so that later comparisons
are of the words themselves.

Shards of whole anchors are bounded in words. An anchor whose different segments exceed the bound is cut further by
content: its windows get anchors of longer runs, so that the segments of a run that many texts share part by what stands
around it. Runs of a whole window end this, as equal windows then are one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, grams, mix, pieces, shared_path, whole_text, written

#: The most bits of the filter of shared anchors (64 MB), and the fewest it needs for each anchor.
FILTER_BITS, LEAST_BITS = 1 << 29, 4
_BLOCK = 20
#: Different segments that a task remembers to have given the words of.
_GIVEN = 1 << 20
#: Segments (anchor, wh, words), each with the smallest doc_id it occurs in.
Shard = dict[tuple[int, int, str], int]


def window_anchors(words: Words, size: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, anchor) of each window that lies within one text."""
    values, text = grams(words.hashes(), gram), words.text
    span, n = size - gram + 1, len(words.start) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least, step = values, 1
    while step * 2 <= span:  # sliding minimum by doubling
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[:n], least[span - step : span - step + n])
    at = np.flatnonzero(text[:n] == text[size - 1 : size - 1 + n])
    return at, least[at]


def segments(words: Words, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, windows, anchor) of each longest stretch of windows in one text with the same anchor."""
    at, anchor = window_anchors(words, size, gram)
    if not len(at):
        return at, at, anchor.view(np.int64)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]
    first = np.flatnonzero(new)
    return at[first], np.diff(np.r_[first, len(at)]), anchor[first].view(np.int64)


def keyed_text(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``th``, a hash of the text that tells rows apart which repeat a doc_id."""
    return whole_text(docs).withColumn("th", F.xxhash64("text"))


def _positions(anchor: np.ndarray, bits: int) -> np.ndarray:
    shift = np.uint64(64 - (bits.bit_length() - 1))
    anchor = anchor.view(np.uint64)
    return np.stack([mix(anchor) >> shift, mix(anchor ^ np.uint64(0x9E3779B97F4A7C15)) >> shift]).astype(np.int64)


def anchor_filter(shared: DataFrame, bits: int) -> np.ndarray:
    """``bits`` bits as bytes; each task sets the bits of its own blocks, so that nothing is merged."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _positions(batch.column("anchor").to_numpy(), bits).ravel()
            yield pa.record_batch([pa.array(at >> _BLOCK), pa.array(at & ((1 << _BLOCK) - 1))], ["block", "at"])

    def build(rows: pa.Table) -> pa.Table:
        flags = np.zeros(1 << _BLOCK, bool)
        flags[rows.column("at").to_numpy()] = True
        return pa.table({"block": [rows.column("block")[0].as_py()], "bits": pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())})

    out = np.zeros(max(bits, 1 << _BLOCK) >> 3, np.uint8)
    blocks = shared.mapInArrow(place, "block long, at long").distinct().groupBy("block").applyInArrow(build, "block long, bits binary")
    for row in blocks.toLocalIterator():
        out[row.block << (_BLOCK - 3) : (row.block + 1) << (_BLOCK - 3)] = np.frombuffer(row.bits, np.uint8)
    return out


def candidates(docs: DataFrame, size: int, gram: int, filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, th, first (word), windows, anchor, wh, words for each segment whose anchor another document may hold.

    ``wh`` is a hash of the words. ``words`` is null where the same task has given the same segment before, under the
    same or a smaller doc_id.
    """
    spark, rows = docs.sparkSession, keyed_text(docs)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                words = Words(part.column("text"))
                first, _, anchor = segments(words, size, gram)
                order = np.lexsort((anchor, words.text[first]))
                text, anchor = words.text[first][order], anchor[order]
                new = np.r_[True, (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])] if len(text) else np.zeros(0, bool)
                yield pa.record_batch([part.column("doc_id").take(pa.array(text[new])), pa.array(anchor[new])], ["doc_id", "anchor"])

    held = rows.select("doc_id", "text").mapInArrow(anchors, "doc_id long, anchor long")
    shared = written(held.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).filter("a < z").select("anchor"), "anchors")
    n = shared.count()
    bits = 1 << max(_BLOCK, min((8 * n).bit_length(), filter_bits.bit_length() - 1))
    if LEAST_BITS * n <= bits:
        passes = spark.sparkContext.broadcast(anchor_filter(shared, bits))
    else:  # the anchors go to their documents instead
        passes = None
        by_doc = held.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))  # bounded by one document's words
        rows = rows.join(by_doc, "doc_id")

    def known(part: pa.RecordBatch, text: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        if passes is not None:
            at = _positions(anchor, bits)
            return np.flatnonzero(((passes.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(0))
        lists = part.column("anchors")
        mine = _pair(np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy())
        return np.flatnonzero(np.isin(_pair(text, anchor), mine))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: dict[int, int] = {}
        for batch in batches:
            for part in pieces(batch):
                words = Words(part.column("text"))
                first, windows, anchor = segments(words, size, gram)
                hit = known(part, words.text[first], anchor)
                first, windows, anchor = first[hit], windows[hit], anchor[hit]
                text, raw, last = words.text[first], words.data.tobytes(), first + windows + size - 2
                listed = [b" ".join(raw[a:z].split()) for a, z in zip(words.start[first].tolist(), words.end[last].tolist(), strict=True)]
                hashes = [xxhash.xxh3_64_intdigest(x) for x in listed]
                docs_ = part.column("doc_id").take(pa.array(text))
                if len(given) > _GIVEN:
                    given.clear()
                for i, (h, doc) in enumerate(zip(hashes, docs_.to_pylist(), strict=True)):
                    if given.get(h, doc + 1) <= doc:
                        listed[i] = None
                    else:
                        given[h] = doc
                yield pa.record_batch(
                    [docs_, part.column("th").take(pa.array(text)), pa.array(first - words.first[text]), pa.array(windows), pa.array(anchor), pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(listed, pa.binary()).cast(pa.string())],
                    ["doc_id", "th", "first", "windows", "anchor", "wh", "words"],
                )

    found = rows.filter("doc_id IS NOT NULL").mapInArrow(cut, "doc_id long, th long, first long, windows long, anchor long, wh long, words string")
    path = shared_path(spark, "found")
    found.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit value for each pair; a false hit costs a needless segment, no more."""
    return b.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (a.astype(np.uint64) << np.uint64(40))


def levels(size: int, gram: int) -> list[int]:
    """Lengths of the runs whose least hash is an anchor, from those of first anchors to whole windows."""
    return [gram, (gram + size) // 2, size]


def recut(crowded: DataFrame, size: int, run_length: int) -> DataFrame:
    """anchor, wh, i (first window), sub_anchor, sub_wh, words, windows, doc_id: segments cut by anchors of ``run_length`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "words", 1 << 18):
                words = Words(part.column("words"))
                if run_length == size:  # every window alone, so that equal ones are one segment
                    first, anchor = window_anchors(words, size, size)
                    windows, anchor = np.ones(len(first), np.int64), anchor.view(np.int64)
                else:
                    first, windows, anchor = segments(words, size, run_length)
                text, raw, last = words.text[first], words.data.tobytes(), first + windows + size - 2
                listed = [raw[a:z] for a, z in zip(words.start[first].tolist(), words.end[last].tolist(), strict=True)]
                hashes = np.array([xxhash.xxh3_64_intdigest(x) for x in listed], np.uint64).view(np.int64)
                own = [part.column(c).take(pa.array(text)) for c in ("anchor", "wh", "doc_id")]
                yield pa.record_batch(
                    [own[0], own[1], pa.array(first - words.first[text]), pa.array(anchor), pa.array(hashes), pa.array(listed, pa.binary()).cast(pa.string()), pa.array(windows), own[2]],
                    ["anchor", "wh", "i", "sub_anchor", "sub_wh", "words", "windows", "doc_id"],
                )

    return crowded.select("anchor", "wh", "words", "doc_id").mapInArrow(run, "anchor long, wh long, i long, sub_anchor long, sub_wh long, words string, windows long, doc_id long")


def by_shards(found: DataFrame, search: Callable[[Shard, int], list[list]], size: int, gram: int, shard_words: int) -> DataFrame:
    """anchor, wh, firsts for each different segment of ``found``: the smallest doc_id of every window.

    A shard holds the segments of whole anchors, each with its smallest doc_id; ``search`` gives the firsts of each of its
    segments (it is told how many words an anchor's run has), and the next shard begins after ``shard_words``. An anchor with one segment needs no search.
    """
    return _settled(found.filter("words IS NOT NULL").select("anchor", "wh", "words", "windows", "doc_id"), search, size, levels(size, gram), shard_words)


def _heavy(rows: DataFrame, size: int, shard_words: int) -> DataFrame:
    """Anchors whose rows have more than ``shard_words`` words."""
    return rows.groupBy("anchor").agg(F.sum(F.col("windows") + size - 1).alias("n")).filter(F.col("n") > shard_words).select("anchor")


def _settled(rows: DataFrame, search, size: int, runs: list[int], shard_words: int) -> DataFrame:
    once = ["anchor", "wh", "words", "windows"]
    if len(runs) == 1:  # single windows: equal ones meet by their words
        return rows.groupBy(*once).agg(F.min("doc_id").alias("doc_id")).select("anchor", "wh", F.array("doc_id").alias("firsts"))
    heavy = written(_heavy(rows, size, shard_words), "heavy")
    if heavy.isEmpty():
        return in_shards(rows, search, size, runs[0], shard_words)
    # Copies from several tasks may make the weight, so these are added up before the rest is cut.
    reduced = written(rows.join(heavy, "anchor", "left_semi").groupBy(*once).agg(F.min("doc_id").alias("doc_id")), "reduced")
    crowded = written(_heavy(reduced, size, shard_words), "crowded")
    light = rows.join(heavy, "anchor", "left_anti").unionByName(reduced.join(crowded, "anchor", "left_anti"))
    cut = written(recut(reduced.join(crowded, "anchor", "left_semi"), size, runs[1]), "recut")
    inner = _settled(cut.select(F.col("sub_anchor").alias("anchor"), F.col("sub_wh").alias("wh"), "words", "windows", "doc_id"), search, size, runs[1:], shard_words)
    inner = inner.select(F.col("anchor").alias("sub_anchor"), F.col("wh").alias("sub_wh"), "firsts")
    back = cut.select("anchor", "wh", "i", "sub_anchor", "sub_wh").join(inner, ["sub_anchor", "sub_wh"]).groupBy("anchor", "wh")
    whole = back.agg(F.array_sort(F.collect_list(F.struct("i", "firsts"))).alias("x")).select("anchor", "wh", F.flatten("x.firsts").alias("firsts"))  # bounded by one segment
    return in_shards(light, search, size, runs[0], shard_words).unionByName(whole)


def in_shards(rows: DataFrame, search, size: int, run_length: int, shard_words: int) -> DataFrame:
    """``by_shards`` for anchors of at most ``shard_words`` words each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple[int, int, str, int]]:
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)

        def out(shard: Shard, firsts: list) -> pa.RecordBatch:
            anchor, wh, _ = zip(*shard, strict=True)
            return pa.record_batch([pa.array(anchor, pa.int64()), pa.array(wh, pa.int64()), pa.array(firsts, pa.list_(pa.int64()))], ["anchor", "wh", "firsts"])

        def alone(single: Shard) -> pa.RecordBatch:
            return out(single, [[doc] * (words.count(" ") + 2 - size) for (_, _, words), doc in single.items()])

        shard: Shard = {}
        single: Shard = {}
        held = waiting = 0
        for _, group in groupby(each(), key=lambda x: x[0]):
            own: Shard = {}
            for *key, doc in group:
                key = tuple(key)
                own[key] = min(own.get(key, doc), doc)
            n = sum(words.count(" ") + 1 for _, _, words in own)
            if len(own) == 1:
                single |= own
                waiting += n
                if waiting >= shard_words:
                    yield alone(single)
                    single, waiting = {}, 0
                continue
            shard |= own
            held += n
            if held >= shard_words:
                yield out(shard, search(shard, run_length))
                shard, held = {}, 0
        if shard:
            yield out(shard, search(shard, run_length))
        if single:
            yield alone(single)

    return rows.select("anchor", "wh", "words", "doc_id").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "anchor long, wh long, firsts array<long>")


def repeated_windows(found: DataFrame, firsts: DataFrame) -> DataFrame:
    """doc_id, th, hits: array<struct<at, d>> with the windows (first word) that a smaller doc_id d has too.

    Segments meet their firsts by anchor and word hash, 128 bits together. Skewed keys are split at run time.
    """
    mark = "filter(transform(firsts, (d, i) -> CASE WHEN d < doc_id THEN struct(first + i AS at, d AS d) END), x -> x IS NOT NULL)"
    hits = found.select("doc_id", "th", "first", "anchor", "wh").join(written(firsts, "firsts"), ["anchor", "wh"]).select("doc_id", "th", F.expr(mark).alias("hits"))
    return hits.filter(F.size("hits") > 0)


def zipped(docs: DataFrame, hit: DataFrame) -> DataFrame:
    """doc_id, th, zip, n_words, digest: texts of rows that may be among ``hit`` (doc_id, th) compressed for a shuffle.

    Of the others, told apart by a bounded filter, only the number of words and their SHA-256 move.
    """
    keys = hit.select(F.xxhash64("doc_id", "th").alias("anchor"))
    bits = 1 << max(_BLOCK, min((16 * keys.count()).bit_length(), FILTER_BITS.bit_length() - 1))
    passes = docs.sparkSession.sparkContext.broadcast(anchor_filter(keys, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in pieces(batch):
                at = _positions(part.column("key").to_numpy(), bits)
                may = ((passes.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(0)
                zips, counts, digests = [], [], []
                for text, some in zip(part.column("text"), may.tolist(), strict=True):
                    words = [] if some else text.as_buffer().to_pybytes().split()
                    zips.append(press.compress(text.as_buffer()) if some else None)
                    counts.append(len(words))
                    digests.append(None if some else hashlib.sha256(b" ".join(words)).hexdigest())
                yield pa.record_batch([part.column("doc_id"), part.column("th"), pa.array(zips, pa.binary()), pa.array(counts, pa.int64()), pa.array(digests, pa.string())], ["doc_id", "th", "zip", "n_words", "digest"])

    rows = keyed_text(docs).withColumn("key", F.xxhash64("doc_id", "th"))
    return rows.mapInArrow(run, "doc_id long, th long, zip binary, n_words long, digest string")
