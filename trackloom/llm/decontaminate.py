"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased, so case and punctuation do not hide a copy. Every run of SEED
words of a benchmark item is a seed. One scan of the documents finds where seeds stand, through filters of bits whose size
is bounded, and cuts out passages around them: for each class of items, by powers of two of their lengths, as far as an alignment
at the threshold can reach (the words it matches, and as many others as its score leaves room for), so one long item does not widen the
passages of the others. Passages with the same words are one.
Passages meet items by equality of seeds, however often a seed stands: a pair is left out only where it shares no seed, or where the passage holds too few of
the item's words to reach the threshold in any order. Each other pair is aligned locally (MATCH, MISMATCH, GAP), and the
score is the best alignment over the score of the whole item: 1 for a verbatim copy, less for one with words exchanged,
inserted or left out.

The result has a row for each contaminated pair: doc_id, item_id, score, item_words, end_word (the document's words up
to the alignment's end). Clean documents have none.

Defined results: null texts have no words; items of fewer than LEAST_WORDS words are too short to tell from chance and never
match; of rows that repeat a doc_id or item_id the best alignment counts, of equal ones the first of a passage, in the last such passage; rows without a
doc_id are reported under null, items without an item_id take no part; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BREAKS, ROW_KEYS, Words, grams, pieces, row_keys, table, with_row_keys, written
from .passages import FILTER_BITS, _positions, anchor_filter, keyed_text

#: Words of a seed: of edited copies that still score THRESHOLD, nearly all keep three words in a row.
SEED, LEAST_WORDS = 3, 4
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
#: Cells of one vectorised step of the alignments.
CELLS = 1 << 20


def _plain(texts: pa.Array) -> tuple[Words, bytes]:
    """The words of the texts, and their bytes with anything between words as spaces."""
    words = Words(texts, lower=True, between=BREAKS)
    return words, np.where(BREAKS[words.data], np.uint8(32), words.data).tobytes()


def item_seeds(items: DataFrame) -> DataFrame:
    """item_id, words (normalised text), n_words, seeds (hashes of its runs of SEED words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                words, raw = _plain(part.column("text"))
                hashes = words.hashes()
                lists, texts = [], []
                for i in range(part.num_rows):
                    a, z = words.first[i], words.first[i + 1]
                    lists.append(np.unique(grams(hashes[a:z], SEED)).view(np.int64).tolist())
                    texts.append(b" ".join(raw[words.offsets[i] : words.offsets[i + 1]].split()).decode())
                yield pa.record_batch([part.column("item_id"), pa.array(texts, pa.string()), pa.array(np.diff(words.first)), pa.array(lists, pa.list_(pa.int64()))], ["item_id", "words", "n_words", "seeds"])

    rows = items.select(items["item_id"].cast("long").alias("item_id"), F.lower(F.coalesce(items["text"], F.lit(""))).alias("text"))
    return rows.mapInArrow(run, "item_id long, words string, n_words long, seeds array<long>")


def _passes(flags: np.ndarray, bits: int, runs: np.ndarray) -> np.ndarray:
    at = _positions(runs, bits)
    return ((flags[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(0)


def seeded_passages(docs: DataFrame, any_seed: tuple[np.ndarray, int], by_class: dict[int, tuple[np.ndarray, int, int]]) -> DataFrame:
    """doc_id, th, span (class), at (first word), words, seeds for each stretch of words with seeds at most a class's reach apart, and that many words to either side.

    any_seed: a filter of all seeds and its bits; by_class: for each class its filter, bits and reach.
    """
    shared = docs.sparkSession.sparkContext.broadcast((any_seed, by_class))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, classes = shared.value
        for batch in batches:
            for part in pieces(batch):
                words, raw = _plain(part.column("text"))
                runs = grams(words.hashes(), SEED)
                inside = words.text[: len(runs)] == words.text[SEED - 1 : SEED - 1 + len(runs)]
                seen = np.flatnonzero(_passes(*every, runs) & inside)
                for span, (flags, bits, reach) in classes.items():
                    hit = seen[_passes(flags, bits, runs[seen])]
                    if not len(hit):
                        continue
                    new = np.r_[True, (np.diff(hit) > reach) | (words.text[hit[1:]] != words.text[hit[:-1]])]
                    first = np.flatnonzero(new)
                    groups = np.split(hit, first[1:])
                    of = words.text[hit[first]]
                    begin = np.maximum(words.first[of], hit[first] - reach)
                    end = np.minimum(words.first[of + 1], np.array([g[-1] for g in groups]) + SEED + reach)
                    texts = [b" ".join(raw[a:z].split()) for a, z in zip(words.start[begin].tolist(), words.end[end - 1].tolist(), strict=True)]
                    own = [part.column(c).take(pa.array(of)) for c in ("doc_id", "th")]
                    seeds = pa.array([np.unique(runs[g]).view(np.int64).tolist() for g in groups], pa.list_(pa.int64()))
                    yield pa.record_batch(
                        [*own, pa.array(np.full(len(of), span)), pa.array(begin - words.first[of]), pa.array(texts, pa.binary()).cast(pa.string()), seeds],
                        ["doc_id", "th", "span", "at", "words", "seeds"],
                    )

    rows = keyed_text(docs).withColumn("text", F.lower("text"))
    return rows.mapInArrow(run, "doc_id long, th long, span long, at long, words string, seeds array<long>")


def align(items: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best local score, words of the passage up to its end) of each pair of rows; padding must never be equal.

    A row of the table takes one step: what a gap brings along the passage is a running maximum.
    """
    n, width = passages.shape
    slope = -GAP * np.arange(1, width + 1)
    before, best, end = np.zeros((n, width + 1), np.int32), np.zeros(n, np.int32), np.zeros(n, np.int64)
    for i in range(items.shape[1]):
        step = np.where(passages == items[:, i : i + 1], MATCH, MISMATCH)
        now = np.maximum(np.maximum(before[:, :-1] + step, before[:, 1:] + GAP), 0)
        now = np.maximum(np.maximum.accumulate(now + slope, axis=1) - slope, 0)
        at = now.argmax(1)
        top = now[np.arange(n), at]
        end = np.where(top > best, at + 1, end)
        best = np.maximum(best, top)
        before[:, 1:] = now
    return best, end


def aligned(pairs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """same, item_id, score, item_words, end (word of the passage) of pairs (same, item_id, item, passage) that may score ``threshold``.

    No alignment matches more of an item's words than the passage holds of them, which bounds the score from above.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers: dict[str, int] = {}
            coded = [[np.array([numbers.setdefault(w, len(numbers)) for w in t.split()], np.int32) for t in batch.column(c).to_pylist()] for c in ("item", "passage")]
            held = np.array([np.isin(item, passage).mean() if len(item) else 0.0 for item, passage in zip(*coded, strict=True)])
            may = np.flatnonzero(held >= threshold)
            batch = batch.take(pa.array(may))
            coded = [[side[i] for i in may] for side in coded]
            sizes = [np.array([len(x) for x in side]) for side in coded]
            scores, ends = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            order = np.lexsort(sizes)
            at = 0
            while at < len(order):
                take = 1
                while at + take < len(order) and sizes[1][order[at + take]] * (take + 1) <= CELLS:
                    take += 1
                rows = order[at : at + take]
                tables = []
                for side, size, pad in zip(coded, sizes, (-1, -2), strict=True):
                    filled = np.full((take, max(1, size[rows].max())), pad, np.int32)
                    for k, row in enumerate(rows):
                        filled[k, : size[row]] = side[row]
                    tables.append(filled)
                best, end = align(*tables)
                scores[rows], ends[rows] = best / (MATCH * np.maximum(1, sizes[0][rows])), end
                at += take
            yield pa.record_batch(
                [batch.column("same"), batch.column("item_id"), pa.array(scores), pa.array(sizes[0].astype(np.int64)), pa.array(ends)],
                ["same", "item_id", "score", "item_words", "end"],
            )

    return pairs.select("same", "item_id", "item", "passage").mapInArrow(run, "same string, item_id long, score double, item_words long, end long")


def longest_alignment(n_words: int, threshold: float) -> int:
    """Words of a passage that an alignment of at least ``threshold`` may span: all of the item's, and others while they cost less than the rest of its score."""
    return n_words + int(MATCH * (1 - threshold) * n_words / -max(MISMATCH, GAP))


def over_threshold(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, th (hash of the text), item_id, score, item_words, end_word for each passage and item at or over the threshold."""
    items = written(item_seeds(items).filter(F.col("n_words") >= LEAST_WORDS).filter("item_id IS NOT NULL").withColumn("span", F.expr("cast(ceil(log2(n_words)) AS long)")), "items")
    seeds = items.select("item_id", "span", F.explode("seeds").alias("seed")).distinct()
    # One row for each power of two that an item's length has.
    classes = items.groupBy("span").agg(F.max("n_words").alias("most"), F.sum(F.size("seeds")).alias("n")).collect()

    def flags(rows: DataFrame, n: int, most: int) -> tuple[np.ndarray, int]:
        bits = 1 << min(most.bit_length() - 1, max(20, (64 * n).bit_length()))
        return anchor_filter(rows.select(F.col("seed").alias("anchor")).distinct(), bits), bits

    any_seed = flags(seeds, sum(c["n"] for c in classes), FILTER_BITS)
    by_class = {c["span"]: (*(flags(seeds.filter(F.col("span") == c["span"]), c["n"], FILTER_BITS >> 3) if len(classes) > 1 else any_seed), longest_alignment(c["most"], threshold)) for c in classes}
    found = written(seeded_passages(docs, any_seed, by_class).withColumn("same", F.sha2(F.concat_ws(" ", "span", "words"), 256)), "passages")
    once = found.select("same", "span", "words", "seeds").dropDuplicates(["same"])  # equal words have equal seeds of a class
    pairs = once.select("same", "span", F.explode("seeds").alias("seed")).join(seeds, ["seed", "span"]).select("same", "item_id").distinct()
    whole = pairs.join(once.select("same", F.col("words").alias("passage")), "same").join(items.select("item_id", F.col("words").alias("item")), "item_id")
    over = aligned(whole, threshold).filter(F.col("score") >= threshold)
    return found.select("doc_id", "th", "at", "same").join(over, "same").withColumn("end_word", F.col("at") + F.col("end"))


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, score, item_words, end_word for each pair at or over the threshold."""
    best = over_threshold(docs, items, threshold).groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "item_words", "end_word")).alias("x"))
    return best.select("doc_id", "item_id", F.round("x.score", 6).alias("score"), "x.item_words", "x.end_word")


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item; rows that share a doc_id are judged one by one."""
    over = over_threshold(docs, items)
    bad = over.select(*row_keys(over["doc_id"], over["th"])).distinct()
    return with_row_keys(docs).join(bad, ROW_KEYS, "left_anti").select(*docs.columns)


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
