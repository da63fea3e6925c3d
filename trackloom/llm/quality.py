"""Quality by histogram gradient-boosted trees over document statistics.

Each text becomes a row of statistics (sizes, character classes, repetition, vocabulary). Training bins every statistic
by quantiles of the sample, and grows trees of DEPTH levels on gradient histograms of the logistic loss. The forest is
flattened into complete-tree arrays, and scoring moves all texts of a batch down one level of one tree at a time.

Training takes a documented bounded sample of labelled rows (SAMPLE, chosen by a hash of the id); scoring covers every
whole text. Labels, lang, source and doc_id are no inputs of a score.

Defined results: null text counts as empty, whose statistics are all 0; with no labelled rows every score is 0.5; rows
that repeat a doc_id, or have none, are each scored (those without one never train); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, grams, labelled_sample, pieces, table, whole_text

STATISTICS = (
    "words", "mean_length", "sd_length", "longest", "short_share", "upper", "digit", "symbol", "bars", "other_bytes",
    "different", "top_share", "repeats", "pair_repeats", "lines", "line_length", "ends_marked", "bang",
)
SAMPLE, BINS, DEPTH, TREES, RATE, MIN_HESSIAN, L2 = 8192, 64, 4, 80, 0.15, 2.0, 1.0
MODULUS, HELD_OUT, THRESHOLD = 5, 0, 0.3

_CLASS = {"upper": range(65, 91), "digit": range(48, 58), "symbol": [i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,;:'\"?"], "bars": [124], "other_bytes": range(128, 256), "line": [10], "bang": [33]}


def _flags(name: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(_CLASS[name])] = True
    return out


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text."""
    words, n = Words(texts), len(texts)
    length, text = (words.end - words.start).astype(float), words.text
    count = np.bincount(text, minlength=n)
    some, bytes_ = np.maximum(count, 1), np.maximum(np.diff(words.offsets), 1)
    out = {"words": np.log1p(count)}
    total = np.bincount(text, length, n)
    out["mean_length"] = total / some
    out["sd_length"] = np.sqrt(np.maximum(np.bincount(text, length**2, n) / some - out["mean_length"] ** 2, 0))
    out["longest"] = np.zeros(n)
    np.maximum.at(out["longest"], text, length)
    out["short_share"] = np.bincount(text, length <= 3, n) / some
    marks = {}
    for name in _CLASS:
        sums = np.zeros(len(words.data) + 1, np.int64)
        np.cumsum(_flags(name)[words.data], out=sums[1:])
        marks[name] = np.diff(sums[words.offsets])
    out |= {k: marks[k] / bytes_ for k in ("upper", "digit", "symbol", "bars", "other_bytes", "bang")}
    out["lines"], out["line_length"] = np.log1p(marks["line"]), np.log1p(bytes_ / (marks["line"] + 1))
    hashes = words.hashes()
    salt = text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for name, h, of in (("different", hashes, text), ("pair_repeats", grams(hashes, 2), text[: max(0, len(text) - 1)])):
        _, at, times = np.unique(h ^ salt[: len(h)], return_index=True, return_counts=True)
        kinds = np.bincount(of[at], minlength=n)
        if name == "different":
            out["different"] = kinds / some
            out["top_share"] = np.zeros(n)
            np.maximum.at(out["top_share"], of[at], times)
            out["top_share"] /= some
        else:
            out["pair_repeats"] = 1 - kinds / some
    same = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    out["repeats"] = np.bincount(text[1:], same, n) / some
    last = words.data[words.end - 1] if len(text) else np.zeros(0, np.uint8)
    out["ends_marked"] = np.bincount(text, np.isin(last, [33, 35, 36, 37, 38, 42, 124]), n) / some
    return np.stack([out[k] for k in STATISTICS], 1)


@dataclass
class Forest:
    """Complete trees of DEPTH levels in arrays: node i has children 2i + 1 and 2i + 2; a node goes right where value > cut."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        z, each = np.full(len(rows), self.base), np.arange(len(rows))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (rows[each, feature[at]] > cut[at])
            z += leaf[at - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(rows: np.ndarray, label: np.ndarray) -> Forest:
    """Histogram boosting: every level's gradient and curvature sums by (node, statistic, bin), best split of each node."""
    n, inner = len(label), 2**DEPTH - 1
    share = (label.sum() + 0.5) / (n + 1)
    z, trees = np.full(n, np.log(share / (1 - share))), []
    if not n or label.min() == label.max():
        return Forest(float(z[0]) if n else 0.0, *(np.zeros((0, inner), t) for t in (np.int64, float)), np.zeros((0, inner + 1)))
    width = rows.shape[1]
    edges = np.quantile(rows, np.linspace(0, 1, BINS + 1)[1:-1], axis=0)
    binned = np.stack([np.searchsorted(edges[:, f], rows[:, f], "left") for f in range(width)], 1)
    slot = binned + np.arange(width) * BINS
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = p - label, p * (1 - p)
        feature, cut, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, many = 2**level - 1, 2**level
            key = ((node - first)[:, None] * width * BINS + slot).ravel()
            sums = [np.bincount(key, np.repeat(x, width), many * width * BINS).reshape(many, width, BINS).cumsum(2) for x in (g, h)]
            (gl, hl), (gt, ht) = sums, (s[:, :, -1:] for s in sums)
            gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
            gain[(hl < MIN_HESSIAN) | (ht - hl < MIN_HESSIAN)] = 0
            gain = gain[:, :, :-1].reshape(many, -1)
            best = gain.argmax(1)
            take = gain[np.arange(many), best] > 1e-6
            feature[first : first + many] = np.where(take, best // (BINS - 1), 0)
            cut[first : first + many] = np.where(take, edges[best % (BINS - 1), best // (BINS - 1)], np.inf)
            node = 2 * node + 1 + (rows[np.arange(n), feature[node]] > cut[node])
        node -= inner
        leaf = -RATE * np.bincount(node, g, inner + 1) / (np.bincount(node, h, inner + 1) + L2)
        z = z + leaf[node]
        trees.append((feature, cut, leaf))
    return Forest(float(np.log(share / (1 - share))), *(np.stack(x) for x in zip(*trees, strict=True)))


def _measured(rows: DataFrame) -> DataFrame:
    """The rows with ``stats`` in place of ``text``."""
    others = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                stats = pa.FixedSizeListArray.from_arrays(pa.array(statistics(part.column("text")).ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
                yield pa.record_batch([*(part.column(f.name) for f in others), stats], [*(f.name for f in others), "stats"])

    return rows.mapInArrow(run, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in others), "stats array<double>"]))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Forest:
    """Fit on the bounded sample: at most SAMPLE rows of statistics reach the driver."""
    rows = _measured(labelled_sample(docs, labels, label, MODULUS, HELD_OUT, SAMPLE)).toArrow().combine_chunks().sort_by("doc_id")
    stats = rows.column("stats").combine_chunks().flatten().to_numpy().reshape(-1, len(STATISTICS))
    return fit(stats, rows.column("label").to_numpy().astype(float))


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                yield pa.record_batch([part.column("doc_id"), pa.array(shared.value.score(statistics(part.column("text"))))], ["doc_id", "score"])

    scored = whole_text(docs).mapInArrow(run, "doc_id long, score double")
    held = F.crc32(F.col("doc_id").cast("string")) % MODULUS == HELD_OUT
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
