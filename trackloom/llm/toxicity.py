"""Toxicity by a factorization machine over hashed terms.

A text's features are which of its terms occur: lower-cased words and their first 4 and 5 bytes, hashed to 2**BITS
slots. Two kinds of slots keep a weight and RANK latent factors: those that tell the classes apart alone (chi-squared), and
those of pairs that do so together though neither does alone, as an insult that is only one beside a group's name. Rows
that are near copies of each other count as one, so that a text copied often does not make its words evidence. The score is

    sigmoid(bias + sum w_i + (|sum v_i|^2 - sum |v_i|^2) / 2)

Training takes a documented bounded sample of labelled rows (SAMPLE, chosen by a hash of the id); scoring covers every
whole text. The model has a fixed size, whatever the input.

Defined results: null text counts as empty; an empty text scores the bias alone; with no labelled rows every score is
0.5, and with one class only it is that class's smoothed share; rows that repeat a doc_id, or have none, are each scored,
equal texts alike (a row without a doc_id is in no fold: held_out is null); an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BREAKS, Words, labelled_sample, mix, pieces, table, whole_text

BITS, RANK, SLOTS, MIN_DOCS, SAMPLE, STEPS = 22, 4, 1024, 4, 8192, 200
#: Least chi-squared of a slot, what a toxic row counts in the loss, and decay of weights and of factors (over the sample's size).
GAIN, TOXIC_COUNTS, DECAY_W, DECAY_V = 20, 3, 1, 1
#: Slots among which pairs are looked for, least chi-squared of a pair, most pairs; keys of near copies and least hashes in each.
PAIR_SLOTS, PAIR_GAIN, PAIRS = 2048, 45, 64
BANDS, WIDTH = 16, 4
MODULUS, HELD_OUT, THRESHOLD = 4, 2, 0.3


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text index, slot) of each different term slot of each text, in order of the text."""
    words = Words(texts, lower=True, between=BREAKS)
    whole, four, five = words.hashes(4, 5)
    salted = (whole, four ^ np.uint64(0x5555555555555555), five ^ np.uint64(0x3333333333333333))
    slot = np.concatenate([h >> np.uint64(64 - BITS) for h in salted])
    pair = np.unique(np.tile(words.text, 3).astype(np.uint64) << np.uint64(BITS) | slot)
    return (pair >> np.uint64(BITS)).astype(np.int64), (pair & np.uint64((1 << BITS) - 1)).astype(np.int64)


@dataclass
class Machine:
    """place: for each slot its row in w and v, or -1."""

    place: np.ndarray
    bias: float
    w: np.ndarray
    v: np.ndarray

    def score(self, text: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        known = self.place[slot] >= 0
        return _sigmoid(_forward(self.bias, self.w, self.v, text[known], self.place[slot[known]], n)[0])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _forward(bias, w, v, text, place, n):
    sums = np.stack([np.bincount(text, v[place, f], n) for f in range(v.shape[1])], 1)
    squares = np.bincount(text, (v[place] ** 2).sum(1), n)
    return bias + np.bincount(text, w[place], n) + ((sums**2).sum(1) - squares) / 2, sums


def near_copies(text: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
    """A group number for each row: rows that share most of their uncommon slots, by BANDS keys of WIDTH least hashes, are one group."""
    rare = np.bincount(slot, minlength=1 << BITS)[slot] <= 2 + n // 100
    text, slot = text[rare], slot[rare]
    label = np.arange(n)
    if not len(text):
        return label
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    row, bands = text[first], np.zeros((BANDS, len(first)), np.uint64)
    for a in range(0, len(first), 256):  # some rows at a time, as each slot is hashed anew for each least hash
        z = min(a + 256, len(first))
        some = slot[first[a] : first[z] if z < len(first) else len(slot)].astype(np.uint64)
        for band in range(BANDS):
            for i in range(WIDTH):
                bands[band, a:z] = mix(bands[band, a:z] + np.minimum.reduceat(mix(some + np.uint64((band * WIDTH + i + 1) << 32)), first[a:z] - first[a]))
    keys = [np.unique(key, return_inverse=True)[1].ravel() for key in bands]
    while True:
        before = label.copy()
        for key in keys:
            least = np.full(len(first), n)
            np.minimum.at(least, key, label[row])
            label[row] = least[key]
        if (label == before).all():
            return np.unique(label, return_inverse=True)[1].ravel()


def _gain(seen, bad, n, share):
    """Chi-squared of an indicator that holds in ``seen`` of ``n`` rows, ``bad`` of them toxic."""
    spread = seen * np.clip(1 - seen / n, 1e-9, None) * share * (1 - share)
    return np.where((seen >= MIN_DOCS) & (n - seen >= MIN_DOCS), (bad - seen * share) ** 2 / np.maximum(spread, 1e-9), 0)


def paired_slots(text, slot, rows, label, seen, bad, share) -> np.ndarray:
    """Slots of pairs that tell the classes apart together (both occur, or exactly one) much better than they do alone.

    Looks at the PAIR_SLOTS most frequent slots outside everyday ones; PAIR_GAIN is far beyond what the best of all their
    pairs reaches by chance.
    """
    n, total = rows.sum(), len(rows)
    able = np.flatnonzero((seen >= max(MIN_DOCS, 0.01 * n)) & (seen <= 0.9 * n))
    able = able[np.argsort(-seen[able], kind="stable")[:PAIR_SLOTS]]
    if len(able) < 2:
        return able[:0]
    at = np.full(1 << BITS, -1, np.int32)
    at[able] = np.arange(len(able))
    here = at[slot] >= 0
    table = np.zeros((total, len(able)), np.float32)
    table[text[here], at[slot[here]]] = 1
    toxic = table[label == 1]
    alone, found = _gain(seen[able], bad[able], n, share), []
    for a in range(0, len(able), 256):
        own = slice(a, a + 256)
        both = (table[:, own] * rows[:, None].astype(np.float32)).T @ table
        both_bad = (toxic[:, own] * rows[label == 1, None].astype(np.float32)).T @ toxic
        one = seen[able][own, None] + seen[able] - 2 * both
        one_bad = bad[able][own, None] + bad[able] - 2 * both_bad
        gain = np.maximum(_gain(both, both_bad, n, share), _gain(one, one_bad, n, share))
        i, j = np.nonzero((gain > PAIR_GAIN) & (gain > 1.5 * (alone[own, None] + alone)))
        found += [(gain[k, m], a + k, m) for k, m in zip(i.tolist(), j.tolist(), strict=True) if a + k < m]
    best = sorted(found, reverse=True)[:PAIRS]
    return able[np.unique(np.array([x[1:] for x in best], np.int64).ravel())]


def fit(text: np.ndarray, slot: np.ndarray, label: np.ndarray) -> Machine:
    """Logistic loss with weight decay, by full-batch Adam steps from a fixed seed."""
    n, size = len(label), 1 << BITS
    place = np.full(size, -1, np.int16)
    share = (label.sum() + 0.5) / (n + 1)
    none = Machine(place, float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, RANK)))
    if not n or label.min() == label.max():
        return none
    _, group, times = np.unique(near_copies(text, slot, n), return_inverse=True, return_counts=True)
    rows = 1 / times[group.ravel()]  # a group of near copies counts as one row
    seen, bad = np.bincount(slot, rows[text], size), np.bincount(slot, (rows * label)[text], size)
    total, share_ = rows.sum(), (rows * label).sum() / rows.sum()
    often = np.flatnonzero(seen >= MIN_DOCS)
    gain = _gain(seen[often], bad[often], total, share_)
    best = np.argsort(-gain, kind="stable")[:SLOTS]
    chosen = np.union1d(often[best[gain[best] > GAIN]], paired_slots(text, slot, rows, label, seen, bad, share_))
    if not len(chosen):
        return none
    place[chosen] = np.arange(len(chosen))
    kept = place[slot] >= 0
    text, at = text[kept], place[slot[kept]]
    rng = np.random.default_rng(7)
    params = [np.array([none.bias]), np.zeros(len(chosen)), rng.normal(0, 0.1, (len(chosen), RANK))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        bias, w, v = params
        z, sums = _forward(bias[0], w, v, text, at, n)
        loss = (_sigmoid(z) - label) * np.where(label == 1, TOXIC_COUNTS, 1) * rows / n
        each = loss[text]
        to_v = np.stack([np.bincount(at, each * (sums[text, f] - v[at, f]), len(w)) for f in range(RANK)], 1)
        grads = [np.array([loss.sum()]), np.bincount(at, each, len(w)) + DECAY_W / n * w, to_v + DECAY_V / n * v]
        for p, g, a, b in zip(params, grads, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= 0.05 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return Machine(place, float(params[0][0]), params[1], params[2])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Machine:
    """Fit on the bounded sample: executors send term slots, at most SAMPLE rows of them, to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                text, slot = terms(part.column("text"))
                cuts = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.record_batch([part.column("doc_id"), part.column("label"), pa.ListArray.from_arrays(cuts, pa.array(slot, pa.int32()))], ["doc_id", "label", "slots"])

    sample = labelled_sample(docs, labels, label, MODULUS, HELD_OUT, SAMPLE)
    rows = sample.mapInArrow(run, "doc_id long, label int, slots array<int>").toArrow().combine_chunks().sort_by("doc_id")
    lists = rows.column("slots").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    return fit(np.repeat(np.arange(len(lengths), dtype=np.int32), lengths), lists.flatten().to_numpy(), rows.column("label").to_numpy().astype(float))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                yield pa.record_batch([part.column("doc_id"), pa.array(shared.value.score(*terms(part.column("text")), part.num_rows))], ["doc_id", "score"])

    scored = whole_text(docs).mapInArrow(run, "doc_id long, score double")
    held = F.crc32(F.col("doc_id").cast("string")) % MODULUS == HELD_OUT
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, that are not predicted toxic; one scan, and nothing is shuffled.

    All stay where the labels tell nothing: none given, one class only, or no term that tells the classes apart.
    """
    machine = train(docs, labels)
    if not len(machine.w):
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                yield part.filter(pa.array(shared.value.score(*terms(part.column("text")), part.num_rows) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
