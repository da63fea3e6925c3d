"""The arithmetic of the two classifiers against plain versions, and awkward rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import SCHEMA, TEXTS, prose
from trackloom.llm import quality, toxicity


def ranked(score, label):
    """Area under the curve."""
    place = np.argsort(np.argsort(score))
    return (place[label == 1].mean() - place[label == 0].mean()) / len(score) + 0.5


def test_machine_learns_what_weights_alone_cannot():
    rng, texts, labels = random.Random(5), [], []
    for i in range(4000):
        words, one, other = prose(i, 30).split(), rng.random() < 0.5, rng.random() < 0.5
        for word in ["alpha"] * one + ["omega"] * other:
            words.insert(rng.randrange(30), word)
        texts.append(" ".join(words))
        labels.append(float(one != other))
    label = np.array(labels)
    text, slot = toxicity.terms(pa.array(texts))
    fitted = text < 3000
    machine = toxicity.fit(text[fitted], slot[fitted], label[:3000])
    held = toxicity.terms(pa.array(texts[3000:]))
    assert ranked(machine.score(*held, 1000), label[3000:]) > 0.95
    linear = toxicity.Machine(machine.place, machine.bias, machine.w, np.zeros_like(machine.v))
    assert ranked(linear.score(*held, 1000), label[3000:]) < 0.6


def test_machine_scores_as_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    listed = ["one two three", "two", "", "three one one four"]
    text, slot = toxicity.terms(pa.array(listed))
    place = np.full(1 << toxicity.BITS, -1, np.int16)
    known = np.unique(slot)[::2]
    place[known] = np.arange(len(known))
    machine = toxicity.Machine(place, 0.3, rng.normal(size=len(known)), rng.normal(size=(len(known), 3)))
    for i, got in enumerate(machine.score(text, slot, len(listed))):
        own = [int(place[s]) for s in slot[text == i] if place[s] >= 0]
        z = 0.3 + sum(machine.w[k] for k in own) + sum(machine.v[a] @ machine.v[b] for n, a in enumerate(own) for b in own[n + 1 :])
        assert got == pytest.approx(1 / (1 + math.exp(-z)))


def test_near_copies_are_one_group():
    texts = [prose(i, 80) for i in range(40)]
    texts += [t.replace(t.split()[7], "changed") for t in texts[:10]]
    group = toxicity.near_copies(*toxicity.terms(pa.array(texts)), 50)
    assert all(group[i] == group[40 + i] for i in range(10)) and len(set(group[:40].tolist())) == 40


def plain_tree(rows, label, edges):
    """The first tree's splits by trying every cut of every statistic, node by node."""
    share = (label.sum() + 0.5) / (len(label) + 1)
    g, h = share - label, np.full(len(label), share * (1 - share))
    out = []

    def grow(own, depth):
        if depth == quality.DEPTH:
            out.append((own.tolist(), -quality.RATE * g[own].sum() / (h[own].sum() + quality.L2)))
            return
        best, chosen = 1e-6, None
        for f in range(rows.shape[1]):
            for b, edge in enumerate(edges[:, f]):
                left = own[rows[own, f] <= edge]
                right = own[rows[own, f] > edge]
                if min(h[left].sum(), h[right].sum()) < quality.MIN_HESSIAN:
                    continue
                parts = [g[x].sum() ** 2 / (h[x].sum() + quality.L2) for x in (left, right, own)]
                if parts[0] + parts[1] - parts[2] > best * (1 + 1e-9):
                    best, chosen = parts[0] + parts[1] - parts[2], (f, edge)
        if chosen is None:
            grow(own, depth + 1)
            grow(own[:0], depth + 1)
            return
        f, edge = chosen
        grow(own[rows[own, f] <= edge], depth + 1)
        grow(own[rows[own, f] > edge], depth + 1)

    grow(np.arange(len(label)), 0)
    return out


def test_histogram_tree_equals_a_plain_search(monkeypatch):
    monkeypatch.setattr(quality, "BINS", 8)
    monkeypatch.setattr(quality, "TREES", 1)
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(300, 3))
    label = (rows[:, 0] + rows[:, 1] * rows[:, 2] + rng.normal(size=300) * 0.3 > 0).astype(float)
    forest = quality.fit(rows, label)
    edges = np.quantile(rows, np.linspace(0, 1, 9)[1:-1], axis=0)
    expected = np.zeros(300)
    for own, leaf in plain_tree(rows, label, edges):
        expected[own] = leaf
    got = np.log(forest.score(rows) / (1 - forest.score(rows))) - forest.base
    assert np.allclose(got, expected)


def test_flattened_forest_equals_walking_its_trees():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(200, 5))
    label = (rows[:, 0] * rows[:, 1] > 0).astype(float)
    forest = quality.fit(rows, label)
    for row, got in zip(rows, forest.score(rows), strict=True):
        z = forest.base
        for feature, cut, leaf in zip(forest.feature, forest.cut, forest.leaf, strict=True):
            at = 0
            while at < 2**quality.DEPTH - 1:
                at = 2 * at + (2 if row[feature[at]] > cut[at] else 1)
            z += leaf[at - (2**quality.DEPTH - 1)]
        assert got == pytest.approx(1 / (1 + math.exp(-z)))
    assert ((forest.score(rows) > 0.5) == (label == 1)).mean() > 0.9


@pytest.mark.parametrize(("module", "label"), [(toxicity, "toxic"), (quality, "quality")])
def test_awkward_rows_are_each_scored(spark, module, label):
    rows = [(i, t, "en", None, 1, 7, "clash", 3, 0.5) for i, t in enumerate([*TEXTS, "word " * 300_000])]
    docs = spark.createDataFrame([*rows, (None, "no id", *rows[0][2:]), *rows[3:5]], SCHEMA).repartition(3)
    labels = spark.range(0, len(TEXTS)).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality", "cast(id % 2 AS int) AS toxic", "0.1D AS score", "'x' AS text")
    out = module.score(docs, module.train(docs, labels)).collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in out) == sorted([*range(len(rows)), -1, 3, 4])
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add(r.score)
        assert 0 <= r.score <= 1 and (r.held_out is None) == (r.doc_id is None)
    assert all(len(x) == 1 for x in by.values()) and by[0] == by[1] and by[7] == by[8]
    assert module.score(docs, module.train(docs, labels.withColumn(label, F.lit(1)))).filter("score < 0.5").isEmpty()
