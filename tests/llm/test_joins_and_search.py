"""Jaccard join, ranked search and vector codes against plain versions."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from tests.llm.test_operators import SCHEMA, TEXTS, docs, empty, lowered, prose, texts  # noqa: F401
from trackloom.llm import jaccard_join, ranked_search, vector_codes
from trackloom.llm.jaccard_join import joined


def plain_join(rows, size=3, percent=90):
    sets = []
    for _, t in rows:
        w = lowered(t or "").encode().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def result(rows, spark, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted(map(tuple, joined(df, **options).collect()), key=repr)


def test_join_of_awkward_rows(spark, docs, empty):  # noqa: F811
    assert sorted(map(tuple, joined(docs).collect()), key=repr) == plain_join(texts())
    assert joined(empty).count() == 0
    rows = [(None, prose(1, 30)), (None, prose(1, 30)), (None, ""), (4, prose(2, 30)), (None, prose(2, 30)), (4, prose(3, 30)), (4, None)]
    assert result(rows, spark) == plain_join(rows)


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"filter_bits": 1 << 20, "percent": 80, "size": 2}), (3, {})])
def test_join_of_families_of_copies(spark, seed, options):
    """Families of light and heavy edits, chains whose ends are far apart, and passages that unrelated texts share."""
    rng = random.Random(seed)
    shared, texts_ = prose(seed + 70, 25), []
    for family in range(5):
        words = prose(100 * seed + family, rng.choice([12, 40, 90, 200])).split()
        for _ in range(30):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(9999)}"
            texts_.append(" ".join(copy))
    chain = prose(seed + 50, 120).split()
    for k in range(25):  # each links with the next one alone
        chain[(4 * k) % 120] = f"link{k}"
        texts_.append(" ".join(chain))
    texts_ += [f"{shared} {prose(3000 + i, 3)}" for i in range(40)] + [prose(4000 + i, 60) + " " + shared for i in range(20)]
    texts_ += [" ".join(f"s{i}" for i in range(n)) for n in range(1, 14)]
    rng.shuffle(texts_)
    rows = list(enumerate(texts_))
    want = plain_join(rows, options.get("size", 3), options.get("percent", 90))
    assert result(rows, spark, **options) == want
    assert len({c for _, _, c in want}) > 40 and max(sum(c == x for _, _, c in want) for x in {c for *_, c in want}) > 15


def test_large_groups_of_near_copies_make_few_pairs(spark, monkeypatch):
    rng, words, made = random.Random(5), prose(9, 150).split(), []
    rows = []
    for i in range(600):
        copy = list(words)
        copy[rng.randrange(150)] = f"edit{i}"
        rows.append((i, " ".join(copy)))
    keep = jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, *rest: made.append(pairs.count()) or keep(pairs, *rest))
    assert result(rows, spark) == plain_join(rows)
    assert sum(made) < 4 * len(rows)  # of some 180,000 pairs


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_ranks(rows, items, top=10):
    bags = [TERM.findall(lowered(t or "")) for _, t in rows]
    n_docs, n_terms = sum(map(bool, bags)), sum(map(len, bags))
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, _), bag in zip(rows, bags, strict=True):
            total = 0
            for term in set(TERM.findall(lowered(text or ""))):
                tf = bag.count(term)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(term in b for b in bags) + 1)))
                    total += w * (1_000_000_000 * tf // (1000 * tf + 8 * (10 + 90 * len(bag) * n_docs // n_terms)))
            if total > 0:
                scores.append((-total, doc_id is None, doc_id))
        out += [(item_id, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"block_terms": 40, "top": 3}])
def test_ranked_search(spark, docs, empty, options, monkeypatch):  # noqa: F811
    monkeypatch.setattr(ranked_search, "LONGEST", 5)
    rows = [(i, t) for i, t in texts()] + [(1000 + i, prose(5000 + i % 90, 20 + i % 7)) for i in range(150)] + [(None, prose(5001, 30))]
    items = [(i, prose(5000 + i, 12)) for i in range(12)] + [(3, "one TWO école x" + "x" * 29999), (3, None), (None, "la la LA"), (50, "nowhere-to-be found9"), (51, prose(5, 90)), (52, "")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, item_id long, score string").repartition(5)
    asked = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id long")
    found = sorted(map(tuple, ranked_search.ranked(df, asked, **options).collect()), key=repr)
    assert found == plain_ranks(rows, items, options.get("top", 10))
    assert ranked_search.ranked(empty, asked).count() == 0 and ranked_search.ranked(df, asked.limit(0)).count() == 0


def test_bounds_leave_out_vectors_but_no_result(spark):
    """Thresholds prune most vectors of most items, and what they prune scores less."""
    rng = np.random.default_rng(3)
    n, size = 400, 60
    dense = np.where(rng.random((n, size)) < 0.2, rng.integers(1, 10**6, (n, size)), 0)
    dense = dense[np.argsort(-np.sqrt((dense.astype(float) ** 2).sum(1)))]
    row, at = np.nonzero(dense)
    ends, value = np.searchsorted(row, np.arange(n + 1)), dense[row, at]
    length = np.sqrt((dense.astype(float) ** 2).sum(1)) * (1 + ranked_search.ROOM)
    terms = [rng.choice(size, rng.integers(1, 9), replace=False) for _ in range(50)]
    weights = [np.sort(rng.integers(1, 9000, len(t)))[::-1].copy() for t in terms]
    norm = np.array([math.sqrt((w.astype(float) ** 2).sum()) for w in weights]) * (1 + ranked_search.ROOM)
    queries = ranked_search.Queries(list(range(50)), terms, weights, norm, np.zeros(50, np.int64))
    scores = np.array([dense[:, t] @ w for t, w in zip(terms, weights, strict=True)])
    floor = np.sort(scores, 1)[:, -10]
    seen = {q: dict(zip(hit.tolist(), s.tolist(), strict=True)) for q, hit, s in ranked_search._bucket(queries, floor, length, ends, at, value, size)}
    assert all(seen.get(q, {}) == {d: int(scores[q, d]) for d in np.flatnonzero(scores[q] >= max(1, floor[q]))} for q in range(50))
    one = ranked_search.Queries([0], terms[:1], weights[:1], norm[:1], np.zeros(1, np.int64))
    assert not list(ranked_search._bucket(one, np.array([2**62]), length, ends, at, value, size))


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(x * scale) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda x: (x[0] is None, x[0], x[1]))
    size = len(kept[0][1]) // parts
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for c in cut:
                groups.setdefault(best(c[p], book)[1], []).append(c[p])
            books[p] = [[sum(x) // len(groups[e]) for x in zip(*groups[e], strict=True)] if e in groups else c for e, c in enumerate(book)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    found = [[best(c[p], books[p]) for p in range(parts)] for c in cut]
    sums = {}
    for (_, _, label), f in zip(kept, found, strict=True):
        sums[label] = sums.get(label, 0) + sum(d for d, _ in f)
    return sorted(((i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), sums[label], digest) for (i, _, label), f in zip(kept, found, strict=True)), key=repr)


VECTORS = "vec_id long, embedding array<float>, label int, v string, code int, error double"


@pytest.mark.parametrize("n, options", [(150, {}), (9, {}), (80, {"parts": 2, "entries": 5, "rounds": 2})])
def test_vector_codes(spark, n, options):
    rng = np.random.default_rng(n)
    rows = [(int(i), rng.normal(0, 0.2, 16).astype(np.float32).tolist(), int(rng.integers(3)) if i % 4 else None) for i in rng.permutation(n)]
    rows += [(2, rows[0][1], 1), (2, rows[0][1], 1), (None, rows[1][1], 2), (1, None, 1), (0, [None] * 16, 1), (3, [float("nan")] * 16, None), (4, [0.1] * 15 + [float("-inf")], 0)]
    rows += [(10_000 + i, [0.25] * 16, 7) for i in range(40)]  # ties
    df = spark.createDataFrame([(i, v, label, "x", 1, 0.5) for i, v, label in rows], VECTORS).repartition(3)
    found = sorted(map(tuple, vector_codes.compressed(df, **options).collect()), key=repr)
    assert found == plain_codes(rows, **options)


def test_vector_codes_of_other_lengths_and_none(spark):
    assert vector_codes.compressed(spark.createDataFrame([], VECTORS)).count() == 0
    rows = [(i, [0.5 * i] * 8, None, "x", 1, 0.5) for i in range(4)] + [(9, [1.0] * 3, 5, "x", 1, 0.5), (8, [], 5, "x", 1, 0.5)]
    found = {r.vec_id: r for r in vector_codes.compressed(spark.createDataFrame(rows, VECTORS)).collect()}
    assert len(found) == 6 and found[9].code is None and found[8].error is None and found[3].code == "03" * 8 and found[3].error == 0
    for bad in ([1e9] * 8, [0.0] * 9):
        with pytest.raises(Exception, match="too large|do not divide"):
            vector_codes.compressed(spark.createDataFrame([(1, bad, None, "x", 1, 0.5)], VECTORS)).collect()


def test_equal_average_search_is_exhaustive_search():
    rng = np.random.default_rng(1)
    for spread in (2, 40, 5000):
        parts, book = rng.integers(-spread, spread, (700, 8)), rng.integers(-spread, spread, (16, 8))
        book[3] = book[11]
        far = ((parts[:, None] - book[None]) ** 2).sum(2)
        found, best = vector_codes.nearest(parts, book)
        assert (found == far.argmin(1)).all() and (best == far.min(1)).all()


def test_parities_bound_the_difference():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 64, rng.integers(0, 900), dtype=np.uint64)) for _ in range(12)]
    sets += [np.delete(sets[3], [0, 5]), np.unique(np.r_[sets[4], np.uint64(77)])]
    text, value = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
    bits = jaccard_join._parities(text, value, len(sets)).reshape(len(sets), -1)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert np.bitwise_count(bits[i] ^ bits[j]).sum() <= len(np.setxor1d(a, b))
    assert np.bitwise_count(bits[3] ^ bits[12]).sum() == 2 and np.bitwise_count(bits[4] ^ bits[13]).sum() == 1
