"""Cases where an operator once did less than the whole job, each against a brute-force version."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_operators import prose
from trackloom.llm import decontaminate, pieces_codec, secret_scan, suffix_dedup, wavelet


def test_decontamination_finds_every_copy_of_an_edited_version(spark):
    rng = random.Random(8)
    item = [f"w{k}" for k in range(38)]
    edited = [f"other{k}" if k % 6 == 5 or 12 <= k < 24 and k % 3 == 2 else w for k, w in enumerate(item)]
    texts = [prose(500, 30) + " " + " ".join(item) + " " + prose(501, 30)]
    texts += [prose(600 + i, 70) + " " + " ".join(edited) + " " + prose(700 + i, 70) for i in range(50)]
    texts += [prose(800, 70) + " " + " ".join(edited) + " " + prose(801, 70)] * 30
    texts += [prose(900 + i, 20) + " w0 w1 w2 w3 " + prose(950 + i, 20) for i in range(30)]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(0, " ".join(item)), (1, prose(600, 40)), (2, prose(77, 40))], "item_id long, text string")
    expected = {}
    for j, t in ((r.item_id, r.text.split()) for r in items.collect()):
        runs = {tuple(t[k : k + 4]) for k in range(len(t) - 3)}
        for i, d in enumerate(x.split() for x in texts):
            numbers = {}
            a, b = (np.array([[numbers.setdefault(w, len(numbers)) for w in x]], np.int32) for x in (t, d))
            score = decontaminate.align(a, b)[0][0] / (2 * len(t))
            if score >= 0.5 and any(tuple(d[k : k + 4]) in runs for k in range(len(d) - 3)):
                expected[i, j] = round(float(score), 6)
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs, items).collect()}
    assert found == expected and sum(j == 0 for _, j in found) == 81


@pytest.mark.parametrize("options", [{}, {"shard_words": 1}])
def test_suffix_dedup_names_every_source_of_a_span(spark, options):
    one, two, three, rest = (prose(1000 + i, n) for i, n in enumerate((60, 60, 80, 60)))
    listed = [one + " " + prose(1010, 9), two, prose(1011, 9) + " " + three, three + " " + rest, f"{one} {two}", f"{prose(1012, 7)} {three} {rest} {one}"]
    first, expected = {}, []
    for i, w in enumerate(x.split() for x in listed):
        rows = []
        for j in range(len(w) - 49):
            d = first.setdefault(tuple(w[j : j + 50]), i)
            if d < i:
                if rows and rows[-1][1] == d and j <= rows[-1][3]:
                    rows[-1][3] = j + 50
                else:
                    rows.append([i, d, j, j + 50])
        expected += [(i, d, a, z - a) for i, d, a, z in rows]
    docs = spark.createDataFrame(list(enumerate(listed)), "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, suffix_dedup.suffix_dedup(docs, **options).collect())) == sorted(expected)
    assert {(i, d) for i, d, *_ in expected} == {(3, 2), (4, 0), (4, 1), (5, 2), (5, 3), (5, 0)}


def test_pieces_of_unbroken_runs():
    sentencepiece = pytest.importorskip("sentencepiece")
    path = pieces_codec.model_path()
    model, rng = pieces_codec.Model(path), random.Random(3)
    listed = ["x" * 100_000, "".join(rng.choice("abcdefghijklmnop") for _ in range(100_000)), "é日" * 3000, "aaaa" * 20, "ab" * 50]
    began = time.process_time()
    ids, counts = model.encode(pa.array(listed))
    assert time.process_time() - began < 15  # some 3 s by itself
    assert model.decode(ids, counts) == [t.encode() for t in listed]
    for _ in range(60):  # both ways, ties included
        chars = np.array([ord(c) for c in "▁" + "".join(rng.choice("thexand日é1") for _ in range(rng.randrange(1, 90)))])
        one, other = model.segment(chars[None].astype(np.uint64)), model.segment_alone(chars)
        assert (one[0] == other[0]).all() and (one[1] == other[1]).all() and model._agree(one[0], chars) and not model._agree(one[0], chars + 1)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    listed = [prose(i, 50) for i in range(20)]
    ids, counts = model.encode(pa.array(listed))
    for t, n, z in zip(listed, counts, np.cumsum(counts), strict=True):
        assert sum(map(library.get_score, ids[z - n : z].tolist())) >= sum(map(library.get_score, library.encode(t))) - 1e-6


def test_decontamination_recall_against_exhaustive_alignment(spark):
    rng = random.Random(21)
    items = [prose(2000 + i, rng.randrange(12, 120)).split() for i in range(30)] + [prose(2100, 5000).split()]
    texts = []
    for k, item in enumerate(items * 5):
        rate, out = [0.05, 0.12, 0.2, 0.35, 0.5][k // len(items)], []
        for word in item:
            way = rng.random() / rate
            out += [word] if way > 1 else [] if way > 0.8 else [word, "more"] if way > 0.6 else [f"edit{rng.randrange(999)}"]
        texts.append(prose(3000 + k, 25) + " " + " ".join(out) + " " + prose(4000 + k, 25))
    expected = set()
    for i, d in enumerate(texts):
        for j, t in enumerate(items):
            if len(t) < 1000 and len(d) < 4000 or i % len(items) == j:
                numbers = {}
                a, b = (np.array([[numbers.setdefault(w, len(numbers)) for w in x]], np.int32) for x in (t, d.split()))
                if decontaminate.align(a, b)[0][0] >= len(t):
                    expected.add((i, j))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = decontaminate.contaminated(docs, spark.createDataFrame([(j, " ".join(t)) for j, t in enumerate(items)], "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    print(f"recall {len(got & expected)} of {len(expected)}")
    assert len(expected) > 110 and got <= expected and len(got) >= 0.95 * len(expected)


def test_decontamination_reaches_as_far_as_an_alignment(spark):
    """Words between the item's own push its end away from the only seeds, and the score still reaches the threshold."""
    item = [f"w{k}" for k in range(32)]
    spread = item[:4] + [x for w in item[4:] for x in ("filler", w)]
    other = [x for w in item[:-4] for x in (w, "filler")] + item[-4:]
    rows = [(0, " ".join(item)), (1, " ".join(spread)), (2, prose(41, 50) + " " + " ".join(other) + " " + prose(42, 50)), (3, prose(43, 90) + " " + " ".join(item[:5]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item)), (8, "w0 w1 w2")], "item_id long, text string")
    found = {r.doc_id: (r.item_id, r.score) for r in decontaminate.contaminated(docs, items).collect()}
    assert found == {0: (7, 1.0), 1: (7, 0.5625), 2: (7, 0.5625)}
    assert [r.doc_id for r in decontaminate.decontaminated(docs, items).collect()] == [3]


def test_secret_parts_of_one_long_text_take_linear_time(spark):
    key = "k" * 31 + "1"
    text = " ".join(f"{key} http://h{i}.example" if i % 900 else f"AKIA{'B' * 16} {key} http://h{i}.example" for i in range(32_000))
    docs = spark.createDataFrame([(1, text), (2, key)], "doc_id long, text string")
    secret_scan.secret_scan(docs).count()
    began = time.time()
    found = {r.doc_id: r for r in secret_scan.secret_scan(docs).collect()}
    took = time.time() - began
    print(f"64,000 parts: {took:.1f} s")
    assert found[1].n_access == 36 and found[1].spans.count("linked_key") > 36 and found[2].spans == ""
    assert took < 30  # some 5 s by itself; the square of the parts took minutes


def test_ids_beyond_the_planes_raise():
    with pytest.raises(ValueError, match="70000 does not fit 16 planes"):
        wavelet.WaveletShard.build(np.array([1, 70000], np.uint32), np.array([0]), np.array([2]))
    shard = wavelet.WaveletShard(wavelet.WaveletShard.build(np.array([1, 70000, 2], np.uint32), np.array([0]), np.array([3]), bits=17))
    assert shard.tokens().tolist() == [1, 70000, 2] and shard.count(70000) == 1 and shard.occurrences(2).tolist() == [2]


def test_decontamination_judges_rows_one_by_one(spark):
    item = prose(31, 40)
    rows = [(1, prose(32, 30) + " " + item), (1, prose(33, 60)), (None, item), (None, prose(34, 60)), (2, item + " " + item), (3, None)]
    docs = spark.createDataFrame([(i, t, 7, "x", 1) for i, t in rows], "doc_id long, text string, item_id long, words string, at int")
    items = spark.createDataFrame([(5, item), (5, item), (None, prose(33, 50)), (6, item)], "item_id long, text string")
    found = sorted((r.doc_id or -1, r.item_id, r.score, r.item_words, r.end_word) for r in decontaminate.contaminated(docs, items).collect())
    assert found == [(i, j, 1.0, 40, end) for i, end in ((-1, 40), (1, 70), (2, 40)) for j in (5, 6)]
    left = decontaminate.decontaminated(docs, items)
    assert left.columns == docs.columns and sorted((r.doc_id or -1, r.text or "") for r in left.collect()) == sorted([(1, rows[1][1]), (-1, rows[3][1]), (3, "")])
