"""Suffix-array dedup with sparse suffix arrays.

Suffixes are retained only where a window of WINDOW words has its minimiser, a run of GRAM words chosen by content, so
equal passages retain the same suffixes. Retained suffixes meet by minimiser; each shard sorts them by what follows,
compares neighbours for the length of their common prefix (the match to the right), and extends to the left by refining
the classes of what precedes. Windows of WINDOW words that several documents hold come out with the first document and
are joined into maximal passages of the same first document.

The result has a row for each passage of a later document that an earlier one holds: doc_id, first_doc_id (the earliest
holder of each repeated window in it), start and n_words in words. Where the earliest holder changes a new row begins,
so rows of different holders may overlap or touch. Documents that share nothing have no row.

Shards are bounded in words (SHARD_WORDS); a minimiser whose segments exceed the bound is cut by minimisers of longer runs.

Defined results: null text has no words; rows that repeat a doc_id do not match each other; rows without one match nothing; a repeat inside one document
alone is none; texts shorter than a window never match; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, grams, table
from .passages import by_shards, candidates, repeated_windows

WINDOW, GRAM = 50, 8
#: Words that one sparse suffix array takes before the next is begun, and beyond which a minimiser is cut by longer ones.
SHARD_WORDS = 40_000


def holders(texts: list[str], anchors: np.ndarray, first: np.ndarray, size: int, gram: int) -> list[np.ndarray]:
    """For each segment (words joined by single spaces, its anchor and smallest doc_id), the smallest doc_id that holds each of its windows."""
    words = Words(pa.array(texts))
    numbers: dict[str, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for t in texts for w in t.split(" ")], np.int64)
    begins, ends = words.first[:-1], words.first[1:]
    windows = ends - begins - size + 1
    runs = grams(words.hashes(), gram)
    of = words.text[: len(runs)]
    at = np.flatnonzero((runs.view(np.int64) == anchors[of]) & (np.arange(len(runs)) + gram <= ends[of]))
    row = words.text[at]
    n, left = len(at), size - gram
    # What follows each retained suffix, padded so that nothing equals what lies beyond a segment's end.
    reach = at[:, None] + np.arange(size)
    after = np.where(reach < ends[row][:, None], ids[np.minimum(reach, len(ids) - 1)], -1 - np.arange(n)[:, None])
    order = np.lexsort([*after.T[::-1], anchors[row]])
    at, row, after = at[order], row[order], after[order]
    common = np.zeros(n, np.int64)
    common[1:] = np.cumprod(after[1:] == after[:-1], axis=1).sum(1)
    common[1:][anchors[row[1:]] != anchors[row[:-1]]] = 0
    offsets = np.r_[0, np.cumsum(windows)]
    least = np.full(offsets[-1], np.iinfo(np.int64).max)
    before = np.zeros(n, np.int64)
    for shift in range(left + 1):
        start = at - shift
        if shift:  # refine the classes of what precedes by one more word
            word = np.where(start >= begins[row], ids[np.maximum(start, 0)], -1 - np.arange(n))
            before = np.unique(np.stack([before, word]), axis=1, return_inverse=True)[1].ravel()
        run = np.cumsum(common < size - shift)
        window = start - begins[row]
        here = np.flatnonzero((window >= 0) & (window < windows[row]))
        if not len(here):
            continue
        _, group = np.unique(run[here] * (n + 1) + before[here], return_inverse=True)
        low = np.full(group.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(low, group, first[row[here]])
        least[offsets[row[here]] + window[here]] = low[group]
    return [least[a:z] for a, z in zip(offsets[:-1], offsets[1:], strict=True)]


def window_holders(found: DataFrame, size: int, gram: int, shard_words: int) -> DataFrame:
    """anchor, wh, firsts for each different segment, as ``first_documents`` gives them."""

    def search(shard: dict[tuple[int, int, str], int], run: int) -> list[list[int]]:
        anchors = np.array([k[0] for k in shard], np.int64)
        return [x.tolist() for x in holders([k[2] for k in shard], anchors, np.array(list(shard.values()), np.int64), size, run)]

    return by_shards(found, search, size, gram, shard_words)


def suffix_dedup(docs: DataFrame, size: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, first_doc_id, start, n_words for each maximal passage whose windows the same earlier document holds first."""
    found = candidates(docs, size, gram)
    hits = repeated_windows(found, window_holders(found, size, gram, shard_words))
    hits = hits.groupBy("doc_id", "th").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))
    # Bounded by one document's words: consecutive windows join to a passage as long as they touch and have the same first document.
    joined = f"""aggregate(hits, cast(array() AS array<struct<start: bigint, stop: bigint, d: bigint>>), (a, x) ->
      CASE WHEN size(a) > 0 AND x.at <= element_at(a, -1).stop AND x.d = element_at(a, -1).d
        THEN concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).start AS start, x.at + {size} AS stop, element_at(a, -1).d AS d)))
        ELSE concat(a, array(struct(x.at AS start, x.at + {size} AS stop, x.d AS d))) END)"""
    return hits.select("doc_id", F.expr(f"inline({joined})")).select("doc_id", F.col("d").alias("first_doc_id"), "start", (F.col("stop") - F.col("start")).alias("n_words"))


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT r, doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM t WHERE len(w) >= 50),
g AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS d FROM g GROUP BY h),
c AS (SELECT r, doc_id, i, d FROM g JOIN f USING (h) WHERE d < doc_id),
n AS (SELECT *, CASE WHEN lag(d) OVER o = d AND i - lag(i) OVER o <= 50 THEN 0 ELSE 1 END AS fresh FROM c WINDOW o AS (PARTITION BY r ORDER BY i)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS k FROM n)
SELECT any_value(doc_id) AS doc_id, any_value(d) AS first_doc_id, min(i) - 1 AS start, max(i) - min(i) + 50 AS n_words FROM s GROUP BY r, k
"""
