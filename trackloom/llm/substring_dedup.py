"""Substring dedup by suffix automata of reference shards.

A word goes when a window of WINDOW consecutive words that covers it also starts in a document with a smaller doc_id.
Reference shards are made of the different segments whose anchor several documents hold (see passages.py), each with
the smallest doc_id it occurs in. A shard's suffix automaton is built over words; every state knows the smallest doc_id of
its occurrences. The segments are then streamed through the automaton for their matching statistics, which gives each
window the first document that has it.

Sending every shard to every document would make the work grow with the square of the corpus. Windows that are equal
have equal anchors, so a segment can only match within its own anchor's shard: shards travel with the segments of their
anchors instead of being broadcast, and work stays in proportion to the input. A shard is bounded in words (SHARD_WORDS);
an anchor beyond the bound is cut by longer anchors, so no automaton grows with the corpus.

Defined results: null text has no words; rows that repeat a doc_id are each reported, and do not remove words of each
other; a row without a doc_id keeps all its words and removes none; texts shorter than a window keep all words; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written
from .passages import by_shards, candidates, repeated_windows, zipped

WINDOW, GRAM = 13, 5
#: Words that one automaton takes before the next is begun, and beyond which an anchor is cut by longer ones.
SHARD_WORDS = 25_000


class Automaton:
    """Suffix automaton over words (any hashable), each state with the smallest document of its occurrences."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [None]
        self.settled = False

    def add(self, words: list, doc: int) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word, doc)

    def _state(self, length: int, doc: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.least.append(doc)
        return len(self.next) - 1

    def _clone(self, at: int, word, target: int) -> int:
        copy = self._state(self.length[at] + 1, self.least[target], dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while at != -1 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, word, doc: int) -> int:
        target = self.next[last].get(word)
        if target is not None:  # another text went this way
            if self.length[target] != self.length[last] + 1:
                target = self._clone(last, word, target)
            self.least[target] = min(self.least[target], doc)
            return target
        new, at = self._state(self.length[last] + 1, doc, {}, 0), last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at != -1:
            target = self.next[at][word]
            self.link[new] = target if self.length[target] == self.length[at] + 1 else self._clone(at, word, target)
        return new

    def settle(self) -> None:
        """Carry the smallest document from longer states to their suffixes."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            link = self.link[state]
            if link > 0:
                self.least[link] = min(self.least[link], self.least[state])
        self.settled = True

    def matches(self, words: list, size: int) -> list[int | None]:
        """For each window of ``size`` words, the smallest document that has it, or None."""
        state, length, out = 0, 0, []
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            while self.length[self.link[state]] >= size if state else False:
                state = self.link[state]
                length = self.length[state]
            if i >= size - 1:
                out.append(self.least[state] if length >= size else None)
        return out


def first_documents(found: DataFrame, size: int, gram: int, shard_words: int) -> DataFrame:
    """anchor, wh, firsts for each different segment: the smallest doc_id of each of its windows."""

    def search(shard: dict[tuple[int, int, str], int], _run: int) -> list[list[int | None]]:
        automaton, lists = Automaton(), [words.split(" ") for _, _, words in shard]
        for words, doc in zip(lists, shard.values(), strict=True):
            automaton.add(words, doc)
        automaton.settle()
        return [automaton.matches(words, size) for words in lists]

    return by_shards(found, search, size, gram, shard_words)


def _kept(batch: pa.RecordBatch, size: int) -> tuple[list[int], list[int], list[str]]:
    counts, removed, digests = [], [], []
    unpress = zstandard.ZstdDecompressor()
    for text, at, n, digest in zip(*(batch.column(c) for c in ("zip", "starts", "n_words", "digest")), strict=True):
        if not text.is_valid:  # no window of it is repeated
            counts.append(n.as_py())
            removed.append(0)
            digests.append(digest.as_py())
            continue
        words = unpress.decompress(text.as_py()).split()
        gone = np.zeros(len(words) + 1, np.int64)
        if at.is_valid and len(at.values):
            first = at.values.to_numpy()
            np.add.at(gone, first, 1)
            np.add.at(gone, first + size, -1)
        drop = np.cumsum(gone)[: len(words)] > 0
        left = [w for w, x in zip(words, drop.tolist(), strict=True) if not x] if drop.any() else words
        counts.append(len(words))
        removed.append(int(drop.sum()))
        digests.append(hashlib.sha256(b" ".join(left)).hexdigest())
    return counts, removed, digests


def substring_dedup(docs: DataFrame, size: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row of ``docs``."""
    found = candidates(docs, size, gram)
    hits = repeated_windows(found, first_documents(found, size, gram, shard_words))
    at = F.flatten(F.collect_list(F.expr("transform(hits, x -> x.at)")))  # bounded by one document's words
    starts = written(hits.groupBy("doc_id", "th").agg(at.alias("starts")), "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, digests = _kept(batch, size)
            yield pa.record_batch([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = zipped(docs, starts).join(starts, ["doc_id", "th"], "left").select("doc_id", "zip", "n_words", "digest", "starts")
    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM t WHERE len(w) >= 13),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h FROM p),
f AS (SELECT h, min(doc_id) AS least FROM g GROUP BY h),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN f USING (h) WHERE least < doc_id),
r AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM t LEFT JOIN r USING (doc_id)
"""
