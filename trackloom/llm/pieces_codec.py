"""SentencePiece encoding and decoding by batched Viterbi.

The text, with spaces as the model's space mark and one mark before it, is cut wherever no piece holds the two
neighbouring characters, so that the parts can be segmented by themselves without changing the result. Different parts
of equal length advance together: hashes of their substrings probe the sorted keys of all pieces, and vectorised maxima
over the scores leave backpointers. A character that no piece covers becomes its byte pieces. Parts that are long and few
have no company to advance with: all their substrings probe at once, and the maxima follow one by one over the few pieces
that are there. The characters of the chosen pieces are compared with the parts', so a hash never decides alone.

The segmentation is the one of greatest total piece score, the search that SentencePiece runs for unigram models; of equal
scores the longer last piece wins. (A model trained by merges has its own greedy encoder in the library; its pieces and
scores are used here as they stand, and every encoding decodes to its text.) Decoding joins the pieces' bytes.

Defined results: null text counts as empty and has no ids; the space mark itself (U+2581) decodes to a space, as in
SentencePiece, and such a text has round_trip false; rows that repeat a doc_id, or have none, are each encoded; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, pieces, table, whole_text

MARK, UNKNOWN_PENALTY = "▁", 10.0
#: Bytes of text whose parts are segmented together, and rows of a table of equal-length parts.
BATCH_BYTES, ROWS = 2 << 20, 1 << 15
#: Parts of this length or longer go one by one where fewer than FEW have the same length.
LONG, FEW = 64, 64
_R = 0x9E3779B97F4A7C15
_SPACE, _MARK = ord(" "), ord(MARK)


def _ragged(offsets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, sizes) of the runs ``offsets[at]`` to ``offsets[at + 1]``, one after the other."""
    size = offsets[at + 1] - offsets[at]
    before = np.cumsum(size) - size
    return np.repeat(offsets[at] - before, size) + np.arange(int(size.sum())), size


class Model:
    """The pieces of a model file as arrays."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        texts = [model.id_to_piece(i) for i in range(size)]
        is_byte = np.array([model.is_byte(i) for i in range(size)])
        plain = [i for i in range(size) if not (is_byte[i] or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        set_plain = set(plain)
        self.byte_ids = np.zeros(256, np.int64)
        for i in np.flatnonzero(is_byte):
            self.byte_ids[int(texts[i][3:-1], 16)] = i
        scores = np.array([model.get_score(i) for i in plain])
        self.unknown = scores.min() - UNKNOWN_PENALTY
        self.longest = max(len(texts[i]) for i in plain)
        self.powers = np.full(self.longest + 1, _R, np.uint64)
        self.powers[0] = 1
        self.powers = np.multiply.accumulate(self.powers)
        keys = np.array([self._key(np.array([[ord(c) for c in texts[i]]], np.uint64))[0] for i in plain], np.uint64)
        order = np.argsort(keys)
        self.keys, self.scores, self.ids = keys[order], scores[order], np.array(plain)[order]
        # The characters of each piece, and which stand next to each other inside a piece.
        of = [texts[i] if i in set_plain else "" for i in range(size)]
        self.chars, self.chars_at = np.array([ord(c) for t in of for c in t], np.int64), np.r_[0, np.cumsum([len(t) for t in of])]
        inside = sorted({c for i in plain if len(texts[i]) > 1 for c in texts[i]})
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in inside]] = np.arange(1, len(inside) + 1)
        self.joined = np.zeros((len(inside) + 1, len(inside) + 1), bool)
        for i in plain:
            at = self.letter[[ord(c) for c in texts[i]]] if len(texts[i]) > 1 else []
            self.joined[at[:-1], at[1:]] = True
        # What each id decodes to.
        said = [bytes([int(texts[i][3:-1], 16)]) if is_byte[i] else b"" if model.is_control(i) else texts[i].replace(MARK, " ").encode() for i in range(size)]
        self.said, self.said_at = np.frombuffer(b"".join(said), np.uint8), np.r_[0, np.cumsum([len(x) for x in said])]

    @staticmethod
    def _salt(n: int) -> np.uint64:
        return np.uint64(n * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)

    def _key(self, chars: np.ndarray) -> np.ndarray:
        """Hash of each row of characters: a polynomial whose highest power belongs to the first."""
        out = np.zeros(len(chars), np.uint64)
        for i in range(chars.shape[1]):
            out = out * np.uint64(_R) + chars[:, i] + np.uint64(1)
        return mix(out + self._salt(chars.shape[1]))

    def segment(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens row after row, tokens of each row) for a table of equal-length parts; an unknown character c is -1 - c."""
        rows, length = chars.shape
        sums = np.zeros((length + 1, rows), np.uint64)
        for i in range(length):
            sums[i + 1] = sums[i] * np.uint64(_R) + chars[:, i] + np.uint64(1)
        best = np.full((length + 1, rows), -np.inf)
        best[0] = 0
        size, token = np.zeros((length + 1, rows), np.int32), np.zeros((length + 1, rows), np.int64)
        for end in range(1, length + 1):
            for start in range(max(0, end - self.longest), end):  # from the longest last piece on, so that it wins ties
                n = end - start
                key = mix(sums[end] - sums[start] * self.powers[n] + self._salt(n))
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                known = self.keys[at] == key
                if n == 1:
                    score, found = np.where(known, self.scores[at], self.unknown), np.where(known, self.ids[at], -1 - chars[:, start].astype(np.int64))
                else:
                    score, found = np.where(known, self.scores[at], -np.inf), self.ids[at]
                better = best[start] + score > best[end]
                best[end] = np.where(better, best[start] + score, best[end])
                size[end] = np.where(better, n, size[end])
                token[end] = np.where(better, found, token[end])
        out, counts = np.zeros((rows, length), np.int64), np.zeros(rows, np.int64)
        at, each = np.full(rows, length), np.arange(rows)
        while (at > 0).any():
            live = at > 0
            out[live, length - 1 - counts[live]] = token[at[live], each[live]]
            counts += live
            at = at - np.where(live, size[at, each], 0)
        return out[np.arange(length) >= (length - counts)[:, None]], counts

    def segment_alone(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``segment`` for one long part: its length times ``longest`` probes at once, then one step for each piece found."""
        length = len(chars)
        sums = [0]
        for c in chars.tolist():
            sums.append((sums[-1] * _R + c + 1) & 0xFFFFFFFFFFFFFFFF)
        sums = np.array(sums, np.uint64)
        ends, sizes, found = [], [], []
        for n in range(min(self.longest, length), 0, -1):
            key = mix(sums[n:] - sums[:-n] * self.powers[n] + self._salt(n))
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = np.flatnonzero(self.keys[at] == key)
            ends.append(known + n)
            sizes.append(np.full(len(known), n))
            found.append(at[known])
        end = np.concatenate(ends)
        order = np.argsort(end, kind="stable")  # longer last pieces first, so that they win ties
        end, n, at = end[order], np.concatenate(sizes)[order].tolist(), np.concatenate(found)[order]
        bounds, scores, ids = np.searchsorted(end, np.arange(length + 2)).tolist(), self.scores[at].tolist(), self.ids[at].tolist()
        best, back, token, unknown = [0.0] * (length + 1), [1] * (length + 1), [0] * (length + 1), float(self.unknown)
        for e in range(1, length + 1):
            top, single = -np.inf, True
            for k in range(bounds[e], bounds[e + 1]):
                score = best[e - n[k]] + scores[k]
                single = single and n[k] != 1
                if score > top:
                    top, back[e], token[e] = score, n[k], ids[k]
            if single and best[e - 1] + unknown > top:
                top, back[e], token[e] = best[e - 1] + unknown, 1, -1 - int(chars[e - 1])
            best[e] = top
        out, e = [], length
        while e:
            out.append(token[e])
            e -= back[e]
        return np.array(out[::-1], np.int64), np.array([len(out)])

    def _agree(self, tokens: np.ndarray, chars: np.ndarray) -> bool:
        """Whether the pieces' characters, one after the other, are ``chars``."""
        known = np.maximum(tokens, 0)
        size = np.where(tokens < 0, 1, np.diff(self.chars_at)[known])
        if size.sum() != len(chars):
            return False
        at = np.repeat(np.where(tokens < 0, 0, self.chars_at[known]) - (np.cumsum(size) - size), size) + np.arange(len(chars))
        return bool((np.where(np.repeat(tokens < 0, size), np.repeat(-1 - tokens, size), self.chars[at % len(self.chars)]) == chars).all())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, how many each text has)."""
        listed = [t or "" for t in texts.to_pylist()]
        chars = np.frombuffer("".join(MARK + t if t else "" for t in listed).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        if not len(chars):
            return np.zeros(0, np.int64), np.zeros(len(listed), np.int64)
        chars[chars == _SPACE] = _MARK
        sizes = np.array([len(t) + 1 if t else 0 for t in listed])
        ends = np.cumsum(sizes)
        letter = self.letter[chars]
        cut = np.ones(len(chars), bool)
        cut[1:] = ~self.joined[letter[:-1], letter[1:]]
        cut[(ends - sizes)[sizes > 0]] = True
        first = np.flatnonzero(cut)
        length = np.diff(np.r_[first, len(chars)])
        # Different parts, by hash and length: sums of c * r**i taken back to the part's own first character.
        powers = np.full(len(chars), _R, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        inverse = np.full(len(chars), pow(_R, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        sums = np.r_[np.uint64(0), np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * powers)]
        hashed = mix((sums[first + length] - sums[first]) * inverse[first] + length.astype(np.uint64))
        _, sample, part = np.unique(hashed, return_index=True, return_inverse=True)
        order = np.argsort(length[sample], kind="stable")
        lengths = length[sample][order]
        tokens, counts = [], []
        at = 0
        while at < len(order):
            n = int(lengths[at])
            to = min(at + max(1, ROWS * 8 // n), int(np.searchsorted(lengths, n, "right")))
            if n >= LONG and to - at < FEW:
                to = at + 1
            some = chars[first[sample[order[at:to]]][:, None] + np.arange(n)]
            found, each = self.segment_alone(some[0]) if n >= LONG and to == at + 1 else self.segment(some.astype(np.uint64))
            if not self._agree(found, some.ravel()):
                raise ValueError("two pieces with one hash")
            tokens.append(found)
            counts.append(each)
            at = to
        flat, each = self._with_bytes(np.concatenate(tokens), np.concatenate(counts))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        positions, size = _ragged(np.r_[0, np.cumsum(each)], place[part])
        of_text = np.searchsorted(ends, first, "right")
        return flat[positions], np.bincount(of_text, size, len(listed)).astype(np.int64)

    def _with_bytes(self, tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unknown characters as their UTF-8 byte pieces."""
        odd = np.flatnonzero(tokens < 0)
        if not len(odd):
            return tokens, counts
        kinds, which = np.unique(-1 - tokens[odd], return_inverse=True)
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in kinds.tolist()]
        raw_at, raw_ids = np.r_[0, np.cumsum([len(x) for x in raw])], self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        wide = np.ones(len(tokens), np.int64)
        wide[odd] = np.diff(raw_at)[which]
        out = np.repeat(tokens, wide)
        out[out < 0] = raw_ids[_ragged(raw_at, which)[0]]
        return out, np.diff(np.r_[0, np.cumsum(wide)][np.r_[0, np.cumsum(counts)]])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The UTF-8 text of each run of ids, without the space that encoding puts first."""
        positions, size = _ragged(self.said_at, ids)
        raw = self.said[positions].tobytes()
        ends = np.r_[0, np.cumsum(size)][np.cumsum(counts)]
        return [raw[a:z].removeprefix(b" ") for a, z in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True)]


@lru_cache(1)
def model(path: str) -> Model:
    """One for each Python worker."""
    return Model(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, most=BATCH_BYTES):
                ids, counts = model(path).encode(part.column("text"))
                yield pa.record_batch([part.column("doc_id"), pa.ListArray.from_arrays(np.r_[0, np.cumsum(counts)].astype(np.int32), pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    return whole_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            texts = model(path).decode(lists.flatten().to_numpy().astype(np.int64), np.diff(lists.offsets.to_numpy()))
            yield pa.record_batch([batch.column("doc_id"), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (ids as little-endian unsigned 32-bit integers), n_bytes and text_crc32 of the decoded text, round_trip."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, most=BATCH_BYTES):
                ids, counts = model(path).encode(part.column("text"))
                texts = model(path).decode(ids, counts)
                ends, raw = np.cumsum(counts), ids.astype("<u4")
                crcs = [zlib.crc32(raw[a:z]) for a, z in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                same = [t == s.as_buffer().to_pybytes() for t, s in zip(texts, part.column("text"), strict=True)]
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(counts), pa.array(crcs, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([zlib.crc32(t) for t in texts], pa.int64()), pa.array(same)],
                    ["doc_id", "n_tokens", "ids_crc32", "n_bytes", "text_crc32", "round_trip"],
                )

    return whole_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, n_bytes long, text_crc32 long, round_trip boolean")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_pieces(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), model_path())
