"""Token ids in binary shards: one wavelet matrix for each shard, one file for each wavelet matrix.

Texts are encoded in ascending doc_id order, an end id follows each, and about SHARD_TOKENS ids make a shard. A shard is
one compressed value: a header, the doc_ids and lengths, the ranks, and a bit-plane for each bit of an id, most
significant first, each plane ordered by the planes before it (zeros first, stable). Planes are compressed in blocks of
2**BLOCK bits, and the number of ones before each block is stored, so access, counting and occurrence lookup inflate the
few blocks they touch and decode no ids. Every shard is the only row of its own Parquet file: Spark's writer commits files
whole or not at all on any file system, a lost executor's shards are written again, and reading one needs no other.

Encoding goes by chunks: white space and what follows up to the next white space or the end of an ASCII word. The
tokenizer's own splitting never reaches across such a place, so each different chunk is encoded once for many occurrences,
and the ids equal those of the whole text. Chunks are told apart by 64-bit hashes, and the bytes of the resulting ids are
compared with the texts; where they differ, the library encodes the whole texts. A tokenizer with other splitting rules
encodes whole texts throughout.

Defined results: null text counts as empty and has the end id alone; rows without a doc_id come first, and rows that
repeat one follow each other, both ordered by text; an empty table writes no shard and gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Words, pieces, range_hashes, shared_path, table, whole_text

MAGIC, LEVEL, BLOCK = b"WMX2", 1, 16
SHARD_TOKENS, END_ID = 1 << 22, 2
#: Slots of an encoder's table of chunks (half are used before it starts afresh), the most ids and the longest chunk it keeps: some 130 MB.
TABLE, KEPT_IDS, KEPT_BYTES = 22, 1 << 24, 48
#: New chunks that are encoded as one text.
JOINED = 512
_NEVER = np.zeros(256, bool)
_WHITE = np.isin(np.arange(256), [*range(9, 14), 32])
#: ASCII letters, and ASCII characters that are neither letters, digits, white space nor control characters.
_LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])
_MARK = np.array([32 < i < 127 and not chr(i).isalnum() for i in range(256)])


class WaveletShard:
    """Ids below 2**bits with rank and select over succinct bit-planes, inflated block by block as they are touched."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        self.n, self.bits, docs, self.nulls, packed = struct.unpack_from("<QIQQQ", data, 4)
        at = 40
        head = zstandard.ZstdDecompressor().decompress(data[at : at + packed])
        self.doc_ids, self.lengths = (np.frombuffer(head, "<i8", docs, 8 * docs * i) for i in range(2))
        blocks = (self.n + (1 << BLOCK) - 1) >> BLOCK
        #: Ones before each block of each plane, and where its bytes begin.
        self.before = np.frombuffer(head, "<i8", self.bits * (blocks + 1), 16 * docs).reshape(self.bits, blocks + 1)
        self.starts = np.frombuffer(head, "<i8", self.bits * blocks + 1, 16 * docs + 8 * self.before.size) + at + packed
        self.zeros = [self.n - int(r[-1]) for r in self.before]
        self.data, self.blocks, self.inflated = data, blocks, 0
        self.have = np.zeros((self.bits, blocks), bool)
        per = 1 << (BLOCK - 6)
        self.words = [np.zeros(blocks * per, np.uint64) for _ in range(self.bits)]
        self.ranks = [np.zeros(blocks * per, np.int64) for _ in range(self.bits)]

    @staticmethod
    def build(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, bits: int = 16, nulls: int = 0) -> bytes:
        """The bytes of a shard; the first ``nulls`` documents have no doc_id."""
        if len(ids) and int(ids.max()) >> bits:
            raise ValueError(f"id {ids.max()} does not fit {bits} planes")
        press, now = zstandard.ZstdCompressor(level=LEVEL), ids.astype(np.uint16 if bits <= 16 else np.uint32)
        before, starts, body, size = [], [0], [], 1 << (BLOCK - 3)
        for level in range(bits - 1, -1, -1):
            bit = (now >> np.asarray(level, now.dtype)) & np.asarray(1, now.dtype)
            mask = bit.astype(bool)
            plane = np.packbits(mask, bitorder="little")
            plane = np.pad(plane, (0, -len(plane) % size)).reshape(-1, size)
            before.append(np.r_[0, np.cumsum(np.bitwise_count(plane).sum(1, dtype=np.int64))])
            for block in plane:
                body.append(press.compress(block.tobytes()))
                starts.append(starts[-1] + len(body[-1]))
            now = np.concatenate([now[~mask], now[mask]])
        head = press.compress(b"".join(x.astype("<i8").tobytes() for x in (doc_ids, lengths, np.array(before), np.array(starts))))
        return MAGIC + struct.pack("<QIQQQ", len(ids), bits, len(doc_ids), nulls, len(head)) + head + b"".join(body)

    def _inflate(self, level: int, blocks: np.ndarray) -> None:
        per, unpress = 1 << (BLOCK - 6), zstandard.ZstdDecompressor()
        blocks = blocks[blocks < self.blocks]
        for b in np.unique(blocks[~self.have[level][blocks]]).tolist():
            a, z = self.starts[level * self.blocks + b : level * self.blocks + b + 2].tolist()
            words = np.frombuffer(unpress.decompress(self.data[a:z]), np.uint64)
            counts = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            self.words[level][b * per : (b + 1) * per] = words
            self.ranks[level][b * per : (b + 1) * per] = self.before[level][b] + np.r_[0, counts[:-1]]
            self.have[level, b] = True
            self.inflated += 1

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        out = np.full(len(at), self.n - self.zeros[level], np.int64)
        inside = np.flatnonzero(at < self.n)
        at = at[inside]
        self._inflate(level, at >> BLOCK)
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        out[inside] = self.ranks[level][word] + np.bitwise_count(self.words[level][word] & ((np.uint64(1) << rest) - np.uint64(1)))
        return out

    def access(self, at) -> np.ndarray:
        """The ids at these positions."""
        at = np.atleast_1d(np.asarray(at, np.int64))
        out = np.zeros(len(at), np.int64)
        for level in range(self.bits):
            ones = self._ones(level, at)
            bit = (self.words[level][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            at = np.where(bit, self.zeros[level] + ones, at - ones)
            out = out * 2 + bit
        return out

    def _descend(self, token: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Where the token's occurrences and those before ``at`` begin below the last plane, and the token's bits."""
        first, path = np.zeros(1, np.int64), []
        for level in range(self.bits):
            one = token >> (self.bits - 1 - level) & 1
            a, b = self._ones(level, first), self._ones(level, at)
            first, at = (self.zeros[level] + a, self.zeros[level] + b) if one else (first - a, at - b)
            path.append(one)
        return first, at, path

    def rank(self, token: int, at) -> np.ndarray:
        """How often ``token`` occurs before each position."""
        at = np.atleast_1d(np.asarray(at, np.int64))
        if token >> self.bits or not self.n:
            return np.zeros(len(at), np.int64)
        first, at, _ = self._descend(token, at)
        return at - first

    def count(self, token: int) -> int:
        return int(self.rank(token, self.n)[0])

    def select(self, token: int, k) -> np.ndarray:
        """Where the k-th occurrences (from 0) of ``token`` are; k must be below its count."""
        k = np.atleast_1d(np.asarray(k, np.int64))
        first, _, path = self._descend(token, np.zeros(1, np.int64))
        at = first + k
        for level in range(self.bits - 1, -1, -1):
            at = self._select_bit(level, path[level], at - self.zeros[level] if path[level] else at)
        return at

    def _select_bit(self, level: int, one: int, k: np.ndarray) -> np.ndarray:
        edges = self.before[level] if one else np.minimum(np.arange(self.blocks + 1) << BLOCK, self.n) - self.before[level]
        block, per = np.searchsorted(edges, k, "right") - 1, 1 << (BLOCK - 6)
        self._inflate(level, block)
        out = np.empty(len(k), np.int64)
        order = np.argsort(block, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(block[order])) + 1) if len(k) else []:
            b = int(block[some[0]])
            words, ranks = self.words[level][b * per : (b + 1) * per], self.ranks[level][b * per : (b + 1) * per]
            ranks = ranks if one else (b << BLOCK) + np.arange(per) * 64 - ranks
            word = np.searchsorted(ranks, k[some], "right") - 1
            bits = np.unpackbits(words[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") == one
            out[some] = (b << BLOCK) + word * 64 + (np.cumsum(bits, 1) == (k[some] - ranks[word] + 1)[:, None]).argmax(1)
        return out

    def occurrences(self, token: int) -> np.ndarray:
        return self.select(token, np.arange(self.count(token)))

    def tokens(self) -> np.ndarray:
        """All ids: the planes' stable partitions undone from the last to the first."""
        now = np.zeros(self.n, np.uint32 if self.bits > 16 else np.uint16)
        for level in range(self.bits - 1, -1, -1):
            self._inflate(level, np.arange(self.blocks))
            mask = np.unpackbits(self.words[level].view(np.uint8), count=self.n, bitorder="little").astype(bool)
            out, zeros = np.empty_like(now), self.zeros[level]
            out[~mask], out[mask] = now[:zeros], now[zeros:] | now.dtype.type(1 << (self.bits - 1 - level))
            now = out
        return now


class Encoder:
    """Ids of whole texts, each different chunk encoded once while it is remembered."""

    def __init__(self, path: str, table: int = TABLE, kept_ids: int = KEPT_IDS, kept_bytes: int = KEPT_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.shift, self.kept_ids, self.kept_bytes = Tokenizer.from_file(path), 64 - table, kept_ids, kept_bytes
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        split = rules.get("pre_tokenizer") or {}
        #: Whether the splitting is the byte-level one, for which the chunks are made.
        self.by_chunks = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not rules.get("normalizer")
        self.by_chunks = self.by_chunks and not any(_WHITE[list(t["content"].encode())].any() or t["lstrip"] or t["rstrip"] for t in rules.get("added_tokens", []))
        self.marks = _MARK.copy()
        self.marks[[b for t in rules.get("added_tokens", []) for b in t["content"].encode()]] = False
        vocabulary = sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])
        self.largest = vocabulary[-1][1] if vocabulary else 0
        # A piece is written with a letter for each byte: itself where it can be printed, or else one from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        said = {i: bytes(byte_of.get(c, 0) for c in piece) for piece, i in vocabulary} if self.by_chunks else {}
        listed = [said.get(i, b"") for i in range(max(said, default=-1) + 1)]
        self.said, self.said_at = np.frombuffer(b"".join(listed), np.uint8), np.r_[0, np.cumsum(np.fromiter(map(len, listed), np.int64, len(listed)))]
        self._forget()

    def _forget(self) -> None:
        self.keys, self.entry = np.zeros(1 << (64 - self.shift), np.uint64), np.zeros(1 << (64 - self.shift), np.int32)
        self.ids, self.offsets, self.n = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), 0

    def _find(self, key: np.ndarray) -> np.ndarray:
        """The entry of each key, or -1."""
        at, out, open_ = (key >> np.uint64(self.shift)).astype(np.int64), np.full(len(key), -1, np.int64), np.arange(len(key))
        while len(open_):
            there = self.keys[at]
            hit = there == key[open_]
            out[open_[hit]] = self.entry[at[hit]]
            on = ~hit & (there != 0)
            open_, at = open_[on], (at[on] + 1) & (len(self.keys) - 1)
        return out

    def _insert(self, key: np.ndarray, entry: np.ndarray) -> None:
        """Different keys that are not there; the table has room."""
        at = (key >> np.uint64(self.shift)).astype(np.int64)
        while len(key):
            free = self.keys[at] == 0
            self.keys[at[free]] = key[free]
            mine = free & (self.keys[at] == key)
            self.entry[at[mine]] = entry[mine]
            key, entry, at = key[~mine], entry[~mine], (at[~mine] + 1) & (len(self.keys) - 1)

    def _append(self, ids: np.ndarray, ends: np.ndarray) -> None:
        base = int(self.offsets[self.n])
        for name, need in (("ids", base + len(ids)), ("offsets", self.n + 1 + len(ends))):
            old = getattr(self, name)
            if need > len(old):
                setattr(self, name, np.concatenate([old, np.zeros(max(need - len(old), len(old)), old.dtype)]))
        self.ids[base : base + len(ids)] = ids
        self.offsets[self.n + 1 : self.n + 1 + len(ends)] = base + ends
        self.n += len(ends)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _learn(self, chunks: list[bytes], joins: np.ndarray) -> None:
        """Append an entry for each chunk; where ``joins``, many make one text, and the ids' bytes tell where each ends."""
        alone = np.flatnonzero(~joins).tolist()
        joinable = np.flatnonzero(joins).tolist()
        sizes, parts = np.zeros(len(chunks), np.int64), []
        if joinable:
            listed = [chunks[i] for i in joinable]
            ids, _ = self._library([b"".join(listed[i : i + JOINED]).decode() for i in range(0, len(listed), JOINED)])
            upto, ends = np.cumsum(np.diff(self.said_at)[ids]), np.cumsum(np.fromiter(map(len, listed), np.int64, len(listed)))
            last = np.minimum(np.searchsorted(upto, ends), len(upto) - 1)
            if (upto[last] == ends).all():
                sizes[joinable] = np.diff(np.r_[0, last + 1])
                parts.append((joinable, ids))
            else:
                alone = alone + joinable
        if alone:
            ids, each = self._library([chunks[i].decode() for i in alone])
            sizes[alone] = each
            parts.append((alone, ids))
        ends = np.cumsum(sizes)
        out = np.zeros(int(sizes.sum()), np.uint32)
        for rows, ids in parts:
            size = sizes[rows]
            out[np.repeat((ends - sizes)[rows] - (np.cumsum(size) - size), size) + np.arange(len(ids))] = ids
        self._append(out, ends)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, how many each text has)."""
        if not self.by_chunks:
            return self._library([t or "" for t in texts.to_pylist()])
        if self.n > len(self.keys) // 2 or self.offsets[self.n] > self.kept_ids or len(self.ids) > 4 * self.kept_ids:
            self._forget()
        words = Words(texts, between=_NEVER)  # the bytes and offsets alone
        data, offsets = words.data, words.offsets
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        begin = _chunk_starts(data, offsets, self.marks)
        end = np.r_[begin[1:], len(data)]
        key = np.maximum(range_hashes(data, begin, end)[0], np.uint64(1))
        entry, kept = self._find(key), self.n
        new = np.flatnonzero(entry < 0)
        if len(new):
            kinds, sample, kind = np.unique(key[new], return_index=True, return_inverse=True)
            at = new[sample]
            length, raw = end[at] - begin[at], data.tobytes()
            # What is remembered comes first, so that the rest can be dropped after this batch.
            room = max(0, len(self.keys) * 3 // 4 - self.n)
            order = np.argsort(length > self.kept_bytes, kind="stable")
            keep = min(room, int((length <= self.kept_bytes).sum()))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            at = at[order]
            joins = _WHITE[data[begin[at]]] & ~_WHITE[data[end[at] - 1]] & ~_after_odd_white(data, end[at]) & (length[order] <= self.kept_bytes)
            self._learn([raw[a:z] for a, z in zip(begin[at].tolist(), end[at].tolist(), strict=True)], joins)
            entry[new] = kept + place[kind]
            self._insert(kinds[order[:keep]], np.arange(kept, kept + keep, dtype=np.int32))
            kept += keep
        first = self.offsets[entry]
        size = self.offsets[entry + 1] - first
        total = np.cumsum(size)
        ids = self.ids[np.repeat(first - (total - size), size) + np.arange(int(total[-1]))]
        self.n = kept
        said, first = np.diff(self.said_at)[ids], self.said_at[ids]
        upto = np.cumsum(said)
        if upto[-1] != len(data) or not np.array_equal(self.said[np.repeat(first - (upto - said), said) + np.arange(len(data))], data):
            return self._library([t or "" for t in texts.to_pylist()])  # two chunks with one hash
        cuts = np.r_[0, total][np.searchsorted(begin, offsets)]
        return ids, np.diff(cuts)


def _after_odd_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place may be white space beyond the ASCII characters of _WHITE."""
    out, last = np.zeros(len(at), bool), data[at - 1]
    out[(last >= 28) & (last < 32)] = True
    wide = np.flatnonzero(last >= 128)
    last, two, three = last[wide], data[at[wide] - 2], data[at[wide] - 3]
    odd = ((two == 0xC2) & ((last == 0x85) | (last == 0xA0))) | ((three == 0xE1) & ((two == 0x9A) | (two == 0xA0)))
    odd |= (three == 0xE2) & (((two == 0x80) & ((last <= 0x8B) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF))) | ((two == 0x81) & (last == 0x9F)))
    out[wide] = odd | ((three == 0xE3) & (two == 0x80) & (last == 0x80))
    return out


def _chunk_starts(data: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Where chunks begin: each text, white space after other characters, and marks after ASCII letters.

    A token never holds a character and white space after it, nor a letter and a mark after it. White space of several
    bytes before a space is one run with it, so no chunk begins there; nor where an added token might go on.
    """
    white = _WHITE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = (white[1:] & ~white[:-1]) | (_LETTER[data[:-1]] & marks[data[1:]])
    at = np.flatnonzero(cut)
    cut[at[_after_odd_white(data, at)]] = False
    cut[offsets[:-1]] = True  # an empty text at the end begins at len(data), which is cut off
    return np.flatnonzero(cut[:-1])


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)


def write_shards(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write (part, shard, n_tokens, data) rows below ``path``, a file for each, in ascending doc_id order of part and shard; as many planes as the vocabulary needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        doc_ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = nulls = 0

        def packed() -> pa.RecordBatch:
            bits = max(encoder(tokenizer).largest, end_id).bit_length()
            data = WaveletShard.build(np.concatenate(ids), np.concatenate(doc_ids), np.concatenate(lengths), bits, nulls)
            row = [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([held], pa.int64()), pa.array([data], pa.binary())]
            return pa.record_batch(row, ["part", "shard", "n_tokens", "data"])

        for batch in batches:
            for piece in pieces(batch, most=min(1 << 20, shard_tokens)):
                found, counts = encoder(tokenizer).encode(piece.column("text"))
                ids.append(np.insert(found, np.cumsum(counts), end_id))
                lengths.append(counts + 1)
                nulls += piece.column("doc_id").null_count
                doc_ids.append(piece.column("doc_id").fill_null(0).to_numpy())
                held += len(ids[-1])
                if held >= shard_tokens:
                    yield packed()
                    shard, held, nulls = shard + 1, 0, 0
                    doc_ids, lengths, ids = [], [], []
        if doc_ids:
            yield packed()

    # Rows that repeat a doc_id, or have none, are dealt by how their texts begin.
    ordered = whole_text(docs).repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    shards = ordered.mapInArrow(run, "part int, shard int, n_tokens long, data binary")
    shards.write.option("compression", "none").option("maxRecordsPerFile", 1).parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("part int, shard int, n_tokens long, data binary").parquet(path)


def _each_shard(shards: DataFrame, columns: str, rows) -> DataFrame:
    """part, shard and the ``columns`` that ``rows`` gives as arrays for each shard."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, data in zip(*(batch.column(c) for c in ("part", "shard", "data")), strict=True):
                arrays = [pa.array(x) for x in rows(WaveletShard(data.as_py()))]
                own = [pa.array(np.full(len(arrays[0]), x.as_py(), np.int32)) for x in (part, shard)]
                yield pa.record_batch(own + arrays, ["part", "shard", *names])

    return shards.select("part", "shard", "data").mapInArrow(run, f"part int, shard int, {columns}")


def _doc_ids(shard: WaveletShard) -> pa.Array:
    return pa.array(shard.doc_ids, pa.int64(), mask=np.arange(len(shard.doc_ids)) < shard.nulls)


def token_ids(shards: DataFrame, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and n_ends (places of the end id, by select) of each document, from the shards alone."""

    def rows(shard: WaveletShard) -> list:
        ends, n = np.cumsum(shard.lengths), len(shard.lengths)
        raw = shard.tokens().astype("<u4")
        crcs = [zlib.crc32(raw[a:z]) for a, z in zip((ends - shard.lengths).tolist(), ends.tolist(), strict=True)]
        of = np.searchsorted(ends, shard.occurrences(end_id), "right")
        return [_doc_ids(shard), ends - shard.lengths, shard.lengths, np.array(crcs, np.int64), np.bincount(of, minlength=n)]

    # Prefix sums in two steps: over the parts, as many as tasks wrote, and within each part over its shards.
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    part_starts = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    within = Window.partitionBy("part").orderBy("shard")
    shard_starts = shards.select("part", "shard", (F.sum("n_tokens").over(within) - F.col("n_tokens")).alias("shard_start"))
    starts = shard_starts.join(part_starts, "part")
    documents = _each_shard(shards, "doc_id long, offset long, n_tokens long, ids_crc32 long, n_ends long", rows)
    start = F.col("part_start") + F.col("shard_start") + F.col("offset")
    return documents.join(starts, ["part", "shard"]).select("doc_id", start.alias("start"), "n_tokens", "ids_crc32", "n_ends")


def lookup(shards: DataFrame, token: int) -> DataFrame:
    """part, shard, doc_id, at: every occurrence of a token, found by select without decoding; ``at`` counts within the document."""

    def rows(shard: WaveletShard) -> list:
        at, ends = shard.occurrences(token), np.cumsum(shard.lengths)
        of = np.searchsorted(ends, at, "right")
        return [_doc_ids(shard).take(pa.array(of)), at - (ends - shard.lengths)[of]]

    return _each_shard(shards, "doc_id long, at long", rows)


def op1_wavelet_tokens(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = shared_path(spark, "wavelet-shards")
    write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return token_ids(read_shards(spark, path))
