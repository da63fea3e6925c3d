"""What the corpus operators share: shared folders, table reading, and word handling with numpy inside tasks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text that one round of numpy work takes at once, so that its 8-byte arrays stay small.
CHUNK_BYTES = 2 << 20
#: Python's ``bytes.split()`` cuts at exactly these: space and 0x09 to 0x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: For terms: all ASCII but letters and digits stands between words.
BREAKS = np.array([not (chr(i).isalnum() or i > 127) for i in range(256)])
#: Folders made so far, with the application they belong to.
_FOLDERS: list[tuple[str, str]] = []
_R = np.uint64(0x9E3779B97F4A7C15 | 1)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``; where that is unset, a temporary one on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _FOLDERS.append((spark.sparkContext.applicationId, path))
    return path


def discard(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete these folders, or all that this application's operators have left: results that read them are gone then."""
    here = spark.sparkContext.applicationId
    for path in paths if paths is not None else [p for a, p in _FOLDERS if a == here]:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        if (here, path) in _FOLDERS:
            _FOLDERS.remove((here, path))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read again, so a lost executor costs a reread and no more."""
    path = shared_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only; a null text counts as empty. Other columns, whatever their names, are left out."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))


ROW_KEYS = ["__none", "__id", "__raw"]


def row_keys(doc_id: Column, raw: Column) -> list[Column]:
    """ROW_KEYS: whether there is no doc_id, the doc_id, and the hash of the text; plain columns that joins can compare."""
    return [doc_id.isNull().alias("__none"), F.coalesce(doc_id, F.lit(0)).alias("__id"), raw.alias("__raw")]


def with_row_keys(docs: DataFrame) -> DataFrame:
    return docs.select("*", *row_keys(docs["doc_id"].cast("long"), F.xxhash64(F.coalesce(docs["text"], F.lit("")))))


def one_row_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of ``docs``, with all its columns, for each (keep_id, keep_raw): a doc_id or null, and the hash of the text.

    Rows that repeat both are one. Join and grouping have the same keys, so the documents move once.
    """
    found = with_row_keys(docs).join(kept.select(*row_keys(kept["keep_id"], kept["keep_raw"])), ROW_KEYS, "left_semi")
    return found.dropDuplicates(ROW_KEYS).select(*docs.columns)


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


@lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(r: np.uint64) -> np.ndarray:
        out = np.full(size, r, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(_R), run(np.uint64(pow(int(_R), -1, 1 << 64)))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def range_hashes(data: np.ndarray, start: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
    """For each of ``ends``, 64 bits for each range of bytes: sums of c * r**i, taken back to the range's own first byte."""
    up, down = _powers(1 << max(21, int(len(data) + 1).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return [mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64)) for end in ends]


class Words:
    """The words of a run of texts: byte ``start``/``end`` in ``data``, the text each belongs to, ``first`` word of each text."""

    def __init__(self, texts: pa.Array, lower: bool = False, between: np.ndarray = _SPACE):
        texts = texts.cast(pa.large_string()).fill_null("")
        buffers = texts.buffers()
        offsets = np.frombuffer(buffers[1], np.int64, len(texts) + 1, texts.offset * 8)
        raw = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        if lower:
            raw = raw.copy()
            raw[(raw >= 65) & (raw <= 90)] += 32
        self.data = raw
        word = ~between[raw]
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        full = np.flatnonzero(np.diff(self.offsets))
        begins[self.offsets[full]] = word[self.offsets[full]]
        ends[self.offsets[full + 1] - 1] = word[self.offsets[full + 1] - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def hashes(self, *heads: int) -> np.ndarray | list[np.ndarray]:
        """64 bits for each word, equal for equal words; with ``heads``, also for its first so many bytes."""
        if not len(self.start):
            return [np.zeros(0, np.uint64)] * (1 + len(heads)) if heads else np.zeros(0, np.uint64)
        upto = [self.end, *(np.minimum(self.end, self.start + n) for n in heads)]
        out = range_hashes(self.data, self.start, *upto)
        return out if heads else out[0]


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """64 bits for each run of ``k`` words; shorter than ``hashes`` by k - 1."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _R + hashes[i : i + n]
    return mix(out)


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``most`` bytes of text each; a longer text stands alone."""
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, base + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, most: int) -> DataFrame:
    """doc_id, text, label of at most ``most`` labelled rows outside the held-out fold, chosen by a hash of the id.

    The ids are few by construction (``most`` is the bound), so they are broadcast to the scan of the texts.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % modulus
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels[label].cast("int").alias("label")).dropna()
    chosen = known.groupBy("doc_id").agg(F.max("label").alias("label")).filter(fold != held_out).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return whole_text(docs).join(F.broadcast(chosen), "doc_id")
