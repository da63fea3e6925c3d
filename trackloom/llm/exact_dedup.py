"""Exact dedup through an extendible-hash index on shared files.

Every text is normalised (A-Z lower-cased, null as empty) and keyed by 64 hash bits. The index has one entry for each
different text. A text whose key no other row has is an entry as it stands; a filter of bits over the keys that occur again
tells these rows apart in the scan, so that only texts that may have a copy are shuffled. Those are grouped by key *and
text*, which compares the bytes: texts that share a key become separate entries of one chain.

A directory over key prefixes doubles until no bucket holds more than its capacity; only overfull buckets split, the
others keep a smaller local depth and several slots. Its depth follows the number of entries. Owner tasks each take a
contiguous range of (bucket, key) and write it as one file of the index. Every row then finds its entry through the
directory: its key's slot names the bucket, and within the bucket key and digest name the entry of the chain.

Defined results: null text equals empty text; of equal texts the largest ``doc_id`` stays; rows that repeat a
``doc_id`` are each reported; rows without one stay only where their whole group has none (``keep_id`` null); an empty
table gives an empty index and no rows; other columns are ignored. ``keep_one`` keeps exactly one row of each group,
whatever ids repeat or are null. Everything runs as DataFrame expressions.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, one_row_each, shared_path, table, written

#: Entries that a bucket holds before it splits, and directory bits beyond those that evenly filled buckets need.
CAPACITY, SLACK = 1 << 16, 3
#: The most bits of the filter of repeated keys (64 MB, which bounds the broadcast), and bits for each key below that.
FILTER_BITS, KEY_BITS = 1 << 29, 16


def keyed(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """doc_id, raw (a hash of the text as it stands), norm, key. Fewer ``hash_bits`` make collisions, for tests."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("raw"), ascii_lower(text).alias("norm"))
    key = F.xxhash64("norm")
    return rows.withColumn("key", key if hash_bits == 64 else F.shiftleft(key, 64 - hash_bits))


def digest(norm: str) -> Column:
    return F.unhex(F.sha2(F.encode(norm, "UTF-8"), 256))


def repeated_filter(hashed: DataFrame, most: int = FILTER_BITS) -> tuple[DataFrame, int]:
    """(bitmaps by bucket, number of bits) of the keys that more than one row has; at most ``most`` bits."""
    again = written(hashed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "repeated-keys")
    bits = min(most, 1 << ceil(log2(max(1 << 15, KEY_BITS * again.count()))))
    at = again.select(_position(bits).alias("at"))
    maps = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))
    return maps, bits


def _position(bits: int) -> Column:
    return F.xxhash64("key", F.lit(1)).bitwiseAND(bits - 1) + 1


def may_repeat(rows: DataFrame, maps: DataFrame, bits: int) -> DataFrame:
    """``rows`` with ``again``: false only where no other row has the key. The maps are ``bits`` / 8 bytes in all."""
    at = rows.withColumn("at", _position(bits)).withColumn("bucket", F.bitmap_bucket_number("at"))
    byte = "cast(conv(hex(substring(bitmap, cast(bitmap_bit_position(at) div 8 AS int) + 1, 1)), 16, 10) AS int)"
    held = F.expr(f"coalesce({byte} & shiftleft(1, cast(bitmap_bit_position(at) % 8 AS int)) <> 0, false)")
    return at.join(F.broadcast(maps), "bucket", "left").withColumn("again", held).drop("at", "bucket", "bitmap")


def slots(col: str, depth: int) -> Column:
    """The top ``depth`` bits of the key: contiguous key ranges in unsigned order."""
    return F.shiftrightunsigned(F.col(col), 64 - depth) if depth else F.lit(0).cast("long")


def directory(entries: DataFrame, capacity: int = CAPACITY, depth: int | None = None) -> DataFrame:
    """slot, bucket, local_depth for each of 2**depth slots.

    Loads are added up for the prefixes of every length; a slot's bucket has the least depth at which it holds no more than
    ``capacity`` entries. One that is overfull at the last depth, because its entries share a longer prefix, stays whole.
    """
    spark = entries.sparkSession
    depth = max(0, ceil(log2(max(1, entries.count()) / capacity)) + SLACK) if depth is None else depth
    levels = f"sequence(0, {depth})"
    loads = entries.groupBy(slots("key", depth).alias("slot")).agg(F.count("*").alias("n"))
    prefix = F.expr(f"shiftright(slot, {depth} - level)").alias("prefix")
    sums = loads.select("slot", "n", F.explode(F.expr(levels)).alias("level")).groupBy("level", prefix).agg(F.sum("n").alias("n"))
    over = sums.filter(F.col("n") > capacity).select("level", "prefix")
    every = spark.range(1 << depth).select(F.col("id").alias("slot"), F.explode(F.expr(levels)).alias("level")).withColumn("prefix", prefix)
    fits = every.join(over, ["level", "prefix"], "left_anti").groupBy("slot").agg(F.min("level").alias("fits"))
    sized = spark.range(1 << depth).select(F.col("id").alias("slot")).join(fits, "slot", "left").select("slot", F.coalesce("fits", F.lit(depth)).alias("local_depth"))
    bucket = F.expr(f"shiftleft(shiftright(slot, {depth} - local_depth), {depth} - local_depth)")
    return sized.select("slot", "local_depth", bucket.alias("bucket"))


def build_index(rows: DataFrame, hashed: DataFrame, path: str, capacity: int = CAPACITY, depth: int | None = None, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """Write the index of ``keyed`` rows, whose digests are ``hashed``, below ``path``; returns (directory, index) as read back.

    The grouping adds up copies before the shuffle, so a text that a third of the rows share costs a row for each task.
    """
    spark = rows.sparkSession
    maps, bits = repeated_filter(hashed, filter_bits)
    maps = written(maps, "repeated-bits")
    alone = may_repeat(hashed, maps, bits).filter("NOT again").select("key", "sha", F.col("doc_id").alias("keep_id"), F.col("raw").alias("keep_raw"), F.lit(1).cast("long").alias("group_size"))
    texts = may_repeat(rows, maps, bits).filter("again").groupBy("key", "norm")
    least_raw = F.coalesce(F.max_by("raw", "doc_id"), F.max("raw"))
    compared = texts.agg(F.max("doc_id").alias("keep_id"), least_raw.alias("keep_raw"), F.count("*").alias("group_size"))
    entries = written(alone.unionByName(compared.withColumn("sha", digest("norm")).drop("norm")), "index-entries")
    directory(entries, capacity, depth).repartition(1).write.parquet(f"{path}/directory")
    slot_map = spark.read.parquet(f"{path}/directory")
    owned = in_buckets(entries, slot_map).select("bucket", "key", "sha", "keep_id", "keep_raw", "group_size")
    owned.repartitionByRange("bucket", F.expr("shiftrightunsigned(key, 1)"), "key").sortWithinPartitions("bucket", "key").write.parquet(f"{path}/buckets")
    return slot_map, spark.read.parquet(f"{path}/buckets")


def in_buckets(rows: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``rows`` with the bucket that the directory names for their key's slot."""
    depth = int(log2(max(1, slot_map.count())))
    return rows.withColumn("slot", slots("key", depth)).join(slot_map.select("slot", "bucket"), "slot").drop("slot")


def probe(hashed: DataFrame, slot_map: DataFrame, index: DataFrame) -> DataFrame:
    """doc_id, raw, sha and the entry's keep_id, keep_raw and group_size of each row.

    Entries differ in bytes, and so in their digests; skewed entries of this join are split at run time (the index has one
    row for each).
    """
    return in_buckets(hashed, slot_map).join(index, ["bucket", "key", "sha"])


def indexed(docs: DataFrame, capacity: int = CAPACITY, depth: int | None = None, hash_bits: int = 64, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(digests of the rows, directory, index) of ``docs``."""
    rows = keyed(docs, hash_bits)
    hashed = written(rows.select("doc_id", "raw", "key", digest("norm").alias("sha")), "index-rows")
    return hashed, *build_index(rows, hashed, shared_path(docs.sparkSession, "hash-index"), capacity, depth, filter_bits)


def exact_dedup(docs: DataFrame, **options) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of ``docs``."""
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return probe(*indexed(docs, **options)).select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, that exact dedup keeps: one row of each group."""
    return one_row_each(docs, indexed(docs)[2].select("keep_id", "keep_raw"))


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM n JOIN g USING (norm)
"""
