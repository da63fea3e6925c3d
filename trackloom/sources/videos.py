"""Videos without a decoder: packets from the sample tables of MP4 files, copies of whole groups of pictures, and comparison of streams.

``packets`` is a Spark data source. Its partitions are runs of files, and of a file only the header is read, unless digests
of the samples are asked for. Tasks open files by pyarrow's file systems (local, HDFS, S3 and others by their URI).
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.intervals import dealt
from ..plans.cutplan import packet_frame

PACKETS = "path string, sample long, pts long, dts long, duration long, timescale long, key boolean, offset long, size long, codec string, width int, height int, streams int, digest string"
#: Files, and bytes of samples where they are read, of one partition.
FILES, BYTES = 64, 128 << 20
#: Names of H.264 in sample descriptions.
H264 = ("avc1", "avc3")
#: Bytes that are copied at once.
BLOCK = 8 << 20


@dataclass
class Track:
    """The one track's samples in decoding order; times in units of 1 / timescale, ``pts`` as the edit list shows them."""

    timescale: int
    sizes: np.ndarray
    offsets: np.ndarray
    durations: np.ndarray
    dts: np.ndarray
    pts: np.ndarray
    keys: np.ndarray
    description: bytes
    streams: int = 1

    @property
    def codec(self) -> str:
        return self.description[20:24].decode("latin1")

    @property
    def size(self) -> tuple[int, int]:
        return struct.unpack_from(">HH", self.description, 48)


def _boxes(data: bytes, a: int, z: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, first and last byte of the contents) of the boxes between ``a`` and ``z``."""
    while a + 8 <= z:
        size, kind = struct.unpack_from(">I4s", data, a)
        head = 8
        if size == 1:
            size, head = struct.unpack_from(">Q", data, a + 8)[0], 16
        size = size or z - a
        if size < head or a + size > z:
            raise ValueError("a box ends outside of its own")
        yield kind, a + head, a + size
        a += size


def _header(file) -> bytes:
    """The contents of the movie box, found by the sizes of the boxes before it."""
    end, at = file.size(), 0
    while at + 8 <= end:
        file.seek(at)
        size, kind, long = struct.unpack(">I4sQ", file.read(16).ljust(16, b"\0"))
        head = 16 if size == 1 else 8
        size = long if size == 1 else size or end - at
        if kind == b"moov":
            file.seek(at + head)
            return file.read(size - head)
        if size < head:
            break
        at += size
    raise ValueError("no movie header")


def _pairs(data: bytes, at: int) -> tuple[np.ndarray, np.ndarray]:
    """A run-length table: (values, how often each)."""
    table = np.frombuffer(data, ">i4", 2 * struct.unpack_from(">I", data, at + 4)[0], at + 8).astype(np.int64).reshape(-1, 2)
    return table[:, 1], table[:, 0]


def read_track(file) -> Track:
    """The samples of an open MP4 file; without a video track, or with samples in fragments, it raises."""
    data = _header(file)
    tracks, movie = [], 1
    for kind, a, z in _boxes(data, 0, len(data)):
        if kind == b"mvhd":
            movie = struct.unpack_from(">I", data, a + (20 if data[a] else 12))[0]
        elif kind == b"trak":
            found, open_ = {}, [(a, z)]
            while open_:
                for kind, b, y in _boxes(data, *open_.pop()):
                    if kind in (b"mdia", b"minf", b"stbl", b"edts"):
                        open_.append((b, y))
                    else:
                        found[kind] = (b, y)
            tracks.append(found)
    videos = [t for t in tracks if b"hdlr" in t and data[t[b"hdlr"][0] + 8 : t[b"hdlr"][0] + 12] == b"vide"]
    if not videos:
        raise ValueError("no video track")
    at = {kind: a for kind, (a, _) in videos[0].items()}
    uniform, count = struct.unpack_from(">II", data, at[b"stsz"] + 4)
    if not count:
        raise ValueError("no samples in the header")
    sizes = np.full(count, uniform, np.int64) if uniform else np.frombuffer(data, ">u4", count, at[b"stsz"] + 12).astype(np.int64)
    durations = np.repeat(*_pairs(data, at[b"stts"]))
    dts = np.cumsum(durations) - durations
    pts = dts + (np.repeat(*_pairs(data, at[b"ctts"])) if b"ctts" in at else 0)
    timescale = struct.unpack_from(">I", data, at[b"mdhd"] + (20 if data[at[b"mdhd"]] else 12))[0]
    if b"elst" in at:
        wide = data[at[b"elst"]]
        for i in range(struct.unpack_from(">I", data, at[b"elst"] + 4)[0]):
            lasts, begins = struct.unpack_from(">Qq" if wide else ">Ii", data, at[b"elst"] + 8 + i * (20 if wide else 12))
            if begins >= 0:
                pts = pts - begins
                break
            pts = pts + lasts * timescale // movie
    keys = np.ones(count, bool)
    if b"stss" in at:
        keys[:] = False
        keys[np.frombuffer(data, ">u4", struct.unpack_from(">I", data, at[b"stss"] + 4)[0], at[b"stss"] + 8).astype(np.int64) - 1] = True
    place, kind = (at[b"co64"], ">u8") if b"co64" in at else (at[b"stco"], ">u4")
    chunks = np.frombuffer(data, kind, struct.unpack_from(">I", data, place + 4)[0], place + 8).astype(np.int64)
    runs = np.frombuffer(data, ">u4", 3 * struct.unpack_from(">I", data, at[b"stsc"] + 4)[0], at[b"stsc"] + 8).astype(np.int64).reshape(-1, 3)
    each = np.repeat(runs[:, 1], np.diff(np.r_[runs[:, 0], len(chunks) + 1]))
    if each.sum() != count or len(durations) != count:
        raise ValueError("the sample tables do not agree")
    before = np.cumsum(sizes) - sizes
    first = np.cumsum(each) - each
    offsets = np.repeat(chunks - before[first], each) + before
    a, z = videos[0][b"stsd"]
    return Track(timescale, sizes, offsets, durations, dts, pts, keys, struct.pack(">I4s", z - a + 8, b"stsd") + data[a:z], len(tracks))


def _opened(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), os.path.abspath(root.removeprefix("file:")))


@dataclass
class _Files(InputPartition):
    paths: list[str]


class Packets(DataSource):
    """``spark.read.format("mp4_packets").load(root)``: a row for each sample of every MP4 file below ``root``, paths as from there.

    Options: ``digest`` (true: read the samples too and give each one's digest), ``files`` (of one partition, at most).
    """

    @classmethod
    def name(cls) -> str:
        return "mp4_packets"

    def schema(self) -> str:
        return PACKETS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.digest, self.files = options["path"], options.get("digest", "false") == "true", int(options.get("files", FILES))

    def partitions(self) -> list[InputPartition]:
        system, base = _opened(self.root)
        found = sorted((x.path, x.size) for x in system.get_file_info(fs.FileSelector(base, recursive=True)) if x.is_file and x.path.endswith(".mp4"))
        out, held = [_Files([])], 0
        for path, size in found:
            if len(out[-1].paths) >= self.files or (self.digest and held + size > BYTES and out[-1].paths):
                out.append(_Files([]))
                held = 0
            out[-1].paths.append(path)
            held += size
        return out

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        system, base = _opened(self.root)
        for path in partition.paths:
            with system.open_input_file(path) as file:
                try:
                    t = read_track(file)
                except (ValueError, KeyError, struct.error) as e:
                    raise ValueError(f"{path}: {e}") from e
                n, digests = len(t.sizes), None
                if self.digest:
                    digests = [_digest(file, a, s) for a, s in zip(t.offsets.tolist(), t.sizes.tolist(), strict=True)]
            same = lambda x, kind: pa.array(np.full(n, x), kind)
            width, height = t.size
            columns = [pa.array([os.path.relpath(path, base)] * n, pa.string()), pa.array(np.arange(n)), pa.array(t.pts), pa.array(t.dts), pa.array(t.durations), same(t.timescale, pa.int64()), pa.array(t.keys), pa.array(t.offsets), pa.array(t.sizes)]
            columns += [pa.array([t.codec] * n, pa.string()), same(width, pa.int32()), same(height, pa.int32()), same(t.streams, pa.int32()), pa.array(digests or [None] * n, pa.string())]
            yield pa.record_batch(columns, [c.split()[0] for c in PACKETS.split(", ")])


def _digest(file, offset: int, size: int) -> str:
    file.seek(offset)
    return hashlib.blake2b(file.read(size), digest_size=16).hexdigest()


def packets(spark: SparkSession, root: str, digest: bool = False) -> DataFrame:
    """The packets of all videos below ``root``."""
    spark.dataSource.register(Packets)
    return spark.read.format("mp4_packets").option("digest", str(digest).lower()).load(root)


def numbered(rows: DataFrame, fps: int = 30) -> DataFrame:
    """Adds ``frame``: the frame of the video that a packet shows, null where its time is none of a frame."""
    return rows.withColumn("frame", packet_frame(F.col("pts"), 1, F.col("timescale"), fps))


def packet_failures(rows: DataFrame, videos: DataFrame, fps: int = 30, packets: int = 0) -> DataFrame:
    """ep, view, problem for each video that cannot be cut. videos: ep, view, path, base (the episode's first frame in the video), n.

    One problem each, the first of: no video, other streams beside it, not H.264, another frame rate, a time that is none of a frame,
    two packets of one frame, frames of the episode that are missing, no keyframe at or before its start. ``packets``, how many
    rows there are, bounds what a task counts; both countings use the one exchange.
    """
    at = dealt(numbered(rows, fps).join(videos.select("ep", "view", "path", "base", "n"), "path"), "ep", "view", rows=packets)
    inside = (F.col("frame") >= F.col("base")) & (F.col("frame") < F.col("base") + F.col("n"))
    once = at.groupBy("ep", "view", "frame").agg(
        F.count(F.lit(1)).alias("k"), F.sum("duration").alias("duration"), F.max("timescale").alias("timescale"), F.max(inside).alias("inside"), F.max("key").alias("key"),
        F.max("base").alias("base"), F.max("n").alias("n"), F.max("streams").alias("streams"), F.max((~F.col("codec").isin(*H264)).cast("int")).alias("other"),
    )
    sums = once.groupBy("ep", "view").agg(
        F.max("streams").alias("streams"), F.max("other").alias("other"), (F.sum("k") * F.max("timescale")).alias("ticks"), F.sum("duration").alias("duration"),
        F.count_if(F.col("frame").isNull()).alias("odd"), F.count_if(F.col("frame").isNotNull() & (F.col("k") > 1)).alias("twice"),
        F.count_if("inside").alias("have"), F.max("n").alias("n"), F.min(F.when(F.col("key"), F.col("frame"))).alias("first_key"), F.max("base").alias("base"),
    )
    problem = (
        F.when(F.col("streams").isNull(), "no video").when(F.col("streams") != 1, "streams").when(F.col("other") > 0, "codec").when(F.col("ticks") != fps * F.col("duration"), "rate")
        .when(F.col("odd") > 0, "timestamp").when(F.col("twice") > 0, "duplicate").when(F.col("have") < F.col("n"), "missing").when(F.coalesce(F.col("first_key") > F.col("base"), F.lit(True)), "keyframe")
    )
    return videos.select("ep", "view").join(sums, ["ep", "view"], "left").select("ep", "view", problem.alias("problem")).filter("problem IS NOT NULL")


def keyframes(rows: DataFrame, videos: DataFrame, fps: int = 30) -> DataFrame:
    """ep, view, kf: frames that can be decoded by themselves, counted from the start of the episode; the video may go on at either end."""
    at = numbered(rows.filter("key"), fps).join(videos.select("ep", "view", "path", "base", "n"), "path")
    return at.select("ep", "view", (F.col("frame") - F.col("base")).alias("kf")).distinct()


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def _table(kind: bytes, columns: list[np.ndarray], version: int = 0) -> bytes:
    rows = np.stack(columns, 1)
    return _box(kind, struct.pack(">II", version << 24, len(rows)), rows.astype(">i4").tobytes())


def _run_lengths(values: np.ndarray) -> list[np.ndarray]:
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return [np.diff(np.r_[first, len(values)]), values[first]]


def movie_header(t: Track, data_at: int) -> bytes:
    """File type and movie boxes of ``t``, whose samples follow each other from ``data_at`` on, in a wide box of their own."""
    width, height = t.size
    lasts = int(t.durations.sum())
    matrix = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    begins = int(t.pts.min())  # where the first frame is shown
    shown = t.pts - t.dts
    tables = [t.description, _table(b"stts", _run_lengths(t.durations)), _table(b"ctts", _run_lengths(shown), 1), _table(b"stss", [np.flatnonzero(t.keys) + 1])]
    tables += [_table(b"stsc", [np.array([1]), np.array([len(t.sizes)]), np.array([1])]), _box(b"stsz", struct.pack(">III", 0, 0, len(t.sizes)), t.sizes.astype(">u4").tobytes()), _box(b"co64", struct.pack(">IIQ", 0, 1, data_at))]
    media = _box(b"minf", _box(b"vmhd", struct.pack(">IQ", 1, 0)), _box(b"dinf", _box(b"dref", struct.pack(">II", 0, 1), _box(b"url ", struct.pack(">I", 1)))), _box(b"stbl", *tables))
    handler = _box(b"hdlr", struct.pack(">II4s3I", 0, 0, b"vide", 0, 0, 0), b"video\0")
    mdia = _box(b"mdia", _box(b"mdhd", struct.pack(">5IHH", 0, 0, 0, t.timescale, lasts, 0x55C4, 0)), handler, media)
    track = struct.pack(">6I2I4H", 3, 0, 0, 1, 0, lasts, 0, 0, 0, 0, 0, 0) + matrix + struct.pack(">II", width << 16, height << 16)
    edits = _box(b"edts", _box(b"elst", struct.pack(">IIIiI", 0, 1, lasts, begins, 0x10000)))
    movie = struct.pack(">5IIHHII", 0, 0, 0, t.timescale, lasts, 0x10000, 0x100, 0, 0, 0) + matrix + struct.pack(">7I", *[0] * 6, 2)
    return _box(b"ftyp", b"isom", struct.pack(">I", 0x200), b"isomavc1mp41") + _box(b"moov", _box(b"mvhd", movie), _box(b"trak", _box(b"tkhd", track), edits, mdia))


def cut(t: Track, start: int, end: int, fps: int = 30) -> tuple[Track, np.ndarray]:
    """(the samples that show frames from ``start`` to before ``end``, their places); they must be whole groups of pictures."""
    frame = (2 * t.pts * fps + t.timescale) // (2 * t.timescale)
    pick = np.flatnonzero((frame >= start) & (frame < end))
    if len(pick) != end - start or len(np.unique(frame[pick])) != end - start:
        raise ValueError(f"{len(pick)} packets for frames {start} to {end}")
    if not t.keys[pick[0]] or frame[pick[0]] != start or (np.diff(pick) > 1).any():
        raise ValueError(f"frames {start} to {end} are no whole groups of pictures")
    begins = int(t.pts[pick].min())
    dts = t.dts[pick] - t.dts[pick[0]]
    # Shown from 0 on; what is decoded before it is shown keeps its lead.
    pts = t.pts[pick] - begins
    lead = max(0, int((dts - pts).max()))
    own = replace(t, sizes=t.sizes[pick], offsets=t.offsets[pick], durations=t.durations[pick], dts=dts, pts=pts + lead, keys=t.keys[pick])
    return own, pick


def copy_groups(cuts: DataFrame, root: str, output: str, fps: int = 30) -> DataFrame:
    """Write an MP4 file of copied samples for each of ``cuts`` (source_path, video_path, first, last: frames of the source, the last not included).

    Gives video_path, samples, bytes. A file gets its name when it is whole, so a task that runs again, or twice, leaves the same file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (source, base), (target, top) = _opened(root), _opened(output)
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                to = f"{top}/{row['video_path']}"
                with source.open_input_file(f"{base}/{row['source_path']}") as file:
                    own, _ = cut(read_track(file), row["first"], row["last"], fps)
                    head, size = movie_header(own, 0), int(own.sizes.sum())
                    head = movie_header(own, len(head) + 16)
                    target.create_dir(os.path.dirname(to))
                    part = f"{to}.{os.getpid()}-{hashlib.blake2b(os.urandom(8), digest_size=4).hexdigest()}.part"
                    with target.open_output_stream(part) as out:
                        out.write(head + struct.pack(">I4sQ", 1, b"mdat", size + 16))
                        for at, length in zip(own.offsets.tolist(), own.sizes.tolist(), strict=True):
                            file.seek(at)
                            for begin in range(0, length, BLOCK):
                                out.write(file.read(min(BLOCK, length - begin)))
                target.move(part, to)
                done.append((row["video_path"], len(own.sizes), len(head) + 16 + size))
            yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*done, strict=True) if done else ([], [], []), (pa.string(), pa.int64(), pa.int64()), strict=True)], ["video_path", "samples", "bytes"])

    spread = cuts.select("source_path", "video_path", F.col("first").cast("long").alias("first"), F.col("last").cast("long").alias("last")).repartition("source_path", "video_path")
    return spread.mapInArrow(run, "video_path string, samples long, bytes long")


def stream_differences(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """keys, position, problem where two streams (keys, position, digest) differ: ``truncated``, ``extra``, ``twice`` or ``bytes``.

    A full outer join by position; what stands twice at one position on either side is told apart first.
    """

    def once(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*keys, "position").agg(F.count(F.lit(1)).alias(f"{name}_k"), F.min("digest").alias(name))

    both = once(expected, "a").join(once(actual, "b"), [*keys, "position"], "full_outer")
    problem = F.when(F.col("b_k").isNull(), "truncated").when(F.col("a_k").isNull(), "extra").when((F.col("a_k") > 1) | (F.col("b_k") > 1), "twice").when(~F.col("a").eqNullSafe(F.col("b")), "bytes")
    return both.select(*keys, "position", problem.alias("problem")).filter("problem IS NOT NULL")


def cut_differences(spark: SparkSession, cuts: DataFrame, root: str, output: str, fps: int = 30) -> DataFrame:
    """video_path, position, problem: samples of written cuts that are not those of their source at the same place."""
    wanted = cuts.select("source_path", "video_path", "first", "last")
    source = numbered(packets(spark, root, digest=True), fps).withColumnRenamed("path", "source_path").join(wanted, "source_path")
    source = source.filter("frame >= first AND frame < last").select("video_path", (F.col("frame") - F.col("first")).alias("position"), "digest")
    made = numbered(packets(spark, output, digest=True), fps).withColumnRenamed("path", "video_path").join(wanted.select("video_path"), "video_path", "left_semi")
    return stream_differences(source, made.select("video_path", F.col("frame").alias("position"), "digest"), ["video_path"])


def frame_offset(seconds: Column, fps: int = 30) -> Column:
    """The frame at which an episode begins in its video; null where the time is off a frame by 1/1000 of one or more."""
    frame = F.round(seconds * fps).cast("long")
    return F.when(F.abs(seconds * fps - frame) < 1e-3, frame)
