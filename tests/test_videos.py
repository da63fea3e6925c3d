"""MP4 files that the test writes itself: packets, faults, copies of groups of pictures, and clips from them."""

import struct

import pytest
from pyspark.sql import functions as F

from tests.test_outputs import done  # noqa: F401
from tests.test_run import root  # noqa: F401
from trackloom.plans import clips
from trackloom.sources import frames as source
from trackloom.sources import sinks, videos


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def write_mp4(path, n, group=10, ticks=512, timescale=15360, late=0, codec=b"avc1", wide=False, skip=(), tracks=1, edit=True):
    """A video of ``n`` frames in groups whose frames are decoded as 0, 2, 1, 4, 3 and so on; returns {frame: bytes}."""
    order = [g + i for g in range(0, n, group) for i in _decoding(min(group, n - g))]
    order = [f for f in order if f not in skip]
    samples = [bytes([f % 251, 7]) * (40 + f % 13) for f in order]
    shown = [f * ticks + (2 * ticks if edit else 0) for f in order]
    offset = [s - i * ticks for i, s in enumerate(shown)]
    sizes = struct.pack(f">{len(order)}I", *map(len, samples))
    keys = [i + 1 for i, f in enumerate(order) if f % group == 0 and f >= late]
    chunks, at = [], 0
    while at < len(order):  # chunks of three, the last shorter
        chunks.append(samples[at : at + 3])
        at += 3
    runs = [(1, 3)] + ([(len(chunks), len(chunks[-1]))] if len(chunks[-1]) != 3 else [])

    def movie(places):
        entry = box(codec, bytes(24), struct.pack(">HH", 64, 48), bytes(50), box(b"avcC", b"\1\2\3"))
        stbl = [box(b"stsd", struct.pack(">II", 0, 1), entry), box(b"stts", struct.pack(">IIII", 0, 1, len(order), ticks))]
        stbl += [box(b"ctts", struct.pack(">II", 1 << 24, len(order)), *[struct.pack(">Ii", 1, o) for o in offset]), box(b"stss", struct.pack(">II", 0, len(keys)), *[struct.pack(">I", k) for k in keys])]
        stbl += [box(b"stsc", struct.pack(">II", 0, len(runs)), *[struct.pack(">III", a, k, 1) for a, k in runs]), box(b"stsz", struct.pack(">III", 0, 0, len(order)), sizes)]
        stbl += [box(b"co64", struct.pack(">II", 0, len(places)), struct.pack(f">{len(places)}Q", *places)) if wide else box(b"stco", struct.pack(">II", 0, len(places)), struct.pack(f">{len(places)}I", *places))]
        times = struct.pack(">IQQIQI", 1 << 24, 0, 0, timescale, n * ticks, 0) if wide else struct.pack(">6I", 0, 0, 0, timescale, n * ticks, 0)
        mdia = box(b"mdia", box(b"mdhd", times), box(b"hdlr", bytes(8), b"vide", bytes(13)), box(b"minf", box(b"vmhd", bytes(12)), box(b"stbl", *stbl)))
        elst = struct.pack(">IIQqI", 1 << 24, 1, n, 2 * ticks, 1 << 16) if wide else struct.pack(">IIIiI", 0, 1, n, 2 * ticks, 1 << 16)
        trak = box(b"trak", box(b"tkhd", bytes(84)), *([box(b"edts", box(b"elst", elst))] if edit else []), mdia)
        other = box(b"trak", box(b"tkhd", bytes(84)), box(b"mdia", box(b"hdlr", bytes(8), b"soun", bytes(13))))
        return box(b"moov", box(b"mvhd", struct.pack(">6I", 0, 0, 0, 1000, n, 0), bytes(76)), trak, *[other] * (tracks - 1))

    head = box(b"ftyp", b"isom", bytes(4)) + box(b"free", bytes(11))
    def places(start):
        out = []
        for c in chunks:
            out.append(start)
            start += sum(map(len, c)) + 5  # chunks need not touch
        return out

    body = b"".join(b"".join(c) + b"-gap-" for c in chunks)
    if wide:  # samples first, in a box with a long size
        data = head + struct.pack(">I4sQ", 1, b"mdat", len(body) + 16) + body + movie(places(len(head) + 16))
    else:
        size = len(movie([0] * len(chunks)))
        data = head + movie(places(len(head) + size + 8)) + box(b"mdat", body)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)
    return dict(zip(order, samples, strict=True))


def _decoding(n):
    out, i = [0], 1
    while i < n:
        out += [i + 1, i] if i + 1 < n else [i]
        i += 2
    return out


@pytest.mark.parametrize("wide", [False, True])
def test_packets_of_files(spark, tmp_path, wide):
    samples = write_mp4(tmp_path / "v/a/one.mp4", 47, wide=wide)
    write_mp4(tmp_path / "v/two.mp4", 20, wide=wide, edit=False)
    rows = videos.numbered(videos.packets(spark, f"{tmp_path}/v", digest=True)).collect()
    one = {r.frame: r for r in rows if r.path == "a/one.mp4"}
    assert set(one) == set(range(47)) and {f for f, r in one.items() if r.key} == {0, 10, 20, 30, 40} and sum(r.path == "two.mp4" for r in rows) == 20
    data = (tmp_path / "v/a/one.mp4").read_bytes()
    assert all(data[r.offset : r.offset + r.size] == samples[f] for f, r in one.items()) and len({r.digest for r in one.values()}) == 47
    assert {(r.codec, r.width, r.height, r.streams, r.timescale) for r in rows} == {("avc1", 64, 48, 1, 15360)}
    (tmp_path / "v/bad.mp4").write_bytes(b"\0\0\0\x08ftyp")
    with pytest.raises(Exception, match="bad.mp4: no movie header"):
        videos.packets(spark, f"{tmp_path}/v").count()


def test_faults_of_videos(spark, tmp_path):
    cases = {
        "good": {}, "later": {"base": 12}, "rate": {"ticks": 500}, "codec": {"codec": b"hev1"}, "streams": {"tracks": 2}, "missing": {"skip": (13,)},
        "keyframe": {"late": 10}, "short": {"base": 30}, "no video": None, "timestamp": {"skip": ()},
    }
    wanted = []
    for ep, (name, options) in enumerate(cases.items()):
        options = dict(options) if options is not None else None
        base = (options or {}).pop("base", 0)
        if options is not None:
            write_mp4(tmp_path / f"v/{name}.mp4", 60, **options)
        wanted.append((ep, "a", f"{name}.mp4", base, 40))
    wanted = spark.createDataFrame(wanted, "ep long, view string, path string, base long, n long")
    rows = videos.packets(spark, f"{tmp_path}/v").withColumn("pts", F.when((F.col("path") == "timestamp.mp4") & (F.col("sample") == 9), F.col("pts") + 3).otherwise(F.col("pts")))
    found = {r.ep: r.problem for r in videos.packet_failures(rows, wanted).collect()}
    names = list(cases)
    assert {names[e]: p for e, p in found.items()} == {"rate": "rate", "codec": "codec", "streams": "streams", "missing": "missing", "keyframe": "keyframe", "short": "missing", "no video": "no video", "timestamp": "timestamp"}
    marks = videos.keyframes(rows, wanted.filter("ep < 2")).orderBy("ep", "kf").collect()
    assert [(r.ep, r.kf) for r in marks] == [(0, k) for k in range(0, 60, 10)] + [(1, k) for k in range(-12, 48, 10)]


def test_copies_hold_the_samples_of_their_source(spark, tmp_path):
    samples = write_mp4(tmp_path / "v/one.mp4", 60)
    cuts = spark.createDataFrame([("one.mp4", "x/a.mp4", 10, 40), ("one.mp4", "x/b.mp4", 50, 60)], "source_path string, video_path string, first long, last long")
    out = f"{tmp_path}/out"
    for _ in range(2):  # a task that runs again leaves the same file
        done = {r.video_path: r for r in videos.copy_groups(cuts, f"{tmp_path}/v", out).collect()}
        first = first if _ else (tmp_path / "out/x/a.mp4").read_bytes()  # noqa: F821
    assert first == (tmp_path / "out/x/a.mp4").read_bytes() and done["x/a.mp4"].samples == 30 and done["x/a.mp4"].bytes == len(first)
    assert sorted(p.name for p in (tmp_path / "out/x").iterdir() if not p.name.startswith(".")) == ["a.mp4", "b.mp4"]
    rows = {r.frame: r for r in videos.numbered(videos.packets(spark, out)).filter("path = 'x/a.mp4'").collect()}
    assert set(rows) == set(range(30)) and all(first[r.offset : r.offset + r.size] == samples[10 + f] for f, r in rows.items())
    assert {f for f, r in rows.items() if r.key} == {0, 10, 20} and min(r.dts for r in rows.values()) == 0
    assert videos.cut_differences(spark, cuts, f"{tmp_path}/v", out).isEmpty()
    changed = bytearray(first)
    changed[rows[7].offset] ^= 1
    (tmp_path / "out/x/a.mp4").write_bytes(changed)
    write_mp4(tmp_path / "out/x/b.mp4", 9)
    found = sorted((r.video_path, r.position, r.problem) for r in videos.cut_differences(spark, cuts, f"{tmp_path}/v", out).collect())
    assert found[0] == ("x/a.mp4", 7, "bytes") and ("x/b.mp4", 9, "truncated") in found
    for a, z, problem in ((11, 40, "no whole groups"), (10, 35, None), (50, 61, "10 packets")):
        bad = spark.createDataFrame([("one.mp4", "y.mp4", a, z)], cuts.schema)
        if problem:
            with pytest.raises(Exception, match=problem):
                videos.copy_groups(bad, f"{tmp_path}/v", out).collect()


def test_streams_are_compared_by_position(spark):
    a = spark.createDataFrame([(1, i, f"d{i}") for i in range(6)] + [(2, 0, "x")], "k long, position long, digest string")
    b = spark.createDataFrame([(1, 0, "d0"), (1, 1, "d2"), (1, 2, "d1"), (1, 3, "d3"), (1, 3, "d4"), (1, 6, "d6"), (2, 0, "x")], a.schema)
    found = sorted((r.k, r.position, r.problem) for r in videos.stream_differences(a, b, ["k"]).collect())
    assert found == [(1, 1, "bytes"), (1, 2, "bytes"), (1, 3, "twice"), (1, 4, "truncated"), (1, 5, "truncated"), (1, 6, "extra")]


def test_clips_take_keyframes_from_videos(spark, done, tmp_path):  # noqa: F811
    """Episode 1 keeps frames 35 to 80; its videos begin between frames, and then at frame 40."""
    annotation, _ = done
    for v in source.VIEWS:
        at = tmp_path / f"videos/observation.images.{v}/chunk-000"
        write_mp4(at / "file-000.mp4", 130)
        write_mp4(at / "file-001.mp4", 130, group=5)
    with pytest.raises(ValueError, match="episode 1, camera_aux_0: offset"):
        clips.run(spark, annotation, f"{tmp_path}/a", video_root=str(tmp_path))
    keep = clips.read_annotation

    def moved(*args):
        pieces, episodes, summary = keep(*args)
        return pieces, episodes.withColumns({f"{v}_from": F.lit(40 / 30) for v in source.VIEWS}), summary

    clips.read_annotation = moved
    try:
        found = clips.run(spark, annotation, f"{tmp_path}/b", video_root=str(tmp_path), copy=True)
        assert found["copied_files"] == 2 and found["methods"]["gop_copy"]["clips"] == 2 and found["methods"]["gop_copy"]["encoded_frames"] == 0
        assert not sinks.exists(spark, f"{tmp_path}/b/stages")
        made = tmp_path / "b/videos/camera_aux_0/chunk-000/episode-000001-segment-0000.mp4"
        assert videos.packets(spark, str(made.parent)).count() == 45
        for v in source.VIEWS:
            write_mp4(tmp_path / f"videos/observation.images.{v}/chunk-000/file-001.mp4", 119)
        with pytest.raises(ValueError, match="episode 1, camera_aux_0: missing"):
            clips.run(spark, annotation, f"{tmp_path}/c", video_root=str(tmp_path))
    finally:
        clips.read_annotation = keep
