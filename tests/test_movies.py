"""Images, sources and streaming against plain loops and damaged files."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.operators import checks as C
from tracelake.operators import images as I
from tracelake.operators import regions
from tracelake.plans import flows, queries
from tracelake.sources import discovery, metadata, sets, sinks, tiff
from tracelake.streaming import motion


def write_tiff(path, frames, contiguous=False, stamps=None):
    """A little-endian TIFF; ``contiguous``: one header before all frames."""
    frames = np.asarray(frames)
    n, h, w = frames.shape[:3]
    samples = frames.shape[3] if frames.ndim == 4 else 1
    bits = frames.dtype.itemsize * 8
    said = f"images={n}\0".encode() if contiguous else b"\0"
    out, at = b"II*\0", 8
    heads = 1 if contiguous else n
    blobs = [frames.tobytes()] if contiguous else [f.tobytes() for f in frames]
    body, chain = b"", []
    for i in range(heads):
        start = at + len(body)
        tags = [(256, 4, w), (257, 4, h), (258, 3, bits), (259, 3, 1), (262, 3, 1), (277, 3, samples), (279, 4, h * w * samples * bits // 8)]
        if stamps is not None:
            tags += [(32781, 4, stamps[i] >> 32), (32782, 4, stamps[i] & 0xFFFFFFFF)]
        size = 2 + 12 * (len(tags) + 2) + 4
        text_at = start + size
        data_at = text_at + len(said)
        entries = [struct.pack("<HHII", t, k, 1, v) for t, k, v in tags]
        entries.append(struct.pack("<HHII", 270, 2, len(said), text_at) if len(said) > 4 else struct.pack("<HHI4s", 270, 2, len(said), said.ljust(4, b"\0")))
        entries.append(struct.pack("<HHII", 273, 4, 1, data_at))
        entries.sort(key=lambda e: struct.unpack("<H", e[:2]))
        after = data_at + len(blobs[i])
        after += after % 2
        chain.append(after if i + 1 < heads else 0)
        body += struct.pack("<H", len(entries)) + b"".join(entries) + struct.pack("<I", chain[-1]) + said + blobs[i]
        body += b"\0" * (len(body) % 2)
    path.write_bytes(out + struct.pack("<I", 8) + body)


def load(spark, path, **options):
    tiff.register(spark)
    return spark.read.format("tiff_movie").options(**options).load(str(path))


def test_movie_parts_equal_frames_for_any_block(spark, tmp_path):
    rng = np.random.default_rng(1)
    parts = [rng.integers(50, 60000, (n, 8, 10)).astype(np.uint16) for n in (7, 1, 5)]
    for i, p in enumerate(parts):
        write_tiff(tmp_path / f"part{i + 9}.tif", p)
    (tmp_path / ".hidden.tif").write_bytes(b"x")
    whole = np.concatenate(parts)
    for block in (0.0001, 1):
        rows = load(spark, tmp_path, block_mb=block).orderBy("frame").collect()
        assert [r["frame"] for r in rows] == list(range(13)) and [r["part"] for r in rows] == [0] * 7 + [1] + [2] * 5
        assert np.array_equal(np.array([r["pixels"] for r in rows]).reshape(whole.shape), whole)
    assert load(spark, tmp_path, trim=3).count() == 10 and tiff.count_frames(str(tmp_path)) == 13


def test_rgb_is_the_mean_of_three(spark, tmp_path):
    rgb = np.random.default_rng(2).integers(0, 255, (6, 4, 5, 3)).astype(np.uint8)
    write_tiff(tmp_path / "a.tif", rgb)
    got = np.array([r["pixels"] for r in load(spark, tmp_path).orderBy("frame").collect()]).reshape(6, 4, 5)
    assert np.allclose(got, rgb.mean(axis=3))


def test_contiguous_giant_and_damage(spark, tmp_path):
    x = np.random.default_rng(3).integers(0, 60000, (37, 6, 5)).astype(np.uint16)
    write_tiff(tmp_path / "a.tif", x, contiguous=True)
    assert load(spark, tmp_path).filter("error is null").count() == 37
    whole = (tmp_path / "a.tif").read_bytes()
    (tmp_path / "a.tif").write_bytes(whole[: -5 * 60])
    rows = load(spark, tmp_path)
    assert rows.filter("error is null").count() == 32 and C.truncations(rows).first()["at_frame"] == 32
    other = tmp_path / "other"
    other.mkdir()
    write_tiff(other / "b.tif", x[:8])
    raw = (other / "b.tif").read_bytes()
    (other / "b.tif").write_bytes(raw[:-31])
    write_tiff(other / "c.tif", x[:2])
    rows = load(spark, other)
    assert C.contiguous_prefix(rows).count() == 7 and rows.filter("error is not null").count() == 1
    with pytest.raises(Exception, match="metadata"):
        C.complete_runs(C.contiguous_prefix(rows), spark.createDataFrame([("other", 8)], "run string, expected int")).collect()


def test_stamps_and_rate(spark, tmp_path):
    stamps = [2**33 + i * 66_666_667 for i in range(4)]
    write_tiff(tmp_path / "a.tif", np.zeros((4, 2, 2), np.uint8), stamps=stamps)
    tags = load(spark, tmp_path).select("run", "page", "tags")
    assert abs(metadata.camera_rate(tags).first()["fps"] - 15.0) < 1e-3
    timed = metadata.page_times(tags).orderBy("page").collect()
    assert timed[0]["delta_ms"] is None and timed[1]["delta_ms"] == 66.667 and timed[3]["t_seconds"] == 0.2
    bare = tags.withColumn("tags", F.map_filter("tags", lambda k, v: k < "3"))
    assert metadata.camera_rate(bare).first()["fps"] == 15.0


def packed(a, compression):
    """Bytes of an image by each scheme; LZW with codes of growing width and clears."""
    raw = a.tobytes()
    if compression == 8:
        return zlib.compress(raw)
    if compression == 32773:
        out, at = b"", 0
        while at < len(raw):
            run = 1
            while run < 128 and at + run < len(raw) and raw[at + run] == raw[at]:
                run += 1
            out += bytes([257 - run & 255, raw[at]]) if run > 1 else bytes([0, raw[at]])
            at += run
        return out
    if compression == 5:
        bits, table, word, width = "", {}, b"", 9
        fresh = lambda: {bytes([i]): i for i in range(256)}
        bits, table = f"{256:09b}", fresh()
        for i in range(len(raw)):
            now = word + raw[i : i + 1]
            if now in table:
                word = now
                continue
            bits += f"{table[word]:0{width}b}"
            table[now] = len(table) + 2
            size = len(table) + 2
            width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
            if size >= 4094:
                bits += f"{256:0{width}b}"
                table, width = fresh(), 9
            word = raw[i : i + 1]
        bits += f"{table[word]:0{width}b}"
        size = len(table) + 3
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        bits += f"{257:0{width}b}"
        bits += "0" * (-len(bits) % 8)
        return int(bits, 2).to_bytes(len(bits) // 8, "big")
    return raw


def write_blocks(path, frames, compression=1, predictor=1, tile=None, rows=None, said=None):
    """A little-endian TIFF with strips of ``rows`` or tiles of ``tile``, by a scheme."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for k, frame in enumerate(frames):
        h, w = frame.shape
        th, tw = tile or (rows or h, w)
        blocks = []
        for y in range(0, h, th):
            for x in range(0, w, tw):
                part = frame[y : y + th, x : x + tw]
                if tile:
                    part = np.pad(part, ((0, th - part.shape[0]), (0, tw - part.shape[1])))
                if predictor == 2:
                    part = np.concatenate([part[:, :1], part[:, 1:] - part[:, :-1]], axis=1).astype(frame.dtype)
                blocks.append((len(out), packed(np.ascontiguousarray(part), compression)))
                out += blocks[-1][1]
        entries = [(256, 4, [w]), (257, 4, [h]), (258, 3, [frame.dtype.itemsize * 8]), (259, 3, [compression]), (277, 3, [1]), (317, 3, [predictor])]
        entries += [(322, 4, [tw]), (323, 4, [th]), (324, 4, [b[0] for b in blocks]), (325, 4, [len(b[1]) for b in blocks])] if tile else [(273, 4, [b[0] for b in blocks]), (278, 4, [th]), (279, 4, [len(b[1]) for b in blocks])]
        if said and k == 0:
            entries.append((270, 2, said.encode() + b"\0"))
        body = b""
        for tag, kind, value in sorted(entries):
            data = value if kind == 2 else struct.pack(f"<{len(value)}{'HI'[kind == 4]}", *value)
            if len(data) > 4:
                at = len(out)
                out += data
                data = struct.pack("<I", at)
            body += struct.pack("<HHI", tag, kind, len(value)) + data.ljust(4, b"\0")
        at = len(out)
        out[link : link + 4] = struct.pack("<I", at)
        out += struct.pack("<H", len(entries)) + body + b"\0\0\0\0"
        link = len(out) - 4
    path.write_bytes(bytes(out))


@pytest.mark.parametrize("compression", [1, 5, 8, 32773])
def test_codecs_strips_and_tiles(tmp_path, compression):
    rng = np.random.default_rng(compression)
    movie = np.repeat(rng.integers(0, 60_000, (2, 33, 21)), 3, axis=2).astype(np.uint16)[:, :, :50]
    for predictor in (1, 2):
        for shape in ({}, {"rows": 7}, {"tile": (16, 32)}):
            write_blocks(tmp_path / "a.tif", movie, compression, predictor, **shape)
            with tiff.opened(str(tmp_path / "a.tif")) as f:
                got = [tiff.image(f, page) for _, page, wrong in tiff.pages_from(f, f.size(), tiff.Chain(f).first, 0, 2, 0) if wrong is None]
            assert np.array_equal(np.array(got), movie)
    noise = rng.integers(0, 256, (1, 90, 100)).astype(np.uint8)  # enough for every width of codes
    write_blocks(tmp_path / "b.tif", noise, compression)
    with tiff.opened(str(tmp_path / "b.tif")) as f:
        assert np.array_equal(tiff.image(f, tiff.Chain(f).page(tiff.Chain(f).first)), noise[0])


class Counted:
    """A file that counts what is read of it."""

    def __init__(self, f):
        self.f, self.n = f, 0

    def __getattr__(self, name):
        return getattr(self.f, name)

    def read(self, *size):
        data = self.f.read(*size)
        self.n += len(data)
        return data


def test_filters_reach_the_files(spark, tmp_path):
    movie = np.random.default_rng(31).integers(0, 60_000, (40, 30, 20)).astype(np.uint16)
    write_tiff(tmp_path / "part2.tif", movie[25:])
    write_tiff(tmp_path / "part1.tif", movie[:25])
    rows = load(spark, tmp_path, block_mb=0.005).filter("frame >= 22 and frame < 27").orderBy("frame").collect()
    assert [(r["frame"], r["part"], r["page"]) for r in rows] == [(22, 0, 22), (23, 0, 23), (24, 0, 24), (25, 1, 0), (26, 1, 1)]
    assert np.array_equal(np.array([r["pixels"] for r in rows]).reshape(5, 30, 20), movie[22:27])
    reader = tiff.MovieReader({"path": str(tmp_path), "block_mb": "0.005"})
    every = reader.partitions()
    list(reader.pushFilters([tiff.GreaterThanOrEqual(("frame",), 22), tiff.LessThan(("frame",), 27)]))
    some = reader.partitions()
    assert len(every) == 11 and [(b.part, b.first) for b in some] == [(0, 20), (0, 24), (1, 0)]
    assert sum(len(list(reader.read(b))) for b in some) == 5
    with tiff.opened(str(tmp_path / "part1.tif")) as f:
        counted = Counted(f)
        tiff.walk(counted, f.size(), 1 << 20)
        assert counted.n < 25 * 100  # the chain, and one header
        walked, counted.n = counted.n, 0
        for _, page, _ in tiff.pages_from(counted, f.size(), tiff.walk(f, f.size(), 0).starts[7], 7, 1, 0):
            tiff.image(counted, page)
        assert 1200 <= counted.n < 1200 + 400 and walked
    files = discovery.split_path(spark.createDataFrame([(str(p), p.stat().st_size) for p in tmp_path.glob("*.tif")], "path string, length long"))
    pages = tiff.index(files)
    assert pages.filter("error is null").count() == 40
    got = tiff.pixels_of(pages.filter("frame between 24 and 25")).orderBy("frame").collect()
    assert np.array_equal(np.array([r["pixels"] for r in got]).reshape(2, 30, 20), movie[24:26])


def test_series_follow_their_description_if_it_is_whole(spark, tmp_path):
    movie = np.random.default_rng(32).integers(0, 60_000, (6, 4, 5)).astype(np.uint16)
    order = [("b.ome.tif", 1), ("a.ome.tif", 0), ("a.ome.tif", 2), ("b.ome.tif", 0), ("a.ome.tif", 1), ("b.ome.tif", 2)]  # time to file and page
    blocks = "".join(f'<TiffData FirstT="{t}" IFD="{k}" PlaneCount="1"><UUID FileName="{name}">u</UUID></TiffData>' for t, (name, k) in enumerate(order))
    said = f'<OME xmlns="http://www.openmicroscopy.org/Schemas/OME/2015-01"><Image><Pixels SizeC="1" SizeZ="1" SizeT="6" DimensionOrder="XYCZT">{blocks}</Pixels></Image></OME>'
    for name in ("a.ome.tif", "b.ome.tif"):
        write_blocks(tmp_path / name, [movie[t] for k in range(3) for t, (n, page) in enumerate(order) if n == name and page == k], said=said)
    files = discovery.split_path(spark.createDataFrame([(str(p), p.stat().st_size) for p in tmp_path.glob("*.tif")], "path string, length long"))
    pages = tiff.index(files)
    for expected, want in ((6, list(range(6))), (7, [t for name in ("a.ome.tif", "b.ome.tif") for k in range(3) for t, (n, page) in enumerate(order) if n == name and page == k])):
        rows = tiff.pixels_of(tiff.series_pages(pages, spark.createDataFrame([(str(tmp_path), expected)], "run string, expected int"))).orderBy("frame").collect()
        assert [r["frame"] for r in rows] == list(range(6)) and np.array_equal(np.array([r["pixels"] for r in rows]).reshape(6, 4, 5), movie[want])
    (tmp_path / "two").mkdir()
    write_blocks(tmp_path / "two" / "c.ome.tif", movie[:2], said=said.replace('SizeC="1"', 'SizeC="2"').replace(blocks, "<TiffData/>").replace('SizeT="6"', 'SizeT="1"'))
    files = discovery.split_path(spark.createDataFrame([(str(tmp_path / "two" / "c.ome.tif"), 9)], "path string, length long"))
    with pytest.raises(Exception, match="several channels"):
        tiff.series_pages(tiff.index(files), spark.createDataFrame([(str(tmp_path / "two"), 2)], "run string, expected int")).collect()


def test_a_growing_recording_as_a_stream(spark, tmp_path):
    movie = np.random.default_rng(33).integers(0, 60_000, (12, 5, 6)).astype(np.uint16)
    folder = tmp_path / "in"
    folder.mkdir()
    tiff.register(spark)

    def batch():
        stream = spark.readStream.format("tiff_movie").option("block_mb", "0.0002").load(str(folder))
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "out")).orderBy("frame").collect()
        assert np.array_equal(np.array([r["pixels"] for r in rows]).reshape(-1, 5, 6), movie[: len(rows)])
        return [r["frame"] for r in rows]

    write_tiff(folder / "p1.tif", movie[:3])
    assert batch() == [0, 1, 2] and batch() == [0, 1, 2]
    write_tiff(folder / "p1.tif", movie[:8])
    (folder / "p1.tif").write_bytes((folder / "p1.tif").read_bytes()[:-20])  # the last page is on its way
    assert batch() == list(range(7))
    write_tiff(folder / "p1.tif", movie[:8])
    write_tiff(folder / "p2.tif", movie[8:])
    assert batch() == list(range(12))


def pixels_of(spark, a):
    rows = [("m", t, y, x, float(a[t, y, x])) for t in range(a.shape[0]) for y in range(a.shape[1]) for x in range(a.shape[2])]
    return spark.createDataFrame(rows, "run string, frame long, y int, x int, v double")


def test_box_traces_three_ways(spark, tmp_path):
    a = np.random.default_rng(4).normal(size=(6, 5, 7))
    boxes = spark.createDataFrame([("m", "p", 1, 1, 4, 5), ("m", "q", 0, 0, 7, 2)], "run string, box string, x0 int, y0 int, x1 int, y1 int")
    want = {("p", t): (a[t, 1:5, 1:4].mean(), 0.0 if not t else np.abs(a[t, 1:5, 1:4] - a[t - 1, 1:5, 1:4]).mean()) for t in range(6)}
    frames = I.to_frames(pixels_of(spark, a))
    for got in (I.box_traces(pixels_of(spark, a), boxes), I.frame_box_traces(frames, boxes), I.box_traces(pixels_of(spark, a), boxes, block=2), I.frame_box_traces(frames, boxes, block=1)):
        assert got.count() == 12
        for r in got.filter("box = 'p'").collect():
            assert np.allclose((r["lum"], r["me"]), want["p", r["frame"]])
    # the same in a stream, whose last file comes after a gap
    frames = frames.select("run", "frame", "h", "w", "pixels").cache()
    for k, cond in enumerate(("frame < 2", "frame in (2, 3)", "frame = 5")):
        frames.filter(cond).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = motion.motion_traces(motion.read_frames(spark, str(tmp_path / "in"), I.FRAMES), [("p", 1, 1, 4, 5)])
        motion.write_traces(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "out")).orderBy("frame").collect()
        assert [r["frame"] for r in rows] == list(range((2, 4, 4)[k]))
        assert all(np.allclose((r["lum"], r["me"]), want["p", r["frame"]]) for r in rows)


def test_stream_goes_on_once_a_gap_is_filled(spark, tmp_path):
    a = np.random.default_rng(9).normal(size=(12, 5, 7))
    frames = I.to_frames(pixels_of(spark, a)).select("run", "frame", "h", "w", "pixels").cache()
    box = a[:, 1:5, 1:]
    for k, cond in enumerate(("frame < 5", "frame between 6 and 9", "frame = 5", "frame in (9, 10, 11)")):
        frames.filter(cond).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        # the second box ends beyond the image
        stream = motion.motion_traces(motion.read_frames(spark, str(tmp_path / "in"), I.FRAMES), [("q", 0, 0, 2, 2), ("p", 1, 1, 9, 5)])
        motion.write_traces(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "out")).filter("box = 'p'").orderBy("frame").collect()
        assert [r["frame"] for r in rows] == list(range((5, 5, 10, 12)[k]))
        for r in rows:
            t = r["frame"]
            assert np.allclose((r["lum"], r["me"]), (box[t].mean(), np.abs(box[t] - box[t - 1]).mean() if t else 0.0))


def test_a_gap_that_never_closes_is_reported_and_given_up(spark, tmp_path):
    a = np.random.default_rng(29).normal(size=(14, 4, 5))
    frames = I.to_frames(pixels_of(spark, a)).select("run", "frame", "h", "w", "pixels").cache()
    seen = []
    for cond in ("frame < 2", "frame between 5 and 7", "frame in (8, 9)", "frame = 3", "frame >= 10"):
        frames.filter(cond).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = motion.motion_traces(motion.read_frames(spark, str(tmp_path / "in"), I.FRAMES), [("p", 0, 0, 3, 3)], most=3)
        motion.write_traces(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "out")).orderBy("frame").collect()
        seen.append(([r["frame"] for r in rows if r["box"]], [(r["frame"], r["missing"]) for r in rows if r["box"] is None]))
    gap = [(2, 3)]
    assert seen == [([0, 1], []), ([0, 1], []), ([0, 1, 5, 6, 7, 8, 9], gap), ([0, 1, 5, 6, 7, 8, 9], gap), ([0, 1, *range(5, 14)], gap)]
    by_frame = {r["frame"]: r for r in rows if r["box"]}
    assert by_frame[5]["me"] == 0 and np.isclose(by_frame[6]["me"], np.abs(a[6] - a[5])[:3, :3].mean())


def test_correlation_map_interior(spark):
    a = np.random.default_rng(5).normal(size=(30, 6, 6))
    got = {(r["y"], r["x"]): r["r"] for r in I.correlation_map(I.to_frames(pixels_of(spark, a))).collect()}
    s = a[:, 1:4, 2:5].sum(axis=(1, 2)) - a[:, 2, 3]
    assert abs(got[2, 3] - np.corrcoef(a[:, 2, 3], s)[0, 1]) < 1e-9
    flat = {r["r"] for r in I.correlation_map(I.to_frames(pixels_of(spark, np.ones((4, 3, 3))))).collect()}
    assert flat == {0.0}


def scene(shift=(0.0, 0.0), n=32):
    y, x = np.mgrid[:n, :n]
    dy, dx = shift
    return sum(np.exp(-((y - cy - dy) ** 2 + (x - cx - dx) ** 2) / 8) for cy, cx in ((10, 12), (20, 18), (15, 22)))


def test_registration(spark):
    f = np.fft.fft2(scene())
    for d in ((0.0, 0.0), (1.3, -2.4), (-0.7, 0.2)):
        got = I.estimate_shift(f, scene(d))
        assert np.allclose(got, (-d[0], -d[1]), atol=0.06)
        assert np.abs(I.shift_image(scene(d), -d[0], -d[1]) - scene())[5:-5, 5:-5].max() < 0.01
    shifts = [(2 * np.sin(t / 3), np.cos(t / 2)) for t in range(12)]
    frames = spark.createDataFrame([("m", t, 32, 32, scene(d).ravel().tolist()) for t, d in enumerate(shifts)], I.FRAMES)
    _, table = I.register(frames)
    rows = table.filter("pass = 2").orderBy("frame").collect()
    assert np.corrcoef([r["dy"] for r in rows], [-d[0] for d in shifts])[0, 1] > 0.95


def test_regions_and_traces(spark):
    rng = np.random.default_rng(6)
    y, x = np.mgrid[:20, :22]
    cells = [np.exp(-((y - cy) ** 2 + (x - cx) ** 2) / 6) for cy, cx in ((6, 6), (13, 15))]
    signals = rng.gamma(1.0, 3.0, (2, 60))
    a = sum(c[None] * s[:, None, None] for c, s in zip(cells, signals, strict=True)) + rng.normal(0, 0.2, (60, 20, 22)) + 10
    pixels = pixels_of(spark, a)
    frames = I.to_frames(pixels)
    cmap = I.correlation_map(frames)
    found = I.dense_labels(I.regions(frames, cmap, 0.6, 3, 80, attempts=4))
    rois = I.roi_table(found).collect()
    centres = sorted((round(r["cy"]), round(r["cx"])) for r in rois)
    assert (6, 6) in centres and (13, 15) in centres
    traces = I.dff_traces(I.roi_traces(pixels, found))
    first = next(r["roi"] for r in rois if (round(r["cy"]), round(r["cx"])) == (6, 6))
    got = [r["dff"] for r in traces.filter(F.col("roi") == first).orderBy("frame").collect()]
    assert np.corrcoef(got, signals[0])[0, 1] > 0.7


def plain_regions(a, c, level, least, most, cap, attempts):
    """Growth by sets of pixels: rings of neighbours whose trace correlates with the mean trace of the region."""
    h, w = c.shape
    free = {(y, x) for y in range(h) for x in range(w) if c[y, x] != 0}
    labels, n, tried = {}, 0, 0
    while free and tried < attempts:
        seed = max(sorted(free), key=lambda p: c[p])
        region = {seed}
        while len(region) < cap:
            ring = sorted({(y + i, x + j) for y, x in region for i in (-1, 0, 1) for j in (-1, 0, 1)} & free - region)
            mean = np.mean([a[:, y, x] for y, x in sorted(region)], axis=0)
            good = [p for p in ring if a[:, p[0], p[1]].std() and mean.std() and np.corrcoef(mean, a[:, p[0], p[1]])[0, 1] > level]
            if not good:
                break
            region |= set(good)
        free -= region
        tried += 1
        if least < len(region) < most:
            n += 1
            labels |= dict.fromkeys(region, n)
    return labels


def test_regions_equal_plain_growth(spark):
    rng = np.random.default_rng(9)
    y, x = np.mgrid[:14, :15]
    for seed in range(3):
        spots = [np.exp(-((y - rng.integers(3, 11)) ** 2 + (x - rng.integers(3, 12)) ** 2) / 5) for _ in range(3)]
        a = sum(s[None] * rng.gamma(1, 2, 40)[:, None, None] for s in spots) + rng.normal(0, 0.4, (40, 14, 15))
        c = rng.uniform(0.1, 0.9, (14, 15))
        c[:2], c[-2:], c[:, :2], c[:, -2:] = 0, 0, 0, 0
        frames = I.to_frames(pixels_of(spark, a))
        cmap = spark.createDataFrame([("m", i, j, float(c[i, j])) for i in range(14) for j in range(15)], "run string, y int, x int, r double")
        for cap in (None, 12):
            found = {(r["y"], r["x"]): r["roi"] for r in I.regions(frames, cmap, 0.35, 1, 40, attempts=12, cap=cap).collect()}
            assert found == plain_regions(a, c, 0.35, 1, 40, cap or 80, 12)


def test_any_tiles_give_the_same_regions(spark):
    rng = np.random.default_rng(19)
    y, x = np.mgrid[:18, :17]
    spots = [np.exp(-((y - rng.integers(2, 16)) ** 2 + (x - rng.integers(2, 15)) ** 2) / 6) for _ in range(4)]
    a = sum(s[None] * rng.gamma(1, 2, 40)[:, None, None] for s in spots) + rng.normal(0, 0.5, (40, 18, 17))
    a[:, 4, 5] = 3.1  # constant
    c = rng.uniform(0.1, 0.9, (18, 17)).round(1)  # with ties
    frames = I.to_frames(pixels_of(spark, a)).cache()
    cmap = spark.createDataFrame([("m", i, j, float(c[i, j])) for i in range(18) for j in range(17)], "run string, y int, x int, r double")
    for attempts in (9, None):
        whole, *others = ([(r["attempt"], sorted(map(tuple, r["pixels"]))) for r in regions.attempted(frames, cmap, 0.4, 25, attempts, tile=t, halo=g).orderBy("attempt").collect()] for t, g in ((64, 8), (6, 2), (9, 4)))
        assert all(o == whole for o in others) and len(whole) > 8
    free, found = {(i, j) for i in range(18) for j in range(17)}, []
    for _, region in whole:  # in the seeds' order, and each pixel once
        assert set(region) <= free
        free -= set(region)


def test_sweep_takes_each_runs_own_thresholds(spark):
    rng = np.random.default_rng(10)
    a = rng.normal(size=(30, 9, 9)).cumsum(axis=1)
    b = rng.normal(size=(30, 9, 9)).cumsum(axis=2) * 5
    frames = I.to_frames(pixels_of(spark, a).unionByName(pixels_of(spark, b).withColumn("run", F.lit("n"))))
    cmap = I.correlation_map(frames)
    rows = I.threshold_sweep(frames, cmap, 2, 30, (0.5, 0.9), cap=25).collect()
    assert len(rows) == 4 and len({r["threshold"] for r in rows}) == 4
    for r in rows:
        level = np.round(np.percentile([x["r"] for x in cmap.filter(f"run = '{r['run']}' and r > 0").collect()], 100 * r["point"]), 3)
        one = I.attempted(frames.filter(F.col("run") == r["run"]), cmap.filter(F.col("run") == r["run"]), float(level), 25, None, 3).collect()
        sizes = [x["size"] for x in one]
        good = [n for n in sizes if 2 < n < 30]
        assert (r["threshold"], r["attempts"], r["accepted"], r["at_cap"], r["median_area"]) == (level, len(sizes), len(good), sum(n >= 25 for n in sizes), np.median(good) if good else 0)
        assert r["sizes"] == [sum(lo <= n <= (hi or 10**9) for n in sizes) for lo, hi in I.SIZES]
    assert I.threshold_sweep(frames.limit(0), cmap.limit(0), 2, 30).count() == 0


def test_flows_isolate_runs_that_fail(spark):
    rng = np.random.default_rng(23)
    y, x = np.mgrid[:24, :26]
    cells = [np.exp(-((y - cy) ** 2 + (x - cx) ** 2) / 6) for cy, cx in ((8, 9), (15, 17))]
    signals = rng.gamma(1.0, 4.0, (2, 40))
    a = sum(c[None] * s[:, None, None] for c, s in zip(cells, signals, strict=True)) + rng.normal(0, 0.1, (40, 24, 26)) + 20 + 6 * rng.normal(size=(24, 26))
    rows = [(run, t, 24, 26, a[t].ravel().tolist(), "p", "cut" if run == "torn" and t == 30 else None) for run, n in (("good", 40), ("short", 35), ("torn", 40)) for t in range(n)]
    frames = spark.createDataFrame(rows, I.FRAMES + ", part string, error string").cache()
    expected = spark.createDataFrame([(r, 40) for r in ("good", "short", "torn", "gone")], "run string, expected int")
    boxes = spark.createDataFrame([(r, "paw", 2, 3, 9, 8) for r in ("good", "short", "torn")], "run string, box string, x0 int, y0 int, x1 int, y1 int")
    out = flows.behaviour(frames, boxes, expected)
    got = {r["run"]: (r["status"], r["reason"]) for r in out["outcomes"].collect()}
    assert got == {"good": ("flagged", None), "short": ("failed", "35 of 40 frames"), "torn": ("failed", "frame 30: cut"), "gone": ("failed", "no frames")}
    lum = out["traces"].orderBy("frame").collect()
    assert [r["run"] for r in lum] == ["good"] * 40 and np.allclose([r["lum"] for r in lum], a[:, 3:8, 2:9].mean(axis=(1, 2)))
    assert flows.exit_code(out["outcomes"]) == 2 and flows.exit_code(out["outcomes"].filter("run = 'good'")) == 3
    out = flows.calcium(frames, expected, flows.Extraction(bin=1, threshold=0.6, least=3, most=120, attempts=4, border=2, least_rois=2))
    assert {r["run"]: r["status"] for r in out["outcomes"].collect()} == {"good": "ok", "short": "failed", "torn": "failed", "gone": "failed"}
    rois = out["rois"].collect()
    near = [min(rois, key=lambda r: (r["cy"] - cy) ** 2 + (r["cx"] - cx) ** 2) for cy, cx in ((8, 9), (15, 17))]
    for r, s in zip(near, signals, strict=True):
        f = [v["dff"] for v in out["traces"].filter(F.col("roi") == r["roi"]).orderBy("frame").collect()]
        assert np.corrcoef(f, s)[0, 1] > 0.8


def test_crops_and_sweeps_of_bins(spark):
    rng = np.random.default_rng(24)
    a = rng.normal(size=(24, 9, 10)) + np.repeat(rng.normal(size=(24, 1, 1)), 9, axis=1)
    p = pixels_of(spark, a)
    got = I.centre_crop(p, 4).orderBy("frame", "y", "x").collect()
    assert np.allclose([r["v"] for r in got], a[:, 2:6, 3:7].ravel()) and I.centre_crop(p, 20).count() == a.size
    swept = {r["bin"]: r["median"] for r in I.bin_sweep(p, (1, 4), 6).collect()}
    one = [r["r"] for r in I.correlation_map(I.to_frames(I.centre_crop(p, 6))).collect()]
    assert abs(swept[1] - np.median(one)) < 1e-9 and set(swept) == {1, 4}
    assert I.denoised_or_not(p, 1, 8).first()["keep"] in (True, False)
    with pytest.raises(ValueError, match="stage"):
        I.prepared(I.to_frames(p), "never", 2)


def test_loading_in_tiers(spark):
    runs = spark.createDataFrame([("a",), ("b",)], "run string")
    part = runs.filter("run = 'a'")
    assert {r["run"]: r["missing"] for r in discovery.tiers(runs, {"traces": runs}, {"meta": part, "rois": runs}).collect()} == {"a": [], "b": ["meta"]}
    with pytest.raises(Exception, match="traces is missing for b"):
        discovery.tiers(runs, {"traces": part}, {}).collect()
    image = spark.createDataFrame([("a", 1, 0, 0), ("a", 1, 0, 2), ("a", 2, 4, 4)], "run string, roi int, y int, x int")
    rows = spark.createDataFrame([("a", 0, [1.0, 2.0, 3.0]), ("a", 1, [4.0, 5.0, 6.0])], "run string, row int, values array<double>")
    got = discovery.neural_traces(rows, image).orderBy("roi", "frame").collect()
    assert [(r["roi"], r["frame"], r["f"], r["cx"]) for r in got][:4] == [(1, 0, 1.0, 1.0), (1, 1, 2.0, 1.0), (1, 2, 3.0, 1.0), (2, 0, 4.0, 4.0)]
    side = spark.createDataFrame([("a", i, [1.0, 2.0]) for i in range(3)], "run string, row int, values array<double>")
    with pytest.raises(Exception, match="transposed"):
        discovery.neural_traces(side, image).collect()
    parts = spark.createDataFrame([("a", 0, 10), ("a", 1, 5), ("b", 0, 7), ("b", 1, 3)], "run string, part int, n int")
    want = spark.createDataFrame([("a", 10), ("b", 10)], "run string, expected int")
    assert sorted((r["run"], r["part"]) for r in discovery.parts_to_read(parts, want).collect()) == [("a", 0), ("b", 0), ("b", 1)]
    files = discovery.split_path(spark.createDataFrame([("/r/a/x.tif", 5), ("/r/a/y.tif", 0)], "path string, length long"))
    more = discovery.split_path(spark.createDataFrame([("/r/a/x.tif", 5), ("/r/b/z.tif", 9)], "path string, length long"))
    assert sorted(map(tuple, discovery.runs_of_roots(files, more).collect())) == [("/r/a", 1, 5, 0), ("/r/b", 1, 9, 1)] and discovery.any_runs(files).first()["n"] == 2


def test_low_rank(spark):
    rng = np.random.default_rng(7)
    a = (rng.normal(size=(12, 2)) @ rng.normal(size=(2, 20))).reshape(12, 4, 5)
    got = I.low_rank(pixels_of(spark, a), 2).orderBy("frame", "y", "x").collect()
    assert np.allclose([r["v"] for r in got], a.ravel())


def test_low_rank_of_whole_movies(spark, tmp_path):
    rng = np.random.default_rng(8)
    tall, wide = rng.normal(size=(40, 2, 3)), rng.normal(size=(5, 3, 4))
    both = pixels_of(spark, tall).unionByName(pixels_of(spark, wide).withColumn("run", F.lit("w")))
    got = I.low_rank(both, 2)
    for run, a in (("m", tall), ("w", wide)):
        u, s, v = np.linalg.svd(a.reshape(len(a), -1), full_matrices=False)
        want = (u[:, :2] * s[:2]) @ v[:2]
        assert np.allclose([r["v"] for r in got.filter(F.col("run") == run).orderBy("frame", "y", "x").collect()], want.ravel())
    a = rng.normal(size=(230, 64))
    spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(a)], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = queries.queries()["low_rank_movie"](spark, str(tmp_path)).orderBy("frame", "y", "x").collect()
    u, s, v = np.linalg.svd(a.astype(np.float32).astype(float), full_matrices=False)
    assert len(rows) == 230 * 64 and np.allclose([r["v"] for r in rows], ((u[:, :5] * s[:5]) @ v[:5]).ravel(), atol=1e-5)


def test_low_rank_by_sketches(spark):
    rng = np.random.default_rng(18)
    u, _, vt = np.linalg.svd(rng.normal(size=(60, 63)), full_matrices=False)
    a = ((u * 0.8 ** np.arange(60)) @ vt).reshape(60, 7, 9)
    want = ((u[:, :4] * 0.8 ** np.arange(4)) @ vt[:4]).ravel()
    for side, width in ((16, 20), (25, None)):
        got = I.low_rank(pixels_of(spark, a), 4, side, width).orderBy("frame", "y", "x").collect()
        assert np.abs(np.array([r["v"] for r in got]) - want).max() < 1e-8
    flat = pixels_of(spark, np.ones((3, 2, 2))).unionByName(pixels_of(spark, np.zeros((3, 2, 2))).withColumn("run", F.lit("z")))
    assert {(r["run"], round(r["v"], 9) + 0.0) for r in I.low_rank(flat, 2).collect()} == {("m", 1.0), ("z", 0.0)} and I.low_rank(flat.limit(0), 2).count() == 0


XML = """<?xml version="1.0"?><PVScan date="1/2/2024"><PVStateShard><PVStateValue key="framePeriod" value="0.5"/><PVStateValue key="micronsPerPixel"><IndexedValue index="XAxis" value="1.25"/></PVStateValue></PVStateShard>
<Sequence type="TSeries"><Frame relativeTime="3.0"/><Frame relativeTime="3.5"/><Frame relativeTime="4.0"/></Sequence></PVScan>"""


def test_metadata(spark, tmp_path):
    (tmp_path / "TSeries-1.xml").write_text(XML)
    docs = metadata.documents(spark, str(tmp_path))
    head = metadata.series_header(docs).first()
    assert head["n_frames"] == 3 and head["fps"] == 2.0 and head["duration_s"] == 1.5 and head["date"] == "1/2/2024"
    rig = metadata.rig(docs).first()
    assert (rig["fps"], rig["um_per_px"], rig["n_frames"]) == (2.0, 1.25, 3)
    values = metadata.state_values(docs).first()
    assert values["values"]["framePeriod"] == "0.5" and values["indexed"][0]["value"] == "1.25"


def test_repeated_documents_stay_apart(spark):
    docs = spark.createDataFrame([("a", XML), ("a", XML), ("b", None)], "path string, xml string")
    heads = metadata.series_header(docs).orderBy("path").collect()
    assert [(h["path"], h["n_frames"], h["fps"]) for h in heads] == [("a", 3, 2.0), ("a", 3, 2.0), ("b", None, None)]
    rigs = metadata.rig(docs, ["framePeriod", "laser"]).orderBy("path").collect()
    assert [(r["fps"], r["framePeriod"], r["laser"]) for r in rigs] == [(2.0, "0.5", None), (2.0, "0.5", None), (None, None, None)]


def test_discovery(spark):
    files = spark.createDataFrame([(p, n) for p, n in (("/d/a/TSeries-x.xml", 9), ("/d/a/in/TSeries-y.xml", 9), ("/d/a/TSeries-x-long.xml", 9), ("/d/b/f10.tif", 5), ("/d/b/f9.tif", 5), ("/d/b/._f1.tif", 5), ("/d/b/e.tif", 0), ("/d/b/proc/o.tif", 5))], "path string, length long")
    files = discovery.split_path(files)
    assert [(r["folder"], r["xml"]) for r in discovery.series(files).collect()] == [("/d/a", "TSeries-x.xml")]
    assert [(r["folder"], r["n"]) for r in discovery.runs(files).collect()] == [("/d/b", 2)]
    assert [r["name"] for r in discovery.in_order(discovery.images(files).filter("folder = '/d/b'")).orderBy("part").collect()] == ["f9.tif", "f10.tif"]
    with pytest.raises(IndexError):
        discovery.pick(discovery.manifest(discovery.runs(files)), 7)


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([("a", "x", 0, 1.0), ("a", "y", 0, 2.0)], "run string, channel string, frame long, v double")
    path = str(tmp_path / "t")
    sinks.save_runs(d, path)
    sinks.save_runs(d.withColumn("v", F.col("v") + 1), path)  # the run is there: nothing is written
    back = sinks.read_runs(spark, path, defaults={"trim": "0"})
    assert back.count() == 2 and back.agg(F.sum("v")).first()[0] == 3.0 and back.first()["trim"] == 0
    assert sinks.wide(d, ["x", "y"]).first().asDict() == {"run": "a", "frame": 0, "x": 1.0, "y": 2.0}
    d.write.parquet(str(tmp_path / "u"))
    assert sinks.verified(d, str(tmp_path / "u"))


def test_box_problems(spark):
    boxes = spark.createDataFrame([("m", "paw", 0, 0, 4, 4), ("m", "paw", 0, 0, 2, 2), ("m", "tail", 3, 2, 8, 7), ("m", "wheel", 3, 2, 8, 7)], "run string, box string, x0 int, y0 int, x1 int, y1 int")
    found = {(r["level"], r["problem"], r["box"]) for r in C.box_problems(boxes, ("paw", "wheel", "nose")).collect()}
    assert found == {("error", "duplicate", "paw"), ("warning", "unknown", "tail"), ("warning", "missing", "nose"), ("warning", "same rectangle", "tail,wheel")}


def test_sets_of_tables_appear_together(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "set")
    kind = "run string, frame long, v double"
    traces = lambda *runs, add=0.0: spark.createDataFrame([(r, i, i + add) for r in runs for i in range(3)], kind)
    rois = lambda *runs: spark.createDataFrame([(r, 1) for r in runs], "run string, roi int")
    with pytest.raises(FileNotFoundError):
        sets.read(spark, path, "traces")
    assert sets.save({"traces": traces("a", "b", None), "rois": rois("a", "b")}, path) == 1
    assert sets.read(spark, path, "traces").count() == 9 and sets.audit(spark, path).count() == 0
    # run a comes again without regions: those of before go with it
    assert sets.save({"traces": traces("a", "a", add=10.0)}, path) == 2
    assert sorted(r["run"] for r in sets.read(spark, path, "rois").collect()) == ["b"]
    got = {(r["run"], r["n"]) for r in sets.read(spark, path, "traces").groupBy("run").agg(F.count("*").alias("n")).collect()}
    assert got == {("a", 6), ("b", 3), (None, 3)} and sets.read(spark, path, "traces", 1).filter("run = 'a'").agg(F.max("v")).first()[0] == 2.0
    assert sets.read(spark, path, "traces", runs=("b",)).count() == 3
    # a write that is killed between its tables, or before its manifest, changes nothing
    broken = spark.range(5).select(F.lit("b").alias("run"), F.expr("if(id = 3, raise_error('killed'), 1)").cast("int").alias("roi"))
    with pytest.raises(Exception, match="killed"):
        sets.save({"traces": traces("b", add=99.0), "rois": broken}, path)
    assert sets.versions(spark, path) == [1, 2] and sets.read(spark, path, "traces").agg(F.max("v")).first()[0] == 12.0
    # two writers at once: the number goes to one of them
    with monkeypatch.context() as m:
        m.setattr(sets, "versions", lambda *_: [1])
        with pytest.raises(Exception, match="00000002.json"):
            sets.save({"traces": traces("b", add=99.0)}, path)
    assert sets.save({"traces": traces("c"), "rois": rois()}, path, runs=spark.createDataFrame([("b",)], "run string")) == 3
    assert {r["run"] for r in sets.read(spark, path, "traces").collect()} == {"a", "c", None} and sets.read(spark, path, "rois").count() == 0
    assert sets.expire(spark, path, 1) > 0 and sets.versions(spark, path) == [3] and sets.read(spark, path, "traces").count() == 12
    odd = "a b/c%20+é=1"
    sets.save({"traces": traces(odd)}, path)
    assert sets.read(spark, path, "traces", runs=(odd,)).count() == 3 and sets.audit(spark, path).count() == 0
    at = sets.manifest(spark, path)["tables"]["traces"]["files"][0]["path"]
    (tmp_path / "set" / at).unlink()
    assert [(r["table"], r["problem"]) for r in sets.audit(spark, path).collect()] == [("traces", "missing")]


def test_verify_and_salvage(spark, tmp_path):
    movie = np.random.default_rng(41).integers(0, 60_000, (9, 6, 5)).astype(np.uint16)
    for run, damage in (("good", 0), ("short", 21), ("gone", None)):
        (tmp_path / run).mkdir()
        write_tiff(tmp_path / run / "a.tif", movie[:5])
        write_tiff(tmp_path / run / "b.tif", movie[5:])
        if damage is None:
            (tmp_path / run / "a.tif").write_bytes(b"nothing at all, nothing")
        elif damage:
            (tmp_path / run / "b.tif").write_bytes((tmp_path / run / "b.tif").read_bytes()[:-damage])
    files = discovery.split_path(spark.createDataFrame([(str(p), p.stat().st_size) for p in tmp_path.glob("*/*.tif")], "path string, length long"))
    done = flows.verify(files)
    got = {r["run"].rsplit("/", 1)[1]: (r["status"], r["reason"]) for r in done["outcomes"].collect()}
    assert got == {"good": ("ok", None), "short": ("failed", f"b.tif: {tiff.CUT_OFF}"), "gone": ("failed", "a.tif: ValueError: not a TIFF file")}
    assert {(r["path"].rsplit("/", 2)[1], r["path"][-5:], r["frames"]) for r in done["files"].collect()} == {("good", "a.tif", 5), ("good", "b.tif", 4), ("short", "a.tif", 5), ("short", "b.tif", 3), ("gone", "a.tif", 0), ("gone", "b.tif", 4)}
    assert flows.exit_code(done["outcomes"]) == 2 and flows.exit_code(done["outcomes"].filter("status = 'ok'")) == 0
    frames = tiff.pixels_of(tiff.index(files.filter("folder not like '%gone'")))
    expected = files.select(F.col("folder").alias("run")).distinct().withColumn("expected", F.lit(9))
    template = spark.createDataFrame([(n, 0, 0, 3, 3 + i) for i, n in enumerate(C.BOXES)], "box string, x0 int, y0 int, x1 int, y1 int")
    own = template.limit(0).withColumn("run", F.lit("x"))
    out = flows.behaviour(frames, own, expected, strict=False, template=template)
    got = {r["run"].rsplit("/", 1)[1]: (r["status"], r["reason"]) for r in out["outcomes"].collect()}
    assert got == {"good": ("ok", None), "short": ("truncated", f"frame 8: {tiff.CUT_OFF}"), "gone": ("failed", "no frames")}
    counts = {r["run"].rsplit("/", 1)[1]: r["n"] for r in out["traces"].filter("box = 'paw'").groupBy("run").agg(F.count("*").alias("n")).collect()}
    assert counts == {"good": 9, "short": 8} and flows.exit_code(out["outcomes"]) == 2
