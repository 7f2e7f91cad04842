"""Movies in TIFF files: ``spark.read.format("tiff_movie").load(folder)``, its stream, and an index of pages.

Reads grey and RGB images of 8 to 64 bits, classic and big files, in strips or tiles,
plain or compressed (``codecs``), many pages or one header before contiguous frames
(``images=`` in the description). Files of a folder are parts in natural order, opened
with Arrow's file systems (local, HDFS and object stores).

The plan of a read is blocks of pages, each with the place of its first header: the
driver walks the chain of headers and keeps none, and tasks read the headers of their own
block. Filters on ``frame``, ``page``, ``part`` and ``run`` leave out blocks and pages
before anything of them is read. A page that can't be read gives a row with ``error``;
``checks.contiguous_prefix`` keeps what comes before.

``index`` is the other way in, for many recordings: tasks walk the chains, one file each,
and the index is a table, which any filter or join may cut down before ``pixels_of`` reads.

As a stream, ``spark.readStream.format("tiff_movie")``, a recording may grow: an offset
is the number of whole pages of each file, so a restart takes each page once. Only the
last file may grow, as frame numbers go on from file to file.

Options: ``path`` (a folder or file), ``run``, ``block_mb``, ``trim`` (last frames of the
movie that aren't read; not in a stream).
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from tracelake.functions import expressions as X
from tracelake.sources import codecs

SCHEMA = "run string, part int, page int, frame long, h int, w int, pixels array<double>, tags map<string,string>, error string"
INDEX = "run string, path string, page int, h int, w int, at long, skip long, tags map<string,string>, error string"
# Fixed values of the format: bytes and struct codes of its types.
_TYPES = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 5: (8, "II"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q"), 17: (8, "q")}
_FORMATS = {1: "u", 2: "i", 3: "f"}
CUT_OFF = "the frame is cut off"


def opened(path: str):
    """A file for random access, by its address or path."""
    system, inner = located(path)
    return system.open_input_file(inner)


def located(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


@dataclass
class Page:
    """A header: the image's shape and where its bytes are."""

    width: int = 0
    height: int = 0
    dtype: str = ""
    samples: int = 1
    compression: int = 1
    predictor: int = 1
    planar: bool = False
    tile: tuple[int, int] = (0, 0)  # height and width of a block
    blocks: list[tuple[int, int]] = field(default_factory=list)
    tags: dict[str, object] = field(default_factory=dict)

    @property
    def nbytes(self) -> int:
        return self.width * self.height * self.samples * np.dtype(self.dtype).itemsize

    def within(self, size: int) -> bool:
        """Whether a file of so many bytes has all of the image."""
        there = all(a + n <= size for a, n in self.blocks)
        return there and (self.compression != codecs.PLAIN or sum(n for _, n in self.blocks) >= self.nbytes)


class Chain:
    """A file's headers, each of which says where the next one is."""

    def __init__(self, f):
        self.f = f
        f.seek(0)
        head = f.read(16)
        order = {b"II": "<", b"MM": ">"}.get(head[:2])
        if order is None:
            raise ValueError("not a TIFF file")
        self.order, self.big = order, struct.unpack(order + "H", head[2:4])[0] == 43
        self.first = struct.unpack(order + "Q", head[8:16])[0] if self.big else struct.unpack(order + "I", head[4:8])[0]
        self.count, self.width, self.word = ("Q", 20, "Q") if self.big else ("H", 12, "I")

    def _entries(self, at: int) -> tuple[int, int]:
        self.f.seek(at)
        return struct.unpack(self.order + self.count, self.f.read(struct.calcsize(self.count)))[0], at + struct.calcsize(self.count)

    def after(self, at: int) -> int:
        """The next header's place, 0 after the last; nothing else of the header is read."""
        n, body = self._entries(at)
        self.f.seek(body + n * self.width)
        return struct.unpack(self.order + self.word, self.f.read(struct.calcsize(self.word)))[0]

    def page(self, at: int) -> Page:
        n, body = self._entries(at)
        self.f.seek(body)
        block = self.f.read(n * self.width)
        page, raw, room = Page(), {}, struct.calcsize(self.word)
        for i in range(n):
            tag, kind = struct.unpack_from(self.order + "HH", block, i * self.width)
            size = struct.unpack_from(self.order + self.word, block, i * self.width + 4)[0]
            if kind not in _TYPES:
                continue
            unit, code = _TYPES[kind]
            inline = i * self.width + 4 + room
            if unit * size <= room:
                data = block[inline : inline + unit * size]
            else:
                self.f.seek(struct.unpack_from(self.order + self.word, block, inline)[0])
                data = self.f.read(unit * size)
            raw[tag] = data.rstrip(b"\0").decode("latin-1") if kind == 2 else list(struct.unpack(f"{self.order}{size * len(code)}{code[0]}", data))
        page.width, page.height = raw[256][0], raw[257][0]
        page.samples, page.compression = raw.get(277, [1])[0], raw.get(259, [1])[0]
        page.predictor, page.planar = raw.get(317, [1])[0], raw.get(284, [1])[0] == 2
        page.dtype = f"{self.order}{_FORMATS.get(raw.get(339, [1])[0], 'u')}{raw.get(258, [8])[0] // 8}"
        if 324 in raw:
            page.tile = raw[323][0], raw[322][0]
            page.blocks = list(zip(raw[324], raw[325], strict=True))
        else:
            page.tile = min(raw.get(278, [page.height])[0], page.height), page.width
            page.blocks = list(zip(raw[273], raw.get(279) or [page.nbytes], strict=True))
        page.tags = {str(t): v if isinstance(v, str) else v[0] if len(v) == 1 else v for t, v in raw.items()}
        return page


def image(f, page: Page) -> np.ndarray:
    """The page's grey image: the mean of the first three samples, or the only one."""
    if page.compression not in codecs.KNOWN:
        raise ValueError(f"compression {page.compression} isn't read")
    planes = page.samples if page.planar else 1
    samples = 1 if page.planar else page.samples
    th, tw = page.tile
    down, across = -(-page.height // th), -(-page.width // tw)
    tiled = "324" in page.tags
    out = np.zeros((planes, page.height, page.width, samples))
    for i, (at, n) in enumerate(page.blocks[: planes * down * across]):
        plane, place = divmod(i, down * across)
        y, x = place // across * th, place % across * tw
        rows = th if tiled else min(th, page.height - y)
        f.seek(at)
        raw = codecs.decoded(f.read(n), page.compression)
        a = np.frombuffer(raw, page.dtype, rows * tw * samples).reshape(rows, tw, samples)
        a = codecs.undone(a, page.predictor)[: page.height - y, : page.width - x]
        out[plane, y : y + len(a), x : x + a.shape[1]] = a
    whole = np.moveaxis(out[..., 0], 0, -1) if page.planar else out[0]
    return whole[:, :, :3].mean(axis=2) if whole.shape[2] >= 3 else whole[:, :, 0]


@dataclass
class Part:
    """What a walk of a file's chain finds: pages, the headers at which blocks of pages begin, and why it ends early."""

    pages: int
    step: int
    starts: list[int]
    skip: int = 0  # bytes from frame to frame where one header stands before all
    error: str | None = None


def contiguous(page: Page) -> int:
    """Frames behind a single header, 1 if it says nothing of more."""
    said = re.search(r"images=(\d+)", str(page.tags.get("270", "")))
    return int(said[1]) if said and page.compression == codecs.PLAIN else 1


def walk(f, size: int, block: int) -> Part:
    """Counts a file's pages; keeps a place for each block of about ``block`` bytes of images."""
    starts: list[int] = []
    count, step = 0, 1
    try:
        chain = Chain(f)
        at, last = chain.first, 0
        while at:
            if count == 0:
                first = chain.page(at)
                step = max(1, block // max(1, first.nbytes))
            elif at == last:
                break
            after = chain.after(at)
            if count % step == 0:
                starts.append(at)
            count, last, at = count + 1, at, after
    except Exception as e:  # a damaged chain ends the file
        return Part(count, step, starts, 0, f"{type(e).__name__}: {e}")
    if count == 1 and (said := contiguous(first)) > 1:
        there = min(said, max(0, size - first.blocks[0][0]) // first.nbytes)
        return Part(there, step, starts * -(-there // step), first.nbytes, None if there == said else f"only {there} of {said} frames are there")
    return Part(count, step, starts)


def pages_from(f, size: int, at: int, first: int, count: int, skip: int) -> Iterator[tuple[int, Page | None, str | None]]:
    """(page number, header, what is wrong) of ``count`` pages, the first of them with its header at ``at``."""
    chain = Chain(f)
    for number in range(first, first + count):
        try:
            page = chain.page(at)
            if skip:
                page.blocks = [(page.blocks[0][0] + number * skip, skip)]
                page.tile = page.height, page.width
            elif number + 1 < first + count:
                at = chain.after(at)
        except Exception as e:
            yield number, None, f"{type(e).__name__}: {e}"
            return
        yield number, page, None if page.within(size) else CUT_OFF


def natural(name: str) -> list:
    return [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.split(r"(\d+)", name.lower()) if x]


@dataclass
class Block(InputPartition):
    """Pages of one file, from the header at ``at``."""

    path: str
    part: int
    first: int
    frame: int
    count: int
    at: int
    skip: int
    error: str | None = None
    unread: int = 0  # the first page that a stream has not read yet


class _Files:
    def __init__(self, options: dict):
        self.path = options["path"]
        system, inner = located(self.path)
        self.run = options.get("run", os.path.basename(inner.rstrip("/")))
        self.block = int(float(options.get("block_mb", 16)) * 1e6)
        self.system, self.inner = system, inner

    def paths(self) -> list[tuple[str, int]]:
        """(path, bytes) of the parts, in order."""
        info = self.system.get_file_info(self.inner)
        if info.type == fs.FileType.File:
            return [(self.inner, info.size)]
        found = self.system.get_file_info(fs.FileSelector(self.inner))
        good = [x for x in found if x.type == fs.FileType.File and x.base_name.lower().endswith((".tif", ".tiff")) and not x.base_name.startswith(".") and x.size]
        return [(x.path, x.size) for x in sorted(good, key=lambda x: natural(x.base_name))]

    def rows(self, block: Block, wanted=lambda frame, page: True) -> Iterator[tuple]:
        head = (self.run, block.part)
        if block.error:
            yield *head, block.first, block.frame, None, None, None, None, block.error
            return
        with self.system.open_input_file(block.path) as f:
            size = f.size()
            for number, page, wrong in pages_from(f, size, block.at, block.first, block.count, block.skip):
                frame = block.frame + number - block.first
                if not wanted(frame, number):
                    continue
                if wrong is None:
                    try:
                        pixels = image(f, page).ravel().tolist()
                        yield *head, number, frame, page.height, page.width, pixels, {k: str(v) for k, v in page.tags.items()}, None
                        continue
                    except Exception as e:
                        wrong = f"{type(e).__name__}: {e}"
                yield *head, number, frame, None, None, None, None, wrong


class MovieReader(_Files, DataSourceReader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.trim = int(options.get("trim", 0))
        self.filters: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Notes the ranges of the numbering columns; Spark still applies every filter to the rows."""
        kinds = {EqualTo: "=", In: "in", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            if type(f) in kinds and len(f.attribute) == 1 and f.attribute[0] in ("frame", "page", "part", "run"):
                self.filters.append((f.attribute[0], kinds[type(f)], f.value))
            yield f

    def _may(self, name: str, low, high) -> bool:
        """Whether a value of ``name`` from ``low`` to ``high`` can pass."""
        for of, kind, value in self.filters:
            if of != name:
                continue
            values = list(value) if kind == "in" else [value]
            good = {"=": low <= values[0] <= high, ">": high > values[0], ">=": high >= values[0], "<": low < values[0], "<=": low <= values[0]} if kind != "in" else {"in": any(low <= v <= high for v in values)}
            if not good[kind]:
                return False
        return True

    def partitions(self) -> list[Block]:
        if not self._may("run", self.run, self.run):
            return []
        parts = []
        for path, size in self.paths():
            with self.system.open_input_file(path) as f:
                parts.append((path, walk(f, size, self.block)))
        total = sum(p.pages for _, p in parts)
        last = total - self.trim if total - self.trim >= 1 else total
        out, frame = [], 0
        for number, (path, part) in enumerate(parts):
            own = min(part.pages, max(0, last - frame))
            for k, at in enumerate(range(0, own, part.step)):
                n = min(part.step, own - at)
                if self._may("part", number, number) and self._may("page", at, at + n - 1) and self._may("frame", frame + at, frame + at + n - 1):
                    out.append(Block(path, number, at, frame + at, n, part.starts[k], part.skip))
            if part.error and own == part.pages:
                out.append(Block(path, number, part.pages, frame + part.pages, 0, 0, 0, part.error))
            frame += part.pages + bool(part.error)
        return out

    def read(self, partition: Block) -> Iterator[tuple]:
        return self.rows(partition, lambda frame, page: self._may("frame", frame, frame) and self._may("page", page, page))


class MovieStream(_Files, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"files": []}

    def latestOffset(self) -> dict:
        """Whole pages of each file now: the frozen list that a batch reads up to."""
        found = []
        for path, size in self.paths():
            with self.system.open_input_file(path) as f:
                part = walk(f, size, self.block)
                whole = part.pages
                if not part.skip and whole:
                    # the last page may still be on its way
                    *_, (_, page, wrong) = pages_from(f, size, part.starts[-1], (len(part.starts) - 1) * part.step, whole - (len(part.starts) - 1) * part.step, 0)
                    whole -= wrong is not None
            found.append([os.path.basename(path), whole])
        return {"files": found}

    def partitions(self, start: dict, end: dict) -> list[Block]:
        before = {name: n for name, n in start["files"]}
        paths = {os.path.basename(p): (p, size) for p, size in self.paths()}
        out, frame = [], 0
        for number, (name, pages) in enumerate(end["files"]):
            done = before.get(name, 0)
            if done and number < len(start["files"]) - 1 and pages != done:
                raise ValueError(f"{name} has grown after a later file began")
            if pages > done:
                path, size = paths[name]
                with self.system.open_input_file(path) as f:
                    part = walk(f, size, self.block)
                    for k, at in enumerate(range(0, pages, part.step)):
                        stop = min(at + part.step, pages)
                        if stop > done:
                            # a block that was begun goes on from its own first header, without the pages that were read
                            out.append(Block(path, number, at, frame + at, stop - at, part.starts[k], part.skip, None, done))
            frame += pages
        return out

    def read(self, partition: Block) -> Iterator[tuple]:
        return self.rows(partition, lambda frame, page: page >= partition.unread)

    def commit(self, end: dict) -> None:
        pass


class TiffMovie(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tiff_movie"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> MovieReader:
        return MovieReader(self.options)

    def streamReader(self, schema) -> MovieStream:
        return MovieStream(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets Spark hand filters to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TiffMovie)


def count_frames(path: str) -> int:
    """Pages, from the chain of headers only."""
    files = _Files({"path": path})
    total = 0
    for p, size in files.paths():
        with files.system.open_input_file(p) as f:
            total += walk(f, size, files.block).pages
    return total


def encode(images: np.ndarray) -> bytes:
    """A big file of 64-bit grey images (frame, h, w), a strip and a header for each."""
    n, h, w = images.shape
    size, entries = h * w * 8, 9
    head = 8 + entries * 20 + 8
    out = [struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16)]
    for k in range(n):
        at = 16 + k * (head + size)
        fields = [(256, 4, w), (257, 4, h), (258, 3, 64), (259, 3, codecs.PLAIN), (262, 3, 1), (273, 16, at + head), (277, 3, 1), (279, 16, size), (339, 3, 3)]
        out += [struct.pack("<Q", entries), *[struct.pack("<HHQQ", tag, kind, 1, value) for tag, kind, value in fields]]
        out += [struct.pack("<Q", at + head + size if k + 1 < n else 0), np.ascontiguousarray(images[k], "<f8").tobytes()]
    return b"".join(out)


def write(frames: DataFrame, folder: str, block_frames: int = 256) -> DataFrame:
    """Writes (run, frame, h, w, pixels) as parts of ``block_frames`` frames below folder/run; returns (run, path, frames, bytes) of them.

    A part's name and bytes follow from its frames, so a task that runs again writes the
    same file; a part appears under its name when it is whole. A null pixel is 0.
    """

    def parts(frames_: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list = []
        key = None

        def done() -> pd.DataFrame:
            run, block = key
            data = encode(np.array([[0.0 if v is None else v for v in r.pixels] for r in rows], "<f8").reshape(len(rows), rows[0].h, rows[0].w))
            system, inner = located(f"{folder}/{run}")
            system.create_dir(inner, recursive=True)
            name = f"{inner}/part{block:06d}.tif"
            draft = f"{inner}/.{block:06d}-{TaskContext.get().taskAttemptId()}"
            with system.open_output_stream(draft) as out:
                out.write(data)
            system.move(draft, name)
            return pd.DataFrame({"run": [run], "path": [name], "frames": [len(rows)], "bytes": [len(data)]})

        for part in frames_:
            for r in part.itertuples():
                if key != (r.run, r.block):
                    if rows:
                        yield done()
                    key, rows = (r.run, r.block), []
                rows.append(r)
        if rows:
            yield done()

    dealt = frames.select(F.col("run").cast("string").alias("run"), F.expr(f"cast(frame div {block_frames} as bigint)").alias("block"), "frame", "h", "w", "pixels")
    dealt = dealt.repartition("run", "block").sortWithinPartitions("run", "block", "frame")
    return dealt.mapInPandas(parts, "run string, path string, frames long, bytes long")


# an index of pages, as a table


def index(files: DataFrame) -> DataFrame:
    """(run, part, path, page, frame, h, w, at, skip, tags, error): every page of listed image files (path, folder, name), read by tasks.

    A folder is a run, its files are parts in natural order. ``at`` is the place of the
    page's header. No pixels are read.
    """

    def headers(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["run", "path", "page", "h", "w", "at", "skip", "tags", "error"]
        for part in parts:
            for run, path in zip(part["run"], part["path"], strict=True):
                rows = []
                with opened(path) as f:
                    size = f.size()
                    found = walk(f, size, 0)
                    for k in range(found.pages):
                        at = found.starts[k]
                        for number, page, wrong in pages_from(f, size, at, k, 1, found.skip):
                            tags = None if page is None else {t: str(v) for t, v in page.tags.items()}
                            rows.append((run, path, number, None if page is None else page.height, None if page is None else page.width, at, found.skip, tags, wrong))
                        if len(rows) >= 10_000:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
                    if found.error:
                        rows.append((run, path, found.pages, None, None, 0, 0, None, found.error))
                yield pd.DataFrame(rows, columns=columns)

    listed = files.select(F.col("folder").alias("run"), "path").repartition("path")
    pages = listed.mapInPandas(headers, INDEX)
    order = Window.partitionBy("run").orderBy(X.natural_key(F.regexp_extract("path", r"([^/]*)$", 1)), "path")
    counts = pages.groupBy("run", "path").agg(F.count("*").alias("n"))  # a row a file
    counts = counts.withColumns({"part": F.row_number().over(order) - 1, "first": F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    numbered = pages.join(counts, ["run", "path"])
    return numbered.select("run", "part", "path", "page", (F.col("first") + F.col("page")).alias("frame"), "h", "w", "at", "skip", "tags", "error")


def pixels_of(pages: DataFrame) -> DataFrame:
    """The frames of an index's rows, whichever are left of it; as the data source gives them."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), 16):
                rows = []
                for path, some in part.iloc[at : at + 16].groupby("path", sort=False):
                    with opened(path) as f:
                        size = f.size()
                        for r in some.itertuples():
                            pixels, wrong = None, r.error
                            if wrong is None:
                                try:
                                    for _, page, wrong in pages_from(f, size, r.at, r.page, 1, r.skip):
                                        pixels = None if wrong else image(f, page).ravel().tolist()
                                except Exception as e:
                                    wrong = f"{type(e).__name__}: {e}"
                            rows.append((r.run, r.part, r.page, r.frame, r.h, r.w, pixels, r.tags, wrong))
                yield pd.DataFrame(rows, columns=["run", "part", "page", "frame", "h", "w", "pixels", "tags", "error"])

    return pages.select("run", "part", "path", "page", "frame", "h", "w", "at", "skip", "tags", "error").mapInPandas(read, SCHEMA)


def ome_planes(pages: DataFrame) -> DataFrame:
    """(run, part, channel, t, file, page) from the OME descriptions in an index: which page of which file each plane is.

    A block of the description names planes in the order of its dimensions; one without a
    file name is about the file that it stands in.
    """
    from xml.etree import ElementTree

    def planes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for r in part.itertuples():
                try:
                    root = ElementTree.fromstring(r.said)
                except ElementTree.ParseError:
                    continue
                found = next((x for x in root.iter() if x.tag.endswith("Pixels")), None)
                if found is None:
                    continue
                order = found.get("DimensionOrder", "XYCZT")[2:]
                sizes = {d: int(found.get(f"Size{d}", 1)) for d in "CZT"}
                for block in (x for x in found if x.tag.endswith("TiffData")):
                    uuid = next((x for x in block if x.tag.endswith("UUID")), None)
                    name = uuid.get("FileName") if uuid is not None else None
                    at = {d: int(block.get(f"First{d}", 0)) for d in "CZT"}
                    whole = block.get("IFD") is None and block.get("PlaneCount") is None
                    for k in range(sizes["C"] * sizes["Z"] * sizes["T"] if whole else int(block.get("PlaneCount", 1))):
                        rows.append((r.run, r.part, at["C"], at["T"], name or r.name, int(block.get("IFD", 0)) + k))
                        for d in order:  # the next plane, the first dimension fastest
                            at[d] += 1
                            if at[d] < sizes[d]:
                                break
                            at[d] = 0
            yield pd.DataFrame(rows, columns=["run", "part", "channel", "t", "file", "page"])

    first = pages.filter("page = 0 and tags is not null").select("run", "part", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.col("tags")["270"].alias("said"))
    return first.filter(F.col("said").contains("<")).mapInPandas(planes, "run string, part int, channel int, t long, file string, page int")


def series_pages(pages: DataFrame, expected: DataFrame) -> DataFrame:
    """The index's rows that make each run's movie, with their frame numbers; ``expected``: (run, expected).

    Where the first file's description tells of as many frames as the run should have, its
    order holds: a frame is a plane's time. Otherwise files follow each other, whatever they
    say. Descriptions of several channels, or files with frames of different shapes, raise.
    """
    planes = ome_planes(pages).filter("part = 0")
    told = planes.groupBy("run").agg(F.count_distinct("t").alias("_t"), F.count_distinct("channel").alias("_c"))
    shapes = pages.filter("h is not null").groupBy("run").agg(F.count_distinct("h", "w").alias("_s"))
    state = shapes.join(told, "run", "left").join(expected, "run", "left")
    wrong = F.when(F.col("_s") > 1, "frame shapes differ across files: ").when(F.col("_c") > 1, "several channels in ")
    state = state.withColumn("ome", F.when(wrong.isNotNull(), F.raise_error(F.concat(wrong, F.col("run"))).cast("boolean")).otherwise(F.coalesce(F.col("_t") == F.col("expected"), F.lit(False))))
    named = pages.withColumn("file", F.regexp_extract("path", r"([^/]*)$", 1)).join(state.select("run", "ome"), "run")
    by_ome = named.filter("ome").drop("frame").join(planes.select("run", "file", "page", F.col("t").alias("frame")), ["run", "file", "page"])
    return named.filter("not ome").select(pages.columns).unionByName(by_ome.select(pages.columns))
