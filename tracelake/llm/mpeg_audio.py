"""MPEG audio as a media column: frame index, tags, rate tables, checksums, seeking.

``parse`` reads any layer of MPEG-1, 2 and 2.5 streams: it skips ID3v2 and ID3v1
tags (and reads their texts), resynchronises on frame headers, reads Xing/Info and VBRI
tables, verifies the CRC-16 of protected frames of all layers, and keeps exact durations
(a count of samples over a rate) and the byte offset of every frame.

A header is four bytes that junk can hold too. After bytes that were skipped, one counts
only if a header of its stream, the end or a rate table confirms it. One that follows a
frame counts as well if its checksum holds or no confirmed header begins inside its frame.

``wrap`` stores bytes losslessly in a stream: 576 bytes, one unit of the format, to
each frame of 576 samples (MPEG-2 Layer III, mono, 16 kHz), behind a tag and a
variable-bitrate header frame. The last frames of a stream are coded at the lowest
rate that holds their data, so the rate table is needed for exact seeking.

Cases: null media parse as empty (no frame, duration zero); bytes without a valid
frame give zero frames; damage costs only the frames that it touches; columns other
than the named ones stay untouched; equal bytes give equal rows.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the format (ISO/IEC 11172-3 and 13818-3): kbit/s by index 1 to 14.
_RATES = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
_HERTZ = {"1": (44100, 48000, 32000), "2": (22050, 24000, 16000), "2.5": (11025, 12000, 8000)}

#: Bytes of payload, and samples, of a frame that ``wrap`` writes.
UNIT = 576


@dataclass(frozen=True)
class Header:
    version: str
    layer: int
    protected: bool
    kbps: int
    hertz: int
    channels: int
    samples: int
    length: int
    side: int

    @property
    def stream(self) -> tuple:
        """What stays the same through a stream."""
        return self.version, self.layer, self.hertz


@functools.lru_cache(maxsize=65536)
def header(word: bytes) -> Header | None:
    """The header in four bytes, or None if they can't be one."""
    if len(word) < 4 or word[0] != 0xFF or word[1] & 0xE0 != 0xE0:
        return None
    version = {0: "2.5", 2: "2", 3: "1"}.get(word[1] >> 3 & 3)
    layer = 4 - (word[1] >> 1 & 3)
    rate, hertz, padding = word[2] >> 4, word[2] >> 2 & 3, word[2] >> 1 & 1
    if version is None or layer == 4 or rate in (0, 15) or hertz == 3 or word[3] & 3 == 2:
        return None
    low = version != "1"
    kbps, hz = _RATES[2 if low else 1, layer][rate - 1], _HERTZ[version][hertz]
    channels = 1 if word[3] >> 6 == 3 else 2
    samples = 384 if layer == 1 else 576 if layer == 3 and low else 1152
    if layer == 1:
        length = (12_000 * kbps // hz + padding) * 4
    else:
        length = samples // 8 * 1000 * kbps // hz + padding
    side = 0 if layer != 3 else {(False, 1): 17, (False, 2): 32, (True, 1): 9, (True, 2): 17}[low, channels]
    return Header(version, layer, not word[1] & 1, kbps, hz, channels, samples, length, side)


def _crc_table() -> list[int]:
    table = []
    for byte in range(256):
        crc = byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ (0x8005 if crc & 0x8000 else 0)) & 0xFFFF
        table.append(crc)
    return table


_CRC = _crc_table()


@functools.lru_cache(maxsize=65536)
def crc16(data: bytes, bits: int | None = None) -> int:
    """CRC-16 of the first ``bits`` bits (all by default)."""
    crc, n = 0xFFFF, len(data) * 8 if bits is None else bits
    for byte in data[: n // 8]:
        crc = (crc << 8 & 0xFFFF) ^ _CRC[crc >> 8 ^ byte]
    for i in range(n % 8):
        bit = data[n // 8] >> (7 - i) & 1
        crc = (crc << 1 & 0xFFFF) ^ (0x8005 if (crc >> 15) ^ bit else 0)
    return crc


# Fixed values of the format: bits of a subband's allocation in Layer II, by table, as (bits, subbands).
_ALLOCATION = {"wide": ((4, 11), (3, 12), (2, 7)), "narrow": ((4, 2), (3, 10)), "low": ((4, 4), (3, 7), (2, 19))}


def _layer2_bits(h: Header) -> list[int]:
    if h.version != "1":
        table, bands = "low", 30
    elif h.kbps // h.channels < 56:
        table, bands = "narrow", 12 if h.hertz == 32000 else 8
    else:
        table, bands = "wide", 30 if h.kbps // h.channels >= 96 and h.hertz != 48000 else 27
    return [bits for bits, n in _ALLOCATION[table] for _ in range(n)][:bands]


def checked_bits(data: bytes, at: int, h: Header) -> int:
    """How many bits after the checksum it covers, besides half the header: side information, or allocation and selection."""
    if h.layer == 3:
        return 8 * h.side
    joint = data[at + 3] >> 6 == 1
    bound = 4 + 4 * (data[at + 3] >> 4 & 3) if joint else 32
    if h.layer == 1:
        bound = min(bound, 32)
        return 4 * (bound * h.channels + 32 - bound)
    sizes = _layer2_bits(h)
    value, p, selected = int.from_bytes(data[at + 6 : at + 6 + 80], "big"), 0, 0
    width = 8 * len(data[at + 6 : at + 6 + 80])
    for band, bits in enumerate(sizes):
        for _ in range(h.channels if band < bound else 1):
            if p + bits > width:
                return width
            used = value >> (width - p - bits) & ((1 << bits) - 1)
            selected += bool(used) * (1 if band < bound else h.channels)
            p += bits
    return min(p + 2 * selected, width)


def checksum_holds(data: bytes, at: int, h: Header) -> bool:
    """Whether a protected frame's CRC-16 is right."""
    n = checked_bits(data, at, h)
    return crc16(data[at + 2 : at + 4] + data[at + 6 : at + 6 + (n + 7) // 8], 16 + n) == data[at + 4] << 8 | data[at + 5]


def _syncsafe(b: bytes) -> int:
    return b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]


def id3v2(data: bytes) -> tuple[int, dict[str, str]]:
    """Bytes that the leading tag takes, and its text frames."""
    if len(data) < 10 or data[:3] != b"ID3" or data[3] == 0xFF or any(x & 0x80 for x in data[6:10]):
        return 0, {}
    size = 10 + _syncsafe(data[6:10]) + (10 if data[5] & 0x10 else 0)
    texts: dict[str, str] = {}
    at, end = 10, min(10 + _syncsafe(data[6:10]), len(data))
    if data[5] & 0x40 and at + 4 <= end:
        at += _syncsafe(data[at : at + 4]) if data[3] == 4 else struct.unpack(">I", data[at : at + 4])[0] + 4
    while data[3] >= 3 and at + 10 <= end and data[at] != 0:
        name = data[at : at + 4].decode("latin-1")
        n = _syncsafe(data[at + 4 : at + 8]) if data[3] == 4 else struct.unpack(">I", data[at + 4 : at + 8])[0]
        body = data[at + 10 : min(at + 10 + n, end)]
        if name[0] == "T" and body:
            codec = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1")
            texts[name] = body[1:].decode(codec, "replace").rstrip("\0")
        at += 10 + n
    return min(size, len(data)), texts


# Fixed places of ID3v1: name, begin and end in the tag's 128 bytes.
_ID3V1 = (("TIT2", 3, 33), ("TPE1", 33, 63), ("TALB", 63, 93), ("TYER", 93, 97), ("COMM", 97, 127))


def id3v1(tag: bytes) -> dict[str, str]:
    """The texts of the tag's fields that aren't empty, by the names that ID3v2 has for them."""
    fields = {name: tag[a:b].split(b"\0")[0].decode("latin-1").rstrip() for name, a, b in _ID3V1}
    return {k: v for k, v in fields.items() if v}


@dataclass
class Track:
    """What ``parse`` finds. ``offsets`` are those of audio frames, the rate table's own frame not counted."""

    tags: dict[str, str] = field(default_factory=dict)
    table: str = ""
    table_frames: int = 0
    table_bytes: int = 0
    toc: bytes = b""
    hertz: int = 0
    samples: int = 0
    offsets: list[int] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    headers: list[Header] = field(default_factory=list)
    skipped: int = 0
    crc_ok: int = 0
    crc_bad: int = 0

    @property
    def seconds(self) -> tuple[int, int]:
        """The duration as an exact fraction."""
        return self.samples, self.hertz or 1

    def seek(self, sample: int) -> int | None:
        """Offset of the frame that holds a sample."""
        if not 0 <= sample < self.samples:
            return None
        return self.offsets[sample // self.headers[0].samples]


def _table(data: bytes, at: int, h: Header, track: Track) -> bool:
    """Read a Xing/Info or VBRI table in the frame at ``at``, if there is one."""
    xing = at + 4 + (2 if h.protected else 0) + h.side
    name = data[xing : xing + 4]
    if name not in (b"Xing", b"Info"):
        xing = at + 4 + h.side  # some writers leave the checksum's room out
        name = data[xing : xing + 4]
    if name in (b"Xing", b"Info"):
        flags, p = struct.unpack_from(">I", data, xing + 4)[0], xing + 8
        if flags & 1:
            track.table_frames, p = struct.unpack_from(">I", data, p)[0], p + 4
        if flags & 2:
            track.table_bytes, p = struct.unpack_from(">I", data, p)[0], p + 4
        if flags & 4:
            track.toc = data[p : p + 100]
        track.table = name.decode()
        return True
    if data[at + 36 : at + 40] == b"VBRI" and at + 62 <= len(data):
        track.table_bytes, track.table_frames, entries, _scale, width, _per = struct.unpack_from(">IIHHHH", data, at + 46)
        track.toc = data[at + 62 : at + 62 + entries * width]
        track.table = "VBRI"
        return True
    return False


def parse(data: bytes | None) -> Track:
    """Index a stream's frames."""
    data = data or b""
    at, tags = id3v2(data)
    end = len(data)
    if len(data) >= 128 + at and data[-128:-125] == b"TAG":
        end -= 128
        tags = id3v1(data[end:]) | tags
    track = Track(tags=tags)
    stream, first, near = None, True, False

    def head(p: int) -> Header | None:
        h = header(data[p : p + 4])
        return h if h is not None and p + h.length <= end and (stream is None or h.stream == stream) else None

    def confirmed(p: int, h: Header) -> bool:
        nxt = header(data[p + h.length : p + h.length + 4])
        return p + h.length == end or nxt is not None and nxt.stream == h.stream

    def real(p: int, h: Header) -> bool:
        if confirmed(p, h) or h.layer == 3 and stream is None and _table(data, p, h, Track()):
            return True
        if not near:
            return False
        if h.protected and checksum_holds(data, p, h):
            return True
        q = data.find(b"\xff", p + 4, p + h.length)
        while q >= 0:
            inner = head(q)
            if inner is not None and confirmed(q, inner):
                return False
            q = data.find(b"\xff", q + 1, p + h.length)
        return True

    while at + 4 <= end:
        h = head(at)
        if h is None or not real(at, h):
            found = data.find(b"\xff", at + 1, end)
            step = (end if found < 0 else found) - at
            track.skipped += step
            at += step
            near = False
            continue
        stream, near = h.stream, True
        track.hertz = h.hertz
        if first and h.layer == 3 and _table(data, at, h, track):
            first = False
            at += h.length
            continue
        first = False
        if h.protected:
            good = checksum_holds(data, at, h)
            track.crc_ok += good
            track.crc_bad += not good
        track.offsets.append(at)
        track.lengths.append(h.length)
        track.headers.append(h)
        track.samples += h.samples
        at += h.length
    track.skipped += max(0, end - at)
    return track


_HEAD, _SIDE = 6, 9  # header and checksum; side information of a mono frame of MPEG-2


def _frame_head(index: int) -> bytes:
    """Header, checksum and empty side information at rate ``index``, 16 kHz, mono, protected."""
    head, side = bytes((0xFF, 0xF2, index << 4 | 0x08, 0xC4)), bytes(_SIDE)
    return head + struct.pack(">H", crc16(head[2:] + side)) + side


_FULL = _frame_head(13)  # 144 kbit/s: 648 bytes
_TABLE = _frame_head(10)  # 96 kbit/s: 432 bytes
_TITLE = b"payload"


def wrap(payload: bytes) -> bytes:
    """A stream whose frames carry ``payload``, whose length is a multiple of ``UNIT``.

    A frame's main data are its 576 bytes and their CRC-32. Where the 576 bytes are
    one byte repeated, the frame is written at 8 kbit/s and holds that byte once.
    """
    if len(payload) % UNIT:
        raise ValueError(f"the payload must be a multiple of {UNIT} bytes")
    units = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    n = len(units)
    lengths = np.full(n, header(_FULL[:4]).length)
    flat = (units == units[:, :1]).all(axis=1)
    small = _frame_head(1)  # 8 kbit/s: 36 bytes
    lengths[flat] = header(small[:4]).length
    frames = []
    for i in range(n):
        body = units[i].tobytes()
        head, data = (small, body[:1]) if flat[i] else (_FULL, body)
        frames.append((head + data + struct.pack(">I", zlib.crc32(body))).ljust(int(lengths[i]), b"\0"))
    total = int(lengths.sum()) + header(_TABLE[:4]).length
    starts = np.concatenate([[0], np.cumsum(lengths)])
    toc = bytes(min(255, int(starts[i * n // 100]) * 256 // max(1, int(starts[-1]))) for i in range(100))
    table = (_TABLE + b"Xing" + struct.pack(">III", 7, n, total) + toc).ljust(header(_TABLE[:4]).length, b"\0")
    frame = b"TIT2" + bytes((0, 0, 0, len(_TITLE) + 1)) + b"\0\0\x03" + _TITLE
    tag = b"ID3\x04\0\0" + bytes((0, 0, 0, len(frame))) + frame
    return tag + table + b"".join(frames)


def unwrap(data: bytes, track: Track | None = None) -> tuple[bytes, int]:
    """The payload that ``wrap`` stored, and how many frames fail their CRC-32."""
    track = track or parse(data)
    out, bad = [], 0
    for at, length in zip(track.offsets, track.lengths, strict=True):
        body = data[at + _HEAD + _SIDE : at + length]
        if length < UNIT:
            unit, check = body[:1] * UNIT, body[1:5]
        else:
            unit, check = body[:UNIT], body[UNIT : UNIT + 4]
        bad += struct.pack(">I", zlib.crc32(unit)) != check
        out.append(unit)
    return b"".join(out), bad


_INDEX = "struct<tags:map<string,string>,rate_table:string,hertz:int,samples:bigint,duration_s:double,frames:int,crc_ok:int,crc_bad:int,skipped:bigint,offsets:array<bigint>>"


def index(media: Column) -> Column:
    """Struct column: tags, rate table, samples and rate, frame offsets, checksum counts."""

    @F.pandas_udf(_INDEX)
    def read(rows: pd.Series) -> pd.DataFrame:
        tracks = [parse(x) for x in rows]
        return pd.DataFrame(
            {
                "tags": [t.tags for t in tracks],
                "rate_table": [t.table for t in tracks],
                "hertz": [t.hertz for t in tracks],
                "samples": [t.samples for t in tracks],
                "duration_s": [t.samples / (t.hertz or 1) for t in tracks],
                "frames": [len(t.offsets) for t in tracks],
                "crc_ok": [t.crc_ok for t in tracks],
                "crc_bad": [t.crc_bad for t in tracks],
                "skipped": [t.skipped for t in tracks],
                "offsets": [t.offsets for t in tracks],
            }
        )

    return read(media)


def store(text: Column) -> Column:
    """Binary column: the stream that holds each text's UTF-8 bytes, padded with bytes 255 to a positive multiple of 576."""

    @F.pandas_udf("binary")
    def media(rows: pd.Series) -> pd.Series:
        return pd.Series([wrap(padded((x or "").encode())) for x in rows])

    return media(text.cast("string"))


def padded(raw: bytes) -> bytes:
    return raw + b"\xff" * (-len(raw) % UNIT or (0 if raw else UNIT))


def features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store each text as a stream, read the stream back and describe it.

    Returns (id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature, frames, samples, duration_s, crc_bad, seek_middle): the
    last is the offset of the frame that holds the middle sample. No shuffle; a task
    holds one batch of texts and one stream at a time.
    """

    def read_back(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text in frame["text"]:
                raw = (text or "").encode()
                media = wrap(padded(raw))
                track = parse(media)
                payload, bad = unwrap(media, track)
                sizes = sorted(set(track.lengths))
                feature = (
                    f"mpeg2-l3 {track.hertz}Hz mono {track.table} frames={len(track.offsets)}/{track.table_frames} samples={track.samples} "
                    f"sizes={'+'.join(map(str, sizes))} crc16={track.crc_ok}:{track.crc_bad} crc32_bad={bad} skipped={track.skipped} title={track.tags.get('TIT2', '')}"
                )
                rows.append(
                    (
                        len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(),
                        feature, len(track.offsets), track.samples, track.samples / track.hertz, track.crc_bad + bad, track.seek(track.samples // 2),
                    )
                )
            out = pd.DataFrame(rows, columns=["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "frames", "samples", "duration_s", "crc_bad", "seek_middle"])
            out.insert(0, "id", frame["id"].array)
            yield out

    kind = df.schema[id_col].dataType.simpleString()
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = source.mapInPandas(read_back, f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, frames long, samples long, duration_s double, crc_bad long, seek_middle long")
    return out.withColumnRenamed("id", id_col)
