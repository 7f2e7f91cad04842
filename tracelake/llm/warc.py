"""WARC records in seekable Zstandard bundles.

Records are packed into frames that decompress on their own; a skippable frame at the
end of a bundle holds the public seek table (sizes and checksum of every frame), and
an index maps each record's identifier to its frame and the offset inside the frame.
A reader that wants one record decompresses one frame.

Bundles are rows of a table in the shared folder (or any folder given), each of a
bounded size; a bundle's bytes are a valid ``.warc.zst`` file as they are.

Equal payloads of at least ``min_bytes`` bytes are stored once: the row with the
largest id is the response, the others are revisits that refer to it. Finding them
aggregates digests before the shuffle, and only digests that repeat are joined back,
salted, so that one page copied a million times is spread over tasks.

Cases: a null payload is an empty one; rows with a null id are kept, and are responses
unless an equal payload has an id; repeated rows (same id and payload) are all
responses; line ends in an address and all but plain characters in an id are
percent-encoded, so ids of any text come back as they were; an empty table gives no bundle;
further columns are left out, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm import common

#: Uncompressed bytes of records in a frame, and compressed bytes in a bundle, about.
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 23
#: Tasks over which one repeated payload's rows are dealt.
SALTS = 32
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the seekable format.
_SKIPPABLE = 0x184D2A5E
_SEEKABLE = 0x8F92EAB1
_CHECKSUMS = 0x80

_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BUNDLES = "bundle string, data binary, index array<struct<record:string,frame:int,offset:bigint,length:bigint>>"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(record_id: str, url: str, payload: bytes, refers_to: str | None = None, date: str = DATE) -> bytes:
    """One WARC record: the response with its payload, or a revisit with the response's head only."""
    url = url.replace("\r", "%0D").replace("\n", "%0A")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {_REVISIT}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def urn(key: str | None) -> str:
    """A record's identifier, with what a field can't hold percent-encoded."""
    return "urn:none" if key is None else f"urn:record:{quote(key, safe='')}"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields (names in lower case) and the payload that is stored."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record starts here")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in http.decode().split("\r\n")[1:])}, payload


class Writer:
    """Collects records into frames and frames into a bundle."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.frame_bytes, self.coder = frame_bytes, zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.open: list[bytes] = []
        self.open_bytes = 0
        self.frames: list[tuple[bytes, int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []
        self.size = 0

    def add(self, record_id: str, raw: bytes) -> None:
        self.index.append((record_id, len(self.frames), self.open_bytes, len(raw)))
        self.open.append(raw)
        self.open_bytes += len(raw)
        if self.open_bytes >= self.frame_bytes:
            self._close_frame()

    def _close_frame(self) -> None:
        if self.open:
            raw = b"".join(self.open)
            frame = self.coder.compress(raw)
            self.frames.append((frame, len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.size += len(frame)
            self.open, self.open_bytes = [], 0

    def close(self) -> bytes:
        self._close_frame()
        entries = b"".join(struct.pack("<III", len(frame), n, check) for frame, n, check in self.frames)
        footer = struct.pack("<IBI", len(self.frames), _CHECKSUMS, _SEEKABLE)
        table = struct.pack("<II", _SKIPPABLE, len(entries) + len(footer)) + entries + footer
        return b"".join(frame for frame, _, _ in self.frames) + table


def seek_table(data: bytes) -> list[tuple[int, int, int, int | None]]:
    """(offset, compressed size, size, checksum) of every frame, read from a bundle's end."""
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != _SEEKABLE:
        raise ValueError("the bundle has no seek table")
    width = 12 if flags & _CHECKSUMS else 8
    start = len(data) - 9 - n * width
    if struct.unpack("<II", data[start - 8 : start]) != (_SKIPPABLE, n * width + 9):
        raise ValueError("the seek table is damaged")
    out, at = [], 0
    for i in range(n):
        entry = struct.unpack_from("<III" if width == 12 else "<II", data, start + i * width)
        out.append((at, entry[0], entry[1], entry[2] if width == 12 else None))
        at += entry[0]
    return out


def read_frame(data: bytes, entry: tuple[int, int, int, int | None]) -> bytes:
    at, packed, size, check = entry
    raw = zstandard.ZstdDecompressor().decompress(data[at : at + packed], max_output_size=size)
    if len(raw) != size or check is not None and xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
        raise ValueError("a frame doesn't match its entry in the seek table")
    return raw


def read_records(data: bytes, index) -> Iterator[bytes]:
    """The indexed records in order; every frame is decompressed once."""
    table, now, raw = seek_table(data), -1, b""
    for entry in sorted(index, key=lambda e: (e["frame"], e["offset"])):
        if entry["frame"] != now:
            now = entry["frame"]
            raw = read_frame(data, table[now])
        yield raw[entry["offset"] : entry["offset"] + entry["length"]]


def refer(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 0, salts: int = SALTS) -> DataFrame:
    """Adds ``refers_to``: the id that a revisit refers to, null for a response.

    Ids and digests alone are shuffled and joined; the revisits' rows, stored, then meet the
    payloads, which move only where there are too many revisits to send them to all tasks.
    """
    long_enough = F.coalesce(F.octet_length(payload_col), F.lit(0)) >= min_bytes
    row = pages.withColumn("_sha", F.when(long_enough, F.sha1(F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")))))
    narrow = row.filter("_sha is not null").select(F.col(id_col).alias("_of"), "_sha", F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int").alias("_salt"))
    repeated = narrow.groupBy("_sha").agg(F.max("_of").alias("_last"), F.count("*").alias("_n")).filter("_n > 1 and _last is not null")
    repeated = repeated.select("_sha", "_last", F.explode(F.array(*[F.lit(i) for i in range(salts)])).alias("_salt"))
    revisits = narrow.join(repeated, ["_sha", "_salt"]).filter(~F.col("_of").eqNullSafe(F.col("_last"))).select("_of", F.col("_sha").alias("_as"), F.col("_last").alias("refers_to")).distinct()
    revisits = common.stored(revisits, "revisits")
    return row.join(revisits, F.col(id_col).eqNullSafe(F.col("_of")) & (F.col("_sha") == F.col("_as")), "left").drop("_sha", "_of", "_as")


def write_bundles(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> None:
    """Write every row's record into bundles under ``path``, a Parquet table with the schema BUNDLES."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, made, writer = TaskContext.get().partitionId(), 0, Writer(frame_bytes)

        def full() -> pd.DataFrame:
            keys = ("record", "frame", "offset", "length")
            return pd.DataFrame({"bundle": [f"{part:06d}-{made:04d}.warc.zst"], "data": [writer.close()], "index": [[dict(zip(keys, x, strict=True)) for x in writer.index]]})

        for frame in frames:
            for key, url, payload, ref in zip(frame["id"], frame["url"], frame["payload"], frame["refers_to"], strict=True):
                record_id = urn(key)
                writer.add(record_id, record(record_id, url or "", bytes(payload or b""), None if ref is None else urn(ref)))
                if writer.size >= bundle_bytes:
                    yield full()
                    made, writer = made + 1, Writer(frame_bytes)
        if writer.index:
            yield full()

    source = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"), F.col(payload_col).cast("binary").alias("_payload"))
    rows = refer(source, "_id", "_payload", min_bytes).select(F.col("_id").cast("string").alias("id"), F.col("_url").alias("url"), F.col("_payload").alias("payload"), F.col("refers_to").cast("string").alias("refers_to"))
    rows.mapInPandas(pack, BUNDLES).write.parquet(path)


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Read every record of the bundles under ``path``.

    (record, url, payload, payload_bytes, payload_digest, record_type, refers_to,
    bundle, frame, frame_offset); the digest of a stored payload is checked.
    """

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for bundle, data, index in zip(frame["bundle"], frame["data"], frame["index"], strict=True):
                rows = []
                entries = sorted(index, key=lambda e: (e["frame"], e["offset"]))
                for entry, raw in zip(entries, read_records(bytes(data), entries), strict=True):
                    fields, http, payload = parse_record(raw)
                    said = fields["warc-payload-digest"].removeprefix("sha1:")
                    kind = fields["warc-type"]
                    if kind == "response" and digest(payload) != said or fields["warc-record-id"].strip("<>") != entry["record"]:
                        raise ValueError(f"{bundle}: {entry['record']} isn't what the index or its digest says")
                    refers = fields.get("warc-refers-to")
                    rows.append((entry["record"], fields["warc-target-uri"], payload if kind == "response" else None, int(http["content-length"]), said, kind, refers and refers.strip("<>"), bundle, entry["frame"], entry["offset"]))
                yield pd.DataFrame(rows, columns=["record", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to", "bundle", "frame", "frame_offset"])

    schema = "record string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to string, bundle string, frame int, frame_offset long"
    return spark.read.schema(BUNDLES).parquet(path).mapInPandas(unpack, schema)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write the bundles, read them back: one row per page, ids with their own type."""
    spark, kind = pages.sparkSession, pages.schema[id_col].dataType
    path = path or common.scratch(spark, "warc")
    write_bundles(pages, path, id_col, url_col, payload_col, min_bytes)

    def number(name: str):
        key = F.expr(f"url_decode(substring({name}, {len('urn:record:') + 1}))")
        return F.when(F.startswith(name, F.lit("urn:record:")), key).cast(kind)

    back = read_bundles(spark, path)
    return back.select(number("record").alias(id_col), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"), "bundle", "frame", "frame_offset")


#: Columns of an archived page that don't depend on how records were packed.
DIGEST = ("payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle() -> str:
    """DuckDB SQL for those columns over ``pages``; a digest's 160 bits are read five at a time."""
    nibble = "instr('0123456789abcdef', substr(h, {0}, 1)) - 1"
    three = " + ".join(f"{16 ** (2 - k)} * greatest(0, {nibble.format(f'5 * i // 4 + {k + 1}')})" for k in range(3))
    letter = f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((({three})::INT >> (7 - 5 * i % 4)::INT) & 31) + 1, 1)"
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages), n AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last FROM p),
        d AS (SELECT h, string_agg({letter}, '' ORDER BY i) AS digest FROM (SELECT DISTINCT h FROM p), range(32) r(i) GROUP BY h)
        SELECT page_id, strlen(html)::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN last <> page_id THEN last END AS refers_to FROM n JOIN d USING (h)"""
