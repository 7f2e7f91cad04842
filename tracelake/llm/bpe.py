"""Byte-level BPE encoding and decoding with a local rank file.

The merges are the tiktoken library's. What is added here: texts longer than
``limit`` characters are cut where no match of the pre-splitting pattern can reach
across, so that neither the regular expression's stack nor its matches grow with the
length of one text (a single match, such as a run of letters without end, is one piece
to the library, too), and ids are decoded to raw bytes (a single id may
be part of a UTF-8 sequence).

Cases: a null text is encoded as the empty text and gives no ids; null ids decode to
empty bytes; repeated rows give repeated results; an empty table gives an empty result;
``encode`` and ``decode`` are columns and leave other columns alone, ``round_trip`` returns
the id, the columns asked for and its own, whatever else the table has.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm import common

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Characters that are handed to the library at once, about.
LIMIT = 100_000

#: Unicode's White_Space, which is what ``\s`` means in the pattern. (Python's own
#: ``\s`` also takes U+001C to U+001F.)
_SPACE = "\t-\r \x85\xa0  -     　"
#: Characters that are letters, digits and neither in any version of Unicode.
_LETTER, _DIGIT, _OTHER = "A-Za-z\u4e00-\u9fa5", "0-9", "!-&(-/:-@\\[-`{-~\u3001\u3002"
_EDGE = re.compile(
    f"(?<=[^{_SPACE}])[{_SPACE}]|(?<=[{_LETTER}])(?=[{_DIGIT}{_OTHER}'])|(?<=[{_DIGIT}])(?=[{_LETTER}{_OTHER}'])|(?<=[{_OTHER}])(?=[{_LETTER}{_DIGIT}])|(?<=')(?=[{_DIGIT}])"
)
_RUN = re.compile(f"[{_SPACE}]+")


@functools.lru_cache(maxsize=4)
def encoding(rank_path: str = RANKS, pattern: str = PATTERN):
    """The library's encoder; one for each worker process and rank file."""
    import tiktoken

    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, limit: int = LIMIT) -> Iterator[tuple[str, bool]]:
    """Cut ``text`` where the pattern's matches end anyway.

    Only ``\\s+`` and one leading blank take white space, and always at the start of
    a match; so no match holds a non-space followed by a space, and each such place
    is a match's end. So is a place between a letter, a digit and another sign, in any
    order, but for an apostrophe before a letter. A run of white space before a non-space is one match without
    its last character; at the end of the text it is one match as a whole. Yields
    pieces, and whether a piece is a single match (a run longer than ``limit``).
    """
    at = 0
    while len(text) - at > limit:
        if (run := _RUN.match(text, at)) and run.end() - at > limit:
            end = run.end() if run.end() == len(text) else run.end() - 1
            yield text[at:end], True
            at = end
            continue
        edge = _EDGE.search(text, at + limit)
        # a run that is cut off as a piece of its own must start at its first character
        for run in _RUN.finditer(text, at + 1, edge.start() if edge else len(text)):
            if run.end() - run.start() > limit:
                edge = run
                break
        if edge is None:
            break
        yield text[at : edge.start()], False
        at = edge.start()
    if at < len(text):
        run = _RUN.match(text, at)
        yield text[at:], bool(run and run.end() == len(text))


def encode_text(enc, text: str | None, limit: int = LIMIT) -> np.ndarray:
    """Ids of one text, little-endian unsigned 32-bit."""
    if not text:
        return np.empty(0, "<u4")
    if len(text) <= limit:
        return np.array(enc.encode_ordinary(text), "<u4")
    ids = [enc._encode_single_piece(piece) if single else enc.encode_ordinary(piece) for piece, single in safe_pieces(text, limit)]
    return np.concatenate([np.array(x, "<u4") for x in ids])


def encode(text: Column, rank_path: str = RANKS, pattern: str = PATTERN, limit: int = LIMIT) -> Column:
    """Column of ids: array<bigint> (an id is unsigned 32-bit)."""

    @F.pandas_udf("array<bigint>")
    def ids(texts: pd.Series) -> pd.Series:
        enc = encoding(rank_path, pattern)
        return pd.Series([encode_text(enc, x, limit).astype(np.int64) for x in texts])

    return ids(text.cast("string"))


def decode(ids: Column, rank_path: str = RANKS, pattern: str = PATTERN) -> Column:
    """Column of raw bytes: binary, not decoded as UTF-8."""

    @F.pandas_udf("binary")
    def raw(rows: pd.Series) -> pd.Series:
        enc = encoding(rank_path, pattern)
        return pd.Series([b"" if x is None else enc.decode_bytes([int(i) for i in x]) for x in rows])

    return raw(ids)


def round_trip(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rank_path: str = RANKS,
    pattern: str = PATTERN,
    limit: int = LIMIT,
    keep: tuple[str, ...] = (),
    with_ids: bool = False,
) -> DataFrame:
    """Encode, decode and digest each text: (id, columns ``keep``, n_tokens, n_bytes, ids_sha256, decoded_sha256).

    ``with_ids`` adds the ids as little-endian unsigned 32-bit integers. One pass, so
    that bytes don't leave the worker; no shuffle.
    """
    names = ["n_tokens", "n_bytes", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(rank_path, pattern)
        for frame in frames:
            rows = []
            for text in frame["text"]:
                ids = encode_text(enc, text, limit)
                raw = enc.decode_bytes(ids.tolist())
                rows.append((len(ids), len(raw), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest(), *[ids.tobytes()] * with_ids))
            out = pd.DataFrame(rows, columns=names)
            yield pd.concat([frame.drop(columns="text").reset_index(drop=True), out], axis=1)

    source = df.select(F.col(id_col).alias("id"), *[F.col(c).alias(f"keep_{c}") for c in keep], F.col(text_col).cast("string").alias("text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    out = common.map_slices(source, digests, kinds + "n_tokens long, n_bytes long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids)
    return out.withColumnsRenamed({"id": id_col} | {f"keep_{c}": c for c in keep})
