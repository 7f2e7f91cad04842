"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tracelake.sources.shared import remove, scope, scratch, stored

__all__ = ["WORD", "map_slices", "lower_ascii", "pack", "pack_keys", "remove", "scope", "scratch", "stored", "table", "text_or_empty", "unpack", "unpack_keys", "whole_groups"]

#: A word is a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def whole_groups(frames: Iterator[pd.DataFrame], key: str, least: int) -> Iterator[pd.DataFrame]:
    """Rows in which those of a group follow each other, in frames of ``least`` rows or more that hold whole groups."""
    held: list[pd.DataFrame] = []
    size = 0
    for frame in frames:
        held.append(frame)
        size += len(frame)
        if size >= least:
            whole = pd.concat(held, ignore_index=True)
            group = whole[key].to_numpy()
            other = np.flatnonzero(group != group[-1])  # the last group may go on
            stop = other[-1] + 1 if len(other) else 0
            if stop:
                yield whole.iloc[:stop]
            held, size = [whole.iloc[stop:]], len(whole) - stop
    if size:
        yield pd.concat(held, ignore_index=True)


def pack(values: np.ndarray) -> bytes:
    """An array as compressed bytes, the values' like bytes together."""
    flat = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(flat.T.tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted integers, as differences."""
    return pack(np.diff(keys, prepend=np.int64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "i8"))


#: Rows that Python holds as objects at once. Spark's batches have up to 10,000 texts.
SLICE_ROWS = 1000


def map_slices(df: DataFrame, run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, rows: int = SLICE_ROWS) -> DataFrame:
    """As ``mapInPandas``, but batches stay Arrow and become frames of ``rows`` rows one after another: less memory on both sides."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = (batch.slice(at, rows).to_pandas() for batch in batches for at in range(0, batch.num_rows, rows))
        for out in run(frames):
            yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)

    return df.mapInArrow(mapped, schema)
