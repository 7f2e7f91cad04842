"""Periodograms of long traces: a transform in columns and rows, with the transpose as a shuffle.

A trace has any length N, so its transform is a convolution with a chirp (Bluestein,
1970) at a power of two M >= 2 N - 1. M is cut into M1 columns' length by M2 columns, both
near its root (Bailey's six steps, 1990): tasks transform some columns, apply the
twiddle factors and hand tiles on; tasks that get a tile of each column transform rows.
There the chirp's transform is multiplied in and the way back begins, with rows first; a
second transpose ends it. A task has the columns (or rows) of a block, about ``POINTS``
numbers and at least one, which grows with the root of a trace.

Cases: null values count as the mean; a trace of one frame has power 0 at 0; missing frames
count as the mean; an empty table gives an empty result; further columns are dropped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("run", "channel")
#: Numbers of a task's block of columns or rows.
POINTS = 1 << 18
_TILE = "run string, channel string, n long, to long, at long, a binary, b binary"


def _shape(n: int) -> tuple[int, int]:
    """M1, M2 with a product of at least 2 n - 1."""
    bits = max(2, int(2 * n - 1).bit_length())
    return 1 << bits // 2, 1 << bits - bits // 2


def _block(length: int, points: int) -> int:
    """Columns of a block, of so many numbers each."""
    return max(1, points // length)


def _chirp(at: np.ndarray, n: int) -> np.ndarray:
    """exp(i pi k**2 / n), from whole numbers so that long traces keep their phase."""
    return np.exp(1j * np.pi * ((at.astype(object) ** 2 % (2 * n)).astype(float) if n > 1 << 30 else (at**2 % (2 * n))) / n)


def _twiddled(a: np.ndarray, columns: np.ndarray, size: int, sign: int) -> np.ndarray:
    """Rows k by ``columns``: times exp(sign 2 pi i k column / size)."""
    k = np.arange(len(a))[:, None] * columns[None, :]
    return a * np.exp(sign * 2j * np.pi * (k % size) / size)


def _tiles(frame: tuple, first: int, a: np.ndarray, b: np.ndarray | None, block: int) -> pd.DataFrame:
    """Blocks of rows, for the tasks that have these rows of all columns."""
    run, channel, n = frame
    starts = range(0, len(a), block)
    cut = lambda x: [np.ascontiguousarray(x[i : i + block]).tobytes() for i in starts] if x is not None else [None] * len(starts)
    return pd.DataFrame({"run": run, "channel": channel, "n": n, "to": list(starts), "at": first, "a": cut(a), "b": cut(b)})


def _joined(frame: pd.DataFrame, column: str, rows: int) -> np.ndarray:
    """Rows of all columns from their tiles, in the columns' order."""
    return np.hstack([np.frombuffer(x, complex).reshape(rows, -1) for x in frame.sort_values("at")[column]])


def periodogram(df: DataFrame, fps: float, points: int = POINTS) -> DataFrame:
    """(run, channel, hz, power) of (run, channel, frame, v) under a Hann window."""
    whole = df.groupBy(*KEYS).agg((F.max("frame") + 1).alias("n"), F.avg("v").alias("mean"))
    rows = df.select(*KEYS, F.col("frame").cast("bigint").alias("frame"), F.col("v").cast("double").alias("v")).join(whole, list(KEYS))
    hann = F.when(F.col("n") > 1, 0.5 - 0.5 * F.cos(2 * np.pi * F.col("frame") / (F.col("n") - 1))).otherwise(1.0)
    rows = rows.select(F.col("run").cast("string").alias("run"), F.col("channel").cast("string").alias("channel"), F.col("n").cast("bigint").alias("n"), "frame", F.coalesce((F.col("v") - F.col("mean")) * hann, F.lit(0.0)).alias("x"))

    @F.pandas_udf("bigint")
    def block_of(frame: pd.Series, n: pd.Series) -> pd.Series:
        shapes = {k: _shape(int(k)) for k in n.unique()}
        m1, m2 = (n.map({k: s[i] for k, s in shapes.items()}) for i in (0, 1))
        return (frame % m2) // np.maximum(1, points // m1)

    # every block of columns, as the chirp has values where the trace has none
    @F.pandas_udf("array<bigint>")
    def blocks_of(n: pd.Series) -> pd.Series:
        return pd.Series([list(range(-(-_shape(int(k))[1] // _block(_shape(int(k))[0], points)))) for k in n])

    every = whole.select(F.col("run").cast("string").alias("run"), F.col("channel").cast("string").alias("channel"), F.col("n").cast("bigint").alias("n"))
    every = every.select("run", "channel", "n", F.explode(blocks_of("n")).alias("block"), F.lit(None).cast("bigint").alias("frame"), F.lit(0.0).alias("x"))
    dealt = rows.withColumn("block", block_of("frame", "n")).unionByName(every)

    def columns(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        run, channel, n, block = key
        (m1, m2), size = _shape(n), _block(_shape(n)[0], points)
        first = block * size
        width = min(size, m2 - first)
        there = frame[frame["frame"].notna()]
        at = there["frame"].to_numpy(np.int64)
        a = np.zeros((m1, width), complex)
        a[at // m2, at % m2 - first] = there["x"].to_numpy() * np.conj(_chirp(at, n))
        place = np.arange(m1)[:, None] * m2 + np.arange(first, first + width)[None, :]
        back = np.minimum(place, m1 * m2 - place)  # the chirp goes both ways
        b = np.where(back < n, _chirp(np.where(back < n, back, 0), n), 0)
        a, b = (_twiddled(np.fft.fft(x, axis=0), np.arange(first, first + width), m1 * m2, -1) for x in (a, b))
        return _tiles((run, channel, n), first, a, b, _block(m2, points))

    def middle(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        run, channel, n, first = key
        m1, m2 = _shape(n)
        height = min(_block(m2, points), m1 - first)
        both = np.fft.fft(_joined(frame, "a", height), axis=1) * np.fft.fft(_joined(frame, "b", height), axis=1)
        back = np.fft.ifft(both, axis=1).T  # by place, and the rows are columns now
        return _tiles((run, channel, n), first, _twiddled(back, np.arange(first, first + height), m1 * m2, 1), None, _block(m1, points))

    def ends(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        run, channel, n, first = key
        m1, m2 = _shape(n)
        height = min(_block(m1, points), m2 - first)
        y = np.fft.ifft(_joined(frame, "a", height), axis=1)
        k = np.arange(first, first + height)[:, None] + m2 * np.arange(m1)[None, :]
        good = k <= n // 2
        return pd.DataFrame({"run": run, "channel": channel, "hz": k[good] * fps / n, "power": np.abs(y[good]) ** 2})

    tiles = dealt.groupBy("run", "channel", "n", "block").applyInPandas(columns, _TILE)
    turned = tiles.groupBy("run", "channel", "n", "to").applyInPandas(middle, _TILE)
    return turned.groupBy("run", "channel", "n", "to").applyInPandas(ends, "run string, channel string, hz double, power double")
