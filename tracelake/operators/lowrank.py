"""A movie's best approximation of a rank, from sketches: no matrix has a side of all frames or all pixels squared.

A run is a matrix of frames by pixels, cut into blocks of both. Its leading space is found
by a randomised range finder (Halko, Martinsson and Tropp, 2011): products with a few
random vectors, then with the matrix's transpose and itself in turns, until the space
stays. Tall matrices are made orthonormal by a tree of small triangular factors (TSQR),
so that a task holds a block and as many vectors as the sketch is wide.

The sketch is as wide as the matrix where that is narrow; the first pass is exact then.
Passes end when the leading space turns by less than ``tolerance`` (the sine of the
largest angle, at most); ``PASSES`` without that raise.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.sources.shared import stored

#: Side of a block, triangular factors that one task stacks, width up to which a sketch is the whole space, and passes.
SIDE, FAN, WHOLE, PASSES = 512, 32, 256, 60
MATRIX = "run string, k long, m int, data binary"


def _arrays(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(n) for n in names]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def _batch(run: str, k: int, a: np.ndarray) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((run, k, len(a), np.ascontiguousarray(a).tobytes()), kinds, strict=True)], ["run", "k", "m", "data"])


def _matrix(data: bytes, m: int) -> np.ndarray:
    return np.frombuffer(data).reshape(m, -1)


def blocks_of(pixels: DataFrame, side: int = SIDE) -> DataFrame:
    """(run, tb, pb, h, w, f, i, data) of (run, frame, y, x, v): blocks, with the places that the movie has; null values are zero."""
    wide = pixels.groupBy("run").agg((F.max("x") + 1).alias("_w"))
    at = pixels.join(wide, "run").select("run", "frame", (F.col("y") * F.col("_w") + F.col("x")).cast("bigint").alias("p"), F.coalesce(F.col("v").cast("double"), F.lit(0.0)).alias("v"), "_w")
    cut = at.groupBy("run", F.expr(f"frame div {side}").alias("tb"), F.expr(f"p div {side}").alias("pb"), "_w")
    point = F.struct((F.col("frame") % side).cast("int").alias("f"), (F.col("p") % side).cast("int").alias("i"), "v")
    rows = cut.agg(F.collect_list(point).alias("e")).select(F.col("run").cast("string").alias("run"), "tb", "pb", F.col("_w").cast("int").alias("w"), F.col("e.f").alias("f"), F.col("e.i").alias("i"), F.col("e.v").alias("v"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = []
            for j in range(batch.num_rows):
                f, i, v = (batch.column(c)[j].values.to_numpy(zero_copy_only=False) for c in ("f", "i", "v"))
                a = np.zeros((side, side))
                a[f, i] = v
                data.append(a.tobytes())
            names = ["run", "tb", "pb", "w", "f", "i"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(data, pa.binary())], [*names, "data"])

    return rows.mapInArrow(made, "run string, tb long, pb long, w int, f array<int>, i array<int>, data binary")


def _times(a: DataFrame, vectors: DataFrame, over: str, to: str, side: int) -> DataFrame:
    """The matrix (or its transpose) times vectors whose blocks ``k`` are numbered by ``over``; blocks by ``to``."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sums of what this task has of a block come first
        held: dict[tuple[str, int], np.ndarray] = {}
        for run, k, data, m, v in _arrays(batches, ("run", to, "data", "m", "v")):
            block = _matrix(data, side)
            part = (block if over == "pb" else block.T) @ _matrix(v, m)
            held[run, k] = held[run, k] + part if (run, k) in held else part
            if len(held) > 64:
                yield from (_batch(*key, x) for key, x in held.items())
                held = {}
        yield from (_batch(*key, x) for key, x in held.items())

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for run, k, m, data in _arrays(batches, ("run", "k", "m", "data")):
            if key == (run, k):
                total = total + _matrix(data, m)
                continue
            if key is not None:
                yield _batch(*key, total)
            key, total = (run, k), _matrix(data, m)
        if key is not None:
            yield _batch(*key, total)

    met = a.select("run", "tb", "pb", "data").join(vectors.select("run", F.col("k").alias(over), "m", F.col("data").alias("v")), ["run", over])
    return met.mapInArrow(partial, MATRIX).repartition("run", "k").sortWithinPartitions("run", "k").mapInArrow(summed, MATRIX)


def _factor(vectors: DataFrame, blocks: int) -> DataFrame:
    """(run, r): the triangular factor of each run's tall matrix, by a tree."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run, k, m, data in _arrays(batches, ("run", "k", "m", "data")):
            yield _batch(run, k, np.linalg.qr(_matrix(data, m), mode="r"))

    def stacked(frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame.sort_values("k")
        r = np.linalg.qr(np.vstack([_matrix(d, m) for m, d in zip(rows["m"], rows["data"], strict=True)]), mode="r")
        return pd.DataFrame({"run": [rows["run"].iloc[0]], "k": [int(rows["k"].iloc[0])], "m": [len(r)], "data": [r.tobytes()]})

    factors = vectors.mapInArrow(local, MATRIX)
    while blocks > 1:
        factors = factors.withColumn("k", F.expr(f"k div {FAN}")).groupBy("run", "k").applyInPandas(stacked, MATRIX)
        blocks = -(-blocks // FAN)
    return factors.select("run", F.col("m").alias("rm"), F.col("data").alias("r"))


def _mapped(vectors: DataFrame, factors: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Vectors times a small matrix that ``of`` makes of the run's factor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}
        for name, k, m, data, rm, r in _arrays(batches, ("run", "k", "m", "data", "rm", "r")):
            if name not in known:
                known = {name: of(_matrix(r, rm))}
            yield _batch(name, k, _matrix(data, m) @ known[name])

    return vectors.join(factors, "run").mapInArrow(run, MATRIX)


def _inverse(r: np.ndarray) -> np.ndarray:
    """What makes the columns orthonormal; directions that aren't there become zero."""
    _, s, vt = np.linalg.svd(r)
    s = np.concatenate([s, np.zeros(len(vt) - len(s))])
    there = s > (s[0] if len(s) else 0.0) * 1e-13
    return vt.T * np.where(there, 1 / np.where(there, s, 1.0), 0.0)


def orthonormal(vectors: DataFrame, blocks: int, name: str) -> DataFrame:
    """The same space, by orthonormal columns; twice, as one step leaves the error of the condition."""
    for _ in range(2):
        vectors = stored(vectors, name)
        vectors = _mapped(vectors, stored(_factor(vectors, blocks), "factor"), _inverse)
    return stored(vectors, name)


def _turned(old: DataFrame, new: DataFrame) -> float:
    """Norm of what the new leading vectors have outside the old space, over all runs the largest."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run, k, m, data, v in _arrays(batches, ("run", "k", "m", "data", "v")):
            yield _batch(run, k, _matrix(v, m).T @ _matrix(data, m))

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(_matrix(d, m) for m, d in zip(frame["m"], frame["data"], strict=True))
        return pd.DataFrame({"run": [frame["run"].iloc[0]], "k": [0], "m": [len(total)], "data": [total.tobytes()]})

    def outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run, m, data, v, rm, r in _arrays(batches, ("run", "m", "data", "v", "rm", "r")):
            rest = _matrix(data, m) - _matrix(v, m) @ _matrix(r, rm)
            yield pa.RecordBatch.from_arrays([pa.array([run]), pa.array([float((rest**2).sum())])], ["run", "s"])

    both = new.join(old.select("run", "k", F.col("data").alias("v")), ["run", "k"])
    part = F.pmod("k", F.lit(FAN))  # partial sums first
    sums = both.mapInArrow(inner, MATRIX).groupBy("run", part).applyInPandas(added, MATRIX).groupBy("run").applyInPandas(added, MATRIX)
    rest = both.join(sums.select("run", F.col("m").alias("rm"), F.col("data").alias("r")), "run").mapInArrow(outside, "run string, s double")
    return rest.groupBy("run").agg(F.sqrt(F.sum("s")).alias("s")).agg(F.max("s")).first()[0] or 0.0


def low_rank(pixels: DataFrame, rank: int, side: int = SIDE, width: int | None = None, tolerance: float = 1e-9, seed: int = 7) -> DataFrame:
    """The movie's best approximation of a rank, as pixels.

    Missing pixels and null ones count as zero, and only places that the movie has are
    returned. Runs are approximated each by themselves, all in the same jobs. ``width``
    is the sketch's; where singular values are equal at the rank, no best one stands out
    and the passes may not end.
    """
    a = stored(blocks_of(pixels, side), "blocks")
    sizes = a.agg(F.max("tb"), F.max("pb")).first()
    if sizes[0] is None:
        return pixels.select("run", "frame", "y", "x", F.col("v").cast("double").alias("v")).limit(0)
    tall, wide = sizes[0] + 1, sizes[1] + 1
    reach = a.select("run", F.array_max("f").alias("f"), F.array_max("i").alias("i"), "tb", "pb")
    narrow = reach.groupBy("run").agg(F.least(F.max(F.col("tb") * side + F.col("f")), F.max(F.col("pb") * side + F.col("i"))).alias("n")).agg(F.max("n")).first()[0] + 1
    whole = width is None and narrow <= WHOLE
    columns = max(rank, min(narrow, width or (narrow if whole else 2 * rank + 30)))

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run, k in _arrays(batches, ("run", "pb")):
            yield _batch(run, k, np.random.default_rng([seed, k, zlib.crc32(run.encode())]).normal(size=(side, columns)))

    right = a.select("run", "pb").distinct().mapInArrow(drawn, MATRIX)
    leading = None
    for _ in range(PASSES):
        left = orthonormal(_times(a, right, "pb", "tb", side), tall, "left")
        right = orthonormal(_times(a, left, "tb", "pb", side), wide, "right")
        # the matrix in the sketch's space, and there the leading directions
        image = stored(_times(a, right, "pb", "tb", side), "image")
        factors = stored(_factor(image, tall), "factor")
        ahead = lambda r: np.linalg.svd(r)[2][:rank].T
        before, leading = leading, stored(_mapped(right, factors, ahead), "leading")
        if whole or (before is not None and _turned(before, leading) <= tolerance):
            break
    else:
        raise ValueError("the leading space doesn't settle: singular values are too close at this rank")
    scores = _mapped(image, factors, ahead)

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for j in range(batch.num_rows):
                run, tb, pb, w, m, u, n, v = (batch.column(c)[j].as_py() for c in ("run", "tb", "pb", "w", "m", "u", "n", "v"))
                f, i = (batch.column(c)[j].values.to_numpy() for c in ("f", "i"))
                values = (_matrix(u, m) @ _matrix(v, n).T)[f, i]
                p = pb * side + i.astype(np.int64)
                arrays = [pa.array([run] * len(f)), pa.array(tb * side + f.astype(np.int64)), pa.array((p // w).astype(np.int32)), pa.array((p % w).astype(np.int32)), pa.array(values)]
                yield pa.RecordBatch.from_arrays(arrays, ["run", "frame", "y", "x", "v"])

    met = a.drop("data").join(scores.select("run", F.col("k").alias("tb"), "m", F.col("data").alias("u")), ["run", "tb"])
    met = met.join(leading.select("run", F.col("k").alias("pb"), F.col("m").alias("n"), F.col("data").alias("v")), ["run", "pb"])
    return met.mapInArrow(out, "run string, frame long, y int, x int, v double")
