"""Whitening of embeddings with an exact covariance: digit-slice products, merged as integers.

Entries become integers, ``floor(scale * c)``. Counts and sums over the distinct vectors give
the integer part of the mean, which is taken off before anything is multiplied. What is left
is split into limbs of ``LIMB`` bits; products of limb matrices are float64 BLAS products over
so few rows that every partial sum stays below 2**53, so they are exact. A task recombines
them as big integers, whose 32-bit digits Spark sums as longs. The driver gets a matrix of
the vectors' dimension, whatever the number of rows, adds the mean's fraction exactly, and
solves it.

Cases: vectors that are null, empty or hold null or non-finite entries are left out, and so
are those of another length than most have (ties: the longest); integers beyond 62 bits are
held at that bound; repeated rows count once in the fit and each gets its rows; null ids stay
null; components without variance (one distinct vector, fewer than the dimensions) have a null
``whitened``; a deviation beyond a long is null; an empty table gives an empty result; further
columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm import common

SCALE, COMPONENTS = 256, 4
#: Bits of a limb, and rows of a product: 2 * LIMB bits and those of the rows stay below 53.
LIMB, ROWS = 16, 1 << 14
_HELD = 1 << 62
_DIGIT = 32


def integers(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, x array<bigint>) of the vectors that count."""
    kept = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    kept = kept.where(F.col("v").isNotNull() & (F.size("v") > 0) & good)
    held = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(_HELD))), F.lit(-float(_HELD)))).cast("bigint"))
    return kept.select("id", held.alias("x"))


def exact_gram(z: np.ndarray) -> np.ndarray:
    """The sum of the outer products of integer rows, as Python integers.

    Rows are cut into blocks of ``ROWS``, entries into signed limbs from the lowest.
    """
    total = np.zeros((z.shape[1], z.shape[1]), object)
    for at in range(0, len(z), ROWS):
        rest = z[at : at + ROWS]
        limbs = []
        while rest.any():
            low = rest & ((1 << LIMB) - 1)
            limbs.append(low.astype(np.float64))
            rest = rest >> LIMB
            if len(limbs) * LIMB >= 64 or (rest == -(low >> (LIMB - 1))).all():
                limbs[-1] += rest.astype(np.float64) * (1 << LIMB)  # the top limb has the sign
                break
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs[: i + 1]):
                part = (a.T @ b).astype(np.int64).astype(object)
                total += (part if i == j else part + part.T) * (1 << (LIMB * (i + j)))
    return total


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """Signed digits of base 2**32, those that are not zero."""
    k = 0
    while value:
        low = value & ((1 << _DIGIT) - 1)
        if low:
            yield k, low
        value >>= _DIGIT
        k += 1
        if value == -1:  # the sign of what is above
            yield k, -1
            return


def _blocks(batches: Iterator[pa.RecordBatch], column: str = "x") -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            array = batch.column(column).slice(at, ROWS)
            if len(array):
                yield array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1)


class Model:
    """Dimension, count, sums, scatter (n**2 times the covariance times n, exact) and the components."""

    def __init__(self, n: int, sums: list[int], gram: np.ndarray, components: int):
        self.n, self.sums = n, sums
        self.mean = [s // n for s in sums]
        self.rest = [s - n * m for s, m in zip(sums, self.mean, strict=True)]
        rest = np.array(self.rest, object)
        scatter = gram * n - np.outer(rest, rest)  # n * n * covariance
        covariance = np.array([[int(v) / (n * n) for v in row] for row in scatter], float)
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[:components]
        self.trace = sum(int(v) for v in scatter.diagonal()) / (n * n)
        self.values = values[order]
        vectors = vectors[:, order]
        largest = np.abs(vectors).argmax(0)
        self.vectors = vectors * np.where(vectors[largest, np.arange(len(order))] < 0, -1.0, 1.0)
        # beyond the rounding of the solver there is variance
        self.solid = self.values > max(abs(values).max(), 0.0) * len(sums) * 1e-15
        self.identity_error = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; not a number where a component has no variance."""
        centred = (x - np.array(self.mean, np.int64)).astype(float) - np.array([r / self.n for r in self.rest])
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.solid, centred @ self.vectors / np.sqrt(np.where(self.solid, self.values, 1.0)), np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)**2, exact; none where a long can't hold it."""
        z, rest = x - np.array(self.mean, np.int64), np.array(self.rest, object)
        most = int(np.abs(z).max(initial=0)) * self.n + max(map(int, self.rest), default=0)
        if most * most * x.shape[1] < 1 << 63:
            return ((z * self.n - rest.astype(np.int64)) ** 2).sum(1).tolist()
        sums = ((z.astype(object) * self.n - rest) ** 2).sum(1).tolist()
        return [s if s < 1 << 63 else None for s in sums]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Model | None:
    """The model of distinct integer vectors of one length (``x``), a stored table; None if there are none."""
    widths = vectors.select(F.size("x")).limit(1).collect()
    if not widths:
        return None
    width = widths[0][0]
    # sums of digits, so that no sum leaves a long
    parts = [(F.col("c").bitwiseAND(F.lit((1 << _DIGIT) - 1))).alias("low"), F.shiftright("c", _DIGIT).alias("high")]
    sums = vectors.select(F.posexplode("x").alias("i", "c")).select("i", *parts).groupBy("i").agg(F.sum("low").alias("low"), F.sum("high").alias("high"), F.count(F.lit(1)).alias("n"))
    found = {r["i"]: r for r in sums.collect()}
    n = found[0]["n"]
    total = [int(found[i]["low"]) + (int(found[i]["high"]) << _DIGIT) for i in range(width)]
    mean = np.array([s // n for s in total], np.int64)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((width, width), object)
        for x in _blocks(batches):
            gram += exact_gram(x - mean)
        rows = [(i, j, k, v) for i in range(width) for j in range(i + 1) for k, v in _digits(int(gram[i, j]))]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["i", "j", "k", "v"])

    gram = np.zeros((width, width), object)
    merged = vectors.select("x").mapInArrow(grams, "i int, j int, k int, v long").groupBy("i", "j", "k").agg(F.sum("v").alias("v"))
    for r in merged.collect():
        gram[r["i"], r["j"]] += int(r["v"]) << (_DIGIT * r["k"])
    model = Model(n, total, np.tril(gram) + np.tril(gram, -1).T, components)
    model.identity_error = _identity_error(vectors, model)
    return model


def _identity_error(vectors: DataFrame, model: Model) -> float:
    """Largest entry of the whitened fit's covariance minus the identity, measured on the vectors."""
    solid = np.flatnonzero(model.solid)
    width = len(solid)
    if not width:
        return 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + width * width)
        for x in _blocks(batches):
            w = model.project(x)[:, solid]  # centred already
            total += np.concatenate([w.sum(0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["k", "v"])

    rows = vectors.select("x").mapInArrow(moments, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(width + width * width)
    for r in rows:
        total[r["k"]] = r["v"] / model.n
    mean, second = total[:width], total[width:].reshape(width, width)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(width)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component."""
    vectors = integers(df, id_col, vector_col, scale)
    lengths = vectors.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    width = lengths[0]["width"] if lengths else 0
    vectors = vectors.where(F.size("x") == width)
    model = fit(common.stored(vectors.select("x").distinct(), "fit"), components) if width else None
    kind = dict(df.select(F.col(id_col).alias("id")).dtypes)["id"]
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x in _blocks([batch]):
                w, count = model.project(x), len(model.values)
                which = np.repeat(np.arange(len(x)), count)
                number = np.tile(np.arange(count), len(x))
                share = np.where(model.solid, model.values, 0.0) / (model.trace or 1.0)
                out = {
                    "component": pa.array(number + 1, pa.int32()), "n": pa.array(np.full(len(which), model.n), pa.int64()), "deviation": pa.array(model.deviations(x), pa.int64()).take(pa.array(which)),
                    "whitened": pa.array(w.ravel(), from_pandas=True), "explained": pa.array(share[number]), "identity_error": pa.array(np.full(len(which), model.identity_error)),
                }
                ids = batch.column("id").slice(at, len(x)).take(pa.array(which))
                at += len(x)
                yield pa.RecordBatch.from_arrays([ids, *out.values()], ["id", *out])

    if model is None:
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    return vectors.mapInArrow(rows, schema).withColumnRenamed("id", id_col)
