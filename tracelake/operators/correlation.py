"""Correlation at lags, effective sample sizes, and the gate that a run must pass before it is analysed.

Sums of lagged products are made in tiles: some channels of one trace table by a block of
frames, against all channels of the other in the blocks that its lags reach. Channels are
dealt by hash; the other table's blocks are copied to each deal. A tile is a product of two
matrices for each lag, or of their Fourier transforms where there are many lags. No frame
meets all its lags as rows, and no task needs a whole trace or all channels.

Cases: null values and missing frames add nothing to a sum; a constant trace correlates
with nothing (0); repeated frames add up; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions import expressions as X
from tracelake.operators.scans import BLOCK
from tracelake.operators.sequence import KEYS

#: Lags up to which products are summed lag by lag, channels of a tile, and sums that a tile may give.
FEW, DEAL, SUMS = 64, 64, 4_000_000


def _blocks(df: DataFrame, block: int) -> DataFrame:
    """(run, channel, b, f, x): frames and values of each block, in any order."""
    cut = df.groupBy("run", F.col("channel").cast("string").alias("channel"), F.expr(f"cast(frame div {block} as bigint)").alias("b"))
    rows = cut.agg(F.collect_list(F.when(F.col("v").isNotNull(), F.struct((F.col("frame") % block).cast("int").alias("f"), F.col("v").cast("double").alias("x")))).alias("p"))
    return rows.select("run", "channel", "b", F.col("p.f").alias("f"), F.col("p.x").alias("x"))


def products(later: np.ndarray, early: np.ndarray, low: int, high: int, same: bool = False) -> np.ndarray:
    """Sums of later[i, t + k] * early[j, t] for k from ``low`` to ``high``: [i, j, k], or [i, k] of like rows (``same``)."""
    n, m = later.shape[1], early.shape[1]
    lags = range(low, high + 1)
    out = np.zeros((len(later), *[len(early)] * (not same), len(lags)))
    if len(lags) <= FEW:
        for at, k in enumerate(lags):
            if -m < k < n:
                a, b = later[:, max(k, 0) : min(n, m + k)], early[:, max(-k, 0) : min(m, n - k)]
                out[..., at] = np.einsum("it,it->i", a, b) if same else a @ b.T
        return out
    size = 1 << (n + m - 1).bit_length()
    k = np.array(lags)
    there = (k > -m) & (k < n)
    partner = np.conj(np.fft.rfft(early, size))
    for i, row in enumerate(later):
        ahead = np.fft.rfft(row, size)
        for j in [i] if same else range(len(early)):
            whole = np.fft.irfft(ahead * partner[j], size)
            out[(i,) if same else (i, j)] = np.where(there, whole[k % size], 0.0)
    return out


def _matrix(table: pa.Table, block: int) -> tuple[list[str], list[int], np.ndarray]:
    """Names, block numbers and rows of a tile's traces; missing frames are zero."""
    rows = np.zeros((table.num_rows, block))
    f, x = (table.column(c).combine_chunks() for c in ("f", "x"))
    for i in range(table.num_rows):
        np.add.at(rows[i], f[i].values.to_numpy(), x[i].values.to_numpy(zero_copy_only=False))
    return table.column("channel").to_pylist(), table.column("b").to_pylist(), rows


def lagged_products(later: DataFrame, early: DataFrame, low: int, high: int, same: bool = False, block: int = BLOCK, deal: int = DEAL) -> DataFrame:
    """(run, roi, channel, lag, s): sums over frames of later(frame + lag) * early(frame).

    ``same``: a channel meets only itself. A deal has about ``deal`` channels of ``later``,
    fewer where their sums would be too many for a task.
    """
    sizes = later.groupBy("run").agg(F.count_distinct("channel").alias("rois"), F.max("frame").alias("end")).agg(F.max("rois"), F.max("end")).first()
    if not sizes[0]:
        return later.sparkSession.createDataFrame([], "run string, roi string, channel string, lag long, s double")
    # a block is no longer than the recordings; both sides are cut alike
    block = max(1, min(block, sizes[1] + 1))
    partners = 1 if same else early.agg(F.count_distinct("channel")).first()[0]
    per = max(1, min(deal, SUMS // max(1, partners * (high - low + 1))))
    deals = -(-sizes[0] // per)
    dealt = F.pmod(F.xxhash64("channel"), F.lit(deals))
    a = _blocks(later, block).withColumn("deal", dealt)
    near = F.sequence(F.col("b") + low // block, F.col("b") + high // block + 1)
    b = _blocks(early, block).withColumn("to", F.explode(near))
    b = b.withColumn("deal", dealt if same else F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(deals - 1).cast("bigint"))))

    def tile(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[str, list] = {"run": [], "roi": [], "channel": [], "first": [], "s": []}
        if left.num_rows and right.num_rows:
            rois, (here, *_), x = _matrix(left, block)
            names, at, y = _matrix(right, block)
            for there in sorted(set(at)):
                which = [i for i, k in enumerate(at) if k == there]
                off = (here - there) * block  # a lag of the blocks' own frames is so much less
                first, last = max(low, off - block + 1), min(high, off + block - 1)
                if first > last:
                    continue
                if same:
                    order = {names[i]: i for i in which}
                    met = [i for i, roi in enumerate(rois) if roi in order]
                    sums = products(x[met], y[[order[rois[i]] for i in met]], first - off, last - off, True)
                    pairs = [(rois[i], rois[i]) for i in met]
                else:
                    sums = products(x, y[which], first - off, last - off).reshape(-1, last - first + 1)
                    pairs = [(roi, names[i]) for roi in rois for i in which]
                found["run"] += [key[0].as_py()] * len(pairs)
                found["roi"] += [p[0] for p in pairs]
                found["channel"] += [p[1] for p in pairs]
                found["first"] += [first] * len(pairs)
                found["s"] += list(sums)
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.float64()))
        return pa.table({n: pa.array(v, k) for (n, v), k in zip(found.items(), kinds, strict=True)})

    # new columns on both sides, which may be one table
    names = ["run", "to", "deal", "channel", "b", "f", "x"]
    left, right = (d.select(*names).toDF(*names).groupBy("run", "to", "deal") for d in (a.withColumn("to", F.col("b")), b))
    sums = left.cogroup(right).applyInArrow(tile, "run string, roi string, channel string, first long, s array<double>")
    each = sums.select("run", "roi", "channel", "first", F.posexplode("s").alias("k", "s"))
    return each.groupBy("run", "roi", "channel", (F.col("first") + F.col("k")).alias("lag")).agg(F.sum("s").alias("s"))


def autocorrelation(df: DataFrame, lags: int, block: int = BLOCK) -> DataFrame:
    """(run, channel, lag, r) for lags 0 to ``lags``, about the whole mean and over the sum at lag 0."""
    mean = df.groupBy(*KEYS).agg(F.avg("v").alias("_m"))
    centred = df.join(mean, list(KEYS)).select(*KEYS, "frame", (F.col("v") - F.col("_m")).alias("v"))
    sums = lagged_products(centred, centred, 0, lags, True, block)
    base = F.max(F.when(F.col("lag") == 0, F.col("s"))).over(Window.partitionBy("run", "roi"))
    return sums.select("run", F.col("roi").alias("channel"), "lag", F.coalesce(F.try_divide(F.col("s"), base), F.lit(0.0)).alias("r"))


def _standard(df: DataFrame) -> DataFrame:
    """z-scores; 0 for a constant trace."""
    of = df.groupBy(*KEYS).agg(F.avg("v").alias("_m"), F.stddev_pop("v").alias("_s"))
    return df.join(of, list(KEYS)).select(*KEYS, "frame", F.coalesce(F.try_divide(F.col("v") - F.col("_m"), F.col("_s")), F.lit(0.0)).alias("v"))


def cross_correlation(neural: DataFrame, behaviour: DataFrame, lags: int, first: int | None = None, block: int = BLOCK) -> DataFrame:
    """(run, roi, channel, lag, r): sum of z(neural at t + lag) z(behaviour at t), over all frames T.

    A positive lag means that the neural trace follows. Lags from ``first`` (default
    -lags) to ``lags``; all are divided by T, so large lags shrink.
    """
    n = neural.groupBy("run").agg((F.max("frame") + 1).alias("_t"))
    sums = lagged_products(_standard(neural), _standard(behaviour), -lags if first is None else first, lags, False, block)
    return sums.join(n, "run").select("run", "roi", "channel", "lag", (F.col("s") / F.col("_t")).alias("r"))


def shift_null(neural: DataFrame, behaviour: DataFrame, least: int, most: int) -> DataFrame:
    """The same at lags from ``least`` to T - ``least``, positive only: what chance gives. ``most`` is T - ``least`` - 1."""
    return cross_correlation(neural, behaviour, most, first=least)


def null_band(null: DataFrame) -> DataFrame:
    """(run, channel, band): 95th percentile of |mean over ROIs| of the null."""
    mean = null.groupBy("run", "channel", "lag").agg(F.avg("r").alias("r"))
    return mean.groupBy("run", "channel").agg(F.percentile(F.abs("r"), F.lit(0.95)).alias("band"))


def peak_lag(cc: DataFrame) -> DataFrame:
    """(run, channel, lag, strength): the lag at which mean |r| over ROIs is largest; first of equals."""
    mean = cc.groupBy("run", "channel", "lag").agg(F.avg(F.abs("r")).alias("strength"))
    w = Window.partitionBy("run", "channel").orderBy(F.desc("strength"), "lag")
    return mean.withColumn("_i", F.row_number().over(w)).filter("_i = 1").drop("_i")


def effective_n(neural: DataFrame, behaviour: DataFrame, lags: int) -> DataFrame:
    """(run, roi, channel, t, n_eff, floor): Bartlett's correction, summed up to the first lag at which either autocorrelation isn't positive.

    ``floor`` is two standard errors, 2 / sqrt(max(n_eff - 3, 1)). A ROI and a channel meet
    as one row, with their autocorrelations as arrays.
    """
    n = neural.groupBy("run", F.col("channel").cast("string").alias("roi")).agg((F.max("frame") + 1).alias("t"))

    def arrays(df: DataFrame, name: str, out: str) -> DataFrame:
        r = autocorrelation(df, lags).filter("lag > 0")
        points = F.array_sort(F.collect_list(F.struct("lag", "r")))
        return r.groupBy("run", F.col("channel").alias(name)).agg(F.transform(points, lambda p: p["r"]).alias(out))

    def step(acc: Column, pair: Column) -> Column:
        on = acc["on"] & (pair["ra"] > 0) & (pair["rb"] > 0)
        return F.struct((acc["s"] + F.when(on, pair["ra"] * pair["rb"]).otherwise(0.0)).alias("s"), on.alias("on"))

    both = arrays(neural, "roi", "ra").join(arrays(behaviour, "channel", "rb"), "run")
    start = F.struct(F.lit(0.0).alias("s"), F.lit(True).alias("on"))
    s = F.aggregate(F.arrays_zip("ra", "rb"), start, lambda acc, pair: step(acc, pair), lambda acc: acc["s"])
    out = both.select("run", "roi", "channel", s.alias("s")).join(n, ["run", "roi"]).withColumn("n_eff", F.col("t") / F.greatest(1 + 2 * F.col("s"), F.lit(1.0)))
    return out.select("run", "roi", "channel", "t", "n_eff", (2 / F.sqrt(F.greatest(F.col("n_eff") - 3, F.lit(1.0)))).alias("floor"))


def lag_zero(neural: DataFrame, behaviour: DataFrame) -> DataFrame:
    """(run, roi, channel, r) of frames that both have."""
    d = neural.select("run", F.col("channel").alias("roi"), "frame", F.col("v").alias("d"))
    return d.join(behaviour.select(*KEYS, "frame", "v"), ["run", "frame"]).groupBy("run", "roi", "channel").agg(X.safe_corr(F.col("d"), F.col("v")).alias("r"))


def gate(*checks: DataFrame) -> DataFrame:
    """(run, ok, passed, failed, not_applicable) from tables of (run, check, ok); a null ok doesn't count."""
    rows = checks[0]
    for c in checks[1:]:
        rows = rows.unionByName(c)
    return rows.groupBy("run").agg(
        F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"),
        F.count_if("ok").alias("passed"),
        F.array_sort(F.collect_list(F.when(~F.col("ok"), F.col("check")))).alias("failed"),
        F.count_if(F.col("ok").isNull()).alias("not_applicable"),
    )


def structural_checks(bundle: DataFrame, clock: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """(run, check, ok) of an aligned table and its clock (run, frame, t).

    Channels have every frame; t starts at 0 and grows; all values are finite; ROI
channels (``roi_`` prefix) aren't z-scored already. With ``names`` (run, channel), a
    run's channels are those and no others.
    """
    n = clock.groupBy("run").agg(F.count("*").alias("_n"), F.min("t").alias("_t0"))
    steps = clock.withColumn("_d", F.col("t") - F.lag("t").over(Window.partitionBy("run").orderBy("frame"))).groupBy("run").agg(F.coalesce(F.min("_d") > 0, F.lit(True)).alias("_up"))
    each = bundle.groupBy("run", "channel").agg(F.count("*").alias("_c"), F.count_if(~X.finite(F.col("v"))).alias("_bad"), F.avg("v").alias("_m"), F.stddev_pop("v").alias("_s"))
    z = F.col("channel").startswith("roi_")
    whole = each.join(n, "run").groupBy("run").agg(
        F.bool_and(F.col("_c") == F.col("_n")).alias("lengths"),
        F.first(F.col("_t0") == 0).alias("starts_at_zero"),
        (F.sum("_bad") == 0).alias("finite"),
        (~((F.max(F.when(z, F.abs("_m"))) < 1e-6) & (F.max(F.when(z, F.abs(F.col("_s") - 1))) < 1e-3))).alias("raw_dff"),
    )
    checks = ["lengths", "starts_at_zero", "finite", "raw_dff", "increasing"]
    rows = whole.join(steps.withColumnRenamed("_up", "increasing"), "run")
    if names is not None:
        both = each.select("run", "channel", F.lit(1).alias("_a")).join(names.select("run", "channel", F.lit(1).alias("_b")).distinct(), ["run", "channel"], "full")
        rows = rows.join(both.groupBy("run").agg(F.bool_and(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("names")), "run")
        checks.append("names")
    return rows.select("run", F.explode(F.array(*[F.struct(F.lit(x).alias("check"), F.col(x).alias("ok")) for x in checks])).alias("c")).select("run", "c.*")


def passing(df: DataFrame, gates: DataFrame) -> DataFrame:
    """Rows of runs whose gate is open."""
    return df.join(gates.filter("ok").select("run"), "run", "left_semi")
