"""Movies: box traces, correlation maps, registration, denoising and growing regions.

A movie is either ``pixels`` (run, frame, y, x, v) or ``frames`` (run, frame, h, w,
pixels: array<double> in rows), the latter one row a frame, so that per-frame work stays
in one Arrow batch. Statistics over time are sums that each task makes for its frames
and Spark adds, so no task holds a movie.

Cases: null pixels count as zero in ``frames`` and stay out of means over time; an empty
movie gives empty results; (run, frame, y, x) is distinct; further columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions import expressions as X
from tracelake.operators.lowrank import low_rank
from tracelake.operators.regions import attempted
from tracelake.sources.shared import stored

FRAMES = "run string, frame long, h int, w int, pixels array<double>"


def to_pixels(frames: DataFrame) -> DataFrame:
    flat = frames.select("run", "frame", "w", F.posexplode("pixels").alias("i", "v"))
    return flat.select("run", "frame", F.expr("cast(i div w as int)").alias("y"), F.expr("cast(i % w as int)").alias("x"), "v")


def to_frames(pixels: DataFrame) -> DataFrame:
    size = pixels.groupBy("run").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    rows = pixels.groupBy("run", "frame").agg(F.array_sort(F.collect_list(F.struct("y", "x", "v"))).alias("p"))
    return rows.join(size, "run").select("run", F.col("frame").cast("bigint").alias("frame"), "h", "w", F.col("p.v").cast("array<double>").alias("pixels"))


def grey(r: Column, g: Column, b: Column) -> Column:
    return (r + g + b) / 3


# boxes: (run, box, x0, y0, x1, y1), half-open


def in_boxes(pixels: DataFrame, boxes: DataFrame) -> DataFrame:
    """Pixels of each box; boxes name their pixels, so this is an equi-join."""
    cells = boxes.select("run", "box", F.explode(F.sequence(F.col("y0"), F.col("y1") - 1)).alias("y"), "x0", "x1").select("run", "box", "y", F.explode(F.sequence(F.col("x0"), F.col("x1") - 1)).alias("x"))
    return pixels.join(cells, ["run", "y", "x"])


#: Pixels that a task lays out at once.
HELD_PIXELS = 1 << 21


def _summed(images: np.ndarray) -> np.ndarray:
    """Sums over all rectangles from each image's first pixel, with an edge of zeros."""
    out = np.zeros((len(images), images.shape[1] + 1, images.shape[2] + 1))
    images.cumsum(1, dtype=np.float64).cumsum(2, out=out[:, 1:, 1:])
    return out


def _laid_out(rows: pd.DataFrame, before: tuple | None, corner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values, and which of them are known, of ``before`` (frame, values, known: an image or None) and of each row, in one size that holds ``corner``."""
    n = rows["y"].str.len().to_numpy()
    at, (y, x) = np.repeat(np.arange(1, len(rows) + 1), n), (np.concatenate([*rows[c], np.zeros(0, int)]).astype(int) for c in ("y", "x"))
    v = np.concatenate([*(np.asarray(v, np.float64) for v in rows["v"]), np.zeros(0)])
    h, w = max(corner[0], y.max(initial=-1) + 1), max(corner[1], x.max(initial=-1) + 1)
    if before is not None:
        h, w = max(h, before[1].shape[0]), max(w, before[1].shape[1])
    values, known = np.zeros((len(rows) + 1, h, w)), np.zeros((len(rows) + 1, h, w), bool)
    values[at, y, x], known[at, y, x] = np.nan_to_num(v), ~np.isnan(v)
    if before is not None:
        at = (0, slice(before[1].shape[0]), slice(before[1].shape[1]))
        values[at], known[at] = before[1:]
    return values, known


def _measured(images: DataFrame, boxes: DataFrame, area_level: float, block: int) -> DataFrame:
    """Box traces of (run, frame, y, x, v) with arrays, one row a frame.

    A block of frames goes to one task with the last frame of the block before. The frames'
    values, and the sizes of their differences, are summed over areas once, for as many
    frames together as HELD_PIXELS allow; a box then costs four reads of each sum, whatever
    its size.
    """
    edges = F.flatten(F.transform("b", lambda b: F.array(b["x0"], b["y0"], b["x1"], b["y1"])))
    cut = boxes.groupBy("run").agg(F.collect_list(F.struct("box", "x0", "y0", "x1", "y1")).alias("b")).select("run", F.col("b.box").alias("boxes"), edges.alias("edges"))
    mine = F.expr(f"cast(frame div {block} as bigint)")
    dealt = images.withColumn("mine", mine).withColumn("block", F.explode(F.array_distinct(F.array("mine", F.expr(f"cast((frame + 1) div {block} as bigint)")))))
    dealt = dealt.join(cut, "run").repartition("run", "block").sortWithinPartitions("run", "block", "frame")

    def measured(rows: pd.DataFrame, before: tuple | None) -> tuple[pd.DataFrame, tuple]:
        """Traces of frames of one block, and the last of them."""
        names, edges = rows["boxes"].iloc[0], np.clip(np.stack(rows["edges"].iloc[:1]).reshape(-1, 4), 0, None)
        values, known = _laid_out(rows, before, edges[:, [3, 2]].max(0))
        frame = rows["frame"].to_numpy()
        follows = np.diff(frame, prepend=frame[0] - 2 if before is None else before[0]) == 1
        both = known[1:] & known[:-1] & follows[:, None, None]
        d = np.where(both, np.abs(np.diff(values, axis=0)), 0.0)
        sums = [_summed(s) for s in (known[1:], values[1:], both, d, d * d, d > area_level)]
        own, out = (rows["block"] == rows["mine"]).to_numpy(), []
        for name, (x0, y0, x1, y1) in zip(names, edges, strict=True):
            if y1 <= y0 or x1 <= x0:
                continue
            n, total, pairs, *of = (s[:, y1, x1] - s[:, y0, x1] - s[:, y1, x0] + s[:, y0, x0] for s in sums)
            at = own & (n > 0)
            means = [np.where(pairs > 0, s / np.maximum(pairs, 1), 0.0)[at] for s in of]
            out.append(pd.DataFrame({"run": rows["run"].iloc[0], "box": name, "frame": frame[at], "lum": total[at] / n[at], "me": means[0], "power": means[1], "area": means[2]}))
        return pd.concat(out) if out else None, (frame[-1], values[-1], known[-1])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = before = None
        for part in parts:
            for name, rows in part.groupby(["run", "block"], sort=False):
                if name != key:
                    key, before = name, None
                at = 0
                while at < len(rows):
                    step = max(1, HELD_PIXELS // max(1, len(rows["y"].iloc[at])))
                    traces, before = measured(rows.iloc[at : at + step], before)
                    at += step
                    if traces is not None:
                        yield traces

    return dealt.select("run", "frame", "mine", "block", "y", "x", "v", "boxes", "edges").mapInPandas(run, "run string, box string, frame long, lum double, me double, power double, area double")


#: Frames of a block of a movie.
FRAMES_BLOCK = 128


def box_traces(pixels: DataFrame, boxes: DataFrame, area_level: float = 10.0, block: int = FRAMES_BLOCK) -> DataFrame:
    """(run, box, frame, lum, me, power, area): mean, and mean absolute, squared and large difference to the frame before; 0 where there is none."""
    points = F.collect_list(F.struct(F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.col("v").cast("double").alias("v")))
    images = pixels.groupBy(F.col("run").cast("string").alias("run"), F.col("frame").cast("bigint").alias("frame")).agg(points.alias("p"))
    return _measured(images.select("run", "frame", F.col("p.y").alias("y"), F.col("p.x").alias("x"), F.col("p.v").alias("v")), boxes, area_level, block)


def frame_box_traces(frames: DataFrame, boxes: DataFrame, area_level: float = 10.0, block: int = FRAMES_BLOCK) -> DataFrame:
    """The same from whole frames."""
    places = F.sequence(F.lit(0), F.col("h") * F.col("w") - 1)
    y, x = F.transform(places, lambda i: F.floor(i / F.col("w")).cast("int")), F.transform(places, lambda i: (i % F.col("w")).cast("int"))
    return _measured(frames.select("run", F.col("frame").cast("bigint").alias("frame"), y.alias("y"), x.alias("x"), F.col("pixels").cast("array<double>").alias("v")), boxes, area_level, block)


# images over time


def mean_image(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("run", "y", "x").agg(F.avg("v").alias("v"))


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b.withColumnRenamed("v", "_b"), ["run", "y", "x"]).select("run", "y", "x", (F.col("v") - F.col("_b")).alias("v"))


def bin_frames(pixels: DataFrame, n: int) -> DataFrame:
    """Means of ``n`` frames; a last bin that isn't full is left out."""
    binned = pixels.groupBy("run", "y", "x", F.expr(f"cast(frame div {n} as bigint)").alias("frame")).agg(F.avg("v").alias("v"), F.count("*").alias("_n"))
    return binned.filter(F.col("_n") == n).select("run", "frame", "y", "x", "v")


def _neighbours(a: np.ndarray) -> np.ndarray:
    p = np.pad(a, 1)
    h, w = a.shape
    return sum(p[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w] for dy in (-1, 0, 1) for dx in (-1, 0, 1) if dy or dx)


def correlation_map(frames: DataFrame) -> DataFrame:
    """(run, y, x, r): correlation of each pixel with the sum of its eight neighbours (zero outside); 0 where one is constant."""
    names = ["sx", "ss", "sxx", "sss", "sxs"]

    def sums(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        for part in parts:
            for r in part.itertuples():
                a = np.array([0 if v is None else v for v in r.pixels], np.float64).reshape(r.h, r.w)
                s = _neighbours(a)
                now = np.stack([a, s, a * a, s * s, a * s]).reshape(5, -1)
                if r.run in held:
                    held[r.run][0] += 1
                    held[r.run][2] += now
                else:
                    held[r.run] = [1, r.w, now]
        for run, (n, w, total) in held.items():
            yield pd.DataFrame({"run": [run], "n": [n], "w": [w], "sums": [total.T.tolist()]})

    parts = frames.mapInPandas(sums, "run string, n long, w int, sums array<array<double>>")
    flat = parts.select("run", "n", "w", F.posexplode("sums").alias("i", "s"))
    total = flat.groupBy("run", "w", "i").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[k]).alias(x) for k, x in enumerate(names)])
    n, sx, ss, sxx, sss, sxs = (F.col(x) for x in ("n", *names))
    var = (n * sxx - sx * sx) * (n * sss - ss * ss)
    r = F.when(var > 0, (n * sxs - sx * ss) / F.sqrt(var)).otherwise(0.0)
    return total.select("run", F.expr("cast(i div w as int)").alias("y"), F.expr("cast(i % w as int)").alias("x"), r.alias("r"))


def zero_border(image: DataFrame, border: DataFrame, value: str = "r") -> DataFrame:
    """``border``: (run, b) pixels at each edge that become 0; so do values that aren't finite."""
    size = image.groupBy("run").agg(F.max("y").alias("_h"), F.max("x").alias("_w"))
    j = image.join(size, "run").join(border, "run")
    out = (F.col("y") < F.col("b")) | (F.col("y") > F.col("_h") - F.col("b")) | (F.col("x") < F.col("b")) | (F.col("x") > F.col("_w") - F.col("b"))
    return j.withColumn(value, F.when(out, 0.0).otherwise(X.zero_if_not_finite(F.col(value)))).select(image.columns)


def border_of(shifts: DataFrame, least: int = 5) -> DataFrame:
    """(run, b) from (run, frame, dy, dx): the largest shift and one more pixel."""
    return shifts.groupBy("run").agg(F.greatest(F.lit(least), F.ceil(F.max(F.greatest(F.abs("dy"), F.abs("dx")))) + 1).cast("int").alias("b"))


def threshold_window(cmap: DataFrame, mean: DataFrame) -> DataFrame:
    """(run, low, high, suggestion): p99 of the map where the image is dim (below its median), p25 where it is bright (above p99), and the greater; null where they overlap."""
    cuts = mean.groupBy("run").agg(F.percentile("v", F.lit(0.5)).alias("dim"), F.percentile("v", F.lit(0.99)).alias("bright"))
    both = cmap.join(mean, ["run", "y", "x"]).join(cuts, "run")
    low = F.percentile(F.when(F.col("v") < F.col("dim"), F.col("r")), F.lit(0.99))
    high = F.percentile(F.when(F.col("v") > F.col("bright"), F.col("r")), F.lit(0.25))
    return both.groupBy("run").agg(low.alias("low"), high.alias("high"), F.when(low < high, high).alias("suggestion"))


def contrast_gap(cmap: DataFrame, mean: DataFrame) -> DataFrame:
    """(run, gap): median of the map where the image is bright less that where it is dim."""
    cuts = mean.groupBy("run").agg(F.percentile("v", F.lit(0.5)).alias("dim"), F.percentile("v", F.lit(0.99)).alias("bright"))
    both = cmap.join(mean, ["run", "y", "x"]).join(cuts, "run")
    bright, dim = (F.percentile(F.when(c, F.col("r")), F.lit(0.5)) for c in (F.col("v") > F.col("bright"), F.col("v") < F.col("dim")))
    return both.groupBy("run").agg((bright - dim).alias("gap"))


def keep_denoised(plain: DataFrame, denoised: DataFrame, margin: float = 0.02) -> DataFrame:
    """(run, keep) from two tables of ``contrast_gap``."""
    return denoised.join(plain.withColumnRenamed("gap", "_p"), "run").select("run", (F.col("gap") > F.col("_p") + margin).alias("keep"))


def centre_crop(pixels: DataFrame, side: int = 128) -> DataFrame:
    """The middle ``side`` by ``side`` pixels of each run's images (all of smaller ones), renumbered from 0."""
    size = pixels.groupBy("run").agg((F.max("y") + 1).alias("_h"), (F.max("x") + 1).alias("_w"))
    low = {c: F.greatest(F.lit(0), F.floor((F.col(n) - side) / 2)).cast("int") for c, n in (("y", "_h"), ("x", "_w"))}
    cut = pixels.join(size, "run").withColumns({"_y": F.col("y") - low["y"], "_x": F.col("x") - low["x"]})
    return cut.filter(F.col("_y").between(0, side - 1) & F.col("_x").between(0, side - 1)).select("run", "frame", F.col("_y").alias("y"), F.col("_x").alias("x"), "v")


def denoised_or_not(pixels: DataFrame, rank: int, side: int = 128, margin: float = 0.02) -> DataFrame:
    """(run, keep): whether a rank's approximation separates bright from dim pixels better, judged on a centre crop."""
    plain = centre_crop(pixels, side)
    gaps = [contrast_gap(correlation_map(to_frames(x)), mean_image(x)) for x in (plain, low_rank(plain, rank))]
    return keep_denoised(*gaps, margin)


def bin_sweep(pixels: DataFrame, bins: tuple[int, ...], side: int = 128) -> DataFrame:
    """(run, bin, median, p95) of the centre crop's correlation map for means over each number of frames."""
    crop, out = centre_crop(pixels, side), None
    for n in bins:
        part = correlation_map(to_frames(bin_frames(crop, n))).groupBy("run").agg(F.lit(n).alias("bin"), F.percentile("r", F.lit(0.5)).alias("median"), F.percentile("r", F.lit(0.95)).alias("p95"))
        out = part if out is None else out.unionByName(part)
    return out


def prepared(frames: DataFrame, stage: str, rank: int) -> DataFrame:
    """Registered frames, with the rank's approximation made ``pre`` or ``post`` registration, or not at all (``off``)."""
    if stage not in ("off", "pre", "post"):
        raise ValueError(f"no such stage: {stage}")
    if stage == "pre":
        frames = to_frames(low_rank(to_pixels(frames), rank))
    moved = register(frames)[0]
    return to_frames(low_rank(to_pixels(moved), rank)) if stage == "post" else moved


def extraction_audit(cmap: DataFrame, mean: DataFrame, roi_pixels: DataFrame, near: float = 0.08) -> DataFrame:
    """(run, claimed, unclaimed, cells_missed): bright pixels in and out of ROIs; medians within ``near`` mean that cells were missed."""
    cut = mean.groupBy("run").agg(F.percentile("v", F.lit(0.99)).alias("_c"))
    used = roi_pixels.select("run", "y", "x").distinct().withColumn("_u", F.lit(True))
    rows = cmap.join(mean, ["run", "y", "x"]).join(cut, "run").filter("v > _c").join(used, ["run", "y", "x"], "left")
    a, b = F.percentile(F.when(F.col("_u"), F.col("r")), F.lit(0.5)), F.percentile(F.when(F.col("_u").isNull(), F.col("r")), F.lit(0.5))
    return rows.groupBy("run").agg(F.count_if("_u").alias("claimed"), F.count_if(F.col("_u").isNull()).alias("unclaimed"), F.coalesce(F.abs(a - b) < near, F.lit(False)).alias("cells_missed"))


# registration


def _spline_coefficients(a: np.ndarray, axis: int) -> np.ndarray:
    """Cubic B-spline coefficients along an axis, mirrored at the ends."""
    c = np.moveaxis(np.array(a, np.float64), axis, 0)
    n, z = len(c), np.sqrt(3.0) - 2
    if n < 2:
        return np.moveaxis(c, 0, axis)
    c = c * 6
    m = min(n, 30)
    head = sum(c[k] * z**k for k in range(m))
    c[0] = head
    for k in range(1, n):
        c[k] += z * c[k - 1]
    c[-1] = z / (z * z - 1) * (c[-1] + z * c[-2])
    for k in range(n - 2, -1, -1):
        c[k] = z * (c[k + 1] - c[k])
    return np.moveaxis(c, 0, axis)


def shift_image(a: np.ndarray, dy: float, dx: float) -> np.ndarray:
    """Move an image by a fraction of pixels with a cubic spline; zero where nothing moves in."""
    for axis, d in ((0, dy), (1, dx)):
        n = a.shape[axis]
        c = np.moveaxis(_spline_coefficients(a, axis), axis, 0)
        at = np.arange(n) - d
        base = np.floor(at).astype(int)
        f = at - base
        weights = ((1 - f) ** 3 / 6, 2 / 3 - f**2 + f**3 / 2, 2 / 3 - (1 - f) ** 2 + (1 - f) ** 3 / 2, f**3 / 6)
        out = 0.0
        for k, w in enumerate(weights):
            i = np.abs(base - 1 + k) % max(1, 2 * (n - 1))
            i = np.where(i > n - 1, 2 * (n - 1) - i, i)
            out = out + w.reshape(-1, *[1] * (c.ndim - 1)) * c[i]
        out[(at < 0) | (at > n - 1)] = 0
        a = np.moveaxis(out, 0, axis)
    return a


def estimate_shift(template_fft: np.ndarray, image: np.ndarray, upsample: int = 10) -> tuple[float, float]:
    """(dy, dx) that move ``image`` onto the template, to 1/upsample pixels.

    The peak of the plain cross-correlation is refined by a matrix-multiply DFT around
    it (Guizar-Sicairos et al., 2008).
    """
    h, w = image.shape
    product = template_fft * np.conj(np.fft.fft2(image))
    peak = np.unravel_index(np.argmax(np.abs(np.fft.ifft2(product))), (h, w))
    coarse = [p - n if p > n // 2 else p for p, n in zip(peak, (h, w), strict=True)]
    if upsample == 1:
        return float(coarse[0]), float(coarse[1])
    near = int(np.ceil(1.5 * upsample))
    offsets = [np.round(c * upsample) / upsample + (np.arange(near) - near // 2) / upsample for c in coarse]
    rows = np.exp(2j * np.pi * offsets[0][:, None] * np.fft.fftfreq(h)[None, :])
    columns = np.exp(2j * np.pi * np.fft.fftfreq(w)[:, None] * offsets[1][None, :])
    i, j = np.unravel_index(np.argmax(np.abs(rows @ product @ columns)), (near, near))
    return float(offsets[0][i]), float(offsets[1][j])


def _smooth(a: np.ndarray, sigma: float) -> np.ndarray:
    if not sigma:
        return a
    f = [np.exp(-2 * (np.pi * sigma * np.fft.fftfreq(n)) ** 2) for n in a.shape]
    return np.fft.ifft2(np.fft.fft2(a) * f[0][:, None] * f[1][None, :]).real


#: Frames that share a copy of their template.
SHIFT_BLOCK = 256


def estimate_shifts(frames: DataFrame, templates: DataFrame, upsample: int = 10, smooth: float = 0.0) -> DataFrame:
    """(run, frame, dy, dx) against (run, template: array<double>), one image a run.

    Frames meet their template by blocks, each of which gets a copy, so that a run is no
    task of its own; where copies are few, Spark sends them to the frames instead.
    """
    block = F.expr(f"cast(frame div {SHIFT_BLOCK} as bigint)")
    frames = frames.withColumn("_block", block)
    copies = stored(frames.select("run", "_block").distinct().join(templates, "run"), "templates")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows, ready = [], {}
            for r in part.itertuples():
                if r.run not in ready:
                    ready = {r.run: np.fft.fft2(_smooth(np.asarray(r.template, np.float64).reshape(r.h, r.w), smooth))}
                image = _smooth(np.asarray(r.pixels, np.float64).reshape(r.h, r.w), smooth)
                rows.append((r.run, r.frame, *estimate_shift(ready[r.run], image, upsample)))
            yield pd.DataFrame(rows, columns=["run", "frame", "dy", "dx"])

    return frames.join(copies, ["run", "_block"]).mapInPandas(run, "run string, frame long, dy double, dx double")


def apply_shifts(frames: DataFrame, shifts: DataFrame) -> DataFrame:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            moved = [shift_image(np.asarray(r.pixels, np.float64).reshape(r.h, r.w), r.dy, r.dx).ravel().tolist() for r in part.itertuples()]
            yield part[["run", "frame", "h", "w"]].assign(pixels=moved)

    return frames.join(shifts.select("run", "frame", "dy", "dx"), ["run", "frame"]).mapInPandas(run, FRAMES)


def template_of(frames: DataFrame) -> DataFrame:
    """(run, template): the mean over frames, summed in tasks."""
    mean = mean_image(to_pixels(frames))
    return mean.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("y", "x", "v")))["v"].alias("template"))


def register(frames: DataFrame, upsample: int = 10, smooth: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """(moved frames, shifts): rigid registration in two passes.

    Shifts to the mean image give a sharper mean, shifts of the raw frames to that are
    applied once. ``shifts`` has ``pass`` 1 and 2; both are written to the shared folder as
    soon as they are found.
    """
    first = stored(estimate_shifts(frames, template_of(frames), upsample, smooth), "shifts")
    second = stored(estimate_shifts(frames, template_of(apply_shifts(frames, first)), upsample, smooth), "shifts")
    return apply_shifts(frames, second), first.withColumn("pass", F.lit(1)).unionByName(second.withColumn("pass", F.lit(2)))


def shift_table(shifts: DataFrame) -> DataFrame:
    return shifts.withColumn("total", X.total_shift(F.col("dy"), F.col("dx")))


# regions


def regions(movie: DataFrame, cmap: DataFrame, threshold: Column | float, least: int, most: int, attempts: int | None = 100, seed_size: int = 1, cap: int | None = None) -> DataFrame:
    """(run, roi, y, x) from (run, h, w, frame, pixels) and the map; sizes strictly between ``least`` and ``most``.

    A region stops growing at ``cap`` pixels (by default twice ``most``). Pixels whose map
    value is 0, such as the border's, join none. ``threshold`` may be a column of the map.
    Later regions take pixels that they share with earlier ones. Growth is by tiles.
    """
    grown = attempted(movie, cmap, threshold, 2 * most if cap is None else cap, attempts, seed_size)
    good = grown.filter((F.col("size") > least) & (F.col("size") < most))
    numbered = good.select("run", "attempt", F.row_number().over(Window.partitionBy("run").orderBy("attempt")).alias("roi"), "pixels")
    each = numbered.select("run", F.col("roi").cast("bigint").alias("roi"), F.inline("pixels"))
    return each.groupBy("run", "y", "x").agg(F.max("roi").alias("roi")).select("run", "roi", "y", "x")


def roi_table(roi_pixels: DataFrame, um_per_px: float = 1.0) -> DataFrame:
    """(run, roi, npix, cx, cy, diameter_um, merged): ``merged`` is over 1.7 times the run's median area."""
    rois = roi_pixels.groupBy("run", "roi").agg(F.count("*").alias("npix"), F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    median = rois.groupBy("run").agg(F.percentile("npix", F.lit(0.5)).alias("_m"))
    return rois.join(median, "run").withColumns({"diameter_um": X.equal_diameter_um(F.col("npix"), F.lit(float(um_per_px))), "merged": F.col("npix") > 1.7 * F.col("_m")}).drop("_m")


def dense_labels(roi_pixels: DataFrame) -> DataFrame:
    """Labels from 1 without gaps, in their order, so that label k is row k of the traces."""
    kept = roi_pixels.select("run", "roi").distinct().withColumn("_k", F.row_number().over(Window.partitionBy("run").orderBy("roi")))
    return roi_pixels.join(kept, ["run", "roi"]).drop("roi").withColumnRenamed("_k", "roi")


def roi_traces(pixels: DataFrame, roi_pixels: DataFrame, how: str = "sum") -> DataFrame:
    """(run, roi, frame, f)."""
    return pixels.join(roi_pixels.select("run", "roi", "y", "x"), ["run", "y", "x"]).groupBy("run", "roi", "frame").agg((F.sum("v") if how == "sum" else F.avg("v")).alias("f"))


def dff_traces(traces: DataFrame, percentile: float = 0.15, mode: str = "clamped") -> DataFrame:
    """(run, roi, frame, f, f0, dff) over a static baseline: a percentile of the whole trace."""
    base = traces.groupBy("run", "roi").agg(F.percentile("f", F.lit(percentile)).alias("f0"))
    return traces.join(base, ["run", "roi"]).withColumn("dff", X.dff(F.col("f"), F.col("f0"), mode))


def bad_baselines(traces: DataFrame) -> DataFrame:
    return traces.filter("f0 <= 0").select("run", "roi", "f0").distinct()


#: Percentiles of the map that a sweep tries, and the sizes that it counts.
POINTS = (0.80, 0.85, 0.90, 0.93, 0.95, 0.97)
SIZES = ((9, 19), (20, 49), (50, 79), (80, 149), (150, 249), (250, 399), (400, None))


def threshold_sweep(movie: DataFrame, cmap: DataFrame, least: int, most: int, points: tuple[float, ...] = POINTS, cap: int | None = None, seed_size: int = 3) -> DataFrame:
    """(run, point, threshold, attempts, accepted, median_area, at_cap, sizes) of growing at percentiles of each run's positive map.

    All points of a run share its tiles' covariances. ``at_cap`` counts all attempts that
    reached the cap; ``sizes`` counts attempts in SIZES, ends included.
    """
    cap = 2 * most if cap is None else cap
    cuts = cmap.filter("r > 0").groupBy("run").agg(F.percentile("r", F.array(*[F.lit(p) for p in points])).alias("_c"))
    cuts = cuts.select("run", F.inline(F.arrays_zip(F.array(*[F.lit(float(p)) for p in points]).alias("point"), F.transform("_c", lambda c: F.bround(c, 3)).alias("threshold"))))
    tried = attempted(movie, cmap.join(cuts, "run"), F.col("threshold"), cap, None, seed_size, by=("point", "threshold"))
    good = (F.col("size") > least) & (F.col("size") < most)
    counts = [F.count_if((F.col("size") >= a) & (F.col("size") <= b if b is not None else F.lit(True))).alias(f"s{i}") for i, (a, b) in enumerate(SIZES)]
    swept = tried.groupBy("run", "point", "threshold").agg(
        F.count("*").alias("attempts"), F.count_if(good).alias("accepted"), F.coalesce(F.percentile(F.when(good, F.col("size")), F.lit(0.5)), F.lit(0.0)).alias("median_area"),
        F.count_if(F.col("size") >= cap).alias("at_cap"), *counts,
    )
    return swept.select("run", "point", "threshold", "attempts", "accepted", "median_area", "at_cap", F.array(*[f"s{i}" for i in range(len(SIZES))]).alias("sizes"))
