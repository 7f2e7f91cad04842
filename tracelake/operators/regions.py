"""Growing regions by tiles: covariances of a tile's pixels, tentative regions, and a pass that lets those stand that nothing can change.

Growing needs of the movie only how pixels vary together. Each tile, with a halo around it,
sums the products of its pixels over time, block by block; that is the last time that
anyone sees the movie. Seeds come in falling order of the map, the first in rows of equals,
and a region that is found takes its pixels from all later ones, so the order matters only
where regions meet. Every tile therefore grows the seeds of its core by itself, in their
order, and notes the pixels it looked at. A pass in the order of all seeds then keeps a
region unless another tile's earlier region took a pixel that it looked at, or an earlier
one that didn't stand might yet. Tiles with regions that didn't stand try again, against
what stands. The result is that of one loop over the whole image, for any tiles.

A region that runs beyond its tile's halo takes back what came after it, and halos double.

The pass holds a run's regions and no traces: pixels of an image, whatever its frames.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.sources.shared import stored

#: Pixels of a tile's side and of the halo around it, and frames of a block of time.
TILE, HALO, BLOCK = 32, 8, 256


def _view(k: int, n: int, tile: int, halo: int) -> tuple[int, int]:
    """First and end of a tile's pixels with its halo along an axis of ``n``."""
    return max(0, k * tile - halo), min(n, (k + 1) * tile + halo)


def covariances(frames: DataFrame, tile: int = TILE, halo: int = HALO) -> DataFrame:
    """(run, ty, tx, h, w, cov): covariances of a tile's pixels with its halo, in rows, float64; from (run, frame, h, w, pixels).

    Null pixels count as zero. A pixel that never changes has none with any other, exactly,
    as products are of differences to the first frame that a tile sees.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK).to_pandas()
                for (run, h, w), rows in part.groupby(["run", "h", "w"], dropna=False, sort=False):
                    a = np.stack([np.nan_to_num(np.asarray(x, np.float64)) if None not in x else np.array([v or 0.0 for v in x]) for x in rows["pixels"]]).reshape(len(rows), h, w)
                    for ty in range(-(-h // tile)):
                        y0, y1 = _view(ty, h, tile, halo)
                        pieces = []
                        for tx in range(-(-w // tile)):
                            x0, x1 = _view(tx, w, tile, halo)
                            pieces.append((run, ty, tx, h, w, len(rows), a[:, y0:y1, x0:x1].tobytes()))
                        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pieces], k) for i, k in enumerate(kinds)], names)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None

        def done() -> pa.RecordBatch:
            n, _, total, products = held
            cov = products / n - np.outer(total / n, total / n)
            row = [[*key, cov.tobytes()][i] for i in range(6)]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, [*kinds[:5], pa.large_binary()], strict=True)], [*names[:5], "cov"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = [batch.column(c)[i].as_py() for c in range(batch.num_columns)]
                a = np.frombuffer(row[6]).reshape(row[5], -1)
                if key != tuple(row[:5]):
                    if key is not None:
                        yield done()
                    key, held = tuple(row[:5]), [0, a[0], np.zeros(a.shape[1]), np.zeros((a.shape[1], a.shape[1]))]
                z = a - held[1]
                held[0] += len(z)
                held[2] += z.sum(0)
                held[3] += z.T @ z
        if key is not None:
            yield done()

    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    names = ["run", "ty", "tx", "h", "w", "n", "data"]
    source = frames.select(F.col("run").cast("string").alias("run"), F.col("h").cast("int").alias("h"), F.col("w").cast("int").alias("w"), F.col("pixels").cast("array<double>").alias("pixels"))
    pieces = source.mapInArrow(cut, "run string, ty int, tx int, h int, w int, n int, data binary").repartition("run", "ty", "tx").sortWithinPartitions("run", "ty", "tx")
    return pieces.mapInArrow(summed, "run string, ty int, tx int, h int, w int, cov binary")


class _Tile:
    """A tile's pixels with its halo, as flat arrays, and what it knows of them."""

    def __init__(self, cov: np.ndarray, box: tuple[int, int, int, int], size: tuple[int, int]):
        self.y0, self.y1, self.x0, self.x1 = box
        self.h, self.w = self.y1 - self.y0, self.x1 - self.x0
        self.size = size
        self.cov, self.variance = cov, cov.diagonal()

    def around(self, mask: np.ndarray) -> np.ndarray:
        near = np.zeros_like(mask)
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                near[max(0, dy) : self.h + min(0, dy), max(0, dx) : self.w + min(0, dx)] |= mask[max(0, -dy) : self.h + min(0, -dy), max(0, -dx) : self.w + min(0, -dx)]
        return near & ~mask

    def at_edge(self, mask: np.ndarray) -> bool:
        """Whether a neighbour lies beyond what the tile sees, in the image."""
        return bool((self.y0 > 0 and mask[0].any()) or (self.x0 > 0 and mask[:, 0].any()) or (self.y1 < self.size[0] and mask[-1].any()) or (self.x1 < self.size[1] and mask[:, -1].any()))

    def grow(self, seed: tuple[int, int], free: np.ndarray, threshold: float, cap: int, seed_size: int) -> tuple[np.ndarray, np.ndarray] | None:
        """The region and the pixels that were looked at; None where it leaves the tile's sight."""
        mask = np.zeros((self.h, self.w), bool)
        r = seed_size // 2
        y, x = seed
        if (y - r < 0 and self.y0 > 0) or (x - r < 0 and self.x0 > 0) or (y + r >= self.h and self.y1 < self.size[0]) or (x + r >= self.w and self.x1 < self.size[1]):
            return None
        mask[max(0, y - r) : y + r + 1, max(0, x - r) : x + r + 1] = True
        seen = mask.copy()
        new = mask
        with_region, within = np.zeros(self.h * self.w), 0.0  # sums of covariances with the region, and in it
        while mask.sum() < cap:
            if self.at_edge(mask):
                return None
            added = np.flatnonzero(new)
            gain = self.cov[added].sum(0)
            with_region = with_region + gain
            within = with_region[mask.ravel()].sum()
            near = self.around(mask)
            seen |= near
            ring = np.flatnonzero((near & free).ravel())
            if not len(ring):
                break
            n = mask.sum()
            scale = np.sqrt(np.maximum(within / (n * n), 0.0) * np.maximum(self.variance[ring], 0.0))
            r_ = np.divide(with_region[ring] / n, scale, out=np.zeros(len(ring)), where=scale > 0)
            take = ring[r_ > threshold]
            if not len(take):
                break
            new = np.zeros((self.h, self.w), bool)
            new.ravel()[take] = True
            mask = mask | new
        return mask, seen


def _tried(tile: _Tile, core: np.ndarray, c: np.ndarray, taken: np.ndarray, level: float, cap: int, attempts: int | None, seed_size: int) -> Iterator[tuple[float, int, int, np.ndarray | None, np.ndarray | None]]:
    """Seeds of the core in their order, with what grows from them; ends with one that leaves the tile's sight."""
    free = (c != 0) & ~taken
    order = np.argsort(-np.where(core & free, c, -np.inf), axis=None, kind="stable")[: int((core & free).sum())]
    count = 0
    for at in order.tolist():
        y, x = divmod(at, tile.w)
        if not free[y, x]:
            continue
        if count == attempts or (attempts is None and not c[y, x] > level):
            return
        found = tile.grow((y, x), free, level, cap, seed_size)
        count += 1
        if found is None:
            yield float(c[y, x]), y + tile.y0, x + tile.x0, None, None
            return
        free &= ~found[0]
        yield float(c[y, x]), y + tile.y0, x + tile.x0, found[0], found[1]


def _standing(tried: list[tuple], cores: dict[tuple[int, int], tuple[int, int, int, int]], size: tuple[int, int]) -> tuple[list[tuple], set, tuple | None]:
    """The pass over tentative regions (r, y, x, tile, pixels, seen): those that stand, tiles to try again, and a seed that left its tile's sight.

    ``cores``: for each tile the rectangle in which its regions can lie.
    """
    writer = np.full(size[0] * size[1], -1, np.int64)
    number = {t: i for i, t in enumerate(cores)}
    stands, again = [], set()
    for row in sorted(tried, key=lambda t: (-t[0], t[1], t[2])):
        _, _, _, tile, pixels, seen = row
        blocked = tile in again
        if not blocked and seen is not None:
            ys, xs = seen // size[1], seen % size[1]
            box = ys.min(), ys.max() + 1, xs.min(), xs.max() + 1
            blocked = any(box[0] < b[1] and b[0] < box[1] and box[2] < b[3] and b[2] < box[3] for b in (cores[t] for t in again))
            by = writer[seen]
            blocked |= bool(((by >= 0) & (by != number[tile])).any())
        elif not blocked:
            # it may be no seed at all, if another tile's region took it or still might
            at = row[1] * size[1] + row[2]
            blocked = (writer[at] >= 0 and writer[at] != number[tile]) or any(b[0] <= row[1] < b[1] and b[2] <= row[2] < b[3] for b in (cores[t] for t in again))
            if not blocked:
                return stands, again, row[:3]
        if blocked:
            again.add(tile)
        else:
            writer[pixels] = number[tile]
            stands.append(row)
    return stands, again, None


def attempted(frames: DataFrame, cmap: DataFrame, threshold: Column | float, cap: int, attempts: int | None = 100, seed_size: int = 1, by: tuple[str, ...] = (), tile: int = TILE, halo: int = HALO) -> DataFrame:
    """(run, columns ``by`` of the map, attempt, size, pixels: array of y, x) of every seed that is tried, in order.

    ``attempts`` seeds are tried; None goes on while a free pixel of the map is above the
    threshold. A region stops growing at ``cap`` pixels. Pixels whose map value is 0 or null
    join none. Maps that ``by`` tells apart share their run's covariances.
    """
    keys = ["run", *by]
    level = (threshold if isinstance(threshold, Column) else F.lit(float(threshold))).cast("double")
    kinds = {f.name: f.dataType.simpleString() for f in cmap.schema.fields}
    image = stored(cmap.select(F.col("run").cast("string").alias("run"), *by, F.col("y").cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.coalesce(F.col("r").cast("double"), F.lit(0.0)).alias("r"), level.alias("level")), "map")
    named = "run string, " + "".join(f"`{b}` {kinds[b]}, " for b in by)
    region = named + "r double, y int, x int, pixels array<int>"
    spark = frames.sparkSession
    stands = spark.createDataFrame([], region)
    w_of = stored(frames.select(F.col("run").cast("string").alias("run"), F.col("h").cast("int").alias("h"), F.col("w").cast("int").alias("w")).distinct(), "sizes")
    places = stored(image.select(*keys, F.expr(f"y div {tile}").cast("int").alias("ty"), F.expr(f"x div {tile}").cast("int").alias("tx")).distinct(), "places")
    open_tiles = places
    frames = frames.select("run", "frame", "h", "w", "pixels")
    cov = None
    while True:
        if cov is None:
            cov = stored(covariances(frames, tile, halo), "covariances")
        tried = stored(_tentative(cov, image, stands, open_tiles, w_of, keys, named, cap, attempts, seed_size, tile, halo), "tried")
        result = stored(_passed(tried, stands, w_of, keys, named, attempts, tile, halo), "passed")
        stands = result.where("kind = 'stands'").select(*keys, "r", "y", "x", "pixels")
        open_tiles = result.where("kind = 'again'").select(*keys, F.col("y").alias("ty"), F.col("x").alias("tx"))
        if result.where("kind = 'beyond'").limit(1).count():
            # whatever may have been taken back is tried again, in runs where that happened
            halo, cov = 2 * halo, None
            wide = result.where("kind = 'beyond'").select(*keys).distinct()
            open_tiles = open_tiles.unionByName(places.join(wide, keys, "left_semi")).distinct()
        elif not open_tiles.limit(1).count():
            break
    order = Window.partitionBy(*keys).orderBy(F.desc("r"), "y", "x")
    out = stands.join(w_of.select("run", "w"), "run").withColumn("attempt", F.row_number().over(order).cast("bigint"))
    if attempts is not None:
        out = out.where(F.col("attempt") <= attempts)
    pixels = F.transform("pixels", lambda i: F.struct(F.floor(i / F.col("w")).cast("bigint").alias("y"), (i % F.col("w")).cast("bigint").alias("x")))
    return out.select(*keys, "attempt", F.size("pixels").cast("bigint").alias("size"), pixels.alias("pixels"))


def _tentative(cov: DataFrame, image: DataFrame, stands: DataFrame, open_tiles: DataFrame, sizes: DataFrame, keys: list[str], named: str, cap: int, attempts: int | None, seed_size: int, tile: int, halo: int) -> DataFrame:
    """What each open tile grows: (keys, ty, tx, r, y, x, pixels, seen); pixels are null where a region leaves the tile's sight."""
    by = keys[1:]

    def near(c: str) -> Column:
        return F.explode(F.sequence(F.floor((F.col(c) - halo) / tile).cast("int"), F.floor((F.col(c) + halo) / tile).cast("int")))

    gone = stands.join(sizes.select("run", "w"), "run").select(*keys, "w", F.explode("pixels").alias("i")).select(*keys, F.expr("cast(i div w as int)").alias("y"), F.expr("cast(i % w as int)").alias("x"), F.lit(True).alias("taken")).distinct()
    known = image.join(gone, [*keys, "y", "x"], "left").withColumn("taken", F.coalesce("taken", F.lit(False)))
    dealt = known.withColumn("ty", near("y")).withColumn("tx", near("x")).join(open_tiles, [*keys, "ty", "tx"], "left_semi")

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(left) and len(right):
            one = left.iloc[0]
            h, w = int(one["h"]), int(one["w"])
            (y0, y1), (x0, x1) = _view(one["ty"], h, tile, halo), _view(one["tx"], w, tile, halo)
            n = (y1 - y0) * (x1 - x0)
            seen_by = _Tile(np.frombuffer(one["cov"]).reshape(n, n), (y0, y1, x0, x1), (h, w))
            core = np.zeros((y1 - y0, x1 - x0), bool)
            core[one["ty"] * tile - y0 : (one["ty"] + 1) * tile - y0, one["tx"] * tile - x0 : (one["tx"] + 1) * tile - x0] = True
            for values, part in right.groupby(by, dropna=False, sort=False) if by else [((), right)]:
                part = part[(part["y"] < y1) & (part["x"] < x1)]
                if not len(part):
                    continue
                c, taken = np.zeros(core.shape), np.zeros(core.shape, bool)
                c[part["y"] - y0, part["x"] - x0] = part["r"]
                taken[part["y"] - y0, part["x"] - x0] = part["taken"]
                for r, y, x, mask, seen in _tried(seen_by, core, c, taken, float(part["level"].iloc[0]), cap, attempts, seed_size):
                    flat = [None if m is None else ((np.nonzero(m)[0] + y0) * w + np.nonzero(m)[1] + x0).astype(np.int32) for m in (mask, seen)]
                    rows.append((key[0], *values, int(one["ty"]), int(one["tx"]), r, y, x, *flat))
        return pd.DataFrame(rows, columns=[*keys, "ty", "tx", "r", "y", "x", "pixels", "seen"])

    some = cov.join(open_tiles.select("run", "ty", "tx").distinct(), ["run", "ty", "tx"], "left_semi")
    return some.groupBy("run", "ty", "tx").cogroup(dealt.groupBy("run", "ty", "tx")).applyInPandas(run, named + "ty int, tx int, r double, y int, x int, pixels array<int>, seen array<int>")


def _passed(tried: DataFrame, stands: DataFrame, sizes: DataFrame, keys: list[str], named: str, attempts: int | None, tile: int, halo: int) -> DataFrame:
    """(keys, kind, r, y, x, pixels): regions that stand, tiles to try ``again`` (y, x are the tile's) and seeds that went ``beyond``."""
    new = tried.join(sizes, "run").select(*keys, "ty", "tx", "r", "y", "x", "pixels", "seen", "h", "w")
    old = stands.select(*keys, "r", "y", "x", "pixels").toDF(*keys, "r", "y", "x", "pixels")

    def run(key: tuple, fresh: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
        done = [(r.r, r.y, r.x, r.pixels) for r in kept.itertuples()]
        rows = []
        if len(fresh):
            h, w = int(fresh["h"].iloc[0]), int(fresh["w"].iloc[0])
            cores = {}
            for ty, tx in {*zip(fresh["ty"], fresh["tx"], strict=True)}:
                (y0, y1), (x0, x1) = _view(ty, h, tile, halo), _view(tx, w, tile, halo)
                cores[ty, tx] = y0, y1, x0, x1
            tried = [(r.r, r.y, r.x, (r.ty, r.tx), r.pixels, r.seen) for r in fresh.itertuples()]
            found, again, beyond = _standing(tried, cores, (h, w))
            done += [(r, y, x, pixels) for r, y, x, _, pixels, _ in found]
            if beyond is not None:
                done = [d for d in done if (-d[0], d[1], d[2]) < (-beyond[0], beyond[1], beyond[2])]
                again = set(cores)
            stood = {(-d[0], d[1], d[2]) for d in done}
            # the first seed that is still open: regions before it can't change
            first = min((p for p in ((-t[0], t[1], t[2]) for t in tried if t[3] in again) if p not in stood), default=None)
            if attempts is not None and first is not None and sum(p < first for p in stood) >= attempts:
                again, beyond = set(), None
            rows += [("again", None, ty, tx, None) for ty, tx in again]
            if beyond is not None:
                rows.append(("beyond", *beyond, None))
        rows += [("stands", *d) for d in done]
        return pd.DataFrame([(*key, *r) for r in rows], columns=[*keys, "kind", "r", "y", "x", "pixels"])

    return new.groupBy(*keys).cogroup(old.groupBy(*keys)).applyInPandas(run, named + "kind string, r double, y int, x int, pixels array<int>")
