"""Two clocks on one axis: clock maps, coverage, interpolation, and the checks of an aligned table.

The neural clock is measured or counted, the camera's is mapped to it by one or two
anchor frames. Traces are interpolated at neural times and never extrapolated.

Cases: a null anchor or rate, or an anchor outside its recording, raises; times
outside a trace get no row; equal times take the trace's own value, bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions import expressions as X
from tracelake.operators import scans
from tracelake.operators.scans import BLOCK
from tracelake.operators.sequence import KEYS

#: Seconds in a block of two clocks.
SECONDS = 3600.0


def neural_clock(frames: DataFrame, measured: DataFrame | None = None) -> DataFrame:
    """(run, frame, t, period) from (run, n, fps): measured times from 0 where a run has n of them, else frame / fps."""
    # runs are dealt before their frames are told, so that joins by run don't move frames
    counted = frames.select("run", "n", "fps").repartition("run").withColumn("frame", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    if measured is None:
        return counted.select("run", "frame", (F.col("frame") / F.col("fps")).alias("t"), (1 / F.col("fps")).alias("period"))
    w = Window.partitionBy("run").orderBy("frame")
    steps = measured.withColumn("_d", F.col("t") - F.lag("t").over(w))
    good = steps.groupBy("run").agg(F.count("*").alias("_m"), F.percentile("_d", F.lit(0.5)).alias("_p"), F.min("t").alias("_t0"))
    own = counted.join(good, "run", "left").join(measured.withColumnRenamed("t", "_t"), ["run", "frame"], "left")
    fits = F.coalesce(F.col("_m") == F.col("n"), F.lit(False))
    return own.select("run", "frame", F.when(fits, F.col("_t") - F.col("_t0")).otherwise(F.col("frame") / F.col("fps")).alias("t"), F.when(fits, F.col("_p")).otherwise(1 / F.col("fps")).alias("period"))


def camera_clock(runs: DataFrame) -> DataFrame:
    """Adds ``dt`` and ``coverage_end`` to (run, on, off, n_cam, cam_fps, t_last, period).

    With a camera rate the map has one anchor, else the recording spans both. Wrong
    anchors raise.
    """
    good = F.coalesce((F.lit(0) <= F.col("on")) & (F.col("on") < F.col("off")) & (F.col("off") <= F.col("n_cam") - 1), F.lit(False))
    span = F.when(good, F.col("off") - F.col("on")).otherwise(F.raise_error(F.concat(F.lit("anchors must satisfy 0 <= on < off <= last camera frame: "), F.col("run").cast("string"))).cast("int"))
    dt = F.coalesce(1 / F.col("cam_fps"), (F.col("t_last") + F.col("period")) / span)
    return runs.withColumn("dt", dt).withColumn("coverage_end", span * F.col("dt"))


def camera_time(frame: Column, on: Column, dt: Column) -> Column:
    return (frame - on) * dt


def covered(clock: DataFrame, camera: DataFrame, least: int = 2, many: bool = False) -> DataFrame:
    """Neural frames that the camera covers; a run with fewer than ``least`` raises.

    With ``many`` runs their rows are hashed where ``neural_clock`` has dealt them. Else it is
    Spark that chooses, by a guess that leaves out how many frames a run has: a broadcast
    of many runs, or of their frames, is more than the driver holds.
    """
    one = (lambda runs: runs.hint("shuffle_hash")) if many else (lambda runs: runs)
    kept = clock.join(one(camera.select("run", "coverage_end")), "run").filter(F.col("t") <= F.col("coverage_end"))
    n = kept.groupBy("run").agg(F.count("*").alias("_n"))
    enough = F.when(F.col("_n") >= least, F.lit(True)).otherwise(F.raise_error(F.lit("too few frames are covered")).cast("boolean"))
    return kept.join(one(n.filter(enough).select("run")), "run")


def interpolate(traces: DataFrame, grid: DataFrame, seconds: float = SECONDS) -> DataFrame:
    """(run, channel, frame, t, v): each channel of (run, channel, t, v) at the times of (run, frame, t).

    Both clocks are put in one order within blocks of ``seconds``; a block that has no
    sample on a side gets the nearest from the blocks there.
    """
    wanted = traces.select(*KEYS).distinct().join(grid.select("run", "frame", "t"), "run")
    both = traces.select(*KEYS, "t", "v", F.lit(None).cast("bigint").alias("frame")).unionByName(wanted.select(*KEYS, "t", F.lit(None).cast("double").alias("v"), F.col("frame").cast("bigint")))
    rows = scans.dealt(both.withColumn("_g", F.col("frame").isNotNull()), KEYS, scans.block_of("t", seconds))
    sample = F.when(~F.col("_g") & F.col("v").isNotNull(), F.struct("t", "v"))
    # at one time samples come first, either way
    near = scans.scan(rows, KEYS, ["t", "_g"], {"p": (scans.LAST, sample), "n": (scans.NEXT, sample)}, back=["t", "_g"])
    near = near.filter("_g and p is not null and n is not null")
    line = F.try_divide(F.col("n.v") - F.col("p.v"), F.col("n.t") - F.col("p.t")) * (F.col("t") - F.col("p.t")) + F.col("p.v")
    return near.select(*KEYS, "frame", "t", F.when(F.col("n.t") == F.col("p.t"), F.col("p.v")).otherwise(line).alias("v"))


def edge_artifacts(clock: DataFrame, camera: DataFrame) -> DataFrame:
    """Adds ``artifact``: frames within one camera period of either end."""
    last = clock.groupBy("run").agg(F.max("t").alias("_last")).join(camera.select("run", "dt"), "run")
    return clock.join(last, "run").withColumn("artifact", (F.col("t") < F.col("dt")) | (F.col("t") > F.col("_last") - F.col("dt"))).drop("dt", "_last")


def nearest_camera_frame(t: Column, on: Column, dt: Column) -> Column:
    return F.bround(t / dt).cast("bigint") + on


def coincident(bundle: DataFrame, traces: DataFrame, on: int, ratio: int) -> DataFrame:
    """(run, channel, n, differing): bundle frames k = ratio * j against camera frames on + j, which must be equal."""
    k = bundle.filter(F.col("frame") % ratio == 0).withColumn("f", on + F.expr(f"frame div {ratio}"))
    met = k.alias("b").join(traces.alias("t"), (F.col("b.run") == F.col("t.run")) & (F.col("b.channel") == F.col("t.channel")) & (F.col("b.f") == F.col("t.frame")))
    return met.groupBy("b.run", "b.channel").agg(F.count("*").alias("n"), F.count_if(~F.col("b.v").eqNullSafe(F.col("t.v"))).alias("differing"))


def blend_errors(bundle: DataFrame, traces: DataFrame, camera: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """(run, channel, n, wrong): each value against (1 - r) of the camera frame before and r of the one after."""
    at = F.col("t") / F.col("dt") + F.col("on")
    asked = bundle.join(camera.select("run", "on", "dt"), "run").withColumn("_f", F.floor(at)).withColumn("_r", at - F.col("_f"))
    a = traces.select(*KEYS, F.col("frame").alias("_f"), F.col("v").alias("_a"))
    b = traces.select(*KEYS, (F.col("frame") - 1).alias("_f"), F.col("v").alias("_b"))
    met = asked.join(a, [*KEYS, "_f"]).join(b, [*KEYS, "_f"])
    off = F.abs((1 - F.col("_r")) * F.col("_a") + F.col("_r") * F.col("_b") - F.col("v"))
    return met.groupBy(*KEYS).agg(F.count("*").alias("n"), F.count_if(off > tolerance * F.greatest(F.lit(1.0), F.abs("v"))).alias("wrong"))


def shift_curve(neural: DataFrame, traces: DataFrame, on: int, dt: float, shifts: list[float]) -> DataFrame:
    """(run, channel, shift, strength): mean |r| of neural channels with a trace re-interpolated at shifted anchors."""
    from tracelake.operators.sequence import zscore

    z = zscore(neural.select(*KEYS, "frame", "v")).withColumnRenamed("channel", "roi").withColumnRenamed("v", "z")
    clock = neural.select("run", "frame", "t").distinct()
    timed = traces.select(*KEYS, X.time_of(F.col("frame") - on, F.lit(dt)).alias("t"), "v")
    out = None
    for s in shifts:
        moved = interpolate(timed, clock.select("run", "frame", (F.col("t") + s).alias("t")))
        r = z.join(moved.select(*KEYS, "frame", "v"), ["run", "frame"]).groupBy(*KEYS, "roi").agg(F.abs(X.safe_corr(F.col("z"), F.col("v"))).alias("r"))
        part = r.groupBy(*KEYS).agg(F.avg("r").alias("strength")).withColumn("shift", F.lit(float(s)))
        out = part if out is None else out.unionByName(part)
    return out


def status(runs: DataFrame, **tables: DataFrame) -> DataFrame:
    """(run, has_<name> for each table): which outputs a run has."""
    for name, table in tables.items():
        mark = table.select("run").distinct().withColumn(f"_{name}", F.lit(True))
        runs = runs.join(mark, "run", "left").withColumn(f"has_{name}", F.coalesce(f"_{name}", F.lit(False))).drop(f"_{name}")
    return runs


def unfinished(runs: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Runs without output, or all of them."""
    return runs if force else runs.join(done.select("run").distinct(), "run", "left_anti")


def positioned(correlations: DataFrame, rois: DataFrame) -> DataFrame:
    """Correlations with their ROI's centre; a run whose numbers of ROIs differ is left out."""
    a = correlations.groupBy("run").agg(F.count_distinct("roi").alias("_a"))
    b = rois.groupBy("run").agg(F.count_distinct("roi").alias("_b"))
    same = a.join(b, "run").filter("_a = _b").select("run")
    return correlations.join(same, "run", "left_semi").join(rois.select("run", "roi", "cx", "cy"), ["run", "roi"])


def global_frame(parts: DataFrame) -> DataFrame:
    """Adds ``first`` to (run, part, n): the number of a part's first frame in its run."""
    w = Window.partitionBy("run").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("first", F.coalesce(F.sum("n").over(w), F.lit(0)))


def locate(frames: DataFrame, parts: DataFrame, block: int = BLOCK) -> DataFrame:
    """(run, frame, part, page) of global frame numbers: the last part that begins at or before a frame, by blocks of frames."""
    both = frames.select("run", "frame", F.lit(None).cast("string").alias("part"), F.lit(1).alias("o")).unionByName(global_frame(parts).filter("n > 0").select("run", F.col("first").alias("frame"), F.col("part").cast("string").alias("part"), F.lit(0).alias("o")))
    rows = scans.dealt(both, ["run"], scans.block_of("frame", block))
    found = scans.scan(rows, ["run"], ["frame", "o"], {"at": (scans.LAST, F.when(F.col("o") == 0, F.struct("part", F.col("frame").alias("first"))))})
    return found.filter("o = 1").select("run", "frame", F.col("at.part").alias("part"), (F.col("frame") - F.col("at.first")).alias("page"))
