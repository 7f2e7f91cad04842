"""Validation: what refuses a run, what only marks it, and counts that say why.

``require`` turns rows that break a rule into an error when the result is read; the
other functions return what they find.

Cases: a rule that is null for a row is broken; null values aren't finite; repeated rows
count each time, repeated boxes are reported; an empty table has no problems and no runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions import expressions as X
from tracelake.operators.sequence import KEYS

# Fixed values of the file format: the names that a box may have.
BOXES = ("laser_trigger", "whisker_pad", "paw", "paw_at_nose", "eye", "nose", "wheel")


def require(df: DataFrame, rule: Column, message: str) -> DataFrame:
    """The same rows; reading one that breaks ``rule`` (or for which it is null) raises."""
    return df.filter(F.when(F.coalesce(rule, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def complete_runs(frames: DataFrame, expected: DataFrame, refuse: bool = True) -> DataFrame:
    """(run, n, expected, ok): frames found against (run, expected); ``refuse`` makes a difference an error."""
    found = frames.groupBy("run").agg(F.count_distinct("frame").alias("n"))
    both = expected.join(found, "run", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint"))).withColumn("ok", F.col("n") == F.col("expected"))
    return require(both, F.col("ok"), "the number of frames isn't what the metadata say") if refuse else both


def rate_checks(runs: DataFrame, limit_percent: float = 1.0) -> DataFrame:
    """(run, rate_ok, count_ok) from (run, fps, measured_fps, n, clock_n): rates may differ by the limit, counts not; null is unknown."""
    off = X.rate_error_percent(F.col("measured_fps"), F.col("fps"))
    return runs.select("run", (off <= limit_percent).alias("rate_ok"), (F.col("n") == F.col("clock_n")).alias("count_ok"))


def contained(grid: DataFrame, traces: DataFrame) -> DataFrame:
    """(run, ok): whether all grid times lie in the span of the trace times."""
    g = grid.groupBy("run").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    t = traces.groupBy("run").agg(F.min("t").alias("c"), F.max("t").alias("d"))
    return g.join(t, "run").select("run", ((F.col("a") >= F.col("c")) & (F.col("b") <= F.col("d"))).alias("ok"))


def not_finite(df: DataFrame) -> DataFrame:
    """(run, channel, n) of values that are null, NaN or infinite; none if all is well."""
    return df.filter(~X.finite(F.col("v"))).groupBy(*KEYS).agg(F.count("*").alias("n"))


def size_gate(rois: DataFrame, least: int, most: int) -> DataFrame:
    """Strictly between the bounds."""
    return rois.filter((F.col("npix") > least) & (F.col("npix") < most))


def box_problems(boxes: DataFrame, names: tuple[str, ...] = BOXES) -> DataFrame:
    """(run, level, problem, box): duplicates are errors; unknown and missing names and equal rectangles are warnings."""
    each = boxes.select("run", "box")
    known = boxes.select("run").distinct().withColumn("box", F.explode(F.array(*[F.lit(n) for n in names])))
    doubled = each.groupBy("run", "box").count().filter("count > 1").select("run", F.lit("error").alias("level"), F.lit("duplicate").alias("problem"), "box")
    unknown = each.distinct().join(known, ["run", "box"], "left_anti").select("run", F.lit("warning"), F.lit("unknown"), "box")
    missing = known.join(each, ["run", "box"], "left_anti").select("run", F.lit("warning"), F.lit("missing"), "box")
    same = boxes.groupBy("run", "x0", "y0", "x1", "y1").agg(F.count_distinct("box").alias("n"), F.array_join(F.array_sort(F.collect_set("box")), ",").alias("box")).filter("n > 1").select("run", F.lit("warning"), F.lit("same rectangle"), "box")
    empty = boxes.filter("x1 <= x0 or y1 <= y0").select("run", F.lit("error"), F.lit("empty"), "box")
    return doubled.union(unknown).union(missing).union(same).union(empty)


def quality_flags(shifts: DataFrame, rois: DataFrame, cmap: DataFrame, stamps: DataFrame, threshold: float, most_shift: float = 10.0, least_rois: int = 10, jitter: float = 0.1) -> DataFrame:
    """(run, large_motion, few_rois, low_correlation, irregular_clock, flagged)."""
    a = shifts.groupBy("run").agg((F.percentile(X.total_shift(F.col("dy"), F.col("dx")), F.lit(0.99)) > most_shift).alias("large_motion"))
    b = rois.groupBy("run").agg(F.count_distinct("roi").alias("_n"))
    c = cmap.groupBy("run").agg((F.max("r") < threshold).alias("low_correlation"))
    d = stamps.withColumn("_d", F.col("t") - F.lag("t").over(Window.partitionBy("run").orderBy("frame"))).groupBy("run").agg((F.stddev_pop("_d") > jitter * F.percentile("_d", F.lit(0.5))).alias("irregular_clock"))
    out = a.join(b, "run", "left").join(c, "run").join(d, "run", "left").withColumn("few_rois", F.coalesce("_n", F.lit(0)) < least_rois).drop("_n")
    flags = ["large_motion", "few_rois", "low_correlation", "irregular_clock"]
    return out.select("run", *flags, F.greatest(*[F.coalesce(F.col(x), F.lit(False)) for x in flags]).alias("flagged"))


def parameter_warnings(runs: DataFrame, sigma_s: float, soma_um: float) -> DataFrame:
    """(run, warnings) from (run, fps, um_per_px): smoothing of under 2 frames, cells of under 5 pixels."""
    notes = [F.when(sigma_s * F.col("fps") < 2, F.lit("the temporal filter spans less than two frames")), F.when(soma_um / F.col("um_per_px") < 5, F.lit("cells are less than five pixels wide"))]
    return runs.select("run", F.filter(F.array(*notes), lambda x: x.isNotNull()).alias("warnings"))


def threshold_checks(cmap: DataFrame, threshold: float) -> DataFrame:
    """(run, too_low, too_high): below the map's 90th percentile, above its maximum."""
    return cmap.groupBy("run").agg((F.lit(threshold) < F.percentile("r", F.lit(0.9))).alias("too_low"), (F.lit(threshold) > F.max("r")).alias("too_high"))


def contiguous_prefix(frames: DataFrame) -> DataFrame:
    """Frames before a run's first unreadable one (``error`` not null) or first gap.

    A frame breaks the prefix if it is unreadable or the one before is missing. Frame
    numbers are distinct; no window spans a run.
    """
    before = frames.select("run", (F.col("frame") + 1).alias("frame"), F.lit(True).alias("_before"))
    broken = frames.join(before, ["run", "frame"], "left").filter(F.col("error").isNotNull() | (F.col("_before").isNull() & (F.col("frame") != 0)))
    stop = broken.groupBy("run").agg(F.min("frame").alias("_s"))
    return frames.join(stop, "run", "left").filter(F.col("_s").isNull() | (F.col("frame") < F.col("_s"))).drop("_s")


def truncations(frames: DataFrame) -> DataFrame:
    """(run, part, at_frame, reason) of each run's first unreadable frame."""
    bad = frames.filter("error is not null").groupBy("run").agg(F.min(F.struct("frame", "part", "error")).alias("b"))
    return bad.select("run", "b.part", F.col("b.frame").alias("at_frame"), F.col("b.error").alias("reason"))


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """(missing, extra): rows that one of two tables has and the other lacks; for reading back what was written."""
    one = a.exceptAll(b).agg(F.count("*").alias("missing"))
    return one.crossJoin(b.exceptAll(a).agg(F.count("*").alias("extra")))  # one row each


def first_failure(outcomes: DataFrame) -> DataFrame:
    """(ok, flagged, failed) counts of (run, status)."""
    return outcomes.groupBy().agg(*[F.count_if(F.col("status") == x).alias(x) for x in ("ok", "flagged", "failed")])
