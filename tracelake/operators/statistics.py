"""Aggregates over traces and tables: levels, regressions, distributions, rankings.

Percentiles are exact with linear interpolation; those of whole traces come from counts
dealt by ranges (``selection``). Ratios with a zero divisor are null,
correlations with a constant side are 0. Null values are left out of every aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions import expressions as X
from tracelake.operators.scans import BLOCK
from tracelake.operators.selection import average_ranks, quantiles, value_counts
from tracelake.operators.sequence import KEYS, differences
from tracelake.sources.shared import stored


def percentiles(df: DataFrame, points: dict[str, float]) -> DataFrame:
    """(run, channel, a column for each point)."""
    return quantiles(df, KEYS, F.col("v"), points)


def robust_spread(df: DataFrame) -> DataFrame:
    """(run, channel, median, sd): 1.4826 times the median distance from the median."""
    median = stored(quantiles(df, KEYS, F.col("v"), {"median": 0.5}), "medians")
    off = quantiles(df.join(median, list(KEYS)), [*KEYS, "median"], F.abs(F.col("v") - F.col("median")), {"sd": 0.5})
    return off.withColumn("sd", 1.4826 * F.col("sd"))


def inventory(df: DataFrame) -> DataFrame:
    """(run, channel, n, least, median, most, mean, sd, nans)."""
    fine = F.when(~F.isnan("v"), F.col("v"))
    return df.groupBy(*KEYS).agg(
        F.count("*").alias("n"), F.min(fine).alias("least"), F.percentile(fine, F.lit(0.5)).alias("median"), F.max(fine).alias("most"),
        F.avg(fine).alias("mean"), F.stddev_pop(fine).alias("sd"), F.count_if(F.isnan("v")).alias("nans"),
    )


def occupancy(df: DataFrame, state: Column) -> DataFrame:
    return df.groupBy(*KEYS).agg(F.avg(state.cast("double")).alias("duty"))


def line_fit(df: DataFrame, y: str = "v", x: str = "frame", by: tuple[str, ...] = KEYS) -> DataFrame:
    """(.., slope, intercept) by least squares."""
    return df.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def bleaching(df: DataFrame, fps: float, limit: float = 20.0) -> DataFrame:
    """(run, percent, flagged): drift over a recording of the mean over channels, from a line through medians of seconds."""
    mean = df.groupBy("run", "frame").agg(F.avg("v").alias("v"))
    second = F.floor(F.col("frame") / fps)
    medians = mean.groupBy("run", second.alias("t")).agg(F.percentile("v", F.lit(0.5)).alias("m"))
    fit = medians.groupBy("run").agg(F.regr_slope("m", "t").alias("slope"), (F.max("t") - F.min("t")).alias("span"), F.avg("m").alias("mean"))
    percent = F.try_divide(100 * F.col("slope") * F.col("span"), F.col("mean"))
    return fit.select("run", percent.alias("percent"), (F.abs(percent) > limit).alias("flagged"))


def histogram(df: DataFrame, low: float, high: float, bins: int, density: bool = False) -> DataFrame:
    """(run, channel, bin, n[, density]) over equal bins; the last one is closed, what lies outside is left out."""
    width = (high - low) / bins
    cell = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1))
    out = df.filter(F.col("v").between(low, high)).groupBy(*KEYS, cell.alias("bin")).agg(F.count("*").alias("n"))
    if density:
        out = out.withColumn("density", F.col("n") / (F.sum("n").over(Window.partitionBy(*KEYS)) * width))
    return out


def size_bins(df: DataFrame, size: str, edges: list[float]) -> DataFrame:
    """(low, high, n): sizes in [low, high], the last bin open above; a size on an edge counts in both."""
    spans = list(zip(edges, [*edges[1:], None], strict=True))
    tags = F.array(*[F.when((F.col(size) >= a) & (F.col(size) <= b if b is not None else F.lit(True)), F.struct(F.lit(float(a)).alias("low"), F.lit(None if b is None else float(b)).cast("double").alias("high"))) for a, b in spans])
    return df.select(F.explode(F.filter(tags, lambda x: x.isNotNull())).alias("b")).groupBy("b.low", "b.high").agg(F.count("*").alias("n"))


def co_occurrence(df: DataFrame, a: Column, b: Column, by: tuple[str, ...] = ("run",)) -> DataFrame:
    """(.., joint, chance, enrichment) of two states of a row."""
    p, q, both = F.avg(a.cast("double")), F.avg(b.cast("double")), F.avg((a & b).cast("double"))
    return df.groupBy(*by).agg(both.alias("joint"), (p * q).alias("chance"), F.try_divide(both, p * q).alias("enrichment"))


def saturation(df: DataFrame, x: str, y: str, bins: int, least: int = 5, by: tuple[str, ...] = ("run",)) -> DataFrame:
    """(.., bin, mean, n): mean of y in quantile bins of x with more than ``least`` rows; the last bin is closed."""
    edges = quantiles(df, by, F.col(x), {f"e{i}": i / bins for i in range(bins + 1)}).select(*by, F.array(*[f"e{i}" for i in range(bins + 1)]).alias("_e"))
    inside = F.expr(f"least(size(filter(_e, e -> e <= `{x}`)) - 1, {bins - 1})")
    rows = df.join(edges, list(by)).withColumn("bin", inside)
    return rows.groupBy(*by, "bin").agg(F.avg(y).alias("mean"), F.count("*").alias("n")).filter(F.col("n") > least)


def spearman(df: DataFrame, a: str, b: str, by: tuple[str, ...] = ("run",)) -> DataFrame:
    ranked = average_ranks(average_ranks(df, a, "_a", by), b, "_b", by)
    return ranked.groupBy(*by).agg(X.safe_corr(F.col("_a"), F.col("_b")).alias("rho"))


def fraction_above(df: DataFrame, value: str, floor: Column, by: tuple[str, ...]) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((F.abs(F.col(value)) > floor).cast("double")).alias("fraction"))


def frame_rate(stamps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (run, frame, t): (run, rate, kept, gaps) and the gaps (run, frame, dt).

    Steps over 1.5 times the upper median of all steps are gaps; the rate is one over
    the mean of the others.
    """
    timed = stamps.select("run", F.lit(0).alias("channel"), "frame", F.col("t").alias("v"))
    steps = stored(differences(timed, BLOCK).filter("v is not null").select("run", "frame", F.col("v").alias("dt")), "steps")
    middle = F.expr("before <= of div 2 and of div 2 < before + n")
    median = value_counts(steps, ["run"], F.col("dt"), "median").filter(middle).select("run", "median")
    marked = steps.join(median, "run").withColumn("gap", F.col("dt") > 1.5 * F.col("median"))
    rate = marked.groupBy("run").agg(F.try_divide(F.lit(1.0), F.avg(F.when(~F.col("gap"), F.col("dt")))).alias("rate"), F.count_if(~F.col("gap")).alias("kept"), F.count_if("gap").alias("gaps"))
    return rate, marked.filter("gap").select("run", "frame", "dt")


def varying_tags(tags: DataFrame) -> DataFrame:
    """(run, tag, values) of the keys of a map column ``tags`` that have more than one value."""
    flat = tags.select("run", F.explode("tags").alias("tag", "value"))
    return flat.groupBy("run", "tag").agg(F.count_distinct("value").alias("values")).filter("values > 1")


def conditional_medians(df: DataFrame, when: Column, by: tuple[str, ...] = KEYS) -> DataFrame:
    """(.., on, off, ratio): medians of v where ``when`` holds and elsewhere; a group without values of either kind has no row."""
    each = quantiles(df.withColumn("_on", when).filter("_on is not null"), [*by, "_on"], F.col("v"), {"_m": 0.5})
    on, off = F.max(F.when(F.col("_on"), F.col("_m"))), F.max(F.when(~F.col("_on"), F.col("_m")))
    return each.groupBy(*by).agg(on.alias("on"), off.alias("off"), F.try_divide(on, off).alias("ratio"))


def channel_correlations(df: DataFrame) -> DataFrame:
    """(run, a, b, r) of the logarithms of each pair of a run's channels."""
    logs = df.select("run", "channel", "frame", X.log_energy(F.col("v")).alias("v"))
    other = logs.select("run", F.col("channel").alias("b"), "frame", F.col("v").alias("w"))
    pairs = logs.withColumnRenamed("channel", "a").join(other, ["run", "frame"]).filter("a < b")
    return pairs.groupBy("run", "a", "b").agg(X.safe_corr(F.col("v"), F.col("w")).alias("r"))


# order and choice


def peak_order(df: DataFrame) -> DataFrame:
    """(run, channel, peak, position): channels by the first frame of their maximum."""
    top = df.groupBy(*KEYS).agg(F.max_by("frame", F.struct("v", (-F.col("frame")).alias("f"))).alias("peak"))
    return top.withColumn("position", F.row_number().over(Window.partitionBy("run").orderBy("peak", "channel")).cast("bigint"))


def best_and_worst(df: DataFrame, n: int = 3) -> DataFrame:
    """(run, channel, amplitude, best, worst): places from either end by maximum less median; both within ``n``."""
    amp = percentiles(df, {"_top": 1.0, "_median": 0.5}).select(*KEYS, (F.col("_top") - F.col("_median")).alias("amplitude"))
    w = Window.partitionBy("run")
    ranked = amp.withColumns({"best": F.row_number().over(w.orderBy(F.desc("amplitude"), "channel")).cast("bigint"), "worst": F.row_number().over(w.orderBy("amplitude", "channel")).cast("bigint")})
    return ranked.filter((F.col("best") <= n) | (F.col("worst") <= n))


def first_argmax(df: DataFrame, value: str, order: tuple[str, ...], by: tuple[str, ...]) -> DataFrame:
    """The row with the largest value; of equals, the first in ``order``."""
    w = Window.partitionBy(*by).orderBy(F.desc(value), *order)
    return df.withColumn("_i", F.row_number().over(w)).filter("_i = 1").drop("_i")


def ordered_components(means: Column, others: list[Column]) -> Column:
    """An array of structs sorted by the first of their fields, the means."""
    return F.array_sort(F.arrays_zip(means, *others))


# sets


def stacked(*blocks: tuple[str, DataFrame]) -> DataFrame:
    """Trace tables under one another; channels get the block's prefix."""
    out = None
    for prefix, block in blocks:
        part = block.select("run", F.concat(F.lit(prefix), F.col("channel").cast("string")).alias("channel"), "frame", "v")
        out = part if out is None else out.unionByName(part)
    return out


def common_channels(df: DataFrame) -> DataFrame:
    """Channels that every run has."""
    runs = df.select("run").distinct().agg(F.count("*").alias("_n"))
    return df.groupBy("channel").agg(F.count_distinct("run").alias("_r")).join(F.broadcast(runs), F.col("_r") == F.col("_n")).select("channel")  # runs: one row


def channel_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("channel").subtract(b.select("channel"))


def first_of_each(df: DataFrame, key: str, position: str) -> DataFrame:
    """Distinct keys at their first position."""
    return df.groupBy(key).agg(F.min(position).alias(position))


def union_of_columns(*tables: DataFrame) -> DataFrame:
    """Rows of all tables under the union of their columns; what a table lacks is null."""
    out = tables[0].select("*")
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
