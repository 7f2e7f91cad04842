"""Operators along a trace: smoothing, repair, runs, bouts, hysteresis, event averages.

A trace table has one row for each run, channel and frame: (run, channel, frame, v).
Frames of a channel are dense from 0. Windows are partitioned by run, channel and block of
frames: with the neighbours that they need where they look a fixed way, with what the
blocks before or after hand on (``scans``) where they don't. No task sorts a whole channel.

Cases: null values stay out of sums; a channel with one frame is its own mean; an empty
table gives an empty result; other columns are dropped unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions import expressions as X
from tracelake.operators import scans
from tracelake.operators.scans import BLOCK
from tracelake.operators.selection import quantiles

KEYS = ("run", "channel")


def along(*more: str) -> Window:
    return Window.partitionBy(*KEYS, *more).orderBy("frame")


def in_blocks(df: DataFrame, before: int, after: int, block: int = BLOCK) -> DataFrame:
    """Deals frames to blocks; adds ``block`` and ``own`` (false for a neighbour that is only looked at)."""
    if max(before, after) >= block:
        raise ValueError("a block must be longer than what it looks at")
    mine = F.expr(f"cast(frame div {block} as bigint)")
    to = F.array_distinct(F.array(mine, F.expr(f"cast((frame + {before}) div {block} as bigint)"), F.expr(f"cast(greatest(frame - {after}, 0) div {block} as bigint)")))
    return df.withColumn("mine", mine).withColumn("block", F.explode(to)).withColumn("own", F.col("block") == F.col("mine")).drop("mine")


def zero_phase_mean(df: DataFrame, width: int, edges: str = "replicate", block: int = BLOCK) -> DataFrame:
    """Centred moving average over ``width`` frames; an even width looks one frame further back.

    ``edges``: ``replicate`` continues the first and last value, ``taper`` counts what
    is missing as zero.
    """
    left, right = width // 2, width - 1 - width // 2
    ends = df.groupBy(*KEYS).agg(F.min_by("v", "frame").alias("first_v"), F.max_by("v", "frame").alias("last_v"), F.max("frame").alias("last_frame"))
    w = along("block").rowsBetween(-left, right)
    rows = in_blocks(df.select(*KEYS, "frame", "v"), left, right, block).withColumn("total", F.sum("v").over(w)).filter("own").join(ends, list(KEYS))
    missing_left = F.greatest(F.lit(0), F.lit(left) - F.col("frame"))
    missing_right = F.greatest(F.lit(0), F.col("frame") + right - F.col("last_frame"))
    total = F.col("total")
    if edges == "replicate":
        total = total + missing_left * F.col("first_v") + missing_right * F.col("last_v")
    return rows.select(*KEYS, "frame", (total / width).alias("v"))


def condition(df: DataFrame, width: int, edges: str = "replicate") -> DataFrame:
    """Logarithm of motion energy, smoothed."""
    return zero_phase_mean(df.withColumn("v", X.log_energy(F.col("v"))), width, edges)


def highpass(df: DataFrame, width: int) -> DataFrame:
    """What is left of a trace after its tapering moving average."""
    low = zero_phase_mean(df, width, "taper").withColumnRenamed("v", "low")
    return df.join(low, [*KEYS, "frame"]).select(*KEYS, "frame", (F.col("v") - F.col("low")).alias("v"))


def gaussian_mean(df: DataFrame, sigma: float, block: int = BLOCK, as_uint16: bool = False) -> DataFrame:
    """Gaussian weights over 4 sigma frames with mirrored ends; an even number of taps looks one frame further ahead."""
    taps = max(2, int(round(4 * sigma)))
    taps += taps % 2
    offsets = range(-(taps // 2) + 1, taps // 2 + 1)
    weights = [2.718281828459045 ** (-0.5 * ((o - 0.5) / sigma) ** 2) for o in offsets]
    total = sum(weights)
    reach = taps // 2
    last = df.groupBy(*KEYS).agg(F.max("frame").alias("last"))
    # frames near an end stand again in its mirror, outside; the block windows then see a longer trace
    rows = df.join(last, list(KEYS)).select(*KEYS, "frame", "v", "last")
    copies = F.array(F.col("frame"), F.when(F.col("frame") < reach, -1 - F.col("frame")), F.when(F.col("frame") > F.col("last") - reach, 2 * F.col("last") + 1 - F.col("frame")))
    rows = rows.select(*KEYS, "v", "last", F.explode(F.filter(F.array_distinct(copies), lambda x: x.isNotNull())).alias("frame"))
    # block numbers need frames from 0 on
    rows = in_blocks(rows.withColumn("frame", F.col("frame") + reach), reach, reach, block)
    near = F.collect_list(F.struct("frame", "v")).over(along("block").rangeBetween(offsets[0], offsets[-1]))
    rows = rows.withColumn("near", near).filter("own").withColumn("frame", F.col("frame") - reach).filter(F.col("frame").between(0, F.col("last")))
    weight = F.array(*[F.lit(w / total) for w in weights])
    at = F.expr(f"frame + {reach} + ({offsets[0]})")
    smooth = F.aggregate(F.col("near"), F.lit(0.0), lambda acc, x: acc + F.coalesce(x["v"] * F.get(weight, (x["frame"] - at).cast("int")), F.lit(0.0)))
    out = rows.select(*KEYS, "frame", smooth.alias("v"))
    return out.withColumn("v", F.floor("v").cast("int")) if as_uint16 else out


def differences(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """v less the frame before; null for the first."""
    rows = in_blocks(df.select(*KEYS, "frame", "v"), 1, 0, block)
    return rows.withColumn("v", F.col("v") - F.lag("v").over(along("block"))).filter("own").select(*KEYS, "frame", "v")


def motion_energy(df: DataFrame) -> DataFrame:
    """Absolute difference to the frame before; 0 for the first."""
    return differences(df).withColumn("v", F.coalesce(F.abs("v"), F.lit(0.0)))


def _with_whole(df: DataFrame, **of: Column) -> DataFrame:
    """Rows with aggregates of their channel, which tasks make of their own rows first."""
    return df.join(df.groupBy(*KEYS).agg(*[c.alias(n) for n, c in of.items()]), list(KEYS))


def zscore(df: DataFrame) -> DataFrame:
    """By the population's standard deviation; 0 for a constant trace."""
    rows = _with_whole(df, _m=F.avg("v"), _s=F.stddev_pop("v"))
    return rows.select(*KEYS, "frame", F.coalesce(F.try_divide(F.col("v") - F.col("_m"), F.col("_s")), F.lit(0.0)).alias("v"))


def unit_range(df: DataFrame) -> DataFrame:
    """Centred and divided by the range (1 for a constant trace), for display."""
    rows = _with_whole(df, _m=F.avg("v"), _s=F.max("v") - F.min("v"))
    return rows.select(*KEYS, "frame", ((F.col("v") - F.col("_m")) / F.when(F.col("_s") == 0, 1.0).otherwise(F.col("_s"))).alias("v"))


def tail_trim(df: DataFrame, frames: int = 3) -> DataFrame:
    """Without the last frames of each run; a run that would lose all keeps all."""
    n = df.groupBy("run").agg((F.max("frame") + 1).alias("_n"))
    return df.join(n, "run").filter(F.col("frame") < F.when(F.col("_n") - frames < 1, F.col("_n")).otherwise(F.col("_n") - frames)).select(df.columns)


def repair(df: DataFrame, on: int | None = None, block: int = BLOCK) -> DataFrame:
    """Frames 0 and ``on``, which have no true difference, take the next frame's value."""
    at = [0] + ([on] if on is not None else [])
    fixed = F.when(F.col("frame").isin(at), F.coalesce(F.lead("v").over(along("block")), F.col("v"))).otherwise(F.col("v"))
    return in_blocks(df.select(*KEYS, "frame", "v"), 0, 1, block).withColumn("v", fixed).filter("own").select(*KEYS, "frame", "v")


def temporal_bins(df: DataFrame, n: int) -> DataFrame:
    """Means of ``n`` frames; the last bin counts only if it is full."""
    binned = df.groupBy(*KEYS, F.expr(f"cast(frame div {n} as bigint)").alias("frame")).agg(F.avg("v").alias("v"), F.count("*").alias("_n"))
    return binned.filter(F.col("_n") == n).drop("_n")


def median3(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """Median of each frame and its neighbours; end frames are left out."""
    w = along("block")
    near = F.array(F.lag("v").over(w), F.col("v"), F.lead("v").over(w))
    rows = in_blocks(df.select(*KEYS, "frame", "v"), 1, 1, block).withColumn("_n", near).filter("own")
    return rows.filter("_n[0] is not null and _n[2] is not null").select(*KEYS, "frame", F.sort_array("_n")[1].alias("v"))


def steepest_edges(df: DataFrame) -> DataFrame:
    """(run, channel, up, down): frames of the largest rise and fall of the median-filtered trace; first of equals."""
    d = differences(median3(df)).filter("v is not null")
    return d.groupBy(*KEYS).agg(F.max_by("frame", F.struct("v", (-F.col("frame")).alias("f"))).alias("up"), F.min_by("frame", F.struct("v", "frame")).alias("down"))


def lag_correlation(df: DataFrame, lags: list[int], block: int = BLOCK) -> DataFrame:
    """(run, channel, lag, r) of a trace with itself ``lag`` frames later, each with its own means."""
    rows = in_blocks(df.select(*KEYS, "frame", "v"), 0, max(lags), max(block, max(lags) + 1))
    later = [F.struct(F.lit(k).alias("lag"), F.lead("v", k).over(along("block")).alias("w")) for k in lags]
    pairs = rows.withColumn("_p", F.array(*later)).filter("own").select(*KEYS, "v", F.inline("_p")).filter("w is not null")
    return pairs.groupBy(*KEYS, "lag").agg(X.safe_corr(F.col("v"), F.col("w")).alias("r"))


def rising_edges(df: DataFrame, hi: Column, block: int = BLOCK) -> DataFrame:
    """(run, channel, edges): how often v passes ``hi`` upwards."""
    rows = in_blocks(df, 1, 0, block).withColumn("_b", F.lag("v").over(along("block"))).filter("own")
    return rows.groupBy(*KEYS).agg(F.count_if((F.col("v") > hi) & (F.col("_b") <= hi)).alias("edges"))


# runs and intervals: (run, channel, onset, offset), ends included


def runs_of(df: DataFrame, state: Column, block: int = BLOCK) -> DataFrame:
    """Maximal runs of frames where ``state`` is true.

    Blocks find their own runs; those that touch a block's end meet their other half,
    two rows a block at most.
    """
    marked = scans.dealt(df.withColumn("_s", F.coalesce(state, F.lit(False))).filter("_s"), KEYS, scans.block_of("frame", block))
    island = F.col("frame") - F.row_number().over(along("block"))
    pieces = marked.withColumn("_i", island).groupBy(*KEYS, "block", "_i").agg(F.min("frame").alias("onset"), F.max("frame").alias("offset"))
    at_end = (F.col("onset") == F.col("block") * block) | (F.col("offset") == (F.col("block") + 1) * block - 1)
    pieces = pieces.withColumn("_end", at_end)
    w = Window.partitionBy(*KEYS).orderBy("onset")
    halves = pieces.filter("_end").withColumn("_far", F.coalesce((F.col("onset") - F.lag("offset").over(w) > 1).cast("int"), F.lit(1))).withColumn("_g", F.sum("_far").over(w))
    whole = halves.groupBy(*KEYS, "_g").agg(F.min("onset").alias("onset"), F.max("offset").alias("offset"))
    return pieces.filter("not _end").select(*KEYS, "onset", "offset").unionByName(whole.select(*KEYS, "onset", "offset"))


def merge_intervals(runs: DataFrame, gap: Column | int, least: Column | int, inclusive: bool = True, block: int = BLOCK) -> DataFrame:
    """Join intervals at most ``gap`` frames apart, then keep those of at least ``least``.

    ``inclusive`` counts the frames between and in an interval; otherwise the plain
    differences of its ends are compared.
    """
    one = 1 if inclusive else 0
    rows = scans.dealt(runs, KEYS, scans.block_of("onset", block))
    near = scans.scan(rows, KEYS, ["onset"], {"_before": (scans.BEFORE, F.col("offset"))})
    far = F.coalesce(F.col("onset") - F.col("_before") - one > gap, F.lit(True))
    groups = scans.scan(near.withColumn("_far", far.cast("int")), KEYS, ["onset"], {"_g": (scans.SUM, F.col("_far"))})
    out = groups.groupBy(*KEYS, "_g").agg(F.min("onset").alias("onset"), F.max("offset").alias("offset")).drop("_g")
    return out.filter(F.col("offset") - F.col("onset") + one >= least)


def _walked(limit: int) -> Column:
    """Where a walk back from a frame ends: after the last low frame before it (``_low``), at most ``limit`` back."""
    return F.greatest(F.col("frame") - limit, F.coalesce(1 + F.col("_low"), F.lit(0)))


def refine_onsets(bouts: DataFrame, df: DataFrame, lo: Column, limit: int = 30, block: int = BLOCK) -> DataFrame:
    """Onsets walk back while the frame before is above ``lo`` (a column of ``df``)."""
    rows = scans.dealt(df, KEYS, scans.block_of("frame", block))
    walked = scans.scan(rows, KEYS, ["frame"], {"_low": (scans.BEFORE, F.when(F.col("v") <= lo, F.col("frame")))})
    walked = walked.select(*KEYS, F.col("frame").alias("onset"), _walked(limit).alias("_to"))
    return bouts.join(walked, [*KEYS, "onset"]).drop("onset").withColumnRenamed("_to", "onset").select(*KEYS, "onset", "offset")


def hysteresis_runs(df: DataFrame, hi: Column, lo: Column, limit: int = 30, block: int = BLOCK) -> DataFrame:
    """On above ``hi``, off below ``lo``: offsets are the first frames below ``lo``; onsets are walked back.

    A frame is one of four maps of the state before: it sets on, sets off, leaves it, or
    (where lo > hi) turns it over. So a state is that of the last frame that set it,
    turned over as often as frames since have. A block, too, is such a map: it tells its
    last set state, its turns, its last low frame, and its first frame off for either state
    before it. A scan over these rows gives each block the state, the low frame and the end
    of the run that it opens; its frames are then done without any other's.
    """
    w = along("block")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    up, down = F.coalesce(F.col("v") > hi, F.lit(False)), F.coalesce(F.col("v") < lo, F.lit(False))
    low = F.when(F.col("v") <= lo, F.col("frame"))
    marks = scans.dealt(df.withColumns({"_up": up, "_down": down, "_l": low}).select(*KEYS, "frame", "_up", "_down", "_l"), KEYS, scans.block_of("frame", block))
    marks = marks.withColumns({"_t": F.sum((F.col("_up") & F.col("_down")).cast("int")).over(so_far), "_low": F.max("_l").over(w.rowsBetween(Window.unboundedPreceding, -1))})
    marks = marks.withColumn("_set", F.last(F.when(F.col("_up") != F.col("_down"), F.struct(F.col("_up").cast("int").alias("on"), F.col("_t").alias("t"))), ignorenulls=True).over(so_far))
    # the state if the block begins off; if it begins on, it is the other one until a frame sets it
    marks = marks.withColumn("_s", (F.coalesce(F.col("_set.on"), F.lit(0)) + F.col("_t") - F.coalesce(F.col("_set.t"), F.lit(0))) % 2)
    free = F.col("_set").isNull()
    other = F.when(free, 1 - F.col("_s")).otherwise(F.col("_s"))
    blocks = marks.groupBy(*KEYS, "block").agg(
        F.max("_l").alias("_l"), F.max("frame").alias("_last"), F.max_by("_t", "frame").alias("_turns"), F.max_by(F.when(~free, F.col("_s")), "frame").alias("_ends"),
        F.min(F.when(F.col("_s") == 0, F.col("frame"))).alias("_off0"), F.min(F.when(other == 0, F.col("frame"))).alias("_off1"),
    )
    along_blocks = Window.partitionBy(*KEYS).orderBy("block")
    before, after = along_blocks.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*KEYS).orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum("_turns").over(along_blocks.rowsBetween(Window.unboundedPreceding, 0))
    blocks = blocks.withColumn("_sum", turns)
    kept = F.last(F.when(F.col("_ends").isNotNull(), F.struct(F.col("_ends").alias("on"), F.col("_sum").alias("t"))), ignorenulls=True).over(before)
    blocks = blocks.withColumns({"_kept": kept, "_from_low": F.max("_l").over(before), "_end": F.max("_last").over(Window.partitionBy(*KEYS))})
    blocks = blocks.withColumn("_from", (F.coalesce(F.col("_kept.on"), F.lit(0)) + F.col("_sum") - F.col("_turns") - F.coalesce(F.col("_kept.t"), F.lit(0))) % 2)
    blocks = blocks.withColumn("_later", F.min(F.when(F.col("_from") == 1, F.col("_off1")).otherwise(F.col("_off0"))).over(after))
    rows = marks.join(blocks.select(*KEYS, "block", "_from", "_from_low", "_later", "_end"), [*KEYS, "block"])
    rows = rows.withColumn("_s", F.when(free & (F.col("_from") == 1), 1 - F.col("_s")).otherwise(F.col("_s")))
    backwards = Window.partitionBy(*KEYS, "block").orderBy(F.desc("frame")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"_b": F.coalesce(F.lag("_s").over(w), "_from"), "_off": F.coalesce(F.min(F.when(F.col("_s") == 0, F.col("frame"))).over(backwards), "_later", "_end"), "_low": F.coalesce("_low", "_from_low")})
    return rows.filter("_s = 1 and _b = 0").select(*KEYS, _walked(limit).alias("onset"), F.col("_off").alias("offset"))


def run_statistics(df: DataFrame, state: Column) -> DataFrame:
    """(run, channel, kind, n, mean, median, longest): lengths of runs and of the gaps that a run ends."""
    marked = df.withColumn("_s", state)
    last = df.groupBy(*KEYS).agg(F.max("frame").alias("_last"))
    on = runs_of(marked, F.col("_s")).withColumn("kind", F.lit("run"))
    off = runs_of(marked, ~F.col("_s")).join(last, list(KEYS)).filter("offset < _last").drop("_last").withColumn("kind", F.lit("gap"))
    length = (F.col("offset") - F.col("onset") + 1).cast("double")
    return on.unionByName(off).groupBy(*KEYS, "kind").agg(F.count("*").alias("n"), F.avg(length).alias("mean"), F.percentile(length, F.lit(0.5)).alias("median"), F.max(length).alias("longest"))


# events and what surrounds them


def spelled(intervals: DataFrame, first: Column | str, last: Column | str) -> DataFrame:
    """A row for each ``frame`` from ``first`` to ``last``, to be joined by merging.

    Spark's guess of the rows' size is that of the intervals, however long they are, and a
    broadcast by that guess would take all frames through the driver.
    """
    return intervals.withColumn("frame", F.explode(F.sequence(first, last))).hint("merge")


def around(events: DataFrame, df: DataFrame, before: int, after: int, same_channel: bool = True) -> DataFrame:
    """Frames of ``df`` within [onset - before, onset + after) of each event: an equi-join on frames, no range join.

    Every event asks for before + after frames, whatever else its channel holds.
    """
    keys = list(KEYS) if same_channel else ["run"]
    return spelled(events, F.col("onset") - before, F.col("onset") + (after - 1)).join(df if same_channel else df.withColumnRenamed("channel", "other"), [*keys, "frame"])


def event_average(events: DataFrame, df: DataFrame, half: int) -> DataFrame:
    """(run, channel, at, mean, sem, n) around events that have all their frames."""
    n = df.groupBy(*KEYS).agg((F.max("frame") + 1).alias("_n"))
    whole = events.join(n, list(KEYS)).filter((F.col("onset") - half >= 0) & (F.col("onset") + half < F.col("_n")))
    rows = around(whole.select(*KEYS, "onset"), df, half, half).withColumn("at", F.col("frame") - F.col("onset"))
    return rows.groupBy(*KEYS, "at").agg(F.avg("v").alias("mean"), (F.stddev_pop("v") / F.sqrt(F.count("v"))).alias("sem"), F.count("v").alias("n"))


def half_rise(average: DataFrame, fps: float) -> DataFrame:
    """(run, channel, base, peak, half_rise_s): first time at which an event average passes halfway from base to peak."""
    t = F.col("at") / fps
    levels = average.groupBy(*KEYS).agg(F.avg(F.when(t < -1, F.col("mean"))).alias("base"), F.max(F.when((t > 0) & (t < 1), F.col("mean"))).alias("peak"))
    passed = average.join(levels, list(KEYS)).filter(F.col("mean") > F.col("base") + 0.5 * (F.col("peak") - F.col("base")))
    return passed.groupBy(*KEYS).agg(F.first("base").alias("base"), F.first("peak").alias("peak"), F.min(t).alias("half_rise_s"))


def busiest_window(events: DataFrame, width: int, hop: int) -> DataFrame:
    """(run, channel, start, n): the window of ``width`` frames, at multiples of ``hop``, with most onsets; first of equals."""
    first = F.greatest(F.lit(0), F.ceil((F.col("onset") - width + 1) / hop)).cast("bigint")
    starts = F.explode(F.sequence(first, F.expr(f"cast(onset div {hop} as bigint)"))).alias("k")
    counted = events.select(*KEYS, starts).groupBy(*KEYS, "k").agg(F.count("*").alias("n"))
    best = counted.groupBy(*KEYS).agg(F.max_by(F.struct("k", "n"), F.struct("n", (-F.col("k")).alias("o"))).alias("b"))
    return best.select(*KEYS, (F.col("b.k") * hop).alias("start"), F.col("b.n").alias("n"))


def next_event(events: DataFrame, positions: DataFrame, block: int = BLOCK) -> DataFrame:
    """(run, channel, frame, previous, next): onsets before and after each position."""
    both = events.select(*KEYS, F.col("onset").alias("frame"), F.col("onset")).unionByName(positions.select(*KEYS, "frame", F.lit(None).cast("bigint").alias("onset")))
    rows = scans.dealt(both.withColumn("_o", F.col("onset").isNotNull()), KEYS, scans.block_of("frame", block))
    # at one frame positions come first, either way: onsets at the position itself count on neither side
    found = scans.scan(rows, KEYS, ["frame", "_o"], {"previous": (scans.BEFORE, F.col("onset")), "next": (scans.AFTER, F.col("onset"))}, back=["frame", "_o"])
    return found.filter("onset is null").select(*KEYS, "frame", "previous", "next")


def spaced_examples(events: DataFrame, n: int, block: int = BLOCK) -> DataFrame:
    """``n`` events of each channel, evenly spaced in their order."""
    rows = scans.dealt(events, KEYS, scans.block_of("onset", block))
    ranked = scans.scan(rows, KEYS, ["onset"], {"_i": (scans.SUM, F.lit(1))}).withColumn("_i", F.col("_i") - 1).drop("block")
    sizes = events.groupBy(*KEYS).agg(F.count("*").alias("_n"))
    picks = F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.floor(k * (F.col("_n") - 1) / max(1, n - 1)))).alias("_i")
    return ranked.join(sizes.select(*KEYS, picks).distinct(), [*KEYS, "_i"]).select(events.columns)


# labels of bouts


def label_bouts(
    bouts: DataFrame,
    env: DataFrame,
    levels: DataFrame,
    fps: float,
    baseline: int,
    coactive: int,
    groom: str | None = None,
    artifact: str | None = None,
    others: tuple[str, ...] = (),
    cross: DataFrame | None = None,
    groom_pct: float = 0.99,
    artifact_pct: float = 0.995,
) -> DataFrame:
    """Bouts with duration, amplitude, baseline_pre, groom, artifact, coactive, isolated, xcheck_frames. None is dropped.

    ``env``: conditioned traces of all channels; ``levels``: (run, channel, base, lo) for
    each. Flags look at fixed frames around the onset: 8 either side for grooming, 2
    before to 2 after for artifacts. A channel that a run lacks flags nothing; without
    any of ``others`` a bout isn't isolated. ``cross``: a second detector's bouts.
    """
    keys = [*KEYS, "onset"]
    lo = levels.select(*KEYS, "base", "lo")
    inside = spelled(bouts, "onset", "offset").join(env, [*KEYS, "frame"]).groupBy(*keys, "offset").agg(F.max("v").alias("_top"))
    out = inside.join(lo, list(KEYS)).withColumns({"duration_s": F.round((F.col("offset") - F.col("onset") + 1) / fps, 3), "amplitude": F.col("_top") - F.col("base")})
    pre = around(bouts.select(*keys), env, baseline, 0).join(lo, list(KEYS)).groupBy(*keys).agg((F.count_if(F.col("v") < F.col("lo")) == baseline).alias("baseline_pre"))
    out = out.join(pre, keys, "left").withColumn("baseline_pre", F.coalesce("baseline_pre", F.lit(False)))
    for name, channel, pct, b, a in (("groom", groom, groom_pct, 8, 8), ("artifact", artifact, artifact_pct, 2, 3)):
        if channel is None:
            out = out.withColumn(name, F.lit(False))
            continue
        source = env.filter(F.col("channel") == channel)
        top = quantiles(source, ["run"], F.col("v"), {"_p": pct})
        hit = around(bouts.select(*keys), source, b, a, same_channel=False).join(top, "run").groupBy(*keys).agg(F.bool_or(F.col("v") > F.col("_p")).alias(name))
        out = out.join(hit, keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    if others:
        source = env.filter(F.col("channel").isin(*others)).join(lo.select(*KEYS, "lo"), list(KEYS)).withColumn("_on", F.col("v") > F.col("lo")).select(*KEYS, "frame", "_on")
        each = around(bouts.select(*keys), source, coactive, coactive + 1, same_channel=False).filter("other <> channel").groupBy(*keys, "other").agg(F.bool_or("_on").alias("_on"))
        co = each.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("other", "_on")))).alias("coactive"), (~F.bool_or("_on")).alias("isolated"))
        out = out.join(co, keys, "left").withColumn("isolated", F.coalesce("isolated", F.lit(False)))
    else:
        out = out.withColumns({"coactive": F.lit(None).cast("map<string,boolean>"), "isolated": F.lit(False)})
    if cross is not None:
        near = next_event(cross, bouts.select(*KEYS, F.col("onset").alias("frame")).distinct())
        same = cross.select(*KEYS, "onset").distinct().withColumn("_same", F.lit(0))
        distance = F.coalesce(F.col("_same"), F.least(F.col("onset") - F.col("previous"), F.col("next") - F.col("onset")), F.lit(-1))
        out = out.join(near.withColumnRenamed("frame", "onset").distinct(), keys, "left").join(same, keys, "left").withColumn("xcheck_frames", distance.cast("bigint")).drop("previous", "next", "_same")
    return out.drop("_top", "base", "lo")


def funnel(labelled: DataFrame) -> DataFrame:
    """(run, channel, bouts, with_baseline_pre, not_grooming, not_artifact, isolated, analysis_set, crosscheck_within_2)."""
    clean = F.col("baseline_pre") & ~F.col("groom") & ~F.col("artifact")
    near = F.col("xcheck_frames").between(0, 2) if "xcheck_frames" in labelled.columns else F.lit(False)
    return labelled.groupBy(*KEYS).agg(
        F.count("*").alias("bouts"),
        F.count_if("baseline_pre").alias("with_baseline_pre"),
        F.count_if(~F.col("groom")).alias("not_grooming"),
        F.count_if(~F.col("artifact")).alias("not_artifact"),
        F.count_if("isolated").alias("isolated"),
        F.count_if(clean).alias("analysis_set"),
        F.count_if(near).alias("crosscheck_within_2"),
    )


def matched(planted: DataFrame, found: DataFrame, tolerance: int = 8) -> DataFrame:
    """(run, channel, planted, found, bias): the nearest found onset within ``tolerance`` of each planted one."""
    asked = spelled(planted.select(*KEYS, F.col("onset").alias("planted")), F.col("planted") - tolerance, F.col("planted") + tolerance)
    hits = asked.join(found.select(*KEYS, F.col("onset").alias("frame"), "onset"), [*KEYS, "frame"]).groupBy(*KEYS, "planted").agg(F.min_by("onset", F.struct(F.abs(F.col("onset") - F.col("planted")), "onset")).alias("found"))
    return planted.select(*KEYS, F.col("onset").alias("planted")).join(hits, [*KEYS, "planted"], "left").withColumn("bias", F.col("found") - F.col("planted"))
