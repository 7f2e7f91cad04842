"""Two-state models of a trace: Gaussian mixture, Viterbi path, posterior; shares of a periodogram.

No task needs a whole channel. A mixture is fitted to counts and means of values in
CELLS equal parts of the trace's range, whatever its length and its unit: a value is off by
its distance to the mean of its part, which is second order in the part's width. Paths and posteriors are found by blocks of frames: a block is one 2 by 2
matrix (in max-plus, and in log-sum), a channel's few matrices are multiplied in order,
and each block then decodes alone from what comes before and after it.

Cases: constant traces and traces of under two frames get a mixture with equal means;
ties of the path go to the low state; null values stay out of a fit and say nothing
about a state; an empty table gives an empty result; frames of a channel are distinct.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions import expressions as X
from tracelake.operators import sequence as S
from tracelake.operators.spectrum import periodogram
from tracelake.operators.statistics import conditional_medians
from tracelake.sources.shared import stored

_FIT = "run string, channel string, mu0 double, mu1 double, sd0 double, sd1 double, w0 double, w1 double"


#: Cells of a trace's range that a mixture is fitted to, and frames in a block.
CELLS, BLOCK = 1 << 17, 65_536


def mixture(x: np.ndarray, iterations: int = 400, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, standard deviations and weights of two Gaussians, by mean; ``n`` counts how often each of ``x`` stands.

    Expectation and maximisation from the 20th and 80th percentile; stops, with what it
    had, when a component holds less than two points.
    """
    n = np.ones(len(x)) if n is None else n.astype(np.float64)
    order = np.argsort(x, kind="stable")
    x, n = x[order], n[order]
    size, last = n.sum(), np.cumsum(n) - 1
    place = (size - 1) * np.array((0.2, 0.8))
    below, above = (x[np.searchsorted(last, f(place))] for f in (np.floor, np.ceil))
    centre = (n @ x) / size
    mean, sd, weight = below + (above - below) * (place - np.floor(place)), np.full(2, np.sqrt(n @ (x - centre) ** 2 / size) / 2 + 1e-6), np.full(2, 0.5)
    for _ in range(iterations):
        density = weight / sd * np.exp(-0.5 * ((x[:, None] - mean) / sd) ** 2)
        share = density / (density.sum(axis=1, keepdims=True) + 1e-300) * n[:, None]
        mass = share.sum(axis=0)
        if mass.min() < 2:
            break
        centre = x @ share / mass
        new_sd = np.sqrt(((x[:, None] - centre) ** 2 * share).sum(axis=0) / mass) + 1e-6
        still = np.array_equal(centre, mean) and np.array_equal(new_sd, sd)
        mean, sd, weight = centre, new_sd, mass / size
        if still:
            break
    by_mean = np.argsort(mean, kind="stable")
    return mean[by_mean], sd[by_mean], weight[by_mean]


def log_densities(x: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """Frames by states."""
    return -0.5 * ((x[:, None] - mean) / sd) ** 2 - np.log(sd * np.sqrt(2 * np.pi))


def transitions(low_frames: float, high_frames: float) -> np.ndarray:
    """Probabilities from expected stays in frames."""
    leave = 1 / np.maximum((low_frames, high_frames), 1.01)
    return np.array(((1 - leave[0], leave[0]), (leave[1], 1 - leave[1])))


def _times(a: np.ndarray, b: np.ndarray, add) -> np.ndarray:
    """Products of 2 by 2 matrices of logarithms; ``add`` is maximum or log-sum."""
    return add(a[:, :, 0, None] + b[:, None, 0, :], a[:, :, 1, None] + b[:, None, 1, :])


def running(steps: np.ndarray, add) -> np.ndarray:
    """Products of the first 1, 2, .. of ``steps``, in as many array operations as their number has binary digits."""
    out, k = steps.copy(), 1
    while k < len(out):
        out[k:] = _times(out[:-k].copy(), out[k:], add)
        k *= 2
    return out


#: The state before the first frame, which only its own matrix leaves.
BEGIN = np.array((0.0, -np.inf))


def matrices(emit: np.ndarray, move: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """A matrix for each frame, from the state before to its own; ``start`` if the first frame is a channel's first."""
    steps = move[None] + emit[:, None, :]
    if start is not None:
        steps[0] = start + emit[0], (-np.inf, -np.inf)
    return steps


def through(steps: np.ndarray, before: np.ndarray, after: np.ndarray, add) -> np.ndarray:
    """Logarithms of both states at each frame of a block, over all paths from the state ``before`` to what follows, ``after``."""
    ahead = running(steps, add)
    ahead = add(before[0] + ahead[:, 0], before[1] + ahead[:, 1])
    back = np.repeat(after[None], len(steps), axis=0)
    if len(steps) > 1:
        rest = running(np.swapaxes(steps[:0:-1], 1, 2), add)
        back[:-1] = add(after[0] + rest[:, 0], after[1] + rest[:, 1])[::-1]
    return ahead + back


def best_path(emit: np.ndarray, move: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Most likely states (0 low, 1 high), from logarithms."""
    both = through(matrices(emit, move, start), BEGIN, np.zeros(2), np.maximum)
    return (both[:, 1] > both[:, 0]).astype(np.int8)


def posterior(emit: np.ndarray, move: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Probability of the high state at each frame, given all."""
    both = through(matrices(emit, move, start), BEGIN, np.zeros(2), np.logaddexp)
    return np.exp(both[:, 1] - np.logaddexp(both[:, 0], both[:, 1]))


def fit(df: DataFrame, iterations: int = 400, cells: int = CELLS) -> DataFrame:
    """(run, channel, mu0, mu1, sd0, sd1, w0, w1) of each trace."""

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        mean, sd, weight = mixture(frame["v"].to_numpy(np.float64), iterations, frame["n"].to_numpy())
        return pd.DataFrame([[frame["run"].iloc[0], frame["channel"].iloc[0], *mean, *sd, *weight]], columns=[x.split()[0] for x in _FIT.split(", ")])

    values = df.filter(X.finite(F.col("v")))
    span = values.groupBy(*S.KEYS).agg(F.min("v").alias("_a"), F.max("v").alias("_b"))
    cell = F.floor(F.coalesce(F.try_divide(F.col("v") - F.col("_a"), F.col("_b") - F.col("_a")), F.lit(0.0)) * cells)
    counts = values.join(span, list(S.KEYS)).groupBy(*S.KEYS, cell.alias("cell")).agg(F.avg("v").alias("v"), F.count("*").alias("n"))
    return counts.groupBy(*S.KEYS).applyInPandas(one, _FIT)


def separation(fits: DataFrame, least: float = 1.5) -> DataFrame:
    """Adds dprime, dprime_pass, and the levels lo (low mean and one deviation) and hi (between the means)."""
    d = X.dprime(F.col("mu0"), F.col("mu1"), F.col("sd0"), F.col("sd1"))
    return fits.withColumns({"dprime": d, "dprime_pass": d >= least, "lo": F.col("mu0") + F.col("sd0"), "hi": 0.5 * (F.col("mu0") + F.col("mu1"))})


def decode(df: DataFrame, low_frames: int, high_frames: int, iterations: int = 400, block: int = BLOCK, fits: DataFrame | None = None) -> DataFrame:
    """(run, channel, frame, v, state, posterior); ``fits`` as given by ``fit``, else made from these traces."""
    fits = stored(fit(df, iterations), "fits") if fits is None else fits
    move = np.log(transitions(low_frames, high_frames))
    keys, params = list(S.KEYS), ["mu0", "mu1", "sd0", "sd1", "w0", "w1"]
    rows = df.select(*keys, F.col("frame").cast("bigint").alias("frame"), F.col("v").cast("double").alias("v"), F.expr(f"cast(frame div {block} as bigint)").alias("block"))
    first = rows.groupBy(*keys).agg(F.min("block").alias("first"))
    rows = rows.join(fits.select(*keys, *params).join(first, keys), keys)
    sides = [f"{x}{i}" for x in ("mb", "ma", "lb", "la") for i in (0, 1)]  # in max and log-sum: before, after

    def steps_of(frame: pd.DataFrame) -> np.ndarray:
        mu0, mu1, sd0, sd1, w0, w1 = frame[params].iloc[0]
        emit = np.nan_to_num(log_densities(frame["v"].to_numpy(np.float64), np.array((mu0, mu1)), np.array((sd0, sd1))))
        return matrices(emit, move, np.log(np.maximum((w0, w1), 1e-12)) if frame["block"].iloc[0] == frame["first"].iloc[0] else None)

    def matrix(frame: pd.DataFrame) -> pd.DataFrame:
        steps = steps_of(frame.sort_values("frame"))
        whole = [running(steps, add)[-1].ravel().tolist() for add in (np.maximum, np.logaddexp)]
        return frame[[*keys, "block"]].head(1).assign(m=[whole[0]], l=[whole[1]])

    def borders(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block", ignore_index=True)
        out = frame[[*keys, "block"]].copy()
        for name, add in (("m", np.maximum), ("l", np.logaddexp)):
            of = np.array(frame[name].to_list()).reshape(-1, 2, 2)
            before, after = [BEGIN], [np.zeros(2)]
            for a in of[:-1]:
                before.append(add(before[-1][0] + a[0], before[-1][1] + a[1]))
            for a in of[:0:-1]:
                after.append(add(a[:, 0] + after[-1][0], a[:, 1] + after[-1][1]))
            for i in (0, 1):
                out[f"{name}b{i}"], out[f"{name}a{i}"] = [x[i] for x in before], [x[i] for x in after[::-1]]
        return out[[*keys, "block", *sides]]

    def states(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("frame", ignore_index=True)
        steps = steps_of(frame)
        ends = frame[sides].iloc[0].to_numpy(np.float64).reshape(4, 2)
        path = through(steps, ends[0], ends[1], np.maximum)
        both = through(steps, ends[2], ends[3], np.logaddexp)
        high = np.exp(both[:, 1] - np.logaddexp(both[:, 0], both[:, 1]))
        return frame[[*keys, "frame", "v"]].assign(state=(path[:, 1] > path[:, 0]).astype(np.int32), posterior=high)

    kinds = "run string, channel string, block long, "
    blocks = rows.groupBy(*keys, "block").applyInPandas(matrix, kinds + "m array<double>, l array<double>")
    ends = blocks.groupBy(*keys).applyInPandas(borders, kinds + ", ".join(f"{x} double" for x in sides))
    return rows.join(ends, [*keys, "block"]).groupBy(*keys, "block").applyInPandas(states, "run string, channel string, frame long, v double, state int, posterior double")


# Fixed values of the method: seconds and percentiles of the detector.
DETECT = {"env_s": 0.33, "gmm_iters": 400, "dwell_low_s": 0.3, "dwell_high_s": 0.5, "min_bout_s": 0.4, "merge_gap_s": 0.3, "baseline_pre_s": 1.0, "coactive_window_s": 1.0, "groom_pct": 99.0, "artifact_pct": 99.5, "dprime_min": 1.5}


def detect(traces: DataFrame, channel: str | None, fps: float, params: dict | None = None, groom: str | None = None, artifact: str | None = None, others: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Bouts of one channel, or of all (None): ``env``, ``states``, ``fits``, ``bouts`` (labelled), ``cross``, ``funnel``, ``gates``.

    What several results read (envelopes, mixtures, states, bouts) is written once to the
    shared folder.
    """
    p = X.merge_params(DETECT, params)

    def frames(seconds: float) -> int:
        return max(1, round(seconds * fps))

    env = stored(S.condition(traces, frames(p["env_s"])), "env")
    fits = stored(separation(fit(env, p["gmm_iters"]), p["dprime_min"]), "fits")
    mine = F.lit(True) if channel is None else F.col("channel") == channel
    own = env.filter(mine)
    states = stored(decode(own, frames(p["dwell_low_s"]), frames(p["dwell_high_s"]), fits=fits), "states")
    level = states.join(fits.select(*S.KEYS, "lo", "hi"), list(S.KEYS))
    runs = S.runs_of(states, F.col("state") == 1)
    bouts = stored(S.refine_onsets(S.merge_intervals(runs, frames(p["merge_gap_s"]), frames(p["min_bout_s"])), level, F.col("lo")), "bouts")
    cross = S.hysteresis_runs(level.select(*S.KEYS, "frame", "v", "hi", "lo"), F.col("hi"), F.col("lo"))
    cross = stored(S.merge_intervals(cross, frames(p["merge_gap_s"]), frames(p["min_bout_s"])), "bouts")
    levels = fits.select(*S.KEYS, F.col("mu0").alias("base"), "lo")
    labelled = S.label_bouts(bouts, env, levels, fps, frames(p["baseline_pre_s"]), frames(p["coactive_window_s"]), groom, artifact, others, cross, p["groom_pct"] / 100, p["artifact_pct"] / 100)
    sure = S.spelled(bouts, "onset", "offset").join(states, [*S.KEYS, "frame"]).groupBy(*S.KEYS, "onset").agg(F.avg("posterior").alias("posterior"))
    labelled = stored(labelled.join(sure, [*S.KEYS, "onset"]), "labels")
    counts = S.funnel(labelled)
    raw = runs.groupBy(*S.KEYS).agg(F.count("*").alias("state_runs"))
    crossed = cross.groupBy(*S.KEYS).agg(F.count("*").alias("crosscheck_bouts"))
    duty = states.groupBy(*S.KEYS).agg(F.avg("state").alias("duty"))
    gates = fits.filter(mine).join(duty, list(S.KEYS)).join(counts.select(*S.KEYS, F.try_divide("crosscheck_within_2", "bouts").alias("agreement")), list(S.KEYS), "left")
    gates = gates.select(*S.KEYS, F.round("dprime", 3).alias("dprime"), "dprime_pass", F.round("w0", 3).alias("low_weight"), F.round("duty", 3).alias("duty"), F.round("agreement", 3).alias("agreement"))
    return {"env": env, "states": states, "fits": fits, "bouts": labelled, "cross": cross, "funnel": raw.join(counts, list(S.KEYS), "left").join(crossed, list(S.KEYS), "left"), "gates": gates}


def signal_table(env: DataFrame, raw: DataFrame) -> DataFrame:
    """(run, channel, dprime, w1, rest, active, ratio): mixture of each conditioned trace, raw medians below and above ``hi``."""
    fits = separation(fit(env))
    both = env.select(*S.KEYS, "frame", F.col("v").alias("e")).join(raw.select(*S.KEYS, "frame", "v"), [*S.KEYS, "frame"]).join(fits.select(*S.KEYS, "hi"), list(S.KEYS))
    medians = conditional_medians(both, F.col("e") > F.col("hi")).select(*S.KEYS, F.col("off").alias("rest"), F.col("on").alias("active"), "ratio")
    return fits.join(medians, list(S.KEYS)).select(*S.KEYS, "dprime", "w1", "hi", "lo", "rest", "active", "ratio")


def common_mode(target: DataFrame, common: DataFrame, betas: list[float]) -> DataFrame:
    """(run, channel, beta, dprime) of the target less beta times another trace of its run."""
    pairs = target.join(common.select("run", "frame", F.col("v").alias("c")), ["run", "frame"])
    swept = pairs.withColumn("beta", F.explode(F.array(*[F.lit(float(b)) for b in betas])))
    named = swept.select("run", F.concat_ws("\x01", "channel", F.col("beta").cast("string")).alias("channel"), "frame", (F.col("v") - F.col("beta") * F.col("c")).alias("v"))
    return separation(fit(named)).select("run", F.split("channel", "\x01")[0].alias("channel"), F.split("channel", "\x01")[1].cast("double").alias("beta"), "dprime")


def band_power(spectrum: DataFrame, bands: dict[str, tuple[float, float]]) -> DataFrame:
    """(run, channel, peak_hz, a percent for each band)."""
    some = spectrum.filter("hz > 0")
    shares = [(100 * F.try_divide(F.sum(F.when((F.col("hz") >= a) & (F.col("hz") < b), F.col("power")).otherwise(0.0)), F.sum("power"))).alias(k) for k, (a, b) in bands.items()]
    return some.groupBy(*S.KEYS).agg(F.max_by("hz", F.struct("power", (-F.col("hz")).alias("o"))).alias("peak_hz"), *shares)
