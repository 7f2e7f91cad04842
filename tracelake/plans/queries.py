"""Registered queries over time series and their SQL.

``events`` stands for box traces: a channel for each event type, frames by time, values
as motion energy. ``embeddings`` stands for ROI traces (a vector is an ROI, a position a
frame) and for an 8 by 8 movie (a vector is a frame, a position a pixel).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelake.functions import expressions as X
from tracelake.operators import alignment as A
from tracelake.operators import checks as C
from tracelake.operators import correlation as R
from tracelake.operators import images as I
from tracelake.operators import models as M
from tracelake.operators import sequence as S
from tracelake.operators import statistics as T
from tracelake.sources.shared import stored

_FOUND: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
WIDTH, GAP, LEAST = 5, 4, 6
KEYS = ["run", "channel"]


def query(sql: str | None = None):
    def keep(f):
        _FOUND[f.__name__] = f, sql
        return f

    return keep


def r6(c: Column | str, name: str) -> Column:
    """Six decimals; adding zero turns -0.0 into 0.0."""
    return (F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)).alias(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Seconds in a block of the events' numbering.
HOUR = 3600


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(channel, t, ts, event_id, v): t in seconds since 2024-01-01."""
    t = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)") / 1e6
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("channel"), t.alias("t"), "ts", "event_id", F.col("value").alias("v"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, channel, frame, t, v): frames numbered by time.

    Events are numbered within hours, from the number of those in the hours before, so
    that a channel is no task of its own.
    """
    e = timed_events(spark, sf_dir).withColumn("hour", F.coalesce(F.floor(F.col("t") / HOUR), F.lit(-(1 << 40))))
    hours = e.groupBy("channel", "hour").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("channel").orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
    within = F.row_number().over(Window.partitionBy("channel", "hour").orderBy("ts", "event_id")) - 1
    numbered = e.join(hours.select("channel", "hour", before.alias("before")), ["channel", "hour"])
    return numbered.select(F.lit("r").alias("run"), "channel", (F.col("before") + within).alias("frame"), "t", "v")


def movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = table(spark, sf_dir, "embeddings").select(F.lit("m").alias("run"), F.col("vec_id").alias("frame"), F.posexplode("embedding").alias("i", "v"))
    return flat.select("run", "frame", F.expr("cast(i div 8 as int)").alias("y"), F.expr("cast(i % 8 as int)").alias("x"), F.col("v").cast("double").alias("v"))


def rois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, channel, frame, v); shifted to be positive, as fluorescence is."""
    flat = table(spark, sf_dir, "embeddings").select(F.lit("m").alias("run"), F.col("vec_id").cast("string").alias("channel"), F.posexplode("embedding").alias("frame", "v"))
    return flat.withColumns({"frame": F.col("frame").cast("bigint"), "v": F.col("v").cast("double") + 10.0})


EV = """ev AS (SELECT 'r' AS run, event_type AS channel, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS frame,
    (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01'))::DOUBLE / 1e6 AS t, value AS v FROM events)"""
ENV = f"""{EV}, ends AS (SELECT channel, arg_min(v, frame) AS fv, arg_max(v, frame) AS lv, max(frame) AS lf FROM ev GROUP BY channel),
    env AS (SELECT run, channel, frame, (s + greatest(0, {WIDTH // 2} - frame) * ln(fv + 1e-3) + greatest(0, frame + {WIDTH - 1 - WIDTH // 2} - lf) * ln(lv + 1e-3)) / {WIDTH} AS v
        FROM (SELECT *, sum(ln(v + 1e-3)) OVER (PARTITION BY channel ORDER BY frame ROWS BETWEEN {WIDTH // 2} PRECEDING AND {WIDTH - 1 - WIDTH // 2} FOLLOWING) AS s FROM ev) JOIN ends USING (channel))"""
MV = """mv AS (SELECT 'm' AS run, vec_id AS frame, (i - 1) // 8 AS y, (i - 1) % 8 AS x, embedding[i]::DOUBLE AS v FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings))"""
RV = """rv AS (SELECT 'm' AS run, vec_id::VARCHAR AS channel, i - 1 AS frame, embedding[i]::DOUBLE + 10.0 AS v FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings))"""
LEVELS = f"""{ENV}, lv AS (SELECT channel, quantile_cont(v, 0.9) AS hi, quantile_cont(v, 0.7) AS lo FROM env GROUP BY channel)"""
HYST = f"""{LEVELS}, mk AS (SELECT env.*, hi, lo, CASE WHEN v > hi THEN 1 WHEN v < lo THEN 0 END AS m,
        max(CASE WHEN v <= lo THEN frame END) OVER (PARTITION BY channel ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pl FROM env JOIN lv USING (channel)),
    st AS (SELECT *, coalesce(last_value(m IGNORE NULLS) OVER (PARTITION BY channel ORDER BY frame), 0) AS s, max(frame) OVER (PARTITION BY channel) AS lf FROM mk),
    ed AS (SELECT *, s = 1 AND coalesce(lag(s) OVER (PARTITION BY channel ORDER BY frame), 0) = 0 AS e FROM st),
    gr AS (SELECT *, sum(e::INT) OVER (PARTITION BY channel ORDER BY frame) AS g FROM ed),
    hy AS (SELECT run, channel, max(CASE WHEN e THEN greatest(frame - 30, coalesce(pl + 1, 0)) END) AS onset, least(max(frame) + 1, max(lf)) AS "offset" FROM gr WHERE s = 1 GROUP BY run, channel, g)"""
BOUTS = f"""{HYST}, far AS (SELECT *, coalesce(onset - lag("offset") OVER (PARTITION BY channel ORDER BY onset) - 1 > {GAP}, true)::INT AS f FROM hy),
    mg AS (SELECT *, sum(f) OVER (PARTITION BY channel ORDER BY onset) AS g FROM far),
    bt AS (SELECT run, channel, min(onset) AS onset, max("offset") AS "offset" FROM mg GROUP BY run, channel, g HAVING max("offset") - min(onset) + 1 >= {LEAST})"""
LABELS = f"""{BOUTS}, base AS (SELECT channel, quantile_cont(v, 0.5) AS base FROM env GROUP BY channel),
    tops AS (SELECT b.*, max(v) AS top FROM bt b JOIN env USING (channel) WHERE frame BETWEEN onset AND "offset" GROUP BY ALL),
    pre AS (SELECT channel, onset, count(*) FILTER (v < lo) = 10 AS ok FROM bt JOIN env USING (channel) JOIN lv USING (channel) WHERE frame >= onset - 10 AND frame < onset GROUP BY ALL),
    art AS (SELECT bt.channel, onset, bool_or(e.v > p) AS hit FROM bt, env e, (SELECT quantile_cont(v, 0.995) AS p FROM env WHERE channel = 'error') q WHERE e.channel = 'error' AND e.frame >= onset - 2 AND e.frame < onset + 3 GROUP BY ALL),
    co AS (SELECT bt.channel, onset, bool_or(e.v > lv.lo) AS busy FROM bt JOIN env e ON e.channel IN ('click', 'purchase') AND e.channel <> bt.channel AND e.frame BETWEEN onset - 5 AND onset + 5 JOIN lv ON lv.channel = e.channel GROUP BY ALL),
    lb AS (SELECT t.run, t.channel, t.onset, t."offset", round((t."offset" - t.onset + 1) / 15.0, 3) AS duration_s, round(top - base, 6) + 0.0 AS amplitude, coalesce(ok, false) AS baseline_pre, coalesce(hit, false) AS artifact, coalesce(NOT busy, false) AS isolated
        FROM tops t JOIN base USING (channel) LEFT JOIN pre ON pre.channel = t.channel AND pre.onset = t.onset LEFT JOIN art ON art.channel = t.channel AND art.onset = t.onset LEFT JOIN co ON co.channel = t.channel AND co.onset = t.onset)"""


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.condition(events(spark, sf_dir), WIDTH)


def stored_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For queries that read it more than once."""
    return stored(envelope(spark, sf_dir), "env")


def levels_of(env: DataFrame) -> DataFrame:
    return stored(T.percentiles(env, {"hi": 0.9, "lo": 0.7, "base": 0.5}), "levels")


def levelled(spark: SparkSession, sf_dir: str, env: DataFrame | None = None) -> DataFrame:
    env = stored_envelope(spark, sf_dir) if env is None else env
    return env.join(levels_of(env), KEYS)


def bouts(spark: SparkSession, sf_dir: str, env: DataFrame | None = None) -> DataFrame:
    return S.merge_intervals(S.hysteresis_runs(levelled(spark, sf_dir, env), F.col("hi"), F.col("lo")), GAP, LEAST)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = stored_envelope(spark, sf_dir)
    found, levels = stored(bouts(spark, sf_dir, env), "bouts"), stored(levels_of(env), "levels")
    return S.label_bouts(found, env, levels, 15.0, 10, 5, artifact="error", others=("click", "purchase"))


@query(f"WITH {ENV} SELECT channel, frame, round(v, 6) + 0.0 AS v FROM env")
def zero_phase_envelope(spark, sf_dir):
    return envelope(spark, sf_dir).select("channel", "frame", r6("v", "v"))


@query(f"WITH {EV} SELECT channel, frame, round(coalesce(abs(v - lag(v) OVER (PARTITION BY channel ORDER BY frame)), 0), 6) + 0.0 AS v FROM ev")
def frame_differences(spark, sf_dir):
    return S.motion_energy(events(spark, sf_dir)).select("channel", "frame", r6("v", "v"))


@query(f"WITH {EV} SELECT channel, frame, round(coalesce((v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w, 0), 0), 6) + 0.0 AS v FROM ev WINDOW w AS (PARTITION BY channel)")
def trace_zscore(spark, sf_dir):
    return S.zscore(events(spark, sf_dir)).select("channel", "frame", r6("v", "v"))


@query(f"WITH {EV} SELECT channel, frame, round((v - avg(v) OVER w) / coalesce(nullif(max(v) OVER w - min(v) OVER w, 0), 1), 6) + 0.0 AS v FROM ev WINDOW w AS (PARTITION BY channel)")
def unit_range(spark, sf_dir):
    return S.unit_range(events(spark, sf_dir)).select("channel", "frame", r6("v", "v"))


@query(f"WITH {EV} SELECT channel, frame, round(v, 6) + 0.0 AS v FROM (SELECT *, max(frame) OVER () + 1 AS n FROM ev) WHERE frame < CASE WHEN n - 3 < 1 THEN n ELSE n - 3 END")
def tail_trim(spark, sf_dir):
    return S.tail_trim(events(spark, sf_dir)).select("channel", "frame", r6("v", "v"))


@query(f"WITH {EV} SELECT channel, frame, round(CASE WHEN frame IN (0, 40) THEN coalesce(lead(v) OVER (PARTITION BY channel ORDER BY frame), v) ELSE v END, 6) + 0.0 AS v FROM ev")
def repaired_samples(spark, sf_dir):
    return S.repair(events(spark, sf_dir), 40).select("channel", "frame", r6("v", "v"))


@query(f"WITH {EV} SELECT channel, frame // 10 AS frame, round(avg(v), 6) + 0.0 AS v FROM ev GROUP BY channel, frame // 10 HAVING count(*) = 10")
def temporal_bin(spark, sf_dir):
    return S.temporal_bins(events(spark, sf_dir), 10).select("channel", "frame", r6("v", "v"))


@query(f"WITH {EV}, n AS (SELECT channel, frame, lag(v) OVER w AS a, v AS b, lead(v) OVER w AS c FROM ev WINDOW w AS (PARTITION BY channel ORDER BY frame)) SELECT channel, frame, round(list_sort([a, b, c])[2], 6) + 0.0 AS v FROM n WHERE a IS NOT NULL AND c IS NOT NULL")
def median_of_three(spark, sf_dir):
    return S.median3(events(spark, sf_dir)).select("channel", "frame", r6("v", "v"))


@query(f"WITH {EV}, p AS (SELECT channel, k AS lag, v, lead(v, k) OVER (PARTITION BY channel, k ORDER BY frame) AS w FROM ev, (SELECT unnest([1, 5, 15]) AS k)) SELECT channel, lag, round(corr(v, w), 6) + 0.0 AS r FROM p WHERE w IS NOT NULL GROUP BY ALL")
def lag_correlation(spark, sf_dir):
    return S.lag_correlation(events(spark, sf_dir), [1, 5, 15]).select("channel", "lag", r6("r", "r"))


@query(f"WITH {LEVELS}, b AS (SELECT *, lag(v) OVER (PARTITION BY channel ORDER BY frame) AS b FROM env JOIN lv USING (channel)) SELECT channel, count(*) FILTER (v > hi AND b <= hi) AS edges FROM b GROUP BY channel")
def rising_edges(spark, sf_dir):
    return S.rising_edges(levelled(spark, sf_dir), F.col("hi")).select("channel", "edges")


@query(f"WITH {LEVELS}, s AS (SELECT channel, frame, frame - row_number() OVER (PARTITION BY channel ORDER BY frame) AS i FROM env JOIN lv USING (channel) WHERE v > hi) SELECT channel, min(frame) AS onset, max(frame) AS \"offset\" FROM s GROUP BY channel, i")
def state_runs(spark, sf_dir):
    d = levelled(spark, sf_dir)
    return S.runs_of(d, F.col("v") > F.col("hi")).select("channel", "onset", "offset")


@query(f'WITH {HYST} SELECT channel, onset, "offset" FROM hy')
def hysteresis_bouts(spark, sf_dir):
    return S.hysteresis_runs(levelled(spark, sf_dir), F.col("hi"), F.col("lo")).select("channel", "onset", "offset")


@query(f'WITH {BOUTS} SELECT channel, onset, "offset" FROM bt')
def merge_filter_bouts(spark, sf_dir):
    return bouts(spark, sf_dir).select("channel", "onset", "offset")


@query(f'WITH {LABELS} SELECT channel, onset, "offset", duration_s, amplitude, baseline_pre, artifact, isolated FROM lb')
def bout_labels(spark, sf_dir):
    return labelled(spark, sf_dir).select("channel", "onset", "offset", "duration_s", r6("amplitude", "amplitude"), "baseline_pre", "artifact", "isolated")


@query(f"""WITH {LABELS} SELECT channel, count(*) AS bouts, count(*) FILTER (baseline_pre) AS with_baseline_pre, count(*) AS not_grooming, count(*) FILTER (NOT artifact) AS not_artifact,
    count(*) FILTER (isolated) AS isolated, count(*) FILTER (baseline_pre AND NOT artifact) AS analysis_set FROM lb GROUP BY channel""")
def bout_funnel(spark, sf_dir):
    return S.funnel(labelled(spark, sf_dir)).select("channel", "bouts", "with_baseline_pre", "not_grooming", "not_artifact", "isolated", "analysis_set")


@query(f"""WITH {BOUTS}, n AS (SELECT channel, max(frame) + 1 AS n FROM env GROUP BY channel), ok AS (SELECT bt.* FROM bt JOIN n USING (channel) WHERE onset - 10 >= 0 AND onset + 10 < n)
    SELECT ok.channel, frame - onset AS at, round(avg(v), 6) + 0.0 AS mean, round(stddev_pop(v) / sqrt(count(v)), 6) + 0.0 AS sem, count(v) AS n FROM ok JOIN env USING (channel) WHERE frame >= onset - 10 AND frame < onset + 10 GROUP BY ok.channel, frame - onset""")
def event_triggered_average(spark, sf_dir):
    env = stored_envelope(spark, sf_dir)
    return S.event_average(bouts(spark, sf_dir, env), env, 10).select("channel", "at", r6("mean", "mean"), r6("sem", "sem"), "n")


@query(f"""WITH {BOUTS}, w AS (SELECT channel, unnest(range(greatest(0, ceil((onset - 59) / 15.0)::BIGINT), onset // 15 + 1)) AS k FROM bt), c AS (SELECT channel, k, count(*) AS n FROM w GROUP BY ALL)
    SELECT channel, k * 15 AS start, n FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY n DESC, k) AS i FROM c) WHERE i = 1""")
def busiest_window(spark, sf_dir):
    return S.busiest_window(bouts(spark, sf_dir), 60, 15).select("channel", "start", "n")


@query(f"""WITH {LEVELS}, x AS (SELECT channel, frame, v > hi AS s, max(frame) OVER (PARTITION BY channel) AS lf FROM env JOIN lv USING (channel)), i AS (SELECT *, frame - row_number() OVER (PARTITION BY channel, s ORDER BY frame) AS g FROM x),
    r AS (SELECT channel, s, (max(frame) - min(frame) + 1)::DOUBLE AS n, max(frame) = max(lf) AS open FROM i GROUP BY channel, s, g)
    SELECT channel, CASE WHEN s THEN 'run' ELSE 'gap' END AS kind, count(*) AS n, round(avg(n), 6) + 0.0 AS mean, quantile_cont(n, 0.5) AS median, max(n) AS longest FROM r WHERE s OR NOT open GROUP BY ALL""")
def run_lengths(spark, sf_dir):
    d = levelled(spark, sf_dir)
    return S.run_statistics(d, F.col("v") > F.col("hi")).select("channel", "kind", "n", r6("mean", "mean"), "median", "longest")


@query(f"WITH {EV} SELECT channel, round(quantile_cont(v, 0.15), 6) AS f0, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.99), 6) AS p99 FROM ev GROUP BY channel")
def trace_percentiles(spark, sf_dir):
    return T.percentiles(events(spark, sf_dir), {"f0": 0.15, "median": 0.5, "p99": 0.99}).select("channel", *[F.round(c, 6).alias(c) for c in ("f0", "median", "p99")])


@query(f"WITH {EV}, m AS (SELECT channel, quantile_cont(v, 0.5) AS m FROM ev GROUP BY channel) SELECT channel, round(any_value(m), 6) AS median, round(1.4826 * quantile_cont(abs(v - m), 0.5), 6) AS sd FROM ev JOIN m USING (channel) GROUP BY channel")
def robust_sd(spark, sf_dir):
    return T.robust_spread(events(spark, sf_dir)).select("channel", F.round("median", 6).alias("median"), F.round("sd", 6).alias("sd"))


@query(f"WITH {EV} SELECT channel, count(*) AS n, round(min(v), 6) AS least, round(quantile_cont(v, 0.5), 6) AS median, round(max(v), 6) AS most, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS sd, count(*) FILTER (isnan(v)) AS nans FROM ev GROUP BY channel")
def trace_inventory(spark, sf_dir):
    return T.inventory(events(spark, sf_dir)).select("channel", "n", *[F.round(c, 6).alias(c) for c in ("least", "median", "most", "mean", "sd")], "nans")


@query(f"WITH {EV} SELECT channel, round(regr_slope(v, frame), 8) + 0.0 AS slope, round(regr_intercept(v, frame), 6) + 0.0 AS intercept FROM ev GROUP BY channel")
def line_fits(spark, sf_dir):
    return T.line_fit(events(spark, sf_dir)).select("channel", (F.round("slope", 8) + 0.0).alias("slope"), r6("intercept", "intercept"))


@query(f"""WITH {EV}, m AS (SELECT frame, avg(v) AS v FROM ev GROUP BY frame), s AS (SELECT floor(frame / 15.0) AS t, quantile_cont(v, 0.5) AS m FROM m GROUP BY 1)
    SELECT round(100 * regr_slope(m, t) * (max(t) - min(t)) / avg(m), 6) + 0.0 AS percent, abs(100 * regr_slope(m, t) * (max(t) - min(t)) / avg(m)) > 20 AS flagged FROM s""")
def bleach_drift(spark, sf_dir):
    return T.bleaching(events(spark, sf_dir), 15.0).select(r6("percent", "percent"), "flagged")


@query(f"WITH {EV} SELECT channel, least(floor(v / 10.0), 19)::BIGINT AS bin, count(*) AS n FROM ev WHERE v BETWEEN 0 AND 200 GROUP BY ALL")
def trace_histogram(spark, sf_dir):
    return T.histogram(events(spark, sf_dir), 0.0, 200.0, 20).select("channel", "bin", "n")


@query("""WITH e AS (SELECT * FROM (VALUES (1.0, 5.0), (5.0, 10.0), (10.0, 20.0), (20.0, NULL)) t(low, high)) SELECT low::DOUBLE AS low, high::DOUBLE AS high, count(*) AS n FROM part JOIN e ON p_size >= low AND (high IS NULL OR p_size <= high) GROUP BY low, high""")
def size_histogram(spark, sf_dir):
    return T.size_bins(table(spark, sf_dir, "part"), "p_size", [1, 5, 10, 20])


@query("""
    SELECT l_returnflag AS run, round(avg((l_quantity > 25 AND l_discount > 0.05)::INT), 6) AS joint, round(avg((l_quantity > 25)::INT) * avg((l_discount > 0.05)::INT), 6) AS chance,
        round(avg((l_quantity > 25 AND l_discount > 0.05)::INT) / (avg((l_quantity > 25)::INT) * avg((l_discount > 0.05)::INT)), 6) AS enrichment FROM lineitem GROUP BY l_returnflag""")
def co_occurrence(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "run")
    return T.co_occurrence(d, F.col("l_quantity") > 25, F.col("l_discount") > 0.05).select("run", *[F.round(c, 6).alias(c) for c in ("joint", "chance", "enrichment")])


@query("""WITH e AS (SELECT l_returnflag AS run, quantile_cont(l_quantity, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM lineitem GROUP BY 1),
    b AS (SELECT run, least(len(list_filter(e, lambda x: x <= l_quantity)) - 1, 4)::INT AS bin, l_extendedprice AS y FROM lineitem JOIN e ON run = l_returnflag)
    SELECT run, bin, round(avg(y), 4) AS mean, count(*) AS n FROM b GROUP BY ALL HAVING count(*) > 5""")
def quantile_saturation(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "run")
    return T.saturation(d, "l_quantity", "l_extendedprice", 5).select("run", "bin", F.round("mean", 4).alias("mean"), "n")


@query("""WITH r AS (SELECT l_returnflag AS run, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0 AS a,
        rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2.0 AS b FROM lineitem)
    SELECT run, round(corr(a, b), 6) + 0.0 AS rho FROM r GROUP BY run""")
def spearman(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "run")
    return T.spearman(d, "l_quantity", "l_extendedprice").select("run", r6("rho", "rho"))


@query(f"""WITH {EV}, d AS (SELECT channel, frame, t - lag(t) OVER (PARTITION BY channel ORDER BY frame) AS dt FROM ev), s AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY dt) - 1 AS i, count(*) OVER (PARTITION BY channel) AS n FROM d WHERE dt IS NOT NULL),
    m AS (SELECT channel, dt AS m FROM s WHERE i = n // 2)
    SELECT channel AS run, round(1 / avg(dt) FILTER (dt <= 1.5 * m), 9) AS rate, count(*) FILTER (dt <= 1.5 * m) AS kept, count(*) FILTER (dt > 1.5 * m) AS gaps FROM s JOIN m USING (channel) GROUP BY channel""")
def frame_rate_gaps(spark, sf_dir):
    stamps = events(spark, sf_dir).select(F.col("channel").alias("run"), "frame", "t")
    return T.frame_rate(stamps)[0].select("run", F.round("rate", 9).alias("rate"), "kept", "gaps")


@query(f"""WITH {EV}, l AS (SELECT channel, frame, ln(v + 1e-3) AS v FROM ev) SELECT a.channel AS a, b.channel AS b, round(corr(a.v, b.v), 6) + 0.0 AS r FROM l a JOIN l b ON a.frame = b.frame AND a.channel < b.channel GROUP BY ALL""")
def channel_correlations(spark, sf_dir):
    return T.channel_correlations(events(spark, sf_dir)).select("a", "b", r6("r", "r"))


@query(f"WITH {LEVELS}, j AS (SELECT ev.channel, ev.v, env.v > hi AS w FROM ev JOIN env ON ev.channel = env.channel AND ev.frame = env.frame JOIN lv ON lv.channel = ev.channel) SELECT channel, round(quantile_cont(v, 0.5) FILTER (w), 6) AS \"on\", round(quantile_cont(v, 0.5) FILTER (NOT w), 6) AS off FROM j GROUP BY channel")
def conditional_medians(spark, sf_dir):
    d = levelled(spark, sf_dir).withColumnRenamed("v", "e").join(events(spark, sf_dir).select("channel", "frame", "v"), ["channel", "frame"])
    return T.conditional_medians(d, F.col("e") > F.col("hi")).select("channel", F.round("on", 6).alias("on"), F.round("off", 6).alias("off"))


@query(f"""WITH {RV}, p AS (SELECT channel, arg_min(frame, frame) FILTER (v = top) AS peak FROM (SELECT *, max(v) OVER (PARTITION BY channel) AS top FROM rv) GROUP BY channel) SELECT channel, peak, row_number() OVER (ORDER BY peak, channel) AS position FROM p""")
def roi_rank_by_peak(spark, sf_dir):
    return T.peak_order(rois(spark, sf_dir)).select("channel", "peak", "position")


@query(f"""WITH {RV}, a AS (SELECT channel, max(v) - quantile_cont(v, 0.5) AS amplitude FROM rv GROUP BY channel), k AS (SELECT *, row_number() OVER (ORDER BY amplitude DESC, channel) AS best, row_number() OVER (ORDER BY amplitude, channel) AS worst FROM a)
    SELECT channel, round(amplitude, 6) AS amplitude, best, worst FROM k WHERE best <= 3 OR worst <= 3""")
def best_and_worst_rois(spark, sf_dir):
    return T.best_and_worst(rois(spark, sf_dir)).select("channel", F.round("amplitude", 6).alias("amplitude"), "best", "worst")


@query(f"""WITH {RV}, f AS (SELECT channel, greatest(quantile_cont(v, 0.15), 1e-6) AS f0 FROM rv GROUP BY channel) SELECT channel, frame, round((v - f0) / f0, 6) + 0.0 AS dff FROM rv JOIN f USING (channel)""")
def dff_static_f0(spark, sf_dir):
    traces = rois(spark, sf_dir).select("run", F.col("channel").alias("roi"), "frame", F.col("v").alias("f"))
    return I.dff_traces(traces).select(F.col("roi").alias("channel"), "frame", r6("dff", "dff"))


_BOXES = [("paw", 0, 0, 4, 4), ("wheel", 3, 2, 8, 7)]


@query(f"""WITH {MV}, b AS (SELECT * FROM (VALUES ('paw', 0, 0, 4, 4), ('wheel', 3, 2, 8, 7)) t(box, x0, y0, x1, y1)), d AS (SELECT *, v - lag(v) OVER (PARTITION BY y, x ORDER BY frame) AS d FROM mv)
    SELECT box, frame, round(avg(v), 6) + 0.0 AS lum, round(coalesce(avg(abs(d)), 0), 6) + 0.0 AS me, round(coalesce(avg(d * d), 0), 6) + 0.0 AS power, round(coalesce(avg((abs(d) > 0.2)::INT), 0), 6) + 0.0 AS area
    FROM d JOIN b ON x >= x0 AND x < x1 AND y >= y0 AND y < y1 GROUP BY box, frame""")
def motion_energy(spark, sf_dir):
    boxes = spark.createDataFrame([("m", *b) for b in _BOXES], "run string, box string, x0 int, y0 int, x1 int, y1 int")
    return I.box_traces(movie(spark, sf_dir), boxes, 0.2).select("box", "frame", *[r6(c, c) for c in ("lum", "me", "power", "area")])


_NEAR = "s AS (SELECT a.frame, a.y, a.x, any_value(a.v) AS v, coalesce(sum(b.v), 0) AS s FROM mv a LEFT JOIN mv b ON a.frame = b.frame AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND NOT (a.y = b.y AND a.x = b.x) GROUP BY a.frame, a.y, a.x), cm AS (SELECT y, x, coalesce(covar_pop(v, s) / nullif(stddev_pop(v) * stddev_pop(s), 0), 0) AS r FROM s GROUP BY y, x)"


@query(f"WITH {MV}, {_NEAR} SELECT y::INT AS y, x::INT AS x, round(r, 6) + 0.0 AS r FROM cm")
def neighbor_corr_map(spark, sf_dir):
    return I.correlation_map(I.to_frames(movie(spark, sf_dir))).select("y", "x", r6("r", "r"))


@query(f"WITH {MV}, {_NEAR} SELECT y::INT AS y, x::INT AS x, CASE WHEN y < 2 OR y > 5 OR x < 2 OR x > 5 THEN 0.0 ELSE round(r, 6) + 0.0 END AS r FROM cm")
def corr_border(spark, sf_dir):
    cmap = I.correlation_map(I.to_frames(movie(spark, sf_dir)))
    return I.zero_border(cmap, spark.createDataFrame([("m", 2)], "run string, b int")).select("y", "x", r6("r", "r"))


@query(f"""WITH {MV}, {_NEAR}, mi AS (SELECT y, x, avg(v) AS m FROM mv GROUP BY y, x), c AS (SELECT quantile_cont(m, 0.5) AS dim, quantile_cont(m, 0.99) AS bright FROM mi)
    SELECT round(quantile_cont(r, 0.99) FILTER (m < dim), 6) AS low, round(quantile_cont(r, 0.25) FILTER (m > bright), 6) AS high FROM cm JOIN mi USING (y, x), c""")
def threshold_window(spark, sf_dir):
    m = movie(spark, sf_dir)
    return I.threshold_window(I.correlation_map(I.to_frames(m)), I.mean_image(m)).select(F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query(f"WITH {MV} SELECT y::INT AS y, x::INT AS x, frame // 10 AS frame, round(avg(v), 6) + 0.0 AS v FROM mv GROUP BY y, x, frame // 10 HAVING count(*) = 10")
def movie_bins(spark, sf_dir):
    return I.bin_frames(movie(spark, sf_dir), 10).select("y", "x", "frame", r6("v", "v"))


#: Orders as recordings: anchors and numbers of frames from their keys, every third with a camera rate of its own.
_RUN_SQL = """rs AS (SELECT o_orderkey AS run, (o_custkey % 150)::INT AS "on", (o_custkey % 150 + 2000 + o_orderkey % 7000)::INT AS "off", 9200 AS n_cam, CASE WHEN o_orderkey % 3 = 0 THEN 10.0 + o_custkey % 25 END AS cam_fps,
    (o_totalprice / 1000.0)::DOUBLE AS t_last, 1 / 30.0::DOUBLE AS period FROM orders), rc AS (SELECT *, coalesce(1 / cam_fps, (t_last + period) / ("off" - "on"))::DOUBLE AS dt FROM rs)"""


def _cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    on, off = F.col("o_custkey") % 150, F.col("o_custkey") % 150 + 2000 + F.col("o_orderkey") % 7000
    fps = F.when(F.col("o_orderkey") % 3 == 0, (F.lit(10) + F.col("o_custkey") % 25).cast("double"))
    return A.camera_clock(o.select(F.col("o_orderkey").alias("run"), on.cast("int").alias("on"), off.cast("int").alias("off"), F.lit(9200).alias("n_cam"), fps.alias("cam_fps"), (F.col("o_totalprice") / 1000.0).alias("t_last"), F.lit(1 / 30.0).alias("period")))


@query(f"""WITH {_RUN_SQL} SELECT run, round(dt, 9) AS dt, round(("off" - "on") * dt, 6) AS coverage_end FROM rc""")
def camera_clocks(spark, sf_dir):
    return _cameras(spark, sf_dir).select("run", F.round("dt", 9).alias("dt"), F.round("coverage_end", 6).alias("coverage_end"))


@query(f"""WITH {_RUN_SQL}, fr AS (SELECT run, dt, "on", "off", unnest(range(0, 40)) * 7.5 AS t FROM rc) SELECT run, count(*) AS kept, round(max(t), 6) AS last, max((round_even(t / dt, 0))::BIGINT + "on") AS camera_frame FROM fr WHERE t <= ("off" - "on") * dt GROUP BY run HAVING count(*) >= 2""")
def coverage_cut(spark, sf_dir):
    cameras = _cameras(spark, sf_dir)
    long_enough = cameras.filter(F.col("coverage_end") >= 7.5)
    frames = long_enough.select("run", F.lit(40).alias("n"), F.lit(1 / 7.5).alias("fps"))
    kept = A.covered(A.neural_clock(frames).withColumn("t", F.col("frame") * 7.5), long_enough, many=True)
    near = A.nearest_camera_frame(F.col("t"), F.col("on"), F.col("dt"))
    return kept.join(cameras.select("run", "on", "dt").hint("shuffle_hash"), "run").groupBy("run").agg(F.count("*").alias("kept"), F.round(F.max("t"), 6).alias("last"), F.max(near).alias("camera_frame"))


# every ROI against every event channel


def behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, channel, frame, v): all events as means on the ROI clock, which spans them; a stored table."""
    d = timed_events(spark, sf_dir)
    span = d.agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    frames = table(spark, sf_dir, "embeddings").agg(F.max(F.size("embedding")).alias("n"))
    at = F.coalesce(F.floor(F.try_divide((F.col("t") - F.col("t0")) * F.col("n"), F.col("t1") - F.col("t0"))), F.lit(0))
    # tables of one row
    d = d.crossJoin(F.broadcast(span)).crossJoin(F.broadcast(frames))
    means = d.groupBy(F.lit("m").alias("run"), "channel", F.least(at, F.col("n") - 1).cast("bigint").alias("frame")).agg(F.avg("v").alias("v"))
    return stored(means, "behaviour")


BV = f"""{EV}, {RV}, sp AS (SELECT min(t) AS t0, max(t) AS t1, (SELECT max(frame) + 1 FROM rv) AS n FROM ev),
    bv AS (SELECT 'm' AS run, channel, least(coalesce(floor((t - t0) * n / nullif(t1 - t0, 0)), 0), n - 1)::BIGINT AS frame, avg(v) AS v FROM ev, sp GROUP BY ALL)"""


def _acf_sql(name: str, table: str) -> str:
    return f"""{name}c AS (SELECT channel, frame, v - avg(v) OVER (PARTITION BY channel) AS v FROM {table}), {name}s AS (SELECT a.channel, b.frame - a.frame AS lag, sum(a.v * b.v) AS s FROM {name}c a JOIN {name}c b ON a.channel = b.channel AND b.frame - a.frame BETWEEN 0 AND 15 GROUP BY ALL),
    {name} AS (SELECT channel, lag, coalesce(s / nullif(max(s) FILTER (lag = 0) OVER (PARTITION BY channel), 0), 0) AS r FROM {name}s)"""


@query(f"WITH {RV}, {_acf_sql('ar', 'rv')} SELECT channel, lag, round(r, 6) + 0.0 AS r FROM ar")
def acf(spark, sf_dir):
    return R.autocorrelation(rois(spark, sf_dir), 15).select("channel", F.col("lag").cast("bigint").alias("lag"), r6("r", "r"))


@query(f"""WITH {BV}, zr AS (SELECT channel, frame, coalesce((v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w, 0), 0) AS z FROM rv WINDOW w AS (PARTITION BY channel)), zb AS (SELECT channel, frame, coalesce((v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w, 0), 0) AS z FROM bv WINDOW w AS (PARTITION BY channel))
    SELECT a.channel AS roi, b.channel, a.frame - b.frame AS lag, round(sum(a.z * b.z) / (SELECT n FROM sp), 6) + 0.0 AS r FROM zr a JOIN zb b ON abs(a.frame - b.frame) <= 10 GROUP BY ALL""")
def xcorr_lags(spark, sf_dir):
    return R.cross_correlation(rois(spark, sf_dir), behaviour(spark, sf_dir), 10).select("roi", "channel", F.col("lag").cast("bigint").alias("lag"), r6("r", "r"))


@query(f"""WITH {BV}, {_acf_sql('ar', 'rv')}, {_acf_sql('ab', 'bv')}, b AS (SELECT x.channel AS roi, y.channel, x.lag, x.r * y.r AS p, x.r <= 0 OR y.r <= 0 AS stop FROM ar x JOIN ab y ON x.lag = y.lag AND x.lag > 0),
    c AS (SELECT *, coalesce(min(lag) FILTER (stop) OVER (PARTITION BY roi, channel), 16) AS k FROM b), n AS (SELECT roi, channel, (SELECT n FROM sp) / greatest(1 + 2 * coalesce(sum(p) FILTER (lag < k), 0), 1.0) AS n FROM c GROUP BY ALL)
    SELECT roi, channel, round(n, 5) AS n_eff, round(2 / sqrt(greatest(n - 3, 1.0)), 5) AS floor FROM n""")
def n_eff_floor(spark, sf_dir):
    return R.effective_n(rois(spark, sf_dir), behaviour(spark, sf_dir), 15).select("roi", "channel", F.round("n_eff", 5).alias("n_eff"), F.round("floor", 5).alias("floor"))


@query(f"WITH {BV} SELECT a.channel AS roi, b.channel, round(corr(a.v, b.v), 6) + 0.0 AS r FROM rv a JOIN bv b ON a.frame = b.frame GROUP BY ALL")
def roi_behaviour_corr(spark, sf_dir):
    return R.lag_zero(rois(spark, sf_dir), behaviour(spark, sf_dir)).select("roi", "channel", r6("r", "r"))


@query(f"WITH {BV}, c AS (SELECT a.channel AS roi, b.channel, corr(a.v, b.v) AS r FROM rv a JOIN bv b ON a.frame = b.frame GROUP BY ALL) SELECT channel, round(avg((abs(r) > 0.25)::INT), 6) AS fraction FROM c GROUP BY channel")
def fraction_above_floor(spark, sf_dir):
    return T.fraction_above(R.lag_zero(rois(spark, sf_dir), behaviour(spark, sf_dir)), "r", F.lit(0.25), ("channel",)).select("channel", F.round("fraction", 6).alias("fraction"))


def _event_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, frame, t): from the first event to the last, as many points as the fullest channel has events."""
    e = events(spark, sf_dir)
    most = e.groupBy("channel").count().agg(F.max("count").alias("n"))
    span = e.agg(F.min("t").alias("t0"), F.max("t").alias("t1")).crossJoin(most)
    points = span.filter("n > 0").withColumn("frame", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    return points.select(F.lit("r").alias("run"), "frame", (F.col("t0") + F.col("frame") * ((F.col("t1") - F.col("t0")) / F.col("n"))).alias("t"))


_CLOCK = f"""{EV}, gd AS (SELECT unnest(range(n)) AS frame, t0, t1, n FROM (SELECT min(t) AS t0, max(t) AS t1, (SELECT max(n) FROM (SELECT count(*) AS n FROM ev GROUP BY channel)) AS n FROM ev)),
    gc AS (SELECT channel, frame, t0 + frame * ((t1 - t0) / n) AS t FROM gd CROSS JOIN (SELECT DISTINCT channel FROM ev)),
    ip AS (SELECT g.channel, g.frame, g.t, CASE WHEN p.t = n.t THEN p.v ELSE (n.v - p.v) / (n.t - p.t) * (g.t - p.t) + p.v END AS v FROM gc g ASOF JOIN ev p ON g.channel = p.channel AND g.t >= p.t ASOF JOIN ev n ON g.channel = n.channel AND g.t <= n.t)"""


@query(f"WITH {_CLOCK} SELECT channel, frame, round(v, 6) + 0.0 AS v FROM ip")
def interp_align(spark, sf_dir):
    return A.interpolate(events(spark, sf_dir), _event_clock(spark, sf_dir)).select("channel", "frame", r6("v", "v"))


@query(f"""WITH {_CLOCK}, z AS (SELECT channel, count(*) AS n, count(*) FILTER (v IS NULL OR isnan(v) OR isinf(v)) AS bad FROM ip GROUP BY channel), k AS (SELECT frame, t, row_number() OVER (ORDER BY frame) AS i FROM (SELECT DISTINCT frame, t FROM ip)), c AS (SELECT * FROM k WHERE i <= (SELECT max(n) FROM z)),
    s AS (SELECT t - lag(t) OVER (ORDER BY frame) AS d FROM c)
    SELECT 'r' AS run, bool_and(n = (SELECT count(*) FROM c)) AS lengths, sum(bad) = 0 AS finite, (SELECT min(t) FROM c) = 0 AS starts_at_zero, (SELECT coalesce(min(d) > 0, true) FROM s) AS increasing FROM z""")
def gate_checks(spark, sf_dir):
    bundle = stored(A.interpolate(events(spark, sf_dir), _event_clock(spark, sf_dir)), "bundle")
    clock = bundle.select("run", "frame", "t").distinct()
    most = bundle.groupBy("run", "channel").count().groupBy("run").agg(F.max("count").alias("m"))
    first = clock.join(most, "run").withColumn("i", F.row_number().over(Window.partitionBy("run").orderBy("frame"))).filter("i <= m").select("run", "frame", "t")
    rows = R.structural_checks(bundle, first)
    return rows.groupBy("run").pivot("check", ["lengths", "finite", "starts_at_zero", "increasing"]).agg(F.first("ok"))


@query("SELECT channel FROM (SELECT event_type AS channel, user_id % 7 AS run FROM events GROUP BY ALL) GROUP BY channel HAVING count(*) = (SELECT count(DISTINCT user_id % 7) FROM events)")
def common_channels(spark, sf_dir):
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("run"), F.col("event_type").alias("channel"))
    return T.common_channels(e)


@query(f"WITH {EV}, {RV} SELECT 'me_' || channel AS channel, frame, round(v, 6) + 0.0 AS v FROM ev UNION ALL SELECT 'roi_' || channel, frame, round(v, 6) + 0.0 FROM rv")
def bundle_matrix(spark, sf_dir):
    return T.stacked(("me_", events(spark, sf_dir)), ("roi_", rois(spark, sf_dir))).select("channel", "frame", r6("v", "v"))


@query("SELECT l_orderkey % 20 AS box, count(*) AS n, round(avg(l_quantity), 6) AS mean, round(coalesce(stddev_pop(l_quantity), 0), 6) AS sd, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem GROUP BY 1")
def grouped_moments(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").groupBy((F.col("l_orderkey") % 20).alias("box"))
    r = X.safe_corr(F.col("l_quantity"), F.col("l_extendedprice"))
    return d.agg(F.count("*").alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean"), F.round(F.stddev_pop("l_quantity"), 6).alias("sd"), F.round(r, 6).alias("r"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(1, round_even(l_quantity * 0.5, 0))::INT AS frames FROM lineitem")
def half_even_frames(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem")
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", X.seconds_to_frames(F.col("l_quantity"), F.lit(0.5)).alias("frames"))


@query("""SELECT url, array_to_string(list_transform(regexp_extract_all(lower(url), '([0-9]+|[^0-9]+)', 1), lambda x: CASE WHEN regexp_full_match(x, '[0-9]+') THEN lpad(CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE ltrim(x, '0') END, 20, '0') ELSE x END), chr(1)) AS n,
    regexp_replace(url, '[\\s]+', '_', 'g') AS safe, substr(sha1(url), 1, 12) AS digest FROM pages""")
def text_keys(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("url", X.natural_key(u).alias("n"), X.safe_name(u).alias("safe"), X.params_hash_of(u).alias("digest"))


GMM = f"""{ENV}, q AS (SELECT channel, quantile_cont(v, 0.2) AS m0, quantile_cont(v, 0.8) AS m1, stddev_pop(v) / 2 + 1e-6 AS s0, count(*) AS n FROM env GROUP BY channel),
    em AS (SELECT channel, 0 AS it, m0, m1, s0, s0 AS s1, 0.5::DOUBLE AS w0, 0.5::DOUBLE AS w1, false AS stop FROM q UNION ALL
        SELECT channel, it + 1, CASE WHEN least(n0, n1) < 2 THEN m0 ELSE c0 END, CASE WHEN least(n0, n1) < 2 THEN m1 ELSE c1 END, CASE WHEN least(n0, n1) < 2 THEN s0 ELSE sqrt(greatest(v0 - c0 * c0, 0)) + 1e-6 END,
            CASE WHEN least(n0, n1) < 2 THEN s1 ELSE sqrt(greatest(v1 - c1 * c1, 0)) + 1e-6 END, CASE WHEN least(n0, n1) < 2 THEN w0 ELSE n0 / n END, CASE WHEN least(n0, n1) < 2 THEN w1 ELSE n1 / n END, least(n0, n1) < 2
        FROM (SELECT channel, any_value(it) AS it, any_value(m0) AS m0, any_value(m1) AS m1, any_value(s0) AS s0, any_value(s1) AS s1, any_value(w0) AS w0, any_value(w1) AS w1, count(*)::DOUBLE AS n, sum(r0) AS n0, sum(r1) AS n1,
                sum(r0 * v) / sum(r0) AS c0, sum(r1 * v) / sum(r1) AS c1, sum(r0 * v * v) / sum(r0) AS v0, sum(r1 * v * v) / sum(r1) AS v1
            FROM (SELECT *, d0 / (d0 + d1 + 1e-300) AS r0, d1 / (d0 + d1 + 1e-300) AS r1 FROM (
                SELECT em.*, v, w0 / s0 * exp(-0.5 * ((v - m0) / s0) ** 2) AS d0, w1 / s1 * exp(-0.5 * ((v - m1) / s1) ** 2) AS d1 FROM em JOIN env USING (channel) WHERE it < 400 AND NOT stop)) GROUP BY channel)),
    fi AS (SELECT channel, CASE WHEN m0 <= m1 THEN [m0, m1, s0, s1, w0, w1] ELSE [m1, m0, s1, s0, w1, w0] END AS p FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY it DESC) AS i FROM em) WHERE i = 1),
    fits AS (SELECT channel, p[1] AS mu0, p[2] AS mu1, p[3] AS sd0, p[4] AS sd1, p[5] AS w0, p[6] AS w1, (p[2] - p[1]) / nullif(sqrt(0.5 * (p[3] * p[3] + p[4] * p[4])), 0) AS dprime, p[1] + p[3] AS lo, 0.5 * (p[1] + p[2]) AS hi FROM fi)"""
_ADD = "(greatest({0}, {1}) + ln(1 + exp(-abs(({0}) - ({1})))))"
_STAY = [[0.75, 0.25], [0.125, 0.875]]
_M = [[f"ln({x})" for x in row] for row in _STAY]
#: Best path and posterior by recursion over frames, forwards and backwards.
PATHS = f"""{GMM}, ob AS (SELECT channel, frame, v, max(frame) OVER (PARTITION BY channel) AS last, -0.5 * ((v - mu0) / sd0) ** 2 - ln(sd0 * sqrt(2 * pi())) AS e0, -0.5 * ((v - mu1) / sd1) ** 2 - ln(sd1 * sqrt(2 * pi())) AS e1,
        ln(greatest(w0, 1e-12)) AS p0, ln(greatest(w1, 1e-12)) AS p1 FROM env JOIN fits USING (channel)),
    fw AS (SELECT channel, frame, p0 + e0 AS a0, p1 + e1 AS a1, p0 + e0 AS l0, p1 + e1 AS l1 FROM ob WHERE frame = 0 UNION ALL
        SELECT channel, ob.frame, greatest(a0 + {_M[0][0]}, a1 + {_M[1][0]}) + e0, greatest(a0 + {_M[0][1]}, a1 + {_M[1][1]}) + e1, {_ADD.format(f"l0 + {_M[0][0]}", f"l1 + {_M[1][0]}")} + e0, {_ADD.format(f"l0 + {_M[0][1]}", f"l1 + {_M[1][1]}")} + e1
        FROM fw JOIN ob USING (channel) WHERE ob.frame = fw.frame + 1),
    bw AS (SELECT channel, frame, e0, e1, 0::DOUBLE AS b0, 0::DOUBLE AS b1, 0::DOUBLE AS k0, 0::DOUBLE AS k1 FROM ob WHERE frame = last UNION ALL
        SELECT channel, ob.frame, ob.e0, ob.e1, greatest({_M[0][0]} + bw.e0 + b0, {_M[0][1]} + bw.e1 + b1), greatest({_M[1][0]} + bw.e0 + b0, {_M[1][1]} + bw.e1 + b1),
            {_ADD.format(f"{_M[0][0]} + bw.e0 + k0", f"{_M[0][1]} + bw.e1 + k1")}, {_ADD.format(f"{_M[1][0]} + bw.e0 + k0", f"{_M[1][1]} + bw.e1 + k1")} FROM bw JOIN ob USING (channel) WHERE ob.frame = bw.frame - 1),
    sv AS (SELECT fw.channel, fw.frame, (a1 + b1 > a0 + b0)::INT AS state, 1 / (1 + exp((l0 + k0) - (l1 + k1))) AS posterior FROM fw JOIN bw ON fw.channel = bw.channel AND fw.frame = bw.frame)"""


@query(f"WITH RECURSIVE {GMM} SELECT channel, {', '.join(f'round({c}, 6) + 0.0 AS {c}' for c in ('mu0', 'mu1', 'sd0', 'sd1', 'w0', 'w1', 'dprime'))} FROM fits")
def gmm_two_state(spark, sf_dir):
    return M.separation(M.fit(envelope(spark, sf_dir))).select("channel", *[r6(c, c) for c in ("mu0", "mu1", "sd0", "sd1", "w0", "w1", "dprime")])


@query(f"WITH RECURSIVE {PATHS} SELECT channel, frame, state, round(posterior, 6) + 0.0 AS posterior FROM sv")
def viterbi_states(spark, sf_dir):
    return M.decode(envelope(spark, sf_dir), 4, 8).select("channel", "frame", "state", r6("posterior", "posterior"))


@query(f"""WITH RECURSIVE {GMM}, j AS (SELECT env.channel, ev.v, env.v > hi AS up, fits.* EXCLUDE (channel) FROM env JOIN ev ON ev.channel = env.channel AND ev.frame = env.frame JOIN fits ON fits.channel = env.channel)
    SELECT channel, round(any_value(dprime), 6) + 0.0 AS dprime, round(any_value(w1), 6) + 0.0 AS w1, round(quantile_cont(v, 0.5) FILTER (NOT up), 6) AS rest, round(quantile_cont(v, 0.5) FILTER (up), 6) AS active,
        round(quantile_cont(v, 0.5) FILTER (up) / nullif(quantile_cont(v, 0.5) FILTER (NOT up), 0), 6) AS ratio FROM j GROUP BY channel""")
def channel_signals(spark, sf_dir):
    return M.signal_table(stored_envelope(spark, sf_dir), events(spark, sf_dir)).select("channel", r6("dprime", "dprime"), r6("w1", "w1"), *[F.round(c, 6).alias(c) for c in ("rest", "active", "ratio")])


#: Both detectors of bouts on the mixtures' levels, and their labels.
DETECTED = f"""{PATHS}, rn AS (SELECT channel, frame, frame - row_number() OVER (PARTITION BY channel ORDER BY frame) AS i FROM sv WHERE state = 1), ru AS (SELECT channel, min(frame) AS a, max(frame) AS b FROM rn GROUP BY channel, i),
    rf AS (SELECT *, coalesce(a - lag(b) OVER (PARTITION BY channel ORDER BY a) - 1 > 4, true)::INT AS f FROM ru), rg AS (SELECT *, sum(f) OVER (PARTITION BY channel ORDER BY a) AS g FROM rf), rm AS (SELECT channel, min(a) AS a, max(b) AS b FROM rg GROUP BY channel, g HAVING max(b) - min(a) + 1 >= 6),
    wl AS (SELECT env.channel, frame, v, hi, lo, max(CASE WHEN v <= lo THEN frame END) OVER (PARTITION BY env.channel ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pl FROM env JOIN fits USING (channel)),
    db AS (SELECT rm.channel, greatest(a - 30, coalesce(pl + 1, 0)) AS onset, b AS "offset" FROM rm JOIN wl ON wl.channel = rm.channel AND wl.frame = a),
    cx AS (SELECT *, v > hi AS up, v < lo AS down FROM wl), cs AS (SELECT *, sum((up AND down)::INT) OVER w AS t, max(frame) FILTER (up <> down) OVER w AS k FROM cx WINDOW w AS (PARTITION BY channel ORDER BY frame)),
    cu AS (SELECT cs.*, (coalesce(z.up::INT, 0) + cs.t - coalesce(z.t, 0)) % 2 AS st FROM cs LEFT JOIN cs z ON z.channel = cs.channel AND z.frame = cs.k), ce AS (SELECT *, st = 1 AND coalesce(lag(st) OVER (PARTITION BY channel ORDER BY frame), 0) = 0 AS e, max(frame) OVER (PARTITION BY channel) AS lf FROM cu),
    cg AS (SELECT *, sum(e::INT) OVER (PARTITION BY channel ORDER BY frame) AS g FROM ce), ch AS (SELECT channel, max(CASE WHEN e THEN greatest(frame - 30, coalesce(pl + 1, 0)) END) AS onset, least(max(frame) + 1, max(lf)) AS "offset" FROM cg WHERE st = 1 GROUP BY channel, g),
    cf AS (SELECT *, coalesce(onset - lag("offset") OVER (PARTITION BY channel ORDER BY onset) - 1 > 4, true)::INT AS f FROM ch), ck AS (SELECT *, sum(f) OVER (PARTITION BY channel ORDER BY onset) AS g FROM cf),
    cb AS (SELECT channel, min(onset) AS onset FROM ck GROUP BY channel, g HAVING max("offset") - min(onset) + 1 >= 6),
    dt AS (SELECT db.channel, onset, "offset", max(wl.v) AS top, avg(posterior) AS posterior FROM db JOIN wl ON wl.channel = db.channel AND wl.frame BETWEEN onset AND "offset" JOIN sv ON sv.channel = wl.channel AND sv.frame = wl.frame GROUP BY ALL),
    dp AS (SELECT db.channel, onset, count(*) FILTER (v < lo) = 15 AS ok FROM db JOIN wl ON wl.channel = db.channel AND frame >= onset - 15 AND frame < onset GROUP BY ALL),
    da AS (SELECT db.channel, onset, bool_or(e.v > p) AS hit FROM db, env e, (SELECT quantile_cont(v, 0.995) AS p FROM env WHERE channel = 'error') WHERE e.channel = 'error' AND e.frame >= onset - 2 AND e.frame < onset + 3 GROUP BY ALL),
    dc AS (SELECT db.channel, onset, bool_or(wl.v > wl.lo) AS busy FROM db JOIN wl ON wl.channel IN ('click', 'purchase') AND wl.channel <> db.channel AND wl.frame BETWEEN onset - 15 AND onset + 15 GROUP BY ALL),
    dx AS (SELECT db.channel, db.onset, min(abs(cb.onset - db.onset)) AS near FROM db JOIN cb ON cb.channel = db.channel GROUP BY ALL)"""


@query(f"""WITH RECURSIVE {DETECTED} SELECT dt.channel, dt.onset, "offset", round(("offset" - dt.onset + 1) / 15.0, 3) AS duration_s, round(top - mu0, 6) + 0.0 AS amplitude, coalesce(ok, false) AS baseline_pre, coalesce(hit, false) AS artifact, coalesce(NOT busy, false) AS isolated,
        coalesce(near, -1)::BIGINT AS xcheck_frames, round(posterior, 6) + 0.0 AS posterior
    FROM dt JOIN fits ON fits.channel = dt.channel LEFT JOIN dp ON dp.channel = dt.channel AND dp.onset = dt.onset LEFT JOIN da ON da.channel = dt.channel AND da.onset = dt.onset LEFT JOIN dc ON dc.channel = dt.channel AND dc.onset = dt.onset LEFT JOIN dx ON dx.channel = dt.channel AND dx.onset = dt.onset""")
def detected_bouts(spark, sf_dir):
    found = M.detect(events(spark, sf_dir), None, 15.0, artifact="error", others=("click", "purchase"))
    return found["bouts"].select("channel", "onset", "offset", "duration_s", r6("amplitude", "amplitude"), "baseline_pre", "artifact", "isolated", "xcheck_frames", r6("posterior", "posterior"))


@query(f"""WITH RECURSIVE {MV}, {_NEAR}, px AS (SELECT (y * 8 + x + 1)::INT AS i, frame, v FROM mv), cv AS (SELECT a.i, b.i AS j, covar_pop(a.v, b.v) AS c FROM px a JOIN px b USING (frame) GROUP BY ALL),
    cc AS (SELECT list(line ORDER BY i) AS cov FROM (SELECT i, list(c ORDER BY j) AS line FROM cv GROUP BY i)), rr AS (SELECT list(r ORDER BY y * 8 + x) AS rs FROM cm),
    g AS (SELECT 0 AS attempt, list_transform(rs, lambda r: r <> 0) AS free, []::BIGINT[] AS region, NULL::BIGINT[] AS grown FROM rr UNION ALL
        SELECT attempt + ended::INT, CASE WHEN ended THEN list_transform(range(1, 65), lambda i: free[i] AND NOT list_contains(region, i)) ELSE free END,
            CASE WHEN ended THEN []::BIGINT[] WHEN len(region) = 0 THEN [seed] ELSE region || good END, CASE WHEN ended THEN region END
        FROM (SELECT *, len(region) > 0 AND len(good) = 0 AS ended FROM (SELECT attempt, free, region,
            list_sort(list_transform(list_filter(range(1, 65), lambda i: free[i]), lambda i: {{'r': -rs[i], 'i': i}}))[1].i AS seed,
            CASE WHEN len(region) = 0 OR len(region) >= 40 THEN []::BIGINT[] ELSE list_filter(range(1, 65), lambda i: free[i] AND NOT list_contains(region, i)
                AND len(list_filter(region, lambda q: abs((q - 1) // 8 - (i - 1) // 8) <= 1 AND abs((q - 1) % 8 - (i - 1) % 8) <= 1)) > 0
                AND list_sum(list_transform(region, lambda q: cov[q][i])) / len(region) > 0.02 * sqrt(greatest(0, list_sum(list_transform(region, lambda q: list_sum(list_transform(region, lambda p: cov[q][p]))))) / (len(region) * len(region)) * cov[i][i])) END AS good
            FROM g, cc, rr WHERE attempt < 100 AND (len(region) > 0 OR list_bool_or(free))))),
    kept AS (SELECT row_number() OVER (ORDER BY attempt) AS roi, grown FROM g WHERE len(grown) > 1 AND len(grown) < 20)
    SELECT 'm' AS run, roi, (i - 1) // 8 AS y, (i - 1) % 8 AS x FROM (SELECT roi, unnest(grown) AS i FROM kept)""")
def roi_growth(spark, sf_dir):
    frames = I.to_frames(movie(spark, sf_dir))
    return I.regions(frames, I.correlation_map(frames), 0.02, 1, 20)


def _shift_sql(sigma: float) -> str:
    """Sums over frequencies in place of transforms: the peak of the cross-correlation, then a grid of tenths around it."""
    near = f"exp(-2 * (pi() * {sigma} * fu) ** 2) * exp(-2 * (pi() * {sigma} * fv) ** 2)" if sigma else "1.0"
    return f"""{MV}, mi AS (SELECT y, x, avg(v) AS m FROM mv GROUP BY ALL), uv AS (SELECT u, v, CASE WHEN u < 4 THEN u ELSE u - 8 END / 8.0 AS fu, CASE WHEN v < 4 THEN v ELSE v - 8 END / 8.0 AS fv FROM (SELECT unnest(range(8)) AS u), (SELECT unnest(range(8)) AS v)),
        tf AS (SELECT u, uv.v, any_value(fu) AS fu, any_value(fv) AS fv, sum(m * cos(2 * pi() * (u * y + uv.v * x) / 8)) * any_value({near}) AS a, -sum(m * sin(2 * pi() * (u * y + uv.v * x) / 8)) * any_value({near}) AS b FROM mi, uv GROUP BY ALL),
        im AS (SELECT frame, u, uv.v, sum(mv.v * cos(2 * pi() * (u * y + uv.v * x) / 8)) * any_value({near}) AS a, -sum(mv.v * sin(2 * pi() * (u * y + uv.v * x) / 8)) * any_value({near}) AS b FROM mv, uv GROUP BY frame, u, uv.v),
        pr AS (SELECT frame, u, v, fu, fv, tf.a * im.a + tf.b * im.b AS re, tf.b * im.a - tf.a * im.b AS mi FROM im JOIN tf USING (u, v)),
        co AS (SELECT frame, uv.u AS y, uv.v AS x, sum(re * cos(2 * pi() * (pr.u * uv.u + pr.v * uv.v) / 8) - mi * sin(2 * pi() * (pr.u * uv.u + pr.v * uv.v) / 8)) AS a, sum(re * sin(2 * pi() * (pr.u * uv.u + pr.v * uv.v) / 8) + mi * cos(2 * pi() * (pr.u * uv.u + pr.v * uv.v) / 8)) AS b FROM pr, uv GROUP BY frame, uv.u, uv.v),
        pk AS (SELECT frame, CASE WHEN y > 4 THEN y - 8 ELSE y END AS cy, CASE WHEN x > 4 THEN x - 8 ELSE x END AS cx FROM (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY round(a * a + b * b, 12) DESC, y, x) AS i FROM co) WHERE i = 1),
        ky AS (SELECT unnest(range(-7, 8)) / 10.0 AS oy), rw AS (SELECT pr.frame, cy + oy AS dy, any_value(cx) AS cx, pr.v, any_value(fv) AS fv, sum(re * cos(2 * pi() * (cy + oy) * fu) - mi * sin(2 * pi() * (cy + oy) * fu)) AS a, sum(re * sin(2 * pi() * (cy + oy) * fu) + mi * cos(2 * pi() * (cy + oy) * fu)) AS b FROM pr JOIN pk USING (frame), ky GROUP BY pr.frame, cy + oy, pr.v),
        gr AS (SELECT frame, dy, cx + oy AS dx, sum(a * cos(2 * pi() * (cx + oy) * fv) - b * sin(2 * pi() * (cx + oy) * fv)) AS p, sum(a * sin(2 * pi() * (cx + oy) * fv) + b * cos(2 * pi() * (cx + oy) * fv)) AS q FROM rw, ky GROUP BY frame, dy, cx + oy)
        SELECT 'm' AS run, frame, round(dy, 3) + 0.0 AS dy, round(dx, 3) + 0.0 AS dx FROM (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY round(p * p + q * q, 12) DESC, dy, dx) AS i FROM gr) WHERE i = 1"""


def _shifts(spark: SparkSession, sf_dir: str, smooth: float) -> DataFrame:
    frames = I.to_frames(movie(spark, sf_dir))
    found = I.estimate_shifts(frames, I.template_of(frames), smooth=smooth)
    return found.select("run", "frame", *[(F.round(c, 3) + 0.0).alias(c) for c in ("dy", "dx")])


@query(f"WITH {_shift_sql(1.0)}")
def smoothed_shifts(spark, sf_dir):
    return _shifts(spark, sf_dir, 1.0)


@query(f"WITH {_shift_sql(0.0)}")
def rigid_shifts(spark, sf_dir):
    return _shifts(spark, sf_dir, 0.0)


@query()
def low_rank_movie(spark, sf_dir):
    return I.low_rank(movie(spark, sf_dir), 5).select("y", "x", "frame", r6("v", "v"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tracelake.plans import checks, derived, recordings  # noqa: F401  they register their queries

    return {name: f for name, (f, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    queries()
    return {name: sql for name, (_, sql) in _FOUND.items() if sql}
