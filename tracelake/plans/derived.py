"""More registered queries: events and what surrounds them, filters, regions, lags and units."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.functions import expressions as X
from tracelake.operators import alignment as A
from tracelake.operators import correlation as R
from tracelake.operators import images as I
from tracelake.operators import models as M
from tracelake.operators import sequence as S
from tracelake.operators import statistics as T
from tracelake.plans.queries import BOUTS, BV, EV, GAP, HYST, KEYS, LEAST, LEVELS, MV, RV, behaviour, bouts, events, levelled, movie, query, r6, rois, stored_envelope, table
from tracelake.sources import metadata
from tracelake.sources.shared import stored


@query(f"""WITH {BOUTS}, pos AS (SELECT channel, frame FROM ev)
    SELECT pos.channel, frame, max(onset) FILTER (onset < frame) AS previous, min(onset) FILTER (onset > frame) AS next FROM pos LEFT JOIN bt USING (channel) GROUP BY ALL""")
def next_and_previous_bouts(spark, sf_dir):
    return S.next_event(bouts(spark, sf_dir), events(spark, sf_dir)).select("channel", "frame", "previous", "next")


@query(f"""WITH {BOUTS}, pl AS (SELECT channel, onset + 3 AS planted FROM bt), m AS (SELECT pl.channel, planted, arg_min(onset, abs(onset - planted) * 100000000 + onset) AS found FROM pl LEFT JOIN bt ON bt.channel = pl.channel AND abs(onset - planted) <= 8 GROUP BY ALL)
    SELECT channel, planted, found, found - planted AS bias FROM m""")
def matched_bouts(spark, sf_dir):
    found = stored(bouts(spark, sf_dir), "bouts")
    return S.matched(found.withColumn("onset", F.col("onset") + 3), found, 8).select("channel", "planted", "found", "bias")


@query(f"""WITH {HYST}, far AS (SELECT *, coalesce(onset - lag("offset") OVER (PARTITION BY channel ORDER BY onset) > {GAP}, true)::INT AS f FROM hy), mg AS (SELECT *, sum(f) OVER (PARTITION BY channel ORDER BY onset) AS g FROM far)
    SELECT channel, min(onset) AS onset, max("offset") AS "offset" FROM mg GROUP BY channel, g HAVING max("offset") - min(onset) >= {LEAST}""")
def merge_by_plain_differences(spark, sf_dir):
    return S.merge_intervals(S.hysteresis_runs(levelled(spark, sf_dir), F.col("hi"), F.col("lo")), GAP, LEAST, inclusive=False).select("channel", "onset", "offset")


@query(f"""WITH {LEVELS}, x AS (SELECT channel, frame, v > lo AS a, v < hi AS b, v <= hi AS low FROM env JOIN lv USING (channel)), s AS (SELECT *, sum((a AND b)::INT) OVER w AS t, max(frame) FILTER (a <> b) OVER w AS k, max(CASE WHEN low THEN frame END) OVER (PARTITION BY channel ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pl FROM x WINDOW w AS (PARTITION BY channel ORDER BY frame)),
    u AS (SELECT s.*, (coalesce(z.a::INT, 0) + s.t - coalesce(z.t, 0)) % 2 AS st FROM s LEFT JOIN s z ON z.channel = s.channel AND z.frame = s.k), e AS (SELECT *, st = 1 AND coalesce(lag(st) OVER (PARTITION BY channel ORDER BY frame), 0) = 0 AS e, max(frame) OVER (PARTITION BY channel) AS lf FROM u),
    g AS (SELECT *, sum(e::INT) OVER (PARTITION BY channel ORDER BY frame) AS g FROM e) SELECT channel, max(CASE WHEN e THEN greatest(frame - 30, coalesce(pl + 1, 0)) END) AS onset, least(max(frame) + 1, max(lf)) AS "offset" FROM g WHERE st = 1 GROUP BY channel, g""")
def crossed_hysteresis(spark, sf_dir):
    """The upper level is below the lower one: states turn over from frame to frame."""
    return S.hysteresis_runs(levelled(spark, sf_dir), F.col("lo"), F.col("hi")).select("channel", "onset", "offset")


@query(f"""WITH {BOUTS}, n AS (SELECT channel, max(frame) + 1 AS n FROM env GROUP BY channel), ok AS (SELECT bt.* FROM bt JOIN n USING (channel) WHERE onset - 30 >= 0 AND onset + 30 < n),
    av AS (SELECT ok.channel, frame - onset AS k, avg(v) AS mean FROM ok JOIN env USING (channel) WHERE frame >= onset - 30 AND frame < onset + 30 GROUP BY ALL),
    l AS (SELECT channel, avg(mean) FILTER (k / 15.0 < -1) AS base, max(mean) FILTER (k > 0 AND k / 15.0 < 1) AS peak FROM av GROUP BY channel)
    SELECT channel, round(any_value(base), 6) + 0.0 AS base, round(any_value(peak), 6) + 0.0 AS peak, round(min(k / 15.0)::DOUBLE, 6) + 0.0 AS half_rise_s FROM av JOIN l USING (channel) WHERE mean > base + 0.5 * (peak - base) GROUP BY channel""")
def half_rise(spark, sf_dir):
    env = stored_envelope(spark, sf_dir)
    average = stored(S.event_average(bouts(spark, sf_dir, env), env, 30), "average")
    return S.half_rise(average, 15.0).select("channel", r6("base", "base"), r6("peak", "peak"), r6("half_rise_s", "half_rise_s"))


@query(f"""WITH {EV}, n AS (SELECT channel, frame, lag(v) OVER w AS a, v AS b, lead(v) OVER w AS c FROM ev WINDOW w AS (PARTITION BY channel ORDER BY frame)), m AS (SELECT channel, frame, list_sort([a, b, c])[2] AS v FROM n WHERE a IS NOT NULL AND c IS NOT NULL),
    d AS (SELECT channel, frame, v - lag(v) OVER (PARTITION BY channel ORDER BY frame) AS d FROM m), k AS (SELECT channel, frame, row_number() OVER (PARTITION BY channel ORDER BY d DESC, frame) AS up, row_number() OVER (PARTITION BY channel ORDER BY d, frame) AS down FROM d WHERE d IS NOT NULL)
    SELECT channel, max(frame) FILTER (up = 1) AS up, max(frame) FILTER (down = 1) AS down FROM k GROUP BY channel""")
def steepest_edges(spark, sf_dir):
    return S.steepest_edges(events(spark, sf_dir)).select("channel", "up", "down")


_TAPER = "tp AS (SELECT channel, frame, v, sum(v) OVER (PARTITION BY channel ORDER BY frame ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) / 9 AS m FROM ev)"


@query(f"WITH {EV}, {_TAPER} SELECT channel, frame, round(m, 6) + 0.0 AS v FROM tp")
def tapering_mean(spark, sf_dir):
    return S.zero_phase_mean(events(spark, sf_dir), 9, "taper").select("channel", "frame", r6("v", "v"))


@query(f"WITH {EV}, {_TAPER} SELECT channel, frame, round(v - m, 6) + 0.0 AS v FROM tp")
def highpass(spark, sf_dir):
    return S.highpass(events(spark, sf_dir), 9).select("channel", "frame", r6("v", "v"))


@query(f"""WITH {EV}, la AS (SELECT channel, max(frame) AS last FROM ev GROUP BY channel), ke AS (SELECT o, exp(-0.5 * ((o - 0.5) / 2.0) ** 2) AS w FROM (SELECT unnest(range(-3, 5)) AS o)),
    ask AS (SELECT channel, frame, w, CASE WHEN frame + o < 0 THEN -1 - frame - o WHEN frame + o > last THEN 2 * last + 1 - frame - o ELSE frame + o END AS f FROM ev JOIN la USING (channel), ke)
    SELECT ask.channel, ask.frame, round(sum(w * ev.v) / (SELECT sum(w) FROM ke), 6) + 0.0 AS v FROM ask JOIN ev ON ev.channel = ask.channel AND ev.frame = ask.f GROUP BY ALL""")
def gaussian_smoothing(spark, sf_dir):
    return S.gaussian_mean(events(spark, sf_dir), 2.0).select("channel", "frame", r6("v", "v"))


@query(f"WITH {BOUTS}, k AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY onset) - 1 AS i, count(*) OVER (PARTITION BY channel) AS n FROM bt), w AS (SELECT DISTINCT channel, (p * (n - 1)) // 4 AS i FROM k, range(5) r(p)) SELECT channel, onset, \"offset\" FROM k JOIN w USING (channel, i)")
def spaced_bouts(spark, sf_dir):
    return S.spaced_examples(bouts(spark, sf_dir), 5).select("channel", "onset", "offset")


@query(f"WITH {LEVELS} SELECT channel, round(avg((v > hi)::INT), 6) + 0.0 AS duty FROM env JOIN lv USING (channel) GROUP BY channel")
def occupancy(spark, sf_dir):
    return T.occupancy(levelled(spark, sf_dir), F.col("v") > F.col("hi")).select("channel", r6("duty", "duty"))


@query(f"WITH {EV} SELECT channel, frame, round(v, 6) AS v FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY v DESC, frame) AS i FROM ev) WHERE i = 1")
def largest_events(spark, sf_dir):
    return T.first_argmax(events(spark, sf_dir), "v", ("frame",), ("channel",)).select("channel", "frame", F.round("v", 6).alias("v"))


_CC = """zr AS (SELECT channel, frame, coalesce((v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w, 0), 0) AS z FROM rv WINDOW w AS (PARTITION BY channel)), zb AS (SELECT channel, frame, coalesce((v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w, 0), 0) AS z FROM bv WINDOW w AS (PARTITION BY channel))"""


@query(f"""WITH {BV}, {_CC}, c AS (SELECT a.channel AS roi, b.channel, a.frame - b.frame AS lag, sum(a.z * b.z) / 64 AS r FROM zr a JOIN zb b ON abs(a.frame - b.frame) <= 10 GROUP BY ALL), m AS (SELECT channel, lag, avg(abs(r)) AS s FROM c GROUP BY ALL)
    SELECT channel, lag, round(s, 6) AS strength FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY s DESC, lag) AS i FROM m) WHERE i = 1""")
def peak_lags(spark, sf_dir):
    return R.peak_lag(R.cross_correlation(rois(spark, sf_dir), behaviour(spark, sf_dir), 10)).select("channel", "lag", F.round("strength", 6).alias("strength"))


@query(f"""WITH {BV}, {_CC}, c AS (SELECT a.channel AS roi, b.channel, a.frame - b.frame AS lag, sum(a.z * b.z) / 64 AS r FROM zr a JOIN zb b ON a.frame - b.frame BETWEEN 20 AND 43 GROUP BY ALL), m AS (SELECT channel, lag, avg(r) AS r FROM c GROUP BY ALL)
    SELECT channel, round(quantile_cont(abs(r), 0.95), 6) AS band FROM m GROUP BY channel""")
def null_bands(spark, sf_dir):
    null = R.shift_null(rois(spark, sf_dir), behaviour(spark, sf_dir), 20, 43)
    return R.null_band(null).select("channel", F.round("band", 6).alias("band"))


@query(f"""WITH {BV}, sh AS (SELECT unnest([-0.5, 0.0, 0.5]) AS s), ac AS (SELECT b.channel, f.frame, s, CASE WHEN s = 0 THEN b.v ELSE 0.5 * b.v + 0.5 * c.v END AS v
        FROM (SELECT DISTINCT frame FROM rv) f, sh, bv b LEFT JOIN bv c ON c.channel = b.channel AND c.frame = b.frame + 1 WHERE b.frame = floor(f.frame + s) AND (s = 0 OR c.v IS NOT NULL)),
    r AS (SELECT ac.channel, rv.channel AS roi, s, abs(coalesce(covar_pop(rv.v, ac.v) / nullif(stddev_pop(rv.v) * stddev_pop(ac.v), 0), 0)) AS r FROM ac JOIN rv USING (frame) GROUP BY ALL)
    SELECT channel, s AS shift, round(avg(r), 6) AS strength FROM r GROUP BY ALL""")
def shift_curve(spark, sf_dir):
    neural = rois(spark, sf_dir).withColumn("t", F.col("frame").cast("double"))
    return A.shift_curve(neural, behaviour(spark, sf_dir), 0, 1.0, [-0.5, 0.0, 0.5]).select("channel", "shift", F.round("strength", 6).alias("strength"))


@query(f"""WITH {EV}, n AS (SELECT channel, count(*) AS n FROM ev GROUP BY channel), f AS (SELECT ev.channel, n, k, sum((v - m) * h * cos(2 * pi() * k * frame / n)) AS re, sum((v - m) * h * sin(2 * pi() * k * frame / n)) AS im
        FROM (SELECT ev.*, n, avg(v) OVER (PARTITION BY channel) AS m, 0.5 - 0.5 * cos(2 * pi() * frame / (n - 1)) AS h FROM ev JOIN n USING (channel)) ev, LATERAL (SELECT unnest(range(1, n // 2 + 1)) AS k) GROUP BY ALL),
    p AS (SELECT channel, k * 15.0 / n AS hz, re * re + im * im AS p FROM f)
    SELECT channel, round(arg_max(hz, p), 6) AS peak_hz, round(100 * sum(p) FILTER (hz < 1) / sum(p), 6) AS slow, round(100 * sum(p) FILTER (hz >= 1 AND hz < 8) / sum(p), 6) AS fast FROM p GROUP BY channel""")
def band_power(spark, sf_dir):
    return M.band_power(M.periodogram(events(spark, sf_dir), 15.0), {"slow": (0.0, 1.0), "fast": (1.0, 8.0)}).select("channel", *[F.round(c, 6).alias(c) for c in ("peak_hz", "slow", "fast")])


# images

_ROI = "rp AS (SELECT DISTINCT label AS roi, (i - 1) // 8 AS y, (i - 1) % 8 AS x FROM (SELECT label, embedding, unnest(range(1, 65)) AS i FROM embeddings) WHERE embedding[i] > 0.25)"


def roi_pixels(spark, sf_dir):
    """(run, roi, y, x): pixels that are bright in an image with the ROI's label."""
    flat = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "v")).filter("v > 0.25")
    return flat.select(F.lit("m").alias("run"), F.col("label").alias("roi"), F.expr("cast(i div 8 as int)").alias("y"), F.expr("cast(i % 8 as int)").alias("x")).distinct()


@query(f"""WITH {_ROI}, c AS (SELECT roi, count(*) AS npix, avg(x) AS cx, avg(y) AS cy FROM rp GROUP BY roi)
    SELECT roi, npix, round(cx, 6) AS cx, round(cy, 6) AS cy, round(2 * sqrt(npix / pi()) * 1.5, 6) AS diameter_um, npix > 1.7 * (SELECT quantile_cont(npix, 0.5) FROM c) AS merged FROM c""")
def roi_sizes(spark, sf_dir):
    return I.roi_table(roi_pixels(spark, sf_dir), 1.5).select("roi", "npix", *[F.round(c, 6).alias(c) for c in ("cx", "cy", "diameter_um")], "merged")


@query(f"WITH {_ROI} SELECT dense_rank() OVER (ORDER BY roi)::INT AS roi, y::INT AS y, x::INT AS x FROM rp")
def dense_labels(spark, sf_dir):
    return I.dense_labels(roi_pixels(spark, sf_dir)).select("roi", "y", "x")


@query(f"WITH {MV}, {_ROI} SELECT roi, frame, round(sum(v), 5) + 0.0 AS f FROM mv JOIN rp USING (y, x) GROUP BY ALL")
def roi_sums(spark, sf_dir):
    return I.roi_traces(movie(spark, sf_dir), roi_pixels(spark, sf_dir)).select("roi", "frame", (F.round("f", 5) + 0.0).alias("f"))


@query(f"""WITH {MV}, a AS (SELECT y, x, avg(v) FILTER (frame % 2 = 0) AS a, avg(v) FILTER (frame % 2 = 1) AS b FROM mv GROUP BY ALL) SELECT y::INT AS y, x::INT AS x, round(a - b, 6) + 0.0 AS v FROM a""")
def image_difference(spark, sf_dir):
    m = movie(spark, sf_dir)
    return I.subtract(I.mean_image(m.filter("frame % 2 = 0")), I.mean_image(m.filter("frame % 2 = 1"))).select("y", "x", r6("v", "v"))


@query(f"""WITH {MV}, mi AS (SELECT y, x, avg(v) AS m FROM mv GROUP BY ALL), cm AS (SELECT y, x, coalesce(corr(v, lv), 0) AS r FROM (SELECT *, lag(v) OVER (PARTITION BY y, x ORDER BY frame) AS lv FROM mv) GROUP BY ALL), {_ROI}, u AS (SELECT DISTINCT y, x FROM rp),
    b AS (SELECT r, u.y IS NOT NULL AS used FROM cm JOIN mi USING (y, x) LEFT JOIN u ON u.y = cm.y AND u.x = cm.x WHERE m > (SELECT quantile_cont(m, 0.99) FROM mi))
    SELECT count(*) FILTER (used) AS claimed, count(*) FILTER (NOT used) AS unclaimed, coalesce(abs(quantile_cont(r, 0.5) FILTER (used) - quantile_cont(r, 0.5) FILTER (NOT used)) < 0.08, false) AS cells_missed FROM b""")
def extraction_audit(spark, sf_dir):
    m = movie(spark, sf_dir)
    before = m.select("run", (F.col("frame") + 1).alias("frame"), "y", "x", F.col("v").alias("b"))
    # any map will do: here each pixel against itself one frame earlier
    cmap = m.join(before, ["run", "frame", "y", "x"]).groupBy("run", "y", "x").agg(X.safe_corr(F.col("v"), F.col("b")).alias("r"))
    return I.extraction_audit(cmap, I.mean_image(m), roi_pixels(spark, sf_dir)).select("claimed", "unclaimed", "cells_missed")


@query(f"WITH {RV}, t AS (SELECT channel, v - 10 AS v FROM rv), f AS (SELECT channel, quantile_cont(v, 0.15) AS f0 FROM t GROUP BY channel) SELECT channel AS roi, round(f0, 6) AS f0 FROM f WHERE f0 <= 0")
def bad_baselines(spark, sf_dir):
    traces = rois(spark, sf_dir).select("run", F.col("channel").alias("roi"), "frame", (F.col("v") - 10).alias("f"))
    return I.bad_baselines(I.dff_traces(traces)).select("roi", F.round("f0", 6).alias("f0"))


@query(f"""WITH {RV}, f AS (SELECT channel, quantile_cont(v, 0.15) AS f0 FROM rv GROUP BY channel)
    SELECT channel, frame, round((v - f0) / greatest(f0, 1e-6), 6) + 0.0 AS denominator, round((v - f0) / nullif(f0, 0), 6) + 0.0 AS plain FROM rv JOIN f USING (channel)""")
def dff_modes(spark, sf_dir):
    d = rois(spark, sf_dir)
    both = d.join(T.percentiles(d, {"f0": 0.15}), KEYS)
    return both.select("channel", "frame", *[r6(X.dff(F.col("v"), F.col("f0"), mode), mode) for mode in ("denominator", "plain")])


# units


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(1, round_even(l_quantity / 6.0, 0))::INT AS bin, round_even(pi() / 4 * (l_quantity / 1.5) ** 2, 0)::INT AS area, round(2 * sqrt(l_quantity / pi()) * 1.5, 6) AS diameter,
    (l_orderkey * 4294967296 + l_partkey)::BIGINT AS ns, round(l_quantity * l_tax, 6) AS t, round(least(greatest(l_extendedprice, 2000), 50000), 6) AS clipped, round(100 * abs((l_extendedprice - 30000.0) / 30000.0), 6) AS error_percent,
    round(greatest(1, l_quantity / 15.0), 6) AS upsampled, round(1e6 / l_quantity, 6) AS ppm FROM lineitem""")
def unit_functions(spark, sf_dir):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", X.auto_bin(q).alias("bin"), X.pixel_area(q, F.lit(1.5)).alias("area"), F.round(X.equal_diameter_um(q, F.lit(1.5)), 6).alias("diameter"),
        X.hardware_ns(F.col("l_orderkey"), F.col("l_partkey")).alias("ns"), F.round(X.time_of(q, F.col("l_tax")), 6).alias("t"), F.round(X.clip(p, 2000.0, 50000.0), 6).alias("clipped"),
        F.round(X.rate_error_percent(p, F.lit(30000.0)), 6).alias("error_percent"), F.round(X.upsampling(q, F.lit(15.0)), 6).alias("upsampled"), F.round(X.scale_error_ppm(q), 6).alias("ppm"),
    )


@query("""WITH g AS (SELECT l_shipdate, avg(l_quantity) AS m0, avg(l_quantity + 50 * l_discount) AS m1, stddev_pop(l_quantity) AS s0, stddev_pop(l_extendedprice) / 1000 AS s1 FROM lineitem GROUP BY ALL)
    SELECT l_shipdate, round((m1 - m0) / nullif(sqrt(0.5 * (s0 * s0 + s1 * s1)), 0), 6) + 0.0 AS dprime, round(CASE WHEN s1 > 0 THEN -0.5 * ((m1 - m0) / s1) ** 2 - ln(s1) - 0.9189385332046727 END, 6) + 0.0 AS density, round(sqrt(m0 * m0 + m1 * m1), 6) AS shift FROM g""")
def score_functions(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_shipdate").agg(
        F.avg("l_quantity").alias("m0"), F.avg(F.col("l_quantity") + 50 * F.col("l_discount")).alias("m1"), F.stddev_pop("l_quantity").alias("s0"), (F.stddev_pop("l_extendedprice") / 1000).alias("s1")
    )
    m0, m1, s0, s1 = map(F.col, ("m0", "m1", "s0", "s1"))
    return g.select("l_shipdate", r6(X.dprime(m0, m1, s0, s1), "dprime"), r6(F.when(s1 > 0, X.gaussian_log_density(m1, m0, s1)), "density"), F.round(X.total_shift(m0, m1), 6).alias("shift"))


@query(f"""WITH {EV}, n AS (SELECT channel, frame, (t * 1000000)::BIGINT AS ns FROM ev), d AS (SELECT *, first_value(ns) OVER w AS n0, lag(ns) OVER w AS b FROM n WINDOW w AS (PARTITION BY channel ORDER BY frame))
    SELECT channel AS run, frame AS page, ns AS timestamp_ns, round((ns - n0) / 1e9, 6) + 0.0 AS t_seconds, round((ns - b) / 1e6, 3) + 0.0 AS delta_ms FROM d""")
def page_times(spark, sf_dir):
    ns = F.round(F.col("t") * 1000000).cast("bigint")
    words = F.create_map(F.lit("32781"), F.shiftright(ns, 32).cast("string"), F.lit("32782"), ns.bitwiseAND(F.lit((1 << 32) - 1)).cast("string"))
    tags = events(spark, sf_dir).select(F.col("channel").alias("run"), F.col("frame").alias("page"), words.alias("tags"))
    return metadata.page_times(tags).select("run", "page", "timestamp_ns", (F.col("t_seconds") + 0.0).alias("t_seconds"), (F.col("delta_ms") + 0.0).alias("delta_ms"))
