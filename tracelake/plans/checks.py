"""Registered queries over what refuses or marks a run, clocks, sets and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.operators import alignment as A
from tracelake.operators import checks as C
from tracelake.operators import correlation as R
from tracelake.operators import statistics as T
from tracelake.plans.queries import BOUTS, EV, bouts, events, query, r6, table
from tracelake.sources import sinks


@query(f"""WITH {EV}, d AS (SELECT *, t - lag(t) OVER (PARTITION BY channel ORDER BY frame) AS d FROM ev), p AS (SELECT channel, quantile_cont(d, 0.5) AS p, min(t) AS t0 FROM d GROUP BY channel)
    SELECT channel AS run, frame, CASE WHEN channel = 'view' THEN round(frame / 0.5, 6) ELSE round(t - t0, 6) END + 0.0 AS t, CASE WHEN channel = 'view' THEN 2.0 ELSE round(p, 6) END AS period FROM d JOIN p USING (channel)""")
def measured_clock(spark, sf_dir):
    """The stamps of 'view' lack one frame, so its clock is counted."""
    e = events(spark, sf_dir).select(F.col("channel").alias("run"), "frame", "t")
    frames = e.groupBy("run").agg(F.count("*").alias("n"), F.lit(0.5).alias("fps"))
    return A.neural_clock(frames, e.filter("run <> 'view' or frame <> 7")).select("run", "frame", r6("t", "t"), F.round("period", 6).alias("period"))


@query(f"""WITH {EV}, b AS (SELECT channel, (frame - 5) * 3 AS frame, v + (frame % 7 = 0)::INT AS v FROM ev WHERE frame >= 5)
    SELECT ev.channel, count(*) AS n, count(*) FILTER (b.v <> ev.v) AS differing FROM b JOIN ev ON ev.channel = b.channel AND ev.frame = b.frame // 3 + 5 GROUP BY ALL""")
def coincident_samples(spark, sf_dir):
    e = events(spark, sf_dir)
    bundle = e.filter("frame >= 5").select("run", "channel", ((F.col("frame") - 5) * 3).alias("frame"), (F.col("v") + (F.col("frame") % 7 == 0).cast("int")).alias("v"))
    return A.coincident(bundle, e, 5, 3).select("channel", "n", "differing")


@query(f"""WITH {EV}, b AS (SELECT e.channel, e.frame AS f, 0.5 * e.v + 0.5 * n.v + (e.frame % 5 = 0)::INT AS v, 0.5 * e.v + 0.5 * n.v AS w FROM ev e JOIN ev n ON n.channel = e.channel AND n.frame = e.frame + 1)
    SELECT channel, count(*) AS n, count(*) FILTER (abs(w - v) > 1e-9 * greatest(1, abs(v))) AS wrong FROM b GROUP BY channel""")
def blend_errors(spark, sf_dir):
    e = events(spark, sf_dir)
    after = e.select("run", "channel", (F.col("frame") - 1).alias("frame"), F.col("v").alias("w"))
    bundle = e.join(after, ["run", "channel", "frame"]).select("run", "channel", "frame", ((F.col("frame") - 2 + 0.5) * 0.25).alias("t"), (0.5 * F.col("v") + 0.5 * F.col("w") + (F.col("frame") % 5 == 0).cast("int")).alias("v"))
    camera = spark.createDataFrame([("r", 2, 0.25)], "run string, on int, dt double")
    return A.blend_errors(bundle, e, camera).select("channel", "n", "wrong")


@query(f"""WITH {EV}, m AS (SELECT channel, max(t) AS t1 FROM ev GROUP BY channel) SELECT channel AS run, frame, t < 36000 OR t > t1 - 36000 AS artifact FROM ev JOIN m USING (channel)""")
def edge_marks(spark, sf_dir):
    clock = events(spark, sf_dir).select(F.col("channel").alias("run"), "frame", "t")
    camera = clock.select("run").distinct().withColumn("dt", F.lit(36000.0))
    return A.edge_artifacts(clock, camera).select("run", "frame", "artifact")


@query(f"""WITH {EV}, k AS (SELECT channel, count(*) AS n FROM ev WHERE t <= 86400.0 * 20 GROUP BY channel) SELECT channel AS run, n AS kept FROM k""")
def covered_events(spark, sf_dir):
    clock = events(spark, sf_dir).select(F.col("channel").alias("run"), "frame", "t")
    camera = clock.select("run").distinct().withColumn("coverage_end", F.lit(86400.0 * 20))
    return A.covered(clock, camera).groupBy("run").agg(F.count("*").alias("kept"))


@query(f"""WITH {BOUTS} SELECT channel AS run, EXISTS (SELECT 1 FROM bt WHERE bt.channel = c.channel) AS has_bouts, channel IN ('error', 'view') AS has_marks FROM (SELECT DISTINCT channel FROM ev) c""")
def run_status(spark, sf_dir):
    runs = events(spark, sf_dir).select(F.col("channel").alias("run")).distinct()
    return A.status(runs, bouts=bouts(spark, sf_dir).select(F.col("channel").alias("run")), marks=runs.filter(F.col("run").isin("error", "view")))


@query("SELECT DISTINCT o_custkey AS run FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F')")
def unfinished_runs(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "run")
    return A.unfinished(o.select("run").distinct(), o.filter("o_totalprice > 100000 and o_orderstatus = 'F'"))


@query("SELECT (vec_id % 3)::VARCHAR AS run, vec_id AS roi, round(embedding[1]::DOUBLE, 5) AS r, round(embedding[2]::DOUBLE, 5) AS cx, round(embedding[3]::DOUBLE, 5) AS cy FROM embeddings WHERE vec_id % 3 <> 2")
def roi_positions(spark, sf_dir):
    """A run whose numbers of ROIs differ is left out."""
    e = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 3).cast("string").alias("run"), F.col("vec_id").alias("roi"), *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(("r", "cx", "cy"))])
    return A.positioned(e.select("run", "roi", "r"), e.filter("roi <> 2").select("run", "roi", "cx", "cy")).select("run", "roi", *[F.round(c, 5).alias(c) for c in ("r", "cx", "cy")])


@query(f"WITH {EV}, g AS (SELECT channel, min(t) AS a, max(t) AS b FROM ev WHERE frame % 10 = 3 GROUP BY channel), s AS (SELECT channel, min(t) AS c, max(t) AS d FROM ev WHERE channel <> 'click' OR frame > 5 GROUP BY channel) SELECT channel AS run, a >= c AND b <= d AS ok FROM g JOIN s USING (channel)")
def containment(spark, sf_dir):
    e = events(spark, sf_dir).select(F.col("channel").alias("run"), "frame", "t")
    return C.contained(e.filter("frame % 10 = 3"), e.filter("run <> 'click' or frame > 5"))


@query(f"WITH {EV}, c AS (SELECT channel, count(*) AS n, (count(*) - 1) / (max(t) - min(t)) AS m, 2000 / 2592000.0 AS fps FROM ev GROUP BY channel) SELECT channel AS run, 100 * abs((m - fps) / fps) <= 1.0 AS rate_ok, channel <> 'view' AS count_ok FROM c")
def rate_checks(spark, sf_dir):
    e = events(spark, sf_dir).groupBy(F.col("channel").alias("run")).agg(F.count("*").alias("n"), ((F.count("*") - 1) / (F.max("t") - F.min("t"))).alias("measured_fps"))
    runs = e.withColumns({"fps": F.lit(2000 / 2592000.0), "clock_n": F.col("n") + (F.col("run") == "view").cast("int")})
    return C.rate_checks(runs)


@query("SELECT l_shipdate AS run, l_returnflag AS channel, count(*) AS n FROM lineitem WHERE l_discount = 0 GROUP BY ALL")
def values_not_finite(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("run"), F.col("l_returnflag").alias("channel"), F.try_divide(F.col("l_quantity"), F.col("l_discount")).alias("v"))
    return C.not_finite(d)


@query("SELECT p_partkey AS roi, p_size AS npix FROM part WHERE p_size > 9 AND p_size < 40")
def size_gate(spark, sf_dir):
    return C.size_gate(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("roi"), F.col("p_size").alias("npix")), 9, 40)


@query("""WITH nm AS (SELECT ['laser_trigger', 'whisker_pad', 'paw', 'paw_at_nose', 'eye', 'nose', 'wheel'] AS n), b AS (SELECT p_partkey // 9 AS run, CASE WHEN p_size % 11 < 7 THEN n[p_size % 11 + 1] ELSE 'tail' END AS box, p_size % 3 AS x0, 0 AS y0, p_partkey % 4 AS x1, 5 AS y1 FROM part, nm),
    k AS (SELECT DISTINCT run, unnest(n) AS box FROM b, nm)
    SELECT run, 'error' AS level, 'duplicate' AS problem, box FROM b GROUP BY ALL HAVING count(*) > 1 UNION ALL SELECT DISTINCT run, 'warning', 'unknown', box FROM b WHERE box = 'tail'
    UNION ALL SELECT run, 'warning', 'missing', box FROM k WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.run = k.run AND b.box = k.box)
    UNION ALL SELECT run, 'warning', 'same rectangle', string_agg(DISTINCT box, ',' ORDER BY box) FROM b GROUP BY run, x0, y0, x1, y1 HAVING count(DISTINCT box) > 1 UNION ALL SELECT run, 'error', 'empty', box FROM b WHERE x1 <= x0""")
def box_problems(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in C.BOXES])
    p = table(spark, sf_dir, "part")
    box = F.when(F.col("p_size") % 11 < 7, F.get(names, F.col("p_size") % 11)).otherwise("tail")
    return C.box_problems(p.select(F.expr("p_partkey div 9").alias("run"), box.alias("box"), (F.col("p_size") % 3).alias("x0"), F.lit(0).alias("y0"), (F.col("p_partkey") % 4).alias("x1"), F.lit(5).alias("y1")))


@query("""WITH s AS (SELECT vec_id % 5 AS run, vec_id, label, embedding AS e FROM embeddings), d AS (SELECT *, vec_id + e[4] - lag(vec_id + e[4]) OVER (PARTITION BY run ORDER BY vec_id) AS d FROM s),
    f AS (SELECT run::VARCHAR AS run, quantile_cont(sqrt((e[1]::DOUBLE * 8) ** 2 + (e[2]::DOUBLE * 8) ** 2), 0.99) > 3 AS large_motion, count(DISTINCT label) < 10 AS few_rois, max(e[3]) < 0.4 AS low_correlation, stddev_pop(d) > 0.05 * quantile_cont(d, 0.5) AS irregular_clock FROM d GROUP BY ALL)
    SELECT *, large_motion OR few_rois OR low_correlation OR irregular_clock AS flagged FROM f""")
def quality_flags(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 5).cast("string").alias("run"), F.col("vec_id").alias("frame"), "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(4)])
    shifts, rois_, cmap = e.select("run", (F.col("e0") * 8).alias("dy"), (F.col("e1") * 8).alias("dx")), e.select("run", F.col("label").alias("roi")), e.select("run", F.col("e2").alias("r"))
    return C.quality_flags(shifts, rois_, cmap, e.select("run", "frame", (F.col("frame") + F.col("e3")).alias("t")), 0.4, 3.0, 10, 0.05)


@query("SELECT n_name AS run, concat_ws('; ', CASE WHEN 0.2 * n_nationkey < 2 THEN 'the temporal filter spans less than two frames' END, CASE WHEN 10 / (n_nationkey / 5.0 + 0.5) < 5 THEN 'cells are less than five pixels wide' END) AS warnings FROM nation")
def parameter_warnings(spark, sf_dir):
    runs = table(spark, sf_dir, "nation").select(F.col("n_name").alias("run"), F.col("n_nationkey").cast("double").alias("fps"), (F.col("n_nationkey") / 5 + 0.5).alias("um_per_px"))
    return C.parameter_warnings(runs, 0.2, 10.0).select("run", F.array_join("warnings", "; ").alias("warnings"))


@query("SELECT l_shipdate AS run, 0.08 < quantile_cont(l_discount, 0.9) AS too_low, 0.08 > max(l_discount) AS too_high FROM lineitem GROUP BY ALL")
def threshold_checks(spark, sf_dir):
    return C.threshold_checks(table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("run"), F.col("l_discount").alias("r")), 0.08)


_FRAMES = "fr AS (SELECT user_id % 40 AS run, row_number() OVER (PARTITION BY user_id % 40 ORDER BY event_id) - 1 + (event_id % 200 > 190)::INT * 0 AS frame, 'p' || (event_id % 5) AS part, CASE WHEN event_id % 97 = 11 THEN 'cut ' || event_id END AS error, event_id FROM events)"


def _frames(spark, sf_dir):
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events")
    frame = F.row_number().over(Window.partitionBy(F.col("user_id") % 40).orderBy("event_id")) - 1
    return e.select((F.col("user_id") % 40).alias("run"), frame.alias("frame"), F.concat(F.lit("p"), (F.col("event_id") % 5).cast("string")).alias("part"), F.when(F.col("event_id") % 97 == 11, F.concat(F.lit("cut "), F.col("event_id").cast("string"))).alias("error"))


@query(f"WITH {_FRAMES}, f AS (SELECT run, arg_min(part, frame) AS part, min(frame) AS at_frame, arg_min(error, frame) AS reason FROM fr WHERE error IS NOT NULL GROUP BY run) SELECT run, part, at_frame::INT AS at_frame, reason FROM f")
def truncations(spark, sf_dir):
    return C.truncations(_frames(spark, sf_dir))


@query(f"WITH {_FRAMES}, g AS (SELECT * FROM fr WHERE frame <> 150), s AS (SELECT run, least(150, coalesce(min(frame) FILTER (error IS NOT NULL), 150)) AS s FROM g GROUP BY run) SELECT g.run, count(*) AS kept, max(frame)::INT AS last FROM g JOIN s USING (run) WHERE frame < s GROUP BY g.run")
def contiguous_prefixes(spark, sf_dir):
    return C.contiguous_prefix(_frames(spark, sf_dir).filter("frame <> 150")).groupBy("run").agg(F.count("*").alias("kept"), F.max("frame").alias("last"))


@query(f"WITH {EV}, x AS (SELECT channel, count(*) AS n FROM ev GROUP BY channel) SELECT channel AS run, n, 2000 AS expected, n = 2000 AS ok FROM x")
def complete_runs(spark, sf_dir):
    e = events(spark, sf_dir).select(F.col("channel").alias("run"), "frame")
    return C.complete_runs(e, e.select("run").distinct().withColumn("expected", F.lit(2000)), refuse=False).select("run", "n", "expected", "ok")


@query("SELECT (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS missing, 0::BIGINT AS extra")
def same_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return C.same_rows(c, c.filter("c_acctbal >= 0"))


@query("SELECT count(*) FILTER (o_orderstatus = 'O') AS ok, count(*) FILTER (o_orderstatus = 'P') AS flagged, count(*) FILTER (o_orderstatus = 'F') AS failed FROM orders")
def outcome_counts(spark, sf_dir):
    names = F.create_map(*[F.lit(x) for x in ("O", "ok", "P", "flagged", "F", "failed")])
    return C.first_failure(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run"), names[F.col("o_orderstatus")].alias("status")))


@query("""WITH c AS (SELECT l_shipdate AS run, 'c' || l_linenumber AS k, CASE WHEN count(*) > 1 THEN avg(l_discount) < 0.06 END AS ok FROM lineitem GROUP BY ALL)
    SELECT run, coalesce(bool_and(ok), true) AS ok, count(*) FILTER (ok) AS passed, coalesce(string_agg(k, ',' ORDER BY k) FILTER (NOT ok), '') AS failed, count(*) FILTER (ok IS NULL) AS not_applicable FROM c GROUP BY run""")
def gate_verdicts(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").alias("run"), F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("check")).agg(F.when(F.count("*") > 1, F.avg("l_discount") < 0.06).alias("ok"))
    return R.gate(d).select("run", "ok", "passed", F.array_join("failed", ",").alias("failed"), "not_applicable")


@query(f"WITH {EV}, g AS (SELECT channel, avg(v) < 51 AS ok FROM ev GROUP BY channel) SELECT channel AS run, frame FROM ev JOIN g USING (channel) WHERE ok")
def rows_of_open_gates(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("run", F.col("channel"))
    return R.passing(e, e.groupBy("run").agg((F.avg("v") < 51).alias("ok"))).select("run", "frame")


# parts of a recording


@query("""WITH p AS (SELECT o_orderpriority AS run, o_orderkey AS part, (o_custkey % 4)::BIGINT AS n FROM orders), g AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY run ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM p),
    a AS (SELECT run, part, first + k AS frame, k AS page FROM g, LATERAL (SELECT unnest(range(n)) AS k)) SELECT run, frame, part::VARCHAR AS part, page FROM a""")
def located_frames(spark, sf_dir):
    parts = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("run"), F.col("o_orderkey").alias("part"), (F.col("o_custkey") % 4).alias("n"))
    total = parts.groupBy("run").agg(F.sum("n").alias("n")).filter("n > 0")
    asked = total.select("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("frame"))
    return A.locate(asked, parts)


# sets and choices


@query(f"WITH {EV} SELECT DISTINCT channel FROM ev WHERE channel NOT IN (SELECT channel FROM ev WHERE v > (SELECT quantile_cont(v, 0.9999) FROM ev))")
def channel_difference(spark, sf_dir):
    e = events(spark, sf_dir)
    top = e.agg(F.percentile("v", F.lit(0.9999)).alias("top"))  # one row
    return T.channel_difference(e, e.crossJoin(F.broadcast(top)).filter("v > top"))


@query("SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def first_seen_users(spark, sf_dir):
    return T.first_of_each(table(spark, sf_dir, "events"), "user_id", "event_id")


@query("SELECT r_regionkey AS key, r_name AS name, NULL::INT AS n_regionkey FROM region UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation")
def union_of_columns(spark, sf_dir):
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    n = table(spark, sf_dir, "nation").select("n_regionkey", F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    return T.union_of_columns(r, n)


@query("""WITH t AS (SELECT user_id % 7 AS run, 'type' AS tag, event_type AS value FROM events UNION ALL SELECT user_id % 7, 'lab', 'one' FROM events UNION ALL SELECT user_id % 7, 'tens', floor(value / 10)::INT::VARCHAR FROM events)
    SELECT run, tag, count(DISTINCT value) AS "values" FROM t GROUP BY ALL HAVING count(DISTINCT value) > 1""")
def varying_tags(spark, sf_dir):
    tags = F.create_map(F.lit("type"), F.col("event_type"), F.lit("lab"), F.lit("one"), F.lit("tens"), F.floor(F.col("value") / 10).cast("int").cast("string"))
    return T.varying_tags(table(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("run"), tags.alias("tags")))


@query("""WITH g AS (SELECT l_shipdate, avg(l_quantity) AS a, avg(l_discount) * 500 AS b, count(*)::DOUBLE AS n FROM lineitem GROUP BY ALL)
    SELECT l_shipdate, round(least(a, b), 6) AS low, round(greatest(a, b), 6) AS high, CASE WHEN b < a THEN n * 2 ELSE n END AS low_weight FROM g""")
def ordered_components(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_shipdate").agg(F.array(F.avg("l_quantity"), F.avg("l_discount") * 500).alias("means"), F.array(F.count("*").cast("double"), F.count("*") * 2.0).alias("weights"))
    c = T.ordered_components(F.col("means"), [F.col("weights")])
    return g.select("l_shipdate", c.alias("c")).select("l_shipdate", F.round(F.col("c")[0]["means"], 6).alias("low"), F.round(F.col("c")[1]["means"], 6).alias("high"), F.col("c")[0]["weights"].alias("low_weight"))


@query(f"""WITH {EV}, h AS (SELECT channel, least(floor(v / 20.0), 9)::BIGINT AS bin, count(*) AS n FROM ev WHERE v BETWEEN 0 AND 200 GROUP BY ALL) SELECT channel, bin, round(n / (sum(n) OVER (PARTITION BY channel) * 20.0), 9) AS density FROM h""")
def histogram_density(spark, sf_dir):
    return T.histogram(events(spark, sf_dir), 0.0, 200.0, 10, density=True).select("channel", "bin", F.round("density", 9).alias("density"))


@query(f"""WITH {EV}, d AS (SELECT channel, frame, t - lag(t) OVER (PARTITION BY channel ORDER BY frame) AS dt FROM ev), s AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY dt) - 1 AS i, count(*) OVER (PARTITION BY channel) AS n FROM d WHERE dt IS NOT NULL), m AS (SELECT channel, dt AS m FROM s WHERE i = n // 2)
    SELECT channel AS run, frame, round(dt, 6) AS dt FROM s JOIN m USING (channel) WHERE dt > 1.5 * m""")
def gap_rows(spark, sf_dir):
    stamps = events(spark, sf_dir).select(F.col("channel").alias("run"), "frame", "t")
    return T.frame_rate(stamps)[1].select("run", "frame", F.round("dt", 6).alias("dt"))


_TYPES = ("click", "error", "purchase", "signup", "view")


@query(f"WITH {EV} SELECT run, frame, {', '.join(f'round(any_value(v) FILTER (channel = {chr(39)}{x}{chr(39)}), 6) AS {x}' for x in _TYPES)} FROM ev GROUP BY ALL")
def wide_traces(spark, sf_dir):
    return sinks.wide(events(spark, sf_dir), list(_TYPES)).select("run", "frame", *[F.round(x, 6).alias(x) for x in _TYPES])

