"""Registered queries over recordings: listings, documents, files, sinks and streams.

``orders`` stands for a listing of files and for the documents of recordings, ``embeddings``
for a movie, which is written and read back in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.operators import images as I
from tracelake.operators import models as M
from tracelake.plans import flows
from tracelake.plans.queries import _BOXES, ENV, EV, GMM, MV, events, movie, query, r6, stored_envelope, table
from tracelake.sources import discovery, metadata, sets, sinks, tiff
from tracelake.sources.shared import scratch, stored
from tracelake.streaming import motion

# listings

_NAME = """CASE o_orderkey % 6 WHEN 0 THEN 'TSeries-' || o_orderkey % 1000 || '.xml' WHEN 1 THEN 'f' || o_orderkey || '.tif' WHEN 2 THEN '._f' || o_orderkey || '.tif'
    WHEN 3 THEN 'g_Ch2_' || o_orderkey || '.ome.tif' WHEN 4 THEN 'note' || o_orderkey || '.csv' ELSE 'VoltageRecording-' || o_orderkey || '.csv' END"""
_FOLDER = "'/d/r' || o_custkey % 90 || CASE WHEN o_orderkey % 9 = 0 THEN '/in' WHEN o_orderkey % 11 = 0 THEN '/proc' WHEN o_orderkey % 13 = 0 THEN '/.hid' ELSE '' END"
_LIST = f"li AS (SELECT {_FOLDER} AS folder, {_NAME} AS name, (o_custkey % 5 * 1000)::BIGINT AS length FROM orders)"
_IMAGES = "im AS (SELECT * FROM li WHERE regexp_matches(lower(name), '\\.tiff?$') AND name NOT LIKE '.%' AND length > 0)"
_NATURAL = "array_to_string(list_transform(regexp_extract_all(lower(name), '([0-9]+|[^0-9]+)', 1), lambda x: CASE WHEN regexp_full_match(x, '[0-9]+') THEN lpad(CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE ltrim(x, '0') END, 20, '0') ELSE x END), chr(1))"


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, folder, name, length): an order is a file."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    names = [F.concat(F.lit("TSeries-"), (F.col("o_orderkey") % 1000).cast("string"), F.lit(".xml")), F.concat(F.lit("f"), key, F.lit(".tif")), F.concat(F.lit("._f"), key, F.lit(".tif"))]
    names += [F.concat(F.lit("g_Ch2_"), key, F.lit(".ome.tif")), F.concat(F.lit("note"), key, F.lit(".csv")), F.concat(F.lit("VoltageRecording-"), key, F.lit(".csv"))]
    sub = F.when(F.col("o_orderkey") % 9 == 0, "/in").when(F.col("o_orderkey") % 11 == 0, "/proc").when(F.col("o_orderkey") % 13 == 0, "/.hid").otherwise("")
    folder = F.concat(F.lit("/d/r"), (F.col("o_custkey") % 90).cast("string"), sub)
    files = o.select(F.concat(folder, F.lit("/"), F.array(*names)[(F.col("o_orderkey") % 6).cast("int")]).alias("path"), (F.col("o_custkey") % 5 * 1000).cast("bigint").alias("length"))
    return discovery.split_path(files)


@query(f"""WITH {_LIST}, own AS (SELECT folder, arg_min(name, length(name)::VARCHAR.lpad(9, '0') || name) AS xml FROM li WHERE regexp_matches(name, '^TSeries.*\\.xml$') AND NOT regexp_matches(folder, '/\\.') GROUP BY folder)
    SELECT folder, xml FROM own WHERE NOT EXISTS (SELECT 1 FROM own o WHERE starts_with(own.folder, o.folder || '/'))""")
def series_folders(spark, sf_dir):
    return discovery.series(listing(spark, sf_dir))


@query(f"WITH {_LIST}, {_IMAGES} SELECT folder, count(*) AS n, sum(length)::BIGINT AS bytes, row_number() OVER (ORDER BY folder) - 1 AS idx FROM im WHERE NOT regexp_matches(folder, '/(\\.[^/]*|proc)(/|$)') GROUP BY folder")
def behaviour_folders(spark, sf_dir):
    found = discovery.runs(listing(spark, sf_dir))
    return found.join(discovery.manifest(found), "folder").select("folder", "n", "bytes", F.col("idx").cast("bigint").alias("idx"))


@query(f"WITH {_LIST} SELECT folder, count(*) AS n FROM li WHERE regexp_matches(lower(name), '\\.tiff?$') GROUP BY folder")
def folders_with_images(spark, sf_dir):
    return discovery.any_runs(listing(spark, sf_dir))


@query(f"""WITH {_LIST}, {_IMAGES}, a AS (SELECT * FROM im WHERE name LIKE 'f%'), b AS (SELECT * FROM im WHERE length >= 2000), r AS (SELECT 0 AS root, folder, length FROM a UNION ALL SELECT 1, folder, length FROM b),
    g AS (SELECT root, folder, count(*) AS n, sum(length)::BIGINT AS bytes FROM r WHERE NOT regexp_matches(folder, '/(\\.[^/]*|proc)(/|$)') GROUP BY ALL) SELECT folder, n, bytes, root FROM g WHERE root = (SELECT min(root) FROM g o WHERE o.folder = g.folder)""")
def folders_of_two_roots(spark, sf_dir):
    files = listing(spark, sf_dir)
    return discovery.runs_of_roots(files.filter("name like 'f%'"), files.filter("length >= 2000")).select("folder", "n", "bytes", "root")


@query(f"WITH {_LIST}, {_IMAGES} SELECT folder, name, row_number() OVER (PARTITION BY folder ORDER BY {_NATURAL}, name) - 1 AS part FROM im")
def parts_in_order(spark, sf_dir):
    return discovery.in_order(discovery.images(listing(spark, sf_dir))).select("folder", "name", F.col("part").cast("bigint").alias("part"))


@query(f"""WITH {_LIST}, {_IMAGES}, k AS (SELECT *, name LIKE '%.ome.%' AS ome, {_NATURAL} AS nk FROM im)
    SELECT folder, folder || '/' || name AS path FROM (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY ome DESC, CASE WHEN ome THEN nk ELSE '' END, length DESC, name) AS i FROM k) WHERE i = 1""")
def movies_by_inspection(spark, sf_dir):
    return discovery.movie_of(listing(spark, sf_dir))


@query(f"WITH {_LIST}, {_IMAGES} SELECT folder, '2' AS channel FROM im WHERE name LIKE '%_Ch2_%' GROUP BY folder")
def channels_of_folders(spark, sf_dir):
    return discovery.single_channel(listing(spark, sf_dir)).select("folder", F.regexp_extract("channel", r"(\d+)", 1).alias("channel"))


@query(f"WITH {_LIST} SELECT folder, name, length, name LIKE '%VoltageRecording%' AS voltage FROM li WHERE NOT regexp_matches(lower(name), '\\.tiff?$')")
def companion_files(spark, sf_dir):
    return discovery.companions(listing(spark, sf_dir))


@query(f"WITH {_LIST} SELECT DISTINCT folder, '/out' || substr(folder, 3) AS path, regexp_replace(replace(substr(folder, 4), '/', '__'), '\\s+', '_', 'g') AS flat FROM li")
def output_names(spark, sf_dir):
    folders = listing(spark, sf_dir).select("folder").distinct()
    return folders.select("folder", discovery.output_path(F.col("folder"), "/d", "/out/").alias("path"), discovery.flat_name(F.col("folder"), "/d").alias("flat"))


@query("""WITH p AS (SELECT o_custkey % 300 AS run, o_orderkey AS part, (o_custkey // 300 + o_orderkey % 3)::BIGINT AS n FROM orders), f AS (SELECT run, min(part) AS part, arg_min(n, part) AS n FROM p GROUP BY run), e AS (SELECT run, 2 AS expected FROM f WHERE run % 4 <> 0)
    SELECT p.run, p.part, p.n FROM p JOIN f USING (run) LEFT JOIN e USING (run) WHERE NOT coalesce(f.n = expected, false) OR p.part = f.part""")
def parts_of_broken_series(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    parts = o.select((F.col("o_custkey") % 300).alias("run"), F.col("o_orderkey").alias("part"), (F.floor(F.col("o_custkey") / 300) + F.col("o_orderkey") % 3).alias("n"))
    return discovery.parts_to_read(parts, parts.filter("run % 4 <> 0").select("run").distinct().withColumn("expected", F.lit(2)))


@query("""WITH r AS (SELECT DISTINCT o_custkey AS run FROM orders) SELECT run, concat_ws(',', CASE WHEN run NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') THEN 'meta' END, CASE WHEN run NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000) THEN 'rois' END) AS missing FROM r""")
def runs_in_tiers(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "run")
    found = discovery.tiers(o.select("run").distinct(), {"traces": o}, {"meta": o.filter("o_orderstatus = 'F'"), "rois": o.filter("o_totalprice > 200000")})
    return found.select("run", F.array_join("missing", ",").alias("missing"))


@query("""WITH e AS (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings) SELECT vec_id + 1 AS roi, i - 1 AS frame, round(embedding[i]::DOUBLE, 6) + 0.0 AS f, vec_id % 7 + 0.5 AS cx, (vec_id % 13)::DOUBLE AS cy FROM e""")
def neural_matrix(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").withColumn("run", F.lit("m"))
    rows = e.select("run", F.col("vec_id").alias("row"), F.col("embedding").cast("array<double>").alias("values"))
    labels = e.select("run", (F.col("vec_id") + 1).alias("roi"), (F.col("vec_id") % 13).alias("y"), F.explode(F.array(F.col("vec_id") % 7, F.col("vec_id") % 7 + 1)).alias("x"))
    return discovery.neural_traces(rows, labels).select("roi", F.col("frame").cast("bigint").alias("frame"), r6("f", "f"), "cx", "cy")


# documents

_PERIOD = "((o_custkey % 9 + 1) / 8.0)"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, xml): an order is a series of a few frames."""
    o = table(spark, sf_dir, "orders")
    period = (F.col("o_custkey") % 9 + 1) / 8.0
    frames = F.transform(F.sequence(F.lit(0), (F.col("o_orderkey") % 4).cast("int")), lambda k: F.concat(F.lit('<Frame relativeTime="'), (F.lit(3) + k * period).cast("string"), F.lit('"/>')))
    head = F.concat(F.lit('<?xml version="1.0"?><PVScan date="'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('"><PVStateShard><PVStateValue key="framePeriod" value="'), period.cast("string"), F.lit('"/><PVStateValue key="laser" value="'), F.col("o_orderpriority"))
    um = F.concat(F.lit('"/><PVStateValue key="micronsPerPixel"><IndexedValue index="XAxis" value="'), ((F.col("o_custkey") % 4 + 1) / 4.0).cast("string"), F.lit('"/><IndexedValue index="YAxis" value="'), ((F.col("o_custkey") % 4 + 1 + (F.col("o_orderkey") % 5 == 0).cast("int") * 0.5) / 4.0).cast("string"), F.lit('"/></PVStateValue></PVStateShard><Sequence type="TSeries '))
    return o.select(F.col("o_orderkey").cast("string").alias("path"), F.concat(head, um, F.col("o_orderstatus"), F.lit('">'), F.array_join(frames, ""), F.lit("</Sequence></PVScan>")).alias("xml"))


@query(f"""SELECT o_orderkey::VARCHAR AS path, strftime(o_orderdate, '%Y-%m-%d') AS date, 'TSeries ' || o_orderstatus AS sequence, o_orderkey % 4 + 1 AS n_frames, CASE WHEN o_orderkey % 4 > 0 THEN round({_PERIOD}, 6) END AS period, CASE WHEN o_orderkey % 4 > 0 THEN round(1 / {_PERIOD}, 6) END AS fps,
    round(CASE WHEN o_orderkey % 4 > 0 THEN (o_orderkey % 4 + 1) * {_PERIOD} ELSE 0 END, 6) AS duration_s FROM orders""")
def series_headers(spark, sf_dir):
    head = metadata.series_header(documents(spark, sf_dir))
    return head.select("path", "date", "sequence", "n_frames", *[F.round(c, 6).alias(c) for c in ("period", "fps", "duration_s")])


@query(f"""SELECT o_orderkey::VARCHAR AS path, round(1 / {_PERIOD}, 6) AS fps, round((o_custkey % 4 + 1 + CASE WHEN o_orderkey % 5 = 0 THEN 0.25 ELSE 0 END) / 4.0, 6)::DOUBLE AS um_per_px, (o_orderkey % 4 + 1)::INT AS n_frames, o_orderpriority AS laser,
    concat_ws('; ', CASE WHEN o_orderkey % 5 = 0 THEN 'pixels aren''t square: their mean is taken' END, CASE WHEN o_orderkey % 4 = 0 THEN 'fewer than two frames' END) AS notes FROM orders""")
def rig_documents(spark, sf_dir):
    return metadata.rig(documents(spark, sf_dir), ["laser"]).select("path", F.round("fps", 6).alias("fps"), F.round("um_per_px", 6).alias("um_per_px"), "n_frames", "laser", F.array_join("notes", "; ").alias("notes"))


@query(f"""WITH {EV}, n AS (SELECT channel, (t * 1000000)::BIGINT AS ns FROM ev) SELECT channel AS run, CASE WHEN channel = 'signup' THEN 15.0 ELSE round(1e9 * (count(*) - 1) / (max(ns) - min(ns)), 6) END AS fps, CASE WHEN channel = 'signup' THEN 'fallback (no timestamps)' ELSE 'timestamps' END AS source FROM n GROUP BY channel""")
def camera_rates(spark, sf_dir):
    ns = F.round(F.col("t") * 1000000).cast("bigint")
    words = F.create_map(F.lit("32781"), F.shiftright(ns, 32).cast("string"), F.lit("32782"), ns.bitwiseAND(F.lit((1 << 32) - 1)).cast("string"))
    tags = events(spark, sf_dir).select(F.col("channel").alias("run"), F.col("frame").alias("page"), F.when(F.col("channel") != "signup", words).otherwise(F.create_map().cast("map<string,string>")).alias("tags"))
    return metadata.camera_rate(tags).select("run", F.round("fps", 6).alias("fps"), "source")


# files and sinks


def movie_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, folder, name, length) of the movie, written as files of 64 frames."""
    folder = scratch(spark, "movie")
    written = stored(tiff.write(I.to_frames(movie(spark, sf_dir)), folder, 64), "files")
    return discovery.split_path(written.select("path", F.col("bytes").alias("length")))


@query(f"WITH {MV} SELECT frame, (frame // 64)::INT AS part, (frame % 64)::INT AS page, round(sum(v), 6) + 0.0 AS total, round(max(v), 6) + 0.0 AS most FROM mv GROUP BY frame")
def movie_from_files(spark, sf_dir):
    frames = tiff.pixels_of(tiff.index(movie_files(spark, sf_dir)))
    total = F.aggregate("pixels", F.lit(0.0), lambda a, v: a + v)
    return frames.select("frame", F.col("part").cast("int").alias("part"), "page", r6(total, "total"), r6(F.array_max("pixels"), "most"))


@query("WITH n AS (SELECT count(*) AS n FROM embeddings) SELECT k::INT AS part, least(64, n - 64 * k) AS pages, 8 AS h, 8 AS w FROM n, LATERAL (SELECT unnest(range((n + 63) // 64)) AS k)")
def pages_of_files(spark, sf_dir):
    pages = tiff.index(movie_files(spark, sf_dir))
    return pages.groupBy(F.col("part").cast("int").alias("part")).agg(F.count("*").alias("pages"), F.max("h").alias("h"), F.max("w").alias("w"))


@query(f"WITH {MV}, l AS (SELECT max(frame) AS last FROM mv) SELECT frame, y::INT AS y, x::INT AS x, round(v, 6) + 0.0 AS v FROM mv, l WHERE frame >= 100 AND frame <= last - 3")
def range_of_a_movie(spark, sf_dir):
    folder = movie_files(spark, sf_dir).select("folder").first()[0]
    tiff.register(spark)
    frames = spark.read.format("tiff_movie").option("trim", 3).option("block_mb", 0.02).load(folder).filter("frame >= 100")
    return I.to_pixels(frames).select("frame", "y", "x", r6("v", "v"))


@query("SELECT n_nationkey AS run, n_name AS name, [n_regionkey, n_nationkey]::VARCHAR AS keys FROM nation")
def sidecars_read_back(spark, sf_dir):
    path = scratch(spark, "sidecars")
    side = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("run"), F.col("n_name").alias("name"), F.array("n_regionkey", "n_nationkey").alias("keys"))
    sinks.save_sidecars(side, path)
    back = spark.read.schema(side.schema).json(path)
    return back.select("run", "name", F.format_string("[%d, %d]", F.col("keys")[0], F.col("keys")[1]).alias("keys"))


@query("SELECT c_nationkey AS run, count(*) AS n, round(CASE WHEN c_nationkey % 2 = 0 THEN -1 ELSE sum(c_acctbal) END, 2) AS total FROM customer GROUP BY c_nationkey")
def summary_with_reruns(spark, sf_dir):
    path = scratch(spark, "summary")
    lines = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("run")).agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))
    sinks.append_summary(lines, path)
    sinks.append_summary(lines.filter("run % 2 = 0").withColumn("total", F.lit(-1.0)), path)
    return spark.read.csv(path, header=True, schema="n long, total double, run int").select(F.col("run").cast("bigint").alias("run"), "n", "total")


@query("""WITH t AS (SELECT o_orderpriority AS run, o_orderkey AS frame, o_totalprice AS v FROM orders) SELECT 'traces' AS name, run, count(*) AS n, round(sum(CASE WHEN run = '1-URGENT' THEN 2 * v ELSE v END), 2) AS total FROM t GROUP BY run
    UNION ALL SELECT 'rois', run, count(DISTINCT frame % 10), NULL FROM t WHERE run <> '1-URGENT' GROUP BY run""")
def committed_sets(spark, sf_dir):
    path = scratch(spark, "set")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("run"), F.col("o_orderkey").alias("frame"), F.col("o_totalprice").alias("v"))
    sets.save({"traces": o, "rois": o.select("run", (F.col("frame") % 10).alias("roi")).distinct()}, path)
    # one run again, without regions
    sets.save({"traces": o.filter("run = '1-URGENT'").withColumn("v", 2 * F.col("v"))}, path)
    traces = sets.read(spark, path, "traces").groupBy("run").agg(F.count("*").alias("n"), F.round(F.sum("v"), 2).alias("total"))
    rois = sets.read(spark, path, "rois").groupBy("run").agg(F.count("*").alias("n"), F.lit(None).cast("double").alias("total"))
    return traces.select(F.lit("traces").alias("name"), "*").unionByName(rois.select(F.lit("rois").alias("name"), "*"))


# flows and streams

_BOX_SQL = f"""{MV}, b AS (SELECT * FROM (VALUES ('paw', 0, 0, 4, 4), ('wheel', 3, 2, 8, 7)) t(box, x0, y0, x1, y1)), d AS (SELECT *, v - lag(v) OVER (PARTITION BY y, x ORDER BY frame) AS d FROM mv)"""


@query(f"WITH {_BOX_SQL} SELECT box, frame, round(avg(v), 6) + 0.0 AS lum, round(coalesce(avg(abs(d)), 0), 6) + 0.0 AS me FROM d JOIN b ON x >= x0 AND x < x1 AND y >= y0 AND y < y1 GROUP BY box, frame")
def streamed_motion(spark, sf_dir):
    frames = I.to_frames(movie(spark, sf_dir)).repartition(6, "frame")
    source, out, state = (scratch(spark, x) for x in ("frames", "streamed", "state"))
    frames.write.parquet(source)
    stream = motion.motion_traces(motion.read_frames(spark, source, I.FRAMES, 2), [*_BOXES], 1 << 30)
    motion.write_traces(stream, out, state).awaitTermination()
    return spark.read.parquet(out).select("box", "frame", r6("lum", "lum"), r6("me", "me"))


@query(f"WITH {_BOX_SQL}, n AS (SELECT count(*) AS n FROM embeddings) SELECT 'm' AS run, box, count(DISTINCT frame) AS frames, round(avg(abs(coalesce(d, 0))), 6) AS me, 'flagged' AS status FROM d JOIN b ON x >= x0 AND x < x1 AND y >= y0 AND y < y1 GROUP BY box")
def behaviour_flow(spark, sf_dir):
    frames = I.to_frames(movie(spark, sf_dir))
    expected = table(spark, sf_dir, "embeddings").agg(F.lit("m").alias("run"), F.count("*").cast("int").alias("expected"))
    boxes = spark.createDataFrame([("m", *b) for b in _BOXES], "run string, box string, x0 int, y0 int, x1 int, y1 int")
    done = flows.behaviour(frames, boxes, expected, 0.2)
    means = done["traces"].groupBy("run", "box").agg(F.count("*").alias("frames"), F.round(F.avg("me"), 6).alias("me"))
    return means.join(done["outcomes"].select("run", "status"), "run")


@query(f"WITH {MV}, p AS (SELECT DISTINCT frame // 64 AS k FROM mv), c AS (SELECT k, count(DISTINCT frame) AS frames FROM mv, p WHERE frame // 64 = k GROUP BY k) SELECT k AS part, frames, 'ok' AS status FROM c")
def verified_files(spark, sf_dir):
    done = flows.verify(movie_files(spark, sf_dir))
    files = done["files"].join(done["outcomes"].select("run", "status"), "run")
    return files.select(F.regexp_extract("path", r"part(\d+)", 1).cast("bigint").alias("part"), "frames", "status")


@query("""WITH r AS (SELECT DISTINCT o_custkey AS run FROM orders), o AS (SELECT DISTINCT o_custkey AS run, 'b' || o_orderkey % 3 AS box, (o_orderkey % 3)::INT AS x0 FROM orders WHERE o_custkey % 3 <> 0), t AS (SELECT * FROM (VALUES ('paw', 0), ('wheel', 3)) v(box, x0))
    SELECT run, box, x0 FROM o UNION ALL SELECT run, box, x0 FROM r, t WHERE run NOT IN (SELECT run FROM o)""")
def boxes_from_a_template(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "run")
    edges = {"y0": F.lit(0), "x1": F.lit(9), "y1": F.lit(9)}
    kind = (F.col("o_orderkey") % 3).cast("int")
    own = o.filter("run % 3 <> 0").select("run", F.concat(F.lit("b"), kind.cast("string")).alias("box"), kind.alias("x0")).distinct().withColumns(edges)
    template = spark.createDataFrame([("paw", 0), ("wheel", 3)], "box string, x0 int").withColumns(edges)
    return flows.boxes_for(o, own, template).select("run", "box", "x0")


# images and mixtures


@query(f"""WITH {MV}, bn AS (SELECT k AS bin, y, x, frame // k AS frame, avg(v) AS v FROM mv, (SELECT unnest([1, 3, 10]) AS k) WHERE y BETWEEN 1 AND 6 AND x BETWEEN 1 AND 6 GROUP BY ALL HAVING count(*) = any_value(k)),
    s AS (SELECT a.bin, a.frame, a.y, a.x, any_value(a.v) AS v, coalesce(sum(b.v), 0) AS s FROM bn a LEFT JOIN bn b ON a.bin = b.bin AND a.frame = b.frame AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND NOT (a.y = b.y AND a.x = b.x) GROUP BY ALL),
    c AS (SELECT bin, y, x, coalesce(covar_pop(v, s) / nullif(stddev_pop(v) * stddev_pop(s), 0), 0) AS r FROM s GROUP BY ALL) SELECT bin::INT AS bin, round(quantile_cont(r, 0.5), 6) AS median, round(quantile_cont(r, 0.95), 6) AS p95 FROM c GROUP BY bin""")
def bin_factors(spark, sf_dir):
    return I.bin_sweep(movie(spark, sf_dir), (1, 3, 10), 6).select("bin", F.round("median", 6).alias("median"), F.round("p95", 6).alias("p95"))


_SWEPT = ENV + """, cmv AS (SELECT a.channel || '@' || beta AS channel, a.frame, a.v - beta * c.v AS v FROM env a JOIN env c ON c.channel = 'error' AND c.frame = a.frame, (SELECT unnest([0.0, 0.5]) AS beta) WHERE a.channel <> 'error')"""


@query(f"WITH RECURSIVE {GMM.replace(ENV, _SWEPT).replace('FROM env GROUP BY', 'FROM cmv GROUP BY').replace('JOIN env USING', 'JOIN cmv USING')} SELECT split_part(channel, '@', 1) AS channel, split_part(channel, '@', 2)::DOUBLE AS beta, round(dprime, 5) + 0.0 AS dprime FROM fits")
def common_mode_sweep(spark, sf_dir):
    env = stored_envelope(spark, sf_dir)
    swept = M.common_mode(env.filter("channel <> 'error'"), env.filter("channel = 'error'"), [0.0, 0.5])
    return swept.select("channel", "beta", (F.round("dprime", 5) + 0.0).alias("dprime"))
