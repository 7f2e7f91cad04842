"""Metadata documents of recordings, read with XPath functions: one row a document, no Python.

Cases: a null document or one without an element gives nulls or empty arrays for what it
lacks; repeated documents give repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelake.functions import expressions as X


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, xml)."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("xml"))


def frame_times(docs: DataFrame) -> DataFrame:
    """(path, frame, t) of every Frame element, from its first time."""
    times = F.expr("transform(xpath(xml, '//Frame/@relativeTime'), x -> cast(x as double))")
    return docs.select("path", F.posexplode(times).alias("frame", "t")).withColumn("t", F.col("t") - F.first("t").over(Window.partitionBy("path").orderBy("frame")))


#: Stands between texts that are read together; XML allows it nowhere.
_CUT = "\uffff"


def _texts(places: Sequence[str]) -> Column:
    """An array of the texts at some places, from one reading: every call of an XPath function parses its document."""
    joined = f", '{_CUT}', ".join(f"string({p})" for p in places)
    return F.split(F.xpath_string("xml", F.lit(f"concat({joined})")), _CUT)


def series_header(docs: DataFrame) -> DataFrame:
    """(path, date, sequence, n_frames, period, fps, duration_s): fps is one over the median step; the duration has one more period.

    A document is read twice, for its texts and for its times, and meets no other row.
    """
    times = F.expr("transform(xpath(xml, '//Frame/@relativeTime'), x -> cast(x as double))")
    read = docs.select("path", _texts(("/*/@date", "//Sequence/@type")).alias("_h"), times.alias("_t"))
    read = read.withColumn("_t", F.transform("_t", lambda t: t - F.get("_t", F.lit(0))))
    steps = F.filter(F.transform("_t", lambda t, i: t - F.get("_t", i - 1)), lambda d: d.isNotNull())
    read = read.withColumn("_d", F.array_sort(steps))
    low, high = (F.get("_d", F.expr(f"cast((size(_d) - {k}) div 2 as int)")) for k in (1, 0))
    read = read.withColumns({"period": 0.5 * low + 0.5 * high, "n_frames": F.when(F.size("_t") > 0, F.size("_t").cast("bigint"))})
    span = F.array_max("_t") - F.array_min("_t")
    return read.select("path", F.col("_h")[0].alias("date"), F.col("_h")[1].alias("sequence"), "n_frames", "period", F.try_divide(F.lit(1.0), F.col("period")).alias("fps"), (span + F.coalesce("period", F.lit(0.0))).alias("duration_s"))


def state_values(docs: DataFrame) -> DataFrame:
    """(path, values, indexed_keys, indexed, subindexed): the first state shard's plain values, and its indexed and sub-indexed ones in order. Values stay text."""
    shard = "//PVStateShard[1]/PVStateValue"
    both = lambda at, of: F.arrays_zip(F.expr(f"xpath(xml, '{at}')").alias("key"), F.expr(f"xpath(xml, '{of}')").alias("value"))
    pairs = both(f"{shard}[@value]/@key", f"{shard}[@value]/@value")
    # a key with several values keeps its first
    first = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, x: F.when(F.map_contains_key(m, x["key"]), m).otherwise(F.map_concat(m, F.create_map(x["key"], x["value"]))))
    names = F.expr(f"xpath(xml, '{shard}/IndexedValue/../@key')")
    values = F.arrays_zip(F.expr(f"xpath(xml, '{shard}/IndexedValue/@index')").alias("index"), F.expr(f"xpath(xml, '{shard}/IndexedValue/@value')").alias("value"))
    deep = F.arrays_zip(F.expr(f"xpath(xml, '{shard}/SubindexedValues/SubindexedValue/../@index')").alias("group"), F.expr(f"xpath(xml, '{shard}/SubindexedValues/SubindexedValue/@subindex')").alias("index"), F.expr(f"xpath(xml, '{shard}/SubindexedValues/SubindexedValue/@value')").alias("value"))
    return docs.select("path", first.alias("values"), names.alias("indexed_keys"), values.alias("indexed"), deep.alias("subindexed"))


def rig(docs: DataFrame, values: Sequence[str] = ()) -> DataFrame:
    """(path, fps, um_per_px, n_frames, notes, a text for each of ``values``) from either of two kinds of document; null where a document says nothing.

    A pixel's size is the mean of its two sides; ``notes`` says where they differ by more
    than a fiftieth, and what a document lacks. ``values``: keys of the first state shard,
    as in ``state_values``. A document is read once.
    """
    places = {
        "rate": "//LSM/@frameRate", "period": '//PVStateValue[@key="framePeriod"]/@value', "size": "//LSM/@pixelSizeUM", "frames": "//Streaming/@frames", "counted": "count(//Frame)",
        **{axis: f'//PVStateValue[@key="micronsPerPixel"]/IndexedValue[@index="{axis}"]/@value' for axis in ("XAxis", "YAxis")},
    }
    held = [f'//PVStateShard[1]/PVStateValue[@value][@key="{k}"]/@value' for k in values]
    # numbers as XPath has them; a text comes after whether it is there
    read = docs.select("path", _texts([*[f"number({p})" for p in places.values()], *[x for p in held for x in (f"boolean({p})", p)]]).alias("_r"))
    read = read.select(
        "path", *[F.nullif(F.col("_r")[i].cast("double"), F.lit(float("nan"))).alias(name) for i, name in enumerate(places)],
        *[F.when(F.col("_r")[len(places) + 2 * i] == "true", F.col("_r")[len(places) + 2 * i + 1]).alias(f"_v{i}") for i in range(len(values))],
    )
    x, y = F.col("XAxis"), F.col("YAxis")
    fps, um = F.coalesce("rate", F.try_divide(F.lit(1.0), F.col("period"))), F.coalesce("size", (x + y) / 2, x, y)
    frames = F.coalesce("frames", "counted")
    said = [
        F.when(F.abs(x - y) > 0.02 * F.greatest(x, y), F.lit("pixels aren't square: their mean is taken")),
        F.when(fps.isNull(), F.lit("no frame rate")), F.when(um.isNull(), F.lit("no pixel size")), F.when(F.coalesce(frames, F.lit(0)) < 2, F.lit("fewer than two frames")),
    ]
    return read.select("path", fps.alias("fps"), um.alias("um_per_px"), frames.cast("int").alias("n_frames"), F.filter(F.array(*said), lambda n: n.isNotNull()).alias("notes"), *[F.col(f"_v{i}").alias(k) for i, k in enumerate(values)])


def page_times(tags: DataFrame, high: str = "32781", low: str = "32782") -> DataFrame:
    """(run, page, tags, timestamp_ns, t_seconds, delta_ms) from (run, page, tags: map of text)."""
    ns = X.hardware_ns(F.col("tags")[high], F.col("tags")[low])
    w = Window.partitionBy("run").orderBy("page")
    timed = tags.withColumn("timestamp_ns", ns)
    return timed.withColumns({"t_seconds": F.round((F.col("timestamp_ns") - F.first("timestamp_ns").over(w)) / 1e9, 6), "delta_ms": F.round((F.col("timestamp_ns") - F.lag("timestamp_ns").over(w)) / 1e6, 3)})


def camera_rate(tags: DataFrame, fallback: float = 15.0) -> DataFrame:
    """(run, fps, source): pages less one over the span of their stamps, else the fallback and why."""
    t = page_times(tags)
    span = F.max("timestamp_ns") - F.min("timestamp_ns")
    return t.groupBy("run").agg(F.try_divide(1e9 * (F.count("timestamp_ns") - 1), span).alias("_r"), F.count("*").alias("_n")).select(
        "run",
        F.coalesce("_r", F.lit(fallback)).alias("fps"),
        F.when(F.col("_r").isNotNull(), "timestamps").when(F.col("_n") < 2, "fallback (single page)").otherwise("fallback (no timestamps)").alias("source"),
    )
