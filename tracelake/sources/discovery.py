"""Finding recordings: file listings as tables, and the rules that make runs of them.

A listing is (path, length); nothing is read but names and sizes.

Cases: paths are distinct and not null; files of equal names keep their folder apart; an
empty listing has no folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelake.functions import expressions as X


def listing(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, folder, name, length) of all files under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "length")
    return split_path(files)


def split_path(files: DataFrame) -> DataFrame:
    return files.select("path", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"), F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "length")


def images(files: DataFrame) -> DataFrame:
    """TIFF files that are neither hidden nor empty."""
    return files.filter(F.lower("name").rlike(r"\.tiff?$") & ~F.col("name").startswith(".") & (F.col("length") > 0))


def in_order(files: DataFrame) -> DataFrame:
    """Adds ``part``: a file's place in its folder by natural order."""
    return files.withColumn("part", F.row_number().over(Window.partitionBy("folder").orderBy(X.natural_key(F.col("name")), "name")) - 1)


def series(files: DataFrame, marker: str = r"^TSeries.*\.xml$") -> DataFrame:
    """(folder, xml) of folders with a metadata file, the shortest name first; folders inside one of them and hidden ones don't count."""
    hits = files.filter(F.col("name").rlike(marker) & ~F.col("folder").rlike(r"/\."))
    own = hits.groupBy("folder").agg(F.min_by("name", F.struct(F.length("name"), "name")).alias("xml"))
    depth = F.size(F.split("folder", "/"))
    parents = own.select("folder", F.explode(F.sequence(F.lit(1), depth - 1)).alias("k"), "xml").select(F.col("folder").alias("inner"), F.expr("array_join(slice(split(folder, '/'), 1, k), '/')").alias("folder"))
    nested = parents.join(own.select("folder"), "folder").select(F.col("inner").alias("folder")).distinct()
    return own.join(nested, "folder", "left_anti")


def runs(files: DataFrame, outputs: str = "proc") -> DataFrame:
    """(folder, n, bytes) of folders with images, outside output and hidden folders."""
    return images(files).filter(~F.col("folder").rlike(rf"/(\.[^/]*|{outputs})(/|$)")).groupBy("folder").agg(F.count("*").alias("n"), F.sum("length").alias("bytes"))


def runs_of_roots(*listings: DataFrame, outputs: str = "proc") -> DataFrame:
    """(folder, n, bytes, root) over several roots in order; a folder that more than one root holds counts for the first."""
    out = None
    for i, files in enumerate(listings):
        part = runs(files, outputs).withColumn("root", F.lit(i))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("folder").agg(F.min(F.struct("root", "n", "bytes")).alias("r")).select("folder", "r.n", "r.bytes", "r.root")


def any_runs(files: DataFrame) -> DataFrame:
    """(folder, n) of all folders with TIFF files, empty and hidden ones too."""
    return files.filter(F.lower("name").rlike(r"\.tiff?$")).groupBy("folder").agg(F.count("*").alias("n"))


def parts_to_read(parts: DataFrame, expected: DataFrame) -> DataFrame:
    """(run, part, n) of the parts that make a run: the first alone if it has the ``expected`` frames, else all of them.

    A series that was not broken names all its files in the first one.
    """
    first = parts.groupBy("run").agg(F.min(F.struct("part", "n")).alias("f"))
    chosen = parts.join(first, "run").join(expected, "run", "left")
    alone = F.coalesce(F.col("f.n") == F.col("expected"), F.lit(False))
    return chosen.filter(~alone | (F.col("part") == F.col("f.part"))).select("run", "part", "n")


def tiers(runs_: DataFrame, needed: dict[str, DataFrame], wanted: dict[str, DataFrame]) -> DataFrame:
    """(run, missing: names of ``wanted`` tables without the run); a run that a ``needed`` table lacks raises when it is read."""
    for name, table in (needed | wanted).items():
        runs_ = runs_.join(table.select("run").distinct().withColumn(f"_{name}", F.lit(True)), "run", "left")
    for name in needed:
        lacking = F.raise_error(F.concat(F.lit(f"{name} is missing for "), F.col("run").cast("string"))).cast("boolean")
        runs_ = runs_.filter(F.when(F.col(f"_{name}"), F.lit(True)).otherwise(lacking))
    missing = F.filter(F.array(*[F.when(F.col(f"_{name}").isNull(), F.lit(name)) for name in wanted]), lambda x: x.isNotNull())
    return runs_.select("run", missing.cast("array<string>").alias("missing"))


def neural_traces(rows: DataFrame, label_image: DataFrame) -> DataFrame:
    """(run, roi, frame, f, cx, cy) from (run, row, values: array) and the labelled pixels (run, roi, y, x).

    Row k of a run belongs to its label k, so both must be as many; a matrix that lies on
    its side (as many values in a row as there are labels) raises and says so. Centres
    come from the label image.
    """
    centres = label_image.groupBy("run", "roi").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    labels = centres.groupBy("run").agg(F.count("*").alias("labels"))
    shape = rows.groupBy("run").agg(F.count("*").alias("rows"), F.max(F.size("values")).alias("columns")).join(labels, "run")
    wrong = F.when(F.col("columns") == F.col("labels"), "the matrix is transposed: ").otherwise("rows and labels differ: ")
    sound = shape.filter(F.when(F.col("rows") == F.col("labels"), F.lit(True)).otherwise(F.raise_error(F.concat(wrong, F.col("run").cast("string"))).cast("boolean")))
    flat = rows.join(sound.select("run"), "run").select("run", (F.col("row") + 1).alias("roi"), F.posexplode("values").alias("frame", "f"))
    return flat.join(centres, ["run", "roi"])


def movie_of(files: DataFrame) -> DataFrame:
    """(folder, path): the first OME file by natural order, else the largest TIFF."""
    rank = Window.partitionBy("folder").orderBy(F.desc(F.lower("name").contains(".ome.")), F.when(F.lower("name").contains(".ome."), X.natural_key(F.col("name"))), F.desc("length"), "name")
    return images(files).withColumn("_i", F.row_number().over(rank)).filter("_i = 1").select("folder", "path")


def single_channel(files: DataFrame) -> DataFrame:
    """(folder, channel); a folder with files of several channels raises."""
    of = images(files).withColumn("c", X.channel_of_file(F.col("name"))).filter("c <> ''").groupBy("folder").agg(F.count_distinct("c").alias("n"), F.min("c").alias("channel"))
    return of.select("folder", F.when(F.col("n") == 1, F.col("channel")).otherwise(F.raise_error(F.concat(F.lit("several channels in "), F.col("folder")))).alias("channel"))


def manifest(folders: DataFrame) -> DataFrame:
    """(idx, folder): a frozen list with numbers from 0, by path."""
    return folders.select("folder").distinct().withColumn("idx", F.row_number().over(Window.orderBy("folder")) - 1)  # one row a recording


def pick(frozen: DataFrame, idx: int) -> DataFrame:
    """The run with a number; an unknown number raises."""
    found = frozen.filter(F.col("idx") == idx)
    if found.isEmpty():
        raise IndexError(f"no run has the number {idx}")
    return found


def companions(files: DataFrame) -> DataFrame:
    """(folder, name, length, voltage): files beside a series' images."""
    return files.filter(~F.lower("name").rlike(r"\.tiff?$")).select("folder", "name", "length", F.col("name").contains("VoltageRecording").alias("voltage"))


def trace_file(files: DataFrame, suffix: str = "_boxtraces.parquet", least: int = 1024) -> DataFrame:
    """(folder, path): the one trace file of a folder; several, or one under ``least`` bytes, raise."""
    own = files.filter(F.col("name").endswith(suffix)).groupBy("folder").agg(F.count("*").alias("n"), F.min("path").alias("path"), F.min("length").alias("length"), F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("names"))
    good = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("several trace files: "), F.col("names")))).when(F.col("length") < least, F.raise_error(F.concat(F.lit("too small to be a trace file: "), F.col("path")))).otherwise(F.col("path"))
    return own.select("folder", good.alias("path"))


def output_path(folder, root: str, out: str):
    """Where a run's results go: the same path under another root."""
    return F.concat(F.lit(out.rstrip("/")), F.substring(folder, len(root.rstrip("/")) + 1, 1 << 20))


def flat_name(folder, root: str):
    """A result's name outside its tree: its path with separators as underscores."""
    return F.regexp_replace(F.regexp_replace(F.substring(folder, len(root.rstrip("/")) + 2, 1 << 20), "/", "__"), r"\s+", "_")
