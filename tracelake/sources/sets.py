"""Sets of tables that appear together: data in a staging folder, a manifest of its files, and a numbered name as the only commit.

A version of a set is a manifest: for each table its schema, and for each of its files the
run, rows and bytes. Tables are written beside those of other versions, read back, and
compared with what went in by count and digest; then the manifest is put under the next
number, which fails if another writer was first. Readers take the files that the last
manifest names and nothing else, so a write that was killed leaves the version before it
as it was, and files of no version are garbage that ``expire`` removes.

A commit replaces the runs it has in all tables of the set: tables that it doesn't bring
lose these runs, so that no result outlives what it was made from. Other runs stay.

Cases: a null run is a run of its own; repeated rows are kept; a table without rows is in
the set, with its schema; a set without versions raises when it is read.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _files(spark: SparkSession, path: str):
    """Hadoop's context for a path: its renames don't overwrite."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    return where.getFileSystem(conf), jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri() if "://" in path else where.getFileSystem(conf).getUri(), conf)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _digest(columns: list[str]) -> list[Column]:
    """Rows and the sum of their hashes, whatever their order."""
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("digest")]


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the set's manifests, ascending."""
    files, _ = _files(spark, path)
    folder = _path(spark, f"{path}/manifests")
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """A version's manifest; the last one's unless a number is given."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no version of a set is at {path}")
    number = known[-1] if version is None else version
    text = spark.read.text(f"{path}/manifests/{number:08d}.json", wholetext=True).first()[0]
    return json.loads(text)


def _staged(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    files, _ = _files(spark, folder)
    found, at = [], files.listFiles(_path(spark, folder), True)
    while at.hasNext():
        status = at.next()
        name = status.getPath().toString()
        if name.endswith(".parquet"):
            found.append((name, status.getLen()))
    return sorted(found)


def save(tables: dict[str, DataFrame], path: str, runs: DataFrame | None = None, sort: tuple[str, ...] = ()) -> int:
    """Commits tables with a column ``run`` as the set's next version; returns its number.

    ``runs``: (run) of the runs that this commit stands for, if some have no rows in any
    table; else those that the tables have.
    """
    spark = next(iter(tables.values())).sparkSession
    files, context = _files(spark, path)
    known = versions(spark, path)
    old = manifest(spark, path, known[-1]) if known else {"tables": {}}
    stage = f"{path}/data/{uuid.uuid4().hex}"
    fresh: dict[str, dict] = {}
    for name, table in tables.items():
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        rows = table.observe(seen, *_digest(table.columns)).withColumn("_run", F.col("run").cast("string"))
        rows = rows.repartition("_run") if not sort else rows.repartition("_run").sortWithinPartitions("_run", *sort)
        rows.write.partitionBy("_run").parquet(f"{stage}/{name}")
        listed = _staged(spark, f"{stage}/{name}")
        back = _read(spark, [f for f, _ in listed], table.schema)
        counts = {r["file"]: r for r in back.groupBy(F.col("_metadata.file_path").alias("file"), F.col("run").cast("string").alias("run")).agg(F.count(F.lit(1)).alias("n")).collect()} if listed else {}  # a row a file
        found = back.agg(*_digest(table.columns)).first()
        if not found["n"] and table.isEmpty():
            pass  # Spark doesn't run an empty plan, and so observes nothing
        elif (found["n"], found["digest"]) != (seen.get["n"], seen.get["digest"]):
            raise OSError(f"{name} doesn't read back as it was written: {found['n']} rows, {seen.get['n']} were")
        by_name = {_tail(unquote(f)): r for f, r in counts.items()}  # Spark's names of files are encoded
        if sum(r["n"] for f, r in by_name.items()) != found["n"] or len(by_name) != len(counts) or set(by_name) - {_tail(f) for f, _ in listed}:
            raise OSError(f"files of {name} aren't those that were written")
        fresh[name] = {"schema": json.loads(table.schema.json()), "files": [{"path": _relative(f, path), "run": by_name[_tail(f)]["run"], "rows": by_name[_tail(f)]["n"], "bytes": size} for f, size in listed if _tail(f) in by_name]}
    replaced = {f["run"] for t in fresh.values() for f in t["files"]}
    if runs is not None:
        replaced |= {r[0] for r in runs.select(F.col("run").cast("string")).distinct().collect()}
    merged = {}
    for name in {**old["tables"], **fresh}:
        kept = [f for f in old["tables"].get(name, {"files": []})["files"] if f["run"] not in replaced]
        merged[name] = {"schema": fresh.get(name, old["tables"].get(name))["schema"], "files": kept + fresh.get(name, {"files": []})["files"]}
    number = known[-1] + 1 if known else 1
    text = json.dumps({"version": number, "tables": merged}, sort_keys=True)
    draft = _path(spark, f"{path}/manifests/.{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    none = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = none
    context.rename(draft, _path(spark, f"{path}/manifests/{number:08d}.json"), options)  # raises if the number is taken
    return number


def _tail(file: str) -> str:
    return "/".join(file.split("/")[-3:])


def _relative(file: str, path: str) -> str:
    mark = "/data/"
    return "data/" + file[file.rindex(mark) + len(mark) :]


def _read(spark: SparkSession, files: list[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, name: str, version: int | None = None, runs: tuple[str, ...] | None = None) -> DataFrame:
    """A table of the set, from the files of one version; of some runs only, their files only."""
    said = manifest(spark, path, version)["tables"][name]
    chosen = [f"{path}/{f['path']}" for f in said["files"] if runs is None or f["run"] in runs]
    return _read(spark, chosen, StructType.fromJson(said["schema"]))


def audit(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(table, run, path, problem) of files that are gone, of another length, or of another number of rows than the manifest says."""
    files, _ = _files(spark, path)
    said = manifest(spark, path, version)["tables"]
    listed = [(name, f["run"], f["path"], f["rows"], f["bytes"]) for name, t in said.items() for f in t["files"]]
    rows = []
    for name, run, at, n, size in listed:
        where = _path(spark, f"{path}/{at}")
        there = files.getFileStatus(where).getLen() if files.exists(where) else None
        rows.append((name, run, at, "missing" if there is None else "length" if there != size else None, n))
    whole = spark.createDataFrame(rows, "table string, run string, path string, problem string, n long")
    sound = [f"{path}/{r[2]}" for r in rows if r[3] is None]
    if sound:
        counted = spark.read.parquet(*sound).groupBy(F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), r"(data/[0-9a-f]{32}/.*)$", 1).alias("path")).agg(F.count(F.lit(1)).alias("found"))
        whole = whole.join(counted, "path", "left").withColumn("problem", F.coalesce("problem", F.when(F.coalesce("found", F.lit(0)) != F.col("n"), "rows")))
    return whole.filter("problem is not null").select("table", "run", "path", "problem")


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Removes all but the last ``keep`` versions, and every file that none of those names; returns how many files went.

    Not while another writer stages tables here.
    """
    files, _ = _files(spark, path)
    known = versions(spark, path)
    named = {f["path"] for v in known[-keep:] for t in manifest(spark, path, v)["tables"].values() for f in t["files"]}
    gone = 0
    for file, _ in _staged(spark, f"{path}/data"):
        if _relative(file, path) not in named:
            files.delete(_path(spark, file), False)
            gone += 1
    for v in known[:-keep]:
        files.delete(_path(spark, f"{path}/manifests/{v:08d}.json"), False)
    return gone
