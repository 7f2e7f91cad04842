"""Results as files: idempotent tables by run, wide exports, sidecars, and reading back.

Cases: nulls are written as nulls and read back as such; repeated rows are kept; an empty
table writes an empty one, which names no run as done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.operators import checks
from tracelake.operators.alignment import unfinished


def save_runs(df: DataFrame, path: str, force: bool = False) -> None:
    """Write a table partitioned by run; runs that are there already are left, or replaced with ``force``.

    The committer makes files appear as a whole, and ``_SUCCESS`` marks the end.
    """
    spark = df.sparkSession
    if not force and exists(spark, path):
        df = unfinished(df, spark.read.parquet(path))
    df.write.mode("overwrite" if force else "append").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_runs(spark: SparkSession, path: str, schema: str | None = None, defaults: dict[str, str] | None = None) -> DataFrame:
    """Read back; columns that older files lack take SQL defaults."""
    df = (spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")).parquet(path)
    for name, value in (defaults or {}).items():
        df = df.withColumn(name, F.coalesce(F.col(name), F.expr(value)) if name in df.columns else F.expr(value))
    return df


def save_sidecars(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_summary(df: DataFrame, path: str) -> None:
    """One line for each run; a rerun replaces its own line, other runs' stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").csv(path, header=True)


def wide(df: DataFrame, names: list[str]) -> DataFrame:
    """(run, frame, a column for each of ``names``) of (run, channel, frame, v)."""
    return df.groupBy("run", "frame").pivot("channel", names).agg(F.first("v"))


def save_tags(tags: DataFrame, path: str) -> None:
    """A CSV with a column for each tag that any page has."""
    keys = sorted(r[0] for r in tags.select(F.explode(F.map_keys("tags"))).distinct().collect())  # names of tags: a few dozen
    tags.select("run", "page", *[F.col("tags")[k].alias(k) for k in keys]).write.mode("overwrite").csv(path, header=True)


def verified(df: DataFrame, path: str) -> bool:
    """Whether what was written reads back as the same rows."""
    found = checks.same_rows(df, df.sparkSession.read.schema(df.schema).parquet(path)).first()
    return found["missing"] == 0 and found["extra"] == 0
