"""Tables in the folder that driver and executors share: what several later steps read is written once.

The folder is the session's ``spark.checkpoint.dir``. Who sets it clears it: a result is
computed when it is read, so the tables it is read from outlive the call that wrote them.
Where a result is itself written at once, ``scope`` removes what it was made from.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scopes: list[list[str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder.

    In a local session without one, as in tests, a temporary folder is made and set; on
    a cluster executors would not see it, so there the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs its running tasks only, and what
    follows reads the table instead of computing ``df`` again.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[list[str]]:
    """Tables stored inside are removed at the end, but for those taken from the list that it gives.

    For a caller that stores its result as the last thing inside, and takes that out. After an
    error all stay, for a look at them.
    """
    _scopes.append([])
    try:
        yield _scopes[-1]
    except BaseException:
        _scopes.pop()
        raise
    for path in _scopes.pop():
        remove(spark, path)
