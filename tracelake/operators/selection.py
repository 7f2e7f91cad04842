"""Exact ranks and quantiles without a task for each group: counts of values, dealt by ranges.

Equal values are counted first, so a value that fills a third of a group is one row. The
counts are then dealt by ranges of group and value over all tasks, and written; each part
of a group gets the number of values before it from the parts' totals, of which there is
one row for each part and group. So a large group is spread over many tasks, and no task
sorts a group.

Cases: null values count nowhere; not-a-number is larger than any number; -0.0 is 0.0; a
group without values has no row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.sources.shared import stored


def value_counts(df: DataFrame, keys: Sequence[str], value: Column, name: str = "value", parts: int | None = None) -> DataFrame:
    """(keys, value, n, before, of): how often a value comes, how many values of its group are smaller, and how many it has."""
    counts = df.select(*keys, value.alias(name)).filter(F.col(name).isNotNull()).groupBy(*keys, name).agg(F.count("*").alias("n"))
    ranges = counts.repartitionByRange(*([parts] if parts else []), *keys, name).withColumn("_part", F.spark_partition_id())
    dealt = stored(ranges, "counts")
    totals = dealt.groupBy(*keys, "_part").agg(F.sum("n").alias("_n"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"), F.sum("_n").over(whole).alias("of"))
    inside = Window.partitionBy(*keys, "_part").orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(totals, same).select(*keys, name, "n", (F.col("_first") + F.col("_inside")).alias("before"), "of")


def quantiles(df: DataFrame, keys: Sequence[str], value: Column, points: dict[str, float], parts: int | None = None) -> DataFrame:
    """(keys, a column for each point): between the two nearest values, by the distance to them."""
    counts = value_counts(df, keys, value, "_v", parts)
    out = []
    for name, p in points.items():
        place = F.lit(float(p)) * (F.col("of") - 1)
        low, high = F.floor(place), F.ceil(place)
        at = lambda k: (F.col("before") <= k) & (k < F.col("before") + F.col("n"))
        a, b = F.max(F.when(at(low), F.col("_v").cast("double"))), F.max(F.when(at(high), F.col("_v").cast("double")))
        out.append((a + (b - a) * F.max(place - low)).alias(name))
    return counts.groupBy(*keys).agg(*out)


def average_ranks(df: DataFrame, column: str, out: str, by: Sequence[str], parts: int | None = None) -> DataFrame:
    """Adds ranks from 1; equal values share the mean of their ranks, null values have none."""
    ranks = value_counts(df, by, F.col(column), "_value", parts)
    ranks = ranks.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(by)], F.col("_value"), (F.col("before") + (F.col("n") + 1) / 2.0).alias(out))
    same = F.col(column).eqNullSafe(F.col("_value"))
    for i, k in enumerate(by):
        same = same & F.col(k).eqNullSafe(F.col(f"_r{i}"))
    return df.join(ranks, same, "left").drop("_value", *[f"_r{i}" for i in range(len(by))])
