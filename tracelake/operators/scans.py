"""Running values along a series, in blocks: a block gives a summary, a scan over the summaries gives each block what it starts with.

A window by series would sort all of it in one task. Here rows are dealt by series and
block, so that a task holds blocks; only one row a block takes part in the window by series.
The dealt rows are read twice (for the summaries and for the rows), from one shuffle.

Cases: blocks may be empty; nulls are passed over; rows of equal order come in any order;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Frames in a block.
BLOCK = 65_536

SUM, LAST, BEFORE, NEXT, AFTER = "sum", "last", "before", "next", "after"


def block_of(position: Column | str, size: int | float = BLOCK) -> Column:
    """The block of a position; negative positions have negative blocks."""
    return F.floor((F.col(position) if isinstance(position, str) else position) / F.lit(size)).cast("bigint")


def dealt(df: DataFrame, keys: Sequence[str], block: Column) -> DataFrame:
    """Rows with their ``block``, those of a series' block in one task."""
    return df.withColumn("block", block).repartition(*keys, "block")


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, tuple[str, Column]], back: Sequence[str] | None = None) -> DataFrame:
    """Adds running values to rows that ``dealt`` has dealt; blocks follow ``order``, the block's own place first.

    Kinds: the sum up to a row (with it), the LAST value that isn't null up to a row, that
    BEFORE it, the NEXT from it on, that AFTER it. The latter two walk from the end, where
    rows with equal order may be wanted otherwise: ``back`` is then what they follow.
    """
    forth = [F.col(c).asc() for c in order]
    turned = [F.col(c).desc() for c in order] if back is None else [F.col(back[0]).desc(), *[F.col(c).asc() for c in back[1:]]]
    upto, ahead = (Window.partitionBy(*keys, "block").orderBy(*o) for o in (forth, turned))
    first = Window.unboundedPreceding
    blocks = Window.partitionBy(*keys)
    inside: dict[str, Column] = {}
    totals, carried = [], {}
    place = F.struct(*order)
    for name, (kind, value) in values.items():
        if kind == SUM:
            inside[name] = F.sum(value).over(upto.rowsBetween(first, 0))
            totals.append(F.sum(value).alias(name))
            carried[name] = F.sum(name).over(blocks.orderBy("block").rowsBetween(first, -1))
            continue
        there = value.isNotNull()
        on = kind in (LAST, BEFORE)
        window = (upto if on else ahead).rowsBetween(first, 0 if kind in (LAST, NEXT) else -1)
        inside[name] = F.last(value, ignorenulls=True).over(window)
        pick = F.max_by if on else F.min_by
        totals.append(pick(value, F.when(there, place)).alias(name))
        side = blocks.orderBy("block" if on else F.desc("block")).rowsBetween(first, -1)
        carried[name] = F.last(name, ignorenulls=True).over(side)
    summary = df.groupBy(*keys, "block").agg(*totals)
    starts = summary.select(*keys, "block", *[c.alias(f"_from_{n}") for n, c in carried.items()])
    out = df.withColumns(inside).join(starts, [*keys, "block"])
    joined = {n: F.coalesce(n, F.lit(0)) + F.coalesce(f"_from_{n}", F.lit(0)) if kind == SUM else F.coalesce(n, f"_from_{n}") for n, (kind, _) in values.items()}
    return out.withColumns(joined).drop(*[f"_from_{n}" for n in values])
