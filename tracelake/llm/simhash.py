"""SimHash fingerprints and covering locality-sensitive hashing.

The fingerprint is the bitwise majority of the XXH64 hashes of a text's word shingles.
Candidate search is covering LSH (Pagh, 2016): for a radius r every bit position gets
a non-zero vector of r+1 bits, and each of the 2**(r+1)-1 non-zero vectors v gives a
table whose mask keeps the positions with an odd inner product with v. Any r positions
give r linear conditions on r+1 bits, so some v is orthogonal to all of them: two
fingerprints within the radius agree under that table's mask. Nothing is missed.

Links are found between distinct fingerprints, in steps that never emit all pairs of a
bucket. First every fingerprint is compared with its bucket's least one and with its
neighbour in the bucket's order, and the links give first components. Only buckets that
hold several components are compared further: members outside the bucket's least
component against members of other components. A bucket of more than LARGE members is
first dealt anew by the masks of another covering family, which again miss nothing. A
mask fixes about half of the bits, so after REFINED more families a bucket's members
differ in a few bits only and are few, whatever the data.

Cases: null and empty texts have fingerprint zero and link like any other; texts with
fewer words than a shingle are one shingle; equal texts and repeated rows share a
component; ids may have any type that has an order. Rows with a null id link like any
other; a component's id is its least id, null where no row of it has one. An empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm import common
from tracelake.llm.components import connected

BITS = 64
#: Members of a bucket that are compared; a larger one is dealt anew, up to so many times.
LARGE, REFINED = 256, 3
#: Rows up to which the documents that go are broadcast (about 50 bytes each).
FEW = 500_000


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """64-bit fingerprint of a text's lower-cased word shingles."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[shingle - 1 :].tolist() if len(words) >= shingle else [len(joined)]
    h = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):  # long texts in parts
        hashes = np.fromiter((h(joined[a:b], seed) for a, b in zip(starts[at : at + 65536], stops[at : at + 65536], strict=True)), np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in range(BITS) if 2 * counts[i] > n)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp bigint: the fingerprint's bits as a signed integer, digest: of the text). No shuffle."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fps = np.array([fingerprint(x, shingle, seed) for x in frame["text"]], np.uint64)
            yield pd.DataFrame({"id": frame["id"].array, "fp": fps.astype(np.int64), "digest": frame["digest"]})

    kind = df.schema[id_col].dataType.simpleString()
    text = F.col(text_col).cast("string")
    source = df.select(F.col(id_col).alias("id"), text.alias("text"), digest(text).alias("digest"))
    return common.map_slices(source, run, f"id {kind}, fp long, digest string")


def digest(text: Column) -> Column:
    """Tells apart the texts of rows that share an id."""
    return F.coalesce(F.md5(text), F.lit("none"))


def masks(radius: int, bits: int = BITS, family: int = 0) -> list[int]:
    """A covering family's masks as signed 64-bit integers, one for each table."""
    vectors = 2 ** (radius + 1) - 1
    phi = [1 + i % vectors for i in range(bits)]
    if family:
        random.Random(family).shuffle(phi)
    out = []
    for v in range(1, vectors + 1):
        mask = sum(1 << i for i in range(bits) if (phi[i] & v).bit_count() & 1)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _near(a: str, b: str, radius: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius


def _tables(radius: int, family: int) -> Column:
    return F.posexplode(F.array(*[F.lit(m).cast("bigint") for m in masks(radius, family=family)])).alias("t", "mask")


def link(points: DataFrame, radius: int) -> DataFrame:
    """(fp, component: the least fingerprint that it reaches) for distinct ``points`` (fp) that have a link."""
    keyed = points.select("fp", _tables(radius, 0)).select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    order = Window.partitionBy("t", "key").orderBy("fp")
    beside = keyed.select("*", F.first("fp").over(order).alias("least"), F.lag("fp").over(order).alias("before"), F.lead("fp").over(order).alias("after"))
    members = common.stored(beside.filter("before is not null or after is not null").drop("after"), "buckets")
    pairs = F.explode(F.array("least", "before")).alias("b")
    first = members.filter("before is not null").select(F.col("fp").alias("a"), pairs).filter(_near("a", "b", radius)).distinct()
    joined = common.stored(connected(first), "components")
    of = members.select("t", "key", "fp").join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    of = _open(of.select(F.array(F.col("t").cast("bigint"), "key").alias("bucket"), "fp", "component"))
    met = None
    for family in range(1, REFINED + 1):
        of = common.stored(of, "open")
        few = _met(of.filter(F.col("n") <= LARGE), radius)
        met = few if met is None else met.union(few)
        of = of.filter(F.col("n") > LARGE)
        if of.isEmpty():
            break
        again = of.select("bucket", "fp", "component", _tables(radius, family))
        of = _open(again.select(F.concat("bucket", F.array(F.col("t").cast("bigint"), F.col("fp").bitwiseAND(F.col("mask")))).alias("bucket"), "fp", "component"))
    else:
        met = met.union(_met(of, radius))
    # components of components, and back to fingerprints
    above = connected(met.distinct()).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    return joined.join(above, "component", "left").select(F.col("node").alias("fp"), F.coalesce("whole", "component").alias("component")).union(
        above.join(joined.select(F.col("node").alias("component")), "component", "left_anti")
    )


def _open(of: DataFrame) -> DataFrame:
    """Members (bucket, fp, component) of buckets with several components, with the least of these and the number of members."""
    whole = Window.partitionBy("bucket")
    counted = of.withColumns({"low": F.min("component").over(whole), "high": F.max("component").over(whole), "n": F.count("*").over(whole)})
    return counted.filter("low <> high").drop("high")


def _met(of: DataFrame, radius: int) -> DataFrame:
    """Pairs of components with members within the radius."""
    left = of.filter("component <> low").select("bucket", F.col("fp").alias("fp_l"), F.col("component").alias("a"))
    right = of.select("bucket", F.col("fp").alias("fp_r"), F.col("component").alias("b"))
    return left.join(right, "bucket").filter((F.col("a") != F.col("b")) & _near("fp_l", "fp_r", radius)).select("a", "b")


def _classes(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, class) of every fingerprint."""
    points = common.stored(prints.select("fp").distinct(), "points")
    return points.join(link(points, radius), "fp", "left").select("fp", F.coalesce("component", "fp").alias("class"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, shingle: int = 4, seed: int = 42) -> DataFrame:
    """(id, fingerprint: 16 lower-case hex digits, component_id: least id reachable)."""
    prints = common.stored(fingerprints(df, id_col, text_col, shingle, seed), "fingerprints")
    classes = common.stored(_classes(prints, radius), "classes")
    least = prints.groupBy("fp").agg(F.min("id").alias("least")).join(classes, "fp")
    named = least.join(least.groupBy("class").agg(F.min("least").alias("component_id")), "class").select("fp", "component_id")
    out = prints.join(named, "fp").select("id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
    return out.withColumnRenamed("id", id_col)


def representatives(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, shingle: int = 4, seed: int = 42, few: int = FEW) -> DataFrame:
    """One row of each component, with its own columns.

    It is the row with the least id (rows without an id come last), of rows that share
    it the one with the least digest of its text, of rows that are equal in both any one.
    The rows that go are found in a narrow table; where they are ``few``, which is
    counted, they are broadcast and no text is shuffled.
    """
    prints = common.stored(fingerprints(df, id_col, text_col, shingle, seed), "fingerprints")
    classes = common.stored(_classes(prints, radius), "classes")
    # keys without nulls
    rows = prints.select(F.col("id").isNull().alias("_none"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("_id"), "id", F.col("digest").alias("_digest"), "fp")
    each = rows.groupBy("fp", "_none", "_id", "_digest").agg(F.min("id").alias("id"), F.count("*").alias("n")).join(classes, "fp")
    best = each.groupBy("class").agg(F.min(F.struct("_none", "id", "_digest", "_id")).alias("best"))
    marked = each.join(best, "class").withColumn("stays", (F.col("_id") == F.col("best._id")) & (F.col("_none") == F.col("best._none")) & (F.col("_digest") == F.col("best._digest")))
    key = ["_none", "_id", "_digest"]
    goes = common.stored(marked.filter("not stays or n > 1").select(*key, "stays"), "goes")
    tagged = df.select(F.struct("*").alias("row"), F.col(id_col).isNull().alias("_none"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), digest(F.col(text_col).cast("string")).alias("_digest"))
    small = F.broadcast if goes.count() <= few else lambda x: x
    kept = tagged.join(small(goes), key, "left")
    once = kept.filter("stays is null").select("row.*")
    again = kept.filter("stays").dropDuplicates(key).select("row.*")  # repeated rows of which one stays
    return once if goes.filter("stays").isEmpty() else once.unionByName(again)
