"""Quality rules: word statistics, and the perplexity of a modified Kneser-Ney model.

The model is over bytes: a text's words are lower-cased (A-Z), joined by one blank and
ended by byte 254; bytes 255 stand before the first (UTF-8 has neither). Spark counts
the ``order``-grams of each language over all documents; tasks sum their own first.
Everything else follows from that table with grouping and windows whose partitions have
at most 256 rows (the bytes that can follow a context):

    p_k(b|c) = max(a_k(cb) - D_k(a_k(cb)), 0) / A_k(c) + g_k(c) p_(k-1)(b|c'),

with a_k the count for the highest order and the number of distinct bytes before the
gram for the others, A_k(c) their sum over b, c' the context without its first byte,
three discounts D for each order and language from the counts of counts (Chen and
Goodman, 1999), and g_k(c) what the discounts take from c. p_0 is uniform.

How it is solved. Each level's counts follow from those of the level above. One pass
over the counts of counts gives the discounts, one window by context what they take;
then grams meet by their last two bytes, so that a group holds a gram and all its
suffixes, and are solved with arrays, packed for each language.

The model scores the documents that it is counted on, so each gram has an entry. (A
document's own counts are not taken out: that changes the discounts and the counts of
all lower orders, and what recurs over many documents looks as fluent as before.) An
entry's logarithm is a whole number of 1/UNIT bits, so that sums are exact in any order.
The entries of a language become two arrays in a task, sorted by the grams' 64-bit
hashes (a bijection, so none collide). Packed, they are broadcast if they are at most
``broadcast_grams``, which is checked, and removed when the documents are scored; else
documents' distinct grams meet the entries in a join, which gives the same sums.

A language's bands lie ``fence`` interquartile ranges outside the quartiles of its
documents' bits per byte (documents that pass the base rules, on a grid of 1/1000 bit,
so that quartiles come from a small histogram and no task sorts a language). The
quartiles of a language with n documents are shrunk towards those of all documents, at
the weight n / (n + ``prior``): a language has bands however few documents it has. A
mean over few bytes varies more, so a document of n bytes gets ``noise`` / sqrt(n) on
either side. A document outside is rejected.

Cases: null and empty texts have no words and fail the base rules; a null language is a
language of its own; repeated rows count each time and get equal verdicts; columns
with any name are kept as they are by ``judge``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm import common

ORDER = 5
START, END = 255, 254
#: Entries that a broadcast may have (at most 9 bytes each packed, about 5 as measured).
BROADCAST_GRAMS = 4_000_000
#: Parts of a bit in which logarithms are stored: below 64 bits, they fit 32-bit integers.
UNIT = 1 << 24
#: Rows that a task solves at once, and rows that go from Python to Spark at once.
SOLVED_ROWS, BATCH_ROWS = 200_000, 50_000
#: Bytes of text that arrays are made from at once; distinct grams that a task holds.
CHUNK_BYTES = 1 << 20
HELD_GRAMS = 1_000_000
#: Languages up to which a table with one row for each is broadcast.
FEW = 10_000
FENCE, NOISE, PRIOR, GRID = 2.0, 1.0, 50, 1000
MIN_WORDS, REPEATED = 50, 0.5

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_features(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    if not text:
        return 0, 0, 0, 0, 0
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    n, repeated = len(words), 0
    if n >= 4:
        known: dict[str, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
        if len(known) < 1 << 21:
            windows = ids[:-2] << 42 | ids[1:-1] << 21 | ids[2:]
            codes, u = pd.factorize(windows)
        else:
            codes, u = pd.factorize(pd.MultiIndex.from_arrays([ids[:-2], ids[1:-1], ids[2:]]))
        at = np.flatnonzero(np.bincount(codes, minlength=len(u))[codes] > 1)
        inside = np.zeros(n, bool)
        for k in range(3):
            inside[at + k] = True
        repeated = int(inside.sum())
    return n, sum(map(len, words)), len(_SYMBOL.findall(text)), len(lines) - len(set(lines)), repeated


def stream(text: str | None) -> bytes:
    """What the model sees of a text, without its start and end."""
    return b" ".join((text or "").encode().lower().split())  # bytes split on ASCII white space


def grams(bodies: list[bytes], order: int = ORDER, limit: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each position's gram, packed with its last byte lowest, and the number of its text."""
    pad = bytes([START]) * (order - 1)

    def packed(data: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data) - order + 1
        out = np.zeros(n, np.int64)
        for j in range(order):
            out |= data[j : j + n].astype(np.int64) << (8 * (order - 1 - j))
        keep = data[order - 1 :] != START
        return out[keep], owner[order - 1 :][keep]

    def joined(first: int, items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        whole = b"".join(pad + x + bytes([END]) for x in items)
        sizes = np.array([len(x) for x in items]) + order
        return packed(np.frombuffer(whole, np.uint8), np.repeat(np.arange(first, first + len(items)), sizes))

    batch: list[bytes] = []
    first = size = 0
    for i, body in enumerate(bodies):
        if len(body) > limit:
            if batch:
                yield joined(first, batch)
            batch, size, first = [], 0, i + 1
            whole = np.frombuffer(pad + body + bytes([END]), np.uint8)
            for at in range(0, len(body) + 1, limit):
                part = whole[at : at + limit + order - 1]
                yield packed(part, np.full(len(part), i))
            continue
        batch.append(body)
        size += len(body)
        if size >= limit:
            yield joined(first, batch)
            batch, size, first = [], 0, i + 1
    if batch:
        yield joined(first, batch)


def count_grams(df: DataFrame, text_col: str, lang_col: str, order: int) -> DataFrame:
    """(lang, gram, n) over all rows; each task sums its own before the shuffle."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            codes, u = pd.factorize(np.concatenate([k for k, _ in parts]))
            return u, np.bincount(codes, np.concatenate([n for _, n in parts]), len(u)).astype(np.int64)

        def out() -> Iterator[pd.DataFrame]:
            for lang, parts in held.items():
                k, n = summed(parts)
                for at in range(0, len(k), BATCH_ROWS):
                    part = k[at : at + BATCH_ROWS]
                    yield pd.DataFrame({"lang": pd.Series([lang] * len(part), dtype=object), "gram": part, "n": n[at : at + BATCH_ROWS]})

        for frame in frames:
            for lang, texts in frame["text"].groupby(frame["lang"], dropna=False):
                lang = None if pd.isna(lang) else lang
                parts = held.setdefault(lang, [])
                for keys, _ in grams([stream(x) for x in texts], order):
                    codes, u = pd.factorize(keys)
                    parts.append((u, np.bincount(codes, minlength=len(u))))
                    size += len(u)
            if size > HELD_GRAMS:
                held = {lang: [summed(parts)] for lang, parts in held.items()}
                size = sum(len(parts[0][0]) for parts in held.values())
            if size > HELD_GRAMS:
                yield from out()
                held, size = {}, 0
        yield from out()

    source = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    return common.map_slices(source, counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _named(lang: str = "lang") -> list[Column]:
    """A language as two columns without nulls, to join on."""
    return [F.coalesce(lang, F.lit("")).alias("l"), F.col(lang).isNull().alias("none")]


def levels(counts: DataFrame, order: int) -> DataFrame:
    """(k, l, none, gram, a): the counts of all orders from those of the highest, ``counts`` (lang, gram, n)."""
    table = counts.select(F.lit(order).alias("k"), *_named(), "gram", F.col("n").alias("a"))
    whole = table
    for k in range(order - 1, 0, -1):
        lower = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("gram")
        table = common.stored(table.groupBy(F.lit(k).alias("k"), "l", "none", lower).agg(F.count("*").alias("a")), "level")
        whole = whole.union(table)
    return whole


def entries(counts: DataFrame, order: int = ORDER, few: bool = False) -> DataFrame:
    """(lang, n, grams, values): the model, n grams a row, packed; values are -log2 of the probability in 1/UNIT bits.

    ``few``: there are at most FEW languages, so a row for each may be broadcast.
    """
    small = F.broadcast if few else lambda x: x
    table = levels(counts, order)
    # counts of counts: a few rows for each language
    of = table.groupBy("k", "l", "none").agg(*[F.count_if(F.col("a") == i).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    # the usual constants where a count of counts is missing
    sound = (F.least("n1", "n2", "n3", "n4") > 0) & (F.greatest(*[F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}")) * y * (i + 1) / i for i in (1, 2, 3)]) < 1)
    discounts = [F.when(sound, i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))).otherwise(0.5 * i).alias(f"d{i}") for i in (1, 2, 3)]
    of = of.select("k", "l", "none", *discounts)
    rows = table.withColumn("c", F.shiftright("gram", 8)).join(small(of), ["k", "l", "none"])
    own = F.when(F.col("a") == 1, F.col("d1")).when(F.col("a") == 2, F.col("d2")).otherwise(F.col("d3"))
    context = Window.partitionBy("k", "l", "none", "c")
    rows = rows.withColumns({"own": own, "all": F.sum("a").over(context)})
    rows = rows.select("k", "l", "none", "gram", ((F.col("a") - F.col("own")) / F.col("all")).alias("direct"), (F.sum("own").over(context) / F.col("all")).alias("left"))
    # at most 256 rows for each language
    bottom = rows.filter("k = 1").select("l", "none", F.col("gram").alias("last"), (F.col("direct") + F.col("left") / 256).alias("p"))
    rows = rows.filter("k > 1").withColumn("last", F.col("gram").bitwiseAND(F.lit(255))).join(small(bottom), ["l", "none", "last"])
    low = F.col("gram").bitwiseAND(F.lit(0xFFFF))
    rows = rows.select("k", "l", "none", "gram", "direct", "left", "p", F.xxhash64("l", "none", low).alias("g"))

    def solved(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in common.whole_groups(frames, "g", SOLVED_ROWS):
            for (lang, none), own in frame.groupby(["l", "none"]):
                above = None
                for k, level in own.groupby("k"):
                    gram = level["gram"].to_numpy()
                    below = level["p"].to_numpy() if above is None else above[1][np.searchsorted(above[0], gram & ((1 << 8 * (int(k) - 1)) - 1))]
                    p = level["direct"].to_numpy() + level["left"].to_numpy() * below
                    at = np.argsort(gram)
                    above = gram[at], p[at]
                values = np.rint(-np.log2(above[1]) * UNIT).astype(np.int32)
                yield pd.DataFrame({"lang": [None if none else lang], "n": [len(values)], "grams": [common.pack_keys(above[0])], "values": [common.pack(values)]})

    return rows.repartition("g").sortWithinPartitions("g", "k").mapInPandas(solved, "lang string, n long, grams binary, values binary")


def unpacked(model: DataFrame) -> DataFrame:
    """(lang, gram, value) of every entry."""

    def out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                yield pd.DataFrame({"gram": common.unpack_keys(row.grams), "value": common.unpack(row.values, "i4").astype(np.int64)}).assign(lang=row.lang)[["lang", "gram", "value"]]

    return model.select("lang", "grams", "values").mapInPandas(out, "lang string, gram long, value long")


def mix(keys: np.ndarray) -> np.ndarray:
    """A 64-bit hash of packed grams; a bijection."""
    z = keys.astype(np.uint64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def hash_arrays(packed: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and values of a language's entries."""
    hashes = mix(np.concatenate([common.unpack_keys(g) for g, _ in packed]))
    order = np.argsort(hashes)
    return hashes[order], np.concatenate([common.unpack(v, "i4") for _, v in packed])[order]


def judge(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    fence: float = FENCE,
    noise: float = NOISE,
    prior: float = PRIOR,
    broadcast_grams: int = BROADCAST_GRAMS,
    carry: tuple[str, ...] = ("*",),
    out: str = "quality",
) -> DataFrame:
    """The columns ``carry`` and a struct ``out``: base statistics, base_failed, bits per byte, band, kept.

    The scored rows go to the shared folder once, as the bands need all of them.
    """
    if not 2 <= order <= 7:
        raise ValueError("order must be from 2 to 7")
    spark = df.sparkSession
    counts = common.stored(count_grams(df, text_col, lang_col, order), "grams")
    few = counts.select("lang").distinct().limit(FEW + 1).count() <= FEW
    model = common.stored(entries(counts, order, few), "model")
    inner = f"struct<{', '.join(f'{x}: bigint' for x in BASE)}, base_failed: boolean, n_bytes: bigint, units: bigint>"
    row = df.select(F.struct(*carry).alias("row"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def described(texts: pd.Series) -> pd.DataFrame:
        got = pd.DataFrame([base_features(x) for x in texts], columns=list(BASE)).astype("int64")
        return got.assign(base_failed=(got["n_words"] < MIN_WORDS) | (100 * got["n_repeat_words"] > 100 * REPEATED * got["n_words"]))

    held = None
    if (model.agg(F.sum("n")).first()[0] or 0) <= broadcast_grams:
        packed: dict[str | None, list[tuple[bytes, bytes]]] = {}
        for lang, grams_, values in model.select("lang", "grams", "values").collect():  # checked to be few
            packed.setdefault(lang, []).append((bytes(grams_), bytes(values)))
        held = spark.sparkContext.broadcast(packed)
        del packed
        shared = held

        names = [*BASE, "base_failed", "n_bytes", "units"]

        @F.arrow_udf(inner)
        def measured(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            arrays: dict[str | None, tuple[np.ndarray, np.ndarray]] = {}

            def part(langs: pd.Series, texts: pd.Series) -> pa.Array:
                got = described(texts)
                units, size = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                numbers = pd.Series(np.arange(len(texts)))
                for lang, at in numbers.groupby(langs, dropna=False):
                    lang = None if pd.isna(lang) else lang
                    if lang not in arrays:
                        arrays[lang] = hash_arrays(shared.value[lang])
                    hashes, value = arrays[lang]
                    at = at.to_numpy()
                    bodies = [stream(texts.iloc[i]) for i in at]
                    size[at] = [len(x) + 1 for x in bodies]
                    for keys, owner in grams(bodies, order):
                        codes, u = pd.factorize(keys)
                        # whole numbers below 2**53: the sums are exact
                        units[at] += np.bincount(owner, value[np.searchsorted(hashes, mix(u))][codes], len(bodies)).astype(np.int64)
                got = got.assign(n_bytes=size, units=units)
                return pa.StructArray.from_arrays([pa.array(got[x]) for x in names], names)

            for langs, texts in batches:
                step = common.SLICE_ROWS
                parts = [part(langs.slice(i, step).to_pandas(), texts.slice(i, step).to_pandas()) for i in range(0, len(texts), step)]
                yield pa.concat_arrays(parts) if parts else pa.StructArray.from_arrays([pa.array([], pa.bool_() if x == "base_failed" else pa.int64()) for x in names], names)

        scored = row.select("row", "lang", measured("lang", "text").alias("m"))
    else:

        @F.pandas_udf(f"struct<{', '.join(f'{x}: bigint' for x in BASE)}, base_failed: boolean, n_bytes: bigint>")
        def plain(texts: pd.Series) -> pd.DataFrame:
            return described(texts).assign(n_bytes=[len(stream(x)) + 1 for x in texts])

        @F.pandas_udf("array<struct<gram: bigint, n: bigint>>")
        def distinct(texts: pd.Series) -> pd.Series:
            out = []
            for x in texts:
                total: Counter = Counter()
                for keys, _ in grams([stream(x)], order):
                    u, n = np.unique(keys, return_counts=True)
                    total.update(dict(zip(u.tolist(), n.tolist(), strict=True)))
                out.append([{"gram": k, "n": n} for k, n in total.items()])
            return pd.Series(out)

        # equal texts of a language share a score, so a row needs no number of its own
        keyed = row.select("row", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"), plain("text").alias("m"), "text")
        pairs = keyed.groupBy("lang", "sha").agg(F.first("text").alias("text")).select("lang", "sha", F.inline(distinct("text")))
        l, r = pairs.alias("l"), unpacked(model).alias("r")
        met = l.join(r, F.col("l.lang").eqNullSafe(F.col("r.lang")) & (F.col("l.gram") == F.col("r.gram")))
        sums = met.groupBy("l.lang", "l.sha").agg(F.sum(F.col("l.n") * F.col("r.value")).alias("units")).alias("s")
        scored = keyed.alias("k").join(sums, F.col("k.lang").eqNullSafe(F.col("s.lang")) & (F.col("k.sha") == F.col("s.sha")))
        scored = scored.select("k.row", "k.lang", F.struct("k.m.*", "s.units").alias("m"))
    scored = common.stored(scored.withColumn("rate", F.col("m.units") / UNIT / F.col("m.n_bytes")), "scored")
    if held is not None:
        held.destroy()
    bands_ = bands(scored.filter("not m.base_failed").select("lang", "rate"), fence, prior)
    bands_ = bands_.select(*_named(), "lower", "upper")
    margin = noise / F.sqrt("m.n_bytes")
    judged = scored.select("*", *_named())
    judged = judged.join(F.broadcast(bands_) if few else bands_, ["l", "none"], "left")
    judged = judged.withColumns({"lower": F.col("lower") - margin, "upper": F.col("upper") + margin})
    inside = F.col("rate").between(F.coalesce("lower", F.lit(-math.inf)), F.coalesce("upper", F.lit(math.inf)))
    quality = F.struct("m.*", F.col("rate").alias("bits_per_byte"), F.pow(F.lit(2.0), "rate").alias("perplexity"), "lower", "upper", (~F.col("m.base_failed") & inside).alias("kept"))
    return judged.select("row.*", quality.alias(out))


def bands(rates: DataFrame, fence: float = FENCE, prior: float = PRIOR, grid: int = GRID) -> DataFrame:
    """(lang, lower, upper) in bits per byte from (lang, rate); quartiles on a grid, shrunk towards those of all rows."""
    cells = rates.groupBy("lang", F.floor(F.col("rate") * grid).alias("cell")).agg(F.count("*").alias("n"))
    both = F.explode(F.array(F.lit(False), F.lit(True))).alias("every")
    counted = cells.select(both, "lang", "cell", "n").groupBy("every", F.when(~F.col("every"), F.col("lang")).alias("lang"), "cell").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("every", "lang").orderBy("cell")  # a rate is below 64 bits: at most 64 * grid cells
    run = counted.withColumns({"upto": F.sum("n").over(order), "total": F.sum("n").over(Window.partitionBy("every", "lang"))})

    def quartile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.col("cell"))) / grid

    found = run.groupBy("every", "lang").agg(F.max("total").alias("n"), quartile(0.25).alias("low"), quartile(0.75).alias("high"))
    whole = found.filter("every").select(F.col("low").alias("low_"), F.col("high").alias("high_"))  # one row
    own = F.col("n") / (F.col("n") + prior)
    low, high = (own * F.col(x) + (1 - own) * F.col(f"{x}_") for x in ("low", "high"))
    spread = fence * F.greatest(high - low, F.lit(1 / grid))
    return found.filter("not every").crossJoin(F.broadcast(whole)).select("lang", (low - spread).alias("lower"), (high + spread).alias("upper"))


def filtered(df: DataFrame, text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The rows that pass, with their own columns."""
    packed = df.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return judge(packed, carry=("row",), **options).filter("quality.kept").select("row.*")


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, bits_per_byte, lower, upper)."""
    judged = judge(df, text_col, lang_col, carry=(id_col,), out="_quality", **options)
    return judged.select(id_col, *[f"_quality.{x}" for x in (*BASE, "base_failed", "kept", "bits_per_byte", "lower", "upper")])
