"""Source divergence: how far the word use of a language's sources lies apart, from mergeable radix tries.

A task counts the terms of its documents in byte tries, one for each language, whose leaves
hold the number of documents and a counter for each source. A trie is kept as its walk in
byte order: for each leaf, how deep it leaves the branch of the leaf before it, the label
below that place, and the leaf's counters. Tries are cut by ranges of prefixes; ranges with
the same prefix meet, are merged, and lose the leaves that too few documents have. A second
walk over the merged ranges, given each group's totals, adds up pairs of sources and keeps
each group's best candidates; as the walk is in UTF-8 order, ties need no further order.

A hot source or a frequent term is one leaf of a task's trie, so what is shuffled grows with
the number of distinct terms, not with their occurrences.

Cases: null text, language and source are read as the empty string; a language without kept
terms has sums of zero; terms of any length are whole; repeated rows are documents of their
own; ties go by the item's UTF-8 bytes; ids don't matter; an empty table gives an empty
result; further columns don't matter, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm import common

#: A term is kept from this number of its language's documents on; shares are counted in units of 1 / UNIT.
LEAST, UNIT = 3, 1_000_000_000
#: Ranks of a group's terms that are returned.
RANKS = 200
#: Bytes of the prefixes by which tries are cut.
PREFIX = 3
#: A task's trie is cut and passed on when it has so many leaves, or bytes of terms.
LEAVES, LABELS = 400_000, 32_000_000
#: Parts in which a group's candidates are first cut down to its ranks.
PARTS = 32
#: Terms of a range that are compared at once, and leaves that wait for a merge.
BLOCK, WAITING = 4096, 1_000_000

#: Letters of ASCII in lower case and bytes beyond ASCII; everything else is between terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


class Trie:
    """Leaves in byte order, with their documents and counters (source, count), which ``first`` delimits."""

    def __init__(self, terms: list[bytes], docs: np.ndarray, first: np.ndarray, source: np.ndarray, count: np.ndarray, depths: np.ndarray | None = None):
        self.terms, self.docs, self.first, self.source, self.count = terms, docs, first, source, count
        self.depths = _depths(terms) if depths is None else depths

    def cut(self, width: int = PREFIX) -> Iterator[tuple[bytes, Trie]]:
        """Its subtries by prefix."""
        # a leaf begins a range if it leaves the one before above the cut
        lengths = np.fromiter(map(len, self.terms), np.int64, len(self.terms))
        starts = np.flatnonzero(self.depths < np.minimum(lengths, width)).tolist()
        for at, end in zip(starts, [*starts[1:], len(self.terms)], strict=False):
            a, b = self.first[at], self.first[end]
            depths = self.depths[at:end].copy()
            depths[0] = 0
            yield self.terms[at][:width], Trie(self.terms[at:end], self.docs[at:end], self.first[at : end + 1] - a, self.source[a:b], self.count[a:b], depths)

    def only(self, which: np.ndarray) -> Trie:
        """Without the other leaves."""
        widths = np.diff(self.first)
        inside = np.repeat(which, widths)
        first = np.concatenate([[0], np.cumsum(widths[which])])
        return Trie([t for t, w in zip(self.terms, which.tolist(), strict=True) if w], self.docs[which], first, self.source[inside], self.count[inside])

    def pack(self) -> bytes:
        """The walk: depths, labels and counters as one compressed block."""
        labels = [term[depth:] for term, depth in zip(self.terms, self.depths.tolist(), strict=True)]
        arrays = [self.depths.astype("<i4"), np.array([len(x) for x in labels], "<i4"), np.diff(self.first).astype("<i4"), self.source.astype("<i4"), self.docs.astype("<i8"), self.count.astype("<i8")]
        head = np.array([len(self.terms), len(self.count)], "<i8")
        return zstandard.ZstdCompressor(level=1).compress(b"".join([head.tobytes(), *(x.tobytes() for x in arrays), *labels]))

    @classmethod
    def unpack(cls, data: bytes) -> Trie:
        raw = zstandard.ZstdDecompressor().decompress(data)
        n, m = np.frombuffer(raw, "<i8", 2).tolist()
        at, arrays = 16, []
        for size, kind in ((n, "<i4"), (n, "<i4"), (n, "<i4"), (m, "<i4"), (n, "<i8"), (m, "<i8")):
            arrays.append(np.frombuffer(raw, kind, size, at))
            at += arrays[-1].nbytes
        depths, lengths, widths, source, docs, count = arrays
        terms, before = [], b""
        for depth, length in zip(depths.tolist(), lengths.tolist(), strict=True):
            before = before[:depth] + raw[at : at + length]
            terms.append(before)
            at += length
        return cls(terms, docs, np.concatenate([[0], np.cumsum(widths, dtype=np.int64)]), source.astype(np.int64), count, depths.astype(np.int64))


#: Bytes of terms that are compared side by side; what goes on beyond is compared one by one.
_SIDE = 24


def _depths(terms: list[bytes]) -> np.ndarray:
    """For each of ordered terms, how many bytes it shares with the one before."""
    out = np.zeros(len(terms), np.int64)
    if len(terms) > 1:
        side = np.array([t[:_SIDE] for t in terms], f"S{_SIDE}").view(np.uint8).reshape(len(terms), _SIDE)
        apart = (side[1:] != side[:-1]) | (side[1:] == 0)  # a term has no zero bytes
        out[1:] = np.where(apart.any(axis=1), apart.argmax(axis=1), _SIDE)
        for i in np.flatnonzero(out == _SIDE).tolist():
            out[i] = _shared(terms[i - 1], terms[i])
    return out


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is shared, a[:high] isn't
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def merge(tries: Iterable[tuple[Trie, np.ndarray]], sources: int) -> Trie:
    """One trie with the leaves of all; each comes with the numbers that its sources have now.

    The walks are sorted runs, which the sort takes as such; equal leaves then follow each other.
    """
    tries = list(tries)
    terms = [t for trie, _ in tries for t in trie.terms]
    order = np.array(sorted(range(len(terms)), key=terms.__getitem__), np.int64)
    ordered = [terms[i] for i in order.tolist()]
    new = np.array([True] * bool(ordered) + [a != b for a, b in zip(ordered, ordered[1:], strict=False)], bool)
    leaf = np.empty(len(terms), np.int64)
    leaf[order] = np.cumsum(new) - 1
    docs = np.zeros(int(new.sum()), np.int64)
    np.add.at(docs, leaf, np.concatenate([t.docs for t, _ in tries] or [docs]))
    widths = np.concatenate([np.diff(t.first) for t, _ in tries] or [docs])
    source = np.concatenate([names[t.source] for t, names in tries] or [docs])
    count = np.concatenate([t.count for t, _ in tries] or [docs])
    return _leaves([t for t, n in zip(ordered, new.tolist(), strict=True) if n], docs, np.repeat(leaf, widths) * sources + source, count, sources)


def _leaves(terms: list[bytes], docs: np.ndarray, keys: np.ndarray, count: np.ndarray, sources: int) -> Trie:
    """A trie of ordered terms, from counters with keys leaf * sources + source."""
    keys, at = np.unique(keys, return_inverse=True)
    summed = np.zeros(len(keys), np.int64)
    np.add.at(summed, at, count)
    first = np.searchsorted(keys, np.arange(len(terms) + 1) * sources)
    return Trie(terms, docs, first, keys % max(sources, 1), summed)


class _Numbers(dict):
    """Numbers what is looked up, from 0."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


class Growing:
    """A language's trie while a task counts: leaves are found by their whole term, and ordered when it is done."""

    def __init__(self):
        self.leaf, self.sources = _Numbers(), _Numbers()
        self.held: list[tuple[np.ndarray, np.ndarray]] = []  # leaves, and the length of each document
        self.of: list[int] = []
        self.size = 0
        self.docs: dict[str, np.ndarray] = {}
        self.keys, self.counts, self.found = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, source: str, terms: list[bytes]) -> None:
        self.held.append(np.fromiter(map(self.leaf.__getitem__, terms), np.int64, len(terms)))
        self.of.append(self.sources[source])
        self.size += len(terms)
        if self.size >= 1 << 20 or len(self.of) >= 1 << 15:
            self.settle()

    def settle(self) -> None:
        """Adds what is held to the leaves' counters. Key: leaf * 2**31 + source; sources of a task are fewer."""
        if not self.of:
            return
        leaves = np.concatenate(self.held)
        row = np.repeat(np.arange(len(self.held)), [len(x) for x in self.held])
        once = np.unique((row << 32) | leaves) & 0xFFFFFFFF
        found = np.bincount(once, minlength=len(self.leaf))
        found[: len(self.found)] += self.found
        self.found = found
        keys, counts = np.unique((leaves << 31) | np.array(self.of, np.int64)[row], return_counts=True)
        keys, at = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        summed = np.zeros(len(keys), np.int64)
        np.add.at(summed, at, np.concatenate([self.counts, counts]))
        self.keys, self.counts = keys, summed
        self.held, self.of, self.size = [], [], 0

    def trie(self) -> tuple[Trie, list[str]]:
        self.settle()
        terms = list(self.leaf)
        order = sorted(range(len(terms)), key=terms.__getitem__)
        to = np.empty(len(terms), np.int64)
        to[order] = np.arange(len(terms))
        n = max(len(self.sources), 1)
        keys = to[self.keys >> 31] * n + (self.keys & ((1 << 31) - 1))
        return _leaves([terms[i] for i in order], self.found[order], keys, self.counts, n), list(self.sources)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to packed ranges of tries: (lang, prefix, sources, data)."""
    growing: dict[str, Growing] = defaultdict(Growing)
    bytes_held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, one in growing.items():
            trie, sources = one.trie()
            rows = [(lang, prefix, sources, part.pack()) for prefix, part in trie.cut()]
            for at in range(0, len(rows), 1000):
                yield _batch(rows[at : at + 1000], (("lang", pa.string()), ("prefix", pa.binary()), ("sources", pa.list_(pa.string())), ("data", pa.binary())))
        growing.clear()

    for batch in batches:
        texts, langs, sources = batch.column("text"), batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for i, (lang, source) in enumerate(zip(langs, sources, strict=True)):
            data = texts[i].as_py()
            growing[lang].add(source, data.translate(_FOLD).split())
            bytes_held += len(data)
            if bytes_held >= LABELS:
                # terms are at most the bytes read since the last look
                bytes_held = sum(sum(map(len, one.leaf)) for one in growing.values())
                if bytes_held >= LABELS or sum(len(one.leaf) for one in growing.values()) >= LEAVES:
                    yield from flush()
                    bytes_held = 0
    yield from flush()


def _batch(rows: list[tuple], kinds: tuple[tuple[str, pa.DataType], ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])


def _merge(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Ordered ranges of tries to merged ones: (lang, kept, sources, sums, data); one range at a time."""
    kinds = (("lang", pa.string()), ("kept", pa.int64()), ("sources", pa.list_(pa.string())), ("sums", pa.list_(pa.int64())), ("data", pa.binary()))
    at: tuple | None = None
    numbers, waiting, size = _Numbers(), [], 0

    def done() -> Iterator[pa.RecordBatch]:
        trie = merge(waiting, len(numbers))
        trie = trie.only(trie.docs >= least)
        if trie.terms:
            sums = np.zeros(len(numbers), np.int64)
            np.add.at(sums, trie.source, trie.count)
            yield _batch([(at[0], len(trie.terms), list(numbers), sums.tolist(), trie.pack())], kinds)

    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in ("lang", "prefix", "sources", "data")}
            if at != (row["lang"], row["prefix"]):
                if waiting:
                    yield from done()
                at, numbers, waiting, size = (row["lang"], row["prefix"]), _Numbers(), [], 0
            trie = Trie.unpack(row["data"])
            waiting.append((trie, np.array([numbers[s] for s in row["sources"]], np.int64)))
            size += len(trie.terms)
            if size >= WAITING:
                waiting = [(merge(waiting, len(numbers)), np.arange(len(numbers)))]
                size = 0
    if waiting:
        yield from done()


def shares(count: np.ndarray, total: np.ndarray, unit: int = UNIT) -> np.ndarray:
    """1 + floor(unit * (count + 1) / total), exact while 1000 * total fits a long. ``unit`` is a power of 1000."""
    rest, whole = count + 1, np.zeros(np.broadcast_shapes(count.shape, total.shape), np.int64)
    while unit > 1:
        rest = rest * 1000
        whole = whole * 1000 + rest // total
        rest = rest % total
        unit //= 1000
    return whole + 1


def _walk(batches: Iterator[pa.RecordBatch], ranks: int) -> Iterator[pa.RecordBatch]:
    """Merged ranges, each with its language's groups, to sums of pairs and to each group's best candidates."""
    kinds = (("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64()))
    pairs: dict[str, tuple[list[str], np.ndarray]] = {}
    best: dict[tuple[str, str], list[tuple[int, bytes]]] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            lang, names, sums, kept = (batch.column(c)[i].as_py() for c in ("lang", "names", "sums_all", "kept_all"))
            trie = Trie.unpack(batch.column("data")[i].as_py())
            place = {name: k for k, name in enumerate(names)}
            to = np.array([place[s] for s in batch.column("sources")[i].as_py()], np.int64)
            total = np.array(sums, np.int64) + kept
            add = pairs.setdefault(lang, (names, np.zeros((len(names), len(names)), np.int64)))[1]
            for start in range(0, len(trie.terms), BLOCK):
                stop = min(start + BLOCK, len(trie.terms))
                a, b = trie.first[start], trie.first[stop]
                count = np.zeros((stop - start, len(names)), np.int64)
                count[np.repeat(np.arange(stop - start), np.diff(trie.first[start : stop + 1])), to[trie.source[a:b]]] = trie.count[a:b]
                p = shares(count, total)
                q = shares(count.sum(1), np.int64(sum(sums) + kept))
                for k, name in enumerate(names):
                    apart = p[:, k : k + 1] - p
                    add[k] += (apart * apart // p).sum(0)
                    over = np.flatnonzero((count[:, k] > 0) & (p[:, k] > q))
                    value = (p[over, k] - q[over]) ** 2 // q[over]
                    mine = best.setdefault((lang, name), [])
                    floor = -mine[-1][0] if len(mine) == ranks else -1
                    some = value >= floor
                    mine += [(-v, trie.terms[start + t]) for v, t in zip(value[some].tolist(), over[some].tolist(), strict=True)]
                    mine.sort()
                    del mine[ranks:]
    rows = [(lang, a, "pair", b, int(total[i, j])) for lang, (names, total) in pairs.items() for i, a in enumerate(names) for j, b in enumerate(names) if i != j]
    rows += [(lang, source, "term", term.decode(), -v) for (lang, source), mine in best.items() for v, term in mine]
    for at in range(0, len(rows), 10_000):
        yield _batch(rows[at : at + 10_000], kinds)


def audit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST, ranks: int = RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank): each group's distance to every other source of its language, and the terms it has more of."""
    source = df.select(*[common.text_or_empty(f"`{c}`").alias(name) for c, name in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    groups = common.stored(source.select("lang", "source").distinct(), "groups")
    ranges = source.withColumn("text", F.col("text").cast("binary")).mapInArrow(_count, "lang string, prefix binary, sources array<string>, data binary")
    tries = ranges.repartitionByRange("lang", "prefix").sortWithinPartitions("lang", "prefix")
    merged = common.stored(tries.mapInArrow(lambda b: _merge(b, least), "lang string, kept long, sources array<string>, sums array<bigint>, data binary"), "tries")
    kept = merged.groupBy("lang").agg(F.sum("kept").alias("kept"))
    sums = merged.select("lang", F.explode(F.arrays_zip("sources", "sums")).alias("s")).groupBy("lang", F.col("s.sources").alias("source")).agg(F.sum("s.sums").alias("n"))
    # a language's groups in one order, with their totals; a row for each language
    totals = groups.join(sums, ["lang", "source"], "left").groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", F.coalesce("n", F.lit(0)).alias("n")))).alias("g"))
    totals = common.stored(totals.join(kept, "lang", "left").select("lang", F.col("g.source").alias("names"), F.col("g.n").alias("sums_all"), F.coalesce("kept", F.lit(0)).alias("kept_all")), "totals")
    found = merged.select("lang", "sources", "data").join(totals, "lang").mapInArrow(lambda b: _walk(b, ranks), "lang string, source string, part string, item string, value long")
    names = totals.select("lang", "names", F.explode("names").alias("source"))
    every = names.select("lang", "source", F.lit("pair").alias("part"), F.explode("names").alias("item"), F.lit(0).cast("long").alias("value")).where("source <> item")
    pairs = found.where("part = 'pair'").unionByName(every).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = F.desc("value"), "item"
    # each task gave a group's best: parts of a group are cut first, so that its last window has at most PARTS * ranks rows
    dealt = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(PARTS))).orderBy(*best)
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(dealt)).where(F.col("rank") <= ranks).drop("rank")
    order = Window.partitionBy("lang", "source").orderBy(*best)
    rank = F.row_number().over(order).cast("int")
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= ranks))


def oracle(least: int = LEAST, ranks: int = RANKS) -> str:
    """The audit of ``documents`` in SQL."""
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
groups AS (SELECT DISTINCT lang, source FROM docs),
words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= {least}),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT g.lang, g.source, coalesce(sum(c), 0) + coalesce(any_value(v), 0) AS n FROM groups g LEFT JOIN counts USING (lang, source) LEFT JOIN size ON size.lang = g.lang GROUP BY g.lang, g.source),
cells AS (
  SELECT t.lang, t.source, k.term, coalesce(c, 0) AS c, 1 + ({UNIT}::HUGEINT * (coalesce(c, 0) + 1)) // n::HUGEINT AS p
  FROM totals t JOIN kept k ON k.lang = t.lang LEFT JOIN counts x ON x.lang = t.lang AND x.source = t.source AND x.term = k.term
),
whole AS (SELECT lang, sum(c) AS n FROM counts GROUP BY lang),
lang_cells AS (
  SELECT lang, term, 1 + ({UNIT}::HUGEINT * (sum(c)::HUGEINT + 1)) // (any_value(n) + any_value(v))::HUGEINT AS q FROM counts JOIN whole USING (lang) JOIN size USING (lang) GROUP BY lang, term
),
found AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN found f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM cells JOIN lang_cells USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {ranks}
"""
