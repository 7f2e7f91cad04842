"""Context-tree weighting over bytes: code lengths of texts under a model of a corpus.

Each byte is coded as eight binary decisions (the path to it in a binary tree of 255
nodes). Every decision has a context tree over the preceding bytes; a context's
estimate is Krichevsky and Trofimov's, (n_bit + 1/2) / (n + 1), and the weighted
probability of its training data is

    Pw(s) = 1/2 KT(s) + 1/2 product of Pw over s extended by one more byte,

down to ``DEPTH`` bytes, where Pw = KT. Once the counts are known, the probability of
a decision mixes the estimates of all depths, from the longest context up to the empty
one, with the weight 1/2 KT(s) / Pw(s) at each. A context without training data has no
node: its parent's estimate stands in for it. Texts are lower-cased (A-Z), end with
byte 255 and start behind bytes 255 (UTF-8 has no such byte), so the probabilities of
all texts sum to one.

How it runs. The scan cuts the corpus into blocks of bounded size. A block deals its
distinct byte (DEPTH+1)-grams and words, with their training counts, over ``parts`` and
gives one row of packed arrays for each; its texts stay beside them, compressed. Blocks
belong to ``salts``, so that a cell (salt, part) has a bounded share of them, however
large the corpus: a cell sums its blocks' counts, and Spark sums the cells'. Grams
meet by their last three context bytes: such a group has at most 256**(DEPTH-2) rows,
holds whole subtrees, and is solved with arrays. The three top levels are 255 trees, one
for each node of the binary tree, of at most 65,536 contexts: one group each. Their
weights come back to the groups below, which then give each gram's code length. Code
lengths and word counts go to the cells, those give packed arrays to each block, and
the block scores its texts. Nothing passes through the driver but a few sums.

Cases: a null text is an empty one (one token, the end); a null id counts as training
data; repeated rows count each time; without training data every estimate is 1/2 and
the base is that of empty counts; other columns are ignored.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm import common
from tracelake.llm.common import pack, pack_keys, unpack, unpack_keys, whole_groups

#: Context bytes. A gram has one more byte and must fit in 63 bits.
DEPTH = 5
#: Levels above the subtrees: contexts of fewer bytes.
TOP = 3
END = 255
#: Bytes of text in a block, and in the arrays that are made at once.
BLOCK_BYTES = 12 << 20
CHUNK_BYTES = 1 << 20
#: Bytes of text whose grams and words a cell has, and parts at most; beyond, there are more salts.
CELL_BYTES = 8 << 20
MAX_PARTS = 4096
#: Grams of chunks that a block holds before it sums them; rows that a group's task solves at once.
HELD_GRAMS = 500_000
SOLVED_ROWS = 200_000

_RAW = pa.schema([("block", pa.int64()), ("salt", pa.int32()), ("part", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary()), ("words", pa.binary()), ("texts", pa.binary())])


def dealt(values: np.ndarray, over: int) -> np.ndarray:
    """Integers dealt evenly over ``over`` numbers."""
    return ((values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % over


def dealt_words(words: pa.Array, over: int) -> np.ndarray:
    if over == 1:
        return np.zeros(len(words), np.int64)
    items = np.empty(len(words), object)
    items[:] = words.to_pylist()
    return (pd.util.hash_array(items, categorize=False) % np.uint64(over)).astype(np.int64)


def by_part(part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions of each part in turn, in their order, and where each part begins."""
    return np.argsort(part, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])


def grams(texts: list[bytes], depth: int = DEPTH, limit: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams of every position, end marks included, and the number of the text that each belongs to.

    A gram is c1 c2 .. cD symbol from the highest byte down, c1 the byte just before.
    """

    def coded(joined: bytes, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(joined, np.uint8)
        n = len(data) - depth
        out = np.zeros(n, np.int64)
        for back in range(1, depth + 1):
            out |= data[depth - back : depth - back + n].astype(np.int64) << (8 * (depth + 1 - back))
        out |= data[depth:]
        keep = owner >= 0
        return out[keep], owner[keep]

    gap = bytes([END]) * depth
    batch: list[bytes] = []
    first = size = 0

    def joined(start: int, items: list[bytes]):
        # after each text, its end mark and then a gap that belongs to none
        owner = np.full(sum(map(len, items)) + depth * len(items), -1, np.int64)
        at = 0
        for i, x in enumerate(items):
            owner[at : at + len(x) + 1] = start + i
            at += len(x) + depth
        return coded(gap + gap.join(items) + gap, owner)

    for i, text in enumerate(texts):
        if len(text) > limit:
            if batch:
                yield joined(first, batch)
            batch, size, first = [], 0, i + 1
            whole = gap + text + bytes([END])
            for at in range(0, len(text) + 1, limit):
                part = whole[at : at + limit + depth]
                yield coded(part, np.full(len(part) - depth, i, np.int64))
            continue
        batch.append(text)
        size += len(text)
        if size >= limit:
            yield joined(first, batch)
            batch, size, first = [], 0, i + 1
    if batch:
        yield joined(first, batch)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, u = pd.factorize(keys, sort=True)
    return u, np.bincount(codes, counts, len(u)).astype(np.int64)


def _merged(some: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return _summed(np.concatenate([x for x, _ in some]), np.concatenate([x for _, x in some]))


def lowered(rows: pa.Table) -> pa.Array:
    """The texts of a block, A-Z as a-z."""
    text = pc.ascii_lower(pc.fill_null(rows.column("text"), ""))
    return text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text


def cuts(text: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as bytes, about ``limit`` at a time, with the number of the first."""
    ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(text):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield at, text.slice(at, stop - at).cast(pa.binary()).to_pylist()
        at = stop


def tokens(text: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words in order of first sight and, last, the end token (no word); each token's number in them, and its text's."""
    split = pc.ascii_split_whitespace(text)
    owner, flat = pc.list_parent_indices(split).to_numpy().astype(np.int32), split.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(real).dictionary_encode()
    del split, flat
    words = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([b""], pa.binary())])
    number = np.concatenate([coded.indices.to_numpy(), np.full(len(text), len(words) - 1, np.int32)])
    return words, number, np.concatenate([owner[real.to_numpy(zero_copy_only=False)], np.arange(len(text), dtype=np.int32)])


class _Block:
    """Texts until there are enough; then their grams and words, packed by part, and their rows."""

    def __init__(self, key: int, depth: int, salts: int, parts: int):
        self.key, self.depth, self.salts, self.parts, self.size = key, depth, salts, parts, 0
        self.rows: list[pa.RecordBatch] = []

    def add(self, rows: pa.RecordBatch) -> None:
        self.rows.append(rows)
        self.size += rows.column("text").nbytes

    def batches(self) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(self.rows).combine_chunks()
        self.rows = []
        text = lowered(rows)
        train = ~rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        some, size = [(np.empty(0, np.int64), np.empty(0, np.int64))], 0
        for first, texts in cuts(text):
            for keys, owner in grams(texts, self.depth):
                codes, u = pd.factorize(keys)
                some.append((u, np.bincount(codes, train[first + owner], len(u)).astype(np.int64)))
                size += len(u)
                if size > HELD_GRAMS + 2 * len(some[0][0]):
                    some, size = [_merged(some)], 0
        k, n = _merged(some)
        del some
        order, at = by_part(dealt(k >> _shift(self.depth), self.parts), self.parts)
        k, n = k[order], n[order]
        packed = [(pack_keys(k[i:j]), pack(n[i:j])) for i, j in zip(at[:-1], at[1:], strict=True)]
        del k, n, order
        words, number, owner = tokens(text)
        seen = np.bincount(number, train[owner], len(words)).astype(np.int64)
        del number, owner, text
        order, at = by_part(dealt_words(words, self.parts), self.parts)
        table = pa.table({"w": words.take(pa.array(order)), "n": seen[order]})
        del words, seen
        salt = int(dealt(np.array([self.key]), self.salts)[0])
        for part, (keys, counts) in enumerate(packed):
            own = ipc(table.slice(at[part], at[part + 1] - at[part]).combine_chunks())
            texts = ipc(rows) if not part else None
            yield pa.RecordBatch.from_pylist([{"block": self.key, "salt": salt, "part": part, "grams": keys, "counts": counts, "words": own, "texts": texts}], schema=_RAW)


def ipc(table: pa.Table) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue()


def _shift(depth: int) -> int:
    """Bits of a gram below the context bytes that its group shares."""
    return 8 * (depth + 1 - TOP)


def blocks(df: DataFrame, id_col: str, text_col: str, held_out: Column, depth: int, block_bytes: int, cell_bytes: int, max_parts: int) -> tuple[DataFrame, int, int]:
    """A row for each block and part, in the shared folder; the numbers of salts and parts."""
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(max_parts, max(1, math.ceil(total / cell_bytes)))
    salts = max(1, math.ceil(total / (cell_bytes * max_parts)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        block = _Block(task << 24, depth, salts, parts)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                block.add(batch.slice(at, 1000))
                if block.size >= block_bytes:
                    yield from block.batches()
                    made += 1
                    block = _Block(task << 24 | made, depth, salts, parts)
        if block.rows:
            yield from block.batches()

    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(total / block_bytes))
    schema = "block long, salt int, part int, grams binary, counts binary, words binary, texts binary"
    return common.stored(source.coalesce(tasks).mapInArrow(cut, schema), "blocks"), salts, parts


_SMALL = 4096
_LOG_GAMMA_HALF = np.array([math.lgamma(i + 0.5) for i in range(_SMALL)])
_LOG_GAMMA_ONE = np.array([math.lgamma(i + 1.0) for i in range(_SMALL)])


def _log_gamma(n: np.ndarray, table: np.ndarray, shift: float) -> np.ndarray:
    """log gamma(n + shift) for counts: from the table, or Stirling's series where that is exact enough."""
    z = np.maximum(n, _SMALL) + shift
    series = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3)
    return np.where(n < _SMALL, table[np.minimum(n, _SMALL - 1).astype(np.int64)], series)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the KT probability of any order of n0 zeros and n1 ones."""
    return _log_gamma(n0, _LOG_GAMMA_HALF, 0.5) + _log_gamma(n1, _LOG_GAMMA_HALF, 0.5) - _log_gamma(n0 + n1, _LOG_GAMMA_ONE, 1.0) - math.log(math.pi)


class _Level:
    """All contexts of one length: ``keys`` are context << 8 | symbol, sorted and distinct."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        self.node, self.start, self.n0, self.n1 = [], [], [], []
        for j in range(8):
            prefix = keys >> (8 - j)
            new = np.concatenate([[True], prefix[1:] != prefix[:-1]]) if len(keys) else np.empty(0, bool)
            node = np.cumsum(new) - 1
            bit = (keys >> (7 - j)) & 1
            ones = np.bincount(node, counts * bit, new.sum())
            self.node.append(node)
            self.start.append(np.flatnonzero(new))
            self.n1.append(ones)
            self.n0.append(np.bincount(node, counts, new.sum()) - ones)


def subtrees(keys: np.ndarray, counts: np.ndarray, depth: int = DEPTH, top: int = TOP) -> tuple[np.ndarray, pd.DataFrame]:
    """Solve whole subtrees below depth ``top``.

    ``keys``: sorted distinct grams. Returns each gram's probabilities of its eight
    decisions as mixed at depth ``top`` (-1 where that context has no data), and the
    sums that the level above needs: (node: context of top-1 bytes << 8 | prefix, n0, n1, log_pw).
    """
    levels, up = [_Level(keys, counts.astype(np.float64))], []
    for _ in range(depth - top):
        below = levels[-1]
        u, inv = np.unique((below.keys >> 16 << 8) | (below.keys & 255), return_inverse=True)
        levels.append(_Level(u, np.bincount(inv, below.counts, len(u))))
        up.append(inv)
    p = np.empty((len(keys), 8), np.float64)
    sums = []
    for j in range(8):
        bit = (keys >> (7 - j)) & 1
        log_pw = mixed = seen = None
        at = np.arange(len(keys))
        for d, level in enumerate(levels):
            kt_log = log_kt(level.n0[j], level.n1[j])
            n = level.n0[j] + level.n1[j]
            node = level.node[j]
            if d:
                at = up[d - 1][at]
                parent = node[up[d - 1][levels[d - 1].start[j]]]
                split = np.bincount(parent, log_pw, len(kt_log))
            here = node[at]
            kt = (np.where(bit == 1, level.n1[j][here], level.n0[j][here]) + 0.5) / (n[here] + 1)
            if d:
                both = np.logaddexp(kt_log, split) - math.log(2)
                leaf = np.exp(kt_log - math.log(2) - both)[here]
                mixed = leaf * kt + (1 - leaf) * np.where(seen, mixed, kt)
                log_pw = both
            else:
                mixed, log_pw = kt, kt_log
            seen = n[here] > 0
        p[:, j] = np.where(seen, mixed, -1.0)
        last = levels[-1]
        first = last.keys[last.start[j]]
        above = (first >> 16 << 8) | (1 << j) | ((first & 255) >> (8 - j))
        sums.append(pd.DataFrame({"node": above, "n0": last.n0[j], "n1": last.n1[j], "log_pw": log_pw}))
    return p, pd.concat(sums).groupby("node", as_index=False).sum()


def top_levels(nodes: pd.DataFrame, top: int = TOP) -> tuple[np.ndarray, ...]:
    """Solve the upper levels. For every node of depth top-1, in order: the probability of a one is a + b * (that of the level below), and its own estimate."""
    nodes = nodes.sort_values("node", ignore_index=True)
    levels, parents = [nodes], []
    split = nodes["log_pw"].to_numpy()
    weights = []
    for d in range(top - 1, -1, -1):
        now = levels[-1]
        n0, n1 = now["n0"].to_numpy(), now["n1"].to_numpy()
        kt_log = log_kt(n0, n1)
        both = np.logaddexp(kt_log, split) - math.log(2)
        weights.append((np.exp(kt_log - math.log(2) - both), (n1 + 0.5) / (n0 + n1 + 1), n0 + n1 > 0))
        if d:
            key = (now["node"].to_numpy() >> 16 << 8) | (now["node"].to_numpy() & 255)
            u, inv = np.unique(key, return_inverse=True)
            parents.append(inv)
            split = np.bincount(inv, both, len(u))
            levels.append(pd.DataFrame({"node": u, "n0": np.bincount(inv, n0, len(u)), "n1": np.bincount(inv, n1, len(u))}))
    a, b = np.zeros(len(nodes)), np.ones(len(nodes))
    at, seen = np.arange(len(nodes)), np.ones(len(nodes), bool)
    for d, (leaf, kt, some) in enumerate(weights):
        if d:
            at = parents[d - 1][at]
        w, own = leaf[at], kt[at]
        a = np.where(seen, w * own + (1 - w) * a, own)
        b = np.where(seen, (1 - w) * b, 0.0)
        seen = some[at]
    return nodes["node"].to_numpy(), a, b, weights[0][1]


def code_lengths(keys: np.ndarray, p: np.ndarray, model: tuple[np.ndarray, ...], depth: int = DEPTH, top: int = TOP) -> np.ndarray:
    """log10 of each gram's symbol probability."""
    node, a, b, own = model
    total = np.zeros(len(keys))
    for j in range(8):
        sym = keys & 255
        above = (keys >> (8 * (depth + 2 - top)) << 8) | (1 << j) | (sym >> (8 - j))
        i = np.searchsorted(node, above)
        bit = (sym >> (7 - j)) & 1
        low = np.where(p[:, j] < 0, np.where(bit == 1, own[i], 1 - own[i]), p[:, j])
        total += np.log10(np.where(bit == 1, a[i], 1 - a[i] - b[i]) + b[i] * low)
    return total


def counted_grams(raw: DataFrame, depth: int) -> DataFrame:
    """(g, k, n): every distinct gram, its group and its training count."""

    def summed(rows: pa.Table) -> pa.Table:
        k, n = _merged([(unpack_keys(a), unpack(b, "i8")) for a, b in zip(rows.column("grams").to_pylist(), rows.column("counts").to_pylist(), strict=True)])
        return pa.table({"k": k, "n": n})

    cells = raw.select("salt", "part", "grams", "counts").groupBy("salt", "part").applyInArrow(summed, "k long, n long")
    return cells.groupBy(F.shiftright("k", _shift(depth)).alias("g"), "k").agg(F.sum("n").alias("n"))


def top_nodes(counted: DataFrame, depth: int) -> DataFrame:
    """(node, a, b, own) of every node of depth TOP - 1: the weights of the levels above, at most 65,536 * 255 rows."""

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, "g", SOLVED_ROWS):
            yield subtrees(frame["k"].to_numpy(), frame["n"].to_numpy(), depth)[1]

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(("node", "a", "b", "own"), top_levels(rows), strict=True)))

    nodes = counted.repartition("g").sortWithinPartitions("g", "k").mapInPandas(sums, "node long, n0 double, n1 double, log_pw double")
    nodes = nodes.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "log_pw")])
    # each of the 255 decisions has a tree of contexts of its own
    return nodes.groupBy(F.col("node").bitwiseAND(F.lit(255)).alias("decision")).applyInPandas(solve, "node long, a double, b double, own double")


def gram_lengths(counted: DataFrame, top: DataFrame, depth: int, parts: int) -> DataFrame:
    """(part, keys, lengths): every gram with its log10 probability, packed."""
    groups = counted.select("g").distinct().withColumn("c", F.shiftright("g", 8))
    above = top.withColumn("c", F.shiftright("node", 8)).join(groups, "c").select("g", F.lit(0).alias("kind"), F.col("node").alias("x"), F.lit(0).cast("bigint").alias("n"), "a", "b", "own")
    none = F.lit(0.0)
    rows = above.union(counted.select("g", F.lit(1), "k", "n", none, none, none))

    def lengths(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames, "g", SOLVED_ROWS):
            gram = frame["kind"].to_numpy() == 1
            node, first = np.unique(frame["x"].to_numpy()[~gram], return_index=True)
            model = (node, *(frame[c].to_numpy()[~gram][first] for c in ("a", "b", "own")))
            k = frame["x"].to_numpy()[gram]
            v = code_lengths(k, subtrees(k, frame["n"].to_numpy()[gram], depth)[0], model, depth)
            order, at = by_part(dealt(k >> _shift(depth), parts), parts)
            k, v = k[order], v[order]
            there = np.flatnonzero(np.diff(at))
            yield pd.DataFrame({"part": there.astype(np.int32), "keys": [pack_keys(k[at[i] : at[i + 1]]) for i in there], "lengths": [pack(v[at[i] : at[i + 1]]) for i in there]})

    return rows.repartition("g").sortWithinPartitions("g", "kind", "x").mapInPandas(lengths, "part int, keys binary, lengths binary")


def counted_words(raw: DataFrame) -> DataFrame:
    """(part, w, c): every distinct token with its training count; the end is the empty word."""

    def summed(rows: pa.Table) -> pa.Table:
        table = pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in rows.column("words").to_pylist()])
        one = table.group_by("w").aggregate([("n", "sum")])
        return pa.table({"part": pa.array(np.full(len(one), rows.column("part")[0].as_py(), np.int32)), "w": one.column("w"), "n": one.column("n_sum")})

    cells = raw.select("salt", "part", "words").groupBy("salt", "part").applyInArrow(summed, "part int, w binary, n long")
    return cells.groupBy("part", "w").agg(F.sum("n").alias("c"))


def _to_cells(model: DataFrame, salts: int) -> DataFrame:
    """Each part's rows for each salt."""
    return model.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def score(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    held_out: Column | None = None,
    depth: int = DEPTH,
    block_bytes: int = BLOCK_BYTES,
    cell_bytes: int = CELL_BYTES,
    max_parts: int = MAX_PARTS,
) -> DataFrame:
    """Score every text; learn from those where ``held_out`` isn't true.

    (id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes,
    bits_per_byte): n_known counts tokens with training data, base_score is the add-one
    unigram log10 probability of the tokens, score the tree's log10 probability of the
    lower-cased text with its end mark, the last two its code length per byte.
    """
    if not TOP < depth <= 6:
        raise ValueError("depth must be from 4 to 6")
    held_out = F.lit(False) if held_out is None else held_out
    raw, salts, parts = blocks(df, id_col, text_col, held_out, depth, block_bytes, cell_bytes, max_parts)
    counted = common.stored(counted_grams(raw, depth), "grams")
    top = common.stored(top_nodes(counted, depth), "top")
    gram = common.stored(gram_lengths(counted, top, depth, parts), "lengths")
    word = common.stored(counted_words(raw), "words")
    sums = word.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    n_train, n_distinct = int(sums[0] or 0), int(sums[1] or 0)

    def gram_values(left: pa.Table, right: pa.Table) -> pa.Table:
        known, lengths = (np.concatenate([f(x) for x in right.column(c).to_pylist()]) for c, f in (("keys", unpack_keys), ("lengths", lambda x: unpack(x, "f8"))))
        order = np.argsort(known)
        known, lengths = known[order], lengths[order]
        values = [pack(lengths[np.searchsorted(known, unpack_keys(x))]) for x in left.column("grams").to_pylist()]
        return pa.table({"block": left.column("block"), "part": left.column("part"), "grams": left.column("grams"), "values": pa.array(values, pa.binary())})

    def word_values(left: pa.Table, right: pa.Table) -> pa.Table:
        known, counts, values = right.column("w").combine_chunks(), right.column("c").to_numpy(), []
        counts = np.append(counts, 0)
        for x in left.column("words").to_pylist():
            at = pc.fill_null(pc.index_in(pa.ipc.open_stream(x).read_all().column("w"), value_set=known), len(counts) - 1)
            values.append(pack(counts[at.to_numpy()]))
        n = len(left)
        return pa.table({"block": left.column("block"), "part": left.column("part"), "grams": pa.nulls(n, pa.binary()), "values": pa.array(values, pa.binary())})

    schema = "block long, part int, grams binary, values binary"
    cell = ["salt", "part"]
    gram = raw.select(*cell, "block", "grams").groupBy(*cell).cogroup(_to_cells(gram, salts).groupBy(*cell)).applyInArrow(gram_values, schema)
    word = raw.select(*cell, "block", "words").groupBy(*cell).cogroup(_to_cells(word.filter("c > 0"), salts).groupBy(*cell)).applyInArrow(word_values, schema)

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        part, keys, values = (right.column(c).to_pylist() for c in ("part", "grams", "values"))
        of_gram = [i for i in range(len(part)) if keys[i] is not None]
        known, lengths = np.concatenate([unpack_keys(keys[i]) for i in of_gram]), np.concatenate([unpack(values[i], "f8") for i in of_gram])
        order = np.argsort(known)
        known, lengths = known[order], lengths[order]
        of_word = sorted((i for i in range(len(part)) if keys[i] is None), key=part.__getitem__)
        in_order = np.concatenate([unpack(values[i], "i8") for i in of_word])
        del keys, values, order
        rows = pa.ipc.open_stream(left.column("texts")[0].as_py()).read_all()
        text = lowered(rows)
        total = np.zeros(len(text))
        for first, texts in cuts(text):
            for some, owner in grams(texts, depth):
                codes, u = pd.factorize(some)
                total += np.bincount(first + owner, lengths[np.searchsorted(known, u)][codes], len(text))
        del known, lengths
        words, number, of = tokens(text)
        counts = np.empty(len(words), np.int64)
        counts[by_part(dealt_words(words, parts), parts)[0]] = in_order
        base = np.log10((counts + 1) / (n_train + 1 * (n_distinct + 1)))
        size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
        columns = {
            "id": rows.column("id"),
            "held_out": rows.column("held_out"),
            "n_tokens": np.bincount(of, minlength=len(text)),
            "n_known": np.bincount(of, counts[number] > 0, len(text)).astype(np.int64),
            "train_tokens": np.full(len(text), n_train),
            "base_score": np.bincount(of, base[number], len(text)),
            "score": total,
            "n_bytes": size,
            "bits_per_byte": -total * math.log2(10) / (size + 1),
        }
        return pa.table(columns)

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    texts = raw.filter("part = 0").select("block", "texts")
    out = texts.groupBy("block").cogroup(gram.union(word).groupBy("block")).applyInArrow(scored, schema)
    return out.withColumnRenamed("id", id_col)


def held_out_rows(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text leaves remainder 2 by 7."""
    return F.crc32(F.col(id_col).cast("string")) % 7 == 2
