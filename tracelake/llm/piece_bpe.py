"""SentencePiece encoding and decoding (BPE models with byte fallback) by vectorised merge rounds.

A batch's distinct words lie in one flat array of symbols. They are cut into segments
wherever no piece of the model holds the two characters beside each other, for no merge
crosses such a place. A round finds the least rank of a neighbouring pair in each segment,
merges its occurrences from the left, all at once, and closes up the array; segments
without a pair leave it. The library merges one pair at a time, so where a merge makes a
pair of the same or a lower rank, only the segment's first occurrence counts in that round:
the result is the library's for every model and text. A segment that is very long, or that
is left after many rounds, is merged with a heap instead, by the same rule.

Normalisation is the library's own, and ids are decoded by its ``decode``. Words and pieces
of text are handled in bounded numbers, so the memory of a task grows with a text's ids only.

Cases: a null text is encoded as the empty text and gives no ids; null ids stay null, empty
ids decode to the empty text; repeated rows give repeated results; ids and ties of the table
don't matter, ties of scores go to the leftmost pair; an empty table gives an empty result;
``encode`` and ``decode`` are columns and leave other columns alone, ``round_trip`` gives the
id, the columns asked for and its own, whatever else the table has.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm import common

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Words that one run of rounds takes, and characters of them.
WORDS, CHARS = 400_000, 2_000_000
#: Symbols of a segment, and rounds, beyond which the heap goes on.
LONG, ROUNDS = 4096, 64

_NONE = np.int32(2**31 - 1)
_UNKNOWN = np.int32(-2)


class Pieces:
    """A model as tables: symbols of characters, pairs of symbols with rank and result, unsafe neighbours."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as spec

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = spec.ModelProto.FromString(self.library.serialized_model_proto())
        kind = spec.ModelProto.SentencePiece
        if model.trainer_spec.model_type != spec.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("not a BPE model with byte fallback")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces aren't supported")
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.size = len(model.pieces)
        self.bytes = np.array([self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        # a character that only longer pieces have is a symbol, too, but no piece
        symbols = dict(normal)
        for char in sorted({c for piece in normal for c in piece} - set(normal)):
            symbols[char] = self.size + len(symbols) - len(normal)
        self.of_char = np.full(0x110000, _UNKNOWN, np.int32)
        for piece, i in symbols.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        score = {i: model.pieces[i].score for i in normal.values()}
        ranks = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.side = self.size + len(symbols) - len(normal) + 1
        pairs = sorted(
            (symbols[piece[:at]] * self.side + symbols[piece[at:]], ranks[score[i]], i)
            for piece, i in normal.items()
            for at in range(1, len(piece))
            if piece[:at] in symbols and piece[at:] in symbols
        )
        self.ranks = np.array([p[1] for p in pairs] + [_NONE], np.int32)
        self.made = np.array([p[2] for p in pairs] + [-1], np.int32)
        self._hash(np.array([p[0] for p in pairs], np.int64))
        beside = {(ord(a) << 21) | ord(b) for piece in normal for a, b in zip(piece, piece[1:], strict=False)}
        self.beside = np.array(sorted(beside), np.int64)
        mark = "▁"
        #: Words can be looked at alone if every piece has its marks at the front.
        cut = not any(re.search(f"[^{mark}]{mark}", p) for p in normal)
        self.word, self.edge = (re.compile(x) for x in ((f"{mark}*[^{mark}]+|{mark}+", f"(?<=[^{mark}]){mark}") if cut else (r"(?s).+", r"(?!)")))

    def words(self, text: str, chars: int) -> Iterator[list[str]]:
        """The words of a normalised text, in lists of about ``chars`` characters."""
        at = 0
        while at < len(text):
            edge = self.edge.search(text, at + chars) if len(text) - at > chars else None
            end = edge.start() if edge else len(text)
            yield self.word.findall(text[at:end] if end - at < len(text) else text)
            at = end

    def _hash(self, keys: np.ndarray) -> None:
        """An open hash table of pairs, at most an eighth full; a pair's slot is the next free one."""
        self.bits = max(10, int(len(keys) * 8).bit_length())
        slots = 1 << self.bits
        self.keys, self.at = np.full(slots, -1, np.int64), np.full(slots, len(keys), np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot] == -1
            self.keys[slot[free]], self.at[slot[free]] = keys[todo[free]], todo[free]
            late = self.keys[slot] != keys[todo]  # the slot is another's
            todo, slot = todo[late], (slot[late] + 1) & (slots - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Numbers of the pairs; the number after the last one if they make no piece."""
        key = left.astype(np.int64) * self.side + right
        key[(left < 0) | (right < 0)] = -2
        slot = self._slot(key)
        there = self.keys[slot]
        out = self.at[slot]
        late = np.flatnonzero((there != key) & (there != -1))
        out[there != key] = len(self.ranks) - 1
        slot = slot[late]
        while len(late):
            slot = (slot + 1) & (len(self.keys) - 1)
            there = self.keys[slot]
            same = there == key[late]
            out[late[same]] = self.at[slot[same]]
            go = ~same & (there != -1)
            late, slot = late[go], slot[go]
        return out


@functools.lru_cache(maxsize=4)
def pieces(path: str = MODEL) -> Pieces:
    """The tables of a model; one for each worker process and file."""
    return Pieces(path)


def merge_with_heap(model: Pieces, symbols: list[int]) -> list[tuple[int, int]]:
    """The library's order with a heap, for one segment: (place, symbol) of what is left."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    found = model.find(np.array(symbols[:-1], np.int32), np.array(symbols[1:], np.int32))
    heap = [(int(model.ranks[t]), i, symbols[i], symbols[i + 1], int(model.made[t])) for i, t in enumerate(found.tolist()) if model.made[t] >= 0]
    heapq.heapify(heap)
    known: dict[tuple[int, int], tuple[int, int]] = {}

    def push(i: int, j: int) -> None:
        pair = symbols[i], symbols[j]
        if pair not in known:
            at = model.find(np.array(pair[:1]), np.array(pair[1:]))[0]
            known[pair] = int(model.ranks[at]), int(model.made[at])
        rank, made = known[pair]
        if made >= 0:
            heapq.heappush(heap, (rank, i, *pair, made))

    gone = bytearray(n)
    while heap:
        _, i, left, right, made = heapq.heappop(heap)
        if gone[i] or symbols[i] != left or (j := after[i]) >= n or symbols[j] != right:
            continue
        symbols[i], gone[j] = made, 1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            push(i, after[i])
        if before[i] >= 0:
            push(before[i], i)
    return [(i, symbols[i]) for i in range(n) if not gone[i]]


def merge_in_rounds(model: Pieces, symbols: np.ndarray, starts: np.ndarray, long: int = LONG, rounds: int = ROUNDS) -> np.ndarray:
    """Symbols after all merges, each at its first character's place, -1 elsewhere.

    ``starts`` are the segments' first places, ascending from 0.
    """
    final = np.full(len(symbols), -1, np.int32)
    segment = np.zeros(len(symbols), np.int64)
    segment[starts[1:]] = 1
    segment = np.cumsum(segment)
    place = np.arange(len(symbols))
    sizes = np.diff(starts, append=len(symbols))
    by_heap = sizes > long

    def finish(which: np.ndarray, symbols: np.ndarray, segment: np.ndarray, place: np.ndarray) -> None:
        cut = np.flatnonzero(np.diff(segment[which])) + 1
        for some, at in zip(np.split(symbols[which], cut), np.split(place[which], cut), strict=True):
            for i, symbol in merge_with_heap(model, some.tolist()):
                final[at[i]] = symbol

    if by_heap.any():
        which = by_heap[segment]
        finish(which, symbols, segment, place)
        symbols, segment, place = symbols[~which], segment[~which], place[~which]
    for _ in range(rounds):
        if not len(symbols):
            return final
        inner = segment[:-1] == segment[1:]
        found = np.full(len(symbols), len(model.ranks) - 1)
        found[:-1][inner] = model.find(symbols[:-1][inner], symbols[1:][inner])
        rank = model.ranks[found]
        first = np.flatnonzero(np.diff(segment, prepend=-1))
        number = np.cumsum(np.diff(segment, prepend=segment[0]) != 0)
        least = np.minimum.reduceat(rank, first)[number]
        done = least == _NONE
        if done.any():
            final[place[done]] = symbols[done]
            symbols, segment, place, found, rank, least, number = (x[~done] for x in (symbols, segment, place, found, rank, least, number))
            if not len(symbols):
                return final
        hit = rank == least
        at = np.flatnonzero(hit)
        # of occurrences that overlap, every other one from the left
        opens = np.diff(at, prepend=-2) != 1
        run = at[opens][np.cumsum(opens) - 1]
        at = at[(at - run) % 2 == 0]
        at = _without_rivals(model, symbols, segment, found, least, at)
        symbols = symbols.copy()
        symbols[at] = model.made[found[at]]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, segment, place = symbols[stay], segment[stay], place[stay]
    finish(np.ones(len(symbols), bool), symbols, segment, place)
    return final


def _without_rivals(model: Pieces, symbols: np.ndarray, segment: np.ndarray, found: np.ndarray, least: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Keeps a segment's first merge only, if any of its merges makes a pair that would come before the next one."""
    made = model.made[found[at]]
    # to the right: the neighbour as it is when the merge happens, from left to right
    right = at + 2
    can = right < len(symbols)
    can[can] = segment[right[can]] == segment[at[can]]
    rival = np.zeros(len(at), bool)
    rival[can] = model.ranks[model.find(made[can], symbols[right[can]])] <= least[at[can]]
    # to the left: the neighbour may be the result of the merge before
    left = at - 1
    can = left >= 0
    can[can] = segment[left[can]] == segment[at[can]]
    before = symbols[np.maximum(left, 0)]
    touch = np.zeros(len(at), bool)
    touch[1:] = at[1:] - at[:-1] == 2
    before = np.where(touch, np.concatenate([made[:1], made[:-1]]), before)
    rival[can] |= model.ranks[model.find(before[can], made[can])] <= least[at[can]]
    if not rival.any():
        return at
    of = segment[at]
    first = np.diff(of, prepend=-1) != 0
    return at[first | ~np.isin(of, of[rival])]


def encode_words(model: Pieces, words: list[str], long: int = LONG, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after another, and where each word's begin (with the end as the last)."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    cut = np.ones(len(chars), bool)
    if len(chars):
        pair = (chars[:-1] << 21) | chars[1:]
        at = np.minimum(np.searchsorted(model.beside, pair), max(len(model.beside) - 1, 0))
        cut[1:] = model.beside[at] != pair if len(model.beside) else True
        cut[ends[:-1][ends[:-1] < len(chars)]] = True
    final = merge_in_rounds(model, model.of_char[chars], np.flatnonzero(cut), long, rounds) if len(chars) else np.empty(0, np.int32)
    kept = np.flatnonzero(final != -1)
    symbols, codes = final[kept], chars[kept]
    # what is no piece becomes its UTF-8 bytes
    other = (symbols < 0) | (symbols >= model.size)
    width = np.where(other, 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF), 1)
    to = np.cumsum(width) - width
    ids = np.zeros(int(width.sum()), np.int32)
    ids[to[~other]] = symbols[~other]
    lead = (0, 0, 0xC0, 0xE0, 0xF0)
    for n in range(1, 5):
        these = np.flatnonzero(other & (width == n))
        for k in range(n):
            bits = (codes[these] >> (6 * (n - 1 - k))) & (0x3F if k else 0x7F if n == 1 else (1 << (7 - n)) - 1)
            ids[to[these] + k] = model.bytes[bits | (lead[n] if k == 0 else 0x80)]
    count = np.zeros(len(chars) + 1, np.int64)
    count[kept + 1] = width
    return ids, np.cumsum(count)[np.concatenate([[0], ends])]


def encode_texts(model: Pieces, texts: Iterable[str | None], words: int = WORDS, chars: int = CHARS, long: int = LONG, rounds: int = ROUNDS) -> Iterator[np.ndarray]:
    """Ids of each text in turn. Words are gathered over texts, and a text over several gatherings."""
    index = _Numbers()
    order: list[int] = []
    sizes: list[int] = []  # words of each text since the last gathering
    whole: list[list[np.ndarray]] = []

    def flush() -> None:
        ids, at = encode_words(model, list(index), long, rounds)
        which = np.array(order, np.int64)
        length = at[which + 1] - at[which]
        ends = np.cumsum(length)
        flat = ids[np.repeat(at[which] - (ends - length), length) + np.arange(int(length.sum()))]
        stops = np.concatenate([[0], ends])[np.cumsum(sizes)]
        for parts, part in zip(whole, np.split(flat, stops[:-1]), strict=True):
            parts.append(part)
        index.clear()
        order.clear()

    held = 0
    for text in texts:
        whole.append([])
        sizes.append(0)
        for found in model.words(model.library.normalize(text) if text else "", chars):
            order.extend(map(index.__getitem__, found))
            sizes[-1] += len(found)
            held += sum(map(len, found))
            if len(order) >= words or held >= chars:
                flush()
                for parts in whole[:-1]:
                    yield np.concatenate(parts)
                whole, sizes, held = whole[-1:], [0], 0
    if whole:
        flush()
        for parts in whole:
            yield np.concatenate(parts)


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def encode(text: Column, model_path: str = MODEL) -> Column:
    """Column of ids: array<int>, without begin or end."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series(list(encode_texts(pieces(model_path), texts)), dtype=object)

    return ids(text.cast("string"))


def decode(ids: Column, model_path: str = MODEL) -> Column:
    """Column of texts, as the library's ``decode`` gives them."""

    @F.pandas_udf("string")
    def texts(rows: pd.Series) -> pd.Series:
        library = pieces(model_path).library
        return pd.Series([None if x is None else library.decode([int(i) for i in x]) for x in rows], dtype=object)

    return texts(ids)


def round_trip(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL, keep: tuple[str, ...] = (), with_ids: bool = False) -> DataFrame:
    """Encode, decode and digest each text: (id, columns ``keep``, n_tokens, ids_sha256, decoded_sha256).

    ``with_ids`` adds the ids, ``array<int>``. One pass and no shuffle.
    """
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = pieces(model_path)
        decimal = [str(i) for i in range(model.size)]
        for frame in frames:
            rows = []
            for ids in encode_texts(model, frame["text"]):
                some = ids.tolist()
                listed = ",".join([decimal[i] for i in some])
                decoded = model.library.decode(some) if some else ""
                rows.append((len(some), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), *[ids] * with_ids))
            yield pd.concat([frame.drop(columns="text").reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    source = df.select(F.col(id_col).alias("id"), *[F.col(c).alias(f"keep_{c}") for c in keep], F.col(text_col).cast("string").alias("text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    out = common.map_slices(source, digests, kinds + "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
    return out.withColumnsRenamed({"id": id_col} | {f"keep_{c}": c for c in keep})
