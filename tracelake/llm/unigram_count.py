"""Token counts under a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton lists, for every end position, the vocabulary's pieces that
end there; dynamic programming over positions keeps the best score and the number of
pieces of the best path only. Ties go as in the usual unigram tokenizers: positions
are served from left to right and a path replaces another only when its score is
strictly greater, so among equal scores the longest last piece stays. A character
that no piece of one character covers may be taken as unknown, at the least score in
the vocabulary less ten. With byte fallback an unknown character counts as one token
per UTF-8 byte, otherwise a run of unknown characters counts as one token.

Texts are split before blanks as the tokenizers do (each blank is U+2581 and starts a
new part, and one is put before the text), so parts are independent: each distinct
part is counted once a batch and looked up from then on in a bounded memo. As a part has
one blank, at its beginning, pieces of several blanks match nothing.

Cases: null and empty texts have no token and score zero; repeated rows give repeated
results; parts longer than any cache are counted in memory linear in their length.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BLANK = "▁"
#: What an unknown character costs below the vocabulary's least score.
UNKNOWN = 10.0
#: Distinct parts that a worker remembers.
MEMO = 500_000


class Vocabulary:
    """Pieces and scores, the automaton over them, and the dynamic programme."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True):
        self.scores: dict[str, float] = {}
        for piece, score in pieces:
            if piece:
                self.scores.setdefault(piece, float(score))
        self.byte_fallback = byte_fallback
        self.singles = {piece for piece in self.scores if len(piece) == 1}
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        if self.scores:
            self.automaton.make_automaton()
        self.memo: dict[str, tuple[int, float]] = {}

    def best(self, part: str) -> tuple[int, float]:
        """Number of pieces and score of the best path through ``part``.

        The automaton reports the matches of an end position longest first, that is
        from the leftmost start, and a later one must be strictly better.
        """
        n = len(part)
        score, count = [0.0] + [-np.inf] * n, [0] * (n + 1)
        if self.singles.issuperset(part):
            for last, (length, value) in self.automaton.iter(part):
                end = last + 1
                s = score[end - length] + value
                if s > score[end]:
                    score[end], count[end] = s, count[end - length] + 1
            return count[n], score[n]
        tail = [False] * (n + 1)  # the path ends in an unknown character
        matches = self.automaton.iter(part) if self.scores else iter(())
        match = next(matches, None)
        for i, char in enumerate(part):
            end = i + 1
            while match is not None and match[0] == i:
                length, value = match[1]
                s = score[end - length] + value
                if s > score[end]:
                    score[end], count[end] = s, count[end - length] + 1
                match = next(matches, None)
            if char not in self.singles and score[i] + self.unknown > score[end]:
                score[end], tail[end] = score[i] + self.unknown, True
                count[end] = count[i] + (len(char.encode()) if self.byte_fallback else not tail[i])
        return count[n], score[n]

    def part(self, part: str) -> tuple[int, float]:
        got = self.memo.get(part)
        if got is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            got = self.memo[part] = self.best(part)
        return got

    def text(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        tokens, total = 0, 0.0
        for word in parts(text):
            n, s = self.part(word)
            tokens += n
            total += s
        return tokens, total


def parts(text: str) -> list[str]:
    """Split before each blank; a blank is put first unless there is one."""
    if not text:
        return []
    head = text[1:] if text[0] in (" ", BLANK) else text
    return [BLANK + x for x in head.replace(" ", BLANK).split(BLANK)]


def pieces_of(model_path: str = MODEL) -> list[tuple[str, float]]:
    """Ordinary pieces of a sentencepiece file with the scores stored in it."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]


@functools.lru_cache(maxsize=4)
def vocabulary(model_path: str = MODEL, byte_fallback: bool = True) -> Vocabulary:
    return Vocabulary(pieces_of(model_path), byte_fallback)


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL, byte_fallback: bool = True) -> DataFrame:
    """(id, n_chars, n_tokens, score) of every text. No shuffle."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(model_path, byte_fallback)
        for frame in frames:
            texts = frame["text"].fillna("")
            rows = [vocab.text(x) for x in texts]
            yield pd.DataFrame({"id": frame["id"].array, "n_chars": texts.str.len().astype("int64"), "n_tokens": [x[0] for x in rows], "score": [x[1] for x in rows]})

    kind = df.schema[id_col].dataType.simpleString()
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInPandas(counted, f"id {kind}, n_chars long, n_tokens long, score double").withColumnRenamed("id", id_col)
