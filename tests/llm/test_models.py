"""Language models and tokenizers against brute force."""

import base64
import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from tracelake.llm import bpe, common, ctw, ngram_quality, unigram_count

TEXTS = ["The cat sat on the mat.", "the cat SAT", "", None, "a\n\nb  a", "Ünïcode ñandú — 中文", "the cat sat on the mat.", "x" * 50, " \t lead and trail \n"]


def docs(spark, texts, lang="en"):
    rows = [(i, t, lang, i) for i, t in enumerate(texts)] + [(None, "no id", None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")


# context-tree weighting


def plain_ctw(train, test, depth):
    def decisions(text):
        data = bytes([255]) * depth + text + bytes([255])
        for i in range(depth, len(data)):
            context, prefix = data[i - depth : i][::-1], 1
            for j in range(7, -1, -1):
                bit = data[i] >> j & 1
                yield context, prefix, bit
                prefix = prefix << 1 | bit

    counts = defaultdict(lambda: [0, 0])
    children = defaultdict(set)
    for text in train:
        for context, prefix, bit in decisions(text):
            for d in range(depth + 1):
                counts[context[:d], prefix][bit] += 1
                if d:
                    children[context[: d - 1], prefix].add(context[:d])

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    memo = {}

    def log_pw(s, prefix):
        if (s, prefix) not in memo:
            own = kt(*counts[s, prefix])
            memo[s, prefix] = own if len(s) == depth else np.logaddexp(own, sum(log_pw(c, prefix) for c in children[s, prefix])) - math.log(2)
        return memo[s, prefix]

    def p(s_full, prefix, bit):
        mixed = None
        for d in range(depth, -1, -1):
            s = s_full[:d]
            if (s, prefix) not in counts:
                continue
            a, b = counts[s, prefix]
            own = ((b if bit else a) + 0.5) / (a + b + 1)
            if d == depth or mixed is None and d == depth:
                mixed = own
            else:
                w = math.exp(kt(a, b) - math.log(2) - log_pw(s, prefix))
                mixed = w * own + (1 - w) * (own if mixed is None else mixed)
        return 0.5 if mixed is None else mixed

    return [sum(math.log10(p(c, x, b)) for c, x, b in decisions(t)) for t in test]


@pytest.mark.parametrize(("cell_bytes", "max_parts"), [(1 << 20, 9), (40, 3)])
def test_ctw_equals_the_recursion(spark, cell_bytes, max_parts):
    scored = ctw.score(docs(spark, TEXTS), held_out=ctw.held_out_rows(), depth=4, block_bytes=64, cell_bytes=cell_bytes, max_parts=max_parts)
    got = {r["doc_id"]: r for r in scored.collect()}
    held = {i for i in range(len(TEXTS)) if got[i]["held_out"]}
    import zlib

    assert held == {i for i in range(len(TEXTS)) if zlib.crc32(str(i).encode()) % 7 == 2}
    low = [(t or "").encode().lower() for t in [*TEXTS, "no id"]]
    train = [t for i, t in enumerate(low) if i not in held]
    want = plain_ctw(train, low, 4)
    for i in range(len(TEXTS)):
        assert abs(got[i]["score"] - want[i]) < 1e-9 * max(1, abs(want[i])), i
    seen = Counter(w for t in train for w in [*t.split(), b""])
    n, v = sum(seen.values()), len(seen)
    for i, t in enumerate(low[:-1]):
        words = [*t.split(), b""]
        assert got[i]["n_tokens"] == len(words) and got[i]["n_known"] == sum(seen[w] > 0 for w in words) and got[i]["train_tokens"] == n
        assert abs(got[i]["base_score"] - sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in words)) < 1e-9
    assert got[None]["n_tokens"] == 3


def test_packed_arrays():
    for values in ([], [5], [-3, 7, 7, 1 << 47]):
        a = np.array(sorted(values), np.int64)
        assert common.unpack_keys(common.pack_keys(a)).tolist() == a.tolist() and common.unpack(common.pack(a / 3), "f8").tolist() == (a / 3).tolist()


def test_ctw_of_no_rows(spark):
    assert ctw.score(docs(spark, []).limit(0)).count() == 0


def test_long_texts_have_the_same_grams():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (0, 3, 40, 7, 100, 1)]

    def flat(limit):
        return sorted((int(o), int(k)) for keys, owner in ctw.grams(texts, 5, limit) for k, o in zip(keys, owner, strict=True))

    assert flat(10) == flat(1 << 20) and len(flat(10)) == sum(len(t) + 1 for t in texts)
    for order in (3, 5):
        a = sorted((int(o), int(k)) for keys, owner in ngram_quality.grams(texts, order, 9) for k, o in zip(keys, owner, strict=True))
        b = sorted((int(o), int(k)) for keys, owner in ngram_quality.grams(texts, order) for k, o in zip(keys, owner, strict=True))
        assert a == b and len(a) == sum(len(t) + 1 for t in texts)


# modified Kneser-Ney


def plain_kneser_ney(texts, order):
    grams = Counter()
    for t in texts:
        data = bytes([255]) * (order - 1) + t + bytes([254])
        for i in range(order - 1, len(data)):
            grams[data[i - order + 1 : i + 1]] += 1
    tables = {order: grams}
    for k in range(order - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    p = {b"": 1 / 256}
    for k in range(1, order + 1):
        t = tables[k]
        n = {i: sum(a == i for a in t.values()) for i in (1, 2, 3, 4)}
        d = {1: 0.5, 2: 1.0, 3: 1.5}
        if min(n.values()) > 0:
            y = n[1] / (n[1] + 2 * n[2])
            own = {i: i - (i + 1) * y * n[i + 1] / n[i] for i in (1, 2, 3)}
            if all(x > 0 for x in own.values()):
                d = own
        total, left = Counter(), Counter()
        for g, a in t.items():
            total[g[:-1]] += a
            left[g[:-1]] += d[min(a, 3)]
        for g, a in t.items():
            p[g] = (a - d[min(a, 3)]) / total[g[:-1]] + left[g[:-1]] / total[g[:-1]] * (p[g[1:]] if k > 1 else 1 / 256)
    out = []
    for t in texts:
        data = bytes([255]) * (order - 1) + t + bytes([254])
        out.append(sum(math.log2(p[data[i - order + 1 : i + 1]]) for i in range(order - 1, len(data))))
    return out


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_quality_equals_kneser_ney(spark, broadcast):
    texts = [t for t in TEXTS] + ["der die das und der hund", "the dog sat on the log and the cat sat on the mat " * 6]
    got = {r["doc_id"]: r for r in ngram_quality.report(docs(spark, texts), order=3, broadcast_grams=broadcast).collect()}
    bodies = [b" ".join((t or "").encode().lower().split()) for t in texts]
    for i, want in enumerate(plain_kneser_ney(bodies, 3)):
        assert abs(got[i]["bits_per_byte"] * (len(bodies[i]) + 1) + want) < 1e-6 * max(1, abs(want)), i
    assert got[3]["n_words"] == 0 and got[3]["base_failed"] and not got[3]["kept"] and None in got


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab# \n\t\x0b\x85é|", max_size=60))
def test_base_features(text):
    words, run = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [run] if run else []
            run = ""
        else:
            run += c
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    assert ngram_quality.base_features(text) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside))


def test_bands_reject_the_odd_one(spark):
    rng = np.random.default_rng(2)
    words = [f"w{x}{y}" for x in "abcdefghij" for y in "nrst"]
    texts = [" ".join(rng.choice(words, 120)) for _ in range(80)]
    odd = " ".join("".join(rng.choice(list("qxzjvkpy0123456789"), 9)) for _ in range(120))
    rows = ngram_quality.report(docs(spark, [*texts, odd])).collect()
    assert [r["doc_id"] for r in rows if not r["kept"] and not r["base_failed"]] == [80]
    kept = ngram_quality.filtered(docs(spark, [*texts, odd]))
    assert kept.columns == ["doc_id", "text", "lang", "quality"] and kept.count() == 80
    assert ngram_quality.report(docs(spark, []).limit(0)).count() == 0


# tokenizers


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab'sé \n\t\x1c 　!7中", max_size=80), st.integers(1, 9))
def test_pieces_split_where_matches_end(text, limit):
    enc = bpe.encoding()
    assert "".join(p for p, _ in bpe.safe_pieces(text, limit)) == text
    assert bpe.encode_text(enc, text, limit).tolist() == library_enc().encode_ordinary(text)


_ENC = []


def library_enc():
    if not _ENC:
        _ENC.append(library())
    return _ENC[0]


def test_bpe_round_trip(spark):
    texts = [*TEXTS, "<|endoftext|>", "word " * 30000, " " * 300]
    rows = {r["doc_id"]: r for r in bpe.round_trip(docs(spark, texts), limit=1000, with_ids=True).collect()}
    for i, t in enumerate(texts):
        ids = library_enc().encode_ordinary(t or "")
        assert rows[i]["n_tokens"] == len(ids) and rows[i]["ids"] == np.array(ids, "<u4").tobytes()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    d = docs(spark, TEXTS)
    back = d.select("doc_id", bpe.decode(bpe.encode(d.text)).alias("raw"), "text").collect()
    assert all(bytes(r["raw"]) == (r["text"] or "").encode() for r in back)


def unigram(pieces, unknown=0):
    vocab = [("<unk>", 0.0), *pieces]
    return Tokenizer(models.Unigram(vocab, unknown, False))


@settings(max_examples=120, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abc", min_size=1, max_size=4), st.sampled_from([-1.0, -2.0, -3.0, -4.0])), min_size=1, max_size=12, unique_by=lambda x: x[0]), st.text(alphabet="abc", max_size=14))
def test_unigram_counts_equal_the_library(pieces, text):
    pieces = [*pieces, *[(c, -6.0) for c in "abc" if c not in dict(pieces)]]
    n, score = unigram_count.Vocabulary(pieces, False).best(text)
    # the library's special piece has the score zero, but no text matches it
    tokens = unigram(pieces).encode(text).tokens if text else []
    assert n == len(tokens)
    assert math.isclose(score, sum(dict(pieces)[t] for t in tokens), abs_tol=1e-9)


def test_unigram_pieces_of_several_blanks_match_nothing():
    b = unigram_count.BLANK
    v = unigram_count.Vocabulary([(b, -2.0), (b * 2, -0.5), ("a", -1.0)], False)
    assert unigram_count.parts("a  a") == [f"{b}a", b, f"{b}a"] and v.text("a  a") == (5, -8.0)
    several = [x for x, _ in unigram_count.pieces_of() if len(x) > 1 and set(x) == {b}]
    assert len(several) == 14


def test_unigram_unknowns_and_table(spark):
    v = unigram_count.Vocabulary([("a", -1.0), ("ab", -1.5), (unigram_count.BLANK, -2.0)], False)
    assert v.best("azzab")[0] == 3 and unigram_count.Vocabulary([("a", -1.0)], True).best("aé")[0] == 3
    rows = {r["doc_id"]: r for r in unigram_count.count_tokens(docs(spark, TEXTS)).collect()}
    assert rows[2]["n_tokens"] == 0 and rows[3]["n_tokens"] == 0 and rows[0]["n_tokens"] > 5 and rows[None]["n_tokens"] > 0
