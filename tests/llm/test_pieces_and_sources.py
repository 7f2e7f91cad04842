"""Whitening, SentencePiece and source divergence against brute force, the library and SQL; long texts with many secrets."""

import hashlib
import random
import time
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.llm import bpe, piece_bpe, secrets, source_tries, warc, whitening, wrappers


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# whitening


def test_digit_slices_are_exact():
    rng = np.random.default_rng(0)
    for high in (3, 200, 1 << 15, 1 << 16, (1 << 31) + 5, 1 << 40, 1 << 61):
        for n in (1, 5, 40):
            z = rng.integers(-high, high, (n, 6))
            z[0] = [high - 1, -high, high - 1, -high, 0, -1]
            assert (whitening.exact_gram(z) == z.astype(object).T @ z.astype(object)).all()
    for value in (0, 1, -1, 1 << 32, -(1 << 32), (1 << 100) + 3, -(1 << 100) - 7, (1 << 64) - 1):
        assert sum(d << (32 * k) for k, d in whitening._digits(value)) == value


def plain_whitening(vectors, components):
    """n, deviations and whitened rows by fractions and one eigendecomposition."""
    x = [[int(np.floor(256 * float(c))) for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, d = len(fit), len(fit[0])
    sums = [sum(v[k] for v in fit) for k in range(d)]
    mean = [Fraction(s, n) for s in sums]
    cov = np.array([[float(sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in fit) / n) for j in range(d)] for i in range(d)])
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    whitened = [[float(sum(float(v[k] - mean[k]) * basis[k, c] for k in range(d)) / np.sqrt(values[c])) for c in range(components)] for v in x]
    return n, [sum((n * v[k] - sums[k]) ** 2 for k in range(d)) for v in x], whitened, values / values.sum()


def test_whitening_against_fractions(spark):
    rng = np.random.default_rng(1)
    for scale, offset in ((1.0, 0.0), (1e-2, 3.0), (1e6, -5e7)):
        a = (rng.normal(size=(30, 6)) * np.arange(1, 7) * scale + offset).round(6)
        a[7] = a[3]
        rows = [(i, [float(c) for c in v], "x", 1.0) for i, v in enumerate(a)] + [(90, None, "x", 0.0), (91, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x", 0.0), (92, [float("nan")] * 6, None, 0.0), (93, [float("inf")] * 6, "x", 0.0), (94, [1.0], "x", 0.0), (95, [], "x", 0.0)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id string, component double").repartition(5)
        got = whitening.whiten(df).collect()
        n, deviations, whitened, share = plain_whitening(a, 4)
        assert len(got) == 30 * 4 and {r["n"] for r in got} == {n} and n == 29
        sign = {}
        for r in got:
            i, c = r["vec_id"], r["component"] - 1
            assert r["deviation"] == (deviations[i] if deviations[i] < 1 << 63 else None)
            sign.setdefault(c, 1 if abs(r["whitened"] - whitened[i][c]) < abs(r["whitened"] + whitened[i][c]) else -1)
            assert abs(r["whitened"] - sign[c] * whitened[i][c]) < 1e-6
            assert abs(r["explained"] - share[c]) < 1e-9 and r["identity_error"] < 1e-6


def test_whitening_of_odd_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], kind)).count() == 0
    got = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (None, [0.5, 0.25])], kind)).collect()
    assert len(got) == 4 and all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 and r["n"] == 1 for r in got)
    huge = whitening.whiten(spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 3.0])], kind)).collect()
    assert len(huge) == 6 and all(r["deviation"] is None or r["deviation"] >= 0 for r in huge)


# SentencePiece


def test_pieces_equal_the_library():
    model = piece_bpe.pieces()
    rng = random.Random(1)
    parts = ["a", "b", "e", "t", " ", "  ", "th", "ing", "é", "中", "文", "😀", "\n", "1", "0", "=", "-", "_", "▁", "x", "//", " the", "\t", "ß", "Д", "а", "の", "\0", "<s>", "<0x41>"]
    texts = ["", None, " ", " " * 100, " " * 900 + "x", "a" * 700, "▁▁ a", *["".join(rng.choice(parts) for _ in range(rng.randint(0, 200))) for _ in range(600)]]
    want = [model.library.encode(x or "") for x in texts]
    for words, chars, long, rounds in ((400_000, 2_000_000, 4096, 64), (7, 50, 4096, 64), (1000, 300, 3, 1), (50, 10_000, 1, 2), (400_000, 2_000_000, 10**9, 10**9)):
        assert [x.tolist() for x in piece_bpe.encode_texts(model, texts, words, chars, long, rounds)] == want


def test_pieces_of_long_texts_without_blanks():
    model = piece_bpe.pieces()
    rng = random.Random(2)
    for alphabet in ("的一是不了人我在有他这为之大来以个中上们", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "a", "=-", "é"):
        text = "".join(rng.choice(alphabet) for _ in range(60_000))
        assert next(piece_bpe.encode_texts(model, [text])).tolist() == model.library.encode(text)


def test_pieces_round_trip(spark):
    texts = ["plain words, and more", None, "", "tab\tand\nline", "日本語 😀", "plain words, and more"]
    df = spark.createDataFrame([(i, t, "k", 5) for i, t in enumerate(texts)], "doc_id long, text string, id string, n_tokens long")
    library = piece_bpe.pieces().library
    for r in piece_bpe.round_trip(df, keep=("id",), with_ids=True).collect():
        ids = library.encode(texts[r["doc_id"]] or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["id"] == "k"
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
    both = df.select("text", piece_bpe.encode(F.col("text")).alias("ids")).select("text", "ids", piece_bpe.decode(F.col("ids")).alias("back")).collect()
    assert all(r["back"] == (r["text"] or "") for r in both)
    assert piece_bpe.round_trip(df.limit(0)).count() == 0


# source divergence


def corpus(spark, n=160, seed=3):
    rng = random.Random(seed)
    words = ["alpha", "Alpha", "alp", "été", "ÉTÉ", "naïve", "日本", "x", "zeta2zeta", "hello-world", *[f"w{'abcdefgh'[i % 8]}{'xyz'[i % 3]}" for i in range(24)]]
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "1 2 3"]) if rng.random() < 0.1 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))
        rows.append((i, text, rng.choice(["en", "en", "fr", None, ""]), rng.choice(["a", "a", "b", "été", None])))
    rows += [(900, "only one", "tiny", "s"), (901, None, "tiny", "t"), (902, "9", "empty", "s")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_divergence_equals_sql(spark):
    docs = corpus(spark)
    documents = docs.toPandas()  # noqa: F841  read by name
    want = sorted(duckdb.query(source_tries.oracle()).fetchall(), key=repr)
    assert rows_of(source_tries.audit(docs.repartition(7)).select("lang", "source", "part", "item", "value", "rank")) == want
    assert {r[2] for r in want} == {"pair", "term"} and any(r[0] == "empty" or r[0] == "tiny" for r in want)
    odd = docs.withColumns({"prefix": F.lit("p"), "kept": F.lit(1), "data": F.lit("x")})
    assert rows_of(source_tries.audit(odd, ranks=3)) == sorted((r for r in want if r[2] == "pair" or r[5] <= 3), key=repr)
    assert source_tries.audit(docs.limit(0)).count() == 0


def test_divergence_does_not_depend_on_flushes(spark, monkeypatch):
    want = rows_of(source_tries.audit(corpus(spark)))
    monkeypatch.setattr(source_tries, "LABELS", 200)
    monkeypatch.setattr(source_tries, "LEAVES", 3)
    monkeypatch.setattr(source_tries, "WAITING", 2)
    monkeypatch.setattr(source_tries, "BLOCK", 2)
    monkeypatch.setattr(source_tries, "PREFIX", 1)
    one = source_tries.Growing()
    for source, text in (("a", b"to ten to"), ("b", b"tea ten"), ("a", b"inn i in to"), ("c", b"")):
        one.add(source, text.split())
    trie, sources = one.trie()
    assert sources == ["a", "b", "c"] and trie.terms == [b"i", b"in", b"inn", b"tea", b"ten", b"to"] and trie.docs.tolist() == [1, 1, 1, 1, 2, 2]
    again = source_tries.Trie.unpack(trie.pack())
    assert again.terms == trie.terms and again.count.tolist() == trie.count.tolist() == [1, 1, 1, 1, 1, 1, 3]
    both = source_tries.merge([(trie, np.array([2, 0, 1])), (again, np.array([0, 1, 2]))], 3)
    assert both.terms == trie.terms and both.docs.tolist() == [2, 2, 2, 2, 4, 4] and both.count.sum() == 18
    assert [p for p, _ in trie.cut(1)] == [b"i", b"t"]
    assert rows_of(source_tries.audit(corpus(spark))) == want


def test_shares_are_exact():
    rng = random.Random(5)
    for _ in range(200):
        total = rng.randint(1, 10**rng.randint(1, 15))
        count = rng.randint(0, total - 1)
        assert source_tries.shares(np.array([count]), np.array([total]))[0] == 1 + 10**9 * (count + 1) // total


# secrets and pages


def test_secrets_in_long_texts(spark):
    hexes = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(50_000)]
    start = time.perf_counter()
    row = secrets.report(spark.createDataFrame([(1, "\n".join(hexes))], "doc_id long, text string")).first()
    assert row["n_hex"] == 50_000 and time.perf_counter() - start < 30
    assert row["spans"].startswith("hex:0:40,hex:41:81") and row["spans"].endswith(f"hex:{49_999 * 41}:{49_999 * 41 + 40}")


def test_pieces_of_texts_change_no_span(spark, monkeypatch):
    rng = random.Random(7)
    bits = ["password: hunter22x", "api_key = 'AbC123dEf456'", "token:", " ", "  ", ":", "=", "\n", '"', "é", ",", "AKIA" + "B2C3" * 5, "0123456789abcdef" * 2, "q8ZtR4mXc1Vb7NpK2sWd9LfG", "secret", "a", "T:", "9:", "= x", "2024-01-01-", "x.y/z"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    want, clean = rows_of(secrets.report(documents)), rows_of(secrets.redact(documents))
    monkeypatch.setattr(secrets, "PIECE", 8)
    assert rows_of(secrets.report(documents)) == want and rows_of(secrets.redact(documents)) == clean


@pytest.mark.parametrize(
    "page", ["<body><nav>Menu item</nav></body>", "<header>Head</header><footer>Foot</footer>", '<div class="cookie-notice">We use cookies</div><form>x</form><section class="comments">hi</section>', "<nav>Menu</nav><article></article>", "<div>" * 600 + "<nav>menu</nav>" + "</div>" * 600]
)
def test_pages_of_excluded_parts_have_no_text(page):
    assert wrappers.extract(page) == ""


def test_text_that_a_hosts_articles_share_stays():
    pages = [f"<body><div class=a><h1>T{i}</h1><p class=lead>Same lead for all</p><p>Body {i} words and words {i * 7}</p></div><div class=b>Same bottom</div></body>" for i in range(5)]
    node = wrappers.sealed(wrappers.tree(pages[0]))
    for page in pages[1:]:
        wrappers.align(node, wrappers.sealed(wrappers.tree(page)))
    plan = wrappers.plan_of(wrappers.dump(node))
    assert wrappers.extract(pages[2], plan) == "T2 Same lead for all Body 2 words and words 14"


def test_byte_pieces_are_cut_between_kinds_of_characters():
    enc, rng = bpe.encoding(), random.Random(1)
    parts = ["a", "B", "'s", "'", "'re", "1", "2", " ", "  ", "\n", "!", "-", "中", "文", "。", "é", "Ⅷ", "_", "\t", "　", "٣", "😀"]
    for _ in range(800):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        for limit in (1, 3, 10):
            assert bpe.encode_text(enc, text, limit).tolist() == enc.encode_ordinary(text)
    for text in ("ab1" * 400_000, "x," * 500_000, "中文。" * 400_000):
        assert max(len(p) for p, _ in bpe.safe_pieces(text)) <= bpe.LIMIT + 3
        assert bpe.encode_text(enc, text).tolist() == enc.encode_ordinary(text)
    for text in ("中" * 60_000, "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(1_000_000))):
        assert bpe.encode_text(enc, text, 20_000).tolist() == enc.encode_ordinary(text)


def test_ids_of_any_text_come_back(spark):
    keys = ["a", "", None, "x>y", "b\r\nWARC-Type: c", "ü %41+ z", "a", "long" * 300]
    rows = [(k, f"http://h/{i}", "same" if i % 2 else "other", 5) for i, k in enumerate(keys)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string, bundle int")
    got = warc.archive(pages).collect()
    assert sorted(map(repr, (r["page_id"] for r in got))) == sorted(map(repr, keys))
    last = {text: max(k for k, _, t, _ in rows if t == text and k is not None) for text in ("same", "other")}
    want = sorted((repr(k), "response" if k == last[t] else "revisit", None if k == last[t] else last[t]) for k, _, t, _ in rows)
    assert sorted((repr(r["page_id"]), r["record_type"], r["refers_to"]) for r in got) == want
    assert warc.archive(pages.limit(0)).count() == 0


def test_walks_of_terms_of_any_length():
    rng = random.Random(8)
    stems = [b"a", b"ab", b"abc", b"q" * 23, b"q" * 24, b"q" * 25, b"q" * 60, "é".encode() * 14]
    terms = sorted({rng.choice(stems) + bytes(rng.choice(b"abz\xc3\xa9") for _ in range(rng.randint(0, 40))) for _ in range(400)} | set(stems))
    shared = [0] + [next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for a, b in zip(terms, terms[1:], strict=False)]
    assert source_tries._depths(terms).tolist() == shared
    n = len(terms)
    trie = source_tries.Trie(terms, np.arange(n), np.arange(n + 1), np.zeros(n, np.int64), np.arange(n))
    for width in (1, 2, 3, 30):
        parts = list(trie.cut(width))
        assert [p for p, _ in parts] == sorted({t[:width] for t in terms})
        back = [source_tries.Trie.unpack(part.pack()) for _, part in parts]
        assert [t for part in back for t in part.terms] == terms and [c for part in back for c in part.count.tolist()] == list(range(n))
