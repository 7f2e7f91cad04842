"""Corpus operators against brute force, SQL and round trips."""

import base64
import hashlib
import html
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tracelake.llm import common, components, mixing, mpeg_audio, secrets, simhash, warc, wrappers

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, sources=("src1", "src7", None)):
    rows = [(i, t, (None, "en", "de")[i % 3], sources[i % len(sources)], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def same(spark_df, sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toPandas().astype({"doc_id": "Int64"}))
    a, b = spark_df.toPandas(), con.execute(sql).df()
    c = sorted(a.columns)
    assert c == sorted(b.columns)
    key = lambda d: sorted(map(str, d[c].astype(object).where(d[c].notna(), None).values.tolist()))
    assert key(a) == key(b)


# media


def test_audio_round_trip_and_damage():
    rng = random.Random(1)
    for n in (1, 2, 5, 120):
        payload = bytes(rng.randrange(256) for _ in range(576)) * (n // 2) + b"\xff" * 576 * (n - n // 2)
        media = mpeg_audio.wrap(payload)
        track = mpeg_audio.parse(media)
        assert mpeg_audio.unwrap(media, track) == (payload, 0)
        assert len(track.offsets) == n == track.table_frames and track.samples == 576 * n and track.crc_bad == 0 and track.skipped == 0
        assert track.tags["TIT2"] == "payload" and track.table == "Xing" and track.table_bytes == sum(track.lengths) + 432
        assert [track.seek(i * 576) for i in range(n)] == track.offsets and track.seek(n * 576) is None
        # junk between frames costs no frame; the parser finds the next header
        cut = track.offsets[n // 2]
        broken = media[:cut] + b"\xff\xe0junk\xff" * 3 + media[cut:]
        again = mpeg_audio.parse(broken)
        assert mpeg_audio.unwrap(broken, again)[0] == payload and again.skipped == 21
        # a changed side information byte fails its checksum
        bad = bytearray(media)
        bad[cut + 8] ^= 1
        assert mpeg_audio.parse(bytes(bad)).crc_bad == 1
    assert mpeg_audio.parse(None).offsets == [] and mpeg_audio.parse(b"no audio").samples == 0
    tagged = mpeg_audio.parse(mpeg_audio.wrap(b"a" * 576) + b"TAG" + b"x" * 125)
    assert tagged.skipped == 0 and len(tagged.offsets) == 1


def test_audio_junk_that_looks_like_a_header():
    payload = bytes(range(256)) * 9 * 7
    payload = payload[: 576 * 7]
    media = mpeg_audio.wrap(payload)
    track = mpeg_audio.parse(media)
    rng = random.Random(14)
    for k in range(1, 7):
        for before in (0, 1, 60):
            junk = bytes(rng.randrange(255) for _ in range(before)) + bytes.fromhex("fff2d8c4") + bytes(rng.randrange(255) for _ in range(60))
            broken = media[: track.offsets[k]] + junk + media[track.offsets[k] :]
            again = mpeg_audio.parse(broken)
            assert mpeg_audio.unwrap(broken, again) == (payload, 0) and again.skipped == len(junk) and again.crc_bad == 0


def audio_frame(version, layer, index, hertz, mode, extension, rng, bad=False):
    """A protected frame with random contents; its checksum is made bit by bit."""
    second = 0xE0 | {"2.5": 0, "2": 2, "1": 3}[version] << 3 | (4 - layer) << 1
    head = bytes((0xFF, second, index << 4 | hertz << 2, mode << 6 | extension << 4))
    h = mpeg_audio.header(head)
    body = bytes(rng.randrange(255) for _ in range(h.length - 6))
    bits = "".join(f"{x:08b}" for x in body)
    if layer == 3:
        n = 8 * h.side
    else:
        bound = 4 + 4 * extension if mode == 1 else 32
        if layer == 1:
            sizes = [4] * 32
        elif version != "1":
            sizes = [4] * 4 + [3] * 7 + [2] * 19
        elif h.kbps / h.channels < 56:
            sizes = ([4] * 2 + [3] * 10)[: 12 if h.hertz == 32000 else 8]
        else:
            sizes = ([4] * 11 + [3] * 12 + [2] * 7)[: 30 if h.kbps / h.channels >= 96 and h.hertz != 48000 else 27]
        n = selected = 0
        for band, size in enumerate(sizes):
            for _ in range(h.channels if band < bound else 1):
                selected += (int(bits[n : n + size], 2) > 0) * (1 if band < bound else h.channels) * (layer == 2)
                n += size
        n += 2 * selected
    crc = 0xFFFF
    for bit in f"{head[2]:08b}{head[3]:08b}" + bits[:n]:
        crc = (crc << 1 & 0xFFFF) ^ (0x8005 if (crc >> 15) ^ int(bit) else 0)
    return head + ((crc ^ bad) & 0xFFFF).to_bytes(2, "big") + body


def test_audio_of_every_layer():
    rng = random.Random(15)
    for version, layer, index, hertz, mode, extension in (
        ("1", 1, 5, 0, 0, 0), ("1", 1, 5, 0, 3, 0), ("1", 1, 9, 2, 1, 2), ("1", 2, 10, 0, 0, 0), ("1", 2, 4, 1, 0, 0), ("1", 2, 3, 2, 3, 0), ("1", 2, 8, 1, 1, 1),
        ("2", 2, 8, 2, 0, 0), ("2", 1, 6, 1, 1, 3), ("1", 3, 9, 0, 1, 0), ("2", 3, 6, 0, 0, 0), ("2.5", 3, 5, 2, 3, 0), ("2.5", 2, 7, 0, 3, 0),
    ):
        frames = [audio_frame(version, layer, index, hertz, mode, extension, rng, bad=i == 3) for i in range(6)]
        tag = b"TAG" + b"song".ljust(30, b"\0") + b"who".ljust(30) + bytes(65)
        track = mpeg_audio.parse(b"".join(frames) + tag)
        assert (len(track.offsets), track.crc_ok, track.crc_bad, track.skipped) == (6, 5, 1, 0), (version, layer, mode)
        assert track.tags == {"TIT2": "song", "TPE1": "who"} and track.samples == 6 * track.headers[0].samples


def test_audio_vbri_table():
    rng = random.Random(16)
    frames = [audio_frame("1", 3, 9, 0, 0, 0, rng) for _ in range(4)]
    entries = b"".join(len(f).to_bytes(2, "big") for f in frames)
    table = b"VBRI" + bytes(6) + sum(map(len, frames)).to_bytes(4, "big") + (4).to_bytes(4, "big") + b"\0\4\0\1\0\2\0\1" + entries
    first = bytearray(frames[0])
    first[6:] = bytes(30) + table + bytes(len(frames[0]) - 36 - len(table))
    track = mpeg_audio.parse(bytes(first) + b"".join(frames))
    assert (track.table, track.table_frames, track.toc, len(track.offsets)) == ("VBRI", 4, entries, 4)


def test_audio_headers():
    h = mpeg_audio.header(bytes.fromhex("fffb9064"))
    assert (h.version, h.layer, h.kbps, h.hertz, h.channels, h.samples, h.length) == ("1", 3, 128, 44100, 2, 1152, 417)
    assert mpeg_audio.header(b"\xff\xfb\xf0\x64") is None and mpeg_audio.crc16(b"123456789") == 0xAEE7


def test_audio_features(spark):
    texts = ["", None, "é" * 300, "x" * 576, "x" * 576, "y" * 2000]
    rows = {r["doc_id"]: r for r in mpeg_audio.features(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        want = raw + b"\xff" * ((-len(raw)) % 576 or (0 if raw else 576))
        r = rows[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-32:]))
    assert rows[3].asDict() | {"doc_id": 4} == rows[4].asDict() and rows[0]["media_sha256"] == rows[1]["media_sha256"]
    d = documents(spark, texts).select(mpeg_audio.index(mpeg_audio.store(F.col("text"))).alias("i"))
    assert [r["i"]["frames"] for r in d.collect()] == [1, 1, 2, 1, 1, 4]


# archives


def test_archive(spark):
    html_ = ["<p>a", "<p>a", None, "", "é" * 1000, "<p>a", "b", None]
    rows = [(i, f"http://h/{i}\n", x) for i, x in enumerate(html_)] + [(None, None, "<p>a"), (6, "http://h/6", "b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.archive(pages).collect()
    assert len(got) == len(rows)
    last = {}
    for i, _, x in rows:
        if i is not None:
            last[x or ""] = max(i, last.get(x or "", -1))
    by = [(r["page_id"], r["payload_digest"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got]
    want = []
    for i, _, x in rows:
        raw = (x or "").encode()
        top = last.get(x or "")
        refers = None if i == top else top
        want.append((i, base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if refers is None else "revisit", refers, len(raw)))
    assert sorted(map(str, by)) == sorted(map(str, want))
    assert all(r["record_type"] == "response" for r in warc.archive(pages, min_bytes=5000).collect())
    assert warc.archive(pages.limit(0)).count() == 0


def test_bundles_are_seekable():
    w = warc.Writer(frame_bytes=300)
    raws = {f"urn:{i}": warc.record(f"urn:{i}", "http://x/", bytes([65 + i]) * (50 * i)) for i in range(9)}
    for k, v in raws.items():
        w.add(k, v)
    data = w.close()
    table = warc.seek_table(data)
    assert len(table) > 3
    for name, frame, offset, length in w.index:
        assert warc.read_frame(data, table[frame])[offset : offset + length] == raws[name]
    import io

    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert whole == b"".join(raws.values())
    fields, http, payload = warc.parse_record(raws["urn:3"])
    assert fields["warc-type"] == "response" and payload == b"D" * 150 and http["content-length"] == "150"
    with pytest.raises(ValueError):
        warc.seek_table(data[:-1])


# pages


def page(paragraphs, extra="", comments=True):
    body = "".join(f"<p>{html.escape(p)}</p>" for p in paragraphs)
    return (
        f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body class='has-sidebar'><nav><ul><li><a href='/a'>menu</a></li><li><a href='/b'>more</a></li></ul></nav><!-- ad --><div class='ad'>buy now</div>"
        f"<article><h1>{html.escape(paragraphs[0])}</h1>{body}{extra}</article>" + "<div id='comments-12'><p>a reader says so</p></div>" * comments + "<aside><p>related</p></aside><form><p>sign up</p></form><footer>&copy; host</footer></body></html>"
    )


def test_main_text_of_articles(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeéñ&<") for _ in range(rng.randint(1, 7)))
    rows, want = [], {}
    for i in range(40):
        paragraphs = [" ".join(word() for _ in range(rng.randint(3, 30))) for _ in range(rng.randint(1, 6))]
        extra = "<ul><li>one<b>b</b></li><li>two</li></ul>" if i % 4 == 0 else ""
        rows.append((i, f"http://h{i % 3}.example/x", page(paragraphs, extra, i % 2 == 0)))
        want[i] = " ".join(" ".join([paragraphs[0], *paragraphs, *(["oneb two"] if extra else [])]).split())
    rows += [(100, "http://h0.example/y", None), (101, None, "plain"), (102, "nonsense", "<article>x<p>y"), (102, "nonsense", "<article>x<p>y")]
    want |= {100: "", 101: "plain", 102: "x y"}
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = wrappers.main_text(pages).collect()
    assert len(got) == len(rows) and {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    inferred = {r["host"]: r["wrapper"] for r in wrappers.infer(pages).collect()}
    said = wrappers.expression(wrappers.load(inferred["h0.example"]))
    assert "(<p> (#text) </p>)+" in said and "(<ul> (<li> (#text) </li>)+ </ul>)?" in said
    assert wrappers.main_text(pages.limit(0)).count() == 0


def host_plan(pages):
    node = None
    for p in pages:
        other = wrappers.sealed(wrappers.tree(p))
        if node is None:
            node = other
        else:
            wrappers.align(node, wrappers.load(wrappers.dump(other)))
    return wrappers.plan_of(wrappers.dump(node))


def test_pages_without_article_elements():
    def old(text, n):
        return f"<html><body><div id=top><a href=/>home</a> <a href=/x>all</a></div><table><tr><td class=menu><a href=/1>one</a></td><td><div class=body><h2>Title {n}</h2>{''.join(f'<p>{t}</p>' for t in text)}</div></td></tr></table><div class=footer>contact</div><p>All rights reserved by host</p></body></html>"

    texts = [[f"Sentence number {i} of page {n} with some words." for i in range(4)] for n in range(5)]
    pages = [old(t, n) for n, t in enumerate(texts)]
    plan = host_plan(pages)
    for n, (p, t) in enumerate(zip(pages, texts, strict=True)):
        assert wrappers.extract(p, plan) == " ".join([f"Title {n}", *t])


def test_the_wrapper_tells_the_template_from_the_text():
    def recipe(n, lead, steps):
        return (
            "<body><div class=bar>Welcome to the kitchen of the host</div><div class=info><p>Open from nine to five</p></div>"
            f"<div class=post><h1>Dish {n}</h1><div class=lead>{lead}</div><h2>Ingredients</h2><ul><li>salt {n}</li><li>oil</li></ul><div class=box>We ship on Mondays</div>"
            f"<h2>Steps</h2><div class=text>{''.join(f'<p>{x}</p>' for x in steps)}</div></div><div class=end>Written by the host, all rights reserved</div></body>"
        )

    rng = random.Random(11)
    words = lambda k: " ".join(rng.choice(["stir", "wait", "boil", "cut", "serve", "mix"]) for _ in range(k))
    cases = [(n, words(30), [words(9) for _ in range(1 + n % 3)]) for n in range(6)]
    pages = [recipe(*c) for c in cases]
    plan = host_plan(pages)
    for page_, (n, lead, steps) in zip(pages, cases, strict=True):
        # nothing of the article is lost, its constant headings stay; what all pages of the host say is gone
        assert wrappers.extract(page_, plan) == " ".join([f"Dish {n}", lead, "Ingredients", f"salt {n}", "oil", "Steps", *steps])
        # one page alone can't tell
        assert "Welcome" in wrappers.extract(page_)
    assert host_plan(pages[::-1]) == plan


def random_page(rng, depth=3):
    """Tokens of a random tree, as text and as what the expression is written in."""
    parts, tokens = [], []
    for _ in range(rng.randint(0, 4)):
        kind = rng.choice(["div", "section", "ol", "#"] if depth else ["#"])
        if kind == "#":
            if tokens and tokens[-1] == "#":
                continue
            parts.append(rng.choice(["same", f"t{rng.random()}"]))
            tokens.append("#")
        else:
            inner, more = random_page(rng, depth - 1)
            parts.append(f"<{kind}>{inner}</{kind}>")
            tokens += [f"<{kind}>", *more, f"</{kind}>"]
    return "".join(parts), tokens


def test_expressions_accept_all_their_pages():
    rng = random.Random(12)
    for _ in range(150):
        pages = [random_page(rng) for _ in range(rng.randint(1, 6))]
        node = None
        for markup, _ in pages:
            other = wrappers.sealed(wrappers.tree(markup))
            if node is None:
                node = other
            else:
                wrappers.align(node, other)
        pattern = re.compile(wrappers.expression(node, text="#").replace(" ", ""))
        assert "|" not in pattern.pattern
        for _, tokens in pages:
            assert pattern.fullmatch("".join(tokens)), (pattern.pattern, "".join(tokens))


def test_alignment_against_brute_force():
    """Every pair of short streams: the items accept both; where one only adds to the other, they are the longer one."""
    import itertools

    streams = [s for n in range(5) for s in itertools.product("abc", repeat=n) if all(x != y for x, y in zip(s, s[1:]))]

    def accepts(items, stream):
        return re.fullmatch("".join(f"[{''.join(i)}]*" if len(i) > 1 else f"{i[0]}?" for i in items), "".join(stream)) is not None

    for a in streams:
        one = wrappers.grouped([(k,) for k in a])
        assert accepts(one, a) and len({k for i in one for k in i}) == sum(map(len, one))
        for b in streams:
            both = wrappers.aligned(one, wrappers.grouped([(k,) for k in b]))
            assert accepts(both, a) and accepts(both, b)
            if len(set(b)) == len(b) and any(list(x) == list(a) for n in range(len(b) + 1) for x in itertools.combinations(b, n)):
                assert both == [(k,) for k in b]


def test_hostile_pages_take_linear_time():
    import time

    for junk, n in (("<div>", 200_000), ("<div>x", 100_000), ("<svg ", 200_000), ("<a x=\"", 100_000), ("<p title=it's>", 50_000), ("<select>x", 50_000), ("<table><tr><td>x", 30_000)):
        start = time.process_time()
        text = wrappers.extract(junk * n)
        assert time.process_time() - start < 8
        if junk.endswith("x"):
            assert text == " ".join("x" * n)
    nested = "".join(f"<div><p>t{i}" for i in range(1500))
    assert wrappers.extract(nested) == " ".join(f"t{i}" for i in range(1500))
    assert "t5" in wrappers.expression(wrappers.tree(nested), text="t5")


def test_alignment_does_not_depend_on_order():
    pages = [page(["a b", "c"]), page(["x"], "<h2>s</h2><p>t</p><h2>u</h2>"), page(["q"] * 3, "<ul><li>1</li></ul>", False)]
    assert len({host_plan([pages[i] for i in order]) for order in ((0, 1, 2), (2, 1, 0), (1, 2, 0))}) == 1


# near duplicates


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_covering_masks_miss_nothing():
    rng = random.Random(4)
    for family in range(4):
        masks = [m & (2**64 - 1) for m in simhash.masks(4, family=family)]
        for _ in range(2000):
            flips = 0
            for b in rng.sample(range(64), rng.randint(0, 4)):
                flips |= 1 << b
            assert any(not flips & m for m in masks)


def test_near_duplicates_equal_all_pairs(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    texts = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            if rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    texts += ["", None, "É a b c d", "one", "one"]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(documents(spark, texts)).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    assert [int(got[i]["fingerprint"], 16) for i in range(len(texts))] == prints
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert [got[i]["component_id"] for i in range(len(texts))] == [root(i) for i in range(len(texts))]
    kept = simhash.representatives(documents(spark, texts))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({root(i) for i in range(len(texts))}) and kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    bare = documents(spark, texts).unionByName(spark.createDataFrame([(None, "one", "en", "s", 3), (None, "quite another thing here", "en", "s", 3)] * 2, SCHEMA))
    # "one" has ids elsewhere; the other text stays once
    assert simhash.representatives(bare).filter("doc_id is null").count() == 1
    assert simhash.representatives(bare, few=0).count() == simhash.representatives(bare).count()
    # rows that share an id and differ in text are documents of their own; repeated rows are one; any type of id will do
    words = [" ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(3)]
    shared = spark.createDataFrame([("b", words[0], 1), ("b", words[1], 2), ("a", words[2], 3), ("a", words[2], 3), ("c", words[2] + " end", 4)], "doc_id string, text string, _id long")
    assert sorted(map(tuple, simhash.representatives(shared).collect())) == sorted([("b", words[0], 1), ("b", words[1], 2), ("a", words[2], 3)])
    assert simhash.near_duplicates(documents(spark, texts).limit(0)).count() == 0


def test_large_buckets_are_dealt_anew(spark, monkeypatch):
    rng = random.Random(13)
    # fingerprints that agree under many masks without being near, and some that are
    base = [rng.getrandbits(64) for _ in range(6)]
    points = {b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 12))) for b in base for _ in range(40)}
    points |= {0, 1, 3, 7, 15, 31, 2**63, 2**64 - 1}
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    parent = {p: p for p in signed}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in signed:
        for b in signed:
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    want = {p: root(p) for p in signed}
    for large in (256, 2):
        monkeypatch.setattr(simhash, "LARGE", large)
        got = {r["fp"]: r["component"] for r in simhash.link(table, 4).collect()}
        assert all(got.get(p, p) == want[p] for p in signed) and set(got) <= set(signed)


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(None, 3)]
    got = {r["node"]: r["component"] for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for node, least in got.items():
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert least == min(seen)
    assert set(got) == set(near)


# mixing


def test_mixing_equals_sql(spark):
    rng = random.Random(7)
    texts = [" ".join("w" for _ in range(rng.randint(0, 40))) for _ in range(300)] + [None, ""]
    d = documents(spark, texts, ("src1", "src2", "src3", "src7", "src8", None, "other"))
    d = d.unionByName(d.limit(20))
    same(mixing.report(d), mixing.oracle(), documents=d)
    assert mixing.report(d.limit(0)).count() == 0
    assert mixing.mixed(d).columns == d.columns


def test_budgets_go_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 10), ("a", "x", "2", 1000), ("a", "y", "3", 5), ("b", "z", "4", 1000)], "domain string, lang string, source string, tokens long")
    got = {r["source"]: r["budget"] for r in mixing.budgets(leaves, 400, {}, 1).collect()}
    # a and b get 200 each; y holds 5 and x, its sibling, takes the 195; source 1 holds 10 and its sibling takes the rest
    assert got == {"1": 10, "2": 185, "3": 5, "4": 200}
    short = spark.createDataFrame([("a", "x", "1", 10), ("b", "z", "4", 1000)], "domain string, lang string, source string, tokens long")
    assert {r["source"]: r["budget"] for r in mixing.budgets(short, 400, {}, 1).collect()} == {"1": 10, "4": 390}
    assert {r["source"]: r["budget"] for r in mixing.budgets(short, 4000, {}, 2).collect()} == {"1": 20, "4": 2000}


# secrets


def test_secrets_beyond_a_base_span(spark):
    key, token = "wJalrXUtnFEMIK7MDENGbPxRfiCYzQ3kT9vB2hLs", "q8ZtR4mXc1Vb7NpK2sWd9LfG"
    hexes = "0123456789abcdef01234567"
    texts = [f"id AKIA{'B2C3D4E5' * 2}/{key} end", f"{hexes}-{token}", f"{token}-{hexes}-{key}"]
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(documents(spark, texts)).collect()}
    for text in clean.values():
        assert all(x not in text for x in (key, token, hexes, key[4:-4], token[4:-4]))
    assert clean[0].startswith("id ") and clean[0].endswith(" end")
    # beside what the allow list names, too; the named stretch itself stays
    joined = [f"docs/example/{token}", f"2024-01-01-{token}", f"550e8400-e29b-41d4-a716-446655440000_{token}", f"{token}-xxxxxxxxxxxxxxxx9", f"example{token}", "my-placeholder-token-2024-01-01-12345"]
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(documents(spark, joined)).collect()}
    assert all(token[4:-4] not in clean[i] for i in range(4)) and clean[4] == joined[4] and clean[5] == joined[5]
    assert "example" in clean[0] and "2024-01-01" in clean[1] and "550e8400-e29b-41d4-a716-446655440000" in clean[2] and "xxxxxxxx" in clean[3]
    same(secrets.report(documents(spark, [*texts, *joined])), secrets.oracle(), documents=documents(spark, [*texts, *joined]))


def test_secrets_equal_sql(spark):
    rng = random.Random(8)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    mixed = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(n))
    texts = [
        "", None, "nothing here", 'Password = "hunter22"', "api_key: abc", "APIKEY=abcdef", "tokEN = 'x'", f"é AKIA{'B' * 16} and AKIA{'C' * 15}", f"sum {hexes(40)} and {hexes(23)}",
        f"{mixed(40)} {mixed(30)}", f"token={hexes(40)} {mixed(44)}", "550e8400-e29b-41d4-a716-446655440000", "2024-01-02-03-04-05-06-07-08", "some-long-hyphenated-words-here-12", f"example{mixed(30)}",
        f"中文 {mixed(60)}中{hexes(64)}", "a" * 5000, "secretsecret=secret:password=abcdefgh", f"ſecret = {mixed(9)}", f"x{mixed(25)}", "\n".join(f"k{i} {mixed(21)}" for i in range(30)),
    ]
    d = documents(spark, texts)
    same(secrets.report(d), secrets.oracle(), documents=d)
    rows = {r["doc_id"]: r for r in secrets.report(d).collect()}
    assert rows[3]["n_assign"] == 1 and rows[4]["n_assign"] == 0 and rows[5]["n_assign"] == 1 and rows[7]["n_access"] == 1 and rows[8]["n_hex"] == 1
    assert rows[0]["base_sha256"] == hashlib.sha256(b"").hexdigest() and not rows[11]["spans"] and not rows[12]["spans"] and not rows[14]["spans"]
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(d).collect()}
    assert clean[3] == "[SECRET]\"" and clean[1] is None and clean[2] == texts[2] and "AKIABB" not in clean[7]
    assert secrets.scan(d.withColumn("secret_x", F.lit(1))).columns == [*d.columns, "secret_x", "secret_spans"]
    plan = secrets.report(d)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


# the pipeline


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(9)
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("an", "on", "ert", "is", "ul")]
    clean = [" ".join(rng.choice(words) for _ in range(rng.randint(60, 200))) for _ in range(90)]
    texts = [*clean, clean[0], clean[1] + " end", "too short", None, clean[2] + ' password = "hunter2222"']
    rows = [(i, t, "en", f"src{i % 9}", len(t or "")) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, SCHEMA)
    d.write.parquet(str(tmp_path / "documents.parquet"))
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen = {}
    docs = common.table(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, str(tmp_path)), "test")
        seen[name] = docs
        if name != names[-1]:
            assert docs.columns == d.columns
    quality = {r["doc_id"] for r in seen[names[0]].collect()}
    assert set(range(90)) <= quality and not quality & {92, 93}
    unique = {r["doc_id"] for r in seen[names[1]].collect()}
    near = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(seen[names[0]]).collect()}
    assert unique == set(near.values()) and 90 not in unique
    found = {r["doc_id"]: r for r in seen[names[2]].collect()}
    assert set(found) == unique
    if 94 in found:
        assert "hunter2222" not in found[94]["text"] and found[94]["n_chars"] == len(found[94]["text"])
    assert all(found[i]["text"] == texts[i] for i in unique if i < 90)
    mixed = seen[names[3]].count()
    assert seen[names[4]].count() == mixed and {r["doc_id"] for r in seen[names[3]].collect()} <= unique
    a = sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect()))
    assert a == sorted(map(str, seen[names[4]].collect()))


def test_pipeline_takes_odd_tables(spark, tmp_path):
    rng = random.Random(10)
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("an", "on", "ert", "is", "ul")]
    text = lambda: " ".join(rng.choice(words) for _ in range(70))
    same_ = text()
    secret = text() + " password=hunter2222"
    rows = [(1, same_, "en", "src1", 1, "a"), (1, same_, "en", "src1", 1, "a"), (1, text(), None, None, None, "b"), (None, text(), "en", "src2", 2, None), (None, text(), "en", "src2", 2, None)]
    rows += [(None, same_, "en", "src9", 3, "c"), (2, None, None, None, None, None), (3, "", "de", "src3", 0, "d"), (4, secret, "en", "src4", len(secret), "e"), (None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, secret_spans string, _whole int, quality string, row string, label string"
    docs = spark.createDataFrame([(*r[:5], "s", 1, "q", "r", r[5]) for r in rows], schema)
    for given in (docs, docs.limit(0)):
        now, path = given, str(tmp_path)
        for name, stage in corpus_pipeline.STAGES:
            before = now
            now = common.stored(stage(spark, now, path), "test")
            if name != corpus_pipeline.STAGES[-1][0]:
                assert now.columns == docs.columns
            if given is not docs:
                assert now.count() == 0
            elif name == "quality rules":
                # the base rules reject the short ones; repeated rows share their verdict
                assert now.filter("text is null or text = ''").count() == 0 and before.count() == 10 and now.count() == 7
            elif name == "SimHash near-dedup":
                got = [r["text"] for r in now.collect()]
                assert len(got) == len(set(got)) == 5 and sum(r["doc_id"] is None for r in now.collect()) == 2
            elif name == "secret scans":
                assert now.count() == before.count() and now.filter("text like '%hunter2222%'").count() == 0
                assert {r["n_chars"] for r in now.filter("doc_id = 4").collect()} == {len(secret) - len("password=hunter2222") + len("[SECRET]")}
