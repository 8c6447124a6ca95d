"""The training-data operators against brute force, exact round trips, labels and odd inputs."""

from __future__ import annotations

import base64
import collections
import gzip
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from lumenflow.llm import bpe, ctxmix, decontaminate, fmindex, htmltext, minmax, queries, secretscan, surrogates, warc, weaksupervision
from lumenflow.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
VOCABULARY = [f"w{i}" for i in range(400)]


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return "/root/testdata/sf0.001"


def corpus() -> list[tuple[int, str | None]]:
    """Nulls, empty and short texts, ties, copies, near copies, shared passages, a very long text."""
    rng = random.Random(7)
    prose = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n))
    passage, base = prose(30), prose(120)
    texts: list[str | None] = [None, "", " \n\t", "one", "One", "two words", "a b c d e f g h i j k l m", passage, "aa " * 60]
    for k in range(25):
        words = base.split()
        for _ in range(k % 6):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        texts.append(" ".join(words))
    texts += [base, base, base.upper()]
    texts += [f"{prose(40)}\n{passage}  {prose(15)}" for _ in range(8)]
    texts += [prose(rng.randrange(1, 90)) for _ in range(30)]
    texts.append(prose(20_000))
    return list(enumerate(texts))


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema).withColumn("n", F.lit("an extra column")).withColumn("id", F.lit(0))


def shingles(text: str | None) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_equal_brute_force(spark, percent):
    rows = corpus()
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r[0]: (r[1], r[2]) for r in minmax.near_duplicates(frame(spark, rows), percent=percent).collect()}
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(30, 40), (40, 35)], "a long, b long")
    got = {r["node"]: r["component"] for r in minmax.components(links).collect()}
    assert got == {**{i: 0 for i in range(21)}, 30: 30, 35: 30, 40: 30}


@pytest.mark.parametrize("hot", [fmindex.HOT, 0])
def test_repeated_windows_equal_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(fmindex, "HOT", hot)
    rows = corpus()
    words = {i: (t or "").encode().split() for i, t in rows}
    first: dict = {}
    for i, w in words.items():
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    want = {}
    for i, w in words.items():
        covered = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        want[i] = (len(w), len(covered), b" ".join(x for k, x in enumerate(w) if k not in covered).decode())
    got = {r[0]: tuple(r[1:]) for r in fmindex.remove_repeats(frame(spark, rows)).collect()}
    assert got == want


def test_a_hot_passage_between_different_words_stays_out_of_the_shards(spark, monkeypatch):
    search = fmindex._search_shard

    def distinct_only(table):
        words = [tuple(w) for w in table.column("words").to_pylist()]
        assert len(set(words)) == len(words)
        return search(table)

    monkeypatch.setattr(fmindex, "HOT", 5)
    monkeypatch.setattr(fmindex, "_search_shard", distinct_only)
    shared = " ".join(f"s{k}" for k in range(20))
    around = lambda i, side: " ".join(f"{side}{i}x{k}" for k in range(15))
    rows = [(i, f"{around(i, 'a')} {shared} {around(i, 'b')}") for i in range(40)]
    got = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in fmindex.remove_repeats(frame(spark, rows)).collect()}
    assert got == {i: (20, f"{around(i, 'a')} {around(i, 'b')}") if i else (0, text) for i, text in rows}


def test_matching_statistics_equal_brute_force():
    rng = random.Random(3)
    passages = [[rng.randrange(4) for _ in range(rng.randrange(1, 40))] for _ in range(12)]
    queries = [[rng.randrange(5) for _ in range(30)] for _ in range(6)]
    flat = lambda x: (np.array([v for p in x for v in p], np.uint64), np.concatenate([[0], np.cumsum([len(p) for p in x])]))
    index = fmindex.FMIndex(*flat(passages))
    words, bounds = flat(queries)
    got = {}
    for place, length, _ in index.statistics(words, bounds, 6):
        got |= dict(zip(place.tolist(), length.tolist()))
    known = {tuple(p[i : i + n]) for p in passages for n in range(1, 7) for i in range(len(p) - n + 1)}
    for q, start in zip(queries, bounds.tolist()):
        for i in range(len(q)):
            assert got[start + i] == max([n for n in range(1, 7) if i + n <= len(q) and tuple(q[i : i + n]) in known], default=0)


def test_quality_counts_equal_brute_force():
    rows = corpus() + [(900, "x\nx\n\nx \n#a $b"), (901, "é " * 12 + "ÿ<>|")]
    got = weaksupervision.counts(pa.array([t for _, t in rows]))
    for i, (_, text) in enumerate(rows):
        text = text or ""
        w = WORD.findall(text)
        windows = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(5)}
        seen, twice = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                twice += line in seen
                seen.add(line)
        want = (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), twice, len(covered))
        assert tuple(int(got[n][i]) for n in weaksupervision.COUNTS) == want


def test_quality_agrees_with_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, sf_dir).select("doc_id", F.lit(True).alias("kept"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").join(docs.select("doc_id"), "doc_id").join(kept, "doc_id", "left")
    by = {r["quality"]: (r["n"], r["k"]) for r in labels.groupBy("quality").agg(F.count("*").alias("n"), F.count("kept").alias("k")).collect()}
    assert by[1][1] >= 0.97 * by[1][0] and by[0][1] <= 0.3 * by[0][0]


def test_quality_of_nothing(spark):
    nothing = frame(spark, [])
    assert weaksupervision.with_posterior(weaksupervision.with_votes(nothing)).count() == 0


def test_bpe_equals_tiktoken_and_decodes(spark):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    odd = ["a" * 3000, " \n \x1c\x85\xa0 ", "\U0003e076滿", "naïve café's ١٢٣ ½ 日本語", "ab" * 500 + "!" * 300]
    odd += ["".join(chr(rng.choice([rng.randrange(1, 400), rng.randrange(0xE000, 0x10FFFF)])) for _ in range(40)) for _ in range(200)]
    rows = corpus() + list(enumerate(odd, 1000))
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    both = bpe.decode(bpe.encode(frame(spark, rows), vocabulary, decoded="same"), vocabulary).collect()
    for r in both:
        assert np.frombuffer(r["ids"], "<u4").tolist() == other.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == bytes(r["same"]) == (r["text"] or "").encode()


def test_warc_revisits(spark):
    pages = [(1, "u1", "x"), (2, "u2", "x"), (3, None, None), (4, "u\r\n4", ""), (5, "u5", "WARC/1.0\r\n\r\n\r\n"), (6, "u6", "é" * 70000), (7, "u7", "x"), (7, "u7", "x")]
    raw, slim = scratch_path(spark, "t-raw"), scratch_path(spark, "t-slim")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), raw, "page_id", "html", "url", per_archive=3)
    full = {(r["source_id"], bytes(r["payload"])) for r in warc.read_archives(spark, raw).collect()}
    assert full == {(str(i), (h or "").encode()) for i, _, h in pages}
    warc.write_deduplicated(spark, raw, slim)
    rows = warc.read_archives(spark, slim).collect()
    assert sorted((r["source_id"], r["record_type"], r["refers_to_source"]) for r in rows) == sorted(
        [("1", "revisit", "7"), ("2", "revisit", "7"), ("3", "revisit", "4"), ("4", "response", None), ("5", "response", None), ("6", "response", None), ("7", "response", None), ("7", "revisit", "7")],
        key=lambda x: (x[0], x[1], x[2] or ""),
    )
    for r in rows:
        payload = next((h or "").encode() for i, _, h in pages if str(i) == r["source_id"])
        assert r["payload_bytes"] == len(payload) and r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_secrets_in_nested_layers():
    inner = "password=hunter2secret"
    b64 = base64.b64encode(inner.encode()).decode()
    packed = base64.b64encode(gzip.compress(base64.b64encode(inner.encode()))).decode()
    cases = {
        "plain": (f"x {inner} y", (2, 2 + len(inner))),
        "url": ("x password%3Dhunter2secret", (2, 26)),
        "double url": ("x password%253Dhunter2secret", (2, 28)),
        "unicode": ("x \\u0070assword=hunter2secret", (2, 29)),
        "base64": (f"é {b64} y", (2, 2 + len(b64.rstrip("=")))),
        "packed": (f"x {packed} y", (2, 2 + len(packed))),
    }
    for name, (text, span) in cases.items():
        assert ("assign", *span) in [s[:3] for s in secretscan.scan(text)[0]], name
    assert secretscan.scan("token = abc, AKIASHORT, deadbeef") == ([], 0)
    assert secretscan.scan("%25" * 2000)[1] == 0


@pytest.mark.parametrize("text", ['x {\\u0022password\\u0022: \\u0022hunter22\\u0022}', "x password%3A hunter22", "x api_key&#61; abcdef1", "x\nto%6Ben =  abcdef1\ny"])
def test_secrets_with_spaces_next_to_escapes(text):
    assert [s[0] for s in secretscan.scan(text)[0]] == ["assign"]


def test_secrets_in_any_decoded_bytes():
    inner = b"password=hunter2secret"
    b64 = lambda raw: base64.b64encode(raw).decode()
    wrap = lambda text, width, end="\n": end.join(text[i : i + width] for i in range(0, len(text), width))
    noise = random.Random(4).randbytes(300)
    for raw in (b"\0 " + inner, b"\x1b[0m " + inner, b"\xef\xbb\xbf" + inner, b"\xe9 " + inner, inner.decode().encode("utf-16-le"), inner.decode().encode("utf-16"), b"." + inner.decode().encode("utf-16-be")):
        for packed in (raw, gzip.compress(raw), gzip.compress(b"first") + gzip.compress(raw)):
            assert "assign" in [s[0] for s in secretscan.scan(f"x {b64(packed)} y")[0]], packed
    text = wrap(b64(b"some text before it, so that it lies at the end: " + inner), 76)
    for given in (text, text.replace("\n", "\r\n"), f"data\n{text}\nend\n", f"key: {text}\n"):
        start, end = next(s[1:3] for s in secretscan.scan(given)[0] if s[0] == "assign")
        assert "\n" in given[start:end] and given[end - 1] == text.rstrip("=")[-1]
    for make in (gzip.compress, zlib.compress):
        packed = wrap(b64(make(noise + inner + noise)), 64)
        found, stopped = secretscan.scan(f"MIME:\n\n{packed}\n")
        assert "assign" in [s[0] for s in found] and stopped == 0
    cut = b64(gzip.compress(noise + inner + noise)[:200])
    assert secretscan.scan(f"x {cut} y")[1] == 1


@pytest.mark.parametrize(
    "text, span",
    [
        ("x password%" + "25" * 40_000 + "3Dhunter22 y", (2, 80_021)),
        ("x password\\" + "u005c" * 20_000 + "u003dhunter22 y", (2, 100_024)),
        ("x password&" + "#38;" * 20_000 + "#61;hunter22 y", (2, 80_023)),
        ("é " * 300_000 + "y%20" * 200_000 + "%C3%A9 password%3Dhunter22", (1_400_007, 1_400_026)),
    ],
)
def test_secrets_behind_deep_nesting_and_in_long_lines(text, span):
    begun = time.process_time()
    found, stopped = secretscan.scan(text)
    assert ("assign", *span) in [s[:3] for s in found] and stopped == 0
    assert time.process_time() - begun < 20


def test_spans_cover_what_was_encoded():
    """Random nesting of encodings around a secret: the span is where the encoded secret lies."""
    rng = random.Random(11)
    url = lambda t: "".join(f"%{b:02X}" for b in t.encode())
    some = lambda t: "".join(url(c) if rng.random() < 0.4 else c for c in t.replace("%", "%25"))
    unicode = lambda t: "".join(f"\\u{ord(c):04x}" for c in t)
    b64 = lambda t: base64.b64encode(t.encode()).decode()
    packed = lambda t: base64.b64encode(zlib.compress(t.encode())).decode()
    for _ in range(60):
        text = "password=hunter2secret"
        for _ in range(rng.randrange(1, 4)):
            text = rng.choice([url, some, unicode, b64, packed])(text)
        before, after = "é x " * rng.randrange(4), " y z%41" * rng.randrange(3)
        found, _ = secretscan.scan(f"{before}{text}{after}")
        spans = [s[1:3] for s in found if s[0] == "assign"]
        end = len(before) + len(text)  # the padding of base64, however it is encoded, is no part of the run
        assert any(len(before) <= a <= len(before) + 3 and end - 80 <= b <= end for a, b in spans), text


def test_secret_query_on_odd_tables(spark):
    rows = [(1, None), (2, ""), (3, "token: " + "a1" * 400_000), (None, "api_key = abcdef1 " + "0a" * 12), (3, "x")]
    path = scratch_path(spark, "t-secrets")
    spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, spans string, stopped int").write.parquet(f"{path}/documents.parquet")
    got = collections.Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"], r["spans"]) for r in queries.op2_secret_scan(spark, path).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    long, two = "assign:0:800007,hex:7:800007", "assign:0:17,hex:18:42"
    assert got == collections.Counter([(1, 0, 0, 0, sha(""), ""), (2, 0, 0, 0, sha(""), ""), (3, 1, 0, 1, sha(long), long), (None, 1, 0, 1, sha(two), two), (3, 0, 0, 0, sha(""), "")])
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{path}/none/documents.parquet")
    assert queries.op2_secret_scan(spark, f"{path}/none").collect() == []


def test_secret_columns(spark):
    rows = [(1, None), (2, ""), (3, "token: AKIA" + "A" * 16 + " " + "0a" * 12), (3, "token: AKIA" + "A" * 16 + " " + "0a" * 12)]
    got = sorted((r["doc_id"], [tuple(s)[:3] for s in r["spans"]]) for r in secretscan.scan_texts(frame(spark, rows)).collect())
    found = [("assign", 0, 27), ("access", 7, 27), ("hex", 28, 52)]
    assert got == [(1, []), (2, []), (3, found), (3, found)]


def test_main_text():
    page = """<html><head><title>T</title><script>var a="</p>";</script></head><body><div class="cookie-notice">We use cookies</div>
    <header>Site</header><nav><ul><li>Home</ul></nav><article><h1>A  title</h1><p><b>One &amp; two.<br><p>Three</p><div class="ad">Buy</div>
    <aside>Side</aside><form><p>Mail me</form></article><section id="comments"><p>I think that this is a long comment</section><footer>End</footer>"""
    assert htmltext.main_text(page) == "A title One & two. Three"
    assert htmltext.main_text("<body><div><p>Only a text here, long enough</p><p>and more</div>") == "Only a text here, long enough and more"
    assert htmltext.main_text("plain") == "plain" and htmltext.main_text("<article><p>cut off <b") in ("cut off", "cut off <b")
    assert htmltext.main_text("<nav>only a menu</nav>") == ""


@pytest.mark.parametrize("body", ["<body>", "", "<body class=x>"])
def test_main_text_after_an_open_head(body):
    page = f"<html><head><title>T</title><meta charset=utf-8><script>1</script><noscript><img src=x></noscript>{body}<article><p>One</p><p>Two</article>"
    assert htmltext.main_text(page) == "One Two"
    assert htmltext.main_text(f"<head><title>T</title>{body}<p>Only a text</p>") == "Only a text"
    assert htmltext.main_text(f"<head><title>T</title>\n{body}Only a text") == "Only a text"


@pytest.mark.parametrize("sizes", [(9, 9, 9), (60, 9, 20), (9, 200, 9)])
def test_main_text_without_article_or_main(sizes):
    texts = [" ".join([f"word{i}"] * n) for i, n in enumerate(sizes)]
    menu = "<div><a>Home</a> <a>Shop</a></div><div><a>A</a> <a>B</a></div><div><a>C</a> <a>D</a></div><div><a>E</a> <a>F</a></div>"
    divs = "".join(f"<div>{text}</div>" for text in texts)
    assert htmltext.main_text(f"<body>{menu}<div id=content>{divs}</div>{menu}") == " ".join(texts)
    sections = "".join(f"<section><h2>Part</h2><p>{text}</p></section>" for text in texts)
    assert htmltext.main_text(f"<body>{menu}<div id=content>{sections}</div>{menu}") == " ".join(f"Part {text}" for text in texts)
    assert htmltext.main_text(f"<body>{sections}") == " ".join(f"Part {text}" for text in texts)


STORY = "<article><h1>Title</h1><p>One long enough paragraph of the story</p><p>and two</p></article>"
TOLD = "Title One long enough paragraph of the story and two"


@pytest.mark.parametrize(
    "around",
    [f'<div class="{c}">{{}}</div>' for c in ("container no-sidebar", "site has-sidebar", "wrapper header-fixed", "page menu-closed", "sidebar", "main-content ad", "comments")]
    + ['<form method="post" id="aspnetForm">{}</form>', '<div role="dialog">{}</div>'],
)
def test_main_text_in_wrappers_named_like_boilerplate(around):
    side = '<div class="sidebar">A side</div><div class="google-ads">Buy this</div><div id="left-nav"><a>Home</a></div>'
    assert htmltext.main_text(f"<body>{side}{around.format(STORY + side)}{side}") == TOLD
    plain = "<div><p>A paragraph that is long enough to be read</p><p>And another one of the same page, longer still</p></div>"
    if "comments" not in around:
        assert htmltext.main_text(f"<body>{around.format(plain)}") == "A paragraph that is long enough to be read And another one of the same page, longer still"


@pytest.mark.parametrize("mark", ['class="no-comment"', 'class="share-price"', 'id="cookie-recipe"', 'class="with-ads"', 'id="notice-period"'])
def test_main_text_keeps_what_only_mentions_a_name(mark):
    assert htmltext.main_text(f"<article><p>Some text first, of a length</p><p {mark}>A marked paragraph</p></article>") == "Some text first, of a length A marked paragraph"


@pytest.mark.parametrize("mark", ['class="ad"', 'class="ad-slot"', 'class="google-ads"', 'id="cookie-notice"', 'class="newsletter-signup"', 'class="relatedPosts"', 'class="comments-list"', 'class="x site-footer y"'])
def test_main_text_drops_named_parts(mark):
    assert htmltext.main_text(f"<article><p>Some text first, of a length</p><div {mark}>Not of the story</div></article>") == "Some text first, of a length"


@pytest.mark.parametrize("comment", ['<article class="comment">{}</article>', '<section id="comments"><article>{}</article></section>', '<div class="comments-list"><article><p>{}</article></div>'])
def test_main_text_is_the_story_not_a_longer_comment(comment):
    long = "I have a lot to say about this and I say it at length. " * 30
    page = f"<body>{STORY}{comment.format(long)}"
    assert htmltext.main_text(page) == TOLD
    assert htmltext.main_text(f"<body><article><h1>Short</h1><p>News.</p>{comment.format(long)}</article>") == "Short News."


@pytest.mark.parametrize("broken", ["<a " * 60_000, "<div>" * 100_000 + "x", "<b><article>" + "<div>" * 20_000 + "</b>" * 20_000, '<a b="' * 30_000 + ">", "<div>" * 40_000 + "</x>" * 40_000, "<!--" * 50_000, '<a href="x' * 30_000, "<" * 100_000])
def test_main_text_of_broken_markup_takes_linear_time(broken):
    begun = time.process_time()
    assert htmltext.main_text(f"<body>{STORY}{broken}").startswith(TOLD)
    assert time.process_time() - begun < 20


def test_main_text_columns(spark):
    rows = [(1, "u", STORY), (1, "u", STORY), (2, None, None), (3, "u", ""), (None, "u", "<p>only this"), (4, "u", "<article><p>" + "long " * 400_000)]
    path = scratch_path(spark, "t-pages")
    spark.createDataFrame([(*r, 0, "x") for r in rows], "page_id long, url string, html string, n_chars int, text string").write.parquet(f"{path}/pages.parquet")
    got = collections.Counter(tuple(r) for r in queries.op9_html_main_text(spark, path).collect())
    text = {STORY: TOLD, None: "", "": "", "<p>only this": "only this"}
    assert got == collections.Counter((i, u, t := text.get(h, ("long " * 400_000).strip()), len(t)) for i, u, h in rows)
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{path}/none/pages.parquet")
    assert queries.op9_html_main_text(spark, f"{path}/none").collect() == []


def test_leaks(spark):
    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    items = [(1, prose(35)), (2, prose(20)), (3, None), (4, "tiny"), (5, prose(60))]
    typo = items[0][1].replace("a", "ä", 4).upper()
    rows = [(1, f"{prose(50)} {items[0][1]} {prose(9)}"), (2, f"{prose(400)}\n{typo}!"), (3, prose(600)), (4, None), (5, ""), (6, "tiny"), (7, items[4][1][60:280]), (8, prose(20_000) + items[1][1])]
    docs, benchmark = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: [m["item_id"] for m in r["leaks"]] for r in decontaminate.matches(docs, benchmark).collect()}
    assert got == {1: [1], 2: [1], 3: [], 4: [], 5: [], 6: [], 7: [5], 8: [2]}
    assert all(r["leaks"] == [] for r in decontaminate.matches(docs, benchmark.where("false")).collect())


def _within(pattern: bytes, text: bytes) -> int:
    """Least edits between ``pattern`` and any part of ``text``."""
    b = np.frombuffer(text, np.uint8)
    row = np.zeros(len(b) + 1, np.int64)
    slope = np.arange(len(b) + 1)
    for i, c in enumerate(pattern, 1):
        new = np.append(i, np.minimum(row[:-1] + (b != c), row[1:] + 1))
        row = np.minimum.accumulate(new - slope) + slope
    return int(row.min())


def test_leaks_equal_a_search_of_all_stretches():
    rng = random.Random(12)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    items = [prose(n) for n in (72, 95, 150, 40)]
    texts = []
    for _ in range(120):
        item = rng.choice(items)
        a = rng.randrange(0, max(1, len(item) - 60))
        part = list(item[a : a + rng.randrange(60, 110)])
        for _ in range(rng.randrange(0, 12)):
            at = rng.randrange(len(part))
            part[at : at + 1] = rng.choice([[], [rng.choice("abcdefgh")], [part[at], rng.choice("abcdefgh")]])
        texts.append(prose(rng.randrange(80)) + "".join(part) + prose(rng.randrange(80)))
    index = decontaminate.Items(list(range(len(items))), items)
    data, offsets, _ = decontaminate.normalise(*decontaminate.t.buffer(pa.array(texts)))
    got = [sorted(m["item_id"] for m in row) for row in decontaminate.search_block(index, pa.array(texts)).to_pylist()]
    for row, found in enumerate(got):
        text = data[offsets[row] : offsets[row + 1]].tobytes()
        want = [i for i, item in enumerate(index.texts) if any(_within(item[s : s + m].tobytes(), text) <= decontaminate.edit_budget(m) for s, m in index.segments[i])]
        assert found == want
    assert 20 < sum(map(bool, got)) < 115


def test_part_copies_are_found_wherever_they_lie():
    rng = random.Random(13)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    item = prose(45)
    index = decontaminate.Items([1], [item])
    size = decontaminate.SEGMENT + decontaminate.STRIDE - 1
    texts = [f"{prose(30)} {item[o : o + size]} {prose(30)}" for o in range(len(item) - size + 1)]
    assert all(row for row in decontaminate.search_block(index, pa.array(texts)).to_pylist())
    typos = [t[:140] + t[140:].replace("e", "é", 2) for t in texts]
    assert sum(map(bool, decontaminate.search_block(index, pa.array(typos)).to_pylist())) >= 0.97 * len(typos)
    clean = [prose(120) for _ in range(200)] + [f"{prose(20)} {item[:40]} {prose(20)} {item[-40:]}"]
    assert not any(decontaminate.search_block(index, pa.array(clean)).to_pylist())


def test_leaks_of_low_complexity():
    items = ["0 " * 200, "ab" * 100]
    got = decontaminate.search_block(decontaminate.Items([1, 2], items), pa.array(["0 " * 50_000, "ab" * 50_000, "0 1 " * 5_000, "", None])).to_pylist()
    assert [[m["item_id"] for m in row] for row in got] == [[1], [2], [], [], []]


def test_leak_queries_on_odd_tables(spark, monkeypatch):
    long = "the quick brown fox jumps over the lazy dog and runs far away from all of the other animals in the wood"
    rows = [(1, long), (1, long), (2, None), (3, ""), (None, f"x {long.upper()}!"), (4, "word " * 300_000 + long), (5, "clean text")]
    path = scratch_path(spark, "t-leaks")
    spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, leaks int, item_id string").write.parquet(f"{path}/documents.parquet")
    items = [(7, long), (8, long), (9, None), (None, long), (10, "short")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    for most in (decontaminate.BLOCK_BYTES, 60):  # one block and several
        real = decontaminate.benchmark_blocks
        monkeypatch.setattr(decontaminate, "benchmark_blocks", lambda b, most=most, real=real: real(b, most=most))
        got = sorted(((r["doc_id"], r["contaminated"], sorted(filter(None, r["item_ids"].split(",")))) for r in queries.op5_benchmark_decontamination(spark, path).collect()), key=str)
        monkeypatch.undo()
        assert got == sorted([(1, True, ["7", "8"]), (1, True, ["7", "8"]), (2, False, []), (3, False, []), (None, True, ["7", "8"]), (4, True, ["7", "8"]), (5, False, [])], key=str)
    for table in ("documents", "benchmark"):
        empty = scratch_path(spark, "t-none")
        for name, schema in (("documents", "doc_id long, text string"), ("benchmark", "item_id long, text string")):
            spark.createDataFrame([] if name == table else [(1, long)], schema).write.parquet(f"{empty}/{name}.parquet")
        assert [r["contaminated"] for r in queries.op5_benchmark_decontamination(spark, empty).collect()] == ([] if table == "documents" else [False])


def test_banded_alignment_equals_full_table():
    rng = random.Random(1)
    for _ in range(30):
        pattern = np.array([rng.randrange(3) + 97 for _ in range(20)], np.uint8)
        region = np.array([rng.randrange(3) + 97 for _ in range(20 + 20)], np.uint8)
        row = [0] * 41
        for i, p in enumerate(pattern.tolist(), 1):
            new = [i]
            for j, c in enumerate(region.tolist(), 1):
                new.append(min(row[j - 1] + (p != c), row[j] + 1, new[-1] + 1))
            row = new
        assert decontaminate.align([pattern], [region])[0] >= min(row)
    assert decontaminate.align([pattern], [np.concatenate([np.zeros(5, np.uint8), pattern, np.zeros(15, np.uint8)])])[0] == 0


def test_surrogates(spark):
    text = "Mrs Jane Doe <Jane.Doe@Mail7.example.com>, 10.1.2.3, +1 (826) 555-4081 190.137.223.204, card 4111 1111 1111 1111. Frau Jane Doe; jane.doe@mail7.example.com"
    rows = [(1, text), (2, "jane.doe@mail7.example.com"), (3, None), (4, ""), (5, "clean 1.5 and 2026-01-02"), (1, text), (6, "bob@mail7.example.com")]
    got = surrogates.replace(frame(spark, rows), b"k").collect()
    by = {r["doc_id"]: r["text"] for r in got}
    assert len(got) == 7 and by[3] is None and by[4] == "" and by[5] == rows[4][1]
    for secret in ("Jane", "Doe", "10.1.2.3", "555-4081", "190.137", "4111 1111", "mail7"):
        assert secret.lower() not in by[1].lower()
    mail = by[2]
    assert by[1].endswith(mail) and by[1].lower().count(mail.lower()) == 2 and by[6] != mail and by[6].split("@")[1] == mail.split("@")[1]
    card = re.search(r"card (4\d{3} \d{4} \d{4} \d{4})\.", by[1]).group(1)
    assert surrogates._luhn(card.replace(" ", ""))


@pytest.mark.parametrize(
    "text, mentions",
    [
        ("Mrs Jane Doe met us. Jane Doe left. Doe said no.", ["Jane Doe", "Jane Doe", "Doe"]),
        ("Doe's car. Then Mr. John Doe's dog; Frau Jane Doe and Doe, then John.", ["Doe", "John Doe", "Jane Doe", "Doe", "John"]),
        ("г-жа Анна Петрова и Петрова", ["Анна Петрова", "Петрова"]),
        ("Herr Li saw Li and li", ["Li"]),
        ("Mr Green drinks Greentea in Greenland, GREEN", ["Green"]),
    ],
)
def test_mentions_of_titled_names(text, mentions):
    found = [e for e in surrogates.find(text) if e[0] == "name"]
    assert [text[e[2] : e[3]] for e in found] == mentions
    assert all(a[3] <= b[2] for a, b in zip(found, found[1:]))


def test_mentions_get_the_same_surrogate(spark):
    rows = [(1, "Mrs Jane Doe met us. Jane Doe left. Doe said no."), (2, "Dear Jane Doe, Mrs Jane Doe"), (None, None), (3, "Doe alone is no name here")]
    by = {r["doc_id"]: r["text"] for r in surrogates.replace(frame(spark, rows), b"k").collect()}
    first, last = re.match(r"Mrs (\w+) (\w+) met us", by[1]).groups()
    assert by[1] == f"Mrs {first} {last} met us. {first} {last} left. {last} said no." and by[2] == f"Dear {first} {last}, Mrs {first} {last}"
    assert "Doe" not in by[1] and by[3] == rows[3][1] and by[None] is None


def test_surrogates_stay_distinct_when_entities_outnumber_their_form(spark):
    # 26 letters of one class and 300 addresses of one letter; short names of one word
    letters = [chr(c) for c in [*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x180), *range(0x3B1, 0x3CA), *range(0x430, 0x4B0)] if chr(c).isalpha() and chr(c).lower() == chr(c)]
    mails = [f"{c}@mail.example.com" for c in dict.fromkeys(letters)]
    assert len(mails) > 150
    entities = spark.createDataFrame([("email", m, "") for m in mails], "kind string, canonical string, form string")
    made = {r["canonical"]: r["surrogate"] for r in surrogates.settle(entities, b"k").collect()}
    assert set(made) == set(mails) and len(set(made.values())) == len(mails) and not set(made.values()) & set(mails)


def test_replaced_entities_against_brute_force(spark):
    """One entity has one surrogate all over, two have two, none is a real one, and no text keeps an entity."""
    rng = random.Random(6)
    people = [f"{rng.choice('Ann Bob Eve Tom Ida'.split())} {rng.choice('Stone Field Marsh Wood'.split())}" for _ in range(12)]
    mails = [f"{rng.choice('abc')}{rng.randrange(4)}@{rng.choice('xyz')}.org" for _ in range(25)]
    numbers = [f"+49 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}" for _ in range(25)] + [f"10.{rng.randrange(9)}.0.{rng.randrange(9)}" for _ in range(25)]
    rows = [(i, f"{rng.choice(['Mr', 'Mrs'])} {rng.choice(people)}, {rng.choice(mails)}; {rng.choice(numbers)} and {rng.choice(mails).upper()} end") for i in range(150)]
    path = scratch_path(spark, "t-pii")
    spark.createDataFrame([(*r, 0) for r in [*rows, (None, None), (900, ""), (900, "no data")]], "doc_id long, text string, entities int").write.parquet(f"{path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op7_pii_surrogates(spark, path).where("doc_id < 900").collect()}
    pairs: dict = {}
    for i, text in rows:
        old = surrogates.find(text)
        spans = [tuple(x.split(":")) for x in got[i]["replaced"].split(",")]
        assert len(old) == len(spans) == got[i]["n_replaced"] and [e[0] for e in old] == [k for k, *_ in spans]
        for e, (kind, a, b) in zip(old, spans):
            new = got[i]["text"][int(a) : int(b)]
            same = re.sub(r"\D", "", new) if kind == "phone" else new.lower()
            pairs.setdefault((kind, e[1]), set()).add(same)
    assert all(len(v) == 1 for v in pairs.values())
    made = [(k[0], *v) for k, v in pairs.items()]
    assert len(set(made)) == len(made) and not {m[1] for m in made} & {k[1] for k in pairs}


def test_surrogate_collisions_are_settled(spark):
    # two digits, the first kept: nine surrogates at most, four of which are entities
    own = {f"1{d}" for d in "0123"}
    entities = spark.createDataFrame([("card", c, "") for c in sorted(own)], "kind string, canonical string, form string")
    settled = surrogates.settle(entities, b"k").collect()
    assert {r["canonical"] for r in settled} == own and any(r["attempt"] for r in settled)
    made = [r["surrogate"] for r in settled]
    assert len(set(made)) == len(made) and not set(made) & own


def test_context_mixing(spark, tmp_path):
    rows = corpus()
    path = str(tmp_path / "documents.parquet")
    frame(spark, rows).write.parquet(path)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    words = {i: [*WORD.findall((t or "").translate(LOWER)), None] for i, t in rows}
    counts = collections.Counter(w for i, ws in words.items() if not held(i) for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in ctxmix.score(spark.read.parquet(path), "crc32(cast(doc_id AS string)) % 7 != 2").collect()}
    for i, ws in words.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), len(ws), sum(counts[w] > 0 for w in ws), total)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws), rel_tol=1e-9)
    long = [r for i, r in got.items() if held(i) and len(words[i]) > 30]
    assert all(r["bits_per_byte"] < 4 for r in long)  # below the 8 of even bytes


def test_mixing_weights_learn_from_every_window(spark):
    rng = np.random.default_rng(5)
    rows = [(i, bytes(rng.integers(33, 127, 2_000).astype(np.uint8)).decode()) for i in range(170)]
    _, mixer = ctxmix.train(frame(spark, rows))
    assert mixer.seen.sum() == ctxmix.ROUNDS * 8 * 170 * 2_001


def test_blocks_of_scoring_are_bounded_by_bytes_not_by_splits(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    rows = [(i % 50, " ".join(rng.choice([f"w{k}" for k in range(400)]) for _ in range(300))) for i in range(400)]
    path = str(tmp_path / "documents.parquet")
    frame(spark, rows).coalesce(1).write.parquet(path)  # one split
    told = lambda r: (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
    got, held = [], []
    for most, batch in ((ctxmix.BLOCK_BYTES, 10_000), (40_000, 100)):
        monkeypatch.setattr(ctxmix, "BLOCK_BYTES", most)
        monkeypatch.setattr(ctxmix, "BLOCK_ROWS", batch)
        monkeypatch.setattr(ctxmix, "_token_rows", lambda docs, f=ctxmix._token_rows: held.append(docs) or f(docs))
        got.append(sorted(told(r) for r in ctxmix.score(spark.read.parquet(path), "doc_id % 7 != 2").collect()))
    assert got[0] == got[1] and len(got[0]) == 400
    blocks = [d.groupBy("block").agg(F.sum(F.octet_length("text")).alias("bytes")).collect() for d in (held[0], held[-1])]
    assert len(blocks[0]) == 1 and max(r["bytes"] for r in blocks[1]) < 120_000
    loose = ctxmix.score(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id % 7 != 2")  # rows of no file
    assert sorted(map(told, loose.collect())) == got[0]


def test_scoring_sends_small_batches_and_leaves_the_session_as_it_was(spark, monkeypatch):
    key, rows = "spark.sql.execution.arrow.maxBytesPerBatch", [(i, "some words " * 300) for i in range(200)]
    monkeypatch.setattr(ctxmix, "BATCH_BYTES", 50_000)
    sent = spark.sparkContext.accumulator(0)
    distinct_windows = ctxmix.windows

    def windows(data, offsets):
        sent.add(len(offsets) - 1 > 40)
        return distinct_windows(data, offsets)

    monkeypatch.setattr(ctxmix, "windows", windows)
    assert ctxmix.score(frame(spark, rows).coalesce(1), "doc_id % 7 != 2").count() == 200
    assert spark.conf.get(key, None) is None
    with ctxmix.small_batches(spark):
        assert ctxmix.window_counts(frame(spark, rows).coalesce(1).select("text")).count() > 0
        before = sent.value  # scoring takes a block's texts together, counting sees batches
        ctxmix.window_counts(frame(spark, rows).coalesce(1).select("text")).collect()
        assert sent.value == before
    spark.conf.set(key, "1000000")
    try:
        with ctxmix.small_batches(spark):
            assert spark.conf.get(key) == "1000000"
    finally:
        spark.conf.unset(key)


def test_windows_are_counted_in_parts_of_bounded_size(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, bytes(rng.integers(97, 103, 3_000).astype(np.uint8)).decode()) for i in range(60)]
    want = collections.Counter(w for _, text in rows for w in ctxmix.windows(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))[0].tolist())
    sizes = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(ctxmix, "SLICE", 10_000)
    monkeypatch.setattr(ctxmix, "HELD", 20_000)
    summed = ctxmix._distinct

    def distinct(found, counts):
        sizes.add(sum(map(len, found)) > 30_000)
        return summed(found, counts)

    monkeypatch.setattr(ctxmix, "_distinct", distinct)
    got = {r["window"]: r["n"] for r in ctxmix.window_counts(frame(spark, rows).coalesce(1)).collect()}
    assert got == want and sizes.value == 0


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        path = scratch_path(spark, f"t-{name}")
        stage(spark, docs.withColumn("votes", F.lit(1)), sf_dir).drop("votes").write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "encoding":
            assert docs.columns == before.columns
        assert docs.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
    assert docs.where("octet_length(ids) != 4 * n_tokens").isEmpty() and docs.count() > 100


def test_context_mixing_predicts_alike_with_and_without_hashing_the_low_orders():
    import numpy as np

    from lumenflow.llm import ctxmix

    rng = np.random.default_rng(1)
    size = ctxmix.ORDERS << ctxmix.TABLE_BITS
    tables = ctxmix.Predictors(rng.normal(size=size).astype(np.float32), rng.integers(0, ctxmix.LEVELS, size).astype(np.uint8))
    mixer = ctxmix.Mixer(rng.normal(size=(ctxmix.GATES, ctxmix.ORDERS)), np.zeros(ctxmix.GATES), rng.integers(0, 50, (2, 256 * ctxmix.REFINE_BUCKETS)).astype(float))
    data = rng.integers(0, 256, 3000).astype(np.uint8)
    found, _ = ctxmix.windows(data, np.array([0, 1, 700, 700, 3000]))
    want = np.zeros(len(found))
    weights = mixer.weights.astype(np.float32)
    contexts = ctxmix._contexts(found)
    for bit in range(8):
        node, value = ctxmix._node(found, bit)
        slots = [ctxmix._slot(contexts[order], node, order) for order in range(ctxmix.ORDERS)]
        gate = ctxmix._gate(bit, tables.level[slots[-1]], tables.level[slots[-2]])
        mixed = np.zeros(len(found), np.float32)
        for order in range(ctxmix.ORDERS):
            mixed += weights[gate, order] * tables.stretched[slots[order]]
        p = ctxmix._squash(mixed)
        at = node.astype(np.int64) * ctxmix.REFINE_BUCKETS + ctxmix._bucket(mixed)
        zeros, ones = mixer.refine[0][at], mixer.refine[1][at]
        p = np.clip((p + (ones + 20 * p) / (zeros + ones + 20)) / 2, 1e-6, 1 - 1e-6)
        want -= np.log2(np.where(value == 1, p, 1 - p))
    assert (ctxmix.bits_of(mixer, tables, found) == want).all()
    near = ctxmix._near(tables)
    assert [len(n) for n in near] == [1 << 8, 1 << 16]  # two orders of six need no hash and no large table
    assert len(ctxmix._contexts(found, 2)) == ctxmix.ORDERS - 2
