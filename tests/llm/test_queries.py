"""The registered queries on odd tables: against their DuckDB statements, or the contract computed in plain Python."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lumenflow.llm import bpe, oracle, queries
from lumenflow.session import scratch_path

sys.path.insert(0, str(Path(__file__).parents[2] / "tools"))
from compare import digest  # noqa: E402

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMAS = {
    "documents": "doc_id long, text string",
    "pages": "page_id long, url string, html string",
    "embeddings": "vec_id long, embedding array<double>",
    "conversations": "conv_id long, turn long, role string, text string",
    "benchmark": "item_id long, text string",
}
#: Columns that some query makes or works with: a table that has them already.
CLASHING = ("n_words", "kept", "component_id", "n_shingles", "payload", "ids", "output", "rank", "audit", "score", "words", "id", "n", "__made_0")


def prose(rng, n) -> str:
    return " ".join(rng.choice([f"w{i}" for i in range(300)]) for _ in range(n))


def odd_documents() -> list[tuple]:
    rng = random.Random(21)
    passage, base = prose(rng, 30), prose(rng, 90)
    texts = [None, "", " \n\t\x0b\x0c\r", "one", "One", "two words", passage, passage.upper(), "aa " * 60, "é ü  x <P>", "a\nb\n\nb \n#$%&|<>", "\U0001f600 滿" * 9]
    for k in range(14):
        words = base.split()
        for _ in range(k % 5):
            words[rng.randrange(len(words))] = rng.choice(["x", "y", "z"])
        texts.append(" ".join(words))
    texts += [base, base, f"{prose(rng, 30)}\n{passage}  {prose(rng, 9)}", f"{passage} {prose(rng, 20)}", prose(rng, 12_000), "z" * 30_000]
    return list(enumerate(texts))


ROWS = {
    "documents": odd_documents(),
    "pages": [(1, "u", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 50_000), (6, "u", "x\n"), (7, "u", "é" * 50_000), (8, "WARC/1.0\r\n", "WARC/1.0\r\n\r\n")],
    "embeddings": [(i, [math.sin(i * k) for k in range(1, 9)]) for i in range(120)] + [(150, None), (200, [1.0, None]), (250, [0.5] * 8), (251, [0.5] * 8), (300, [float("nan")] * 8)],
    "conversations": [(c, t, ("user", "assistant", "system", None)[(c + t * t) % 4], ("Yes.", "no", None, "why?")[(c * t) % 4]) for c in range(30) for t in range(7)] + [(None, None, "user", "x"), (None, 0, "assistant", "y.")],
    "benchmark": [(1, prose(random.Random(1), 20)), (2, None)],
}


@pytest.fixture(scope="module")
def odd(spark) -> str:
    path = scratch_path(spark, "t-odd")
    for name, rows in ROWS.items():
        made = spark.createDataFrame(rows, SCHEMAS[name]).selectExpr("*", *[f"'clash' AS `{c}`" for c in CLASHING])
        made.write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="module")
def empty(spark) -> str:
    path = scratch_path(spark, "t-empty")
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("name", sorted(oracle.STATEMENTS))
def test_query_equals_its_sql_on_odd_tables(spark, odd, name):
    found = queries.registry()[name](spark, odd)
    con = duckdb.connect()
    for table in ROWS:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{odd.removeprefix('file:')}/{table}.parquet/*.parquet')")
    want = con.execute(oracle.STATEMENTS[name])
    columns, rows = [c[0] for c in want.description], want.fetchall()
    assert sorted(found.columns) == sorted(columns)
    assert digest(found.columns, [tuple(r) for r in found.collect()])[1] == digest(columns, rows)[1]


@pytest.mark.parametrize("name", sorted(queries.registry()))
def test_query_of_empty_tables(spark, empty, name):
    assert queries.registry()[name](spark, empty).collect() == []


def test_counts_and_base_of_quality(spark, odd):
    got = {r["doc_id"]: r for r in queries.op3_weak_supervision(spark, odd).collect()}
    for i, text in ROWS["documents"]:
        w = WORD.findall(text or "")
        windows = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(5)}
        seen, twice = set(), 0
        for line in (text or "").split("\n"):
            if WORD.search(line):
                twice += line in seen
                seen.add(line)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), twice, len(covered))
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_base_of_scores(spark, odd):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in ROWS["documents"]}
    words = {i: [*WORD.findall((t or "").translate(LOWER)), None] for i, t in ROWS["documents"]}
    counts = collections.Counter(w for i, ws in words.items() if not held[i] for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in queries.op8_context_mixing(spark, odd).collect()}
    for i, ws in words.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(counts[w] > 0 for w in ws), total)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws), rel_tol=1e-9) and r["score"] <= 0


def test_ids_of_byte_pairs(spark, odd):
    ranks = bpe.read_ranks(public_tokenizers.path(queries.RANKS))
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in queries.op10_byte_bpe(spark, odd).collect()}
    for i, text in ROWS["documents"]:
        ids = other.encode_ordinary(text or "")
        digests = (hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), *digests)
