"""Block-max search, fill-in-the-middle and conversation repair against brute force, on odd tables too."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from lumenflow.llm import blockmax, dialogue, fim, queries
from lumenflow.session import scratch_path

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


def folder(spark, name, rows, schema) -> str:
    """A folder with one table, as the registered queries read it."""
    path = scratch_path(spark, "t-tables")
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


# ----------------------------------------------------------------- block-max
def vectors() -> list[tuple]:
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]) for i in range(0, 400)]
    rows += [(1000 + i, centres[0]) for i in range(150)]  # a large group of ties
    rows += [(2000, None), (2050, [1.0, None]), (2100, [1.0, float("nan")]), (2150, [float("inf")]), (None, [1.0] * 8), (2200, []), (2250, [0.5, -0.5])]
    rows += [(2300, centres[1]), (2300, centres[1]), (2300, centres[2]), (2350, [-0.001] * 8), (2400, [1e200, -1e200]), (2450, [1e15] * 8), (-50, [0.25] * 9)]
    return rows


def nearest(rows, k=5) -> dict:
    code = lambda v: [max(-blockmax._LIMIT, min(blockmax._LIMIT, math.floor(x * 256) if abs(x) < 1e300 else x)) for x in v]
    good = [(i, [int(x) for x in code(v)]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in good if i % 50 == 0}:
        scored = [(max(-(2**63) + 1, min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), d) for d, b in good if d != q]
        best = sorted(scored, key=lambda s: (-s[0], s[1]))[:k]
        out += [(q, n, d, s) for n, (s, d) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(8192, 512), (40, 3), (100, 1)])
def test_block_max_equals_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(blockmax, "SHARD_ROWS", sizes[0])
    monkeypatch.setattr(blockmax, "QUERY_GROUP", sizes[1])
    rows = vectors()
    path = folder(spark, "embeddings", [(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, id int, score string")
    got = sorted(tuple(r) for r in queries.op11_block_max_top_k(spark, path).select("query_id", "rank", "vec_id", "score").collect())
    assert got == nearest(rows)


def test_block_max_of_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert queries.op11_block_max_top_k(spark, folder(spark, "embeddings", [], schema)).collect() == []
    got = queries.op11_block_max_top_k(spark, folder(spark, "embeddings", [(0, [1.0]), (1, [-1.0]), (2, None)], schema)).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, -65536)]


def test_blocks_below_the_kth_score_are_left_out():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 400, (40, 16))
    blocks = [(np.arange(64) + 64 * b, (c + rng.normal(0, 4, (64, 16))).astype(np.int64)) for b, c in enumerate(centres)]
    top, bottom = np.array([w.max(axis=0) for _, w in blocks]), np.array([w.min(axis=0) for _, w in blocks])
    asked = np.array([w[0] for _, w in blocks])
    none, last = np.full(40, np.iinfo(np.int64).min), np.full(40, np.iinfo(np.int64).max)
    score, vec_id, scored = blockmax.search(asked, np.arange(40) * 64, none, last, top, bottom, np.array([i[0] for i, _ in blocks]), blocks, 5)
    everything = asked @ np.concatenate([w for _, w in blocks]).T
    everything[np.arange(40), np.arange(40) * 64] = np.iinfo(np.int64).min + 1
    assert (score == -np.sort(-everything, axis=1)[:, :5]).all() and scored < 40 * 40 / 4


# ------------------------------------------------------------------ the middle
def texts() -> list[tuple]:
    rng = random.Random(9)
    odd = [None, "", " ", "\n\t ", "one", " one", "one ", "a<P>b c", "<S>", "x<M", "é ü z", "\x1c \x85 a", "a b\r\nc  ", "滿 \U0001f600 x" * 5, "w " * 3000, "z" * 9000]
    odd += ["".join(rng.choice("ab <SPM>\n\té滿") for _ in range(rng.randrange(60))) for _ in range(250)]
    return [*enumerate(odd), (None, "null id here"), (5, "five again"), (5, "five again"), (7000, "long " * 600_000)]


def arranged(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    form = "spm" if h4 % 100 < 80 else "psm"
    return doc_id, n, form, len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"), sha(text)


def test_middle_equals_brute_force(spark):
    rows = texts()
    path = folder(spark, "documents", [(i, t, "n", "m") for i, t in rows], "doc_id long, text string, form string, output string")
    got = [tuple(r) for r in queries.op12_fill_in_middle(spark, path).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted((arranged(*r) for r in rows), key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_middle_of_no_documents(spark):
    assert queries.op12_fill_in_middle(spark, folder(spark, "documents", [], "doc_id long, text string")).collect() == []


def test_cuts_of_a_slice_equal_the_sums_of_units():
    import pyarrow as pa

    from lumenflow.llm.textops import buffer

    given = [t or "" for _, t in texts()[:-1]]
    data, offsets = buffer(pa.array(given))
    units = fim.Units(data, offsets)
    found = [UNIT.findall(t) for t in given]
    assert units.number().tolist() == [len(f) for f in found]
    for share in (0, 0.3, 1):
        number = np.array([int(share * len(f)) for f in found])
        want = [len("".join(f[:n]).encode()) for f, n in zip(found, number)]
        assert (units.cut(number) - offsets[:-1]).tolist() == want


# ---------------------------------------------------------------- conversations
def cheapest(rows: list[tuple[str, str, int]]) -> tuple[int, str, list[str]]:
    """Dijkstra by (cost, audit) over (rows done, initials' state); rows are (role, text, fault)."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best, heap, seen = None, [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if best is not None and cost > best[0]:
            break
        if i == len(rows) and state in ("", "a") and (best is None or (cost, audit) < best[:2]):
            best = (cost, audit, list(lines))
        if (i, state, audit) in seen or cost > 4 * len(rows):  # deleting everything costs that
            continue
        seen.add((i, state, audit))
        for to, name in (("u", "user"), ("a", "assistant")):
            if to in step[state]:
                heapq.heappush(heap, (cost + 3, audit + "I", i, to, (*lines, f"{name}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, lines))
            if fault < 2:
                more = 3 * fault
                if role[:1] in step[state]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, step[state][role[:1]], (*lines, f"{role}:{text}")))
                for to, name in (("u", "user"), ("a", "assistant")):
                    if to in step[state]:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, to, (*lines, f"{name}:{text}")))
    return best


def judged(rows) -> list[tuple[str, str, int]]:
    out, seen = [], set()
    for role, text in rows:
        core = text.rstrip(" \t\n\v\f\r")
        out.append((role, text, 3 if not core else 2 if (role, text) in seen else int(core[-1] not in ".!?")))
        seen.add((role, text))
    return out


def expected(table) -> dict:
    """What op13 must give for a table of (conv_id, turn, role, text)."""
    by: dict = {}
    for conv_id, turn, role, text in table:
        rows = by.setdefault(conv_id, [])
        show = lambda v: " " if v is None else str(v)
        draw = zlib.crc32(f"{show(conv_id)}:{show(turn)}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        rows += [(turn, "user" if draw == 4 else role, text)] * {0: 0, 3: 2}.get(draw, 1)
    out = {}
    for conv_id, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = [t for t, _, _ in rows if t is not None]
        marked = judged([r[1:] for r in rows])
        faults = [m[2] for m in marked]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, lines = cheapest(marked)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv_id] = (gaps, faults.count(3), faults.count(2), faults.count(1), illegal, cost, audit, sha("\n".join(lines)))
    return out


def talks() -> list[tuple]:
    rng = random.Random(8)
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "unsure"])
            text = rng.choice(["yes.", "no!", "why?", "cut off", "", " \n", None, "é. ", "yes."])
            turn = rng.choice([t, t, t, t, 0, None, 3 * t])
            rows.append((c if c else None, turn, role, text))
    return rows


@pytest.mark.parametrize("sizes", [(4096, 16384), (3, 2), (0, 1), (0, 4)])
def test_repair_equals_brute_force(spark, monkeypatch, sizes):
    long, piece = sizes
    real = dialogue.repair
    monkeypatch.setattr(dialogue, "repair", lambda rows, present: real(rows, present, long, piece))
    rows = talks()
    path = folder(spark, "conversations", [(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, part string, present int")
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, path).collect()}
    assert got == expected(rows)


def test_repair_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert queries.op13_conversation_repair(spark, folder(spark, "conversations", [], schema)).collect() == []
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = queries.op13_conversation_repair(spark, folder(spark, "conversations", [(gone, 0, "user", "Hi.")], schema)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", sha(""))]


def test_ranks_order_the_least_audits():
    rng = np.random.default_rng(4)
    symbols, bounds = rng.integers(0, 12, 40), np.array([0, 7, 7, 20, 40])
    ends = np.ones(4, bool)
    dist = dialogue.costs(symbols, bounds, np.tile(dialogue.END, (4, 1)), ends)
    paths = dialogue.least_paths(symbols, bounds, dist, ends)
    nodes = np.arange(dist.size)
    walked, cuts = paths.walk(nodes)
    letters = paths.letters[walked].tobytes()
    audits = [letters[a:b] for a, b in itertools.pairwise(cuts.tolist())]
    order = sorted(range(len(audits)), key=lambda i: paths.rank[i])
    assert [audits[i] for i in order] == sorted(audits)


def test_a_very_long_conversation_is_repaired_in_pieces(spark):
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["So it is.", f"number {t}.", "no end", " "])) for t in range(30_000)] + [(2, 0, "user", "Hi.")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    by = lambda found: {r["conv_id"]: tuple(r) for r in dialogue.summary(*found).collect()}
    assert by(dialogue.repair(given, piece_rows=1_000)) == by(dialogue.repair(given, long=10**6))
