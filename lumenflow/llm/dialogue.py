"""Conversations brought into the form ``(system? (user assistant)+)?`` by the cheapest edits.

Faults of a row, the first that holds: *blank* (nothing but separators), *duplicate* (role and text
seen earlier in the conversation), *truncated* (the last other character isn't one of ``.!?``).
Edits: Keep (0), Rerole to user or assistant (3), Delete (4; blank and duplicate rows must go), Insert
an empty user or assistant message anywhere (3). A truncated row that stays adds 3. An audit is the edits' initials in
order; of the cheapest edits those with the ASCII-least audit are taken.

Method: a node is (rows done, what stands last: nothing, system, user, assistant). A dynamic
program backwards over the rows gives each node its cost to the end, one numpy step per row for
all conversations of a batch. Arcs that lose nothing are the optimal ones; the letters of one
node's arcs differ and each leads to one node, so a node's least letter fixes its next node. Prefix
doubling then ranks the nodes by their least audits of 1, 2, 4, ... letters: a node's rank at twice the length is the
rank of (its rank, the rank of the node where its pointer leads), and pointers double along. The
path from a conversation's first node is read off the doubled pointers, all places at once.

On the cluster: conversations of up to ``LONG`` rows are hashed by their id, sorted, and
repaired as they stream by. Longer ones, whatever share of the rows one of them holds, are
spread over ranges of their order and cut into pieces. A piece is a 4 x 4 matrix of least
costs between the nodes at its two ends; a scan over a conversation's matrices gives every
piece its costs to the end, each piece then tells to which node each of its first nodes leads,
a second scan gives each piece its first node, and the pieces are repaired on their own. Only the matrices
(128 bytes for thousands of rows) of one conversation meet in a task. The digest over a long
conversation is taken piece by piece in order, as SHA-256 can't be split; memory is one piece.

Odd input: a null role or text is one space (so blank, or a role that must change); rows with a null turn come first;
of equal turns the order is role, then text. All null conversation ids are one conversation. Roles count by their first
letter (``s``, ``u``, ``a``); any other, or an empty role, can't be kept. A conversation without rows that are
present gives zeros, an empty audit and no text. An empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenflow.llm.textops import settle
from lumenflow.session import scratch_path

LONG = 4_096
PIECE_ROWS, PIECE_BYTES = 16_384, 8 << 20
BATCH_ROWS = 8_192

#: Costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SEPARATORS = " \t\n\v\f\r"
LEGAL = {"su", "ua", "au"}

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
FREE = 1 << 40  # more than any cost: no way
#: Costs at the end of a conversation: done after nothing or an assistant's message.
END = np.array([0, FREE, FREE, 0], np.int64)
#: The state after a user's or an assistant's message that is put in or gets its role.
MADE = np.array([USER, USER, ASSISTANT, USER])

# A row is a symbol: its role (s, u, a, other) plus 4 if truncated, or plus 8 if it must go.
_KEPT = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1] * 4])
KEEP_TO = np.tile(np.maximum(_KEPT, 0), (3, 1))
KEEP_COST = np.concatenate([np.where(_KEPT < 0, FREE, 0), np.where(_KEPT < 0, FREE, TRUNCATED), np.full((4, 4), FREE)])
REROLE_COST = np.repeat([REROLE, REROLE + TRUNCATED, FREE], 4)


# ---------------------------------------------------------------- costs, paths
def closed(cost: np.ndarray) -> np.ndarray:
    """Costs after inserting what pays off."""
    out = cost.copy()
    out[:, USER] = np.minimum(cost[:, USER], INSERT + cost[:, ASSISTANT])
    out[:, ASSISTANT] = np.minimum(cost[:, ASSISTANT], INSERT + cost[:, USER])
    for state in (NOTHING, SYSTEM):
        out[:, state] = np.minimum(cost[:, state], INSERT + out[:, USER])
    return out


def costs(symbols: np.ndarray, bounds: np.ndarray, after: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Least cost to the end from every node, four per place; a run of n rows has n + 1 places.

    ``after``: costs behind each run; ``ends``: whether the conversation ends there, so that rows may be inserted behind it.
    """
    sizes = np.diff(bounds)
    last = bounds[1:] + np.arange(len(sizes))
    dist = np.empty((len(symbols) + len(sizes), 4), np.int64)
    dist[last] = np.where(ends[:, None], closed(after), after)
    order = np.argsort(-sizes, kind="stable")
    falling = -sizes[order]
    for back in range(1, int(sizes.max(initial=0)) + 1):
        live = order[: np.searchsorted(falling, -back, side="right")]
        at = last[live] - back
        symbol, behind = symbols[bounds[live + 1] - back], dist[at + 1]
        cost = np.minimum(DELETE + behind, KEEP_COST[symbol] + np.take_along_axis(behind, KEEP_TO[symbol], 1))
        dist[at] = closed(np.minimum(cost, REROLE_COST[symbol][:, None] + behind[:, MADE]))
    return dist


@dataclass
class Paths:
    """Optimal arcs of all nodes, doubled: letters, pointers over 1, 2, 4, ... edits, edits to the end, ranks."""

    letters: np.ndarray
    pointers: list[np.ndarray]
    length: np.ndarray
    rank: np.ndarray

    def walk(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nodes on the paths from ``starts`` without their ends, bounds of the paths)."""
        sizes = self.length[starts]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(starts, sizes)
        step = np.arange(len(at)) - np.repeat(bounds[:-1], sizes)
        for k, pointer in enumerate(self.pointers):
            at = np.where((step >> k) & 1, pointer[at], at)
        return at, bounds

    def end(self, starts: np.ndarray) -> np.ndarray:
        """The nodes where the paths end."""
        at = starts.copy()
        for k, pointer in enumerate(self.pointers):
            at = np.where((self.length[starts] >> k) & 1, pointer[at], at)
        return at


def least_paths(symbols: np.ndarray, bounds: np.ndarray, dist: np.ndarray, ends: np.ndarray) -> Paths:
    sizes = np.diff(bounds)
    runs = np.repeat(np.arange(len(sizes)), sizes + 1)
    place = np.arange(len(dist))
    last = np.zeros(len(dist), bool)
    last[bounds[1:] + np.arange(len(sizes))] = True
    symbol = np.zeros(len(dist), np.int64)
    symbol[~last] = symbols
    behind = np.concatenate([dist[1:], dist[:1]])
    rows = ~last[:, None]
    target = np.empty((4, len(dist), 4), np.int64)  # by letter D, I, K, R
    ok = np.empty((4, len(dist), 4), bool)
    target[0] = (place[:, None] + 1) * 4 + np.arange(4)
    ok[0] = rows & (dist == DELETE + behind)
    target[1] = place[:, None] * 4 + MADE
    ok[1] = (rows | ends[runs][:, None]) & (dist == INSERT + dist[:, MADE])
    target[2] = (place[:, None] + 1) * 4 + KEEP_TO[symbol]
    ok[2] = rows & (dist == KEEP_COST[symbol] + np.take_along_axis(behind, KEEP_TO[symbol], 1))
    target[3] = (place[:, None] + 1) * 4 + MADE
    ok[3] = rows & (dist == REROLE_COST[symbol][:, None] + behind[:, MADE])
    ok &= dist < FREE
    letter = np.where(ok.any(axis=0), ok.argmax(axis=0), -1).ravel()
    target = target.reshape(4, -1)
    node = np.arange(4 * len(dist))
    pointer = np.where(letter < 0, node, target[np.maximum(letter, 0), node])
    rank, length = letter + 1, (letter >= 0).astype(np.int64)  # an end comes before any letter
    pointers = [pointer]
    while np.any(letter[pointer] >= 0):
        _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)
        length = length + length[pointer]
        pointer = pointer[pointer]
        pointers.append(pointer)
    return Paths(np.frombuffer(b"DIKR", np.uint8)[np.maximum(letter, 0)], pointers, length, rank)


# ----------------------------------------------------------------------- rows
@dataclass
class Run:
    """Consecutive rows of one conversation that are present, and what is counted over them."""

    conv_id: object
    part: int = 0
    turns: list = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    faults: list[int] = field(default_factory=list)  # 0 none, 1 truncated, 2 duplicate, 3 blank
    seen: set | None = field(default_factory=set)
    size: int = 0

    def add(self, turn, role: str, text: str, duplicate: bool = False) -> None:
        core = text.rstrip(SEPARATORS)
        if self.seen is not None and core:
            duplicate = (role, text) in self.seen
            self.seen.add((role, text))
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(3 if not core else 2 if duplicate else 1 if core[-1] not in ".!?" else 0)
        self.size += len(role) + len(text)

    def symbols(self) -> np.ndarray:
        role = np.array(["sua".find(r[:1]) if r else -1 for r in self.roles], np.int64)
        fault = np.array(self.faults, np.int64)
        return np.where(role < 0, 3, role) + np.where(fault >= 2, 8, 4 * fault)

    def counts(self) -> dict:
        initials = [r[:1] for r in self.roles]
        turns = [t for t in self.turns if t is not None]
        return {
            "conv_id": self.conv_id, "part": self.part, "blank": self.faults.count(3), "duplicate": self.faults.count(2), "truncated": self.faults.count(1),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])), "low_turn": min(turns, default=None), "high_turn": max(turns, default=None),
            "turns": len(set(turns)), "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
        }

    def lines(self, letters: bytes, nodes: list[int], first_place: int) -> list[str]:
        out = []
        for letter, node in zip(letters, nodes):
            row, state = node // 4 - first_place, node % 4
            if letter == 73:  # I
                out.append(f"{ROLES[int(MADE[state])]}:")
            elif letter == 75:  # K
                out.append(f"{self.roles[row]}:{self.texts[row]}")
            elif letter == 82:  # R
                out.append(f"{ROLES[int(MADE[state])]}:{self.texts[row]}")
        return out


_COUNTS = [("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("low_turn", pa.int64()), ("high_turn", pa.int64()), ("turns", pa.int64()), ("first", pa.string()), ("last", pa.string())]
_COUNTS_SQL = "part int, blank long, duplicate long, truncated long, illegal long, low_turn long, high_turn long, turns long, first string, last string"
_PIECE = [("part", pa.int32()), *_COUNTS, ("cost", pa.int64()), ("audit", pa.string()), ("repaired", pa.string())]
_PIECE_SQL = f"{_COUNTS_SQL}, cost long, audit string, repaired string"


def repaired(runs: list[Run], after: np.ndarray, ends: np.ndarray, states: np.ndarray) -> list[dict]:
    """Counts, cost, audit and text of each run that is entered in its state."""
    sizes = [len(r.roles) for r in runs]
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)
    symbols = np.concatenate([r.symbols() for r in runs]) if runs else np.zeros(0, np.int64)
    dist = costs(symbols, bounds, after, ends)
    paths = least_paths(symbols, bounds, dist, ends)
    places = bounds[:-1] + np.arange(len(runs))
    starts = places * 4 + states
    nodes, cuts = paths.walk(starts)
    letters = paths.letters[nodes].tobytes()
    total = dist.ravel()
    spent = total[starts] - np.where(ends, 0, total[paths.end(starts)])
    out = []
    for run, place, begin, end, cost in zip(runs, places.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), spent.tolist()):
        audit = letters[begin:end]
        lines = run.lines(audit, nodes[begin:end].tolist(), place)
        out.append(run.counts() | {"cost": cost, "audit": audit.decode(), "repaired": "\n".join(lines)})
    return out


def _schema(conv_id: pa.DataType, rest: list[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema([("conv_id", conv_id), *rest])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text", "present")])


def _whole(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Sorted rows of whole conversations, repaired by batches of conversations."""
    schema = _schema(kind, _PIECE)
    runs: list[Run] = []
    held = 0

    def done() -> pa.RecordBatch:
        n = len(runs)
        return pa.RecordBatch.from_pylist(repaired(runs, np.tile(END, (n, 1)), np.ones(n, bool), np.full(n, NOTHING)), schema=schema)

    for conv_id, turn, role, text, present in _rows(batches):
        if not runs or runs[-1].conv_id != conv_id:
            if held >= BATCH_ROWS or sum(r.size for r in runs[-1:]) > PIECE_BYTES:
                yield done()
                runs, held = [], 0
            runs.append(Run(conv_id))
        if present:
            runs[-1].add(turn, role, text)
            held += 1
    if runs:
        yield done()
    settle()


# ------------------------------------------------------- long conversations
_CHUNK = [("segment", pa.int32()), ("part", pa.int32()), ("turns_", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("faults", pa.binary()), ("symbols", pa.binary())]
_CHUNK_SQL = "segment int, part int, turns_ array<long>, roles array<string>, texts array<string>, faults binary, symbols binary"


def _chunks(batches: Iterator[pa.RecordBatch], kind: pa.DataType, piece_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range as pieces of one conversation each."""
    schema, segment, part, run = _schema(kind, _CHUNK), TaskContext.get().partitionId(), 0, None

    def done() -> pa.RecordBatch:
        row = {"conv_id": run.conv_id, "segment": segment, "part": part, "turns_": run.turns, "roles": run.roles, "texts": run.texts}
        row |= {"faults": bytes(run.faults), "symbols": run.symbols().astype(np.uint8).tobytes()}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text", "present", "repeated")]
        for conv_id, turn, role, text, present, repeated in zip(*columns):
            if run is not None and (run.conv_id != conv_id or len(run.roles) >= piece_rows or run.size >= PIECE_BYTES):
                yield done()
                run, part = None, part + 1
            if run is None:
                run = Run(conv_id, seen=None)
            if present:
                run.add(turn, role, text, repeated)
    if run is not None:
        yield done()
    settle()


def _bounds(symbols: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in symbols], np.int64)
    return np.frombuffer(b"".join(symbols), np.uint8).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def matrix(symbols: bytes) -> np.ndarray:
    """Least costs from each state before the rows to each state behind them."""
    behind = np.where(np.eye(4, dtype=bool), 0, FREE)
    flat, bounds = _bounds([symbols] * 4)
    dist = costs(flat, bounds, behind, np.zeros(4, bool))
    return dist[bounds[:-1] + np.arange(4)].T


def leads_to(symbols: bytes, after: np.ndarray, ends: bool) -> np.ndarray:
    """The state behind the rows that the least path from each state before them ends in."""
    flat, bounds = _bounds([symbols])
    dist = costs(flat, bounds, after[None, :], np.array([ends]))
    return least_paths(flat, bounds, dist, np.array([ends])).end(np.arange(4)) % 4


def _mapped(df: DataFrame, row, output: list[tuple[str, pa.DataType]], sql: str) -> DataFrame:
    """``df.mapInArrow`` of a function from one row (a dict) to the rows that it gives."""
    schema = pa.schema(output)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_pylist(row(batch.slice(i, 1).to_pylist()[0]), schema=schema)
        settle()

    return df.mapInArrow(run, sql)


def _tell(piece: dict) -> list[dict]:
    return [{"segment": piece["segment"], "part": piece["part"], "matrix": matrix(piece["symbols"]).astype("<i8").tobytes()}]


def _back(conversation: dict) -> list[dict]:
    """Costs behind each piece of a conversation, from the last to the first."""
    out, after, ends = [], END, True
    for piece in reversed(conversation["pieces"]):
        out.append({"segment": piece["segment"], "part": piece["part"], "after": after.astype("<i8").tobytes(), "ends": ends})
        costs_ = np.frombuffer(piece["matrix"], "<i8").reshape(4, 4)
        after = (costs_ + (closed(after[None, :])[0] if ends else after)).min(axis=1)
        ends = False
    return out


def _lead(piece: dict) -> list[dict]:
    states = leads_to(piece["symbols"], np.frombuffer(piece["after"], "<i8"), piece["ends"])
    return [{"segment": piece["segment"], "part": piece["part"], "leads": states.astype(np.uint8).tobytes()}]


def _forth(conversation: dict) -> list[dict]:
    """The state before each piece, from the first to the last; ``place`` numbers the pieces."""
    out, state = [], NOTHING
    for place, piece in enumerate(conversation["pieces"]):
        out.append({"segment": piece["segment"], "part": piece["part"], "state": state, "place": place})
        state = piece["leads"][state]
    return out


def _mend(piece: dict) -> list[dict]:
    run = Run(piece["conv_id"], piece["place"], piece["turns_"], piece["roles"], piece["texts"], list(piece["faults"]), None)
    return repaired([run], np.frombuffer(piece["after"], "<i8")[None, :], np.array([piece["ends"]]), np.array([piece["state"]]))


def _long_pieces(rows: DataFrame, kind: pa.DataType, conv_sql: str, piece_rows: int) -> DataFrame:
    spark = rows.sparkSession

    def staged(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    rows = staged(rows.withColumn("row_id", F.monotonically_increasing_id()), "dialogue-rows")
    order = F.struct(F.col("turn").isNotNull().alias("given"), F.coalesce("turn", F.lit(0)).alias("turn"), "row_id")
    marked = rows.withColumn("digest", F.sha2(F.concat(F.col("role"), F.lit("\0"), F.col("text")).cast("binary"), 256)).withColumn("at", order)
    firsts = marked.where("present").groupBy("conv_id", "digest").agg(F.min("at").alias("first_at"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.select(F.col("conv_id").alias("conv_"), F.col("digest").alias("digest_"), "first_at")
    same = F.col("conv_id").eqNullSafe(F.col("conv_")) & (F.col("digest") == F.col("digest_"))
    marked = marked.join(firsts, same, "left").withColumn("repeated", F.coalesce(F.col("at") > F.col("first_at"), F.lit(False)))
    marked = marked.select("conv_id", "turn", "role", "text", "present", "repeated", "row_id")
    key = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "row_id")]
    ranges = max(1, -(-rows.count() // piece_rows))
    dealt = marked.repartitionByRange(ranges, *key).sortWithinPartitions(*key).drop("row_id")
    chunks = staged(dealt.mapInArrow(lambda batches: _chunks(batches, kind, piece_rows), f"conv_id {conv_sql}, {_CHUNK_SQL}"), "dialogue-pieces")

    key2 = ["segment", "part"]
    slim = chunks.select("conv_id", *key2, "symbols")
    ids = [("segment", pa.int32()), ("part", pa.int32())]

    def by_conversation(told: DataFrame, extra: str) -> DataFrame:
        told = told.join(chunks.select("conv_id", *key2), key2)
        return told.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*key2, extra))).alias("pieces")).select("pieces")

    told = _mapped(slim.drop("conv_id"), _tell, [*ids, ("matrix", pa.binary())], "segment int, part int, matrix binary")
    behind = _mapped(by_conversation(told, "matrix"), _back, [*ids, ("after", pa.binary()), ("ends", pa.bool_())], "segment int, part int, after binary, ends boolean")
    behind = staged(behind, "dialogue-behind")
    leads = _mapped(slim.drop("conv_id").join(behind, key2), _lead, [*ids, ("leads", pa.binary())], "segment int, part int, leads binary")
    states = _mapped(by_conversation(leads, "leads"), _forth, [*ids, ("state", pa.int32()), ("place", pa.int32())], "segment int, part int, state int, place int")
    ready = chunks.join(behind, key2).join(states, key2).drop("symbols")
    return _mapped(ready, _mend, list(_schema(kind, _PIECE)), f"conv_id {conv_sql}, {_PIECE_SQL}")


def _digests(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Pieces in order, folded into one row per conversation; holds one piece's text and the audit."""
    schema = _schema(kind, _SUMMARY)
    state: dict | None = None

    def close() -> pa.RecordBatch:
        row = {k: state[k] for k in ("conv_id", "blank", "duplicate", "truncated", "illegal", "cost")}
        low, high = state["low_turn"], state["high_turn"]
        row |= {"gaps": 0 if low is None else high - low + 1 - state["turns"], "audit": "".join(state["audits"]), "repaired_sha256": state["sha"].hexdigest()}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for i in range(batch.num_rows):
            piece = batch.slice(i, 1).to_pylist()[0]
            if state is None or state["conv_id"] != piece["conv_id"]:
                if state is not None:
                    yield close()
                state = {"conv_id": piece["conv_id"], "low_turn": None, "high_turn": None, "turns": 0, "last": None, "audits": [], "sha": hashlib.sha256(), "any": False}
                state |= dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
            for name in ("blank", "duplicate", "truncated", "illegal", "cost", "turns"):
                state[name] += piece[name]
            if piece["first"] is not None:
                state["illegal"] += state["last"] is not None and state["last"] + piece["first"] not in LEGAL
                state["last"] = piece["last"]
            if piece["low_turn"] is not None:
                state["turns"] -= state["high_turn"] == piece["low_turn"]  # one turn on both sides of the cut
                state["low_turn"] = piece["low_turn"] if state["low_turn"] is None else state["low_turn"]
                state["high_turn"] = piece["high_turn"]
            state["audits"].append(piece["audit"])
            if piece["repaired"]:
                state["sha"].update(b"\n" * state["any"] + piece["repaired"].encode())
                state["any"] = True
    if state is not None:
        yield close()
    settle()


_SUMMARY = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
_SUMMARY_SQL = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


# ----------------------------------------------------------------------- jobs
def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by the checksum of ``conv_id:turn``; dropped rows stay with ``present`` false."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    drawn = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(drawn == 1, "").when(drawn == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(drawn == 4, "user").otherwise(space("role"))
    copies = F.explode(F.when(drawn == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), (drawn != 0).alias("present"), copies.alias("copy")).drop("copy")


def repair(rows: DataFrame, present: Column | None = None, long: int = LONG, piece_rows: int = PIECE_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """(whole conversations, pieces of longer ones or None): counts, cost, audit and ``repaired`` (``role:text`` by lines).

    ``rows``: conv_id, turn, role, text. Pieces of a conversation are numbered by ``part``.
    """
    clean = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    given = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), clean("role"), clean("text"), (F.lit(True) if present is None else present).alias("present"))
    kind, conv_sql = given.select("conv_id").schema["conv_id"], given.schema["conv_id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[conv_sql] if conv_sql in ("bigint", "int", "string") else None
    if arrow is None:
        raise TypeError(f"conversation ids are long, int or string, not {kind.dataType.simpleString()}")
    sizes = given.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > long).select(F.col("conv_id").alias("conv_"))
    path = scratch_path(rows.sparkSession, "dialogue-long")
    sizes.write.parquet(path)
    hot = rows.sparkSession.read.parquet(path)
    longer = None
    if not hot.isEmpty():
        same = F.col("conv_id").eqNullSafe(F.col("conv_"))
        longer = _long_pieces(given.join(hot, same, "left_semi"), arrow, conv_sql, piece_rows)
        given = given.join(hot, same, "left_anti")
    key = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    whole = given.repartition("conv_id").sortWithinPartitions(*key)
    return whole.mapInArrow(lambda batches: _whole(batches, arrow), f"conv_id {conv_sql}, {_PIECE_SQL}"), longer


def summary(whole: DataFrame, longer: DataFrame | None) -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit and the digest of the repaired text."""
    gaps = F.coalesce(F.col("high_turn") - F.col("low_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    names = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    out = whole.select("conv_id", gaps, *names, F.sha2(F.col("repaired").cast("binary"), 256).alias("repaired_sha256"))
    if longer is None:
        return out
    conv_sql = longer.schema["conv_id"].dataType.simpleString()
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[conv_sql]
    key = [F.col("conv_id").asc_nulls_first(), F.col("part")]
    folded = longer.repartition("conv_id").sortWithinPartitions(*key).mapInArrow(lambda batches: _digests(batches, arrow), f"conv_id {conv_sql}, {_SUMMARY_SQL}")
    return out.unionByName(folded)
