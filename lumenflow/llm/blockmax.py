"""Exact k largest inner products: blocks of documents visited in the order of their bounds.

Vectors become integers, ``floor(scale * x)``; a dimension is a term, its integer the weight.
Documents are put in an order that keeps like ones together and cut into ranges (blocks).
Each block keeps, per term, the largest and the smallest weight (its bounds) and the weights
of all its documents (its forward index). A block's bound for a query is the sum over terms of
the query's weight times the block's largest weight, or smallest for a negative query weight.
A query visits blocks by falling bound, scores every document of a block through the forward
index and stops where no later bound reaches its k-th best. Nothing is approximate: a block is
left out only if its bound is below the k-th score, or equal to it with no smaller id inside.

On the cluster
--------------
* Vectors are coded and get their two nearest of ``PIVOTS`` pivots (a bounded sample of 4 x
  ``PIVOTS`` rows by hash; it only sets the order of documents, never the result), then staged.
* A range partitioning by (pivot, second pivot, id) makes shards of about ``SHARD_ROWS`` rows;
  a group of equal vectors spans as many shards as it needs. Each task writes its blocks and one
  summary of the whole shard.
* Queries are salted into groups of about ``QUERY_GROUP`` rows. Every group sees the summaries
  of all shards (copied once per group, never broadcast), and each query goes to the shard with
  the best bound first. Its k-th score there is the threshold with which the other shards are
  chosen: a shard is sent only the queries that its bound says it can improve.
* Searching joins (shard, salt) groups of queries with that shard's blocks; a group holds one
  shard and about ``QUERY_GROUP`` queries, whatever is hot. The results of both rounds are merged
  by a window of at most k rows per query and shard. Nothing but the pivots reaches the driver.

Odd input: vectors that are null, hold null, NaN or infinite components, or have a null id, take
no part, neither as query nor as candidate. Vectors of different lengths meet in the components that both
have; an empty vector scores 0 with all. Equal scores go to the smaller id. A query's own rows
are those of its id, none of which it gets; other rows that repeat an id are candidates each.
Equal query rows are answered once, different vectors of one id each. Components and scores beyond a
long are held at its limits. Fewer than k candidates give all; an empty table gives no rows.
Other columns are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenflow.llm.textops import settle
from lumenflow.session import scratch_path

K = 5
SCALE = 256
BLOCK_ROWS = 128
SHARD_ROWS = 8_192
QUERY_GROUP = 512
PIVOTS = 256

_LIMIT = float(2**63 - 1024)  # the largest double below a long's end
_NONE = np.iinfo(np.int64).min
_LAST = np.iinfo(np.int64).max
_CODED = "id long, pivot int, second int, code binary"
_BLOCK = "shard int, block int, low long, rows int, dims int, width int, ids binary, codes binary, top binary, bottom binary"
_SENT = "query_id long, code binary, salt int, kth_score long, kth_id long, shard int"
_FOUND = "query_id long, query_hash long, vec_id long, score long"


# ------------------------------------------------------------------ integers
def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` as long."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * values.astype(np.float64)), -_LIMIT, _LIMIT).astype(np.int64)


def pack(row: np.ndarray) -> bytes:
    """A vector of integers: one byte for the width, then the integers."""
    small = not len(row) or (row.min() >= -32768 and row.max() <= 32767)
    return b"\x02" + row.astype("<i2").tobytes() if small else b"\x08" + row.astype("<i8").tobytes()


def unpack(codes: list[bytes]) -> np.ndarray:
    """Packed vectors as rows of one matrix, short ones filled up with zeros."""
    rows = [np.frombuffer(c, "<i2" if c[0] == 2 else "<i8", offset=1) for c in codes]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def widened(matrix: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, dims - matrix.shape[1]))) if matrix.shape[1] < dims else matrix


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices, held at a long's limits."""
    dims = max(a.shape[1], b.shape[1])
    a, b = widened(a, dims), widened(b, dims)
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * dims < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, _NONE + 1, _LAST).astype(np.int64)


def bounds(queries: np.ndarray, top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """Per query and block, no less than the score of any document of the block."""
    dims = max(queries.shape[1], top.shape[1])
    queries, top, bottom = (widened(m, dims) for m in (queries, top, bottom))
    signs = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1)
    return products(signs, np.concatenate([top, bottom], axis=1))


def _reaches(bound: np.ndarray, low: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> np.ndarray:
    """Whether (bound, low) comes before (score, vec_id): by falling score, then rising id."""
    return (bound > score) | ((bound == score) & (low < vec_id))


# -------------------------------------------------------------------- coding
def _coder(pivots: list[list[float]], scale: int):
    points = integers(np.zeros((0, 0)) if not pivots else np.array([p + [0.0] * (max(map(len, pivots)) - len(p)) for p in pivots]), scale)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        real = points.astype(np.float64)
        half = (real * real).sum(axis=1) / 2
        for batch in batches:
            ids, vectors = batch.columns
            good = ~(pc.is_null(ids).to_numpy(zero_copy_only=False) | pc.is_null(vectors).to_numpy(zero_copy_only=False))
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null component is NaN
            sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            good &= bad[ends] == bad[ends - sizes]
            numbers = integers(np.where(np.isfinite(values), values, 0), scale)
            keep = np.flatnonzero(good)
            codes = [pack(numbers[ends[i] - sizes[i] : ends[i]]) for i in keep.tolist()]
            first = second = np.zeros(len(keep), np.int32)
            if len(half) > 1 and len(keep):
                matrix = unpack(codes).astype(np.float64)
                dims = max(matrix.shape[1], real.shape[1])
                near = widened(matrix, dims) @ widened(real, dims).T - half
                first = near.argmax(axis=1)
                near[np.arange(len(keep)), first] = -np.inf
                second = near.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(keep)), pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(codes, pa.binary())],
                names=["id", "pivot", "second", "code"],
            )
        settle()

    return run


def _block(shard: int, block: int, ids: list[int], matrix: np.ndarray, whole: bool = True) -> dict:
    small = not matrix.size or np.abs(matrix).max() <= 32767
    return {
        "shard": shard, "block": block, "low": min(ids), "rows": len(ids), "dims": matrix.shape[1], "width": 2 if small else 8,
        "ids": np.array(ids, "<i8").tobytes() if whole else b"", "codes": matrix.astype("<i2" if small else "<i8").tobytes() if whole else b"",
        "top": matrix.max(axis=0).astype("<i8").tobytes(), "bottom": matrix.min(axis=0).astype("<i8").tobytes(),
    }


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the sorted rows of one task, then (block -1) the bounds of all of them."""
    shard, made = TaskContext.get().partitionId(), 0
    ids: list[int] = []
    codes: list[bytes] = []
    pivot = None
    edges: list[np.ndarray] = []
    lows: list[int] = []
    rows: list[dict] = []

    def close() -> None:
        nonlocal made, ids, codes, edges
        matrix = unpack(codes)
        rows.append(_block(shard, made, ids, matrix))
        dims = max(matrix.shape[1], edges[0].shape[1] if edges else 0)
        # a document that lacks a component has a 0 there, so the padding belongs to the bounds
        seen = [widened(e, dims) for e in edges] + [widened(matrix, dims)]
        seen = np.concatenate(seen)
        edges = [np.stack([seen.max(axis=0), seen.min(axis=0)])]
        lows.append(min(ids))
        made, ids, codes = made + 1, [], []

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_pylist(rows, schema=_arrow_block())
        rows.clear()
        return out

    for given in batches:
        for vec_id, here, code in zip(given.column("id").to_pylist(), given.column("pivot").to_pylist(), given.column("code").to_pylist()):
            if len(ids) == BLOCK_ROWS or (here != pivot and len(ids) >= BLOCK_ROWS // 4):
                close()
            pivot = here
            ids.append(vec_id)
            codes.append(code)
        if len(rows) >= 16:
            yield batch()
    if ids:
        close()
    if lows:
        rows.append(_block(shard, -1, [min(lows)], edges[0], whole=False))
        yield batch()
    settle()


def _arrow_block() -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in _BLOCK.split(", "))])


def _edges(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(largest, smallest) weights of the rows of a block table."""
    both = []
    for name in ("top", "bottom"):
        rows = [np.frombuffer(b, "<i8") for b in table.column(name).to_pylist()]
        out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
        for i, row in enumerate(rows):
            out[i, : len(row)] = row
        both.append(out)
    return both[0], both[1]


# ----------------------------------------------------------- choosing shards
def _chooser(first: bool):
    """Queries of a group against the summaries of all shards.

    ``first``: each to the shard with the best bound; else to all others whose bound reaches the k-th result.
    """

    def run(queries: pa.Table, shards: pa.Table) -> pa.Table:
        matrix = unpack(queries.column("code").to_pylist())
        top, bottom = _edges(shards)
        low, number = shards.column("low").to_numpy(), shards.column("shard").to_numpy()
        bound = bounds(matrix, top, bottom)
        if not len(number) or not len(matrix):
            at = shard = np.zeros(0, np.int64)
        elif first:
            at = np.arange(len(matrix))
            shard = number[np.lexsort((np.broadcast_to(low, bound.shape), -bound))[:, 0]]
        else:
            score, vec_id = queries.column("kth_score").to_numpy()[:, None], queries.column("kth_id").to_numpy()[:, None]
            reached = _reaches(bound, low, score, vec_id) & (number != queries.column("done").to_numpy()[:, None])
            at, column = np.nonzero(reached)
            shard = number[column]
        out = queries.select(["query_id", "code", "salt", "kth_score", "kth_id"]).take(pa.array(at))
        return out.append_column("shard", pa.array(shard, pa.int32()))

    return run


# ----------------------------------------------------------------- searching
def search(
    queries: np.ndarray, own: np.ndarray, floor_score: np.ndarray, floor_id: np.ndarray,
    top: np.ndarray, bottom: np.ndarray, low: np.ndarray, forward: list[tuple[np.ndarray, np.ndarray]], k: int,
) -> tuple[np.ndarray, np.ndarray, int]:
    """(scores, ids) of up to ``k`` results per query that come before its floor, and the number of blocks scored.

    ``forward`` has (ids, weights) per block; places without a result hold the smallest score.
    """
    m = len(queries)
    best_score, best_id = np.full((m, k), _NONE), np.full((m, k), _LAST)
    if not m or not forward:
        return best_score, best_id, 0
    bound = bounds(queries, top, bottom)
    order = np.lexsort((np.broadcast_to(low, bound.shape), -bound))
    kth_score, kth_id = floor_score.copy(), floor_id.copy()
    active, scored = np.arange(m), 0
    for step in range(len(forward)):
        block = order[active, step]
        more = _reaches(bound[active, block], low[block], kth_score[active], kth_id[active])
        active, block = active[more], block[more]  # the bounds only fall, so the others are done
        if not len(active):
            break
        by_block = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.diff(block[by_block], prepend=-1))
        hits = []
        for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(active)]):
            who = active[by_block[begin:end]]
            ids, weights = forward[block[by_block[begin]]]
            score = products(queries[who], weights)
            good = _reaches(score, ids, kth_score[who][:, None], kth_id[who][:, None]) & (ids != own[who][:, None])
            row, column = np.nonzero(good)
            hits.append((who[row], score[row, column], ids[column]))
            scored += len(who)
        who, score, vec_id = (np.concatenate(x) for x in zip(*hits))
        touched = np.unique(who)
        who = np.concatenate([who, np.repeat(touched, k)])
        score = np.concatenate([score, best_score[touched].ravel()])
        vec_id = np.concatenate([vec_id, best_id[touched].ravel()])
        ranked = np.lexsort((vec_id, np.where(score == _NONE, _LAST, -score), who))
        starts = np.searchsorted(who[ranked], touched)
        place = starts[:, None] + np.arange(k)
        best_score[touched], best_id[touched] = score[ranked][place], vec_id[ranked][place]
        better = touched[best_score[touched, k - 1] != _NONE]
        kth_score[better], kth_id[better] = best_score[better, k - 1], best_id[better, k - 1]
    return best_score, best_id, scored


def _searcher(k: int):
    def run(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        top, bottom = _edges(blocks)
        forward = []
        for block in blocks.select(["ids", "codes", "rows", "dims", "width"]).to_pylist():
            weights = np.frombuffer(block["codes"], f"<i{block['width']}").reshape(block["rows"], block["dims"]).astype(np.int64)
            forward.append((np.frombuffer(block["ids"], "<i8"), weights))
        number = queries.column("query_id").to_numpy()
        score, vec_id, _ = search(
            unpack(queries.column("code").to_pylist()), number, queries.column("kth_score").to_numpy(), queries.column("kth_id").to_numpy(),
            top, bottom, blocks.column("low").to_numpy(), forward, k,
        )
        row, column = np.nonzero(score != _NONE)
        return pa.table({
            "query_id": number[row], "query_hash": queries.column("query_hash").to_numpy()[row],
            "vec_id": vec_id[row, column], "score": score[row, column],
        })

    return run


# ------------------------------------------------------------------- the job
def top_k(vectors: DataFrame, is_query: Column, id_column: str = "vec_id", vector_column: str = "embedding", k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best candidates of every row for which ``is_query`` (of a column ``id``) holds."""
    spark = vectors.sparkSession
    given = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sample = given.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite).orderBy(F.xxhash64("id", "vector")).limit(4 * PIVOTS)
    pivots = [list(p) for p in dict.fromkeys(tuple(r["vector"]) for r in sample.collect())][:PIVOTS]
    path = scratch_path(spark, "topk-codes")
    given.mapInArrow(_coder(pivots, scale), _CODED).write.parquet(path)
    coded = spark.read.parquet(path)
    shards = max(1, -(-coded.count() // SHARD_ROWS))
    path = scratch_path(spark, "topk-blocks")
    key = ["pivot", "second", "id"]
    coded.repartitionByRange(shards, *key).sortWithinPartitions(*key).mapInArrow(_index, _BLOCK).write.parquet(path)
    index = spark.read.parquet(path)
    blocks, summaries = index.where("block >= 0"), index.where("block < 0").select("shard", "low", "top", "bottom")

    asked = coded.where(is_query).select(F.col("id").alias("query_id"), "code").distinct()
    groups = max(1, -(-coded.where(is_query).count() // QUERY_GROUP))
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("query_id", "code"), F.lit(groups)).cast("int"))
    copies = summaries.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).groupBy("salt")

    def run(sent: DataFrame) -> DataFrame:
        sent = sent.withColumn("query_hash", F.xxhash64("code"))
        wanted = sent.select(F.col("shard").alias("to_shard"), F.col("salt").alias("to_salt")).distinct()
        wanted = blocks.join(wanted, F.col("shard") == F.col("to_shard"))
        return sent.groupBy("shard", "salt").cogroup(wanted.groupBy("to_shard", "to_salt")).applyInArrow(_searcher(k), _FOUND)

    def staged(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    unset = asked.withColumn("kth_score", F.lit(int(_NONE))).withColumn("kth_id", F.lit(int(_LAST)))
    home = staged(unset.groupBy("salt").cogroup(copies).applyInArrow(_chooser(first=True), _SENT), "topk-home")
    found = staged(run(home), "topk-found")
    own = Window.partitionBy("query_id", "query_hash").orderBy(F.col("score").desc(), "vec_id")
    kth = found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") == k)
    kth = kth.select("query_id", "query_hash", F.col("score").alias("score_"), F.col("vec_id").alias("id_"))
    known = home.withColumn("query_hash", F.xxhash64("code")).join(kth, ["query_id", "query_hash"], "left").select(
        "query_id", "code", "salt", F.coalesce("score_", "kth_score").alias("kth_score"), F.coalesce("id_", "kth_id").alias("kth_id"), F.col("shard").alias("done")
    )
    rest = staged(known.groupBy("salt").cogroup(copies).applyInArrow(_chooser(first=False), _SENT), "topk-rest")
    every = found.union(run(rest)).withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    return every.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
