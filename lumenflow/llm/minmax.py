"""Near-duplicate texts by min-max hashing of word shingles.

A text's sketch keeps both the smallest and the largest hash of its shingles under
each permutation, so a permutation that is evaluated once gives two matches, each
with the texts' Jaccard similarity as its probability. A band is the two extremes
of two permutations: 40 permutations make 20 bands of four values, and two texts of
similarity 0.85 share no band once in 2.5 million times.

The steps, each a Spark job over all rows:

1. Texts with equal shingle sets become one representative, the smallest id
   (a combining aggregate, however many copies there are).
2. In each bucket of a band the smallest id is the hub; each other member is
   paired with it, so a bucket of n members makes n - 1 pairs.
3. Pairs are confirmed on the full sets, which are built again from the texts
   of those documents that share a bucket with another.
4. Connected components of the links: alternating large and small stars. Then
   the same with another hub per bucket, the member with the least share of
   shingles that no other candidate has, which is the likeliest original.
5. Members of a bucket that are still in different components are compared too, so
   that no link that bypasses both hubs is lost. Before that, an exact bound removes
   what can't link: shingles that no other candidate has can't be shared, so with
   c shingles that some other candidate has, a text has at most c in common. And a
   512-bit sketch (one bit of both extremes of 256 more permutations) must agree
   in the 447 bits that a link misses once in 100,000 times. A pair is made in
   the least of the buckets that it shares only.
6. Components again, with all links.

Hubs and copies can be hot: groups are elected by aggregates that combine in the
map tasks, and joins on them are plain shuffle joins that Spark splits.

Defined results: a null or empty text, or one without words, has an empty set and is
linked with nothing; a text shorter than a shingle is one shingle; rows that repeat an id
all get that id's verdict; a null id is linked with nothing; an empty table gives
an empty table; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenflow.llm import textops as t
from lumenflow.session import scratch_path

SHINGLE = 5
PERMUTATIONS = 40
BAND_PERMUTATIONS = 2
#: Permutations of the bit sketch, and bits that must agree: 4.4 standard deviations below the mean at similarity 0.85.
SKETCH_PERMUTATIONS, SKETCH_DEVIATIONS = 256, 4.4
#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 85
SEED = 20_240_229


def permutations(n: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, 1 << 64, n, dtype=np.uint64)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): each row's distinct shingle hashes, ascending; a shorter text is one shingle."""
    data, offsets = t.buffer(column, lower=True)
    starts, ends, first = t.words(data, offsets)
    hashes = t.span_hashes(data, starts, ends)
    n = len(offsets) - 1
    h, _, row = t.windows(hashes, first, size)
    count = np.diff(first)
    parts, rows = [h], [row]
    for k in range(1, size):
        short = np.flatnonzero(count == k)
        whole = np.full(len(short), k, np.uint64)
        for i in range(k):
            whole = t.mix(whole * np.uint64(5) + hashes[first[short] + i])
        parts.append(whole)
        rows.append(short)
    h, row = np.concatenate(parts), np.concatenate(rows)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[fresh], row[fresh]
    return h, np.searchsorted(row, np.arange(n + 1))


def signatures(h: np.ndarray, bounds: np.ndarray, n: int = PERMUTATIONS) -> np.ndarray:
    """Rows of (min, max) under each permutation; rows of empty sets are of no use."""
    full = np.flatnonzero(np.diff(bounds) > 0)
    out = np.zeros((len(bounds) - 1, n, 2), np.uint64)
    if len(full):
        at = bounds[full]
        for i, (a, b) in enumerate(zip(*permutations(n))):
            p = h * a + b
            out[full, i, 0] = np.minimum.reduceat(p, at)
            out[full, i, 1] = np.maximum.reduceat(p, at)
    return out


def band_hashes(signature: np.ndarray, per_band: int = BAND_PERMUTATIONS) -> np.ndarray:
    """One hash per row and band; equal bands of different numbers differ."""
    rows, n, _ = signature.shape
    values = signature[:, : n - n % per_band].reshape(rows, n // per_band, 2 * per_band)
    h = np.broadcast_to(np.arange(1, n // per_band + 1, dtype=np.uint64), values.shape[:2])
    for k in range(values.shape[2]):
        h = t.mix(h * np.uint64(3) + values[:, :, k])
    return h


def _arrow_lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(t.signed(values)))


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n (set size), set_a and set_b (a hash of the set), bands (empty for an empty set)."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b in t.slices(batch.column(1)):
                h, bounds = shingle_sets(batch.column(1).slice(a, b - a))
                n = np.diff(bounds)
                bands = band_hashes(signatures(h, bounds))
                bands = bands[n > 0]
                at = np.concatenate([[0], np.cumsum(np.where(n > 0, bands.shape[1], 0))])
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(t.mix(h ^ np.uint64(k)), dtype=np.uint64)]) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(n.astype(np.int64)),
                        *[pa.array(t.signed(s[bounds[1:]] - s[bounds[:-1]])) for s in sums],
                        _arrow_lists(bands.ravel(), at),
                    ],
                    names=["id", "n", "set_a", "set_b", "bands"],
                )
        t.settle()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, n long, set_a long, set_b long, bands array<long>"
    )


def bit_sketches(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One bit of the min and of the max under each permutation, 64 to a word."""
    full = np.flatnonzero(np.diff(bounds) > 0)
    bits = np.zeros((len(bounds) - 1, 2 * SKETCH_PERMUTATIONS), np.uint8)
    if len(full):
        for i, (a, b) in enumerate(zip(*permutations(SKETCH_PERMUTATIONS, SEED + 1))):
            p = h * a + b
            for j, extreme in enumerate((np.minimum, np.maximum)):
                bits[full, 2 * i + j] = t.mix(extreme.reduceat(p, bounds[full])) & np.uint64(1)
    return np.packbits(bits, axis=1).view(np.uint64)


def sketch_threshold(percent: int) -> int:
    """Equal bits that a pair at the link threshold has but for rare chance; a bit is equal with probability (1 + J) / 2."""
    n, p = 2 * SKETCH_PERMUTATIONS, (1 + percent / 100) / 2
    return int(n * p - SKETCH_DEVIATIONS * (n * p * (1 - p)) ** 0.5)


def full_sets(docs: DataFrame) -> DataFrame:
    """id, n, shingles (all, ascending), bits (the sketch) of (id, text)."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b in t.slices(batch.column(1)):
                h, bounds = shingle_sets(batch.column(1).slice(a, b - a))
                bits = bit_sketches(h, bounds)
                words = np.arange(b - a + 1) * bits.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(bounds)), _arrow_lists(h, bounds), _arrow_lists(bits.ravel(), words)],
                    names=["id", "n", "shingles", "bits"],
                )
        t.settle()

    return docs.select("id", "text").mapInArrow(run, f"id {id_type}, n long, shingles array<long>, bits array<long>")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of the links (a, b); a component is its smallest node.

    Large stars join the larger neighbours of a node to its smallest one, small
    stars its smaller neighbours; both keep components together, and the edges
    end up as stars around the smallest nodes.
    """
    least = lambda df: df.groupBy("u").agg(F.min("v").alias("low"))
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = staged(edges, "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(least(both).withColumn("low", F.least("u", "low")), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .where("u != v")
            .distinct()
        )
        large = staged(large, "large-stars")
        low = least(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).union(low.select("u", F.col("low").alias("v")))
        edges = staged(small.where("u != v").distinct(), "small-stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links on their full sets."""
    side = lambda k: sets.select(F.col("id").alias(k), F.col("n").alias(f"n_{k}"), F.col("shingles").alias(f"s_{k}"))
    shared = F.size(F.array_intersect("s_a", "s_b")).cast("long")
    return (
        pairs.join(side("b"), "b")
        .join(side("a"), "a")
        .withColumn("shared", shared)
        .where(F.lit(100) * F.col("shared") >= F.lit(percent) * (F.col("n_a") + F.col("n_b") - F.col("shared")))
        .select("a", "b")
    )


def _may_link(n_a: Column, n_b: Column, most_shared: Column, percent: int) -> Column:
    """Whether an intersection of ``most_shared`` would make a link."""
    return F.lit(100) * most_shared >= F.lit(percent) * (n_a + n_b - most_shared)


def _apart(members: DataFrame, able: DataFrame, links: DataFrame) -> DataFrame:
    """The able members, with their components, of the buckets that hold several components."""
    joined = components(links)
    found = (
        members.select("bucket", "rep", "n")
        .join(able, "rep")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    mixed = found.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("bucket")
    return found.join(mixed, "bucket", "left_semi")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id_col, n_shingles, component_id) for each row of ``docs``."""
    sketched = staged(sketches(docs, id_col, text_col), "sketches")
    same_set = ["set_a", "set_b", "n"]
    reps = sketched.where("n > 0 AND id IS NOT NULL").groupBy(*same_set).agg(F.min("id").alias("rep"), F.first("bands").alias("bands"))
    reps = staged(reps, "representatives")

    in_bands = reps.select("rep", "n", F.explode("bands").alias("bucket"))
    hubs = in_bands.groupBy("bucket").agg(F.min(F.struct("rep", "n")).alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1")
    members = staged(in_bands.join(hubs.select("bucket", "hub"), "bucket"), "members")
    starred = (
        members.where(F.col("rep") != F.col("hub.rep"))
        .where(_may_link(F.col("n"), F.col("hub.n"), F.least("n", "hub.n"), percent))
        .select(F.col("hub.rep").alias("a"), F.col("rep").alias("b"))
        .distinct()
    )
    candidates = members.select("rep").distinct().hint("merge")  # the same plan at every size
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(candidates, F.col("id") == F.col("rep"), "left_semi")
    sets = staged(full_sets(texts), "sets")
    links = staged(confirmed(starred, sets, percent), "star-links")

    lone = (
        sets.select("id", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("texts"), F.min("id").alias("id"))
        .where("texts = 1")
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("lone"))
    )
    shared_buckets = members.groupBy("rep").agg(F.collect_list("bucket").alias("buckets"))  # one per band at most
    able = sets.join(lone, "id", "left").join(shared_buckets, F.col("id") == F.col("rep")).select(
        "rep", "bits", "buckets", (F.col("n") - F.coalesce("lone", F.lit(0))).alias("common")
    )
    able = staged(able.where(F.lit(100) * F.col("common") >= F.lit(percent) * F.col("n")), "able")

    central = staged(_apart(members, able.drop("bits", "buckets"), links), "apart")
    share = F.col("common") / F.col("n")
    hub = central.groupBy("bucket").agg(F.max(F.struct(share.alias("share"), "rep", "n", "common", "component")).alias("hub"))
    to_central = (
        central.join(hub, "bucket")
        .where(F.col("component") != F.col("hub.component"))
        .where(_may_link(F.col("n"), F.col("hub.n"), F.least("common", "hub.common"), percent))
        .select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b"))
        .distinct()
    )
    links = links.union(staged(confirmed(to_central, sets, percent), "central-links"))

    apart = staged(_apart(members, able, links), "apart")
    side = lambda k: apart.select("bucket", F.col("rep").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in ("n", "common", "component", "bits", "buckets")])
    equal_bits = sum((F.lit(64) - F.bit_count(F.col("bits_a")[i].bitwiseXOR(F.col("bits_b")[i])) for i in range(SKETCH_PERMUTATIONS // 32)), F.lit(0))
    bypassing = (
        side("a")
        .join(
            side("b").withColumnRenamed("bucket", "bucket_b"),
            (F.col("bucket") == F.col("bucket_b"))
            & (F.col("a") < F.col("b"))
            & (F.col("component_a") != F.col("component_b"))
            & _may_link(F.col("n_a"), F.col("n_b"), F.least("common_a", "common_b"), percent)
            & (equal_bits >= sketch_threshold(percent))
            & (F.array_min(F.array_intersect("buckets_a", "buckets_b")) == F.col("bucket")),
        )
        .select("a", "b")
        .distinct()
    )
    links = links.union(staged(confirmed(bypassing, sets, percent), "more-links"))
    final = staged(components(links), "components")

    group = reps.join(final, F.col("rep") == F.col("node"), "left").select(*same_set, F.coalesce("component", "rep").alias("group"))
    return sketched.join(group, same_set, "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("group")).otherwise(F.col("id")).alias("component_id"),
    )
