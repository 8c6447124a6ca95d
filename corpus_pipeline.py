"""From raw documents to token ids: quality, near duplicates, leaks, personal data, encoding.

Each stage takes all that the one before kept, is written as Parquet in the shared
folder and read again. All but the last return the columns of ``documents``.
Every stage calls one operator of ``lumenflow.llm``, whose module tells how nulls, empty
and very long texts, repeated rows and empty tables come out. Working columns have names
with two leading underscores, so columns of the input keep theirs.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.llm import bpe, decontaminate, minmax, surrogates, weaksupervision
from lumenflow.llm.queries import RANKS, SURROGATE_KEY
from lumenflow.session import scratch_path

#: Near duplicates of the pipeline: shingles of five words, similarity 0.8 or more.
NEAR_PERCENT = 80
#: SQL can't express an EM fit, confirmed near duplicates, alignments or BPE; the tests hold the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior probability of being good is at least a half."""
    voted = weaksupervision.with_votes(docs, votes="__votes", prefix="__")
    judged = weaksupervision.with_posterior(voted, votes="__votes", posterior="__good")
    return judged.where(F.col("__good") >= weaksupervision.MIN_POSTERIOR).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate component; of rows with one id, one; null ids stay."""
    found = minmax.near_duplicates(docs, percent=NEAR_PERCENT)
    kept = found.where("doc_id = component_id").select("doc_id").distinct().hint("merge")
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).union(docs.where("doc_id IS NULL")).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    found = decontaminate.matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), output="__leaks")
    return found.where(F.size("__leaks") == 0).select(docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced, n_chars counted again."""
    done = surrogates.replace(docs, SURROGATE_KEY, entities="__entities")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with n_tokens and ids (little-endian uint32), text being what the ids decode to."""
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    done = bpe.encode(docs, vocabulary, ids="ids", decoded="__decoded").withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))
    return done.withColumn("text", F.col("__decoded").cast("string")).drop("__decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def statements() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
