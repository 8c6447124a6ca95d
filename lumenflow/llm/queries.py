"""Registered queries of the numbered operators: thin selections over their real outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenflow.llm import blockmax, bpe, ctxmix, decontaminate, dialogue, fim, fmindex, htmltext, minmax, secretscan, surrogates, warc, weaksupervision
from lumenflow.llm.oracle import STATEMENTS
from lumenflow.session import scratch_path

RANKS = "byte_bpe_50k.tiktoken"
#: The secret of the surrogates; a deployment gives its own.
SURROGATE_KEY = b"a key for tests and checks only"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One WARC record per page, read back, revisits resolved, deduplicated archives read back."""
    raw, slim = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc-dedup")
    warc.write_archives(_table(spark, sf_dir, "pages"), raw, "page_id", "html", "url")
    warc.write_deduplicated(spark, raw, slim, id_type="long", min_bytes=0)
    return warc.read_archives(spark, slim, payloads=False).select(
        F.col("source_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to_source").cast("long").alias("refers_to"),
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text and of the layers encoded inside it."""
    found = secretscan.scan_texts(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("spans", lambda s: s["layer"] == "")
    number = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in secretscan.KINDS],
        F.sha2(secretscan.listed(base).cast("binary"), 256).alias("base_sha256"),
        secretscan.listed(F.col("spans")).alias("spans"),
        "stopped",
    )


def op3_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, the base rules, and the posterior's verdict for every text."""
    voted = weaksupervision.with_votes(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    judged = weaksupervision.with_posterior(voted)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select(
        "doc_id",
        *weaksupervision.COUNTS,
        failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= weaksupervision.MIN_POSTERIOR)).alias("kept"),
        "posterior",
    )


def op4_fm_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every text when windows of 13 words stay in their first document only."""
    left = fmindex.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that each text holds, whole or a segment, within the edit budget."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.matches(docs, _table(spark, sf_dir, "benchmark")).drop("text")
    return found.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.size("leaks").cast("long").alias("n_items"),
        F.array_join(F.transform("leaks", lambda m: m["item_id"].cast("string")), ",").alias("item_ids"),
        F.array_min(F.transform("leaks", lambda m: m["edits"])).alias("least_edits"),
    )


def op6_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every text; the document that gives a component its id is kept."""
    found = minmax.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"), percent=minmax.PERCENT)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its personal data replaced, and the kinds and places of the replacements."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    done = surrogates.replace(docs, SURROGATE_KEY)
    spans = F.transform("entities", lambda e: F.concat_ws(":", e["kind"], e["start"], e["end"]))
    return done.select("doc_id", "text", F.size("entities").cast("long").alias("n_replaced"), F.array_join(spans, ",").alias("replaced"))


def op8_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text under unigrams and under context mixing."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return ctxmix.score(docs, "crc32(cast(doc_id AS string)) % 7 != 2")


def op9_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = htmltext.extract(pages).drop("html")
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the bytes that they decode to, as digests."""
    vocabulary = bpe.Vocabulary(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, vocabulary, decoded="decoded").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_block_max_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest integer inner products of every 50th vector with all others."""
    return blockmax.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text cut twice and put in its drawn form, and the text rebuilt from that."""
    done = fim.transform(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restored().cast("binary"), 256).alias("restored_sha256"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults put into every conversation, the cheapest repair of each, and a digest of the repaired text."""
    rows = dialogue.damaged(_table(spark, sf_dir, "conversations"))
    return dialogue.summary(*dialogue.repair(rows, F.col("present")))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    numbered = (
        op1_warc_revisits,
        op2_secret_scan,
        op3_weak_supervision,
        op4_fm_index_dedup,
        op5_benchmark_decontamination,
        op6_minmax_near_dedup,
        op7_pii_surrogates,
        op8_context_mixing,
        op9_html_main_text,
        op10_byte_bpe,
        op11_block_max_top_k,
        op12_fill_in_middle,
        op13_conversation_repair,
    )
    return {f.__name__: f for f in numbered}


def statements() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express at a bearable cost."""
    return dict(STATEMENTS)
