"""Registered queries of the text operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import conversation_repair, toxicity, vector_codes
from tidegrid.llm.decontamination import contaminated
from tidegrid.llm.jaccard_join import jaccard_components
from tidegrid.llm.main_text import extract
from tidegrid.llm.mixing import mixing_rates
from tidegrid.llm.license_scan import oracle, scan_licences
from tidegrid.llm.line_rules import line_rules
from tidegrid.llm.quality_classifier import fit, remainder, score
from tidegrid.llm.sharding import assign_shards
from tidegrid.llm.token_counts import count_tokens
from tidegrid.llm.url_filter import Rule, judge_urls

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document under piece_bpe_32k."""
    return count_tokens(table(spark, sf_dir, "documents"), "piece_bpe_32k.model", limit=4096)


URL_RULES = [
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: by rule, else by the language models."""
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES, ["page_id"])


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it gives away."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards of near equal bytes."""
    placed = assign_shards(table(spark, sf_dir, "documents"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


#: Wanted shares of tokens by domain.
TARGETS = {"good": 0.90, "poor": 0.05, "toxic": 0.05}


def domains(labels: DataFrame) -> DataFrame:
    """The domain that each label stands for: toxic first, else by quality."""
    told = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", told.alias("domain"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior and rate of every document for the target shares of tokens."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rates = mixing_rates(docs, domains(labels), TARGETS)
    names = sorted(TARGETS)
    return rates.select(
        "doc_id",
        F.col("mix_copies").alias("n_rows"),
        F.col("mix_tokens").alias("n_tokens"),
        *[F.col("mix_p")[i].alias(f"p_{name}") for i, name in enumerate(names)],
        F.col("mix_rate").alias("rate"),
    )


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the verdict of the cross-document line rule for every document."""
    docs = table(spark, sf_dir, "documents")
    return line_rules(docs, host="source").select(
        "doc_id",
        *["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_words_left"],
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a fifth of the keys is never trained on."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    seen = labels.where(remainder(F.col("doc_id")) != 0).select("doc_id", F.col("quality").alias("label"))
    odds = fit(docs.select("doc_id", "text"), seen)
    marked = docs.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "text")
    return score(marked, odds, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the documents under 4-word-shingle Jaccard of 0.85."""
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of every document."""
    return scan_licences(table(spark, sf_dir, "documents"), ["doc_id"])


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every usable embedding under 8 codebooks of 16 entries, with errors."""
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and checksum of the repaired text of every damaged conversation."""
    rows = table(spark, sf_dir, "conversations")
    plans, repaired = conversation_repair.repair(conversation_repair.damaged(rows), rows.select("conv_id"))
    sums = conversation_repair.checksums(repaired).withColumnRenamed("conv_id", "_conv")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return plans.join(sums, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        *plans.columns, F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; a fifth of the keys is never trained on."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    seen = labels.where(remainder(F.col("doc_id")) != 0).select("doc_id", F.col("toxic").alias("label"))
    weights = toxicity.fit(docs.select("doc_id", "text"), seen)
    marked = docs.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "text")
    return toxicity.score(marked, weights, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_url_filter": op2_url_filter,
    "op3_main_text": op3_main_text,
    "op4_decontamination": op4_decontamination,
    "op5_sharding": op5_sharding,
    "op6_mixing": op6_mixing,
    "op7_line_rules": op7_line_rules,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_license_scan": op10_license_scan,
    "op11_vector_codes": op11_vector_codes,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_toxicity": op13_toxicity,
}

ORACLES: dict[str, str] = {"op10_license_scan": oracle(), "op11_vector_codes": vector_codes.oracle()}
