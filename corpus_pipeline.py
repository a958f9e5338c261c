"""The corpus pipeline: quality, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and its result is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.catalog import TARGETS, domains, table
from tidegrid.llm.decontamination import without_contaminated
from tidegrid.llm.jaccard_join import without_copies
from tidegrid.llm.mixing import mix, mixing_rates
from tidegrid.llm.quality_classifier import fit, score
from tidegrid.llm.sharding import assign_shards
from tidegrid.llm.storage import staged

SHARDS = 24
LEAST_SCORE = 0.3
#: Near copies share 0.8 of their shingles of five words at least.
WORDS, NUM, DEN = 5, 80, 100

#: No SQL: the first stage trains a model.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    odds = fit(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    scored = score(docs, odds, docs.columns)
    return scored.where(F.col("score") >= LEAST_SCORE).drop("score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies, and every row without a word."""
    return without_copies(docs, words=WORDS, num=NUM, den=DEN)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that give no benchmark item away."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of domains over their target share thinned to it; nothing comes twice."""
    return mix(docs, mixing_rates(docs, domains(table(spark, sf_dir, "labels")), TARGETS, most=1.0))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of every row."""
    return assign_shards(docs, SHARDS)


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a table in the shared folder between any two."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
