"""The corpus pipeline: documents that the quality classifier accepts, one of each
group of equal texts, one of each group of SimHash neighbours, mixed to target
weights, packed into sequences.

Each stage is (name, function of (spark, docs, sf_dir)); all but the last return
the columns of ``documents``.  ``run`` writes every stage's result to the shared
folder and reads it back, so a lost executor never repeats an earlier stage.
Stages that run Python bound the size of the batches they send it.

Rows of ``documents`` with null or empty text are scored, compared and packed like
any other; an empty table gives an empty result of every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstream.llm.common import free_name, quoted, table
from trendstream.llm.exact_dedup import drop_exact_duplicates
from trendstream.llm.mixing import mixed_documents
from trendstream.llm.packing import pack
from trendstream.llm.quality import fit, with_scores
from trendstream.llm.queries import tokenizer_path
from trendstream.llm.simhash import drop_near_duplicates
from trendstream.session import bound_batches, materialize, ship_package

ACCEPT = 0.3
MIX = {"clean": 0.96, "toxic": 0.04}


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least ACCEPT."""
    bound_batches(spark)
    logits = fit(docs, table(spark, sf_dir, "labels"))
    score = free_name("__quality", docs.columns)
    scored = with_scores(docs, logits, out=score)
    return scored.filter(F.col(score) >= ACCEPT).select(*[F.col(quoted(c)) for c in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints at most two bits apart (3-word shingles)."""
    bound_batches(spark)
    return drop_near_duplicates(docs, words=3, radius=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the rates fitted to MIX say."""
    return mixed_documents(docs, table(spark, sf_dir, "labels"), MIX)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    bound_batches(spark)
    return pack(docs, tokenizer_path(), window=2048, end_id=1)


STAGES = [("quality", accept), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mixing", mixing), ("packing", packing)]

# Learned scores, XXH64 fingerprints and the tokenizer's ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
