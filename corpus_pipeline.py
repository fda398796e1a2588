"""A training-data pipeline over documents: every stage is one of the library's operators.

Each stage takes (spark, docs, sf_dir) and returns the columns of documents, the last one also the
shard and the place in it. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcount.llm import decontam, interleave, langid, poisson_mix, simhash
from shelfcount.session import durable

#: Least share of the score that the predicted language must have among four languages or fewer. Among more it
#: is this multiple of an even share, which is the same among four.
MIN_SCORE = 0.4
EVEN_SHARES = 1.6


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a recognised language: not ``und`` and at least MIN_SCORE (less among many languages).

    Null and empty texts and texts without letters go; all else about nulls, ties and repeated
    rows is as in ``langid.identify``. An empty table stays empty.
    """
    model = langid.fit(langid.training_rows(docs))
    scored = langid.identify(docs, model, pred="__lang", score="__score")
    least = min(MIN_SCORE, EVEN_SHARES / max(1, len(model.languages)))
    accepted = (F.col("__lang") != langid.UNKNOWN) & (F.col("__score") >= least)
    return scored.where(accepted).drop("__lang", "__score")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component (``simhash.keep_one``)."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out of the texts (``decontam.remove_leaks``); wholly covered documents go."""
    return decontam.remove_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents to the target weights, which level the sources' sizes by a square root, and shuffles."""
    return poisson_mix.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the documents into shards that match the mixture (``interleave.interleaved``)."""
    return interleave.interleaved(docs)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]

#: The stages hash texts and walk graphs, which SQL here cannot express; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written in the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = durable(docs)
    return docs
