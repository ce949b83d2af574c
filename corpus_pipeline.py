"""A corpus pipeline over ``documents``: quality, near-duplicates, personal data, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet below
``spark.checkpoint.dir`` and read again as the documents of the next one. All but the last return the columns of
``documents``; the last returns one row of token counts and digests per document.

Defined results, beside those of the operators: documents with a null ``doc_id`` pass the filtering stages; an empty
table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import neardup, pii, queries
from gleaner.llm.common import by_ids
from gleaner.session import materialise, ship_package

#: The mixture takes this share of the tokens, each document at most once: the copies that went must not come back.
FRACTION = 0.9
EPOCHS = 1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    scores = queries.quality_scores(spark, sf_dir, docs)
    return by_ids(docs, scores.filter(F.col("score") < queries.ACCEPTED), "doc_id", "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return neardup.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of personal data in its place."""
    return pii.redact(docs, pii.learn(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes."""
    taken = queries.mixture(docs, fraction=FRACTION, epochs=EPOCHS)
    return by_ids(docs, taken.filter("copies = 0"), "doc_id", "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of all documents, encoded and decoded again."""
    return queries.bpe_digests(docs)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixture", mixture),
    ("tokens", tokens),
]
#: SQL can express neither the trained stages nor the tokenizer; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    ship_package(spark)
    folder = sf_dir.rstrip("/")
    docs = queries.table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, folder), name.replace(" ", "-"))
    return docs
