"""A corpus pipeline: five stages over ``documents``, each one an llm operator.

quality          the classifier's rejects go
near_duplicates  one document of each near-duplicate group stays (five-word shingles, 0.8)
decontamination  documents contaminated by ``benchmark`` go
mixing           documents are repeated or left out to meet the sources' targets
token_output     the rest is written as token-ID files, whose digests are the result

Every stage is written as Parquet in the shared checkpoint folder and read
again as the next one's input.  All but the last return the columns of
``documents``, and the documents they keep unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm.decontaminate import drop_contaminated
from tarmac.llm.mixing import mix
from tarmac.llm.near_duplicates import keep_one_of_each
from tarmac.llm.quality_classifier import keep_quality
from tarmac.llm.tables import ship, table, written
from tarmac.llm.token_output import tokenised

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as 1; it learns from ``labels``."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document of the smallest id."""
    ship(spark)
    return keep_one_of_each(docs, shingle_words=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark phrases."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them (zero to two times)."""
    ship(spark)
    return mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the files."""
    ship(spark)
    return tokenised(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: No SQL: the classifier is a trained model and the files hold a tokenizer's ids.
#: tests/llm checks each stage against brute force on the stage's own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
