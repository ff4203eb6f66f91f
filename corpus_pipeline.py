"""Training-corpus pipeline: language ID, n-gram Jaccard join (one document of
each group stays), benchmark decontamination, mixing to target weights,
sharding.  Every stage takes the documents its predecessor kept; all but the
last return the columns of ``documents``."""

from pyspark.sql import DataFrame, SparkSession

from stratus.llm.common import table, written
from stratus.llm.decontaminate import clean_documents
from stratus.llm.language_id import known_language
from stratus.llm.mixing import mix
from stratus.llm.ngram_jaccard import one_per_group
from stratus.llm.sharding import shard_documents
from stratus.session import job


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group stays, with the smallest id; null ids come last.
    Groups are of texts: an id with several texts can stay with some of them."""
    return one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

#: The fitted language model and the drawn matrix have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with job(spark) as held:  # a stage's own tables go once its result is written
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
            held.hand_over()
    return STAGES[-1][1](spark, docs, sf_dir)
