"""From documents to training sequences: quality rules, near duplicates, repeated passages, source weights, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All but the last return the
columns of documents: the first two drop rows, the third cuts passages out of texts (and drops texts that were nothing
else), the fourth drops and repeats rows. The last returns pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm.mixing import expand, planned_copies
from clickloom.llm.near import deduplicated
from clickloom.llm.packing import pack
from clickloom.llm.quality import good_documents
from clickloom.llm.suffixes import cut
from clickloom.llm.tables import prepare, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return deduplicated(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return cut(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return expand(planned_copies(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pack(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("mixing", mixing), ("packing", packing)]

#: robust estimates, sketches, Newton steps and token ids are beyond SQL; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
