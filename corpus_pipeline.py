"""A corpus pipeline: quality, toxicity, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows as Parquet into the shared
folder and gives them to the next. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridjobs.llm import ngram_join, packing, quality_mil, toxicity_knn
from gridjobs.llm.common import table, whole, written
from gridjobs.llm.queries import QUALITY_AT, TOXIC_AT


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. It is learned from the documents at hand and their labels."""
    model = quality_mil.learn(docs, table(spark, sf_dir, "labels"))
    return quality_mil.filter_documents(docs, model, QUALITY_AT)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled examples don't call toxic."""
    model = toxicity_knn.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity_knn.filter_documents(docs, model, TOXIC_AT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links hold together: that of the smallest doc_id.

    Of several texts of that doc_id in the group, or of a group without any doc_id, the text of the least digest stays. Rows
    that repeat a doc_id with the same text (null: empty) stay one. Texts without words link with nothing and stay.
    """
    name = "row_id"
    while name in docs.columns:
        name += "_"
    digest = F.unhex(F.md5(F.concat_ws(":", F.col("doc_id").isNull().cast("string"), F.col("doc_id").cast("string"), whole(F.col("text")))))
    rows = docs.withColumn(name, digest)
    found = ngram_join.join(docs, row=digest).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = found.filter("component IS NOT NULL").groupBy("component").agg(F.min("row_id").alias(name)).select(name)
    kept = kept.union(found.filter("component IS NULL").select("row_id"))
    # repeated rows meet before the join, map-side first, in the layout that the join needs: one shuffle of the texts
    return rows.dropDuplicates([name]).join(kept, name, "left_semi").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    return packing.pack(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("packing", pack)]

#: SQL can express none of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = reduce(lambda d, stage: written(stage[1](spark, d, sf_dir), f"pipeline-{stage[0]}"), STAGES[:-1], docs)
    return STAGES[-1][1](spark, docs, sf_dir)
