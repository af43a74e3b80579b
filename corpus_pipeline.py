"""A training-data pipeline over ``documents``: each stage keeps, cleans or weighs documents.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns the
documents it leaves. ``run`` writes every stage's result as Parquet in the shared folder and
reads it back as the next stage's input, so a lost executor costs at most one stage and no
stage's plan depends on the one before.

1. toxicity: documents that score at or above the threshold go.
2. line dedup: lines on many sites go, but for their first place; documents left empty go.
3. near dedup: one document of each group of near duplicates stays; then lines of more than 50
   words that stand in several of the documents left go, but for their first place.
4. decontamination: documents that hold a benchmark item go.
5. mixing: sources are weighed; ``mix_words`` says how many words of a document are taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.llm.common import staged, table
from terrace.llm.decontaminate import remove
from terrace.llm.line_dedup import remove_boilerplate, remove_passages
from terrace.llm.mixing import mix
from terrace.llm.near_dedup import deduplicate
from terrace.llm.toxicity import keep_clean
from terrace.session import use_local_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    use_local_folder(spark)
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    use_local_folder(spark)
    return remove_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    use_local_folder(spark)
    # After the near copies are gone, as it would leave rests of them.
    return remove_passages(staged(deduplicate(docs), "pipeline-distinct"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    use_local_folder(spark)
    return remove(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    use_local_folder(spark)
    return mix(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# The toxicity stage is a trained classifier, which SQL cannot express; the stages are tested
# against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_local_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
