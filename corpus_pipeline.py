"""Corpus pipeline: five of the training-data operators in a row, each over all that the one before kept.

Stages take (spark, docs, sf_dir) and return a DataFrame. All but the last return the columns of documents.

Cases: a null or empty text passes all stages and is packed as one end id. Rows with a null doc_id stay in every stage: they are
near-duplicates of nothing, lose no passage and take none from others, but go if toxic or contaminated. Repeated rows with one doc_id
are one document to the near-duplicate stage, so all of them stay or go. Further columns, whatever their names, go through to the last
stage, which returns pieces. Empty tables give an empty result. A document that substring removal has emptied stays, with its end id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rasterloom.llm import decontaminate, near_dedup, packing, substring_dedup, toxicity
from rasterloom.llm.common import as_table, remove_tables, tables_made


#: Documents whose sets of word shingles are so alike, in percent, are near-duplicates; op10_near_dedup has a limit of its own, 85.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest id stays."""
    return near_dedup.drop_near_duplicates(docs, percent=NEAR_PERCENT)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out of the text; every document stays."""
    return substring_dedup.remove_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", remove_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Classifier and tokenizer can't be said in SQL; tests hold run() against plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each result is written to the shared folder and read again, and all other tables go."""
    docs, mark = spark.read.parquet(f"{sf_dir}/documents.parquet"), tables_made()
    for name, stage in STAGES[:-1]:
        docs = as_table(stage(spark, docs, sf_dir), name)
        remove_tables(mark, but_last=True)
    return STAGES[-1][1](spark, docs, sf_dir)
