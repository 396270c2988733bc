"""From raw documents to packed training sequences: five stages, each an operator of the library.

A stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next
stage's `docs`. All but the last return the columns of documents.

Defined cases, for every stage: a null text counts as empty; a null key, language or source is a value
of its own; an empty table gives an empty one; extra columns are passed on by all stages but the last,
whatever their names. Of rows that agree in key and text one is left after exact_dedup.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.exact_dedup import drop_copies
from tablewright.llm.mixing import TEMPER, mixed
from tablewright.llm.near_dedup import drop_near_copies
from tablewright.llm.packing import pack
from tablewright.llm.toxicity import keep_clean
from tablewright.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below the threshold of their language, rows as they are. An empty
    text scores as the network's output without any word."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the largest key; empty texts are one group."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the smallest key; a text without words is a
    class of its own."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of a mix in which a source's weight is its share of all characters
    to the power `TEMPER`."""
    return mixed(docs, temper=TEMPER)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents; each source's queue keeps the order of the mix, which is the
    order of the rows in the files. Tables that are not read from files go by hash."""
    try:
        file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
        docs.select(file, row)
    except AnalysisException:
        return pack(docs)
    return pack(docs, slice_by=file, order_by=row)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mixing", mixing), ("packing", packing)]

#: The first stage is a trained network, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
