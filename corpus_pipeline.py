"""Documents to packed training sequences in five stages.

quality classifier -> line dedup -> near-duplicate removal -> source mixing -> packing

Each stage takes (spark, docs, sf_dir), where ``docs`` has the columns of ``documents`` and
is what the stage before kept, written as Parquet. All but the last return such columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import materialize, table
from llm.line_dedup import remove_shared_lines
from llm.mixing import take_words
from llm.near_dedup import keep_one_of_each
from llm.packing import pack_documents
from llm.quality import score_documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``, with the length of the text as it is now."""
    return df.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the classifier doesn't reject; texts are as before."""
    scored = score_documents(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take lines that many sites share out of all but their first document. Documents stay."""
    return _documents(remove_shared_lines(docs.select(*COLUMNS)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the least doc_id, of each group of near-duplicates."""
    return keep_one_of_each(docs.select(*COLUMNS)).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat, cut and leave out documents as the mix takes their words."""
    return _documents(take_words(docs.select(*COLUMNS)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: Seeded hashes, learnt weights and tokens aren't SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
