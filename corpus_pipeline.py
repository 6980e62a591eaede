"""The corpus pipeline: quality, near-duplicates, decontamination, secrets, packing, over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` stores it as Parquet in the shared
folder and the next stage reads that.

Cases, in every stage: a null or blank text is a document without words; rows that repeat and rows with a null
doc_id are documents of their own until near-duplicates go; texts of any length are taken whole; columns beyond
doc_id and text, whatever their names, stay as they are (``n_chars`` follows the text); an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import stored, table
from ticketloom.llm.decontaminate import drop_contaminated
from ticketloom.llm.packing import pack_documents
from ticketloom.llm.quality import keep_good, train
from ticketloom.llm.secrets import masked
from ticketloom.llm.simhash import keep_first


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It is fitted on these documents' labelled rows.

    Texts without words are scored like any other; without labelled rows of both kinds all documents stay.
    """
    return keep_good(docs, train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id.

    Texts without words are one group. Rows with a null doc_id come after all others of their group.
    """
    return keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items, as they are; without words none is."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found in their texts masked; a null text stays null."""
    return masked(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens; a document without text is its end token."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secret scans", secrets),
    ("packing", pack),
]

#: A learned model and differencing have no SQL form; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
