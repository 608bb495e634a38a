"""Documents to training sequences, stage by stage.

Every stage takes what the one before kept, as a table that it can read again, and all but the last return the columns
of documents. A document that a stage empties stays, as an empty text; ``n_chars``, where there is one, follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import language
from tickloom.llm.near_dup import keep_one
from tickloom.llm.pii import Detector, redact
from tickloom.llm.queries import packed
from tickloom.llm.store import Workspace, ready
from tickloom.llm.suffix_dedup import cut_repeats


def _measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or as near to one language as to another, go."""
    ready(spark)
    return language.accepted(docs, language.profiles(docs.where("doc_id is not null").where(~language.held_out())))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the smallest doc_id stays, once."""
    ready(spark)
    return keep_one(docs)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that start twice are cut wherever they are."""
    ready(spark)
    return _measured(cut_repeats(docs))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets."""
    ready(spark)
    return _measured(redact(docs, Detector().fit(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens."""
    ready(spark)
    return packed(docs)


STAGES = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("repeated strings", cut_repeated_strings),
    ("personal data", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL can express neither the language profiles nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written as Parquet and read again."""
    space = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = space.save(stage(spark, docs, sf_dir), f"stage_{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
