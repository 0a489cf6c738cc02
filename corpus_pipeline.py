"""A corpus made ready for training: language, repeated lines, near-duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read again
as the next stage's documents. All but the last give the columns of documents. Rows that a stage keeps are
unchanged, except that the line stage shortens texts (and n_chars with them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import table, tokenizer_path
from tallyward.llm.decontaminate import decontaminate
from tallyward.llm.language import UNKNOWN, language_id
from tallyward.llm.linededup import dedup_lines
from tallyward.llm.packing import pack_documents
from tallyward.llm.setsketch import representatives
from tallyward.plans.durable import durable

# A language must win all its contests; the score is then above a half.
LEAST_SCORE = 0.5


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a learned language; a null text, or one without a letter, goes."""
    found = language_id(docs)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; documents of which nothing is left go."""
    found = dedup_lines(docs)
    left = found.where((F.col("removed_lines") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        cut = F.length("text").cast(docs.schema["n_chars"].dataType)
        left = left.withColumn("n_chars", F.when(F.col("removed_lines") > 0, cut).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: the one with the smallest id, and of rows that repeat
    that id the first by their text's hash. A document without a word is in no group."""
    return representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in training sequences."""
    return pack_documents(docs, tokenizer_path(), with_ids=False)


STAGES = [
    ("language", in_a_language),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

# Language, sketches and subword ids have no SQL twin. tests/llm holds the operator of each stage against a brute-force version
# or held-out rows; run() as a whole is only checked to end with rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name)
    return docs
