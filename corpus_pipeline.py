"""Corpus pipeline: language, repeated lines, near copies, benchmark leaks, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each stage's result to the shared folder as Parquet and reads it again
as the next stage's ``docs``.  All stages but the last return the columns of
``documents``.  Languages and tokens have no SQL form, so ``ORACLE_SQL`` is
None; the tests hold the stages against brute force.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm import decontam, langid, lines, packing, simhash
from tremor.llm.common import drop_staged, fresh, stage_table
from tremor.llm.queries import MIN_LINES, WORD_VOCABULARY, table, vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; what the classifier rejects goes."""
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    found = fresh(docs, "_found")
    marked = docs.withColumn(found, langid.predict_column(model, F.col("text")))
    return marked.where(~F.col(f"{found}.rejected")).drop(found)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs leave the texts; a text that loses all its words goes."""
    found = fresh(docs, "_found")
    marked = lines.dedup_lines(docs, min_lines=MIN_LINES, found=found)
    changed = F.col(f"{found}.n_deleted") > 0
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        marked = marked.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return marked.where(~changed | (F.trim("text") != "")).drop(found)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one_of_each(docs, shingle=4, max_bits=4)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = fresh(docs, "_found")
    marked = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10, out=found)
    return marked.where(F.col(f"{found}.n_hit") == 0).drop(found)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents kept, placed in sequences of 2048 tokens."""
    return packing.pack_documents(docs, vocabulary(WORD_VOCABULARY))


STAGES = [
    ("language_id", language),
    ("line_dedup", repeated_lines),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("best_fit_packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_staged(before)
    return docs
