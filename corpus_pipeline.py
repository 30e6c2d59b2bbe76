"""A training-data pipeline over ``documents``: quality, near copies, repeated passages, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fringeframe.llm.bpe import bpe_round_trip, tokenizer_file
from fringeframe.llm.decontaminate import find_benchmark_passages
from fringeframe.llm.near_copies import near_copy_groups, row_keys
from fringeframe.llm.pu_quality import score_quality
from fringeframe.llm.queries import learnable, table
from fringeframe.llm.simhash import simhash_groups
from fringeframe.llm.storage import remove, scratch, shared_folder
from fringeframe.llm.window_dedup import remove_repeated_windows

#: Rows of a batch, and bytes of text of a block, that a Python worker holds at once.
BATCH_ROWS, BLOCK_BYTES = 1000, 4 << 20
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be of quality; null and empty texts have their score like any other,
    rows stand alone, an empty table stays empty."""
    _, learn = learnable(5, 0)
    scored = score_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), learn, carry=COLUMNS)
    return scored.where("predicted = 1").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies: the one of the smallest doc_id, and of its rows without a doc_id the
    first too.  Two rows are near copies if their SimHash fingerprints of five-word shingles, repeats counted, differ in
    at most 3 bits, joined by vantage-point trees, or if their sets of shingles have an exact Jaccard similarity of 0.8.
    Texts without words are copies of each other only; rows of one doc_id are told apart by their place in the files."""
    rows = row_keys(docs.select(*COLUMNS))
    worded = rows.where(F.col("text").rlike(r"[^ \t-\r]"))
    close = simhash_groups(worded.select(F.col("row_key").alias("doc_id"), "text"), radius=3, shingle=5)
    joined = close.select(F.col("doc_id").alias("row_key"), F.col("component_id").alias("other")).where("row_key <> other")
    grouped = near_copy_groups(rows.select("row_key", "text"), joined=joined)
    known = rows.select("row_key", "doc_id").join(grouped, "row_key")
    first = known.groupBy("component", F.col("doc_id").isNull().alias("nameless")).agg(F.min(F.struct("doc_id", "row_key")).alias("best")).select("best.row_key")
    return rows.join(first, "row_key", "left_semi").select(*COLUMNS)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that occur earlier; those that lose every word go.  Texts that lose none,
    null and empty ones among them, stay as they are; of repeated rows one keeps its words."""
    cut = remove_repeated_windows(docs, width=20, carry=COLUMNS, block_bytes=BLOCK_BYTES)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    kept = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return kept.select("doc_id", text.alias("text"), "lang", "source", F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage, judged row by row, whatever their doc_id; null texts hold none."""
    rows = row_keys(docs.select(*COLUMNS))
    held = find_benchmark_passages(rows.select("row_key", "text"), table(spark, sf_dir, "benchmark"), key="row_key").select("row_key").distinct()
    return rows.join(held, "row_key", "left_anti").select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text, a row for every row; a null text has no tokens."""
    return bpe_round_trip(docs, tokenizer_file(spark), carry=["doc_id", "lang", "source"], digests=True)


def _in_small_batches(stage):
    """The stage with at most ``BATCH_ROWS`` rows sent to a Python worker at once: five stages share the executors,
    and a worker keeps the memory of its largest batch."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("quality_classifier", _in_small_batches(quality)),
    ("simhash_near_dedup", _in_small_batches(near_dedup)),
    ("substring_dedup", _in_small_batches(passage_dedup)),
    ("benchmark_decontamination", _in_small_batches(decontaminate)),
    ("bpe_round_trip", _in_small_batches(tokenize)),
]

#: No SQL expresses the classifier or the components of near copies; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; what came before is removed."""
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        before, path = path, f"{shared_folder(spark).rstrip('/')}/fringeframe-{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}-{name}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs = spark.read.parquet(path)
    return docs
