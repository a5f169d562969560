"""A training-data pipeline over ``documents``: five stages, each one operator.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet in the shared folder
and read again as the next one's ``docs``.  All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setbook.llm import decontaminate, exact_dedup, near_dedup, quality, sentence_pieces
from setbook.llm.common import stored, whole_text
from setbook.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.keep_good(docs, quality.fit(docs, quality.quality_labels(spark, sf_dir)))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each text."""
    return exact_dedup.keep_first(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.keep_one_of_each(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold an item of ``benchmark``."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def sentence_piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece_ids, n_pieces, and whether decoding gives the text back."""
    path = sentence_pieces.default_model()
    # smaller tables than by default, beside executors whose heap the stages before have filled
    rows = sentence_pieces.round_trip(docs.select("doc_id", "text"), path, memo_words=80_000)
    return rows.select("doc_id", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"),
                       (F.col("back") == whole_text()).alias("round_trip"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontaminate_stage),
    ("sentence_pieces", sentence_piece_stage),
]

# the classifier, the verified similarities and the edit distances cannot be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
