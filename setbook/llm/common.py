"""Helpers shared by the document operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable
from typing import Any
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_at_end, delete_now, ensure_checkpoint_dir
from ..sources.tables import read_table

# fixed value: the white space of the contracts, as a Java regex class
SPACE = r"[\x20\x09-\x0D]"

# a Parquet writer holds one row group, and a reader takes at most one at a time; every core runs one of them
ROW_GROUP_BYTES = 16 << 20
ARROW_BATCH_BYTES = 4 << 20

# whether Spark removes an execution's shuffle files at its end; else they stay until the driver happens to collect its garbage
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# where stored tables are
_STORED: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``documents`` that the operators use."""
    return read_table(spark, sf_dir, "documents", ["doc_id", "text"])


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared checkpoint folder; it goes when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    delete_at_end(spark, path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read again.

    Cuts the lineage: a lost executor re-reads files instead of recomputing
    what stands before, and the column pruning of a Parquet scan is kept.
    The shuffles that made it go with the write; ``dropped`` deletes it before
    the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _STORED[out] = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote; for tables that no frame still to be run reads."""
    for table in tables:
        delete_now(table.sparkSession, _STORED.pop(table))


def whole_text(col: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def normalised(col: str = "text") -> Column:
    """The text with every run of white space replaced by one space."""
    return F.regexp_replace(whole_text(col), f"{SPACE}+", " ")


def text_key(col: str = "text") -> Column:
    """SHA-256 of the normalised text, as bytes: what equal texts share."""
    return F.unhex(F.sha2(normalised(col), 256))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be none of ``df``'s columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` named by ``kept`` (doc_id, key of the text), all columns; of repeated rows one."""
    named_id, named_key, own_key = unused(docs, "named_id", "named_key", "own_key")
    named = kept.select(F.col("doc_id").alias(named_id), F.col("key").alias(named_key))
    own = docs.withColumn(own_key, text_key())
    same = F.col(own_key).eqNullSafe(F.col(named_key)) & F.col("doc_id").eqNullSafe(F.col(named_id))
    return own.join(named, same, "left_semi").dropDuplicates(["doc_id", own_key]).drop(own_key)


def bounded_batches(spark: SparkSession, rows: int = 500) -> None:
    """Bound what a task of this session holds at a time: ``rows`` rows and about ARROW_BATCH_BYTES in an Arrow
    batch, ROW_GROUP_BYTES in a Parquet writer.

    A single longer row still makes a batch of its own.
    """
    spark.conf.set("parquet.block.size", str(ROW_GROUP_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


# what an operator keeps in a Python worker from one task to the next, by (operator, name)
_HELD: dict[tuple[str, str], Any] = {}


def held(operator: str, name: str, make: Callable[[str], Any]) -> Any:
    """What ``operator`` keeps under ``name`` in this worker, made by ``make(name)`` when it is not there.

    Spark keeps workers, and deals tasks to them in turn, for all stages of an
    application: the tables of other operators are let go first.
    """
    if any(owner != operator for owner, _ in _HELD):
        let_go()
    if (operator, name) not in _HELD:
        _HELD[operator, name] = make(name)
    return _HELD[operator, name]


def let_go() -> None:
    """Let go what operators keep in this worker; for the start of tasks that keep nothing themselves."""
    if _HELD:
        _HELD.clear()
        give_back()


def give_back() -> None:
    """Return freed memory of a Python worker to the system: Spark keeps workers for the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):            # no C library with it
        pass
