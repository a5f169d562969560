"""Exact deduplication by stateful streaming.

Rows arrive as (digest, row, doc_id, file): a SHA-256 of the normalised
text, a stable identifier (the load that brought the row and its number in
it, written with the arrival, so it never changes and no two rows share
one) and where the content lies, without the text.  A streaming aggregation
keyed by digest holds, in RocksDB state on disk and without watermark or
expiry, the first row of each text (by doc_id, then row) and its count.
The caller may name the folder of that state: a later load, of more
documents, then goes on from it, and its copies of earlier texts are found.
The partial aggregation before the shuffle folds the copies of a hot text
inside each task.

Hits are checked on full bytes: the texts of every digest that was seen
more than once are compared (smallest against largest of the group, with
map-side folding).  A digest that holds different texts is regrouped by
the text itself, so the result of a load does not rest on the digest; a hit
on an earlier load, whose texts are not at hand, does.

All of it is DataFrame and Structured Streaming operations.

Defined results: a null text counts as empty, and empty texts equal each
other; a null doc_id comes after every other; of repeated rows with one
doc_id the first read stays; an empty table gives an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keep_rows, normalised, scratch_path, stored

# state on disk; without preallocated files, of which each state partition would hold several MB
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _first_row() -> Column:
    return F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "file")).alias("first")


def fold_stream(spark: SparkSession, arrivals_path: str, schema, checkpoint: str,
                files_per_trigger: int = 1000) -> DataFrame:
    """Run the stream over what is new below ``arrivals_path``; the state as a table.

    Returns (digest, first, n).  ``checkpoint`` holds the stream's progress
    and state: calling again after more files arrived reads only those.
    """
    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        arriving = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
                    .parquet(arrivals_path))
        state = arriving.groupBy("digest").agg(_first_row(), F.count(F.lit(1)).alias("n"))
        run = (state.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
               .option("checkpointLocation", checkpoint).start())
        run.awaitTermination()
        kept = spark.read.format("statestore").load(checkpoint)
        first, n = kept.schema["value"].dataType.names
        return stored(kept.select(
            F.col("key.digest").alias("digest"), F.col(f"value.`{first}`").alias("first"),
            F.col(f"value.`{n}`").cast("long").alias("n")), "dedup-first")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def _collided(docs: DataFrame, state: DataFrame, digest: Column) -> DataFrame | None:
    """Hit rows whose digest holds more than one text, with their text; None if there are none."""
    hits = state.where(F.col("n") > 1).select("digest")
    texts = docs.select("doc_id", normalised().alias("norm")).withColumn("digest", digest)
    texts = stored(texts.join(hits, "digest"), "hits")
    unequal = stored(texts.groupBy("digest").agg(F.min("norm").alias("a"), F.max("norm").alias("b"))
                     .where(F.col("a") != F.col("b")).select("digest"), "collided")
    if unequal.isEmpty():
        return None
    return texts.join(unequal, "digest")


def deduplicate(docs: DataFrame, digest=sha256_digest, files_per_trigger: int = 1000,
                state: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, digest, keep_id, group_size, kept, file.

    ``digest`` maps the normalised text to a binary key; any function of the
    text gives the same result, a weak one only more work.  ``state`` names a
    shared folder that outlives the call: calling again with it and other
    documents counts them together with all that came before (``keep_id`` may
    then name an earlier document, and an earlier result may be overtaken).
    """
    spark = docs.sparkSession
    key = digest(F.col("norm"))
    base = docs.select("doc_id", "text")
    folder = state.rstrip("/") if state else scratch_path(spark, "dedup")
    path, load = f"{folder}/arrivals", uuid.uuid4().int >> 65
    row = F.struct(F.lit(load).cast("long").alias("load"), F.monotonically_increasing_id().alias("at"))
    (base.select("doc_id", row.alias("row"), F.input_file_name().alias("file"), normalised().alias("norm"))
     .select("doc_id", "row", "file", key.alias("digest"), F.sha2("norm", 256).alias("text_sha256"))
     .write.mode("append").parquet(path))
    arrivals = spark.read.parquet(path).where(F.col("row.load") == load)
    seen = arrivals.select("doc_id", "row", "file", "digest").schema
    first = fold_stream(spark, path, seen, f"{folder}/progress", files_per_trigger)
    out = arrivals.join(first, "digest")
    clashes = _collided(base, first, key)
    if clashes is not None:
        out = _regrouped(out, clashes)
    return out.select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256", "digest", "file")


def _regrouped(out: DataFrame, clashes: DataFrame) -> DataFrame:
    """``out`` with the groups of collided digests formed by the whole text instead."""
    texts = clashes.select(F.col("doc_id").alias("id"), F.col("digest").alias("dg"), "norm",
                           F.sha2("norm", 256).alias("sha")).distinct()
    rows = out.join(texts, out["digest"].eqNullSafe(F.col("dg")) & out["doc_id"].eqNullSafe(F.col("id"))
                    & (out["text_sha256"] == F.col("sha")), "left").drop("first", "n", "id", "dg", "sha")
    alone = rows.where(F.col("norm").isNull()).select("row").join(out, "row")
    split = rows.where(F.col("norm").isNotNull())
    groups = split.groupBy("digest", "norm").agg(_first_row(), F.count(F.lit(1)).alias("n"))
    split = split.join(groups, ["digest", "norm"])
    return alone.select(*out.columns).unionByName(split.select(*out.columns))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the later copies of equal texts."""
    return keep_rows(docs, deduplicate(docs).where("kept").select("doc_id", F.col("digest").alias("key")))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: every row of ``documents`` with the row that stays for its text."""
    return deduplicate(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
"""
