"""Benchmark decontamination: pigeonhole pieces, then bit-parallel edit distance.

A test item of n characters may differ in ``error_rate * n`` edits, rounded
down.  Cut into one piece more than that, at least one piece must stand in
a leaked copy unchanged.  An Aho-Corasick automaton finds every exact hit
of every piece in the whole text; around each hit (one window per item and
place) Myers' bit-parallel algorithm computes the edit distance of the item
to its best match, which must be within the budget.

The items are the stated query set: they are dealt by hash into blocks of
about ``block_chars`` characters, and each block (its automaton is built in
the worker) is held against all documents in turn, its hits written before
the next block is read.  The driver and a worker hold one block at a time.

Text and items are compared in lower case with white space runs as one
blank.  Defined results: null and empty texts match nothing; items with a
null or empty text or a null item_id are ignored; an item too short for an edit must occur exactly;
repeated rows each get a row; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import bounded_batches, documents, let_go, scratch_path, stored, unused, whole_text

_BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def plain(text: str) -> str:
    """Lower case, white space runs as one blank."""
    return _BLANKS.sub(" ", text).strip().lower()


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): the item cut into ``errors + 1`` nearly equal pieces."""
    cuts = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_distance(pattern: str, text: str, most: int) -> int:
    """Smallest edit distance of ``pattern`` to any substring of ``text``; ``most + 1`` if above ``most``.

    Myers' algorithm: one bit vector over the pattern per text character.
    """
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        where[c] |= 1 << i
    up, down, score, best = full, 0, m, m
    for c in text:
        eq = where.get(c, 0)
        diag = ((((eq & up) + up) ^ up) | eq | down) & full
        grow, shrink = down | (full & ~(diag | up)), up & diag
        if grow & top:
            score += 1
        elif shrink & top:
            score -= 1
        grow, shrink = (grow << 1) & full, (shrink << 1) & full     # a match may start anywhere
        up = shrink | (full & ~(diag | grow))
        down = grow & diag
        if score < best:
            best = score
    return min(best, most + 1)


class Matcher:
    """The pieces of one block of items, compiled."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        import ahocorasick

        self.items = [(key, t, int(error_rate * len(t))) for key, t in items]
        at: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (_, t, errors) in enumerate(self.items):
            for offset, piece in pieces(t, errors):
                at[piece].append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        if at:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[int]:
        """Keys of the items within their budget of some part of ``text``, ascending."""
        if not self.items or not text:
            return []
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (size, places) in self.automaton.iter(text):
            for i, offset in places:
                starts[i].add(end + 1 - size - offset)
        found = []
        for i, where in starts.items():
            key, item, errors = self.items[i]
            last = None
            for start in sorted(where):
                # windows of neighbouring places overlap: the first covers those within the budget
                if last is not None and start <= last + errors:
                    continue
                last = start
                window = text[max(0, start - errors):start + len(item) + 2 * errors]
                if item in window or best_distance(item, window, errors) <= errors:
                    found.append(key)
                    break
        return sorted(set(found))


def _block(items: DataFrame, k: int, n: int) -> list[tuple[int, str]]:
    """The items (item_id, text) of block ``k`` of ``n``."""
    rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).select("item_id", "text").collect()
    return sorted({(r["item_id"], t) for r in rows if r["item_id"] is not None and (t := plain(r["text"] or ""))})


def _matched(text: Column, block: list[tuple[int, str]], error_rate: float) -> Column:
    """Array of the keys of a block's items that ``text`` contains."""
    @F.pandas_udf("array<long>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        let_go()
        matcher = Matcher(block, error_rate)
        for texts in batches:
            yield pd.Series([matcher.find(plain(t)) for t in texts], dtype=object)

    return find(text)


def with_matches(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.05,
                 block_chars: int = 4_000_000, out: str = "items") -> DataFrame:
    """``docs`` and an array column ``out``: item_ids found in the text, ascending."""
    bounded_batches(docs.sparkSession)
    size = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // block_chars))
    if n == 1:
        return docs.withColumn(out, F.sort_array(_matched(whole_text(), _block(benchmark, 0, 1), error_rate)))
    spark = docs.sparkSession
    row, own, found_in = unused(docs, "row", "own_row", "hits")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "decontaminate-rows")
    path = scratch_path(spark, "decontaminate-hits")
    for k in range(n):
        found = rows.select(F.col(row).alias("at"), _matched(whole_text(), _block(benchmark, k, n), error_rate).alias("found"))
        found.select("at", F.explode("found").alias("item")).write.mode("append").parquet(path)
    hits = spark.read.schema("at long, item long").parquet(path)
    lists = hits.groupBy(F.col("at").alias(own)).agg(F.sort_array(F.collect_set("item")).alias(found_in))
    none = F.array().cast("array<long>")
    joined = rows.join(lists, rows[row] == lists[own], "left")
    return joined.withColumn(out, F.coalesce(found_in, none)).drop(row, own, found_in)


def keep_clean(docs: DataFrame, benchmark: DataFrame, error_rate: float = 0.05) -> DataFrame:
    """``docs`` (all columns) without the documents that hold a test item."""
    (out,) = unused(docs, "items")
    return with_matches(docs, benchmark, error_rate, out=out).where(F.size(out) == 0).drop(out)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the test items that each document holds."""
    items = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    found = with_matches(documents(spark, sf_dir), items)
    return found.select("doc_id", F.size("items").cast("long").alias("n_items"), "items",
                        (F.size("items") > 0).alias("contaminated"))
