"""Repeated windows of a corpus: candidate search shared by the passage operators.

A text is a sequence of units (bytes or words); a window is ``width``
consecutive units.  Of each window the leftmost gram of ``gram`` units with
the smallest hash is its anchor; it depends on the window's content alone,
so equal windows have equal anchors.  Neighbouring windows mostly share
theirs, so a text falls into few contexts: an anchor and the run of windows
that have it.

1. Anchors that occur once in the corpus cannot have a repeated window.
2. The others' contexts are collapsed: equal contexts of one anchor are a
   class, with its count and its first place.  Copies, however many, are
   one row from here on.
3. Anchors whose classes differ are where windows must be compared.  Their
   contexts (of each class's first place) are cut from the texts and dealt
   out by anchor, for an operator to compare block by block.
4. An anchor whose distinct contexts exceed a block (a passage that a large
   part of all documents embeds) is not gathered: its windows are dealt out
   by their own content instead, and grouped with map-side folding.

Every window is compared in exactly one place, against every other one that
could equal it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, dropped, stored, whole_text

_LOW, _HIGH = np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000)
_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit function of each number."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def gram_hashes(units: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k units."""
    up, down = _powers(len(units))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(units * down)])
    return mixed((sums[k:] - sums[:-k]) * up[:len(units) - k + 1])


def run_hashes(units: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run of units from ``first`` to ``end`` (exclusive), wherever it stands."""
    up, down = _powers(len(units))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(units * down)])
    return mixed((sums[end] - sums[first]) * up[first])


def contexts(units: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, last window) of each run of windows with one anchor."""
    windows = len(units) - width + 1
    if windows <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    h = gram_hashes(units, gram)
    least, span, size = (h & _HIGH) | np.arange(len(h), dtype=np.uint64), width - gram + 1, 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[:windows], least[span - size:span - size + windows])
    place = (least & _LOW).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    last = np.append(first[1:] - 1, windows - 1)
    return h[place[first]], first, last


@dataclass(frozen=True)
class Kind:
    """What a window is: its width and anchor gram in units, and how a text is cut.

    ``open`` maps a text to (units, raw bytes, offsets): unit i lies at
    ``raw[offsets[i]:offsets[i + 1]]``, with ``gap`` bytes of separator at its end.
    """

    width: int
    gram: int
    open: Callable[[str], tuple[np.ndarray, bytes, np.ndarray]]
    gap: int = 0

    def slice(self, raw: bytes, offsets: np.ndarray, a: int, b: int) -> bytes:
        """The bytes of units a to b, end exclusive."""
        return raw[offsets[a]:offsets[b] - self.gap]


# null ids sort before all others
_NULL_ID = -(1 << 63)


def identity() -> list:
    """Columns id and tkey: a row is named by its doc_id and a hash of its text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"),
            F.xxhash64(whole_text()).alias("tkey")]


def identified(docs: DataFrame) -> DataFrame:
    """(id, tkey, text) of every row."""
    return docs.select(*identity(), whole_text().alias("text"))


def _context_rows(kind: Kind) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            anchor, ctx, first, last, sizes = [], [], [], [], []
            for t in b.column("text").to_pylist():
                units, raw, offsets = kind.open(t)
                h, i0, i1 = contexts(units, kind.width, kind.gram)
                anchor.append(h)
                first.append(i0)
                last.append(i1)
                sizes.append(len(h))
                cuts = zip(offsets[i0].tolist(), (offsets[i1 + kind.width] - kind.gap).tolist()) if len(h) else ()
                ctx.extend([xxhash.xxh3_64_intdigest(raw[a:e]) for a, e in cuts])
            if sum(sizes):
                yield pa.RecordBatch.from_pydict({
                    "id": np.repeat(b.column("id").to_numpy(), sizes),
                    "tkey": np.repeat(b.column("tkey").to_numpy(), sizes),
                    "anchor": np.concatenate(anchor).view(np.int64),
                    "ctx": np.array(ctx, np.uint64).view(np.int64),
                    "i0": np.concatenate(first).astype(np.int32), "i1": np.concatenate(last).astype(np.int32)})
    return run


_ROWS = "id long, tkey long, anchor long, ctx long, i0 int, i1 int"


def _packed(text: str) -> Column:
    """The column compressed: half of what Spark's own codec leaves of a shuffled text."""
    @F.pandas_udf("binary")
    def pack(texts: pd.Series) -> pd.Series:
        codec = zstandard.ZstdCompressor(level=1)
        return texts.map(lambda t: codec.compress(t.encode("utf-8", "surrogatepass")))

    return pack(text)


def unpacked(data: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(data).decode("utf-8", "surrogatepass")


@dataclass
class Candidates:
    """What the search leaves: ``members`` (context rows of repeated anchors),
    ``classes`` (anchor, ctx, n, rep, kinds, hot) and ``texts`` (id, tkey, packed
    text, want: the contexts to compare), one row per distinct document."""

    members: DataFrame
    classes: DataFrame
    texts: DataFrame


def search(docs: DataFrame, kind: Kind, block_units: int) -> Candidates:
    """Find the contexts that may hold repeated windows in ``docs`` (id, tkey, text)."""
    bounded_batches(docs.sparkSession)
    # both sides stored, so that the texts are cut once and the join is one of
    # two plain shuffles, whose hot anchors AQE splits
    rows = stored(docs.mapInArrow(_context_rows(kind), _ROWS), "windows")
    repeated = stored(rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "anchors")
    members = stored(rows.join(repeated, "anchor"), "contexts")
    dropped(rows, repeated)
    classes = stored(members.groupBy("anchor", "ctx").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "tkey", "i0", "i1")).alias("rep")), "classes")
    groups = classes.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"),
        F.sum(F.col("rep.i1") - F.col("rep.i0") + kind.width).alias("units"))
    groups = groups.where("kinds > 1").select("anchor", (F.col("units") > block_units).alias("hot"))
    want = (classes.join(groups, "anchor").groupBy(F.col("rep.id").alias("id"), F.col("rep.tkey").alias("tkey"))
            .agg(F.collect_list(F.struct("anchor", "rep.i0", "rep.i1", "hot")).alias("want")))
    wanted = members.select("id", "tkey").distinct().join(want, ["id", "tkey"], "left")
    packed = docs.select("id", "tkey", _packed("text").alias("packed"))
    texts = stored(packed.join(wanted, ["id", "tkey"]).dropDuplicates(["id", "tkey"]), "texts")
    return Candidates(members, classes, texts)


def _cut_contexts(kind: Kind) -> Callable:
    """The wanted contexts that fit a block: anchor, id, tkey, i0, content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc in b.to_pylist():
                own = [w for w in doc["want"] if not w["hot"]]
                if not own:
                    continue
                _, raw, offsets = kind.open(unpacked(doc["packed"]))
                yield pa.RecordBatch.from_pydict({
                    "anchor": pa.array([w["anchor"] for w in own], pa.int64()),
                    "id": pa.array([doc["id"]] * len(own), pa.int64()),
                    "tkey": pa.array([doc["tkey"]] * len(own), pa.int64()),
                    "i0": pa.array([w["i0"] for w in own], pa.int32()),
                    "content": pa.array([kind.slice(raw, offsets, w["i0"], w["i1"] + kind.width) for w in own], pa.binary())})
    return run


def _cut_windows(kind: Kind) -> Callable:
    """Every window of the wanted contexts of hot anchors: two hashes of its content, and its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc in b.to_pylist():
                own = [i for w in doc["want"] if w["hot"] for i in range(w["i0"], w["i1"] + 1)]
                if not own:
                    continue
                _, raw, offsets = kind.open(unpacked(doc["packed"]))
                h = [xxhash.xxh3_128_intdigest(kind.slice(raw, offsets, i, i + kind.width)) for i in own]
                low = np.array([x & (2 ** 64 - 1) for x in h], np.uint64).view(np.int64)
                high = np.array([x >> 64 for x in h], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "w1": low, "w2": high, "id": pa.array([doc["id"]] * len(own), pa.int64()),
                    "tkey": pa.array([doc["tkey"]] * len(own), pa.int64()), "s0": pa.array(own, pa.int32())})
    return run


RUNS = "id long, tkey long, s0 int, s1 int"


def compared(found: Candidates, kind: Kind, batch_units: int, compare: Callable) -> DataFrame:
    """Runs of windows (id, tkey, s0, s1) that ``compare`` reports, block by block.

    ``compare`` gets a list of (id, tkey, i0, content) of whole anchors, about
    ``batch_units`` units (one anchor alone may fill a block), and yields
    (index of the context, first, last) of runs of windows counted from the
    context's start.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(block):
            runs = list(compare(block))
            return pa.RecordBatch.from_pydict({
                "id": pa.array([block[c][0] for c, _, _ in runs], pa.int64()),
                "tkey": pa.array([block[c][1] for c, _, _ in runs], pa.int64()),
                "s0": pa.array([block[c][2] + a for c, a, _ in runs], pa.int32()),
                "s1": pa.array([block[c][2] + e for c, _, e in runs], pa.int32())})

        block, size, last = [], 0, None
        for b in batches:
            for r in b.to_pylist():
                if block and r["anchor"] != last and size >= batch_units:
                    yield closed(block)
                    block, size = [], 0
                last = r["anchor"]
                block.append((r["id"], r["tkey"], r["i0"], r["content"]))
                size += len(r["content"]) if not kind.gap else r["content"].count(b" ") + 1
        if block:
            yield closed(block)

    cut = found.texts.where(F.col("want").isNotNull()).mapInArrow(
        _cut_contexts(kind), "anchor long, id long, tkey long, i0 int, content binary")
    return cut.repartition("anchor").sortWithinPartitions("anchor", "id", "tkey", "i0").mapInArrow(run, RUNS)


def hot_windows(found: Candidates, kind: Kind) -> DataFrame:
    """(w1, w2, id, tkey, s0) of every window of hot anchors; empty unless there are any."""
    hot = found.texts.where(F.exists("want", lambda w: w["hot"]))
    return hot.mapInArrow(_cut_windows(kind), "w1 long, w2 long, id long, tkey long, s0 int")


def covered(runs: list[tuple[int, int]], width: int, n: int) -> np.ndarray:
    """Which of n units are covered by windows starting at the runs' places."""
    change = np.zeros(n + 1, np.int64)
    for a, b in runs:
        change[a] += 1
        change[b + width] -= 1
    return np.cumsum(change[:-1]) > 0


def gathered(runs: DataFrame, found: Candidates) -> DataFrame:
    """(id, tkey, packed, runs): the runs of each document beside its text."""
    lists = runs.groupBy("id", "tkey").agg(F.collect_list(F.struct("s0", "s1")).alias("runs"))
    return found.texts.select("id", "tkey", "packed").join(lists, ["id", "tkey"])
