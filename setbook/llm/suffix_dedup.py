"""Removal of repeated byte strings by two-stage suffix sorting.

A byte goes if it is covered by a string of ``width`` bytes that also
starts anywhere else.  Where that can be is found by anchors (``anchors``).
There, blocks of contexts are sorted by suffix in two stages:

1. of each run of suffixes smaller than their successor the first one is
   sorted directly, by its first ``width`` bytes and more;
2. scans over the buckets (first bytes) induce the place of every other
   suffix from its successor's: from left to right those larger than it,
   then from right to left those smaller.

The common prefixes of neighbouring suffixes then tell which windows occur
twice.  A separator that no UTF-8 text holds ends each context, so a common
prefix of ``width`` bytes never crosses documents.

Defined results: a null text counts as empty; texts shorter than ``width``
lose nothing; rows that repeat a doc_id and its text are copies of each
other; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import anchors
from .common import bounded_batches, documents, dropped, stored, whole_text

WIDTH = 400
PASSAGE, PASSAGE_GRAM = 50, 16     # words of a shared passage, and of its anchors
WIDTH_BYTES, LEAST_PASSAGE = 128, 200
BLOCK_BYTES = 1 << 19           # contexts of one anchor beyond this are dealt out by window
BATCH_BYTES = 1 << 16           # contexts sorted together; fits a core's cache
SORTED_KEYS = 1 << 10           # about as many suffixes are cut out at a time; fits it too
_END = b"\xff"                  # in no UTF-8 text
_BYTE_UNITS = anchors.mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _open(text: str) -> tuple[np.ndarray, bytes, np.ndarray]:
    raw = text.encode("utf-8", "surrogatepass")
    return _BYTE_UNITS[np.frombuffer(raw, np.uint8)], raw, np.arange(len(raw) + 1)


def kind(width: int = WIDTH) -> anchors.Kind:
    return anchors.Kind(width, min(64, max(1, width // 4)), _open)


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it (the last one is not)."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1] = -1
    differs = np.where(step != 0, np.arange(n), n)
    return step[np.minimum.accumulate(differs[::-1])[::-1]] > 0        # equal bytes go on with the next


def _words(text: bytes, beyond: int = 0) -> np.ndarray:
    """The eight bytes from each place on (zeros behind the end), the first one lowest, to ``beyond`` places behind the end."""
    data = np.frombuffer(text + bytes(beyond + 8), np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, 8).copy().view("<u8")[:, 0]


def _sorted_directly(text: bytes, places: np.ndarray, depth: int) -> list[int]:
    """``places`` by the first ``depth`` bytes of their suffixes: by eight bytes at first, then whole groups of equal ones."""
    words = _words(text).byteswap()[places]
    by = np.argsort(words)
    words, near = words[by], places[by].tolist()
    ends = np.flatnonzero(words[1:] != words[:-1]) + 1
    out, a = [], 0
    for e in [*ends[np.flatnonzero(np.diff(ends // SORTED_KEYS, prepend=0))].tolist(), len(near)]:
        out += sorted(near[a:e], key=lambda i: text[i:i + depth])
        a = e
    return out


def _induce(places: np.ndarray, start: np.ndarray, scanned: np.ndarray, front: np.ndarray, lead: np.ndarray) -> None:
    """Fill the front of each bucket of ``places`` in one scan.

    Bucket ``c`` begins at ``start[c]``, its first ``scanned[c]`` places are
    scanned, and the next free one is ``front[c]``.  ``lead[p]`` is the bucket
    of the suffix before ``p`` if the scan is to place that one, else -1.
    """
    for c in np.flatnonzero(scanned).tolist():
        lo, hi = start[c], front[c]
        while lo < hi:                                                  # runs of one byte grow their own bucket
            own = places[lo:hi]
            own = own[lead[own] == c] - 1
            lo, hi = hi, hi + len(own)
            places[lo:hi] = own
        source = places[start[c]:start[c] + scanned[c]]
        first = lead[source]
        later = first > c
        source, first = source[later] - 1, first[later]
        by = np.argsort(first, kind="stable")
        first = first[by]
        own = np.bincount(first, minlength=256)
        places[np.arange(len(by)) + (front - (np.cumsum(own) - own))[first]] = source[by]
        front += own


def suffix_order(text: bytes, depth: int) -> np.ndarray:
    """Suffixes in the order of at least their first ``depth`` bytes.

    Only the first of each run of suffixes smaller than their successor are
    compared; the others are placed by two scans.
    """
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    small = smaller_than_next(data)
    direct = np.array(_sorted_directly(text, np.flatnonzero(small[1:] & ~small[:-1]) + 1, depth), np.int64)
    # a bucket holds the suffixes with one first byte: large ones in front, small ones behind
    size, large = np.bincount(data, minlength=256), np.bincount(data[~small], minlength=256)
    start = np.cumsum(size) - size
    places = np.zeros(n, np.int32)
    own = np.bincount(data[direct], minlength=256)
    places[np.arange(len(direct)) + np.repeat(start + large - (np.cumsum(own) - own), own)] = direct
    front = start.copy()
    places[front[text[n - 1]]] = n - 1                                  # its successor is the empty suffix
    front[text[n - 1]] += 1
    before = np.concatenate([[-1], data[:-1]]).astype(np.int16)
    after_small = np.concatenate([[False], small[:-1]])
    _induce(places, start, large + own, front, np.where(after_small, np.int16(-1), before))
    # the same from the other end, over all that is placed; the small ones are placed anew
    mirrored = (n - start - size)[::-1]
    _induce(places[::-1], mirrored, size[::-1], mirrored.copy(), np.where(after_small, 255 - before, np.int16(-1)))
    return places.astype(np.int64)


def long_prefixes(text: bytes, order: np.ndarray, width: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, up to ``width`` bytes.

    Where neighbours' successors are neighbours too, their prefix is one byte
    longer than that of the successors; only where such a chain ends bytes are compared.
    """
    n = len(order)
    data, words = np.frombuffer(text, np.uint8), _words(text, width)
    before = np.full(n + 1, -2, np.int64)                               # the first one has none, next to no place
    before[order[1:]] = order[:-1]
    differs = data != data[np.maximum(before[:n], 0)]
    differs[order[0]] = True
    stops = np.flatnonzero(differs | (before[1:] != before[:-1] + 1))
    common = np.zeros(len(stops), np.int64)
    left = np.flatnonzero(~differs[stops])
    a, b = stops[left], before[stops[left]]
    for at in range(0, width, 8):
        apart = words[a + at] ^ words[b + at]
        same = apart == 0
        ended = apart[~same]
        if len(ended):
            common[left[~same]] = at + (ended.view(np.uint8).reshape(-1, 8) != 0).argmax(axis=1)
        left, a, b = left[same], a[same], b[same]
        if not len(left):
            break
    common[left] = width
    chained = np.repeat(common + stops, np.diff(stops, prepend=-1)) - np.arange(n)
    return np.minimum(chained[order], width)


def repeated_starts(contexts: list[bytes], width: int) -> list[np.ndarray]:
    """For each context, which of its windows also start at another place of ``contexts``."""
    text = _END.join(contexts) + _END
    order = suffix_order(text, width + 8)
    twice = np.zeros(len(text) + 1, bool)
    hits = np.flatnonzero(long_prefixes(text, order, width) >= width)
    twice[order[hits]] = True
    twice[order[hits - 1]] = True
    out, at = [], 0
    for c in contexts:
        out.append(twice[at:at + max(0, len(c) - width + 1)])
        at += len(c) + 1
    return out


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    yield from zip(edge[::2].tolist(), (edge[1::2] - 1).tolist())


def _compare(width: int):
    def run(block):
        for c, flags in enumerate(repeated_starts([b[3] for b in block], width)):
            for a, e in _runs(flags):
                yield c, a, e
    return run


def _removed(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {"id": [], "tkey": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            for r in b.to_pylist():
                raw = np.frombuffer(anchors.unpacked(r["packed"]).encode("utf-8", "surrogatepass"), np.uint8)
                gone = anchors.covered([(x["s0"], x["s1"]) for x in r["runs"]], width, len(raw))
                kept = raw[~gone].tobytes()
                for name, value in (("id", r["id"]), ("tkey", r["tkey"]), ("n_removed", int(gone.sum())),
                                    ("n_spans", len(list(_runs(gone)))), ("kept", kept),
                                    ("kept_sha256", hashlib.sha256(kept).hexdigest())):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("id", pa.int64()), ("tkey", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                ("kept_sha256", pa.string()), ("kept", pa.binary())]))
    return run


def repeated_runs(docs: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, anchors.Candidates]:
    """(runs, candidates): runs of repeated windows (id, tkey, s0, s1) in ``docs`` (id, tkey, text)."""
    k = kind(width)
    found = anchors.search(docs, k, block_bytes)
    copies = found.members.join(found.classes.where("n > 1").select("anchor", "ctx"), ["anchor", "ctx"]).select(
        "id", "tkey", F.col("i0").alias("s0"), F.col("i1").alias("s1"))
    sorted_runs = anchors.compared(found, k, BATCH_BYTES, _compare(width))
    windows = stored(anchors.hot_windows(found, k), "hot-windows")
    again = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2")
    hot = windows.join(again, ["w1", "w2"]).select("id", "tkey", "s0", F.col("s0").alias("s1"))
    return copies.unionByName(sorted_runs).unionByName(hot), found


def remove_repeats(docs: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES, more=()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans,
    kept_sha256 and ``kept`` (the remaining bytes where some were removed, else null);
    ``more`` names further columns of ``docs`` to carry."""
    rows = anchors.identified(docs)
    runs, found = repeated_runs(rows, width, block_bytes)
    cut = anchors.gathered(runs, found).mapInArrow(
        _removed(width), "id long, tkey long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    cut = cut.withColumnRenamed("kept_sha256", "cut_sha256")
    whole = docs.select(
        "doc_id", *more, *anchors.identity(),
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("whole_sha256"))
    return whole.join(cut, ["id", "tkey"], "left").select(
        *[c for c in whole.columns if c not in ("id", "tkey", "whole_sha256", "n_bytes")], "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"), "kept")


def _word_open(text: str) -> tuple[np.ndarray, bytes, np.ndarray]:
    """The words of a text as units; offsets are those of the words joined by single blanks, which is left out."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    space = np.concatenate([[True], (raw == 32) | ((raw >= 9) & (raw <= 13)), [True]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    first, last = edge[::2], edge[1::2]
    return anchors.run_hashes(_BYTE_UNITS[raw], first, last), b"", np.concatenate([[0], np.cumsum(last - first + 1)])


WORDS = anchors.Kind(PASSAGE, PASSAGE_GRAM, _word_open, gap=1)


def _byte_passages(width: int) -> anchors.Kind:
    return anchors.Kind(width, max(1, width // 4), _open)


def _passage_rows(kind: anchors.Kind):
    """Per context: its document, anchor and a hash of the whole of it, its windows (i0 to i1) and its bytes (at, n)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, rows = [], []
            for t in b.column("text").to_pylist():
                units, _, offsets = kind.open(t)
                anchor, i0, i1 = anchors.contexts(units, kind.width, kind.gram)
                ends = i1 + kind.width
                rows.append(len(i0))
                if len(i0):
                    out.append((anchor, anchors.run_hashes(units, i0, ends), i0, i1, offsets[i0], offsets[ends] - kind.gap))
            if out:
                anchor, ctx, i0, i1, at, end = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_pydict({
                    "doc": np.repeat(b.column("doc").to_numpy(), rows), "anchor": anchor.view(np.int64),
                    "ctx": ctx.view(np.int64), "i0": i0.astype(np.int32), "i1": i1.astype(np.int32),
                    "at": at.astype(np.int64), "n": (end - at).astype(np.int64)})
    return run


def _passage_windows(kind: anchors.Kind):
    """Every window of the wanted contexts: hash, first byte (from the context's start) and bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc in b.to_pylist():
                units, _, offsets = kind.open(anchors.unpacked(doc["packed"]))
                windows = anchors.gram_hashes(units, kind.width)
                own = doc["want"]
                sizes = [w["i1"] - w["i0"] + 1 for w in own]
                i = np.concatenate([np.arange(w["i0"], w["i1"] + 1) for w in own])
                start = np.repeat(offsets[[w["i0"] for w in own]], sizes)
                each = lambda name: np.repeat(np.array([w[name] for w in own], np.int64), sizes)  # noqa: E731, B023
                yield pa.RecordBatch.from_pydict({
                    "anchor": each("anchor"), "ctx": each("ctx"), "a": each("a"), "z": each("z"),
                    "w": windows[i].view(np.int64), "at": (offsets[i] - start).astype(np.int64),
                    "n": (offsets[i + kind.width] - kind.gap - offsets[i]).astype(np.int64)})
    return run


def shared_passages(docs: DataFrame, width: int = WIDTH_BYTES, least: int = LEAST_PASSAGE,
                    kind: anchors.Kind | None = None) -> DataFrame:
    """(doc, longest_shared) of the documents of ``docs`` (doc, text) that share a passage with another one.

    A passage is a run of units (of ``kind``; by default bytes), each in a
    window of ``width`` that another ``doc`` holds too, wherever it stands;
    ``longest_shared`` is the longest one's size in bytes, words being joined by
    single blanks, and counts if it has ``least`` bytes.

    Equal windows have equal anchors.  Contexts that are all equal for an
    anchor are shared as a whole; where they differ, the windows of each
    distinct one are looked up among those of the others.
    """
    kind = kind or _byte_passages(width)
    bounded_batches(docs.sparkSession)
    cuts = stored(docs.mapInArrow(_passage_rows(kind), "doc long, anchor long, ctx long, i0 int, i1 int, at long, n long"),
                  "passages")
    both = cuts.groupBy("anchor").agg(F.min("doc").alias("a"), F.max("doc").alias("z"),
                                      (F.min("ctx") != F.max("ctx")).alias("differ"))
    # stored, so that the joins are of plain shuffles, whose hot keys AQE splits
    shared = stored(both.where("a != z").select("anchor", "differ"), "shared")
    members = stored(cuts.join(shared, "anchor"), "shared-contexts")
    dropped(cuts, shared)
    whole, parts = members.where("not differ"), members.where("differ")
    classes = parts.groupBy("anchor", "ctx").agg(F.min("doc").alias("a"), F.max("doc").alias("z"),
                                                 F.min(F.struct("doc", "i0", "i1")).alias("rep"))
    want = classes.groupBy(F.col("rep.doc").alias("doc")).agg(
        F.collect_list(F.struct("anchor", "ctx", "a", "z", "rep.i0", "rep.i1")).alias("want"))
    texts = docs.select("doc", anchors._packed("text").alias("packed")).join(want, "doc")
    windows = stored(texts.mapInArrow(_passage_windows(kind), "anchor long, ctx long, a long, z long, w long, at long, n long"),
                     "passage-windows")
    again = windows.groupBy("anchor", "w").agg(F.min("a").alias("a"), F.max("z").alias("z")).where("a != z").select("anchor", "w")
    hits = (windows.join(again, ["anchor", "w"]).groupBy("anchor", "ctx")
            .agg(F.collect_set(F.struct("at", "n")).alias("hits")))
    found = parts.select("doc", "anchor", "ctx", "at").join(hits, ["anchor", "ctx"]).select(
        "doc", F.transform("hits", lambda h: F.struct((F.col("at") + h["at"]).alias("at"), h["n"].alias("n"))).alias("runs"))
    found = found.unionByName(whole.select("doc", F.array(F.struct("at", "n")).alias("runs")))
    runs = found.groupBy("doc").agg(F.sort_array(F.flatten(F.collect_list("runs"))).alias("runs"))
    zero, state = F.lit(0).cast("long"), lambda at, end, best: F.struct(at.alias("at"), end.alias("end"), best.alias("best"))

    def joined(acc, x):
        end = F.greatest(acc["end"], x["at"] + x["n"])
        return F.when((x["at"] <= acc["end"] + kind.gap) & (acc["end"] > 0), state(acc["at"], end, F.greatest(acc["best"], end - acc["at"]))) \
                .otherwise(state(x["at"], x["at"] + x["n"], F.greatest(acc["best"], x["n"])))

    longest = F.aggregate("runs", state(zero, zero, zero), joined, lambda acc: acc["best"])
    out = stored(runs.select("doc", longest.alias("longest_shared")).where(F.col("longest_shared") >= least), "longest-shared")
    dropped(members, windows)
    return out


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated strings of 400 bytes leave of every document."""
    return remove_repeats(documents(spark, sf_dir)).drop("kept")


def with_longest_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: ``op5_suffix_dedup`` and the bytes of the longest passage of at least 50 words, each in a
    run of 50 that another document holds too (0: none); such passages may be shorter than the strings removed."""
    docs = documents(spark, sf_dir)
    doc = F.xxhash64("doc_id", whole_text())
    shared = shared_passages(docs.select(doc.alias("doc"), whole_text().alias("text")), least=1, kind=WORDS)
    out = remove_repeats(docs, more=[doc.alias("doc")]).drop("kept")
    return out.join(shared, "doc", "left").drop("doc").withColumn(
        "longest_shared", F.coalesce("longest_shared", F.lit(0).cast("long")))
