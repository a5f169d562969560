"""Removal of repeated passages by automata of recurring phrases.

A word goes if it is covered by a window of ``width`` words whose sequence
also starts earlier (smaller doc_id, or same document, earlier start).

1. Anchors (``anchors``) lead to the contexts in which a window may recur;
   equal contexts are one row.
2. Each shard of contexts (whole anchors, about ``BATCH_WORDS`` words)
   confirms its recurring windows: those whose hash occurs twice become
   phrases.
3. The phrases are compiled into an Aho-Corasick automaton over words, and
   every context of the shard is streamed through it.  The automaton reports
   each true occurrence of each phrase; all but the earliest go.

A word is one symbol of the automaton: the shard's words are numbered and
written as characters.  Anchors send a phrase and all of its occurrences to
one shard, so no document visits a shard that cannot concern it.

Defined results: a null text has no words; texts of fewer than ``width``
words lose nothing; of rows that repeat a doc_id and its text one counts as
the earliest; a null doc_id comes before all others; an empty table gives
an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import anchors
from .common import documents, normalised, stored

WIDTH, GRAM = 20, 6
BLOCK_WORDS = 50_000             # contexts of one anchor beyond this are dealt out by window
BATCH_WORDS = 10_000             # contexts of one automaton
_MEMO_WORDS = 500_000
_HASHES: dict[bytes, int] = {}


def _word_units(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, through a bounded table per worker."""
    import xxhash

    if len(_HASHES) > _MEMO_WORDS:
        _HASHES.clear()
    for w in set(words).difference(_HASHES):
        _HASHES[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def _open(text: str) -> tuple[np.ndarray, bytes, np.ndarray]:
    words = text.encode("utf-8", "surrogatepass").split()        # at ASCII white space only
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    return _word_units(words), b" ".join(words), np.concatenate([[0], ends])


def kind(width: int = WIDTH, gram: int = GRAM) -> anchors.Kind:
    return anchors.Kind(width, min(gram, width), _open, gap=1)


def _symbols(contents: list[bytes]) -> list[str]:
    """Each context as a string with one character per word."""
    number: dict[bytes, str] = {}
    out = []
    for c in contents:
        words = c.split(b" ")
        for w in words:
            if w not in number:
                k = len(number) + 1
                number[w] = chr(k if k < 0xD800 else k + 0x800)      # not a surrogate
        out.append("".join(map(number.__getitem__, words)))
    return out


def _recurring(texts: list[str], width: int) -> set[str]:
    """The windows whose hash occurs more than once in ``texts``."""
    joined = "".join(texts)
    starts = np.cumsum([0, *map(len, texts)])
    place = np.arange(max(0, len(joined) - width + 1))
    units = anchors.mixed(np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64))
    # windows inside one text
    place = place[place + width <= starts[np.searchsorted(starts, place, "right")]]
    if not len(place):
        return set()
    _, which, counts = np.unique(anchors.gram_hashes(units, width)[place], return_inverse=True, return_counts=True)
    return {joined[i:i + width] for i in place[counts[which] > 1].tolist()}


def later_occurrences(places: list[tuple], contents: list[bytes], width: int) -> list[list[int]]:
    """For each context (its place, its words), the windows that also start at an earlier place.

    A place is (document, start) with a comparable document and the number of the context's first word.
    """
    import ahocorasick

    texts = _symbols(contents)
    phrases = _recurring(texts, width)
    out: list[list[int]] = [[] for _ in texts]
    if not phrases:
        return out
    automaton = ahocorasick.Automaton()
    for n, phrase in enumerate(phrases):
        automaton.add_word(phrase, n)
    automaton.make_automaton()
    # contexts hold disjoint runs of windows: in the order of their places, occurrences come in order too
    met = bytearray(len(phrases))
    for c in sorted(range(len(texts)), key=places.__getitem__):
        for end, n in automaton.iter(texts[c]):
            if met[n]:
                out[c].append(end - width + 1)
            else:
                met[n] = 1
    return out


def _compare(width: int):
    def run(block):
        found = later_occurrences([((b[0], b[1]), b[2]) for b in block], [b[3] for b in block], width)
        for c, starts in enumerate(found):
            first = last = None
            for s in sorted(starts):
                if last is not None and s == last + 1:
                    last = s
                    continue
                if last is not None:
                    yield c, first, last
                first = last = s
            if last is not None:
                yield c, first, last
    return run


def _removed(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {"id": [], "tkey": [], "n_removed": [], "kept": []}
            for r in b.to_pylist():
                words = anchors.unpacked(r["packed"]).encode("utf-8", "surrogatepass").split()
                gone = anchors.covered([(x["s0"], x["s1"]) for x in r["runs"]], width, len(words))
                out["id"].append(r["id"])
                out["tkey"].append(r["tkey"])
                out["n_removed"].append(int(gone.sum()))
                out["kept"].append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]))
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(out["id"], pa.int64()), "tkey": pa.array(out["tkey"], pa.int64()),
                "n_removed": pa.array(out["n_removed"], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in out["kept"]], pa.string()),
                "kept": pa.array([k.decode("utf-8", "replace") for k in out["kept"]], pa.string())})
    return run


def later_runs(docs: DataFrame, width: int = WIDTH, gram: int = GRAM,
               block_words: int = BLOCK_WORDS) -> tuple[DataFrame, anchors.Candidates]:
    """(runs, candidates): runs of windows (id, tkey, s0, s1) of ``docs`` (id, tkey, text) that occur earlier too."""
    k = kind(width, gram)
    found = anchors.search(docs, k, block_words)
    here = F.struct("id", "tkey", "i0")
    first = found.classes.where("n > 1").select(
        "anchor", "ctx", F.struct("rep.id", "rep.tkey", "rep.i0").alias("first"))
    copies = found.members.join(first, ["anchor", "ctx"]).where(here != F.col("first")).select(
        "id", "tkey", F.col("i0").alias("s0"), F.col("i1").alias("s1"))
    phrases = anchors.compared(found, k, BATCH_WORDS, _compare(width))
    windows = stored(anchors.hot_windows(found, k), "hot-windows")
    place = F.struct("id", "tkey", "s0")
    least = windows.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hot = windows.join(least.select("w1", "w2", "first"), ["w1", "w2"]).where(place != F.col("first")).select(
        "id", "tkey", "s0", F.col("s0").alias("s1"))
    return copies.unionByName(phrases).unionByName(hot), found


def remove_passages(docs: DataFrame, width: int = WIDTH, gram: int = GRAM,
                    block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256
    and ``kept`` (the remaining words where some were removed, else null)."""
    runs, found = later_runs(anchors.identified(docs), width, gram, block_words)
    cut = anchors.gathered(runs, found).mapInArrow(
        _removed(width), "id long, tkey long, n_removed long, kept_sha256 string, kept string")
    cut = cut.select("id", "tkey", F.col("n_removed").alias("cut"), F.col("kept_sha256").alias("cut_sha256"), "kept")
    words = F.trim(normalised())
    count = F.when(words == "", 0).otherwise(F.length(words) - F.length(F.replace(words, F.lit(" "))) + 1)
    whole = docs.select("doc_id", *anchors.identity(), count.cast("long").alias("n_words"),
                        F.sha2(words, 256).alias("whole_sha256"))
    # of rows that repeat a doc_id and its text, all but one lose every window
    again = F.row_number().over(Window.partitionBy("id", "tkey").orderBy("n_words")) > 1
    rows = whole.join(cut, ["id", "tkey"], "left").withColumn("gone", again & (F.col("n_words") >= width))
    return rows.select(
        "doc_id", "n_words",
        F.when(F.col("gone"), F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(F.col("gone"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_sha256", "whole_sha256")).alias("kept_sha256"),
        F.when(F.col("gone"), "").otherwise(F.col("kept")).alias("kept"))


def op8_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: what repeated passages of 20 words leave of every document."""
    return remove_passages(documents(spark, sf_dir)).drop("kept")
