"""Ranked lexical search over bit-sliced Bloom signatures.

*Index.*  Documents are gathered into blocks of similar size.  A document's
signature holds, for every term and every level of ``LEVELS`` that its count
reaches, ``HASHES`` bits; the signatures of a block are stored by *slice* (one
bitmap over the block's documents for each bit).  The bitmaps of a term
and-ed together give every document that holds it, and some that do not.
Beside them stand each document's length and its term counts.  The index
also holds the exact number of documents of every term.

*Search.*  For a block of items, each term's bitmaps give, level by level, the
largest count that a document can have of it; with the document's length that
bounds the term's contribution, and the weighted sums over an item's terms
bound the document's score from above.  A task keeps the best documents of
every item so far.  A document whose bound for an item stays below the last of
them is excluded by proof; every other one is scored exactly from its term
counts.  The tasks' best rows are merged by one ranking.

Terms are the longest runs of characters other than ASCII ones that are not
letters or digits; only A-Z are lower-cased.  Scores are 64-bit whole numbers:
see ``contribution`` and ``weight``.

Defined results: a null or empty text has no term, so it is no result, and as
an item it has none; an item whose terms no document holds has no result;
repeated rows are documents (or items) of their own; of equal scores the
smaller doc_id comes first, a null one last; an empty table gives an empty
result.  A document of any length is indexed whole: a block holds at most
``BLOCK_DOCS`` documents and is closed after ``BLOCK_BYTES``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import bounded_batches, documents, stored, whole_text

TOP = 20
LEVELS = (1, 2, 4, 8, 16)
HASHES = 5
BITS_PER_KEY = 32
BLOCK_DOCS, BLOCK_BYTES = 512, 4 << 20
ITEMS_PER_BLOCK = 500
_GATHER_DOCS, _GATHER_BYTES = 4096, 16 << 20
_TERM_BYTES = 16 << 20     # of the counts of terms that a task gathers before it hands them on
_FLAT = 4096               # item terms whose contributions are added at a time
_PAIR_TERMS = 1 << 20      # terms of scored pairs that are gathered at a time

# upper case to lower case, all other ASCII that is no letter or digit to a blank; bytes above 0x7F stay
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def mass(length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with ``length`` terms."""
    return 100 - 25 + (25 * length * n_docs) // n_terms


def contribution(w, tf, m):
    """What a term of weight w that occurs tf times adds to a document's score (whole numbers; arrays broadcast)."""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def term_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def slice_numbers(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """(terms x HASHES) slices of the terms at a level, for signatures of ``bits`` bits (a power of two)."""
    h = (hashes + np.full(1, level, np.uint64) * _C1) * _C2
    h ^= h >> np.uint64(29)
    step = (h >> np.uint64(32)) | np.uint64(1)
    at = h[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]
    return ((at * _C1) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)


@dataclass
class Block:
    """Documents with their signatures by slice: ``slices`` is (bits x bytes of a bitmap over the documents)."""

    ids: np.ndarray
    null_id: np.ndarray
    lengths: np.ndarray
    slices: np.ndarray
    terms: list[bytes]           # each document's distinct terms, joined by a blank
    counts: list[np.ndarray]     # and how often it holds them

    def may_hold(self, where: np.ndarray) -> np.ndarray:
        """(terms x documents) booleans from (terms x HASHES) slice numbers."""
        bitmaps = self.slices[where[:, 0]]
        for j in range(1, where.shape[1]):
            bitmaps &= self.slices[where[:, j]]
        return np.unpackbits(bitmaps, axis=1, count=len(self.ids)).astype(bool)


def signature_bits(keys: int) -> int:
    """Bits for documents with so many keys: a power of two, at least BITS_PER_KEY / 2 a key."""
    return max(256, BITS_PER_KEY << max(0, (keys - 1).bit_length()) >> 1)


def build_slices(hashes: list[np.ndarray], counts: list[np.ndarray], bits: int) -> np.ndarray:
    doc = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    h, c = np.concatenate(hashes), np.concatenate(counts)
    grid = np.zeros((bits, len(hashes)), bool)
    for level in LEVELS:
        held = c >= level
        grid[slice_numbers(h[held], level, bits), doc[held, None]] = True
    return np.packbits(grid, axis=1)


_INDEX = ("ids array<long>, lengths array<long>, bits int, slices binary, forward array<binary>, "
          "counts array<binary>, terms array<binary>, dfs array<long>")


def _block_rows(gathered: list[tuple]) -> Iterator[dict]:
    """Index rows of gathered documents (id, length, terms, counts, keys), those of similar size together."""
    gathered.sort(key=lambda d: d[4])
    at = 0
    while at < len(gathered):
        bits, end, size = signature_bits(gathered[at][4]), at, 0
        while (end < len(gathered) and end - at < BLOCK_DOCS and size < BLOCK_BYTES
               and signature_bits(gathered[end][4]) == bits):
            size += sum(map(len, gathered[end][2])) + bits // 8
            end += 1
        docs = gathered[at:end]
        slices = build_slices([term_hashes(d[2]) for d in docs], [d[3] for d in docs], bits)
        yield {"ids": [d[0] for d in docs], "lengths": [d[1] for d in docs], "bits": bits, "slices": slices.tobytes(),
               "forward": [b" ".join(d[2]) for d in docs], "counts": [d[3].astype(np.uint32).tobytes() for d in docs]}
        at = end


_ARROW = pa.schema([("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("bits", pa.int32()),
                    ("slices", pa.binary()), ("forward", pa.list_(pa.binary())), ("counts", pa.list_(pa.binary())),
                    ("terms", pa.list_(pa.binary())), ("dfs", pa.list_(pa.int64()))])


def _row(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([columns], schema=_ARROW)


def build_index(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id, text), written as a table: rows of blocks, and rows of term counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: Counter[bytes] = Counter()
        df_bytes, gathered, size = 0, [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = Counter(terms(text))
                if not found:
                    continue
                before = len(df)
                df.update(found.keys())
                df_bytes += (len(df) - before) * 80 + (sum(map(len, found)) if len(df) > before else 0)
                counts = np.fromiter(found.values(), np.int64, len(found))
                keys = sum(int((counts >= level).sum()) for level in LEVELS)
                own = list(found)
                gathered.append((doc_id, int(counts.sum()), own, counts, keys))
                size += sum(map(len, own)) + 16 * len(own)
                if len(gathered) >= _GATHER_DOCS or size >= _GATHER_BYTES:
                    for row in _block_rows(gathered):
                        yield _row(**row)
                    gathered, size = [], 0
                if df_bytes >= _TERM_BYTES:
                    yield _row(terms=list(df), dfs=list(df.values()))
                    df, df_bytes = Counter(), 0
        for row in _block_rows(gathered):
            yield _row(**row)
        if df:
            yield _row(terms=list(df), dfs=list(df.values()))

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return stored(rows.mapInArrow(run, _INDEX), "lexical-index")


@dataclass
class Items:
    """A block of items as arrays: the terms of item k are ``flat[start[k]:start[k + 1]]`` (numbers of ``vocabulary``)."""

    vocabulary: list[bytes]
    weights: np.ndarray
    hashes: np.ndarray
    flat: np.ndarray
    repeats: np.ndarray
    start: np.ndarray
    n_docs: int
    n_terms: int

    def __len__(self) -> int:
        return len(self.start) - 1

    def sums(self, each: np.ndarray) -> np.ndarray:
        """(items x documents): sums over the items' terms of ``each`` (terms x documents), in bounded pieces."""
        out = np.zeros((len(self), each.shape[1]), np.int64)
        owner = np.repeat(np.arange(len(self)), np.diff(self.start))
        for at in range(0, len(self.flat), _FLAT):
            piece = slice(at, at + _FLAT)
            items, first = np.unique(owner[piece], return_index=True)
            rows = each[self.flat[piece]] * self.repeats[piece, None]
            out[items] += np.add.reduceat(rows, first, axis=0)
        return out


def upper_bounds(block: Block, items: Items) -> np.ndarray:
    """(items x documents) upper bounds of the scores, from the slices and the lengths alone."""
    bits = len(block.slices)
    rows = np.flatnonzero(block.may_hold(slice_numbers(items.hashes, LEVELS[0], bits)).any(axis=1))
    each = np.zeros((len(items.vocabulary), len(block.ids)), np.int64)
    if len(rows):
        most = np.zeros((len(rows), len(block.ids)), np.int64)      # how often a document can hold a term
        alive = np.arange(len(rows))
        for k, level in enumerate(LEVELS):
            reached = block.may_hold(slice_numbers(items.hashes[rows[alive]], level, bits))
            # a level counts only on top of the one below, which every holder has as well
            reached &= most[alive] >= level - 1 if k else True
            top = LEVELS[k + 1] - 1 if k + 1 < len(LEVELS) else np.maximum(block.lengths, level)
            most[alive] = np.where(reached, top, most[alive])
            alive = alive[reached.any(axis=1)]
            if not len(alive):
                break
        m = mass(block.lengths, items.n_docs, items.n_terms)
        each[rows] = contribution(items.weights[rows, None], np.minimum(most, block.lengths), m)
    return items.sums(each)


def exact_scores(block: Block, items: Items, item: np.ndarray, doc: np.ndarray, number: dict[bytes, int]) -> np.ndarray:
    """Scores of the pairs (item, document of a block), from the documents' term counts."""
    which, at = np.unique(doc, return_inverse=True)
    tf = np.zeros((len(items.vocabulary), len(which)), np.int64)
    for j, d in enumerate(which.tolist()):
        own = np.array([number.get(t, -1) for t in block.terms[d].split()], np.int64)
        held = own >= 0
        tf[own[held], j] = block.counts[d][held]
    m = mass(block.lengths[which], items.n_docs, items.n_terms)
    size = np.diff(items.start)[item]
    out = np.zeros(len(item), np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // _PAIR_TERMS, prepend=0)).tolist()
    for lo, hi in zip([0, *cuts], [*cuts, len(item)]):              # pairs whose terms are gathered at a time
        if lo == hi:
            continue
        n = size[lo:hi]
        first = np.cumsum(n) - n
        place = np.repeat(items.start[item[lo:hi]] - first, n) + np.arange(n.sum())
        term, col = items.flat[place], np.repeat(at[lo:hi], n)
        each = contribution(items.weights[term], tf[term, col], m[col]) * items.repeats[place]
        out[lo:hi] = np.add.reduceat(each, first)
    return out


class Best:
    """The best documents of every item so far: by falling score, then doc_id, null ids last."""

    def __init__(self, n: int, top: int):
        self.top = top
        self.rows = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)) for _ in range(n)]
        self.least = np.ones(n, np.int64)            # scores below are no result

    def add(self, block: Block, item: np.ndarray, doc: np.ndarray, scores: np.ndarray) -> None:
        """Take in the scores of pairs (item, document of the block), sorted by item."""
        good = scores >= self.least[item]
        item, doc, scores = item[good], doc[good], scores[good]
        items, first = np.unique(item, return_index=True)
        for k, lo, hi in zip(items.tolist(), first, [*first[1:], len(item)]):
            d = doc[lo:hi]
            s, i, z = (np.concatenate(x) for x in zip(self.rows[k], (scores[lo:hi], block.ids[d], block.null_id[d])))
            order = np.lexsort((i, z, -s))[:self.top]
            self.rows[k] = s[order], i[order], z[order]
            if len(order) == self.top:
                self.least[k] = max(self.least[k], s[order[-1]])


def search_block(block: Block, items: Items, best: Best, number: dict[bytes, int]) -> int:
    """Add a block's results to ``best``; returns how many pairs (item, document) had to be scored."""
    bound = upper_bounds(block, items)
    scored = 0
    if (best.least <= 1).any():                      # no threshold yet: the most promising documents give one
        order = np.argsort(-bound, axis=1, kind="stable")[:, :best.top]
        item, doc = np.repeat(np.arange(len(items)), order.shape[1]), order.reshape(-1)
        best.add(block, item, doc, exact_scores(block, items, item, doc, number))
        bound[item, doc] = 0
        scored = len(item)
    item, doc = np.nonzero(bound >= best.least[:, None])
    if len(item):
        best.add(block, item, doc, exact_scores(block, items, item, doc, number))
    return scored + len(item)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for b in batches:
        for i in range(len(b)):
            at = {name: b.column(k)[i] for k, name in enumerate(b.schema.names)}
            ids = at["ids"].as_py()
            slices = np.frombuffer(at["slices"].as_buffer(), np.uint8).reshape(at["bits"].as_py(), -1)
            yield Block(np.array([x or 0 for x in ids], np.int64), np.array([x is None for x in ids]),
                        np.array(at["lengths"].as_py(), np.int64), slices, at["forward"].as_py(),
                        [np.frombuffer(c, np.uint32).astype(np.int64) for c in at["counts"].as_py()])


def _items(texts: list[str | None], index: DataFrame, n_docs: int, n_terms: int) -> tuple[Items, list[int]] | None:
    """The items of one block as arrays with their numbers in ``texts``; None if no document can match."""
    found = [Counter(terms(t)) for t in texts]
    asked = sorted(set().union(*found)) if found else []
    if not asked:
        return None
    spark = index.sparkSession
    wanted = spark.createDataFrame([(t,) for t in asked], "term binary")
    counted = (index.where(F.col("terms").isNotNull()).select(F.inline(F.arrays_zip("terms", "dfs")))
               .join(F.broadcast(wanted), F.col("terms") == F.col("term"), "left_semi")   # the terms of one block of items
               .groupBy("terms").agg(F.sum("dfs").alias("df")).collect())
    df = {bytes(r["terms"]): r["df"] for r in counted}
    df = {t: n for t, n in df.items() if weight(n_docs, n) > 0}
    vocabulary = sorted(df)
    if not vocabulary:
        return None
    number = {t: i for i, t in enumerate(vocabulary)}
    each = [[(number[t], n) for t, n in c.items() if t in number] for c in found]
    kept = [k for k, e in enumerate(each) if e]
    flat = [p for k in kept for p in each[k]]
    return Items(vocabulary, np.array([weight(n_docs, df[t]) for t in vocabulary], np.int64), term_hashes(vocabulary),
                 np.array([p[0] for p in flat], np.int64), np.array([p[1] for p in flat], np.int64),
                 np.cumsum([0, *(len(each[k]) for k in kept)]), n_docs, n_terms), kept


def search(index: DataFrame, items: DataFrame, top: int = TOP, items_per_block: int = ITEMS_PER_BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every row of ``items`` (item_id, text).

    The items are dealt by hash into blocks of about ``items_per_block``; one
    block at a time is held against the whole index.
    """
    spark = index.sparkSession
    id_kind = items.schema["item_id"].dataType.simpleString()
    empty = spark.createDataFrame([], f"item_id {id_kind}, rank int, doc_id long, score long")
    held = index.where(F.col("bits").isNotNull())
    totals = held.agg(F.sum(F.size("ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    count = items.count()
    if not totals[0] or not count:
        return empty
    n_blocks = -(-count // items_per_block)
    own = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    out = None
    for k in range(n_blocks):
        rows = items.where(own == k).select("item_id", "text").collect()       # about ``items_per_block`` rows
        packed = _items([r["text"] for r in rows], index, *totals)
        if packed is None:
            continue
        found = _search_items(held, packed[0], top)
        names = spark.createDataFrame([(i, rows[n]["item_id"]) for i, n in enumerate(packed[1])],
                                      f"item int, item_id {id_kind}")
        found = found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = stored(found, "ranked") if n_blocks > 1 else found
        out = found if out is None else out.unionByName(found)
    return empty if out is None else out


def _search_items(held: DataFrame, items: Items, top: int) -> DataFrame:
    """(item, rank, doc_id, score) for one block of items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(items.vocabulary)}
        best = Best(len(items), top)
        for block in _blocks(batches):
            search_block(block, items, best, number)
        score, ids, null = (np.concatenate(x) for x in zip(*best.rows))
        item = np.repeat(np.arange(len(items), dtype=np.int32), [len(r[0]) for r in best.rows])
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=null), pa.array(score)],
                                         ["item", "doc_id", "score"])

    bounded_batches(held.sparkSession, 8)
    rows = held.select("ids", "lengths", "bits", "slices", "forward", "counts").mapInArrow(
        run, "item int, doc_id long, score long")
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (rows.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
            .select("item", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the 20 best documents of every item of ``benchmark``."""
    items = read_table(spark, sf_dir, "benchmark", ["item_id", "text"])
    return stored(search(build_index(documents(spark, sf_dir)), items), "ranked")


ORACLE = r"""
WITH tok AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term FROM documents),
posting AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
length AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM posting GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM length),
heavy AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM posting, total GROUP BY term),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))
    AS BIGINT) AS score
  FROM asked JOIN heavy USING (term) JOIN posting USING (term) JOIN length USING (doc_id), total
  GROUP BY item_id, doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 20
"""
