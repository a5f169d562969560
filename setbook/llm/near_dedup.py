"""Near-duplicate classes by ProbMinHash, banding and verification.

1. Shingles of five words, weighted by how often the text holds them.  Each
   shingle sends arrivals of a Poisson process, whose rate is its weight,
   to random registers; a register keeps the first arrival.  A shingle stops
   once its next arrival comes after every register's.  Two texts agree in a
   register with their probability Jaccard similarity
   ``sum_d 1 / sum_e max(a_e / a_d, b_e / b_d)`` over common shingles d.
2. Equal texts (white space aside) are one node.  Nodes that agree in all
   registers of a band share a bucket; 24 bands of 5 registers miss a pair of
   similarity 0.8 with probability below 1e-4.
3. A bucket is never expanded into all pairs.  Every node is compared with
   two leaders of each of its buckets: the most central member (the one
   that shares buckets with most others, as the original of a group of
   copies does) and a random one.  That joins the bulk of any group, however
   large.  What is still in another class than most of its bucket is then
   compared with all members outside its class: pair by pair in small
   buckets, else as a query set against all members, in blocks, which
   yields links only.  So no pair that shares a bucket stays untested
   across classes.
4. Compared means: the exact similarity of the whole texts' shingles is
   computed and must reach ``similarity``.  Connected components of these
   links are the classes.

Defined results: a text of one to four words is one shingle; null and empty
texts are equal to each other, blank ones too, and similar to nothing else;
repeated rows are copies; of rows with the smallest doc_id of a class the first read
stays, a null doc_id comes last; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, documents, give_back, keep_rows, let_go, stored, text_key, whole_text
from .components import components

SHINGLE = 5
BANDS, ROWS = 24, 5
CLASS_PARTS = 16           # parts that a class of any size is dealt to in the last join
SMALL_BUCKET = 32          # members; larger buckets are compared in blocks
_M = BANDS * ROWS
_MEMO_WORDS, _MEMO_LENGTH = 120_000, 64      # words kept, and the longest of them in bytes

_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit function of each number."""
    x = x + _C1
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words, through a bounded table per worker."""

    def __init__(self):
        self.memo: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) > _MEMO_WORDS:
            memo.clear()
        new = set(words).difference(memo)
        for w in new:
            memo[w] = xxhash.xxh3_64_intdigest(w)
        out = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        for w in new:
            if len(w) > _MEMO_LENGTH:
                del memo[w]
        return out


def shingles(text: str, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the distinct shingles of a text, by hash."""
    w = hashes(text.encode("utf-8", "surrogatepass").split())     # splits at ASCII white space only
    if not len(w):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    width = min(SHINGLE, len(w))
    s = np.full(len(w) - width + 1, np.uint64(width))
    for k in range(width):
        s = s * _C1 + w[k:len(w) - width + 1 + k]
    return np.unique(_mix(s), return_counts=True)


def signatures(found: list[tuple[np.ndarray, np.ndarray]], m: int = _M) -> np.ndarray:
    """ProbMinHash registers (texts x m) of weighted shingle sets; zeros for an empty set."""
    sizes = [len(h) for h, _ in found]
    doc = np.repeat(np.arange(len(found)), sizes)
    shingle = np.concatenate([h for h, _ in found]) if found else np.empty(0, np.uint64)
    rate = np.concatenate([c for _, c in found]).astype(float) if found else np.empty(0)
    first = np.full((len(found), m), np.inf)
    winner = np.zeros((len(found), m), np.uint64)
    flat_first, flat_winner = first.reshape(-1), winner.reshape(-1)
    at, stream = np.zeros(len(doc)), shingle
    while len(doc):
        stream = _mix(stream)
        u = ((stream >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53
        at = at - np.log(u) / rate
        place = doc * m + (_mix(stream ^ _C3) % np.uint64(m)).astype(np.int64)
        better = np.flatnonzero(at < flat_first[place])
        better = better[np.argsort(-at[better], kind="stable")]       # the earliest is written last
        flat_first[place[better]] = at[better]
        flat_winner[place[better]] = shingle[better]
        going = at < first.max(axis=1)[doc]
        doc, shingle, rate, at, stream = doc[going], shingle[going], rate[going], at[going], stream[going]
    return winner


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard similarity of two weighted shingle sets."""
    (ha, ca), (hb, cb) = a, b
    _, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    x, y = ca[ia].astype(float), cb[ib].astype(float)
    order = np.argsort(-x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    last = np.searchsorted(-ratio, -ratio, side="right")              # how many have a ratio at least as large
    above = (ca.sum() - x.sum()) + np.cumsum(x)[last - 1]
    below = (cb.sum() - y.sum()) + y.sum() - np.cumsum(y)[last - 1]
    return float((1.0 / (above / x + below / y)).sum())


def _sign(docs: DataFrame) -> DataFrame:
    """(row, doc_id, key, bands) of every row; key is equal for equal texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        hashes = WordHashes()
        for b in batches:
            found = [shingles(t, hashes) for t in b["text"]]
            sig = signatures(found).reshape(len(b), BANDS, ROWS)
            key = np.zeros((len(b), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for r in range(ROWS):
                key = _mix(key * _C1 + sig[:, :, r])
            bands = [k if len(h) else k[:0] for k, (h, _) in zip(key.view(np.int64), found)]
            yield pd.DataFrame({"row": b["row"], "doc_id": b["doc_id"], "key": b["key"], "bands": bands})
        give_back()

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       text_key().alias("key"), whole_text().alias("text"))
    return rows.mapInPandas(run, "row long, doc_id long, key binary, bands array<long>")


def _profiles(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, hashes, counts) of the shingles of the nodes (node, doc_id, key)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        hashes = WordHashes()
        for b in batches:
            found = [shingles(t, hashes) for t in b["text"]]
            yield pd.DataFrame({"node": b["node"], "hashes": [h.tobytes() for h, _ in found],
                                "counts": [c.astype(np.uint32).tobytes() for _, c in found]})
        give_back()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("own"), whole_text().alias("text"))
    mine = nodes.withColumnRenamed("doc_id", "id")
    same = texts["doc_id"].eqNullSafe(mine["id"]) & (texts["own"] == mine["key"])
    return texts.join(mine, same).select("node", "text").mapInPandas(run, "node long, hashes binary, counts binary")


def _verified(pairs: DataFrame, profiles: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose exact similarity is at least ``least``, with it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        for b in batches:
            sides = [[(np.frombuffer(h, np.uint64), np.frombuffer(c, np.uint32)) for h, c in zip(b[f"{s}h"], b[f"{s}c"])]
                     for s in "uv"]
            sim = np.array([similarity(x, y) for x, y in zip(*sides)], float)
            yield pd.DataFrame({"u": b["u"], "v": b["v"], "sim": sim})[sim >= least]
        give_back()

    side = lambda s: profiles.select(F.col("node").alias(s), F.col("hashes").alias(f"{s}h"),
                                     F.col("counts").alias(f"{s}c"))
    return pairs.join(side("u"), "u").join(side("v"), "v").mapInPandas(run, "u long, v long, sim double").distinct()


def _leader_pairs(shared: DataFrame) -> DataFrame:
    """Distinct (u, v), u < v: every bucket member with the bucket's two leaders."""
    sizes = shared.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    reach = shared.join(sizes, "band").groupBy("node").agg(F.sum("n").alias("reach"))
    central = shared.join(reach, "node").groupBy("band").agg(
        F.max(F.struct("reach", "node"))["node"].alias("leader"))
    mask = F.xxhash64("band")
    random = shared.groupBy("band").agg(F.min(F.col("node").bitwiseXOR(mask)).alias("x")).select(
        "band", F.col("x").bitwiseXOR(mask).alias("leader"))
    pairs = shared.join(central.unionByName(random), "band").where(F.col("node") != F.col("leader"))
    return pairs.select(F.least("node", "leader").alias("u"), F.greatest("node", "leader").alias("v")).distinct()


def _unjoined(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """(band, node, root, main, n): the rows of buckets with more than one class, and their largest class."""
    rows = shared.join(classes, shared["node"] == classes["member"], "left").select(
        "band", "node", F.coalesce("root", "node").alias("root"))
    sizes = rows.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("main"),
                                      F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots"))
    return rows.join(mixed.where((F.col("roots") > 1) & (F.col("n") > 2)).drop("roots"), "band")


def _rest_pairs(unjoined: DataFrame, tested: DataFrame) -> DataFrame:
    """Untested pairs of a bucket that are in different classes; one side is always outside its largest class."""
    left = unjoined.where(F.col("root") != F.col("main")).select("band", F.col("node").alias("a"), F.col("root").alias("ra"))
    right = unjoined.select("band", F.col("node").alias("b"), F.col("root").alias("rb"), "main")
    across = (F.col("ra") != F.col("rb")) & ((F.col("rb") == F.col("main")) | (F.col("a") < F.col("b")))
    pairs = left.join(right, "band").where(across).select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
    return pairs.distinct().join(tested, ["u", "v"], "left_anti")


def block_links(queries: list, members: list, least: float) -> Iterator[tuple[int, int, float]]:
    """Links (node, node, similarity) of queries with members of other classes.

    Both are lists of (node, class, hashes, counts).  Postings of the members'
    shingles give, for each query, the mass of both sides on common shingles;
    their minimum bounds the similarity, which is computed where it can reach
    ``least``.
    """
    owner = np.repeat(np.arange(len(members)), [len(m[2]) for m in members])
    hashes = np.concatenate([m[2] for m in members])
    counts = np.concatenate([m[3] for m in members]).astype(float)
    order = np.argsort(hashes, kind="stable")
    owner, hashes, counts = owner[order], hashes[order], counts[order]
    total = np.array([m[3].sum() for m in members], float)
    classes = np.array([m[1] for m in members])
    for node, root, h, c in queries:
        lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        mine = np.bincount(owner[at], np.repeat(c.astype(float), n), len(members)) / c.sum()
        theirs = np.bincount(owner[at], counts[at], len(members)) / total
        for k in np.flatnonzero((np.minimum(mine, theirs) >= least - 1e-9) & (classes != root)).tolist():
            sim = similarity((h, c), members[k][2:])
            if sim >= least:
                yield node, members[k][0], sim


def _rest_links(unjoined: DataFrame, profiles: DataFrame, least: float, queries: int = 512, members: int = 512) -> DataFrame:
    """Links (u, v, sim) across the classes of large buckets.

    The buckets of one main class are taken together: what is outside it is
    the query set.  Queries and members are dealt into blocks by hash, and
    every cell (a block of queries, a block of members) is one group of
    bounded size.
    """
    asked = unjoined.where(F.col("root") != F.col("main")).select("main", "node", "root").distinct()
    there = unjoined.select("main", "node", "root").distinct()
    blocks = (asked.groupBy("main").agg(F.ceil(F.count(F.lit(1)) / queries).cast("int").alias("qs"))
              .join(there.groupBy("main").agg(F.ceil(F.count(F.lit(1)) / members).cast("int").alias("ms")), "main"))
    draw = F.xxhash64("node")
    side = lambda rows, name, own, other, is_query: rows.join(blocks, "main").join(profiles, "node").select(
        "main", "node", "root", "hashes", "counts", F.lit(is_query).alias("query"),
        F.pmod(draw, F.col(own)).cast("int").alias(name),
        F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("q" if name == "m" else "m"))
    cells = side(asked, "q", "qs", "ms", True).unionByName(side(there, "m", "ms", "qs", False))

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        rows = [(n, r, np.frombuffer(h, np.uint64), np.frombuffer(c, np.uint32), q) for n, r, h, c, q in
                zip(cell["node"], cell["root"], cell["hashes"], cell["counts"], cell["query"])]
        found = list(block_links([x[:4] for x in rows if x[4]], [x[:4] for x in rows if not x[4]], least)) \
            if any(x[4] for x in rows) and not all(x[4] for x in rows) else []
        return pd.DataFrame([(min(a, b), max(a, b), s) for a, b, s in found], columns=["u", "v", "sim"])

    return cells.groupBy("main", "q", "m").applyInPandas(run, "u long, v long, sim double").distinct()


def near_links(docs: DataFrame, least: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(rows, links): the signed rows with their node, and verified links (u, v, sim) between nodes."""
    bounded_batches(docs.sparkSession)
    signed = stored(_sign(docs), "signed")
    groups = signed.groupBy("key").agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"))
    groups = stored(groups, "nodes")
    rows = signed.select("row", "doc_id", "key").join(groups, "key")
    heads = signed.join(groups.select("node"), signed["row"] == F.col("node"), "left_semi")
    members = heads.select(F.col("row").alias("node"), F.explode("bands").alias("band"))
    full = members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    shared = stored(members.join(full, "band"), "buckets")
    wanted = shared.select("node").distinct().join(
        signed.select(F.col("row").alias("node"), "doc_id", "key"), "node")
    profiles = stored(_profiles(docs, wanted), "profiles")
    tested = stored(_leader_pairs(shared), "pairs")
    links = stored(_verified(tested, profiles, least), "links")
    classes = components(links).withColumnRenamed("node", "member")
    unjoined = stored(_unjoined(shared, classes), "unjoined")
    few = stored(_verified(_rest_pairs(unjoined.where(F.col("n") <= SMALL_BUCKET), tested), profiles, least), "links")
    many = stored(_rest_links(unjoined.where(F.col("n") > SMALL_BUCKET), profiles, least), "links")
    return rows, links.unionByName(few).unionByName(many)


def near_classes(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, key, class_id, class_size, kept.

    ``class_id`` is the smallest doc_id of the class; ``kept`` marks the one row that stays.
    """
    rows, links = near_links(docs, least)
    roots = components(links).select(F.col("node").alias("member"), "root")
    rows = rows.join(roots, rows["node"] == roots["member"], "left").select(
        "row", "doc_id", "key", F.coalesce("root", "node").alias("root"),
        (F.col("root").isNull() & (F.col("copies") == 1)).alias("alone"))
    rows = stored(rows, "classed")
    single = rows.where("alone").select("doc_id", "key", F.col("doc_id").alias("class_id"),
                                        F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"))
    rows = rows.where(~F.col("alone"))
    best = rows.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first"),
        F.count(F.lit(1)).alias("class_size"))
    # a class may hold a third of all rows: its rows are dealt to parts, each of which gets the class's one row
    best = best.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(CLASS_PARTS - 1))))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(CLASS_PARTS)).cast("int"))
    return rows.join(best, ["root", "part"]).select(
        "doc_id", "key", F.col("first.doc_id").alias("class_id"), "class_size",
        (F.col("row") == F.col("first.row")).alias("kept")).unionByName(single)


def keep_one_of_each(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """``docs`` (all columns) with one document of each near-duplicate class."""
    return keep_rows(docs, near_classes(docs, least).where("kept").select("doc_id", "key"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the near-duplicate class of every document."""
    return near_classes(documents(spark, sf_dir)).select("doc_id", "class_id", "class_size", "kept")
