"""Sharding, ranked search and whitening, against brute force."""
import math
import random
import re
import uuid
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_texts import LONG, docs_of, odd_texts, words  # noqa: F401
from pyspark.sql import functions as F

from setbook.llm import ranked_search, sharding, whitening

SF = "/root/testdata/sf0.001"


# ---- sharding

def by_shard(rows):
    out = {}
    for r in rows:
        out.setdefault(r["shard"], []).append(r)
    return out


def sizes(rows):
    return [sum(len((r["text"] or "").encode()) + 16 for r in v) for v in by_shard(rows).values()]


def read(spark, folder, version, docs):
    return read_rows(sharding.read_shards(spark, folder, version, docs))


def read_rows(df):
    return df.select("record.*", "shard", "place", "virtual_slot").collect()


def test_sharding_query(spark):
    rows = sharding.op11_sharding(spark, SF).collect()
    texts = dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
    for shard, own in by_shard(rows).items():
        assert 0 <= shard < 40
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    load = [sum(r["size"] for r in v) for v in by_shard(rows).values()]
    assert max(load) <= max(max(r["size"] for r in rows), 1.1 * sum(load) / 40)


@pytest.mark.parametrize("block_bytes", [5000, 1 << 20])
def test_sharding_growth_moves_little(spark, docs_of, tmp_path, block_bytes):
    docs = docs_of([" ".join(words(i, 5 + i % 60)) for i in range(600)])
    folder = f"{tmp_path}/{uuid.uuid4().hex}"
    one = sharding.write_shards(docs, folder, shards=6, slots=256, block_bytes=block_bytes)
    first = read(spark, folder, one, docs)
    assert sorted(r["text"] for r in first) == sorted(r["text"] for r in docs.collect())
    assert max(sizes(first)) <= 1.02 * min(sizes(first))
    slot = {r["doc_id"]: r["virtual_slot"] for r in first}
    two = sharding.grow(spark, folder, one, 7, block_bytes)
    second = read(spark, folder, two, docs)
    assert {r["doc_id"]: r["virtual_slot"] for r in second} == slot
    assert max(sizes(second)) <= 1.02 * min(sizes(second)) and len(sizes(second)) == 7
    old, new = ({r["doc_id"]: r["shard"] for r in rows} for rows in (first, second))
    assert sum(old[i] != new[i] for i in old) <= 0.2 * len(old)
    for own in by_shard(second).values():
        assert sorted(r["place"] for r in own) == list(range(len(own)))
    # the version before can still be read; a shard can be given up again
    assert sorted(map(tuple, read(spark, folder, one, docs))) == sorted(map(tuple, first))
    three = sharding.grow(spark, folder, two, 5, block_bytes)
    third = read(spark, folder, three, docs)
    assert set(by_shard(third)) == set(range(5)) and {r["doc_id"] for r in third} == set(old)
    assert max(sizes(third)) <= 1.02 * min(sizes(third))


def test_sharding_edges(spark, docs_of, odd_texts, tmp_path):
    # nulls, very long texts, repeated rows that are a third of all, names that clash with the places
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(7, "same " * 9)] * 600 + [(None, f"n{i} " * 9) for i in range(600)]
    docs = docs_of(rows).withColumn("slot", F.lit(1)).withColumn("shard", F.lit("s")).withColumn("record", F.lit(2.0))
    folder = f"{tmp_path}/{uuid.uuid4().hex}"
    version = sharding.write_shards(docs, folder, shards=4, slots=2048)
    back = sharding.read_shards(spark, folder, version, docs)
    assert sorted(map(repr, back.select("record.*").collect())) == sorted(map(repr, docs.collect()))
    placed = back.select(F.col("shard").alias("at"), "place", F.col("record.text").alias("text")).collect()
    load, same = {}, {}
    for r in placed:
        load[r["at"]] = load.get(r["at"], 0) + len((r["text"] or "").encode()) + 16
        same[r["at"]] = same.get(r["at"], 0) + (r["text"] == "same " * 9)
    assert max(load.values()) <= len(LONG.encode()) + 16 + 4000
    assert sum(n > 0 for n in same.values()) >= 2                       # the copies do not all lie in one shard
    empty = docs.where("false")
    folder = f"{tmp_path}/{uuid.uuid4().hex}"
    assert read_rows(sharding.read_shards(spark, folder, sharding.write_shards(empty, folder), docs_of([]))) == []


def test_dealt_and_edited():
    r = random.Random(5)
    sizes_ = {s: r.randint(0, 1000) for s in range(500)}
    at = sharding.dealt(sizes_, 8)
    again = sharding.edited(sizes_, at, 8)
    assert sum(at[s] != again[s] for s in at) <= 8
    more = sharding.edited(sizes_, at, 9)
    load = [sum(sizes_[s] for s in more if more[s] == k) for k in range(9)]
    assert max(load) - min(load) <= 0.01 * max(load)


# ---- ranked search

def plain_terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in found]


def plain_search(docs, items, top):
    """docs: (doc_id, text); returns (item number, rank, doc_id, score) rows."""
    found = [(i, Counter(plain_terms(t))) for i, t in docs]
    found = [(i, t, sum(t.values())) for i, t in found if t]
    n_docs, n_terms = len(found), sum(n for _, _, n in found)
    df = Counter(x for _, t, _ in found for x in t)
    w = {x: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for x, d in df.items()}
    out = []
    for k, item in items:
        asked, scored = Counter(plain_terms(item)), []
        for i, t, n in found:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            s = sum(times * (w[x] * ((1000000000 * t[x]) // (1000 * t[x] + 12 * m))) for x, times in asked.items() if x in t)
            if s > 0:
                scored.append((-s, i is None, i))
        for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1):
            out.append((k, rank, i, -s))
    return out


def search(spark, docs, items, **kw):
    table = spark.createDataFrame(items, "item_id long, text string, doc_id long")
    return [tuple(r) for r in ranked_search.search(ranked_search.build_index(docs), table.drop("doc_id"), **kw).collect()]


@pytest.mark.parametrize("block_docs, bits", [(512, 32), (7, 2)])
def test_ranked_search_brute_force(spark, docs_of, odd_texts, monkeypatch, block_docs, bits):
    monkeypatch.setattr(ranked_search, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(ranked_search, "BITS_PER_KEY", bits)           # few bits: many false hits, the same result
    r = random.Random(3)
    texts = [(i, t) for i, t in enumerate(odd_texts)]
    texts += [(100 + i, " ".join(words(i % 40, r.randint(1, 150), 90)).title()) for i in range(160)]
    texts += [(None, "Ünter THE cat"), (90, "the CAT, the cat"), (90, "the CAT, the cat"), (3, "1 2 3 the")]
    items = [(k, " ".join(words(200 + k, 12, 90)), 0) for k in range(9)]
    items += [(20, None, 0), (21, "", 0), (22, "the the cat cat ünter 1", 0), (23, "qqqq zzzz", 0), (24, LONG, 0)]
    for blocks in (500, 5):
        got = search(spark, docs_of(texts), items, top=7, items_per_block=blocks)
        assert sorted(got) == sorted(plain_search(texts, [i[:2] for i in items], 7))


def test_ranked_search_repeats_and_empty(spark, docs_of):
    items = [(1, "alpha beta", 0), (1, "alpha beta", 0), (None, "beta", 0)]
    got = search(spark, docs_of([(5, "alpha"), (4, "Alpha"), (6, "beta-beta")]), items, top=2)
    one = plain_search([(5, "alpha"), (4, "Alpha"), (6, "beta-beta")], [(1, "alpha beta"), (None, "beta")], 2)
    assert sorted(map(repr, got)) == sorted(map(repr, [x for x in one if x[0] == 1] * 2 + [x for x in one if x[0] is None]))
    assert search(spark, docs_of([]), items) == []
    assert search(spark, docs_of([None, "", "?!"]), items) == []
    assert search(spark, docs_of(["alpha"]), []) == []


def test_bounds_hold_and_exclude():
    r = random.Random(11)
    texts = [" ".join(words(i, r.randint(1, 300), 3000)) for i in range(400)]
    found = [ranked_search.Counter(ranked_search.terms(t)) for t in texts]
    df = ranked_search.Counter(x for f in found for x in f)
    gathered = [(i, sum(f.values()), list(f), np.array(list(f.values())), len(f)) for i, f in enumerate(found)]
    n, total = len(texts), sum(sum(f.values()) for f in found)
    vocabulary = sorted(x for x in df if ranked_search.weight(n, df[x]) > 0)
    number = {x: k for k, x in enumerate(vocabulary)}
    asked = [[number[x] for x in ranked_search.Counter(ranked_search.terms(" ".join(words(k, 15, 3000)))) if x in number]
             for k in range(20)]
    items = ranked_search.Items(
        vocabulary, np.array([ranked_search.weight(n, df[x]) for x in vocabulary]), ranked_search.term_hashes(vocabulary),
        np.array(sum(asked, [])), np.ones(sum(map(len, asked)), int), np.cumsum([0, *map(len, asked)]), n, total)
    best, scored, pairs = ranked_search.Best(20, 3), 0, 0
    for row in ranked_search._block_rows(gathered):
        block = ranked_search.Block(
            np.array(row["ids"]), np.zeros(len(row["ids"]), bool), np.array(row["lengths"]),
            np.frombuffer(row["slices"], np.uint8).reshape(row["bits"], -1), row["forward"],
            [np.frombuffer(c, np.uint32).astype(np.int64) for c in row["counts"]])
        item, doc = (x.reshape(-1) for x in np.indices((20, len(block.ids))))
        exact = ranked_search.exact_scores(block, items, item, doc, number).reshape(20, -1)
        bound = ranked_search.upper_bounds(block, items)
        assert (bound >= exact).all()
        scored += ranked_search.search_block(block, items, best, number)
        pairs += exact.size
    assert scored < 0.5 * pairs


# ---- whitening

def plain_whitening(vectors, k=4):
    x = np.array([[math.floor(256 * float(c)) for c in v] for v in vectors], np.int64)
    u = np.unique(x, axis=0)
    n, total = len(u), u.sum(0)
    z = u - total / n
    e, v = np.linalg.eigh(z.T @ z / n)
    e, v = e[::-1][:k], v[:, ::-1].T[:k]
    w = (x - total / n) @ v.T / np.sqrt(e)
    return n, [int(d) for d in ((n * x - total) ** 2).sum(1)], w, e / np.trace(z.T @ z / n)


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, x int, vector string")


def whitened(spark, rows, **kw):
    q = whitening.quantised(vectors_of(spark, rows), "vec_id", "embedding")
    model = whitening.fit(q, **kw)
    return model, (whitening.whiten(q, model).collect() if model else [])


def test_whitening_query(spark):
    rows = whitening.op13_whitening(spark, SF).collect()
    table = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    n, deviation, w, explained = plain_whitening([v for _, v in table])
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == 4 * len(table)
    for c in range(4):
        mine = np.array([got[i, c + 1]["whitened"] for i, _ in table])
        sign = np.sign((mine * w[:, c]).sum())
        assert np.abs(mine - sign * w[:, c]).max() < 1e-9
        assert abs(rows[0]["n"] - n) == 0 and abs(got[table[0][0], c + 1]["explained"] - explained[c]) < 1e-12
    assert [got[i, 1]["deviation"] for i, _ in table] == deviation
    assert rows[0]["identity_error"] < 1e-9


def test_whitening_edges(spark):
    r = random.Random(2)
    good = [[r.gauss(0, 1) for _ in range(6)] for _ in range(40)]
    odd = [None, [], [None] * 6, [1.0] * 5 + [float("nan")], [float("inf")] + [0.0] * 5, [1.0, 2.0]]
    rows = [(i, v, "a", 1, "v") for i, v in enumerate(good)]
    plain, _ = whitened(spark, rows)
    more = rows + [(500, v, "a", 1, "v") for v in odd] + [(0, good[0], "b", 2, "w")] * 300 + [(None, good[1], "", 0, "")]
    model, out = whitened(spark, more)
    assert (model.n, model.total) == (plain.n, plain.total) and np.allclose(model.eigenvalues, plain.eigenvalues)
    ids = [o["id"] for o in out]
    assert len(out) == 4 * (40 + 300 + 1) and ids.count(None) == 4 and 500 not in ids
    # rank below four, one distinct vector, no vector, entries of any size
    flat = [(i, [float(i), 2.0 * i, 0.0], "", 0, "") for i in range(9)]
    model, out = whitened(spark, flat)
    assert len(model.eigenvalues) == 1 and len(out) == 9 and model.identity_error < 1e-9
    assert whitened(spark, [(1, [1.0, 2.0], "", 0, "")] * 4) == (None, [])
    assert whitened(spark, [(1, None, "", 0, "")]) == (None, [])
    model, out = whitened(spark, [(1, [3e30, 1.0], "", 0, ""), (2, [-3e30, 2.0], "", 0, ""), (3, [0.5, 0.25], "", 0, "")])
    assert len(out) == 3 * len(model.eigenvalues)


def test_cholesky_and_jacobi():
    rng = np.random.default_rng(3)
    for d, rank in ((1, 1), (2, 1), (7, 7), (12, 5), (33, 33)):
        a = rng.normal(size=(d, rank)) * 10.0 ** rng.integers(-3, 3, rank)
        v = a @ a.T
        low = whitening.pivoted_cholesky(v)
        assert low.shape[1] <= d and np.allclose(low @ low.T, v, rtol=0, atol=1e-9 * np.abs(v).max())
        e, axes = whitening.one_sided_jacobi(low)
        want = np.linalg.eigvalsh(v)[::-1][:len(e)]
        assert np.allclose(e, want, rtol=1e-6, atol=1e-10 * want[0])
        assert np.allclose(axes @ axes.T, np.eye(len(e)), atol=1e-9)
    assert len(whitening.one_sided_jacobi(np.zeros((3, 0)))[0]) == 0
