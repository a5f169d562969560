"""Operators that compare documents, against brute force."""
import glob
import hashlib
import os
import random
import re
import time

import duckdb
import numpy as np
from llm_texts import docs_of, odd_texts, words  # noqa: F401

from setbook.llm import anchors, common, near_dedup, phrase_dedup, suffix_dedup
from setbook.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"


def table_rows():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()


# ---- near duplicates

def profile(text):
    w = (text or "").encode().split()
    k = min(5, len(w))
    out = {}
    for i in range(len(w) - k + 1 if w else 0):
        s = (k, *w[i:i + k])
        out[s] = out.get(s, 0) + 1
    return out


def plain_similarity(a, b):
    total = 0.0
    for d in a.keys() & b.keys():
        total += 1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys())
    return total


def as_arrays(p):
    keys = {s: int.from_bytes(hashlib.sha256(repr(s).encode()).digest()[:8], "big") for s in p}
    order = sorted(p, key=keys.get)
    return np.array([keys[s] for s in order], np.uint64), np.array([p[s] for s in order])


def variants(seed, base, n, rate):
    r = random.Random(seed)
    return [" ".join(w if r.random() > rate else "zz%d" % r.randrange(999) for w in base) for _ in range(n)]


def brute_classes(rows, least=0.8):
    n = len(rows)
    profiles = [profile(t) for _, t in rows]
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            same = re.sub(r"\s+", " ", rows[i][1] or "") == re.sub(r"\s+", " ", rows[j][1] or "")
            a, b = profiles[i], profiles[j]
            if a and b and not same:
                common = len(a.keys() & b.keys())
                same = common and common / len(a.keys() | b.keys()) > 0.4 and plain_similarity(a, b) >= least
            if same:
                root[find(i)] = find(j)
    least_id = {}
    for i in range(n):
        k = find(i)
        least_id[k] = min(least_id.get(k, rows[i][0]), rows[i][0])
    return {rows[i][0]: least_id[find(i)] for i in range(n)}


def test_similarity_and_registers():
    r = random.Random(4)
    for _ in range(60):
        a = {("s", k): r.randint(1, 5) for k in r.sample(range(40), r.randint(1, 30))}
        b = {("s", k): r.randint(1, 5) for k in r.sample(range(40), r.randint(1, 30))}
        assert abs(near_dedup.similarity(as_arrays(a), as_arrays(b)) - plain_similarity(a, b)) < 1e-9
    a = {("s", k): 1 + k % 4 for k in range(60)}
    b = {("s", k): 1 + k % 3 for k in range(12, 70)}
    m = 4000
    sig = near_dedup.signatures([as_arrays(a), as_arrays(b), as_arrays(a), as_arrays({("s", 1): 7}), as_arrays({})], m)
    assert (sig[0] == sig[2]).all() and not sig[4].any() and len(set(sig[3].tolist())) == 1
    assert abs((sig[0] == sig[1]).mean() - plain_similarity(a, b)) < 0.03


def test_near_classes_brute_force(docs_of, odd_texts):
    base = [words(k, 60 + 20 * k) for k in range(4)]
    texts = [t for t in odd_texts if not t or len(t) < 1000]
    for k, b in enumerate(base):
        texts += variants(k, b, 14, 0.01 + 0.012 * k) + [" ".join(b)] * 3 + ["  ".join(b)]
    r = random.Random(9)
    r.shuffle(texts)
    rows = [(i * 7 + 3, t) for i, t in enumerate(texts)]
    rows.append((rows[5][0], rows[5][1]))
    out = near_dedup.near_classes(docs_of(rows)).collect()
    assert len(out) == len(rows)
    assert {x["doc_id"]: x["class_id"] for x in out} == brute_classes(rows)
    sizes = {}
    for x in out:
        sizes[x["class_id"]] = sizes.get(x["class_id"], 0) + 1
    assert all(x["class_size"] == sizes[x["class_id"]] for x in out)
    assert sum(x["kept"] for x in out) == len(sizes) and all(x["doc_id"] == x["class_id"] for x in out if x["kept"])
    kept = near_dedup.keep_one_of_each(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(sizes)


def test_large_buckets_are_compared_in_blocks(spark):
    """A query set against all members, in blocks of every size, finds exactly the links across classes."""
    r = random.Random(12)
    base = [words(90, 40), words(91, 40)]
    texts = [t for k, b in enumerate(base) for t in variants(k, b, 25, 0.02)]
    texts += [t + " " + " ".join(["loop"] * 40) for t in variants(7, base[0], 6, 0.02)]
    hashes = near_dedup.WordHashes()
    found = [near_dedup.shingles(t, hashes) for t in texts]
    root = {i: (0 if r.random() < 0.5 else i) for i in range(len(texts))}
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if root[i] != root[j]
            and near_dedup.similarity(found[i], found[j]) >= 0.8}
    profiles = spark.createDataFrame(
        [(i, bytearray(h.tobytes()), bytearray(c.astype(np.uint32).tobytes())) for i, (h, c) in enumerate(found)],
        "node long, hashes binary, counts binary")
    unjoined = spark.createDataFrame([(b, i, root[i], 0, len(texts)) for i in range(len(texts)) for b in (1, 2)],
                                     "band long, node long, root long, main long, n long")
    for q, m in ((512, 512), (7, 5), (1, 1000)):
        got = near_dedup._rest_links(unjoined, profiles, 0.8, q, m).collect()
        assert {(x["u"], x["v"]) for x in got} == want and len(got) == len(want) > 50
    assert near_dedup._rest_links(unjoined.limit(0), profiles, 0.8).count() == 0


def test_near_classes_with_blocks_only(docs_of, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 2)
    texts = [t for k in range(3) for t in variants(k, words(k, 80), 12, 0.02)]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    out = near_dedup.near_classes(docs_of(rows)).collect()
    assert {x["doc_id"]: x["class_id"] for x in out} == brute_classes(rows)


def test_near_classes_edges(docs_of):
    assert near_dedup.near_classes(docs_of(["a"]).limit(0)).count() == 0
    out = near_dedup.near_classes(docs_of([(None, "a b"), (None, "a b"), (3, "a  b"), (4, "c")])).collect()
    assert sum(x["kept"] for x in out) == 2 and {x["class_id"] for x in out} == {3, 4}


def test_rest_pairs_reach_across_classes(spark):
    """Members outside a bucket's main class meet all members of other classes, untested pairs only."""
    shared = spark.createDataFrame([(1, n) for n in range(6)] + [(2, 8), (2, 9)], "band long, node long")
    classes = spark.createDataFrame([(0, 0), (1, 0), (2, 0), (3, 3), (4, 3)], "member long, root long")
    tested = spark.createDataFrame([(0, 3), (8, 9)], "u long, v long")
    got = {tuple(x) for x in near_dedup._rest_pairs(near_dedup._unjoined(shared, classes), tested).collect()}
    assert got == {(1, 3), (2, 3), (0, 4), (1, 4), (2, 4), (0, 5), (1, 5), (2, 5), (3, 5), (4, 5)}


# ---- repeated strings

def runs(flags):
    return sum(f and not p for p, f in zip([False, *flags], flags))


def brute_bytes(rows, width):
    raw = [(t or "").encode() for _, t in rows]
    seen = {}
    for d in raw:
        for i in range(len(d) - width + 1):
            seen[d[i:i + width]] = seen.get(d[i:i + width], 0) + 1
    out = []
    for (k, _), d in zip(rows, raw):
        gone = [False] * len(d)
        for i in range(len(d) - width + 1):
            if seen[d[i:i + width]] > 1:
                gone[i:i + width] = [True] * width
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((k, len(d), sum(gone), runs(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda x: (x[0] is not None, x))


def collected(df, columns):
    return sorted((tuple(x[c] for c in columns) for x in df.collect()), key=lambda x: (x[0] is not None, x))


def passages(seed=1):
    r = random.Random(seed)
    pool = [" ".join(words(100 + k, 30)) for k in range(6)]
    out = []
    for k in range(40):
        parts = [" ".join(words(500 + 50 * k + j, r.randint(1, 25))) for j in range(4)]
        parts.insert(r.randint(0, 4), r.choice(pool))
        if r.random() < 0.5:
            p = r.choice(pool)
            parts.append(p[r.randint(0, 40):len(p) - r.randint(0, 40)])
        out.append(r.choice([" ", "\n", "  "]).join(parts))
    return out + [out[3], out[3], "ab" * 300, "x y " * 80, "é" * 150]


BYTES = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_suffix_order_and_prefixes():
    r = random.Random(3)
    for _ in range(200):
        t = bytes(r.choice(b"abc") for _ in range(r.randint(1, 60))) + b"\xff"
        order = suffix_dedup.suffix_order(t, len(t)).tolist()
        assert order == sorted(range(len(t)), key=lambda i: t[i:])
        common = suffix_dedup.long_prefixes(t, np.array(order), 8)
        for k in range(1, len(order)):
            a, b = t[order[k - 1]:], t[order[k]:]
            n = next((i for i in range(8) if a[i:i + 1] != b[i:i + 1]), 8)
            assert common[k] == n


class Sliced(bytes):
    """Bytes that count how often Python code takes something out of them."""

    taken = 0

    def __getitem__(self, key):
        self.taken += 1
        return super().__getitem__(key)


def test_suffix_order_cuts_out_few_suffixes():
    r = random.Random(11)
    words = [bytes(r.choice(b"abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(60)]
    text = Sliced(b"\xff".join(b" ".join(r.choices(words, k=90)) for _ in range(6)) + b"\xff")
    order = suffix_dedup.suffix_order(text, 40)
    assert text.taken < len(text) / 2
    cuts = [bytes(text)[i:i + 40] for i in order.tolist()]
    assert cuts == sorted(cuts) and sorted(order.tolist()) == list(range(len(text)))


def test_suffix_order_of_equal_beginnings_and_their_prefixes(monkeypatch):
    r = random.Random(12)
    for keys in (1, 7, 1 << 10):
        monkeypatch.setattr(suffix_dedup, "SORTED_KEYS", keys)
        for _ in range(150):
            alphabet = r.choice([b"ab", b"ab\x00", b"a", bytes([1, 97, 244])])
            parts = [bytes(r.choice(alphabet) for _ in range(r.randint(0, 25))) for _ in range(r.randint(1, 5))]
            text = b"\xff".join([*parts, parts[0]]) + b"\xff"
            width = r.choice([1, 5, 8, 11, 16])
            order = suffix_dedup.suffix_order(text, width + 8).tolist()
            cuts = [text[i:i + width + 8] for i in order]
            assert cuts == sorted(cuts) and sorted(order) == list(range(len(text)))
            common = suffix_dedup.long_prefixes(text, np.array(order), width).tolist()
            padded = text + bytes(width)
            for k in range(1, len(order)):
                a, b = padded[order[k - 1]:][:width], padded[order[k]:][:width]
                assert common[k] == next((i for i in range(width) if a[i] != b[i]), width)
            assert common[0] == 0


def test_suffix_dedup_brute_force(docs_of, odd_texts):
    rows = list(enumerate(passages() + [t for t in odd_texts if not t or len(t) < 5000]))
    rows += [(None, rows[2][1]), (7, rows[7][1])]
    for width, block in ((40, 1 << 19), (40, 300), (90, 1 << 19)):
        got = suffix_dedup.remove_repeats(docs_of(rows), width, block)
        assert collected(got, BYTES) == brute_bytes(rows, width)
    for x in got.where("n_removed > 0").collect():
        assert hashlib.sha256(x["kept"]).hexdigest() == x["kept_sha256"]
    assert suffix_dedup.remove_repeats(docs_of(rows).limit(0)).count() == 0


def test_suffix_dedup_query(spark, docs_of, odd_texts):
    got = suffix_dedup.op5_suffix_dedup(spark, SF)
    assert tuple(got.columns) == BYTES
    assert collected(got, BYTES) == brute_bytes(table_rows(), 400)
    long = [(i, t) for i, t in enumerate(odd_texts) if t and len(t) > 5000]
    assert {x["n_removed"] for x in suffix_dedup.remove_repeats(docs_of(long)).collect()} == {len(t) for _, t in long}


def folder(spark):
    return ensure_checkpoint_dir(spark).removeprefix("file:")


def test_tables_that_nothing_reads_any_more_are_deleted(spark, docs_of):
    rows = list(enumerate(passages()))
    before = set(os.listdir(folder(spark)))
    left = lambda: sorted(x.rpartition("-")[0] for x in set(os.listdir(folder(spark))) - before)
    table = anchors.identified(docs_of(rows))
    found = anchors.search(table, suffix_dedup.kind(40), 300)
    assert left() == ["classes", "contexts", "texts"]
    assert found.members.count() > found.classes.count() > 0 and found.texts.count() > 0
    before |= set(os.listdir(folder(spark)))
    shared = suffix_dedup.shared_passages(table.select("id", "text").toDF("doc", "text"), 40, 40)
    assert left() == ["longest-shared"]
    assert shared.count() > 0


def test_shuffles_of_a_stored_table_go_with_its_write(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in local for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}
    before, setting = files(), spark.conf.get(common.SHUFFLE_CLEANUP)
    rows = spark.range(5000).repartition(4).withColumnRenamed("id", "k").join(spark.range(0, 9000, 2).toDF("k").repartition(3), "k")
    table = common.stored(rows.groupBy("k").count(), "t-shuffled")
    end = time.time() + 20
    while files() - before and time.time() < end:           # they are removed in the background
        time.sleep(0.2)
    assert not files() - before
    assert table.count() == 2500 and spark.conf.get(common.SHUFFLE_CLEANUP) == setting


# ---- repeated passages

def brute_words(rows, width):
    """``rows`` in ascending order of doc_id."""
    seen, out = set(), []
    for k, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            key = tuple(w[i:i + width])
            if key in seen:
                gone[i:i + width] = [True] * width
            seen.add(key)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((k, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda x: (x[0] is not None, x))


WORDS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_phrase_dedup_brute_force(docs_of, odd_texts):
    rows = [(None, passages()[2])] + list(enumerate(passages() + [t for t in odd_texts if not t or len(t) < 5000]))
    rows.insert(9, rows[8])
    for width, gram, block in ((20, 8, 50_000), (20, 8, 40), (5, 2, 50_000)):
        got = phrase_dedup.remove_passages(docs_of(rows), width, gram, block)
        assert collected(got, WORDS) == brute_words(rows, width)
    assert phrase_dedup.remove_passages(docs_of(rows).limit(0)).count() == 0


def test_phrase_dedup_query(spark):
    got = phrase_dedup.op8_phrase_dedup(spark, SF)
    assert tuple(got.columns) == WORDS
    assert collected(got, WORDS) == brute_words(table_rows(), 20)


def test_every_window_in_one_context_with_the_same_anchor():
    r = random.Random(8)
    u = np.array([r.randrange(1 << 60) for _ in range(50)], np.uint64)
    v = np.concatenate([np.array([r.randrange(1 << 60) for _ in range(17)], np.uint64), u, u])

    def per(units, w, g):
        return {i: h for h, a, b in zip(*(x.tolist() for x in anchors.contexts(units, w, g))) for i in range(a, b + 1)}
    for w, g in ((20, 8), (20, 20), (10, 1), (50, 3)):
        a, b = per(u, w, g), per(v, w, g)
        assert len(a) == 50 - w + 1 and len(b) == len(v) - w + 1
        assert all(b[i + 17] == a[i] == b[i + 67] for i in a)


def test_longest_shared_passage(spark, docs_of, odd_texts):
    """Against every string of the width: never more than what others hold, and of a passage at most an anchor's reach less at either end."""
    r = random.Random(12)
    make = lambda n: bytes(r.choice(b"abcdefgh ,.") for _ in range(n)).decode()
    passages = [make(n) for n in (60, 130, 220, 300, 700)]
    texts = [make(r.randint(0, 400)) + r.choice(passages) + make(r.randint(0, 400)) for _ in range(40)]
    texts += [make(300) for _ in range(5)] + [passages[4] * 3, passages[3], passages[3], "é" * 300, "é" * 300] + odd_texts
    rows = list(enumerate(texts))
    width, least = 64, 100
    table = spark.createDataFrame([(i, t or "") for i, t in rows], "doc long, text string")
    got = {x["doc"]: x["longest_shared"] for x in suffix_dedup.shared_passages(table, width, least).collect()}
    raw = [(t or "").encode() for t in texts]
    holders = {}
    for i, t in enumerate(raw):
        if len(t) < 5000:
            for at in range(len(t) - width + 1):
                holders.setdefault(t[at:at + width], set()).add(i)
    for i, t in enumerate(raw):
        if len(t) >= 5000:
            continue
        cover = [False] * len(t)
        for at in range(len(t) - width + 1):
            if len(holders[t[at:at + width]]) > 1:
                cover[at:at + width] = [True] * width
        true = max((len(x) for x in "".join("x" if c else " " for c in cover).split()), default=0)
        found = got.get(i, 0)
        one = max((len(q) for q in passages if q in (texts[i] or "") and sum(q in (u or "") for u in texts) > 1), default=0)
        assert found <= true and (found >= one - 2 * width or one - 2 * width < least), (i, true, one, found)
    long = [i for i, t in enumerate(texts) if t and t.startswith("Lorem")]
    assert {got[i] for i in long} == {len(raw[long[0]])}
    assert suffix_dedup.shared_passages(table.limit(0)).count() == 0


def test_registered_suffix_query_adds_the_longest_passage(spark):
    from setbook.llm import registry
    plain = {x["doc_id"]: x for x in suffix_dedup.op5_suffix_dedup(spark, SF).collect()}
    rows = registry.queries()["op5_suffix_dedup"](spark, SF).collect()
    assert len(rows) == len(plain)
    for x in rows:
        assert tuple(x)[:-1] == tuple(plain[x["doc_id"]])
        assert x["longest_shared"] == 0 or 200 <= x["longest_shared"] <= x["n_bytes"]
    texts = dict(table_rows())
    copies = {}
    for i, t in texts.items():
        copies.setdefault(t, []).append(i)
    same = {i for ids in copies.values() if len(ids) > 1 for i in ids}
    got = {x["doc_id"]: x["longest_shared"] for x in rows}
    assert all(got[i] > 0 for i in same if len((texts[i] or "").encode()) >= 400)


def test_shared_passages_of_words_are_exact(spark, docs_of, odd_texts):
    """Documents that share 50 words with another one, and the bytes of the longest such passage, against every window."""
    r = random.Random(31)
    make = lambda n: [r.choice("abcdefghijklmnopqrstuvwxyzé") + str(r.randint(0, 9) if r.random() < 0.3 else "") for _ in range(n)]
    passages = [make(n) for n in (30, 49, 50, 50, 51, 55, 70, 130)]
    texts = []
    for k in range(120):
        gap = r.choice([" ", "  ", "\n", " \t"])
        texts.append(gap.join(make(r.randint(0, 80)) + passages[k % 8][r.randint(0, 2) * (k % 8 > 4):] + make(r.randint(0, 80))))
    texts += [" ".join(make(40) + p[:60] + make(40) + p[40:] + make(20)) for p in (passages[7], passages[7])]
    texts += [" ".join(passages[6] * 3), " ".join(make(30) * 5), " ".join(make(49)), texts[0], texts[1].replace("\n", " "), "", " \n"]
    texts = [t for t in texts + odd_texts if len(t or "") < 20_000]
    table = spark.createDataFrame([(i, t or "") for i, t in enumerate(texts)], "doc long, text string")
    got = {x["doc"]: x["longest_shared"] for x in
           suffix_dedup.shared_passages(table, least=1, kind=suffix_dedup.WORDS).collect()}
    words = [(t or "").encode().split() for t in texts]
    holders = {}
    for i, ws in enumerate(words):
        for at in range(len(ws) - 49):
            holders.setdefault(tuple(ws[at:at + 50]), set()).add(i)
    expected = {}
    for i, ws in enumerate(words):
        cover = [False] * len(ws)
        for at in range(len(ws) - 49):
            if len(holders[tuple(ws[at:at + 50])]) > 1:
                cover[at:at + 50] = [True] * 50
        best = run = 0
        for w, c in zip(ws, cover):
            run = (run + len(w) + 1) * c
            best = max(best, run - 1)
        if best > 0:
            expected[i] = best
    assert len(expected) > 60 and got == expected
