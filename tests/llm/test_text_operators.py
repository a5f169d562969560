"""Operators that work on one text at a time, against brute force over whole tables."""
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from llm_texts import docs_of, odd_texts  # noqa: F401

from setbook.llm import decontaminate, pii, quality, sentence_pieces, simple8b, token_ids
from setbook.llm.common import scratch_path

SF = "/root/testdata/sf0.01"


def table(name, columns="*"):
    return duckdb.sql(f"select {columns} from '{SF}/{name}.parquet'").fetchall()


# ---- personal data

BASE = (("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
        ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
        ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
        ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")))


def passes(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        ds = [int(d) for d in digits[::-1]]
        return 13 <= len(ds) <= 19 and sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(ds)) % 10 == 0
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def base_spans(text):
    return [(k, m.start(), m.end()) for k, p in BASE for m in p.finditer(text or "") if passes(k, m[0])]


def check_pii(docs, rows):
    got = pii.find_personal_data(docs).collect()
    assert len(got) == len(rows)
    want = sorted((i if i is not None else -1, base_spans(t)) for i, t in rows)
    out = sorted((r["doc_id"] if r["doc_id"] is not None else -1,
                  [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in r["redactions"] if s["kind"] < pii.BASE])
                 for r in got)
    assert out == want
    return got


TRICKY = [
    "a@b.com_x@c.de", "a@b..c x.@y.z.", "q@r", "..a@b.c..", "a@b.c@d.e", "%@-.-", "é@é.fr a.b@c-d.e-f.", "x@y.z.\u0001w",
    "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.0255 1.1.1.1000", "1..2.3.4", "0.0.0.0",
    "4111 1111 1111 1111", "4111-1111-1111-1111-", "4111  1111 1111 1111", "4-1-1-1 1111 1111 1111 1", "5 5 5",
    "+1 (269) 555-3296", "+1-2", "++49 30 123456789", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "+4 (", "🎉+1 (269) 555-3296🎉 a@b.co",
    "4111111111111111 +4111111111111111", "password=135299847ac0e0f0dc", 'token = "0641917ea4e9feb9cda83477b57ac2654884f485"',
]


def test_pii_tricky_texts(docs_of, odd_texts):
    r = random.Random(5)
    noise = ["".join(r.choice("a1@.+- ()\u0001é,") for _ in range(r.randint(1, 60))) for _ in range(300)]
    rows = list(enumerate(odd_texts + TRICKY + noise + ["1 " * 60_000, "a." * 30_000 + "@" + "b." * 30_000, "9" * 50_000]))
    check_pii(docs_of(rows), rows)


def test_pii_tables_ids_and_empty(spark, docs_of):
    rows = table("documents", "doc_id, text")
    got = check_pii(spark.read.parquet(f"{SF}/documents.parquet"), rows)
    texts = dict(rows)
    added = [texts[r["doc_id"]][s["start"]:s["end"]] for r in got for s in r["redactions"] if s["kind"] >= pii.BASE]
    assert added and sum(any(c.isdigit() for c in a) for a in added) == len(added)
    q = pii.op2_pii(spark, SF).where("doc_id = %d" % next(i for i, t in rows if base_spans(t))).first()
    spans = base_spans(texts[q["doc_id"]])
    assert q["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    assert [q[f"n_{k}"] for k, _ in BASE] == [sum(s[0] == k for s in spans) for k, _ in BASE]
    assert check_pii(docs_of([(1, "a@b.c"), (1, "a@b.c"), (None, "+123456789")]), [(1, "a@b.c"), (1, "a@b.c"), (None, "+123456789")])
    assert pii.find_personal_data(docs_of([(1, "a")]).limit(0)).count() == 0


def test_pii_thresholds_use_every_wide_candidate(docs_of):
    """A kind with few positives beside a small fitting sample, under two dealings of the rows."""
    texts = [f"x token=a{k:06d}bcdefghijklm y" if k % 2 else f"x a{k:06d}bcdefghijklm y" for k in range(1500)]
    texts += [f"no 555-{k:06d}-77 no" for k in range(2500)] + [f"account={k}55-666-{k}77" for k in range(1, 7)]
    got = []
    for partitions in (3, 7):
        out = pii.find_personal_data(docs_of(texts, partitions), train_rows=300).collect()
        got.append({r["doc_id"]: [tuple(s) for s in r["redactions"]] for r in out})
    number, secret = pii.KINDS.index("number"), pii.KINDS.index("secret")
    for k, t in enumerate(texts):
        kinds = [s[0] for s in got[0][k]]
        assert (number in kinds) == t.startswith("account=") and (secret in kinds) == ("token=" in t)
    assert got[0] == got[1]


def test_pii_features_of_the_whole_match(spark):
    long = "a1" * 400 + "_" + "".join(map(chr, range(ord("b"), ord("z"))))
    spans = spark.createDataFrame([(0, 0, 5, 0, len(long), long, "", "", False), (1, 0, 4, 0, 9, "12 (34)-5", "", "", False)],
                                  "row long, key long, kind int, start long, end long, m string, prev string, next string, base boolean")
    out = {r["row"]: (r["groups"], r["switches"], r["distinct"]) for r in pii._features(spans).collect()}
    assert out == {0: (2, 800, 27), 1: (3, 1, 9)}


# ---- token ids

def test_simple8b_round_trip():
    r = np.random.default_rng(1)
    cases = [np.empty(0, np.uint64), np.zeros(5000, np.uint64), r.integers(0, 50257, 7000).astype(np.uint64),
             np.array([0, 1, 2 ** 60 - 1, 2 ** 60, 2 ** 64 - 1, 7], np.uint64)]
    cases += [r.integers(0, 2 ** int(b), 3000, dtype=np.uint64) for b in r.integers(1, 63, 30)]
    cases += [np.concatenate([np.zeros(int(r.integers(1, 300)), np.uint64), r.integers(0, 2 ** 17, 50, dtype=np.uint64)] * 9)]
    for v in cases:
        words, offsets, escapes = simple8b.encode(v)
        assert np.array_equal(simple8b.decode(words, escapes), v)
        for k in range(len(offsets) - 1):
            block = v[k * simple8b.BLOCK:(k + 1) * simple8b.BLOCK]
            assert np.array_equal(simple8b.decode_block(words, offsets, escapes, k), block)
    assert len(simple8b.encode(np.zeros(960, np.uint64))[0]) == 8


def expected_ids(rows, path):
    from tokenizers import Tokenizer

    tokenizer, start, out = Tokenizer.from_file(path), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "byte_bpe_50k.json small chunks"])
def test_token_ids(spark, docs_of, odd_texts, name):
    import public_tokenizers

    path = public_tokenizers.path(name.split()[0])
    more = ["a b  c", " lead", "trail ", "a \n b", "\n\n", "it's we'll 'd", "x<|endoftext|> <|endoftext|>y", "tab\tb", "a\rb", "\x1c \x1f"]
    rows = [(k * 3 % 101, t) for k, t in enumerate(odd_texts + more)] + [(None, "null id"), (4, "twin"), (4, "twin")]
    out = scratch_path(spark, "t-ids")
    token_ids.write_ids(docs_of(rows), out, path, chunk_ids=64 if "small" in name else 1 << 14)
    got = sorted(map(tuple, token_ids.document_index(spark, out).collect()), key=lambda r: r[1])
    assert got == expected_ids(rows, path)
    empty = scratch_path(spark, "t-ids")
    token_ids.write_ids(docs_of(rows).limit(0), empty, path)
    assert token_ids.document_index(spark, empty).count() == 0


def test_token_ids_query(spark):
    import public_tokenizers

    got = sorted(map(tuple, token_ids.op4_token_ids(spark, SF).collect()))
    assert got == expected_ids(table("documents", "doc_id, text"), public_tokenizers.path("byte_bpe_50k.json"))


# ---- decontamination

def edit_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i] + [0] * len(t)
        for j, d in enumerate(t, 1):
            new[j] = min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1)
        row = new
    return min(row)


def test_myers_distance():
    r = random.Random(2)
    for _ in range(500):
        p = "".join(r.choice("abc") for _ in range(r.randint(1, 70)))
        t = "".join(r.choice("abc") for _ in range(r.randint(0, 90)))
        assert decontaminate.best_distance(p, t, 100) == min(101, edit_distance(p, t))


def damaged(r, t, n):
    for _ in range(n):
        k = r.randrange(len(t))
        t = r.choice([t[:k] + t[k + 1:], t[:k] + "#" + t[k:], t[:k] + "#" + t[k + 1:]])
    return t


def test_decontamination_brute_force(spark, docs_of, odd_texts):
    r = random.Random(3)
    items = [(k, "".join(r.choice("abcde ") for _ in range(r.randint(1, 120)))) for k in range(40)]
    items += [(90, None), (91, ""), (92, " "), (93, "x y"), (93, "x y"), (None, "abc")]
    texts = list(odd_texts)[:9]
    for k in range(60):
        t = items[r.randrange(40)][1]
        texts.append("pre fix " + damaged(r, t, r.randint(0, 8)) + " post" if len(t) > 20 else "X  Y")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for t in texts:
        p = decontaminate.plain(t or "")
        own = {(i, decontaminate.plain(q)) for i, q in items if i is not None and q}
        want.append(sorted({i for i, q in own if q and edit_distance(q, p) <= int(0.05 * len(q))}))
    for block in (4_000_000, 500):
        got = decontaminate.with_matches(docs_of(texts), bench, block_chars=block).collect()
        assert {r_["doc_id"]: r_["items"] for r_ in got} == dict(enumerate(want))
    clean = decontaminate.keep_clean(docs_of(texts), bench)
    assert clean.columns == docs_of(texts).columns
    assert sorted(x["doc_id"] for x in clean.collect()) == [i for i, w in enumerate(want) if not w]
    assert decontaminate.with_matches(docs_of(texts), bench.limit(0)).where("size(items) > 0").count() == 0
    assert decontaminate.with_matches(docs_of(texts).limit(0), bench).count() == 0


def test_decontamination_holds_one_block_at_a_time(spark, docs_of):
    items = [(k, f"item number {k} of the benchmark") for k in range(30)] + [(3, "another text of item 3")]
    texts = [f"see item number {k} of the benchmark" for k in range(30)] + ["no", "item number 3 of the benchmark, another text of item 3"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.with_matches(docs_of(texts), bench, error_rate=0, block_chars=200)
    assert "EvalPython" not in out._jdf.queryExecution().toString()
    assert out.columns == [*docs_of(texts).columns, "items"]
    assert {r["doc_id"]: r["items"] for r in out.collect()} == {k: [k] for k in range(30)} | {30: [], 31: [3]}


def test_decontamination_query_finds_every_exact_leak(spark):
    items = [(i, decontaminate.plain(t)) for i, t in table("benchmark", "item_id, text")]
    got = {r["doc_id"]: r for r in decontaminate.op6_decontaminate(spark, SF).collect()}
    for i, t in table("documents", "doc_id, text"):
        p = decontaminate.plain(t)
        assert {k for k, q in items if q in p} <= set(got[i]["items"])
        for k in got[i]["items"]:
            q = dict(items)[k]
            assert edit_distance(q, p) <= 0.05 * len(q)


# ---- sentence pieces

def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.default_model())


def test_sentence_pieces_equal_the_library(odd_texts):
    lib, own = library(), sentence_pieces.Pieces(sentence_pieces.default_model())
    r = random.Random(6)
    voc = [lib.id_to_piece(i).replace(sentence_pieces.MARK, " ") for i in range(3, 32000) if not lib.is_byte(i)]
    texts = [t for t in odd_texts if t and sentence_pieces.MARK not in t] + ["", "     x   y", "e" * 33]
    texts += ["".join(r.choice(voc) for _ in range(r.randint(1, 8))) for _ in range(3000)]
    texts += ["".join(r.choice("abcdeht \n") for _ in range(r.randint(1, 30))) for _ in range(3000)]
    texts += [t for (t,) in table("documents", "text")[:300]]
    got = own.encode(texts)
    for t, a, b in zip(texts, got, lib.encode(texts)):
        assert list(a) == b, t[:80]
        assert own.decode(a.tolist()) == t
    assert own.merged(" theory of") == [" theory", " of"]


def test_sentence_pieces_as_a_unigram_model():
    """The unconstrained search against the best sum over all segmentations."""
    own = sentence_pieces.Pieces(sentence_pieces.default_model(), merges=False)

    def best(word):
        out = [0.0]
        for j in range(1, len(word) + 1):
            out.append(max([out[i] + own.rank[word[i:j]][0] for i in range(j) if word[i:j] in own.rank]
                           + ([out[j - 1] + own.unknown_score] if word[j - 1] not in own.rank else [])))
        return out[-1]

    words = sorted({" " + w for (t,) in table("documents", "text")[:40] for w in t.split()} | {" theory", "é", " \u2581x"})
    for w, ids in own.segment(words).items():
        ids = np.frombuffer(ids, "<i4")
        assert b"".join(own.bytes_of[i] for i in ids).decode() == w
        if all(c in own.rank for c in w):
            assert sum(own.rank[own.texts[i]][0] for i in ids) == best(w)


def test_sentence_pieces_round_trip(spark, docs_of, odd_texts):
    from pyspark.sql import functions as F

    docs = sentence_pieces.encode_documents(docs_of(odd_texts), sentence_pieces.default_model())
    out = docs.withColumn("back", sentence_pieces.decoded(F.col("piece_ids"), sentence_pieces.default_model())).collect()
    assert {r["doc_id"]: r["back"] for r in out} == {i: t or "" for i, t in enumerate(odd_texts)}
    assert all(r["piece_ids"] == [] for r in out if not r["text"])
    assert sentence_pieces.encode_documents(docs_of(odd_texts).limit(0), sentence_pieces.default_model()).count() == 0


def test_sentence_pieces_query(spark):
    out = sentence_pieces.op7_sentence_pieces(spark, SF).collect()
    assert len(out) == 1000 and all(r["round_trip"] and r["n_pieces"] > 0 for r in out)


# ---- quality

def test_quality_held_out_accuracy(spark):
    out = {r["doc_id"]: r for r in quality.op9_quality_classifier(spark, SF).collect()}
    assert len(out) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in out.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    held = [(out[i]["predicted"], q) for i, q in table("labels", "doc_id, quality") if out[i]["held_out"]]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) >= 0.95


def test_quality_shapes_of_whole_words():
    assert quality._shape("ab12-Cd.Ef_g") == "x9-Xx.Xx_x" and quality._shape("a" * 5000 + "1") == "x9"
    assert quality._shape("a-" * 40 + "1") != quality._shape("a-" * 40 + "B")


def test_quality_votes_exactly(docs_of):
    """The blocked vote against a plain loop over all labelled vectors."""
    r = np.random.default_rng(0)
    matrix = r.poisson(0.3, (700, quality.TERMS)).astype(np.float32)
    matrix[5] = 0
    vec = quality._unit(r.normal(size=(40, 8)))
    m = quality.Model(np.ones(quality.TERMS, np.float32), r.normal(size=(quality.TERMS, 8)).astype(np.float32), vec,
                      (r.random(40) < 0.5).astype(float), 5, 0.25)
    got = m.score(matrix)
    assert got[5] == 0.25
    for i in (0, 1, 300, 699):
        p = m.project(matrix[i:i + 1])[0]
        sim = vec @ p
        near = np.argsort(-sim)[:5]
        w = np.maximum(sim[near], 0) ** 4 + 1e-9
        assert abs(got[i] - (w * m.labels[near]).sum() / w.sum()) < 1e-4


def test_quality_odd_inputs(spark, docs_of, odd_texts):
    docs = docs_of(odd_texts)
    labels = spark.createDataFrame([(5, 1.0), (6, 0.0), (7, 1.0)], "doc_id long, label double")
    out = quality.score(docs, quality.fit(docs, labels), names=("s", "p")).collect()
    assert len(out) == len(odd_texts) and all(0 <= r["s"] <= 1 for r in out)
    assert abs(next(r["s"] for r in out if r["doc_id"] == 0) - 2 / 3) < 1e-9
    none = quality.fit(docs, labels.limit(0))
    assert {r["s"] for r in quality.score(docs, none, names=("s", "p")).collect()} == {0.5}
    empty = docs.limit(0)
    assert quality.score(empty, quality.fit(empty, labels), names=("s", "p")).count() == 0
    assert quality.keep_good(docs, none).columns == docs.columns


def test_token_ids_of_single_documents(spark, docs_of, odd_texts, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = odd_texts + ["some words " * k for k in range(1, 400, 7)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "again"), (None, "no id")]
    token_ids.write_ids(docs_of(rows), f"{tmp_path}/ids", path, chunk_ids=3000)
    plain = Tokenizer.from_file(path)
    wanted = [0, 3, 11, 12, 40, 999]
    got = sorted((r["doc_id"], list(r["ids"])) for r in token_ids.ids_of(spark, f"{tmp_path}/ids", wanted).collect())
    want = sorted((i, plain.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows if i in wanted)
    assert got == want


def test_simple8b_ranges():
    r = random.Random(8)
    values = np.array([r.choice([0, 1, 5, 2 ** r.randint(0, 63)]) for _ in range(5000)], np.uint64)
    words, offsets, escapes = simple8b.encode(values)
    for a, e in ((0, 0), (0, 1), (1023, 1025), (0, 5000), (4999, 5000), (1024, 2048), (17, 3333)):
        assert (simple8b.decode_range(words, offsets, escapes, a, e) == values[a:e]).all()


def test_sentence_pieces_take_one_worker_a_task(spark, docs_of):
    """Encoding and decoding again is one step in one worker, and gives what the two apart give."""
    from pyspark.sql import functions as F

    path = sentence_pieces.default_model()
    docs = docs_of([(1, "Ein  Wort\n und\tnoch eins"), (2, None), (3, ""), (4, "▁ mark")])
    both = sentence_pieces.round_trip(docs, path)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.split("ArrowEvalPython")[1].count("there_and_back(") == 1
    apart = sentence_pieces.encode_documents(docs, path).withColumn(
        "back", sentence_pieces.decoded(F.col("piece_ids"), path))
    assert both.columns == apart.columns and sorted(both.collect(), key=str) == sorted(apart.collect(), key=str)
    query = sentence_pieces.op7_sentence_pieces(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert query.count("ArrowEvalPython") == 1


def test_a_worker_keeps_the_tables_of_one_operator(spark):
    """Workers serve all stages: what one operator keeps goes when another's task begins."""
    from setbook.llm import common

    def run(batches):
        first = common.held("a", "x", lambda name: [name])
        again = common.held("a", "x", lambda name: [name]) is first
        common.held("a", "y", lambda name: [name])
        both = len(common._HELD)
        common.held("b", "x", lambda name: [name])
        other = list(common._HELD)
        common.let_go()
        for b in batches:
            yield b.assign(said=f"{again} {both} {other} {len(common._HELD)}")

    said = spark.range(1, numPartitions=1).mapInPandas(run, "id long, said string").first()["said"]
    assert said == "True 2 [('b', 'x')] 0"


def test_plain_words_go_to_the_model_once():
    """Distinct words of Latin letters skip the tokenizer's pattern, and every text gets the tokenizer's own ids."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, lib = token_ids.PieceEncoder(path), Tokenizer.from_file(path)
    asked = []
    separate = own._separate
    own._separate = lambda t, lines: asked.extend((t is own.single, len(x.splitlines())) for x in lines) or separate(t, lines)
    r = random.Random(5)
    words = ["".join(r.choice("abcdeéßñĀx") for _ in range(r.randint(1, 9))) for _ in range(400)]
    marks = ["", ",", ".***", "'s", "'", "_x", "...", "!?"]
    plain = [" ".join(r.choice(words) + r.choice(marks[:3]) for _ in range(300)) for _ in range(20)]
    expected = lambda texts: [lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in own.encode(plain)] == expected(plain)
    assert asked and all(single for single, _ in asked)
    asked.clear()
    assert [x.tolist() for x in own.encode(plain[::-1])] == expected(plain[::-1]) and not asked
    odd = ["", "a×b,÷ é×, x²³.", "don't, we'LL. it's's'", "ｘ,， 1,2.3a,b", "<|endoftext|>", "foo,<|endoftext|>.bar ,", "a,\nb.\n\nc, ",
           " ,a", " x,", "語,漢字. ｶﾅ!", "é", "", "ª,º.µ!", "Ⅷ,ⅷ.", "á,é.", ", , .", "\n", "x\n", "ʯ.ʰ,ˆ!"]
    more = ["".join(r.choice("aé ,.'\n\t _1×²語́") for _ in range(r.randint(0, 40))) for _ in range(3000)]
    more += [" ".join(r.choice(words) + r.choice(marks) for _ in range(50)) for _ in range(50)]
    assert [x.tolist() for x in own.encode(odd + more)] == expected(odd + more)
    assert [x.tolist() for x in own.encode([])] == [] and [x.tolist() for x in own.encode(["", ""])] == [[], []]
