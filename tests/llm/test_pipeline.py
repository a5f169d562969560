"""The pipeline against a brute-force version of its stages on the smallest tables."""
import re

import duckdb
from llm_texts import docs_of, odd_texts  # noqa: F401
from test_copies import brute_classes
from test_text_operators import edit_distance

import corpus_pipeline
from setbook.llm import decontaminate, quality
from setbook.llm.common import documents

SF = "/root/testdata/sf0.001"


def rows_of(table, columns):
    return duckdb.sql(f"select {columns} from '{SF}/{table}.parquet'").fetchall()


def test_pipeline_equals_brute_force(spark):
    docs = documents(spark, SF)
    scored = quality.score(docs, quality.fit(docs, quality.quality_labels(spark, SF)))
    good = {r["doc_id"] for r in scored.where("predicted = 1").collect()}
    rows = sorted(r for r in rows_of("documents", "doc_id, text") if r[0] in good)
    first = {}
    for i, t in rows:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), (i, t))
    rows = sorted(first.values())
    classes = brute_classes(rows)
    rows = [(i, t) for i, t in rows if classes[i] == i]
    items = [decontaminate.plain(t) for (t,) in rows_of("benchmark", "text")]

    def leaked(t):
        p = decontaminate.plain(t or "")
        near = [q for q in items if any(q[k:k + 12] in p for k in range(0, len(q) - 12, 3))]
        return any(q in p or edit_distance(q, p) <= int(0.05 * len(q)) for q in near)
    want = sorted(i for i, t in rows if not leaked(t))
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in out) == want
    assert all(r["round_trip"] and r["n_pieces"] == len(r["piece_ids"]) > 0 for r in out)
    assert 0 < len(want) < len(good) < 200


def test_stages_on_odd_and_empty_documents(spark, docs_of, odd_texts):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "near_dedup", "decontamination", "sentence_pieces"]
    for docs in (docs_of(odd_texts), docs_of(odd_texts).limit(0)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            if k < 4:
                assert out.columns == docs.columns
            assert out.count() <= docs.count()


def test_clashing_column_names(spark):
    """Columns of the table that are named like an operator's own stay as they are."""
    names = ["named_id", "named_key", "own_key", "own", "score", "predicted", "items", "row", "own_row", "hits", "found", "key", "Items"]
    rows = [(i, t, *[f"{n}{i}" for n in names[:-1]]) for i, t in enumerate(
        ["the cat sat on the mat today", "the cat  sat on the mat today", "alpha beta gamma delta epsilon zeta", None, ""])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names[:-1]))
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon"), (2, "nothing of the kind here")], "item_id long, text string")
    from setbook.llm import decontaminate, exact_dedup, near_dedup, quality
    labels = spark.createDataFrame([(0, 1.0), (2, 1.0)], "doc_id long, label double")
    table = {r["doc_id"]: r for r in docs.collect()}

    def same(kept, ids):
        assert kept.columns == docs.columns
        assert {r["doc_id"]: r for r in kept.collect()} == {i: table[i] for i in ids}
    same(quality.keep_good(docs, quality.fit(docs, labels)), [0, 1, 2, 3, 4])
    same(exact_dedup.keep_first(docs), [0, 2, 3])
    same(near_dedup.keep_one_of_each(docs), [0, 2, 3])
    same(decontaminate.keep_clean(docs, items), [0, 1, 3, 4])
    same(decontaminate.with_matches(docs, items, block_chars=10, out="zz").where("size(zz) = 0").drop("zz"), [0, 1, 3, 4])
