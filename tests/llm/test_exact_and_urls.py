import hashlib
import re

import duckdb
from llm_texts import docs_of, odd_texts  # noqa: F401

from setbook.llm import exact_dedup, registry, url_filter
from setbook.llm.common import scratch_path
from setbook.llm.components import components

SF_SMALL = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def expected_groups(rows):
    first, size = {}, {}
    for i, t in rows:
        n = SPACE.sub(" ", t or "")
        size[n] = size.get(n, 0) + 1
        first[n] = min(first.get(n, i), i)
    return sorted((i, first[n], size[n], i == first[n], hashlib.sha256(n.encode()).hexdigest())
                  for i, t in rows for n in [SPACE.sub(" ", t or "")])


def test_exact_dedup_odd_texts_and_weak_digest(docs_of, odd_texts):
    from pyspark.sql import functions as F

    rows = list(enumerate(odd_texts + ["a  b\u000bc", "a b c", "A b c"]))
    want = expected_groups(rows)
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    got = exact_dedup.deduplicate(docs_of(rows)).select(columns).collect()
    assert sorted(map(tuple, got)) == want
    # a digest under which different texts collide gives the same result
    weak = lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 1).cast("string"))
    got = exact_dedup.deduplicate(docs_of(rows), digest=weak).select(columns).collect()
    assert sorted(map(tuple, got)) == want


def test_exact_dedup_repeated_and_null_ids_and_empty(docs_of):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (2, "b")]
    out = exact_dedup.deduplicate(docs_of(rows)).collect()
    assert sum(r["kept"] for r in out) == 2 and {r["keep_id"] for r in out} == {1, 2}
    kept = exact_dedup.keep_first(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, "a"), (2, "b")]
    assert exact_dedup.deduplicate(docs_of(rows).limit(0)).count() == 0


def test_exact_dedup_state_goes_on(spark, docs_of):
    from pyspark.sql import functions as F

    path, state = scratch_path(spark, "t-arrivals"), scratch_path(spark, "t-state")
    day = lambda rows: docs_of(rows).select(
        "doc_id", F.monotonically_increasing_id().alias("row"), F.lit("f").alias("file"),
        F.unhex(F.sha2("text", 256)).alias("digest"))
    first = day([(5, "a"), (6, "b")])
    first.write.parquet(path)
    assert exact_dedup.fold_stream(spark, path, first.schema, state).count() == 2
    day([(3, "a"), (9, "a"), (7, "c")]).write.mode("append").parquet(path)
    out = {r["first"]["doc_id"]: r["n"] for r in exact_dedup.fold_stream(spark, path, first.schema, state, 1).collect()}
    assert out == {3: 3, 6: 1, 7: 1}


def test_exact_dedup_goes_on_in_a_named_folder(docs_of, tmp_path):
    folder = f"{tmp_path}/state"
    result = lambda texts: sorted(
        (r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.deduplicate(docs_of(texts), state=folder).collect())
    assert result([(5, "a"), (6, "b"), (6, "b")])[0] == (5, 5, 1, True)
    # copies of an earlier text, a text that an earlier document loses to, a repeated row of the same id, a new text
    got = result([(9, "a"), (3, "b  "), (3, "b "), (7, "c"), (5, "a")])
    assert [g[:3] for g in got] == [(3, 3, 2), (3, 3, 2), (5, 5, 3), (7, 7, 1), (9, 5, 3)]
    assert sum(g[3] for g in got if g[0] == 3) == 1 and [g[3] for g in got if g[0] != 3] == [got[2][3], True, False]
    assert result([]) == []
    # another folder knows nothing of it
    assert [(r["doc_id"], r["kept"]) for r in exact_dedup.deduplicate(docs_of([(9, "a")]), state=f"{tmp_path}/other").collect()] == [(9, True)]


def oracle(name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    return con.sql(registry.oracle_sql()[name])


def test_oracles(spark):
    for name in registry.oracle_sql():
        got = registry.queries()[name](spark, SF_SMALL)
        want = oracle(name)
        assert sorted(got.columns) == sorted(want.columns)
        pick = ", ".join(sorted(got.columns))
        assert sorted(map(repr, map(tuple, got.select(*sorted(got.columns)).collect()))) == \
            sorted(map(repr, want.project(pick).fetchall()))


PAGES = [
    (1, "http://a.example.org/p?q#f", '<link rel="canonical" href="http://b.example.org/c">'),
    (2, "https://b.example.org/c", '<meta http-equiv="refresh" content="0; url=https://x.example.com/en/z">'),
    (3, "HTTP://X.Example.COM/en/z", None),
    (4, "http://www.example.com/en/q", '<LINK href="//d.example.org/w" rel=canonical>'),
    (5, "http://d.example.org/w", '<link rel=canonical href="/v">'),
    (6, "http://d.example.org/v", '<link rel=canonical href="http://e.net/es/1">'),
    (7, "http://e.net/es/1", ""),
    (8, None, "<link rel=canonical href='http://e.net/es/1'>"),
    (9, "no scheme/en/", None),
    (10, "http://net/es", None),
    (11, "x://notexample.com/en/", None),
    (12, "", None),
    (13, "http://a.example.org/p?q", None),
]


def test_url_filter_aliases(spark):
    df = spark.createDataFrame(PAGES + PAGES[:1], "page_id long, url string, html string")
    out = {r["page_id"]: r for r in url_filter.filter_urls(df).collect()}
    verdict = {k: (r["rule"], r["verdict"]) for k, r in out.items()}
    assert verdict == {
        1: (None, "block"), 2: (None, "block"), 3: ("example.com/en/", "block"),
        4: ("www.example.com/en/", "allow"), 5: (None, "allow"), 6: (None, "allow"), 7: ("net/es/", "block"),
        8: (None, "allow"), 9: (None, "allow"), 10: (None, "allow"), 11: ("com/", "allow"), 12: (None, "allow"),
        13: (None, "block")}
    assert (out[3]["host"], out[3]["path"]) == ("x.example.com", "/en/z")
    assert (out[8]["host"], out[9]["path"]) == ("", "")
    assert url_filter.filter_urls(df).count() == len(PAGES) + 1
    assert url_filter.filter_urls(df.limit(0)).count() == 0
    con = duckdb.connect()
    pages = df.toPandas()
    con.register("pages", pages)
    want = {r[0]: r[1:] for r in con.sql(url_filter.ORACLE).project("page_id, host, path, rule, verdict").fetchall()}
    assert {k: (r["host"], r["path"], r["rule"], r["verdict"]) for k, r in out.items()} == want


LINK_FORMS = {
    "second tag": '<link rel=canonical href="/w"><link rel="canonical" href="{}">',
    "second refresh": '<meta http-equiv=refresh content="0; url=/w"><meta http-equiv=refresh content="0; url={}">',
    "blanks": "<link rel = 'canonical' href = \"{}\" >",
    "refresh first": '<meta content="0; URL = \'{}\'" http-equiv = "refresh">',
    "token list": '<link href={} rel="alternate canonical">',
}
LINKS = ["http://e.net/es/1?a=1&amp;b=2", "//e.net/es/./1?a=1&#38;b=2", "http://e.net/x/../es/1?a=1&b=2"]
RELATIVE = [("http://e.net/x/y/z", "../../es/1?a=1&amp;b=2"), ("http://e.net/es/z", "./1?a=1&b=2"),
            ("http://e.net/es/q/..", "1?a=1&b=2"), ("http://f.net/es/1", "?u=http://e.org/"),
            ("http://e.net/u", "../../../es/1?a=1&b=2")]


def test_alias_links_of_each_form(spark):
    tag = '<link rel="canonical" href="{}">'
    pages = [(f"http://a{i}-{j}.org/p", form.format(link)) for i, form in enumerate(LINK_FORMS.values())
             for j, link in enumerate(LINKS)]
    pages += [(url, tag.format(link)) for url, link in RELATIVE]
    pages += [("http://g.org/p", tag.format("#top")), ("http://g.org/p", tag.format("mailto:a@b.c")),
              ("http://g.org/p", '<link rel="canonicals" href="/q"><link rel=icon href="/q">')]
    edges = url_filter.alias_edges(spark.createDataFrame(pages, "url string, html string")).collect()
    got = {(r["u"], r["v"]) for r in edges}
    goal = "e.net/es/1?a=1&b=2"
    want = {(f"a{i}-{j}.org/p", goal) for i in range(len(LINK_FORMS)) for j in range(len(LINKS))}
    want |= {(f"a{i}-{j}.org/p", f"a{i}-{j}.org/w") for i in (0, 1) for j in range(len(LINKS))}
    want |= {("e.net/x/y/z", goal), ("e.net/es/z", goal), ("e.net/es/", goal), ("e.net/u", goal),
             ("f.net/es/1", "f.net/es/1?u=http://e.org/")}
    assert got == want


def test_components_of_long_path_and_star(spark):
    n = 40
    path = [(i, i + 1) for i in range(n)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 1), (201, 200)]
    out = {r["node"]: r["root"] for r in components(spark.createDataFrame(path, "u long, v long")).collect()}
    want = {i: 0 for i in range(n + 1)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert out == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
