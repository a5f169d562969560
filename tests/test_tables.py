"""Bitmaps, positions, the text dump, refreshed years, refused rows, catalog tables."""
import datetime as dt
import random
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from setbook.operators import order, quality
from setbook.operators.classify import semi_join
from setbook.operators.distinct import count_bits, merge_bits, number_bits
from setbook.operators.staging import stage_journal
from setbook.plans import dashboard as D
from setbook.plans import marts as M
from setbook.plans.cubes import session_bits
from setbook.plans.warehouse import build_tables, current_build, open_marts
from setbook.sources.dump import read_dump, write_dump
from setbook.sources.journal import JOURNAL_SCHEMA, journal_for, read_journal, write_journal
from setbook.sources.refresh import changed_years, corrected_sums, in_years, refresh_years

from conftest import SF_SMALL, journal_row, same_rows


def fresh(tmp_path):
    return f"{tmp_path}/{uuid.uuid4().hex}"


# ---- bitmaps of numbers

def test_bitmaps_equal_distinct_counts(spark):
    r = random.Random(1)
    rows = [(r.choice("abc"), r.choice([None, "x", "y"]), r.choice([None, 0, 63, 64, -1, -64, -65, 2 ** 62, r.randint(-300, 300)]))
            for _ in range(2000)] + [("d", "x", None)] * 3
    df = spark.createDataFrame(rows, "k string, l string, n long")
    fine = number_bits(df, ["k", "l"], "n")
    for keys in (["k", "l"], ["k"], ["l"], []):
        want = df.groupBy(*keys).agg(F.count_distinct("n").alias("c"))
        assert same_rows(count_bits(fine, keys, "c"), want)
        assert same_rows(count_bits(merge_bits(fine, keys), keys, "c"), want)
    assert count_bits(number_bits(df.where("false"), ["k"], "n"), ["k"], "c").count() == 0


def test_session_marts_from_bitmaps(spark, make_stg):
    r = random.Random(7)
    rows = []
    for _ in range(400):
        d = dt.date(2023, 1, 1) + dt.timedelta(days=r.randint(0, 800))
        rows.append(journal_row(d, counter=r.randint(1, 40), type_=r.choice(["pull", "push"]),
                                month=r.choice([None, "brumaire"]) if r.random() < .1 else None,
                                weekday="blursday" if r.random() < .1 else None))
    stg = make_stg(rows)
    bits = session_bits(stg)
    for name in ("workouts_per_month_per_year", "month_with_most_workouts_per_year", "workout_sessions_per_year",
                 "yearly_workouts_per_type", "workout_frequency_weekday"):
        assert same_rows(M.MARTS[name](bits), M.MARTS[name](stg)), name


# ---- global order

@pytest.mark.parametrize("keys", [["a"], ["-a", "b"], ["b", "-c"]])
def test_global_position_is_the_rank(spark, keys):
    r = random.Random(4)
    rows = [(r.choice([None, 1, 2, 3, 3, 3]), r.choice([None, "x", "y", "z"]), Decimal(r.randint(-3, 3)), i) for i in range(500)]
    rows += [(3, "x", Decimal(0), 1000 + i) for i in range(300)]                    # a hot key
    df = spark.createDataFrame(rows, "a int, b string, c decimal(5,2), i int")
    got = {x["i"]: x["position"] for x in order.global_position(df, keys, ranges=5).collect()}

    def place(x):
        out = []
        for k in keys:
            v = x["abci".index(k.lstrip("-"))]
            out.append(((v is not None), -v if v is not None else 0) if k.startswith("-") else (v is None, v if v is not None else 0))
        return out
    ordered = sorted(rows, key=place)
    want, last = {}, None
    for n, x in enumerate(ordered, 1):
        if last is None or place(x) != place(last[0]):
            last = (x, n)
        want[x[3]] = last[1]
    assert got == want
    assert order.global_position(df.where("false"), keys).count() == 0


def test_global_position_has_no_single_partition_window(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    plan = order.global_position(df, ["-k"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_write_sorted(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") * 7919 % 2003).alias("n"), F.lit("x").alias("s"))
    path = fresh(tmp_path)
    order.write_sorted(df, path, ["-n"], files=6)
    rows = spark.read.parquet(path).select("n", F.input_file_name().alias("f"), F.col("_metadata.row_index").alias("i")).collect()
    by_file = [x["n"] for x in sorted(rows, key=lambda x: (x["f"].rsplit("/", 1)[1], x["i"]))]
    assert by_file == sorted(by_file, reverse=True) and len({x["f"] for x in rows}) > 1


# ---- the text dump

def test_dump_roundtrip_of_odd_texts(spark, tmp_path):
    schema = "year int, a string, n smallint, d date, w decimal(5,2)"
    rows = [(2024, 'quote " comma , bracket ]', 7, dt.date(2024, 2, 29), Decimal("1.25")), (2024, "line\nend\r\n\ttab \\  ", None, None, None),
            (2025, "", -1, None, Decimal("-0.50")), (None, None, None, None, None), (2025, "null", 0, None, None)] * 2
    df = spark.createDataFrame(rows, schema)
    path = fresh(tmp_path)
    write_dump(df, path, "year")
    assert same_rows(read_dump(spark, path, df.schema), df)
    assert same_rows(read_dump(spark, path, df.schema, years=[2025]), df.where("year = 2025"))
    lines = spark.read.text(path).where("_year = 2024").count()
    assert lines == 4                                                               # one record a line


def test_dump_keeps_lines_that_are_no_record(spark, tmp_path):
    path = fresh(tmp_path)
    spark.createDataFrame([("[\"a\"]",), ("not json",), ("[\"1\",\"b\"]",)], "value string").write.text(f"{path}/_year=2024")
    schema = spark.createDataFrame([], "n int, s string").schema
    assert sorted(map(repr, read_dump(spark, path, schema).collect())) == sorted(
        map(repr, spark.createDataFrame([(None, None), (None, None), (1, "b")], schema).collect()))


# ---- refreshing single years

def files(spark, path):
    got = spark.read.parquet(path).select(F.col("year"), F.input_file_name().alias("f")).distinct().collect()
    out = {}
    for r in got:
        out.setdefault(r["year"], set()).add(r["f"])
    return out


def test_refresh_writes_only_changed_years(spark, tmp_path):
    from setbook.sources.versions import published
    old = [journal_row(f"{y}-03-0{d}", amount=d) for y in (2022, 2023, 2024, 2025) for d in range(1, 8)]
    new = [x for x in old if x[2].year not in (2023, 2025)] + [journal_row("2023-03-01", amount=99), journal_row("2026-01-01")]
    a, b = (spark.createDataFrame(rows, JOURNAL_SCHEMA) for rows in (old, new))
    path = fresh(tmp_path)
    write_journal(a, path, partition_by_year=True)
    before = files(spark, published(spark, path))
    years = changed_years(read_journal(spark, path), b)
    assert years == [2023, 2025, 2026]
    refresh_years(spark, b, path, years)
    assert same_rows(read_journal(spark, path), b)
    after = files(spark, published(spark, path))
    assert {y: after[y] for y in (2022, 2024)} == {y: before[y] for y in (2022, 2024)}
    assert 2025 not in after and after[2023] != before[2023]
    assert changed_years(read_journal(spark, path), b) == []


def test_corrected_sums(spark):
    r = random.Random(9)

    def rows(n, year):
        return [(dt.date(year, 1, 1), r.choice([None, "a", "b", "c"]), r.randint(1, 9)) for _ in range(n)]
    kept = rows(40, 2022)
    old, new = kept + rows(20, 2023) + [(dt.date(2023, 1, 1), "gone", 5), (None, "a", 1)], kept + rows(15, 2023) + [(dt.date(2023, 2, 1), "new", 0)]
    a, b = (spark.createDataFrame(x, "date date, k string, amount int") for x in (old, new))
    sums = lambda df: df.groupBy("k").agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("_rows"))
    years = changed_years(a, b)
    assert years == [None, 2023]
    part = lambda df: in_years(df, years).select("k", "amount")
    assert same_rows(corrected_sums(sums(a), ["k"], ["amount"], part(a), part(b)), sums(b))


# ---- refused rows

def test_rejected_rows_name_their_rules(spark):
    rows = [journal_row("2024-01-01"), journal_row("2024-02-01", unit="st"), journal_row("2024-01-01", amount=-1),
            journal_row("2024-01-01", unit=None, type_=None)]
    loose = spark.createDataFrame(rows, JOURNAL_SCHEMA.simpleString()[7:-1].replace(":", " "))
    got = quality.rejected_rows(loose).collect()
    assert sorted(r["reasons"] for r in got) == ["not_null_type,not_null_weight_unit", "unit_allowed"]
    bits = quality.rule_bits()
    assert {r["reasons"]: r["broken"] for r in got}["unit_allowed"] == bits["unit_allowed"]
    assert loose.where(quality.constraints_met()).count() == 2
    good, report = quality.check_journal(loose)
    assert good.count() == 1
    assert {r["rule"]: r["violations"] for r in report.collect() if r["violations"]} == {
        "unit_allowed": 1, "negative_amount": 1, "not_null_type": 1, "not_null_weight_unit": 1}
    marked = loose.withColumn("m", quality.broken_rules())
    assert same_rows(quality.check_journal(marked, mask="m")[1], report)


# ---- a dimension of its own

def test_semi_join_builds_a_runtime_filter(spark, tmp_path):
    path = fresh(tmp_path)
    spark.range(20000).select((F.col("id") % 500).alias("k"), F.lit("v").alias("v")).write.parquet(f"{path}/facts")
    spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 50).alias("g")).write.parquet(f"{path}/dim")
    facts, dim = spark.read.parquet(f"{path}/facts"), spark.read.parquet(f"{path}/dim").where("g = 3")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = semi_join(facts, dim, "k")
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan
        assert out.count() == 400
        repeated = dim.unionByName(dim)
        assert semi_join(facts, repeated, ["k"]).count() == 400
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


# ---- catalog tables

def test_catalog_build_swaps_once(spark, tmp_path):
    base = f"prod_{uuid.uuid4().hex[:8]}"
    journal = journal_for(spark, SF_SMALL)
    names = ["mom_changes_reps", "yearly_reps_per_exercise_weight", "workout_frequency_weekday"]
    first = build_tables(spark, journal, base, str(tmp_path), names)
    reader = open_marts(spark, base)
    stg = stage_journal(journal)
    for n in names:
        assert same_rows(reader[n], M.MARTS[n](stg))
    ex = tuple(f"brand#{i}" for i in range(1, 10))
    read = reader.for_dashboard()
    assert same_rows(D.dash_mom(None, exercises=ex, mom_reps=read["mom_reps"]), D.dash_mom(stg, exercises=ex))
    # a build that fails half-way leaves the tables that are read
    half = journal.where("date < '2024-01-01'")

    def broken(stg, by=()):
        raise ValueError("half-way")
    with pytest.raises(ValueError):
        build_tables(spark, half, base, str(tmp_path), names, marts={"workout_frequency_weekday": broken}, threads=1)
    assert current_build(spark, base) == first
    assert same_rows(open_marts(spark, base)["mom_changes_reps"], M.MARTS["mom_changes_reps"](stg))
    # the next build: old readers keep their tables, new ones get the new set
    second = build_tables(spark, half, base, str(tmp_path), names)
    assert current_build(spark, base) == second != first
    assert same_rows(reader["mom_changes_reps"], M.MARTS["mom_changes_reps"](stg))
    assert same_rows(open_marts(spark, base)["mom_changes_reps"], M.MARTS["mom_changes_reps"](stage_journal(half)))
    third = build_tables(spark, half, base, str(tmp_path), ["workout_frequency_weekday"], keep=1)
    assert not spark.catalog.databaseExists(first) and not spark.catalog.databaseExists(second)
    assert current_build(spark, base) == third
    with pytest.raises(LookupError):
        open_marts(spark, "nothing_here")


def test_wide_heat_map(spark, make_stg):
    stg = make_stg([journal_row("2022-01-03", counter=1), journal_row("2022-01-10", counter=2), journal_row("2023-01-01", counter=1)])
    wide = D.dash_heatmap_wide(stg)
    assert wide.columns == ["weekday_position", "weekday", "y2022", "y2023"]
    assert {r["weekday"]: (r["y2022"], r["y2023"]) for r in wide.collect()} == {"monday": (2, 0), "sunday": (0, 1)}
    assert D.dash_heatmap_wide(stg, years=[2023]).columns[2:] == ["y2023"]


def test_path_build_publishes_nothing_when_it_fails(spark, make_stg, tmp_path, monkeypatch):
    import os

    from setbook.plans.build import build_marts
    from setbook.sources.versions import published
    rows = [journal_row("2022-01-03"), journal_row("2022-02-03", amount=3)]
    journal = spark.createDataFrame(rows, JOURNAL_SCHEMA)
    names = ["workout_sessions_per_year", "yearly_workouts_per_type"]
    first = build_marts(spark, journal, str(tmp_path), names)

    def broken(stg, by=()):
        raise ValueError("half-way")
    monkeypatch.setitem(M.MARTS, "yearly_workouts_per_type", broken)
    with pytest.raises(ValueError):
        build_marts(spark, journal.where("amount = 3"), str(tmp_path), names, threads=1)
    for n in names:
        assert published(spark, f"{tmp_path}/{n}") == first[n]
        assert [v for v in os.listdir(f"{tmp_path}/{n}") if v.startswith("v-")] == [first[n].rsplit("/", 1)[1]]


def test_input_state_sees_changed_files(spark, tmp_path):
    from setbook.sources.journal import _input_state
    for t in ("a", "b"):
        spark.range(5).write.parquet(f"{tmp_path}/{t}.parquet")
    one = _input_state(spark, str(tmp_path), ("a", "b"))
    assert one == _input_state(spark, f"{tmp_path}/", ("a", "b"))
    spark.range(6).write.mode("append").parquet(f"{tmp_path}/b.parquet")
    assert _input_state(spark, str(tmp_path), ("a", "b")) != one
    assert _input_state(spark, str(tmp_path), ("a",)) == tuple(x for x in one if "/a.parquet/" in x[0])


def test_refused_rows_of_the_daily_job_carry_reasons(spark, tmp_path):
    from setbook.plans.daily import ingest
    from setbook.sources.cells import CELLS_SCHEMA
    from setbook.sources.versions import published
    rows = [["head"], ["May"], [45413.0, "", "Wednesday", "Pull", "122/365"], ["Push"],
            ["Dips", "Bodyweight", "Wide", 5.0, 60.0], ["Dips", "red band", "Wide", 6.0, 60.0]]
    cells = [(1, "2024", r, c, v if isinstance(v, str) else None, v if isinstance(v, float) else None, None)
             for r, row in enumerate(rows) for c, v in enumerate(row)]
    spark.createDataFrame(cells, CELLS_SCHEMA).write.parquet(f"{tmp_path}/cells")
    ingest(spark, f"{tmp_path}/cells", f"{tmp_path}/journal", f"{tmp_path}/report")
    assert [r["amount"] for r in read_journal(spark, f"{tmp_path}/journal").collect()] == [5]
    refused = spark.read.parquet(published(spark, f"{tmp_path}/journal_rejected")).collect()
    assert [(r["amount"], r["reasons"]) for r in refused] == [(6, "not_null_weight,not_null_weight_unit")]
    report = {r["rule"]: r["violations"] for r in spark.read.parquet(published(spark, f"{tmp_path}/report")).collect()}
    assert {k for k, v in report.items() if v} == {"not_null_weight", "not_null_weight_unit"}


def test_build_in_order(spark, tmp_path):
    from setbook.plans.build import build_marts
    journal = journal_for(spark, SF_SMALL)
    paths = build_marts(spark, journal, str(tmp_path), ["total_reps_per_exercise_weight", "yearly_workouts_per_type"], in_order=True)
    got = spark.read.parquet(paths["total_reps_per_exercise_weight"]).select(
        "total_reps", F.input_file_name().alias("f"), F.col("_metadata.row_index").alias("i")).collect()
    totals = [r["total_reps"] for r in sorted(got, key=lambda r: (r["f"].rsplit("/", 1)[1], r["i"]))]
    assert totals == sorted(totals, reverse=True) and len(totals) > 100
