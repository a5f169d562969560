"""check_journal on hand-made bad rows; unit conversion."""

from decimal import Decimal

from pyspark.sql import functions as F

from setbook.operators.quality import check_journal
from setbook.operators.units import convert_unit
from setbook.sources.journal import JOURNAL_SCHEMA

from conftest import journal_row as J


def test_check_journal_reports_each_rule(spark):
    good = J("2024-05-06")
    bad_unit = J("2024-05-06", unit="stone")
    bad_month = J("2024-05-06", month="jan")
    wrong_month = J("2024-05-06", month="june")        # known name, other month than the date
    two_units = J("2024-05-07", unit="lbs")            # same cell as `good` but another unit
    neg = J("2024-05-08", amount=-1, deload=2)
    schema = JOURNAL_SCHEMA
    # nullable copy of the schema so NULLs can be fed in
    from pyspark.sql import types as T
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    null_weight = list(J("2024-05-09")); null_weight[9] = None
    rows = [good, bad_unit, bad_month, wrong_month, two_units, neg, tuple(null_weight)]
    df = spark.createDataFrame(rows, loose)
    good_rows, report = check_journal(df)
    r = {x.rule: x.violations for x in report.collect()}
    assert r["unit_allowed"] == 1 and r["month_name_known"] == 1 and r["month_matches_date"] == 2
    assert r["negative_amount"] == 1 and r["deload_is_flag"] == 1 and r["not_null_weight"] == 1
    assert r["one_unit_per_cell"] == 1 and r["not_null_date"] == 0
    assert good_rows.count() == 2      # `good` and `two_units` pass every row-level rule


def test_convert_unit_lbs_is_exact(spark):
    df = spark.createDataFrame([(Decimal("10.00"),), (Decimal("12.50"),), (Decimal("0.00"),)],
                               "added_weight decimal(5,2)")
    got = [(r.display_weight, r.display_unit) for r in convert_unit(df, unit="lbs").collect()]
    assert got == [(Decimal("22.00"), "lbs"), (Decimal("27.50"), "lbs"), (Decimal("0.00"), "lbs")]
    assert [r.display_weight for r in convert_unit(df, unit="kg").collect()] == \
        [Decimal("10.00"), Decimal("12.50"), Decimal("0.00")]
