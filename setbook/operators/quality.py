"""Journal quality checks (schema constraints + the grid's known traps).

One pass over the rows gives each the bits of the row-level rules it breaks;
the one cross-row rule (a grid cell with several month texts or units, which
would multiply rows downstream) is an aggregation over the cell key.
Nothing is collected: the report is a DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_name, month_number, weekday_name, weekday_number
from ..functions.vocab import ALLOWED_UNITS
from ..sources.journal import JOURNAL_SCHEMA


def row_rules() -> dict[str, Column]:
    """rule name -> predicate that is TRUE for a violating row."""
    rules: dict[str, Column] = {}
    for f in JOURNAL_SCHEMA.fields:
        rules[f"not_null_{f.name}"] = F.col(f.name).isNull()
    rules["unit_allowed"] = ~F.col("weight_unit").isin(*ALLOWED_UNITS)
    rules["deload_is_flag"] = ~F.col("deload").isin(0, 1)
    rules["weight_fits_5_2"] = F.abs(F.col("weight")) >= 1000
    rules["month_name_known"] = month_number(F.col("month")).isNull() & F.col("month").isNotNull()
    rules["weekday_name_known"] = weekday_number(F.col("weekday")).isNull() & F.col("weekday").isNotNull()
    rules["month_matches_date"] = F.col("month") != month_name(F.col("date"))
    rules["weekday_matches_date"] = F.col("weekday") != weekday_name(F.col("date"))
    rules["negative_amount"] = F.col("amount") < 0
    return rules


def _enforced(name: str) -> bool:
    """Rules that the journal table itself enforces: nothing NULL, a known unit, a weight that fits."""
    return name.startswith("not_null_") or name in ("unit_allowed", "weight_fits_5_2")


def rule_bits() -> dict[str, int]:
    """rule name -> its bit in the mask of ``broken_rules``."""
    return {name: 1 << i for i, name in enumerate(row_rules())}


def enforced_bits() -> int:
    return sum(bit for name, bit in rule_bits().items() if _enforced(name))


def broken_rules(enforced_only: bool = False) -> Column:
    """BIGINT with the bit of every row-level rule (or enforced one) that the row breaks; 0 for a clean row."""
    bits = rule_bits()
    return reduce(lambda a, b: a.bitwiseOR(b), [
        F.when(F.coalesce(p, F.lit(False)), F.lit(bits[name])).otherwise(F.lit(0)) for name, p in row_rules().items()
        if _enforced(name) or not enforced_only
    ]).cast("bigint")


def accepted(mask: Column) -> Column:
    """TRUE where no enforced rule is broken (smallints fit by their type)."""
    return mask.bitwiseAND(F.lit(enforced_bits())) == 0


def reasons(mask: Column, enforced_only: bool = True) -> Column:
    """The names of the broken rules, comma-joined in the order of the rules."""
    return F.concat_ws(",", *[
        F.when(mask.bitwiseAND(F.lit(bit)) != 0, F.lit(name)) for name, bit in rule_bits().items()
        if _enforced(name) or not enforced_only])


def constraints_met() -> Column:
    """TRUE for rows that the journal table accepts."""
    return accepted(broken_rules())


def rejected_rows(journal: DataFrame, mask: str = "broken", text: str = "reasons") -> DataFrame:
    """The rows that the journal table refuses, with the bits and names of the enforced rules they break.

    Only the enforced rules are looked at, once a row: a filter on the mask
    would be moved below the columns it is made of and work all of them out
    again, so the refused rows are handed on as arrays of one row, the others as none.
    """
    marked = journal.withColumn(mask, broken_rules(enforced_only=True))
    row = F.struct(*[F.col(c) for c in marked.columns])
    refused = marked.select(F.inline(F.when(F.col(mask) != 0, F.array(row))))
    return refused.withColumn(text, reasons(F.col(mask)))


def check_journal(journal: DataFrame, by=(), mask: str | None = None):
    """Return (good_rows, report).

    ``report`` has one row per rule (and log, with ``by``): (rule,
    violations).  ``good_rows`` are the rows that break no row-level rule.
    ``mask`` names a column that already holds ``broken_rules()``.

    One scan: a row's broken rules are one number, and rows are counted per
    (grid cell, number), combined map-side; the rules' counts and the
    cross-row rule (a cell's smallest against its largest month text and
    unit) come from those few rows.
    """
    broken = F.col(mask) if mask else broken_rules()
    variant = F.when(F.col("month").isNotNull() & F.col("weight_unit").isNotNull(), F.struct("month", "weight_unit"))
    cell = (*by, "_y", "_m", "exercise", "weight")
    counted = journal.groupBy(*by, F.year("date").alias("_y"), month_number(F.col("month")).alias("_m"),
                              "exercise", "weight", broken.alias("_broken")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(variant).alias("_a"), F.max(variant).alias("_z"))
    bits = rule_bits()
    hits = {name: F.sum(F.when(F.col("_broken").bitwiseAND(F.lit(bit)) != 0, F.col("_n")).otherwise(0))
            for name, bit in bits.items()}
    cells = counted.groupBy(*cell).agg(
        *[h.alias(name) for name, h in hits.items()],
        F.coalesce(F.min("_a") != F.max("_z"), F.lit(False)).cast("bigint").alias("one_unit_per_cell"))
    names = [*bits, "one_unit_per_cell"]
    counts = cells.groupBy(*by).agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names])
    report = counts.select(*by, F.inline(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in names])))
    return journal.where(broken == 0), report
