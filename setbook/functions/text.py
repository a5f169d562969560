"""Text parsing expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocab import BODYWEIGHT_MARK, KG_MARK


def weight_kg(text_col) -> Column:
    """Weight cell text -> DECIMAL(5,2) kilograms.

    Contains 'Bodyweight' -> 0.00 (checked first, so 'Bodyweight + 10kg' is 0);
    else contains 'kg' -> the number before the first 'kg'; else NULL.  The
    match is case-sensitive.  Rounded to two places half to even on the
    double, as the original's frames are.  A text that is no number gives
    NULL (reported by ``check_journal``) instead of failing the job.
    """
    t = F.col(text_col) if isinstance(text_col, str) else text_col
    before_kg = F.trim(F.substring_index(t, KG_MARK, 1))
    value = F.when(t.contains(BODYWEIGHT_MARK), F.lit(0.0)).when(
        t.contains(KG_MARK), number_or_null(before_kg)
    )
    return (F.rint(value * 100) / 100).try_cast("decimal(5,2)")


def weight_unit(text_col) -> Column:
    """'kg' when the weight text is recognised (bodyweight or '<n>kg'), else NULL."""
    t = F.col(text_col) if isinstance(text_col, str) else text_col
    return F.when(t.contains(BODYWEIGHT_MARK) | t.contains(KG_MARK), F.lit(KG_MARK))


def number_or_null(text: Column) -> Column:
    """A plain decimal number (sign, point, exponent) as DOUBLE, else NULL;
    suffixes that only the JVM reads, such as ``10d``, are not numbers."""
    return F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double"))
