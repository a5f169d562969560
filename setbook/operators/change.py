"""Period-over-period change (lag-based), e.g. month-over-month, year-over-year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import relative_change


def period_change(df: DataFrame, keys, order, value: str, offset: int,
                  prev_name: str, pct_name: str, abs_name: str,
                  guard: str | None = None, pct_rule: str = "any_nonzero",
                  pct_type: str = "decimal(18,2)") -> DataFrame:
    """Add previous value, % change and absolute change of ``value``.

    prev      = LAG(value, offset) over (keys order by order); with
                ``guard`` the previous value is kept only when
                LAG(guard, offset) = guard (e.g. same month_int a year ago).
    pct       = 100 when prev = 0 and value > 0; otherwise
                round(100 * (value - LAG) / LAG, 2) when prev qualifies
                (``pct_rule`` "any_nonzero": prev <> 0, "positive": prev > 0);
                otherwise NULL.
    absolute  = value - coalesce(LAG(value, offset), 0)  (never guarded).

    One window spec; ``order`` NULLs sort last.  When ``df`` is already
    hash-partitioned on ``keys`` (the dense grid is) no exchange is added.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    raw_prev = F.lag(value, offset).over(w)
    cur = F.col(value)
    if guard is not None:
        prev = F.when(F.lag(guard, offset).over(w) == F.col(guard), F.col("_lag_raw"))
    else:
        prev = F.col("_lag_raw")           # one lag, reused (equal lag calls are not merged)
    qualifies = (F.col(prev_name) != 0) if pct_rule == "any_nonzero" else (F.col(prev_name) > 0)
    pct = (F.when((F.col(prev_name) == 0) & (cur > 0), F.lit(100).cast(pct_type))
             .when(qualifies, relative_change(cur, F.col("_lag_raw")).cast(pct_type)))
    out = (df.withColumn("_lag_raw", raw_prev)
             .withColumn(prev_name, prev.cast("bigint"))
             .withColumn(pct_name, pct)
             .withColumn(abs_name, (cur - F.coalesce(F.col("_lag_raw"), F.lit(0))).cast("bigint")))
    return out.drop("_lag_raw")
