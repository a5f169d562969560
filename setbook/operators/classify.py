"""Exercise classification (LIKE-pattern dimensions) and dimension joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vocab import COMBO_PATTERN, SECONDS_PATTERN


def like_predicate(col, include=(), exclude=()) -> Column:
    """AND of ``col LIKE p`` for p in include and ``col NOT LIKE p`` for p in exclude."""
    c = F.col(col) if isinstance(col, str) else col
    terms = [c.like(p) for p in include] + [~c.like(p) for p in exclude]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def is_reps_exercise(col="exercise") -> Column:
    """Counted in repetitions: no '(s)' marker and not a '+' combination."""
    return like_predicate(col, exclude=(SECONDS_PATTERN, COMBO_PATTERN))


def is_seconds_exercise(col="exercise") -> Column:
    """Counted in seconds: contains '(s)' (combinations included)."""
    return like_predicate(col, include=(SECONDS_PATTERN,))


def classify(df: DataFrame, col: str, predicate: Column, by=()) -> DataFrame:
    """Distinct values of ``col`` satisfying ``predicate`` (a dimension table)."""
    return df.where(predicate).select(*by, col).distinct()


def restrict_to(df: DataFrame, predicate: Column) -> DataFrame:
    """Keep rows whose class predicate holds.

    Used instead of ``df ⋈ classify(df', col, predicate)`` whenever the
    values of ``df.col`` are drawn from the data the dimension was built
    from: a row then joins exactly one dimension row iff the predicate
    holds, so the join is the filter — no shuffle, no broadcast.
    """
    return df.where(predicate)


def semi_join(df: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose keys occur in an externally supplied ``dim``.

    No broadcast hint: adaptive execution measures the materialised ``dim``
    and broadcasts it only when it is below the broadcast threshold,
    otherwise keeps a shuffled semi join.  Only the keys of ``dim`` take part.
    Where ``dim`` is filtered and both sides shuffle, Spark first
    builds a Bloom filter of its keys and drops facts that cannot match at
    the scan (``spark.sql.optimizer.runtime.bloomFilter.*``); a hot key of the
    facts is split by adaptive skew handling, as only their side repeats keys.
    """
    names = [on] if isinstance(on, str) else list(on)
    return df.join(dim.select(*names), on=names, how="left_semi")
