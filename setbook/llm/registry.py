"""The registered queries of the document operators and their SQL."""

from __future__ import annotations

from . import (
    decontaminate,
    exact_dedup,
    near_dedup,
    phrase_dedup,
    pii,
    quality,
    ranked_search,
    sentence_pieces,
    sharding,
    suffix_dedup,
    token_ids,
    url_filter,
    whitening,
)


def queries() -> dict:
    """(spark, sf_dir) -> DataFrame by name; each runs over its whole table."""
    out = {f.__name__: f for f in (
        near_dedup.op1_near_dedup,
        pii.op2_pii,
        exact_dedup.op3_exact_dedup,
        token_ids.op4_token_ids,
        suffix_dedup.op5_suffix_dedup,
        decontaminate.op6_decontaminate,
        sentence_pieces.op7_sentence_pieces,
        phrase_dedup.op8_phrase_dedup,
        quality.op9_quality_classifier,
        url_filter.op10_url_filter,
        sharding.op11_sharding,
        ranked_search.op12_ranked_search,
        whitening.op13_whitening,
    )}
    out["op5_suffix_dedup"] = suffix_dedup.with_longest_shared         # one column more
    return out


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where SQL can express a query."""
    return {
        "op3_exact_dedup": exact_dedup.ORACLE,
        "op10_url_filter": url_filter.ORACLE,
        "op12_ranked_search": ranked_search.ORACLE,
    }
