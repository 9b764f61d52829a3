"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from lakestrata.llm import (
    ball_tree,
    bpe,
    decontaminate,
    html_wrappers,
    importance,
    katz,
    language_id,
    near_dup,
    packing,
    pii,
    secrets,
    syncmers,
    toxicity,
)


def queries() -> dict:
    return {
        "op1_pii": pii.op1_pii,
        "op2_language": language_id.op2_language,
        "op3_syncmers": syncmers.op3_syncmers,
        "op4_katz": katz.op4_katz,
        "op5_secrets": secrets.op5_secrets,
        "op6_decontaminate": decontaminate.op6_decontaminate,
        "op7_html": html_wrappers.op7_html,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_bpe": bpe.op9_bpe,
        "op10_near_dup": near_dup.op10_near_dup,
        "op11_search": ball_tree.op11_search,
        "op12_resample": importance.op12_resample,
        "op13_packing": packing.op13_packing,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_decontaminate": decontaminate.ORACLE,
        "op11_search": ball_tree.ORACLE,
        "op12_resample": importance.ORACLE,
    }
