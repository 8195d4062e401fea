"""Queries of the corpus operators by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revlens.llm import (
    bpe,
    collocations,
    gridjoin,
    langid,
    lengths,
    licenses,
    manifest,
    minhash,
    mixing,
    pitmanyor,
    quality,
    secrets,
    substrings,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per operator, over whole tables."""
    listed = [
        mixing.op1_mix_sources,
        minhash.op2_minhash_near_dedup,
        gridjoin.op3_grid_order_join,
        bpe.op4_bpe_round_trip,
        quality.op5_quality_rules,
        pitmanyor.op6_pitman_yor_scores,
        substrings.op7_substring_dedup,
        secrets.op8_secret_scan,
        langid.op9_language_id,
        lengths.op10_token_counts,
        manifest.op11_merkle_manifest,
        collocations.op12_phrase_collocations,
        licenses.op13_license_scan,
    ]
    return {query.__name__: query for query in listed}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name."""
    return {
        "op1_mix_sources": mixing.ORACLE,
        "op2_minhash_near_dedup": minhash.ORACLE,
        "op3_grid_order_join": gridjoin.ORACLE,
        "op7_substring_dedup": substrings.ORACLE,
        "op11_merkle_manifest": manifest.ORACLE,
        "op12_phrase_collocations": collocations.ORACLE,
        "op13_license_scan": licenses.ORACLE,
    }
