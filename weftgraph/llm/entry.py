"""Registered queries of the operators and their DuckDB SQL (where SQL can express them)."""

from __future__ import annotations

from . import (chat, collocations, counts, exactdedup, hyperminhash, itq, licenses, mixing, negatives, packing, quality,
               tokenfile, urls)


def queries() -> dict:
    import corpus_pipeline

    return {
        "op1_chat_format": chat.query,
        "op2_best_fit_packing": packing.query,
        "op3_quality_rules": quality.query,
        "op4_token_files": tokenfile.query,
        "op5_pfair_mixing": mixing.query,
        "op6_token_counts": counts.query,
        "op7_url_filter": urls.query,
        "op8_license_scan": licenses.query,
        "op9_embedding_dedup": itq.query,
        "op10_minhash_dedup": hyperminhash.query,
        "op11_hard_negatives": negatives.query,
        "op12_exact_dedup": exactdedup.query,
        "op13_collocations": collocations.query,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_format": chat.ORACLE,
        "op3_quality_rules": quality.ORACLE,
        "op7_url_filter": urls.ORACLE,
        "op11_hard_negatives": negatives.ORACLE,
        "op12_exact_dedup": exactdedup.ORACLE,
        "op13_collocations": collocations.ORACLE,
    }
