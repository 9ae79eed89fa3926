"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    centroids,
    chat_format,
    embedding_join,
    exact_dedup,
    html_text,
    mixing,
    packing,
    secret_scan,
    sentencepiece_codec,
    simhash,
    toxicity,
    url_filter,
    vector_codes,
)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": sentencepiece_codec.op1_sentencepiece,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_simhash": simhash.op3_simhash,
        "op4_embedding_join": embedding_join.op4_embedding_join,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_packing": packing.op6_packing,
        "op7_url_filter": url_filter.op7_url_filter,
        "op8_secret_scan": secret_scan.op8_secret_scan,
        "op9_chat_format": chat_format.op9_chat_format,
        "op10_html_text": html_text.op10_html_text,
        "op11_source_mix": mixing.op11_source_mix,
        "op12_vector_codes": vector_codes.op12_vector_codes,
        "op13_centroids": centroids.op13_centroids,
    }


def oracles() -> dict[str, str]:
    """DuckDB SQL where SQL can express the operator; the others are tested by brute force."""
    return {
        "op2_exact_dedup": exact_dedup.ORACLE,
        "op9_chat_format": chat_format.ORACLE,
        "op11_source_mix": mixing.ORACLE,
        "op12_vector_codes": vector_codes.ORACLE,
        "op13_centroids": centroids.ORACLE,
    }
