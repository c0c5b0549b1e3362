"""The registered queries of the subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedmark.llm import bpe, divergence, exact, merkle, mixing, ngrams, pieces, secrets, suffixes, token_files, toxicity, vectors, warc

Query = Callable[[SparkSession, str], DataFrame]


def registered() -> dict[str, Query]:
    return {
        "op1_mix_sources": mixing.query,
        "op2_token_files": token_files.query,
        "op3_toxicity": toxicity.query,
        "op4_near_vectors": vectors.query,
        "op5_bpe_round_trip": bpe.query,
        "op6_suffix_dedup": suffixes.query,
        "op7_warc_round_trip": warc.query,
        "op8_ngram_join": ngrams.query,
        "op9_exact_dedup": exact.query,
        "op10_secret_scan": secrets.query,
        "op11_merkle_manifest": merkle.query,
        "op12_source_divergence": divergence.query,
        "op13_pieces_round_trip": pieces.query,
    }


def sql() -> dict[str, str]:
    return {
        "op4_near_vectors": vectors.SQL,
        "op7_warc_round_trip": warc.SQL,
        "op8_ngram_join": ngrams.SQL,
        "op9_exact_dedup": exact.SQL,
        "op10_secret_scan": secrets.SQL,
        "op11_merkle_manifest": merkle.SQL,
        "op12_source_divergence": divergence.SQL,
    }
