"""Operators for training-data pipelines; nothing else in the library imports them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module

MODULES = ("suffix_dedup", "line_dedup", "quality_rules", "source_mix", "sharding", "pair_index_bpe", "secret_forest", "shingle_join", "token_pack", "impact_topk", "fingerprints", "conversation_repair", "token_alignment")


def _all(name: str) -> dict:
    return {k: v for m in MODULES for k, v in getattr(import_module(f"{__name__}.{m}"), name).items()}


def _shipped(query: Callable) -> Callable:
    @wraps(query)
    def run(spark, sf_dir):
        from chunkwright.llm import shared

        shared.ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict:
    import corpus_pipeline

    return {k: _shipped(q) for k, q in (_all("QUERIES") | {"pipeline": corpus_pipeline.run}).items()}


def oracle_sql() -> dict:
    return _all("ORACLES")
