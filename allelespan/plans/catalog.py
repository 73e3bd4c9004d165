"""Registered queries over the driver's tables and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from allelespan.plans import align_queries, chain_queries, composite_queries, function_queries, interval_queries, io_queries, kmer_queries, pair_queries

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
for found in (kmer_queries, interval_queries, pair_queries, align_queries, function_queries, composite_queries, chain_queries, io_queries):
    QUERIES |= found.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in QUERIES.items() if sql}
