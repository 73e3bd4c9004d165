"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from allelespan.llm.collocations import OP13_SQL, op13_collocations
from allelespan.llm.decontaminate import OP5_SQL, op5_decontaminate
from allelespan.llm.langid import op9_language_id
from allelespan.llm.licences import op10_license_scan
from allelespan.llm.nearest import op8_stable_projections
from allelespan.llm.pieces import op7_merge_dropout
from allelespan.llm.pii import op1_pii_surrogates
from allelespan.llm.preference import OP2_SQL, op2_preference_format
from allelespan.llm.resampling import OP11_SQL, op11_importance_resampling
from allelespan.llm.sharding import op4_histogram_sort
from allelespan.llm.simhash import op6_simhash
from allelespan.llm.token_counts import op12_heap_bpe
from allelespan.llm.url_filter import op3_url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii_surrogates": op1_pii_surrogates,
        "op2_preference_format": op2_preference_format,
        "op3_url_filter": op3_url_filter,
        "op4_histogram_sort": op4_histogram_sort,
        "op5_decontaminate": op5_decontaminate,
        "op6_simhash": op6_simhash,
        "op7_merge_dropout": op7_merge_dropout,
        "op8_stable_projections": op8_stable_projections,
        "op9_language_id": op9_language_id,
        "op10_license_scan": op10_license_scan,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_heap_bpe": op12_heap_bpe,
        "op13_collocations": op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_preference_format": OP2_SQL,
        "op5_decontaminate": OP5_SQL,
        "op11_importance_resampling": OP11_SQL,
        "op13_collocations": OP13_SQL,
    }
