"""Queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .extraction import op1_template_extraction
from .fill_middle import OP11_SQL, op11_fill_in_middle
from .fingerprint import op8_parsing_fingerprint
from .lattice_lm import op9_lattice_lm
from .media import op5_lossless_webp
from .mixing import OP4_SQL, op4_fair_queue_mixing
from .multi_index import op13_inverted_multi_index
from .near_dedup import OP10_SQL, op10_minhash_near_dedup
from .packing import op7_best_fit_packing
from .sharding import op3_hilbert_sharding
from .suffix_dedup import op2_suffix_dedup
from .toxicity import op6_toxicity
from .turn_repair import OP12_SQL, op12_conversation_repair


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_template_extraction": op1_template_extraction,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_hilbert_sharding": op3_hilbert_sharding,
        "op4_fair_queue_mixing": op4_fair_queue_mixing,
        "op5_lossless_webp": op5_lossless_webp,
        "op6_toxicity": op6_toxicity,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_parsing_fingerprint": op8_parsing_fingerprint,
        "op9_lattice_lm": op9_lattice_lm,
        "op10_minhash_near_dedup": op10_minhash_near_dedup,
        "op11_fill_in_middle": op11_fill_in_middle,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_inverted_multi_index": op13_inverted_multi_index,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_fair_queue_mixing": OP4_SQL,
        "op10_minhash_near_dedup": OP10_SQL,
        "op11_fill_in_middle": OP11_SQL,
        "op12_conversation_repair": OP12_SQL,
    }
