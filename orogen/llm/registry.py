"""The queries of this subpackage and their DuckDB SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orogen.llm import decontamination, repeats
from orogen.llm.alignment import op11_cross_tokenizer_alignment
from orogen.llm.decontamination import op4_benchmark_decontamination
from orogen.llm.embeddings import op9_embedding_near_dedup
from orogen.llm.interpolation import op7_deleted_interpolation
from orogen.llm.merges import op12_bpe_round_trip
from orogen.llm.packing import op10_packed_token_ids
from orogen.llm.pieces import op6_sentencepiece_round_trip
from orogen.llm.private import op8_personal_data
from orogen.llm.quality import op1_quality_classifier
from orogen.llm.repeats import op3_repeated_passages
from orogen.llm.simhash import op5_simhash_near_dedup
from orogen.llm.toxicity import op2_toxicity_ordinal
from orogen.llm.whitening import op13_embedding_whitening

_QUERIES = (
    op1_quality_classifier,
    op2_toxicity_ordinal,
    op3_repeated_passages,
    op4_benchmark_decontamination,
    op5_simhash_near_dedup,
    op6_sentencepiece_round_trip,
    op7_deleted_interpolation,
    op8_personal_data,
    op9_embedding_near_dedup,
    op10_packed_token_ids,
    op11_cross_tokenizer_alignment,
    op12_bpe_round_trip,
    op13_embedding_whitening,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    """The others learn a model, follow links or need a tokenizer, and are held against brute force in the tests."""
    return {"op3_repeated_passages": repeats.ORACLE_SQL, "op4_benchmark_decontamination": decontamination.ORACLE_SQL}
