"""Queries of this subpackage and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spectrail.llm.bpe import op8_bpe_round_trip
from spectrail.llm.decontaminate import OP9_SQL, op9_decontamination
from spectrail.llm.filter_audit import OP11_SQL, op11_filter_audit
from spectrail.llm.jaccard import OP10_SQL, op10_jaccard_join
from spectrail.llm.language import op4_language
from spectrail.llm.merkle import OP13_SQL, op13_merkle_manifest
from spectrail.llm.pii import op7_pii
from spectrail.llm.secrets import op3_secrets
from spectrail.llm.sharding import OP1_SQL, op1_interleaved_shards
from spectrail.llm.simhash import op12_simhash
from spectrail.llm.substrings import OP6_SQL, op6_substrings
from spectrail.llm.token_files import op5_token_files
from spectrail.llm.topk import OP2_SQL, op2_top_k

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    import corpus_pipeline

    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (op1_interleaved_shards, op2_top_k, op3_secrets, op4_language, op5_token_files, op6_substrings, op7_pii, op8_bpe_round_trip, op9_decontamination, op10_jaccard_join, op11_filter_audit, op12_simhash, op13_merkle_manifest)}


def oracle_sql() -> dict[str, str]:
    return {"op1_interleaved_shards": OP1_SQL, "op2_top_k": OP2_SQL, "op6_substrings": OP6_SQL, "op9_decontamination": OP9_SQL, "op10_jaccard_join": OP10_SQL, "op11_filter_audit": OP11_SQL, "op13_merkle_manifest": OP13_SQL}
