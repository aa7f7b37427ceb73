"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larkspur.llm import bpe, chat, fingerprints, licenses, lines, packing, pii, quality, simhash, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii_crf": pii.op1_pii_crf,
        "op2_arc_to_warc": warc.op2_arc_to_warc,
        "op3_license_diagonals": licenses.op3_license_diagonals,
        "op4_incremental_chat": chat.op4_incremental_chat,
        "op5_edit_embedding": fingerprints.op5_edit_embedding,
        "op6_simhash_blocks": simhash.op6_simhash_blocks,
        "op7_quality_divergence": quality.op7_quality_divergence,
        "op8_bpe_chunk_reuse": bpe.op8_bpe_chunk_reuse,
        "op9_bounded_best_fit": packing.op9_bounded_best_fit,
        "op10_segment_edit_join": lines.op10_segment_edit_join,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_arc_to_warc": warc.OP2_SQL,
        "op3_license_diagonals": licenses.OP3_SQL,
        "op4_incremental_chat": chat.OP4_SQL,
        "op7_quality_divergence": quality.OP7_SQL,
    }
