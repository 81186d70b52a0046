"""Registered queries of this subpackage: name → (Spark callable, SQL or None)."""

from __future__ import annotations

import os
import sys

from . import (
    byte_bpe,
    chat_format,
    decontamination,
    language_id,
    line_dedup,
    merkle,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    whitening,
)


def pipeline(spark, sf_dir):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_substring_dedup": (substring_dedup.op1_substring_dedup, None),
    "op2_decontamination": (decontamination.op2_decontamination, None),
    "op3_line_dedup": (line_dedup.op3_line_dedup, line_dedup.SQL),
    "op4_pii": (pii.op4_pii, None),
    "op5_simhash": (simhash.op5_simhash, None),
    "op6_language_id": (language_id.op6_language_id, None),
    "op7_quality_classifier": (quality_classifier.op7_quality_classifier, None),
    "op8_sharding": (sharding.op8_sharding, None),
    "op9_quality_rules": (quality_rules.op9_quality_rules, None),
    "op10_byte_bpe": (byte_bpe.op10_byte_bpe, None),
    "op11_whitening": (whitening.op11_whitening, None),
    "op12_merkle": (merkle.op12_merkle, merkle.SQL),
    "op13_chat_format": (chat_format.op13_chat_format, chat_format.SQL),
    "pipeline": (pipeline, None),
}
