"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from linkloom.llm import dedup, langid, lm, mixing, ngram_join, packing, quality, secrets, sharding, warc


def queries():
    return {
        "op1_secret_scan": secrets.op1_secret_scan,
        "op2_ngram_join": ngram_join.op2_ngram_join,
        "op3_mixing": mixing.op3_mixing,
        "op4_language_id": langid.op4_language_id,
        "op5_exact_dedup": dedup.op5_exact_dedup,
        "op6_lm_scoring": lm.op6_lm_scoring,
        "op7_quality_rules": quality.op7_quality_rules,
        "op8_sharding": sharding.op8_sharding,
        "op9_warc": warc.op9_warc,
        "op10_best_fit_packing": packing.op10_best_fit_packing,
    }


def oracle_sql():
    return {"op3_mixing": mixing.OP3_SQL, "op5_exact_dedup": dedup.OP5_SQL, "op7_quality_rules": quality.OP7_SQL, "op8_sharding": sharding.OP8_SQL}
