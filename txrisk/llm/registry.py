"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from txrisk.llm import bpe, chat, codes, decontam, dedup, langid, licenses, neighbours, pii, quality, repair, toxicity, urls

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_bpe": bpe.op2_bpe,
    "op3_licenses": licenses.op3_licenses,
    "op4_chat": chat.op4_chat,
    "op5_urls": urls.op5_urls,
    "op6_quality": quality.op6_quality,
    "op7_minhash": dedup.op7_minhash,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_decontamination": decontam.op9_decontamination,
    "op10_language": langid.op10_language,
    "op11_neighbours": neighbours.op11_neighbours,
    "op12_codes": codes.op12_codes,
    "op13_repair": repair.op13_repair,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op4_chat": chat.ORACLE_SQL,
    "op5_urls": urls.ORACLE_SQL,
    "op7_minhash": dedup.ORACLE_SQL,
    "op9_decontamination": decontam.ORACLE_SQL,
    "op12_codes": codes.oracle_sql(),
    "op13_repair": repair.ORACLE_SQL,
}
