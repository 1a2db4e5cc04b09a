"""The corpus pipeline: documents in, clean and tokenised documents out.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and
read again as the next one's ``docs``. All but the last return the columns of
``documents``; a null text counts as empty throughout.
"""

from __future__ import annotations

from txrisk.llm.bpe import stage_bpe
from txrisk.llm.common import read, written
from txrisk.llm.decontam import stage_decontamination
from txrisk.llm.dedup import stage_dedup
from txrisk.llm.pii import stage_pii
from txrisk.llm.quality import stage_quality

STAGES = [
    ("quality rules", stage_quality),
    ("near-duplicates", stage_dedup),
    ("benchmark decontamination", stage_decontamination),
    ("personal data", stage_pii),
    ("byte-pair encoding", stage_bpe),
]

#: Trained models, message passing and byte-pair merges are not SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in order, each on the Parquet table that its predecessor left."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
