"""The corpus pipeline: five stages, each reading what the one before kept.

run(spark, sf_dir) applies them to documents; every stage is written as Parquet
in the shared folder and read again as the next one's docs.
"""

from __future__ import annotations

from keyledger.llm.common import documents
from keyledger.llm.exact_dedup import stage_exact_dedup
from keyledger.llm.mixing import stage_mixing
from keyledger.llm.packing import stage_packing
from keyledger.llm.quality import stage_quality
from keyledger.llm.simhash import stage_simhash
from keyledger.session import stage

STAGES = [
    ("quality_classifier", stage_quality),
    ("exact_dedup", stage_exact_dedup),
    ("simhash_near_dedup", stage_simhash),
    ("mixing", stage_mixing),
    ("packing", stage_packing),
]

# No SQL: the classifier, the fingerprints and the packing have none; tests hold
# the rows against brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    docs = documents(spark, sf_dir)
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
