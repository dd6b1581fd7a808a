"""Corpus preparation: language ID, near-dedup, decontamination, secret masking, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
that the one before it kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barframe.llm.common import materialise, read
from barframe.llm.decontaminate import decontamination_stage
from barframe.llm.language_id import language_stage
from barframe.llm.minhash_dedup import dedup_stage
from barframe.llm.secret_scan import secret_stage
from barframe.llm.source_mix import mix_stage

STAGES = [
    ("language_id", language_stage),
    ("minhash_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("source_mix", mix_stage),
]

#: Hyperdimensional cosines and the randomness battery have no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written once and read by the next."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
