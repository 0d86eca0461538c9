"""From raw documents to packed sequences: quality rules, exact and near duplicates, mix, packing.

Each stage gets what the one before it kept, and all but the last return the columns of
``documents``. Between stages ``run`` writes Parquet to the shared folder, so that each starts
from a table and an executor's loss costs no more than its own tasks. No SQL twin: packing
needs a tokenizer; tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm.dedup import dedup_stage
from linkloom.llm.mixing import mixing_stage
from linkloom.llm.ngram_join import near_duplicate_stage
from linkloom.llm.packing import pack
from linkloom.llm.quality import quality_stage
from linkloom.llm.shared import Workspace

STAGES = [
    ("quality_rules", lambda spark, docs, sf_dir: quality_stage(docs)),
    ("exact_dedup", lambda spark, docs, sf_dir: dedup_stage(docs)),
    ("ngram_jaccard_join", lambda spark, docs, sf_dir: near_duplicate_stage(docs)),
    ("mixing", lambda spark, docs, sf_dir: mixing_stage(docs)),
    ("best_fit_packing", lambda spark, docs, sf_dir: pack(docs)),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of ``documents``."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = ws.save(stage(spark, docs, sf_dir), f"{k}_{name}")
        if k:
            ws.drop(f"{k - 1}_{STAGES[k - 1][0]}")
    return docs
