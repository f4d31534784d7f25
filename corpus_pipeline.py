"""Corpus pipeline: five stages over ``documents``, each one operator of ``costlens.llm``.

1. ``quality``: rejected documents go;
2. ``near_dedup``: the document with the smallest id of each near-duplicate group stays;
3. ``decontaminate``: documents with a benchmark passage go;
4. ``secrets``: secrets inside the texts are masked, documents stay;
5. ``tokens``: byte-level BPE ids of every text, with the digests of ids and decoded bytes.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``docs``.  ``run`` writes each stage's result as Parquet
to the shared checkpoint folder and reads it back as the next one's input, so a
lost executor repeats tasks of one stage at most.  Nulls, empty tables and extra
columns are handled as each operator's docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from costlens.llm import bpe, decontaminate, near_dedup, quality, secret_scan
from costlens.llm.common import Workspace, table
from costlens.llm.queries import RANK_FILE


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one_per_group(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("secrets", secrets_stage),
    ("tokens", tokens_stage),
]

# The classifier, the forest and BPE cannot be said in SQL; tests/llm compares the
# stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = ws.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
