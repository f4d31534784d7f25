"""Labelled documents: the held-out fold and bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import Workspace


def fold_number(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 5; remainder 0 is held out of training."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """label_id, label, fold of every labelled id outside the held-out fold."""
    return (
        labels.select(
            labels["doc_id"].cast("long").alias("label_id"), labels[label].cast("int").alias("label")
        )
        .filter("label_id is not null and label is not null")
        .groupBy("label_id")
        .agg(F.max("label").alias("label"))
        .withColumn("fold", fold_number(F.col("label_id")))
        .filter("fold <> 0")
    )


def class_counts(docs: DataFrame, labels: DataFrame, label: str) -> dict[int, int]:
    """Number of labelled documents per label, all of them outside the held-out fold."""
    ids = docs.select(docs["doc_id"].cast("long").alias("label_id"))
    rows = known_labels(labels, label).join(ids, "label_id", "left_semi")
    return {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}


def training_sample(
    ws: Workspace, docs: DataFrame, labels: DataFrame, label: str, most_of: dict[int, int]
) -> DataFrame:
    """Texts and labels of a bounded, hash-picked sample outside the held-out fold.

    The ids (at most the sum of ``most_of``) are broadcast to the scan; equal
    texts count once.
    """
    known = known_labels(labels, label)
    picked = None
    for value, most in most_of.items():
        some = known.filter(F.col("label") == value).orderBy(F.xxhash64("label_id")).limit(most)
        picked = some if picked is None else picked.unionByName(some)
    picked = ws.keep(picked, "label-ids")
    texts = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text"))
    sample = texts.join(F.broadcast(picked), F.col("id") == F.col("label_id"))
    sample = sample.select("text", "label", "fold", F.xxhash64("text").alias("h"))
    return ws.keep(sample.dropDuplicates(["h", "label"]).drop("h"), "sample")
