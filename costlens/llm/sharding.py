"""Operator 6: balanced shards by vector bin packing.

Law: ``bytes`` (the shards' sizes are near equal).  A document's size is the
UTF-8 length of its text plus 16; its vector is (size, words, 1), so bytes,
tokens and rows are balanced jointly, bytes first.

Documents with equal texts form a group and share a shard.  Placing needs the
groups' vectors in order of size, one after the other; to bound that step,
groups below 1/``CELLS`` of all bytes are merged into at most ``CELLS`` cells by a
hash of their text, so the driver places at most 2 * ``CELLS`` + pieces vectors
whatever the corpus holds.  A group of more than a shard's share cannot stay
whole in balanced shards: it is cut into pieces of a fraction of a share by a
hash of the doc_id.  (With few documents every group is placed on its own.)

Placing: in falling order of size, each vector goes to the shard where its dot
product with the shard's residual capacity is highest, both counted in shares
of a shard, with a growing charge for a shard whose bytes would run over.

Slots: rows are numbered per shard and hash bucket of bounded size, and buckets
are offset by running counts, so no task sorts a whole shard.

Defined results: a null text has size 16, digest 0 and forms a group with the
empty text's rows kept apart; repeated rows are placed like any copies and get
slots of their own; null doc_ids are placed by their text; ``grown_shard`` is null
(it belongs to another law); empty tables give empty results; further columns
are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.common import Workspace

SHARDS = 40
ROW_BYTES = 16
CELLS = 8192  # cells of small groups, and at most as many large groups
PIECE = 8  # pieces of a group that outgrows a shard: about a share / PIECE each
SLOT_ROWS = 20_000  # rows numbered in one task's bucket


def _digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, group key and words of every row; one pass, no Python."""
    text = docs["text"].cast("string")
    raw = F.coalesce(text, F.lit("")).cast("binary")
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.length(raw) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(text, F.length(raw), F.crc32(raw), text.isNull()).alias("group"),
        (F.length(text) - F.length(F.replace(text, F.lit(" "))) + 1).cast("long").alias("words"),
    )


def pack(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every vector (bytes, words, rows): falling size, highest dot product.

    ``vectors`` holds shares of one shard's capacity per dimension.
    """
    weight = np.array([1.0, 0.25, 0.25])
    residual = np.ones((shards, vectors.shape[1]))
    out = np.empty(len(vectors), np.int32)
    for i in np.lexsort(tuple(vectors.T[::-1]))[::-1]:
        item = vectors[i]
        direction = item * weight / max(float(np.linalg.norm(item)), 1e-300)
        gain = residual @ direction
        over = np.maximum(item[0] - residual[:, 0], 0)
        best = int(np.argmax(gain - 10 * over))
        out[i] = best
        residual[best] -= item
    return out


def _piece() -> Column:
    return F.pmod(F.xxhash64("doc_id"), "pieces").cast("int").alias("piece")


def place(ws: Workspace, digest: DataFrame, shards: int) -> tuple[DataFrame, DataFrame]:
    """(group, pieces) of every group and (group, piece, shard) of every piece."""
    total = digest.agg(F.sum("size").alias("size"), F.count("*").alias("rows")).first()
    all_bytes = int(total["size"] or 0)
    share = max(all_bytes / shards, 1.0)
    groups = ws.keep(
        digest.groupBy("group").agg(F.sum("size").alias("size"), F.count("*").alias("rows")),
        "groups",
    )
    pieces = F.when(F.col("size") > share, F.ceil(F.col("size") / share * PIECE)).otherwise(1)
    large = F.col("size") * CELLS > all_bytes
    planned = groups.select(
        "group",
        pieces.cast("int").alias("pieces"),
        F.when(~large, F.pmod("group", F.lit(CELLS))).alias("cell"),
    )
    planned = ws.keep(planned, "planned")
    # the group key of a large group, the cell of the small ones
    named = digest.join(planned, "group").select(
        F.coalesce("cell", "group").alias("unit"),
        F.col("cell").isNotNull().alias("merged"),
        _piece(),
        "size",
        F.coalesce("words", F.lit(0)).alias("words"),
    )
    units = (
        named.groupBy("unit", "merged", "piece")
        .agg(F.sum("size").alias("size"), F.sum("words").alias("words"), F.count("*").alias("rows"))
        .orderBy("unit", "merged", "piece")
        .toPandas()  # bounded: CELLS cells, at most CELLS large groups, SHARDS * PIECE pieces
    )
    vectors = units[["size", "words", "rows"]].to_numpy(float)
    capacity = np.maximum(vectors.sum(axis=0) / shards, 1.0)
    units["shard"] = pack(vectors / capacity, shards) if len(units) else []
    rows = [
        (int(u), bool(m), int(p), int(s))
        for u, m, p, s in zip(units["unit"], units["merged"], units["piece"], units["shard"])
    ]
    spark = digest.sparkSession
    shard_of = spark.createDataFrame(rows, "unit long, merged boolean, piece int, shard int")
    split = planned.select(
        "group",
        F.coalesce("cell", "group").alias("unit"),
        F.col("cell").isNotNull().alias("merged"),
        "pieces",
        F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"),
    )
    placed = split.join(F.broadcast(shard_of), ["unit", "merged", "piece"])
    return planned.select("group", "pieces"), ws.keep(
        placed.select("group", "piece", "shard"), "placed"
    )


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    ws = Workspace(docs.sparkSession, "sharding")
    digest = ws.keep(_digest(docs), "digest")
    planned, placed = place(ws, digest, shards)
    located = (
        digest.join(planned, "group")
        .select("doc_id", "size", "text_crc32", "group", _piece())
        .join(placed, ["group", "piece"])
    )
    located = ws.keep(located.select("doc_id", "size", "text_crc32", "shard"), "located")
    buckets = max(1, -(-located.count() // (shards * SLOT_ROWS)))
    # a row number breaks ties of full copies, which may be any number of rows
    spread = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(buckets))
    numbered = ws.keep(located.withColumn("bucket", spread.cast("int")), "bucketed")
    counts = numbered.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        F.col("shard").alias("s"),
        F.col("bucket").alias("b"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    ranked = numbered.withColumn("rank", F.row_number().over(inside) - 1)
    joined = ranked.join(offsets, (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b")))
    return joined.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("offset") + F.col("rank")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
