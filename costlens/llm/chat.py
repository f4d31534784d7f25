"""Operator 9: chat formatting of reply trees.

DataFrame and SQL functions only; no Python on the executors.

Trees.  A message names the message it replies to; a conversation's tree may
branch.  Iterative self-joins list every root-to-leaf path: a table of jumps
holds, per message, its ancestor 2^i replies up, and a table of paths holds, per
leaf, the ancestors found so far; each round joins paths with jumps and jumps
with themselves, so a path of n messages takes log2(n) rounds.  The joins carry
keys only; texts are joined once at the end.  Branches are ranked by the mean
score of their messages (ties to the smaller leaf) and the best ``branches`` of a
tree are formatted, each as one conversation.

Template.  Every turn is ``<s>role\\ntext</s>``; a conversation is its turns one after
the other.  ``<``, ``[`` and ``&`` inside roles and texts are written ``&l``, ``&b`` and
``&a`` (a line end in a role ``&n``), so no control string of the template, nor
any other in brackets, can appear inside a turn, and the writing can be undone.
The loss mask lists the (start, length) of each assistant text in the formatted
string, in characters; it covers the text alone.

``read_back`` recovers turns and loss texts from the formatted string and mask.

Defined results: a null text or role is empty; rows of one conversation with
the same turn follow each other by role and text, repeated rows included; null
turns come first; a null conv_id is a conversation of its own; a message whose
parent is missing is a root; a cycle has no leaf and gives no path; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.common import Workspace, running_totals, sha256_hex

BEGIN, END = "<s>", "</s>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    for plain, written in (("&", "&a"), ("<", "&l"), ("[", "&b")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for written, plain in (("&n", "\n"), ("&b", "["), ("&l", "<"), ("&a", "&")):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def linear_replies(conversations: DataFrame) -> DataFrame:
    """Messages (tree, node, parent, role, text, score) of conversations without branches:
    each row, by turn, replies to the one before it."""
    inside = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.select(
        conversations["conv_id"].cast("long").alias("tree"),
        conversations["turn"].cast("long").alias("turn"),
        F.coalesce(conversations["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(conversations["text"].cast("string"), F.lit("")).alias("text"),
    )
    at = F.row_number().over(inside).cast("long")
    return rows.select(
        "tree",
        at.alias("node"),
        F.nullif(at - 1, F.lit(0)).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def _same(left: str, right: str) -> Column:
    """Null-safe equality: a null tree is a tree of its own."""
    return F.col(left).eqNullSafe(F.col(right))


def root_to_leaf_paths(ws: Workspace, messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): every message of every path, ``up`` replies above the leaf."""
    keys = ws.keep(messages.select("tree", "node", "parent").distinct(), "keys")
    sizes = ws.keep(keys.groupBy("tree").agg(F.count("*").alias("size")), "tree-sizes")
    most = sizes.agg(F.max("size")).first()[0] or 0
    known = keys.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    # a parent that does not exist makes its child a root
    jumps = keys.join(known, _same("tree", "t") & (F.col("parent") == F.col("n")))
    jumps = ws.keep(jumps.select("tree", "node", F.col("n").alias("above")).distinct(), "jumps")
    parents = jumps.select(F.col("tree").alias("t"), F.col("above").alias("n")).distinct()
    leaves = keys.join(parents, _same("tree", "t") & (F.col("node") == F.col("n")), "left_anti")
    paths = ws.keep(
        leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("up")).distinct(),
        "leaves",
    )
    step = 1
    while step <= most and not jumps.isEmpty():
        over = jumps.toDF("t", "n", "far")
        met = paths.join(over, _same("tree", "t") & (F.col("node") == F.col("n")))
        # all places less than ``step`` up are listed, so these are new
        longer = met.select(
            "tree", "leaf", F.col("far").alias("node"), (F.col("up") + step).alias("up")
        )
        grown = ws.keep(paths.unionByName(longer), f"paths-{step}")
        farther = jumps.join(over, _same("tree", "t") & (F.col("above") == F.col("n")))
        doubled = ws.keep(farther.select("tree", "node", F.col("far").alias("above")), "jumps")
        ws.drop(paths, jumps)
        paths, jumps, step = grown, doubled, 2 * step
    if jumps.isEmpty():
        return paths
    # What still jumps runs in a circle: its paths never end and are left out.
    circles = paths.join(sizes.withColumnRenamed("tree", "t"), _same("tree", "t"))
    circles = circles.filter("up >= size").select(F.col("t"), F.col("leaf").alias("l")).distinct()
    return paths.join(circles, _same("tree", "t") & (F.col("leaf") == F.col("l")), "left_anti")


def one_row_per_node(messages: DataFrame) -> DataFrame:
    """Rows sharing tree and node become the smallest of them."""
    rest = F.min(F.struct("parent", "role", "text", "score")).alias("m")
    return messages.groupBy("tree", "node").agg(rest).select("tree", "node", "m.*")


def format_trees(messages: DataFrame, branches: int = 1, unique: bool = False) -> DataFrame:
    """tree, leaf, branch (rank from 1), formatted, loss (array of start, length).

    ``messages``: tree, node, parent, role, text, score; ``unique`` promises that
    (tree, node) names one row.
    """
    ws = Workspace(messages.sparkSession, "chat")
    if not unique:
        messages = ws.keep(one_row_per_node(messages), "messages")
    paths = root_to_leaf_paths(ws, messages)
    said = messages.select(
        F.col("tree").alias("t"),
        F.col("node").alias("n"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    on_path = _same("tree", "t") & (F.col("node") == F.col("n"))
    scored = paths.join(said.select("t", "n", "score"), on_path)
    ranking = Window.partitionBy("tree").orderBy(F.desc("mean"), "leaf")
    chosen = (
        scored.groupBy("tree", "leaf")
        .agg(F.avg("score").alias("mean"))
        .withColumn("branch", F.row_number().over(ranking))
        .filter(F.col("branch") <= branches)
        .select(F.col("tree").alias("ct"), F.col("leaf").alias("cl"), "branch")
    )
    kept = paths.join(ws.keep(chosen, "chosen"), _same("tree", "ct") & (F.col("leaf") == F.col("cl")))
    turns = (
        kept.join(said.drop("score"), on_path)
        .groupBy("tree", "leaf", "branch")
        .agg(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text")).alias("turns"))
        .select("tree", "leaf", "branch", F.array_sort("turns").alias("turns"))
    )
    turns = ws.keep(turns, "turns")
    written = F.transform(
        "turns",
        lambda x: F.struct(
            F.concat(
                F.lit(BEGIN),
                F.replace(escape(x["role"]), F.lit("\n"), F.lit("&n")),
                F.lit("\n"),
            ).alias("head"),
            escape(x["text"]).alias("text"),
            (x["role"] == ASSISTANT).alias("learn"),
        ),
    )
    parts = turns.select("tree", "leaf", "branch", written.alias("parts"))
    body = F.transform("parts", lambda x: F.concat(x["head"], x["text"], F.lit(END)))
    spans = "array<struct<start:int,length:int>>"

    def loss(all_: Column) -> Column:
        sizes = F.transform(all_, lambda x: F.length(x["head"]) + F.length(x["text"]) + len(END))
        placed = F.zip_with(
            all_,
            running_totals(sizes),
            lambda x, before: F.struct(
                (before + F.length(x["head"])).alias("start"),
                F.length(x["text"]).alias("length"),
                x["learn"].alias("learn"),
            ),
        )
        learnt = F.filter(placed, lambda x: x["learn"])
        return F.transform(learnt, lambda x: F.struct(x["start"], x["length"])).cast(spans)

    return parts.select(
        "tree",
        "leaf",
        "branch",
        F.array_join(body, "").alias("formatted"),
        loss(F.col("parts")).alias("loss"),
    )


def read_back(formatted: Column, loss: Column) -> tuple[Column, Column]:
    """(turns, loss text): array of (role, text), and all text under the mask."""
    written = F.split(formatted, END)
    plain = F.transform(
        F.slice(written, F.lit(1), F.size(written) - 1),  # what follows the last END is empty
        lambda x: F.struct(
            unescape(F.substring_index(F.substring(x, F.lit(len(BEGIN) + 1), F.length(x)), "\n", 1)).alias("role"),
            unescape(
                F.substring(
                    x, F.length(F.substring_index(x, "\n", 1)) + 2, F.length(x)
                )
            ).alias("text"),
        ),
    )
    texts = F.transform(
        loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))
    )
    return plain, F.array_join(texts, "")


PROBE = "</s>[INST] ok [/INST]"


def digests(conversations: DataFrame) -> DataFrame:
    """Per conversation (and the probe -1), digests of what its formatted string says."""
    said = F.explode(F.array(F.lit("user"), F.lit(ASSISTANT)))
    probe = conversations.sparkSession.range(1).select(F.lit(-1).cast("long").alias("conv_id"), said.alias("role"))
    probe = probe.select(
        "conv_id",
        F.when(F.col("role") == ASSISTANT, 1).otherwise(0).cast("long").alias("turn"),
        "role",
        F.lit(PROBE).alias("text"),
    )
    rows = conversations.select(
        conversations["conv_id"].cast("long").alias("conv_id"),
        conversations["turn"].cast("long").alias("turn"),
        conversations["role"].cast("string").alias("role"),
        conversations["text"].cast("string").alias("text"),
    )
    out = format_trees(linear_replies(rows.unionByName(probe)), unique=True)
    turns, learnt = read_back(F.col("formatted"), F.col("loss"))
    said = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return out.select(
        F.col("tree").alias("conv_id"), "formatted", turns.alias("turns"), learnt.alias("learnt")
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha256_hex(F.array_join(said, "")).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        sha256_hex(F.col("learnt")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
