"""Chat formatting of reply trees, with DataFrame functions only.

A message names its parent. Root-to-leaf paths are enumerated by self-joins that double the reach of every leaf, so a chain
of n messages takes log2(n) joins. Paths of a tree are ranked by the mean score of their messages, and each chosen path
becomes one conversation: the formatted string and the spans of it that the loss covers.

Turns are ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line feed. In roles and texts one word joiner (U+2060) is put
before the bar of every ``<|``, also where joiners stand there already; ``read_back`` takes exactly one out again.

Defined results: null roles and texts are empty; a parent that does not exist makes a root; messages of a cycle, and
branches that only lead to one, have no root and belong to no conversation; of rows that share an id the first by parent,
role and text counts; a message without an id is a root without replies; an empty table gives no conversation; other
columns are left out. A conversation is one string, so its turns meet in one row; trees are spread by their messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import stored

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
JOINER = "\u2060"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\u2060*)\|", f"<$1{JOINER}|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\u2060*)\u2060\|", "<$1|")


def clean_messages(messages: DataFrame) -> DataFrame:
    """One stored row per message id; a parent that is no message is null."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    content = F.to_json(F.struct("tree_id", "role", "text"))
    rows = messages.select(
        "tree_id",
        F.coalesce(F.col("message_id"), F.concat(F.lit("?"), F.md5(content))).alias("message_id"),
        F.when(F.col("message_id").isNotNull(), F.col("parent_id")).alias("parent_id"),
        text("role").alias("role"),
        text("text").alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    first = F.min(F.struct("parent_id", "role", "text", "tree_id", "score")).alias("m")
    rows = rows.groupBy("message_id").agg(first).select("message_id", "m.*")
    rows = stored(rows, "chat-messages")
    known = rows.select(F.col("message_id").alias("parent_id"), F.lit(True).alias("known"))
    parents = rows.filter("parent_id is not null").select("message_id", "parent_id")
    parents = parents.join(known, "parent_id").select("message_id", "parent_id")
    rows = rows.drop("parent_id").join(parents, "message_id", "left")
    return stored(rows, "chat-linked")


def reply_paths(messages: DataFrame) -> DataFrame:
    """``leaf_id``, ``message_id``, ``up`` (steps from the leaf) for all messages on the way from each leaf to its root."""
    links = messages.select("message_id", "parent_id")
    jumps = stored(
        links.filter("parent_id is not null").select(
            F.col("message_id").alias("low"), F.col("parent_id").alias("high")
        ),
        "chat-jumps",
    )
    answered = jumps.select(F.col("high").alias("message_id")).distinct()
    leaves = links.join(answered, "message_id", "left_anti")
    reach = stored(
        leaves.select(
            F.col("message_id").alias("leaf_id"), "message_id", F.lit(0).cast("long").alias("up")
        ),
        "chat-reach",
    )
    most = messages.count()
    step, fresh, parts = 1, reach, [reach]
    # All messages within ``step`` steps of a leaf are known; a jump spans ``step`` steps.
    while step <= most and not jumps.isEmpty():
        known = parts[0]
        for part in parts[1:]:
            known = known.unionByName(part)
        fresh = known.join(jumps, known["message_id"] == jumps["low"]).select(
            "leaf_id", F.col("high").alias("message_id"), (F.col("up") + step).alias("up")
        )
        fresh = stored(fresh, "chat-reach")
        if fresh.isEmpty():
            break
        parts.append(fresh)
        further = jumps.select(F.col("low").alias("high"), F.col("high").alias("top"))
        jumps = stored(jumps.join(further, "high").select("low", F.col("top").alias("high")), "chat-jumps")
        step *= 2
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _formatted(paths: DataFrame) -> DataFrame:
    """Adds the formatted string and the loss spans to rows with an array ``turns`` of role and text."""
    head = lambda t: F.concat(F.lit(START), t["role"], F.lit(SEP))
    rows = paths.withColumn(
        "turns",
        F.transform(
            "turns",
            lambda t: F.struct(
                escaped(t["role"]).alias("role"),
                escaped(t["text"]).alias("text"),
                (t["role"] == "assistant").alias("learned"),
            ),
        ),
    )
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,size:int>>").alias("spans"))

    def add(s: Column, t: Column) -> Column:
        start = s["at"] + F.length(head(t))
        size = F.length(t["text"])
        span = F.array(F.struct(start.alias("start"), size.alias("size")))
        return F.struct(
            (start + size + len(END)).alias("at"),
            F.when(t["learned"], F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"),
        )

    pieces = F.transform("turns", lambda t: F.concat(head(t), t["text"], F.lit(END)))
    return rows.withColumns(
        {
            "formatted": F.array_join(pieces, ""),
            "loss_spans": F.aggregate("turns", state, add, lambda s: s["spans"]),
        }
    ).drop("turns")


def format_trees(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """One row per chosen path: ``tree_id``, ``leaf_id``, ``rank``, ``formatted``, ``loss_spans`` (start from 0, size).

    ``messages`` has ``tree_id``, ``message_id``, ``parent_id``, ``role``, ``text``, ``score``; ids are unique over all
    trees. ``best`` paths of each tree are chosen, all if None.
    """
    rows = clean_messages(messages)
    ranked = reply_paths(rows).join(
        rows.select("message_id", "tree_id", "score", F.col("parent_id").isNull().alias("root")),
        "message_id",
    )
    paths = ranked.groupBy("leaf_id").agg(
        F.max("tree_id").alias("tree_id"), F.avg("score").alias("score"), F.max("root").alias("root")
    )
    order = Window.partitionBy("tree_id").orderBy(F.desc("score"), "leaf_id")
    paths = paths.filter("root").withColumn("rank", F.row_number().over(order))
    if best is not None:
        paths = paths.filter(F.col("rank") <= best)
    paths = stored(paths.select("leaf_id", "tree_id", "rank"), "chat-paths")
    turns = (
        ranked.select("leaf_id", "message_id", "up")
        .join(paths, "leaf_id")
        .join(rows.select("message_id", "role", "text"), "message_id")
        .groupBy("leaf_id", "tree_id", "rank")
        .agg(F.sort_array(F.collect_list(F.struct(F.negative("up").alias("at"), "role", "text"))).alias("turns"))
    )
    return _formatted(turns)


def read_back(conversations: DataFrame) -> DataFrame:
    """Adds what the formatted string says: ``turns`` (role, text) and ``loss_texts``, the texts under the loss mask."""
    pieces = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda p: p != "")
    parts = lambda p: F.split(F.substr(p, F.lit(len(START) + 1)), r"<\|im_sep\|>")
    return conversations.withColumns(
        {
            "turns": F.transform(
                pieces,
                lambda p: F.struct(
                    unescaped(parts(p)[0]).alias("role"), unescaped(parts(p)[1]).alias("text")
                ),
            ),
            "loss_texts": F.transform(
                "loss_spans",
                lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["size"])),
            ),
        }
    )


def chains(rows: DataFrame) -> DataFrame:
    """Turn tables as trees of one branch: every row of a ``conv_id`` replies to the row before it.

    Rows are taken by turn, role and text, so repeated turns follow each other.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    n = F.row_number().over(order)
    at = rows.select("conv_id", "role", "text", n.alias("n"))
    name = lambda i: F.concat_ws(":", tree, i.cast("string"))
    return at.select(
        F.col("conv_id").alias("tree_id"),
        name(F.col("n")).alias("message_id"),
        F.when(F.col("n") > 1, name(F.col("n") - 1)).alias("parent_id"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )
