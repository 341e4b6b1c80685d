"""Chat formatting of reply trees, in DataFrame operations only.

Messages answer one another; every path from a root to a leaf is a conversation. Iterated self-joins double the
distance that each message's pointer spans, so paths of any length take a logarithmic number of joins; scores add up
on the way. The best branches of each tree are chosen by score, the same jumps enumerate their messages, and each path
becomes one text in which every turn is marked and a loss mask that covers what the assistant says.

Control strings inside texts are escaped: a backslash before every backslash, and between "<" and "|".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from frostline.llm.common import col, stored

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
_TURN = r"(?s)^<\|im_start\|>([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n(.*)$"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _nodes(messages: DataFrame, tree: str, node: str, parent: str, score: str | None) -> DataFrame:
    own = messages.select(
        col(tree).alias("tree"), col(node).alias("node"), col(parent).alias("parent"), (col(score) if score else F.lit(0.0)).cast("double").alias("score")
    ).filter("node is not null")
    own = own.groupBy("tree", "node").agg(F.min("parent").alias("parent"), F.coalesce(F.max("score"), F.lit(0.0)).alias("score"))
    there = own.select(F.col("tree").alias("t"), F.col("node").alias("up"))
    return own.join(there, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("up")), "left").select(
        "tree", "node", "up", "score", F.lit(1).cast("long").alias("depth")
    )


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """Pointers over 1, 2, 4, ... replies; in the last, those of all messages below a root have reached the top.

    score and depth cover the messages from the own one up to, without, the one pointed to. Those that have reached the
    top are joined no more. Messages on a cycle never reach one; there are at most as many rounds as the longest path
    could need.
    """
    levels = [stored(nodes, "jumps")]
    limit = max(1, levels[0].count()).bit_length()
    while len(levels) <= limit and not levels[-1].filter("up is not null").isEmpty():
        above = levels[-1].select(
            F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("far"), F.col("score").alias("more"), F.col("depth").alias("further")
        )
        same = F.col("tree").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n"))
        doubled = levels[-1].filter("up is not null").join(above, same).select(
            "tree", "node", F.col("far").alias("up"), (F.col("score") + F.col("more")).alias("score"), (F.col("depth") + F.col("further")).alias("depth")
        )
        levels.append(stored(doubled.unionByName(levels[-1].filter("up is null")), "jumps"))
    return levels


def paths(messages: DataFrame, tree: str, node: str, parent: str, score: str | None = None, branches: int | None = 1) -> DataFrame:
    """tree, leaf, node and depth (1 at the root) of the messages on the best branches of each tree; None takes all.

    Branches rank by the mean score of their messages, then the longer, then the smaller leaf. An unknown parent makes
    a root. Messages without id take no part; nor do those on a cycle. A null tree is a tree. Without messages there are
    no paths. Other columns are not read, whatever their names.
    """
    levels = _jumps(_nodes(messages, tree, node, parent, score))
    full = levels[-1].filter("up is null")
    parents = levels[0].filter("up is not null").select(F.col("tree").alias("t"), F.col("up").alias("n")).distinct()
    leaves = full.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")), "left_anti")
    if branches is not None:
        best = Window.partitionBy("tree").orderBy(F.desc(F.col("score") / F.col("depth")), F.desc("depth"), "node")
        leaves = leaves.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= branches)
    reached = leaves.select("tree", F.col("node").alias("leaf"), "node")
    for level in reversed(levels):
        jump = level.filter("up is not null").select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        same = F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))
        both = F.filter(F.array("node", "up"), lambda x: x.isNotNull())
        reached = reached.join(jump, same, "left").select("tree", "leaf", F.explode(both).alias("node"))
    depth = full.select(F.col("tree").alias("t"), F.col("node").alias("n"), "depth")
    return reached.join(depth, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select("tree", "leaf", "node", "depth")


def conversations(
    messages: DataFrame, tree: str, node: str, parent: str, role: str = "role", text: str = "text", score: str | None = None, branches: int | None = 1
) -> DataFrame:
    """tree, leaf, formatted and loss (an array of start and stop in code points) of each chosen path.

    Null texts and roles are empty. Rows that repeat a message's id count once, with the smallest role and text. A
    conversation is one text, so it must fit one value; single texts may be of any length below that. No messages, no
    conversations.
    """
    chosen = paths(messages, tree, node, parent, score, branches)
    body = F.struct(F.coalesce(col(role), F.lit("")).alias("role"), F.coalesce(col(text), F.lit("")).alias("text"))
    said = messages.select(col(tree).alias("t"), col(node).alias("n"), body.alias("body")).filter("n is not null")
    said = said.groupBy("t", "n").agg(F.min("body").alias("body"))
    rows = chosen.join(said, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
    header = F.concat(F.lit(START), F.replace(escaped(F.col("body.role")), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    rows = rows.select(
        "tree", "leaf", "depth", header.alias("header"), escaped(F.col("body.text")).alias("shown"), (F.col("body.role") == ASSISTANT).alias("learned")
    )
    rows = rows.withColumn("turn", F.concat("header", "shown", F.lit(END + "\n")))
    so_far = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("turn")).over(so_far), F.lit(0)) + F.length("header")
    rows = rows.withColumn("span", F.when(F.col("learned"), F.struct(begin.alias("start"), (begin + F.length("shown")).alias("stop"))))
    joined = rows.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(F.struct("depth", "turn", "span"))).alias("turns"))
    spans = F.filter(F.transform("turns", lambda x: x["span"]), lambda s: s.isNotNull())
    return joined.select("tree", "leaf", F.array_join(F.transform("turns", lambda x: x["turn"]), "").alias("formatted"), spans.alias("loss"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of role and text, unescaped."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    return F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: F.struct(unescaped(F.regexp_extract(p, _TURN, 1)).alias("role"), unescaped(F.regexp_extract(p, _TURN, 2)).alias("text")),
    )


def under_mask(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped span by span."""
    cut = F.transform(loss, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))))
    return F.array_join(cut, "")


def chained(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, place, reply_to, role and text of plain conversations: each row, by turn, answers the one before.

    Rows of one turn follow by role and text; repeated rows are turns of their own. A null turn comes first, and rows
    without conversation are one conversation. An empty table gives no rows; other columns are not read.
    """
    rows = turns.select(col(conv).alias("conv"), col(turn).alias("turn"), col(role).alias("role"), col(text).alias("text"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = rows.withColumn("place", F.row_number().over(order).cast("long"))
    return rows.select("conv", "place", F.when(F.col("place") > 1, F.col("place") - 1).alias("reply_to"), "role", "text")


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from the output."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    rows = formatted.select("tree", "formatted", read_back(F.col("formatted")).alias("turns"), under_mask(F.col("formatted"), F.col("loss")).alias("learned"))
    return rows.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
