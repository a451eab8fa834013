"""Reply trees to training conversations, in DataFrame functions only.

Ancestors are found by doubling self-joins: after k rounds every message knows the one 2^k above it, so a path of any
depth takes a logarithm of its length in rounds. Branches are ranked by the sum of their messages' scores, and each
chosen root-to-leaf path becomes one conversation.

Template: ``### role: text </turn>`` and a newline for each turn. In texts ``\\``, ``#`` and ``<`` get a backslash before
them, in roles ``:`` too, so the marks never occur inside and everything can be read back.

Defined results: null text or role is empty; a message whose parent is missing is a root; ties between branches go to
the least leaf; of messages that repeat a number in their tree one stands (``once``), while repeated turns of a flat
conversation all count and follow each other by role and text; replies in a circle raise an error; an empty table gives
no rows; a null tree is a tree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Cut

END = " </turn>\n"


def escape(text: Column, also: str = "") -> Column:
    return F.regexp_replace(text, rf"([\\#<{also}])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\#<:])", "$1")


def linear(conversations: DataFrame) -> DataFrame:
    """Flat conversations as trees of one branch: (tree, msg, parent, role, text, score)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.row_number().over(order).alias("msg"))
    return rows.select(F.col("conv_id").alias("tree"), "msg", F.when(F.col("msg") > 1, F.col("msg") - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score"))


def once(messages: DataFrame) -> DataFrame:
    """One row for each (tree, msg): of repeated ones the least parent, then role, then text, then score stands; null is least."""
    rest = [c for c in ("parent", "role", "text", "score") if c in messages.columns]
    best = F.min(F.struct(*[F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("value")).alias(c) for c in rest])).alias("best")
    return messages.groupBy("tree", "msg").agg(best).select("tree", "msg", *[F.col(f"best.{c}.value").alias(c) for c in rest])


def best_paths(messages: DataFrame, per_tree: int = 1, unique: bool = False) -> DataFrame:
    """(tree, leaf, branch, msg, up_by): the messages of the ``per_tree`` best branches of each tree, up_by levels above the leaf; branch is the rank. ``unique``: no (tree, msg) repeats."""
    same = lambda x, y: F.col(f"{x}.tree").eqNullSafe(F.col(f"{y}.tree"))
    messages = messages if unique else once(messages)
    nodes = messages.select("tree", "msg", F.col("parent").alias("up"), F.coalesce("score", F.lit(0.0)).alias("total"))
    moving, done, levels = Cut(nodes), [], []
    rounds = moving.df.count().bit_length()
    while True:
        # only messages below a root climb on; the others are set aside, and still answer for those that reach them
        now = moving.df.select("tree", "msg", "up", "total")
        done.append(now.where(F.col("up").isNull()))
        climbing = now.where(F.col("up").isNotNull())
        if climbing.isEmpty():
            break
        if len(levels) > rounds:
            # no path is longer than the table, and each round doubles what a message knows of its own
            raise ValueError("replies form a cycle")
        # total covers the messages from this one to just below ``up``; a missing ``up`` ends the path there
        known = reduce(DataFrame.unionByName, done, climbing)
        step = climbing.alias("a").join(known.alias("b"), same("a", "b") & (F.col("a.up") == F.col("b.msg")), "left")
        moving = Cut(step.select("a.tree", "a.msg", F.when(F.col("b.msg").isNotNull(), F.col("a.up")).alias("here"), F.col("b.up").alias("up"), (F.col("a.total") + F.coalesce("b.total", F.lit(0.0))).alias("total")))
        levels.append(moving.df.where(F.col("here").isNotNull()).select("tree", "msg", "here"))
    state = reduce(DataFrame.unionByName, done)
    replied = nodes.where(F.col("up").isNotNull()).select("tree", F.col("up").alias("msg"), F.lit(None).cast("double").alias("total"), F.lit(True).alias("answered"))
    ends = state.select("tree", "msg", "total", F.lit(False).alias("answered")).unionByName(replied).groupBy("tree", "msg").agg(F.max("total").alias("total"), F.max("answered").alias("answered"))
    leaves = ends.where(~F.col("answered"))
    if per_tree == 1:
        top = leaves.groupBy("tree").agg(F.min_by("msg", F.struct((-F.col("total")).alias("t"), "msg")).alias("leaf")).withColumn("branch", F.lit(1))
    else:
        rank = Window.partitionBy("tree").orderBy(F.desc("total"), "msg")
        top = leaves.withColumn("branch", F.row_number().over(rank)).where(F.col("branch") <= per_tree).select("tree", F.col("msg").alias("leaf"), "branch")
    paths = top.select("tree", "leaf", "branch", F.col("leaf").alias("msg"), F.lit(0).alias("up_by"))
    for k in range(len(levels) - 1, -1, -1):
        above = paths.alias("p").join(levels[k].alias("l"), same("p", "l") & (F.col("p.msg") == F.col("l.msg"))).select("p.tree", "p.leaf", "p.branch", F.col("l.here").alias("msg"), (F.col("p.up_by") + (1 << k)).alias("up_by"))
        paths = Cut(paths.unionByName(above)).df
    return paths.select("tree", "leaf", "branch", "msg", "up_by")


def format_paths(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """(tree, branch, formatted, loss): one conversation per path, of messages that don't repeat; loss is the spans (start, len), in code points, of the assistant's escaped texts."""
    joined = paths.alias("p").join(messages.alias("m"), F.col("p.tree").eqNullSafe(F.col("m.tree")) & (F.col("p.msg") == F.col("m.msg")))
    turn = F.struct((-F.col("up_by")).alias("at"), escape(F.coalesce("role", F.lit("")), ":").alias("role"), escape(F.coalesce("text", F.lit(""))).alias("text"), F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("own"))
    turns = joined.select("p.tree", "p.branch", turn.alias("t")).groupBy("tree", "branch").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = lambda t: F.concat(F.lit("### "), t["role"], F.lit(": "))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(head(t), t["text"], F.lit(END))), "")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,len:int>>").alias("spans"))
    size = lambda t: F.char_length(t["text"])
    step = lambda acc, t: F.struct((acc["at"] + F.char_length(head(t)) + size(t) + len(END)).alias("at"), F.when(t["own"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.char_length(head(t))).alias("start"), size(t).alias("len"))))).otherwise(acc["spans"]).alias("spans"))
    return turns.select("tree", "branch", whole.alias("formatted"), F.aggregate("turns", start, step, lambda acc: acc["spans"]).alias("loss"))


def parsed(formatted: Column | str) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    pieces = F.filter(F.split(formatted, END, -1), lambda p: p != "")
    part = lambda p, k: unescape(F.regexp_extract(p, r"(?s)^### ((?:[^\\:]|\\.)*+): (.*)$", k))
    return F.transform(pieces, lambda p: F.struct(part(p, 1).alias("role"), part(p, 2).alias("text")))


def under_loss(formatted: Column | str, spans: Column | str) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    text = F.col(formatted) if isinstance(formatted, str) else formatted
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(text, s["start"] + 1, s["len"]))), "")


def trees(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """(tree, branch, formatted, loss) of the best branches of reply trees (tree, msg, parent, role, text, score)."""
    stored = Cut(once(messages.select("tree", "msg", "parent", "role", "text", "score"))).df
    return format_paths(stored, best_paths(stored, per_tree, unique=True))


def conversations(table: DataFrame) -> DataFrame:
    """(tree, branch, formatted, loss) for flat conversations."""
    messages = Cut(linear(table)).df
    return format_paths(messages, best_paths(messages, unique=True))
