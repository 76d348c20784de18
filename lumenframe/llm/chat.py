"""Reply trees as conversations, in DataFrame operations only.

Self-joins that double the distance covered give every message its depth and the score of its path;
the branches of a tree are ranked by score, the chosen leaves are followed up to the root by the same
doubled pointers, and each chosen path is formatted as one conversation with a loss mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.common import stash
from lumenframe.llm.secrets import let

#: The template: ``<s>[role] text</s>`` per turn, joined by line feeds.  Its marks all begin with one
#: of ``< > [ ]``; inside roles and texts these and ``&`` are written as the names beside them.
NAMES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&lb;"), ("]", "&rb;"))
TURN = r"<s>\[([^<>\[\]]*)\] ([^<>\[\]]*)</s>"


def escape(text: Column) -> Column:
    for char, name in NAMES:
        text = F.replace(text, F.lit(char), F.lit(name))
    return text


def unescape(text: Column) -> Column:
    for char, name in reversed(NAMES):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def branches(messages: DataFrame, top: int = 1) -> DataFrame:
    """``tree``, ``leaf``, ``node``, ``depth`` of the ``top`` root-to-leaf paths of each tree.

    ``messages`` has ``tree``, ``node`` (unique in the tree), ``parent`` (NULL at a root), ``score``.
    A path's score is the sum along it (NULL: 0); ties go to the longer path, then to the smaller
    leaf.  A parent that is not there makes a root; messages on a cycle have no root and no path.
    """
    known = messages.select("tree", "node")
    linked = messages.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"))
    up = known.select(F.col("tree").alias("t"), F.col("node").alias("anc"))
    state = linked.join(up, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("anc")), "left")
    state = stash(state.select("tree", "node", "anc", "total", F.lit(1).cast("long").alias("depth")), "tree-0")
    rounds = max(1, state.count()).bit_length()
    done, open_, jumps = state.where("anc IS NULL"), state.where("anc IS NOT NULL"), []
    # only messages that have not reached their root yet take part in a round
    while len(jumps) <= rounds and not open_.isEmpty():
        jumps.append(open_.select("tree", "node", "anc"))
        above = open_.unionByName(done).select(
            F.col("tree").alias("t"), F.col("node").alias("n"), F.col("anc").alias("next"),
            F.col("total").alias("more"), F.col("depth").alias("steps"),
        )
        joined = open_.join(above, F.col("tree").eqNullSafe(F.col("t")) & (F.col("anc") == F.col("n")))
        moved = stash(
            joined.select(
                "tree", "node", F.col("next").alias("anc"),
                (F.col("total") + F.col("more")).alias("total"), (F.col("depth") + F.col("steps")).alias("depth"),
            ),
            f"tree-{len(jumps)}",
        )
        done, open_ = done.unionByName(moved.where("anc IS NULL")), moved.where("anc IS NOT NULL")
    parents = messages.where("parent IS NOT NULL").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaves = done.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("p")), "left_anti")
    best = Window.partitionBy("tree").orderBy(F.col("total").desc(), F.col("depth").desc(), "node")
    chosen = leaves.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)
    path = chosen.select("tree", F.col("node").alias("leaf"), "node")
    for jump in jumps:
        far = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"), "anc")
        higher = path.join(far, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n")))
        # written each time: the plan would double with every level
        path = stash(path.unionByName(higher.select("tree", "leaf", F.col("anc").alias("node"))), "tree-path")
    depths = done.select(F.col("tree").alias("t"), F.col("node").alias("n"), "depth")
    return path.join(depths, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("n"))).select("tree", "leaf", "node", "depth")


def format_paths(messages: DataFrame, top: int = 1, learn: str = "assistant") -> DataFrame:
    """``tree``, ``leaf``, ``formatted``, ``loss``: one conversation per chosen path.

    ``loss`` lists (start, size) in code points of each text whose role is ``learn``, in order.
    NULL roles and texts are empty.  The result of an empty table is empty.
    """
    path = branches(messages, top).withColumnsRenamed({"tree": "__t", "node": "__n"})
    turns = path.join(messages, F.col("__t").eqNullSafe(F.col("tree")) & (F.col("__n") == F.col("node")))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit("<s>["), escape(role), F.lit("] "))
    turns = turns.select("tree", "leaf", "depth", (role == learn).alias("learn"), head.alias("head"), escape(text).alias("body"))
    turns = turns.withColumn("turn", F.concat("head", "body", F.lit("</s>")))
    w = Window.partitionBy("tree", "leaf").orderBy("depth")
    ahead = F.sum(F.length("turn") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(ahead, F.lit(0)) + F.length("head")
    turns = turns.withColumn("loss", F.when(F.col("learn"), F.struct(start.cast("long").alias("start"), F.length("body").cast("long").alias("size"))))
    whole = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct("depth", "turn", "loss"))).alias("turns"))
    return whole.select(
        "tree",
        "leaf",
        F.array_join("turns.turn", "\n").alias("formatted"),
        F.filter("turns.loss", lambda x: x.isNotNull()).alias("loss"),
    )


def chains(rows: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Conversations stored as turns, as trees of one branch: a turn replies to the one before it.

    Turns go by ``turn`` (NULL last), then role and text; repeated turns stay.  A NULL ``conv`` is a
    conversation too.
    """
    w = Window.partitionBy("tree").orderBy(F.col("at").asc_nulls_last(), "role", "text")
    got = rows.select(F.col(conv).alias("tree"), F.col(turn).alias("at"), "role", "text")
    got = got.withColumn("node", F.row_number().over(w).cast("long"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return got.select("tree", "node", parent.alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def read_back(formatted: Column, loss: Column) -> dict[str, Column]:
    """Digest columns read from a formatted conversation alone, and from its mask."""

    def column(k: int) -> Column:
        return F.regexp_extract_all(formatted, F.lit(TURN), F.lit(k))

    turns = F.transform(
        F.arrays_zip(column(1).alias("role"), column(2).alias("text")),
        lambda t: F.concat(unescape(t["role"]), F.lit("\n"), unescape(t["text"]), F.lit("\n")),
    )
    learned = F.array_join(
        F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["size"].cast("int")))), ""
    )
    return {
        "n_turns": F.size(column(1)).cast("long"),
        "turns_sha256": F.sha2(F.array_join(turns, ""), 256),
        "loss_chars": let(learned, F.length).cast("long"),
        "loss_sha256": F.sha2(learned, 256),
        "formatted_chars": F.length(formatted).cast("long"),
    }
