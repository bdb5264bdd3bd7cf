"""Chat formatting of reply trees (built-in functions only).

Messages are nodes of reply trees. Iterative self-joins over (tree, node) double the
distance each round: after round k every node knows its 2^k-th ancestor, its root, its
depth and the sum of the scores on the way, so a chain of n messages takes log2(n) rounds.
Branches (root-to-leaf paths) are ranked within their root by mean score, then depth, then node; all of them, the
best `branches`, or those of at least `min_score` become conversations, one a path. Their members are enumerated by the
same tables from the longest jump to the shortest, joined with their texts and put together in order.

The template marks turns as <turn>ROLE<say>TEXT</turn>. In roles and texts a backslash
becomes \\b and < becomes \\l, so control strings cannot occur inside and the original
comes back exactly (first \\l, then \\b). The loss mask is a list of code point spans
(start, length) of the assistants' texts.

Edge cases: NULL role or text is empty; a missing parent makes a node a root; repeated nodes
count once (the least of differing rows); nodes on or below a cycle have no root and
are left out; an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areabook.llm.common import left_join, stager
from areabook.operators.rank import rank_by

TURN, SAY, END = "<turn>", "<say>", "</turn>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def branches(nodes: DataFrame, st) -> tuple[DataFrame, list[DataFrame]]:
    """((tree, node, root, depth, score) of every node that has a root, [(tree, node, up) a jump of 2^k])."""
    ids = (nodes.groupBy("tree", "node").agg(F.min(F.struct("parent", "score")).alias("x"))
           .select("tree", "node", F.col("x.parent").alias("parent"), F.coalesce("x.score", F.lit(0.0)).alias("score")))
    ids = st.stage(ids, "nodes")
    there = ids.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    linked = left_join(ids, there, ["tree", "parent"])
    up = F.when(F.col("known"), F.col("parent"))
    first = st.stage(linked.select(
        "tree", "node", up.alias("up"), F.when(up.isNull(), F.col("node")).alias("root"),
        F.when(up.isNull(), 0).otherwise(1).cast("long").alias("depth"), "score"), "jump0")
    jumps, placed = [], [first.filter("up is null")]
    open_, rounds = first.filter("up is not null"), max(1, math.ceil(math.log2(max(2, ids.count())))) + 1
    for k in range(rounds):
        if open_.isEmpty():
            break
        jumps.append(open_.select("tree", "node", "up"))
        # only nodes that have not reached their root go on; all others are looked up
        seen = reduce(DataFrame.unionByName, placed, open_)
        far = seen.select(F.col("tree").alias("f_tree"), F.col("node").alias("f_node"), F.col("up").alias("f_up"),
                          F.col("root").alias("f_root"), F.col("depth").alias("f_depth"), F.col("score").alias("f_score"))
        met = open_.join(far, open_["tree"].eqNullSafe(far["f_tree"]) & (open_["up"] == far["f_node"]))
        nxt = st.stage(met.select("tree", "node", F.col("f_up").alias("up"), F.col("f_root").alias("root"),
                                  (F.col("depth") + F.col("f_depth")).alias("depth"),
                                  (F.col("score") + F.col("f_score")).alias("score")), f"jump{k + 1}")
        placed.append(nxt.filter("up is null"))
        open_ = nxt.filter("up is not null")
    return reduce(DataFrame.unionByName, placed).drop("up"), jumps


def paths(nodes: DataFrame, st, keep: int | None = None, min_score: float | None = None) -> DataFrame:
    """(tree, root, rank, node, depth, score): the members of every chosen branch; score is the branch's mean."""
    placed, jumps = branches(nodes, st)
    inner = nodes.select("tree", F.col("parent").alias("node")).distinct().withColumn("inner", F.lit(True))
    leaves = left_join(placed, inner, ["tree", "node"]).filter("inner is null")
    leaves = st.stage(leaves.select("tree", "root", "node", "depth", (F.col("score") / (F.col("depth") + 1)).alias("mean")), "leaves")
    # an only leaf is the first; the leaves of other roots are ranked exactly and without one task a root
    n = leaves.groupBy("tree", "root").agg(F.count("*").alias("n"))
    counted = left_join(leaves, n, ["tree", "root"])
    chosen = counted.filter("n = 1").select("tree", "root", F.lit(1).cast("long").alias("rank"), "node", "mean")
    several = st.stage(counted.filter("n > 1").withColumn("at", F.struct("mean", "depth", "node")), "branches")
    if not several.isEmpty():
        ranked = rank_by(several, "at", ["tree", "root"], descending=True, out="rank", stager=st)
        chosen = chosen.unionByName(ranked.select("tree", "root", "rank", "node", "mean"))
    if keep is not None:
        chosen = chosen.filter(F.col("rank") <= keep)
    if min_score is not None:
        chosen = chosen.filter(F.col("mean") >= min_score)
    members = st.stage(chosen.withColumnRenamed("mean", "score"), "chosen")
    for k in reversed(range(len(jumps))):
        hop = jumps[k].select(F.col("tree").alias("h_tree"), F.col("node").alias("h_node"), "up")
        more = members.join(hop, members["tree"].eqNullSafe(hop["h_tree"]) & (members["node"] == hop["h_node"])) \
            .select("tree", "root", "rank", F.col("up").alias("node"), "score")
        members = st.stage(members.unionByName(more), f"members{k}")
    return left_join(members, placed.select("tree", "node", "depth"), ["tree", "node"])


def format_trees(nodes: DataFrame, loss_role: str = LOSS_ROLE, keep: int | None = None, min_score: float | None = None) -> DataFrame:
    """nodes(tree, node, parent, role, text, score) -> (tree, root, rank, score, n_turns, formatted, loss) a chosen path;
    `keep` is how many paths of a root are, `min_score` from which mean score on (default: all)."""
    st = stager(nodes.sparkSession, "chat")
    nodes = st.stage(nodes.select("tree", "node", "parent", "role", "text", F.col("score").cast("double").alias("score")), "messages")
    path = paths(nodes, st, keep, min_score)
    said = nodes.groupBy("tree", "node").agg(F.min(F.struct("parent", "score", "role", "text")).alias("x")) \
        .select("tree", "node", "x.role", "x.text")
    turns = left_join(path, said, ["tree", "node"]).select(
        "tree", "root", "rank", "score", "depth", (F.col("role") == loss_role).alias("scored"),
        F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAY)).alias("head"), escape(F.col("text")).alias("body"))
    size = F.length("head") + F.length("body") + F.lit(len(END))
    before = Window.partitionBy("tree", "root", "rank").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    row = F.struct("depth", F.concat("head", "body", F.lit(END)).alias("turn"),
                   F.coalesce("scored", F.lit(False)).alias("scored"), "start", F.length("body").alias("len"))
    return (turns.groupBy("tree", "root", "rank").agg(F.array_sort(F.collect_list(row)).alias("t"), F.first("score").alias("score"))
            .select("tree", "root", "rank", "score", F.size("t").cast("long").alias("n_turns"),
                    F.array_join(F.transform("t", lambda x: x["turn"]), "").alias("formatted"),
                    F.transform(F.filter("t", lambda x: x["scored"]),
                                lambda x: F.struct(x["start"].cast("int").alias("start"), x["len"].alias("len"))).alias("loss")))


def read_back(chats: DataFrame) -> DataFrame:
    """Parses formatted conversations: adds turns (array of role, text) and loss_text (array, unescaped)."""
    pieces = F.filter(F.split("formatted", END), lambda x: x != "")
    turn = lambda x: F.struct(
        unescape(F.substring(F.substring_index(x, SAY, 1), F.lit(len(TURN) + 1), F.length(x))).alias("role"),
        unescape(F.substring_index(x, SAY, -1)).alias("text"))
    mask = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["len"])))
    return chats.withColumn("turns", F.transform(pieces, turn)).withColumn("loss_text", mask)
