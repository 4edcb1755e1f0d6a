"""Chat formatting: reply trees into conversations, by built-in functions only.

Nodes (tree, node, parent, role, text, score) form trees by their parents.
Paths from root to leaf are found by iterative self-joins on the keys alone:
in each round a node's pointer jumps twice as far up, and takes the scores on
its way along, so a tree of depth d needs log2(d) rounds. Leaves are ranked by
the score of their path; the path of each chosen leaf is then unrolled by the
jumps of all rounds, longest first, and formatted as one conversation.

Template: ``<s>``, then the turns in order. A user's turn stands between
``[INST]`` and ``[/INST]``, a system turn between ``<<SYS>>`` and
``<</SYS>>``, an assistant's before ``</s>``, any other role's between
``<|role|>`` with its name and ``<|end|>``. Control strings inside texts and
role names are broken by a backslash after their first character, backslashes
are doubled; ``unescape`` takes that back exactly.

Defined results: null texts and roles are empty; null scores count 0; a node
whose parent is null or missing is a root; nodes on a cycle have no root and
are on no path; repeated nodes of one key must not be given (``chain`` numbers
repeated rows, so that it makes none); ties between branches go to the
smaller leaf; an empty table gives no conversation. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

#: The control strings of the template.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>", "<|text|>", "<|end|>")
_BREAK = r"\\|<(?=/?s>|</?SYS>>|\|)|\[(?=/?INST\])"
#: Opening and closing marks by role; other roles have their own.
MARKS = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": (" ", " </s>"),
}
OTHER = ("<|role|>", "<|text|>", "<|end|>")
_TURN = (
    r"(?s)<<SYS>>\n.*?\n<</SYS>>\n\n|\[INST\] .*? \[/INST\]|<\|role\|>.*?<\|end\|>| .*? </s>"
)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _BREAK, r"$0\\")


def unescape(text: Column) -> Column:
    # A doubled backslash is one; a single one broke a control string.
    return F.regexp_replace(text, r"(?s)(\\)\\|\\", "$1")


def _opening(role: Column) -> Column:
    mark = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]))
    for name, (left, _) in MARKS.items():
        mark = F.when(role == name, F.lit(left)).otherwise(mark)
    return mark


def _closing(role: Column) -> Column:
    mark = F.lit(OTHER[2])
    for name, (_, right) in MARKS.items():
        mark = F.when(role == name, F.lit(right)).otherwise(mark)
    return mark


def chain(rows: DataFrame, tree: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Nodes of conversations without branches: each row replies to the one
    before it, by turn, then role and text."""
    order = Window.partitionBy(tree).orderBy(turn, "role", "text")
    node = F.row_number().over(order).cast("long")
    return rows.select(
        F.col(tree).alias("tree"), node.alias("node"), "role", "text", F.lit(0.0).alias("score")
    ).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def _linked(left: DataFrame, right: DataFrame, here: str, there: str, how: str = "inner") -> DataFrame:
    """Joins l and r on the tree (null is a tree, too) and a node."""
    l, r = left.alias("l"), right.alias("r")
    same = F.col("l.tree").eqNullSafe(F.col("r.tree")) & (F.col(f"l.{here}") == F.col(f"r.{there}"))
    return l.join(r, same, how)


def paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """(tree, leaf, node, up): the nodes of the ``best`` highest-scored
    root-to-leaf paths of each tree; up counts from the leaf (0)."""
    keys = nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    keys = stage(keys, "chat-keys")
    known = keys.select("tree", F.col("node").alias("_known"))
    jump = _linked(keys, known, "parent", "_known", "left").select(
        "l.tree", "l.node", F.col("r._known").alias("up"), F.lit(1).cast("long").alias("length"), "l.score"
    )
    largest = keys.groupBy("tree").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    jumps = [stage(jump, "chat-jump")]
    # After the last round a pointer that is still there is on a cycle.
    for _ in range(max(1, int(largest).bit_length())):
        now = jumps[-1]
        longer = _linked(now, now, "up", "node", "left").select(
            "l.tree",
            "l.node",
            "r.up",
            (F.col("l.length") + F.coalesce("r.length", F.lit(0).cast("long"))).alias("length"),
            (F.col("l.score") + F.coalesce("r.score", F.lit(0.0))).alias("score"),
        )
        jumps.append(stage(longer, "chat-jump"))
    parents = jumps[0].filter(F.col("up").isNotNull()).select("tree", F.col("up").alias("_inner")).distinct()
    leaves = _linked(jumps[-1].filter(F.col("up").isNull()), parents, "node", "_inner", "left_anti")
    rank = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
    chosen = leaves.withColumn("_rank", F.row_number().over(rank)).filter(F.col("_rank") <= best)
    members = chosen.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    # Longest jumps first: after the jump of 2**i, every 2**i-th node is there.
    for i in reversed(range(len(jumps) - 1)):
        step = jumps[i].filter(F.col("up").isNotNull()).select("tree", "node", F.col("up").alias("_to"))
        above = _linked(members, step, "node", "node").select(
            "l.tree", "l.leaf", F.col("r._to").alias("node"), (F.col("l.up") + (1 << i)).alias("up")
        )
        members = stage(members.unionByName(above), "chat-members")
    return members


def conversations(nodes: DataFrame, best: int = 1) -> DataFrame:
    """One row per chosen path: tree, leaf, n_turns, formatted, and loss: the
    spans (start, length) of the assistant's escaped texts in code points."""
    content = nodes.select(
        "tree", F.col("node").alias("_node"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    role = F.col("r.role")
    turns = (
        _linked(paths(nodes, best), content, "node", "_node")
        .groupBy("l.tree", "l.leaf")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        (-F.col("l.up")).alias("at"), _opening(role).alias("a"), escape(F.col("r.text")).alias("b"),
                        _closing(role).alias("c"), (role == "assistant").alias("loss"),
                    )
                )
            ).alias("t")
        )
    )
    whole = F.concat(
        F.lit("<s>"), F.array_join(F.transform("t", lambda x: F.concat(x["a"], x["b"], x["c"])), "")
    )
    start = F.struct(F.lit(3).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans"))

    def walk(state, x):
        size = F.length(x["b"]).cast("long")
        begin = state["at"] + F.length(x["a"])
        span = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct(
            (begin + size + F.length(x["c"])).cast("long").alias("at"),
            F.when(x["loss"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return turns.select(
        "tree",
        "leaf",
        F.size("t").cast("long").alias("n_turns"),
        whole.alias("formatted"),
        F.aggregate("t", start, walk)["spans"].alias("loss"),
    )


def parsed(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted conversation."""
    found = F.regexp_extract_all(formatted.substr(F.lit(4), F.length(formatted)), F.lit(_TURN), F.lit(0))

    def inside(turn: Column, left: int, right: int) -> Column:
        return unescape(turn.substr(F.lit(left + 1), F.length(turn) - (left + right)))

    def read(turn: Column) -> Column:
        split = F.instr(turn, OTHER[1])
        name = turn.substr(F.lit(len(OTHER[0]) + 1), split - (len(OTHER[0]) + 1))
        text = turn.substr(split + len(OTHER[1]), F.length(turn) - split - (len(OTHER[1]) - 1) - len(OTHER[2]))
        result = F.struct(unescape(name).alias("role"), unescape(text).alias("text"))
        for role, (left, right) in MARKS.items():
            known = F.struct(F.lit(role).alias("role"), inside(turn, len(left), len(right)).alias("text"))
            result = F.when(turn.startswith(left), known).otherwise(result)
        return result

    return F.transform(found, read)


def masked(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(formatted.substr(s["start"] + 1, s["length"]))), "")
