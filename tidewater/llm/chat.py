"""Conversations from reply trees: root-to-leaf paths, ranked by score, each formatted as one text.

Paths come from iterative self-joins by pointer doubling: after k rounds every
message knows its ancestor 2^k replies up, so a tree of any depth needs as many
rounds as its depth has binary digits.  Only the chosen leaves' paths are written
out, again by doubling.

Each turn is `<|im_start|>role`, a line break, the text and `<|im_end|>` with a line
break.  Inside roles and texts `<|` gets a backslash after its `<`, and one more for
each that is there already, so no text can contain a marker and the texts can be
read back.  In roles, backslashes and line breaks are escaped first.

Null roles and texts are empty.  A message whose parent is null or missing is a
root; messages on a cycle of replies, or below one, have no root and belong to no
path.  A null tree is a tree.  Equal scores go by path length, then by the leaf.
Repeated rows of a conversation are turns of their own.  An empty table gives no
rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.storage import staged

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def thread(turns: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A linear conversation as a tree: each turn replies to the one before; longer texts score higher."""
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    named = turns.select(F.col(tree).alias("tree"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    node = F.row_number().over(order).cast("bigint")
    return named.withColumn("node", node).select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.char_length(F.coalesce("text", F.lit(""))).cast("double").alias("score"))


def _met(left: DataFrame, right: DataFrame, at: str, how: str) -> DataFrame:
    """`right` (r_tree, r_node, ...) joined to `left` where its node is `left[at]` in the same tree."""
    return left.join(right, left["tree"].eqNullSafe(right["r_tree"]) & (left[at] == right["r_node"]), how)


def climbed(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """`tree, node, total, size` of every message that has a root: score and length of the path down to it; and the jump tables."""
    plain = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("total"))
    known = plain.select(F.col("tree").alias("r_tree"), F.col("node").alias("r_node")).distinct()
    start = _met(plain, known, "parent", "left").select("tree", "node", F.col("r_node").alias("jump"), "total", F.lit(1).cast("bigint").alias("size"))
    state, jumps, finished, open_before = staged(start, "jumps"), [], [], -1
    while True:
        going = state.where("jump is not null")
        unfinished = going.count()
        finished.append(state.where("jump is null"))
        if unfinished in (0, open_before):  # what is left never ends: replies in a circle
            return reduce(DataFrame.unionByName, finished).select("tree", "node", "total", "size"), jumps
        open_before = unfinished
        jumps.append(going.select("tree", "node", "jump"))
        known = reduce(DataFrame.unionByName, [*finished[:-1], state])
        above = known.select(F.col("tree").alias("r_tree"), F.col("node").alias("r_node"), F.col("jump").alias("r_jump"), F.col("total").alias("r_total"), F.col("size").alias("r_size"))
        higher = _met(going, above, "jump", "inner").select("tree", "node", F.col("r_jump").alias("jump"), (F.col("total") + F.col("r_total")).alias("total"), (F.col("size") + F.col("r_size")).alias("size"))
        state = staged(higher, "jumps")


def _roots(messages: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """`tree, node, root`: every message's topmost ancestor, from the jump tables, farthest first."""
    at = messages.select("tree", "node", F.col("node").alias("root"))
    for table in reversed(jumps):
        up = table.select(F.col("tree").alias("r_tree"), F.col("node").alias("r_node"), F.col("jump").alias("r_jump"))
        at = _met(at, up, "root", "left").select("tree", "node", F.coalesce("r_jump", "root").alias("root"))
    return at


def best_paths(messages: DataFrame, per_root: int = 1) -> DataFrame:
    """`tree, leaf, node, place`: the messages of the `per_root` best leaves below every root, place 1 being the root."""
    reached, jumps = climbed(messages)
    parents = messages.select(F.col("tree").alias("r_tree"), F.col("parent").alias("r_node")).where("r_node is not null").distinct()
    leaves = _met(reached, parents, "node", "left_anti")
    with_root = _roots(leaves, jumps)
    under = leaves.join(with_root.select(F.col("tree").alias("r_tree"), F.col("node").alias("r_node"), "root").distinct(), F.col("tree").eqNullSafe(F.col("r_tree")) & (F.col("node") == F.col("r_node")))
    rank = F.row_number().over(Window.partitionBy("tree", "root").orderBy(F.desc("total"), F.desc("size"), "node"))
    chosen = under.withColumn("rank", rank).where(F.col("rank") <= per_root)
    paths = staged(chosen.select("tree", F.col("node").alias("leaf"), "node", F.col("size").alias("place")), "paths")
    for k, table in enumerate(jumps):
        up = table.select(F.col("tree").alias("r_tree"), F.col("node").alias("r_node"), F.col("jump").alias("r_jump"))
        higher = _met(paths, up, "node", "inner").select("tree", "leaf", F.col("r_jump").alias("node"), (F.col("place") - (1 << k)).alias("place"))
        paths = staged(paths.unionByName(higher), "paths")
    return paths


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _escaped_role(role: Column) -> Column:
    plain = F.replace(F.coalesce(role, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return escaped(F.replace(plain, F.lit("\n"), F.lit("\\n")))


def _unescaped_role(role: Column) -> Column:
    """Undo the line breaks without touching `\\\\n`, a backslash followed by an n."""
    parts = F.split(unescaped(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def formatted(messages: DataFrame, paths: DataFrame, learn: str = ASSISTANT) -> DataFrame:
    """`tree, leaf, formatted, loss`: one text per path, and the places (start, length in characters) of what is learnt."""
    said = messages.select(F.col("tree").alias("r_tree"), F.col("node").alias("r_node"), F.col("role"), F.col("text"))
    turns = _met(paths, said, "node", "inner").select("tree", "leaf", "place", "role", escaped(F.col("text")).alias("body"), F.concat(F.lit(START), _escaped_role(F.col("role")), F.lit("\n")).alias("head"))
    turns = turns.withColumn("turn", F.concat("head", "body", F.lit(END)))
    path = Window.partitionBy("tree", "leaf").orderBy("place")
    before = F.coalesce(F.sum(F.char_length("turn")).over(path.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    span = F.when(F.col("role") == learn, F.struct((before + F.char_length("head")).alias("start"), F.char_length("body").cast("bigint").alias("length")))
    placed = turns.withColumn("span", span)
    held = placed.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct("place", "turn", "span"))).alias("turns"))
    return held.select("tree", "leaf", F.array_join("turns.turn", "").alias("formatted"), F.array_compact("turns.span").alias("loss"))


def read_back(texts: DataFrame) -> DataFrame:
    """Add `turns` (role, text) and `learnt` (the texts under the loss mask), taken from the formatted text alone."""
    pieces = F.split(F.col("formatted"), r"<\|im_end\|>\n", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    head = len(START)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(head + 1), F.char_length(piece))
        role = F.substring_index(body, "\n", 1)
        return F.struct(_unescaped_role(role).alias("role"), unescaped(F.substring(body, F.char_length(role) + 2, F.char_length(body))).alias("text"))

    learnt = F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return texts.withColumns({"turns": F.transform(pieces, turn), "learnt": learnt})
