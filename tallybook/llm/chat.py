"""Chat formatting: reply trees, their best branches, and each as one marked-up conversation.

A tree's nodes name their parents.  Self-joins double the reach of each node's
pointer to an ancestor (parent, grandparent, fourth, eighth ...), adding up
scores, so depth and score of every root-to-leaf path are known after as many
joins as its length has binary digits.  The chosen leaves then spread up along
the same pointers, the longest first, which lists every node of a path once.

A turn is written ``<|im_start|>role NEWLINE text<|im_end|> NEWLINE``.  Inside
texts and roles ``<|`` becomes ``<\\|`` (and ``<\\|`` gets one more stroke, and so
on), so no text holds a control string and unescaping gives back the text; roles
have ``%`` and line breaks written as ``%25`` and ``%0A``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.common import let, settled

START, END = "<|im_start|>", "<|im_end|>"
ESCAPED = r"<(\\*)\\\|"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "<$1|")


def _role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _plain_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def threaded(turns: DataFrame) -> DataFrame:
    """Nodes of conversations without branches: each row replies to the one ahead of it.

    Rows go by turn; of equal turns by role and text, NULL first.  Rows with a
    NULL conv_id are one conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", F.row_number().over(order).cast("bigint").alias("node"), "role", "text")
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select("conv_id", "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """The ``keep`` best root-to-leaf paths of each conversation: conv_id, leaf, depth (from 0), node.

    ``nodes`` has conv_id, node (unique in a conversation, not NULL), parent
    and score (NULL is 0).  A path's score is the sum of its nodes'; ties go to
    the least leaf.  A parent that does not exist makes a root; nodes on a
    circle, or below one, have no path and are left out.
    """
    nodes = nodes.select("conv_id", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = nodes.select(F.col("conv_id").alias("c"), F.col("node").alias("n"))
    found = F.expr("x.conv_id <=> k.c and x.parent = k.n")
    start = nodes.alias("x").join(known.alias("k"), found, "left")
    state = settled(start.select("conv_id", "node", F.col("k.n").alias("up"), F.col("score").alias("total"), F.expr("if(k.n is null, 0L, 1L)").alias("depth")))
    parents = state.select("conv_id", "up").where("up is not null").distinct()
    leaves = state.select("conv_id", "node").alias("x").join(parents.alias("p"), F.expr("x.conv_id <=> p.conv_id and x.node = p.up"), "left_anti")

    size = state.count()
    pointers = []
    for _ in range(math.ceil(math.log2(size + 1)) + 1):
        linked = state.where("up is not null").select("conv_id", "node", "up")
        if linked.isEmpty():
            break
        pointers.append(linked)
        # Only nodes below what they have reached go on; their number falls from round to round.
        climbing = state.where("up is not null").alias("a")
        further = climbing.join(state.alias("b"), F.expr("a.conv_id <=> b.conv_id and a.up = b.node"))
        further = further.select(
            "a.conv_id",
            "a.node",
            F.col("b.up").alias("up"),
            F.expr("a.total + b.total").alias("total"),
            F.expr("a.depth + b.depth").alias("depth"),
        )
        state = settled(state.where("up is null").unionByName(further))
    ended = state.where("up is null").select("conv_id", "node", "total", "depth")
    ranked = leaves.alias("l").join(ended.alias("e"), F.expr("l.conv_id <=> e.conv_id and l.node = e.node"))
    best = Window.partitionBy("conv_id").orderBy(F.col("total").desc(), "node")
    ranked = ranked.select("e.conv_id", "e.node", "e.total", "e.depth").withColumn("rank", F.row_number().over(best))
    chosen = ranked.where(F.col("rank") <= keep)
    chosen = settled(chosen.select("conv_id", F.col("node").alias("leaf"), "node", "depth"))
    for k in reversed(range(len(pointers))):
        step = F.expr("s.conv_id <=> u.conv_id and s.node = u.node")
        above = chosen.alias("s").join(pointers[k].alias("u"), step)
        above = above.select("s.conv_id", "s.leaf", F.col("u.up").alias("node"), (F.col("s.depth") - 2**k).alias("depth"))
        chosen = settled(chosen.unionByName(above))
    return chosen


def formatted(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """One row per chosen path: conv_id, leaf, n_turns, formatted, loss_spans.

    ``loss_spans`` has (start, length) of each assistant text in ``formatted``,
    in code points from 1: what a loss counts.  A NULL text or role is empty.
    A path is one row, so it must fit a task; conversations are independent.
    """
    nodes = settled(nodes)
    text, role = F.coalesce("n.text", F.lit("")), F.coalesce("n.role", F.lit(""))
    rows = paths(nodes, keep).alias("p").join(nodes.alias("n"), F.expr("p.conv_id <=> n.conv_id and p.node = n.node"))
    head = F.concat(F.lit(START), _role(role), F.lit("\n"))
    rows = rows.select("p.conv_id", "p.leaf", "p.depth", head.alias("head"), escaped(text).alias("body"), (role == LOSS_ROLE).alias("loss"))
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(END + "\n")))
    ahead = Window.partitionBy("conv_id", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length("piece").cast("bigint")).over(ahead), F.lit(0))
    rows = rows.withColumn("start", before + F.length("head") + 1)
    turn = F.struct("depth", "piece", "start", F.length("body").cast("bigint").alias("length"), "loss")
    grouped = rows.groupBy("conv_id", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    spans = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    return grouped.select(
        "conv_id",
        "leaf",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"),
    )


def parsed(text: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    turns = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda x: x != "")
    return F.transform(
        turns,
        lambda x: F.struct(
            _plain_role(F.substring(F.substring_index(x, "\n", 1), len(START) + 1, 2**31 - 1)).alias("role"),
            unescaped(F.substr(x, F.instr(x, "\n") + 1)).alias("text"),
        ),
    )


def _ahead(lengths: str) -> str:
    """SQL for the sums ahead of each number of an array, by sums within and over blocks of about the root of its size.

    An array grows by copying it, so a plain running sum would be quadratic.
    """
    blocks = f"transform(sequence(0, size({lengths}) - 1, step), at -> slice({lengths}, at + 1, step))"
    running = "aggregate(block, array(0L), (sums, x) -> concat(sums, array(element_at(sums, -1) + x)))"
    over = "aggregate(within, array(0L), (sums, block) -> concat(sums, array(element_at(sums, -1) + element_at(block, -1))))"
    moved = "transform(slice(block, 1, size(block) - 1), x -> x + before)"
    summed = let(over, "totals", f"flatten(zip_with(within, slice(totals, 1, size(within)), (block, before) -> {moved}))")
    summed = let(f"transform({blocks}, block -> {running})", "within", summed)
    return let(f"cast(ceil(sqrt(size({lengths}))) as int)", "step", f"if(size({lengths}) = 0, cast(array() as array<bigint>), {summed})")


def loss_text(text: str, spans: str) -> Column:
    """All that the loss counts, unescaped and joined.

    The text is cut into its turns once, and the lengths ahead of a turn tell
    where its text stands, so no span walks the text from its beginning.  The
    spans must be the texts of the turns the loss counts, else this raises.
    """
    turns = f"filter(split({text}, r'<\\|im_end\\|>\\n'), x -> x <> '')"
    counted = f"filter(zip_with(turns, starts, (t, s) -> struct(t, s)), x -> startswith(x.t, '{START}{LOSS_ROLE}\\n'))"
    places = "transform(counted, x -> struct(x.s + instr(x.t, '\\n') + 1 as start, cast(length(x.t) - instr(x.t, '\\n') as bigint) as length))"
    plain = f"regexp_replace(substr(x.t, instr(x.t, '\\n') + 1), r'{ESCAPED}', '<$1|')"
    body = f"if({places} = {spans}, array_join(transform(counted, x -> {plain}), ''), raise_error('a span is not the text of a turn'))"
    body = let(counted, "counted", body)
    body = let(_ahead("lengths"), "starts", body)
    body = let(f"transform(turns, x -> length(x) + {len(END) + 1}L)", "lengths", body)
    return F.expr(let(turns, "turns", body))
