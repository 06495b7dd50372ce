"""Chat formatting of reply trees, in DataFrame operations alone.

Messages form trees: each names the message it replies to.  Self-joins that
double their reach find every message's root, depth and score along its path,
then the path from the chosen leaf of each tree back to its root, so a chain of
n messages takes log2(n) joins.  Each chosen path becomes one conversation.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.frames import saved

# Fixed values of the template.
TURN, SEPARATOR, STOP = "<|im_start|>", "<|sep|>", "<|im_end|>\n"
# Strings that steer a model or this template; inside a text they get a backslash after their first character.
CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]")
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """No control string is left in the result; :func:`unescape` gives the text back."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}")), CONTROL, text)


def unescape(text: Column) -> Column:
    text = reduce(lambda t, c: F.replace(t, F.lit(f"{c[0]}\\{c[1:]}"), F.lit(c)), CONTROL, text)
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def paths(messages: DataFrame) -> DataFrame:
    """The best root-to-leaf path of each tree: ``messages`` rows with their ``depth`` from 0.

    ``messages`` has ``conv_id, msg_id, parent_id, score`` and any payload.
    A message whose parent is null or absent is a root; a conversation may have
    several roots, its best branch is taken over all of them.  Branches rank by
    the mean score of their messages (null counts as 0), then by length, then by
    the smaller leaf id.  ``msg_id`` is unique within a conversation and not
    null; of repeated ids the first row by payload stays.  Messages on a cycle
    hang below no root and belong to no path.
    """
    payload = [name for name in messages.columns if name not in ("conv_id", "msg_id")]
    first = Window.partitionBy("conv_id", "msg_id").orderBy(*payload)
    messages = saved(
        messages.filter(F.col("msg_id").isNotNull()).withColumn("_copy", F.row_number().over(first))
        .filter("_copy = 1").drop("_copy")
    )
    known = messages.select(F.col("conv_id").alias("kc"), F.col("msg_id").alias("km"))
    links = messages.join(known, _same(F.col("conv_id"), F.col("kc")) & (F.col("parent_id") == F.col("km")), "left")
    # jump: the ancestor 2**k steps up, null above the root; sum and steps are over the path up to before it.
    state = saved(links.select(
        "conv_id", "msg_id", F.col("km").alias("jump"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"), F.lit(1).cast("long").alias("steps"),
    ))
    levels = [state.filter("jump IS NOT NULL").select("conv_id", "msg_id", "jump")]
    open_rows = state.filter("jump IS NOT NULL").count()
    while open_rows:
        up = state.select(
            F.col("conv_id").alias("uc"), F.col("msg_id").alias("um"), F.col("jump").alias("up_jump"),
            F.col("total").alias("up_total"), F.col("steps").alias("up_steps"),
        )
        # Only messages that have not reached their root take part; ever fewer do.
        climbed = state.filter("jump IS NOT NULL").join(
            up, _same(F.col("conv_id"), F.col("uc")) & (F.col("jump") == F.col("um"))
        ).select(
            "conv_id", "msg_id", F.col("up_jump").alias("jump"), (F.col("total") + F.col("up_total")).alias("total"),
            (F.col("steps") + F.col("up_steps")).alias("steps"),
        )
        state = saved(state.filter("jump IS NULL").union(climbed))
        still = state.filter("jump IS NOT NULL").count()
        if still == open_rows:  # only cycles are left, where every jump leads on
            break
        levels.append(state.filter("jump IS NOT NULL").select("conv_id", "msg_id", "jump"))
        open_rows = still

    parents = links.filter("km IS NOT NULL").select(F.col("conv_id").alias("pc"), F.col("km").alias("pm")).distinct()
    leaves = state.filter("jump IS NULL").join(
        parents, _same(F.col("conv_id"), F.col("pc")) & (F.col("msg_id") == F.col("pm")), "left_anti"
    )
    best = leaves.groupBy("conv_id").agg(F.max(F.struct(
        (F.col("total") / F.col("steps")).alias("mean"), "steps", (-F.col("msg_id")).alias("minus_id")
    )).alias("best"))
    chosen = best.select("conv_id", (-F.col("best.minus_id")).alias("msg_id"))
    # From the leaf back up: what is reached so far, joined to the jumps of each level, longest first.
    for level in reversed(levels):
        reached = saved(chosen)
        jumps = level.select(F.col("conv_id").alias("jc"), F.col("msg_id").alias("jm"), "jump")
        chosen = reached.union(
            reached.join(jumps, _same(F.col("conv_id"), F.col("jc")) & (F.col("msg_id") == F.col("jm")))
            .select("conv_id", F.col("jump").alias("msg_id"))
        ).distinct()
    depth = state.select(
        F.col("conv_id").alias("dc"), F.col("msg_id").alias("dm"), (F.col("steps") - 1).alias("depth")
    )
    on_path = saved(chosen).join(depth, _same(F.col("conv_id"), F.col("dc")) & (F.col("msg_id") == F.col("dm"))).select(
        "dc", "dm", "depth"
    )
    return messages.join(
        on_path, _same(F.col("conv_id"), F.col("dc")) & (F.col("msg_id") == F.col("dm"))
    ).drop("dc", "dm")


def format_trees(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans``: the best path of each tree as one text.

    ``messages`` has ``conv_id, msg_id, parent_id, score, role, text``; null
    roles and texts are empty.  ``loss_spans`` are the start (from 0) and length
    in characters of each assistant text in ``formatted``.  An empty table gives
    no rows.
    """
    turns = paths(messages).select(
        "conv_id", "depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumns({"head": F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SEPARATOR)), "body": escape(F.col("text"))})
    # Where each turn begins follows from the lengths before it.
    before = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    size = F.char_length("head") + F.char_length("body") + F.lit(len(STOP))
    placed = turns.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.char_length("head"))
    span = F.when(F.col("role") == LEARNED_ROLE, F.struct("start", F.char_length("body").cast("long").alias("length")))
    ordered = F.array_sort(F.collect_list(F.struct(
        "depth", F.concat("head", "body", F.lit(STOP)).alias("turn"), span.alias("span")
    )))
    whole = placed.groupBy("conv_id").agg(ordered.alias("turns"))
    return whole.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t.turn), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t.span), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of (role, text)."""
    parts = F.slice(F.split(formatted, re.escape(TURN)), 2, 1 << 30)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, SEPARATOR, 1)
        text = F.substring(
            part, F.char_length(role) + len(SEPARATOR) + 1,
            F.char_length(part) - F.char_length(role) - len(SEPARATOR) - len(STOP),
        )
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def linear(messages: DataFrame) -> DataFrame:
    """Conversations kept as rows by ``turn``, as trees: each row replies to the one before it.

    Rows of one turn follow in the order of their role and text, null first;
    rows without a turn come first.
    """
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = messages.select("conv_id", "role", "text", place.cast("long").alias("msg_id"))
    return rows.select(
        "conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"),
        F.lit(1.0).alias("score"), "role", "text",
    )
