r"""Chat formatting of reply trees.

Messages form trees through parent ids. Iterative self-joins with doubled step (parent, then
grandparent, then four up ...) give every message its depth and the summed score of its path
in log2(depth) joins. Leaves are ranked within their conversation by mean score; the same
step tables then enumerate the messages of the chosen root-to-leaf paths, and each path is
formatted as one conversation. Turns are numbered and joined by (conversation, turn) or
(conversation, message), so a conversation with a large share of the rows is dealt over all tasks
until its paths are ranked (ids and scores alone) and its one text is put together.

Template, per turn: ``<|im_start|>role\ntext<|im_end|>\n``. Inside roles and texts ``&``
becomes ``&amp;`` and ``<|`` becomes ``&lt;|`` (in roles also a line feed ``&#10;``), so no
text can hold a control string and the original can be read back.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, text_or_empty

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def chain_replies(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Linear conversations as reply trees: each turn answers the one before it.

    Rows of one turn are ordered by role and text; null turns come first. A null conversation is
    one of its own, repeated rows are turns of their own, extra columns are ignored, an empty
    table gives an empty result. Only counts by turn meet in a task of their conversation.
    """
    t = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), "role", "text")
    counts = t.groupBy("conv_id", "turn").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    here = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    m = t.withColumn("place", F.row_number().over(here)).join(starts, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")))
    m = m.select("conv_id", (F.col("start") + F.col("place")).alias("msg_id"), "role", "text")
    return m.withColumn("parent_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1)).withColumn("score", F.lit(0.0))


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The messages of the ``branches`` best root-to-leaf paths of each conversation.

    ``messages``: conv_id, msg_id (unique in its conversation), parent_id, role, text, score.
    Returns conv_id, branch (0 is best), depth (from 1), role, text. Null scores count as 0;
    ties go to the smaller leaf id. A parent that does not exist makes its reply a root.
    Replies that lead into a cycle of parents have no root and are left out.
    """
    key = ["conv_id", "msg_id"]
    messages = materialise(messages.select(*key, "parent_id", "role", "text", "score"), "chat-messages")
    here = messages.select(*key, "parent_id", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    known = here.select(F.col("conv_id").alias("_c"), F.col("msg_id").alias("_m"))
    step = here.join(known, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("parent_id") == F.col("_m")), "left")
    step = materialise(step.select(*key, F.col("_m").alias("up"), "score", F.lit(1).cast("long").alias("n")), "chat-step")
    first, levels, rooted = step, [], step.where("up IS NULL")
    rounds = math.ceil(math.log2(max(2, first.count()))) + 1
    for _ in range(rounds):
        moving = step.where("up IS NOT NULL")  # only these can still climb
        if moving.isEmpty():
            break
        levels.append(moving)
        above = rooted.unionByName(moving).select(F.col("conv_id").alias("_c"), F.col("msg_id").alias("_m"), F.col("up").alias("_up"), F.col("score").alias("_s"), F.col("n").alias("_n"))
        joined = moving.join(above, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("up") == F.col("_m")))
        step = materialise(joined.select(*key, F.col("_up").alias("up"), (F.col("score") + F.col("_s")).alias("score"), (F.col("n") + F.col("_n")).alias("n")), "chat-step")
        rooted = rooted.unionByName(step.where("up IS NULL"))
    rooted = rooted.select(*key, "score", F.col("n").alias("depth"))

    parents = first.select(F.col("conv_id").alias("_c"), F.col("up").alias("_m")).where("_m IS NOT NULL").distinct()
    leaves = rooted.join(parents, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("msg_id") == F.col("_m")), "left_anti")
    rank = Window.partitionBy("conv_id").orderBy(F.desc(F.col("score") / F.col("depth")), "msg_id")
    paths = leaves.withColumn("branch", F.row_number().over(rank) - 1).where(F.col("branch") < branches).select("conv_id", "branch", "msg_id")
    for level in reversed(levels):
        up = level.select(F.col("conv_id").alias("_c"), F.col("msg_id").alias("_m"), "up")
        more = paths.join(up, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("msg_id") == F.col("_m"))).select("conv_id", "branch", F.col("up").alias("msg_id"))
        paths = materialise(paths.unionByName(more), "chat-paths")
    texts = messages.join(rooted, [messages.conv_id.eqNullSafe(rooted.conv_id), messages.msg_id == rooted.msg_id]).select(messages.conv_id.alias("_c"), messages.msg_id.alias("_m"), "depth", "role", "text")
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("msg_id") == F.col("_m"))
    return paths.join(texts, on).select("conv_id", "branch", "depth", "role", "text")


def format_paths(paths: DataFrame) -> DataFrame:
    """One conversation per path: conv_id, branch, formatted, loss_spans.

    ``loss_spans``: [start, end) in code points of ``formatted``, one per assistant text, in
    order. Null roles and texts are empty. An empty table gives an empty result.
    """
    role, text = _escape_role(text_or_empty(F.col("role"))), escape(text_or_empty(F.col("text")))
    p = paths.select("conv_id", "branch", "depth", (F.col("role") == "assistant").alias("learn"), role.alias("role"), text.alias("text"))
    head = len(START) + F.length("role") + 1
    p = p.select("conv_id", "branch", F.struct("depth", F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END)).alias("piece"), "learn", head.cast("long").alias("head")).alias("turn"))
    turns = p.groupBy("conv_id", "branch").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    begun = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<begin:bigint,end:bigint>>").alias("spans"))

    def add(done: Column, t: Column) -> Column:
        after = done["at"] + F.length(t["piece"])
        span = F.struct((done["at"] + t["head"]).alias("begin"), (after - len(END)).alias("end"))
        return F.struct(after.alias("at"), F.when(t["learn"], F.array_append(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    spans = F.aggregate("turns", begun, add)["spans"]
    return turns.select("conv_id", "branch", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, branch, formatted, turns (role, text) and loss_text, parsed from the formatted text and its spans.

    Null roles and texts come back as empty ones. Repeated rows are each read, extra columns are
    left out, an empty table gives an empty result.
    """
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    body = F.transform(pieces, lambda x: F.substr(x, F.lit(len(START) + 1)))
    turns = F.transform(
        body,
        lambda x: F.struct(_unescape_role(F.substring_index(x, "\n", 1)).alias("role"), unescape(F.substr(x, F.instr(x, F.lit("\n")) + 1)).alias("text")),
    )
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substr("formatted", (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int")))), "")
    return formatted.select("conv_id", "branch", "formatted", turns.alias("turns"), loss.alias("loss_text"))
