"""Chat formatting over reply trees.

Messages name their parent. Pointer jumping (self-joins that double the reach each round) gives every message
its depth and the score of its path; leaves are ranked within their tree by path score; the chosen paths are
expanded by the stored jumps, and each becomes one conversation. Rounds grow with the logarithm of the depth,
and only ids and scores travel in them.

The template is ``<|im_start|>role`` newline text ``<|im_end|>`` newline. In texts and roles one backslash more is
put between ``<`` and ``|``, so a text can never hold a control string and unescaping gives it back exactly. Roles
also escape percent signs and line breaks. A conversation is stored as segments with a loss flag: assistant texts
are loss segments, everything else is not.

Defined cases: null text or role is empty; a null tree id is a tree; a parent that is not in the tree makes
its message a root; messages on a parent cycle belong to no path; of rows that repeat a message id the one least
by parent, role and text counts; a null score is 0; ties between leaves go to the smaller id. Rows with a null message
id are ignored by ``reply_paths``; ``chain`` numbers the rows of a flat conversation by turn (null first), role and
text, so there every row counts. One conversation becomes one row, as the format asks, so the longest must fit
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeflow.llm.columns import same
from changeflow.llm.common import stage

# Fixed values of the template.
START, END, ASSISTANT = "<|im_start|>", "<|im_end|>\n", "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def chain(rows: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages of flat conversations: each turn replies to the one before it."""
    order = W.partitionBy(rows[tree]).orderBy(*(F.col(c).asc_nulls_first() for c in (turn, role, text)))
    number = F.row_number().over(order).cast("long")
    return rows.select(
        rows[tree].alias("tree_id"),
        number.alias("message_id"),
        F.when(number > 1, number - 1).alias("parent_id"),
        F.lit(0.0).alias("score"),
        rows[role].alias("role"),
        rows[text].alias("text"),
    )


def _on(left: DataFrame, a: str, right: DataFrame, b: str) -> Column:
    return same(left["tree_id"], right["_tree"]) & (left[a] == right[b])


def _side(df: DataFrame, **names: str) -> DataFrame:
    return df.select(F.col("tree_id").alias("_tree"), *(F.col(c).alias(n) for n, c in names.items()))


def reply_paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """(tree_id, path, rank, position, message_id): the ``keep`` best root-to-leaf paths of each tree.

    ``path`` is the leaf's id; the score of a path is the sum over its messages.
    """
    nodes = stage(
        messages.where(F.col("message_id").isNotNull())
        .groupBy("tree_id", "message_id")
        .agg(F.min(F.struct("parent_id", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("_m"))
        .select("tree_id", "message_id", "_m.parent_id", "_m.score"),
        "chat-nodes",
    )
    known = _side(nodes, _node="message_id")
    pointers = stage(
        nodes.join(known, _on(nodes, "parent_id", known, "_node"), "left").select(
            "tree_id",
            "message_id",
            F.col("_node").alias("up"),
            "score",
            F.lit(1).cast("long").alias("depth"),
        ),
        "chat-pointers",
    )
    jumps: list[DataFrame] = []
    limit = max(nodes.count(), 1).bit_length() + 1  # a pointer still open then runs in a cycle
    while len(jumps) < limit:
        open_ = pointers.where(F.col("up").isNotNull())
        if not open_.head(1):
            break
        jumps.append(open_.select("tree_id", "message_id", "up"))
        far = _side(pointers, _node="message_id", _up="up", _score="score", _depth="depth")
        moved = open_.join(far, _on(open_, "up", far, "_node")).select(
            "tree_id",
            "message_id",
            F.col("_up").alias("up"),
            (F.col("score") + F.col("_score")).alias("score"),
            (F.col("depth") + F.col("_depth")).alias("depth"),
        )
        pointers = stage(pointers.where(F.col("up").isNull()).unionByName(moved), "chat-pointers")
    parents = _side(nodes.where(F.col("parent_id").isNotNull()), _node="parent_id").distinct()
    done = pointers.where(F.col("up").isNull())
    leaves = done.join(parents, _on(done, "message_id", parents, "_node"), "left_anti")
    best = W.partitionBy("tree_id").orderBy(F.col("score").desc(), "message_id")
    members = stage(
        leaves.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= keep)
        .select(
            "tree_id",
            F.col("message_id").alias("path"),
            "rank",
            "message_id",
            (F.col("depth") - 1).alias("position"),
        ),
        "chat-members",
    )
    for k in range(len(jumps) - 1, -1, -1):
        jump = _side(jumps[k], _node="message_id", _up="up")
        reached = members.join(jump, _on(members, "message_id", jump, "_node")).select(
            "tree_id", "path", "rank", F.col("_up").alias("message_id"), (F.col("position") - (1 << k)).alias("position")
        )
        members = stage(members.unionByName(reached), "chat-members")
    return members


def format_paths(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """One row per path: tree_id, path, rank, segments (text, loss) in order."""
    said = (
        messages.where(F.col("message_id").isNotNull())
        .groupBy("tree_id", "message_id")
        .agg(F.min(F.struct("parent_id", F.coalesce("score", F.lit(0.0)), "role", "text")).alias("_m"))
        .select(
            F.col("tree_id").alias("_tree"),
            F.col("message_id").alias("_node"),
            F.coalesce("_m.role", F.lit("")).alias("role"),
            escape(F.coalesce("_m.text", F.lit(""))).alias("body"),
        )
    )
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))

    def part(text: Column, loss: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    segments = F.when(
        F.col("role") == ASSISTANT, F.array(part(head, False), part(F.col("body"), True), part(F.lit(END), False))
    ).otherwise(F.array(part(F.concat(head, "body", F.lit(END)), False)))
    return (
        paths.join(said, _on(paths, "message_id", said, "_node"))
        .groupBy("tree_id", "path", "rank")
        .agg(F.sort_array(F.collect_list(F.struct("position", segments.alias("segments")))).alias("_turns"))
        .select("tree_id", "path", "rank", F.flatten("_turns.segments").alias("segments"))
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """Parse stored conversations: adds ``formatted``, ``turns`` (role, text) and ``loss_text``."""

    def turn(block: Column) -> Column:
        rest = F.substr(block, F.lit(len(START) + 1))
        role = F.substring_index(rest, "\n", 1)
        text = F.substr(rest, F.length(role) + 2)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    whole = formatted.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
    blocks = F.filter(F.split("formatted", r"<\|im_end\|>\n", -1), lambda b: F.startswith(b, F.lit(START)))
    return whole.withColumn("turns", F.transform(blocks, turn)).withColumn("loss_text", F.array_join(loss, ""))
