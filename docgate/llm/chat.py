"""Reply trees: root-to-leaf paths by self-joins, formatted as conversations; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docgate.llm.common import stage

ANSWER = "assistant"
# A bracket, any number of escapes, and the rest of a control string: <s> </s> [INST] [/INST].
_CONTROL = r"(<|\[)(\\*)(/?(?:s>|INST\]))"
_ESCAPED = r"(<|\[)\\(\\*)(/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    """``text`` without control strings: one backslash more after the bracket of each."""
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`, for every text."""
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def chain(rows: DataFrame) -> DataFrame:
    """Messages of plain conversations (conv_id, turn, role, text) as trees without branches.

    Each row replies to the row before it by turn; rows of one turn follow in order of role and text,
    nulls first.
    """
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return rows.select("conv_id", "role", "text", place.cast("long").alias("msg_id")).select(
        "*",
        F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"),
        F.lit(0.0).alias("score"),
    )


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The messages on the ``branches`` best root-to-leaf paths of each conversation.

    ``messages``: conv_id, msg_id, parent_id (null at a root), score. A path's score is the sum along
    it (null scores count 0); ties go to the smaller leaf id. Returns conv_id, leaf_id, branch (from
    1), place (from 0 at the root), msg_id. A parent that does not exist makes its reply a root;
    replies that form a cycle have no leaf and are left out. Null conversations are one conversation.

    The self-joins double the distance each time: after k of them a message knows its ancestor 2^k
    steps up and the score up to there, so depth d takes about log2(d) joins. Chosen leaves then
    walk the same tables downwards, which lists every message of a chosen path once; paths
    that are not chosen are never listed.
    """
    nodes = messages.select(
        F.struct(F.col("conv_id").alias("conv"), F.col("msg_id").alias("msg")).alias("node"),
        F.when(
            F.col("parent_id").isNotNull(),
            F.struct(F.col("conv_id").alias("conv"), F.col("parent_id").alias("msg")),
        ).alias("up"),
        F.coalesce(F.col("score"), F.lit(0.0)).cast("double").alias("score"),
    )
    known = nodes.select(F.col("node").alias("_node"))
    latest = stage(
        nodes.join(known, F.col("up").eqNullSafe(F.col("_node")), "left").select(
            "node", F.col("_node").alias("up"), "score", F.lit(1).cast("long").alias("steps")
        ),
        "hops",
    )
    first, hops, rooted = latest, [], latest.where("up is null")
    limit = messages.count()
    while not latest.where("up is not null").isEmpty() and 2 ** len(hops) <= limit:
        # Messages that have reached their root are done; they are only looked up.
        climbing = latest.where("up is not null")
        hops.append(climbing.select("node", "up"))
        far = rooted.unionByName(climbing).select(
            F.col("node").alias("_node"),
            F.col("up").alias("_up"),
            F.col("score").alias("_score"),
            F.col("steps").alias("_steps"),
        )
        climbed = climbing.join(far, F.col("up") == F.col("_node")).select(
            "node",
            F.col("_up").alias("up"),
            (F.col("score") + F.col("_score")).alias("score"),
            (F.col("steps") + F.col("_steps")).alias("steps"),
        )
        latest = stage(climbed, "hops")
        rooted = rooted.unionByName(latest.where("up is null"))
    parents = first.where("up is not null").select(F.col("up").alias("_up")).distinct()
    leaves = rooted.join(parents, F.col("node").eqNullSafe(F.col("_up")), "left_anti")
    rank = Window.partitionBy("node.conv").orderBy(F.desc("score"), "node.msg")
    chosen = (
        leaves.withColumn("branch", F.row_number().over(rank))
        .where(F.col("branch") <= branches)
        .select(F.col("node").alias("leaf"), "branch", "node", (F.col("steps") - 1).alias("place"))
    )
    found = chosen
    for k in range(len(hops) - 1, -1, -1):
        up = hops[k].select(F.col("node").alias("_node"), F.col("up").alias("_up"))
        climbed = found.join(up, F.col("node").eqNullSafe(F.col("_node"))).select(
            "leaf", "branch", F.col("_up").alias("node"), (F.col("place") - 2**k).alias("place")
        )
        found = stage(found.unionByName(climbed), "paths")
    return found.select(
        F.col("leaf.conv").alias("conv_id"),
        F.col("leaf.msg").alias("leaf_id"),
        "branch",
        "place",
        F.col("node.msg").alias("msg_id"),
    )


def format_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One formatted conversation per chosen path.

    ``messages``: conv_id, msg_id (unique in a conversation), parent_id, role, text, score. Turns are
    ``[INST] role`` newline ``text [/INST]``, answers ``<s>text</s>``; the role is percent-encoded
    and control strings in texts are escaped, so the output reads back exactly. Returns conv_id,
    leaf_id, branch, formatted and loss_spans (start from 0 and length, in code points of formatted,
    of each answer's text). Null roles and texts count as empty, also in very long conversations;
    an empty table gives no rows; other columns are ignored.

    A conversation is one output row, so its messages meet in one task; nothing larger does.
    """
    paths = best_paths(messages, branches)
    answer = F.col("role") == ANSWER
    body = escape(F.coalesce(F.col("text"), F.lit("")))
    head = F.concat(F.lit("[INST] "), F.url_encode(F.coalesce(F.col("role"), F.lit(""))), F.lit("\n"))
    turns = messages.select(
        F.col("conv_id").alias("_conv"),
        F.col("msg_id").alias("_msg"),
        F.when(answer, F.concat(F.lit("<s>"), body, F.lit("</s>")))
        .otherwise(F.concat(head, body, F.lit(" [/INST]")))
        .alias("turn"),
        F.when(answer, F.length(body)).cast("long").alias("learnt"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("msg_id") == F.col("_msg"))
    path = ["conv_id", "leaf_id", "branch"]
    upto = Window.partitionBy(*path).orderBy("place")
    placed = paths.join(turns, same).select(
        *path, "place", "turn", "learnt", F.sum(F.length("turn")).over(upto).alias("end")
    )
    start = F.col("end") - F.length("turn") + len("<s>")
    span = F.when(
        F.col("learnt").isNotNull(), F.struct(start.alias("start"), F.col("learnt").alias("length"))
    )
    rows = F.sort_array(F.collect_list(F.struct("place", "turn", span.alias("span"))))
    return placed.groupBy(*path).agg(rows.alias("rows")).select(
        *path,
        F.array_join(F.col("rows.turn"), "").alias("formatted"),
        F.filter(F.col("rows.span"), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.split(formatted, r" \[/INST\]|</s>", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        told = F.struct(
            F.url_decode(F.substr(head, F.lit(len("[INST] ") + 1))).alias("role"),
            unescape(F.substr(piece, F.length(head) + 2)).alias("text"),
        )
        answered = F.struct(
            F.lit(ANSWER).alias("role"),
            unescape(F.substr(piece, F.lit(len("<s>") + 1))).alias("text"),
        )
        return F.when(piece.startswith("<s>"), answered).otherwise(told)

    return F.transform(pieces, turn)


def learnt_text(formatted: Column, loss_spans: Column) -> Column:
    """All text under the loss mask, unescaped, joined by nothing."""
    texts = F.transform(
        loss_spans,
        lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )
    return F.array_join(texts, "")


