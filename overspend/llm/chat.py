"""Chat formatting of reply trees, with DataFrame operations only.

Messages form a forest by their parent ids. Iterative self-joins double the reach of every message's pointer: after k rounds it names the ancestor 2^k above, with the
number and the scores of the messages on the way. So after as many rounds as the depth has binary digits each leaf knows its path's mean score, and leaves are ranked
by it before any path is built. The same pointers then enumerate the chosen paths, each round doubling the known part, and ids are collected once, by their
distance from the leaf. Rounds are written to the shared folder and removed when they are used up. Each chosen path is formatted as one conversation. Texts
join their paths only at the end.

Formatted turns are ``<|im_start|>role NEWLINE text<|im_end|> NEWLINE``. Control strings inside roles and texts are escaped: each backslash becomes
``\\e``, the first character of a control string ``\\l`` or ``\\b``, a line end in a role ``\\n``; undoing these in reverse order restores the text. The loss mask is a
list of run lengths in code points, with loss on the bodies of the assistant's turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from overspend.llm.common import release, written

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Control strings of common chat templates; only their first character is replaced.
CONTROL_ANGLE = r"<(?=\|(im_start|im_end|endoftext|system|user|assistant|eot_id)\||/?s>|</?SYS>>)"
CONTROL_SQUARE = r"\[(?=/?INST\])"


def escape(text: Column) -> Column:
    """Reversible: afterwards the text holds no control string, and every backslash starts an escape."""
    once = F.replace(text, F.lit("\\"), F.lit("\\e"))
    return F.regexp_replace(F.regexp_replace(once, CONTROL_ANGLE, r"\\l"), CONTROL_SQUARE, r"\\b")


def unescape(text: Column) -> Column:
    for code, plain in (("\\l", "<"), ("\\b", "["), ("\\e", "\\")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def threads(conversations: DataFrame) -> DataFrame:
    """Flat conversations (conv_id, turn, role, text) as trees: each row answers the one before it by turn.

    Rows of equal turn follow by role and text, so repeated rows give the same result in any order; a null turn comes first. The tree is
    a struct of the conversation's id, so rows without an id form a conversation too.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    ranked = conversations.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("message"))
    return ranked.select(F.struct("conv_id").alias("tree"), "message", F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"), "role", "text",
                         F.lit(0.0).alias("score"))


def paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, path_no, path) of root-to-leaf paths of ``messages`` (tree, message, parent, role, text, score).

    ``path`` lists message ids from the root on; path 1 has the highest mean score, ties go to the smaller ids. Rows whose message or tree
    is null, and answers to a message that is missing, are left out; a parent cycle has no root, so it has no path. ``best`` keeps that many
    paths per tree. Of repeated messages one counts.
    """
    edges = written(messages.where("tree is not null and message is not null").groupBy("tree", "message")
                    .agg(F.max(F.struct(F.coalesce("score", F.lit(0.0)).alias("score"), "parent")).alias("best"))
                    .select("tree", "message", "best.parent", "best.score"), "reply-edges")
    levels = _pointers(edges)
    parents = edges.where("parent is not null").select("tree", F.col("parent").alias("message")).distinct()
    leaves = levels[-1].where("up is null").join(parents, ["tree", "message"], "left_anti").select("tree", "message", (F.col("score") / F.col("size")).alias("mean"))
    if best is not None:
        # Ties stay until their paths can be compared.
        leaves = leaves.withColumn("place", F.rank().over(Window.partitionBy("tree").orderBy(F.desc("mean")))).where(F.col("place") <= best)
    ends = written(leaves.select("tree", F.col("message").alias("leaf"), F.col("message").alias("node"), F.lit(0).alias("above"), "mean"), "reply-paths")
    for k, level in enumerate(levels):
        up = level.where("up is not null").select("tree", F.col("message").alias("node"), "up")
        more = ends.join(up, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("above") + (1 << k)).alias("above"), "mean")
        longer = written(ends.unionByName(more), "reply-paths")
        release(ends)
        ends = longer
    release(edges, *levels)
    found = ends.groupBy("tree", "leaf").agg(F.max("mean").alias("mean"), F.sort_array(F.collect_list(F.struct("above", "node")), asc=False).alias("way"))
    whole = found.select("tree", "mean", F.col("way.node").alias("path"))
    numbered = whole.withColumn("path_no", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("mean"), "path"))).select("tree", "path_no", "path")
    return numbered if best is None else numbered.where(F.col("path_no") <= best)


def _pointers(edges: DataFrame) -> list[DataFrame]:
    """Per round k the table (tree, message, up, size, score): ``up`` is the ancestor 2^k above, null where the chain has reached its root before; size
    and score count the messages below ``up``. The last round has the roots of all chains that have one.

    Chains that end at a missing message disappear, since nothing joins it. Chains in a cycle never reach a root; no chain is longer than there are
    messages, which bounds the rounds. Finished rows are not joined again, so they do not gather under one key.
    """
    rounds = max(1, edges.count()).bit_length()
    levels = [written(edges.select("tree", "message", F.col("parent").alias("up"), F.lit(1).cast("long").alias("size"), "score"), "reply-pointers")]
    while len(levels) <= rounds and levels[-1].where("up is not null").limit(1).count():
        now = levels[-1]
        above = now.select("tree", F.col("message").alias("up"), F.col("up").alias("next"), F.col("size").alias("more"), F.col("score").alias("added"))
        moved = now.where("up is not null").join(above, ["tree", "up"]).select(
            "tree", "message", F.col("next").alias("up"), (F.col("size") + F.col("more")).alias("size"), (F.col("score") + F.col("added")).alias("score"))
        levels.append(written(now.where("up is null").unionByName(moved), "reply-pointers"))
    return levels


def format_paths(messages: DataFrame, chosen: DataFrame) -> DataFrame:
    """(tree, path_no, formatted, mask) of the chosen paths; mask is an array of (chars, loss) runs that covers ``formatted``.

    A null text is empty; a null role is the empty role.
    """
    texts = messages.groupBy("tree", "message").agg(F.max(F.struct(F.coalesce("score", F.lit(0.0)).alias("score"), "parent",
                                                                  F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("best"))
    places = chosen.select("tree", "path_no", F.posexplode("path").alias("place", "message"))
    turns = places.join(texts, ["tree", "message"]).groupBy("tree", "path_no").agg(
        F.sort_array(F.collect_list(F.struct("place", _escape_role(F.col("best.role")).alias("role"), escape(F.col("best.text")).alias("text")))).alias("turns"))

    def runs(turn):
        head, body = F.char_length(turn["role"]) + len(OPEN) + 1, F.char_length(turn["text"])
        return F.array(F.struct(head.alias("chars"), F.lit(False).alias("loss")), F.struct(body.alias("chars"), (turn["role"] == "assistant").alias("loss")),
                       F.struct(F.lit(len(CLOSE)).alias("chars"), F.lit(False).alias("loss")))

    formatted = F.array_join(F.transform("turns", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(CLOSE))), "")
    return turns.select("tree", "path_no", formatted.alias("formatted"), F.flatten(F.transform("turns", runs)).alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns``, (role, text) as they were, and ``loss``, the unescaped texts under the mask, from ``formatted`` and ``mask`` alone."""
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, 1 << 30)

    def fields(piece):
        head = F.substring_index(piece, "\n", 1)
        length = F.char_length(head)
        body = F.substring(piece, length + 2, F.char_length(piece) - length - (len(CLOSE) + 1))
        return F.struct(head.alias("role"), body.alias("text"))

    raw = formatted.withColumn("raw", F.transform(pieces, fields))
    checked = F.transform("raw", lambda turn, i: F.when(F.get("mask", i * 3 + 1)["loss"] & (F.get("mask", i * 3 + 1)["chars"] == F.char_length(turn["text"])), unescape(turn["text"])))
    return (raw.withColumn("turns", F.transform("raw", lambda t: F.struct(_unescape_role(t["role"]).alias("role"), unescape(t["text"]).alias("text"))))
            .withColumn("loss", F.filter(checked, lambda text: text.isNotNull())).drop("raw"))
