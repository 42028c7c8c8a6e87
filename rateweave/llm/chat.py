"""Chat formatting of reply trees, with DataFrame functions only.

Iterative self-joins enumerate the paths from each root to each leaf, paths
are ranked within their tree by the scores of their messages, and every
chosen path is formatted as one conversation with a loss mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

# Fixed marks of the template: a turn is OPEN role CUT text CLOSE.
OPEN, CUT, CLOSE = "<s>[", "]\n", "</s>"
# A backslash goes behind each of these characters inside roles and texts, so
# none of the marks can occur there and the change can be undone.
GUARDED = r"([<\[\]\\])"
GUARD = r"([<\[\]\\])\\"


def guarded(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), GUARDED, r"$1\\")


def unguarded(text: Column) -> Column:
    return F.regexp_replace(text, GUARD, "$1")


def reply_paths(messages: DataFrame, id_col: str = "id", parent_col: str = "parent") -> DataFrame:
    """(leaf, id, up): each leaf with every message on its path, ``up`` replies above it.

    Ids are unique and not null; a message whose parent is null or unknown is
    a root.  Step k joins the paths found so far with the 2**k-th ancestors,
    which are joined with themselves for the next step, so the number of
    joins grows with the logarithm of the depth.  A cycle of replies has no
    leaf and is left out; a leaf that leads into one raises ValueError.
    """
    nodes = messages.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent"))
    links = nodes.filter("parent is not null").select("id", F.col("parent").alias("above"))
    links = links.join(nodes.select(F.col("id").alias("above")), "above", "left_semi").select("id", "above")
    hops = written(links, "replies")
    leaves = nodes.select("id").join(hops.select(F.col("above").alias("id")), "id", "left_anti")
    paths = written(leaves.select(F.col("id").alias("leaf"), "id", F.lit(0).alias("up")), "paths")
    step, most = 1, nodes.count()
    while True:
        further = written(paths.join(hops, "id").select(
            "leaf", F.col("above").alias("id"), (F.col("up") + step).alias("up")), "further")
        if not further.limit(1).count():
            return paths
        if step > most:
            raise ValueError("the replies above a leaf contain a cycle")
        paths = written(paths.unionByName(further), "paths")
        onward = hops.select(F.col("id").alias("above"), F.col("above").alias("next"))
        hops = written(hops.join(onward, "above").select("id", F.col("next").alias("above")), "replies")
        step *= 2


def best_paths(messages: DataFrame, paths: DataFrame, most: int | None = None) -> DataFrame:
    """(tree, leaf, place, id, role, text): the messages of each tree's best paths.

    messages: tree, id, role, text, score.  A path scores the mean of its
    messages (null: 0); ``rank`` 1 is the best, ties go to the smaller leaf.
    ``most`` paths of a tree are kept, all of them when it is None.
    """
    on_path = paths.join(messages, "id")
    ranked = on_path.groupBy("leaf").agg(
        F.min("tree").alias("of"), F.max("up").alias("top"),
        F.avg(F.coalesce("score", F.lit(0.0))).alias("path_score"))
    ranked = ranked.withColumn("rank", F.row_number().over(
        Window.partitionBy("of").orderBy(F.desc("path_score"), "leaf")))
    if most is not None:
        ranked = ranked.filter(F.col("rank") <= most)
    return on_path.join(ranked, "leaf").select(
        "tree", "leaf", "rank", (F.col("top") - F.col("up")).alias("place"), "id", "role", "text")


def formatted(turns: DataFrame, keys: list[str], learn: str = "assistant") -> DataFrame:
    """(keys..., formatted, spans): the turns of each key in order of ``place`` as one text.

    spans: array of (start, length) in code points, one for each text of role
    ``learn``: the loss mask.
    """
    head = F.concat(F.lit(OPEN), guarded(F.col("role")), F.lit(CUT))
    body = guarded(F.col("text"))
    before = Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    laid = (turns.withColumn("head", head).withColumn("body", body)
            .withColumn("size", F.length("head") + F.length("body") + len(CLOSE))
            .withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0)) + F.length("head")))
    span = F.when(F.col("role") == learn, F.struct(F.col("at").alias("start"), F.length("body").cast("long").alias("length")))
    grouped = laid.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(
        "place", F.concat("head", "body", F.lit(CLOSE)).alias("part"), span.alias("span")))).alias("parts"))
    return grouped.select(
        *keys, F.array_join("parts.part", "").alias("formatted"),
        F.filter("parts.span", lambda s: s.isNotNull()).alias("spans"))


def read_back(text: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    parts = F.filter(F.split(text, CLOSE), lambda x: x != "")
    cut = lambda x: F.instr(x, CUT)
    return F.transform(parts, lambda x: F.struct(
        unguarded(F.substring(x, F.lit(len(OPEN) + 1), cut(x) - len(OPEN) - 1)).alias("role"),
        unguarded(F.substring(x, cut(x) + len(CUT), F.length(x))).alias("text")))


def masked_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, as it was before guarding."""
    return F.array_join(F.transform(spans, lambda s: unguarded(
        F.substring(text, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def as_tree(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Plain conversations as reply trees: each row replies to the row before it.

    Rows go by turn, nulls first; rows with the same turn go by role and text.
    A null conversation id is a conversation of its own.
    """
    order = Window.partitionBy(conv_col).orderBy(turn_col, "role", "text")
    name = lambda at: F.concat_ws(":", F.coalesce(F.col(conv_col).cast("string"), F.lit("")), at.cast("string"))
    at = F.row_number().over(order)
    return (rows.withColumn("at", at).select(
        F.col(conv_col).alias("tree"), name(F.col("at")).alias("id"),
        F.when(F.col("at") > 1, name(F.col("at") - 1)).alias("parent"), "role", "text"))


def format_conversations(rows: DataFrame, learn: str = "assistant") -> DataFrame:
    """(conv_id, formatted, spans) of every conversation (conv_id, turn, role, text).

    Null texts and roles are empty; rows that repeat are turns of their own;
    other columns are not read; an empty table gives no rows.
    """
    messages = written(as_tree(rows.select("conv_id", "turn", "role", "text")), "messages")
    scored = messages.select("tree", "id", "role", "text", F.lit(0.0).alias("score"))
    chosen = best_paths(scored, reply_paths(messages))
    return formatted(chosen, ["tree", "leaf"], learn).select(
        F.col("tree").alias("conv_id"), "formatted", "spans")


def conversation_digests(done: DataFrame) -> DataFrame:
    """Digests of conversations, read back from their formatted text and mask."""
    spoken = masked_text(F.col("formatted"), F.col("spans"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (done.withColumn("turns", read_back(F.col("formatted"))).withColumn("spoken", spoken).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("spoken").cast("long").alias("loss_chars"),
        F.sha2("spoken", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars")))
