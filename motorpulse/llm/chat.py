"""Reply trees formatted as conversations.

Messages know the message they reply to. Iterative self-joins over doubled steps
enumerate the root-to-leaf paths, branches are ranked by score, and every chosen path
becomes one text with a mask of the parts to learn from. DataFrame functions only.

Template: ``<|turn|>ROLE<|text|>TEXT<|end|>`` and a line feed for each turn. Control
strings inside roles and texts get a backslash after their first character, and a
backslash is doubled, so that only the template's own marks read as marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: Whatever a chat template may take for a mark: "<|", "<s>", "</s>", "[INST]", "[/INST]",
#: "<<SYS>>" and "<</SYS>>".
CONTROL = r"([<\[])(\||/?s>|/?INST\]|<?/?SYS>>)"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def paths(messages: DataFrame) -> DataFrame:
    """Every message on every root-to-leaf path: (tree, leaf, message, steps to the leaf).

    ``messages`` has tree, message and parent (null: a root). A parent that is not there
    makes a root too; messages whose ancestors run in a circle have no root and are on no
    path. Steps are doubled in every round, so a path of n messages takes log2(n) rounds.
    """
    links = messages.select("tree", "message", "parent").distinct()
    known = links.select("tree", F.col("message").alias("parent")).distinct()
    linked = links.where("parent IS NOT NULL").join(known, ["tree", "parent"], "left_semi")
    jumps = stored(linked.select("tree", "message", F.col("parent").alias("ancestor")))
    parents = jumps.select("tree", F.col("ancestor").alias("leaf")).distinct()
    nodes = known.withColumnRenamed("parent", "leaf")
    found = stored(
        nodes.join(parents, ["tree", "leaf"], "left_anti").select(
            "tree", "leaf", F.col("leaf").alias("message"), F.lit(0).cast("long").alias("steps")
        )
    )
    step, most = 1, nodes.count()
    while not jumps.isEmpty():
        if step > most:  # what is left runs in circles
            found = found.join(
                jumps.select("tree", "message").distinct(), ["tree", "message"], "left_anti"
            )
            break
        further = found.join(jumps, ["tree", "message"]).select(
            "tree", "leaf", F.col("ancestor").alias("message"), (F.col("steps") + step).alias("steps")
        )
        found = stored(found.unionByName(further))
        onward = jumps.select("tree", F.col("message").alias("ancestor"), F.col("ancestor").alias("beyond"))
        jumps = stored(
            jumps.join(onward, ["tree", "ancestor"]).select(
                "tree", "message", F.col("beyond").alias("ancestor")
            )
        )
        step *= 2
    return found


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The ``branches`` best paths of each tree: (tree, leaf, branch, message, steps).

    Branches are ranked by the mean score of their messages (null counts 0), then by
    length, longer first, then by leaf.
    """
    found = paths(messages)
    scores = messages.groupBy("tree", "message").agg(F.max("score").alias("score"))
    ranked = (
        found.join(scores, ["tree", "message"])
        .groupBy("tree", "leaf")
        .agg(F.avg(F.coalesce("score", F.lit(0.0))).alias("score"), F.count("*").alias("turns"))
    )
    order = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("turns"), "leaf")
    ranked = ranked.withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= branches)
    return found.join(ranked.select("tree", "leaf", "branch"), ["tree", "leaf"])


def as_messages(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as reply trees of one branch each.

    Rows stand by turn, then role and text; every row is a turn, equal ones too. Rows
    of a null conversation belong to none and are left out.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = F.row_number().over(order)
    rows = turns.where("conv_id IS NOT NULL").withColumn("message", place)
    return rows.select(
        F.col("conv_id").alias("tree"),
        "message",
        F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def format_chats(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The best branches of every reply tree, each as one text.

    ``messages``: tree, message, parent, role, text, score; other columns are ignored.
    Tree and message must name a message; rows equal in both are one message, of which
    the first by role and text stays. Null roles and texts are empty. Returns tree,
    branch, n_turns, formatted and learn, an array of (start, length) in code points of
    the escaped assistant texts inside ``formatted``.
    """
    kept = messages.where("tree IS NOT NULL AND message IS NOT NULL")
    said = kept.groupBy("tree", "message").agg(
        F.min(
            F.struct(
                F.coalesce("role", F.lit("")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text"),
            )
        ).alias("said")
    )
    chosen = best_paths(kept, branches).join(said, ["tree", "message"])
    turn = F.struct((-F.col("steps")).alias("place"), "said.role", "said.text")
    turns = F.sort_array(F.collect_list(turn)).alias("turns")
    chats = chosen.groupBy("tree", "branch").agg(turns)
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT)).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == LEARNED_ROLE).alias("learn"),
        ),
    )
    chats = chats.select("tree", "branch", F.size("turns").cast("long").alias("n_turns"), pieces.alias("pieces"))
    sized = F.transform(
        "pieces",
        lambda p: F.struct(
            F.length(p["head"]).alias("head"), F.length(p["body"]).alias("body"), p["learn"].alias("learn")
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.expr("CAST(array() AS array<struct<start: int, length: int>>)").alias("spans"))

    def step(done: Column, piece: Column) -> Column:
        begin = done["at"] + piece["head"]
        span = F.array(F.struct(begin.alias("start"), piece["body"].alias("length")))
        spans = F.when(piece["learn"], F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct((begin + piece["body"] + len(END)).alias("at"), spans.alias("spans"))

    whole = F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END)))
    return chats.select(
        "tree",
        "branch",
        "n_turns",
        F.concat_ws("", whole).alias("formatted"),
        F.aggregate(sized, start, step)["spans"].alias("learn"),
    )


def read_turns(formatted: Column) -> Column:
    """Turns of a formatted text as an array of (role, text)."""
    pattern = r"(?s)<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n"
    roles = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(1))
    texts = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(2))
    return F.zip_with(
        roles, texts, lambda r, t: F.struct(unescape(r).alias("role"), unescape(t).alias("text"))
    )


def read_learned(formatted: Column, learn: Column) -> Column:
    """The text under the mask, unescaped, nothing between its parts."""
    parts = F.transform(learn, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))
    return F.concat_ws("", parts)
