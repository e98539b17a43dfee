"""Chat formatting by prefix-target expansion, in DataFrame operations only.

Every assistant turn becomes its own training example: its text is all turns
before it as context, then the reply, and only the reply is trainable. Each
example row holds this whole text, so the output grows with the square of a
conversation's turns. Turns after the last reply close the conversation in an
example without a target, so the last example holds the whole conversation.

The expansion happens inside tasks: the turns of a conversation are gathered
per block of examples, with the turns before the block as their common prefix, and a
task writes out one example after the other. A conversation of one block is
shuffled once; with more blocks the prefix goes to each of them. ``segment``
is the part of a text that the example before it does not have.

A turn is written ``<|turn|>role<|says|>text<|end|>``. In roles and texts a
backslash is doubled and every control string gets a backslash after its first
character, so no control string survives inside a text; removing each
backslash and keeping the character after it restores the original.

Defined results: null role or text counts as empty; rows of one conversation
are ordered by (turn, role, text) with nulls first, so repeated turns stay in
a fixed order and are all kept; a null conversation id is a conversation of its
own; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The markers of this template and control strings of common templates.
TURN, SAYS, END = "<|turn|>", "<|says|>", "<|end|>"
CONTROL = ("<|", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>")
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _expanded(gathered: DataFrame) -> DataFrame:
    """One row per example, each with all turns before it, from the turns gathered per block of examples.

    Only the pieces of a block are held at once: the exploded rows are written out one by one.
    """
    g = gathered.select(
        "conv_id", F.array_join(F.filter("turns", lambda x: ~x["own"])["rendered"], "").alias("prefix"),
        F.filter("turns", lambda x: x["own"]).alias("turns"))
    g = g.select("conv_id", "prefix", F.col("turns.rendered").alias("pieces"), F.filter(
        F.transform("turns", lambda x, i: F.struct(
            x["reply"].alias("reply"), x["complete"].alias("complete"), x["example_no"].alias("example_no"),
            x["end"].alias("end"), x["body_chars"].alias("body_chars"), (i + 1).alias("n_pieces"))), lambda x: x["reply"] | x["complete"]).alias("closing"),
        (F.col("turns")[0]["end"] - F.col("turns")[0]["chars"]).alias("first"))
    g = g.select("conv_id", "prefix", "pieces", "first", "closing.end", F.posexplode("closing").alias("at", "x"))
    g = g.select(
        "conv_id", F.col("x.example_no").alias("example_no"), F.col("x.reply").alias("has_target"),
        F.concat("prefix", F.array_join(F.slice("pieces", F.lit(1), F.col("x.n_pieces")), "")).alias("text"),
        F.when(F.col("at") == 0, F.col("first")).otherwise(F.get("end", F.col("at") - 1)).alias("segment_start"),
        F.col("x.end").alias("full_chars"), F.col("x.body_chars").alias("body_chars"), F.col("x.complete").alias("complete"))
    loss_end = F.when(F.col("has_target"), F.col("full_chars") - len(END))
    return g.select("conv_id", "example_no", "has_target", "text",
                    F.col("text").substr((F.col("segment_start") + 1).cast("int"),
                                         (F.col("full_chars") - F.col("segment_start")).cast("int")).alias("segment"),
                    "segment_start", "full_chars", (loss_end - F.col("body_chars")).alias("loss_start"),
                    loss_end.alias("loss_end"), "complete")


def format_examples(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text", block_turns: int = 512, block_examples: int = 256) -> DataFrame:
    """Examples of all conversations: conv_id, example_no (from 1), has_target, text (the whole
    example), segment, segment_start, full_chars (length of the text), loss_start and loss_end
    (the reply within the text; both null without a target), complete (the conversation's last example).

    Running counts and lengths of a conversation come from sums per block of
    ``block_turns`` turn numbers, and its examples are written out in blocks of ``block_examples``,
    so a conversation that holds a large share of all rows is spread over many tasks.
    """
    t = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    t = t.select(
        "conv_id", "turn", "role", F.floor(F.col("turn") / block_turns).alias("block"),
        (F.col("role") == ASSISTANT).cast("int").alias("reply"), F.col("text").alias("raw"),
        F.concat(F.lit(TURN), escape(F.col("role")), F.lit(SAYS)).alias("head"), escape(F.col("text")).alias("body"))
    t = t.withColumn("chars", F.length("head") + F.length("body") + F.lit(len(END)))
    blocks = t.groupBy("conv_id", "block").agg(F.sum("chars").alias("chars"), F.sum("reply").alias("replies"))
    whole = Window.partitionBy("conv_id").orderBy(F.col("block").asc_nulls_first())
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    total = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        F.col("conv_id").alias("b_conv"), F.col("block").alias("b_block"),
        F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum("replies").over(before), F.lit(0)).alias("replies_before"),
        F.sum("chars").over(total).alias("all_chars"), F.sum("replies").over(total).alias("all_replies"))
    t = t.join(blocks, F.col("conv_id").eqNullSafe(F.col("b_conv")) & F.col("block").eqNullSafe(F.col("b_block")))
    inside = Window.partitionBy("conv_id", "block").orderBy(
        F.col("turn").asc_nulls_first(), "role", "raw").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.select(
        "conv_id", "reply", F.length("body").alias("body_chars"), F.concat("head", "body", F.lit(END)).alias("rendered"),
        (F.col("chars_before") + F.sum("chars").over(inside)).alias("end"), "chars", "all_chars", "all_replies",
        (F.col("replies_before") + F.sum("reply").over(inside) - F.col("reply") + 1).alias("example_no"))
    # A turn goes to the block of its example and, as context, to all later blocks of the conversation.
    own = F.floor((F.col("example_no") - 1) / block_examples)
    t = t.withColumn("own", own).withColumn("part", F.explode(F.sequence(
        F.col("own"), F.floor(F.col("all_replies") / block_examples))))
    g = t.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct(
        "end", (F.col("own") == F.col("part")).alias("own"), (F.col("end") == F.col("all_chars")).alias("complete"),
        (F.col("reply") == 1).alias("reply"), "body_chars", "example_no", "chars", "rendered"))).alias("turns"))
    return _expanded(g)


def full_texts(examples: DataFrame, block_examples: int = 64) -> DataFrame:
    """Write ``text`` from the segments alone: each example with all its context, for examples kept without their texts.

    The result is as large as the expansion itself (quadratic in the turns of a
    conversation); select the examples wanted first where that matters, keeping
    the earlier segments of their conversations. Examples are joined to segments by
    block of ``block_examples`` numbers, so that many tasks write a long conversation.
    """
    examples = examples.drop("text")
    block = F.floor(F.col("example_no") / block_examples)
    last = examples.groupBy(F.col("conv_id").alias("l_conv")).agg(F.max(block).alias("last"))
    parts = examples.join(last, F.col("conv_id").eqNullSafe(F.col("l_conv"))).select(
        F.col("conv_id").alias("p_conv"), F.col("example_no").alias("p_no"), F.col("segment").alias("p_segment"),
        F.explode(F.sequence(block, F.col("last"))).alias("p_block"))
    wanted = examples.select(F.col("conv_id").alias("w_conv"), F.col("example_no").alias("w_no"), block.alias("w_block"))
    texts = wanted.join(parts, F.col("w_conv").eqNullSafe(F.col("p_conv")) & (F.col("w_block") == F.col("p_block"))
                        & (F.col("p_no") <= F.col("w_no"))).groupBy("w_conv", "w_no").agg(F.array_join(F.transform(
                            F.array_sort(F.collect_list(F.struct("p_no", "p_segment"))), lambda x: x["p_segment"]), "").alias("text"))
    return examples.join(texts, F.col("conv_id").eqNullSafe(F.col("w_conv")) & (F.col("example_no") == F.col("w_no"))).select(
        *examples.columns, "text")


def parse_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from formatted text."""
    parts = F.filter(F.split(formatted, r"<\|turn\|>"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(p, SAYS, 1)).alias("role"),
        unescape(p.substr(F.instr(p, SAYS) + len(SAYS),
                          F.length(p) - F.instr(p, SAYS) - len(SAYS) - len(END) + 1)).alias("text")))


def digest_columns(examples: DataFrame) -> DataFrame:
    """Per conversation: turn count and digests, read back from the texts of the formatted examples.

    Turns are read from the whole text of a conversation's last example, replies from under the
    loss mask of each example's text, characters from all texts. A SHA-256 runs over the replies in order, so this report
    (not the operator) brings the replies of one conversation together.
    """
    said = F.when(F.col("complete"), F.transform(parse_turns(F.col("text")), lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    mask = F.when(F.col("has_target"), unescape(F.col("text").substr(
        (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int")))).otherwise("")
    read = examples.select("conv_id", "example_no", F.length("text").cast("long").alias("chars"), said.alias("said"), mask.alias("mask"))
    read = read.select("conv_id", "example_no", "chars", F.when(F.col("said").isNotNull(), F.size("said")).alias("turns"),
                       F.sha2(F.array_join("said", ""), 256).alias("turns_sha256"), "mask")
    replies = F.array_join(F.transform(F.col("rows"), lambda r: r["mask"]), "")
    g = read.groupBy("conv_id").agg(
        F.max("turns").cast("long").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
        F.sum(F.length("mask")).cast("long").alias("loss_chars"), F.sum("chars").cast("long").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("example_no", "mask"))).alias("rows"))
    return g.select("conv_id", "n_turns", "turns_sha256", "loss_chars", F.sha2(replies, 256).alias("loss_sha256"), "formatted_chars")
