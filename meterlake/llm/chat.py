"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Each assistant turn is an example of its own: all turns before it are the context, and only the text
of the reply is trainable. A conversation that does not end with the assistant has one more example
without a target, so that no turn is lost.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line feed. In roles and texts a backslash
becomes two and ``<|`` becomes ``<\\|``; so no control string can stand inside a turn, and taking a
backslash from each pair undoes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def training_examples(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, target, n_context, prompt, completion, loss_start, loss_chars): the example's text is prompt + completion.

    ``target`` is the position of the reply among the turns, from 0; an example without one has it null,
    an empty completion and no loss. The loss mask is ``loss_chars`` code points from ``loss_start`` (1-based)
    of the example's text. Null roles and texts are empty; null turns come first; equal turn numbers are
    ordered by role and text, and repeated rows stay. A row with a null id is a conversation of its own.

    The turns of a conversation are held by one task, once for each of its replies while that example is made: the examples
    of a conversation grow with the square of its length, by the method.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    given = conversations.select(F.col(conv_col).alias("conv_id"), turn.alias("t"))
    named = given.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    nameless = F.lit(None).cast(given.schema["conv_id"].dataType).alias("conv_id")
    whole = named.unionByName(given.filter("conv_id IS NULL").select(nameless, F.array("t").alias("turns")))
    spell = lambda t: F.concat(F.lit(START), escaped(t.role), F.lit(MIDDLE), escaped(t.text), F.lit(END + "\n"))
    header = START + ASSISTANT + MIDDLE
    n = F.size("turns")
    replies = F.filter(F.transform("turns", lambda t, i: F.when(t.role == ASSISTANT, i)), lambda i: i.isNotNull())
    spoken = whole.select(
        "conv_id",
        F.transform("turns", spell).alias("pieces"),
        # the places of the replies, and the end where no reply is last
        F.when(F.element_at("turns", -1).role == ASSISTANT, replies).otherwise(F.concat(replies, F.array(n))).alias("at"),
    )
    single = spoken.withColumn("at", F.explode("at"))
    at = F.col("at")
    is_reply = at < F.size("pieces")
    return single.select(
        "conv_id",
        F.when(is_reply, at).alias("target"),
        at.alias("n_context"),
        F.concat(F.array_join(F.slice("pieces", F.lit(1), at), ""), F.when(is_reply, F.lit(header)).otherwise("")).alias("prompt"),
        F.coalesce(F.expr(f"substring(get(pieces, at), {len(header) + 1})"), F.lit("")).alias("completion"),
    ).select(
        "*",
        F.when(F.col("target").isNotNull(), F.length("prompt") + 1).alias("loss_start"),
        F.greatest(F.length("completion") - len(END) - 1, F.lit(0)).alias("loss_chars"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            unescaped(F.substring_index(p, MIDDLE, 1)).alias("role"),
            unescaped(F.substring_index(F.substring_index(p, MIDDLE, -1), END, 1)).alias("text"),
        ),
    )


def digests(examples: DataFrame) -> DataFrame:
    """What the examples of each conversation hold, read back from their texts.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples); the turns come from
    the longest example, the loss from the masked text of every example, and ``formatted_chars`` sums all of them.
    """
    text = F.concat("prompt", "completion")
    masked = F.coalesce(unescaped(text.substr(F.col("loss_start"), F.col("loss_chars"))), F.lit(""))
    read = examples.select("conv_id", "n_context", text.alias("formatted"), masked.alias("loss"))
    named = read.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(
        F.max_by("formatted", "n_context").alias("longest"),
        F.array_sort(F.collect_list(F.struct("n_context", "loss"))).alias("losses"),
        F.sum(F.length("formatted")).alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_examples"),
    )
    # a conversation without an id is one turn and so one example
    nameless = read.filter("conv_id IS NULL").select(
        "conv_id", F.col("formatted").alias("longest"), F.array(F.struct("n_context", "loss")).alias("losses"),
        F.length("formatted").cast("long").alias("formatted_chars"), F.lit(1).cast("long").alias("n_examples"),
    )
    per_conversation = named.unionByName(nameless).select(
        "*", read_turns(F.col("longest")).alias("turns"), F.array_join(F.col("losses.loss"), "").alias("loss")
    )
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return per_conversation.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long"),
        F.col("n_examples").cast("long"),
    )
