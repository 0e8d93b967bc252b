r"""Chat formatting: every assistant turn becomes its own example.

An example is the formatted text of all turns up to and including one assistant
turn; only that reply is trainable, given by ``loss_start`` / ``loss_chars``
(code points, 0-based).  Turns after the last assistant turn, and conversations
without one, give one more example with no trainable text, so that nothing of a
conversation is lost.

Template of a turn: ``<s>[INST] role [/INST]text</s>``.  Control strings inside
roles and texts are escaped reversibly: a backslash is doubled, and ``<`` or
``[`` that opens a control string gets a backslash behind it; removing the
backslash before any character restores the text.

Turns are ordered by turn, then role, then text (so ties and repeated rows have
one order and all count); null role or text is empty; rows with a null
conversation id form one conversation.  An empty table gives no examples; other
columns are ignored.  One conversation is one row, as a document is; the
examples of n turns hold O(n^2) text, which is what prefix-target examples are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MID, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
#: What a text must not hold as it is; after its first character goes a backslash.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for word in CONTROL:
        c = F.replace(c, F.lit(word), F.lit(word[0] + "\\" + word[1:]))
    return c


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def format_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role), F.lit(MID), escape(text), F.lit(CLOSE))


def chat_examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text",
                  assistant: str = "assistant") -> DataFrame:
    """Rows (conversation, ``example``, ``formatted``, ``loss_start``, ``loss_chars``).

    ``loss_chars`` counts escaped code points; it is null where nothing is trained.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    convs = (turns.select(F.col(conv_col).alias("_conv"),
                          F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
                                   format_turn(role, text).alias("out"),
                                   F.char_length(escape(role)).alias("role_chars"),
                                   F.char_length(escape(text)).alias("text_chars")).alias("_t"))
             .groupBy("_conv").agg(F.sort_array(F.collect_list("_t")).alias("_turns")))
    n = F.size("_turns")
    replies = F.filter(F.sequence(F.lit(1), n), lambda i: F.get(F.col("_turns"), i - 1)["role"] == assistant)
    ends = (convs.withColumn("_replies", replies)
            .withColumn("_ends", F.when(F.coalesce(F.array_max("_replies"), F.lit(0)) < n,
                                        F.concat("_replies", F.array(n))).otherwise(F.col("_replies")))
            .select("_conv", "_turns", "_replies", F.posexplode("_ends").alias("example", "_end")))
    prefix = F.slice("_turns", 1, F.col("_end"))
    last = F.get(F.col("_turns"), F.col("_end") - 1)
    trained = F.array_contains("_replies", F.col("_end"))
    full = F.array_join(F.transform(prefix, lambda t: t["out"]), "")
    out = ends.select("_conv", "example", full.alias("formatted"), trained.alias("_trained"),
                      last["text_chars"].alias("_n"))
    start = F.char_length("formatted") - len(CLOSE) - F.col("_n")
    return out.select(F.col("_conv").alias(conv_col), "example", "formatted",
                      F.when(F.col("_trained"), start).alias("loss_start"),
                      F.when(F.col("_trained"), F.col("_n")).alias("loss_chars"))


def parse_formatted(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted example."""
    turns = F.filter(F.split(formatted, CLOSE, -1), lambda t: F.char_length(t) > 0)
    shape = r"(?s)^<s>\[INST\] (.*?) \[/INST\](.*)$"
    return F.transform(turns, lambda t: F.struct(
        unescape(F.regexp_extract(t, shape, 1)).alias("role"),
        unescape(F.regexp_extract(t, shape, 2)).alias("text")))


def trained_text(formatted: Column, loss_start: Column, loss_chars: Column) -> Column:
    """The text under the loss mask, unescaped; empty where nothing is trained."""
    return F.coalesce(unescape(F.substr(formatted, loss_start + 1, loss_chars)), F.lit(""))
