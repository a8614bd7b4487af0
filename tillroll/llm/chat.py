r"""Conversations as chat text, one training example for each assistant turn.

Fixed values of the template, by role, around the escaped text:

    start of every example   <s>
    system                   <<SYS>> TEXT <</SYS>>
    user                     [INST] TEXT [/INST]
    assistant                one space, TEXT, </s>
    any other role           [ROLE] ROLE [/ROLE] TEXT</s>

Escaping puts one more backslash after the first character of every control
string in a text, of `[INST]` and of an escaped `[\INST]` alike; unescaping takes
one away. So no control string is left in a text and every text comes back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_REST = r"(/?s>|/?INST\]|/?ROLE\]|</?SYS>>)"
_TURN = (
    r"(?s)\[INST\] .*? \[/INST\]|<<SYS>> .*? <</SYS>>|\[ROLE\] .*? \[/ROLE\] .*?</s>| .*?</s>"
)
START = "<s>"


def escape(text: Column) -> Column:
    """Text without control strings."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _REST, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """The text that escape was given."""
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _REST, "$1$2$3")


def _opening(role: Column) -> Column:
    other = F.concat(F.lit("[ROLE] "), escape(role), F.lit(" [/ROLE] "))
    return (
        F.when(role == "user", "[INST] ").when(role == "system", "<<SYS>> ").when(role == "assistant", " ").otherwise(other)
    )


def _closing(role: Column) -> Column:
    return F.when(role == "user", " [/INST]").when(role == "system", " <</SYS>>").otherwise("</s>")


def chat_examples(frame: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows conv, example (from 0), text, loss_start, loss_end: places in text from 0, the end excluded.

    Each assistant turn gives one example: the conversation up to this reply,
    of which only the reply's own text is to be trained on. Turns after the last
    reply, or a conversation without one, give one more example with an empty
    loss span, so that no turn is lost.

    Null roles and texts count as empty ones. Turns of equal number go by role
    and text; repeated rows are turns of their own; a null conversation is one
    conversation, null turns go first. Other columns are left out. Shuffled are
    the turns, once; a conversation, being one training text, must fit into a
    string.
    """
    own = frame.select(
        F.col(conv),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("_turn"),
    )
    turns = own.groupBy(conv).agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    formatted = turns.select(
        conv,
        F.transform(
            "_turns",
            lambda t: F.struct(
                (t["role"] == "assistant").alias("reply"),
                _opening(t["role"]).alias("opening"),
                escape(t["text"]).alias("text"),
                _closing(t["role"]).alias("closing"),
            ),
        ).alias("_turns"),
    )
    # Where each turn ends, from running lengths.
    spans = F.aggregate(
        F.transform("_turns", lambda t: F.struct(t["reply"], *(F.length(t[x]).alias(x) for x in ("opening", "text", "closing")))),
        F.struct(F.lit(len(START)).alias("end"), F.array().cast("array<struct<reply:boolean,start:int,stop:int,end:int>>").alias("spans")),
        lambda seen, t: F.struct(
            (seen["end"] + t["opening"] + t["text"] + t["closing"]).alias("end"),
            F.array_append(
                seen["spans"],
                F.struct(
                    t["reply"].alias("reply"),
                    (seen["end"] + t["opening"]).alias("start"),
                    (seen["end"] + t["opening"] + t["text"]).alias("stop"),
                    (seen["end"] + t["opening"] + t["text"] + t["closing"]).alias("end"),
                ),
            ).alias("spans"),
        ),
        lambda seen: seen["spans"],
    )
    whole = F.concat(F.lit(START), F.array_join(F.transform("_turns", lambda t: F.concat(t["opening"], t["text"], t["closing"])), ""))
    placed = formatted.select(conv, whole.alias("_whole"), spans.alias("_spans"))
    wanted = F.filter("_spans", lambda s, i: s["reply"] | (i == F.size("_spans") - 1))
    examples = placed.select(conv, "_whole", F.posexplode(wanted).alias("example", "_span"))
    return examples.select(
        conv,
        "example",
        F.substring(F.col("_whole"), F.lit(1), F.col("_span.end")).alias("text"),
        F.when(F.col("_span.reply"), F.col("_span.start")).otherwise(F.col("_span.end")).alias("loss_start"),
        F.when(F.col("_span.reply"), F.col("_span.stop")).otherwise(F.col("_span.end")).alias("loss_end"),
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text, an array of (role, text)."""
    def parsed(piece: Column) -> Column:
        def inside(before: Column | int, after: int) -> Column:
            start = before + 1 if isinstance(before, Column) else F.lit(before + 1)
            return F.substring(piece, start, F.length(piece) - start + 1 - after)

        role_end = F.locate(" [/ROLE] ", piece)
        other = piece.startswith("[ROLE] ")
        role = (
            F.when(piece.startswith("[INST] "), "user")
            .when(piece.startswith("<<SYS>> "), "system")
            .when(other, unescape(F.substring(piece, F.lit(8), role_end - 8)))
            .otherwise("assistant")
        )
        words = (
            F.when(piece.startswith("[INST] "), inside(7, 8))
            .when(piece.startswith("<<SYS>> "), inside(8, 9))
            .when(other, inside(role_end + 8, 4))
            .otherwise(inside(1, 4))
        )
        return F.struct(role.alias("role"), unescape(words).alias("text"))

    pieces = F.regexp_extract_all(F.substring(text, F.lit(len(START) + 1), F.length(text)), F.lit(_TURN), F.lit(0))
    return F.transform(pieces, parsed)


def read_back(examples: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What the examples of each conversation say, from their texts and loss spans alone.

    n_turns and turns_sha256 (role, line feed, text, line feed for every turn)
    from the longest example; loss_chars and loss_sha256 of the trained texts in
    order; formatted_chars of all examples together.
    """
    loss = unescape(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    gathered = (
        examples.select(conv, "example", "text", loss.alias("_loss"))
        .groupBy(conv)
        .agg(
            F.max_by("text", "example").alias("_whole"),
            F.sort_array(F.collect_list(F.struct("example", "_loss"))).alias("_losses"),
            F.sum(F.length("text").cast("long")).alias("formatted_chars"),
        )
    )
    turns = gathered.select(
        conv,
        read_turns(F.col("_whole")).alias("_turns"),
        F.array_join(F.transform("_losses", lambda x: x["_loss"]), "").alias("_loss"),
        "formatted_chars",
    )
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        conv,
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
