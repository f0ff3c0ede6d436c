"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted, merged into blocks of adjacent turns of one role by an
array aggregation, and concatenated. The template:

    [INST] user text [/INST]      [OUT] assistant text </s>      [ROLE] any role [SAYS] text [END]

Texts of one block are joined by `` [NEXT] ``. A control string inside a text gets a backslash ahead of it; a
true control string always follows a space, an escaped one never does, so the output can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"<s>|</s>|\[/?INST\]|\[OUT\]|\[ROLE\]|\[SAYS\]|\[END\]|\[NEXT\]"
HEADS = {"user": "[INST] ", "assistant": "[OUT] "}
TAILS = {"user": " [/INST]", "assistant": " </s>"}
NEXT = " [NEXT] "
SAYS = " [SAYS] "


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"({CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\({CONTROL})", "$1")


def _merge(blocks: Column, turn: Column) -> Column:
    last = F.element_at(blocks, -1)
    text = F.array(turn["text"])
    joined = F.struct(last["role"].alias("role"), F.concat(last["texts"], text).alias("texts"))
    return F.when(
        (F.size(blocks) > 0) & (F.get(blocks, F.size(blocks) - 1)["role"] == turn["role"]),
        F.concat(F.slice(blocks, 1, F.size(blocks) - 1), F.array(joined)),
    ).otherwise(F.concat(blocks, F.array(F.struct(turn["role"].alias("role"), text.alias("texts")))))


def _parts(block: Column) -> Column:
    """The block's pieces of output with whether each is under the loss mask."""
    role = block["role"]
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    other = F.concat(F.lit("[ROLE] "), escape(role), F.lit(SAYS))
    head = F.when(role == "user", HEADS["user"]).when(role == "assistant", HEADS["assistant"]).otherwise(other)
    tail = F.when(role == "user", TAILS["user"]).when(role == "assistant", TAILS["assistant"]).otherwise(" [END]")
    body = F.transform(
        block["texts"],
        lambda text, i: F.array(
            part(F.when(i > 0, NEXT).otherwise(head), F.lit(False)), part(escape(text), role == "assistant")
        ),
    )
    return F.concat(F.flatten(body), F.array(part(tail, F.lit(False))))


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, parts``: the chat as one string, and its pieces in order with their loss flag.

    Reads ``conv_id, turn, role, text`` only, so further columns of any name do no harm. Null role and text count
    as empty; rows without conv_id form one conversation; a null turn comes first; ties of turn go by role, then
    text; repeated rows are repeated turns. No rows give no chats.
    """
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("said"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    none = F.expr("cast(array() as array<struct<role: string, texts: array<string>>>)")
    chats = chats.select("conv_id", F.aggregate("said", none, _merge).alias("blocks"))
    chats = chats.select("conv_id", F.flatten(F.transform("blocks", _parts)).alias("parts"))
    return chats.select("conv_id", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("formatted"), "parts")


def read_back(formatted: Column) -> Column:
    """The turns of a formatted chat as an array of ``role, text``."""
    ends = r"(?<= \[/INST\])|(?<= </s>)|(?<= \[END\])"
    pieces = F.filter(F.split(formatted, ends), lambda p: p != "")

    def inner(piece, skip, tail):
        return F.substring(piece, skip + 1, F.length(piece) - skip - len(tail))

    def texts(body):
        return F.transform(F.split(body, r" \[NEXT\] "), unescape)

    def turns(piece):
        user = inner(piece, F.lit(len(HEADS["user"])), TAILS["user"])
        assistant = inner(piece, F.lit(len(HEADS["assistant"])), TAILS["assistant"])
        other = inner(piece, F.lit(len("[ROLE] ")), " [END]")
        role = F.substring_index(other, SAYS, 1)
        spoken = F.substring(other, F.length(role) + len(SAYS) + 1, F.length(other))
        block = (
            F.when(piece.startswith(HEADS["user"]), F.struct(F.lit("user").alias("role"), texts(user).alias("texts")))
            .when(
                piece.startswith(HEADS["assistant"]),
                F.struct(F.lit("assistant").alias("role"), texts(assistant).alias("texts")),
            )
            .otherwise(F.struct(unescape(role).alias("role"), texts(spoken).alias("texts")))
        )
        return F.transform(
            block["texts"], lambda text: F.struct(block["role"].alias("role"), text.alias("text"))
        )

    return F.flatten(F.transform(pieces, turns))


def digests(chats: DataFrame) -> DataFrame:
    """What the output says, read back from it: the contract's columns."""
    turns = read_back(F.col("formatted"))
    loss = F.transform(F.filter("parts", lambda p: p["loss"]), lambda p: unescape(p["text"]))
    told = chats.select("conv_id", "formatted", turns.alias("turns"), F.array_join(loss, "").alias("loss"))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return told.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
