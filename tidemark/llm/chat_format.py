"""Chat formatting with built-in expressions: a role automaton, a declarative template, loss flags."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Allowed next roles by current role; "" is the start.
TURNS = {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}


@dataclass(frozen=True)
class ChatTemplate:
    """``open`` + role + ``head`` + text + ``close`` for every turn; ``learn`` names the roles under the loss.

    All markers begin with ``<|``.  Inside texts and roles a ``<`` that is followed by any
    number of backslashes and a bar gets one backslash more, so that no marker can occur there;
    taking one backslash away again restores the text exactly.
    """

    open: str = "<|im_start|>"
    head: str = "\n"
    close: str = "<|im_end|>\n"
    learn: tuple[str, ...] = ("assistant",)


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    """As :func:`escape`; besides, a line break becomes ``<N`` (and ``<\\*N`` gets one backslash more)."""
    return F.replace(F.regexp_replace(escape(c), r"<(\\*)N", r"<\\$1N"), F.lit("\n"), F.lit("<N"))


def unescape_role(c: Column) -> Column:
    return unescape(F.regexp_replace(F.replace(c, F.lit("<N"), F.lit("\n")), r"<\\(\\*)N", r"<$1N"))


def automaton(roles: Column, turns: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Last state after reading the roles; ``error`` once a role may not follow the one before."""
    turns = turns or TURNS

    def step(state: Column, role: Column) -> Column:
        out = F.lit("error")
        for now, following in turns.items():
            out = F.when((state == now) & role.isin(*following), role).otherwise(out)
        return out

    return F.aggregate(roles, F.lit(""), step)


def format_chats(rows: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """One row per conversation: ``conv_id``, ``n_turns``, ``valid``, ``formatted``, ``segments``.

    ``segments`` is an array of (text, loss) in output order whose texts concatenate to
    ``formatted``; loss is true for the text of turns by a role of ``template.learn``, never
    for the markup around it.  ``valid`` says whether the automaton accepts the role order
    and the conversation ends with an assistant turn; invalid conversations are formatted too.

    Turns go by ``turn`` (nulls first), ties by role and text, so repeated rows stay repeated
    turns.  A null text is empty, a null role is the empty role (invalid).  Rows with a null
    ``conv_id`` form one conversation of their own.  Other columns are not read.
    """
    t = template or ChatTemplate()
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    turn = F.struct(F.col("turn"), role.alias("role"), text.alias("text"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def parts(x: Column) -> Column:
        piece = lambda value, loss: F.struct(value.alias("text"), loss.alias("loss"))
        off = F.lit(False)
        return F.array(
            piece(F.concat(F.lit(t.open), escape_role(x["role"]), F.lit(t.head)), off),
            piece(escape(x["text"]), x["role"].isin(*t.learn)),
            piece(F.lit(t.close), off),
        )

    segments = F.flatten(F.transform("turns", parts))
    return chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        (automaton(F.col("turns.role")) == "assistant").alias("valid"),
        F.array_join(F.transform(segments, lambda s: s["text"]), "").alias("formatted"),
        segments.alias("segments"),
    )


def read_back(chats: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """Parse ``formatted`` again: adds ``turns_back``, an array of (role, text) as they came in."""
    t = template or ChatTemplate()
    blocks = F.filter(F.split("formatted", F.lit(rf"\Q{t.open}\E"), -1), lambda x: x != "")

    def turn(x: Column) -> Column:
        cut = F.locate(t.head, x)  # roles hold no line break
        end = F.length(x) - len(t.close)
        return F.struct(
            unescape_role(F.substring(x, F.lit(1), cut - 1)).alias("role"),
            unescape(F.substring(x, cut + len(t.head), end - cut - len(t.head) + 1)).alias("text"),
        )

    return chats.withColumn("turns_back", F.transform(blocks, turn))
