"""Chat formatting by a finite-state machine over roles and a declarative template.

All work is column expressions. A conversation is one output row: its turns are
gathered in order, its segments are an array of (text, loss), and the formatted
text is their concatenation. Inside texts and roles every control string of the
template gets an escape after its first character, so that formatted texts can
be read back exactly.

Turns are ordered by ``turn``, then role, text. Nulls: a null text or role is
empty, a null turn comes first, rows without a conversation id make one
conversation with a null id. Repeated rows are turns of their own. Conversations
whose roles break the order are formatted too, with ``valid`` false and the
number of their first wrong turn.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class ChatTemplate:
    """How turns are marked, which roles carry loss, and which role may follow which.

    A turn is ``opens + role + names_end + text + closes``. ``follows`` maps a
    state (the last role, or ``start``) to the roles allowed next; a conversation
    may end in the roles of ``ends``.
    """

    opens: str = "<|im_start|>"
    names_end: str = "\n"
    closes: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    ends: tuple[str, ...] = ("assistant",)
    #: Strings that must not appear inside a text, here and in common other templates.
    control: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    )


def escaped(text: Column, template: ChatTemplate, line_ends: bool = False) -> Column:
    """``text`` with its control strings (and line ends, for roles) broken up by escapes."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for mark in template.control:
        text = F.replace(text, F.lit(mark), F.lit(mark[0] + ESCAPE + mark[1:]))
    return F.replace(text, F.lit("\n"), F.lit(ESCAPE + "n")) if line_ends else text


def unescaped(text: Column, line_ends: bool = False) -> Column:
    """Undoes ``escaped``."""
    if line_ends:  # the escaped line end is the one escape that is not just dropped
        text = F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _first_wrong(turns: Column, template: ChatTemplate) -> Column:
    """Number (from 0) of the first turn whose role may not stand there, their count if the end is wrong, null if none."""
    def step(state: Column, turn: Column) -> Column:
        fits = F.lit(False)
        for last, roles in template.follows.items():
            fits = fits | ((state["last"] == last) & turn["role"].isin(*roles))
        wrong = F.when(state["wrong"].isNull() & ~fits, state["at"]).otherwise(state["wrong"])
        return F.struct(turn["role"].alias("last"), (state["at"] + 1).alias("at"), wrong.alias("wrong"))

    start = F.struct(
        F.lit("start").alias("last"), F.lit(0).cast("int").alias("at"), F.lit(None).cast("int").alias("wrong")
    )
    end = F.aggregate(turns, start, step)
    return F.coalesce(end["wrong"], F.when(~end["last"].isin(*template.ends), end["at"]))


def format_conversations(
    rows: DataFrame, template: ChatTemplate | None = None, id_col="conv_id", turn_col="turn", role_col="role", text_col="text"
) -> DataFrame:
    """``id_col, valid, first_wrong, segments array<struct<text, loss>>, formatted``: one row per conversation."""
    template = template or ChatTemplate()
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    grouped = rows.groupBy(F.col(id_col).alias("id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def parts(t: Column) -> Column:
        role = escaped(t["role"], template, line_ends=True)
        head = F.concat(F.lit(template.opens), role, F.lit(template.names_end))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(t["text"], template).alias("text"), t["role"].isin(*template.loss_roles).alias("loss")),
            F.struct(F.lit(template.closes).alias("text"), F.lit(False).alias("loss")),
        )

    wrong = _first_wrong(F.col("turns"), template)
    shaped = grouped.select("id", wrong.alias("first_wrong"), F.flatten(F.transform("turns", parts)).alias("segments"))
    return shaped.select(
        F.col("id").alias(id_col),
        F.col("first_wrong").isNull().alias("valid"),
        "first_wrong",
        "segments",
        F.array_join(F.col("segments.text"), "").alias("formatted"),
    )


def read_turns(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """``array<struct<role, text>>`` read from a formatted conversation."""
    template = template or ChatTemplate()
    opens, closes = template.opens, template.closes
    blocks = F.filter(F.split(formatted, rf"\Q{opens}\E", -1), lambda b, i: i > 0)

    def turn(block: Column) -> Column:
        cut = F.instr(block, template.names_end)
        role = F.substr(block, F.lit(1), cut - 1)
        start = cut + len(template.names_end)
        text = F.substr(block, start, F.length(block) - start + 1 - len(closes))
        return F.struct(unescaped(role, line_ends=True).alias("role"), unescaped(text).alias("text"))

    return F.transform(blocks, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    marked = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"]))
    return F.array_join(marked, "")
