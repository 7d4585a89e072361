"""Chat formatting by a declarative template: role automaton, segments, loss flags.

Everything is a column expression. A template names the control strings, the automaton over roles
and the roles whose texts are learned. ``format_conversations`` turns rows by turn into one row per
conversation with its segments (text and loss flag), and ``read_back`` recovers the turns and the
learned text from that output alone.

Escaping: wherever a text holds ``<``, any number of ``~``, and ``|``, one more ``~`` is put before
the bar. So ``<|`` only ever begins a control string, and taking one ``~`` off restores the text.
A line break inside a role is written as its own control string.

Cases: null text and null role count as empty; turns are ordered by (turn, role, text), a null turn
first, so ties and repeated rows have one result and are all kept; a null conversation id is a
conversation of its own; turn orders that the automaton refuses are formatted all the same and
reported (``valid`` false, ``first_bad`` the 0-based position); empty tables give empty tables; other
columns are not read. One conversation is one output row, so its text must fit into one row; work
on the texts is done before turns are brought together.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``moves`` lists, per state, the roles that may follow; a state is the last role."""

    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>\n"
    role_break: str = "<|br|>"
    start: str = ""
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    learned: tuple[str, ...] = ("assistant",)


CHAT = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(~*)\|", "<$1~|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(~*)~\|", "<$1|")


def _escape_role(role: Column, template: Template) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(template.role_break))


def _unescape_role(role: Column, template: Template) -> Column:
    return unescape(F.replace(role, F.lit(template.role_break), F.lit("\n")))


def _allowed(template: Template, state: Column, role: Column) -> Column:
    """Whether the automaton moves from ``state`` on ``role``."""
    allowed = F.lit(False)
    for source, roles in template.moves.items():
        allowed = allowed | ((state == source) & role.isin(*roles))
    return allowed


def _first_bad(template: Template, roles: Column) -> Column:
    """Position of the first refused role, or null."""
    previous = F.concat(F.array(F.lit(template.start)), roles)
    steps = F.zip_with(
        roles, F.slice(previous, 1, F.size(roles)), lambda role, state: _allowed(template, state, role)
    )
    return F.nullif(F.array_position(steps, False) - 1, F.lit(-1).cast("long"))


def format_conversations(
    turns: DataFrame,
    template: Template = CHAT,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, segments array<struct<text, loss>>, valid, first_bad)."""
    who, said = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    parts = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            who.alias("role"),
            said.alias("raw"),
            F.array(
                F.struct(
                    F.concat(
                        F.lit(template.opening), _escape_role(who, template), F.lit("\n")
                    ).alias("text"),
                    F.lit(False).alias("loss"),
                ),
                F.struct(
                    escape(said).alias("text"), who.isin(*template.learned).alias("loss")
                ),
                F.struct(F.lit(template.closing).alias("text"), F.lit(False).alias("loss")),
            ).alias("segments"),
        ).alias("part"),
    )
    grouped = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("part"))
    return (
        grouped.withColumn("first_bad", _first_bad(template, F.col("part.role")))
        .withColumn("segments", F.flatten(F.col("part.segments")))
        .select("conv_id", "segments", F.col("first_bad").isNull().alias("valid"), "first_bad")
    )


def rendered(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def read_back(formatted: Column, segments: Column, template: Template = CHAT) -> tuple[Column, Column]:
    """Turns (array of role, text) parsed from the formatted string; the learned text.

    ``formatted`` is the rendered string; the loss mask is read from the segments.
    """
    blocks = F.split(formatted, F.lit(template.opening.replace("|", r"\|")))
    blocks = F.slice(blocks, 2, F.greatest(F.size(blocks) - 1, F.lit(0)))
    turns = F.transform(
        blocks,
        lambda b: F.struct(
            _unescape_role(F.substring_index(b, "\n", 1), template).alias("role"),
            unescape(
                F.substring(
                    b,
                    F.locate("\n", b) + 1,
                    F.char_length(b) - F.locate("\n", b) - F.lit(len(template.closing)),
                )
            ).alias("text"),
        ),
    )
    learned = F.array_join(
        F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), ""
    )
    return turns, learned
