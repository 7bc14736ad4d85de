"""Chat formatting: turn order checked by a state machine, texts with loss flags.

Everything is DataFrame functions.  A conversation becomes one training text, so
its turns are brought together in one row, in the order of turn, role and text.

Control strings cannot occur inside a text: a backslash is put behind every
escape character (the backslash and the first characters of the control
strings).  Taking it away again restores the text exactly.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """How turns are written, which of them train the model, and their legal order.

    ``labels`` names the known roles; another role is written as ``=`` and its
    name.  ``moves`` lists, for each state, the roles that may follow; the state after a
    turn is its role.  A conversation ends well in one of ``final``.
    """

    before: str = "### "
    between: str = ": "
    after: str = "</turn>\n"
    labels: dict[str, str] = field(
        default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"}
    )
    trained: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def text_escapes(self) -> str:
        """Characters that a control string may begin with, and the backslash."""
        return "\\" + self.before[0] + self.after[0]

    def label_escapes(self) -> str:
        """The same in labels, which end at the first ``between``."""
        return self.text_escapes() + self.between[0]


def _class(chars: str) -> str:
    return "([" + "".join(map(re.escape, chars)) + "])"


def _escape(text: Column, chars: str) -> Column:
    return F.regexp_replace(text, _class(chars), r"$1\\")


def _unescape(text: Column, chars: str) -> Column:
    return F.regexp_replace(text, _class(chars) + r"\\", "$1")


def _label(role: Column, template: ChatTemplate) -> Column:
    known = F.create_map(*(F.lit(x) for pair in template.labels.items() for x in pair))
    return F.coalesce(
        F.try_element_at(known, role), F.concat(F.lit("="), _escape(role, template.label_escapes()))
    )


def _role(label: Column, template: ChatTemplate) -> Column:
    known = F.create_map(*(F.lit(x) for k, v in template.labels.items() for x in (v, k)))
    return F.coalesce(
        F.try_element_at(known, label),
        _unescape(F.substring(label, 2, 1 << 30), template.label_escapes()),
    )


def _next_state(state: Column, role: Column, template: ChatTemplate) -> Column:
    moves = F.create_map(
        *(
            F.lit(x)
            for source, roles in template.moves.items()
            for role_ in roles
            for x in (f"{source}>{role_}", role_)
        )
    )
    # A turn out of order leads to the null state, which nothing leaves.
    return F.try_element_at(moves, F.concat(state, F.lit(">"), role))


def format_chats(conversations: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, valid, formatted, segments``.

    ``segments`` are (text, loss) in order; joined they are ``formatted``.  A text of
    a trained role is one segment with the flag set, and never its markers.
    ``valid`` tells whether the turns follow the template's order.  Invalid
    conversations are formatted as well, nothing is dropped.

    A null text or role counts as empty, a null turn sorts first, a null conv_id is
    a conversation of its own.  Turns of equal number are ordered by role and
    text, repeated rows are kept.  An empty table gives no rows.
    """
    empty = F.lit("")
    turns = conversations.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("turn").alias("turn"),
                    F.coalesce("role", empty).alias("role"),
                    F.coalesce("text", empty).alias("text"),
                )
            )
        ).alias("turns")
    )
    state = F.aggregate(
        F.col("turns.role"), F.lit(template.start), lambda s, r: _next_state(s, r, template)
    )

    def written(turn: Column) -> Column:
        opening = F.concat(
            F.lit(template.before), _label(turn.role, template), F.lit(template.between)
        )
        return F.array(
            F.struct(opening.alias("text"), F.lit(False).alias("loss")),
            F.struct(
                _escape(turn.text, template.text_escapes()).alias("text"),
                turn.role.isin(*template.trained).alias("loss"),
            ),
            F.struct(F.lit(template.after).alias("text"), F.lit(False).alias("loss")),
        )

    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.coalesce(state.isin(*template.final), F.lit(False)).alias("valid"),
        F.flatten(F.transform("turns", written)).alias("segments"),
    ).select(
        "conv_id",
        "n_turns",
        "valid",
        F.concat_ws("", F.col("segments.text")).alias("formatted"),
        "segments",
    )


def parse_turns(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """The (role, text) pairs that ``formatted`` was made of."""
    pieces = F.split(formatted, rf"\Q{template.after}\E", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def parsed(piece: Column) -> Column:
        first = F.locate(template.between, piece)
        start = len(template.before) + 1
        label = F.substring(piece, F.lit(start), first - start)
        text = F.substring(piece, first + len(template.between), F.length(piece))
        return F.struct(
            _role(label, template).alias("role"), _unescape(text, template.text_escapes()).alias("text")
        )

    return F.transform(pieces, parsed)


def loss_text(segments: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """All text under the loss flag, unescaped and joined."""
    marked = F.filter(segments, lambda s: s.loss)
    return F.concat_ws("", F.transform(marked, lambda s: _unescape(s.text, template.text_escapes())))
