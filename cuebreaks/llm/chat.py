"""Formats conversations as training text with a loss flag per segment.

A declarative template names the turn marks, the roles under the loss, and the transitions of a
finite-state machine over roles, which tells whether the order of turns is valid. The segments, joined, are
the formatted text. Control strings inside texts are escaped, so marks are found again without doubt.

Defined cases: NULL text and NULL role are empty; turns of equal number go by role, then text;
repeated rows are turns of their own; an empty table gives no conversation. A conversation is one value of the
result, so its turns meet in one row, however they are computed.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INVALID = "invalid"


@dataclass(frozen=True)
class Template:
    """Turn marks and rules; every mark that a text could forge begins with ``control``."""

    control: str = "<|"
    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accepting: tuple[str, ...] = ("assistant",)
    transitions: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )

    @property
    def escapes(self) -> list[tuple[str, str]]:
        """Replacements in the order of escaping; undone in reverse."""
        head, rest = self.control[0], self.control[1:]
        return [("&", "&amp;"), (head + rest, "&ctl;" + rest)]

    def escape(self, text: Column) -> Column:
        return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), self.escapes, text)

    def unescape(self, text: Column) -> Column:
        back = reversed(self.escapes)
        return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), back, text)

    def escape_role(self, role: Column) -> Column:
        return F.replace(self.escape(role), F.lit("\n"), F.lit("&nl;"))

    def unescape_role(self, role: Column) -> Column:
        return self.unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def _final_state(template: Template, roles: Column) -> Column:
    """The machine's state after all roles; a missing transition leads to ``invalid`` for good."""
    moves = [(f"{a}>{b}", b) for a, after in template.transitions.items() for b in after]
    table = F.create_map(*[F.lit(x) for move in moves for x in move])
    step = lambda state, role: F.coalesce(
        F.try_element_at(table, F.concat(state, F.lit(">"), role)), F.lit(INVALID)
    )
    return F.aggregate(roles, F.lit(template.start), step)


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: ``conv_id, segments, formatted, valid``.

    ``segments`` are structs of ``text`` and ``loss``; only texts of the template's loss roles are under the loss.
    """
    row = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    talks = turns.select("conv_id", row.alias("row")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("row")).alias("turns")
    )

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_turn(t: Column) -> Column:
        role, text = t["role"], t["text"]
        opening = F.concat(F.lit(template.opening), template.escape_role(role), F.lit("\n"))
        return F.array(
            segment(opening, F.lit(False)),
            segment(template.escape(text), role.isin(*template.loss_roles)),
            segment(F.lit(template.closing), F.lit(False)),
        )

    state = _final_state(template, F.transform("turns", lambda t: t["role"]))
    return talks.select(
        "conv_id",
        F.flatten(F.transform("turns", of_turn)).alias("segments"),
        state.isin(*template.accepting).alias("valid"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """``formatted`` plus ``turns`` (``role``, ``text``) parsed from the text, and ``learned`` texts by the flags."""
    closing = "\\Q" + template.closing + "\\E"
    pieces = F.split("formatted", closing, -1)
    body = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.substring(p, F.lit(len(template.opening) + 1), F.length(p)),
    )

    parsed = F.transform(
        body,
        lambda p: F.struct(
            template.unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            template.unescape(
                F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))
            ).alias("text"),
        ),
    )
    learned = F.transform(
        F.filter("segments", lambda s: s["loss"]), lambda s: template.unescape(s["text"])
    )
    return formatted.withColumn("turns", parsed).withColumn("learned", learned)
