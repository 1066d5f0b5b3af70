"""Chat formatting: a declarative template, a state machine over roles, and loss flags per segment.

All of it is column expressions. A conversation becomes an array of segments
(text, loss); their concatenation is the formatted text. Texts and roles are
escaped so that no control string of the template can appear inside them, and
the escape can be undone exactly.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    """How a turn is written, which roles bear loss, and which role may follow which."""

    turn_open: str = "<s>[ROLE]"
    role_close: str = "[/ROLE]"
    turn_close: str = "</s>"
    control: tuple[str, ...] = ("<s>", "</s>", "[ROLE]", "[/ROLE]", "[INST]", "[/INST]")
    loss_roles: tuple[str, ...] = ("assistant",)
    # State machine: (state, role) -> next state. A state is the last role; anything not listed is a dead end.
    start: str = "start"
    dead: str = "out of order"
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user",
    })
    final: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        leads = {c[0] for c in self.control}
        for c in self.control:
            if "\\" in c or leads & set(c[1:]):
                raise ValueError(f"control string {c!r} must have its lead at its start only and no backslash")

    @property
    def guarded(self) -> str:
        """A control string, or one with backslashes after its first character."""
        leads = "".join(sorted({re.escape(c[0]) for c in self.control}))
        tails = "|".join(sorted((re.escape(c[1:]) for c in self.control), key=len, reverse=True))
        return rf"([{leads}])(\\*)({tails})"

    def escape(self, text: Column) -> Column:
        """One backslash more after the first character of whatever looks like a control string."""
        return F.regexp_replace(text, self.guarded, r"$1$2\\$3")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, self.guarded.replace(r"(\\*)", r"\\(\\*)"), "$1$2$3")


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conv_id: segments (array of text and loss), formatted, state, in_order, complete.

    ``turns`` has conv_id, turn, role, text; other columns are not read. A null
    role or text is empty; turns with equal numbers go by role, then text, and
    nulls come first; repeated rows are repeated turns; rows without conv_id
    are one conversation. Conversations out of order are formatted all the
    same and say so in ``in_order``; ``complete`` also asks for a final state.
    """
    ordered = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    moves = F.create_map(*(F.lit(x) for (state, role), to in template.moves.items() for x in (f"{state}\n{role}", to)))

    def segments(turn: Column) -> Column:
        role, text = F.coalesce(turn["role"], F.lit("")), F.coalesce(turn["text"], F.lit(""))
        parts = (
            (F.concat(F.lit(template.turn_open), template.escape(role), F.lit(template.role_close)), F.lit(False)),
            (template.escape(text), role.isin(*template.loss_roles)),
            (F.lit(template.turn_close), F.lit(False)),
        )
        return F.array(*(F.struct(t.alias("text"), loss.alias("loss")) for t, loss in parts))

    state = F.aggregate(
        "turns", F.lit(template.start),
        lambda at, turn: F.coalesce(moves[F.concat(at, F.lit("\n"), F.coalesce(turn["role"], F.lit("")))], F.lit(template.dead)),
    )
    return (
        ordered.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"), state.alias("state"))
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
        .withColumn("in_order", F.col("state") != template.dead)
        .withColumn("complete", F.col("state").isin(*template.final))
    )


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, turns (array of role and text) from the formatted text, and loss_text from the flagged segments."""
    literal = lambda s: "\\Q" + s + "\\E"
    pieces = F.split("formatted", literal(template.turn_close), -1)
    opening, closing = len(template.turn_open), len(template.role_close)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, opening + 1, 2**31 - 1)
        role = F.substring_index(body, template.role_close, 1)
        text = body.substr(F.length(role) + F.lit(closing + 1), F.length(body))
        return F.struct(template.unescape(role).alias("role"), template.unescape(text).alias("text"))

    flagged = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: template.unescape(s["text"]))
    return formatted.select(
        "conv_id", "formatted", "segments",
        F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn).alias("turns"),
        F.array_join(flagged, "").alias("loss_text"),
    )


def digests(read: DataFrame) -> DataFrame:
    """What the read-back conversations hold, as counts and checksums."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
