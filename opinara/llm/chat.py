"""Chat formatting: a role machine, a declarative template, segments with loss flags.

Everything is a column expression; the only shuffle gathers a conversation's
turns. Control strings inside texts are escaped by one backslash after their
first character, where backslashes already standing there count along, so that
the formatted string can be read back exactly.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role. ``other`` takes any further role, whose name stands before ``name_end``.

    Every opening and closing holds exactly one string of ``controls``; no
    control string begins inside another one.
    """

    start: str = "<s>"
    turns: dict[str, Turn] = field(default_factory=lambda: {
        "system": Turn("[SYS] ", " [/SYS]"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("[OUT] ", "</s>", loss=True),
    })
    other: Turn = Turn("[TURN] ", " [/TURN]")
    name_end: str = " [TEXT] "
    controls: tuple[str, ...] = (
        "<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[OUT]", "[TURN]", "[/TURN]", "[TEXT]",
    )
    # The role machine: state and role give the next state; a missing pair is an error.
    steps: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "ready",
        ("start", "user"): "asked",
        ("ready", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    })

    def _pattern(self, escapes: str) -> str:
        first = "".join(sorted({re.escape(control[0]) for control in self.controls}))
        rest = "|".join(re.escape(control[1:]) for control in self.controls)
        return f"([{first}]){escapes}({rest})"

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"(\\*)"), r"$1\\$2$3")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"\\(\\*)"), "$1$2$3")

    def segments(self, turn: Column) -> Column:
        """The segments (text, loss) of one turn (role, text)."""

        def three(opening: Column, closing: str, loss: bool) -> Column:
            parts = ((opening, False), (self.escape(turn["text"]), loss), (F.lit(closing), False))
            return F.array(*[F.struct(part.alias("text"), F.lit(flag).alias("loss")) for part, flag in parts])

        named = F.concat(F.lit(self.other.opening), self.escape(turn["role"]), F.lit(self.name_end))
        found = three(named, self.other.closing, self.other.loss)
        for role, marks in self.turns.items():
            found = F.when(turn["role"] == role, three(F.lit(marks.opening), marks.closing, marks.loss)).otherwise(found)
        return found

    def state(self, turns: Column) -> Column:
        """The machine's state after all turns, or ``error``."""
        steps = F.create_map(*[
            F.lit(item) for (state, role), after in self.steps.items() for item in (f"{state}>{role}", after)
        ])
        return F.aggregate(turns, F.lit("start"), lambda state, turn: F.coalesce(
            F.element_at(steps, F.concat(state, F.lit(">"), turn["role"])), F.lit("error")
        ))

    def read(self, formatted: Column) -> Column:
        """The turns (role, text) of a formatted conversation."""
        ends = "|".join(re.escape(marks.closing) for marks in (*self.turns.values(), self.other))
        parts = F.filter(
            F.split(F.substr(formatted, F.lit(len(self.start) + 1)), f"(?<={ends})"), lambda part: part != ""
        )

        def turn(part: Column) -> Column:
            def inner(marks: Turn) -> Column:
                return F.substr(part, F.lit(len(marks.opening) + 1), F.length(part) - len(marks.opening) - len(marks.closing))

            def pair(role: Column, text: Column) -> Column:
                return F.struct(self.unescape(role).alias("role"), self.unescape(text).alias("text"))

            body = inner(self.other)
            name = F.substring_index(body, self.name_end, 1)
            found = pair(name, F.substr(body, F.length(name) + len(self.name_end) + 1))
            for role, marks in self.turns.items():
                found = F.when(part.startswith(marks.opening), pair(F.lit(role), inner(marks))).otherwise(found)
            return found

        return F.transform(parts, turn)


def format_chats(
    rows: DataFrame, template: Template | None = None,
    key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per conversation: key, segments (text, loss), formatted, state, valid.

    Turns are taken by ``turn``, ties by role and text; a null turn comes first,
    null roles and texts count as empty, and repeated rows are turns of their
    own. A null key is a conversation like others. ``state`` is where the role
    machine ends, ``valid`` whether it never failed; conversations that break
    the order are formatted all the same, so that none is lost. Other columns
    are not read. A conversation becomes one string and has to fit one row.
    """
    template = template or Template()
    picked = rows.select(
        F.col(f"`{key}`").alias("k"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        ).alias("one"),
    )
    gathered = picked.groupBy("k").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    start = F.array(F.struct(F.lit(template.start).alias("text"), F.lit(False).alias("loss")))
    segments = F.concat(start, F.flatten(F.transform("turns", template.segments)))
    return gathered.select("k", segments.alias("segments"), template.state(F.col("turns")).alias("state")).select(
        F.col("k").alias(key), "segments",
        F.array_join(F.transform("segments", lambda part: part["text"]), "").alias("formatted"),
        "state", (F.col("state") != "error").alias("valid"),
    )


def digests(chats: DataFrame, template: Template | None = None, key: str = "conv_id") -> DataFrame:
    """What the formatted strings and loss flags say when read back: counts and SHA-256 sums."""
    template = template or Template()
    loss = F.array_join(F.transform(
        F.filter("segments", lambda part: part["loss"]), lambda part: template.unescape(part["text"])
    ), "")
    lines = F.array_join(F.transform("turns", lambda one: F.concat(one["role"], F.lit("\n"), one["text"], F.lit("\n"))), "")
    read = chats.select(
        F.col(f"`{key}`").alias("k"), template.read(F.col("formatted")).alias("turns"), loss.alias("loss"), "formatted", "state", "valid"
    )
    return read.select(
        F.col("k").alias(key),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "state", "valid",
    )
