"""Chat formatting by prefix-target expansion.

Every turn of the trained role becomes an example of its own: all turns before it are context, and only
its text lies under the loss mask. The template puts a mark before and after every turn. Backslashes
inside texts and role names are doubled, and a control string gets a backslash after its first
character, so that no text can end a turn; reading back takes a backslash off every group. What stands
after the last such turn, or a conversation without one, comes as an example without a mask, so that
every turn can be read back from the output. An example's text grows with its context: the texts of
one conversation together grow with the square of its length, as the method says, but a task holds
the turns of one conversation and one example at a time.

Only DataFrame functions are used. Mask bounds are code points, the end is exclusive.

Defined results: a null text is empty, a null role is the empty role; roles without marks of their own
are named in the text; turns stand in the order of `turn`, null last, ties in the order of role and
formatted text; repeated rows are turns of their own; rows with a null conversation id form one
conversation; no rows give no examples. Other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import text_or_empty

# The marks of the instruction format.
MARKS = {
    "system": ("[SYSTEM_PROMPT] ", " [/SYSTEM_PROMPT]"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": (" ", "</s>"),
}


@dataclass(frozen=True)
class Template:
    """Marks by role. Only `trained` turns may begin with a mark that holds no control string."""

    begin: str = "<s>"
    marks: dict[str, tuple[str, str]] = field(default_factory=lambda: dict(MARKS))
    trained: str = "assistant"
    other: tuple[str, str, str] = ("[ROLE] ", " [/ROLE]", "[/TURN]")

    def __post_init__(self):
        firsts = {control[0] for control in self.controls}
        for control in self.controls:
            if len(control) < 2 or "\\" in control or firsts.intersection(control[1:]):
                raise ValueError(f"control string {control!r} can't be told from text")
        if not self.marks.get(self.trained, ("",))[0]:
            raise ValueError("the trained role needs a mark to begin with")

    @property
    def controls(self) -> list[str]:
        """The strings that texts must not hold, without the blanks around them."""
        marks = [self.begin, *self.other, *(mark for pair in self.marks.values() for mark in pair)]
        return sorted({mark.strip() for mark in marks if mark.strip()})

    @property
    def control_pattern(self) -> str:
        """First characters and rests of the control strings, for Java's and other expressions."""
        firsts = "|".join(sorted({re.escape(control[0]) for control in self.controls}))
        rests = "|".join(sorted({re.escape(control[1:]) for control in self.controls}))
        return f"({firsts})({rests})"

    @property
    def end_pattern(self) -> str:
        """Any turn's end."""
        ends = {end for _, end in self.marks.values()} | {self.other[2]}
        return "|".join(sorted(map(re.escape, ends)))


def escape(text: Column, template: Template) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, template.control_pattern, r"$1\\$2")


def unescape(text: Column) -> Column:
    plain = F.regexp_replace(text, r"\\(\\?)", "$1")
    return F.when(F.contains(text, F.lit("\\")), plain).otherwise(text)


def formatted_turn(role: Column, text: Column, template: Template) -> Column:
    """A turn between its marks."""
    start, middle, end = template.other
    turn = F.concat(F.lit(start), escape(role, template), F.lit(middle), text, F.lit(end))
    for name, (before, after) in template.marks.items():
        turn = F.when(role == name, F.concat(F.lit(before), text, F.lit(after))).otherwise(turn)
    return turn


def format_chats(
    conversations: DataFrame,
    template: Template = Template(),
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Examples: conv_id, n_turns (in the text), trainable, whole (holds all turns), text, loss_start
    and loss_end (null unless trainable)."""
    name = text_or_empty(role)
    turns = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).isNull().alias("missing"),
            F.col(turn).alias("turn"),
            name.alias("role"),
            formatted_turn(name, escape(text_or_empty(text), template), template).alias("piece"),
        ).alias("turn"),
    )
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    trained = F.transform(F.col("turns"), lambda one: one["role"] == template.trained)
    size = F.size("turns")
    stops = F.filter(
        F.sequence(F.lit(1), size), lambda n: F.element_at("trained", n) | (n == F.col("size"))
    )
    expanded = (
        ordered.withColumns({"trained": trained, "size": size})
        .withColumn("n_turns", F.explode(stops))
        .withColumn("trainable", F.element_at("trained", F.col("n_turns")))
    )
    seen = F.transform(F.slice("turns", F.lit(1), F.col("n_turns")), lambda one: one["piece"])
    before, after = template.marks[template.trained]
    last = F.length(F.element_at("turns", F.col("n_turns"))["piece"]) - len(before) - len(after)
    examples = expanded.select(
        "conv_id",
        "n_turns",
        "trainable",
        (F.col("n_turns") == F.col("size")).alias("whole"),
        F.concat(F.lit(template.begin), F.array_join(seen, "")).alias("text"),
        last.alias("reply_chars"),
    )
    stop = F.length("text") - len(after)
    return examples.select(
        "conv_id",
        "n_turns",
        "trainable",
        "whole",
        "text",
        F.when(F.col("trainable"), stop - F.col("reply_chars")).alias("loss_start"),
        F.when(F.col("trainable"), stop).alias("loss_end"),
    )


def loss_text(template: Template = Template()) -> Column:
    """What lies under an example's mask, as it was before formatting; null without a mask."""
    masked = F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    return unescape(masked)


def read_turns(text: Column, template: Template = Template()) -> Column:
    """The turns of an example's text: an array of (role, text), as they were before formatting."""

    def read(piece: Column) -> Column:
        """One turn, up to its end."""

        def turn(role: Column, before: Column | int) -> Column:
            start = before + 1 if isinstance(before, Column) else F.lit(before + 1)
            body = F.substring(piece, start, F.length(piece))
            return F.struct(role.alias("role"), unescape(body).alias("text"))

        result = turn(F.lit(template.trained), len(template.marks[template.trained][0]))
        for role, (before, _) in template.marks.items():
            if role != template.trained:
                found = turn(F.lit(role), len(before))
                result = F.when(F.startswith(piece, F.lit(before)), found).otherwise(result)
        start, middle, _ = template.other
        named = F.substring_index(F.substring(piece, F.lit(len(start) + 1), F.length(piece)), middle, 1)
        other = turn(unescape(named), F.length(named) + len(start) + len(middle))
        return F.when(F.startswith(piece, F.lit(start)), other).otherwise(result)

    body = F.substring(text, F.lit(len(template.begin) + 1), F.length(text))
    # Every turn begins with a mark; only after the last end there is nothing.
    pieces = F.filter(F.split(body, template.end_pattern), lambda piece: piece != "")
    return F.transform(pieces, read)
