"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame functions only.

A conversation's rows, ordered by turn (ties by role, then text), become segments of text with a loss flag: marker,
text and closing marker of each turn. Control strings inside texts are escaped by one backslash after their first
character, and a backslash that already stands there gets one more, so unescaping gives the text back and no control
string of the output comes from a text. The machine tells whether the roles follow each other as the template allows,
and at which turn they first do not; a conversation that breaks the order is formatted all the same.

A conversation is one row of the result, so its turns meet in one task: it is the unit of the output, not a group that
could be split.

Defined results: a null text or role counts as empty; a null conversation id is a conversation of its own; rows that
are there twice are two turns; no rows give no conversations.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Markers, the control strings that texts must not hold, roles under the loss, and the machine's transitions."""

    opening: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>\n"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]")
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accepting: tuple[str, ...] = ("answered",)
    transitions: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "instructed",
        ("start", "user"): "asked",
        ("instructed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    })

    def pattern(self, backslash: str) -> str:
        first = "".join(sorted({re.escape(c[0]) for c in self.controls}))
        rest = "|".join(re.escape(c[1:]) for c in sorted(self.controls))
        return rf"([{first}]){backslash}(\\*)(?={rest})"


def escaped(text, template: Template) -> Column:
    return F.regexp_replace(text, template.pattern(""), r"$1\\$2")


def unescaped(text, template: Template) -> Column:
    return F.regexp_replace(text, template.pattern(r"\\"), "$1$2")


def role_out(role, template: Template) -> Column:
    """A role on one line, without control strings."""
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), template)


def role_in(role, template: Template) -> Column:
    return F.replace(F.replace(unescaped(role, template), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def segments(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: conv_id, valid, first_bad_turn (from 0, else null), segments (text, loss)."""
    rows = conversations.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("row"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("turns"))
    table = F.create_map(*[F.lit(x) for (state, role), then in template.transitions.items()
                           for x in (f"{state}\n{role}", then)])

    def step(now, turn):
        then = F.when(now["bad"].isNull(), F.try_element_at(table, F.concat(now["state"], F.lit("\n"), turn["role"])))
        return F.struct(F.coalesce(then, now["state"]).alias("state"), (now["i"] + 1).alias("i"),
                        F.coalesce(now["bad"], F.when(then.isNull(), now["i"])).alias("bad"))

    def turn_segments(turn):
        return F.array(
            F.struct(F.concat(F.lit(template.opening), role_out(turn["role"], template),
                              F.lit(template.after_role)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(turn["text"], template).alias("text"),
                     turn["role"].isin(*template.loss_roles).alias("loss")),
            F.struct(F.lit(template.closing).alias("text"), F.lit(False).alias("loss")))

    start = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("i"), F.lit(None).cast("int").alias("bad"))
    end = F.aggregate("turns", start, step)
    return turns.select(
        "conv_id", (end["bad"].isNull() & end["state"].isin(*template.accepting)).alias("valid"),
        end["bad"].alias("first_bad_turn"), F.flatten(F.transform("turns", turn_segments)).alias("segments"))


def formatted(pieces) -> Column:
    return F.array_join(F.transform(pieces, lambda s: s["text"]), "")


def read_back(text, template: Template = Template()) -> Column:
    """The turns (role, text) of a formatted text."""
    closing, head = len(template.closing), re.escape(template.after_role)

    def turn(part):
        both = F.split(part, head, 2)
        body = F.get(both, F.lit(1))
        return F.struct(role_in(F.get(both, F.lit(0)), template).alias("role"),
                        unescaped(F.left(body, F.length(body) - closing), template).alias("text"))

    parts = F.split(text, re.escape(template.opening), -1)
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), turn)


def digests(formatted_rows: DataFrame, template: Template = Template()) -> DataFrame:
    """What the output says, read back from its segments: turns, their digest, the text under the loss."""
    whole = formatted_rows.withColumn("formatted", formatted("segments"))
    turns = whole.withColumn("turns", read_back(F.col("formatted"), template)).withColumn(
        "loss_text", F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                              lambda s: unescaped(s["text"], template)), ""))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")
