"""Chat formatting: a role automaton, a declarative template, and loss flags.

A conversation becomes text segments, each with a flag that says whether a model
learns from it. Control strings inside texts are broken up by a backslash, so the
template's own marks are the only ones left and the turns can be read back.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwright.llm.common import whole_text


@dataclass(frozen=True)
class Template:
    """How a turn is written, which roles are learned, and which order is valid.

    ``moves`` is the automaton: (state, role) to state; a conversation is valid if
    every turn has a move from ``start`` on and the last state is in ``accept``.
    """

    labels: dict[str, str] = field(
        default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"}
    )
    learned: tuple[str, ...] = ("assistant",)
    before: str = "### "
    between: str = ": "
    after: str = "</turn>\n"
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "instructed",
            ("start", "user"): "asked",
            ("instructed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    start: str = "start"
    accept: tuple[str, ...] = ("answered",)

    @property
    def marks(self) -> tuple[str, ...]:
        """Strings that must not appear in a written text: the header's start and the end mark."""
        return (self.before, self.after.rstrip("\n"))


def _escape(text: Column, template: Template) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in template.marks:  # a backslash after its first character breaks a mark
        out = F.replace(out, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return out


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _label(role: Column, template: Template) -> Column:
    """Known roles have a label; any other is written after an @, with the separator broken up."""
    named = F.create_map(*[F.lit(x) for pair in template.labels.items() for x in pair])[role]
    other = F.replace(_escape(F.coalesce(role, F.lit("")), template), F.lit(":"), F.lit("\\:"))
    return F.coalesce(named, F.concat(F.lit("@"), other))


def _role(label: Column, template: Template) -> Column:
    known = F.create_map(*[F.lit(x) for role, name in template.labels.items() for x in (name, role)])[label]
    return F.coalesce(known, _unescape(F.substring(label, 2, 2**31 - 1)))


def format_chats(
    turns: DataFrame,
    template: Template = Template(),
    conversation: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: ``segments``, ``formatted``, ``valid`` and ``first_invalid``.

    ``segments`` is an array of (text, loss); ``formatted`` is their concatenation.
    ``first_invalid`` is the position of the first turn without a move, or the number
    of turns if the conversation ends too early; null if valid. Nothing is dropped:
    invalid conversations are written and flagged.

    Turns are ordered by (turn, role, text), nulls first, so ties and repeated rows
    have one order. A null text is empty, a null role is an unknown one with an empty
    name, null conversations form one conversation. Other columns are ignored.
    """
    rows = turns.select(
        F.col(conversation).alias(conversation),
        F.struct(F.col(order).alias("at"), F.col(role).alias("role"), whole_text(text).alias("text")).alias("_turn"),
    )
    gathered = rows.groupBy(conversation).agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))

    moves = F.create_map(*[F.lit(x) for (a, r), b in template.moves.items() for x in (f"{a}\n{r}", b)])

    def step(seen, turn):
        here = F.coalesce(moves[F.concat_ws("\n", seen["state"], F.coalesce(turn["role"], F.lit("")))], F.lit(""))
        return F.struct(here.alias("state"), (seen["done"] + (here != "").cast("int")).alias("done"))

    run = F.aggregate("_turns", F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("done")), step)

    def segments(turn):
        head = F.concat(F.lit(template.before), _label(turn["role"], template), F.lit(template.between))
        learned = F.coalesce(turn["role"].isin(*template.learned), F.lit(False))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(_escape(turn["text"], template).alias("text"), learned.alias("loss")),
            F.struct(F.lit(template.after).alias("text"), F.lit(False).alias("loss")),
        )

    return (
        gathered.withColumn("_run", run)
        .withColumn("valid", F.col("_run.state").isin(*template.accept))
        .withColumn("first_invalid", F.when(~F.col("valid"), F.col("_run.done")))
        .withColumn("segments", F.flatten(F.transform("_turns", segments)))
        .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
        .drop("_turns", "_run")
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a formatted conversation: an array of (role, text).

    Written texts hold no end mark, so the marks found are the template's own.
    """
    pieces = F.split(formatted, f"\\Q{template.after}\\E")
    written = F.slice(pieces, 1, F.size(pieces) - 1)
    head, sep = len(template.before), f"^([^:\\\\]*+(?:\\\\.[^:\\\\]*+)*+)\\Q{template.between}\\E"

    def turn(piece):
        rest = F.substring(piece, head + 1, 2**31 - 1)
        label = F.regexp_extract(rest, f"(?s){sep}", 1)
        body = F.substr(rest, F.length(label) + F.lit(len(template.between) + 1))
        return F.struct(_role(label, template).alias("role"), _unescape(body).alias("text"))

    return F.transform(written, turn)


def read_learned(segments: Column) -> Column:
    """All text under the loss mask, as it was before escaping, in order."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: _unescape(s["text"])), "")
