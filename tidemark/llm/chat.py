"""Chat formatting with DataFrame functions only.

A declarative template names the marks around a turn, the roles whose texts count for the loss, and the role order as a finite
state machine: a transition table from (state, role) to a state, and the states in which a conversation may end. The machine runs
over the turns of each conversation; its verdict and the first turn that it refuses are columns. Every conversation is formatted,
valid or not. The output is a list of text segments, each with a loss flag; joined, they are the formatted text.

Marks contain "<"; inside texts and roles the escape character, "<" and ">" are written as the escape character and a digit, so
that no text can hold a mark, and ``parse_turns`` reads the turns back.

Turns are taken in the order of (turn, role, text), nulls first, so ties have a fixed order and repeated rows stay repeated. Null
texts and null roles are empty strings; each row with a null conv_id is a conversation of its own, so that however many there are,
they don't meet in one task. Other columns are ignored, whatever their names. An empty table gives an empty result. A conversation
is one output row and is assembled in one task; its size, very long texts included, not the number of conversations, bounds that
task's memory.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import quoted


@dataclass(frozen=True)
class Template:
    """``opening`` ends with ``opening_end``, and what lies between is the escaped role."""

    opening: str = "<turn:"
    opening_end: str = ">\n"
    closing: str = "</turn>\n"
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    transitions: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "briefed",
            ("start", "user"): "asked",
            ("briefed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    final: tuple[str, ...] = ("answered",)

    def escaped(self, text: Column) -> Column:
        for n, control in enumerate((self.escape, "<", ">")):
            text = F.replace(text, F.lit(control), F.lit(f"{self.escape}{n}"))
        return text

    def unescaped(self, text: Column) -> Column:
        for n, control in reversed([*enumerate((self.escape, "<", ">"))]):
            text = F.replace(text, F.lit(f"{self.escape}{n}"), F.lit(control))
        return text


def conversations_of(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: its id and ``turns``, an array of (turn, role, text) in order."""
    rows = turns.select(quoted(conv_col).alias("conv_id"), F.struct(quoted(turn_col).alias("turn"), F.coalesce(quoted(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text")).alias("_turn"))
    rows = rows.withColumn("_row", F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()))
    return rows.groupBy("conv_id", "_row").agg(F.array_sort(F.collect_list("_turn")).alias("turns")).drop("_row")


def check_order(turns: Column, template: Template) -> Column:
    """struct(state, at, refused): the machine after the last turn; refused is the number of the first refused turn, from 0."""
    table = F.create_map(*(F.lit(x) for (state, role), to in template.transitions.items() for x in (f"{state}\n{role}", to)))
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("refused"))

    def step(held: Column, turn: Column) -> Column:
        to = F.try_element_at(table, F.concat(held["state"], F.lit("\n"), turn["role"]))
        stay = held["refused"].isNotNull() | to.isNull()
        return F.struct(
            F.when(stay, held["state"]).otherwise(to).alias("state"),
            (held["at"] + 1).alias("at"),
            F.when(held["refused"].isNull() & to.isNull(), held["at"]).otherwise(held["refused"]).alias("refused"),
        )

    return F.aggregate(turns, begin, step)


def format_chats(turns: DataFrame, template: Template | None = None, **columns: str) -> DataFrame:
    """conv_id, n_turns, segments (array of text and loss), formatted, valid, refused_turn."""
    template = template or Template()

    def segments(turn: Column) -> Column:
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            part(F.concat(F.lit(template.opening), template.escaped(turn["role"]), F.lit(template.opening_end)), F.lit(False)),
            part(template.escaped(turn["text"]), turn["role"].isin(*template.loss_roles)),
            part(F.lit(template.closing), F.lit(False)),
        )

    chats = conversations_of(turns, **columns).withColumn("_order", check_order(F.col("turns"), template))
    chats = chats.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.flatten(F.transform("turns", segments)).alias("segments"), "_order")
    return chats.select(
        "conv_id",
        "n_turns",
        "segments",
        F.array_join(F.col("segments.text"), "").alias("formatted"),
        (F.col("_order.refused").isNull() & F.col("_order.state").isin(*template.final)).alias("valid"),
        F.col("_order.refused").alias("refused_turn"),
    )


def parse_turns(formatted: Column, template: Template | None = None) -> Column:
    """The turns (role, text) of a formatted text."""
    template = template or Template()
    pieces = F.split(formatted, "\\Q" + template.closing + "\\E", -1)

    def turn(piece: Column) -> Column:
        at = F.instr(piece, template.opening_end)
        role = F.substr(piece, F.lit(len(template.opening) + 1), at - len(template.opening) - 1)
        return F.struct(template.unescaped(role).alias("role"), template.unescaped(F.substr(piece, at + len(template.opening_end))).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def read_back(chats: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests of the turns and of the loss texts, taken from the formatted text and its segments alone."""
    template = template or Template()
    parsed = chats.withColumn("_turns", parse_turns(F.col("formatted"), template)).withColumn(
        "_loss", template.unescaped(F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]), ""))
    )
    whole = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(whole, "UTF-8"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("_loss", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "refused_turn",
    )
