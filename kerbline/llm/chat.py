"""Conversations as marked text with a loss flag per segment, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """What marks a turn of each role, and which role may follow which.

    Marks begin with ``<`` or ``[``, which escaped texts never hold. ``follows`` lists, for the
    state before a turn (a role, or ``start``), the roles that the machine accepts. A role
    without an entry is written between ``other`` marks and is accepted nowhere.
    """

    roles: dict[str, Role] = field(default_factory=lambda: {
        "system": Role("<<SYS>>", "<</SYS>>"),
        "user": Role("[INST] ", " [/INST]"),
        "assistant": Role("<s>", "</s>", loss=True),
    })
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",),
    })
    other: tuple[str, str, str] = ("<role>", "</role>", "</turn>")


#: Escapes, in the order in which they are written; they are read in the reverse order.
ESCAPES = (("\\", "\\e"), ("<", "\\l"), ("[", "\\b"))


def escape(text: Column) -> Column:
    for plain, mark in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescape(text: Column) -> Column:
    for plain, mark in reversed(ESCAPES):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def _by_role(role: Column, values: dict[str, object], otherwise: Column) -> Column:
    out = None
    for name, value in values.items():
        out = F.when(role == name, F.lit(value)) if out is None else out.when(role == name, F.lit(value))
    return otherwise if out is None else out.otherwise(otherwise)


def format_turns(turns: DataFrame, template: Template = Template(), by: str = "conv_id", order: str = "turn") -> DataFrame:
    """One row per turn: ``by, order, role, text, n, segments, accepted, valid``.

    ``segments`` is an array of (text, loss): the opening mark, the escaped text, the closing
    mark. The machine's state before a turn is the role of the turn before, so one ordered
    window walks it without collecting a conversation; ``accepted`` tells whether the machine
    takes this turn, ``valid`` whether it has taken all up to it. ``n`` counts turns from 1.
    Null roles and texts count as empty; ties in ``order`` go by role, then text; rows with a
    null ``by`` form one conversation. Other columns are ignored.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = turns.select(by, order, role.alias("role"), text.alias("text"))
    walk = Window.partitionBy(by).orderBy(F.col(order).asc_nulls_first(), "role", "text")
    state = F.coalesce(F.lag("role").over(walk), F.lit("start"))
    begins = F.row_number().over(walk)
    accepted = F.lit(False)
    for name, after in template.follows.items():
        here = (begins == 1) if name == "start" else (begins > 1) & (state == name)
        accepted = accepted | (here & F.col("role").isin(*after))
    head, middle, tail = template.other
    opening = _by_role(F.col("role"), {k: r.open for k, r in template.roles.items()}, F.concat(F.lit(head), escape(F.col("role")), F.lit(middle)))
    closing = _by_role(F.col("role"), {k: r.close for k, r in template.roles.items()}, F.lit(tail))
    loss = _by_role(F.col("role"), {k: r.loss for k, r in template.roles.items()}, F.lit(False))

    def piece(words: Column, flag: Column) -> Column:
        return F.struct(words.alias("text"), flag.alias("loss"))

    segments = F.array(piece(opening, F.lit(False)), piece(escape(F.col("text")), loss), piece(closing, F.lit(False)))
    return (
        rows.withColumn("n", begins).withColumn("accepted", accepted)
        .withColumn("valid", F.min("accepted").over(walk.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("segments", segments)
    )


def assemble(formatted: DataFrame, by: str = "conv_id") -> DataFrame:
    """One row per conversation: ``by, segments, formatted, valid``, segments in turn order.

    A conversation becomes one value here, so it must fit in a row; use :func:`format_turns`
    where it does not.
    """
    turns = F.array_sort(F.collect_list(F.struct("n", "segments")))
    return (
        formatted.groupBy(by).agg(turns.alias("t"), F.min("valid").alias("valid"))
        .select(by, F.flatten("t.segments").alias("segments"), "valid")
        .withColumn("formatted", F.array_join("segments.text", ""))
    )


def _quoted(mark: str) -> str:
    return "".join(c if c.isalnum() or c.isspace() else "\\" + c for c in mark)


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The (role, text) turns of a formatted conversation, in order: the inverse of the format."""
    head, middle, tail = template.other
    opens = [_quoted(r.open) for r in template.roles.values()] + [_quoted(head) + "[^<\\[]*" + _quoted(middle)]
    closes = [_quoted(r.close) for r in template.roles.values()] + [_quoted(tail)]
    turn = F.lit(f"({'|'.join(opens)})([^<\\[]*)({'|'.join(closes)})")
    names = {r.open: k for k, r in template.roles.items()}

    def role(mark: Column) -> Column:
        own = unescape(mark.substr(F.lit(len(head) + 1), F.length(mark) - len(head) - len(middle)))
        return _by_role(mark, names, own)

    marks = F.regexp_extract_all(formatted, turn, F.lit(1))
    texts = F.regexp_extract_all(formatted, turn, F.lit(2))
    return F.zip_with(marks, texts, lambda m, t: F.struct(role(m).alias("role"), unescape(t).alias("text")))
