"""Conversations as formatted training text, with a loss flag for every segment.

A declarative template says how a turn opens and closes, which roles carry loss and which role
may follow which. Everything is DataFrame functions. The role order is checked by a finite-state
machine: the state is the last role, its transitions are pairs in the template.

Control strings inside texts are escaped, reversibly: a backslash is doubled, then a single one is
put into every ``<|``. So no text holds ``<|``, all controls do, and reading back is exact. Roles are
percent-encoded (plain names stay as they are), so neither line breaks nor controls in a role hurt.

A conversation becomes one text, so it must fit a row, as a training sample must; its turns meet in
one group. No group is larger than a conversation: turns without ``conv_id`` aren't gathered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, BROKEN = "", "!"


@dataclass(frozen=True)
class Template:
    """``{role}`` stands for the turn's role; ``opens`` and ``closes`` begin with ``<|``."""

    opens: str = "<|im_start|>{role}\n"
    closes: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: Role pairs that may follow each other, from the empty role at the start.
    follows: tuple[tuple[str, str], ...] = (
        (START, "system"), (START, "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user"),
    )

    def __post_init__(self):
        before, found, after = self.opens.partition("{role}")
        if not (found and after and before.startswith("<|") and self.closes.startswith("<|")):
            raise ValueError("a template opens with <|..{role}.. and closes with <|..")
        if set(after) & set("%+") or after[0].isalnum():
            raise ValueError("what follows the role must not look like a part of it")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _order_is_valid(roles: Column, template: Template) -> Column:
    allowed = F.array(*(F.lit(f"{a}\n{b}") for a, b in template.follows))
    step = lambda state, role: F.when(
        F.array_contains(allowed, F.concat(state, F.lit("\n"), role)), role
    ).otherwise(F.lit(BROKEN))
    return F.aggregate(roles, F.lit(START), step) != BROKEN


def format_conversations(
    turns: DataFrame,
    *,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` (text and loss flag), ``valid``.

    Turns stand by ``turn``; among equal numbers (NULL first) by role, then text. NULL role and NULL
    text count as empty; an empty conversation doesn't exist. Repeated rows stay. A row without
    ``conv_id`` makes a conversation of its own with a NULL id, equal rows one together. ``valid``
    says whether the roles follow the template; nothing is dropped for being invalid. The segments'
    texts, joined, are the formatted conversation. Other columns are ignored.
    """
    before, _, after = template.opens.partition("{role}")
    rows = turns.select(
        turns[conv_col].alias("conv_id"),
        F.struct(
            turns[turn_col].alias("turn"),
            F.coalesce(turns[role_col], F.lit("")).alias("role"),
            F.coalesce(turns[text_col], F.lit("")).alias("text"),
        ).alias("row"),
    )
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("row.turn", "row.role", "row.text"))
    grouped = rows.groupBy("conv_id", alone.alias("_alone")).agg(F.sort_array(F.collect_list("row")).alias("turns"))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                segment(F.concat(F.lit(before), F.url_encode(t["role"]), F.lit(after)), F.lit(False)),
                segment(escape(t["text"]), t["role"].isin(*template.loss_roles)),
                segment(F.lit(template.closes), F.lit(False)),
            ),
        )
    )
    return grouped.select(
        "conv_id",
        segments.alias("segments"),
        _order_is_valid(F.transform("turns", lambda t: t["role"]), template).alias("valid"),
    )


def formatted(segments: Column) -> Column:
    """The whole text of a conversation."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """What carries loss, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def parse(text: Column, template: Template = Template()) -> Column:
    """Reads a formatted text back: an array of ``role`` and ``text``."""
    before, _, after = template.opens.partition("{role}")

    def turn(part: Column) -> Column:
        head = F.substring_index(part, after, 1)
        body = F.substring(part, F.char_length(head) + len(after) + 1, F.char_length(part))
        body = F.substring(body, F.lit(1), F.char_length(body) - len(template.closes))
        return F.struct(F.url_decode(head).alias("role"), unescape(body).alias("text"))

    parts = F.split(text, _quoted(before))
    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def _quoted(text: str) -> str:
    """A pattern for the text itself."""
    return "".join(c if c.isalnum() else f"\\u{ord(c):04x}" for c in text)
