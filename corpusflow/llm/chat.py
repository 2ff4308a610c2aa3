"""Chat formatting: a finite-state machine over roles and a declarative template, all native.

A template gives, for each role, the control strings around a turn and whether its text bears
loss, and the allowed turn orders as transitions of a state machine. Control strings inside texts
are escaped by a backslash after their first character (and one more where there already are
some), so the formatted text can be read back exactly.

Defined results: a null text or role is the empty string; a role that the template lacks is
formatted as ``other`` with its name, and makes the order invalid; turns are taken by turn, then
role and text (null turns first), so ties and repeated rows have a fixed place; rows with a null
conversation id form one conversation with a null id; an empty table gives no rows; other columns
are ignored. Every conversation is formatted, also one of invalid order (``valid`` is false).
Loss is borne by the text of a turn alone, never by its control strings or a role's name.
A formatted conversation is one string, so one conversation's turns meet in one row;
:func:`segments` gives them as rows, for conversations of any length.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass(frozen=True)
class Template:
    """open, close: control strings by role, ``other`` for roles not named; loss: roles whose text
    bears loss; then: the states that may follow a state (a state is the last role; ``start``)."""

    open: dict = field(default_factory=lambda: {"system": "<<SYS>>", "user": "[INST]", "assistant": "<s>", "other": "<<ROLE>>"})
    close: dict = field(default_factory=lambda: {"system": "<</SYS>>", "user": "[/INST]", "assistant": "</s>", "other": "<</ROLE>>"})
    loss: tuple = ("assistant",)
    then: dict = field(default_factory=lambda: {"start": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]})

    def control(self) -> list[str]:
        """All control strings, longest first."""
        return sorted({*self.open.values(), *self.close.values()}, key=lambda s: (-len(s), s))


def _quoted(s: str) -> str:
    return "\\Q" + s + "\\E"


def escape(text: Column, template: Template) -> Column:
    for first, rests in _by_first(template):
        text = F.regexp_replace(text, f"{_quoted(first)}(\\\\*)({rests})", f"{_literal(first)}\\\\$1$2")
    return text


def unescape(text: Column, template: Template) -> Column:
    for first, rests in _by_first(template):
        text = F.regexp_replace(text, f"{_quoted(first)}\\\\(\\\\*)({rests})", f"{_literal(first)}$1$2")
    return text


def _literal(s: str) -> str:
    return s.replace("\\", "\\\\").replace("$", "\\$")


def _by_first(template: Template) -> list[tuple[str, str]]:
    """The first character of control strings, and a pattern of what follows it."""
    firsts: dict[str, list[str]] = {}
    for c in template.control():
        firsts.setdefault(c[0], []).append(_quoted(c[1:]))
    return [(first, "|".join(rests)) for first, rests in sorted(firsts.items())]


def _by_role(role: Column, values: dict, default) -> Column:
    out = F.lit(default)
    for r, v in values.items():
        if r != "other":
            out = F.when(role == r, F.lit(v)).otherwise(out)
    return out


def segments(turns: DataFrame, template: Template = Template(), id_col: str = "conv_id", turn_col: str = "turn",
             role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: conv_id, turn, role, text, and what the template makes of it: opening,
    body (the escaped text), closing, and whether the body bears loss."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    known = role.isin([r for r in template.open if r != "other"])
    name = F.when(known, F.lit("")).otherwise(F.concat(F.replace(F.replace(escape(role, template), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("\n")))
    return turns.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
        F.concat(_by_role(role, template.open, template.open["other"]), name).alias("opening"),
        escape(text, template).alias("body"), _by_role(role, template.close, template.close["other"]).alias("closing"),
        role.isin(list(template.loss)).alias("loss"))


def format_chat(turns: DataFrame, template: Template = Template(), **columns) -> DataFrame:
    """One row per conversation: conv_id, formatted, valid, and its segments in order as
    array<struct<role, part, start, length, loss>> (code points of ``formatted``): three a turn,
    whose parts are ``open``, ``text`` and ``close``."""
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    chars = F.length("opening") + F.length("body") + F.length("closing")
    rows = segments(turns, template, **columns).withColumn("start", F.coalesce(F.sum(chars).over(before), F.lit(0)))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", "text", "opening", "body", "closing", "loss", "start"))).alias("t"))
    arrows = [f"{a}>{b}" for a, after in template.then.items() for b in after]
    state = F.aggregate(F.col("t.role"), F.lit("start"),
                        lambda s, r: F.when(F.concat(s, F.lit(">"), r).isin(arrows), r).otherwise(F.lit("!")))

    def parts(x: Column) -> Column:
        text_at = x["start"] + F.length(x["opening"])
        of_turn = (("open", "opening", x["start"], F.lit(False)), ("text", "body", text_at, x["loss"]),
                   ("close", "closing", text_at + F.length(x["body"]), F.lit(False)))
        return F.array(*(F.struct(x["role"].alias("role"), F.lit(part).alias("part"), start.alias("start"),
                                  F.length(x[name]).alias("length"), loss.alias("loss")) for part, name, start, loss in of_turn))

    return grouped.select(
        "conv_id", F.array_join(F.transform("t", lambda x: F.concat(x["opening"], x["body"], x["closing"])), "").alias("formatted"),
        (state != "!").alias("valid"), F.flatten(F.transform("t", parts)).alias("segments"))


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """``formatted`` with ``turns``: array<struct<role, text, loss>>, role and text read from its
    formatted text, loss from the flags of its text segments."""
    opens, closes = ("|".join(map(_quoted, sorted(set(d.values()), key=lambda s: (-len(s), s)))) for d in (template.open, template.close))
    pattern = F.lit(f"(?s)({opens})(.*?)({closes})")
    role_of = {v: k for k, v in template.open.items()}

    def turn(x: Column) -> Column:
        role, body = F.lit("other"), x["_body"]
        for o, r in role_of.items():
            role = F.when(x["_open"] == o, F.lit(r)).otherwise(role)
        other = role == "other"
        named = F.replace(F.replace(F.substring_index(body, "\n", 1), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))
        return F.struct(F.when(other, unescape(named, template)).otherwise(role).alias("role"),
                        unescape(F.when(other, F.substr(body, F.instr(body, "\n") + 1)).otherwise(body), template).alias("text"),
                        x["_loss"].alias("loss"))

    flags = F.transform(F.filter("segments", lambda s: s["part"] == "text"), lambda s: s["loss"])
    return (formatted.withColumn("_open", F.regexp_extract_all("formatted", pattern, 1))
            .withColumn("_body", F.regexp_extract_all("formatted", pattern, 2)).withColumn("_loss", flags)
            .withColumn("turns", F.transform(F.arrays_zip("_open", "_body", "_loss"), turn)).drop("_open", "_body", "_loss"))


def digest(read: DataFrame) -> DataFrame:
    """Digests of what was read back, one row per conversation."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                       F.length(learned).cast("long").alias("loss_chars"),
                       F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid")
