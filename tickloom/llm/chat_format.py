"""Chat formatting (DataFrame functions only).

A declarative template gives each turn's opening and closing mark, the roles under the loss, the
control strings and the transitions of the role automaton. A conversation becomes segments of text
with a loss flag, and their concatenation the formatted string. Control strings within roles and
texts are broken by an escape, so that reading back restores every turn.

A conversation is one string by contract, so its turns meet in one row; long conversations make long
rows, and that is the only bound. Defined cases: a null role or text counts as empty; turns stand in
order of turn (null first), ties by role and text; repeated rows are turns of their own; null
conv_ids form one conversation; an empty table gives an empty result; extra columns are ignored. A
conversation against the automaton is formatted all the same, with valid false and bad_turn telling
the first position (from 0) that breaks it, or the number of turns if it ends too early.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

ESCAPE = "\\"
BROKEN = "\0broken"  # the automaton's dead state


@dataclass(frozen=True)
class ChatTemplate:
    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>"
    loss_roles: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    start: str = "start"
    final: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user", "tool"), "tool": ("assistant",)
        }
    )


def escaped(text: Column, template: ChatTemplate) -> Column:
    """No control string is left: each has an escape after its first character."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "b"))
    for c in template.controls:
        text = F.replace(text, F.lit(c), F.lit(c[0] + ESCAPE + "c" + c[1:]))
    return text


def unescaped(text: Column) -> Column:
    for code, plain in (("c", ""), ("n", "\n"), ("b", ESCAPE)):
        text = F.replace(text, F.lit(ESCAPE + code), F.lit(plain))
    return text


def _next_state(state: Column, role: Column, template: ChatTemplate) -> Column:
    step = F.lit(BROKEN)
    for at, roles in template.moves.items():
        step = F.when((state == at) & role.isin(*roles), role).otherwise(step)
    return step


def format_conversations(conversations: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """conversations (conv_id, turn, role, text) -> conv_id, segments, formatted, valid, bad_turn."""
    t = template or ChatTemplate()
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def segments(x: Column) -> Column:
        role = F.replace(escaped(x["role"], t), F.lit("\n"), F.lit(ESCAPE + "n"))
        parts = (
            (F.concat(F.lit(t.opening), role, F.lit("\n")), F.lit(False)),
            (escaped(x["text"], t), x["role"].isin(*t.loss_roles)),
            (F.lit(t.closing + "\n"), F.lit(False)),
        )
        return F.array(*[F.struct(text.alias("text"), loss.alias("loss")) for text, loss in parts])

    walked = F.aggregate(
        "turns",
        F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("good")),
        lambda acc, x: F.struct(
            _next_state(acc["state"], x["role"], t).alias("state"),
            (acc["good"] + F.when(_next_state(acc["state"], x["role"], t) != BROKEN, 1).otherwise(0)).alias("good"),
        ),
    )
    out = talks.select("conv_id", F.size("turns").alias("n"), F.flatten(F.transform("turns", segments)).alias("segments"), walked.alias("walk"))
    valid = F.col("walk.state").isin(*t.final)
    return out.select(
        "conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        valid.alias("valid"), F.when(~valid, F.col("walk.good")).alias("bad_turn"),
    )


def read_back(formatted: DataFrame, template: ChatTemplate | None = None) -> DataFrame:
    """formatted and segments -> turns (role, text) and loss_text, both as before the escape."""
    t = template or ChatTemplate()
    pieces = F.expr(f"filter(split(formatted, '\\\\Q{t.opening}\\\\E', -1), (p, i) -> i > 0)")

    def turn(p: Column) -> Column:
        at = F.locate("\n", p)
        text = F.substr(p, at + 1, F.length(p) - at - len(t.closing) - 1)
        return F.struct(unescaped(F.substr(p, F.lit(1), at - 1)).alias("role"), unescaped(text).alias("text"))

    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
    return formatted.withColumn("turns", F.transform(pieces, turn)).withColumn("loss_text", loss)
