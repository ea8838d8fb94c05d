"""Chat formatting: a finite-state machine over roles validates the order of turns; a declarative template renders them.

A template names the machine's transitions and accepting states, and for each role the segments of a turn with their loss
flags. The machine runs as a fold over the turns of a conversation, in generated JVM code; turns meet in one shuffle on the conversation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "start"


@dataclass(frozen=True)
class Template:
    """``transitions``: (state, role) to state; ``segments``: role to its (pattern with {text}, loss) in order."""

    transitions: dict[tuple[str, str], str]
    accept: tuple[str, ...]
    segments: dict[str, tuple[tuple[str, bool], ...]] = field(default_factory=dict)

    def __post_init__(self):
        missing = {r for _, r in self.transitions} - set(self.segments)
        if missing or any(p.count("{text}") > 1 for s in self.segments.values() for p, _ in s):
            raise ValueError(f"every role needs segments with at most one {{text}} each; none for {sorted(missing)}")


#: An optional system turn, then user and assistant in turn; one answer at least; a last question without an answer may stay, without loss.
DEFAULT = Template(
    transitions={(START, "system"): "system", (START, "user"): "asked", ("system", "user"): "asked", ("asked", "assistant"): "answered", ("answered", "user"): "again", ("again", "assistant"): "answered"},
    accept=("answered", "again"),
    segments={
        "system": (("<|system|>\n{text}<|end|>\n", False),),
        "user": (("<|user|>\n{text}<|end|>\n", False),),
        "assistant": (("<|assistant|>\n", False), ("{text}<|end|>\n", True)),
    },
)


def _rendered(turn: Column, template: Template) -> Column:
    """The segments of a turn."""
    text, out = F.coalesce(turn["text"], F.lit("")), None
    for role, parts in template.segments.items():
        made = []
        for pattern, loss in parts:
            head, hole, tail = pattern.partition("{text}")
            made.append(F.struct(F.lit(role).alias("role"), (F.concat(F.lit(head), text, F.lit(tail)) if hole else F.lit(head)).alias("text"), F.lit(loss).alias("loss")))
        out = F.when(turn["role"] == role, F.array(*made)) if out is None else out.when(turn["role"] == role, F.array(*made))
    return out


def format_conversations(df: DataFrame, template: Template = DEFAULT, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, segment, role, text, loss, error): the segments of each valid conversation, one row with an error for each other.

    Segments count from 0. ``error`` is the first of these that holds: a turn without a number; two different turns of one number; a role
    that the state doesn't allow, with the place of the turn and the state; an end in a state that isn't accepting. Turns are
    ordered by number; equal rows count once. Null texts are empty; a null role is never allowed. Rows with a null
    conversation are left out, an empty table gives no rows, and other columns are ignored.
    """
    turns = df.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.struct(F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")).alias("t")
    )
    conv = turns.groupBy("conv_id").agg(F.sort_array(F.collect_set("t")).alias("ts"))
    table = F.create_map(*[F.lit(x) for (s, r), to in template.transitions.items() for x in (f"{s}>{r}", to)])
    first = F.struct(F.lit(START).alias("state"), F.lit(0).alias("place"), F.lit(None).cast("string").alias("error"))

    def step(acc: Column, t: Column) -> Column:
        to = F.try_element_at(table, F.concat(acc["state"], F.lit(">"), F.coalesce(t["role"], F.lit(""))))
        bad = F.when(to.isNull(), F.concat(F.lit("turn "), acc["place"].cast("string"), F.lit(": "), F.coalesce(t["role"], F.lit("no role")), F.lit(" after "), acc["state"]))
        return F.struct(F.coalesce(to, acc["state"]).alias("state"), (acc["place"] + 1).alias("place"), F.coalesce(acc["error"], bad).alias("error"))

    end = F.aggregate("ts", first, step)
    numbers = F.transform("ts", lambda t: t["turn"])
    error = (
        F.when(F.exists(numbers, lambda n: n.isNull()), F.lit("a turn without a number"))
        .when(F.size(F.array_distinct(numbers)) < F.size(numbers), F.lit("two turns of one number"))
        .when(F.col("end.error").isNotNull(), F.col("end.error"))
        .when(~F.col("end.state").isin(*template.accept), F.concat(F.lit("ends after "), F.col("end.state")))
    )
    made = conv.withColumn("end", end).withColumn("error", error)
    segments = F.when(F.col("error").isNull(), F.flatten(F.transform("ts", lambda t: _rendered(t, template))))
    return made.select("conv_id", "error", F.posexplode_outer(segments).alias("segment", "s")).select("conv_id", "segment", "s.role", "s.text", "s.loss", "error")
