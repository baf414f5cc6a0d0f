"""Chat formatting of records in many layouts.

A record is a VARIANT. The hash of its nested field paths, its schema fingerprint, selects one of the
declared layouts; the layout says where the turns are. A record with more fields than any layout takes
the one with the most declared fields of which it lacks none; shapes that fit none are reported. The canonical turns of a conversation are
written with a template that marks each turn, and escaped so that reading the output back gives the
very same turns. Everything is SQL expressions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, COLON, END = "### ", ": ", "</turn>\n"
#: Escapes of what the template uses, in this order; undone in the reverse order. The last is for roles.
ESCAPES = (("\\", "\\b"), ("</turn>", "\\t"), ("### ", "\\h"), (":", "\\c"))
TURNS = "array<struct<role:string,text:string>>"
_SCALARS = r"(?:STRING|VOID|BOOLEAN|BIGINT|FLOAT|DOUBLE|DECIMAL\(\d+,\d+\)|DATE|TIMESTAMP(?:_NTZ)?|BINARY|UUID|VARIANT)"


def _leaves(x: object) -> int:
    if isinstance(x, Mapping):
        return sum(_leaves(v) for v in x.values())
    return _leaves(x[0]) if isinstance(x, Sequence) and not isinstance(x, str) else 1


def _shape(x: object) -> str:
    """The field paths of a nested example in the notation of schema_of_variant, types left out."""
    if isinstance(x, Mapping):
        return "OBJECT<" + ", ".join(f"{k}: {_shape(x[k])}" for k in sorted(x)) + ">"
    if isinstance(x, Sequence) and not isinstance(x, str):
        return f"ARRAY<{_shape(x[0])}>"
    return "*"


@dataclass(frozen=True)
class Layout:
    """One shape of record. Either `parts`, fixed (role, path) pairs of which empty ones but the last
    are left out, or `items`, the path of a list, with the fields of its role and text."""

    name: str
    example: Mapping
    parts: tuple[tuple[str, str], ...] = ()
    items: str = ""
    role: str = "role"
    text: str = "content"
    roles: tuple[tuple[str, str], ...] = ()

    def fingerprint(self) -> str:
        return hashlib.sha256(_shape(self.example).encode()).hexdigest()

    def covers(self, record: Column) -> Column:
        """Whether the record has every declared field, in each item of a list, whatever else it has."""

        def has(value: Column, path: str) -> Column:
            return F.try_variant_get(value, f"$.{path}", "variant").isNotNull()

        tests = [has(record, key) for key in self.example if key != self.items]
        if self.items:
            items = F.try_variant_get(record, f"$.{self.items}", "array<variant>")
            tests += [F.size(items) > 0, F.forall(items, lambda m: has(m, self.role) & has(m, self.text))]
        return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))

    def turns(self, record: Column) -> Column:
        def get(path: str, kind: str = "string") -> Column:
            return F.try_variant_get(record, f"$.{path}", kind)

        def named(role: Column) -> Column:
            for was, canonical in self.roles:
                role = F.when(role == was, canonical).otherwise(role)
            return role

        def turn(role: Column, text: Column) -> Column:
            both = (F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
            return F.struct(*both)

        if self.items:
            found = get(self.items, f"array<struct<`{self.role}`:string,`{self.text}`:string>>")
            return F.transform(found, lambda m: turn(named(m[self.role]), m[self.text]))
        if self.role and not self.parts:
            return F.array(turn(named(get(self.role)), get(self.text)))
        last = len(self.parts) - 1
        made = [
            F.when(F.coalesce(get(path), F.lit("")) != "", turn(F.lit(role), get(path)))
            if i != last
            else turn(F.lit(role), get(path))
            for i, (role, path) in enumerate(self.parts)
        ]
        return F.filter(F.array(*made), lambda t: t.isNotNull())


_MESSAGE, _SAID = {"role": "", "content": ""}, {"from": "", "value": ""}
_HUMAN = (("human", "user"), ("gpt", "assistant"))
LAYOUTS = (
    Layout("turn", {"role": "", "text": ""}, role="role", text="text"),
    Layout("messages", {"messages": [_MESSAGE]}, items="messages"),
    Layout("named_messages", {"id": "", "messages": [_MESSAGE]}, items="messages"),
    Layout("said", {"conversations": [_SAID]}, items="conversations", role="from", text="value", roles=_HUMAN),
    Layout("prompt_response", {"prompt": "", "response": ""}, (("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_completion", {"prompt": "", "completion": ""}, (("user", "prompt"), ("assistant", "completion"))),
    Layout("question_answer", {"question": "", "answer": ""}, (("user", "question"), ("assistant", "answer"))),
    Layout("instruction", {"instruction": "", "output": ""}, (("user", "instruction"), ("assistant", "output"))),
    Layout(
        "instruction_input",
        {"instruction": "", "input": "", "output": ""},
        (("user", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
    Layout(
        "system_prompt",
        {"system": "", "prompt": "", "response": ""},
        (("system", "system"), ("user", "prompt"), ("assistant", "response")),
    ),
)


def schema_fingerprint(record: Column) -> Column:
    """SHA-256 of the nested field paths of a VARIANT; types and null values make no difference."""
    shape = F.regexp_replace(F.schema_of_variant(record), rf"(?<=: |^|<){_SCALARS}(?=[,>]|$)", "*")
    return F.sha2(shape, 256)


def canonical_turns(record: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """Array of (role, text) of a record, by the layout of its fingerprint; null for an unknown shape.

    Fields that no layout declares cost nothing: without an exact fingerprint the layout with the most
    fields that are all there counts, the first declared of equals.
    """
    mark = schema_fingerprint(record)
    choices = [(mark == layout.fingerprint(), layout) for layout in layouts]
    choices += [(layout.covers(record), layout) for layout in sorted(layouts, key=lambda x: -_leaves(x.example))]
    out = F.lit(None).cast(TURNS)
    for fits, layout in reversed(choices):
        out = F.when(fits, layout.turns(record)).otherwise(out)
    return out


def unknown_shapes(records: DataFrame, record_col: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """The shapes that no layout fits: `fingerprint`, `shape` and the number of records `n`.

    Null records have no shape. Shapes that differ in types only are one, with the first of them by name.
    """
    record = F.col(record_col)
    odd = records.where(record.isNotNull() & canonical_turns(record, layouts).isNull())
    marked = odd.select(schema_fingerprint(record).alias("fingerprint"), F.schema_of_variant(record).alias("shape"))
    return marked.groupBy("fingerprint").agg(F.min("shape").alias("shape"), F.count(F.lit(1)).alias("n"))


def escape(text: Column, role: bool = False) -> Column:
    for what, code in ESCAPES if role else ESCAPES[:-1]:
        text = F.replace(text, F.lit(what), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for what, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(what))
    return text


def format_conversations(
    records: DataFrame,
    id_col: str = "conv_id",
    order_col: str = "turn",
    record_col: str = "record",
    layouts: Sequence[Layout] = LAYOUTS,
) -> DataFrame:
    """One row per conversation: `formatted`, the marked text, `mask`, runs of (chars, loss), and `unknown`.

    The mask has three runs per turn: its header, its text, its end mark. Loss is on the texts of
    the assistant. Records are ordered by `order_col`, null last. A record that holds several
    turns keeps their order; records that tie take turns, by role and text. Null ids form one conversation. A record of unknown
    shape has no turn, and a conversation of such records an empty text; none is left out, and `unknown`
    holds the fingerprint of each such record (see `unknown_shapes`). A null record has no turn either and
    no fingerprint. Repeated records are repeated turns. The whole conversation is one text, so it must fit in a row.
    """
    turns = canonical_turns(F.col(record_col), layouts)
    mark = schema_fingerprint(F.col(record_col))
    rows = records.select(
        F.col(id_col).alias("id"), F.col(order_col).alias("at"), turns.alias("turns"), mark.alias("mark")
    )
    odd = F.when(F.col("turns").isNull(), F.col("mark")).alias("odd")
    rows = rows.select("id", "at", odd, F.posexplode_outer("turns").alias("pos", "said"))
    single = F.when(
        F.col("said").isNotNull(),
        F.struct(
            F.col("at").isNull().alias("late"), "at", "pos",
            F.col("said.role").alias("role"), F.col("said.text").alias("text"),
        ),
    )
    talks = rows.groupBy("id").agg(
        F.array_sort(F.collect_list(single)).alias("turns"), F.array_sort(F.collect_list("odd")).alias("unknown")
    )
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(START), escape(t["role"], role=True), F.lit(COLON)).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == "assistant").alias("loss"),
        ),
    )
    talks = talks.select("id", pieces.alias("pieces"), "unknown")
    text = F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END)))
    run = lambda chars, loss: F.struct(chars.cast("int").alias("chars"), loss.alias("loss"))
    runs = F.transform(
        "pieces",
        lambda p: F.array(
            run(F.length(p["head"]), F.lit(False)),
            run(F.length(p["body"]), p["loss"]),
            run(F.lit(len(END)), F.lit(False)),
        ),
    )
    return talks.select(F.col("id").alias(id_col), F.array_join(text, "").alias("formatted"), F.flatten(runs).alias("mask"), "unknown")


def read_back(formatted: Column, mask: Column) -> Column:
    """The turns (role, text, loss) of a formatted conversation, from its text and mask alone."""
    parts = F.split(formatted, END)
    parts = F.slice(parts, 1, F.size(parts) - 1)
    return F.transform(
        parts,
        lambda p, i: F.struct(
            unescape(F.substring_index(F.substr(p, F.lit(len(START) + 1)), COLON, 1)).alias("role"),
            unescape(F.substr(p, F.get(mask, 3 * i)["chars"] + 1, F.get(mask, 3 * i + 1)["chars"])).alias("text"),
            F.get(mask, 3 * i + 1)["loss"].alias("loss"),
        ),
    )
