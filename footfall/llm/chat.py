"""Chat formatting with schema fingerprints.

Records are JSON of unlike layouts. A record's fingerprint is the hash of its nested field paths
(``messages[].role`` and so on; values and types do not count). The fingerprint selects a
declarative mapping, which tells where turns, roles and texts are; the result is one list of
turns with canonical roles. Everything is DataFrame expressions.

The template writes ``### <role>: <text></turn>`` and a line end per turn. Inside role and text a
backslash, ``<`` and ``#`` are written ``\\b``, ``\\l`` and ``\\h``, and in a role ``:`` is
``\\c``, so that no control string can occur there and reading back is exact.

A record whose fingerprint is unknown keeps its row with null turns. Null texts and roles count as
empty; a null record has a null fingerprint. A layout's optional empty field gives no turn.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN = "struct<role: string, text: string>"


@dataclass(frozen=True)
class Mapping:
    """``schema``: the record's fields. Either ``items``: a list field with the names of its role
    and text fields, or ``fields``: (role, text field, whether it may be missing or empty)."""

    schema: str
    paths: tuple[str, ...]
    items: tuple[str, str, str] | None = None
    fields: tuple[tuple[str, str, bool], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


# Layouts in common use. Paths are sorted.
MAPPINGS = {
    "messages": Mapping(
        "messages array<struct<role: string, content: string>>",
        ("messages", "messages[].content", "messages[].role"),
        items=("messages", "role", "content"),
    ),
    "share": Mapping(
        "conversations array<struct<`from`: string, value: string>>",
        ("conversations", "conversations[].from", "conversations[].value"),
        items=("conversations", "from", "value"),
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    "prompt": Mapping(
        "prompt string, completion string",
        ("completion", "prompt"),
        fields=(("user", "prompt", False), ("assistant", "completion", False)),
    ),
    "instruction": Mapping(
        "instruction string, input string, output string",
        ("input", "instruction", "output"),
        fields=(("system", "instruction", False), ("user", "input", True), ("assistant", "output", False)),
    ),
}


def _paths_of_schema(schema: Column) -> Column:
    """Field paths of a schema text such as ``OBJECT<a: ARRAY<OBJECT<b: STRING>>>``.

    Scalar types are dropped, arrays become ``[]``: the nesting itself is the list of paths in
    order, as object fields are sorted by name."""
    nested = F.regexp_replace(schema, r"ARRAY<", "[")
    scalar = r": (VOID|STRING|BIGINT|BOOLEAN|DOUBLE|FLOAT|DECIMAL\([0-9,]+\)|VARIANT)"
    return F.regexp_replace(nested, scalar, "")


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a JSON text; null where it is not JSON."""
    return F.sha2(_paths_of_schema(F.schema_of_variant(F.try_parse_json(record))), 256)


def _nested(paths: tuple[str, ...]) -> str:
    """The same text as `_paths_of_schema` gives for a record with these paths."""
    lists = {p.split("[].")[0] for p in paths if "[]." in p}
    parts = []
    for path in paths:
        if path in lists:
            inner = [p.split("[].")[1] for p in paths if p.startswith(f"{path}[].")]
            parts.append(f"{path}: [OBJECT<{', '.join(inner)}>>")
        elif "[]." not in path:
            parts.append(path)
    return f"OBJECT<{', '.join(parts)}>"


def _known() -> dict[str, str]:
    """Mapping name to fingerprint."""
    return {name: hashlib.sha256(_nested(m.paths).encode()).hexdigest() for name, m in MAPPINGS.items()}


def _turns(record: Column, mapping: Mapping) -> Column:
    parsed = F.from_json(record, mapping.schema)

    def role(value: Column) -> Column:
        out = F.coalesce(value, F.lit(""))
        for theirs, ours in mapping.roles:
            out = F.when(value == theirs, ours).otherwise(out)
        return out

    if mapping.items:
        name, who, what = mapping.items
        return F.transform(
            parsed[name],
            lambda t: F.struct(role(t[who]).alias("role"), F.coalesce(t[what], F.lit("")).alias("text")),
        )
    listed = F.array(
        *(
            F.struct(
                F.lit(who).alias("role"),
                F.coalesce(parsed[field], F.lit("")).alias("text"),
                F.lit(optional).alias("optional"),
            )
            for who, field, optional in mapping.fields
        )
    )
    full = F.filter(listed, lambda t: ~t["optional"] | (t["text"] != ""))
    return F.transform(full, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def canonical_turns(records: DataFrame, record_col: str = "record") -> DataFrame:
    """``records`` with ``layout_hash``, ``layout`` (null if unknown) and ``turns``."""
    plain = records.drop("layout_hash", "layout", "turns").withColumn("layout_hash", fingerprint(F.col(record_col)))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(f"array<{TURN}>")
    for name, known in _known().items():
        layout = F.when(F.col("layout_hash") == known, name).otherwise(layout)
        turns = F.when(F.col("layout_hash") == known, _turns(F.col(record_col), MAPPINGS[name])).otherwise(turns)
    return plain.withColumn("layout", layout).withColumn("turns", turns)


def escape(text: Column) -> Column:
    for plain, coded in (("\\", "\\b"), ("<", "\\l"), ("#", "\\h")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in ((":", "\\c"), ("#", "\\h"), ("<", "\\l"), ("\\", "\\b")):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _head(turn: Column) -> Column:
    role = F.replace(escape(turn["role"]), F.lit(":"), F.lit("\\c"))
    return F.concat(F.lit("### "), role, F.lit(": "))


def formatted(turns: Column) -> Column:
    return F.array_join(
        F.transform(turns, lambda t: F.concat(_head(t), escape(t["text"]), F.lit("</turn>\n"))), ""
    )


def loss_spans(turns: Column) -> Column:
    """``start, length`` (code points) of each assistant text in the formatted text."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start: bigint, length: bigint>>").alias("spans"))

    def step(held: Column, t: Column) -> Column:
        head = F.char_length(_head(t)).cast("long")
        body = F.char_length(escape(t["text"])).cast("long")
        span = F.struct((held["at"] + head).alias("start"), body.alias("length"))
        return F.struct(
            (held["at"] + head + body + F.lit(len("</turn>\n"))).alias("at"),
            F.when(t["role"] == "assistant", F.concat(held["spans"], F.array(span))).otherwise(held["spans"]).alias("spans"),
        )

    return F.aggregate(turns, start, step, lambda held: held["spans"])


def read_back(text: Column) -> Column:
    """Turns of a formatted text."""
    lines = F.filter(F.split(text, "</turn>\n", -1), lambda p: p != "")
    return F.transform(
        lines,
        lambda p: F.struct(
            unescape(F.substring(p, F.lit(5), F.instr(p, ": ") - F.lit(5))).alias("role"),
            unescape(F.substring(p, F.instr(p, ": ") + F.lit(2), F.char_length(p))).alias("text"),
        ),
    )


def masked_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(text, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def format_records(records: DataFrame, record_col: str = "record") -> DataFrame:
    """`canonical_turns` with ``formatted`` and ``loss_spans``."""
    turned = canonical_turns(records, record_col)
    return turned.withColumn("formatted", formatted(F.col("turns"))).withColumn("loss_spans", loss_spans(F.col("turns")))
