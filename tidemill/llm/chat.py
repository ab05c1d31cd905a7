"""Chat formatting: schema fingerprints select declarative mappings from heterogeneous layouts to canonical turns.

A payload is a JSON object in any of the layouts of MAPPINGS. Its fingerprint is the SHA-256 of its nested field paths,
sorted, without scalar types and without paths that say nothing of turns (IGNORED). A mapping declares examples of the
shapes that it reads; the row whose fingerprint is one of theirs gets that mapping's turns. A row whose fingerprint no
mapping declares keeps turns null and layout null, and is never dropped. A table with a row for each turn is restated as
payloads first (payloads), as a corpus of several sources has them, so that all turns come through fingerprints and
mappings. Turns are then written with a template that marks them and escapes control strings inside texts reversibly:

    ### role: text</turn>

In roles and texts a backslash becomes \\b, # becomes \\h, </turn> becomes \\l/turn>, and in roles : becomes \\c; so no
text can hold a mark. Loss spans are code point ranges of the assistant's escaped texts in the formatted string.

Everything here is DataFrame functions. Defined results: null roles and texts are empty; rows of a conversation go by
turn (null first), then role, then text, so ties and repeated rows have one order; a null conv_id is a conversation of
its own; an empty list has no turns; an empty table gives an empty one; further columns are ignored, whatever their names. A
payload that Spark can't parse (beyond its limit for one variant, 128 MiB) has no fingerprint: canonical() leaves its turns
null, and format_rows() takes them from the table's own columns, so that every row's role and text come back as they went
in. A conversation becomes one string, so its turns meet in one task: that is the result asked for, and its size bounds the
memory.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
SCALAR = r"\b(STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|VOID|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|INT|SMALLINT|TINYINT|UUID|DECIMAL\(\d+,\d+\))(?=[,>]|$)"
#: Fields beside the turns that many sources carry, at any depth, if they hold a scalar or a list of scalars.
IGNORED = ("id", "uid", "uuid", "name", "source", "dataset", "lang", "language", "category", "model", "score", "weight", "tags", "timestamp", "created")


@dataclass(frozen=True)
class Mapping:
    """A layout: its shapes as example payloads, and how its parts become turns.

    kind list: parts are the list, role and text, and roles (pairs of a role in any case of letters and its canonical one)
    are the layout's own names, any other role being kept; fields: parts are (field, role) pairs in order, empty fields give
    no turn.
    """

    name: str
    examples: tuple[str, ...]
    kind: str
    parts: tuple
    roles: tuple = ()


MAPPINGS = (
    Mapping("messages", ('{"messages": [{"role": "", "content": ""}]}', '{"messages": []}', '{"messages": [{"content": ""}]}'), "list", ("messages", "role", "content")),
    Mapping("shares", ('{"conversations": [{"from": "", "value": ""}]}', '{"conversations": []}'), "list", ("conversations", "from", "value"), (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))),
    Mapping("prompt-response", ('{"prompt": "", "response": ""}', '{"prompt": ""}'), "fields", (("prompt", "user"), ("response", "assistant"))),
    Mapping("prompt-completion", ('{"prompt": "", "completion": ""}',), "fields", (("prompt", "user"), ("completion", "assistant"))),
    Mapping("system-prompt-response", ('{"system": "", "prompt": "", "response": ""}',), "fields", (("system", "system"), ("prompt", "user"), ("response", "assistant"))),
    Mapping("question-answer", ('{"question": "", "answer": ""}',), "fields", (("question", "user"), ("answer", "assistant"))),
    Mapping("instruction", ('{"instruction": "", "output": ""}',), "fields", (("instruction", "user"), ("output", "assistant"))),
    Mapping("instruction-input", ('{"instruction": "", "input": "", "output": ""}',), "fields", (("instruction+input", "user"), ("output", "assistant"))),
)


def paths(value: Column) -> Column:
    """The nested field paths of a variant, sorted, scalars as *, without those of IGNORED."""
    plain = F.regexp_replace(F.schema_of_variant(value), SCALAR, "*")
    some = F.regexp_replace(plain, r"(?<=[<\s])(" + "|".join(IGNORED) + r"): (\*|ARRAY<\*>)(, |(?=>))", "")
    return F.regexp_replace(some, ", >", ">")


def fingerprint(payload: Column) -> Column:
    """Of a JSON string (null if it isn't JSON)."""
    return F.sha2(paths(F.try_parse_json(payload)), 256)


def declared(example: str) -> str:
    """The fingerprint that payloads of an example's shape have, worked out once on the driver."""

    def told(x) -> str:
        if isinstance(x, dict):
            fields = sorted((k, told(v)) for k, v in x.items())
            return "OBJECT<" + ", ".join(f"{k}: {v}" for k, v in fields if k not in IGNORED or v not in ("*", "ARRAY<*>")) + ">"
        return f"ARRAY<{told(x[0]) if x else '*'}>" if isinstance(x, list) else "*"

    return hashlib.sha256(told(json.loads(example)).encode()).hexdigest()


def _role(told: Column, names: tuple) -> Column:
    known = F.coalesce(told, F.lit(""))
    for name, role in names:
        known = F.when(F.lower(told) == name, role).otherwise(known)
    return known


def canonical(rows: DataFrame, payload: str, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """rows with layout (a mapping's name or null) and turns (array of role, text; null if the layout is unknown)."""
    known = rows.withColumn("_value", F.try_parse_json(F.col(payload)))
    known = known.withColumn("_fingerprint", F.sha2(paths(F.col("_value")), 256))
    value = F.col("_value")
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    mark = F.col("_fingerprint")
    for m in mappings:
        if m.kind == "list":
            path, who, what = m.parts
            items = F.try_variant_get(value, f"$.{path}", f"array<struct<`{who}`:string,`{what}`:string>>")
            own = F.transform(items, lambda x: F.struct(_role(x[who], m.roles).alias("role"), F.coalesce(x[what], F.lit("")).alias("text")))
        else:
            built = []
            for field, who in m.parts:
                texts = [F.nullif(F.try_variant_get(value, f"$.{x}", "string"), F.lit("")) for x in field.split("+")]
                built.append(F.struct(F.lit(who).alias("role"), F.concat_ws("\n", *texts).alias("text")))
            own = F.filter(F.array(*built), lambda x: x["text"] != "")
        hit = mark.isin(*map(declared, m.examples))
        layout, turns = F.when(hit, F.lit(m.name)).otherwise(layout), F.when(hit, own.cast(TURNS)).otherwise(turns)
    return known.withColumns({"layout": layout, "turns": turns}).drop("_value", "_fingerprint")


def payloads(turns: DataFrame) -> DataFrame:
    """conv_id, n, payload, own: rows of a table (conv_id, turn, role, text) as JSON in several layouts, beside their turns.

    A user's text and the assistant's after it become one payload, in the layout that a hash of the conversation and the
    place say, if neither is empty; any other row is a list of one message. n is the place of a payload's first turn.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    full = F.col("text") != ""
    rows = rows.withColumns({"asks": (F.col("role") == "user") & full, "answers": (F.col("role") == "assistant") & full})
    after = F.lead(F.when(F.col("answers"), F.col("text"))).over(order)
    rows = rows.select("conv_id", "role", "text", "asks", "answers", F.row_number().over(order).alias("n"), after.alias("text1"), F.lag("asks", 1, False).over(order).alias("asked"))
    pair, taken = F.col("asks") & F.col("text1").isNotNull(), F.col("answers") & F.col("asked")
    two = lambda a, b, *more: F.to_json(F.struct(F.col("text").alias(a), F.col("text1").alias(b), *more))
    said = lambda who, what, role, text: F.struct(role.alias(who), text.alias(what))
    both = lambda who, what: F.array(said(who, what, F.col("role"), F.col("text")), said(who, what, F.lit("assistant"), F.col("text1")))
    kinds = (
        two("prompt", "response"),
        two("instruction", "output", F.col("n").alias("id"), F.lit("rows").alias("source")),
        F.to_json(F.struct(both("role", "content").alias("messages"))),
        F.to_json(F.struct(F.col("n").alias("id"), both("from", "value").alias("conversations"))),
        two("question", "answer", F.array(F.lit("rows")).alias("tags")),
    )
    at, made = F.pmod(F.xxhash64("conv_id", "n"), F.lit(len(kinds))), F.to_json(F.struct(F.array(said("role", "content", F.col("role"), F.col("text"))).alias("messages")))
    for i, kind in enumerate(kinds):
        made = F.when(pair & (at == i), kind).otherwise(made)
    turn = lambda role, text: F.struct(role.alias("role"), text.alias("text"))
    alone = turn(F.col("role"), F.col("text"))
    own = F.when(pair, F.array(alone, turn(F.lit("assistant"), F.col("text1")))).otherwise(F.array(alone)).cast(TURNS)
    return rows.filter(~taken).select("conv_id", "n", made.alias("payload"), own.alias("own"))


def escape(text: Column, role: bool = False) -> Column:
    for a, b in (("\\", "\\b"), ("#", "\\h"), ("</turn>", "\\l/turn>"), *([(":", "\\c")] * role)):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def unescape(text: Column) -> Column:
    for a, b in ((":", "\\c"), ("<", "\\l"), ("#", "\\h"), ("\\", "\\b")):
        text = F.replace(text, F.lit(b), F.lit(a))
    return text


END = "</turn>\n"


def format_rows(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss: one row for each conversation of a table with a row for each turn (conv_id, turn, role, text)."""
    told = canonical(payloads(turns.select("conv_id", "turn", "role", "text")), "payload")
    # (outer, since a plain explode would have the turns worked out once more, to see first whether there are any)
    spoken = told.select("conv_id", "n", F.posexplode_outer(F.coalesce("turns", "own")).alias("pos", "t")).filter("pos is not null")
    return formatted(spoken.select("conv_id", (F.col("n") + F.col("pos")).alias("n"), "t.role", "t.text"))


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss (array of start, size in code points) of canonical turns (conv_id, n, role, text)."""
    head, body = F.concat(F.lit("### "), escape(F.col("role"), role=True), F.lit(": ")), escape(F.col("text"))
    rows = turns.select("conv_id", "n", "role", F.concat(head, body, F.lit(END)).alias("piece"), F.length(head).alias("head"), F.length(body).alias("size"))
    order = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length("piece")).over(order), F.lit(0))
    rows = rows.select("conv_id", "n", "piece", (before + F.col("head")).alias("start"), F.col("size").cast("long").alias("size"), (F.col("role") == "assistant").alias("loss"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "piece", "start", "size", "loss"))).alias("parts"))
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter("parts", lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), x["size"].alias("size"))).alias("loss"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted string: array of role, text."""
    pieces = F.split(formatted, END, -1)
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(unescape(F.substring(F.substring_index(p, ": ", 1), F.lit(5), F.length(p))).alias("role"), unescape(F.substring(p, F.locate(": ", p) + 2, F.length(p))).alias("text")),
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda x: unescape(F.substring(formatted, x["start"].cast("int") + 1, x["size"].cast("int")))), "")
