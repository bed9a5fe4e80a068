"""Chat formatting: records of any known layout become canonical turns, then one text.

A record is a JSON object. The paths that it has, of those that any mapping reads, are
hashed to its fingerprint; the fingerprint selects the declarative mapping that says
where its turns are. Fields that no mapping reads don't count, so a record may carry more.

The template writes a turn as <s>role, a line break, the text, </s>. Control strings
inside a text get a backslash before their last part: </s> becomes </\\s>, and what looks
like that already gets one more, so that taking one away restores every text. Loss spans
give the places, in code points, of assistants' texts.

Only DataFrame functions are used. Turns are sorted within a conversation and joined
to one value, as the result has one row per conversation: a conversation must fit in memory,
and its turns are in one task. Everything before that deals with single records.
"""

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from daybook.llm.common import column

# Roles by other names, and the fields of layouts in use.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout are.

    Either `each` is the path of a list whose elements have the fields `role` and `text`, or
    `turns` lists fixed turns: a role and the path of its text, joined where there are several.
    `order` is the path of a record's place, for layouts with a record per turn.
    """

    name: str
    each: str | None = None
    role: str | None = None
    text: str | None = None
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    order: str | None = None

    @property
    def paths(self) -> list[str]:
        if self.each:
            return [f"{self.each}[0].{self.role}", f"{self.each}[0].{self.text}"]
        if self.order:
            return [self.order, self.role, self.text]
        return [path for _, paths in self.turns for path in paths]


def _fixed(name: str, *turns: tuple[str, ...]) -> Mapping:
    return Mapping(name, turns=tuple((role, paths) for role, *paths in map(tuple, turns)))


def _pairs() -> list[Mapping]:
    found = []
    for ask, answer in (("prompt", "completion"), ("prompt", "response"), ("question", "answer"), ("prompt", "chosen")):
        for system in ((), (("system", "system"),)):
            found.append(_fixed(f"{ask}-{answer}{'-system' * bool(system)}", *system, ("user", ask), ("assistant", answer)))
    for extra in ((), ("input",)):
        for system in ((), (("system", "system"),)):
            name = f"instruction{'-input' * bool(extra)}{'-system' * bool(system)}"
            found.append(_fixed(name, *system, ("user", "instruction", *extra), ("assistant", "output")))
    return found


MAPPINGS = (
    Mapping("messages", each="messages", role="role", text="content"),
    Mapping("nested-messages", each="data.messages", role="role", text="content"),
    Mapping("conversations", each="conversations", role="from", text="value"),
    Mapping("turn", role="role", text="text", order="turn"),
    *_pairs(),
)


def _vocabulary(mappings: tuple[Mapping, ...]) -> list[str]:
    return sorted({path for mapping in mappings for path in mapping.paths})


def fingerprint_of(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def fingerprint(record: Column, mappings: tuple[Mapping, ...] = MAPPINGS) -> Column:
    """Digest of a parsed record's paths, as fingerprint_of; a field that is null counts."""
    present = F.array(
        *(
            F.when(F.try_variant_get(record, f"$.{path}", "variant").isNotNull(), F.lit(path))
            for path in _vocabulary(mappings)
        )
    )
    return F.sha2(F.array_join(present, "\n"), 256)  # nulls are left out


_TURN = "array<struct<place bigint, role string, text string>>"


def _turns(record: Column, mapping: Mapping) -> Column:
    """The turns of a record of this layout."""

    def value(path: str, kind: str = "string") -> Column:
        return F.try_variant_get(record, f"$.{path}", kind)

    def named(role: Column) -> Column:
        return F.coalesce(F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))[role], role)

    def turn(place, role: Column, text: Column) -> Column:
        return F.struct(
            place.cast("bigint").alias("place"), role.alias("role"), F.coalesce(text, F.lit("")).alias("text")
        )

    if mapping.each:
        found = value(mapping.each, f"array<struct<`{mapping.role}`:string,`{mapping.text}`:string>>")
        return F.transform(found, lambda x, i: turn(i, named(x[mapping.role]), x[mapping.text]))
    if mapping.order:
        return F.array(turn(value(mapping.order, "bigint"), value(mapping.role), value(mapping.text)))
    return F.array(
        *(
            # An input that is null or empty adds no line.
            turn(F.lit(i), F.lit(role), F.concat_ws("\n", value(paths[0]), *(F.nullif(value(p), F.lit("")) for p in paths[1:])))
            for i, (role, paths) in enumerate(mapping.turns)
        )
    )


def to_turns(
    records: DataFrame,
    key: str = "conv_id",
    record: str = "record",
    mappings: tuple[Mapping, ...] = MAPPINGS,
) -> DataFrame:
    """(conv, layout, place, role, text) for every turn of every record.

    A null text is empty; null roles stay null. A record that is null, no JSON object, or of no
    known layout gives one row with null layout, place, role and text, and one
    without turns one with a layout. Records repeated are turns repeated. An empty table gives no
    rows; other columns are ignored.
    """
    parsed = records.select(column(key).alias("conv"), F.try_parse_json(column(record)).alias("record"))
    marked = parsed.withColumn("print", fingerprint(F.col("record"), mappings))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURN)
    for mapping in mappings:
        chosen = F.col("print") == fingerprint_of(mapping.paths)
        layout = F.when(chosen, F.lit(mapping.name)).otherwise(layout)
        turns = F.when(chosen, _turns(F.col("record"), mapping).cast(_TURN)).otherwise(turns)
    mapped = marked.select("conv", layout.alias("layout"), turns.alias("turns"))
    return mapped.select("conv", "layout", F.explode_outer("turns").alias("turn")).select(
        "conv", "layout", "turn.place", "turn.role", "turn.text"
    )


# Template

_OPEN, _CLOSE = "<s>", "</s>"
# What has a meaning in templates in use, without the backslashes that escape it.
_CONTROL = r"([<\[]/?)(\\*)(s>|INST\]|SYS\]|<SYS>>|\|im_start\|>|\|im_end\|>)"
# A role's line may hold none of these.
_ROLE_CODES = (("%", "%25"), ("\n", "%0A"), ("<", "%3C"), ("[", "%5B"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL.replace(r"(\\*)", r"\\(\\*)"), "$1$2$3")


def _role_line(role: Column) -> Column:
    found = F.coalesce(role, F.lit(""))
    for plain, code in _ROLE_CODES:
        found = F.replace(found, F.lit(plain), F.lit(code))
    return found


def _role_of(line: Column) -> Column:
    for plain, code in reversed(_ROLE_CODES):
        line = F.replace(line, F.lit(code), F.lit(plain))
    return line


def format_turns(turns: DataFrame, learned: str = "assistant") -> DataFrame:
    """Per conversation: conv, formatted, loss_spans (start and end, end exclusive, code points).

    Turns come in order of place, then role and text; a null role is an empty one. Rows
    without place, role and text mark a conversation that may have no turns. A null conv
    is a conversation like any other.
    """
    is_turn = F.col("place").isNotNull() | F.col("role").isNotNull() | F.col("text").isNotNull()
    body = escaped(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(_OPEN), _role_line(F.col("role")), F.lit("\n"))
    pieces = turns.select(
        "conv",
        "place",
        F.coalesce("role", F.lit("")).alias("role"),
        "text",
        F.when(is_turn, F.concat(head, body, F.lit(_CLOSE))).alias("piece"),
        F.when(is_turn & (F.col("role") == learned), F.length(body)).alias("learns"),
    )
    in_order = Window.partitionBy("conv").orderBy("place", "role", "text")
    before = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.length(F.coalesce("piece", F.lit("")))).over(before) - len(_CLOSE)
    placed = pieces.select(
        "conv",
        F.row_number().over(in_order).alias("at"),
        "piece",
        F.when(F.col("learns").isNotNull(), F.struct((end - F.col("learns")).alias("start"), end.alias("end"))).alias("loss"),
    )
    listed = F.array_sort(F.collect_list(F.struct("at", "piece", "loss")))
    joined = placed.groupBy("conv").agg(listed.alias("found"))
    return joined.select(
        "conv",
        F.concat_ws("", F.transform("found", lambda x: x["piece"])).alias("formatted"),
        F.transform(F.filter("found", lambda x: x["loss"].isNotNull()), lambda x: x["loss"]).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> as they were before formatting."""
    parts = F.split(formatted, _CLOSE)
    whole = F.slice(parts, 1, F.size(parts) - 1)  # after the last there is nothing
    inner = F.transform(whole, lambda part: F.substr(part, F.lit(len(_OPEN) + 1)))
    return F.transform(
        inner,
        lambda part: F.struct(
            _role_of(F.substring_index(part, "\n", 1)).alias("role"),
            unescaped(F.substr(part, F.locate("\n", part) + 1)).alias("text"),
        ),
    )


def read_learned(formatted: Column, loss_spans: Column) -> Column:
    """The texts under the loss mask, one after the other."""
    return F.concat_ws(
        "",
        F.transform(
            loss_spans,
            lambda span: unescaped(
                F.substr(formatted, span["start"].cast("int") + 1, (span["end"] - span["start"]).cast("int"))
            ),
        ),
    )


def format_chats(
    records: DataFrame, key: str = "conv_id", record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS
) -> DataFrame:
    """Per conversation: the key, formatted, loss_spans; see to_turns and format_turns for all cases."""
    return format_turns(to_turns(records, key, record, mappings)).withColumnRenamed("conv", key)


def turn_records(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows by turn as records of the layout `turn`, other columns left out; columns key and record."""
    fields = F.struct(column(turn).alias("turn"), column(role).alias("role"), column(text).alias("text"))
    return turns.select(column(key).alias(key), F.to_json(fields, {"ignoreNullFields": "false"}).alias("record"))
