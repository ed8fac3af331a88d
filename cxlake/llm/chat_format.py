"""Chat formatting by schema fingerprints (DataFrame functions only).

A record of any layout is a list of *leaves*: nested field paths with their texts,
in order (``prompt``, or ``messages[].role``). JSON records are read into leaves;
tables give theirs without a detour through JSON. The paths that some mapping reads
(other fields are ignored) are hashed, and the hash selects a declarative mapping,
which names the role and the field of each turn or the array that holds them. The
canonical form is an array of (role, text) turns.

The template writes a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``.
Control strings inside texts and roles are escaped reversibly: ``%`` becomes
``%25``, and the first character of a control string becomes its ``%`` code
(roles also escape line ends). So a marker in the output is always the
template's, and reading back is a split at the markers. The loss mask lists
the spans of the assistants' texts.

Defined results: null texts and roles are empty; rows of a conversation are
ordered by turn, role and text (null turns first), repeated rows repeat the
turn; a record whose fingerprint no mapping has, or that isn't a JSON object, gives
null turns; texts may be as long as a row may be (the JSON reader's own limit on
strings is lifted); input columns with the names of result columns are replaced. A
conversation is one sample, hence one row: its turns meet in one task.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
START_PATTERN, END_PATTERN = r"<\|im_start\|>", r"<\|im_end\|>\n"
# Control strings of common chat templates, by their first character.
CONTROL_ANGLE = r"<(?=\||/?s>|</?SYS>>)"
CONTROL_BRACKET = r"\[(?=/?INST\])"


# The JSON reader's limit on the length of a string, lifted to what a row can hold.
JSON_OPTIONS = {"maxStringLen": str(2**31 - 1)}
LEAVES = "array<struct<path:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns: fixed fields with roles, or an array with role and text fields.

    ``aliases`` renames the roles of an array layout."""

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    array: tuple[str, str, str] | None = None
    aliases: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        if self.array:
            path, role, text = self.array
            return sorted([f"{path}[].{role}", f"{path}[].{text}"])
        return sorted(field for _, field in self.fields)

    def fingerprint(self) -> str:
        return hashlib.sha256("\n".join(self.paths()).encode()).hexdigest()

    def turns(self, leaves: Column) -> Column:
        def texts(path: str) -> Column:
            return F.transform(F.filter(leaves, lambda x: x["path"] == path), lambda x: F.coalesce(x["text"], F.lit("")))

        if self.array:
            path, role, text = self.array
            pairs = F.arrays_zip(texts(f"{path}[].{role}").alias("role"), texts(f"{path}[].{text}").alias("text"))
            name = F.create_map(*[F.lit(x) for pair in self.aliases for x in pair]) if self.aliases else None

            def turn(m: Column) -> Column:
                known = F.coalesce(F.try_element_at(name, m["role"]), m["role"]) if self.aliases else m["role"]
                return F.struct(known.alias("role"), m["text"].alias("text"))

            return F.transform(pairs, turn)
        return F.array(*[F.struct(F.lit(role).alias("role"), texts(f)[0].alias("text")) for role, f in self.fields])


# Known layouts.
MAPPINGS = (
    Mapping("messages", array=("messages", "role", "content")),
    Mapping("conversations", array=("conversations", "from", "value"), aliases=(("human", "user"), ("gpt", "assistant"))),
    Mapping("prompt_response", fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt_completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("question_answer", fields=(("user", "question"), ("assistant", "answer"))),
    Mapping("instruction", fields=(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("instruction_output", fields=(("user", "instruction"), ("assistant", "output"))),
)


def json_leaves(record: Column, mappings: tuple[Mapping, ...] = MAPPINGS) -> Column:
    """Leaves of a JSON object: its fields, and for the arrays that mappings read, every element's fields in order
    (null where an element lacks a field that another one has). Null for what is no JSON object."""
    arrays = sorted({m.array[0] for m in mappings if m.array})
    fields = F.from_json(record, "map<string,string>", JSON_OPTIONS)

    def inside(array: str) -> Column:
        elements = F.from_json(F.try_element_at(fields, F.lit(array)), "array<map<string,string>>", JSON_OPTIONS)
        names = F.array_distinct(F.flatten(F.transform(elements, lambda m: F.map_keys(m))))
        leaves = F.transform(
            names, lambda k: F.transform(elements, lambda m: F.struct(F.concat(F.lit(f"{array}[]."), k).alias("path"), F.try_element_at(m, k).alias("text")))
        )
        return F.coalesce(F.flatten(leaves), F.array().cast(LEAVES))

    top = F.transform(F.map_entries(fields), lambda e: F.struct(e["key"].alias("path"), e["value"].alias("text")))
    return F.concat(top, *[inside(a) for a in arrays])


def fingerprint(leaves: Column, mappings: tuple[Mapping, ...] = MAPPINGS) -> Column:
    """Hash of the record's nested field paths, out of those that the mappings read."""
    known = sorted({p for m in mappings for p in m.paths()})
    paths = F.coalesce(F.transform(leaves, lambda x: x["path"]), F.array().cast("array<string>"))
    return F.sha2(F.array_join(F.array_sort(F.array_intersect(F.array(*[F.lit(p) for p in known]), paths)), "\n"), 256)


def leaves_to_turns(records: DataFrame, leaves_col: str = "leaves", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``records`` plus ``fingerprint`` and the canonical ``turns``."""
    marked = records.withColumn("fingerprint", fingerprint(F.col(leaves_col), mappings))
    turns = None
    for m in mappings:
        hit = F.col("fingerprint") == m.fingerprint()
        turns = F.when(hit, m.turns(F.col(leaves_col))) if turns is None else turns.when(hit, m.turns(F.col(leaves_col)))
    return marked.withColumn("turns", turns)


def to_turns(records: DataFrame, record_col: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``records`` with JSON text in ``record_col``, plus ``fingerprint`` and the canonical ``turns``."""
    with_leaves = records.withColumn("_leaves", json_leaves(F.col(record_col), mappings))
    return leaves_to_turns(with_leaves, "_leaves", mappings).drop("_leaves")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("%"), F.lit("%25"))
    out = F.regexp_replace(out, CONTROL_ANGLE, "%3C")
    return F.regexp_replace(out, CONTROL_BRACKET, "%5B")


def unescape(text: Column) -> Column:
    for code, char in (("%0A", "\n"), ("%3C", "<"), ("%5B", "["), ("%25", "%")):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def format_turns(samples: DataFrame) -> DataFrame:
    """``samples`` (with ``turns``) plus ``formatted`` and ``loss_spans`` (code points, end exclusive)."""
    escaped = F.transform(
        "turns",
        lambda t: F.struct(F.replace(escape(t["role"]), F.lit("\n"), F.lit("%0A")).alias("role"), escape(t["text"]).alias("text"), (t["role"] == "assistant").alias("loss")),
    )
    with_escaped = samples.withColumn("_turns", escaped)
    written = F.transform("_turns", lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END)))
    start = len(START) + 1
    spans = F.aggregate(
        "_turns",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + start + F.char_length(t["role"]) + F.char_length(t["text"]) + len(END)).alias("at"),
            F.when(
                t["loss"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + start + F.char_length(t["role"])).alias("start"),
                            (acc["at"] + start + F.char_length(t["role"]) + F.char_length(t["text"])).alias("end"),
                        )
                    ),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return with_escaped.withColumn("formatted", F.array_join(written, "")).withColumn("loss_spans", spans).drop("_turns")


def read_back(formatted: Column) -> Column:
    """The turns of a formatted sample."""
    parts = F.split(formatted, END_PATTERN, -1)
    whole = F.slice(parts, 1, F.size(parts) - 1)

    def turn(p: Column) -> Column:
        body = F.regexp_replace(p, "^" + START_PATTERN, "")
        role = F.substring_index(body, "\n", 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(body, F.char_length(role) + 2, F.char_length(body))).alias("text"))

    return F.transform(whole, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def conversation_records(rows: DataFrame) -> DataFrame:
    """Rows by turn -> (conv_id, leaves), in the layouts that such conversations come in.

    A user and an assistant turn are a pair under one of four names, a system turn before them
    an instruction with input and output; any other conversation is a list of messages, every
    other one under the names ``from`` and ``value`` with the roles human and gpt."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("m"))
    roles = F.transform("m", lambda t: t["role"])
    sequence = F.array_join(roles, "\n")

    def named(*paths: str) -> Column:
        return F.array(*[F.struct(F.lit(p).alias("path"), F.col("m")[i]["content"].alias("text")) for i, p in enumerate(paths)])

    def listed(array: str, role: str, text: str, names: dict[str, str]) -> Column:
        def said(t: Column) -> Column:
            name = t["role"]
            for plain, other in names.items():
                name = F.when(t["role"] == plain, other).otherwise(name)
            return F.array(
                F.struct(F.lit(f"{array}[].{role}").alias("path"), name.alias("text")), F.struct(F.lit(f"{array}[].{text}").alias("path"), t["content"].alias("text"))
            )

        return F.flatten(F.transform("m", said))

    way = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    pair = F.when(way == 0, named("prompt", "response")).when(way == 1, named("prompt", "completion")).when(way == 2, named("question", "answer"))
    pair = pair.otherwise(named("instruction", "output"))
    # a role that is called human or gpt keeps its name under the plain layout only
    plain = F.arrays_overlap(roles, F.array(F.lit("human"), F.lit("gpt"))) | (way % 2 == 0)
    messages = F.when(plain, listed("messages", "role", "content", {})).otherwise(listed("conversations", "from", "value", {"user": "human", "assistant": "gpt"}))
    leaves = F.when((F.size("m") == 2) & (sequence == "user\nassistant"), pair)
    leaves = leaves.when((F.size("m") == 3) & (sequence == "system\nuser\nassistant"), named("instruction", "input", "output")).otherwise(messages)
    return grouped.select("conv_id", leaves.alias("leaves"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """Rows by turn -> conv_id, leaves, fingerprint, turns, formatted, loss_spans."""
    return format_turns(leaves_to_turns(conversation_records(rows)))


def digests(samples: DataFrame) -> DataFrame:
    """What a reader of the output sees: counts and digests of the turns and of the text under the loss mask."""
    seen = samples.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return seen.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
