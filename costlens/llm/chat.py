"""Chat formatting by schema fingerprinting (operator 7). DataFrame functions only.

Method. Records come as JSON in different layouts. A record's layout is the set of
its nested field paths, whatever the values; its hash is the fingerprint. It is taken
from a copy of the record without its values (texts emptied, numbers 0, equal neighbours
in lists once), so neither long texts nor many turns change it. A small
table maps fingerprints to declarative mappings, which say where the turns of such
a record are, and turn it into canonical turns of (role, text). Layouts without a
mapping are kept and named in ``layout``, with no turns.

Template. A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts a
backslash becomes two and ``<|`` becomes ``<\\|``; a line feed in a role becomes
``\\n``. So no text can hold a control string, and unescaping gives it back. The
loss mask is the list of spans (start, length in code points) of the assistants'
texts.

Defined results: a null text is empty, a null role is ``user``; turns are ordered by
their number, nulls first, then role and text; repeated turns stay; a conversation
without turns has an empty string. A null record, or one that isn't JSON, has the
fingerprint of no fields. Conversations are strings: one must fit into a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TURN = "struct<turn:bigint,role:string,text:string>"

#: Layouts: name -> (an example record, its turns as (role, path) or a list of turns at
#: (path of the list, role field, text field, names of roles that mean others)).
LAYOUTS = {
    "row": ('{"turn": 0, "role": "", "text": ""}', [("$.role", "$.text")]),
    "row without text": ('{"turn": 0, "role": ""}', [("$.role", None)]),
    "row without role": ('{"turn": 0, "text": ""}', [("user", "$.text")]),
    "bare row": ('{"turn": 0}', [("user", None)]),
    "prompt": ('{"prompt": "", "completion": ""}', [("user", "$.prompt"), ("assistant", "$.completion")]),
    "prompt response": ('{"prompt": "", "response": ""}', [("user", "$.prompt"), ("assistant", "$.response")]),
    "instruction": ('{"instruction": "", "output": ""}', [("user", "$.instruction"), ("assistant", "$.output")]),
    "instruction input": (
        '{"instruction": "", "input": "", "output": ""}',
        [("user", ("$.instruction", "$.input")), ("assistant", "$.output")],
    ),
    "system instruction": (
        '{"system": "", "instruction": "", "output": ""}',
        [("system", "$.system"), ("user", "$.instruction"), ("assistant", "$.output")],
    ),
    "messages": ('{"messages": [{"role": "", "content": ""}]}', ("$.messages", "role", "content")),
    "conversations": ('{"conversations": [{"from": "", "value": ""}]}', ("$.conversations", "from", "value")),
}
#: Names that layouts give to the canonical roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


#: The JSON reader's own limit of a text's length is raised to what a string can hold.
_ANY_LENGTH = {"maxStringLen": str((1 << 31) - 1)}
_LIST = "array<struct<`{0}`:string,`{1}`:string>>"


def _skeleton(record: Column) -> Column:
    """The record without its values. Escapes are blanked first, so that a string ends at the next
    quote; a string before a colon is a name and stays."""
    bare = F.replace(F.replace(record, F.lit("\\\\"), F.lit("??")), F.lit('\\"'), F.lit("??"))
    bare = F.regexp_replace(bare, r'("[^"]*+"\s*+:)|(")[^"]*+(")', "$1$2$3")
    bare = F.regexp_replace(bare, r"(?<=[:\[,\s])-?[0-9][0-9.eE+-]*+(?=\s*+[,\]}])", "0")
    return F.regexp_replace(bare, r"(\{[^{}]*+\}\s*+,\s*+)(?=\1)", "")


def paths(record: Column) -> Column:
    """The nested field paths of a JSON text, in one canonical string: the record's shape
    without its scalar types."""
    shape = F.schema_of_variant(F.try_parse_json(_skeleton(record)))
    shape = F.regexp_replace(shape, r"\b(VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|STRING|VARIANT|DATE|TIMESTAMP|DECIMAL\(\d+,\d+\))(?=[,>]|$)", "_")
    return F.coalesce(shape, F.lit(""))


def fingerprint(record: Column) -> Column:
    """A hash of the record's nested field paths."""
    return F.xxhash64(paths(record))


def _fields() -> str:
    """The type of a record with the fields of all layouts; a text of another kind is read as its JSON."""
    lists = {m[0]: _LIST.format(*m[1:]) for _, m in LAYOUTS.values() if isinstance(m, tuple)}
    plain = {p for _, m in LAYOUTS.values() if isinstance(m, list) for turn in m for x in turn
             for p in (x if isinstance(x, tuple) else [x]) if p and p.startswith("$.")}
    return ", ".join(f"`{p.removeprefix('$.')}` {kind}" for p, kind in [("$.turn", "string"), *sorted((p, "string") for p in plain), *sorted(lists.items())])


def _get(record: Column, path: str | None) -> Column:
    return F.lit("") if path is None else F.coalesce(record[path.removeprefix("$.")], F.lit(""))


def _turns(record: Column, mapping, aliases: bool = True) -> Column:
    """The turns of a parsed record under a mapping: an array of (turn, role, text); without
    ``aliases`` a role that the record itself names in a row layout stays as it is."""
    if isinstance(mapping, tuple):
        at, role, text = mapping
        made = F.transform(record[at.removeprefix("$.")], lambda x, i: F.struct(i.cast("long").alias("turn"), _role(x[role]).alias("role"), F.coalesce(x[text], F.lit("")).alias("text")))
        return F.coalesce(made, F.array().cast(f"array<{TURN}>"))
    out = []
    for i, (role, path) in enumerate(mapping):
        if isinstance(path, tuple):  # joined by an empty line, but for empty parts
            parts = F.filter(F.array(*[_get(record, p) for p in path]), lambda x: x != "")
            text = F.array_join(parts, "\n\n")
        else:
            text = _get(record, path)
        number = record["turn"].try_cast("long") if len(mapping) == 1 else F.lit(i).cast("long")  # a null number stays null
        said = record[role.removeprefix("$.")] if role.startswith("$.") else F.lit(role)
        name = _role(said) if aliases else F.coalesce(said, F.lit("user"))
        out.append(F.struct(number.alias("turn"), name.alias("role"), text.alias("text")))
    return F.array(*out)


def _role(name: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, name), name, F.lit("user"))


def canonical_turns(records: DataFrame, record: str, key: str, row_aliases: bool = True) -> DataFrame:
    """(key, layout, fingerprint, turn, role, text): a row for each turn of the JSON texts in
    column ``record``; a record in no known layout gives one row with a null layout and turn.
    Without ``row_aliases`` the names of ``ROLES`` stay as they are in the row layouts, whose
    roles are then canonical already."""
    spark = records.sparkSession
    known = spark.createDataFrame([(n, x) for n, (x, _) in LAYOUTS.items()], "layout string, example string")
    prints = {r["layout"]: r["f"] for r in known.select("layout", fingerprint(F.col("example")).alias("f")).collect()}
    said = F.col(record).cast("string")
    rows = records.select(F.col(key).alias(key), fingerprint(said).alias("fingerprint"), F.from_json(said, _fields(), _ANY_LENGTH).alias("__record"))
    layout, turns = F.lit(None).cast("string"), F.array(F.lit(None).cast(TURN))
    for name, (_, mapping) in LAYOUTS.items():
        mine = F.col("fingerprint") == prints[name]
        layout = F.when(mine, name).otherwise(layout)
        turns = F.when(mine, _turns(F.col("__record"), mapping, row_aliases).cast(f"array<{TURN}>")).otherwise(turns)
    rows = rows.select(key, layout.alias("layout"), "fingerprint", F.explode(turns).alias("__turn"))
    return rows.select(key, "layout", "fingerprint", "__turn.turn", "__turn.role", "__turn.text")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """The inverse of ``escape``: a single backslash stands between ``<`` and a bar only
    where it was put, all others are double."""
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def format_chat(turns: DataFrame, key: str) -> DataFrame:
    """(key, formatted, loss): the conversation of each key from canonical turns, and the
    spans of its loss mask as (start, length), from 0, in code points."""
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    rows = turns.select(key, "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    body = escape(F.col("text"))
    rows = rows.withColumn("__body", body).withColumn("__head", F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")))
    rows = rows.withColumn("__piece", F.concat("__head", "__body", F.lit(END + "\n")))
    by = Window.partitionBy(key).orderBy(*order)
    ahead = F.coalesce(F.sum(F.length("__piece")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.select(
        key,
        F.row_number().over(by).alias("n"),
        F.col("__piece").alias("piece"),
        F.when(F.col("role") == "assistant", F.struct((ahead + F.length("__head")).cast("long").alias("start"), F.length("__body").cast("long").alias("length"))).alias("span"),
    )
    pieces = F.sort_array(F.collect_list(F.struct("n", "piece", "span")))
    out = rows.groupBy(key).agg(pieces.alias("__all"))
    spans = F.transform(F.filter("__all", lambda x: x["span"].isNotNull()), lambda x: x["span"])
    return out.select(key, F.array_join(F.transform("__all", lambda x: x["piece"]), "").alias("formatted"), spans.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, in order."""
    pieces = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        body = F.substring_index(F.substr(piece, F.length(head) + 2), END, 1)
        return F.struct(unescape_role(head).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))


def digests(chats: DataFrame, key: str) -> DataFrame:
    """What the formatted conversations hold, read back from them: (key, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars)."""
    chats = chats.withColumn("__turns", read_turns(F.col("formatted"))).withColumn("__loss", F.array_join(read_loss(F.col("formatted"), F.col("loss")), ""))
    lines = F.array_join(F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return chats.select(
        key,
        F.size("__turns").cast("long").alias("n_turns"),
        sha(lines).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"),
        sha(F.col("__loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
