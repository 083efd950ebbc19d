"""Chat formatting: layouts found by a fingerprint of their field paths, one template, and a loss mask.

Records come as JSON texts or as table rows. The nested field paths of a record (``messages[].role``), of all items of its
lists, or of a table's schema are cut to those that some layout names, sorted and hashed; the hash selects a declarative
``Layout`` that says where roles and texts lie. Further paths (an id, a weight) do not matter; in a record a path of another
layout does, so that no turn is lost unseen. Everything is SQL functions.

Template: every turn is ``<s>[INST]role[/INST]text</s>``. A control string inside a role or a text gets one backslash after
its first character, also when it already has some there, so that taking one away gives the text back exactly.

Defined cases: a null text or role counts as empty; turns are ordered by turn (null first), role, text; repeated rows are
turns of their own; rows without a conversation id form one conversation; a record of unknown layout (an empty list of turns
included) raises nothing but is returned by ``unknown_records``; a table of unknown layout raises; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

# The control strings of the template.
TURN_START, TURN_END, HEAD_START, HEAD_END = "<s>", "</s>", "[INST]", "[/INST]"
_CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
_ESCAPED = r"([<\[])(\\*)\\(/?s>|/?INST\])"


@dataclass(frozen=True)
class Layout:
    """Where a layout keeps its turns.

    ``list_path``: JSON path of a list of turns with the fields ``role`` and ``text``; or else ``fields``: (role, name)
    pairs of top-level texts that become turns in this order, the empty ones left out. ``roles`` renames roles.
    """

    paths: tuple[str, ...]
    list_path: str | None = None
    role: str | None = None
    text: str | None = None
    fields: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


LAYOUTS = (
    Layout(("messages[].content", "messages[].role"), "messages", "role", "content"),
    Layout(("conversations[].from", "conversations[].value"), "conversations", "from", "value",
           roles=(("human", "user"), ("gpt", "assistant"))),
    Layout(("prompt", "response"), fields=(("user", "prompt"), ("assistant", "response"))),
    Layout(("completion", "prompt"), fields=(("user", "prompt"), ("assistant", "completion"))),
    Layout(("instruction", "output"), fields=(("user", "instruction"), ("assistant", "output"))),
    Layout(("input", "instruction", "output"),
           fields=(("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout(("output", "prompt", "system"), fields=(("system", "system"), ("user", "prompt"), ("assistant", "output"))),
)
#: Layouts of tables: a row per turn, or a row per conversation with a list of turns.
ROWS = Layout(("conv_id", "role", "text", "turn"), role="role", text="text")
LISTS = tuple(Layout(("conv_id", *x.paths), x.list_path, x.role, x.text, roles=x.roles) for x in LAYOUTS if x.list_path)
TABLES = (ROWS, *LISTS)


def fingerprint(paths: Column) -> Column:
    """Hash of an array of field paths, whatever their order."""
    return F.xxhash64(F.array_join(F.array_sort(paths), "\n"))


def paths_of(payload: Column) -> Column:
    """Field paths of a JSON object: its keys, and for a list of objects the keys of all of them."""
    keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    lists = F.from_json(payload, "map<string,string>")

    def below(key: Column) -> Column:
        items = F.from_json(F.when(F.element_at(lists, key).startswith("["), F.element_at(lists, key)), "array<map<string,string>>")
        names = F.array_distinct(F.flatten(F.transform(F.filter(items, lambda m: m.isNotNull()), F.map_keys)))
        return F.when(F.size(names) > 0, F.transform(names, lambda s: F.concat(key, F.lit("[]."), s))).otherwise(F.array(key))

    return F.flatten(F.transform(keys, below))


def _named(paths: Column, layouts: tuple[Layout, ...]) -> Column:
    """Those of the paths that some layout names."""
    return F.array_intersect(paths, F.array(*map(F.lit, sorted({p for x in layouts for p in x.paths}))))


def schema_paths(schema: StructType, below: str = "") -> list[str]:
    """Field paths of a table, sorted."""
    found: list[str] = []
    for f in schema.fields:
        kind, name = f.dataType, below + f.name
        if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
            found += schema_paths(kind.elementType, name + "[].")
        elif isinstance(kind, StructType):
            found += schema_paths(kind, name + ".")
        else:
            found.append(name)
    return sorted(found)


def _known(layouts: tuple[Layout, ...]) -> list[Column]:
    return [fingerprint(F.array(*map(F.lit, x.paths))) for x in layouts]


def _renamed(turns: Column, layout: Layout) -> Column:
    if not layout.roles:
        return turns
    named = F.create_map(*[F.lit(v) for pair in layout.roles for v in pair])
    return F.transform(turns, lambda t: F.struct(
        F.coalesce(named[F.coalesce(t["role"], F.lit(""))], t["role"]).alias("role"), t["text"].alias("text")))


def _turns(layout: Layout) -> Column:
    if layout.list_path:
        items = F.from_json(F.get_json_object(F.col("_payload"), f"$.{layout.list_path}"), "array<map<string,string>>")
        own = F.transform(items, lambda m: F.struct(
            F.element_at(m, layout.role).alias("role"), F.element_at(m, layout.text).alias("text")))
    else:
        own = F.filter(F.array(*[
            F.struct(F.lit(role).alias("role"), F.get_json_object(F.col("_payload"), f"$.{name}").alias("text"))
            for role, name in layout.fields]), lambda t: F.coalesce(t["text"], F.lit("")) != "")
    return _renamed(own, layout)


def from_records(records: DataFrame, conv: str = "conv_id", payload: str = "payload",
                 layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Turns (conv_id, turn, role, text) of JSON records; the layout of each is chosen by its fingerprint."""
    turns, mark = F.array().cast("array<struct<role:string,text:string>>"), F.col("_print")
    for layout, known in zip(layouts, _known(layouts), strict=True):
        turns = F.when(mark == known, _turns(layout)).otherwise(turns)
    marked = records.select(F.col(conv).alias("conv_id"), F.col(payload).alias("_payload")).withColumn(
        "_print", fingerprint(_named(paths_of(F.col("_payload")), layouts)))
    return marked.select("conv_id", F.posexplode(turns).alias("turn", "t")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.col("t.role").alias("role"), F.col("t.text").alias("text"))


def unknown_records(records: DataFrame, payload: str = "payload", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The records, whole, that ``from_records`` finds no layout for."""
    return records.where(~fingerprint(_named(paths_of(F.col(payload)), layouts)).isin(*_known(layouts)))


def unknown_layouts(records: DataFrame, payload: str = "payload", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Fingerprints without a layout: print and paths (all of them), number of records."""
    paths = F.array_sort(paths_of(F.col(payload)))
    return unknown_records(records, payload, layouts).select(
        fingerprint(paths).alias("print"), F.array_join(paths, ",").alias("paths")).groupBy("print", "paths").agg(F.count("*").alias("records"))


def _items(layout: Layout) -> Column:
    return F.transform(layout.list_path, lambda m: F.struct(m[layout.role].cast("string").alias("role"), m[layout.text].cast("string").alias("text")))


def from_rows(table: DataFrame, layouts: tuple[Layout, ...] = TABLES) -> DataFrame:
    """Turns (conv_id, turn, role, text) of a table: by the first layout whose fingerprint the schema's paths give, cut to that
    layout's own, so that further columns do not matter.

    Turns of a list are numbered from 0. The hashes are constants, so Spark drops the other layouts from the plan.
    """
    have = schema_paths(table.schema)
    fitting = [x for x in layouts if set(x.paths) <= set(have)]  # others name columns that the table lacks
    if not fitting:
        raise ValueError(f"no layout of turns: the table has {have}, layouts have {[x.paths for x in layouts]}")
    kind = table.schema["conv_id"].dataType.simpleString()
    turns = F.array().cast(f"array<struct<conv_id:{kind},turn:bigint,role:string,text:string>>")
    for layout, known in reversed(list(zip(fitting, _known(tuple(fitting)), strict=True))):
        mark = fingerprint(_named(F.array(*map(F.lit, have)), (layout,)))
        if layout.list_path:
            own = F.transform(_renamed(_items(layout), layout), lambda t, k: F.struct(
                F.col("conv_id"), k.cast("long").alias("turn"), t["role"].alias("role"), t["text"].alias("text")))
        else:
            own = F.array(F.struct("conv_id", F.col("turn").cast("long").alias("turn"), F.col(layout.role).alias("role"), F.col(layout.text).alias("text")))
        turns = F.when(mark == known, own).otherwise(turns)
    return table.select(F.inline(turns))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, r"$1$2$3")


def format_chats(turns: DataFrame, learned_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (array of start, length: code points, start from 1).

    Pieces and their lengths are made per turn before the shuffle; a conversation meets in one place only as the text it is.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(TURN_START + HEAD_START), escape(role), F.lit(HEAD_END))
    pieces = turns.select(
        "conv_id", "turn", role.alias("role"), head.alias("head"), escape(text).alias("body")).withColumn(
        "chars", F.length("head") + F.length("body") + F.lit(len(TURN_END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    placed = pieces.withColumn("k", F.row_number().over(order)).withColumn(
        "before", F.coalesce(F.sum("chars").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))
    grouped = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "k", F.concat("head", "body", F.lit(TURN_END)).alias("piece"),
        F.when(F.col("role") == learned_role, F.col("before") + F.length("head") + 1).alias("start"),
        F.length("body").cast("long").alias("length")))).alias("t"))
    learned = F.filter("t", lambda x: x["start"].isNotNull())
    return grouped.select(
        "conv_id", F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(learned, lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))).alias("loss_spans"))


def parse_chat(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    pieces = F.split(formatted, TURN_END)
    skip = len(TURN_START + HEAD_START)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, HEAD_END, 1)
        return F.struct(unescape(F.substring(head, F.lit(skip + 1), F.length(head))).alias("role"),
                        unescape(F.substring(piece, F.length(head) + len(HEAD_END) + 1, F.length(piece))).alias("text"))

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def loss_texts(formatted: Column, spans: Column) -> Column:
    """Array of the unescaped texts under the mask."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"].cast("int"), s["length"].cast("int"))))
