"""JSON documents: paths, shredding, tree flattening, message feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sixfold.operators.ordered import HOT_ROWS, with_ordered

LABEL_CHARS = 25
ARRAY_ITEMS = 5


def json_fields(df: DataFrame, fields: Mapping[str, tuple[str, str]], payload: str = "payload", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns ``{name: (path, type)}`` from a JSON text; each text is parsed once. A bad text or value gives NULL."""
    parsed = df.select(*keep, F.try_parse_json(payload).alias("_doc"))
    return parsed.select(*keep, *[F.try_variant_get("_doc", path, kind).alias(name) for name, (path, kind) in fields.items()])


def message_extract(documents: DataFrame, k: int | None = 15) -> DataFrame:
    """Category, flag, the first 50 characters and the lap of each message."""
    messages = documents.where(F.col("doc_type") == "race_control_message")
    if k is not None:
        messages = messages.orderBy("doc_id").limit(k)
    fields = {
        "category": ("$.Category", "string"),
        "flag": ("$.Flag", "string"),
        "message_text": ("$.Message", "string"),
        "lap": ("$.Lap", "double"),
    }
    return json_fields(messages, fields).withColumn("message_text", F.substring("message_text", 1, 50))


def session_extract(documents: DataFrame) -> DataFrame:
    """Session id, grand prix, session name and the nested location of each session document."""
    fields = {
        "session_id": ("$.session_id", "string"),
        "gp_name": ("$.gp", "string"),
        "session_name": ("$.session_name", "string"),
        "location": ("$.data.Meeting.Location", "string"),
    }
    return json_fields(documents.where(F.col("doc_type") == "session_info"), fields)


def shred(df: DataFrame, path: str, fields: str, payload: str = "payload", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per object in the array at ``path``, with the typed ``fields`` (DDL) and the position from 1."""
    items = F.try_variant_get(F.try_parse_json(payload), path, f"array<struct<{fields}>>")
    placed = df.select(*keep, F.posexplode(items).alias("_at", "_item"))
    return placed.select(*keep, (F.col("_at") + 1).alias("item"), "_item.*")


def flag_summary(messages: DataFrame) -> DataFrame:
    """Messages per flag."""
    return messages.groupBy("flag").agg(F.count(F.lit(1)).alias("messages"))


#: Characters that stand for an escaped backslash and an escaped quote while a text is cut into tokens.
_BACKSLASH, _QUOTE = "\ue000", "\ue001"
#: A string (with its colon if it is a key), a bracket, or another scalar; commas and spaces are dropped.
_TOKEN = r'"[^"]*+"\s*+:?|[\[\]{}]|[^\s\[\]{}:,"]++'
#: Tokens whose nodes are gathered before they are added to all others, so that adding does not copy all nodes for each token.
_RUN = 512
_OPEN = "array<struct<id:string,items:boolean,n:int,hidden:boolean>>"
_FOUND = "array<struct<id:string,parent:string,name:string,item:boolean,raw:string>>"


def tokens(payload: Column | str) -> Column:
    """The tokens of a JSON text, without backslashes and quotes inside strings; ``_written`` puts them back."""
    column = F.col(payload) if isinstance(payload, str) else payload
    # Where a text holds the stand-ins themselves, it is given them as JSON escapes.
    for mark, escape in ((_BACKSLASH, "\\ue000"), (_QUOTE, "\\ue001"), ("\\\\", _BACKSLASH), ('\\"', _QUOTE)):
        column = F.replace(column, F.lit(mark), F.lit(escape))
    return F.regexp_extract_all(column, F.lit(_TOKEN), F.lit(0))


def _written(token: Column) -> Column:
    return F.replace(F.replace(token, F.lit(_BACKSLASH), F.lit("\\\\")), F.lit(_QUOTE), F.lit('\\"'))


def _key(token: Column) -> Column:
    """The name in a key token."""
    escaped = token.rlike(f"[\\\\{_BACKSLASH}{_QUOTE}]")
    quoted = F.rtrim(F.substring(_written(token), F.lit(1), F.char_length(_written(token)) - 1))
    return F.when(escaped, F.try_variant_get(F.try_parse_json(quoted), "$", "string")).otherwise(F.get(F.split(token, '"'), F.lit(1)))


def _step(state: Column, token: Column) -> Column:
    """The state (open containers, pending key, nodes) after one more token."""
    stack, first = state["stack"], F.substring(token, 1, 1)
    top = F.get(stack, F.size(stack) - 1)
    outer = F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0)))
    below = F.size(stack) > 0
    opens, closes = first.isin("{", "["), first.isin("}", "]")
    is_key = (first == '"') & token.endswith(":")
    place = F.concat(F.lit("["), top["n"].cast("string"), F.lit("]"))
    joined = F.when(top["id"] == "", state["key"]).otherwise(F.concat(top["id"], F.lit("/"), state["key"]))
    name = F.when(~below, F.lit("")).when(top["items"], F.concat(top["id"], place)).otherwise(joined)
    hidden = F.when(below, top["hidden"] | (top["items"] & (top["n"] >= ARRAY_ITEMS))).otherwise(False)
    node = F.struct(
        name.alias("id"), top["id"].alias("parent"), F.when(top["items"], place).otherwise(state["key"]).alias("name"),
        top["items"].alias("item"), F.when(~opens, token).alias("raw"),
    )
    counted = F.when(below, F.concat(outer, F.array(F.struct(top["id"].alias("id"), top["items"].alias("items"), (top["n"] + 1).alias("n"), top["hidden"].alias("hidden"))))).otherwise(stack)
    opened = F.concat(counted, F.array(F.struct(name.alias("id"), (first == "[").alias("items"), F.lit(0).alias("n"), hidden.alias("hidden"))))
    return F.struct(
        F.when(is_key, stack).when(closes, outer).when(opens, opened).otherwise(counted).alias("stack"),
        F.when(is_key, _key(token)).otherwise(state["key"]).alias("key"),
        F.when(is_key | closes | hidden | ~below, state["nodes"]).otherwise(F.concat(state["nodes"], F.array(node))).alias("nodes"),
    )


def _state(stack: Column, key: Column, nodes: Column) -> Column:
    return F.struct(stack.alias("stack"), key.alias("key"), nodes.alias("nodes"))


def _below_root(payload: str) -> Column:
    """All nodes below the root of a JSON text, from its tokens: one pass with a stack of the containers that are open."""
    found = tokens(payload)

    def run(state: Column, at: Column) -> Column:
        some = F.slice(found, at * _RUN + 1, F.lit(_RUN))
        after = F.aggregate(some, _state(state["stack"], state["key"], F.array().cast(_FOUND)), _step)
        # As the item of an array the result is worked out once, however often it is looked into.
        return F.element_at(F.transform(F.array(after), lambda x: _state(x["stack"], x["key"], F.concat(state["nodes"], x["nodes"]))), 1)

    def shown(made: Column) -> Column:
        value = F.substring(scalar_text(F.try_parse_json(_written(made["raw"]))), 1, LABEL_CHARS)
        label = F.when(made["item"] | made["raw"].isNull(), made["name"]).otherwise(F.concat(made["name"], F.lit(": "), value))
        return _node(made["id"], made["parent"], label, 1, F.lit(None).cast("variant"))

    runs = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _RUN).cast("int"))
    every = F.aggregate(runs, _state(F.array().cast(_OPEN), F.lit(None).cast("string"), F.array().cast(_FOUND)), run, lambda state: state["nodes"])
    return F.transform(every, shown)


#: Texts of at most so many levels are unfolded as variants, level after level; deeper ones in a pass over their tokens.
LEVELS = 4


def deeper_than(payload: str, levels: int) -> Column:
    """Whether objects and arrays of a JSON text are nested in more levels: innermost pairs of brackets are taken out level by level."""
    bare = F.regexp_replace(F.regexp_replace(payload, r"(?s)\\.", ""), '"[^"]*+"', "")
    left = F.regexp_replace(bare, r"[^\[\]{}]++", "")
    for _ in range(levels):
        left = F.regexp_replace(left, r"\[\]|\{\}", "")
    return left != ""


def flatten_tree(df: DataFrame, payload: str = "payload", keep: Sequence[str] = ("doc_id",), root: str = "session_info", levels: int = LEVELS) -> DataFrame:
    """Each JSON document as a tree: ``id``, ``parent``, ``label``, ``value`` per node, plus a root with value 0.

    Object members are ``parent/key``, array items ``parent[i]`` (the first five only). The label of a scalar member ends in its
    first 25 characters; numbers are shown as the variant type writes them (``1.0`` as ``1``). The plan is the same for any depth: texts of
    up to ``levels`` levels are unfolded one level after the other, deeper ones in one pass over their tokens. A text that
    Spark's parser does not take (no JSON, a key repeated within one object, over 1000 levels) gives no rows.
    """
    keep = list(keep)
    document, none = F.col("_document"), F.lit(None).cast("variant")
    parsed = df.select(*keep, payload, F.try_parse_json(payload).alias("_document")).where(document.isNotNull())
    top = lambda node: F.array(_node(F.lit(""), F.lit(""), F.lit(root), 0, node))
    whole = F.when(deeper_than(payload, levels), F.concat(top(none), _below_root(payload))).otherwise(top(document))
    nodes = parsed.select(*keep, F.explode(whole).alias("_node"))
    for _ in range(levels):
        node = F.col("_node")
        closed = _node(node["id"], node["parent"], node["label"], node["value"], none)
        opened = F.when(node["open"].isNull(), F.array(node)).otherwise(F.concat(F.array(closed), _children(node)))
        nodes = nodes.select(*keep, F.explode(opened).alias("_node"))
    return nodes.select(*keep, "_node.id", "_node.parent", "_node.label", "_node.value")


_NODES = "array<struct<id:string,parent:string,label:string,value:int,open:variant>>"


def _node(name: Column, parent: Column, label: Column, value: int | Column, node: Column) -> Column:
    value = F.lit(value) if isinstance(value, int) else value
    return F.struct(name.alias("id"), parent.alias("parent"), label.alias("label"), value.alias("value"), node.alias("open"))


def _members(node: Column) -> Column:
    return F.map_entries(F.try_variant_get(node, "$", "map<string,variant>"))


def _items(node: Column) -> Column:
    return F.try_variant_get(node, "$", "array<variant>")


def _nested(node: Column) -> Column:
    """Whether the node is an object or an array: those are written with a bracket, and a text that begins with one is no such kind."""
    return F.substring(F.to_json(node), 1, 1).isin("{", "[")


def _children(row: Column) -> Column:
    """The nodes right below one node; none below a scalar. Only objects and arrays stay open."""
    parent, node = row["id"], row["open"]

    def member(entry: Column) -> Column:
        key, value = entry["key"], entry["value"]
        name = F.when(parent == "", key).otherwise(F.concat(parent, F.lit("/"), key))
        shown = F.concat(key, F.lit(": "), F.substring(scalar_text(value), 1, LABEL_CHARS))
        return _node(name, parent, F.when(_nested(value), key).otherwise(shown), 1, F.when(_nested(value), value))

    def item(value: Column, at: Column) -> Column:
        place = F.concat(F.lit("["), at.cast("string"), F.lit("]"))
        return _node(F.concat(parent, place), parent, place, 1, F.when(_nested(value), value))

    members = F.transform(_members(node), member)
    items = F.transform(F.slice(_items(node), 1, ARRAY_ITEMS), item)
    return F.coalesce(members, items, F.array().cast(_NODES))


def scalar_text(node: Column) -> Column:
    """A scalar as shown in labels: ``None``, ``True`` and ``False`` as words, texts without quotes."""
    written = F.try_variant_get(node, "$", "string")
    is_flag = written.isin("true", "false") & (F.schema_of_variant(node) == "BOOLEAN")
    return F.when(F.is_variant_null(node), F.lit("None")).when(is_flag, F.initcap(written)).otherwise(written)


def message_feed(documents: DataFrame) -> DataFrame:
    """Messages with text: seconds since the earliest message, shortened text, and defaults for what is missing."""
    fields = {
        "category": ("$.Category", "string"),
        "flag": ("$.Flag", "string"),
        "message": ("$.Message", "string"),
        "time_text": ("$.Time", "string"),
        "lap": ("$.Lap", "double"),
    }
    rows = json_fields(documents.where(F.col("doc_type") == "race_control_message"), fields)
    strict = F.when(F.col("time_text").rlike(r"^\d{1,4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"), F.col("time_text"))
    rows = rows.withColumn("_at", strict.try_cast("timestamp_ntz"))
    start = rows.agg(F.min("_at").alias("_start")).scalar()
    seconds = (F.col("_at") - start).cast("decimal(20,6)").cast("double")
    short = F.when(F.length("message") > 50, F.concat(F.substring("message", 1, 50), F.lit("..."))).otherwise(F.col("message"))
    return rows.where(F.length("message") > 0).select(
        "doc_id",
        F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit("Unknown")).alias("category"),
        F.coalesce("flag", F.lit("")).alias("flag"),
        "message",
        short.alias("text_short"),
        F.coalesce(seconds, F.lit(0.0)).alias("time_sec"),
        F.coalesce("lap", F.lit(0.0)).alias("lap"),
    )


def timeline(feed: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The feed with its minute and the ordinal of its category (categories numbered from 0 by first appearance)."""
    seen = feed.groupBy("category").agg(F.min("doc_id").alias("_first"))
    numbered = with_ordered(seen, [], ["_first"], row_number="_place", hot_rows=hot_rows)
    ordinals = numbered.select("category", (F.col("_place") - 1).alias("y_pos"))
    return feed.withColumn("race_minute", F.col("time_sec") / 60).join(ordinals, "category")
