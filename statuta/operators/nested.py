"""Deeply nested statute documents turned into related flat tables.

Every JSON value below the law is classified bottom-up by a tree automaton:
leaves get a leaf state, lists the set of their members' states, objects the
state that their kind and the states of their slots lead to.  The state of a
record is its *variant*.  All records share one supertype table (document,
path, parent path, kind, position, variant and the common attributes); each
kind has a typed table, and each variant is routed to a subtype table of its kind
(bare text, leaf, branch, form); all keep the path as key and the parent path as
link, which leads to the root table for the records straight below the law.

Defined results: payloads that are null, empty, cut off or hold no law give no
rows.  Nulls, blank strings, empty objects and empty lists are no records and
take no position.  Bare text (or a bare number) in a record's place is a
record of variant ``text``.  Wrappers are no level of their own.  A payload
received twice gives its rows twice, under each ``raw_id``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statuta.session import spread

ROOT = "법령"

# The slots of the document format that hold records, by the
# kind of the record that owns them, with the kind of the records inside.
SLOTS: dict[str, dict[str, str]] = {
    ROOT: {"조문": "조", "부칙": "부칙", "별표": "별표", "별표목록": "별표"},
    "조": {"항": "항", "별표": "별표"},
    "항": {"호": "호", "목": "목"},
    "호": {"목": "목"},
    "목": {},
    "부칙": {"별표": "별표"},
    "별표": {"별표서식PDF파일링크": "링크"},
    "링크": {},
}
# The keys whose value stands for the object around it.
WRAPPERS: dict[str, tuple[str, ...]] = {
    "조": ("조문단위", "조문"),
    "부칙": ("부칙단위", "부칙"),
    "별표": ("별표단위", "별표목록", "별표"),
}
# Where each kind keeps its number, title and content.
NUMBER = {"조": ("조문번호",), "항": ("항번호",), "호": ("호번호",), "목": ("목번호",), "별표": ("별표번호",), "부칙": ("부칙공포일자",)}
TITLE = {"조": ("조문제목",), "부칙": ("부칙제목",), "별표": ("별표명", "별표제목", "서식명")}
CONTENT = {
    "조": ("조문내용",),
    "항": ("항내용",),
    "호": ("호내용",),
    "목": ("목내용",),
    "부칙": ("부칙내용",),
    "별표": ("별표내용",),
    "링크": ("링크",),
}
# Keys of which a document without the outer wrapper has one.
LAW_KEYS = ("조문", "부칙", "별표", "별표목록", "기본정보", "법령명_한글")

KINDS = ("조", "항", "호", "목", "부칙", "별표", "링크")

NODE = T.StructType(
    [
        T.StructField("node_path", T.StringType(), False),
        T.StructField("parent_path", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("position", T.IntegerType(), False),
        T.StructField("depth", T.IntegerType(), False),
        T.StructField("variant", T.StringType(), False),
        T.StructField("number", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("attributes", T.StringType()),
    ]
)


def law_of(payload: str | None) -> dict | None:
    """The law object of a payload, or None if there is none."""
    try:
        value = json.loads(payload) if payload else None
        if isinstance(value, dict) and ROOT in value:
            value = value[ROOT]
        elif not (isinstance(value, dict) and any(key in value for key in LAW_KEYS)):
            return None
        while not isinstance(value, dict) or (ROOT in value and not any(key in value for key in LAW_KEYS)):
            if isinstance(value, dict):
                value = value[ROOT]
            elif isinstance(value, list):
                value = value[0] if value else None
            elif isinstance(value, str):
                value = json.loads(value)
            else:
                return None
    except (ValueError, RecursionError):
        return None
    return value or None


def leaf_state(value: object) -> str | None:
    """State of a leaf, None for what is no value at all."""
    if value is None:
        return None
    if isinstance(value, str):
        return "text" if value.strip() else None
    if isinstance(value, bool):
        return "flag"
    return "number"


def state_of(value: object) -> str | None:
    """State of any JSON value below a record that is no record itself.

    Lists lead to the sorted set of their members' states, objects to the
    sorted set of key and state of their slots; both are computed bottom-up.
    """
    done: dict[int, str | None] = {}
    stack: list[tuple[object, bool]] = [(value, False)]
    while stack:
        node, ready = stack.pop()
        if not isinstance(node, (dict, list)):
            continue
        inner = list(node.values()) if isinstance(node, dict) else node
        if not ready:
            stack.append((node, True))
            stack += [(x, False) for x in inner]
            continue
        states = [done[id(x)] if isinstance(x, (dict, list)) else leaf_state(x) for x in inner]
        if isinstance(node, list):
            known = sorted({s for s in states if s})
            done[id(node)] = f"[{'|'.join(known)}]" if known else None
        else:
            known = sorted(f"{k}:{s}" for k, s in zip(node, states) if s)
            done[id(node)] = "{" + ",".join(known) + "}" if known else None
    return done[id(value)] if isinstance(value, (dict, list)) else leaf_state(value)


def members(value: object, kind: str) -> Iterator[object]:
    """Records of ``kind`` in a slot, in source order, wrappers undone."""
    stack = [value]
    while stack:
        item = stack.pop()
        if isinstance(item, list):
            stack += reversed(item)
        elif isinstance(item, dict):
            wrapper = next((k for k in WRAPPERS.get(kind, ()) if _wraps(item, k, kind)), None)
            if wrapper is not None:
                stack.append(item[wrapper])
            elif item:
                yield item
        elif leaf_state(item):
            yield item


def _wraps(item: dict, key: str, kind: str) -> bool:
    """Whether ``item`` is only a wrapper: it has the key and nothing of a record."""
    if key not in item:
        return False
    own = NUMBER.get(kind, ()) + TITLE.get(kind, ()) + CONTENT.get(kind, ()) + tuple(SLOTS[kind])
    return not any(k in item for k in own)


def plain_text(value: object) -> str | None:
    """The leaves of a value in source order, joined by line breaks."""
    parts: list[str] = []
    stack = [value]
    while stack:
        item = stack.pop()
        if isinstance(item, list):
            stack += reversed(item)
        elif isinstance(item, dict):
            stack += reversed(list(item.values()))
        elif leaf_state(item):
            parts.append(item if isinstance(item, str) else json.dumps(item))
    return "\n".join(parts) or None


def _first(item: dict, keys: tuple[str, ...]) -> str | None:
    return next((t for k in keys if (t := plain_text(item.get(k)))), None)


def nodes_of(payload: str | None) -> list[tuple]:
    """Supertype rows (see ``NODE``) of all records below the law of one payload."""
    law = law_of(payload)
    if law is None:
        return []
    rows: list[tuple] = []
    stack: list[tuple[object, str, str, int]] = [(law, ROOT, ROOT, 0)]
    while stack:
        item, kind, path, depth = stack.pop()
        if not isinstance(item, dict):
            continue
        below, seen = [], {}
        for slot, value in item.items():
            child = SLOTS[kind].get(slot)
            if child is None:
                continue
            for record in members(value, child):
                seen[child] = seen.get(child, 0) + 1
                at = f"{path}/{child}:{seen[child]}"
                rows.append((at, path, child, seen[child], depth + 1, *_describe(record, child)))
                below.append((record, child, at, depth + 1))
        stack += reversed(below)
    return rows


def _describe(record: object, kind: str) -> tuple:
    """Variant, number, title, content and remaining attributes of a record."""
    if not isinstance(record, dict):
        return leaf_state(record), None, None, plain_text(record), None
    slots, known = SLOTS[kind], NUMBER.get(kind, ()) + TITLE.get(kind, ()) + CONTENT.get(kind, ())
    states = []
    for key, value in record.items():
        if key in slots:
            if next(members(value, slots[key]), None) is not None:
                states.append(f"{key}:<{slots[key]}>")
        elif (state := state_of(value)) is not None:
            states.append(f"{key}:{state}")
    rest = {k: v for k, v in record.items() if k not in slots and k not in known and v is not None}
    return (
        "{" + ",".join(sorted(states)) + "}",
        _first(record, NUMBER.get(kind, ())),
        _first(record, TITLE.get(kind, ())),
        _first(record, CONTENT.get(kind, ())),
        json.dumps(rest, ensure_ascii=False) if rest else None,
    )


def flatten_documents(raw: DataFrame, id_col: str = "raw_id", payload_col: str = "payload") -> DataFrame:
    """The supertype table: ``id_col`` and the columns of ``NODE``.

    One narrow pass over the payloads; no shuffle unless the input has fewer
    splits than the session has cores.
    """
    key = raw.schema[id_col]
    schema = T.StructType([T.StructField(id_col, key.dataType), *NODE.fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, rows = [], []
            for k, payload in enumerate(batch.column(1).to_pylist()):
                found = nodes_of(payload)
                take += [k] * len(found)
                rows += found
                if len(rows) >= 20_000:
                    yield _batch(batch, take, rows, names)
                    take, rows = [], []
            yield _batch(batch, take, rows, names)

    return spread(raw.select(id_col, payload_col), id_col).mapInArrow(run, schema)


def _batch(source: pa.RecordBatch, take: list[int], rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int32() if isinstance(f.dataType, T.IntegerType) else pa.string() for f in NODE.fields]
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    ids = source.column(0).take(pa.array(take, pa.int64()))
    return pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns, kinds))], names=names)


# The keys of a law's own facts, in the law or in its 기본정보.
LAW_FACTS = ("법령명_한글", "시행일자", "공포일자", "제개정구분")
_LAW = "node_path string, variant string, law_name string, effective string, promulgated string, revision string, attributes string"


def law_row(payload: str | None) -> tuple | None:
    """The root record of a payload: variant, its facts, and all further attributes as JSON."""
    law = law_of(payload)
    if law is None:
        return None
    basic = law.get("기본정보") if isinstance(law.get("기본정보"), dict) else {}
    facts = [_first(law, (k,)) or _first(basic, (k,)) for k in LAW_FACTS]
    slots = SLOTS[ROOT]
    states = [f"{k}:<{slots[k]}>" if k in slots else f"{k}:{state}" for k, v in law.items() if (state := state_of(v)) is not None]
    rest = {k: v for k, v in {**basic, **law}.items() if k not in slots and k not in LAW_FACTS and k != "기본정보" and v is not None}
    return (ROOT, "{" + ",".join(sorted(states)) + "}", *facts, json.dumps(rest, ensure_ascii=False) if rest else None)


def law_table(raw: DataFrame, id_col: str = "raw_id", payload_col: str = "payload") -> DataFrame:
    """The root records, to which the parent paths of articles, addenda and annexes lead."""
    fields = T._parse_datatype_string(_LAW).fields
    schema = T.StructType([raw.schema[id_col], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, *row) for k, payload in enumerate(batch.column(1).to_pylist()) if (row := law_row(payload)) is not None]
            columns = list(zip(*rows)) if rows else [()] * (len(fields) + 1)
            ids = batch.column(0).take(pa.array(columns[0], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.string()) for c in columns[1:])], names=schema.fieldNames())

    rows = spread(raw.select(id_col, payload_col), id_col).mapInArrow(run, schema)
    return rows.withColumns({c: F.try_to_date(c, "yyyyMMdd") for c in ("effective", "promulgated")})


#: The subtypes that the automaton's states lead to, by kind.
SUBTYPES = {
    "조": ("article", "article_branch", "article_text"),
    "항": ("paragraph", "paragraph_branch", "paragraph_text"),
    "호": ("item", "item_branch", "item_text"),
    "목": ("subitem", "subitem_text"),
    "부칙": ("addendum", "addendum_branch", "addendum_text"),
    "별표": ("annex", "annex_branch", "form", "form_branch", "annex_text"),
    "링크": ("link", "link_text"),
}


def subtype(kind: Column | str = "kind", variant: Column | str = "variant") -> Column:
    """The subtype that a record's variant (its state) is routed to.

    Bare text is a subtype of its own; objects part by whether they own records
    (``_branch``) and, for annexes, whether they are named as forms.
    """
    state = F.col(variant) if isinstance(variant, str) else variant
    kind = F.col(kind) if isinstance(kind, str) else kind
    base = F.when((kind == "별표") & state.rlike(r"[{,]서식명:"), F.lit("form"))
    for name, subtypes in SUBTYPES.items():
        base = base.when(kind == name, F.lit(subtypes[0]))
    bare = ~F.startswith(state, F.lit("{"))
    tail = F.when(bare, "_text").when(state.rlike(":<"), "_branch").otherwise("")
    return F.concat(base, tail)


def _digits(column: str) -> Column:
    """The number that a numbering (``제3조의2``, ``①``, ``3.``) begins with."""
    text = F.col(column)
    circled = F.ascii(F.regexp_extract(text, "([①-⑳])", 1)) - F.lit(ord("①") - 1)
    return F.coalesce(F.regexp_extract(text, r"(\d+)", 1).try_cast("int"), F.when(text.rlike("[①-⑳]"), circled).cast("int"))


def subtype_table(nodes: DataFrame, kind: str, id_col: str = "raw_id", route: str | None = None) -> DataFrame:
    """The typed table of one kind, or of one of its subtypes (``route``).

    Keys are (``id_col``, node_path); (``id_col``, parent_path) links to the
    parent's table.  Columns that a subtype's variants never fill are left out of
    its table; what no column holds stands in ``attributes``.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}")
    if route is not None and route not in SUBTYPES[kind]:
        raise ValueError(f"unknown subtype {route!r}")
    rows = nodes.where(F.col("kind") == kind).withColumn("subtype", subtype())
    common = [id_col, "node_path", "parent_path", "position", "variant", "subtype"]
    lines = F.split("content", "\n").alias("lines")
    number = F.col("number")
    own = {
        "조": [number.alias("article_no"), _digits("number").alias("article_num"), "title", "content", lines,
               F.get_json_object("attributes", "$.조문여부").alias("article_kind")],
        "항": [number.alias("paragraph_no"), _digits("number").alias("paragraph_num"), "content", lines],
        "호": [number.alias("item_no"), _digits("number").alias("item_num"), "content", lines],
        "목": [number.alias("subitem_no"), "content", lines],
        "부칙": [F.try_to_date("number", "yyyyMMdd").alias("promulgated_on"), "title", "content", lines],
        "별표": [number.alias("annex_no"), _digits("number").alias("annex_num"), "title", "content", lines],
        "링크": [
            F.col("content").alias("url"),
            F.get_json_object("attributes", "$.형식").alias("format"),
            F.get_json_object("attributes", "$.쪽수").try_cast("int").alias("pages"),
        ],
    }[kind]
    if route is None:
        return rows.select(*common, *own, "attributes")
    rows = rows.where(F.col("subtype") == route)
    if route.endswith("_text"):
        return rows.select(*common, F.col("content").alias("url" if kind == "링크" else "content"))
    return rows.select(*common, *own, "attributes")


def variant_counts(nodes: DataFrame) -> DataFrame:
    """How many records each variant of each kind has, and its subtype."""
    return nodes.groupBy("kind", "variant").agg(F.count(F.lit(1)).alias("records")).withColumn("subtype", subtype())
