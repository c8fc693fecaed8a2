"""Schema drift between the files of a provider, and one table out of them all.

Each file is profiled (its top-level fields, their JSON types, the values they
hold) and compared with the provider's previous file.  Fields present on one
side only are matched by similarity flooding: field pairs start from the
overlap of their values, their names and their types; scores are propagated
along the edges both schemas share (file to field, field to type, field to
nested slot, field to values) until they converge; consistent one-to-one correspondences are
selected and count as renamed if the new field holds what the old one held.
All reports and the unified table follow from these correspondences.

Cost: one pass over the records for the profiles, and one for the values of
the fields that came or went.  Profiles are pre-aggregated per Arrow batch and
again map-side; no group is ever larger than the fields of two files.

Defined results: a payload that is null or no JSON object has no fields but
its file still counts; repeated lines change nothing; null values make a field
present and add no type; files are ordered by (file_date, file_id), null dates
first.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statuta.session import durable, spread

#: Least share of the smaller field's values that a renamed field must share.
HELD = 0.5
#: Weights of values, names and types in a field pair's initial score.
WEIGHTS = (0.7, 0.2, 0.1)

_ZEROS = re.compile(r"0+(?=\d+$)")


def nested_slots(value: object) -> set[str]:
    """Paths (keys, and ``[]`` for members) of all slots inside an array or object."""
    found: set[str] = set()
    stack = [(value, "")]
    while stack:
        item, path = stack.pop()
        inner = ((f"{path}.{k}", v) for k, v in item.items()) if isinstance(item, dict) else ((f"{path}[]", v) for v in item)
        for at, below in inner:
            found.add(at)
            if isinstance(below, (dict, list)):
                stack.append((below, at))
    return found


def json_type(value: object) -> str | None:
    """JSON type of a value; None for null."""
    if value is None:
        return None
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, (int, float)):
        return "number"
    return {str: "string", list: "array", dict: "object"}[type(value)]


def leaves(value: object) -> Iterator[str]:
    """Scalar leaves of a value in one spelling: trimmed, numbers without leading zeros."""
    stack = [value]
    while stack:
        item = stack.pop()
        if isinstance(item, dict):
            stack += reversed(list(item.values()))
        elif isinstance(item, list):
            stack += reversed(item)
        elif item is not None:
            text = (item if isinstance(item, str) else json.dumps(item)).strip()
            if text:
                yield _ZEROS.sub("", text)


def _record(payload: str | None) -> dict | None:
    try:
        value = json.loads(payload) if payload else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


_CELLS = T.StructType(
    [
        T.StructField("provider_id", T.LongType()),
        T.StructField("file_id", T.LongType()),
        T.StructField("file_date", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("types", T.ArrayType(T.StringType())),
        T.StructField("hashes", T.ArrayType(T.LongType())),
        T.StructField("inner", T.ArrayType(T.StringType())),
    ]
)


def _cells(feed: DataFrame, values: bool) -> DataFrame:
    """Fields of each file, pre-aggregated per batch; ``field`` is null in a
    row that only says that the file exists."""
    names = _CELLS.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple, tuple[set, set, set]] = {}
            for provider, file, date, payload in zip(*(batch.column(i).to_pylist() for i in range(4))):
                seen.setdefault((provider, file, date, None), (set(), set(), set()))
                for field, value in (_record(payload) or {}).items():
                    types, hashes, inner = seen.setdefault((provider, file, date, field), (set(), set(), set()))
                    if (kind := json_type(value)) is not None:
                        types.add(kind)
                    if kind in ("array", "object"):
                        inner.update(nested_slots(value))
                    if values:
                        hashes.update(xxhash.xxh64_intdigest(leaf) - (1 << 63) for leaf in leaves(value))
            keys = list(zip(*seen)) or [[], [], [], []]
            columns = [
                *(pa.array(k, t) for k, t in zip(keys, (pa.int64(), pa.int64(), pa.string(), pa.string()))),
                pa.array([sorted(t) for t, _, _ in seen.values()], pa.list_(pa.string())),
                pa.array([sorted(h) for _, h, _ in seen.values()], pa.list_(pa.int64())),
                pa.array([sorted(i) for _, _, i in seen.values()], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = feed.select(
        F.col("provider_id").cast("long"), F.col("file_id").cast("long"), F.col("file_date").cast("string"), "payload"
    )
    return spread(rows, "file_id").mapInArrow(run, _CELLS)


def profiles(feed: DataFrame) -> DataFrame:
    """provider_id, file_id, file_date, field, types, inner (both sorted): the fields of each file.

    The row with a null field stands for the file itself.
    """
    merged = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)
    return _cells(feed, values=False).groupBy("provider_id", "file_id", "field").agg(
        F.min("file_date").alias("file_date"), merged("types"), merged("inner")
    )


def predecessors(profile: DataFrame) -> DataFrame:
    """file_id, prev_id: each file but a provider's first, with the file before it."""
    order = Window.partitionBy("provider_id").orderBy(F.col("file_date").asc_nulls_first(), "file_id")
    files = profile.where(F.col("field").isNull()).select("provider_id", "file_id", "file_date")
    return files.select("file_id", F.lag("file_id").over(order).alias("prev_id")).where("prev_id is not null")


def compared(profile: DataFrame) -> DataFrame:
    """file_id, prev_id, field, old_types, new_types, old_inner, new_inner: each field
    of a file or of the one before it; those of a side are null where it is absent."""
    pairs, fields = predecessors(profile), profile.where("field is not null")
    shape = F.struct("types", "inner").alias("t")
    new = pairs.join(fields.select("file_id", "field", shape), "file_id")
    old = pairs.join(fields.select(F.col("file_id").alias("prev_id"), "field", shape), "prev_id")
    none = F.lit(None).cast("struct<types:array<string>,inner:array<string>>")
    sides = new.select("file_id", "prev_id", "field", none.alias("o"), F.col("t").alias("n")).unionByName(
        old.select("file_id", "prev_id", "field", F.col("t").alias("o"), none.alias("n"))
    )
    both = sides.groupBy("file_id", "prev_id", "field").agg(F.max("o").alias("o"), F.max("n").alias("n"))
    return both.select(
        "file_id", "prev_id", "field", F.col("o.types").alias("old_types"), F.col("n.types").alias("new_types"),
        F.col("o.inner").alias("old_inner"), F.col("n.inner").alias("new_inner"),
    )


def field_overlaps(feed: DataFrame, fields: DataFrame) -> DataFrame:
    """file_id, old_field, new_field, n_old, n_new, n_both and the types of both.

    One row for each removed field and each added field of the same file, with
    the numbers of distinct values; only values of such fields are shuffled.
    """
    gone = fields.where("new_types is null")
    came = fields.where("old_types is null")
    ends = gone.select("file_id", F.col("field").alias("old_field"), F.col("old_types").alias("types_a"), F.col("old_inner").alias("inner_a")).join(
        came.select("file_id", F.col("field").alias("new_field"), F.col("new_types").alias("types_b"), F.col("new_inner").alias("inner_b")), "file_id"
    )
    open_files = ends.select("file_id").distinct()
    wanted = (
        gone.select(F.col("prev_id").alias("at"), "field", "file_id", F.lit(0).alias("side"))
        .unionByName(came.select(F.col("file_id").alias("at"), "field", "file_id", F.lit(1).alias("side")))
        .join(open_files, "file_id", "left_semi")
        .withColumnRenamed("file_id", "pair")
    )
    held = (
        _cells(feed, values=True)
        .where("field is not null")
        .select(F.col("file_id").alias("at"), "field", "hashes")
        .join(wanted, ["at", "field"])
        .select("pair", "side", "field", F.explode("hashes").alias("hash"))
        .distinct()
    )
    by_value = held.groupBy("pair", "hash").agg(
        F.collect_set(F.when(F.col("side") == 0, F.col("field"))).alias("olds"),
        F.collect_set(F.when(F.col("side") == 1, F.col("field"))).alias("news"),
    )
    both = (
        by_value.where((F.size("olds") > 0) & (F.size("news") > 0))
        .select("pair", F.explode("olds").alias("old_field"), "news")
        .select(F.col("pair").alias("file_id"), "old_field", F.explode("news").alias("new_field"))
        .groupBy("file_id", "old_field", "new_field")
        .agg(F.count(F.lit(1)).alias("n_both"))
    )
    sizes = held.groupBy("pair", "side", "field").agg(F.count(F.lit(1)).alias("n"))
    old = sizes.where("side = 0").select(F.col("pair").alias("file_id"), F.col("field").alias("old_field"), F.col("n").alias("n_old"))
    new = sizes.where("side = 1").select(F.col("pair").alias("file_id"), F.col("field").alias("new_field"), F.col("n").alias("n_new"))
    return (
        ends.join(both, ["file_id", "old_field", "new_field"], "left")
        .join(old, ["file_id", "old_field"], "left")
        .join(new, ["file_id", "new_field"], "left")
        .na.fill(0, ["n_both", "n_old", "n_new"])
    )


def name_similarity(a: str, b: str) -> float:
    """Dice coefficient of the names' character pairs, case and signs aside."""
    grams = []
    for name in (a, b):
        plain = re.sub(r"[\W_]+", "", name).lower()
        grams.append({plain[i : i + 2] for i in range(len(plain) - 1)} or {plain})
    return 2 * len(grams[0] & grams[1]) / (len(grams[0]) + len(grams[1]))


def flood(pairs: list[dict], rounds: int = 50, settled: float = 1e-4) -> np.ndarray:
    """Converged similarity-flooding scores of the field pairs of two schemas.

    ``pairs``: old_field, new_field, types_a, types_b, inner_a, inner_b, n_old,
    n_new, n_both.  Nodes of the pairwise connectivity graph are the pair of files,
    the field pairs, the pairs of types, of nested slots, and of value sets; an edge
    label's weight is shared equally among the edges that leave a node under it.
    Edges are kept as lists, so memory follows their number.
    """
    n = len(pairs)
    held = np.array([_held(p) for p in pairs])
    names = np.array([name_similarity(p["old_field"], p["new_field"]) for p in pairs])
    types = np.array([float(bool(set(p["types_a"]) & set(p["types_b"]))) for p in pairs])
    wv, wn, wt = WEIGHTS
    start = [*(wv * held + wn * names + wt * types), 1.0, *held]
    files, values = n, n + 1
    into, out, weight = [], [], []

    def edges(a: int, b: int, back: float, forth: float) -> None:
        """``a`` hears from ``b`` with weight ``back``, ``b`` from ``a`` with ``forth``."""
        into.extend((a, b))
        out.extend((b, a))
        weight.extend((back, forth))

    for k in range(n):
        edges(k, files, 1.0 / n, 1.0)
        edges(k, values + k, 1.0, 1.0)
    for side in ("types", "inner"):
        linked = [[(s, t) for s in p.get(side + "_a") or () for t in p.get(side + "_b") or ()] for p in pairs]
        users = Counter(x for row in linked for x in row)
        at = {x: len(start) + k for k, x in enumerate(sorted(users))}
        start += [float(s == t) for s, t in sorted(users)]
        for k, row in enumerate(linked):
            for x in row:
                edges(k, at[x], 1.0 / users[x], 1.0 / len(row))
    start = np.array(start)
    into, out, weight = np.array(into), np.array(out), np.array(weight)
    score = start / start.max()
    for _ in range(rounds):
        heard = start + score
        grown = heard + np.bincount(into, weight * heard[out], len(start))
        grown /= grown.max()
        change = np.abs(grown - score).max()
        score = grown
        if change < settled:
            break
    return score[:n]


def _held(pair: dict) -> float:
    """Share of the smaller field's values that both fields hold."""
    return pair["n_both"] / max(1, min(pair["n_old"], pair["n_new"]))


def _consistent(pairs: list[dict]) -> list[tuple[str, str, float]]:
    """(old field, new field, score) of the one-to-one renames of a file."""
    pairs = sorted(pairs, key=lambda p: (p["old_field"], p["new_field"]))
    ranked = sorted(zip(flood(pairs), pairs), key=lambda x: (-x[0], -x[1]["n_both"]))
    taken: tuple[set, set] = (set(), set())
    out = []
    for score, pair in ranked:
        a, b = pair["old_field"], pair["new_field"]
        if _held(pair) >= HELD and a not in taken[0] and b not in taken[1]:
            taken[0].add(a)
            taken[1].add(b)
            out.append((a, b, float(score)))
    return out


def correspondences(overlaps: DataFrame) -> DataFrame:
    """file_id, old_field, new_field, score: the consistent renames of each file.

    A file's pairs travel as one row; their number follows its fields.
    """
    columns = ["old_field", "new_field", "types_a", "types_b", "inner_a", "inner_b", "n_old", "n_new", "n_both"]
    by_file = overlaps.groupBy("file_id").agg(F.collect_list(F.struct(*columns)).alias("pairs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (file, *found)
                for file, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for found in _consistent(pairs)
            ]
            kinds = (pa.int64(), pa.string(), pa.string(), pa.float64())
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], names=["file_id", "old_field", "new_field", "score"]
            )

    return by_file.mapInArrow(run, "file_id long, old_field string, new_field string, score double")


def _report(fields: DataFrame, renames: DataFrame) -> DataFrame:
    """file_id, field, old_field, change, old_types, new_types of every change."""
    old = renames.select("file_id", F.col("old_field").alias("field"), F.lit(True).alias("was_old"))
    new = renames.select("file_id", F.col("new_field").alias("field"), "old_field")
    marked = fields.join(old, ["file_id", "field"], "left").join(new, ["file_id", "field"], "left")
    before = fields.where("new_types is null").select(
        "file_id", F.col("field").alias("old_field"), F.col("old_types").alias("before_types")
    )
    marked = marked.join(before, ["file_id", "old_field"], "left").withColumn(
        "before", F.coalesce("old_types", "before_types")
    )
    renamed = F.col("old_field").isNotNull()
    retyped = (F.size("before") > 0) & (F.size("new_types") > 0) & (F.col("before") != F.col("new_types"))
    changes = F.filter(
        F.array(
            F.when(renamed, F.lit("renamed")),
            F.when(F.col("old_types").isNull() & ~renamed, F.lit("added")),
            F.when(F.col("new_types").isNull() & F.col("was_old").isNull(), F.lit("removed")),
            F.when(F.coalesce(retyped, F.lit(False)), F.lit("retyped")),
        ),
        lambda x: x.isNotNull(),
    )
    return marked.select(
        "file_id", "field", "old_field", F.explode(changes).alias("change"), F.col("before").alias("old_types"), "new_types"
    )


def matched(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fields of neighbouring files, renames).

    Both hold a row for each field of a file and are read several times, so
    each is written once; the records themselves never are.
    """
    profile = durable(profiles(feed))
    fields = durable(compared(profile))
    owners = profile.where("field is null").select("file_id", "provider_id")
    return fields, durable(correspondences(field_overlaps(feed, fields)).join(owners, "file_id"))


def drift_report(feed: DataFrame) -> DataFrame:
    """Every change between a file and its provider's file before it."""
    return _report(*matched(feed))


# The fields of the unified annex table.
UNIFIED = (
    "별표명",
    "서식명",
    "별표번호",
    "별표종류",
    "관련법령일련번호",
    "관련법령명",
    "별표서식파일링크",
    "별표서식PDF파일링크",
    "별표법령상세링크",
)


def canonical_names(renames: DataFrame) -> DataFrame:
    """provider_id, field, canonical: one name for each set of a provider's names
    joined by its renames; rows without a provider hold for all others, where all
    providers that rename a name agree on what it means.

    Works on counts of (old name, new name) of one provider, so a group's size
    follows its field names.  Edges are added by support; an edge that would join
    two different fields of the unified table is refused.
    """
    edges = renames.groupBy("provider_id", "old_field", "new_field").agg(F.count(F.lit(1)).alias("n"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        root: dict[str, str] = {name: name for name in UNIFIED}

        def find(name: str) -> str:
            root.setdefault(name, name)
            while root[name] != name:
                root[name] = root[root[name]]
                name = root[name]
            return name

        for row in pdf.sort_values(["n", "old_field", "new_field"], ascending=[False, True, True]).itertuples():
            a, b = find(row.old_field), find(row.new_field)
            if a == b or (a in UNIFIED and b in UNIFIED):
                continue
            if b in UNIFIED or (a not in UNIFIED and b < a):
                a, b = b, a
            root[b] = a
        provider = pdf["provider_id"].iloc[0]
        return pd.DataFrame([(provider, name, find(name)) for name in sorted(root)], columns=["provider_id", "field", "canonical"])

    own = durable(edges.groupBy("provider_id").applyInPandas(run, "provider_id long, field string, canonical string"))
    agreed = own.groupBy("field").agg(F.min("canonical").alias("canonical"), F.max("canonical").alias("other")).where("canonical = other")
    return own.unionByName(agreed.select(F.lit(None).cast("long").alias("provider_id"), "field", "canonical"))


def unified_table(feed: DataFrame, names: DataFrame) -> DataFrame:
    """All records of all files in one schema; ``names`` without a provider hold for all.

    Columns: the feed's ids, the fields of ``UNIFIED`` as text, ``other``, a map
    of all further fields under their canonical names, and ``more``, a map of
    lists: where a record has several names of one field, the column or ``other``
    has the first filled value in the order of those names, ``more`` the rest.
    Arrays and objects give their leaves joined by a line break.
    """
    ids = ["feed_row_id", "provider_id", "file_id", "file_date", "received_at", "line_no"]

    @F.pandas_udf("array<struct<field:string,value:string>>")
    def entries(payloads):  # noqa: ANN001
        out = []
        for payload in payloads:
            record = _record(payload)
            out.append(
                None
                if record is None
                else [{"field": k, "value": _as_text(v)} for k, v in record.items()]
            )
        return pd.Series(out, dtype=object)

    cells = feed.select("feed_row_id", "provider_id", F.explode(entries("payload")).alias("e")).select("feed_row_id", "provider_id", "e.field", "e.value")
    if "provider_id" not in names.columns:
        names = names.withColumn("provider_id", F.lit(None).cast("long"))
    own = names.where("provider_id is not null")
    agreed = names.where("provider_id is null").select("field", F.col("canonical").alias("agreed"))
    named = cells.join(own, ["provider_id", "field"], "left").join(agreed, "field", "left").select(
        "feed_row_id", F.coalesce("canonical", "agreed", "field").alias("name"), "field", "value"
    )
    # values of one name in the order of their fields, nulls last
    fields = named.groupBy("feed_row_id", "name").agg(
        F.array_sort(F.collect_list(F.struct(F.col("value").isNull().alias("blank"), "field", "value"))).alias("all")
    ).select(
        "feed_row_id",
        "name",
        F.col("all")[0]["value"].alias("first"),
        F.transform(F.filter(F.slice("all", 2, F.size("all")), lambda x: ~x["blank"]), lambda x: x["value"]).alias("rest"),
    )
    best = [F.max(F.when(F.col("name") == n, F.col("first"))).alias(n) for n in UNIFIED]
    pairs = lambda test, value: F.map_from_entries(F.array_sort(F.collect_list(F.when(test, F.struct("name", value)))))
    other = pairs(~F.col("name").isin(*UNIFIED), "first").alias("other")
    more = pairs(F.size("rest") > 0, "rest").alias("more")
    wide = fields.groupBy("feed_row_id").agg(*best, other, more)
    return feed.select(*ids).join(wide, "feed_row_id", "left")


def _as_text(value: object) -> str | None:
    if value is None:
        return None
    if isinstance(value, (dict, list)):
        found = []
        stack = [value]
        while stack:
            item = stack.pop()
            if isinstance(item, dict):
                stack += reversed(list(item.values()))
            elif isinstance(item, list):
                stack += reversed(item)
            elif item is not None:
                found.append(item if isinstance(item, str) else json.dumps(item))
        return "\n".join(found) or None
    return value if isinstance(value, str) else json.dumps(value)
