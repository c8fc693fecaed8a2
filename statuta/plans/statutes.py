"""Queries of the statute operators over units, laws, annex lists and vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions import text as X
from statuta.functions import vectors as V
from statuta.operators import export, lookup, search
from statuta.operators import units as U
from statuta.session import spread, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Host for relative links.
BASE = "http://law.example"
#: Names of the columns of ``units.stable_key``.
_KEYS = ("k_jo", "k_hang", "k_mok", "k_title", "k_text")


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def register(function):  # noqa: ANN001
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


# ---------------------------------------------------------------- SQL pieces

_S = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ART = r"(?:제[\s\x{0b}]*)?(\d+)[\s\x{0b}]*조(?:[\s\x{0b}]*의[\s\x{0b}]*(\d+))?"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_S}+|{_S}+$', '', 'g')"


def _squash(x: str) -> str:
    return f"coalesce(trim(regexp_replace({x}, '{_S}+', ' ', 'g')), '')"


def _group(x: str, pattern: str, k: int) -> str:
    return f"nullif(regexp_extract({x}, '{pattern}', {k}), '')"


def _paragraph(x: str) -> str:
    bare = _strip(x)
    return f"coalesce(CASE WHEN length({bare}) = 1 THEN nullif(instr('{X.CIRCLED}', {bare}), 0) END, try_cast({_group(bare, r'(\d+)', 1)} AS INT))::INT"


def _item(x: str) -> str:
    return f"try_cast({_group(x, rf'^{_S}*(\d+){_S}*\.?{_S}*$', 1)} AS INT)"


def _branch(n: str, s: str) -> str:
    return f"({n} || CASE WHEN {s} IS NOT NULL THEN '의' || {s} ELSE '' END)"


def _article_norm() -> str:
    fields = [_strip(c) for c in ("jo", "path", "title", "text")]
    pairs = [(_group(f, _ART, 1), _group(f, _ART, 2)) for f in fields]
    return "coalesce(" + ", ".join(
        [f"CASE WHEN {s} IS NOT NULL THEN {n} || '의' || {s} END" for n, s in pairs] + [n for n, _ in pairs]
    ) + ")"


def _article_path(x: str) -> str:
    shape = r"^[\s\x{0b}]*(\d+)(?:[\s\x{0b}]*의[\s\x{0b}]*(\d+))?[\s\x{0b}]*$"
    n, s = f"try_cast({_group(x, shape, 1)} AS BIGINT)", f"try_cast({_group(x, shape, 2)} AS BIGINT)"
    return f"CASE WHEN {n} IS NOT NULL THEN '제' || {n} || '조' || CASE WHEN {s} IS NOT NULL THEN '의' || {s} ELSE '' END ELSE nullif({x}, '') END"


_REF = r"별표[\s\x{0b}]*(\d+)(?:[\s\x{0b}]*의[\s\x{0b}]*(\d+))?"
_REFS = f"""coalesce(list_transform(list_sort(list_distinct(list_transform(regexp_extract_all(text, '{_REF}', 0),
    lambda m: {{'n': length({_branch(f"try_cast({_group('m', _REF, 1)} AS BIGINT)::VARCHAR", f"try_cast({_group('m', _REF, 2)} AS BIGINT)::VARCHAR")}),
                'v': {_branch(f"try_cast({_group('m', _REF, 1)} AS BIGINT)::VARCHAR", f"try_cast({_group('m', _REF, 2)} AS BIGINT)::VARCHAR")}}}))),
    lambda y: y.v), [])"""
_DATES = r"""list_transform(flatten(list_transform(regexp_extract_all(text, '<[\s\x{0b}]*개정[^>]*>', 0),
    lambda t: regexp_extract_all(t, '\d{4}\.\d{1,2}\.\d{1,2}', 0))),
    lambda d: split_part(d, '.', 1) || '-' || lpad(split_part(d, '.', 2), 2, '0') || '-' || lpad(split_part(d, '.', 3), 2, '0'))"""

#: The units with their normalised columns.
NORM = f"""norm0 AS (
  SELECT *, {_paragraph('hang')} AS hang_norm, {_item('mok')} AS mok_norm, {_article_norm()} AS jo_norm FROM units
), norm AS (
  SELECT *, CASE WHEN level IN ('조','항','목')
      THEN concat_ws(' ', {_article_path(f"coalesce(jo_norm, nullif({_strip('jo')}, ''))")},
        CASE WHEN hang_norm <> 0 THEN '제' || hang_norm || '항' END, CASE WHEN mok_norm <> 0 THEN '제' || mok_norm || '호' END)
      ELSE coalesce(nullif(path, ''), nullif(title, ''), level, '') END AS display_path_norm,
    CASE WHEN level IN ('조','항','목') THEN {_REFS} ELSE [] END AS annex_refs,
    {_DATES} AS amended_all
  FROM norm0
)"""
#: The first unit of each stable key of a law, with dense ids.
IDS = f"""{NORM}, keyed AS (
  SELECT *, row_number() OVER (PARTITION BY mst, coalesce(jo_norm, jo), coalesce(hang_norm, 0), coalesce(mok_norm, 0),
      coalesce({_strip('title')}, ''), sha256(coalesce(text, ''))[:16] ORDER BY unit_id) AS nth FROM norm
), ids AS (
  SELECT * EXCLUDE nth, row_number() OVER (PARTITION BY mst ORDER BY unit_id) - 1 AS faiss_id FROM keyed WHERE nth = 1
)"""


def _hash_vec(x: str) -> str:
    words = ", ".join(f"('0x' || substr(sha256(coalesce({x}, '')), {1 + 8 * k}, 8))::UBIGINT::DOUBLE::FLOAT" for k in range(8))
    scaled = f"list_transform([{words}], lambda w: ((((w::DOUBLE / 4294967295.0::FLOAT::DOUBLE)::FLOAT)::DOUBLE * 2.0)::FLOAT::DOUBLE - 1.0)::FLOAT)"
    return f"(SELECT list_transform(z, lambda x: (x::DOUBLE / n)::FLOAT) FROM (SELECT z, sqrt(list_sum(list_transform(z, lambda x: x::DOUBLE * x::DOUBLE)))::FLOAT::DOUBLE AS n FROM (SELECT {scaled} AS z)))"


def _active(cutoff: str, eff: str) -> str:
    def date(x: str) -> str:
        head = f"left({_strip(x)}, 10)"
        shape = r"^[\s\x{0b}]*(\d+)[\s\x{0b}]*-[\s\x{0b}]*(\d+)[\s\x{0b}]*-[\s\x{0b}]*(\d+)[\s\x{0b}]*$"
        y, m, d = (f"lpad({_group(head, shape, k)}, {w}, '0')" for k, w in ((1, 4), (2, 2), (3, 2)))
        return f"CASE WHEN regexp_matches({head}, '{shape}') THEN try_cast({y} || '-' || {m} || '-' || {d} AS DATE) END"

    return f"({date(cutoff)} IS NULL OR {date(eff)} IS NULL OR {date(eff)} <= {date(cutoff)})"


# ------------------------------------------------------------------- tables


def _units(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "units")


def _norm(spark: SparkSession, d: str) -> DataFrame:
    return U.normalised(spread(_units(spark, d), "unit_id"))


def _ids(spark: SparkSession, d: str, asked: DataFrame | None = None) -> DataFrame:
    """Units with dense ids; only those of the laws asked about, if questions are given."""
    units = _units(spark, d) if asked is None else search.asked_units(_units(spark, d), asked)
    return U.with_dense_ids(U.deduplicated(U.normalised(spread(units, "unit_id"))))


def _index(spark: SparkSession, d: str, asked: DataFrame, *more: str) -> DataFrame:
    """The search index over the units of the laws asked about, with dense ids and ``unit_id``.

    Texts are read once, for numbers, keys and vectors; only those are moved and written.
    """
    units = U.normalised(spread(search.asked_units(_units(spark, d), asked), "unit_id"))
    keys = U.stable_key()
    rows = search.entries(units.select("*", *keys), "unit_id", *more, *_KEYS)
    return U.with_dense_ids(U.first_of_each(rows, ["mst", *_KEYS]).drop(*_KEYS))


def _told(spark: SparkSession, d: str, best: DataFrame, index: DataFrame, *columns) -> DataFrame:  # noqa: ANN002
    """Answers with columns of their units, which are read for the answers only."""
    ids = best.join(index.select("mst", "faiss_id", "unit_id"), ["mst", "faiss_id"])
    found = _units(spark, d).join(ids.drop("mst"), "unit_id")
    return U.normalised(found).select(*columns)


# ---------------------------------------------------------- vectors


@query("SELECT vec_id, label, len(embedding)::INT AS dim FROM embeddings")
def scan_embeddings(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label", F.size("embedding").alias("dim"))


def _vector_queries(spark, d):
    e = table(spark, d, "embeddings")
    return e, e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("q"))


_L2 = "list_sum(list_transform(range(1, len(c.embedding) + 1), lambda i: (c.embedding[i]::DOUBLE - q.embedding[i]::DOUBLE) ** 2))"
_KNN = f"""SELECT q.vec_id AS qid, c.vec_id, {_L2} AS dist,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY {_L2}, c.vec_id) AS rank
  FROM embeddings c, embeddings q WHERE q.vec_id % 20 = 0"""


@query(f"SELECT qid, vec_id, round(dist, 6) AS dist, rank::INT AS rank FROM ({_KNN}) WHERE rank <= 10")
def knn_l2(spark, d):
    near = search.nearest(*_vector_queries(spark, d), 10)
    return near.select("qid", "vec_id", F.round("dist", 6).alias("dist"), "rank")


@query(f"SELECT k.qid, k.rank::INT AS rank, e.label FROM ({_KNN}) k JOIN embeddings e USING (vec_id) WHERE k.rank <= 5")
def knn_join_units(spark, d):
    """Neighbours joined to their records by id."""
    e, q = _vector_queries(spark, d)
    return search.nearest(e, q, 5).join(e.select("vec_id", "label"), "vec_id").select("qid", "rank", "label")


@query(
    """WITH q AS (SELECT embedding AS q FROM embeddings ORDER BY vec_id LIMIT 1)
    SELECT vec_id, round(list_sum(list_transform(range(1, len(embedding) + 1), lambda i: (embedding[i]::DOUBLE - q[i]::DOUBLE) ** 2)), 6) AS dist
    FROM embeddings, q ORDER BY list_sum(list_transform(range(1, len(embedding) + 1), lambda i: (embedding[i]::DOUBLE - q[i]::DOUBLE) ** 2)), vec_id LIMIT 200"""
)
def knn_topk(spark, d):
    """The 200 nearest vectors of one query vector (top 10 with the usual over-fetch)."""
    e = table(spark, d, "embeddings")
    vector = e.orderBy("vec_id").first()["embedding"]
    dist = V.squared_distance(F.col("embedding"), F.array(*(F.lit(float(x)) for x in vector)))
    return e.select("vec_id", dist.alias("raw")).orderBy("raw", "vec_id").limit(200).select("vec_id", F.round("raw", 6).alias("dist"))


@query(
    """SELECT qid, vec_id, round(sim, 6) AS sim, rank::INT AS rank FROM (
      SELECT qid, vec_id, sim, row_number() OVER (PARTITION BY qid ORDER BY round(1 - sim, 12), vec_id) AS rank FROM (
        SELECT q.vec_id AS qid, c.vec_id, list_sum(list_transform(range(1, len(c.embedding) + 1), lambda i: c.embedding[i]::DOUBLE * q.embedding[i]::DOUBLE))
          / sqrt(list_sum(list_transform(c.embedding, lambda x: x::DOUBLE * x::DOUBLE))) / sqrt(list_sum(list_transform(q.embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS sim
        FROM embeddings c, embeddings q WHERE q.vec_id % 20 = 0)) WHERE rank <= 10"""
)
def cosine_topk(spark, d):
    near = search.nearest(*_vector_queries(spark, d), 10, cosine=True)
    return near.select("qid", "vec_id", F.round(1 - F.col("dist"), 6).alias("sim"), "rank")


@query(
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN vec_id % 7 = 0 THEN 0::FLOAT WHEN x > 0.3 AND vec_id % 5 = 0 THEN 'nan'::FLOAT WHEN x < -0.3 AND vec_id % 5 = 0 THEN 'inf'::FLOAT ELSE x END) AS v FROM embeddings),
    s AS (SELECT vec_id, list_transform(v, lambda x: CASE WHEN isnan(x) OR isinf(x) THEN 0::FLOAT ELSE x END) AS v FROM v)
    SELECT vec_id, round(CASE WHEN len(list_filter(v, lambda x: x <> 0)) = 0 THEN 1e-6::FLOAT ELSE v[1] END::DOUBLE, 7) AS first, round(list_sum(list_transform(v, lambda x: x::DOUBLE)), 5) AS total FROM s"""
)
def sanitize_vec(spark, d):
    e = table(spark, d, "embeddings")
    spoiled = F.transform(
        "embedding",
        lambda x: F.when(F.col("vec_id") % 7 == 0, F.lit(0.0))
        .when((x > 0.3) & (F.col("vec_id") % 5 == 0), F.lit(float("nan")))
        .when((x < -0.3) & (F.col("vec_id") % 5 == 0), F.lit(float("inf")))
        .otherwise(x.cast("double"))
        .cast("float"),
    )
    clean = e.select("vec_id", V.sanitize(spoiled).alias("v"))
    tiny = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return clean.select(
        "vec_id",
        F.round(F.col("v")[0].cast("double"), 7).alias("first"),
        F.round(F.when(F.col("v")[0] == F.lit(1e-6).cast("float"), 0.0).otherwise(tiny), 5).alias("total"),
    )


@query(f"SELECT unit_id, {', '.join(f'round(v[{k + 1}]::DOUBLE, 6) AS e{k}' for k in range(8))} FROM (SELECT unit_id, {_hash_vec('text')} AS v FROM units)")
def hash_embed(spark, d):
    v = spread(_units(spark, d).select("unit_id", "text"), "unit_id").select("unit_id", V.hash_embedding(F.col("text")).alias("v"))
    return v.select("unit_id", *(F.round(F.col("v")[k].cast("double"), 6).alias(f"e{k}") for k in range(8)))


@query(
    """SELECT label, (i - 1)::INT AS dim, round(avg(embedding[i]::DOUBLE), 6) AS mean FROM embeddings, range(1, 65) t(i) GROUP BY label, i"""
)
def mean_pool(spark, d):
    e = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("dim", "x"))
    return e.groupBy("label", "dim").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"))


# ------------------------------------------------------------ scalar functions


@query(f"SELECT unit_id, {_squash('title')} AS title, {_squash('path')} AS path FROM units")
def str_clean(spark, d):
    return _units(spark, d).select("unit_id", X.squash(F.col("title")).alias("title"), X.squash(F.col("path")).alias("path"))


@query(f"SELECT unit_id, {_paragraph('hang')} AS hang_norm FROM units")
def circled_to_int(spark, d):
    return _units(spark, d).select("unit_id", X.paragraph_number(F.col("hang")).alias("hang_norm"))


@query(f"SELECT unit_id, {_item('mok')} AS mok_norm FROM units")
def normalize_item(spark, d):
    return _units(spark, d).select("unit_id", X.item_number(F.col("mok")).alias("mok_norm"))


@query(f"WITH {NORM} SELECT unit_id, jo_norm FROM norm")
def normalize_article(spark, d):
    return _norm(spark, d).select("unit_id", "jo_norm")


@query(f"WITH {NORM} SELECT unit_id, display_path_norm FROM norm")
def display_path(spark, d):
    return _norm(spark, d).select("unit_id", "display_path_norm")


@query(f"WITH {NORM} SELECT unit_id, coalesce(array_to_string(list_filter(amended_all, lambda x, i: list_position(amended_all, x) = i), ','), '') AS amended_on FROM norm")
def amend_dates(spark, d):
    return _norm(spark, d).select("unit_id", F.array_join("amended_on", ",").alias("amended_on"))


@query(f"WITH {NORM} SELECT unit_id, array_to_string(annex_refs, ',') AS annex_refs FROM norm")
def annex_refs(spark, d):
    return _norm(spark, d).select("unit_id", F.array_join("annex_refs", ",").alias("annex_refs"))


_ANNEX_NO = rf"regexp_replace(nullif({_strip('annex_no')}, ''), '^(\d+)[\s\x{{0b}}]*(?:[-_/]|의)[\s\x{{0b}}]*(\d+)$', '\1의\2')"


@query(f"SELECT unit_id, {_ANNEX_NO} AS annex_no FROM units WHERE level IN ('별표','서식')")
def annex_no_norm(spark, d):
    return _units(spark, d).where(F.col("level").isin(*U.ANNEX)).select("unit_id", X.annex_number(F.col("annex_no")).alias("annex_no"))


def _human(x: str) -> str:
    code = f"CASE WHEN length({x}) < 6 THEN lpad({x}, 6, '0') ELSE {x} END"
    head, tail = f"try_cast(substr({code}, 1, 4) AS INT)", f"try_cast(substr({code}, 5) AS INT)"
    return rf"CASE WHEN coalesce({x}, '') = '' THEN '' WHEN regexp_full_match({code}, '\d+') THEN {head}::VARCHAR || CASE WHEN {tail} <> 0 THEN '의' || {tail} ELSE '' END END"


@query(f"SELECT unit_id, {_human('annex_no')} AS human FROM units WHERE level IN ('별표','서식')")
def annex_no_human(spark, d):
    return _units(spark, d).where(F.col("level").isin(*U.ANNEX)).select("unit_id", X.annex_number_human(F.col("annex_no")).alias("human"))


@query(
    rf"""SELECT unit_id, {_branch(_group('t', r'(?:제[\s\x{0b}]*)?(\d+)[\s\x{0b}]*조[\s\x{0b}]*(?:의[\s\x{0b}]*(\d+))?', 1), _group('t', r'(?:제[\s\x{0b}]*)?(\d+)[\s\x{0b}]*조[\s\x{0b}]*(?:의[\s\x{0b}]*(\d+))?', 2))} AS jo,
    {_paragraph(_group('t', r'(?:제[\s\x{0b}]*)?([0-9①-⑳]+)[\s\x{0b}]*항', 1))} AS hang,
    try_cast({_group('t', r'(?:제[\s\x{0b}]*)?(\d+)[\s\x{0b}]*호', 1)} AS INT) AS mok FROM (SELECT unit_id, {_strip('text')} AS t FROM units)"""
)
def parse_citation(spark, d):
    return _units(spark, d).select("unit_id", X.citation(X.strip(F.col("text"))).alias("c")).select("unit_id", "c.jo", "c.hang", "c.mok")


@query(
    rf"""SELECT unit_id, CASE WHEN {_group('q', r'별표[\s\x{0b}]*(\d+)', 1)} IS NOT NULL THEN nullif({_strip(f"regexp_extract(q, '{X.NAMED_ANNEX.replace(chr(39), chr(39) * 2)}', 1)")}, '') END AS law_name,
    try_cast({_group('q', r'별표[\s\x{0b}]*(\d+)', 1)} AS INT) AS number
    FROM (SELECT u.unit_id, '"' || coalesce(l.law_name, '') || '"의 ' || coalesce(u.path, '') || ' 링크' AS q FROM units u
      JOIN (SELECT mst, arg_min(law_name, law_row_id) FILTER (law_name IS NOT NULL) AS law_name FROM laws GROUP BY mst) l USING (mst) WHERE u.level IN ('별표','서식'))"""
)
def intent_extract(spark, d):
    """The law and annex that a question asks for; questions are made of units."""
    names = table(spark, d, "laws").where("law_name is not null").groupBy("mst").agg(F.min_by("law_name", "law_row_id").alias("law_name"))
    all_laws = table(spark, d, "laws").select("mst").distinct().join(names, "mst", "left")
    asked = _units(spark, d).where(F.col("level").isin(*U.ANNEX)).join(all_laws, "mst")
    question = F.concat(F.lit('"'), F.coalesce("law_name", F.lit("")), F.lit('"의 '), F.coalesce("path", F.lit("")), F.lit(" 링크"))
    return asked.select("unit_id", X.annex_intent(question).alias("i")).select("unit_id", "i.law_name", "i.number")


@query(
    r"""SELECT unit_id, CASE WHEN try_cast(n[1] AS INT) IS NOT NULL THEN lpad(n[1]::INT::VARCHAR, greatest(4, length(n[1]::INT::VARCHAR))::INT, '0')
      || lpad(coalesce(try_cast(n[2] AS INT), 0)::VARCHAR, greatest(2, length(coalesce(try_cast(n[2] AS INT), 0)::VARCHAR))::INT, '0') END AS code
    FROM (SELECT unit_id, regexp_extract_all(jo, '\d+', 0) AS n FROM units)"""
)
def jo_codes(spark, d):
    return _units(spark, d).select("unit_id", X.article_code(F.col("jo")).alias("code"))


@query(rf"""SELECT unit_id, {_strip("regexp_replace(coalesce(title, ''), '[/:*?" + chr(34) + "<>|]+', '_', 'g')")} AS name FROM units""")
def safe_filename(spark, d):
    return _units(spark, d).select("unit_id", X.safe_filename(F.coalesce("title", F.lit(""))).alias("name"))


@query(rf"""SELECT law_row_id, regexp_replace(left({_squash(r"regexp_replace(regexp_replace(nfc_normalize(law_name), '[\\/:*?" + '"' + r"<>|]+', ' ', 'g'), '[\p{C}\p{Zl}\p{Zp}]', '', 'g')")}, 80), '\s+$', '') AS slug FROM laws""")
def fs_slug(spark, d):
    return table(spark, d, "laws").select("law_row_id", X.slug(F.col("law_name")).alias("slug"))


@query(
    f"""SELECT unit_id, CASE WHEN starts_with(u, 'http') THEN nullif(u, '') ELSE '{BASE}' || nullif(u, '') END AS url
    FROM (SELECT unit_id, links.pdf AS u FROM units WHERE level IN ('별표','서식'))"""
)
def abs_url(spark, d):
    rows = _units(spark, d).where(F.col("level").isin(*U.ANNEX))
    return rows.select("unit_id", X.absolute_url(F.col("links.pdf"), BASE).alias("url"))


@query(
    """SELECT unit_id, concat_ws(' > ', '제' || nullif(jo, '') || '조', '제' || nullif(hang, '') || '항',
      CASE WHEN nullif(mok, '') IS NOT NULL THEN CASE WHEN ends_with(mok, '.') THEN mok || '호' ELSE mok || '.호' END END) AS path
    FROM units WHERE level IN ('조','항','목')"""
)
def unit_path(spark, d):
    rows = _units(spark, d).where(F.col("level").isin(*U.BODY))
    return rows.select("unit_id", X.unit_path(F.col("jo"), F.col("hang"), F.col("mok")).alias("path"))


@query(
    r"""SELECT doc_id, CASE WHEN length(t) > 160 THEN left(t, 160) || '...' ELSE t END AS snippet
    FROM (SELECT doc_id, replace(coalesce(text, ''), chr(10), ' ') AS t FROM documents)"""
)
def snippet(spark, d):
    return table(spark, d, "documents").select("doc_id", X.snippet(F.col("text")).alias("snippet"))


@query("SELECT doc_id, left(sha256(coalesce(text, '')), 16) AS fp FROM documents")
def text_fingerprint(spark, d):
    return table(spark, d, "documents").select("doc_id", X.fingerprint(F.col("text")).alias("fp"))


_BREAK = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"


@query(
    f"""SELECT doc_id, md5({_strip(f"array_to_string(list_transform(string_split_regex(coalesce(text, ''), '{_BREAK}'), lambda s: regexp_replace(s, '{_S}+$', '')), chr(10))")}) AS clean FROM documents"""
)
def clean_md(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(X.clean_lines(F.col("text"))).alias("clean"))


def _no_labels(x: str) -> str:
    for label in X.ANNEX_LABELS:
        x = f"replace({x}, '{label}', '')"
    return x


@query(f"SELECT unit_id, length({_squash(_no_labels("coalesce(text, '')"))}) >= 100 AS meaningful FROM units")
def meaningful_text(spark, d):
    return _units(spark, d).select("unit_id", X.is_meaningful(F.col("text")).alias("meaningful"))


@query(
    f"""WITH lines AS (SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS raw FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '{_BREAK}') AS l FROM documents)),
    rows AS (SELECT doc_id, pos, {_strip('raw')} AS line FROM lines WHERE starts_with({_strip('raw')}, '|') AND ends_with({_strip('raw')}, '|')),
    runs AS (SELECT doc_id, pos, line, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM rows),
    kept AS (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY pos) AS nth FROM runs),
    each AS (SELECT doc_id, run, string_agg(line, ' ' ORDER BY pos) AS summary FROM kept WHERE nth <= 2 GROUP BY doc_id, run)
    SELECT doc_id, string_agg(summary, chr(10) ORDER BY run) AS summaries FROM each GROUP BY doc_id"""
)
def table_summaries(spark, d):
    runs = table(spark, d, "documents").select("doc_id", X.table_runs(F.col("text")).alias("r"))
    return runs.where(F.size("r") > 0).select("doc_id", F.array_join("r", "\n").alias("summaries"))


# ---------------------------------------------------- units: dedup, ids, projections


@query(f"WITH {IDS} SELECT unit_id, mst, jo_norm FROM ids")
def dedup_units(spark, d):
    return U.deduplicated(_norm(spark, d)).select("unit_id", "mst", "jo_norm")


@query(f"WITH {IDS} SELECT unit_id, mst, faiss_id::INT AS faiss_id FROM ids")
def assign_ids(spark, d):
    return _ids(spark, d).select("unit_id", "mst", "faiss_id")


_EMBED_IN = _strip("coalesce(title, '') || chr(10) || coalesce(text, '')")


@query(f"WITH {IDS} SELECT mst, faiss_id::INT AS faiss_id, level, jo, hang, mok, path, title, {_EMBED_IN} AS text FROM ids")
def answers_projection(spark, d):
    return U.answers(_ids(spark, d))


@query(f"WITH {IDS} SELECT faiss_id::INT AS faiss_id, mst, level, jo, hang, mok, path, title FROM ids")
def id_map_projection(spark, d):
    return U.id_map(_ids(spark, d))


@query(f"SELECT unit_id, md5({_EMBED_IN}) AS input FROM units")
def embed_input(spark, d):
    return _units(spark, d).select("unit_id", F.md5(search.embed_input()).alias("input"))


_SCORE = f"""(CASE WHEN nullif(links.html, '') IS NOT NULL THEN 4 ELSE 0 END + CASE WHEN nullif(links.pdf, '') IS NOT NULL THEN 2 ELSE 0 END
  + CASE WHEN nullif(links.detail, '') IS NOT NULL THEN 1 ELSE 0 END + least(50, length(coalesce({_strip('title')}, ''))) + CASE WHEN level = '별표' THEN 1 ELSE 0 END)"""


@query(
    f"""SELECT mst, annex_key, unit_id, first_seen, score::INT AS score FROM (
      SELECT *, min(unit_id) OVER (PARTITION BY mst, annex_key) AS first_seen, row_number() OVER (PARTITION BY mst, annex_key ORDER BY score DESC, unit_id) AS nth
      FROM (SELECT mst, unit_id, coalesce(nullif({_ANNEX_NO}, ''), title, '') AS annex_key, {_SCORE} AS score FROM units WHERE level IN ('별표','서식'))) WHERE nth = 1"""
)
def annex_best(spark, d):
    return U.best_annexes(_units(spark, d)).select("mst", "annex_key", "unit_id", "first_seen", F.col("score").cast("int").alias("score"))


@query(
    f"""SELECT jo, n, first_id FROM (SELECT coalesce({_strip('jo')}, '') AS jo, count(*) AS n, min(unit_id) AS first_id FROM units GROUP BY 1) ORDER BY n DESC, first_id LIMIT 10"""
)
def freq_topn(spark, d):
    by = _units(spark, d).groupBy(F.coalesce(X.strip(F.col("jo")), F.lit("")).alias("jo"))
    return by.agg(F.count(F.lit(1)).alias("n"), F.min("unit_id").alias("first_id")).orderBy(F.desc("n"), "first_id").limit(10)


@query("SELECT count(*) FILTER (nullif(text, '') IS NOT NULL AND text <> title) AS filled, count(*) AS total FROM units WHERE level IN ('별표','서식')")
def fill_stats(spark, d):
    rows = _units(spark, d).where(F.col("level").isin(*U.ANNEX))
    return rows.agg(F.count_if(X.filled(F.col("text")).isNotNull() & (F.col("text") != F.col("title"))).alias("filled"), F.count(F.lit(1)).alias("total"))


@query("SELECT mst, level, count(*) AS units, min(unit_id) AS first_id FROM units GROUP BY mst, level")
def build_stats(spark, d):
    return _units(spark, d).groupBy("mst", "level").agg(F.count(F.lit(1)).alias("units"), F.min("unit_id").alias("first_id"))


@query(f"WITH {NORM} SELECT mst, count(DISTINCT r) AS n_refs, string_agg(DISTINCT r, ',' ORDER BY r) AS refs FROM (SELECT mst, unnest(annex_refs) AS r FROM norm) GROUP BY mst")
def refs_union(spark, d):
    refs = _norm(spark, d).select("mst", F.explode("annex_refs").alias("r")).distinct()
    return refs.groupBy("mst").agg(F.count("r").alias("n_refs"), F.array_join(F.array_sort(F.collect_list("r")), ",").alias("refs"))


@query(f"WITH {NORM} SELECT mst, bool_or(len(annex_refs) > 0) AS cites_annex FROM norm GROUP BY mst")
def any_annex(spark, d):
    return _norm(spark, d).groupBy("mst").agg(F.bool_or(F.size("annex_refs") > 0).alias("cites_annex"))


@query(
    """SELECT u.unit_id, u.mst, l.effective_date, l.promulgation_date, l.revision_type FROM units u LEFT JOIN (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mst ORDER BY law_row_id) AS nth FROM laws) WHERE nth = 1) l USING (mst)"""
)
def meta_broadcast(spark, d):
    """Each law's first listed dates and revision type on its units."""
    laws = table(spark, d, "laws")
    first = laws.join(laws.groupBy("mst").agg(F.min("law_row_id").alias("law_row_id")), ["mst", "law_row_id"], "left_semi")
    dates = first.select("mst", "effective_date", "promulgation_date", "revision_type")
    return _units(spark, d).select("unit_id", "mst").join(dates, "mst", "left")


@query(
    """SELECT u.unit_id, coalesce(u.effective_date, l.effective_date) AS effective_date, coalesce(u.promulgation_date, l.promulgation_date) AS promulgation_date,
      coalesce(u.revision_type, l.revision_type) AS revision_type FROM units u LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mst ORDER BY law_row_id) AS nth FROM laws) WHERE nth = 1) l USING (mst)"""
)
def fill_missing(spark, d):
    laws = table(spark, d, "laws")
    first = laws.join(laws.groupBy("mst").agg(F.min("law_row_id").alias("law_row_id")), ["mst", "law_row_id"], "left_semi")
    names = ("effective_date", "promulgation_date", "revision_type")
    meta = first.select("mst", *(F.col(n).alias(f"l_{n}") for n in names))
    return _units(spark, d).join(meta, "mst", "left").select("unit_id", *(F.coalesce(n, f"l_{n}").alias(n) for n in names))


@query(
    """SELECT mst, law_name FROM (SELECT mst, law_name, row_number() OVER (PARTITION BY mst ORDER BY law_row_id) AS nth FROM laws WHERE nullif(trim(law_name), '') IS NOT NULL) WHERE nth = 1"""
)
def first_non_null(spark, d):
    laws = table(spark, d, "laws").where(F.nullif(F.trim("law_name"), F.lit("")).isNotNull())
    return laws.groupBy("mst").agg(F.min_by("law_name", "law_row_id").alias("law_name"))


@query(
    """SELECT u.unit_id, n.law_name FROM units u LEFT JOIN (SELECT mst, arg_min(law_name, law_row_id) AS law_name FROM laws WHERE nullif(trim(law_name), '') IS NOT NULL GROUP BY mst) n USING (mst)"""
)
def name_lookup(spark, d):
    return _units(spark, d).select("unit_id", "mst").join(first_non_null(spark, d), "mst", "left").select("unit_id", "law_name")


@query("SELECT mst, min(law_row_id) AS first_seen FROM laws WHERE nullif(trim(mst), '') IS NOT NULL GROUP BY mst")
def distinct_first_seen(spark, d):
    laws = table(spark, d, "laws").where(F.nullif(F.trim("mst"), F.lit("")).isNotNull())
    return laws.groupBy("mst").agg(F.min("law_row_id").alias("first_seen"))


@query("SELECT law_name, arg_min(mst, law_row_id) AS mst FROM laws WHERE mst IS NOT NULL GROUP BY law_name")
def first_per_group(spark, d):
    return table(spark, d, "laws").where("mst is not null").groupBy("law_name").agg(F.min_by("mst", "law_row_id").alias("mst"))


@query(
    """SELECT source, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS kinds FROM (
      SELECT source, list(doc_kind ORDER BY doc_id) AS l FROM documents WHERE doc_kind IS NOT NULL GROUP BY source)"""
)
def ordered_distinct(spark, d):
    """Distinct kinds of each source in order of first appearance; the group is
    reduced to one row a kind before it is ordered."""
    first = table(spark, d, "documents").where("doc_kind is not null").groupBy("source", "doc_kind").agg(F.min("doc_id").alias("at"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "doc_kind"))), lambda x: x["doc_kind"])
    return first.groupBy("source").agg(F.array_join(ordered, ",").alias("kinds"))


# --------------------------------------------------------- filters

#: A stated set of questions; the law is the largest one.
QUESTIONS = [
    (1, "990017", "제4조의2 제3항 제2호", "2024-06-30"),
    (2, "990017", "제38조 제1항에 따른 보고", None),
    (3, "990017", "별표 3의 설치기준은?", "2023-1-5"),
    (4, "990017", "제12조", "20240101"),
    (5, "1000001", "제2조 ①항 1호의 서식", "2020-01-01"),
]


def _questions(spark):
    return spark.createDataFrame(QUESTIONS, "qid int, mst string, query string, as_of string")


_ASKED = (
    "asked AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{m}', '{q}', {'NULL' if a is None else repr(a)})" for i, m, q, a in QUESTIONS)
    + ") v(qid, mst, query, as_of)), cited AS (SELECT *, "
    + _branch(_group("query", r"(?:제\s*)?(\d+)\s*조\s*(?:의\s*(\d+))?", 1), _group("query", r"(?:제\s*)?(\d+)\s*조\s*(?:의\s*(\d+))?", 2))
    + " AS c_jo, "
    + _paragraph(_group("query", r"(?:제\s*)?([0-9①-⑳]+)\s*항", 1))
    + " AS c_hang, try_cast("
    + _group("query", r"(?:제\s*)?(\d+)\s*호", 1)
    + " AS INT) AS c_mok FROM asked)"
)
_BASE = f"""{IDS}, {_ASKED}, base AS (SELECT i.*, c.qid, c.query, c.as_of, c.c_jo, c.c_hang, c.c_mok,
    {_active('c.as_of', 'i.effective_date')} AS active,
    (coalesce(coalesce(jo_norm, {_strip('jo')}) = c_jo, false)::INT + coalesce(hang_norm = c_hang, false)::INT + coalesce(mok_norm = c_mok, false)::INT) AS matches,
    ((nullif(c_jo, '') IS NOT NULL OR coalesce(c_hang, 0) <> 0 OR coalesce(c_mok, 0) <> 0)
      AND (nullif(c_jo, '') IS NULL OR {_strip("coalesce(jo_norm, jo, '')")} = c_jo)
      AND (c_hang IS NULL OR coalesce(hang_norm = c_hang, false)) AND (c_mok IS NULL OR coalesce(mok_norm = c_mok, false))) AS exact,
    coalesce(nullif(display_path_norm, ''), path, '') AS shown
  FROM ids i JOIN cited c USING (mst))"""


def _asked(spark, d, questions=None):
    """Entries of the distinct units of the laws asked about, without vectors, and the questions: the stated ones, or those given, which may be many."""
    asked = search.asked_about(_questions(spark) if questions is None else questions, vectors=False)
    units = U.normalised(spread(search.asked_units(_units(spark, d), asked), "unit_id")).select("*", *U.stable_key())
    return U.first_of_each(search.entries(units, "unit_id", "path", "display_path_norm", *_KEYS, vectors=False), ["mst", *_KEYS]), asked


@query(f"WITH {_BASE} SELECT qid, unit_id FROM base WHERE active")
def as_of_filter(spark, d, questions=None):
    return search.valid_pairs(*_asked(spark, d, questions))


@query(f"WITH {_BASE} SELECT qid, unit_id FROM base WHERE exact")
def meta_match_all(spark, d, questions=None):
    return search.exact_pairs(*_asked(spark, d, questions)).select("qid", "unit_id")


@query(
    f"""WITH {_BASE} SELECT qid, unit_id FROM base WHERE (nullif(c_jo, '') IS NULL OR coalesce(jo = c_jo, false) OR coalesce(jo_norm = c_jo, false) OR contains(shown, '제' || c_jo || '조'))
      AND (c_hang IS NULL OR coalesce(hang_norm = c_hang, false) OR contains(shown, '제' || c_hang || '항'))
      AND (c_mok IS NULL OR coalesce(mok_norm = c_mok, false) OR contains(shown, '제' || c_mok || '호'))"""
)
def meta_match_lenient(spark, d, questions=None):
    return search.lenient_pairs(*_asked(spark, d, questions), uncited=True).select("qid", "unit_id")


@query(f"WITH {_BASE} SELECT qid, unit_id FROM base WHERE active AND matches >= 2")
def meta_match_strict(spark, d, questions=None):
    return search.strict_pairs(*_asked(spark, d, questions)).select("qid", "unit_id")


@query(f"WITH {_BASE} SELECT qid, matches::INT AS matches, count(*) AS units FROM base GROUP BY qid, matches")
def meta_match_count(spark, d, questions=None):
    units, asked = _asked(spark, d, questions)
    asked = F.broadcast(asked) if asked.count() <= search.STATED else asked
    rows = units.join(asked, "mst").withColumn("matches", U.match_count(F.col("c.jo"), F.col("c.hang"), F.col("c.mok")))
    return rows.groupBy("qid", "matches").agg(F.count(F.lit(1)).alias("units"))


@query(
    f"""SELECT unit_id FROM units WHERE length(coalesce({_strip('text')}, '')) >= 20 AND NOT (contains(coalesce(title, ''), '삭제') AND length(coalesce({_strip('text')}, '')) < 120)"""
)
def export_filters(spark, d):
    return _units(spark, d).where(export.export_filter(20, skip_deletion=True)).select("unit_id")


# --------------------------------------------------- search

_CAND = f"""{_BASE}, vecs AS (SELECT *, {_hash_vec(_EMBED_IN)} AS v, {_hash_vec('query')} AS q FROM base),
dists AS (SELECT * EXCLUDE (v, q), list_sum(list_transform(range(1, 9), lambda i: (v[i]::DOUBLE - q[i]::DOUBLE) ** 2)) AS dist FROM vecs),
raw AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, faiss_id) AS raw_rank FROM dists),
near AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, faiss_id) AS seed_rank, 0 AS stage, dist AS distance FROM raw WHERE raw_rank <= 100 AND active),
inj AS (SELECT *, 0 AS seed_rank, 1 AS stage, 1e9::DOUBLE AS distance FROM raw r WHERE exact AND NOT EXISTS (SELECT 1 FROM near n WHERE n.qid = r.qid AND n.faiss_id = r.faiss_id)),
found AS (SELECT * FROM near UNION ALL BY NAME SELECT * FROM inj),
refs AS (SELECT DISTINCT qid, unnest(annex_refs) AS ref FROM found WHERE seed_rank <= 10),
fall AS (SELECT DISTINCT qid, unnest(annex_refs) AS ref FROM raw r WHERE nullif(c_jo, '') IS NOT NULL AND ({_strip("coalesce(jo_norm, jo, '')")} = c_jo OR coalesce({_strip('jo')} = '제' || c_jo || '조', false))
  AND NOT EXISTS (SELECT 1 FROM refs x WHERE x.qid = r.qid)),
targets AS (SELECT * FROM refs UNION ALL SELECT * FROM fall),
ann AS (SELECT *, 0 AS seed_rank, 2 AS stage, 1e9::DOUBLE AS distance FROM raw r WHERE active AND level IN ('별표','서식')
  AND EXISTS (SELECT 1 FROM targets t WHERE t.qid = r.qid AND t.ref = r.annex_no) AND NOT EXISTS (SELECT 1 FROM found n WHERE n.qid = r.qid AND n.faiss_id = r.faiss_id)),
cand AS (SELECT *, (level IN ('별표','서식') AND EXISTS (SELECT 1 FROM targets t WHERE t.qid = a.qid AND t.ref = a.annex_no)) AS is_target
  FROM (SELECT * FROM found UNION ALL BY NAME SELECT * FROM ann) a),
prio AS (SELECT *, (CASE WHEN exact THEN 3 WHEN matches >= 1 AND active THEN 1 ELSE 0 END + CASE WHEN is_target THEN 3 ELSE 0 END + CASE WHEN stage = 2 THEN 1 ELSE 0 END) AS priority FROM cand),
placed AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY priority DESC, distance, stage, faiss_id) AS rk FROM prio),
marked AS (SELECT *, coalesce(bool_or(is_target AND rk <= 5) OVER (PARTITION BY qid), false) AS has, min(CASE WHEN is_target AND rk > 5 THEN rk END) OVER (PARTITION BY qid) AS best FROM placed),
kept AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY rk) AS rank FROM marked WHERE rk < 5 OR (CASE WHEN NOT has AND best IS NOT NULL THEN rk = best ELSE rk = 5 END))"""
_TOP = 5


def _found(spark, d, questions=None):
    asked = _questions(spark) if questions is None else questions
    return search.candidates(_index(spark, d, asked), asked, _TOP)


@query(f"WITH {_CAND} SELECT qid, faiss_id::INT AS faiss_id, stage FROM cand")
def candidate_union(spark, d, questions=None):
    return _found(spark, d, questions).select("qid", "faiss_id", "stage")


@query(f"WITH {_CAND} SELECT qid, faiss_id::INT AS faiss_id FROM found WHERE seed_rank <= 10")
def seed_select(spark, d, questions=None):
    return _found(spark, d, questions).where((F.col("stage") < 2) & (F.col("seed_rank") <= max(10, 2 * _TOP))).select("qid", "faiss_id")


@query(f"WITH {_CAND} SELECT qid, faiss_id::INT AS faiss_id FROM cand WHERE is_target")
def ref_semi_join(spark, d, questions=None):
    return _found(spark, d, questions).where("is_target").select("qid", "faiss_id")


@query(f"WITH {_CAND} SELECT qid, faiss_id::INT AS faiss_id FROM inj")
def anti_inject(spark, d, questions=None):
    return _found(spark, d, questions).where("stage = 1").select("qid", "faiss_id")


@query(f"WITH {_CAND} SELECT qid, faiss_id::INT AS faiss_id, priority::INT AS priority, rk::INT AS rk FROM placed")
def priority_rerank(spark, d, questions=None):
    return search.ranked(_found(spark, d, questions)).select("qid", "faiss_id", "priority", "rk")


@query(f"WITH {_CAND} SELECT qid, rank::INT AS rank, faiss_id::INT AS faiss_id FROM kept")
def topk_guarantee(spark, d, questions=None):
    return search.with_guarantee(search.ranked(_found(spark, d, questions)), _TOP).select("qid", "rank", "faiss_id")


@query(
    f"""WITH {_CAND} SELECT qid, rank::INT AS rank, faiss_id::INT AS faiss_id, round(distance, 6) AS distance, level, annex_no, jo, hang, hang_norm, mok, mok_norm, title, text, path, display_path_norm FROM kept"""
)
def hybrid_search(spark, d, questions=None):
    asked = _questions(spark) if questions is None else questions
    index = _index(spark, d, asked)
    best = search.best_answers(index, asked, _TOP).withColumn("distance", F.round("distance", 6))
    return _told(spark, d, best, index, "qid", "rank", *search.HIT)


@query(
    f"""WITH {_CAND}, near2 AS (SELECT *, dist AS distance FROM raw WHERE raw_rank <= 100),
    hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY faiss_id) AS n FROM raw WHERE (nullif(c_jo, '') IS NOT NULL OR c_hang IS NOT NULL OR c_mok IS NOT NULL)
      AND (nullif(c_jo, '') IS NULL OR coalesce(jo = c_jo, false) OR coalesce(jo_norm = c_jo, false) OR contains(shown, '제' || c_jo || '조'))
      AND (c_hang IS NULL OR coalesce(hang_norm = c_hang, false) OR contains(shown, '제' || c_hang || '항'))
      AND (c_mok IS NULL OR coalesce(mok_norm = c_mok, false) OR contains(shown, '제' || c_mok || '호'))) WHERE n <= 200),
    both2 AS (SELECT * FROM near2 UNION ALL BY NAME SELECT * EXCLUDE n, 'inf'::DOUBLE AS distance FROM hits h WHERE NOT EXISTS (SELECT 1 FROM near2 n WHERE n.qid = h.qid AND n.faiss_id = h.faiss_id)),
    scored AS (SELECT *, (CASE WHEN nullif(c_jo, '') IS NOT NULL AND (coalesce(jo = c_jo, false) OR coalesce(jo_norm = c_jo, false) OR contains(shown, '제' || c_jo || '조')) THEN 2 ELSE 0 END
      + coalesce(hang_norm = c_hang, false)::INT + coalesce(mok_norm = c_mok, false)::INT) AS score FROM both2)
    SELECT * FROM (SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY score DESC, distance, faiss_id)::INT AS rank, faiss_id::INT AS faiss_id, score::INT AS score, coalesce(display_path_norm, path) AS shown,
      CASE WHEN length(replace(coalesce(text, ''), chr(10), ' ')) > 160 THEN left(replace(coalesce(text, ''), chr(10), ' '), 160) || '...' ELSE replace(coalesce(text, ''), chr(10), ' ') END AS snippet FROM scored) WHERE rank <= 5"""
)
def rerank_v2(spark, d, questions=None):
    asked = _questions(spark) if questions is None else questions
    index = _index(spark, d, asked, "path", "display_path_norm")
    best = search.reranked_by_parts(index, asked, _TOP)
    return _told(spark, d, best, index, "qid", "rank", "faiss_id", "score", "shown", X.snippet(F.col("text")).alias("snippet"))


# ------------------------------- the same, asked by every twentieth unit of all laws

_STATED = _ASKED[: _ASKED.index(", cited AS (")]
_EVERY = "asked AS (SELECT unit_id AS qid, mst, coalesce(path, title, '') AS query, effective_date AS as_of FROM units WHERE unit_id % 20 = 0)"


def _every_20th(spark, d):
    """Questions of every unit whose id is divisible by 20: its law, path and date."""
    return table(spark, d, "units").where("unit_id % 20 = 0").select(
        F.col("unit_id").alias("qid"), "mst", F.coalesce("path", "title", F.lit("")).alias("query"), F.col("effective_date").alias("as_of")
    )


def _register_every20(function):
    """Register ``NAME_every20``: the query NAME over the questions of all laws."""
    name = f"{function.__name__}_every20"
    QUERIES[name] = lambda spark, d: function(spark, d, _every_20th(spark, d))
    SQL[name] = SQL[function.__name__].replace(_STATED, _EVERY)


for _search in (
    as_of_filter, meta_match_all, meta_match_lenient, meta_match_strict, meta_match_count, candidate_union, seed_select, ref_semi_join,
    anti_inject, priority_rerank, topk_guarantee, hybrid_search, rerank_v2,
):
    _register_every20(_search)


# ------------------------------------------------------------------ export

_TITLED = """titled AS (SELECT u.*, coalesce(n.name, u.mst) AS law_title FROM units u LEFT JOIN (
  SELECT mst, arg_min(law_name, law_row_id) AS name FROM laws WHERE nullif(regexp_replace(law_name, '\\s+', '', 'g'), '') IS NOT NULL GROUP BY mst) n USING (mst))"""
_NUM = f"coalesce(nullif({_human('annex_no')}, ''), nullif(annex_no, ''), '')"
_T = f"coalesce({_strip('title')}, '')"
_HEAD = f"""regexp_replace(CASE {_strip('level')} WHEN '조' THEN '## ' || CASE WHEN nullif(jo, '') IS NOT NULL THEN '제' || jo || '조 ' ELSE '' END || {_T}
  WHEN '항' THEN '### 제' || coalesce(hang, '') || '항 ' || {_T} WHEN '목' THEN '#### ' || CASE WHEN nullif(mok, '') IS NOT NULL THEN mok || '. ' ELSE '' END || {_T}
  WHEN '별표' THEN '## 별표 ' || {_NUM} || ' ' || {_T} WHEN '서식' THEN '## 서식 ' || {_NUM} || ' ' || {_T} WHEN '부칙' THEN '## 부칙 ' || {_T} ELSE '## ' || {_T} END, '[\\s\\x{{0b}}]+$', '')"""
_LINKS = """nullif(concat_ws(' / ', '[상세](' || nullif(links.detail, '') || ')', '[HTML](' || nullif(links.html, '') || ')', '[PDF](' || nullif(links.pdf, '') || ')'), '')"""
_META = f"""nullif(concat_ws(' / ', '법령명: ' || nullif(law_title, ''), 'MST: ' || nullif(mst, ''),
  CASE WHEN level IN ('별표','서식') AND nullif(annex_no, '') IS NOT NULL THEN '번호: ' || annex_no || ' (사람표기: ' || coalesce({_human('annex_no')}, '') || ')' END, '링크: ' || {_LINKS}), '')"""
_RENDER = f"""{_TITLED}, lines AS (SELECT unit_id, generate_subscripts(l, 1) AS pos, unnest(l) AS raw FROM (SELECT unit_id, string_split_regex(coalesce({_strip('text')}, ''), '{_BREAK}') AS l FROM units)),
trows AS (SELECT unit_id, pos, {_strip('raw')} AS line FROM lines WHERE starts_with({_strip('raw')}, '|') AND ends_with({_strip('raw')}, '|')),
truns AS (SELECT unit_id, pos, line, pos - row_number() OVER (PARTITION BY unit_id ORDER BY pos) AS run FROM trows),
tkept AS (SELECT *, row_number() OVER (PARTITION BY unit_id, run ORDER BY pos) AS nth FROM truns),
teach AS (SELECT unit_id, run, string_agg(line, ' ' ORDER BY pos) AS s FROM tkept WHERE nth <= 2 GROUP BY unit_id, run),
tables AS (SELECT unit_id, string_agg('- 표요약: ' || s, chr(10) || chr(10) ORDER BY run) AS t FROM teach GROUP BY unit_id),
rendered AS (SELECT mst, law_title, unit_id, level, annex_no, regexp_replace(concat_ws(chr(10) || chr(10), {_HEAD}, '> ' || {_META}, tables.t, nullif({_strip('text')}, '')), '[\\s\\x{{0b}}]+$', '') || chr(10) AS md
  FROM titled LEFT JOIN tables USING (unit_id))"""


def _rendered(spark, d):
    return export.rendered(export.titled(spread(_units(spark, d), "unit_id"), table(spark, d, "laws")))


@query(f"WITH {_RENDER} SELECT unit_id, md FROM rendered")
def unit_markdown(spark, d):
    return _rendered(spark, d).select("unit_id", "md")


@query(
    f"""WITH {_RENDER} SELECT mst, 0::BIGINT AS pos, '# ' || max(law_title) || chr(10) || chr(10) || '_MST: ' || mst || '_' || chr(10) || chr(10) AS md FROM rendered GROUP BY mst
    UNION ALL SELECT mst, unit_id, md || chr(10) FROM rendered"""
)
def md_export(spark, d):
    """The parts of each law's document in order."""
    return export.law_lines(_rendered(spark, d))


@query(
    f"""WITH {_RENDER} SELECT file_name, max(unit_id) AS unit_id FROM (SELECT unit_id, {_strip(r"regexp_replace(law_title || '_별표_' || coalesce(nullif(" + _human('annex_no') + r", ''), nullif(annex_no, ''), 'unknown') || '.md', '[/:*?" + '"' + r"<>|]+', '_', 'g')")} AS file_name
    FROM rendered WHERE level IN ('별표','서식')) GROUP BY file_name"""
)
def md_per_annex(spark, d):
    return export.annex_files(_rendered(spark, d)).select("file_name", "unit_id")


@query()
def md_shard(spark, d):
    """Shards of each law's Markdown of at most 20,000 characters."""
    rows = _rendered(spark, d)
    shards = export.greedy_shards(rows.select("mst", "unit_id", F.length("md").alias("size")), "mst", "unit_id", "size", 20_000)
    return export.shard_names(export.shard_markdown(rows.join(shards, ["mst", "unit_id"]))).select("file_name", "mst", "shard", F.length("md").alias("size"))


@query(
    """WITH RECURSIVE sized AS (SELECT source, doc_id, coalesce(length(text), 0) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
    walk(source, doc_id, i, used, shard) AS (SELECT source, doc_id, i, n, 1 FROM sized WHERE i = 1 UNION ALL
      SELECT s.source, s.doc_id, s.i, CASE WHEN w.used + s.n > 5000 THEN s.n ELSE w.used + s.n END, CASE WHEN w.used + s.n > 5000 THEN w.shard + 1 ELSE w.shard END
      FROM walk w JOIN sized s ON s.source = w.source AND s.i = w.i + 1)
    SELECT source, doc_id, shard::INT AS shard FROM walk"""
)
def greedy_shard(spark, d):
    sizes = table(spark, d, "documents").where("source is not null").select("source", "doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n"))
    return export.greedy_shards(sizes, "source", "doc_id", "n", 5_000)


# ------------------------------------------------------- lookups and merges


@query(
    """SELECT law_name, mst, law_row_id FROM (SELECT *, row_number() OVER (PARTITION BY law_name ORDER BY coalesce(effective_date, '') DESC, coalesce(promulgation_date, '') DESC, law_row_id) AS nth
      FROM laws WHERE law_name IS NOT NULL) WHERE nth = 1"""
)
def latest_by(spark, d):
    laws = table(spark, d, "laws").where("law_name is not null")
    return lookup.latest_by(laws, "law_name", [F.col("effective_date"), F.col("promulgation_date")], "law_row_id").select("law_name", "mst", "law_row_id")


@query(
    """SELECT l.law_name, count(u.unit_id) AS units FROM (SELECT law_name, mst FROM (SELECT *, row_number() OVER (PARTITION BY law_name ORDER BY coalesce(effective_date, '') DESC, coalesce(promulgation_date, '') DESC, law_row_id) AS nth
      FROM laws WHERE law_name IS NOT NULL) WHERE nth = 1) l JOIN units u USING (mst) GROUP BY l.law_name"""
)
def latest_then_join(spark, d):
    return _units(spark, d).select("mst", "unit_id").join(latest_by(spark, d).select("law_name", "mst"), "mst").groupBy("law_name").agg(F.count("unit_id").alias("units"))


@query(
    """WITH best AS (SELECT mst, arg_max({'t': law_title, 'u': units, 'b': build_ts}, {'b': build_ts, 'u': units, 't': law_title}) AS x FROM manifest GROUP BY mst),
    old AS (SELECT mst, x.t AS law_title, x.u AS units, x.b AS build_ts FROM best), new AS (SELECT mst, max(law_title) AS law_title, count(*)::INT AS units, '2026-01-01T00:00:00' AS build_ts
      FROM (SELECT u.mst, n.law_name AS law_title FROM units u LEFT JOIN (SELECT mst, arg_min(law_name, law_row_id) AS law_name FROM laws WHERE nullif(trim(law_name), '') IS NOT NULL GROUP BY mst) n USING (mst)) GROUP BY mst)
    SELECT coalesce(n.mst, o.mst) AS mst, CASE WHEN n.mst IS NOT NULL THEN n.law_title ELSE o.law_title END AS law_title, CASE WHEN n.mst IS NOT NULL THEN n.units ELSE o.units END AS units,
      CASE WHEN n.mst IS NOT NULL THEN n.build_ts ELSE o.build_ts END AS build_ts FROM old o FULL JOIN new n ON o.mst = n.mst"""
)
def manifest_upsert(spark, d):
    """The latest recorded builds, with the units at hand merged in as a new build."""
    names = first_non_null(spark, d)
    new = (
        _units(spark, d)
        .groupBy("mst")
        .agg(F.count(F.lit(1)).cast("int").alias("units"))
        .join(names, "mst", "left")
        .select("mst", F.col("law_name").alias("law_title"), "units", F.lit("2026-01-01T00:00:00").alias("build_ts"))
    )
    return lookup.merged_by_key(lookup.latest_manifest(table(spark, d, "manifest")), new, "mst")


@query(
    """WITH t AS (SELECT mst, unit_id, 0 AS tier FROM units WHERE level = '별표' AND nullif(links.pdf, '') IS NOT NULL UNION ALL SELECT mst, unit_id, 1 FROM units WHERE level = '서식'
      UNION ALL SELECT mst, unit_id, 2 FROM units WHERE level = '부칙' UNION ALL SELECT mst, unit_id, 3 FROM units WHERE level = '조')
    SELECT mst, unit_id, tier FROM t WHERE tier = (SELECT min(tier) FROM t x WHERE x.mst = t.mst)"""
)
def cascade_first_nonempty(spark, d):
    rows = _units(spark, d).select("mst", "unit_id", "level", "links")
    tiers = [
        rows.where((F.col("level") == "별표") & X.filled(F.col("links.pdf")).isNotNull()),
        rows.where("level = '서식'"),
        rows.where("level = '부칙'"),
        rows.where("level = '조'"),
    ]
    return lookup.first_nonempty([t.select("mst", "unit_id") for t in tiers], "mst")


@query(
    """WITH p AS (SELECT user_id, event_id, event_type = 'error' AS e, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page FROM events),
    f AS (SELECT * FROM p WHERE page <= 80), b AS (SELECT *, sum(CASE WHEN e THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS block FROM f),
    s AS (SELECT *, sum(e::INT) OVER (PARTITION BY user_id, block ORDER BY event_id) AS streak FROM b),
    c AS (SELECT *, min(CASE WHEN streak >= 2 THEN page END) OVER (PARTITION BY user_id) AS stop FROM s)
    SELECT user_id, event_id, page::INT AS page FROM c WHERE stop IS NULL OR page <= stop"""
)
def empty_streak_cut(spark, d):
    rows = lookup.cut_at_empty_run(table(spark, d, "events"), "user_id", "event_id", F.col("event_type") == "error", run=2)
    return rows.select("user_id", "event_id", "page")


@query(
    """SELECT mst, jo, string_agg(hang, '' ORDER BY unit_id) AS marks FROM units WHERE level = '항' AND hang IS NOT NULL GROUP BY mst, jo"""
)
def user_turn_concat(spark, d):
    """Ordered concatenation of a short text of each row of a group."""
    rows = _units(spark, d).where("level = '항' and hang is not null")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("unit_id", "hang"))), lambda x: x["hang"])
    return rows.groupBy("mst", "jo").agg(F.array_join(ordered, "").alias("marks"))


@query(
    """SELECT src, ord, unit_id FROM (SELECT 0 AS src, unit_id AS ord, unit_id FROM units WHERE level IN ('조','항','목') UNION ALL SELECT 1, unit_id, unit_id FROM units WHERE level = '부칙'
      UNION ALL SELECT 2, unit_id, unit_id FROM units WHERE level IN ('별표','서식'))"""
)
def union_units(spark, d):
    rows = _units(spark, d).select("unit_id", "level")
    parts = [rows.where(F.col("level").isin(*levels)).select(F.lit(k).alias("src"), F.col("unit_id").alias("ord"), "unit_id") for k, levels in enumerate((U.BODY, ("부칙",), U.ANNEX))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_PLAIN = r"CASE WHEN regexp_full_match({0}, '\d+') THEN try_cast(coalesce(nullif(ltrim({0}, '0'), ''), '0') AS INT) END"
_ATTACH = f"""WITH newest AS (SELECT law_name, mst FROM (SELECT *, row_number() OVER (PARTITION BY law_name ORDER BY coalesce(effective_date, '') DESC, coalesce(promulgation_date, '') DESC, law_row_id) AS nth
  FROM laws WHERE law_name IS NOT NULL) WHERE nth = 1),
asked AS (SELECT DISTINCT law_name, n AS attachment_number FROM newest, (VALUES (1), (2), (3)) t(n)),
named AS (SELECT a.*, n.mst FROM asked a LEFT JOIN newest n USING (law_name)),
doc AS (SELECT n.law_name, n.attachment_number, u.links.pdf AS pdf, 'document' AS source, 0 AS tier, u.unit_id AS ord FROM named n JOIN units u USING (mst)
  WHERE u.level = '별표' AND {_PLAIN.format('u.annex_no')} = n.attachment_number AND nullif(u.links.pdf, '') IS NOT NULL),
lst AS (SELECT a.law_name, a.attachment_number, f.pdf, 'annex_list' AS source, 1 AS tier, f.ord FROM asked a JOIN (
  SELECT feed_row_id AS ord, payload->>'관련법령명' AS listed_name, payload->>'별표번호' AS annex_no, payload->>'별표서식PDF파일링크' AS pdf FROM annex_feed) f
  ON contains(f.listed_name, a.law_name) AND {_PLAIN.format('f.annex_no')} = a.attachment_number WHERE nullif(f.pdf, '') IS NOT NULL),
won AS (SELECT law_name, attachment_number, pdf, source FROM (SELECT *, row_number() OVER (PARTITION BY law_name, attachment_number ORDER BY tier, ord) AS nth FROM (SELECT * FROM doc UNION ALL SELECT * FROM lst)) WHERE nth = 1),
result AS (SELECT n.law_name, n.attachment_number, w.pdf IS NOT NULL AS ok, CASE WHEN starts_with(w.pdf, '/') THEN '{BASE}' || w.pdf ELSE w.pdf END AS pdf_url, n.mst, w.source,
  CASE WHEN w.pdf IS NULL AND n.mst IS NOT NULL THEN '{BASE}/law?mst=' || n.mst END AS detail_page,
  CASE WHEN w.pdf IS NOT NULL THEN NULL WHEN n.mst IS NOT NULL THEN 'no link found; see the law''s page' ELSE 'no law of this name' END AS message FROM named n LEFT JOIN won w USING (law_name, attachment_number))"""


def _attached(spark, d):
    laws = table(spark, d, "laws").where("law_name is not null")
    asked = laws.select("law_name").distinct().select("law_name", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("attachment_number"))
    annexes = _units(spark, d).where("level = '별표'").select("mst", "annex_no", F.col("links.pdf").alias("pdf"), F.col("unit_id").alias("ord"))
    feed = table(spark, d, "annex_feed")
    field = lambda name: F.get_json_object("payload", f"$.{name}")
    listed = feed.select(field("관련법령명").alias("law_name"), field("별표번호").alias("annex_no"), field("별표서식PDF파일링크").alias("pdf"), F.col("feed_row_id").alias("ord"))
    return lookup.attachments(asked, laws, annexes, listed, BASE)


@query(f"{_ATTACH} SELECT * FROM result")
def attachment_lookup(spark, d):
    return _attached(spark, d)


@query(
    f"""{_ATTACH} SELECT law_name, attachment_number, CASE WHEN ok THEN '별표 ' || attachment_number || ' PDF 링크: ' || pdf_url
      ELSE coalesce(message, '링크를 찾지 못했습니다.') || CASE WHEN detail_page IS NOT NULL THEN ' 상세 페이지: ' || detail_page ELSE '' END END AS reply FROM result"""
)
def reply_format(spark, d):
    return lookup.reply(_attached(spark, d))
