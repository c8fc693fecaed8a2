"""Queries of unit building, pages, files and responses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions import html as H
from statuta.functions import text as X
from statuta.operators import annexbody, documents, textsearch
from statuta.operators import units as U
from statuta.plans.statutes import _BREAK, _S, BASE, QUESTIONS, _no_labels, _squash, _strip
from statuta.sources import files, service
from statuta.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def register(function):  # noqa: ANN001
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


# --------------------------------------------------- documents


@query()
def extract_units(spark, d):
    """Articles, paragraphs and items of all raw documents, in document order."""
    return documents.build_units(table(spark, d, "raw_laws")).where("src = 0")


@query()
def extract_addenda(spark, d):
    return documents.build_units(table(spark, d, "raw_laws")).where("src = 1")


@query()
def strip_headings(spark, d):
    """How many units a law has with and without the headings of its parts."""
    raw = table(spark, d, "raw_laws")
    kept = documents.build_units(raw).groupBy("raw_id").agg(F.count(F.lit(1)).alias("stripped"))
    full = documents.build_units(raw, strip_headings=False).groupBy("raw_id").agg(F.count(F.lit(1)).alias("all_units"))
    return full.join(kept, "raw_id", "left").na.fill(0, ["stripped"])


@query()
def built_units(spark, d):
    """The whole build: flattened, normalised, deduplicated and numbered."""
    built = documents.build_units(table(spark, d, "raw_laws"))
    keyed = built.withColumns({"unit_id": F.struct("raw_id", "ord"), "annex_no": F.lit(None).cast("string")})
    numbered = U.with_dense_ids(U.deduplicated(U.normalised(keyed)))
    return numbered.select("mst", "faiss_id", "level", "jo_norm", "hang_norm", "mok_norm", "display_path_norm", "title", "text")


_LAW = """laws1 AS (SELECT raw_id, CASE WHEN payload IS NULL OR NOT json_valid(payload) OR json_type(payload) <> 'OBJECT' THEN NULL
    WHEN json_type(payload, '$."법령"') IS NULL THEN payload::JSON WHEN json_type(payload, '$."법령"') = 'ARRAY' THEN json_extract(payload, '$."법령"[0]') ELSE json_extract(payload, '$."법령"') END AS law FROM raw_laws),
  laws2 AS (SELECT raw_id, CASE WHEN json_type(law) = 'OBJECT' THEN json_extract(law, '$."조문"') END AS a FROM laws1),
  laws3 AS (SELECT raw_id, CASE WHEN json_type(a) = 'OBJECT' AND json_type(a, '$."조문"') IS NOT NULL THEN json_extract(a, '$."조문"') ELSE a END AS a FROM laws2),
  items AS (SELECT raw_id, CASE WHEN a IS NULL OR json_type(a) = 'NULL' THEN [] WHEN json_type(a) = 'ARRAY' THEN json_extract(a, '$[*]') ELSE [a] END AS l FROM laws3)"""


@query(f"WITH {_LAW} SELECT raw_id, len(l)::INT AS items FROM items")
def normalize_root(spark, d):
    """How many entries the articles' list of each document has once it is one."""

    @F.pandas_udf("int")
    def run(payloads):  # noqa: ANN001
        return payloads.map(lambda p: len(documents.root(documents._load(p))["조문"]))

    run.__annotations__ = {}
    return table(spark, d, "raw_laws").select("raw_id", run(F.coalesce("payload", F.lit(""))).alias("items"))


@query(
    f"""WITH {_LAW} SELECT raw_id, coalesce(list_sum(list_transform(l, lambda x: CASE WHEN json_type(x) = 'OBJECT' AND json_type(x, '$."조문단위"') IS NOT NULL
      THEN CASE json_type(x, '$."조문단위"') WHEN 'ARRAY' THEN json_array_length(x, '$."조문단위"')::INT WHEN 'NULL' THEN 0 ELSE 1 END ELSE 1 END)), 0)::INT AS articles FROM items"""
)
def flatten_articles(spark, d):
    """How many articles each document has, whatever they are wrapped in."""

    @F.pandas_udf("int")
    def run(payloads):  # noqa: ANN001
        return payloads.map(lambda p: len(documents.articles(documents.root(documents._load(p)))))

    run.__annotations__ = {}
    return table(spark, d, "raw_laws").select("raw_id", run(F.coalesce("payload", F.lit(""))).alias("articles"))


@query(
    """SELECT raw_id, count(*)::INT AS objects FROM raw_laws, json_tree(CASE WHEN json_valid(payload) THEN payload::JSON END) t
    WHERE t.type = 'OBJECT' AND (json_type(t.value, '$."별표번호"') IS NOT NULL OR json_type(t.value, '$."별표서식PDF파일링크"') IS NOT NULL) GROUP BY raw_id"""
)
def deep_collect(spark, d):
    """Objects with an annex number or a link, at any depth of each document."""

    @F.pandas_udf("int")
    def run(payloads):  # noqa: ANN001
        return payloads.map(lambda p: len(documents.deep_objects(documents._load(p), "별표번호", "별표서식PDF파일링크")))

    run.__annotations__ = {}
    return table(spark, d, "raw_laws").select("raw_id", run(F.coalesce("payload", F.lit(""))).alias("objects")).where("objects > 0")


@query(
    """SELECT a.mst, a.jo, a.unit_id AS article_id, d.unit_id AS detail_id FROM (SELECT mst, jo, min(unit_id) AS unit_id FROM units WHERE level = '조' AND jo IS NOT NULL GROUP BY mst, jo) a
    JOIN (SELECT mst, jo, unit_id FROM units WHERE level IN ('항', '목')) d ON a.mst = d.mst AND a.jo = d.jo
    UNION ALL SELECT mst, jo, min(unit_id), min(unit_id) FROM units WHERE level = '조' AND jo IS NOT NULL GROUP BY mst, jo"""
)
def detail_merge(spark, d):
    """Articles with the parts that their details add, by law and article."""
    rows = table(spark, d, "units").select("mst", "jo", "level", "unit_id")
    heads = rows.where("level = '조' and jo is not null").groupBy("mst", "jo").agg(F.min("unit_id").alias("article_id"))
    parts = rows.where("level in ('항', '목')").select("mst", "jo", F.col("unit_id").alias("detail_id"))
    return heads.join(parts, ["mst", "jo"]).unionByName(heads.withColumn("detail_id", F.col("article_id")))


@query()
def deep_name(spark, d):
    return documents.names_of(table(spark, d, "raw_laws"))


@query()
def ingest_cascade(spark, d):
    """Units of each law by the first source that has any: documents, listed units, addenda."""
    built = documents.build_units(table(spark, d, "raw_laws")).select("mst", "level", "path", "text")
    listed = table(spark, d, "units").select("mst", "level", "path", "text")
    return documents.ingest(built.where("level <> '부칙'"), listed.where("level <> '부칙'"), listed.where("level = '부칙'"))


@query(
    f"""SELECT feed_row_id, CASE WHEN nullif(payload->>'서식명', '') IS NOT NULL THEN '서식' ELSE '별표' END AS level,
      coalesce(nullif({_squash("coalesce(nullif(payload->>'별표명', ''), nullif(payload->>'서식명', ''), nullif(payload->>'항목명', ''), nullif(payload->>'명칭', ''), nullif(payload->>'제목', ''))")}, ''), '별표/서식') AS title,
      CASE WHEN starts_with(h, 'http') THEN h ELSE '{BASE}' || h END AS html
    FROM (SELECT *, coalesce(nullif(payload->>'별표서식파일링크', ''), nullif(payload->>'별표본문링크', ''), nullif(payload->>'서식파일링크', ''), nullif(payload->>'파일링크', ''), nullif(payload->>'본문링크', '')) AS h FROM annex_feed)"""
)
def annex_units(spark, d):
    """Annex units of the records of annex lists, whichever names their fields have."""
    names = (
        "별표명 서식명 항목명 명칭 제목 별표번호 번호 관련법령일련번호 법령일련번호 MST 별표서식파일링크 별표본문링크 서식파일링크 파일링크 본문링크 "
        "별표서식PDF파일링크 PDF파일링크 서식PDF링크 별표법령상세링크 상세링크 법령상세링크"
    ).split()
    pairs = [x for n in names for x in (F.lit(n), F.get_json_object("payload", f"$.{n}"))]
    feed = table(spark, d, "annex_feed").select("feed_row_id", F.create_map(*pairs).alias("record"))
    unit = U.annex_from_feed(F.col("record"), BASE)
    return feed.select("feed_row_id", unit["level"].alias("level"), unit["title"].alias("title"), unit["html"].alias("html"))


# -------------------------------------------------------- pages


def _escaped(column):
    return F.replace(F.replace(column, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _pages(spark, d) -> tuple[DataFrame, DataFrame]:
    """Annexes of the units, and a page for each of their three links: the
    detail page frames the title, the other two hold the text."""
    rows = table(spark, d, "units").where(F.col("level").isin(*U.ANNEX)).select(
        F.col("unit_id").alias("id"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("text", F.lit("")).alias("text")
    )
    url = lambda kind: F.concat(F.lit(f"{BASE}/{kind}/"), F.col("id").cast("string"))
    annexes = rows.select("id", "title", url("detail").alias("detail"), url("html").alias("html"), url("pdf").alias("pdf"))
    frame = F.concat(F.lit("<html><body><iframe src='/inner/"), F.col("id").cast("string"), F.lit("'></iframe></body></html>"))
    body = lambda c: F.concat(F.lit("<html><head><style>p{}</style></head><body><p>"), _escaped(c), F.lit("</p></body></html>"))
    pages = [
        rows.select(url("detail").alias("url"), F.lit("html").alias("kind"), frame.alias("body")),
        rows.select(url("inner").alias("url"), F.lit("html").alias("kind"), body(F.col("title")).alias("body")),
        rows.select(url("html").alias("url"), F.lit("html").alias("kind"), body(F.col("text")).alias("body")),
        rows.select(url("pdf").alias("url"), F.lit("pdf").alias("kind"), F.col("text").alias("body")),
    ]
    whole = pages[0]
    for page in pages[1:]:
        whole = whole.unionByName(page)
    return annexes, whole


def _clean(x: str) -> str:
    return _strip(f"array_to_string(list_transform(string_split_regex({x}, '{_BREAK}'), lambda s: regexp_replace(s, '{_S}+$', '')), chr(10))")


_BODY = f"""WITH b AS (SELECT unit_id AS id, title AS own, {_clean(_strip("coalesce(title, '')"))} AS t, {_clean(_strip("coalesce(text, '')"))} AS h, {_clean("coalesce(text, '')")} AS p FROM units WHERE level IN ('별표','서식')),
picked AS (SELECT id, own, CASE WHEN length({_squash(_no_labels('t'))}) >= 100 THEN t WHEN length({_squash(_no_labels('h'))}) >= 100 THEN h WHEN p <> '' THEN p END AS md,
  CASE WHEN length({_squash(_no_labels('t'))}) >= 100 THEN 'detail' WHEN length({_squash(_no_labels('h'))}) >= 100 THEN 'html' WHEN p <> '' THEN 'pdf' END AS extracted_from FROM b)"""


@query(f"{_BODY} SELECT id, md5(md) AS digest, extracted_from FROM picked WHERE md IS NOT NULL")
def annex_body_pick(spark, d):
    annexes, pages = _pages(spark, d)
    return annexbody.pick_bodies(annexes, pages).select("id", F.md5("md").alias("digest"), "extracted_from")


@query(f"{_BODY} SELECT id, md5(coalesce(nullif(md, ''), own, '')) AS digest, extracted_from FROM picked")
def annex_enrich(spark, d):
    """Annexes whose text, at first the title, is their body where one was found."""
    annexes, pages = _pages(spark, d)
    bodies = annexbody.pick_bodies(annexes, pages)
    whole = annexbody.enriched(annexes.select("id", F.col("title").alias("text")), bodies)
    return whole.select("id", F.md5("text").alias("digest"), "extracted_from")


@query(f"SELECT unit_id AS id, '{BASE}/inner/' || unit_id AS frame FROM units WHERE level IN ('별표','서식')")
def iframe_hop(spark, d):
    """The page inside the frame of each detail page."""
    annexes, pages = _pages(spark, d)
    framed = pages.select("url", H.page_struct(F.when(F.col("kind") == "html", F.col("body")), F.col("url")).alias("p")).where("p.frame is not null")
    return annexes.join(framed, F.col("detail") == F.col("url")).select("id", F.col("p.frame").alias("frame"))


@query(
    f"""SELECT unit_id AS id, CASE WHEN unit_id % 3 = 0 THEN '{BASE}/a/flDownload.do?n=' || unit_id || ',' || '{BASE}/c.pdf' ELSE '{BASE}/c.pdf' END AS links
    FROM units WHERE level IN ('별표','서식')"""
)
def url_candidates(spark, d):
    """Content links of pages: anchors to files first, then embedded documents."""
    rows = table(spark, d, "units").where(F.col("level").isin(*U.ANNEX)).select(F.col("unit_id").alias("id"))
    anchor = F.when(F.col("id") % 3 == 0, F.concat(F.lit("<a href='/a/flDownload.do?n="), F.col("id").cast("string"), F.lit("'>x</a>"))).otherwise("<a href='/other'>y</a>")
    page = F.concat(F.lit("<div><embed src='/c.pdf'/>"), anchor, anchor, F.lit("<a href='#'>z</a></div>"))
    found = rows.select("id", H.page_struct(page, F.lit(BASE)).alias("p"))
    return found.select("id", F.array_join("p.links", ",").alias("links"))


@query()
def html_to_md(spark, d):
    """Pages with a table each as Markdown and as headers and rows."""
    rows = table(spark, d, "units").where(F.col("level").isin(*U.ANNEX)).select("unit_id", "title", "annex_no")
    page = F.concat(
        F.lit("<h1>"), _escaped(F.coalesce("title", F.lit(""))), F.lit("</h1><table><tr><th>번호</th><th>내용</th></tr><tr><td>"),
        _escaped(F.coalesce("annex_no", F.lit("-"))), F.lit("</td><td><b>가</b> 나</td></tr></table>"),
    )
    read = rows.select("unit_id", H.page_struct(page, F.lit(BASE)).alias("p"))
    return read.select("unit_id", "p.md", F.to_json("p.tables").alias("tables"))


# -------------------------------------------- responses and files


@query(
    r"""SELECT raw_id, CASE WHEN raw_id % 4 <> 0 AND json_valid(payload) THEN 'json' WHEN raw_id % 4 <> 0 THEN 'bad_json'
      WHEN NOT regexp_matches(p, '\S') THEN 'empty' WHEN regexp_matches(p, '^\s*<') THEN 'markup' ELSE 'unexpected' END AS kind
    FROM (SELECT raw_id, payload, CASE WHEN raw_id % 8 = 0 THEN '<html>' || payload ELSE coalesce(payload, '') END AS p FROM raw_laws)"""
)
def response_classify(spark, d):
    """What kind of response each payload would be, with mixed content types."""
    rows = table(spark, d, "raw_laws").select(
        "raw_id",
        F.when(F.col("raw_id") % 4 == 0, "text/html").otherwise("application/json; charset=utf-8").alias("ct"),
        F.when(F.col("raw_id") % 8 == 0, F.concat(F.lit("<html>"), "payload")).otherwise(F.col("payload")).alias("body"),
    )
    return rows.select("raw_id", service.classified(F.col("ct"), F.col("body")).alias("kind"))


@query(
    f"""SELECT doc_id, array_to_string(list_filter(list_transform(string_split(lang, ','), lambda x: {_strip('x')}), lambda x: x <> ''), '|') AS members FROM documents WHERE lang IS NOT NULL"""
)
def csv_list_parse(spark, d):
    rows = table(spark, d, "documents").where("lang is not null")
    return rows.select("doc_id", F.array_join(files.csv_list(F.col("lang")), "|").alias("members"))


_LINES_FIXTURE = ["# comment", "", "MSTS=1,2", "NAME = 'a b'", 'KEY="x=y"', "no pair", "EMPTY=", "MSTS=9", "HALF='open"]


@query(
    """SELECT * FROM (VALUES ('MSTS', '1,2'), ('NAME ', ' ''a b'''), ('KEY', 'x=y'), ('EMPTY', ''), ('MSTS', '9'), ('HALF', '''open')) v(key, value)"""
)
def kv_parse(spark, d):
    return files.key_values(spark.createDataFrame([(x,) for x in _LINES_FIXTURE], "value string"))


@query(
    """SELECT * FROM (VALUES (0, '# comment'), (1, ''), (2, 'MSTS=7,8'), (3, 'NAME = ''a b'''), (4, 'KEY="x=y"'), (5, 'no pair'), (6, 'EMPTY='), (7, 'MSTS=9'), (8, 'HALF=''open')) v(pos, value)"""
)
def line_upsert(spark, d):
    lines = spark.createDataFrame(list(enumerate(_LINES_FIXTURE)), "pos int, value string")
    return files.upsert_line(lines, "MSTS", "7,8")


@query(
    r"""SELECT law_row_id, CASE WHEN law_row_id % 3 = 0 THEN n || '_' || mst ELSE n || '_' || mst || '_other' END AS base, CASE WHEN law_row_id % 3 = 0 THEN mst END AS mst
    FROM (SELECT law_row_id, mst, coalesce(nullif(regexp_replace(law_name, '\s', '', 'g'), ''), 'x') AS n FROM laws)"""
)
def filename_parse(spark, d):
    n = F.coalesce(X.filled(F.regexp_replace("law_name", r"\s", "")), F.lit("x"))
    tail = F.when(F.col("law_row_id") % 3 == 0, "_units.json").otherwise("_other.json")
    path = F.concat(F.lit("file:///data/"), n, F.lit("_"), F.col("mst"), tail)
    name = files.unit_file_name(path)
    return table(spark, d, "laws").select("law_row_id", name["base"].alias("base"), name["mst"].alias("mst"))


# ------------------------------------------------------------- term search

_ASK = ", ".join(f"({i}, '{q}')" for i, _, q, _ in QUESTIONS)


@query(
    rf"""WITH words AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(coalesce(text, '')), '[^0-9A-Za-z가-힣]+'), lambda w: w <> '')) AS term FROM documents),
    terms AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL), n AS (SELECT count(*) AS n FROM documents),
    idf AS (SELECT term, ln((1.0 + n) / (1.0 + count(*))) + 1.0 AS idf FROM terms, n GROUP BY term, n),
    w AS (SELECT doc_id, term, tf * idf AS w FROM terms JOIN idf USING (term)), norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id),
    q0 AS (SELECT qid, unnest(list_filter(string_split_regex(lower(query), '[^0-9A-Za-z가-힣]+'), lambda w: w <> '')) AS term FROM (VALUES {_ASK}) v(qid, query)),
    q AS (SELECT qid, term, tf * idf AS qw FROM (SELECT qid, term, count(*) AS tf FROM q0 GROUP BY ALL) JOIN idf USING (term)), qn AS (SELECT qid, sqrt(sum(qw * qw)) AS q_norm FROM q GROUP BY qid),
    s AS (SELECT qid, doc_id, round(sum(w * qw) / max(norm) / max(q_norm), 6) AS score FROM w JOIN q USING (term) JOIN norms USING (doc_id) JOIN qn USING (qid) GROUP BY qid, doc_id)
    SELECT qid, doc_id, score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 10"""
)
def tfidf_search(spark, d):
    asked = spark.createDataFrame([(i, q) for i, _, q, _ in QUESTIONS], "qid int, query string")
    return textsearch.tfidf_search(table(spark, d, "documents"), asked, 10)


@query(
    SQL["tfidf_search"].replace(
        f"(VALUES {_ASK}) v(qid, query)", "(SELECT doc_id AS qid, coalesce(nullif(trim(title), ''), text) AS query FROM documents WHERE doc_id % 20 = 0)"
    )
)
def tfidf_search_every20(spark, d):
    """The same, asked by every twentieth document: its title, or its text if it has none."""
    asked = table(spark, d, "documents").where("doc_id % 20 = 0").select(
        F.col("doc_id").alias("qid"), F.coalesce(X.filled(F.trim("title")), F.col("text")).alias("query")
    )
    return textsearch.tfidf_search(table(spark, d, "documents"), asked, 10)
