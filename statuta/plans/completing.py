"""Queries of annex lists by law, answers without an index, ordered builds and further name forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statuta.functions import text as X
from statuta.operators import lookup
from statuta.operators import units as U
from statuta.plans import statutes
from statuta.plans.statutes import _BASE, _group, _questions
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


# ------------------------------------------------------- annex lists

_REL = "nullif(regexp_replace(trim(coalesce(nullif(payload->>'관련법령일련번호', ''), nullif(payload->>'법령일련번호', ''), nullif(payload->>'MST', ''))), '\\s+', ' ', 'g'), '')"
_OF = "nullif(trim(coalesce(nullif(payload->>'관련법령명', ''), nullif(payload->>'법령명', ''))), '')"
_NAMED = "nullif(trim(coalesce(nullif(payload->>'별표명', ''), nullif(payload->>'서식명', ''), nullif(payload->>'항목명', ''), nullif(payload->>'명칭', ''), nullif(payload->>'제목', ''))), '')"
_LISTED = "SELECT mst, min(trim(law_name)) AS law_name FROM laws WHERE nullif(trim(mst), '') IS NOT NULL GROUP BY mst"


def _feed(spark: SparkSession, d: str) -> DataFrame:
    """feed_row_id, rel, of, named: what a record says about its law, and its annex's name."""

    def either(*names: str):  # noqa: ANN202
        return F.nullif(F.trim(F.coalesce(*(X.filled(F.get_json_object("payload", f"$.{n}")) for n in names))), F.lit(""))

    return table(spark, d, "annex_feed").select(
        "feed_row_id",
        X.filled(X.squash(either("관련법령일련번호", "법령일련번호", "MST"))).alias("rel"),
        either("관련법령명", "법령명").alias("of"),
        either("별표명", "서식명", "항목명", "명칭", "제목").alias("named"),
    )


@query(
    f"""WITH f AS (SELECT feed_row_id, {_REL} AS rel, {_OF} AS of, {_NAMED} AS named FROM annex_feed WHERE json_valid(payload)), l AS ({_LISTED}),
    hits AS (SELECT mst, feed_row_id, rel, 0 AS tier FROM l JOIN f ON f.of = l.law_name UNION ALL SELECT mst, feed_row_id, rel, 1 FROM l JOIN f ON contains(f.named, l.law_name) AND l.law_name <> ''
      UNION ALL SELECT mst, feed_row_id, rel, 2 FROM l JOIN f ON f.rel = l.mst),
    first AS (SELECT *, min(tier) OVER (PARTITION BY mst) AS least FROM hits)
    SELECT mst, feed_row_id, tier FROM first WHERE tier = least AND (rel IS NULL OR rel = mst)"""
)
def annex_cascade(spark, d):
    """The listed annexes of each law: by the law's name, else by its name inside the
    annex's, else by its number; those that name another law are left out."""
    feed = _feed(spark, d)
    laws = table(spark, d, "laws").where(F.nullif(F.trim("mst"), F.lit("")).isNotNull()).groupBy("mst").agg(F.min(F.trim("law_name")).alias("law_name"))
    by_name = laws.join(feed, F.col("of") == F.col("law_name")).select("mst", "feed_row_id", "rel")
    inside = lookup.containing(feed.select(F.col("named").alias("listed_name")), laws.where("law_name <> ''").select("law_name"))
    by_part = (
        feed.join(inside, F.col("named") == F.col("listed_name")).join(laws, "law_name").select("mst", "feed_row_id", "rel")
    )
    by_number = laws.join(feed, F.col("rel") == F.col("mst")).select("mst", "feed_row_id", "rel")
    found = lookup.first_nonempty([by_name, by_part, by_number], "mst")
    return found.where(U.annex_of_law(F.col("rel"), F.col("mst"))).select("mst", "feed_row_id", "tier")


# --------------------------------------------------- answers without an index


@query(
    f"""WITH {_BASE} SELECT qid, rank::INT AS rank, faiss_id::INT AS faiss_id FROM (SELECT qid, faiss_id, row_number() OVER (PARTITION BY qid ORDER BY faiss_id) AS rank FROM base
      WHERE (nullif(c_jo, '') IS NOT NULL OR c_hang IS NOT NULL OR c_mok IS NOT NULL)
      AND (nullif(c_jo, '') IS NULL OR coalesce(jo = c_jo, false) OR coalesce(jo_norm = c_jo, false) OR contains(shown, '제' || c_jo || '조'))
      AND (c_hang IS NULL OR coalesce(hang_norm = c_hang, false) OR contains(shown, '제' || c_hang || '항'))
      AND (c_mok IS NULL OR coalesce(mok_norm = c_mok, false) OR contains(shown, '제' || c_mok || '호'))) WHERE rank <= 10"""
)
def meta_fallback(spark, d, questions=None):
    """The first ten units of each question that bear its citation, where no vectors are at hand."""
    asked = (_questions(spark) if questions is None else questions).withColumn("c", X.citation(X.strip(F.col("query"))))
    cite = [F.col("c.jo"), F.col("c.hang"), F.col("c.mok")]
    given = X.filled(F.col("c.jo")).isNotNull() | F.col("c.hang").isNotNull() | F.col("c.mok").isNotNull()
    rows = statutes._ids(spark, d, asked).join(F.broadcast(asked), "mst").where(given & U.matches_leniently(*cite))
    place = F.row_number().over(Window.partitionBy("qid").orderBy("faiss_id"))
    return rows.select("qid", "faiss_id", place.alias("rank")).where("rank <= 10")


# ------------------------------------------- ordered builds, stamps and names


@query(statutes.SQL["manifest_upsert"] + " ORDER BY mst")
def manifest_ordered(spark, d):
    """The merged builds in order of their law numbers (laid out by ranges, then sorted)."""
    return statutes.QUERIES["manifest_upsert"](spark, d).orderBy("mst")


@query("SELECT doc_id, strftime(ingested_at, '%Y-%m-%dT%H:%M:%S') AS stamp FROM documents")
def iso_stamp(spark, d):
    """Times in ISO form to the second, as builds are stamped."""
    return table(spark, d, "documents").select("doc_id", X.iso_time(F.col("ingested_at")).alias("stamp"))


@query(
    "SELECT unit_id, CASE WHEN ends_with(base, '_' || mst) THEN nullif(left(base, length(base) - length(mst) - 1), '') END AS law_title FROM (SELECT unit_id, mst, coalesce(title, '') || '_' || CASE WHEN unit_id % 2 = 0 THEN mst ELSE 'x' END AS base FROM units)"
)
def title_from_base(spark, d):
    """The law's title out of a base name like ``title_mst``; null for other names."""
    base = F.concat_ws("_", F.coalesce("title", F.lit("")), F.when(F.col("unit_id") % 2 == 0, F.col("mst")).otherwise(F.lit("x")))
    return table(spark, d, "units").select("unit_id", X.title_of_base(base, F.col("mst")).alias("law_title"))


_JO1 = _group("trim(coalesce(jo, ''))", r"(\d+)(?:\s*의\s*(\d+))?", 1)
_JO2 = _group("trim(coalesce(jo, ''))", r"(\d+)(?:\s*의\s*(\d+))?", 2)
_TX1 = _group("trim(coalesce(text, ''))", r"제\s*(\d+)\s*조\s*(?:의\s*(\d+))?", 1)
_TX2 = _group("trim(coalesce(text, ''))", r"제\s*(\d+)\s*조\s*(?:의\s*(\d+))?", 2)


@query(
    f"SELECT unit_id, CASE WHEN {_JO1} IS NOT NULL THEN {_JO1} || coalesce('의' || {_JO2}, '') ELSE {_TX1} || coalesce('의' || {_TX2}, '') END AS article FROM units"
)
def article_or_text(spark, d):
    """A unit's article: its own number, else the first one its text names."""
    return table(spark, d, "units").select("unit_id", X.article_with_fallback(F.col("jo"), F.col("text")).alias("article"))


@query(rf"""SELECT unit_id, regexp_replace(coalesce(title, ''), '[\\/*?:{chr(34)}<>|]', '', 'g') AS name FROM units""")
def bare_filename(spark, d):
    """Titles as file names, with what file systems refuse left out."""
    return table(spark, d, "units").select("unit_id", X.bare_filename(F.coalesce("title", F.lit(""))).alias("name"))
