"""Lookups with fallbacks: latest laws, attachments, ingest stages, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuta.functions import text as X


def latest_by(rows: DataFrame, key: str, order: list[Column], tie: str) -> DataFrame:
    """The row of each key with the greatest ``order``; of equals the least ``tie``.

    Missing parts of the order count as ''.
    """
    rank = F.struct(*(F.coalesce(c, F.lit("")).alias(f"o{k}") for k, c in enumerate(order)), (-F.col(tie)).alias("t"))
    best = rows.groupBy(key).agg(F.max_by(tie, rank).alias(tie))
    return rows.join(best.select(tie), tie, "left_semi")


def merged_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keyed upsert: a row of ``new`` replaces the one of ``old``."""
    fields = [c for c in old.columns if c != key]
    o, n = old.alias("o"), new.alias("n")
    here = F.col(f"n.{key}").isNotNull()
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(
        F.coalesce(f"n.{key}", f"o.{key}").alias(key), *(F.when(here, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in fields)
    )


def latest_manifest(manifest: DataFrame) -> DataFrame:
    """The newest build of each law, of equal times the one with most units."""
    rank = F.struct("build_ts", "units", "law_title")
    best = manifest.groupBy("mst").agg(F.max(rank).alias("b"))
    return best.select("mst", F.col("b.law_title").alias("law_title"), F.col("b.units").alias("units"), F.col("b.build_ts").alias("build_ts"))


def first_nonempty(tiers: list[DataFrame], key: str) -> DataFrame:
    """For each key the rows of the first tier that has any, with ``tier`` from 0."""
    rows = None
    for k, tier in enumerate(tiers):
        one = tier.withColumn("tier", F.lit(k))
        rows = one if rows is None else rows.unionByName(one)
    least = rows.groupBy(key).agg(F.min("tier").alias("least"))
    same = F.col("r." + key).eqNullSafe(F.col("l." + key)) & (F.col("r.tier") == F.col("l.least"))
    return rows.alias("r").join(least.alias("l"), same, "left_semi")


def cut_at_empty_run(
    pages: DataFrame, key: str, order: str, empty: Column, run: int = 5, most: int = 80, failed: Column | None = None
) -> DataFrame:
    """Rows of each key up to and with the ``run``-th empty one in a row.

    Only the first ``most`` rows of a key are looked at, as a pager would.  A
    ``failed`` page gives no row and neither ends nor lengthens a run of empty ones.
    """
    by = Window.partitionBy(key).orderBy(order)
    rows = pages.withColumn("page", F.row_number().over(by)).where(F.col("page") <= most)
    if failed is not None:
        rows = rows.where(~F.coalesce(failed, F.lit(False)))
    rows = rows.withColumn("is_empty", empty.cast("int"))
    rows = rows.withColumn("block", F.sum(F.when(F.col("is_empty") == 0, 1).otherwise(0)).over(by))
    streak = F.sum("is_empty").over(Window.partitionBy(key, "block").orderBy(order))
    rows = rows.withColumn("streak", streak)
    stop = F.min(F.when(F.col("streak") >= run, F.col("page"))).over(Window.partitionBy(key))
    return rows.withColumn("stop", stop).where(F.col("stop").isNull() | (F.col("page") <= F.col("stop"))).drop("block", "stop")


def containing(texts: DataFrame, names: DataFrame) -> DataFrame:
    """listed_name, law_name: which distinct texts contain which names.

    Every part of a distinct text is looked up among the names, so this is an
    equi-join whose size follows the texts' lengths, and not texts times names.
    """
    name = F.col("listed_name")
    ends = lambda start: F.sequence(start, F.length(name))
    parts = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.length(name)),
            lambda start: F.transform(ends(start), lambda end: F.substring(name, start, end - start + 1)),
        )
    )
    split = texts.where(X.filled(name).isNotNull()).distinct().select("listed_name", F.explode(F.array_distinct(parts)).alias("law_name"))
    return split.join(names.select("law_name").distinct(), "law_name").select("listed_name", "law_name")


def attachments(questions: DataFrame, laws: DataFrame, annexes: DataFrame, listed: DataFrame, base: str) -> DataFrame:
    """Links of asked attachments, by the first source that has one.

    ``questions`` (law_name, attachment_number); ``laws`` (law_name, mst,
    effective_date, promulgation_date, law_row_id); ``annexes`` (mst, annex_no,
    pdf, ord) of the documents; ``listed`` (law_name, annex_no, pdf, ord) of the
    annex lists, where the name need only be contained.
    """
    asked = questions.select("law_name", "attachment_number").distinct()
    newest = latest_by(laws, "law_name", [F.col("effective_date"), F.col("promulgation_date")], "law_row_id").select("law_name", "mst")
    named = asked.join(newest, "law_name", "left")
    in_document = (
        named.join(annexes, "mst")
        .where((X.plain_number(F.col("annex_no")) == F.col("attachment_number")) & X.filled(F.col("pdf")).isNotNull())
        .select("law_name", "attachment_number", "pdf", F.lit("document").alias("source"), F.lit(0).alias("tier"), "ord")
    )
    in_lists = (
        listed.withColumnRenamed("law_name", "listed_name")
        .join(containing(listed.select(F.col("law_name").alias("listed_name")), asked), "listed_name")
        .withColumn("number", X.plain_number(F.col("annex_no")))
        .join(asked.withColumnRenamed("attachment_number", "number"), ["law_name", "number"])
        .where(X.filled(F.col("pdf")).isNotNull())
        .select("law_name", F.col("number").alias("attachment_number"), "pdf", F.lit("annex_list").alias("source"), F.lit(1).alias("tier"), "ord")
    )
    won = (
        in_document.unionByName(in_lists)
        .groupBy("law_name", "attachment_number")
        .agg(F.min(F.struct("tier", "ord", "pdf", "source")).alias("w"))
        .select("law_name", "attachment_number", F.col("w.pdf").alias("pdf"), F.col("w.source").alias("source"))
    )
    url = F.when(F.startswith("pdf", F.lit("/")), F.concat(F.lit(base), F.col("pdf"))).otherwise(F.col("pdf"))
    found = named.join(won, ["law_name", "attachment_number"], "left")
    return found.select(
        "law_name",
        "attachment_number",
        F.col("pdf").isNotNull().alias("ok"),
        url.alias("pdf_url"),
        "mst",
        "source",
        F.when(F.col("pdf").isNull() & F.col("mst").isNotNull(), F.concat(F.lit(f"{base}/law?mst="), F.col("mst"))).alias("detail_page"),
        F.when(F.col("pdf").isNotNull(), F.lit(None).cast("string"))
        .when(F.col("mst").isNotNull(), "no link found; see the law's page")
        .otherwise("no law of this name")
        .alias("message"),
    )


def reply(result: DataFrame) -> DataFrame:
    """law_name, attachment_number, reply: the answer in words."""
    page = F.when(F.col("detail_page").isNotNull(), F.concat(F.lit(" 상세 페이지: "), F.col("detail_page"))).otherwise("")
    good = F.concat(F.lit("별표 "), F.col("attachment_number").cast("string"), F.lit(" PDF 링크: "), F.col("pdf_url"))
    bad = F.concat(F.coalesce("message", F.lit("링크를 찾지 못했습니다.")), page)
    return result.select("law_name", "attachment_number", F.when(F.col("ok"), good).otherwise(bad).alias("reply"))
