"""The body of an annex from the pages its links lead to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.functions import html as H
from statuta.functions import text as X


def read_pages(pages: DataFrame) -> DataFrame:
    """url, md, cells, meaningful, links of fetched pages (url, kind, body).

    A page that is only a frame takes its frame's page; ``kind`` is ``html`` or
    ``pdf`` (whose body is the extracted text).
    """
    parsed = pages.select("url", "kind", "body", H.page_struct(F.when(F.col("kind") == "html", F.col("body")), F.col("url")).alias("p"))
    framed = (
        parsed.where("kind = 'html' and p.frame is not null")
        .select("url", F.col("p.frame").alias("frame"))
        .join(parsed.where("kind = 'html'").select(F.col("url").alias("frame"), F.col("p").alias("inner")), "frame")
        .select("url", "inner")
    )
    whole = parsed.join(framed, "url", "left").withColumn("p", F.coalesce("inner", "p"))
    cells = F.flatten(F.flatten(F.transform("p.tables", lambda t: t["rows"])))
    return whole.select(
        "url",
        "kind",
        F.when(F.col("kind") == "pdf", X.clean_lines(F.col("body"))).otherwise(F.col("p.md")).alias("md"),
        F.when(F.col("kind") == "pdf", X.filled(X.strip(F.col("body"))).isNotNull()).otherwise(X.is_meaningful(F.col("p.md"), cells)).alias("meaningful"),
        F.when(F.col("kind") == "html", F.col("p.links")).alias("links"),
    )


def pick_bodies(annexes: DataFrame, pages: DataFrame) -> DataFrame:
    """id, md, extracted_from: the first page with content of each annex.

    ``annexes`` (id, detail, html, pdf).  Sources are tried in that order; a page
    without content is followed by the (up to three) links it holds.
    """
    read = read_pages(pages)
    steps = F.array(*(F.struct(F.lit(k).alias("tier"), F.lit(n).alias("source"), F.col(n).alias("url")) for k, n in enumerate(("detail", "html", "pdf"))))
    tried = annexes.select("id", F.explode(steps).alias("s")).where("s.url is not null").select("id", "s.*")
    direct = tried.join(read, "url").where((F.col("source") == "pdf") | (F.col("kind") == "html") | (F.col("kind") == "pdf"))
    own = direct.where("meaningful").select("id", "tier", F.lit(0).alias("sub"), F.lit(0).alias("pos"), "md", "source")
    follow = (
        direct.where("not meaningful and kind = 'html' and links is not null")
        .select("id", "tier", "source", F.posexplode("links").alias("pos", "next"))
        .join(read.select(F.col("url").alias("next"), "md", "meaningful", F.col("kind").alias("next_kind")), "next")
        .where("meaningful")
        .select("id", "tier", F.lit(1).alias("sub"), "pos", "md", F.when(F.col("next_kind") == "pdf", "pdf").otherwise(F.col("source")).alias("source"))
    )
    best = own.unionByName(follow).groupBy("id").agg(F.min(F.struct("tier", "sub", "pos", "md", "source")).alias("b"))
    return best.select("id", F.col("b.md").alias("md"), F.col("b.source").alias("extracted_from"))


def enriched(annexes: DataFrame, bodies: DataFrame) -> DataFrame:
    """Annexes (id, text, ...) whose text is their body where one was found."""
    return annexes.join(bodies, "id", "left").withColumn("text", F.coalesce(X.filled(F.col("md")), F.col("text"))).drop("md")
