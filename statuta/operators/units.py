"""Normalising, deduplicating and projecting units of law."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuta.functions import text as X
from statuta.session import stored

#: Levels that lie in a law's body; the others are annexes, forms and addenda.
BODY = ("조", "항", "목")
ANNEX = ("별표", "서식")
#: Rows (some dozen bytes each) of laws' places that are broadcast at most.
FEW = 200_000


def normalised(units: DataFrame) -> DataFrame:
    """Units with hang_norm, mok_norm, jo_norm, jo_num, jo_suffix,
    display_path_norm, amended_on and annex_refs added."""
    body = F.col("level").isin(*BODY)
    art = X.article(X.strip(F.col("jo")), X.strip(F.col("path")), X.strip(F.col("title")), X.strip(F.col("text")))
    out = units.withColumns(
        {
            "hang_norm": X.paragraph_number(F.col("hang")),
            "mok_norm": X.item_number(F.col("mok")),
            "article": art,
        }
    )
    out = out.withColumns(
        {
            "jo_norm": F.col("article.norm"),
            "jo_num": F.col("article.num"),
            "jo_suffix": F.col("article.suffix"),
        }
    ).drop("article")
    named = F.coalesce("jo_norm", X.filled(X.strip(F.col("jo"))))
    other = F.coalesce(X.filled(F.col("path")), X.filled(F.col("title")), F.col("level"), F.lit(""))
    return out.withColumns(
        {
            "display_path_norm": F.when(body, X.display_path(named, F.col("hang_norm"), F.col("mok_norm"))).otherwise(other),
            "amended_on": X.amendment_dates(F.col("text")),
            "annex_refs": F.when(body, X.annex_references(F.col("text"))).otherwise(F.array().cast("array<string>")),
        }
    )


def stable_key() -> list[Column]:
    """What makes two units of a law the same."""
    return [
        F.coalesce("jo_norm", "jo").alias("k_jo"),
        F.coalesce("hang_norm", F.lit(0)).alias("k_hang"),
        F.coalesce("mok_norm", F.lit(0)).alias("k_mok"),
        F.coalesce(X.strip(F.col("title")), F.lit("")).alias("k_title"),
        X.fingerprint(F.col("text")).alias("k_text"),
    ]


def deduplicated(units: DataFrame, order: str = "unit_id") -> DataFrame:
    """The first unit of each stable key within a law.

    The survivor is found by an aggregate, which combines map-side, so a key or
    a law of any size is no bottleneck; then a semi-join keeps its row.
    """
    keys = [F.col("mst"), *stable_key()]
    first = units.groupBy(*keys).agg(F.min(order).alias(order)).select(order)
    return units.join(first, order, "left_semi")


def first_of_each(units: DataFrame, keys: list[str], order: str = "unit_id") -> DataFrame:
    """The first row of each key, in one pass; every task passes on one row a key at most."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return units.withColumn("_nth", place).where("_nth = 1").drop("_nth")


def with_dense_ids(units: DataFrame, order: str = "unit_id", name: str = "faiss_id") -> DataFrame:
    """Position of each unit in its law, from 0.

    Units are laid out by ranges of (law, order), so a law of any size spreads
    over many tasks; a unit's position is its place in its range plus the units
    of its law in earlier ranges.  The layout is written once, as both parts
    must see the same ranges.
    """
    placed = units.repartitionByRange("mst", order).sortWithinPartitions("mst", order)
    ranged = stored(placed.withColumns({"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}))
    sizes = ranged.groupBy("mst", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    before = Window.partitionBy("mst").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("mst", "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    starts = F.broadcast(starts) if sizes.count() <= FEW else starts
    same = F.col("r.mst").eqNullSafe(F.col("s.mst")) & (F.col("r._range") == F.col("s._range"))
    return ranged.alias("r").join(starts.alias("s"), same).select(
        *(F.col(f"r.{c}") for c in units.columns), (F.col("s._start") + F.col("r._place")).cast("int").alias(name)
    )


def answers(units: DataFrame) -> DataFrame:
    """id, level, jo, hang, mok, path, title and the text under its title."""
    body = X.strip(F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit(""))))
    return units.select("mst", "faiss_id", "level", "jo", "hang", "mok", "path", "title", body.alias("text"))


def id_map(units: DataFrame) -> DataFrame:
    return units.select("faiss_id", "mst", "level", "jo", "hang", "mok", "path", "title")


def annex_score() -> Column:
    """How much of an annex a unit gives: its links, its title, its kind."""
    has = lambda name, points: F.when(X.filled(F.col(f"links.{name}")).isNotNull(), points).otherwise(0)
    return (
        has("html", 4)
        + has("pdf", 2)
        + has("detail", 1)
        + F.least(F.lit(50), F.length(F.coalesce(X.strip(F.col("title")), F.lit(""))))
        + F.when(F.col("level") == "별표", 1).otherwise(0)
    )


def best_annexes(units: DataFrame, order: str = "unit_id") -> DataFrame:
    """The best unit of each annex number of a law; the first of equals.

    A unit without a number goes by its title.  ``first_seen`` keeps the order
    in which the numbers first appear.
    """
    key = F.coalesce(X.filled(X.annex_number(F.col("annex_no"))), F.col("title"), F.lit("")).alias("annex_key")
    rows = units.where(F.col("level").isin(*ANNEX)).select("*", key, annex_score().alias("score"))
    best = rows.groupBy("mst", "annex_key").agg(
        F.max_by(order, F.struct(F.col("score"), -F.col(order))).alias(order), F.min(order).alias("first_seen"), F.max("score").alias("score")
    )
    return best


def annex_from_feed(record: Column, base: str) -> dict[str, Column]:
    """Columns of an annex unit out of one record (a map of fields) of an annex list."""

    def either(*names: str) -> Column:
        return F.coalesce(*(X.filled(F.try_element_at(record, F.lit(n))) for n in names))

    form = either("서식명").isNotNull()
    level = F.when(form, "서식").otherwise("별표")
    number = X.annex_number(either("별표번호", "번호"))
    name = X.squash(either("별표명", "서식명", "항목명", "명칭", "제목"))
    rel = X.squash(either("관련법령일련번호", "법령일련번호", "MST"))
    return {
        "rel": rel,
        "level": level,
        "annex_no": number,
        "title": F.coalesce(X.filled(name), F.lit("별표/서식")),
        "path": F.concat_ws(" ", level, number),
        "html": X.absolute_url(either("별표서식파일링크", "별표본문링크", "서식파일링크", "파일링크", "본문링크"), base),
        "pdf": X.absolute_url(either("별표서식PDF파일링크", "PDF파일링크", "서식PDF링크"), base),
        "detail": X.absolute_url(either("별표법령상세링크", "상세링크", "법령상세링크"), base),
    }


def annex_of_law(rel: Column, mst: Column) -> Column:
    """Whether a listed annex belongs to the law asked about: it names that law, or none."""
    return X.filled(rel).isNull() | (rel == mst)


def active_as_of(cutoff: Column) -> Column:
    """Whether a unit holds at a date: true where either date is unknown."""
    until, since = X.as_of_date(cutoff), X.as_of_date(F.col("effective_date"))
    return until.isNull() | since.isNull() | (since <= until)


def match_count(jo: Column, hang: Column, mok: Column) -> Column:
    """How many of a citation's parts a unit bears, 0 to 3."""
    own = F.coalesce("jo_norm", X.strip(F.col("jo")))
    tests = (own == jo, F.col("hang_norm") == hang, F.col("mok_norm") == mok)
    return sum((F.coalesce(t, F.lit(False)).cast("int") for t in tests), F.lit(0))


def matches_all(jo: Column, hang: Column, mok: Column) -> Column:
    """Whether a unit bears every part that the citation has; false for none."""
    own = X.strip(F.coalesce(F.col("jo_norm"), F.col("jo"), F.lit("")))
    given = X.filled(jo).isNotNull() | (F.coalesce(hang, F.lit(0)) != 0) | (F.coalesce(mok, F.lit(0)) != 0)
    return (
        given
        & (X.filled(jo).isNull() | (own == jo))
        & (hang.isNull() | F.coalesce(F.col("hang_norm") == hang, F.lit(False)))
        & (mok.isNull() | F.coalesce(F.col("mok_norm") == mok, F.lit(False)))
    )


def matches_leniently(jo: Column, hang: Column, mok: Column) -> Column:
    """As ``matches_all``, but the shown path may bear the part instead."""
    path = F.coalesce(X.filled(F.col("display_path_norm")), F.col("path"), F.lit(""))

    def shown(value: Column, unit: str) -> Column:
        return F.contains(path, F.concat(F.lit("제"), value.cast("string"), F.lit(unit)))

    no = F.lit(False)
    return (
        (X.filled(jo).isNull() | F.coalesce(F.col("jo") == jo, no) | F.coalesce(F.col("jo_norm") == jo, no) | shown(jo, "조"))
        & (hang.isNull() | F.coalesce(F.col("hang_norm") == hang, no) | shown(hang, "항"))
        & (mok.isNull() | F.coalesce(F.col("mok_norm") == mok, no) | shown(mok, "호"))
    )
