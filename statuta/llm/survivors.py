"""One surviving record for each group of units that describe the same annex.

Units are grouped by law, level and annex number however written; a unit
without a usable number joins the annex whose title it bears.  For every field
the surviving value is the usable one of the most trusted source, then the
latest, then of the smallest unit id.  That rule is given with the data, so it
decides the survivor; the latent two-sided quality model decides what the rule
leaves open: how probable each claimed value is, and which further values of
the multi-valued fields (the links) are kept.

The model: a fact is a distinct value of a field in a group.  A source that
states it makes a positive claim, a source that states only other values of
the field makes a negative one.  Expectation-maximisation alternates between
each fact's probability and each source's sensitivity and specificity per
field, on counts of equal claim patterns, so an iteration's cost follows the
number of patterns and not of units.

Defined results: groups of one unit have no survivor rows; a field without a
usable value has no row; a null law number (``mst``) is a law of its own; where
a title belongs to several numbers, the smallest (as text) is taken; unit ids
given twice give the same winner.  Null sources and sources without a trust
value rank lowest.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.session import durable

FIELDS = ("annex_no", "title", "html", "pdf", "detail")
LEVELS = ("별표", "서식")

# What stands in a field for a missing value (compared in lower
# case, without white space).
STAND_INS = ("", "-", "–", "—", "none", "null", "n/a", "nan", "undefined", "별표/서식")
LINK_STAND_INS = ("#", "/", "//", "http://", "https://", "about:blank")

# Full-width forms and their plain ones.
_WIDE = "０１２３４５６７８９（）［］＜＞〈〉【】〔〕－／＿．\u3000"
_PLAIN = "0123456789()[]<><>[][]-/_. "

_BLANKS = r"(?U)[\s\x1c-\x1f" + "\N{ZERO WIDTH SPACE}\N{ZERO WIDTH NO-BREAK SPACE}]+"

#: Iterations of the quality model at most, and the change at which it ends.
ROUNDS, SETTLED = 12, 1e-3
#: Pseudo-counts (true, false) of the priors of sensitivity, specificity, truth.
PRIORS = {"sensitivity": (6.0, 4.0), "specificity": (8.0, 2.0), "truth": (2.0, 2.0)}
#: A value counts as true from this probability on.
TRUE_FROM = 0.5


def _plain(column: Column) -> Column:
    return F.translate(column, _WIDE, _PLAIN)


def _usable(column: Column) -> Column:
    return column.isNotNull() & ~F.lower(F.regexp_replace(_plain(column), _BLANKS, "")).isin(*STAND_INS)


def number_key(column: Column) -> Column:
    """One spelling of an annex number (``4``, ``4의2``); null if not usable.

    Six digits are four for the number and two for its branch.
    """
    bare = F.regexp_replace(F.regexp_replace(_plain(column), _BLANKS, ""), r"[\[\]<>().]|별표|별지|서식|제|호", "")
    packed, parts = r"^(\d{4})(\d{2})$", r"^(\d+)(?:[의\-_/](\d+))?$"
    head = F.when(bare.rlike(packed), F.regexp_extract(bare, packed, 1)).otherwise(F.regexp_extract(bare, parts, 1))
    tail = F.when(bare.rlike(packed), F.regexp_extract(bare, packed, 2)).otherwise(F.regexp_extract(bare, parts, 2))
    head, tail = F.regexp_replace(head, "^0+", ""), F.regexp_replace(tail, "^0+", "")
    other = F.when(bare.rlike(r"[0-9A-Za-z가-힣]") & ~bare.rlike(parts), bare)
    return F.when(
        _usable(column),
        F.coalesce(F.when(head != "", F.when(tail != "", F.concat(head, F.lit("의"), tail)).otherwise(head)), other),
    )


def title_key(column: Column) -> Column:
    """A title without its annex number, its article note and white space; null if not usable."""
    body = _plain(column)
    body = F.regexp_replace(body, r"(?U)^\s*[\[<(]\s*(?:별표|별지|서식)[^\]>)]*[\]>)]", "")
    body = F.regexp_replace(body, r"(?U)\([^()]*관련\s*\)\s*$", "")
    body = F.lower(F.regexp_replace(body, _BLANKS, ""))
    return F.when(_usable(column) & (body != ""), body)


def link_key(column: Column) -> Column:
    """A link without scheme and host; null if not usable."""
    bare = F.regexp_replace(column, _BLANKS, "")
    good = _usable(column) & ~F.lower(bare).isin(*LINK_STAND_INS) & ~F.lower(bare).rlike("^(?:#|javascript:|about:)")
    return F.when(good, F.regexp_replace(bare, r"^(?i:https?:)?//[^/]+", ""))


def annex_claims(units: DataFrame, trust: DataFrame) -> DataFrame:
    """Annex units with their group (mst, level, annex), trust and, for each
    field, the value and its key (null where not usable)."""
    rows = (
        units.where(F.col("level").isin(*LEVELS))
        .select("unit_id", "mst", "level", "annex_no", "title", "links.html", "links.pdf", "links.detail", "source_name", "collected_at")
        .join(trust.groupBy("source_name").agg(F.max("trust").alias("trust")), "source_name", "left")
        .select(
            "*",
            number_key(F.col("annex_no")).alias("annex_no_key"),
            title_key(F.col("title")).alias("title_key"),
            *(link_key(F.col(x)).alias(f"{x}_key") for x in ("html", "pdf", "detail")),
        )
        # a title that is only a number in brackets is a value, but names no annex
        .withColumn("title_value", F.coalesce("title_key", F.when(_usable(F.col("title")), F.trim("title"))))
    )
    numbered = rows.where("annex_no_key is not null")
    titled = numbered.where("title_key is not null").groupBy("mst", "level", "title_key").agg(F.min("annex_no_key").alias("via"))
    bare = rows.where("annex_no_key is null").alias("b")
    found = bare.join(
        titled.alias("t"),
        F.col("b.mst").eqNullSafe(F.col("t.mst")) & (F.col("b.level") == F.col("t.level")) & (F.col("b.title_key") == F.col("t.title_key")),
        "left",
    ).select(
        "b.*",
        F.coalesce(
            F.col("t.via"),
            F.concat(F.lit("title:"), F.col("b.title_key")),
            F.concat(F.lit("unit:"), F.col("b.unit_id").cast("string")),
        ).alias("annex"),
    )
    # the annexes are a small part of the units and read many times from here on
    return durable(numbered.withColumn("annex", F.col("annex_no_key")).unionByName(found))


_KEY = ("mst", "level", "annex")


def _key_of(field: str) -> str:
    return "title_value" if field == "title" else f"{field}_key"


def _survivors(claims: DataFrame) -> DataFrame:
    """mst, level, annex, group_id, field, unit_id, value, fact of each survivor."""

    def best(field: str) -> Column:
        order = F.struct(
            F.coalesce("trust", F.lit(-(2**31))).alias("t"),
            F.col("collected_at").alias("c"),
            (-F.col("unit_id")).alias("u"),
            F.col(field).alias("value"),
            F.col(_key_of(field)).alias("fact"),
        )
        return F.max(F.when(F.col(_key_of(field)).isNotNull(), order)).alias(field)

    groups = claims.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("n"), F.min("unit_id").alias("group_id"), *(best(f) for f in FIELDS)
    )
    won = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("won")) for f in FIELDS)))
    return (
        groups.where("n > 1")
        .select(*_KEY, "group_id", won.alias("x"))
        .where("x.won is not null")
        .select(*_KEY, "group_id", "x.field", (-F.col("x.won.u")).alias("unit_id"), "x.won.value", "x.won.fact")
    )


def _facts(claims: DataFrame) -> DataFrame:
    """mst, level, annex, field, fact, value, pos, neg: who states each value, who another one."""
    source = F.coalesce("source_name", F.lit("?"))
    stated = (
        claims.select(
            *_KEY,
            source.alias("source"),
            F.explode(
                F.array(*(F.struct(F.lit(f).alias("field"), F.col(_key_of(f)).alias("fact"), F.col(f).alias("value")) for f in FIELDS))
            ).alias("x"),
        )
        .where("x.fact is not null")
        .select(*_KEY, "source", "x.*")
    )
    facts = stated.groupBy(*_KEY, "field", "fact").agg(
        F.array_sort(F.collect_set("source")).alias("pos"), F.min("value").alias("value")
    )
    covered = stated.groupBy(*_KEY, "field").agg(F.collect_set("source").alias("all"))
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"c.{k}")) for k in (*_KEY, "field")]
    return facts.alias("f").join(covered.alias("c"), same).select(
        "f.*", F.array_sort(F.array_except("all", "pos")).alias("neg")
    )


def quality_model(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(patterns with their posterior, quality of each source).

    Patterns: field, pos, neg, n, posterior.  Quality: field, source,
    sensitivity, specificity.  What reaches the driver is one row for each
    field and source.
    """
    spark = facts.sparkSession
    patterns = durable(facts.groupBy("field", "pos", "neg").agg(F.count(F.lit(1)).alias("n")))
    quality: dict[tuple[str, str], tuple[float, float]] = {}
    truth: dict[str, float] = {}
    start = {k: a / (a + b) for k, (a, b) in PRIORS.items()}

    def posterior() -> Column:
        import math

        rows = [(f, s, *q) for (f, s), q in quality.items()]
        logs = {
            f"{f}\x00{s}": (math.log(se / (1 - sp)), math.log((1 - se) / sp)) for f, s, se, sp in rows
        }
        first = (math.log(start["sensitivity"] / (1 - start["specificity"])), math.log((1 - start["sensitivity"]) / start["specificity"]))

        def weights(k: int) -> Column:
            if not logs:
                return F.create_map().cast("map<string,double>")
            return F.create_map(*(F.lit(x) for name, w in logs.items() for x in (name, float(w[k]))))

        def total(side: str, k: int) -> Column:
            table = weights(k)
            return F.aggregate(
                side,
                F.lit(0.0),
                lambda acc, s: acc + F.coalesce(F.try_element_at(table, F.concat(F.col("field"), F.lit("\x00"), s)), F.lit(first[k])),
            )

        prior = F.lit(math.log(start["truth"] / (1 - start["truth"])))
        for f, p in truth.items():
            prior = F.when(F.col("field") == f, F.lit(math.log(p / (1 - p)))).otherwise(prior)
        return 1 / (1 + F.exp(-(prior + total("pos", 0) + total("neg", 1))))

    for _ in range(ROUNDS):
        scored = patterns.withColumn("p", posterior())
        sides = F.concat(
            F.transform("pos", lambda s: F.struct(s.alias("source"), F.lit(True).alias("says"))),
            F.transform("neg", lambda s: F.struct(s.alias("source"), F.lit(False).alias("says"))),
            F.array(F.struct(F.lit(None).cast("string").alias("source"), F.lit(True).alias("says"))),
        )
        weight = F.col("n") * F.col("p")
        against = F.col("n") * (1 - F.col("p"))
        sums = (
            scored.select("field", weight.alias("w"), against.alias("v"), F.explode(sides).alias("x"))
            .groupBy("field", F.col("x.source").alias("source"))
            .agg(
                F.sum(F.when(F.col("x.says"), F.col("w")).otherwise(0.0)).alias("hit"),
                F.sum("w").alias("true"),
                F.sum(F.when(~F.col("x.says"), F.col("v")).otherwise(0.0)).alias("rejected"),
                F.sum("v").alias("false"),
            )
            .collect()
        )
        before = dict(quality)
        for r in sums:
            if r["source"] is None:
                a, b = PRIORS["truth"]
                truth[r["field"]] = (r["true"] + a) / (r["true"] + r["false"] + a + b)
                continue
            (a, b), (c, d) = PRIORS["sensitivity"], PRIORS["specificity"]
            quality[r["field"], r["source"]] = (
                (r["hit"] + a) / (r["true"] + a + b),
                (r["rejected"] + c) / (r["false"] + c + d),
            )
        if before and max(abs(x - y) for k in quality for x, y in zip(quality[k], before.get(k, (0, 0)))) < SETTLED:
            break
    rows = [(f, s, se, sp) for (f, s), (se, sp) in sorted(quality.items())]
    table = spark.createDataFrame(rows, "field string, source string, sensitivity double, specificity double")
    return patterns.withColumn("posterior", posterior()), table


def _with_posterior(facts: DataFrame) -> DataFrame:
    patterns, _ = quality_model(facts)
    return facts.join(patterns.drop("n"), ["field", "pos", "neg"])


def surviving_values(units: DataFrame, trust: DataFrame) -> DataFrame:
    """group_id, field, unit_id, value: the surviving value of every field of every
    annex with two or more units, by the rule given with the data."""
    return _survivors(annex_claims(units, trust)).select("group_id", "field", "unit_id", "value")


def model_against_rule(units: DataFrame, trust: DataFrame) -> DataFrame:
    """field, contested (surviving values with a rival), disagree: how often the
    model holds another value of the group to be more probable than the survivor."""
    claims = annex_claims(units, trust)
    facts = _with_posterior(_facts(claims)).select(*_KEY, "field", "fact", "posterior")
    won = _survivors(claims)
    same = [F.col(f"w.{k}").eqNullSafe(F.col(f"f.{k}")) for k in (*_KEY, "field")]
    pairs = won.alias("w").join(facts.alias("f"), same).select("w.group_id", "w.field", (F.col("w.fact") == F.col("f.fact")).alias("mine"), "f.posterior")
    each = pairs.groupBy("group_id", "field").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("mine"), F.col("posterior"))).alias("own"), F.max("posterior").alias("top")
    )
    return each.where("n > 1").groupBy("field").agg(
        F.count(F.lit(1)).alias("contested"), F.sum((F.col("top") > F.col("own") + 1e-9).cast("long")).alias("disagree")
    )


def best_representatives(units: DataFrame, trust: DataFrame) -> DataFrame:
    """group_id, field, unit_id, value, posterior: the surviving value of every
    field of every annex with two or more units, and how probable it is."""
    claims = annex_claims(units, trust)
    facts = _with_posterior(_facts(claims)).select(*_KEY, "field", "fact", "posterior")
    won = _survivors(claims)
    same = [F.col(f"w.{k}").eqNullSafe(F.col(f"f.{k}")) for k in (*_KEY, "field", "fact")]
    return won.alias("w").join(facts.alias("f"), same, "left").select(
        "w.group_id", "w.field", "w.unit_id", "w.value", F.round("f.posterior", 6).alias("posterior")
    )


def true_values(units: DataFrame, trust: DataFrame) -> DataFrame:
    """group_id, field, value, posterior: every value judged true of the
    multi-valued fields, in groups of two or more units."""
    claims = annex_claims(units, trust)
    facts = _with_posterior(_facts(claims)).where(F.col("field").isin("html", "pdf", "detail"))
    groups = claims.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("size"), F.min("unit_id").alias("group_id")).where("size > 1")
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"g.{k}")) for k in _KEY]
    return (
        facts.alias("f")
        .where(F.col("posterior") >= TRUE_FROM)
        .join(groups.alias("g"), same)
        .select("g.group_id", "f.field", "f.value", F.round("f.posterior", 6).alias("posterior"))
    )


def source_quality(units: DataFrame, trust: DataFrame) -> DataFrame:
    """field, source, sensitivity, specificity as the model infers them."""
    return quality_model(_facts(annex_claims(units, trust)))[1]
