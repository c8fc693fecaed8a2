"""Markdown of units, whole laws and size-bounded shards of laws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuta.functions import text as X
from statuta.operators.units import ANNEX

def heading() -> Column:
    """The heading line of a unit."""
    level, title = F.coalesce(X.strip(F.col("level")), F.lit("")), F.coalesce(X.strip(F.col("title")), F.lit(""))
    number = F.coalesce(X.filled(X.annex_number_human(F.col("annex_no"))), X.filled(F.col("annex_no")), F.lit(""))
    text = (
        F.when(level == "조", F.concat(F.lit("## "), F.when(X.filled(F.col("jo")).isNotNull(), F.concat(F.lit("제"), F.col("jo"), F.lit("조 "))).otherwise(""), title))
        .when(level == "항", F.concat(F.lit("### 제"), F.coalesce("hang", F.lit("")), F.lit("항 "), title))
        .when(level == "목", F.concat(F.lit("#### "), F.when(X.filled(F.col("mok")).isNotNull(), F.concat(F.col("mok"), F.lit(". "))).otherwise(""), title))
        .when(level.isin(*ANNEX), F.concat(F.lit("## "), level, F.lit(" "), number, F.lit(" "), title))
        .when(level == "부칙", F.concat(F.lit("## 부칙 "), title))
        .otherwise(F.concat(F.lit("## "), title))
    )
    return F.regexp_replace(text, r"\s+$", "")


def links_line() -> Column:
    named = [("detail", "상세"), ("html", "HTML"), ("pdf", "PDF")]
    parts = [
        F.when(X.filled(F.col(f"links.{k}")).isNotNull(), F.concat(F.lit(f"[{label}]("), F.col(f"links.{k}"), F.lit(")")))
        for k, label in named
    ]
    return F.concat_ws(" / ", *parts)


def meta_line(law_title: Column) -> Column:
    """Law, serial number, annex number and links on one line."""
    number = F.when(
        F.col("level").isin(*ANNEX) & X.filled(F.col("annex_no")).isNotNull(),
        F.concat(
            F.lit("번호: "), F.col("annex_no"), F.lit(" (사람표기: "),
            F.coalesce(X.annex_number_human(F.col("annex_no")), F.lit("")), F.lit(")"),
        ),
    )
    return F.concat_ws(
        " / ",
        F.concat(F.lit("법령명: "), X.filled(law_title)),
        F.concat(F.lit("MST: "), X.filled(F.col("mst"))),
        number,
        F.concat(F.lit("링크: "), X.filled(links_line())),
    )


def unit_markdown(law_title: Column) -> Column:
    """A unit's heading, meta line, table summaries and text, parted by blank lines."""
    body = F.coalesce(X.strip(F.col("text")), F.lit(""))
    tables = F.transform(F.filter(X.table_runs(body), lambda r: r != ""), lambda r: F.concat(F.lit("- 표요약: "), r))
    parts = F.concat(
        F.array(heading(), F.concat(F.lit("> "), X.filled(meta_line(law_title)))),
        tables,
        F.array(X.filled(body)),
    )
    joined = F.array_join(F.filter(parts, lambda p: p.isNotNull()), "\n\n")
    return F.concat(F.regexp_replace(joined, r"\s+$", ""), F.lit("\n"))


def titled(units: DataFrame, laws: DataFrame) -> DataFrame:
    """Units with law_title: the name first seen for their law, else its number."""
    names = laws.where(X.filled(X.strip(F.col("law_name"))).isNotNull()).groupBy("mst").agg(F.min_by("law_name", "law_row_id").alias("name"))
    return units.join(names, "mst", "left").withColumn("law_title", F.coalesce("name", "mst")).drop("name")


def rendered(units: DataFrame) -> DataFrame:
    """mst, law_title, unit_id, level, annex_no and md of each unit."""
    return units.select("mst", "law_title", "unit_id", "level", "annex_no", unit_markdown(F.col("law_title")).alias("md"))


def export_filter(min_text_len: int = 0, skip_deletion: bool = False, annex_only: bool = False) -> Column:
    """Which units are exported."""
    size = F.length(F.coalesce(X.strip(F.col("text")), F.lit("")))
    keep = F.lit(True)
    if min_text_len:
        keep &= size >= min_text_len
    if skip_deletion:
        keep &= ~(F.contains(F.coalesce("title", F.lit("")), F.lit("삭제")) & (size < max(120, min_text_len)))
    if annex_only:
        keep &= F.col("level").isin(*ANNEX)
    return keep


def greedy_shards(sizes: DataFrame, key: str, order: str, size: str, limit: int) -> DataFrame:
    """key, order, shard (from 1): consecutive rows of a key filled up to ``limit``.

    A row that would exceed the limit opens the next shard; one that exceeds it
    alone stays alone.  The shard of a row depends on the one before it, so each
    key is passed over once in order; only its sizes travel, streamed in sorted
    batches that spill, and nothing of a key is held but the running sum.
    """
    schema = f"{key} {sizes.schema[key].dataType.simpleString()}, {order} {sizes.schema[order].dataType.simpleString()}, shard int"

    def run(frames):  # noqa: ANN001
        import pandas as pd

        current, used, shard = None, 0, 0
        for frame in frames:
            shards = []
            for k, n in zip(frame[key], frame[size]):
                if current is None or k != current[0]:
                    current, used, shard = (k,), 0, 1
                elif used + n > limit:
                    used, shard = 0, shard + 1
                used += n
                shards.append(shard)
            yield pd.DataFrame({key: frame[key], order: frame[order], "shard": pd.array(shards, dtype="int32")})

    sorted_rows = sizes.select(key, order, size).repartition(F.col(key)).sortWithinPartitions(key, order)
    return sorted_rows.mapInPandas(run, schema)


def header() -> Column:
    """The lines above a document's first unit."""
    return F.concat(F.lit("# "), F.col("law_title"), F.lit("\n\n_MST: "), F.col("mst"), F.lit("_\n\n"))


def law_lines(rows: DataFrame) -> DataFrame:
    """mst, pos, md: the parts of each law's document in order, its header at 0.

    A law's document is as long as the law, so it stays rows; written by law and
    sorted by ``pos`` they are the file.
    """
    heads = rows.groupBy("mst").agg(F.max("law_title").alias("law_title")).select("mst", F.lit(0).cast("long").alias("pos"), header().alias("md"))
    return heads.unionByName(rows.select("mst", F.col("unit_id").alias("pos"), F.concat("md", F.lit("\n")).alias("md")))


def shard_markdown(rows: DataFrame) -> DataFrame:
    """mst, shard, law_title, md: one document a shard; the shards' size is bounded."""
    ordered = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("unit_id", "md"))), lambda r: F.concat(r["md"], F.lit("\n"))), ""
    )
    one = rows.groupBy("mst", "shard").agg(F.max("law_title").alias("law_title"), ordered.alias("body"))
    return one.select("mst", "shard", "law_title", F.concat(header(), F.col("body")).alias("md"))


def annex_files(rows: DataFrame) -> DataFrame:
    """file_name, unit_id, md: one file for each annex; of one name the last unit stays."""
    number = F.coalesce(X.filled(X.annex_number_human(F.col("annex_no"))), X.filled(F.col("annex_no")), F.lit("unknown"))
    named = rows.where(F.col("level").isin(*ANNEX)).withColumn(
        "file_name", X.safe_filename(F.concat(F.col("law_title"), F.lit("_별표_"), number, F.lit(".md")))
    )
    last = named.groupBy("file_name").agg(F.max("unit_id").alias("unit_id"))
    return named.join(last, ["file_name", "unit_id"], "left_semi").select("file_name", "unit_id", "md")


def shard_names(rows: DataFrame) -> DataFrame:
    part = F.format_string("%s_part%02d.md", F.col("law_title"), F.col("shard"))
    return rows.withColumn("file_name", X.safe_filename(part))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in an order."""
    return df.orderBy(*order).limit(n)


def dense_rank_in(df: DataFrame, key: str, *order: str) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
