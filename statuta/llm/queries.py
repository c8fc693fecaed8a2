"""Named queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.llm import encoding, langid, leakage, residue, splitting, survivors
from statuta.session import table


def _titled(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "units").select("unit_id", "mst", "title", "text")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue_units(_titled(spark, d), law="mst").select("unit_id")


def p1_templates(spark: SparkSession, d: str) -> DataFrame:
    return residue.templates(residue.judged_segments(_titled(spark, d), law="mst"))


def p1_clean(spark: SparkSession, d: str) -> DataFrame:
    return residue.clean_units(_titled(spark, d), law="mst")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.oversized(table(spark, d, "units").select("unit_id", "text"))


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_oversized(table(spark, d, "units").select("unit_id", "text"))


def p4_restored(spark: SparkSession, d: str) -> DataFrame:
    """For every unit the hash of the text that its pieces give without their
    overlaps, and whether all pieces fit and begin with the end of the one before."""
    pieces = splitting.split_oversized(table(spark, d, "units").select("unit_id", "text"))
    # the pieces of one text, which is one value already
    parts = pieces.groupBy("unit_id").agg(F.array_sort(F.collect_list(F.struct("piece_no", "start_pos", "end_pos", "piece"))).alias("p"))
    own = F.transform("p", lambda x: F.substring(x["piece"], F.length(x["piece"]) - (x["end_pos"] - x["start_pos"]) + 1, x["end_pos"] - x["start_pos"]))
    before = F.concat(F.array(F.lit("")), F.transform("p", lambda x: F.right(x["piece"], F.lit(splitting.OVERLAP))))
    heads = F.transform("p", lambda x, k: F.startswith(x["piece"], F.when(k == 0, F.lit("")).otherwise(F.get(before, k))))
    return parts.select(
        "unit_id",
        F.md5(F.array_join(own, "")).alias("digest"),
        F.forall("p", lambda x: F.length(x["piece"]) <= splitting.LIMIT).alias("fits"),
        F.forall(heads, lambda ok: ok).alias("overlapping"),
    )


def _annex_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, "units"), table(spark, d, "trust_sources")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.surviving_values(*_annex_inputs(spark, d)).select("group_id", "field", "unit_id")


def p5_records(spark: SparkSession, d: str) -> DataFrame:
    return survivors.best_representatives(*_annex_inputs(spark, d))


def p5_values(spark: SparkSession, d: str) -> DataFrame:
    return survivors.true_values(*_annex_inputs(spark, d))


def p5_sources(spark: SparkSession, d: str) -> DataFrame:
    return survivors.source_quality(*_annex_inputs(spark, d))


def p5_disagreement(spark: SparkSession, d: str) -> DataFrame:
    return survivors.model_against_rule(*_annex_inputs(spark, d))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.encode_corpus(table(spark, d, "documents").select("doc_id", "text"))


def p6_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Length and hash of every text after encoding and decoding it."""
    back = encoding.decode_column(F.col("ids"))
    ids = encoding.encode_corpus(table(spark, d, "documents").select("doc_id", "text"))
    return ids.select("doc_id", back.alias("text")).select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest")
    )


def _leak_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "eval_items").select("item_id", "passage")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(*_leak_inputs(spark, d)).select("doc_id", "item_id")


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leak_report(*_leak_inputs(spark, d))


def _language_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, d, "documents").select("doc_id", "text", "lang"), table(spark, d, "lang_samples")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return langid.relabelled(*_language_inputs(spark, d)).select("doc_id", "lang")


def p8_segments(spark: SparkSession, d: str) -> DataFrame:
    return langid.detect_segments(*_language_inputs(spark, d))


def p8_documents(spark: SparkSession, d: str) -> DataFrame:
    return langid.document_languages(langid.detect_segments(*_language_inputs(spark, d)), every=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_templates": p1_templates,
    "p1_clean": p1_clean,
    "p4_found": p4_found,
    "p4_pieces": p4_pieces,
    "p4_restored": p4_restored,
    "p5_found": p5_found,
    "p5_records": p5_records,
    "p5_values": p5_values,
    "p5_sources": p5_sources,
    "p5_disagreement": p5_disagreement,
    "p6_ids": p6_ids,
    "p6_roundtrip": p6_roundtrip,
    "p7_found": p7_found,
    "p7_report": p7_report,
    "p8_found": p8_found,
    "p8_segments": p8_segments,
    "p8_documents": p8_documents,
}

_BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+"


def _plain(x: str) -> str:
    return f"translate({x}, '{survivors._WIDE}', '{survivors._PLAIN}')"


def _usable(x: str) -> str:
    values = ", ".join(f"'{v}'" for v in survivors.STAND_INS)
    return f"({x} IS NOT NULL AND lower(regexp_replace({_plain(x)}, '{_BLANK}', '', 'g')) NOT IN ({values}))"


def _link(x: str) -> str:
    bare = f"regexp_replace({x}, '{_BLANK}', '', 'g')"
    values = ", ".join(f"'{v}'" for v in survivors.LINK_STAND_INS)
    return f"({_usable(x)} AND lower({bare}) NOT IN ({values}) AND NOT regexp_matches(lower({bare}), '^(?:#|javascript:|about:)'))"


_BARE = rf"regexp_replace(regexp_replace({_plain('annex_no')}, '{_BLANK}', '', 'g'), '[\[\]<>().]|별표|별지|서식|제|호', '', 'g')"
_P5 = rf"""WITH a0 AS (SELECT u.unit_id, u.mst, u.level, u.annex_no, u.title, u.links.html AS html, u.links.pdf AS pdf, u.links.detail AS detail, u.collected_at,
    coalesce(t.trust, -2147483648) AS trust, {_BARE} AS bare FROM units u LEFT JOIN trust_sources t USING (source_name) WHERE u.level IN ('별표', '서식')),
a1 AS (SELECT *, CASE WHEN regexp_matches(bare, '^\d{{6}}$') THEN ltrim(bare[:4], '0') ELSE ltrim(regexp_extract(bare, '^(\d+)(?:[의\-_/](\d+))?$', 1), '0') END AS head,
    CASE WHEN regexp_matches(bare, '^\d{{6}}$') THEN ltrim(bare[5:], '0') ELSE ltrim(regexp_extract(bare, '^(\d+)(?:[의\-_/](\d+))?$', 2), '0') END AS tail FROM a0),
a2 AS (SELECT *, CASE WHEN NOT {_usable('annex_no')} THEN NULL WHEN head <> '' THEN head || CASE WHEN tail <> '' THEN '의' || tail ELSE '' END
      WHEN regexp_matches(bare, '[0-9A-Za-z가-힣]') AND NOT regexp_matches(bare, '^(\d+)(?:[의\-_/](\d+))?$') THEN bare END AS num,
    CASE WHEN {_usable('title')} THEN nullif(lower(regexp_replace(regexp_replace(regexp_replace({_plain('title')}, '^\s*[\[<(]\s*(?:별표|별지|서식)[^\]>)]*[\]>)]', ''), '\([^()]*관련\s*\)\s*$', ''), '{_BLANK}', '', 'g')), '') END AS tk FROM a1),
titled AS (SELECT mst, level, tk, min(num) AS via FROM a2 WHERE num IS NOT NULL AND tk IS NOT NULL GROUP BY ALL),
a3 AS (SELECT a2.*, coalesce(num, via, 'title:' || a2.tk, 'unit:' || unit_id) AS annex FROM a2 LEFT JOIN titled t ON a2.mst = t.mst AND a2.level = t.level AND a2.tk = t.tk),
g AS (SELECT *, min(unit_id) OVER w AS group_id, count(*) OVER w AS n FROM a3 WINDOW w AS (PARTITION BY mst, level, annex)),
f AS (SELECT group_id, unit_id, trust, collected_at, unnest([{{'f': 'annex_no', 'ok': num IS NOT NULL}}, {{'f': 'title', 'ok': {_usable('title')}}}, {{'f': 'html', 'ok': {_link('html')}}},
    {{'f': 'pdf', 'ok': {_link('pdf')}}}, {{'f': 'detail', 'ok': {_link('detail')}}}]) AS x FROM g WHERE n > 1)
SELECT group_id, field, unit_id FROM (SELECT group_id, x.f AS field, unit_id, row_number() OVER (PARTITION BY group_id, x.f ORDER BY trust DESC, collected_at DESC NULLS LAST, unit_id) AS nth FROM f WHERE x.ok) WHERE nth = 1"""

SQL: dict[str, str] = {
    "p5_found": _P5,
    "p4_found": "SELECT unit_id FROM units WHERE length(text) > 2000",
    "p4_restored": "SELECT unit_id, md5(text) AS digest, true AS fits, true AS overlapping FROM units WHERE text IS NOT NULL",
    "p6_roundtrip": """
        SELECT doc_id, length(coalesce(text, '')) AS n_chars, md5(coalesce(text, '')) AS digest FROM documents
    """,
}
