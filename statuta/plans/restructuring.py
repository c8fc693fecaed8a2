"""Queries of the restructuring operators: nested documents and schema drift."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from statuta.operators import drift, nested
from statuta.session import table


def _nodes(spark: SparkSession, d: str) -> DataFrame:
    return nested.flatten_documents(table(spark, d, "raw_laws").select("raw_id", "payload"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _nodes(spark, d).select("raw_id", "node_path", "parent_path")


def p2_laws(spark: SparkSession, d: str) -> DataFrame:
    return nested.law_table(table(spark, d, "raw_laws").select("raw_id", "payload"))


def _kind(kind: str, route: str | None = None) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: nested.subtype_table(_nodes(spark, d), kind, route=route)


def p2_variants(spark: SparkSession, d: str) -> DataFrame:
    return nested.variant_counts(_nodes(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.drift_report(table(spark, d, "annex_feed")).select("file_id", "field", "change")


def p3_annexes(spark: SparkSession, d: str) -> DataFrame:
    feed = table(spark, d, "annex_feed")
    _, renames = drift.matched(feed)
    return drift.unified_table(feed, drift.canonical_names(renames))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found,
    "p2_laws": p2_laws,
    "p2_articles": _kind("조"),
    "p2_paragraphs": _kind("항"),
    "p2_items": _kind("호"),
    "p2_subitems": _kind("목"),
    "p2_addenda": _kind("부칙"),
    "p2_annexes": _kind("별표"),
    "p2_links": _kind("링크"),
    "p2_variants": p2_variants,
    # tables of subtypes
    "p2_article_branches": _kind("조", "article_branch"),
    "p2_paragraph_branches": _kind("항", "paragraph_branch"),
    "p2_paragraph_texts": _kind("항", "paragraph_text"),
    "p2_item_branches": _kind("호", "item_branch"),
    "p2_item_texts": _kind("호", "item_text"),
    "p2_subitem_texts": _kind("목", "subitem_text"),
    "p2_annex_branches": _kind("별표", "annex_branch"),
    "p2_forms": _kind("별표", "form"),
    "p2_form_branches": _kind("별표", "form_branch"),
    "p2_link_texts": _kind("링크", "link_text"),
    "p3_found": p3_found,
    "p3_annexes": p3_annexes,
}

SQL: dict[str, str] = {}
