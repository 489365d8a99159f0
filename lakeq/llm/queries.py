"""Queries of the text problems (p6-p8). Their tests are brute-force and round-trip; SQL covers the copy checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeq.llm import canonical, leakage, mixing
from lakeq.session import table


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.lookalike_pairs(table(spark, d, "documents"))


def p8_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every document in the one form, by its key and length."""
    forms = canonical.canonical_form(table(spark, d, "documents"))
    return forms.select("doc_id", (F.col("text_key") != canonical.text_key(F.col("form"))).alias("changed"), F.length("form").alias("form_chars"))


def p8_classes(spark: SparkSession, d: str) -> DataFrame:
    return canonical.lookalike_classes(table(spark, d, "documents"))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).filter(F.col("exact_words") >= leakage.SPAN).select("doc_id", "item_id")


def p6_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """All verified overlaps, those with substituted words included."""
    return _leaks(spark, d).filter(F.col("overlap_words") >= leakage.SPAN)


def p7_draw(spark: SparkSession, d: str) -> DataFrame:
    """Copies of every drawn document per mix."""
    return mixing.draw(table(spark, d, "mix_targets"), table(spark, d, "documents"))[0]


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Shares reached per mix and source, with any shortfall."""
    return mixing.draw(table(spark, d, "mix_targets"), table(spark, d, "documents"))[1]


def p7_report_held(spark: SparkSession, d: str) -> DataFrame:
    """As ``p7_report``, with budgets shrunk until the shares hold among the tokens drawn."""
    return mixing.draw(table(spark, d, "mix_targets"), table(spark, d, "documents"), hold_shares=True)[1]


QUERIES = {
    "p6_found": p6_found,
    "p6_overlaps": p6_overlaps,
    "p7_draw": p7_draw,
    "p7_report": p7_report,
    "p7_report_held": p7_report_held,
    "p8_found": p8_found,
    "p8_forms": p8_forms,
    "p8_classes": p8_classes,
}

#: The text queries have no SQL: their steps can't be said in it.
ORACLE: dict[str, str] = {}
