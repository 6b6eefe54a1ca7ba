"""The queries of the problems tagged llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ferrolex.llm import canonical, mixing, packing, spam
from ferrolex.sources.tables import table

FIELDS = ("dopant_or_alloying_element", "deformation_process", "dbtt_definition")


def mapped(spark: SparkSession, d: str, skip_labels: bool) -> DataFrame:
    tables = [(table(spark, d, "w_dbtt"), "rec_key", FIELDS), (table(spark, d, "extraction_figure"), "figure_key", ("figure_type",))]
    return canonical.map_to_terms(tables, table(spark, d, "ref_term"), skip_labels)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return mapped(spark, d, True).select("field_name", "row_key", "term_id")


def p1_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The report of entries that name nothing on the list."""
    return mapped(spark, d, True).where("term_id = 0").groupBy("field_name", "entry").count().withColumnRenamed("count", "n_rows")


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    packed, certificates = packing.certified(table(spark, d, "documents"))
    return packing.report(packed, certificates=certificates)


def p8_selection(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_target"))[0]


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_target"))[1]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.score(table(spark, d, "documents")).where("is_spam").select("doc_id")


def p9_scores(spark: SparkSession, d: str) -> DataFrame:
    return spam.score(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found, "p1_unmatched": p1_unmatched, "p7_packed": p7_packed, "p7_report": p7_report,
        "p8_selection": p8_selection, "p8_shares": p8_shares, "p9_found": p9_found, "p9_scores": p9_scores,
    }


def oracle_sql() -> dict[str, str]:
    """None of these operators can be written in SQL; tests hold them against brute force."""
    return {}
