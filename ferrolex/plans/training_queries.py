"""The queries of the general training-data operations (problems 2 to 6)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolex.operators import drift, nested, packed_fields, quality, units
from ferrolex.plans import sql_training
from ferrolex.session import cut, spread
from ferrolex.sources.tables import table

ROOTS = ("symmetry", "bulk_modulus", "shear_modulus", "origins")


def _answers(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "mp_cache"))


def _stating(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "w_dbtt").select("rec_key", *units.STATING))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    found = drift.changes(table(spark, d, "raw_file"), spread(table(spark, d, "raw_record")))
    return found.select("file_id", "key_name", "change_kind")


def p2_unified(spark: SparkSession, d: str) -> DataFrame:
    return drift.unified(table(spark, d, "raw_file"), spread(table(spark, d, "raw_record")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return units.converted(_stating(spark, d), table(spark, d, "ref_unit"))


def p3_ppm(spark: SparkSession, d: str) -> DataFrame:
    return units.to_ppm(_stating(spark, d), table(spark, d, "ref_unit")).drop("raw", "offset")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.findings(table(spark, d, "w_dbtt"), table(spark, d, "column_profile"))


def p4_metrics(spark: SparkSession, d: str) -> DataFrame:
    return quality.metrics(table(spark, d, "w_dbtt"), table(spark, d, "column_profile"))


def p4_anomalies(spark: SparkSession, d: str) -> DataFrame:
    states = quality.load_states(table(spark, d, "w_dbtt"), table(spark, d, "column_profile"))
    found = quality.control_limits(cut(quality.load_metrics(states)))
    return found.withColumns({c: F.round(c, 6) for c in ("value", "expected", "deviation")})


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.leaf_paths(_answers(spark, d), ROOTS)


def _p5(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: nested.flat_tables(_answers(spark, d))[name]


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return packed_fields.split_fields(table(spark, d, "w_dbtt"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p2_found": p2_found, "p2_unified": p2_unified, "p3_found": p3_found, "p3_ppm": p3_ppm, "p4_found": p4_found,
        "p4_metrics": p4_metrics, "p4_anomalies": p4_anomalies, "p5_found": p5_found, "p5_answers": _p5("answer"),
        "p5_documents": _p5("document"), "p5_origins": _p5("document_origins"), "p6_found": p6_found,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": sql_training.P3_FOUND, "p3_ppm": sql_training.P3_PPM, "p4_found": sql_training.P4_FOUND, "p4_metrics": sql_training.P4_METRICS,
        "p4_anomalies": sql_training.P4_ANOMALIES, "p5_found": sql_training.P5_FOUND, "p5_answers": sql_training.P5_ANSWERS,
        "p5_documents": sql_training.P5_DOCUMENTS, "p5_origins": sql_training.P5_ORIGINS,
    }
