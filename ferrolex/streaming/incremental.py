"""The enrich step as a stream of new extraction files: stateless, append only, restartable from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ferrolex.functions.elements import Elements
from ferrolex.operators.composition import with_composition
from ferrolex.operators.mixture import features
from ferrolex.operators.phases import heavy_alloy_flag, with_phases


def stream_records(spark: SparkSession, folder: str, record: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    """_source_file, pos and the record columns of *_extraction.json as the files arrive."""
    raw = spark.readStream.option("wholetext", True).option("pathGlobFilter", "*_extraction.json").option("maxFilesPerTrigger", files_per_trigger).text(folder)
    items = raw.select(F.col("_metadata.file_name").alias("_source_file"), F.posexplode(F.try_variant_get(F.try_parse_json("value"), "$.records", "array<variant>")).alias("pos", "r"))
    return items.select("_source_file", "pos", F.from_json(F.to_json("r"), record).alias("rec")).select("_source_file", "pos", "rec.*")


def enriched(records: DataFrame, answers: DataFrame | None = None, elements: DataFrame | None = None) -> DataFrame:
    """Composition, flag and mixture features of streamed records, and with `answers` their phases.

    The phases are a static table, one row per key, that the stream is joined with; no state is kept.
    """
    df = with_composition(records)
    df = df.withColumn("dataset_scope_flag", heavy_alloy_flag(F.col("parts"))).withColumns(features(F.col("parts"), Elements.of(elements)))
    return df if answers is None else with_phases(df, answers)


def run_once(
    spark: SparkSession, folder: str, record: T.StructType, out: str, checkpoint: str, answers: DataFrame | None = None, elements: DataFrame | None = None
) -> StreamingQuery:
    """Process all files that are new since the last run, then stop."""
    return (
        enriched(stream_records(spark, folder, record), answers, elements).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    )
