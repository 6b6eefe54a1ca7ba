"""File sources and sinks: extraction envelopes, logs, lists, caches, CSV and text."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrolex.operators.fetching import slug
from ferrolex.operators.phases import cache_path

LOG = "doi string, status string, filename string, message string"
FIGURES = "array<struct<figure_id:string,figure_type:string,description:string,contains_data:boolean>>"


def whole_texts(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """path and value of whole text files; a missing folder gives no rows."""
    try:
        df = spark.read.text(path, wholetext=True, **({"pathGlobFilter": pattern} if pattern else {}))
        return df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), "value")
    except AnalysisException:
        return spark.createDataFrame([], "path string, file_name string, value string")


def scan_extractions(spark: SparkSession, folder: str, record: T.StructType) -> DataFrame:
    """_source_file, pos, _doi and the record columns of all *_extraction.json; failed envelopes are left to `failed_extractions`.

    In the order of file and position where `in_file_order` is applied, as the sinks do.
    """
    v = whole_texts(spark, folder, "*_extraction.json").withColumn("v", F.try_parse_json("value"))
    items = v.select("file_name", F.try_variant_get("v", "$.doi", "string").alias("doi"), F.posexplode(F.try_variant_get("v", "$.records", "array<variant>")).alias("pos", "r"))
    parsed = items.select("file_name", "doi", "pos", F.from_json(F.to_json("r"), record).alias("rec"))
    return parsed.select(F.col("file_name").alias("_source_file"), "pos", F.col("doi").alias("_doi"), "rec.*")


def failed_extractions(spark: SparkSession, folder: str) -> DataFrame:
    """_source_file, error, finish_reason, raw of envelopes whose records are an error object, or that are no JSON."""
    v = whole_texts(spark, folder, "*_extraction.json").withColumn("v", F.try_parse_json("value"))
    bad = v.where(F.col("v").isNull() | ~F.coalesce(F.schema_of_variant(F.try_variant_get("v", "$.records", "variant")).startswith("ARRAY"), F.lit(True)))
    g = lambda p: F.try_variant_get("v", p, "string")
    return bad.select(F.col("file_name").alias("_source_file"), F.coalesce(g("$.records.error"), F.lit("no JSON")).alias("error"), g("$.records.finish_reason").alias("finish_reason"), g("$.records.raw").alias("raw"))


def scan_figure_classes(spark: SparkSession, folder: str) -> DataFrame:
    v = whole_texts(spark, folder, "*_extraction.json")
    env = v.select("file_name", F.from_json("value", f"doi string, figure_classifications {FIGURES}").alias("e"))
    return env.select(F.col("file_name").alias("_source_file"), "e.doi", F.posexplode("e.figure_classifications").alias("pos", "f")).select("_source_file", "doi", "pos", "f.*")


def scan_fetch_log(spark: SparkSession, path: str) -> DataFrame:
    """The log's entries with their place; a missing file gives none."""
    v = whole_texts(spark, path)
    return v.select(F.posexplode(F.from_json("value", f"array<struct<{', '.join(f.replace(' ', ':') for f in LOG.split(', '))}>>")).alias("pos", "e")).select("pos", "e.*")


def scan_manual_list(spark: SparkSession, path: str) -> DataFrame:
    return whole_texts(spark, path).select(F.posexplode(F.from_json("value", "array<string>")).alias("ord", "doi"))


def scan_phase_cache(spark: SparkSession, folder: str) -> DataFrame:
    """cache_key, payload of cached answers, empty lists among them."""
    return whole_texts(spark, folder, "*.json").select(F.regexp_replace("file_name", r"\.json$", "").alias("cache_key"), F.col("value").alias("payload"))


def in_file_order(df: DataFrame) -> DataFrame:
    """Rows in the order of their file and their place in it, then of their log line if they have one."""
    order = [c for c in ("_source_file", "pos", "rec_key", "seq") if c in df.columns]
    return df.orderBy(*order) if order else df


# Files are written through Arrow's file systems, so that a folder may lie on a disk shared by all executors, on HDFS or in
# an object store. Each file is written beside its place and moved there when it is whole; a task that runs again writes
# the same file again.


def _place(path: str) -> tuple:
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def exists(path: str) -> bool:
    from pyarrow import fs

    system, at = _place(path)
    return system.get_file_info(at).type != fs.FileType.NotFound


def _write(path: str, chunks: Iterator[bytes]) -> None:
    system, at = _place(path)
    system.create_dir(posixpath.dirname(at), recursive=True)
    with system.open_output_stream(at + ".part") as out:
        for chunk in chunks:
            out.write(chunk)
    system.move(at + ".part", at)


def write_files(df: DataFrame, folder: str) -> None:
    """Write (path, payload) rows, text or binary, as files below a folder; rows with a null in either write nothing."""

    def run(rows: Iterator) -> None:
        for r in rows:
            if r.path is not None and r.payload is not None:
                _write(f"{folder}/{r.path}", iter([r.payload.encode() if isinstance(r.payload, str) else bytes(r.payload)]))

    df.select("path", "payload").foreachPartition(run)


def _one_file(df: DataFrame, path: str, chunks: Callable[[Iterator], Iterator[bytes]]) -> None:
    """Write rows of text as one file: one task that holds a row at a time, in the order of the frame."""

    def run(rows: Iterator) -> None:
        _write(path, chunks(r.value for r in rows))

    df.select("value").coalesce(1).foreachPartition(run)


def sink_envelopes(df: DataFrame, folder: str) -> None:
    """One JSON file per paper of rows (doi, ...): {slug}_extraction.json, indented, nulls written, text not escaped."""
    body = F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"})
    write_files(df.where("doi is not null").select(F.concat(slug(F.col("doi")), F.lit("_extraction.json")).alias("path"), body.alias("payload")), folder)


def list_text(values: Column) -> Column:
    """A list of texts as it is printed: ['a', 'b'], with double quotes around a text that holds a single one."""
    def one(x: Column) -> Column:
        plain = F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
        single = F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'"))
        double = F.concat(F.lit('"'), plain, F.lit('"'))
        return F.when(x.isNull(), "None").when(x.contains("'") & ~x.contains('"'), double).otherwise(F.when(x.contains("'"), single).otherwise(F.concat(F.lit("'"), plain, F.lit("'"))))

    return F.when(values.isNotNull(), F.concat(F.lit("["), F.array_join(F.transform(values, one), ", "), F.lit("]")))


def csv_ready(df: DataFrame) -> DataFrame:
    """NaN as null, lists of texts as printed, other nested values as JSON."""
    out = {}
    for f in df.schema:
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            out[f.name] = list_text(F.col(f"`{f.name}`"))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out[f.name] = F.to_json(f"`{f.name}`")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast("double"))
    return df.withColumns(out) if out else df


#: Options under which CSV keeps texts as they are.
AS_WRITTEN = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def sink_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header, nulls empty: a folder of parts, or one file in file order for small results."""
    ready = csv_ready(df)
    if not single:
        ready.write.mode("overwrite").options(header=True, **AS_WRITTEN).csv(path)
        return
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in ready.columns]), AS_WRITTEN)
    head = ",".join(ready.columns)
    ordered = in_file_order(ready).select(line.alias("value"))
    _one_file(ordered, path, lambda values: (x.encode() for part in ([head + "\n"], (v + "\n" for v in values)) for x in part))


def replace_csv(df: DataFrame, path: str) -> None:
    """Write a small CSV table beside an old one and put it in its place when it is whole."""
    system, at = _place(path)
    new = f"{path}.new"
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(new)
    if exists(path):
        system.delete_dir(at)
    system.move(_place(new)[1], at)


def sink_text(lines: DataFrame, path: str, header: DataFrame | None = None) -> None:
    """A text log as one file: the header's lines, then the lines in file order."""
    keys = ("_source_file", "pos", "rec_key", "seq")
    text = in_file_order(lines).select(F.concat_ws(" ", *[c for c in lines.columns if c not in keys]).alias("value"))
    first = [r.value for r in header.limit(100).collect()] if header is not None else []
    _one_file(text, path, lambda values: ((v + "\n").encode() for part in (first, values) for v in part))


def sink_fetch_log(df: DataFrame, path: str) -> None:
    """The log as one JSON array, which `scan_fetch_log` reads; overwrites."""

    def chunks(values: Iterator[str]) -> Iterator[bytes]:
        yield b"["
        for k, v in enumerate(values):
            yield ((",\n  " if k else "\n  ") + v).encode()
        yield b"\n]\n"

    order = [c for c in ("ord", "fetch_id") if c in df.columns]
    rows = df.orderBy(*order) if order else df
    columns = [c.split()[0] for c in LOG.split(", ")]
    _one_file(rows.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")), path, chunks)


def sink_manual_list(dois: DataFrame, path: str) -> None:
    """A list of DOIs as one JSON array, `[]` for none."""
    _one_file(dois.select(F.to_json(F.array("doi")).alias("value")), path, lambda values: iter([("[" + ", ".join(v[1:-1] for v in values) + "]").encode()]))


def sink_phase_cache(answers: DataFrame, folder: str) -> None:
    """One JSON file per key, named as `scan_phase_cache` reads it; answers without a readable payload are left out."""
    ok = answers.where(F.try_parse_json("payload").isNotNull() & F.col("cache_key").isNotNull())
    write_files(ok.select(cache_path(F.col("cache_key")).alias("path"), "payload"), folder)


def sink_binary(df: DataFrame, folder: str) -> None:
    """Write (path, payload) rows as files below a folder."""
    write_files(df, folder)
