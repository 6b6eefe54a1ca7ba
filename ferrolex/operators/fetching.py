"""Routing, classification and summaries of fetched papers, and the selection of pending work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The publisher prefix, statuses, and the marks of a full text in an XML answer.
PREFIX = "10.1016/"
FETCHABLE = ("full_text", "pdf_downloaded")
FULL_TEXT_MARKS = ("<xocs:rawtext>", "<ce:sections>")
ERROR_MESSAGES = {403: "access denied", 404: "not found", 429: "rate limited"}


def slug(doi: Column) -> Column:
    """File name of a DOI: slashes to underscores, dots to hyphens (not injective; tables are keyed by the DOI)."""
    return F.translate(doi, "/.", "_-")


def publisher_route(doi: Column) -> Column:
    """Whether the publisher's interface serves the DOI; compared with case after trimming."""
    return F.trim(doi).startswith(PREFIX)


def classify_response(code: Column, body: Column) -> Column:
    """Status of an article answer."""
    full = F.lower(body).contains("<body>")
    for mark in FULL_TEXT_MARKS:
        full = full | body.contains(mark)
    return F.when((code == 200) & F.coalesce(full, F.lit(False)), "full_text").when(code == 200, "abstract_only").otherwise("error")


def response_message(code: Column) -> Column:
    out = F.when(code == 200, None)
    for c, text in ERROR_MESSAGES.items():
        out = out.when(code == c, text)
    return out.otherwise(F.concat(F.lit("status "), code.cast("string")))


def classify_open_access(code: Column, url_for_pdf: Column, url: Column, pdf_code: Column) -> Column:
    """Status of an open-access lookup and of the download that follows it."""
    link = open_access_url(url_for_pdf, url)
    return (
        F.when(F.coalesce(code, F.lit(0)) != 200, "error").when(link.isNull(), "no_oa_pdf")
        .when(F.coalesce(pdf_code, F.lit(0)) != 200, "error").otherwise("pdf_downloaded")
    )


def open_access_url(url_for_pdf: Column, url: Column) -> Column:
    return F.coalesce(F.nullif(url_for_pdf, F.lit("")), F.nullif(url, F.lit("")))


def paper_path(doi: Column, status: Column) -> Column:
    """Path of the file that a status leaves, null where it leaves none."""
    return (
        F.when(status == "full_text", F.concat(slug(doi), F.lit(".xml"))).when(status == "abstract_only", F.concat(slug(doi), F.lit("_abstract_only.xml")))
        .when(status == "pdf_downloaded", F.concat(slug(doi), F.lit(".pdf")))
    )


def error_path(doi: Column) -> Column:
    return F.concat(slug(doi), F.lit("_error.txt"))


def error_text(body: Column) -> Column:
    return F.substring(body, 1, 500)


def status_counts(log: DataFrame) -> DataFrame:
    """One row: totals of the statuses as written; other statuses are in the total and in n_other."""
    n = lambda s: F.count_if(F.col("status") == s)
    named = ("full_text", "abstract_only", "error")
    return log.agg(
        F.count("*").alias("n_total"), *[n(s).alias(f"n_{s}") for s in named], F.count_if(~F.coalesce(F.col("status").isin(*named), F.lit(False))).alias("n_other")
    )


def fetchable(log: DataFrame) -> DataFrame:
    return log.where(F.col("status").isin(*FETCHABLE))


def union_of_work(log: DataFrame, manual: DataFrame) -> DataFrame:
    """doi, source, ord: fetchable entries of the log (ord = fetch order), then the manual list. Bags, not sets."""
    a = fetchable(log).select("doi", F.lit(0).alias("source"), F.col("fetch_id").cast("bigint").alias("ord"))
    b = manual.select("doi", F.lit(1).alias("source"), F.col("ord").cast("bigint").alias("ord"))
    return a.unionByName(b)


def first_wins(work: DataFrame) -> DataFrame:
    """Each DOI once with its first place; an aggregate, so a frequent DOI is merged before the shuffle."""
    return work.where("doi is not null").groupBy("doi").agg(F.min(F.struct("source", "ord")).alias("p")).select("doi", "p.source", "p.ord")


def first_wins_by_rank(work: DataFrame) -> DataFrame:
    """The same by a ranking window."""
    r = F.row_number().over(W.partitionBy("doi").orderBy("source", "ord"))
    return work.where("doi is not null").withColumn("r", r).where("r = 1").drop("r")


def pending(log: DataFrame, manual: DataFrame, done: DataFrame) -> DataFrame:
    """DOIs without an output: log before manual list, each once, those whose file name exists left out."""
    outputs = done.where("doi is not null").select(slug(F.col("doi")).alias("slug")).distinct()
    todo = first_wins(union_of_work(log, manual)).withColumn("slug", slug(F.col("doi")))
    return todo.join(outputs, "slug", "left_anti").select("doi", "source", "ord")


def input_route(papers: DataFrame, files: DataFrame) -> DataFrame:
    """doi, input_format: xml if such a file exists, else pdf, else null (a row, not a failure)."""
    names = files.select("filename").distinct()
    p = papers.select("doi").distinct().withColumns({"x": F.concat(slug(F.col("doi")), F.lit(".xml")), "f": F.concat(slug(F.col("doi")), F.lit(".pdf"))})
    p = p.join(names.select(F.col("filename").alias("x"), F.lit(True).alias("has_xml")), "x", "left")
    p = p.join(names.select(F.col("filename").alias("f"), F.lit(True).alias("has_pdf")), "f", "left")
    return p.select("doi", F.when(F.col("has_xml"), "xml").when(F.col("has_pdf"), "pdf").alias("input_format"))


def supplements(papers: DataFrame, files: DataFrame) -> DataFrame:
    """doi, filename: supplementary documents by the slug before `_mmc`; papers without any get the unnamed ones.

    The prefix is a key of the file name, so this is an equi-join.
    """
    named = files.where(F.col("filename").rlike(r"_mmc[^/]*\.docx$")).select(F.regexp_extract("filename", r"^(.*)_mmc[^/]*\.docx$", 1).alias("slug"), "filename")
    general = files.where(F.col("filename").rlike(r"^mmc[^/]*\.docx$")).select(F.lit(1).alias("one"), F.col("filename").alias("general"))
    p = papers.select("doi").distinct().withColumn("slug", slug(F.col("doi"))).withColumn("one", F.lit(1))
    own = p.join(named, "slug", "left")
    lists = general.groupBy("one").agg(F.sort_array(F.collect_set("general")).alias("general"))
    j = own.join(lists, "one", "left")
    return j.select("doi", F.explode(F.when(F.col("filename").isNotNull(), F.array("filename")).otherwise(F.col("general"))).alias("filename"))


def extraction_totals(extractions: DataFrame, records: DataFrame) -> DataFrame:
    """One row: runs, failed runs, records in all and the largest number of one run."""
    n = records.where("extraction_id is not null").groupBy("extraction_id").agg(F.count("*").alias("n"))
    j = extractions.join(n, "extraction_id", "left")
    return j.agg(
        F.count("*").alias("n_runs"), F.count_if(F.col("failure").isNotNull()).alias("n_failed"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_records"), F.coalesce(F.max("n"), F.lit(0)).alias("most_records")
    )
