"""From paper files to extraction envelopes: content, classified figures, extracted records (one paper a row).

Each call of the model is made once and its reply stored; a paper without a file, a failed call or an unreadable reply
gives an envelope that says so, and never ends the others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolex.functions import rules
from ferrolex.operators import figures
from ferrolex.operators.fetching import slug
from ferrolex.session import cut
from ferrolex.sources import connectors, papers
from ferrolex.sources.record_schema import RecordSchema, classification_prompt

FIGURE_INFO = "figure_id string, figure_type string, description string, contains_data boolean"


@dataclass
class Extraction:
    """What an extraction leaves: envelopes (one row per paper), kept figures (path, payload) and records."""

    envelopes: DataFrame
    figure_files: DataFrame
    records: DataFrame

    def totals(self) -> DataFrame:
        """One row: papers, papers with records, failed papers, records."""
        e = self.envelopes
        return e.agg(
            F.count("*").alias("n_papers"), F.count_if(F.col("failure").isNull()).alias("n_succeeded"), F.count_if(F.col("failure").isNotNull()).alias("n_failed"),
            F.coalesce(F.sum("n_records"), F.lit(0)).alias("n_records"),
        )


def content(papers_: DataFrame, transport: connectors.Transport | None = None, render: Callable[[bytes], list[bytes]] | None = None, key: str | None = None) -> DataFrame:
    """doi, input_format, body_text, parts of papers (doi, xml string, pdf binary): XML before PDF, null format without either."""
    xml = papers_.where("xml is not null").select("doi", "xml")
    pdf = papers_.where("xml is null and pdf is not null").select("doi", "pdf")
    none = F.array().cast(connectors.PARTS)
    a = connectors.xml_content(xml, transport, key).select("doi", F.lit("xml").alias("input_format"), "body_text", "parts")
    if render is None:
        b = pdf.select("doi", none.alias("parts"))
    else:
        b = pdf.select("doi").join(connectors.gathered_parts(papers.pdf_pages(pdf, render)), "doi", "left").select("doi", F.coalesce("parts", none).alias("parts"))
    b = b.select("doi", F.lit("pdf").alias("input_format"), F.lit("").alias("body_text"), "parts")
    c = papers_.where("xml is null and pdf is null").select("doi", F.lit(None).cast("string").alias("input_format"), F.lit(None).cast("string").alias("body_text"), none.alias("parts"))
    return a.unionByName(b).unionByName(c)


def classify_figures(contents: DataFrame, client: connectors.Client) -> DataFrame:
    """doi, figure_classifications of rows (doi, parts): one call per paper that has parts; an empty list for any other outcome."""
    with_parts = contents.where(F.size("parts") > 0)
    labels = F.array_join(F.transform("parts", lambda p: p["label"]), ", ")
    head, tail = classification_prompt(["\u0000"]).split("\u0000")
    prompts = with_parts.select("doi", F.concat(F.lit(head), labels, F.lit(tail)).alias("prompt"), "parts")
    replies = connectors.ask(prompts, client, connectors.CLASSIFY_OPTIONS)
    listed = F.schema_of_variant(F.try_parse_json("reply")).startswith("ARRAY")
    infos = F.when(listed, F.from_json("reply", f"array<struct<{FIGURE_INFO.replace(' string', ':string').replace(' boolean', ':boolean')}>>"))
    found = replies.select("doi", infos.alias("c"))
    empty = F.from_json(F.lit("[]"), f"array<struct<{FIGURE_INFO.replace(' string', ':string').replace(' boolean', ':boolean')}>>")
    return contents.select("doi").join(found, "doi", "left").select("doi", F.coalesce("c", empty).alias("figure_classifications"))


def kept_figure_files(contents: DataFrame, classified: DataFrame, kinds: tuple[str, ...] = figures.KEPT_TYPES) -> DataFrame:
    """path, payload of the parts whose last classification is one of the kinds."""
    last = classified.select("doi", F.posexplode("figure_classifications").alias("n", "c")).groupBy("doi", F.col("c.figure_id").alias("label")).agg(F.max_by("c.figure_type", "n").alias("kind"))
    parts = contents.select("doi", F.explode("parts").alias("p")).select("doi", "p.label", "p.payload", "p.mime")
    kept = parts.join(last.where(F.col("kind").isin(*kinds)), ["doi", "label"], "left_semi")
    return kept.select(figures.figure_path(F.col("doi"), F.col("label"), F.col("mime")).alias("path"), "payload")


def extract(
    papers_: DataFrame, schema: RecordSchema, client: connectors.Client, model: str, supplements: DataFrame | None = None, transport: connectors.Transport | None = None,
    render: Callable[[bytes], list[bytes]] | None = None, key: str | None = None,
) -> Extraction:
    """Papers (doi, xml, pdf) and supplements (doi, filename, data) to envelopes, figure files and records.

    Two calls of the model per paper: figures are classified, then records are extracted from the prompt, the body, the
    supplements and the parts. An envelope has the members of its JSON file, and besides n_records and failure.
    """
    contents = cut(content(papers_.where("doi is not null").dropDuplicates(["doi"]), transport, render, key))
    classified = cut(classify_figures(contents, client))
    if supplements is not None:
        texts = supplements.select("doi", "filename", papers.docx_text(F.col("data")).alias("text"))
        supp = papers.supplement_text(texts)
    else:
        supp = contents.select("doi").limit(0).select("doi", F.lit("").alias("supp_text"), F.lit(0).alias("supp_chars"))
    j = contents.join(supp, "doi", "left").withColumns({"supp_text": F.coalesce("supp_text", F.lit("")), "supp_chars": F.coalesce("supp_chars", F.lit(0))})
    head, tail = schema.extraction_prompt("\u0000").split("\u0000", 1)
    body = F.when(F.coalesce("body_text", F.lit("")) != "", F.concat(F.lit("\n\n=== PAPER BODY TEXT ===\n"), "body_text", F.lit("\n=== END BODY TEXT ==="))).otherwise("")
    prompt = F.concat(F.lit(head), F.col("doi"), F.lit(tail), body, F.col("supp_text"))
    replies = connectors.ask(j.where("input_format is not null").select("doi", prompt.alias("prompt"), "parts"), client, connectors.EXTRACT_OPTIONS)
    reply = rules.parse_reply(F.col("reply"), F.col("finish_reason"), schema.struct.simpleString())
    e = j.join(replies, "doi", "left").join(classified, "doi").withColumn("r", reply)
    failure = (
        F.when(F.col("input_format").isNull(), "no paper file").when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("r.truncated") & F.col("r.error").isNotNull(), "parse_failed: truncated").when(F.col("r.error").isNotNull(), F.col("r.error"))
    )
    failed = F.when(failure.isNotNull(), F.struct(F.coalesce("r.error", failure).alias("error"), F.col("finish_reason"), F.col("reply").alias("raw")))
    raw = F.when(failure.isNull(), F.parse_json("reply")).otherwise(F.try_parse_json(F.to_json(failed, {"ignoreNullFields": "false"})))
    envelopes = e.select(
        F.lit(model).alias("model"), "doi", "input_format", F.size("parts").alias("n_content_parts"), "supp_chars",
        F.concat(F.lit("figures/"), slug(F.col("doi"))).alias("figures_dir"), "figure_classifications", raw.alias("records"),
        F.coalesce(F.size("r.records"), F.lit(0)).alias("n_records"), failure.alias("failure"),
    )
    source = F.concat(slug(F.col("doi")), F.lit("_extraction.json"))
    records = e.where("r.records is not null").select(source.alias("_source_file"), F.col("doi").alias("_doi"), F.posexplode("r.records").alias("pos", "rec")).select("_source_file", "pos", "_doi", "rec.*")
    return Extraction(envelopes, kept_figure_files(contents, classified), records)


def envelope_files(extraction: Extraction) -> DataFrame:
    """The members of the envelopes that go to their JSON files, for `sink_envelopes`."""
    return extraction.envelopes.where("input_format is not null").drop("n_records", "failure")
