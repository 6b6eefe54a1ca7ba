"""Figures of papers: which are taken, from where, and which are kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolex.operators.fetching import slug

KEPT_TYPES = ("EBSD",)
URL_ORDER = ("high", "standard", "thumbnail")


def figure_filter(ref: Column, kind: Column, url: Column) -> Column:
    """Objects that are figures: named, located, neither supplements nor graphical abstracts, no vector drawings."""
    named = (F.coalesce(ref, F.lit("")) != "") & (F.coalesce(url, F.lit("")) != "")
    return named & ~ref.rlike("^(si|ga)") & ~F.lower(F.concat(F.coalesce(kind, F.lit("")), url)).contains("svg")


def main_figure(ref: Column) -> Column:
    return ref.startswith("gr")


def url_table(objects: DataFrame) -> DataFrame:
    """doi, ref, urls: map of category to url; of one category the last mention counts."""
    kept = objects.where(figure_filter(F.col("ref"), F.col("type"), F.col("url")))
    last = kept.groupBy("doi", "ref", "category").agg(F.max_by("url", "pos").alias("url"))
    return last.groupBy("doi", "ref").agg(F.map_from_entries(F.collect_list(F.struct("category", "url"))).alias("urls"))


def url_choice(urls: Column) -> Column:
    """The first of the preferred categories that has a url."""
    return F.coalesce(*[F.nullif(F.try_element_at(urls, F.lit(c)), F.lit("")) for c in URL_ORDER])


def extension(mime: Column) -> Column:
    return F.when(mime.contains("png"), "png").otherwise("jpg")


def clean_mime(content_type: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(F.split_part(content_type, F.lit(";"), F.lit(1))), F.lit("")), F.lit("image/jpeg"))


def encoded(payload: Column) -> Column:
    """Binary as base64 text without line breaks, whatever the session's setting."""
    return F.regexp_replace(F.base64(payload), r"[\r\n]", "")


def decoded(text: Column) -> Column:
    return F.unbase64(text)


def figure_path(doi: Column, label: Column, mime: Column) -> Column:
    return F.concat(F.lit("figures/"), slug(doi), F.lit("/"), slug(doi), F.lit("_"), label, F.lit("."), extension(mime))


def last_classes(classes: DataFrame) -> DataFrame:
    """extraction_id, figure_id, figure_type: the last classification of each label."""
    return classes.where("figure_id is not null").groupBy("extraction_id", "figure_id").agg(F.max_by("figure_type", "figure_key").alias("figure_type"))


def kept_figures(figures: DataFrame, classes: DataFrame, kinds: tuple[str, ...] = KEPT_TYPES) -> DataFrame:
    """Figures whose last classification is one of the kinds (a semi join)."""
    wanted = last_classes(classes).where(F.col("figure_type").isin(*kinds)).select("extraction_id", "figure_id")
    return figures.join(wanted, ["extraction_id", "figure_id"], "left_semi")


def kept_counts(figures: DataFrame, classes: DataFrame) -> DataFrame:
    """extraction_id, n_kept, n_total."""
    last = last_classes(classes)
    labels = figures.where("figure_id is not null").select("extraction_id", "figure_id").distinct().join(last, ["extraction_id", "figure_id"], "left")
    return labels.groupBy("extraction_id").agg(F.count_if(F.col("figure_type").isin(*KEPT_TYPES)).alias("n_kept"), F.count("*").alias("n_total"))
