"""The queries of the record, composition, feature, phase and fetch operators over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrolex.functions import elements, rules
from ferrolex.operators import composition as comp
from ferrolex.operators import enrich, fetching, figures, mixture, nested, phases
from ferrolex.plans import sql_reference
from ferrolex.session import shared_folder, spread
from ferrolex.sources import files, papers
from ferrolex.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
WIDE = ("W", "Re", "Ta", "Mo", "Ni", "Fe", "Cu", "K")


def rounded(x: Column) -> Column:
    return F.round(x + 1e-9, 6)


#: Columns of a record that the composition and the queries on it need.
NEEDED = ["rec_key", "record_id", "material_name", "composition_type", "composition_string", *[c for slot in comp.DOPANTS for c in slot], *enrich.AUTHORITATIVE]


def records(spark: SparkSession, d: str) -> DataFrame:
    return comp.with_composition(spread(table(spark, d, "w_dbtt").select(*NEEDED)))


def per_record(**columns: Callable[[Column], Column]) -> Query:
    """rec_key and functions of the composition, for records that have one."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return records(spark, d).where("parts is not null").select("rec_key", *[f(F.col("parts")).alias(n) for n, f in columns.items()])

    return run


def label(a: Column) -> Column:
    return F.array_join(a, ",")


def scan_records(spark: SparkSession, d: str) -> DataFrame:
    """Records with the run they came from."""
    e = table(spark, d, "extraction").where("failure is null").select("extraction_id", "doi")
    return table(spark, d, "w_dbtt").join(e, "extraction_id").select("rec_key", "extraction_id", "doi")


def composition_parse(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "w_dbtt").select("rec_key", F.nullif("composition_string", F.lit("")).alias("t"))
    return enrich.fraction_rows(comp.with_formula(p, "t", "parts")).select("rec_key", "el", rounded(F.col("frac")).alias("frac"))


def discrete_composition(spark: SparkSession, d: str) -> DataFrame:
    p = comp.with_discrete(table(spark, d, "w_dbtt"), parts="parts").select("rec_key", "parts")
    return enrich.fraction_rows(p).select("rec_key", "el", rounded(F.col("frac")).alias("frac"))


def compositions(spark: SparkSession, d: str) -> DataFrame:
    rows = records(spark, d)
    return rows.select("rec_key", "format_used", F.explode("parts").alias("p")).select("rec_key", "format_used", F.col("p.el").alias("el"), rounded(F.col("p.f")).alias("frac"))


def composition_warnings(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select("rec_key", F.explode("composition_warnings").alias("warning"))


def composition_formats(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).groupBy(F.coalesce("format_used", F.lit("none")).alias("format_used")).agg(F.count("*").alias("n"))


def dopant_units(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "w_dbtt").select("rec_key", comp.dopant_fraction(F.col("dopant_concentration"), F.col("dopant_concentration_unit")).alias("x"))
    return r.select("rec_key", "x.kind", rounded(F.col("x.f")).alias("f"))


def formats_compared(spark: SparkSession, d: str) -> DataFrame:
    """Data-quality view: the base's share by the string and by the fields, where both give one."""
    x = comp.with_discrete(table(spark, d, "w_dbtt")).withColumn("t", F.nullif("composition_string", F.lit("")))
    x = comp.with_formula(x, "t", "string_parts")
    base = lambda c: F.try_element_at(F.filter(c, lambda p: p["el"] == comp.BASE), F.lit(1))["f"]
    x = x.select("rec_key", rounded(base("string_parts")).alias("by_string"), rounded(base("field_parts")).alias("by_fields"))
    return x.where("by_string is not null and by_fields is not null")


def fractions_wide(spark: SparkSession, d: str) -> DataFrame:
    wide = enrich.fraction_columns(records(spark, d).where("parts is not null"), list(WIDE))
    return wide.select("rec_key", *[rounded(F.col(f"frac_{e.lower()}")).alias(f"frac_{e.lower()}") for e in WIDE])


def collected_elements(spark: SparkSession, d: str) -> DataFrame:
    return enrich.fraction_rows(records(spark, d)).select("el").distinct()


def element_cache(spark: SparkSession, d: str) -> DataFrame:
    """A cache of three elements extended by those that the records use."""
    every = elements.element_table(spark)
    cached = every.where(F.col("symbol").isin("W", "Re", "Ta"))
    used = collected_elements(spark, d).withColumnRenamed("el", "symbol")
    return elements.extend_cache(cached, used, every).select("symbol", "atomic_number", "atomic_weight")


def element_attributes(spark: SparkSession, d: str) -> DataFrame:
    return elements.attributes(elements.element_table(spark), "W")


def fraction_features_by_join(spark: SparkSession, d: str) -> DataFrame:
    """The relational form of the means: exploded compositions joined with the element dimension, one group-by.

    The planner broadcasts the dimension, of known size.
    """
    rows = enrich.fraction_rows(records(spark, d))
    dim = elements.element_table(spark).select(F.col("symbol").alias("el"), "metallic_radius", "melting_point")
    j = rows.join(dim, "el")
    mean = lambda c: F.try_divide(F.sum(F.col("frac") * F.col(c)), F.nullif(F.sum(F.when(F.col(c).isNotNull(), F.col("frac"))), F.lit(0.0)))
    return j.groupBy("rec_key").agg(rounded(mean("metallic_radius")).alias("metallic_radius"), rounded(mean("melting_point")).alias("melting_point"))


def overwritten(spark: SparkSession, d: str) -> DataFrame:
    r = records(spark, d)
    parts = F.col("parts")
    r = r.withColumns({"mix_vec": mixture.vec(parts), "mix_size": mixture.size_mismatch(parts), "mix_entropy": mixture.mixing_entropy(parts), "mix_enthalpy": mixture.mixing_enthalpy(parts)})
    o = enrich.authoritative_overwrite(r)
    return o.select("rec_key", *[rounded(F.col(c)).alias(c) for c in enrich.AUTHORITATIVE], F.size("overwritten").alias("n_overwritten"))


def enriched(spark: SparkSession, d: str) -> DataFrame:
    return enrich.enrich(spread(table(spark, d, "w_dbtt")), table(spark, d, "mp_cache"))


def enriched_features(spark: SparkSession, d: str) -> DataFrame:
    """The feature rows themselves: one per record with all features."""
    e = enriched(spark, d)
    plain = ["format_used", "dataset_scope_flag", *[c for c, t in phases.PHASE_COLUMNS.items() if t != "double"], "mp_query_skipped"]
    numbers = [*mixture.WEIGHTED, "mendeleev_a_bcc_equiv_angstrom", *enrich.AUTHORITATIVE, "usfe_linear_mixture_mj_m2", *[c for c, t in phases.PHASE_COLUMNS.items() if t == "double"]]
    return e.select("rec_key", *plain, *[rounded(F.col(c)).alias(c) for c in numbers])


def enrich_summary(spark: SparkSession, d: str) -> DataFrame:
    e = enriched(spark, d)
    return e.groupBy(F.coalesce("format_used", F.lit("none")).alias("format_used"), F.coalesce("dataset_scope_flag", F.lit("none")).alias("scope")).agg(
        F.count("*").alias("n"), F.count("mp_material_id").alias("n_phases"), rounded(F.sum("usfe_linear_mixture_mj_m2") / 1e3).alias("usfe_sum"),
    )


def feature_log(spark: SparkSession, d: str) -> DataFrame:
    return enrich.log_lines(records(spark, d))


def record_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "w_dbtt").select("rec_key", enrich.record_label().alias("label"))


def _padded(c: Column, width: int) -> Column:
    return F.when(F.length(c) >= width, c).otherwise(F.rpad(c, width, " "))


def record_summary(spark: SparkSession, d: str) -> DataFrame:
    """What is printed for each record: padded id and material, transition temperature and grain size."""
    name = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("?"))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    line = F.concat(F.lit("  "), _padded(name("record_id"), 10), F.lit("  "), _padded(name("material_name"), 20), F.lit("  DBTT="), number("dbtt_k"), F.lit("K  grain_L="), number("grain_size_l_um"), F.lit("µm"))
    return table(spark, d, "w_dbtt").select("rec_key", line.alias("line"))


def figure_summary(spark: SparkSession, d: str) -> DataFrame:
    """What is printed for each figure: padded id and type, a mark of data, the start of its description."""
    text = lambda c, other: F.coalesce(F.col(c), F.lit(other))
    mark = F.when(F.col("contains_data"), "[DATA]").otherwise("")
    line = F.concat(F.lit("  "), _padded(text("figure_id", "?"), 8), F.lit("  "), _padded(text("figure_type", "?"), 18), F.lit("  "), _padded(mark, 6), F.lit("  "), F.substring(text("description", ""), 1, 60))
    return table(spark, d, "extraction_figure").select("figure_key", line.alias("line"))


def figure_order(spark: SparkSession, d: str) -> DataFrame:
    """The main figures of each run in the order in which they are sent: sorted as text, gr10 before gr2 (O2)."""
    f = table(spark, d, "extraction_figure").where("extraction_id is not null").where(figures.main_figure(F.col("figure_id")))
    return f.groupBy("extraction_id").agg(F.array_join(F.sort_array(F.collect_set("figure_id")), ",").alias("refs"))


def formula_strings(spark: SparkSession, d: str) -> DataFrame:
    """Compositions written as formulas."""
    return records(spark, d).where("parts is not null").select("rec_key", comp.formula_string(F.col("parts")).alias("formula"))


def supplement_files(spark: SparkSession, d: str) -> DataFrame:
    """Papers with their supplements by name, or the unnamed ones (S9, J10); names are made up of the log's papers."""
    log = table(spark, d, "fetch_log").where("doi is not null")
    own = log.where("fetch_id % 3 = 0").select(F.concat(fetching.slug(F.col("doi")), F.lit("_mmc"), (F.col("fetch_id") % 2 + 1).cast("string"), F.lit(".docx")).alias("filename"))
    loose = spark.createDataFrame([("mmc1.docx",), ("mmc2.docx",), ("other.pdf",)], "filename string")
    return fetching.supplements(log.select("doi"), own.distinct().unionByName(loose))


def phase_cache(spark: SparkSession, d: str) -> DataFrame:
    docs = phases.phase_docs(table(spark, d, "mp_cache"))
    return docs.select("cache_key", F.size("docs").cast("bigint").alias("n_docs"))


def _n_elements() -> Column:
    return F.regexp_count("cache_key", F.lit("[A-Z]"))


def select_phase(spark: SparkSession, d: str) -> DataFrame:
    docs = phases.phase_docs(table(spark, d, "mp_cache"))
    s = docs.select("cache_key", phases.select_phase(F.col("docs"), _n_elements()).alias("s")).where("s is not null")
    return s.select("cache_key", F.col("s.doc.material_id").alias("material_id"), F.col("s.all_phases_found").alias("all_phases_found"), F.col("s.bcc_assumption").alias("bcc_assumption"))


def select_phase_window(spark: SparkSession, d: str) -> DataFrame:
    docs = phases.phase_docs(table(spark, d, "mp_cache")).select("cache_key", _n_elements().alias("n_elements"), F.explode("docs").alias("d"))
    return phases.select_phase_by_window(docs.select("cache_key", "n_elements", "d.*"))


def phase_lookup(spark: SparkSession, d: str) -> DataFrame:
    r = records(spark, d).where("parts is not null").select("rec_key", "parts")
    p = phases.with_phases(r, table(spark, d, "mp_cache"))
    return p.select("rec_key", "mp_material_id", "mp_formula", "mp_crystal_system", "mp_is_stable", "mp_all_phases_found", "mp_query_skipped")


def phase_off(spark: SparkSession, d: str) -> DataFrame:
    r = records(spark, d).where("parts is not null").select("rec_key", "parts")
    return phases.with_phases(r, table(spark, d, "mp_cache"), phase_source="off").select("rec_key", "mp_material_id", "mp_query_skipped")


def phase_empty(spark: SparkSession, d: str) -> DataFrame:
    return phases.empty_phases(table(spark, d, "mp_cache").select("cache_id"), "no client").select("cache_id", "mp_material_id", "mp_is_stable", "mp_query_skipped")


def phase_projection(spark: SparkSession, d: str) -> DataFrame:
    docs = phases.phase_docs(table(spark, d, "mp_cache")).select("cache_key", F.explode("docs").alias("d"))
    return docs.select("cache_key", "d.pos", "d.material_id", "d.crystal_system", "d.spacegroup", rounded(F.col("d.bulk")).alias("bulk"), rounded(F.col("d.shear")).alias("shear"))


def chemical_systems(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).where("parts is not null").groupBy(phases.chemical_system(F.col("parts")).alias("chemsys")).agg(F.count("*").alias("n"))


def phase_misses(spark: SparkSession, d: str) -> DataFrame:
    """Formula keys without an answer in the cache, with the system to search for."""
    r = records(spark, d).where("parts is not null").select("rec_key", "parts")
    return phases.missing_systems(r, table(spark, d, "mp_cache"))


def runs_and_fetches(spark: SparkSession, d: str) -> DataFrame:
    """Rows of different columns under one another."""
    return enrich.outer_union([table(spark, d, "extraction").select("doi", "model", "failure"), table(spark, d, "fetch_log").select("doi", "status", "message")])


def figure_base64(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "extraction_figure").select("figure_key", figures.encoded(F.encode("description", "UTF-8")).alias("encoded"))
    return f.withColumn("decoded", F.decode(figures.decoded(F.col("encoded")), "UTF-8"))


def reply_parse(spark: SparkSession, d: str) -> DataFrame:
    """Answers taken as replies of a model: records, failure and truncation."""
    m = table(spark, d, "mp_cache")
    reason = F.when(F.pmod("cache_id", F.lit(3)) == 0, "FinishReason.MAX_TOKENS").otherwise("STOP")
    r = m.select("cache_id", rules.parse_reply(F.col("payload"), reason, "struct<material_id:string>").alias("r"))
    return r.select("cache_id", F.when(F.col("r.records").isNotNull(), F.size("r.records")).alias("n_records"), "r.error", "r.truncated")


def _escaped(c: Column) -> Column:
    for mark, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(mark), F.lit(code))
    return c


def xml_objects(spark: SparkSession, d: str) -> DataFrame:
    """The figures of a run written as a publisher's object list and read from it."""
    f = table(spark, d, "extraction_figure").where("extraction_id is not null")
    one = F.concat(F.lit('<object ref="'), _escaped(F.coalesce("figure_id", F.lit(""))), F.lit('" category="high" type="IMAGE">u'), F.col("figure_key").cast("string"), F.lit("</object>"))
    lists = f.groupBy("extraction_id").agg(F.array_sort(F.collect_list(F.struct("figure_key", one.alias("x")))).alias("p"))
    xml = F.concat(F.lit(f'<r xmlns="{papers.SVAPI}"><objects>'), F.array_join(F.transform("p", lambda p: p["x"]), ""), F.lit("</objects></r>"))
    return papers.figure_objects(lists.select(F.col("extraction_id").cast("string").alias("doi"), xml.alias("xml"))).select("doi", "pos", "ref", "url")


def xml_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Descriptions written as the body of a paper and read from it."""
    f = table(spark, d, "extraction_figure")
    para = lambda c: F.concat(F.lit("<p>"), _escaped(F.coalesce(c, F.lit(""))), F.lit("</p>"))
    xml = F.concat(F.lit(f'<r xmlns:ja="{papers.JA}"><head>x</head><ja:body>'), para("description"), para("figure_id"), F.lit("</ja:body></r>"))
    return f.select(F.col("figure_key").cast("string").alias("doi"), papers.body_text(xml).alias("body_text"))


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the folder that all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/ferrolex-{uuid.uuid4().hex}/{name}"


def fetch_log_file(spark: SparkSession, d: str) -> DataFrame:
    """The log written as its JSON file and read back."""
    at = _folder(spark, "fetch_log.json")
    files.sink_fetch_log(table(spark, d, "fetch_log"), at)
    return files.scan_fetch_log(spark, at)


def phase_cache_files(spark: SparkSession, d: str) -> DataFrame:
    """The latest readable answer of each key written as the key's file and read back."""
    at = _folder(spark, "mp_cache")
    readable = table(spark, d, "mp_cache").where(F.col("cache_key").isNotNull() & F.try_parse_json("payload").isNotNull())
    files.sink_phase_cache(readable.groupBy("cache_key").agg(F.max_by("payload", F.struct("written_at", "cache_id")).alias("payload")), at)
    return files.scan_phase_cache(spark, at).select("cache_key", F.md5("payload").alias("payload_md5"))


def envelope_files(spark: SparkSession, d: str) -> DataFrame:
    """The records of each run written as the run's envelope and read back in order."""
    at = _folder(spark, "outputs")
    record = T.StructType([T.StructField("record_id", T.StringType()), T.StructField("vec", T.DoubleType()), T.StructField("reference_titles", T.ArrayType(T.StringType()))])
    r = table(spark, d, "w_dbtt").where("extraction_id is not null").select("extraction_id", F.struct("rec_key", *record.names).alias("r"))
    runs = r.groupBy(F.col("extraction_id").cast("string").alias("doi")).agg(F.array_sort(F.collect_list("r")).alias("records"))  # the records of one run make one file
    files.sink_envelopes(runs.select("doi", F.transform("records", lambda x: F.struct(*[x[n].alias(n) for n in record.names])).alias("records")), at)
    back = files.scan_extractions(spark, at, record)
    return files.in_file_order(back).select(F.col("_source_file").alias("source_file"), "pos", "record_id", "vec", F.size("reference_titles").alias("n_titles"))


def features_file(spark: SparkSession, d: str) -> DataFrame:
    """Labels and overwritten columns written as CSV and read back (K2)."""
    at = _folder(spark, "features.csv")
    rows = overwritten(spark, d).join(record_labels(spark, d), "rec_key").select("rec_key", "label", "vec", "delta_s_mix_j_mol_k")
    files.sink_csv(rows, at)
    return spark.read.csv(at, header=True, multiLine=True, **files.AS_WRITTEN, schema="rec_key bigint, label string, vec double, delta_s_mix_j_mol_k double")


def stable_top(spark: SparkSession, d: str) -> DataFrame:
    """The 50 documents nearest to the hull."""
    docs = nested.documents(table(spark, d, "mp_cache"))
    g = lambda p, t: F.try_variant_get("doc", p, t)
    x = docs.select("cache_id", "doc_pos", g("$.material_id", "string").alias("material_id"), g("$.energy_above_hull", "double").alias("e_hull"))
    return x.where("e_hull <= 0.1").orderBy("e_hull", "cache_id", "doc_pos").limit(50)


def manual_list(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("paper_doi is not null").groupBy(F.col("paper_doi").alias("doi")).agg(F.min("doc_id").alias("ord"))


def done(spark: SparkSession, d: str) -> DataFrame:
    """Papers with an output from their XML; those read from PDF are to be done again."""
    return table(spark, d, "extraction").where("failure is null and input_format = 'xml'")


def pending_dois(spark: SparkSession, d: str) -> DataFrame:
    return fetching.pending(table(spark, d, "fetch_log"), manual_list(spark, d), done(spark, d))


def work_union(spark: SparkSession, d: str) -> DataFrame:
    return fetching.union_of_work(table(spark, d, "fetch_log"), manual_list(spark, d)).groupBy("source").agg(F.count("*").alias("n"))


def first_wins(spark: SparkSession, d: str) -> DataFrame:
    return fetching.first_wins(fetching.union_of_work(table(spark, d, "fetch_log"), manual_list(spark, d)))


def first_wins_rank(spark: SparkSession, d: str) -> DataFrame:
    return fetching.first_wins_by_rank(fetching.union_of_work(table(spark, d, "fetch_log"), manual_list(spark, d)))


def fetch_routes(spark: SparkSession, d: str) -> DataFrame:
    doi = F.col("doi")
    return table(spark, d, "fetch_log").select(
        "fetch_id", fetching.slug(doi).alias("slug"), fetching.publisher_route(doi).alias("own_route"), fetching.paper_path(doi, F.col("status")).alias("path"),
        fetching.error_text(F.col("message")).alias("message"),
    )


def response_classes(spark: SparkSession, d: str) -> DataFrame:
    """Documents taken as answers: code from the id, body from the text."""
    code = F.element_at(F.array(*map(F.lit, (200, 200, 403, 404, 429, 500))), (F.pmod("doc_id", F.lit(6)) + 1).cast("int"))
    body = F.when(F.pmod("doc_id", F.lit(4)) == 0, F.concat(F.lit("<ce:sections>"), "text")).otherwise(F.col("text"))
    x = table(spark, d, "documents").select("doc_id", code.alias("code"), body.alias("body"))
    return x.select("doc_id", fetching.classify_response(F.col("code"), F.col("body")).alias("status"), fetching.response_message(F.col("code")).alias("message"))


def open_access_classes(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "fetch_log")
    code = F.when(F.pmod("fetch_id", F.lit(5)) == 0, 404).otherwise(200)
    pdf = F.when(F.pmod("fetch_id", F.lit(7)) == 0, 500).otherwise(200)
    x = f.select("fetch_id", code.alias("code"), pdf.alias("pdf"), F.coalesce("filename", F.lit("")).alias("u1"), F.when(F.pmod("fetch_id", F.lit(3)) == 0, F.col("doi")).alias("u2"))
    return x.select("fetch_id", fetching.classify_open_access(F.col("code"), F.col("u1"), F.col("u2"), F.col("pdf")).alias("status"), fetching.open_access_url(F.col("u1"), F.col("u2")).alias("url"))


def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return fetching.status_counts(table(spark, d, "fetch_log"))


def latest_status(spark: SparkSession, d: str) -> DataFrame:
    """The last status of each DOI as written."""
    return table(spark, d, "fetch_log").where("doi is not null").groupBy("doi").agg(F.max_by("status", F.struct("fetched_at", "fetch_id")).alias("status"))


def input_formats(spark: SparkSession, d: str) -> DataFrame:
    return fetching.input_route(table(spark, d, "extraction").where("doi is not null"), table(spark, d, "fetch_log").where("filename is not null"))


def extraction_totals(spark: SparkSession, d: str) -> DataFrame:
    return fetching.extraction_totals(table(spark, d, "extraction"), table(spark, d, "w_dbtt"))


def runs_without_records(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extraction").join(table(spark, d, "w_dbtt"), "extraction_id", "left_anti").select("extraction_id", "failure")


def figure_classes(spark: SparkSession, d: str) -> DataFrame:
    return figures.last_classes(table(spark, d, "extraction_figure"))


def kept_figures(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "extraction_figure")
    return figures.kept_figures(f, f).select("figure_key", "extraction_id", "figure_id")


def kept_counts(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "extraction_figure")
    return figures.kept_counts(f, f)


def figure_filter(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "extraction_figure").withColumn("url", F.concat(F.lit("f/"), F.coalesce("description", F.lit(""))))
    return f.where(figures.figure_filter(F.col("figure_id"), F.col("figure_type"), F.col("url"))).select("figure_key", figures.main_figure(F.col("figure_id")).alias("is_main"))


def figure_paths(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "extraction_figure").where("figure_id is not null and doi is not null")
    mime = F.when(F.col("contains_data"), "image/png; q=1").otherwise("image/jpeg")
    return f.select("figure_key", figures.figure_path(F.col("doi"), F.col("figure_id"), figures.clean_mime(mime)).alias("path"), figures.clean_mime(mime).alias("mime"))


def figure_urls(spark: SparkSession, d: str) -> DataFrame:
    """Figures pivoted to a map of categories and the preferred one chosen."""
    f = table(spark, d, "extraction_figure")
    category = F.element_at(F.array(F.lit("thumbnail"), F.lit("standard"), F.lit("high")), (F.pmod("figure_key", F.lit(3)) + 1).cast("int"))
    o = f.select("doi", F.col("figure_id").alias("ref"), category.alias("category"), F.lit("IMAGE").alias("type"), F.concat(F.lit("u"), F.col("figure_key")).alias("url"), F.col("figure_key").alias("pos"))
    return figures.url_table(o).select("doi", "ref", figures.url_choice(F.col("urls")).alias("url"), F.size("urls").cast("bigint").alias("n_urls"))


def note_tags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "w_dbtt").select("rec_key", F.explode(rules.note_tags(F.col("notes"))).alias("tag"))


def tag_counts(spark: SparkSession, d: str) -> DataFrame:
    return note_tags(spark, d).groupBy("tag").agg(F.count("*").alias("n"))


def provenance(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "w_dbtt").select("rec_key", F.explode(rules.provenance(F.col("data_from_reference"), F.col("reference_titles"))).alias("p"))
    return p.select("rec_key", "p.pos", "p.reference", "p.title")


def domain_rules(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return table(spark, d, "w_dbtt").select(
        "rec_key", rounded(rules.celsius_to_kelvin(c("deformation_temperature_k"))).alias("kelvin"), rounded(rules.range_midpoint(c("dbtt_lower_k"), c("dbtt_upper_k"))).alias("midpoint"),
        rounded(rules.range_half_width(c("dbtt_lower_k"), c("dbtt_upper_k"))).alias("half_width"), rounded(rules.log_strain(c("degree_of_cold_rolling") / 100)).alias("log_strain"),
        rules.per_cm2_to_per_m2(c("pre_existing_dislocation_density_m2")).alias("density"),
        rounded(rules.boundary_area_per_volume(c("grain_size_l_um"), c("grain_size_t_um"), c("grain_size_s_um"))).alias("boundary_area"),
    )


def composition_classes(spark: SparkSession, d: str) -> DataFrame:
    wt = F.when(F.col("dopant_concentration_unit") == "wt%", F.col("dopant_concentration")).when(F.col("dopant_or_alloying_element").isNull(), 0.0)
    return table(spark, d, "w_dbtt").select("rec_key", rules.composition_class(F.col("base_material_purity_pct"), wt).alias("class"))


def enumerations(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    bad = {
        "composition_type": rules.in_enumeration(c("composition_type"), rules.COMPOSITION_TYPES), "dopant_concentration_unit": rules.in_enumeration(c("dopant_concentration_unit"), rules.CONCENTRATION_UNITS),
        "grain_size_estimated_dimensions": rules.in_enumeration(c("grain_size_estimated_dimensions"), rules.GRAIN_DIMENSIONS),
    }
    cells = F.explode(F.array_compact(F.array(*[F.when(~ok, F.lit(n)) for n, ok in bad.items()])))
    return table(spark, d, "w_dbtt").select("rec_key", cells.alias("field_name"))


def history_steps(spark: SparkSession, d: str) -> DataFrame:
    """Steps of histories separated by semicolons, read by the schema's grammar."""
    steps = table(spark, d, "w_dbtt").select("rec_key", F.posexplode(F.split("processing_history", ";")).alias("pos", "step"))
    return steps.select("rec_key", "pos", rules.history_step(F.trim("step")).alias("s")).select("rec_key", "pos", "s.*")


def json_props(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("k_sum"), F.min("k").alias("k_min"), F.max("k").alias("k_max"))


def supplement_concat(spark: SparkSession, d: str) -> DataFrame:
    """Descriptions of a run's figures joined in order, with their length."""
    f = table(spark, d, "extraction_figure").where("extraction_id is not null")
    one = f.groupBy("extraction_id").agg(F.array_sort(F.collect_list(F.struct("figure_key", F.coalesce("description", F.lit("")).alias("t")))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: x["t"]), "\n")
    return one.select("extraction_id", F.md5(text).alias("text_md5"), F.length(text).cast("bigint").alias("n_chars"))


def order_mixtures(spark: SparkSession, d: str) -> DataFrame:
    """Mixture rules in relational form over orders: parts types as components, shares by quantity (A3, A5 at scale).

    One shuffle by order and type for the shares, one window-free second aggregate on the same key prefix.
    """
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("el"))
    q = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(p, "l_partkey")
    x = q.groupBy("l_orderkey", "el").agg(F.sum("l_quantity").alias("q"))
    n = x.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("q").alias("t"), F.sum(F.col("q") * F.ln("q")).alias("qlnq"))
    return n.select("l_orderkey", F.col("n").alias("n_components"), F.round(F.when(F.col("n") > 1, -elements.GAS_CONSTANT * (F.col("qlnq") / F.col("t") - F.ln("t"))).otherwise(0.0) + 1e-9, 4).alias("entropy"))


def queries() -> dict[str, Query]:
    parts = {
        "weighted_means": per_record(**{n: lambda p, n=n: rounded(mixture.weighted_mean(p, elements.property_map(n))) for n in mixture.WEIGHTED.values()}),
        "vec": per_record(vec=lambda p: rounded(mixture.vec(p)), missing=lambda p: label(mixture.missing_from(p, elements.literal(elements.VEC)))),
        "size_mismatch": per_record(delta=lambda p: rounded(mixture.size_mismatch(p))),
        "mixing_entropy": per_record(entropy=lambda p: rounded(mixture.mixing_entropy(p))),
        "mixing_enthalpy": per_record(enthalpy=lambda p: rounded(mixture.mixing_enthalpy(p)), n_missing=lambda p: F.size(mixture.missing_pairs(p))),
        "bcc_lattice": per_record(lattice=lambda p: rounded(mixture.bcc_lattice(p))),
        "usfe_guarded": per_record(usfe=lambda p: rounded(mixture.usfe(p)), missing=lambda p: label(F.array_sort(mixture.missing_from(p, elements.literal(elements.USFE))))),
        "heavy_alloy_flag": per_record(flag=phases.heavy_alloy_flag),
        "formula_key": per_record(formula=lambda p: phases.formula_key(phases.without_traces(p)), path=lambda p: phases.cache_path(phases.formula_key(phases.without_traces(p)))),
    }
    own = [
        scan_records, composition_parse, discrete_composition, compositions, composition_warnings, composition_formats, dopant_units, formats_compared, fractions_wide,
        collected_elements, element_cache, element_attributes, fraction_features_by_join, overwritten, enriched_features, enrich_summary, feature_log, record_labels, record_summary, figure_summary, figure_order, formula_strings, supplement_files,
        phase_cache, select_phase, select_phase_window, phase_lookup, phase_off, phase_empty, phase_projection, phase_misses, fetch_log_file, phase_cache_files, envelope_files, features_file, runs_and_fetches, figure_base64, reply_parse, xml_objects, xml_bodies, chemical_systems, stable_top, pending_dois,
        work_union, first_wins, first_wins_rank, fetch_routes, response_classes, open_access_classes, status_counts, latest_status, input_formats, extraction_totals,
        runs_without_records, figure_classes, kept_figures, kept_counts, figure_filter, figure_paths, figure_urls, note_tags, tag_counts, provenance, domain_rules,
        composition_classes, enumerations, history_steps, json_props, supplement_concat, order_mixtures,
    ]
    return parts | {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return sql_reference.oracle_sql()
