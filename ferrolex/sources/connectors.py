"""Remote sources behind injected transports: without one nothing leaves the machine.

A transport is a picklable callable (url, parameters, headers, timeout in seconds) -> (status code, body, content type). A
model client is a picklable callable (prompt, parts, options) -> (text, finish reason). A row that fails carries its
error; other rows go on. Answers are stored in the shared folder, bodies included, when they have been asked for, so that
no later step asks again. All requests of one call go through `lanes` partitions, each with its own delay: one lane keeps
the delay for the host as a whole.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrolex.operators import fetching, figures
from ferrolex.session import cut
from ferrolex.sources import papers as paper_files

Transport = Callable[[str, dict, dict, float], tuple[int, bytes, str]]
Client = Callable[[str, list, dict], tuple[str, str]]

# Timeouts in seconds, the delay between papers and the wait after status 429.
ARTICLE_TIMEOUT, LOOKUP_TIMEOUT, PDF_TIMEOUT, FIGURE_TIMEOUT, SUPPLEMENT_TIMEOUT = 30.0, 15.0, 30.0, 30.0, 60.0
DELAY, WAIT_ON_429 = 2.0, 30.0
# How the article is asked for, and the options of the two calls of a model.
ARTICLE_PARAMS, ARTICLE_HEADERS = {"view": "FULL"}, {"Accept": "text/xml"}
CLASSIFY_OPTIONS = {"temperature": 0.0, "max_output_tokens": 4096, "response": "json"}
EXTRACT_OPTIONS = {"temperature": 0.0, "max_output_tokens": 65536, "response": "json"}
KEY_HEADER = "X-ELS-APIKey"


def get(requests: DataFrame, transport: Transport, timeout: float = 30.0, delay: float = 0.0, wait_on_429: float = 0.0, headers: dict | None = None, lanes: int = 1) -> DataFrame:
    """Adds code, body, content_type and error to rows (url, params map<string,string>); rows without a url are not asked.

    The result is stored: each url is asked once, however often the result is read.
    """
    extra = [T.StructField("code", T.IntegerType()), T.StructField("body", T.BinaryType()), T.StructField("content_type", T.StringType()), T.StructField("error", T.StringType())]
    schema = T.StructType(requests.schema.fields + extra)
    own = dict(headers or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = True
        for b in batches:
            rows = []
            for url, params in zip(b["url"], b["params"]):
                if not url:
                    rows.append((None, None, None, None))
                    continue
                if not first and delay:
                    time.sleep(delay)
                first = False
                try:
                    code, body, kind = transport(url, dict(params) if params is not None else {}, own, timeout)
                    if code == 429 and wait_on_429:
                        time.sleep(wait_on_429)
                    rows.append((code, body, kind, None))
                except Exception as e:  # one bad request never ends the others
                    rows.append((None, None, None, f"{type(e).__name__}: {e}"))
            new = pd.DataFrame(rows, columns=["code", "body", "content_type", "error"], index=b.index, dtype=object)
            yield b.assign(code=new["code"].astype("Int32"), body=new["body"], content_type=new["content_type"], error=new["error"])

    return cut(requests.repartition(max(1, lanes)).mapInPandas(run, schema))


def _params(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair]) if values else F.lit(None).cast("map<string,string>")


def fetch(dois: DataFrame, transport: Transport, article_url: str, lookup_url: str, delay: float = DELAY, key: str | None = None, lookup_params: dict | None = None) -> DataFrame:
    """doi, status, filename, message, body, code: each DOI once, by the publisher's interface or by open access.

    `body` is the XML or PDF; of an error the text of its file. `log_of` is the log of it, `files_of` its files.
    """
    each = dois.where("doi is not null").select("doi").distinct()
    headers = ARTICLE_HEADERS | ({KEY_HEADER: key} if key else {})
    routed = each.select("doi", fetching.publisher_route(F.col("doi")).alias("own"))
    asked = routed.where("own").select("doi", F.concat(F.lit(article_url), F.trim("doi")).alias("url"), _params(ARTICLE_PARAMS).alias("params"))
    own = get(asked, transport, ARTICLE_TIMEOUT, delay, WAIT_ON_429 if delay else 0.0, headers)
    text = F.col("body").cast("string")
    status = F.when(F.col("error").isNotNull(), "error").otherwise(fetching.classify_response(F.col("code"), text))
    failed = F.concat(F.lit("HTTP "), F.col("code").cast("string"), F.lit("\nDOI: "), F.col("doi"), F.lit("\nResponse: "), fetching.error_text(text))
    said = F.when(status == "full_text", F.concat(F.lit("full text, "), F.length(text), F.lit(" characters"))).when(status == "abstract_only", F.lit("abstract only"))
    a = own.select(
        "doi", "code", status.alias("status"), F.coalesce("error", fetching.response_message(F.col("code")), said).alias("message"),
        F.when(status != "error", F.col("body")).when(F.col("code").isNotNull() & (F.col("code") != 429), failed.cast("binary")).alias("body"),
    )
    asked = routed.where("not own").select("doi", F.concat(F.lit(lookup_url), F.trim("doi")).alias("url"), _params(lookup_params or {}).alias("params"))
    look = get(asked, transport, LOOKUP_TIMEOUT, delay)
    answer = F.from_json(F.col("body").cast("string"), "best_oa_location struct<url_for_pdf:string,url:string,host_type:string>")["best_oa_location"]
    found = look.select(
        "doi", F.col("code").alias("code0"), F.col("error").alias("error0"), answer["url_for_pdf"].alias("u1"), answer["url"].alias("u2"), answer["host_type"].alias("host_type"),
    )
    link = F.when(F.col("code0") == 200, fetching.open_access_url(F.col("u1"), F.col("u2")))
    pdf = get(found.select("*", link.alias("url"), _params({}).alias("params")), transport, PDF_TIMEOUT, delay)
    s = F.when(F.coalesce("error0", "error").isNotNull(), "error").otherwise(fetching.classify_open_access(F.col("code0"), F.col("u1"), F.col("u2"), F.col("code")))
    manual = F.concat(F.lit("no open copy; save the PDF as "), fetching.slug(F.col("doi")), F.lit(".pdf"))
    source = F.concat(F.lit("PDF from "), F.coalesce("host_type", F.lit("unknown")), F.lit(" source"))
    code = F.coalesce(F.when(F.col("code0") != 200, F.col("code0")), F.col("code"))
    message = F.coalesce("error0", "error", F.when(s == "no_oa_pdf", manual).when(s == "pdf_downloaded", source).otherwise(F.concat(F.lit("status "), code.cast("string"))))
    b = pdf.select("doi", code.alias("code"), s.alias("status"), message.alias("message"), F.when(s == "pdf_downloaded", F.col("body")).alias("body"))
    every = a.unionByName(b)
    name = F.coalesce(fetching.paper_path(F.col("doi"), F.col("status")), F.when((F.col("status") == "error") & F.col("body").isNotNull(), fetching.error_path(F.col("doi"))))
    return every.select("doi", "status", name.alias("filename"), "message", "body", "code")


def log_of(fetched: DataFrame) -> DataFrame:
    """doi, status, filename, message: the log of a fetch, as `sink_fetch_log` writes it."""
    return fetched.select("doi", "status", "filename", "message")


def files_of(fetched: DataFrame) -> DataFrame:
    """path, payload: the paper and error files of a fetch, for `write_files`."""
    return fetched.where("filename is not null and body is not null").select(F.col("filename").alias("path"), F.col("body").alias("payload"))


def fetch_supplements(fetched: DataFrame, transport: Transport, object_url: str, key: str | None = None) -> DataFrame:
    """doi, path, payload, code, error: the attachments (.docx, .pdf) of full texts, named {slug}_{last part of the identifier}."""
    xml = fetched.where("status = 'full_text'").select("doi", F.col("body").cast("string").alias("xml"))
    listed = paper_files.attachments(xml)
    asked = listed.select("doi", "eid", F.concat(F.lit(object_url), "eid").alias("url"), _params({}).alias("params"))
    got = get(asked, transport, SUPPLEMENT_TIMEOUT, headers={KEY_HEADER: key} if key else {})
    path = F.concat(fetching.slug(F.col("doi")), F.lit("_"), F.element_at(F.split("eid", "-"), -1))
    return got.select("doi", path.alias("path"), F.when(F.col("code") == 200, F.col("body")).alias("payload"), "code", "error")


def fetch_figures(papers: DataFrame, transport: Transport, key: str | None = None) -> DataFrame:
    """doi, label, payload, mime of the main figures of papers (doi, xml), each at its best size; a failed one is left out."""
    urls = figures.url_table(paper_files.figure_objects(papers)).where(figures.main_figure(F.col("ref")))
    asked = urls.select("doi", F.col("ref").alias("label"), figures.url_choice(F.col("urls")).alias("url"), _params({}).alias("params")).where("url is not null")
    got = get(asked, transport, FIGURE_TIMEOUT, headers={KEY_HEADER: key} if key else {})
    return got.where("code = 200").select("doi", "label", F.col("body").alias("payload"), figures.clean_mime(F.col("content_type")).alias("mime"))


def xml_content(papers: DataFrame, transport: Transport | None, key: str | None = None) -> DataFrame:
    """doi, body_text, parts: array<struct<label, payload, mime>> in the order of their labels, of papers (doi, xml)."""
    text = papers.select("doi", paper_files.body_text(F.col("xml")).alias("body_text"))
    if transport is None:
        return text.withColumn("parts", F.array().cast(PARTS))
    return text.join(gathered_parts(fetch_figures(papers, transport, key)), "doi", "left").withColumn("parts", F.coalesce("parts", F.array().cast(PARTS)))


PARTS = "array<struct<label:string,payload:binary,mime:string>>"


def gathered_parts(parts: DataFrame) -> DataFrame:
    """doi, parts: the figures or pages of each paper; labels are sorted as text (gr1, gr10, gr2), pages by number."""
    page = F.coalesce(F.regexp_extract("label", r"^page_(\d+)$", 1).try_cast("int"), F.lit(0))
    one = F.struct(page.alias("n"), F.col("label"), F.col("payload"), F.col("mime"))
    ordered = F.array_sort(F.collect_list(one))
    return parts.groupBy("doi").agg(F.transform(ordered, lambda p: F.struct(p["label"].alias("label"), p["payload"].alias("payload"), p["mime"].alias("mime"))).alias("parts"))


def ask(prompts: DataFrame, client: Client, options: dict | None = None, lanes: int | None = None) -> DataFrame:
    """doi, reply, finish_reason, error of rows (doi, prompt, parts array<struct<label,payload,mime>>); stored like answers."""
    own = dict(options or EXTRACT_OPTIONS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doi, prompt, parts in zip(b["doi"], b["prompt"], b["parts"]):
                try:
                    text, reason = client(prompt, list(parts) if parts is not None else [], own)
                    rows.append((doi, text, reason, None))
                except Exception as e:
                    rows.append((doi, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["doi", "reply", "finish_reason", "error"])

    asked = prompts.select("doi", "prompt", "parts")
    asked = asked.repartition(lanes) if lanes else asked
    return cut(asked.mapInPandas(run, "doi string, reply string, finish_reason string, error string"))


def phase_search(systems: DataFrame, transport: Transport, url: str) -> DataFrame:
    """chemsys, payload: documents of exactly these elements, one request per system with only the fields needed."""
    fields = "material_id,formula_pretty,symmetry,formation_energy_per_atom,energy_above_hull,bulk_modulus,shear_modulus,is_stable"
    n = F.size(F.split("chemsys", "-")).cast("string")
    params = F.create_map(F.lit("elements"), F.replace(F.col("chemsys"), F.lit("-"), F.lit(",")), F.lit("num_elements"), n, F.lit("fields"), F.lit(fields))
    asked = get(systems.select("chemsys").distinct().select("chemsys", F.lit(url).alias("url"), params.alias("params")), transport)
    failed = F.coalesce("error", F.when(F.col("code") != 200, F.concat(F.lit("status "), F.col("code").cast("string"))))
    return asked.select("chemsys", F.when(F.col("code") == 200, F.col("body").cast("string")).alias("payload"), failed.alias("error"))


def formation_energies(spark, transport: Transport, url: str, elements: str, limit: int = 50) -> DataFrame:
    """name, delta_e, stability of stable compounds of some elements, at most `limit` as the service is asked."""
    one = spark.createDataFrame([(url, {"element_set": elements, "stability__lte": "0", "fields": "name,delta_e,stability", "limit": str(limit)})], "url string, params map<string,string>")
    data = F.from_json(F.col("body").cast("string"), "data array<struct<name:string,delta_e:double,stability:double>>")["data"]
    return get(one, transport).select(F.explode(data).alias("d")).select("d.*").where("stability <= 0").limit(limit)
