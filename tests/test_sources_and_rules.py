import base64
import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from ferrolex.functions import elements, rules
from ferrolex.operators import extraction, fetching, figures
from ferrolex.operators.enrich import log_header
from ferrolex.sources import connectors, files, papers
from ferrolex.sources.record_schema import RecordSchema, classification_prompt, load_schema
from ferrolex.streaming.incremental import run_once


def test_schema(tmp_path):
    at = tmp_path / "s.yaml"
    at.write_text("project: P\nmaterial_system: tungsten\nfields:\n- {name: a, type: float, unit: K, description: temp}\n- {name: b}\n- {name: l, type: 'list[str]'}\n- {name: a, type: int}\n")
    s = load_schema(str(at))
    assert s.name == "P" and s.struct.simpleString() == "struct<a:bigint,b:string,l:array<string>>"
    assert "- l  (return as JSON array, or null)" in s.prompt_fields() and "10.1/x" in s.extraction_prompt("10.1/x") and "EBSD" in classification_prompt(["gr1"])
    assert RecordSchema({}).name == "DynamicRecord"
    with pytest.raises(ValueError, match="decimal"):
        RecordSchema({"fields": [{"name": "x", "type": "decimal"}]})


def envelope(doi, records):
    return json.dumps({"doi": doi, "model": "m", "figure_classifications": [{"figure_id": "gr1", "figure_type": "EBSD", "description": "d", "contains_data": True}], "records": records})


def test_file_sources(spark, tmp_path):
    schema = RecordSchema({"fields": [{"name": "record_id"}, {"name": "VEC", "type": "float"}]}).struct
    (tmp_path / "b_extraction.json").write_text(envelope("d1", [{"record_id": "r1", "VEC": 6.1}, {"record_id": None}]))
    (tmp_path / "a_extraction.json").write_text(envelope("d2", {"error": "parse_failed", "finish_reason": "MAX_TOKENS", "raw": "["}))
    (tmp_path / "log.json").write_text('[{"doi": "d1", "status": "full_text"}, {"doi": "d2", "status": "error", "message": "x"}]')
    (tmp_path / "manual.json").write_text('["d3", "d4"]')
    d = str(tmp_path)
    rows = files.scan_extractions(spark, d, schema).orderBy("pos").collect()
    assert [(r._source_file, r.record_id, r.VEC) for r in rows] == [("b_extraction.json", "r1", 6.1), ("b_extraction.json", None, None)]
    assert [r.finish_reason for r in files.failed_extractions(spark, d).collect()] == ["MAX_TOKENS"]
    assert files.scan_figure_classes(spark, d).count() == 2
    assert [r.doi for r in files.scan_fetch_log(spark, f"{d}/log.json").orderBy("pos").collect()] == ["d1", "d2"]
    assert files.scan_fetch_log(spark, f"{d}/none.json").count() == 0
    assert [r.doi for r in files.scan_manual_list(spark, f"{d}/manual.json").orderBy("ord").collect()] == ["d3", "d4"]
    cache = tmp_path / "cache"
    cache.mkdir()
    (cache / "W1.0.json").write_text("[]")
    assert [tuple(r) for r in files.scan_phase_cache(spark, str(cache)).collect()] == [("W1.0", "[]")]


def test_sinks_are_read_back_by_the_sources(spark, tmp_path):
    d = str(tmp_path)
    df = spark.createDataFrame([(2, 1, "y", ["it's", None], float("nan")), (1, 1, "x, \"z\"", ["a", "b"], 0.5)], "rec_key bigint, seq int, message string, l array<string>, v double")
    files.sink_csv(df, f"{d}/c")
    assert {r.l for r in spark.read.csv(f"{d}/c", header=True, escape='"').collect()} == {"['a', 'b']", "[\"it's\", None]"}
    files.sink_csv(df, f"{d}/one.csv", single=True)
    one = spark.read.csv(f"{d}/one.csv", header=True, escape='"').collect()
    assert (tmp_path / "one.csv").is_file() and [(r.rec_key, r.message, r.v) for r in one] == [("1", 'x, "z"', "0.5"), ("2", "y", None)]
    files.sink_text(df.drop("l", "v"), f"{d}/log.txt", header=log_header(df))
    lines = (tmp_path / "log.txt").read_text().splitlines()
    assert lines[0].startswith("feature log, run at 20") and lines[1:] == ['x, "z"', "y"]
    log = spark.createDataFrame([("10.1/a", "full_text", "a.xml", "é"), ("10.1/b", "error", None, None)], files.LOG)
    files.sink_fetch_log(log, f"{d}/log.json")
    files.sink_fetch_log(log, f"{d}/log.json")
    back = files.scan_fetch_log(spark, f"{d}/log.json").orderBy("pos").drop("pos").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in log.collect()] and json.loads((tmp_path / "log.json").read_text())[1]["filename"] is None
    files.sink_fetch_log(log.limit(0), f"{d}/none.json")
    assert files.scan_fetch_log(spark, f"{d}/none.json").count() == 0
    files.sink_manual_list(log.select("doi"), f"{d}/manual.json")
    assert [r.doi for r in files.scan_manual_list(spark, f"{d}/manual.json").orderBy("ord").collect()] == ["10.1/a", "10.1/b"]
    answers = spark.createDataFrame([("W1.0", '[{"material_id": "m"}]'), ("Re/W", "[]"), ("bad", "{"), (None, "[]")], "cache_key string, payload string")
    files.sink_phase_cache(answers, f"{d}/cache")
    assert {tuple(r) for r in files.scan_phase_cache(spark, f"{d}/cache").collect()} == {("W1.0", '[{"material_id": "m"}]'), ("Re_W", "[]")}
    files.sink_binary(spark.createDataFrame([("figures/a/x.png", bytearray(b"1")), ("y", None)], "path string, payload binary"), d)
    assert (tmp_path / "figures/a/x.png").read_bytes() == b"1" and not (tmp_path / "y").exists() and not list(tmp_path.rglob("*.part"))


def test_element_cache_is_extended_refreshed_and_written_back(spark, tmp_path):
    at = str(tmp_path / "elements.csv")
    every = elements.element_table(spark)
    want = lambda *s: spark.createDataFrame([(x,) for x in s], "symbol string")
    assert {r.symbol for r in elements.build_table(spark, at, want("W", "Re", "??"), every).collect()} == {"W", "Re"}
    other = every.withColumn("density", F.lit(1.0))
    got = {r.symbol: r.density for r in elements.build_table(spark, at, want("W", "Ta"), other).collect()}
    assert got == {"W": 19.3, "Ta": 1.0} and spark.read.csv(at, schema=elements.COLUMNS, header=True).count() == 3
    assert {r.density for r in elements.build_table(spark, at, want("W"), other, force_refresh=True).collect()} == {1.0}


def test_stream_processes_each_file_once(spark, tmp_path):
    names = ["record_id", "composition_type", "composition_string", "dopant_or_alloying_element", "dopant_concentration_unit", "second_dopant_element", "second_dopant_concentration_unit"]
    schema = RecordSchema({"fields": [{"name": n} for n in names] + [{"name": n, "type": "float"} for n in ("dopant_concentration", "second_dopant_concentration")]}).struct
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    os.makedirs(src)
    answers = spark.createDataFrame([(1, "W1.0", None, '[{"material_id": "m", "energy_above_hull": 0.0}]')], "cache_id bigint, cache_key string, written_at timestamp, payload string")
    for k in range(2):
        with open(f"{src}/{k}_extraction.json", "w") as f:
            f.write(envelope(f"d{k}", [{"record_id": f"r{k}", "composition_string": "W0.95Ni0.035Fe0.015"}, {"record_id": "p", "composition_string": "W1"}]))
        run_once(spark, src, schema, out, check, answers).awaitTermination()
        rows = spark.read.parquet(out).where("record_id <> 'p'").collect()
        assert len(rows) == k + 1 and all(round(r.mix_vec, 3) == 6.17 and r.dataset_scope_flag and r.mp_query_skipped.startswith("heavy") for r in rows)
        assert {r.mp_material_id for r in spark.read.parquet(out).where("record_id = 'p'").collect()} == {"m"}


ATTACHED = f'<r xmlns:x="{papers.XOCS}"><body/><x:attachment><x:attachment-eid>1-s2.0-mmc1.docx</x:attachment-eid></x:attachment><x:attachment><x:attachment-eid>1-x.mp4</x:attachment-eid></x:attachment></r>'
BODY = f'<doc xmlns:ja="{papers.JA}"><ja:body><p>a<b>c<i>d</i>e</b>f</p></ja:body></doc>'


def test_papers(spark):
    assert papers.body_text_of(BODY) == "a c f d e" and papers.body_text_of("<x>") is None and papers.body_text_of("<x> a <y>b</y></x>") == " a  b"
    xml = f'<r xmlns="{papers.SVAPI}"><objects><object ref="gr1" category="high" type="I">u1</object><object ref="gr10" category="high" type="I">u2</object><object ref="si1" category="high" type="I">u3</object><object ref="gr1" category="high" type="I">u4</object><object ref="gr2" category="thumbnail" type="I">x.SVG</object></objects></r>'
    df = spark.createDataFrame([("10.1/a", xml), ("10.1/b", None), ("10.1/c", "<")], "doi string, xml string")
    urls = figures.url_table(papers.figure_objects(df)).orderBy("ref").collect()
    assert [(r.ref, r.urls["high"]) for r in urls] == [("gr1", "u4"), ("gr10", "u2")]
    assert papers.attachments_of(ATTACHED) == ["1-s2.0-mmc1.docx"]
    w = papers.WORD[1:-1]
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body><w:p><w:r><w:t> x </w:t></w:r></w:p><w:p/><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p/></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>')
    assert papers.docx_text_of(buffer.getvalue()) == "x\na | b" and papers.docx_text_of(b"no") == ""
    texts = spark.createDataFrame([("d", "b.docx", "two"), ("d", "a.docx", "one"), ("e", "c.docx", None)], "doi string, filename string, text string")
    got = {r.doi: r for r in papers.supplement_text(texts).collect()}
    assert got["d"].supp_text.index("one") < got["d"].supp_text.index("two") and got["d"].supp_chars == len(got["d"].supp_text)
    pages = papers.pdf_pages(spark.createDataFrame([("d", bytearray(b"ab"))], "doi string, pdf binary"), lambda pdf: [bytes([b]) for b in pdf])
    assert [(r.label, r.mime) for r in pages.collect()] == [("page_1", "image/png"), ("page_2", "image/png")]
    assert spark.createDataFrame([(BODY,), (None,)], "x string").select(papers.body_text(F.col("x"))).collect()[0][0] == "a c f d e"


def recorded(folder):
    """A transport that answers from a record and notes what it was asked."""

    def transport(url, params, headers, timeout):
        with open(os.path.join(folder, "asked.txt"), "a") as f:
            f.write(f"{url} {params} {headers} {timeout}\n")
        if "bad" in url:
            raise TimeoutError("slow")
        if "lookup" in url:
            return 200, json.dumps({"best_oa_location": {"url_for_pdf": "pdf://x", "url": "", "host_type": "repository"} if "open" in url else None}).encode(), "application/json"
        if url.startswith("object/"):
            return 200, b"docx", "application/x"
        if url.startswith("pdf"):
            return 200, b"%PDF", "application/pdf"
        if url.startswith("fig"):
            return (200, url.encode(), "image/png; q=1") if "lost" not in url else (500, b"", "")
        if "busy" in url or "no" in url:
            return (429, b"", "") if "busy" in url else (403, b"x" * 900, "")
        return 200, ATTACHED.replace("<body/>", "<body>t</body>").encode() if "abstract" not in url else b"<x/>", "text/xml"

    return transport


def asked(folder):
    with open(os.path.join(folder, "asked.txt")) as f:
        return f.read().splitlines()


def test_fetch_keeps_bodies_and_asks_once(spark, tmp_path):
    d = str(tmp_path)
    names = ["10.1016/a", "10.1016/bad", "10.1016/busy", "10.1016/no", "10.1016/abstract", "10.2/open", "10.2/closed"]
    dois = spark.createDataFrame([(x,) for x in [*names, "10.1016/a", None]], "doi string")
    fetched = connectors.fetch(dois, recorded(d), "article/", "lookup/", 0.0, key="k")
    got = {r.doi: r for r in fetched.collect()}
    assert [got[x].status for x in names] == ["full_text", "error", "error", "error", "abstract_only", "pdf_downloaded", "no_oa_pdf"] and len(got) == 7
    assert got["10.1016/a"].filename == "10-1016_a.xml" and "TimeoutError" in got["10.1016/bad"].message and got["10.1016/busy"].message == "rate limited"
    assert got["10.2/open"].message == "PDF from repository source" and got["10.1016/busy"].filename is None
    files.write_files(connectors.files_of(fetched), d)
    assert (tmp_path / "10-1016_a.xml").read_bytes().endswith(b"</r>") and (tmp_path / "10-2_open.pdf").read_bytes() == b"%PDF"
    assert (tmp_path / "10-1016_abstract_abstract_only.xml").read_bytes() == b"<x/>" and len((tmp_path / "10-1016_no_error.txt").read_text()) < 560
    files.sink_fetch_log(connectors.log_of(fetched), f"{d}/log.json")
    assert files.scan_fetch_log(spark, f"{d}/log.json").count() == 7
    files.write_files(connectors.fetch_supplements(fetched, recorded(d), "object/", "k"), d)
    assert (tmp_path / "10-1016_a_mmc1.docx").read_bytes() == b"docx"
    lines = asked(d)
    assert len(lines) == len(set(lines)) == 9 and any("article/10.1016/a {'view': 'FULL'} {'Accept': 'text/xml', 'X-ELS-APIKey': 'k'} 30.0" in x for x in lines)


PAPER = f'''<r xmlns="{papers.SVAPI}" xmlns:ja="{papers.JA}"><ja:body>text</ja:body><objects><object ref="gr10" category="high" type="I">fig/10</object>
<object ref="gr2" category="thumbnail" type="I">fig/2t</object><object ref="gr2" category="standard" type="I">fig/2s</object><object ref="gr1" category="high" type="I">fig/lost</object>
<object ref="ga1" category="high" type="I">fig/ga</object></objects></r>'''


def model():
    """A client that answers by rule."""

    def client(prompt, parts, options):
        if "10.1/boom" in prompt:
            raise ValueError("boom")
        if options["max_output_tokens"] == 4096:
            assert "gr10" in prompt or "page_1" in prompt
            return json.dumps([{"figure_id": "gr2", "figure_type": "map"}, {"figure_id": "gr2", "figure_type": "EBSD", "contains_data": True}]) if "gr2" in prompt else "oops", "STOP"
        if "10.1/cut" in prompt:
            return '[{"record_id": "r', "MAX_TOKENS"
        assert ("=== PAPER BODY TEXT ===\ntext" in prompt) == ("10.1/xml" in prompt) and ("SUPPLEMENTARY: a_mmc1.docx" in prompt) == ("10.1/xml" in prompt)
        return json.dumps([{"record_id": p["label"], "VEC": float(len(p["payload"]))} for p in parts]), "STOP"

    return client


def test_extraction_from_files_to_envelopes(spark, tmp_path):
    d = str(tmp_path)
    assert base64.b64encode(spark.range(1).select(F.unbase64(F.base64(F.lit(bytearray(b"\x00\xff")))).alias("x")).first().x) == b"AP8="
    schema = RecordSchema({"fields": [{"name": "record_id"}, {"name": "VEC", "type": "float"}]})
    rows = [("10.1/xml", PAPER, None), ("10.1/pdf", None, bytearray(b"abcdefghijk")), ("10.1/none", None, None), ("10.1/cut", "<x>y</x>", None), ("10.1/boom", "<x/>", bytearray(b"a"))]
    given = spark.createDataFrame(rows, "doi string, xml string, pdf binary")
    supp = spark.createDataFrame([("10.1/xml", "a_mmc1.docx", bytearray(b"no docx"))], "doi string, filename string, data binary")
    e = extraction.extract(given, schema, model(), "m", supp, recorded(d), lambda pdf: [bytes([b]) for b in pdf])
    got = {r.doi: r for r in e.envelopes.drop("records").collect()}
    assert {k: r.failure for k, r in got.items()} == {"10.1/xml": None, "10.1/pdf": None, "10.1/none": "no paper file", "10.1/cut": "parse_failed: truncated", "10.1/boom": "ValueError: boom"}
    assert got["10.1/xml"].n_content_parts == 2 and got["10.1/pdf"].n_content_parts == 11 and got["10.1/xml"].supp_chars == len("\n\n=== SUPPLEMENTARY: a_mmc1.docx ===\n\n")
    found = [(r._doi, r.record_id) for r in files.in_file_order(e.records).collect()]
    assert found[:3] == [("10.1/pdf", "page_1"), ("10.1/pdf", "page_2"), ("10.1/pdf", "page_3")] and found[-2:] == [("10.1/xml", "gr10"), ("10.1/xml", "gr2")]
    assert [(r.path, bytes(r.payload)) for r in e.figure_files.collect()] == [("figures/10-1_xml/10-1_xml_gr2.png", b"fig/2s")]
    assert e.totals().first().asDict() == {"n_papers": 5, "n_succeeded": 2, "n_failed": 3, "n_records": 13}
    files.sink_envelopes(extraction.envelope_files(e), f"{d}/out")
    assert sorted(os.listdir(f"{d}/out")) == ["10-1_boom_extraction.json", "10-1_cut_extraction.json", "10-1_pdf_extraction.json", "10-1_xml_extraction.json"]
    with open(f"{d}/out/10-1_xml_extraction.json") as f:
        one = json.load(f)
    assert list(one) == ["model", "doi", "input_format", "n_content_parts", "supp_chars", "figures_dir", "figure_classifications", "records"]
    back = files.in_file_order(files.scan_extractions(spark, f"{d}/out", schema.struct)).collect()
    assert [(r._doi, r.record_id, r.VEC) for r in back] == [(r._doi, r.record_id, r.VEC) for r in files.in_file_order(e.records).collect()]
    assert {(r.error, r.finish_reason) for r in files.failed_extractions(spark, f"{d}/out").collect()} == {("parse_failed", "MAX_TOKENS"), ("parse_failed", None)}
    assert sum("fig/" in x for x in asked(d)) == 3


def test_other_connectors(spark):
    found = connectors.phase_search(spark.createDataFrame([("Re-W",), ("bad",)], "chemsys string"), lambda u, p, h, t: (200, json.dumps([{"material_id": p["elements"] + p["num_elements"]}]).encode(), "") if "Re" in p["elements"] else (500, b"", ""), "u")
    got = {r.chemsys: r for r in found.collect()}
    assert "Re,W2" in got["Re-W"].payload and got["bad"].error == "status 500"
    energies = connectors.formation_energies(spark, lambda u, p, h, t: (200, b'{"data": [{"name": "a", "delta_e": -1.0, "stability": -0.1}, {"name": "b", "delta_e": 1.0, "stability": 0.2}]}', ""), "u", "W,Re")
    assert [r.name for r in energies.collect()] == ["a"]


def test_rules_and_fetching(spark):
    one = spark.range(1)
    v = lambda c: one.select(c.alias("x")).first().x
    assert v(fetching.slug(F.lit("10.1016/j.jmst.2026.01.050"))) == "10-1016_j-jmst-2026-01-050"
    assert v(figures.extension(F.lit("image/png; q=1"))) == "png" and v(figures.clean_mime(F.lit("image/png; q=1"))) == "image/png" and v(figures.clean_mime(F.lit(""))) == "image/jpeg"
    assert round(v(rules.log_strain(F.lit(0.5))), 6) == 0.693147 and v(rules.log_strain(F.lit(1.0))) is None and round(v(rules.log_strain(F.lit(0.5), F.lit(2))), 6) == 1.386294
    assert v(rules.boundary_area_per_volume(F.lit(2.0), F.lit(4.0), F.lit(None).cast("double"))) is None
    assert v(rules.note_tags(F.lit("[a_b] x [graph_read][high]"))) == ["a_b", "graph_read", "high"] and v(rules.graph_confidence(F.lit("[graph_read][low]"))) == "low"
    step = v(rules.history_step(F.lit("rolled at 900 °C, 30 %, 4_passes")))
    assert (step.method, step.temperature_k, step.reduction_pct, step.passes) == ("rolled", 1173.15, 30.0, 4.0)
    assert v(rules.provenance(F.array(F.lit("[1]"), F.lit("[2]")), F.array(F.lit("t"))))[1].title is None
    reply = v(rules.parse_reply(F.lit('[{"a": 1}]'), F.lit("STOP"), "struct<a:int>"))
    assert reply.records[0].a == 1 and reply.error is None
    bad = v(rules.parse_reply(F.lit("["), F.lit("MAX_TOKENS"), "struct<a:int>"))
    assert bad.records is None and bad.error == "parse_failed" and bad.truncated
    log = spark.createDataFrame([(1, "10.1/a", "full_text"), (2, "10.1/b", "pdf_downloaded"), (3, "10.1/c", "full_text"), (4, "10.1/c", "error"), (5, None, "full_text")], "fetch_id int, doi string, status string")
    manual = spark.createDataFrame([("10.1/z", 0), ("10.1/a", 1)], "doi string, ord int")
    done = spark.createDataFrame([("10.1/b",)], "doi string")
    todo = fetching.pending(log, manual, done).orderBy("source", "ord").collect()
    assert [r.doi for r in todo] == ["10.1/a", "10.1/c", "10.1/z"]
    assert fetching.status_counts(log).first().asDict() == {"n_total": 5, "n_full_text": 3, "n_abstract_only": 0, "n_error": 1, "n_other": 1}
    names = spark.createDataFrame([("10-1_a_mmc2.docx",), ("10-1_a_mmc1.docx",), ("mmc9.docx",), ("10-1_a.pdf",)], "filename string")
    supp = sorted(tuple(r) for r in fetching.supplements(log, names).where("doi in ('10.1/a', '10.1/b')").collect())
    assert supp == [("10.1/a", "10-1_a_mmc1.docx"), ("10.1/a", "10-1_a_mmc2.docx"), ("10.1/b", "mmc9.docx")]
    assert {r.doi: r.input_format for r in fetching.input_route(log.where("doi is not null"), names).collect()} == {"10.1/a": "pdf", "10.1/b": None, "10.1/c": None}
