import json

import pytest

from ferrolex.functions.schema_graph import inline, parse_schema
from ferrolex.operators.nested import flat_tables, leaf_paths

ROOTS = ("symmetry", "bulk_modulus", "origins")
DOC = {"material_id": "m", "symmetry": {"number": 229, "symbol": None, "a.b": "x"}, "origins": [{"name": "e", "task_id": None}, None, {"name": "f"}], "bulk_modulus": None}


def answers(spark, *payloads):
    return spark.createDataFrame([(i, "k", p, "o", "d") for i, p in enumerate(payloads)], "cache_id bigint, cache_key string, payload string, outer_form string, docs string")


def test_outer_forms(spark):
    one = json.dumps(DOC)
    df = answers(spark, f"[{one}, null, {one}]", json.dumps({"meta": {}, "data": [DOC]}), one, "[]", "null", "", None, one[:-9], '{"error": "x"}', '"text"', json.dumps({"data": DOC}))
    got = {(r.cache_id, r.doc_pos) for r in leaf_paths(df, ROOTS).collect()}
    assert got == {(0, 0), (0, 2), (1, 0), (2, 0), (10, 0)}
    paths = {r.leaf_path for r in leaf_paths(df, ROOTS).where("cache_id = 2").collect()}
    assert paths == {"symmetry.number", "symmetry.a.b", "origins[0].name", "origins[2].name"}
    t = flat_tables(df)
    forms = [r.outer_form for r in t["answer"].orderBy("cache_id").collect()]
    assert forms == ["list", "wrapped", "document", "list", "scalar", "empty", "empty", "broken", "failed", "scalar", "wrapped"]
    links = {(r.cache_id, r.doc_pos) for r in t["document"].collect()}
    assert {(r.cache_id, r.doc_pos) for r in t["document_origins"].collect()} <= links


def test_mixed_types_and_long_documents(spark):
    df = answers(spark, json.dumps([{"symmetry": {"number": 1}}, {"symmetry": {"number": "x"}}, {"symmetry": {"number": {"deep": 1}}}, {"symmetry": {"number": "y" * 200_000}}]))
    got = {(r.doc_pos, r.leaf_path) for r in leaf_paths(df, ROOTS).collect()}
    assert got == {(0, "symmetry.number"), (1, "symmetry.number"), (2, "symmetry.number.deep"), (3, "symmetry.number")}


def test_members_of_several_kinds_are_found_in_all_documents(spark):
    docs = [
        {"material_id": "a", "symmetry": {"number": 1, "deep": {"x": 1}}, "origins": [{"name": "e"}, "odd", [["p", {"q": 2}], 3]], "bulk_modulus": {"vrh": 1}},
        {"material_id": "b", "symmetry": "cubic", "origins": "n/a", "bulk_modulus": [1.5, None, {"vrh": 2}]},
        {"material_id": "c", "symmetry": {"number": {"of": [7]}, "deep": "y"}, "origins": [{"name": {"first": "f"}}]},
    ]
    df = answers(spark, json.dumps(docs), json.dumps([[1], "x", docs[0]]))
    first = {"symmetry.number", "symmetry.deep.x", "origins[0].name", "origins[1]", "origins[2][0][0]", "origins[2][0][1].q", "origins[2][1]", "bulk_modulus.vrh"}
    got = [(r.cache_id, r.doc_pos, r.leaf_path) for r in leaf_paths(df, ROOTS).collect()]
    assert len(got) == len(set(got))
    assert {p for c, d, p in got if (c, d) == (0, 0)} == {p for c, d, p in got if (c, d) == (1, 2)} == first
    assert {p for c, d, p in got if (c, d) == (0, 1)} == {"bulk_modulus[0]", "bulk_modulus[2].vrh"}
    assert {p for c, d, p in got if (c, d) == (0, 2)} == {"symmetry.number.of[0]", "symmetry.deep", "origins[0].name.first"}
    t = flat_tables(df)
    rows = {(r.cache_id, r.doc_pos): r for r in t["document"].collect()}
    assert rows[0, 1].symmetry == '"cubic"' and rows[0, 0].symmetry is None and rows[0, 0].symmetry_number == "1" and rows[0, 0].symmetry_deep_x == 1
    assert {(r.pos, r.name) for r in t["document_origins"].where("cache_id = 0 and doc_pos = 0").collect()} == {(0, '"e"'), (1, None), (2, None)}


def test_wrappers_are_known_by_their_form(spark):
    docs = [
        {"entries": [DOC, None, DOC], "tags": []}, {"answer": {"found": [DOC]}}, {"answer": {"found": DOC}}, {"rows": []}, {"error": "x", "rows": []},
        {"list": [{"other": 1}]}, {"meta": {"n": 0}},
    ]
    t = flat_tables(answers(spark, *map(json.dumps, docs)))["answer"]
    assert [(r.outer_form, r.n_documents) for r in t.orderBy("cache_id").collect()] == [
        ("wrapped", 3), ("wrapped", 1), ("wrapped", 1), ("wrapped", 0), ("failed", 0), ("wrapped", 1), ("failed", 0),
    ]


def test_a_shared_element_has_one_table_with_keys_of_its_parents(spark):
    docs = [{"material_id": "m", "a": {"link": {"x": 1}}, "b": [{"link": {"x": 2, "y": "z"}}, {"link": [{"x": 3}]}], "part": {"n": 1, "part": {"n": 2}}}, {"a": {"link": 7}}]
    t = flat_tables(answers(spark, json.dumps(docs)))
    got = {(r.doc_pos, r.node, r.parent_table, r.parent_node, r.pos, r.x, r.y) for r in t["link"].collect()}
    assert got == {(0, "a.link", "document", "", None, 1, None), (0, "b[0].link", "document_b", "b[0]", None, 2, "z"), (0, "b[1].link[0]", "document_b", "b[1]", 0, 3, None)}
    assert {(r.node, r.parent_table, r.parent_node, r.n) for r in t["part"].collect()} == {("part", "document", "", 1), ("part.part", "part", "part", 2)}
    for name, df in t.items():
        if name not in ("answer", "document"):
            for r in df.collect():
                assert t[r.parent_table].where((t[r.parent_table].doc_pos == r.doc_pos) & (t[r.parent_table].node == r.parent_node)).count() == 1
    paths = {(r.doc_pos, r.leaf_path) for r in leaf_paths(answers(spark, json.dumps(docs)), ("a", "b", "part")).collect()}
    assert paths == {(0, "a.link.x"), (0, "b[0].link.x"), (0, "b[0].link.y"), (0, "b[1].link[0].x"), (0, "part.n"), (0, "part.part.n"), (1, "a.link")}


def test_empty(spark):
    assert leaf_paths(answers(spark), ROOTS).count() == 0
    assert leaf_paths(answers(spark, "[]"), ROOTS).count() == 0


def test_shared_and_recursive_elements_get_tables():
    root = parse_schema("OBJECT<a: OBJECT<link: OBJECT<x: BIGINT>>, b: OBJECT<link: OBJECT<x: BIGINT>>, c: OBJECT<c: OBJECT<y: STRING>>, d: ARRAY<DECIMAL(4,1)>, `e f`: DOUBLE>")
    names = [t.name for t in inline(root, "r").every()]
    assert names.count("link") == 2 and "r_d" in names and "c" in names
    with pytest.raises(ValueError):
        parse_schema("BIGINT> x")
