import json

from pyspark.sql import functions as F

from ferrolex.operators import drift
from ferrolex.sources.tables import table


def feed(spark, *files, names=None):
    f = [(i + 1, "feed", i + 1, f"f{i}", len(rs)) for i, rs in enumerate(files)]
    r = [(100 * i + k, i + 1, k, p if isinstance(p, str) or p is None else json.dumps(p)) for i, rs in enumerate(files) for k, p in enumerate(rs)]
    return (
        spark.createDataFrame(f, "file_id bigint, feed_name string, seq_no int, file_name string, n_records int"),
        spark.createDataFrame(r, "raw_id bigint, file_id bigint, line_no int, payload string"),
    )


def rec(i, **members):
    return {"record_id": f"W-{i}"} | members


def changes(spark, *files):
    return {(r.file_id, r.prev_key, r.key_name, r.change_kind) for r in drift.changes(*feed(spark, *files)).collect()}


def test_rename_retype_add_remove(spark):
    a = [rec(i, VEC=6.1 + i / 7, kind="x", old=i * 11) for i in range(6)]
    b = [rec(i, mean_vec={"value": 6.1 + i / 7}, kind=None if i else "x", new=f"n{i}") for i in range(3, 9)]
    assert changes(spark, a, b) == {
        (2, "VEC", "mean_vec", "renamed"), (2, "VEC", "mean_vec", "retyped"), (2, "old", "old", "removed"), (2, "new", "new", "added"),
    }


def test_swapped_keys_and_forms_of_compositions(spark):
    a = [rec(i, p=i * 1.5, q=f"W0.9{i}Re0.0{i}") for i in range(1, 7)]
    b = [rec(i, q=i * 1.5, p=[["W", 0.9 + i / 100], ["Re", i / 100]]) for i in range(2, 8)]
    got = changes(spark, a, b)
    assert (2, "p", "q", "renamed") in got and (2, "q", "p", "renamed") in got and (2, "q", "p", "retyped") in got


def test_edges(spark):
    a = [rec(1, x=1), "not json", None, "[1]", "", rec(1, x=1)]
    assert changes(spark, a, a, []) == {(3, "x", "x", "removed"), (3, "record_id", "record_id", "removed")}
    assert changes(spark) == set()
    assert changes(spark, [rec(1, x=None)], [rec(1, x=3)]) == set()


def test_repeated_rows_nulls_and_clashing_columns(spark):
    a = [rec(i, VEC=i * 1.5, x=None) for i in range(6)]
    b = [rec(i, mean_vec=i * 1.5, x=None) for i in range(6)] * 2
    files, records = feed(spark, a, b)
    extra = spark.createDataFrame([(None, "feed", 1, None, None), (9, None, 3, None, None), (8, "feed", None, None, None)], files.schema)
    lost = spark.createDataFrame([(None, None, None, None), (7, None, 1, '{"record_id": 1}'), (8, 99, 1, '{"record_id": "W-1", "z": "' + "y" * 100_000 + '"}')], records.schema)
    clash = lambda df: df.withColumns({c: F.lit("clash") for c in ("m", "p", "key_name", "rows", "now", "next_id")})
    files, records = clash(files.unionByName(files).unionByName(extra)), clash(records.unionByName(records).unionByName(lost))
    assert [tuple(r) for r in drift.changes(files, records).collect()] == [(2, "VEC", "mean_vec", "renamed")]
    rows = drift.unified(files, records).collect()
    assert len(rows) == 2 * 18 + 2 and sum(r.vec is not None for r in rows) == 36


def test_unified_follows_lineages(spark):
    a = [rec(i, VEC=6.0 + i / 9, composition_string=f"W0.{i}1") for i in range(1, 6)]
    b = [rec(i, mean_vec=str(6.0 + i / 9), composition_string=f"W0.{i}1", extra=[1, 2]) for i in range(3, 8)]
    c = [rec(i, electrons={"value": 6.0 + i / 9}, composition_string={"W": float(f"0.{i}1")}) for i in range(5, 10)]
    rows = drift.unified(*feed(spark, a, b, c)).collect()
    assert len(rows) == 15 and all(abs(r.vec - (6.0 + int(r.record_id[2:]) / 9)) < 1e-9 for r in rows)
    assert all(r.composition_string == f"W0.{r.record_id[2:]}1" for r in rows)


def test_wide_and_narrow_files_of_one_feed_are_compared_in_full(spark):
    wide = [rec(i, VEC=i * 1.01, s=i * 7) for i in range(1000, 5000)]
    wide_on = [rec(i, vec_mean=i * 1.01, s=i * 7) for i in range(2000, 6000)]
    a = [rec(i, VEC=i * 1.01, composition_string=f"W0.{i}1") for i in range(10, 23)]
    b = [rec(i, electrons_per_atom=i * 1.01, alloy_formula=f"W0.{i}1") for i in range(19, 32)]
    got = changes(spark, wide, wide_on, a, b)
    assert {c for c in got if c[0] == 2} == {(2, "VEC", "vec_mean", "renamed")}
    assert {c for c in got if c[0] == 4} == {(4, "VEC", "electrons_per_atom", "renamed"), (4, "composition_string", "alloy_formula", "renamed")}


def test_many_small_feeds_beside_a_wide_file_keep_all_renames(spark):
    """All of 20 renames are found; a common rate of sampling would lose most of them."""
    f, r = [], []
    for feed_no in range(20):
        for seq in (1, 2, 3):
            file_id = feed_no * 3 + seq
            f.append((file_id, f"feed {feed_no}", seq, "f", 0))
            span = range(0, 30) if seq == 1 else range(20, 50) if seq == 2 else range(40, 240)
            name = "VEC" if seq == 1 else "electrons"
            r += [(file_id * 1000 + i, file_id, i, json.dumps(rec(i, **{name: i * 1.01}))) for i in span]
    files = spark.createDataFrame(f, "file_id bigint, feed_name string, seq_no int, file_name string, n_records int")
    records = spark.createDataFrame(r, "raw_id bigint, file_id bigint, line_no int, payload string")
    got = [tuple(x) for x in drift.changes(files, records).collect()]
    assert sorted(got) == [(3 * k + 2, "VEC", "electrons", "renamed") for k in range(20)]


def test_files_without_common_records_are_matched_by_their_value_sketches(spark):
    a = [rec(i, vec=6 + i % 10 / 10, melting=3000 + 40 * (i % 20), form=("rod", "sheet", "wire")[i % 3]) for i in range(40)]
    b = [rec(i, vec_mean=6.05 + i % 10 / 10, hardness=300 + 4 * (i % 20), form_kind=("rod", "sheet", "wire")[i % 3]) for i in range(100, 140)]
    assert changes(spark, a, b) == {
        (2, "vec", "vec_mean", "renamed"), (2, "form", "form_kind", "renamed"), (2, "melting", "melting", "removed"), (2, "hardness", "hardness", "added"),
    }


def test_another_record_key_and_repeated_records(spark):
    a = [{"sample": f"S-{i}", "x": i * 3, "k": 1} for i in range(30)]
    b = [{"sample_no": f"S-{i}", "y": i * 3, "k": 1} for i in range(20, 50)] * 3
    assert changes(spark, a, b) == {(2, "sample", "sample_no", "renamed"), (2, "x", "y", "renamed")}
    same = [rec(1, x=i) for i in range(50)]
    assert changes(spark, same, [rec(1, y=i) for i in range(50)] * 20) <= {(2, "x", "y", "renamed"), (2, "x", "x", "removed"), (2, "y", "y", "added")}


def test_long_chains_of_renames_and_swaps(spark):
    files = [[rec(i, **{f"name_{k}_{'abcdefghijk'[k] * 9}": i * 1.5}) for i in range(6)] for k in range(11)]
    f, r = feed(spark, *files)
    got = drift.lineages(f, drift.changes(f, r)).collect()
    assert len(got) == 10 and {x.root for x in got} == {"name_0_aaaaaaaaa"} and all(x.to_seq == x.from_seq or x.from_seq == 11 for x in got)
    rows = drift.unified(*feed(spark, *[[rec(i, VEC=i * 1.5, hardness_HV=i * 7 + 0.5) for i in range(6)], [rec(i, hardness_HV=i * 1.5, VEC=i * 7 + 0.5) for i in range(6)]])).collect()
    assert all(r.vec == int(r.record_id[2:]) * 1.5 and r.hardness_hv == int(r.record_id[2:]) * 7 + 0.5 for r in rows) and len(rows) == 12


def test_rarely_filled_keys_are_renamed_and_swapped(spark):
    full = [{"VEC": i * 1.01} | ({"dopant": f"D{i}", "p": i * 7, "q": f"Q{i}"} if i % 10 == 0 else {}) for i in range(100)]
    a = [rec(i, **m) for i, m in enumerate(full)]
    b = [rec(i, **{{"dopant": "second_element", "p": "q", "q": "p"}.get(k, k): v for k, v in m.items()}, unlike=i % 50 + 2000) for i, m in enumerate(full)]
    got = changes(spark, a, b)
    assert {c for c in got if c[3] != "retyped"} == {
        (2, "dopant", "second_element", "renamed"), (2, "p", "q", "renamed"), (2, "q", "p", "renamed"), (2, "unlike", "unlike", "added"),
    }


def test_one_chance_agreement_renames_nothing(spark):
    a = [rec(i, VEC=i * 1.01, form="rod") for i in range(20)]
    b = [rec(i, VEC=i * 1.01, **({"shape": "rod"} if i == 3 else {})) for i in range(20)]
    assert changes(spark, a, b) == {(2, "form", "form", "removed"), (2, "shape", "shape", "added")}


def test_order_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(drift, "BUCKET", 2)
    f, _ = feed(spark, [], [], [], [], [])
    assert {(r.file_id, r.prev_id) for r in drift.previous_files(f).collect()} == {(1, None), (2, 1), (3, 2), (4, 3), (5, 4)}


def test_whole_table(spark, sf):
    """Agreement of the record key with itself is the number of records in common, counted plainly."""
    files, records = table(spark, sf, "raw_file"), table(spark, sf, "raw_record")
    found = drift.changes(files, records).collect()
    assert {"renamed"} <= {r.change_kind for r in found} <= {"renamed", "retyped", "added", "removed"}
    ids: dict[int, set] = {}
    for r in records.collect():
        try:
            ids.setdefault(r.file_id, set()).add(json.loads(r.payload)["record_id"])
        except (ValueError, KeyError, TypeError):
            pass
    links = drift.previous_files(files)
    rows = drift.cells(records)
    profiles = drift.key_profiles(rows)
    key = profiles.where("key_name = 'record_id'").first().key_hash
    got = drift.overlaps(rows, links, drift.record_keys(profiles, "record_id")).where(f"prev_hash = {key} and key_hash = {key}")
    want = {r.file_id: len((ids.get(r.file_id, set()) & ids.get(r.prev_id, set())) - {None}) for r in links.collect()}
    assert {r.file_id: r.n_same for r in got.collect()} == {k: n for k, n in want.items() if n}
