import pytest
from pyspark.sql import functions as F

from ferrolex.functions.elements import attributes, element_lookup, element_table, extend_cache
from ferrolex.operators import mixture
from ferrolex.operators.composition import expand_brackets, formula_string, with_composition, with_formula, wt_to_at
from ferrolex.operators.enrich import enrich, fraction_columns, log_lines
from ferrolex.operators.phases import empty_phases, formula_key, searched, select_phase, select_phase_by_window, with_phases, without_traces

RECORD = "rec_key bigint, record_id string, material_name string, composition_type string, composition_string string, dopant_or_alloying_element string, dopant_concentration double, dopant_concentration_unit string, second_dopant_element string, second_dopant_concentration double, second_dopant_concentration_unit string, vec double, delta_s_mix_j_mol_k double, delta_atomic_size double, delta_h_mix_kj_mol double"


def records(spark, *rows):
    """Rows of (type, string, el1, c1, u1, el2, c2, u2)."""
    full = [(i, None, "m", *r, *[None] * (8 - len(r)), 1.0, 2.0, 3.0, 4.0) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, RECORD)


def fractions(spark, *rows):
    out = with_composition(records(spark, *rows)).orderBy("rec_key").collect()
    return [None if r.parts is None else {p.el: round(p.f, 6) for p in r.parts} for r in out], [r.composition_warnings for r in out], [r.format_used for r in out]


@pytest.mark.parametrize("_", [0])
def test_string_features_match_hand_derived_values(spark, _):
    cases = {
        "W0.95Ni0.035Fe0.015": (6.17, 1.904392, -0.4032, None, "Fe0.015Ni0.035W0.95"), "W0.93Ni0.045Fe0.01Co0.015": (6.245, 2.627949, -0.5622, None, "Co0.015Fe0.01Ni0.045W0.93"),
        "W0.90Ni0.06Cu0.04": (6.44, 3.262282, 2.5584, None, "Cu0.04Ni0.06W0.9"), "W1": (6.0, 0.0, 0.0, 1786.0, "W1.0"),
        "W0.982Re0.018": (6.018, 0.749506, -0.282816, None, "Re0.018W0.982"), "W0.995Re0.005": (6.005, 0.261717, -0.0796, 1786.0, "W0.995"),
        "W0.99994K0.00006": (5.9997, 0.005348, None, 1785.8944, "W0.9999"),
    }
    df = with_composition(records(spark, *[("alloy", s) for s in cases]))
    p = F.col("parts")
    rows = df.select("composition_string", mixture.vec(p), mixture.mixing_entropy(p), mixture.mixing_enthalpy(p), mixture.usfe(p), formula_key(without_traces(p))).collect()
    for r in rows:
        got = [round(x, 6) if isinstance(x, float) else x for x in r[1:]]
        want = cases[r[0]]
        assert got == [pytest.approx(w, abs=2e-6) if isinstance(w, float) else w for w in want], r[0]


def test_discrete_fields(spark):
    got, notes, used = fractions(
        spark, ("alloy", None, "Ni", 3.5, "wt%", "Fe", 1.5, "wt%"), ("doped", None, "K", 60.0, "ppm"), ("alloy", None, "Re", 3.0, "wt%"), ("pure", None, "Re", 3.0, "wt%"),
        (None, None, "Re", 3.0, "wt%"), ("doped", None), ("doped", None, "Re", 3.0, "vol%"), ("doped", None, "Re", 3.0, None, "Ta", 1.0, "at%"), ("doped", None, "La2O3", 1.0, "wt%"),
        ("doped", None, "La2O3", 1.0, "wt%", "Re", 3.0, "wt%"), ("alloy", None, "Re", 70.0, "wt%", "Ta", 60.0, "wt%"), ("alloy", None, "Re", 70.0, "at%", "Ta", 60.0, "at%"),
        ("alloy", None, "Re", 0.0, "wt%"), ("alloy", "bad!", "Re", 3.0, "wt%"), ("alloy", "bad!"), ("alloy", "", "Re", 3.0, "wt%"), ("alloy", None, "Re", 3.0, "wt%", "Ta", 2.0, "at%"),
    )
    assert got[0] == {"Ni": 0.098852, "Fe": 0.044526, "W": 0.856622} and got[1] == {"K": 0.000282, "W": 0.999718} and got[2] == {"Re": 0.02963, "W": 0.97037}
    assert got[3] == {"W": 1.0} and used[3] == "B_pure" and got[4:7] == [None, None, None]
    assert got[7] == {"Ta": 0.01, "W": 0.99} and len(notes[7]) == 1 and got[8] is None
    assert got[9] == got[2] and len(notes[9]) == 1
    assert got[10]["W"] == 0.0 and round(sum(got[10].values()), 6) == 1 and round(sum(got[11].values()), 6) == 1.3 and got[11]["W"] == 0
    assert got[12] == {"Re": 0.0, "W": 1.0}
    assert used[13] == "B_discrete_fields" and notes[13][0].startswith("cannot read") and got[14] is None and notes[14]
    assert got[15] == got[2] and any("mixed" in n for n in notes[16]) and list(got[16]) == ["Re", "Ta", "W"]


def test_formula_strings(spark):
    df = spark.createDataFrame([(t,) for t in ("W0.9Re0.1", "ReW", "W2W2", "W0", "Xx1", "w1", "", None, "W0.9(Re2O3)0.1", "W[Re", "W[Re(Ta2)2]0.5", "W(Re]", "W()", "W(Re)(Ta)0.5", "W(x)")], "t string")
    got = {r.t: r.p and {x.el: round(x.f, 4) for x in r.p} for r in with_formula(df, "t", "p").collect()}
    assert got["W0.9Re0.1"] == {"W": 0.9, "Re": 0.1} and got["ReW"] == {"Re": 0.5, "W": 0.5} and got["W2W2"] == {"W": 1.0}
    assert all(got[t] is None for t in ("W0", "Xx1", "w1", "", None, "W[Re", "W(Re]", "W(x)"))
    assert got["W0.9(Re2O3)0.1"] == {"W": 0.6429, "Re": 0.1429, "O": 0.2143} and got["W[Re(Ta2)2]0.5"] == {"W": 0.2857, "Re": 0.1429, "Ta": 0.5714}
    assert got["W()"] == {"W": 1.0} and got["W(Re)(Ta)0.5"] == {"W": 0.4, "Re": 0.4, "Ta": 0.2}
    assert df.where("t = 'W0.9Re0.1'").select(expand_brackets(F.col("t"))).first()[0] == "W0.9Re0.1"
    assert with_formula(df.where("t = 'W0.9Re0.1'"), "t", "p").select(formula_string(F.col("p"))).first()[0] == "W0.9Re0.1"
    weights = with_formula(df.where("t = 'W0.9Re0.1'"), "t", "p")
    assert round(sum(x.f for x in wt_to_at(weights, "p", "a").first().a), 9) == 1


DOCS = [
    ("a", "Hexagonal", 0.49604466, False), ("b", "Orthorhombic", 0.49139236, False), ("c", "Cubic", 0.0, True), ("d", "Cubic", 0.47142784, False), ("e", "Cubic", 0.12686559, False),
]


@pytest.mark.parametrize(
    "docs,n,want",
    [
        (DOCS, 1, ("c", True, False)), (DOCS, 2, ("c", True, False)), ([x for x in DOCS if x[0] != "c"], 1, ("e", False, False)),
        (DOCS[:2], 2, ("b", False, True)), ([("x", None, 0.0, False), ("y", None, 0.0, True)], 1, ("y", True, False)), ([("z", None, None, None)], 1, ("z", False, True)), ([], 1, None),
    ],
)
def test_phase_selection(spark, docs, n, want):
    schema = "docs array<struct<pos:int,material_id:string,crystal_system:string,e_hull:double,is_stable:boolean>>, n int, cache_key string"
    df = spark.createDataFrame([([(i, *x) for i, x in enumerate(docs)], n, "k")], schema)
    s = df.select(select_phase(F.col("docs"), F.col("n")).alias("s")).first().s
    assert (s and (s.doc.material_id, s.all_phases_found, s.bcc_assumption)) == want
    w = select_phase_by_window(df.select("cache_key", F.col("n").alias("n_elements"), F.explode("docs").alias("d")).select("cache_key", "n_elements", "d.*")).collect()
    assert ([tuple(r)[1:] for r in w] or [None])[0] == want


def test_enrich_keeps_all_records(spark):
    df = records(spark, ("alloy", "W0.95Ni0.035Fe0.015"), ("alloy", "W1"), (None, None), ("alloy", "W0.995Re0.005"))
    answers = spark.createDataFrame([(1, "W1.0", None, '[{"material_id": "m", "energy_above_hull": 0.0, "symmetry": {"crystal_system": "Cubic"}}]'), (2, "W0.995", None, "[]")], "cache_id bigint, cache_key string, written_at timestamp, payload string")
    r = {x.rec_key: x for x in enrich(df, answers).collect()}
    assert r[0].dataset_scope_flag and r[0].mp_query_skipped.startswith("heavy") and round(r[0].vec, 4) == 6.17
    assert r[1].mp_material_id == "m" and r[1].mp_query_skipped is None and r[2].fractions is None and r[2].vec == 1.0
    assert r[3].mp_query_skipped == "no matching entries" and r[3].kept_original == []
    off = {x.rec_key: x for x in enrich(df, answers, phase_source="off").collect()}
    assert off[1].mp_query_skipped == "phase lookup is switched off"
    assert empty_phases(df.select("rec_key"), "why").first().mp_query_skipped == "why"
    wide = fraction_columns(with_composition(df), ["W", "Cu"]).orderBy("rec_key").collect()
    assert wide[0].frac_w == 0.95 and wide[0].frac_cu is None and wide[2].frac_w is None
    assert log_lines(with_composition(df)).where("level = 'WARN'").count() == 1


def test_phases_are_searched_for_where_the_cache_misses(spark, tmp_path):
    at = str(tmp_path / "asked")

    def transport(url, params, headers, timeout):
        with open(at, "a") as f:
            f.write(params["elements"] + "\n")
        if params["elements"] == "Ta,W":
            raise TimeoutError("slow")
        return 200, (b'[{"material_id": "new", "formula_pretty": "WRe", "energy_above_hull": 0.0, "symmetry": {"crystal_system": "Cubic"}}]' if "Re" in params["elements"] else b"[]"), ""

    df = records(spark, ("alloy", "W1"), ("alloy", "W0.9Re0.1"), ("alloy", "W0.8Re0.2"), ("alloy", "W0.9Ta0.1"), ("alloy", "W0.9Mo0.1"), ("alloy", "W0.9Ni0.1"))
    answers = spark.createDataFrame([(1, "W1.0", None, '[{"material_id": "m", "energy_above_hull": 0.0}]')], "cache_id bigint, cache_key string, written_at timestamp, payload string")
    composed = with_composition(df)
    live = with_phases(composed, answers, phase_source="live", transport=transport, url="u")
    got = {r.composition_string: r for r in live.collect()}
    assert [got[c].mp_material_id for c in ("W1", "W0.9Re0.1", "W0.8Re0.2", "W0.9Ta0.1", "W0.9Mo0.1", "W0.9Ni0.1")] == ["m", "new", "new", None, None, None]
    assert got["W0.9Ta0.1"].mp_query_skipped == "phase search failed: TimeoutError: slow" and got["W0.9Mo0.1"].mp_query_skipped == "no matching entries"
    assert got["W0.9Mo0.1"].mp_formula == "Mo0.1W0.9" and got["W0.9Mo0.1"].mp_all_phases_found is False
    with open(at) as f:
        assert sorted(f.read().split()) == ["Mo,W", "Re,W", "Ta,W"]
    assert with_phases(composed, answers, phase_source="live").where("composition_string = 'W1'").first().mp_query_skipped.startswith("no client")
    cached = {r.composition_string: r.mp_query_skipped for r in with_phases(composed, answers).collect()}
    assert cached["W0.9Re0.1"] == "no answer in the cache" and cached["W1"] is None
    new = searched(composed, answers, transport, "u").where("error is null")
    assert {r.cache_key for r in new.collect()} == {"Re0.1W0.9", "Re0.2W0.8", "Mo0.1W0.9"} and new.select(*answers.columns).unionByName(answers).count() == 4


def test_an_element_table_of_the_caller_reaches_all_features(spark):
    own = element_table(spark).withColumns({c: F.when(F.col("symbol") == "La", 7.0).otherwise(F.lit(3.0)) for c in set(mixture.WEIGHTED.values()) | {"lattice_constant"}})
    df = records(spark, ("alloy", "W0.5La0.5"))
    answers = spark.createDataFrame([], "cache_id bigint, cache_key string, written_at timestamp, payload string")
    r = enrich(df, answers, elements=own).first()
    assert {r[c] for c in mixture.WEIGHTED} == {5.0} and round(r.delta_atomic_size, 6) == 40.0
    built_in = enrich(records(spark, ("alloy", "W0.9Re0.1")), answers).first()
    assert all(built_in[c] is not None for c in mixture.WEIGHTED)
    lines = [x.message for x in log_lines(enrich(df, answers).withColumn("parts", F.lit(1))).orderBy("seq").collect()]
    assert lines[0] == "m composition by A_composition_string" and any("overwritten: vec" in x for x in lines) and any("phase skipped" in x for x in lines)


def test_invariants(spark, sf):
    df = with_composition(spark.read.parquet(f"{sf}/w_dbtt.parquet").select(*[c.split()[0] for c in RECORD.split(", ")])).where("parts is not null")
    p = F.col("parts")
    total = F.aggregate(p, F.lit(0.0), lambda a, x: a + x["f"])
    bad = df.where((total < 1 - 1e-9) | (mixture.mixing_entropy(p) < 0) | (F.abs(mixture.weighted_mean(p, F.create_map(F.lit("W"), F.lit(5.0))) - 5.0) > 1e-9))
    assert bad.count() == 0


def test_element_dimension(spark):
    t = element_table(spark)
    assert t.count() == 94 and element_lookup(t, "W").first().vec == 6 and element_lookup(t, "Q").count() == 0
    assert {r.attribute: r.value for r in attributes(t, "W").collect()}["lattice_structure"] == "BCC"
    some = t.where("symbol in ('W', 'Re')")
    more = extend_cache(some, spark.createDataFrame([("Ta",), ("W",), ("??",)], "symbol string"), t)
    assert {r.symbol for r in more.collect()} == {"W", "Re", "Ta"}
