import pytest

from ferrolex.functions.unit_graph import Affine, UnitGraph
from ferrolex.operators.units import conversions, converted, to_ppm
from ferrolex.sources.tables import table

UNITS = [
    (1, "wt_ppm", "mass", 1.0), (2, "wt_pct", "mass", 1e4), (3, "wt_ppb", "mass", 1e-3), (4, "mass_fraction", "mass", 1e6), (5, "g_per_kg", "mass", 1e3),
    (6, "at_ppm", "atom", 1.0), (7, "at_pct", "atom", 1e4), (8, "atom_fraction", "atom", 1e6), (9, "vol_pct", "volume", None),
]
COLUMNS = "rec_key bigint, dopant_concentration double, dopant_concentration_unit string, second_dopant_element string, second_dopant_concentration double, second_dopant_concentration_unit string, impurity_concentration string, material_name string, notes string, unit_id string"


def convert(spark, *rows):
    units = spark.createDataFrame(UNITS, "unit_id int, unit_label string, basis string, per_million double")
    out = {}
    df = spark.createDataFrame(list(rows), COLUMNS).selectExpr("*", "cast(null as string) as dopant_or_alloying_element")
    for r in to_ppm(df, units).orderBy("value_pos").collect():
        out.setdefault((r.rec_key, r.field_name), []).append(r)
    return out


def test_graph_composes_and_checks_cycles():
    g = UnitGraph([("C", "K", 1.0, 273.15), ("F", "C", 5 / 9, -160 / 9)])
    f = g.paths("K")["F"]
    assert abs(f.factor * 212 + f.offset - 373.15) < 1e-9
    assert Affine(2.0, 3.0).inverse().then(Affine(2.0, 3.0)).agrees(Affine(1.0))
    g.add("F", "K", Affine(2.0))
    with pytest.raises(ValueError):
        g.paths("K")
    with pytest.raises(ValueError):
        UnitGraph([("a", "b", 1.0, 0.0), ("a", "b", 2.0, 0.0)])


def test_where_units_are_stated(spark):
    got = convert(
        spark,
        (1, 3.5, "Gew.-%", None, None, None, "0,254 g/kg", "W-Re", None, None),
        (2, 60.0, None, "Re", 2.0, None, "<12", "W-K (60 ppm)", "Re: value in at. % All impurity contents: atomic ppm.", None),
        (3, 1.0, "see notes", "Ni", 0.1, "vol%", "12 | 13", "W", "[methodology] K content in ‰ (w/w). Furnace gas held below 5 ppm O2.", None),
        (4, 1.0, None, None, None, None, None, None, None, None),
    )
    ppm = lambda *at: [None if r.ppm is None else round(r.ppm, 6) for r in got[at]]
    unit = lambda *at: {r.unit_id for r in got[at]}
    assert unit(1, "dopant_concentration") == {2} and ppm(1, "dopant_concentration") == [35000.0]
    assert unit(1, "impurity_concentration") == {5} and ppm(1, "impurity_concentration") == [254.0]
    assert unit(2, "dopant_concentration") == {1} and unit(2, "second_dopant_concentration") == {7} and unit(2, "impurity_concentration") == {6}
    assert unit(3, "dopant_concentration") == {5}
    assert unit(3, "second_dopant_concentration") == {9} and ppm(3, "second_dopant_concentration") == [None]
    assert ppm(3, "impurity_concentration") == [12.0, 13.0]
    assert unit(4, "dopant_concentration") == {None} and (4, "impurity_concentration") not in got


def test_each_value_of_an_entry_has_its_own_unit(spark):
    row = (1, 2.0, None, None, None, None, "C 20 wt.ppm; O 0.003 wt%", "W", "Grain content in wt%. C content in wt%.", None)
    other = (2, 2.0, None, None, None, None, "10-14 at%", "W", "Amount of Re quoted in wt%.", None)
    got = convert(spark, row, other)
    assert [(r.value_pos, round(r.ppm, 6)) for r in got[1, "impurity_concentration"]] == [(1, 20.0), (2, 30.0)]
    assert [round(r.ppm) for r in got[2, "impurity_concentration"]] == [100_000, 140_000]
    units = spark.createDataFrame(UNITS, "unit_id int, unit_label string, basis string, per_million double")
    named = "rec_key bigint, dopant_or_alloying_element string, dopant_concentration double, dopant_concentration_unit string, second_dopant_element string, second_dopant_concentration double, second_dopant_concentration_unit string, impurity_concentration string, material_name string, notes string"
    rows = [
        (1, "Re", 2.0, None, "K", 1.0, None, "C 20 wt.ppm; O 0.003 wt%", "W", "Grain content in wt%. K content in ppb."),
        (2, "Re", 2.0, None, "K", 1.0, "at%", None, "W", "Re measured and reported as wt%"),
        (3, "rhenum", 2.0, None, None, None, None, None, "W", "Amount of addition quoted in mass fraction."),
        (4, None, 2.0, None, None, None, None, None, "W", "W powder of 3 wt% binder"),
    ]
    found = {tuple(r) for r in converted(spark.createDataFrame(rows, named), units).collect()}
    assert found == {(1, "impurity_concentration", 2), (1, "second_dopant_concentration", 3), (2, "dopant_concentration", 2), (2, "second_dopant_concentration", 7), (3, "dopant_concentration", 4)}


def test_the_table_of_units_is_checked_against_the_scales(spark):
    wrong = [(i, u, b, 5e3 if u == "wt_pct" else f) for i, u, b, f in UNITS]
    with pytest.raises(ValueError):
        conversions(spark.createDataFrame(wrong, "unit_id int, unit_label string, basis string, per_million double"))


def test_edges(spark):
    assert convert(spark, (None, None, None, None, None, None, None, None, None, None)) == {}
    assert len(convert(spark, (1, 1.0, "", None, None, None, "", "x" * 100_000, "y" * 100_000, "clash"))) == 2


def test_whole_table(spark, sf):
    r = to_ppm(table(spark, sf, "w_dbtt"), table(spark, sf, "ref_unit"))
    assert r.where("field_name = 'impurity_concentration' and unit_id is null").count() == 0
