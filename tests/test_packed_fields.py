from hypothesis import given, settings
from hypothesis import strategies as st

from ferrolex.functions.segment import split_packed
from ferrolex.operators.packed_fields import split_fields


def values(text):
    return [v for _, v in split_packed(text)]


def test_delimiters_inside_values_are_kept():
    assert values("0,0064; 0,0096; 0,0174") == ["0,0064", "0,0096", "0,0174"]
    assert values("0.05 g/kg/0.03 g/kg") == ["0.05 g/kg", "0.03 g/kg"]
    assert values("metals (Fe, Ni) and S") == ["metals (Fe, Ni)", "S"]
    assert values("cold_pressed | 35-40%/pass | 24-29% per pass") == ["cold_pressed", "35-40%/pass", "24-29% per pass"]
    assert values("annealed (1330 K, 1 h; H2);1490–1590 K") == ["annealed (1330 K, 1 h; H2)", "1490–1590 K"]
    assert values("sintered then 2,5 h then annealed") == ["sintered", "2,5 h", "annealed"]
    assert values("Cu C H") == ["Cu", "C", "H"]


def test_positions_quotes_and_single_values():
    assert split_packed("Mo;;C") == [(1, "Mo"), (3, "C")]
    assert values('"so-called ""green"" state, 1" → 1730C') == ['so-called "green" state, 1', "1730C"]
    assert values("'Fe'; 'S'") == ["Fe", "S"]
    for one in (None, "", "  ", "Mo", "O;", "43,4 %", "1250–1350 K", "rest (all < 5, each)", '"H, trace"', "furnace cooled", ";;", "Al (main)"):
        assert split_packed(one) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["Mo", "Fe", "12", "0,5", "sintered", "40 %", "3 mg/kg", "annealed (900 K, 1 h)"]), min_size=2, max_size=6), st.sampled_from(["; ", "|", " -> ", " then ", "\t", "\n"]))
def test_round_trip(items, delimiter):
    assert values(delimiter.join(items)) == items


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab1,;/| \"'()[]\n\t.%+-", max_size=40))
def test_no_text_breaks_it(text):
    for pos, item in split_packed(text):
        assert pos >= 1 and item == item.strip() and item


def test_long_text():
    assert len(split_packed("Fe; " * 20_000 + "Ni")) == 20_001
    assert len(split_packed("Fe " * 5_000 + "Ni")) == 5_001


def test_entries_of_many_values_are_split_like_short_ones():
    items = ["Fe 12 ppm", "Ni 5 ppm", "0.5 wt%", "Cu"]
    for n in (1, 6, 16, 500):
        assert values(" ".join(items * n)) == items * n
    inside = ", ".join(f"Fe {k} ppm; Ni" for k in range(100))
    assert len(inside) > 1000
    assert values(f"rest ({inside}); Mo") == [f"rest ({inside})", "Mo"]
    assert values("a (b [c; d; " * 300 + "e")[-1] == "e"


def test_operator_edges(spark):
    schema = "rec_key bigint, impurities string, impurity_concentration string, processing_history string, pos string, item string, entry string"
    rows = [(1, "Fe; Ni", None, "a\tb", "x", "y", "z"), (1, "Fe; Ni", "12", "", "x", "y", "z"), (None, "Fe; Ni", None, None, None, None, None)]
    got = sorted(split_fields(spark.createDataFrame(rows, schema)).collect(), key=str)
    assert len(got) == 8 and {r.rec_key for r in got} == {1, None}
    assert split_fields(spark.createDataFrame([], schema)).count() == 0


def test_known_values_of_any_length():
    digits = "1" * 200
    assert values(f"0.{digits} g/kg/0.03 g/kg") == [f"0.{digits} g/kg", "0.03 g/kg"]
    assert values(f"35-{digits}%/pass | Mo") == [f"35-{digits}%/pass", "Mo"]
    for n in (5, 20, 59, 60, 240):
        assert values(" ".join(["C 20 ppm"] * n)) == ["C 20 ppm"] * n
        assert values("/".join(["0.05 g/kg"] * n)) == ["0.05 g/kg"] * n


def test_long_entries_take_time_in_proportion():
    import time

    for text in ("unknown words, and more of them " * 4_000, "C 20 ppm " * 10_000, "ppm " * 3_000, "(a, b) " * 10_000, "x" * 100_000 + ", y"):
        began = time.time()
        split_packed(text)
        assert time.time() - began < 20
