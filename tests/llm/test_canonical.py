import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from ferrolex.llm.canonical import FieldMatcher, TypoIndex, errors_allowed, letter_pairs, map_to_terms, typing_distance
from ferrolex.llm.queries import p1_found

TERMS = [
    (1, "dopant_or_alloying_element", "K", "potassium (kalium)"), (2, "dopant_or_alloying_element", "Re", "rhenium"), (9, "dopant_or_alloying_element", "Hf", "hafnium"),
    (20, "dopant_or_alloying_element", "La2O3", "lanthanum oxide (lanthana)"), (26, "dopant_or_alloying_element", "HfC", "hafnium carbide"),
    (101, "deformation_process", "cold_rolling", "rolling near room temperature"), (103, "deformation_process", "hot_rolling", "x"), (106, "deformation_process", "hot_forging", "x"),
    (110, "deformation_process", "equal_channel_angular_pressing", "ECAP"), (202, "dbtt_definition", "temperature at half upper shelf energy", "absorbed energy is midway to the upper shelf"),
    (304, "figure_type", "EBSD", "orientation maps"), (301, "figure_type", "microstructure", "x"),
]


def matcher(field):
    return FieldMatcher(field, [(i, label, gloss) for i, f, label, gloss in TERMS if f == field])


def test_names_aliases_and_typing_errors():
    m = matcher("dopant_or_alloying_element")
    for text in ("k", " K [1]", "doped with Potussium", "kailum*", "K (99.9 %)", "element K", "potassium metal"):
        assert m.term(text) == 1, text
    assert m.term("rhneuim") == 2 and m.term("Hafnium crabide") == 26 and m.term("La₂O₃") == 20 and m.term("lathanum(III) xoide") == 20 and m.term("HFC") == 26


def test_related_things_are_not_on_the_list():
    m = matcher("dopant_or_alloying_element")
    for text in ("Rh", "rhodium", "hafnium oxide", "HfN", "hafnium silicide", "unknown", "??", "-", "", "   ", "see Table 2", "n/a", "NbC", "zinc", "lanthanum"):
        assert m.term(text) == 0, text


def test_word_order_and_phrases():
    m = matcher("deformation_process")
    assert m.term("rolled cold, several passes") == 101 and m.term("laminage à froid") == 101 and m.term("forging, hto") == 106 and m.term("E.C.A.P. (multi-pass)") == 110
    assert m.term("deep drawing") == 0 and m.term("hot isostatic pressing") == 0
    d = matcher("dbtt_definition")
    assert d.term("T at hlf the shelf energy; see text") == 202 and d.term("hardness drop criterion") == 0
    f = matcher("figure_type")
    assert f.term("type: pole fiigure (a-d)") == 304 and f.term("publisher logo") == 0


def test_long_texts_and_empty_lists():
    assert matcher("deformation_process").term("word " * 20_000) == 0
    assert FieldMatcher("deformation_process", []).term("cold rolling") == 0
    assert FieldMatcher("some_other_field", [(7, "abc def", None)]).term("abc dfe") == 7


def test_embedded_mentions_decide_where_nothing_is_similar():
    m = matcher("deformation_process")
    assert m.term("ECAP route Bc") == 110 and m.term("billets went through ECAP before they were cut up") == 110
    assert matcher("dopant_or_alloying_element").term("ingots that carry traces of Re beside what was charged") == 2
    filler = "zzz qqq " * 30
    assert m.term(f"{filler} cold rolilng {filler}") == 101 and m.term(filler) == 0


def plain_distance(a, b):
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
            if i and j and x == b[j - 1] and a[i - 1] == y:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abcd", max_size=12), st.text(alphabet="abcd", max_size=12), st.integers(0, 12))
def test_distances_equal_the_plain_table(a, b, limit):
    want = plain_distance(a, b)
    got = typing_distance(a, b, limit)
    assert got == want if want <= limit else got > limit


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcde", min_size=1, max_size=12), min_size=1, max_size=30, unique=True), st.text(alphabet="abcde", min_size=3, max_size=12))
def test_the_index_loses_no_word_that_shares_a_pair_of_letters(words, word):
    got = {words[k] for k, _ in TypoIndex(words).near(word)}
    want = {w for w in words if w == word or (errors_allowed(word, w) and plain_distance(word, w) <= errors_allowed(word, w))}
    assert got <= want and all(not letter_pairs(w) & letter_pairs(word) for w in want - got)


def test_long_lists_are_looked_up_by_index():
    rng = random.Random(1)
    names = list({"".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(6, 14))) for _ in range(50_000)})
    m = FieldMatcher("other_field", [(k + 1, n, None) for k, n in enumerate(names)])
    tried = rng.sample(range(len(names)), 300)
    began = time.time()
    found = [m.term(names[k][:2] + names[k][3] + names[k][2] + names[k][4:]) for k in tried]
    assert sum(f == k + 1 for f, k in zip(found, tried)) >= 295 and time.time() - began < 15


def test_distance():
    assert typing_distance("potassium", "ptosassium", 3) == 2 and typing_distance("ab", "ba", 2) == 1 and typing_distance("a", "abcd", 2) == 3


def test_operator(spark):
    terms = spark.createDataFrame(TERMS, "term_id bigint, field_name string, label string, gloss string")
    schema = "rec_key bigint, deformation_process string, term_id bigint, entry string, field_name string"
    rows = [(1, "Cold rolling", 5, "x", "y"), (1, "Cold rolling", 5, "x", "y"), (2, None, None, None, None), (3, "cold_rolling", 1, "", ""), (None, "", None, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted((r.row_key or 0, r.term_id) for r in map_to_terms([(df, "rec_key", ("deformation_process",))], terms).collect())
    assert got == [(0, 0), (1, 101), (1, 101)]
    assert map_to_terms([(df.where("false"), "rec_key", ("deformation_process",))], terms).count() == 0
    assert {r.term_id for r in map_to_terms([(df, "rec_key", ("deformation_process",))], terms.where("false")).collect()} == {0}


def test_aliases_of_another_list_are_a_table(spark):
    terms = spark.createDataFrame([(1, "city", "Cologne", None), (2, "city", "Munich", None)], "term_id bigint, field_name string, label string, gloss string")
    aliases = spark.createDataFrame([("city", "Köln", "Cologne", True), ("city", "München", "Munich", True), ("city", "Munchkin", None, False), (None, "x", "y", None)], "field_name string, phrase string, label string, fuzzy boolean")
    df = spark.createDataFrame([(k, v) for k, v in enumerate(["koeln", "Köln (Deutz)", "muenchen", "Munchkin", "Muncih", "Cologne", "Paris"])], "id bigint, city string")
    got = {r.entry: r.term_id for r in map_to_terms([(df, "id", ("city",))], terms, aliases=aliases).collect()}
    assert got == {"koeln": 1, "Köln (Deutz)": 1, "muenchen": 2, "Munchkin": 0, "Muncih": 2, "Paris": 0}


def test_whole_tables(spark, sf):
    rows = p1_found(spark, sf).collect()
    assert rows and len({(r.field_name, r.row_key) for r in rows}) == len(rows)
