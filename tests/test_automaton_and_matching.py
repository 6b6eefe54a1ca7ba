import itertools

from hypothesis import given, settings
from hypothesis import strategies as st

from ferrolex.functions.automaton import PhraseAutomaton
from ferrolex.functions.matching import best_matching


def test_longest_match_wins():
    a = PhraseAutomaton([("hafnium", 1), ("hafnium carbide", 2), ("carbide", 3)])
    assert a.longest("pure hafnium carbide") == [(5, 20, 2)]
    assert a.longest("") == [] and PhraseAutomaton([]).longest("x") == []


def test_whole_words_only():
    a = PhraseAutomaton([("re", 1)])
    assert a.longest("rest") == [] and a.longest("w re!") == [(2, 4, 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0, 0, 0.2, 0.5, 0.9]), min_size=3, max_size=3), min_size=0, max_size=4))
def test_matching_is_best(w):
    got = sum(w[i][j] for i, j in best_matching(w))
    n = max(len(w), 3)
    full = [[w[i][j] if i < len(w) and j < 3 else 0 for j in range(n)] for i in range(n)]
    assert abs(got - max(sum(full[i][p[i]] for i in range(n)) for p in itertools.permutations(range(n)))) < 1e-9
