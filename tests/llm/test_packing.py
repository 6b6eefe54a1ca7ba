import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrolex.llm.packing import best_fit_decreasing, certified, lower_bound, pack, report
from ferrolex.llm.tokens import encode


def fewest(sizes, capacity):
    best = [len(sizes)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b + sizes[i] <= capacity}.values():
            bins[k] += sizes[i]
            put(i + 1, bins)
            bins[k] -= sizes[i]
        put(i + 1, [*bins, sizes[i]])

    put(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.integers(3, 30), st.lists(st.integers(1, 30), max_size=8))
def test_bounds_hold_and_bins_fit(capacity, sizes):
    sizes = [min(s, capacity) for s in sizes]
    fill = {}
    for b, s in zip(best_fit_decreasing(sizes, capacity), sizes):
        fill[b] = fill.get(b, 0) + s
    assert all(v <= capacity for v in fill.values())
    assert lower_bound(sizes, capacity) <= fewest(sorted(sizes, reverse=True), capacity) <= len(fill)


def test_dual_feasible_bound_beats_the_sum():
    assert lower_bound([6, 6, 6], 10) == 3 and lower_bound([], 10) == 0


@pytest.mark.parametrize("group", [1, 4, 512])
def test_every_text_comes_out(spark, group):
    rng = random.Random(group)
    rows = [(i, "word " * rng.choice([1, 3, 20, 60, 90, 150, 700]), "x", 3) for i in range(200)] + [(900, None, "x", 1), (901, "", "x", 1), (902, "word " * 3, "x", 1), (None, "a b c", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, container string, part int")
    got = pack(df, capacity=100, group_containers=group).collect()
    fill, parts = {}, {}
    for r in got:
        assert (r.container is None) == (r.n_tokens == 0)
        if r.container:
            fill[r.container] = fill.get(r.container, 0) + r.n_tokens
        parts.setdefault(r.doc_id, []).append((r.first_token, r.n_tokens))
    assert max(fill.values()) <= 100
    for doc_id, text, _, _ in rows:
        n = len(encode(text)) if text else 0
        assert sum(x for _, x in parts[doc_id]) == n
        assert (len(parts[doc_id]) > 1) == (n > 100)
    sizes = [r.n_tokens for r in got if r.container]
    together = len(set(best_fit_decreasing(sizes, 100)))  # as if one group held everything
    assert lower_bound(sizes, 100) <= len(fill) <= together * (1.0 if group == 512 else 1.1)
    packed, certificates = certified(df, 100, group_containers=group)
    r = report(packed, 100, certificates).first()
    assert r.n_tokens == sum(fill.values()) and r.largest_fill <= 100 and r.gap == r.n_containers - r.bound
    assert -(-r.n_tokens // 100) <= r.bound <= lower_bound(sizes, 100) and r.n_certified_groups <= r.n_groups and r.group_bounds <= r.group_bins


def test_repeated_long_rows_and_rows_without_id_get_containers_of_their_own(spark):
    long = "word " * 2050
    df = spark.createDataFrame([(1, long), (1, long), (None, long), (None, long), (0, long), (8589934592, long)], "doc_id bigint, text string").repartition(3)
    fill = {}
    for r in pack(df, capacity=500).collect():
        fill[r.container] = fill.get(r.container, 0) + r.n_tokens
    assert max(fill.values()) == 500 and len(fill) == 6 * 4 + 1


def test_one_id_for_all_rows_still_spreads_over_groups(spark):
    df = spark.createDataFrame([(7, "word " * (20 + k % 60)) for k in range(400)], "doc_id bigint, text string")
    _, certificates = certified(df, capacity=100, group_containers=20)
    assert certificates.where("round_no = 0").count() > 5


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert pack(df).count() == 0 and report(pack(df)).first().n_containers == 0
    with pytest.raises(ValueError):
        pack(df, 0)


def test_special_strings_are_text():
    assert len(encode("<|endoftext|>")) > 1
