import numpy as np

from ferrolex.llm.mixing import draw, mix, permuted, plan, size_of_mix, split
from ferrolex.llm.tokens import encode


def test_permutation():
    for n in (1, 2, 7, 64, 1000):
        for key in (0, 12345):
            p = permuted(np.arange(n), np.full(n, n), np.full(n, key))
            assert sorted(p) == list(range(n))
    assert list(permuted(np.arange(50), np.full(50, 50), np.full(50, 1))) != list(permuted(np.arange(50), np.full(50, 50), np.full(50, 2)))


def test_plan():
    given = plan({"a": 1000, "b": 100, "c": 1000}, {"a": (0.5, 1), "b": (0.3, 2), "c": (0.2, 1), "d": (0.1, 9)}, tolerance=0.0)
    assert abs(given["b"] - 200) < 1 and abs(given["a"] / given["c"] - 2.5) < 0.01
    assert plan({}, {"a": (1.0, 1)}) == {} and plan({"a": 5}, {"a": (0.0, 1)}) == {}


def test_the_draw_splits_and_keeps_the_totals():
    counts = np.array([7000, 300, 1, 0])
    every = list(draw(counts, 256, 0, 10**9))
    assert [k for k, _, _ in every] == list(range(29)) and sum(n for _, n, _ in every).tolist() == counts.tolist()
    assert all(n.sum() == 256 for _, n, _ in every[:-1])
    at = np.zeros(4, dtype=int)
    for _, n, start in every:
        assert start.tolist() == at.tolist()
        at += n
    for first, last in ((0, 5), (13, 14), (20, 40)):  # a task that draws some shards gets the same as one that draws all
        assert [(k, n.tolist(), s.tolist()) for k, n, s in draw(counts, 256, first, last)] == [(k, n.tolist(), s.tolist()) for k, n, s in every[first:last]]
    assert 3 < np.std([n[1] for _, n, _ in every[:-1]]) < 5 and list(draw(np.array([], dtype=int), 256, 0, 9)) == []


def test_splits_of_any_size(monkeypatch):
    rng = np.random.default_rng(0)
    for exact in (500_000_000, 10):
        monkeypatch.setattr("ferrolex.llm.mixing.EXACT_SLOTS", exact)
        for _ in range(200):
            counts = rng.integers(0, 50, 6)
            take = int(rng.integers(0, counts.sum() + 1))
            n = split(counts, take, rng)
            assert n.sum() == take and (n >= 0).all() and (n <= counts).all()
    big = split(np.array([6 * 10**10, 3 * 10**10, 10**10]), 5 * 10**10, rng)
    assert big.sum() == 5 * 10**10 and abs(big[0] / 3e10 - 1) < 1e-4


def test_a_nearly_empty_source_is_sized_like_an_absent_one():
    targets = {"a": (0.5, 2), "b": (0.485, 1), "c": (0.015, 2)}
    without = sum(plan({"a": 900_000, "b": 1_000_000}, targets).values())
    for few in (1, 100, 1_000):
        given = plan({"a": 900_000, "b": 1_000_000, "c": few}, targets)
        assert abs(sum(given.values()) / without - 1) < 0.02 and given["c"] == 2 * few
        assert abs(given["a"] / given["b"] - 0.5 / 0.485) < 0.03
    large = {"a": (0.4, 2), "b": (0.3, 1), "c": (0.3, 2)}
    assert sum(plan({"a": 900_000, "b": 1_000_000, "c": 10}, large).values()) > 2_000_000
    half = plan({"a": 900_000, "b": 1_000_000, "c": 150_000}, large, tolerance=0.0)
    assert abs(half["c"] / sum(half.values()) - 0.3) < 1e-6


def test_size_is_the_largest_within_the_tolerance(monkeypatch):
    monkeypatch.setattr("ferrolex.llm.mixing.GAIN", 1e12)
    rng = np.random.default_rng(1)
    for _ in range(50):
        share = rng.dirichlet(np.ones(6))
        caps = rng.random(6) * 1000
        t = size_of_mix(list(zip(share, caps)), 0.01)
        missing = [np.maximum(0, share * x - caps).sum() / x for x in (t, t * 1.001)]
        assert missing[0] <= 0.01 + 1e-9 < missing[1]


def corpus(spark):
    rows = [(i, f"text {i} of the first source " * (1 + i % 5), "a", 1, "x") for i in range(300)]
    rows += [(1000 + i, f"another text {i} " * 4, "b", 1, "x") for i in range(40)]
    rows += [(2000, rows[0][1], "b", 1, "x"), (2001, None, "a", 1, "x"), (2002, "", "b", 1, "x"), (2003, "not listed", "z", 1, "x"), (2004, "no source", None, 1, "x"), (None, "no id", "a", 1, "x")]
    targets = [("a", 0.6, 1), ("b", 0.3, 3), ("gone", 0.1, 2), (None, 0.5, 1), ("a", 0.1, 9)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, block int, shard string"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int"), rows


def test_mix_meets_shares_and_caps(spark):
    docs, targets, rows = corpus(spark)
    selection, shares = mix(docs, targets, block=16)
    s = {r.source: r for r in shares.collect()}
    assert abs(s["a"].actual_share - 2 / 3) < 0.03 and abs(s["b"].actual_share - 1 / 3) < 0.03 and s["gone"].actual_share == 0 and len(s) == 3
    uses, texts = {}, {d: t for d, t, *_ in rows}
    for r in selection.collect():
        key = (texts[r.doc_id], r.first_token)
        uses[key] = uses.get(key, 0) + 1
        assert r.source in ("a", "b") and 0 < r.n_tokens <= 16 and r.first_token + r.n_tokens <= len(encode(texts[r.doc_id]))
        assert r.doc_id != 2000
    assert max(n for (t, _), n in uses.items() if t.startswith("text")) == 1 and max(uses.values()) <= 3
    again = sorted(map(tuple, mix(docs, targets, block=16)[0].collect()), key=str)
    assert again == sorted(map(tuple, selection.collect()), key=str)


def test_copies_in_unlisted_sources_displace_nothing(spark):
    docs = spark.createDataFrame([(3, "a text held twice", "forum_post"), (4, "a text held twice", None), (9, "a text held twice", "a"), (10, "a text held twice", "a")], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    selection, shares = mix(docs, targets)
    assert {r.doc_id for r in selection.collect()} == {9} and shares.first().tokens_available == len(encode("a text held twice"))


def test_edges(spark):
    docs, targets, _ = corpus(spark)
    for d, t in ((docs.where("false"), targets), (docs, targets.where("false"))):
        selection, shares = mix(d, t)
        assert selection.count() == 0 and all(r.actual_share == 0 for r in shares.collect())
