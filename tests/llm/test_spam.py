import math
import time

import numpy as np
import pandas as pd

from ferrolex.llm import spam
from ferrolex.llm.spam import FEATURES, SHOP, TRADE_PHRASE, URL, block_lines, blocks, features, hinted, link_spans, page_odds, score, weak_label
from ferrolex.llm.trees import BaggedTrees

PROSE = "The specimens were annealed in hydrogen and the hardness was measured after each step. We found that it falls when the grains grow."
TABLE = "T (K)\tHV\tgrain\nR1\t642\t29.8\nB2\t542\t58.6\nC3\t401\t41.7\nA4\t1033\t28.4"
REFERENCES = "[1] Veldrup, Refr. Met. Notes 89 (1980) 1837.\n[2] Pirrano, J. Hard Matter 1 (1993) 469.\n[3] Ostrik et al. vol. 79, 2017, doi:10.1/x"
PILE = "tungsten rod price, tungsten sheet cheap, tungsten wire buy online, tungsten rod supplier, tungsten plate wholesale, tungsten rod price, tungsten foil sale"
LINKS = "\n".join(f'<a href="http://shop-{i}.test/{i}">tungsten rod {i}</a>' for i in range(12))
TAGS = "\n".join(f"SKU W-{i} | tungsten rod {i}mm | in stock | add to cart" for i in range(8))
TRADE = "The supplier quotes a price for tungsten disc only on request, and buyers should ask which tests were done on the batch before they order."


def test_trees_learn_and_stay_the_same():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 6))
    y = ((x[:, 1] > 0.6) & (x[:, 4] < 0.5)).astype(int)
    model = BaggedTrees(seed=3).fit(x[:1500], y[:1500])
    held_out = (model.predict(x[1500:]) > 0.5) == y[1500:]
    assert held_out.mean() > 0.97
    assert (BaggedTrees(seed=3).fit(x[:1500], y[:1500]).predict(x) == model.predict(x)).all()
    assert (BaggedTrees().predict(x) == 0).all() and BaggedTrees().fit(x[:0], y[:0]).trees == []


def test_blocks_cover_the_text_and_labels_are_sure():
    text = f"{PROSE}\n\n{TABLE}\n{PROSE}\n{PILE}"
    assert "".join("".join(blocks(text)).split()) == "".join(text.split())
    label = lambda b: [weak_label("".join(x.text for x in run), features(run)) for run in block_lines(b)]
    for b in (PROSE, REFERENCES, TABLE):
        assert label(b) == [0]
    for b in (PILE, LINKS, TAGS):
        assert label(b) == [1]
    assert label(TRADE) == [-1] or label(TRADE) == [0]
    assert blocks("") == [] and blocks(" \n \n") == []


def test_hints_miss_nothing_that_the_patterns_find():
    lines = [f"rod EUR{k}" for k in range(10)] + ["rod eur 7", "USD5", "x€ 3", "x$9", "More rods at Hartwig", "more tungsten at a-b", "all rods at", "all rods at \t", "x at\r\ny"]
    lines += ["<a\nhref='x'>y</a>", "<a\thref='x'>y</a>", "[x](ftp://y)", "see x.de", "\u0131tem 4", "\u0130tem 4", "\u017fku", "Tags: a", "Partner: b", "in den Warenkorb", "Ajouter au panier", "À vendre"]
    for x in lines:
        for text in (x, f"prose\n{x}\nprose"):
            links, trade = hinted(text)
            assert links or not link_spans(text), text
            assert trade or not (SHOP.search(text) or TRADE_PHRASE.search(text)), text
            assert link_spans(text) or SHOP.search(text) or TRADE_PHRASE.search(text), text
    assert features(block_lines("rod EUR7 sheet EUR5")[0])[FEATURES.index("shop_marks")] > 0


def test_links_of_any_length_are_found_in_one_pass():
    long = f'<a href="http://a.test/{"x" * 5000}">{"rod " * 1000}</a> and [{"w" * 900}](http://b.test/{"y" * 900}) and verylongscheme://x'
    assert [long[a:b][:3] for a, b in link_spans(long)] == ["<a ", "[ww", "ver"] and sum(b - a for a, b in link_spans(long)) == len(long) - len(" and " * 2)
    assert link_spans("see [1] (p. 3), a<b and c>d, no link") == [] and URL.search("x.de/a")
    began = time.time()
    for hard in ("<a " * 60_000, "[" * 60_000 + "](", "<a >" * 60_000, "](" * 60_000, "a-" * 60_000, "<a " * 30_000 + ">" + "<" * 30_000):
        link_spans(hard)
    assert time.time() - began < 20


def test_pages_are_judged_by_the_probability_of_a_spam_majority():
    assert page_odds(np.array([]), np.array([])) == (-spam.SUREST, 0.0)
    assert page_odds(np.array([10.0, 30.0]), np.array([0.0, 1.0])) == (spam.SUREST, 0.75)
    rng = np.random.default_rng(0)
    sizes, p = np.arange(1.0, 60), np.linspace(0.2, 0.72, 59)
    drawn = ((rng.random((20_000, 59)) < p) * sizes).sum(axis=1) > sizes.sum() / 2
    odds = page_odds(sizes, p)[0]
    assert abs(1 / (1 + math.exp(-odds)) - drawn.mean()) < 0.02


def piles(k, words):
    """Search terms without a word of trade: no rule is sure of a short list of them."""
    return ", ".join(f"{words[(k + i) % 7]} {words[(k * 3 + i * 2) % 5]} tungsten" for i in range(10))


def test_trees_find_pages_that_the_rules_leave_open(spark):
    words = "ductile brittle fracture toughness hardness table grain".split()
    pages = [(k, (PROSE, piles(k, words), TABLE, LINKS, PILE, TAGS)[k % 6], "h") for k in range(240)]
    df = spark.createDataFrame(pages, "doc_id bigint, text string, source string")
    got = {r.doc_id: r.is_spam for r in score(df).collect()}
    assert all(got[k] == (k % 6 in (1, 3, 4, 5)) for k in got)
    assert {weak_label(t, features(block_lines(t)[0])) for _, t, _ in pages[1::6]} == {-1}


def test_host_rates_decide_uncertain_pages_and_their_weight_is_fitted(spark):
    unsure = "tungsten wire 3 mm, tungsten wire 5 mm, grain of the wire, hardness, rod, the disc"
    rows = [(k, LINKS if k % 2 else PILE, "bad") for k in range(100)] + [(100 + k, PROSE, "good") for k in range(100)] + [(300, unsure, "bad"), (301, unsure, "good")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    even = {r.doc_id: r for r in score(df, weight=0.0).collect()}
    fitted = {r.doc_id: r for r in score(df).collect()}
    assert even[300].smoothed == even[301].smoothed and fitted[300].smoothed > fitted[301].smoothed
    assert {k: r.is_spam for k, r in fitted.items() if k < 300} == {k: k < 100 for k in range(200)}
    sample = pd.DataFrame({"sizes": [[10]] * 40, "labels": [[k % 2] for k in range(40)], "f": [list(np.full(len(FEATURES), 0.5))] * 40})
    x = np.array([1.0 if k % 2 else -1.0 for k in range(40)])
    assert spam.fitted_weight(sample, x) == spam.MOST_WEIGHT and spam.fitted_weight(sample, -x) == 0.0 and spam.fitted_weight(sample.iloc[:0], x[:0]) == 0.0


def test_pages(spark):
    pages = [PROSE * 3, f"{PROSE}\n\n{TABLE}", f"{PROSE}\n\nReferences\n{REFERENCES}", TRADE * 2, PILE * 3, LINKS, TAGS, f"{PROSE}\n\n{PILE * 4}", f"{PROSE * 4}\n\n{PILE}", None, "", "  "]
    rows = [(i, t, ("h1", "h2", None)[i % 3], 0.5, True) for i, t in enumerate(pages * 6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, share double, is_spam boolean")
    got = {r.doc_id: r for r in score(df).collect()}
    for i, r in got.items():
        assert r.is_spam == (i % len(pages) in (4, 5, 6, 7)), (i, r.share)
    assert len(got) == 66
    assert score(df.where("false")).count() == 0
    assert score(df.where("doc_id = 0")).first().is_spam is False


def test_long_text(spark):
    df = spark.createDataFrame([(1, (PILE + "\n") * 800, "h"), (2, (PROSE + "\n") * 800, "h")], "doc_id bigint, text string, source string")
    assert {r.doc_id: r.is_spam for r in score(df).collect()} == {1: True, 2: False}
