"""Pages that are mostly keyword piles, link lists or shop tags (problem 9).

Texts are cut into blocks of like lines, and content and link features are computed of each block in one pass that is
kept. Rules that are sure of themselves label some blocks, most stay without a label; bagged decision trees are trained
on the labels of a bounded sample of pages, and on EXAMPLES built by rule, and give every block a probability. The page's
prediction is the probability that most of its characters lie in spam blocks. It is smoothed with the spam rate of the
page's host on the scale of log odds, with a weight fitted to the labelled pages of the sample.

Defined results: null, empty and blank texts are no spam; whole texts count, however long; repeated texts come out
each; a table without labels is judged by trees of the examples alone. Null hosts form one host. Further columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolex.llm.trees import BaggedTrees
from ferrolex.session import cut, spread

#: Pages in the training sample (expected number; all pages of smaller tables), and labelled blocks of either kind used of
#: them at most.
TRAIN_PAGES, TRAIN_BLOCKS = 10_000, 10_000
#: Examples of each kind that training starts from, built by rule.
EXAMPLES = 120
#: Pages of average spam rate added to each host, and the largest weight of the host's log odds that is tried.
HOST_PRIOR, MOST_WEIGHT = 20.0, 2.0
#: Log odds of a page are kept within this.
SUREST = 6.0

# Function words of English, German and French, and words of trade as they are used in search terms.
FUNCTION_WORDS = frozenset(
    "the and to in is a an for that by with as at from was were are be been on it its this these those which who our we they he she not or "
    "than if when may can could should would has have had does do but both after before below above between against into only also more most "
    "because while since although until each all any no further such here there their you your "
    "der die das den dem des und von zu zum zur mit sich auf für ist im in nicht ein eine einer eines als auch nach bei wird wurde wurden werden "
    "aus wir sie er es dass obwohl sobald wenn durch über unter noch haben hat je um am vom "
    "le la les des et un une que qui est sont été pour dans ce cette pas sur avec au aux par nous dès se sa son ses ou mais plus on à".split()
)
TRADE_WORDS = frozenset(
    "buy price prices cheap sale wholesale discount supplier suppliers manufacturer manufacturers factory export quote stock online shop order "
    "best quality cart basket sku tags item near download free pdf top custom polished forged new pure cnc eur usd offer deal partner "
    "kaufen preis preise günstig angebot hersteller lieferant bestellen großhandel lager "
    "acheter prix promo fabricant fournisseur pas cher ligne livraison vente devis grossiste".split()
)
WORD = re.compile(r"[^\W\d_]+(?:[-'][^\W\d_]+)*")
ASCII_WORD = re.compile(r"[a-z]+(?:[-'][a-z]+)*")  # the same for lower-case text in ASCII
URL = re.compile(
    r"\b\w+://\S+|\b[\w-]{1,63}(?:\.[\w-]{1,63}){0,6}\.(?:com|net|org|info|example|invalid|test|biz|shop|de|fr)\b(?:/\S*)?"
)  # a label of a domain has 63 characters at most
TRADE_PHRASE = re.compile(
    r"\b(?:in stock|near me|buy online|best quality|add to (?:cart|basket)|for sale|free shipping|en ligne|pas cher|en stock|à vendre|auf lager|in den warenkorb|"
    r"see also)\b|^more (?=.+ at\b)| at\s*$",
    re.I | re.M,
)
HASHTAG = re.compile(r"#\w+")
SHOP = re.compile(r"add to (?:cart|basket)|\bSKU\b|\bin stock\b|^tags:|^item \d|\b(?:EUR|USD|\$|€) ?\d|in den warenkorb|ajouter au panier|^partner:|^see also:|^more .+ at ", re.I | re.M)
LINK_HINTS = ("://", "<a", "](", ".com", ".net", ".org", ".info", ".example", ".invalid", ".test", ".biz", ".shop", ".de", ".fr")
TRADE_HINTS = (
    "add to ", "sku", "in stock", "tags:", "item ", "eur ", *(f"eur{k}" for k in range(10)), "usd", "$", "€", "warenkorb", "au panier", "partner:", "see also", "near me", "buy online",
    "best quality", "for sale", "free shipping", "en ligne", "pas cher", "en stock", "à vendre", "auf lager", "\nmore ",
)
AT_LINE_END = re.compile(r" at\s*$", re.M)
REFERENCE_HINTS = ("et al", "doi", "vol.", "(19", "(20", ", 19", ", 20")
DIGIT = re.compile(r"\d")
REFERENCE = re.compile(r"\bet al\b|\bdoi\b|\bvol\. ?\d|\((?:19|20)\d\d\)|, (?:19|20)\d\d\b")
SENTENCE_END = re.compile(r"[.!?](?:\s|$)")
SEPARATORS = (*",;|/·•>»", " - ")
LIST_MARK = re.compile(r"\s*(?:[-*•]|\d+[.)])\s")
CAMEL = re.compile(r"[a-zäöü][A-ZÄÖÜ]")
KEYWORD_LINE = re.compile(r"\s*(?:keywords|schlagwörter|mots-clés)\s*:", re.I)
FEATURES = (
    "function_share", "trade_share", "link_share", "hashtag_share", "shop_marks", "digit_share", "distinct_share", "separator_rate", "end_rate",
    "reference_rate", "line_words", "top_word_share", "log_words", "upper_share", "camel_rate", "list_mark_share", "repeat_pairs", "glossary",
)
AT = {name: k for k, name in enumerate(FEATURES)}


def trade_hinted(text: str) -> bool:
    """Whether a text can hold marks or phrases of trade; misses none."""
    low = text.lower()
    if not low.isascii():
        low = low.replace("i\u0307", "i").replace("ı", "i").replace("ſ", "s")  # as the patterns ignore case
    return any(h in low for h in TRADE_HINTS) or low.startswith("more ") or (" at" in low and AT_LINE_END.search(low) is not None)


def hinted(text: str) -> tuple[bool, bool]:
    """Whether the text can hold links, and whether it can hold marks or phrases of trade; cheap tests that miss none."""
    low = text.lower()
    return any(h in low for h in LINK_HINTS), trade_hinted(text)


def link_spans(text: str) -> list[tuple[int, int]]:
    """Places of anchors, markdown links, addresses and domains, of any length; no character is looked at again and again."""
    found = []
    at, close, end = 0, -1, -1
    while (at := text.find("<a", at)) >= 0:
        if not text[at + 2 : at + 3].isspace():
            at += 2
            continue
        close = text.find(">", at) if close < at else close
        if close < 0:
            break
        end = text.find("<", close + 1) if end <= close else end
        if end < 0:
            break
        if text.startswith("</a>", end):
            found.append((at, end + 4))
            at = end + 4
        else:
            at += 2
    at = floor = 0
    while (at := text.find("](", at)) >= 0:
        start, end = text.rfind("[", floor, at), text.find(")", at)
        if end < 0:
            break
        floor = at + 2
        if start >= 0 and "://" in text[at:end] and "\n" not in text[at:end]:
            found.append((start, end + 1))
            floor = end + 1
        at = floor
    taken = sorted(found)
    out, last, k = [], 0, 0
    for m in URL.finditer(text):
        a, b = m.span()
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k == len(taken) or b <= taken[k][0]:
            out.append((a, b))
    merged: list[tuple[int, int]] = []
    for a, b in sorted(taken + out):
        if a >= last:
            merged.append((a, b))
            last = b
    return merged


def columns(line: str) -> tuple[int, ...]:
    return tuple(line.count(c) for c in "\t;|")


def with_digits(tokens: list[str]) -> int:
    return sum([not t.isalpha() and DIGIT.search(t) is not None for t in tokens])


class Line:
    """What is counted of one line."""

    __slots__ = ("text", "words", "function", "trade", "phrases", "shop", "links", "tokens", "upper", "digits", "hashtags", "references", "kind")

    def __init__(self, text: str, plain: str, links: int, trade: bool, tagged: bool):
        self.text, self.links = text, links
        self.phrases = self.shop = 0
        if trade and trade_hinted(plain):
            self.phrases = len(TRADE_PHRASE.findall(plain))
            self.shop = len(SHOP.findall(plain))
            if self.phrases or self.shop:
                plain = TRADE_PHRASE.sub(" ", SHOP.sub(" ", plain))
        low = plain.lower()
        self.words = (ASCII_WORD if low.isascii() else WORD).findall(low)
        self.function = sum(map(FUNCTION_WORDS.__contains__, self.words))
        self.trade = sum(map(TRADE_WORDS.__contains__, self.words))
        tokens = text.split()
        self.tokens = len(tokens)
        self.upper = sum([t[0].isupper() for t in tokens])
        self.digits = with_digits(tokens) if DIGIT.search(text) else 0
        self.hashtags = len(HASHTAG.findall(text)) if tagged else 0
        self.references = len(REFERENCE.findall(text)) if any(h in text for h in REFERENCE_HINTS) else 0
        whole = not (links or self.phrases or self.shop)
        self.kind = self.classify(plain, tokens if whole else plain.split(), whole)

    def classify(self, plain: str, bare: list[str], whole: bool) -> str:
        """p prose, n numbers, r references, o other, from the tokens of the line without links and phrases of trade."""
        n = len(self.words)
        if not bare or self.links > 0.4 * len(self.text) or len(plain) < 0.6 * len(self.text):
            return "o"
        if self.references:
            return "r"
        if n >= 4 and self.function >= 0.12 * n:
            return "p"
        digits = self.digits if whole else with_digits(bare)
        return "n" if digits >= 0.5 * len([t for t in bare if t.isalnum() or any(c.isalnum() for c in t)]) and n <= 1 + digits else "o"


def page_lines(text: str) -> list[Line | None]:
    """The lines of a text, None for blank ones; links are found in the text as a whole."""
    text = text.replace("\xa0", " ")
    linked, trade = hinted(text)
    spans = link_spans(text) if linked else []
    masked = text
    if spans:
        parts, last = [], 0
        for a, b in spans:
            parts += [text[last:a], re.sub(r"[^\n]", " ", text[a:b])]
            last = b
        masked = "".join(parts) + text[last:]
    tagged = "#" in text
    out: list[Line | None] = []
    at = k = 0
    for line in text.splitlines(keepends=True):
        end = at + len(line)
        links = 0
        while k < len(spans) and spans[k][0] < end:
            links += min(end, spans[k][1]) - max(at, spans[k][0])
            if spans[k][1] > end:
                break
            k += 1
        out.append(Line(line, masked[at:end], links, trade, tagged) if line.strip() else None)
        at = end
    return out


def block_lines(text: str) -> list[list[Line]]:
    """Runs of like lines; a blank line ends a run. A heading with the columns of the numbers below belongs to them."""
    lines = page_lines(text)
    for a, b in zip(lines, lines[1:]):
        if a and b and a.kind in ("o", "p") and b.kind == "n" and any(columns(a.text)) and columns(a.text) == columns(b.text):
            a.kind = "n"
    out: list[list[Line]] = []
    last = ""
    for line in lines:
        if line is None:
            last = ""
        elif line.kind == last:
            out[-1].append(line)
        else:
            out.append([line])
            last = line.kind
    return out


def blocks(text: str) -> list[str]:
    return ["".join(x.text for x in run) for run in block_lines(text)]


def features(run: list[Line]) -> list[float]:
    """The content and link features of one block, in the order of FEATURES."""
    block = "".join(x.text for x in run)
    words = [w for x in run for w in x.words]
    n, m, lines = max(1, len(words)), max(1, sum(x.tokens for x in run)), len(run)
    phrases = sum(x.phrases for x in run)
    counts = Counter(words)
    content = list(filterfalse(FUNCTION_WORDS.__contains__, words))
    pairs = list(zip(content, content[1:]))
    return [
        sum(x.function for x in run) / n,
        min(1.0, (sum(x.trade for x in run) + 2 * phrases) / (n + 2 * phrases)),
        sum(x.links for x in run) / max(1, len(block)),
        sum(x.hashtags for x in run) / m,
        sum(x.shop for x in run) / lines,
        sum(x.digits for x in run) / m,
        len(counts) / n,
        sum(map(block.count, SEPARATORS)) / m,
        len(SENTENCE_END.findall(block)) / m,
        sum(x.references for x in run) / lines,
        len(words) / lines,
        max(counts.values(), default=0) / n,
        math.log1p(len(words)),
        sum(x.upper for x in run) / m,
        len(CAMEL.findall(block)) / m if "#" in block else 0.0,
        sum(LIST_MARK.match(x.text) is not None for x in run) / lines,
        1 - len(set(pairs)) / len(pairs) if pairs else 0.0,
        sum(": " in x.text for x in run) / lines,
    ]


def weak_label(block: str, f: list[float]) -> int:
    """1 surely spam, 0 surely content, -1 not sure; a block whose signs are weak or mixed is not sure."""
    v = {name: f[k] for name, k in AT.items()}
    words = math.expm1(v["log_words"])
    if v["reference_rate"] > 0.5 and v["link_share"] < 0.3 or KEYWORD_LINE.match(block):
        return 0
    if v["hashtag_share"] > 0.6 and words >= 3:
        return 1
    if v["function_share"] >= 0.2 and v["trade_share"] < 0.1 and v["link_share"] < 0.1 and v["end_rate"] > 0 and words >= 8:
        return 0
    if v["function_share"] < 0.06:
        if v["link_share"] > 0.5 or (v["trade_share"] >= 0.2 and words >= 15) or (v["shop_marks"] >= 0.75 and words >= 6):
            return 1
        if words >= 25 and v["repeat_pairs"] > 0.4 and v["digit_share"] < 0.2 and v["separator_rate"] > 0.1:
            return 1
    if v["digit_share"] > 0.55 and v["trade_share"] == 0 and v["link_share"] == 0 and v["shop_marks"] == 0:
        return 0
    return -1


def examples(seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of EXAMPLES blocks of either kind, built by rule from the word lists, to start training from."""
    rng = np.random.default_rng(seed)
    function, trade = sorted(w for w in FUNCTION_WORDS if w.isascii()), sorted(TRADE_WORDS)
    noun = lambda: "".join(rng.choice(list("bcdfglmnprst")) + rng.choice(list("aeiou")) for _ in range(rng.integers(2, 5)))
    nouns = [noun() for _ in range(200)]
    pick = lambda words, n: [str(w) for w in rng.choice(words, n)]

    def spam(kind: int) -> str:
        few, n = pick(nouns, 4), int(rng.integers(6, 40))
        terms = [" ".join(pick(few, 2) + (pick(trade, 1) if rng.random() < 0.5 else [])) for _ in range(n)]
        if kind == 0:
            return str(rng.choice([", ", "; ", " | ", " - ", "\n"])).join(terms)
        if kind == 1:
            style = ("http://{w}.test/{k} {t}", "[{t}](http://{w}.test/{k})", "http://{w}.test/{k}", '<a href="http://{w}.test/{k}">{t}</a>')[int(rng.integers(4))]
            return "\n".join(style.format(w=w, k=rng.integers(999), t=t) for w, t in zip(pick(nouns, n), terms))
        if kind == 2:
            styles = ("SKU {k} | {t} | in stock | add to cart", "Tags: {t}, {u}", "Item {k}: {t} / {u}", "Home > {t} > {u}", "{t} ({k})", "See also: {t} | {u}", "{t} {k} mm EUR {k}.90", "custom {t} {k}mm")
            few_styles = pick(styles, int(rng.integers(1, 4)))
            return "\n".join(str(rng.choice(few_styles)).format(k=rng.integers(9999), t=t, u=u) for t, u in zip(terms, reversed(terms)))
        return " ".join("#" + "".join(w.capitalize() for w in t.split()) for t in terms)

    def content(kind: int) -> str:
        n = int(rng.integers(2, 12))
        if kind == 0:  # sentences, half of the texts about trade, some said several times
            own = nouns + trade * int(rng.integers(0, 2)) * 3
            return " ".join(int(rng.integers(1, 4)) * [" ".join(w for pair in zip(pick(own, 6), pick(function, 6)) for w in pair).capitalize() + "." for _ in range(n)])
        if kind == 1:
            return "\n".join("\t".join(f"{x:.2f}" for x in rng.random(5) * 900) for _ in range(n))
        if kind == 2:
            return "\n".join(f"[{k}] {w.capitalize()} et al., vol. {rng.integers(99)} ({rng.integers(1950, 2024)}) {rng.integers(999)}." for k, w in enumerate(pick(nouns, n)))
        return "\n".join(f"{k}. " + " ".join(w for pair in zip(pick(nouns, 4), pick(function, 4)) for w in pair) + f" {rng.integers(999)} K" for k in range(n))

    x, y = [], []
    for k in range(EXAMPLES):
        for label, text in ((1, spam(k % 4)), (0, content(k % 4))):
            for run in block_lines(text):
                x.append(features(run))
                y.append(label)
    return np.array(x, dtype=float), np.array(y)


PAGES = "page bigint, host string, sizes array<int>, labels array<tinyint>, f array<float>"


def _featurize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for page, host, text in zip(batch["page"], batch["host"], batch["text"]):
            sizes, labels, flat = [], [], []
            for run in block_lines(text):
                block = "".join(x.text for x in run)
                f = features(run)
                sizes.append(len(block.strip()))
                labels.append(weak_label(block, f))
                flat += f
            out.append((page, host, sizes, labels, flat))
        yield pd.DataFrame(out, columns=["page", "host", "sizes", "labels", "f"])


def page_features(pages: DataFrame) -> DataFrame:
    """The features of all blocks of each page, computed once and kept: PAGES."""
    return cut(pages.mapInPandas(_featurize, PAGES))


def sample_of(pages: DataFrame, seed: int = 7) -> pd.DataFrame:
    """About TRAIN_PAGES pages by a hash of their id, all of a smaller table."""
    n = pages.count()
    share = (1 << 30) if n <= TRAIN_PAGES else (TRAIN_PAGES << 30) // n
    return pages.where(F.pmod(F.xxhash64("page", F.lit(seed)), F.lit(1 << 30)) < F.lit(share)).orderBy("page").limit(2 * TRAIN_PAGES).toPandas()


def labelled(sample: pd.DataFrame, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and pages (row of the sample) of the labelled blocks of a sample, at most TRAIN_BLOCKS of either kind."""
    rows = [(np.asarray(f, dtype=float).reshape(len(ls), len(FEATURES)), np.asarray(ls), k) for k, (ls, f) in enumerate(zip(sample["labels"], sample["f"])) if len(ls)]
    if not rows:
        return np.zeros((0, len(FEATURES))), np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    x, y = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    page = np.concatenate([np.full(len(r[1]), r[2]) for r in rows])
    rng = np.random.default_rng(seed)
    kinds = [np.flatnonzero(y == kind) for kind in (0, 1)]
    sure = np.sort(np.concatenate([k if len(k) <= TRAIN_BLOCKS else rng.choice(k, TRAIN_BLOCKS, replace=False) for k in kinds]))
    return x[sure], y[sure].astype(int), page[sure]


def train(sample: pd.DataFrame, seed: int = 7) -> BaggedTrees:
    x, y, _ = labelled(sample, seed)
    x0, y0 = examples()
    return BaggedTrees(seed=seed).fit(np.concatenate([x0, x]), np.concatenate([y0, y]))


def page_odds(sizes: np.ndarray, p: np.ndarray) -> tuple[float, float]:
    """Log odds that most characters lie in spam blocks, and their expected share, from the blocks' probabilities.

    The sum of independent blocks is taken as normal around its mean; a page without characters is no spam.
    """
    total = float(sizes.sum())
    if not total:
        return -SUREST, 0.0
    mean, spread = float((sizes * p).sum()), math.sqrt(float((sizes**2 * p * (1 - p)).sum()))
    z = (mean - total / 2) / max(spread, 1e-9 * total)
    tail = 0.5 * math.erfc(min(40.0, abs(z)) / math.sqrt(2))
    odds = math.log(max(1 - tail, 1e-12) / max(tail, 1e-12))
    return max(-SUREST, min(SUREST, odds if z > 0 else -odds)), mean / total


def judge(model: BaggedTrees):
    """mapInPandas function: PAGES rows to page, host, log odds and share of characters in spam blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            flat = [np.asarray(f, dtype=float) for f in batch["f"]]
            x = np.concatenate(flat).reshape(-1, len(FEATURES)) if len(flat) else np.zeros((0, len(FEATURES)))
            p = model.predict(x)
            odds, shares, at = [], [], 0
            for sizes in batch["sizes"]:
                o, s = page_odds(np.asarray(sizes, dtype=float), p[at : at + len(sizes)])
                odds.append(o)
                shares.append(s)
                at += len(sizes)
            yield pd.DataFrame({"page": batch["page"], "host": batch["host"], "odds": odds, "share": shares})

    return run


def fitted_weight(sample: pd.DataFrame, lift: np.ndarray, seed: int = 7) -> float:
    """The weight of the host's log odds that makes the weak labels of sample pages most likely beside the trees.

    Trees judge only pages that they were not trained on (two halves), pages count whose labelled characters are all of
    one kind; 0 where there are none of either kind.
    """
    x, y, page = labelled(sample, seed)
    x0, y0 = examples()
    n = len(sample)
    odds, label = np.full(n, np.nan), np.full(n, -1)
    sizes = [np.asarray(v, dtype=float) for v in sample["sizes"]]
    for k, labels in enumerate(sample["labels"]):
        labels = np.asarray(labels)
        kinds = set(labels[labels >= 0].tolist())
        if len(kinds) == 1 and (labels >= 0).mean() > 0.5:
            label[k] = kinds.pop()
    for half in (0, 1):
        own = page % 2 != half
        model = BaggedTrees(seed=seed + half).fit(np.concatenate([x0, x[own]]), np.concatenate([y0, y[own]]))
        judged = [k for k in range(half, n, 2) if label[k] >= 0]
        if judged:
            p = model.predict(np.concatenate([np.asarray(sample["f"].iloc[k], dtype=float) for k in judged]).reshape(-1, len(FEATURES)))
            ends = np.cumsum([len(sizes[k]) for k in judged])
            for k, part in zip(judged, np.split(p, ends[:-1])):
                odds[k] = page_odds(sizes[k], part)[0]
    known = label >= 0
    if len(set(label[known].tolist())) < 2:
        return 0.0
    t = np.where(label[known] == 1, 1.0, -1.0)
    tried = np.linspace(0.0, MOST_WEIGHT, 41)
    loss = [np.logaddexp(0.0, -t * (odds[known] + w * lift[known])).sum() for w in tried]
    return float(tried[int(np.argmin(loss))])


def host_lift(spam: Column, n: Column, rate: float) -> Column:
    """Log odds of a host's spam rate, drawn to the rate of all pages by HOST_PRIOR pages, above those of all pages."""
    own = (spam + HOST_PRIOR * rate) / (n + HOST_PRIOR)
    return F.log(own / (1 - own)) - math.log(rate / (1 - rate))


def score(docs: DataFrame, host: Column | None = None, key: str = "doc_id", model: BaggedTrees | None = None, weight: float | None = None) -> DataFrame:
    """key, host, share (of characters in spam blocks), odds (before smoothing), smoothed, is_spam for every page with a text.

    The host rates are one pre-aggregated row per host, joined without a forced broadcast.
    """
    host = F.col("source") if host is None else host
    texts = docs.select(F.col(key).cast("bigint").alias("page"), F.coalesce(host.cast("string"), F.lit("")).alias("host"), "text").where("text is not null")
    pages = page_features(spread(texts))
    sample = sample_of(pages) if model is None or weight is None else None
    model = train(sample) if model is None else model
    judged = cut(pages.mapInPandas(judge(model), "page bigint, host string, odds double, share double"))
    spam = F.when(F.col("odds") > 0, 1.0).otherwise(0.0)
    sums = judged.agg(F.sum(spam).alias("s"), F.count("*").alias("n")).first()
    rate = ((sums.s or 0.0) + 0.5) / (sums.n + 1.0)
    hosts = judged.groupBy("host").agg(host_lift(F.sum(spam), F.count("*"), rate).alias("lift"))
    if weight is None:
        own = dict(hosts.where(F.col("host").isin(sorted(set(sample["host"])))).collect()) if len(sample) else {}  # hosts of the sample
        weight = fitted_weight(sample, np.array([own.get(h, 0.0) for h in sample["host"]]))
    smoothed = F.col("odds") + F.lit(weight) * F.col("lift")
    out = judged.join(hosts, "host").select(F.col("page").alias(key), "host", "share", "odds", (1 / (1 + F.exp(-smoothed))).alias("smoothed"))
    return out.withColumn("is_spam", F.col("smoothed") > 0.5)
