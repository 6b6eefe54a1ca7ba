"""Free-typed values mapped to the closest entry of a canonical list (problem 1).

A multi-pattern automaton over names and aliases finds the mentions embedded in a value, the longest non-overlapping
match wins. A value that a mention explains up to words without weight is decided; what remains goes to the
similarity of token sets, where tokens match up to typing errors, and where that finds nothing, to the longest mention,
a listed one of five letters and more before strangers; without any mention, windows as wide as a name are compared.
Names of things that are not on the list compete as strangers; a value nearest to a stranger, or near to nothing, is
reported with term 0. The same rules hold for values of any length. Typing errors are looked up in an index of letter
pairs that loses no word within the errors allowed.

Other names of the entries and strangers are a table (`aliases`); without one those of the vocabulary module count.

Defined results: null values give no rows; a blank value names nothing (0); of equally near names the entry of the
list wins over a stranger and the first entry over later ones; repeated rows are mapped each under its own key. An
empty list maps everything to 0, an empty table gives no rows. Columns that are not mapped are not read. Values are
matched whole, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolex.functions.automaton import PhraseAutomaton
from ferrolex.llm.vocabulary import NOISE, fold, phrases
from ferrolex.session import spread
from ferrolex.sources.tables import small_rows

#: Larger canonical lists are refused; they would need another vocabulary than the one below.
MAX_TERMS = 50_000
#: Least similarity of token sets; one typing error is allowed per this many letters of a word.
LEAST_SIMILARITY, LETTERS_PER_ERROR = 0.64, 3
#: Letters of a listed mention that goes before strangers.
LONG_MENTION = 5
#: Rows of a table of aliases at most.
MAX_ALIASES = 500_000
#: Entries remembered by each Python worker.
MEMORY = 100_000


def letter_masks(word: str) -> dict[str, int]:
    """For each letter the bits of the places where it stands."""
    masks: dict[str, int] = {}
    for k, c in enumerate(word):
        masks[c] = masks.get(c, 0) | 1 << k
    return masks


def typing_distance(a: str, b: str, limit: int, masks: dict[str, int] | None = None) -> int:
    """Insertions, deletions, replacements and swaps of neighbours between two words; more than `limit` may be cut.

    A column of the table of distances is kept as bits of its differences, so a letter of b costs a few operations.
    """
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    if not a:
        return len(b)
    masks = letter_masks(a) if masks is None else masks
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, diagonal, before, distance, left = full, 0, 0, 0, len(a), len(b)
    for c in b:
        here = masks.get(c, 0)
        swapped = ((~diagonal & here) << 1) & before
        diagonal = (((here & up) + up) ^ up) | here | down | swapped
        more, less = down | (full & ~(diagonal | up)), diagonal & up
        distance += bool(more & last) - bool(less & last)
        more, less = more << 1 | 1, less << 1
        up, down, before = (less | ~(diagonal | more)) & full, more & diagonal & full, here
        left -= 1
        if distance - left > limit:
            return limit + 1
    return distance


def letters(word: str) -> int:
    """The letters of a word as a set of bits; d typing errors change at most 2 d of them."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 63)
    return bits


def errors_allowed(a: str, b: str) -> int:
    """Typing errors that two words may differ by; numbers and words of one or two letters must be equal."""
    size = max(len(a), len(b))
    return 0 if size <= 2 or a.isdigit() or b.isdigit() else size // LETTERS_PER_ERROR


def letter_pairs(word: str) -> set[str]:
    padded = f"^{word}$"
    return {padded[k : k + 2] for k in range(len(padded) - 1)}


class TypoIndex:
    """Finds the words of a list within the typing errors allowed, by the letter pairs they share.

    An error changes three of a word's letter pairs at most, so a word with d errors keeps all but 3 d of them: only words
    that share so many are compared, and none within the errors is lost as long as one pair is left. Of these, words whose
    sets of letters differ too much are left out before distances are computed.
    """

    def __init__(self, words: list[str]):
        self.words = words
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        self.letters = np.array([letters(w) for w in words], dtype=np.uint64)
        places: dict[str, list[int]] = {}
        for k, w in enumerate(words):
            for pair in letter_pairs(w):
                places.setdefault(pair, []).append(k)
        self.places = {pair: np.array(ks, dtype=np.int64) for pair, ks in places.items()}

    def near(self, word: str) -> list[tuple[int, float]]:
        """(place, likeness) of the words near a word; likeness is 1 less the share of letters in error."""
        pairs = letter_pairs(word)
        lists = [self.places[p] for p in pairs if p in self.places]
        if not lists:
            return []
        found, shared = np.unique(np.concatenate(lists), return_counts=True)
        sizes = self.sizes[found]
        allowed = np.maximum(sizes, len(word)) // LETTERS_PER_ERROR
        keep = (np.abs(sizes - len(word)) <= allowed) & (shared >= np.maximum(1, len(pairs) - 3 * allowed))
        keep &= np.bitwise_count(self.letters[found] ^ np.uint64(letters(word))) <= 2 * allowed
        masks = letter_masks(word)
        out = []
        for k in found[keep]:
            other = self.words[k]
            if other == word:
                out.append((int(k), 1.0))
            elif (limit := errors_allowed(word, other)) and (d := typing_distance(word, other, limit, masks)) <= limit:
                out.append((int(k), 1 - d / max(len(word), len(other))))
        return out


def given_phrases(terms: list[tuple[int, str, str | None]], aliases: list[tuple[str, str | None, bool]]) -> list[tuple[str, int, bool]]:
    """The labels, then the names of a table of aliases, those of entries before those of strangers."""
    by_label = {label: i for i, label, _ in terms}
    own = [(label, i, True) for i, label, _ in terms]
    named = [(phrase, by_label.get(label, 0), fuzzy) for phrase, label, fuzzy in aliases]
    return own + sorted(named, key=lambda x: x[1] == 0)


class FieldMatcher:
    """Maps the values of one field."""

    def __init__(self, field: str, terms: list[tuple[int, str, str | None]], aliases: list[tuple[str, str | None, bool]] | None = None):
        """`aliases` are (phrase, label or null for a stranger, whether typing errors are looked for), in place of the vocabulary's."""
        self.noise = frozenset(NOISE.get(field, "").split())
        self.known: dict[str, int] = {}
        loose: dict[str, int] = {}
        for phrase, term, fuzzy in phrases(field, terms) if aliases is None else given_phrases(terms, aliases):
            if folded := fold(phrase):
                self.known.setdefault(folded, term)
                if fuzzy:
                    loose.setdefault(folded, self.known[folded])
        self.machine = PhraseAutomaton(self.known.items())
        self.names = [(words, sum(map(len, words)), "".join(words), term) for name, term in loose.items() if (words := name.split())]
        self.by_word: dict[str, list[int]] = {}
        for k, (words, _, _, _) in enumerate(self.names):
            for w in set(words):
                self.by_word.setdefault(w, []).append(k)
        self.widest = max((size for _, size, _, _ in self.names), default=0)
        self.words = TypoIndex(list(self.by_word))
        self.joined = TypoIndex([name for _, _, name, _ in self.names])
        self.near: dict[str, list[tuple[str, float]]] = {}

    def similar_words(self, word: str) -> list[tuple[str, float]]:
        found = self.near.get(word)
        if found is None:
            found = [(self.words.words[k], s) for k, s in self.words.near(word)]
            if len(self.near) > MEMORY:
                self.near.clear()
            self.near[word] = found
        return found

    def term(self, value: str) -> int:
        text = fold(re.sub(r"\[[^\]]*\]|\(?\b\d+(?:\.\d+)? ?% ?\)?(?=\s*$)", " ", value)) or fold(value)
        if not text:
            return 0
        if (whole := self.known.get(text)) is not None:
            return whole
        words = text.split()
        mentions = self.machine.longest(text)
        core = [w for w in words if w not in self.noise]
        if mentions:
            covered = set()
            for a, b, _ in mentions:
                covered.update(text[a:b].split())
            if all(w in covered or w in self.noise for w in words):
                named = [m for m in mentions if not set(text[m[0] : m[1]].split()) <= self.noise] or mentions
                return max(named, key=lambda m: (m[1] - m[0], -m[0]))[2]
        for tokens in ([core, words] if core and core != words else [words]):
            best = self.nearest(tokens)
            if best is not None:
                return best
        named = [m for m in mentions if not set(text[m[0] : m[1]].split()) <= self.noise]
        found = [m for m in named if m[1] - m[0] >= LONG_MENTION and m[2] != 0] or named
        if found:
            return max(found, key=lambda m: (m[1] - m[0], -m[0]))[2]
        return self.nearest_window(words) or 0

    def nearest_window(self, words: list[str]) -> int | None:
        """The term of the name most similar to any run of as many words as a name has, None if none is similar enough."""
        near = [bool(self.similar_words(w)) for w in words]
        seen: set[tuple[str, ...]] = set()
        best, term = 0.0, None
        for width in sorted({len(name) for name, _, _, _ in self.names}):
            for k in range(len(words) - width + 1):
                window = tuple(words[k : k + width])
                if window in seen or not any(near[k : k + width]):
                    continue
                seen.add(window)
                score, t = self.most_similar(list(window))
                if t is not None and (score > best or (score == best and term == 0 and t != 0)):
                    best, term = score, t
        return term

    def nearest(self, words: list[str]) -> int | None:
        """The term of the most similar name, None if none is similar enough; words run together or split count as typed so."""
        best, term = self.most_similar(words)
        if best < 0.85:
            for k, likeness in self.joined.near("".join(words)):
                if likeness > best and len(self.names[k][2]) > 3:
                    best, term = likeness, self.names[k][3]
        return term

    def most_similar(self, words: list[str]) -> tuple[float, int | None]:
        """Similarity and term of the name with the most similar tokens, None if none is similar enough.

        Twice the letters that tokens share, over the letters of both; names too short for the value to reach
        LEAST_SIMILARITY are not looked at.
        """
        size = sum(map(len, words))
        if size * LEAST_SIMILARITY > (2 - LEAST_SIMILARITY) * self.widest:
            return LEAST_SIMILARITY, None
        likes = [dict(self.similar_words(w)) for w in words]
        candidates = {k for like in likes for w in like for k in self.by_word[w]}
        best, term = LEAST_SIMILARITY, None
        for k in sorted(candidates):
            name, name_size, _, t = self.names[k]
            if 2 * min(size, name_size) < best * (size + name_size):
                continue
            pairs = sorted(((s * (len(words[i]) + len(w)), i, j) for i, like in enumerate(likes) for j, w in enumerate(name) if (s := like.get(w))), reverse=True)
            left, right, total = set(), set(), 0.0
            for s, i, j in pairs:
                if i not in left and j not in right:
                    left.add(i)
                    right.add(j)
                    total += s
            score = total / (size + name_size)
            if score > best or (score == best and term == 0 and t != 0):
                best, term = score, t
        return best, term


#: Matchers of this Python process; Spark uses a worker process for many tasks. What they were asked is not kept.
_MATCHERS: dict[tuple, FieldMatcher] = {}


def matcher_of(field: str, terms: tuple, aliases: tuple | None = None) -> FieldMatcher:
    key = (field, terms, aliases)
    if key not in _MATCHERS:
        if len(_MATCHERS) >= 16:
            _MATCHERS.clear()
        _MATCHERS[key] = FieldMatcher(field, list(terms), None if aliases is None else list(aliases))
    return _MATCHERS[key]


def mapper(terms_by_field: dict[str, list[tuple[int, str, str | None]]], aliases_by_field: dict[str, list] | None = None):
    """The function for mapInPandas; values are remembered within a task."""
    terms = {f: tuple(t) for f, t in terms_by_field.items()}
    aliases = {f: None if aliases_by_field is None else tuple(aliases_by_field.get(f, ())) for f in terms}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from ferrolex.llm.canonical import matcher_of  # the module's own matchers, not a copy sent with this function

        own: dict[str, FieldMatcher] = {}
        memory: dict[tuple[str, str], int] = {}
        for batch in batches:
            out = []
            for field, entry in zip(batch["field_name"], batch["entry"]):
                found = memory.get((field, entry))
                if found is None:
                    if field not in own:
                        own[field] = matcher_of(field, terms.get(field, ()), aliases.get(field))
                        own[field].near.clear()
                    if len(memory) > MEMORY:
                        memory.clear()
                    found = own[field].term(entry)
                    if len(entry) < 500:
                        memory[field, entry] = found
                out.append(found)
            yield pd.DataFrame({"field_name": batch["field_name"], "row_key": batch["row_key"], "entry": batch["entry"], "term_id": out})

    return run


def map_to_terms(tables: list[tuple[DataFrame, str, tuple[str, ...]]], terms: DataFrame, skip_labels: bool = True, aliases: DataFrame | None = None) -> DataFrame:
    """field_name, row_key, entry, term_id for the non-null entries of (table, key column, fields).

    `aliases` (field_name, phrase, label, fuzzy) are the other names of entries, and with a null label those of strangers.
    With `skip_labels` entries written exactly as a label of their field are left out. Narrow: each table is read once
    and no row is shuffled, so frequent values cost nothing extra; the list is a checked dimension.
    """
    rows = small_rows(terms.select("term_id", "field_name", "label", "gloss").orderBy("term_id"), MAX_TERMS, "the canonical list")
    by_field: dict[str, list[tuple[int, str, str | None]]] = {}
    for r in rows:
        if r.field_name is not None and r.label is not None:
            by_field.setdefault(r.field_name, []).append((r.term_id, r.label, r.gloss))
    named: dict[str, list[tuple[str, str | None, bool]]] | None = None
    if aliases is not None:
        named = {}
        for r in small_rows(aliases.select("field_name", "phrase", "label", "fuzzy").orderBy("field_name", "phrase", "label"), MAX_ALIASES, "the table of aliases"):
            if r.field_name is not None and r.phrase:
                named.setdefault(r.field_name, []).append((r.phrase, r.label, bool(r.fuzzy)))
    parts = []
    for df, key, fields in tables:
        cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"`{f}`").cast("string").alias("entry")) for f in fields]))
        long = df.select(F.col(f"`{key}`").cast("bigint").alias("row_key"), cells.alias("c")).select("row_key", "c.*").where("entry is not null")
        if skip_labels:
            for f in fields:
                labels = [t[1] for t in by_field.get(f, [])]
                if labels:
                    long = long.where(~((F.col("field_name") == f) & F.col("entry").isin(labels)))
        long = spread(long)
        parts.append(long.mapInPandas(mapper({f: by_field.get(f, []) for f in fields}, named), "field_name string, row_key bigint, entry string, term_id bigint"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
