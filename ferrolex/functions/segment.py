"""Dictionary-guided segmentation of fields that hold several values in one string.

A multi-pattern automaton finds known whole values (substances, process steps, numbers, units, rates) in the
text with its digits folded; dynamic programming then picks the cover with the most known text and the fewest
pieces. A delimiter inside a known value is thereby protected, as is anything inside quotes or brackets.
"""

from __future__ import annotations

import re
from functools import lru_cache

from ferrolex.functions.automaton import PhraseAutomaton

# Delimiters. Strong ones always separate (outside quotes and brackets), plain ones separate
# unless a known value holds them, blanks only between values that are all known.
STRONG = re.compile(r"\r\n|[;|\t\n\r]|->|=>|→|(?<=\s)>(?=\s)|(?<=\s)&(?=\s)|(?<=\s)(?:then|und|and|et)(?=\s)")
PLAIN = re.compile(r"[,/+·•]")
BLANKS = re.compile(r"[  ]+")
NUMBER_LIKE = re.compile(r"\d+")
BRACKETS = {"(": ")", "[": "]", "{": "}"}
BRACKET = re.compile(r"[()\[\]{}]")
QUOTES = {'"': '"', "“": "”", "«": "»", "„": "“", "'": "'", "‘": "’"}

# Symbols and names of elements that are recorded as impurities.
ELEMENTS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Y Zr Nb Mo Tc Ru Rh "
    "Pd Ag Cd In Sn Sb Te I Cs Ba La Ce Pr Nd Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Th U"
).split()
NAMES = (
    "hydrogen carbon nitrogen oxygen sodium magnesium aluminium aluminum silicon phosphorus sulfur sulphur potassium "
    "calcium titanium vanadium chromium manganese iron cobalt nickel copper zinc zirconium niobium molybdenum tin "
    "tantalum rhenium lead interstitials gases metals alkali"
).split()
QUALIFIERS = "trace total sum rest ca ca. approx. approx about max max. min. main each all".split()

# Parts from which units and rates are built by rule.
NUMERATORS = "% ‰ K °C C mg g kg µg μg ug ng mm cm m µm um nm s min h MPa GPa J kJ N kN Pa at atoms ml l A V W".split()
DENOMINATORS = "pass passes kg g mg K °C min h s mol m mm cm atom m2 m3 cm3 l L hour step cycle dpa year".split()
PLAIN_UNITS = (
    "ppm ppb PPM PPB ppmw ppbw wppm wppb appm appb at% wt% AT% WT% at.% wt.% at.-% wt.-% Gew.-% Ma.-% Atom-% Vol.-% vol% "
    "atom% mass% mass-% mass-‰ wt‰ hours hour pct percent fraction frac. weight mass atomic atom at wt vol volume % ‰ K °C C "
    "h min s mm µm um MPa GPa passes pass _passes _hour at. wt. at.ppm at.-ppm wt.-ppm massique atomique reduction HV"
).split()
STEPS = (
    "sintered annealed recrystallized degassed polished straightened as_rolled as_sintered stress_relieved hot_rolled warm_rolled "
    "cold_rolled rotary_swaged hot_forged ball_milled cold_pressed vacuum_sintered spark_plasma_sintered powder_injection_molded"
).split()
PHRASES = ("furnace cooled", "by weight", "by atoms", "per pass", "per kg", "(w/w)", "(wt)", "(at.)", "so-called", "annealed at")

#: What a single value may consist of: kinds in order. L label, N number, U unit, Q qualifier, S step, B label or unit,
#: which is a unit only right behind a number.
ONE_VALUE = re.compile(r"^(?:Q*[LB]Q*|Q*[LB]?Q*NB?U*Q*|Q+|U+|S(?:NB?U*)?|NB?U*S)$")
#: Kinds of which one value holds one at most.
AT_MOST_ONE = "LNS"


@lru_cache(maxsize=1)
def known_values() -> PhraseAutomaton:
    """The automaton over the dictionary; numbers appear with each run of digits folded to #."""
    signed = ["#", "#.#", "#,#"]
    numbers = signed + [f"{x}e{sign}#" for x in signed for sign in ("", "-", "+", "−")]
    ranges = [f"{a}{dash}{b}" for a in numbers for dash in ("-", "–", "−", "±") for b in numbers]
    phrases = [(x, "N") for x in numbers + ranges]
    phrases += [(x, "B" if x in PLAIN_UNITS else "L") for x in ELEMENTS]
    phrases += [(x, "L") for name in NAMES for x in (name, name.capitalize())]
    phrases += [(f"{a}/{b}", "U") for a in NUMERATORS for b in DENOMINATORS]
    phrases += [("#/s", "N"), ("#/min", "N"), ("#/h", "N")]
    phrases += [(x, "U") for x in PLAIN_UNITS]
    phrases += [(x, "Q") for x in QUALIFIERS] + [(x, "S") for x in STEPS]
    phrases += [(x, "S" if x in ("furnace cooled", "annealed at") else "U") for x in PHRASES]
    return PhraseAutomaton(phrases)


def guarded(text: str) -> bytearray:
    """1 at each character inside quotes or brackets, the marks included. Marks without a partner guard nothing."""
    mask = bytearray(len(text))
    at, size = 0, len(text)
    partners = bracket_partners(text)
    while at < size:
        c = text[at]
        end = -1
        if c in QUOTES and (c not in "'‘" or opens_item(text, at)):
            end = closing_quote(text, at, QUOTES[c])
        elif c in BRACKETS:
            end = partners.get(at, -1)
        if end > at:
            mask[at : end + 1] = b"\1" * (end + 1 - at)
            at = end
        at += 1
    return mask


def opens_item(text: str, at: int) -> bool:
    before = text[:at].rstrip()[-1:]
    return not before or not (before.isalnum() or before in ".)%")


def closing_quote(text: str, at: int, mark: str) -> int:
    end = at + 1
    while (end := text.find(mark, end)) >= 0:
        if text[end + 1 : end + 2] == mark:
            end += 2
            continue
        if mark == "'" and text[end + 1 : end + 2].isalnum():
            end += 1
            continue
        return end
    return -1


def bracket_partners(text: str) -> dict[int, int]:
    """Opening to closing position of each pair of brackets; a bracket within an open one of another kind does not close it."""
    stack: list[tuple[int, str]] = []
    partners = {}
    for m in BRACKET.finditer(text):
        c = m.group()
        if c in BRACKETS:
            stack.append((m.start(), BRACKETS[c]))
        elif stack and c == stack[-1][1]:
            partners[stack.pop()[0]] = m.start()
    return partners


def known_value(piece: str) -> tuple[bool, bool]:
    """As `judged`; short pieces are remembered."""
    return _remembered(piece) if len(piece) < 100 else judged(piece)


def judged(piece: str) -> tuple[bool, bool]:
    """Whether the piece as a whole is one known value, and whether no longer piece that ends with it can be one.

    The latter holds where text that no phrase reaches from the left is unknown, or holds two parts of a kind of which a
    value has one.
    """
    text = piece.strip()
    if not text:
        return False, False
    folded = NUMBER_LIKE.sub("#", re.sub(r"\((?!w/w\)|wt\)|at\.\))[^()]*\)", " ", text))
    automaton = known_values()
    reach = automaton.longest_phrase
    kinds, inner, at = [], [], 0
    known, hopeless = True, False
    for start, end, kind in automaton.longest(folded):
        if folded[at:start].strip(" <>≤≥~≈=:_-\u00a0"):
            known = False
            hopeless = hopeless or bool(folded[max(at, reach) : start].strip(" <>≤≥~≈=:_-\u00a0"))
        kinds.append(kind)
        if start >= reach:
            inner.append(kind)
        at = end
    if folded[at:].strip(" =:.\u00a0"):
        known = False
        hopeless = hopeless or bool(folded[max(at, reach) :].strip(" =:.\u00a0"))
    hopeless = hopeless or any(inner.count(k) > 1 for k in AT_MOST_ONE)
    return known and bool(kinds) and ONE_VALUE.match("".join(kinds)) is not None, hopeless


_remembered = lru_cache(maxsize=50_000)(judged)


def one_known_value(piece: str) -> bool:
    return known_value(piece)[0]


def best_cover(text: str, start: int, end: int, cuts: list[tuple[int, int, bool]]) -> list[tuple[int, int]]:
    """Pieces of text[start:end] by dynamic programming over the cuts (from, to, is a blank).

    Known text counts its length, each piece costs a half; a piece that runs over a plain delimiter or ends at a
    blank without being known is ruled out as long as any other cover exists.
    """
    stops = [(start, start, False), *cuts, (end, end, False)]
    best: list[tuple[float, int]] = [(0.0, -1)]
    for j in range(1, len(stops)):
        choice = (-1e18, j - 1)
        over_plain = False
        for i in range(j - 1, -1, -1):
            piece = text[stops[i][1] : stops[j][0]]
            if i < j - 1:
                over_plain = over_plain or not stops[i + 1][2]
            known, hopeless = known_value(piece)
            score = (len(piece.strip()) if known else 0) - 0.5
            if not known and over_plain:
                score -= 1e6
            if not known and (stops[j][2] or stops[i][2]):
                score -= 1e6
            if best[i][0] + score > choice[0]:
                choice = (best[i][0] + score, i)
            if hopeless and i < j - 1:
                break
        best.append(choice)
    pieces, j = [], len(stops) - 1
    while j > 0:
        i = best[j][1]
        pieces.append((stops[i][1], stops[j][0]))
        j = i
    return pieces[::-1]


def clean(piece: str) -> str:
    """The value as written: trimmed, without the quotation marks around it, doubled marks inside made single."""
    text = piece.strip()
    mark = QUOTES.get(text[:1])
    if mark and len(text) >= 2 and closing_quote(text, 0, mark) == len(text) - 1:
        return text[1:-1].replace(mark * 2, mark).strip()
    return text


def split_packed(text: str | None) -> list[tuple[int, str]]:
    """(position from 1, value) of each value if the text holds two or more, else nothing.

    An empty slot takes a position but gives no value. Null and blank texts give nothing.
    """
    if not text or not text.strip():
        return []
    mask = guarded(text)
    strong = [(m.start(), m.end()) for m in STRONG.finditer(text) if not mask[m.start()]]
    merged: list[tuple[int, int]] = []
    for a, b in strong:  # a line break beside another delimiter is part of it
        beside = merged and not text[merged[-1][1] : a].strip(" ")
        if beside and (text[a] in "\r\n") != (text[merged[-1][0]] in "\r\n"):
            merged[-1] = (merged[-1][0], b)
        else:
            merged.append((a, b))
    pieces: list[tuple[int, int]] = []
    at = 0
    for a, b in [*merged, (len(text), len(text))]:
        pieces += chunk_pieces(text, at, a, mask)
        at = b
    values = [clean(text[a:b]) for a, b in pieces]
    found = [(k, v) for k, v in enumerate(values, 1) if v]
    return found if len(found) > 1 else []


def chunk_pieces(text: str, start: int, end: int, mask: bytearray) -> list[tuple[int, int]]:
    """Pieces of a stretch without strong delimiters."""
    plain = [(m.start() + start, m.end() + start, False) for m in PLAIN.finditer(text[start:end]) if not mask[m.start() + start]]
    pieces = best_cover(text, start, end, plain) if plain else [(start, end)]
    out: list[tuple[int, int]] = []
    for a, b in pieces:
        inner = text[a:b]
        lead = len(inner) - len(inner.lstrip())
        tail = len(inner.rstrip())
        blanks = [
            (m.start() + a, m.end() + a, True)
            for m in BLANKS.finditer(inner)
            if lead <= m.start() and m.end() <= tail and not mask[m.start() + a]
        ]
        if not blanks or one_known_value(inner):
            out.append((a, b))
            continue
        edges = [a, *(y for x in blanks for y in x[:2]), b]
        words = [(edges[k], edges[k + 1]) for k in range(0, len(edges), 2)]
        if not all(one_known_value(text[x:y]) for x, y in words):
            out.append((a, b))
        else:
            out += best_cover(text, a, b, blanks)
    return out
