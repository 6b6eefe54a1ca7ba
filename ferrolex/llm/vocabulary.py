"""Names under which the entries of a canonical list occur, and names of related things that are not on the list.

Phrases are built by rule from short lists of words. A list entry is recognised by its label, by the words of its
gloss, and by the aliases below; a name that belongs to no entry of the list given is a stranger (term 0), so that a
related substance, process, measure or page is told apart from the nearest entry.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Elements by symbol with their names in English, German, French and Latin.
ELEMENTS = {
    "K": "potassium kalium", "Re": "rhenium", "Ta": "tantalum tantal tantale", "Mo": "molybdenum molybdan molybdene",
    "Nb": "niobium niob columbium", "V": "vanadium vanadin", "Ti": "titanium titan titane", "Zr": "zirconium zirkonium",
    "Hf": "hafnium", "Cr": "chromium chrom chrome", "Fe": "iron eisen fer ferrum", "Ni": "nickel", "Co": "cobalt kobalt",
    "Cu": "copper kupfer cuivre cuprum", "Al": "aluminium aluminum", "Si": "silicon silizium silicium", "Y": "yttrium",
    "Mn": "manganese mangan", "Ru": "ruthenium", "La": "lanthanum lanthan lanthane", "Ce": "cerium", "Rh": "rhodium",
    "Pd": "palladium", "Os": "osmium", "Ir": "iridium", "Pt": "platinum platin platine", "Ag": "silver silber argent",
    "Au": "gold", "Zn": "zinc zink", "Sn": "tin zinn etain", "Pb": "lead blei plomb", "Sc": "scandium", "Lu": "lutetium",
    "Mg": "magnesium", "Ca": "calcium", "Na": "sodium natrium", "Li": "lithium", "B": "boron bor", "Ge": "germanium",
    "Ga": "gallium", "Sb": "antimony", "Bi": "bismuth", "Cd": "cadmium", "Sr": "strontium", "Ba": "barium",
    "Nd": "neodymium", "Pr": "praseodymium", "Sm": "samarium", "Gd": "gadolinium", "Dy": "dysprosium", "Er": "erbium",
    "Yb": "ytterbium", "Th": "thorium", "U": "uranium", "W": "tungsten wolfram", "Tc": "technetium", "In": "indium",
    "Be": "beryllium", "Rb": "rubidium", "Cs": "caesium cesium", "Eu": "europium", "Tb": "terbium", "Ho": "holmium",
}
# Short names of oxides, and the compounds built for each element.
OXIDE_NAMES = {
    "La": "lanthana", "Y": "yttria", "Ce": "ceria", "Zr": "zirconia", "Hf": "hafnia", "Al": "alumina", "Mg": "magnesia",
    "Ti": "titania", "Si": "silica", "Th": "thoria", "Sc": "scandia", "Cr": "chromia", "Er": "erbia", "Ca": "calcia",
    "Sm": "samaria", "Nd": "neodymia", "Gd": "gadolinia", "Lu": "lutetia",
}
COMPOUNDS = {
    "O": ("oxide dioxide trioxide sesquioxide", ("{}O", "{}O2", "{}O3", "{}2O3", "{}2O", "{}2O5")),
    "C": ("carbide", ("{}C", "{}2C", "{}C2")),
    "N": ("nitride", ("{}N", "{}2N", "{}3N4")),
    "B": ("boride diboride", ("{}B", "{}B2")),
    "Si": ("silicide", ("{}Si", "{}Si2")),
    "H": ("hydride", ("{}H", "{}H2")),
    "S": ("sulfide sulphide", ("{}S", "{}S2")),
}
#: Symbols that are also words; only their longer names are used.
WORDS_AS_SYMBOLS = {"In", "Be", "No", "As", "At", "He", "I"}

# Process names as (words of the adjective, forms of the verb) and whole aliases, by label.
PROCESS_FORMS = {
    "cold_rolling": (("cold",), "rolling rolled roll"), "warm_rolling": (("warm",), "rolling rolled roll"),
    "hot_rolling": (("hot",), "rolling rolled roll"), "cross_rolling": (("cross", "crosswise"), "rolling rolled roll"),
    "rotary_swaging": (("rotary",), "swaging swaged swage"), "hot_forging": (("hot",), "forging forged forge"),
    "wire_drawing": (("wire",), "drawing drawn draw"), "hot_extrusion": (("hot",), "extrusion extruded extruding extrude"),
    "hydrostatic_extrusion": (("hydrostatic", "hydrostatically"), "extrusion extruded extruding"),
    "equal_channel_angular_pressing": (("equal channel angular", "equal channel", "eca"), "pressing pressed press"),
    "high_pressure_torsion": (("high pressure", "hp"), "torsion twisted"),
    "accumulative_roll_bonding": (("accumulative", "accumulated"), "roll bonding|roll bonded|roll bond"),
    "mechanical_alloying": (("mechanical", "mechanically", "mech"), "alloying alloyed alloy"),
    "explosive_compaction": (("explosive", "explosively"), "compaction compacted compacting"),
    "upsetting": (("upset", "upsetting"), "forming formed"), "flow_forming": (("flow",), "forming formed form"),
}
PROCESS_ALIASES = {
    "cold_rolling": "laminage a froid|kaltwalzen|kaltgewalzt", "warm_rolling": "laminage tiede|laminage a tiede|halbwarmwalzen",
    "hot_rolling": "laminage a chaud|warmwalzen|heisswalzen|heiszwalzen", "cross_rolling": "laminage croise|kreuzwalzen",
    "rotary_swaging": "rundkneten|rundhammern|martelage rotatif|martelage", "hot_forging": "forgeage a chaud|warmschmieden|heissschmieden",
    "wire_drawing": "drahtziehen|trefilage|drawing of wire|drawn into wire", "hot_extrusion": "extrusion a chaud|strangpressen|warmstrangpressen",
    "hydrostatic_extrusion": "extrusion hydrostatique|hydrostatisches strangpressen|he",
    "equal_channel_angular_pressing": "ecap|e c a p|ecae", "high_pressure_torsion": "hpt|h p t|torsion under high pressure|hochdrucktorsion",
    "accumulative_roll_bonding": "arb|a r b", "mechanical_alloying": "ma|m a|ball milling of powders|ball milling|ball milled|mechanisches legieren|broyage",
    "explosive_compaction": "explosivverdichten|compaction by shock|shock compaction", "upsetting": "upset|upsetting|stauchen|upset forged|refoulement",
    "flow_forming": "forming by flow|druckwalzen|fluotournage|streckdrucken",
}
OTHER_PROCESSES = (
    "tube hydroforming|hydroforming|polishing|electropolishing|tempering|electroplating|as received|shot peening|annealing|annealed|"
    "cold isostatic pressing|hot isostatic pressing|isostatic pressing|sintering only|sintering|sintered|cold spraying|thermal spraying|"
    "plasma spraying|chemical vapour deposition|chemical vapor deposition|physical vapour deposition|deep drawing|stress relief|"
    "laser powder bed fusion|selective laser melting|electron beam melting|spark plasma sintering|powder injection molding|casting|"
    "arc melting|quenching|machining|grinding|welding|bending|stamping|spinning|infiltration|recrystallized|stretching|shearing"
)

# Ways to word the definitions of the transition temperature, by label.
DEFINITION_ALIASES = {
    "temperature at half ductile fracture area": "50 % ductile fracture surface|t where half the fracture face is ductile|fracture face 50/50 ductile-brittle|half of the fracture area ductile|50 % shear fracture|fatt|fracture appearance transition temperature",
    "temperature at half upper shelf energy": "50% of upper-shelf energy|t at half the shelf energy|half upper shelf absorbed energy|energy midway between zero and upper shelf|half of the upper shelf energy",
    "lowest temperature with ductile specimens only": "lowest t at which every specimen is ductile|all specimens ductile, lowest test temperature|only ductile behaviour at and above this t|all specimens ductile at or above",
    "temperature at a set bend angle": "t for crack-free bending to the set angle|bend angle of 90 degrees without crack|90° bend without fracture|set bend angle reached|bending to the set angle",
    "temperature of first plastic yield": "first plastic yielding|first yielding before fracture|onset of plastic flow before fracture|t where plastic yield first appears",
    "temperature at a set fracture toughness": "set toughness level reached|k_ic reaches the set level|t at which fracture toughness hits the limit|toughness reaches the set level|fracture toughness threshold|toughness threshold",
    "temperature at five percent elongation": "elongation exceeds 5%|5 % total elongation|5 % elongation|t where tensile elongation hits five percent|five per cent elongation|five percent total elongation",
    "inflection of fitted sigmoid": "midpoint of sigmoid fit|inflection of sigmoidal curve|sigmoid fit, inflection point|inflection point of the fit|t_half from the fitted sigmoid|half point of the sigmoid",
    "temperature at half punch energy": "small punch energy at 50%|t at half of the small-punch energy|half of the punch energy|50 % small punch energy|punch energy midpoint|half of maximum sp energy|sp energy at half maximum",
    "temperature at zero reduction of area": "zero ra on cooling|t where ra becomes zero|reduction of area becomes zero|no reduction of area|zero reduction in area|nil reduction of area|reduction of area drops to zero|vanishing reduction of area",
}
OTHER_DEFINITIONS = (
    "taken from earlier work|see supplementary file|not defined by authors|unclear|ultrasonic attenuation peak|hardness drop criterion|"
    "creep rate minimum|acoustic emission onset|internal friction peak|estimated by eye|charpy|3pb|three point bending|tensile test|"
    "bend test|small punch test|nil ductility temperature|electrical resistivity change|fatigue limit|temperature of maximum hardness"
)

# Ways to name the types of figures, by label.
FIGURE_ALIASES = {
    "microstructure": "microstructural image|micro-structure|grain structure image|sem micrograph of grains|precipitates (tem image)|mikrostruktur|gefuge|micrograph|grain structure|porosity image",
    "DBTT_curve": "dbtt curve|dbtt plot|dbtt against dose|dbtt vs. grain size|transition temperature curve|curve of dbtt|dbtt against temperature",
    "hardness": "hardness plot|hardness profile|micro-hardness|vickers hardness|harte|durete|hardness curve|hv vs. temperature|hv plot|hardness vs. dose",
    "EBSD": "ebsd map|e.b.s.d.|electron backscatter diffraction|ipf map|pole figure|grain boundary map|orientation map",
    "fracture_surface": "fracture surface sem|fractograph|fractography|bruchflache|cleavage facets, fracture surface|fracture-surface image|fracture surface image",
    "map": "maps|element map (eds)|eds map|wds map|strain map|dose map|elemental map|composition map",
    "other": "others|misc / other|xrd pattern|stress-strain curve|schematic drawing|schematic|flow chart|table|diagram|autre|sonstige",
}
OTHER_FIGURES = (
    "see caption|video still|file missing|not classified|publisher logo|cover page|author portrait|equation block|unreadable page|"
    "blank page|advertisement|graphical abstract|table of contents|photograph|unknown"
)
PLACEHOLDERS = "unknown|various|none|not stated|not given|not reported|n/a|na|see table|see text|proprietary|binder phase|unclear|not specified|tbd|other elements|confidential"

# Words around a name that do not change what is named, by field (as folded words).
NOISE = {
    "dopant_or_alloying_element": "alloyed doped with added addition additions element particles particle nominal metal powder content the of dispersed dispersion i ii iii iv phase",
    "deformation_process": "via by in air multi pass passes several then after and the using",
    "dbtt_definition": "defined as dbtt authors see text methodology the",
    "figure_type": "type a d b c e f fig figure panel panels",
}


@lru_cache(maxsize=200_000)
def fold(text: str) -> str:
    """Lower case without accents, sub- and superscripts made plain, everything but letters and digits made a blank."""
    plain = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text).replace("ß", "ss"))
    plain = "".join(c for c in plain if not unicodedata.combining(c)).casefold()
    return re.sub(r"[^0-9a-z%°]+", " ", plain).strip()


def inflect(adjectives: tuple[str, ...], verbs: str) -> list[str]:
    """`cold` and `rolling rolled roll` in the orders and joins in which they are written."""
    forms = verbs.split("|") if "|" in verbs else verbs.split()
    return [x for a in adjectives for v in forms for x in (f"{a} {v}", f"{v} {a}", f"{a}{v}".replace(" ", ""))]


def element_phrases() -> list[tuple[str, str, bool]]:
    """(phrase, formula, whether typing errors are looked for) for elements and their oxides, carbides, nitrides and so on."""
    out = []
    for symbol, names in ELEMENTS.items():
        if symbol not in WORDS_AS_SYMBOLS:
            out.append((symbol, symbol, False))
        out += [(x, symbol, True) for n in names.split() for x in (n, f"{n} metal")]
        for other, (nouns, formulas) in COMPOUNDS.items():
            if symbol == other:
                continue
            for f in formulas:
                written = f.format(symbol)
                out.append((written, written, False))
                out.append((re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", written), written, False))
            usual = usual_formula(symbol, other)
            for noun in nouns.split():
                out += [(f"{n} {noun}", usual, True) for n in (*names.split(), symbol, usual)]
                out += [(f"{noun} of {n}", usual, False) for n in names.split()]
                out += [(f"{n}{noun[:-1]}", usual, False) for n in names.split()]
            if len(symbol) + len(other) > 2:
                out.append((f"{symbol} {other} {nouns.split()[0]}", usual, True))
        if symbol in OXIDE_NAMES:
            out.append((OXIDE_NAMES[symbol], usual_formula(symbol, "O"), True))
    return out


def usual_formula(symbol: str, other: str) -> str:
    """The common compound of an element."""
    if other == "O":
        if symbol in ("Ce", "Zr", "Hf", "Ti", "Si", "Th", "Ru", "Mo", "Sn", "U", "Ge"):
            return f"{symbol}O2"
        if symbol in ("Mg", "Ca", "Zn", "Ni", "Co", "Cu", "Mn", "Be", "Sr", "Ba", "Pb", "Pd", "Fe"):
            return f"{symbol}O"
        return f"{symbol}O3" if symbol in ("W", "Re") else f"{symbol}2O3"
    if other in ("B", "Si", "S"):
        return f"{symbol}{other}2"
    return f"{symbol}{other}"


def phrases(field: str, terms: list[tuple[int, str, str | None]]) -> list[tuple[str, int, bool]]:
    """(phrase, term id, whether typing errors are looked for) of one field; terms are (id, label, gloss).

    Entries of the list come first; strangers have term 0.
    """
    by_label = {label: i for i, label, _ in terms}
    chemical = field == "dopant_or_alloying_element"
    own: list[tuple[str, int, bool]] = [(x, i, not chemical) for i, label, _ in terms for x in (label, label.replace("_", ""))]
    strangers: list[tuple[str, int, bool]] = []
    if chemical:
        for i, _, gloss in terms:
            own += [(g.strip(), i, True) for g in re.split(r"[()]", gloss or "") if g.strip()]
        for phrase, formula, fuzzy in element_phrases():
            (own if formula in by_label else strangers).append((phrase, by_label.get(formula, 0), fuzzy))
    elif field == "deformation_process":
        for label, i in by_label.items():
            adjectives, verbs = PROCESS_FORMS.get(label, ((), ""))
            own += [(p, i, True) for p in inflect(adjectives, verbs)]
            own += [(p, i, True) for p in PROCESS_ALIASES.get(label, "").split("|") if p]
        strangers += [(p, 0, True) for p in OTHER_PROCESSES.split("|")]
    elif field in ("dbtt_definition", "figure_type"):
        aliases, others = (DEFINITION_ALIASES, OTHER_DEFINITIONS) if field == "dbtt_definition" else (FIGURE_ALIASES, OTHER_FIGURES)
        for i, label, gloss in terms:
            own += [(p, i, True) for p in aliases.get(label, "").split("|") if p]
            if field == "dbtt_definition" and gloss:
                own.append((gloss, i, True))
        strangers += [(p, 0, True) for p in others.split("|")]
    strangers += [(p, 0, True) for p in PLACEHOLDERS.split("|")]
    return own + strangers
