"""Quantities recorded in different units, brought to ppm of their basis (problem 3).

The unit of a value is what its unit column states, else what the material name or the notes state about it. In an
impurity entry each number has the unit behind it, else the first unit in the entry, else that of the notes, else ppm
by mass. Spellings are reduced to one key and read as a unit; units are joined with the composed conversions of the
unit graph, whose edges are the factors of the table of units and the known relations between scales. Cycles of edges
are checked, so a table that contradicts the scales raises.

A note speaks about a dopant if its subject is the dopant as written, or, where the dopant is no formula, any formula
that is not the second dopant's nor the base's, or the word addition.

Null values give no rows. A value whose unit is unknown has a null unit and null ppm. A blank text states nothing.
Repeated rows are converted each under its own key; ties cannot arise, the first statement about a value counts.
Further columns of the input are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolex.functions.elements import ATOMIC_WEIGHT
from ferrolex.functions.unit_graph import Affine, UnitGraph
from ferrolex.sources.tables import small_rows

FIELDS = ("dopant_concentration", "second_dopant_concentration", "impurity_concentration")
#: More rows than this in the table of units are refused.
MAX_UNITS = 500

# Words for the bases and scales, from which spellings are built by rule (as reduced by `unit_key`).
MASS = "wt weight mass gew ma masse massen gewichts".split()
ATOM = "at atom atomic".split()
VOLUME = "vol volume".split()
PERCENT = "% pct percent".split()
PER_MILLE = "‰ permille permil".split()
FRACTION = "fraction frac".split()
RATIOS = {
    "wt_ppm": "mg/kg ug/g mgperkg ugperg".split(),
    "wt_ppb": "ug/kg ng/g ugperkg ngperg".split(),
    "g_per_kg": "g/kg mg/g gperkg mgperg".split(),
    "mass_fraction": "g/g kg/kg gperg kgperkg".split(),
    "atom_fraction": "atoms/atom at/at mol/mol".split(),
}

#: One unit in running text. Percent, per mille and fraction need a word for their basis; ppm and ppb do not.
BASIS = r"(?:wt|weight|mass|gew|ma|atomic|atom|at|volume|vol)"
SCALE = r"(?:%|‰|pct|percent|per ?mille?)"
AFTER = r"(?: ?\((?:w/w|wt\.?|mass|weight|at\.?|a/a|v/v|vol\.?|by weight|by atoms)\)| by (?:weight|mass|atoms?|volume)| (?:massique|atomique|volumique))"
UNIT = (
    rf"(?i:(?<![a-z])(?:{BASIS}[. \-_]{{0,3}}{SCALE}|{SCALE}{AFTER}|{BASIS}[. \-_]{{0,3}}frac(?:tion|\.)?"
    rf"|(?:{BASIS}[. \-_]{{0,3}}|[wa])?pp[mb]{AFTER}?|(?:mg|[uµμ]g|ng|kg|g|atoms|at|mol)(?:/| per )(?:kg|g|atom|at|mol)))(?-i:[wa](?![A-Za-z]))?"
)
NUMBER = r"[0-9]+(?:[.,][0-9]+)?(?:[eE][-+]?[0-9]+)?"


# Known relations between the scales of one basis: a value in the first unit times the factor is in the second.
SCALES = (
    ("wt_pct", "mass_fraction", 0.01), ("wt_ppb", "wt_ppm", 1e-3), ("g_per_kg", "wt_pct", 0.1), ("mass_fraction", "g_per_kg", 1e3), ("wt_pct", "wt_ppm", 1e4),
    ("at_pct", "atom_fraction", 0.01), ("at_ppb", "at_ppm", 1e-3), ("at_per_mille", "at_pct", 0.1), ("at_pct", "at_ppm", 1e4),
    ("vol_pct", "vol_fraction", 0.01), ("vol_ppb", "vol_ppm", 1e-3), ("vol_per_mille", "vol_pct", 0.1), ("vol_pct", "vol_ppm", 1e4),
)
#: A subject that is a chemical formula: symbols of elements with whole numbers.
FORMULA = rf"(?:(?:{'|'.join(sorted(ATOMIC_WEIGHT, key=len, reverse=True))})[0-9]*)+"
#: Words of a note between its subject and the unit.
GAP = r"(?::|,)?(?: [a-z]+:?){0,6} "
BASE = "W"


def unit_key(text: Column) -> Column:
    """A spelling reduced to its key: lower case, micro signs made u, blanks, dots, hyphens and underscores dropped."""
    return F.regexp_replace(F.translate(F.lower(text), "µμ", "uu"), r"[\s.\-_]", "")


def spellings() -> list[tuple[str, str]]:
    """(key, unit label) of the spellings known, built from the words by rule."""
    out = []
    for words, percent, ppm, ppb, fraction, per_mille in (
        (MASS, "wt_pct", "wt_ppm", "wt_ppb", "mass_fraction", "g_per_kg"),
        (ATOM, "at_pct", "at_ppm", "at_ppb", "atom_fraction", "at_per_mille"),
        (VOLUME, "vol_pct", "vol_ppm", "vol_ppb", "vol_fraction", "vol_per_mille"),
    ):
        for w in words:
            for scale_words, unit in ((PERCENT, percent), (PER_MILLE, per_mille)):
                out += [(f"{w}{s}", unit) for s in scale_words]
                out += [(f"{s}{x}", unit) for s in scale_words for x in (f"({w})", f"by{w}", f"by{w}s")]
            out += [(f"{w}{s}", fraction) for s in FRACTION]
            for s, unit in (("ppm", ppm), ("ppb", ppb)):
                out += [(x, unit) for x in (f"{w}{s}", f"{s}({w})", f"{s}by{w}", f"{s}by{w}s")]
    for mark, percent, ppm, ppb, per_mille in (
        ("w", "wt_pct", "wt_ppm", "wt_ppb", "g_per_kg"),
        ("a", "at_pct", "at_ppm", "at_ppb", "at_per_mille"),
        ("v", "vol_pct", "vol_ppm", "vol_ppb", "vol_per_mille"),
    ):
        out += [(f"%({mark}/{mark})", percent), (f"‰({mark}/{mark})", per_mille), (f"ppm({mark}/{mark})", ppm)]
        out += [(f"{mark}ppm", ppm), (f"ppm{mark}", ppm), (f"{mark}ppb", ppb), (f"ppb{mark}", ppb)]
    out += [("%massique", "wt_pct"), ("‰massique", "g_per_kg"), ("%atomique", "at_pct"), ("%volumique", "vol_pct")]
    out += [("ppm", "wt_ppm"), ("ppb", "wt_ppb")]
    out += [(key, unit) for unit, keys in RATIOS.items() for key in keys]
    return out


def conversions(units: DataFrame, target: str = "ppm") -> DataFrame:
    """The composed conversions: unit, target, unit_id, basis, factor, offset; one row per unit of the table.

    A unit that no path of the graph leads from to its target keeps its row with null factor.
    """
    named = _named(units)
    graph = UnitGraph()
    for r in named.values():
        if r.per_million is not None and r.per_million != 0 and r.basis is not None:
            graph.add(r.unit_label, f"ppm of {r.basis}", Affine(float(r.per_million)))
            graph.add(f"fraction of {r.basis}", f"ppm of {r.basis}", Affine(1e6))
    for a, b, factor in SCALES:
        if a in graph.edges and b in graph.edges:
            graph.add(a, b, Affine(factor))
    paths = {b: graph.paths(f"{target} of {b}") for b in {r.basis for r in named.values() if r.basis is not None}}
    out = []
    for label, r in named.items():
        step = paths.get(r.basis, {}).get(label)
        out.append((label, target, r.unit_id, r.basis, step and step.factor, step and step.offset))
    return units.sparkSession.createDataFrame(out, "unit string, target string, unit_id int, basis string, factor double, offset double")


def _named(units: DataFrame) -> dict:
    rows = small_rows(units.select("unit_id", "unit_label", "basis", "per_million"), MAX_UNITS, "the table of units")
    return {r.unit_label: r for r in rows if r.unit_label is not None}


def known_spellings(units: DataFrame) -> Column:
    """Map literal of key to unit label; keys of units that are not in the table are left out."""
    named = _named(units)
    chosen: dict[str, str] = {}
    for key, label in spellings() + [("".join(c for c in label.lower() if c not in " .-_"), label) for label in named]:
        if label in named:
            chosen.setdefault(key, label)
    return F.from_json(F.lit(json.dumps(chosen)), "map<string,string>")


def found_in(text: Column, pattern: str = UNIT) -> Column:
    """Key of the first unit in a text, null where there is none."""
    return F.nullif(unit_key(F.regexp_extract(text, pattern, 0)), F.lit(""))


#: A note without any of these states no unit; tested before the longer pattern.
MAY_STATE = r"(?i)%|‰|pct|percent|permille|per mille|pp[mb]|frac|/| per "


def claims() -> Column:
    """array<struct<who, unit>>: what the notes state about formulas, in order."""
    about = F.lit(rf"\b({FORMULA}|addition)\b{GAP}({UNIT})")
    found = F.arrays_zip(F.regexp_extract_all("notes", about, F.lit(1)).alias("who"), F.regexp_extract_all("notes", about, F.lit(2)).alias("unit"))
    empty = F.array().cast("array<struct<who:string,unit:string>>")
    return F.when(F.col("notes").rlike(MAY_STATE), F.filter(found, lambda c: c["who"] != BASE)).otherwise(empty)


def stated_units(claimed_units: Column) -> dict[str, Column]:
    """The unit key of each field, from the columns and texts of a record and what its notes claim."""
    first = F.trim(F.coalesce("dopant_or_alloying_element", F.lit("")))
    second = F.trim(F.coalesce("second_dopant_element", F.lit("")))

    def claimed(keep) -> Column:
        return F.nullif(unit_key(F.try_element_at(F.filter(claimed_units, keep), F.lit(1))["unit"]), F.lit(""))

    of_impurities = F.when(F.col("notes").rlike(r"(?i)impurit"), F.regexp_extract("notes", rf"(?i:impurit(?:y|ies)[^.\[\]]*?[ :])({UNIT})", 1))
    dopant = claimed(lambda c: (c["who"] == first) | (c["who"] == "addition") | (~first.rlike(f"^{FORMULA}$") & (c["who"] != second)))
    return {
        "dopant_concentration": F.coalesce(found_in(F.col("dopant_concentration_unit")), found_in(F.col("material_name")), dopant),
        "second_dopant_concentration": F.coalesce(found_in(F.col("second_dopant_concentration_unit")), claimed(lambda c: (c["who"] == second) & (second != ""))),
        "impurity_concentration": F.coalesce(found_in(F.col("impurity_concentration")), F.nullif(unit_key(of_impurities), F.lit("")), F.lit("ppm")),
    }


#: The columns that state something about a value.
STATING = (
    *FIELDS, "dopant_concentration_unit", "second_dopant_concentration_unit", "material_name", "notes", "dopant_or_alloying_element", "second_dopant_element",
)


def stated_values(records: DataFrame, units: DataFrame, key: str = "rec_key") -> DataFrame:
    """key, field_name, raw and values: array<struct<pos, number, unit_key, unit>> of each non-null entry, within the row.

    pos is from 1; an entry without a number has one value whose number is null.
    """
    keys = stated_units(F.col("_n.claims"))
    known = known_spellings(units)
    noted = records.select(key, *STATING, F.explode(F.array(F.struct(claims().alias("claims")))).alias("_n"))  # once per record
    stated = lambda f: F.when(F.col(f).isNotNull(), keys[f]).alias("stated")
    spread = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("raw"), stated(f)) for f in FIELDS]))
    long = noted.select(F.col(key), spread.alias("v")).select(key, "v.*").where(F.col("raw").isNotNull())
    decimal = F.regexp_replace("raw", r"([0-9]),([0-9])", "$1.$2")
    one = rf"(?<![A-Za-z0-9.])({NUMBER})(?:\s*[(\[]?\s*({UNIT}))?"
    found = F.arrays_zip(F.regexp_extract_all(decimal, F.lit(one), F.lit(1)).alias("n"), F.regexp_extract_all(decimal, F.lit(one), F.lit(2)).alias("u"))
    in_text = F.transform(found, lambda x: F.struct(x["n"].try_cast("double").alias("number"), F.coalesce(F.nullif(unit_key(x["u"]), F.lit("")), F.col("stated")).alias("unit_key")))
    alone = F.array(F.struct(F.when(F.col("field_name") != "impurity_concentration", F.col("raw").try_cast("double")).alias("number"), F.col("stated").alias("unit_key")))
    pairs = F.when((F.col("field_name") == "impurity_concentration") & (F.size(in_text) > 0), in_text).otherwise(alone)
    values = F.transform(
        pairs, lambda x, i: F.struct((i + 1).alias("pos"), x["number"].alias("number"), x["unit_key"].alias("unit_key"), F.try_element_at(known, x["unit_key"]).alias("unit"))
    )
    return long.select(key, "field_name", "raw", F.explode(F.array(values)).alias("values"))


def to_ppm(records: DataFrame, units: DataFrame, key: str = "rec_key") -> DataFrame:
    """Every value with its unit and its size in ppm of its basis: one row per value.

    Columns: key, field_name, value_pos, raw, unit_key, unit_id, basis, factor, offset, ppm. One narrow pass and one
    broadcast join with the conversions, one row per unit.
    """
    rows = stated_values(records, units, key).select(key, "field_name", "raw", F.explode("values").alias("v"))
    rows = rows.select(key, "field_name", F.col("v.pos").alias("value_pos"), "raw", F.col("v.number").alias("number"), F.col("v.unit_key").alias("unit_key"), F.col("v.unit").alias("unit"))
    joined = rows.join(F.broadcast(conversions(units)), "unit", "left")
    return joined.select(
        key, "field_name", "value_pos", "raw", "unit_key", "unit_id", "basis", "factor", "offset", (F.col("number") * F.col("factor") + F.col("offset")).alias("ppm"),
    )


def converted(records: DataFrame, units: DataFrame, key: str = "rec_key") -> DataFrame:
    """key, field_name, unit_id: each unit of an entry whose composed conversion to ppm changes the value.

    The units of an entry are made distinct within the row, before the join; nothing is shuffled.
    """
    entries = stated_values(records, units, key)
    each = entries.select(key, "field_name", F.explode(F.array_distinct(F.transform("values", lambda v: v["unit"]))).alias("unit"))
    joined = each.join(F.broadcast(conversions(units)), "unit")
    return joined.where((F.abs(F.col("factor") - 1) > 1e-12) | (F.col("offset") != 0)).select(key, "field_name", "unit_id")
