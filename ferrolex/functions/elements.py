"""Element data as small dimensions and as map literals for use inside expressions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolex.sources.tables import small_rows

# Standard atomic weights (public, conventional values), atomic numbers 1 to 94 in order.
ATOMIC_WEIGHT = {
    "H": 1.008, "He": 4.002602, "Li": 6.94, "Be": 9.0121831, "B": 10.81, "C": 12.011, "N": 14.007, "O": 15.999, "F": 18.998403163,
    "Ne": 20.1797, "Na": 22.98976928, "Mg": 24.305, "Al": 26.9815385, "Si": 28.085, "P": 30.973761998, "S": 32.06, "Cl": 35.45,
    "Ar": 39.948, "K": 39.0983, "Ca": 40.078, "Sc": 44.955908, "Ti": 47.867, "V": 50.9415, "Cr": 51.9961, "Mn": 54.938044,
    "Fe": 55.845, "Co": 58.933194, "Ni": 58.6934, "Cu": 63.546, "Zn": 65.38, "Ga": 69.723, "Ge": 72.63, "As": 74.921595,
    "Se": 78.971, "Br": 79.904, "Kr": 83.798, "Rb": 85.4678, "Sr": 87.62, "Y": 88.90584, "Zr": 91.224, "Nb": 92.90637,
    "Mo": 95.95, "Tc": 97.90721, "Ru": 101.07, "Rh": 102.9055, "Pd": 106.42, "Ag": 107.8682, "Cd": 112.414, "In": 114.818,
    "Sn": 118.71, "Sb": 121.76, "Te": 127.6, "I": 126.90447, "Xe": 131.293, "Cs": 132.90545196, "Ba": 137.327, "La": 138.90547,
    "Ce": 140.116, "Pr": 140.90766, "Nd": 144.242, "Pm": 144.91276, "Sm": 150.36, "Eu": 151.964, "Gd": 157.25, "Tb": 158.92535,
    "Dy": 162.5, "Ho": 164.93033, "Er": 167.259, "Tm": 168.93422, "Yb": 173.045, "Lu": 174.9668, "Hf": 178.49, "Ta": 180.94788,
    "W": 183.84, "Re": 186.207, "Os": 190.23, "Ir": 192.217, "Pt": 195.084, "Au": 196.966569, "Hg": 200.592, "Tl": 204.38,
    "Pb": 207.2, "Bi": 208.9804, "Po": 209.0, "At": 210.0, "Rn": 222.0, "Fr": 223.0, "Ra": 226.0, "Ac": 227.0, "Th": 232.0377,
    "Pa": 231.03588, "U": 238.02891, "Np": 237.0, "Pu": 244.0,
}
# Valence electron counts used for mixtures.
VEC = {
    "W": 6, "Re": 7, "Mo": 6, "Ta": 5, "Nb": 5, "Hf": 4, "Ti": 4, "Zr": 4, "V": 5, "Cr": 6, "K": 1, "La": 3, "Y": 3, "Fe": 8, "Ni": 10,
    "Co": 9, "Cu": 11, "C": 4, "O": 6, "N": 5, "Si": 4, "Al": 3,
}
# Pair mixing enthalpies in kJ/mol; the pairs are unordered.
PAIR_ENTHALPY = {
    "W-Ti": -6, "W-V": -1, "W-Cr": 1, "W-Mn": 6, "W-Fe": 0, "W-Co": -1, "W-Ni": -3, "W-Cu": 22, "W-Zr": -9, "W-Nb": -8, "W-Mo": 0,
    "W-Ta": -7, "W-Re": -4, "Re-Ta": -24, "Fe-Ni": -2, "Fe-Cu": 13, "Fe-Co": -1, "Ni-Cu": 4, "Co-Ni": 0, "Co-Cu": 6,
}
# Unstable stacking fault energies on {110}<111> in mJ/m2.
USFE = {"Li": 71, "Na": 48, "K": 26, "Ti": 190, "V": 713, "Cr": 1549, "Fe": 980, "Nb": 674, "Mo": 1425, "Ta": 725, "W": 1786}

PROPERTY_COLUMNS = ("metallic_radius", "melting_point", "density", "en_pauling", "lattice_constant")
# Fixed values (public): metallic radius pm, melting point K, density g/cm3, Pauling electronegativity, lattice constant in
# angstrom, structure.
_PROPERTIES = {
    "W": (141, 3695, 19.3, 2.36, 3.16, "BCC"), "Re": (137, 3459, 20.8, 1.9, 2.76, "HEX"), "Mo": (140, 2896, 10.2, 2.16, 3.15, "BCC"),
    "Ta": (147, 3290, 16.4, 1.5, 3.31, "BCC"), "Nb": (147, 2750, 8.57, 1.6, 3.3, "BCC"), "Hf": (160, 2506, 13.3, 1.3, 3.2, "HEX"),
    "Ti": (147, 1941, 4.506, 1.54, 2.95, "HEX"), "Zr": (160, 2128, 6.52, 1.33, 3.23, "HEX"), "V": (135, 2183, 6.11, 1.63, 3.02, "BCC"),
    "Cr": (129, 2180, 7.15, 1.66, 2.88, "BCC"), "K": (238, 336.7, 0.862, 0.82, 5.23, "BCC"), "La": (188, 1193, 6.15, 1.1, 3.75, "HEX"),
    "Y": (181, 1795, 4.47, 1.22, 3.65, "HEX"), "Fe": (127, 1811, 7.87, 1.83, 2.87, "BCC"), "Ni": (125, 1728, 8.9, 1.91, 3.52, "FCC"),
    "Co": (125, 1768, 8.86, 1.88, 2.51, "HEX"), "Cu": (128, 1357.8, 8.96, 1.9, 3.61, "FCC"), "Al": (143, 933.5, 2.7, 1.61, 4.05, "FCC"),
    "Si": (None, 1687, 2.33, 1.9, 5.43, "DIA"), "Mn": (137, 1519, 7.3, 1.55, 8.89, "CUB"), "Ru": (134, 2607, 12.1, 2.2, 2.7, "HEX"),
}
FURTHER_COLUMNS = ("atomic_radius", "boiling_point", "fusion_heat", "thermal_conductivity", "en_allen", "electron_affinity")
# Fixed values (public): atomic radius pm, boiling point K, heat of fusion kJ/mol, thermal conductivity W/(m K), Allen
# electronegativity (Pauling units), electron affinity eV. What is missing here comes with a dimension table of the caller.
_FURTHER = {
    "W": (135, 5828, 35.2, 173, 1.47, 0.816), "Re": (135, 5869, 33.2, 48, 1.6, 0.06), "Mo": (145, 4912, 36, 138, 1.47, 0.747), "Ta": (145, 5731, 36, 57.5, 1.34, 0.329),
    "Nb": (145, 5017, 26.8, 53.7, 1.41, 0.917), "Ti": (140, 3560, 18.8, 21.9, 1.38, 0.076), "Zr": (155, 4682, 19.2, 22.7, 1.32, 0.433), "V": (135, 3680, 17.5, 30.7, 1.53, 0.525),
    "Cr": (140, 2944, 21, 93.9, 1.65, 0.666), "K": (220, 1032, 2.33, 102.5, 0.734, 0.501), "Fe": (140, 3134, 13.8, 80.4, 1.8, 0.151), "Ni": (135, 3186, 17.6, 90.9, 1.88, 1.157),
    "Co": (135, 3200, 15.5, 100, 1.84, 0.662), "Cu": (135, 2835, 13, 401, 1.85, 1.236),
}
#: Columns of an element dimension, in order.
COLUMNS = (
    "symbol string, atomic_number int, lattice_structure string, vec int, atomic_weight double, atomic_radius double, metallic_radius double, "
    "covalent_radius double, melting_point double, boiling_point double, density double, lattice_constant double, en_pauling double, "
    "en_allen double, fusion_heat double, thermal_conductivity double, electron_affinity double"
)
GAS_CONSTANT = 8.314


def rows() -> list[dict]:
    """The built-in dimension; properties that are not shipped are null."""
    out = []
    for number, (symbol, weight) in enumerate(ATOMIC_WEIGHT.items(), 1):
        row = dict.fromkeys(c.split()[0] for c in COLUMNS.split(", ")) | {"symbol": symbol, "atomic_number": number, "atomic_weight": weight, "vec": VEC.get(symbol)}
        if symbol in _PROPERTIES:
            *numbers, row["lattice_structure"] = _PROPERTIES[symbol]
            row |= {c: None if v is None else float(v) for c, v in zip(PROPERTY_COLUMNS, numbers)}
        row |= {c: float(v) for c, v in zip(FURTHER_COLUMNS, _FURTHER.get(symbol, ()))}
        out.append(row)
    return out


def element_table(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The element dimension, from a CSV file with COLUMNS if given, else built in. About a hundred rows."""
    if path:
        return spark.read.csv(path, schema=COLUMNS, header=True)
    return spark.createDataFrame(rows(), COLUMNS)


def extend_cache(cached: DataFrame, wanted: DataFrame, source: DataFrame, force_refresh: bool = False) -> DataFrame:
    """Cached element rows plus those of the wanted symbols that are missing, taken from the source.

    With force_refresh nothing that is cached counts: all wanted rows come from the source.
    """
    symbols = wanted.select("symbol").distinct()
    if force_refresh:
        return source.join(symbols, "symbol", "left_semi").select(*cached.columns)
    missing = symbols.join(cached, "symbol", "left_anti")
    return cached.unionByName(source.join(missing, "symbol", "left_semi").select(*cached.columns))


def build_table(spark: SparkSession, path: str, wanted: DataFrame, source: DataFrame, force_refresh: bool = False) -> DataFrame:
    """The rows of the wanted symbols, through a CSV cache that is extended by what it lacks and written back.

    The new cache is written beside the old one and put in its place when it is whole. A symbol that the source does not
    have gives no row.
    """
    from ferrolex.sources.files import exists, replace_csv

    cached = spark.read.csv(path, schema=COLUMNS, header=True) if exists(path) else source.limit(0)
    extended = extend_cache(cached, wanted, source, force_refresh).select(*[c.split()[0] for c in COLUMNS.split(", ")])
    replace_csv(extended, path)
    return spark.read.csv(path, schema=COLUMNS, header=True).join(wanted.select("symbol").distinct(), "symbol", "left_semi")


def element_lookup(elements: DataFrame, symbol: str) -> DataFrame:
    """The row of one symbol; no row for a symbol that is not there."""
    return elements.where(F.col("symbol") == symbol)


def attributes(elements: DataFrame, symbol: str) -> DataFrame:
    """attribute, value: the row of one symbol turned on its side."""
    names = [c for c in elements.columns if c != "symbol"]
    texts = element_lookup(elements, symbol).select("symbol", *[F.col(c).cast("string").alias(c) for c in names])
    return texts.unpivot("symbol", names, "attribute", "value").select("attribute", "value")


def literal(values: dict) -> Column:
    """A map of symbol to double as one constant, folded when the query is planned; null values are left out."""
    text = json.dumps({k: float(v) for k, v in values.items() if v is not None})
    return F.from_json(F.lit(text), "map<string,double>")


def look(values: Column, key: Column) -> Column:
    return F.try_element_at(values, key)


#: A dimension with more rows than this is refused.
MAX_ELEMENTS = 1000


class Elements:
    """The properties of an element dimension as map literals for use inside expressions."""

    def __init__(self, found: list[dict] | None = None):
        self.rows = rows() if found is None else found

    @classmethod
    def of(cls, table: DataFrame | None) -> "Elements":
        """From a dimension table of the caller (its size is checked), else built in."""
        if table is None:
            return cls()
        return cls([r.asDict() for r in small_rows(table, MAX_ELEMENTS, "the element dimension")])

    def property(self, name: str) -> Column:
        return literal({r["symbol"]: r.get(name) for r in self.rows})

    def bcc_lattice(self) -> Column:
        """Lattice constant of BCC elements, else the equivalent from the metallic radius: (4 / sqrt 3) r / 100."""
        out = {}
        for r in self.rows:
            native = r.get("lattice_structure") == "BCC" and r.get("lattice_constant")
            radius = r.get("metallic_radius")
            out[r["symbol"]] = r["lattice_constant"] if native else radius and 4 / 3**0.5 * radius / 100
        return literal(out)


def property_map(name: str) -> Column:
    """One property of the built-in dimension as a map literal."""
    return Elements().property(name)
