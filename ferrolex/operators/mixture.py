"""Mixture rules over a composition, as column expressions over its parts (no shuffle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrolex.functions.elements import GAS_CONSTANT, PAIR_ENTHALPY, USFE, VEC, Elements, literal, look, property_map

#: Output names of the weighted means and the property each is of.
WEIGHTED = {
    "mendeleev_atomic_radius_pm_weighted": "atomic_radius", "mendeleev_metallic_radius_pm_weighted": "metallic_radius",
    "mendeleev_atomic_weight_weighted": "atomic_weight", "mendeleev_melting_point_k_weighted": "melting_point",
    "mendeleev_density_g_cm3_weighted": "density", "mendeleev_electronegativity_weighted": "en_pauling", "mean_boiling_point_k": "boiling_point",
    "mean_fusion_heat_kj_mol": "fusion_heat", "mean_thermal_conductivity_w_mk": "thermal_conductivity", "mean_en_allen": "en_allen",
    "mean_electron_affinity_ev": "electron_affinity",
}
USFE_GUARD = 0.01
USFE_NOTE = "linear mixture of element values; interactions are left out"


def total(parts: Column, term: Callable[[Column], Column]) -> Column:
    """Sum of a term over parts, null terms left out."""
    return F.aggregate(parts, F.lit(0.0), lambda a, p: a + F.coalesce(term(p), F.lit(0.0)))


def weighted_mean(parts: Column, values: Column) -> Column:
    """Mean of a property by fraction over the elements that have it, null where none has. NaN counts as missing."""
    value = lambda p: F.nanvl(look(values, p["el"]), F.lit(None).cast("double"))
    known = total(parts, lambda p: F.when(value(p).isNotNull(), p["f"]))
    return F.when(parts.isNotNull(), F.try_divide(total(parts, lambda p: p["f"] * value(p)), F.nullif(known, F.lit(0.0))))


def missing_from(parts: Column, values: Column) -> Column:
    """Symbols without a value, in the order of the composition."""
    return F.transform(F.filter(parts, lambda p: look(values, p["el"]).isNull()), lambda p: p["el"])


def vec(parts: Column) -> Column:
    """Valence electron concentration: the plain sum, null if an element has no count."""
    values = literal(VEC)
    return F.when(F.size(missing_from(parts, values)) == 0, total(parts, lambda p: p["f"] * look(values, p["el"])))


def size_mismatch(parts: Column, radii: Column | None = None) -> Column:
    """100 sqrt(sum f (1 - r / mean)^2) over the metallic radii; elements without a radius drop out of the sum."""
    radii = property_map("metallic_radius") if radii is None else radii
    mean = weighted_mean(parts, radii)
    spread = F.aggregate(
        parts, F.lit(0.0), lambda a, p: a + F.coalesce(p["f"] * F.pow(1 - look(radii, p["el"]) / mean, 2), F.lit(0.0))
    )
    return F.when(mean.isNotNull() & (mean != 0), 100 * F.sqrt(spread))


def mixing_entropy(parts: Column) -> Column:
    """-R sum f ln f over positive fractions; 0 for a single element."""
    inner = total(parts, lambda p: F.when(p["f"] > 0, p["f"] * F.ln(F.when(p["f"] > 0, p["f"]))))
    return F.when(F.size(parts) > 1, -GAS_CONSTANT * inner).when(parts.isNotNull(), 0.0)


def pairs(parts: Column) -> Column:
    """array<struct<name, x, h>> of all element pairs in the order of the composition: label a-b, product, enthalpy."""
    by_label = literal({label: h for label, h in PAIR_ENTHALPY.items()} | {"-".join(reversed(label.split("-"))): h for label, h in PAIR_ENTHALPY.items()})

    def from_(p: Column, i: Column) -> Column:
        later = F.slice(parts, i + 2, F.greatest(F.size(parts) - i - 1, F.lit(0)))
        return F.transform(later, lambda q: F.struct(F.concat_ws("-", p["el"], q["el"]).alias("name"), (p["f"] * q["f"]).alias("x"), look(by_label, F.concat_ws("-", p["el"], q["el"])).alias("h")))

    return F.flatten(F.transform(parts, from_))


def mixing_enthalpy(parts: Column) -> Column:
    """Sum of 4 h x y over pairs, null if a pair has no value; 0 for a single element."""
    p = pairs(parts)
    value = F.aggregate(p, F.lit(0.0), lambda a, q: a + 4 * q["h"] * q["x"])
    return F.when(F.size(parts) <= 1, 0.0).when(~F.exists(p, lambda q: q["h"].isNull()), value)


def missing_pairs(parts: Column) -> Column:
    return F.transform(F.filter(pairs(parts), lambda q: q["h"].isNull()), lambda q: q["name"])


def bcc_lattice(parts: Column, elements: Elements | None = None) -> Column:
    """Mean lattice constant of the BCC equivalent in angstrom."""
    return weighted_mean(parts, (elements or Elements()).bcc_lattice())


def usfe(parts: Column) -> Column:
    """Linear mixture over the known elements; null if an unknown one holds more than USFE_GUARD or none is known."""
    values = literal(USFE)
    guarded = F.exists(parts, lambda p: look(values, p["el"]).isNull() & (p["f"] > USFE_GUARD))
    return F.when(parts.isNotNull() & ~guarded, weighted_mean(parts, values))


def features(parts: Column, elements: Elements | None = None) -> dict[str, Column]:
    """All mixture features by name, from the element dimension given or the built-in one."""
    elements = elements or Elements()
    none = lambda a: F.when(F.size(a) > 0, a)
    out = {name: weighted_mean(parts, elements.property(p)) for name, p in WEIGHTED.items()}
    out["mendeleev_a_bcc_equiv_angstrom"] = bcc_lattice(parts, elements)
    out["mix_vec"], out["mix_size"] = vec(parts), size_mismatch(parts, elements.property("metallic_radius"))
    out["mix_entropy"], out["mix_enthalpy"] = mixing_entropy(parts), mixing_enthalpy(parts)
    out["mendeleev_vec_missing_elements"] = none(missing_from(parts, literal(VEC)))
    out["mendeleev_h_mix_missing_pairs"] = none(missing_pairs(parts))
    out["usfe_linear_mixture_mj_m2"] = usfe(parts)
    out["usfe_approximation_note"] = F.when(parts.isNotNull(), F.lit(USFE_NOTE))
    out["usfe_missing_elements"] = none(missing_from(parts, literal(USFE)))
    return out
