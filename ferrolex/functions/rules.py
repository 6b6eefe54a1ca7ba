"""Rules of the record schema as column expressions: units, derived quantities, tags, histories and enumerations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The enumerations of the schema.
COMPOSITION_TYPES = ("pure", "doped", "alloy")
CONCENTRATION_UNITS = ("ppm", "wt%", "at%")
GRAIN_DIMENSIONS = ("full_3D", "two_directions", "single_direction_only")


def celsius_to_kelvin(c: Column) -> Column:
    return c + 273.15


def range_midpoint(low: Column, high: Column) -> Column:
    return (low + high) / 2


def range_half_width(low: Column, high: Column) -> Column:
    return (high - low) / 2


def log_strain(reduction: Column, passes: Column | None = None) -> Column:
    """ln(1 / (1 - r)) of a reduction r below 1, times the passes if given; else null."""
    one = F.when(reduction < 1, -F.ln(F.when(reduction < 1, 1 - reduction)))
    return one if passes is None else passes * one


def per_cm2_to_per_m2(x: Column) -> Column:
    return x * 1e4


def boundary_area_per_volume(l: Column, t: Column, s: Column) -> Column:  # noqa: E741
    """1/L + 1/T + 1/S, null unless all three are there and not 0."""
    return F.try_divide(F.lit(1.0), l) + F.try_divide(F.lit(1.0), t) + F.try_divide(F.lit(1.0), s)


def composition_class(purity_pct: Column, dopant_wt_pct: Column) -> Column:
    """pure without dopant at 99.9 % and above, doped below 1 wt%, else alloy."""
    none = F.coalesce(dopant_wt_pct, F.lit(0.0)) == 0
    return F.when(none & (purity_pct >= 99.9), "pure").when(dopant_wt_pct < 1, "doped").when(dopant_wt_pct >= 1, "alloy")


def in_enumeration(value: Column, allowed: tuple[str, ...]) -> Column:
    """Null counts as allowed."""
    return value.isNull() | value.isin(*allowed)


def note_tags(notes: Column) -> Column:
    """array<string> of the tags in square brackets."""
    return F.regexp_extract_all(notes, F.lit("\\[([a-z_]+)\\]"), F.lit(1))


def graph_confidence(notes: Column) -> Column:
    return F.nullif(F.regexp_extract(notes, "\\[graph_read\\]\\[(high|low)\\]", 1), F.lit(""))


def history_step(step: Column) -> Column:
    """struct<method, temperature_k, reduction_pct, passes> of one step of a processing history."""
    number = lambda pattern: F.nullif(F.regexp_extract(step, pattern, 1), F.lit("")).try_cast("double")
    kelvin = number(r"(\d+(?:\.\d+)?) ?K\b")
    celsius = number(r"(\d+(?:\.\d+)?) ?°?C\b")
    return F.struct(
        F.nullif(F.regexp_extract(step, r"^([a-z][a-z_]+)", 1), F.lit("")).alias("method"),
        F.coalesce(kelvin, celsius_to_kelvin(celsius)).alias("temperature_k"),
        number(r"(\d+(?:\.\d+)?) ?%").alias("reduction_pct"),
        number(r"(\d+)_pass").alias("passes"),
    )


def provenance(references: Column, titles: Column) -> Column:
    """array<struct<pos, reference, title>> of two lists side by side; the longer one counts."""
    n = F.greatest(F.size(F.coalesce(references, F.array().cast("array<string>"))), F.size(F.coalesce(titles, F.array().cast("array<string>"))))
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(i.alias("pos"), F.try_element_at(references, i).alias("reference"), F.try_element_at(titles, i).alias("title"))))


def parse_reply(text: Column, finish_reason: Column, schema: str) -> Column:
    """struct<records, error, truncated> of a model's reply: an array of records, or why there is none."""
    ok = F.schema_of_variant(F.try_parse_json(text)).startswith("ARRAY")
    truncated = F.coalesce(finish_reason.contains("MAX_TOKENS"), F.lit(False))
    return F.struct(F.when(ok, F.from_json(text, f"array<{schema}>")).alias("records"), F.when(~F.coalesce(ok, F.lit(False)), "parse_failed").alias("error"), truncated.alias("truncated"))
