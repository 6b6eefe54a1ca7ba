"""Compositions of records: from a formula string, else from the discrete dopant fields.

Everything is computed within the row, in steps that each build on the columns of the one before, so a composition
costs no shuffle. parts is array<struct<el, f>> in the order in which the elements were given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolex.functions.elements import ATOMIC_WEIGHT, literal, look

TOKEN = "([A-Z][a-z]?)([0-9]*\\.?[0-9]*)"
#: An innermost pair of brackets: what is in round or square ones, and the amount behind.
INNERMOST = r"(?:\(([^()\[\]]*)\)|\[([^()\[\]]*)\])([0-9]*\.?[0-9]*)"
BASE = "W"
PART = "array<struct<el:string,f:double>>"


def _weights() -> Column:
    return literal(ATOMIC_WEIGHT)


def is_element(symbol: Column) -> Column:
    return look(_weights(), symbol).isNotNull()


def summed(parts: Column) -> Column:
    """Sum of the fractions of parts."""
    return F.aggregate(parts, F.lit(0.0), lambda a, p: a + p["f"])


def scaled(parts: Column, by: Column) -> Column:
    return F.transform(parts, lambda p: F.struct(p["el"].alias("el"), (p["f"] / by).alias("f")))


def merged(parts: Column) -> Column:
    """Parts of one element added up, at the place of the first."""
    names = F.array_distinct(F.transform(parts, lambda p: p["el"]))
    return F.transform(names, lambda n: F.struct(n.alias("el"), summed(F.filter(parts, lambda p: p["el"] == n)).alias("f")))


def with_formula(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the normalised atomic fractions of a formula such as W0.95Ni0.05 or W0.9(Re2O3)0.1, null where it cannot be read.

    The tokens must make up the whole string, symbols must be elements, a missing amount is 1, the amounts must not
    all be zero; brackets are expanded.
    """
    x = df.withColumn("_flat", expand_brackets(F.col(text)))
    t = F.col("_flat")
    x = x.withColumns({"_names": F.regexp_extract_all(t, F.lit(TOKEN), F.lit(1)), "_amounts": F.regexp_extract_all(t, F.lit(TOKEN), F.lit(2))})
    x = x.withColumn("_raw", F.zip_with("_names", "_amounts", lambda n, a: F.struct(n.alias("el"), F.when(a == "", 1.0).otherwise(a.try_cast("double")).alias("f"))))
    x = x.withColumns({"_whole": F.array_join(F.zip_with("_names", "_amounts", lambda n, a: F.concat(n, a)), ""), "_total": F.aggregate("_raw", F.lit(0.0), lambda a, p: a + p["f"])})
    fits = (F.col("_whole") == t) & (F.size("_names") > 0) & F.forall("_raw", lambda p: is_element(p["el"]) & p["f"].isNotNull()) & (F.col("_total") > 0)
    x = x.withColumn("_scaled", F.when(fits, scaled(F.col("_raw"), F.col("_total"))))
    x = x.withColumn(out, merged(F.col("_scaled")).cast(PART))
    return x.drop("_flat", "_names", "_amounts", "_raw", "_whole", "_total", "_scaled")


def expand_brackets(text: Column) -> Column:
    """Formulas with round or square brackets written flat, W0.9(Re2O3)0.1 as W0.9Re0.2O0.3; others as they are.

    An innermost pair is expanded per opening bracket, inside the JVM. Where brackets do not match or hold something else
    than tokens, some remain, and the text cannot be read as a formula.
    """

    def step(t: Column, _: Column) -> Column:
        inner = F.concat(F.regexp_extract(t, INNERMOST, 1), F.regexp_extract(t, INNERMOST, 2))
        whole = F.regexp_extract(t, INNERMOST, 0)
        times = F.coalesce(F.regexp_extract(t, INNERMOST, 3).try_cast("double"), F.lit(1.0))
        names, amounts = F.regexp_extract_all(inner, F.lit(TOKEN), F.lit(1)), F.regexp_extract_all(inner, F.lit(TOKEN), F.lit(2))
        amount = lambda a: F.when(a == "", 1.0).otherwise(a.try_cast("double"))
        flat = F.array_join(F.zip_with(names, amounts, lambda n, a: F.concat(n, (amount(a) * times).cast("decimal(30,12)").cast("string"))), "")
        fits = (whole != "") & (F.array_join(F.zip_with(names, amounts, lambda n, a: F.concat(n, a)), "") == inner) & flat.isNotNull()
        return F.when(fits, F.overlay(t, flat, F.call_function("locate", whole, t), F.length(whole))).otherwise(t)

    pairs = F.sequence(F.lit(1), F.length(F.regexp_replace(text, r"[^(\[]", "")))
    return F.when(text.rlike(r"[(\[]"), F.aggregate(pairs, text, step)).otherwise(text)


def dopant_fraction(amount: Column, unit: Column) -> Column:
    """struct<kind, f>: ppm and wt% by weight, at% by atoms, null for any other unit."""
    return (
        F.when(unit == "ppm", F.struct(F.lit("wt").alias("kind"), (amount / 1e6).alias("f")))
        .when(unit == "wt%", F.struct(F.lit("wt").alias("kind"), (amount / 100).alias("f")))
        .when(unit == "at%", F.struct(F.lit("at").alias("kind"), (amount / 100).alias("f")))
    )


def weight_from_atoms(f: Column, symbol: Column) -> Column:
    """Weight fraction of a single dopant in tungsten from its atomic fraction."""
    a, w = look(_weights(), symbol), ATOMIC_WEIGHT[BASE]
    return f * a / (f * a + (1 - f) * w)


def wt_to_at(df: DataFrame, weights: str, out: str) -> DataFrame:
    """Adds atomic fractions from weight fractions: moles over their sum."""
    x = df.withColumn("_moles", F.transform(weights, lambda p: F.struct(p["el"].alias("el"), (p["f"] / look(_weights(), p["el"])).alias("f"))))
    x = x.withColumn("_total", summed(F.col("_moles")))
    return x.withColumn(out, scaled(F.col("_moles"), F.col("_total"))).drop("_moles", "_total")


def last_wins(parts: Column) -> Column:
    """One part per element, with the value of its last mention at the place of the first."""
    names = F.array_distinct(F.transform(parts, lambda p: p["el"]))
    return F.transform(names, lambda n: F.struct(n.alias("el"), F.element_at(F.filter(parts, lambda p: p["el"] == n), -1)["f"].alias("f")))


#: The columns of the two dopants of a record: symbol, amount, unit.
DOPANTS = (
    ("dopant_or_alloying_element", "dopant_concentration", "dopant_concentration_unit"),
    ("second_dopant_element", "second_dopant_concentration", "second_dopant_concentration_unit"),
)
NONE = "array<string>"


def with_discrete(df: DataFrame, parts: str = "field_parts", notes: str = "field_notes") -> DataFrame:
    """Adds the composition by the discrete fields and its warnings, in steps that build on each other.

    pure gives the base alone; doped and alloy need a usable dopant; any other type gives null.
    """
    slots = [F.struct(F.nullif(s, F.lit("")).alias("el"), F.col(c).alias("c"), dopant_fraction(F.col(c), F.col(u)).alias("d")) for s, c, u in DOPANTS]
    part = lambda e: F.struct(e["el"].alias("el"), e["d"]["f"].alias("f"))
    x = df.withColumn("_all", F.filter(F.array(*slots), lambda e: e["el"].isNotNull()))
    x = x.withColumn("_use", F.filter("_all", lambda e: e["c"].isNotNull() & e["d"].isNotNull()))
    x = x.withColumn("_good", F.filter("_use", lambda e: is_element(e["el"])))
    x = x.withColumn("_wt", F.transform(F.filter("_good", lambda e: e["d"]["kind"] == "wt"), part))
    x = x.withColumn("_at", F.transform(F.filter("_good", lambda e: e["d"]["kind"] == "at"), part))
    x = x.withColumn("_by_wt", (F.size("_wt") > 0)).withColumn("_mixed", F.col("_by_wt") & (F.size("_at") > 0))
    turned = F.transform("_at", lambda p: F.struct(p["el"].alias("el"), weight_from_atoms(p["f"], p["el"]).alias("f")))
    x = x.withColumn("_given", F.when(F.col("_mixed"), F.concat("_wt", turned)).when(F.col("_by_wt"), F.col("_wt")).otherwise(F.col("_at")))
    x = x.withColumn("_given", last_wins(F.col("_given")))
    x = x.withColumn("_sum", summed(F.col("_given")))
    base = F.array(F.struct(F.lit(BASE).alias("el"), F.greatest(F.lit(0.0), 1 - F.col("_sum")).alias("f")))
    x = x.withColumn("_full", F.concat("_given", base))
    x = x.withColumn("_full", last_wins(F.col("_full")))
    x = x.withColumn("_moles", F.transform("_full", lambda p: F.struct(p["el"].alias("el"), (p["f"] / look(_weights(), p["el"])).alias("f"))))
    x = x.withColumn("_total", summed(F.col("_moles")))
    kind = F.col("composition_type")
    alloyed = F.when(F.size("_given") == 0, None).when(F.col("_by_wt"), scaled(F.col("_moles"), F.col("_total"))).otherwise(F.col("_full"))
    pure = F.array(F.struct(F.lit(BASE).alias("el"), F.lit(1.0).alias("f")))
    none = F.array().cast(NONE)
    said = F.concat(
        F.transform(F.filter("_all", lambda e: e["c"].isNull() | e["d"].isNull()), lambda e: F.concat(F.lit("no usable amount of "), e["el"])),
        F.transform(F.filter("_use", lambda e: ~is_element(e["el"])), lambda e: F.concat(F.lit("no element "), e["el"])),
        F.when(F.col("_mixed"), F.array(F.lit("mixed units of dopants"))).otherwise(none),
        F.when(F.col("_sum") > 1, F.array(F.lit("dopants exceed the whole"))).otherwise(none),
    )
    found = F.when(kind == "pure", pure).when(kind.isin("doped", "alloy"), alloyed).cast(PART)
    result = F.struct(found.alias(parts), F.when(kind.isin("doped", "alloy"), said).otherwise(none).alias(notes))
    return once(x, df.columns, result)


def once(df: DataFrame, keep: list[str], result: Column) -> DataFrame:
    """The columns to keep and the members of a struct, computed once per row behind a generator.

    Without it a filter on the result would be copied into the steps that build it, and they into each other.
    """
    kept = [F.col(f"`{c}`") for c in keep]
    return df.select(*kept, F.explode(F.array(result)).alias("_once")).select(*kept, "_once.*")


def with_composition(df: DataFrame) -> DataFrame:
    """Adds parts, format_used and composition_warnings: the string first, the discrete fields where it fails.

    parts is null where neither gives a composition; the warning of a failed string is kept.
    """
    x = with_discrete(df).withColumn("_text", F.nullif("composition_string", F.lit("")))
    x = with_formula(x, "_text", "_string_parts")
    kind = F.col("composition_type")
    used = (
        F.when(F.col("_string_parts").isNotNull(), "A_composition_string").when(F.col("field_parts").isNull(), None)
        .when(kind == "pure", "B_pure").otherwise("B_discrete_fields")
    )
    failed = F.when(F.col("_text").isNotNull(), F.array(F.concat(F.lit("cannot read "), "_text"))).otherwise(F.array().cast(NONE))
    warnings = F.when(F.col("_string_parts").isNotNull(), F.array().cast(NONE)).otherwise(F.concat(failed, "field_notes"))
    result = F.struct(F.coalesce("_string_parts", "field_parts").alias("parts"), used.alias("format_used"), warnings.alias("composition_warnings"))
    return once(x, df.columns, result)


def formula_string(parts: Column) -> Column:
    """The inverse of `with_formula`: symbols with their fractions to twelve places in order, no blanks, no exponents."""
    amount = lambda f: F.regexp_replace(f.cast("decimal(18,12)").cast("string"), r"\.?0+$", "")
    return F.array_join(F.transform(parts, lambda p: F.concat(p["el"], F.coalesce(F.nullif(amount(p["f"]), F.lit("")), F.lit("0")))), "")
