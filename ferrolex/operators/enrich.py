"""Records to model-ready rows: composition, mixture features, overwrite, phases, flags and a log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolex.functions.elements import Elements
from ferrolex.operators import mixture
from ferrolex.operators.composition import with_composition
from ferrolex.operators.phases import heavy_alloy_flag, with_phases

#: Columns of a record that a computed feature replaces where it has a value.
AUTHORITATIVE = {"vec": "mix_vec", "delta_s_mix_j_mol_k": "mix_entropy", "delta_atomic_size": "mix_size", "delta_h_mix_kj_mol": "mix_enthalpy"}


def record_label() -> Column:
    return F.coalesce(F.nullif("record_id", F.lit("")), F.nullif("material_name", F.lit("")), F.lit("unknown"))


def authoritative_overwrite(df: DataFrame) -> DataFrame:
    """Record columns replaced by computed ones that are neither null nor NaN, with lists of what was replaced and kept."""
    num = lambda c: F.nanvl(F.col(c), F.lit(None).cast("double"))
    changed = [F.when(num(new).isNotNull(), F.lit(old)) for old, new in AUTHORITATIVE.items()]
    kept = [F.when(num(new).isNull(), F.lit(old)) for old, new in AUTHORITATIVE.items()]
    out = df.withColumns({"overwritten": F.array_compact(F.array(*changed)), "kept_original": F.array_compact(F.array(*kept))})
    return out.withColumns({old: F.coalesce(num(new), F.col(old)) for old, new in AUTHORITATIVE.items()}).drop(*AUTHORITATIVE.values())


def enrich(records: DataFrame, answers: DataFrame, phase_source: str = "cache", elements: DataFrame | None = None, transport=None, url: str = "") -> DataFrame:
    """One row per record: all its columns and the features. Only the phase join shuffles.

    `elements` is a dimension table with the columns of the built-in one; phase_source, transport and url as in
    `with_phases`. Records without a composition keep their columns and have null features.
    """
    df = with_composition(records)
    df = df.withColumn("dataset_scope_flag", heavy_alloy_flag(F.col("parts")))
    df = authoritative_overwrite(df.withColumns(mixture.features(F.col("parts"), Elements.of(elements))))
    df = with_phases(df, answers, phase_source=phase_source, transport=transport, url=url)
    return df.withColumn("fractions", F.map_from_entries(F.transform("parts", lambda p: F.struct(p["el"], p["f"])))).drop("parts")


def outer_union(tables: list[DataFrame]) -> DataFrame:
    """All rows of tables with different columns: the columns of all, null where a table has none of that name."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def fraction_rows(df: DataFrame, key: str = "rec_key") -> DataFrame:
    """key, pos, el, frac: one row per element of a composition."""
    return df.select(key, F.posexplode("parts").alias("pos", "p")).select(key, "pos", F.col("p.el").alias("el"), F.col("p.f").alias("frac"))


def _named(element: str):
    return lambda p: p["el"] == element


def fraction_columns(df: DataFrame, elements: list[str]) -> DataFrame:
    """frac_X columns for the elements given, null where absent; no pivot, no shuffle."""
    return df.withColumns({f"frac_{e.lower()}": F.try_element_at(F.filter("parts", _named(e)), F.lit(1))["f"] for e in elements})


def log_lines(df: DataFrame, keys: tuple[str, ...] = ("rec_key",)) -> DataFrame:
    """keys, seq, level, message of what happened to each record, from its composition to its phases.

    Lines on overwritten columns, phases and stacking faults come where `df` went through `enrich`.
    """
    label, has = record_label(), set(df.columns)
    composed = F.col("format_used").isNotNull()
    said = lambda level, text, when=None: F.when(composed if when is None else when, F.struct(F.lit(level).alias("level"), F.concat_ws(" ", label, text).alias("message")))
    lines = [F.array(F.struct(
        F.when(composed, "INFO").otherwise("WARN").alias("level"),
        F.concat_ws(" ", label, F.coalesce(F.concat(F.lit("composition by "), F.col("format_used")), F.lit("no composition"))).alias("message"),
    ))]
    lines.append(F.transform("composition_warnings", lambda w: F.struct(F.lit("WARN").alias("level"), F.concat_ws(" ", label, w).alias("message"))))
    if "dataset_scope_flag" in has:
        lines.append(F.array(said("INFO", F.concat(F.lit("scope "), "dataset_scope_flag"), F.col("dataset_scope_flag").isNotNull())))
    if "overwritten" in has:
        for name, text in (("overwritten", "overwritten: "), ("kept_original", "kept: ")):
            lines.append(F.array(said("INFO", F.concat(F.lit(text), F.array_join(name, ", ")), composed & (F.size(name) > 0))))
    if "mp_query_skipped" in has:
        lines.append(F.array(said("INFO", F.coalesce(F.concat(F.lit("phase skipped: "), "mp_query_skipped"), F.concat(F.lit("phase "), F.coalesce("mp_material_id", F.lit("unnamed")))))))
    if "usfe_approximation_note" in has:
        lines.append(F.array(said("INFO", F.concat(F.lit("stacking fault energy: "), "usfe_approximation_note"), F.col("usfe_approximation_note").isNotNull())))
    every = F.array_compact(F.concat(*lines))
    return df.select(*keys, F.posexplode(every).alias("seq", "l")).select(*keys, (F.col("seq") + 1).alias("seq"), "l.*")


def log_header(df: DataFrame) -> DataFrame:
    """One line with the time of the run, to stand before the lines of a log."""
    return df.sparkSession.range(1).select(F.concat(F.lit("feature log, run at "), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("value"))
