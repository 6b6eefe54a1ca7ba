"""Selection of a phase per formula from cached answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ferrolex.operators.nested import parsed
from ferrolex.session import cut

# Limits of the selection.
NEAR_HULL, GROUND_STATE, TRACE, NO_HULL = 0.1, 1e-6, 0.01, 1e6
# Fixed value: the metals whose presence marks a heavy alloy.
HEAVY = ("Ni", "Co", "Cu")
HEAVY_FLAG = "W_heavy_alloy_no_DBTT"
REASONS = {
    "off": "phase lookup is switched off", "client": "no client for the phase search", "trace": "all elements are below the trace limit",
    "miss": "no answer in the cache", "failed": "phase search failed: ", "empty": "no matching entries", "unusable": "no usable phase",
    "heavy": "heavy alloy: not looked up",
}
PHASE_COLUMNS = {
    "mp_material_id": "string", "mp_formula": "string", "mp_bulk_modulus_gpa": "double", "mp_shear_modulus_gpa": "double",
    "mp_formation_energy_ev_atom": "double", "mp_energy_above_hull_ev_atom": "double", "mp_crystal_system": "string",
    "mp_spacegroup_symbol": "string", "mp_is_stable": "boolean", "mp_bcc_assumption_applied": "boolean", "mp_all_phases_found": "boolean",
}


def without_traces(parts: Column) -> Column:
    """Parts of at least the trace limit, not renormalised."""
    return F.filter(parts, lambda p: p["f"] >= TRACE)


def rounded(x: Column) -> Column:
    """A fraction to four places, half to even on the decimal value, printed as short as possible."""
    return F.regexp_replace(F.call_function("format_number", x, F.lit("0.0000")), ",", "").cast("double").cast("string")


def formula_key(parts: Column) -> Column:
    """Symbols in alphabetical order with fractions to four places."""
    ordered = F.array_sort(F.transform(parts, lambda p: F.struct(p["el"].alias("el"), p["f"].alias("f"))))
    return F.array_join(F.transform(ordered, lambda p: F.concat(p["el"], rounded(p["f"]))), "")


def cache_path(key: Column) -> Column:
    return F.concat(F.replace(key, F.lit("/"), F.lit("_")), F.lit(".json"))


def chemical_system(parts: Column) -> Column:
    return F.array_join(F.array_sort(F.transform(parts, lambda p: p["el"])), "-")


def heavy_alloy_flag(parts: Column) -> Column:
    """The flag where one of the marking metals is present, at whatever fraction; null without a composition."""
    return F.when(F.exists(parts, lambda p: p["el"].isin(*HEAVY)), HEAVY_FLAG)


def phase_docs(answers: DataFrame) -> DataFrame:
    """cache_key and docs: array of flat documents of the latest readable answer of each key.

    An answer with an empty list is a cached negative result. Unreadable answers do not replace older ones. The
    latest answer of a key is found by an aggregate, so a key fetched very often costs one row per task.
    """
    p = parsed(answers.select("cache_id", "cache_key", "written_at", "payload")).where(F.col("docs").isNotNull() & F.col("cache_key").isNotNull())
    g = lambda d, path, t: F.try_variant_get(d, path, t)
    doc = lambda d, i: F.struct(
        i.alias("pos"), g(d, "$.material_id", "string").alias("material_id"), g(d, "$.formula_pretty", "string").alias("formula"),
        g(d, "$.energy_above_hull", "double").alias("e_hull"), g(d, "$.formation_energy_per_atom", "double").alias("formation_energy"),
        g(d, "$.is_stable", "boolean").alias("is_stable"), g(d, "$.symmetry.crystal_system", "string").alias("crystal_system"),
        g(d, "$.symmetry.symbol", "string").alias("spacegroup"), g(d, "$.bulk_modulus.vrh", "double").alias("bulk"), g(d, "$.shear_modulus.vrh", "double").alias("shear"),
    )
    flat = p.select("cache_key", "written_at", "cache_id", F.transform("docs", doc).alias("docs"))
    return flat.groupBy("cache_key").agg(F.max_by("docs", F.struct("written_at", "cache_id")).alias("docs"))


def select_phase(docs: Column, n_elements: Column) -> Column:
    """The chosen document with all_phases_found and bcc_assumption, null without documents.

    A pure element with documents in the ground state takes the first stable of them, else the first. Otherwise the
    pool is what lies near the hull, or everything; cubic members come first, then the lowest energy, then the order.
    """
    hull = lambda d: F.coalesce(d["e_hull"], F.lit(NO_HULL))
    ground = (n_elements == 1) & F.exists(docs, lambda d: F.abs(hull(d)) <= GROUND_STATE)
    near = F.exists(docs, lambda d: hull(d) <= NEAR_HULL)
    cubic = lambda d: F.coalesce(d["crystal_system"] == "Cubic", F.lit(False))

    def rank(d: Column) -> Column:
        out_of_pool = F.when(ground, F.abs(hull(d)) > GROUND_STATE).otherwise(near & (hull(d) > NEAR_HULL))
        second = F.when(ground, ~F.coalesce(d["is_stable"], F.lit(False))).otherwise(~cubic(d))
        return F.struct(out_of_pool.alias("a"), second.alias("b"), F.when(ground, 0.0).otherwise(hull(d)).alias("c"), d["pos"].alias("pos"))

    first = F.array_min(F.transform(docs, rank))["pos"]
    best = F.element_at(docs, first + 1)
    return F.when(
        F.size(docs) > 0,
        F.struct(best.alias("doc"), (ground | near).alias("all_phases_found"), (~ground & ~cubic(best)).alias("bcc_assumption")),
    )


def select_phase_by_window(docs: DataFrame) -> DataFrame:
    """The same choice over exploded documents (cache_key, n_elements, pos, e_hull, is_stable, crystal_system)."""
    every = W.partitionBy("cache_key")
    hull = F.coalesce("e_hull", F.lit(NO_HULL))
    d = docs.withColumns({"near": F.max(hull <= NEAR_HULL).over(every), "ground": F.max((F.col("n_elements") == 1) & (F.abs(hull) <= GROUND_STATE)).over(every)})
    out_of_pool = F.when(F.col("ground"), F.abs(hull) > GROUND_STATE).otherwise(F.col("near") & (hull > NEAR_HULL))
    cubic = F.coalesce(F.col("crystal_system") == "Cubic", F.lit(False))
    second = F.when(F.col("ground"), ~F.coalesce("is_stable", F.lit(False))).otherwise(~cubic)
    order = every.orderBy(out_of_pool, second, F.when(F.col("ground"), 0.0).otherwise(hull), "pos")
    top = d.withColumn("r", F.row_number().over(order)).where("r = 1")
    return top.select(
        "cache_key", "material_id", (F.col("ground") | F.col("near")).alias("all_phases_found"), (~F.col("ground") & ~cubic).alias("bcc_assumption")
    )


def phase_table(answers: DataFrame) -> DataFrame:
    """cache_key, n_docs and the chosen phase `s` of each key: the choice is made once per key, not once per record.

    The number of elements that the choice depends on is that of the symbols in the key.
    """
    chosen = select_phase(F.col("docs"), F.regexp_count("cache_key", F.lit("[A-Z]")))
    return phase_docs(answers).select("cache_key", F.size("docs").alias("n_docs"), chosen.alias("s"))


def keyed(records: DataFrame, parts: str = "parts", phase_source: str = "cache", client: bool = True) -> DataFrame:
    """Adds _why (reason not to look up, in this order: no composition, heavy alloy, off, no client, traces only) and _key."""
    p = without_traces(F.col(parts))
    reason = (
        F.when(F.col(parts).isNull(), None).when(heavy_alloy_flag(F.col(parts)).isNotNull(), REASONS["heavy"]).when(F.lit(phase_source == "off"), REASONS["off"])
        .when(F.lit(not client), REASONS["client"]).when(F.size(p) == 0, REASONS["trace"])
    )
    return records.withColumn("_why", reason).withColumn("_key", F.when(F.col(parts).isNotNull() & F.col("_why").isNull(), formula_key(p)))


def missing_systems(records: DataFrame, answers: DataFrame, parts: str = "parts") -> DataFrame:
    """cache_key, chemsys: the keys of records without an answer in the cache, each once, with their chemical system."""
    asked = keyed(records, parts).where("_key is not null").select(F.col("_key").alias("cache_key"), chemical_system(without_traces(F.col(parts))).alias("chemsys"))
    return asked.groupBy("cache_key").agg(F.first("chemsys").alias("chemsys")).join(phase_docs(answers).select("cache_key"), "cache_key", "left_anti")


def searched(records: DataFrame, answers: DataFrame, transport, url: str, parts: str = "parts") -> DataFrame:
    """cache_id, cache_key, written_at, payload, error of the phase searches for all missing keys; one request per chemical system.

    Requests are made once and their answers kept; rows without an error can be added to the cache.
    """
    from ferrolex.sources.connectors import phase_search

    wanted = cut(missing_systems(records, answers, parts))
    found = cut(phase_search(wanted.select("chemsys"), transport, url))
    return wanted.join(found, "chemsys").select(F.lit(None).cast("bigint").alias("cache_id"), "cache_key", F.current_timestamp().alias("written_at"), "payload", "error")


def with_phases(records: DataFrame, answers: DataFrame, parts: str = "parts", phase_source: str = "cache", transport=None, url: str = "") -> DataFrame:
    """Adds the phase columns and mp_query_skipped. Heavy alloys are not looked up, nor is a composition of traces.

    phase_source: off, cache (misses are reported) or live (misses are searched for with the transport; what is found
    counts like a cached answer, see `searched` for writing it back). One row per key is joined; a frequent key, such as
    that of the pure metal, meets one row, and AQE splits it where the join shuffles.
    """
    if phase_source not in ("off", "cache", "live"):
        raise ValueError(f"phase_source must be off, cache or live, not {phase_source!r}")
    live = phase_source == "live" and transport is not None
    rows = keyed(records, parts, phase_source, client=phase_source != "live" or live)
    chosen = phase_table(answers).select(F.col("cache_key").alias("_key"), "n_docs", "s", F.lit(None).cast("string").alias("_failed"))
    if live:
        new = searched(records, answers, transport, url, parts)
        more = phase_table(new.where("error is null")).select(F.col("cache_key").alias("_key"), "n_docs", "s", F.lit(None).cast("string").alias("_failed"))
        failed = new.where("error is not null").select(F.col("cache_key").alias("_key"), F.lit(None).cast("int").alias("n_docs"), F.lit(None).cast(chosen.schema["s"].dataType).alias("s"), F.col("error").alias("_failed"))
        chosen = chosen.unionByName(more).unionByName(failed)
    j = rows.join(chosen, "_key", "left")
    d, empty = F.col("s.doc"), F.col("n_docs") == 0
    values = {
        "mp_material_id": d["material_id"], "mp_formula": F.when(empty, F.col("_key")).otherwise(d["formula"]), "mp_bulk_modulus_gpa": d["bulk"], "mp_shear_modulus_gpa": d["shear"],
        "mp_formation_energy_ev_atom": d["formation_energy"], "mp_energy_above_hull_ev_atom": d["e_hull"], "mp_crystal_system": d["crystal_system"],
        "mp_spacegroup_symbol": d["spacegroup"], "mp_is_stable": d["is_stable"], "mp_bcc_assumption_applied": F.col("s.bcc_assumption"),
        "mp_all_phases_found": F.when(empty, False).otherwise(F.col("s.all_phases_found")),
    }
    missed = F.when(F.col("_key").isNotNull() & F.col("n_docs").isNull(), F.coalesce(F.concat(F.lit(REASONS["failed"]), "_failed"), F.lit(REASONS["miss"])))
    skipped = F.coalesce("_why", missed, F.when(empty, REASONS["empty"]), F.when(F.col("_key").isNotNull() & F.col("s").isNull(), REASONS["unusable"]))
    return j.withColumns(values | {"mp_query_skipped": skipped}).drop("_why", "_key", "_failed", "s", "n_docs")


def empty_phases(df: DataFrame, reason: str) -> DataFrame:
    """The phase columns as typed nulls with a reason."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in PHASE_COLUMNS.items()} | {"mp_query_skipped": F.lit(reason)})
