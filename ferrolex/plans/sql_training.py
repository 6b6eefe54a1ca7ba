"""SQL for the operations of a training-data pipeline that SQL can express, as run by an independent engine."""

_NUMERIC = ("dbtt_k", "grain_size_l_um", "pre_existing_dislocation_density_m2", "hardness_hv", "yield_strength_mpa")
_TEXT = ("record_id", "source_doi")
_CELLS = " UNION ALL ".join(
    [f"SELECT load_id, '{c}' AS column_name, {c} AS x, CAST(NULL AS VARCHAR) AS t FROM w_dbtt" for c in _NUMERIC]
    + [f"SELECT load_id, '{c}' AS column_name, CAST(NULL AS DOUBLE) AS x, {c} AS t FROM w_dbtt" for c in _TEXT]
)

P4_FOUND = f"""
WITH cells AS ({_CELLS}),
tops AS (
  SELECT load_id, column_name, max(n) AS n_top
  FROM (SELECT load_id, column_name, x, count(*) AS n FROM cells WHERE x IS NOT NULL GROUP BY ALL)
  GROUP BY load_id, column_name
),
m AS (
  SELECT c.load_id, c.column_name, count(*) AS n_rows, count(x) AS n_numbers, count(t) AS n_texts,
    count(*) FILTER (WHERE x < p.low_value OR x > p.high_value) AS n_out,
    count(*) FILTER (WHERE x <= p.mid_value) AS n_low,
    count(*) FILTER (WHERE NOT regexp_matches(t, p.shape)) AS n_odd,
    any_value(p.null_limit) AS null_limit, any_value(p.low_value) AS low_value, any_value(p.high_value) AS high_value,
    any_value(p.mid_value) AS mid_value, any_value(p.shape) AS shape
  FROM cells c JOIN column_profile p USING (column_name)
  GROUP BY c.load_id, c.column_name
)
SELECT load_id, column_name, 'nulls' AS finding FROM m WHERE (n_rows - n_numbers - n_texts) / n_rows > null_limit
UNION ALL
SELECT load_id, column_name, 'range' FROM m
WHERE n_numbers >= 20 AND (low_value IS NOT NULL OR high_value IS NOT NULL) AND n_out / n_numbers > 0.05
UNION ALL
SELECT load_id, column_name, 'shift' FROM m
WHERE n_numbers >= 20 AND mid_value IS NOT NULL AND (n_low / n_numbers < 0.2 OR n_low / n_numbers > 0.8)
UNION ALL
SELECT m.load_id, m.column_name, 'repeat' FROM m JOIN tops USING (load_id, column_name)
WHERE n_numbers >= 20 AND n_top / n_numbers > 0.3
UNION ALL
SELECT load_id, column_name, 'shape' FROM m WHERE n_texts >= 20 AND shape IS NOT NULL AND n_odd / n_texts > 0.05
"""

_TIMED = _CELLS.replace("load_id, '", "load_id, loaded_at, '")
P4_METRICS_OF = f"""
cells AS ({_TIMED}),
tops AS (
  SELECT load_id, column_name, max(n) AS n_top
  FROM (SELECT load_id, column_name, x, count(*) AS n FROM cells WHERE x IS NOT NULL GROUP BY ALL)
  GROUP BY load_id, column_name
),
m AS (
  SELECT c.load_id, c.column_name, c.column_name NOT IN ('record_id', 'source_doi') AS is_number, min(loaded_at) AS first_at, count(*) AS n_rows,
    count(x) + count(t) AS n_values, count(DISTINCT x) + count(DISTINCT t) AS n_distinct, min(x) AS low, max(x) AS high,
    count(*) FILTER (WHERE x < p.low_value OR x > p.high_value) AS n_out, count(*) FILTER (WHERE x <= p.mid_value) AS n_low,
    count(*) FILTER (WHERE NOT regexp_matches(t, p.shape)) AS n_odd
  FROM cells c JOIN column_profile p USING (column_name) GROUP BY c.load_id, c.column_name
),
metrics AS (
  SELECT m.load_id, m.column_name, is_number, first_at, n_rows, n_values, n_distinct, low, high, (n_rows - n_values) / n_rows AS null_share,
    n_out / nullif(n_values, 0) AS out_share, n_low / nullif(n_values, 0) AS low_share, n_odd / nullif(n_values, 0) AS odd_share,
    CASE WHEN n_top / n_values > 0.3 THEN n_top / n_values END AS top_share
  FROM m LEFT JOIN tops USING (load_id, column_name)
)"""
P4_METRICS = f"WITH {P4_METRICS_OF} SELECT * FROM metrics"
P4_ANOMALIES = f"""
WITH {P4_METRICS_OF},
long AS (
  SELECT load_id, first_at, column_name, metric, x FROM metrics
  UNPIVOT (x FOR metric IN (null_share, out_share, low_share, odd_share))
),
h AS (
  SELECT *, count(x) OVER w AS n, avg(x) OVER w AS mean, stddev_samp(x) OVER w AS dev FROM long
  WINDOW w AS (PARTITION BY column_name, metric ORDER BY first_at, load_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
SELECT load_id, column_name, metric, round(x, 6) AS value, round(mean, 6) AS expected, round(dev, 6) AS deviation
FROM h WHERE n >= 8 AND abs(x - mean) > 3 * dev + 1e-9
"""

_DOCS = """
WITH v AS (SELECT cache_id, CAST(payload AS JSON) AS j FROM mp_cache WHERE json_valid(payload)),
b AS (
  SELECT cache_id, CASE WHEN json_type(j) = 'ARRAY' THEN j
    WHEN json_type(j) = 'OBJECT' AND json_exists(j, '$.material_id') THEN json_array(j)
    WHEN json_type(j) = 'OBJECT' THEN json_extract(j, '$.data') END AS docs
  FROM v
),
doc AS (
  SELECT cache_id, CAST(e.key AS INTEGER) AS doc_pos, e.value AS d FROM b, json_each(b.docs) e WHERE b.docs IS NOT NULL
)
"""

P5_FOUND = (
    _DOCS
    + """
SELECT cache_id, doc_pos, substr(t.fullkey, 3) AS leaf_path
FROM doc, json_tree(doc.d) t
WHERE t.atom IS NOT NULL AND t.type NOT IN ('NULL', 'OBJECT', 'ARRAY')
  AND regexp_matches(t.fullkey, '^\\$\\.(symmetry|bulk_modulus|shear_modulus|origins)[.\\[]')
"""
)

P5_ORIGINS = (
    _DOCS
    + """
SELECT cache_id, doc_pos, 'origins[' || o.key || ']' AS node, 'document' AS parent_table, '' AS parent_node, CAST(o.key AS INTEGER) AS pos,
  o.value->>'$.name' AS name, o.value->>'$.task_id' AS task_id
FROM doc, json_each(doc.d, '$.origins') o
"""
)

P5_ANSWERS = """
WITH v AS (SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS j FROM mp_cache),
b AS (
  SELECT *, json_type(j) AS jt, CASE WHEN json_type(j) = 'ARRAY' THEN j WHEN json_type(j) = 'OBJECT' AND json_exists(j, '$.material_id') THEN json_array(j)
    WHEN json_type(j) = 'OBJECT' THEN json_extract(j, '$.data') END AS docs
  FROM v
)
SELECT cache_id, cache_key, written_at,
  CASE WHEN trim(coalesce(payload, '')) = '' THEN 'empty' WHEN j IS NULL THEN 'broken' WHEN jt = 'ARRAY' THEN 'list' WHEN jt <> 'OBJECT' THEN 'scalar'
    WHEN json_exists(j, '$.material_id') THEN 'document' WHEN docs IS NULL OR json_type(docs) <> 'ARRAY' THEN 'failed' ELSE 'wrapped' END AS outer_form,
  CAST(CASE WHEN json_type(docs) = 'ARRAY' THEN json_array_length(docs) ELSE 0 END AS INTEGER) AS n_documents
FROM b
"""

_PROPERTIES = (("bulk_modulus", ("reuss", "voigt", "vrh")), ("shear_modulus", ("reuss", "voigt", "vrh")))
_SYMMETRY = ("crystal_system", "hall", "point_group", "symbol", "version")
P5_DOCUMENTS = (
    _DOCS
    + "SELECT cache_id, doc_pos, '' AS node, 'answer' AS parent_table, CAST(NULL AS VARCHAR) AS parent_node, CAST(NULL AS INTEGER) AS pos, "
    + ", ".join(f"CAST(d->>'$.{m}.{p}' AS DOUBLE) AS {m}_{p}" for m, ps in _PROPERTIES for p in ps)
    + ", "
    + ", ".join(f"d->>'$.symmetry.{p}' AS symmetry_{p}" for p in _SYMMETRY)
    + """, CAST(d->>'$.symmetry.angle_tolerance' AS DOUBLE) AS symmetry_angle_tolerance, CAST(d->>'$.symmetry.symprec' AS DOUBLE) AS symmetry_symprec,
  CAST(d->>'$.symmetry.number' AS BIGINT) AS symmetry_number, CAST(d->>'$.energy_above_hull' AS DOUBLE) AS energy_above_hull,
  CAST(d->>'$.formation_energy_per_atom' AS DOUBLE) AS formation_energy_per_atom, d->>'$.formula_pretty' AS formula_pretty,
  CAST(d->>'$.is_stable' AS BOOLEAN) AS is_stable, d->>'$.material_id' AS material_id
FROM doc
"""
)

# Fixed values of this SQL: words of bases and scales, with the label each pair stands for.
_WORDS = {"wt": "wt weight mass gew ma masse massen gewichts", "at": "at atom atomic", "vol": "vol volume"}
_SCALES = {"pct": "% pct percent", "pm": "‰ permille permil", "frac": "fraction frac", "ppm": "ppm", "ppb": "ppb"}
_LABELS = {
    ("wt", "pct"): "wt_pct", ("wt", "ppm"): "wt_ppm", ("wt", "ppb"): "wt_ppb", ("wt", "frac"): "mass_fraction", ("wt", "pm"): "g_per_kg",
    ("at", "pct"): "at_pct", ("at", "ppm"): "at_ppm", ("at", "frac"): "atom_fraction", ("vol", "pct"): "vol_pct",
}
_SINGLE = {
    "ppm": "wt_ppm", "wppm": "wt_ppm", "ppmw": "wt_ppm", "ppm(w/w)": "wt_ppm", "mg/kg": "wt_ppm", "ug/g": "wt_ppm", "mgperkg": "wt_ppm", "ugperg": "wt_ppm",
    "ppb": "wt_ppb", "wppb": "wt_ppb", "ppbw": "wt_ppb", "ug/kg": "wt_ppb", "ng/g": "wt_ppb", "ugperkg": "wt_ppb", "g/kg": "g_per_kg", "mg/g": "g_per_kg",
    "gperkg": "g_per_kg", "‰(w/w)": "g_per_kg", "‰massique": "g_per_kg", "g/g": "mass_fraction", "kg/kg": "mass_fraction", "gperg": "mass_fraction",
    "%(w/w)": "wt_pct", "%massique": "wt_pct", "appm": "at_ppm", "ppma": "at_ppm", "ppm(a/a)": "at_ppm", "%(a/a)": "at_pct", "%atomique": "at_pct",
    "atoms/atom": "atom_fraction", "at/at": "atom_fraction", "mol/mol": "atom_fraction", "%(v/v)": "vol_pct", "%volumique": "vol_pct",
}
_KEYS = [(k, label) for k, label in _SINGLE.items()] + [
    (key, label)
    for (basis, scale), label in _LABELS.items()
    for w in _WORDS[basis].split()
    for s in _SCALES[scale].split()
    for key in (w + s, f"{s}({w})", f"{s}by{w}", f"{s}by{w}s")
]
_BASIS, _SCALE = "(?:wt|weight|mass|gew|ma|atomic|atom|at|volume|vol)", "(?:%|‰|pct|percent|per ?mille?)"
_AFTER = r"(?: ?\((?:w/w|wt\.?|mass|weight|at\.?|a/a|v/v|vol\.?|by weight|by atoms)\)| by (?:weight|mass|atoms?|volume)| (?:massique|atomique|volumique))"
_UNIT = (
    rf"(?:{_BASIS}[. \-_]{{0,3}}{_SCALE}|{_SCALE}{_AFTER}|{_BASIS}[. \-_]{{0,3}}frac(?:tion|\.)?|(?:{_BASIS}[. \-_]{{0,3}}|[wa])?pp[mb]{_AFTER}?"
    r"|(?:mg|[uµμ]g|ng|kg|g|atoms|at|mol)(?:/| per )(?:kg|g|atom|at|mol))(?:(?-i:[wa])\b)?"
)
_SYMBOLS = (
    "He|Li|Be|Ne|Na|Mg|Al|Si|Cl|Ar|Ca|Sc|Ti|Cr|Mn|Fe|Co|Ni|Cu|Zn|Ga|Ge|As|Se|Br|Kr|Rb|Sr|Zr|Nb|Mo|Tc|Ru|Rh|Pd|Ag|Cd|In|Sn|Sb|Te|Xe|Cs|Ba|La|Ce|Pr|Nd|Pm|Sm|Eu|"
    "Gd|Tb|Dy|Ho|Er|Tm|Yb|Lu|Hf|Ta|Re|Os|Ir|Pt|Au|Hg|Tl|Pb|Bi|Po|At|Rn|Fr|Ra|Ac|Th|Pa|Np|Pu|H|B|C|N|O|F|P|S|K|V|Y|I|W|U"
)
_WHO = rf"(?:(?:{_SYMBOLS})[0-9]*)+"


def _key(text: str) -> str:
    return rf"regexp_replace(translate(lower({text}), 'µμ', 'uu'), '[\s.\-_]', '', 'g')"


def _first(text: str) -> str:
    return f"nullif({_key(f"regexp_extract({text}, '(?i)(?:^|[^a-z])({_UNIT})', 1)")}, '')"


_CLAIM = rf"\b({_WHO}|addition)\b(?::|,)?(?: [a-z]+:?){{0,6}} ((?i:{_UNIT}))"
_NUMBER = r"[0-9]+(?:[.,][0-9]+)?(?:[eE][-+]?[0-9]+)?"
_VALUE = rf"(?:^|[^A-Za-z0-9.])({_NUMBER})(?:\s*[(\[]?\s*((?i:{_UNIT})))?"
_UNITS = f"""
spelt(unit_key, unit_label) AS (VALUES {', '.join(f"('{k}', '{u}')" for k, u in dict(_KEYS).items())}),
texts AS (
  SELECT rec_key, dopant_concentration AS c1, second_dopant_concentration AS c2, impurity_concentration AS c3, dopant_concentration_unit AS u1,
    second_dopant_concentration_unit AS u2, coalesce(material_name, '') AS name, coalesce(notes, '') AS notes,
    trim(coalesce(dopant_or_alloying_element, '')) AS d1, trim(coalesce(second_dopant_element, '')) AS d2,
    regexp_extract_all(coalesce(notes, ''), '{_CLAIM}', 1) AS who, regexp_extract_all(coalesce(notes, ''), '{_CLAIM}', 2) AS what
  FROM w_dbtt
),
said AS (
  SELECT rec_key, arg_min(what, i) FILTER (WHERE who <> 'W' AND (who = d1 OR who = 'addition' OR (NOT regexp_matches(d1, '^{_WHO}$') AND who <> d2))) AS of1,
    arg_min(what, i) FILTER (WHERE who <> 'W' AND who = d2) AS of2
  FROM (SELECT rec_key, d1, d2, unnest(who) AS who, unnest(what) AS what, generate_subscripts(who, 1) AS i FROM texts) GROUP BY rec_key
),
stated AS (
  SELECT t.*, coalesce({_first('u1')}, {_first('name')}, nullif({_key('of1')}, '')) AS k1, coalesce({_first('u2')}, nullif({_key('of2')}, '')) AS k2,
    coalesce({_first('c3')}, nullif({_key(f"regexp_extract(notes, '(?i:impurit(?:y|ies)[^.[\\]]*?[ :])((?i:{_UNIT}))', 1)")}, ''), 'ppm') AS k3,
    regexp_replace(c3, '([0-9]),([0-9])', '\\1.\\2', 'g') AS c3d
  FROM texts t LEFT JOIN said USING (rec_key)
),
found AS (
  SELECT rec_key, k3, c3, regexp_extract_all(c3d, '{_VALUE}', 1) AS n, regexp_extract_all(c3d, '{_VALUE}', 2) AS u FROM stated WHERE c3 IS NOT NULL
),
each AS (
  SELECT rec_key, 'dopant_concentration' AS field_name, 1 AS value_pos, k1 AS unit_key, c1 AS number FROM stated WHERE c1 IS NOT NULL
  UNION ALL SELECT rec_key, 'second_dopant_concentration', 1, k2, c2 FROM stated WHERE c2 IS NOT NULL
  UNION ALL SELECT rec_key, 'impurity_concentration', 1, k3, NULL FROM found WHERE len(n) = 0
  UNION ALL SELECT rec_key, 'impurity_concentration', pos, coalesce(nullif({_key('u')}, ''), k3), try_cast(n AS DOUBLE)
  FROM (SELECT rec_key, k3, unnest(n) AS n, unnest(u) AS u, generate_subscripts(n, 1) AS pos FROM found)
),
v AS (SELECT e.*, r.* FROM each e LEFT JOIN spelt USING (unit_key) LEFT JOIN ref_unit r USING (unit_label))"""
P3_FOUND = f"WITH {_UNITS} SELECT DISTINCT rec_key, field_name, unit_id FROM v WHERE per_million <> 1"
P3_PPM = f"""WITH {_UNITS} SELECT rec_key, field_name, CAST(value_pos AS INTEGER) AS value_pos, unit_key, unit_id, basis, per_million AS factor,
  number * per_million AS ppm FROM v"""
