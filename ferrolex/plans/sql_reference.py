"""SQL for the record, composition, feature, phase and fetch queries, written on its own for an independent engine."""

from __future__ import annotations

# Fixed values, written for this SQL on its own: standard atomic weights in the order of the atomic numbers 1 to 94.
_WEIGHTS = """
H 1.008 He 4.002602 Li 6.94 Be 9.0121831 B 10.81 C 12.011 N 14.007 O 15.999 F 18.998403163 Ne 20.1797 Na 22.98976928 Mg 24.305 Al 26.9815385
Si 28.085 P 30.973761998 S 32.06 Cl 35.45 Ar 39.948 K 39.0983 Ca 40.078 Sc 44.955908 Ti 47.867 V 50.9415 Cr 51.9961 Mn 54.938044 Fe 55.845
Co 58.933194 Ni 58.6934 Cu 63.546 Zn 65.38 Ga 69.723 Ge 72.63 As 74.921595 Se 78.971 Br 79.904 Kr 83.798 Rb 85.4678 Sr 87.62 Y 88.90584 Zr 91.224
Nb 92.90637 Mo 95.95 Tc 97.90721 Ru 101.07 Rh 102.9055 Pd 106.42 Ag 107.8682 Cd 112.414 In 114.818 Sn 118.71 Sb 121.76 Te 127.6 I 126.90447
Xe 131.293 Cs 132.90545196 Ba 137.327 La 138.90547 Ce 140.116 Pr 140.90766 Nd 144.242 Pm 144.91276 Sm 150.36 Eu 151.964 Gd 157.25 Tb 158.92535
Dy 162.5 Ho 164.93033 Er 167.259 Tm 168.93422 Yb 173.045 Lu 174.9668 Hf 178.49 Ta 180.94788 W 183.84 Re 186.207 Os 190.23 Ir 192.217 Pt 195.084
Au 196.966569 Hg 200.592 Tl 204.38 Pb 207.2 Bi 208.9804 Po 209 At 210 Rn 222 Fr 223 Ra 226 Ac 227 Th 232.0377 Pa 231.03588 U 238.02891 Np 237 Pu 244
""".split()
# Valence electrons; pair enthalpies in kJ/mol; unstable stacking fault energies in mJ/m2.
_VALENCE = "K 1 La 3 Y 3 Al 3 Hf 4 Ti 4 Zr 4 C 4 Si 4 Ta 5 Nb 5 V 5 N 5 W 6 Mo 6 Cr 6 O 6 Re 7 Fe 8 Co 9 Ni 10 Cu 11".split()
_ENTHALPIES = """
Co-Cu 6 Co-Fe -1 Co-Ni 0 Co-W -1 Cr-W 1 Cu-Fe 13 Cu-Ni 4 Cu-W 22 Fe-Ni -2 Fe-W 0 Mn-W 6 Mo-W 0 Nb-W -8 Ni-W -3 Re-Ta -24 Re-W -4 Ta-W -7 Ti-W -6 V-W -1 W-Zr -9
""".split()
_FAULTS = "Cr 1549 Fe 980 K 26 Li 71 Mo 1425 Na 48 Nb 674 Ta 725 Ti 190 V 713 W 1786".split()
PROPERTY_COLUMNS = ("metallic_radius", "melting_point", "density", "en_pauling", "lattice_constant", "structure")
# The columns above by element.
_METALS = """
Al 143 933.5 2.7 1.61 4.05 FCC|Co 125 1768 8.86 1.88 2.51 HEX|Cr 129 2180 7.15 1.66 2.88 BCC|Cu 128 1357.8 8.96 1.9 3.61 FCC|Fe 127 1811 7.87 1.83 2.87 BCC
Hf 160 2506 13.3 1.3 3.2 HEX|K 238 336.7 0.862 0.82 5.23 BCC|La 188 1193 6.15 1.1 3.75 HEX|Mn 137 1519 7.3 1.55 8.89 CUB|Mo 140 2896 10.2 2.16 3.15 BCC
Nb 147 2750 8.57 1.6 3.3 BCC|Ni 125 1728 8.9 1.91 3.52 FCC|Re 137 3459 20.8 1.9 2.76 HEX|Ru 134 2607 12.1 2.2 2.7 HEX|Si - 1687 2.33 1.9 5.43 DIA
Ta 147 3290 16.4 1.5 3.31 BCC|Ti 147 1941 4.506 1.54 2.95 HEX|V 135 2183 6.11 1.63 3.02 BCC|W 141 3695 19.3 2.36 3.16 BCC|Y 181 1795 4.47 1.22 3.65 HEX|Zr 160 2128 6.52 1.33 3.23 HEX
"""
FURTHER_COLUMNS = ("atomic_radius", "boiling_point", "fusion_heat", "thermal_conductivity", "en_allen", "electron_affinity")
# The columns above by element.
_MORE = """
Co 135 3200 15.5 100 1.84 0.662|Cr 140 2944 21 93.9 1.65 0.666|Cu 135 2835 13 401 1.85 1.236|Fe 140 3134 13.8 80.4 1.8 0.151|K 220 1032 2.33 102.5 0.734 0.501
Mo 145 4912 36 138 1.47 0.747|Nb 145 5017 26.8 53.7 1.41 0.917|Ni 135 3186 17.6 90.9 1.88 1.157|Re 135 5869 33.2 48 1.6 0.06|Ta 145 5731 36 57.5 1.34 0.329
Ti 140 3560 18.8 21.9 1.38 0.076|V 135 3680 17.5 30.7 1.53 0.525|W 135 5828 35.2 173 1.47 0.816|Zr 155 4682 19.2 22.7 1.32 0.433
"""


def _by_element(words: list[str]) -> list[tuple]:
    return [(a, float(b)) for a, b in zip(words[::2], words[1::2])]


def _table(text: str) -> list[tuple]:
    cell = lambda x: None if x == "-" else x if x.isalpha() else float(x)
    return [tuple(map(cell, row.split())) for row in text.replace("\n", "|").split("|") if row.strip()]


def _values(rows: list[tuple], columns: str) -> str:
    def lit(x: object) -> str:
        return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else f"CAST({x!r} AS DOUBLE)"

    return f"(VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS t({columns})"


AW = _values(_by_element(_WEIGHTS), "el, aw")
VECS = _values(_by_element(_VALENCE), "el, v")
USFES = _values(_by_element(_FAULTS), "el, u")
PAIRS = _values([(*k.split("-"), h) for k, h in _by_element(_ENTHALPIES)], "a, b, h")
PROPS = f"(SELECT * FROM {_values(_table(_METALS), f'el, {', '.join(PROPERTY_COLUMNS)}')} LEFT JOIN {_values(_table(_MORE), f'el, {', '.join(FURTHER_COLUMNS)}').replace('AS t(', 'AS m(')} USING (el)) AS q"

STRING = f"""
aw AS (SELECT * FROM {AW}),
tok AS (
  SELECT rec_key, composition_string AS cs, unnest(t) AS tok, generate_subscripts(t, 1) AS pos
  FROM (SELECT rec_key, composition_string, regexp_extract_all(composition_string, '[A-Z][a-z]?[0-9]*\\.?[0-9]*') AS t
        FROM w_dbtt WHERE composition_string <> '')
),
amt AS (
  SELECT rec_key, cs, tok, pos, regexp_extract(tok, '^[A-Z][a-z]?') AS el,
    CASE WHEN regexp_extract(tok, '[0-9]*\\.?[0-9]*$') = '' THEN 1.0 ELSE try_cast(regexp_extract(tok, '[0-9]*\\.?[0-9]*$') AS DOUBLE) END AS n
  FROM tok
),
ok AS (
  SELECT rec_key, sum(n) AS total FROM amt LEFT JOIN aw USING (el) GROUP BY rec_key
  HAVING string_agg(tok, '' ORDER BY pos) = any_value(cs) AND count(aw) = count(*) AND count(n) = count(*) AND sum(n) > 0
),
bystring AS (
  SELECT rec_key, el, min(pos) AS pos, sum(n / total) AS f FROM amt JOIN ok USING (rec_key) GROUP BY rec_key, el
)
"""
FIELDS = """
slot AS (
  SELECT rec_key, 1 AS s, dopant_or_alloying_element AS el, dopant_concentration AS c, dopant_concentration_unit AS u, composition_type AS ct FROM w_dbtt
  UNION ALL
  SELECT rec_key, 2, second_dopant_element, second_dopant_concentration, second_dopant_concentration_unit, composition_type FROM w_dbtt
),
use AS (
  SELECT rec_key, s, el, aw, CASE u WHEN 'at%' THEN 'at' ELSE 'wt' END AS kind, CASE u WHEN 'ppm' THEN c / 1e6 ELSE c / 100 END AS f
  FROM slot JOIN aw USING (el) WHERE ct IN ('doped', 'alloy') AND c IS NOT NULL AND u IN ('ppm', 'wt%', 'at%')
),
kinds AS (SELECT rec_key, bool_or(kind = 'wt') AS haswt FROM use GROUP BY rec_key),
turned AS (
  SELECT rec_key, haswt, el, aw, s + CASE WHEN kind = 'at' AND haswt THEN 10 ELSE 0 END AS o,
    CASE WHEN kind = 'at' AND haswt THEN f * aw / (f * aw + (1 - f) * 183.84) ELSE f END AS f
  FROM use JOIN kinds USING (rec_key)
),
last AS (SELECT rec_key, any_value(haswt) AS haswt, el, any_value(aw) AS aw, min(o) AS pos, arg_max(f, o) AS f FROM turned GROUP BY rec_key, el),
rest AS (SELECT rec_key, any_value(haswt) AS haswt, greatest(0, 1 - sum(f)) AS r, bool_or(el = 'W') AS hasw FROM last GROUP BY rec_key),
alle AS (
  SELECT l.rec_key, l.haswt, l.el, l.aw, l.pos, CASE WHEN l.el = 'W' THEN r.r ELSE l.f END AS f FROM last l JOIN rest r USING (rec_key)
  UNION ALL
  SELECT rec_key, haswt, 'W', 183.84, 99, r FROM rest WHERE NOT hasw
),
byfields AS (
  SELECT rec_key, el, pos, CASE WHEN haswt THEN (f / aw) / sum(f / aw) OVER (PARTITION BY rec_key) ELSE f END AS f FROM alle
  UNION ALL
  SELECT rec_key, 'W', 1, 1.0 FROM w_dbtt WHERE composition_type = 'pure'
)
"""
COMP = f"""WITH {STRING}, {FIELDS},
comp AS (
  SELECT rec_key, 'A_composition_string' AS format_used, el, pos, f FROM bystring
  UNION ALL
  SELECT b.rec_key, CASE WHEN w.composition_type = 'pure' THEN 'B_pure' ELSE 'B_discrete_fields' END, el, pos, f
  FROM byfields b JOIN w_dbtt w USING (rec_key) WHERE b.rec_key NOT IN (SELECT rec_key FROM ok)
),
rec AS (SELECT DISTINCT rec_key FROM comp)
"""


def r6(x: str) -> str:
    return f"round({x} + 1e-9, 6)"


def mean(c: str) -> str:
    return f"sum(f * p.{c}) FILTER (WHERE p.{c} IS NOT NULL) / nullif(sum(f) FILTER (WHERE p.{c} IS NOT NULL), 0)"


PROPS_AW = f"(SELECT aw.el, aw.aw AS atomic_weight, q.* EXCLUDE (el) FROM aw LEFT JOIN (SELECT * FROM {PROPS}) q USING (el))"
DELTA = f"""
means AS (SELECT rec_key, {mean('metallic_radius')} AS m FROM comp LEFT JOIN {PROPS_AW} p USING (el) GROUP BY rec_key),
delta AS (
  SELECT rec_key, CASE WHEN any_value(m) IS NOT NULL AND any_value(m) <> 0
    THEN 100 * sqrt(coalesce(sum(f * (1 - p.metallic_radius / m) * (1 - p.metallic_radius / m)), 0)) END AS delta
  FROM comp JOIN means USING (rec_key) LEFT JOIN {PROPS_AW} p USING (el) GROUP BY rec_key
)"""
ENTROPY = "entropy AS (SELECT rec_key, CASE WHEN count(*) > 1 THEN -8.314 * coalesce(sum(CASE WHEN f > 0 THEN f * ln(f) END), 0) ELSE 0.0 END AS entropy FROM comp GROUP BY rec_key)"
ENTHALPY = f"""pr AS (
  SELECT x.rec_key, h, x.f * y.f AS xy FROM comp x JOIN comp y ON x.rec_key = y.rec_key AND x.pos < y.pos
  LEFT JOIN (SELECT * FROM {PAIRS}) q ON q.a = least(x.el, y.el) AND q.b = greatest(x.el, y.el)
),
enthalpy AS (
  SELECT rec.rec_key, CASE WHEN count(xy) = 0 THEN 0.0 WHEN count(h) = count(xy) THEN sum(4 * h * xy) END AS enthalpy, CAST(count(xy) - count(h) AS INTEGER) AS n_missing
  FROM rec LEFT JOIN pr USING (rec_key) GROUP BY rec.rec_key
)"""
VECSQL = f"vecs AS (SELECT rec_key, CASE WHEN count(v) = count(*) THEN sum(f * v) END AS vec, coalesce(string_agg(CASE WHEN v IS NULL THEN el END, ',' ORDER BY pos), '') AS missing FROM comp LEFT JOIN (SELECT * FROM {VECS}) USING (el) GROUP BY rec_key)"
KEY = "keys AS (SELECT rec_key, coalesce(string_agg(el || CAST(CAST(printf('%.4f', f) AS DOUBLE) AS VARCHAR), '' ORDER BY el) FILTER (WHERE f >= 0.01), '') AS formula, count(*) FILTER (WHERE f >= 0.01) AS n, bool_or(el IN ('Ni', 'Co', 'Cu')) AS heavy FROM comp GROUP BY rec_key)"

DOCS = """
v AS (SELECT cache_id, cache_key, written_at, CAST(payload AS JSON) AS j FROM mp_cache WHERE json_valid(payload) AND cache_key IS NOT NULL),
b AS (
  SELECT cache_id, cache_key, written_at, CASE WHEN json_type(j) = 'ARRAY' THEN j WHEN json_type(j) = 'OBJECT' AND json_exists(j, '$.material_id') THEN json_array(j)
    WHEN json_type(j) = 'OBJECT' THEN json_extract(j, '$.data') END AS docs FROM v
),
newest AS (SELECT cache_key, docs FROM b WHERE docs IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cache_key ORDER BY written_at DESC, cache_id DESC) = 1),
doc AS (
  SELECT cache_key, CAST(e.key AS INTEGER) AS pos, e.value->>'$.material_id' AS material_id, e.value->>'$.formula_pretty' AS formula,
    CAST(e.value->>'$.energy_above_hull' AS DOUBLE) AS e_hull, CAST(e.value->>'$.is_stable' AS BOOLEAN) AS is_stable,
    e.value->>'$.symmetry.crystal_system' AS crystal_system, e.value->>'$.symmetry.symbol' AS spacegroup,
    CAST(e.value->>'$.formation_energy_per_atom' AS DOUBLE) AS formation,
    CAST(e.value->>'$.bulk_modulus.vrh' AS DOUBLE) AS bulk, CAST(e.value->>'$.shear_modulus.vrh' AS DOUBLE) AS shear
  FROM newest, json_each(newest.docs) e
)
"""


ALL_DOCS = """
v AS (SELECT cache_id, CAST(payload AS JSON) AS j FROM mp_cache WHERE json_valid(payload)),
b AS (
  SELECT cache_id, CASE WHEN json_type(j) = 'ARRAY' THEN j WHEN json_type(j) = 'OBJECT' AND json_exists(j, '$.material_id') THEN json_array(j)
    WHEN json_type(j) = 'OBJECT' THEN json_extract(j, '$.data') END AS docs FROM v
),
doc AS (SELECT cache_id, CAST(e.key AS INTEGER) AS doc_pos, e.value AS d FROM b, json_each(b.docs) e WHERE b.docs IS NOT NULL)
"""


def chosen(keyed: str, n: str, by: str) -> str:
    """Phase selection by rank over documents joined with a count of elements."""
    return f"""
k AS (SELECT {by}, {n} AS n, d.* FROM {keyed}),
t AS (
  SELECT *, coalesce(e_hull, 1e6) AS eh, bool_or(coalesce(e_hull, 1e6) <= 0.1) OVER (PARTITION BY {by}) AS near,
    bool_or(n = 1 AND abs(coalesce(e_hull, 1e6)) <= 1e-6) OVER (PARTITION BY {by}) AS gs FROM k
),
best AS (
  SELECT *, coalesce(crystal_system = 'Cubic', FALSE) AS cubic FROM t
  QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY
    CASE WHEN gs THEN abs(eh) > 1e-6 ELSE near AND eh > 0.1 END,
    CASE WHEN gs THEN NOT coalesce(is_stable, FALSE) ELSE NOT coalesce(crystal_system = 'Cubic', FALSE) END, CASE WHEN gs THEN 0 ELSE eh END, pos) = 1
)"""


N_ELEMENTS = "length(regexp_replace(d.cache_key, '[^A-Z]', '', 'g'))"
SELECT_PHASE = f"""WITH {DOCS}, {chosen("doc d", N_ELEMENTS, "cache_key")}
SELECT cache_key, material_id, gs OR near AS all_phases_found, NOT gs AND NOT cubic AS bcc_assumption FROM best"""
PHASE_LOOKUP = f"""{COMP}, {KEY}, {DOCS}, {chosen("keys JOIN doc d ON d.cache_key = keys.formula AND NOT heavy AND keys.n > 0", "keys.n", "rec_key")}
SELECT keys.rec_key, best.material_id AS mp_material_id, CASE WHEN best.rec_key IS NULL AND newest.cache_key IS NOT NULL AND keys.n > 0 THEN keys.formula ELSE best.formula END AS mp_formula,
  best.crystal_system AS mp_crystal_system, best.is_stable AS mp_is_stable, CASE WHEN best.rec_key IS NULL AND newest.cache_key IS NOT NULL AND keys.n > 0 THEN FALSE ELSE gs OR near END AS mp_all_phases_found,
  CASE WHEN heavy THEN 'heavy alloy: not looked up' WHEN keys.n = 0 THEN 'all elements are below the trace limit'
    WHEN newest.cache_key IS NULL THEN 'no answer in the cache' WHEN best.rec_key IS NULL THEN 'no matching entries' END AS mp_query_skipped
FROM keys LEFT JOIN best USING (rec_key) LEFT JOIN newest ON newest.cache_key = keys.formula AND NOT heavy"""

MANUAL = "manual AS (SELECT paper_doi AS doi, min(doc_id) AS ord FROM documents WHERE paper_doi IS NOT NULL GROUP BY paper_doi)"
WORK = f"""{MANUAL},
work AS (
  SELECT doi, 0 AS source, fetch_id AS ord FROM fetch_log WHERE status IN ('full_text', 'pdf_downloaded')
  UNION ALL SELECT doi, 1, ord FROM manual
),
firsts AS (SELECT doi, source, ord FROM work WHERE doi IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doi ORDER BY source, ord) = 1)"""
LAST_CLASS = "lastc AS (SELECT extraction_id, figure_id, arg_max(figure_type, figure_key) FILTER (WHERE TRUE) AS ft0, max(figure_key) AS k FROM extraction_figure WHERE figure_id IS NOT NULL GROUP BY ALL), last AS (SELECT l.extraction_id, l.figure_id, e.figure_type FROM lastc l JOIN extraction_figure e ON e.figure_key = l.k)"


WARN = """warn AS (
  SELECT rec_key, 1 AS o, 'cannot read ' || composition_string AS warning FROM w_dbtt WHERE composition_string <> '' AND rec_key NOT IN (SELECT rec_key FROM ok)
  UNION ALL
  SELECT rec_key, 1 + s, 'no usable amount of ' || el FROM slot WHERE ct IN ('doped', 'alloy') AND el <> '' AND (c IS NULL OR u IS NULL OR u NOT IN ('ppm', 'wt%', 'at%'))
    AND rec_key NOT IN (SELECT rec_key FROM ok)
  UNION ALL
  SELECT rec_key, 4 + s, 'no element ' || el FROM slot WHERE ct IN ('doped', 'alloy') AND el <> '' AND c IS NOT NULL AND u IN ('ppm', 'wt%', 'at%') AND el NOT IN (SELECT el FROM aw)
    AND rec_key NOT IN (SELECT rec_key FROM ok)
  UNION ALL
  SELECT rec_key, 7, 'mixed units of dopants' FROM use WHERE rec_key NOT IN (SELECT rec_key FROM ok) GROUP BY rec_key HAVING count(DISTINCT kind) = 2
  UNION ALL
  SELECT rec_key, 8, 'dopants exceed the whole' FROM last WHERE rec_key NOT IN (SELECT rec_key FROM ok) GROUP BY rec_key HAVING sum(f) > 1
)"""
# The names of the means and the property each is of.
MEANS = {
    "mendeleev_atomic_radius_pm_weighted": "atomic_radius", "mendeleev_metallic_radius_pm_weighted": "metallic_radius", "mendeleev_atomic_weight_weighted": "atomic_weight",
    "mendeleev_melting_point_k_weighted": "melting_point", "mendeleev_density_g_cm3_weighted": "density", "mendeleev_electronegativity_weighted": "en_pauling",
    "mean_boiling_point_k": "boiling_point", "mean_fusion_heat_kj_mol": "fusion_heat", "mean_thermal_conductivity_w_mk": "thermal_conductivity",
    "mean_en_allen": "en_allen", "mean_electron_affinity_ev": "electron_affinity",
}
LATTICE = f"l AS (SELECT el, CASE WHEN structure = 'BCC' THEN lattice_constant ELSE 4 / sqrt(3) * metallic_radius / 100 END AS a FROM {PROPS})"
_EMPTY = "best.rec_key IS NULL AND newest.cache_key IS NOT NULL AND NOT heavy AND keys.n > 0"
FEATURES = f"""{COMP}, {KEY}, {DOCS}, {chosen("keys JOIN doc d ON d.cache_key = keys.formula AND NOT heavy AND keys.n > 0", "keys.n", "rec_key")},
{VECSQL}, {DELTA}, {ENTROPY}, {ENTHALPY}, {LATTICE},
m AS (SELECT rec_key, {', '.join(f"{mean(c)} AS {n}" for n, c in MEANS.items())} FROM comp LEFT JOIN {PROPS_AW} p USING (el) GROUP BY rec_key),
bcc AS (SELECT rec_key, sum(f * a) / nullif(sum(f) FILTER (WHERE a IS NOT NULL), 0) AS a FROM comp LEFT JOIN l USING (el) GROUP BY rec_key),
us AS (SELECT rec_key, CASE WHEN NOT bool_or(u IS NULL AND f > 0.01) THEN sum(f * u) / nullif(sum(f) FILTER (WHERE u IS NOT NULL), 0) END AS usfe FROM comp LEFT JOIN (SELECT * FROM {USFES}) USING (el) GROUP BY rec_key),
fu AS (SELECT DISTINCT rec_key, format_used FROM comp)
SELECT w.rec_key, fu.format_used, CASE WHEN heavy THEN 'W_heavy_alloy_no_DBTT' END AS dataset_scope_flag, {', '.join(f"{r6(f'm.{n}')} AS {n}" for n in MEANS)},
  {r6('bcc.a')} AS mendeleev_a_bcc_equiv_angstrom, {r6('coalesce(v.vec, w.vec)')} AS vec, {r6('coalesce(s.entropy, w.delta_s_mix_j_mol_k)')} AS delta_s_mix_j_mol_k,
  {r6('coalesce(d.delta, w.delta_atomic_size)')} AS delta_atomic_size, {r6('coalesce(h.enthalpy, w.delta_h_mix_kj_mol)')} AS delta_h_mix_kj_mol, {r6('us.usfe')} AS usfe_linear_mixture_mj_m2,
  best.material_id AS mp_material_id, CASE WHEN {_EMPTY} THEN keys.formula ELSE best.formula END AS mp_formula, {r6('best.bulk')} AS mp_bulk_modulus_gpa, {r6('best.shear')} AS mp_shear_modulus_gpa,
  {r6('best.formation')} AS mp_formation_energy_ev_atom, {r6('best.e_hull')} AS mp_energy_above_hull_ev_atom, best.crystal_system AS mp_crystal_system, best.spacegroup AS mp_spacegroup_symbol,
  best.is_stable AS mp_is_stable, NOT gs AND NOT cubic AS mp_bcc_assumption_applied, CASE WHEN {_EMPTY} THEN FALSE ELSE gs OR near END AS mp_all_phases_found,
  CASE WHEN keys.rec_key IS NULL THEN NULL WHEN heavy THEN 'heavy alloy: not looked up' WHEN keys.n = 0 THEN 'all elements are below the trace limit'
    WHEN newest.cache_key IS NULL THEN 'no answer in the cache' WHEN best.rec_key IS NULL THEN 'no matching entries' END AS mp_query_skipped
FROM w_dbtt w LEFT JOIN fu USING (rec_key) LEFT JOIN keys USING (rec_key) LEFT JOIN m USING (rec_key) LEFT JOIN bcc USING (rec_key) LEFT JOIN vecs v USING (rec_key) LEFT JOIN delta d USING (rec_key)
LEFT JOIN entropy s USING (rec_key) LEFT JOIN enthalpy h USING (rec_key) LEFT JOIN us USING (rec_key) LEFT JOIN best USING (rec_key) LEFT JOIN newest ON newest.cache_key = keys.formula"""
_STEP = "trim(step)"


def _number(pattern: str) -> str:
    return f"try_cast(nullif(regexp_extract({_STEP}, '{pattern}', 1), '') AS DOUBLE)"


HISTORY = f"""SELECT rec_key, CAST(pos - 1 AS INTEGER) AS pos, nullif(regexp_extract({_STEP}, '^([a-z][a-z_]+)', 1), '') AS method,
  coalesce({_number('([0-9]+(?:[.][0-9]+)?) ?K\\b')}, {_number('([0-9]+(?:[.][0-9]+)?) ?°?C\\b')} + 273.15) AS temperature_k,
  {_number('([0-9]+(?:[.][0-9]+)?) ?%')} AS reduction_pct, {_number('([0-9]+)_pass')} AS passes
FROM (SELECT rec_key, unnest(s) AS step, generate_subscripts(s, 1) AS pos FROM (SELECT rec_key, string_split(processing_history, ';') AS s FROM w_dbtt WHERE processing_history IS NOT NULL))"""


def oracle_sql() -> dict[str, str]:
    out = {
        "scan_records": "SELECT w.rec_key, w.extraction_id, e.doi FROM w_dbtt w JOIN extraction e USING (extraction_id) WHERE e.failure IS NULL",
        "composition_parse": f"WITH {STRING} SELECT rec_key, el, {r6('f')} AS frac FROM bystring",
        "discrete_composition": f"WITH {STRING}, {FIELDS} SELECT rec_key, el, {r6('f')} AS frac FROM byfields",
        "compositions": f"{COMP} SELECT rec_key, format_used, el, {r6('f')} AS frac FROM comp",
        "composition_formats": f"{COMP}, u AS (SELECT DISTINCT rec_key, format_used FROM comp) SELECT coalesce(format_used, 'none') AS format_used, count(*) AS n FROM w_dbtt LEFT JOIN u USING (rec_key) GROUP BY 1",
        "dopant_units": f"SELECT rec_key, CASE WHEN dopant_concentration_unit IN ('ppm', 'wt%') THEN 'wt' WHEN dopant_concentration_unit = 'at%' THEN 'at' END AS kind, {r6("CASE dopant_concentration_unit WHEN 'ppm' THEN dopant_concentration / 1e6 WHEN 'wt%' THEN dopant_concentration / 100 WHEN 'at%' THEN dopant_concentration / 100 END")} AS f FROM w_dbtt",
        "formats_compared": f"WITH {STRING}, {FIELDS} SELECT a.rec_key, {r6('a.f')} AS by_string, {r6('b.f')} AS by_fields FROM bystring a JOIN byfields b ON a.rec_key = b.rec_key AND a.el = 'W' AND b.el = 'W'",
        "fractions_wide": f"{COMP} SELECT rec_key, " + ", ".join(f"{r6(f"sum(f) FILTER (WHERE el = '{e}')")} AS frac_{e.lower()}" for e in ("W", "Re", "Ta", "Mo", "Ni", "Fe", "Cu", "K")) + " FROM comp GROUP BY rec_key",
        "collected_elements": f"{COMP} SELECT DISTINCT el FROM comp",
        "element_cache": f"{COMP}, n AS (SELECT el, aw, row_number() OVER () AS z FROM (SELECT * FROM {AW})) SELECT el AS symbol, CAST(z AS INTEGER) AS atomic_number, aw AS atomic_weight FROM n WHERE el IN ('W', 'Re', 'Ta') OR el IN (SELECT el FROM comp)",
        "fraction_features_by_join": f"{COMP} SELECT rec_key, {r6(mean('metallic_radius'))} AS metallic_radius, {r6(mean('melting_point'))} AS melting_point FROM comp LEFT JOIN {PROPS_AW} p USING (el) GROUP BY rec_key",
        "weighted_means": f"{COMP} SELECT rec_key, " + ", ".join(f"{r6(mean(c))} AS {c}" for c in MEANS.values()) + f" FROM comp LEFT JOIN {PROPS_AW} p USING (el) GROUP BY rec_key",
        "vec": f"{COMP}, {VECSQL} SELECT rec_key, {r6('vec')} AS vec, missing FROM vecs",
        "size_mismatch": f"{COMP}, {DELTA} SELECT rec_key, {r6('delta')} AS delta FROM delta",
        "mixing_entropy": f"{COMP}, {ENTROPY} SELECT rec_key, {r6('entropy')} AS entropy FROM entropy",
        "mixing_enthalpy": f"{COMP}, {ENTHALPY} SELECT rec_key, {r6('enthalpy')} AS enthalpy, n_missing FROM enthalpy",
        "bcc_lattice": f"{COMP}, {LATTICE} SELECT rec_key, {r6('sum(f * a) / nullif(sum(f) FILTER (WHERE a IS NOT NULL), 0)')} AS lattice FROM comp LEFT JOIN l USING (el) GROUP BY rec_key",
        "usfe_guarded": f"{COMP} SELECT rec_key, {r6("CASE WHEN NOT bool_or(u IS NULL AND f > 0.01) THEN sum(f * u) / nullif(sum(f) FILTER (WHERE u IS NOT NULL), 0) END")} AS usfe, coalesce(string_agg(CASE WHEN u IS NULL THEN el END, ',' ORDER BY el), '') AS missing FROM comp LEFT JOIN (SELECT * FROM {USFES}) USING (el) GROUP BY rec_key",
        "heavy_alloy_flag": f"{COMP}, {KEY} SELECT rec_key, CASE WHEN heavy THEN 'W_heavy_alloy_no_DBTT' END AS flag FROM keys",
        "formula_key": f"{COMP}, {KEY} SELECT rec_key, formula, formula || '.json' AS path FROM keys",
        "overwritten": f"{COMP}, {VECSQL}, {DELTA}, {ENTROPY}, {ENTHALPY} SELECT w.rec_key, {r6('coalesce(v.vec, w.vec)')} AS vec, {r6('coalesce(s.entropy, w.delta_s_mix_j_mol_k)')} AS delta_s_mix_j_mol_k, {r6('coalesce(d.delta, w.delta_atomic_size)')} AS delta_atomic_size, {r6('coalesce(h.enthalpy, w.delta_h_mix_kj_mol)')} AS delta_h_mix_kj_mol, CAST((v.vec IS NOT NULL)::INT + (s.entropy IS NOT NULL)::INT + (d.delta IS NOT NULL)::INT + (h.enthalpy IS NOT NULL)::INT AS INTEGER) AS n_overwritten FROM w_dbtt w LEFT JOIN vecs v USING (rec_key) LEFT JOIN delta d USING (rec_key) LEFT JOIN entropy s USING (rec_key) LEFT JOIN enthalpy h USING (rec_key)",
        "record_labels": "SELECT rec_key, coalesce(nullif(record_id, ''), nullif(material_name, ''), 'unknown') AS label FROM w_dbtt",
        "phase_cache": f"WITH {DOCS} SELECT cache_key, CAST(json_array_length(docs) AS BIGINT) AS n_docs FROM newest",
        "select_phase": SELECT_PHASE,
        "select_phase_window": SELECT_PHASE,
        "phase_lookup": PHASE_LOOKUP,
        "phase_off": f"{COMP}, {KEY} SELECT rec_key, CAST(NULL AS VARCHAR) AS mp_material_id, CASE WHEN heavy THEN 'heavy alloy: not looked up' ELSE 'phase lookup is switched off' END AS mp_query_skipped FROM keys",
        "phase_empty": "SELECT cache_id, CAST(NULL AS VARCHAR) AS mp_material_id, CAST(NULL AS BOOLEAN) AS mp_is_stable, 'no client' AS mp_query_skipped FROM mp_cache",
        "phase_projection": f"WITH {DOCS} SELECT cache_key, pos, material_id, crystal_system, spacegroup, {r6('bulk')} AS bulk, {r6('shear')} AS shear FROM doc",
        "chemical_systems": f"{COMP}, s AS (SELECT rec_key, string_agg(el, '-' ORDER BY el) AS chemsys FROM comp GROUP BY rec_key) SELECT chemsys, count(*) AS n FROM s GROUP BY chemsys",
        "pending_dois": f"WITH {WORK} SELECT doi, source, ord FROM firsts WHERE translate(doi, '/.', '_-') NOT IN (SELECT translate(doi, '/.', '_-') FROM extraction WHERE failure IS NULL AND input_format = 'xml' AND doi IS NOT NULL)",
        "work_union": f"WITH {WORK} SELECT source, count(*) AS n FROM work GROUP BY source",
        "first_wins": f"WITH {WORK} SELECT doi, source, ord FROM firsts",
        "first_wins_rank": f"WITH {WORK} SELECT doi, source, ord FROM firsts",
        "fetch_routes": "SELECT fetch_id, translate(doi, '/.', '_-') AS slug, starts_with(trim(doi), '10.1016/') AS own_route, CASE status WHEN 'full_text' THEN translate(doi, '/.', '_-') || '.xml' WHEN 'abstract_only' THEN translate(doi, '/.', '_-') || '_abstract_only.xml' WHEN 'pdf_downloaded' THEN translate(doi, '/.', '_-') || '.pdf' END AS path, substr(message, 1, 500) AS message FROM fetch_log",
        "response_classes": "WITH a AS (SELECT doc_id, [200, 200, 403, 404, 429, 500][doc_id % 6 + 1] AS code, CASE WHEN doc_id % 4 = 0 THEN '<ce:sections>' || text ELSE text END AS body FROM documents) SELECT doc_id, CASE WHEN code = 200 AND (contains(body, '<xocs:rawtext>') OR contains(body, '<ce:sections>') OR contains(lower(body), '<body>')) THEN 'full_text' WHEN code = 200 THEN 'abstract_only' ELSE 'error' END AS status, CASE code WHEN 200 THEN NULL WHEN 403 THEN 'access denied' WHEN 404 THEN 'not found' WHEN 429 THEN 'rate limited' ELSE 'status ' || code END AS message FROM a",
        "open_access_classes": "WITH a AS (SELECT fetch_id, CASE WHEN fetch_id % 5 = 0 THEN 404 ELSE 200 END AS code, CASE WHEN fetch_id % 7 = 0 THEN 500 ELSE 200 END AS pdf, coalesce(nullif(filename, ''), CASE WHEN fetch_id % 3 = 0 THEN nullif(doi, '') END) AS url FROM fetch_log) SELECT fetch_id, CASE WHEN code <> 200 THEN 'error' WHEN url IS NULL THEN 'no_oa_pdf' WHEN pdf <> 200 THEN 'error' ELSE 'pdf_downloaded' END AS status, url FROM a",
        "status_counts": "SELECT count(*) AS n_total, count(*) FILTER (WHERE status = 'full_text') AS n_full_text, count(*) FILTER (WHERE status = 'abstract_only') AS n_abstract_only, count(*) FILTER (WHERE status = 'error') AS n_error, count(*) FILTER (WHERE status IS NULL OR status NOT IN ('full_text', 'abstract_only', 'error')) AS n_other FROM fetch_log",
        "latest_status": "SELECT doi, status FROM fetch_log WHERE doi IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doi ORDER BY fetched_at DESC NULLS LAST, fetch_id DESC) = 1",
        "input_formats": "WITH p AS (SELECT DISTINCT doi, translate(doi, '/.', '_-') AS s FROM extraction WHERE doi IS NOT NULL) SELECT doi, CASE WHEN s || '.xml' IN (SELECT filename FROM fetch_log WHERE filename IS NOT NULL) THEN 'xml' WHEN s || '.pdf' IN (SELECT filename FROM fetch_log WHERE filename IS NOT NULL) THEN 'pdf' END AS input_format FROM p",
        "extraction_totals": "WITH n AS (SELECT extraction_id, count(*) AS n FROM w_dbtt WHERE extraction_id IS NOT NULL GROUP BY extraction_id) SELECT count(*) AS n_runs, count(failure) AS n_failed, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_records, coalesce(max(n), 0) AS most_records FROM extraction LEFT JOIN n USING (extraction_id)",
        "runs_without_records": "SELECT extraction_id, failure FROM extraction e WHERE NOT EXISTS (SELECT 1 FROM w_dbtt w WHERE w.extraction_id = e.extraction_id)",
        "kept_figures": f"WITH {LAST_CLASS} SELECT figure_key, f.extraction_id, f.figure_id FROM extraction_figure f JOIN last l ON f.extraction_id = l.extraction_id AND f.figure_id = l.figure_id AND l.figure_type = 'EBSD'",
        "figure_classes": f"WITH {LAST_CLASS} SELECT extraction_id, figure_id, figure_type FROM last",
        "kept_counts": f"WITH {LAST_CLASS} SELECT extraction_id, count(*) FILTER (WHERE figure_type = 'EBSD') AS n_kept, count(*) AS n_total FROM last GROUP BY extraction_id",
        "figure_filter": "SELECT figure_key, starts_with(figure_id, 'gr') AS is_main FROM extraction_figure WHERE coalesce(figure_id, '') <> '' AND NOT regexp_matches(figure_id, '^(si|ga)') AND NOT contains(lower(coalesce(figure_type, '') || 'f/' || coalesce(description, '')), 'svg')",
        "figure_paths": "SELECT figure_key, 'figures/' || translate(doi, '/.', '_-') || '/' || translate(doi, '/.', '_-') || '_' || figure_id || CASE WHEN contains_data THEN '.png' ELSE '.jpg' END AS path, CASE WHEN contains_data THEN 'image/png' ELSE 'image/jpeg' END AS mime FROM extraction_figure WHERE figure_id IS NOT NULL AND doi IS NOT NULL",
        "figure_urls": "WITH o AS (SELECT doi, figure_id AS ref, figure_key % 3 AS c, max(figure_key) AS k FROM extraction_figure WHERE coalesce(figure_id, '') <> '' AND NOT regexp_matches(figure_id, '^(si|ga)') GROUP BY ALL) SELECT doi, ref, 'u' || arg_max(k, c) AS url, count(*) AS n_urls FROM o GROUP BY doi, ref",
        "note_tags": "SELECT rec_key, unnest(regexp_extract_all(notes, '\\[([a-z_]+)\\]', 1)) AS tag FROM w_dbtt WHERE notes IS NOT NULL",
        "tag_counts": "SELECT tag, count(*) AS n FROM (SELECT unnest(regexp_extract_all(notes, '\\[([a-z_]+)\\]', 1)) AS tag FROM w_dbtt WHERE notes IS NOT NULL) GROUP BY tag",
        "provenance": "SELECT rec_key, CAST(i AS INTEGER) AS pos, data_from_reference[i] AS reference, reference_titles[i] AS title FROM w_dbtt, unnest(generate_series(1, greatest(coalesce(len(data_from_reference), 0), coalesce(len(reference_titles), 0)))) AS g(i)",
        "domain_rules": f"SELECT rec_key, {r6('deformation_temperature_k + 273.15')} AS kelvin, {r6('(dbtt_lower_k + dbtt_upper_k) / 2')} AS midpoint, {r6('(dbtt_upper_k - dbtt_lower_k) / 2')} AS half_width, {r6('CASE WHEN degree_of_cold_rolling / 100 < 1 THEN -ln(1 - degree_of_cold_rolling / 100) END')} AS log_strain, pre_existing_dislocation_density_m2 * 1e4 AS density, {r6('1 / nullif(grain_size_l_um, 0) + 1 / nullif(grain_size_t_um, 0) + 1 / nullif(grain_size_s_um, 0)')} AS boundary_area FROM w_dbtt",
        "composition_classes": "WITH x AS (SELECT rec_key, base_material_purity_pct AS p, CASE WHEN dopant_concentration_unit = 'wt%' THEN dopant_concentration WHEN dopant_or_alloying_element IS NULL THEN 0 END AS w FROM w_dbtt) SELECT rec_key, CASE WHEN coalesce(w, 0) = 0 AND p >= 99.9 THEN 'pure' WHEN w < 1 THEN 'doped' WHEN w >= 1 THEN 'alloy' END AS class FROM x",
        "enumerations": "SELECT rec_key, 'composition_type' AS field_name FROM w_dbtt WHERE composition_type NOT IN ('pure', 'doped', 'alloy') UNION ALL SELECT rec_key, 'dopant_concentration_unit' FROM w_dbtt WHERE dopant_concentration_unit NOT IN ('ppm', 'wt%', 'at%') UNION ALL SELECT rec_key, 'grain_size_estimated_dimensions' FROM w_dbtt WHERE grain_size_estimated_dimensions NOT IN ('full_3D', 'two_directions', 'single_direction_only')",
        "stable_top": f"WITH {ALL_DOCS} SELECT cache_id, doc_pos, d->>'$.material_id' AS material_id, CAST(d->>'$.energy_above_hull' AS DOUBLE) AS e_hull FROM doc WHERE CAST(d->>'$.energy_above_hull' AS DOUBLE) <= 0.1 ORDER BY e_hull, cache_id, doc_pos LIMIT 50",
        "record_summary": "WITH p AS (SELECT rec_key, coalesce(nullif(record_id, ''), '?') AS r, coalesce(nullif(material_name, ''), '?') AS m, coalesce(CAST(dbtt_k AS VARCHAR), 'None') AS t, coalesce(CAST(grain_size_l_um AS VARCHAR), 'None') AS g FROM w_dbtt) SELECT rec_key, '  ' || CASE WHEN length(r) < 10 THEN rpad(r, 10, ' ') ELSE r END || '  ' || CASE WHEN length(m) < 20 THEN rpad(m, 20, ' ') ELSE m END || '  DBTT=' || t || 'K  grain_L=' || g || 'µm' AS line FROM p",
        "figure_summary": "WITH p AS (SELECT figure_key, coalesce(figure_id, '?') AS i, coalesce(figure_type, '?') AS t, coalesce(description, '') AS x, contains_data AS c FROM extraction_figure) SELECT figure_key, '  ' || CASE WHEN length(i) < 8 THEN rpad(i, 8, ' ') ELSE i END || '  ' || CASE WHEN length(t) < 18 THEN rpad(t, 18, ' ') ELSE t END || '  ' || CASE WHEN c THEN '[DATA]' ELSE '      ' END || '  ' || substr(x, 1, 60) AS line FROM p",
        "figure_order": "SELECT extraction_id, array_to_string(list_sort(list(DISTINCT figure_id)), ',') AS refs FROM extraction_figure WHERE extraction_id IS NOT NULL AND starts_with(figure_id, 'gr') GROUP BY extraction_id",
        "formula_strings": f"{COMP} SELECT rec_key, string_agg(el || coalesce(nullif(regexp_replace(CAST(CAST(f AS DECIMAL(18, 12)) AS VARCHAR), '[.]?0+$', ''), ''), '0'), '' ORDER BY pos) AS formula FROM comp GROUP BY rec_key",
        "supplement_files": "WITH p AS (SELECT DISTINCT doi, translate(doi, '/.', '_-') AS s FROM fetch_log WHERE doi IS NOT NULL), n AS (SELECT DISTINCT translate(doi, '/.', '_-') AS s, translate(doi, '/.', '_-') || '_mmc' || (fetch_id % 2 + 1) || '.docx' AS filename FROM fetch_log WHERE doi IS NOT NULL AND fetch_id % 3 = 0) SELECT doi, filename FROM p JOIN n USING (s) UNION ALL SELECT doi, filename FROM p, (VALUES ('mmc1.docx'), ('mmc2.docx')) AS g(filename) WHERE s NOT IN (SELECT s FROM n)",
        "enrich_summary": f"""{COMP}, {KEY}, {DOCS}, {chosen("keys JOIN doc d ON d.cache_key = keys.formula AND NOT heavy AND keys.n > 0", "keys.n", "rec_key")},
u AS (SELECT rec_key, CASE WHEN NOT bool_or(u IS NULL AND f > 0.01) THEN sum(f * u) / nullif(sum(f) FILTER (WHERE u IS NOT NULL), 0) END AS usfe FROM comp LEFT JOIN (SELECT * FROM {USFES}) USING (el) GROUP BY rec_key),
fu AS (SELECT DISTINCT rec_key, format_used FROM comp)
SELECT coalesce(format_used, 'none') AS format_used, CASE WHEN heavy THEN 'W_heavy_alloy_no_DBTT' ELSE 'none' END AS scope, count(*) AS n, count(best.material_id) AS n_phases, {r6('sum(usfe) / 1e3')} AS usfe_sum
FROM w_dbtt LEFT JOIN fu USING (rec_key) LEFT JOIN keys USING (rec_key) LEFT JOIN best USING (rec_key) LEFT JOIN u USING (rec_key) GROUP BY ALL""",
        "element_attributes": f"WITH w AS (SELECT * FROM {PROPS} WHERE el = 'W') SELECT attribute, value FROM (VALUES ('atomic_number', '74'), ('lattice_structure', 'BCC'), ('vec', '6'), ('atomic_weight', '183.84'), ('atomic_radius', (SELECT CAST(atomic_radius AS VARCHAR) FROM w)), ('metallic_radius', (SELECT CAST(metallic_radius AS VARCHAR) FROM w)), ('covalent_radius', NULL), ('melting_point', (SELECT CAST(melting_point AS VARCHAR) FROM w)), ('boiling_point', (SELECT CAST(boiling_point AS VARCHAR) FROM w)), ('density', (SELECT CAST(density AS VARCHAR) FROM w)), ('lattice_constant', (SELECT CAST(lattice_constant AS VARCHAR) FROM w)), ('en_pauling', (SELECT CAST(en_pauling AS VARCHAR) FROM w)), ('en_allen', (SELECT CAST(en_allen AS VARCHAR) FROM w)), ('fusion_heat', (SELECT CAST(fusion_heat AS VARCHAR) FROM w)), ('thermal_conductivity', (SELECT CAST(thermal_conductivity AS VARCHAR) FROM w)), ('electron_affinity', (SELECT CAST(electron_affinity AS VARCHAR) FROM w))) AS t(attribute, value)",
        "json_props": "WITH e AS (SELECT event_type, CAST(props->>'$.k' AS BIGINT) AS k FROM events) SELECT event_type, count(*) AS n, CAST(sum(k) AS BIGINT) AS k_sum, min(k) AS k_min, max(k) AS k_max FROM e GROUP BY event_type",
        "supplement_concat": "WITH s AS (SELECT extraction_id, string_agg(coalesce(description, ''), chr(10) ORDER BY figure_key) AS t FROM extraction_figure WHERE extraction_id IS NOT NULL GROUP BY extraction_id) SELECT extraction_id, md5(t) AS text_md5, length(t) AS n_chars FROM s",
        "enriched_features": FEATURES,
        "composition_warnings": f"{COMP}, {WARN} SELECT rec_key, warning FROM warn",
        "feature_log": f"""{COMP}, {WARN}, fu AS (SELECT DISTINCT rec_key, format_used FROM comp),
lines AS (
  SELECT rec_key, 0 AS o, CASE WHEN format_used IS NULL THEN 'WARN' ELSE 'INFO' END AS level, coalesce('composition by ' || format_used, 'no composition') AS t FROM w_dbtt LEFT JOIN fu USING (rec_key)
  UNION ALL SELECT rec_key, o, 'WARN', warning FROM warn
)
SELECT rec_key, CAST(row_number() OVER (PARTITION BY rec_key ORDER BY o) AS INTEGER) AS seq, level, coalesce(nullif(record_id, ''), nullif(material_name, ''), 'unknown') || ' ' || t AS message
FROM lines JOIN w_dbtt USING (rec_key)""",
        "history_steps": HISTORY,
        "phase_misses": f"{COMP}, {KEY}, {DOCS}, s AS (SELECT rec_key, string_agg(el, '-' ORDER BY el) FILTER (WHERE f >= 0.01) AS chemsys FROM comp GROUP BY rec_key) SELECT DISTINCT formula AS cache_key, chemsys FROM keys JOIN s USING (rec_key) WHERE NOT heavy AND n > 0 AND formula NOT IN (SELECT cache_key FROM newest)",
        "fetch_log_file": "SELECT CAST(row_number() OVER (ORDER BY fetch_id) - 1 AS INTEGER) AS pos, doi, status, filename, message FROM fetch_log",
        "phase_cache_files": "SELECT replace(cache_key, '/', '_') AS cache_key, md5(payload) AS payload_md5 FROM mp_cache WHERE cache_key IS NOT NULL AND json_valid(payload) QUALIFY row_number() OVER (PARTITION BY cache_key ORDER BY written_at DESC NULLS LAST, cache_id DESC) = 1",
        "envelope_files": "SELECT extraction_id || '_extraction.json' AS source_file, CAST(row_number() OVER (PARTITION BY extraction_id ORDER BY rec_key) - 1 AS INTEGER) AS pos, record_id, vec, CAST(len(reference_titles) AS INTEGER) AS n_titles FROM w_dbtt WHERE extraction_id IS NOT NULL",
        "features_file": f"{COMP}, {VECSQL}, {ENTROPY} SELECT w.rec_key, coalesce(nullif(record_id, ''), nullif(material_name, ''), 'unknown') AS label, {r6('coalesce(v.vec, w.vec)')} AS vec, {r6('coalesce(s.entropy, w.delta_s_mix_j_mol_k)')} AS delta_s_mix_j_mol_k FROM w_dbtt w LEFT JOIN vecs v USING (rec_key) LEFT JOIN entropy s USING (rec_key)",
        "runs_and_fetches": "SELECT doi, model, failure FROM extraction UNION ALL BY NAME SELECT doi, status, message FROM fetch_log",
        "figure_base64": "SELECT figure_key, to_base64(encode(description)) AS encoded, description AS decoded FROM extraction_figure",
        "reply_parse": """WITH v AS (SELECT cache_id, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS j FROM mp_cache)
SELECT cache_id, CASE WHEN json_type(j) = 'ARRAY' THEN CAST(json_array_length(j) AS INTEGER) END AS n_records,
  CASE WHEN json_type(j) = 'ARRAY' THEN NULL ELSE 'parse_failed' END AS error, cache_id % 3 = 0 AS truncated FROM v""",
        "xml_objects": "SELECT CAST(extraction_id AS VARCHAR) AS doi, CAST(row_number() OVER (PARTITION BY extraction_id ORDER BY figure_key) - 1 AS INTEGER) AS pos, coalesce(figure_id, '') AS ref, 'u' || figure_key AS url FROM extraction_figure WHERE extraction_id IS NOT NULL",
        "xml_bodies": "SELECT CAST(figure_key AS VARCHAR) AS doi, concat_ws(' ', nullif(trim(coalesce(description, '')), ''), nullif(trim(coalesce(figure_id, '')), '')) AS body_text FROM extraction_figure",
        "order_mixtures": "WITH x AS (SELECT l_orderkey, split_part(p_type, ' ', 1) AS el, sum(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL) SELECT l_orderkey, count(*) AS n_components, round(CASE WHEN count(*) > 1 THEN -8.314 * (sum(q * ln(q)) / sum(q) - ln(sum(q))) ELSE 0.0 END + 1e-9, 4) AS entropy FROM x GROUP BY l_orderkey",
    }
    return out
