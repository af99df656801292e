"""Queries of the core operators over whole tables."""

from __future__ import annotations

from formloom.operators import analytes, units
from formloom.plans.registry import Registry
from formloom.session import load

registry = Registry()


@registry.add("p4_found")
def p4_found(spark, d):
    lines = analytes.resolve(load(spark, d, "lab_lines"), load(spark, d, "analyte_ref"))
    return units.p4_found(lines, load(spark, d, "observations"), load(spark, d, "unit_ref"))


@registry.add("p4_common")
def p4_common(spark, d):
    """Every quantity in the common unit of its analyte."""
    from pyspark.sql import functions as F

    ref = load(spark, d, "unit_ref")
    lines = units.lab_quantities(analytes.resolve(load(spark, d, "lab_lines"), load(spark, d, "analyte_ref")), ref)
    obs = units.observation_quantities(load(spark, d, "observations"), ref)
    cols = ["number", "bound", "unit_text", "unit_code", "unit_from", "common_value", "common_unit"]
    a = lines.select(F.lit("lab_line").alias("record_kind"), F.col("line_id").cast("string").alias("record_id"), F.col("analyte").alias("canonical_key"), *cols)
    b = obs.select(F.lit("observation").alias("record_kind"), F.col("observation_id").alias("record_id"), "canonical_key", *cols)
    return a.unionAll(b).where("number is not null")


def _unit_key_sql(c: str) -> str:
    """A unit's spelling by the rules, in DuckDB."""
    from formloom.operators.units import BLANKS, SPELLINGS

    raw = f"trim(regexp_replace({c}, '[{BLANKS}]', ' ', 'g'), ' ')"
    k = f"regexp_replace(translate(lower(replace({raw}, '³', '3')), 'àâäáãåçéèêëíìîïñóòôöõúùûüýÿαβγμµ', 'aaaaaaceeeeiiiinooooouuuuyyabguu'), '\\s+', '', 'g')"
    for a, b in SPELLINGS:
        k = f"regexp_replace({k}, '{a}', '{b.replace('$1', chr(92) + '1')}', 'g')"
    return f"CASE WHEN regexp_full_match({raw}, '[mnpµμ]M') THEN translate({raw}[1:1], 'µμ', 'uu') || 'mol/l' ELSE {k} END"


def _unit_sizes_sql() -> str:
    """size(k, d, l): what spellings measure; ref: unit_ref with it."""
    import math

    prefix = {"": 1.0, "k": 1e3, "m": 1e-3, "u": 1e-6, "n": 1e-9, "p": 1e-12}
    volume = {"l": 1.0, "dl": 1e-1, "ml": 1e-3}
    sizes = [(f"{p}{b}/{v}", b, x / y) for b in ("g", "mol", "u", "kat") for p, x in prefix.items() for v, y in volume.items()]
    sizes += [(f"10^{e}/{v}", "count", 10.0**e * f) for e in (3, 6, 9, 12) for v, f in (("l", 1.0), ("mm3", 1e6))]
    sizes += [("g/l", "count", 1e9), ("t/l", "count", 1e12), ("/mm3", "count", 1e6), ("mm", "m", 1e-3), ("cm", "m", 1e-2), ("dm", "m", 1e-1), ("%", "%", 1.0), ("l/l", "%", 100.0)]
    sizes += [(u, u, 1.0) for u in ("1", "mmol/mol", "pg", "fl", "s", "mm/h")]
    values = ", ".join(f"('{k}', '{d}', {round(math.log10(x), 6)})" for k, d, x in sizes)
    return f"""size AS (SELECT * FROM (VALUES {values}) t(k, d, l)),
ref AS (SELECT u.*, s.d, s.l FROM unit_ref u JOIN size s ON s.k = {_unit_key_sql('u.unit_code')} WHERE NOT (s.k = 'g/l' AND (s.d = 'count') <> starts_with(u.unit_code, 'G')))"""


def _observation_sql() -> str:
    """The same sums in DuckDB: units by their spelling rules, numbers and pairs by its own regular expressions."""
    from formloom.operators.units import BLANKS, NUMBER

    number = NUMBER.replace("'", "''")
    key = _unit_key_sql
    unit = r"[^\s\d,;()|][^\s,;()|]*(?:[ ]?/[ ]?[^\s,;()|]+)?(?: mL| mm3| cent| première heure)?|/[ ]?mm[3³]|10[\^*][0-9]+/[a-zA-Z0-9]+|x10\^[0-9]+/L|p\. cent"
    pair = f"(?:^|[^\\w.,])({number})[{BLANKS}]?({unit})"
    num = lambda c: f"try_cast(replace(regexp_replace({c}, '[{BLANKS}]', '', 'g'), ',', '.') AS double)"
    pairs = lambda c: f"list_zip(regexp_extract_all({c}, '{pair}', 1), regexp_extract_all({c}, '{pair}', 2))"
    return f"""WITH {_unit_sizes_sql()},
o AS (SELECT observation_id, extracted_at, canonical_key, raw_value, evidence_text, coalesce(normalized_value.n, {num(f"regexp_extract(raw_value, '({number})', 1)")}) AS number,
  CASE WHEN lower(trim(regexp_replace(unit, '[{BLANKS}]', ' ', 'g'), ' ')) NOT IN ('', '-', '?', 'n/a', 'na', '--', '.') THEN unit END AS field_unit FROM observations),
c AS (SELECT o.*, unnest(list_concat([{{'p': 1, 'i': 1, 'u': field_unit, 'n': number}}], list_transform({pairs('raw_value')}, lambda x, i: {{'p': 2, 'i': i, 'u': x[2], 'n': {num('x[1]')}}}), list_transform({pairs('evidence_text')}, lambda x, i: {{'p': 3, 'i': i, 'u': x[2], 'n': {num('x[1]')}}}))) AS z FROM o),
k AS (SELECT observation_id, extracted_at, c.canonical_key, z, r.unit_code, r.factor, r.shift FROM c JOIN size s ON s.k = {key("regexp_replace(z.u, '([^m])[.]$', '" + chr(92) + "1')")} JOIN ref r ON r.canonical_key = c.canonical_key AND r.d = s.d AND r.l = s.l WHERE z.u IS NOT NULL AND (z.p < 2 OR abs(z.n - number) <= abs(number) * 1e-9)),
b AS (SELECT observation_id, extracted_at, canonical_key, arg_min(struct_pack(unit_code, factor, shift), (z.p, z.i)) AS r FROM k GROUP BY ALL)
SELECT o.observation_id, o.extracted_at, o.canonical_key, o.number, b.r.unit_code AS unit_code, round(coalesce(o.number * b.r.factor + b.r.shift, CASE WHEN u.unit_code IS NOT NULL THEN o.number END), 6) AS common_value
FROM o LEFT JOIN b USING (observation_id, extracted_at, canonical_key) LEFT JOIN unit_ref u ON u.canonical_key = o.canonical_key AND u.is_common WHERE o.number IS NOT NULL"""


@registry.add("observation_units", _observation_sql())
def observation_units(spark, d):
    """Observations in the common unit of their key, with the code of the unit stated."""
    from pyspark.sql import functions as F

    q = units.observation_quantities(load(spark, d, "observations"), load(spark, d, "unit_ref")).where("number is not null")
    return q.select("observation_id", "extracted_at", "canonical_key", "number", "unit_code", F.round("common_value", 6).alias("common_value"))


def _analyte_sql() -> str:
    """Every name against every form of the list by distance, without segments or variants."""
    marks = "'àâäáãåçéèêëíìîïñóòôöõúùûüýÿαβγμµ', 'aaaaaaceeeeiiiinooooouuuuyyabguu'"

    def plain(c: str) -> str:
        a = f"regexp_replace({c}, '[\\s\\x{{a0}}\\x{{202f}}]+', ' ', 'g')"
        a = f"regexp_replace({a}, '\\s*[\\(\\[][^\\(\\)\\[\\]]*[\\)\\]]\\s*$', '')"
        a = f"regexp_replace({a}, '(?i)\\s+(?:[-–—;:]\\s+.*|[àa]\\s+j[0-9]+\\s*)$', '')"
        f = f"translate(replace(translate(replace(replace(lower(trim({a}, ' ')), 'œ', 'oe'), 'æ', 'ae'), {marks}), '\\/', 'v'), '@†', 'at')"
        return f"regexp_replace({f}, '\\s*(?:[*:;,…]+|\\.{{2,}})\\s*$', '')"

    dotted = "CASE WHEN regexp_matches(f0, '^(?:[a-z0-9]\\.){2,}[a-z0-9]?$') THEN replace(f0, '.', '') ELSE f0 END"
    spaced = "trim(regexp_replace(f, '[^a-z0-9]+', ' ', 'g'), ' ')"
    order = lambda c: f"array_to_string(list_sort(string_split({c}, ' ')), ' ')"
    letters = lambda c: f"array_to_string(list_sort(string_split({c}, '')), '')"
    looks = lambda c: f"translate(replace(replace(replace(replace(regexp_replace({c}, '[^a-z0-9]+', '', 'g'), 'rn', 'm'), 'ri', 'n'), 'ii', 'u'), 'li', 'h'), '01l59qc', 'oiisgge')"
    blank = lambda c: f"regexp_full_match(coalesce({c}, ''), '[\\s\\x{{a0}}\\x{{85}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]*')"
    return f"""WITH l0 AS (SELECT line_id, CASE WHEN NOT {blank('name')} THEN name WHEN NOT {blank('canonical_name')} THEN canonical_name END AS t,
  CASE WHEN NOT {blank('name')} THEN trim(regexp_extract(raw_text, '(?s)^\\s*\\|?\\s*(.*?)(?:\\.{{3}}|[\\n\\t|:=]|\\z)', 1), ' ') END AS p FROM lab_lines),
forms AS (SELECT DISTINCT canonical_key AS key, f, {spaced} AS gs FROM (SELECT canonical_key, {dotted} AS f FROM (SELECT canonical_key, {plain('form')} AS f0 FROM (SELECT canonical_key, unnest(list_concat([canonical_key, label_fr, label_en], aliases)) AS form FROM analyte_ref) WHERE form IS NOT NULL))),
n AS (SELECT t, typed, f, {spaced} AS fs FROM (SELECT t, typed, {dotted} AS f FROM (SELECT t, max(typed) AS typed, any_value({plain('t')}) AS f0 FROM (SELECT t, 1 AS typed FROM l0 UNION ALL SELECT p, 0 FROM l0) WHERE NOT {blank('t')} GROUP BY t))),
s AS (SELECT t, key, 0 AS cost FROM n JOIN forms ON fs = gs UNION ALL SELECT t, key, 1 FROM n JOIN forms ON {order('fs')} = {order('gs')} UNION ALL SELECT t, key, 2 FROM n JOIN forms ON {looks('fs')} = {looks('gs')}
  UNION ALL SELECT t, key, 3 FROM (SELECT t, key, list_filter(string_split_regex(regexp_replace(n.f, '[^a-z0-9. ]', ' ', 'g'), '\\s+'), lambda x: x <> '') AS w, string_split(gs, ' ') AS g, fs, gs FROM n, forms WHERE regexp_matches(n.f, '[a-z0-9]{{2,}}\\.(?:\\s|$)'))
    WHERE len(w) = len(g) AND len(list_filter(range(1, len(w) + 1), lambda i: CASE WHEN ends_with(w[i], '.') THEN starts_with(g[i], replace(w[i], '.', '')) ELSE w[i] = g[i] END)) = len(w)
    AND array_to_string(list_transform(string_split(fs, ' '), lambda x: x[1:2]), ' ') = array_to_string(list_transform(string_split(gs, ' '), lambda x: x[1:2]), ' ')),
sure AS (SELECT t, arg_min(key, (cost, key)) AS k FROM s WHERE t IN (SELECT t FROM n WHERE fs <> '') GROUP BY t),
d AS (SELECT t, key, gs, levenshtein(fs, gs) AS d, levenshtein({letters('fs')}, {letters('gs')}) AS far FROM n JOIN forms ON length(fs) >= 4 AND length(gs) >= 4 AND abs(length(fs) - length(gs)) <= 2 WHERE typed = 1 AND t NOT IN (SELECT t FROM sure) AND levenshtein(fs, gs) <= 4),
e AS (SELECT *, CASE WHEN d = 4 AND far = 0 THEN 2 WHEN d = 3 AND far <= 2 THEN 2 WHEN d = 2 AND far = 0 THEN 1 ELSE d END AS errors FROM d),
b AS (SELECT t, key, min(errors * 10 + d) AS c FROM e WHERE errors <= CASE WHEN length(gs) >= 6 THEN 2 ELSE 1 END GROUP BY ALL),
near AS (SELECT t, arg_min(key, (c, key)) AS k FROM b GROUP BY t HAVING count(*) = 1 OR list_sort(list(c))[1] < list_sort(list(c))[2]),
known AS (SELECT * FROM sure UNION ALL SELECT * FROM near)
SELECT line_id, coalesce(a.k, sure.k) AS analyte FROM l0 LEFT JOIN known a ON a.t = l0.t LEFT JOIN sure ON sure.t = l0.p"""


@registry.add("line_analytes", _analyte_sql())
def line_analytes(spark, d):
    """The analyte of every lab line, by its typed or printed name."""
    return analytes.resolve(load(spark, d, "lab_lines"), load(spark, d, "analyte_ref")).select("line_id", "analyte")


def _stated_sql() -> str:
    from formloom.operators.units import BLANKS, NUMBER

    said = f"trim(regexp_replace(unit, '[{BLANKS}]', ' ', 'g'), ' ')"
    num = f"coalesce(value.n, try_cast(replace(regexp_replace(regexp_extract(value.s, '({NUMBER})', 1), '[{BLANKS}]', '', 'g'), ',', '.') AS double))"
    return f"""{_analyte_sql().replace("SELECT line_id, coalesce(a.k, sure.k) AS analyte", "an AS (SELECT line_id, coalesce(a.k, sure.k) AS analyte").replace("known AS (SELECT * FROM sure UNION ALL SELECT * FROM near)", "known AS (SELECT * FROM sure UNION ALL SELECT * FROM near),")}),
{_unit_sizes_sql()},
x AS (SELECT line_id, analyte, {num} AS number, {said} AS u FROM lab_lines JOIN an USING (line_id) WHERE lower({said}) NOT IN ('', '-', '?', 'n/a', 'na', '--', '.')),
k AS (SELECT line_id, arg_min(struct_pack(c := r.unit_code, f := r.factor, h := r.shift), (NOT r.is_common, r.unit_code)) AS r FROM x JOIN size s ON s.k = {_unit_key_sql('x.u')} JOIN ref r ON r.canonical_key = x.analyte AND r.d = s.d AND r.l = s.l GROUP BY 1)
SELECT line_id, analyte, number, k.r.c AS unit_code, round(number * k.r.f + k.r.h, 6) AS common_value FROM x LEFT JOIN k USING (line_id) WHERE number IS NOT NULL"""


@registry.add("p4_stated", _stated_sql())
def p4_stated(spark, d):
    """The lines with a unit of their own: number, code of that unit, value in the common one."""
    from pyspark.sql import functions as F

    lines = analytes.resolve(load(spark, d, "lab_lines"), load(spark, d, "analyte_ref"))
    q = units.lab_quantities(lines, load(spark, d, "unit_ref")).where(units.stated(F.col("unit")).isNotNull() & F.col("number").isNotNull())
    return q.select("line_id", "analyte", "number", "unit_code", F.round("common_value", 6).alias("common_value"))
