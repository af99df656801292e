"""Queries of the extraction pipeline's own operators over whole tables, with SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from formloom.operators import chunking, etl, evaluation, extraction, index, labrows, parsing, retrieval, rules
from formloom.plans.registry import Registry
from formloom.session import bounded, load
from formloom.streaming import ingest

registry = Registry()
add = registry.add


def _list(items) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


def _points(items, each: int, s: str = "s") -> str:
    return f"{each} * len(list_filter({_list(items)}, lambda x: contains({s}, x)))"


# --- parsing --------------------------------------------------------------------------------------
_VU = r"[0-9]+(?:[.,][0-9]+)?\s*(?:(?:g/l|mg/l|u/l|µmol/l|umol/l|ui/l|mmol/l)\b|%\b)"
_SCORES = rf"""
base AS (SELECT doc_id, text, lower(substring(text, 1, 18000)) AS s, substring(text, 1, 18000) AS r FROM documents),
lab AS (SELECT *, len(list_filter({_list(parsing.MORPHO_CONTEXT)}, lambda x: contains(s, x))) > 0 AS ctx, regexp_matches(s, '(?i){_VU}') AS vu,
  (len(list_filter({_list(parsing.LAB_ROW_PARTS)}, lambda x: contains(s, x))) > 0 OR regexp_matches(s, '(?:^|[^\p{{L}}\p{{N}}_])(?:ast|alt|crp)(?:[^\p{{L}}\p{{N}}_]|$)')) AS rowish FROM base),
scored AS (SELECT *, {_points(parsing.LAB_STRONG, 3)} + {_points(parsing.LAB_MEDIUM, 2)} + CASE WHEN regexp_matches(s, '\bbiologie\b') THEN 2 ELSE 0 END
  + least({_points(parsing.LAB_WEAK_PARTS, 1)} + regexp_matches(s, '(?:^|[^\p{{L}}\p{{N}}_])crp(?:[^\p{{L}}\p{{N}}_]|$)')::int + regexp_matches(s, '(?:^|[^\p{{L}}\p{{N}}_])ast(?:[^\p{{L}}\p{{N}}_]|$)')::int + regexp_matches(s, '(?:^|[^\p{{L}}\p{{N}}_])alt(?:[^\p{{L}}\p{{N}}_]|$)')::int, 3)
  + CASE WHEN vu THEN 2 ELSE 0 END + CASE WHEN vu AND rowish THEN 2 ELSE 0 END AS lab_score FROM lab)
"""


@add("probable_lab", f"WITH {_SCORES} SELECT doc_id, lab_score::int AS lab_score, ctx AS morpho_context, (trim(text) <> '' AND lab_score >= CASE WHEN ctx THEN 6 ELSE 4 END) AS probable_lab FROM scored WHERE text IS NOT NULL")
def probable_lab(s, d):
    t = F.col("text")
    return load(s, d, "documents").where(t.isNotNull()).select("doc_id", parsing.lab_score(t).alias("lab_score"), parsing.morpho_context(t).alias("morpho_context"), parsing.probable_lab(t).alias("probable_lab"))


_STATS = r"""
lines AS (SELECT doc_id, list_filter(string_split(r, chr(10)), lambda x: trim(x, ' ') <> '')[1:500] AS l FROM base),
stats AS (SELECT doc_id, len(l) AS n_lines,
  CASE WHEN len(l) = 0 THEN 0.0 ELSE len(list_filter(l, lambda x: length(x) - length(replace(x, '|', '')) >= 2))::double / len(l) END AS p,
  CASE WHEN len(l) = 0 THEN 0.0 ELSE len(list_filter(l, lambda x: regexp_matches(x, '(?i)""" + _VU + r"""')))::double / len(l) END AS v,
  CASE WHEN len(l) = 0 THEN 0.0 ELSE list_sum(list_transform(l, lambda x: length(trim(x, ' '))))::double / len(l) END AS m FROM lines)
"""


@add("line_stats", f"WITH {_SCORES}, {_STATS} SELECT doc_id, n_lines::int AS n_lines, round(p, 6) AS pipe_ratio, round(v, 6) AS value_unit_ratio, round(m, 6) AS mean_length FROM stats JOIN base USING (doc_id) WHERE text IS NOT NULL")
def line_stats(s, d):
    x = load(s, d, "documents").where("text is not null").select("doc_id", parsing.line_stats(F.substring("text", 1, parsing.SAMPLE_CHARS)).alias("x"))
    return x.select("doc_id", "x.n_lines", *[F.round(f"x.{c}", 6).alias(c) for c in ("pipe_ratio", "value_unit_ratio", "mean_length")])


_IMG = " + ".join(f"CASE WHEN contains(s, '{w.replace(chr(39), chr(39) * 2)}') THEN {x} ELSE 0.0 END" for w, x in parsing.IMAGING_PARTS)
_PS = parsing.PATHOLOGY_STRONG.replace("'", "''")
_PC = parsing.PATHOLOGY_CONTEXT.replace("'", "''")
_LT = parsing.LETTER.replace("'", "''")


@add(
    "classify_document_type",
    rf"""WITH {_SCORES}, {_STATS},
a AS (SELECT scored.*, n_lines, p, v, m, 0.52 * least(1.0, lab_score / 6.25::double) + 0.35 * least(1.0, 0.42 * p + 0.38 * least(1.0, v * 12.0) + 0.08 * v) + 0.13 * least(1.0, (p + v) / 1.2::double) AS l0,
  CASE WHEN ctx THEN 0.86::double ELSE least(1.0, 0.22 + least(1.0, ({_IMG})::double)) END AS ib,
  least(1.0, 0.28 * least(1.0, m / 95.0::double) + 0.32 * (1.0 - p) + 0.18 * least(1.0, n_lines / 80.0::double)) AS nar,
  CASE WHEN regexp_matches(s, '{_PC}') THEN 0.75::double ELSE 0.0 END AS pc, least(1.0, 0.28::double * len(regexp_extract_all(s, '{_PS}'))) AS ps,
  least(1.0, 0.38::double * len(regexp_extract_all(s, '{_LT}'))) AS lt FROM scored JOIN stats USING (doc_id)),
b AS (SELECT *, CASE WHEN ctx THEN l0 * CASE WHEN l0 < 0.58 THEN 0.38 ELSE 0.82 END ELSE l0 END AS l1, least(1.0, ib * (0.62 + 0.38 * nar)) AS i0, least(1.0, greatest(pc, ps * 1.15, 0.55 * (pc + ps))) AS p1 FROM a),
c AS (SELECT *, CASE WHEN pc >= 0.7 THEN i0 * 0.52 WHEN greatest(pc, ps) >= 0.42 AND p1 >= i0 - 0.14 AND l1 < 0.62 THEN i0 * 0.72 ELSE i0 END AS i1 FROM b),
f AS (SELECT doc_id, text, round(l1, 4) AS x1, round(i1, 4) AS x2, round(p1, 4) AS x3, round(lt, 4) AS x4 FROM c),
g AS (SELECT *, list_reverse_sort([x1, x2, x3, x4]) AS r FROM f)
SELECT doc_id, CASE WHEN text IS NULL OR r[1] < 0.33 OR r[1] - r[2] < 0.055 THEN 'unknown' WHEN r[1] = x1 THEN 'lab_blood_panel' WHEN r[1] = x2 THEN 'imaging_report' WHEN r[1] = x3 THEN 'pathology_report' ELSE 'clinical_letter' END AS document_type FROM g""",
)
def classify_document_type(s, d):
    return parsing.classify(load(s, d, "documents").select("doc_id", "text")).select("doc_id", "document_type")


def _duck_date(p: str, o: tuple[int, int, int]) -> str:
    q = p.replace("'", "''")
    y, m, dd = (f"regexp_extract(full_text, '{q}', {i})" for i in o)
    n = f"try_cast({y} AS int)"
    year = f"CASE WHEN {n} >= 100 THEN {n} WHEN {n} < 70 THEN {n} + 2000 ELSE {n} + 1900 END"
    return f"try_cast(lpad(({year})::varchar, 4, '0') || '-' || {m} || '-' || {dd} AS date)"


@add("document_date", "SELECT document_id, coalesce(" + ", ".join(_duck_date(p, o) for p, o in parsing.DATE_PATTERNS) + ") AS found_date FROM parsed_documents")
def document_date(s, d):
    return load(s, d, "parsed_documents").select("document_id", parsing.document_date(F.col("full_text")).alias("found_date"))


def _heads(items) -> str:
    return f"len(list_filter({_list(items)}, lambda x: contains(lower(c), x))) > 0"


@add(
    "segment_lines",
    rf"""WITH l AS (SELECT document_id, document_type_hint AS h, unnest(string_split_regex(full_text, '\r?\n')) AS line, generate_subscripts(string_split_regex(full_text, '\r?\n'), 1) AS i FROM parsed_documents),
c AS (SELECT *, trim(regexp_replace(line, '\s+', ' ', 'g'), ' ') AS c FROM l),
k AS (SELECT *, length(c) <= 90 AND (CASE WHEN h = 'lab_blood_panel' THEN {_heads(parsing.LAB_HEADINGS)} ELSE {_heads(parsing.GENERIC_HEADINGS)} END OR regexp_full_match(c, '[A-ZÀ-Ÿ0-9 /()\-]{{4,}}')) AS is_h FROM c
  WHERE c <> '' AND NOT regexp_matches(c, '(?i)^page\s+[0-9]+\b') AND NOT regexp_matches(c, '(?i)^--\s*[0-9]+\s+of\s+[0-9]+\s*--$') AND NOT regexp_matches(c, '(?i)^labo .*tel[:\s]')),
n AS (SELECT *, sum(is_h::int) OVER (PARTITION BY document_id ORDER BY i) AS section_ord FROM k)
SELECT document_id, section_ord::bigint AS section_ord, max(CASE WHEN is_h THEN trim(replace(c, ':', ''), ' ') END) AS heading, coalesce(string_agg(CASE WHEN NOT is_h THEN c END, chr(10) ORDER BY i), '') AS body FROM n GROUP BY document_id, section_ord""",
)
def segment_lines(s, d):
    return parsing.segment(load(s, d, "parsed_documents"), "document_id", "full_text", "document_type_hint")


@add(
    "markdown_sections",
    r"""WITH t AS (SELECT document_id, string_split_regex(regexp_replace(full_text, '\n\n+', chr(10) || '## ', 'g'), '\n(?:##+\s+)') AS p FROM parsed_documents WHERE full_text IS NOT NULL),
u AS (SELECT document_id, unnest(p) AS part, generate_subscripts(p, 1) - 1 AS section_ord FROM t),
v AS (SELECT document_id, section_ord::int AS section_ord, CASE WHEN section_ord > 0 THEN trim(split_part(part, chr(10), 1), ' ') END AS heading,
  trim(CASE WHEN section_ord > 0 THEN substring(part, length(split_part(part, chr(10), 1)) + 2) ELSE part END, ' ') AS body FROM u)
SELECT * FROM v WHERE heading IS NOT NULL OR body <> ''""",
)
def markdown_sections(s, d):
    t = load(s, d, "parsed_documents").where("full_text is not null").select("document_id", F.regexp_replace("full_text", r"\n\n+", "\n## ").alias("t"))
    return parsing.markdown_sections(t, "document_id", "t")


# --- chunks ---------------------------------------------------------------------------------------
_FAM = "CASE " + " ".join(
    f"WHEN h{i} > 0 AND h{i} = greatest(h0, h1, h2, h3) THEN '{n}'" for i, (n, _) in enumerate(chunking.FAMILY_KEYWORDS)
) + " END"
_HITS = ", ".join(f"{_points(ks, 1, 'lower(text)')} AS h{i}" for i, (_, ks) in enumerate(chunking.FAMILY_KEYWORDS))


@add(
    "chunk_paragraphs",
    rf"""WITH t AS (SELECT document_id, full_text, list_filter(list_transform(string_split_regex(full_text, '\n\s*\n+'), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(10))), lambda x: x <> '') AS p,
  list_filter(list_transform(string_split(full_text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(10))), lambda x: x <> '') AS l FROM parsed_documents WHERE trim(full_text, ' ' || chr(9) || chr(13) || chr(10)) <> ''),
u AS (SELECT document_id, unnest(CASE WHEN len(p) <= 1 THEN l ELSE p END) AS text, generate_subscripts(CASE WHEN len(p) <= 1 THEN l ELSE p END, 1) - 1 AS chunk_ord FROM t),
h AS (SELECT *, {_HITS} FROM u)
SELECT document_id, chunk_ord::int AS chunk_ord, 'chk_' || substring(sha256(document_id || ':' || text), 1, 16) AS chunk_id, text, {_FAM} AS field_family FROM h""",
)
def chunk_paragraphs(s, d):
    return chunking.paragraphs(load(s, d, "parsed_documents"), "document_id", "full_text").select("document_id", "chunk_ord", "chunk_id", "text", "field_family")


@add("chunk_spans", "SELECT document_id, true AS all_verified FROM parsed_documents WHERE trim(full_text, ' ' || chr(9) || chr(13) || chr(10)) <> ''")
def chunk_spans(s, d):
    docs = load(s, d, "parsed_documents")
    c = chunking.paragraphs(docs, "document_id", "full_text").join(docs.select("document_id", "full_text"), "document_id")
    ok = F.expr("substring(full_text, char_start + 1, char_end - char_start) = text")
    return c.groupBy("document_id").agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias("all_verified"))


# the texts of these tables below the limit come out whole; the fold is tested beyond it
@add("chunk_pack_oversized", """WITH t AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL)
SELECT doc_id, true AS within, true AS whole FROM t""")
def chunk_pack_oversized(s, d):
    """Whether the parts of every text keep the limit (or are single lines) and hold all its words in order."""
    docs = load(s, d, "documents")
    p = chunking.pack_oversized(docs, "doc_id", "text")
    words = lambda c: F.regexp_replace(c, r"\s+", "")
    g = p.groupBy("doc_id").agg(F.bool_and((F.length("part") <= chunking.IMAGING_CHARS) | ~F.contains("part", F.lit("\n"))).alias("within"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part_ord", "part"))), lambda x: x["part"]), "").alias("t"))
    return g.join(docs.select("doc_id", "text"), "doc_id").select("doc_id", "within", (words("t") == words("text")).alias("whole"))


@add(
    "lab_row_chunks",
    """WITH g AS (SELECT document_id, section, subsection, min(ord) AS o, arg_min(line_id, (ord, line_id)) AS i, string_agg(raw_text, chr(10) ORDER BY ord, line_id) AS text FROM lab_lines WHERE raw_text IS NOT NULL GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY o, i) - 1 AS chunk_ord FROM g)
SELECT document_id, chunk_ord::int AS chunk_ord, 'chk_' || substring(sha256(document_id || ':lab_rows:' || chunk_ord || ':' || text), 1, 16) AS chunk_id, text, section, subsection FROM n""",
)
def lab_row_chunks(s, d):
    return chunking.lab_row_chunks(load(s, d, "lab_lines"))


@add(
    "section_spans",
    rf"""WITH l AS (SELECT document_id, document_type_hint AS h, unnest(string_split_regex(full_text, '\r?\n')) AS line, generate_subscripts(string_split_regex(full_text, '\r?\n'), 1) AS i FROM parsed_documents),
c AS (SELECT *, trim(regexp_replace(line, '\s+', ' ', 'g'), ' ') AS c FROM l),
k AS (SELECT *, length(c) <= 90 AND (CASE WHEN h = 'lab_blood_panel' THEN {_heads(parsing.LAB_HEADINGS)} ELSE {_heads(parsing.GENERIC_HEADINGS)} END OR regexp_full_match(c, '[A-ZÀ-Ÿ0-9 /()\-]{{4,}}')) AS is_h FROM c
  WHERE c <> '' AND NOT regexp_matches(c, '(?i)^page\s+[0-9]+\b') AND NOT regexp_matches(c, '(?i)^--\s*[0-9]+\s+of\s+[0-9]+\s*--$') AND NOT regexp_matches(c, '(?i)^labo .*tel[:\s]')),
n AS (SELECT *, sum(is_h::int) OVER (PARTITION BY document_id ORDER BY i) AS section_ord FROM k),
s AS (SELECT document_id, section_ord, max(CASE WHEN is_h THEN trim(replace(c, ':', ''), ' ') END) AS heading, sum(CASE WHEN NOT is_h THEN length(c) + 1 ELSE 0 END) - 1 AS n FROM n GROUP BY ALL HAVING bool_or(NOT is_h))
SELECT document_id, section_ord::bigint AS section_ord, heading, (coalesce(sum(n + 2) OVER w, 0))::bigint AS char_start, (coalesce(sum(n + 2) OVER w, 0) + n)::bigint AS char_end, true AS verified FROM s
WINDOW w AS (PARTITION BY document_id ORDER BY section_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def section_spans(s, d):
    docs = load(s, d, "parsed_documents")
    sec = parsing.segment(docs, "document_id", "full_text", "document_type_hint")
    joined = sec.where("body <> ''").groupBy("document_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section_ord", "body"))), lambda x: x["body"]), "\n\n").alias("full"))
    return chunking.section_spans(sec, joined, "document_id", "full").drop("body")


# --- laboratory rows ------------------------------------------------------------------------------
_INL = labrows.INLINE.replace("(?iu)", "(?i)").replace("'", "''")
_CANON = "CASE " + " ".join(f"WHEN strip_accents(lower(trim(name, ' '))) = '{k}' THEN '{v}'" for k, v in reversed(list(labrows.CANONICAL.items()))) + " END"


@add(
    "lab_inline_rows",
    rf"""WITH l AS (SELECT document_id, trim(unnest(string_split_regex(full_text, '\r?\n')), ' ') AS raw_text, generate_subscripts(string_split_regex(full_text, '\r?\n'), 1) - 1 AS ord FROM parsed_documents),
m AS (SELECT *, trim(regexp_extract(raw_text, '{_INL}', 1), ' ') AS name, regexp_extract(raw_text, '{_INL}', 2) AS v, regexp_extract(raw_text, '{_INL}', 3) AS u FROM l)
SELECT document_id, ord::int AS ord, name, nullif({_CANON}, name) AS canonical_name, replace(regexp_replace(v, '[<>\s]', '', 'g'), ',', '.')::double AS value, nullif(u, '') AS unit, raw_text, CASE WHEN u <> '' THEN 0.88 ELSE 0.78 END::double AS confidence
FROM m WHERE v <> '' AND NOT starts_with(lower(name), 'inf.')""",
)
def lab_inline_rows(s, d):
    return labrows.inline_rows(load(s, d, "parsed_documents"), "document_id", "full_text")


@add("lab_dotted_rows")
def lab_dotted_rows(s, d):
    return labrows.dotted_rows(load(s, d, "parsed_documents"), "document_id", "full_text")


# --- extraction -----------------------------------------------------------------------------------
@add(
    "plan_jobs",
    """WITH f AS (SELECT *, coalesce(extraction_strategy, CASE extraction_family WHEN 'lab_values' THEN 'lab_deterministic' WHEN 'imaging_recist' THEN 'imaging_langextract' WHEN 'narrative_clinical' THEN 'narrative_keywords' ELSE 'none' END) AS strategy, unnest(document_types_allowed) AS document_type FROM field_defs),
c AS (SELECT *, CASE WHEN strategy = 'imaging_langextract' THEN CASE canonical_key WHEN 'Size_major_nodule_mm' THEN 'lesion_size_mm' WHEN 'RECIST_response' THEN 'recist_response' WHEN 'lesion_description' THEN 'lesion_description' WHEN 'imaging_conclusion' THEN 'imaging_conclusion' END END AS cls FROM f WHERE strategy <> 'none'),
g AS (SELECT document_type, strategy, field_family, string_agg(DISTINCT canonical_key, ',' ORDER BY canonical_key) AS canonical_keys, string_agg(DISTINCT field_name, ',' ORDER BY field_name) AS field_names, list(DISTINCT cls) FILTER (cls IS NOT NULL) AS cs, bool_or(canonical_key = 'RECIST_response' AND strategy = 'imaging_langextract') AS derive_recist FROM c GROUP BY ALL)
SELECT document_type, strategy, field_family, canonical_keys, field_names, array_to_string(list_sort(list_distinct(list_concat(coalesce(cs, []), CASE WHEN derive_recist THEN ['imaging_conclusion'] ELSE [] END))), ',') AS classes, derive_recist FROM g""",
)
def plan_jobs(s, d):
    return extraction.plan_jobs(load(s, d, "field_defs"))


_LABX = " UNION ALL ".join(
    f"SELECT chunk_id, document_id, indexed_at, '{k}' AS canonical_key, try_cast(replace(regexp_extract(text, '(?i){p}', 1), ',', '.') AS double) AS value, "
    + (f"'{u}'" if u else "NULL") + f" AS unit, '{fam}' AS field_family FROM chunks WHERE regexp_extract(text, '(?i){p}', 1) <> ''" for k, p, u, fam in extraction.ANALYTES
)


@add("lab_regex_extract", _LABX)
def lab_regex_extract(s, d):
    return extraction.lab_values(load(s, d, "chunks").select("chunk_id", "document_id", "indexed_at", "text")).drop("text", "confidence")


_NK = "trim(regexp_replace(strip_accents(lower(name)), '[^a-z0-9]+', ' ', 'g'))"
_KEY = "CASE " + " ".join(f"WHEN k = '{a}' THEN '{v}'" for a, v in extraction.ALIASES.items()) + " WHEN list_contains(string_split(k, ' '), 'asat') THEN 'AST' WHEN list_contains(string_split(k, ' '), 'alat') THEN 'ALT' END"


@add(
    "lab_name_keys",
    f"""WITH n AS (SELECT line_id, section, {_NK} AS k FROM lab_lines WHERE name IS NOT NULL), m AS (SELECT *, {_KEY} AS canonical_key FROM n)
SELECT line_id, canonical_key, CASE """ + " ".join(f"WHEN canonical_key = '{k}' THEN '{fam}'" for k, _, _, fam in extraction.ANALYTES)
    + """ WHEN strip_accents(lower(section)) = 'hematologie' THEN 'hematology' WHEN strip_accents(lower(section)) = 'hemostase' THEN 'coagulation' WHEN strip_accents(lower(section)) = 'biochimie' THEN 'hepatic_biochemistry' ELSE 'inflammation_biomarkers' END AS field_family FROM m""",
)
def lab_name_keys(s, d):
    key = extraction.canonical_key_of(F.col("name"))
    return load(s, d, "lab_lines").where("name is not null").select("line_id", key.alias("canonical_key"), extraction.lab_family(key, F.col("section")).alias("field_family"))


@add(
    "line_observations",
    f"""WITH c AS (SELECT chunk_id, arg_max(struct_pack(d := document_id, o := chunk_ord, t := text), (indexed_at, document_id, chunk_ord)) AS r FROM chunks GROUP BY 1),
j AS (SELECT l.line_id, arg_min(c.chunk_id, (c.r.o, c.chunk_id)) AS source_chunk_id FROM lab_lines l LEFT JOIN c ON l.document_id = c.r.d AND contains(c.r.t, l.raw_text) GROUP BY l.line_id),
n AS (SELECT *, {_NK} AS k FROM lab_lines), m AS (SELECT *, {_KEY} AS canonical_key FROM n)
SELECT line_id, document_id, canonical_key, CASE """ + " ".join(f"WHEN canonical_key = '{k}' THEN '{fam}'" for k, _, _, fam in extraction.ANALYTES)
    + """ WHEN strip_accents(lower(section)) = 'hematologie' THEN 'hematology' WHEN strip_accents(lower(section)) = 'hemostase' THEN 'coagulation' WHEN strip_accents(lower(section)) = 'biochimie' THEN 'hepatic_biochemistry' ELSE 'inflammation_biomarkers' END AS field_family,
value.n AS number, value.s AS words, unit, confidence, source_chunk_id FROM m JOIN j USING (line_id)""",
)
def line_observations(s, d):
    o = extraction.line_observations(load(s, d, "lab_lines"), load(s, d, "chunks"))
    return o.select("line_id", "document_id", "canonical_key", "field_family", F.col("value.n").alias("number"), F.col("value.s").alias("words"), "unit", "confidence", "source_chunk_id")


_NEG = "|".join(extraction.NEGATIONS)


@add(
    "narrative_keywords",
    rf"""WITH l AS (SELECT document_id, unnest(string_split(full_text, chr(10))) AS line, generate_subscripts(string_split(full_text, chr(10)), 1) AS i FROM parsed_documents),
k AS (SELECT * FROM l WHERE (instr(lower(line), 'cirrhose') > 0 AND NOT regexp_matches(substring(lower(line), 1, instr(lower(line), 'cirrhose') - 1), '{_NEG}'))
  OR (instr(lower(line), 'cirrhosis') > 0 AND NOT regexp_matches(substring(lower(line), 1, instr(lower(line), 'cirrhosis') - 1), '{_NEG}')))
SELECT document_id, 'Cirrhosis' AS canonical_key, true AS value, 0.8::double AS confidence, arg_min(trim(line, ' '), i) AS evidence FROM k GROUP BY document_id""",
)
def narrative_keywords(s, d):
    return extraction.narrative(load(s, d, "parsed_documents"), "document_id", "full_text", "Cirrhosis", ["cirrhose", "cirrhosis"])


_SZ = extraction.SIZE


@add(
    "lesion_size_mm",
    f"""WITH o AS (SELECT observation_id, extracted_at, evidence_text, replace(regexp_extract(evidence_text, '(?i){_SZ}', 1), ',', '.') AS n, lower(regexp_extract(evidence_text, '(?i){_SZ}', 2)) AS u FROM observations WHERE canonical_key = 'Size_major_nodule_mm')
SELECT observation_id, extracted_at, round(CASE WHEN starts_with(u, 'c') THEN try_cast(n AS double) * 10 ELSE try_cast(n AS double) END, 6) AS value_mm FROM o""",
)
def lesion_size_mm(s, d):
    o = load(s, d, "observations").where("canonical_key = 'Size_major_nodule_mm'")
    return o.select("observation_id", "extracted_at", F.round(extraction.first_size_mm(F.col("evidence_text")), 6).alias("value_mm"))


@add("lesion_sizes")
def lesion_sizes(s, d):
    # the hint is a dirty column: where it knows nothing, the text settles the type, and a document that
    # neither settles (many short imaging reports) is read too; only documents of another type are left out
    p = load(s, d, "parsed_documents").select("document_id", "full_text", "document_type_hint")
    hint = F.lower(F.trim("document_type_hint"))
    blank = F.coalesce(hint, F.lit("")).isin("", "unknown")
    routed = parsing.classify(p.where(blank), "full_text").select("document_id", "full_text", parsing.route(hint, F.col("document_type")).alias("t"))
    docs = p.where(~blank).select("document_id", "full_text", hint.alias("t")).unionAll(routed).where("t in ('imaging_report', 'unknown')")
    return extraction.lesion_sizes(docs, "document_id", "full_text")


_BB, _BA = extraction.BASELINE_BEFORE.replace("'", "''"), extraction.BASELINE_AFTER.replace("'", "''")


def _mm(p: str, t: str) -> str:
    n, u = f"try_cast(replace(regexp_extract({t}, '{p}', 1), ',', '.') AS double)", f"lower(regexp_extract({t}, '{p}', 2))"
    return f"CASE WHEN starts_with({u}, 'c') THEN {n} * 10 ELSE {n} END"


_PART_TEXT_DUCK = """concat('Indication : suspicion de PD. Au bilan d''inclusion, la cible etait chiffree a ', CASE WHEN p_partkey % 2 = 0 THEN concat(p_size::varchar, ' mm') ELSE concat((p_size / 10.0)::decimal(6,1)::varchar, ' cm') END,
 '. Examen actuel : ', (p_size + 7)::varchar, ' mm. CONCLUSION : Categorie RECIST retenue : ', CASE p_partkey % 5 WHEN 0 THEN 'CR' WHEN 1 THEN 'PR' WHEN 2 THEN 'SD' WHEN 3 THEN 'PD' ELSE 'NE' END, '.')"""


# the report is made from the part's own columns, so the counterpart reads the columns and no text
@add("imaging_fallbacks", "SELECT p_partkey, p_size::double AS size_mm, CASE p_partkey % 5 WHEN 0 THEN 'CR' WHEN 1 THEN 'PR' WHEN 2 THEN 'SD' WHEN 3 THEN 'PD' ELSE 'NE' END AS recist FROM part")
def imaging_fallbacks(s, d):
    t = F.expr(
        "concat('Indication : suspicion de PD. Au bilan d\\'inclusion, la cible etait chiffree a ', case when p_partkey % 2 = 0 then concat(cast(p_size as string), ' mm') else concat(cast(cast(p_size / 10.0 as decimal(6,1)) as string), ' cm') end, "
        "'. Examen actuel : ', cast(p_size + 7 as string), ' mm. CONCLUSION : Categorie RECIST retenue : ', case p_partkey % 5 when 0 then 'CR' when 1 then 'PR' when 2 then 'SD' when 3 then 'PD' else 'NE' end, '.')"
    )
    return load(s, d, "part").withColumn("t", t).select("p_partkey", F.round(extraction.baseline_size_mm(F.col("t")), 6).alias("size_mm"), extraction.conclusion_recist(F.col("t")).alias("recist"))


# the same rules over every clinical text; tested against brute force
@add("report_fallbacks")
def report_fallbacks(s, d):
    t = F.col("full_text")
    return load(s, d, "parsed_documents").select("document_id", F.round(extraction.baseline_size_mm(t), 6).alias("size_mm"), extraction.conclusion_recist(t).alias("recist"))


_NE = " OR ".join("contains(lower(t), '" + x.replace("'", "''") + "')" for x in extraction.NOT_EVALUABLE)
_ST = " OR ".join(f"contains(lower(t), '{x}')" for x in extraction.STABLE)


@add(
    "recist_normalize",
    rf"""WITH o AS (SELECT observation_id, extracted_at, trim(evidence_text, ' ') AS t FROM observations WHERE canonical_key = 'RECIST_response')
SELECT observation_id, extracted_at, CASE WHEN t IS NULL OR t = '' THEN NULL WHEN {_NE} THEN 'NE' WHEN len(regexp_extract_all(t, '(?i)\b(CR|PR|SD|PD|NE)\b', 1)) > 0 THEN upper(regexp_extract_all(t, '(?i)\b(CR|PR|SD|PD|NE)\b', 1)[-1])
 WHEN contains(lower(t), 'complète') OR contains(lower(t), 'complete') THEN 'CR' WHEN contains(lower(t), 'partielle') OR contains(lower(t), 'partial') THEN 'PR' WHEN {_ST} THEN 'SD' WHEN contains(lower(t), 'progression') OR contains(lower(t), 'progressive') THEN 'PD' ELSE substring(t, 1, 64) END AS code FROM o""",
)
def recist_normalize(s, d):
    o = load(s, d, "observations").where("canonical_key = 'RECIST_response'")
    return o.select("observation_id", "extracted_at", extraction.recist_code(F.col("evidence_text")).alias("code"))


# --- mapping and rules ----------------------------------------------------------------------------
_LATEST_OBS = "o AS (SELECT observation_id, arg_max(struct_pack(document_id, canonical_key, confidence), (extracted_at, document_id)) AS r FROM observations GROUP BY 1)"


def _observations(s, d):
    o = load(s, d, "observations")
    return o.groupBy("observation_id").agg(F.max_by(F.struct("document_id", "canonical_key", "confidence"), F.struct("extracted_at", "document_id")).alias("r")).select("observation_id", "r.*")


_RANK = (
    "CASE " + " ".join(f"WHEN t = '{t}' AND temporal_scope = '{sc}' THEN {i}" for t, scs in rules.SCOPES.items() for i, sc in enumerate(scs))
    + f" WHEN t NOT IN ({', '.join(repr(t) for t in rules.SCOPES)}) AND temporal_scope IN ('unspecified', 'baseline', 'follow_up') THEN 0 WHEN temporal_scope = 'unspecified' THEN 50 ELSE 60 END"
)
_MAPPED = f"""{_LATEST_OBS},
j AS (SELECT o.observation_id, o.r.document_id AS document_id, p.document_type_hint AS t, f.*, o.r.confidence AS confidence FROM o JOIN parsed_documents p ON p.document_id = o.r.document_id JOIN field_defs f ON f.canonical_key = o.r.canonical_key),
k AS (SELECT *, {_RANK} AS rk, min({_RANK}) OVER (PARTITION BY observation_id) AS best, row_number() OVER (PARTITION BY observation_id ORDER BY {_RANK}, field_name) AS nth FROM j),
mapped AS (SELECT * FROM k WHERE rk = best AND (best < 60 OR nth = 1))"""


@add("map_observations", f"""WITH {_MAPPED} SELECT observation_id, field_name, target_column, temporal_scope, confidence FROM mapped WHERE list_contains(document_types_allowed, t)""")
def map_observations(s, d):
    docs = load(s, d, "parsed_documents").select("document_id", F.col("document_type_hint").alias("document_type"))
    return rules.map_to_fields(_observations(s, d).join(docs, "document_id"), load(s, d, "field_defs")).select("observation_id", "field_name", "target_column", "temporal_scope", "confidence")


@add(
    "confidence_blend",
    f"""WITH {_MAPPED}, h AS (SELECT document_id, field_family, max(CASE WHEN field_family IS NOT NULL THEN 0.88 ELSE 0.78 END)::double AS s FROM chunks GROUP BY ALL),
b AS (SELECT observation_id, field_name, autofill_threshold, CASE WHEN s IS NULL THEN confidence ELSE greatest(0.0, least(1.0, 0.5 * confidence + 0.5 * s)) END AS blended FROM mapped LEFT JOIN h ON h.document_id = mapped.document_id AND h.field_family = mapped.field_family WHERE list_contains(document_types_allowed, t))
SELECT observation_id, field_name, round(blended, 6) AS blended, blended >= autofill_threshold AS autofill FROM b""",
)
def confidence_blend(s, d):
    docs = load(s, d, "parsed_documents").select("document_id", F.col("document_type_hint").alias("document_type"))
    fields = load(s, d, "field_defs")
    m = rules.map_to_fields(_observations(s, d).join(docs, "document_id"), fields).join(bounded(fields.select("field_name", "field_family")), "field_name")
    score = load(s, d, "chunks").groupBy("document_id", "field_family").agg(F.max(F.when(F.col("field_family").isNotNull(), 0.88).otherwise(0.78)).alias("s"))
    x = m.join(score, ["document_id", "field_family"], "left").withColumn("b", rules.blend(F.col("confidence"), F.col("s")))
    return x.select("observation_id", "field_name", F.round("b", 6).alias("blended"), (F.col("b") >= F.col("autofill_threshold")).alias("autofill"))


_CLEAN = "(SELECT *, CASE WHEN confidence > 1 THEN confidence / 100 ELSE confidence END AS c FROM field_candidates WHERE target_column IS NOT NULL AND confidence IS NOT NULL)"


@add("best_per_column", f"SELECT patient_id, study_id, target_column, max(c) AS c, arg_max(candidate_id, (c, -candidate_id)) AS candidate_id, arg_max_null(value_text, (c, -candidate_id)) AS value_text FROM {_CLEAN} GROUP BY ALL")
def best_per_column(s, d):
    f = load(s, d, "field_candidates").where("target_column is not null and confidence is not null").withColumn("c", F.when(F.col("confidence") > 1, F.col("confidence") / 100).otherwise(F.col("confidence")))
    return rules.best_per_column(f, ["patient_id", "study_id", "target_column"], "c", "candidate_id", ["candidate_id", "value_text"])


_OBS_ROW = ("document_id", "patient_id", "canonical_key", "field_family", "raw_value", "unit", "document_date", "event_date", "temporal_label", "confidence", "evidence_text", "source_chunk_id", "extraction_method", "model_name", "schema_version")
_AUD_ROW = ("recorded_at", "pipeline_version", "document_id", "patient_id", "study_id", "step", "model_name", "source_chunk_id", "evidence_excerpt", "confidence", "details")


@add("dedup_last_wins", f"WITH n AS (SELECT *, row_number() OVER (PARTITION BY observation_id ORDER BY extracted_at DESC, document_id DESC NULLS LAST, raw_value DESC NULLS LAST) AS n FROM observations) SELECT observation_id, extracted_at, {', '.join(_OBS_ROW)} FROM n WHERE n = 1")
def dedup_last_wins(s, d):
    return rules.first_or_last(load(s, d, "observations"), ["observation_id"], ["extracted_at", "document_id", "raw_value"], last=True).select("observation_id", "extracted_at", *_OBS_ROW)


@add("dedup_first_wins", f"WITH n AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY received_at, recorded_at NULLS FIRST, evidence_excerpt NULLS FIRST) AS n FROM audit_records) SELECT record_id, received_at, {', '.join(_AUD_ROW)} FROM n WHERE n = 1")
def dedup_first_wins(s, d):
    return rules.first_or_last(load(s, d, "audit_records"), ["record_id"], ["received_at", "recorded_at", "evidence_excerpt"]).select("record_id", "received_at", *_AUD_ROW)


@add(
    "score_margin",
    """WITH d AS (SELECT document_id, confidence, row_number() OVER (PARTITION BY document_id ORDER BY confidence DESC) AS n FROM observations WHERE confidence IS NOT NULL),
g AS (SELECT document_id, max(CASE WHEN n = 1 THEN confidence END) AS best, max(CASE WHEN n = 2 THEN confidence END) AS second FROM d WHERE n <= 2 GROUP BY 1)
SELECT *, round(best - coalesce(second, 0.0), 6) AS margin FROM g""",
)
def score_margin(s, d):
    return rules.margin(load(s, d, "observations").where("confidence is not null"), "document_id", "confidence")


@add(
    "temporal_labels",
    "SELECT field_name, CASE temporal_scope WHEN 'first_imaging' THEN 'first_imaging_evaluation' WHEN 'second_imaging' THEN 'second_imaging_evaluation' WHEN 'baseline' THEN 'baseline' WHEN 'follow_up' THEN 'follow_up' "
    "WHEN 'line_l2' THEN 'line_l2' WHEN 'line_l3' THEN 'line_l3' WHEN 'line_l4' THEN 'line_l4' ELSE 'unknown' END AS temporal_label, CASE temporal_scope WHEN 'line_l2' THEN 2 WHEN 'line_l3' THEN 3 WHEN 'line_l4' THEN 4 END AS line_number FROM field_defs",
)
def temporal_labels(s, d):
    c = F.col("temporal_scope")
    return load(s, d, "field_defs").select("field_name", rules.temporal_label(c).alias("temporal_label"), rules.line_number(c).alias("line_number"))


@add(
    "validate_values",
    """WITH j AS (SELECT o.observation_id, o.extracted_at, o.normalized_value AS v, f.field_name, f.field_type FROM observations o JOIN field_defs f ON f.canonical_key = o.canonical_key)
SELECT observation_id, extracted_at, field_name, CASE WHEN field_type = 'numeric' AND NOT coalesce(v.kind IN ('n', 'b'), false) THEN 'number expected'
 WHEN field_type = 'boolean' AND v IS NOT NULL AND NOT coalesce(v.kind = 'b' OR v.n IN (0.0, 1.0) OR lower(trim(v.s, ' ')) IN ('true', 'false', ''), false) THEN 'boolean expected' ELSE '' END AS errors FROM j""",
)
def validate_values(s, d):
    f = load(s, d, "field_defs").select("canonical_key", "field_name", "field_type")
    o = load(s, d, "observations").join(F.broadcast(f), "canonical_key")
    return o.select("observation_id", "extracted_at", "field_name", F.array_join(rules.validate(F.col("field_type"), F.col("normalized_value")), ",").alias("errors"))


# --- export ---------------------------------------------------------------------------------------
_CELLS = "cells AS (SELECT patient_id, target_column AS column_key, arg_min_null(value_text, (created_at, candidate_id)) AS value FROM field_candidates WHERE target_column IS NOT NULL AND extraction_method = 'manual' GROUP BY ALL)"
_UPD = "upd AS (SELECT patient_id, target_column AS column_key, arg_max(value_text, (created_at, candidate_id)) AS value FROM field_candidates WHERE target_column IS NOT NULL AND extraction_method <> 'manual' AND value_text IS NOT NULL GROUP BY ALL)"
_EMPTY = "(existing IS NULL OR trim(existing, ' ') = '' OR lower(trim(existing, ' ')) = 'na')"


def _cells(s, d, manual: bool):
    f = load(s, d, "field_candidates").where("target_column is not null")
    f = f.where("extraction_method = 'manual'") if manual else f.where("extraction_method <> 'manual' and value_text is not null")
    pick = (F.min_by if manual else F.max_by)(F.struct("value_text"), F.struct("created_at", "candidate_id"))
    return f.groupBy("patient_id", F.col("target_column").alias("column_key")).agg(pick.alias("r")).select("patient_id", "column_key", F.col("r.value_text").alias("value"))


for _policy, _ok in (("empty_only", _EMPTY), ("always", "true"), ("never", "false")):
    def _part(s, d, p=_policy):
        return etl.partition_updates(_cells(s, d, False), _cells(s, d, True), p)

    add(
        f"overwrite_{_policy}",
        f"WITH {_CELLS}, {_UPD}, j AS (SELECT u.*, c.value AS existing FROM upd u LEFT JOIN cells c USING (patient_id, column_key)) "
        f"SELECT patient_id, column_key, value, {_ok} AS accepted, CASE WHEN NOT {_ok} AND NOT {_EMPTY} THEN existing END AS existing FROM j",
    )(_part)


@add(
    "registry_merge",
    f"""WITH {_CELLS}, {_UPD}, j AS (SELECT coalesce(c.patient_id, u.patient_id) AS patient_id, coalesce(c.column_key, u.column_key) AS column_key, c.value AS existing, u.value AS n FROM cells c FULL JOIN upd u ON c.patient_id = u.patient_id AND c.column_key = u.column_key)
SELECT patient_id, column_key, CASE WHEN n IS NOT NULL AND {_EMPTY} THEN n ELSE existing END AS value FROM j""",
)
def registry_merge(s, d):
    return etl.merge_cells(_cells(s, d, True), _cells(s, d, False), "empty_only")


@add(
    "patient_key_resolution",
    """WITH p AS (SELECT DISTINCT patient_id FROM parsed_documents WHERE patient_id IS NOT NULL), r AS (SELECT DISTINCT patient_id AS k FROM field_candidates), e AS (SELECT patient_id, CASE WHEN patient_id LIKE '%3' THEN 'REG-' || patient_id END AS x, CASE WHEN patient_id LIKE '%7' THEN 'MAP-' || patient_id END AS m FROM p)
SELECT e.patient_id, coalesce(x, m, e.patient_id) AS registry_key, CASE WHEN x IS NOT NULL THEN 'explicit' WHEN m IS NOT NULL THEN 'map_file' WHEN r.k IS NOT NULL THEN 'direct_match' ELSE 'pipeline_id' END AS source, q.k IS NOT NULL AS in_registry
FROM e LEFT JOIN r ON r.k = e.patient_id LEFT JOIN r q ON q.k = coalesce(x, m, e.patient_id)""",
)
def patient_key_resolution(s, d):
    p = load(s, d, "parsed_documents").where("patient_id is not null").select("patient_id").distinct()
    ex = p.withColumn("explicit", F.when(F.col("patient_id").like("%3"), F.concat(F.lit("REG-"), "patient_id")))
    m = p.where("patient_id like '%7'").select("patient_id", F.concat(F.lit("MAP-"), "patient_id").alias("mapped"))
    return etl.resolve_patients(ex, m, load(s, d, "field_candidates").select(F.col("patient_id").alias("registry_id")))


@add(
    "empty_sentinels",
    "SELECT target_column, count(*) FILTER (value_text IS NULL OR trim(value_text, ' ') = '' OR lower(trim(value_text, ' ')) = 'na') AS empty_values, count(*) FILTER (unit IS NULL OR trim(unit, ' ') = '' OR lower(trim(unit, ' ')) = 'na') AS empty_units, count(*) AS n FROM field_candidates GROUP BY 1",
)
def empty_sentinels(s, d):
    return load(s, d, "field_candidates").groupBy("target_column").agg(F.count_if(etl.is_empty_cell(F.col("value_text"))).alias("empty_values"), F.count_if(etl.is_empty_cell(F.col("unit"))).alias("empty_units"), F.count("*").alias("n"))


@add(
    "wide_pivot_export",
    f"""WITH {_UPD}, a AS (SELECT patient_id, f.field_name, value FROM upd JOIN field_defs f ON f.target_column = upd.column_key)
SELECT * FROM (PIVOT a ON field_name IN (SELECT field_name FROM field_defs) USING max(value) GROUP BY patient_id)""",
)
def wide_pivot_export(s, d):
    """One row per patient; a column for every field of the form."""
    fields = {r["target_column"]: r["field_name"] for r in load(s, d, "field_defs").select("target_column", "field_name").collect()}  # the form's fixed list
    u = _cells(s, d, False).where(F.col("column_key").isin(list(fields)))
    w = etl.wide(u, "patient_id", "column_key", "value", list(fields))
    return w.select("patient_id", *[F.col(f"`{c}`").alias(n) for c, n in fields.items()])


@add("header_map", "SELECT target_column AS header, min(candidate_id) AS ord, count(*) AS n FROM field_candidates GROUP BY 1")
def header_map(s, d):
    return etl.header_map(load(s, d, "field_candidates").select(F.col("target_column").alias("header"), F.col("candidate_id").alias("ord")))


@add("header_aliases", "WITH a AS (SELECT unnest(header_aliases) AS alias, target_column AS header FROM field_defs) SELECT candidate_id, coalesce(a.header, target_column) AS header FROM field_candidates c LEFT JOIN a ON c.target_column = a.alias")
def header_aliases(s, d):
    a = load(s, d, "field_defs").select(F.explode("header_aliases").alias("alias"), F.col("target_column").alias("header"))
    return etl.aliased(load(s, d, "field_candidates").select("candidate_id", "target_column"), a, "target_column").select("candidate_id", "header")


@add(
    "nested_template",
    """WITH l AS (SELECT document_id, coalesce(section, 'Uncategorized') AS section, coalesce(subsection, section, 'Uncategorized') AS subsection, name, arg_max(struct_pack(v := value, u := unit), (ord, line_id)) AS r FROM lab_lines WHERE name IS NOT NULL GROUP BY ALL)
SELECT document_id, section, subsection, name, CASE WHEN r.v.kind = 'n' THEN r.v.n END AS number, CASE WHEN r.v.kind = 's' THEN r.v.s END AS words, r.u AS unit, coalesce(r.v.kind = 'n', false) OR r.u IS NOT NULL AS declared FROM l""",
)
def nested_template(s, d):
    """The nested templates, read back leaf by leaf."""
    t = etl.lab_template(load(s, d, "lab_lines")).select("document_id", F.explode(evaluation.flatten_json("template")).alias("x"))
    return t.select("document_id", *[F.col("x.path")[i].alias(n) for i, n in enumerate(("section", "subsection", "name"))], F.col("x.value.n").alias("number"), F.col("x.value.s").alias("words"), "x.unit", F.col("x.declared").alias("declared"))


@add(
    "audit_trail",
    """WITH r AS (SELECT record_id, arg_max(struct_pack(step, document_id, confidence), (received_at, step)) AS r FROM audit_records GROUP BY 1)
SELECT r.step AS step, count(*) AS n_records, count(DISTINCT r.document_id) AS n_documents, round(avg(r.confidence), 6) AS mean_confidence FROM r GROUP BY 1""",
)
def audit_trail(s, d):
    return etl.audit_counts(load(s, d, "audit_records"))


@add("redacted_paths", "SELECT document_id, regexp_extract(source_path, '[^/\\\\]+$') AS file_name FROM parsed_documents")
def redacted_paths(s, d):
    return load(s, d, "parsed_documents").select("document_id", etl.redact_path(F.col("source_path")).alias("file_name"))


@add("sections_asof", "SELECT line_id, last_value(section IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY ord, line_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section_now FROM lab_lines")
def sections_asof(s, d):
    return etl.carry_forward(load(s, d, "lab_lines"), "document_id", ["ord", "line_id"], F.col("section"), "section_now").select("line_id", "section_now")


@add("flatten_details", "SELECT record_id, received_at, unnest(json_keys(details)) AS key, json_extract_string(details, '$.' || unnest(json_keys(details))) AS value FROM audit_records WHERE details IS NOT NULL")
def flatten_details(s, d):
    a = load(s, d, "audit_records").where("details is not null").select("record_id", "received_at", F.from_json("details", "map<string,string>").alias("m"))
    return a.select("record_id", "received_at", F.explode("m").alias("key", "value"))


# --- index ----------------------------------------------------------------------------------------
@add("index_upsert", "WITH n AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY indexed_at DESC, chunk_ord, char_start DESC NULLS LAST, text DESC) AS n FROM chunks WHERE chunk_id IS NOT NULL) SELECT chunk_id, document_id, chunk_ord, text, field_family, char_start, char_end, indexed_at FROM n WHERE n = 1")
def index_upsert(s, d):
    return index.upsert(load(s, d, "chunks")).select("chunk_id", "document_id", "chunk_ord", "text", "field_family", "char_start", "char_end", "indexed_at")


@add("index_delete", "SELECT document_id, count(*) AS deleted FROM chunks WHERE document_id IN (SELECT document_id FROM parsed_documents WHERE document_type_hint = 'unknown') GROUP BY 1")
def index_delete(s, d):
    return index.delete_documents(load(s, d, "chunks"), load(s, d, "parsed_documents").where("document_type_hint = 'unknown'"))[1]


@add(
    "version_preflight",
    """WITH o AS (SELECT observation_id, arg_max(struct_pack(d := document_id, v := schema_version), (extracted_at, document_id)) AS l, arg_min(struct_pack(d := document_id, v := schema_version), (extracted_at, document_id)) AS f FROM observations GROUP BY 1),
a AS (SELECT DISTINCT f.d AS document_id, f.v AS v FROM o WHERE f.v IS NOT NULL), b AS (SELECT DISTINCT l.d AS document_id, l.v AS v FROM o WHERE l.v IS NOT NULL)
SELECT a.document_id, a.v AS stored_version, b.v AS incoming_version FROM a JOIN b USING (document_id) WHERE a.v <> b.v""",
)
def version_preflight(s, d):
    """Stored: each observation as first delivered; incoming: as last delivered."""
    o = load(s, d, "observations").groupBy("observation_id")
    pick = [F.struct("document_id", F.col("schema_version").alias("version")), F.struct("extracted_at", "document_id")]
    stored, incoming = (o.agg(f(*pick).alias("r")).select("r.*") for f in (F.min_by, F.max_by))
    return index.version_conflicts(stored, incoming)


@add("tenant_names", "SELECT DISTINCT study_id, 'forms__' || substring(regexp_replace(study_id, '[^A-Za-z0-9_-]', '_', 'g'), 1, 60) AS collection FROM parsed_documents")
def tenant_names(s, d):
    return load(s, d, "parsed_documents").select("study_id", index.collection_of("forms", F.col("study_id")).alias("collection")).distinct()


@add(
    "point_ids",
    """WITH h AS (SELECT chunk_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(chunk_id)) AS h FROM (SELECT DISTINCT chunk_id FROM chunks))
SELECT chunk_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || ['8','9','a','b'][(strpos('0123456789abcdef', h[17:17]) - 1) % 4 + 1] || h[18:20] || '-' || h[21:32] AS point_id FROM h""",
)
def point_ids(s, d):
    return load(s, d, "chunks").select("chunk_id").distinct().select("chunk_id", index.point_id(F.col("chunk_id")).alias("point_id"))


# --- retrieval ------------------------------------------------------------------------------------
_FAMS = ("hematology", "coagulation", "hepatic_biochemistry", "inflammation_biomarkers", "imaging_recist", "comorbidities", "treatment_lines")


@add(
    "family_first_k",
    f"""WITH c AS (SELECT chunk_id, arg_max(struct_pack(document_id, chunk_ord, field_family), indexed_at) AS r FROM chunks GROUP BY 1),
f AS (SELECT r.document_id AS document_id, r.chunk_ord AS o, r.field_family AS ff, chunk_id, unnest({_list(_FAMS)}) AS family FROM c),
n AS (SELECT *, row_number() OVER (PARTITION BY document_id, family ORDER BY o, chunk_id) AS rank FROM f WHERE ff = family OR ff IS NULL)
SELECT document_id, family, rank::int AS rank, chunk_id, CASE WHEN ff IS NOT NULL THEN 0.88 ELSE 0.78 END::double AS score FROM n WHERE rank <= 5""",
)
def family_first_k(s, d):
    c = load(s, d, "chunks").groupBy("chunk_id").agg(F.max_by(F.struct("document_id", "chunk_ord", "field_family"), "indexed_at").alias("r")).select("chunk_id", "r.*")
    return retrieval.family_first_k(c, list(_FAMS), 5)


def _queries(s, d):
    docs = load(s, d, "documents").where("text is not null")
    return docs.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query")), docs.select(F.col("doc_id").alias("id"), "text")


# written from the rule: every passage scores, a repeated word of the query counts again, words count inside longer ones
@add(
    "lexical_search_topk",
    r"""WITH q AS (SELECT doc_id AS query_id, unnest(string_split_regex(trim(regexp_replace(lower(text), '\s+', ' ', 'g'), ' '), ' ')) AS w FROM documents WHERE doc_id % 100 = 0 AND text IS NOT NULL),
c AS (SELECT query_id, w, count(*) AS m FROM q WHERE length(w) > 2 GROUP BY ALL), p AS (SELECT doc_id AS id, lower(text) AS t FROM documents WHERE text IS NOT NULL),
x AS (SELECT DISTINCT w FROM c), h AS (SELECT id, w FROM p JOIN x ON contains(t, w)), n AS (SELECT query_id, id, sum(m) AS hits FROM c JOIN h USING (w) GROUP BY ALL),
r AS (SELECT a.query_id, p.id, round(least(1.0::double, 0.2::double + 0.15::double * coalesce(hits, 0)), 6) AS score FROM (SELECT DISTINCT query_id FROM (SELECT doc_id AS query_id FROM documents WHERE doc_id % 100 = 0 AND text IS NOT NULL)) a CROSS JOIN p LEFT JOIN n ON n.query_id = a.query_id AND n.id = p.id),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM r)
SELECT query_id, id, score, rank::int AS rank FROM k WHERE rank <= 10""",
)
def lexical_search_topk(s, d):
    q, p = _queries(s, d)
    return retrieval.lexical(q, p, 10)


_BM = r"""t AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM documents WHERE text IS NOT NULL), tf AS (SELECT id, term, count(*) AS tf FROM t GROUP BY ALL), dl AS (SELECT id, sum(tf) AS dl FROM tf GROUP BY 1),
st AS (SELECT count(*) AS n, avg(dl) AS a FROM dl), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), q AS (SELECT id AS query_id, term FROM tf WHERE id % 100 = 0),
s AS (SELECT query_id, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)::double) * tf * 2.2::double / (tf + 1.2::double * (0.25::double + 0.75::double * dl / a))), 6) AS score FROM tf JOIN q USING (term) JOIN df USING (term) JOIN dl USING (id), st GROUP BY ALL),
bm AS (SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s)"""


@add("bm25_topk", f"WITH {_BM} SELECT query_id, id, score, rank::int AS rank FROM bm WHERE rank <= 10")
def bm25_topk(s, d):
    q, p = _queries(s, d)
    return retrieval.bm25(q, p, 10)


@add(
    "rrf_fusion",
    f"""WITH {_BM}, e AS (SELECT DISTINCT query_id, id, rank FROM bm WHERE rank <= 20), l AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, id) AS rank FROM (SELECT q.query_id, tf.id, count(*) AS n FROM tf JOIN q USING (term) GROUP BY ALL)),
b AS (SELECT * FROM e UNION ALL SELECT query_id, id, rank FROM l WHERE rank <= 20), f AS (SELECT query_id, id, round(sum(1.0::double / (60 + rank)), 9) AS score FROM b GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM f)
SELECT query_id, id, score, rank::int AS rank FROM k WHERE rank <= 10""",
)
def rrf_fusion(s, d):
    q, p = _queries(s, d)
    return retrieval.fuse(retrieval.bm25(q, p, 20), retrieval.overlap(q, p, 20), 10)


@add(
    "rerank_topk",
    f"""WITH {_BM}, h AS (SELECT query_id, id, rank AS first_rank FROM bm WHERE rank <= 20), w AS (SELECT doc_id AS id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS l FROM documents WHERE text IS NOT NULL),
sh AS (SELECT query_id, h.id, first_rank, round(coalesce(len(list_intersect(a.l, b.l))::double / nullif(len(a.l), 0), 0.0), 6) AS score FROM h JOIN w a ON a.id = h.query_id JOIN w b ON b.id = h.id),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first_rank, id) AS rank FROM sh)
SELECT query_id, id, score, first_rank::int AS first_rank, rank::int AS rank FROM k WHERE rank <= 5""",
)
def rerank_topk(s, d):
    q, p = _queries(s, d)
    return retrieval.rerank(retrieval.bm25(q, p, 20), q, p, 5)


_COS = """c AS (SELECT q.vec_id AS query_id, e.vec_id AS id, round(list_cosine_similarity(q.embedding::double[], e.embedding::double[]), 6) AS score FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM c)"""


def _dense(s, d, k):
    e = load(s, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return retrieval.dense(e.where("id % 100 = 0").select(F.col("id").alias("query_id"), "embedding"), e, k)


@add("dense_topk_cosine", f"WITH {_COS} SELECT query_id, id, score, rank::int AS rank FROM k WHERE rank <= 10")
def dense_topk_cosine(s, d):
    return _dense(s, d, 10)


@add(
    "retrieval_recall_at_k",
    f"""WITH {_COS}, r AS (SELECT q.vec_id AS query_id, e.vec_id AS id FROM embeddings q JOIN embeddings e ON q.label = e.label WHERE q.vec_id % 100 = 0), n AS (SELECT query_id, count(*) AS n FROM r GROUP BY 1),
f AS (SELECT query_id, count(*) FILTER (rank <= 1) AS f1, count(*) FILTER (rank <= 5) AS f5, count(*) FILTER (rank <= 10) AS f10 FROM k JOIN r USING (query_id, id) GROUP BY 1)
SELECT query_id, round(coalesce(f1, 0)::double / n, 6) AS recall_1, round(coalesce(f5, 0)::double / n, 6) AS recall_5, round(coalesce(f10, 0)::double / n, 6) AS recall_10 FROM n LEFT JOIN f USING (query_id)""",
)
def retrieval_recall_at_k(s, d):
    """Relevant are all vectors of the query's label: counted per label, never paired."""
    e = load(s, d, "embeddings").select("vec_id", "label")
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "label")
    return retrieval.recall_by_label(_dense(s, d, 10), q, e.select(F.col("vec_id").alias("id"), "label"), [1, 5, 10])


# --- evaluation -----------------------------------------------------------------------------------
def _forms(s, d, method: str, name: str):
    f = load(s, d, "field_candidates").where(F.col("extraction_method") == method).where("target_column is not null")
    return f.groupBy("patient_id", "target_column").agg(F.max_by(F.struct("value_text", "unit"), F.struct("created_at", "candidate_id")).alias("r")).select("patient_id", "target_column", F.when(~etl.is_empty_cell(F.col("r.value_text")), F.trim("r.value_text")).alias(name), F.when(~etl.is_empty_cell(F.col("r.unit")), F.col("r.unit")).alias(f"{name}_unit"))


def _duck_form(method: str, n: str) -> str:
    e = lambda c: f"({c} IS NULL OR trim({c}, ' ') = '' OR lower(trim({c}, ' ')) = 'na')"
    return (
        f"SELECT patient_id, target_column, CASE WHEN NOT {e('v')} THEN trim(v, ' ') END AS {n}, CASE WHEN NOT {e('u')} THEN u END AS {n}_unit FROM (SELECT patient_id, target_column, arg_max(struct_pack(a := value_text, b := unit), (created_at, candidate_id)).a AS v, "
        f"arg_max(struct_pack(a := value_text, b := unit), (created_at, candidate_id)).b AS u FROM field_candidates WHERE extraction_method = '{method}' AND target_column IS NOT NULL GROUP BY ALL)"
    )


_CU = lambda c: f"CASE replace(replace(lower(trim({c}, ' ')), 'μ', 'µ'), ' ', '') WHEN 'ui/l' THEN 'u/l' WHEN 'iu/l' THEN 'u/l' WHEN 'µmol/l' THEN 'umol/l' WHEN 'µg/l' THEN 'ug/l' ELSE replace(replace(lower(trim({c}, ' ')), 'μ', 'µ'), ' ', '') END"
_NUMD = lambda c: f"try_cast(replace({c}, ',', '.') AS double)"
_OUT = f"""gold AS ({_duck_form('manual', 'g')}), pred AS ({_duck_form('lab_regex', 'p')}),
o AS (SELECT gold.patient_id, gold.target_column, CASE WHEN g IS NOT NULL AND p IS NOT NULL AND coalesce(CASE WHEN {_NUMD('g')} IS NOT NULL AND {_NUMD('p')} IS NOT NULL THEN abs({_NUMD('g')} - {_NUMD('p')}) <= greatest(1e-6 * greatest(abs({_NUMD('g')}), abs({_NUMD('p')})), 1e-6) ELSE lower(g) = lower(p) END, false)
  AND (g_unit IS NULL OR ({_CU('g_unit')}) IS NOT DISTINCT FROM ({_CU('p_unit')})) THEN 'match' WHEN g IS NOT NULL AND p IS NOT NULL THEN 'wrong_value' WHEN g IS NOT NULL THEN 'missing' WHEN p IS NOT NULL THEN 'false_fill' ELSE 'true_empty' END AS outcome
  FROM gold LEFT JOIN pred USING (patient_id, target_column))"""


def _outcomes(s, d):
    num = lambda c: F.replace(F.col(c), F.lit(","), F.lit(".")).try_cast("double")
    match = F.coalesce(F.when(num("g").isNotNull() & num("p").isNotNull(), evaluation.numbers_match(num("g"), num("p"))).otherwise(F.lower("g") == F.lower("p")), F.lit(False))
    return evaluation.outcomes(_forms(s, d, "manual", "g"), _forms(s, d, "lab_regex", "p"), ["patient_id", "target_column"], match).select("patient_id", "target_column", "outcome")


add("field_outcomes", f"WITH {_OUT} SELECT * FROM o")(_outcomes)
_MET = f"""{_OUT}, c AS (SELECT target_column, count(*) AS eligible, count(*) FILTER (outcome IN ('match', 'wrong_value')) AS tp, count(*) FILTER (outcome = 'false_fill') AS fp, count(*) FILTER (outcome = 'missing') AS fn,
 count(*) FILTER (outcome IN ('match', 'wrong_value', 'false_fill')) AS predicted, count(*) FILTER (outcome = 'match') AS correct FROM o GROUP BY ROLLUP (target_column)),
m AS (SELECT *, tp / nullif(tp + fp, 0)::double AS p, tp / nullif(tp + fn, 0)::double AS q FROM c)"""


@add(
    "field_metrics",
    f"WITH {_MET} SELECT target_column, eligible, tp, fp, fn, predicted, correct, round(p, 6) AS precision, round(q, 6) AS recall, round(CASE WHEN p + q = 0 THEN 0.0 ELSE 2 * p * q / (p + q) END, 6) AS f1, round(predicted / nullif(eligible, 0)::double, 6) AS autofill_rate, "
    "round(fp / nullif(predicted, 0)::double, 6) AS false_autofill_rate, round(correct / nullif(tp, 0)::double, 6) AS value_accuracy FROM m",
)
def field_metrics(s, d):
    return evaluation.metrics(evaluation.counts(_outcomes(s, d), ["target_column"]))


@add("macro_metrics", f"WITH {_MET} SELECT round(avg(round(p, 6)), 6) AS macro_precision, round(avg(round(q, 6)), 6) AS macro_recall FROM m WHERE target_column IS NOT NULL")
def macro_metrics(s, d):
    m = evaluation.metrics(evaluation.counts(_outcomes(s, d), ["target_column"])).where("target_column is not null")
    return evaluation.macro(m, ["precision", "recall"])


@add("out_of_template", "SELECT DISTINCT c.target_column FROM field_candidates c WHERE c.target_column IS NOT NULL AND c.target_column NOT IN (SELECT target_column FROM field_defs)")
def out_of_template(s, d):
    c = load(s, d, "field_candidates").where("target_column is not null").select("target_column").distinct()
    return evaluation.out_of_template(c, load(s, d, "field_defs"), ["target_column"])


@add(
    "dataset_discovery",
    """WITH u AS (SELECT document_id, 0 AS i FROM parsed_documents UNION ALL SELECT document_id, 1 FROM lab_lines UNION ALL SELECT document_id, 2 FROM chunks UNION ALL SELECT document_id, 3 FROM observations),
h AS (SELECT document_id AS sample_id, max((i = 0)::int) AS a, max((i = 1)::int) AS b, max((i = 2)::int) AS c, max((i = 3)::int) AS e FROM u WHERE document_id IS NOT NULL GROUP BY 1)
SELECT sample_id, a + b + c + e = 4 AS complete, concat_ws(',', CASE WHEN a = 0 THEN 'report' END, CASE WHEN b = 0 THEN 'lines' END, CASE WHEN c = 0 THEN 'chunks' END, CASE WHEN e = 0 THEN 'observations' END) AS missing FROM h""",
)
def dataset_discovery(s, d):
    return evaluation.discover({n: load(s, d, t) for n, t in (("report", "parsed_documents"), ("lines", "lab_lines"), ("chunks", "chunks"), ("observations", "observations"))}, "document_id")


@add("values_match_tolerance", "SELECT count(*) AS n, count(*) FILTER (abs(a - b) <= greatest(1e-6 * greatest(abs(a), abs(b)), 1e-6)) AS matching FROM (SELECT l_extendedprice AS a, round(l_extendedprice / 3, 4) * 3 AS b FROM lineitem)")
def values_match_tolerance(s, d):
    x = load(s, d, "lineitem").select(F.col("l_extendedprice").alias("a"), (F.round(F.col("l_extendedprice") / 3, 4) * 3).alias("b"))
    return x.agg(F.count("*").alias("n"), F.count_if(evaluation.numbers_match(F.col("a"), F.col("b"))).alias("matching"))


@add("normalize_text", "SELECT canonical_key, trim(regexp_replace(replace(strip_accents(lower(regexp_replace(label_fr, '[µμœŒæÆαβγ]', '', 'g'))), ',', '.'), '[^a-z0-9.]+', ' ', 'g'), ' ') AS label FROM analyte_ref")
def normalize_text(s, d):
    return load(s, d, "analyte_ref").select("canonical_key", evaluation.normal_text(F.col("label_fr")).alias("label"))


@add("canonical_units", f"SELECT DISTINCT unit, {_CU('unit')} AS canonical FROM lab_lines")
def canonical_units(s, d):
    return load(s, d, "lab_lines").select("unit", evaluation.canonical_unit(F.col("unit")).alias("canonical")).distinct()


_NT = lambda c: f"trim(regexp_replace(replace(strip_accents(lower(regexp_replace({c}, '[µμœŒæÆαβγ]', '', 'g'))), ',', '.'), '[^a-z0-9.]+', ' ', 'g'), ' ')"


@add(
    "silver_judgments",
    f"""WITH c AS (SELECT chunk_id, arg_max(struct_pack(d := document_id, t := text), (indexed_at, -chunk_ord)) AS r FROM chunks WHERE chunk_id IS NOT NULL GROUP BY 1),
n AS (SELECT chunk_id, r.d AS d, {_NT('r.t')} AS t FROM c),
f AS (SELECT line_id, document_id, {_NT('name')} AS l, {_NT('unit')} AS u, list_filter(CASE WHEN value.kind = 'n' THEN [{_NT("CASE WHEN value.n = floor(value.n) THEN value.n::bigint::varchar || '.0' ELSE value.n::varchar END")}, CASE WHEN value.n = floor(value.n) THEN value.n::bigint::varchar END] ELSE [{_NT('value.s')}] END, lambda x: x <> '') AS v
  FROM lab_lines WHERE (value.kind = 'n' AND value.n IS NOT NULL) OR (value.kind = 's' AND value.s IS NOT NULL)),
h AS (SELECT f.line_id, count(chunk_id) AS n, count(chunk_id) FILTER (u <> '' AND contains(t, u)) AS nu, min(chunk_id) AS one, min(chunk_id) FILTER (u <> '' AND contains(t, u)) AS one_u
  FROM f LEFT JOIN n ON n.d = f.document_id AND contains(t, l) AND len(list_filter(v, lambda x: contains(t, x))) > 0 GROUP BY 1),
e AS (SELECT line_id, CASE WHEN n > 1 AND nu > 0 THEN nu ELSE n END AS n, CASE WHEN n > 1 AND nu > 0 THEN one_u ELSE one END AS one FROM h)
SELECT line_id::varchar AS path, CASE n WHEN 1 THEN 'matched' WHEN 0 THEN 'unmatched' ELSE 'ambiguous' END AS status, CASE WHEN n = 1 THEN one END AS chunk_id FROM e""",
)
def silver_judgments(s, d):
    f = load(s, d, "lab_lines").select(F.col("document_id").alias("sample_id"), F.col("line_id").cast("string").alias("path"), F.col("name").alias("label"), "value", "unit")
    c = index.upsert(load(s, d, "chunks"))
    return evaluation.silver_judgments(f, c.select(F.col("document_id").alias("sample_id"), "chunk_id", "text")).select("path", "status", "chunk_id")


# --- streams --------------------------------------------------------------------------------------
@add("stream_best_value", "SELECT user_id, event_type, arg_max(event_id, (value, -event_id)) AS event_id, max(value) AS value FROM events WHERE value IS NOT NULL GROUP BY ALL")
def stream_best_value(s, d):
    folder, glob = ingest.table_folder(d, "events")
    schema = load(s, d, "events").schema
    rows = ingest.best_value_stream(s, folder, schema, ["user_id", "event_type"], [F.col("value"), -F.col("event_id")], ["event_id", "value"], glob=glob)
    return rows.where("value is not null")


@add("windowed_counts", "SELECT time_bucket(interval 1 hour, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def windowed_counts(s, d):
    return ingest.windowed_counts(load(s, d, "events"), "ts", "event_type").withColumn("total", F.round("total", 4))
