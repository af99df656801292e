"""Queries of routing, sections, chunks, jobs, candidates, index, search, form and evaluation stages, and of the whole run, with SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from formloom import pipeline, runner
from formloom.operators import chunking, etl, evaluation, extraction, index, labrows, parsing, retrieval, rules
from formloom.plans import domain
from formloom.plans.registry import Registry
from formloom.session import bounded, cut, load
from formloom.sources import files

registry = Registry()
add = registry.add
RUN_DATE = "2026-01-01"


def _scores(table: str, key: str, text: str) -> str:
    """The scores of the classifier for any table."""
    a = domain._SCORES.replace("SELECT doc_id, text,", f"SELECT {key} AS doc_id, {text} AS text,").replace("substring(text, 1, 18000)", f"substring({text}, 1, 18000)").replace("FROM documents", f"FROM {table}")
    return a


_TYPES = f"""{_scores('parsed_documents', 'document_id', 'full_text')}, {domain._STATS},
a AS (SELECT scored.*, n_lines, p, v, m, 0.52 * least(1.0, lab_score / 6.25::double) + 0.35 * least(1.0, 0.42 * p + 0.38 * least(1.0, v * 12.0) + 0.08 * v) + 0.13 * least(1.0, (p + v) / 1.2::double) AS l0,
  CASE WHEN ctx THEN 0.86::double ELSE least(1.0, 0.22 + least(1.0, ({domain._IMG})::double)) END AS ib, least(1.0, 0.28 * least(1.0, m / 95.0::double) + 0.32 * (1.0 - p) + 0.18 * least(1.0, n_lines / 80.0::double)) AS nar,
  CASE WHEN regexp_matches(s, '{domain._PC}') THEN 0.75::double ELSE 0.0 END AS pc, least(1.0, 0.28::double * len(regexp_extract_all(s, '{domain._PS}'))) AS ps, least(1.0, 0.38::double * len(regexp_extract_all(s, '{domain._LT}'))) AS lt FROM scored JOIN stats USING (doc_id)),
b AS (SELECT *, CASE WHEN ctx THEN l0 * CASE WHEN l0 < 0.58 THEN 0.38 ELSE 0.82 END ELSE l0 END AS l1, least(1.0, ib * (0.62 + 0.38 * nar)) AS i0, least(1.0, greatest(pc, ps * 1.15, 0.55 * (pc + ps))) AS p1 FROM a),
c AS (SELECT *, CASE WHEN pc >= 0.7 THEN i0 * 0.52 WHEN greatest(pc, ps) >= 0.42 AND p1 >= i0 - 0.14 AND l1 < 0.62 THEN i0 * 0.72 ELSE i0 END AS i1 FROM b),
f AS (SELECT doc_id, text, ctx, lab_score, round(l1, 4) AS x1, round(i1, 4) AS x2, round(p1, 4) AS x3, round(lt, 4) AS x4 FROM c), g AS (SELECT *, list_reverse_sort([x1, x2, x3, x4]) AS r FROM f),
types AS (SELECT doc_id AS document_id, trim(text, ' ') <> '' AND lab_score >= CASE WHEN ctx THEN 6 ELSE 4 END AS probable_lab,
  CASE WHEN text IS NULL OR r[1] < 0.33 OR r[1] - r[2] < 0.055 THEN 'unknown' WHEN r[1] = x1 THEN 'lab_blood_panel' WHEN r[1] = x2 THEN 'imaging_report' WHEN r[1] = x3 THEN 'pathology_report' ELSE 'clinical_letter' END AS guess FROM g)"""
_ROUTED = f"""{_TYPES},
routed AS (SELECT d.document_id, contains(lower(coalesce(mime_type, '')), 'pdf') OR ends_with(lower(coalesce(source_path, '')), '.pdf') AS is_pdf, coalesce(probable_lab, false) AS probable_lab,
  CASE WHEN coalesce(document_type_hint, 'unknown') NOT IN ('unknown', '') THEN document_type_hint ELSE guess END AS document_type FROM parsed_documents d JOIN types USING (document_id))"""


@add("smart_route", f"WITH {_ROUTED} SELECT document_id, is_pdf, probable_lab, document_type, CASE WHEN NOT is_pdf THEN NULL WHEN probable_lab THEN 'lab_rows' WHEN document_type = 'imaging_report' THEN 'imaging_full' ELSE 'sections' END AS chunking_strategy FROM routed")
def smart_route(s, d):
    return parsing.smart_route(load(s, d, "parsed_documents"), hint="document_type_hint").select("document_id", "is_pdf", "probable_lab", "document_type", "chunking_strategy")


# --- sections ---------------------------------------------------------------------------------------
_SEG = domain.registry.sql["segment_lines"].split("\nSELECT document_id, section_ord")[0] + ",\nseg AS (SELECT document_id, section_ord" + domain.registry.sql["segment_lines"].split("\nSELECT document_id, section_ord")[1] + ")"


def _segments(s, d):
    return parsing.segment(load(s, d, "parsed_documents"), "document_id", "full_text", "document_type_hint")


@add("aligned_text", f"{_SEG} SELECT document_id, string_agg(trim(body, ' '), chr(10) || chr(10) ORDER BY section_ord) AS full_text FROM seg WHERE trim(body, ' ') <> '' GROUP BY 1")
def aligned_text(s, d):
    return parsing.joined_bodies(_segments(s, d), "document_id")


_ADMIN = r"""CASE WHEN section_ord = 0 AND length(t) <= 280 AND (regexp_matches(lower(t), '(?:^|[^\pL\pN_])(?:hôpital|hopital|chu|clinique|centre hospitalier|ap-hp|institut|laboratoire)(?:[^\pL\pN_]|$)')
 OR (length(t) <= 120 AND contains(lower(t), 'service') AND contains(lower(t), 'radiologie'))) THEN 'admin_section' ELSE 'clinical_section' END"""


@add("section_kinds", f"{_SEG} SELECT document_id, section_ord, {_ADMIN} AS section_kind FROM (SELECT *, concat_ws(' ', heading, body) AS t FROM seg)")
def section_kinds(s, d):
    return _segments(s, d).select("document_id", "section_ord", parsing.section_kind(F.col("section_ord"), F.col("heading"), F.col("body")).alias("section_kind"))


# sections of a parser: the Markdown split of the text, a document of every three as one with layout
_MD = domain.registry.sql["markdown_sections"].replace("\nSELECT * FROM v WHERE heading IS NOT NULL OR body <> ''", ",\nmd AS (SELECT * FROM v WHERE heading IS NOT NULL OR body <> '')")
_CLEAN = r"""array_to_string(list_filter(list_transform(string_split_regex(body, '\r?\n'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'), ' ')),
 lambda c: c <> '' AND NOT regexp_matches(c, '(?i)^page\s+[0-9]+\b') AND NOT regexp_matches(c, '(?i)^--\s*[0-9]+\s+of\s+[0-9]+\s*--$') AND NOT regexp_matches(c, '(?i)^labo .*tel[:\s]')), chr(10))"""


def _existing(s, d):
    t = load(s, d, "parsed_documents").where("full_text is not null").select("document_id", F.regexp_replace("full_text", r"\n\n+", "\n## ").alias("t"))
    md = parsing.markdown_sections(t, "document_id", "t")
    return md.withColumn("source", F.when(F.ascii(F.right("document_id", F.lit(1))) % 3 == 0, "layout_graph").otherwise("text_split"))


@add(
    "section_policy",
    f"""{_MD}, e AS (SELECT document_id, section_ord, heading, {_CLEAN} AS body, CASE WHEN ascii(right(document_id, 1)) % 3 = 0 THEN 'layout_graph' ELSE 'text_split' END AS source FROM md),
q AS (SELECT document_id FROM e GROUP BY 1 HAVING (bool_or(starts_with(source, 'layout')) AND count(*) FILTER (trim(body, ' ') <> '') >= 1) OR (count(*) > 1 AND count(*) FILTER (trim(body, ' ') <> '') >= 2)),
{_SEG[5:]}
SELECT document_id, section_ord, heading, body, source FROM e WHERE trim(body, ' ') <> '' AND document_id IN (FROM q) UNION ALL SELECT document_id, section_ord, heading, body, 'segmenter' FROM seg WHERE document_id NOT IN (FROM q)""",
)
def section_policy(s, d):
    return parsing.choose_sections(_segments(s, d), _existing(s, d), "document_id")


def _items(s, d):
    """The lines of every document as layout items, labelled by what they look like."""
    line = F.trim("line")
    label = (
        F.when(line.rlike(r"^[A-ZÀ-Ÿ][A-ZÀ-Ÿ ]{3,40}:?\z"), "section_header").when(F.lower(line).rlike("^page [0-9]"), "page_footer").when(F.lower(line).rlike("^labo "), "page_header").when(line.startswith("|"), "table")
        .when(line.rlike(r"^\.{3,}\z"), "picture").otherwise("text")
    )
    x = load(s, d, "parsed_documents").select("document_id", F.posexplode(F.split("full_text", "\n")).alias("ord", "line"))
    return x.select("document_id", "ord", label.alias("label"), F.when(label != "picture", line).alias("text"))


_ITEMS = r"""i0 AS (SELECT document_id, trim(unnest(string_split(full_text, chr(10))), ' ') AS line, generate_subscripts(string_split(full_text, chr(10)), 1) - 1 AS ord FROM parsed_documents),
items AS (SELECT document_id, ord, CASE WHEN regexp_matches(line, '^[A-ZÀ-Ÿ][A-ZÀ-Ÿ ]{3,40}:?\z') THEN 'section_header' WHEN regexp_matches(lower(line), '^page [0-9]') THEN 'page_footer' WHEN regexp_matches(lower(line), '^labo ') THEN 'page_header' WHEN starts_with(line, '|') THEN 'table'
 WHEN regexp_matches(line, '^\.{3,}\z') THEN 'picture' ELSE 'text' END AS label, CASE WHEN NOT regexp_matches(line, '^\.{3,}\z') THEN line END AS text FROM i0)"""


@add(
    "layout_sections",
    f"""WITH {_ITEMS}, w AS (SELECT *, sum((label IN ('title', 'section_header'))::int) OVER (PARTITION BY document_id ORDER BY ord) AS section_ord, CASE WHEN label = 'picture' THEN coalesce(nullif(text, ''), '<!-- figure -->') ELSE text END AS shown FROM items)
SELECT document_id, section_ord::bigint AS section_ord, max(CASE WHEN label IN ('title', 'section_header') AND text <> '' THEN text END) AS heading, string_agg(CASE WHEN label NOT IN ('title', 'section_header', 'page_header', 'page_footer') AND shown <> '' THEN shown END, chr(10) || chr(10) ORDER BY ord) AS body
FROM w GROUP BY ALL HAVING count(*) FILTER (label NOT IN ('title', 'section_header', 'page_header', 'page_footer') AND shown <> '') > 0""",
)
def layout_sections(s, d):
    return parsing.layout_sections(_items(s, d), "document_id")[0].drop("source")


@add(
    "layout_counters",
    f"""WITH {_ITEMS} SELECT document_id, count(*) FILTER (label = 'table' AND text <> '') AS n_tables, count(*) FILTER (label = 'text' AND text <> '') AS n_texts, count(*) FILTER (label = 'picture') AS n_pictures, count(*) FILTER (label = 'section_header') AS n_headings,
count(*) FILTER (label IN ('page_header', 'page_footer') AND text <> '') AS n_aside FROM items GROUP BY 1""",
)
def layout_counters(s, d):
    return parsing.layout_sections(_items(s, d), "document_id")[1]


@add(
    "layout_or_markdown",
    f"""{_MD}, {_ITEMS}, w AS (SELECT *, sum((label = 'section_header')::int) OVER (PARTITION BY document_id ORDER BY ord) AS so, CASE WHEN label = 'picture' THEN '<!-- figure -->' ELSE text END AS shown FROM items),
gr AS (SELECT document_id, so FROM w GROUP BY ALL HAVING count(*) FILTER (label NOT IN ('section_header', 'page_header', 'page_footer') AND shown <> '') > 0),
n AS (SELECT d.document_id, d.full_text, (SELECT count(*) FROM gr WHERE gr.document_id = d.document_id) AS g, (SELECT count(*) FROM md WHERE md.document_id = d.document_id) AS m FROM parsed_documents d)
SELECT document_id, CASE WHEN g < 2 AND m > g THEN 'layout_markdown' WHEN g = 0 THEN 'full_text' ELSE 'layout_graph' END AS source, CASE WHEN g < 2 AND m > g THEN m WHEN g = 0 THEN 1 ELSE g END::bigint AS n FROM n WHERE g > 0 OR m > 0 OR trim(full_text, ' ') <> ''""",
)
def layout_or_markdown(s, d):
    docs = load(s, d, "parsed_documents")
    g = parsing.layout_sections(_items(s, d), "document_id")[0]
    t = docs.where("full_text is not null").select("document_id", F.regexp_replace("full_text", r"\n\n+", "\n## ").alias("t"))
    m = parsing.markdown_sections(t, "document_id", "t")
    return parsing.layout_or_markdown(g, m, docs.select("document_id", "full_text"), "document_id").groupBy("document_id", "source").agg(F.count("*").alias("n"))


# --- chunks -----------------------------------------------------------------------------------------
_TRIM = "trim({0}, ' ' || chr(9) || chr(13) || chr(10))"


@add(
    "imaging_chunks",
    f"""WITH t AS (SELECT document_id, {_TRIM.format('full_text')} AS t FROM parsed_documents)
SELECT document_id, 0 AS chunk_ord, 'chk_' || substring(sha256(document_id || ':imaging:0:' || t), 1, 16) AS chunk_id, t AS text, 'imaging_recist' AS field_family, 0 AS char_start, length(t)::int AS char_end FROM t WHERE t <> '' AND length(t) <= 12000
UNION ALL SELECT document_id, -1, NULL, NULL, NULL, NULL, length(t)::int FROM t WHERE length(t) > 12000""",
)
def imaging_chunks(s, d):
    """Chunks of whole reports; of a split report only that its parts end where the text does."""
    docs = load(s, d, "parsed_documents")
    c = chunking.imaging_chunks(docs, "document_id", "full_text")
    one = ["document_id", "chunk_ord", "chunk_id", "text", "field_family", "char_start", "char_end"]
    n = c.groupBy("document_id").agg(F.count("*").alias("n"), F.max("char_end").alias("end"))
    whole = c.join(n.where("n = 1").select("document_id"), "document_id", "left_semi").select(*one)
    none = F.lit(None)
    split = n.where("n > 1").select("document_id", F.lit(-1).alias("chunk_ord"), none.cast("string").alias("chunk_id"), none.cast("string").alias("text"), none.cast("string").alias("field_family"), none.cast("int").alias("char_start"), F.col("end").alias("char_end"))
    return whole.unionByName(split)


@add(
    "section_chunks",
    f"""{_SEG}, b AS (SELECT document_id, section_ord, heading, trim(body, ' ') AS t FROM seg WHERE trim(body, ' ') <> ''),
o AS (SELECT *, coalesce(sum(length(t) + 2) OVER (PARTITION BY document_id ORDER BY section_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base, row_number() OVER (PARTITION BY document_id ORDER BY section_ord) - 1 AS n FROM b)
SELECT document_id, n::int AS chunk_ord, 'chk_' || substring(sha256(document_id || ':' || section_ord || ':0:' || t), 1, 16) AS chunk_id, t AS text, heading, base::int AS char_start, (base + length(t))::int AS char_end, true AS verified FROM o WHERE length(t) <= 12000""",
)
def section_chunks(s, d):
    """Chunks of sections within the limit, placed in the joined text."""
    seg = _segments(s, d)
    c = chunking.section_chunks(seg, parsing.joined_bodies(seg, "document_id"), "document_id", "full_text")
    return c.where(F.length("text") <= chunking.IMAGING_CHARS).select("document_id", "chunk_ord", "chunk_id", "text", "heading", "char_start", "char_end", "verified")


@add("passages", "SELECT chunk_id, indexed_at, chunk_ord, CASE WHEN trim(field_family, ' ') <> '' AND trim(text, ' ') <> '' THEN trim(field_family, ' ') || chr(10) || trim(text, ' ') ELSE coalesce(nullif(trim(field_family, ' '), ''), trim(text, ' ')) END AS passage FROM chunks")
def passages(s, d):
    return load(s, d, "chunks").select("chunk_id", "indexed_at", "chunk_ord", chunking.passage(F.col("field_family"), F.col("text")).alias("passage"))


@add(
    "metadata_propagation",
    """SELECT record_id, received_at, step, map_keys(m) AS keys FROM (SELECT record_id, received_at, step, map_from_entries(list_sort(list_filter([{'k': 'step', 'v': step}, {'k': 'model', 'v': model_name}, {'k': 'chunk', 'v': source_chunk_id}], lambda e: e.v IS NOT NULL))) AS m FROM audit_records)""",
)
def metadata_propagation(s, d):
    """Section metadata (step, model, chunk and a reserved key) put into chunk metadata that has a step of its own."""
    a = load(s, d, "audit_records")
    own = F.create_map(F.lit("step"), F.col("step"))
    entry = lambda k, c: F.struct(F.lit(k).alias("key"), c.cast("string").alias("value"))
    section = F.map_from_entries(F.filter(F.array(entry("model", F.col("model_name")), entry("chunk", F.col("source_chunk_id")), entry("chunker", F.col("study_id")), entry("step", F.lit("other"))), lambda e: e["value"].isNotNull()))
    m = chunking.propagated(own, section)
    return a.select("record_id", "received_at", F.try_element_at(m, F.lit("step")).alias("step"), F.array_sort(F.map_keys(m)).alias("keys"))


@add(
    "lines_to_sections",
    "WITH g AS (SELECT document_id, section, min(ord) AS o, string_agg(raw_text, chr(10) ORDER BY ord, raw_text) AS body FROM lab_lines WHERE raw_text IS NOT NULL GROUP BY ALL) SELECT document_id, (row_number() OVER (PARTITION BY document_id ORDER BY o, section NULLS FIRST) - 1)::int AS section_ord, section AS heading, body FROM g",
)
def lines_to_sections(s, d):
    return labrows.sections_of_lines(load(s, d, "lab_lines"), "document_id")


@add("lab_rows_enriched")
def lab_rows_enriched(s, d):
    """Report rows of both readers over every document; the layouts are tested one by one."""
    seg = _segments(s, d)
    return labrows.enrich(load(s, d, "parsed_documents"), "document_id", "full_text", seg)


# --- jobs and extraction ----------------------------------------------------------------------------------
@add("job_families", "WITH f AS (SELECT unnest(document_types_allowed) AS document_type, field_family, coalesce(extraction_strategy, 'x') AS s FROM field_defs) SELECT DISTINCT document_type, field_family FROM f WHERE s <> 'none'")
def job_families(s, d):
    return extraction.families_of(extraction.plan_jobs(load(s, d, "field_defs")))


@add("jobs_sorted", domain.registry.sql["plan_jobs"].replace("SELECT document_type, strategy, field_family, canonical_keys, field_names, array_to_string", "SELECT document_type, strategy, field_family, row_number() OVER (PARTITION BY document_type ORDER BY strategy, field_family)::int AS n, array_to_string").replace(" AS classes, derive_recist FROM g", " AS classes FROM g"))
def jobs_sorted(s, d):
    from pyspark.sql.window import Window

    j = extraction.plan_jobs(load(s, d, "field_defs"))
    return j.select("document_type", "strategy", "field_family", F.row_number().over(Window.partitionBy("document_type").orderBy("strategy", "field_family")).alias("n"), "classes")


@add("fields_per_family", "SELECT extraction_family, field_family, count(*) AS n_fields FROM field_defs GROUP BY ALL")
def fields_per_family(s, d):
    return files.fields_per_family(load(s, d, "field_defs"))


_JOBS = domain.registry.sql["plan_jobs"].replace("\nSELECT document_type", ",\njobs AS (SELECT document_type", 1) + ")"
_HITS = """latest AS (SELECT chunk_id, arg_max(struct_pack(d := document_id, o := chunk_ord, t := text, f := field_family), (indexed_at, -chunk_ord)) AS r FROM chunks WHERE chunk_id IS NOT NULL GROUP BY 1),
fam AS (SELECT DISTINCT document_type, field_family FROM jobs),
x AS (SELECT p.document_id, p.document_type_hint AS document_type, fam.field_family, l.chunk_id, l.r.o AS chunk_ord, l.r.t AS text, CASE WHEN l.r.f IS NULL THEN 0.78 ELSE 0.88 END::double AS retrieval_score,
  row_number() OVER (PARTITION BY p.document_id, fam.field_family ORDER BY l.r.o, l.chunk_id) AS rank FROM latest l JOIN parsed_documents p ON p.document_id = l.r.d JOIN fam ON fam.document_type = p.document_type_hint WHERE l.r.f IS NULL OR l.r.f = fam.field_family),
hits AS (SELECT * FROM x WHERE rank <= 5)"""


def _hits(s, d):
    jobs = extraction.plan_jobs(load(s, d, "field_defs"))
    docs = load(s, d, "parsed_documents").select("document_id", F.col("document_type_hint").alias("document_type"))
    return pipeline.family_hits(index.upsert(load(s, d, "chunks")), docs, jobs, 5), jobs


@add("job_hits", f"{_JOBS}, {_HITS} SELECT document_id, document_type, field_family, rank::int AS rank, chunk_id, retrieval_score FROM hits")
def job_hits(s, d):
    return _hits(s, d)[0].select("document_id", "document_type", "field_family", "rank", "chunk_id", "retrieval_score")


@add("best_per_family", f"{_JOBS}, {_HITS} SELECT document_id, field_family AS family, max(retrieval_score) AS best_score FROM hits GROUP BY ALL")
def best_per_family(s, d):
    return retrieval.best_per_family(_hits(s, d)[0].select("document_id", F.col("field_family").alias("family"), F.col("retrieval_score").alias("score")))


_LABJOB = " UNION ALL ".join(
    f"SELECT h.document_id, h.chunk_id, h.field_family, '{k}' AS canonical_key, try_cast(replace(regexp_extract(text, '(?i){p}', 1), ',', '.') AS double) AS value, " + (f"'{u}'" if u else "NULL")
    + f" AS unit FROM hits h JOIN jobs j USING (document_type, field_family) WHERE strategy = 'lab_deterministic' AND list_contains(string_split(canonical_keys, ','), '{k}') AND (h.field_family = '{fam}' OR h.field_family = 'comorbidities') AND regexp_extract(text, '(?i){p}', 1) <> ''"
    for k, p, u, fam in extraction.ANALYTES
)


@add("lab_job_values", f"{_JOBS}, {_HITS}, v AS ({_LABJOB}) SELECT * FROM v")
def lab_job_values(s, d):
    h, j = _hits(s, d)
    return extraction.lab_strategy(h, j).select("document_id", "chunk_id", "field_family", "canonical_key", F.col("value.n").alias("value"), "unit")


@add(
    "keyword_job_values",
    rf"""{_JOBS}, {_HITS}, l AS (SELECT h.document_id, chunk_id, h.field_family, trim(unnest(string_split(text, chr(10))), ' ') AS line, lower(unnest(string_split(text, chr(10)))) AS low, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM hits h JOIN jobs j USING (document_type, field_family)
  WHERE strategy = 'narrative_keywords' AND list_contains(string_split(canonical_keys, ','), 'Cirrhosis')),
k AS (SELECT * FROM l WHERE (instr(low, 'cirrhose') > 0 AND NOT regexp_matches(substring(low, 1, instr(low, 'cirrhose') - 1), '{domain._NEG}')) OR (instr(low, 'cirrhosis') > 0 AND NOT regexp_matches(substring(low, 1, instr(low, 'cirrhosis') - 1), '{domain._NEG}')))
SELECT document_id, chunk_id, field_family, 'Cirrhosis' AS canonical_key, arg_min(line, i) AS evidence_text FROM k GROUP BY ALL""",
)
def keyword_job_values(s, d):
    h, j = _hits(s, d)
    return extraction.narrative_strategy(h, j).select("document_id", "chunk_id", "field_family", "canonical_key", "evidence_text")


def _size_model(text: str) -> list:
    """A stand-in for a model server: every size and code of a text, with its place."""
    import re

    out: list = [{"extractions": [{"class": "lesion_size_mm", "text": m[0], "start": m.start(), "end": m.end(), "attributes": {}} for m in re.finditer(r"[0-9]+(?:[.,][0-9]+)?\s*(?:mm|cm)\b", text)]}]
    out.append([{"class": "recist_response", "text": m[0], "start": m.start(), "end": m.end()} for m in re.finditer(r"\b(?:CR|PR|SD|PD|NE)\b", text)])
    return [*out, {"class": "lesion_description", "text": "ungrounded"}]


@add(
    "model_extractions",
    r"""WITH t AS (SELECT document_id, full_text AS t FROM parsed_documents WHERE full_text IS NOT NULL), m AS (SELECT document_id, unnest(regexp_extract_all(t, '[0-9]+(?:[.,][0-9]+)?\s*(?:mm|cm)\b')) AS x FROM t)
SELECT document_id, count(*) AS n_sizes, round(sum(CASE WHEN ends_with(x, 'cm') THEN 10 ELSE 1 END * replace(regexp_extract(x, '[0-9]+(?:[.,][0-9]+)?'), ',', '.')::double), 4) AS total_mm FROM m GROUP BY 1""",
)
def model_extractions(s, d):
    """An injected model over every document: nested answers flattened, ungrounded ones dropped, sizes in millimetres."""
    x = extraction.run_model(load(s, d, "parsed_documents").select("document_id", F.col("full_text").alias("text")), _size_model)
    g = extraction.grounded(x).where("class = 'lesion_size_mm'")
    return g.groupBy("document_id").agg(F.count("*").alias("n_sizes"), F.round(F.sum("value.n"), 4).alias("total_mm"))


@add("imaging_observations")
def imaging_observations(s, d):
    """The imaging strategy with an injected model over every hit; conclusion rule and fallbacks are tested case by case."""
    h, j = _hits(s, d)
    return extraction.imaging_strategy(h, j, _size_model).select("document_id", "chunk_id", "canonical_key", "raw_value", "confidence", "extraction_method")


@add(
    "dedup_observations",
    "WITH n AS (SELECT *, row_number() OVER (PARTITION BY document_id, field_family, canonical_key, evidence_text ORDER BY extracted_at, observation_id) AS n FROM observations) SELECT document_id, field_family, canonical_key, evidence_text, observation_id, extracted_at FROM n WHERE n = 1",
)
def dedup_observations(s, d):
    o = load(s, d, "observations").select("document_id", "field_family", "canonical_key", "evidence_text", "observation_id", "extracted_at")
    return extraction.dedup_observations(o, ["document_id", "field_family", "canonical_key", "evidence_text"], ["extracted_at", "observation_id"])


@add(
    "lab_override",
    """WITH p AS (SELECT document_id FROM parsed_documents WHERE document_type_hint = 'lab_blood_panel'), r AS (SELECT DISTINCT document_id FROM lab_lines WHERE document_id IN (FROM p))
SELECT 'observation' AS kind, observation_id AS id, extracted_at AS at FROM observations WHERE NOT (extraction_method = 'lab_regex' AND document_id IN (FROM r)) UNION ALL SELECT 'line', line_id::varchar, NULL FROM lab_lines WHERE document_id IN (FROM r)""",
)
def lab_override(s, d):
    method = F.when(F.col("extraction_method") == "lab_regex", extraction.LAB_METHOD).otherwise(F.col("extraction_method"))
    o = load(s, d, "observations").select("document_id", method.alias("extraction_method"), F.lit("observation").alias("kind"), F.col("observation_id").alias("id"), F.col("extracted_at").alias("at"))
    rows = load(s, d, "lab_lines").select("document_id", F.lit(extraction.ROWS_METHOD).alias("extraction_method"), F.lit("line").alias("kind"), F.col("line_id").cast("string").alias("id"), F.lit(None).cast("timestamp").alias("at"))
    return extraction.lab_override(o, rows, load(s, d, "parsed_documents").where("document_type_hint = 'lab_blood_panel'")).select("kind", "id", "at")


@add("union_of_observations", "SELECT 'o' AS kind, document_id, count(*) AS n FROM observations GROUP BY ALL UNION ALL SELECT 'l', document_id, count(*) FROM lab_lines GROUP BY ALL")
def union_of_observations(s, d):
    o, l = (load(s, d, t).select(F.lit(k).alias("kind"), "document_id") for t, k in (("observations", "o"), ("lab_lines", "l")))  # noqa: E741
    return o.unionByName(l).groupBy("kind", "document_id").agg(F.count("*").alias("n"))


# --- rules -----------------------------------------------------------------------------------------------------
@add(
    "observation_keys",
    """WITH k AS (SELECT observation_id, extracted_at, document_id, list_filter([canonical_key, CASE WHEN extraction_method = 'lab_regex' THEN canonical_key END, CASE WHEN field_family = 'imaging_recist' THEN 'RECIST_response' END, CASE WHEN field_family = 'comorbidities' THEN 'Cirrhosis' END], lambda x: x IS NOT NULL) AS l FROM observations)
SELECT observation_id, extracted_at, document_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS keys FROM k""",
)
def observation_keys(s, d):
    k = F.col("canonical_key")
    keys = rules.observation_keys(k, F.when(F.col("extraction_method") == "lab_regex", k), F.when(F.col("field_family") == "imaging_recist", "RECIST_response"), F.when(F.col("field_family") == "comorbidities", "Cirrhosis"))
    return load(s, d, "observations").select("observation_id", "extracted_at", "document_id", F.array_join(keys, ",").alias("keys"))


def _typed(s, d):
    docs = load(s, d, "parsed_documents").select("document_id", F.col("document_type_hint").alias("document_type"), F.col("document_date").alias("doc_date"))
    return load(s, d, "observations").join(docs, "document_id")


_MULTI = f"""o AS (SELECT observation_id, extracted_at, o.document_id, document_type_hint AS t, [canonical_key, CASE WHEN field_family = 'imaging_recist' THEN 'RECIST_response' END] AS ks FROM observations o JOIN parsed_documents p USING (document_id)),
j AS (SELECT o.*, f.field_name, f.temporal_scope, f.document_types_allowed FROM o JOIN field_defs f ON list_contains(ks, f.canonical_key)),
k AS (SELECT *, {domain._RANK} AS rk, min({domain._RANK}) OVER (PARTITION BY observation_id, extracted_at, document_id) AS best, row_number() OVER (PARTITION BY observation_id, extracted_at, document_id ORDER BY {domain._RANK}, field_name) AS nth FROM j),
m AS (SELECT * FROM k WHERE rk = best AND (best < 60 OR nth = 1))"""


@add("fields_of_many_keys", f"WITH {_MULTI} SELECT observation_id, extracted_at, document_id, field_name FROM m WHERE list_contains(document_types_allowed, t)")
def fields_of_many_keys(s, d):
    o = _typed(s, d).withColumn("second_key", F.when(F.col("field_family") == "imaging_recist", "RECIST_response"))
    return rules.map_to_fields(o, load(s, d, "field_defs"), ["canonical_key", "second_key"]).select("observation_id", "extracted_at", "document_id", "field_name")


@add("first_field_names", f"WITH {_MULTI} SELECT o.observation_id, o.extracted_at, o.document_id, min(m.field_name) AS field_name FROM o LEFT JOIN m USING (observation_id, extracted_at, document_id) GROUP BY ALL")
def first_field_names(s, d):
    o = _typed(s, d).withColumn("second_key", F.when(F.col("field_family") == "imaging_recist", "RECIST_response"))
    return rules.first_field_name(o, load(s, d, "field_defs"), ["canonical_key", "second_key"]).select("observation_id", "extracted_at", "document_id", "field_name")


_SIZE1 = extraction.SIZE


@add(
    "build_candidates",
    f"""WITH o AS (SELECT observation_id, extracted_at, o.document_id, document_type_hint AS t, o.canonical_key, normalized_value AS v, unit, evidence_text, raw_value, p.document_date AS dd FROM observations o JOIN parsed_documents p USING (document_id)),
j AS (SELECT o.*, f.field_name, f.temporal_scope, f.normalization_rule AS rule, f.document_types_allowed FROM o JOIN field_defs f ON f.canonical_key = o.canonical_key),
k AS (SELECT *, {domain._RANK} AS rk, min({domain._RANK}) OVER (PARTITION BY observation_id, extracted_at, document_id) AS best, row_number() OVER (PARTITION BY observation_id, extracted_at, document_id ORDER BY {domain._RANK}, field_name) AS nth FROM j),
m AS (SELECT *, coalesce(evidence_text, raw_value) AS e FROM k WHERE rk = best AND (best < 60 OR nth = 1) AND list_contains(document_types_allowed, t)),
z AS (SELECT *, try_cast(replace(regexp_extract(e, '(?i){_SIZE1}', 1), ',', '.') AS double) * CASE WHEN starts_with(lower(regexp_extract(e, '(?i){_SIZE1}', 2)), 'c') THEN 10 ELSE 1 END AS e_mm FROM m)
SELECT observation_id, extracted_at, document_id, field_name, round(CASE WHEN rule = 'numeric_mm' THEN coalesce(e_mm, CASE WHEN starts_with(lower(unit), 'c') THEN v.n * 10 ELSE v.n END, v.n) ELSE v.n END, 6) AS number,
CASE temporal_scope WHEN 'first_imaging' THEN 'first_imaging_evaluation' WHEN 'second_imaging' THEN 'second_imaging_evaluation' WHEN 'baseline' THEN 'baseline' WHEN 'follow_up' THEN 'follow_up' WHEN 'line_l2' THEN 'line_l2' ELSE 'unknown' END AS temporal_label, coalesce(dd, DATE '{RUN_DATE}') AS event_date FROM z""",
)
def build_candidates(s, d):
    o = _typed(s, d).withColumnRenamed("normalized_value", "value").drop("document_date", "temporal_label", "event_date").withColumnRenamed("doc_date", "document_date")
    c = pipeline.build_candidates(o, load(s, d, "field_defs"), RUN_DATE)
    return c.select("observation_id", "extracted_at", "document_id", "field_name", F.round("value.n", 6).alias("number"), "temporal_label", "event_date")


@add("candidate_definitions", "SELECT candidate_id, f.field_type, f.temporal_scope FROM field_candidates c JOIN field_defs f USING (field_name)")
def candidate_definitions(s, d):
    return load(s, d, "field_candidates").select("candidate_id", "field_name").join(bounded(load(s, d, "field_defs").select("field_name", "field_type", "temporal_scope")), "field_name").drop("field_name")


@add("observation_refresh", "WITH f AS (SELECT observation_id, arg_min(confidence, (extracted_at, document_id)) AS c FROM observations GROUP BY 1) SELECT o.observation_id, extracted_at, document_id, coalesce(f.c, confidence) AS confidence FROM observations o LEFT JOIN f USING (observation_id)")
def observation_refresh(s, d):
    """Every delivery of an observation with what was first said of it."""
    o = load(s, d, "observations").select("observation_id", "extracted_at", "document_id", "confidence")
    f = o.groupBy("observation_id").agg(F.min_by("confidence", F.struct("extracted_at", "document_id")).alias("c"))
    return o.join(f, "observation_id", "left").select("observation_id", "extracted_at", "document_id", F.coalesce("c", "confidence").alias("confidence"))


# --- form -----------------------------------------------------------------------------------------------------
@add("columns_skipped_never", f"WITH {domain._CELLS} SELECT patient_id, f.target_column AS column_key FROM (SELECT DISTINCT patient_id FROM cells) CROSS JOIN (SELECT DISTINCT target_column FROM field_defs) f")
def columns_skipped_never(s, d):
    return etl.columns_to_skip(domain._cells(s, d, True), "never", load(s, d, "field_defs").select(F.col("target_column").alias("column_key")))


@add("columns_skipped_filled", f"WITH {domain._CELLS}, x AS (SELECT patient_id, column_key, value AS existing FROM cells) SELECT DISTINCT patient_id, column_key FROM x WHERE NOT {domain._EMPTY}")
def columns_skipped_filled(s, d):
    return etl.columns_to_skip(domain._cells(s, d, True), "empty_only")


@add(
    "merge_stats",
    f"""WITH {domain._CELLS}, {domain._UPD}, j AS (SELECT u.column_key, u.patient_id, u.value AS n, c.value AS existing, k.patient_id IS NOT NULL AS known FROM upd u LEFT JOIN cells c USING (patient_id, column_key) LEFT JOIN (SELECT DISTINCT patient_id FROM cells) k ON k.patient_id = u.patient_id)
SELECT column_key, count(*) FILTER ({domain._EMPTY}) AS written, count(*) FILTER (NOT {domain._EMPTY}) AS kept, count(*) FILTER ({domain._EMPTY} AND existing IS NOT DISTINCT FROM n) AS unchanged, count(DISTINCT CASE WHEN NOT known THEN patient_id END) AS new_rows FROM j GROUP BY 1""",
)
def merge_stats(s, d):
    return etl.merge_stats(domain._cells(s, d, True), domain._cells(s, d, False), "empty_only", ["column_key"])


@add("duplicate_headers", "SELECT target_column AS header, count(*) AS n FROM field_candidates WHERE target_column IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def duplicate_headers(s, d):
    return etl.duplicate_headers(load(s, d, "field_candidates").select(F.col("target_column").alias("header")))


@add("workbook_cells", " UNION ALL ".join(f"SELECT candidate_id::varchar AS patient_id, '{c}' AS column_key, {c} AS value FROM field_candidates" for c in ("field_name", "target_column", "value_text")))
def workbook_cells(s, d):
    """A wide sheet as cells: one row per key and header."""
    w = load(s, d, "field_candidates").select("candidate_id", "field_name", "target_column", "value_text")
    c = etl.snapshot(w, "candidate_id")
    return c.withColumn("patient_id", etl.coerce_patient_id(F.col("patient_id")))


@add("missing_patients", "SELECT DISTINCT patient_id, patient_id AS registry_key, 'pipeline_id' AS source FROM observations WHERE patient_id IS NOT NULL AND patient_id NOT IN (SELECT patient_id FROM field_candidates WHERE patient_id IS NOT NULL)")
def missing_patients(s, d):
    p = load(s, d, "observations").where("patient_id is not null").select("patient_id").distinct().withColumn("explicit", F.lit(None).cast("string"))
    m = p.select("patient_id", F.lit(None).cast("string").alias("mapped"))
    return etl.missing_patients(etl.resolve_patients(p, m, load(s, d, "field_candidates").select(F.col("patient_id").alias("registry_id"))))


@add("row_exists", "SELECT DISTINCT patient_id, patient_id IN (SELECT patient_id FROM field_candidates WHERE extraction_method = 'manual') AS in_registry FROM parsed_documents WHERE patient_id IS NOT NULL")
def row_exists(s, d):
    p = load(s, d, "parsed_documents").where("patient_id is not null").select("patient_id").distinct().withColumn("explicit", F.lit(None).cast("string"))
    m = p.select("patient_id", F.lit(None).cast("string").alias("mapped"))
    return etl.resolve_patients(p, m, load(s, d, "field_candidates").where("extraction_method = 'manual'").select(F.col("patient_id").alias("registry_id"))).select("patient_id", "in_registry")


@add("coerced_ids", "SELECT candidate_id, trim(value_text, ' ') AS t, CASE WHEN try_cast(trim(value_text, ' ') AS double) = floor(try_cast(trim(value_text, ' ') AS double)) AND isfinite(try_cast(trim(value_text, ' ') AS double)) THEN try_cast(trim(value_text, ' ') AS double)::bigint::varchar END AS whole FROM field_candidates")
def coerced_ids(s, d):
    v = F.trim("value_text")
    n = v.try_cast("double")
    return load(s, d, "field_candidates").select("candidate_id", v.alias("t"), F.when(n == F.floor(n), etl.coerce_patient_id(F.col("value_text"))).alias("whole"))


@add("redacted_json", "SELECT record_id, received_at, json_extract_string(details, '$.n') AS n, json_extract_string(details, '$.ok') AS ok FROM audit_records WHERE details IS NOT NULL")
def redacted_json(s, d):
    """Details with a path put in at depth, redacted and read back: everything but the path's folders is left."""
    a = load(s, d, "audit_records").where("details is not null")
    nested = F.concat(F.lit('{"a":[{"source_path":"/x/y/'), F.col("record_id"), F.lit('.pdf"}],"d":'), F.col("details"), F.lit("}"))
    r = etl.redact_json(nested)
    whole = F.get_json_object(r, "$.a[0].source_path") == F.concat("record_id", F.lit(".pdf"))
    return a.select("record_id", "received_at", *[F.when(whole, F.get_json_object(r, f"$.d.{k}")).alias(k) for k in ("n", "ok")])


@add("audit_excerpts", "SELECT recorded_at, document_id, patient_id, study_id, 'extraction' AS step, substring(evidence_excerpt, 1, 500) AS evidence_excerpt, confidence FROM audit_records")
def audit_excerpts(s, d):
    a = load(s, d, "audit_records")
    return etl.audit_records(a, "extraction", F.lit("{}"), F.col("recorded_at"), F.col("confidence"), F.col("evidence_excerpt")).select("recorded_at", "document_id", "patient_id", "study_id", "step", "evidence_excerpt", "confidence")


@add("quarantined_candidates", "SELECT candidate_id, array_to_string(list_filter([CASE WHEN NOT coalesce(confidence BETWEEN 0 AND 1, false) THEN 'confidence' END, CASE WHEN patient_id IS NULL THEN 'patient' END], lambda x: x IS NOT NULL), ',') AS faults FROM field_candidates WHERE NOT coalesce(confidence BETWEEN 0 AND 1, false) OR patient_id IS NULL")
def quarantined_candidates(s, d):
    bad = files.quarantine(load(s, d, "field_candidates"), {"confidence": F.col("confidence").between(0, 1), "patient": F.col("patient_id").isNotNull()})[1]
    return bad.select("candidate_id", F.array_join("faults", ",").alias("faults"))


@add("imaging_template", "WITH l AS (SELECT patient_id, canonical_key, arg_max(raw_value, (extracted_at, observation_id)) AS v, arg_max_null(unit, (extracted_at, observation_id)) AS u FROM observations WHERE field_family = 'imaging_recist' AND raw_value IS NOT NULL AND patient_id IS NOT NULL GROUP BY ALL) SELECT patient_id, canonical_key AS column_key, v AS valeur, u AS unite FROM l")
def imaging_template(s, d):
    """Imaging templates, read back leaf by leaf."""
    o = load(s, d, "observations").where("field_family = 'imaging_recist' and raw_value is not null and patient_id is not null")
    last = o.groupBy("patient_id", "canonical_key").agg(F.max_by(F.struct("raw_value", "unit"), F.struct("extracted_at", "observation_id")).alias("r"))
    u = last.select("patient_id", F.col("canonical_key").alias("column_key"), F.col("r.raw_value").alias("value"), F.col("r.unit").alias("unit"), F.lit(True).alias("validated"))
    t = etl.imaging_template(u).select("patient_id", F.explode(evaluation.flatten_json("template")).alias("x"))
    return t.select("patient_id", F.col("x.path")[1].alias("column_key"), F.col("x.value.s").alias("valeur"), F.col("x.unit").alias("unite"))


# --- index and search -------------------------------------------------------------------------------------------
def _payload(s, d):
    docs = load(s, d, "parsed_documents").select("document_id", "patient_id", "study_id", F.col("document_type_hint").alias("document_type"))
    return index.payload(load(s, d, "chunks").join(docs, "document_id", "left"), F.coalesce("study_id", F.lit("none")), "v1", "hash", 32)


@add(
    "payload_filters",
    """WITH n AS (SELECT c.*, study_id, patient_id, document_type_hint AS t, row_number() OVER (PARTITION BY chunk_id ORDER BY indexed_at DESC, chunk_ord, char_start DESC NULLS LAST, text DESC) AS n FROM chunks c LEFT JOIN parsed_documents USING (document_id))
SELECT chunk_id, document_id, patient_id, field_family FROM n WHERE n = 1 AND study_id = (SELECT min(study_id) FROM parsed_documents) AND t = 'lab_blood_panel' AND (field_family IN ('hematology', 'coagulation') OR field_family IS NULL)""",
)
def payload_filters(s, d):
    tenant = load(s, d, "parsed_documents").agg(F.min("study_id")).first()[0]
    x = index.filtered(index.merge(None, _payload(s, d)), tenant, families=["hematology", "coagulation"], version="v1", document_type="lab_blood_panel")
    return x.select("chunk_id", "document_id", "patient_id", "field_family")


@add("payload_metadata", "WITH n AS (SELECT c.chunk_id, c.text, document_type_hint AS t, row_number() OVER (PARTITION BY chunk_id ORDER BY indexed_at DESC, chunk_ord, char_start DESC NULLS LAST, text DESC) AS n FROM chunks c LEFT JOIN parsed_documents USING (document_id) WHERE chunk_id IS NOT NULL) SELECT chunk_id, text, t AS document_type, 'v1' AS version, true AS no_nulls FROM n WHERE n = 1")
def payload_metadata(s, d):
    m = index.metadata_of(index.merge(None, _payload(s, d)))
    return m.select("chunk_id", "text", F.try_element_at("metadata", F.lit("document_type")).alias("document_type"), F.try_element_at("metadata", F.lit("version")).alias("version"), F.forall(F.map_values("metadata"), lambda v: v.isNotNull()).alias("no_nulls"))


@add("index_references", "SELECT chunk_id, indexed_at, chunk_ord, coalesce(field_family, 'own') AS field_family, document_id AS ref_doc_id, chunk_id AS ref_chunk_id FROM chunks")
def index_references(s, d):
    own = F.when(F.col("field_family").isNull(), F.create_map(F.lit("field_family"), F.lit("own"))).otherwise(F.create_map().cast("map<string,string>"))
    m = index.referenced(own, F.col("document_id"), F.col("chunk_id"), F.col("field_family"))
    return load(s, d, "chunks").select("chunk_id", "indexed_at", "chunk_ord", *[F.try_element_at(m, F.lit(k)).alias(k) for k in ("field_family", "ref_doc_id", "ref_chunk_id")])


@add("index_pages", "WITH c AS (SELECT DISTINCT chunk_id FROM chunks), n AS (SELECT chunk_id, row_number() OVER (ORDER BY chunk_id) AS n FROM c) SELECT chunk_id FROM n WHERE n BETWEEN 51 AND 100")
def index_pages(s, d):
    """The second page of fifty by key, from the last key of the first."""
    c = load(s, d, "chunks").select("chunk_id").distinct()
    last = index.page(c, "chunk_id", None, 50).agg(F.max("chunk_id")).first()[0]
    return index.page(c, "chunk_id", last, 50)


@add("index_health", "SELECT count(*) AS n_rows, count(*) FILTER (field_family IS NULL) AS untagged FROM chunks")
def index_health(s, d):
    return index.health(load(s, d, "chunks")).select("n_rows", "untagged")


def _texts(s, d):
    docs = load(s, d, "documents").where("text is not null")
    return docs.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query")), docs.select(F.col("doc_id").alias("id"), "text")


_EMB = r"""wd AS (SELECT doc_id, p, unnest(regexp_extract_all(lower(p || text), '[a-z0-9]+')) AS w FROM (SELECT doc_id, 'passage: ' AS p, text FROM documents WHERE text IS NOT NULL UNION ALL SELECT doc_id, 'query: ', text FROM documents WHERE text IS NOT NULL AND doc_id % 100 = 0 AND NOT regexp_full_match(text, '[\s\x{a0}\x{2000}-\x{200a}\x{202f}]*'))),
bk AS (SELECT doc_id, p, ('0x' || md5(w)[1:4])::int % 32 AS b, count(*) AS n FROM wd GROUP BY ALL), nm AS (SELECT doc_id, p, sqrt(sum(n * n)) AS norm FROM bk GROUP BY ALL),
cs AS (SELECT q.doc_id AS query_id, e.doc_id AS id, round(sum(q.n * e.n)::double / any_value(qn.norm) / any_value(en.norm), 6) AS score FROM bk q JOIN bk e ON q.b = e.b AND q.p = 'query: ' AND e.p = 'passage: ' JOIN nm qn ON qn.doc_id = q.doc_id AND qn.p = q.p JOIN nm en ON en.doc_id = e.doc_id AND en.p = e.p GROUP BY ALL),
de AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM cs)"""


@add(
    "hybrid_search_topk",
    f"""WITH {domain._BM}, {_EMB}, bo AS (SELECT query_id, id, rank FROM bm WHERE rank <= 20 AND query_id IN (SELECT doc_id FROM wd WHERE p = 'query: ') UNION ALL SELECT query_id, id, rank FROM de WHERE rank <= 20), fu AS (SELECT query_id, id, round(sum(1.0::double / (60 + rank)), 9) AS score FROM bo GROUP BY ALL),
fr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM fu), h AS (SELECT * FROM fr WHERE rank <= 20 AND score >= 0.0135),
wl AS (SELECT doc_id AS id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS l FROM documents WHERE text IS NOT NULL),
rr AS (SELECT query_id, h.id, h.score, h.rank, round(coalesce(len(list_intersect(a.l, b.l))::double / nullif(len(a.l), 0), 0.0), 6) AS rs FROM h JOIN wl a ON a.id = h.query_id JOIN wl b ON b.id = h.id), kk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rs DESC, rank, id) AS rk FROM rr)
SELECT query_id, id, score AS retrieval_score, rank::int AS retrieval_rank, rs AS rerank_score, rk::int AS rerank_rank FROM kk WHERE rk <= 5""",
)
def hybrid_search_topk(s, d):
    q, p = _texts(s, d)
    return retrieval.hybrid(q, p, 5, min_score=0.0135, rerank_top=True)


@add("hash_embeddings", f"WITH {_EMB} SELECT nm.doc_id, round(nm.norm, 6) AS norm, count(*) AS filled FROM nm JOIN bk USING (doc_id, p) WHERE p = 'passage: ' GROUP BY ALL")
def hash_embeddings(s, d):
    """Embeddings of all texts: how many buckets are filled, and the length before it is brought to one."""
    e = retrieval.hash_embedding(F.col("text"), retrieval.PASSAGE)
    words = F.size(F.regexp_extract_all(F.lower(F.concat(F.lit(retrieval.PASSAGE), "text")), F.lit("[a-z0-9]+"), F.lit(0)))
    y = load(s, d, "documents").where("text is not null").select("doc_id", e.alias("e"), words.alias("n"))
    total = F.aggregate("e", F.lit(0.0), lambda a, v: a + v)
    return y.select("doc_id", F.round(F.col("n") / total, 6).alias("norm"), F.size(F.filter("e", lambda v: v > 0)).alias("filled").cast("bigint"))


_FQ = "CASE field_family " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in retrieval.FAMILY_QUERIES.items()) + " ELSE replace(field_family, '_', ' ') END"


@add("family_queries", f"SELECT DISTINCT field_family, CASE WHEN field_family = 'hematology' THEN 'NFS plaquettes' ELSE {_FQ} END AS query FROM field_defs")
def family_queries(s, d):
    f = load(s, d, "field_defs")
    return retrieval.family_queries(f, f, {"hematology": "NFS plaquettes"})


@add(
    "family_search",
    f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY indexed_at DESC, chunk_ord, char_start DESC NULLS LAST, text DESC) AS n FROM chunks WHERE chunk_id IS NOT NULL), c AS (SELECT * FROM n WHERE n = 1),
q AS (SELECT field_family AS family, list_filter(string_split_regex(lower({_FQ}), '\\s+'), lambda w: length(w) > 2) AS w FROM (SELECT DISTINCT field_family FROM field_defs)),
x AS (SELECT document_id, family, chunk_id, chunk_ord, round(least(1.0::double, 0.2::double + 0.15::double * len(list_filter(w, lambda y: contains(lower(text), y)))), 6) AS score FROM c JOIN q ON c.field_family IS NULL OR c.field_family = q.family),
r AS (SELECT *, row_number() OVER (PARTITION BY document_id, family ORDER BY score DESC, chunk_ord, chunk_id) AS rank FROM x)
SELECT document_id, family, rank::int AS rank, chunk_id, score FROM r WHERE rank <= 3""",
)
def family_search(s, d):
    return retrieval.family_search(index.upsert(load(s, d, "chunks")), retrieval.family_queries(load(s, d, "field_defs")), 3)


@add("nonblank_hits", "SELECT chunk_id, indexed_at, chunk_ord FROM chunks WHERE trim(text, ' ') <> ''")
def nonblank_hits(s, d):
    return load(s, d, "chunks").where("trim(text) <> ''").select("chunk_id", "indexed_at", "chunk_ord")


@add("reports_with_answers", "SELECT CASE i % 5 WHEN 0 THEN 'x' END AS k, count(*) AS n FROM range(2000) t(i) GROUP BY 1")
def reports_with_answers(s, d):
    """Two thousand synthetic reports read by the imaging rules: those whose size and response both come out as written."""
    r = cut(files.synthetic_reports(s, 2000), "reports")
    good = (extraction.baseline_size_mm(F.col("text")) == F.col("baseline_mm")) & (extraction.conclusion_recist(F.col("text")) == F.col("code"))
    return r.where(good).select(F.when(F.col("report_id") % 5 == 0, "x").alias("k")).groupBy("k").agg(F.count("*").alias("n"))


# --- evaluation ---------------------------------------------------------------------------------------------------
@add("contract_check", "SELECT observation_id, extracted_at, document_id, array_to_string(list_filter([CASE WHEN f.field_type = 'numeric' AND normalized_value.kind <> 'n' THEN 'type' END, CASE WHEN u.unit_code IS NOT NULL AND (" + domain._CU("u.unit_code") + ") IS DISTINCT FROM (" + domain._CU("o.unit") + ") THEN 'unit' END], lambda x: x IS NOT NULL), ',') AS faults FROM observations o JOIN (SELECT DISTINCT canonical_key, field_type FROM field_defs) f USING (canonical_key) LEFT JOIN (SELECT canonical_key, unit_code FROM unit_ref WHERE is_common) u USING (canonical_key)")
def contract_check(s, d):
    """Observations against the type of their field and the declared common unit of their key."""
    f = load(s, d, "field_defs").select("canonical_key", "field_type").distinct()
    u = load(s, d, "unit_ref").where("is_common").select("canonical_key", "unit_code")
    o = load(s, d, "observations").join(bounded(f), "canonical_key").join(bounded(u), "canonical_key", "left")
    kind = F.when(F.col("field_type") == "numeric", "n")
    return o.select("observation_id", "extracted_at", "document_id", F.array_join(evaluation.contract(kind, F.col("normalized_value.kind"), F.col("unit_code"), F.col("unit")), ",").alias("faults"))


@add("scalar_types", "SELECT line_id, CASE WHEN value IS NULL THEN 'null' WHEN value.kind = 'n' THEN CASE WHEN value.n IS NULL THEN 'null' ELSE 'number' END WHEN value.kind = 'b' THEN CASE WHEN value.b IS NULL THEN 'null' ELSE 'boolean' END WHEN value.s IS NULL THEN 'null' ELSE 'text' END AS scalar_type FROM lab_lines")
def scalar_types(s, d):
    return load(s, d, "lab_lines").select("line_id", evaluation.scalar_type(F.col("value")).alias("scalar_type"))


@add("value_needles", "SELECT line_id, value.n::bigint::varchar AS whole FROM lab_lines WHERE value.kind = 'n' AND value.n = floor(value.n)")
def value_needles(s, d):
    """The whole-number form of whole values, last of their needles."""
    n = F.col("value.n")
    x = load(s, d, "lab_lines").where((F.col("value.kind") == "n") & (n == F.floor(n)))
    return x.select("line_id", F.element_at(evaluation.value_needles(F.col("value")), -1).alias("whole"))


@add("section_families", "SELECT line_id, CASE strip_accents(lower(trim(section, ' '))) WHEN 'hematologie' THEN 'hematology' WHEN 'hemostase' THEN 'coagulation' WHEN 'biochimie' THEN 'hepatic_biochemistry' WHEN 'imaging recist' THEN 'imaging_recist' END AS family FROM lab_lines")
def section_families(s, d):
    return load(s, d, "lab_lines").select("line_id", evaluation.family_of_section(F.col("section")).alias("family"))


_SILVER = domain.registry.sql["silver_judgments"]


@add(
    "silver_recall",
    _SILVER.replace("\nSELECT line_id::varchar AS path", ",\nsj AS (SELECT line_id, line_id::varchar AS path", 1) + """),
j AS (SELECT l.document_id, sj.*, CASE strip_accents(lower(trim(section, ' '))) WHEN 'hematologie' THEN 'hematology' WHEN 'hemostase' THEN 'coagulation' WHEN 'biochimie' THEN 'hepatic_biochemistry' END AS family FROM sj JOIN lab_lines l USING (line_id)),
ck AS (SELECT chunk_id, r.d AS d, arg_max(struct_pack(o := k.chunk_ord, f := k.field_family), (k.indexed_at, -k.chunk_ord)) AS x FROM c JOIN chunks k USING (chunk_id) GROUP BY ALL),
fm AS (SELECT unnest(['hematology', 'coagulation', 'hepatic_biochemistry']) AS family), rk AS (SELECT d, family, chunk_id, row_number() OVER (PARTITION BY d, family ORDER BY ck.x.o, chunk_id) AS rank FROM ck JOIN fm ON ck.x.f IS NULL OR ck.x.f = family),
m AS (SELECT j.*, rank FROM j LEFT JOIN rk ON rk.d = j.document_id AND rk.family = j.family AND rk.chunk_id = j.chunk_id AND rank <= 5)
SELECT document_id AS sample_id, round(avg((coalesce(rank, 99) <= 1)::int::double) FILTER (family IS NOT NULL AND status = 'matched'), 6) AS recall_1, round(avg((coalesce(rank, 99) <= 5)::int::double) FILTER (family IS NOT NULL AND status = 'matched'), 6) AS recall_5,
count(*) FILTER (family IS NOT NULL AND status = 'matched') AS matched, count(*) FILTER (family IS NOT NULL AND status = 'unmatched') AS unmatched, count(*) FILTER (family IS NOT NULL AND status = 'ambiguous') AS ambiguous, count(*) FILTER (family IS NULL) AS unsupported_family FROM m GROUP BY 1""",
)
def silver_recall(s, d):
    """Recall of the family rankings against silver judgments of every lab line, per document; status counts."""
    lines = load(s, d, "lab_lines")
    c = index.upsert(load(s, d, "chunks"))
    f = lines.select(F.col("document_id").alias("sample_id"), F.col("line_id").cast("string").alias("path"), F.col("name").alias("label"), "value", "unit")
    j = evaluation.silver_judgments(f, c.select(F.col("document_id").alias("sample_id"), "chunk_id", "text"))
    j = j.join(lines.select(F.col("line_id").cast("string").alias("path"), evaluation.family_of_section(F.col("section")).alias("family")), "path")
    h = retrieval.family_first_k(c, ["hematology", "coagulation", "hepatic_biochemistry"], 5).withColumnRenamed("document_id", "sample_id")
    return evaluation.recall_summary(j, h, [5, 1, 5])


@add("evaluation_report", domain.registry.sql["field_metrics"].replace("SELECT target_column, eligible", "SELECT coalesce(target_column, 'micro') AS sample, format('{:.4f}', round(p, 6)) AS shown, eligible") + " WHERE p IS NOT NULL")
def evaluation_report(s, d):
    """The report of every column and over all, with the rate as it is printed."""
    m = evaluation.metrics(evaluation.counts(domain._outcomes(s, d), ["target_column"])).where("precision is not null")
    return m.withColumn("sample", F.coalesce("target_column", F.lit("micro"))).withColumn("shown", F.format_string("%.4f", F.col("precision"))).drop("target_column")


_LAST = "arg_max(struct_pack(v := value, u := unit), (ord, line_id))"
_LEAVES = lambda cond, n: f"{n} AS (SELECT document_id, coalesce(section, 'Uncategorized') AS s1, coalesce(subsection, section, 'Uncategorized') AS s2, name, {_LAST} AS r FROM lab_lines WHERE name IS NOT NULL AND {cond} GROUP BY ALL)"


@add(
    "evaluation_run",
    f"""WITH {_LEAVES('true', 'g0')}, {_LEAVES('confidence >= 0.9', 'p0')}, both_in AS (SELECT DISTINCT document_id FROM p0),
g AS (SELECT * FROM g0 WHERE document_id IN (FROM both_in)),
j AS (SELECT g.document_id, g.r.v AS gv, g.r.u AS gu, (g.r.v.kind = 'n' OR g.r.u IS NOT NULL) AS gd, p0.r.v AS pv, p0.r.u AS pu, (g.r.v.kind = 'n' AND g.r.v.n IS NOT NULL) OR (g.r.v.kind = 's' AND g.r.v.s IS NOT NULL) AS has_g, coalesce((p0.r.v.kind = 'n' AND p0.r.v.n IS NOT NULL) OR (p0.r.v.kind = 's' AND p0.r.v.s IS NOT NULL), false) AS has_p
  FROM g LEFT JOIN p0 USING (document_id, s1, s2, name)),
o AS (SELECT *, coalesce(has_g, false) AS hg, CASE WHEN gv.kind = 's' AND pv.kind = 's' THEN {domain._NT('pv.s')} = {domain._NT('gv.s')} WHEN gv.kind = 'n' AND pv.kind = 'n' THEN abs(pv.n - gv.n) <= greatest(1e-6 * greatest(abs(pv.n), abs(gv.n)), 1e-6) ELSE false END AS same,
  NOT coalesce(gd, false) OR gu IS NULL OR ({domain._CU('gu')}) IS NOT DISTINCT FROM ({domain._CU('pu')}) AS same_unit FROM j)
SELECT document_id AS sample_id, count(*) AS eligible, count(*) FILTER (hg AND has_p) AS tp, count(*) FILTER (NOT hg AND has_p) AS fp, count(*) FILTER (hg AND NOT has_p) AS fn, count(*) FILTER (hg AND has_p AND same AND same_unit) AS correct FROM o GROUP BY ROLLUP (document_id)""",
)
def evaluation_run(s, d):
    """Templates of the surer lines against those of all lines, through the runner: counts of every sample and over all."""
    lines = load(s, d, "lab_lines")
    t = lambda df: cut(etl.lab_template(df).withColumnRenamed("document_id", "sample_id"), "templates")
    gold = t(lines)
    ev = runner.evaluate(gold, gold, t(lines.where("confidence >= 0.9")), partial=True)
    return ev.metrics.select("sample_id", "eligible", "tp", "fp", "fn", "correct")


@add("pending_documents", "SELECT document_id FROM parsed_documents WHERE document_id NOT IN (SELECT document_id FROM observations WHERE document_id IS NOT NULL)")
def pending_documents(s, d):
    return files.pending(load(s, d, "parsed_documents").select("document_id"), load(s, d, "observations"), "document_id")


@add("first_samples", "SELECT document_id FROM parsed_documents ORDER BY document_id LIMIT 25")
def first_samples(s, d):
    """The first twenty-five samples by id: the limit is the option."""
    p = load(s, d, "parsed_documents").select("document_id")
    return files.pending(p, p, "document_id", overwrite=True, limit=25)


# --- the whole run --------------------------------------------------------------------------------------------------
def run(s, d) -> pipeline.Run:
    f = load(s, d, "field_defs")
    a = f.select(F.explode("header_aliases").alias("alias"), F.col("target_column").alias("header"))
    return pipeline.run_pipeline(load(s, d, "parsed_documents"), f, RUN_DATE, registry=domain._cells(s, d, True), aliases=a, hint="document_type_hint")


@add("run_pipeline")
def run_pipeline(s, d):
    """The accepted cells of a run over every document; the stages have counterparts, the whole is tested against golden rows."""
    u = run(s, d).updates
    return u.select("document_id", "patient_id", "study_id", "column_key", "shown", "unit", F.round("blended", 6).alias("confidence"), "validated", "temporal_label", "event_date")


# every document leaves one record at each of eleven steps, whatever is found in it
_DOC_STEPS = [x for x in etl.STEPS if x not in ("extraction", "validation")]


@add("pipeline_audit", f"SELECT document_id, patient_id, study_id, unnest({domain._list(_DOC_STEPS)}) AS step FROM parsed_documents")
def pipeline_audit(s, d):
    return run(s, d).audit.where(F.col("step").isin(_DOC_STEPS)).select("document_id", "patient_id", "study_id", "step")
