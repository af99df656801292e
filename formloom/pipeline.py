"""From documents to form cells in one plan: parse, chunk, plan jobs, retrieve, extract, map, blend, choose, check, export, audit.

Every stage is a DataFrame over all documents. Parsed documents, report rows, chunks and observations are
products of a run and are written once into the shared folder, as several stages read them; nothing else is.

Null and blank texts give a parsed document without chunks; a document of no known type has no jobs; ties
of candidates go to the earliest observation; a run without a registry treats every cell as empty.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formloom.operators import chunking, etl, extraction, labrows, parsing, rules
from formloom.session import bounded, cut, safe_unions

TAGGED, UNTAGGED = 0.88, 0.78
_KEYS = ["document_id", "patient_id", "study_id"]


@dataclass
class Run:
    """What a run gives."""

    parsed: DataFrame
    sections: DataFrame
    lab_lines: DataFrame
    chunks: DataFrame
    jobs: DataFrame
    hits: DataFrame
    observations: DataFrame
    candidates: DataFrame
    updates: DataFrame
    suppressed: DataFrame
    cells: DataFrame
    audit: DataFrame


def parse(docs: DataFrame, existing: DataFrame | None = None, hint: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(parsed, sections, lab_lines) of docs(document_id, patient_id, study_id, source_path, mime_type, full_text).

    Report rows are read for PDF documents that are probably panels; the text of other PDF documents becomes
    what their sections hold, as chunks are placed in it. existing: sections a parser found itself.
    """
    routed = parsing.smart_route(docs.select(*_KEYS, "source_path", "mime_type", "full_text", *([hint] if hint else [])), hint=hint)
    routed = cut(routed.withColumn("document_date", parsing.document_date(F.col("full_text"))), "routed")
    segments = parsing.segment(routed, "document_id", "full_text", "document_type").where("body <> ''")
    if existing is None:
        sections = segments.withColumn("source", F.lit("segmenter"))
    else:
        sections = parsing.choose_sections(segments, existing, "document_id")
    kind = parsing.section_kind(F.col("section_ord"), F.col("heading"), F.col("body"))
    sections = cut(sections.withColumn("section_kind", kind), "sections")
    panels = routed.where("is_pdf and probable_lab")
    lab = cut(labrows.enrich(panels, "document_id", "full_text", existing), "lab-rows")
    text = parsing.joined_bodies(sections, "document_id").withColumnRenamed("full_text", "_joined")
    narrative = routed.where("is_pdf and not probable_lab").join(text, "document_id", "left").withColumn("full_text", F.coalesce("_joined", "full_text")).drop("_joined")
    return routed.where("not (is_pdf and not probable_lab)").unionByName(narrative), sections, lab


def family_hits(chunks: DataFrame, types: DataFrame, jobs: DataFrame, k: int) -> DataFrame:
    """Per document and family of its jobs the first k chunks of the family or of none, in document order, with their scores."""
    asked = jobs.groupBy("document_type").agg(F.collect_set("field_family").alias("_families"))
    c = chunks.join(types.select("document_id", "document_type"), "document_id").join(bounded(asked), "document_type")
    own = F.filter("_families", lambda f: F.col("field_family").isNull() | (F.col("field_family") == f))
    c = c.withColumn("_family", F.explode(own)).withColumn("retrieval_score", F.when(F.col("field_family").isNull(), UNTAGGED).otherwise(TAGGED))
    w = Window.partitionBy("document_id", "_family").orderBy("chunk_ord", "chunk_id")
    ranked = c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("document_id", "document_type", F.col("_family").alias("field_family"), "rank", "chunk_id", "chunk_ord", "text", "retrieval_score", (F.col("chunk_ord") * 1000 + F.col("rank")).cast("long").alias("ord"))


def build_candidates(observations: DataFrame, fields: DataFrame, run_date: str) -> DataFrame:
    """Observations(document_type, document_date, ...) as candidates of the form's fields: normalised, placed in time."""
    m = rules.map_to_fields(observations, fields)
    mm = F.col("normalization_rule") == "numeric_mm"
    value = rules.normalise(F.col("normalization_rule"), F.col("value"), F.coalesce("evidence_text", "raw_value"), F.col("unit"))
    return m.withColumns({
        "value": F.when(F.col("normalization_rule").isNotNull(), value).otherwise(F.col("value")), "unit": F.when(mm & F.col("value.n").isNotNull(), F.coalesce("unit", F.lit("mm"))).otherwise(F.col("unit")),
        "temporal_label": rules.temporal_label(F.col("temporal_scope")), "line_number": rules.line_number(F.col("temporal_scope")), "event_date": rules.event_date(F.col("document_date"), F.to_date(F.lit(run_date))),
    })


def score(candidates: DataFrame, hits: DataFrame) -> DataFrame:
    """Candidates with their blended confidence and whether it reaches the field's threshold; rows of panels had no retrieval."""
    best = hits.groupBy("document_id", "field_family").agg(F.max("retrieval_score").alias("_best"))
    c = candidates.join(best, ["document_id", "field_family"], "left")
    found = F.when(F.col("extraction_method") != extraction.ROWS_METHOD, F.coalesce("retrieval_score", "_best"))
    blended = rules.blend(F.col("confidence"), found)
    return c.withColumn("blended", blended).withColumn("accepted", blended >= F.col("autofill_threshold")).drop("_best")


def run_pipeline(
    docs: DataFrame,
    fields: DataFrame,
    run_date: str,
    registry: DataFrame | None = None,
    policy: str = "empty_only",
    aliases: DataFrame | None = None,
    existing: DataFrame | None = None,
    extract_fn: Callable[[str], list] | None = None,
    k: int = 5,
    hint: str | None = None,
) -> Run:
    """Documents through all stages. registry(patient_id, column_key, value): the form as it stands."""
    if policy not in etl.POLICIES:
        raise ValueError(f"policy must be one of {etl.POLICIES}")
    spark = docs.sparkSession
    safe_unions(spark)
    parsed, sections, lab = parse(docs, existing, hint)
    chunks = cut(chunking.chunk_documents(parsed, sections, lab, "document_id", "full_text"), "chunks")
    small = cut(parsed.drop("full_text"), "parsed")  # all later stages need of a document
    jobs = extraction.plan_jobs(fields)
    hits = family_hits(chunks, small, jobs, k)
    found = extraction.extract_all(hits, jobs, extract_fn)
    rows = extraction.rows_as_observations(lab, chunks)
    panels = small.where("document_type = 'lab_blood_panel'")
    found = extraction.lab_override(found, rows, panels)
    ident = F.concat(F.lit("obs_"), F.substring(F.sha2(F.concat_ws("|", "document_id", "chunk_id", "field_family", "canonical_key", "extraction_method", F.col("ord").cast("string"), "evidence_text"), 256), 1, 24))
    found = found.join(small.select(*_KEYS, "document_type", "document_date"), "document_id")
    observations = cut(found.withColumn("observation_id", ident), "observations")
    cells = registry if registry is not None else spark.createDataFrame([], "patient_id string, column_key string, value string")
    skip = etl.columns_to_skip(cells, policy, fields.select(F.col("target_column").alias("column_key")))
    c = build_candidates(observations, fields, run_date)
    c = c.join(skip.select("patient_id", F.col("column_key").alias("target_column")), ["patient_id", "target_column"], "left_anti")
    candidates = cut(score(c, hits), "candidates")
    kept = candidates.where("accepted")
    best = rules.best_per_column(kept, [*_KEYS, "target_column"], "blended", "ord", ["field_name", "field_type", "value", "unit", "event_date", "temporal_label", "observation_id", "evidence_text", "document_type"])
    best = best.withColumn("errors", rules.validate(F.col("field_type"), F.col("value"))).withColumn("validated", F.size("errors") == 0)
    column = best.withColumnRenamed("target_column", "column_key")
    if aliases is not None:
        column = etl.aliased(column, aliases, "column_key").drop("column_key").withColumnRenamed("header", "column_key")
    shown = F.coalesce("value.s", F.col("value.n").cast("string"), F.col("value.b").cast("string"))
    split = etl.partition_updates(column.withColumn("shown", shown), cells, policy)
    # one cell of a patient may be filled from several documents: the most confident one writes it
    updates = split.where("accepted").drop("existing")
    write = F.max_by("shown", F.struct("blended", F.col("event_date"), "document_id"))
    new = updates.where("validated").groupBy("patient_id", "column_key").agg(write.alias("value"))
    merged = etl.merge_cells(cells, new, policy)
    audit = audit_trail(run_date, policy, small, sections, lab, chunks, hits, observations, candidates, column, split)
    return Run(parsed, sections, lab, chunks, jobs, hits, observations, candidates, updates, split.where("not accepted"), merged, audit)


def audit_trail(run_date: str, policy: str, small: DataFrame, sections: DataFrame, lab: DataFrame, chunks: DataFrame, hits: DataFrame, observations: DataFrame, candidates: DataFrame, best: DataFrame, split: DataFrame) -> DataFrame:
    """The records of a run: one a document and step, one an observation, one a checked cell."""
    at = F.to_timestamp(F.lit(run_date))

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("document_id").agg(F.count("*").alias(name))

    counts = [counted(sections, "n_sections"), counted(lab, "n_lab_lines"), counted(chunks, "n_chunks"), counted(candidates, "n_candidates"), counted(best, "n_cells"), counted(split.where("accepted"), "n_accepted")]
    per_family = hits.groupBy("document_id", "field_family").agg(F.count("*").alias("n")).groupBy("document_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field_family", "n")))).alias("hits"))
    d = reduce(lambda a, b: a.join(b, "document_id", "left"), [small, *counts, per_family])
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    steps = {
        "ingestion": F.struct(F.col("mime_type").alias("mime"), F.col("source_path").alias("path")), "parsing": F.struct(n("n_sections"), n("n_lab_lines")), "chunking": F.struct(n("n_chunks")), "routing": F.struct("document_type", "chunking_strategy"),
        "indexing": F.struct(F.col("study_id").alias("tenant"), n("n_chunks")), "ecrf_prefilter": F.struct(F.lit(policy).alias("policy")), "retrieval": F.struct(F.coalesce("hits", F.create_map().cast("map<string,bigint>")).alias("hits")),
        "temporal_mapping": F.struct(n("n_candidates")), "field_mapping": F.struct(n("n_cells")), "ecrf_export_policy": F.struct(F.lit(policy).alias("policy"), n("n_cells"), n("n_accepted")), "export": F.struct(n("n_accepted")),
    }
    # one pass over the documents: all its steps come out of one row
    each = F.array(*[F.struct(F.lit(s).alias("step"), F.to_json(x).alias("details")) for s, x in steps.items()])
    wide = d.select(*_KEYS, F.explode(each).alias("x")).select(*_KEYS, "x.*")
    documents = wide.select(
        at.alias("recorded_at"), *_KEYS, "step", F.lit(None).cast("string").alias("model_name"), F.lit(None).cast("string").alias("source_chunk_id"), F.lit(None).cast("string").alias("evidence_excerpt"), F.lit(None).cast("double").alias("confidence"),
        F.when(F.col("step") == "ingestion", etl.redact_json("details")).otherwise(F.col("details")).alias("details"),
    )
    seen = etl.audit_records(observations, "extraction", F.to_json(F.struct("field_family", "extraction_method")), at, F.col("confidence"), F.col("evidence_text"), chunk=F.col("chunk_id"))
    checked = etl.audit_records(best, "validation", F.to_json(F.struct(F.col("column_key").alias("column"), F.col("validated").alias("ok"), "errors")), at, F.col("blended"), F.col("evidence_text"))
    return documents.unionByName(seen).unionByName(checked)
