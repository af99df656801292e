"""Form export: empty cells, headers and aliases, patient keys, overwrite policy, merge, templates, audit.

Null and sentinel cells count as empty; numbers and booleans never do. Of equal headers the first
counts; unknown headers and patients are reported, never dropped.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from formloom.session import bounded

POLICIES = ("empty_only", "always", "never")


def is_empty_cell(text: Column, sentinels: tuple[str, ...] = ("na",)) -> Column:
    t = F.lower(F.trim(text))
    return text.isNull() | (t == "") | t.isin(*[s.lower() for s in sentinels])


def header_map(headers: DataFrame) -> DataFrame:
    """(header, ord, n): the first position of each header and how often it stands."""
    return headers.groupBy("header").agg(F.min("ord").alias("ord"), F.count("*").alias("n"))


def aliased(updates: DataFrame, aliases: DataFrame, column: str) -> DataFrame:
    """Column names through the alias table; unknown ones stay."""
    a = aliases.select(F.col("alias").alias("_a"), F.col("header").alias("_h"))
    return updates.join(bounded(a), F.col(column) == F.col("_a"), "left").withColumn("header", F.coalesce("_h", F.col(column))).drop("_a", "_h")


def number_key(c: Column) -> Column:
    """Patient ids that are equal as numbers get one key, so the join stays an equality."""
    n = F.trim(c).try_cast("double")
    return F.coalesce(n.cast("string"), F.trim(c))


def resolve_patients(patients: DataFrame, mapping: DataFrame, registry: DataFrame) -> DataFrame:
    """(patient_id, registry_key, source, in_registry): explicit key, map, direct match, else the id itself."""
    m = mapping.select("patient_id", F.col("mapped").alias("_m")).dropDuplicates(["patient_id"])
    r = registry.select(number_key(F.col("registry_id")).alias("_rk")).distinct()
    df = patients.join(m, "patient_id", "left").withColumn("_direct", number_key(F.col("patient_id")))
    df = df.join(r.withColumnRenamed("_rk", "_d"), F.col("_direct") == F.col("_d"), "left")
    key = F.coalesce("explicit", "_m", "patient_id")
    source = F.when(F.col("explicit").isNotNull(), "explicit").when(F.col("_m").isNotNull(), "map_file").when(F.col("_d").isNotNull(), "direct_match").otherwise("pipeline_id")
    df = df.select("patient_id", key.alias("registry_key"), source.alias("source"))
    return df.join(r, number_key(F.col("registry_key")) == F.col("_rk"), "left").select("patient_id", "registry_key", "source", F.col("_rk").isNotNull().alias("in_registry"))


def partition_updates(updates: DataFrame, cells: DataFrame, policy: str) -> DataFrame:
    """updates(patient_id, column_key, value) with `accepted`, and the value that stands where they're held back."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    c = cells.select("patient_id", "column_key", F.col("value").alias("existing"))
    j = updates.join(c, ["patient_id", "column_key"], "left")
    filled = ~is_empty_cell(F.col("existing"))
    ok = {"always": F.lit(True), "never": F.lit(False), "empty_only": ~filled}[policy]
    return j.withColumn("accepted", ok).withColumn("existing", F.when(~ok & filled, F.col("existing")))


def columns_to_skip(cells: DataFrame, policy: str, targets: DataFrame | None = None) -> DataFrame:
    """(patient_id, column_key) no job needs to fill: `never` skips every target column of every patient, `empty_only` the filled ones.

    targets(column_key): the columns the form's fields write; without them `never` can only name the columns that exist.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    filled = cells.where(~is_empty_cell(F.col("value"))).select("patient_id", "column_key").distinct()
    if policy == "always":
        return filled.limit(0)
    if policy == "empty_only":
        return filled
    if targets is None:
        return cells.select("patient_id", "column_key").distinct()
    # every patient by every column of the form: the columns are a fixed list, added inside the patient's row
    columns = [r[0] for r in targets.select("column_key").where("column_key is not null").distinct().collect()]
    return cells.select("patient_id").distinct().withColumn("column_key", F.explode(F.array(*[F.lit(c) for c in columns])) if columns else F.lit(None).cast("string")).where("column_key is not null")


def merge_cells(cells: DataFrame, updates: DataFrame, policy: str) -> DataFrame:
    """The registry after the updates: MERGE as one full join; unknown patients' cells are appended."""
    u = updates.select("patient_id", "column_key", F.col("value").alias("_new"))
    j = cells.join(u, ["patient_id", "column_key"], "full")
    old, new = F.col("value"), F.col("_new")
    take = {"always": new.isNotNull(), "never": F.lit(False), "empty_only": new.isNotNull() & is_empty_cell(old)}[policy]
    return j.select("patient_id", "column_key", F.when(take, new).otherwise(old).alias("value"))


def merge_stats(cells: DataFrame, updates: DataFrame, policy: str, by: list[str]) -> DataFrame:
    """Per group: how many cells were written, kept because they are filled, left as equal, and how many rows are new."""
    known = cells.select("patient_id").distinct().withColumn("_known", F.lit(True))
    u = updates.select(*dict.fromkeys([*by, "patient_id", "column_key"]), F.col("value").alias("_new")).where("_new is not null")
    j = u.join(cells.select("patient_id", "column_key", F.col("value").alias("_old")), ["patient_id", "column_key"], "left").join(known, "patient_id", "left")
    filled = ~is_empty_cell(F.col("_old"))
    write = {"always": F.lit(True), "never": F.lit(False), "empty_only": ~filled}[policy]
    return j.groupBy(*by).agg(
        F.count_if(write).alias("written"), F.count_if(~write & filled).alias("kept"), F.count_if(write & F.col("_old").eqNullSafe(F.col("_new"))).alias("unchanged"),
        F.countDistinct(F.when(F.col("_known").isNull(), F.col("patient_id"))).alias("new_rows"),
    )


def snapshot(sheet: DataFrame, key: str, headers: list[str] | None = None) -> DataFrame:
    """(patient_id, column_key, value) of a wide workbook sheet: one row per patient and header; of equal headers the first counts."""
    seen: dict[str, str] = {}
    for c in headers or sheet.columns:
        if c != key:
            seen.setdefault(c, c)
    pairs = F.array(*[F.struct(F.lit(h).alias("column_key"), F.col(f"`{c}`").cast("string").alias("value")) for h, c in seen.items()])
    return sheet.where(F.col(f"`{key}`").isNotNull()).select(number_key(F.col(f"`{key}`").cast("string")).alias("patient_id"), F.explode(pairs).alias("p")).select("patient_id", "p.*")


def duplicate_headers(headers: DataFrame) -> DataFrame:
    """The headers that stand more than once."""
    return headers.where("header is not null").groupBy("header").agg(F.count("*").alias("n")).where("n > 1")


def parse_sentinels(text: str | None) -> tuple[str, ...]:
    """The sentinel texts of a comma-separated setting, trimmed, blank ones left out."""
    return tuple(x.strip().lower() for x in (text or "").split(",") if x.strip())


def coerce_patient_id(c: Column) -> Column:
    """How a sheet stores a patient id: whole numbers without point, other numbers as they are, else the trimmed text."""
    n = F.trim(c).try_cast("double")
    return F.when(n.isNotNull() & (n == F.floor(n)) & (F.abs(n) < 1e15), n.cast("bigint").cast("string")).when(n.isNotNull(), n.cast("string")).otherwise(F.trim(c))


def missing_patients(resolved: DataFrame, required: bool = True) -> DataFrame:
    """The resolved patients without a row in the registry; none are missing where no row is required."""
    return resolved.where(~F.col("in_registry") & F.lit(required)).select("patient_id", "registry_key", "source")


def wide(cells: DataFrame, key: str, column: str, value: str, columns: list[str]) -> DataFrame:
    """One row per key; the columns are given, so no extra job finds them."""
    return cells.groupBy(key).agg(*[F.max(F.when(F.col(column) == c, F.col(value))).alias(c) for c in columns])


def _quoted(c: Column) -> Column:
    """A text as a JSON string."""
    return F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)


def lab_template(lines: DataFrame) -> DataFrame:
    """(document_id, template): nested section > subsection > analyte > {valeur, unité}, the last row of a name wins.

    `unité` stands beside numbers and wherever a unit is given.
    """
    v = F.col("value")
    shown = F.when(v["kind"] == "n", v["n"].cast("string")).when(v["kind"] == "b", v["b"].cast("string")).when(v["s"].isNotNull(), _quoted(v["s"])).otherwise("null")
    unit = F.when(F.col("unit").isNotNull(), _quoted(F.col("unit"))).otherwise("null")
    leaf = F.concat(F.lit('{"valeur":'), shown, F.when((v["kind"] == "n") | F.col("unit").isNotNull(), F.concat(F.lit(',"unité":'), unit)).otherwise(""), F.lit("}"))
    rows = lines.select(
        "document_id", F.coalesce("section", F.lit("Uncategorized")).alias("section"), F.coalesce("subsection", "section", F.lit("Uncategorized")).alias("subsection"), "name", "ord", "line_id", leaf.alias("leaf"),
    ).where("name is not null")
    level = rows.groupBy("document_id", "section", "subsection", "name").agg(F.max_by("leaf", F.struct("ord", "line_id")).alias("leaf"))
    for keys, name in ((["document_id", "section", "subsection"], "name"), (["document_id", "section"], "subsection"), (["document_id"], "section")):
        parts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(name).alias("k"), F.col("leaf").alias("v")))), lambda x: F.concat(_quoted(x["k"]), F.lit(":"), x["v"]))
        level = level.groupBy(*keys).agg(F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")).alias("leaf"))
    return level.select("document_id", F.col("leaf").alias("template"))


def imaging_template(updates: DataFrame) -> DataFrame:
    """(patient_id, template) of the valid, non-null imaging updates."""
    u = updates.where("validated and value is not null")
    return u.groupBy("patient_id").agg(F.to_json(F.struct(F.map_from_entries(F.array_sort(F.collect_list(F.struct("column_key", F.struct(F.col("value").alias("valeur"), F.col("unit").alias("unite")))))).alias("Imaging_RECIST"))).alias("template"))


def redact_path(path: Column) -> Column:
    """The file name of a path, by either separator."""
    return F.regexp_extract(path, r"[^/\\]+$", 0)


#: Keys whose values are paths, and how deep nested objects are followed (fixed values).
PATH_KEYS, MAX_DEPTH = ("path", "source_path", "document_path", "json", "csv"), 32


def _redacted(x, depth: int = 0):
    if depth > MAX_DEPTH:
        return x
    if isinstance(x, dict):
        return {k: re.split(r"[/\\]", v)[-1] if k in PATH_KEYS and isinstance(v, str) else _redacted(v, depth + 1) for k, v in x.items()}
    return [_redacted(v, depth + 1) for v in x] if isinstance(x, list) else x


@F.pandas_udf(StringType())
def redact_json(texts: pd.Series) -> pd.Series:
    """JSON objects with file names in place of paths, at any depth up to MAX_DEPTH; what is no JSON stays."""
    def one(t):
        if t is None:
            return None
        try:
            return json.dumps(_redacted(json.loads(t)), ensure_ascii=False, separators=(",", ":"))
        except ValueError:
            return t

    return texts.map(one)


#: The steps of a run, in order.
STEPS = ("ingestion", "parsing", "chunking", "routing", "indexing", "ecrf_prefilter", "retrieval", "extraction", "temporal_mapping", "field_mapping", "validation", "ecrf_export_policy", "export")


def excerpt(text: Column, limit: int = 500) -> Column:
    return F.substring(text, 1, limit)


def audit_records(rows: DataFrame, step: str, details: Column, recorded_at: Column, confidence: Column | None = None, evidence: Column | None = None, model: Column | None = None, chunk: Column | None = None) -> DataFrame:
    """One audit record per row of (document_id, patient_id, study_id): step, details as JSON without paths, evidence cut to 500 characters."""
    if step not in STEPS:
        raise ValueError(f"step must be one of {STEPS}")
    none = F.lit(None).cast("string")
    return rows.select(
        recorded_at.alias("recorded_at"), "document_id", "patient_id", "study_id", F.lit(step).alias("step"), (model if model is not None else none).alias("model_name"),
        (chunk if chunk is not None else none).alias("source_chunk_id"), (excerpt(evidence) if evidence is not None else none).alias("evidence_excerpt"),
        (confidence if confidence is not None else F.lit(None).cast("double")).cast("double").alias("confidence"), redact_json(details).alias("details"),
    )


def audit_counts(audit: DataFrame) -> DataFrame:
    """Records, distinct documents and mean confidence per step; of a record delivered again only one counts."""
    one = audit.groupBy("record_id").agg(F.max_by(F.struct("step", "document_id", "confidence"), F.struct("received_at", "step")).alias("r")).select("r.*")
    return one.groupBy("step").agg(F.count("*").alias("n_records"), F.countDistinct("document_id").alias("n_documents"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


def carry_forward(df: DataFrame, by: str, order: list[str], value: Column, out: str) -> DataFrame:
    """The last non-null value at or before each row."""
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))
