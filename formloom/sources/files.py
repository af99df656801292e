"""Files in and out: documents, study schema, alias and patient maps, results.

Unreadable optional files give an empty map and a warning; a broken schema raises one error with all
its faults; PDF text needs an optional parser and never fails a task.
"""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.operators import etl, extraction, parsing

log = logging.getLogger(__name__)
FIELD_TYPES = ("numeric", "boolean", "categorical")


class MissingPackageError(ImportError):
    """An optional package that a chosen backend needs is not installed."""


#: What a PDF parser gives: text, the sections it found itself, notes.
PARSED = "struct<text:string,sections:array<struct<heading:string,body:string>>,pages:int,encrypted:boolean,parser:string,warnings:array<string>>"
#: Failures of a structure parser after which the plain one is tried even where the first was demanded (fixed values).
RECOVERABLE = ("connection", "timeout", "timed out", "network", "401", "403", "unauthorized", "forbidden", "token", "ssl", "resolve")


def plain_pdf(content: bytes) -> dict:
    """Pages joined by blank lines; a page that fails is empty. Needs pypdf."""
    import io

    try:
        import pypdf
    except ImportError as e:
        raise MissingPackageError("pypdf is not installed") from e
    reader = pypdf.PdfReader(io.BytesIO(content))
    pages = []
    for p in reader.pages:
        try:
            pages.append((p.extract_text() or "").strip())
        except Exception:
            pages.append("")
    return {"text": "\n\n".join(pages).strip(), "sections": [], "pages": len(pages), "encrypted": bool(reader.is_encrypted)}


def available(package: str) -> bool:
    import importlib.util

    return importlib.util.find_spec(package) is not None


def parse_pdf(content: bytes, backend: str = "auto", structure: Callable[[bytes], dict] | None = None, plain: Callable[[bytes], dict] | None = plain_pdf) -> dict:
    """One PDF by the chosen backend: `structure`, `plain`, or `auto` (structure first, plain after any failure).

    A demanded structure parser gives way only to recoverable failures. Text that comes out empty is read
    again by the plain parser. Nothing is raised but what was demanded and cannot be had.
    """
    if backend not in ("auto", "structure", "plain"):
        raise ValueError(f"backend must be auto, structure or plain, not {backend!r}")
    notes: list[str] = []
    out = None
    if backend != "plain":
        try:
            if structure is None:
                raise MissingPackageError("no structure parser")
            out = {"parser": "structure", **structure(content)}
        except Exception as e:
            if backend == "structure" and (isinstance(e, ImportError) or not any(w in str(e).lower() for w in RECOVERABLE)):
                raise
            notes.append(f"structure parser failed: {e}")
    if out is None:
        try:
            out = {"parser": "plain", **plain(content)} if plain else None
        except Exception as e:
            notes.append(f"plain parser failed: {e}")
    if out is not None and out["parser"] == "structure" and not (out.get("text") or "").strip() and plain:
        try:
            out = {"parser": "plain", **plain(content)}
            notes.append("fallback_after_empty_primary")
        except Exception as e:
            notes.append(f"plain parser failed: {e}")
    out = out or {"parser": None, "text": ""}
    return {"text": out.get("text") or "", "sections": out.get("sections") or [], "pages": out.get("pages"), "encrypted": out.get("encrypted"), "parser": out["parser"], "warnings": notes}


def read_documents(spark: SparkSession, path: str, parse: Callable[[bytes], dict | str] | None = None, manifest: DataFrame | None = None) -> DataFrame:
    """(document_id, source_path, mime_type, full_text, ingested_at, sections, parser, warnings, ...) of a folder.

    Ids are content hashes, so reruns agree; manifest(file_name, patient_id, study_id) names whose they are.
    parse(content) reads a PDF (`parse_pdf` with its options, or any callable giving text); without one PDF
    files come out without text. A missing folder is an error; a broken file is a document without text.
    """
    try:
        raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        some = raw.select("path").limit(1).count()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        some = 0
    if not some:
        raise FileNotFoundError(path)
    df = raw.select(
        F.concat(F.lit("doc-"), F.substring(F.sha2("content", 256), 1, 16)).alias("document_id"), F.col("path").alias("source_path"),
        parsing.mime_type(F.col("path")).alias("mime_type"), F.col("modificationTime").alias("ingested_at"), "content",
    )

    @F.pandas_udf(PARSED)
    def read(contents: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in contents:
            yield pd.DataFrame([_safely(parse, b) for b in s], columns=["text", "sections", "pages", "encrypted", "parser", "warnings"])

    pdf = parsing.is_pdf(F.col("mime_type"), F.col("source_path"))
    none = F.from_json(F.lit('{"text":""}'), PARSED)
    df = df.withColumn("_p", F.when(pdf, read("content") if parse is not None else none))
    df = df.withColumn("full_text", F.when(pdf, F.col("_p.text")).otherwise(parsing.decode_text(F.col("content"))))
    df = df.select("document_id", "source_path", "mime_type", "full_text", "ingested_at", "_p.sections", "_p.pages", "_p.encrypted", "_p.parser", "_p.warnings")
    if manifest is not None:
        df = df.withColumn("file_name", etl.redact_path(F.col("source_path"))).join(manifest, "file_name", "left").drop("file_name")
    return df


def sections_of(docs: DataFrame) -> DataFrame:
    """(document_id, section_ord, heading, body, source) of what the parsers found themselves."""
    x = docs.where("sections is not null").select("document_id", F.posexplode("sections").alias("section_ord", "s"))
    return x.select("document_id", "section_ord", "s.heading", "s.body", F.lit("layout_parser").alias("source"))


def _safely(parse: Callable, content: bytes) -> dict:
    try:
        out = parse(content)
        if isinstance(out, str):
            out = {"text": out}
        return {"text": out.get("text") or "", "sections": out.get("sections") or [], "pages": out.get("pages"), "encrypted": out.get("encrypted"), "parser": out.get("parser"), "warnings": out.get("warnings") or []}
    except Exception as e:  # a broken file is a document without text
        log.warning("unreadable document: %s", e)
        return {"text": "", "sections": [], "pages": None, "encrypted": None, "parser": None, "warnings": [f"unreadable: {e}"]}


class SchemaError(ValueError):
    pass


@dataclass(frozen=True)
class Study:
    """A study schema: its fields as a table, and the catalogue beside them."""

    study_id: str
    version: str
    fields: DataFrame
    family_queries: dict[str, str]
    analytes: tuple[tuple, ...]
    keywords: dict[str, tuple[str, ...]]
    classes: dict[str, str]


FIELD_SCHEMA = (
    "field_ord int, field_name string, field_type string, document_types_allowed array<string>, extraction_family string, field_family string, temporal_scope string, normalization_rule string, "
    "target_column string, autofill_threshold double, canonical_key string, extraction_strategy string, langextract_class string, retrieval_query string"
)


def read_study(spark: SparkSession, path: str) -> Study:
    """A study schema file, checked as a whole; its own analytes, keywords and classes, else the built-in ones."""
    raw = json.loads(Path(path).read_text(encoding="utf-8"))
    faults, seen, rows = [], set(), []
    for i, f in enumerate(raw.get("fields", [])):
        name = f.get("field_name")
        if not name or name in seen:
            faults.append(f"field {i}: name missing or repeated: {name!r}")
        seen.add(name)
        if f.get("field_type") not in FIELD_TYPES:
            faults.append(f"field {name}: type {f.get('field_type')!r}")
        t = f.get("autofill_threshold", 0.65)
        if not 0 <= t <= 1:
            faults.append(f"field {name}: threshold {t}")
        if f.get("extraction_strategy", "none") != "none" and not f.get("canonical_key"):
            faults.append(f"field {name}: strategy without canonical key")
        rows.append((
            i, name, f.get("field_type"), f.get("document_types_allowed", []), f.get("extraction_family"), f.get("field_family"), f.get("temporal_scope"), f.get("normalization_rule"), f.get("target_column"), float(t), f.get("canonical_key"),
            f.get("extraction_strategy"), f.get("langextract_class"), f.get("retrieval_query"),
        ))
    catalog = raw.get("extraction_catalog") or {}
    analytes = []
    for a in catalog.get("lab_analytes", []):
        try:
            re.compile(a["pattern"])
            analytes.append((a["canonical_key"], a["pattern"], a.get("unit"), a.get("field_family")))
        except (re.error, KeyError) as e:
            faults.append(f"analyte {a.get('canonical_key')}: {e}")
    if faults:
        raise SchemaError("; ".join(faults))
    words = {k["canonical_key"]: tuple(k["keywords"]) for k in catalog.get("narrative_keywords", [])}
    return Study(
        raw.get("study_id", ""), str(raw.get("schema_version", "1")), spark.createDataFrame(rows, FIELD_SCHEMA), dict(raw.get("family_retrieval_queries") or {}), tuple(analytes) or extraction.ANALYTES, words or dict(extraction.KEYWORDS),
        {**extraction.CLASS_KEYS, **(catalog.get("langextract_class_map") or {})},
    )


def read_schema(spark: SparkSession, path: str) -> DataFrame:
    """The fields of a study schema file, checked as a whole."""
    return read_study(spark, path).fields


def analytes_for(study: Study, keys: set[str]) -> tuple[tuple, ...]:
    """The analytes of some keys; no keys ask for all."""
    return tuple(a for a in study.analytes if not keys or a[0] in keys)


def keywords_for(study: Study, keys: set[str]) -> dict[str, tuple[str, ...]]:
    return {k: v for k, v in study.keywords.items() if not keys or k in keys}


def fields_per_family(fields: DataFrame) -> DataFrame:
    """(extraction_family, field_family, n_fields)."""
    return fields.groupBy("extraction_family", "field_family").agg(F.count("*").alias("n_fields"))


def quarantine(rows: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows that fail with `faults`): checks name what is wrong where they are false or null."""
    faults = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
    x = rows.withColumn("faults", faults)
    return x.where("size(faults) = 0").drop("faults"), x.where("size(faults) > 0")


def read_map(path: str, strict: bool = False) -> dict[str, str]:
    """A JSON object of texts; unreadable files warn, or raise where strict."""
    try:
        raw = json.loads(Path(path).read_text(encoding="utf-8"))
        if not isinstance(raw, dict):
            raise ValueError("an object is expected")
        return {str(k): str(v) for k, v in raw.items()}
    except (OSError, ValueError) as e:
        if strict:
            raise ValueError(f"{path}: {e}") from e
        log.warning("map not read: %s: %s", path, e)
        return {}


def read_aliases(path: str | None, built_in: dict[str, str] | None = None, default: str | None = None) -> dict[str, str]:
    """Built-in header aliases with those of a file; a named file takes the place of the default one."""
    chosen = path or (default if default and Path(default).exists() else None)
    return {**(built_in or {}), **(read_map(chosen) if chosen else {})}


def read_sheet(spark: SparkSession, path: str, sheet: str = "Global_CC", header_row: int = 2, reader: Callable | None = None) -> DataFrame | None:
    """A wide registry: a Parquet or CSV table, or a workbook sheet through an optional adapter; None where it cannot be had."""
    try:
        if path.endswith(".parquet"):
            return spark.read.parquet(path)
        if path.endswith(".csv"):
            return spark.read.option("header", "true").csv(path)
        if reader is None:
            if not available("openpyxl"):
                raise MissingPackageError("openpyxl is not installed")
            reader = lambda p, s, h: pd.read_excel(p, sheet_name=s, header=h - 1, dtype=str)
        return spark.createDataFrame(reader(path, sheet, header_row).astype(object).where(lambda d: d.notna(), None))
    except Exception as e:
        log.warning("registry not read: %s: %s", path, e)
        return None


def pending(inputs: DataFrame, done: DataFrame, key: str, overwrite: bool = False, limit: int | None = None) -> DataFrame:
    """What is still to be run: inputs without a result, all of them where results are overwritten; the first `limit` by key if given."""
    left = inputs if overwrite else inputs.join(done.select(key).distinct(), key, "left_anti")
    return left.orderBy(key).limit(limit) if limit is not None else left


def read_template(text: str) -> dict:
    """A template object; a repeated key is an error."""
    def pairs(items: list) -> dict:
        out: dict = {}
        for k, v in items:
            if k in out:
                raise ValueError(f"repeated key {k!r}")
            out[k] = v
        return out

    raw = json.loads(text, object_pairs_hook=pairs)
    if not isinstance(raw, dict):
        raise ValueError("an object is expected")
    return raw


def flatten_template(raw: dict, path: tuple = ()) -> Iterator[tuple[tuple, object, str | None, bool]]:
    """(path, value, unit, unit declared) of every leaf, which is an object with `valeur`."""
    if "valeur" in raw:
        unit = raw.get("unité", raw.get("unite"))
        yield path, raw["valeur"], unit, "unité" in raw or "unite" in raw
        return
    for k, v in raw.items():
        if isinstance(v, dict):
            yield from flatten_template(v, (*path, k))


def write_json(df: DataFrame, path: str, partition: str | None = None) -> None:
    """JSON lines; path-like columns keep only the file's name, and so do path-like keys of JSON columns named `details` or `metadata`."""
    for c in etl.PATH_KEYS:
        if dict(df.dtypes).get(c) == "string":
            df = df.withColumn(c, etl.redact_path(F.col(c)))
    for c in ("details", "metadata"):
        if dict(df.dtypes).get(c) == "string":
            df = df.withColumn(c, etl.redact_json(c))
    w = df.write.mode("overwrite")
    (w.partitionBy(partition) if partition else w).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def form_rows(updates: DataFrame, columns: list[str]) -> DataFrame:
    """One row per document: its ids, type and a column for every column of the form, filled by the accepted updates."""
    ids = ["document_id", "patient_id", "study_id", "document_type"]
    shown = F.coalesce("value.s", F.col("value.n").cast("string"), F.col("value.b").cast("string"))
    return updates.groupBy(*ids).agg(F.count("*").alias("n_updates"), *[F.max(F.when(F.col("column_key") == c, shown)).alias(c) for c in columns])


# --- synthetic reports --------------------------------------------------------------------------------------
CODES = ("CR", "PR", "SD", "PD", "NE")


def synthetic_reports(spark: SparkSession, n: int, seed: int = 20260821) -> DataFrame:
    """(report_id, baseline_mm, current_mm, code, text): imaging reports with known answers and distracting sizes, by rule from id and seed."""
    i = F.col("id")
    h = lambda a, m: F.pmod((i + seed) * a + F.lit(seed % 9973), F.lit(m)).cast("int")
    base, now, other = 18 + h(7919, 79), 18 + h(104729, 79), 5 + h(1299709, 12)
    code = F.element_at(F.array(*[F.lit(c) for c in CODES]), h(15485863, 5) + 1)
    size = F.when(h(31, 3) == 0, F.concat((base / 10).cast("decimal(6,1)").cast("string"), F.lit(" cm"))).otherwise(F.concat(base.cast("string"), F.lit(" mm")))
    text = F.concat(
        F.lit("INDICATION : suivi sous traitement.\nExamen actuel : cible de "), now.cast("string"), F.lit(" mm.\nLésion non cible de "), other.cast("string"), F.lit(" mm.\nAu bilan d'inclusion, la cible mesurait "), size,
        F.lit(".\nCONCLUSION : catégorie RECIST retenue : "), code, F.lit("."),
    )
    return spark.range(n).select(i.alias("report_id"), base.alias("baseline_mm"), now.alias("current_mm"), code.alias("code"), text.alias("text"))
