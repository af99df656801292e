"""Maintenance of the chunk index as tables: upsert, delete, version check, paging, tenant names.

The index is a table partitioned by tenant; an upsert is a hash aggregate over old and new rows.
Null ids form no row; of rows with one id the latest stays, then the smallest order.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.operators.chunking import passage

log = logging.getLogger(__name__)

NAMESPACE_URL = "6ba7b8119dad11d180b400c04fd430c8"  # fixed value of the UUID standard


def upsert(chunks: DataFrame) -> DataFrame:
    """The latest row of every chunk_id."""
    cols = [F.col(c) for c in chunks.columns]
    latest = F.max_by(F.struct(*cols), F.struct("indexed_at", (-F.col("chunk_ord")).alias("o"), "char_start", "text"))
    return chunks.where("chunk_id is not null").groupBy(F.col("chunk_id").alias("_id")).agg(latest.alias("r")).select("r.*")


def delete_documents(index: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(what stays, number deleted per document)."""
    ids = gone.select("document_id").where("document_id is not null").distinct()
    return index.join(ids, "document_id", "left_anti"), index.join(ids, "document_id", "left_semi").groupBy("document_id").agg(F.count("*").alias("deleted"))


def version_conflicts(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Documents whose stored rows carry another version than the incoming ones."""
    a = stored.select("document_id", F.col("version").alias("stored_version")).where("stored_version is not null").distinct()
    b = incoming.select("document_id", F.col("version").alias("incoming_version")).where("incoming_version is not null").distinct()
    return a.join(b, "document_id").where("stored_version <> incoming_version")


def page(index: DataFrame, key: str, after: str | None, size: int) -> DataFrame:
    """The next rows by key: keyset paging, so page n costs as much as page one."""
    if size < 1:
        raise ValueError("size must be at least 1")
    rows = index if after is None else index.where(F.col(key) > after)
    return rows.orderBy(key).limit(size)


def tenant_name(raw: Column) -> Column:
    return F.substring(F.regexp_replace(raw, "[^A-Za-z0-9_-]", "_"), 1, 60)


def collection_of(prefix: str, tenant: Column) -> Column:
    return F.when(F.trim(tenant) != "", F.concat(F.lit(prefix + "__"), tenant_name(tenant)))


def point_id(chunk_id: Column) -> Column:
    """Version 5 UUID of a chunk id."""
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_URL)), F.encode(chunk_id, "utf-8")))
    variant = F.element_at(F.array(*[F.lit(x) for x in "89ab"]), F.pmod(F.conv(F.substring(h, 17, 1), 16, 10).cast("int"), F.lit(4)) + 1)
    s = lambda a, n: F.substring(h, a, n)
    return F.concat(s(1, 8), F.lit("-"), s(9, 4), F.lit("-5"), s(14, 3), F.lit("-"), variant, s(18, 3), F.lit("-"), s(21, 12))


def require_tenant(tenant: str | None) -> str:
    if not tenant or not tenant.strip():
        raise ValueError("a tenant is required")
    return tenant.strip()


def strict_tenant(tenant: str) -> str:
    """The tenant where its name needs no change, else an error."""
    import re

    if not re.fullmatch(r"[A-Za-z0-9_-]{1,60}", tenant or ""):
        raise ValueError(f"not a plain tenant name: {tenant!r}")
    return tenant


def filtered(
    index: DataFrame, tenant: str, document_id: str | None = None, families: list[str] | None = None, version: str | None = None, patient_id: str | None = None, document_type: str | None = None,
) -> DataFrame:
    """Rows of a tenant under optional filters, all of which hold; untagged rows pass a family filter.

    The index is partitioned by tenant, so the tenant prunes its files.
    """
    df = index.where(F.col("tenant") == require_tenant(tenant))
    for column, wanted in (("document_id", document_id), ("patient_id", patient_id), ("document_type", document_type)):
        if wanted is not None:
            df = df.where(F.col(column) == wanted)
    if families:
        df = df.where(F.col("field_family").isin(families) | F.col("field_family").isNull())
    return df.where(F.col("version") == version) if version is not None else df


def health(index: DataFrame) -> DataFrame:
    return index.agg(F.count("*").alias("n_rows"), F.count_if(F.col("field_family").isNull()).alias("untagged"), F.approx_count_distinct("document_id", 0.01).alias("documents"))


class ReadOnlyError(RuntimeError):
    pass


class IndexMismatchError(ValueError):
    pass


#: Columns of an index table (fixed values: the payload of a stored chunk).
PAYLOAD = (
    "tenant", "patient_id", "study_id", "document_id", "document_type", "field_family", "chunk_id", "heading", "section_ord", "part", "content_kind", "char_start", "char_end", "verified", "version", "model", "dim", "text",
)


def payload(chunks: DataFrame, tenant: Column, version: str, model: str, dim: int) -> DataFrame:
    """Chunks as rows of the index: the payload's columns, missing ones null, with id and the passage that is embedded."""
    have = set(chunks.columns)
    given = {"tenant": tenant, "version": F.lit(version), "model": F.lit(model), "dim": F.lit(dim)}
    cols = [given[c].alias(c) if c in given else F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in PAYLOAD]
    head = F.col("heading") if "heading" in have else F.lit(None).cast("string")
    return chunks.where("chunk_id is not null").select(*cols, point_id(F.col("chunk_id")).alias("point_id"), passage(head, F.col("text")).alias("passage"), *[c for c in ("indexed_at", "chunk_ord") if c in have])


def metadata_of(row: DataFrame) -> DataFrame:
    """Stored rows back as chunks: columns of their own and a map of what else is known; nulls go."""
    own = ("chunk_id", "document_id", "text", "field_family", "char_start", "char_end")
    rest = [c for c in PAYLOAD if c not in own]
    m = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in rest]), lambda e: e["value"].isNotNull()))
    return row.select(*own, m.alias("metadata"))


def referenced(metadata: Column, document_id: Column, chunk_id: Column, family: Column) -> Column:
    """A metadata map with ref_doc_id, ref_chunk_id and field_family, each only where it is absent; null families add nothing."""
    add = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("ref_doc_id").alias("key"), document_id.alias("value")), F.struct(F.lit("ref_chunk_id").alias("key"), chunk_id.alias("value")), F.struct(F.lit("field_family").alias("key"), family.alias("value")),
    ), lambda e: e["value"].isNotNull() & ~F.array_contains(F.map_keys(metadata), e["key"])))
    return F.map_concat(metadata, add)


def preflight(stored: DataFrame, incoming: DataFrame, reject: bool = False) -> DataFrame:
    """version_conflicts, logged, or an error where they are to be rejected."""
    found = version_conflicts(stored, incoming)
    first = found.take(3)
    if first and reject:
        raise IndexMismatchError(f"documents stored under another version: {[r['document_id'] for r in first]}")
    if first:
        log.warning("documents stored under another version: %s", [r["document_id"] for r in first])
    return found


def merge(index: DataFrame | None, rows: DataFrame, read_only: bool = False, reject: bool = False) -> DataFrame:
    """The index after rows (of `payload`) are put in; the later of equal chunk ids stays."""
    if read_only:
        raise ReadOnlyError("the index is read-only")
    if rows.where("tenant is null or trim(tenant) = ''").limit(1).count():
        raise ValueError("a tenant is required")
    if index is None:
        return upsert(rows)
    preflight(index, rows, reject)
    return upsert(index.unionByName(rows))


def check_index(index: DataFrame, dim: int) -> None:
    """An error if a table cannot be this index: columns missing, or rows of another dimension."""
    gone = [c for c in PAYLOAD if c not in index.columns]
    if gone:
        raise IndexMismatchError(f"columns missing: {gone}")
    other = index.where(F.col("dim") != dim).limit(1).count()
    if other:
        raise IndexMismatchError(f"rows of another dimension than {dim}")


def open_index(spark: SparkSession, backend: str = "memory", path: str | None = None, dim: int | None = None) -> DataFrame | None:
    """The stored index: a table partitioned by tenant, or none yet; `memory` starts empty."""
    if backend == "memory":
        return None
    if backend != "table":
        raise ValueError(f"backend must be memory or table, not {backend!r}")
    try:
        df = spark.read.parquet(path)
    except Exception as e:  # no table yet
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
    if dim is not None:
        check_index(df, dim)
    return df


def write_index(index: DataFrame, path: str, read_only: bool = False) -> None:
    """The index as a table partitioned by tenant, written beside the old one's files only after it is whole."""
    if read_only:
        raise ReadOnlyError("the index is read-only")
    index.write.mode("overwrite").partitionBy("tenant").parquet(path)


def with_retry(call: Callable, times: int = 3, base: float = 0.5, transient: tuple = (ConnectionError, TimeoutError), sleep: Callable[[float], None] = time.sleep):
    """call(), again after transient failures with doubling pauses; other errors are raised at once. For model servers called inside a UDF."""
    for n in range(times + 1):
        try:
            return call()
        except transient:
            if n == times:
                raise
            sleep(base * 2**n)
