"""Queries of the training-data operators over whole tables."""

from __future__ import annotations

from formloom.llm import canonical, packing, pii, residue, scans, split, survivor, tokens
from formloom.llm.oracles import SQL
from formloom.plans.registry import Registry
from formloom.session import load

registry = Registry()


def _add(name: str, f) -> None:
    registry.add(name, SQL.get(name))(f)


_add("p1_found", lambda s, d: pii.p1_found(load(s, d, "parsed_documents"), load(s, d, "audit_records")))
_add("p1_redacted", lambda s, d: pii.p1_redacted(load(s, d, "parsed_documents"), load(s, d, "audit_records")))
_add("p2_found", lambda s, d: scans.p2_found(load(s, d, "parsed_documents"), load(s, d, "lab_lines")))
_add("p2_repaired", lambda s, d: scans.p2_repaired(load(s, d, "parsed_documents"), load(s, d, "lab_lines")))
_add("p3_found", lambda s, d: canonical.p3_found(load(s, d, "lab_lines"), load(s, d, "analyte_ref")))
_add("p3_mapped", lambda s, d: canonical.map_rows(load(s, d, "lab_lines"), load(s, d, "analyte_ref")).select("line_id", "ref_key"))
_add("p5_found", lambda s, d: survivor.p5_found(load(s, d, "field_candidates"), load(s, d, "field_defs")))
_add("p5_records", lambda s, d: survivor.p5_records(load(s, d, "field_candidates"), load(s, d, "field_defs")))
_add("p5_bundles", lambda s, d: survivor.p5_bundles(load(s, d, "field_candidates"), load(s, d, "field_defs")))
_add("p6_found", lambda s, d: split.p6_found(load(s, d, "chunks")))
_add("p6_pieces", lambda s, d: split.split_chunks(load(s, d, "chunks"), load(s, d, "parsed_documents")))
_add("p6_tiling", lambda s, d: split.p6_tiling(load(s, d, "chunks"), load(s, d, "parsed_documents")))
_add("p7_ids", lambda s, d: tokens.p7_ids(load(s, d, "documents")))
_add("p8_containers", lambda s, d: packing.p8_containers(load(s, d, "documents")))
_add("p9_found", lambda s, d: residue.p9_found(load(s, d, "documents")))
_add("p9_clean", lambda s, d: residue.p9_clean(load(s, d, "documents")).select("doc_id", "lang", "source", "text"))
