"""The whole run against golden rows, and the parts that SQL cannot state against hand-made cases."""

import datetime
import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from formloom import pipeline
from formloom.operators import chunking, etl, evaluation, extraction, index, parsing, retrieval, rules
from formloom.sources import files
from formloom.streaming import ingest

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import the tests
FIELDS = [
    (0, "AFP_D0", "numeric", ["lab_blood_panel"], "lab_values", "inflammation_biomarkers", "baseline", "numeric_mg_l", "AFP", 0.70, "AFP", "lab_deterministic"),
    (1, "AST_D0", "numeric", ["lab_blood_panel"], "lab_values", "hepatic_biochemistry", "baseline", "numeric_u_l", "AST", 0.65, "AST", "lab_deterministic"),
    (2, "ALT_D0", "numeric", ["lab_blood_panel"], "lab_values", "hepatic_biochemistry", "baseline", "numeric_u_l", "ALT", 0.65, "ALT", "lab_deterministic"),
    (3, "BILI_D0", "numeric", ["lab_blood_panel"], "lab_values", "hepatic_biochemistry", "baseline", "numeric_umol_l", "BILI", 0.65, "Total_bilirubine", "lab_deterministic"),
    (4, "PLT_D0", "numeric", ["lab_blood_panel"], "lab_values", "hematology", "baseline", "numeric_g_l", "PLT", 0.65, "PLT", "lab_deterministic"),
    (5, "Cirrhosis", "boolean", ["clinical_letter", "lab_blood_panel"], "narrative_clinical", "comorbidities", "unspecified", "bool_yes_no", "CIRR", 0.75, "Cirrhosis", "narrative_keywords"),
    (6, "Size_D0", "numeric", ["imaging_report"], "imaging_recist", "imaging_recist", "baseline", "numeric_mm", "SIZE", 0.70, "Size_major_nodule_mm", "imaging_langextract"),
    (7, "Response_1", "categorical", ["imaging_report"], "imaging_recist", "imaging_recist", "first_imaging", "recist_category", "RECIST", 0.75, "RECIST_response", "imaging_langextract"),
]
FIELD_SCHEMA = (
    "field_ord int, field_name string, field_type string, document_types_allowed array<string>, extraction_family string, field_family string, temporal_scope string, normalization_rule string, target_column string, "
    "autofill_threshold double, canonical_key string, extraction_strategy string"
)
DOC = "document_id string, patient_id string, study_id string, source_path string, mime_type string, full_text string"
PANEL = (
    "LABORATOIRE de biologie médicale\n\nPrélevé le 15/03/2026\n\nHémogramme (NFS)\nPlaquettes : 145 G/L\nLeucocytes : 6,1 G/L\n\nHémostase\nINR : 1.1\n\nBilan hépatique\nAST : 48 U/L\nALT : 35 U/L\nBilirubine totale : 22 µmol/L\n\n"
    "Marqueurs\nAFP : 24\nCRP : 5 mg/L\n\nCommentaire : cirrhose connue, compensée."
)
IMAGING = (
    "COMPTE RENDU DE SCANNER\nScanner abdominal avec injection de contraste, reconstruction.\nINDICATION : suspicion de PD.\nRESULTATS\nAu bilan d'inclusion la lésion cible mesurait 5,3 cm. Examen actuel : 41 mm.\n"
    "CONCLUSION : réponse partielle, PR selon les critères."
)


@pytest.fixture(scope="module")
def fields(spark):
    return spark.createDataFrame(FIELDS, FIELD_SCHEMA)


@pytest.fixture(scope="module")
def golden(spark, fields):
    docs = spark.createDataFrame(
        [
            ("p", "P1", "S", "/depot/x/panel.txt", "text/plain", PANEL), ("i", "P1", "S", "/depot/x/scan.txt", "text/plain", IMAGING), ("d", "P2", "S", "/depot/x/panel.pdf", "application/pdf", "NFS hémogramme laboratoire\nHematologie\nPlaquettes ........ 150 G/L\nBiochimie\nASAT ........ 50 U/L 5 à 34"),
            ("n", "P3", "S", "/depot/x/none.txt", "text/plain", None), ("e", "P3", "S", "/depot/x/empty.pdf", "application/pdf", ""),
        ], DOC,
    )
    registry = spark.createDataFrame([("P1", "AST", "47"), ("P1", "ALT", "NA"), ("P2", "PLT", "")], "patient_id string, column_key string, value string")
    return pipeline.run_pipeline(docs, fields, "2026-04-01", registry=registry)


def cells(df):
    return {(r["document_id"], r["column_key"]): (r["shown"], r["validated"]) for r in df.collect()}


def test_run_fills_the_form(golden):
    got = cells(golden.updates)
    assert got == {
        ("p", "PLT"): ("145.0", True), ("p", "ALT"): ("35.0", True), ("p", "BILI"): ("22.0", True), ("p", "AFP"): ("24.0", True), ("p", "CIRR"): ("true", True),
        ("i", "SIZE"): ("53.0", True), ("i", "RECIST"): ("PR", True), ("d", "PLT"): ("150.0", True), ("d", "AST"): ("50.0", True),
    }  # P1's AST is filled in the form: never read again
    assert {(r["patient_id"], r["column_key"]): r["value"] for r in golden.cells.where("column_key in ('AST', 'ALT', 'PLT')").collect()} == {
        ("P1", "AST"): "47", ("P1", "ALT"): "35.0", ("P1", "PLT"): "145.0", ("P2", "PLT"): "150.0", ("P2", "AST"): "50.0"
    }


def test_run_dates_and_confidences(golden):
    rows = {(r["document_id"], r["column_key"]): r for r in golden.updates.collect()}
    assert rows["p", "PLT"]["event_date"] == datetime.date(2026, 3, 15) and rows["i", "SIZE"]["event_date"] == datetime.date(2026, 4, 1)
    assert rows["p", "PLT"]["temporal_label"] == "baseline" and rows["i", "RECIST"]["temporal_label"] == "first_imaging_evaluation"
    assert round(rows["p", "PLT"]["blended"], 6) == 0.85  # half .82, half .88
    assert rows["d", "PLT"]["blended"] == 0.9  # rows of a panel had no retrieval
    assert rows["i", "SIZE"]["unit"] == "mm"


def test_run_keeps_its_trail(golden):
    steps = {(r["document_id"], r["step"]) for r in golden.audit.select("document_id", "step").collect()}
    assert {s for d, s in steps if d == "n"} == set(etl.STEPS) - {"extraction", "validation"}
    assert ("p", "extraction") in steps and ("p", "validation") in steps
    first = golden.audit.where("step = 'ingestion' and document_id = 'p'").first()
    assert json.loads(first["details"]) == {"mime": "text/plain", "path": "panel.txt"}


def test_routes(golden):
    got = {r["document_id"]: (r["document_type"], r["chunking_strategy"]) for r in golden.parsed.collect()}
    assert got["p"] == ("lab_blood_panel", None) and got["i"] == ("imaging_report", None) and got["d"] == ("lab_blood_panel", "lab_rows") and got["e"][1] == "sections"
    assert {r["chunker"] for r in golden.chunks.where("document_id = 'd'").collect()} == {"lab_rows"}


def test_policies(spark, fields):
    docs = spark.createDataFrame([("p", "P1", "S", "/x/a.txt", "text/plain", PANEL)], DOC)
    reg = spark.createDataFrame([("P1", "AST", "47")], "patient_id string, column_key string, value string")
    always = pipeline.run_pipeline(docs, fields, "2026-04-01", registry=reg, policy="always")
    assert cells(always.updates)["p", "AST"] == ("48.0", True)
    never = pipeline.run_pipeline(docs, fields, "2026-04-01", registry=reg, policy="never")
    assert never.updates.count() == 0 and never.cells.count() == 1
    with pytest.raises(ValueError):
        pipeline.run_pipeline(docs, fields, "2026-04-01", policy="sometimes")
    none = pipeline.run_pipeline(docs.limit(0), fields, "2026-04-01")
    assert none.updates.count() == 0 and none.audit.count() == 0


# --- imaging -----------------------------------------------------------------------------------------------
TEXT = "INDICATION : PD évoquée. Cible au bilan d'inclusion : 53 mm. Lésion non cible 9 mm.\nCONCLUSION : maladie stable, SD."


def model(text):
    at = text.index
    return {"extractions": [
        [{"class": "lesion_size_mm", "text": "53 mm", "start": at("53"), "end": at("53") + 5}, {"class": "lesion_size_mm", "text": "taille", "start": at("9 mm"), "end": at("9 mm") + 4, "attributes": {"value_cm": "0,9"}}],
        {"class": "recist_response", "text": "PD", "start": at("PD"), "end": at("PD") + 2}, {"class": "recist_response", "text": "stable", "attributes": {"category": "sd"}, "start": at("SD"), "end": at("SD") + 2},
        {"class": "recist_response", "text": "CR"}, {"class": "other", "text": "x", "start": 0, "end": 1}, {"class": "imaging_conclusion", "text": "maladie stable, SD", "start": at("maladie"), "end": at("SD")},
    ]}


def hits(spark, text=TEXT):
    return spark.createDataFrame([("d", "imaging_report", "imaging_recist", "c", 0, text, 0.88, 1)], "document_id string, document_type string, field_family string, chunk_id string, chunk_ord int, text string, retrieval_score double, ord long")


def test_grounded_extractions(spark, fields):
    g = extraction.grounded(extraction.run_model(hits(spark), model)).collect()
    assert {(r["canonical_key"], r["value"]["n"] or r["value"]["s"], r["confidence"]) for r in g} == {
        ("Size_major_nodule_mm", 53.0, 0.93), ("Size_major_nodule_mm", 9.0, 0.4), ("RECIST_response", "SD", 0.93), ("imaging_conclusion", "maladie stable, SD", 0.75)
    }
    loose = extraction.grounded(extraction.run_model(hits(spark), model), require_grounding=False)
    assert ("RECIST_response", "CR") not in {(r["canonical_key"], r["value"]["s"]) for r in loose.collect()}  # nowhere in the conclusion


def test_imaging_strategy_fills_what_the_model_left_out(spark, fields):
    jobs = extraction.plan_jobs(fields)
    got = {(r["canonical_key"], r["extraction_method"]) for r in extraction.imaging_strategy(hits(spark), jobs, lambda t: []).collect()}
    assert got == {("Size_major_nodule_mm", extraction.FALLBACK_METHOD), ("RECIST_response", extraction.FALLBACK_METHOD)}
    got = {(r["canonical_key"], r["extraction_method"]) for r in extraction.imaging_strategy(hits(spark), jobs, model).collect()}
    assert got == {("Size_major_nodule_mm", extraction.IMAGING_METHOD), ("RECIST_response", extraction.IMAGING_METHOD)}
    derived = extraction.imaging_strategy(hits(spark), jobs, lambda t: [x for x in extraction.flatten_extractions(model(t)) if x["class"] == "imaging_conclusion"]).where("canonical_key = 'RECIST_response'").collect()
    assert [(r["value"]["s"], r["confidence"]) for r in derived] == [("SD", 0.93)]


def test_a_failing_model_gives_nothing(spark):
    assert extraction.run_model(hits(spark), lambda t: 1 / 0).count() == 0
    with pytest.raises(Exception, match="missing"):
        def gone(t):
            raise ImportError("missing")
        extraction.run_model(hits(spark), gone).count()


def test_unknown_strategy_and_dedup(spark, fields):
    jobs = extraction.plan_jobs(fields)
    with pytest.raises(ValueError):
        extraction.extract_all(hits(spark), jobs, strategies={})
    two = hits(spark).unionAll(hits(spark).withColumn("chunk_id", F.lit("c2")).withColumn("ord", F.lit(2).cast("long")))
    assert extraction.extract_all(two, jobs).count() == 2  # the same evidence counts once


def test_sentences_and_attributes(spark):
    df = spark.createDataFrame([("Un. Deux mots ici! Trois", 6, 10), ("seul", 0, 4)], "t string, a int, b int")
    assert [r[0] for r in df.select(extraction.sentence_around(F.col("t"), F.col("a"), F.col("b"))).collect()] == ["Deux mots ici!", "seul"]
    rows = [("4,1 cm", {}), ("x", {"value_mm": "12"}), ("x", {"value_cm": "1.2"}), ("x", {"value": "3", "unit": "cm"}), ("7", {}), ("x", {})]
    got = [r[0] for r in spark.createDataFrame(rows, "t string, a map<string,string>").select(F.round(extraction.attribute_mm(F.col("t"), F.col("a")), 3)).collect()]
    assert got == [41.0, 12.0, 12.0, 30.0, 7.0, None]


def test_keywords_are_no_part_of_the_dedup_key(spark, fields):
    jobs = extraction.plan_jobs(fields)
    h = spark.createDataFrame([("d", "clinical_letter", "comorbidities", "c", 0, "Pas de cirrhose.\nCirrhose virale.", 0.88, 1), ("d", "clinical_letter", "comorbidities", "b", 1, " ", 0.8, 2)], hits(spark).schema)
    got = extraction.extract_all(h, jobs.where("strategy = 'narrative_keywords'")).collect()
    assert [(r["canonical_key"], r["evidence_text"]) for r in got] == [("Cirrhosis", "Cirrhose virale.")]


# --- rules ---------------------------------------------------------------------------------------------------------
def test_scopes(spark):
    f = spark.createDataFrame([("b", "K", "baseline", ["t1", "lab_blood_panel", "imaging_report"]), ("a", "K", "follow_up", ["lab_blood_panel"]), ("c", "L", "line_l2", ["x"]), ("d", "L", "line_l3", ["x"])], "field_name string, canonical_key string, temporal_scope string, document_types_allowed array<string>")
    f = f.selectExpr("*", "field_name target_column", "'numeric' field_type", "'r' normalization_rule", "0.5d autofill_threshold")
    o = spark.createDataFrame([(1, "K", "lab_blood_panel"), (2, "K", "pathology_report"), (3, "L", "x"), (4, None, "x"), (5, "K", None)], "observation_id int, canonical_key string, document_type string")
    got = {(r["observation_id"], r["field_name"]) for r in rules.map_to_fields(o, f).collect()}
    assert got == {(1, "b"), (3, "c")}  # a scope nothing speaks for: the first field only
    assert {r["observation_id"]: r["field_name"] for r in rules.first_field_name(o, f).collect()} == {1: "b", 2: "a", 3: "c", 4: None, 5: "a"}


def test_normalisation(spark):
    rows = [("recist_category", "s", "réponse partielle", None, None, None, None), ("numeric_mm", "n", None, 4.1, None, "cm", "taille 4,1 cm"), ("bool_yes_no", "s", "Oui", None, None, None, None), ("numeric_u_l", "n", None, 5.0, None, "U/L", None), ("recist_category", "s", "rien", None, None, None, None)]
    df = spark.createDataFrame(rows, "rule string, kind string, s string, n double, b boolean, unit string, e string")
    v = F.struct("kind", "s", "n", "b")
    got = [(r[0]["s"], r[0]["n"], r[0]["b"]) for r in df.select(rules.normalise(F.col("rule"), v, F.col("e"), F.col("unit"))).collect()]
    assert got == [("PR", None, None), (None, 41.0, None), (None, None, True), (None, 5.0, None), ("rien", None, None)]


# --- index and search ------------------------------------------------------------------------------------------------
def chunk_rows(spark, *rows):
    return spark.createDataFrame(rows, "chunk_id string, document_id string, text string, field_family string, chunk_ord int, char_start int, char_end int, indexed_at timestamp, tenant string")


def test_index_merge_versions_and_guards(spark):
    t = datetime.datetime(2026, 1, 1)
    rows = chunk_rows(spark, ("a", "d", "x", None, 0, 0, 1, t, "S"), ("b", "e", "y", "hematology", 0, 0, 1, t, "S"), (None, "e", "z", None, 1, 0, 1, t, "S"))
    one = index.payload(rows, F.col("tenant"), "v1", "m", 32)
    idx = index.merge(None, one)
    assert idx.count() == 2 and set(index.PAYLOAD) <= set(idx.columns)
    later = index.payload(rows.where("chunk_id = 'a'").withColumn("text", F.lit("new")).withColumn("indexed_at", F.lit(datetime.datetime(2026, 2, 1))), F.col("tenant"), "v2", "m", 32)
    assert {r["chunk_id"]: r["text"] for r in index.merge(idx, later).collect()} == {"a": "new", "b": "y"}
    with pytest.raises(index.IndexMismatchError):
        index.merge(idx, later, reject=True)
    with pytest.raises(index.ReadOnlyError):
        index.merge(idx, later, read_only=True)
    with pytest.raises(ValueError):
        index.merge(idx, index.payload(rows, F.lit(" "), "v1", "m", 32))
    with pytest.raises(ValueError):
        index.filtered(idx, " ")
    assert index.filtered(idx, "S", families=["coagulation"]).count() == 1 and index.filtered(idx, "T").count() == 0
    with pytest.raises(index.IndexMismatchError):
        index.check_index(idx, 64)
    assert index.strict_tenant("a-b_1") == "a-b_1"
    with pytest.raises(ValueError):
        index.strict_tenant("a b")


def test_index_table(spark, tmp_path):
    t = datetime.datetime(2026, 1, 1)
    path = str(tmp_path / "index")
    assert index.open_index(spark, "table", path) is None and index.open_index(spark) is None
    index.write_index(index.merge(None, index.payload(chunk_rows(spark, ("a", "d", "x", None, 0, 0, 1, t, "S")), F.col("tenant"), "v1", "m", 32)), path)
    assert index.open_index(spark, "table", path, 32).count() == 1
    with pytest.raises(ValueError):
        index.open_index(spark, "other")


def test_retry():
    calls, pauses = [], []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError
        return "ok"

    assert index.with_retry(call, sleep=pauses.append) == "ok" and pauses == [0.5, 1.0]
    with pytest.raises(TypeError):
        index.with_retry(lambda: 1 + "a", sleep=pauses.append)
    with pytest.raises(TimeoutError):
        index.with_retry(lambda: (_ for _ in ()).throw(TimeoutError()), times=1, sleep=pauses.append)


def test_more_queries_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "TEXT_BLOCK", 3)
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 3)
    monkeypatch.setattr(retrieval, "QUERY_ROWS", 2)
    texts = [(i, f"mot{i % 4} le la foie {i}") for i in range(17)]
    p = spark.createDataFrame(texts, "id long, text string")
    q = p.selectExpr("id query_id", "text query")
    b = retrieval.bm25(q, p, 3).collect()
    assert len({r["query_id"] for r in b}) == 17 and all(r["id"] == r["query_id"] for r in b if r["rank"] == 1)
    v = p.select("id", F.array(F.col("id") + 1.0, F.lit(1.0)).alias("embedding"))
    d = retrieval.dense(v.withColumnRenamed("id", "query_id"), v, 1).collect()
    assert len(d) == 17 and all(r["id"] == r["query_id"] or r["score"] == 1.0 for r in d)
    assert retrieval.bm25(q.limit(0), p, 3).count() == 0 and retrieval.dense(v.limit(0).withColumnRenamed("id", "query_id"), v, 1).count() == 0


def test_stop_words_are_no_join_key(spark):
    p = spark.createDataFrame([(i, "de la " * 3 + ("foie" if i == 7 else "rate")) for i in range(50)] + [(99, None), (98, "")], "id long, text string")
    got = retrieval.bm25(spark.createDataFrame([(1, "de la foie")], "query_id long, query string"), p, 2).collect()
    assert [r["id"] for r in got] == [7, 0]


def test_lexical_counts_repeats_and_gives_hitless_passages(spark):
    p = spark.createDataFrame([(1, "hépatopathie"), (2, "rien"), (3, None)], "id long, text string")
    got = {r["id"]: r["score"] for r in retrieval.lexical(spark.createDataFrame([(1, "path path le xyz")], "query_id long, query string"), p, 5).collect()}
    assert got == {1: 0.5, 2: 0.2}


def test_hybrid_blank_queries_and_scores(spark):
    p = spark.createDataFrame([(1, "foie normal"), (2, "rate normale"), (3, "scanner du foie")], "id long, text string")
    q = spark.createDataFrame([(1, "foie"), (2, " "), (3, None)], "query_id long, query string")
    got = retrieval.hybrid(q, p, 2).orderBy("retrieval_rank").collect()
    assert {r["query_id"] for r in got} == {1} and len(got) == 2 and got[0]["rerank_score"] is None
    assert retrieval.hybrid(q, p, 2, min_score=1.0).count() == 0
    assert retrieval.hybrid(q, p, 1, sparse=False, rerank_top=True).count() == 1
    with pytest.raises(ValueError):
        retrieval.check_documents(spark.createDataFrame([("c", "x")], "chunk_id string, document_id string"), spark.createDataFrame([("d",)], "document_id string"))


# --- sections and chunks ----------------------------------------------------------------------------------------------
def test_section_policy(spark):
    seg = spark.createDataFrame([("a", 0, None, "s"), ("b", 0, None, "s"), ("c", 0, None, "s")], "k string, section_ord long, heading string, body string")
    own = spark.createDataFrame([("a", 0, "H", "Page 3", "text_split"), ("a", 1, "I", "x", "text_split"), ("b", 0, "H", "  y  z ", "layout_graph"), ("b", 1, "I", "page 2", "layout_graph")], "k string, section_ord int, heading string, body string, source string")
    got = {(r["k"], r["body"], r["source"]) for r in parsing.choose_sections(seg, own, "k").collect()}
    assert got == {("a", "s", "segmenter"), ("b", "y z", "layout_graph"), ("c", "s", "segmenter")}


def test_chunks_beyond_the_limit_keep_their_places(spark):
    body = "\n\n".join(f"paragraphe {i} " + "mot " * 20 for i in range(12)).strip()
    docs = spark.createDataFrame([("d", "tête\n\n" + body, "sections"), ("i", body, "imaging_full"), ("l", "AST : 4", "lab_rows"), ("p", "a\n\nb", None)], "k string, t string, chunking_strategy string")
    sec = spark.createDataFrame([("d", 0, None, "tête"), ("d", 1, "H", body)], "k string, section_ord int, heading string, body string")
    lab = spark.createDataFrame([], "k string, ord int, section string, subsection string, raw_text string")
    got = chunking.chunk_documents(docs, sec, lab, "k", "t", limit=300).join(docs, "k").collect()
    for r in got:
        assert len(r["text"]) <= 300
        if r["char_start"] is not None:
            assert r["t"][r["char_start"] : r["char_end"]] == r["text"] and r["verified"]
    assert {r["chunker"] for r in got} == {"sections", "imaging", "paragraphs"} and {r["k"] for r in got} == {"d", "i", "l", "p"}
    assert "".join("".join(r["text"] for r in sorted(got, key=lambda r: r["chunk_ord"]) if r["k"] == "i").split()) == "".join(body.split())


# --- sources ------------------------------------------------------------------------------------------------------------
def test_pdf_backends():
    good, empty = lambda b: {"text": "structured"}, lambda b: {"text": " "}
    plain = lambda b: {"text": "plain"}

    def broken(message):
        def f(b):
            raise RuntimeError(message)
        return f

    assert files.parse_pdf(b"", "auto", good, plain)["parser"] == "structure"
    assert files.parse_pdf(b"", "auto", broken("odd"), plain)["text"] == "plain"
    assert files.parse_pdf(b"", "structure", broken("HTTP 401"), plain)["parser"] == "plain"
    with pytest.raises(RuntimeError):
        files.parse_pdf(b"", "structure", broken("odd"), plain)
    with pytest.raises(files.MissingPackageError):
        files.parse_pdf(b"", "structure", None, plain)
    rescued = files.parse_pdf(b"", "auto", empty, plain)
    assert rescued["text"] == "plain" and "fallback_after_empty_primary" in rescued["warnings"]
    assert files.parse_pdf(b"", "auto", broken("a"), broken("b")) ["text"] == "" and files.parse_pdf(b"", "plain", None, broken("b"))["warnings"] == ["plain parser failed: b"]
    with pytest.raises(ValueError):
        files.parse_pdf(b"", "other")
    assert files.available("json") and not files.available("no_such_package_here")


def test_documents_with_their_own_sections(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.pdf").write_bytes(b"%PDF x")
    (d / "b.txt").write_bytes("é".encode("latin-1"))
    m = spark.createDataFrame([("a.pdf", "P", "S")], "file_name string, patient_id string, study_id string")
    docs = files.read_documents(spark, str(d), lambda b: {"text": "t", "sections": [{"heading": "H", "body": "t"}], "parser": "x"}, m).collect()
    by = {r["source_path"][-5:]: r for r in docs}
    assert by["a.pdf"]["full_text"] == "t" and by["a.pdf"]["patient_id"] == "P" and by["b.txt"]["full_text"] == "�" and by["b.txt"]["patient_id"] is None
    s = files.sections_of(files.read_documents(spark, str(d), lambda b: {"text": "t", "sections": [{"heading": "H", "body": "t"}]})).collect()
    assert [(r["heading"], r["source"]) for r in s] == [("H", "layout_parser")]
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        files.read_documents(spark, str(tmp_path / "none"))


def test_study_and_maps(spark, tmp_path):
    p = tmp_path / "s.json"
    p.write_text(json.dumps({"study_id": "S", "schema_version": 3, "fields": [{"field_name": "a", "field_type": "numeric", "retrieval_query": "q", "field_family": "f"}], "family_retrieval_queries": {"g": "x"},
                             "extraction_catalog": {"lab_analytes": [{"canonical_key": "K", "pattern": "k ([0-9]+)"}], "narrative_keywords": [{"canonical_key": "C", "keywords": ["c"]}], "langextract_class_map": {"n": "K"}}}))
    st = files.read_study(spark, str(p))
    assert st.version == "3" and files.analytes_for(st, set())[0][0] == "K" and files.analytes_for(st, {"X"}) == () and files.keywords_for(st, {"C"}) == {"C": ("c",)} and st.classes["n"] == "K"
    q = {r["field_family"]: r["query"] for r in retrieval.family_queries(st.fields, st.fields, st.family_queries).collect()}
    assert q == {"f": "q"}
    m = tmp_path / "m.json"
    m.write_text('{"x": "y"}')
    assert files.read_aliases(None, {"a": "b"}, str(m)) == {"a": "b", "x": "y"} and files.read_aliases(str(tmp_path / "no"), {"a": "b"}, str(m)) == {"a": "b"}
    assert files.read_sheet(spark, str(tmp_path / "no.xlsx")) is None
    sheet = files.read_sheet(spark, "x.xlsx", reader=lambda *a: __import__("pandas").DataFrame({"id": ["1", None], "A": ["x", "y"]}))
    assert [tuple(r) for r in etl.snapshot(sheet, "id").collect()] == [("1.0", "A", "x")]


def test_results_written(spark, tmp_path):
    df = spark.createDataFrame([("d", "/a/b.pdf", '{"x":{"json":"/q/r.json"}}')], "document_id string, source_path string, details string")
    files.write_json(df, str(tmp_path / "j"))
    r = spark.read.json(str(tmp_path / "j")).first()
    assert r["source_path"] == "b.pdf" and json.loads(r["details"]) == {"x": {"json": "r.json"}}
    files.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).count() == 1


def test_form_rows(golden):
    rows = {r["document_id"]: r for r in files.form_rows(golden.updates.withColumnRenamed("document_type", "document_type"), ["PLT", "AFP", "SIZE"]).collect()}
    assert rows["p"]["PLT"] == "145.0" and rows["p"]["SIZE"] is None and rows["i"]["SIZE"] == "53.0" and rows["p"]["n_updates"] == 5


def test_settings():
    assert etl.parse_sentinels(" NA, n/a ,,") == ("na", "n/a") and etl.parse_sentinels(None) == ()
    assert evaluation.parse_threshold("recall=0.9") == ("recall", 0.9) and evaluation.shown(None) == "n/a" and evaluation.summary_text({"a": 0.5, "b": None}) == "a: 0.5000\nb: n/a"
    for bad in ("recall", "=1", "recall=2"):
        with pytest.raises(ValueError):
            evaluation.parse_threshold(bad)
    assert evaluation.passes({"recall": 0.9}, {"recall": 0.9}) == 0 and evaluation.passes({"recall": 0.8}, {"recall": 0.9}) == 1 and evaluation.passes(None, {}) == 2 and evaluation.passes({"r": 1}, {"r": 3}) == 2
    assert evaluation.passes({"fa": 0.02}, {"max_fa": 0.01}) == 1


def test_templates_with_faults(spark):
    df = spark.createDataFrame([('{"a": {"valeur": 1}}',), ('{"a": 1, "a": 2}',), ("[1]",), ("{",), (None,), ('{"a": {"b": {"valeur": true, "unite": null}, "c": 3}}',)], "t string")
    got = [r[0] and [(tuple(x["path"]), x["value"]["n"], x["value"]["b"], x["declared"]) for x in r[0]] for r in df.select(evaluation.flatten_json("t")).collect()]
    assert got == [[(("a",), 1.0, None, False)], None, None, None, None, [(("a", "b"), None, True, True)]]


def test_silver_other_words(spark):
    v = "struct<kind:string,s:string,n:double,b:boolean>"
    f = spark.createDataFrame([("s", "p", "Response at first imaging RECIST", ("s", "PR", None, None), None), ("s", "q", "x", None, None)], f"sample_id string, path string, label string, value {v}, unit string")
    c = spark.createDataFrame([("s", "c1", "Réponse : PR"), ("s", "c2", "autre")], "sample_id string, chunk_id string, text string")
    assert [tuple(r) for r in evaluation.silver_judgments(f, c).collect()] == [("s", "p", "matched", "c1")]


# --- streams ------------------------------------------------------------------------------------------------------------------
EVENT = "user_id long, event_id long, value double"


def test_best_values_go_on_after_a_restart(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "state")
    src.mkdir()
    schema = spark.createDataFrame([], EVENT).schema
    rank = [F.col("value"), -F.col("event_id")]

    def feed(n, rows):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(str(tmp_path / f"t{n}"))
        next((tmp_path / f"t{n}").glob("*.parquet")).rename(src / f"f{n}.parquet")

    def run():
        return {r["user_id"]: r["event_id"] for r in ingest.best_value_stream(spark, str(src), schema, ["user_id"], rank, ["event_id", "value"], root=root, parts=4).collect()}

    feed(0, [(1, 1, 5.0), (2, 2, 1.0), (2, 3, 1.0)])
    assert run() == {1: 1, 2: 2}
    feed(1, [(1, 4, 2.0), (3, 5, None), (2, 6, 9.0)])
    assert run() == {1: 1, 2: 6, 3: 5}
    assert run() == {1: 1, 2: 6, 3: 5}  # nothing new: the table as it stands


def test_windows_drop_rows_behind_the_watermark(spark, tmp_path):
    src = tmp_path / "w"
    src.mkdir()
    schema = "ts timestamp, event_type string, value double"
    t = lambda h: datetime.datetime(2026, 1, 1, h)
    for n, rows in enumerate([[(t(1), "a", 1.0)], [(t(12), "a", 1.0)], [(t(12), "a", 1.0)], [(t(1), "a", 7.0), (t(13), "a", 2.0)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"x{n}"))
        next((tmp_path / f"x{n}").glob("*.parquet")).rename(src / f"{n}.parquet")
        os.utime(src / f"{n}.parquet", (1_700_000_000 + 60 * n,) * 2)  # the order in which they are read
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    q = ingest.windowed_counts(stream, "ts", "event_type").writeStream.outputMode("update").format("memory").queryName("win").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r["window_start"].hour, r["total"]) for r in spark.table("win").collect()}
    assert (1, 1.0) in got and (13, 2.0) in got and not any(v in (7.0, 8.0) for _, v in got)


def test_shared_folder_is_demanded_off_local_masters(spark, monkeypatch):
    from formloom import session

    class Context:
        master = "yarn"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())
