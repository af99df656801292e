import datetime
import json
import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from formloom.operators import chunking, etl, evaluation, extraction, index, labrows, parsing, retrieval, rules
from formloom.plans import domain
from formloom.sources import files
from formloom.streaming import ingest


def _table(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_lesion_sizes_route_unknown_hints(spark, tmp_path):
    imaging = "Scanner thoraco-abdominal. RECIST 1.1. " + "La lésion du foie mesure 40 mm. " * 3
    rows = [("a", "imaging_report", "Nodule de 12 mm."), ("b", "unknown", imaging), ("c", None, imaging), ("d", " ", imaging), ("e", "clinical_letter", imaging), ("f", "unknown", "Bonjour, cicatrice de 3 cm."), ("g", "unknown", None), ("i", "unknown", "Cher confrère, antécédents de nodule de 9 mm. Cordialement"), ("h", "Imaging_Report ", "Nodule de 5 cm.")]
    d = _table(spark, tmp_path, "parsed_documents", rows, "document_id string, document_type_hint string, full_text string")
    got = Counter((r["document_id"], r["value_mm"]) for r in domain.lesion_sizes(spark, d).collect())
    assert got == {("a", 12.0): 1, ("b", 40.0): 3, ("c", 40.0): 3, ("d", 40.0): 3, ("f", 30.0): 1, ("h", 50.0): 1}


def test_report_fallbacks_against_brute_force(spark, sf, tmp_path):
    fl = re.I | re.S

    def mm(t):
        for p in (extraction.BASELINE_BEFORE, extraction.BASELINE_AFTER):
            m = re.search(p.replace("(?is)", ""), t, fl)
            if m:
                return round(float(m[1].replace(",", ".")) * (10 if m[2].lower().startswith("c") else 1), 6)

    def recist(t):
        at = [m.start() for m in re.finditer(extraction.CONCLUSION, t, re.I)]
        c = t[at[-1] :].strip() if at else ""
        low = c.lower()
        codes = re.findall(r"\b(CR|PR|SD|PD|NE)\b", c, re.I)
        has = lambda *xs: any(x in low for x in xs)
        if not c:
            return None
        if has(*extraction.NOT_EVALUABLE):
            return "NE"
        if codes:
            return codes[-1].upper()
        return "CR" if has("complète", "complete") else "PR" if has("partielle", "partial") else "SD" if has(*extraction.STABLE) else "PD" if has("progression", "progressive") else None

    long = "Le foie est normal. " * 5000
    texts = [long + "Bilan d'inclusion : 4,5 cm.\n" + long + "\nCONCLUSION : PR\n" + long, "CATÉGORIE RECIST RETENUE : SD", "AU DÉMARRAGE DU TRAITEMENT, 3 cm", "Conclusion : PR.\n\nConclusion\nMaladie stable.\n", "", None, "PD sans titre"]
    real = [r["full_text"] for r in spark.read.parquet(f"{sf}/parsed_documents.parquet").select("full_text").collect()]
    rows = [(str(i), t) for i, t in enumerate(texts + real)]
    got = {r["document_id"]: (r["size_mm"], r["recist"]) for r in domain.report_fallbacks(spark, _table(spark, tmp_path, "parsed_documents", rows, "document_id string, full_text string")).collect()}
    assert got == {i: (mm(t), recist(t)) if t is not None else (None, None) for i, t in rows}
    assert [got[str(i)] for i in range(7)] == [(45.0, "PR"), (None, "SD"), (30.0, None), (None, "SD"), (None, None), (None, None), (None, None)]
    assert any(x for _, x in list(got.values())[7:])


def test_dates(spark):
    rows = [("Prélevé le 05/03/24, édité 2020-01-01",), ("le 31/02/2024 puis 2023-05-06",), ("12/11/69 ",), ("12/11/70 ",), ("rien",), (None,), ("",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(parsing.document_date(F.col("t"))).collect()]
    d = datetime.date
    assert got == [d(2024, 3, 5), d(2023, 5, 6), d(2069, 11, 12), d(1970, 11, 12), None, None, None]


def test_document_types(spark):
    lab = "Hématologie\nNumération\nLeucocytes : 5 G/L\nCRP : 12 mg/L\nAST : 30 U/L\nBiologie médicale"
    imaging = "Scanner thoraco-abdominal. RECIST 1.1. " + "La lésion du foie mesure 40 mm. " * 10
    letter = "Cher confrère, antécédents de diabète, traitement en cours. Cordialement"
    rows = [(1, lab), (2, imaging), (3, letter), (4, ""), (5, None), (6, "Compte rendu anatomopathologique : biopsie, coloration, histologie")]
    got = {r["i"]: r["document_type"] for r in parsing.classify(spark.createDataFrame(rows, "i int, text string")).collect()}
    assert got == {1: "lab_blood_panel", 2: "imaging_report", 3: "clinical_letter", 4: "unknown", 5: "unknown", 6: "pathology_report"}


def test_scores_over_whole_texts(spark):
    late = "a b c d\n" * 3000 + "NFS, hémogramme. CRP : 12 mg/L\nCompte rendu anatomopathologique : biopsie, coloration, histologie\n"
    df = spark.createDataFrame([(late,)], "text string")
    t = F.col("text")
    got = df.select(parsing.lab_score(t), parsing.lab_score(t, None), parsing.morpho_context(t), parsing.morpho_context(t, None), parsing.probable_lab(t), parsing.probable_lab(t, None), parsing.line_stats(t)["n_lines"], parsing.line_stats(t, None)["n_lines"]).first()
    assert got[0] == 0 and got[1] > 6 and tuple(got)[2:] == (False, True, False, True, 500, 3002)
    types = [parsing.classify(df, **k).first()["document_type"] for k in ({}, {"chars": None, "most": None})]
    assert types == ["unknown", "pathology_report"]


def test_segments_and_headings(spark):
    rows = [("a", "lab_blood_panel", "Page 1\nBIOCHIMIE :\nx 1\n\ny 2\nHemostase\nz 3"), ("b", "unknown", ""), ("c", "unknown", None)]
    got = parsing.segment(spark.createDataFrame(rows, "k string, t string, x string"), "k", "x", "t").orderBy("k", "section_ord").collect()
    assert [(r["k"], r["heading"], r["body"]) for r in got] == [("a", "BIOCHIMIE", "x 1\ny 2"), ("a", "Hemostase", "z 3")]


def test_paragraph_offsets(spark):
    t = "Un.\n\n  Deux deux.\n\nUn.\n\n🙂 AST alt"
    rows = chunking.paragraphs(spark.createDataFrame([(1, t), (2, None), (3, " \n "), (4, "a\nb")], "k int, t string"), "k", "t").orderBy("k", "chunk_ord").collect()
    assert [(r["k"], r["text"]) for r in rows] == [(1, "Un."), (1, "Deux deux."), (1, "Un."), (1, "🙂 AST alt"), (4, "a"), (4, "b")]
    assert all(t[r["char_start"] : r["char_end"]] == r["text"] for r in rows if r["k"] == 1)
    assert rows[0]["chunk_id"] == rows[2]["chunk_id"] and rows[3]["field_family"] == "hepatic_biochemistry"


def test_packing_keeps_all_lines(spark):
    t = "\n\n".join("\n".join(f"ligne {i} {j}" for j in range(30)) for i in range(10))
    parts = [r["part"] for r in chunking.pack_oversized(spark.createDataFrame([(1, t)], "k int, t string"), "k", "t", 200).orderBy("part_ord").collect()]
    assert max(map(len, parts)) <= 200
    assert "".join("".join(parts).split()) == "".join(t.split())


@pytest.mark.parametrize(
    "text, rows",
    [
        ("Biochimie\nASAT ........ 28.5 U/L 5 à 40", [("ASAT", 28.5, "U/L")]),
        ("Testostérone ......... Inf à 0.8 ng/ml", [("Testostérone", "Inf à 0.8", "ng/ml")]),
        ("Cellules ....... Très nombreuses\nCristaux ....... Absentes", [("Cellules", "Très nombreuses", None), ("Cristaux", "Absentes", None)]),
        ("TP ......\nINR ......\nRatio ......\n121 %\n1\n1.5", [("TP", 121, "%"), ("INR", 1, None), ("Ratio", 1.5, None)]),
        ("TP ......\nINR ......\n121 %\n1", [("INR", 121, "%")]),  # two names are no column: the result is the nearest name's
        ("TP ......\nCréatinine ......\nUrée ......\n80 %\n61.9 umol/L\n5.47 mg/L\n4 mmol/L\n1 à 2", [("TP", 80, "%"), ("Créatinine", 61.9, "umol/L"), ("Urée", 4, "mmol/L")]),
        ("739.4 /mL\nAbsent\nLEUCOCYTES ......\nCristaux ......", [("LEUCOCYTES", 739.4, "/mL"), ("Cristaux", "Absent", None)]),
        ("Testostérone .......\n| Homme | 2 à 9 |\n2 à 9\n0.4 ng/ml", [("Testostérone", 0.4, "ng/ml")]),
        ("", []),
        ("Pas de ligne", []),
    ],
)
def test_dotted_rows(text, rows):
    assert [(r["name"], r["value"], r["unit"]) for r in labrows.read_rows(text)] == rows


@pytest.mark.parametrize(
    "text, want",
    [
        # one report a layout: (name, result, unit, confidence)
        ("Biochimie\nLipase ........\n31 U/L\nInf. à 60\nPage 3\n", [("Lipase", 31, "U/L", 0.9)]),
        (
            "Hematologie NumerationGlobulaire Hématies........ 4.9 10^6/mm3 4.1 à 5.6 FormuleLeucocytaire Lymphocytes........ 31% : 2040 /mm3 Hemostase TCA........ 1.1 0.8 à 1.2 Biochimie Phosphatase (P.A.L)........ 71.5 U/L 30 à 120",
            [("Hématies", 4.9, "10^6/mm3", 0.9), ("Lymphocytes", 31, "%", 0.9), ("TCA", 1.1, None, 0.82), ("Phosphatase (P.A.L)", 71.5, "U/L", 0.9)],
        ),
        ("Hormonologie\n| A.C.T.H........ | 6.3 pmol/L | 1.6 à 13.9 |\n| 25 OH vitamine D........ | 41 nmol/L | 75 à 150 |", [("A.C.T.H.", 6.3, "pmol/L", 0.9), ("25 OH vitamine D", 41, "nmol/L", 0.9)]),
        ("Estradiol........\n\nInf à 19 pg/ml\n\n20 à 90\n\nCortisol........\n\n310 nmol/L\n", [("Estradiol", "Inf à 19", "pg/ml", 0.85), ("Cortisol", 310, "nmol/L", 0.9)]),
        ("Testostérone........\n\n## Valeurs usuelles\n\n| Fille | Garçon |\n\nsup à 0.4 ng/ml\n", [("Testostérone", "Sup à 0.4", "ng/ml", 0.85)]),
        ("Testostérone........\n\n| " + "x" * 1600 + " |\n0.4 ng/ml\n", []),  # too far off
        (
            "Hemostase\n\nFacteur V........\n\nTCA........\n\nRapport........\n\nD-dimères........\n\nBiochimie\n\nUrate........\n\nBiochimie\n\n88.0 %\n\n2.0\n\n1.7\n\n0.4 g/L\n\n302 umol/L\n\n50.8 mg/L\n\n60 à 120\n\n1.0 à 2.0\n",
            [("Facteur V", 88, "%", 0.85), ("TCA", 2, None, 0.85), ("Rapport", 1.7, None, 0.85), ("D-dimères", 0.4, "g/L", 0.85), ("Urate", 302, "umol/L", 0.85)],
        ),
        ("412 /mL\n\n500 à 9000\n\nQuelques\n\nAbsent\n\nHEMATIES........\n\nGERMES........\n\nLEVURES........\n", [("HEMATIES", 412, "/mL", 0.8), ("GERMES", "Quelques", None, 0.78), ("LEVURES", "Absent", None, 0.78)]),
        ("CRISTAUX........\n\nRares\n", [("CRISTAUX", "Rares", None, 0.82)]),
    ],
)
def test_layouts_and_confidences(text, want):
    assert [(r["name"], r["value"], r["unit"], r["confidence"]) for r in labrows.read_rows(text)] == want


def test_enrich_joins_both_readers(spark):
    docs = spark.createDataFrame([(1, "AST ....... 48 U/L\nAST : 48 U/L\nALT : 32 U/L\nALT : 32 U/L", "x"), (2, "ignored : 3", "x"), (3, None, "x"), (4, "", "x"), (5, "CRP : 5 mg/L", "x")], "k long, t string, section string")
    secs = spark.createDataFrame([(2, 0, "Biochimie", "CRP : 5 mg/L"), (2, 1, "Conclusion", "Poids : 70 kg"), (5, 0, "Plan", " ")], "k long, section_ord int, heading string, body string")
    got = [(r["k"], r["ord"], r["name"], r["value"]["n"], r["section"]) for r in labrows.enrich(docs, "k", "t", secs).orderBy("k", "ord").collect()]
    assert got == [(1, 0, "AST", 48.0, None), (1, 1, "ALT", 32.0, None), (2, 0, "CRP", 5.0, "Biochimie"), (5, 0, "CRP", 5.0, None)]
    back = labrows.sections_of_lines(labrows.enrich(docs, "k", "t"), "k").where("k = 1").collect()
    assert [r["body"] for r in back] == ["AST | 48 U/L\nALT : 32 U/L"]


def test_dotted_sections():
    r = labrows.read_rows("Hemostase\nINR ..... 1\nHematologie\nNumerationGlobulaire\nGlobules rouges ..... 4.4 T/L\nTestostérone ..... 3 ng/mL")
    assert [(x["section"], x["subsection"]) for x in r] == [("Hemostase", "Hemostase"), ("Hematologie", "NumerationGlobulaire"), ("Hormonologie", "Hormonologie")]


def test_imaging(spark):
    rows = [
        ("9,6 cm",), ("28 mm",), ("53 millimètres",), ("rien",), (None,),
    ]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(F.round(extraction.first_size_mm(F.col("t")), 3)).collect()]
    assert got == [96.0, 28.0, 53.0, None, None]
    texts = [("Non évaluable ce jour",), ("PR puis SD",), ("réponse complète",), ("maladie stable",), ("progression nette",), ("",), (None,), ("les critères ne s'appliquent",)]
    got = [r[0] for r in spark.createDataFrame(texts, "t string").select(extraction.recist_code(F.col("t"))).collect()]
    assert got == ["NE", "SD", "CR", "SD", "PD", None, None, "NE"]
    t = [("Suspicion de PD.\nConclusion : catégorie RECIST retenue : NE",), ("PD sans conclusion finale",)]
    got = [r[0] for r in spark.createDataFrame(t, "t string").select(extraction.conclusion_recist(F.col("t"))).collect()]
    assert got == ["NE", None]


def test_narrative_negation(spark):
    rows = [(1, "a\nCirrhose alcoolique\nCirrhose"), (2, "pas de cirrhose connue"), (3, "sans cirrhose\ncirrhose"), (4, None), (5, "")]
    got = {r["k"]: r["evidence"] for r in extraction.narrative(spark.createDataFrame(rows, "k int, t string"), "k", "t", "Cirrhosis", ["cirrhose"]).collect()}
    assert got == {1: "Cirrhose alcoolique", 3: "cirrhose"}


def test_scope_choice(spark):
    f = "field_name string, target_column string, field_type string, temporal_scope string, normalization_rule string, autofill_threshold double, canonical_key string, document_types_allowed array<string>"
    fields = spark.createDataFrame([("b", "B", "numeric", "baseline", None, 0.7, "AST", ["lab_blood_panel"]), ("f", "F", "numeric", "follow_up", None, 0.7, "AST", ["lab_blood_panel"])], f)
    obs = spark.createDataFrame([("o", "AST", "lab_blood_panel"), ("p", "AST", "clinical_letter"), ("q", None, "lab_blood_panel")], "observation_id string, canonical_key string, document_type string")
    assert [(r["observation_id"], r["field_name"]) for r in rules.map_to_fields(obs, fields).collect()] == [("o", "b")]


def test_best_value_ties_go_first(spark):
    df = spark.createDataFrame([("c", 0.8, 2, "x"), ("c", 0.8, 1, "y"), ("c", 0.5, 0, "z"), ("d", 0.1, 3, None)], "k string, conf double, ord int, v string")
    assert {(r["k"], r["v"]) for r in rules.best_per_column(df, ["k"], "conf", "ord", ["v"]).collect()} == {("c", "y"), ("d", None)}


def test_overwrite_and_merge(spark):
    s = "patient_id string, column_key string, value string"
    cells = spark.createDataFrame([("p", "a", "1"), ("p", "b", " NA "), ("p", "c", None)], s)
    upd = spark.createDataFrame([("p", "a", "9"), ("p", "b", "8"), ("q", "z", "7")], s)
    assert {(r["column_key"], r["accepted"], r["existing"]) for r in etl.partition_updates(upd, cells, "empty_only").collect()} == {("a", False, "1"), ("b", True, None), ("z", True, None)}
    merged = {(r["patient_id"], r["column_key"]): r["value"] for r in etl.merge_cells(cells, upd, "empty_only").collect()}
    assert merged == {("p", "a"): "1", ("p", "b"): "8", ("p", "c"): None, ("q", "z"): "7"}
    assert etl.columns_to_skip(cells, "empty_only").count() == 1 and etl.columns_to_skip(cells, "always").count() == 0
    with pytest.raises(ValueError):
        etl.partition_updates(upd, cells, "sometimes")


def test_point_ids_are_uuid5(spark):
    ids = ["chk_1", "chk_é", ""]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i string").select(index.point_id(F.col("i"))).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_URL, i)) for i in ids]


def test_dense_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)).astype("float32")
    rows = [(i, [float(v) for v in x[i]]) for i in range(300)] + [(300, None), (301, [0.0] * 8)]
    v = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(7)
    hits = retrieval.dense(v.where("id % 100 = 0").select(F.col("id").alias("query_id"), "embedding"), v, 5).collect()
    u = x.astype("float64") / np.linalg.norm(x.astype("float64"), axis=1, keepdims=True)
    for q in (0, 100, 200):
        best = sorted(range(300), key=lambda i: (-round(float(u[q] @ u[i]), 6), i))[:5]
        assert [r["id"] for r in sorted((h for h in hits if h["query_id"] == q), key=lambda h: h["rank"])] == best


def test_dense_in_blocks_of_queries(spark, monkeypatch):
    rows = [(i, [float(i % 7 + 1), float(i % 5), 1.0]) for i in range(60)]
    v = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(3)
    q = v.where("id % 3 = 0").select(F.col("id").alias("query_id"), "embedding")
    ranked = lambda: sorted((tuple(r) for r in retrieval.dense(q, v, 4).collect()), key=str)
    whole = ranked()
    assert len(whole) == 20 * 4
    for size in (1, 7, 20):  # rests, and a last block that is full
        monkeypatch.setattr(retrieval, "QUERY_BLOCK", size)
        assert ranked() == whole
    assert retrieval.dense(q.where("false"), v, 4).collect() == []


def test_lexical_counts_words_inside_words(spark):
    q = spark.createDataFrame([(1, "bilan AST ab"), (2, "  "), (3, None)], "query_id int, query string")
    p = spark.createDataFrame([(1, "contraste injecté"), (2, "bilan ast"), (3, ""), (4, None)], "id int, text string")
    got = [(r["query_id"], r["id"], r["score"]) for r in retrieval.lexical(q, p, 5).orderBy("query_id", "rank").collect()]
    assert got == [(1, 2, 0.5), (1, 1, 0.35), (1, 3, 0.2), (2, 1, 0.2), (2, 2, 0.2), (2, 3, 0.2)]


def test_evaluation_fixture(spark):
    v = "struct<kind:string,s:string,n:double,b:boolean>"
    gold = spark.createDataFrame([("s", "rouges", ("n", None, 4.4, None), "10^6/mm3"), ("s", "plaquettes", None, "G/L")], f"sample_id string, path string, g {v}, g_unit string")
    pred = spark.createDataFrame([("s", "rouges", ("n", None, 4.4, None), "10^6/mm3"), ("s", "plaquettes", ("n", None, 150.0, None), "G/L"), ("s", "hematocrite", ("n", None, 42.0, None), "%")], f"sample_id string, path string, p {v}, p_unit string")
    m = evaluation.metrics(evaluation.counts(evaluation.outcomes(gold, pred, ["sample_id", "path"], evaluation.values_match(F.col("p"), F.col("g"))), [])).first()
    assert (m["autofill_rate"], m["false_autofill_rate"], m["precision"], m["recall"], m["value_accuracy"]) == (1.0, 0.5, 0.5, 1.0, 1.0)
    assert [r["path"] for r in evaluation.out_of_template(pred, gold, ["sample_id", "path"]).collect()] == ["hematocrite"]
    none = evaluation.metrics(evaluation.counts(gold.where("false").withColumn("outcome", F.lit("x")), [])).first()
    assert none["precision"] is None and none["f1"] is None
    assert evaluation.passes({"precision": 0.9}, {"precision": 0.95}) == 1 and evaluation.passes({"precision": 0.96, "fa": 0.0}, {"precision": 0.95, "max_fa": 0.01}) == 0
    assert evaluation.passes({}, {"recall": 0.1}) == 1


def test_silver_judgments(spark):
    f = spark.createDataFrame([("s", "a", "Plaquettes", ("n", None, 150.0, None), "G/L"), ("s", "b", "AST", ("s", "30", None, None), None), ("s", "c", "CRP", ("n", None, 1.0, None), None), ("s", "d", "INR", None, None)], "sample_id string, path string, label string, value struct<kind:string,s:string,n:double,b:boolean>, unit string")
    c = spark.createDataFrame([("s", "x", "Plaquettes : 150 G/L, AST 30"), ("s", "y", "plaquettes 150; ast 30"), ("t", "z", "CRP 1")], "sample_id string, chunk_id string, text string")
    got = {r["path"]: (r["status"], r["chunk_id"]) for r in evaluation.silver_judgments(f, c).collect()}
    assert got == {"a": ("matched", "x"), "b": ("ambiguous", None), "c": ("unmatched", None)}


def test_schema_and_templates(spark, tmp_path):
    p = tmp_path / "s.json"
    ok = {"field_name": "a", "field_type": "numeric", "target_column": "A", "canonical_key": "AST", "extraction_strategy": "lab_deterministic"}
    p.write_text(json.dumps({"fields": [ok]}))
    assert files.read_schema(spark, str(p)).first()["autofill_threshold"] == 0.65
    p.write_text(json.dumps({"fields": [ok, ok, {"field_name": "b", "field_type": "x", "autofill_threshold": 2, "extraction_strategy": "s"}]}))
    with pytest.raises(files.SchemaError) as e:
        files.read_schema(spark, str(p))
    assert str(e.value).count(";") == 3
    assert files.read_map(str(tmp_path / "none.json")) == {}
    with pytest.raises(ValueError):
        files.read_template('{"a": 1, "a": 2}')
    leaves = list(files.flatten_template({"H": {"N": {"valeur": 4, "unité": None}}, "x": 1}))
    assert leaves == [(("H", "N"), 4, None, True)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes(b"caf\xe9 \xc3\xa9")
    (tmp_path / "in" / "b.pdf").write_bytes(b"%PDF")
    docs = files.read_documents(spark, str(tmp_path / "in"), lambda b: 1 / 0)
    assert {(r["mime_type"], r["full_text"]) for r in docs.collect()} == {("text/plain", "caf� é"), ("application/pdf", "")}


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(i % 3, i, float(i * 7 % 11)) for i in range(50)], "k int, i long, v double").repartition(6)
    df.write.parquet(str(tmp_path / "in"))
    got = ingest.best_value_stream(spark, str(tmp_path / "in"), df.schema, ["k"], [F.col("v"), -F.col("i")], ["i", "v"], files_per_batch=2)
    want = df.groupBy("k").agg(F.max_by(F.struct("i", "v"), F.struct("v", -F.col("i"))).alias("r")).select("k", "r.*")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_core_stands_alone():
    import pathlib
    import re

    root = pathlib.Path(files.__file__).parents[1]
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"^\s*(?:from|import) formloom\.llm", p.read_text(), re.M), p
