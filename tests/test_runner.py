import json

import pytest

from formloom import runner

T = "sample_id string, template string"


def table(spark, **samples):
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in samples.items()], T)


EMPTY = {"H": {"rouges": {"valeur": None, "unité": "10^6/mm3"}, "plaquettes": {"valeur": None, "unité": "G/L"}, "note": {"valeur": None}}}
GOLD = {"H": {"rouges": {"valeur": 4.4, "unité": "10^6/mm3"}, "plaquettes": {"valeur": None, "unité": "G/L"}, "note": {"valeur": "Élevé"}}}
PRED = {"H": {"rouges": {"valeur": 4.4, "unité": "10^6/mm3"}, "plaquettes": {"valeur": 150, "unité": "G/L"}, "note": {"valeur": "eleve"}, "autre": {"valeur": 1}}}


def test_one_sample(spark):
    ev = runner.evaluate(table(spark, a=EMPTY), table(spark, a=GOLD), table(spark, a=PRED))
    assert {r["path"]: r["outcome"] for r in ev.fields.collect()} == {"H/rouges": "match", "H/plaquettes": "false_fill", "H/note": "match"}
    m = {r["sample_id"]: r for r in ev.metrics.collect()}
    assert set(m) == {"a", None} and (m[None]["precision"], m[None]["recall"], m[None]["validation_pass_rate"]) == (round(2 / 3, 6), 1.0, 1.0)
    assert [(r["path"], r["outcome"]) for r in ev.issues.collect()] == [("H/plaquettes", "false_fill")] and [r["path"] for r in ev.out_of_template.collect()] == ["H/autre"]


def test_contract_faults(spark):
    pred = {"H": {"rouges": {"valeur": "4.4", "unité": "T/L"}, "plaquettes": {"valeur": None}, "note": {"valeur": "Élevé"}}}
    ev = runner.evaluate(table(spark, a=EMPTY), table(spark, a=GOLD), table(spark, a=pred))
    assert [(r["path"], r["outcome"], r["faults"]) for r in ev.issues.collect()] == [("H/rouges", "wrong_value", "type,unit")]


def test_faulty_data(spark):
    with pytest.raises(runner.DatasetError, match="incomplete"):
        runner.evaluate(table(spark, a=EMPTY, b=EMPTY), table(spark, a=GOLD), table(spark, a=PRED))
    assert runner.evaluate(table(spark, a=EMPTY, b=EMPTY), table(spark, a=GOLD), table(spark, a=PRED), partial=True).metrics.count() == 2
    with pytest.raises(runner.DatasetError, match="misses"):
        runner.evaluate(table(spark, a=EMPTY), table(spark, a={"H": {}}), table(spark, a=PRED))
    with pytest.raises(runner.DatasetError, match="read"):
        runner.evaluate(spark.createDataFrame([("a", '{"x": 1, "x": 2}')], T), table(spark, a=GOLD), table(spark, a=PRED))


def test_command_line(spark, tmp_path):
    d = tmp_path / "d"
    d.mkdir()
    for n, t in (("_empty", EMPTY), ("_filled", GOLD), ("_extracted", PRED)):
        (d / f"s1{n}.json").write_text(json.dumps(t), encoding="utf-8")
    out = str(tmp_path / "out")
    assert runner.main(["evaluate", str(d), out, "--threshold", "recall=0.9"], spark) == 0
    assert runner.main(["evaluate", str(d), out, "--threshold", "precision=0.9"], spark) == 1
    assert runner.main(["evaluate", str(d), out, "--threshold", "precision=9"], spark) == 2 and runner.main(["evaluate"], spark) == 2
    r = json.loads((tmp_path / "out" / "evaluation_report.json").read_text())
    assert r["micro"]["recall"] == 1.0 and r["out_of_template"] == [{"sample_id": "s1", "path": "H/autre"}] and "micro recall: 1.0000" in (tmp_path / "out" / "summary.txt").read_text()
    (d / "s2_empty.json").write_text("{}")
    assert runner.main(["evaluate", str(d), out], spark) == 2


def test_prediction_goes_on_where_it_stopped(spark, tmp_path):
    docs, out = tmp_path / "docs", str(tmp_path / "res")
    docs.mkdir()
    (docs / "a.txt").write_text("LABORATOIRE\n\nNFS hémogramme\nPlaquettes : 145 G/L\n\nAST : 48 U/L")
    study = tmp_path / "s.json"
    study.write_text(json.dumps({"study_id": "S", "fields": [{"field_name": "p", "field_type": "numeric", "document_types_allowed": ["lab_blood_panel"], "extraction_family": "lab_values", "field_family": "hematology", "temporal_scope": "baseline", "target_column": "PLT", "canonical_key": "PLT"}]}))
    args = ["run", str(docs), str(study), out, "--date", "2026-01-01", "--patient", "P"]
    assert runner.main(args, spark) == 0
    assert [(r["column_key"], r["shown"]) for r in spark.read.json(out).collect()] == [("PLT", "145.0")]
    (docs / "b.txt").write_text("rien")
    assert runner.main(args, spark) == 0 and runner.main(args, spark) == 0
    rows = spark.read.json(out).collect()
    assert len(rows) == 2 and {r["column_key"] for r in rows} == {"PLT", None}
    assert runner.main(["run", str(tmp_path / "no"), str(study), out, "--date", "2026-01-01"], spark) == 2
