"""Evaluation of filled templates as a whole, batch prediction, and the command line of both.

Templates are JSON texts by sample: the empty form, the gold one and the predicted one. Everything is a
DataFrame until the report, which is one row a sample and one over all.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.operators import evaluation
from formloom.sources import files

RATES = ("precision", "recall", "f1", "autofill_rate", "false_autofill_rate", "value_accuracy", "validation_pass_rate")


class DatasetError(ValueError):
    """Samples are incomplete, templates are broken, or gold misses a field of the form."""


@dataclass
class Evaluation:
    samples: DataFrame  # sample_id, complete, missing
    fields: DataFrame  # sample_id, path, outcome, valid, faults
    metrics: DataFrame  # one row a sample, one with sample_id null over all
    macro: DataFrame
    issues: DataFrame  # fields that are neither matched nor rightly empty, or break the contract
    out_of_template: DataFrame  # sample_id, path


def leaves(templates: DataFrame) -> DataFrame:
    """(sample_id, path, value, unit, declared) of templates(sample_id, template); broken templates are an error."""
    x = templates.select("sample_id", evaluation.flatten_json("template").alias("l"))
    bad = x.where("l is null").select("sample_id").take(3)
    if bad:
        raise DatasetError(f"templates that cannot be read: {[r[0] for r in bad]}")
    y = x.select("sample_id", F.explode("l").alias("x"))
    return y.select("sample_id", F.array_join("x.path", "/").alias("path"), "x.value", "x.unit", "x.declared")


def evaluate(empty: DataFrame, gold: DataFrame, predicted: DataFrame, reports: DataFrame | None = None, partial: bool = False) -> Evaluation:
    """Predicted templates against gold ones, for the fields of the empty ones. Incomplete samples are an error unless partial."""
    parts = {**({"report": reports} if reports is not None else {}), "empty": empty, "filled": gold, "extracted": predicted}
    samples = evaluation.discover(parts)
    whole = samples.where("complete").select("sample_id")
    if not partial and samples.where("not complete").limit(1).count():
        raise DatasetError(f"incomplete samples: {[tuple(r) for r in samples.where('not complete').select('sample_id', 'missing').take(3)]}")
    e, g, p = (leaves(x.join(whole, "sample_id", "left_semi")) for x in (empty, gold, predicted))
    gone = e.join(g, ["sample_id", "path"], "left_anti").select("sample_id", "path").take(3)
    if gone:
        raise DatasetError(f"gold misses fields of the form: {[tuple(r) for r in gone]}")
    null = lambda c: F.when(evaluation.scalar_type(F.col(c)) != "null", F.col(c))
    asked = e.select("sample_id", "path", F.when(F.col("declared"), F.col("unit")).alias("declared_unit"))
    gold_rows = asked.join(g.select("sample_id", "path", null("value").alias("g"), F.when(F.col("declared"), F.col("unit")).alias("g_unit")), ["sample_id", "path"])
    pred_rows = p.select("sample_id", "path", null("value").alias("p"), F.col("unit").alias("p_unit"))
    o = evaluation.outcomes(gold_rows, pred_rows, ["sample_id", "path"], F.coalesce(evaluation.values_match(F.col("p"), F.col("g")), F.lit(False)))
    faults = F.when(F.col("p").isNotNull(), evaluation.contract(F.col("g")["kind"], F.col("p")["kind"], F.col("declared_unit"), F.col("p_unit")))
    o = o.withColumn("faults", faults).withColumn("valid", F.coalesce(F.size("faults") == 0, F.lit(False)))
    counts = evaluation.counts(o, ["sample_id"])
    valid = o.rollup("sample_id").agg(F.count_if(F.col("valid")).alias("valid"))
    key = lambda df: df.withColumn("_k", F.coalesce("sample_id", F.lit("\0")))
    m = evaluation.metrics(key(counts).join(key(valid).drop("sample_id"), "_k").drop("_k"))
    macro = evaluation.macro(m.where("sample_id is not null"), list(RATES))
    issues = o.where("outcome not in ('match', 'true_empty') or not (valid or p is null)").select("sample_id", "path", "outcome", F.array_join("faults", ",").alias("faults"))
    return Evaluation(samples, o.select("sample_id", "path", "outcome", "valid", "faults"), m, macro, issues, evaluation.out_of_template(p, e, ["sample_id", "path"]).select("sample_id", "path"))


def report(ev: Evaluation) -> dict:
    """What is written: rates over all, their means, each sample's, and what went wrong."""
    rows = [r.asDict() for r in ev.metrics.collect()]  # one a sample
    micro = next((r for r in rows if r["sample_id"] is None), {})
    return {
        "micro": {k: micro.get(k) for k in RATES}, "macro": ev.macro.first().asDict(), "samples": sorted((r for r in rows if r["sample_id"] is not None), key=lambda r: r["sample_id"]),
        "issues": [r.asDict() for r in ev.issues.orderBy("sample_id", "path").collect()], "out_of_template": [r.asDict() for r in ev.out_of_template.orderBy("sample_id", "path").collect()],
    }


def write_report(found: dict, folder: str) -> None:
    """evaluation_report.json and summary.txt."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    Path(folder, "evaluation_report.json").write_text(json.dumps(found, ensure_ascii=False, indent=2), encoding="utf-8")
    lines = [f"micro {evaluation.summary_text({k: v})}" for k, v in found["micro"].items()] + [evaluation.summary_text({k: v}) for k, v in found["macro"].items()]
    Path(folder, "summary.txt").write_text("\n".join([*lines, f"issues: {len(found['issues'])}", f"out of template: {len(found['out_of_template'])}"]) + "\n", encoding="utf-8")


def read_templates(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """(sample_id, template) of the files `<sample><suffix>` of a folder."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").load(folder)
    name = F.regexp_extract("path", r"[^/\\]+$", 0)
    return raw.select(F.substr(name, F.lit(1), F.length(name) - len(suffix)).alias("sample_id"), F.col("content").cast("string").alias("template"))


def predict(spark: SparkSession, docs: DataFrame, fields: DataFrame, run_date: str, out: str, overwrite: bool = False, limit: int | None = None, extract_fn=None) -> int:
    """Runs what has no result under `out` yet and writes one JSON row a cell; returns how many documents were run."""
    from formloom.pipeline import run_pipeline

    try:
        done = spark.read.json(out)
    except Exception:  # nothing there yet
        done = None
    rest = docs if done is None or "document_id" not in done.columns else files.pending(docs, done, "document_id", overwrite)
    rest = rest.orderBy("document_id").limit(limit) if limit is not None else rest
    n = rest.count()
    if n:
        run = run_pipeline(rest, fields, run_date, extract_fn=extract_fn)
        cells = run.updates.select("document_id", "patient_id", "study_id", "document_type", "column_key", "shown", "unit", "blended", "validated")
        # documents without a cell leave a row too, so that a later run passes them over
        all_docs = run.parsed.select("document_id", "patient_id", "study_id", "document_type").join(cells.drop("patient_id", "study_id", "document_type"), "document_id", "left")
        all_docs.write.mode("overwrite" if overwrite else "append").json(out)
    return n


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="formloom")
    sub = p.add_subparsers(dest="what", required=True)
    r = sub.add_parser("run", help="fill form cells from a folder of documents")
    for name in ("documents", "study", "out"):
        r.add_argument(name)
    r.add_argument("--date", required=True)
    r.add_argument("--patient", default="")
    r.add_argument("--overwrite", action="store_true")
    r.add_argument("--limit", type=int)
    r.add_argument("--pdf", choices=("auto", "structure", "plain"), default="auto")
    e = sub.add_parser("evaluate", help="compare filled templates with gold ones")
    e.add_argument("folder")
    e.add_argument("out")
    e.add_argument("--partial", action="store_true")
    e.add_argument("--threshold", action="append", default=[], metavar="NAME=THRESHOLD")
    try:
        a = p.parse_args(argv)
    except SystemExit as x:
        return 2 if x.code else 0
    from formloom.session import local_session

    spark = spark or local_session(name="formloom")
    try:
        if a.what == "run":
            study = files.read_study(spark, a.study)
            docs = files.read_documents(spark, a.documents, lambda b: files.parse_pdf(b, a.pdf))
            docs = docs.select("document_id", F.lit(a.patient).alias("patient_id"), F.lit(study.study_id).alias("study_id"), "source_path", "mime_type", "full_text")
            print(predict(spark, docs, study.fields, a.date, a.out, a.overwrite, a.limit))
            return 0
        thresholds = dict(evaluation.parse_threshold(t) for t in a.threshold)
        ev = evaluate(*(read_templates(spark, a.folder, f"{s}.json") for s in ("_empty", "_filled", "_extracted")), partial=a.partial)
        found = report(ev)
        write_report(found, a.out)
        return evaluation.passes(found["micro"] if found["samples"] else None, thresholds)
    except (DatasetError, ValueError, OSError) as x:
        print(x, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
