"""From observations to form fields: mapping, scopes, normalisation, confidence, best value, checks.

Field definitions are a small fixed table and are broadcast. Null keys map to nothing; ties go to the
smallest id; a missing retrieval score leaves the confidence as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formloom.operators.extraction import first_size_mm, recist_code
from formloom.session import bounded

# Preferred scopes of each document type, in order; labels of scopes.
SCOPES = {
    "lab_blood_panel": ("baseline", "follow_up"),
    "imaging_report": ("first_imaging", "second_imaging", "baseline"),
    "clinical_letter": ("unspecified", "baseline", "follow_up"),
}
LABELS = {
    "baseline": "baseline", "follow_up": "follow_up", "first_imaging": "first_imaging_evaluation", "second_imaging": "second_imaging_evaluation",
    "line_l2": "line_l2", "line_l3": "line_l3", "line_l4": "line_l4",
}


def scope_rank(document_type: Column, scope: Column) -> Column:
    """Small is preferred. A type without an order of its own prefers unspecified, baseline and follow-up alike;
    where nothing is preferred, unspecified scopes come before others."""
    out = F.when(scope == "unspecified", 50).otherwise(60)
    for t, scopes in SCOPES.items():
        for i, s in reversed(list(enumerate(scopes))):
            out = F.when((document_type == t) & (scope == s), i).otherwise(out)
    known = document_type.isin(*SCOPES)
    return F.when(~F.coalesce(known, F.lit(False)) & scope.isin("unspecified", "baseline", "follow_up"), 0).otherwise(out)


def observation_keys(*keys: Column) -> Column:
    """The different keys of an observation, in the order given; nulls go."""
    return F.array_distinct(F.array_compact(F.array(*keys)))


def matched_fields(obs: DataFrame, fields: DataFrame, keys: list[str]) -> DataFrame:
    """obs with `_fields`: the fields of any of its keys that the scopes of its document type choose, in the order of the fields.

    The fields of a key are gathered into one row of a small table, so the choice is made inside the
    observation's own row: no aggregate, no second join.
    """
    order = F.col("field_ord") if "field_ord" in fields.columns else F.col("field_name")
    entry = F.struct(order.alias("ord"), "field_name", "target_column", "field_type", "temporal_scope", "normalization_rule", "autofill_threshold", "document_types_allowed")
    by_key = fields.where("canonical_key is not null").groupBy(F.col("canonical_key").alias("_k")).agg(F.collect_list(entry).alias("_f"))
    by_key = bounded(by_key)
    df = obs
    for i, k in enumerate(keys):
        df = df.join(by_key.withColumnRenamed("_k", f"_k{i}").withColumnRenamed("_f", f"_f{i}"), F.col(k) == F.col(f"_k{i}"), "left")
    df = df.withColumn("_all", F.array_sort(F.array_distinct(F.flatten(F.array_compact(F.array(*[F.col(f"_f{i}") for i in range(len(keys))]))))))
    df = df.drop(*[c for i in range(len(keys)) for c in (f"_k{i}", f"_f{i}")])
    t = F.col("document_type")
    ranked = F.transform("_all", lambda f: F.struct(scope_rank(t, f["temporal_scope"]).alias("r"), f.alias("f")))
    best = F.array_min(F.transform(ranked, lambda x: x["r"]))
    chosen = F.transform(F.filter(ranked, lambda x: x["r"] == best), lambda x: x["f"])
    # of scopes that nothing speaks for only the first field counts
    return df.withColumn("_fields", F.when(best >= 60, F.slice(chosen, 1, 1)).otherwise(chosen)).drop("_all")


def map_to_fields(obs: DataFrame, fields: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per observation and chosen field that allows its document type; the preferred scope wins, all its ties stay."""
    df = matched_fields(obs, fields, keys or ["canonical_key"])
    df = df.withColumn("_x", F.explode("_fields")).where(F.array_contains("_x.document_types_allowed", F.col("document_type")))
    return df.select(*obs.columns, "_x.field_name", "_x.target_column", "_x.field_type", "_x.temporal_scope", "_x.normalization_rule", "_x.autofill_threshold")


def first_field_name(obs: DataFrame, fields: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """obs with `field_name`: the first chosen field, or null."""
    df = matched_fields(obs, fields, keys or ["canonical_key"])
    return df.withColumn("field_name", F.try_element_at("_fields", F.lit(1))["field_name"]).drop("_fields")


def temporal_label(scope: Column) -> Column:
    out = F.lit("unknown")
    for k, v in LABELS.items():
        out = F.when(scope == k, v).otherwise(out)
    return out


def event_date(document_date: Column, run_date: Column) -> Column:
    return F.coalesce(document_date, run_date)


def line_number(scope: Column) -> Column:
    return F.when(scope.rlike("^line_l[234]$"), F.substring(scope, 7, 1).cast("int"))


def normalise(rule: Column, value: Column, evidence: Column, unit: Column) -> Column:
    """The value (tagged struct) as its field's rule wants it; unknown rules change nothing."""
    make = lambda kind, s=None, n=None, b=None: F.struct(
        F.lit(kind).alias("kind"), (s if s is not None else F.lit(None)).cast("string").alias("s"), (n if n is not None else F.lit(None)).cast("double").alias("n"), (b if b is not None else F.lit(None)).cast("boolean").alias("b")
    )
    low = F.lower(F.trim(value["s"]))
    code = recist_code(value["s"])
    mm = F.coalesce(first_size_mm(evidence), F.when(F.lower(unit).startswith("c"), value["n"] * 10).otherwise(value["n"]))
    return (
        F.when((rule == "recist_category") & code.isin("CR", "PR", "SD", "PD", "NE"), make("s", s=code))
        .when((rule == "numeric_mm") & mm.isNotNull(), make("n", n=mm))
        .when((rule == "bool_yes_no") & low.isin("true", "yes", "oui", "1"), make("b", b=F.lit(True)))
        .when((rule == "bool_yes_no") & low.isin("false", "no", "non", "0"), make("b", b=F.lit(False)))
        .otherwise(value)
    )


def blend(base: Column, retrieval: Column) -> Column:
    """Half extraction, half retrieval, within 0 and 1; base alone where nothing was retrieved."""
    return F.when(retrieval.isNull(), base).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.5 * base + 0.5 * retrieval)))


def best_per_column(cands: DataFrame, keys: list[str], confidence: str, order: str, keep: list[str]) -> DataFrame:
    """The most confident candidate of each cell, the earliest of equals: one hash aggregate with partial sums, no sort."""
    best = F.max_by(F.struct(*keep), F.struct(F.col(confidence), (-F.col(order)).alias("o")))
    return cands.groupBy(*keys).agg(F.max(confidence).alias(confidence), best.alias("b")).select(*keys, confidence, "b.*")


def validate(field_type: Column, value: Column) -> Column:
    """Errors of a value against its field's type, as an array."""
    numeric_ok = value["kind"].isin("n", "b")
    low = F.lower(F.trim(value["s"]))
    bool_ok = (value["kind"] == "b") | (value["n"].isin(0.0, 1.0)) | low.isin("true", "false", "")
    return F.array_compact(
        F.array(
            F.when(field_type.isNull(), "unknown field"),
            F.when((field_type == "numeric") & ~F.coalesce(numeric_ok, F.lit(False)), "number expected"),
            F.when((field_type == "boolean") & value.isNotNull() & ~F.coalesce(bool_ok, F.lit(False)), "boolean expected"),
        )
    )


def first_or_last(df: DataFrame, by: list[str], order: list[str], last: bool = False) -> DataFrame:
    """First (or last) row per key without a sort."""
    agg = (F.max_by if last else F.min_by)(F.struct(*[F.col(c) for c in df.columns]), F.struct(*order))
    return df.groupBy(*[F.col(b).alias(f"_k{i}") for i, b in enumerate(by)]).agg(agg.alias("r")).select("r.*")


def margin(df: DataFrame, key: str, score: str) -> DataFrame:
    """Best and second-best score per key and their distance: two largest in one pass."""
    w = Window.partitionBy(key).orderBy(F.desc(score))
    ranked = df.withColumn("_n", F.row_number().over(w)).where("_n <= 2")
    return ranked.groupBy(key).agg(F.max(F.when(F.col("_n") == 1, F.col(score))).alias("best"), F.max(F.when(F.col("_n") == 2, F.col(score))).alias("second")).withColumn("margin", F.round(F.col("best") - F.coalesce("second", F.lit(0.0)), 6))
