"""Problem 5: one surviving row per group of duplicates, field by field or in consistent bundles.

A bundle is a set of dependent fields taken together from one source row (a value and its unit, the parts
of an address). Trust of a row is (confidence with percentages divided by 100, null lowest; then
created_at; then smallest id). The choice of bundles maximises the sum of their confidences, then the trust
of the first, second, ... bundle, under functional dependencies: `fd=(x, y)` demands that the chosen y is
one that stands beside the chosen x in some row of the group. A bundle may stay empty, at no confidence.

Branch and bound, as relations. The root relaxation (each bundle's most trusted row, no dependency) is one
hash aggregate and an upper bound of every solution; where it violates no dependency it is the optimum.
Only the other groups branch, bundle after bundle: a partial choice is extended along the pairs of values
that stand beside each other. Its bound is its own confidence plus the root's of the bundles to come; what
stays below the most trusted row taken whole, which is always a solution, is cut. Of partial choices that
later dependencies cannot tell apart the best remains. So a group has never more partial choices than
distinct pairs of values, and these are rows of a table, not a list in one task: a group may be of any size.

Edge cases: null, blank and `NA` texts are empty; a field empty in all rows of a group has no source
row; groups of one row survive as they are; ties fall to the smallest id; null keys form no group;
repeated rows count as rows; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.functions.text import blank, empty_cell
from formloom.llm.canonical import UNMATCHED, match_values, reference_forms
from formloom.session import cut

ATTRIBUTES = ("value_text", "unit", "event_date")


def trust(confidence: Column, created: Column, rank_id: Column) -> Column:
    """Sorts upwards: the greatest struct is the most trusted row; nulls sort lowest."""
    c = F.when(confidence > 1, confidence / 100).otherwise(confidence)
    return F.struct(c.alias("c"), created.alias("t"), (-rank_id).alias("i"))


def is_empty(df: DataFrame, field: str) -> Column:
    return empty_cell(F.col(field)) if dict(df.dtypes)[field] == "string" else F.col(field).isNull()


def fields_named(cands: DataFrame, defs: DataFrame) -> DataFrame:
    """cands with `field`: the field_defs entry that field_name, else target_column, names in any form."""
    forms = reference_forms(defs, "field_name", [F.array("field_name", "target_column"), F.col("header_aliases")])
    said = cands.select(F.explode(F.array("field_name", "target_column")).alias("said")).distinct()
    m = match_values(said, "said", forms).where(F.col("ref_key") != UNMATCHED)
    # field names are few (hundreds): AQE broadcasts the map where its measured size allows
    a = m.select(F.col("said").alias("field_name"), F.col("ref_key").alias("_a"))
    b = m.select(F.col("said").alias("target_column"), F.col("ref_key").alias("_b"))
    return cands.join(a, "field_name", "left").join(b, "target_column", "left").withColumn("field", F.coalesce("_a", "_b")).drop("_a", "_b")


#: Confidence of a row that states none: below every stated one, above an empty bundle.
UNSTATED = 1e-6


def survivors(
    rows: DataFrame,
    keys: Sequence[str],
    bundles: Sequence[Sequence[str]],
    rank: Column,
    id_col: str,
    fds: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """(keys..., n_rows, b0, b1, ...): per group and bundle a struct of the source id and the bundle's fields, or null.

    The first field of a bundle leads it: where it is empty, the row has no such bundle.
    """
    df = rows.withColumn("_rank", rank)
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    has = [~is_empty(df, b[0]) for b in bundles]
    aggs = [F.max(F.when(has[j], F.struct("_rank", F.col(id_col).alias("id"), *b))).alias(f"b{j}") for j, b in enumerate(bundles)]
    root = df.groupBy(*keys).agg(F.count("*").alias("n_rows"), *aggs)
    if not fds:
        return root
    fields = dict.fromkeys(f for b in bundles for f in b)
    df = cut(df.select(*keys, id_col, *fields, "_rank"), "rows")  # read by every branch below
    has = [~is_empty(df, b[0]) for b in bundles]
    aggs = [F.max(F.when(has[j], F.struct("_rank", F.col(id_col).alias("id"), *b))).alias(f"b{j}") for j, b in enumerate(bundles)]
    root = df.groupBy(*keys).agg(F.count("*").alias("n_rows"), *aggs)
    where = {f: j for j, b in enumerate(bundles) for f in b}
    links = [(where[x], x, where[y], y) for x, y in fds]
    if any(i == j for i, _, j, _ in links):
        raise ValueError("a dependency joins fields of two bundles")
    pairs = [df.where(has[i] & has[j] & ~is_empty(df, x) & ~is_empty(df, y)).select(*keys, F.col(x).alias("_x"), F.col(y).alias("_y")).distinct() for i, x, j, y in links]
    # the root where it keeps every dependency
    test = root
    for n, ((i, x, j, y), p) in enumerate(zip(links, pairs)):
        test = test.withColumns({"_x": F.col(f"b{i}")[x], "_y": F.col(f"b{j}")[y]}).join(p.withColumn(f"_ok{n}", F.lit(True)), [*keys, "_x", "_y"], "left")
        test = test.withColumn(f"_ok{n}", F.col("_x").isNull() | F.col("_y").isNull() | F.col(f"_ok{n}").isNotNull()).drop("_x", "_y")
    ok = F.expr(" and ".join(f"_ok{n}" for n in range(len(links))))
    test = cut(test.withColumn("_ok", ok).drop(*[f"_ok{n}" for n in range(len(links))]), "roots")
    done = test.where("_ok").drop("_ok")
    open_groups = test.where("not _ok").drop("_ok")

    def score(r: Column) -> Column:
        return F.when(r.isNull(), 0.0).otherwise(F.coalesce(r["_rank"]["c"], F.lit(UNSTATED)))

    # a row taken whole keeps every dependency: no solution below the best of them is of use
    ids = open_groups.select(*keys)
    back = df.join(ids, list(keys), "left_semi")
    row_score = sum((F.when(h, F.coalesce(F.col("_rank")["c"], F.lit(UNSTATED))).otherwise(0.0) for h in has), F.lit(0.0))
    floor = back.groupBy(*keys).agg(F.max(row_score).alias("_floor"))
    bounds = open_groups.join(floor, list(keys)).select(*keys, "_floor", *[score(F.col(f"b{j}")).alias(f"_u{j}") for j in range(len(bundles))])
    base = bounds.select(*keys, "_floor", *[f"_u{j}" for j in range(len(bundles))], F.lit(0.0).alias("_sum"), F.expr("cast(array() as array<struct<t:timestamp,i:bigint>>)").alias("_tie"))
    part = base
    for j, b in enumerate(bundles):
        kind = F.struct("_rank", F.col(id_col).alias("id"), *b)
        back_j = back.where(has[j])
        values = back_j.groupBy(*keys, *[F.col(f).alias(f"_v{f}") for f in b]).agg(F.max(kind).alias(f"b{j}")).select(*keys, f"b{j}")
        later = [x if i == j else y for i, x, k, y in links if j in (i, k) and max(i, k) > j]
        if not later and not any(max(i, k) == j for i, _, k, _ in links):
            values = values.groupBy(*keys).agg(F.max(f"b{j}").alias(f"b{j}"))  # nothing depends on it: the best one
        now = [(n, x, i, y, k) for n, (i, x, k, y) in enumerate(links) if max(i, k) == j]
        empty = part.withColumn(f"b{j}", F.lit(None).cast(values.schema[f"b{j}"].dataType))
        if now:
            n, x, i, y, k = now[0]
            early, e_field, l_field, e_pair, l_pair = (i, x, y, "_x", "_y") if k == j else (k, y, x, "_y", "_x")
            told = part.withColumn("_e", F.col(f"b{early}")[e_field])
            along = told.where("_e is not null").join(pairs[n].select(*keys, F.col(e_pair).alias("_e"), F.col(l_pair).alias("_l")), [*keys, "_e"])
            along = along.join(values.withColumn("_l", F.col(f"b{j}")[l_field]), [*keys, "_l"]).drop("_e", "_l")
            free = told.where("_e is null").drop("_e").join(values, list(keys))
            blank_l = told.where("_e is not null").drop("_e").join(values.where(F.col(f"b{j}")[l_field].isNull()), list(keys))
            more = along.unionByName(free).unionByName(blank_l)
            for n, x, i, y, k in now[1:]:
                more = more.withColumns({"_x": F.col(f"b{i}")[x], "_y": F.col(f"b{k}")[y]})
                both = F.col("_x").isNotNull() & F.col("_y").isNotNull()
                more = more.where(both).join(pairs[n], [*keys, "_x", "_y"], "left_semi").unionByName(more.where(~both)).drop("_x", "_y")
        else:
            more = part.join(values, list(keys))
        part = more.unionByName(empty)
        s = F.col(f"b{j}")
        part = part.withColumn("_sum", F.round(F.col("_sum") + score(s), 9)).withColumn("_tie", F.array_append("_tie", F.struct(s["_rank"]["t"].cast("timestamp").alias("t"), s["_rank"]["i"].cast("long").alias("i"))))
        rest = sum((F.col(f"_u{k}") for k in range(j + 1, len(bundles))), F.lit(0.0))
        part = part.where(F.col("_sum") + rest >= F.col("_floor") - 1e-6)
        # what later dependencies still ask for
        asked = sorted({(i, x) for i, x, k, _ in links if i <= j < k} | {(k, y) for i, _, k, y in links if k <= j < i})
        front = [F.col(f"b{i}")[f].alias(f"_q{n}") for n, (i, f) in enumerate(asked)]
        cols = part.columns
        part = part.groupBy(*keys, *front).agg(F.max_by(F.struct(*cols), F.struct("_sum", "_tie")).alias("_p")).select("_p.*")
    picked = part.join(open_groups.select(*keys, "n_rows"), list(keys)).select(*keys, "n_rows", *[f"b{j}" for j in range(len(bundles))])
    return done.unionByName(picked)


def form_groups(cands: DataFrame, defs: DataFrame) -> DataFrame:
    return fields_named(cands, defs).where("field is not null")


def p5_found(cands: DataFrame, defs: DataFrame) -> DataFrame:
    """One row per group of two or more rows and attribute with a value: the row it comes from.

    TESTDATA.md takes each attribute from its own best row, so each bundle is one attribute here.
    """
    g = form_groups(cands, defs)
    s = survivors(g, ("patient_id", "study_id", "field"), [(a,) for a in ATTRIBUTES], trust(F.col("confidence"), F.col("created_at"), F.col("candidate_id")), "candidate_id")
    parts = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(f"b{j}.id").alias("candidate_id")) for j, a in enumerate(ATTRIBUTES)])
    return (
        s.where("n_rows >= 2")
        .select("patient_id", "study_id", F.col("field").alias("field_name"), F.explode(parts).alias("p"))
        .where("p.candidate_id is not null")
        .select("patient_id", "study_id", "field_name", "p.attribute", "p.candidate_id")
    )


def p5_records(cands: DataFrame, defs: DataFrame) -> DataFrame:
    """The surviving row of every group."""
    g = form_groups(cands, defs)
    s = survivors(g, ("patient_id", "study_id", "field"), [(a,) for a in ATTRIBUTES], trust(F.col("confidence"), F.col("created_at"), F.col("candidate_id")), "candidate_id")
    return s.select("patient_id", "study_id", F.col("field").alias("field_name"), "n_rows", *[F.col(f"b{j}")[a].alias(a) for j, a in enumerate(ATTRIBUTES)])


def p5_bundles(cands: DataFrame, defs: DataFrame) -> DataFrame:
    """Survivors in two bundles, value with unit and date with document; a value and a date must have stood beside each other."""
    g = form_groups(cands, defs)
    s = survivors(
        g, ("patient_id", "study_id", "field"), [("value_text", "unit"), ("event_date", "document_id")],
        trust(F.col("confidence"), F.col("created_at"), F.col("candidate_id")), "candidate_id", fds=[("value_text", "event_date")],
    )
    return s.select(
        "patient_id", "study_id", F.col("field").alias("field_name"), "n_rows", F.col("b0.id").alias("value_from"), "b0.value_text", "b0.unit", F.col("b1.id").alias("date_from"), "b1.event_date", "b1.document_id",
    )
