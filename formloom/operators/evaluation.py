"""Evaluation of filled forms against gold, and of retrieval against silver judgments.

Null means absent. A rate over nothing is null. Equal paths of one sample count once; unknown
predicted paths are reported as out of template.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formloom.functions.text import fold

UNIT_ALIASES = {"ui/l": "u/l", "iu/l": "u/l", "µmol/l": "umol/l", "µg/l": "ug/l"}  # fixed values


def normal_text(c: Column) -> Column:
    """Folded text of letters, digits and points, words parted by one space."""
    f = F.replace(fold(F.regexp_replace(c, "[µμœŒæÆαβγ]", "")), F.lit(","), F.lit("."))
    return F.trim(F.regexp_replace(f, r"[^a-z0-9.]+", " "))


def canonical_unit(c: Column) -> Column:
    u = F.replace(F.replace(F.lower(F.trim(c)), F.lit("μ"), F.lit("µ")), F.lit(" "), F.lit(""))
    out = u
    for k, v in UNIT_ALIASES.items():
        out = F.when(u == k, v).otherwise(out)
    return out


def numbers_match(a: Column, b: Column, abs_tol: float = 1e-6, rel_tol: float = 1e-6) -> Column:
    return F.abs(a - b) <= F.greatest(rel_tol * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_tol))


def values_match(p: Column, e: Column) -> Column:
    """Tagged values: numbers within tolerance, texts by their normal form, booleans as 0 and 1 against numbers."""
    num = lambda x: F.coalesce(x["n"], x["b"].cast("double"))
    return F.when((p["kind"] == "s") & (e["kind"] == "s"), normal_text(p["s"]) == normal_text(e["s"])).when((p["kind"] != "s") & (e["kind"] != "s"), numbers_match(num(p), num(e))).otherwise(F.lit(False))


def outcomes(gold: DataFrame, predicted: DataFrame, keys: list[str], match: Column) -> DataFrame:
    """gold(keys, g, g_unit) with predicted(keys, p, p_unit): outcome of each eligible field."""
    j = gold.join(predicted, keys, "left")
    unit_ok = F.col("g_unit").isNull() | (canonical_unit(F.col("g_unit")).eqNullSafe(canonical_unit(F.col("p_unit"))))
    g, p = F.col("g").isNotNull(), F.col("p").isNotNull()
    out = F.when(g & p & match & unit_ok, "match").when(g & p, "wrong_value").when(g, "missing").when(p, "false_fill").otherwise("true_empty")
    return j.withColumn("outcome", out)


def counts(fields: DataFrame, by: list[str]) -> DataFrame:
    """Conditional sums of outcomes, for every `by` group and over all (grouping sets in one pass)."""
    o = F.col("outcome")
    agg = [
        F.count("*").alias("eligible"), F.count_if(o.isin("match", "wrong_value")).alias("tp"), F.count_if(o == "false_fill").alias("fp"), F.count_if(o == "missing").alias("fn"),
        F.count_if(o.isin("match", "wrong_value", "false_fill")).alias("predicted"), F.count_if(o == "match").alias("correct"),
    ]
    return fields.rollup(*by).agg(*agg) if by else fields.agg(*agg)


def metrics(c: DataFrame) -> DataFrame:
    """Rates of counts; f1 is 0 where precision and recall are, null where either is."""
    r = lambda a, b: F.round(F.try_divide(F.col(a).cast("double"), F.col(b)), 6)
    p, q = F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn"))
    f1 = F.when(p + q == 0, 0.0).otherwise(F.try_divide(2 * p * q, p + q))
    return c.withColumns({
        "precision": F.round(p, 6), "recall": F.round(q, 6), "f1": F.round(f1, 6), "autofill_rate": r("predicted", "eligible"),
        "false_autofill_rate": r("fp", "predicted"), "value_accuracy": r("correct", "tp"), **({"validation_pass_rate": r("valid", "predicted")} if "valid" in c.columns else {}),
    })


def macro(m: DataFrame, rates: list[str]) -> DataFrame:
    """Means of the groups' rates; null ones don't count."""
    return m.agg(*[F.round(F.avg(c), 6).alias(f"macro_{c}") for c in rates])


def discover(parts: dict[str, DataFrame], key: str = "sample_id") -> DataFrame:
    """(sample_id, complete, missing): full outer join of the parts as one aggregate over their union."""
    union = None
    for i, (name, df) in enumerate(parts.items()):
        one = df.select(F.col(key).alias("sample_id"), F.lit(i).alias("i"))
        union = one if union is None else union.unionAll(one)
    have = union.where("sample_id is not null").groupBy("sample_id").agg(F.collect_set("i").alias("have"))
    names = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(n).alias("n")) for i, n in enumerate(parts)])
    missing = F.transform(F.filter(names, lambda x: ~F.array_contains("have", x["i"])), lambda x: x["n"])
    return have.select("sample_id", (F.size(missing) == 0).alias("complete"), F.array_join(missing, ",").alias("missing"))


def out_of_template(predicted: DataFrame, template: DataFrame, keys: list[str]) -> DataFrame:
    return predicted.join(template.select(*keys).distinct(), keys, "left_anti")


def contract(kind_gold: Column, kind: Column, unit_declared: Column, unit: Column) -> Column:
    """Errors of a predicted field against its gold type and declared unit."""
    return F.array_compact(F.array(
        F.when(kind_gold.isNotNull() & (kind_gold != kind), "type"),
        F.when(unit_declared.isNotNull() & ~canonical_unit(unit_declared).eqNullSafe(canonical_unit(unit)), "unit"),
    ))


#: Other words for the labels of two imaging fields; families of template sections.
LABEL_ALIASES = {"size major nodule mm start atezobev d0": ("lesion cible", "grand axe"), "response at first imaging recist": ("recist", "reponse")}
SECTION_FAMILIES = {"hematologie": "hematology", "hemostase": "coagulation", "biochimie": "hepatic_biochemistry", "imaging recist": "imaging_recist"}


def value_needles(value: Column) -> Column:
    """How a tagged value may stand in a text: its normal form, for whole numbers also without decimals; blank forms go."""
    n = value["n"]
    text = F.when(value["kind"] == "n", n.cast("string")).when(value["kind"] == "b", value["b"].cast("string")).otherwise(value["s"])
    whole = F.when((value["kind"] == "n") & (n == F.floor(n)) & (F.abs(n) < 1e15), n.cast("bigint").cast("string"))
    return F.filter(F.array_distinct(F.array_compact(F.array(normal_text(text), normal_text(whole)))), lambda x: x != "")


def scalar_type(value: Column) -> Column:
    """number, text, boolean or null of a tagged value."""
    return F.when(value.isNull(), "null").when(value["kind"] == "n", F.when(value["n"].isNull(), "null").otherwise("number")).when(value["kind"] == "b", F.when(value["b"].isNull(), "null").otherwise("boolean")).otherwise(F.when(value["s"].isNull(), "null").otherwise("text"))


def family_of_section(section: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in SECTION_FAMILIES.items():
        out = F.when(normal_text(section) == k, v).otherwise(out)
    return out


def silver_judgments(fields: DataFrame, chunks: DataFrame) -> DataFrame:
    """fields(sample_id, path, label, value, unit) x chunks(sample_id, chunk_id, text) of one sample.

    A chunk that holds the label (or another word for it) and the value is a candidate; the unit decides
    between several; exactly one is `matched`, none `unmatched`, more `ambiguous`. value is a tagged struct.
    The chunks of a sample are gathered once, a field judges them inside its own row.
    """
    held = chunks.groupBy("sample_id").agg(F.collect_list(F.struct("chunk_id", normal_text(F.col("text")).alias("t"))).alias("_c"))
    label = normal_text(F.col("label"))
    other = F.array().cast("array<string>")
    for k, v in LABEL_ALIASES.items():
        other = F.when(label == k, F.array(*[F.lit(x) for x in v])).otherwise(other)
    f = fields.where(scalar_type(F.col("value")) != "null").withColumns({"_l": F.concat(F.array(label), other), "_v": value_needles(F.col("value")), "_u": normal_text(F.col("unit"))})
    f = f.join(held, "sample_id", "left")
    hit = F.filter(F.coalesce("_c", F.array().cast("array<struct<chunk_id:string,t:string>>")), lambda c: F.exists("_l", lambda x: F.contains(c["t"], x)) & F.exists("_v", lambda x: F.contains(c["t"], x)))
    f = f.withColumn("_h", hit)
    with_unit = F.filter("_h", lambda c: (F.col("_u") != "") & F.contains(c["t"], F.col("_u")))
    f = f.withColumn("_h", F.when((F.size("_h") > 1) & F.col("_u").isNotNull() & (F.size(with_unit) > 0), with_unit).otherwise(F.col("_h")))
    n = F.size("_h")
    return f.select("sample_id", "path", F.when(n == 1, "matched").when(n == 0, "unmatched").otherwise("ambiguous").alias("status"), F.when(n == 1, F.element_at("_h", 1)["chunk_id"]).alias("chunk_id"))


def recall_summary(judged: DataFrame, hits: DataFrame, ks: list[int], family: str = "family") -> DataFrame:
    """judged(sample_id, path, family, status, chunk_id), hits(sample_id, family, rank, chunk_id) -> per sample: recall at each k over the matched
    fields of supported families, and how many fields are matched, unmatched, ambiguous or of no supported family."""
    best = hits.groupBy("sample_id", family, "chunk_id").agg(F.min("rank").alias("_rank"))
    j = judged.join(best, ["sample_id", family, "chunk_id"], "left")
    supported = F.col(family).isNotNull()
    counted = supported & (F.col("status") == "matched")
    return j.groupBy("sample_id").agg(
        *[F.round(F.avg(F.when(counted, (F.coalesce("_rank", F.lit(10**9)) <= k).cast("double"))), 6).alias(f"recall_{k}") for k in sorted(set(ks))],
        F.count_if(counted).alias("matched"), F.count_if(supported & (F.col("status") == "unmatched")).alias("unmatched"),
        F.count_if(supported & (F.col("status") == "ambiguous")).alias("ambiguous"), F.count_if(~supported).alias("unsupported_family"),
    )


_VALUE = T.StructType([T.StructField("kind", T.StringType()), T.StructField("s", T.StringType()), T.StructField("n", T.DoubleType()), T.StructField("b", T.BooleanType())])
_LEAF = T.StructType([T.StructField("path", T.ArrayType(T.StringType())), T.StructField("value", _VALUE), T.StructField("unit", T.StringType()), T.StructField("declared", T.BooleanType())])


@F.pandas_udf(T.ArrayType(_LEAF))
def flatten_json(templates: pd.Series) -> pd.Series:
    """The leaves of template objects (objects with `valeur`), in order; null where the text is no object or repeats a key."""
    def one(t):
        try:
            return [_leaf(*x) for x in _leaves(_object(t))] if t is not None else None
        except ValueError:
            return None

    return templates.map(one)


def _object(text: str) -> dict:
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


def _leaves(node: dict, path: tuple = ()):
    if "valeur" in node:
        yield path, node["valeur"], node.get("unité", node.get("unite")), "unité" in node or "unite" in node
        return
    for k, v in node.items():
        if isinstance(v, dict):
            yield from _leaves(v, (*path, k))


def _leaf(path, value, unit, declared) -> dict:
    kind = "b" if isinstance(value, bool) else "n" if isinstance(value, int | float) else "s"
    return {
        "path": list(path), "unit": unit, "declared": declared,
        "value": {"kind": kind, "s": value if kind == "s" and value is not None else None, "n": float(value) if kind == "n" else None, "b": value if kind == "b" else None},
    }


def passes(report: dict[str, float | None] | None, thresholds: dict[str, float]) -> int:
    """0 if every named rate reaches its threshold, else 1; an absent rate fails. Rates named `max_...` must not exceed it.
    2 where the input itself is at fault: a threshold outside 0..1, or nothing evaluated."""
    if any(not 0 <= t <= 1 for t in thresholds.values()) or report is None:
        return 2
    for name, t in thresholds.items():
        v = report.get(name.removeprefix("max_"))
        if v is None or (v > t if name.startswith("max_") else v < t):
            return 1
    return 0


def parse_threshold(text: str) -> tuple[str, float]:
    """`name=0.95` of a command line."""
    name, sep, value = text.partition("=")
    t = float(value) if sep else float("nan")
    if not name or not 0 <= t <= 1:
        raise ValueError(f"NAME=THRESHOLD with a threshold in 0..1 is expected: {text!r}")
    return name, t


def shown(rate: float | None) -> str:
    """A rate in a report: four decimals, or n/a."""
    return "n/a" if rate is None else f"{rate:.4f}"


def summary_text(report: dict[str, float | None]) -> str:
    return "\n".join(f"{k}: {shown(v)}" for k, v in report.items())
