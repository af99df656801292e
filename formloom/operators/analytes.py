"""Which analyte a lab line is about, by equality joins only.

The name as typed, its words in any order and the name printed in raw_text are looked up among the
forms of the analyte list, also by word beginnings; typed names that are left are joined on deletion
variants of their first letters (texts within two typing errors share a beginning with at most two
letters deleted) and verified by levenshtein.

Edge cases: null or blank names fall back to canonical_name; no match or a tie gives null; repeated
rows, empty tables and extra columns are kept as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.functions.text import blank, fold
from formloom.operators.units import name_part
from formloom.session import BROADCAST_ROWS, bounded, cut


def plain_name(c: Column) -> Column:
    """Folded name without remarks and brackets around it."""
    c = F.regexp_replace(c, r"[\s\u00a0\u202f]+", " ")
    c = F.regexp_replace(c, r"\s*[\(\[][^\(\)\[\]]*[\)\]]\s*$", "")
    c = F.regexp_replace(c, r"(?i)\s+(?:[-–—;:]\s+.*|[àa]\s+j\d+\s*)$", "")
    f = F.translate(F.replace(fold(F.trim(c)), F.lit("\\/"), F.lit("v")), "@†", "at")
    f = F.regexp_replace(f, r"\s*(?:[*:;,…]+|\.{2,})\s*$", "")
    return F.when(f.rlike(r"^(?:[a-z0-9]\.){2,}[a-z0-9]?$"), F.replace(f, F.lit("."), F.lit(""))).otherwise(f)


def _spaced(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[^a-z0-9]+", " "))


def _looks(c: Column) -> Column:
    """Look-alike letters of scans on one sign, without spaces."""
    s = F.regexp_replace(c, r"[^a-z0-9]+", "")
    for a, b in (("rn", "m"), ("ri", "n"), ("ii", "u"), ("li", "h")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.translate(s, "01l59qc", "oiisgge")


def _deletions(c: Column) -> Column:
    """The text and every text with one letter deleted."""
    return F.array_distinct(
        F.concat(F.array(c), F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substr(c, F.lit(1), i - 1), F.substr(c, i + 1))))
    )


def resolve(lines: DataFrame, analyte_ref: DataFrame, out: str = "analyte") -> DataFrame:
    """lines with the canonical key in `out`, or null."""
    forms = (
        analyte_ref.select("canonical_key", F.explode(F.array_compact(F.concat(F.array("canonical_key", "label_fr", "label_en"), F.col("aliases")))).alias("form"))
        .withColumn("f", plain_name(F.col("form")))
        .withColumn("fs", _spaced(F.col("f")))
        .dropDuplicates(["canonical_key", "fs"])
    )
    # the list's size is checked before the lookups broadcast what is made of it
    small = F.broadcast if forms.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else (lambda df: df)
    typed = F.when(~blank(F.col("name")), F.col("name")).when(~blank(F.col("canonical_name")), F.col("canonical_name"))
    rows = lines.withColumn("_t", typed).withColumn("_p", F.when(~blank(F.col("name")), name_part(F.col("raw_text"))))
    names = rows.select(F.explode(F.array(F.struct(F.col("_t").alias("t"), F.lit(True).alias("typed")), F.struct(F.col("_p").alias("t"), F.lit(False).alias("typed")))).alias("x")).select("x.*")
    names = names.where(~blank(F.col("t"))).groupBy("t").agg(F.max("typed").alias("typed")).withColumn("f", plain_name(F.col("t"))).withColumn("fs", _spaced(F.col("f")))
    # read by every lookup below; written before it is filtered, else the plain form would be made of every line for the filter
    names = cut(names, "names").where("fs <> ''")
    by = []
    for cost, expr in ((0, lambda c: c), (1, lambda c: F.array_join(F.sort_array(F.split(c, " ")), " ")), (2, _looks)):
        k = forms.select("canonical_key", expr(F.col("fs")).alias("k")).distinct()
        by.append(names.withColumn("k", expr(F.col("fs"))).join(small(k), "k").select("t", "canonical_key", F.lit(cost).alias("cost")))
    begin = F.array_join(F.transform(F.split(F.col("fs"), " "), lambda x: F.substring(x, 1, 2)), " ")
    short = names.where(F.col("f").rlike(r"[a-z0-9]{2,}\.(?:\s|$)")).withColumn("k", begin)
    parts = F.filter(F.split(F.regexp_replace(F.col("f"), r"[^a-z0-9. ]", " "), r"\s+"), lambda x: x != "")
    by.append(
        short.join(small(forms.select("canonical_key", F.col("fs").alias("gs"), begin.alias("k"))), "k")
        .where(F.forall(F.zip_with(parts, F.split("gs", " "), lambda a, b: F.coalesce(F.when(a.endswith("."), b.startswith(F.replace(a, F.lit("."), F.lit("")))).otherwise(a == b), F.lit(False))), lambda ok: ok))
        .select("t", "canonical_key", F.lit(3).alias("cost"))
    )
    sure = cut(reduce(DataFrame.unionAll, by).groupBy("t").agg(F.min(F.struct("cost", "canonical_key")).alias("b"), F.count("*").alias("n")), "sure")
    # a printed name counts only as it stands, a typed one also with typing errors
    left = names.where("typed").join(sure.select("t"), "t", "left_anti").where("length(fs) >= 4")
    near = _near(left, forms)
    known = sure.select("t", F.col("b.canonical_key").alias("k"))
    a = known.unionAll(near).select(F.col("t").alias("_t"), F.col("k").alias("_k1"))
    b = known.select(F.col("t").alias("_p"), F.col("k").alias("_k2"))
    return rows.join(a, "_t", "left").join(b, "_p", "left").withColumn(out, F.coalesce("_k1", "_k2")).drop("_t", "_p", "_k1", "_k2")


#: How many first letters deletion variants are made of: two errors leave a common beginning among them.
PREFIX = 7


def _near(names: DataFrame, forms: DataFrame) -> DataFrame:
    """(t, k): the one key nearest within two typing errors (one below six letters), swaps of neighbours included."""
    variants = lambda c: F.array_distinct(F.flatten(F.transform(_deletions(F.substring(c, 1, PREFIX)), _deletions)))
    f = forms.where("length(fs) >= 4").select("canonical_key", F.col("fs").alias("gs"), F.explode(variants(F.col("fs"))).alias("v"))
    n = names.select("t", "fs", F.explode(variants(F.col("fs"))).alias("v"))
    pairs = n.join(bounded(f), "v").where("abs(length(fs) - length(gs)) <= 2").select("t", "fs", "gs", "canonical_key").distinct()
    pairs = cut(pairs, "pairs")  # else the tests below are pushed under the distinct and run once per shared variant
    letters = lambda c: F.array_join(F.sort_array(F.split(F.col(c), "")), "")
    lev = F.levenshtein("fs", "gs")
    # a swap is two of the distance and one error, and leaves the letters what they are
    pairs = pairs.withColumn("d", lev).where("d <= 4").withColumn("far", F.levenshtein(letters("fs"), letters("gs")))
    errors = F.when((F.col("d") == 4) & (F.col("far") == 0), 2).when((F.col("d") == 3) & (F.col("far") <= 2), 2).when((F.col("d") == 2) & (F.col("far") == 0), 1).otherwise(F.col("d"))
    return (
        pairs.where(errors <= F.when(F.length("gs") >= 6, 2).otherwise(1))
        .groupBy("t", "canonical_key").agg(F.min(errors * 10 + F.col("d")).alias("d"))
        .groupBy("t").agg(F.min(F.struct("d", "canonical_key")).alias("b"), F.sort_array(F.collect_list("d")).alias("ds"))
        .where((F.size("ds") == 1) | (F.element_at("ds", 1) < F.try_element_at("ds", F.lit(2))))
        .select("t", F.col("b.canonical_key").alias("k"))
    )
