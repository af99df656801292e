"""Problem 3: mapping free-entered values to a canonical list.

Pure Spark SQL. Distinct entered texts are matched in four equality joins against the forms of the
reference list: folded text, sorted words, shortened words, and a partition-based pigeonhole join
(reference forms cut into segments, joined on positional substrings, verified by levenshtein).
The closest form decides; two keys equally close, or none, give UNMATCHED (anti-join).

Edge cases: null or blank deciding text gives no row in `match_values` (key null in `map_rows`);
an empty table gives no rows; repeated rows each keep their row; extra columns are kept untouched;
texts of any length are compared with the forms at most two letters shorter or longer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.functions.text import blank, fold
from formloom.session import cut

UNMATCHED = "UNMATCHED"
#: The reference list is broadcast only up to this many forms; beyond it the joins shuffle.
BROADCAST_FORMS = 20_000
#: Letter shapes that scanning confuses, folded onto one class (fixed values).
SHAPES_FROM, SHAPES_TO = "01l5@†9q", "oiisatgg"


def bare(c: Column) -> Column:
    """The entered text without what was added around the name: remarks, brackets, marks at the end."""
    c = F.regexp_replace(c, r"[  \s]+", " ")
    c = F.regexp_replace(c, r"(?i)\s*[\(\[][^\(\)\[\]]*[\)\]]\s*$", "")
    c = F.regexp_replace(c, r"(?i)\s+(?:[-–—;:]\s+.*|[àa]\s+j\d+\s*)$", "")
    c = F.regexp_replace(c, r"\s*(?:[*:;,…]+|\.{2,}|\s\.)\s*$", "")
    return F.trim(c)


def name_key(c: Column) -> Column:
    """Folded words; runs of single letters with full stops are one word."""
    f = F.replace(fold(c), F.lit("\\/"), F.lit("v"))
    f = F.translate(f, "@†", "at")
    dotted = f.rlike(r"^\s*(?:[a-z0-9]\.){2,}[a-z0-9]?\s*$")
    return F.when(dotted, F.regexp_replace(f, r"[^a-z0-9]", "")).otherwise(
        F.trim(F.regexp_replace(f, r"[^a-z0-9]+", " "))
    )


def shape_key(k: Column) -> Column:
    """name_key with scanning look-alikes on one letter and without spaces."""
    s = F.regexp_replace(k, " ", "")
    for a, b in (("rn", "m"), ("ri", "n"), ("ii", "u"), ("li", "h"), ("vv", "w")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.translate(s, SHAPES_FROM, SHAPES_TO)


def sorted_words(k: Column) -> Column:
    return F.array_join(F.sort_array(F.split(k, " ")), " ")


def edits_allowed(n: Column) -> Column:
    """Typing errors (insert, delete, replace, swap of neighbours) allowed in a form of n letters."""
    return F.when(n >= 6, 2).when(n >= 4, 1).otherwise(0)


def reference_forms(ref: DataFrame, key: str, forms: list[Column]) -> DataFrame:
    """(ref_key, form, fkey, flen): one row per distinct folded form of each entry."""
    f = ref.select(F.col(key).alias("ref_key"), F.explode(F.array_distinct(F.array_compact(F.concat(*forms)))).alias("form"))
    return (
        f.where(~blank(F.col("form")))
        .withColumn("fkey", name_key(F.col("form")))
        .dropDuplicates(["ref_key", "fkey"])
        .withColumn("flen", F.length("fkey"))
    )


def _seg_bounds(df: DataFrame, length: str, edits: Column) -> DataFrame:
    """One row per segment: 2k+1 segments, as a swap across a cut touches two of them."""
    n = 2 * edits + 1
    return (
        df.withColumn("k", edits)
        .where("k > 0")
        .withColumn("n", n)
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .withColumn("s0", F.floor(F.col("i") * F.col(length) / F.col("n")).cast("int"))
        .withColumn("s1", F.floor((F.col("i") + 1) * F.col(length) / F.col("n")).cast("int"))
        .withColumn("sl", F.col("s1") - F.col("s0"))
    )


def close_pairs(names: DataFrame, forms: DataFrame, hint) -> DataFrame:
    """Pigeonhole join: (nkey, ref_key, fkey, dist, lev) of all pairs within the allowed typing errors.

    A form of length L and an entered text of length L+d share, unshifted up to the edits left, at
    least one whole segment; d and the shift are bounded by k, so every probe is an equality join on
    (L, i, substring). levenshtein <= 2k verifies; a distance above k must be explained by swaps,
    which keep the letters: the sorted letters may differ by no more than the rest allows.
    """
    segs = _seg_bounds(forms, "flen", edits_allowed(F.col("flen"))).select(
        "ref_key", "fkey", "flen", "k", "i", F.expr("substring(fkey, s0 + 1, sl)").alias("seg")
    )
    layout = (
        _seg_bounds(forms.select("flen").distinct(), "flen", edits_allowed(F.col("flen")))
        .select("flen", "k", "i", "s0", "sl")
    )
    d = F.col("d")
    probes = (
        names.select("nkey", F.length("nkey").alias("nlen"))
        .withColumn("d", F.explode(F.array(*[F.lit(x) for x in (-2, -1, 0, 1, 2)])))
        .withColumn("flen", F.col("nlen") - d)
        .join(hint(layout), "flen")
        .where(F.abs(d) <= F.col("k"))
        .withColumn("sh", F.explode(F.sequence(F.lit(-2), F.lit(2))))
        .where(F.abs("sh") + F.abs(d - F.col("sh")) <= F.col("k"))
        .where(F.col("s0") + F.col("sh") >= 0)
        .select("nkey", "flen", "i", F.expr("substring(nkey, s0 + sh + 1, sl)").alias("seg"))
    )  # equal probes of one text need no shuffle of their own: the pairs they lead to are made distinct
    pairs = probes.join(hint(segs), ["flen", "i", "seg"]).select("nkey", "ref_key", "fkey", "k").distinct()

    def letters(c: str) -> Column:
        return F.array_join(F.sort_array(F.split(F.col(c), "")), "")

    lev = F.levenshtein("nkey", "fkey")
    far = F.levenshtein(letters("nkey"), letters("fkey"))
    return (
        pairs.withColumn("lev", lev)
        .where(F.col("lev") <= 2 * F.col("k"))
        .withColumn("bag", F.when(F.col("lev") > 1, far).otherwise(0))
        # swaps explain two of the distance each and cost one error
        .withColumn(
            "dist",
            F.when((F.col("lev") >= 4) & (F.col("bag") == 0), F.col("lev") - 2)
            .when((F.col("lev") == 3) & (F.col("bag") <= 2), F.lit(2))
            .when((F.col("lev") == 2) & (F.col("bag") == 0), F.lit(1))
            .otherwise(F.col("lev")),
        )
        .where(F.col("dist") <= F.col("k"))
        .select("nkey", "ref_key", "fkey", "dist", "lev")
    )


def match_values(values: DataFrame, text: str, forms: DataFrame, broadcast_forms: int = BROADCAST_FORMS) -> DataFrame:
    """(<text>, ref_key, how): each distinct non-blank text with the key meant, or UNMATCHED.

    Work is over distinct texts, so a text that holds a third of all rows is matched once.
    """
    small = forms.count() <= broadcast_forms  # the reference list's size is checked before it is broadcast
    hint = F.broadcast if small else (lambda df: df)
    names = (
        values.select(F.col(text).alias("text"))
        .where(~blank(F.col("text")))
        .distinct()
        .withColumn("clean", bare(F.col("text")))
        .withColumn("clean", F.when(blank(F.col("clean")), F.trim("text")).otherwise(F.col("clean")))
        .withColumn("nkey", name_key(F.col("clean")))
    )
    names = cut(names, "names")  # read by every join below
    # the distinct names are few bytes, but every one becomes many probes: spread them before, AQE would pack them into one task
    conf, spark = values.sparkSession.conf, values.sparkSession
    keys = names.select("nkey").distinct().repartition(max(int(conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
    f = forms.select("ref_key", "fkey")
    exact = names.join(hint(f), F.col("nkey") == F.col("fkey")).select("text", "ref_key", F.lit(0).alias("cost"))
    turned = names.join(
        hint(f.select("ref_key", sorted_words(F.col("fkey")).alias("w")).distinct()), F.expr("array_join(sort_array(split(nkey, ' ')), ' ')") == F.col("w")
    ).select("text", "ref_key", F.lit(1).alias("cost"))
    shaped = names.withColumn("w", shape_key(F.col("nkey"))).join(
        hint(f.select("ref_key", shape_key(F.col("fkey")).alias("w")).distinct()), "w"
    ).select("text", "ref_key", F.lit(2).alias("cost"))

    def stems(c: str) -> Column:
        return F.array_join(F.transform(F.split(F.col(c), " "), lambda x: F.substring(x, 1, 2)), " ")

    # shortened words: every full stop ends a beginning of the word in the same place
    short = names.where(F.col("text").rlike(r"(?U)\w{2,}\.(?:\s|$)")).withColumn(
        "parts", F.filter(F.split(F.regexp_replace(fold(F.col("clean")), r"[^a-z0-9. ]", " "), r"\s+"), lambda x: x != "")
    )
    # `bare` may have taken the last stop of several; a last word counts as shortened where the text ends in one stop
    short = short.withColumn("stem", F.array_join(F.transform("parts", lambda x: F.substring(F.replace(x, F.lit("."), F.lit("")), 1, 2)), " "))
    begun = (
        short.join(hint(f.withColumn("stem", stems("fkey"))), "stem")
        .where(
            F.forall(
                F.zip_with("parts", F.split("fkey", " "), lambda a, b: F.when(a.endswith("."), b.startswith(F.regexp_replace(a, r"\.", ""))).otherwise(a == b)),
                lambda ok: F.coalesce(ok, F.lit(False)),
            )
        )
        .select("text", "ref_key", F.lit(3).alias("cost"))
    )
    typed = (
        close_pairs(keys, forms, hint)
        .groupBy("nkey", "ref_key")
        .agg(F.min(F.col("dist") * 10 + F.col("lev")).alias("cost"))
    )
    typed = names.select("text", "nkey").join(typed, "nkey").select("text", "ref_key", (F.col("cost") + 10).alias("cost"))
    found = reduce(DataFrame.unionAll, [exact, turned, shaped, begun, typed])
    best = (
        found.groupBy("text", "ref_key")
        .agg(F.min("cost").alias("cost"))
        .groupBy("text")
        .agg(F.min(F.struct("cost", "ref_key")).alias("b"), F.sort_array(F.collect_list("cost")).alias("costs"))
        # two keys equally close: nobody can say which is meant
        .where((F.size("costs") == 1) | (F.element_at("costs", 1) < F.try_element_at("costs", F.lit(2))))
        .select("text", F.col("b.ref_key").alias("ref_key"), F.when(F.col("b.cost") < 10, "form").otherwise("close").alias("how"))
    )
    none = names.select("text").join(best.select("text"), "text", "left_anti")
    return best.unionAll(none.select("text", F.lit(UNMATCHED), F.lit("none"))).withColumnRenamed("text", text)


def analyte_forms(ref: DataFrame) -> DataFrame:
    return reference_forms(ref, "canonical_key", [F.array("canonical_key", "label_fr", "label_en"), F.col("aliases")])


def deciding_text() -> Column:
    return F.when(~blank(F.col("name")), F.col("name")).when(~blank(F.col("canonical_name")), F.col("canonical_name"))


def exact_forms(ref: DataFrame) -> DataFrame:
    return ref.select(F.explode(F.array_compact(F.concat(F.array("canonical_key", "label_fr", "label_en"), F.col("aliases")))).alias("_t")).distinct()


def map_rows(lines: DataFrame, ref: DataFrame) -> DataFrame:
    """Every line with ref_key: the entry meant, UNMATCHED, or null where there is no text to decide by."""
    rows = lines.withColumn("_t", deciding_text())
    m = match_values(rows, "_t", analyte_forms(ref))
    return rows.join(m.select("_t", "ref_key"), "_t", "left").drop("_t")


def p3_found(lines: DataFrame, ref: DataFrame) -> DataFrame:
    """Rows whose deciding text isn't, letter by letter, a form of the list, with the key meant or UNMATCHED."""
    rows = lines.select("line_id", deciding_text().alias("_t")).where("_t is not null")
    rows = rows.join(F.broadcast(exact_forms(ref)) if ref.count() <= BROADCAST_FORMS else exact_forms(ref), "_t", "left_anti")
    m = match_values(rows, "_t", analyte_forms(ref))
    return rows.join(m, "_t").select("line_id", F.col("ref_key").alias("canonical_key"))
