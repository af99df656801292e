"""Problem 4: quantities recorded in different units, brought to the common unit of their analyte.

Pure Spark SQL: number and unit are taken from fields or text by regular expressions, unit spellings
are normalised by an equality join with an alias table, the unit is coalesced from the unit field, the
unit in the value text, the unit in the longer text and the analyte's default, then factor and shift
of the reference table apply.

Edge cases: null, blank, `-`, `?`, `n/a` and `NA` units count as not stated; a bound keeps its sign in
`bound`; a row without number or without known analyte keeps null results; an unknown unit keeps
`unit_code` null; empty tables give no rows; repeated rows keep one output row each; extra columns are kept.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.functions.text import fold
from formloom.session import bounded, cut

#: Blanks used between thousands and before units.
BLANKS = " \u00a0\u202f\u2009"
NUMBER = rf"(?:\d{{1,3}}(?:[{BLANKS}]\d{{3}})+|\d+)(?:[.,]\d+)?"
#: The same with the letters scanning puts for digits (fixed values: O 0, l 1, Z 2, S 5, B 8).
DIGITS_LIKE, DIGITS = "OlZSB", "01258"
SCANNED = rf"(?-i:(?=[OlZSB.,]*\d)[\dOlZSB]{{1,3}}(?:[{BLANKS}][\dOlZSB]{{3}})+(?:[.,][\dOlZSB]+)?|(?=[OlZSB.,]*\d)[\dOlZSB]+(?:[.,][\dOlZSB]+)?)"
#: How units are written in running text, longest spellings first (fixed pattern).
UNIT_TEXT = (
    r"(?:x\s?)?10\s?[\^*]\s?\d+\s?/\s?(?:mm[3³]|l)"
    r"|(?:cell(?:ules?|s)?|[ée]l[ée]ments)?\s?/\s?mm[3³]|par\s+mm[3³]"
    r"|mm\s+premi[èe]re\s+heure|mm\s?/\s?1?h\b"
    r"|(?:giga|t[ée]ra|milli(?:grammes?|mol)|micro(?:g|mol|kat)|nano(?:g|mol|kat)|pico(?:g|mol)|grammes?|mcg|gr"
    r"|[munpkµμ]?(?:mol|kat|ui|iu|g|u)|t|l)\s?(?:/\s?(?:100\s?ml|litre|d?m?l|mol|cellule)|\.(?:d|m)?l-1)"
    r"|mg\s?%|pour\s+cent|p\.\s?cent|%|ratio"
    r"|[mnpµμ]M(?![A-Za-z])|millim[èe]tres?|centim[èe]tres?|d[ée]cim[èe]tres?|millim\.|centim\.|d[ée]cim\.|[mcd]m(?![a-z0-9])\.?"
    r"|fl|[µμu]m[3³]|pg|picog|secondes|sec|s"
)
PAIR = rf"(?<![\w.,])({SCANNED})[{BLANKS}\t]?({UNIT_TEXT})(?![\w³/^])"

_PAIR_NUMBER = f"(?i)^{SCANNED}(?=[{BLANKS}\t]?(?:{UNIT_TEXT})$)"


#: Spellings and what they become, in this order (fixed values).
SPELLINGS = (
    (r"^(?:x)?10[\^*](\d+)/", "10^$1/"),
    (r"^(?:cell(?:ules?|s)?|elements|par)/?mm3$", "/mm3"),
    (r"milligrammes?", "mg"), (r"grammes?", "g"), (r"^gr([/.])", "g$1"),
    (r"millim(?:etres?|\.)$", "mm"), (r"centim(?:etres?|\.)$", "cm"), (r"decim(?:etres?|\.)$", "dm"),
    (r"^([mcd]m)\.$", "$1"),
    (r"^milli(mol)", "m$1"), (r"^(?:micro|mc)(mol|kat|g)", "u$1"), (r"^nano(mol|kat|g)", "n$1"), (r"^pico(mol|g)", "p$1"),
    (r"^giga", "g"), (r"^tera", "t"), (r"litre$", "l"), (r"\.([dm]?l)-1$", "/$1"), (r"/100ml$", "/dl"), (r"^mg%$", "mg/dl"),
    (r"^([munk]?)(?:ui|iu)/", "$1u/"),
    (r"^(?:pourcent|p\.cent)$", "%"), (r"^(?:ratio|1)$", "1"), (r"^sec(?:ondes)?$", "s"), (r"^um3$", "fl"), (r"^pg/cellule$", "pg"),
    (r"^mm(?:/1?h|premiereheure)$", "mm/h"),
)


def _double(c: Column) -> Column:
    return F.replace(F.regexp_replace(c, f"[{BLANKS}]", ""), F.lit(","), F.lit(".")).try_cast("double")


def number_of(c: Column) -> Column:
    """First number in a text; blanks between thousands and decimal commas understood."""
    return _double(F.regexp_extract(c, f"({NUMBER})", 1))


def bound_of(c: Column) -> Column:
    t = F.lower(F.trim(c))
    return (
        F.when(t.rlike(r"^(?:<=|≤)"), "<=").when(t.rlike(r"^(?:>=|≥)"), ">=").when(t.rlike(r"^(?:<|inf)"), "<").when(t.rlike(r"^(?:>|sup)"), ">")
    )


def unit_key(c: Column) -> Column:
    """One spelling for all spellings of a unit; case only decides between molar M and metre m."""
    raw = F.trim(F.regexp_replace(c, f"[{BLANKS}]", " "))
    molar = F.when(raw.rlike(r"^[mnpµμ]M$"), F.concat(F.translate(F.substring(raw, 1, 1), "µμ", "uu"), F.lit("mol/l")))
    plain = F.replace(fold(F.replace(raw, F.lit("³"), F.lit("3"))), F.lit(" "), F.lit(""))
    k = F.regexp_replace(plain, r"\s+", "")
    for a, b in SPELLINGS:
        k = F.regexp_replace(k, a, b)
    # most units are spelled as the rules would leave them: no pattern is tried on these
    return F.coalesce(molar, F.when(plain.isin(*_settled()), plain).otherwise(k))


def _settled() -> list[str]:
    """The known spellings that the rules leave as they are."""
    def ruled(k: str) -> str:
        for a, b in SPELLINGS:
            k = re.sub(a, b.replace("$", "\\"), k)
        return k

    return [k for k, _, _ in _aliases() if ruled(k) == k]


def stated(c: Column) -> Column:
    """The unit field where it says something."""
    t = F.trim(F.regexp_replace(c, f"[{BLANKS}]", " "))
    return F.when(~F.lower(t).isin("", "-", "?", "n/a", "na", "--", "."), t)


def _aliases() -> list[tuple[str, str, float]]:
    prefix = {"": 1.0, "k": 1e3, "m": 1e-3, "u": 1e-6, "n": 1e-9, "p": 1e-12}
    volume = {"l": 1.0, "dl": 1e-1, "ml": 1e-3}
    rows = [
        (f"{p}{base}/{v}", base, ps / vs)
        for base in ("g", "mol", "u", "kat")
        for p, ps in prefix.items()
        for v, vs in volume.items()
    ]
    rows += [(f"10^{e}/{v}", "count", float(f"1e{e}") * f) for e in (3, 6, 9, 12) for v, f in (("l", 1.0), ("mm3", 1e6))]
    rows += [("g/l", "count", 1e9), ("t/l", "count", 1e12), ("/mm3", "count", 1e6)]
    rows += [("mm", "m", 1e-3), ("cm", "m", 1e-2), ("dm", "m", 1e-1)]
    return rows + [("%", "%", 1.0), ("l/l", "%", 100.0), ("1", "1", 1.0), ("mmol/mol", "mmol/mol", 1.0), ("pg", "pg", 1.0), ("fl", "fl", 1.0), ("s", "s", 1.0), ("mm/h", "mm/h", 1.0)]


def alias_table(spark: SparkSession) -> DataFrame:
    """(ukey, dim, size): what each normalised spelling measures. Built by rule from prefixes and volumes."""
    return spark.createDataFrame(_aliases(), "ukey string, dim string, size double")


def unit_sizes(unit_ref: DataFrame) -> DataFrame:
    """unit_ref with what each entry measures: (canonical_key, unit_code, is_common, factor, shift, dim, size).

    Where a code reads two ways (g/L: mass or 10^9 cells), the case of the entry's own code decides.
    """
    a = alias_table(unit_ref.sparkSession)
    u = unit_ref.withColumn("ukey", unit_key(F.col("unit_code"))).join(F.broadcast(a), "ukey")  # a: built above, under 100 rows
    return u.where(~((F.col("ukey") == "g/l") & ((F.col("dim") == "count") != F.col("unit_code").startswith("G")))).drop("ukey")


def text_unit(text: Column, number: Column, by_number_only: bool) -> Column:
    """The unit that follows `number` in a text; else, if allowed, the unit of the first number that has one."""
    # the long pattern runs once; number and unit are told apart in the short matches
    hits = F.regexp_extract_all(text, F.lit(f"(?i){PAIR}"), F.lit(0))
    split = F.transform(hits, lambda x: F.struct(F.regexp_extract(x, _PAIR_NUMBER, 0).alias("n"), x.alias("x")))
    pairs = F.transform(split, lambda p: F.struct(_double(F.translate(p["n"], DIGITS_LIKE, DIGITS)).alias("n"), F.regexp_replace(F.substr(p["x"], F.length(p["n"]) + 1), f"^[{BLANKS}\t]", "").alias("u")))

    def choose(found: Column) -> Column:
        hit = F.try_element_at(F.filter(found, lambda p: F.abs(p["n"] - number) <= F.abs(number) * 1e-9), F.lit(1))["u"]
        return hit if by_number_only else F.coalesce(hit, F.try_element_at(found, F.lit(1))["u"])

    return F.element_at(F.transform(F.array(pairs), choose), 1)  # a lambda's variable is computed once


def with_units(rows: DataFrame, key: str, number: str, unit: str, unit_ref: DataFrame) -> DataFrame:
    """Adds unit_code, is_common, same_as_common, common_value and common_unit to rows.

    unit: stated unit text or null. A null unit takes the analyte's common one as default (`unit_from`).
    """
    sizes = cut(unit_sizes(unit_ref), "unit-sizes")  # read by three lookups
    a = alias_table(rows.sparkSession)
    common = sizes.where("is_common").select(F.col("canonical_key").alias("_ck"), F.col("unit_code").alias("common_unit"))
    # several codes of one key may have one size: the common one first, then by name
    ranked = (
        sizes.groupBy("canonical_key", "dim", "size")
        .agg(F.min(F.struct((~F.col("is_common")).alias("o"), "unit_code", "factor", "shift")).alias("e"))
        .select(F.col("canonical_key").alias("_rk"), "dim", "size", F.col("e.unit_code").alias("unit_code"), F.col("e.factor").alias("_f"), F.col("e.shift").alias("_h"))
    )
    # sizes compared exactly would miss 1e-9/1e-3 against 1e-6: compare by rounded logarithm instead
    log = lambda c: F.round(F.log10(c), 6)
    spelled = (
        ranked.withColumn("_l", log(F.col("size")))
        .join(F.broadcast(a.select(F.col("ukey").alias("_ru"), F.col("dim").alias("_d2"), log(F.col("size")).alias("_l2"))), (F.col("dim") == F.col("_d2")) & (F.col("_l") == F.col("_l2")))
        .groupBy("_rk", "_ru")
        .agg(F.min(F.struct(F.col("unit_code"), F.col("_f"), F.col("_h"))).alias("e"))
        .select("_rk", "_ru", F.col("e.unit_code").alias("unit_code"), F.col("e._f").alias("_f"), F.col("e._h").alias("_h"))
    )
    n = F.col(number)
    return (
        rows.withColumn("_u", unit_key(F.col(unit)))
        # both sides: a fixed reference of a few hundred rows
        .join(bounded(spelled), (F.col(key) == F.col("_rk")) & (F.col("_u") == F.col("_ru")), "left")
        .join(F.broadcast(common), F.col(key) == F.col("_ck"), "left")
        .withColumn("same_as_common", F.col("unit_code") == F.col("common_unit"))
        .withColumn("unit_from", F.when(F.col("unit_code").isNotNull(), "stated").when(F.col(unit).isNull() & F.col("common_unit").isNotNull(), "default"))
        .withColumn("common_value", F.when(F.col("unit_code").isNotNull(), n * F.col("_f") + F.col("_h")).when(F.col("unit_from") == "default", n))
        .drop("_u", "_rk", "_ru", "_ck", "_f", "_h")
    )


def name_part(raw: Column) -> Column:
    """What stands before the value in a printed line."""
    return F.trim(F.regexp_extract(raw, r"^\s*+\|?\s*+((?:[^\n\t|:=.]|\.(?!\.\.))*+)", 1))


def lab_quantities(lines: DataFrame, unit_ref: DataFrame, key: str = "analyte") -> DataFrame:
    """lab_lines (with their analyte in `key`) -> number, bound, stated unit and value in the common unit."""
    v, raw = F.col("value"), F.col("raw_text")
    rest = F.coalesce(F.expr("substring(raw_text, length(_lead) + 1)"), raw)
    df = (
        lines.withColumn("_lead", F.regexp_extract(raw, r"^\s*+\|?(?:[^\n\t|:=.]|\.(?!\.\.))*+(?:\.{3,}|[\n\t|:=])", 0))
        .withColumn("number", F.coalesce(v["n"], number_of(v["s"])))
        .withColumn("bound", bound_of(v["s"]))
    )
    df = df.withColumn(
        "unit_text",
        F.coalesce(stated(F.col("unit")), text_unit(v["s"], F.col("number"), False), F.when(F.col("number").isNotNull(), text_unit(rest, F.col("number"), False))),
    ).drop("_lead")
    return with_units(df, key, "number", "unit_text", unit_ref)


def observation_quantities(obs: DataFrame, unit_ref: DataFrame) -> DataFrame:
    """observations -> number, bound, stated unit and value in the common unit."""
    v = F.col("normalized_value")
    df = obs.withColumn("number", F.coalesce(v["n"], number_of(F.col("raw_value")))).withColumn("bound", bound_of(F.col("raw_value")))
    df = df.withColumn(
        "unit_text",
        F.coalesce(stated(F.col("unit")), text_unit(F.col("raw_value"), F.col("number"), False), text_unit(F.col("evidence_text"), F.col("number"), True)),
    )
    return with_units(df, "canonical_key", "number", "unit_text", unit_ref)


def p4_found(lines: DataFrame, observations: DataFrame, unit_ref: DataFrame) -> DataFrame:
    """(record_kind, record_id, unit_code): records whose stated unit is neither the common one nor equal to it in size."""
    a = lab_quantities(lines, unit_ref).select(F.lit("lab_line").alias("record_kind"), F.col("line_id").cast("string").alias("record_id"), "unit_code", "number", "same_as_common")
    o = observation_quantities(observations, unit_ref).select(F.lit("observation").alias("record_kind"), F.col("observation_id").alias("record_id"), "unit_code", "number", "same_as_common")
    return a.unionAll(o).where("number is not null and unit_code is not null and not same_as_common").select("record_kind", "record_id", "unit_code").distinct()
