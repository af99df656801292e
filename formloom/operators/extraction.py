"""Schema-driven extraction: jobs, laboratory values, keywords, lesion sizes and response codes.

Null texts yield nothing; the first match of a text counts where the rule says so; ties follow the
order columns given. Everything is column expressions over exploded, broadcast dimensions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formloom.functions.text import fold
from formloom.session import bounded, cut

# Analyte patterns, units and families; name aliases.
ANALYTES = (
    ("AST", r"\bAST\b\s*[:=]?\s*([0-9]+(?:[.,][0-9]+)?)", "U/L", "hepatic_biochemistry"),
    ("ALT", r"\bALT\b\s*[:=]?\s*([0-9]+(?:[.,][0-9]+)?)", "U/L", "hepatic_biochemistry"),
    ("Total_bilirubine", r"\b(?:bilirubine\s+totale|total\s+bilirubin)\b\s*[:=]?\s*([0-9]+(?:[.,][0-9]+)?)", "µmol/L", "hepatic_biochemistry"),
    ("PLT", r"\b(?:plt|plaquettes)\b\s*[:=]?\s*([0-9]+(?:[.,][0-9]+)?)", "G/L", "hematology"),
    ("AFP", r"\bAFP\b\s*[:=]?\s*([0-9]+(?:[.,][0-9]+)?)", None, "inflammation_biomarkers"),
    ("CRP", r"\bCRP\b\s*[:=]?\s*([0-9]+(?:[.,][0-9]+)?)", "mg/L", "inflammation_biomarkers"),
    ("INR", r"\bINR\b\s*[:=]?\s*([0-9]+(?:[.,][0-9]+)?)", None, "coagulation"),
)
ALIASES = {
    "ast": "AST", "asat": "AST", "transaminase asat s g o t": "AST", "alt": "ALT", "alat": "ALT", "transaminase alat s g p t": "ALT",
    "bilirubine totale": "Total_bilirubine", "total bilirubin": "Total_bilirubine", "plaquettes": "PLT", "plt": "PLT", "crp": "CRP", "crp 3eme generation": "CRP",
    "inr": "INR", "afp": "AFP", "alpha foetoproteine": "AFP",
}
SECTION_FAMILY = {"hematologie": "hematology", "hemostase": "coagulation", "biochimie": "hepatic_biochemistry"}
NEGATIONS = (r"\bpas\s+de\b", r"\baucune?\b", r"\bsans\b", r"\babsence\s+de\b", r"\bno\b")
STRATEGY_OF_FAMILY = {"lab_values": "lab_deterministic", "imaging_recist": "imaging_langextract", "narrative_clinical": "narrative_keywords"}


def strategy_of(explicit: Column, family: Column) -> Column:
    by = F.lit("none")
    for k, v in STRATEGY_OF_FAMILY.items():
        by = F.when(family == k, v).otherwise(by)
    return F.coalesce(explicit, by)


# Classes of an imaging model and the keys they fill.
CLASS_KEYS = {"lesion_size_mm": "Size_major_nodule_mm", "recist_response": "RECIST_response", "lesion_description": "lesion_description", "imaging_conclusion": "imaging_conclusion"}
KEYWORDS = {"Cirrhosis": ("cirrhose", "cirrhosis")}


def class_of(explicit: Column | None, key: Column, strategy: Column) -> Column:
    """The imaging class of a field: its own, else the one that fills its key; none for other strategies."""
    by = F.lit(None).cast("string")
    for c, k in reversed(CLASS_KEYS.items()):
        by = F.when(key == k, c).otherwise(by)
    by = F.when(strategy == "imaging_langextract", by)
    return by if explicit is None else F.coalesce(explicit, by)


def plan_jobs(fields: DataFrame, document_types: list[str] | None = None, skip: DataFrame | None = None) -> DataFrame:
    """One job per document type, strategy and family, with its sorted keys, fields and imaging classes; skipped columns go first.

    A job that asks for the response also asks for the conclusion it can be derived from.
    """
    f = fields.join(skip.select("target_column"), "target_column", "left_anti") if skip is not None else fields
    f = f.withColumn("strategy", strategy_of(F.col("extraction_strategy"), F.col("extraction_family"))).where("strategy <> 'none'")
    own = F.col("langextract_class") if "langextract_class" in fields.columns else None
    f = f.withColumn("_class", class_of(own, F.col("canonical_key"), F.col("strategy"))).withColumn("document_type", F.explode("document_types_allowed"))
    if document_types is not None:
        f = f.where(F.col("document_type").isin(document_types))
    asks = F.coalesce(F.bool_or((F.col("canonical_key") == "RECIST_response") & (F.col("strategy") == "imaging_langextract")), F.lit(False))
    jobs = f.groupBy("document_type", "strategy", "field_family").agg(
        F.array_sort(F.collect_set("canonical_key")).alias("_keys"), F.array_sort(F.collect_set("field_name")).alias("_names"), F.collect_set("_class").alias("_classes"), asks.alias("derive_recist"),
    )
    more = F.when(F.col("strategy") == "imaging_langextract", F.concat(
        F.array_compact(F.array(*[F.when(F.array_contains("_keys", k), F.lit(c)) for c, k in CLASS_KEYS.items()])), F.when(F.col("derive_recist"), F.array(F.lit("imaging_conclusion"))).otherwise(F.array().cast("array<string>"))
    )).otherwise(F.array().cast("array<string>"))
    classes = F.array_sort(F.array_distinct(F.concat("_classes", more)))
    return jobs.select("document_type", "strategy", "field_family", F.array_join("_keys", ",").alias("canonical_keys"), F.array_join("_names", ",").alias("field_names"), F.array_join(classes, ",").alias("classes"), "derive_recist")


def families_of(jobs: DataFrame) -> DataFrame:
    """(document_type, field_family), each once."""
    return jobs.select("document_type", "field_family").distinct()


def lab_values(chunks: DataFrame, text: str = "text") -> DataFrame:
    """chunks with one row per analyte found: canonical_key, value, unit (of the analyte), field_family, confidence."""
    hits = []
    for key, pattern, unit, family in ANALYTES:
        raw = F.regexp_extract(F.col(text), "(?iU)" + pattern, 1)
        hits.append(F.when(raw != "", F.struct(F.lit(key).alias("canonical_key"), F.replace(raw, F.lit(","), F.lit(".")).try_cast("double").alias("value"), F.lit(unit).cast("string").alias("unit"), F.lit(family).alias("field_family"))))
    return chunks.withColumn("_h", F.explode(F.array_compact(F.array(*hits)))).select(*chunks.columns, "_h.*", F.lit(0.82).alias("confidence"))


def name_key(name: Column) -> Column:
    return F.trim(F.regexp_replace(fold(name, greek=False), "[^a-z0-9]+", " "))


def canonical_key_of(name: Column) -> Column:
    """The schema's key for a printed analyte name, or null."""
    k = name_key(name)
    toks = F.split(k, " ")
    out = F.when(F.array_contains(toks, "asat"), "AST").when(F.array_contains(toks, "alat"), "ALT")
    for a, v in ALIASES.items():
        out = F.when(k == a, v).otherwise(out)
    return out


def lab_family(key: Column, section: Column) -> Column:
    out = F.lit("inflammation_biomarkers")
    s = name_key(section)
    for k, v in SECTION_FAMILY.items():
        out = F.when(s == k, v).otherwise(out)
    for k, _, _, fam in ANALYTES:
        out = F.when(key == k, fam).otherwise(out)
    return out


def line_observations(lines: DataFrame, chunks: DataFrame) -> DataFrame:
    """Every lab line as an observation, with the first chunk of its document that holds its text.

    Of a chunk indexed again the latest text counts. The chunks of a document are gathered once, so the
    lines are joined once and choose their chunk inside their own row.
    """
    latest = chunks.groupBy("chunk_id").agg(F.max_by(F.struct("document_id", "chunk_ord", "text"), F.struct("indexed_at", "document_id", "chunk_ord")).alias("r")).select("chunk_id", "r.*")
    held = latest.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("chunk_ord", "chunk_id", "text"))).alias("_chunks"))
    raw = F.col("raw_text")
    first = F.try_element_at(F.filter("_chunks", lambda c: F.contains(c["text"], raw)), F.lit(1))["chunk_id"]
    key = canonical_key_of(F.col("name"))
    return lines.join(held, "document_id", "left").select(
        "line_id", "document_id", key.alias("canonical_key"), lab_family(key, F.col("section")).alias("field_family"), "value", "unit", "confidence", first.alias("source_chunk_id")
    )


def narrative(docs: DataFrame, key: str, text: str, canonical_key: str, keywords: list[str], negations: tuple[str, ...] = NEGATIONS) -> DataFrame:
    """(key, canonical_key, evidence): the first line with a keyword that no negation stands before."""
    lines = docs.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("line_ord", "line"))
    low = F.lower(F.col("line"))
    found = F.lit(False)
    for k in keywords:
        at = F.locate(k.lower(), low)
        before = F.substr(low, F.lit(1), at - 1)
        found = found | ((at > 0) & ~before.rlike("(?U)" + "|".join(negations)))
    return lines.where(found).groupBy(key).agg(F.min_by(F.trim("line"), "line_ord").alias("evidence")).select(key, F.lit(canonical_key).alias("canonical_key"), F.lit(True).alias("value"), F.lit(0.8).alias("confidence"), "evidence")


# --- imaging ----------------------------------------------------------------------------------------
# Units, cues and phrases.
SIZE = r"([0-9]+(?:[.,][0-9]+)?)\s*(mm|millim[eè]tres?|cm|centim[eè]tres?)\b"
CONCLUSION = r"(?:(?:^|\n)\s*conclusion\b|(?:^|\n)\s*au total\b|bilan de fin d['’][eé]valuation|cat[eé]gorie recist retenue|selon recist\s*1(?:[.,]1)?)"
BASELINE_BEFORE = r"(?is)(?:scanner initial|bilan d['’]inclusion|au d[eé]marrage du traitement|r[eé]f[eé]rence j0|j0\s*/\s*d0|inclusion).{0,140}?([0-9]+(?:[.,][0-9]+)?)\s*(mm|millim[eè]tres?|cm|centim[eè]tres?)"
BASELINE_AFTER = r"(?is)([0-9]+(?:[.,][0-9]+)?)\s*(mm|millim[eè]tres?|cm|centim[eè]tres?).{0,90}?(?:scanner initial|bilan d['’]inclusion)"
NOT_TARGET = r"(?iu)non[\s-]cible|non retenu|l[eé]sion nouvelle|apparition d['’]une"
CURRENT = r"(?iu)examen actuel|contr[oô]le du jour|ne pas confondre"
BASELINE = r"(?iu)\b(?:j0|d0)\b|inclusion|scanner initial|d[eé]marrage du traitement|bilan d['’]inclusion|r[eé]f[eé]rence"
NOT_EVALUABLE = ("non évaluable", "non evaluable", "ne peuvent pas être appliqués", "ne peuvent pas etre appliques", "critères recist ne peuvent pas", "criteres recist ne peuvent pas", "non évalu")
STABLE = ("stabilité", "stabilite", "stable", "stabile", "sans progression", "absence de progression", "maladie stabilisée", "maladie stabilisee")


def size_mm(number: Column, unit: Column) -> Column:
    n = F.replace(number, F.lit(","), F.lit(".")).try_cast("double")
    return F.when(F.lower(unit).startswith("c"), n * 10).otherwise(n)


def first_size_mm(text: Column) -> Column:
    """The first size with a unit in a text, in millimetres."""
    p = "(?i)" + SIZE
    return size_mm(F.nullif(F.regexp_extract(text, p, 1), F.lit("")), F.regexp_extract(text, p, 2))


def size_confidence(sentence: Column) -> Column:
    return F.when(sentence.rlike(NOT_TARGET), 0.40).when(sentence.rlike(CURRENT), 0.55).when(sentence.rlike(BASELINE), 0.93).otherwise(0.82)


def baseline_size_mm(text: Column) -> Column:
    """The size that stands near a baseline cue, in millimetres."""
    one = lambda p: size_mm(F.nullif(F.regexp_extract(text, p, 1), F.lit("")), F.regexp_extract(text, p, 2))
    return F.coalesce(*[one(p.replace("(?is)", "(?isu)")) for p in (BASELINE_BEFORE, BASELINE_AFTER)])  # É as é


def lesion_sizes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, sentence_ord, sentence, value_mm, confidence) of every sentence with a size."""
    s = docs.select(key, F.posexplode(F.split(F.col(text), r"(?<=[!?\n])|(?<=\.)(?![0-9])")).alias("sentence_ord", "sentence"))
    mm = first_size_mm(F.col("sentence"))
    return s.select(key, "sentence_ord", F.trim("sentence").alias("sentence"), mm.alias("value_mm"), size_confidence(F.col("sentence")).alias("confidence")).where("value_mm is not null")


def conclusion_of(text: Column) -> Column:
    """The text from its last conclusion heading on, or null."""
    rest = F.regexp_extract(text, rf"(?isu)^.*({CONCLUSION}.*)\z", 1)
    return F.when(rest != "", rest)


def recist_code(text: Column) -> Column:
    """CR, PR, SD, PD or NE; else the start of the text; blank gives null."""
    t = F.trim(text)
    low = F.lower(t)
    has = lambda *xs: F.coalesce(reduce(lambda a, b: a | b, [low.contains(x) for x in xs]), F.lit(False))
    codes = F.regexp_extract_all(t, F.lit(r"(?iU)\b(CR|PR|SD|PD|NE)\b"), F.lit(1))
    return (
        F.when(t.isNull() | (t == ""), None)
        .when(has(*NOT_EVALUABLE), "NE")
        .when(F.size(codes) > 0, F.upper(F.try_element_at(codes, F.lit(-1))))
        .when(has("complète", "complete"), "CR")
        .when(has("partielle", "partial"), "PR")
        .when(has(*STABLE), "SD")
        .when(has("progression", "progressive"), "PD")
        .otherwise(F.substring(t, 1, 64))
    )


def conclusion_recist(text: Column) -> Column:
    """The response code of the conclusion, if it is one of the five."""
    c = recist_code(conclusion_of(text))
    return F.when(c.isin("CR", "PR", "SD", "PD", "NE"), c)


def dedup_observations(obs: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order (a hash aggregate, no sort)."""
    first = F.min_by(F.struct(*[F.col(c) for c in obs.columns]), F.struct(*order))
    return obs.groupBy(*[F.col(b).alias(f"_k{i}") for i, b in enumerate(by)]).agg(first.alias("r")).select("r.*")


# --- running jobs -----------------------------------------------------------------------------------------
OBSERVATION = (
    "document_id string, chunk_id string, field_family string, canonical_key string, raw_value string, value struct<kind:string,s:string,n:double,b:boolean>, unit string, confidence double, "
    "evidence_text string, extraction_method string, retrieval_score double, ord long"
)
IMAGING_METHOD, FALLBACK_METHOD, LAB_METHOD, ROWS_METHOD, KEYWORD_METHOD = "imaging_model", "imaging_source_fallback", "lab_deterministic", "lab_document_rows", "narrative_keywords"


def tagged(kind: str, c: Column) -> Column:
    """c as a tagged value."""
    return F.struct(
        F.lit(kind).alias("kind"), (c if kind == "s" else F.lit(None)).cast("string").alias("s"), (c if kind == "n" else F.lit(None)).cast("double").alias("n"), (c if kind == "b" else F.lit(None)).cast("boolean").alias("b")
    )


def _keys_of(jobs: DataFrame, strategy: str) -> DataFrame:
    return jobs.where(F.col("strategy") == strategy).select("document_type", "field_family", F.split("canonical_keys", ",").alias("_keys"), "derive_recist")


def lab_strategy(hits: DataFrame, jobs: DataFrame) -> DataFrame:
    """Laboratory values of the hit chunks, for the keys their job asks for; of its own family, unless that is comorbidities."""
    j = hits.join(bounded(_keys_of(jobs, "lab_deterministic")), ["document_type", "field_family"])
    v = lab_values(j.withColumnRenamed("field_family", "_family"), "text").where(F.array_contains("_keys", F.col("canonical_key")))
    v = v.where("field_family = _family or _family = 'comorbidities'")
    return v.select("document_id", "chunk_id", F.col("_family").alias("field_family"), "canonical_key", F.col("value").cast("string").alias("raw_value"), tagged("n", F.col("value")).alias("value"), "unit", "confidence", F.col("text").alias("evidence_text"), F.lit(LAB_METHOD).alias("extraction_method"), "retrieval_score", "ord")


def narrative_strategy(hits: DataFrame, jobs: DataFrame, specs: dict[str, tuple[str, ...]] = KEYWORDS) -> DataFrame:
    """Keys of the job whose words stand in a hit chunk without a negation before them, with the first such line."""
    j = hits.join(bounded(_keys_of(jobs, "narrative_keywords")), ["document_type", "field_family"])
    parts = []
    for key, words in specs.items():
        line = F.trim(F.try_element_at(F.filter(F.split("text", "\n"), _tells(words)), F.lit(1)))
        parts.append(j.where(F.array_contains("_keys", F.lit(key))).withColumn("_line", line).where("_line is not null").select(
            "document_id", "chunk_id", "field_family", F.lit(key).alias("canonical_key"), F.col("_line").alias("raw_value"), tagged("b", F.lit(True)).alias("value"), F.lit(None).cast("string").alias("unit"), F.lit(0.8).alias("confidence"),
            F.col("_line").alias("evidence_text"), F.lit(KEYWORD_METHOD).alias("extraction_method"), "retrieval_score", "ord",
        ))
    return reduce(DataFrame.unionByName, parts)


def _tells(words: tuple[str, ...]):
    """Whether a line holds one of the words without a negation before it."""
    def told(line: Column) -> Column:
        low = F.lower(line)
        hit = F.lit(False)
        for w in words:
            at = F.locate(w.lower(), low)
            hit = hit | ((at > 0) & ~F.substr(low, F.lit(1), at - 1).rlike("(?U)" + "|".join(NEGATIONS)))
        return hit

    return told


EXTRACTED = "class string, text string, start int, end int, attributes map<string,string>"


def flatten_extractions(result) -> list[dict]:
    """A model's answer, however nested (lists, documents with `extractions`), as one list of extractions."""
    out: list[dict] = []
    if result is None:
        return out
    if isinstance(result, dict):
        if "class" in result:
            return [result]
        return flatten_extractions(result.get("extractions"))
    for x in result:
        out += flatten_extractions(x)
    return out


def run_model(hits: DataFrame, extract_fn) -> DataFrame:
    """hits with one row per extraction (class, extracted, start, end, attributes) of extract_fn(text); a failing text gives none.

    extract_fn runs in Arrow batches on the executors; whatever it holds (a client, a model) is made once per worker.
    """
    import pandas as pd

    cols = [c for c in hits.columns if c != "text"]

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                try:
                    found = flatten_extractions(extract_fn(r["text"])) if r["text"] and str(r["text"]).strip() else []
                except ImportError:
                    raise  # a missing package is no failing text
                except Exception:
                    found = []
                for n, x in enumerate(found):
                    rows.append({**r, "n": n, "class": x.get("class"), "extracted": (x.get("text") or "").strip(), "start": x.get("start"), "end": x.get("end"), "attributes": {str(k): str(v) for k, v in (x.get("attributes") or {}).items()}})
            out = pd.DataFrame(rows, columns=[*cols, "text", "n", "class", "extracted", "start", "end", "attributes"])
            for c in ("start", "end"):
                out[c] = out[c].astype("Int64")
            yield out

    schema = ", ".join(f"{c} {t}" for c, t in hits.select(*cols).dtypes) + ", text string, n int, class string, extracted string, start int, end int, attributes map<string,string>"
    return hits.select(*cols, "text").mapInPandas(run, schema)


def sentence_around(text: Column, start: Column, end: Column) -> Column:
    """The sentence of a text that holds a span."""
    before = F.substr(text, F.lit(1), start)
    lo = F.length(F.regexp_extract(before, r"(?s)^(.*[.!?\n])?", 0))
    after = F.substr(text, end + 1)
    hi = end + F.length(F.regexp_extract(after, r"(?s)^[^.!?\n]*[.!?\n]?", 0))
    return F.trim(F.substr(text, lo + 1, hi - lo), F.lit(" \t\r\n"))


def attribute_mm(text: Column, attributes: Column) -> Column:
    """A size in millimetres: number and unit in the text, else the attributes value_mm or value_cm, else value with unit, else a bare number."""
    num = lambda c: F.replace(c, F.lit(","), F.lit(".")).try_cast("double")
    a = lambda k: F.try_element_at(attributes, F.lit(k))
    value = num(a("value"))
    bare = num(F.nullif(F.regexp_extract(text, r"([0-9]+(?:[.,][0-9]+)?)", 1), F.lit("")))
    return F.coalesce(first_size_mm(text), num(a("value_mm")), num(a("value_cm")) * 10, F.when(F.lower(a("unit")).startswith("c"), value * 10).otherwise(value), F.when(F.lower(a("unit")).startswith("c"), bare * 10).otherwise(bare))


def grounded(extracted: DataFrame, require_grounding: bool = True, allowed: list[str] | None = None) -> DataFrame:
    """Extractions as observations: sizes, responses, descriptions and conclusions of known classes.

    Without a place in the text an extraction is dropped, where grounding is required. A response before the
    last conclusion heading is dropped, one within it is trusted more.
    """
    key = F.lit(None).cast("string")
    for c, k in CLASS_KEYS.items():
        key = F.when(F.col("class") == c, k).otherwise(key)
    df = extracted.withColumn("canonical_key", key).where("canonical_key is not null and extracted <> ''")
    if allowed:
        df = df.where(F.col("canonical_key").isin(allowed))
    placed = F.col("start").isNotNull()
    if require_grounding:
        df = df.where(placed)
    heading = F.length("text") - F.length(conclusion_of(F.col("text")))
    inside = F.when(heading.isNull(), None).otherwise(F.coalesce(F.col("start") >= heading, F.lit(False)))
    mm = attribute_mm(F.col("extracted"), F.col("attributes"))
    code = recist_code(F.col("extracted"))
    category = F.upper(F.trim(F.try_element_at("attributes", F.lit("category"))))
    code = F.when(code.isin("CR", "PR", "SD", "PD", "NE"), code).when(category.isin("CR", "PR", "SD", "PD", "NE"), category)
    base = F.when(placed, 0.82).otherwise(0.55)
    around = F.when(placed, sentence_around(F.col("text"), F.col("start"), F.coalesce("end", "start"))).otherwise(F.col("extracted"))
    size, response = F.col("class") == "lesion_size_mm", F.col("class") == "recist_response"
    value = F.when(size, tagged("n", mm)).when(response, tagged("s", code)).otherwise(tagged("s", F.col("extracted")))
    confidence = F.when(size, size_confidence(around)).when(response, F.when(inside, 0.93).otherwise(base)).otherwise(F.least(base, F.lit(0.75)))
    df = df.withColumns({"value": value, "confidence": confidence, "_inside": inside}).where("(class <> 'lesion_size_mm' or value.n is not null) and (class <> 'recist_response' or (value.s is not null and coalesce(_inside, true)))")
    return df.withColumns({"unit": F.when(size, "mm"), "in_conclusion": F.coalesce("_inside", F.lit(False))}).drop("_inside")


def derived_response(found: DataFrame, key: list[str]) -> DataFrame:
    """The response a text's conclusions give, the last one that gives a code, for texts whose conclusion has none of its own."""
    has = found.where("class = 'recist_response' and in_conclusion").select(*key).distinct()
    code = recist_code(F.col("extracted"))
    c = found.where("class = 'imaging_conclusion'").withColumn("_code", code).where(F.col("_code").isin("CR", "PR", "SD", "PD", "NE")).join(has, key, "left_anti")
    last = F.max_by(F.struct("_code", "extracted", "in_conclusion"), F.col("n"))
    d = c.groupBy(*key).agg(last.alias("r"))
    return d.select(*key, F.lit("RECIST_response").alias("canonical_key"), F.col("r.extracted").alias("extracted"), tagged("s", F.col("r._code")).alias("value"), F.when(F.col("r.in_conclusion"), 0.93).otherwise(0.72).alias("confidence"))


def source_fallbacks(hits: DataFrame, jobs: DataFrame) -> DataFrame:
    """What the imaging text itself says of baseline size and response, by column expressions only."""
    j = hits.join(bounded(_keys_of(jobs, "imaging_langextract")), ["document_type", "field_family"])
    t = F.col("text")
    mm, code = baseline_size_mm(t), conclusion_recist(t)
    size = F.when(F.array_contains("_keys", F.lit("Size_major_nodule_mm")) & mm.isNotNull(), F.struct(F.lit("Size_major_nodule_mm").alias("k"), mm.cast("string").alias("raw"), tagged("n", mm).alias("v"), F.lit("mm").alias("u")))
    resp = F.when(F.col("derive_recist") & code.isNotNull(), F.struct(F.lit("RECIST_response").alias("k"), F.substring(F.trim(conclusion_of(t)), 1, 240).alias("raw"), tagged("s", code).alias("v"), F.lit(None).cast("string").alias("u")))
    x = j.withColumn("_x", F.explode(F.array_compact(F.array(size, resp))))
    return x.select(
        "document_id", "chunk_id", "field_family", F.col("_x.k").alias("canonical_key"), F.col("_x.raw").alias("raw_value"), F.col("_x.v").alias("value"), F.col("_x.u").alias("unit"), F.lit(0.94).alias("confidence"), F.col("_x.raw").alias("evidence_text"),
        F.lit(FALLBACK_METHOD).alias("extraction_method"), "retrieval_score", "ord",
    )


def imaging_strategy(hits: DataFrame, jobs: DataFrame, extract_fn=None) -> DataFrame:
    """Observations of an injected model, if there is one, and of the source itself where the model left something out."""
    own = source_fallbacks(hits, jobs)
    if extract_fn is None:
        return own
    keys = _keys_of(jobs, "imaging_langextract")
    j = hits.join(bounded(keys), ["document_type", "field_family"])
    found = cut(grounded(run_model(j, extract_fn)).where(F.array_contains("_keys", F.col("canonical_key")) | F.col("derive_recist") & (F.col("class") == "imaging_conclusion")), "model")
    cols = ["document_id", "chunk_id", "field_family", "canonical_key", F.col("extracted").alias("raw_value"), "value", "unit", "confidence", F.col("extracted").alias("evidence_text"), F.lit(IMAGING_METHOD).alias("extraction_method"), "retrieval_score", "ord"]
    key = ["document_id", "chunk_id", "field_family", "retrieval_score", "ord"]
    derived = derived_response(found.where("derive_recist"), key).withColumn("unit", F.lit(None).cast("string"))
    model = found.where(F.array_contains("_keys", F.col("canonical_key"))).select(*cols).unionByName(derived.select(*cols))
    sure = model.where("(canonical_key = 'Size_major_nodule_mm' and confidence >= 0.93) or (canonical_key = 'RECIST_response' and confidence >= 0.93)").select("document_id", "chunk_id", "canonical_key").distinct()
    return model.unionByName(own.join(sure, ["document_id", "chunk_id", "canonical_key"], "left_anti"))


#: What reads the hits of each strategy; a strategy without entry is an error.
STRATEGIES = {"lab_deterministic": lab_strategy, "narrative_keywords": narrative_strategy, "imaging_langextract": imaging_strategy}


def extract_all(hits: DataFrame, jobs: DataFrame, extract_fn=None, strategies: dict = STRATEGIES) -> DataFrame:
    """All observations of the hit chunks(document_id, document_type, field_family, chunk_id, text, retrieval_score, ord).

    Blank texts are skipped; of observations of one family with one key and one evidence the first stays;
    keys that words give are no part of that rule's key, as in one document one line speaks for one of them.
    """
    names = [r[0] for r in jobs.select("strategy").distinct().collect()]  # a handful
    unknown = [n for n in names if n not in strategies]
    if unknown:
        raise ValueError(f"no extractor for {unknown}")
    h = hits.where(F.trim("text") != "")
    parts = [strategies[n](h, jobs, extract_fn) if n == "imaging_langextract" else strategies[n](h, jobs) for n in sorted(names)]
    every = reduce(DataFrame.unionByName, parts)
    rule = F.when(F.col("extraction_method") == KEYWORD_METHOD, F.lit(None)).otherwise(F.col("canonical_key"))
    return dedup_observations(every.withColumn("_rule", rule), ["document_id", "field_family", "_rule", "evidence_text", "extraction_method"], ["ord", "chunk_id", "canonical_key"]).drop("_rule")


def rows_as_observations(lines: DataFrame, chunks: DataFrame) -> DataFrame:
    """Every reconstructed row as an observation, without a retrieval gate, with the first chunk that holds it."""
    held = chunks.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("chunk_ord", "chunk_id", "text"))).alias("_c"))
    raw = F.col("raw_text")
    chunk = F.try_element_at(F.filter("_c", lambda c: F.contains(c["text"], raw)), F.lit(1))["chunk_id"]
    key = canonical_key_of(F.col("name"))
    v = F.col("value")
    return lines.join(held, "document_id", "left").select(
        "document_id", chunk.alias("chunk_id"), lab_family(key, F.col("section")).alias("field_family"), key.alias("canonical_key"), F.coalesce(v["s"], v["n"].cast("string"), v["b"].cast("string")).alias("raw_value"), "value", "unit", "confidence",
        raw.alias("evidence_text"), F.lit(ROWS_METHOD).alias("extraction_method"), F.lit(None).cast("double").alias("retrieval_score"), F.col("ord").cast("long").alias("ord"),
    )


def lab_override(observations: DataFrame, rows: DataFrame, panels: DataFrame) -> DataFrame:
    """Observations in which the reconstructed rows of panels(document_id) replace their values read by pattern."""
    with_rows = rows.join(panels.select("document_id"), "document_id", "left_semi")
    gone = with_rows.select("document_id").distinct().withColumn("extraction_method", F.lit(LAB_METHOD))
    return observations.join(gone, ["document_id", "extraction_method"], "left_anti").unionByName(with_rows)
