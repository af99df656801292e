"""Text to structure: decoding, scores, document type, dates, sections. All column expressions.

Null texts give null scores and no sections; empty texts score zero and are `unknown`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: How much of a text the scores look at, and how many of its lines, unless told otherwise (fixed values
#: of the behaviour matched; None is the whole text).
SAMPLE_CHARS, SAMPLE_LINES = 18_000, 500

# Vocabularies of the scores.
MORPHO_CONTEXT = (
    "compte rendu d'imagerie", "compte-rendu d'imagerie", "compte rendu d'examen", "tomodensitom", "tomodensitomet", " tomodensitométrie", " irm ", " irl ", " tdm ",
    "scanner", "échographie", "echographie", "fibroscan", " mammographie", "tep-", "tep ", "tep/", "recist", "compte rendu anatomopathologique", "anatomopathologie",
)
LAB_STRONG = (
    "nfs", "hémogramme", "hemogram", "numération", "numeration", "formule leucocytaire", "ionogramme", "bilan lipidique", "bilan hépatique", "bilan hepatique", "bilan rénal",
    "bilan renal", "bilan ionique", "bilan complet", "hémostase", "hemostase", "cytométrie", "cytometrie", "hormonologie", "immunologie",
)
LAB_MEDIUM = ("laboratoire", "biologie médicale", "biologie medicale", "prélèvement le", "prelevement le", "tube sec", "tube edta")
LAB_WEAK_WORDS = ("crp", "ast", "alt")
LAB_WEAK_PARTS = ("plaquette", "bilirubine", "bilirubin", "créatinine", "creatinine")
LAB_ROW_PARTS = ("plaquette", "creatinine", "créatinine", "hb ", "hémoglobine")
IMAGING_PARTS = (
    ("compte rendu de scanner", 0.28), ("compte rendu de tomodensitom", 0.28), ("compte rendu d'irm", 0.22), ("compte-rendu de scanner", 0.28), ("abdomen", 0.08), ("pelvien", 0.08),
    ("injection", 0.05), ("contraste", 0.05), ("reconstruction", 0.06), ("mm coronal", 0.07), ("mm sagittal", 0.07),
)
VALUE_UNIT = r"(?iu)\d+(?:[.,]\d+)?\s*(g/l|mg/l|u/l|µmol/l|umol/l|ui/l|mmol/l|%)\b"
PATHOLOGY_STRONG = (
    r"\b(?:biopsie|biopsies|lame\(s\)?|coloration|immunohistochimi\w*|ihc\b|gleason|anatomopatholog\w*|histolog\w*|cytoponction|cytologie\s+asc|reseau\s+nestin|who\s+20\d\d)\b"
)
PATHOLOGY_CONTEXT = r"\b(?:compte\s+rendu\s+anatomopatholog\w*|rapport\s+d['’]?\s*anatomopatholog\w*|examen\s+anatomopatholog\w*)\b"
LETTER = (
    r"\b(?:antécédents?|antecedents?|comorbidit|comorbidités|traitement\s+en\s+cours|cher\s+confrère|cher\s+consoeur|cordialement|votre\s+patiente?|médecin\s+traitant|medecin\s+traitant)\b"
)
LAB_HEADINGS = ("hématologie", "hematologie", "hemostase", "hémostase", "biochimie", "hormonologie", "cytologie", "immunologie")
GENERIC_HEADINGS = ("antécédents", "antecedents", "comorbidités", "comorbidites", "traitement", "traitements", "conclusion", "imagerie", "examen clinique", "plan", "impression")


def _any(c: Column, parts: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(p) for p in parts])


def _points(c: Column, parts: Sequence[str], each: int) -> Column:
    return reduce(lambda a, b: a + b, [c.contains(p).cast("int") * each for p in parts])


def mime_type(path: Column) -> Column:
    """MIME type by extension; unknown ones are octet-stream."""
    p = F.lower(path)
    known = {"pdf": "application/pdf", "txt": "text/plain", "md": "text/markdown", "json": "application/json", "csv": "text/csv"}
    return reduce(lambda acc, kv: F.when(p.endswith("." + kv[0]), kv[1]).otherwise(acc), reversed(list(known.items())), F.lit("application/octet-stream"))


def is_pdf(mime: Column, path: Column) -> Column:
    return F.coalesce(F.lower(mime).contains("pdf"), F.lit(False)) | F.coalesce(F.lower(path).endswith(".pdf"), F.lit(False))


def decode_text(content: Column) -> Column:
    """Bytes to text; what isn't UTF-8 becomes U+FFFD and never fails the task."""
    return F.make_valid_utf8(content.cast("string"))


def sample(text: Column, chars: int | None = SAMPLE_CHARS) -> Column:
    return text if chars is None else F.substring(text, 1, chars)


def sample_lower(text: Column, chars: int | None = SAMPLE_CHARS) -> Column:
    return F.lower(sample(text, chars))


def lab_score(text: Column, chars: int | None = SAMPLE_CHARS) -> Column:
    """Points that speak for a laboratory panel."""
    s = sample_lower(text, chars)
    weak = _points(s, LAB_WEAK_PARTS, 1) + reduce(lambda a, b: a + b, [s.rlike(rf"(?U)\b{w}\b").cast("int") for w in LAB_WEAK_WORDS])
    has_value = s.rlike(VALUE_UNIT)
    row = _any(s, LAB_ROW_PARTS) | s.rlike(r"(?U)\b(?:ast|alt|crp)\b")
    return (
        _points(s, LAB_STRONG, 3) + _points(s, LAB_MEDIUM, 2) + F.when(s.rlike(r"(?U)\bbiologie\b"), 2).otherwise(0) + F.least(weak, F.lit(3))
        + F.when(has_value, 2).otherwise(0) + F.when(has_value & row, 2).otherwise(0)
    )


def morpho_context(text: Column, chars: int | None = SAMPLE_CHARS) -> Column:
    return _any(sample_lower(text, chars), MORPHO_CONTEXT)


def probable_lab(text: Column, chars: int | None = SAMPLE_CHARS) -> Column:
    return (F.trim(text) != "") & (lab_score(text, chars) >= F.when(morpho_context(text, chars), 6).otherwise(4))


def line_stats(text: Column, most: int | None = SAMPLE_LINES) -> Column:
    """Struct of the first non-blank lines: number, share of table rows, share with value and unit, mean length."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    lines = lines if most is None else F.slice(lines, 1, most)
    n = F.size(lines)

    def share(test) -> Column:
        return F.coalesce(F.try_divide(F.size(F.filter(lines, test)).cast("double"), n), F.lit(0.0))

    pipes = lambda x: F.length(x) - F.length(F.replace(x, F.lit("|"), F.lit(""))) >= 2
    length = F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + F.length(F.trim(x)))
    return F.struct(
        n.alias("n_lines"), share(pipes).alias("pipe_ratio"), share(lambda x: x.rlike(VALUE_UNIT)).alias("value_unit_ratio"),
        F.coalesce(F.try_divide(length.cast("double"), n), F.lit(0.0)).alias("mean_length"),
    )


def classify(docs: DataFrame, text: str = "text", sections: str | None = None, n_tables: Column | None = None, n_headings: Column | None = None,
             chars: int | None = SAMPLE_CHARS, most: int | None = SAMPLE_LINES) -> DataFrame:
    """docs with `type_scores` (struct of four) and `document_type`.

    Scores blend vocabulary and line structure; imaging context dampens the laboratory score,
    pathology context the imaging one; a weak or narrow winner is `unknown`. chars and most bound what is
    looked at; None is the whole text and all lines.
    """
    t = F.col(text)
    low = sample_lower(t, chars)
    tables, heads = n_tables if n_tables is not None else F.lit(0), n_headings if n_headings is not None else F.lit(0)
    df = docs.withColumn("_s", line_stats(F.coalesce(F.col(sections), sample(t, chars)) if sections else sample(t, chars), most))
    p, v = F.col("_s.pipe_ratio"), F.col("_s.value_unit_ratio")
    one = F.lit(1.0)
    lab_struct = F.least(one, 0.42 * p + 0.38 * F.least(one, v * 12.0) + 0.12 * F.least(one, tables / 5.0) + 0.08 * v)
    df = df.withColumn("_ctx", morpho_context(t, chars)).withColumn("_lab", 0.52 * F.least(one, lab_score(t, chars) / 6.25) + 0.35 * lab_struct + 0.13 * F.least(one, (p + v) / 1.2))
    bonus = F.least(one, reduce(lambda a, b: a + b, [F.when(low.contains(w), x).otherwise(0.0) for w, x in IMAGING_PARTS]))
    narrative = F.least(one, 0.28 * F.least(one, F.col("_s.mean_length") / 95.0) + 0.32 * (1.0 - p) + 0.22 * F.least(one, heads / 5.0) + 0.18 * F.least(one, F.col("_s.n_lines") / 80.0))
    base = F.when(F.col("_ctx"), 0.86).otherwise(F.least(one, 0.22 + bonus))
    df = df.withColumn("_img", F.least(one, base * (0.62 + 0.38 * narrative)))
    df = df.withColumn("_pc", F.when(low.rlike("(?U)" + PATHOLOGY_CONTEXT), 0.75).otherwise(0.0)).withColumn("_ps", F.least(one, 0.28 * F.regexp_count(low, F.lit("(?U)" + PATHOLOGY_STRONG))))
    df = df.withColumn("_path", F.least(one, F.greatest(F.col("_pc"), F.col("_ps") * 1.15, 0.55 * (F.col("_pc") + F.col("_ps")))))
    df = df.withColumn("_letter", F.least(one, 0.38 * F.regexp_count(low, F.lit("(?U)" + LETTER))))
    df = df.withColumn("_lab", F.when(F.col("_ctx"), F.col("_lab") * F.when(F.col("_lab") < 0.58, 0.38).otherwise(0.82)).otherwise(F.col("_lab")))
    tie = (F.greatest("_pc", "_ps") >= 0.42) & (F.col("_path") >= F.col("_img") - 0.14) & (F.col("_lab") < 0.62)
    df = df.withColumn("_img", F.when(F.col("_pc") >= 0.7, F.col("_img") * 0.52).when(tie, F.col("_img") * 0.72).otherwise(F.col("_img")))
    named = (("lab_blood_panel", "_lab"), ("imaging_report", "_img"), ("pathology_report", "_path"), ("clinical_letter", "_letter"))
    df = df.withColumn("type_scores", F.struct(*[F.round(c, 4).alias(n) for n, c in named]))
    ranked = F.sort_array(F.array(*[F.struct(F.col("type_scores")[n].alias("v"), F.lit(-i).alias("o"), F.lit(n).alias("t")) for i, (n, _) in enumerate(named)]), asc=False)
    best, second = ranked[0], ranked[1]
    df = df.withColumn("document_type", F.when(t.isNull() | (best["v"] < 0.33) | (best["v"] - second["v"] < 0.055), "unknown").otherwise(best["t"]))
    return df.drop("_s", "_ctx", "_lab", "_img", "_pc", "_ps", "_path", "_letter")


def route(hint: Column, classified: Column) -> Column:
    """The parser's hint unless it knows nothing."""
    return F.when(~F.coalesce(hint, F.lit("unknown")).isin("unknown", ""), hint).otherwise(classified)


# Fixed patterns, most telling first; the order of day, month and year of each.
DATE_PATTERNS = (
    (r"(?i)prélev[ée]?\s+le\s+([0-9]{2})/([0-9]{2})/([0-9]{2,4})", (3, 2, 1)),
    (r"(?i)prélèvement\s+du\s+([0-9]{2})/([0-9]{2})/([0-9]{2,4})", (3, 2, 1)),
    (r"(?i)edit[ée]?\s+le\s+([0-9]{2})/([0-9]{2})/([0-9]{2,4})", (3, 2, 1)),
    (r"(?i)date\s+de\s+l[’']examen\s*[:\-]?\s*([0-9]{2})/([0-9]{2})/([0-9]{2,4})", (3, 2, 1)),
    (r"\b([0-9]{4})[-/]([0-9]{2})[-/]([0-9]{2})\b", (1, 2, 3)),
    (r"\b([0-9]{2})/([0-9]{2})/([0-9]{4})\b", (3, 2, 1)),
    (r"\b([0-9]{2})/([0-9]{2})/([0-9]{2})\b", (3, 2, 1)),
)


def document_date(text: Column) -> Column:
    """The first valid date, the most telling pattern first; two-digit years below 70 are of this century."""
    def one(pattern: str, order: tuple[int, int, int]) -> Column:
        y, m, d = (F.regexp_extract(text, pattern, i) for i in order)
        n = y.try_cast("int")
        year = F.when(n >= 100, n).when(n < 70, n + 2000).otherwise(n + 1900)
        return F.when(y != "", F.try_to_date(F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), m, d), "yyyy-MM-dd"))

    return F.coalesce(*[one(p, o) for p, o in DATE_PATTERNS])


def clean_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, r"\s+", " "))


def is_noise(line: Column) -> Column:
    s = clean_line(line)
    return (s == "") | s.rlike(r"(?i)^page\s+[0-9]+\b") | s.rlike(r"(?i)^--\s*[0-9]+\s+of\s+[0-9]+\s*--$") | s.rlike(r"(?i)^labo .*tel[:\s]")


def is_heading(line: Column, document_type: Column) -> Column:
    s = clean_line(line)
    low = F.lower(s)
    vocab = F.when(document_type == "lab_blood_panel", _any(low, LAB_HEADINGS)).otherwise(_any(low, GENERIC_HEADINGS))
    return (s != "") & (F.length(s) <= 90) & (F.coalesce(vocab, F.lit(False)) | s.rlike(r"^[A-ZÀ-Ÿ0-9 /()\-]{4,}$"))


def lines_of(docs: DataFrame, key: str, text: str, *keep: str) -> DataFrame:
    """One row per line: key, line_ord, line, kept columns."""
    return docs.select(key, *keep, F.posexplode(F.split(F.col(text), "\r?\n")).alias("line_ord", "line"))


def segment(docs: DataFrame, key: str, text: str, document_type: str) -> DataFrame:
    """(key, section_ord, heading, body): lines gathered under the last heading above them.

    Every line belongs to one running count of headings, so a document is one window partition.
    """
    lines = lines_of(docs, key, text, document_type).where(~is_noise(F.col("line"))).withColumn("h", is_heading(F.col("line"), F.col(document_type)))
    w = Window.partitionBy(key).orderBy("line_ord")
    lines = lines.withColumn("section_ord", F.sum(F.col("h").cast("int")).over(w))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("h"), F.struct("line_ord", clean_line(F.col("line")).alias("l"))))), lambda x: x["l"]), "\n")
    heading = F.max(F.when(F.col("h"), F.trim(F.regexp_replace(clean_line(F.col("line")), ":", ""))))
    return lines.groupBy(key, "section_ord").agg(heading.alias("heading"), body.alias("body"))


def markdown_sections(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, section_ord, heading, body): text cut at second- and deeper-level Markdown headings."""
    parts = docs.select(key, F.posexplode(F.split(F.col(text), r"\n(?:##+\s+)")).alias("section_ord", "part"))
    first_line = F.substring_index("part", "\n", 1)
    headed = F.col("section_ord") > 0
    return parts.select(
        key, "section_ord", F.when(headed, F.trim(first_line)).alias("heading"),
        F.trim(F.when(headed, F.expr("substring(part, length(substring_index(part, '\n', 1)) + 2)")).otherwise(F.col("part"))).alias("body"),
    ).where("heading is not null or body <> ''")


def section_kind(section_ord: Column, heading: Column, body: Column) -> Column:
    """`admin_section` for a short first section with an institution's name or a radiology stamp."""
    t = F.concat_ws(" ", heading, body)
    low = F.lower(t)
    stamp = (F.length(t) <= 120) & low.contains("service") & low.contains("radiologie")
    who = low.rlike(r"(?U)\b(?:hôpital|hopital|chu|clinique|centre hospitalier|ap-hp|institut|laboratoire)\b")
    return F.when((section_ord == 0) & (F.length(t) <= 280) & (who | stamp), "admin_section").otherwise("clinical_section")


def clean_body(body: Column) -> Column:
    """A section's text with white space collapsed and noise lines dropped."""
    return F.array_join(F.filter(F.transform(F.split(body, "\r?\n"), clean_line), lambda x: ~is_noise(x)), "\n")


def choose_sections(segments: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """(key, section_ord, heading, body, source): a parser's own sections where they hold, else the segmenter's.

    existing(key, section_ord, heading, body, source): layout sections (source `layout...`) are kept if any has
    text after cleaning, others if at least two of several do.
    """
    cleaned = existing.withColumn("body", clean_body(F.col("body")))
    full = F.trim("body") != ""
    n = cleaned.groupBy(key).agg(F.count("*").alias("n"), F.count_if(full).alias("m"), F.bool_or(F.col("source").startswith("layout")).alias("layout"))
    kept = n.where("(layout and m >= 1) or (n > 1 and m >= 2)").select(key)
    own = cleaned.where(full).join(kept, key, "left_semi").select(key, "section_ord", "heading", "body", "source")
    rest = segments.join(kept, key, "left_anti").select(key, "section_ord", "heading", "body", F.lit("segmenter").alias("source"))
    return own.unionByName(rest)


def joined_bodies(sections: DataFrame, key: str, sep: str = "\n\n") -> DataFrame:
    """(key, full_text): the bodies with text, in order, joined."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("section_ord", F.trim("body").alias("b")))), lambda x: x["b"])
    return sections.where(F.trim("body") != "").groupBy(key).agg(F.array_join(parts, sep).alias("full_text"))


def layout_sections(items: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(sections, counters) of layout items(key, ord, label, text).

    Titles and section headers begin a section; tables come as their Markdown, pictures without text as a
    comment; page headers and footers go aside; a section without text drops its heading. counters: per
    document the tables, texts, pictures and headings, and the texts put aside.
    """
    w = Window.partitionBy(key).orderBy("ord")
    t = F.trim("text")
    head = F.col("label").isin("title", "section_header")
    aside = F.col("label").isin("page_header", "page_footer")
    shown = F.when(F.col("label") == "picture", F.coalesce(F.nullif(t, F.lit("")), F.lit("<!-- figure -->"))).otherwise(t)
    x = items.withColumn("section_ord", F.sum(head.cast("int")).over(w))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~head & ~aside & (shown != ""), F.struct("ord", shown.alias("t"))))), lambda y: y["t"]), "\n\n")
    sections = x.groupBy(key, "section_ord").agg(F.max(F.when(head & (t != ""), t)).alias("heading"), body.alias("body")).where("body <> ''").withColumn("source", F.lit("layout_graph"))
    label = F.col("label")
    counters = items.groupBy(key).agg(
        F.count_if((label == "table") & (t != "")).alias("n_tables"), F.count_if(label.isin("text", "list_item") & (t != "")).alias("n_texts"), F.count_if(label == "picture").alias("n_pictures"), F.count_if(head).alias("n_headings"),
        F.count_if(aside & (t != "")).alias("n_aside"),
    )
    return sections, counters


def layout_or_markdown(graph: DataFrame, markdown: DataFrame, whole: DataFrame, key: str) -> DataFrame:
    """Graph sections, unless there are fewer than two and the Markdown split gives more; without either the whole text."""
    g, m = graph.groupBy(key).agg(F.count("*").alias("g")), markdown.groupBy(key).agg(F.count("*").alias("m"))
    n = whole.select(key).join(g, key, "left").join(m, key, "left").select(key, F.coalesce("g", F.lit(0)).alias("g"), F.coalesce("m", F.lit(0)).alias("m"))
    by_md = n.where("g < 2 and m > g").select(key)
    by_text = n.where("g = 0 and m = 0").select(key)
    cols = [key, "section_ord", "heading", "body", "source"]
    a = graph.join(by_md, key, "left_anti").select(*cols)
    b = markdown.join(by_md, key, "left_semi").withColumn("source", F.lit("layout_markdown")).select(*cols)
    c = whole.join(by_text, key, "left_semi").select(key, F.lit(0).alias("section_ord"), F.lit(None).cast("string").alias("heading"), F.col("full_text").alias("body"), F.lit("full_text").alias("source"))
    return a.unionByName(b).unionByName(c.where("trim(body) <> ''"))


def smart_route(docs: DataFrame, text: str = "full_text", mime: str = "mime_type", path: str = "source_path", hint: str | None = None) -> DataFrame:
    """docs with is_pdf, probable_lab, document_type (the hint unless it knows nothing) and chunking_strategy.

    Only PDF documents get a strategy: `lab_rows` for a probable panel, `imaging_full` for an imaging report,
    else `sections`; texts are chunked by paragraphs.
    """
    df = classify(docs, text).drop("type_scores").withColumn("is_pdf", is_pdf(F.col(mime), F.col(path))).withColumn("probable_lab", F.coalesce(probable_lab(F.col(text)), F.lit(False)))
    if hint:
        df = df.withColumn("document_type", route(F.col(hint), F.col("document_type")))
    strategy = F.when(~F.col("is_pdf"), None).when(F.col("probable_lab"), "lab_rows").when(F.col("document_type") == "imaging_report", "imaging_full").otherwise("sections")
    return df.withColumn("chunking_strategy", strategy)
