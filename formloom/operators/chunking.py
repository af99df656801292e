"""Texts into chunks with verified offsets.

Null and blank texts give no chunks; equal paragraphs of one document share an id by content, so an
upsert keeps one of them; offsets are null where the text can't be found again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Family keywords, in the order that decides ties.
FAMILY_KEYWORDS = (
    ("hematology", ("hb", "hémoglobine", "hemoglobine", "ht", "hématocrite", "hematocrite", "leucocyte", "plaquette", "plt", "nfs", "gb")),
    ("coagulation", ("inr", "tp", "tca", "fibrinogène", "fibrinogene", "d-dimère", "ddimer")),
    ("hepatic_biochemistry", ("ast", "alt", "ggt", "pal", "bilirubin", "bilirubine", "albumine", "dfh")),
    ("inflammation_biomarkers", ("crp", "vs", "vsp", "pcr", "afp", "ca19", "ca 19")),
)
IMAGING_CHARS = 12_000


def chunk_id(prefix: Column, text: Column) -> Column:
    return F.concat(F.lit("chk_"), F.substring(F.sha2(F.concat(prefix, F.lit(":"), text), 256), 1, 16))


def family_of(text: Column) -> Column:
    """The family with most keyword hits; ties go to the first; none is null."""
    low = F.lower(text)
    hits = [reduce(lambda a, b: a + b, [low.contains(k).cast("int") for k in ks]) for _, ks in FAMILY_KEYWORDS]
    best = F.greatest(*hits)
    out = F.lit(None).cast("string")
    for (name, _), h in reversed(list(zip(FAMILY_KEYWORDS, hits))):
        out = F.when((h == best) & (h > 0), name).otherwise(out)
    return out


def paragraphs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, chunk_ord, chunk_id, text, field_family, char_start, char_end).

    Parts are blank-line paragraphs, or lines where there is only one. Offsets come from one fold over
    the parts that searches each from the end of the one before.
    """
    t = F.col(text)
    trimmed = lambda a: F.filter(F.transform(a, lambda x: F.trim(x, F.lit(" \t\r\n"))), lambda x: x != "")
    paras = trimmed(F.split(t, r"\n\s*\n+"))
    df = docs.where(t.isNotNull() & (F.trim(t, F.lit(" \t\r\n")) != "")).withColumn("_parts", F.when(F.size(paras) <= 1, trimmed(F.split(t, "\n"))).otherwise(paras))
    spans = F.expr(
        f"aggregate(_parts, struct(0 as at, cast(array() as array<struct<a:int,b:int>>) as out), "
        f"(acc, p) -> struct(if(locate(p, `{text}`, acc.at + 1) > 0, locate(p, `{text}`, acc.at + 1) - 1 + length(p), acc.at) as at, "
        f"array_append(acc.out, struct(cast(if(locate(p, `{text}`, acc.at + 1) > 0, locate(p, `{text}`, acc.at + 1) - 1, null) as int) as a, "
        f"cast(if(locate(p, `{text}`, acc.at + 1) > 0, locate(p, `{text}`, acc.at + 1) - 1 + length(p), null) as int) as b)) as out), acc -> acc.out)"
    )
    df = df.withColumn("_spans", spans).select(key, F.posexplode(F.arrays_zip("_parts", "_spans")).alias("chunk_ord", "z"))
    return df.select(
        key, "chunk_ord", chunk_id(F.col(key).cast("string"), F.col("z._parts")).alias("chunk_id"), F.col("z._parts").alias("text"), family_of(F.col("z._parts")).alias("field_family"),
        F.col("z._spans.a").alias("char_start"), F.col("z._spans.b").alias("char_end"),
    )


def _packed(limit: int) -> Column:
    """Parts of column `_t` of at most `limit` characters: paragraphs, else lines, packed one after the other; a longer line stays whole."""

    def fold(parts: str, sep: str) -> str:
        return (
            f"aggregate({parts}, cast(array() as array<string>), (acc, p) -> if(size(acc) > 0 and length(element_at(acc, -1)) + length(p) + {len(sep)} <= {limit}, "
            f"array_append(slice(acc, 1, size(acc) - 1), concat(element_at(acc, -1), '{sep}', p)), array_append(acc, p)))"
        )

    def parts(of: str, pattern: str) -> str:
        return f"filter(transform(split({of}, '{pattern}'), y -> trim(BOTH '\t\r\n ' FROM y)), y -> y <> '')"

    lines = fold(parts("x", "\n"), "\n")
    return F.expr(f"flatten(transform({fold(parts('_t', chr(92) * 2 + 'n' + chr(92) * 2 + 's*' + chr(92) * 2 + 'n+'), chr(10) * 2)}, x -> if(length(x) <= {limit}, array(x), {lines})))")


def pack_oversized(docs: DataFrame, key: str, text: str, limit: int = IMAGING_CHARS) -> DataFrame:
    """(key, part_ord, part) of every text, split only above the limit."""
    df = docs.where(F.col(text).isNotNull()).select(key, F.col(text).alias("_t"))
    return df.select(key, F.posexplode(F.when(F.length("_t") <= limit, F.array("_t")).otherwise(_packed(limit))).alias("part_ord", "part"))


def lab_row_chunks(lines: DataFrame, key: str = "document_id") -> DataFrame:
    """(key, chunk_ord, chunk_id, text, section, subsection): lab lines gathered by section, in first-seen order."""
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "line_id", "raw_text"))), lambda x: x["raw_text"]), "\n")
    g = lines.where("raw_text is not null").groupBy(key, "section", "subsection").agg(F.min(F.struct("ord", "line_id")).alias("first"), rows.alias("text"))
    w = Window.partitionBy(key).orderBy("first")
    g = g.withColumn("chunk_ord", F.row_number().over(w) - 1)
    return g.select(key, "chunk_ord", chunk_id(F.concat(F.col(key), F.lit(":lab_rows:"), F.col("chunk_ord").cast("string")), F.col("text")).alias("chunk_id"), "text", "section", "subsection")


def section_spans(sections: DataFrame, docs: DataFrame, key: str, full: str) -> DataFrame:
    """Sections with offsets in the joined text, kept only where the text there is the section's."""
    w = Window.partitionBy(key).orderBy("section_ord").rowsBetween(Window.unboundedPreceding, -1)
    s = sections.where("body <> ''").withColumn("_at", F.coalesce(F.sum(F.length("body") + 2).over(w), F.lit(0)))
    j = s.join(docs.select(key, F.col(full).alias("_full")), key)
    ok = F.expr("substring(_full, cast(_at as int) + 1, length(body)) = body")
    return j.select(key, "section_ord", "heading", "body", F.when(ok, F.col("_at")).alias("char_start"), F.when(ok, F.col("_at") + F.length("body")).alias("char_end"), ok.alias("verified"))


def passage(heading: Column, body: Column) -> Column:
    """What is indexed of a section: heading and body, blank ones left out."""
    h, b = F.trim(heading), F.trim(body)
    return F.concat_ws("\n", F.when(h != "", h), F.when(b != "", b))


def _spans_in(parts: str, text: str) -> str:
    """SQL of [(start, end), ...] of parts in a text, each searched from the end of the one before; null where it isn't found."""
    at = f"locate(p, {text}, acc.at + 1)"
    return (
        f"aggregate({parts}, struct(0 as at, cast(array() as array<struct<a:int,b:int>>) as out), (acc, p) -> struct(if({at} > 0, {at} - 1 + length(p), acc.at) as at, "
        f"array_append(acc.out, struct(cast(if({at} > 0, {at} - 1, null) as int) as a, cast(if({at} > 0, {at} - 1 + length(p), null) as int) as b)) as out), acc -> acc.out)"
    )


_CHUNK = ("chunk_ord", "chunk_id", "text", "field_family", "char_start", "char_end", "chunker", "heading", "content_kind", "verified")


def imaging_chunks(docs: DataFrame, key: str, text: str, limit: int = IMAGING_CHARS) -> DataFrame:
    """Whole trimmed reports, split only above the limit, with their places in the trimmed text; all of the imaging family."""
    df = docs.select(key, F.trim(F.col(text), F.lit(" \t\r\n")).alias("_t")).where("_t <> ''")
    df = df.withColumn("_parts", F.when(F.length("_t") <= limit, F.array("_t")).otherwise(_packed(limit))).withColumn("_spans", F.expr(_spans_in("_parts", "_t")))
    df = df.select(key, F.posexplode(F.arrays_zip("_parts", "_spans")).alias("chunk_ord", "z"))
    part = F.col("z._parts")
    return df.select(
        key, "chunk_ord", chunk_id(F.concat(F.col(key).cast("string"), F.lit(":imaging:"), F.col("chunk_ord").cast("string")), part).alias("chunk_id"), part.alias("text"), F.lit("imaging_recist").alias("field_family"),
        F.col("z._spans.a").alias("char_start"), F.col("z._spans.b").alias("char_end"), F.lit("imaging").alias("chunker"), F.lit(None).cast("string").alias("heading"), F.lit("imaging_report").alias("content_kind"), F.col("z._spans.a").isNotNull().alias("verified"),
    )


def section_chunks(sections: DataFrame, docs: DataFrame, key: str, full: str, limit: int = IMAGING_CHARS) -> DataFrame:
    """Every section, in parts of at most `limit`, with places in the full text that are kept only where the text there is the part's.

    A document without sections but with text is one chunk.
    """
    w = Window.partitionBy(key).orderBy("section_ord").rowsBetween(Window.unboundedPreceding, -1)
    s = sections.select(key, "section_ord", "heading", F.trim("body").alias("_t")).where("_t <> ''")
    s = s.withColumn("_base", F.coalesce(F.sum(F.length("_t") + 2).over(w), F.lit(0)).cast("int"))
    s = s.withColumn("_parts", F.when(F.length("_t") <= limit, F.array("_t")).otherwise(_packed(limit))).withColumn("_spans", F.expr(_spans_in("_parts", "_t")))
    s = s.select(key, "section_ord", "heading", "_base", F.posexplode(F.arrays_zip("_parts", "_spans")).alias("part", "z"))
    j = s.join(docs.select(key, F.col(full).alias("_full")), key)
    text, start = F.col("z._parts"), F.col("_base") + F.col("z._spans.a")
    ok = F.coalesce(F.substr(F.col("_full"), start + 1, F.length(text)) == text, F.lit(False))
    order = Window.partitionBy(key).orderBy("section_ord", "part")
    ident = F.concat_ws(":", F.col(key).cast("string"), F.col("section_ord").cast("string"), F.col("part").cast("string"))
    own = j.select(
        key, (F.row_number().over(order) - 1).cast("int").alias("chunk_ord"), chunk_id(ident, text).alias("chunk_id"), text.alias("text"), F.lit(None).cast("string").alias("field_family"), F.when(ok, start).alias("char_start"),
        F.when(ok, start + F.length(text)).alias("char_end"), F.lit("sections").alias("chunker"), "heading", F.lit("clinical_section").alias("content_kind"), ok.alias("verified"),
    )
    bare = docs.select(key, F.trim(F.col(full)).alias("text")).where("text <> ''").join(s.select(key).distinct(), key, "left_anti")
    none = F.lit(None)
    return own.unionByName(bare.select(
        key, F.lit(0).alias("chunk_ord"), chunk_id(F.col(key).cast("string"), F.col("text")).alias("chunk_id"), "text", none.cast("string").alias("field_family"), none.cast("int").alias("char_start"), none.cast("int").alias("char_end"),
        F.lit("sections").alias("chunker"), none.cast("string").alias("heading"), F.lit("clinical_fallback").alias("content_kind"), F.lit(False).alias("verified"),
    ))


def chunk_documents(docs: DataFrame, sections: DataFrame, lab_lines: DataFrame, key: str, text: str, strategy: str = "chunking_strategy", limit: int = IMAGING_CHARS) -> DataFrame:
    """All chunks of all documents, each by its strategy: laboratory rows (paragraphs where there are none), whole imaging
    reports, sections, else paragraphs. One union of four plans, each over its own documents only."""
    how = F.col(strategy)
    of = lambda name: docs.where(how == name)
    none = F.lit(None)
    rows = lab_lines.join(of("lab_rows").select(key), key, "left_semi")
    lab = lab_row_chunks(rows.withColumn("line_id", F.col("ord")), key)
    lab = lab.select(
        key, "chunk_ord", "chunk_id", "text", family_of(F.col("text")).alias("field_family"), none.cast("int").alias("char_start"), none.cast("int").alias("char_end"), F.lit("lab_rows").alias("chunker"), F.col("section").alias("heading"),
        F.lit("structured_lab_rows").alias("content_kind"), F.lit(False).alias("verified"),
    )
    without = of("lab_rows").join(rows.where("raw_text is not null").select(key).distinct(), key, "left_anti")
    plain = docs.where(how.isNull()).unionByName(without)
    par = paragraphs(plain, key, text)
    par = par.select(key, "chunk_ord", "chunk_id", "text", "field_family", "char_start", "char_end", F.lit("paragraphs").alias("chunker"), none.cast("string").alias("heading"), F.lit("paragraph").alias("content_kind"), F.col("char_start").isNotNull().alias("verified"))
    ids = of("sections").select(key)
    sec = section_chunks(sections.join(ids, key, "left_semi"), of("sections"), key, text, limit)
    img = imaging_chunks(of("imaging_full"), key, text, limit)
    return reduce(DataFrame.unionByName, [x.select(key, *_CHUNK) for x in (lab, par, sec, img)])


#: Keys of a section's metadata that its chunks set themselves (fixed values).
RESERVED = ("chunker", "content_kind", "section_heading", "section_index", "part_index", "char_spans_verified")


def propagated(own: Column, section: Column) -> Column:
    """A chunk's metadata map with what its section says besides; reserved keys and keys of its own stay."""
    mine = F.map_keys(own)
    return F.map_concat(own, F.map_filter(section, lambda k, v: ~k.isin(*RESERVED) & ~F.array_contains(mine, k)))
