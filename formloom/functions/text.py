"""Folding of text inside Spark expressions (JVM side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Latin letters with marks and the plain letters they stand for, by position.
MARKED = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
GREEK, LATIN = "αβγμµ", "abguu"


def fold(c: Column, greek: bool = True) -> Column:
    """Lower case without accents; ligatures spelled out, Greek letters of units and names as Latin. Null stays null."""
    low = F.lower(c)
    low = F.replace(F.replace(low, F.lit("œ"), F.lit("oe")), F.lit("æ"), F.lit("ae"))
    return F.translate(low, MARKED + GREEK, PLAIN + LATIN) if greek else F.translate(low, MARKED, PLAIN)


def blank(c: Column) -> Column:
    """True for null and for text of white space only (Unicode)."""
    return c.isNull() | F.coalesce(c.rlike(r"(?U)^[\s ]*$"), F.lit(True))


def empty_cell(c: Column) -> Column:
    """Null, blank or the sentinel NA in any case."""
    return blank(c) | (F.upper(F.trim(c)) == "NA")


def words(c: Column) -> Column:
    """Folded text with every other run of characters turned into one space."""
    return F.trim(F.regexp_replace(fold(c), r"[^a-z0-9]+", " "))
