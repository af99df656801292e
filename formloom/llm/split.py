"""Problem 6: splitting oversized items at natural boundaries, with overlap.

Structure-tree packing. Every place where the text may be cut has a rank: headings by their depth (number
of signs, then titles in capitals or before a colon), blank lines, list items by their indentation, lines,
sentences, words. The ranks make a tree: the children of a node are what the lowest rank inside it parts.
Neighbouring children of one parent are merged while they fit the limit; only a node larger than the limit
is descended into, and its parts are never merged with the nodes beside it. A heading stays with what it
heads; a first part shorter than the overlap goes with the next. The pieces' cores tile the text; every piece but the first starts `overlap` characters before its
core, so a core holds at most `limit - overlap` characters (the first one `limit`).

Edge cases: null texts and texts within the limit give no pieces; blank oversized text is cut like any
other; a word longer than the limit is cut inside; unknown offsets come out null; of repeated rows of one
chunk_id only the latest counts, so a shorter later version needs no cutting; lengths count Unicode code
points.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType
from pyspark.sql.window import Window

LIMIT, OVERLAP = 1200, 100

_LINE = re.compile(r"[^\n]*\n?")
_MARKDOWN = re.compile(r"[ \t]*(#{1,6})[ \t]+\S")
_TITLE = re.compile(r"[ \t]*(?:[A-ZÀ-ÖØ-Þ][^\n.|]{2,60}\s?:|[A-ZÀ-ÖØ-Þ][A-ZÀ-ÖØ-Þ '’\-]{3,60})[ \t\r]*\n?$")
_ITEM = re.compile(r"([ \t]*)(?:[-*+•–—]|\(?(?:\d{1,3}|[a-zA-Z])[.)])[ \t]+\S")
#: Ranks of the places below the depths of headings.
TITLE, BLOCK, ITEM, LINE = 7, 8, 9, 10_000
_SENTENCE = re.compile(r"(?<=[.!?…;])[)\]»\"]*\s+")
_WORD = re.compile(r"\s+")


def places(text: str) -> tuple[list[int], list[int]]:
    """(positions, ranks) of the places between lines."""
    at, rank = [], []
    blank = False
    for m in _LINE.finditer(text):
        line = m[0]
        if not line:
            break
        if not line.strip():
            blank = True
            continue
        if m.start():
            head, item = _MARKDOWN.match(line), _ITEM.match(line)
            at.append(m.start())
            rank.append(len(head[1]) if head else TITLE if _TITLE.match(line) else BLOCK if blank and not item else ITEM + len(item[1].expandtabs(4)) if item else LINE)
        blank = False
    return at, rank


def cores(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """Spans that tile the text, packed from the structure tree."""
    out: list[tuple[int, int]] = []
    at, rank = places(text)

    def room(start: int) -> int:
        return limit if start == 0 else limit - overlap

    def heading(a: int, b: int) -> bool:
        line = text[a:b].strip()
        return len(line) < 100 and "\n" not in line and bool(_MARKDOWN.match(line) or _TITLE.match(line))

    def children(a: int, b: int) -> list[tuple[int, int]]:
        lo, hi = bisect_right(at, a), bisect_left(at, b)
        if lo < hi:
            best = min(rank[lo:hi])
            cuts = [at[i] for i in range(lo, hi) if rank[i] == best]
        else:
            cuts = [m.end() for m in _SENTENCE.finditer(text, a, b) if a < m.end() < b] or [m.end() for m in _WORD.finditer(text, a, b) if a < m.end() < b]
        return list(zip([a, *cuts], [*cuts, b])) if cuts else []

    def pack(a: int, b: int, inner: int) -> None:
        """Packs the node inner..b; a < inner where a heading before it goes along."""
        if b - a <= room(a):
            out.append((a, b))
            return
        kids = children(inner, b)
        if not kids:  # a leaf larger than the limit has no boundary inside: cut it
            while a < b:
                e = min(b, a + room(a))
                out.append((a, e))
                a = e
            return
        run: tuple[int, int] | None = None
        kids[0] = (a, kids[0][1])
        for n, (x, y) in enumerate(kids):
            inside = inner if n == 0 else x
            if run and y - run[0] <= room(run[0]):
                run = (run[0], y)
                continue
            if run and heading(*run):
                x = run[0]
            elif run:
                out.append(run)
            run = None
            if y - x <= room(x):
                run = (x, y)
            else:
                pack(x, y, inside)
        if run:
            out.append(run)

    if text:
        pack(0, len(text), 0)
    while len(out) > 1 and out[0][1] < overlap:  # too short to be overlapped: the next piece begins with it
        out[:2] = [(0, out[1][1])]
    return out


def pieces_of(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Spans of the pieces, overlap included."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below the limit")
    return [(max(0, a - overlap) if a else 0, b) for a, b in cores(text, limit, overlap)]


def latest_chunks(chunks: DataFrame, above: int = -1) -> DataFrame:
    """One row per chunk_id whose latest text is longer than `above`.

    The latest is the one indexed last (then with known offsets, then of smallest order). Texts within the
    bound aren't shuffled, they only count as versions.
    """
    long = F.when(F.length("text") > above, F.col("text"))
    pick = F.struct(F.col("indexed_at"), F.col("char_start").isNotNull(), (-F.col("chunk_ord")).alias("o"), "document_id", "chunk_ord", long.alias("text"), "char_start", "char_end")
    known = F.max(F.struct("char_start", long.alias("text")))
    return chunks.where("text is not null").groupBy("chunk_id").agg(F.max(pick).alias("p"), known.alias("k")).where("p.text is not null").select(
        "chunk_id", "p.document_id", "p.chunk_ord", "p.text",
        F.coalesce("p.char_start", F.when(F.col("k.text") == F.col("p.text"), F.col("k.char_start"))).alias("char_start"),
    )


@F.pandas_udf(ArrayType(LongType()))
def occurrences(whole: pd.Series, part: pd.Series) -> pd.Series:
    """All places where part stands in whole, overlapping ones too."""
    out = []
    for w, p in zip(whole, part):
        at: list[int] = []
        i = w.find(p) if w is not None else -1
        while i >= 0:
            at.append(i)
            i = w.find(p, i + 1)
        out.append(at)
    return pd.Series(out)


def split_chunks(chunks: DataFrame, documents: DataFrame | None = None, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(chunk_id, document_id, piece, text, char_start, char_end) of every chunk above the limit.

    Offsets of a chunk that has none are looked up in its document's text, if documents are given. Copies
    of one text get its occurrences in their order; where there are more or fewer occurrences without a
    known chunk than copies, nothing tells them apart and the offsets stay null.
    """
    big = latest_chunks(chunks, limit)
    if documents is not None:
        # all copies of a text in a document, those of known place too: the n-th by order is the n-th occurrence
        copy = Window.partitionBy("document_id", "text")
        mates = big.withColumn("taken", F.collect_set("char_start").over(copy)).where("char_start is null").drop("char_start")
        mates = mates.withColumn("n", F.dense_rank().over(copy.orderBy("chunk_ord")))
        mates = mates.withColumn("copies", F.max("n").over(copy))
        texts = documents.select("document_id", "full_text")
        found = mates.join(texts, "document_id", "left").withColumn("at", occurrences("full_text", "text"))
        free = F.array_sort(F.array_except("at", "taken"))
        # as many places as copies, or the copies cannot be told apart
        told = (F.size(free) == F.col("copies")) & F.col("chunk_ord").isNotNull()
        found = found.select("chunk_id", "document_id", "chunk_ord", "text", F.when(told, F.try_element_at(free, F.col("n"))).alias("char_start"))
        big = big.where("char_start is not null").select(*found.columns).unionAll(found)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for cid, did, text, start in zip(pdf["chunk_id"], pdf["document_id"], pdf["text"], pdf["char_start"]):
                base = None if pd.isna(start) else int(start)
                for n, (a, b) in enumerate(pieces_of(text, limit, overlap)):
                    rows.append((cid, did, n, text[a:b], base if base is None else base + a, base if base is None else base + b))
            out = pd.DataFrame(rows, columns=["chunk_id", "document_id", "piece", "text", "char_start", "char_end"])
            out["char_start"], out["char_end"] = out["char_start"].astype("Int64"), out["char_end"].astype("Int64")
            yield out

    return big.select("chunk_id", "document_id", "text", "char_start").mapInPandas(
        run, "chunk_id string, document_id string, piece int, text string, char_start long, char_end long"
    )


def p6_found(chunks: DataFrame) -> DataFrame:
    """Each chunk that had to be split."""
    return split_chunks(chunks).select("chunk_id").distinct()


def p6_tiling(chunks: DataFrame, documents: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(chunk_id, within, overlapping, whole): whether the pieces keep the limit, overlap by exactly `overlap` and give the chunk's text."""
    p = split_chunks(chunks, documents, limit, overlap)
    ordered = F.array_sort(F.collect_list(F.struct("piece", "text")))
    texts = F.transform(ordered, lambda x: x["text"])
    g = p.groupBy("chunk_id").agg(texts.alias("t"), F.max(F.length("text")).alias("most"))
    ends = F.zip_with(F.slice("t", 1, F.size("t") - 1), F.slice("t", 2, F.size("t") - 1), lambda a, b: F.right(a, F.lit(overlap)) == F.left(b, F.lit(overlap)))
    joined = F.concat(F.element_at("t", 1), F.array_join(F.transform(F.slice("t", 2, F.size("t") - 1), lambda x: F.substr(x, F.lit(overlap + 1))), ""))
    g = g.join(latest_chunks(chunks, limit).select("chunk_id", F.col("text").alias("source")), "chunk_id")
    return g.select("chunk_id", (F.col("most") <= limit).alias("within"), F.forall(ends, lambda x: x).alias("overlapping"), (joined == F.col("source")).alias("whole"))
