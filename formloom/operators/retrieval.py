"""Retrieval: lexical, dense and BM25 rankings, fusion, reranking, recall, hybrid search.

Queries are a stated set (rows with an id divisible by 100, or a small table); all rows are candidates.
Queries go in blocks of a fixed size, however many there are; each block is broadcast, every task scores its
passages against it and passes on only its own k best per query. So no term, however frequent, is a join
key, and what is shuffled is queries * k per task. The rankings of the blocks are united.
Blank queries have no hits in `hybrid`; ties fall to the smallest id; null texts match nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formloom.functions.text import blank
from formloom.session import safe_unions

#: Most queries that are broadcast as one block (vectors, texts), and most scored at a time within it.
QUERY_BLOCK, TEXT_BLOCK, QUERY_ROWS = 10_000, 1_000, 500
#: Fusion constant and BM25 parameters (published defaults).
RRF_C, BM25_K1, BM25_B = 60.0, 1.2, 0.75
_TERM = re.compile("[a-z0-9]+")


def _blocks(rows: Iterable, size: int) -> Iterator[list]:
    block: list = []
    for r in rows:
        block.append(r)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


class _Best:
    """The k best (score, id) of each query so far, ties to the smallest id."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.scores, self.ids = k, [None] * n, [None] * n

    def add(self, first: int, scores, own, least: float | None) -> None:
        """scores: queries x passages of queries first..; own: ids of the passages; least: scores at or below it don't count."""
        import numpy as np

        for q in range(scores.shape[0]):
            s, i = scores[q], own
            if least is not None:
                keep = s > least
                s, i = s[keep], own[keep]
            if self.scores[first + q] is not None:
                s, i = np.concatenate([self.scores[first + q], s]), np.concatenate([self.ids[first + q], i])
            if len(s) > self.k:
                floor = np.partition(s, len(s) - self.k)[len(s) - self.k]
                keep = s >= floor
                s, i = s[keep], i[keep]
            order = np.lexsort((i, -s))[: self.k]
            self.scores[first + q], self.ids[first + q] = s[order], i[order]

    def frame(self, names: list):
        import numpy as np
        import pandas as pd

        have = [q for q, i in enumerate(self.ids) if i is not None and len(i)]
        if not have:
            return None
        return pd.DataFrame({"query_id": np.repeat([names[q] for q in have], [len(self.ids[q]) for q in have]), "id": np.concatenate([self.ids[q] for q in have]), "score": np.concatenate([self.scores[q] for q in have])})


def _text_block(passages: DataFrame, names: list, postings: dict, weigh: Callable, finish: Callable, least: float | None, k: int, kind: str, idk: str) -> DataFrame:
    """(query_id, id, score): per task the k best passages of each query of one block.

    postings: term -> (query numbers, weights); weigh(text, postings): {term: weight} of a passage; finish: scores from sums.
    """
    import numpy as np

    shared = passages.sparkSession.sparkContext.broadcast((names, postings))

    def run(batches):
        names, postings = shared.value
        best = _Best(len(names), k)
        for pdf in batches:
            pdf = pdf[pdf["text"].notna()]
            if not len(pdf) or not names:
                continue
            own = pdf["id"].to_numpy()
            at: dict = {}
            for d, text in enumerate(pdf["text"]):
                for term, w in weigh(text, postings).items():
                    at.setdefault(term, ([], []))
                    at[term][0].append(d)
                    at[term][1].append(w)
            held = [(postings[t], np.asarray(d), np.asarray(w, np.float64)) for t, (d, w) in at.items()]
            for first in range(0, len(names), QUERY_ROWS):
                n = min(QUERY_ROWS, len(names) - first)
                sums = np.zeros((n, len(own)))
                for (q, qw), d, w in held:
                    lo, hi = np.searchsorted(q, (first, first + n))
                    if lo < hi:
                        sums[np.ix_(q[lo:hi] - first, d)] += np.outer(qw[lo:hi], w)
                best.add(first, finish(sums), own, least)
        out = best.frame(names)
        if out is not None:
            yield out

    return passages.select("id", "text").mapInPandas(run, f"query_id {kind}, id {idk}, score double")


def _postings(rows: list, terms_of: Callable[[str], dict]) -> dict:
    """term -> (query numbers, weights) of a block of queries."""
    import numpy as np

    lists: dict = {}
    for q, r in enumerate(rows):
        for t, w in terms_of(r["query"]).items():
            lists.setdefault(t, ([], []))
            lists[t][0].append(q)
            lists[t][1].append(w)
    return {t: (np.asarray(q, np.int64), np.asarray(w, np.float64)) for t, (q, w) in lists.items()}


def _by_blocks(queries: DataFrame, passages: DataFrame, k: int, one: Callable[[list], DataFrame]) -> DataFrame:
    """The rankings of all blocks of queries, united."""
    found = None
    for rows in _blocks(queries.where("query is not null").select("query_id", "query").toLocalIterator(), TEXT_BLOCK):
        part = one(rows)
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = one([])
    return top_k(found, ["query_id"], "score", "id", k).select("query_id", "id", "score", "rank")


def top_k(df: DataFrame, by: list[str], score: str, tie: str, k: int) -> DataFrame:
    """The k best rows of each query with their rank; Spark turns the filter into a group limit before the shuffle."""
    w = Window.partitionBy(*by).orderBy(F.desc(score), tie)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def family_first_k(chunks: DataFrame, families: list[str], k: int) -> DataFrame:
    """Per document and family, the first k chunks tagged with it or untagged, in document order."""
    tagged = chunks.withColumn("family", F.explode(F.array(*[F.lit(f) for f in families]))).where("field_family = family or field_family is null")
    w = Window.partitionBy("document_id", "family").orderBy("chunk_ord", "chunk_id")
    score = F.when(F.col("field_family").isNotNull(), 0.88).otherwise(0.78)
    return tagged.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("document_id", "family", "rank", "chunk_id", score.alias("score"))


def _words(text: str) -> Counter:
    return Counter(w for w in text.lower().split() if len(w) > 2)


def _words_inside(text: str, postings: dict) -> dict:
    """The query words a passage holds, also inside its longer words: a word without blanks stands in a text
    exactly if it stands in one of its tokens."""
    sizes = postings.get("", None)
    if sizes is None:
        sizes = postings[""] = sorted({len(w) for w in postings})
    out: dict = {}
    for token in set(text.lower().split()):
        for n in sizes:
            if n > len(token):
                break
            for i in range(len(token) - n + 1):
                w = token[i : i + n]
                if w in postings:
                    out[w] = 1.0
    return out


def lexical(queries: DataFrame, passages: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank): passages by how many of the query's words stand in them, also inside longer words.

    score = min(1, 0.2 + 0.15 * words found); only words above two letters count, a repeated word counts
    again. A passage without any scores 0.2, so every query has its k passages.
    """
    import numpy as np

    kind, idk = dict(queries.dtypes)["query_id"], dict(passages.dtypes)["id"]

    def one(rows: list) -> DataFrame:
        return _text_block(passages, [r["query_id"] for r in rows], _postings(rows, _words), _words_inside, lambda s: np.round(np.minimum(1.0, 0.2 + 0.15 * s), 6), None, k, kind, idk)

    return _by_blocks(queries, passages, k, one)


def dense(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank) by cosine, exact: every vector against the stated queries, blocks of queries one after the other."""
    kind, idk = dict(queries.dtypes)["query_id"], dict(vectors.dtypes)["id"]
    found = None
    for rows in _blocks(queries.select("query_id", "embedding").where("embedding is not null").toLocalIterator(), QUERY_BLOCK):
        part = _dense_block(rows, vectors, k, kind, idk)
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = _dense_block([], vectors, k, kind, idk)
    return top_k(found, ["query_id"], "score", "id", k)


def _dense_block(rows: list, vectors: DataFrame, k: int, kind: str, idk: str) -> DataFrame:
    """(query_id, id, score): per task the k best vectors of each query of one block."""
    import numpy as np

    ids = [r["query_id"] for r in rows]
    m = np.asarray([r["embedding"] for r in rows], np.float64).reshape(len(rows), -1) if rows else np.zeros((0, 0))
    m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    shared = vectors.sparkSession.sparkContext.broadcast((ids, m))

    def run(batches):
        ids, m = shared.value
        best = _Best(len(ids), k)
        for pdf in batches:
            pdf = pdf[pdf["embedding"].notna()]
            if not len(pdf) or not len(ids):
                continue
            x = np.asarray(pdf["embedding"].tolist(), np.float64)
            x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
            own = pdf["id"].to_numpy()
            for a in range(0, len(ids), QUERY_ROWS):
                best.add(a, np.round(m[a : a + QUERY_ROWS] @ x.T, 6), own, None)
        out = best.frame(ids)
        if out is not None:
            yield out

    return vectors.select("id", "embedding").mapInPandas(run, f"query_id {kind}, id {idk}, score double")


def _terms_once(text: str) -> dict:
    return dict.fromkeys(_TERM.findall(text.lower()), 1.0)


def corpus_statistics(passages: DataFrame) -> tuple[DataFrame, int, float]:
    """((term, df), number of passages with terms, their mean length): counted over all passages, terms summed before the shuffle."""
    tokens = F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))
    row = passages.select(F.size(tokens).alias("dl")).where("dl > 0").agg(F.count("*").alias("n"), F.avg("dl").alias("a")).first()
    df = passages.select(F.explode(F.array_distinct(tokens)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return df, row["n"] or 0, row["a"] or 1.0


def bm25(queries: DataFrame, passages: DataFrame, k: int, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """(query_id, id, score, rank) by Okapi BM25; corpus statistics over all passages. A query's words count once."""
    import numpy as np

    spark = passages.sparkSession
    kind, idk = dict(queries.dtypes)["query_id"], dict(passages.dtypes)["id"]
    df, n, avg = corpus_statistics(passages)

    def one(rows: list) -> DataFrame:
        postings = _postings(rows, _terms_once)
        known = df.join(F.broadcast(spark.createDataFrame([(t,) for t in postings], "term string")), "term") if postings else df.limit(0)  # the terms of one block
        idf = {r["term"]: math.log(1 + (n - r["df"] + 0.5) / (r["df"] + 0.5)) for r in known.collect()}
        postings = {t: (q, w * idf[t]) for t, (q, w) in postings.items() if t in idf}

        def weigh(text: str, postings: dict) -> dict:
            tf = Counter(_TERM.findall(text.lower()))
            base = k1 * (1 - b + b * sum(tf.values()) / avg)
            return {t: m * (k1 + 1) / (m + base) for t, m in tf.items() if t in postings}

        return _text_block(passages, [r["query_id"] for r in rows], postings, weigh, lambda s: np.round(s, 6), 0.0, k, kind, idk)

    return _by_blocks(queries, passages, k, one)


def overlap(queries: DataFrame, passages: DataFrame, k: int) -> DataFrame:
    """(query_id, id, score, rank) by the number of different words shared."""
    kind, idk = dict(queries.dtypes)["query_id"], dict(passages.dtypes)["id"]

    def shared(text: str, postings: dict) -> dict:
        return {t: 1.0 for t in set(_TERM.findall(text.lower())) if t in postings}

    def one(rows: list) -> DataFrame:
        return _text_block(passages, [r["query_id"] for r in rows], _postings(rows, _terms_once), shared, lambda s: s, 0.0, k, kind, idk)

    return _by_blocks(queries, passages, k, one)


def fuse(a: DataFrame, b: DataFrame, k: int, c: float = RRF_C) -> DataFrame:
    """(query_id, id, score, rank): reciprocal rank fusion of two rankings."""
    safe_unions(a.sparkSession)
    both = a.select("query_id", "id", "rank").unionAll(b.select("query_id", "id", "rank"))
    s = both.groupBy("query_id", "id").agg(F.round(F.sum(1.0 / (c + F.col("rank"))), 9).alias("score"))
    return top_k(s, ["query_id"], "score", "id", k)


def rerank(hits: DataFrame, queries: DataFrame, passages: DataFrame, k: int) -> DataFrame:
    """hits reordered by the share of the query's words a passage holds (the deterministic scorer; a model's scorer is a pandas UDF in its place)."""
    j = hits.select("query_id", "id", F.col("rank").alias("first_rank")).join(queries.select("query_id", "query"), "query_id").join(passages.select("id", "text"), "id")
    toks = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0)))
    share = F.coalesce(F.try_divide(F.size(F.array_intersect(toks("query"), toks("text"))).cast("double"), F.size(toks("query"))), F.lit(0.0))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "first_rank", "id")
    return j.withColumn("score", F.round(share, 6)).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "id", "score", "first_rank", "rank")


def best_per_family(hits: DataFrame) -> DataFrame:
    return hits.groupBy("document_id", "family").agg(F.max("score").alias("best_score"))


def recall_by_label(hits: DataFrame, queries: DataFrame, labels: DataFrame, ks: list[int]) -> DataFrame:
    """(query_id, recall_1, ...): share of the rows with the query's label among the first k. The rows of a label are
    counted, never paired with its queries, so a label may hold any share of them."""
    n = labels.groupBy("label").agg(F.count("*").alias("n"))
    q = queries.join(n, "label")
    own = hits.join(labels.select("id", F.col("label").alias("_l")), "id").join(queries, "query_id").where("_l = label")
    found = own.groupBy("query_id").agg(*[F.count_if(F.col("rank") <= k).alias(f"f{k}") for k in ks])
    return q.join(found, "query_id", "left").select("query_id", *[F.round(F.coalesce(F.col(f"f{k}"), F.lit(0)) / F.col("n"), 6).alias(f"recall_{k}") for k in ks])


# --- hybrid search ---------------------------------------------------------------------------------------
#: What a family is searched by where the study says nothing.
FAMILY_QUERIES = {
    "hematology": "hématologie hémogramme plaquettes leucocytes", "coagulation": "coagulation INR TP TCA fibrinogène", "hepatic_biochemistry": "bilan hépatique AST ALT GGT bilirubine",
    "inflammation_biomarkers": "inflammation CRP biomarqueurs", "comorbidities": "antécédents comorbidités traitements",
    "imaging_recist": "RECIST réponse tumorielle cible non cible progression stabilité scanner TDM IRM mesure lésion millimètres mm",
    "treatment_lines": "ligne de traitement chimiothérapie immunothérapie protocole cycle dose arrêt efficacité toxicité seconde ligne troisième ligne",
}
PASSAGE, QUERY = "passage: ", "query: "
CANDIDATES = 4


def hash_embedding(text: Column, prefix: str = "", dim: int = 32) -> Column:
    """A deterministic embedding: how often the text's words fall into each of `dim` buckets, of length one.

    A model's embedding is a pandas UDF in its place; dimension and prefixes are the same contract.
    """
    words = F.regexp_extract_all(F.lower(F.concat(F.lit(prefix), text)), F.lit("[a-z0-9]+"), F.lit(0))
    buckets = F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 4), 16, 10).cast("int") % dim)
    counts = _let(buckets, lambda b: F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.size(F.filter(b, lambda x: x == i)).cast("double")))
    scaled = _let(counts, lambda c: _let(F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x)), lambda n: F.when(n > 0, F.transform(c, lambda x: x / n))))
    return scaled


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once: lambda variables are, expressions inside lambdas are not."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hybrid(
    queries: DataFrame, passages: DataFrame, k: int, embed: Callable[[Column, str], Column] = hash_embedding, sparse: bool = True, min_score: float | None = None, rerank_top: bool = False, candidates: int = CANDIDATES,
) -> DataFrame:
    """(query_id, id, retrieval_score, retrieval_rank, rerank_score, rerank_rank): dense and BM25 rankings fused, cut and reranked.

    passages: rows of one tenant after `index.filtered`. Each branch gives candidates * k; the least score
    is asked of the fused ranking before reranking; without a sparse branch the dense score stands.
    """
    q = queries.where(~blank(F.col("query")))
    n = max(k, k * candidates)
    p = passages.select("id", "text")
    d = dense(q.select("query_id", embed(F.col("query"), QUERY).alias("embedding")), p.select("id", embed(F.col("text"), PASSAGE).alias("embedding")), n)
    first = fuse(d, bm25(q, p, n), n) if sparse else d
    first = first.select("query_id", "id", F.col("score").alias("retrieval_score"), F.col("rank").alias("retrieval_rank"))
    if min_score is not None:
        first = first.where(F.col("retrieval_score") >= min_score)
    if not rerank_top:
        return first.where(F.col("retrieval_rank") <= k).select("*", F.lit(None).cast("double").alias("rerank_score"), F.lit(None).cast("int").alias("rerank_rank"))
    again = rerank(first.select("query_id", "id", F.col("retrieval_rank").alias("rank")), q, p, k)
    return first.join(again.select("query_id", "id", F.col("score").alias("rerank_score"), F.col("rank").alias("rerank_rank")), ["query_id", "id"])


def family_queries(families: DataFrame, fields: DataFrame | None = None, study: dict[str, str] | None = None) -> DataFrame:
    """(field_family, query): the study's query, else the first field's own, else the usual one, else the family's name."""
    f = F.col("field_family")
    said, usual = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, v in (study or {}).items():
        said = F.when(f == k, v).otherwise(said)
    for k, v in FAMILY_QUERIES.items():
        usual = F.when(f == k, v).otherwise(usual)
    df = families.select("field_family").distinct()
    own = F.lit(None).cast("string")
    if fields is not None and "retrieval_query" in fields.columns:
        order = "field_ord" if "field_ord" in fields.columns else "field_name"
        first = fields.where(~blank(F.col("retrieval_query"))).groupBy("field_family").agg(F.min_by("retrieval_query", order).alias("_own"))
        df, own = df.join(first, "field_family", "left"), F.col("_own")
    return df.select("field_family", F.coalesce(said, own, usual, F.replace(f, F.lit("_"), F.lit(" "))).alias("query"))


def family_search(chunks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Per document and family the k chunks, tagged with it or untagged, that hold most words of the family's query.

    queries(field_family, query) are a handful; the search stays within a document, so no ranking is global.
    """
    words = F.filter(F.split(F.lower("query"), r"\s+"), lambda w: F.length(w) > 2)
    asked = [(r["field_family"], r["w"]) for r in queries.select("field_family", words.alias("w")).collect()]
    fams = F.array(*[F.struct(F.lit(f).alias("f"), F.array(*[F.lit(x) for x in w]).cast("array<string>").alias("w")) for f, w in asked])
    own = F.filter(fams, lambda x: F.col("field_family").isNull() | (F.col("field_family") == x["f"]))
    c = chunks.withColumn("_q", F.explode(own)).withColumn("_low", F.lower("text"))
    score = F.round(F.least(F.lit(1.0), 0.2 + 0.15 * F.size(F.filter("_q.w", lambda w: F.contains(F.col("_low"), w)))), 6)
    w = Window.partitionBy("document_id", "_q.f").orderBy(F.desc("score"), "chunk_ord", "chunk_id")
    c = c.withColumn("score", score).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return c.select("document_id", F.col("_q.f").alias("family"), "rank", "chunk_id", "score")


def check_documents(chunks: DataFrame, documents: DataFrame) -> None:
    """An error if chunks name a document that is not among documents."""
    other = chunks.join(documents.select("document_id"), "document_id", "left_anti").select("chunk_id", "document_id").take(1)
    if other:
        raise ValueError(f"chunk {other[0]['chunk_id']} is of document {other[0]['document_id']}, which is not searched")
