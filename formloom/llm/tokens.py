"""Problem 7: encoding of the whole corpus with a public byte-level BPE vocabulary.

The corpus is counted once; its frequent words are encoded exactly and compiled into a minimal acyclic
transducer: states with equal futures are shared, every edge carries how many words lie before it, so
the sum along a path is the word's number, which points into the table of id outputs. The file is
shipped to every executor and memory-mapped there. Words it does not hold are merged exactly by rank.

Edge cases: null, empty text -> empty list; strings of special tokens are ordinary text; unusual
characters go through their bytes; very long texts and words are encoded whole; repeated rows each
keep their row; empty tables give no rows; extra columns are dropped by `encode` and kept nowhere else.
"""

from __future__ import annotations

import array
import base64
import heapq
import mmap
import os
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How many of the most frequent words the transducer holds: a size of the lexicon, not of the corpus;
#: every other word is merged exactly, so it changes speed only.
LEXICON_WORDS = 32_768
#: Splits text before merging (fixed value of the public vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries a worker remembers before it starts anew.
MEMO = 400_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(word: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Exact byte-pair merges: always the pair of lowest rank, the leftmost of equals.

    A heap over a linked list keeps very long words at n log n.
    """
    if word in ranks:
        return (ranks[word],)
    n = len(word)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, e = heapq.heappop(heap)
        if not alive[i] or (j := nxt[i]) >= n or end[j] != e:
            continue
        if end[i] != j:
            continue
        alive[j] = False
        end[i] = e
        nxt[i] = nxt[j]
        if nxt[j] < n:
            prv[nxt[j]] = i
            k = nxt[i]
            if (r := ranks.get(word[i : end[k]])) is not None:
                heapq.heappush(heap, (r, i, end[k]))
        if prv[i] >= 0:
            p = prv[i]
            if (r := ranks.get(word[p:e])) is not None:
                heapq.heappush(heap, (r, p, e))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = nxt[i]
    return tuple(out)


# --- the transducer -----------------------------------------------------------------------------


def compile_lexicon(entries: Iterable[tuple[bytes, tuple[int, ...]]], path: str) -> int:
    """Writes the minimal acyclic transducer of sorted distinct (word, ids); returns its number of states."""
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...], int]] = []  # final, edges, words below

    class Node:
        __slots__ = ("final", "edges")

        def __init__(self) -> None:
            self.final, self.edges = False, []

    def freeze(node: Node) -> int:
        key = (node.final, tuple(node.edges))
        if key not in register:
            register[key] = len(states)
            states.append((node.final, key[1], node.final + sum(states[t][2] for _, t in key[1])))
        return register[key]

    offsets, ids = array.array("i", [0]), array.array("i")
    path_nodes, last = [Node()], b""
    for word, out in entries:
        if word <= last and last:
            raise ValueError("words must be sorted and distinct")
        common = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        while len(path_nodes) > common + 1:  # the tail of the last word has all its futures: share it
            node = path_nodes.pop()
            path_nodes[-1].edges[-1] = (path_nodes[-1].edges[-1][0], freeze(node))
        for b in word[common:]:
            path_nodes[-1].edges.append((b, -1))
            path_nodes.append(Node())
        path_nodes[-1].final = True
        ids.extend(out)
        offsets.append(len(ids))
        last = word
    while len(path_nodes) > 1:
        node = path_nodes.pop()
        path_nodes[-1].edges[-1] = (path_nodes[-1].edges[-1][0], freeze(node))
    root = freeze(path_nodes[0])
    first, labels, targets, before = [0], [], [], []
    for final, edges, _ in states:
        seen = int(final)
        for b, t in edges:
            labels.append(b)
            targets.append(t)
            before.append(seen)
            seen += states[t][2]
        first.append(len(labels))
    parts = [np.asarray(first, "<i4"), np.asarray(targets, "<i4"), np.asarray(before, "<i4"), np.frombuffer(offsets, "i").astype("<i4"), np.frombuffer(ids, "i").astype("<i4") if ids else np.zeros(0, "<i4"),
             np.asarray([s[0] for s in states], "u1"), np.asarray(labels, "u1")]
    head = np.asarray([root, len(states), *(len(p) for p in parts)], "<i8")
    with open(path, "wb") as f:
        f.write(head.tobytes())
        for p in parts:
            f.write(p.tobytes())
    return len(states)


class Lexicon:
    """The memory-mapped transducer."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        head = np.frombuffer(self._map, "<i8", 9)
        self.root, at = int(head[0]), 72
        views = []
        for n, kind in zip(head[2:], ("<i4",) * 5 + ("u1",) * 2):
            views.append(np.frombuffer(self._map, kind, int(n), at))
            at += views[-1].nbytes
        self.first, self.targets, self.before, self.offsets, self.ids, self.final, self.labels = (memoryview(v) for v in views)

    def get(self, word: bytes) -> tuple[int, ...] | None:
        state, number = self.root, 0
        first, labels, targets, before = self.first, self.labels, self.targets, self.before
        for b in word:
            lo, hi = first[state], first[state + 1]
            while lo < hi:
                mid = (lo + hi) >> 1
                if labels[mid] < b:
                    lo = mid + 1
                else:
                    hi = mid
            if lo >= first[state + 1] or labels[lo] != b:
                return None
            number += before[lo]
            state = targets[lo]
        return tuple(self.ids[self.offsets[number] : self.offsets[number + 1]]) if self.final[state] else None


class Encoder:
    """Text -> ids by lexicon and exact merges; remembers what it looked up."""

    def __init__(self, lexicon: Lexicon | None, ranks: dict[bytes, int]) -> None:
        self.lexicon, self.ranks = lexicon, ranks
        self.split = regex.compile(PATTERN).findall
        self.memo: dict[str, tuple[int, ...]] = {}

    def word(self, w: str) -> tuple[int, ...]:
        raw = w.encode("utf-8", "surrogatepass")
        out = self.lexicon.get(raw) if self.lexicon else None
        if out is None:
            out = merge(raw, self.ranks)
        if len(raw) <= 64:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[w] = out
        return out

    def extend(self, buf: array.array, text: str) -> None:
        memo, add = self.memo, buf.extend
        for w in self.split(text):
            ids = memo.get(w)
            add(ids if ids is not None else self.word(w))


_WORKER: dict[tuple[str, str], Encoder] = {}


def _encoder(lexicon: str, vocabulary: str) -> Encoder:
    """One encoder per worker process and lexicon."""
    key = (lexicon, vocabulary)
    if key not in _WORKER:
        _WORKER.clear()
        here = vocabulary if os.path.exists(vocabulary) else SparkFiles.get(os.path.basename(vocabulary))
        _WORKER[key] = Encoder(Lexicon(SparkFiles.get(lexicon)), read_ranks(here))
    return _WORKER[key]


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over the whole corpus; every task sums before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(PATTERN).findall
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return b

        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    seen.update(split(t))
            if len(seen) > 300_000:
                yield out()
        if seen:
            yield out()

    return docs.select(F.col(text)).mapInArrow(count, "word string, n long").where(F.length("word") <= 48).groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, text: str = "text", vocabulary: str | None = None, words: int = LEXICON_WORDS) -> tuple[str, str]:
    """Compiles the corpus's most frequent words and ships the file; returns (file name, vocabulary)."""
    vocabulary = vocabulary or default_vocabulary()
    spark = docs.sparkSession
    frequent = word_counts(docs, text).orderBy(F.desc("n"), "word").limit(words).select("word").collect()  # at most `words` short words
    ranks = read_ranks(vocabulary)
    entries = sorted({r["word"].encode("utf-8", "surrogatepass") for r in frequent})
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="formloom-"), name)  # the driver's copy; executors fetch theirs
    compile_lexicon(((w, merge(w, ranks)) for w in entries), path)
    spark.sparkContext.addFile(path)
    spark.sparkContext.addFile(vocabulary)
    return name, vocabulary


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, lexicon: tuple[str, str] | None = None) -> DataFrame:
    """(key, ids): the ids of every text, an empty list for null and empty ones."""
    name, vocab = lexicon or build_lexicon(docs, text, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(name, vocab)
        for b in batches:
            buf, offsets = array.array("i"), array.array("i", [0])
            for t in b.column(1).to_pylist():
                if t:
                    enc.extend(buf, t)
                offsets.append(len(buf))
            ids = pa.ListArray.from_arrays(pa.array(np.frombuffer(offsets, "i")), pa.array(np.frombuffer(buf, "i") if buf else np.zeros(0, "i4")))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], [key, "ids"])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, ids array<int>")


def token_sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, lexicon: tuple[str, str] | None = None) -> DataFrame:
    """(key, n_tokens), without shipping the ids."""
    name, vocab = lexicon or build_lexicon(docs, text, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(name, vocab)
        for b in batches:
            sizes = []
            for t in b.column(1).to_pylist():
                buf = array.array("i")
                if t:
                    enc.extend(buf, t)
                sizes.append(len(buf))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int32())], [key, "n_tokens"])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, n_tokens int")


def p7_ids(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    return encode(docs.select("doc_id", "text"), vocabulary=vocabulary)
