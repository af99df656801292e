"""Problem 2: noise in text from scanned pages, found and repaired.

Lines that only repeat the head of a page or number it are set aside; the rest is one stream of characters.
It is decoded jointly: one lattice whose arcs are a word as it stands, every known reading of its scanning
confusions, words broken at a line end with and without a hyphen of their own, two words merged, one word
split. Arcs weigh what their words cost by their frequency (bits) and what the noise costs; the cheapest
path decides, and only noise on that path is reported. Words and frequencies are learned from the pages
that were not scanned. Paragraph boundaries are chosen by dynamic programming over the lines.

Edge cases: null and empty texts give no rows and stay as they are; documents known not to be scanned
are left alone; without any unscanned document the lexicon comes from all; repeated rows give one set
of rows; very long tokens (codes, blobs) and e-mail addresses are never changed; empty tables give none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from math import log2

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.session import cut

#: A word or line is known if it stands in this many unscanned documents, and in this share of them. So the
#: lexicon is at most 1 / SHARE times the distinct words of a document, of a corpus of any size.
MIN_DOCS, SHARE = 3, 1e-4
#: Bits that noise costs: a confusion, a break at a line end, a lost hyphen, two words run together, a word torn apart.
CONFUSED, BROKEN, OWN_HYPHEN, TORN, FUSED = 10.0, 1.0, 4.0, 18.0, 16.0
#: Bits an unknown word costs above the rarest known one, and one that no word is written like.
UNKNOWN, ODD = 12.0, 14.0

#: What scanning makes of letters: (as it stands, as it was) (fixed values).
CONFUSIONS = (
    ("1", "l"), ("1", "i"), ("í", "i"), ("ì", "i"), ("0", "o"), ("5", "s"), ("@", "a"), ("†", "t"), ("9", "g"), ("6", "é"), ("6", "b"), ("8", "b"), ("3", "e"),
    ("e'", "é"), ("e’", "é"), ("\\/", "v"), ("rn", "m"), ("ri", "n"), ("ii", "u"), ("li", "h"), ("vv", "w"), ("cl", "d"), ("d", "cl"),
    ("c", "e"), ("g", "q"), ("m", "rn"), ("l", "i"), ("I", "l"), ("|", "l"), ("q", "g"), ("h", "li"), ("n", "ri"), ("u", "ii"), ("f", "t"),
)
#: Those whose left side never stands in a word of its own accord.
STRANGE = re.compile(r"[@†íì\\]|(?<=[^\W\d_])[01569](?=[^\W\d_])|^[015][a-zà-ÿ]{3,}|[a-zà-ÿ]{3,}[0156]$|[a-z]e['’](?:[a-zà-ÿ]|$)|^e['’][a-zà-ÿ]{2}")
HYPHENS = "-¬­‐"
_MARKS = str.maketrans("àâäáãåçéèêëîïñóòôöõúùûüýÿ", "aaaaaaceeeeiinooooouuuuyy")
_ELISION = re.compile(r"^(?:[ldnsmtcj]|qu|jusqu|lorsqu|puisqu)['’](?=\w)", re.I)
_EDGE = ".,;:!?()[]{}|«»\"“”…=<>≤≥~≈•–—*"
_NUM = re.compile(r"^(?=.*\d)(?=.*[OlZSB])[\dOlZSB]+(?:[.,][\dOlZSB]+)?$")
_DATE = re.compile(r"^(?=.*\d)(?=.*[OlZSB])[\dOlZSB]{1,4}([-/.])[\dOlZSB]{1,2}\1[\dOlZSB]{1,4}$")
_D = r"[\dlOZSB]{1,3}"
PAGE_LINE = re.compile(
    rf"^(?:(?:p[a@][g9][ec]|p[g9]|p|feui[l1]{{2}}[ec]t|f[o0][l1]i[o0]|sheet)\.?\s*{_D}(?:\s*(?:/|\||sur|of|de)\s*{_D})?|[-–—]\s*{_D}\s*[-–—]|\[\s*{_D}\s*\]|{_D}\s*[/|]\s*{_D})$", re.I
)
_BARE = re.compile(r"^\d{1,2}$")
_CARD = re.compile(r"^\d{2}ZZ\d{5}$")  # identity cards
_STREET_NEXT = re.compile(r"^,?\s*(?:,|rue|av|boulevard|bd|place|quai|chemin|all[ée]e|impasse|[A-Z][a-z]+\s(?:Street|Lane|Avenue|Road|Close))", re.I)


def fold(w: str) -> str:
    return w.lower().translate(_MARKS).replace("œ", "oe").replace("’", "'")


def shape(line: str) -> str:
    """A line with digits masked and look-alikes on one sign."""
    s = re.sub(r"\d+", "9", re.sub(r"(?<=[^\W\d_])[019@†](?=[^\W\d_])", lambda m: {"0": "o", "1": "i", "9": "g", "@": "a", "†": "t"}[m[0]], line.strip().lower().translate(_MARKS).replace("í", "i")))
    return s.replace("rn", "m").replace("ri", "n").replace("ii", "u").replace("c", "e").replace("l", "i").replace("q", "g").replace("\\/", "v").replace("5", "s")


def alike(a: str, b: str) -> bool:
    """Two shapes of one line: equal but for what page numbers and scans change."""
    if a == b:
        return True
    strip = re.compile(r"\s*(?:[-–—|•(\[]?\s*(?:page|p\.?|pg)?\s*9(?:\s*(?:/|sur|of)\s*9)?\s*[)\]]?)$")
    a, b = strip.sub("", a), strip.sub("", b)
    if a == b:
        return bool(a)
    if abs(len(a) - len(b)) > 2 or min(len(a), len(b)) < 6:
        return False
    head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    tail = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), min(len(a), len(b)))
    return max(len(a), len(b)) - head - tail <= 2


def headers_of(lines: list[str], known_lines: frozenset[str]) -> set[int]:
    """Indices of the lines that repeat the head of the pages."""
    first = next((i for i, x in enumerate(lines) if x.strip()), None)
    if first is None:
        return set()
    top = shape(lines[first].lstrip("\f"))
    if top in known_lines or not re.search(r"[^\W\d_]{2}", top):
        return set()
    same = {i for i, x in enumerate(lines) if x.strip() and alike(shape(x.lstrip("\f")), top)}
    return same if len(same) > 1 else set()


def page_lines_of(lines: list[str], heads: set[int]) -> set[int]:
    """Indices of the other lines that only number a page."""
    out = {i for i, x in enumerate(lines) if i not in heads and PAGE_LINE.match(x.strip()) and re.search(r"\d", x)}
    bare = [i for i, x in enumerate(lines) if i not in heads and _BARE.match(x.strip())]
    if bare:
        full = [i for i, x in enumerate(lines) if x.strip() and i not in heads]
        chain, n = [], 1
        for i in bare:
            if int(lines[i]) == n:
                chain.append(i)
                n += 1
        # numbers of pages count up to the last line, or stand right before the head of the next page
        if chain and full and chain[-1] == full[-1]:
            out.update(chain)
        else:
            for i in chain:
                nxt = next((j for j in range(i + 1, len(lines)) if lines[j].strip()), None)
                if nxt is not None and (nxt in heads or lines[nxt].startswith("\f")):
                    out.add(i)
    return out


class Reader:
    """Costs and readings of words by a lexicon of folded words with their counts."""

    def __init__(self, words: Mapping[str, int] | frozenset[str]) -> None:
        self.words = words if isinstance(words, Mapping) else dict.fromkeys(words, 1)
        total = max(sum(self.words.values()), 1)
        self.bits = {w: log2(total / n) for w, n in self.words.items()}
        self.unknown = max(self.bits.values(), default=0.0) + UNKNOWN
        #: A word that costs no more than this has no cheaper reading.
        self.sure = min(self.bits.values(), default=0.0) + CONFUSED
        self.memo: dict[str, tuple[float, str, bool]] = {}
        self.tokens: dict[str, tuple[float, str, str | None, bool]] = {}

    def cost(self, w: str) -> float | None:
        """Bits of a known word, or of a word whose parts are; None if it isn't known."""
        f = fold(w)
        c = self.bits.get(f)
        if c is None and "-" in f:
            parts = [self.bits.get(p) for p in f.split("-")]
            if all(p is not None for p in parts):
                c = max(parts) + OWN_HYPHEN
        return c

    def known(self, w: str) -> bool:
        return self.cost(w) is not None

    def reading(self, w: str) -> tuple[float, str, bool]:
        """(bits, word, misread) of the cheapest reading of one word."""
        if w not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[w] = self._reading(w)
        return self.memo[w]

    def undo(self, w: str) -> str | None:
        """The word that stood here, if confusions explain this one; None for a word of its own accord."""
        _, v, misread = self.reading(w)
        return v if misread else None

    def _reading(self, w: str) -> tuple[float, str, bool]:
        own = self.cost(w)
        strange = bool(STRANGE.search(w))
        stay = own if own is not None else self.unknown + (ODD if strange else 0.0)
        if len(w) < 2 or not strange and (own is not None and own <= self.sure or any(ch.isdigit() for ch in w) and len(w) < 4):
            return stay, w, False
        if strange and fold(w) in self.words and not re.search(r"[@†íì\\]", w):
            return stay, w, False
        best = (stay, w, False)
        step = {w.lower()}
        for depth in (1, 2):
            new = set()
            for v in step:
                for a, b in CONFUSIONS:
                    at = v.find(a)
                    spots = []
                    while at >= 0:
                        spots.append(at)
                        at = v.find(a, at + 1)
                    for p in spots:
                        new.add(v[:p] + b + v[p + len(a) :])
                    if len(spots) > 1:
                        new.add(v.replace(a, b))
            for v in sorted(new):
                if self._plain(v):
                    c = depth * CONFUSED + self.cost(v)
                    if c < best[0]:
                        best = (c, v, True)
            if best[2] or not strange:
                break  # a second confusion only where the first is plain to see and not enough
            step = new
        if not best[2] and strange and re.search(r"[^\W\d_]{2}[019@†5í][^\W\d_]|[^\W\d_][019@†5í][^\W\d_]{2}", w) and sum(ch.isalpha() for ch in w) >= 4 and not re.search(r"\d{2}", w):
            return stay - 1, w.lower().translate(str.maketrans("01@†59í", "oiatsgi")), True  # no word known, yet no word is written so
        return best

    def _plain(self, v: str) -> bool:
        f = fold(v)
        if f in self.words:
            return len(f) > 2 or f in _SHORT
        return "-" in f and len(f) > 5 and all(p in self.words for p in f.split("-"))


_SHORT = frozenset("de du le la un en et au ou of to in on is as at we no".split())


def clean_number(w: str) -> str:
    return w.translate(str.maketrans("OlZSB", "01258"))


def _core(tok: str) -> tuple[str, str, str]:
    """(before, word, after): the token without punctuation and elided article around it."""
    a, b = 0, len(tok)
    while a < b and (tok[a] in _EDGE or tok[a] in "'’" or tok[a] in HYPHENS):
        a += 1
    while b > a and (tok[b - 1] in _EDGE or tok[b - 1] in HYPHENS or tok[b - 1] in "'’" and not (b - a > 2 and tok[b - 2] in "eE")):
        b -= 1
    m = _ELISION.match(tok[a:b])
    if m:
        a += m.end()
    return tok[:a], tok[a:b], tok[b:]


_BLOB = re.compile(r"[\w+/=]{30,}")
_MAIL = re.compile(r"\S+@[\w\-]+(?:\.[\w\-]+)+|\S+(?:\[@\]|\[at\]|\(at\))\S*", re.I)


def _token(tok: str, reader: Reader) -> tuple[float, str, str | None, bool]:
    """(bits, as read, misread word, open): the cheapest reading of one token; open: unknown letters, other arcs may win."""
    if tok in reader.tokens:
        return reader.tokens[tok]
    if len(reader.tokens) > 400_000:
        reader.tokens.clear()
    reader.tokens[tok] = out = _read_token(tok, reader)
    return out


def _read_token(tok: str, reader: Reader) -> tuple[float, str, str | None, bool]:
    if not tok or _BLOB.search(tok) or _MAIL.search(tok):
        return 0.0, tok, None, False
    pre, w, post = _core(tok)
    if not w or not any(ch.isalpha() or ch in "@†" for ch in w):
        return 0.0, tok, None, False
    if _NUM.match(w) or _DATE.match(w):
        if fold(w) not in reader.words and not _CARD.match(w):
            return CONFUSED, pre + clean_number(w) + post, w, False
        return 0.0, tok, None, False
    c, v, misread = reader.reading(w)
    if misread:
        return c, pre + _case_like(v, w) + post, w, not STRANGE.search(w)
    return c, tok, None, c >= reader.unknown and len(w) >= 3


def decode(text: str, reader: Reader, across: bool = False) -> tuple[str, list[tuple[str, str]]]:
    """(repaired text, [(noise_kind, item)]) of a stream of words: the cheapest path through the lattice of its readings.

    across: lines were taken out, so a word may go on after blank lines.
    """
    parts = re.split(r"(\s+)", text)
    toks, gaps = parts[0::2], parts[1::2]
    n = len(toks)
    bits = [0.0] + [1e18] * n
    back: list[tuple[int, str, tuple]] = [(0, "", ())] * (n + 1)

    def offer(j: int, c: float, i: int, out: str, items: tuple) -> None:
        if c < bits[j]:
            bits[j] = c
            back[j] = (i, out, items)

    for i in range(n):
        c0 = bits[i]
        if c0 > 1e17:
            continue  # inside a longer arc
        tok = toks[i]
        c, out, wrong, is_open = _token(tok, reader)
        if wrong is not None and wrong[-1:] == "B" and re.match(r"^\d{1,3}B$", wrong) and (tok.partition(wrong)[2].startswith(",") or _STREET_NEXT.match(" ".join(toks[i + 1 : i + 4]))):
            out, wrong = tok, None  # a house number
        offer(i + 1, c0 + c, i, out, (("misread", wrong),) if wrong is not None else ())
        if i + 1 == n:
            break
        if is_open:
            pre, w, post = _core(tok)
            if w.isalpha() and w.islower():
                if not post and "\n\n" not in gaps[i]:
                    p2, w2, q2 = _core(toks[i + 1])
                    if not p2 and w2.isalpha() and w2.islower() and len(w + w2) > 6 and not reader.known(w2) and fold(w + w2) in reader.bits:
                        offer(i + 2, c0 + TORN + reader.bits[fold(w + w2)], i, pre + w + w2 + q2, ())
                if len(w) > 8:
                    for k in range(4, len(w) - 3):
                        a, b = reader.bits.get(fold(w[:k])), reader.bits.get(fold(w[k:]))
                        if a is not None and b is not None:
                            offer(i + 1, c0 + FUSED + a + b, i, pre + w[:k] + " " + w[k:] + post, ())
        if tok[-1:] in HYPHENS and "\n" in gaps[i]:
            left, j, items, spent = tok, i, [], 0.0
            while j + 1 < n and "\n" in gaps[j] and (across or gaps[j].count("\n") == 1):
                m = _LEFT.search(left)
                r = _RIGHT.match(toks[j + 1]) if m else None
                if not r or "@" in toks[j + 1][r.end() : r.end() + 2] or re.match(r"\S*@\S+\.\S", toks[j + 1]):
                    break
                right = r[1].rstrip("'’-") or r[1]
                more, word = rejoin(m[1], right, left[m.end(1)], reader)
                spent += more
                w = _core(word)[1]
                if w and w.replace("-", "").isalnum() or re.search(r"[@†\\'’]", w):
                    items.append(("hyphenation", w))
                left = left[: m.start(1)] + word + toks[j + 1][r.start(1) + len(right) :]
                j += 1
                c, out, wrong, _ = _token(left, reader)
                offer(j + 1, c0 + spent + min(c, reader.unknown), i, out, (*items, *((("misread", wrong),) if wrong is not None else ())))
    spans: list[str] = []
    found: list[tuple[str, str]] = []
    j = n
    while j > 0:
        i, s, items = back[j]
        spans.append(s)
        found += items
        if i:
            spans.append(gaps[i - 1])
        j = i
    return "".join(reversed(spans)), found


def _case_like(v: str, w: str) -> str:
    letters = [ch for ch in w if ch.isalpha()]
    if len(letters) > 1 and all(ch.isupper() for ch in letters):
        return v.upper()
    return v[:1].upper() + v[1:] if w[:1].isupper() else v


_LEFT = re.compile(rf"([\w'’@†\\/{re.escape(HYPHENS)}]*[^\W\d_])[{HYPHENS}][ \t]*$")
_RIGHT = re.compile(r"[ \t]*([^\W\d_@†][\w'’\-@†\\/]*|[019@†5][a-zà-ÿ][\w'’\-@†]*)")


def rejoin(left: str, right: str, mark: str, reader: Reader) -> tuple[float, str]:
    """(bits of the break, the word) of a word broken at a line end; a hyphen of the word's own stays where that is cheaper.

    A word broken into two unknown ones costs less than these two, as a break is plain to see.
    """
    one, two = left + right, f"{left}-{right}"
    m = _ELISION.match(one)
    skip = m.end() if m else 0
    c1, c2 = reader.bits.get(fold(one[skip:])), reader.bits.get(fold(two[skip:]))
    if c1 is None and (c3 := reader.cost(one[skip:])) is not None and "-" in one[skip:]:
        c1 = c3
    names = mark == "-" and right[:1].isupper() and left[:1].isupper() and not (left.isupper() and right.isupper())
    known = len(right) > 2 and reader.known(right) and reader.known(left[skip:]) and right[:1].isupper() and left[:1].isupper() and not left.isupper()
    own = c2 if c2 is not None else reader.unknown - 1 if names or known else reader.unknown + OWN_HYPHEN
    plain = c1 if c1 is not None else reader.unknown
    return (BROKEN, one) if plain <= own else (BROKEN, two)


def read(text: str, reader: Reader, known_lines: frozenset[str], heads_given: list[str] | None = None, line_record: bool = False, with_text: bool = True) -> tuple[str, list[tuple[str, str]]]:
    """(repaired text, items) of one document or lab line."""
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    items: list[tuple[str, str]] = []
    if line_record:
        tops = [shape(h) for h in heads_given or []]
        heads = {i for i, x in enumerate(lines) if x.strip() and any(alike(shape(x.lstrip("\f")), t) for t in tops)} if tops else set()
        pages = set()
        for i, x in enumerate(lines):
            s = x.strip()
            if i in heads or not s:
                continue
            if PAGE_LINE.match(s) and re.search(r"\d", s):
                pages.add(i)
            elif i and _BARE.match(s):
                before = " ".join(y for k, y in enumerate(lines[:i]) if k not in heads)
                if re.search(r"(?:[:=|\t]|\.{3,})\s*[<>≤≥]?\s*[\wÀ-ÿ]|\d\s*\S*$", before) and not re.search(r"(?:\.{3,}|[:=|\t])\s*$", before):
                    pages.add(i)
    else:
        heads = headers_of(lines, known_lines)
        pages = page_lines_of(lines, heads)
    items += [("running_header", lines[i].replace("\f", "").strip()) for i in sorted(heads)]
    items += [("page_number", lines[i].replace("\f", "").strip()) for i in sorted(pages)]
    body = [x.replace("\f", "") for i, x in enumerate(lines) if i not in heads and i not in pages]
    fixed, more = decode("\n".join(body), reader, across=bool(heads or pages))
    return (fixed if line_record or not with_text else paragraphs(fixed, known_lines)), items + more


def paragraphs(text: str, known_lines: frozenset[str] = frozenset()) -> str:
    """Lines joined into paragraphs; the boundaries of least cost are chosen by dynamic programming.

    Joining two lines costs when the first ends a sentence or is short, or the second starts like a
    heading, a table row or a list item; parting them costs when the first runs on.
    """
    blocks = re.split(r"\n[ \t]*\n+", text)
    out = []
    for block in blocks:
        lines = [x.strip() for x in block.split("\n") if x.strip()]
        if not lines:
            continue
        width = max(len(x) for x in lines)

        def runs_on(a: str, b: str) -> float:
            """Positive: a and b belong together."""
            s = 0.0
            table = re.compile(r"\t|\||\.{4,}|^[^.]{2,60}\s[:=]\s")
            if table.search(a) or table.search(b):
                return -5.0
            if shape(a) in known_lines or shape(b) in known_lines:  # headings
                return -6.0
            s += 2.0 if len(a) > 0.75 * width and len(a) > 40 else -1.0
            s += 1.5 if b[:1].islower() or b[:1].isdigit() else 0.0
            s += -1.0 if a[-1:] in ".!?:" else 1.0
            if re.match(r"^[A-ZÀ-Þ][A-ZÀ-Þ '’]{3,60}:?$|^[A-ZÀ-Þ][^.]{2,40}\s:$", a) or re.match(r"^[A-ZÀ-Þ][A-ZÀ-Þ '’]{3,60}:?$", b):
                s -= 6.0
            return s

        # best[j]: (cost, start of the last paragraph) for the lines before j
        gain = [0.0] + [runs_on(a, b) for a, b in zip(lines, lines[1:])]
        total = [0.0]
        for g in gain[1:]:
            total.append(total[-1] + g)
        best: list[tuple[float, int]] = [(0.0, 0)]
        low = (0.0, 0)  # min over i of best[i] + total of the joins before i
        for j in range(1, len(lines) + 1):
            best.append((low[0] - total[j - 1], low[1]))
            if j < len(lines):
                here = best[j][0] + total[j]
                if here < low[0]:
                    low = (here, j)
        cuts = []
        j = len(lines)
        while j > 0:
            i = best[j][1]
            cuts.append((i, j))
            j = i
        out.append("\n".join(" ".join(lines[i:j]) for i, j in reversed(cuts)))
    return "\n\n".join(out)


# --- the lexicon ------------------------------------------------------------------------------------
_LEX = re.compile(r"[^\W_]+(?:[-'’][^\W\d_]+)*")


def lexicon(docs: DataFrame) -> tuple[dict[str, int], frozenset[str]]:
    """(folded words with the documents they stand in, shapes of short lines) of the unscanned documents."""
    clean = docs.where("page_scan = false")
    if clean.limit(1).count() == 0:
        clean = docs

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])
            words.clear()
            return b

        for b in batches:
            for t in b.column(0).to_pylist():
                if not t:
                    continue
                own = set()
                for m in _LEX.finditer(t):
                    w = fold(m[0])
                    e = _ELISION.match(w)
                    own.add(w[e.end() :] if e else w)
                    if "-" in w:
                        own.update(p for p in w.split("-") if len(p) > 2)
                lines = t.replace("\r", "").split("\n")
                own.update("\n" + shape(x) for x in lines if 0 < len(x.strip()) <= 40 and not re.search(r"\d", x))
                words.update(own)
            if len(words) > 300_000:
                yield out()
        if words:
            yield out()

    stats = cut(clean.select("full_text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "lexicon")
    least = max(MIN_DOCS, int(clean.count() * SHARE))
    rows = stats.where(F.col("n") >= least).collect()  # bounded by SHARE, whatever the corpus
    return {r["word"]: r["n"] for r in rows if r["word"][:1] != "\n"}, frozenset(r["word"][1:] for r in rows if r["word"][:1] == "\n")


_READERS: dict[int, Reader] = {}


def reader_of(shared) -> Reader:
    """One reader per worker process and lexicon, with what it has read so far."""
    key = id(shared.value)
    if key not in _READERS:
        _READERS.clear()
        _READERS[key] = Reader(shared.value[0])
    return _READERS[key]


def noise(docs: DataFrame, lines: DataFrame, with_text: bool = True) -> DataFrame:
    """(record_kind, record_id, text, items) of every scanned document and lab line; document_id keeps the link.

    with_text=False leaves the repaired text out, so nothing but the items is written or moved.
    """
    words, known = lexicon(docs)
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((words, known))  # bounded by SHARE
    kind = "array<struct<noise_kind:string,item:string>>"

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = reader_of(shared)
        for pdf in batches:
            rows = []
            for i, t in zip(pdf["document_id"], pdf["full_text"]):
                fixed, items = read(t, reader, shared.value[1], with_text=with_text)
                rows.append(("parsed_document", i, i, fixed if with_text else None, [{"noise_kind": k, "item": v} for k, v in dict.fromkeys(items)]))
            yield pd.DataFrame(rows, columns=["record_kind", "record_id", "document_id", "text", "items"])

    schema = f"record_kind string, record_id string, document_id string, text string, items {kind}"
    scanned = docs.where("page_scan is null or page_scan").where("full_text is not null").select("document_id", "full_text")
    of_docs = cut(scanned.mapInPandas(documents, schema), "pages")
    top = F.transform(F.filter("items", lambda x: x["noise_kind"] == "running_header"), lambda x: x["item"])
    heads = of_docs.groupBy("document_id").agg(F.max(top).alias("heads"))  # repeated rows of a document agree

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = reader_of(shared)
        for pdf in batches:
            rows = []
            for i, d, t, h in zip(pdf["line_id"], pdf["document_id"], pdf["raw_text"], pdf["heads"]):
                fixed, items = read(t, reader, shared.value[1], list(h) if h is not None else [], line_record=True)
                rows.append(("lab_line", str(i), d, fixed if with_text else None, [{"noise_kind": k, "item": v} for k, v in dict.fromkeys(items)]))
            yield pd.DataFrame(rows, columns=["record_kind", "record_id", "document_id", "text", "items"])

    # lines of documents known not to be scanned are left alone; those of unknown documents are read
    plain = docs.where("page_scan = false").select("document_id").distinct()
    read_lines = lines.where("raw_text is not null and raw_text <> ''").select("line_id", "document_id", "raw_text").join(plain, "document_id", "left_anti")
    of_lines = read_lines.join(heads, "document_id", "left").mapInPandas(rows_of, schema)
    return of_docs.unionAll(of_lines)


def p2_found(docs: DataFrame, lines: DataFrame) -> DataFrame:
    n = noise(docs, lines, with_text=False).select("record_kind", "record_id", "document_id", F.explode("items").alias("i"))
    both = F.array(F.struct("record_kind", "record_id"), F.struct(F.lit("parsed_document").alias("record_kind"), F.col("document_id").alias("record_id")))
    return n.select(F.explode(F.array_distinct(both)).alias("r"), "i").select("r.record_kind", "r.record_id", "i.noise_kind", "i.item").distinct()


def p2_repaired(docs: DataFrame, lines: DataFrame) -> DataFrame:
    return noise(docs, lines).select("record_kind", "record_id", "text")
