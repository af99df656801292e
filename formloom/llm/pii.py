"""Problem 1: personal information inside free text, found and replaced by typed placeholders.

Offset-preserving transducers rewrite the text (look-alike letters, blanks, words broken at line ends,
at/dot disguises with or without brackets, numbers said in words) while keeping, for every character, the
source characters it came from. Identifiers are detected in the rewritten text; spans are mapped back, so
surfaces stand exactly as in the source and the rest of the text stays as it was.

A person is a run of name-like words next to a title, a cue or a given name, or before what only a person
does. Both sides are learned from the whole corpus (`Names`): ordinary words are those that also stand in
lower case or open sentences; given names are those that stand, after titles and cues, before another name
or behind the label of a first name.

Edge cases: null and empty texts give no rows and stay as they are; overlapping hits keep the earlier
kind in the order e-mail, telephone, identity number, address, person; one row per distinct
(record, kind, surface); very long texts are read whole; repeated rows give one set of rows; empty
tables give none; extra columns are kept by `redact`.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.session import cut

#: Least uses of a learned word: this many, and this share of all words. So at most 1 / SHARE words are learned
#: of a corpus of any size.
LEAST, SHARE = 3, 1e-6
#: A name runs on over a line end only where the line is long enough to be a wrapped one.
WRAPPED = 40

# --- fixed values ---------------------------------------------------------------------------------
LOOKALIKE = str.maketrans(
    "АВЕКМНОРСТХаеорсухіїѕјΑΒΕΖΗΙΚΜΝΟΡΤΥΧοíìＡ０１２３４５６７８９＠．†‐‑–     　",
    "ABEKMHOPCTXaeopcyxiisjABEZHIKMNOPTYXoiiA0123456789@.t---      ",
)
TITLES = r"(?:Dr|Docteur|Docteure|Doctor|Pr|Prof|Professeur|Professor|Mme|Mlle|Madame|Mademoiselle|Monsieur|MM|Mr|Mrs|Ms|Miss|Sir|Nurse|Sister)"
CUES = (
    r"(?:[Pp]atiente?|PATIENTE?|[Ss]ign[ée]e?(?=\s*:)|[Ss]igned(?: by)?|[Nn]om(?: de naissance| d'usage)?|NOM|[Pp]r[ée]noms?|[Nn]ame|[Ss]urname|[Ff]orename|[Cc]ontact|[Pp]ersonne de confiance"
    r"|[Nn]ext of kin|[Aa]ppel de|[Pp]our|[Ff]or|fr[èe]re de|s[oœ]eur de|[Bb]rother of|[Ss]ister of|sign[ée]e? par|signed by|organis[ée]e? par|[Dd]ict[ée]e? par|[Dd]ictated by"
    r"|[Rr]elue? par|[Rr]eviewed by|[Rr]ead by|[Vv]u par|[Ss]een by|[Ss]een with|fils du patient,|fille du patient,|conjointe?,|[Cc]opie|[Cc]opies|[Mm][ée]decin traitant|[Gg]eneral practitioner"
    r"|[Ii]nfirmi[èe]re?|[Ii]nfirmier|demander|communiqu[ée] [àa]|adress[ée] au?|copied to)"
)
#: Titles, labels and function words, which stand beside names and are none.
NOT_NAMES = frozenset(
    """ins ipp i.p.p nip nir nhs cni secu tel tél fax mobile portable mail email courriel domicile home contact nom prenom patient patiente signe signed copie copies passport passeport immatriculation
    labo laboratoire laboratory chu ch institut centre clinique hospital hopital general unite service page pg feuillet numero number no identifiant code personne
    code le la les un une il elle on en au aux des du de l' a an the please this that there we et and pour for par by frere brother soeur sister next appel dictated reviewed consent seen vue vu
    dr docteur docteure doctor pr prof professeur professor mme mlle madame mademoiselle monsieur mr mrs ms miss sir nurse l'infirmiere infirmiere infirmier medecin""".split()
)
STREETS = r"(?:rue|avenue|av\.|boulevard|bd|bld|place|pl\.|quai|chemin|ch\.|all[ée]e|impasse|cours|route|square|sentier|passage|faubourg|villa|cit[ée]|rond-point|esplanade|mail|promenade|voie|ruelle)"
UK_STREETS = r"(?:Street|Lane|Avenue|Road|Close|Drive|Way|Gardens?|Crescent|Terrace|Court|Place|Square|Grove|Hill|Mews|Row|Walk|Park|St|Rd)"
#: Numbers in words (fixed values): what they are worth, by their word.
UNITS = {w: d for d, ws in enumerate((
    "zéro zero oh", "un une one", "deux two", "trois three", "quatre four", "cinq five", "six", "sept seven", "huit eight", "neuf nine", "dix ten", "onze eleven", "douze twelve", "treize thirteen",
    "quatorze fourteen", "quinze fifteen", "seize sixteen", "dix-sept seventeen", "dix-huit eighteen", "dix-neuf nineteen")) for w in ws.split()}
TENS = {w: 10 * d for d, ws in enumerate(("vingt twenty", "trente thirty", "quarante forty", "cinquante fifty", "soixante sixty", "septante seventy", "huitante octante quatre-vingt quatre-vingts eighty", "nonante ninety"), 2) for w in ws.split()}
TIMES = {"double": 2, "triple": 3}


# --- transducers ------------------------------------------------------------------------------------
class Tape:
    """A text with, for each character, where its source begins (`at`) and ends (`end`)."""

    def __init__(self, text: str, at: list[int] | None = None, end: list[int] | None = None) -> None:
        self.text, self.at, self.end = text, at, end

    def rewrite(self, pattern: re.Pattern, to) -> Tape:
        """Replaces each match; the characters put in stand for the whole match."""
        out: list[str] = []
        at: list[int] = []
        end: list[int] = []
        last = 0

        def keep(a: int, b: int) -> None:
            out.append(self.text[a:b])
            at.extend(range(a, b) if self.at is None else self.at[a:b])
            end.extend(range(a + 1, b + 1) if self.end is None else self.end[a:b])

        for m in pattern.finditer(self.text):
            new = to(m)
            if new is None:
                continue
            a, b = m.span()
            keep(last, a)
            x, y = self.span(a, b)
            out.append(new)
            at.extend([x] * len(new))
            end.extend([y] * len(new))
            last = b
        if not out:
            return self
        keep(last, len(self.text))
        return Tape("".join(out), at, end)

    def span(self, a: int, b: int) -> tuple[int, int]:
        """Source span of text[a:b]: from where its first character begins to where its last one ends."""
        return (a, b) if self.at is None else (self.at[a], self.end[b - 1])


_ALIKE = re.compile("[" + "".join(map(chr, LOOKALIKE)) + "]")
_BROKEN = re.compile(r"(?<=\w)[-¬­] ?\r?\n[ \t]*(?=\w)")
_AT = re.compile(r"(?<=[\w])(?: ?[\[(] ?(?:at|arobase|@) ?[\])] ?| (?:arobase|AROBASE) | @ )(?=\w)", re.I)
_DOT = re.compile(r"(?<=[\w])(?: ?[\[(] ?(?:dot|point) ?[\])] ?| (?:dot|point) )(?=\w+(?:[\s.)\]]|$))", re.I)
#: at and dot said without brackets: the host ends in a said dot and letters.
_BARE_AT = re.compile(r"(?<=\w) (?:at|arobase|chez) (?=[\w\-]+(?:(?: (?:dot|point) |\.)[\w\-]+)* (?:dot|point) [A-Za-z]{2,}\b)", re.I)
_BARE_DOT = re.compile(r"(?<=\w) (?:dot|point) (?=[\w\-]+(?: (?:dot|point) [\w\-]+)*@)", re.I)
_NUMBER_WORD = "|".join(sorted({*UNITS, *TENS, *TIMES, "cent", "cents"}, key=len, reverse=True))
_SAID = re.compile(rf"(?<![\w\-])(?:{_NUMBER_WORD}|\d{{1,4}})(?:[ \-]+(?:et[ \-]+)?(?:{_NUMBER_WORD}|\d{{1,4}})(?!\w)){{3,}}", re.I)
_PART = re.compile(rf"\d+|(?:{_NUMBER_WORD})(?![\w])", re.I)


def said_number(words: list[str]) -> str:
    """The digits of numbers said one after the other, each below a thousand."""
    out: list[str] = []
    i, n = 0, len(words)
    times = 1
    while i < n:
        w = words[i]
        i += 1
        if w in TIMES:
            times = TIMES[w]
            continue
        if w.isdigit():
            out.append(w * times)
        elif w in ("cent", "cents") or w in UNITS and 1 < UNITS[w] < 10 and i < n and words[i] in ("cent", "cents"):
            value = 100
            if w in UNITS:
                value, i = 100 * UNITS[w], i + 1
            if i < n and words[i] in TENS:
                value, i = value + TENS[words[i]], i + 1
            if i < n and words[i] in UNITS and UNITS[words[i]] and (value % 100 == 0 or UNITS[words[i]] < 10):
                value, i = value + UNITS[words[i]], i + 1
            out.append(str(value))
        elif w in TENS or w == "quatre" and i < n and words[i] in ("vingt", "vingts"):
            value = TENS.get(w)
            if value is None:
                value, i = 80, i + 1
            if i < n and words[i] in UNITS and 0 < UNITS[words[i]] < (20 if w in ("soixante", "quatre", "quatre-vingt", "quatre-vingts") else 10):
                value, i = value + UNITS[words[i]], i + 1
            out.append(str(value))
        else:
            out.append(str(UNITS[w]) * times)
        times = 1
    return "".join(out)


def _in_digits(m: re.Match) -> str | None:
    """A run of numbers said in words, in digits; what holds no word or is too short or long for an identifier stays."""
    words = [w.lower() for w in _PART.findall(m[0])]
    said = [i for i, w in enumerate(words) if not w.isdigit()]
    if not said:
        return None
    figures = [i for i, w in enumerate(words) if w.isdigit()]
    if sum(len(words[i]) for i in figures) > 8 and (said[0] > figures[-1] or said[-1] < figures[0]):
        return None  # an identifier in figures with a number beside it
    digits = said_number(words)
    return digits if 9 <= len(digits) <= 16 else None


def normalise(text: str) -> Tape:
    t = Tape(text.translate(LOOKALIKE) if _ALIKE.search(text) else text)  # one character for one
    if "\n" in t.text:
        # a word broken at a line end is one word; a hyphen before a capital or digit is the word's own
        t = t.rewrite(_BROKEN, lambda m: "-" if m[0][0] == "-" and (m.string[m.end()].isupper() or m.string[m.end()].isdigit()) else "")
    if "­" in t.text:
        t = t.rewrite(re.compile("­"), lambda m: "")
    low = t.text.lower()
    if "arobase" in low or "[" in low or "(" in low or " @ " in low:
        t = t.rewrite(_AT, lambda m: "@")
        if "dot" in low or "point" in low:
            t = t.rewrite(_DOT, lambda m: "." if "@" in m.string[max(0, m.start() - 60) : m.end() + 60] and re.search(r"@[\w.\-]*$", m.string[: m.start()][-60:]) else None)
    if " dot " in low or " point " in low:
        t = t.rewrite(_BARE_AT, lambda m: "@")
        if "@" in t.text:
            t = t.rewrite(_DOT, lambda m: "." if re.search(r"@[\w.\-]*$", m.string[max(0, m.start() - 60) : m.start()]) else None)
            while True:  # a dot behind a dot
                new = t.rewrite(_DOT, lambda m: "." if re.search(r"@[\w.\-]*$", m.string[max(0, m.start() - 60) : m.start()]) else None)
                if new is t:
                    break
                t = new
            t = t.rewrite(_BARE_DOT, lambda m: ".")
    return t.rewrite(_SAID, _in_digits) if any(w in low for w in _TELLING) and _SPOKEN.search(low) else t


#: Parts of number words of which any identifier said in words has one.
_TELLING = ("zéro", "zero", "deux", "trois", "quatre", "cinq", "sept", "huit", "neuf", "douze", "treize", "quinze", "seize", "trente", "soixante", "double", "two", "three", "four", "five", "seven", "eight", "nine", "eleven", "twelve", "teen", "ty-", "ty ")
_SPOKEN = re.compile(rf"(?<![\w\-])(?:{_NUMBER_WORD})[ \-]+(?:et[ \-]+)?(?:(?:{_NUMBER_WORD})\b|\d)|\d[ \-]+(?:{_NUMBER_WORD})[ \-]+\d")


# --- detectors ----------------------------------------------------------------------------------------
_S = r"(?:[ .\-]|\s*\n[ \t]*)?"  # between groups of digits
EMAIL = re.compile(r"(?<![\w.+\-@])[A-Za-z0-9_][\w.+\-]*@[A-Za-z0-9](?:[\w\-]*[\w])?(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}(?![\w@])")
PHONE = re.compile(
    rf"(?<![\w+])(?<!\d[ .\-])(?:(?:\+|00)33{_S}(?:\(0\){_S})?[1-9](?:{_S}\d{{2}}){{4}}|0[1-9](?:{_S}\d{{2}}){{4}}"
    rf"|(?:\+|00)44{_S}(?:\(0\){_S})?(?:\d{{2}}{_S}\d{{4}}{_S}\d{{4}}|\d{{4}}{_S}\d{{3}}{_S}\d{{3}}|\d{{3}}{_S}\d{{3}}{_S}\d{{4}})"
    rf"|\(0\d{{2,4}}\){_S}\d{{3,4}}{_S}\d{{3,4}}|0\d{{2}}{_S}\d{{4}}{_S}\d{{4}}|0\d{{4}}{_S}\d{{6}}|0\d{{4}}{_S}\d{{3}}{_S}\d{{3}})(?![\w])(?![ .\-]\d\d)"
)
NIR = re.compile(rf"(?<![\w])(?<!\d[ .\-])[12378](?:{_S}\d{{2}}){{2}}{_S}(?:\d{{2}}|2[AB]){_S}\d{{3}}{_S}\d{{3}}(?:{_S}\d{{2}})(?![\w])(?![ .\-]\d\d)")
PASS = re.compile(r"(?<![\w])\d{2}[A-Z]{2}\d{5}(?![\w])")
ID_NUMBER = re.compile(rf"(?<![\w])[A-Z]?\d(?:{_S}\d){{6,14}}(?![\w])")
ID_CUE_END = re.compile(
    r"(?:\bI\.?P\.?P\.?|\bNIP|identifiant permanent(?: du patient)?|n°\s?(?:de\s)?(?:patient|dossier)(?:\shospitalier)?|num[ée]ro\s(?:de\s)?patient(?:\shospitalier)?|NHS\s(?:no\.?|number|num)|hospital\s(?:no\.?|number)|patient\s(?:no\.?|number|id)|\bMRN"
    r"|\bINS|\bNIR|immatriculation|s[ée]cu(?:rit[ée]\ssociale)?|num[ée]ro\sd'assur[ée]|CNI|carte\sd'identit[ée]|passeport|passport|identity\scard)(?:\s?n°)?\s*[:.]?\s*$", re.I,
)
_G = r"(?: |[ ]?\r?\n[ \t]*)"
_ART = r"(?:(?:de\s(?:la|l['’])|du|des|de|d['’]|la|le|les)\s?)"
_W = r"[A-ZÀ-ÖØ-Þ][\wÀ-ÿ'’]*(?:-[\wÀ-ÿ]+)*"
_TOWN = rf"(?:(?:L[ea]s?|LES?|LA)\s)?{_W}"
ADDRESS = re.compile(
    rf"(?<![\w])\d{{1,4}}(?:\s?(?:bis|ter|quater)\b|\s?[A-D]\b)?\s?,?{_G}{STREETS}{_G}(?:{_ART}{_G}?)*{_W}(?:{_G}(?:{_ART}{_G}?)?{_W}){{0,3}}(?:(?:\s?,{_G}|\s-{_G}|{_G})\d{{5}}{_G}{_TOWN})?"
    rf"|(?<![\w])\d{{1,4}}[A-D]?\s(?:{_W}\s){{1,3}}{UK_STREETS}\b(?:,\s(?:{_W}\s){{1,3}}[A-Z]{{1,2}}\d[\dA-Z]?\s\d[A-Z]{{2}}\b)?",
)
_LET = r"[a-zà-öø-ÿ'’0-9\\/]"
_TOK = re.compile(
    r"(?P<p>(?:de\sla|DE\sLA|De\sla|du|DU|de|DE)(?=\s[A-ZÀ-ÖØ-Þ])|(?<!\w)d['’](?=[A-ZÀ-ÖØ-Þ]))"
    rf"|(?<![\w/])(?P<i>[A-ZÀ-ÖØ-Þ]\.(?:-[A-ZÀ-ÖØ-Þ]\.)*|[A-ZÀ-ÖØ-Þ](?![\w.'’\-]))|(?P<w>(?:[A-ZÀ-ÖØ-Þ]{_LET}+|[A-ZÀ-ÖØ-Þ][A-ZÀ-ÖØ-Þ0-9]+(?<![0-9]))(?:-(?:[A-ZÀ-ÖØ-Þ]{_LET}+|[A-ZÀ-ÖØ-Þ]{{2,}}))*)(?![\w@†])"
)
_ARTICLE = frozenset(("Le", "LE", "La", "LA"))
_TITLE_END = re.compile(rf"(?:\b{TITLES}\.?|(?<![\w.])M\.)\s+$")
_CUE_END = re.compile(rf"(?<!\w){CUES}\s*[:|]?\s*$")
#: The last words of titles and cues, to tell quickly where none can stand.
_LAST = frozenset(
    """dr docteur docteure doctor pr prof professeur professor mme mlle madame mademoiselle monsieur mm m mr mrs ms miss sir nurse sister patient patiente signé signée signe signee signed by nom naissance d'usage prénom prénoms prenom prenoms name
    surname forename contact confiance kin de of pour for par copie copies traitant practitioner infirmier infirmière infirmiere demander à a au to with conjoint conjointe""".split()
)
#: What only a person does or is, after one name and after two (grammar, fixed values).
_LIVES = re.compile(r"\s(?:habite|lives at|souhaite recevoir|viendra chercher|demeurant)\b")
_AFTER = re.compile(
    r"\s(?:,\s)?(?:(?:a|avait) été (?:vue?|reçue?|adressée?|hospitalisée?|opérée?|suivie?|admise?|prévenue?|informée?|convoquée?)|est (?:né|venu|suivi|âgé|adressé|hospitalisé|décédé)e?|né(?:e)? le|âgée? de|habite|demeurant|demeure|souhaite|viendra|accepte|refuse|consulte|se plaint"
    r"|lives at|was (?:seen|born|admitted|referred|reviewed|told|informed)|is a \d+|attended|presented with|agrees|declined|wishes|complains)\b"
)
#: Names of diseases, scores and signs are no persons (grammar, fixed values).
_EPONYM_BEFORE = re.compile(r"\b(?:scores?|signes?|classifications?|espaces?|formules?|indices?|stades?|maladies?|syndromes?|triades?|critères|coefficient|clairance|test|selon|score|sign|space|disease|formula|pouch|criteria|according to)(?: (?:de|of|du))? (?:d['’])?$", re.I)
_EPONYM_AFTER = re.compile(r"\s(?:signs?|scores?|space|disease|syndrome|criteria|stage|grade|formula)\b")
_CELL_END = re.compile(r"[Cc]ontact\s*\|[^|\n]{2,40}\|\s*$")
_MARKS = str.maketrans("àâäáãåçéèêëíìîïñóòôöõúùûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")


def plain(w: str) -> str:
    return w.lower().translate(_MARKS).replace("œ", "oe").replace("’", "'")


@dataclass(frozen=True)
class Names:
    """What the corpus tells of words: which are ordinary, and which are given names."""

    ordinary: frozenset[str]
    given: frozenset[str] = frozenset()
    #: What each token was taken for, so far.
    memo: dict[str, str | None] = field(default_factory=dict, compare=False, repr=False)


_BAR_CODE = re.compile(r"(?:barres?\s(?:du\s\w+\s)?|bar\scode\s)$", re.I)
_DIGIT = re.compile(r"\d")


def find(text: str, names: Names) -> list[tuple[int, int, str]]:
    """(start, end, kind) in the source text, not overlapping, in order."""
    t = normalise(text)
    s = t.text
    taken: list[tuple[int, int, str]] = []
    busy = bytearray(len(s) + 1)

    def take(a: int, b: int, kind: str) -> None:
        if not any(busy[a:b]):
            busy[a:b] = b"\1" * (b - a)
            taken.append((a, b, kind))

    if "@" in s:
        for m in EMAIL.finditer(s):
            take(*m.span(), "email")
    if _DIGIT.search(s):
        for m in ID_NUMBER.finditer(s):
            if ID_CUE_END.search(s, max(0, m.start() - 50), m.start()):
                take(*m.span(), "id_number")
        for m in NIR.finditer(s):
            if not _BAR_CODE.search(s, max(0, m.start() - 25), m.start()):
                take(*m.span(), "id_number")
        for m in PASS.finditer(s):
            take(*m.span(), "id_number")
        for m in PHONE.finditer(s):
            if not _BAR_CODE.search(s, max(0, m.start() - 25), m.start()):
                take(*m.span(), "phone")
        for m in ADDRESS.finditer(s):
            take(*m.span(), "address")
    for a, b in _persons(s, busy, names):
        take(a, b, "person")
    out = []
    for a, b, kind in sorted(taken):
        x, y = t.span(a, b)
        out.append((x, y, kind))
    return out


def _persons(s: str, busy: bytearray, names: Names) -> Iterator[tuple[int, int]]:
    ordinary, first_names = names.ordinary, names.given
    chain: list[tuple[int, int, str, str]] = []  # start, end, kind (i, w, p), word

    memo = names.memo

    def named(tok: str) -> str | None:
        if tok not in memo:
            if len(memo) > 200_000:
                memo.clear()
            memo[tok] = judged(tok)
        return memo[tok]

    def judged(tok: str) -> str | None:
        low = plain(tok)
        if low in first_names:
            return "g"
        if low in NOT_NAMES or low in ordinary:
            return None
        if "-" in low:
            parts = low.split("-")
            if parts[0] in first_names and all(p not in ordinary or p in first_names for p in parts):
                return "g" if all(p in first_names for p in parts) else "w"
            return "w" if any(p not in ordinary for p in parts) else None
        if sum(ch.isdigit() for ch in low) * 2 > len(low):
            return None
        return "w"

    def close() -> Iterator[tuple[int, int]]:
        toks = chain[:]
        chain.clear()
        while toks and (toks[-1][2] == "p" or toks[-1][3] in _ARTICLE):
            toks.pop()
        while toks and toks[0][2] == "p" and toks[0][3] in ("de", "DE", "du", "DU") and len(toks) == 1:
            toks.pop(0)
        if not toks or not any(k in "gw" for _, _, k, _ in toks):
            return
        before = s[max(0, toks[0][0] - 32) : toks[0][0]]
        given = any(k == "g" for _, _, k, _ in toks)
        words = before.rstrip(" \n\t:|.,").rsplit(None, 1)
        cued = bool(words) and words[-1].lower().lstrip("(.-;:|,") in _LAST
        title = cued and bool(_TITLE_END.search(before, max(0, len(before) - 18)))
        if toks[0][3] == "M." and not title:
            toks.pop(0)  # Monsieur
            title = True
            if not toks:
                return
        if not title and (_EPONYM_BEFORE.search(before) or _EPONYM_AFTER.match(s, toks[-1][1])):
            return
        told = _LIVES.match(s, toks[-1][1]) or sum(k == "w" for _, _, k, _ in toks) > 1 and _AFTER.match(s, toks[-1][1])
        cue = cued and bool(_CUE_END.search(before))
        if given or title or told or cue or "|" in before and _CELL_END.search(before):
            # a lone initial at the end belongs to the run; an article before the first word does where a name follows
            a, b = toks[0][0], toks[-1][1]
            if toks[0][2] == "p" and not title and not given and not cue:
                a = toks[1][0]
            elif toks[0][2] == "p" and given and not title and not cue and toks[0][3].islower():
                a = toks[1][0]
            if toks[-1][2] == "i" and len(toks) == 1:
                return
            if s[b - 1] == "." and toks[-1][2] == "i":
                b -= 1
            yield a, b

    last = -1
    for m in _TOK.finditer(s):
        a, b = m.span()
        if busy[a]:
            if chain:
                yield from close()
            last = -1
            continue
        kind = m.lastgroup
        tok = m[0]
        gap = s[last:a] if last >= 0 and a - last < 40 else None
        joined = gap is not None and (gap == " " or gap == "  " or "\n" in gap and re.fullmatch(r" ?\r?\n[ \t]*", gap) is not None and last - s.rfind("\n", 0, last) > WRAPPED or gap == "" and chain and chain[-1][3].endswith(("'", "’")))
        if kind == "w":
            if tok in _ARTICLE:
                nxt = _TOK.match(s, b + 1) if b + 1 < len(s) and s[b] in " \n" else None
                kind = "p" if nxt and nxt.lastgroup == "w" and named(nxt[0]) == "w" else None
            else:
                kind = named(tok)
        if chain and (not joined or kind is None):
            yield from close()
        if kind is None:
            last = -1
            continue
        if kind == "i" and joined and chain and "\n" in gap and not tok.endswith("."):
            yield from close()
            last = -1
            continue
        if joined and chain and chain[-1][2] == "i" and "." not in chain[-1][3] and kind in "gw":
            yield from close()  # a bare initial ends its run
        if kind == "g" and chain and all(k == "p" or k == "w" and not t.isupper() for _, _, k, t in chain):
            yield from close()  # only a surname in capitals goes before a given name
        chain.append((a, b, kind, tok))
        last = b
    yield from close()


# --- what the corpus tells of words ---------------------------------------------------------------------
_WORD = re.compile(r"(?<![\w@.+\-])[^\W\d_]{2,}(?!\w|@|\+|\s?[\[(@]|\sarobase)")
#: Words that open sentences and paragraphs; what may stand before a sentence that a word opens.
_OPEN = re.compile(r"[.!?] ([A-ZÀ-ÖØ-Þ][a-zà-ÿ]+)(?= ?[a-zà-ÿ'’(:])")
_ENDS = re.compile(r"(?<![Pp]rof)(?<!octeur)(?<!Copie)(?<!Mme)(?<!Mlle)(?<=[a-zà-ÿ0-9)%]{2})[.!?]")
_PARAGRAPH = re.compile(r"(?:\A|\n\s*\n\s*)([A-ZÀ-ÖØ-Þ][a-zà-ÿ]+)(?= ?[a-zà-ÿ'’(:])")


def opening_words(text: str) -> Iterator[str]:
    for m in _OPEN.finditer(text):
        if _ENDS.match(text, m.start()):
            yield m[1].lower()
    for w in _PARAGRAPH.findall(text):
        yield w.lower()


_NAME = r"[A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ'’]+(?:-[A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]+)*"
_UPPER = r"[A-ZÀ-ÖØ-Þ][A-ZÀ-ÖØ-Þ'’\-]+"
#: Two words of which one may be given, the other a surname; what must stand before them.
_TWO = re.compile(rf"(?<![\w.'’\-])(?!{TITLES}\b)(?:({_NAME})\s(?:(?:de la|DE LA|de|du|DE|DU|La|Le|LE)\s|d['’])?({_NAME}|{_UPPER})|({_UPPER})\s({_NAME}))(?![\w'’\-])")
_SURE = re.compile(
    rf"(?:\b{TITLES}\.?|(?<![\w.])M\.|\b(?:[Pp]atiente?|[Ss]ign[ée]e?(?: par)?|[Ss]igned(?: by)?|[Nn]om|[Nn]ame|[Ss]urname|[Cc]ontact|[Dd]ict[ée]e? par|[Dd]ictated by|[Vv]u par|[Ss]een by|[Aa]ppel de|[Rr]eviewed by|[Rr]elue? par)\s*[:|]?)\s+$"
)
_FIRST = re.compile(rf"(?:[Pp]r[ée]noms?|PR[ÉE]NOMS?|[Ff]orename|[Ff]irst name)\s*[:|]\s*({_NAME})")


def word_statistics(texts: DataFrame, col: str = "text") -> DataFrame:
    """(word, uses, common, given, surname) over the whole corpus; every task sums before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        opens: Counter[str] = Counter()
        given: Counter[str] = Counter()
        surname: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            uses: Counter[str] = Counter()
            common: Counter[str] = Counter(opens)
            for w, n in words.items():
                uses[w.lower()] += n
                if w[0].islower():
                    common[w] += n
            all_words = [*{**uses, **given, **surname, **common}]
            for c in (words, opens):
                c.clear()
            cols = [pa.array([c[w] for w in all_words], pa.int64()) for c in (uses, common, given, surname)]
            given.clear()
            surname.clear()
            return pa.RecordBatch.from_arrays([pa.array(all_words, pa.string()), *cols], ["word", "uses", "common", "given", "surname"])

        for b in batches:
            for t in b.column(0).to_pylist():
                if not t:
                    continue
                words.update(_WORD.findall(t))
                opens.update(opening_words(t))
                for m in _TWO.finditer(t):
                    if _SURE.search(t, max(0, m.start() - 24), m.start()):
                        first, last = (m[1], m[2]) if m[1] else (m[4], m[3])
                        given[first.lower()] += 1
                        surname[last.lower()] += 1
                if "noms" in t or "nom" in t or "name" in t or "NOM" in t:
                    given.update(w.lower() for w in _FIRST.findall(t))
            if len(words) > 300_000:
                yield out()
        if words or given:
            yield out()

    counts = ("uses", "common", "given", "surname")
    return texts.select(F.col(col)).mapInArrow(count, "word string, uses long, common long, given long, surname long").groupBy("word").agg(*[F.sum(c).alias(c) for c in counts])


def learn_names(texts: DataFrame, col: str = "text") -> Names:
    """Ordinary words: in lower case or opening sentences in more than a tenth of their uses. Given names: after
    titles, cues and labels at least twice as often given as surname."""
    stats = cut(word_statistics(texts, col), "words")
    total = stats.agg(F.sum("uses")).first()[0] or 0
    least = max(LEAST, int(total * SHARE))
    rows = stats.where((F.greatest("common", "given") >= least)).collect()  # at most 2 / SHARE words, of a corpus of any size
    given = {r["word"] for r in rows if r["given"] >= least and r["given"] > 2 * r["surname"] and r["common"] * 2 < r["uses"] + r["given"] and plain(r["word"]) not in NOT_NAMES}
    ordinary = {r["word"] for r in rows if r["common"] >= least and r["common"] * 10 > r["uses"]}
    first = frozenset(plain(w) for w in given)
    return Names(frozenset(plain(w) for w in ordinary) - first, first)


def _records(parsed: DataFrame, audit: DataFrame) -> DataFrame:
    p = parsed.select(F.lit("parsed_document").alias("record_kind"), F.col("document_id").alias("record_id"), F.col("full_text").alias("text"))
    a = audit.select(F.lit("audit_record").alias("record_kind"), "record_id", F.col("evidence_excerpt").alias("text"))
    return p.unionAll(a).where("text is not null and text <> ''")


def found_in(records: DataFrame, names: Names) -> DataFrame:
    """records(record_kind, record_id, text) -> (record_kind, record_id, pii_kind, surface, start, end)."""
    shared = records.sparkSession.sparkContext.broadcast(names)  # at most 2 / SHARE words

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = shared.value
        for pdf in batches:
            rows = [
                (k, i, kind, t[a:b], a, b)
                for k, i, t in zip(pdf["record_kind"], pdf["record_id"], pdf["text"])
                for a, b, kind in find(t, words)
            ]
            yield pd.DataFrame(rows, columns=["record_kind", "record_id", "pii_kind", "surface", "start", "end"])

    return records.mapInPandas(run, "record_kind string, record_id string, pii_kind string, surface string, start long, end long")


def replace(text: str, hits: list[tuple[int, int, str]]) -> str:
    out, last = [], 0
    for a, b, kind in hits:
        out += [text[last:a], f"[{kind.upper()}]"]
        last = b
    return "".join([*out, text[last:]])


def redact(records: DataFrame, col: str, names: Names) -> DataFrame:
    """records with every piece of personal information in `col` replaced by its placeholder."""
    shared = records.sparkSession.sparkContext.broadcast(names)

    @F.pandas_udf("string")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = shared.value
        for s in texts:
            yield pd.Series([replace(t, find(t, words)) if t else t for t in s], dtype=object)

    return records.withColumn(col, clean(F.col(col)))


def p1_found(parsed: DataFrame, audit: DataFrame) -> DataFrame:
    r = _records(parsed, audit)
    return found_in(r, learn_names(r)).select("record_kind", "record_id", "pii_kind", "surface").distinct()


def p1_redacted(parsed: DataFrame, audit: DataFrame) -> DataFrame:
    r = _records(parsed, audit)
    return redact(r, "text", learn_names(r))
