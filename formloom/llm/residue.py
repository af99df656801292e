"""Problem 9: template residue, filler, error pages and script notices in place of content.

One multi-pattern automaton (Aho-Corasick, built once per worker) finds word beginnings of seven languages
in the folded text in a single pass. A beginning has a role: trouble, system, advice, script, permission,
reference, filler. No single role says much; a sentence is an error or a script notice by the roles that
meet in it, or by its structure (status codes, stack frames, fields of an error object). A document is
marked when it has an open slot, or when such sentences cover most of what is left of it without headings
and menu lines.

Filler is known by statistics, not by its words: a sentence without figures and almost without function
words, whose letters follow each other in a way the corpus does not know. That model is a table of letter
triples (27 ** 3 numbers, whatever the corpus) counted over all documents (`letter_model`). Filler is also
what repeats itself: few different words in a sentence, or a short phrase that follows itself.

Edge cases: null, empty and blank texts are not marked; a sentence in which somebody reports an error or a
notice is content; control tokens (<|...|>), marks like [illisible] and lists of choices in braces are no
slots, and repeated they are no filler; very long texts are read whole; repeated rows each keep their row;
an empty corpus has a model that knows nothing and finds no filler by letters.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from operator import eq

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of the words of a document that such sentences must hold.
COVERAGE = 0.5
#: A phrase of PHRASE words at most is filler if it follows itself in COPIES copies or more.
PHRASE = 5
COPIES = 4
#: Most words read as one sentence.
STRETCH = 40
#: Bits a letter costs on average above which the corpus does not know how its neighbours go together;
#: most function words a filler sentence may have, and its fewest words.
STRANGE_BITS, FEW_FUNCTION, FILLER_SIZE = 3.3, 0.2, 4
#: Bits a letter of a whole document costs below which not half of it can be strange, and the share of different
#: words above which not half of it can repeat itself: such documents need no look at their sentences.
PLAIN_BITS, VARIED = 2.85, 0.62
#: The same for the share of function words, and for the share of text far from figures.
SPOKEN, UNFIGURED = 0.3, 0.3
#: Roles without one of which no sentence is an error, a notice or announced filler.
TELLING = ("trouble", "script", "browser", "sign", "filler")

#: Word beginnings by role, folded (fixed values). A final `$` wants the word to end there.
ROLES = {
    "trouble": (
        "erreur", "echec", "echoue", "introuvable", "indisponible", "injoignable", "inaccessible", "illisible$", "expire", "refuse", "interdit", "acces est suspendu", "acces suspendu", "compte suspendu", "depasse", "surcharge", "impossible d", "n'existe plus", "n'existe pas",
        "ne repond", "n'a pas repondu", "mal passe", "trop de requetes", "n'avez pas", "absente$", "en maintenance", "hors service", "impossible$", "pas pris en charge", "obsolete",
        "error", "fail", "not found", "unavailable", "unreachable", "timed out", "timeout", "time-out", "denied", "forbidden", "unauthori", "overload", "no longer exists", "does not exist", "could not be", "couldn't", "cannot be", "unable to",
        "did not answer", "did not respond", "went wrong", "too many requests", "do not have permission", "missing", "exception", "traceback", "under maintenance", "scheduled maintenance", "crash", "null pointer", "condition that prevented", "not supported", "outdated",
        "fehler", "nicht gefunden", "nicht verfugbar", "abgelaufen", "verweigert", "fehlgeschlagen", "no encontrad", "no disponible", "caducad", "denegad", "errore", "non trovat", "non disponibile", "scadut", "accesso negat", "fout", "niet gevonden",
    ),
    "system": (
        "page$", "pages$", "serveur", "session", "requete", "url$", "http", "portail", "site$", "navigateur", "fichier", "connexion", "identifiant", "compte$", "base de donnees", "document", "ressource", "archive", "conversion", "chargement", "passerelle",
        "affich", "afficheur", "application", "service$", "acces$", "code$", "statut", "visionneuse", "droits",
        "server", "host$", "upstream", "proxy", "gateway", "request", "portal", "website", "web page", "browser", "file$", "connection", "login", "account", "database", "api$", "resource", "display", "render", "thread", "status", "module", "viewer", "access$",
        "permission", "seite", "datei", "sitzung", "anfrage", "verbindung", "zugriff", "pagina", "servidor", "sesion", "solicitud", "acceso", "servizio", "richiesta", "sessione",
    ),
    "browser": ("navigateur", "browser", "navegador"),
    "advice": (
        "reessayez", "essayez", "revenir plus tard", "revenez", "contactez", "assistance", "rechargez", "actualisez", "reconnecte", "patientez", "quelques minutes", "veuillez", "administrateur", "verifiez",
        "try again", "come back later", "contact support", "contact the", "help desk", "reload", "refresh", "sign in again", "log in again", "please", "in a few minutes", "administrator", "check your", "check the settings",
        "versuchen sie", "bitte", "erneut", "laden sie", "intente", "vuelva", "por favor", "riprova", "ricarica", "contatta", "probeer",
    ),
    "script": (
        "javascript", "script$", "scripts$", "scripting", "module actif", "modules actifs", "js$", "cookie", "bloqueur", "blocker", "ad block", "adblock", "contenu actif", "active content", "contenus actifs", "skript", "aktive inhalte", "secuencias de comandos", "contenuti attivi", "applet", "webgl",
    ),
    "permission": (
        "activ", "autoris", "desactiv", "accept", "necessaire", "requis", "exige", "fonctionne", "besoin", "empeche", "execut", "permet", "sans$", "reglages",
        "enabl", "allow", "disabl", "turned o", "turn o", "required", "requires", "needs", "support", "prevent", "will not work", "must be", "without$", "to run", "settings",
        "aktivier", "zulassen", "erlaub", "benotig", "deaktivier", "habilit", "permit", "necesit", "abilit", "consent", "richied", "inschakel",
    ),
    "reference": ("incident", "ticket", "request id", "ray id", "trace id", "reference :", "ref$", "code erreur", "error code", "code incident", "correlation"),
    "sign": (
        "en maintenance", "maintenance", "bad gateway", "stack trace", "oups$", "oops$", "http", "\"status", "\"statut", "\"error", "\"erreur", "\"message", "\"code", "<code", "<libelle", "<erreur", "<error", "<?xml", "file \"", "null",
    ),
    "filler": (
        "lorem", "ipsum", "placeholder", "texte de remplissage", "remplissage", "contenu fictif", "texte fictif", "faux texte", "exemple de texte", "exemple de contenu", "texte d'exemple", "contenu d'exemple", "inserer ici", "inserez", "a inserer",
        "votre titre", "votre texte", "votre description", "ici votre", "sera remplace", "maquette", "ne pas diffuser",
        "sample text", "sample content", "dummy", "filler", "goes here", "your title", "your heading", "your text", "your description", "insert text", "insert description", "insert the", "insert your", "text here", "will be replaced", "for layout", "mock-up", "mockup",
        "do not publish", "platzhalter", "blindtext", "texto de relleno", "texto de ejemplo", "testo segnaposto", "foo bar",
    ),
}
#: What only an error page says, alone (fixed values).
PLAIN_ERROR = re.compile(
    r"(?:maintenance in progress|en (?:cours de )?maintenance|scheduled maintenance|internal server error|bad gateway|service unavailable|gateway time-?out|page (?:not found|introuvable)|not found\W*$|access denied|acces refuse|(?:something|quelque chose) (?:went wrong|s'est mal passe)|une erreur (?:inattendue )?est survenue"
    r"|an (?:unexpected )?error (?:has )?occurred|session (?:has |a )?expired?|exception in thread|stack ?trace|traceback|\boups\b|\boops\b|proxy error|\b(?:echec|failed)\b.{0,40}\b(?:chargement|conversion|load|render)|^\W*(?:erreur|error|http(?: status)?|fehler)\W{0,3}\d{3}\b)"
)
#: The build of an error: stack frames, class names of exceptions, fields of an error object.
STRUCTURE = re.compile(
    r"^\s*at [\w$]+(?:[.$/][\w$]+)+|\b[a-z]\w*(?:\.[a-z]\w*)+(?:exception|error|report)?\b(?= at |:|\()|[\"<](?:status|statut|error|erreur|message|code|libelle)[\">]\s*[:>]?|^\s*<\?xml|\bfile \"[^\"]+\", line \d+"
)
CODE = re.compile(r"(?<![\d.,/-])[45]\d\d(?![\d.,/-])|\b0x[0-9a-f]{4,}\b")
#: Somebody tells of it: a person as subject of a reporting verb, or a verb of showing in the past (grammar, fixed values).
WHO = r"(?:patiente?s?|famille|epou(?:x|se)|fil(?:s|le)|mere|pere|madame|monsieur|mme|m\.|il|elle|on|nous|je|family|wife|husband|daughter|son|mother|father|mrs|mr|he|she|they|we|i|nurse|infirmiere?|secretariat|secretary|carer)"
TELLS = r"(?:signal\w+|rapport\w+|indiqu\w+|declar\w+|mentionn\w+|expliqu\w+|dit|disait|raconte\w*|decrit|note|said|says|reports?|reported|told|mentions?|mentioned|explain\w*|complain\w*|notice[sd]?|describe[sd]?|saw)"
MENTION = re.compile(rf"\b{WHO}\b[^,;]{{0,30}}?\b{TELLS}\b|\b(?:a|ont|avait) (?:affiche|montre|demande)\b|\b(?:affichait|montrait|demandait|demandaient)\b|\b(?:portal|page|screen|site|browser|system|it) (?:showed|displayed|asked)\b")
#: Function words of seven languages (fixed values).
FUNCTION = frozenset(
    """le la les l d de du des un une et ou en au aux a dans sur pour par avec sans sous est sont ont ce cet cette ces il elle on qui que qu ne n pas plus se s son sa ses leur y entre depuis selon chez mais
    the of and to in is are was were with for on by at from this that it not no an be has have had as or than but its their which
    der die das und ist mit von zu den dem ein eine nicht auf fur im am wurde el los las del y con por para una que es no se su lo il lo gli di che e per con non sono una della het van een op te dat zijn do da os as um uma""".split()
) - frozenset(("et", "in", "a", "ut", "ad", "se", "d", "non", "e", "te", "do"))

_NAME = r"[A-Za-zÀ-ÿ_][\w .\-À-ÿ]{0,60}?"
#: Every alternative begins with its own sign, so a text without these signs is passed over quickly.
SLOT = re.compile(
    rf"\{{\{{\s*[#/^>]?\s*{_NAME}\s*\}}\}}|<%[=\-]?\s*{_NAME}\s*%>|\$\{{\s*{_NAME}\s*\}}|#\{{\s*{_NAME}\s*\}}|\[\[\s*{_NAME}\s*\]\]|<<\s*{_NAME}\s*>>|«[A-Za-z_][\w.]*»"
    rf"|@@\w+@@|__(?<!\w__)[A-Za-z]\w*?__(?!\w)|%[A-Z][A-Z0-9_]*%|<(?i:ins[ée]rer|insert)\s[^<>\n]{{1,60}}>|\{{\d{{1,2}}\}}"
    r"|\[[A-ZÀ-Ý]{2}[A-ZÀ-Ý _]*\]|\[(?i:[àa] compl[ée]ter|to be completed|[àa] renseigner|to be filled(?: in)?)\]"
)
SLOT_DATE = re.compile(r"\b(?:XX/XX/XX(?:XX)?|JJ/MM/AAAA|DD/MM/YYYY)\b")


def open_slot(text: str) -> bool:
    return bool(SLOT.search(text)) or ("XX/XX" in text or "JJ/MM" in text or "DD/MM" in text) and bool(SLOT_DATE.search(text))


class _Fold(dict):
    """Per character: lower case without marks, blanks of any kind as one kind; one character each."""

    def __missing__(self, code: int) -> int:
        ch = chr(code)
        d = unicodedata.normalize("NFD", ch)[0].lower()[:1] or ch
        self[code] = ord("'") if d in "’‘`´" else 32 if d.isspace() and d != "\n" else ord(d)
        return self[code]


_FOLD = _Fold()
_UNSEEN = re.compile("[­​-‏⁠﻿\x00-\x08\x0b\x0e-\x1f]")


def folded(text: str) -> str:
    """The text in lower case without marks; same length as the text."""
    return text.translate(_FOLD)


# --- how letters follow each other in the corpus ------------------------------------------------------
_LETTER = np.zeros(256, np.uint8)
_LETTER[97:123] = np.arange(1, 27)


def triples(low: str) -> np.ndarray:
    """Number of each letter triple of a folded text, runs of other characters as one blank."""
    c = _LETTER[np.frombuffer(f" {low} ".encode("ascii", "replace"), np.uint8)]
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
    c = c[keep].astype(np.int32)
    return c[:-2] * 729 + c[1:-1] * 27 + c[2:]


def letter_model(docs: DataFrame, text: str = "text") -> np.ndarray | None:
    """Bits each letter triple costs, from counts over all documents; None where there is no text.

    Every task adds up its own table of 27 ** 3 counts; only these tables are shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(27**3, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    total += np.bincount(triples(folded(t)), minlength=27**3)
        seen = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["triple", "n"])

    rows = docs.select(F.col(text)).mapInArrow(count, "triple int, n long").groupBy("triple").agg(F.sum("n").alias("n")).collect()  # at most 27 ** 3 rows
    if not rows:
        return None
    n = np.zeros(27**3)
    n[[r["triple"] for r in rows]] = [r["n"] for r in rows]
    n = n.reshape(729, 27)
    single = n.sum(0) / max(n.sum(), 1)
    # rarely seen pairs lean on the frequencies of single letters
    return -np.log2(np.maximum((n + 20 * single) / (n.sum(1, keepdims=True) + 20), 1e-9)).reshape(-1).astype(np.float32)


def strange(words: list[str], model: np.ndarray | None) -> bool:
    """Whether the letters of these words follow each other as in no text of the corpus."""
    if model is None:
        return False
    t = triples(" ".join(words))
    return len(t) > 0 and float(model[t].mean()) > STRANGE_BITS + 1 / len(words)  # few words vary more


# --- judging ------------------------------------------------------------------------------------------
def automaton(roles: dict[str, tuple[str, ...]]) -> ahocorasick.Automaton:
    by: dict[str, list] = {}
    for role, starts in roles.items():
        for p in starts:
            by.setdefault(p.rstrip("$"), []).append((role, p.endswith("$")))
    a = ahocorasick.Automaton()
    for p, tags in by.items():
        a.add_word(p, (len(p), tags))
    a.make_automaton()
    return a


_AUTO: list = []
_SENT = re.compile(r"[^.!?\n]+(?:(?:[.!?]+(?!\s|$))[^.!?\n]*)*(?:[.!?]+|\n|$)|[.!?\n]")
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"\w+")
_ENDS = re.compile(r"[.!?\n]+")
_NO_FIGURES = re.compile(r"[^.!?\n\d]{12,}")
_DIGIT = re.compile(r"\d")
_MARK = re.compile(r"\[[^\[\]\n]*\]|<\|[^|\n]*\|>|\{[^{}\n]*\}|\b(?:illisibles?|illegible|inaudible)\b")


def repeated(low: str) -> list[tuple[int, int]]:
    """Spans where a phrase of two or more different words, without digits, follows itself COPIES times or more."""
    low = _MARK.sub(lambda m: "0" * len(m[0]), low)
    words = _TOKEN.findall(low)
    spans: list[tuple[int, int]] = []
    at: list[tuple[int, int]] = []
    for p in range(2, PHRASE + 1):
        same = bytes(map(eq, words, words[p:]))
        i = same.find(b"\1" * (p * (COPIES - 1)))
        while i >= 0:
            j = same.find(0, i)
            j = len(same) if j < 0 else j
            if len(set(words[i : i + p])) > 1 and all(w.isalpha() for w in words[i : i + p]):
                at = at or [m.span() for m in _TOKEN.finditer(low)]
                spans.append((at[i][0], at[j + p - 1][1]))
            i = same.find(b"\1" * (p * (COPIES - 1)), j)
    merged: list[tuple[int, int]] = []
    for x, y in sorted(spans):
        if merged and x <= merged[-1][1]:
            x, y = merged[-1][0], max(y, merged.pop()[1])
        merged.append((x, y))
    return merged


def stutters(sentence: str) -> bool:
    """Whether a sentence has few different words."""
    words = sentence.split()
    return len(words) >= 3 and len(set(words)) * 3 <= len(words)


def filler_like(sentence: str, model: np.ndarray | None) -> bool:
    """Whether a folded sentence is filler by its statistics: it repeats a word or two, or is in no language."""
    if _DIGIT.search(sentence) or _MARK.search(sentence):
        return False
    words = [w for w in _WORD.findall(sentence) if w.isascii()]
    n = len(words)
    if n >= 3 and len(set(words)) * 3 <= n:
        return True
    if n < FILLER_SIZE:
        return False
    return sum(w in FUNCTION for w in words) < FEW_FUNCTION * n and strange(words, model)


def stretches(low: str) -> Iterator[tuple[int, int]]:
    """Spans of the sentences of a folded text; a sentence without end is read STRETCH words at a time."""
    for m in _SENT.finditer(low):
        a, b = m.span()
        if b - a > 4 * STRETCH:
            for w in list(_TOKEN.finditer(low, a, b))[STRETCH::STRETCH]:
                yield a, w.start()
                a = w.start()
        yield a, b


def _hits(auto: ahocorasick.Automaton, low: str) -> Iterator[tuple[int, str]]:
    for end, (n, tags) in auto.iter(low):
        a = end - n + 1
        if a and low[a - 1].isalnum() and low[a].isalnum():
            continue
        whole = end + 1 == len(low) or not low[end + 1].isalnum()
        for role, exact in tags:
            if whole or not exact:
                yield a, role


def _automata() -> list[ahocorasick.Automaton]:
    """All roles, and the telling ones alone."""
    if not _AUTO:
        _AUTO.extend((automaton(ROLES), automaton({k: ROLES[k] for k in TELLING})))
    return _AUTO


def roles_in(low: str) -> list[tuple[int, str]]:
    """(position, role) of every word beginning the automaton knows."""
    return sorted(_hits(_automata()[0], low))


def suspected(low: str, model: np.ndarray | None) -> tuple[bool, bool, bool]:
    """(says so, repeats itself, is strange): what a folded text may be as a whole; where all are false it is no residue."""
    words = low.split()
    says = next(_hits(_automata()[1], low), None) is not None
    repeats = len(set(words)) <= VARIED * len(words)
    odd = False
    # strange are sentences without figures and almost without function words
    if model is not None and sum(map(FUNCTION.__contains__, words)) < SPOKEN * len(words) and sum(map(len, _NO_FIGURES.findall(low))) > UNFIGURED * len(low):
        t = triples(low)
        odd = len(t) > 0 and float(model[t].mean()) > PLAIN_BITS
    return says, repeats, odd


def kind_of(sentence: str, roles: set[str]) -> str | None:
    """error, script or filler by the roles that meet in a folded sentence and by its build, else null."""
    if "filler" in roles:
        return "filler"
    if "script" in roles and roles & {"permission", "system", "advice", "trouble"} or "browser" in roles and roles & {"permission", "trouble"}:
        return "script"
    if roles & {"trouble", "sign"} and (PLAIN_ERROR.search(sentence) or STRUCTURE.search(sentence)):
        return "error"
    if "trouble" in roles and ("system" in roles or "advice" in roles and "reference" in roles or CODE.search(sentence)):
        return "error"
    return None


def judge(text: str | None, coverage: float = COVERAGE, model: np.ndarray | None = None) -> tuple[str | None, float]:
    """(kind, share): what the text is in place of content, with the share of its words that says so."""
    if text is None or not text.strip():
        return None, 0.0
    text = _UNSEEN.sub("", text)
    if open_slot(text):
        return "slot", 1.0
    low = folded(text)
    says, repeats, odd = suspected(low, model)
    if not (says or repeats or odd):
        return None, 0.0
    hits = roles_in(low) if says else []
    runs = repeated(low) if repeats else []
    if not (says or odd or runs or any(map(stutters, _ENDS.split(low)))):
        return None, 0.0
    covered = {"error": 0, "script": 0, "filler": 0}
    side: list[int] = []  # sizes of sentences that only go with others
    total = k = r = 0
    for a, b in stretches(low):
        s = low[a:b]
        size = len(_TOKEN.findall(s))
        roles: set[str] = set()
        while k < len(hits) and hits[k][0] < b:
            roles.add(hits[k][1])
            k += 1
        again = 0
        while r < len(runs) and runs[r][0] < b:
            again += len(_TOKEN.findall(low, max(a, runs[r][0]), min(b, runs[r][1])))
            if runs[r][1] > b:
                break
            r += 1
        if not size:
            continue
        menu = "|" in s or "·" in s
        kind = None
        if not menu:
            kind = "filler" if again and again * 2 >= size else (kind_of(s, roles) if roles else None) or ("filler" if (repeats or odd) and filler_like(s, model) else None)
        if kind in ("error", "script") and MENTION.search(s):
            kind = None
        if kind:
            covered[kind] += size
            total += size
        elif not menu and (size > 4 or _DIGIT.search(s)) and not s.strip().startswith("version"):  # all else: headings and menu entries
            total += size
            if roles & {"advice", "reference", "trouble", "permission"} and not MENTION.search(s):
                side.append(size)
    if covered["error"] or covered["script"]:
        covered["error" if covered["error"] >= covered["script"] else "script"] += sum(side)
    share = sum(covered.values()) / max(total, 1)
    if not sum(covered.values()) or share < coverage:
        return None, share
    return max(covered, key=covered.get), share


def mark_residue(docs: DataFrame, text: str = "text", coverage: float = COVERAGE, model: np.ndarray | None = None) -> DataFrame:
    """docs with residue_kind (slot, filler, error, script or null) and residue_share.

    model: what `letter_model` made of a corpus; fitted on docs where none is given.
    """
    shared = docs.sparkSession.sparkContext.broadcast(letter_model(docs, text) if model is None else model)  # 27 ** 3 numbers

    @F.pandas_udf("kind string, share double")
    def mark(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for s in texts:
            yield pd.DataFrame([judge(t, coverage, m) for t in s], columns=["kind", "share"])

    return docs.withColumn("_r", mark(F.col(text))).withColumn("residue_kind", F.col("_r.kind")).withColumn("residue_share", F.col("_r.share")).drop("_r")


def p9_found(docs: DataFrame) -> DataFrame:
    return mark_residue(docs.select("doc_id", "text")).where("residue_kind is not null").select("doc_id")


def p9_clean(docs: DataFrame) -> DataFrame:
    """The corpus without the marked documents."""
    return mark_residue(docs).where("residue_kind is null").drop("residue_kind", "residue_share")
