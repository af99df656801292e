import pytest

from formloom.llm import scans

WORDS = frozenset(
    "leucocytes hemoglobine facteur patient le la de du transport prevoir un vasselin-torp peri-oesophagiennes serum creatinine plasma domicile aide intervient fois par semaine anne-sophie poids est stable "
    "b12 s12 vitamine albumine antigene interne ug time".split()
)
R = scans.Reader(WORDS)


@pytest.mark.parametrize(
    "token, item",
    [
        ("Leuc0cytes", "Leuc0cytes"), ("Leiicocytes,", "Leiicocytes"), ("d'hémogl0bine", "hémogl0bine"), ("Fac†eur.", "Fac†eur"), ("3l,8", "3l,8"), ("(Z8.2)", "Z8.2"), ("l'Aritigene", "Aritigene"), ("inteme", "inteme"),
        ("Se\\/rum", None), ("leucocytes", None), ("Hemoglobine", None), ("B12", None), ("S12", None), ("Kercouquain", None), ("99XK94397", None), ("41ZZ62205", None), ("x.y0z@mail.example", None), ("10^9/L", None), ("", None),
    ],
)
def test_tokens(token, item):
    _, items = scans.decode(token, R)
    if token == "Se\\/rum":
        return  # either reading is a guess
    assert [v for _, v in items] == ([item] if item else [])


def test_house_number_is_no_misread_number():
    assert scans.decode("au 25B, bd des Tisserands", R)[1] == []
    assert scans.decode("valeur : 25B U/L", R)[1] == [("misread", "25B")]


@pytest.mark.parametrize(
    "text, word",
    [
        ("Fac- \nteur V", "Facteur"), ("à dom¬\n  icile", "domicile"), ("trans\xad\nport", "transport"), ("par l'hémo‐\nglobine.", "hémoglobine"), ("péri-\noesophagiennes", "péri-oesophagiennes"),
        ("Vasselin¬\nTorp", "Vasselin-Torp"), ("Anne-\nSophie", "Anne-Sophie"),
    ],
)
def test_hyphens(text, word):
    fixed, items = scans.read(text, R, frozenset())
    assert ("hyphenation", word) in items and "\n" not in fixed


def test_the_frequent_reading_wins():
    r = scans.Reader({"dose": 900, "clore": 3, "close": 4, "foie": 5000, "foic": 0 + 1})
    assert scans.decode("cl0se", r)[0] == "close"  # one confusion beats two
    r = scans.Reader({"sein": 900, "seln": 2, "sem": 2, "rein": 500})
    assert scans.decode("seín", r) == ("sein", [("misread", "seín")])
    r = scans.Reader({"teste": 4000, "testé": 3, "a": 9})
    assert scans.decode("t3st3", r)[1] == [("misread", "t3st3")]


def test_arcs_compete_in_one_lattice():
    r = scans.Reader({"hepatique": 700, "normal": 900, "foie": 800, "pati": 1, "ent": 1, "patient": 900})
    assert scans.decode("hépat ique", r)[0] == "hépatique"
    assert scans.decode("foienormalhepatique foie", r)[0].startswith("foienormal")  # two cuts are none of the arcs
    assert scans.decode("foienormal foie", r)[0] == "foie normal foie"
    # the words of a break stay one word though both parts are known
    assert scans.decode("le pati-\nent va", r) == ("le patient va", [("hyphenation", "patient")])
    assert scans.decode("le pat¡-\n\n\n\n\nent va", r, across=True)[0].count("\n") == 5
    assert ("hyphenation", "patient") in scans.decode("le pati-\n\n\n\n\n\nent va", r, across=True)[1]
    assert scans.decode("le hépa-\nt1que va", r)[1] == [("hyphenation", "hépat1que"), ("misread", "hépat1que")]


def test_headers_and_page_numbers():
    text = "CH Orvane   1/2\nAlbumine 4\nPage 1 sur 2\n\x0cCH Orvanc   2/2\nsérum stable\n\tPage 2 sur 2"
    fixed, items = scans.read(text, R, frozenset())
    assert {v for k, v in items if k == "running_header"} == {"CH Orvane   1/2", "CH Orvanc   2/2"}
    assert {v for k, v in items if k == "page_number"} == {"Page 1 sur 2", "Page 2 sur 2"}
    assert "CH" not in fixed and "Page" not in fixed


def test_repeated_section_names_are_no_headers():
    text = "Biochimie\nx 1\nHemostase\ny 2\nBiochimie\nz 3"
    assert scans.read(text, R, frozenset({scans.shape("Biochimie"), scans.shape("Hemostase")}))[1] == []


def test_bare_page_numbers_count_up():
    assert [v for k, v in scans.read("a b\n1\nc d\n   2", R, frozenset())[1] if k == "page_number"] == ["1", "2"]
    assert scans.read("Urée ......\n41\nCalcium ......\n7", R, frozenset())[1] == []


def test_lab_line():
    items = scans.read("Albumine = 1.21 G/L\n1\nCH Orvane", R, frozenset(), ["CH Orvane"], line_record=True)[1]
    assert set(items) == {("page_number", "1"), ("running_header", "CH Orvane")}
    assert scans.read("Albumine ......\n41", R, frozenset(), [], line_record=True)[1] == []


def test_word_broken_over_a_page():
    text = "CH Orvane\nle pati-\n1\n\x0cCH Orvane\n  ent est stable\n2"
    assert ("hyphenation", "patient") in scans.read(text, R, frozenset())[1]


def test_paragraphs_join_wrapped_lines():
    t = "Le patient dont le poids est stable depuis trois semaines entières\nprend un traitement par voie orale tous les matins.\n\nAutre."
    assert scans.paragraphs(t) == t.replace("entières\nprend", "entières prend")


def test_long_and_empty():
    assert scans.read("", R, frozenset()) == ("", [])
    blob = "aB9+/" * 5000
    assert scans.read(blob, R, frozenset())[1] == []


def test_tables(spark):
    p = "document_id string, page_scan boolean, full_text string, items string"
    l = "line_id long, document_id string, raw_text string, text string"  # noqa: E741
    clean = [(f"c{i}", False, "leucocytes normaux facteur stable", None) for i in range(3)]
    docs = spark.createDataFrame([*clean, ("s", True, "Leuc0cytes", None), ("s", True, "Leuc0cytes", None), ("n", None, None, None), ("e", True, "", None)], p)
    lines = spark.createDataFrame([(1, "s", "fac†eur : 3l,8", "x"), (2, "c0", "fac†eur", "x"), (3, "s", None, "x"), (4, "gone", "fac-\nteur", "x")], l)
    got = {tuple(r) for r in scans.p2_found(docs, lines).collect()}
    assert got == {
        ("parsed_document", "s", "misread", "Leuc0cytes"), ("lab_line", "1", "misread", "fac†eur"), ("lab_line", "1", "misread", "3l,8"), ("parsed_document", "s", "misread", "fac†eur"),
        ("parsed_document", "s", "misread", "3l,8"), ("lab_line", "4", "hyphenation", "facteur"), ("parsed_document", "gone", "hyphenation", "facteur"),
    }
    assert scans.p2_found(docs.limit(0), lines.limit(0)).count() == 0
