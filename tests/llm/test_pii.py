import pytest

from formloom.llm import pii

NAMES = pii.Names(
    frozenset("resultat de controle sur un second automate le patient est fragment beige biologique score espace".split()),
    frozenset("tiago apolline benedicte remi bastien".split()),
)


def hits(text):
    return [(k, text[a:b]) for a, b, k in pii.find(text, NAMES)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("", []),
        ("Écrire à a.b+c@mail.example.", [("email", "a.b+c@mail.example")]),
        ("Écrire à a.b [at] mail.example dès que possible", [("email", "a.b [at] mail.example")]),
        ("à x_y arobase clinic.example.org.", [("email", "x_y arobase clinic.example.org")]),
        ("à x(at)clinic [dot] example ", [("email", "x(at)clinic [dot] example")]),
        ("tél. 01 99 00 29 41, puis", [("phone", "01 99 00 29 41")]),
        ("(04\xa065\xa071\xa031\xa048)", [("phone", "04\xa065\xa071\xa031\xa048")]),
        ("+33 (0)1 99 00 12 36.", [("phone", "+33 (0)1 99 00 12 36")]),
        ("((020) 7946 0480)", [("phone", "(020) 7946 0480")]),
        ("07700 900147 ou 0033465719583", [("phone", "07700 900147"), ("phone", "0033465719583")]),
        ("au zéro un deux trois quatre cinq six sept huit neuf merci", [("phone", "zéro un deux trois quatre cinq six sept huit neuf")]),
        ("Code-barres du flacon 05-76-25-58-30-41-43-71, le 2023-04-01", []),
        ("NIR 1 62 38 99 929 312 45.", [("id_number", "1 62 38 99 929 312 45")]),
        ("IPP : 8018683681", [("id_number", "8018683681")]),
        ("NHS No: 999-284-5265.", [("id_number", "999-284-5265")]),
        ("passport 99XK94397", [("id_number", "99XK94397")]),
        ("(hospital number H1726227)", [("id_number", "H1726227")]),
        ("au 189 bis chemin des Glycines 96699 TARVIGNY.", [("address", "189 bis chemin des Glycines 96699 TARVIGNY")]),
        ("Domicile : 30, bd de la Petite Vitesse.", [("address", "30, bd de la Petite Vitesse")]),
        ("at 171 Thornholme Lane, Thornbeck ZZ4 7QT and", [("address", "171 Thornholme Lane, Thornbeck ZZ4 7QT")]),
        ("Dr. M. Vaumelreuil par téléphone", [("person", "M. Vaumelreuil")]),
        ("Signé : Querplamont É Fragment beige", [("person", "Querplamont É")]),
        ("Nom : Kercouquain   Prénom : Tiago", [("person", "Kercouquain"), ("person", "Tiago")]),
        ("Contact | de la Lanrozeau | Apolline | 0261911356", [("person", "de la Lanrozeau"), ("person", "Apolline"), ("phone", "0261911356")]),
        ("Appel de DE LA BELROCHET Bénédicte ce jour", [("person", "DE LA BELROCHET Bénédicte")]),
        ("M. DE LA VERZELIEUX habite ici", [("person", "DE LA VERZELIEUX")]),
        ("Signed B.-M. Wendmere NHS No: 999-284-5265", [("person", "B.-M. Wendmere"), ("id_number", "999-284-5265")]),
        ("Score de Child-Pugh A5, espace de Morrison, Cockcroft", []),
        ("rappeler le 06 douze 34 56 78 demain", [("phone", "06 douze 34 56 78")]),
        ("zéro six douze trente-quatre cinquante-six soixante-dix-huit", [("phone", "zéro six douze trente-quatre cinquante-six soixante-dix-huit")]),
        ("call oh seven seven double zero nine zero zero one four seven now", [("phone", "oh seven seven double zero nine zero zero one four seven")]),
        ("NIR un quatre-vingt-cinq zéro sept soixante-quinze cent seize zéro deux quatre quarante-deux, clé", [("id_number", "un quatre-vingt-cinq zéro sept soixante-quinze cent seize zéro deux quatre quarante-deux")]),
        ("prendre un ou deux comprimés trois fois par jour pendant dix jours", []),
        ("tél. 01 99 00 29 41 un contrôle", [("phone", "01 99 00 29 41")]),
        ("écrire à jean.durand at example dot com merci", [("email", "jean.durand at example dot com")]),
        ("à jean point durand arobase mail point example point fr", [("email", "jean point durand arobase mail point example point fr")]),
        ("seen at home", []),
        ("Bruno Castellani a été vu en consultation.", [("person", "Bruno Castellani")]),
        ("pour score de Vasselin-Torp, signe de Quernadec", []),
        ("réactif lot 94L6, automate n° 102912, CQ-542", []),
    ],
)
def test_found(text, want):
    assert sorted(hits(text)) == sorted(want)


def test_spans_survive_line_breaks_and_lookalikes():
    text = "Consen-\ntement signé par Rémi Loutimont. Mail : jo­hn@mаil.example"  # soft hyphen, Cyrillic a
    found = hits(text)
    assert ("person", "Rémi Loutimont") in found and ("email", "jo­hn@mаil.example") in found


def test_long_text_and_round_trip():
    text = "mot " * 30_000 + "Dr Vaumelreuil" + " mot" * 30_000
    h = pii.find(text, NAMES)
    assert [text[a:b] for a, b, _ in h] == ["Vaumelreuil"]
    out = pii.replace(text, h)
    assert out == text.replace("Vaumelreuil", "[PERSON]")


def test_given_names_are_learned_from_titles_and_labels(spark):
    texts = [("Dr Bruno Castellani, Mme Bruno Verzel. Prénom : Bruno. Vu par CASTELLANI Bruno ce jour. Le foie est normal. Le foie est gros. Le foie est petit.",)]
    n = pii.learn_names(spark.createDataFrame(texts, "text string"))
    assert n.given == {"bruno"} and {"foie", "est"} <= n.ordinary and "castellani" not in n.ordinary
    assert [(k, "Bruno Malaspina"[a:b]) for a, b, k in pii.find("Bruno Malaspina", n)] == [("person", "Bruno Malaspina")]
    assert pii.learn_names(spark.createDataFrame([], "text string")) == pii.Names(frozenset())


def test_tables(spark):
    p = "document_id string, full_text string, text string"
    a = "record_id string, evidence_excerpt string, record_kind string"
    docs = spark.createDataFrame([("d", "Dr Vaumelreuil, Dr Vaumelreuil", "x"), ("d", "Dr Vaumelreuil, Dr Vaumelreuil", "x"), ("e", None, "x"), ("f", "", "x")], p)
    audit = spark.createDataFrame([("r", "appel au 01 99 00 29 41", "k"), ("r", "appel au 01 99 00 29 41", "k")], a)
    assert {tuple(r) for r in pii.p1_found(docs, audit).collect()} == {("parsed_document", "d", "person", "Vaumelreuil"), ("audit_record", "r", "phone", "01 99 00 29 41")}
    assert pii.p1_found(docs, audit).count() == 2
    assert pii.p1_found(docs.limit(0), audit.limit(0)).count() == 0
    assert sorted(r["text"] for r in pii.p1_redacted(docs.limit(1), audit.limit(0)).collect()) == ["Dr [PERSON], Dr [PERSON]"]
