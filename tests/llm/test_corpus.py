import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from formloom.llm import packing, residue, split, tokens

tiktoken = pytest.importorskip("tiktoken")


# --- splitting ------------------------------------------------------------------------------------
@pytest.mark.parametrize("seed", range(20))
def test_pieces_tile_and_overlap(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["mot ", "phrase. ", "\n", "\n\n", "TITRE :\n", "x" * rng.randrange(1, 400), "🙂", " "]) for _ in range(rng.randrange(200, 900)))
    spans = split.pieces_of(text, 300, 40)
    assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(b - a <= 300 for a, b in spans)
    assert all(y[0] == x[1] - 40 for x, y in zip(spans, spans[1:]))


def test_cuts_at_the_largest_boundary():
    a, b, c = "Un mot. " * 60, "Deux mots. " * 50, "fin " * 100
    text = f"{a}\n\nRESULTATS :\n{b}\n\n{c}"
    spans = split.cores(text, 600, 50)
    assert text[spans[1][0] :].startswith("RESULTATS")
    assert all(text[y - 1].isspace() for _, y in spans[:-1])


def test_siblings_of_one_parent_only_are_merged():
    text = "# A\n" + "a b. " * 60 + "\n## A1\n" + "c d. " * 100 + "\n## A2\n" + "e f. " * 90 + "\n# B\n" + "g h. " * 20
    starts = [text[a : a + 4].strip() for a, _ in split.cores(text, 1200, 100)]
    assert starts == ["# A", "## A", "# B"]  # A with A1, then A2, then B: A2 is no sibling of B


def test_lists_are_cut_by_depth():
    text = "- x\n  - y1 " + "w " * 300 + "\n  - y2 " + "w " * 250 + "\n- z " + "v " * 100
    assert [text[a : a + 3] for a, _ in split.cores(text, 1200, 100)] == ["- x", "- z"]
    assert [text[a : a + 6].strip() for a, _ in split.cores(text, 700, 50)] == ["- x", "- y2", "- z v"]


def test_a_later_shorter_version_needs_no_cutting(spark):
    import datetime

    s = "chunk_id string, document_id string, chunk_ord int, text string, char_start long, char_end long, indexed_at timestamp"
    t1, t2 = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2)
    rows = [("a", "d", 0, "x" * 1300, None, None, t1), ("a", "d", 0, "x", None, None, t2), ("b", "d", 0, "x", None, None, t1), ("b", "d", 0, "x" * 1300, None, None, t2)]
    assert [r["chunk_id"] for r in split.p6_found(spark.createDataFrame(rows, s)).collect()] == ["b"]


def test_no_boundary_at_all():
    assert [b - a for a, b in split.pieces_of("x" * 2500, 1200, 100)] == [1200, 1200, 300]
    with pytest.raises(ValueError):
        split.pieces_of("x", 10, 10)


def test_chunk_offsets(spark):
    import datetime

    t1, t2 = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2)
    long = "Une phrase de plus. " * 100
    s = "chunk_id string, document_id string, chunk_ord int, text string, char_start long, char_end long, indexed_at timestamp, piece int"
    rows = [
        ("a", "d", 0, long, 5, 5 + len(long), t1, 0), ("a", "d", 0, long, None, None, t2, 0), ("b", "d", 1, "y" + long, None, None, t1, 0), ("c", "e", 0, long, None, None, t1, 0), ("k", "d", 2, "kurz", 0, 4, t1, 0),
        ("n", "d", 3, None, None, None, t1, 0), ("u", "d", 4, "z" * 1201, None, None, t1, 0), ("v", "d", 5, "z" * 1201, None, None, t1, 0),
    ]
    full = "12345" + long + "y" + long + "z" * 1201
    docs = spark.createDataFrame([("d", full, "t")], "document_id string, full_text string, text string")
    got = split.split_chunks(spark.createDataFrame(rows, s), docs).collect()
    assert {r["chunk_id"] for r in got} == {"a", "b", "c", "u", "v"}
    for r in got:
        if r["char_start"] is not None:
            assert full[r["char_start"] : r["char_end"]] == r["text"]
    known = {r["chunk_id"]: r["char_start"] is not None for r in got}
    assert known == {"a": True, "b": True, "c": False, "u": False, "v": False}
    assert split.p6_found(spark.createDataFrame([], s)).count() == 0


def test_copies_of_one_text_get_its_occurrences_in_order(spark):
    import datetime

    t = datetime.datetime(2024, 1, 1)
    x, y = "Une phrase de plus. " * 100, "é𝄞 noch ein Satz. " * 100
    s = "chunk_id string, document_id string, chunk_ord int, text string, char_start long, char_end long, indexed_at timestamp"
    full = {"two": "A" + x + "B" + x + "C" + y + "D", "known": "A" + x + "B" + x, "once of two": x + "B" + x, "three of two": x + "B" + x, "tied": "A" + x}
    rows = [
        ("a2", "two", 5, x, None, None, t), ("a1", "two", 2, x, None, None, t), ("a3", "two", 7, y, None, None, t), ("b1", "known", 0, x, None, None, t), ("b2", "known", 1, x, 2 + len(x), 2 + 2 * len(x), t),
        ("c1", "once of two", 0, x, None, None, t), ("d1", "three of two", 0, x, None, None, t), ("d2", "three of two", 1, x, None, None, t), ("d3", "three of two", 2, x, None, None, t),
        ("e1", "tied", 0, x, None, None, t), ("e2", "tied", 0, x, None, None, t), ("f1", "missing", 0, x, None, None, t),
    ]
    docs = spark.createDataFrame(list(full.items()), "document_id string, full_text string")
    got = split.split_chunks(spark.createDataFrame(rows, s), docs).collect()
    first = {r["chunk_id"]: r["char_start"] for r in got if r["piece"] == 0}
    n = len(x)
    assert first == {"a1": 1, "a2": 2 + n, "a3": 3 + 2 * n, "b1": 1, "b2": 2 + n, "c1": None, "d1": None, "d2": None, "d3": None, "e1": 1, "e2": 1, "f1": None}
    assert all(full[r["document_id"]][r["char_start"] : r["char_end"]] == r["text"] for r in got if r["char_start"] is not None)


# --- encoding -------------------------------------------------------------------------------------
def reference():
    import public_tokenizers as P

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=tokens.read_ranks(tokens.default_vocabulary()), special_tokens={})


def test_merges_are_exact():
    ranks, enc = tokens.read_ranks(tokens.default_vocabulary()), reference()
    rng = random.Random(2)
    for _ in range(300):
        w = "".join(rng.choice("aeioulrstéàç🙂 0189_-αжñ") for _ in range(rng.randrange(1, 60))).encode()
        assert list(tokens.merge(w, ranks)) == enc._encode_single_piece(w)


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = {w.encode(): (i, i + 1) if i % 2 else (i,) for i, w in enumerate(["a", "ab", "abc", "b", "bc", "chat", "chats", "rat", "rats", "é"])}
    path = str(tmp_path / "l")
    n = tokens.compile_lexicon(sorted(words.items()), path)
    lex = tokens.Lexicon(path)
    assert all(lex.get(w) == ids for w, ids in words.items())
    assert lex.get(b"") is None and lex.get(b"ch") is None and lex.get(b"ratz") is None
    # chat(s) and rat(s) share their ends: distinct right languages only
    ends = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w0 in words for p in (w0[:i] for i in range(len(w0) + 1))}
    assert n == len(ends)
    tokens.compile_lexicon([], str(tmp_path / "none"))
    assert tokens.Lexicon(str(tmp_path / "none")).get(b"a") is None


def test_ids_of_a_corpus(spark):
    texts = ["Bonjour le monde", "", None, "<|endoftext|> x", "  \n\t ", "é" * 5000, "don't I'll 12 345 ½²³ 🙂🙂", "Bonjour le monde", "mot " * 20_000]
    df = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(texts)], "doc_id long, text string, ids array<int>")
    enc = reference()
    got = {r["doc_id"]: r["ids"] for r in tokens.p7_ids(df).collect()}
    assert got == {i: enc.encode_ordinary(t) if t else [] for i, t in enumerate(texts)}
    assert tokens.p7_ids(df.limit(0)).count() == 0


# --- packing --------------------------------------------------------------------------------------
def check(spark, sizes, capacity, groups=packing.GROUPS):
    df = spark.createDataFrame([(i, s, "x") for i, s in enumerate(sizes)], "k long, n int, piece string")
    rows = packing.pack(df, "k", "n", capacity, groups, 4).collect()
    use, per = Counter(), defaultdict(list)
    for r in rows:
        use[r["container_id"]] += r["n_tokens"]
        per[r["k"]].append(r)
        assert r["token_end"] - r["token_start"] == r["n_tokens"]
    assert len(per) == len(sizes) and max(use.values(), default=0) <= capacity
    for i, s in enumerate(sizes):
        assert sum(r["n_tokens"] for r in per[i]) == (s or 0)
        assert len(per[i]) == max(1, -(-(s or 0) // capacity))
    return len([1 for v in use.values() if v]), sum(use.values())


@pytest.mark.parametrize("seed", range(4))
def test_nothing_lost_and_little_wasted(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([None, 0, 7, 7, 7, rng.randrange(1, 300), rng.randrange(1, 100), rng.randrange(1, 40)]) for _ in range(3000)]
    n, total = check(spark, sizes, 100)
    assert n <= -(-total // 100) * 1.02 + 1


def test_edges(spark):
    assert check(spark, [0, None, 0], 10)[0] == 0
    assert check(spark, [10, 20, 25], 10) == (6, 55)
    assert check(spark, [6] * 5, 10) == (5, 30)
    assert packing.plan_containers({}, 10) == ([], 0)
    assert packing.pack(spark.createDataFrame([], "k long, n int"), "k", "n", 10).count() == 0


def test_plan_is_bounded_by_sizes_not_items():
    rng = random.Random(3)
    few = Counter(rng.randrange(1, 2049) for _ in range(10_000))
    many = {s: n * 1000 for s, n in few.items()}
    a, b = packing.plan_containers(few)[0], packing.plan_containers(many)[0]
    assert len(b) < 3 * len(a)
    placed = Counter()
    for s, lo, n, _ in b:
        assert lo == placed[s]
        placed[s] += n
    assert placed == Counter(many)


# --- residue --------------------------------------------------------------------------------------
@pytest.mark.parametrize(
    "text, kind",
    [
        (None, None), ("", None), (" \n\xa0", None), ("Conclusion : {{ nom }}", "slot"), ("Réponse {CR, PR, SD} [illisible] <|im_start|>", None), ("Le poids est de ${poids} kg, stable depuis.", "slot"), ("Né le XX/XX/XXXX", "slot"),
        ("[À compléter]", "slot"), ("__SEXE__", "slot"), ("Titre\nLorem ipsum dolor sit amet.", "filler"), ("bla blabla asdf toto", "filler"), ("Accueil\nErreur 404 - la page demandée est introuvable.\nAide", "error"),
        ("Veuillez activer JavaScript pour afficher ce compte rendu.", "script"), ("Le portail a affiché une erreur 404 lors de la consultation, sans conséquence pour le suivi.", None),
        ("The patient said the browser asked to enable JavaScript; a paper copy was given. Liver normal.", None), ("Foie normal. Rate normale.", None), ("texte " * 20_000 + "Erreur 404 - la page demandée est introuvable.", "filler"), ("".join(f"nodule {i} du foie de {i} mm et " for i in range(3000)) + "Erreur 404 - la page demandée est introuvable.", None), ("{{ n​om }}", "slot"),
    ],
)
def test_residue(text, kind, letters):
    assert residue.judge(text, model=letters)[0] == kind


@pytest.fixture(scope="module")
def letters(spark, sf):
    return residue.letter_model(spark.read.parquet(f"{sf}/documents.parquet"))


@pytest.mark.parametrize(
    "text, kind",
    [
        ("502 Proxy Error: upstream host unreachable. Request ID 8812.", "error"), ("HTTP Status 500 – The server encountered a condition that prevented it from fulfilling the request.", "error"),
        ("Exception in thread main: renderer.NullReport at stage 5 (ref F59671)", "error"), ("Morbi gravida, nunc et tempor vehicula, sapien lectus congue augue, sed luctus velit. Integer feugiat scelerisque varius.", "filler"),
        ("Bitte aktivieren Sie Skripte.", "script"), ("Este sitio necesita JavaScript. Por favor, habilite los scripts.", "script"), ("Votre navigateur n'est pas pris en charge.", "script"), ("Datei nicht gefunden. Bitte versuchen Sie es erneut.", "error"),
        ("La patiente signale une erreur sur la page du portail.", None), ("She said the server was unavailable.", None), ("Échec de la première ligne, relais par sorafenib.", None), ("Carcinome hépatocellulaire moyennement différencié, marges saines.", None),
    ],
)
def test_residue_unseen_wordings(text, kind, letters):
    assert residue.judge(text, model=letters)[0] == kind


def test_residue_without_a_model():
    assert residue.judge("Morbi gravida nunc tempor vehicula sapien lectus")[0] is None and residue.judge("Erreur 404 : page introuvable.")[0] == "error"


@pytest.mark.parametrize(
    "text, kind",
    [
        ("Foo bar baz " * 9, "filler"), ("Microscopy\n" + "Foo bar baz " * 8, "filler"), ("abc " * 50, "filler"), ("Antécédents\n" + "abc " * 50, "filler"), ("Texte d'exemple " * 10, "filler"),
        ("Test test test " * 30, "filler"), ("Description goes here. Your heading here. Dummy content for layout.", "filler"), ("Your heading here.", "filler"), ("essai test titi tata", "filler"),
        ("Contenu à venir " * 6, "filler"), ("Conclusion\n" + "Rien à lire. " * 6, "filler"), ("Mot mot vide " * 6, "filler"), ("gauche droite " * 9, "filler"),  # unlisted phrases, repeated
        ("Test positif.", None), ("Essai clinique.", None), ("Caryotype 47,XXX.", None), ("Pression 3 bar.", None), ("Score ABC élevé.", None), ("[illisible] mot " * 9, None), ("non lu illisible " * 9, None), ("12 mm 12 mm " * 9, None),
        ("Contenu à venir " * 4 + "\nLe foie est normal, la rate est normale, les reins sont normaux, la vessie est vide et le pancréas est homogène.", None),
        ("Foie normal. Rate normale. " * 3, None), ("Une lésion du foie mesure 12 mm. " * 9, None), ("| oui non | oui non | oui non | oui non |\nFoie normal.", None),
    ],
)
def test_residue_filler_families(text, kind, letters):
    assert residue.judge(text, model=letters)[0] == kind


def test_repeated_phrase_is_counted_once():
    low = "gauche droite gauche droite gauche droite gauche droite gauche droite gauche droite gauche droite gauche droite"
    assert residue.repeated(low + " et le foie") == [(0, len(low))]


def test_residue_tables(spark):
    df = spark.createDataFrame([(1, "{{x}}", "s"), (1, "{{x}}", "s"), (2, "Foie normal.", "s"), (3, None, "s")], "doc_id long, text string, residue_kind string")
    assert [r["doc_id"] for r in residue.p9_found(df).collect()] == [1, 1]
    assert sorted(r["doc_id"] for r in residue.p9_clean(df.drop("residue_kind")).collect()) == [2, 3]
    assert residue.p9_found(df.where("false").withColumn("x", F.lit(1))).count() == 0
