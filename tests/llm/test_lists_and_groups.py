import datetime
import random

import pytest
from pyspark.sql import functions as F

from formloom.llm import canonical, survivor

REF = [
    ("CRP", "Protéine C réactive", "C-reactive protein", ["PCR us"]), ("Hb", "Hémoglobine", "Haemoglobin", ["HGB"]), ("Potassium", "Potassium plasmatique", "Plasma potassium", []),
    ("Sodium", "Sodium plasmatique", "Plasma sodium", []), ("AST", "Aspartate aminotransférase", "Aspartate aminotransferase", ["ASAT"]), ("ALT", "Alanine aminotransférase", "Alanine aminotransferase", ["ALAT"]),
    ("AFP", "Alpha-foetoprotéine", "Alpha-fetoprotein", ["αFP"]),
]
LINES = "line_id long, name string, canonical_name string, text string, ref_key string"


def mapped(spark, names):
    ref = spark.createDataFrame(REF, "canonical_key string, label_fr string, label_en string, aliases array<string>")
    lines = spark.createDataFrame([(i, n, c, "x", "y") for i, (n, c) in enumerate(names)], LINES)
    return {r["line_id"]: r["canonical_key"] for r in canonical.p3_found(lines, ref).collect()}


def test_each_way_of_typing(spark):
    names = [
        ("réactive C Protéine", None), ("H.G.B.", None), ("hémoglobine (recheck)", None), ("Hémogl.", None), ("Hém0globine", None), ("plasma poasium", None), ("rCéatinine", None), ("Haptoglobine", None),
        (None, " crp"), ("  ", "ALAT "), (None, None), ("Hémoglobine", None), ("Aspratate aminortansferase", None), ("z" * 10_000, None), ("Α.F.P.", None), ("réactive C Protéine", None), ("A?AT", None),
    ]
    assert mapped(spark, names) == {
        0: "CRP", 1: "Hb", 2: "Hb", 3: "Hb", 4: "Hb", 5: "Potassium", 6: "UNMATCHED", 7: "UNMATCHED", 8: "CRP", 9: "ALT", 12: "AST", 13: "UNMATCHED", 14: "AFP", 15: "CRP", 16: "UNMATCHED",
    }


def test_no_rows(spark):
    assert mapped(spark, [(None, None)]) == {}


def _osa(a, b):
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_segments_lose_no_pair(spark):
    """Every pair within the allowed errors shares a segment: against all pairs by brute force."""
    rng = random.Random(5)
    forms = ["potassium", "hemoglobine", "protein", "sodium", "lactate", "fer serique", "gamma glutamyl transferase"]

    def spoil(w):
        for _ in range(2):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("aeinr") + w[i:], w[:i] + rng.choice("xyz") + w[i + 1 :], w[: max(i - 1, 0)] + w[max(i - 1, 0) : i + 1][::-1] + w[i + 1 :]])
        return w

    names = sorted({spoil(rng.choice(forms)) for _ in range(400)})
    f = spark.createDataFrame([(w, w, len(w)) for w in forms], "ref_key string, fkey string, flen int")
    n = spark.createDataFrame([(w,) for w in names], "nkey string")
    got = {(r["nkey"], r["fkey"]) for r in canonical.close_pairs(n, f, F.broadcast).collect()}
    want = {(a, b) for a in names for b in forms if _osa(a, b) <= 2 and (abs(len(a) - len(b)) <= 2)}
    assert want <= got


C = "candidate_id long, patient_id string, study_id string, field_name string, target_column string, value_text string, unit string, event_date date, confidence double, created_at timestamp, field string"
T1, T2 = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2)
DAY = datetime.date(2024, 1, 1)
DEFS = [("AST_inclusion", "AST T0 dosage", ["AST_T0"]), ("ALT_inclusion", "ALT T0 dosage", ["ALT_T0"])]


def defs(spark):
    return spark.createDataFrame(DEFS, "field_name string, target_column string, header_aliases array<string>")


def test_best_row_of_each_attribute(spark):
    rows = [
        (1, "p", "s", "AST_inclusion", None, "10", None, None, 0.5, T1, "x"), (2, "p", "s", None, "ast t0 dosage", " NA", "U/L", None, 60.0, T1, "x"), (3, "p", "s", "AST_inclsion", "", "12", "", DAY, 0.5, T2, "x"),
        (4, "p", "s", "AST.inclusion", "AST_T0", "13", None, DAY, None, T2, "x"), (5, "p", "s", "ALT_inclusion", None, "1", None, None, 0.9, T1, "x"), (6, None, "s", "AST_inclusion", None, "1", None, None, 0.9, T1, "x"),
        (7, "q", "s", "AST_inclusion", None, "1", None, None, 0.9, T1, "x"), (8, "q", "s", "AST_inclusion", None, "2", None, None, 0.9, T1, "x"), (9, "p", "s", "rien", "rien", "1", None, None, 0.9, T1, "x"),
    ]
    got = {tuple(r) for r in survivor.p5_found(spark.createDataFrame(rows, C), defs(spark)).collect()}
    assert got == {
        ("p", "s", "AST_inclusion", "value_text", 3), ("p", "s", "AST_inclusion", "unit", 2), ("p", "s", "AST_inclusion", "event_date", 3), ("q", "s", "AST_inclusion", "value_text", 7),
    }
    assert survivor.p5_found(spark.createDataFrame([], C), defs(spark)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_branch_and_bound_against_all_choices(spark, seed):
    rng = random.Random(seed)
    rows = [
        (i, f"p{rng.randrange(6)}", "s", None, None, rng.choice(["1", "2", None]), rng.choice(["a", "b", ""]), None, rng.choice([0.1, 0.5, 0.9, None]), rng.choice([T1, T2]), "AST_inclusion") for i in range(60)
    ]
    df = spark.createDataFrame(rows, C)
    bundles = [("value_text",), ("unit",)]
    s = survivor.survivors(df, ("patient_id", "field"), bundles, survivor.trust(F.col("confidence"), F.col("created_at"), F.col("candidate_id")), "candidate_id", fds=[("value_text", "unit")])
    got = {r["patient_id"]: tuple(r[f"b{j}"] and r[f"b{j}"]["id"] for j in range(2)) for r in s.collect()}

    def rank(r):
        return (0.0, "", 0) if r is None else (1e-6 if r[8] is None else r[8], str(r[9]), -r[0])

    for p in got:
        own = [r for r in rows if r[1] == p]
        known = {(r[5], r[6]) for r in own if r[5] and r[6]}
        choices = [
            (x, y) for x in [r for r in own if r[5]] + [None] for y in [r for r in own if r[6]] + [None] if x is None or y is None or (x[5], y[6]) in known
        ]
        best = max(choices, key=lambda c: [round(rank(c[0])[0] + rank(c[1])[0], 9), rank(c[0])[1:], rank(c[1])[1:]])
        assert got[p] == tuple(c and c[0] for c in best)


@pytest.mark.parametrize("seed", range(2))
def test_bundles_of_several_fields_under_two_dependencies(spark, seed):
    rng = random.Random(seed)
    rows = [(i, f"p{rng.randrange(8)}", rng.choice("xy"), rng.choice("uv"), rng.choice(["a", "b", "c", None]), rng.choice("mn"), rng.choice([1, 2, None]), rng.choice([0.1, 0.4, 0.45, 0.9, None]), T1) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, p string, street string, house string, town string, zip string, year int, confidence double, created_at timestamp")
    bundles = [("town", "zip"), ("street", "house"), ("year",)]
    fds = [("town", "street"), ("street", "year")]
    s = survivor.survivors(df, ("p",), bundles, survivor.trust(F.col("confidence"), F.col("created_at"), F.col("id")), "id", fds=fds)
    at = {"town": 4, "street": 2, "year": 6}
    for r in s.collect():
        own = [x for x in rows if x[1] == r["p"]]
        sides = {f: {(x[at[f[0]]], x[at[f[1]]]) for x in own} for f in fds}
        score = lambda x: 0.0 if x is None else 1e-6 if x[7] is None else x[7]
        pick = lambda f: [x for x in own if x[at[f]] is not None] + [None]
        fits = lambda f, x, y: x is None or y is None or (x[at[f[0]]], y[at[f[1]]]) in sides[f]
        most = max(score(x) + score(y) + score(z) for x in pick("town") for y in pick("street") if fits(fds[0], x, y) for z in pick("year") if fits(fds[1], y, z))
        got = [next((x for x in own if r[f"b{j}"] and x[0] == r[f"b{j}"]["id"]), None) for j in range(3)]
        assert abs(sum(map(score, got)) - most) < 1e-9
        assert fits(fds[0], got[0], got[1]) and fits(fds[1], got[1], got[2])
        assert got[0] is None or (r["b0"]["town"], r["b0"]["zip"]) == (got[0][4], got[0][5])
