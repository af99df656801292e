from pyspark.sql import functions as F

from formloom.operators import analytes, units

REF = "canonical_key string, label_fr string, label_en string, aliases array<string>"
FORMS = [
    ("Albumine", "Albumine plasmatique", "Plasma albumin", ["ALB"]),
    ("AST", "Aspartate aminotransférase", "Aspartate aminotransferase", ["ASAT", "TGO"]),
    ("ALT", "Alanine aminotransférase", "Alanine aminotransferase", ["ALAT"]),
    ("CRP", "Protéine C réactive", "C-reactive protein", []),
    ("WBC", "Leucocytes", "White blood cells", ["GB"]),
]
UNITS = [
    ("Albumine", "g/L", True, 1.0, 0.0), ("Albumine", "g/dL", False, 10.0, 0.0), ("WBC", "G/L", True, 1.0, 0.0), ("WBC", "/mm3", False, 0.001, 0.0),
    ("HbA1c", "%", True, 1.0, 0.0), ("HbA1c", "mmol/mol", False, 0.0915, 2.15), ("CRP", "mg/L", True, 1.0, 0.0), ("CRP", "mg/dL", False, 10.0, 0.0),
    ("AST", "U/L", True, 1.0, 0.0), ("AST", "µkat/L", False, 60.0, 0.0), ("Size_major_nodule_mm", "mm", True, 1.0, 0.0), ("Size_major_nodule_mm", "cm", False, 10.0, 0.0),
]
LINES = "line_id long, name string, canonical_name string, value struct<kind:string,s:string,n:double,b:boolean>, unit string, raw_text string, extra string"


def _ref(spark):
    return spark.createDataFrame(FORMS, REF), spark.createDataFrame(UNITS, "canonical_key string, unit_code string, is_common boolean, factor double, shift double")


def _n(x):
    return ("n", None, x, None)


def test_names_resolve(spark):
    ref, _ = _ref(spark)
    rows = [
        (1, "aspartate  aminotransferase", None), (2, "A.L.B.", None), (3, "réactive C Protéine", None), (4, "Leucocy†es", None), (5, "Albumi. plasmati.", None), (6, "Aspratate aminotransferse", None),
        (7, "Haptoglobine", None), (8, None, "ALT"), (9, "  ", " alt"), (10, None, None), (11, "", ""), (12, "x" * 5000, None), (13, "ASAT (automate 2)", None), (14, "Leucocytes - sérum", None),
    ]
    df = spark.createDataFrame([(i, n, c, None, None, None, "e") for i, n, c in rows], LINES)
    got = {r["line_id"]: r["analyte"] for r in analytes.resolve(df, ref).collect()}
    assert got == {1: "AST", 2: "Albumine", 3: "CRP", 4: "WBC", 5: "Albumine", 6: "AST", 7: None, 8: "ALT", 9: "ALT", 10: None, 11: None, 12: None, 13: "AST", 14: "WBC"}


def test_lab_quantities(spark):
    _, ur = _ref(spark)
    rows = [
        (1, "Albumine", _n(4.28), "g/100 mL", None), (2, "Albumine", _n(42.8), "gr/L", None), (3, "WBC", _n(6500.0), None, "Leucocytes : 6 500 /mm³"), (4, "WBC", _n(6.5), "10^3/mm3", None),
        (5, "Albumine", ("s", "< 3,1 g/dL", None, None), "?", None), (6, "Albumine", _n(28.3), "-", "ALB : 2B.3 g/L 17,0 à 42,5"), (7, "AST", _n(0.57), None, "AST\t0.57\tμkat/L"),
        (8, "CRP", _n(5.0), None, "CRP : 5"), (9, "CRP", ("s", "hémolysé", None, None), "mg/dL", "CRP : hémolysé"), (10, "CRP", None, None, None), (11, "Zinc", _n(1.0), "g/L", None),
        (12, "Albumine", _n(4.0), "G/DL", None), (13, "Albumine", _n(4.0), "furlong", None), (1, "Albumine", _n(4.28), "g/100 mL", None),
    ]
    df = spark.createDataFrame([(i, a, None, v, u, t, a) for i, a, v, u, t in rows], LINES).withColumn("analyte", F.col("name"))
    got = {r["line_id"]: r for r in units.lab_quantities(df, ur).collect()}
    value = lambda i: (got[i]["unit_code"], got[i]["common_value"] and round(got[i]["common_value"], 6), got[i]["same_as_common"])
    assert value(1) == ("g/dL", 42.8, False)
    assert value(2) == ("g/L", 42.8, True)
    assert value(3) == ("/mm3", 6.5, False)
    assert value(4) == ("G/L", 6.5, True)
    assert value(5) == ("g/dL", 31.0, False) and got[5]["bound"] == "<"
    assert value(6) == ("g/L", 28.3, True)
    assert value(7) == ("µkat/L", 34.2, False)
    assert value(8) == (None, 5.0, None) and got[8]["unit_from"] == "default"
    assert got[9]["number"] is None and got[9]["common_value"] is None
    assert got[10]["number"] is None and got[11]["unit_code"] is None and got[13]["unit_code"] is None
    assert value(12) == ("g/dL", 40.0, False)
    assert units.lab_quantities(df, ur).count() == len(rows)  # repeated rows stay


def test_observations_take_the_unit_beside_their_number(spark):
    _, ur = _ref(spark)
    schema = "observation_id string, canonical_key string, raw_value string, normalized_value struct<kind:string,s:string,n:double,b:boolean>, unit string, evidence_text string"
    rows = [
        ("a", "Size_major_nodule_mm", "6,8", _n(6.8), None, "Lésion cible : 6,8. La cible est chiffrée à 7,8 cm contre 95 mm."), ("b", "Size_major_nodule_mm", "6,8", _n(6.8), "n/a", "Nodule 6,8 cm"),
        ("c", "HbA1c", "45,9 mmol/mol", None, None, None), ("d", "CRP", None, None, None, None), ("e", "AST", "~0.5", _n(0.5), "microkat/L", ""),
    ]
    obs = spark.createDataFrame(rows, schema)
    got = {r["observation_id"]: (r["unit_code"], r["common_value"] and round(r["common_value"], 3)) for r in units.observation_quantities(obs, ur).collect()}
    assert got == {"a": (None, 6.8), "b": ("cm", 68.0), "c": ("mmol/mol", 6.35), "d": (None, None), "e": ("µkat/L", 30.0)}
    lines = spark.createDataFrame([], LINES).withColumn("analyte", F.col("name"))
    assert {(r[0], r[1], r[2]) for r in units.p4_found(lines, obs, ur).collect()} == {("observation", "b", "cm"), ("observation", "c", "mmol/mol"), ("observation", "e", "µkat/L")}


def test_spellings_have_one_size(spark):
    a = {(r["ukey"], r["dim"]): r["size"] for r in units.alias_table(spark).collect()}
    spelled = {
        "10*9/L": ("10^9/l", "count", 1e9), "x10^12/L": ("10^12/l", "count", 1e12), "par mm3": ("/mm3", "count", 1e6), "éléments/mm3": ("/mm3", "count", 1e6), "mM": ("mmol/l", "mol", 1e-3), "MM": ("mm", "m", 1e-3),
        "mg%": ("mg/dl", "g", 1e-2), "µUI/mL": ("uu/ml", "u", 1e-3), "mUI/L": ("mu/l", "u", 1e-3), "pour cent": ("%", "%", 1.0), "grammes/litre": ("g/l", "g", 1.0), "mm première heure": ("mm/h", "mm/h", 1.0), "pg/cellule": ("pg", "pg", 1.0),
    }
    got = {r["u"]: r["k"] for r in spark.createDataFrame([(u,) for u in spelled], "u string").select("u", units.unit_key(F.col("u")).alias("k")).collect()}
    for u, (key, dim, size) in spelled.items():
        assert got[u] == key
        assert abs(a[key, dim] / size - 1) < 1e-9
