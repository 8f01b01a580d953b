"""Scalar functions against expected values."""

import pytest
from pyspark.sql import functions as F

from tallygrove.functions import classify, parse, pii, text


def one(spark, column, **values):
    kinds = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'int'}" for k, v in values.items()) or "x int"
    row = tuple(values.values()) or (0,)
    return spark.createDataFrame([row], kinds).select(column.alias("r")).first()["r"]


def many(spark, make, inputs):
    rows = spark.createDataFrame(list(enumerate(inputs)), "i int, v string").select("i", make(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(rows)]


def test_money(spark):
    cases = {
        "39816.84": 39816.84, "59.725,26 EUR (449.999,97 HRK)": 59725.26, "30,31 EUR (228,37 HRK)": 30.31, "1.102.500,03": 1102500.03,
        "32.805": 32.81, "1,234,567": None, "3/4 procjene": None, "EUR 500": None, "": None, "-5 EUR": 5.0,
    }
    assert many(spark, parse.parse_money, list(cases)) == list(cases.values())
    assert many(spark, parse.parse_money, [None]) == [None]


def test_area(spark):
    got = many(spark, lambda c: parse.parse_area(c)["area"], ["80 m²", "1200 m2", "402 čhv, 3 ha", "0 m2", "k.c. 12/3", None])
    assert got == [80.0, 1200.0, 30000.0, None, None, None]


def test_dates_and_status(spark):
    got = many(spark, lambda c: parse.parse_datetime(c).cast("string"), ["01.02.2024", "01.02.2024 10:30", "01.02.2024 10:30:05", "2024-02-01", None])
    assert got == ["2024-02-01 00:00:00", "2024-02-01 10:30:00", "2024-02-01 10:30:05", None, None]
    day = lambda d: F.lit(d).cast("timestamp_ntz")
    ends = [("2024-01-02", "2024-01-03", "najavljeno"), ("2024-01-01", "2024-01-03", "u_tijeku"), ("2023-12-01", "2024-01-01", "u_tijeku"), ("2023-01-01", "2023-02-01", "zavrseno"), (None, "2024-01-01", "bez_termina")]
    for start, end, want in ends:
        assert one(spark, parse.derive_status(day(start), day(end), day("2024-01-01"))) == want


def test_discount(spark):
    assert float(one(spark, parse.discount_pct(F.col("e"), F.col("o")), e=200.0, o=50.0)) == 75.0
    assert one(spark, parse.discount_pct(F.col("e"), F.col("o")), e=0.0, o=50.0) is None
    assert one(spark, parse.is_suspicious(F.col("e"), F.col("o")), e=2000.0, o=0.13) is True
    assert one(spark, parse.is_suspicious(F.col("e"), F.col("o")), e=100.0, o=50.0) is False


def test_text(spark):
    assert many(spark, text.slugify, ["Građevinsko zemljište, Šibenik!", "  ", None]) == ["gradevinsko-zemljiste-sibenik", "", ""]
    got = [one(spark, text.hr_plural(F.col("n"), "a", "b", "c"), n=n) for n in (1, 3, 7, 11, 21, 22, 112)]
    assert got == ["a", "b", "c", "c", "a", "b", "c"]
    assert many(spark, text.sorted_words, ["Gora Bela", "bela-gora"]) == ["bela gora", "bela gora"]
    assert many(spark, lambda c: text.trim_at_stop_word(c, ["odjela", "suda"]), ["Grad Zagreb Odjela X", "Trsat"]) == ["Grad Zagreb", "Trsat"]
    assert one(spark, text.grounded(F.lit("Vela-Luka"), F.lit("u mjestu Vela Luka, otok"))) is True


def test_fingerprint_ignores_punctuation(spark):
    a, b = (many(spark, lambda c: text.property_fingerprint(F.lit("St-1"), c), [x])[0] for x in ("Kuća, u Splitu.", "kuca u splitu"))
    assert a == b


def test_classify(spark):
    assert many(spark, lambda c: classify.property_type(c, F.lit("nekretnina")), ["Obiteljska kuća", "Oranica", "nešto"]) == ["kuca", "poljoprivredno-zemljiste", "ostalo"]
    assert many(spark, classify.procedure_type, ["Ovr-1/20", "St-2", "x", None]) == ["ovrha", "stecaj", "ostalo", "ostalo"]
    assert many(spark, classify.issuer_type, ["Općinski sud u Splitu", "Trgovački sud", "Javni bilježnik Ana", "FINA", "", None]) == ["opcinski_sud", "trgovacki_sud", "javni_biljeznik", "fina", "nepoznato", "nepoznato"]


CANARY = "ovršenika Ivana Horvata, OIB: 12345678901, mob. 091 123 4567, a.b@mail.example.com"


def test_redaction(spark):
    done = many(spark, lambda c: pii.redact(c)["text"], [CANARY, None])
    assert "Horvat" not in done[0] and "12345678901" not in done[0] and "example" not in done[0]
    assert many(spark, lambda c: F.size(pii.scan(c)), done) == [0, 0]
    assert many(spark, lambda c: pii.redact(c)["text"], done) == done
    assert many(spark, lambda c: F.size(pii.scan(c)), ["id 12345678901, dalje"]) == [1]


def test_residual_names(spark):
    names = lambda c: pii.residual_names(c, ["Ivan", "Marko", "Ana"])
    assert many(spark, names, ["Nekretnina Ivana Horvata u selu", "ulica Ivana Horvata 5", "kuća", None]) == [["Ivana Horvata"], [], [], []]


#: text, names that go
PEOPLE = [
    ("Nekretnina Ivana Horvata u selu", ["Ivana Horvata"]), ("IVAN HORVAT, kuća", ["IVAN HORVAT"]), ("Marku Kraljeviću i Mariji Novak", ["Marku Kraljeviću", "Mariji Novak"]), ("ŽELJKA ŠUKER iz", ["ŽELJKA ŠUKER"]),
    ("Ana-Marija Horvat Perić-Babić i drugi", ["Ana-Marija Horvat Perić-Babić"]), ("Josip Juraj Strossmayer Drugi", ["Josip Juraj Strossmayer"]), ("BOŽIDAROM Magovcem", ["BOŽIDAROM Magovcem"]), ("Ivan  Horvat", ["Ivan  Horvat"]),
    ("ulica Ivana Gorana Kovačića, Split", []), ("na adresi Put Petra Svačića", []), ("trg Ante Starčevića", []), ("Ljudevita Gaja 8", []), ("Ante Starčevića 12b", []), ("Ivan Horvat d.o.o.", []),
    ("marko Marković", []), ("Anabela Kovač", []), ("Split Ivan", []), ("Marko", []), ("", []),
]


def test_gazetteer(spark):
    assert many(spark, pii.residual_names, [t for t, _ in PEOPLE]) == [n for _, n in PEOPLE]
    done = many(spark, lambda c: pii.redact(c), [t for t, _ in PEOPLE])
    assert [d["removed"].get("person_name_gazetteer", 0) for d in done] == [len(n) for _, n in PEOPLE]
    assert many(spark, pii.residual_names, [d["text"] for d in done]) == [[] for _ in PEOPLE]


def test_gazetteer_every_form(spark):
    """Each given name in each of its forms, by the forms' own rule and not by the pattern."""
    ends = ["om", "em", "ova", "eva", "inu", "in", "a", "u", "e", "i", "o"]
    forms = [n.capitalize() + e for n in pii.GIVEN_NAMES for e in ["", *ends]] + [n[:-1].upper() + e.upper() for n in pii.GIVEN_NAMES if n[-1] in "aeo" for e in ends]
    got = many(spark, pii.residual_names, [f"kod {f} Šimić, x" for f in forms])
    assert [f for f, g in zip(forms, got) if g != [f"{f} Šimić"]] == []


def test_tidy(spark):
    assert many(spark, lambda c: pii.redact(c)["text"], ["  a ,, b;\u00a0, c  \n d ", "a . b"]) == ["a , b, c d", "a . b"]
    assert many(spark, lambda c: pii.redact(c)["removed"], ["dužnik Pero Perić iz Splita, Ilica 5, OIB 12345678901"]) == [{"person_name": 1, "person_address": 1, "oib_labelled": 1}]


def test_redaction_looks_once(spark):
    """Each pattern stands twice in the plan, to replace and to count: a step's text is not made anew for every later one. A mask that is a hit itself counts."""
    done = spark.createDataFrame([("a@b.hr, 1.2.3.4 Ivan Horvat",)], "t string").select(pii.redact(F.col("t"), pii.GENERAL, mask="a@b.hr", roles=False).alias("r")).select("r.text", "r.removed")
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(pii.GENERAL["email"]) == 2
    assert done.first().asDict() == {"text": "a@b.hr, a@b.hr a@b.hr", "removed": {"email": 1, "ip": 1, "person_name_gazetteer": 1}}


def test_fold_by_rule(spark):
    """All characters of the basic plane: the ASCII of the compatibility decomposition, and letters without marks."""
    import unicodedata

    chars = [chr(c) for c in range(0x20, 0x10000) if not 0xD800 <= c < 0xE000]
    ascii_of = lambda c: unicodedata.normalize("NFKD", {"đ": "d", "Đ": "D"}.get(c, c)).encode("ascii", "ignore").decode().lower()
    rows = spark.createDataFrame([(c, f"aB{c}Ž{c}") for c in chars], "c string, t string")
    assert [r["c"] for r in rows.select("c", text.fold(F.col("t")).alias("f")).collect() if r["f"] != f"ab{ascii_of(r['c'])}z{ascii_of(r['c'])}"] == []
    assert many(spark, text.fold, ["m²", "½ ha", "ﬁnale Ǆ", "１２"]) == ["m2", "12 ha", "finale dz", "12"]
    assert many(spark, text.fold_keeping, ["Ćevapi đak", "м²й", "Łódź", "ﬁ"]) == ["cevapi dak", "м²и", "łodz", "ﬁ"]


def test_fold_has_its_tables_once(spark):
    """The tables are long: in a plan that folds a computed name each stands once; located registers' plans hold them no more."""
    made = spark.createDataFrame([("Žabac",)], "t string").select(text.fold(F.regexp_replace("t", "a", "b")).alias("f"))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(text.MARKED) == plan.count(text.PLAIN) == 1
    assert made.first()["f"] == "zbbbc"


@pytest.mark.parametrize("raw, want", [("Svakog četvrtka od 13,00 do 14,00 sati", True), ("po dogovoru, tel. 091 123 4567", True), ("", False)])
def test_viewing(spark, raw, want):
    got = many(spark, pii.viewing_window, [raw])[0]
    assert bool(got) == want and "091" not in got
