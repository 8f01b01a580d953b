"""Registered queries of the registry's own functions: rows are made from keys of the driver's tables, so that SQL can tell what must come out."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.functions import classify, parse, pii, text
from tallygrove.operators import cascade, items, linking, marts
from tallygrove.operators.checkpoints import shared_path
from tallygrove.sources import search_index as search
from tallygrove.plans.queries import _OFFERS, _PCT, _STATUS, _fold_sql, _offers, _r2, _status, query, table


def _cases(key: str, values: list[str | None]) -> str:
    """SQL: the value at the key's remainder."""
    quoted = ("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(quoted)) + " END"


_NAMES = ["Győr", "Łódź", "Dvořák", "Šibenik", "ĐAKOVO", "naïve ﬁ"]


@query(f"SELECT p_partkey, {_cases('p_partkey', ['gyor', 'odz', 'dvorak', 'sibenik', 'dakovo', 'naive fi'])} AS folded FROM part")
def fold_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", text.fold(F.expr(_cases("p_partkey", _NAMES))).alias("folded"))


#: Characters of the Latin, sign, number, enclosed and compatibility blocks.
_BLOCKS = [chr(c) for a, b in ((0xA0, 0x250), (0x1E00, 0x1F00), (0x2000, 0x2500), (0x3200, 0x3400), (0xFB00, 0xFB07), (0xFF01, 0xFF5F)) for c in range(a, b)]


def _block_list(of) -> str:
    return "[" + ", ".join("'" + of(c).replace("'", "''") + "'" for c in _BLOCKS) + "]"


def _nfkd(c: str) -> str:
    """What Unicode's rule gives for one character."""
    return unicodedata.normalize("NFKD", {"đ": "d", "Đ": "D"}.get(c, c)).encode("ascii", "ignore").decode().lower()


@query(f"""WITH b AS MATERIALIZED (SELECT {_block_list(lambda c: c)} AS given, {_block_list(_nfkd)} AS want)
    SELECT doc_id, md5(replace({_fold_sql('text')}, ' ', want[1 + coalesce(doc_id, 0) % {len(_BLOCKS)}] || ' ')) AS folded_md5 FROM documents, b""")
def fold_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Every document folded, with a character of the blocks before each of its spaces: the next document has the next character."""
    given = F.substring(F.lit("".join(_BLOCKS)), F.lit(1) + (F.coalesce("doc_id", F.lit(0)) % len(_BLOCKS)).cast("int"), F.lit(1))
    marked = F.replace(F.coalesce("text", F.lit("")), F.lit(" "), F.concat(given, F.lit(" ")))
    return table(spark, sf, "documents").select("doc_id", F.md5(text.fold(marked).cast("binary")).alias("folded_md5"))


#: description, kind, type
_TYPED = [
    ("Jednosobni stan", "nekretnina", "stan"), ("Stan", "nekretnina", "stan"), ("Prodaje se stan", "nekretnina", "stan"), ("nestan x", "nekretnina", "ostalo"),
    ("krava i junica", "imovina", "pokretnina"), ("krava na k.o. Lipa", "imovina", "ostalo"), ("Obiteljska kuća", "nekretnina", "kuca"), ("oranica u polju", "nekretnina", "poljoprivredno-zemljiste"),
    ("garažno mjesto", "nekretnina", "garaza"), ("udio", "pravo", "pravo"), ("kuća", "Pokretnina", "pokretnina"), ("dvorište", "nekretnina", "zemljiste"), ("", "", "ostalo"),
]


@query(f"SELECT p_partkey, {_cases('p_partkey', [t for _, _, t in _TYPED])} AS property_type FROM part")
def property_types(spark: SparkSession, sf: str) -> DataFrame:
    description, kind = (F.expr(_cases("p_partkey", [row[k] for row in _TYPED])) for k in (0, 1))
    return table(spark, sf, "part").select("p_partkey", classify.property_type(description, kind).alias("property_type"))


#: text, text without personal data
_PRIVATE = [
    ("ovršenik Ivan Horvat iz Splita, Ilica 5, stan", "ovršenik [ime uklonjeno], stan"), ("Pero Perić, vl. obrta Val", "[ime uklonjeno], vl. obrta Val"),
    ("OIB: 12345678901 i mob. 091 123 4567", "[OIB uklonjen] i [telefon uklonjen]"), ("mail a.b@mail.example.com, kraj", "mail [e-mail uklonjen], kraj"),
    ("račun HR1212345678901234567.", "račun [IBAN uklonjen]."), ("kuća u cvijeću", "kuća u cvijeću"), ("broj 12345678901, dalje", "broj [OIB uklonjen], dalje"),
    ("IVAN HORVAT, kuća", "[ime uklonjeno], kuća"), ("Nekretnina Ivana Horvata u selu", "Nekretnina [ime uklonjeno] u selu"), ("kuća, ; vrt", "kuća; vrt"),
]


@query(f"SELECT s_suppkey, {_cases('s_suppkey', [b for _, b in _PRIVATE])} AS redacted FROM supplier")
def registry_redact(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select("s_suppkey", pii.redact(F.expr(_cases("s_suppkey", [a for a, _ in _PRIVATE])))["text"].alias("redacted"))


_VIEWED = [("Svakog četvrtka od 13,00 do 14,00 sati, tel. 091 123 4567", "četvrtka od 13,00 do 14,00"), ("po dogovoru", "Po dogovoru"), ("", ""), ("utorkom u 10 sati", "utorkom u 10 sati"), ("petkom", "")]


@query(f"SELECT s_suppkey, {_cases('s_suppkey', [b for _, b in _VIEWED])} AS viewing FROM supplier")
def viewing_slots(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select("s_suppkey", pii.viewing_window(F.expr(_cases("s_suppkey", [a for a, _ in _VIEWED]))).alias("viewing"))


#: description, kind, type, label, area
_SOLD = [
    ("Stan u Rijeci, 80 m²", "nekretnina", "stan", "Stan", 80), ("oranica od 2 ha", "nekretnina", "poljoprivredno-zemljiste", "Poljoprivredno zemljište", 20000),
    ("kuća od 120 m2", "nekretnina", "kuca", "Kuća", 120), ("krava i junica", "imovina", "pokretnina", "Pokretnina", None), ("Garažno mjesto 12 m²", "nekretnina", "garaza", "Garaža / parkirno mjesto", 12),
]
_FIELDS = "case_ref auction_id description kind issuer scope sale_method round estimated opening minimum deposit step decision_date publish_start auction_start auction_end deposit_value_date extendable snapshot_date".split()


def _snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as snapshot rows: amounts in two notations, dates as the source has them."""
    made = {
        "case_ref": "' Ovr-' || o_orderkey", "auction_id": "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END",
        "description": _cases("o_orderkey", [r[0] for r in _SOLD]), "kind": _cases("o_orderkey", [r[1] for r in _SOLD]),
        "issuer": "CASE WHEN o_orderkey % 2 = 0 THEN 'Javni bilježnik Ana Anić' ELSE 'Općinski sud u Splitu' END", "scope": "''", "sale_method": "'dražba'", "round": "CASE WHEN o_orderkey % 2 = 0 THEN 'Prva' ELSE 'Druga' END",
        "estimated": "CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS STRING) END",
        "opening": "translate(format_number(CAST(floor(o_totalprice * 0.75D) AS BIGINT), 0), ',', '.') || ',' || lpad(CAST(o_orderkey % 100 AS STRING), 2, '0') || ' EUR'", "minimum": "CASE WHEN o_orderkey % 4 <> 1 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END", "deposit": "CAST(o_custkey AS STRING) || ',5 EUR (1,00 HRK)'", "step": "' 1.500,00 '",
        "decision_date": "CASE WHEN o_orderkey % 6 <> 5 THEN date_format(o_orderdate - INTERVAL 40 DAYS, 'dd.MM.yyyy') END", "publish_start": "date_format(o_orderdate - INTERVAL 9 DAYS, 'dd.MM.yyyy HH:mm:ss')", "auction_start": "date_format(o_orderdate, 'dd.MM.yyyy HH:mm')", "auction_end": "date_format(o_orderdate + INTERVAL 30 DAYS, 'dd.MM.yyyy HH:mm:ss')",
        "deposit_value_date": "'nije datum'", "extendable": "CASE o_orderkey % 3 WHEN 0 THEN 'Da' WHEN 1 THEN ' Da ' ELSE 'Ne' END", "snapshot_date": "'15.06.1998'",
    }
    return table(spark, sf, "orders").select("o_orderkey", *(F.expr(made[f]).alias(f) for f in _FIELDS))


_ESTIMATE = "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_totalprice AS DECIMAL(16,2)) END"
_OPENING = "CAST((CAST(floor(o_totalprice * 0.75) AS BIGINT) * 100 + o_orderkey % 100) / 100 AS DECIMAL(16,2))"
_AREA = _cases("o_orderkey", [None if r[4] is None else str(r[4]) for r in _SOLD])


def _items(spark: SparkSession, sf: str) -> DataFrame:
    clean = items.sanitise(_snapshot(spark, sf), _FIELDS, "description", "issuer", key=("o_orderkey",))
    return items.to_items(clean, {f: f for f in _FIELDS}, F.lit("1998-06-15").cast("timestamp_ntz"), key=("o_orderkey",))


_HUNDRED = f"CAST((CAST({_ESTIMATE} AS DOUBLE) - CAST({_OPENING} AS DOUBLE)) / CAST({_ESTIMATE} AS DOUBLE) * 100 AS DECIMAL(18,6))"
_DISCOUNT = f"CASE WHEN {_ESTIMATE} > 0 THEN round({_HUNDRED}, 2) END"
_DOUBTFUL = f"coalesce({_DISCOUNT} >= 99 OR ({_OPENING} < 1 AND {_ESTIMATE} > 1000), false)"
#: The mapped item's columns: name, SQL over orders.
_MAPPED = {
    "case_ref": "'Ovr-' || o_orderkey", "auction_id": "CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) END",
    "issuer_type": "CASE WHEN o_orderkey % 2 = 0 THEN 'javni_biljeznik' ELSE 'opcinski_sud' END", "issuer_name": "CASE WHEN o_orderkey % 2 = 0 THEN 'Javni bilježnik' ELSE 'Općinski sud u Splitu' END",
    "description": _cases("o_orderkey", [r[0] for r in _SOLD]), "property_type": _cases("o_orderkey", [r[2] for r in _SOLD]), "procedure_type": "'ovrha'", "sale_method": "'dražba'", "scope": "''",
    "estimated_value_eur": _ESTIMATE, "opening_price_eur": _OPENING, "minimum_price_eur": "CASE WHEN o_orderkey % 4 <> 1 THEN CAST(floor(o_totalprice) AS DECIMAL(16,2)) END",
    "deposit_eur": "CAST(o_custkey + 0.5 AS DECIMAL(16,2))", "bid_step_eur": "CAST(1500 AS DECIMAL(16,2))", "current_bid_eur": "CAST(NULL AS DECIMAL(16,2))",
    "discount_pct": _DISCOUNT, "discount_suspicious": _DOUBTFUL, "area_m2": f"CAST({_AREA} AS DECIMAL(16,2))", "area_unit_source": _cases("o_orderkey", ["m²", "ha", "m2", None, "m²"]),
    "auction_round": "CASE WHEN o_orderkey % 2 = 0 THEN 'Prva' ELSE 'Druga' END", "auction_round_no": "CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END",
    "decision_date": "CASE WHEN o_orderkey % 6 <> 5 THEN o_orderdate - INTERVAL 40 DAY END", "publish_start": "o_orderdate - INTERVAL 9 DAY", "auction_start": "o_orderdate", "auction_end": "o_orderdate + INTERVAL 30 DAY",
    "deposit_value_date": "CAST(NULL AS TIMESTAMP)", "extendable": "o_orderkey % 3 <> 2", "viewing_time": "''", "source_snapshot_date": "DATE '1998-06-15'", "status": _STATUS,
}
_AMOUNTS = [c for c in _MAPPED if c.endswith(("_eur", "_pct", "_m2"))]
_TIMES = ["decision_date", "publish_start", "auction_start", "auction_end", "deposit_value_date"]


def _told(c: str, sql: str) -> str:
    kind = "DOUBLE" if c in _AMOUNTS else "TIMESTAMP" if c in _TIMES else "INTEGER" if c == "auction_round_no" else None
    return f"CAST({sql} AS {kind}) AS {c}" if kind else f"{sql} AS {c}"


@query(f"SELECT o_orderkey, {', '.join(_told(c, sql) for c, sql in _MAPPED.items())} FROM orders")
def items_mapped(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot rows through allow-list, redaction and mapper: every column of the item but its key."""
    kind = lambda c: "double" if c in _AMOUNTS else "timestamp_ntz" if c in _TIMES else None
    return _items(spark, sf).select("o_orderkey", *(F.col(c).cast(kind(c)).alias(c) if kind(c) else F.col(c) for c in _MAPPED))


_PLACE = "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'Vela Luka' END"


def _money_sql(x: str, places: int, thousands: str) -> str:
    """SQL: a number with signs for thousands and a decimal comma."""
    return f"replace(replace(replace(format('{{:,.{places}f}}', CAST(round(CAST({x} AS DECIMAL(18,6)), {places}) AS DOUBLE)), ',', '#'), '.', ','), '#', '{thousands}')"


_EUR = f"regexp_replace({_money_sql('opening_price_eur', 2, text.NBSP)}, ',00$', '') || '{text.NBSP}€'"


@query(f"""WITH m AS (SELECT o_orderkey, {', '.join(f'{sql} AS {c}' for c, sql in _MAPPED.items())}, {_cases('o_orderkey', [r[3] for r in _SOLD])} AS label, {_PLACE} AS city FROM orders),
    t AS (SELECT *, coalesce(city, 'Hrvatska') AS place, date_diff('day', DATE '1998-06-15', CAST(auction_end AS DATE)) AS days FROM m)
    SELECT o_orderkey, label AS type_label, CASE status WHEN 'najavljeno' THEN 'Najavljeno' WHEN 'u_tijeku' THEN 'U tijeku' ELSE 'Završeno' END AS status_label, 'Ovrha' AS procedure_label,
    label || coalesce(' ' || {_money_sql('area_m2', 0, text.NBSP)} || ' m²', '') || ', ' || place AS card_title,
    label || coalesce(', ' || {_money_sql('area_m2', 0, text.NBSP)} || '{text.NBSP}m²', '') || ', ' || CASE WHEN city IS NULL THEN '' ELSE 'u mjestu ' END || place || ', početna cijena ' || {_EUR}
        || CASE WHEN discount_pct IS NOT NULL AND NOT discount_suspicious THEN ', ' || {_money_sql('discount_pct', 1, '')} || '{text.NBSP}% ispod procjene' ELSE '' END || '. Sudska dražba (ovrha). Službeni podaci FINA Očevidnika.' AS meta_description,
    CASE WHEN property_type = 'pokretnina' THEN '/pokretnine/' WHEN city IS NULL THEN '/nekretnine/nepoznata-lokacija/ostalo/' ELSE '/nekretnine/dubrovacko-neretvanska-zupanija/vela-luka/' END AS tree,
    CASE WHEN area_m2 >= 1 AND NOT discount_suspicious THEN round(CAST(CAST(opening_price_eur AS DOUBLE) / CAST(area_m2 AS DOUBLE) AS DECIMAL(18,6)), 2)::DOUBLE END AS price_per_m2,
    CASE WHEN status IN ('najavljeno', 'u_tijeku') AND days BETWEEN 0 AND 60 THEN days END::INTEGER AS days_left FROM t""")
def items_decorated(spark: SparkSession, sf: str) -> DataFrame:
    """Labels, titles, descriptions, url trees, prices per m² and days left."""
    placed = _items(spark, sf).withColumn("city", F.expr(_PLACE)).withColumn("county", F.expr("CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'Dubrovačko-neretvanska županija' END")).withColumn("cadastral_municipality", F.lit(None).cast("string"))
    shown = items.decorate(placed, F.lit("1998-06-15").cast("date"))
    return shown.select("o_orderkey", "type_label", "status_label", "procedure_label", "card_title", "meta_description", F.regexp_replace("url", "[^/]+/$", "").alias("tree"), "price_per_m2", "days_left")


def _plural_sql(n: str, one: str, few: str, many: str) -> str:
    return f"CASE WHEN {n} % 100 BETWEEN 11 AND 14 THEN '{many}' WHEN {n} % 10 = 1 THEN '{one}' WHEN {n} % 10 BETWEEN 2 AND 4 THEN '{few}' ELSE '{many}' END"


@query(f"""WITH o AS (SELECT *, CASE WHEN o_orderkey % 9 <> 0 THEN CASE WHEN o_orderkey % 4 = 0 THEN round(o_totalprice) ELSE o_totalprice END END AS v, o_orderkey % 130 AS n FROM orders)
    SELECT o_orderkey, coalesce(regexp_replace({_money_sql('v', 2, text.NBSP)}, ',00$', '') || '{text.NBSP}€', '—') AS eur, coalesce({_money_sql('v', 1, '')} || '{text.NBSP}%', '—') AS pct, coalesce({_money_sql('v', 0, '')} || ' %', '—') AS pct_plain,
    coalesce({_money_sql('v', 0, text.NBSP)} || '{text.NBSP}m²', '—') AS area, coalesce({_money_sql('v', 0, ' ')} || ' €/m²', '—') AS ppm, strftime(o_orderdate, '%d.%m.%Y.') AS day, strftime(o_orderdate, '%d.%m.%Y. u %H:%M') AS moment,
    'još ' || n || ' ' || {_plural_sql('n', 'dan', 'dana', 'dana')} AS days, n || ' ' || {_plural_sql('n', 'nekretnina', 'nekretnine', 'nekretnina')} AS items, n || ' ' || {_plural_sql('n', 'predmet', 'predmeta', 'predmeta')} AS subjects FROM o""")
def formatted(spark: SparkSession, sf: str) -> DataFrame:
    """All formatters over the orders' amounts, dates and numbers."""
    o = table(spark, sf, "orders").withColumn("v", F.expr("CASE WHEN o_orderkey % 9 <> 0 THEN CASE WHEN o_orderkey % 4 = 0 THEN round(o_totalprice) ELSE o_totalprice END END")).withColumn("n", F.expr("o_orderkey % 130"))
    v, n, d = F.col("v"), F.col("n"), F.col("o_orderdate")
    made = {"eur": text.format_eur(v), "pct": text.format_pct(v), "pct_plain": text.format_pct_plain(v), "area": text.format_area(v), "ppm": text.format_ppm(v), "day": text.format_date(d), "moment": text.format_datetime(d)}
    made |= {"days": text.format_days(n), "items": text.format_items(n), "subjects": text.format_subjects(n)}
    return o.select("o_orderkey", *(c.alias(name) for name, c in made.items()))


@query("""SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name || ' | ' || p_brand || ' | ' || p_type), 'ring') AND contains(lower(p_name || ' | ' || p_brand || ' | ' || p_type), 'brand#1') AND contains(lower(p_name || ' | ' || p_brand || ' | ' || p_type), 'e') ORDER BY p_partkey LIMIT 60""")
def search_index(spark: SparkSession, sf: str) -> DataFrame:
    """An index of parts is written, and a search answered from it: a word, a part of a word and a single letter."""
    at = shared_path(spark, "search-index")
    search.build(table(spark, sf, "part"), at, "p_partkey", ["p_name", "p_brand", "p_type"])
    return search.search(spark, at, "p_partkey", "Ring brand#1 E", [F.col("p_partkey")]).select("p_partkey", "p_name")


@query("""SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'javni_biljeznik' ELSE 'opcinski_sud' END AS issuer_type, count(*)::BIGINT AS n, CASE WHEN o_orderkey % 2 = 0 THEN 'sjedište tijela nije dokaz lokacije' ELSE 'naselje nije prepoznato u opisu' END AS reason
    FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 5 = 1 GROUP BY ALL""")
def unresolved_items(spark: SparkSession, sf: str) -> DataFrame:
    placed = _items(spark, sf).withColumn("county", F.expr("CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 5 = 1 THEN NULL ELSE 'Z' END")).withColumn("location_raw", F.lit("")).withColumn("cadastral_municipality", F.lit(None).cast("string"))
    reasons = items.unresolved(placed).join(placed.select("item_key", "issuer_type"), "item_key").groupBy("issuer_type", "reason").agg(F.count(F.lit(1)).alias("n"))
    return reasons.select("issuer_type", "n", "reason")


#: text, issuer, issuer type; county, city, confidence, step
_PLACED = [
    ("stan, k.o. Primorska", "", "fina", "Primorska županija", None, "srednja", 1),
    ("kuća u Lipovcu, k.č. 5", "", "fina", "Primorska županija", "Lipovac", "visoka", 2),
    ("kuća u Novigradu, zk odjel Brod", "", "fina", "Slavonska županija", "Novigrad", "visoka", 3),
    ("kuća u Dugopolju", "", "fina", "Primorska županija", "Dugopolje", "srednja", 3),
    ("k.o. 111111 Nepoznato", "", "fina", "Slavonska županija", "Nepoznato", "srednja", 4),
    ("k.o. Trsat", "Općinski sud u Luki", "opcinski_sud", "Primorska županija", "Trsat", "visoka", 4),
    ("k.o. Trsat, ZK odjel Brod", "", "fina", "Primorska županija", "Trsat", "niska", 4),
    ("k.o. Lipovac", "Općinski sud u Luki, stalna služba u Brodu", "opcinski_sud", "Slavonska županija", None, "niska", 5),
    ("k.o. Lipovac", "Trgovački sud u Luki", "trgovacki_sud", "Primorska županija", "Lipovac", "srednja", 5),
    ("k.o. Dugopolje", "", "fina", "Primorska županija", "Dugopolje", "srednja", 6),
    ("zemlja, Zemljišnoknjižni odjel Brod", "", "fina", "Slavonska županija", "Brod", "srednja", 7),
    ("zemlja", "Općinski sud u Luki", "opcinski_sud", "Primorska županija", None, "srednja", 8),
    ("zemlja", "Trgovački sud u Luki", "trgovacki_sud", None, None, "nema", 9),
]


def registers(spark: SparkSession) -> cascade.Registers:
    """Small registers: a name of one county, one of two at 190:1 and one at 2:1, a unit without a county."""
    p, s = "Primorska županija", "Slavonska županija"
    frame = spark.createDataFrame
    settlements = [("Lipovac", p, 900), ("Dugopolje", p, 3248), ("Dugopolje", s, 17), ("Novigrad", p, 500), ("Novigrad", s, 900)]
    towns = [("lipovcu", "Lipovac", p), ("dugopolju", "Dugopolje", None), ("novigradu", "Novigrad", None), ("Brod", "Brod", s), ("brodu", "Brod", s)]
    units = [("111111", "NEŠTO", 45.0, 18.0, s), ("222222", "TRSAT", 45.3, 14.4, p), ("333333", "GRANICA", 45.01, 18.01, None)]
    return cascade.Registers(
        frame(settlements + [("Dugopolju", p, 3248), ("Dugopolju", s, 17), ("Novigradu", p, 500), ("Novigradu", s, 900)], "name string, county string, population int"),
        frame(towns, "form string, town string, county string"),
        frame([("Luki", p), ("Brodu", s)], "town string, county string"),
        frame([(p, 45.3, 14.4), (s, 45.0, 18.0)], "county string, lat double, lon double"),
        frame(units, "code string, name string, lat double, lon double, county string"),
    )


def _placed(k: int) -> str:
    return _cases("s_suppkey", [None if r[k] is None else str(r[k]) for r in _PLACED])


@query(f"SELECT s_suppkey AS item_id, {_placed(3)} AS county, {_placed(5)} AS location_confidence, CAST({_placed(6)} AS INTEGER) AS step FROM supplier")
def location_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """One text and issuer for each step of the cascade, and for each of its outcomes."""
    rows = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("item_id"), F.expr(_placed(0)).alias("text"), F.expr(_placed(1)).alias("issuer"), F.expr(_placed(2)).alias("issuer_type"))
    return cascade.locate(rows, registers(spark)).select("item_id", "county", "location_confidence", F.col("step").cast("int").alias("step"))


# ---- published analytics and lists

_AVG = _r2(f"avg(CAST({_PCT} AS DOUBLE)) FILTER (estimate > 0)")


def _pct_avg():
    return parse.round_half_up(F.avg(F.when(F.col("estimate") > 0, parse.discount_pct(F.col("estimate"), F.col("opening")).cast("double")))).cast("double").alias("avg_discount")


_DEPOSIT = "CASE WHEN l_partkey % 3 = 0 THEN estimate * 0.1 WHEN l_partkey % 3 = 1 THEN estimate * 0.05 END"


@query(f"WITH {_OFFERS} SELECT count({_DEPOSIT})::BIGINT AS n, {_r2(f'avg({_DEPOSIT} / estimate * 100)', 1)}::DOUBLE AS avg_share, {_r2(f'max({_DEPOSIT})')}::DOUBLE AS most FROM offers WHERE estimate > 0")
def deposit_share(spark: SparkSession, sf: str) -> DataFrame:
    d = _offers(spark, sf).where("estimate > 0").withColumn("d", F.expr(_DEPOSIT))
    return d.agg(F.count("d").alias("n"), parse.round_half_up(F.avg(F.col("d") / F.col("estimate") * 100), 1).cast("double").alias("avg_share"), parse.round_half_up(F.max("d")).cast("double").alias("most"))


@query(f"SELECT status, count(*)::BIGINT AS n, {_r2('count(*) / (SELECT count(*) FROM orders) * 100', 1)}::DOUBLE AS share FROM (SELECT {_STATUS.replace('o_orderdate IS NULL', 'o_orderkey % 3 = 0')} AS status FROM orders) GROUP BY 1")
def without_date(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of the statuses; every third order is given no date."""
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")))
    n = orders.groupBy(_status().alias("status")).agg(F.count(F.lit(1)).alias("n"))
    total = orders.count()
    return n.select("status", "n", parse.round_half_up(F.col("n") / F.lit(total) * 100, 1).cast("double").alias("share"))


_COUNTY = "'Z' || (l_suppkey % 21)"


@query(f"WITH {_OFFERS} SELECT {_COUNTY} AS county, count(*)::BIGINT AS n FROM offers WHERE p_type = 'SMALL' AND opening < 30000 GROUP BY 1 ORDER BY n DESC, county LIMIT 6")
def cheap_by_county(spark: SparkSession, sf: str) -> DataFrame:
    cheap = _offers(spark, sf).where("p_type = 'SMALL' AND opening < 30000").groupBy(F.expr(_COUNTY).alias("county")).agg(F.count(F.lit(1)).alias("n"))
    return cheap.orderBy(F.desc("n"), "county").limit(6)


@query(f"WITH {_OFFERS} SELECT {_COUNTY} AS county, count(*)::BIGINT AS n, {_AVG}::DOUBLE AS avg_discount FROM offers WHERE l_suppkey % 21 IN (0, 3, 7, 11, 14, 18) GROUP BY 1")
def coast_discounts(spark: SparkSession, sf: str) -> DataFrame:
    coast = _offers(spark, sf).where((F.col("l_suppkey") % 21).isin(0, 3, 7, 11, 14, 18))
    return coast.groupBy(F.expr(_COUNTY).alias("county")).agg(F.count(F.lit(1)).alias("n"), _pct_avg())


@query(f"WITH {_OFFERS} SELECT {_COUNTY} AS county, count(*)::BIGINT AS n, {_AVG}::DOUBLE AS avg_discount FROM offers WHERE p_type = 'LARGE' GROUP BY 1 ORDER BY n DESC, county LIMIT 5")
def farm_land(spark: SparkSession, sf: str) -> DataFrame:
    got = _offers(spark, sf).where("p_type = 'LARGE'").groupBy(F.expr(_COUNTY).alias("county")).agg(F.count(F.lit(1)).alias("n"), _pct_avg())
    return got.orderBy(F.desc("n"), "county").limit(5)


@query(f"WITH {_OFFERS} SELECT l_returnflag AS procedure, {_COUNTY} AS county, count(*)::BIGINT AS n, {_r2('avg(estimate)')}::DOUBLE AS avg_estimate, {_AVG}::DOUBLE AS avg_discount FROM offers WHERE p_type = 'PROMO' GROUP BY 1, 2")
def business_premises(spark: SparkSession, sf: str) -> DataFrame:
    got = _offers(spark, sf, "l_returnflag").where("p_type = 'PROMO'").groupBy(F.col("l_returnflag").alias("procedure"), F.expr(_COUNTY).alias("county"))
    return got.agg(F.count(F.lit(1)).alias("n"), parse.round_half_up(F.avg("estimate")).cast("double").alias("avg_estimate"), _pct_avg())


@query(f"""WITH {_OFFERS} SELECT {_COUNTY} AS county, l_suppkey AS city, count(*)::BIGINT AS n, count(p)::BIGINT AS n_priced, min(p) AS least, {_r2('avg(p)')}::DOUBLE AS mean, max(p) AS most
    FROM (SELECT *, CASE WHEN l_partkey % 2 = 0 THEN opening END AS p FROM offers WHERE p_type = 'ECONOMY') GROUP BY 1, 2""")
def garages(spark: SparkSession, sf: str) -> DataFrame:
    p = F.when(F.col("l_partkey") % 2 == 0, F.col("opening"))
    got = _offers(spark, sf).where("p_type = 'ECONOMY'").groupBy(F.expr(_COUNTY).alias("county"), F.col("l_suppkey").alias("city"))
    return got.agg(F.count(F.lit(1)).alias("n"), F.count(p).alias("n_priced"), F.min(p).alias("least"), parse.round_half_up(F.avg(p)).cast("double").alias("mean"), F.max(p).alias("most"))


@query(f"WITH {_OFFERS} SELECT l_returnflag AS procedure, count(*)::BIGINT AS n, {_AVG}::DOUBLE AS avg_discount, {_r2('avg(estimate)')}::DOUBLE AS avg_estimate FROM offers GROUP BY 1")
def procedure_amounts(spark: SparkSession, sf: str) -> DataFrame:
    return _offers(spark, sf, "l_returnflag").groupBy(F.col("l_returnflag").alias("procedure")).agg(F.count(F.lit(1)).alias("n"), _pct_avg(), parse.round_half_up(F.avg("estimate")).cast("double").alias("avg_estimate"))


@query(f"""WITH g AS (SELECT o_custkey, count(*)::BIGINT AS n, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS a, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS b,
    arg_min(o_orderkey, (o_orderdate, o_orderkey)) FILTER (o_orderstatus <> 'F') AS live FROM orders GROUP BY 1)
    SELECT o_custkey, n, CASE WHEN a > b AND b > 0 THEN {_r2('(1 - b / a) * 100', 0)}::INTEGER END AS drop_pct, live FROM g WHERE n >= 3 ORDER BY n DESC, o_custkey LIMIT 8""")
def stubborn_groups(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("status", F.when(F.col("o_orderstatus") == "F", "zavrseno").otherwise("u_tijeku"))
    return marts.stubborn_groups(orders, "o_custkey", "o_orderdate", "o_totalprice", "status", "o_orderkey")


@query("""(SELECT 'priciest' AS list, o_orderkey AS key, o_totalprice AS value FROM orders WHERE o_totalprice <> 0 ORDER BY value DESC, key LIMIT 10)
    UNION ALL (SELECT 'types', n_nationkey, count(*)::DOUBLE FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 6)
    UNION ALL (SELECT 'sample', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' ORDER BY 2 LIMIT 15)""")
def home_lists(spark: SparkSession, sf: str) -> DataFrame:
    """The front page's lists: most valuable, most frequent; and the deterministic sample of a check."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    item = o.select(F.lit("priciest").alias("list"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("value"))
    top = item.where("value <> 0").orderBy(F.desc("value"), "key").limit(10)
    kinds = c.groupBy("c_nationkey").agg(F.count(F.lit(1)).cast("double").alias("value")).orderBy(F.desc("value"), "c_nationkey").limit(6)
    sampled = o.where("o_orderstatus = 'P'").select(F.lit("sample").alias("list"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("value")).orderBy("key").limit(15)
    return top.unionByName(kinds.select(F.lit("types").alias("list"), F.col("c_nationkey").cast("long").alias("key"), "value")).unionByName(sampled)


@query("""WITH g AS (SELECT o_custkey, string_agg(o_orderkey, ' ' ORDER BY o_orderdate, o_orderkey) AS members FROM orders GROUP BY 1 HAVING count(*) > 1) SELECT o_orderkey, members FROM orders JOIN g USING (o_custkey)""")
def group_members(spark: SparkSession, sf: str) -> DataFrame:
    """Each item with the members of its repeat group in order."""
    return marts.with_members(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey").select("o_orderkey", F.array_join(F.col("members").cast("array<string>"), " ").alias("members"))


@query("""WITH g AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS place, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WHERE o_custkey IS NOT NULL)
    SELECT o_custkey, ((place - 1) // 4)::INTEGER AS chunk, (((place - 1) // 4) * 4 + 1)::INTEGER AS first, string_agg(o_orderkey, ' ' ORDER BY place) AS members FROM g WHERE n > 1 GROUP BY ALL""")
def group_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Each repeat group once, in rows of four members."""
    got = linking.group_lists(table(spark, sf, "orders"), "o_custkey", "o_orderkey", ["o_orderdate"], 4)
    return got.select("o_custkey", "chunk", "first", F.array_join(F.col("members").cast("array<string>"), " ").alias("members"))


@query("""SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INTEGER AS place, (count(*) OVER (PARTITION BY o_custkey))::INTEGER AS members, ((place - 1) // 4)::INTEGER AS chunk
    FROM orders WHERE o_custkey IS NOT NULL QUALIFY members > 1""")
def group_membership(spark: SparkSession, sf: str) -> DataFrame:
    """Each item's place in its repeat group, and the row of group_lists that has it."""
    return linking.membership(table(spark, sf, "orders"), "o_custkey", "o_orderkey", ["o_orderdate"], 4)


#: Two snapshots of orders: the first of those before 1998, the second a later copy without a fifth of them, in which some decisions came later.
_FIRST, _SECOND = "o_orderdate < TIMESTAMP '1998-01-01'", "NOT (o_orderdate < TIMESTAMP '1998-01-01' AND o_orderkey % 5 = 2)"
_ROUND = "CASE WHEN o_orderpriority LIKE '5%' THEN 0 WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END"
_PUBLISHED = "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END"


def _decided(days: str) -> str:
    return f"CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + {days} END"


@query(f"""WITH v AS (SELECT o_orderkey, o_custkey AS g, coalesce(nullif({_ROUND}, 0), 99) AS r, coalesce({_decided("INTERVAL 5 DAY")}, {_PUBLISHED}) AS t1,
        coalesce({_decided("(CASE WHEN o_orderkey % 11 = 0 THEN INTERVAL 400 DAY ELSE INTERVAL 5 DAY END)")}, {_PUBLISHED}) AS t2, {_FIRST} AS was, {_SECOND} AS "is" FROM orders),
    a AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY r, t2 NULLS FIRST, o_orderkey) AS q FROM v WHERE "is"),
    f AS (SELECT o_orderkey, g, r, CASE WHEN "is" THEN t2 ELSE t1 END AS t, was, "is", was AND "is" AND t1 IS DISTINCT FROM t2 AS moved FROM v WHERE was OR "is"),
    h AS (SELECT g, max((r, coalesce(t, TIMESTAMP '0001-01-01'), o_orderkey)) FILTER (was) AS last, min((r, coalesce(t, TIMESTAMP '0001-01-01'), o_orderkey)) FILTER (NOT was) AS first, bool_or(moved) AS moved FROM f GROUP BY 1)
    SELECT f.o_orderkey, a.q::INTEGER AS snapshot_seq, row_number() OVER (PARTITION BY f.g ORDER BY f.r, f.t NULLS FIRST, f.o_orderkey)::INTEGER AS state_seq,
    CASE WHEN h.moved OR coalesce(h.first < h.last, false) THEN 'renumbered' WHEN f.was THEN 'kept' ELSE 'appended' END AS how
    FROM f JOIN h ON f.g = h.g LEFT JOIN a ON f.o_orderkey = a.o_orderkey""")
def repeat_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Attempts numbered within the latest snapshot alone, and over all versions by adding it to the linked state."""
    orders = table(spark, sf, "orders")
    order = ["r", "t", "o_orderkey"]

    def version(where: str, days: str) -> DataFrame:
        r, t = linking.repeat_order(F.expr(_ROUND), F.expr(_decided(days)), F.expr(_PUBLISHED))
        return orders.where(where).select("o_orderkey", F.col("o_custkey").alias("repeat_group"), r.alias("r"), t.alias("t"))

    by_order = [F.col(c).asc_nulls_first() for c in order]
    state = linking.link_repeats(version(_FIRST, "INTERVAL 5 DAYS"), "repeat_group", by_order)
    batch = version(_SECOND, "(CASE WHEN o_orderkey % 11 = 0 THEN INTERVAL 400 DAYS ELSE INTERVAL 5 DAYS END)")
    alone = linking.link_repeats(batch, "repeat_group", by_order).select("o_orderkey", F.col("repeat_seq").alias("snapshot_seq"))
    all_of = linking.link_increment(state, batch, "o_orderkey", order)
    return all_of.select("o_orderkey", F.col("repeat_seq").alias("state_seq"), "how").join(alone, "o_orderkey", "left").select("o_orderkey", "snapshot_seq", "state_seq", "how")


@query("""WITH c AS (SELECT n_regionkey AS r, list(DISTINCT n_nationkey % 4 ORDER BY n_nationkey % 4) AS a FROM nation GROUP BY 1), s AS (SELECT s_nationkey % 5 AS r, list(DISTINCT s_nationkey % 3 ORDER BY s_nationkey % 3) AS b FROM supplier GROUP BY 1)
    SELECT r, array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), ' ') AS without, array_to_string(list_sort(list_distinct(list_concat(a, b))), ' ') AS every, array_to_string(list_sort(list_intersect(a, b)), ' ') AS common FROM c JOIN s USING (r)""")
def county_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Difference, union and intersection of the sets that two registers give."""
    a = table(spark, sf, "nation").groupBy(F.col("n_regionkey").alias("r")).agg(F.collect_set(F.col("n_nationkey") % 4).alias("a"))
    b = table(spark, sf, "supplier").groupBy((F.col("s_nationkey") % 5).alias("r")).agg(F.collect_set(F.col("s_nationkey") % 3).alias("b"))
    told = lambda c: F.array_join(F.array_sort(c).cast("array<string>"), " ")
    return a.join(b, "r").select("r", told(F.array_except("a", "b")).alias("without"), told(F.array_union("a", "b")).alias("every"), told(F.array_intersect("a", "b")).alias("common"))
