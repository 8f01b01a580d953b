"""Registered query of the location cascade at size: registers of thousands of settlements and units, made from customers and parts, and texts that name them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.operators import cascade, location
from tallygrove.plans.queries import query, table


#: A number in letters: names of towns have no digits.
_LETTERS = "translate(CAST({} AS STRING), '0123456789', 'abcdefghij')"


def _grad(n: str) -> str:
    return f"'Grad' || {_LETTERS.format(n)}"


def _registers(spark: SparkSession, sf: str) -> cascade.Registers:
    """Counties by nation. A settlement for each customer; of ten, one is in a second county too small to matter, one in two alike. A unit for each part, every ninth of no county."""
    c, n, p = (table(spark, sf, t) for t in ("customer", "nation", "part"))
    zupa = "'Zupa' || {} || ' županija'"
    own = c.select(F.expr("'Mjesto' || c_custkey").alias("name"), F.expr(zupa.format("c_nationkey")).alias("county"), F.expr("CAST(1000 + c_custkey % 100 AS INT)").alias("population"))
    other = c.where("c_custkey % 10 IN (1, 2)").select(F.expr("'Mjesto' || c_custkey").alias("name"), F.expr(zupa.format("((c_nationkey + 1) % 25)")).alias("county"), F.expr("CAST(CASE WHEN c_custkey % 10 = 1 THEN 3 ELSE 900 END AS INT)").alias("population"))
    forms = c.where("c_custkey % 3 = 0").select(F.expr("'Mjestu' || c_custkey").alias("form"), F.expr("'Mjesto' || c_custkey").alias("town"), F.expr(f"CASE WHEN c_custkey % 10 NOT IN (1, 2) THEN {zupa.format('c_nationkey')} END").alias("county"))
    grad = F.expr("'Grad' || " + _LETTERS.format('n_nationkey'))
    county = F.expr(zupa.format("n_nationkey"))
    towns = forms.unionByName(n.select(grad.alias("form"), grad.alias("town"), county.alias("county")))
    lone = "p_partkey % 9 = 0"
    units = p.select(
        F.expr("CAST(100000 + p_partkey AS STRING)").alias("code"), F.expr("'OPCINA' || p_partkey").alias("name"), F.expr(f"CASE WHEN {lone} THEN -40D ELSE 40D + p_partkey % 25 END").alias("lat"),
        F.expr(f"CASE WHEN {lone} THEN p_partkey * 1D ELSE 15D END").alias("lon"), F.expr(f"CASE WHEN NOT {lone} THEN {zupa.format('(p_partkey % 25)')} END").alias("county"),
    )
    return cascade.Registers(own.unionByName(other), towns, n.select(grad.alias("town"), county.alias("county")), n.select(county.alias("county"), F.expr("40D + n_nationkey").alias("lat"), F.lit(15.0).alias("lon")), units)


#: Text and court by the order's key; k is its customer, n the customer's nation, p a part.
_TEXTS = [
    "'kuća u Mjesto' || k || ', vrt'", "'kuća u Mjestu' || k", "'stan, k.o. Opcina' || p", "'k.o. ' || (100000 + p) || ' Nepoznata'", "'k.o. opcina' || p", "'k.o. Opcina' || p", "'k.o. Opcina' || p || ', ZK odjel ' || " + _grad("(p + 1) % 25"),
    "'k.o. Mjesto' || k", "'k.o. Mjesto' || k", "'k.o. Mjesto' || k", "'kuća u Mjesto' || k || '. Vidi ' || " + _grad("n"), "'k.o. Zupa' || (p % 25)", "''", "NULL",
]
_COURTS = {5: "(p % 25)", 8: "n", 9: "((n + 2) % 25)"}


def _by_case(values: dict[int, str], other: str) -> str:
    return "CASE o_orderkey % 14 " + " ".join(f"WHEN {i} THEN {v}" for i, v in values.items()) + f" ELSE {other} END"


_COURT = _by_case({i: f"'Općinski sud u ' || {_grad(v)}" for i, v in _COURTS.items()}, "''")
_ROWS = "SELECT o_orderkey, o_custkey AS k, c_nationkey AS n, o_orderkey % 200 AS p, o_custkey % 10 AS t FROM orders JOIN customer ON o_custkey = c_custkey"
#: What comes out by case: (condition, county's number, city, confidence, step, raw, unit), the first that holds; '#' is the text's own name.
_M = "'Mjesto' || k"
_O = "'Opcina' || p"
_WANT = [
    ("c = 0 AND t NOT IN (1, 2)", "n", _M, "visoka", 2, _M, "NULL"), ("c = 0 AND t = 1", "n", _M, "srednja", 3, _M, "NULL"),
    ("c = 1 AND k % 3 = 0 AND t NOT IN (1, 2)", "n", _M, "visoka", 2, "'Mjestu' || k", "NULL"),
    ("c IN (2, 4) AND p % 9 <> 0", "p % 25", _O, "srednja", 4, _O, _O), ("c IN (2, 4)", "NULL", "NULL", "nema", 9, _O, _O),
    ("c = 3 AND p % 9 <> 0", "p % 25", "'Nepoznata'", "srednja", 4, "'Nepoznata'", "'Nepoznata'"), ("c = 3", "NULL", "NULL", "nema", 9, "'Nepoznata'", "'Nepoznata'"),
    ("c = 5 AND p % 9 <> 0", "p % 25", _O, "visoka", 4, _O, _O), ("c = 5", "p % 25", "NULL", "srednja", 8, "'Općinski sud u ' || " + _grad("p % 25"), _O),
    ("c = 6 AND p % 9 <> 0", "p % 25", _O, "niska", 4, _O, _O), ("c = 6", "(p + 1) % 25", _grad("(p + 1) % 25"), "srednja", 7, _grad("(p + 1) % 25"), _O),
    ("c = 7 AND t NOT IN (1, 2)", "n", _M, "srednja", 5, _M, _M), ("c = 7 AND t = 1", "n", _M, "srednja", 6, _M, _M), ("c = 7", "NULL", "NULL", "nema", 9, _M, _M),
    ("c = 8 AND t NOT IN (1, 2)", "n", _M, "visoka", 5, _M, _M), ("c = 8", "n", _M, "visoka", 6, _M, _M),
    ("c = 9 AND t NOT IN (1, 2)", "(n + 2) % 25", "NULL", "niska", 5, _M, _M), ("c = 9 AND t = 1", "n", _M, "srednja", 6, _M, _M), ("c = 9", "(n + 2) % 25", "NULL", "srednja", 8, "'Općinski sud u ' || " + _grad("(n + 2) % 25"), _M),
    ("c = 10 AND t NOT IN (1, 2)", "n", _M, "visoka", 2, _M, "NULL"), ("c = 10", "n", _M, "visoka", 3, _M, "NULL"),
    ("c = 11", "p % 25", "NULL", "srednja", 1, "'k.o. Zupa' || (p % 25) || ' = županija'", "'Zupa' || (p % 25)"),
]


def _wanted(place: int, other: str) -> str:
    return "CASE " + " ".join(f"WHEN {w[0]} THEN {repr(w[place]) if place == 3 else w[place]}" for w in _WANT) + f" ELSE {other} END"


@query(f"""WITH r AS (SELECT *, o_orderkey % 14 AS c, o_orderkey % 28 = 12 AS given FROM ({_ROWS})),
    w AS (SELECT *, {_wanted(1, 'NULL')} AS z, {_wanted(2, 'NULL')} AS place, {_wanted(3, "'nema'")} AS grade, {_wanted(4, '9')} AS step, {_wanted(5, "''")} AS raw, {_wanted(6, 'NULL')} AS unit FROM r)
    SELECT o_orderkey AS item_id, CASE WHEN given THEN 'Zupa1 županija' ELSE 'Zupa' || z || ' županija' END AS county, CASE WHEN given THEN 'Gradb' ELSE place END AS city, unit AS cadastral_municipality,
        CASE WHEN given THEN 'srednja' ELSE grade END AS location_confidence, raw AS location_raw, step::INTEGER AS step,
        CASE WHEN c IN (2, 3, 4, 5, 6) THEN CASE WHEN p % 9 = 0 THEN -40 ELSE 40 + p % 25 END END::DOUBLE AS lat, CASE WHEN c = 3 THEN 'matični broj' WHEN c IN (2, 4, 5, 6) THEN 'naziv' END AS point_source FROM w""")
def located_items(spark: SparkSession, sf: str) -> DataFrame:
    """Orders' texts through the cascade with all its columns, then confirmed overrides, then points on the map."""
    reg = _registers(spark, sf)
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).selectExpr("o_orderkey", "o_custkey AS k", "c_nationkey AS n", "o_orderkey % 200 AS p")
    issuer = F.expr(_COURT)
    items = rows.select(F.col("o_orderkey").alias("item_id"), F.expr(_by_case(dict(enumerate(_TEXTS)), "NULL")).alias("text"), issuer.alias("issuer"), F.when(issuer == "", "fina").otherwise("opcinski_sud").alias("issuer_type"))
    found = cascade.locate(items, reg)
    given = rows.where("o_orderkey % 28 = 12").select(F.col("o_orderkey").alias("item_id"), F.lit("Zupa1 županija").alias("o_county"), F.lit("Gradb").alias("o_city"))
    placed = location.with_overrides(found.withColumnRenamed("location_confidence", "confidence"), given)
    shown = found.select("item_id", "cadastral_municipality", "location_raw", "step").join(placed, "item_id")
    points = cascade.points(shown, items, reg).select("item_id", "lat", F.col("source").alias("point_source"))
    out = shown.join(points, "item_id", "left").withColumnRenamed("confidence", "location_confidence")
    return out.select("item_id", "county", "city", "cadastral_municipality", "location_confidence", "location_raw", F.col("step").cast("int").alias("step"), "lat", "point_source")
