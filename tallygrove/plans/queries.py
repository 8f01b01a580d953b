"""Registered queries over the driver's tables, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.functions import classify, parse, pii, text
from tallygrove.operators import linking, location, marts
from tallygrove.streaming import events as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r2(sql: str, places: int = 2) -> str:
    """SQL: rounded through DECIMAL(18,6), as the engine does."""
    return f"round(CAST({sql} AS DECIMAL(18,6)), {places})"


def _offers(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """Line items as offers: the part's list price is the estimate, the discounted price the opening price."""
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_retailprice")
    line = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_linestatus", "l_shipdate", "l_suppkey", *more)
    met = line.join(part, line.l_partkey == part.p_partkey)
    return met.withColumn("estimate", F.col("p_retailprice") * F.col("l_quantity") * 60).withColumn("opening", F.col("l_extendedprice") * (1 - F.col("l_discount")))


_OFFERS = """offers AS (SELECT *, p_retailprice * l_quantity * 60 AS estimate, l_extendedprice * (1 - l_discount) AS opening
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_PCT = _r2("(estimate - opening) / estimate * 100")
_SUSPICIOUS = f"coalesce(estimate > 0 AND ({_PCT} >= 99 OR (opening < 1 AND estimate > 1000)), false)"


@query(f"""WITH {_OFFERS} SELECT p_type, count(*)::BIGINT AS n, count(*) FILTER (l_linestatus = 'O')::BIGINT AS n_running,
    {_r2(f"avg(CASE WHEN estimate > 0 AND NOT {_SUSPICIOUS} THEN CAST({_PCT} AS DOUBLE) END)")}::DOUBLE AS avg_discount,
    min(opening) FILTER (opening <> 0) AS min_price FROM offers GROUP BY p_type""")
def discount_stats(spark: SparkSession, sf: str) -> DataFrame:
    pct = F.when(~parse.is_suspicious(F.col("estimate"), F.col("opening")), parse.discount_pct(F.col("estimate"), F.col("opening")))
    return marts.stats_by(_offers(spark, sf), "p_type", price=F.col("opening"), discount=pct, running=F.col("l_linestatus") == "O")


@query(f"""WITH {_OFFERS} SELECT {_SUSPICIOUS} AS suspicious, count(*)::BIGINT AS n FROM offers GROUP BY 1""")
def suspicious_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _offers(spark, sf).groupBy(parse.is_suspicious(F.col("estimate"), F.col("opening")).alias("suspicious")).agg(F.count(F.lit(1)).alias("n"))


_STATUS = """CASE WHEN o_orderdate IS NULL THEN 'bez_termina' WHEN TIMESTAMP '1998-06-15' < o_orderdate THEN 'najavljeno'
    WHEN TIMESTAMP '1998-06-15' <= o_orderdate + INTERVAL 30 DAY THEN 'u_tijeku' ELSE 'zavrseno' END"""


def _status(as_of: str = "1998-06-15 00:00:00"):
    start = F.col("o_orderdate")
    return parse.derive_status(start, start + F.expr("INTERVAL 30 DAYS"), F.lit(as_of).cast("timestamp_ntz"))


@query(f"SELECT {_STATUS} AS status, count(*)::BIGINT AS n FROM orders GROUP BY 1")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy(_status().alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT status, o_orderpriority, o_orderstatus, count(*)::BIGINT AS n FROM (SELECT *, {_STATUS} AS status FROM orders)
    GROUP BY GROUPING SETS ((status), (o_orderpriority), (o_orderstatus), ())""")
def summary_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Several groupings from one scan."""
    orders = table(spark, sf, "orders").withColumn("status", _status())
    sets = [[F.col("status")], [F.col("o_orderpriority")], [F.col("o_orderstatus")], []]
    return orders.groupingSets(sets, "status", "o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT CASE WHEN grouping(r_name) = 0 THEN coalesce(r_name, 'Nepoznato') END AS region, n_name AS nation, count(*)::BIGINT AS n FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def region_rollup(spark: SparkSession, sf: str) -> DataFrame:
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    met = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    got = met.rollup("r_name", "n_name").agg(F.count(F.lit(1)).alias("n"), F.grouping("r_name").alias("g"))
    return got.select(F.when(F.col("g") == 0, F.coalesce("r_name", F.lit("Nepoznato"))).alias("region"), F.col("n_name").alias("nation"), "n")


_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(f"""SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(_REST)}) = 1""")
def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    return linking.first_by_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col(c) for c in _REST])




def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _fold_sql(column: str) -> str:
    """SQL: the compatibility decomposition's ASCII, lower-cased; characters that become several are replaced one by one."""
    table = "MAP {" + ", ".join(f"{_quoted(c)}: {_quoted(p)}" for c, p in text.SEVERAL.items()) + "}"
    odd = f"list_distinct(regexp_extract_all(coalesce({column}, ''), {_quoted(text.character_class(text.SEVERAL))}))"
    spelled = f"list_reduce({odd}, lambda acc, x: replace(acc, x, {table}[x]), coalesce({column}, ''))"
    return f"lower(regexp_replace(translate({spelled}, {_quoted(text.MARKED)}, {_quoted(text.PLAIN)}), '[^\\x00-\\x7F]', '', 'g'))"


_PRINT = f"substr(sha1(coalesce(source, '') || '|' || trim(regexp_replace({_fold_sql('text')}, '[\\s.,;:()\\[\\]\\-/]+', ' ', 'g'))), 1, 16)"


def _linked(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text", "n_chars")
    printed = docs.withColumn("fp", text.property_fingerprint(F.col("source"), F.col("text"))).drop("text")
    return linking.link_repeats(printed, "fp", [F.col("n_chars").asc_nulls_first(), F.col("doc_id")])


@query(f"""SELECT doc_id, {_PRINT} AS repeat_group, row_number() OVER (PARTITION BY {_PRINT} ORDER BY n_chars NULLS FIRST, doc_id)::INTEGER AS repeat_seq FROM documents""")
def repeat_link(spark: SparkSession, sf: str) -> DataFrame:
    return _linked(spark, sf).select("doc_id", "repeat_group", "repeat_seq")


@query("""WITH g AS (SELECT o_custkey AS g, count(*) AS n, count(DISTINCT o_orderpriority) AS rounds, count(*) FILTER (o_orderpriority > '1-URGENT') AS d FROM orders GROUP BY 1)
    SELECT max(n)::BIGINT AS max_attempts, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS items_in_repeats,
    count(*) FILTER (n > 1 AND rounds > 1)::BIGINT AS groups_with_rounds, sum(d)::BIGINT AS self_declared FROM g""")
def repeat_counters(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("repeat_group"), F.substring("o_orderpriority", 1, 1).cast("int").alias("round"))
    return linking.repeat_counters(orders, "round")


@query(f"""WITH g AS (SELECT o_custkey, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_price, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_price, count(*)::BIGINT AS n
    FROM orders WHERE o_totalprice <> 0 GROUP BY 1)
    SELECT *, {_r2("(first_price - last_price) / first_price * 100")}::DOUBLE AS drop_pct, last_price < first_price AS fell FROM g WHERE n > 1""")
def price_drop(spark: SparkSession, sf: str) -> DataFrame:
    got = linking.price_drop(table(spark, sf, "orders"), "o_custkey", "o_totalprice", [F.col("o_orderdate"), F.col("o_orderkey")])
    return got.withColumn("drop_pct", F.col("drop_pct").cast("double"))


@query("""SELECT o_custkey, count(*)::BIGINT AS n, count(DISTINCT o_orderpriority) + max(CASE WHEN o_orderpriority IS NULL THEN 1 ELSE 0 END) AS rounds,
    count(DISTINCT round(CAST(o_totalprice AS DECIMAL(18,6)), 2)) AS prices FROM orders GROUP BY 1 HAVING n >= 2 AND (rounds > 1 OR prices > 1)""")
def meaningful_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return linking.meaningful_repeats(table(spark, sf, "orders"), "o_custkey", "o_orderpriority", "o_totalprice")


def _states(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers today, and an earlier state that differs from it by rules on the key."""
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    before = c.where("c_custkey % 7 <> 3").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 5 == 0, F.col("c_acctbal") + 10.5).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 11 == 0, "OLD").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    return c.where("c_custkey % 13 <> 5"), before


_STATES = """today AS (SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 13 <> 5),
    before AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 10.5 ELSE c_acctbal END AS c_acctbal,
    CASE WHEN c_custkey % 11 = 0 THEN 'OLD' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 7 <> 3)"""


@query(f"""WITH {_STATES}, b AS (SELECT t.c_custkey AS k, {_r2("p.c_acctbal")} AS o, {_r2("t.c_acctbal")} AS n, p.c_mktsegment AS os, t.c_mktsegment AS ns FROM today t JOIN before p USING (c_custkey))
    SELECT c_custkey, 'nova' AS event, '' AS field, NULL::VARCHAR AS old_value, NULL::VARCHAR AS new_value, NULL::DOUBLE AS pct FROM today ANTI JOIN before USING (c_custkey)
    UNION ALL SELECT c_custkey, 'nestala', '', NULL, NULL, NULL FROM before ANTI JOIN today USING (c_custkey)
    UNION ALL SELECT k, 'status', 'c_mktsegment', os, ns, NULL FROM b WHERE os IS DISTINCT FROM ns
    UNION ALL SELECT k, 'cijena', 'c_acctbal', CAST(CAST(o AS DECIMAL(15,2)) AS VARCHAR), CAST(CAST(n AS DECIMAL(15,2)) AS VARCHAR),
    CASE WHEN o <> 0 THEN {_r2("(CAST(n AS DOUBLE) - CAST(o AS DOUBLE)) / CAST(o AS DOUBLE) * 100")}::DOUBLE END FROM b WHERE o <> n""")
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    today, before = _states(spark, sf)
    return linking.snapshot_diff(today, before, "c_custkey", ["c_acctbal"], "c_mktsegment")


@query(f"""WITH {_STATES} SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey,
    CASE WHEN t.c_custkey IS NOT NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
    CASE WHEN t.c_custkey IS NOT NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment,
    CASE WHEN s.c_custkey IS NULL THEN DATE '2024-01-02' ELSE DATE '2024-01-01' END AS first_seen,
    CASE WHEN t.c_custkey IS NULL THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS last_seen,
    (CASE WHEN s.c_custkey IS NULL THEN 0 ELSE 1 END + CASE WHEN t.c_custkey IS NULL THEN 0 ELSE 1 END)::INTEGER AS times_seen
    FROM before s FULL JOIN today t ON s.c_custkey = t.c_custkey""")
def merge_state(spark: SparkSession, sf: str) -> DataFrame:
    today, before = _states(spark, sf)
    day = lambda d: F.lit(d).cast("date")
    state = before.withColumn("first_seen", day("2024-01-01")).withColumn("last_seen", day("2024-01-01")).withColumn("times_seen", F.lit(1))
    return linking.merge_state(state, today, "c_custkey", day("2024-01-02"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 4 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS DOUBLE) END AS amount FROM orders""")
def money_parse(spark: SparkSession, sf: str) -> DataFrame:
    price, k = F.col("o_totalprice"), F.col("o_orderkey") % 6
    dotted = text.swap_separators(F.format_number(price, 2))
    written = (
        F.when(k == 0, price.cast("decimal(16,2)").cast("string"))
        .when(k == 1, F.concat(dotted, F.lit(" EUR (1.234,50 HRK)")))
        .when(k == 2, dotted)
        .when(k == 3, F.format_number(price, 2))
        .when(k == 4, F.lit("3/4 procijenjene vrijednosti"))
        .otherwise(F.concat(F.translate(dotted, ".", " "), F.lit(" €")))
    )
    return table(spark, sf, "orders").select("o_orderkey", parse.parse_money(written).alias("amount"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_size::DOUBLE WHEN 1 THEN greatest(p_size, 7)::DOUBLE WHEN 2 THEN p_size * 10000.0::DOUBLE WHEN 3 THEN p_size * 3.5966::DOUBLE END AS area,
    CASE p_partkey % 5 WHEN 0 THEN 'm²' WHEN 1 THEN 'm2' WHEN 2 THEN 'ha' WHEN 3 THEN 'čhv' END AS unit FROM part""")
def area_parse(spark: SparkSession, sf: str) -> DataFrame:
    k, size = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    written = (
        F.when(k == 0, F.concat(F.lit("stan od "), size, F.lit(" m², 2 sobe")))
        .when(k == 1, F.concat(F.lit("podrum 7 m2 i vrt "), size, F.lit(" m2.")))
        .when(k == 2, F.concat(F.lit("šuma "), size, F.lit(" ha")))
        .when(k == 3, F.concat(size, F.lit(" čhv oranica")))
        .otherwise(F.concat(F.lit("k.c. "), size, F.lit("/2")))
    )
    got = table(spark, sf, "part").select("p_partkey", parse.parse_area(written).alias("a"))
    return got.select("p_partkey", F.col("a.area").alias("area"), F.col("a.unit").alias("unit"))


_KINDS = [("fastener", ["bolt", "nut", "screw"]), ("ring", ["ring"]), ("machine", ["gear", "widget", "motor"]), ("large", ["large"])]


@query(r"""SELECT p_partkey, CASE WHEN regexp_matches(t, '\bbolt\w{0,3}\b|\bnut\w{0,3}\b|screw') THEN 'fastener' WHEN regexp_matches(t, '\bring\w{0,3}\b') THEN 'ring'
    WHEN regexp_matches(t, '\bgear\w{0,3}\b|widget|\bmotor\w{0,3}\b') THEN 'machine' WHEN regexp_matches(t, '\blarge\w{0,3}\b') THEN 'large' ELSE 'ostalo' END AS kind
    FROM (SELECT p_partkey, lower(p_name || ' ' || p_type) AS t FROM part)""")
def classify_parts(spark: SparkSession, sf: str) -> DataFrame:
    words = text.fold(F.concat_ws(" ", "p_name", "p_type"))
    return table(spark, sf, "part").select("p_partkey", classify.by_needles(words, _KINDS, "ostalo").alias("kind"))


_CASES = "(CASE o_orderkey % 6 WHEN 0 THEN 'Ovr-' WHEN 1 THEN 'St-' WHEN 2 THEN 'OSIG-' WHEN 3 THEN 'os-' WHEN 4 THEN 'Ins-' ELSE 'P-' END || o_orderkey)"


@query("""SELECT CASE o_orderkey % 6 WHEN 0 THEN 'ovrha' WHEN 1 THEN 'stecaj' WHEN 2 THEN 'osiguranje' WHEN 3 THEN 'osiguranje' WHEN 4 THEN 'insolvencija' ELSE 'ostalo' END AS procedure_type,
    count(*)::BIGINT AS n FROM orders GROUP BY 1""")
def procedure_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").groupBy(classify.procedure_type(F.expr(_CASES)).alias("procedure_type")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT s_suppkey, CASE s_suppkey % 6 WHEN 0 THEN 'opcinski_sud' WHEN 1 THEN 'trgovacki_sud' WHEN 2 THEN 'javni_biljeznik' WHEN 3 THEN 'fina' WHEN 4 THEN 'nepoznato' ELSE 'ostalo' END AS issuer_type,
    CASE s_suppkey % 6 WHEN 0 THEN 'Općinski sud u ' || s_name WHEN 1 THEN 'Trgovački sud u ' || s_name WHEN 2 THEN 'Javni bilježnik' WHEN 3 THEN 'FINA ' || s_suppkey WHEN 4 THEN 'Nepoznato tijelo' ELSE s_name END AS issuer_name FROM supplier""")
def issuer_normalise(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr("CASE s_suppkey % 6 WHEN 0 THEN 'Općinski sud u ' || s_name WHEN 1 THEN 'Trgovački sud u ' || s_name WHEN 2 THEN 'Javni bilježnik ' || s_name WHEN 3 THEN 'FINA ' || s_suppkey WHEN 4 THEN ' ' ELSE s_name END")
    return table(spark, sf, "supplier").select("s_suppkey", classify.issuer_type(raw).alias("issuer_type"), classify.issuer_name(raw).alias("issuer_name"))


@query(f"""WITH {_OFFERS} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST({_PCT} AS DOUBLE) AS discount FROM offers WHERE estimate > 0 AND NOT {_SUSPICIOUS}
    ORDER BY {_PCT} DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice LIMIT 120""")
def topk_discount(spark: SparkSession, sf: str) -> DataFrame:
    offers = _offers(spark, sf).withColumn("pct", parse.discount_pct(F.col("estimate"), F.col("opening"))).where(~parse.is_suspicious(F.col("estimate"), F.col("opening")) & F.col("pct").isNotNull())
    top = offers.orderBy(F.desc("pct"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").limit(120)
    return top.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("pct").cast("double").alias("discount"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 1 ORDER BY o_totalprice, o_orderkey LIMIT 120")
def cheapest(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where("o_totalprice >= 1").orderBy("o_totalprice", "o_orderkey").limit(120).select("o_orderkey", "o_totalprice")


@query("""SELECT o_orderkey, o_orderdate + INTERVAL 30 DAY AS ends FROM orders WHERE o_totalprice >= 50000 AND o_orderdate + INTERVAL 30 DAY BETWEEN TIMESTAMP '1998-06-15' AND TIMESTAMP '1998-06-22'
    ORDER BY ends, o_orderkey LIMIT 10""")
def ending_soon(spark: SparkSession, sf: str) -> DataFrame:
    ends = table(spark, sf, "orders").where("o_totalprice >= 50000").select("o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("ends"))
    return ends.where(F.col("ends").between(F.lit("1998-06-15").cast("timestamp_ntz"), F.lit("1998-06-22").cast("timestamp_ntz"))).orderBy("ends", "o_orderkey").limit(10)


@query("""SELECT p_type, p_partkey, p_retailprice / p_size AS ppm, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice / p_size, p_partkey)::INTEGER AS rank FROM part
    WHERE p_size >= CASE p_type WHEN 'SMALL' THEN 2 WHEN 'LARGE' THEN 20 ELSE 10 END AND p_retailprice >= 500 QUALIFY rank <= 60""")
def best_value(spark: SparkSession, sf: str) -> DataFrame:
    least = F.when(F.col("p_type") == "SMALL", 2).when(F.col("p_type") == "LARGE", 20).otherwise(10)
    parts = table(spark, sf, "part").where((F.col("p_size") >= least) & (F.col("p_retailprice") >= 500)).select("p_type", "p_partkey", (F.col("p_retailprice") / F.col("p_size")).alias("ppm"))
    return marts.top_by_group(parts, "p_type", [F.col("ppm"), F.col("p_partkey")], 60)


@query("""WITH t AS (SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_name) > 1 THEN p_name || ' · ' || p_brand ELSE p_name END AS t FROM part)
    SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY t) > 1 THEN t || ' / ' || p_partkey ELSE t END AS unique_title FROM t""")
def unique_titles(spark: SparkSession, sf: str) -> DataFrame:
    return marts.unique_titles(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), "p_name", "p_brand", "p_partkey").select("p_partkey", "unique_title")


@query("""SELECT a.s_suppkey, b.s_suppkey AS related, row_number() OVER (PARTITION BY a.s_suppkey ORDER BY b.s_suppkey)::INTEGER AS place
    FROM supplier a JOIN supplier b ON a.s_nationkey IS NOT DISTINCT FROM b.s_nationkey AND a.s_suppkey <> b.s_suppkey QUALIFY place <= 6""")
def related_items(spark: SparkSession, sf: str) -> DataFrame:
    return marts.related(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey", "s_nationkey", 6)


@query("""SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name || ' ' || p_brand || ' ' || p_type), 'ring') AND contains(lower(p_name || ' ' || p_brand || ' ' || p_type), 'brand#1') ORDER BY p_partkey LIMIT 60""")
def search_parts(spark: SparkSession, sf: str) -> DataFrame:
    return marts.search(table(spark, sf, "part"), ["p_name", "p_brand", "p_type"], "Ring brand#1", [F.col("p_partkey")]).select("p_partkey", "p_name")


@query("""SELECT p_partkey, p_retailprice, p_size FROM part WHERE p_type IN ('PROMO', 'SMALL') AND p_retailprice >= 920 AND p_retailprice <= 980 AND p_size >= 10 ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 200""")
def listing_filter(spark: SparkSession, sf: str) -> DataFrame:
    got = marts.listing_filter(table(spark, sf, "part"), p_type__in=["PROMO", "SMALL"], p_retailprice__min=920, p_retailprice__max=980, p_size__min=10)
    return marts.sort_listing(got, "p_retailprice", True, "p_partkey").limit(200).select("p_partkey", "p_retailprice", "p_size")


@query(f"""SELECT p_type, {_r2("median(p_retailprice / p_size)")}::DOUBLE AS median_ppm FROM part WHERE p_size BETWEEN 5 AND 40 AND p_retailprice > 500 GROUP BY 1""")
def median_ppm(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").where("p_size BETWEEN 5 AND 40 AND p_retailprice > 500")
    got = marts.exact_median(parts.select("p_type", (F.col("p_retailprice") / F.col("p_size")).alias("ppm")), "p_type", "ppm")
    return got.select("p_type", parse.round_half_up(F.col("median")).cast("double").alias("median_ppm"))


@query(f"""WITH {_OFFERS} SELECT l_linenumber AS round, count(*)::BIGINT AS n, {_r2("avg((estimate - opening) / estimate * 100)", 1)}::DOUBLE AS avg_discount, {_r2("avg(opening / estimate)", 3)}::DOUBLE AS share
    FROM offers WHERE estimate > 0 GROUP BY 1""")
def discount_by_round(spark: SparkSession, sf: str) -> DataFrame:
    offers = _offers(spark, sf).where("estimate > 0")
    pct, share = F.avg((F.col("estimate") - F.col("opening")) / F.col("estimate") * 100), F.avg(F.col("opening") / F.col("estimate"))
    return offers.groupBy(F.col("l_linenumber").alias("round")).agg(F.count(F.lit(1)).alias("n"), parse.round_half_up(pct, 1).cast("double").alias("avg_discount"), parse.round_half_up(share, 3).cast("double").alias("share"))


@query(r"""SELECT lang, regexp_matches(coalesce(text, ''), '\b\d+/\d+\b') AS has_share, count(*)::BIGINT AS n, """ + _r2("avg(n_chars)", 1) + """::DOUBLE AS avg_chars FROM documents GROUP BY 1, 2""")
def share_flag(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.groupBy("lang", F.coalesce("text", F.lit("")).rlike(r"\b\d+/\d+\b").alias("has_share")).agg(F.count(F.lit(1)).alias("n"), parse.round_half_up(F.avg("n_chars"), 1).cast("double").alias("avg_chars"))


@query("""WITH j AS (SELECT d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN (SELECT DISTINCT doc_id, quality, toxic FROM labels) l USING (doc_id))
    SELECT c AS "column", n::BIGINT AS filled, (SELECT count(*) FROM j)::BIGINT AS total FROM (SELECT 'lang' AS c, count(*) FILTER (lang IS NOT NULL AND lang <> '') AS n FROM j
    UNION ALL SELECT 'source', count(*) FILTER (source IS NOT NULL AND source <> '') FROM j UNION ALL SELECT 'quality', count(quality) FROM j UNION ALL SELECT 'toxic', count(toxic) FROM j)""")
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    met = table(spark, sf, "documents").select("doc_id", "lang", "source").join(table(spark, sf, "labels").distinct(), "doc_id", "left")
    return marts.coverage(met, ["lang", "source", "quality", "toxic"])


@query("SELECT count(DISTINCT o_custkey)::BIGINT AS groups FROM orders WHERE o_orderpriority > '1-URGENT'")
def distinct_groups(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where("o_orderpriority > '1-URGENT'").agg(F.count_distinct("o_custkey").alias("groups"))


_GENERAL = {k: v.replace("'", "''") for k, v in pii.GENERAL.items()}
_HITS = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, unnest(regexp_extract_all(text, '{v}')) AS hit FROM documents" for k, v in _GENERAL.items())


def _scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.explode(pii.scan(F.col("text"), pii.GENERAL)).alias("h"))
    return docs.select("doc_id", "h.kind", "h.hit")


@query(_HITS)
def pii_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _scan(spark, sf)


@query(f"SELECT kind, count(*)::BIGINT AS n FROM ({_HITS}) GROUP BY kind")
def pii_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _scan(spark, sf).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def _tidy_sql(now: str) -> str:
    """SQL: runs of spaces as one, none at the ends, and of two commas or semicolons the second."""
    ends = f"regexp_replace(regexp_replace({now}, '{pii.SPACE}{{2,}}', ' ', 'g'), '^{pii.SPACE}+|{pii.SPACE}+$', '', 'g')"
    return f"regexp_replace({ends}, '[,;]{pii.SPACE}*([,;])', '\\1', 'g')"


def _redacted_sql(now: str = "coalesce(text, '')") -> str:
    for v in _GENERAL.values():
        now = f"regexp_replace({now}, '{v}', '[uklonjeno]', 'g')"
    return now


@query(f"SELECT doc_id, md5({_tidy_sql(_redacted_sql())}) AS redacted_md5 FROM documents")
def pii_redact(spark: SparkSession, sf: str) -> DataFrame:
    done = pii.redact(F.col("text"), pii.GENERAL, mask="[uklonjeno]", roles=False, given_names=())
    return table(spark, sf, "documents").select("doc_id", F.md5(done["text"].cast("binary")).alias("redacted_md5"))


#: A name as it stands in a text and what must stand there afterwards: declined, in capitals, with hyphens; streets, house numbers and companies stay.
_PEOPLE = [
    ("Nekretnina Ivana Horvata", "Nekretnina #", 1), ("IVAN HORVAT", "#", 1), ("Božidaru Magovcu", "#", 1), ("Mariji Ani Kovač i Marku Kralju", "# i #", 2), ("ulica Ivana Gorana Kovačića", "ulica Ivana Gorana Kovačića", 0),
    ("Ante Starčevića 12b", "Ante Starčevića 12b", 0), ("Zlatko Horvat d.o.o.", "Zlatko Horvat d.o.o.", 0), ("ŽELJKA ŠUKER-PERIĆ", "#", 1), ("Ana-Marija Novak", "#", 1), ("grad Zagreb i Marko", "grad Zagreb i Marko", 0), ("Krešimirom Petrom Novakom Drugim", "# Drugim", 1),
]


def _people(k: int) -> str:
    return "CASE coalesce(doc_id, 0) % {} {} END".format(len(_PEOPLE), " ".join(f"WHEN {i} THEN {_quoted(str(row[k]))}" for i, row in enumerate(_PEOPLE)))


@query(f"""WITH d AS (SELECT doc_id, lower(coalesce(text, '')) AS t, 1 + coalesce(doc_id, 0) % 7 AS p, {_people(1)} AS told, {_people(2)}::INTEGER AS n_names FROM documents),
    w AS (SELECT *, string_split(t, ' ') AS w FROM d),
    x AS (SELECT doc_id, n_names, told, array_to_string(list_concat(w[:p], ['(' || chr(1) || '),'], w[p + 1:]), ' ') AS t FROM w)
    SELECT doc_id, n_names, md5({_tidy_sql("replace(" + _redacted_sql('t') + ", chr(1), replace(told, '#', '[uklonjeno]'))")}) AS redacted_md5 FROM x""")
def names_redacted(spark: SparkSession, sf: str) -> DataFrame:
    """Names planted in lower-cased documents at places by their id; what the gazetteer removes is counted as a kind of its own."""
    d = table(spark, sf, "documents").select("doc_id", F.split(F.lower(F.coalesce("text", F.lit(""))), " ").alias("w"), (F.lit(1) + F.coalesce("doc_id", F.lit(0)) % 7).cast("int").alias("p"), F.expr(_people(0)).alias("name"))
    planted = F.array_join(F.concat(F.slice("w", 1, F.col("p")), F.array(F.concat(F.lit("("), "name", F.lit("),"))), F.slice("w", F.col("p") + 1, F.size("w"))), " ")
    done = d.select("doc_id", pii.redact(planted, pii.GENERAL, mask="[uklonjeno]").alias("r"))
    return done.select("doc_id", F.coalesce(F.col("r.removed")["person_name_gazetteer"], F.lit(0)).alias("n_names"), F.md5(F.col("r.text").cast("binary")).alias("redacted_md5"))


@query(r"""SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script.*?</script>|<style.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g'), ' ')) AS visible_md5 FROM pages""")
def html_visible(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.md5(marts.visible_text(F.col("html")).cast("binary")).alias("visible_md5"))


#: Pages given the tags they lack, by their id: short or long descriptions, canonical links, JSON-LD sound, without a type or broken.
_TAGGED = """replace(html, '<head>', '<head>' || CASE page_id % 3 WHEN 0 THEN '<meta name="description" content="short one">' WHEN 1 THEN '<meta name="description" content="a description that has forty characters or more">' ELSE '' END
    || CASE WHEN page_id % 2 = 0 THEN '<link rel="canonical" href="https://example.org/">' ELSE '' END
    || CASE page_id % 5 WHEN 0 THEN '<script type="application/ld+json">{"@context": "x", "@type": "y"}</script>' WHEN 1 THEN '<script type="application/ld+json">{"@context": "x"}</script>' WHEN 2 THEN '<script type="application/ld+json">{"@context" "x"</script>' ELSE '' END)"""


@query(rf"""WITH t AS (SELECT page_id, {_TAGGED} AS html FROM pages), b AS (SELECT *, regexp_extract_all(html, '(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>', 1) AS blocks FROM t)
    SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) <> '' AS has_title,
    length(regexp_extract(html, '(?is)<meta[^>]*name="description"[^>]*content="([^"]*)"', 1)) >= 40 AS has_meta, regexp_matches(html, '(?is)<link[^>]*rel="canonical"') AS has_canonical,
    len(regexp_extract_all(html, '(?i)<h1[\s>]'))::BIGINT AS n_h1, len(blocks) > 0 AS has_json_ld,
    len(list_filter(blocks, lambda x: CASE WHEN json_valid(x) THEN NOT (json_exists(x, '$."@context"') AND json_exists(x, '$."@type"')) ELSE true END))::BIGINT AS bad_json_ld FROM b""")
def html_lint(spark: SparkSession, sf: str) -> DataFrame:
    return marts.html_lint(table(spark, sf, "pages").select("page_id", F.expr(_TAGGED).alias("html")))


def _points(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers and suppliers at places computed from their keys."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("point_id"), F.expr("45 + (c_custkey * 37 % 1000) / 1000D").alias("lat"), F.expr("15 + (c_custkey * 61 % 1000) / 1000D").alias("lon"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("place_id"), F.expr("45 + (s_suppkey * 113 % 1000) / 1000D").alias("lat"), F.expr("15 + (s_suppkey * 71 % 1000) / 1000D").alias("lon"), F.expr("CAST(s_nationkey % 3 AS STRING)").alias("county"))
    return c, s


_NEAR = """near AS (SELECT * FROM (SELECT point_id, place_id, county, km, row_number() OVER (PARTITION BY point_id ORDER BY km, place_id)::INTEGER AS rank FROM
    (SELECT c.point_id, s.place_id, s.county, sqrt(pow(c.lat - s.lat, 2) + pow((c.lon - s.lon) * cos(radians((c.lat + s.lat) / 2)), 2)) * 111.0 AS km FROM
    (SELECT c_custkey AS point_id, 45 + (c_custkey * 37 % 1000) / 1000 AS lat, 15 + (c_custkey * 61 % 1000) / 1000 AS lon FROM customer) c,
    (SELECT s_suppkey AS place_id, 45 + (s_suppkey * 113 % 1000) / 1000 AS lat, 15 + (s_suppkey * 71 % 1000) / 1000 AS lon, (s_nationkey % 3)::VARCHAR AS county FROM supplier) s) WHERE km <= 12) WHERE rank <= 3)"""


@query(f"WITH {_NEAR} SELECT point_id, place_id, rank, {_r2('km', 3)}::DOUBLE AS km FROM near")
def geo_nearest(spark: SparkSession, sf: str) -> DataFrame:
    c, s = _points(spark, sf)
    return location.nearest(c, s, 3, 12.0).select("point_id", "place_id", "rank", parse.round_half_up(F.col("km"), 3).cast("double").alias("km"))


@query(f"WITH {_NEAR} SELECT point_id, min(county) AS county FROM near GROUP BY 1 HAVING count(*) = 3 AND count(DISTINCT county) = 1")
def geo_unanimous(spark: SparkSession, sf: str) -> DataFrame:
    c, s = _points(spark, sf)
    return location.unanimous(location.nearest(c, s, 3, 12.0), s.select("place_id", "county"), 3)


@query("""WITH n AS (SELECT n_nationkey AS name_id, CASE n_nationkey % 3 WHEN 0 THEN n_name WHEN 1 THEN replace(n_name, '_', '-') ELSE split_part(n_name, '_', 2) || ' ' || split_part(n_name, '_', 1) END AS name FROM nation),
    u AS (SELECT n_nationkey AS unit_id, replace(n_name, '_', CASE n_nationkey % 3 WHEN 0 THEN '_' ELSE ' ' END) AS name FROM nation)
    SELECT n.name_id, u.unit_id FROM n JOIN u ON list_sort(string_split_regex(lower(n.name), '[^a-z0-9]+')) = list_sort(string_split_regex(lower(u.name), '[^a-z0-9]+'))""")
def name_resolve(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    names = n.select(F.col("n_nationkey").alias("name_id"), F.expr("CASE n_nationkey % 3 WHEN 0 THEN n_name WHEN 1 THEN replace(n_name, '_', '-') ELSE split_part(n_name, '_', 2) || ' ' || split_part(n_name, '_', 1) END").alias("name"))
    units = n.select(F.col("n_nationkey").alias("unit_id"), F.expr("replace(n_name, '_', CASE n_nationkey % 3 WHEN 0 THEN '_' ELSE ' ' END)").alias("name"))
    return location.by_name(names, units)


_REGISTER = """register AS (SELECT 'Mjesto ' || (c_custkey % 40) AS name, 'Z' || (c_nationkey % 7) AS county, count(*) * (CASE WHEN c_nationkey % 7 = 0 THEN 50 ELSE 1 END) AS population FROM customer GROUP BY c_custkey % 40, c_nationkey % 7),
    names AS (SELECT s_suppkey AS name_id, 'mjesto ' || (s_suppkey % 45) AS name, 'Z' || (s_nationkey % 7) AS anchor FROM supplier),
    cand AS (SELECT name_id, anchor, county, population FROM names JOIN register ON lower(register.name) = names.name)"""


@query(f"""WITH {_REGISTER}, g AS (SELECT name_id, any_value(anchor) AS anchor, list(county) AS cs, list(population ORDER BY population DESC, county DESC) AS ps, list(county ORDER BY population DESC, county DESC) AS top FROM cand GROUP BY 1)
    SELECT name_id, CASE WHEN len(cs) = 1 THEN top[1] WHEN list_contains(cs, anchor) THEN anchor WHEN ps[1] >= 20 * greatest(ps[2], 1) THEN top[1] END AS county,
    CASE WHEN len(cs) = 1 OR list_contains(cs, anchor) THEN 'visoka' WHEN ps[1] >= 20 * greatest(ps[2], 1) THEN 'srednja' ELSE 'nema' END AS confidence FROM g""")
def county_choice(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").groupBy(F.expr("'Mjesto ' || (c_custkey % 40)").alias("name"), F.expr("c_nationkey % 7").alias("z")).agg(F.count(F.lit(1)).alias("n"))
    register = c.select("name", F.expr("'Z' || z").alias("county"), F.expr("n * CASE WHEN z = 0 THEN 50 ELSE 1 END").alias("population"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("name_id"), F.expr("'mjesto ' || (s_suppkey % 45)").alias("name"), F.expr("array('Z' || (s_nationkey % 7))").alias("counties"))
    return location.choose_county(location.settlement_candidates(s.select("name_id", "name"), register), s.select("name_id", "counties"))


@query("""SELECT doc_id AS text_id, arg_max(w, (len(w), w)) AS name FROM (SELECT doc_id, w FROM documents, (SELECT unnest(['and', 'the', 'with by', 'for an', 'que la', 'und die', 'de la', 'para que la', 'of the and the of']) AS w)
    WHERE contains(' ' || trim(regexp_replace(""" + _fold_sql("text") + r""", '[^a-z0-9]+', ' ', 'g'), ' ') || ' ', ' ' || w || ' ')) GROUP BY 1""")
def longest_mention(spark: SparkSession, sf: str) -> DataFrame:
    names = spark.createDataFrame([(w,) for w in ("and", "the", "with by", "for an", "que la", "und die", "de la", "para que la", "of the and the of")], "name string")
    return location.longest_mention(table(spark, sf, "documents").select(F.col("doc_id").alias("text_id"), "text"), names)


@query("""SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, '{"field":"' || event_type || '","old_value":"' || user_id || '","new_value":"x \\"' || event_id || '\\""}' AS detail FROM events""")
def events_detail(spark: SparkSession, sf: str) -> DataFrame:
    """Values as they are logged; a missing one is left out of the text."""
    events = table(spark, sf, "events").select("event_id", "props", F.col("event_type").alias("field"), F.col("user_id").cast("string").alias("old_value"),
        F.format_string('x "%s"', F.col("event_id").cast("string")).alias("new_value"), F.lit(None).cast("double").alias("pct"))
    return linking.event_detail(events).select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), "detail")


@query(r"""SELECT p_partkey, trim(regexp_replace(lower(p_type || ' ' || p_name), '[^a-z0-9]+', '-', 'g'), '-') || '-sd-' || p_partkey AS slug FROM part""")
def slug_url(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", text.build_slug(F.concat_ws(" ", "p_type", "p_name", F.lit("ŠĐ")), F.lit(""), F.col("p_partkey").cast("string")).alias("slug"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'spis-' || substr(d, 1, 16) ELSE 'nad-' || o_custkey || '-' || substr(d, 1, 8) END AS item_key FROM
    (SELECT *, sha1(o_orderkey || '|' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_custkey::VARCHAR END || '|' || o_orderpriority || '|' || CAST(CAST(o_totalprice AS DECIMAL(16,2)) AS VARCHAR) || '|' || o_orderstatus || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|' || strftime(o_orderdate, '%Y-%m-%d') || '||') AS d FROM orders)""")
def item_keys(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    item = {
        "case_ref": F.col("o_orderkey"), "auction_id": F.expr("CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END"), "description": F.col("o_orderpriority"),
        "estimated_value": F.col("o_totalprice"), "auction_round": F.col("o_orderstatus"), "decision_date": F.col("o_orderdate"), "publish_start": F.col("o_orderdate"),
        "scope": F.lit(None).cast("string"), "property_type": F.lit(None).cast("string"),
    }
    return o.select("o_orderkey", text.item_key(item).alias("item_key"))


@query("""SELECT r_name AS region, o_orderpriority AS value, count(*)::BIGINT AS cnt, row_number() OVER (PARTITION BY r_name ORDER BY count(*) DESC, o_orderpriority)::INTEGER AS rank
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2 QUALIFY rank <= 3""")
def most_common(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    met = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return marts.most_common(met.select(F.col("r_name").alias("region"), F.col("o_orderpriority").alias("value")), "region", "value", 3)


@query(f"""WITH n AS (SELECT s_nationkey AS lat, s_suppkey % 3 AS lon, count(*)::BIGINT AS n FROM supplier GROUP BY 1, 2) SELECT lat, lon, n, {_r2("5 + 11 * sqrt(n / (SELECT max(n) FROM n))", 3)}::DOUBLE AS radius FROM n""")
def map_points(spark: SparkSession, sf: str) -> DataFrame:
    return marts.by_point(table(spark, sf, "supplier").select(F.col("s_nationkey").alias("lat"), (F.col("s_suppkey") % 3).alias("lon")), "lat", "lon")


@query("""SELECT o_custkey, n, n || ' ' || CASE WHEN n % 10 = 1 AND n % 100 NOT BETWEEN 11 AND 14 THEN 'stavka' WHEN n % 10 BETWEEN 2 AND 4 AND n % 100 NOT BETWEEN 11 AND 14 THEN 'stavke' ELSE 'stavki' END AS label
    FROM (SELECT o_custkey, count(*)::BIGINT AS n FROM orders GROUP BY 1)""")
def plural_labels(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("label", F.concat_ws(" ", F.col("n").cast("string"), text.hr_plural(F.col("n"), "stavka", "stavke", "stavki")))


@query("SELECT p_name, count(*)::BIGINT AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicate_titles(spark: SparkSession, sf: str) -> DataFrame:
    return marts.duplicates(table(spark, sf, "part"), "p_name")


@query("""SELECT name, violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT 'nation_has_region' AS name, count(*)::BIGINT AS violations FROM nation ANTI JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'unique_orders', count(*)::BIGINT FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'unique_lines', count(*)::BIGINT FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1))""")
def quality_checks(spark: SparkSession, sf: str) -> DataFrame:
    n, r, o, line = (table(spark, sf, t) for t in ("nation", "region", "orders", "lineitem"))
    lines = line.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return marts.checks_report([("nation_has_region", n.join(r, n.n_regionkey == r.r_regionkey, "left_anti")), ("unique_orders", marts.duplicates(o, "o_orderkey")), ("unique_lines", lines)])


@query("""SELECT time_bucket(INTERVAL 1 DAY, ts)::TIMESTAMP AS window_start, event_type, count(*)::BIGINT AS n, """ + _r2("sum(value)") + """::DOUBLE AS total FROM events GROUP BY 1, 2""")
def event_windows(spark: SparkSession, sf: str) -> DataFrame:
    got = streaming.windowed_counts(table(spark, sf, "events"))
    return got.withColumn("total", parse.round_half_up(F.col("total")).cast("double"))


def _spread_sql(k: int = 2, rounds: int = 5) -> str:
    """Rounds one after the other, each over all pairs."""
    places = """SELECT s_suppkey + 1000000000 AS unit_id, 45 + (s_suppkey * 113 % 1000) / 1000 AS lat, 15 + (s_suppkey * 71 % 1000) / 1000 AS lon FROM supplier"""
    steps = [f"""u0 AS MATERIALIZED (SELECT *, CASE WHEN lat < 45.5 THEN 'A' ELSE 'B' END AS county FROM ({places})
        UNION ALL SELECT c_custkey, 45 + (c_custkey * 37 % 1000) / 1000, 15 + (c_custkey * 61 % 1000) / 1000, NULL FROM customer)"""]
    for i in range(rounds):
        km = "sqrt(pow(a.lat - b.lat, 2) + pow((a.lon - b.lon) * cos(radians((a.lat + b.lat) / 2)), 2)) * 111.0"
        near = f"SELECT a.unit_id, b.county, {km} AS km FROM u{i} a JOIN u{i} b ON a.county IS NULL AND b.county IS NOT NULL QUALIFY row_number() OVER (PARTITION BY a.unit_id ORDER BY km, b.unit_id) <= {k}"
        told = f"SELECT unit_id, min(county) AS told FROM ({near}) GROUP BY 1 HAVING count(*) = {k} AND count(DISTINCT county) = 1 AND min(km) <= 12"
        steps.append(f"u{i + 1} AS MATERIALIZED (SELECT unit_id, lat, lon, coalesce(county, told) AS county FROM u{i} LEFT JOIN ({told}) USING (unit_id))")
    return f"WITH {', '.join(steps)} SELECT unit_id, county FROM u{rounds}"


@query(_spread_sql())
def assign_counties(spark: SparkSession, sf: str) -> DataFrame:
    """Counties of suppliers' places, spread to customers' places over rounds."""
    c, s = _points(spark, sf)
    known = s.select((F.col("place_id") + 1_000_000_000).alias("unit_id"), "lat", "lon", F.expr("CASE WHEN lat < 45.5 THEN 'A' ELSE 'B' END").alias("county"))
    units = known.unionByName(c.select(F.col("point_id").alias("unit_id"), "lat", "lon", F.lit(None).cast("string").alias("county")))
    return location.assign_counties(units, k=2).select("unit_id", "county")


_TOWN = "CASE WHEN k % 3 = 0 THEN {0}.5 + (k % {1}) / 50000000D ELSE {0} + (k * {2} % 10000) / 10000D END"


@query(f"""WITH p AS (SELECT o_orderkey AS place_id, {_TOWN.replace('0D', '0').format(45, 977, 113).replace('k ', 'o_orderkey ')} AS lat, {_TOWN.replace('0D', '0').format(15, 991, 71).replace('k ', 'o_orderkey ')} AS lon FROM orders),
    q AS (SELECT s_suppkey AS point_id, {_TOWN.replace('0D', '0').format(45, 883, 37).replace('k ', 's_suppkey ')} AS lat, {_TOWN.replace('0D', '0').format(15, 877, 61).replace('k ', 's_suppkey ')} AS lon FROM supplier)
    SELECT point_id, place_id, {_r2('km', 3)}::DOUBLE AS km, row_number() OVER (PARTITION BY point_id ORDER BY km, place_id)::INTEGER AS rank
    FROM (SELECT point_id, place_id, sqrt(pow(q.lat - p.lat, 2) + pow((q.lon - p.lon) * cos(radians((q.lat + p.lat) / 2)), 2)) * 111.0 AS km FROM q JOIN p ON true) QUALIFY rank <= 5""")
def geo_dense(spark: SparkSession, sf: str) -> DataFrame:
    """The five nearest of all orders' places to each supplier; a third of both lie in one town some metres wide."""
    place = lambda at, key, name, a, b: table(spark, sf, at).select(F.col(key).alias("k")).select(F.col("k").alias(name), F.expr(_TOWN.format(45, *a)).alias("lat"), F.expr(_TOWN.format(15, *b)).alias("lon"))
    near = location.nearest(place("supplier", "s_suppkey", "point_id", (883, 37), (877, 61)), place("orders", "o_orderkey", "place_id", (977, 113), (991, 71)), 5)
    return near.select("point_id", "place_id", parse.round_half_up(F.col("km"), 3).cast("double").alias("km"), "rank")
