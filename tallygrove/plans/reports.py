"""Registered queries of what a run leaves behind: its report, its counters, its site map. Faults are planted by rules on keys, so that SQL can tell what must be found."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrove.functions import text
from tallygrove.operators import validation
from tallygrove.operators.checkpoints import shared_path
from tallygrove.plans.queries import _STATUS, _r2, _status, query, table
from tallygrove.sources import snapshot, state

_KEY = "'k' || lpad(CAST(o_orderkey AS {}), 9, '0')"
_PRICE = "CAST((CAST(floor(o_totalprice * {}) AS BIGINT) * 100 + o_orderkey % 100) / 100 AS DECIMAL(16,2))"


def _frames(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """A snapshot of orders, the state, pages, site map and logs, each with faults."""
    made = {
        "item_key": _KEY.format("STRING"), "case_ref": "'Ovr-' || o_custkey || CASE WHEN o_orderkey % 997 = 5 THEN 'x' ELSE '' END",
        "county": "CASE WHEN o_orderkey % 10 = 0 THEN 'Istarska županija' WHEN o_orderkey % 7 <> 0 THEN 'Zadarska županija' END", "city": "'Grad'",
        "description": "CASE WHEN o_orderkey % 211 = 7 THEN 'kuća, tel. 091 123 4567' WHEN o_orderkey % 223 = 9 THEN 'stan Ivana Horvata' ELSE 'kuća' END", "issuer_name": "'FINA'",
        "estimated_value_eur": _PRICE.format("1D"), "opening_price_eur": _PRICE.format("0.75D"), "area_m2": "CASE WHEN o_orderkey % 4 <> 0 THEN 50.0D END", "auction_start": "o_orderdate", "auction_end": "o_orderdate + INTERVAL 30 DAYS",
        "property_type": "'kuca'", "repeat_group": "CAST(o_custkey AS STRING)", "auction_round": "CASE WHEN o_orderkey % 2 = 0 THEN 'Prva' ELSE 'Druga' END",
    }
    orders = table(spark, sf, "orders")
    items = orders.select("o_orderkey", *(F.expr(sql).alias(c) for c, sql in made.items()), _status().alias("status"))
    pct = (F.col("estimated_value_eur").cast("double") - F.col("opening_price_eur").cast("double")) / F.col("estimated_value_eur").cast("double") * 100
    items = items.withColumn("discount_pct", (F.round(pct.cast("decimal(18,6)"), 2) + F.when(F.col("o_orderkey") % 301 == 3, F.lit(1)).otherwise(F.lit(0))).cast("decimal(9,2)"))
    kept = items.where("o_orderkey % 409 <> 11").withColumn("city", F.when(F.col("o_orderkey") % 30 == 0, "Selo").otherwise(F.col("city")))
    page = (
        "'<html><head><title>' || CASE WHEN page_id % 50 = 1 THEN 'isti' ELSE 'Naslov ' || page_id END || '</title><meta name=\"description\" content=\"Opis stranice broj ' || page_id || ', dug najmanje četrdeset znakova\">' "
        "|| CASE WHEN page_id % 40 = 3 THEN '' ELSE '<link rel=\"canonical\" href=\"https://example.org/\">' END || CASE WHEN page_id % 45 = 11 THEN '<script type=\"application/ld+json\">{\"@context\" \"x\"}</script>' ELSE '' END "
        "|| '</head><body><h1>č</h1>' || CASE WHEN page_id % 60 = 7 THEN '<h1>dva</h1>' ELSE '' END || CASE WHEN page_id % 70 = 13 THEN '<p>mail a.b@example.org</p>' ELSE '<p>bez</p>' END || '</body></html>'"
    )
    pages = table(spark, sf, "pages").select("page_id", F.expr("'/p' || page_id || '/'").alias("path"), F.expr(page).alias("html"))
    events = table(spark, sf, "events").select(F.when(F.col("event_type") == "click", "nova").otherwise("cijena").alias("event_type"))
    return {
        "snapshot": items.drop("o_orderkey"), "state": kept.drop("o_orderkey"), "pages": pages.select("path", "html"), "sitemap": pages.where("page_id % 80 <> 19").select("path"),
        "runs": table(spark, sf, "nation").select(F.col("n_regionkey").cast("string").alias("source_sha256")), "prices": items.where("o_orderkey % 5000 = 1").select("item_key"), "events": events,
    }


_SHARE = "replace(format('{{:.1f}}', CAST(round(CAST(100.0::DOUBLE * {} / count(*) AS DECIMAL(18,6)), 1) AS DOUBLE)), ',', '')"


@query(f"""WITH o AS (SELECT *, {_KEY.format('VARCHAR')} AS item_key, {_PRICE.format('1')} AS e, o_orderkey % 409 <> 11 AS kept, CASE WHEN o_orderkey % 10 = 0 OR o_orderkey % 7 <> 0 THEN 1 END AS placed FROM orders),
    p AS (SELECT *, '/p' || page_id || '/' AS path FROM pages),
    v AS (SELECT 'keys_present' AS name, item_key AS offender FROM o WHERE NOT kept
        UNION ALL SELECT 'fields_same', item_key || CASE WHEN kept THEN ' city' ELSE ' item_key' END FROM (SELECT * FROM o WHERE o_orderkey % 10 = 0 ORDER BY item_key LIMIT 15) WHERE o_orderkey % 30 = 0 OR NOT kept
        UNION ALL SELECT 'no_personal_data', item_key || '.description ' || unnest(['phone_labelled', 'phone_mobile']) FROM o WHERE kept AND o_orderkey % 211 = 7
        UNION ALL SELECT 'no_personal_data', item_key || '.description name' FROM o WHERE kept AND o_orderkey % 223 = 9 AND o_orderkey % 211 <> 7
        UNION ALL SELECT 'no_personal_data', path || ' email' FROM p WHERE page_id % 70 = 13
        UNION ALL SELECT 'discounts', item_key FROM o WHERE kept AND o_orderkey % 301 = 3 AND e > 0
        UNION ALL SELECT 'no_mixed_cases', o_custkey::VARCHAR FROM o WHERE kept GROUP BY o_custkey HAVING count(DISTINCT o_orderkey % 997 = 5) > 1
        UNION ALL SELECT 'known_repeat_linked', 'Ovr-1' WHERE (SELECT count(*) < 2 OR count(DISTINCT o_orderkey % 2) < 2 FROM o WHERE kept AND o_custkey = 1 AND o_orderkey % 997 <> 5)
        UNION ALL SELECT 'pages', path || ' canonical' FROM p WHERE page_id % 40 = 3 UNION ALL SELECT 'pages', path || ' h1' FROM p WHERE page_id % 60 = 7 UNION ALL SELECT 'pages', path || ' json_ld' FROM p WHERE page_id % 45 = 11
        UNION ALL SELECT 'pages', path || ' sitemap' FROM p WHERE page_id % 80 = 19 UNION ALL SELECT 'pages', 'isti same title' FROM p WHERE page_id % 50 = 1 HAVING count(*) > 1),
    g AS (SELECT name, count(*)::BIGINT AS violations, list(offender ORDER BY offender)[:5] AS offenders FROM v GROUP BY name),
    c AS (SELECT count(placed) || ' with a county, ' || (count(*) - count(placed)) || ' without; county ' || {_SHARE.format('count(placed)')} || ', city 100.0, area_m2 ' || {_SHARE.format('count(*) FILTER (o_orderkey % 4 <> 0)')}
        || ', estimated_value_eur 100.0, opening_price_eur 100.0, discount_pct ' || {_SHARE.format('count(*) FILTER (e > 0)')} || ', auction_start 100.0, auction_end 100.0, property_type 100.0, status 100.0' AS detail FROM o WHERE kept)
    SELECT n.name, coalesce(violations, 0)::BIGINT AS violations, CASE WHEN violations > 0 THEN 'FAIL' ELSE 'PASS' END AS status, coalesce(array_to_string(offenders, '; '), '') AS offenders,
        CASE WHEN n.name = 'coverage_reported' THEN (SELECT detail FROM c) ELSE '' END AS detail
    FROM (SELECT unnest({validation.CHECKS}) AS name) n LEFT JOIN g USING (name)""")
def validation_report(spark: SparkSession, sf: str) -> DataFrame:
    """The twelve checks over a state of orders and over pages: how many rows fail each, and the first of them."""
    got = validation.validate(**_frames(spark, sf), county="Istarska županija", case_ref="Ovr-1")
    return got.select("name", "violations", "status", F.array_join("offenders", "; ").alias("offenders"), "detail")


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@query(f"""WITH o AS (SELECT *, {_STATUS} AS status, CAST(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 90 + 0.25 END AS DECIMAL(7,2)) AS pct, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS seq FROM orders)
    SELECT 'items' AS name, '' AS key, count(*)::DOUBLE AS value FROM o UNION ALL SELECT 'avg_discount_pct', '', {_r2('avg(CASE WHEN o_orderkey % 8 <> 1 THEN CAST(pct AS DOUBLE) END)')}::DOUBLE FROM o
    UNION ALL SELECT 'suspicious', '', count(*) FILTER (o_orderkey % 8 = 1)::DOUBLE FROM o UNION ALL SELECT 'repeat_groups', '', count(DISTINCT o_custkey)::DOUBLE FROM o WHERE seq > 1
    UNION ALL SELECT 'by_status', status, count(*)::DOUBLE FROM o GROUP BY 2 UNION ALL SELECT 'by_type', o_orderstatus, count(*)::DOUBLE FROM o GROUP BY 2
    UNION ALL SELECT 'by_county', CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN o_orderpriority ELSE 'Nepoznato' END, count(*)::DOUBLE FROM o GROUP BY 2""")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A run's counters, observed while the state is written and not counted from it again."""
    seq = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    items = table(spark, sf, "orders").select(
        _status().alias("status"), F.col("o_orderstatus").alias("property_type"), F.col("o_orderpriority").alias("county"), (F.col("o_orderkey") % 8 == 1).alias("discount_suspicious"),
        F.expr("CAST(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 90 + 0.25 END AS DECIMAL(7,2))").alias("discount_pct"), seq.alias("repeat_seq"),
    )
    counted = state.counters(["najavljeno", "u_tijeku", "zavrseno", "bez_termina"], ["F", "O", "P"], _PRIORITIES)
    _, flat = state.write_version(items, shared_path(spark, "state"), counted=counted)
    told = state.summary(flat)
    lines = [(name, key, float(x)) for name, v in told.items() for key, x in (v.items() if isinstance(v, dict) else [("", v)]) if x is not None]
    return spark.createDataFrame(lines, "name string, key string, value double")


@query("""WITH u AS (SELECT *, '/' || regexp_replace(coalesce(url, ''), '^https?://[^/]*/|[?#].*$', '', 'g') AS path FROM pages), f AS (SELECT path, min(page_id) AS first FROM u GROUP BY 1),
    n AS (SELECT f.path, page_id, row_number() OVER (ORDER BY first) - 1 AS n FROM f JOIN u ON page_id = first)
    SELECT path, n::BIGINT AS n, (n // 40)::INTEGER AS shard, '  <url><loc>https://example.org' || replace(path, '&', '&amp;') || '</loc><lastmod>2024-01-01</lastmod><changefreq>' || CASE WHEN page_id % 3 = 0 THEN 'daily' ELSE 'weekly' END
        || '</changefreq><priority>' || CASE WHEN page_id % 4 = 0 THEN '0.8' ELSE '0.5' END || '</priority></url>' AS entry FROM n""")
def site_map(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of the site map in order, each path once by its first page, dealt to files of 40."""
    path = F.concat(F.lit("/"), F.regexp_replace(text.text_or_empty(F.col("url")), r"^https?://[^/]*/|[?#].*$", ""))
    pages = table(spark, sf, "pages").select("page_id", path.alias("path"), F.expr("CASE WHEN page_id % 3 = 0 THEN 'daily' ELSE 'weekly' END").alias("changefreq"), F.expr("CASE WHEN page_id % 4 = 0 THEN 0.8D ELSE 0.5D END").alias("priority"))
    entries = snapshot.numbered_pages(pages, "page_id", 40)
    return entries.select("path", "n", "shard", snapshot.sitemap_entry("https://example.org", "2024-01-01").alias("entry"))


_FEED_ITEM = """'<item><title>Kuća, Grad, ' || regexp_replace(replace(replace(replace(format('{:,.2f}', CAST(o_totalprice AS DOUBLE)), ',', '#'), '.', ','), '#', '%s'), ',00$', '') || '%s€</title><link>https://example.org/i/' || o_orderkey || '/</link><guid isPermaLink="true">https://example.org/i/' || o_orderkey
    || '/</guid><pubDate>' || strftime(o_orderdate, '%%a, %%d %%b %%Y %%H:%%M:%%S') || ' +0100</pubDate><description>Kuća · A &amp; B' || CASE WHEN o_orderkey %% 2 = 0 THEN ' · 12,5%s%%%% ispod procjene' ELSE '' END || ' · nadmetanje do ' || strftime(o_orderdate + INTERVAL 30 DAY, '%%d.%%m.%%Y.') || '</description></item>'""" % ((text.NBSP,) * 3)


@query(f"SELECT (row_number() OVER (ORDER BY o_orderdate DESC, 'https://example.org/i/' || o_orderkey || '/'))::INTEGER AS place, 'https://example.org/i/' || o_orderkey || '/' AS url, {_FEED_ITEM.replace('%%', '%')} AS entry FROM orders ORDER BY place LIMIT 50")
def feed_entries(spark: SparkSession, sf: str) -> DataFrame:
    """The newest 50 items as feed entries."""
    made = table(spark, sf, "orders").select(
        F.concat(F.lit("https://example.org/i/"), F.col("o_orderkey"), F.lit("/")).alias("url"), F.lit("Kuća, Grad").alias("card_title"), F.lit("Kuća").alias("type_label"), F.lit("A & B").alias("county"),
        F.col("o_orderdate").alias("publish_start"), F.col("o_totalprice").alias("opening_price_eur"), F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 12.5D END").alias("discount_pct"), F.lit(False).alias("discount_suspicious"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("auction_end"),
    )
    return snapshot.feed_items(made)
