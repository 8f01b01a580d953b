"""The twelve checks of a finished state against its source, its pages and its logs.

All checks give rows (name, offender) of one frame. It is counted by name in one grouped pass,
with the first few offenders of each check; nothing else leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.functions import parse, pii
from tallygrove.operators import linking, marts
from tallygrove.operators.checkpoints import checkpointed

# Fields that are looked through for personal data, compared in the sample, and whose coverage is told.
TEXT_FIELDS = ["description", "issuer_name", "viewing_time", "location_raw", "cadastral_municipality", "case_ref", "sale_method", "scope"]
SAMPLED = ["case_ref", "county", "city", "estimated_value_eur", "opening_price_eur", "area_m2", "auction_start", "auction_end", "property_type", "status"]
COVERED = ["county", "city", "cadastral_municipality", "area_m2", "estimated_value_eur", "opening_price_eur", "discount_pct", "auction_id", "auction_start", "auction_end", "viewing_time", "property_type", "procedure_type", "status"]
CHECKS = "keys_present fields_same coverage_reported no_personal_data detectors_work discounts known_repeat_linked no_mixed_cases pages diacritics history price_tracking".split()
#: Offenders that a report names for each check.
NAMED = 5
CANARY = "ovršenik Pero Perić, OIB: 12345678901, mob. 091 123 4567, a.b@mail.example.com"


def sample(items: DataFrame, county: str, n: int = 15) -> DataFrame:
    """The n items of a county with the least keys: the same ones each time."""
    return items.where(F.col("county") == county).orderBy("item_key").limit(n)


def field_differences(chosen: DataFrame, state: DataFrame, fields: Sequence[str] = SAMPLED) -> DataFrame:
    """(item_key, field) where source and state differ; an item the state lacks differs once, in its key."""
    a, b = chosen.alias("a"), state.withColumn("__has", F.lit(True)).alias("b")
    met = a.join(b, F.col("a.item_key") == F.col("b.item_key"), "left")
    differ = [F.when(F.col("b.__has") & ~parse.same_value(F.col(f"a.{f}"), F.col(f"b.{f}")), F.lit(f)) for f in fields]
    each = F.array_compact(F.array(F.when(F.col("b.__has").isNull(), F.lit("item_key")), *differ))
    return met.select(F.col("a.item_key").alias("item_key"), F.explode(each).alias("field"))


def personal_data(items: DataFrame, pages: DataFrame, given_names: Sequence[str], own_address: str = "") -> DataFrame:
    """(place, kind, hit): detector hits in text fields and in pages' visible text, and names left in descriptions."""
    texts = [F.struct(F.concat_ws(".", "item_key", F.lit(f)).alias("place"), F.col(f).alias("text")) for f in TEXT_FIELDS if f in items.columns]
    fields = items.select(F.explode(F.array(*texts)).alias("t")).select("t.*")
    seen = pages.select(F.col("path").alias("place"), marts.visible_text(F.col("html")).alias("text"))
    hits = fields.unionByName(seen).select("place", F.explode(pii.scan(F.col("text"))).alias("h")).select("place", "h.kind", "h.hit")
    names = items.select(F.col("item_key").alias("place"), F.explode(pii.residual_names(F.col("description"), given_names)).alias("hit"))
    return hits.where(F.lower(F.trim("hit")) != own_address.lower()).unionByName(names.select("place", F.lit("name").alias("kind"), "hit"))


def _wrong_discount() -> Column:
    e, o = F.col("estimated_value_eur").cast("double"), F.col("opening_price_eur").cast("double")
    return F.coalesce(F.abs(parse.discount_pct(e, o) - F.col("discount_pct")) > 0.01, F.lit(False))


def wrong_discounts(items: DataFrame) -> DataFrame:
    """Items whose discount differs from its recomputation by more than a hundredth."""
    return items.where(_wrong_discount())


def page_faults(pages: DataFrame, sitemap: DataFrame) -> DataFrame:
    """(path, fault) of pages; sitemap has the column path."""
    head = marts.html_lint(pages.withColumn("page_id", F.col("path")))
    flags = {"title": ~F.col("has_title"), "meta": ~F.col("has_meta"), "canonical": ~F.col("has_canonical"), "h1": F.col("n_h1") != 1, "json_ld": F.col("bad_json_ld") > 0}
    faults = F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in flags.items())))
    one = head.select(F.col("page_id").alias("path"), F.explode(faults).alias("fault"))
    h = F.coalesce("html", F.lit(""))
    tops = pages.select(
        F.trim(F.regexp_extract(h, r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"),
        F.trim(F.regexp_extract(h, r"(?is)<meta[^>]*name=.description.[^>]*content=.([^\"']*)", 1)).alias("meta"),
    )
    twice = [marts.duplicates(tops.where(F.col(c) != ""), c).select(F.col(c).alias("path"), F.lit(f"same {c}").alias("fault")) for c in ("title", "meta")]
    unlisted = pages.join(sitemap.select("path").distinct(), "path", "left_anti").select("path", F.lit("sitemap").alias("fault"))
    return one.unionByName(twice[0]).unionByName(twice[1]).unionByName(unlisted)


def progressing(items: DataFrame, case_ref: str) -> DataFrame:
    """Repeat groups of a case with two members and rounds at least."""
    got = items.where(F.col("case_ref") == case_ref).groupBy("repeat_group").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("auction_round").alias("rounds"))
    return got.where("repeat_group is not null and n > 1 and rounds > 1")


def mixed_cases(items: DataFrame) -> DataFrame:
    """Repeat groups that hold more than one case."""
    return items.where("repeat_group is not null").groupBy("repeat_group").agg(F.count_distinct("case_ref").alias("cases")).where("cases > 1")


def distinct_sources(runs: DataFrame) -> DataFrame:
    return runs.agg(F.count_distinct("source_sha256").alias("sources"))


def event_counts(events: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Events of the given kinds, counted."""
    return events.where(F.col("event_type").isin(*kinds)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def _absent(found: DataFrame, what: str) -> DataFrame:
    """One row if a frame has none."""
    return found.limit(1).agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit(what).alias("what"))


def _told(name: str, rows: DataFrame, *parts: str) -> DataFrame:
    """Violating rows as (name, offender)."""
    return rows.select(F.lit(name).alias("name"), F.concat_ws(" ", *(F.col(c).cast("string") for c in parts)).alias("offender"))


def item_violations(state: DataFrame, given_names: Sequence[str], own_address: str = "") -> DataFrame:
    """(name, offender) of what single items violate, all checks of a row in one look: personal data in text fields, names left in descriptions, wrong discounts."""
    struct = lambda name, *parts: F.struct(F.lit(name).alias("name"), F.concat_ws(" ", *parts).alias("offender"))
    foreign = lambda hits: F.filter(hits, lambda h: F.lower(F.trim(h["hit"])) != own_address.lower())
    told = lambda f: F.transform(foreign(pii.scan(F.col(f))), lambda h: struct("no_personal_data", F.concat_ws(".", "item_key", F.lit(f)), h["kind"]))
    hits = [told(f) for f in TEXT_FIELDS if f in state.columns]
    names = F.transform(pii.residual_names(F.col("description"), given_names), lambda n: struct("no_personal_data", F.concat_ws(".", "item_key", F.lit("description")), F.lit("name")))
    wrong = F.array_compact(F.array(F.when(_wrong_discount(), struct("discounts", F.col("item_key")))))
    return state.select(F.explode(F.concat(*hits, names, wrong)).alias("v")).select("v.*")


def coverage_text(state: DataFrame) -> DataFrame:
    """One row (name, detail): how many items have a county and how many have not, and the share of each covered field in percent, if there are items."""
    filled = lambda c: F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != ""))
    fields = [c for c in COVERED if c in state.columns]
    got = state.agg(F.count(F.lit(1)).alias("n"), *(filled(c).alias(c) for c in fields))
    share = lambda c: F.concat_ws(" ", F.lit(c), F.format_number(F.round((100 * F.col(c) / F.col("n")).cast("decimal(18,6)"), 1), 1))
    told = F.concat(F.col("county"), F.lit(" with a county, "), F.col("n") - F.col("county"), F.lit(" without; "), F.concat_ws(", ", *(share(c) for c in fields)))
    return got.select(F.lit("coverage_reported").alias("name"), F.when(F.col("n") > 0, told).otherwise("no items").alias("detail"))


def violations(
    snapshot: DataFrame, state: DataFrame, pages: DataFrame, sitemap: DataFrame, runs: DataFrame, prices: DataFrame, events: DataFrame,
    county: str, case_ref: str, given_names: Sequence[str], own_address: str = "",
) -> DataFrame:
    """(name, offender) of all checks."""
    spark = state.sparkSession
    canary = spark.range(1).select(F.explode(pii.scan(F.lit(CANARY))).alias("h")).agg(F.count_distinct("h.kind").alias("kinds")).where("kinds < 3")
    priced = state.where("opening_price_eur is not null and opening_price_eur <> 0").orderBy("item_key").limit(1)
    probe = priced.select("item_key", "status", F.col("opening_price_eur").cast("double").alias("opening_price_eur"))
    cut = probe.withColumn("opening_price_eur", F.col("opening_price_eur") * 0.8)
    caught = linking.snapshot_diff(cut, probe, "item_key", ["opening_price_eur"], "status").where("event = 'cijena'")
    one_source = distinct_sources(runs).where("sources < 2")
    phantom = prices.select("item_key", F.lit("change").alias("what")).join(F.broadcast(one_source.select(F.lit("change").alias("what"))), "what", "left_semi")
    shown = pages.select("path", F.explode(pii.scan(marts.visible_text(F.col("html")))).alias("h")).where(F.lower(F.trim("h.hit")) != own_address.lower())
    parts = [
        _told("keys_present", snapshot.join(state, "item_key", "left_anti"), "item_key"),
        _told("fields_same", field_differences(sample(snapshot, county), state), "item_key", "field"),
        item_violations(state, given_names, own_address),
        _told("no_personal_data", shown, "path", "h.kind"),
        _told("detectors_work", canary, "kinds"),
        _told("known_repeat_linked", _absent(progressing(state, case_ref), case_ref), "what"),
        _told("no_mixed_cases", mixed_cases(state), "repeat_group"),
        _told("pages", page_faults(pages, sitemap), "path", "fault"),
        _told("diacritics", _absent(pages.where(F.col("html").rlike("[čćžšđČĆŽŠĐ]")), "diacritics"), "what"),
        _told("history", phantom, "item_key"),
        _told("price_tracking", _absent(caught, "change"), "what"),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def validate(
    snapshot: DataFrame, state: DataFrame, pages: DataFrame, sitemap: DataFrame, runs: DataFrame, prices: DataFrame, events: DataFrame,
    county: str, case_ref: str, given_names: Sequence[str] = tuple(pii.GIVEN_NAMES), own_address: str = "",
) -> DataFrame:
    """(name, violations, status, offenders, detail) of the twelve checks.

    offenders are the first NAMED ones. Coverage is reported in detail and never fails. History
    over time fails on a change between runs of one source, and warns while only one source
    was seen or nothing changed.
    """
    spark = state.sparkSession
    found = checkpointed(violations(snapshot, state, pages, sitemap, runs, prices, events, county, case_ref, given_names, own_address))
    counts = found.groupBy("name").agg(F.count(F.lit(1)).alias("violations"))
    first = marts.top_by_group(found, "name", [F.col("offender")], NAMED).groupBy("name").agg(F.array_sort(F.collect_list("offender")).alias("offenders"))
    several = distinct_sources(runs).where("sources > 1").select(F.lit("history").alias("name"))
    tracked = prices.select(F.lit("history").alias("name")).unionByName(events.where(F.col("event_type").isin("nova", "status")).select(F.lit("history").alias("name"))).limit(1)
    watched = several.join(F.broadcast(tracked), "name", "left_semi").withColumn("watched", F.lit(True))
    report = spark.createDataFrame([(c,) for c in CHECKS], "name string")
    for more in (counts, first, watched, coverage_text(state)):  # a row for each check at most
        report = report.join(F.broadcast(more), "name", "left")
    n = F.coalesce("violations", F.lit(0))
    status = F.when(n > 0, "FAIL").when((F.col("name") == "history") & F.col("watched").isNull(), "WARN").otherwise("PASS")
    return report.select("name", n.alias("violations"), status.alias("status"), F.coalesce("offenders", F.array().cast("array<string>")).alias("offenders"), F.coalesce("detail", F.lit("")).alias("detail"))


def exit_code(report: DataFrame) -> int:
    """1 if a check failed."""
    return 0 if report.where("status = 'FAIL'").isEmpty() else 1
