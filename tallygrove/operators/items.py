"""From snapshot rows to items: allow-list and redaction, mapping, display fields, listings of what is unresolved."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.functions import classify, parse, pii, text
from tallygrove.functions.text import text_or_empty

# Labels of types, statuses and procedures, and the kinds of statuses and types.
TYPE_LABELS = {
    "stan": "Stan", "kuca": "Kuća", "poslovni-prostor": "Poslovni prostor", "gradevinsko-zemljiste": "Građevinsko zemljište",
    "poljoprivredno-zemljiste": "Poljoprivredno zemljište", "sumsko-zemljiste": "Šumsko zemljište", "garaza": "Garaža / parkirno mjesto",
    "zemljiste": "Zemljište", "pokretnina": "Pokretnina", "pravo": "Pravo", "ostalo": "Nekretnina",
}
STATUS_LABELS = {"najavljeno": "Najavljeno", "u_tijeku": "U tijeku", "zavrseno": "Završeno", "bez_termina": "Bez termina"}
PROCEDURE_LABELS = {"ovrha": "Ovrha", "stecaj": "Stečaj", "osiguranje": "Osiguranje", "insolvencija": "Insolvencijski postupak", "ostalo": "Ostalo"}
ACTIVE = ["najavljeno", "u_tijeku", "bez_termina"]
MOVABLE = ["pokretnina", "pravo"]
#: Issuers whose seat says nothing about where an estate lies.
SEATLESS = ["trgovacki_sud", "javni_biljeznik", "ostalo", "nepoznato"]


def sanitise(rows: DataFrame, published: Sequence[str], free_text: str, issuer: str, viewing: str | None = None, key: Sequence[str] = ("row_ord",)) -> DataFrame:
    """Published columns trimmed, the free text redacted, the issuer an institution; removed counts what went, by kind.

    Columns that are not published never enter the plan; of a viewing note only the slot is derived.
    """
    done = pii.redact(F.trim(text_or_empty(F.col(free_text))))
    name = classify.issuer_name(F.col(issuer))
    renamed = F.when(name != F.trim(text_or_empty(F.col(issuer))), F.create_map(F.lit("notary_name"), F.lit(1))).otherwise(F.create_map().cast("map<string,int>"))
    plain = [F.trim(text_or_empty(F.col(c))).alias(c) for c in published if c not in (free_text, issuer)]
    rows = rows.withColumn("__low", text.fold(F.col(issuer)))
    out = rows.select(*key, *plain, done.alias("__done"), name.alias(issuer), classify.issuer_type(F.col(issuer), F.col("__low")).alias("issuer_type"),
                      (pii.viewing_window(F.col(viewing)) if viewing else F.lit("")).alias("viewing_time"), renamed.alias("__renamed"))
    return out.withColumn(free_text, F.col("__done.text")).withColumn("removed", F.map_concat("__done.removed", "__renamed")).drop("__done", "__renamed")


def removal_summary(clean: DataFrame) -> DataFrame:
    """(kind, n): what sanitise removed, the most frequent first."""
    each = clean.select(F.explode("removed").alias("kind", "n"))
    return each.groupBy("kind").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "kind")


def to_items(clean: DataFrame, columns: Mapping[str, str], as_of: Column, key: Sequence[str] = ("row_ord",)) -> DataFrame:
    """The item of each clean row, but for its location.

    columns names the source column of: case_ref, auction_id, description, kind, issuer,
    scope, sale_method, round, estimated, opening, minimum, deposit, step, decision_date,
    publish_start, auction_start, auction_end, deposit_value_date, extendable, snapshot_date.
    The status is as of the given time, not of the snapshot.
    """
    c = {name: F.col(f"`{source}`") for name, source in columns.items()}
    money = lambda name: parse.parse_money(c[name]).cast("decimal(16,2)")
    area = parse.parse_area(c["description"])
    clean = clean.withColumns({"__text": text.fold(c["description"]), "__kind": text.fold(c["kind"])})
    out = clean.select(
        *key,
        F.trim(c["case_ref"]).alias("case_ref"),
        F.nullif(F.trim(c["auction_id"]), F.lit("")).alias("auction_id"),
        "issuer_type",
        c["issuer"].alias("issuer_name"),
        c["description"].alias("description"),
        classify.folded_property_type(F.col("__text"), F.col("__kind")).alias("property_type"),
        classify.procedure_type(c["case_ref"]).alias("procedure_type"),
        c["sale_method"].alias("sale_method"),
        c["scope"].alias("scope"),
        money("estimated").alias("estimated_value_eur"),
        money("opening").alias("opening_price_eur"),
        money("minimum").alias("minimum_price_eur"),
        money("deposit").alias("deposit_eur"),
        money("step").alias("bid_step_eur"),
        F.lit(None).cast("decimal(16,2)").alias("current_bid_eur"),
        area.alias("__area"),
        F.nullif(F.trim(c["round"]), F.lit("")).alias("auction_round"),
        classify.round_number(c["round"]).alias("auction_round_no"),
        *(parse.parse_datetime(c[name]).alias(name) for name in ("decision_date", "publish_start", "auction_start", "auction_end", "deposit_value_date")),
        (c["extendable"] == "Da").alias("extendable"),
        "viewing_time",
        parse.parse_datetime(c["snapshot_date"]).cast("date").alias("source_snapshot_date"),
    )
    estimated, opening = F.col("estimated_value_eur").cast("double"), F.col("opening_price_eur").cast("double")
    out = out.withColumns(
        {
            "area_m2": F.col("__area.area").cast("decimal(16,2)"),
            "area_unit_source": F.col("__area.unit"),
            "discount_pct": parse.discount_pct(estimated, opening).cast("decimal(9,2)"),
            "discount_suspicious": parse.is_suspicious(estimated, opening),
            "status": parse.derive_status(F.col("auction_start"), F.col("auction_end"), as_of),
        }
    ).drop("__area")
    facts = {n: F.col(n) for n in ("case_ref", "auction_id", "description", "auction_round", "decision_date", "publish_start", "scope", "property_type")}
    return out.withColumn("item_key", text.item_key(facts | {"estimated_value": F.col("estimated_value_eur")}))


def place_of(city: Column, unit: Column, county: Column) -> Column:
    return text.first_filled(city, unit, county, default="Hrvatska")


def county_url(county: Column) -> Column:
    return F.concat(F.lit("/nekretnine/"), F.coalesce(F.nullif(text.slugify(county), F.lit("")), F.lit("nepoznata-lokacija")), F.lit("/"))


def city_url(county: Column, city: Column) -> Column:
    return F.concat(county_url(county), F.coalesce(F.nullif(text.slugify(city), F.lit("")), F.lit("ostalo")), F.lit("/"))


def type_url(kind: Column) -> Column:
    return F.concat(F.lit("/vrste/"), kind, F.lit("/"))


def item_url(kind: Column, county: Column, city: Column, slug: Column) -> Column:
    """Movables and rights have no place and live in a tree of their own."""
    return F.when(kind.isin(*MOVABLE), F.concat(F.lit("/pokretnine/"), slug, F.lit("/"))).otherwise(F.concat(city_url(county, city), slug, F.lit("/")))


def card_title(kind: Column, area: Column, place: Column) -> Column:
    """Type with its area, and the place."""
    label = text.lookup(kind, TYPE_LABELS, F.lit("Nekretnina"))
    size = F.when(F.coalesce(area, F.lit(0)) != 0, F.concat(F.translate(F.format_number(F.round(area.cast("decimal(18,6)"), 0), 0), ",", text.NBSP), F.lit(" m²")))
    return F.concat_ws(", ", F.concat_ws(" ", label, size), F.nullif(place, F.lit("")))


def meta_description(item: Mapping[str, Column], place: Column) -> Column:
    """Three sentences of 300 characters at most: the facts that an item has, its procedure, the source."""
    has = lambda name: F.coalesce(item[name], F.lit(0)) != 0
    # Each fact with what stands before and after it, and the condition under which it is told.
    facts = [
        (F.lit(True), "", text.lookup(item["property_type"], TYPE_LABELS, F.lit("Nekretnina")), ""),
        (has("area_m2"), "", text.format_area(item["area_m2"]), ""),
        (text_or_empty(item["city"]) != "", "u mjestu ", place, ""),
        (text_or_empty(item["city"]) == "", "", place, ""),
        (has("opening_price_eur"), "početna cijena ", text.format_eur(item["opening_price_eur"]), ""),
        (item["discount_pct"].isNotNull() & ~item["discount_suspicious"], "", text.format_pct(item["discount_pct"]), " ispod procjene"),
    ]
    procedure = F.nullif(F.lower(text.lookup(item["procedure_type"], PROCEDURE_LABELS, F.lit(""))), F.lit("ostalo"))
    told = F.concat_ws(", ", *(F.when(when, F.concat(F.lit(before), value, F.lit(after))) for when, before, value, after in facts))
    sale = F.concat(F.lit("Sudska dražba"), F.coalesce(F.concat(F.lit(" ("), F.nullif(procedure, F.lit("")), F.lit(")")), F.lit("")))
    sentences = [F.nullif(F.regexp_replace(x, r"^[ .,]+|[ .,]+$", ""), F.lit("")) for x in (told, sale, F.lit("Službeni podaci FINA Očevidnika"))]
    return F.substring(F.concat(F.concat_ws(". ", *sentences), F.lit(".")), 1, 300)


def decorate(items: DataFrame, today: Column) -> DataFrame:
    """Items with slug, labels, urls, titles, price_per_m2 and days_left (within 60 days, of announced and running ones)."""
    c = {n: F.col(n) for n in ("property_type", "county", "city", "area_m2", "opening_price_eur", "discount_pct", "discount_suspicious", "procedure_type", "status")}
    place = place_of(c["city"], F.col("cadastral_municipality"), c["county"])
    named = F.coalesce(F.nullif(c["city"], F.lit("")), F.nullif(F.col("cadastral_municipality"), F.lit("")), F.lit(""))
    out = items.withColumn("slug", text.build_slug(text.lookup(c["property_type"], TYPE_LABELS, F.lit("nekretnina")), named, F.col("item_key")))
    has_price = (F.coalesce(c["opening_price_eur"], F.lit(0)) != 0) & (F.coalesce(c["area_m2"], F.lit(0)) >= 1) & ~c["discount_suspicious"]
    left = F.datediff(F.col("auction_end").cast("date"), today)
    return out.withColumns(
        {
            "type_label": text.lookup(c["property_type"], TYPE_LABELS, F.lit("Nekretnina")),
            "status_label": text.lookup(c["status"], STATUS_LABELS, text_or_empty(c["status"])),
            "procedure_label": text.lookup(c["procedure_type"], PROCEDURE_LABELS, F.lit("Ostalo")),
            "url": item_url(c["property_type"], c["county"], c["city"], F.col("slug")),
            "card_title": card_title(c["property_type"], c["area_m2"], place),
            "meta_description": meta_description(c, place),
            "price_per_m2": F.when(has_price, parse.round_half_up(c["opening_price_eur"].cast("double") / c["area_m2"].cast("double"))).cast("double"),
            "days_left": F.when(c["status"].isin("najavljeno", "u_tijeku") & left.between(0, 60), left),
        }
    )


def active(items: DataFrame) -> DataFrame:
    return items.where(F.col("status").isin(*ACTIVE))


def estates(items: DataFrame) -> DataFrame:
    return items.where(~F.col("property_type").isin(*MOVABLE))


def movables(items: DataFrame) -> DataFrame:
    return items.where(F.col("property_type").isin(*MOVABLE))


def residue(items: DataFrame) -> DataFrame:
    """Estates without a county that are not finished, by key."""
    return estates(items).where(F.col("county").isNull() & (F.col("status") != "zavrseno")).orderBy("item_key")


def unresolved(items: DataFrame) -> DataFrame:
    """(item_key, issuer_name, raw_hint, reason) of items without a county."""
    reason = F.when(F.col("issuer_type").isin(*SEATLESS), "sjedište tijela nije dokaz lokacije").otherwise("naselje nije prepoznato u opisu")
    hint = F.substring(text.first_filled(F.col("location_raw"), F.col("cadastral_municipality")), 1, 200)
    return items.where("county is null").select("item_key", "issuer_name", hint.alias("raw_hint"), reason.alias("reason"))


def unresolved_by_issuer(items: DataFrame, n: int = 8) -> tuple[DataFrame, DataFrame]:
    """Items without a county by issuer type, and the n issuers that have most of them."""
    bare = items.where("county is null")
    by_type = bare.groupBy(F.coalesce(F.nullif("issuer_type", F.lit("")), F.lit("nepoznato")).alias("issuer_type")).agg(F.count(F.lit(1)).alias("n"))
    names = bare.groupBy("issuer_name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "issuer_name").limit(n)
    return by_type, names


def is_stale(snapshot: Column, now: Column, most_hours: int = 48) -> Column:
    """Whether more hours than allowed lie between the snapshot's midnight and now; it gates publishing only."""
    hours = (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(snapshot.cast("timestamp"))) / 3600
    return F.coalesce(hours > most_hours, F.lit(False))
