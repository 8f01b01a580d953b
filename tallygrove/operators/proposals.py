"""Proposed locations against the registers: which are confirmed, by what, and why the others are not.

Whoever proposes (a model, a clerk) only reads names; the registers decide. A name that stands
both in the text and in a register outweighs a proposed county. The first of three rules that
applies decides for good, whether it accepts or rejects:

1. the cadastral unit, by the register of units;
2. the settlement, by the register of settlements, unless units say that its name is not unique;
3. the county alone, if the text names it or a place that is only in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.functions.text import fold, grounded, text_or_empty
from tallygrove.operators.location import by_name, longest_mention

_NONE = "array<string>"


def _bare(name: Column) -> Column:
    """Without punctuation around it and without an ordinal at its end."""
    return F.regexp_replace(F.regexp_replace(text_or_empty(name), r"^[ ,.;:-]+|[ ,.;:-]+$", ""), r"\s+(?:[IVX]{1,4}|\d{1,2})$", "")


def judge_proposals(proposals: DataFrame, settlements: DataFrame, units: DataFrame, ambiguous: Sequence[str] = ()) -> DataFrame:
    """(item_id, county, settlement, unit, evidence, reason): evidence for confirmed proposals, and for the others no county and a reason.

    proposals: item_id, text, county (an official name), settlement, unit, each of which may be
    missing; settlements: name, county, population; units: code, name, county (may be missing).
    """
    filled = lambda c: F.nullif(F.trim(text_or_empty(F.col(c))), F.lit(""))
    asked = proposals.select("item_id", text_or_empty(F.col("text")).alias("text"), filled("county").alias("claimed"), filled("settlement").alias("settlement"), filled("unit").alias("unit"))
    asked = asked.withColumn("ks", fold(_bare(F.col("settlement"))))

    # all units of the name, by the first of the keys that finds any
    ids = by_name(asked.where("unit is not null").select(F.col("item_id").alias("name_id"), _bare(F.col("unit")).alias("name")), units.select(F.col("code").alias("unit_id"), "name"))
    entries = ids.join(units.select(F.col("code").alias("unit_id"), F.col("name").alias("u"), F.col("county").alias("c")), "unit_id")
    entries = entries.groupBy(F.col("name_id").alias("item_id")).agg(F.count(F.lit(1)).alias("n_units"), F.collect_set("c").alias("unit_counties"), F.min(F.struct("unit_id", "u")).alias("first_unit"))
    known = settlements.groupBy(fold(F.col("name")).alias("ks")).agg(F.collect_set("county").alias("counties"))
    spelled = settlements.groupBy(fold(F.col("name")).alias("ks"), F.col("county").alias("sc")).agg(F.max_by("name", F.struct("population", "name")).alias("s"))
    spelled = spelled.groupBy("ks").agg(F.map_from_entries(F.collect_list(F.struct("sc", "s"))).alias("spelled"))
    elsewhere = units.where("county is not null").groupBy(fold(F.col("name")).alias("ks")).agg(F.collect_set("county").alias("same_name"))
    # places that stand in the text and are in one county only, four letters at least
    unique = settlements.groupBy(fold(F.col("name")).alias("ks")).agg(F.collect_set("county").alias("cs"), F.max_by("name", F.struct("population", "name")).alias("name"))
    unique = unique.where((F.size("cs") == 1) & (F.char_length("ks") >= 4) & ~F.col("ks").isin([a for a in _folded(settlements, ambiguous)])).withColumn("county", F.col("cs")[0])
    unique = unique.join(elsewhere, "ks", "left").where(F.size(F.array_except(F.coalesce("same_name", F.array().cast(_NONE)), F.array("county"))) <= 0)
    mention = longest_mention(asked.where("claimed is not null").select(F.col("item_id").alias("text_id"), "text", F.col("claimed").alias("county")), unique.select("name", "county"))

    met = asked.join(entries, "item_id", "left").join(known, "ks", "left").join(spelled, "ks", "left").join(elsewhere, "ks", "left")
    met = met.join(mention.select(F.col("text_id").alias("item_id"), F.col("name").alias("mention")), "item_id", "left")
    claimed, settlement, unit, text = (F.col(c) for c in ("claimed", "settlement", "unit", "text"))
    counties, unit_counties = (F.coalesce(c, F.array().cast(_NONE)) for c in ("counties", "unit_counties"))
    n = F.coalesce("n_units", F.lit(0))
    in_county = lambda c: F.try_element_at("spelled", c)
    clash = lambda c: F.size(F.array_except(F.coalesce("same_name", F.array().cast(_NONE)), F.array(c))) > 0
    say = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts))
    name = F.col("first_unit")["u"]

    def accept(county: Column, place: Column, unit: Column, evidence: Column) -> Column:
        return F.struct(county.alias("county"), F.coalesce(place, F.lit("")).alias("settlement"), F.coalesce(unit, F.lit("")).alias("unit"), evidence.alias("evidence"), F.lit("").alias("reason"))

    def reject(reason: Column) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(none.alias("county"), F.lit("").alias("settlement"), F.lit("").alias("unit"), F.lit("").alias("evidence"), reason.alias("reason"))

    own = F.get(unit_counties, 0)
    stands = grounded(unit, text)
    one_unit = (n == 1) & own.isNotNull()
    blank = F.lit("")
    sole = F.get(counties, 0)
    doubtful = F.col("ks").isin(_folded(settlements, ambiguous))
    asks = settlement.isNotNull()
    backed = F.array_contains(counties, claimed) & ~clash(claimed)
    stem = fold(F.replace(claimed, F.lit(" županija"), F.lit("")))
    # The phrases of evidence and rejection.
    rules = [
        (one_unit & claimed.isNotNull() & (claimed != own) & ~stands, reject(say("k.o. ", name, " je u ", own, ", model tvrdi ", claimed, " — proturječje bez uporišta u tekstu, odbijeno"))),
        (one_unit & asks & in_county(own).isNull() & (F.size(F.array_except(counties, F.array(own))) > 0) & ~stands, reject(say("k.o. ", name, " (", own, ") i naselje ", settlement, " se ne slažu — odbijeno"))),
        (one_unit, accept(own, F.when(asks, in_county(own)), F.initcap(name), say("k.o. ", name, " (DGU ", F.col("first_unit")["unit_id"].cast("string"), ")"))),
        ((n > 1) & F.array_contains(unit_counties, claimed), accept(claimed, F.when(asks, in_county(claimed)), F.initcap(name), say("k.o. ", name, " ×", n.cast("string"), " + županija u opisu"))),
        (asks & doubtful & backed, accept(claimed, in_county(claimed), blank, say("naselje ", in_county(claimed), " (DZS) +županija (dvoznačno ime)"))),
        (asks & doubtful, reject(say("naselje ", settlement, " je poznato dvoznačno ime — bez potvrde županije se ne prihvaća"))),
        (asks & (F.size(counties) == 1) & clash(sole), reject(say("naselje ", settlement, ": istoimena k.o. postoji u drugoj županiji (DGU) — ime nije jednoznačno, odbijeno"))),
        (asks & (F.size(counties) == 1) & claimed.isNotNull() & (claimed != sole) & ~grounded(settlement, text), reject(say("naselje ", settlement, " je u ", sole, ", model tvrdi ", claimed, " — proturječje bez uporišta u tekstu, odbijeno"))),
        (asks & (F.size(counties) == 1), accept(sole, in_county(sole), blank, say("naselje ", in_county(sole), " (DZS)"))),
        (asks & (F.size(counties) > 1) & backed, accept(claimed, in_county(claimed), blank, say("naselje ", in_county(claimed), " (DZS, ×", F.size(counties).cast("string"), ") + županija"))),
        (asks & (F.size(counties) > 0), reject(say("naselje ", settlement, " postoji u ", F.size(counties).cast("string"), " županija, bez presude — odbijeno"))),
        (asks & claimed.isNull(), reject(say("'", settlement, "' nije u DZS registru naselja — odbijeno"))),
        (claimed.isNotNull() & F.contains(fold(text), F.substring(stem, F.lit(1), F.char_length(stem) - 1)), accept(claimed, blank, blank, say("županija izrijekom u opisu (", claimed, ")"))),
        (claimed.isNotNull() & F.col("mention").isNotNull(), accept(claimed, F.col("mention"), blank, say("mjesto ", F.col("mention"), " u opisu (DZS, jednoznačno)"))),
        (claimed.isNotNull(), reject(say("model tvrdi ", claimed, ", ali ni županija ni njoj jednoznačno mjesto nisu spomenuti u opisu"))),
    ]
    verdict = None
    for when, then in rules:
        when = F.coalesce(when, F.lit(False))
        verdict = F.when(when, then) if verdict is None else verdict.when(when, then)
    return met.select("item_id", verdict.otherwise(reject(F.lit("model nije prepoznao lokaciju"))).alias("v")).select("item_id", "v.*")


def _folded(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Names of a short list as registers are keyed."""
    return [r["k"] for r in df.sparkSession.createDataFrame([(n,) for n in names], "n string").select(fold(F.col("n")).alias("k")).collect()] if names else []


def valid_proposals(proposals: DataFrame, settlements: DataFrame, units: DataFrame, ambiguous: Sequence[str] = ()) -> DataFrame:
    """The confirmed ones: (item_id, county, settlement, unit, evidence)."""
    return judge_proposals(proposals, settlements, units, ambiguous).where("county is not null").drop("reason")
