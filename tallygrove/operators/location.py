"""Location resolution against reference registers, with a confidence grade.

Registers are small dimensions (settlements, cadastral units with points and counties),
so every probe is a broadcast join whose size Spark checks against its threshold;
distances are looked up over cells (see nearest.py), never over all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.functions.parse import distance_km
from tallygrove.functions.text import fold, sorted_words
from tallygrove.operators.checkpoints import checkpointed
from tallygrove.operators.nearest import nearest

DOMINANCE = 20


def settlement_candidates(names: DataFrame, register: DataFrame) -> DataFrame:
    """(name_id, county, population, display): the counties that know a name, with its most populous settlement there.

    names: name_id, name; register: name, county, population.
    """
    known = register.select(fold(F.col("name")).alias("k"), F.col("name").alias("display"), "county", "population")
    known = known.groupBy("k", "county").agg(F.max("population").alias("population"), F.max_by("display", "population").alias("display"))
    return names.withColumn("k", fold(F.col("name"))).join(known, "k").select("name_id", "county", "population", "display")


def choose_county(candidates: DataFrame, anchors: DataFrame) -> DataFrame:
    """One row for each name: county, confidence.

    One candidate is high confidence; of several, the only one among the anchors is high,
    one at least DOMINANCE times as populous as the next is middle; else none.
    anchors: name_id, counties (array of strings from registry office, court and text).
    """
    ranked = candidates.groupBy("name_id").agg(
        F.sort_array(F.collect_list(F.struct("population", "county")), asc=False).alias("c"), F.collect_set("county").alias("counties")
    )
    met = ranked.join(anchors.withColumnRenamed("counties", "anchors"), "name_id", "left")
    common = F.array_intersect("counties", F.coalesce("anchors", F.array().cast("array<string>")))
    first, second = F.element_at("c", 1), F.coalesce(F.get("c", 1)["population"], F.lit(0))
    alone = F.size("counties") == 1
    tied = F.size(common) == 1
    dominant = first["population"] >= DOMINANCE * F.greatest(second, F.lit(1))
    county = F.when(alone, first["county"]).when(tied, F.element_at(common, 1)).when(dominant, first["county"])
    grade = F.when(alone | tied, "visoka").when(dominant, "srednja").otherwise("nema")
    return met.select("name_id", county.alias("county"), grade.alias("confidence"))


def by_name(names: DataFrame, units: DataFrame) -> DataFrame:
    """Probe a register by name: exactly, then with hyphens as spaces, then with words in any order.

    names: name_id, name; units: unit_id, name. One row for each name and unit found by the first key that finds any.
    """
    keys = [lambda c: fold(c), lambda c: F.replace(fold(c), F.lit("-"), F.lit(" ")), sorted_words]
    parts = []
    for place, key in enumerate(keys):
        left = names.select("name_id", key(F.col("name")).alias("k"))
        right = units.select("unit_id", key(F.col("name")).alias("k"))
        parts.append(left.join(right, "k").select("name_id", "unit_id", F.lit(place).alias("place")))
    found = parts[0].unionByName(parts[1]).unionByName(parts[2])
    best = found.groupBy("name_id").agg(F.min("place").alias("place"))
    return found.join(best, ["name_id", "place"]).select("name_id", "unit_id").distinct()


def unanimous(near: DataFrame, assigned: DataFrame, k: int, nearest_km: float | None = None) -> DataFrame:
    """(point_id, county) of points that have k near places, all of one county, the nearest within nearest_km. assigned: place_id, county."""
    return _agreed(near.join(assigned, "place_id"), k, nearest_km)


def _agreed(near: DataFrame, k: int, nearest_km: float | None) -> DataFrame:
    votes = near.groupBy("point_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("county").alias("counties"), F.min("county").alias("county"), F.min("km").alias("km"))
    close = F.lit(True) if nearest_km is None else F.col("km") <= nearest_km
    return votes.where((F.col("n") == k) & (F.col("counties") == 1) & close).select("point_id", "county")


def assign_counties(units: DataFrame, k: int = 5, within_km: float = 12.0, rounds: int | None = 5) -> DataFrame:
    """Spread counties to units without one: a unit takes the county of its k nearest units that have one, if all agree and the nearest is within_km away at most.

    Rounds read the state before them; without a number they go on until one changes
    nothing. units: unit_id, lat, lon, county (null where unknown).

    A unit without a county keeps its k nearest known ones. After a round only the units just
    assigned are places, and only those nearer than a unit's k-th are of interest to it, so
    what is not beside them is not looked at again: neither searched nor asked anew.
    """
    state = checkpointed(units.select("unit_id", "lat", "lon", "county"))
    spot = lambda df, name: df.select(F.col("unit_id").alias(name), "lat", "lon")
    known = state.where("county is not null")
    near = checkpointed(nearest(spot(state.where("county is null"), "point_id"), spot(known, "place_id"), k).drop("rank").join(known.select(F.col("unit_id").alias("place_id"), "county"), "place_id"))
    asked, found, done = near, None, 0
    while rounds is None or done < rounds:
        done += 1
        added = checkpointed(_agreed(asked, k, within_km))
        if added.isEmpty():
            break
        found = added if found is None else checkpointed(found.unionByName(added))
        near = near.join(added.select("point_id"), "point_id", "left_anti")
        new = added.withColumnRenamed("point_id", "unit_id").join(state.drop("county"), "unit_id")
        farthest = near.groupBy("point_id").agg(F.when(F.count(F.lit(1)) == k, F.max("km")).alias("reach"))
        open_units = spot(state.where("county is null"), "point_id").join(found.select("point_id"), "point_id", "left_anti").join(farthest, "point_id", "left")
        fresh = nearest(open_units, spot(new, "place_id"), k).drop("rank").join(new.select(F.col("unit_id").alias("place_id"), "county"), "place_id")
        fresh = checkpointed(fresh)
        beside = fresh.select("point_id").distinct()
        order = Window.partitionBy("point_id").orderBy("km", "place_id")
        asked = near.join(beside, "point_id", "left_semi").unionByName(fresh).withColumn("__i", F.row_number().over(order)).where(F.col("__i") <= k).drop("__i")
        asked = checkpointed(asked)
        near = checkpointed(near.join(beside, "point_id", "left_anti").unionByName(asked))
    if found is None:
        return state
    told = found.select(F.col("point_id").alias("unit_id"), F.col("county").alias("__found"))
    return state.join(told, "unit_id", "left").withColumn("county", F.coalesce("county", "__found")).drop("__found")


def cascade(rows: DataFrame) -> DataFrame:
    """The winning candidate of each item: least phase, then least position in the text, then least step.

    rows: item_id, phase, position, step, county, city, confidence. Mentions of one
    phase compete by position, so a later mention never outranks an earlier one.
    """
    best = rows.groupBy("item_id").agg(F.min_by(F.struct("county", "city", "confidence"), F.struct("phase", "position", "step")).alias("b"))
    return best.select("item_id", "b.*")


def with_overrides(items: DataFrame, overrides: DataFrame) -> DataFrame:
    """Confirmed overrides fill items without a county, at middle confidence. overrides: item_id, o_county, o_city."""
    met = items.join(overrides, "item_id", "left")
    use = F.col("county").isNull() & F.col("o_county").isNotNull()
    return met.select(
        "item_id",
        F.when(use, F.col("o_county")).otherwise(F.col("county")).alias("county"),
        F.when(use, F.col("o_city")).otherwise(F.col("city")).alias("city"),
        F.when(use, "srednja").otherwise(F.col("confidence")).alias("confidence"),
    )


def valid_overrides(overrides: DataFrame, counties: DataFrame, settlements: DataFrame, units: DataFrame) -> DataFrame:
    """Overrides whose county exists, whose settlement lies in it, and whose cadastral name no other county has.

    overrides: item_id, county, settlement, unit; counties: county; settlements: name, county; units: name, county.
    """
    ok = overrides.join(counties.select("county"), "county", "left_semi")
    here = settlements.select(fold(F.col("name")).alias("k"), F.col("county").alias("kc"))
    blank = F.coalesce(F.col("settlement"), F.lit("")) == ""
    inside = ok.where(~blank).join(here, (fold(F.col("settlement")) == F.col("k")) & (F.col("county") == F.col("kc")), "left_semi")
    ok = ok.where(blank).unionByName(inside)
    other = units.select(fold(F.col("name")).alias("k"), F.col("county").alias("kc"))
    return ok.join(other, (fold(F.col("unit")) == F.col("k")) & (F.col("county") != F.col("kc")), "left_anti")


def longest_mention(texts: DataFrame, names: DataFrame) -> DataFrame:
    """The longest register name that stands in each text as whole words: (text_id, name).

    Instead of testing each name in each text, a text's words, each with as many words after
    it as the longest name has, meet the names' first words in an equi-join. Only those that
    meet are put together, to as many words as names with that first word have, and meet the
    names. texts: text_id, text; names: name. If both have a county, only names of the
    text's county count.
    """
    both = ["k", "county"] if "county" in texts.columns and "county" in names.columns else ["k"]
    own = ["text_id", *both[1:]]
    known = names.select(F.trim(F.regexp_replace(fold(F.col("name")), "[^a-z0-9]+", " ")).alias("k"), "name", *both[1:]).where("k <> ''")
    known = checkpointed(known.select(*both, "name", F.split("k", " ").alias("ks")))
    longest = known.agg(F.max(F.size("ks"))).first()[0]
    if not longest:
        return texts.select("text_id", F.lit(None).cast("string").alias("name")).limit(0)
    firsts = known.select(F.get("ks", 0).alias("w0"), F.size("ks").alias("n")).groupBy("w0").agg(F.collect_set("n").alias("sizes"))
    words = F.split(F.trim(F.regexp_replace(fold(F.col("text")), "[^a-z0-9]+", " ")), " ")
    texts = texts.select(*own, words.alias("w"))
    # a text is set beside itself, shifted by a word each time: (w0, w1, ...), null beyond its end
    shifted = F.arrays_zip(*(F.slice("w", i + 1, F.size("w")).alias(f"w{i}") for i in range(longest)))
    each = texts.select(*own, F.inline(shifted).alias(*(f"w{i}" for i in range(longest)))).where("w0 is not null")
    met = each.join(firsts, "w0").withColumn("n", F.explode("sizes"))
    whole = F.array(*(F.col(f"w{i}") for i in range(longest)))
    met = met.select(*own, F.array_join(F.slice(whole, F.lit(1), F.col("n")), " ").alias("k"))
    met = met.join(known.select(*both, "name"), both)
    return met.groupBy("text_id").agg(F.max_by("name", F.struct(F.length("k"), "name")).alias("name"))


def name_counties(units: DataFrame, settlements: DataFrame, centres: DataFrame, core: str, core_km: float = 8.0, least_km: float = 25.0, ratio: float = 2.5) -> DataFrame:
    """Units with the county and source that their names and places tell: (unit_id, name, lat, lon, county, source), null where neither does.

    Within core_km of the core county's centre: that county. Else the only county of the
    settlements of that name, of its words in any order, or of all its words as
    settlements; rejected if its centre is beyond least_km and ratio times as far as the
    nearest centre. units: unit_id, name, lat, lon; centres: county, lat, lon (a few rows).
    """
    own = units.withColumn("k", fold(F.regexp_replace(F.trim("name"), r"\s+(?:[IVX]{1,4}|\d{1,2})$", "")))
    whole = settlements.groupBy(fold(F.col("name")).alias("k")).agg(F.collect_set("county").alias("c"))
    words = settlements.groupBy(sorted_words(F.col("name")).alias("w")).agg(F.collect_set("county").alias("cw"))
    parts = own.select("unit_id", F.explode(F.split("k", " ")).alias("k"), F.size(F.split("k", " ")).alias("n")).where("n > 1").join(whole, "k")
    agreed = parts.where(F.size("c") == 1).groupBy("unit_id", "n").agg(F.count(F.lit(1)).alias("met"), F.collect_set(F.col("c")[0]).alias("cp"))
    agreed = agreed.where((F.col("met") == F.col("n")) & (F.size("cp") == 1)).select("unit_id", "cp")
    met = own.join(whole, "k", "left").withColumn("w", sorted_words(F.col("k"))).join(words, "w", "left").join(agreed, "unit_id", "left")
    told = F.coalesce("c", "cw", "cp")
    met = met.withColumn("claimed", F.when(F.size(told) == 1, told[0])).withColumn("how", F.when(F.col("c").isNotNull(), "ime").when(F.col("cw").isNotNull(), "ime-obrnuto").otherwise("ime-slozeno"))
    # the centres are one row a county: a literal
    each = [F.struct(distance_km(F.col("lat"), F.col("lon"), F.lit(r["lat"]), F.lit(r["lon"])).alias("km"), F.lit(r["county"]).alias("c")) for r in centres.collect()]
    met = met.withColumn("far", F.array_sort(F.array(*each))).withColumn("least", F.col("far")[0]["km"]).withColumn("own", F.get(F.filter("far", lambda x: x["c"] == F.col("claimed")), 0)["km"])
    met = met.withColumn("to_core", F.get(F.filter("far", lambda x: x["c"] == core), 0)["km"])
    inside = F.coalesce(F.col("to_core") <= core_km, F.lit(False))
    good = F.col("claimed").isNotNull() & ~F.coalesce((F.col("own") > least_km) & (F.col("own") > ratio * F.col("least")), F.lit(False))
    return met.select(
        "unit_id", "name", "lat", "lon", F.when(inside, core).when(good, F.col("claimed")).alias("county"), F.when(inside, "jezgra").when(good, F.col("how")).alias("source")
    )
