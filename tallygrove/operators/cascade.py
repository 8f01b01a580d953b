"""The location cascade: every step makes candidate rows, the earliest step that has one wins.

Items: item_id, text, issuer, issuer_type. Registers, all small dimensions that joins
broadcast by their size:

    settlements  name, county, population
    towns        form (a name or a declined form of it), town, county (null if ambiguous)
    courts       town, county
    counties     county, lat, lon
    units        code, name, lat, lon, county (null where the register does not tell)

Names meet registers by equi-joins on folded keys; nothing is compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.functions.parse import distance_km
from tallygrove.functions.text import fold, sorted_words, trim_at_stop_word
from tallygrove.operators.checkpoints import checkpointed
from tallygrove.operators.location import DOMINANCE, unanimous
from tallygrove.operators.nearest import nearest

# How a cadastral unit, a place, a land registry and a court are written, and words that end a unit's name.
UNIT = r"(?<![\p{L}\d])(?:[Kk]\.?\s*[Oo]\.?|(?iu:katastarsk\p{L}+\s+op[cć]in\p{L}*))\s*:?\s*"
CAPITAL = r"\p{Lu}[\p{L}\d]*(?:-\p{Lu}[\p{L}\d]*)?"
ANY = r"\p{L}[\p{L}\d]*(?:-\p{L}[\p{L}\d]*)?"
PLACE_WORDS = ["u", "na", "iz", "kod", "blizu", "mjestu", "naselju", "gradu", "općini", "opcini", "adresi"]
LAND_REGISTRY = r"(?iu:zemlji[šs]noknji[žz]n\p{L}*|zk\.?)\s+(?iu:odjel\p{L}*)\s+(?:[Uu]\s+)?(\p{Lu}[\p{L}-]+(?:\s+\p{Lu}[\p{L}-]+)?)"
BRANCH, SEAT = r"(?iu)stalna\s+služba\s+u\s+(.+)$", r"(?iu)sud\s+u\s+([^,]+)"
STOP_WORDS = """zemljisnoknjiznog zemljisnoknjizni zemljisnoknjizne zemljisnoknjizna opcinskog opcinski trgovackog trgovacki suda sud odjela odjel
    sluzbe sluzba vlasnistvo vlasnistvu etazno upisano upisane upisana poslovni stambeni zgrada kuca stan zk ul zkul kc kcbr ckbr br broj cest cestica""".split()
_ORDINAL = r"\s+(?:[IVX]{1,4}|\d{1,2})$"


@dataclass(frozen=True)
class Registers:
    settlements: DataFrame
    towns: DataFrame
    courts: DataFrame
    counties: DataFrame
    units: DataFrame


def bare(name: Column) -> Column:
    """A name without punctuation around it and without its ordinal."""
    return F.regexp_replace(F.trim(F.regexp_replace(name, r"^[ ,.;:-]+|[ ,.;:-]+$", "")), _ORDINAL, "")


def unit_names(text: Column, first: str = CAPITAL) -> Column:
    """All names that follow the sign of a cadastral unit, cut at stop words: three characters at least, no numbers, 80 at most."""
    found = F.regexp_extract_all(text, F.lit(rf"{UNIT}(?:\d{{4,6}}[\s,]+)?({first}(?:\s+{first}){{0,3}})"), F.lit(1))
    cut = F.transform(found, lambda n: F.substring(trim_at_stop_word(n, STOP_WORDS), 1, 80))
    return F.filter(cut, lambda n: (F.char_length(n) >= 3) & ~n.rlike(r"^\d+$"))


def unit_code(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, rf"{UNIT}(\d{{4,6}})\b", 1), F.lit(""))


def words(text: Column) -> Column:
    """array<struct<w, opens, ends>>: what stands between white space, without signs around it, and whether signs stood before or after."""
    chunks = F.filter(F.split(text, r"\s+"), lambda c: c != "")
    bare_word = lambda c: F.regexp_replace(c, r"^[^\p{L}\d]+|[^\p{L}\d]+$", "")
    return F.transform(chunks, lambda c: F.struct(bare_word(c).alias("w"), c.rlike(r"^[^\p{L}\d]").alias("opens"), c.rlike(r"[^\p{L}\d]$").alias("ends")))


def prose_names(spoken: Column) -> Column:
    """Of the words of a text: names after a word that leads to a place, up to three capitalised words with no sign between."""
    leads = F.array(*map(F.lit, PLACE_WORDS))

    def after(i: Column) -> Column:
        at = [F.get(spoken, i + k) for k in range(4)]
        goes, name = F.array_contains(leads, at[0]["w"]), []
        for before, now in zip(at, at[1:]):
            goes = goes & ~before["ends"] & ~now["opens"] & now["w"].rlike(r"^\p{Lu}[\p{L}\d-]+$")
            name.append(F.when(goes, now["w"]))
        return F.concat_ws(" ", *name)

    return F.filter(F.transform(F.sequence(F.lit(0), F.size(spoken)), after), lambda n: n != "")


def hint_names(spoken: Column) -> Column:
    """Of the words of a text: runs of up to three capitalised ones of three letters and more, with hyphens as spaces too, and their parts of five letters and more."""
    part = lambda p, sign: F.struct(p.alias("p"), F.lit(sign).alias("sign"))
    stop = F.array(part(F.lit(""), ""))
    none = F.array().cast("array<struct<p:string,sign:string>>")

    def parts(word: Column) -> Column:
        own = F.transform(F.split(word["w"], "-"), lambda p, i: F.struct(p.alias("p"), F.when(i == 0, " ").otherwise("-").alias("sign")))
        return F.concat(F.when(word["opens"], stop).otherwise(none), own, F.when(word["ends"], stop).otherwise(none))

    def step(run: Column, x: Column) -> Column:
        name = x["p"].rlike(r"^\p{Lu}[\p{L}\d]{2,}$")
        on = name & run["n"].between(1, 2)
        done = F.when((run["n"] > 0) & ~on, F.concat(run["done"], F.array(run["now"]))).otherwise(run["done"])
        now = F.when(on, F.concat(run["now"], x["sign"], x["p"])).when(name, x["p"]).otherwise("")
        n = F.when(on, run["n"] + 1).when(name, 1).otherwise(0)
        return F.struct(done.alias("done"), now.alias("now"), n.alias("n"))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"), F.lit(0).alias("n"))
    runs = F.reduce(F.flatten(F.transform(spoken, parts)), start, step, lambda r: F.when(r["n"] > 0, F.concat(r["done"], F.array(r["now"]))).otherwise(r["done"]))
    long = F.filter(F.flatten(F.transform(runs, lambda r: F.split(r, r"[\s-]+"))), lambda p: F.char_length(p) >= 5)
    return F.array_distinct(F.concat(runs, F.transform(runs, lambda r: F.replace(r, F.lit("-"), F.lit(" "))), long))


def keyed(df: DataFrame) -> DataFrame:
    """df with k, the folded name, if it has none: the folding's tables are long and stand in every plan that folds."""
    return df if "k" in df.columns else df.withColumn("k", fold(F.col("name")))


def forms_of(towns: DataFrame) -> DataFrame:
    """(form, t): each folded form once, with its town and county."""
    return towns.select(fold(F.col("form")).alias("form"), "town", F.col("county").alias("town_county")).groupBy("form").agg(F.min_by(F.struct("town", "town_county"), "town").alias("t"))


def name_keys(names: DataFrame) -> DataFrame:
    """names as a table with __a, the folded name, and __b, the one without its ordinal: joins on them do not hold the folding in their plans."""
    cut = names.withColumns({"__a": F.regexp_replace(F.col("name"), r"^[ ,.;:-]+|[ ,.;:-]+$", ""), "__b": bare(F.col("name"))})
    return checkpointed(cut.withColumns({"__a": fold(F.col("__a")), "__b": fold(F.col("__b"))}))


def towns_of(names: DataFrame, towns: DataFrame) -> DataFrame:
    """(*names, town, county) by the name as it stands, else without its ordinal; a name's last word is never dropped. towns: as registered, or forms_of them."""
    forms = (towns if "t" in towns.columns else forms_of(towns)).select(F.col("form").alias("__form"), F.col("t").alias("__t"))
    met = names if "__a" in names.columns else name_keys(names)
    met = met.join(forms.select(F.col("__form").alias("__a"), F.col("__t").alias("__ta")), "__a", "left").join(forms.select(F.col("__form").alias("__b"), F.col("__t").alias("__tb")), "__b", "left")
    t = F.coalesce("__ta", "__tb")
    return met.withColumn("town", t["town"]).withColumn("town_county", t["town_county"]).drop("__a", "__b", "__ta", "__tb")


def candidates(names: DataFrame, reg: Registers) -> DataFrame:
    """(item_id, role, pos, name, found): found is an array of (population, county), the most populous first, of the counties that know the name."""
    known = keyed(reg.settlements).select("k", "county", "population")
    names = name_keys(names)
    one = names.withColumn("k", F.col("__b")).join(known, "k").select("item_id", "role", "pos", "name", "county", "population")
    two = towns_of(names, reg.towns).where("town_county is not null").select("item_id", "role", "pos", "name", F.col("town_county").alias("county"), F.lit(0).cast("long").alias("population"))
    each = one.withColumn("population", F.col("population").cast("long")).unionByName(two)
    most = each.groupBy("item_id", "role", "pos", "name", "county").agg(F.max("population").alias("population"))
    return most.groupBy("item_id", "role", "pos", "name").agg(F.sort_array(F.collect_list(F.struct("population", "county")), asc=False).alias("found"))


def display_names(names: DataFrame, reg: Registers) -> DataFrame:
    """(name, display): the most populous settlement's spelling, else the only unit's in title case, else the town, else the name."""
    names = name_keys(names.select("name").distinct())
    spelled = keyed(reg.settlements).groupBy(F.col("k").alias("__k")).agg(F.max_by("name", F.struct("population", "name")).alias("__s"))
    units = keyed(reg.units).groupBy(F.col("k").alias("__k")).agg(F.count(F.lit(1)).alias("__n"), F.min("name").alias("__u")).where("__n = 1")
    met = towns_of(names.withColumn("__k", F.col("__b")), reg.towns).join(spelled, "__k", "left").join(units.select("__k", "__u"), "__k", "left")
    return met.select("name", F.coalesce("__s", F.initcap("__u"), "town", bare(F.col("name"))).alias("display"))


def unit_entries(names: DataFrame, units: DataFrame) -> DataFrame:
    """(item_id, codes, counties, only): units of each name by the first key that finds any: folded, hyphens as spaces, words in any order.

    only is the struct of the unit if there is just one.
    """
    keys = [lambda c: fold(bare(c)), lambda c: F.replace(fold(bare(c)), F.lit("-"), F.lit(" ")), lambda c: sorted_words(bare(c))]
    unit = F.struct("code", "name", "lat", "lon", "county", "near")
    parts = None
    names = checkpointed(names.select("item_id", *(key(F.col("name")).alias(f"k{place}") for place, key in enumerate(keys))))
    units = keyed(units)
    for place in range(len(keys)):
        left = names.select("item_id", F.col(f"k{place}").alias("k"))
        right = units.select(unit.alias("u"), (sorted_words(F.col("name")) if place == 2 else F.col("k")).alias("k"))
        part = left.join(right, "k").select("item_id", "u", F.lit(place).alias("place"))
        parts = part if parts is None else parts.unionByName(part)
    first = parts.groupBy("item_id").agg(F.min("place").alias("place"))
    got = parts.join(first, ["item_id", "place"]).groupBy("item_id").agg(F.collect_set("u").alias("us"))
    counties = F.array_distinct(F.filter(F.transform("us", lambda u: u["county"]), lambda c: c.isNotNull()))
    return got.select("item_id", F.size("us").alias("n_units"), counties.alias("unit_counties"), F.when(F.size("us") == 1, F.col("us")[0]).alias("only"))


def _only(a: Column) -> Column:
    return F.when(F.size(a) == 1, F.get(a, 0))


def tie_break(counties: Column, anchors: Column, hints: Column) -> Column:
    """The only county among the anchors, else the only one among the hints."""
    return F.coalesce(_only(F.array_intersect(counties, anchors)), _only(F.array_intersect(counties, hints)))


def dominant(found: Column) -> Column:
    """The county of the first candidate, if it is DOMINANCE times as populous as the second."""
    return F.when((F.size(found) > 1) & (F.get(found, 0)["population"] >= DOMINANCE * F.greatest(F.get(found, 1)["population"], F.lit(1))), F.get(found, 0)["county"])


def locate(items: DataFrame, reg: Registers) -> DataFrame:
    """item_id, county, city, cadastral_municipality, location_confidence, location_raw, step (1 to 9) for each item.

    Steps: 1 the unit is a county's name; 2 a place in prose that one county knows, unless
    the unit register contradicts; 3 one that several know, by tie-break or dominance; 4 the
    unit register; 5 the unit's name as a settlement of one county; 6 of several; 7 the land
    registry; 8 a municipal court; 9 none. Confidence is visoka where two signals agree or
    the prose is explicit, srednja for one signal, niska where they contradict, else nema.
    """
    text = F.coalesce("text", F.lit(""))
    # names of registers are folded once: every later plan that folds would hold the tables anew
    units = checkpointed(keyed(_with_near(reg.units)))
    reg = Registers(checkpointed(keyed(reg.settlements)), checkpointed(forms_of(reg.towns)), reg.courts, reg.counties, units)
    base = items.select("item_id", text.alias("text"), F.coalesce("issuer", F.lit("")).alias("issuer"), "issuer_type", F.get(unit_names(text), 0).alias("strict"), unit_code(text).alias("code"))
    # all names that are looked up, cut first and then folded, in a plan without joins
    municipal = F.when(F.col("issuer_type") == "opcinski_sud", F.col("issuer"))
    land = F.nullif(F.regexp_extract("text", LAND_REGISTRY, 1), F.lit(""))
    base = base.withColumns({
        "any": F.when(F.col("strict").isNull(), F.get(unit_names(F.col("text"), ANY), 0)), "land_name": land,
        "branch": F.trim(F.regexp_extract(municipal, BRANCH, 1)), "seat": F.trim(F.regexp_extract(municipal, SEAT, 1)),
    })
    base = base.withColumn("loose_key", bare(F.col("any")))
    base = checkpointed(base.withColumns({c: F.when(F.col(c).isNotNull(), fold(F.col(c))) for c in ("loose_key", "branch", "seat")}))
    # written in lower case: only if the register has the whole name
    listed = units.groupBy("k").agg(F.initcap(F.min("name")).alias("loose"))
    loose = base.where("any is not null").select("item_id", F.col("loose_key").alias("k")).join(listed, "k").select("item_id", "loose")
    # the land registry's town and the court's seat are anchors
    land = towns_of(base.where("land_name is not null").select("item_id", F.col("land_name").alias("name")), reg.towns)
    land = land.where("town_county is not null").select("item_id", F.col("town").alias("land_town"), F.col("town_county").alias("land_county"))
    seats = checkpointed(reg.courts.groupBy(fold(F.col("town")).alias("k")).agg(F.min("county").alias("c")))
    sought = base.where("branch is not null").select("item_id", "branch", "seat")
    sought = sought.join(seats.select(F.col("k").alias("branch"), F.col("c").alias("c1")), "branch", "left").join(seats.select(F.col("k").alias("seat"), F.col("c").alias("c2")), "seat", "left")
    base = base.join(loose, "item_id", "left").withColumn("unit", F.coalesce("strict", "loose")).drop("strict", "loose", "any", "land_name", "branch", "seat", "loose_key")
    base = base.join(land, "item_id", "left").join(sought.select("item_id", F.coalesce("c1", "c2").alias("court_county")), "item_id", "left")
    base = base.withColumn("anchors", F.array_distinct(F.array_compact(F.array("land_county", "court_county"))))
    base = checkpointed(base.withColumn("spoken", words(F.col("text"))).withColumn("unit_key", F.when(F.col("unit").isNotNull(), fold(F.col("unit")))))

    prose = base.select("item_id", F.posexplode(prose_names(F.col("spoken"))).alias("pos", "name")).withColumn("role", F.lit("prose"))
    hinted = base.select("item_id", F.posexplode(hint_names(F.col("spoken"))).alias("pos", "name")).withColumn("role", F.lit("hint"))
    named = base.where("unit is not null").select("item_id", F.lit(0).alias("pos"), F.col("unit").alias("name"), F.lit("unit").alias("role"))
    found = checkpointed(candidates(prose.unionByName(hinted).unionByName(named), reg))
    hints = found.where((F.col("role") == "hint") & (F.size("found") == 1)).groupBy("item_id").agg(F.collect_set(F.col("found")[0]["county"]).alias("hints"))
    base = base.join(hints, "item_id", "left").withColumn("hints", F.coalesce("hints", F.array().cast("array<string>")))

    # the register's county: by code, else by name
    by_code = units.select("code", F.coalesce("county", "near").alias("code_county"), F.lit(True).alias("code_known"))
    entries = unit_entries(base.where("unit is not null").select("item_id", F.col("unit").alias("name")), units)
    base = base.join(by_code, "code", "left").join(entries, "item_id", "left")
    several = F.when(F.col("n_units") > 1, F.coalesce(_only(F.col("unit_counties")), F.when(F.size("unit_counties") > 1, tie_break(F.col("unit_counties"), F.col("anchors"), F.col("hints")))))
    by_name = F.coalesce(F.col("only")["county"], F.col("only")["near"], several)
    base = base.withColumn("reg_county", F.when(F.col("code_known"), F.col("code_county")).otherwise(by_name))
    of_county = reg.counties.select("county", F.explode(F.array_distinct(F.array(fold(F.col("county")), fold(F.replace("county", F.lit(" županija"), F.lit("")))))).alias("k")).groupBy("k").agg(F.min("county").alias("named_county"))
    base = checkpointed(base.withColumnRenamed("unit_key", "k").join(of_county, "k", "left").drop("text", "spoken", "only", "k"))

    none = F.lit(None).cast("string")

    def rows(df: DataFrame, step: Column | int, county: Column, name: Column, grade: Column | str, raw: Column, pos: Column | int = 0) -> DataFrame:
        as_column = lambda x: F.lit(x) if isinstance(x, (int, str)) else x
        return df.select("item_id", as_column(step).alias("step"), as_column(pos).alias("pos"), county.alias("county"), name.alias("name"), as_column(grade).alias("grade"), raw.alias("raw"))

    agrees = lambda c: F.array_contains("anchors", c)
    free = F.size("anchors") == 0
    met = found.where("role <> 'hint'").join(base.select("item_id", "anchors", "hints", "reg_county", "land_county", "land_town", "court_county", "issuer"), "item_id")
    counties = F.transform("found", lambda x: x["county"])
    tie, lead = F.when(F.size("found") > 1, tie_break(counties, F.col("anchors"), F.col("hints"))), dominant(F.col("found"))
    single = _only(counties)
    met = met.withColumn("single", single).withColumn("tie", tie).withColumn("lead", lead)
    said = met.where("role = 'prose'").where("single is null or reg_county is null or single = reg_county").where("coalesce(single, tie, lead) is not null")
    told = met.where("role = 'unit'")
    parts = [
        rows(base.where("named_county is not null"), 1, F.col("named_county"), none, "srednja", F.concat(F.lit("k.o. "), F.col("unit"), F.lit(" = županija"))),
        # mentions in prose compete by their place in the text, so steps 2 and 3 share one rank
        rows(said, F.when(F.col("single").isNotNull(), 2).otherwise(3), F.coalesce("single", "tie", "lead"), F.col("name"),
             F.when(F.col("single").isNotNull() | F.col("tie").isNotNull(), "visoka").otherwise("srednja"), F.col("name"), F.col("pos")),
        rows(base.where("reg_county is not null"), 4, F.col("reg_county"), F.col("unit"),
             F.when(free, "srednja").when(agrees(F.col("reg_county")), "visoka").otherwise("niska"), F.coalesce("unit", "code")),
        rows(told.where("single is not null"), 5, F.when(free | agrees(F.col("single")), F.col("single")).otherwise(F.coalesce("land_county", "court_county")),
             F.when(free | agrees(F.col("single")), F.col("name")), F.when(agrees(F.col("single")), "visoka").when(free, "srednja").otherwise("niska"), F.col("name")),
        rows(told.where("single is null and coalesce(tie, lead) is not null"), 6, F.coalesce("tie", "lead"), F.col("name"), F.when(F.col("tie").isNotNull(), "visoka").otherwise("srednja"), F.col("name")),
        rows(base.where("land_county is not null"), 7, F.col("land_county"), F.col("land_town"), "srednja", F.col("land_town")),
        rows(base.where("court_county is not null"), 8, F.col("court_county"), none, "srednja", F.col("issuer")),
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    rank = F.when(F.col("step") == 3, 2).otherwise(F.col("step"))
    best = every.groupBy("item_id").agg(F.min_by(F.struct("county", "name", "grade", "raw", "step"), F.struct(rank, "pos")).alias("b"))
    won = base.select("item_id", "unit", "land_town").join(best, "item_id", "left").select("item_id", "unit", "land_town", "b.*")
    shown = display_names(won.where("name is not null and step <> 7").select("name"), reg)
    won = won.join(shown, "name", "left")
    city = F.when(F.col("step") == 7, F.col("land_town")).when((F.col("step") == 5) & (F.col("grade") == "niska"), F.col("land_town")).otherwise(F.col("display"))
    # a table: callers use it several times, and its plan is long
    return checkpointed(won.select(
        "item_id", "county", city.alias("city"), F.col("unit").alias("cadastral_municipality"), F.coalesce("grade", F.lit("nema")).alias("location_confidence"),
        F.coalesce("raw", "unit", F.lit("")).alias("location_raw"), F.coalesce("step", F.lit(9)).alias("step"),
    ))


def _with_near(units: DataFrame) -> DataFrame:
    """units with near: for one without a county, that of its three nearest units with one, within 12 km, if they agree."""
    known = units.where("county is not null").select(F.col("code").alias("place_id"), "lat", "lon", "county")
    unknown = units.where("county is null").select(F.col("code").alias("point_id"), "lat", "lon")
    voted = unanimous(nearest(unknown, known, 3, 12.0), known.select("place_id", "county"), 3)
    return units.join(voted.select(F.col("point_id").alias("code"), F.col("county").alias("near")), "code", "left")


def points(located: DataFrame, items: DataFrame, reg: Registers, within_km: float = 90.0) -> DataFrame:
    """(item_id, lat, lon, source): the unit of the code, else the only unit of the name, else the only one near its county's centre."""
    place = F.struct("lat", "lon")
    coded = items.select("item_id", unit_code(F.coalesce("text", F.lit(""))).alias("code")).join(reg.units.select("code", place.alias("p")), "code").select("item_id", F.lit(0).alias("rank"), "p")
    named = located.where("cadastral_municipality is not null").select("item_id", "county", fold(bare(F.col("cadastral_municipality"))).alias("k"))
    met = named.join(keyed(reg.units).select("k", "code", place.alias("p")), "k")
    alone = Window.partitionBy("item_id")
    only = met.withColumn("n", F.count(F.lit(1)).over(alone)).where("n = 1").select("item_id", F.lit(1).alias("rank"), "p")
    centre = reg.counties.select("county", F.col("lat").alias("clat"), F.col("lon").alias("clon"))
    near = met.join(centre, "county").where(distance_km(F.col("p")["lat"], F.col("p")["lon"], F.col("clat"), F.col("clon")) <= within_km)
    near = near.withColumn("n", F.count(F.lit(1)).over(alone)).where("n = 1").select("item_id", F.lit(2).alias("rank"), "p")
    best = coded.unionByName(only).unionByName(near).groupBy("item_id").agg(F.min_by("p", "rank").alias("p"), F.min("rank").alias("rank"))
    source = F.element_at(F.array(*map(F.lit, ("matični broj", "naziv", "naziv i županija"))), F.col("rank") + 1)
    return best.select("item_id", "p.lat", "p.lon", source.alias("source"))


def official_county(names: DataFrame, counties: Sequence[str]) -> DataFrame:
    """names with official: the county meant, with or without the word for county."""
    spark = names.sparkSession
    known = spark.createDataFrame([(c,) for c in counties], "official string")
    keys = known.select("official", F.explode(F.array_distinct(F.array(fold(F.col("official")), fold(F.replace("official", F.lit(" županija"), F.lit("")))))).alias("__k"))
    return names.withColumn("__k", fold(F.trim("name"))).join(keys, "__k", "left").drop("__k")
