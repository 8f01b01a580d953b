"""Registers that are small and fixed: counties with their centres, declined and other forms of towns' names, names of several places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.functions.text import fold

# The counties and about where their middle is.
COUNTIES = {
    "Grad Zagreb": (45.815, 15.98), "Zagrebačka županija": (45.85, 16.10), "Krapinsko-zagorska županija": (46.10, 15.87), "Sisačko-moslavačka županija": (45.35, 16.55), "Karlovačka županija": (45.30, 15.55),
    "Varaždinska županija": (46.25, 16.25), "Koprivničko-križevačka županija": (46.10, 16.75), "Bjelovarsko-bilogorska županija": (45.85, 16.95), "Primorsko-goranska županija": (45.35, 14.55),
    "Ličko-senjska županija": (44.75, 15.30), "Virovitičko-podravska županija": (45.75, 17.55), "Požeško-slavonska županija": (45.35, 17.75), "Brodsko-posavska županija": (45.15, 17.85),
    "Zadarska županija": (44.10, 15.55), "Osječko-baranjska županija": (45.55, 18.55), "Šibensko-kninska županija": (43.85, 16.05), "Vukovarsko-srijemska županija": (45.20, 18.85),
    "Splitsko-dalmatinska županija": (43.55, 16.55), "Istarska županija": (45.15, 13.85), "Dubrovačko-neretvanska županija": (42.85, 17.65), "Međimurska županija": (46.40, 16.45),
}
# Forms of towns' names in the locative, folded, and the town.
LOCATIVES = {
    "rijeci": "Rijeka", "splitu": "Split", "zagrebu": "Zagreb", "osijeku": "Osijek", "zadru": "Zadar", "puli": "Pula", "sibeniku": "Šibenik", "dubrovniku": "Dubrovnik", "karlovcu": "Karlovac", "varazdinu": "Varaždin",
    "sisku": "Sisak", "bjelovaru": "Bjelovar", "koprivnici": "Koprivnica", "cakovcu": "Čakovec", "pozegi": "Požega", "vinkovcima": "Vinkovci", "vukovaru": "Vukovar", "gospicu": "Gospić", "virovitici": "Virovitica",
    "pazinu": "Pazin", "porecu": "Poreč", "rovinju": "Rovinj", "umagu": "Umag", "labinu": "Labin", "makarskoj": "Makarska", "sinju": "Sinj", "trogiru": "Trogir", "solinu": "Solin", "omisu": "Omiš", "kastelima": "Kaštela",
    "krku": "Krk", "rabu": "Rab", "opatiji": "Opatija", "crikvenici": "Crikvenica", "kninu": "Knin", "drnisu": "Drniš", "metkovicu": "Metković", "korculi": "Korčula", "slavonskom brodu": "Slavonski Brod",
    "novoj gradiski": "Nova Gradiška", "velikoj gorici": "Velika Gorica", "samoboru": "Samobor", "zapresicu": "Zaprešić", "kutini": "Kutina", "petrinji": "Petrinja", "ogulinu": "Ogulin", "djakovu": "Đakovo",
    "dakovu": "Đakovo", "nasicama": "Našice", "belišću": "Belišće", "belom manastiru": "Beli Manastir", "valpovu": "Valpovo", "zupanji": "Županja", "ilok": "Ilok", "prelogu": "Prelog", "senju": "Senj",
    "otoccu": "Otočac", "novalji": "Novalja", "benkovcu": "Benkovac", "biogradu": "Biograd na Moru", "vodicama": "Vodice", "plocama": "Ploče",
}
# Other names of towns, and names that several counties have.
CANONICAL = {
    "Ivanić Grad": "Ivanić-Grad", "Pola": "Pula", "Parenzo": "Poreč", "Rovigno": "Rovinj", "Buie": "Buje", "Umago": "Umag", "Cittanova": "Novigrad", "Dignano": "Vodnjan", "Sveta Nedjelja": "Sveta Nedelja",
    "Novi Zagreb": "Zagreb", "Sesvete": "Zagreb",
}
AMBIGUOUS = ["Novigrad", "Otok", "Sveta Nedelja", "Sveta Nedjelja", "Privlaka", "Luka", "Blato", "Dubrava", "Orehovica", "Stari Grad", "Bistra", "Nova Bukovica"]


def counties(spark: SparkSession) -> DataFrame:
    """county, lat, lon"""
    return spark.createDataFrame([(c, *at) for c, at in COUNTIES.items()], "county string, lat double, lon double")


def town_forms(towns: DataFrame, ambiguous: Sequence[str] = tuple(AMBIGUOUS)) -> DataFrame:
    """(form, town, county) of towns (town, county): each town's own name, the forms in LOCATIVES, and other names, which lead to the one that CANONICAL gives.

    A form that is a town's name already stays that town's. Ambiguous names have no county.
    """
    spark = towns.sparkSession
    one = spark.createDataFrame(list(CANONICAL.items()), "__other string, __town string")
    # a name of a town that has another one is that town
    known = towns.join(F.broadcast(one), F.col("town") == F.col("__other"), "left").select(F.col("town").alias("form"), F.coalesce("__town", "town").alias("town"), "county")
    declined = spark.createDataFrame(list(LOCATIVES.items()), "form string, __of string")
    lesser = declined.join(known.select("form", "town", "county").withColumnRenamed("form", "__of"), "__of").select("form", "town", "county")
    taken = known.select(fold(F.col("form")).alias("k"))
    every = known.unionByName(lesser.join(taken, fold(F.col("form")) == F.col("k"), "left_anti"))
    doubtful = spark.createDataFrame([(a,) for a in ambiguous], "a string").select(fold(F.col("a")).alias("a"))
    met = every.join(F.broadcast(doubtful), fold(F.col("town")) == F.col("a"), "left")
    return met.select("form", "town", F.when(F.col("a").isNull(), F.col("county")).alias("county")).distinct()
