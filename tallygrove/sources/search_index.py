"""A search index on disk: postings of trigrams, and the items they lead to.

Each item's searched columns are folded into one text. Its runs of three characters, with a
blank before and after the text, are postings (gram, doc), dealt to buckets by the gram's
hash, so a look-up of a gram reads one bucket's files and in them the row groups that hold
it. A term of three letters and more stands in an item only if all the term's grams do; the
term's rarest gram gives candidates. A shorter term stands in every text that has a gram
around it, and the grams are few. Candidates are confirmed by the term itself on the stored
texts, which are read for their buckets only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrove.functions import text

BUCKETS = 64
#: Items for one share of a bucket: at some thirty grams an item, half a million postings a share and bucket.
SHARE = 1_000_000


def fold_terms(spark: SparkSession, terms: str) -> list[str]:
    """The folded terms of a search, by the same function as the texts."""
    row = spark.range(1).select(F.split(F.trim(text.fold_keeping(F.lit(terms))), r"\s+").alias("t")).first()
    return [t for t in row["t"] if t]


def _grams(folded: Column) -> Column:
    padded = F.concat(F.lit(" "), folded, F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(padded) - 2, F.lit(1))), lambda i: F.substring(padded, i, F.lit(3)))


def _bucket(c: Column) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")


def _shares(stored: DataFrame) -> int:
    """Into how many a bucket's postings are dealt: one for each SHARE items, so a small index has few files and a large one many tasks."""
    return max(1, -(-stored.count() // SHARE))


def build(items: DataFrame, path: str, key: str, searched: Sequence[str]) -> None:
    """Write the index of items: grams with their numbers of items, postings, and the items with their folded text."""
    rows = items.withColumn("hay", text.fold_keeping(F.concat_ws(" | ", *searched))).withColumn("part", _bucket(F.col(key)))
    # dealt by bucket and sorted by what is looked up, so that files' statistics tell where it is
    rows.repartition(F.col("part")).sortWithinPartitions("part", key).write.mode("overwrite").partitionBy("part").parquet(f"{path}/items")
    stored = items.sparkSession.read.parquet(f"{path}/items")
    # an item's grams are told apart in its row; the deal has a part's postings in few files, as many as they need
    own = stored.select(F.col(key).alias("doc"), F.explode(F.array_distinct(_grams(F.col("hay")))).alias("gram"))
    own = own.withColumn("part", _bucket(F.col("gram")))
    own = own.withColumn("share", F.pmod(F.xxhash64("doc"), F.lit(_shares(stored))).cast("int"))
    # rows that share a key lie in one partition, so the exchange serves the grouping as well
    own = own.repartition(F.col("part"), F.col("share")).dropDuplicates(["part", "share", "gram", "doc"]).drop("share")
    own.sortWithinPartitions("part", "gram", "doc").write.mode("overwrite").partitionBy("part").parquet(f"{path}/postings")
    posted = items.sparkSession.read.parquet(f"{path}/postings")
    posted.groupBy("part", "gram").agg(F.count(F.lit(1)).alias("items")).repartition(1, "part").sortWithinPartitions("part", "gram").write.mode("overwrite").partitionBy("part").parquet(f"{path}/grams")


def _looked_up(postings: DataFrame, grams: Sequence[str], known: DataFrame) -> DataFrame:
    """Postings of some grams, from their buckets only."""
    parts = [r["part"] for r in known.where(F.col("gram").isin(*grams)).select("part").distinct().collect()]
    return postings.where(F.col("part").isin(*parts) & F.col("gram").isin(*grams))


def candidates(spark: SparkSession, path: str, folded: Sequence[str]) -> DataFrame | None:
    """(doc) of items that may have all terms; None if a term has no candidate at all."""
    known, postings = spark.read.parquet(f"{path}/grams"), spark.read.parquet(f"{path}/postings")
    found = []
    for term in folded:
        if len(term) < 3:  # of all different grams, those around the term
            grams = [r["gram"] for r in known.where(F.contains("gram", F.lit(term))).select("gram").collect()]
        else:
            own = sorted({term[i : i + 3] for i in range(len(term) - 2)})
            counts = {r["gram"]: r["items"] for r in known.where(F.col("gram").isin(*own)).collect()}
            grams = [min(own, key=lambda g: (counts[g], g))] if len(counts) == len(own) else []
        if not grams:
            return None
        found.append(_looked_up(postings, grams, known).select("doc").distinct())
    return reduce(lambda a, b: a.join(b, "doc", "left_semi"), found)


def search(spark: SparkSession, path: str, key: str, terms: str, order: Sequence[Column], n: int = 60) -> DataFrame:
    """Items in whose text all terms stand, the first n in order, with the items' columns."""
    items = spark.read.parquet(f"{path}/items")
    folded = fold_terms(spark, terms)
    hit = reduce(lambda a, b: a & b, (F.contains("hay", F.lit(t)) for t in folded), F.lit(True))
    if folded:
        some = candidates(spark, path, folded)
        if some is None:
            items = items.limit(0)
        else:  # the bucket is part of the key, so only buckets with candidates are read
            some = some.select(F.col("doc").alias(key), _bucket(F.col("doc")).alias("part"))
            items = items.join(some, ["part", key], "left_semi")
    return items.where(hit).orderBy(*order).limit(n).drop("hay", "part")


def projection(items: DataFrame, names: Mapping[str, str | Column]) -> DataFrame:
    """Records of the client's index: short keys with their columns; values that are missing stay out of the JSON."""
    return items.select(*((F.col(c) if isinstance(c, str) else c).alias(k) for k, c in names.items()))


def client_record() -> dict[str, Column]:
    """The record of the client's index for a decorated item: texts as shown, then raw values for filters and sorting."""
    filled = lambda c, shown: F.when(F.coalesce(F.col(c), F.lit(0)) != 0, shown)
    text_of = lambda c: F.coalesce(F.col(c), F.lit(""))
    sound = F.col("discount_pct").isNotNull() & ~F.coalesce("discount_suspicious", F.lit(False))
    shown = {
        "n": F.col("card_title"), "u": F.col("url"), "g": text_of("city"), "z": text_of("county"), "k": text_of("cadastral_municipality"),
        "r": text_of("case_ref"), "i": text_of("auction_id"), "t": text_of("type_label"), "s": text_of("status_label"),
        "p": F.coalesce(filled("opening_price_eur", text.format_eur(F.col("opening_price_eur"))), F.lit("")),
        "d": F.when(sound, text.format_pct_plain(F.col("discount_pct"))).otherwise(""),
        "a": F.coalesce(filled("area_m2", text.format_area(F.col("area_m2"))), F.lit("")),
        "e": F.when(F.col("auction_end").isNotNull(), text.format_date(F.col("auction_end"))).otherwise(""),
        "pm": F.coalesce(filled("price_per_m2", text.format_ppm(F.col("price_per_m2"))), F.lit("")), "dl": F.col("days_left"),
    }
    county, city = (F.coalesce(F.nullif(text.slugify(F.col(c)), F.lit("")), F.lit(none)) for c, none in (("county", "nepoznata-lokacija"), ("city", "ostalo")))
    raw = {
        "ty": text_of("property_type"), "sk": text_of("status"), "pk": text_of("procedure_type"), "zs": county, "gs": city,
        "pn": filled("opening_price_eur", F.col("opening_price_eur").cast("double")), "an": filled("area_m2", F.col("area_m2").cast("double")),
        "dn": F.when(sound, F.col("discount_pct").cast("double")), "mn": F.col("price_per_m2"), "ei": F.coalesce(F.date_format("auction_end", "yyyy-MM-dd"), F.lit("")),
        "lt": filled("latitude", F.col("latitude").cast("double")), "ln": filled("longitude", F.col("longitude").cast("double")),
    }
    return shown | raw
