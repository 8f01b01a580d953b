"""Grouped statistics, rankings, listings, search and checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.functions.parse import round_half_up
from tallygrove.functions.text import fold


def stats_by(df: DataFrame, *keys: Column | str, price: Column, discount: Column, running: Column) -> DataFrame:
    """Count, running count, average discount (NULL if none) and least price, for each group."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(running).alias("n_running"),
        round_half_up(F.avg(discount.cast("double"))).cast("double").alias("avg_discount"),
        F.min(F.when(price != 0, price)).alias("min_price"),
    )


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, filled, total): one pass over the table for all columns."""
    counts = [F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).alias(c) for c in columns]
    wide = df.agg(F.count(F.lit(1)).alias("total"), *counts)
    return wide.unpivot("total", list(columns), "column", "filled").select("column", "filled", "total")


def top_by_group(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of each group; Spark limits each task to n a group before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= n)


def most_common(df: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """The n most frequent values of each group; counts first, so only values are ranked."""
    return top_by_group(df.groupBy(group, value).agg(F.count(F.lit(1)).alias("cnt")), group, [F.desc("cnt"), F.col(value)], n)


def related(df: DataFrame, key: str, group: str, n: int) -> DataFrame:
    """(key, related, place): the first n others of the same group (missing groups belong together).

    The first n + 1 keys of each group are enough for all its members, so nothing
    grows with the square of a group.
    """
    heads = top_by_group(df.select(F.col(key).alias("other"), F.col(group).alias("g")), "g", [F.col("other")], n + 1)
    met = df.select(key, F.col(group).alias("g0")).join(heads, F.col("g0").eqNullSafe(F.col("g")))
    met = met.where(F.col(key) != F.col("other"))
    heads_of = met.groupBy(key).agg(F.slice(F.sort_array(F.collect_list("other")), 1, n).alias("r"))
    return heads_of.select(key, F.posexplode("r").alias("p", "related")).select(key, "related", (F.col("p") + 1).alias("place"))


def unique_titles(df: DataFrame, title: str, second: str, key: str) -> DataFrame:
    """Titles made unique: a repeated one takes the second column, and if still repeated its key.

    Repeated titles are counted with partial sums and joined back, so a common title is
    not collected in one task.
    """

    def longer(df: DataFrame, name: str, now: str, more: Column, sign: str) -> DataFrame:
        repeated = df.groupBy(F.col(now).alias("__k")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__k", F.lit(True).alias("__again"))
        met = df.join(repeated, F.col(now).eqNullSafe(F.col("__k")), "left")
        return met.withColumn(name, F.when(F.col("__again"), F.concat_ws(sign, now, more)).otherwise(F.col(now))).drop("__k", "__again")

    out = longer(df, "__t", title, F.nullif(F.col(second).cast("string"), F.lit("")), " · ")
    return longer(out, "unique_title", "__t", F.col(key).cast("string"), " / ").drop("__t")


def search(df: DataFrame, columns: Sequence[str], terms: str, order: Sequence[Column], n: int = 60) -> DataFrame:
    """Rows in whose folded columns all folded terms stand, the first n."""
    hay = fold(F.concat_ws(" ", *columns))
    hit = F.lit(True)
    for term in terms.split():
        hit = hit & F.contains(hay, fold(F.lit(term)))
    return df.where(hit).orderBy(*order).limit(n)


def listing_filter(df: DataFrame, **bounds) -> DataFrame:
    """A listing's conjunction: <column>__in, __min, __max or plain equality; a missing number fails a bound."""
    for name, value in bounds.items():
        if value is None:
            continue
        column, _, kind = name.partition("__")
        c = F.col(column)
        df = df.where(c.isin(*value) if kind == "in" else c >= value if kind == "min" else c <= value if kind == "max" else c == value)
    return df


def sort_for_display(df: DataFrame, status: str, discount: str, key: str, statuses: Sequence[str]) -> DataFrame:
    """By status in the given order, then discount from the top (a missing one counts as -1), then key."""
    place = F.array_position(F.array(*map(F.lit, statuses)), F.col(status))
    return df.orderBy(F.when(place == 0, len(statuses) + 1).otherwise(place), F.coalesce(F.col(discount), F.lit(-1)).desc(), key)


def sort_listing(df: DataFrame, column: str, descending: bool, key: str) -> DataFrame:
    """A listing by one of its columns, missing values last in either direction, then by key."""
    c = F.col(column)
    return df.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last(), key)


def stubborn_groups(df: DataFrame, group: str, seq: str, price: str, status: str, key: str, n: int = 8) -> DataFrame:
    """The n groups with most attempts, three at least: attempts, drop of the first to the last price in percent, first member not finished."""
    priced = F.when(F.col(price) != 0, F.col(price))
    place = F.struct(seq, key)
    got = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(price, F.when(priced.isNotNull(), place)).alias("first_price"),
        F.max_by(price, F.when(priced.isNotNull(), place)).alias("last_price"),
        F.min_by(key, F.when(F.col(status) != "zavrseno", place)).alias("live"),
    )
    drop = F.when((F.col("first_price") > F.col("last_price")) & (F.col("last_price") > 0), round_half_up((1 - F.col("last_price") / F.col("first_price")) * 100, 0).cast("int"))
    return got.where("n >= 3").withColumn("drop_pct", drop).orderBy(F.desc("n"), group).limit(n).select(group, "n", "drop_pct", "live")


def by_point(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Items of one point with the radius of its mark."""
    n = df.groupBy(lat, lon).agg(F.count(F.lit(1)).alias("n"))
    top = n.agg(F.max("n").alias("top"))
    return n.crossJoin(F.broadcast(top)).select(lat, lon, "n", round_half_up(5 + 11 * F.sqrt(F.col("n") / F.col("top")), 3).cast("double").alias("radius"))


def with_members(df: DataFrame, group: str, order: Sequence[str], key: str) -> DataFrame:
    """df with members: the keys of its group in order, for groups of two and more."""
    got = df.groupBy(group).agg(F.sort_array(F.collect_list(F.struct(*order, F.col(key).alias("__key")))).alias("__all")).where(F.size("__all") > 1)
    return df.join(got.select(group, F.transform("__all", lambda x: x["__key"]).alias("members")), group)


def duplicates(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def exact_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, median): exact, without holding a group's values in one buffer.

    A sketch with a rank error of one in 10,000 gives two values that enclose the median;
    only values between them, some fiftieth of all, are ranked, below them rows are counted.
    """
    known = df.where(F.col(value).isNotNull()).select(group, value)
    bounds = known.groupBy(group).agg(F.count(F.lit(1)).alias("__n"), F.percentile_approx(value, [0.49, 0.51], 10_000).alias("__b"))
    met = known.join(bounds.withColumnRenamed(group, "__g"), F.col(group).eqNullSafe(F.col("__g"))).drop("__g")
    low, high = F.element_at("__b", 1), F.element_at("__b", 2)
    below = met.groupBy(group).agg(F.count_if(F.col(value) < low).alias("__below"), F.first("__n").alias("__n"))
    middle = met.where(F.col(value).between(low, high)).groupBy(group, value).agg(F.count(F.lit(1)).alias("__c"))
    upto = F.sum("__c").over(Window.partitionBy(group).orderBy(value))
    placed = middle.withColumn("__upto", upto).join(below.withColumnRenamed(group, "__g"), F.col(group).eqNullSafe(F.col("__g"))).drop("__g")
    at = lambda k: F.min(F.when(F.col("__below") + F.col("__upto") >= k, F.col(value)))
    two = placed.groupBy(group).agg(at(F.floor((F.col("__n") + 1) / 2)).alias("a"), at(F.floor(F.col("__n") / 2) + 1).alias("b"))
    return two.select(group, ((F.col("a") + F.col("b")) / 2).alias("median"))


def html_lint(pages: DataFrame) -> DataFrame:
    """Checks of each page's head and body; bad_json_ld counts blocks that do not parse or lack @context or @type."""
    h = F.coalesce("html", F.lit(""))
    blocks = F.regexp_extract_all(h, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    sound = lambda b: F.get_json_object(b, "$.@context").isNotNull() & F.get_json_object(b, "$.@type").isNotNull()
    return pages.select(
        "page_id",
        (F.trim(F.regexp_extract(h, r"(?is)<title[^>]*>(.*?)</title>", 1)) != "").alias("has_title"),
        (F.length(F.regexp_extract(h, r"(?is)<meta[^>]*name=.description.[^>]*content=.([^\"']*)", 1)) >= 40).alias("has_meta"),
        h.rlike(r"(?is)<link[^>]*rel=.canonical").alias("has_canonical"),
        F.regexp_count(h, F.lit(r"(?i)<h1[\s>]")).cast("long").alias("n_h1"),
        h.rlike(r"(?is)<script[^>]*application/ld\+json").alias("has_json_ld"),
        F.size(F.filter(blocks, lambda b: ~F.coalesce(sound(b), F.lit(False)))).cast("long").alias("bad_json_ld"),
    )


def visible_text(html: Column) -> Column:
    """Text without scripts, styles and tags."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<script.*?</script>|<style.*?</style>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "(?s)<[^>]*>", " "), r"[ \t\r\n]+", " "))


def checks_report(checks: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(name, violations, status): each check is a frame of violating rows, none of which leaves the executors."""
    out = None
    for name, bad in checks:
        row = bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("name"), "violations")
        out = row if out is None else out.unionByName(row)
    return out.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))
