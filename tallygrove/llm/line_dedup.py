"""Line dedup by site-relative frequency, on DataFrame functions alone.

Pages are grouped by host; pages of a host with equal texts count as one. A line (what
stands between line feeds, trimmed of blanks at both ends) is boilerplate on a host if
at least min_pages of its pages contain it and they are more than max_ratio of the
host's pages. Such lines are dropped from the host's pages; all else, blank lines
included, stays in place. A page copied often on its host is one page, so its own lines
are not taken for boilerplate.

Plan: lines are first counted by 64-bit hashes, each once a page (Spark finds distinct
numbers by hashing, but distinct strings pair by pair), with partial aggregation before
the shuffle. Hashes that exceed the ratio are few by construction, at most
(lines per page) / max_ratio for each host; only their lines are counted again by
text, so lines whose hashes clash are told apart. The lines found are kept as SLOTS short
lists for each host, by the line's hash, so a look-up does not grow with the host's
lists. Pages meet them in a broadcast join when their bytes are below broadcast_bytes,
and otherwise in a join that adaptive execution can split on a hot host; page texts
are never exploded and put together again.

Defined results: null host counts as the empty host, null text as empty (and stays
null in the output); repeated rows are pages with equal texts; a ratio exactly at the
bound is no boilerplate; an empty table gives an empty result; extra columns pass through
drop_boilerplate unchanged, whatever their names, but that input columns named as in
`report` give way to the counts. With report=None nothing is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import fresh, materialise, slim

MAX_RATIO = 0.05
MIN_PAGES = 5
SLOTS = 64
BROADCAST_BYTES = 16 << 20


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    """64 bits of the trimmed line; null for a blank one."""
    line = F.trim(line)
    return F.when(line != "", F.xxhash64(line))


def boilerplate(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, line, pages, host_pages) of the lines that exceed the ratio, from (host, text)."""
    text = F.coalesce("text", F.lit(""))
    same = ("h64", "h32")  # together they tell a host's pages apart
    pages = pages.select(F.coalesce("host", F.lit("")).alias("host"), text.alias("text"), F.xxhash64(text).alias("h64"), F.hash(text).alias("h32"))
    # a table of its own: a join with an aggregate on the same key could not be split on a hot host
    totals = pages.select("host", *same).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    totals = materialise(totals, "host-pages")

    def over(lines: DataFrame, line: str) -> DataFrame:
        counts = lines.distinct().groupBy("host", line).agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
        return counts.join(totals, "host").where(F.col("pages") > max_ratio * F.col("host_pages"))

    keys = F.array_distinct(F.transform(_lines(F.col("text")), _key))
    nominated = over(pages.select("host", F.explode(keys).alias("key"), *same).where("key is not null"), "key").select("host", "key")
    nominated = materialise(nominated, "line-keys")
    each = pages.select("host", F.explode(_lines(F.col("text"))).alias("line"), *same).withColumn("line", F.trim("line"))
    return over(each.withColumn("key", _key(F.col("line"))).join(nominated, ["host", "key"]).select("host", "line", *same), "line")


def _slot(line: Column) -> Column:
    return F.pmod(F.xxhash64(line), F.lit(SLOTS)).cast("int")


def drop_boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
    broadcast_bytes: int = BROADCAST_BYTES,
    report: tuple[str, str] | None = ("n_lines", "n_dropped"),
) -> DataFrame:
    """docs with boilerplate lines cut from text_col, and the counts of lines and of dropped lines named by report."""
    found = materialise(boilerplate(slim(docs, host=host_col, text=text_col), max_ratio, min_pages), "boilerplate")
    lists = found.groupBy("host").agg(F.collect_list("line").alias("all"))
    slots = F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda k: F.filter("all", lambda x: _slot(x) == k))
    key, host_key, drop, kept = (fresh(docs, x) for x in ("key", "host_key", "drop", "kept"))
    sets = lists.select(F.col("host").alias(host_key), slots.alias(drop))
    size = found.agg(F.sum(F.octet_length("line") + F.octet_length("host") + 16)).first()[0] or 0
    if size <= broadcast_bytes:
        sets = F.broadcast(sets)
    text = F.col(f"`{text_col}`")
    met = docs.withColumn(key, F.coalesce(F.col(f"`{host_col}`"), F.lit(""))).join(sets, F.col(key) == F.col(host_key), "left")
    stays = lambda x: ~F.array_contains(F.get(F.col(drop), _slot(F.trim(x))), F.trim(x))
    met = met.withColumn(kept, F.when(F.col(drop).isNull(), _lines(text)).otherwise(F.filter(_lines(text), stays)))
    n_lines, n_kept = F.size(_lines(text)).cast("long"), F.size(kept).cast("long")
    cut = F.when(text.isNotNull(), F.when(n_lines > n_kept, F.array_join(kept, "\n")).otherwise(text))
    made = {text_col: cut} | ({report[0]: n_lines, report[1]: n_lines - n_kept} if report else {})
    columns = [made.pop(c).alias(c) if c in made else F.col(f"`{c}`") for c in docs.columns]
    return met.select(*columns, *(c.alias(name) for name, c in made.items()))
