"""Sources and sinks of full daily snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrove.functions import text
from tallygrove.operators.checkpoints import checkpointed
from tallygrove.operators.linking import first_by_key


def read_snapshot(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A semicolon CSV of quoted, possibly multi-line fields, all as text, without blank rows; row_ord keeps the order."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.options(sep=";", header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8").schema(schema).csv(path)
    trimmed = raw.select(*(F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in columns))
    filled = trimmed.where(F.length(F.concat_ws("", *(F.col(f"`{c}`") for c in columns))) > 0)
    return filled.withColumn("row_ord", F.monotonically_increasing_id())


def source_meta(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, sha256 of each file."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("modified"))


def guard_snapshot(meta: DataFrame, rows: DataFrame, least_bytes: int = 1_000_000, least_rows: int = 500) -> DataFrame:
    """(check, ok): floors below which a snapshot is refused."""
    size = meta.agg((F.coalesce(F.sum("bytes"), F.lit(0)) >= least_bytes).alias("ok")).select(F.lit("bytes").alias("check"), "ok")
    count = rows.agg((F.count(F.lit(1)) >= least_rows).alias("ok")).select(F.lit("rows").alias("check"), "ok")
    return size.unionByName(count)


def snapshot_date(rows: DataFrame, column: str) -> DataFrame:
    """The first filled value of a column, in row order."""
    return rows.where(F.col(column) != "").agg(F.min_by(column, "row_ord").alias("snapshot_date"))


def read_register(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A reference register: semicolon CSV with typed columns."""
    return spark.read.options(sep=";", header=True).schema(", ".join(f"`{k}` {v}" for k, v in columns.items())).csv(path)


def read_html(spark: SparkSession, path: str) -> DataFrame:
    """All HTML files below a folder: path, html."""
    files = spark.read.option("pathGlobFilter", "*.html").text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))


def append_log(rows: DataFrame, path: str, run_id: int) -> None:
    """A run's rows in a log partitioned by run: other runs stay, this one's rows replace what an earlier attempt left."""
    out = rows.withColumn("run_id", F.lit(run_id))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def write_search_index(records: DataFrame, path: str) -> None:
    """The client's search index as JSON lines."""
    records.write.mode("overwrite").json(path)


def feed_items(items: DataFrame, published: str = "publish_start", n: int = 50) -> DataFrame:
    """The newest n decorated items as feed entries: (place, url, entry), the newest at place 1.

    An entry has title (with the price), link, guid, date and a description of the type,
    county, discount and end, as far as the item has them.
    """
    newest = items.where(F.col(published).isNotNull()).orderBy(F.desc(published), "url").limit(n)
    price = F.when(F.coalesce("opening_price_eur", F.lit(0)) != 0, text.format_eur(F.col("opening_price_eur")))
    sound = F.col("discount_pct").isNotNull() & ~F.coalesce("discount_suspicious", F.lit(False))
    told = F.concat_ws(
        " · ",
        F.nullif("type_label", F.lit("")),
        F.nullif("county", F.lit("")),
        F.when(sound, F.concat(text.format_pct(F.col("discount_pct")), F.lit(" ispod procjene"))),
        F.when(F.col("auction_end").isNotNull(), F.concat(F.lit("nadmetanje do "), text.format_date(F.col("auction_end")))),
    )
    link = text.xml_escape(F.col("url"))
    parts = [
        ("<item><title>", text.xml_escape(F.concat_ws(", ", "card_title", price))), ("</title><link>", link), ('</link><guid isPermaLink="true">', link),
        ("</guid><pubDate>", F.date_format(published, "EEE, dd MMM yyyy HH:mm:ss")), (" +0100</pubDate><description>", text.xml_escape(told)),
    ]
    entry = F.concat(*(x for before, value in parts for x in (F.lit(before), value)), F.lit("</description></item>"))
    return newest.select(F.row_number().over(Window.orderBy(F.desc(published), "url")).alias("place"), "url", entry.alias("entry"))  # n rows


def write_feed(items: DataFrame, path: str, title: str, site: str, description: str, published: str = "publish_start", n: int = 50) -> None:
    """A feed of the newest n items, newest first, as one text file; urls are made absolute."""
    found = feed_items(items.withColumn("url", F.concat(F.lit(site), F.col("url"))), published, n).orderBy("place").collect()  # n rows
    safe = lambda x: x.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    head = f'<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0"><channel><title>{safe(title)}</title><link>{safe(site)}/</link><description>{safe(description)}</description><language>hr</language>'
    _put(items.sparkSession, path, head + "".join(r["entry"] for r in found) + "</channel></rss>\n")


#: Urls in one file of a site map, as its protocol bounds them.
MOST_URLS = 50_000


def numbered_pages(pages: DataFrame, order: str = "row_ord", most: int = MOST_URLS) -> DataFrame:
    """(path, changefreq, priority, n, shard): each path once, by its first row, numbered from 0 in that order; `most` of them to a shard.

    Rows are dealt by ranges of the order and numbered within them, and the counts of the
    ranges before are added, so no task sees all.
    """
    first = first_by_key(pages.select("path", "changefreq", "priority", order), ["path"], [F.col(order)])
    dealt = checkpointed(first.repartitionByRange(F.col(order), F.col("path")).withColumn("__part", F.spark_partition_id()))
    sizes = {r["__part"]: r["count"] for r in dealt.groupBy("__part").count().collect()}  # a row for each partition
    before, total = [], 0
    for part, size in sorted(sizes.items()):
        before += [F.lit(part), F.lit(total)]
        total += size
    shift = F.create_map(*before)[F.col("__part")] if before else F.lit(0)
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(order, "path")) - 1
    n = dealt.withColumn("n", (inside + shift).cast("long"))
    return n.select("path", "changefreq", "priority", "n", F.floor(F.col("n") / most).cast("int").alias("shard"))


def sitemap_entry(site: str, lastmod: str) -> Column:
    url = text.xml_escape(F.concat(F.lit(site), F.col("path")))
    return F.concat(F.lit("  <url><loc>"), url, F.lit(f"</loc><lastmod>{lastmod}</lastmod><changefreq>"), F.col("changefreq"), F.lit("</changefreq><priority>"), F.format_number(F.col("priority"), 1), F.lit("</priority></url>"))


_URLSET = '<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'


def write_sitemap(pages: DataFrame, folder: str, site: str, lastmod: str, order: str = "row_ord", most: int = MOST_URLS) -> int:
    """Site map and robots.txt: sitemap.xml, or an index of that name over sitemap-0.xml, sitemap-1.xml, ... of `most` urls each; returns their number.

    Executors write a file for each shard; the driver only names them.
    """
    spark = pages.sparkSession
    lines = numbered_pages(pages, order, most).select("shard", "n", sitemap_entry(site, lastmod).alias("line"))
    whole = lines.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("e"))  # `most` short lines each
    body = whole.select("shard", F.concat(F.lit(_URLSET + "\n"), F.array_join(F.transform("e", lambda x: x["line"]), "\n"), F.lit("\n</urlset>")).alias("value"))
    made = f"{folder}/_shards"
    body.repartition("shard").write.mode("overwrite").partitionBy("shard").text(made)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = hadoop.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted((int(s.getPath().getParent().getName().partition("=")[2]), s.getPath()) for s in files.globStatus(hadoop.Path(f"{made}/shard=*/part-*")))
    names = ["sitemap.xml"] if len(found) == 1 else [f"sitemap-{k}.xml" for k, _ in found]
    for name, (_, at) in zip(names, found):
        files.delete(hadoop.Path(f"{folder}/{name}"), False)
        files.rename(at, hadoop.Path(f"{folder}/{name}"))
    files.delete(hadoop.Path(made), True)
    if not found:
        _put(spark, f"{folder}/sitemap.xml", _URLSET + "\n</urlset>")
    elif len(found) > 1:
        index = _URLSET.replace("urlset", "sitemapindex") + "".join(f"\n  <sitemap><loc>{site}/{n}</loc><lastmod>{lastmod}</lastmod></sitemap>" for n in names) + "\n</sitemapindex>"
        _put(spark, f"{folder}/sitemap.xml", index)
    _put(spark, f"{folder}/robots.txt", f"User-agent: *\nAllow: /\n\nSitemap: {site}/sitemap.xml\n")
    return len(found)


def _put(spark: SparkSession, path: str, content: str) -> None:
    """A small text file in place of any other."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    stream.write(bytearray(content.encode()))
    stream.close()


def written_once(pages: DataFrame, path: str = "path") -> DataFrame:
    """pages, with an assertion in the plan: writing them fails, naming the path, if two have the same one."""
    twice = pages.groupBy(F.col(path).alias("__path")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    met = pages.join(twice, F.col(path).eqNullSafe(F.col("__path")), "left")
    message = F.concat(F.col("__n").cast("string"), F.lit(" pages write to the same path: "), F.coalesce(path, F.lit("null")))
    return met.where(F.when(F.col("__n").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))).drop("__path", "__n")


def reread(spark: SparkSession, path: str, columns: Sequence[str]) -> tuple[DataFrame, str | None]:
    """A snapshot read anew from its file, apart from the run's own frames, and its date column's first value: what validation compares with."""
    rows = read_snapshot(spark, path, columns)
    dated = snapshot_date(rows, "Stanje na dan").first() if "Stanje na dan" in columns else None
    return rows, dated["snapshot_date"] if dated else None


def read_photos(spark: SparkSession, path: str) -> DataFrame:
    """The photo manifest, one JSON object of objects: (key, photo), photo a map of texts."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("key", "photo"))


def newest_first(*lists: DataFrame, date: str, key: str) -> DataFrame:
    """Several lists of posts as one, the newest first."""
    out = lists[0]
    for more in lists[1:]:
        out = out.unionByName(more)
    return out.orderBy(F.desc(date), key)
