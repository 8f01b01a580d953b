"""State versions and logs, the twelve checks with planted faults, register build and proposals."""

import datetime as dt
import hashlib
import random
import re
import threading
import xml.etree.ElementTree
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallygrove.functions import parse
from tallygrove.operators import cascade, items, linking, location, marts, proposals, validation
from tallygrove.sources import registers, snapshot, state


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_versions(spark, tmp_path):
    root = f"file://{tmp_path}/state"
    assert state.read_items(spark, root) is None and state.runs(spark, root).collect() == []
    batch = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "item_key string, price double")
    assert state.upsert(spark, root, batch, "item_key", F.lit(1)) == 1
    assert state.upsert(spark, root, batch.where("item_key = 'a'").withColumn("price", F.lit(5.0)), "item_key", F.lit(2)) == 2
    got = rows(state.read_items(spark, root))
    assert got == [("a", 5.0, 1, 2, 2), ("b", 2.0, 1, 1, 1)]

    @F.udf("double")
    def broken(x):
        raise ValueError("lost")

    with pytest.raises(Exception, match="lost"):
        state.upsert(spark, root, batch.withColumn("price", broken("price")), "item_key", F.lit(3))
    assert rows(state.read_items(spark, root)) == got and state.current_version(spark, root)[0] == 2
    assert rows(state.read_items(spark, root, where="price > 4", columns=["item_key"])) == [("a",)]
    now = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    assert [state.log_run(spark, root, {"sha256": x, "rows": 2}, now, now, {"n": 1}) for x in "xy"] == [1, 2]
    assert validation.distinct_sources(state.runs(spark, root)).first()[0] == 2
    today = spark.createDataFrame([("b",), ("c",)], "item_key string")
    assert rows(state.keys_common(today.unionByName(today), state.read_items(spark, root), "item_key")) == [("b",)]
    assert rows(state.keys_compared(today, state.read_items(spark, root), "item_key")) == [("a", "retained"), ("c", "missing")]


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    """Both have read the same version when both commit: one is overtaken, merges anew, and neither batch is lost."""
    root = f"file://{tmp_path}/state"
    frame = lambda *keys: spark.createDataFrame([(k, 1.0) for k in keys], "item_key string, price double")
    state.upsert(spark, root, frame("a"), "item_key", F.lit(1))
    both, plain, met = threading.Barrier(2, timeout=60), state.put_if_absent, threading.local()

    def together(spark, path, text):
        if not getattr(met, "once", False):
            met.once = True
            both.wait()
        return plain(spark, path, text)

    monkeypatch.setattr(state, "put_if_absent", together)
    with ThreadPoolExecutor(2) as pool:
        got = list(pool.map(lambda k: state.upsert(spark, root, frame("a", k), "item_key", F.lit(2)), "bc"))
    assert sorted(got) == [2, 3]
    assert rows(state.read_items(spark, root).select("item_key", "times_seen")) == [("a", 3), ("b", 1), ("c", 1)]
    now = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    met = threading.local()
    with ThreadPoolExecutor(2) as pool:
        assert sorted(pool.map(lambda k: state.log_run(spark, root, {"sha256": k}, now, now), "bc")) == [1, 2]
    assert rows(state.runs(spark, root).select("run_id")) == [(1,), (2,)]
    assert len(list((tmp_path / "state/items").iterdir())) == 3 and not list((tmp_path / "state/commits").glob(".*.json.*"))


def test_overtaken_for_good(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/state"
    monkeypatch.setattr(state, "put_if_absent", lambda *x: False)
    with pytest.raises(state.Conflict):
        state.upsert(spark, root, spark.createDataFrame([("a",)], "item_key string"), "item_key", F.lit(1), attempts=2)
    assert state.read_items(spark, root) is None


def test_put_if_absent(spark, tmp_path):
    at = f"file://{tmp_path}/deep/x.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: state.put_if_absent(spark, at, str(k) * 100), range(8)))
    assert won.count(True) == 1
    assert (tmp_path / "deep/x.json").read_text() == str(won.index(True)) * 100


def test_logs_are_typed(spark, tmp_path):
    root = f"file://{tmp_path}/state"
    state.init_schema(spark, root)
    state.init_schema(spark, root)
    assert state.table_counts(spark, root) == {"items": 0, "price_history": 0, "item_events": 0}
    change = spark.createDataFrame([("a", "2024-01-01", "opening_price_eur", "5.00", "4.5", -10.0, "more")], "item_key string, snapshot_date string, field string, old_value string, new_value string, pct_change double, extra string")
    state.record(change, root, "price_history", 1)
    state.record(change, root, "price_history", 2)
    state.record(change, root, "price_history", 2)
    assert rows(state.read_log(spark, root, "price_history")) == [("a", dt.date(2024, 1, 1), "opening_price_eur", Decimal("5.00"), Decimal("4.50"), Decimal("-10.00"), k) for k in (1, 2)]
    with pytest.raises(Exception, match="reason"):
        state.record(change, root, "unresolved_locations", 1)
    assert state.table_counts(spark, root)["price_history"] == 2
    assert state.conform(spark.createDataFrame([], state.ITEMS), state.ITEMS).schema == spark.createDataFrame([], state.ITEMS).schema


def test_counters_in_the_write(spark, tmp_path):
    kinds = "status string, property_type string, county string, discount_pct decimal(7,2), discount_suspicious boolean, repeat_seq int"
    made = [("u_tijeku", "stan", "A", Decimal("10.00"), False, 1), ("u_tijeku", "kuca", None, Decimal("20.01"), False, 2), (None, "stan", "B", Decimal("99.00"), True, 2), ("zavrseno", "x", "A", None, None, 3)]
    counted = state.counters(["u_tijeku", "zavrseno"], ["stan", "kuca"], ["A", "B"])
    version, flat = state.write_version(spark.createDataFrame(made, kinds), f"file://{tmp_path}/s", counted=counted)
    assert version == 1 and state.summary(flat) == {
        "items": 4, "avg_discount_pct": 15.01, "suspicious": 1, "repeat_groups": 2, "by_status": {"u_tijeku": 2, "Nepoznato": 1, "zavrseno": 1},
        "by_type": {"stan": 2, "Nepoznato": 1, "kuca": 1}, "by_county": {"A": 2, "B": 1, "Nepoznato": 1},
    }


PAGE = '<html><head><title>{t}</title><meta name="description" content="{t} with a description that is long enough to pass"><link rel="canonical" href="https://x/"></head><body><h1>čaj</h1><p>{b}</p></body></html>'


@pytest.fixture(scope="module")
def sound(spark):
    """A state and all beside it that pass every check."""
    d = Decimal
    kinds = "item_key string, case_ref string, county string, city string, description string, issuer_name string, estimated_value_eur decimal(16,2), opening_price_eur decimal(16,2), discount_pct decimal(9,2), area_m2 double, auction_start timestamp_ntz, auction_end timestamp_ntz, property_type string, status string, repeat_group string, auction_round string"
    t = dt.datetime(2024, 1, 1)
    made = [(f"k{i}", "OVR-1" if i < 2 else f"ST-{i}", "Z", "grad", "kuća", "FINA", d(100), d(60 - i), d(40 + i), 5.0, t, t, "kuca", "u_tijeku", "g" if i < 2 else f"g{i}", ["Prva", "Druga"][i % 2]) for i in range(4)]
    frame = spark.createDataFrame(made, kinds)
    pages = spark.createDataFrame([(f"/p{i}/", PAGE.format(t=f"T{i}", b="text")) for i in range(3)], "path string, html string")
    return {
        "snapshot": frame, "state": frame, "pages": pages, "sitemap": pages.select("path"),
        "runs": spark.createDataFrame([("x",), ("y",)], "source_sha256 string"), "prices": spark.createDataFrame([("k1",)], "item_key string"),
        "events": spark.createDataFrame([("nova",)], "event_type string"),
    }


def _report(parts):
    got = validation.validate(**parts, county="Z", case_ref="OVR-1", given_names=["Ivan"])
    return {r["name"]: r["status"] for r in got.collect()}


def _faults(spark, s):
    frame = s["state"]
    change = lambda column, value: frame.withColumn(column, F.when(F.col("item_key") == "k0", F.lit(value)).otherwise(F.col(column)))
    page = lambda html: s["pages"].unionByName(spark.createDataFrame([("/q/", html)], "path string, html string"))
    return {
        "keys_present": {"snapshot": frame.unionByName(frame.limit(1).withColumn("item_key", F.lit("new")).withColumn("county", F.lit("Y")))},
        "fields_same": {"snapshot": change("city", "selo")},
        "no_personal_data": {"state": change("description", "kuća, tel. 091 123 4567"), "snapshot": change("description", "x")},
        "discounts": {"state": change("discount_pct", Decimal("41.00"))},
        "known_repeat_linked": {"state": frame.withColumn("repeat_group", F.col("item_key"))},
        "no_mixed_cases": {"state": frame.withColumn("repeat_group", F.lit("g"))},
        "pages": {"pages": page("<html><title>q</title></html>")},
        "diacritics": {"pages": s["pages"].withColumn("html", F.replace("html", F.lit("č"), F.lit("c")))},
        "history": {"runs": s["runs"].limit(1)},
        "price_tracking": {"state": frame.withColumn("opening_price_eur", F.lit(None).cast("decimal(16,2)")).withColumn("discount_pct", F.lit(None).cast("decimal(9,2)"))},
    }


def test_all_checks_pass(sound):
    got = _report(sound)
    assert len(got) == 12 and set(got.values()) == {"PASS"}, got


def test_each_check_fails_on_its_fault(spark, sound, monkeypatch):
    for name, parts in _faults(spark, sound).items():
        assert _report(sound | parts)[name] == "FAIL", name
    quiet = _report(sound | {"runs": sound["runs"].limit(1), "prices": sound["prices"].limit(0)})
    assert quiet["history"] == "WARN"
    monkeypatch.setattr(validation, "CANARY", "nothing")
    bad = validation.validate(**sound, county="Z", case_ref="OVR-1", given_names=[])
    assert validation.exit_code(bad) == 1 and {r["name"] for r in bad.where("status = 'FAIL'").collect()} == {"detectors_work"}


def test_register_build(spark):
    units = spark.createDataFrame([("1", "Jezgra", 45.0, 15.0), ("2", "Lipa II", 45.5, 15.5), ("3", "Donja Lipa", 45.5, 15.5), ("4", "Lipa Brod", 45.5, 15.5), ("5", "Lipa", 46.9, 17.0), ("6", "Nigdje", 45.5, 15.5)], "unit_id string, name string, lat double, lon double")
    places = spark.createDataFrame([("Lipa", "B"), ("Lipa Donja", "B"), ("Brod", "B")], "name string, county string")
    centres = spark.createDataFrame([("A", 45.0, 15.0), ("B", 45.5, 15.5), ("C", 46.9, 17.0)], "county string, lat double, lon double")
    got = {r["unit_id"]: (r["county"], r["source"]) for r in location.name_counties(units, places, centres, "A").collect()}
    assert got == {"1": ("A", "jezgra"), "2": ("B", "ime"), "3": ("B", "ime-obrnuto"), "4": ("B", "ime-slozeno"), "5": (None, None), "6": (None, None)}


OFFERED = [
    # id, text, county, settlement, unit; county, settlement, unit of the answer, or a part of the reason
    (1, "k.o. Trsat", None, None, "Trsat", ("A", "", "Trsat")),
    (2, "tekst", "B", None, "Trsat", "proturječje"),
    (3, "kuća, k.o. TRSAT", "B", None, "Trsat", ("A", "", "Trsat")),
    (4, "x", None, "Lipa", "Trsat", ("A", "Lipa", "Trsat")),
    (5, "x", None, "Brod", "Trsat", "se ne slažu"),
    (6, "u k.o. Trsat", None, "Brod", "Trsat", ("A", "", "Trsat")),
    (7, "x", "B", "Luka", None, ("B", "Luka", "")),
    (8, "x", None, "Luka", None, "postoji u 2 županija"),
    (9, "x", None, "Lipa", None, ("A", "Lipa", "")),
    (10, "x", "B", "Lipa", None, "je u A"),
    (11, "mjesto Lipa", "B", "Lipa", None, ("A", "Lipa", "")),
    (12, "x", None, "Otok", None, "dvoznačno"),
    (13, "x", "A", "Otok", None, ("A", "Otok", "")),
    (14, "x", None, "Blato", None, "istoimena k.o."),
    (15, "x", None, "Nigdje", None, "nije u DZS"),
    (16, "u županiji Beta", "Beta županija", None, None, ("Beta županija", "", "")),
    (17, "x", "Beta županija", "Nigdje", None, "ni županija ni njoj"),
    (18, "kraj Vrela, Vrelo", "Gama", None, None, ("Gama", "Vrelo", "")),
    (19, "kraj Polja, Polje", "Gama", None, None, "ni županija ni njoj"),
    (20, "x", "B", None, "Dva", ("B", "", "Dva")),
    (21, "x", None, None, "Dva", "nije prepoznao"),
    (22, "x", None, "Lipa", "Bez", ("A", "Lipa", "")),
    (23, "x", None, None, "Dol Donji II", ("B", "", "Donji Dol")),
    (24, None, None, None, None, "nije prepoznao"),
    (25, "x", " ", "", "  ", "nije prepoznao"),
]


def test_proposals(spark):
    frame = spark.createDataFrame([r[:5] for r in OFFERED], "item_id int, text string, county string, settlement string, unit string")
    places = spark.createDataFrame([("Luka", "A", 5), ("Luka", "B", 9), ("Lipa", "A", 3), ("LIPA", "A", 1), ("Brod", "B", 2), ("Otok", "A", 7), ("Blato", "A", 4), ("Vrelo", "Gama", 4), ("Polje", "Gama", 4)], "name string, county string, population int")
    units = spark.createDataFrame([("1", "TRSAT", "A"), ("2", "BLATO", "B"), ("3", "DVA", "A"), ("4", "DVA", "B"), ("5", "BEZ", None), ("6", "DONJI DOL", "B"), ("7", "POLJE", "B")], "code string, name string, county string")
    got = {r["item_id"]: r for r in proposals.judge_proposals(frame, places, units, ["Otok"]).collect()}
    assert len(got) == len(OFFERED)
    for i, *_, want in OFFERED:
        r = got[i]
        if isinstance(want, str):
            assert r["county"] is None and want in r["reason"] and not r["evidence"], (i, r)
        else:
            assert (r["county"], r["settlement"], r["unit"]) == want and r["evidence"] and not r["reason"], (i, r)
    assert {r["item_id"] for r in proposals.valid_proposals(frame, places, units, ["Otok"]).collect()} == {i for i, *_, want in OFFERED if not isinstance(want, str)}


def test_names_in_text(spark):
    texts = ["kuća u Vela Luka, na Otoku", "iz Donjeg Sela Velikog Polja Maloga", "u (Splitu) i kod Novi-Grad", "u, Splitu", "Uz Split", None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", cascade.words(F.coalesce("t", F.lit(""))).alias("w"))
    prose = [r[0] for r in frame.orderBy("i").select(cascade.prose_names(F.col("w"))).collect()]
    assert prose == [["Vela Luka", "Otoku"], ["Donjeg Sela Velikog"], ["Novi-Grad"], [], [], [], []]
    told = ["Ličko-senjska, Vela Luka Mala Gora", "NOVI-GRAD kraj Sela. Brod", "ab Cd", ""]
    frame = spark.createDataFrame(list(enumerate(told)), "i int, t string").select("i", cascade.words(F.col("t")).alias("w"))
    hints = [set(r[0]) for r in frame.orderBy("i").select(cascade.hint_names(F.col("w"))).collect()]
    assert hints == [{"Ličko", "Vela Luka Mala", "Gora"}, {"NOVI-GRAD", "NOVI GRAD", "Sela", "Brod"}, set(), set()]


@pytest.mark.parametrize("county", [False, True])
def test_longest_mention(spark, county):
    """By brute force, over names of one to four words; runs of words are made only where a name begins."""
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choices(["Luka", "vela,", "MALA", "Ž", "otok"], k=rng.randint(0, 9))), rng.choice("AB")) for i in range(60)] + [(99, None, "A"), (98, " ., ", None)]
    names = [("Luka", "A"), ("Vela Luka", "A"), ("vela luka", "B"), ("mala-vela", "B"), ("otok z mala luka", "A"), ("Otok", "B"), ("", "A"), (None, "A")]
    cut = lambda t: " ".join(re.findall("[a-z0-9]+", (t or "").lower().replace("ž", "z")))
    want = {}
    for i, t, c in texts:
        met = [(len(cut(n)), n) for n, of in names if cut(n) and f" {cut(n)} " in f" {cut(t)} " and (not county or of == c)]
        want |= {i: max(met)[1]} if met else {}
    a, b = spark.createDataFrame(texts, "text_id int, text string, county string"), spark.createDataFrame(names, "name string, county string")
    got = location.longest_mention(a if county else a.drop("county"), b)
    assert {r["text_id"]: r["name"] for r in got.collect()} == want
    assert "sequence(" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert location.longest_mention(a, b.limit(0)).collect() == []


def test_links_of_a_hot_group(spark):
    df = spark.range(3000).select(F.lit("hot").alias("fp"), (F.col("id") * 7919 % 3000).alias("o"), "id").unionByName(spark.createDataFrame([("one", 1, 1)], "fp string, o bigint, id bigint"))
    got = linking.link_repeats(df, "fp", [F.col("o")]).select("fp", "o", "repeat_seq").collect()
    assert len(got) == 3001 and all(r["repeat_seq"] == (r["o"] + 1 if r["fp"] == "hot" else 1) for r in got)


def test_exact_median(spark):
    import random
    import statistics

    rng = random.Random(4)
    data = [(g, float(rng.choice(pool))) for g, pool, n in (("a", range(1000), 5001), ("b", [1, 1, 1, 9], 400), ("c", [3], 1), (None, range(7), 2)) for _ in range(n)] + [("d", None)]
    got = {r["g"]: r["median"] for r in marts.exact_median(spark.createDataFrame(data, "g string, v double"), "g", "v").collect()}
    assert got == {g: statistics.median([v for h, v in data if h == g]) for g in ("a", "b", "c", None)}


def test_titles_and_feeds(spark, tmp_path):
    df = spark.createDataFrame([(1, "t", "x"), (2, "t", "x"), (3, "t", "y"), (4, "u", "z"), (5, None, "z")], "k int, t string, s string")
    assert rows(marts.unique_titles(df, "t", "s", "k").select("k", "unique_title")) == [(1, "t · x / 1"), (2, "t · x / 2"), (3, "t · y"), (4, "u"), (5, None)]
    kinds = "card_title string, url string, publish_start timestamp_ntz, opening_price_eur double, type_label string, county string, discount_pct double, discount_suspicious boolean, auction_end timestamp_ntz"
    day = lambda d: dt.datetime(2024, 1, d, 9, 0)
    made = spark.createDataFrame([("A & B", "/1/", day(5), 1234.5, "Stan", "Z", 10.0, False, day(30)), ("Z", "/2/", day(9), None, "", None, None, None, None), ("none", "/3/", None, 1.0, "", "", 1.0, False, None), ("C", "/4/", day(7), 0.0, "Kuća", "", 99.0, True, None)], kinds)
    for n, want in ((50, ["/2/", "/4/", "/1/"]), (2, ["/2/", "/4/"])):
        snapshot.write_feed(made, f"file://{tmp_path}/feed.xml", "T & U", "https://x", "D", n=n)
        text = (tmp_path / "feed.xml").read_text()
        assert re.findall(r'<guid isPermaLink="true">https://x(.*?)</guid>', text) == want  # the newest first
    snapshot.write_feed(made, f"file://{tmp_path}/feed.xml", "T & U", "https://x", "D")
    text = (tmp_path / "feed.xml").read_text()
    assert text.startswith('<?xml version="1.0" encoding="UTF-8"?>') and "<title>T &amp; U</title>" in text and "<language>hr</language>" in text and text.endswith("</channel></rss>\n")
    assert "<title>A &amp; B, 1\u00a0234,50\u00a0€</title><link>https://x/1/</link>" in text and "<pubDate>Fri, 05 Jan 2024 09:00:00 +0100</pubDate>" in text
    assert "<description>Stan · Z · 10,0\u00a0% ispod procjene · nadmetanje do 30.01.2024.</description>" in text and "<description>Kuća</description>" in text and "<description></description>" in text
    xml.etree.ElementTree.fromstring(text)


@pytest.mark.parametrize("most, files", [(50_000, 1), (100, 4), (390, 1)])
def test_sitemap_in_files(spark, tmp_path, most, files):
    """Each path once, by its first page, in order; files of bounded length, under an index where there are several."""
    made = [(i, f"/p{i % 390}/" if i % 390 else "/a&b/", "daily" if i < 390 else "never", 0.5 + (i % 5) / 10) for i in range(500)]
    pages = spark.createDataFrame(made, "row_ord int, path string, changefreq string, priority double").repartition(7)
    for _ in range(2):  # written again over itself
        assert snapshot.write_sitemap(pages, f"file://{tmp_path}/site", "https://x", "2024-01-01", most=most) == files
    names = sorted(p.name for p in (tmp_path / "site").glob("*.xml"))
    parts = ["sitemap.xml"] if files == 1 else [f"sitemap-{k}.xml" for k in range(files)]
    assert names == sorted({"sitemap.xml", *parts}) and not (tmp_path / "site/_shards").exists()
    texts = [(tmp_path / "site" / n).read_text() for n in parts]
    urls = [re.findall("<loc>(.*?)</loc>", t) for t in texts]
    assert max(map(len, urls)) <= most and [u for own in urls for u in own] == ["https://x/a&amp;b/", *(f"https://x/p{i}/" for i in range(1, 390))]
    for t in texts:
        xml.etree.ElementTree.fromstring(t)
    assert "  <url><loc>https://x/p7/</loc><lastmod>2024-01-01</lastmod><changefreq>daily</changefreq><priority>0.7</priority></url>" in "".join(texts) and "never" not in "".join(texts)
    assert (tmp_path / "site/robots.txt").read_text() == "User-agent: *\nAllow: /\n\nSitemap: https://x/sitemap.xml\n"
    if files > 1:
        assert re.findall("<loc>(.*?)</loc>", (tmp_path / "site/sitemap.xml").read_text()) == [f"https://x/{n}" for n in parts]


def test_sitemap_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "row_ord int, path string, changefreq string, priority double")
    assert snapshot.write_sitemap(empty, f"file://{tmp_path}/s", "https://x", "2024-01-01") == 0
    assert "<urlset" in (tmp_path / "s/sitemap.xml").read_text()


def test_pages_are_written_once(spark, tmp_path):
    pages = spark.createDataFrame([("/a/", "x"), ("/b/", "y"), ("/a/", "z")], "path string, html string")
    with pytest.raises(Exception, match="2 pages write to the same path: /a/"):
        snapshot.written_once(pages).write.parquet(f"file://{tmp_path}/pages")
    assert not (tmp_path / "pages/_SUCCESS").exists()
    assert rows(snapshot.written_once(pages.where("html <> 'z'"))) == [("/a/", "x"), ("/b/", "y")]


def test_sources(spark, tmp_path):
    """Metadata, floors, dates, registers, HTML files, the independent reading, photos, lists of posts."""
    (tmp_path / "s.csv").write_text('\ufeffOpis;Stanje na dan\n"a\nb";\n;\nc;05.08.2026\n', encoding="utf-8")
    at = f"file://{tmp_path}/s.csv"
    meta = snapshot.source_meta(spark, at)
    raw = (tmp_path / "s.csv").read_bytes()
    assert [(r["bytes"], r["sha256"]) for r in meta.collect()] == [(len(raw), hashlib.sha256(raw).hexdigest())]
    got, date = snapshot.reread(spark, at, ["Opis", "Stanje na dan"])
    assert [r["Opis"] for r in got.orderBy("row_ord").collect()] == ["a\nb", "c"] and date == "05.08.2026"
    assert snapshot.reread(spark, at, ["Opis"])[1] is None
    assert rows(snapshot.guard_snapshot(meta, got)) == [("bytes", False), ("rows", False)]
    assert rows(snapshot.guard_snapshot(meta, got, 10, 2)) == [("bytes", True), ("rows", True)]
    assert rows(snapshot.guard_snapshot(meta.limit(0), got, 1, 2)) == [("bytes", False), ("rows", True)]
    (tmp_path / "r.csv").write_text("naziv;lat\nTrsat;45.3\n", encoding="utf-8")
    assert rows(snapshot.read_register(spark, f"file://{tmp_path}/r.csv", {"naziv": "string", "lat": "double"})) == [("Trsat", 45.3)]
    (tmp_path / "site/deep").mkdir(parents=True)
    (tmp_path / "site/deep/x.html").write_text("<p>č\nd</p>", encoding="utf-8")
    (tmp_path / "site/y.txt").write_text("no", encoding="utf-8")
    assert [(r["path"].rsplit("/", 2)[1:], r["html"]) for r in snapshot.read_html(spark, f"file://{tmp_path}/site").collect()] == [(["deep", "x.html"], "<p>č\nd</p>")]
    (tmp_path / "p.json").write_text('{"rab": {"autor": "A", "licenca": "CC"}, "vis": {}}', encoding="utf-8")
    assert rows(snapshot.read_photos(spark, f"file://{tmp_path}/p.json")) == [("rab", {"autor": "A", "licenca": "CC"}), ("vis", {})]
    a, b = spark.createDataFrame([("x", "2024-01-02")], "url string, day string"), spark.createDataFrame([("y", "2024-03-01"), ("a", "2024-01-02")], "url string, day string")
    assert [r["url"] for r in snapshot.newest_first(a, b, date="day", key="url").collect()] == ["y", "a", "x"]


def test_listings(spark):
    """Display order, unresolved by issuer, removals, events, numbers, keys in common, baseline."""
    kinds = "item_key string, status string, discount_pct double, county string, issuer_type string, issuer_name string"
    made = [("a", "zavrseno", 50.0, None, "fina", "F"), ("b", "u_tijeku", None, None, "", "G"), ("c", "u_tijeku", -5.0, "Z", "fina", "F"), ("d", "u_tijeku", 9.0, None, None, "G"), ("e", "?", 99.0, None, "fina", "H")]
    df = spark.createDataFrame(made, kinds)
    assert [r["item_key"] for r in marts.sort_for_display(df, "status", "discount_pct", "item_key", ["u_tijeku", "zavrseno"]).collect()] == ["d", "b", "c", "a", "e"]
    by_type, names = items.unresolved_by_issuer(df, 2)
    assert rows(by_type) == [("fina", 2), ("nepoznato", 2)] and [tuple(r) for r in names.collect()] == [("G", 2), ("F", 1)]
    removed = spark.createDataFrame([({"email": 2, "iban": 1},), ({"email": 1},), ({},)], "removed map<string,int>")
    assert [tuple(r) for r in items.removal_summary(removed).collect()] == [("email", 3), ("iban", 1)]
    events = spark.createDataFrame([("nova",), ("nova",), ("status",), ("cijena",)], "event_type string")
    assert rows(validation.event_counts(events, ["nova", "status"])) == [("nova", 2), ("status", 1)]
    numbers = spark.createDataFrame([("1.5",), ("x",), (None,), ("",)], "v string")
    assert [r[0] for r in numbers.select(parse.number_or_null(F.col("v"))).collect()] == [1.5, None, None, None]


def test_overrides_points_and_counties(spark):
    places = spark.createDataFrame([("Luka", "A"), ("Lipa", "B")], "name string, county string")
    units = spark.createDataFrame([("Trsat", "A"), ("Blato", "B")], "name string, county string")
    counties = spark.createDataFrame([("A",), ("B",)], "county string")
    offered = spark.createDataFrame([("1", "A", "Luka", ""), ("2", "A", "Lipa", ""), ("3", "C", "", ""), ("4", "A", "", "Blato"), ("5", "A", None, "Trsat")], "item_id string, county string, settlement string, unit string")
    good = location.valid_overrides(offered, counties, places, units)
    assert {r["item_id"] for r in good.collect()} == {"1", "5"}
    found = spark.createDataFrame([("1", None, None, "nema"), ("5", "B", "Grad", "visoka"), ("9", None, None, "nema")], "item_id string, county string, city string, confidence string")
    got = location.with_overrides(found, good.select("item_id", F.col("county").alias("o_county"), F.col("settlement").alias("o_city")))
    assert rows(got) == [("1", "A", "Luka", "srednja"), ("5", "B", "Grad", "visoka"), ("9", None, None, "nema")]
    named = spark.createDataFrame([("Ličko-senjska",), ("licko-senjska ŽUPANIJA",), ("Grad Zagreb",), ("Narnija",), (None,)], "name string")
    known = {r["name"]: r["official"] for r in cascade.official_county(named, ["Ličko-senjska županija", "Grad Zagreb"]).collect()}
    assert known == {"Ličko-senjska": "Ličko-senjska županija", "licko-senjska ŽUPANIJA": "Ličko-senjska županija", "Grad Zagreb": "Grad Zagreb", "Narnija": None, None: None}


def test_town_forms(spark):
    """Towns by their names, declined and other forms; ambiguous ones have no county, whatever the form."""
    towns = spark.createDataFrame([("Rijeka", "P"), ("Đakovo", "O"), ("Belišće", "O"), ("Novigrad", "I"), ("Pula", "I"), ("Pola", "I"), ("Sveta Nedelja", "Z"), ("Sveta Nedjelja", "Z"), ("Ilok", "V")], "town string, county string")
    got = {r["form"]: (r["town"], r["county"]) for r in registers.town_forms(towns).collect()}
    assert got == {
        "Rijeka": ("Rijeka", "P"), "rijeci": ("Rijeka", "P"), "Đakovo": ("Đakovo", "O"), "djakovu": ("Đakovo", "O"), "dakovu": ("Đakovo", "O"), "Belišće": ("Belišće", "O"), "belišću": ("Belišće", "O"), "Novigrad": ("Novigrad", None),
        "Pula": ("Pula", "I"), "Pola": ("Pula", "I"), "puli": ("Pula", "I"), "Sveta Nedelja": ("Sveta Nedelja", None), "Sveta Nedjelja": ("Sveta Nedelja", None), "Ilok": ("Ilok", "V"),
    }
    assert registers.counties(spark).count() == 21
    empty = lambda s: spark.createDataFrame([], s)
    reg = cascade.Registers(empty("name string, county string, population int"), registers.town_forms(towns), empty("town string, county string"), registers.counties(spark), empty("code string, name string, lat double, lon double, county string"))
    said = spark.createDataFrame([(1, "kuća u Rijeci"), (2, "stan u Belišću, vrt"), (3, "kuća u Novigradu"), (4, "kuća u mjestu Pola"), (5, "k.o. Istarska")], "item_id int, text string").withColumn("issuer", F.lit("")).withColumn("issuer_type", F.lit("fina"))
    found = {r["item_id"]: (r["county"], r["city"], r["step"]) for r in cascade.locate(said, reg).collect()}
    assert found == {1: ("P", "Rijeka", 2), 2: ("O", "Belišće", 2), 3: (None, None, 9), 4: ("I", "Pula", 2), 5: ("Istarska županija", None, 1)}


def test_map_points(spark):
    """By code, else by the only unit of a name, else by the only one near the county's centre."""
    empty = lambda s: spark.createDataFrame([], s)
    units = spark.createDataFrame([("111111", "TRSAT", 45.3, 14.4, "A"), ("2222", "DVA", 45.0, 15.0, "A"), ("3333", "DVA", 48.0, 18.0, "B"), ("4444", "TRI", 45.1, 15.0, "A"), ("5555", "TRI", 45.2, 15.0, "A")], "code string, name string, lat double, lon double, county string")
    reg = cascade.Registers(empty("name string, county string, population int"), empty("form string, town string, county string"), empty("town string, county string"), spark.createDataFrame([("A", 45.0, 15.0), ("B", 48.0, 18.0)], "county string, lat double, lon double"), units)
    given = spark.createDataFrame([(1, "k.o. 111111 x"), (2, "x"), (3, "x"), (4, "x"), (5, "x")], "item_id int, text string")
    located = spark.createDataFrame([(1, "B", "DVA"), (2, None, "Trsat"), (3, "B", "Dva"), (4, "A", "Tri"), (5, "A", None)], "item_id int, county string, cadastral_municipality string")
    got = cascade.points(located, given, reg)
    assert rows(got) == [(1, 45.3, 14.4, "matični broj"), (2, 45.3, 14.4, "naziv"), (3, 48.0, 18.0, "naziv i županija")]


def test_staleness_and_residue(spark):
    when = lambda x: F.lit(x).cast("timestamp_ntz")
    got = spark.range(1).select(items.is_stale(when("2024-01-01"), when("2024-01-03 00:00:01")), items.is_stale(when("2024-01-01"), when("2024-01-02"))).first()
    assert tuple(got) == (True, False)
    df = spark.createDataFrame([("b", None, "stan", "u_tijeku"), ("a", None, "stan", "u_tijeku"), ("c", None, "pravo", "u_tijeku"), ("d", "Z", "stan", "u_tijeku"), ("e", None, "stan", "zavrseno")], "item_key string, county string, property_type string, status string")
    assert [r["item_key"] for r in items.residue(df).collect()] == ["a", "b"] and items.active(df).count() == 4 and items.movables(df).count() == 1
