"""The search index, incremental linking and chunked groups against brute force."""

import datetime as dt
import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallygrove.functions import text
from tallygrove.operators import items, linking
from tallygrove.sources import search_index, snapshot

WORDS = ["Kuća", "stan", "Đakovo", "ĐAKOVAČKA", "m²", "ab", "a", "Čakovec i okolica", "x-y", "Rijeka", "njiva", ""]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rng = random.Random(3)
    made = [(i, " ".join(rng.choices(WORDS, k=rng.randint(0, 4))), rng.choice([None, "Split", "Rab"])) for i in range(200)] + [(1000 + i, "hot njiva", None) for i in range(100)]
    at = f"file://{tmp_path_factory.mktemp('index')}/x"
    search_index.build(spark.createDataFrame(made, "id int, name string, city string"), at, "id", ["name", "city"])
    return made, at


@pytest.mark.parametrize("terms", ["kuca", "Đako", "STAN split", "m²", "a", "ab ra", "hot", "njiv hot", "zzz", "kuca zzz", "", "  ", "x-y", "| rab", "t"])
def test_search_finds_what_a_scan_finds(spark, index, terms):
    made, at = index
    fold = lambda s: "".join({"đ": "d", "ć": "c", "č": "c"}.get(c, c) for c in s.lower())
    hay = {i: fold(" | ".join(x for x in (n, c) if x is not None)) for i, n, c in made}
    want = [i for i in sorted(hay) if all(t in hay[i] for t in fold(terms).split())][:60]
    got = search_index.search(spark, at, "id", terms, [F.col("id")])
    assert [r["id"] for r in got.collect()] == want and got.columns == ["id", "name", "city"]


def test_search_reads_buckets_only(spark, index):
    """A look-up of a gram is a filter on partitions, not a scan of the postings."""
    known = spark.read.parquet(f"{index[1]}/grams")
    got = search_index._looked_up(spark.read.parquet(f"{index[1]}/postings"), ["hot"], known)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "PushedFilters: [IsNotNull(gram), EqualTo(gram,hot)]" in plan
    assert got.select("part").distinct().count() == 1


def test_postings_are_few_files(spark, tmp_path):
    """A small index has one file of postings a bucket; each item's gram stands once, however often the item and the gram do."""
    made = [(i % 50, "abcabcabc" if i % 2 else "xyzab") for i in range(200)]
    at = f"file://{tmp_path}/few"
    search_index.build(spark.createDataFrame(made, "id int, name string"), at, "id", ["name"])
    postings = spark.read.parquet(f"{at}/postings")
    assert postings.select("part", F.input_file_name().alias("f")).distinct().groupBy("part").count().where("count > 1").count() == 0
    want = {(i, f" {t} "[k : k + 3]) for i, t in made for k in range(len(t))}
    assert sorted((r["doc"], r["gram"]) for r in postings.collect()) == sorted(want)
    assert {r["gram"]: r["items"] for r in spark.read.parquet(f"{at}/grams").collect()}["abc"] == 25


def test_client_record(spark, tmp_path):
    day = dt.datetime(2024, 5, 6, 10, 0)
    kinds = "item_key string, case_ref string, auction_id string, property_type string, procedure_type string, county string, city string, cadastral_municipality string, area_m2 double, opening_price_eur double, discount_pct double, discount_suspicious boolean, status string, auction_end timestamp_ntz, latitude double, longitude double"
    made = [("k1", "Ovr-1", None, "stan", "ovrha", "Ličko-senjska županija", "Gospić", None, 1250.4, 99000.5, 12.25, False, "u_tijeku", day, 44.5, 15.4), ("k2", None, "7", "pravo", None, None, None, None, 0.0, 0.0, 99.5, True, "bez_termina", None, None, None)]
    shown = items.decorate(spark.createDataFrame(made, kinds), F.lit("2024-05-01").cast("date"))
    snapshot.write_search_index(search_index.projection(shown.orderBy("item_key"), search_index.client_record()), f"file://{tmp_path}/i")
    got = sorted((json.loads(line) for p in (tmp_path / "i").glob("*.json") for line in p.read_text().splitlines()), key=lambda r: r["pk"], reverse=True)
    nbsp = text.NBSP
    assert got[0] == {
        "n": f"Stan 1{nbsp}250 m², Gospić", "u": "/nekretnine/licko-senjska-zupanija/gospic/stan-gospic-k1/", "g": "Gospić", "z": "Ličko-senjska županija", "k": "", "r": "Ovr-1", "i": "", "t": "Stan", "s": "U tijeku",
        "p": f"99{nbsp}000,50{nbsp}€", "d": "12 %", "a": f"1{nbsp}250{nbsp}m²", "e": "06.05.2024.", "pm": "79 €/m²", "dl": 5, "ty": "stan", "sk": "u_tijeku", "pk": "ovrha", "zs": "licko-senjska-zupanija", "gs": "gospic",
        "pn": 99000.5, "an": 1250.4, "dn": 12.25, "mn": 79.18, "ei": "2024-05-06", "lt": 44.5, "ln": 15.4,
    }
    assert got[1] == {"n": "Pravo, Hrvatska", "u": "/pokretnine/pravo-k2/", "g": "", "z": "", "k": "", "r": "", "i": "7", "t": "Pravo", "s": "Bez termina", "p": "", "d": "", "a": "", "e": "", "pm": "", "ty": "pravo", "sk": "bez_termina", "pk": "", "zs": "nepoznata-lokacija", "gs": "ostalo", "ei": ""}


def test_meta_description(spark):
    kinds = "property_type string, area_m2 double, city string, opening_price_eur double, discount_pct double, discount_suspicious boolean, procedure_type string"
    made = [("stan", 80.0, "Rijeka", 50000.0, 10.0, False, "stecaj"), ("kuca", None, None, None, None, None, "ostalo"), ("x", 0.0, "", 0.0, 99.0, True, None), ("kuca", 5.0, "Y" * 400, 1.0, None, None, "insolvencija")]
    df = spark.createDataFrame(made, kinds)
    got = [r[0] for r in df.select(items.meta_description({c: F.col(c) for c in df.columns}, F.coalesce(F.nullif("city", F.lit("")), F.lit("Z")))).collect()]
    nbsp = text.NBSP
    tail = "Službeni podaci FINA Očevidnika."
    assert got[:3] == [f"Stan, 80{nbsp}m², u mjestu Rijeka, početna cijena 50{nbsp}000{nbsp}€, 10,0{nbsp}% ispod procjene. Sudska dražba (stečaj). {tail}", f"Kuća, Z. Sudska dražba. {tail}", f"Nekretnina, Z. Sudska dražba. {tail}"]
    assert len(got[3]) == 300


ITEM = "k int, repeat_group string, r int, t int"


def linked(rows):
    """{key: number in its group} by sorting each group whole."""
    groups = defaultdict(list)
    for k, g, r, t in rows:
        groups[g].append((r, t is not None, t or 0, k))
    return {x[-1]: n for g in groups.values() for n, x in enumerate(sorted(g), 1)}


@pytest.mark.parametrize("seed", [1, 2])
def test_linking_by_increments(spark, seed):
    """Day after day full copies with new, moved and missing items: numbers as if all were linked at once, and untouched groups stay."""
    rng = random.Random(seed)
    now, state = {}, None
    for day in range(3):
        for k in range(day * 40, day * 40 + 60):
            if k not in now or rng.random() < 0.1:
                now[k] = (k, "hot" if rng.random() < 0.4 else f"g{rng.randint(0, 12)}", rng.choice([1, 2, 99]), rng.choice([None, day * 10 + rng.randint(0, 9)]))
        today = [v for k, v in now.items() if rng.random() < 0.8]
        batch = spark.createDataFrame(today, ITEM)
        if state is None:
            seen = {v[0]: v for v in today}
            order = [F.col(c).asc_nulls_first() for c in ("r", "t", "k")]
            state = linking.link_repeats(batch, "repeat_group", order)
            continue
        before = {r["k"]: (r["repeat_group"], r["repeat_seq"]) for r in state.collect()}
        seen |= {v[0]: v for v in today}
        got = linking.link_increment(state, batch, "k", ["r", "t", "k"])
        rows = got.collect()
        assert {r["k"]: r["repeat_seq"] for r in rows} == linked(seen.values()) and len(rows) == len(seen)
        assert all(before[r["k"]] == (r["repeat_group"], r["repeat_seq"]) for r in rows if r["how"] == "kept")
        assert {r["how"] for r in rows} >= {"renumbered", "kept"}
        state = spark.createDataFrame(rows, got.schema).drop("how")
    same = linking.link_increment(state, state.drop("repeat_seq"), "k", ["r", "t", "k"])
    assert {r["how"] for r in same.collect()} == {"kept"}
    heads = linking.group_heads(state, ["r", "t", "k"])
    more = spark.createDataFrame([(9000, "hot", 99, 10**6)], ITEM)
    added = [r for r in linking.link_increment(state, more, "k", ["r", "t", "k"], heads).collect() if r["how"] != "kept"]
    assert [(r["k"], r["how"], r["repeat_seq"]) for r in added] == [(9000, "appended", state.where("repeat_group = 'hot'").count() + 1)]


def test_repeat_order(spark):
    got = spark.createDataFrame([(1, 0, None, "2024-01-02"), (2, None, "2024-01-01", "2024-05-05"), (3, 2, None, None)], "k int, n int, d string, p string")
    r, t = linking.repeat_order(F.col("n"), F.col("d"), F.col("p"))
    assert [tuple(x) for x in got.select(r, t.cast("string")).collect()] == [(99, "2024-01-02 00:00:00"), (99, "2024-01-01 00:00:00"), (2, None)]


def test_groups_in_chunks(spark):
    """A third of all items in one group: rows of bounded length, each member once, in order; no value grows with a square."""
    rng = random.Random(5)
    made = [(i, "hot" if i % 3 == 0 else f"g{rng.randint(0, 150)}" if i % 7 else None, rng.choice([None, *range(20)])) for i in range(600)]
    df = spark.createDataFrame(made, "k int, g string, o int")
    groups = defaultdict(list)
    for k, g, o in made:
        if g is not None:
            groups[g].append((o is not None, o or 0, k))
    groups = {g: [x[-1] for x in sorted(m)] for g, m in groups.items() if len(m) > 1}
    got = linking.group_lists(df, "g", "k", ["o"], chunk=50).collect()
    assert max(len(r["members"]) for r in got) == 50
    whole = defaultdict(list)
    for r in sorted(got, key=lambda r: r["chunk"]):
        assert r["first"] == len(whole[r["g"]]) + 1
        whole[r["g"]] += r["members"]
    assert dict(whole) == groups
    place = {r["k"]: (r["g"], r["place"], r["members"], r["chunk"]) for r in linking.membership(df, "g", "k", ["o"], chunk=50).collect()}
    assert place == {k: (g, i + 1, len(m), i // 50) for g, m in groups.items() for i, k in enumerate(m)}
