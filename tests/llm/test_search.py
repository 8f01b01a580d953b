"""Clustering, lexical search and exact top-k against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tallygrove.llm import clustering, lexical, topk
from tallygrove.llm._vectors import unpacked

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id bigint, embedding array<float>, label int, v string, ids string, dims int, shard string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "clash", "clash", 7, "clash") for i, v in rows], VECTORS)


def random_rows(n, dims=64, seed=1, spreads=3):
    rng = np.random.default_rng(seed)
    tops = rng.normal(size=(spreads, dims))
    return [(i, [float(np.float32(x)) for x in tops[i % spreads] + rng.normal(size=dims) * 0.4]) for i in range(n)]


@pytest.fixture(scope="module")
def odd_rows():
    rows = random_rows(300)
    same = rows[7][1]
    rows += [(1000 + i, same) for i in range(150)] + [(7, same), (None, rows[3][1]), (None, rows[3][1])]
    return rows + [(5000, None), (5001, [1.0] * 63), (5002, [NAN, *[0.5] * 63]), (5003, [INF, *[0.5] * 63]), (5004, [None, *[0.5] * 63]), (5050, [0.25] * 63), (5100, [])]


def usable(rows, scale, dims=None):
    out = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v) and (dims is None or len(v) == dims):
            out.append((i, [math.floor(scale * x) for x in v]))
    return out


def lloyd_want(rows, k=8, rounds=10):
    kept = usable(rows, 1024, 64)
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    centroids = [list(v) for _, v in first]
    points = np.array([v for _, v in kept], np.int64)

    def assigned():
        d = ((points[:, None, :] - np.array(centroids, np.int64)[None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        label, _ = assigned()
        for c in range(len(centroids)):
            own = points[label == c]
            if len(own):
                centroids[c] = [int(x) // len(own) for x in own.sum(axis=0)]
    label, d = assigned()
    of = Counter()
    for c, x in zip(label.tolist(), d.tolist()):
        of[c] += x
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, c, x, of[c], sum(of.values()), sha[c]) for (i, _), c, x in zip(kept, label.tolist(), d.tolist()))


@pytest.mark.parametrize("block, leaf", [(2048, 24), (40, 3), (1, 1)])
def test_lloyd(spark, odd_rows, block, leaf):
    got = clustering.cluster_vectors(frame(spark, odd_rows).repartition(3), block=block, leaf=leaf)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, got.collect())) == lloyd_want(odd_rows)


def test_lloyd_few_and_none(spark):
    rows = random_rows(3) + [(1, random_rows(3)[1][1])]
    assert Counter(map(tuple, clustering.cluster_vectors(frame(spark, rows)).collect())) == lloyd_want(rows)
    assert clustering.cluster_vectors(frame(spark, [])).collect() == []
    assert clustering.cluster_vectors(frame(spark, [(1, None), (2, [0.0])])).collect() == []


def test_lloyd_large_components(spark):
    """Components beyond what doubles hold exactly; those beyond 2^27 count as 2^27."""
    rows = [(i, [float((i * 37 % 11) * 9000)] * 64) for i in range(60)]
    assert Counter(map(tuple, clustering.cluster_vectors(frame(spark, rows)).collect())) == lloyd_want(rows)
    got = clustering.cluster_vectors(frame(spark, [(1, [3e38] * 64), (2, [-3e38] * 64)]), k=1, rounds=0).collect()
    assert {r["distance"] for r in got} == {0, 64 * (1 << 28) ** 2}


@pytest.mark.parametrize("leaf", [1, 4, 50])
def test_cover_tree(leaf):
    """Nodes hold what they say: a partition of their parent, within the radius; sibling centres are apart; the first keeps the centre."""
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.integers(-50, 50, (200, 5)), np.tile([[1, 2, 3, 4, 5]], (90, 1))]).astype(np.float64)
    order, nodes = clustering.cover_tree(points, leaf)
    assert sorted(order.tolist()) == list(range(len(points)))
    p = points[order]
    for n in nodes:
        far = np.linalg.norm(p[n["start"] : n["stop"]] - p[n["centre"]], axis=1)
        assert far.max() == pytest.approx(n["radius"]) and n["start"] <= n["centre"] < n["stop"]
        below = nodes[n["first"] : n["first"] + n["children"]]
        if len(below):
            scale = 2.0 ** (math.ceil(math.log2(n["radius"])) - 1)
            assert below[0]["centre"] == n["centre"] and below["start"][0] == n["start"] and below["stop"][-1] == n["stop"]
            assert (below["start"][1:] == below["stop"][:-1]).all() and (below["radius"] <= scale).all()
            centres = p[below["centre"]]
            apart = np.linalg.norm(centres[:, None] - centres[None], axis=2) + np.eye(len(below)) * 1e9
            assert (apart > scale).all()
        else:
            assert n["stop"] - n["start"] <= leaf or n["radius"] == 0


def test_dual_tree_prunes_and_keeps_ties():
    """Equal centroids and equal distances give the smaller number; whole nodes are assigned without comparing their vectors."""
    points = np.array([[x, y] for x in range(40) for y in range(40)], "<i4")
    order, nodes = clustering.cover_tree(unpacked(points.tobytes(), 2), 4)
    p = unpacked(points[order].tobytes(), 2)
    centroids = np.array([[30, 30], [10, 10], [10, 10], [30, 10], [900, 900]], np.float64)
    want = ((p[:, None] - centroids[None]) ** 2).sum(axis=2).argmin(axis=1)
    calls = []
    plain = clustering._compare
    clustering._compare = lambda *x: calls.append(x[4]["stop"] - x[4]["start"]) or plain(*x)
    try:
        assert (clustering.nearest(p, nodes, centroids) == want).all()
    finally:
        clustering._compare = plain
    assert 0 < sum(calls) < len(p) / 2


def top_want(rows, k=5, every=50):
    kept = usable(rows, 256)
    out = Counter()
    for a, (i, v) in enumerate(kept):
        if i is not None and i % every == 0:
            scores = [(-sum(x * y for x, y in zip(v, w)), j is None, j if j is not None else 0) for b, (j, w) in enumerate(kept) if a != b and len(w) == len(v)]
            out.update((i, rank, None if none else j, -s) for rank, (s, none, j) in enumerate(sorted(scores)[:k], 1))
    return out


@pytest.mark.parametrize("size, queries, leaf, parts", [(4096, 512, 64, 2), (64, 3, 8, 5), (1, 1, 1, 2)])
def test_top_k(spark, odd_rows, size, queries, leaf, parts):
    rows = odd_rows[:60] + odd_rows[-30:] if size == 1 else odd_rows
    got = topk.top_k(frame(spark, rows).repartition(parts), size=size, queries=queries, leaf=leaf)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, got.collect())) == top_want(rows)


def test_top_k_few_and_none(spark):
    rows = [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (50, [1.0, 2.0]), (100, [1.0]), (3, [-1.0, 0.5])]
    assert Counter(map(tuple, topk.top_k(frame(spark, rows)).collect())) == top_want(rows)
    assert topk.top_k(frame(spark, [])).collect() == []
    assert topk.top_k(frame(spark, [(50, [1.0])])).collect() == []


def test_ball_tree_prunes():
    """Far balls are never scored, and a smaller id at the k-th score is found behind an equal bound."""
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.integers(-3, 3, (500, 8)) + 100, rng.integers(-3, 3, (500, 8)) - 100, np.tile([[50] * 8], (40, 1))]).astype("<i4")
    ids = rng.permutation(len(points))
    order, nodes, centres = topk.ball_tree(unpacked(points.tobytes(), 8), ids, 16)
    shard = topk.Shard(ids[order], ids[order], unpacked(points[order].tobytes(), 8), nodes, centres)
    scored = []
    for q in ([1] * 8, [-1] * 8, [1, -1] * 4):
        best = topk.Best(np.array([q], np.float64), np.array([-5]), 5)
        plain = best.take
        best.take = lambda own, scores, *x, plain=plain: scored.append(scores.size) or plain(own, scores, *x)
        best.search(shard)
        want = sorted((-int(np.dot(p, q)), int(i)) for p, i in zip(points, ids))[:5]
        assert [(-s, i) for s, i in zip(best.score[0].tolist(), best.id[0].tolist())] == want
    assert sum(scored) < 3 * len(points) / 2


DOCS = "doc_id bigint, text string, n bigint, terms string, times string, item bigint, score string"


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "clash", "clash", 2, "clash") for i, t in rows], DOCS)


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "item_id bigint, text string, doc_id string, rank int")


def terms_want(text):
    return re.findall(lexical.TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def search_want(docs, items, k=10):
    counted = [(i, Counter(terms_want(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = Counter()
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 100 - 90 + ((90 * sum(c.values()) * n_docs) // total)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms_want(text)) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out.update((item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1))
    return out


def some_docs(seed=2, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ärger", "ÄRGER", "naïve", "漢字", "I", "x1"]
    rows = [(i, rng.choice([" ", ", ", "\n", "_"]).join(rng.choices(words, weights=[1 / (j + 1) for j in range(len(words))], k=rng.randint(1, 30)))) for i in range(n)]
    rows += [(1000 + i, "w5 w6 W5! copies of one text") for i in range(120)]
    return rows + [(7, "w5 again"), (7, "w5 again"), (None, "w5 W6 none"), (None, None), (2000, None), (2001, ""), (2002, " _-_ "), (2003, "w7 " * 20000 + "w8")]


ITEMS = [(1, "w5 w6 and w50"), (2, None), (3, "---"), (4, "unseen words only"), (5, "W7-w8_Ärger ÄRGER"), (5, "W7-w8_Ärger ÄRGER"), (None, "w0 w1 w2 w3 w4 w5"), (6, "copies of one text"), (7, "w5 again")]


@pytest.mark.parametrize("size, lot, parts", [(4096, 500, 2), (17, 3, 4), (256, 500, 1), (1, 500, 3)])
def test_search(spark, size, lot, parts):
    docs = some_docs()
    got = lexical.search(docs_frame(spark, docs).repartition(parts), items_frame(spark, ITEMS), size=size, lot=lot)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == search_want(docs, ITEMS)


def test_search_empty(spark):
    docs = some_docs(n=5)
    assert lexical.search(docs_frame(spark, []), items_frame(spark, ITEMS)).collect() == []
    assert lexical.search(docs_frame(spark, docs), items_frame(spark, [])).collect() == []
    assert lexical.search(docs_frame(spark, [(1, None), (2, "")]), items_frame(spark, ITEMS)).collect() == []


def test_max_tree_opens_few():
    """The search opens a few ranges only, and takes the smallest places of a tie."""
    size = 4096
    term = np.repeat([0, 1], [size, 40])
    place = np.concatenate([np.arange(size), np.arange(40) * 100])
    gain = np.concatenate([np.full(size, 3), np.full(40, 1000)])
    trees = lexical.Trees(term, place, gain, size)
    opened = []
    plain = trees.bounds
    trees.bounds = lambda *x: opened.append(x) or plain(*x)
    assert trees.best(np.array([0, 1]), 5) == [(1003, 100 * i) for i in range(5)]
    assert len(opened) < 20
    assert trees.best(np.array([0]), 3) == [(3, 0), (3, 1), (3, 2)]
    assert trees.best(np.array([1]), 3, floor=1001) == []
