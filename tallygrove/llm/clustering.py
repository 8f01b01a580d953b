"""Lloyd's clustering with two trees: a cover tree over each block of vectors, and one over the centroids in each round.

A cover tree's node stands for vectors within its radius of its centre, which is one of
them. A node's children are a net: each child's centre is farther than half the node's
scale (a power of two) from the others', and a child's vectors are within that of its
centre; the first child keeps the parent's centre.

A round goes down both trees at once over pairs of a vector node and a centroid node. With
d the distance of centres, any vector of the node has a centroid within d + r of the
vector node's radius, and none of the centroid node nearer than d - r - r'. Pairs whose least
distance is above the vector node's bound are pruned; a node that has one centroid left is
assigned as a whole; pairs of leaves are compared vector by vector, in whole numbers.
Bounds are widened by more than rounding can move them, so ties are always compared.

Blocks hold BLOCK vectors at most, are made once and kept as a table in the shared folder.
Every round reads them, and only sums for each centroid leave a task: the driver gets
k times (components + 2) numbers, whatever the input's size.

Defined results: vectors that are null, of another length, or with a null or non-finite
component are not kept; scaled components beyond 2^27 count as 2^27, so that distances fit
a long; a null vec_id comes after all others at the start; rows that repeat are clustered
each by itself; with fewer than k kept vectors there are as many centroids; an empty table
gives an empty result; extra columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialise
from ._vectors import matrix, runs, same_kind, spread, unpacked, vector_rows

BLOCK = 2048
LEAF = 24
_PAIRS = 1 << 16
_NODE = np.dtype([("centre", "<i4"), ("start", "<i4"), ("stop", "<i4"), ("first", "<i4"), ("children", "<i4"), ("radius", "<f8")])


def cover_tree(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes): nodes in breadth-first order over the places start to stop of points[order]; node 0 is the root.

    A node of at most leaf vectors, or of equal ones, has no children.
    """
    if not len(points):
        return np.zeros(0, np.intp), np.zeros(0, _NODE)
    everything = np.arange(len(points))
    nodes: list[list] = []
    waiting = [(everything, 0, _distances(points, everything, 0), 0)]
    order = np.empty(len(points), np.intp)
    at = 0
    while at < len(waiting):
        members, centre, far, start = waiting[at]
        at += 1
        radius = float(far.max())
        node = [centre, start, start + len(members), 0, 0, radius]
        nodes.append(node)
        if len(members) <= leaf or radius == 0:
            order[start : start + len(members)] = members
            continue
        scale = 2.0 ** (math.ceil(math.log2(radius)) - 1)  # half the power of two that covers the node
        node[3] = len(waiting)
        while len(members):
            near = far <= scale
            waiting.append((members[near], centre, far[near], start))
            start += int(near.sum())
            members = members[~near]
            if len(members):
                centre = int(members[0])
                far = _distances(points, members, centre)
        node[4] = len(waiting) - node[3]
    out = np.array([tuple(x) for x in nodes], _NODE)
    place = np.empty(len(points), np.int32)
    place[order] = everything
    out["centre"] = place[out["centre"]]
    return order, out


def _distances(points: np.ndarray, members: np.ndarray, centre: int) -> np.ndarray:
    gap = points[members] - points[centre]
    return np.sqrt(np.einsum("ij,ij->i", gap, gap).astype(np.float64))


def nearest(points: np.ndarray, nodes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The number of each point's nearest centroid, the smaller one at equal distance; nodes is the cover tree of points."""
    different, number = np.unique(centroids, axis=0, return_index=True)
    order, tree = cover_tree(different, 1)
    different, number = different[order], number[order]
    points, different = same_kind(points, different)
    label = np.empty(len(points), np.int64)
    frontiers = [(np.zeros(1, np.intp), np.zeros(1, np.intp))] if len(points) else []
    while frontiers:
        v, c = frontiers.pop()  # pairs, those of a vector node together
        begins = runs(v)
        if len(v) > _PAIRS and len(begins) > 1:
            half = begins[len(begins) // 2]
            frontiers += [(v[:half], c[:half]), (v[half:], c[half:])]
            continue
        gap = points[nodes["centre"][v]] - different[tree["centre"][c]]
        d = np.sqrt(np.einsum("ij,ij->i", gap, gap).astype(np.float64))
        r, rc = nodes["radius"][v], tree["radius"][c]
        lengths = np.diff(np.append(begins, len(v)))
        bound = np.repeat(np.minimum.reduceat(d + r, begins), lengths)
        stays = d - r - rc <= bound * (1 + 1e-9) + 1e-6
        v, c, rc = v[stays], c[stays], rc[stays]
        begins = runs(v)
        lengths = np.diff(np.append(begins, len(v)))
        own = v[begins]
        inner_c = tree["children"][c] > 0
        widest = np.maximum.reduceat(np.where(inner_c, rc, -1.0), begins)
        single = (lengths == 1) & (widest < 0)
        for node, centroid in zip(nodes[own[single]], c[begins[single]]):
            label[node["start"] : node["stop"]] = number[tree["start"][centroid]]
        inner_v = nodes["children"][own] > 0
        open_c = ~single & (widest >= 0) & (~inner_v | (widest > nodes["radius"][own]))
        open_v = ~single & ~open_c & inner_v
        compare = ~single & ~open_c & ~inner_v
        if open_c.any():
            mine = np.repeat(open_c, lengths)
            pv, pc = v[mine], c[mine]
            many = np.where(tree["children"][pc] > 0, tree["children"][pc], 1)
            first = np.where(tree["children"][pc] > 0, tree["first"][pc], pc)
            frontiers.append((np.repeat(pv, many), spread(first, many)))
        if open_v.any():
            places = np.flatnonzero(open_v)
            pv, pc = [], []
            for i in places.tolist():
                node, some = nodes[own[i]], c[begins[i] : begins[i] + lengths[i]]
                pv.append(np.repeat(np.arange(node["first"], node["first"] + node["children"]), len(some)))
                pc.append(np.tile(some, node["children"]))
            frontiers.append((np.concatenate(pv), np.concatenate(pc)))
        for i in np.flatnonzero(compare).tolist():
            node, some = nodes[own[i]], c[begins[i] : begins[i] + lengths[i]]
            _compare(label, points, different, number, node, tree["start"][some])
    return label


def _compare(label: np.ndarray, points: np.ndarray, different: np.ndarray, number: np.ndarray, node: np.ndarray, some: np.ndarray) -> None:
    """Label the vectors of a leaf by exact comparison with some centroids."""
    some = some[np.argsort(number[some])]
    gap = points[node["start"] : node["stop"], None, :] - different[None, some, :]
    label[node["start"] : node["stop"]] = number[some][np.einsum("ijk,ijk->ij", gap, gap).argmin(axis=1)]


def squared_distances(points: np.ndarray, centroids: np.ndarray, label: np.ndarray) -> np.ndarray:
    points, centroids = same_kind(points, centroids)
    gap = points - centroids[label]
    return np.einsum("ij,ij->i", gap, gap).astype(np.int64)


def make_blocks(vectors: DataFrame, dims: int, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """(ids, points, nodes): blocks of (vec_id, v) with their cover trees; points stand in the tree's order."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def made(ids: list[pa.Array], rows: list[np.ndarray]) -> pa.RecordBatch:
        points = np.concatenate(rows)
        order, nodes = cover_tree(unpacked(points.tobytes(), dims), leaf)
        told = pa.concat_arrays(ids).take(pa.array(order))
        columns = [pa.ListArray.from_arrays(pa.array([0, len(told)], pa.int32()), told), pa.array([points[order].tobytes()]), pa.array([nodes.tobytes()])]
        return pa.record_batch(columns, ["ids", "points", "nodes"])

    def run(batches):
        ids, rows, held = [], [], 0
        for b in batches:
            some, at = matrix(b.column(1), dims), 0
            while at < len(some):
                part = some[at : at + block - held]
                ids.append(b.column(0).slice(at, len(part)))
                rows.append(part)
                at, held = at + len(part), held + len(part)
                if held == block:
                    yield made(ids, rows)
                    ids, rows, held = [], [], 0
        if held:
            yield made(ids, rows)

    return vectors.mapInArrow(run, f"ids array<{kind}>, points binary, nodes binary")


def _blocks(batches, dims: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for b in batches:
        for ids, points, nodes in zip(*(b.column(k) for k in range(3))):
            yield ids.values, unpacked(points.as_buffer(), dims), np.frombuffer(nodes.as_buffer(), _NODE)


def lloyd(blocks: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """The centroids after some rounds: each the componentwise floor of its vectors' mean; empty ones stay."""
    for _ in range(rounds):
        centroids = _round(blocks, centroids)
    return centroids


def _round(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    dims = centroids.shape[1]

    def run(batches):
        sums = [[0] * (dims + 1) for _ in centroids]
        for _, points, nodes in _blocks(batches, dims):
            label = nearest(points, nodes, centroids)
            order = np.argsort(label, kind="stable")
            begins = runs(label[order])
            totals = np.add.reduceat(points[order].astype(np.int64), begins)
            counts = np.diff(np.append(begins, len(order)))
            for k, total, n in zip(label[order][begins].tolist(), totals.tolist(), counts.tolist()):
                sums[k] = [x + y for x, y in zip(sums[k], [*total, n])]
        rows = [(k, j, x) for k, row in enumerate(sums) if row[-1] for j, x in enumerate(row)]
        yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64()))], ["k", "j", "x"]) if rows else _NO_SUMS

    added = blocks.mapInArrow(run, "k int, j int, x bigint").groupBy("k", "j").agg(F.sum(F.col("x").cast("decimal(28,0)")).alias("x"))
    of: dict[tuple[int, int], int] = {(r["k"], r["j"]): int(r["x"]) for r in added.collect()}  # k * (dims + 1) rows at most
    means = [[of[k, j] // of[k, dims] for j in range(dims)] if (k, dims) in of else row for k, row in enumerate(centroids.tolist())]
    return _whole(means, dims)


_NO_SUMS = pa.record_batch([pa.array([], t) for t in (pa.int32(), pa.int32(), pa.int64())], ["k", "j", "x"])


def _whole(rows: list[list[int]], dims: int) -> np.ndarray:
    return unpacked(np.array(rows, "<i4").reshape(-1, dims).tobytes(), dims)


def assign(blocks: DataFrame, centroids: np.ndarray, id_type: str) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    dims = centroids.shape[1]

    def run(batches):
        for ids, points, nodes in _blocks(batches, dims):
            label = nearest(points, nodes, centroids)
            distance = squared_distances(points, centroids, label)
            yield pa.record_batch([ids, pa.array(label.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(run, f"vec_id {id_type}, cluster int, distance bigint")


def cluster_vectors(
    df: DataFrame, k: int = 8, rounds: int = 10, scale: int = 1024, dims: int = 64, salt: str = "3:", id_col: str = "vec_id", vector_col: str = "embedding",
    block: int = BLOCK, leaf: int = LEAF,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each kept vector.

    The first centroids are the k kept vectors with the smallest sha256 of salt and vec_id.
    """
    vectors = vector_rows(df, id_col, vector_col, scale).where(F.size("v") == dims)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    drawn = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.select(drawn.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    if not first:
        return vectors.select("vec_id", *(F.lit(None).cast(t).alias(n) for n, t in _TOLD))
    blocks = materialise(make_blocks(vectors, dims, block, leaf), "vector-blocks")
    centroids = lloyd(blocks, _whole([r["v"] for r in first], dims), rounds)
    told = materialise(assign(blocks, centroids, kind), "clusters")
    inertia = {r["cluster"]: r["s"] for r in told.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    of_cluster = {c: (s, hashlib.sha256(",".join(str(int(x)) for x in centroids[c]).encode()).hexdigest()) for c, s in inertia.items()}
    fixed = F.create_map(*chain.from_iterable((F.lit(c), F.struct(F.lit(s).cast("long").alias("s"), F.lit(h).alias("h"))) for c, (s, h) in of_cluster.items()))
    own = fixed[F.col("cluster")]
    return told.select(
        "vec_id", "cluster", "distance", own["s"].alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"), own["h"].alias("centroid_sha256")
    )


_TOLD = (("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string"))
