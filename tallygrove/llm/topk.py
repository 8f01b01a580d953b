"""Exact top-k inner products by branch and bound over ball trees.

Rows are cut into shards of SHARD vectors at most, each with a ball tree: a node has the
mean of its vectors, the radius around it, and its smallest place in the order of ids. A query
q can score at most q.c + |q| r in a node (widened by more than rounding can move it). Nodes
are taken in the order of that bound; those whose bound is below the query's current k-th
score are pruned with all that lies below them, and at the k-th score itself unless they hold a
smaller id. A leaf's vectors are scored exactly, in whole numbers.

Queries are rows themselves (a stated share of all), in blocks of QUERIES. First every block
searches one shard: the k-th scores found there are a start for all shards. Then
tiles of about STRIP shards by GROUP blocks are searched each in one task, where every block
passes its current k-th scores from shard to shard. A tile's bytes have a bound
whatever the input's size; the k best of each tile meet in a window by query.

Defined results: a vector that is null or has a null or non-finite component takes no part;
scaled components beyond 2^27 count as 2^27; vectors of different lengths are not compared;
a null id is no query and as a candidate comes after all others at equal scores; rows that
repeat are rows of their own (a copy of a query's row is a candidate); an empty table gives an
empty result; extra columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialise
from ._vectors import matrix, same_kind, unpacked, vector_rows

SHARD = 4096
LEAF = 64
QUERIES = 512
STRIP = 16
GROUP = 64
_LAST = np.iinfo(np.int64).max
#: Below every score.
_NONE = -(1 << 62)
_NODE = np.dtype([("start", "<i4"), ("stop", "<i4"), ("left", "<i4"), ("radius", "<f8"), ("least", "<i8")])
_BLOCK = "dims int, block long, ids binary, rids binary, points binary"
_SHARD = "dims int, shard long, ids binary, rids binary, points binary, nodes binary, centres binary"


def ball_tree(points: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, nodes, centres): node i has children left and left + 1 unless left is 0; leaves keep the order of ids."""
    order = np.argsort(ids, kind="stable")
    nodes: list[tuple] = []
    centres: list[np.ndarray] = []
    waiting = [(0, len(points))]
    at = 0
    while at < len(waiting):
        start, stop = waiting[at]
        at += 1
        mine = order[start:stop]
        rows = points[mine].astype(np.float64)
        centre = rows.mean(axis=0)
        gap = rows - centre
        far = np.einsum("ij,ij->i", gap, gap)
        left = 0
        if stop - start > leaf and far.max() > 0:
            one = rows[far.argmax()]
            away = rows - one
            along = rows @ (rows[np.einsum("ij,ij->i", away, away).argmax()] - one)
            half = (stop - start) // 2
            upper = np.zeros(stop - start, bool)
            upper[np.argpartition(along, half)[half:]] = True
            order[start:stop] = np.concatenate([mine[~upper], mine[upper]])  # each half still in the order of ids
            left = len(waiting)
            waiting += [(start, start + half), (start + half, stop)]
        nodes.append((start, stop, left, float(np.sqrt(far.max())), int(ids[mine].min())))
        centres.append(centre)
    return order, np.array(nodes, _NODE), np.array(centres)


class Shard:
    def __init__(self, ids: np.ndarray, rids: np.ndarray, points: np.ndarray, nodes: np.ndarray, centres: np.ndarray) -> None:
        self.ids, self.rids, self.points, self.nodes, self.centres = ids, rids, points, nodes, centres


class Best:
    """The k best of some queries: score, id and row of each, best first; absent ones have the least score."""

    def __init__(self, queries: np.ndarray, rids: np.ndarray, k: int, floor: np.ndarray | None = None) -> None:
        self.queries, self.rids, self.k = queries, rids, k
        self.score = np.full((len(queries), k), _NONE)
        self.id, self.rid = np.full((len(queries), k), _LAST), np.full((len(queries), k), -1)
        #: scores known to be reached by k rows somewhere
        self.floor = np.full(len(queries), _NONE) if floor is None else floor
        self.norms = np.sqrt(np.einsum("ij,ij->i", queries.astype(np.float64), queries.astype(np.float64)))

    def worth(self, bound: np.ndarray, least: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Whether nodes of these bounds and smallest ids may change the k best of the queries own."""
        last = self.score[own, -1]
        beats = (bound > last) | ((bound == last) & (least <= self.id[own, -1]))
        return beats & (bound >= self.floor[own])

    def take(self, own: np.ndarray, scores: np.ndarray, ids: np.ndarray, rids: np.ndarray) -> None:
        """Offer rows, in the order of ids, to the queries own."""
        scores = np.where(self.rids[own, None] == rids, _NONE, scores)  # a row is no candidate of its own
        some = self.worth(scores.max(axis=1), np.int64(ids[0]), own)
        own, scores = own[some], scores[some]
        if not len(own):
            return
        if scores.shape[1] > 4 * self.k:  # the k best of a row of scores, at equal scores those of smaller ids: a stable order by score
            cut = np.argsort(-scores, axis=1, kind="stable")[:, : self.k]
        else:
            cut = np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
        score = np.concatenate([self.score[own], np.take_along_axis(scores, cut, 1)], axis=1)
        ident, row = np.concatenate([self.id[own], ids[cut]], axis=1), np.concatenate([self.rid[own], rids[cut]], axis=1)
        row[score == _NONE] = -1
        first = np.lexsort((row, ident, -score), axis=1)[:, : self.k]
        for name, table in (("score", score), ("id", ident), ("rid", row)):
            getattr(self, name)[own] = np.take_along_axis(table, first, 1)

    def search(self, shard: Shard) -> None:
        """Branch and bound: every query takes its open leaves by falling bound, in waves of 1, 2, 4, ..., and prunes after each."""
        nodes = shard.nodes
        reach = (self.queries.astype(np.float64) @ shard.centres.T) + self.norms[:, None] * nodes["radius"]
        reach = np.floor(reach + np.abs(reach) * 1e-9 + 1e-3)  # scores are whole
        everyone = np.arange(len(self.queries))
        pending, wave = None, 1
        while True:
            open_leaf = self._open(nodes, reach, everyone)
            if pending is not None:
                open_leaf &= pending
            if not open_leaf.any():
                return
            pending = open_leaf.copy()
            ranked = np.where(open_leaf, reach, -np.inf)
            first = np.argsort(-ranked, axis=1, kind="stable")[:, :wave]
            q = np.repeat(everyone, first.shape[1])
            leaf = first.ravel()
            there = open_leaf[q, leaf]
            q, leaf = q[there], leaf[there]
            pending[q, leaf] = False
            for n in np.unique(leaf).tolist():
                own = q[leaf == n]
                own = own[self.worth(reach[own, n], nodes["least"][n], own)]
                if len(own):
                    lot = slice(nodes["start"][n], nodes["stop"][n])
                    left, right = same_kind(self.queries[own], shard.points[lot])
                    self.take(own, (left @ right.T).astype(np.int64), shard.ids[lot], shard.rids[lot])
            wave *= 2

    def _open(self, nodes: np.ndarray, reach: np.ndarray, everyone: np.ndarray) -> np.ndarray:
        """Of each query, the leaves that no bound on the way from the root closes."""
        is_open = np.zeros(reach.shape, bool)
        is_open[:, 0] = True
        for n, left in enumerate(nodes["left"].tolist()):  # parents stand before children
            if (on := is_open[:, n]).any():
                on &= self.worth(reach[:, n], nodes["least"][n], everyone)
                if left:
                    is_open[:, left] = is_open[:, left + 1] = on
                    is_open[:, n] = False
        return is_open


def _longs(buffer) -> np.ndarray:
    return np.frombuffer(buffer, "<i8")


def make_shards(rows: DataFrame, size: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """Shards with ball trees, of rows (rid, vec_id, v); a shard holds vectors of one length."""

    def made(shard: int, dims: int, parts: list) -> pa.RecordBatch:
        ids, rids, points = (np.concatenate(x) for x in zip(*parts))
        order, nodes, centres = ball_tree(_points(points.tobytes(), dims, len(ids)), ids, leaf)
        values = [dims, shard, *(x[order].tobytes() for x in (ids, rids, points)), nodes.tobytes(), centres.tobytes()]
        return pa.record_batch([pa.array([x]) for x in values], [x.split()[0] for x in _SHARD.split(", ")]).cast(_ARROW_SHARD)

    def run(batches):
        held: dict[int, list] = {}
        for b in batches:
            rids, ids = b.column(0).to_numpy(), b.column(1).fill_null(_LAST).to_numpy()
            lengths = b.column(2).value_lengths().to_numpy()
            for dims in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == dims)
                points = matrix(b.column(2).take(pa.array(mine)), dims) if dims else np.zeros((len(mine), 0), np.int32)
                at = 0
                while at < len(mine):
                    parts = held.setdefault(dims, [])
                    n = min(size - sum(len(x[0]) for x in parts), len(mine) - at)
                    parts.append((ids[mine[at : at + n]], rids[mine[at : at + n]], points[at : at + n]))
                    at += n
                    if sum(len(x[0]) for x in parts) == size:
                        yield made(int(parts[0][1][0]), dims, held.pop(dims))
        for dims, parts in held.items():
            yield made(int(parts[0][1][0]), dims, parts)

    return rows.mapInArrow(run, _SHARD)


_ARROW_SHARD = pa.schema([("dims", pa.int32()), ("shard", pa.int64()), *((n, pa.binary()) for n in ("ids", "rids", "points", "nodes", "centres"))])
_ARROW_BLOCK = pa.schema([("dims", pa.int32()), ("block", pa.int64()), *((n, pa.binary()) for n in ("ids", "rids", "points"))])


def _points(buffer, dims: int, n: int) -> np.ndarray:
    return unpacked(buffer, dims) if dims else np.zeros((n, 0))


def query_blocks(shards: DataFrame, every: int, most: int = QUERIES) -> DataFrame:
    """Blocks of the rows whose id is divisible by every."""

    def made(dims: int, parts: list) -> pa.RecordBatch:
        ids, rids, points = (np.concatenate(x) for x in zip(*parts))
        return pa.record_batch([pa.array([x]) for x in (dims, int(rids[0]), ids.tobytes(), rids.tobytes(), points.tobytes())], _ARROW_BLOCK.names).cast(_ARROW_BLOCK)

    def run(batches):
        held: dict[int, list] = {}
        for b in batches:
            for dims, ids, rids, points in zip(b.column(0).to_pylist(), *(b.column(k) for k in (2, 3, 4))):
                ids, rids = _longs(ids.as_buffer()), _longs(rids.as_buffer())
                points = np.frombuffer(points.as_buffer(), "<i4").reshape(len(ids), dims)
                own = np.flatnonzero((ids % every == 0) & (ids != _LAST))
                for i in range(0, len(own), most):
                    some = own[i : i + most]
                    parts = held.setdefault(dims, [])
                    if parts and sum(len(x[0]) for x in parts) + len(some) > most:
                        yield made(dims, held.pop(dims))
                        parts = held.setdefault(dims, [])
                    parts.append((ids[some], rids[some], points[some]))
        for dims, parts in held.items():
            yield made(dims, parts)

    return shards.select("dims", "shard", "ids", "rids", "points").mapInArrow(run, _BLOCK)


def _shard_of(row: dict) -> Shard:
    ids = _longs(row["ids"])
    nodes = np.frombuffer(row["nodes"], _NODE)
    centres = np.frombuffer(row["centres"]).reshape(len(nodes), -1) if row["dims"] else np.zeros((len(nodes), 0))
    return Shard(ids, _longs(row["rids"]), _points(row["points"], row["dims"], len(ids)), nodes, centres)


def _tile(blocks: pa.Table, shards: pa.Table, k: int) -> list[tuple[dict, Best]]:
    """Every block's search of all shards of its vectors' length, one after the other."""
    loaded = [(row["dims"], _shard_of(row)) for row in shards.to_pylist()]
    out = []
    for row in blocks.to_pylist():
        rids = _longs(row["rids"])
        best = Best(_points(row["points"], row["dims"], len(rids)), rids, k, _longs(row["floor"]) if row.get("floor") else None)
        for dims, shard in loaded:
            if dims == row["dims"]:
                best.search(shard)
        out.append((row, best))
    return out


def top_k(df: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", size: int = SHARD, queries: int = QUERIES, leaf: int = LEAF) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by every, its k best other rows by inner product."""
    spark = df.sparkSession
    rows = vector_rows(df, id_col, vector_col, scale).select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), "v")
    shards = materialise(make_shards(rows, size, leaf), "shards")
    blocks = materialise(query_blocks(shards, every, queries), "query-blocks")
    n_shards, n_blocks = shards.count(), blocks.count()
    # small inputs are spread over the machines, large ones fall into tiles of bounded size
    strips = max(1, -(-n_shards // STRIP), min(n_shards, 2 * spark.sparkContext.defaultParallelism))
    groups = max(1, -(-n_blocks // GROUP))
    strip, group = F.pmod(F.xxhash64("shard"), F.lit(strips)), F.pmod(F.xxhash64("block"), F.lit(groups))

    def seed(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = _tile(left, right, k)
        return pa.table({"block": pa.array([r["block"] for r, _ in found], pa.int64()), "floor": pa.array([b.score[:, -1].astype("<i8").tobytes() for _, b in found], pa.binary())})

    # each block meets one shard, if its lot has any: that of the largest number
    lots = max(1, min(n_shards, n_blocks))
    one = shards.groupBy("dims", F.pmod(F.xxhash64("shard"), F.lit(lots)).alias("lot")).agg(F.max("shard").alias("shard"))
    firsts = shards.join(one, ["dims", "shard"])
    started = blocks.withColumn("lot", F.pmod(F.xxhash64("block"), F.lit(lots)))
    floors = started.groupBy("dims", "lot").cogroup(firsts.groupBy("dims", "lot")).applyInArrow(seed, "block long, floor binary")
    blocks = materialise(blocks.join(floors, "block", "left"), "query-floors")

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        for row, best in _tile(left, right, k):
            real = best.rid >= 0
            own = np.broadcast_to(np.arange(len(best.rids))[:, None], real.shape)[real]
            for column, x in zip(out, (_longs(row["ids"])[own], best.rids[own], best.id[real], best.rid[real], best.score[real])):
                column.append(x)
        return pa.table([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in out], ["query_id", "query_rid", "vec_id", "rid", "score"])

    tiles = strips * groups
    left = blocks.withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1)))).withColumn("tile", F.col("strip") * groups + group).drop("strip")
    right = shards.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("tile", strip * groups + F.col("group")).drop("group")
    n = min(tiles, 10_000)
    found = left.repartition(n, "tile").groupBy("tile").cogroup(right.repartition(n, "tile").groupBy("tile")).applyInArrow(search, "query_id long, query_rid long, vec_id long, rid long, score long")
    best = Window.partitionBy("query_rid").orderBy(F.desc("score"), "vec_id", "rid")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.nullif("vec_id", F.lit(int(_LAST)).cast("long")).alias("vec_id"), "score")
