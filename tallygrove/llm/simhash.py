"""SimHash near-dedup by tiled exact comparison.

Fingerprints: whole texts, A-Z lower-cased, words [^\\x20\\x09-\\x0D]+, 3-word
shingles with repeats, XXH64 with seed 42; a bit is 1 if set in over half of the
shingles' hashes. Texts of fewer words are one shingle; those of none have the
fingerprint zero and are linked like any other.

Comparison: equal fingerprints are one node. Nodes are dealt to blocks by population
count; a pair of blocks whose counts differ by more than the radius cannot hold a
link and is never formed. Inside a pair, nodes are sorted into tiles by the
population counts of their four 16-bit parts, tiles further apart than the radius
(sum of absolute differences) are skipped, and the rest are compared in full by
numpy exclusive-or and bit counts. A task emits a spanning forest of what it links,
never the pairs.

Defined results: null text is empty; null doc_id is never a component_id unless the
whole component has no other; repeated rows each get a row; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ._common import materialise, slim
from ._components import components

SEED = 42
RADIUS = 3
_STEP = 1 << 15


def fingerprint(text: str) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = text.encode().lower().split()  # bytes: lower() and split() know ASCII only
    if not words:
        return 0
    n = max(1, len(words) - 2)
    if len(words) < 3:
        words = [b" ".join(words), b""]
    counts = np.zeros(64, np.int64)
    digest, seed, join = xxhash.xxh64_intdigest, SEED, b" ".join
    for at in range(0, n, _STEP):
        part = words[at : at + _STEP + 2]
        if n == 1 and len(words) == 2:
            hashes = [digest(words[0], seed)]
        else:
            hashes = [digest(join(x), seed) for x in zip(part, part[1:], part[2:])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint_udf():
    @arrow_udf("bigint")
    def simhash(text: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x.as_py() or "") for x in text], pa.int64())

    return simhash


def _find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if np.array_equal(up, x):
            return x
        x = up


def _link(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union of all pairs (i, j): roots take the least root they meet, until none differ."""
    while True:
        i, j = _find(parent, i), _find(parent, j)
        apart = i != j
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(parent, np.maximum(i, j), np.minimum(i, j))


def _tiles(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the values by tile, each tile's four population counts, and where it begins."""
    parts = np.bitwise_count(values.view("<u2").reshape(-1, 4)).astype(np.int64)
    code = ((parts[:, 0] * 17 + parts[:, 1]) * 17 + parts[:, 2]) * 17 + parts[:, 3]
    order = np.argsort(code, kind="stable")
    _, first = np.unique(code[order], return_index=True)
    return order, parts[order][first], np.append(first, len(values))


def link_blocks(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest (node, root) of the links between left and right, or within left if right is None."""
    values = left if right is None else np.concatenate([left, right])
    parent = np.arange(len(values))
    lo, lo_counts, lo_at = _tiles(left)
    hi, hi_counts, hi_at = (lo, lo_counts, lo_at) if right is None else _tiles(right)
    base = 0 if right is None else len(left)
    lo_bits, hi_bits = left[lo], (left if right is None else right)[hi]
    for t in range(len(lo_counts)):
        close = np.abs(hi_counts - lo_counts[t]).sum(axis=1) <= radius
        if right is None:
            close[:t] = False
        near = np.flatnonzero(close)
        if not len(near):
            continue
        rows = np.concatenate([np.arange(hi_at[k], hi_at[k + 1]) for k in near])
        other = hi_bits[rows]
        a0, a1 = lo_at[t], lo_at[t + 1]
        step = max(1, (1 << 21) // len(rows))
        for a in range(a0, a1, step):
            mine = lo_bits[a : min(a1, a + step)]
            i, j = np.nonzero(np.bitwise_count(mine[:, None] ^ other[None, :]) <= radius)
            if len(i):
                _link(parent, lo[a + i], hi[rows[j]] + base)
    root = _find(parent, np.arange(len(values)))
    moved = np.flatnonzero(root != np.arange(len(values)))
    signed = values.view(np.int64)
    return list(zip(signed[moved].tolist(), signed[root[moved]].tolist()))


def _pair_group(table: pa.Table) -> pa.Table:
    data = {k: table.column(k).to_numpy() for k in ("fp", "side")}
    fp, side = data["fp"].view(np.uint64), data["side"]
    left, right = fp[side == 0], fp[side == 1]
    same = bool((side == 2).any())
    forest = link_blocks(fp, None) if same else link_blocks(left, right) if len(left) and len(right) else []
    return pa.table({"u": pa.array([x for x, _ in forest], pa.int64()), "v": pa.array([y for _, y in forest], pa.int64())})


def block_pairs(nodes: DataFrame, least_block: int = 1 << 14, most_block: int = 1 << 20) -> DataFrame:
    """Each node (fp, pc) once for each pair of blocks that it belongs to: (pair, side, fp).

    A block holds nodes of one population count. The 65 counts are all that reaches
    the driver; they set the number of blocks, so that a pair's rows fit in a task. A
    block is an eighth of all nodes or most_block, whichever is less: up to 8 * most_block
    nodes a population count is one block and each node is sent to seven pairs.
    """
    sizes = dict(nodes.groupBy("pc").count().collect())
    block = min(most_block, max(least_block, sum(sizes.values()) // 8))
    parts = [0] * RADIUS + [-(-sizes.get(p, 0) // block) for p in range(65)] + [0] * RADIUS
    counts, most = F.array(*map(F.lit, parts)), max(1, *parts)
    mine = F.when(F.col("own") > 1, F.pmod(F.xxhash64("fp"), F.col("own"))).otherwise(0).cast("int")
    dealt = nodes.withColumn("own", F.element_at(counts, F.col("pc") + RADIUS + 1)).withColumn("slot", mine)

    def towards(d):
        """Pairs with the blocks of population count pc + d."""
        q = F.col("pc") + d
        others = F.slice(F.sequence(F.lit(0), F.lit(most - 1)), F.lit(1), F.element_at(counts, q + RADIUS + 1))

        def pair(t):
            here = F.struct(F.col("pc").cast("int").alias("p"), F.col("slot").alias("s"))
            there = F.struct(q.cast("int").alias("p"), t.cast("int").alias("s"))
            side = F.when(here == there, 2).when(here < there, 0).otherwise(1)
            return F.struct(F.least(here, there).alias("low"), F.greatest(here, there).alias("high"), side.alias("side"))

        return F.transform(others, pair)

    span = F.sequence(F.lit(-RADIUS), F.lit(RADIUS))
    out = dealt.select("fp", F.explode(F.flatten(F.transform(span, towards))).alias("x"))
    pair = F.concat_ws("-", "x.low.p", "x.low.s", "x.high.p", "x.high.s")
    return out.select(pair.alias("pair"), F.col("x.side").cast("int").alias("side"), "fp")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_block: int = 1 << 14, most_block: int = 1 << 20) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id. The block sizes change the plan, not the result."""
    rows = slim(docs, doc_id=id_col, text=text_col)
    marked = materialise(rows.select("doc_id", fingerprint_udf()("text").alias("fp")), "simhash")
    nodes = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    pairs = block_pairs(nodes.select("fp", F.bit_count("fp").alias("pc")), least_block, most_block)
    forest = pairs.groupBy("pair").applyInArrow(_pair_group, "u bigint, v bigint")
    linked = components(forest)
    rooted = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
