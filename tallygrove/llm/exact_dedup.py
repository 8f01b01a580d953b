"""Exact dedup by composable polynomial fingerprints.

A chunk of bytes b_0..b_{n-1} has the hash sum(b_i * base^(n-1-i)) mod p, for four
bases. Two hashes combine by length-shifted arithmetic,
H(AB) = H(A) * base^len(B) + H(B), so the chunks of a huge document are hashed
apart (one matrix product for all chunks of a document, or in different tasks with
chunk_fingerprints and combine_fingerprints) and joined afterwards. Equal
fingerprints only nominate: each row of such a group is compared with the group's
representative, chunk by chunk, and the comparison ends at the first difference.

Defined results: null text counts as empty, so null and empty texts are equal;
a null doc_id is smaller than any other; if rows repeat with the same doc_id and
text, one of them stays; an empty table gives an empty result; extra columns of the
input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ._common import materialise, slim

PRIME = 2**31 - 1
BASES = (1_103_515_245, 1_664_525_061, 1_812_433_253, 69_069_077)
#: 8192 products below 2^39 add up below 2^53, so float64 products are exact.
CHUNK = 8192
_FP = "struct<a:bigint,b:bigint,n:bigint>"
_NAMES = ("fa", "fb", "fn")
#: The bound of the broadcast that tells which texts may be in a group.
SLOTS = 1 << 20


def _powers() -> np.ndarray:
    out = np.empty((CHUNK, len(BASES)))
    for k, base in enumerate(BASES):
        x = 1
        for i in range(CHUNK - 1, -1, -1):
            out[i, k] = x
            x = x * base % PRIME
    return out


class Hasher:
    """Hashes bytes; hash(x) is (residues, length)."""

    def __init__(self) -> None:
        self.powers = _powers()
        self.full = [pow(b, CHUNK, PRIME) for b in BASES]

    def chunk(self, data: np.ndarray) -> list[int]:
        return [int(x) % PRIME for x in data.astype(np.float64) @ self.powers[CHUNK - len(data) :]]

    def hash(self, data: bytes) -> tuple[list[int], int]:
        raw = np.frombuffer(data, np.uint8)
        whole = len(raw) // CHUNK
        state = [0] * len(BASES)
        for at in range(0, whole, 512):  # 4 MB at a time
            part = raw[at * CHUNK : min(whole, at + 512) * CHUNK].reshape(-1, CHUNK)
            for row in (part.astype(np.float64) @ self.powers).tolist():
                state = [(s * f + int(h)) % PRIME for s, f, h in zip(state, self.full, row)]
        if rest := len(raw) - whole * CHUNK:
            tail = self.chunk(raw[whole * CHUNK :])
            state = combine(state, tail, rest) if whole else tail
        return state, len(raw)


def combine(left: list[int], right: list[int], right_length: int) -> list[int]:
    """The residues of the concatenation."""
    return [(x * pow(b, right_length, PRIME) + y) % PRIME for x, y, b in zip(left, right, BASES)]


def _packed(items) -> pa.Array:
    a, b, n = [], [], []
    for (h0, h1, h2, h3), length in items:
        a.append(h0 << 31 | h1)
        b.append(h2 << 31 | h3)
        n.append(length)
    return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], ["a", "b", "n"])


def _bytes_of(array: pa.Array):
    for value in array:
        yield b"" if (buffer := value.as_buffer()) is None else buffer


def fingerprint_udf():
    hasher: list[Hasher] = []

    @arrow_udf(_FP)
    def fingerprint(text: pa.Array) -> pa.Array:
        if not hasher:
            hasher.append(Hasher())
        return _packed(hasher[0].hash(x) for x in _bytes_of(text))

    return fingerprint


def chunk_fingerprints(chunks: DataFrame, doc: str = "doc_id", number: str = "chunk", text: str = "text") -> DataFrame:
    """For documents stored as rows of chunks: each chunk's fingerprint, hashed wherever the chunk lies."""
    rows = slim(chunks, doc_id=doc, chunk=number, text=text)
    return rows.select("doc_id", "chunk", fingerprint_udf()(F.coalesce("text", F.lit(""))).alias("fp"))


def combine_fingerprints(chunked: DataFrame) -> DataFrame:
    """One fingerprint for each document out of its chunks' fingerprints; no text moves."""

    @arrow_udf(_FP)
    def fold(parts: pa.Array) -> pa.Array:
        def one(items):
            state, total = [0] * 4, 0
            for x in items or ():
                f = x["fp"]
                state = combine(state, [f["a"] >> 31, f["a"] & PRIME, f["b"] >> 31, f["b"] & PRIME], f["n"])
                total += f["n"]
            return state, total

        return _packed(one(x.as_py()) for x in parts)

    parts = chunked.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("chunk", "fp"))).alias("parts"))
    return parts.select("doc_id", fold("parts").alias("fp"))


def same_text_udf():
    """Chunkwise comparison of two texts, ending at the first chunk that differs."""

    @arrow_udf("boolean")
    def same(left: pa.Array, right: pa.Array) -> pa.Array:
        def equal(x, y) -> bool:
            if len(x) != len(y):
                return False
            x, y = memoryview(x), memoryview(y)
            return all(x[i : i + CHUNK] == y[i : i + CHUNK] for i in range(0, len(x), CHUNK))

        return pa.array([equal(x, y) for x, y in zip(_bytes_of(left), _bytes_of(right))], pa.bool_())

    return same


def _marked(rows: DataFrame, fingerprint) -> DataFrame:
    """The rows with their fingerprint as the columns of _NAMES."""
    marked = rows.withColumn("fp", (fingerprint or fingerprint_udf())("text"))
    return marked.select("*", *(F.col(f"fp.{name[-1]}").alias(name) for name in _NAMES)).drop("fp")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fingerprint=None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Sizes of groups come from rows without texts. Only texts that may be in a group of
    two or more are shuffled, for the comparison: a scan is filtered by the slots (a
    hash of the fingerprint modulo SLOTS) that groups fall in, which is a broadcast of at
    most SLOTS numbers whatever the input's size; a wrong slot match costs one row's
    shuffle and no more. Adaptive execution splits a hot fingerprint, as the groups'
    side of each join is a table with one row a key. fingerprint replaces the hash in
    tests, to force collisions.
    """
    rows = slim(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    narrow = materialise(_marked(rows, fingerprint).select("doc_id", sha.alias("text_sha256"), *_NAMES), "exact-narrow")
    groups = narrow.groupBy(*_NAMES).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # a table of its own: a join with an aggregate on the same key could not be split on a hot fingerprint
    groups = materialise(groups.where("group_size > 1"), "exact-sizes")
    single = narrow.join(groups.select(*_NAMES, "group_size"), list(_NAMES), "left").where("group_size is null")
    single = single.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")

    slot = F.pmod(F.xxhash64(*_NAMES), F.lit(SLOTS)).alias("slot")
    slots = F.broadcast(groups.select(slot).distinct())  # at most SLOTS rows
    some = _marked(rows, fingerprint).withColumn("slot", slot).join(slots, "slot", "left_semi").drop("slot")
    members = some.join(groups, list(_NAMES)).select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", sha.alias("text_sha256"), "text", *_NAMES, "keep_id", "group_size"
    )
    members = materialise(members, "exact-members")
    names = list(_NAMES)
    stays = members.where("doc_id <=> keep_id").groupBy(*names).agg(F.min("rid").alias("keep_rid"))
    firsts = members.where("doc_id <=> keep_id").select("rid", F.col("text").alias("keep_text"))
    firsts = firsts.join(stays.withColumnRenamed("keep_rid", "rid"), "rid")
    firsts = firsts.withColumnRenamed("rid", "keep_rid")
    compared = members.join(firsts, names).withColumn("same", same_text_udf()("text", "keep_text")).drop("keep_text")
    verdict = materialise(compared.select("rid", "doc_id", "keep_id", "keep_rid", "group_size", "text_sha256", "same", *names), "exact-verdicts")
    clashing = verdict.where("not same").select(*names).distinct()
    if clashing.isEmpty():
        many = verdict
    else:  # different texts under one fingerprint: those groups are formed again by the text itself
        many = verdict.join(clashing, names, "left_anti")
        again = members.join(clashing, names, "left_semi")
        by_text = again.groupBy("text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        again = again.drop("keep_id", "group_size").join(by_text, "text")
        top = again.where("doc_id <=> keep_id").groupBy("text").agg(F.min("rid").alias("keep_rid"))
        many = many.select("rid", "doc_id", "keep_id", "keep_rid", "group_size", "text_sha256").unionByName(
            again.join(top, "text").select("rid", "doc_id", "keep_id", "keep_rid", "group_size", "text_sha256")
        )
    many = many.select("doc_id", "keep_id", "group_size", F.expr("rid = keep_rid").alias("kept"), "text_sha256")
    return single.unionByName(many)
