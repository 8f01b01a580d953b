"""Ranked lexical search with a hierarchical max tree over document ranges for each term.

Documents are read once for each lot of items, and keep of their terms those of the items, with
counts. Corpus figures (documents, terms, documents of a term) are sums over all of it.
Then each task gathers its documents into ranges of RANGE, in the order of ids. A term's
tree has its documents' contributions to a score as leaves, and above each FAN of places their
largest; places without the term are left out. An item's bound for a range is the sum of
its terms' largest contributions there, and a document's is its score. The search goes best
first: the place with the highest bound is opened, at equal bounds the one that begins first,
so a range that may hold a smaller id of the same score is opened before a document
is taken. Documents come out in their final order, and the search ends with the k-th, or once
no bound reaches the k-th score of the ranges that the task has searched before. The k best
of all tasks meet in a window by item.

Defined results: terms are maximal matches of TERM in the whole text, A-Z lower-cased; a
null text has none; an item without terms, or none of whose terms occurs with weight, has no
rows; items and documents that repeat are rows of their own; a null doc_id comes after all
others at equal scores; empty tables give an empty result; extra columns are ignored.

Items are taken in lots of about LOT, so that what is broadcast, the terms of one lot, is
bounded by LOT texts whatever the number of items; each lot is a pass over the documents.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialise, slim

#: Letters and digits of ASCII, and whatever is not ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RANGE = 4096
FAN = 16
LOT = 500
_LAST = np.iinfo(np.int64).max
#: Bytes as terms see them: A-Z lower-cased, other ASCII signs to spaces.
_BYTES = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    """All terms of a text, repeats included, as UTF-8."""
    return (text or "").encode().translate(_BYTES).split()


class Trees:
    """Max trees of all terms over one range of documents, which stand in the order of ids.

    Level 0 has (term, place) with a contribution each, sorted; a level above has (term,
    place // FAN) with the largest.
    """

    def __init__(self, term: np.ndarray, place: np.ndarray, gain: np.ndarray, size: int) -> None:
        self.depth = max(1, math.ceil(math.log(max(size, 2), FAN) - 1e-9))
        self.span = FAN**self.depth
        order = np.argsort(term * self.span + place, kind="stable")
        keys, gains = (term * self.span + place)[order], gain[order]
        self.levels = [(keys, gains)]
        for _ in range(self.depth):
            keys = keys // FAN
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.intp)
            keys, gains = keys[starts], np.maximum.reduceat(gains, starts) if len(starts) else gains
            self.levels.append((keys, gains))

    def bounds(self, own: np.ndarray, level: int, first: int, many: int) -> np.ndarray:
        """Of places first, first + 1, ... at a level: the sum of the terms' largest contributions."""
        keys, gains = self.levels[level]
        wanted = own[:, None] * (self.span // FAN**level) + np.arange(first, first + many)
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        return np.where(keys[at] == wanted, gains[at], 0).sum(axis=0) if len(keys) else np.zeros(many, np.int64)

    def best(self, own: np.ndarray, k: int, floor: int = 1) -> list[tuple[int, int]]:
        """(score, place) of the k best documents of at least floor, best first, the smaller place first at equal scores."""
        out: list[tuple[int, int]] = []
        top = int(self.bounds(own, self.depth, 0, 1)[0])
        heap = [(-top, 0, -self.depth, 0)] if top >= floor else []
        while heap and len(out) < k:
            bound, begin, level, place = heapq.heappop(heap)
            if level == 0:
                out.append((-bound, begin))
                continue
            below = -level - 1
            for j, x in enumerate(self.bounds(own, below, place * FAN, FAN).tolist()):
                if x >= floor:
                    child = place * FAN + j
                    heapq.heappush(heap, (-x, child * FAN**below, -below, child))
        return out


def matched(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, times) of documents with a term: n counts all of them, terms are those of the vocabulary."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        of = known.value
        for b in batches:
            rows, total, own, times = [], [], [], []
            for i, text in enumerate(b.column(1)):
                words = terms(text.as_py())
                if not words:
                    continue
                met = np.fromiter((of.get(w, -1) for w in words), np.int32, len(words))
                found, n = np.unique(met[met >= 0], return_counts=True)
                for column, x in zip((rows, total, own, times), (i, len(words), found, n)):
                    column.append(x)
            yield pa.record_batch([b.column(0).take(pa.array(rows, pa.int64())), pa.array(total, pa.int64()), pa.array(own, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "times"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n bigint, terms array<int>, times array<bigint>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def contributions(tf: np.ndarray, n: np.ndarray, w: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What tf occurrences of a term of weight w add to the score of a document of n terms."""
    m = 10 + (90 * n * n_docs) // n_terms
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _ranges(batches, size: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    rows = 0
    for b in batches:
        at = 0
        while at < b.num_rows:
            part = b.slice(at, size - rows)
            held.append(part)
            at, rows = at + part.num_rows, rows + part.num_rows
            if rows == size:
                yield pa.concat_batches(held)
                held, rows = [], 0
    if held:
        yield pa.concat_batches(held)


def _search_lot(docs: DataFrame, items: list[tuple[int, list[bytes]]], k: int, size: int) -> DataFrame:
    """(item, doc_id, score): of each task and item the k best documents; items are (number, different terms)."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, own in items for t in own}))}
    rows = materialise(matched(docs, vocabulary), "matched")
    n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for r in rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():  # at most the vocabulary
        weights[r["t"]] = weight(n_docs, r["df"])
    queries = [(number, np.array([vocabulary[t] for t in own if weights[vocabulary[t]] > 0], np.int64)) for number, own in items]
    known = docs.sparkSession.sparkContext.broadcast((weights, [q for q in queries if len(q[1])]))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        weights, queries = known.value
        found: dict[int, list[tuple[int, int]]] = {number: [] for number, _ in queries}
        for b in _ranges(batches, size):
            ids = b.column(0).fill_null(_LAST).to_numpy()
            order = np.argsort(ids, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            lengths = b.column(2).value_lengths().to_numpy()
            own, times = (b.column(j).flatten().to_numpy().astype(np.int64) for j in (2, 3))
            gain = contributions(times, np.repeat(b.column(1).to_numpy(), lengths), weights[own], n_docs, n_terms)
            some = gain > 0
            trees = Trees(own[some], np.repeat(place, lengths)[some], gain[some], len(order))
            for number, of in queries:
                best = found[number]  # (score downwards, id)
                floor = -best[-1][0] if len(best) == k else 1
                more = [(-score, int(ids[order[at]])) for score, at in trees.best(of, k, floor)]
                found[number] = sorted(best + more)[:k] if more else best
        lines = [(number, None if i == _LAST else i, -down) for number, best in found.items() for down, i in best]
        yield pa.record_batch([pa.array([x[j] for x in lines], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.int64()))], ["item", "doc_id", "score"])

    told = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "n", "terms", "times").mapInArrow(run, "item bigint, doc_id bigint, score bigint")
    return told.select("item", F.col("doc_id").cast(kind).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = RANGE, lot: int = LOT) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents of positive score."""
    docs = slim(docs, doc_id=id_col, text=text_col)
    numbered = materialise(slim(items, item_id=item_col, text=item_text).withColumn("item", F.monotonically_increasing_id()), "items")
    lots = max(1, -(-numbered.count() // lot))
    parts = []
    for j in range(lots):
        mine = numbered if lots == 1 else numbered.where(F.pmod(F.xxhash64("item"), F.lit(lots)) == j)
        own = [(r["item"], sorted(set(terms(r["text"])))) for r in mine.select("item", "text").collect()]  # about LOT items
        parts.append(materialise(_search_lot(docs, own, k, size), "candidates"))
    found = reduce(DataFrame.unionByName, parts)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
