"""Best-fit packing of tokenised documents into sequences.

Best-fit decreasing over all pieces, with a segment tree over remaining capacities
that finds the tightest open bin in logarithmic time. Pieces of one length are
interchangeable, so the packer needs only how many pieces each length has: at most
4096 numbers leave the executors, whatever the size of the corpus. It places equal
pieces in runs (as best fit would, one by one: a bin that takes one stays the
tightest while it can take another) and returns a plan of runs, which the executors
apply to each piece by its rank among the pieces of its length.

Ranks come from fixed buckets of pieces, numbered inside each bucket and shifted by
the bucket's place, so a length that a third of all pieces share is spread over all
buckets.

Defined results: null text is empty and gives one piece (the end id alone); repeated
rows are packed as often as they occur; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialise, slim, texts

MAX_TOKENS = 4096
END_ID = 1
#: Distinct words whose ids a worker remembers in each of two generations.
CACHE = 450_000
_BATCH = 128
_MARK = b"\x02"
_SIGNS = b".,;:!?#$%&*|"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """ids of a text, as little-endian unsigned 32-bit bytes, by remembered words.

    The vocabulary drops white space and never merges across it, so a text's ids are
    those of its words one after another. Words are cut at ASCII white space; other
    white space is left to the tokenizer. Signs after a letter always begin a token of
    their own, so those at a word's end are split off before it is remembered. Special
    tokens written out in a text become their ids, as the tokenizer does by default; a
    word that holds one keeps its case, as they are told by exact letters.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.special]
        self.special = re.compile(b"|".join(map(re.escape, special))) if special else None
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        (self.mark,) = self._encode(_MARK.decode())

    def _learn(self, words: list[bytes]) -> None:
        """Many words in one text, a mark between them that none of them contains."""
        plain = [w for w in words if _MARK not in w]
        joined = b" ".join(x for w in plain for x in (w, _MARK)).decode()
        ids = np.array(self._encode(joined), "<u4")
        cuts = np.flatnonzero(ids == self.mark).tolist()
        data, at = ids.tobytes(), 0
        for w, cut in zip(plain, cuts):
            self.known[w] = data[4 * at : 4 * cut]
            at = cut + 1
        for w in words:
            if _MARK in w:
                self.known[w] = np.array(self._encode(w.decode()), "<u4").tobytes()

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _recall(self, words: set[bytes]) -> set[bytes]:
        """Take over what the older generation knows; what is left is new."""
        old = self.older
        met = {w for w in words if w in old}  # intersection() would walk through all of old
        self.known.update((w, old[w]) for w in met)
        return words - met

    def _add(self, words: set[bytes]) -> None:
        new = words.difference(self.known)
        if not new:
            return
        if len(self.known) > CACHE:
            self.older, self.known = self.known, {}
            new = words
        new = self._recall(new)
        stems = {w: s for w in new if w[-1] in _SIGNS and (s := w.rstrip(_SIGNS)) and s.decode()[-1].isalpha()}
        plain = ((new - stems.keys()) | set(stems.values()) | {w[len(s) :] for w, s in stems.items()}).difference(self.known)
        self._learn(list(self._recall(plain)))
        known = self.known
        known.update((w, known[s] + known[w[len(s) :]]) for w, s in stems.items())

    def words(self, text: str) -> list[bytes]:
        """The words of a text, A-Z lower-cased but where a special token stands."""
        low = text.encode().lower()
        if self.special and self.special.search(low):
            return [w if self.special.search(w.lower()) else w.lower() for w in text.encode().split()]
        return low.split()

    def encode(self, split_texts: list[list[bytes]]) -> list[bytes]:
        """The ids of each text, given as its words."""
        self._add(set().union(*split_texts))
        known = self.known.__getitem__
        return [b"".join(map(known, words)) for words in split_texts]


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer_of(path: str) -> WordTokenizer:
    """One for each worker process, kept with the words it knows from one task to the next."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def tokenise(docs: DataFrame, path: str | None = None, limit: int = MAX_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most limit tokens: doc_id, piece, start, length, ids_crc32."""
    rows = slim(docs, doc_id=id_col, text=text_col)
    path = path or default_tokenizer()
    end = np.array([END_ID], "<u4").tobytes()
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tokenizer = tokenizer_of(path)
        for batch in batches:
            where, piece, start, length, crc = [], [], [], [], []
            coded = (
                data + end
                for at in range(0, batch.num_rows, _BATCH)
                for data in tokenizer.encode([tokenizer.words(x) for x in texts(batch.column(1).slice(at, _BATCH))])
            )
            for k, data in enumerate(coded):
                n = len(data) // 4
                for p, at in enumerate(range(0, n, limit)):
                    cut = data[4 * at : 4 * (at + limit)]
                    where.append(k)
                    piece.append(p)
                    start.append(at)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
            numbers = [pa.array(x, t) for x, t in ((piece, pa.int32()), (start, pa.int64()), (length, pa.int64()), (crc, pa.int64()))]
            yield pa.record_batch([batch.column(0).take(pa.array(where, pa.int64())), *numbers], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(run, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint")


class CapacityTree:
    """A segment tree over remaining capacities 0..limit; tightest(n) is the least capacity >= n with an open bin."""

    def __init__(self, limit: int) -> None:
        self.size = 1 << (limit + 1).bit_length()
        self.open = [0] * (2 * self.size)

    def set(self, capacity: int, n_open: int) -> None:
        k = capacity + self.size
        self.open[k] = n_open
        while k > 1:
            k >>= 1
            self.open[k] = self.open[2 * k] + self.open[2 * k + 1]

    def tightest(self, need: int) -> int | None:
        k = need + self.size
        if self.open[k]:
            return need
        while k > 1:  # up to the first ancestor whose right sibling has an open bin, then down its left edge
            if not k & 1 and self.open[k + 1]:
                k += 1
                while k < self.size:
                    k = 2 * k if self.open[2 * k] else 2 * k + 1
                return k - self.size
            k >>= 1
        return None


def best_fit_plan(counts: dict[int, int], limit: int = MAX_TOKENS) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, n pieces, first bin, pieces per bin, offset) of best-fit decreasing.

    The pieces of a run fill successive bins from the first, pieces-per-bin in each,
    beginning at the offset; only the last bin may get fewer.
    """
    runs = []
    bins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # capacity left: ranges (first bin, bins)
    tree, made = CapacityTree(limit), 0

    def put(capacity: int, first: int, n: int) -> None:
        bins[capacity].append((first, n))
        tree.set(capacity, tree.open[capacity + tree.size] + n)

    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        left, rank = counts[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                each = limit // length
                need = -(-left // each)
                first, n, capacity = made, need, limit
                made += need
            else:
                each = capacity // length
                first, n = bins[capacity].pop()
                tree.set(capacity, tree.open[capacity + tree.size] - n)
                if (need := -(-left // each)) < n:
                    put(capacity, first + need, n - need)
                    n = need
            placed = min(left, n * each)
            runs.append((length, rank, placed, first, each, limit - capacity))
            full, rest = divmod(placed, each)
            if full:
                put(capacity - each * length, first, full)
            if rest:
                put(capacity - rest * length, first + full, 1)
            left, rank = left - placed, rank + placed
    return runs


def pack(pieces: DataFrame, limit: int = MAX_TOKENS, buckets: int | None = None) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32)."""
    spark = pieces.sparkSession
    buckets = buckets or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64("rid"), F.lit(buckets)).cast("int")
    pieces = materialise(pieces.withColumn("rid", F.monotonically_increasing_id()).withColumn("bucket", bucket), "pieces")
    sizes = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes = materialise(sizes, "piece-counts")
    counts = {r[0]: r[1] for r in sizes.groupBy("length").agg(F.sum("n")).collect()}  # at most `limit` rows
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = F.row_number().over(Window.partitionBy("bucket", "length").orderBy("rid")) - 1
    ranked = pieces.withColumn("inside", inside).join(shifts, ["bucket", "length"]).withColumn("rank", F.col("shift") + F.col("inside"))
    plan = np.array(sorted(best_fit_plan(counts, limit)) or np.empty((0, 6)), np.int64)
    starts = plan[:, 0] << 44 | plan[:, 1]
    id_type = pieces.schema["doc_id"].dataType.simpleString()

    def place(batches):
        for b in batches:
            length, rank = (b.column(k).to_numpy() for k in ("length", "rank"))
            run = plan[np.searchsorted(starts, length << 44 | rank, side="right") - 1]
            bins, at = np.divmod(rank - run[:, 1], run[:, 4])
            out = [b.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
            out += [pa.array(run[:, 3] + bins), pa.array(run[:, 5] + at * length)]
            yield pa.record_batch(out, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "rank"]
    return ranked.select(*columns).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str | None = None, limit: int = MAX_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """tokenise, then pack."""
    return pack(tokenise(docs, path, limit, id_col, text_col), limit)
