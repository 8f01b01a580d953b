"""Hidden Markov language model with exact sequence likelihoods.

Tokens: A-Z lower-cased, words [^\\x20\\x09-\\x0D]+, then one end. Word counts cover all
training documents. The hidden Markov model emits symbols: the most frequent words
each have one, the others share SUFFIXES symbols by the hash of their last two bytes,
and the end has its own; a word given its shared symbol has the add-one probability
(c + 1) / (N_s + V_s + 1) of its count among that symbol's words. Log10 of a text's
probability is the scaled forward recursion's sum plus those words' terms.

Training: ROUNDS of Baum-Welch, each over all training documents, whatever their length.
Each task runs forward and backward over its documents and gives its expected counts
once; they are added by (kind, place) in a shuffle, and at most a table of the model's
size reaches the driver.

A task holds the states' shares of some millions of symbols and of the borders between such
segments, however long a text is (about 0.1 KB for each of its words while it is encoded); the
recursion over one text is one sequence of steps, some 40 microseconds a word and round.

Counts of words: at most DICTIONARY words, the most frequent, are broadcast, by a
threshold on the count that a histogram of counts gives. All other words of each
document meet the whole table of counts in a join, so every token has its count.

Defined results: null text is empty and has one token, the end; without training
documents all counts are zero and the model is uniform over the shared symbols and the end; repeated rows each get a row;
null doc_id counts as training; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialise, slim

STATES = 8
SUFFIXES = 256
WORDS = 4096
DICTIONARY = 200_000
ROUNDS = 14
_CELLS = 1_500_000
_HELD = 1 << 23
_TASK_TOKENS = 1 << 23
_FLUSH = 250_000
_TOGETHER = 1 << 16
#: Symbols of a segment whose shares are held at once.
_STEPS = 2_000_000


def _tokens(value) -> list[bytes]:
    return (value.as_py() or "").encode().lower().split()


def suffix(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % SUFFIXES


class _Tails(dict):
    """The shared symbol of each pair of last bytes, made when it is first met."""

    def __missing__(self, tail: bytes) -> int:
        self[tail] = found = suffix(tail)
        return found


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) over the texts; each task adds up its own before the shuffle."""

    def run(batches):
        seen: Counter = Counter()

        def out():
            items = list(seen.items())
            seen.clear()
            for i in range(0, len(items), 50_000):
                words, counts = zip(*items[i : i + 50_000])
                yield pa.record_batch([pa.array([w.decode() for w in words], pa.string()), pa.array(counts, pa.int64())], ["word", "c"])

        for b in batches:
            for text in b.column(0):
                seen.update(_tokens(text))
                if len(seen) > _FLUSH:
                    yield from out()
        yield from out()

    return docs.select("text").mapInArrow(run, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def _thresholds(counts: DataFrame, sizes: tuple[int, ...]) -> list[int]:
    """For each size, the least count such that at most so many words have it or more."""
    level = F.floor(F.log2("c") * 32).cast("int")
    # a level's words are counted with its least count; there are some 32 levels for each doubling
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).orderBy(F.desc("level")).collect()
    out = []
    for size in sizes:
        total, least = 0, (levels[0]["c"] + 1 << 20) if levels else 1
        for row in levels:
            total += row["n"]
            if total > size:
                break
            least = row["c"]
        out.append(least)
    return out


class Model:
    """start (K), move (K x K: from, to), emit (symbols x K)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, emit

    @property
    def symbols(self) -> int:
        return len(self.emit)

    @classmethod
    def of_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> Model:
        """Most likely model of expected counts, a little smoothed towards the symbols' overall share."""
        start = (start + 0.1) / (start + 0.1).sum()
        move = (move + 0.1) / (move + 0.1).sum(axis=1, keepdims=True)
        emit = emit + 0.5 * share[:, None] * len(share) ** 0.5 + 1e-4
        return cls(start, move, emit / emit.sum(axis=0))

    @classmethod
    def first(cls, share: np.ndarray, seed: int = 7) -> Model:
        """A random start of Baum-Welch, from a fixed seed."""
        rng = np.random.default_rng(seed)
        emit = (share[:, None] + 1e-6) * rng.gamma(2.0, size=(len(share), STATES))
        move = rng.dirichlet(np.full(STATES, 2.0), STATES) * 0.3 + 0.7 * np.eye(STATES)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))

    @classmethod
    def uniform(cls, symbols: int) -> Model:
        return cls(np.full(STATES, 1 / STATES), np.full((STATES, STATES), 1 / STATES), np.full((symbols, STATES), 1 / symbols))


class Batch:
    """Sequences side by side in time, the longest first.

    At place t those longer than t have a symbol each; they are the first ones, so
    nothing is padded, and a step works on a slice. at[t] counts the symbols before place t.
    """

    def __init__(self, own: list[int], sequences: list[np.ndarray]) -> None:
        self.own = own  # the sequences' numbers, longest first
        lengths = np.array([len(sequences[i]) for i in own])
        self.length = int(lengths[0])
        live = np.searchsorted(-lengths, -np.arange(self.length), side="left")
        self.at = np.concatenate([[0], np.cumsum(live)])
        column = np.repeat(np.arange(len(own)), lengths)
        place = np.arange(len(column)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.flat = np.empty(len(column), np.intp)
        self.flat[self.at[place] + column] = np.concatenate([sequences[i] for i in own])

    def __len__(self) -> int:
        return len(self.flat)

    def symbols(self, t: int) -> np.ndarray:
        return self.flat[self.at[t] : self.at[t + 1]]


def batches_of(sequences: list[np.ndarray], most: int = _CELLS):
    """Batches of at most `most` symbols (or one sequence), the long ones together."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    own: list[int] = []
    total = 0
    for i in order:
        if own and total + len(sequences[i]) > most:
            yield Batch(own, sequences)
            own, total = [], 0
        own.append(i)
        total += len(sequences[i])
    if own:
        yield Batch(own, sequences)


class Steps:
    """Single steps of the scaled forward recursion of a batch."""

    def __init__(self, model: Model, batch: Batch, kind) -> None:
        self.batch, self.kind = batch, kind
        self.emit, self.move, self.start = np.ascontiguousarray(model.emit.T, kind), np.ascontiguousarray(model.move.T, kind), model.start.astype(kind)[:, None]

    def emitted(self, t: int, out: np.ndarray | None = None) -> np.ndarray:
        """The probability of each sequence's symbol at place t in each state (K x live)."""
        return self.emit.take(self.batch.symbols(t), axis=1, out=out, mode="clip")

    def forward(self, t: int, before: np.ndarray | None, out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The states' shares (K x live) at place t and the scales' reciprocals, from the shares at the place before."""
        now = self.emitted(t, out)
        now *= self.start if t == 0 else self.move @ before[:, : now.shape[1]]
        inverse = 1 / now.sum(axis=0)
        now *= inverse
        return now, inverse


def forward(model: Model, batch: Batch, kind=np.float64) -> np.ndarray:
    """Scaled forward recursion: log10 likelihood of each sequence of the batch, in the order of own."""
    steps = Steps(model, batch, kind)
    out = np.zeros(len(batch.own))
    now = None
    for t in range(batch.length):
        now, inverse = steps.forward(t, now)
        out[: len(inverse)] -= np.log10(inverse)
    return out


class Expected:
    """Baum-Welch counts of many sequences. Shares are single precision; sums over steps are double."""

    def __init__(self, symbols: int) -> None:
        self.start, self.move, self.emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((symbols, STATES))

    def add(self, model: Model, batch: Batch, most: int = _STEPS) -> None:
        """The way forward keeps the shares at the borders of segments of about `most` symbols; on the way back each segment's are made again.

        So a batch takes memory for a segment and the borders, however long its sequences; one of one segment is gone through once each way.
        """
        steps = Steps(model, batch, np.float32)
        borders = [0]
        for t in range(1, batch.length):
            if batch.at[t + 1] - batch.at[borders[-1]] > most:
                borders.append(t)
        segments = list(zip(borders, [*borders[1:], batch.length]))
        entries: list[np.ndarray | None] = [None]  # the shares before each segment
        for first, end in segments[:-1]:
            now = entries[-1]
            for t in range(first, end):
                now, _ = steps.forward(t, now)
            entries.append(now)
        self.back_move = model.move.astype(np.float32)
        moved = np.zeros((STATES, STATES))
        back = None
        for first, end in reversed(segments):
            back = self._segment(steps, entries.pop(), first, end, moved, back)
        self.move += moved * model.move

    def _segment(self, steps: Steps, entry: np.ndarray | None, first: int, end: int, moved: np.ndarray, back: np.ndarray | None) -> np.ndarray | None:
        """Forward and backward over the places first to end: back is what comes in from behind, the result what goes on before."""
        at = steps.batch.at
        base = at[first]
        shares, inverses = np.empty(STATES * (at[end] - base), np.float32), np.empty(at[end] - base, np.float32)

        def view(t: int) -> np.ndarray:
            return shares[STATES * (at[t] - base) : STATES * (at[t + 1] - base)].reshape(STATES, -1)

        now = entry
        for t in range(first, end):
            now, inverses[at[t] - base : at[t + 1] - base] = steps.forward(t, now, view(t))
        if back is None:
            back = np.ones_like(now)
        wait: list[tuple] = []
        size = 0
        for t in range(end - 1, first - 1, -1):
            gamma = view(t)
            gamma *= back
            wait.append((steps.batch.symbols(t), gamma))
            size += gamma.shape[1]
            if size > _TOGETHER or t == first:
                self._emitted(wait)
                wait, size = [], 0
            if t == 0:
                self.start += gamma.sum(axis=1, dtype=np.float64)
                return None
            emitted = steps.emitted(t)
            emitted *= back
            emitted *= inverses[at[t] - base : at[t + 1] - base]
            before = view(t - 1) if t > first else entry
            live = emitted.shape[1]
            moved += before[:, :live] @ emitted.T
            if live == before.shape[1]:
                back = self.back_move @ emitted
            else:
                back = np.ones_like(before)
                back[:, :live] = self.back_move @ emitted
        return back

    def _emitted(self, wait: list[tuple]) -> None:
        symbols, gamma = np.concatenate([s for s, _ in wait]), np.concatenate([g for _, g in wait], axis=1)
        for k in range(STATES):
            self.emit[:, k] += np.bincount(symbols, weights=gamma[k], minlength=len(self.emit))

    def rows(self):
        """(kind, places, values of each state) of what is not zero; kind 0 start, 1 move, 2 emit."""
        for kind, table in enumerate((self.start[None, :], self.move, self.emit)):
            places = np.flatnonzero(table.any(axis=1))
            yield np.full(len(places), kind), places, table[places]


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), "<u2") for x in column]


def _gathered(groups, most: int = _HELD):
    """Lists of at least `most` symbols, the last of fewer: long sequences of many Arrow batches go side by side."""
    held: list[np.ndarray] = []
    size = 0
    for group in groups:
        held += group
        size += sum(map(len, group))
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def baum_welch(encoded: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts over all encoded sequences, added across partitions."""
    names = [f"v{k}" for k in range(STATES)]

    def run(batches):
        total = Expected(model.symbols)
        for sequences in _gathered(_sequences(b.column(0)) for b in batches):
            for batch in batches_of(sequences):
                total.add(model, batch)
        for kind, place, values in total.rows():
            yield pa.record_batch([pa.array(kind, pa.int32()), pa.array(place, pa.int32()), *map(pa.array, values.T.copy())], ["kind", "place", *names])

    parts = encoded.select("symbols").mapInArrow(run, f"kind int, place int, {', '.join(f'{x} double' for x in names)}")
    out = Expected(model.symbols)
    for r in parts.groupBy("kind", "place").agg(*(F.sum(x).alias(x) for x in names)).collect():
        (out.start[None, :], out.move, out.emit)[r["kind"]][r["place"]] = r[2:]
    return out.start, out.move, out.emit


def score_texts(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, from (doc_id, text, held_out)."""
    spark = docs.sparkSession
    training = docs.where("not held_out")
    counts = materialise(count_words(training), "word-counts")
    dict_least, word_least = _thresholds(counts, (DICTIONARY, WORDS))
    sums = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    n_docs = training.count()
    n_train, vocabulary = int(sums[0] or 0) + n_docs, int(sums[1]) + (1 if n_docs else 0)
    tail = F.col("word").cast("binary")
    shared = F.crc32(F.substring(tail, -2, 2)) % SUFFIXES
    rest = counts.where(F.col("c") < word_least).groupBy(shared.alias("s")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"))
    below = np.ones(SUFFIXES)
    mass = np.zeros(SUFFIXES)
    for r in rest.collect():
        below[r["s"]], mass[r["s"]] = r["n"] + r["v"] + 1, r["n"]
    frequent = sorted((-r["c"], r["word"]) for r in counts.where(F.col("c") >= dict_least).collect())  # at most DICTIONARY rows
    n_words = sum(-c >= word_least for c, _ in frequent)
    end = n_words + SUFFIXES
    share = np.array([*(-c for c, _ in frequent[:n_words]), *mass, n_docs], float) + 0.01
    share /= share.sum()
    below_log = np.log10(below)
    shared_of = np.array([suffix(w.encode()) for _, w in frequent], np.int64)
    plain = np.log10(np.array([-c for c, _ in frequent], float) + 1)  # log10(c + 1)
    own_symbol = np.arange(len(frequent)) < n_words
    symbol_of = np.where(own_symbol, np.arange(len(frequent)), n_words + shared_of).astype("<u2")
    more_of = np.where(own_symbol, 0.0, plain - below_log[shared_of])
    known = spark.sparkContext.broadcast(([w.encode() for _, w in frequent], symbol_of, plain, more_of))
    end_term, end_known = math.log10(n_docs + 1), int(n_docs > 0)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches):
        words, symbol_of, plain, more_of = known.value
        place = {w: k for k, w in enumerate(words)}
        tails = _Tails()
        end_symbol = end.to_bytes(2, "little")
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for text in b.column(2):
                words = _tokens(text)
                at = np.fromiter(map(place.get, words, repeat(-1)), np.int64, len(words))
                unknown = np.flatnonzero(at < 0)
                symbols, met = np.zeros(len(words), "<u2"), at[at >= 0] if len(unknown) else at
                symbols[at >= 0] = symbol_of[met]
                others = [words[i] for i in unknown.tolist()]
                shares = np.fromiter(map(tails.__getitem__, (w[-2:] for w in others)), np.int64, len(others))
                symbols[unknown] = n_words + shares
                more = float(more_of[met].sum()) - float(below_log[shares].sum())
                missing = Counter(others)
                base = end_term + float(plain[met].sum())
                rare, times = [w.decode() for w in missing], list(missing.values())
                for column, x in zip(out, (len(words) + 1, end_known + len(met), base, more, symbols.tobytes() + end_symbol, rare, times)):
                    column.append(x)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
            names = ["doc_id", "held_out", "n_tokens", "found", "base", "more", "symbols", "rare", "times"]
            yield pa.record_batch([b.column(0), b.column(1), *(pa.array(x, k) for x, k in zip(out, kinds))], names)

    schema = f"doc_id {id_type}, held_out boolean, n_tokens bigint, found bigint, base double, more double, symbols binary, rare array<string>, times array<bigint>"
    encoded = docs.select("doc_id", "held_out", "text").mapInArrow(encode, schema).withColumn("rid", F.monotonically_increasing_id())
    encoded = materialise(encoded, "encoded")

    model = Model.first(share) if n_docs else Model.uniform(len(share))
    # a task takes some millions of tokens, as one step of its longest sequence costs the same for one sequence and for many
    tasks = max(spark.sparkContext.defaultParallelism, -(-n_train // _TASK_TOKENS))
    learn = encoded.where("not held_out").coalesce(tasks)
    for _ in range(rounds if n_docs else 0):
        model = Model.of_counts(*baum_welch(learn, model), share)

    def likelihood(batches):
        for b in batches:
            out = np.zeros(b.num_rows)
            for batch in batches_of(_sequences(b.column(4))):
                out[batch.own] = forward(model, batch)
            yield pa.record_batch([*(b.column(k) for k in (0, 1, 2, 3, 5, 6, 7)), pa.array(out)], ["doc_id", "held_out", "n_tokens", "found", "base", "more", "rid", "hmm"])

    columns = ["doc_id", "held_out", "n_tokens", "found", "symbols", "base", "more", "rid"]
    schema = f"doc_id {id_type}, held_out boolean, n_tokens bigint, found bigint, base double, more double, rid bigint, hmm double"
    scored = encoded.select(*columns).mapInArrow(likelihood, schema)
    pairs = encoded.select("rid", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("rid", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    # words with no count add nothing, so an inner join is enough
    met = pairs.join(counts.where(F.col("c") < dict_least), "word")
    added = met.groupBy("rid").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("rare_term"), F.sum("times").alias("rare_found"))
    all_rows = scored.join(added, "rid", "left")
    term = F.coalesce("rare_term", F.lit(0.0))
    return all_rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("found") + F.coalesce("rare_found", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + term - F.col("n_tokens") * math.log10(n_train + vocabulary + 1)).alias("base_score"),
        (F.col("hmm") + F.col("more") + term).alias("score"),
    )


def score_documents(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """score_texts for documents; held_out is a Column over doc_id."""
    return score_texts(slim(docs, doc_id=id_col, text=text_col).withColumn("held_out", F.coalesce(held_out, F.lit(False))), rounds)
