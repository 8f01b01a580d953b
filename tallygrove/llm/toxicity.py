"""Toxicity by a weighted finite-state pattern grammar.

Tokens become symbols: I insult, W weak insult, T threat, U a person spoken to or of, O
a pronoun that follows its verb as object, P one that may precede it, N negation, R
reported speech, o other, and . for a clause's end. Four transducers over them are composed
into one machine: negation marks insults and threats shortly after an N; report marks the end
of a clause that holds an R; target marks it by whether a person is meant (U, O or
P on either side) and whether a threat has its object; the clause reader then gives, at
each clause's end, the kind of the clause: plain (an insult of nobody named), targeted,
negated, reported, weak, threat or none. Each kind's end arcs carry a weight in log-odds; a
text scores the logistic of bias + sum of weight * log2(1 + clauses of the kind), so
a word counts by its clause alone, once, and more clauses of a kind add ever less.

The insults are learned: whole words, and stems of 5 to 7 letters that at least
STEM_TYPES different words of toxic documents begin with (a word of its own is no stem, so
a longer word's beginning does not catch neutral words), which labelled toxic documents
contain and others seldom do, chosen by sequential covering, beside a short fixed list of
lemmas with their endings. Those that more than a few other documents held are weak. Weights of
kinds that labelled documents show are fitted to them; for a kind that they never show
a single clause is set to tell by itself (threat, targeted, plain) or not to (the
others), by MARGIN; a single negated or reported clause never does, and a targeted one
weighs no less than a plain one. Training reads at most PER_CLASS labelled documents of each label,
those with the least hash of their text; scoring reads whole texts.

Defined results: null or empty text gets the score of a text without a match; rows of
labels with a null doc_id or label are ignored, and if labels repeat for a document
the higher one counts; without labels the fixed lists alone score; repeated rows each
get a row; a text repeated under one label counts once in training; extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ._common import materialise, slim

PER_CLASS = 4000
MOST_UNITS = 1500
KINDS = ("plain", "targeted", "negated", "reported", "weak", "threat")
# General words of each symbol, in English, German, French and Spanish.
INSULTS = ["idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "dumb", "imbecile", "bastard", "vermin"]
ENDINGS = ["", "s", "e", "en", "es"]
THREATS = ["kill", "kills", "killing", "murder", "murders", "murdering", "hurt", "hurts", "hurting", "destroy", "destroys", "destroying", "beat", "beats", "beating"]
THREATS += ["töten", "töte", "tötet", "tuer", "tuerai", "matar", "mato", "mataré"]
PERSONS = ["he", "she", "they", "du", "tu"]
OBJECTS = ["you", "your", "yours", "them", "him", "her"]
PRONOUNS = ["dich", "euch", "ihr", "toi", "vous", "te", "usted", "ustedes"]
NEGATIONS = ["not", "never", "no", "nicht", "kein", "nie", "pas", "jamais", "nunca"]
REPORTS = ["said", "says", "called", "quoted", "wrote", "told", "sagte", "dit", "dijo"]
_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
_SHORT, _LONG = 5, 7
STEM_TYPES = 4
#: Most other documents that may hold a unit, as a share of what its toxic documents would be at equal frequency of both:
#: of a strong one, of one in general, and of one that at least a share BROAD of toxic documents hold, which chance does not give.
STRONG, NARROW, WEAK, BROAD = 0.002, 0.02, 0.13, 0.05
#: Share of toxic documents that must hold a unit which covering does not need.
MANY = 0.02
#: A negation reaches so many symbols.
REACH = 4
#: How strongly the learned weights are held to the values assumed before.
PRIOR = 0.1
#: Log-odds by which one clause of a kind without examples passes or misses a score of a half.
MARGIN = 1.0
_KNOWN = 200_000


def units(word: str):
    """The morphemes of a lower-cased word: itself, marked by =, and its beginnings."""
    yield "=" + word
    for n in range(_SHORT, min(_LONG, len(word)) + 1):
        yield word[:n]


class Symbols(dict):
    """Token to symbol, remembered; starts anew when too large."""

    def __init__(self, insults: dict[str, bool]) -> None:
        super().__init__()
        self.insults = insults
        lists = (("R", REPORTS), ("N", NEGATIONS), ("U", PERSONS), ("O", OBJECTS), ("P", PRONOUNS), ("T", THREATS))
        self.fixed = {w: s for s, words in lists for w in words}

    def __missing__(self, token: str) -> str:
        if len(self) > _KNOWN:
            self.clear()
        if not token[0].isalpha():
            s = "."
        elif found := [self.insults[u] for u in units(token) if u in self.insults]:
            s = "I" if any(found) else "W"
        else:
            s = self.fixed.get(token, "o")
        self[token] = s
        return s


class Transducer:
    """A deterministic letter-to-letter transducer: arcs[state][symbol] = (output, next state); it starts in 0."""

    def __init__(self, arcs: list[dict[str, tuple[str, int]]]) -> None:
        self.arcs = arcs

    @classmethod
    def of_rule(cls, start, step, alphabet) -> Transducer:
        """step(state, symbol) gives (output, next state); the states are those it reaches from start."""
        number, arcs, queue = {start: 0}, [], [start]
        for state in queue:  # grows while it is read
            row = {}
            for symbol in alphabet:
                output, to = step(state, symbol)
                if to not in number:
                    number[to] = len(number)
                    queue.append(to)
                row[symbol] = output, number[to]
            arcs.append(row)
        return cls(arcs)

    def outputs(self) -> list[str]:
        return sorted({output for row in self.arcs for output, _ in row.values()})

    def compose(self, after: Transducer) -> Transducer:
        """The machine that reads what this one reads and gives what `after` makes of this one's output."""

        def step(state, symbol):
            middle, left = self.arcs[state[0]][symbol]
            output, right = after.arcs[state[1]][middle]
            return output, (left, right)

        return Transducer.of_rule((0, 0), step, list(self.arcs[0]))

    def run(self, symbols) -> list[str]:
        state, out = 0, []
        for s in symbols:
            output, state = self.arcs[state][s]
            out.append(output)
        return out


ALPHABET = "IWTUOPNRo."


def _negation() -> Transducer:
    """I, W and T become i, w and t within REACH symbols after an N; N becomes o. State: symbols still reached."""

    def step(left: int, s: str):
        if s == ".":
            return s, 0
        if s == "N":
            return "o", REACH
        return s.lower() if left and s in "IWT" else s, max(0, left - 1)

    return Transducer.of_rule(0, step, ALPHABET)


def _report(alphabet) -> Transducer:
    """R becomes o, and the end of its clause a colon. State: whether an R was met."""

    def step(met: bool, s: str):
        if s == ".":
            return ":" if met else ".", False
        return ("o", True) if s == "R" else (s, met)

    return Transducer.of_rule(False, step, alphabet)


def _target(alphabet) -> Transducer:
    """The end of a clause gets u if it means a person, and x if a threat has its object: O or P after T, or P before.

    State: person, P met, T met, threat complete.
    """

    def step(state, s: str):
        person, before, threat, complete = state
        if s in (".", ":"):
            return s + "u" * person + "x" * complete, (False, False, False, False)
        if s == "T":
            return "o", (person, before, True, complete or before)
        if s in ("U", "O", "P"):
            return "o", (True, before or s == "P", threat, complete or threat and s != "U")
        return s, state

    return Transducer.of_rule((False, False, False, False), step, alphabet)


def _clause(alphabet) -> Transducer:
    """At a clause's end its kind; o elsewhere. State: the strongest insult met: none, negated, weak, strong."""
    rank = {"i": 1, "w": 1, "W": 2, "I": 3}

    def step(met: int, s: str):
        if s[0] not in ".:":
            return "o", max(met, rank.get(s, 0))
        threat, reported = s.endswith("x"), s[0] == ":"
        if reported:
            return "reported" if threat or met > 1 else "negated" if met else "o", 0
        if threat:
            return "threat", 0
        return ("o", "negated", "weak", "targeted" if "u" in s else "plain")[met], 0

    return Transducer.of_rule(0, step, alphabet)


def grammar_machine() -> Transducer:
    """The four transducers composed."""
    machine = _negation()
    for make in (_report, _target, _clause):
        machine = machine.compose(make(machine.outputs()))
    return machine


MACHINE = grammar_machine()
_SIGNS = re.compile("[IWT]")


def match(symbols: str) -> Counter:
    """How many clauses of each kind the machine finds; clauses without insult or threat need no run."""
    found: Counter = Counter()
    for clause in symbols.split("."):
        if _SIGNS.search(clause):
            found[MACHINE.run(clause + ".")[-1]] += 1
    found.pop("o", None)
    return found


def _row(found: Counter) -> list[float]:
    return [math.log2(1 + found[k]) for k in KINDS]


class Grammar:
    def __init__(self, insults: dict[str, bool], weights: dict[str, float], bias: float) -> None:
        """insults: morphemes, and whether one match is strong. weights: of each kind's end arcs."""
        self.insults, self.weights, self.bias = insults, weights, bias

    def kinds(self):
        """text -> Counter of kinds."""
        symbols = Symbols(self.insults)
        return lambda text: match("".join(map(symbols.__getitem__, _TOKEN.findall(text.lower()))))

    def scorer(self):
        kinds, weights = self.kinds(), [self.weights[k] for k in KINDS]

        def score(text: str) -> float:
            z = self.bias + sum(w * x for w, x in zip(weights, _row(kinds(text))))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def _sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(text, toxic) of at most per_class labelled texts of each label, each text once."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    sizes = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, 2.0 * per_class / max(1, sizes.get(1, 0)))).otherwise(min(1.0, 2.0 * per_class / max(1, sizes.get(0, 0))))
    # about 2 * per_class rows of each label at most: a checked bound for the broadcast
    thin = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    rows = docs.where("text is not null").join(F.broadcast(thin), "doc_id").select("text", "toxic", F.xxhash64("text").alias("order"))
    rows = materialise(rows.groupBy("toxic", "order").agg(F.min("text").alias("text")), "toxic-rows")
    least = [rows.where(F.col("toxic") == y).select("toxic", "order").orderBy("order").limit(per_class) for y in (0, 1)]
    return rows.join(F.broadcast(least[0].unionByName(least[1])), ["toxic", "order"], "left_semi").select("text", "toxic")


def _count_units(rows: DataFrame) -> DataFrame:
    def run(batches):
        counts = [Counter(), Counter()]
        for b in batches:
            for text, toxic in zip(b.column(0), b.column(1).to_pylist()):
                words = set(_TOKEN.findall(text.as_py().lower()))
                counts[toxic].update({u for w in words if w[0].isalpha() for u in units(w)})
        both = [[u, n, counts[0][u]] for u, n in counts[1].items()] + [[u, 0, n] for u, n in counts[0].items() if u not in counts[1]]
        for i in range(0, len(both), 50_000):
            part = list(zip(*both[i : i + 50_000]))
            yield pa.record_batch([pa.array(x) for x in part], ["unit", "toxic", "other"])

    return rows.select("text", "toxic").mapInArrow(run, "unit string, toxic bigint, other bigint")


def _incidence(rows: DataFrame, candidates: list[str]) -> tuple[np.ndarray, np.ndarray]:
    at = {u: i for i, u in enumerate(candidates)}
    width = -(-len(candidates) // 8) or 1

    @arrow_udf("binary")
    def bits(text: pa.Array) -> pa.Array:
        out = []
        for x in text:
            row = np.zeros(width * 8, np.uint8)
            for w in set(_TOKEN.findall(x.as_py().lower())):
                for u in units(w):
                    if u in at:
                        row[at[u]] = 1
            out.append(np.packbits(row).tobytes())
        return pa.array(out, pa.binary())

    got = rows.select("toxic", bits("text").alias("bits")).collect()
    if not got:
        return np.zeros((0, len(candidates)), bool), np.zeros(0, bool)
    m = np.unpackbits(np.frombuffer(b"".join(bytes(r["bits"]) for r in got), np.uint8).reshape(len(got), -1), axis=1)
    return m[:, : len(candidates)].astype(bool), np.array([r["toxic"] == 1 for r in got])


def cover(has: np.ndarray, toxic: np.ndarray, candidates: list[str]) -> dict[str, bool]:
    """Sequential covering: the unit that adds most toxic documents not covered yet, less a multiple of the others it hits.

    Afterwards, units as clean as those chosen and as telling against chance stay too.
    Each with whether it is strong: hardly any other document held it.
    """
    chosen: list[int] = []
    good, bad = has[toxic], has[~toxic]
    n_bad = bad.sum(axis=0)
    hits = good.sum(axis=0)
    ratio = len(bad) / max(1, len(good))
    broad = hits >= max(20, BROAD * len(good))
    clean = n_bad <= np.where(broad, WEAK, NARROW) * ratio * hits
    # one in 2^20 or less that so many documents of the class would hold it, were it not telling
    telling = np.log2((len(good) + len(bad)) / max(1, len(good))) * hits
    rare = telling >= 20
    left = np.ones(len(good), bool)
    while left.any():
        gain = (good[left].sum(axis=0) - 10 / max(ratio, 0.1) * n_bad) * (clean & (telling >= 14))
        k = int(gain.argmax()) if len(gain) else -1
        if k < 0 or gain[k] < max(3, 0.002 * len(good)):
            break
        chosen.append(k)
        left &= ~good[:, k]
    # many documents must hold it: the words of a few near copies are as clean and say nothing
    many = hits >= max(20, MANY * len(good))
    taken = set(chosen) | set(np.flatnonzero(clean & rare & many).tolist())
    return {candidates[k]: bool(n_bad[k] <= STRONG * ratio * hits[k]) for k in sorted(taken)}


def _types(totals: DataFrame) -> DataFrame:
    """(unit, types): for each stem, how many different words of toxic documents alone begin with it."""
    words = totals.where("unit like '=%' and a > 0 and b = 0").select(F.expr("substring(unit, 2)").alias("word"))
    lengths = F.array(*(F.lit(n) for n in range(_SHORT, _LONG + 1)))
    stems = words.select("word", F.explode(lengths).alias("n")).where("char_length(word) >= n")
    return stems.select(F.expr("substring(word, 1, n)").alias("unit")).groupBy("unit").agg(F.count(F.lit(1)).alias("types"))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Grammar:
    """Learn insults and weights from (doc_id, text) and (doc_id, toxic)."""
    rows = materialise(_sample(slim(docs, doc_id="doc_id", text="text"), slim(labels, doc_id="doc_id", toxic="toxic"), per_class), "toxic-sample")
    sizes = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    insults = {"=" + w + e: True for w in INSULTS for e in ENDINGS}
    prior = {"plain": 3.0, "targeted": 3.5, "negated": 1.0, "reported": 0.5, "weak": 1.0, "threat": 3.5}
    if not pos or not neg:
        return Grammar(insults, prior, -2.5)
    totals = materialise(_count_units(rows).groupBy("unit").agg(F.sum("toxic").alias("a"), F.sum("other").alias("b")), "toxic-units")
    lift = F.log((F.col("a") + 0.5) / (pos + 1)) - F.log((F.col("b") + 0.5) / (neg + 1))
    telling = totals.where("a >= 3").withColumn("gain", F.col("a") * lift).where(lift > math.log(8))
    telling = telling.join(_types(totals), "unit", "left").where(F.col("unit").startswith("=") | (F.col("types") >= STEM_TYPES))
    best = telling.orderBy(F.desc("gain"), "unit").limit(MOST_UNITS).collect()
    candidates = [r["unit"] for r in best]
    has, toxic = _incidence(rows, candidates)
    insults |= cover(has, toxic, candidates) if candidates else {}
    blank = Grammar(insults, dict.fromkeys(KINDS, 0.0), 0.0)

    @arrow_udf("array<double>")
    def kinds(text: pa.Array) -> pa.Array:
        found = blank.kinds()
        return pa.array([_row(found(x.as_py())) for x in text], pa.list_(pa.float64()))

    got = rows.select("toxic", kinds("text").alias("k")).collect()
    x = np.array([r["k"] for r in got], float)
    y = np.array([r["toxic"] for r in got], float)
    w = fit(x, y, np.array([-2.5, *(prior[k] for k in KINDS)]))
    bias, weights = float(w[0]), dict(zip(KINDS, w[1:].tolist()))
    for k, shown in zip(KINDS, x.any(axis=0)):
        if not shown:
            weights[k] = max(0.0, -bias + (MARGIN if k in ("threat", "targeted", "plain") else -MARGIN))
        elif k in ("negated", "reported"):
            weights[k] = min(weights[k], max(0.0, -bias - MARGIN))
        elif k == "targeted":
            weights[k] = max(weights[k], weights["plain"])
    return Grammar(insults, weights, bias)


def fit(x: np.ndarray, y: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Newton steps towards the most likely weights, bias first, under a prior at start; both labels count as equally frequent."""
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    w = start.copy()
    full = np.column_stack([np.ones(len(x)), x])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        grad = full.T @ (weight * (p - y)) + PRIOR * (w - start)
        hess = (full * (weight * p * (1 - p))[:, None]).T @ full + PRIOR * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return w


def score_udf(grammar: Grammar):
    made: list = []

    @arrow_udf("double")
    def toxicity(text: pa.Array) -> pa.Array:
        if not made:
            made.append(grammar.scorer())
        return pa.array([made[0](x.as_py() or "") for x in text], pa.float64())

    return toxicity


def toxicity(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from 0.5 on) for each row."""
    rows = slim(docs, doc_id=id_col, text=text_col).select("doc_id", score_udf(grammar)("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
