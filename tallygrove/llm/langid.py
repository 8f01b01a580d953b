"""Language identification by a blended-spectrum string kernel.

Two texts have the kernel |G(x) & G(y)| / sqrt(|G(x)| |G(y)|), G(x) being the set of
character n-grams, n = 1 to 4, of the lower-cased letters of x (other characters
count as one space), hashed to BUCKETS presence bits. Landmarks drawn from a bounded
sample of labelled documents give the Nystrom approximation, in which one-versus-rest
ridge regression is solved: alpha = (K' K + lambda K_mm)^-1 K' Y. As the kernel is an
inner product of presence vectors, K(x, landmarks) alpha equals P(x) (P_landmarks' alpha),
so a batch of texts is scored by one product of its presence matrix with a matrix of
BUCKETS rows and a column for each language.

Training is the only bounded part: at most PER_LANG labelled documents of each
language, distinct texts, the ones with the least hash of their text. Prediction reads whole texts.

Defined results: `und` with score 0 where the text is null, empty or without a
letter, or where no labelled document exists; ties go to the first language in
order; repeated rows each get a row; extra columns are ignored.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ._common import materialise, slim

BUCKETS = 1 << 16
ORDERS = 4
PER_LANG = 300
LANDMARKS = 160
RIDGE = 1e-2
UNDETERMINED = "und"
_BATCH = 32
_SPAN = 1 << 20
_ASCII_LETTER = re.compile("[A-Za-z]")


def _has_letter(text: str) -> bool:
    """Whether any character is a letter (Unicode category L); number characters are none."""
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


@cache
def _folding() -> np.ndarray:
    """Code point to lower-cased letter, or to a space; beyond the first plane nothing is folded."""
    table = np.arange(1 << 16, dtype=np.uint32)
    for point in range(1 << 16):
        c = chr(point)
        table[point] = ord(low) if c.isalpha() and len(low := c.lower()) == 1 else point if c.isalpha() else 32
    return table


def mark(text: str, row: np.ndarray) -> None:
    """Set row[b] = 1 for each bucket b of the text's n-grams."""
    table = _folding()
    for at in range(0, len(text), _SPAN):
        part = np.frombuffer(text[max(0, at - ORDERS + 1) : at + _SPAN].encode("utf-32-le", "surrogatepass"), np.uint32)
        part = np.where(part < 1 << 16, table[np.minimum(part, (1 << 16) - 1)], part)
        space = part == 32
        part = part[~(space & np.append(False, space[:-1]))].astype(np.uint64)
        gram = np.zeros(len(part), np.uint64)
        for n in range(1, ORDERS + 1):
            if len(part) < n:
                break
            gram = (gram[: len(part) - n + 1] + part[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            row[(gram >> np.uint64(48)).astype(np.int64)] = 1


def presence_udf():
    @arrow_udf("binary")
    def presence(text: pa.Array) -> pa.Array:
        out = []
        for x in text:
            row = np.zeros(BUCKETS, np.uint8)
            mark(x.as_py() or "", row)
            out.append(np.packbits(row).tobytes())
        return pa.array(out, pa.binary())

    return presence


class Model:
    def __init__(self, langs: list[str], weights: np.ndarray) -> None:
        self.langs, self.weights = langs, weights.astype(np.float32)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Batched product, scaled by each text's own norm."""
        return (rows @ self.weights) / np.sqrt(np.maximum(1, rows.sum(axis=1, dtype=np.float64)))[:, None]


def fit(packed: list[bytes], langs: list[str]) -> Model | None:
    names = sorted(set(langs))
    if not names:
        return None
    rows = np.unpackbits(np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1), axis=1)
    norms = np.sqrt(np.maximum(1, rows.sum(axis=1, dtype=np.int64)))
    y = np.array([[1.0 if x == n else -1.0 for n in names] for x in langs])
    each = max(1, LANDMARKS // len(names))
    seen: dict[str, int] = {}
    marks = []
    for i, x in enumerate(langs):  # as many landmarks of each language
        seen[x] = seen.get(x, 0) + 1
        if seen[x] <= each:
            marks.append(i)
    base = rows[marks].astype(np.float32) / norms[marks, None].astype(np.float32)
    k = np.concatenate([rows[i : i + 128].astype(np.float32) @ base.T for i in range(0, len(rows), 128)]) / norms[:, None]
    k = k.astype(np.float64)
    square = k[marks]
    alpha = np.linalg.solve(k.T @ k + RIDGE * len(k) * (square + square.T) / 2 + 1e-8 * len(k) * np.eye(len(marks)), k.T @ y)
    return Model(names, base.T @ alpha)


def train(labelled: DataFrame, per_lang: int = PER_LANG) -> Model | None:
    """Fit on a bounded sample of (text, lang): for each language at most per_lang rows.

    Different texts of each language are counted first, by their hash alone; a hash
    threshold then thins each language to about twice what is needed, and a window takes
    the rest, so no task holds more than that of one language. Only presence bits are
    collected, of every language there is.
    """
    known = labelled.where("lang is not null and text is not null and text rlike '\\\\p{L}'").withColumn("order", F.xxhash64("text"))
    # a text that repeats very often counts once, so it can neither shrink nor fill the sample
    different = known.select("lang", "order").distinct().groupBy("lang").count()
    shares = materialise(different.select("lang", F.least(F.lit(1.0), F.lit(2.0 * per_lang + 50) / F.col("count")).alias("share")), "lang-shares")
    ranked = known.join(shares, "lang").where(F.pmod("order", F.lit(1 << 20)) < F.col("share") * (1 << 20))
    ranked = ranked.groupBy("lang", "order").agg(F.min("text").alias("text"))
    first = Window.partitionBy("lang").orderBy("order")
    chosen = ranked.withColumn("place", F.row_number().over(first)).where(F.col("place") <= per_lang)
    got = chosen.select("lang", "place", presence_udf()("text").alias("bits")).collect()
    got.sort(key=lambda r: (r["place"], r["lang"]))
    return fit([bytes(r["bits"]) for r in got], [r["lang"] for r in got])


def predict_udf(model: Model | None):
    @arrow_udf("struct<lang:string,score:double>")
    def predict(text: pa.Array) -> pa.Array:
        langs, scores = [UNDETERMINED] * len(text), [0.0] * len(text)
        wait: list[int] = []
        rows = np.zeros((_BATCH, BUCKETS), np.float32)

        def flush() -> None:
            f = model.scores(rows[: len(wait)])
            best = f.argmax(axis=1)
            for k, i in enumerate(wait):
                langs[i] = model.langs[best[k]]
                scores[i] = float(np.clip((1 + f[k, best[k]]) / 2, 0, 1))
            rows[:] = 0
            wait.clear()

        for i, value in enumerate(text if model else ()):
            x = value.as_py()
            if x and _has_letter(x):
                mark(x, rows[len(wait)])
                wait.append(i)
                if len(wait) == _BATCH:
                    flush()
        if wait:
            flush()
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return predict


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for each row."""
    rows = slim(docs, doc_id=id_col, text=text_col)
    told = rows.select("doc_id", predict_udf(model)("text").alias("p"))
    return told.select("doc_id", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


#: Of documents told right, the share that a rejection by score may cost, and how many of a length must be known for it.
LOST = 0.001
LEAST_KNOWN = 100


def length_class(text):
    """A column: doublings of the number of characters."""
    return F.floor(F.log2(F.char_length(F.coalesce(text, F.lit(""))) + 1)).cast("int")


def calibrate(held_out: DataFrame, model: Model | None, lost: float = LOST, least_known: int = LEAST_KNOWN) -> dict[int, float]:
    """The least credible score by length class: LOST of the held-out documents (text, lang) whose language is told right have less.

    Short texts score low, so each class has its own; a class with few documents has none.
    Every labelled row is scored, once.
    """
    told = held_out.where("lang is not null and text is not null").select("lang", length_class(F.col("text")).alias("k"), predict_udf(model)("text").alias("p"))
    # no filter on the prediction: Spark would predict again below it, in a second Python worker beside each task's first
    right = told.select("k", F.when(F.col("p.lang") == F.col("lang"), F.col("p.score")).alias("score"))
    known = right.groupBy("k").agg(F.count("score").alias("n"), F.percentile_approx("score", lost, 10_000).alias("least"))
    return {r["k"]: r["least"] for r in known.where(F.col("n") >= max(1, least_known)).collect()}  # a row for each doubling


def credible(lang, score, text, least: dict[int, float]):
    """A column: whether a language was told, with a score that is not below its length class's least."""
    told = lang != UNDETERMINED
    if not least:
        return told
    bounds = F.create_map(*(F.lit(x) for kv in least.items() for x in kv))
    return told & (score >= F.coalesce(F.try_element_at(bounds, length_class(text)), F.lit(0.0)))
