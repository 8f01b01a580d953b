"""Quality rules as a learned decision list, on DataFrame functions alone.

Statistics of whole texts come from array functions: words [^\\x20\\x09-\\x0D]+, their
code points, symbols, repeated lines, and words in repeated 3-word windows. Lines are told
apart by 64-bit hashes (distinct strings would be compared pair by pair). Windows are
64-bit hashes sorted inside the row; only rows with a repeat look at positions, so the
cost is a sort of the row's windows and no word is ever shuffled.

The verdict is an ordered list of threshold conjunctions, learned by sequential
covering from labelled statistics: on two thirds of the labelled rows a rule grows by
the condition of greatest information gain, on the rest it is pruned from its end;
rules are kept while they are precise on the rest, and the rows they cover are removed
before the next one grows. The list becomes one Spark CASE expression; what no rule
matches is kept. Learning reads at most MOST_LABELLED labelled rows (numbers, no
texts); the list is applied to all rows.

Defined results: null or empty text has zero of everything and fails; a null label or
doc_id in labels is ignored, the lower of repeated labels counts; without labels of
both kinds the list is empty; repeated rows each get a row; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import materialise, slim

MOST_LABELLED = 20_000
LEAST_WORDS = 50
LEAST_PRECISION = 0.9
MOST_RULES = 12
MOST_CONDITIONS = 3
FEATURES = ("n_words", "word_length", "symbol_ratio", "dup_line_ratio", "repeat_ratio")
_SPACE = "[\\x20\\x09-\\x0D]+"


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, as a table in the shared folder."""
    rows = slim(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    words = F.filter(F.split("text", _SPACE), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.regexp_replace(x, _SPACE, "") != "")
    rows = rows.select(
        "doc_id",
        F.char_length(F.regexp_replace("text", _SPACE, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x))))).cast("long").alias("n_dup_lines"),
        words.alias("words"),
    )
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    last = F.col("n_words").cast("int") - 2
    windows = F.transform(
        F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.element_at("words", i), F.element_at("words", i + 1), F.element_at("words", i + 2)),
    )
    rows = rows.withColumn("windows", windows).drop("words").withColumn("sorted", F.sort_array("windows"))
    again = F.array_distinct(F.filter("sorted", lambda h, i: (i > 0) & (h == F.get("sorted", i - 1))))
    rows = rows.withColumn("again", again).drop("sorted")
    # places of repeated windows in order; each adds three words, less what it shares with the one before
    order = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("order", F.when(F.size("again") > 0, order)).drop("windows", "again")

    def twin(x: Column, i: Column) -> Column:
        before = (i > 0) & (F.get("order", i - 1)["h"] == x["h"])
        return before | (F.coalesce(F.get("order", i + 1)["h"] == x["h"], F.lit(False)))

    places = F.sort_array(F.transform(F.filter("order", twin), lambda x: x["i"]))
    rows = rows.withColumn("places", places).drop("order")
    added = F.transform("places", lambda p, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), p - F.get("places", i - 1))))
    repeated = F.coalesce(F.aggregate(added, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    # a table of numbers: a filter on them pushed into the arrays would make these anew for each element
    return materialise(rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", repeated.alias("n_repeat_words")), "statistics")


def features(stats: DataFrame) -> DataFrame:
    """stats with the columns FEATURES, as doubles, under f_<name>."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    made = {
        "n_words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / words,
        "dup_line_ratio": F.col("n_dup_lines") / words,
        "repeat_ratio": F.col("n_repeat_words") / words,
    }
    return stats.withColumns({f"f_{k}": v for k, v in made.items()})


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict[str, float]) -> bool:
        return row[self.feature] > self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self) -> Column:
        c = F.col(f"f_{self.feature}")
        return c > self.threshold if self.above else c <= self.threshold


Rule = list[Condition]


def _covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _grow(rows: list[dict]) -> Rule:
    rule: Rule = []
    while len(rule) < MOST_CONDITIONS:
        bad = sum(r["bad"] for r in rows)
        if not bad or bad == len(rows):
            break
        now, best = math.log2(bad / len(rows)), (0.0, None)
        for f in FEATURES:
            order = sorted(rows, key=lambda r: r[f])
            p = n = 0
            for k in range(len(order) - 1):
                p, n = p + order[k]["bad"], n + 1
                a, b = order[k][f], order[k + 1][f]
                if a == b:
                    continue
                for above, good, size in ((False, p, n), (True, bad - p, len(order) - n)):
                    if good and (gain := good * (math.log2(good / size) - now)) > best[0] + 1e-9:
                        best = gain, Condition(f, above, round((a + b) / 2, 6))
        if not best[1]:
            break
        rule.append(best[1])
        rows = [r for r in rows if best[1].holds(r)]
    return rule


def _worth(rule: Rule, rows: list[dict]) -> tuple[float, int, int]:
    met = [r["bad"] for r in rows if _covers(rule, r)]
    p = sum(met)
    return (2 * p - len(met)) / (len(met) or 1), p, len(met)


def learn(rows: list[dict]) -> list[Rule]:
    """A decision list of rules for rejection, from rows with FEATURES and bad (bool)."""
    grow = [r for k, r in enumerate(rows) if k % 3]
    prune = [r for k, r in enumerate(rows) if not k % 3]
    out: list[Rule] = []
    while len(out) < MOST_RULES and any(r["bad"] for r in grow):
        rule = _grow(grow)
        if not rule:
            break
        short = min((rule[:k] for k in range(len(rule), 0, -1)), key=lambda x: -_worth(x, prune)[0])
        _, p, n = _worth(short, prune)
        _, gp, gn = _worth(short, grow)
        if p + gp < 5 or n == 0 or p < LEAST_PRECISION * n or gp < LEAST_PRECISION * gn:
            break
        out.append(short)
        grow = [r for r in grow if not _covers(short, r)]
        prune = [r for r in prune if not _covers(short, r)]
    return out


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> list[dict]:
    """FEATURES and bad of at most `most` labelled documents, those with the least hash of their id.

    Of rows that repeat a doc_id, one counts: that of the least features.
    """
    known = slim(labels, doc_id="doc_id", quality="quality").where("doc_id is not null and quality is not null")
    known = known.groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    stats = features(statistics(slim(docs, doc_id="doc_id", text="text").join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")))
    stats = stats.where("n_words >= %d and 100 * n_repeat_words <= 50 * n_words" % LEAST_WORDS)
    told = stats.join(F.broadcast(known), "doc_id").groupBy("doc_id", "bad").agg(F.min(F.struct(*(f"f_{f}" for f in FEATURES))).alias("f"))
    got = told.select("doc_id", "bad", "f.*").collect()  # at most `most` rows
    return [{"bad": r["bad"], **{f: r[f"f_{f}"] for f in FEATURES}} for r in sorted(got, key=lambda r: r["doc_id"])]


def verdict(rules: list[Rule]) -> Column:
    """The ordered conditional expression: false for the first rule that holds, true if none does."""
    out = None
    for rule in rules:
        all_hold = F.lit(True)
        for c in rule:
            all_hold = all_hold & c.column()
        out = F.when(all_hold, False) if out is None else out.when(all_hold, False)
    return F.lit(True) if out is None else out.otherwise(True)


def assess(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The statistics, base_failed and kept of each row."""
    stats = features(statistics(docs, id_col, text_col))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = stats.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(rules))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
