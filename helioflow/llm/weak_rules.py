"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Everything is DataFrame expressions. One pass over the texts computes each document's measures in
its own row; expectation-maximisation works on the table of vote patterns, at most 3 to the power
of the number of rules, with one small aggregate in each step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helioflow.llm.common import WORD, cut, stored

STEPS = 12
#: A rule is never believed to be worse than this, so that the meaning of the classes is fixed.
LEAST_ACCURACY = 0.55
PRIOR_VOTES = 20.0
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_WORDS = 50


def _number_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more; in a row, by sorting window hashes."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)))
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def found_twice(s: Column) -> Column:
        same = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(
            at,
            F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-3).alias("last")),
            lambda a, i: F.struct((a["sum"] + F.least(F.lit(3), i - a["last"])).alias("sum"), i.alias("last")),
            lambda a: a["sum"],
        )

    # Bind each array to a name once, by a transform over an array of one.
    def let(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))

    slow = let(placed, lambda s: let(found_twice(s), covered))
    few = let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    return F.when(n < 4, F.lit(0).cast("long")).when(few, F.lit(0).cast("long")).otherwise(slow)


def measures(docs: DataFrame) -> DataFrame:
    """The measures of every row's whole text, with ``doc_id``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    row = plain.select(
        "doc_id",
        "text",
        F.filter(F.split("text", f"[{SPACE}]+"), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    return row.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text").cast("long") - _number_of(F.col("text"), SPACE)).alias("word_chars"),
        _number_of(F.col("text"), SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _number_of(F.col("text"), UPPER).alias("n_upper"),
        _number_of(F.col("text"), "!?").alias("n_marks"),
        _number_of(F.col("text"), "0123456789").alias("n_digits"),
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """1 for good, -1 for bad, 0 abstains."""
    n, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    share = lambda name, of: F.col(name) / of
    return {
        "length": _vote(F.col("n_words") >= 100, F.col("n_words") < LEAST_WORDS),
        "word_size": _vote(share("word_chars", n).between(3, 10), ~share("word_chars", n).between(2, 14)),
        "symbols": _vote(share("n_symbols", n) < 0.02, share("n_symbols", n) > 0.1),
        "lines": _vote((F.col("n_dup_lines") == 0) & (F.col("n_lines") > 2), share("n_dup_lines", lines) > 0.3),
        "repeats": _vote(share("n_repeat_words", n) < 0.1, share("n_repeat_words", n) > 0.3),
        "upper": _vote(share("n_upper", chars) < 0.15, share("n_upper", chars) > 0.4),
        "marks": _vote(share("n_marks", n) < 0.1, share("n_marks", n) > 0.3),
        "digits": _vote(share("n_digits", chars) < 0.1, share("n_digits", chars) > 0.3),
    }


def _log_odds(names: list[str], prior: float, accuracy: dict[str, float]) -> Column:
    """Of good quality, given the votes."""
    terms = [F.col(name) * F.log(F.lit(accuracy[name] / (1 - accuracy[name]))) for name in names]
    return reduce(lambda a, b: a + b, terms, F.log(F.lit(prior / (1 - prior))))


def learn(patterns: DataFrame, names: list[str], steps: int = STEPS) -> tuple[float, dict[str, float]]:
    """The share of good documents and each rule's accuracy where it votes, by expectation-maximisation.

    ``patterns``: a row for each combination of votes, with its number of documents ``n``.
    """
    prior, accuracy = 0.7, dict.fromkeys(names, 0.8)
    for _ in range(steps):
        p = 1 / (1 + F.exp(-_log_odds(names, prior, accuracy)))
        right = {v: F.when(F.col(v) == 1, F.col("p")).when(F.col(v) == -1, 1 - F.col("p")).otherwise(0.0) for v in names}
        row = patterns.withColumn("p", p).agg(
            F.sum("n").alias("all"),
            F.sum(F.col("n") * F.col("p")).alias("good"),
            *(F.sum(F.col("n") * right[v]).alias(f"{v}_right") for v in names),
            *(F.sum(F.when(F.col(v) != 0, F.col("n")).otherwise(0)).alias(f"{v}_votes") for v in names),
        ).first()
        if not row["all"]:
            break
        prior = min(0.95, max(0.05, row["good"] / row["all"]))
        accuracy = {
            v: min(0.99, max(LEAST_ACCURACY, (row[f"{v}_right"] + 0.8 * PRIOR_VOTES) / (row[f"{v}_votes"] + PRIOR_VOTES))) for v in names
        }
    return prior, accuracy


def judged(docs: DataFrame, least_good: float = 0.5) -> DataFrame:
    """Measures, ``base_failed``, ``p_good`` and ``kept`` for every row of ``docs``.

    Null text counts as empty: no words, failed. Repeated rows and null ids keep their rows; equal
    votes have equal results. Empty input: no rows. Other columns are not read.
    """
    rules = votes()
    names = [f"vote_{v}" for v in rules]
    found = stored(measures(docs).withColumns({f"vote_{v}": column for v, column in rules.items()}))
    patterns = cut(found.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1))
    prior, accuracy = learn(patterns, names)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        found.withColumn("base_failed", failed)
        .withColumn("p_good", 1 / (1 + F.exp(-_log_odds(names, prior, accuracy))))
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least_good))
    )
