"""Secret scans as DataFrame expressions: fixed patterns, and windowed entropy of other candidates.

A candidate is a long run of token characters with both letters and digits. A window slides over it,
for each character class; the counts of the class's characters in the window are updated by the
character that enters and the one that leaves, and give the window's Shannon entropy. The largest
one decides. Candidates with an allow-listed part, or that overlap a fixed pattern, are suppressed.
Everything happens in the document's own row, for the few that have a candidate.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kind, pattern, least number of characters of the group (fixed values).
BASE = [
    ("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Cheap tests that a text can have a match at all.
SCREEN = {"assign": r"(?i)(?:pass|secret|token|key)[a-z\"']*\x20*[:=]", "access": "AKIA", "hex": r"[0-9a-f]{24}", "entropy": r"(?=[A-Za-z0-9+/_=-]{20})(?=[A-Za-z+/_=-]{0,24}[0-9])[A-Za-z0-9+/_=-]"}
WINDOW = 20
#: Alphabet of each class, and the least entropy, in bits a character, of some window.
CLASSES = {
    "digits": ("0123456789", 3.0),
    "hex": ("0123456789abcdef", 3.4),
    "mixed": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.85),
}
#: Parts of strings that look random and are no secrets.
ALLOWED = r"(?i)example|sample|dummy|placeholder|changeme|lorem|ipsum|abcdef|0123456789|1234567890|(.)\1{5}|sha(?:1|256|512)-|^[A-Za-z]+(?:[-_/=+][A-Za-z]+)*[0-9]{0,4}$|^[0-9]+$|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}"

SPAN = "array<struct<kind:string,start:int,end:int,text:string>>"


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their code points, from the pieces between them."""
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast(SPAN)
    # Bind pieces and matches to names, once.
    return F.get(
        F.transform(
            F.array(F.struct(pieces.alias("p"), matches.alias("m"))),
            lambda x: _chain(x["p"], x["m"], kind, none),
        ),
        F.lit(0),
    )


def _chain(pieces: Column, matches: Column, kind: str, none: Column) -> Column:
    """Running ends in one pass, then spans."""
    sizes = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("size"), m.alias("text")))
    state = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.aggregate(
        sizes,
        state,
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + x["size"]).alias("at"),
            F.concat(
                a["spans"],
                F.array(F.struct(F.lit(kind).alias("kind"), (a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + x["size"]).alias("end"), x["text"].alias("text"))),
            ).alias("spans"),
        ),
        lambda a: a["spans"],
    )


def _plogp() -> Column:
    """n * log2(n) for n from 0 to the window's size."""
    return F.lit([0.0] + [n * log2(n) for n in range(1, WINDOW + 1)])


def window_entropy(candidate: Column, alphabet: str) -> Column:
    """The largest entropy, in bits a character, of any window that lies wholly in the alphabet; 0 if none does.

    Counts are kept by character; each step adds the entering character, removes the leaving one,
    and adjusts the sum of n log n by these two counts alone.
    """
    codes = F.transform(F.split(candidate, ""), lambda c: F.position(c, F.lit(alphabet)))
    size, table = len(alphabet) + 1, _plogp()

    def run(code: Column) -> Column:
        start = F.struct(
            F.array_repeat(F.lit(0), size).alias("n"), F.lit(0.0).alias("sum"), F.lit(0).alias("length"), F.lit(0.0).alias("best"),
        )

        def step(a: Column, i: Column) -> Column:
            new = F.get(code, i)
            old = F.when(a["length"] >= WINDOW, F.get(code, i - WINDOW)).otherwise(F.lit(0))
            inside = new > 0
            less = F.when(old > 0, F.transform(a["n"], lambda n, k: F.when(k == old, n - 1).otherwise(n))).otherwise(a["n"])
            counts = F.transform(less, lambda n, k: F.when(k == new, n + 1).otherwise(n))
            c_old = F.when(old > 0, F.get(a["n"], old)).otherwise(F.lit(0))
            total = a["sum"] - F.when(c_old > 0, F.get(table, c_old) - F.get(table, c_old - 1)).otherwise(0.0)
            c_new = F.get(a["n"], new) - F.when((old > 0) & (old == new), 1).otherwise(0)
            total = total + F.get(table, c_new + 1) - F.get(table, c_new)
            length = F.least(a["length"] + 1, F.lit(WINDOW))
            entropy = F.when(length >= WINDOW, F.lit(log2(WINDOW)) - total / WINDOW).otherwise(0.0)
            return F.when(
                inside,
                F.struct(counts.alias("n"), total.alias("sum"), length.alias("length"), F.greatest(a["best"], entropy).alias("best")),
            ).otherwise(
                F.struct(F.array_repeat(F.lit(0), size).alias("n"), F.lit(0.0).alias("sum"), F.lit(0).alias("length"), a["best"].alias("best"))
            )

        return F.aggregate(F.sequence(F.lit(0), F.size(code) - 1), start, step, lambda a: a["best"])

    return F.get(F.transform(F.array(codes), run), F.lit(0))


def _random(candidate: Column) -> Column:
    tests = [window_entropy(candidate, alphabet) >= least for alphabet, least in CLASSES.values()]
    shape = candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]") & ~candidate.rlike(ALLOWED)
    return F.when(shape, reduce(lambda a, b: a | b, tests)).otherwise(F.lit(False))


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _ordered(spans: Column, kinds: list[str]) -> Column:
    """By start, then by kind as listed."""
    rank = lambda s: F.array_position(F.lit(kinds), s["kind"]).cast("int")
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keyed)


def _longer(pattern: str, group: int, least: int) -> Callable[[Column], Column]:
    return lambda s: F.length(F.regexp_extract(s["text"], pattern, group)) >= least


def scan(docs: DataFrame) -> DataFrame:
    """Secrets in every row's whole text.

    Returns ``doc_id, n_assign, n_access, n_hex, base_spans, spans``; spans are arrays of
    ``start, rank, end, kind`` in code points, by start, then kind. Matches of different kinds may
    overlap; candidates of the entropy test that overlap one are left out. Null text counts as
    empty. Repeated rows and null ids keep their rows. Empty input: no rows. Other columns are not
    read.
    """
    none = F.array().cast(SPAN)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    for kind, pattern, group, least in BASE:
        spans = F.filter(_found(F.col("text"), kind, pattern), _longer(pattern, group, least))
        found = found.withColumn(kind, F.when(F.col("text").rlike(SCREEN[kind]), spans).otherwise(none))
    found = found.withColumn("base", F.concat(*(kind for kind, *_ in BASE)))
    apart = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    odd = F.filter(F.filter(_found(F.col("text"), "entropy", CANDIDATE), apart), lambda s: _random(s["text"]))
    found = found.withColumn("entropy", F.when(F.col("text").rlike(SCREEN["entropy"]), odd).otherwise(none))
    kinds = [kind for kind, *_ in BASE] + ["entropy"]
    return found.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind, *_ in BASE),
        _ordered(F.col("base"), kinds).alias("base_spans"),
        _ordered(F.concat("base", "entropy"), kinds).alias("spans"),
    )
