"""Quality statistics and learned decision lists (operator 8), in DataFrame operations only.

Everything here is built-in functions: statistics are expressions over each row's text,
and fitting reads histograms that Spark counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbaloom.llm.common import Aside

from verbaloom.sources.tables import stage

SPACES = " \t\n\x0b\f\r"
# The limits that fail a text before any learned rule.
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# What rules may test, from the counts.
FEATURES = {
    "n_words": "n_words",
    "mean_word": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "repeated": "n_repeat_words / n_words",
    "dup_lines_per_word": "n_dup_lines / n_words",
    "upper": "n_upper / word_chars",
    "digits": "n_digits / word_chars",
    "stops_per_word": "n_stops / n_words",
    "shouts_per_word": "n_shouts / n_words",
    "distinct": "n_distinct_words / n_words",
}


# The columns that the statistics are worked out in.
INTERNAL = ["_words", "_lines", "_grams", "_sorted", "_at"]


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the
    counts n_upper, n_digits, n_stops, n_shouts and n_distinct_words, all bigint.

    A word is a run of characters other than space and tab to carriage return. A null
    text has no words and 0 for every count; so has an empty one. Lines are cut at line
    feeds. The repeated words of a text are those in a window of three words that is
    there twice or more, found by sorting the windows' 64-bit hashes: n log n for texts
    of any length. Earlier columns of these names are replaced. No shuffle.
    """
    beside = Aside(df, INTERNAL)
    df, text = beside.df, beside.name(text)
    clean = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(clean, F.lit(SPACES))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, "[ \\t-\\r]+")
    )
    lines = F.filter(F.split(clean, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    found = df.withColumns({"_words": words, "_lines": lines})
    n = F.size("_words")

    def count(pattern: str) -> Column:
        return F.regexp_count(clean, F.lit(pattern)).cast("bigint")

    zipped = F.arrays_zip(
        F.col("_words").alias("a"),
        F.slice("_words", 2, F.greatest(n, F.lit(1))).alias("b"),
        F.slice("_words", 3, F.greatest(n, F.lit(1))).alias("c"),
    )
    hashes = F.transform(zipped, lambda x: F.xxhash64(x))
    found = found.withColumn("_grams", F.slice(hashes, 1, F.greatest(n - 2, F.lit(0))))
    # Most texts repeat no window; only the others sort theirs.
    repeats = F.size(F.array_distinct("_grams")) < F.size("_grams")
    placed = F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    found = found.withColumn("_sorted", F.when(repeats, F.sort_array(placed)))

    def twice(x: Column, i: Column) -> Column:
        return F.coalesce(
            (F.get("_sorted", i - 1)["h"] == x["h"]) | (F.get("_sorted", i + 1)["h"] == x["h"]),
            F.get("_sorted", i - 1)["h"] == x["h"],
            F.get("_sorted", i + 1)["h"] == x["h"],
            F.lit(False),
        )

    again = F.transform(F.filter("_sorted", twice), lambda x: x["p"])
    found = found.withColumn("_at", F.sort_array(again))
    gaps = F.zip_with("_at", F.slice("_at", 2, F.greatest(F.size("_at"), F.lit(1))), _covered)
    repeated = F.aggregate(gaps, F.lit(0), lambda a, x: a + x)
    found = found.withColumns(
        {
            "n_words": n.cast("bigint"),
            "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
            "n_symbols": count("[#*$%&|<>]"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_repeat_words": F.coalesce(repeated, F.lit(0)).cast("bigint"),
            "n_upper": count("[A-Z]"),
            "n_digits": count("[0-9]"),
            "n_stops": count("[.!?]"),
            "n_shouts": count("!!"),
            "n_distinct_words": F.size(F.array_distinct("_words")).cast("bigint"),
        }
    )
    return beside.back(found.drop(*INTERNAL))


def _covered(here: Column, following: Column) -> Column:
    """The words that a window adds before the next repeated window begins."""
    return F.least(F.lit(3), F.coalesce(following - here, F.lit(3)))


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """All of these hold: (feature, at_least, threshold); at_least False means below."""

    tests: tuple[tuple[str, bool, float], ...]

    def condition(self) -> Column:
        held = F.lit(True)
        for feature, at_least, threshold in self.tests:
            value = _feature(feature)
            held &= (value >= threshold) if at_least else (value < threshold)
        return F.coalesce(held, F.lit(False))

    def __str__(self) -> str:
        return " and ".join(f"{f} {'>=' if up else '<'} {t:g}" for f, up, t in self.tests)


def _feature(name: str) -> Column:
    """Ratios of a text without words are 0."""
    return F.coalesce(F.try_divide(*map(F.col, FEATURES[name].split(" / "))), F.lit(0.0)) if (
        "/" in FEATURES[name]
    ) else F.col(FEATURES[name]).cast("double")


def fit_rules(
    labelled: DataFrame,
    label: str = "bad",
    key: str = "doc_id",
    max_rules: int = 6,
    max_tests: int = 3,
    min_precision: float = 0.9,
    min_covered: int = 3,
    cuts: int = 24,
) -> list[Rule]:
    """An ordered list of rules for rows whose ``label`` is true, by sequential covering.

    Each rule is grown on two thirds of the rows: the threshold test of best information
    gain is added until no wrong row is covered, ``max_tests`` are there or nothing is
    gained. It is then pruned to the leading tests that do best, by (right - wrong) /
    (right + wrong), on the other third. A rule with less precision there than
    ``min_precision``, or that covers fewer than ``min_covered`` rows there, ends the list;
    otherwise the rows it covers leave and the next is sought. Thresholds are quantiles.

    ``labelled`` has the statistics' columns; it is written once as bins of the features.
    Rows with a null label are left out, and rows that fail the fixed limits, which need no
    rule. Without rows of both labels there are no rules.
    Equal gains are settled by feature order and threshold.
    """
    values = labelled.select(
        F.when(~base_failed(), F.col(label).cast("int")).alias("y"),
        (F.pmod(F.xxhash64(key), F.lit(3)) < 2).alias("grow"),
        *(_feature(f).alias(f) for f in FEATURES),
    )
    # Filtered only once written: Spark would evaluate the statistics anew in a filter.
    values = stage(values, "labelled-statistics").where("y is not null")
    share = [i / cuts for i in range(1, cuts)]
    of_bad = [F.when(F.col("y") == 1, F.col(f)) for f in FEATURES]
    found = values.agg(
        *(F.percentile_approx(f, share).alias(f) for f in FEATURES),
        *(F.percentile_approx(v, share).alias(f"bad_{f}") for f, v in zip(FEATURES, of_bad)),
    ).first()
    thresholds = {
        f: sorted(set((found[f] or []) + (found[f"bad_{f}"] or []))) for f in FEATURES
    }
    bins = [_bin(f, t).alias(f) for f, t in thresholds.items()]
    table = stage(values.select("y", "grow", *bins), "labelled-bins")
    rules, rest = [], table
    while len(rules) < max_rules:
        tests = _grow(rest.where("grow"), thresholds, max_tests)
        tests = _prune(rest.where("not grow"), tests, min_precision, min_covered)
        if not tests:
            break
        rules.append(Rule(tuple((f, up, thresholds[f][k - 1]) for f, up, k in tests)))
        rest = rest.where(~_binned(tests))
    return rules


def _bin(feature: str, thresholds: list[float]) -> Column:
    """How many of the thresholds a value reaches."""
    if not thresholds:
        return F.lit(0)
    limits = F.lit(thresholds).cast("array<double>")
    return F.size(F.filter(limits, lambda x: x <= F.col(feature)))


def _binned(tests) -> Column:
    """A test (f, up, k): at least (or below) the k-th threshold of the feature."""
    held = F.lit(True)
    for feature, up, k in tests:
        held &= (F.col(feature) >= k) if up else (F.col(feature) < k)
    return held


def _grow(rows: DataFrame, thresholds: dict, max_tests: int) -> list:
    tests: list = []
    while len(tests) < max_tests:
        pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in thresholds)))
        counted = (
            rows.where(_binned(tests))
            .select("y", pairs.alias("x"))
            .groupBy("x.f", "x.b")
            .agg(F.sum("y").alias("p"), F.count("*").alias("n"))
            .collect()
        )  # at most one row per feature and threshold
        seen = {(r["f"], r["b"]): (r["p"], r["n"] - r["p"]) for r in counted}
        first = next(iter(thresholds))
        p0, n0 = (sum(v[i] for (f, _), v in seen.items() if f == first) for i in (0, 1))
        if not p0 or not n0:
            break
        best = (0.0, None)
        for f, limits in thresholds.items():
            for k in range(1, len(limits) + 1):
                above = [sum(v[i] for (g, b), v in seen.items() if g == f and b >= k) for i in (0, 1)]
                for up, (p, n) in ((True, above), (False, (p0 - above[0], n0 - above[1]))):
                    if p:
                        gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, up, k))
        if best[1] is None:
            break
        tests.append(best[1])
    return tests


def _prune(rows: DataFrame, tests: list, min_precision: float, min_covered: int) -> list:
    if not tests:
        return []
    sums = []
    for length in range(1, len(tests) + 1):
        held = _binned(tests[:length])
        sums.append(F.sum(F.when(held, F.col("y"))).alias(f"p{length}"))
        sums.append(F.count(F.when(held, F.lit(1))).alias(f"n{length}"))
    found = rows.agg(*sums).first()
    worth, length = max(
        (
            ((2 * (found[f"p{k}"] or 0) - found[f"n{k}"]) / max(found[f"n{k}"], 1), -k)
            for k in range(1, len(tests) + 1)
        ),
    )
    length = -length
    covered = found[f"n{length}"]
    right = found[f"p{length}"] or 0
    good = covered >= min_covered and right >= min_precision * covered
    return tests[:length] if good else []


def with_verdict(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``df`` (with the statistics) with base_failed, rule (the first that holds, from 1;
    null if none does) and kept: not failed and no rule holds."""
    rule = F.lit(None).cast("int")
    for number, one in reversed(list(enumerate(rules, 1))):
        rule = F.when(one.condition(), F.lit(number)).otherwise(rule)
    marked = df.withColumns({"base_failed": base_failed(), "rule": rule})
    return marked.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def only_kept(judged: DataFrame) -> DataFrame:
    """The rows of ``with_verdict`` that are kept.

    A plain filter would be pushed below the statistics with their expressions written
    out in it, each evaluated many times over. It stays above a column that must not be
    evaluated twice.
    """
    beside = Aside(judged, ["_row"])
    numbered = beside.df.withColumn("_row", F.monotonically_increasing_id())
    return beside.back(numbered.where(F.col("kept") & (F.col("_row") >= 0)).drop("_row"))


def labelled_statistics(
    docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, key: str = "doc_id"
) -> DataFrame:
    """The statistics of at most ``max_labelled`` labelled documents, with ``bad``: quality
    is 0. The sample is the labels of least key hash; a document labelled twice takes the
    worse label. The sample is small enough to broadcast: two numbers a row."""
    sample = (
        labels.where("quality is not null")
        .groupBy(key)
        .agg((F.min("quality") == 0).alias("bad"))
        .orderBy(F.xxhash64(key), key)
        .limit(max_labelled)
    )
    # Copies of a key take the label once each.
    return with_statistics(docs.select(key, "text").join(F.broadcast(sample), key))
