"""Operator 7: quality rules as a short-circuit cascade (DataFrame functions only).

Every rule is a boolean column over ``text`` and its words. ``estimate`` measures each
rule's cost and rejection rate on a sample, ``ordered`` sorts the rules by rejections per
second, and ``cascade`` evaluates them in that order with nested CASE branches, so a rule
is only computed for documents that all earlier rules let pass. The order changes the
cost alone: a document is kept if no rule rejects it, whatever the order.

Defined results: null and empty texts have no words and all counts 0; very long texts are
processed whole, row by row, without a shuffle; repeated rows are judged one by one;
an empty table gives an empty result; other columns of the input are passed through
(columns named like a result column are replaced).
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmarts.llm.common import NON_SPACE, split_words

MIN_WORDS = 50
MAX_REPEAT_PCT = 50


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def text_lines(text: Column) -> Column:
    """Lines with a word, in order."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(NON_SPACE))


def symbol_count(text: Column) -> Column:
    return F.size(F.split(F.coalesce(text, F.lit("")), r"[#*$%&|<>]")).cast("long") - 1


def _windows(words: Column) -> Column:
    """64-bit hashes of the 3-word windows."""
    def hashed(h: Column) -> Column:
        return F.when(F.size(h) < 3, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - 2, F.lit(0))),
                        lambda a, i: F.xxhash64(a, F.get(h, i + 1), F.get(h, i + 2))))
    # binding the word hashes to a lambda variable evaluates them once a text
    return F.get(F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), hashed), F.lit(0))


def repeated_words(windows: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Windows are sorted with their place only if some window repeats (hash-based check).
    """
    ranked = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def covered(sorted_windows: Column) -> Column:
        twice = F.filter(sorted_windows, lambda x, k: (
            F.coalesce(F.get(sorted_windows, k - 1)["w"] == x["w"], F.lit(False))
            | F.coalesce(F.get(sorted_windows, k + 1)["w"] == x["w"], F.lit(False))))
        places = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
        return F.size(F.array_distinct(places)).cast("long")

    one = F.transform(F.array(ranked), covered)
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(F.get(one, F.lit(0)))


def base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with words, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = F.col("text")
    return (docs.withColumns({"words": split_words(text), "_lines": text_lines(text)})
            .withColumn("_windows", _windows(F.col("words")))
            .withColumns({
                "n_words": F.size("words").cast("long"),
                "word_chars": F.length(F.array_join("words", "")).cast("long"),
                "n_symbols": symbol_count(text),
                "n_lines": F.size("_lines").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": repeated_words(F.col("_windows")),
            }).drop("_windows", "_lines"))


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def default_rules() -> list[Rule]:
    """Rules beyond the base test, over the base counts and words. Thresholds are fixed values."""
    n = F.col("n_words")
    return [
        Rule("few_distinct_words", 100 * F.size(F.array_distinct("words")) < 2 * n),
        Rule("duplicate_lines", 100 * F.col("n_dup_lines") > 40 * F.col("n_lines")),
        Rule("short_words", F.col("word_chars") < 2 * n),
        Rule("long_words", F.col("word_chars") > 30 * n),
        Rule("symbols", 100 * F.col("n_symbols") > 10 * n),
    ]


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: float

    @property
    def rate(self) -> float:
        return self.rejected / max(self.seconds, 1e-4)


def estimate(docs: DataFrame, rules: list[Rule], sample_rows: int = 2000, seed: int = 7) -> list[Estimate]:
    """Cost (seconds over the sample, above an empty pass) and rejected share of each rule.

    ``docs`` has text; rules see the columns of ``base_counts``. The sample is a Bernoulli sample of about ``sample_rows``
    rows; only one number per rule comes back.
    """
    total = docs.count()
    share = 1.0 if total <= sample_rows else sample_rows / total
    sample = (docs.select("text").sample(False, share, seed) if share < 1 else docs.select("text"))
    sample = base_counts(sample).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = sample.count()

        def run(cond: Column) -> tuple[float, int]:
            best, hits = None, 0
            for _ in range(2):
                t0 = time.perf_counter()
                hits = sample.agg(F.count_if(cond)).first()[0] or 0
                took = time.perf_counter() - t0
                best = took if best is None else min(best, took)
            return best, hits

        floor, _ = run(F.col("text").isNull())
        out = []
        for rule in rules:
            took, hits = run(rule.rejects)
            out.append(Estimate(rule.name, max(0.0, took - floor), hits / rows if rows else 0.0))
        return out
    finally:
        sample.unpersist()


def ordered(rules: list[Rule], estimates: list[Estimate]) -> list[Rule]:
    """Most rejections per second first; ties keep the given order."""
    rate = {e.name: e.rate for e in estimates}
    return sorted(rules, key=lambda r: -rate[r.name])


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does; later branches stay unevaluated."""
    out = None
    for rule in rules:
        hit = F.coalesce(rule.rejects, F.lit(False))
        out = F.when(hit, F.lit(rule.name)) if out is None else out.when(hit, F.lit(rule.name))
    return out if out is not None else F.lit(None).cast("string")


def quality(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """``docs`` with the base counts, base_failed, rejected_by and kept.

    ``rejected_by`` names the first rejecting rule in the measured order (so it can differ
    between runs when several rules reject); ``kept`` does not depend on the order.
    """
    rules = default_rules() if rules is None else rules
    plan = ordered(rules, estimate(docs, rules, sample_rows))
    counted = base_counts(docs).withColumn("base_failed", base_failed())
    why = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(plan))
    return counted.withColumn("rejected_by", why).withColumn("kept", F.col("rejected_by").isNull()).drop("words")
