"""Operator 2: URL filter by the ratio of two character language models (DataFrame functions only).

Two smoothed variable-order Markov models, one of accepted and one of rejected URLs, give
every character of a URL a probability after each of its contexts of 0 to ``order``
characters. Orders are interpolated from the shortest to the longest context that was seen
(Witten-Bell: a context's weight for the next shorter one is its number of different
continuations), so rare contexts back off. A URL's score is the difference of the two log
likelihoods divided by its length; it is blocked if the score is above a threshold.

The models train on four fifths of the labelled URLs (by a hash of the URL). The rest
calibrates: the threshold is the score that best separates its rejected from its accepted
URLs (highest balanced accuracy, the middle of the best stretch).

All counts are taken over distinct character windows: a window of order + 1 characters
determines its log ratio, so positions are grouped to windows first (pre-aggregated per
task), suffix counts come from the windows, and each URL joins its positions to the
windows' ratios. The model is a table and grows with the input; only the calibration
histogram (at most 801 rows per class) reaches the driver.

With ``whole`` (``op2_url_filter``) the models train on and score the whole URL, scheme, query
and fragment included, and every row counts, in the window counts and in the calibration.
Without it they read host + path, each distinct one once. Rules read host and path only.

Rules: a rule ``host/path`` fits its host and all subdomains if the URL's path starts with
the rule's path; the longest fitting rule decides, else the models do.

Defined results: a null URL or one without ``://`` has empty host and path, no rule, and
the score of the empty text (with ``whole``, the score of what is there); very long texts are scored to their end; repeated rows are judged one
by one; with no accepted or no rejected training URL every score is 0 and the verdict is
allow; an empty table gives an empty result; other columns pass through, columns named like
a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmarts.llm.common import UPPER, Workspace

ORDER = 5
PAD, END = "\x02", "\x03"
ALPHABET = 256.0


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """``host``: after the first :// up to / ? # or end, A-Z lower-cased; ``path``: then up to ? # or end."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.locate("://", u)
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return pages.withColumns({"host": F.translate(host, UPPER, UPPER.lower()), "path": path})


def rule_columns(rules: dict[str, str]) -> tuple[Column, Column]:
    """(rule, its verdict) by the longest fitting rule; null where none fits."""
    rule = verdict = None
    for text in sorted(rules, key=lambda r: (-len(r), r)):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(rules[text])) if verdict is None else verdict.when(fits, F.lit(rules[text]))
    none = F.lit(None).cast("string")
    return (rule, verdict) if rules else (none, none)


def windows_of(text: Column, order: int) -> Column:
    """One window of order + 1 characters for each character of the text and its end."""
    padded = F.concat(F.lit(PAD * order), text, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, F.lit(order + 1)))


def window_ratios(train: DataFrame, windows: DataFrame, order: int, ws: Workspace) -> DataFrame:
    """(win, ratio): log P(last character | rejected) - log P(... | accepted) for ``windows``.

    ``train`` has text, rejected (boolean) and copies; ``windows`` the distinct windows to score.
    """
    seen = (train.select("rejected", "copies", F.explode(windows_of(F.col("text"), order)).alias("win"))
            .groupBy("win").agg(*_sides()))
    suffix = F.transform(F.sequence(F.lit(0), F.lit(order)), lambda k: F.struct(
        k.alias("k"), F.substring("win", order + 1 - k, k + 1).alias("gram")))
    grams = ws.store(seen.select("r", "a", F.explode(suffix).alias("x")).groupBy("x.k", "x.gram")
                     .agg(F.sum("r").alias("r"), F.sum("a").alias("a")), "grams")
    contexts = ws.store(grams.select("k", F.substring("gram", F.lit(1), F.col("k")).alias("ctx"), "r", "a").groupBy("k", "ctx").agg(
        F.sum("r").alias("nr"), F.sum("a").alias("na"),
        F.count_if(F.col("r") > 0).alias("tr"), F.count_if(F.col("a") > 0).alias("ta")), "contexts")
    wanted = windows.select("win", F.explode(suffix).alias("x")).select(
        "win", "x.k", "x.gram", F.substring("x.gram", F.lit(1), F.col("x.k")).alias("ctx"))
    met = (wanted.join(grams, ["k", "gram"], "left").join(contexts, ["k", "ctx"], "left")
           .select("win", "k", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("r", "a", "nr", "na", "tr", "ta")]))
    by_order = met.groupBy("win").agg(F.array_sort(F.collect_list(F.struct("k", "r", "a", "nr", "na", "tr", "ta"))).alias("o"))

    def log_likelihood(count: str, total: str, kinds: str) -> Column:
        base = F.lit(1.0 / ALPHABET)
        mixed = F.aggregate("o", base, lambda p, x: F.when(
            x[total] > 0, (x[count] + x[kinds] * p) / (x[total] + x[kinds])).otherwise(p))
        return F.log(mixed)

    return by_order.select("win", (log_likelihood("r", "nr", "tr") - log_likelihood("a", "na", "ta")).alias("ratio"))


def _sides() -> list[Column]:
    """Copies of rejected (r) and accepted (a) rows."""
    return [F.sum(F.when(side, F.col("copies")).otherwise(0)).alias(name)
            for name, side in (("r", F.col("rejected")), ("a", ~F.col("rejected")))]


def calibrate(scored: DataFrame) -> float:
    """Threshold with the highest balanced accuracy over ``scored`` (score, rejected, copies)."""
    binned = scored.select("rejected", "copies", F.round(F.greatest(F.lit(-8.0), F.least(F.lit(8.0), "score")) / 0.02).cast("int").alias("bin"))
    rows = binned.groupBy("bin").agg(*_sides()).orderBy("bin").collect()
    n_r, n_a = sum(x.r for x in rows), sum(x.a for x in rows)
    if not n_r or not n_a:
        return 0.0
    # block above a bin: rejected above it and accepted at or below it are right
    right = 1.0
    steps = [(rows[0].bin - 1, right)]
    for x in rows:
        right += x.a / n_a - x.r / n_r
        steps.append((x.bin, right))
    best = max(v for _, v in steps)
    at = [k for k, (_, v) in enumerate(steps) if v > best - 1e-12]
    low = steps[at[0]][0]
    high = steps[at[-1] + 1][0] if at[-1] + 1 < len(steps) else steps[at[-1]][0] + 1
    return (low + high) / 2 * 0.02


def judge(pages: DataFrame, rules: dict[str, str], url: str = "url", key: str = "page_id", order: int = ORDER,
          whole: bool = False) -> DataFrame:
    """``pages`` with host, path, rule, score and verdict; the models learn from the URLs that a rule decides."""
    ws = Workspace(pages.sparkSession, "url-lm")
    rule, by_rule = rule_columns(rules)
    # the URL is taken first: host and path replace columns of these names
    parted = (with_host_and_path(pages.withColumn("_url", F.coalesce(F.col(url), F.lit(""))), url)
              .withColumns({"rule": rule, "_by_rule": by_rule})
              .withColumn("_text", F.col("_url") if whole else F.concat("host", "path")).drop("_url"))
    texts = ws.store(parted.select(F.col("_text").alias("text"), (F.col("_by_rule") == "block").alias("rejected"))
                     .groupBy("text", "rejected").agg((F.count(F.lit(1)) if whole else F.lit(1).cast("long")).alias("copies")), "texts")
    labelled = texts.where("rejected IS NOT NULL")
    held = F.pmod(F.xxhash64("text"), F.lit(5)) == 0
    train = labelled.where(~held)
    kinds = {r["rejected"] for r in train.select("rejected").distinct().collect()}
    places = texts.select("text").distinct().select("text", F.explode(windows_of(F.col("text"), order)).alias("win"))
    if len(kinds) == 2:
        windows = ws.store(places.groupBy("win").agg(F.count(F.lit(1)).alias("c")).select("win"), "windows")
        ratios = ws.store(window_ratios(train, windows, order, ws), "ratios")
        scores = ws.store(places.join(ratios, "win").groupBy("text").agg(F.avg("ratio").alias("score")), "scores")
        threshold = calibrate(labelled.where(held).join(scores, "text").select("rejected", "copies", "score"))
    else:
        scores, threshold = texts.select("text").distinct().withColumn("score", F.lit(0.0)), 0.0
    out = parted.join(scores.withColumnRenamed("text", "_text"), "_text")
    verdict = F.coalesce("_by_rule", F.when(F.col("score") > threshold, F.lit("block")).otherwise(F.lit("allow")))
    return out.withColumn("verdict", verdict).drop("_text", "_by_rule")
