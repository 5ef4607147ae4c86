"""Operator 3: URL filter by the ratio of two character language models, in DataFrame functions only.

Rules judge the urls they fit; the urls they judge are the examples of accepted and rejected ones. For both
classes a variable-order Markov model predicts each character from the ``ORDER`` before it: counts of
longer contexts are smoothed with the estimate of the next shorter one, and a context never seen hands over to
it. The models are two arrays indexed by folded characters, so their size depends on the alphabet
alone (``len(ALPHABET) ** (ORDER + 1)`` numbers) and scoring needs no join.

A url's score is the difference of its two log-likelihoods over its length. The threshold is the score that best
separates the judged urls of the calibration fold (balanced accuracy), which the models have not seen.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule; a null or empty
url scores 0. If rules judge no url, or only one way, all scores are 0 and 0 is the threshold; scores from the
threshold up are allowed. Repeated rows count as often as they occur. Other columns are not touched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolake.llm.common import fold_of, stored

#: Folded characters: letters, digit, marks; all others are one. The first stands for "before the url".
ALPHABET = "^abcdefghijklmnopqrstuvwxyz0/.-?=&#_%*"
ORDER = 2
STRENGTH = 4.0      # observations that a shorter context's estimate is worth
FOLDS, CALIBRATION = 4, 3
STEP = 1000         # score steps per unit of log-likelihood a character

#: Fixed values of the contract: rule (host and path) and verdict.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null or a url without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule string and verdict of the longest fitting rule, else nulls."""
    ordered = sorted(rules, key=lambda r: (-len(r[0]), -len(r[0].partition("/")[0]), r[0]))
    rule = verdict = None
    for text, outcome in ordered:
        own, slash, path_start = text.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + path_start)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, outcome) if verdict is None else verdict.when(fits, outcome)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def _codes(url: Column) -> Column:
    """Folded character codes of a url; 0 stands for nothing before it."""
    lowered = F.regexp_replace(F.regexp_replace(F.lower(url), "[0-9]", "0"), "[^a-z0/.\\-?=&#_%]", "*")
    return F.transform(F.split(F.coalesce(lowered, F.lit("")), ""), lambda c: F.greatest(F.instr(F.lit(ALPHABET), c) - 1, F.lit(0)))


def _url_codes(url: Column) -> Column:
    return F.filter(_codes(url), lambda c: c > 0)


def _context_codes(codes: Column, order: int) -> Column:
    """For every character the number that its ``order`` predecessors and itself spell in base ``len(ALPHABET)``."""
    base = len(ALPHABET)
    padded = F.concat(F.array(*[F.lit(0)] * order), codes) if order else codes
    return F.transform(codes, lambda c, i: reduce(
        lambda sum_, k: sum_ * base + F.get(padded, i + k), range(1, order + 1), F.get(padded, i)))


def _model(judged: DataFrame) -> DataFrame:
    """One row: array of log-likelihood differences, indexed by the code of the longest context and character."""
    base = len(ALPHABET)
    grams = judged.select("allowed", F.explode(_context_codes(F.col("codes"), ORDER)).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count_if("allowed").alias("a"), F.count_if(~F.col("allowed")).alias("b"))
    estimates = None
    for order in range(ORDER + 1):
        size = base ** (order + 1)
        own = counts.groupBy((F.col("gram") % size).alias("gram")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        space = judged.sparkSession.range(size).withColumnRenamed("id", "gram")
        space = space.join(own, "gram", "left").na.fill(0, ["a", "b"])
        context = F.floor(F.col("gram") / base)
        totals = own.groupBy(context.alias("context")).agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
        space = space.withColumn("context", context).join(totals, "context", "left").na.fill(0, ["na", "nb"])
        if estimates is None:
            space = space.withColumns({"qa": F.lit(1.0 / base), "qb": F.lit(1.0 / base)})
        else:
            shorter = estimates.select(F.col("gram").alias("short"), F.col("pa").alias("qa"), F.col("pb").alias("qb"))
            space = space.join(shorter, F.col("gram") % (size // base) == F.col("short"))
        estimates = space.select(
            "gram", ((F.col("a") + STRENGTH * F.col("qa")) / (F.col("na") + STRENGTH)).alias("pa"),
            ((F.col("b") + STRENGTH * F.col("qb")) / (F.col("nb") + STRENGTH)).alias("pb"))
    packed = F.array_sort(F.collect_list(F.struct("gram", F.log(F.col("pa") / F.col("pb")).alias("d"))))
    return estimates.agg(F.transform(packed, lambda s: s["d"]).alias("model"))


def _score(codes: Column, model: Column) -> Column:
    total = F.aggregate(_context_codes(codes, ORDER), F.lit(0.0), lambda s, g: s + F.get(model, g))
    return F.when(F.size(codes) > 0, total / F.size(codes)).otherwise(0.0)


def judge_urls(pages: DataFrame, rules=RULES, url: str = "url", key: str = "page_id") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score."""
    host, path = host_and_path(F.col(f"`{url}`").cast("string"))
    rows = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        host.alias("host"), path.alias("path"))
    rule, outcome = matched_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "outcome": outcome, "codes": _url_codes(F.col("url")),
                             "fold": fold_of(F.col("url"), FOLDS)})
    judged = rows.filter("outcome is not null").withColumn("allowed", F.col("outcome") == "allow")
    seen = judged.agg(F.count_if("allowed").alias("a"), F.count_if(~F.col("allowed")).alias("b")).first()
    if not seen["a"] or not seen["b"]:
        return rows.select("page_id", "host", "path", "rule",
                           F.coalesce("outcome", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("score"))
    model = stored(_model(judged.filter(F.col("fold") != CALIBRATION)), "model")
    held = judged.filter(F.col("fold") == CALIBRATION).withColumn("model", model.scalar()).select(
        "allowed", F.round(_score(F.col("codes"), F.col("model")) * STEP).cast("long").alias("step"))
    # Scores are bounded, so there are few distinct steps.
    steps = held.groupBy("step").agg(F.count_if("allowed").alias("a"), F.count_if(~F.col("allowed")).alias("b")).collect()
    threshold = _threshold([(r["step"], r["a"], r["b"]) for r in steps])
    score = _score(F.col("codes"), F.col("model"))
    out = rows.withColumn("model", model.scalar()).withColumn("score", score)
    method = F.when(F.round(F.col("score") * STEP) >= threshold, "allow").otherwise("block")
    return out.select("page_id", "host", "path", "rule", F.coalesce("outcome", method).alias("verdict"), "score")


def _threshold(steps: list[tuple[int, int, int]]) -> int:
    """The step from which urls are allowed, by balanced accuracy; of equal ones the nearest to 0, then the lower."""
    a, b = sum(s[1] for s in steps), sum(s[2] for s in steps)
    if not a or not b:
        return 0
    best, right_a, right_b = (-1.0, 0, 0), a, 0
    for step, own_a, own_b in sorted(steps):
        best = max(best, (right_a / a + right_b / b, -abs(step), -step))
        right_a, right_b = right_a - own_a, right_b + own_b
    return -best[2]
