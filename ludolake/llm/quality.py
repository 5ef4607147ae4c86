"""Operator 9: quality rules whose cutoffs limit false rejections, with exact binomial bounds.

Every rule is a whole number of thousandths ("badness") computed from the whole text. A setting has one
cutoff for each rule; settings are nested, from cutoffs that no good document of the tuning half
exceeds to ever tighter ones. On the other half of the labelled rows each stratum tests the settings in
this order. A setting passes if its false rejections among the good documents are so few that a true
rate above ``risk`` would show as few with probability at most ``error / strata`` (exact binomial tail,
Bonferroni over the strata). Testing stops at the first that does not pass, so the order needs no
further correction (fixed-sequence testing). A stratum uses the mildest passing setting that rejects
49 of 50 poor tuning documents that any passing one rejects; a stratum without a passing setting rejects nothing.

Defined results: a null or empty text has no words, so it fails the base rule. Null strata form a
stratum of their own. Labelled rows with null or contradicting labels are not used. Without labels only
the base rule rejects. Repeated rows are judged alike; other columns are passed through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolake.llm.common import agreed, as_text, fold_of, own_name, per_row, stored
from ludolake.llm.wordhash import _separators, WHITE, mix, windows, words

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SYMBOLS = b"#*$%&|<>"
REPEAT_SPAN = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Share of good tuning documents above the cutoffs of one setting, mildest first.
SETTINGS = (0.0, 0.0005, 0.001, 0.002, 0.005, 0.01, 0.02)
RULES = ("long_words", "short_words", "symbols", "repeated_lines", "repeated_words", "few_words")


def _repeated(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For every word whether it lies in a window that occurs twice or more in its row."""
    row = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    spans = windows(hashes, REPEAT_SPAN)
    marks = np.zeros(len(hashes) + 1, dtype=np.int64)
    if len(spans):
        at = np.flatnonzero(row[:len(spans)] == row[REPEAT_SPAN - 1:])
        keys = mix(spans[at] + mix(row[at] + np.uint64(1)))
        ranked = np.sort(keys)
        twice = ranked[1:][ranked[1:] == ranked[:-1]]
        hit = at[np.isin(keys, twice)] if len(twice) else at[:0]
        marks[hit] += 1
        marks[hit + REPEAT_SPAN] -= 1
    return np.cumsum(marks[:-1]) > 0


def _text_stats(texts: pa.Array) -> pa.Array:
    symbol = _separators(SYMBOLS)
    out = []
    for own, lines in zip(words(texts), words(texts, separators=b"\n")):
        data, at = own.data, own.offsets
        letters = (data & 0xC0) != 0x80
        letters[_separators(WHITE)[data]] = False
        inside = np.searchsorted(own.starts, lines.starts) < np.searchsorted(own.starts, lines.ends)
        row = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(lines.bounds))
        keys = mix(lines.hashes + mix(row + np.uint64(1)))
        kept = np.flatnonzero(inside)
        _, first = np.unique(keys[kept], return_index=True)
        again = inside.copy()
        again[kept[first]] = False
        out.append(np.stack([np.diff(own.bounds), per_row(letters, at), per_row(symbol[data], at),
                             per_row(again, lines.bounds), per_row(_repeated(own.hashes, own.bounds), own.bounds),
                             per_row(inside, lines.bounds)]))
    table = np.concatenate(out, axis=1) if out else np.zeros((len(STATS), 0), np.int64)
    return pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in table], list(STATS))


def text_stats(text: Column) -> Column:
    """Struct of ``STATS`` of a text column."""
    return F.arrow_udf(_text_stats, ", ".join(f"{s} long" for s in STATS))(text)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (s["n_repeat_words"] * 100 > s["n_words"] * MAX_REPEAT_PERCENT)


def badness(s: Column) -> dict[str, Column]:
    """Rule name to thousandths, larger is worse; 0 to 1000 except for odd word lengths."""
    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, F.floor(part * 1000 / whole)).otherwise(0).cast("int")

    per_word = F.when(s["n_words"] > 0, s["word_chars"] * 20 / s["n_words"]).otherwise(0)
    return {"long_words": F.least(F.floor(per_word), F.lit(1000)).cast("int"),
            "short_words": F.greatest(F.lit(1000) - F.floor(per_word), F.lit(0)).cast("int"),
            "symbols": share(s["n_symbols"], s["word_chars"]),
            "repeated_lines": share(s["n_dup_lines"], s["n_lines"]),
            "repeated_words": share(s["n_repeat_words"], s["n_words"]),
            "few_words": F.greatest(F.lit(1000) - s["n_words"], F.lit(0)).cast("int")}


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(at most k of n) at rate p, exactly."""
    if k >= n:
        return 1.0
    terms = [lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p)
             for i in range(k + 1)]
    top = max(terms)
    return min(1.0, exp(top) * sum(exp(t - top) for t in terms))


@dataclass
class QualityModel:
    """Cutoffs of every setting, and the setting each stratum uses."""

    settings: list[dict[str, int]]
    chosen: dict[str | None, int] = field(default_factory=dict)
    evidence: list[dict] = field(default_factory=list)

    def rejects(self, setting: int, bad: dict[str, Column]) -> Column:
        hit = F.lit(False)
        for rule, cutoff in self.settings[setting].items():
            hit = hit | (bad[rule] > cutoff)
        return hit

    def verdict(self, stats: Column, stratum: Column) -> Column:
        """True where the method rejects."""
        bad, out = badness(stats), F.lit(False)
        for setting in sorted(set(self.chosen.values())):
            names = [s for s, c in self.chosen.items() if c == setting]
            own = stratum.isin([s for s in names if s is not None])
            own = F.coalesce(own, F.lit(None in names))
            out = out | (own & self.rejects(setting, bad))
        return out


def fit_quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang", text: str = "text",
                key: str = "doc_id", risk: float = 0.01, error: float = 0.05) -> QualityModel:
    """Cutoffs from the labelled rows of ``docs``; all of them count.

    Only tables of counts come to the driver: (rule, thousandth, label) for the tuning half, and
    (stratum, setting) for the holdout, of strata with enough good rows to pass any test.
    """
    known = docs.select(F.col(key), F.col(stratum).cast("string").alias("stratum"),
                        text_stats(as_text(text)).alias("s"))
    known = known.join(agreed(labels, key, "quality"), key).filter(~base_failed(F.col("s")))
    known = stored(known.select("stratum", "quality", *[c.alias(r) for r, c in badness(F.col("s")).items()],
                                (fold_of(F.col(key), 2) == 0).alias("tuning")), "quality")
    pairs = F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("bad")) for r in RULES]))
    counts = (known.filter("tuning").select("quality", pairs).groupBy("rule", "bad")
              .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("poor"))
              .collect())
    model = QualityModel(_nested_settings(counts))
    enough = log(1 / error) / risk
    strata = (known.filter("not tuning and quality = 1").groupBy("stratum").agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") >= enough))
    strata = strata.select(F.col("stratum").alias("enough"))
    held = known.join(strata, F.col("stratum").eqNullSafe(F.col("enough")), "left_semi")
    bad = {r: F.col(r) for r in RULES}
    hits = [F.count_if(model.rejects(i, bad)).alias(f"r{i}") for i in range(len(model.settings))]
    found: dict = {}
    for row in held.groupBy("stratum", "tuning", "quality").agg(F.count(F.lit(1)).alias("n"), *hits).collect():
        found.setdefault(row["stratum"], {})[row["tuning"], row["quality"]] = row
    tested = {s: x for s, x in found.items() if (False, 1) in x}
    for name, rows in tested.items():
        good, poor, passed = rows[False, 1], rows.get((True, 0)), []
        for i in range(len(model.settings)):
            tail = binomial_tail(good[f"r{i}"], good["n"], risk)
            model.evidence.append({"stratum": name, "setting": i, "good": good["n"], "rejected": good[f"r{i}"],
                                   "tail": tail})
            if tail > error / len(tested):
                break
            passed.append(i)
        if passed and poor is not None:
            most = max(poor[f"r{i}"] for i in passed)
            if most:
                model.chosen[name] = next(i for i in passed if poor[f"r{i}"] * 50 >= most * 49)
    return model


def _nested_settings(counts: list) -> list[dict[str, int]]:
    """Cutoffs per setting. A rule takes part where it hits poor documents at ten times the good rate or more."""
    out: list[dict[str, int]] = []
    for share in SETTINGS:
        setting = {}
        for rule in RULES:
            own = sorted(((r["bad"], r["good"], r["poor"]) for r in counts if r["rule"] == rule), reverse=True)
            goods, poors = sum(r[1] for r in own), sum(r[2] for r in own)
            if not goods or not poors:
                continue
            above_good = above_poor = 0
            cutoff = None
            for bad, good, poor in own:
                cutoff = bad
                if above_good + good > share * goods:
                    break
                above_good, above_poor = above_good + good, above_poor + poor
            if above_poor and above_poor / poors >= 10 * above_good / goods:
                setting[rule] = cutoff
        if out:  # nested: what a milder setting has stays, and no cutoff grows
            setting = {r: min(setting.get(r, 1 << 30), out[-1].get(r, 1 << 30)) for r in setting | out[-1]}
        out.append(setting)
    return out


def judge_quality(docs: DataFrame, model: QualityModel, stratum: str = "lang", text: str = "text",
                  prefix: str = "") -> DataFrame:
    """All columns of ``docs`` and, each with ``prefix``: the statistics, ``base_failed`` and ``kept``."""
    name = own_name("stats")
    s = F.col(name)
    out = docs.withColumn(name, text_stats(as_text(text)))
    keep = ~base_failed(s) & ~model.verdict(s, F.col(f"`{stratum}`").cast("string"))
    new = {f"{prefix}{x}": s[x] for x in STATS} | {f"{prefix}base_failed": base_failed(s), f"{prefix}kept": keep}
    return out.withColumns(new).drop(name)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    model = fit_quality(docs, labels, **options)
    name = own_name("q")
    judged = judge_quality(docs, model, prefix=name)
    return judged.filter(F.col(f"{name}kept")).select(*[f"`{c}`" for c in docs.columns])
