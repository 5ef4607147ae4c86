"""The text rules in SQL, built from the same fixed values as the column expressions."""

from __future__ import annotations

from ludolake.functions.text import (CLEANING_STEPS, MODIFIERS, NEGATIVE_WEIGHT, NEGATIVE_WORDS,
                                     POSITIVE_WEIGHT, POSITIVE_WORDS)


def clean_sql(text: str) -> str:
    out = f"lower({text})"
    for pattern, replacement in CLEANING_STEPS:
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', 'g')"
    return f"trim({out})"


def context_sql(clean: str) -> str:
    def found(words):
        return " + ".join(f"CAST(contains({clean}, '{w}') AS INTEGER)" for w in words)

    total = f"(({found(POSITIVE_WORDS)}) * {POSITIVE_WEIGHT}e0 + ({found(NEGATIVE_WORDS)}) * ({NEGATIVE_WEIGHT}e0))"
    for word, adjustment in MODIFIERS.items():
        total = f"({total} + CASE WHEN contains({clean}, '{word}') THEN ({adjustment}e0) ELSE 0.0e0 END)"
    return f"greatest(-2.0e0, least(2.0e0, {total}))"


def _stage(name: str, source: str, columns: str, drop: str = "") -> str:
    star = f"* EXCLUDE ({drop})" if drop else "*"
    return f"{name} AS MATERIALIZED (SELECT {star}, {columns} FROM {source})"


START = "(0.0e0 * 1.2e0 + 0.2e0) / 2.0e0"
START_NEUTRAL = "(0.0e0 + 0.6e0) / 2.0e0"


def scored_sql(source: str, text: str, name: str = "scored") -> str:
    """CTEs that score ``source`` with the library-free ensemble; the last one is ``name``."""
    boost = "least(abs(ctx) * 0.15e0, 0.4e0)"
    up = "least(1.0e0, {0} + " + boost + ")"
    down = "greatest(0.0e0, {0} - " + boost + " * 0.5e0)"
    stages = [
        _stage(f"{name}_clean", source, f"{clean_sql(text)} AS clean_text"),
        _stage(f"{name}_ctx", f"{name}_clean",
               f"coalesce({context_sql('clean_text')}, 0.0e0) AS ctx, {START} AS p0, {START} AS q0, "
               f"{START_NEUTRAL} AS u0"),
        _stage(f"{name}_shift", f"{name}_ctx",
               f"CASE WHEN ctx > 0 THEN {up.format('p0')} WHEN ctx < 0 THEN {down.format('p0')} ELSE p0 END AS p1, "
               f"CASE WHEN ctx > 0 THEN {down.format('q0')} WHEN ctx < 0 THEN {up.format('q0')} ELSE q0 END AS q1"),
        _stage(f"{name}_norm", f"{name}_shift",
               "p1 / (p1 + q1 + u0) AS pos, q1 / (p1 + q1 + u0) AS neg, u0 / (p1 + q1 + u0) AS neu"),
        _stage(f"{name}_label", f"{name}_norm",
               "CASE WHEN neg > 0.35e0 AND neg > pos THEN 'negative' WHEN pos > 0.35e0 AND pos > neg "
               "THEN 'positive' ELSE 'neutral' END AS label, "
               "CASE WHEN neg > 0.35e0 AND neg > pos THEN neg WHEN pos > 0.35e0 AND pos > neg THEN pos "
               "ELSE greatest(neu, 0.4e0) END AS sure, coalesce(clean_text, '') = '' AS no_text"),
        _stage(name, f"{name}_label",
               "CASE WHEN no_text THEN 'neutral' ELSE label END AS sentiment, "
               "CASE WHEN no_text THEN 0.5e0 ELSE sure END AS sentiment_confidence, "
               "CASE WHEN no_text THEN 0.33e0 ELSE pos END AS positive_score, "
               "CASE WHEN no_text THEN 0.33e0 ELSE neg END AS negative_score, "
               "CASE WHEN no_text THEN 0.34e0 ELSE neu END AS neutral_score"),
    ]
    return ", ".join(stages)


SCORED = "WITH " + scored_sql("reviews", "text")
