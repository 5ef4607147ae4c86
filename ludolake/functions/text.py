"""Review text: cleaning and keyword scores as built-in string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every space the cleaning treats as whitespace, as character class bodies. Single characters are
# listed one by one, which the regex engine looks up at once; ranges it tries one after another.
ASCII_SPACES = r"\t\n\x{0B}\f\r\x{1C}\x{1D}\x{1E}\x{1F} "
SPACES = (ASCII_SPACES + r"\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
          r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")

# Cleaning steps in order, (pattern, replacement).
CLEANING_STEPS = [
    (r"\p{Nd}+/\p{Nd}+", ""),
    (r"[!]{2,}", "!"),
    (r"[?]{2,}", "?"),
    (r"[.]{3,}", "..."),
    (f"http[^{SPACES}]+|www[^{SPACES}]+", ""),
    (f"[{SPACES}]+", " "),
]

# A step can only change a text that holds one of its marks; looking for a mark is far cheaper
# than a pattern search. The last step, squeezing spaces, always runs.
STEP_MARKS = [["/"], ["!!"], ["??"], ["...."], ["http", "www"]]

# Positive and negative words and their weights.
POSITIVE_WORDS = [
    "epic", "amazing", "addictive", "fun", "engaging", "immersive",
    "masterpiece", "brilliant", "fantastic", "gorgeous", "stunning",
    "smooth", "polished", "innovative", "creative", "enjoyable",
    "excellent", "outstanding", "solid", "rewarding", "satisfying",
    "compelling", "captivating", "impressive", "beautiful", "perfect",
    "recommend", "love", "great", "good", "nice", "wonderful",
]
POSITIVE_WEIGHT = 2.0
NEGATIVE_WORDS = [
    "buggy", "broken", "unplayable", "laggy", "boring", "repetitive",
    "terrible", "awful", "disappointing", "frustrating", "annoying",
    "glitchy", "crashing", "unfinished", "overpriced", "waste",
    "horrible", "pathetic", "useless", "garbage", "trash",
    "unoptimized", "pay2win", "microtransaction", "cashgrab",
    "regret", "hate", "dislike", "bad", "worst", "mess",
]
NEGATIVE_WEIGHT = -2.5

# Modifier word, adjustment.
MODIFIERS = {
    "but": -0.8,
    "however": -0.8,
    "except": -0.5,
    "unfortunately": -1.0,
    "definitely": 0.4,
    "absolutely": 0.5,
    "highly": 0.4,
    "recommend": 0.6,
    "suggest": 0.3,
    "avoid": -1.2,
    "refund": -1.5,
    "waste": -1.3,
    "regret": -1.2,
    "buying": 0.0,
    "overall": 0.2,
}

# Words of the quick indicator, and the candidate text columns in order.
INDICATOR_POSITIVE = ["amazing", "great", "fantastic", "love"]
INDICATOR_NEGATIVE = ["terrible", "awful", "hate", "worst"]
TEXT_COLUMNS = ["review_text", "review", "content", "text", "comment"]


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it.

    Plain column chains would be copied into every place that uses them, also when a filter on a
    result column is pushed below them; a bound variable keeps the expression linear in size.
    """
    return F.transform(F.array(value), body)[0]


def _cleaning_step(pattern: str, replacement: str, marks: list[str]):
    def apply(t: Column) -> Column:
        marked = F.contains(t, F.lit(marks[0]))
        for mark in marks[1:]:
            marked = marked | F.contains(t, F.lit(mark))
        return F.when(marked, F.regexp_replace(t, pattern, replacement)).otherwise(t)

    return apply


def _squeeze_spaces(t: Column) -> Column:
    pattern, blank = CLEANING_STEPS[-1]
    plain = F.octet_length(t) == F.char_length(t)
    return (F.when(plain, F.regexp_replace(t, f"[{ASCII_SPACES}]+", blank))
            .otherwise(F.regexp_replace(t, pattern, blank)))


def clean_review(text: Column) -> Column:
    """Lower-cased text without scores like 10/10, URLs, or repeated punctuation and spaces."""
    cleaned = F.lower(text)
    for (pattern, replacement), marks in zip(CLEANING_STEPS, STEP_MARKS):
        cleaned = let(cleaned, _cleaning_step(pattern, replacement, marks))
    return F.trim(let(cleaned, _squeeze_spaces))


def _words_present(text: Column, words: list[str]) -> Column:
    lexicon = F.array(*[F.lit(w) for w in words])
    return F.size(F.filter(lexicon, lambda word: F.contains(text, word)))


def context_score(clean: Column) -> Column:
    """Each listed word found anywhere in the cleaned text adds its weight once; within -2..2.

    Containment is by substring on purpose ("but" is found in "button"): the rule is so defined.
    """
    total = (_words_present(clean, POSITIVE_WORDS) * F.lit(POSITIVE_WEIGHT)
             + _words_present(clean, NEGATIVE_WORDS) * F.lit(NEGATIVE_WEIGHT))
    for word, adjustment in MODIFIERS.items():
        total = total + F.when(F.contains(clean, F.lit(word)), F.lit(adjustment)).otherwise(F.lit(0.0))
    return F.greatest(F.lit(-2.0), F.least(F.lit(2.0), total))


def sentiment_indicator(text: Column) -> Column:
    """Quick label of a streamed review from two short word lists; positive words win."""
    lowered = F.coalesce(F.lower(text), F.lit(""))
    return (F.when(lowered.rlike("|".join(INDICATOR_POSITIVE)), F.lit("positive"))
            .when(lowered.rlike("|".join(INDICATOR_NEGATIVE)), F.lit("negative"))
            .otherwise(F.lit("neutral")))


def pick_text_column(columns: list[str]) -> str | None:
    """First of the known text columns that is present."""
    return next((c for c in TEXT_COLUMNS if c in columns), None)


def synthetic_review(columns: list[str]) -> Column:
    """Stand-in text from hours and votes, for reviews that carry no text."""
    hours = F.col("playtime_hours") if "playtime_hours" in columns else F.lit(0)
    helpful = F.col("helpful_votes") if "helpful_votes" in columns else F.lit(0)
    total = F.col("total_votes") if "total_votes" in columns else F.lit(1)
    verdict = (F.when(helpful > total / F.lit(2), F.lit("Highly recommended!"))
               .otherwise(F.lit("Could be better.")))
    return F.format_string("Game review with %s hours played. Helpful votes: %s, Total votes: %s. %s",
                           hours.cast("string"), helpful.cast("string"), total.cast("string"), verdict)
