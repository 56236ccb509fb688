"""Text helpers: word tokens, mail header fields.

All built-in string functions and higher-order array functions, so they run
inside the JVM and stay in whole-stage code generation where Spark allows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: stop-word list of the reference's TF-IDF program, in its order
# (it lists "to" twice)
STOP_WORDS = [
    "the", "i", "a", "an", "at", "are", "am", "for", "and", "or", "is",
    "there", "it", "this", "that", "on", "was", "by", "of", "to", "in",
    "to", "message", "not", "be", "with", "you", "have", "as", "can",
]

# whitespace set of a default string tokenizer: space, tab, newline, CR, form feed
WHITESPACE = "[ \\t\\n\\r\\f]+"
WORD = "^[a-z]+$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def words(text, stop_words=STOP_WORDS) -> Column:
    """Lower-cased whitespace tokens made only of ASCII letters, stop words removed.

    Keeps duplicates (term frequency needs them); ``F.array_distinct`` on the
    result gives the unique words of a text.
    """
    stops = F.array(*[F.lit(w) for w in dict.fromkeys(stop_words)])
    toks = F.split(F.lower(_c(text)), WHITESPACE)
    return F.filter(toks, lambda w: w.rlike(WORD) & ~F.array_contains(stops, w))


def month_of(time_text) -> Column:
    """First seven characters of a time text: ``yyyy-MM`` (F8)."""
    return F.substring(_c(time_text), 1, 7)


def email_address(sender) -> Column:
    """Address inside the last ``<...>`` of a sender field, without the final ``>`` (F8)."""
    s = F.substring_index(_c(sender), "<", -1)
    return F.substring(s, F.lit(1), F.length(s) - 1)


def word_rows(df, text_col: str, keep: list[str], stop_words=STOP_WORDS, out: str = "word"):
    """One row per word of ``text_col`` (same rules as ``words``), with ``keep`` columns.

    Exploding the raw tokens first and filtering rows keeps the letters-only and
    stop-word tests in generated code; the array form (``words``) evaluates them
    in an interpreted lambda and is about twice as slow on long texts.
    """
    toks = df.select(*keep, F.explode(F.split(F.lower(F.col(text_col)), WHITESPACE)).alias(out))
    return toks.filter(F.col(out).rlike(WORD) & ~F.col(out).isin(list(dict.fromkeys(stop_words))))
