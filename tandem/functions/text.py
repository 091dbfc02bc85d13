"""Text expressions. Everything here is a Catalyst expression; no UDF."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tandem.config import MIN_TOKEN_LENGTH, STOP_WORDS

# Fixed value: the characters Unicode-aware string splitting treats as white
# space (Java's and RE2's \s cover ASCII only).
WHITESPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    Catalyst inlines a projected expression into every place that uses it, so an
    array referenced several times would be tokenised several times over.
    """
    return F.transform(F.array(value), body)[0]


def clean_tokens(text: Column) -> Column:
    """Lowercase letter runs of ``text`` without stop words; null gives ``[]``.

    ``isin`` on literals becomes a hash set, so each token costs one lookup.
    """
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]+")
    return F.filter(words, lambda w: (w != "") & ~w.isin(*STOP_WORDS))


def clean_text(text: Column) -> Column:
    return F.array_join(clean_tokens(text), " ")


def split_clean(clean: Column) -> Column:
    """Tokens of an already cleaned text (single spaces)."""
    return F.filter(F.split(clean, " "), lambda w: w != "")


def model_tokens(clean: Column, min_length: int = MIN_TOKEN_LENGTH) -> Column:
    """Tokens the vectoriser sees: those of at least ``min_length`` letters."""
    return F.filter(F.split(F.coalesce(clean, F.lit("")), " "),
                    lambda w: F.length(w) >= min_length)


def ngrams(tokens: Column, low: int = 1, high: int = 1) -> Column:
    """All n-grams with ``low <= n <= high``, space-joined, shorter ones first."""
    if (low, high) == (1, 1):
        return tokens

    def runs(words: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, joined).otherwise(F.array().cast("array<string>"))

    return bind(tokens, lambda words: F.concat(*[runs(words, n) for n in range(low, high + 1)]))


def title_length(title: Column) -> Column:
    """Characters (code points) of the raw title; null counts as empty."""
    return F.length(F.coalesce(title, F.lit("")))


def title_words(title: Column) -> Column:
    """White-space separated words of the raw title."""
    words = F.split(F.coalesce(title, F.lit("")), f"[{WHITESPACE}]+")
    return F.size(F.filter(words, lambda w: w != ""))


def is_blank(text: Column) -> Column:
    """True for null, empty or white-space-only text."""
    return ~F.coalesce(text, F.lit("")).rlike(f"[^{WHITESPACE}]")
