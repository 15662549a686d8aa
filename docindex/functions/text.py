"""Text analysis: lower-case words, split on anything that is not a letter or digit."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

WORD_CHARACTER = "[\\p{L}\\p{N}]"
WORD_BREAK = "[^\\p{L}\\p{N}]+"


def tokens(text: Column) -> Column:
    """Words of a text in order; text without words (or null) gives an empty list."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAK), "")


def query_words(query: str) -> list[str]:
    """The same analysis for a query string, on the driver; each word once."""
    return list(dict.fromkeys(query_words_in_order(query)))


def query_words_in_order(query: str) -> list[str]:
    kept = (c if unicodedata.category(c)[0] in "LN" else " " for c in query.lower())
    return "".join(kept).split()


def has_word(text: Column, word: str) -> Column:
    """True where ``word`` is one of the text's words."""
    return has_any_word(text, [word])


def has_any_word(text: Column, words: list[str]) -> Column:
    """True where any of the words is one of the text's words."""
    if not words:
        return F.lit(False)
    return F.coalesce(F.lower(text).rlike("|".join(map(word_pattern, words))), F.lit(False))


def word_pattern(word: str) -> str:
    """A whole word in lower-cased text. The word itself comes first in the
    pattern, so that most positions of a text fail on one character."""
    return f"{word}(?<!{WORD_CHARACTER}{word})(?!{WORD_CHARACTER})"


def has_phrase(text: Column, words: list[str]) -> Column:
    """True where the words stand one after the other."""
    pattern = WORD_BREAK.join(words)
    return F.coalesce(F.lower(text).rlike(f"(?<!{WORD_CHARACTER}){pattern}(?!{WORD_CHARACTER})"), F.lit(False))


def has_prefix(text: Column, prefix: str) -> Column:
    """True where one of the text's words begins so."""
    return F.coalesce(F.lower(text).rlike(f"(?<!{WORD_CHARACTER}){prefix}"), F.lit(False))
