"""Text columns and word lists."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_of(words: Sequence[str]) -> str:
    """One pattern that matches any of the words as they stand."""
    return "|".join(re.escape(word) for word in words)


def mask_words(text: Column, words: Sequence[str], mask: str) -> Column:
    return F.regexp_replace(text, any_of(words), mask)


def first_word_of(text: Column, words: Sequence[str]) -> Column:
    """The first listed word in the text; an empty string if there is none."""
    return F.regexp_extract(text, f"({any_of(words)})", 1)


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(word) for word in words])


def word_flags(text: Column, words: Sequence[str], prefix: str = "is_") -> list[Column]:
    """One boolean column per word, named after it in lower case."""
    return [text.contains(word).alias(f"{prefix}{word.lower()}") for word in words]
