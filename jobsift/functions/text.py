"""Column helpers on text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsift import lexicons
from jobsift.functions.arrays import distinct_ignore_case, let


def text_of(column: str | Column) -> Column:
    """Null text counts as empty text in every operator."""
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(value.cast("string"), F.lit(""))


def strip(value: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def find_all(value: Column, pattern: str) -> Column:
    """All matches, trimmed, without empties and case-insensitive repeats."""
    found = F.regexp_extract_all(value, F.lit(f"(?iU){pattern}"), F.lit(0))
    cleaned = F.filter(F.transform(found, strip), lambda x: x != "")
    return let(cleaned, distinct_ignore_case)


def find_all_if(value: Column, hint: Column, pattern: str) -> Column:
    """``find_all`` for rows where the cheap ``hint`` says a match is possible."""
    return F.coalesce(F.when(hint, find_all(value, pattern)), F.array().cast("array<string>"))


def joined(values: Column) -> Column:
    return F.array_join(values, ", ")


def normalized(value: Column) -> Column:
    """Lower case; links and all but a-z, 0-9 become blanks; blanks collapsed."""
    no_links = F.regexp_replace(F.lower(value), r"(?U)http\S+|www\.\S+", " ")
    plain = F.regexp_replace(no_links, "[^a-z0-9]+", " ")
    return F.trim(plain)


def word_tokens(normalized_text: Column, contractions: Mapping[str, str] | None = None) -> Column:
    """Split normalised text into words; known contractions become two words."""
    table = lexicons.CONTRACTIONS if contractions is None else contractions
    split = normalized_text
    if table:
        # one test for all contractions keeps the usual row at a single scan
        any_of = r"\b(?:" + "|".join(table) + r")\b"
        changed = split
        for form, parts in table.items():
            changed = F.regexp_replace(changed, rf"\b{form}\b", parts)
        split = F.when(split.rlike(any_of), changed).otherwise(split)
    return F.filter(F.split(split, " "), lambda x: x != "")


def content_tokens(tokens: Column, stop_words: Sequence[str] | None = None) -> Column:
    """Tokens of three characters and more that are not stop words."""
    stops = lexicons.ENGLISH_STOP_WORDS if stop_words is None else list(stop_words)
    if not stops:
        return F.filter(tokens, lambda x: F.length(x) > 2)
    # isin over literals is a hash lookup, not a scan of the list
    return F.filter(tokens, lambda x: (F.length(x) > 2) & ~x.isin(stops))
