"""Text columns: label normalization, metro keys, clipping, JSON facts."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.functions.arrow import arrow_function, map_values

NON_ASCII = r"[^\x00-\x7F]"


def mentions(text: Column, words: list[str]) -> Column:
    """True when a short text (a link, a label) has at least one of the words: one pattern, compiled once."""
    return text.rlike("|".join(re.escape(word) for word in words))


def contains_any(text: Column, words: list[str]) -> Column:
    """True when a long text (a page) contains at least one of the words: plain scans, which beat a pattern there."""
    hit = F.lit(False)
    for word in words:
        hit = hit | F.contains(text, F.lit(word))
    return hit


def count_words(text: Column, words: list[str]) -> Column:
    """How many of a fixed, short list of words the text contains."""
    total = F.lit(0)
    for word in words:
        total = total + F.contains(text, F.lit(word)).cast("int")
    return total


def null_if_empty(text: Column) -> Column:
    return F.when(text != "", text)


def extract(text: Column, pattern: str, group: int) -> Column:
    """First match of a group, NULL when the pattern does not match or the group is empty."""
    return null_if_empty(F.regexp_extract(text, pattern, group))


def collapse_spaces(text: Column) -> Column:
    """Runs of whitespace, non-breaking spaces included, to one space; none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def _plain_words(folded: Column) -> Column:
    """'&' spelled out, punctuation to spaces, spaces collapsed."""
    spelled = F.replace(folded, F.lit("&"), F.lit(" and "))
    return collapse_spaces(F.regexp_replace(spelled, r"[^\p{L}\p{N}_\s]", " "))


def normalize_label_native(text: Column) -> Column:
    """Normalized label by JVM functions alone. Exact for ASCII text."""
    return _plain_words(F.lower(F.coalesce(text, F.lit(""))))


@arrow_function(T.StringType())
def _compatible_fold(values: pa.Array) -> pa.Array:
    """Compatibility form and full case folding, which Spark SQL has no function for."""
    return map_values(pa.string(), lambda value: value and unicodedata.normalize("NFKC", value).casefold(), values)


def normalize_label(text: Column) -> Column:
    """Normalized label for keys and evidence checks; NULL becomes ''.

    Only text with characters beyond ASCII travels to Python, and only to be folded: the function is fed NULL otherwise.
    """
    foreign = F.when(text.rlike(NON_ASCII), text)
    return _plain_words(F.coalesce(_compatible_fold(foreign), F.lower(text), F.lit("")))


def metro_display(metro: Column) -> Column:
    return collapse_spaces(metro)


def metro_key(metro: Column) -> Column:
    """Case-insensitive key of a metro; NULL when blank. Upper case first, so that ß meets SS and both small sigmas meet."""
    return null_if_empty(F.replace(F.lower(F.upper(metro_display(metro))), F.lit("ς"), F.lit("σ")))


def clip(text: Column, width: int) -> Column:
    """Shorten to `width` characters, the last three being dots."""
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width - 3), F.lit("..."))).otherwise(text)


def strip_space(text: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def strip_quotes(text: Column) -> Column:
    """Drop white space of any kind around a generated line, then one surrounding pair of double quotes."""
    return F.regexp_replace(strip_space(text), r'(?s)^"(.*)"$', "$1")
