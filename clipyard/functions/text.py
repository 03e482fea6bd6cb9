"""Tokenizers and shingles as column expressions (no UDF, no shuffle)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipyard.functions.columns import bind

# The character rules of the two tokenizers.
#: Characters a whitespace tokenizer splits on (all but the no-break spaces).
WHITESPACE = "[\\t-\\r\\x1c-\\x20\\u1680\\u2000-\\u2006\\u2008-\\u200a\\u2028\\u2029\\u205f\\u3000]+"
#: Word-boundary rule of a standard tokenizer: runs of letters, marks, digits
#: and underscores; a dot, colon or apostrophe between two letters and a dot,
#: comma, semicolon or apostrophe between two digits do not break a word. The
#: quantifiers are possessive so that long dotted runs cannot exhaust the stack.
STANDARD_TOKEN = (
    "(?:[\\p{L}\\p{M}\\p{N}_]*"
    "(?:\\p{L}(?:[.:'’·]\\p{L})++|\\p{N}(?:[.,;']\\p{N})++))++[\\p{L}\\p{M}\\p{N}_]*"
    "|[\\p{L}\\p{M}\\p{N}_]+"
)


def whitespace_tokens(text: Column) -> Column:
    return F.filter(F.split(text, WHITESPACE), lambda t: t != "")


def standard_tokens(text: Column, lowercase: bool = True) -> Column:
    """Tokens of a text field; the default analysis also lowercases them."""
    source = F.lower(text) if lowercase else text
    return F.regexp_extract_all(source, F.lit(STANDARD_TOKEN), F.lit(0))


def shingles(tokens: Column, size: int = 5) -> Column:
    """All runs of ``size`` neighbouring tokens joined by a space, in order.

    Fewer tokens than ``size`` give an empty array (no unigram fallback).
    """

    def build(t):
        starts = F.sequence(F.lit(0), F.size(t) - size)
        return F.when(
            F.size(t) >= size,
            F.transform(starts, lambda i: F.array_join(F.slice(t, i + 1, size), " ")),
        ).otherwise(F.array().cast("array<string>"))

    return bind(tokens, build)
