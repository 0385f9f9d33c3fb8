"""String expressions. White space means every Unicode white-space character, not only blanks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white-space characters that trimming and splitting recognise.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as regular expressions: the Unicode property is far faster than the listed characters.
WS = r"(?U:[\s\x1c-\x1f])"
NOT_WS = r"(?U:[^\s\x1c-\x1f])"
# Fixed value: the 32 ASCII punctuation characters as a regular-expression class.
ASCII_PUNCTUATION = r"[!-/:-@\[-`{-~]"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to a value that is computed once, however often ``use`` refers to it."""
    return F.transform(F.array(value), use)[0]


def utrim(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def urtrim(c: Column) -> Column:
    return F.rtrim(c, F.lit(WHITE_SPACE))


def is_blank(c: Column) -> Column:
    """True for null, empty and all-white-space."""
    return F.coalesce(utrim(c), F.lit("")) == ""


def value_or(c: Column, default: str | Column) -> Column:
    """The value, or the default where it is null or empty."""
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.nullif(c, F.lit("")), fallback)


def remove_white_space(c: Column) -> Column:
    return F.regexp_replace(c, WS + "+", "")


def words(c: Column) -> Column:
    """White-space separated words; empty array for blank text."""
    trimmed = utrim(c)
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS + "+"))


def one_line(c: Column) -> Column:
    """Trimmed text with newlines turned into blanks; null becomes empty."""
    return F.replace(utrim(F.coalesce(c, F.lit(""))), F.lit("\n"), F.lit(" "))


def cut(c: Column, chars: int) -> Column:
    """At most ``chars`` code points, trailing white space removed, no ellipsis."""
    return urtrim(F.substring(c, 1, chars))


def cut_with_dots(c: Column, chars: int) -> Column:
    """Unchanged if it fits; otherwise cut, right-trimmed, and marked with three dots."""
    return bind(c, lambda t: F.when(F.length(t) > chars, F.concat(cut(t, chars), F.lit("..."))).otherwise(t))


def preview(c: Column, chars: int = 200) -> Column:
    """Display form: values of ``chars`` or more code points are cut and marked."""
    return F.when(F.length(c) < chars, c).otherwise(F.concat(F.substring(c, 1, chars), F.lit("...")))


def normalise_loose(c: Column) -> Column:
    """Lower case without white space, without words that are one punctuation character."""
    lone = f"(?<!{NOT_WS}){ASCII_PUNCTUATION}(?!{NOT_WS})"
    return remove_white_space(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), lone, ""))


def normalise_strict(c: Column) -> Column:
    """Lower case without white space and without any ASCII punctuation."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), f"(?:{WS}|{ASCII_PUNCTUATION})+", "")


def token_count(c: Column, method: str = "whitespace") -> Column:
    """Length in tokens; ``method`` is "whitespace" or "chars". A model tokenizer plugs in as a
    vectorised UDF column instead (see ``profiling.token_stats``)."""
    if method == "whitespace":
        return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(NOT_WS + "+"))
    if method == "chars":
        return F.length(F.coalesce(c, F.lit("")))
    raise ValueError(f"unknown token counting method {method!r}")
