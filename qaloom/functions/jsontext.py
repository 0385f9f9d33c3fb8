"""JSON text with a blank after ':' and ',', non-ASCII left as it is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qaloom.functions.text import bind

# Control characters whose hexadecimal escape has a letter, which is written in lower case.
_LETTERED = (0x0B, 0x0E, 0x0F, 0x1A, 0x1B, 0x1C, 0x1D, 0x1E, 0x1F)
_UNESCAPED = r"(?<!\\)((?:\\\\)*)"  # not inside an escaped backslash


def json_string(c: Column) -> Column:
    """Quoted, escaped JSON string; null becomes the empty string."""
    wrapped = F.to_json(F.struct(F.coalesce(c, F.lit("")).alias("v")))  # {"v":"..."}
    quoted = F.substr(wrapped, F.lit(6), F.length(wrapped) - 6)
    return bind(quoted, lambda text: F.when(F.contains(text, F.lit("\\u00")), _lower_hex(text)).otherwise(text))


def _lower_hex(text: Column) -> Column:
    for code in _LETTERED:
        text = F.regexp_replace(text, rf"{_UNESCAPED}\\u00{code:02X}", rf"$1\\u00{code:02x}")
    return text


def json_object(**fields: Column) -> Column:
    """``fields`` hold finished JSON text, in output order."""
    parts: list[Column] = []
    for i, (name, value) in enumerate(fields.items()):
        parts += [F.lit(("{" if i == 0 else ", ") + f'"{name}": '), value]
    return F.concat(*parts, F.lit("}"))


def json_array(items: Column) -> Column:
    """``items`` is an array of finished JSON texts."""
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def is_one_json_value(c: Column) -> Column:
    """Whether the text is exactly one JSON value with nothing behind it.

    Spark's JSON functions stop after the first value, so ``{} x`` would pass; wrapped in an array
    any trailing text breaks the syntax or changes the length.
    """
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1, F.lit(False))
