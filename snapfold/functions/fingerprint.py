"""Row fingerprints that keep NULL and empty text apart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def differs(left: list[Column], right: list[Column]) -> Column:
    """NULL-safe "any column differs"; exact, and stops at the first difference."""
    return reduce(
        lambda a, b: a | b, [~x.eqNullSafe(y) for x, y in zip(left, right, strict=True)]
    )


def row_text(*columns: Column) -> Column:
    """The row as composite text: ``(a,"b c",,"")``.

    NULL is nothing, empty text is ``""``; texts with quotes, backslashes,
    brackets, commas or white space are quoted, with quotes and backslashes doubled.
    """

    def field(x: Column) -> Column:
        text = x.cast("string")
        quoted = F.concat(F.lit('"'), F.regexp_replace(text, r'(["\\])', "$1$1"), F.lit('"'))
        plain = text.rlike(r'^[^"\\(),\s\x0b]+\z')
        return F.when(text.isNull(), "").when(plain, text).otherwise(quoted)

    return F.concat(F.lit("("), F.concat_ws(",", *map(field, columns)), F.lit(")"))


def row_fingerprint(*columns: Column) -> Column:
    return F.md5(row_text(*columns))
