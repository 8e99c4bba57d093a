"""Column expressions on texts shared by the operators of this package."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"


def n_words(text: Column) -> Column:
    """Number of words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))
