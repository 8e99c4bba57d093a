"""Cleaning rules as Column -> Column functions.

All of them are compositions of built-in expressions that take part in
whole-stage code generation: no Python, no array lambdas, one pass per value.
Each rule first brings a text into shape and then judges it, so that a projection
over many columns can do the two in separate steps and shape every text once.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

# The characters removed from both ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# E-mail rules.
KNOWN_DOMAINS = ("example.com", "example.net", "example.org")
NO_EMAIL = ("", "user_no_domain")

# Address texts that mean "none", compared in lower case.
NO_ADDRESS = ("", "unknown")

# Unicode "Cased" characters, and those that casing rules look through.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
_CASE_IGNORABLE = (
    r"\p{Mn}\p{Me}\p{Cf}\p{Lm}\p{Sk}'.:\u00b7\u0387\u055f\u05f4\u2018\u2019"
    r"\u2024\u2027\ufe13\ufe52\ufe55\uff07\uff0e\uff1a"
)
# Two Unicode noncharacters (reserved for process-internal use) and a space.
_WORD_MARK = "\ufdd0\ufdd1 "

# A day of one digit may be padded with a space.
_DATE_SHAPE = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-([0-9]{1,2}| [1-9])$"


def strip(x: Column) -> Column:
    return F.btrim(x, F.lit(WHITESPACE))


def title_case(x: Column) -> Column:
    """Capitalise every cased letter that follows an uncased character.

    ``initcap`` only sees spaces as word ends, so a marked space is put in front
    of every other word start first and taken out again afterwards.  A capital
    sigma inside a word that merely continues behind an apostrophe or full stop
    is lowered beforehand, since the mark would make it look word-final.
    """
    inner = F.when(
        F.contains(x, F.lit("Σ")),
        F.regexp_replace(x, f"([{_CASED}])Σ(?=[{_CASE_IGNORABLE}]+[{_CASED}])", "$1σ"),
    ).otherwise(x)
    marked = F.regexp_replace(inner, f"([^{_CASED} ])([{_CASED}])", f"$1{_WORD_MARK}$2")
    return F.replace(F.initcap(marked), F.lit(_WORD_MARK), F.lit(""))


def clean_names(x: Column) -> Column:
    return title_case(strip(x))


def mail_text(x: Column) -> Column:
    return F.lower(strip(x))


def mail_or_null(mail: Column) -> Column:
    """Put back a lost ``@`` in front of a known domain; NULL if there is no address."""
    out = F.when(mail.isin(*NO_EMAIL), F.lit(None).cast("string")).when(
        F.contains(mail, F.lit("@")), mail
    )
    for domain in KNOWN_DOMAINS:
        user_length = F.length(mail) - len(domain)
        out = out.when(
            mail.endswith(domain) & (user_length > 0),
            F.concat(F.substring(mail, F.lit(1), user_length), F.lit(f"@{domain}")),
        )
    return out


def clean_email(x: Column) -> Column:
    return mail_or_null(mail_text(x))


def digits(x: Column) -> Column:
    return F.regexp_replace(x, r"[^\p{Nd}]+", "")


def phone_or_null(number: Column) -> Column:
    return F.when(number != "", number)


def clean_phone(x: Column) -> Column:
    """Digits only (those of an extension stay); NULL if there are none."""
    return phone_or_null(digits(x))


@cache
def _other_digits() -> tuple[str, str]:
    """All decimal digits outside ASCII and the ASCII digits they stand for."""
    other = [c for c in map(chr, range(0x80, 0x110000)) if unicodedata.category(c) == "Nd"]
    return "".join(other), "".join(str(unicodedata.decimal(c)) for c in other)


def salary_or_null(number: Column) -> Column:
    is_ascii = F.length(number) == F.octet_length(number)
    in_ascii = F.when(is_ascii, number).otherwise(F.translate(number, *_other_digits()))
    return F.when(number != "", in_ascii).cast("int")


def clean_salary(x: Column) -> Column:
    """Digits only, as INT; too large a number aborts (ANSI cast)."""
    return salary_or_null(digits(x))


def date_or_null(text: Column) -> Column:
    """A year-month-day text as a date; any other text, or no such day, is NULL."""
    return F.when(text.rlike(_DATE_SHAPE), F.replace(text, F.lit(" "), F.lit(""))).try_cast("date")


def clean_date(x: Column) -> Column:
    return date_or_null(strip(x))


def resolve_dates(
    status: Column,
    start: Column,
    end: Column,
    start_missing: Column,
    end_missing: Column,
    ended: str = "Terminated",
) -> tuple[Column, Column, Column]:
    """(start, end, flag): contradictory dates are wiped and flagged.

    An ended record that never had either date is flagged too; dates that were
    given but could not be read are not.
    """
    contradiction = F.coalesce(end < start, F.lit(False))
    never_dated = status.eqNullSafe(F.lit(ended)) & start_missing & end_missing
    return (
        F.when(~contradiction, start),
        F.when(~contradiction, end),
        contradiction | never_dated,
    )


def clean_employment_dates(
    status: Column, raw_start: Column, raw_end: Column
) -> tuple[Column, Column, Column]:
    return resolve_dates(
        status,
        clean_date(raw_start),
        clean_date(raw_end),
        raw_start.isNull(),
        raw_end.isNull(),
    )


def one_line(x: Column) -> Column:
    """Line feeds become spaces (carriage returns stay), then both ends are stripped."""
    return strip(F.replace(x, F.lit("\n"), F.lit(" ")))


def address_or_null(line: Column) -> Column:
    return F.when(~F.lower(line).isin(*NO_ADDRESS), line)


def clean_address(x: Column) -> Column:
    return address_or_null(one_line(x))
