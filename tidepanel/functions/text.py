"""Text expressions: typed parsing of raw cells and label normalisation."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, functions as F

from tidepanel import config

# Java's (?U)\s is the Unicode White_Space class; the four separator control
# characters are added because the raw files' producer counts them as blanks.
BLANK = r"(?U)[\s\x1c-\x1f]"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# Year-first forms are never read day-first; slashed, dotted and dashed forms
# are day-first, and month-first only where day-first is impossible.
DAY_FORMATS = (
    "yyyy-M-d", "yyyy/M/d", "yyyyMMdd", "yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s",
    "d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "d/M/yyyy H:m:s", "d/M/yyyy H:m",
    "M/d/yyyy", "M-d-yyyy",
)


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def _may_fit(text: Column, day_format: str) -> Column:
    """False only where `day_format` can't read the text: it lacks a separator, or four digits where the year is first."""
    tests = [text.contains(c) for c in "-/.:" if c in day_format]
    if day_format.startswith("yyyy"):
        tests.append(text.rlike(r"^[+-]?[0-9]{4}"))
    return reduce(Column.__and__, tests)


def parse_day(text: Column, formats=DAY_FORMATS, strict: bool = True) -> Column:
    """Day of a text in any of `formats`; unreadable text is an error if strict.

    A format that fails costs an exception for every row, so only those that may fit are tried.
    """
    clean = blank_to_null(text)
    parsed = [F.when(_may_fit(clean, f), F.try_to_date(clean, f)) for f in formats]
    if strict:
        unreadable = F.raise_error(F.concat(F.lit("unreadable day: "), clean)).cast("date")
        parsed.append(F.when(clean.isNotNull(), unreadable))
    return F.coalesce(*parsed)


def parse_number(text: Column) -> Column:
    """Double of a plain decimal text, else NULL (Java suffixes such as 1d refused)."""
    clean = F.trim(text)
    return F.when(clean.rlike(NUMBER), clean.try_cast("double"))


def parse_id(text: Column, strict: bool = True) -> Column:
    """Whole-number id; non-numeric text is NULL, a fraction is an error if strict."""
    number = parse_number(text)
    whole = F.coalesce(F.trim(text).try_cast("bigint"), number.try_cast("bigint"))
    fraction = number != F.floor(number)
    if strict:
        bad = F.raise_error(F.concat(F.lit("fractional id: "), text)).cast("bigint")
        return F.when(fraction, bad).otherwise(whole)
    return F.when(~F.coalesce(fraction, F.lit(False)), whole)


def parse_count(text: Column) -> Column:
    """Count with thousands blanks removed; a censored count gets its fixed value."""
    packed = F.regexp_replace(text, BLANK, "")
    return F.when(packed == config.CENSORED_TEXT, F.lit(config.CENSORED_VALUE)).otherwise(
        parse_number(packed)
    )


def title_label(label: Column) -> Column:
    """Trimmed, single-blank, title-cased label; a letter after any non-letter is upper."""
    tidy = F.trim(F.regexp_replace(label, BLANK + "+", " "))
    runs = F.regexp_extract_all(tidy, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(
        F.transform(
            runs,
            lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substr(r, F.lit(2)))),
        ),
        "",
    )


def strip_accents(text: Column) -> Column:
    """Compatibility-decomposed text without combining marks.

    Spark has no built-in for this, so it is the one Arrow-batched text UDF;
    call it on distinct labels, not on fact rows.
    """

    @F.pandas_udf("string")
    def strip(s: pd.Series) -> pd.Series:
        def plain(t):
            return "".join(
                c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)
            )

        return s.map(plain, na_action="ignore")

    return strip(text)


# Fixed value: suffixes of labels that name a line.
LINE_SUFFIX = r"(?U)\b(t\d{1,2}|rer\s*[a-e])\b"


def label_key(label: Column) -> Column:
    """Comparison key: no accents, lower case, no line suffix, no punctuation."""
    plain = F.lower(strip_accents(label))
    no_line = F.regexp_replace(plain, LINE_SUFFIX, " ")
    words = F.regexp_replace(no_line, r"(?U)[^\w\s]", " ")
    return F.coalesce(F.trim(F.regexp_replace(words, BLANK + "+", " ")), F.lit(""))
