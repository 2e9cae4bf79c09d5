"""Athlete attributes: club, codes, age, category and report labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from racelake.functions.columns import as_col, is_non_ascii

UNKNOWN = "unknown"
# Leading annotation stars (and following spaces) on club names.
CLUB_PREFIX = r"^\*+\s*"
BIRTH_YEAR_SENTINEL = 1193
AGE_MIN, AGE_MAX = 5, 100


def clean_club(c: Column | str) -> Column:
    """NULL -> unknown; trim; strip leading ``*``; blank -> unknown.
    Non-ASCII names are kept as they are."""
    cleaned = F.trim(F.regexp_replace(F.trim(F.coalesce(as_col(c), F.lit(UNKNOWN))), CLUB_PREFIX, ""))
    return F.when(F.length(cleaned) == 0, F.lit(UNKNOWN)).otherwise(cleaned)


def normalize_code(c: Column | str) -> Column:
    """Country / gender / lookup codes: ``upper(trim(x))``."""
    return F.upper(F.trim(as_col(c)))


def clean_birth_year(c: Column | str) -> Column:
    """Known typo year 1193 -> NULL, otherwise the integer year (NULL when the
    value cannot be an int, instead of an ANSI cast error)."""
    year = as_col(c).try_cast("int")
    return F.when(year != BIRTH_YEAR_SENTINEL, year)


def age_at_event(event_year: Column | str, birth_year: Column | str,
                 lo: int = AGE_MIN, hi: int = AGE_MAX) -> Column:
    """Event year minus birth year; ages outside [lo, hi] become NULL
    (``try_subtract``: absurd inputs give NULL, not an ANSI overflow)."""
    age = F.try_subtract(as_col(event_year), as_col(birth_year))
    return F.when((age < lo) | (age > hi), F.lit(None).cast("int")).otherwise(age)


def clean_category(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(c.isNull() | (F.length(F.trim(c)) == 0), F.lit(UNKNOWN)).otherwise(F.upper(F.trim(c)))


def gender_label(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(c == "M", "Male").when(c == "F", "Female").otherwise("Other / Unknown")


def age_group_label(c: Column | str) -> tuple[Column, Column]:
    """(label, sort key) of an age category.

    ``%U%`` -> ``Under N`` sorted as N-1; ``M%`` / ``W%`` -> ``N+`` sorted as N;
    anything else keeps its text and sorts last (999).  A category without
    digits (``M``) gives label ``+`` and a NULL sort key instead of a cast error.
    """
    c = as_col(c)
    digits = F.regexp_extract(c, "[0-9]+", 0)
    number = digits.try_cast("int")
    under = c.like("%U%")
    veteran = c.like("M%") | c.like("W%")
    label = (F.when(under, F.concat(F.lit("Under "), digits))
             .when(veteran, F.concat(digits, F.lit("+")))
             .otherwise(c))
    sort = (F.when(under, number - 1)
            .when(veteran, number)
            .otherwise(F.lit(999)))
    return label, sort


def business_age_group(c: Column | str) -> Column:
    """Simpler label of the business views: ``%U23`` -> ``Under 23``; a leading
    ``M``/``W`` letter is removed everywhere in the text and ``+`` appended."""
    c = as_col(c)
    return (F.when(c.like("%U23"), F.lit("Under 23"))
            .when(c.like("M%"), F.concat(F.replace(c, F.lit("M"), F.lit("")), F.lit("+")))
            .when(c.like("W%"), F.concat(F.replace(c, F.lit("W"), F.lit("")), F.lit("+")))
            .otherwise(c))


def club_pattern(c: Column | str) -> Column:
    """Exploratory club text class: null, star prefix, non-ASCII, blank, standard."""
    c = as_col(c)
    return (F.when(c.isNull(), "null")
            .when(c.rlike(r"^\*"), "starts_with_star")
            .when(is_non_ascii(c), "contains_non_ascii_characters")
            .when(c.rlike(r"^\s*$"), "empty_or_whitespace")
            .otherwise("standard_text"))
