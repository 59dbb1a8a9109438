"""Column cleansers: built-in expressions only (stay inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: cleansing rules of the silver layer ------------------------
# State spellings (after removing spaces and lower-casing) -> canonical state.
STATE_CANONICAL = {
    "tn": "Tamil Nadu",
    "tamilnadu": "Tamil Nadu",
    "ka": "Karnataka",
    "karnataka": "Karnataka",
    "mh": "Maharashtra",
    "maharashtra": "Maharashtra",
}
# Characters removed from phone numbers: whitespace, hyphen, parentheses, plus.
PHONE_STRIP_PATTERN = r"[\s\-\(\)\+]"
# Accepted e-mail shape.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
# --- end of fixed values -------------------------------------------------------


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_name(col: str | Column) -> Column:
    """Trimmed, word-capitalised text (``initcap`` splits on spaces only)."""
    return F.initcap(F.trim(_c(col)))


def canonicalize(col: str | Column, mapping: Mapping[str, str],
                 normalizer: Callable[[Column], Column],
                 fallback: Callable[[Column], Column]) -> Column:
    """Map a normalised spelling to its canonical value, else apply ``fallback``.

    The normaliser is evaluated once and looked up in a literal map (one
    expression instead of a CASE chain that repeats the normaliser per branch).
    """
    lookup = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(lookup, normalizer(_c(col))), fallback(_c(col)))


def canonical_state(col: str | Column) -> Column:
    return canonicalize(col, STATE_CANONICAL,
                        normalizer=lambda c: F.lower(F.regexp_replace(c, " ", "")),
                        fallback=clean_name)


def clean_phone(col: str | Column) -> Column:
    return F.regexp_replace(_c(col), PHONE_STRIP_PATTERN, "")


def clean_payment_method(col: str | Column) -> Column:
    """``net_banking`` -> ``Net Banking``: trim, underscores to spaces, capitalise."""
    return F.initcap(F.regexp_replace(F.trim(_c(col)), "_", " "))


def email_is_valid(col: str | Column) -> Column:
    """Three-valued: NULL for a NULL address (it neither passes nor fails)."""
    return _c(col).rlike(EMAIL_PATTERN)
