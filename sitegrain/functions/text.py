"""Blank handling and plain text keys as Column builders (no Python rows)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    """A Column from a name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of the value, which is evaluated once however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), lambda v: f(v)), 0)


def clean(c: Column | str) -> Column:
    """Missing, empty and space-only text all become the empty string; outer spaces go."""
    return F.trim(F.coalesce(col(c), F.lit("")))


def is_blank(c: Column | str) -> Column:
    """True where the value is null, empty or only spaces."""
    return clean(c) == ""


def alnum_key(c: Column | str) -> Column:
    """Lower-case letters and digits only; null gives the empty string."""
    return F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9]", "")


def lower_trim(c: Column | str) -> Column:
    """Trimmed lower-case text; null gives the empty string."""
    return F.lower(clean(c))


def squeeze(c: Column | str) -> Column:
    """At most two line breaks and one blank in a row, outer white space removed."""
    x = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\n{3,}", "\n\n")
    return F.regexp_replace(F.regexp_replace(x, " {2,}", " "), r"^\s+|\s+$", "")


def contains_any(c: Column | str, phrases: list[str]) -> Column:
    """True where the lower-cased text holds one of the phrases; null text gives false."""
    text = F.lower(F.coalesce(col(c), F.lit("")))
    out = F.lit(False)
    for phrase in phrases:
        out = out | text.contains(phrase)
    return out


def filled(template: str, values: dict[str, Column | str]) -> Column:
    """The template with each {name} replaced by its value, null by ''; other braces stay as they are."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(col(value), F.lit("")))
    return out
