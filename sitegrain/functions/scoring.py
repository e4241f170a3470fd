"""Comparators of expected and found values: each gives 'skip', 'exact', 'soft' or 'miss' as a Column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegrain.functions.addresses import norm_phone
from sitegrain.functions.text import clean, lower_trim
from sitegrain.functions.urls import norm_url, url_host


def _graded(expected: Column | str, actual: Column | str, exact: Column, soft: Column | None = None) -> Column:
    out = F.when(clean(expected) == "", "skip").when(clean(actual) == "", "miss").when(exact, "exact")
    return (out.when(soft, "soft") if soft is not None else out).otherwise("miss")


def compare_name(expected: Column | str, actual: Column | str) -> Column:
    """Exact where one holds the other, letter case aside."""
    e, a = lower_trim(expected), lower_trim(actual)
    return _graded(expected, actual, F.contains(a, e) | F.contains(e, a))


def compare_phone(expected: Column | str, actual: Column | str) -> Column:
    """Exact where the normal numbers are equal."""
    e, a = norm_phone(expected), norm_phone(actual)
    return _graded(expected, actual, (e != "") & (e == a))


def compare_address(expected: Column | str, actual: Column | str) -> Column:
    """Exact where the leading number or the first word of four letters is found, soft for the first of two letters."""
    e, a = lower_trim(expected), lower_trim(actual)
    number, word, code = F.regexp_extract(e, r"^(\d+)", 1), F.regexp_extract(e, r"\b([a-z]{4,})\b", 1), F.regexp_extract(e, r"\b([a-z]{2})\b", 1)
    return _graded(expected, actual, ((number != "") & F.contains(a, number)) | ((word != "") & F.contains(a, word)), (code != "") & F.contains(a, code))


def compare_count(expected: Column | str, actual: Column | str) -> Column:
    """Exact where a number (with its plus sign) is shared, soft without the sign; skip where none is expected."""
    tokens = [F.regexp_extract_all(clean(c), F.lit(r"(\d+\+?)"), 1) for c in (expected, actual)]
    bare = [F.transform(t, lambda x: F.replace(x, F.lit("+"), F.lit(""))) for t in tokens]
    graded = _graded(expected, actual, F.arrays_overlap(*tokens), F.arrays_overlap(*bare))
    return F.when((clean(expected) != "") & (clean(actual) != "") & (F.size(tokens[0]) == 0), "skip").otherwise(graded)


def compare_label(expected: Column | str, actual: Column | str) -> Column:
    """Exact where equal, letter case aside."""
    return _graded(expected, actual, lower_trim(expected) == lower_trim(actual))


def compare_url(expected: Column | str, actual: Column | str) -> Column:
    """Exact where host and path agree, soft where the host does."""
    return _graded(expected, actual, norm_url(expected) == norm_url(actual), url_host(expected) == url_host(actual))


COMPARATORS: dict[str, Callable[[Column | str, Column | str], Column]] = {
    "canonical_org_name": compare_name, "hq_phone": compare_phone, "hq_address": compare_address, "location_count": compare_count, "research_url": compare_url, "org_subcategory": compare_label,
}
