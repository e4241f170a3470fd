"""Shapes of tables: wide and long, nested and flat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ["canonical_org_name", "hq_phone", "hq_address", "location_count", "research_url", "org_subcategory"]
PARTS = ["value", "confidence", "source_url", "snippet"]


def nest(rows: DataFrame, fields: list[str] = FIELDS, parts: list[str] = PARTS) -> DataFrame:
    """The wide columns ``field__part`` as one struct a field."""
    flat = {f"{f}__{p}" for f in fields for p in parts}
    others = [c for c in rows.columns if c not in flat]
    return rows.select(*others, *[F.struct(*[F.col(f"{f}__{p}").alias(p) for p in parts]).alias(f) for f in fields])


def widen(rows: DataFrame, fields: list[str] = FIELDS, parts: list[str] = PARTS) -> DataFrame:
    """The structs as columns ``field__part``, nulls as ''."""
    others = [c for c in rows.columns if c not in fields]
    return rows.select(*others, *[F.coalesce(F.col(f"{f}.{p}"), F.lit("")).alias(f"{f}__{p}") for f in fields for p in parts])


def unpivot(rows: DataFrame, keys: list[str], fields: list[str], columns: dict[str, str]) -> DataFrame:
    """(keys, field, columns): one row a field; ``columns`` maps a result column to the name of its source, {} for the field."""
    pack = F.array(*[F.struct(F.lit(f).alias("field"), *[F.col(p.format(f)).alias(c) for c, p in columns.items()]) for f in fields])
    return rows.select(*keys, F.explode(pack).alias("_x")).select(*keys, "_x.*")


def explode_children(rows: DataFrame, parent: list[str], child: str, literals: dict[str, str] | None = None) -> DataFrame:
    """One row for each struct of the array ``child`` with the parent's keys, its place and constant columns."""
    out = rows.select(*parent, F.posexplode(child).alias("pos", "_c"))
    return out.select(*parent, "pos", "_c.*", *[F.lit(v).alias(k) for k, v in (literals or {}).items()])


def filled_count(rows: DataFrame, columns: list[str], empty: str = "not_found") -> Column:
    """How many of the columns hold another value than ``empty``; null counts as empty."""
    return F.size(F.filter(F.array(*[F.coalesce(F.col(c), F.lit(empty)) for c in columns]), lambda c: c != empty))


def with_default(rows: DataFrame, values: DataFrame, key: str, column: str, default: str) -> DataFrame:
    """The rows with ``column`` from ``values`` by key, replacing one they have; unmatched rows have the default."""
    base = rows.drop(column)
    return base.join(values.select(key, column), key, "left").select(*base.columns, F.coalesce(F.col(column), F.lit(default)).alias(column))


def expand_in_place(rows: DataFrame, copies: DataFrame, ord_: str = "ord") -> DataFrame:
    """Each row once for each of its copies (``ord``, ``copy_no``, further columns), or once without any."""
    more = [c for c in copies.columns if c != ord_]
    return rows.join(copies, ord_, "left").select(*rows.columns, *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c == "copy_no" else F.col(c) for c in more])


def assembled_text(rows: DataFrame, key: list[str], text: str, ord_: str, cut: int, separator: str = "\n\n---\n\n") -> DataFrame:
    """(key, text): the group's texts in order, each cut to ``cut`` characters."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(ord_).alias("o"), F.substring(F.coalesce(F.col(text), F.lit("")), 1, cut).alias("t"))))
    return rows.groupBy(*key).agg(F.array_join(F.transform(parts, lambda x: x["t"]), separator).alias("text"))
