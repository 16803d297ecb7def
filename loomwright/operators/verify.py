"""Contracts of records: required fields, number ranges, spans, boxes, leaked text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import AXES
from .rules import Rules, all_reasons


def required(columns: list[str]) -> Rules:
    return [(f"missing {c}", F.col(c).isNull()) for c in columns]


def not_blank(columns: list[str]) -> Rules:
    return [(f"blank {c}", F.coalesce(F.trim(c) == "", F.lit(False))) for c in columns]


def in_range(column: str, low: float | None = None, high: float | None = None) -> Rules:
    out: Rules = []
    if low is not None:
        out.append((f"{column} below {low}", F.coalesce(F.col(column) < low, F.lit(False))))
    if high is not None:
        out.append((f"{column} above {high}", F.coalesce(F.col(column) > high, F.lit(False))))
    return out


def span_matches(text: str, start: str, end: str, block: str) -> Rules:
    """The block is what the text has at start..end."""
    there = F.col(text).substr(F.col(start) + 1, F.col(end) - F.col(start))
    return [
        ("span is not ordered", (F.col(start) < 0) | (F.col(end) <= F.col(start))),
        ("span does not match", F.coalesce(there != F.col(block), F.lit(True))),
    ]


def box_ordered(box: dict[str, Column], label: str) -> Rules:
    return [(f"{label} {a} not ordered", ~F.coalesce(box[f"{a}min"] < box[f"{a}max"], F.lit(False))) for a in AXES]


def no_leak(text: Column, tokens: list[str]) -> Rules:
    return [(f"leaks {t}", F.coalesce(F.contains(F.lower(text), F.lit(t)), F.lit(False))) for t in tokens]


def violations(df: DataFrame, key: str, rules: Rules) -> DataFrame:
    """(key, message) for each rule that a row breaks."""
    return df.select(key, F.explode(all_reasons(rules)).alias("message"))


def forbidden_paths(schema, forbidden: set[str], prefix: str = "") -> list[str]:
    """Paths of forbidden fields in a schema: found once for a plan, not for each row."""
    out = []
    for f in getattr(schema, "fields", []):
        path = f"{prefix}{f.name}"
        if f.name in forbidden:
            out.append(path)
        inner = getattr(f.dataType, "elementType", f.dataType)
        out.extend(forbidden_paths(inner, forbidden, path + "."))
    return out
