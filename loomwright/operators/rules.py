"""Rules over rows: the first failing one, all failing ones, and named checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = list[tuple[str, Column]]


def first_reason(rules: Rules) -> Column:
    """The name of the first rule whose condition (of failure) holds; null if none."""
    out = None
    for name, fails in rules:
        out = F.when(fails, name) if out is None else out.when(fails, name)
    return out if out is not None else F.lit(None).cast("string")


def all_reasons(rules: Rules) -> Column:
    """The names of all rules that fail, in order."""
    return F.array_compact(F.array(*[F.when(fails, F.lit(name)) for name, fails in rules]))


def reason_counts(df: DataFrame, reasons: Column) -> DataFrame:
    """How many rows have each reason; a row counts once for each of its reasons."""
    return df.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def failed_checks(checks: dict[str, Column]) -> Column:
    """``failed check: <name>`` of each check that doesn't hold."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(f"failed check: {n}")) for n, c in checks.items()])
    )
