"""Counts, rates and merged partial results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import round_exact


def percent(part: Column, whole: Column) -> Column:
    """Percent to 4 places, half to even; 0 of nothing is 0."""
    return F.when(whole > 0, round_exact(part * 100.0 / whole, 4)).otherwise(F.lit(0.0))


def coverage(df: DataFrame, keys: list[str], ok: Column) -> DataFrame:
    """Candidates, validated, failed and rate by ``keys``, by each key and in all."""
    sets = [keys, *[[k] for k in keys if len(keys) > 1], []]
    counted = df.withColumn("__ok", F.coalesce(ok, F.lit(False)))
    out = counted.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if("__ok").alias("validated"), F.grouping_id().alias("level")
    )
    return out.withColumn("failed", F.col("candidates") - F.col("validated")).withColumn(
        "pass_rate", percent(F.col("validated"), F.col("candidates"))
    )


def coverage_of(counts: DataFrame, keys: list[str]) -> DataFrame:
    """``coverage`` of counts (``keys``, candidates, validated) that are known already."""
    sets = [keys, *[[k] for k in keys if len(keys) > 1], []]
    out = counts.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(
        F.sum("candidates").alias("candidates"), F.sum("validated").alias("validated"), F.grouping_id().alias("level")
    )
    return out.withColumn("failed", F.col("candidates") - F.col("validated")).withColumn("pass_rate", percent(F.col("validated"), F.col("candidates")))


def most_common(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; ties by value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(k)


def per_group_stats(df: DataFrame, key: str) -> DataFrame:
    """Number of groups, and mean, median and maximum of their sizes."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    return sizes.agg(
        F.count(F.lit(1)).alias("groups"), round_exact(F.avg("c"), 4).alias("mean"),
        F.median("c").alias("median"), F.max("c").alias("most"),
    )


def spread(counts: list[Column], strict: bool, places: int | None = None) -> Column:
    """Largest over smallest count; null if ``strict`` and one is 0, else over the positive ones, rounded if ``places`` says so."""
    positive = [F.when(c > 0, c) for c in counts]
    ratio = F.greatest(*positive) / F.least(*positive)
    if places is not None:
        ratio = round_exact(ratio, places)
    if not strict:
        return ratio
    return F.when(F.least(*[F.coalesce(c, F.lit(0)) for c in counts]) > 0, ratio)


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Chunks' (candidates, validated, elapsed) as one: sums, the rate anew, the longest time."""
    out = parts.groupBy(*keys).agg(
        F.sum("candidates").alias("candidates"), F.sum("validated").alias("validated"), F.max("elapsed").alias("elapsed")
    )
    return out.withColumn("pass_rate", percent(F.col("validated"), F.col("candidates")))


# What reasons of generation begin with, statuses that are no rejection, and the length of a reason.
REASON_STARTS = ("skipped", "geometry_error", "syntax_error", "validation_error")
NO_REJECTION = (
    "candidate_records", "attempted_edits", "emitted_ok", "validated_output_records", "candidate_output_records", "instruction_output_records",
    "output_records",
)
NO_REJECTION_START = "delete_candidate_records"
STAGE_REASON, AUDIT_REASON = 120, 160


def rejection(errors: Column, error: Column, otherwise: str = "unknown", longest: int = STAGE_REASON) -> Column:
    """The reason that a failed edit counts under: its first error, cut to ``longest`` characters."""
    first = F.coalesce(F.try_element_at(errors, F.lit(1)), error, F.lit(otherwise))
    return F.concat(F.lit("validation:"), F.substring(first, 1, longest))


def generation_reasons(counts: DataFrame, status: str = "status") -> DataFrame:
    """``counts`` (status, n) of statuses that say why nothing came of a record."""
    out = F.lit(False)
    for start in REASON_STARTS:
        out = out | F.col(status).startswith(start)
    return counts.filter(out & (F.col("n") > 0))


def audit_reasons(counts: DataFrame, status: str = "status") -> DataFrame:
    """``counts`` (status, n) of all statuses but those that count output."""
    return counts.filter((F.col("n") > 0) & ~F.col(status).isin(*NO_REJECTION) & ~F.col(status).startswith(NO_REJECTION_START))


def stage_counters(df: DataFrame, status: Column, by: list[str] | None = None) -> DataFrame:
    """How many rows of a stage have each status."""
    return df.withColumn("status", status).groupBy(*(by or []), "status").agg(F.count(F.lit(1)).alias("n"))


def readiness(conditions: dict[str, Column], df: DataFrame) -> DataFrame:
    """One row: whether each condition holds for all rows of ``df``, and ``ready`` if all do and there are rows.

    An aggregate may be a condition, too.
    """
    every = df.agg(F.count(F.lit(1)).alias("records"), *[c.alias(n) for n, c in conditions.items()])
    ready = F.col("records") > 0
    for n in conditions:
        ready = ready & F.coalesce(F.col(n), F.lit(True))
    return every.withColumn("ready", ready)


def ready_for_training(records: DataFrame, dropped: Column, leaks: dict[str, Column], code_ok: Column) -> DataFrame:
    """The ten conditions of a finished data set over ``records`` (images_ok, target_code, instruction, shows_detail).

    ``dropped``: how many rows went; ``leaks``: whether no leak was found, by check;
    ``code_ok``: whether the programs that were run ran.
    """
    filled = lambda c: F.bool_and(F.coalesce(F.trim(c) != "", F.lit(False)))
    return readiness(
        {
            "none_dropped": F.max(dropped) == 0, **{k: F.bool_and(v) for k, v in leaks.items()}, "image_paths_ok": F.bool_and("images_ok"),
            "target_code_nonempty_ok": filled("target_code"), "instruction_nonempty_ok": filled("instruction"),
            "no_detail_leaks": F.count_if("shows_detail") == 0, "code_verification_ok": F.bool_and(code_ok),
        },
        records,
    )


def crossing_summary(found: DataFrame, key: str, most: int = 10) -> DataFrame:
    """(count, ok, examples: the first ``most`` keys) of keys that are in more than one part."""
    first = found.orderBy(key).limit(most).agg(F.sort_array(F.collect_list(key)).alias("examples"))
    return found.agg(F.count(F.lit(1)).alias("count")).crossJoin(first).select("count", (F.col("count") == 0).alias("ok"), "examples")
