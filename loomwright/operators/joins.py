"""Joins with a rule for repeated keys on the build side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_for_each_key(build: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    number = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return build.withColumn("__n", number).filter("__n = 1").drop("__n")


def lookup(probe: DataFrame, build: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Left join with one build row for each key; ``matched`` says if there was one."""
    one = one_for_each_key(build, key, order).withColumn("matched", F.lit(True))
    return probe.join(one, key, "left").withColumn("matched", F.coalesce("matched", F.lit(False)))


def crossing(df: DataFrame, key: str, part: str) -> DataFrame:
    """Keys that occur in more than one part, with the parts."""
    # Two parts show in the least and the greatest; only the keys that have them need a list.
    ends = df.groupBy(key).agg(F.min(part).alias("__a"), F.max(part).alias("__b")).filter("__a <> __b").select(F.col(key).alias("__k"))
    both = df.join(ends, F.col(key).eqNullSafe(F.col("__k")), "left_semi")
    return both.groupBy(key).agg(F.sort_array(F.collect_set(part)).alias("parts"))
