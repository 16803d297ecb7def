"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled (by the MD5 of their id) and queued, twice
over.  A copy's virtual finish time is the source's words up to and including
it, divided by the source's weight.  All copies are put in order of that time
and the order is cut at the budget.  A source that runs out leaves the rest of
the budget to the others in proportion to their weights, which is what the
resharing of targets asks for.

Edge cases: a null text has no words; null sources are one source, the last;
documents without words take nothing; rows that are equal in all columns share
one decision if their finish time is the cut itself; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import bucketed_prefix, materialize, table

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
EPOCHS = 2
BINS = 4096


@F.pandas_udf(LongType())
def word_count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Number of maximal runs of other characters than ASCII white space."""
    for batch in texts:
        yield pd.Series([0 if t is None else len(t.encode().split()) for t in batch], dtype="int64")


def targets(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """Per source: rank, weight, words (source_size) and target.

    Water level F: the sum over sources of min(weight * F, epochs * words) is the
    budget.  In order of epochs * words / weight, a source is full while the
    budget covers that level.
    """
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    sums = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sums.withColumn("source_rank", F.row_number().over(by_name))
    ranked = ranked.withColumn("weight", F.element_at(pattern, (F.pmod(F.col("source_rank") - 1, F.lit(len(weights))) + 1).cast("int")))
    full = F.col("source_size") * float(epochs)
    by_level = Window.partitionBy(F.lit(0)).orderBy("level", "source_rank")
    upto, whole = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    level = ranked.withColumn("level", full / F.col("weight")).withColumns(
        {
            "below": F.coalesce(F.sum(full).over(upto), F.lit(0.0)),
            "rest": F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)),
            "budget": F.sum("source_size").over(whole) * F.lit(budget),
        }
    )
    level = level.withColumn("is_full", F.col("below") + F.col("rest") * F.col("level") <= F.col("budget"))
    level = level.withColumns(
        {
            "spent": F.coalesce(F.sum(F.when(F.col("is_full"), full)).over(whole), F.lit(0.0)),
            "open": F.coalesce(F.sum(F.when(~F.col("is_full"), F.col("weight"))).over(whole), F.lit(1.0)),
        }
    )
    share = F.col("weight") * (F.col("budget") - F.col("spent")) / F.col("open")
    return level.select(
        "source", "source_rank", "weight", "source_size", "budget",
        F.when(F.col("is_full"), full).otherwise(F.least(full, share)).alias("target"),
    )


def shuffled() -> Column:
    """What a source's documents are queued by, before doc_id and size."""
    return F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))


def fair_queue(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """``docs`` (doc_id, source, size; materialised) with source_size, target and copies."""
    goal = targets(docs, weights, budget, epochs)
    goal, _ = materialize(goal, "mix-targets")
    queued = docs.join(goal, docs["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    queued = queued.withColumn("shuffle", shuffled()).withColumns(
        {"__a": F.substring("shuffle", 1, 3), "__b": F.substring("shuffle", 4, 2)}
    )
    queued = bucketed_prefix(
        queued, ["__a", "__b"], ["shuffle", "doc_id", "size"], {"before": "size"}, group=["source_rank"]
    ).drop("__a", "__b")
    queued, _ = materialize(queued, "mix-queue")

    spread = goal.agg(
        F.max(F.col("source_size") * float(epochs) / F.col("weight")).alias("last"), F.max("budget").alias("budget")
    ).first()
    last, total = spread["last"] or 1.0, spread["budget"] or 0.0
    times = F.transform(
        F.sequence(F.lit(0), F.lit(epochs - 1)),
        lambda e: (e * F.col("source_size") + F.col("before") + F.col("size")) / F.col("weight"),
    )
    key = lambda t: F.struct(t.alias("time"), "source_rank", "shuffle", "doc_id", "size")
    slot = lambda t: F.least(F.lit(BINS - 1), F.floor(t / F.lit(last) * BINS)).cast("int")
    copies = queued.filter("size > 0").select("source_rank", "shuffle", "doc_id", "size", F.explode(times).alias("time"))
    copies = copies.withColumn("bin", slot(F.col("time")))
    bins = copies.groupBy("bin").agg(F.sum("size").alias("words")).orderBy("bin").collect()  # at most BINS rows
    passed, cut_bin = 0, BINS
    for row in bins:
        if passed + row["words"] > total:
            cut_bin = row["bin"]
            break
        passed += row["words"]
    # Only the bin that holds the cut is put in full order.
    inside = Window.partitionBy("bin").orderBy("key")
    at_cut = copies.filter(F.col("bin") == cut_bin).select("bin", "size", key(F.col("time")).alias("key"))
    at_cut = at_cut.withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    cut = at_cut.filter(F.col("upto") <= total - passed).agg(F.max("key").alias("cut")).first()["cut"]

    def kept(time):
        below = slot(time) < cut_bin
        if cut is None:
            return below
        edge = F.struct(
            F.lit(cut["time"]).alias("time"), F.lit(cut["source_rank"]).alias("source_rank"), F.lit(cut["shuffle"]).alias("shuffle"),
            F.lit(cut["doc_id"]).cast("long").alias("doc_id"), F.lit(cut["size"]).cast("long").alias("size"),
        )
        return below | ((slot(time) == cut_bin) & (key(time) <= edge))

    copies_kept = F.size(F.filter(times, kept))
    return queued.withColumn("copies", F.when(F.col("size") > 0, copies_kept).otherwise(F.lit(0)))


def queue_ends(mixed: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Per source, the last place in its queue that is taken once, twice and so on: end_1, end_2, ...

    Finish times grow along a queue, so a document is taken as often as there are
    ends that don't come before it.  ``mixed``: what ``fair_queue`` returns.
    """
    place = F.struct("shuffle", "doc_id", "size")
    ends = [F.max(F.when(F.col("copies") >= e, place)).alias(f"end_{e}") for e in range(1, epochs + 1)]
    return mixed.filter("copies > 0").groupBy("source").agg(*ends)


def with_copies(docs: DataFrame, ends: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """``docs`` (doc_id, source, size and others) with copies, from the ``ends`` of the queues alone; no document is shuffled.

    Rows with one doc_id, source and size share the decision at an end.
    """
    place = F.struct(shuffled().alias("shuffle"), F.col("doc_id"), F.col("size"))
    taken = sum((F.coalesce(place <= F.col(f"end_{e}"), F.lit(False)).cast("int") for e in range(1, epochs + 1)), F.lit(0))
    joined = docs.join(ends.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")), "left")
    return joined.select(*docs.columns, F.when(F.col("size") > 0, taken).otherwise(F.lit(0)).alias("copies"))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and number of words of each document."""
    return docs.select("doc_id", "source", word_count("text").alias("size"))


def op4_fair_queue_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes from each document."""
    docs, _ = materialize(sized(table(spark, sf_dir, "documents")), "op4")
    mixed = fair_queue(docs)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies"
    )


#: The same queue in SQL: one global window for each sum.
OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS shuffle
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS source_rank
  FROM d GROUP BY source),
w AS (
  SELECT *, CASE (source_rank - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight,
         (sum(source_size) OVER ())::DOUBLE * 1.5 AS budget
  FROM s),
l AS (
  SELECT *, coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source_rank
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            + sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source_rank
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) * (2.0::DOUBLE * source_size / weight)
            <= budget AS is_full
  FROM w),
t AS (
  SELECT *, CASE WHEN is_full THEN 2.0::DOUBLE * source_size ELSE least(2.0::DOUBLE * source_size,
      weight * (budget - coalesce(sum(CASE WHEN is_full THEN 2.0::DOUBLE * source_size END) OVER (), 0))
      / coalesce(sum(CASE WHEN NOT is_full THEN weight END) OVER (), 1)) END AS target
  FROM l),
q AS (
  SELECT d.doc_id, d.size, d.shuffle, t.source_rank, t.source_size, t.weight, t.target, t.budget,
         coalesce(sum(d.size) OVER (PARTITION BY t.source_rank ORDER BY d.shuffle, d.doc_id, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT q.*, (e * source_size + before + size)::DOUBLE / weight AS finish
  FROM q, (VALUES (0), (1)) AS epochs(e)),
o AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source_rank, shuffle, doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= budget AS kept
  FROM c)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(sum(CASE WHEN kept THEN size ELSE 0 END) AS BIGINT) AS taken,
       CAST(sum(CASE WHEN kept AND size > 0 THEN 1 ELSE 0 END) AS INTEGER) AS copies
FROM o GROUP BY doc_id, size, source_size, target
"""
