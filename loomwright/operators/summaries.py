"""Summaries of audited chunks that merge: any way of cutting a run into chunks gives the run's own summary.

A summary is one record: input records, both kinds of elapsed time, counts by
branch, category and edit type, the most frequent reasons of rejection with error
bounds, and samples of each edit type.  Counts add up and rates are computed anew;
samples are the first in a hashed order, so the first of two samples are the first of
both; of the reasons at most ``MOST_REASONS`` a branch are kept, each with how often
it was seen at least (``n``) and how often it may have been seen beyond that
(``over``), and ``unseen`` bounds the reasons that aren't kept.  ``top_reasons``
counts the candidates exactly in a second pass over the edits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import ready_to_checkpoint
from .ranking import bottom_k
from .stats import percent, spread

KEYS = ("branch", "category", "edit_type")
#: Reasons that a summary keeps for a branch, reasons that a report shows, samples of an edit type.
MOST_REASONS, SHOWN_REASONS, SAMPLES = 1000, 30, 5
#: The edits of a summary, and a summary.
EDITS = "chunk string, branch string, category string, edit_type string, sample_id string, ok boolean, reason string, score double"
SUMMARY = (
    "chunk string, records long, elapsed_most double, elapsed_sum double, "
    "counts array<struct<branch: string, category: string, edit_type: string, candidates: long, validated: long>>, "
    "reasons array<struct<branch: string, reason: string, n: long, over: long>>, unseen array<struct<branch: string, n: long>>, "
    "samples array<struct<edit_type: string, score: double, sample_id: string>>"
)
#: Branches whose numbers of validated edits should be alike, and by how much at most.
STRUCTURAL, LARGEST_RATIO = ("v2_add", "v3_delete", "v4_replace"), 9


def _written(summaries: DataFrame) -> DataFrame:
    """Few rows that are read several times: kept in the checkpoint folder."""
    ready_to_checkpoint(summaries.sparkSession)
    return summaries.checkpoint()


def _listed(rows: DataFrame, keys: list[str], name: str, *columns: str) -> DataFrame:
    """Few rows of each key as a sorted list."""
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(name))


def _kept_reasons(reasons: DataFrame, keys: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """The ``most`` reasons of each branch that were seen most, and the most that any other may have been seen."""
    best = bottom_k(reasons, [*keys, "branch"], most + 1, [-F.col("n"), F.col("reason")])
    place = F.row_number().over(Window.partitionBy(*keys, "branch").orderBy(F.desc("n"), "reason"))
    kept = best.withColumn("__r", place).filter(F.col("__r") <= most).drop("__r")
    # The upper bounds of all that go, not of the next one alone; branches and chunks may be null.
    names = [*keys, "branch", "reason"]
    staying = kept.select(*[F.col(c).alias(f"__{c}") for c in names])
    gone = reasons.join(staying, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names]), "left_anti")
    return kept, gone.groupBy(*keys, "branch").agg(F.max(F.col("n") + F.col("over")).alias("n"))


def summarised(edits: DataFrame, runs: DataFrame, most: int = MOST_REASONS, samples: int = SAMPLES) -> DataFrame:
    """A ``SUMMARY`` for each chunk of ``runs`` (chunk, records, elapsed) over its ``EDITS``.

    Chunks without edits have empty lists; edits of chunks without a run are left out.
    """
    key = ["chunk"]
    counts = edits.groupBy("chunk", *KEYS).agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.coalesce("ok", F.lit(False))).alias("validated"))
    failed = edits.filter(~F.coalesce("ok", F.lit(False)) & F.col("reason").isNotNull())
    reasons = failed.groupBy("chunk", "branch", "reason").agg(F.count(F.lit(1)).alias("n")).withColumn("over", F.lit(0).cast("long"))
    kept, unseen = _kept_reasons(reasons, key, most)
    chosen = bottom_k(edits.filter("ok"), ["chunk", "edit_type"], samples, [F.col("score"), F.col("sample_id")])
    parts = [
        _listed(counts, key, "counts", *KEYS, "candidates", "validated"), _listed(kept, key, "reasons", "branch", "reason", "n", "over"),
        _listed(unseen, key, "unseen", "branch", "n"), _listed(chosen, key, "samples", "edit_type", "score", "sample_id"),
    ]
    out = runs.select("chunk", F.col("records").cast("long"), F.col("elapsed").cast("double").alias("elapsed_most"), F.col("elapsed").cast("double").alias("elapsed_sum"))
    for part in parts:
        out = out.join(part, "chunk", "left")
    types = {f.name: f.dataType for f in edits.sparkSession.createDataFrame([], SUMMARY).schema}
    empty = {n: F.coalesce(F.col(n).cast(types[n]), F.array().cast(types[n])) for n in ("counts", "reasons", "unseen", "samples")}
    return _written(out.withColumns(empty).select(*types))


def merged(summaries: DataFrame, most: int = MOST_REASONS, samples: int = SAMPLES) -> DataFrame:
    """All ``summaries`` as one, of no chunk; merging merged ones is merging their parts."""
    one = [F.lit(1).alias("one")]
    totals = summaries.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"), F.max("elapsed_most").alias("elapsed_most"), F.sum("elapsed_sum").alias("elapsed_sum")
    ).select("*", *one)
    counts = summaries.select(F.inline("counts")).groupBy(*KEYS).agg(F.sum("candidates").alias("candidates"), F.sum("validated").alias("validated"))
    # A summary that lacks a reason may have left out as many as its bound says.
    numbered = summaries.select("reasons", "unseen", F.monotonically_increasing_id().alias("of"))
    bounds = numbered.select("of", F.inline("unseen")).withColumnRenamed("n", "bound")
    whole = bounds.groupBy("branch").agg(F.sum("bound").alias("whole"))
    bound = F.coalesce(F.get(F.filter("unseen", lambda u: u["branch"].eqNullSafe(F.col("r.branch"))), F.lit(0))["n"], F.lit(0))
    seen = numbered.select("unseen", F.explode("reasons").alias("r")).select("r.*", bound.alias("bound"))
    seen = seen.groupBy("branch", "reason").agg(F.sum("n").alias("n"), F.sum(F.col("over") - F.col("bound")).alias("over"))
    seen = seen.join(whole.withColumnRenamed("branch", "b"), F.col("branch").eqNullSafe(F.col("b")), "left").drop("b")
    reasons = seen.select("branch", "reason", "n", (F.col("over") + F.coalesce("whole", F.lit(0))).alias("over"))
    kept, gone = _kept_reasons(reasons, [], most)
    unseen = gone.unionByName(whole.withColumnRenamed("whole", "n")).groupBy("branch").agg(F.max("n").alias("n"))
    chosen = bottom_k(summaries.select(F.inline("samples")), ["edit_type"], samples, [F.col("score"), F.col("sample_id")])
    out = totals
    for rows, name, columns in (
        (counts, "counts", (*KEYS, "candidates", "validated")), (kept, "reasons", ("branch", "reason", "n", "over")),
        (unseen, "unseen", ("branch", "n")), (chosen, "samples", ("edit_type", "score", "sample_id")),
    ):
        out = out.join(_listed(rows.select("*", *one), ["one"], name, *columns), "one", "left")
    types = {f.name: f.dataType for f in summaries.sparkSession.createDataFrame([], SUMMARY).schema}
    empty = {n: F.coalesce(F.col(n).cast(types[n]), F.array().cast(types[n])) for n in ("counts", "reasons", "unseen", "samples")}
    return _written(out.withColumns(empty).withColumn("chunk", F.lit(None).cast("string")).select(*types))


def rates(summary: DataFrame) -> DataFrame:
    """(level, branch, key, candidates, validated, failed, pass_rate): a row for each branch, and its edit types and categories."""
    counts = summary.select(F.inline("counts"))
    add = [F.sum("candidates").alias("candidates"), F.sum("validated").alias("validated")]
    levels = [("branch", F.col("branch")), ("edit_type", F.col("edit_type")), ("category", F.col("category"))]
    out = None
    for level, key in levels:
        rows = counts.groupBy("branch", key.alias("key")).agg(*add).select(F.lit(level).alias("level"), "branch", "key", "candidates", "validated")
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn("failed", F.col("candidates") - F.col("validated")).withColumn("pass_rate", percent(F.col("validated"), F.col("candidates")))


def structural_ratio(summary: DataFrame, branches: tuple[str, ...] = STRUCTURAL) -> DataFrame:
    """One row: validated edits of each structural branch, the largest number over the smallest positive one, and whether that will do."""
    counts = summary.select(F.inline("counts"))
    made = [F.coalesce(F.sum(F.when(F.col("branch") == b, F.col("validated"))), F.lit(0)).cast("long").alias(b) for b in branches]
    rows = counts.agg(*made).withColumn("ratio", spread([F.col(b) for b in branches], False, 4))
    return rows.withColumn("passes", F.coalesce(F.col("ratio") <= LARGEST_RATIO, F.lit(False)))


def top_reasons(edits: DataFrame, summary: DataFrame, k: int = SHOWN_REASONS) -> DataFrame:
    """(branch, reason, n): the ``k`` most frequent reasons of each branch with their exact counts, ties by reason.

    A reason that may be among them is one whose upper bound reaches the ``k``-th
    lower bound; these are counted in one pass over ``edits``, next to the few of the
    summary.  Where the reasons that aren't kept might reach the ``k``-th count, all of
    that branch are counted.
    """
    reasons, unseen = summary.select(F.inline("reasons")), summary.select(F.inline("unseen"))
    place = F.row_number().over(Window.partitionBy("branch").orderBy(F.desc("n"), "reason"))
    floor = reasons.withColumn("r", place).filter(F.col("r") == k).select(F.col("branch").alias("b"), F.col("n").alias("floor"))
    bounded = reasons.join(floor, F.col("branch").eqNullSafe(F.col("b")), "left").filter((F.col("n") + F.col("over")) >= F.coalesce("floor", F.lit(0)))
    maybe = bounded.select(F.col("branch").alias("b"), F.col("reason").alias("t"))  # at most MOST_REASONS of a branch
    failed = edits.filter(~F.coalesce("ok", F.lit(False)) & F.col("reason").isNotNull()).select("branch", "reason")
    # A branch is open where an unkept reason might have as many as the k-th, or where there aren't k.
    at = floor.withColumnRenamed("b", "fb")
    open_ = unseen.join(at, F.col("branch").eqNullSafe(F.col("fb")), "left").filter(F.col("n") >= F.coalesce("floor", F.lit(0)))
    open_ = open_.select(F.col("branch").alias("ob"))
    few = failed.join(F.broadcast(maybe), F.col("branch").eqNullSafe(F.col("b")) & (F.col("reason") == F.col("t")), "left_semi")
    every = failed.join(F.broadcast(open_), F.col("branch").eqNullSafe(F.col("ob")), "left_semi")
    few = few.join(F.broadcast(open_), F.col("branch").eqNullSafe(F.col("ob")), "left_anti")
    counted = few.unionByName(every).groupBy("branch", "reason").agg(F.count(F.lit(1)).alias("n"))
    return bottom_k(counted, ["branch"], k, [-F.col("n"), F.col("reason")])
