"""Ranks and selections by rank in which no task sorts a whole group.

A group (a split, an edit type) may hold most rows of a table.  Positions of all
rows come from a sort over all partitions and the partitions' counts.  Quotas by
group come from histograms of the sort keys: they say below which key all rows of a
group are taken, and only rows at that threshold are put in exact order.  Samples of
a few rows a key come from bounded lists in each task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import ready_to_checkpoint

#: Bins of a histogram level, and rows at a threshold that one task may sort.
BINS, MOST = 4096, 1_000_000
#: Rows of samples that a task holds before it passes them on.
HELD = 200_000


def numbered(df: DataFrame, order: list[Column | str], name: str = "position") -> DataFrame:
    """``df`` with each row's place (from 1) in ``order``; equal rows in any order.

    Rows are sorted over all partitions by sampled ranges, kept in the checkpoint
    folder, and the partitions' counts, a row for each, are added up.
    """
    ready_to_checkpoint(df.sparkSession)
    # A number of its own parts rows that are equal in the order, however many.
    own = df.withColumn("__own", F.monotonically_increasing_id())
    ranges = own.repartitionByRange(*order, "__own").sortWithinPartitions(*order, "__own").drop("__own")
    rows = ranges.withColumn("__id", F.monotonically_increasing_id()).checkpoint()
    part, inside = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = rows.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(F.lit(0)).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("__p", F.coalesce(before, F.lit(0)).alias("__before"))  # a row for each partition
    placed = rows.withColumn("__p", part).join(F.broadcast(starts), "__p")
    return placed.withColumn(name, F.col("__before") + inside + 1).drop("__p", "__id", "__before")


def _same(ones: list[str], others: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(ones, others, strict=True)], F.lit(True))


def _bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Of ``bins`` equal stretches from ``low`` to ``high`` the one with ``x``; -1 below them, ``bins`` above."""
    inside = F.floor((x - low) / (high - low) * F.lit(float(bins)))
    return (
        F.when(low.isNull() | (x < low), -1).when(x > high, bins).when(high <= low, 0).otherwise(F.least(inside, F.lit(bins - 1)))
    ).cast("int")


def first_by_quota(
    df: DataFrame, group: list[str], quotas: DataFrame, order: list[Column], ties: list[str], bins: int | None = None, most: int | None = None
) -> DataFrame:
    """Of each group the first ``quota`` rows (of ``quotas``: the group's columns and quota) in ``order``, then ``ties``.

    Numbers that lead ``order`` make histograms.  A level counts a group's rows in
    ``bins`` stretches of a number and finds the stretch in which the quota ends;
    the next level divides that stretch, or goes on with the next number if all of
    it is one value.  It ends when no more than ``most`` rows of a group are left
    at the threshold (or nothing is left to divide), and only these are ranked.
    Nulls sort first and NaN last, as in Spark; a null group is a group of its own;
    groups without a quota give nothing.
    """
    sided = beside_threshold(df, group, quotas, order, bins or BINS, most or MOST)
    exact = F.row_number().over(Window.partitionBy(*group).orderBy(*order, *ties))
    at_edge = sided.filter("__side = 0").withColumn("__r", exact).filter(F.col("__r") <= F.col("__need"))
    return sided.filter("__side < 0").select(*df.columns).unionByName(at_edge.select(*df.columns))


def beside_threshold(df: DataFrame, group: list[str], quotas: DataFrame, order: list[Column], bins: int, most: int) -> DataFrame:
    """``df`` with ``__side``: -1 for rows before their group's threshold, 0 for those of which ``__need`` are to be taken, 1 beyond."""
    ready_to_checkpoint(df.sparkSession)
    kinds = df.select(*[c.alias(f"c{i}") for i, c in enumerate(order)]).schema
    lead = next((i for i, f in enumerate(kinds) if not isinstance(f.dataType, T.NumericType)), len(order))
    infinite = float("inf")
    numbers = [F.when(c.isNull(), F.lit(-infinite)).otherwise(F.when(F.isnan(c.cast("double")), infinite).otherwise(c.cast("double"))) for c in order[:lead]]
    rows = df.withColumn("__x", F.array(*numbers) if numbers else F.array().cast("array<double>"))
    finite = lambda x: F.when((x > -infinite) & (x < infinite), x)
    span = lambda x: [F.min(finite(x)).alias("__low"), F.max(finite(x)).alias("__high"), F.min(x).alias("__least"), F.max(x).alias("__most")]

    at = lambda j: F.try_element_at("__x", j + 1)
    own = [f"__g{i}" for i in range(len(group))]
    key = [F.col(c).alias(g) for c, g in zip(group, own, strict=True)]
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), *span(F.try_element_at("__x", F.lit(1))))
    wanted = [f"__q{i}" for i in range(len(group))]
    q = quotas.filter("quota > 0").select(*[F.col(c).alias(w) for c, w in zip(group, wanted, strict=True)], F.col("quota").cast("long").alias("__need"))
    step = "struct<j: int, low: double, high: double, bin: int>"
    state = sizes.join(q, _same(own, wanted)).drop(*wanted).withColumns(
        {"__j": F.lit(0), "__path": F.array().cast(f"array<{step}>")}
    ).checkpoint()

    def beside(path: Column) -> Column:
        """-1 where a row lies before its group's threshold, 1 beyond it, 0 in the stretch that holds it."""
        return F.aggregate(
            path, F.lit(0),
            lambda side, s: F.when(side != 0, side).otherwise(F.signum(_bin(at(s["j"]), s["low"], s["high"], bins) - s["bin"]).cast("int")),
        )

    is_open = (F.col("__n") > most) & (F.col("__need") < F.col("__n")) & (F.col("__j") < lead)
    while lead and not state.filter(is_open).isEmpty():
        wide, done = state.filter(is_open), state.filter(~is_open)
        inside = rows.join(wide, _same(group, own)).select(*own, "__need", "__j", "__path", "__x", F.col("__low").alias("__from"), F.col("__high").alias("__to"))
        inside = inside.filter(beside(F.col("__path")) == 0).withColumn("__v", at(F.col("__j")))
        inside = inside.withColumn("__bin", _bin(F.col("__v"), F.col("__from"), F.col("__to"), bins))
        # At most ``bins`` + 2 rows of a group.
        counted = inside.groupBy(*own, "__need", "__j", "__path", "__from", "__to", "__bin").agg(F.count(F.lit(1)).alias("__n"), *span(F.col("__v")))
        before = Window.partitionBy(*own).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        edge = counted.filter((F.col("__before") < F.col("__need")) & (F.col("__need") <= F.col("__before") + F.col("__n")))
        here = F.struct(F.col("__j").alias("j"), F.col("__from").alias("low"), F.col("__to").alias("high"), F.col("__bin").alias("bin"))
        # Infinite values may be nulls or NaN, too: they aren't divided further.
        next_number = F.when(F.col("__least") < F.col("__most"), F.col("__j")).when(F.abs("__least") < infinite, F.col("__j") + 1).otherwise(lead)
        edge = edge.withColumns({"__path": F.concat("__path", F.array(here.cast(step))), "__need": F.col("__need") - F.col("__before"), "__j": next_number})
        # The next number's span, among the rows that are left, is taken as it is needed.
        spans = rows.join(edge, _same(group, own)).select(*own, "__path", "__j", "__x").filter(beside(F.col("__path")) == 0)
        spans = spans.groupBy(*[F.col(g).alias(w) for g, w in zip(own, wanted, strict=True)]).agg(*span(at(F.col("__j"))))
        edge = edge.drop("__low", "__high", "__least", "__most").join(spans, _same(own, wanted), "left").select(*state.columns)
        state = done.unionByName(edge).checkpoint()

    joined = rows.join(state, _same(group, own)).select(*rows.columns, "__need", "__n", "__path")
    side = beside(F.col("__path"))
    # Where the quota takes all that is at the threshold, nothing is to be ranked.
    side = F.when((side == 0) & (F.col("__need") >= F.col("__n")), -1).otherwise(side)
    return joined.withColumn("__side", side).drop("__path", "__x")


def bottom_k(df: DataFrame, keys: list[str], k: int, order: list[Column]) -> DataFrame:
    """The ``k`` rows of each key that come first in ``order``, nulls first.

    Each task keeps the best ``k`` of each key among its rows (and passes them on
    when it holds more than ``HELD``), so that what is shuffled grows with keys, k
    and tasks and not with the rows; lists merge by the same rule.
    """
    names = [f"__o{i}" for i in range(len(order))]
    rows = df.withColumns(dict(zip(names, order, strict=True)))
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def best(table: pa.Table) -> pa.Table:
            # A key is a number, so that a null one is a key as well.
            numbers = table.select(keys).to_pandas().groupby(keys, dropna=False, sort=False).ngroup() if keys else [0] * len(table)
            table = table.append_column("__key", pa.array(numbers, pa.int64()))
            options = [("__key", "ascending"), *[(n, "ascending") for n in names]]
            table = table.take(pa.compute.sort_indices(table, sort_keys=options, null_placement="at_start"))
            key = table["__key"].to_numpy()
            starts = [0, *((key[1:] != key[:-1]).nonzero()[0] + 1).tolist(), len(key)]
            kept = [i for a, b in zip(starts, starts[1:], strict=False) for i in range(a, min(a + k, b))]
            return table.take(pa.array(kept, pa.int64())).drop_columns("__key")

        for batch in batches:
            if batch.num_rows:
                new = pa.Table.from_batches([batch])
                held = best(pa.concat_tables([held, new]) if held is not None else new)
                if len(held) > HELD:
                    yield from held.combine_chunks().to_batches()
                    held = None
        if held is not None:
            yield from held.combine_chunks().to_batches()

    few = rows.mapInArrow(run, schema)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*names))
    return few.withColumn("__r", number).filter(F.col("__r") <= k).drop("__r", *names)
