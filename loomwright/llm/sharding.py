"""Sharding by Hilbert-curve order, with DataFrame functions only.

Language, source and size are quantised to eight bits each; the three numbers
make a point, and its place on the Hilbert curve through the 256^3 grid orders
the rows.  Runs of this order with near-equal bytes become the shards, so that
the files of a shard cover a small box of the three columns and readers can skip
the others by the files' column statistics.

Law: ``bytes``.  Row i with ``before`` bytes in front of it and ``size`` of its
own goes to shard floor(shards * (before + size / 2) / total): a shard's bytes
differ from total / shards by at most the size of its first and last rows.
Equal texts aren't forced together: a text with a third of all rows would then
make the shards unequal.

Edge cases: a null text has size 1 and crc32 0 as the empty one has; a null
lang, source or doc_id is a value of its own; rows that are equal in all columns
get neighbouring slots in either order; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucketed_prefix, materialize, table

BITS = 8


def quantised_name(value: Column, bits: int = BITS) -> Column:
    """A text column as a number of ``bits`` bits; null is 0."""
    cells = (1 << bits) - 1
    return F.coalesce(F.pmod(F.xxhash64(value), F.lit(cells)) + 1, F.lit(0)).cast("int") * value.isNotNull().cast("int")


def quantised_log(value: Column, bits: int = BITS) -> Column:
    """A positive count as a number of ``bits`` bits: eight steps for each doubling."""
    return F.least(F.lit((1 << bits) - 1), F.floor(F.log2(F.greatest(value, F.lit(1))) * 8)).cast("int")


def hilbert_index(axes: list[Column], bits: int = BITS) -> Column:
    """The place of a grid point on the Hilbert curve (Skilling's transform).

    A fold over the bit planes, from the highest, undoes the curve's rotations;
    a Gray code and the interleaved bits follow.  It is one expression and needs
    neither Python nor a table.
    """
    n = len(axes)
    names = [f"x{i}" for i in range(n)]
    bit = lambda q: q.cast("int")

    def turn(state: Column, q: Column) -> Column:
        x = [state[name] for name in names]
        low = bit(q) - 1
        for i in range(n):
            on = x[i].bitwiseAND(bit(q)) != 0
            swap = x[0].bitwiseXOR(x[i]).bitwiseAND(low)
            first = F.when(on, x[0].bitwiseXOR(low)).otherwise(x[0].bitwiseXOR(swap))
            x[i], x[0] = (x[i] if i == 0 else F.when(on, x[i]).otherwise(x[i].bitwiseXOR(swap))), first
        return F.struct(*[v.cast("int").alias(k) for v, k in zip(x, names, strict=True)])

    planes = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])
    start = F.struct(*[a.cast("int").alias(k) for a, k in zip(axes, names, strict=True)])

    def gray(state: Column) -> Column:
        x = [state[name] for name in names]
        for i in range(1, n):
            x[i] = x[i].bitwiseXOR(x[i - 1])
        last = x[n - 1]
        # Each set bit above the lowest flips all bits below it.
        flips = F.lit(0)
        for b in range(bits - 1, 0, -1):
            flips = flips.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0)))
        return F.struct(*[v.alias(k) for v, k in zip(x, names, strict=True)], flips.alias("flips"))

    def interleaved(state: Column) -> Column:
        out = F.lit(0).cast("long")
        for b in range(bits - 1, -1, -1):
            for name in names:
                one = F.shiftright(state[name].bitwiseXOR(state["flips"]), b).bitwiseAND(F.lit(1))
                out = F.shiftleft(out, 1).bitwiseOR(one.cast("long"))
        return out

    # transform() binds each step's result to a variable, so that it is computed once.
    turned = F.aggregate(planes, start, turn)
    return F.transform(F.transform(F.array(turned), gray), interleaved)[0]


def shard_by_hilbert(docs: DataFrame, shards: int) -> DataFrame:
    """``docs`` (key, size, axes as array of ints, tie columns) with shard and slot.

    Expects columns ``doc_id``, ``size``, ``text_crc32``, ``hilbert``; adds
    ``shard`` and ``slot`` (gapless from 0 in each shard, in curve order).
    """
    half = 3 * BITS // 2
    keyed = docs.withColumns(
        {
            "__hi": F.shiftright("hilbert", half),
            "__lo": F.col("hilbert").bitwiseAND(F.lit((1 << half) - 1)),
            "__mix": F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(256)),
            "__one": F.lit(1),
        }
    )
    placed = bucketed_prefix(
        keyed,
        ["__hi", "__lo", "__mix"],
        ["doc_id", "text_crc32", "size"],
        {"__bytes": "size", "__rows": "__one"},
    )
    total = docs.agg(F.sum("size").alias("n")).first()["n"] or 1
    at = F.expr(f"({shards} * (2 * __bytes + size)) div (2 * {total})")
    cut = placed.withColumn("shard", F.least(at, F.lit(shards - 1)).cast("int"))
    first = cut.groupBy("shard").agg(F.min("__rows").alias("__first"))  # a row for each shard
    return cut.join(F.broadcast(first), "shard").withColumn("slot", F.col("__rows") - F.col("__first"))


def op3_hilbert_sharding(spark: SparkSession, sf_dir: str, shards: int = 8) -> DataFrame:
    """All documents in ``shards`` shards of near-equal bytes, in Hilbert order."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", size.alias("size"), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
        quantised_name(F.col("lang")).alias("__lang"), quantised_name(F.col("source")).alias("__source"),
        quantised_log(size).alias("__size"),
    )
    docs = docs.select(
        "doc_id", "size", "text_crc32", hilbert_index([F.col("__lang"), F.col("__source"), F.col("__size")]).alias("hilbert")
    )
    docs, _ = materialize(docs, "op3")
    return shard_by_hilbert(docs, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert",
    )
