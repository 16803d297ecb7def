"""Shared helpers: reading tables, materialising in the shared folder, prefix sums."""

from __future__ import annotations

import atexit
import ctypes
import functools
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LEFT: list[tuple[SparkSession, str]] = []


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
#: Bytes of rows that a worker is sent at once.
BATCH_BYTES = "16m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the data set in ``sf_dir``.

    Rows go to Python by at most ``BATCH_BYTES`` at once, since texts may be long.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What empties each cache that a worker keeps from task to task, by the cache's name.
_CACHES: dict[str, Callable[[], None]] = {}


def worker_cache(name: str, clear: Callable[[], None]) -> None:
    """Name a cache that a module keeps for the worker's next tasks; see ``lean``."""
    _CACHES[name] = clear


def forget_caches(but: str | None = None) -> None:
    """Empty all of this worker's caches but one."""
    for name, clear in _CACHES.items():
        if name != but:
            clear()


def trim() -> None:
    """Give free memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps it
        pass


def lean(run: Run, cache: str | None = None) -> Run:
    """``run`` for mapInArrow, giving free memory back when a task ends: workers stay for other tasks and stages.

    ``cache`` names the worker's cache that ``run`` uses.  All others, which tasks
    of other operators left, are emptied first.
    """

    @functools.wraps(run)
    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_caches(cache)
        trim()
        try:
            yield from run(batches)
        finally:
            trim()

    return outer


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is what the cluster names in ``spark.checkpoint.dir``.  Where that is
    unset (tests, local mode: one machine) a temporary folder takes its place.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _LOCAL
    if _LOCAL is None:
        _LOCAL = tempfile.mkdtemp(prefix="loomwright-")
    return f"file://{_LOCAL}"


_LOCAL: str | None = None


#: Spark's setting that removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tasks for each core that write a table of short rows.
WAVES = 4


def materialize(df: DataFrame, label: str, short: bool = False) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder; return it reread, and its path.

    This cuts the lineage, and what later plans read is the same on each read,
    also after executors are lost.  Shuffle files of the write go when it ends, not
    when the driver happens to collect its garbage.  ``discard`` removes it when it is no longer
    read; what is left goes when the program ends.  ``short``: rows of a few
    numbers, written by ``WAVES`` tasks for each core of the cluster, however many
    partitions there are.
    """
    spark = df.sparkSession
    if short:
        df = df.coalesce(WAVES * spark.sparkContext.defaultParallelism)
    path = f"{shared_dir(spark)}/loomwright/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _LEFT.append((spark, path))
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove tables written by ``materialize``."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        _LEFT[:] = [x for x in _LEFT if x[1] != path]


@atexit.register
def _discard_all() -> None:
    for spark, path in list(_LEFT):
        try:
            if spark.sparkContext._jsc is not None:
                discard(spark, path)
        except Exception:  # noqa: BLE001 - the JVM may be gone at exit
            return


def ordered_key(docs: DataFrame, key: str) -> tuple[DataFrame, bool]:
    """``docs`` with a number of their own in ``key``, growing with doc_id (null last), then text and the other columns.

    It is doc_id itself, and the second result true, where that is no row's twice
    and never null.  Otherwise rows are sorted over all partitions, so that
    neither a hot id nor null is one task's, and numbered as they then lie.
    """
    if docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null").isEmpty():
        return docs.withColumn(key, F.col("doc_id").cast("long")), True
    sortable = [f.name for f in docs.schema if f.name not in ("doc_id", "text") and f.dataType.simpleString() in ("string", "bigint", "int", "double")]
    in_order = docs.orderBy(F.col("doc_id").asc_nulls_last(), "text", *sortable)
    return materialize(in_order.withColumn(key, F.monotonically_increasing_id()), "keyed")[0], False


#: A filter of keys has so many bits for each of them, and this many at most (16 MiB); a row of it has so many.
BITS_A_KEY, MOST_FILTER_BITS, ROW_BITS = 16, 1 << 27, 1 << 15


def parted(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may have their ``key`` among ``keys`` (materialised), and those that surely have not.

    A bitmap of hashes, bounded however many keys there are, goes to all tasks.  So
    of wide rows only those with a key, and few others, need to be shuffled for the
    join that tells exactly.  A null key is surely not among them.
    """
    bits = min(MOST_FILTER_BITS, max(ROW_BITS, 1 << (BITS_A_KEY * keys.count() - 1).bit_length()))
    place = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(bits))
    row, bit = F.shiftright(place, 15), place.bitwiseAND(F.lit(ROW_BITS - 1))
    # Dealt by row first: partial bitmaps would be larger than the keys.
    placed = keys.filter(F.col(key).isNotNull()).select(row.alias("__row"), bit.alias("__bit"))
    maps = placed.repartition("__row").groupBy("__row").agg(F.bitmap_construct_agg("__bit").alias("__map"))
    held = rows.withColumns({"__row": F.when(F.col(key).isNotNull(), row), "__bit": bit.cast("int")}).join(F.broadcast(maps), "__row", "left")
    byte = F.conv(F.hex(F.substring("__map", F.shiftright("__bit", 3) + 1, F.lit(1))), 16, 10).cast("int")
    found = held.withColumn("__found", F.coalesce(F.getbit(byte, F.col("__bit").bitwiseAND(F.lit(7))) == 1, F.lit(False)))
    return found.filter("__found").select(*rows.columns), found.filter("not __found").select(*rows.columns)


def among(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The ``rows`` with their ``key`` among ``keys`` (materialised)."""
    return parted(rows, keys, key)[0].join(keys.select(key), key, "left_semi")


def without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The ``rows`` with their ``key`` not among ``keys`` (materialised)."""
    maybe, others = parted(rows, keys, key)
    return others.unionByName(maybe.join(keys.select(key), key, "left_anti"))


def bucketed_prefix(
    df: DataFrame, levels: list[str], order: list[str], values: dict[str, str], group: list[str] | None = None
) -> DataFrame:
    """Exclusive running sums of ``values`` in the order of ``levels``, then ``order``.

    ``levels`` are columns that sort before ``order``.  Rows are only sorted
    within one combination of ``group`` and all levels; totals of the
    combinations are summed level by level, so that no task sorts more than the
    rows of one combination or the distinct values of one level below the
    levels above it.  ``group`` starts the sums anew.  All of these columns must
    not be null.  ``values`` maps each new column to the summed one.
    """
    keys = [*(group or []), *levels]
    totals = df.groupBy(*keys).agg(*[F.sum(v).alias(f"__t{len(levels)}_{k}") for k, v in values.items()])
    starts = totals
    for n in range(len(levels), 0, -1):
        above = [*(group or []), *levels[: n - 1]]
        window = (
            Window.partitionBy(*(above or [F.lit(0)])).orderBy(levels[n - 1]).rowsBetween(Window.unboundedPreceding, -1)
        )
        here = totals if n == len(levels) else totals.groupBy(*above, levels[n - 1]).agg(
            *[F.sum(f"__t{len(levels)}_{k}").alias(f"__t{n}_{k}") for k in values]
        )
        here = here.select(
            *above,
            levels[n - 1],
            *[F.coalesce(F.sum(f"__t{n}_{k}").over(window), F.lit(0)).alias(f"__s{n}_{k}") for k in values],
        )
        starts = here if n == len(levels) else starts.join(here, [*above, levels[n - 1]])
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumns({f"__l_{k}": F.coalesce(F.sum(v).over(inner), F.lit(0)) for k, v in values.items()})
    sums = [
        sum((F.col(f"__s{n}_{k}") for n in range(1, len(levels) + 1)), F.col(f"__l_{k}")).alias(k) for k in values
    ]
    return local.join(starts, keys).select(*[local[c] for c in df.columns], *sums)
