"""Incremental runs: resume a batch, or follow a folder of files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..sources.log import AppendLog, summed


def pending(source: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't done yet."""
    return source.join(done.select(key).distinct(), key, "left_anti")


def resume(source: DataFrame, path: str, key: str, overwrite: bool = False) -> int:
    """Append what ``path`` (a log of Parquet files) lacks of ``source``; the number of new rows, from the write itself.

    Two runs at once append no key twice.
    """
    log = AppendLog(source.sparkSession, path, source.schema)
    if overwrite:
        log.store.remove(log.path)
    return log.append(source, key=key)


def follow(spark: SparkSession, inbox: str, schema: StructType, key: str, out: str, checkpoint: str) -> StreamingQuery:
    """Each new file's rows to ``out`` (a log), a key once; stops when the inbox is read.

    What is known is the table itself, not the stream's state, which stays empty however
    long the stream is; a batch that is played again is in the log and changes nothing.
    """
    log = AppendLog(spark, out, schema)
    rows = spark.readStream.schema(schema).parquet(inbox)
    writer = rows.writeStream.option("checkpointLocation", checkpoint)
    return writer.foreachBatch(lambda df, n: log.append(df, f"{checkpoint}#{n}", key)).trigger(availableNow=True).start()


#: Batches after which the counts of a stream are compacted.
COMPACT_AFTER = 20


def running_counts(spark: SparkSession, inbox: str, schema: StructType, key: str, out: str, checkpoint: str) -> StreamingQuery:
    """The counts by ``key`` of all files so far, as ``counts_so_far`` reads them.

    Each batch appends the counts of its own keys, so no state is held and nothing is
    rewritten; the log's files are added up from time to time.  A batch that is
    played again changes nothing, and readers always find a whole table.
    """
    log = AppendLog(spark, out, _counts_schema(schema, key))

    def add(df: DataFrame, n: int) -> None:
        log.append(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")), f"{checkpoint}#{n}")
        if len(log.files()) > COMPACT_AFTER * spark.sparkContext.defaultParallelism or n % COMPACT_AFTER == COMPACT_AFTER - 1:
            log.compact(summed(key, "n"))

    rows = spark.readStream.schema(schema).parquet(inbox)
    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(add).trigger(availableNow=True).start()


def _counts_schema(schema: StructType, key: str) -> StructType:
    return StructType([schema[key], StructField("n", LongType())])


def counts_so_far(spark: SparkSession, out: str, schema: StructType, key: str) -> DataFrame:
    """(key, n): what ``running_counts`` has counted up to now."""
    return summed(key, "n")(AppendLog(spark, out, _counts_schema(schema, key)).read())
