"""JSON lines: scans with line numbers, strict and lenient, and sinks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import folders


def read_strict(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of a JSONL file or folder; a bad line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_lenient(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of a JSONL file or folder; bad lines are left out, and a path that isn't there has no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, which may have globs, names any file."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """file, source_line (from 1, blank lines count) and raw text of each line that isn't blank.

    A file may be read by many tasks: each block's lines are numbered, and the
    blocks' counts, a row for each, are added up in the file's order.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"),
        F.col("value").alias("raw"),
    )
    blocks = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    numbered = lines.join(F.broadcast(starts), ["file", "block"])
    source_line = F.col("id") - F.col("first") + F.col("before") + 1
    return numbered.filter(F.trim("raw") != "").select("file", source_line.alias("source_line"), "raw")


def bad_lines(numbered: DataFrame) -> DataFrame:
    """Lines that aren't JSON objects, as ``file:line``."""
    ok = F.coalesce(F.try_parse_json("raw").isNotNull() & F.trim("raw").startswith("{"), F.lit(False))
    return numbered.filter(~ok).select(F.concat_ws(":", "file", "source_line").alias("at"), "raw")


def row_range(numbered: DataFrame, start: int = 0, limit: int | None = None, line: str = "source_line") -> DataFrame:
    """Lines from number ``start`` on, the first ``limit`` of them by number."""
    rows = numbered.filter(F.col(line) >= start)
    return rows if limit is None else rows.orderBy(line).limit(limit)


def write_by(df: DataFrame, path: str, *columns: str, append: bool = False) -> None:
    """One folder for each value of ``columns``, all below ``path``."""
    df.write.partitionBy(*columns).mode("append" if append else "overwrite").json(path)


def fan_out(df: DataFrame, path: str, column: str, names: dict[str, str], everything: str | None = None, append: bool = False) -> None:
    """A folder ``names[value]`` for the rows of each value of ``column``, empty or not, and one with all rows; one job, all or nothing."""
    folders.fan_out(df, path, folders.branch_targets(names, everything, branch=column), append)


def chunks(spark: SparkSession, root: str, summary: str) -> tuple[DataFrame, DataFrame]:
    """(chunk, path) of the files below ``root``/*/, and the chunks that have no file ``summary``."""
    base = re.escape(root.rstrip("/").rsplit("/", 1)[-1])
    files = spark.read.format("binaryFile").load(f"{root}/*/*").select(F.regexp_extract("path", rf".*/{base}/([^/]+)/", 1).alias("chunk"), "path")
    done = files.filter(F.col("path").endswith(f"/{summary}")).select("chunk").distinct()
    return files.orderBy("chunk", "path"), files.select("chunk").distinct().join(done, "chunk", "left_anti")
