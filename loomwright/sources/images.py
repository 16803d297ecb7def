"""Images: which paths exist, and files as data addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Media types by suffix.
MEDIA_TYPES = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "webp": "image/webp", "bmp": "image/bmp", "tif": "image/tiff", "tiff": "image/tiff"}


def resolved(path: Column, root: str) -> Column:
    """A path below ``root``, unless it is absolute."""
    plain = F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), r"^\./", "")
    return F.when(plain.startswith("/") | plain.rlike(r"^[A-Za-z][\w+.-]*:"), plain).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), plain))


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, size) of all files below ``root``; the files aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(F.regexp_replace("path", r"^file:(?://)?", "").alias("path"), F.col("length").alias("size"))


def missing(records: DataFrame, images: str, key: str, files: DataFrame, root: str) -> DataFrame:
    """(key, missing: the paths that aren't in ``files``) of records that lack some."""
    wanted = records.select(key, F.posexplode(images).alias("at", "image")).withColumn("path", resolved(F.col("image"), root))
    lacking = wanted.join(files.select("path").distinct(), "path", "left_anti")
    return lacking.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "image"))), lambda x: x["image"]).alias("missing"))


def with_images(records: DataFrame, images: str, key: str, files: DataFrame, root: str) -> DataFrame:
    """``records`` all of whose images are there, at least one each."""
    return records.filter(F.size(images) > 0).join(missing(records, images, key, files, root).select(key), key, "left_anti")


def data_urls(spark: SparkSession, root: str) -> DataFrame:
    """(path, url) of all images below ``root``, base64 in a data address."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    types = F.create_map(*[F.lit(x) for pair in MEDIA_TYPES.items() for x in pair])
    kind = F.coalesce(F.try_element_at(types, F.lower(F.regexp_extract("path", r"\.(\w+)$", 1))), F.lit("application/octet-stream"))
    return files.select(F.regexp_replace("path", r"^file:(?://)?", "").alias("path"), F.concat(F.lit("data:"), kind, F.lit(";base64,"), F.base64("content")).alias("url"))
