"""Folders that are written whole or not at all: fan-out in one pass, and commits by renaming."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.counters import Counters

MANIFEST = "_manifest.json"


class Store:
    """Files below a path, in whatever store it names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.files = self.at(path).getFileSystem(self.conf)

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.files.exists(self.at(path))

    def names(self, path: str) -> list[str]:
        """Names of what is right below ``path``; none if it isn't there."""
        return sorted(s.getPath().getName() for s in self.files.listStatus(self.at(path))) if self.exists(path) else []

    def make(self, path: str) -> None:
        self.files.mkdirs(self.at(path))

    def move(self, old: str, new: str) -> None:
        if not self.files.rename(self.at(old), self.at(new)):
            raise OSError(f"{old} can't become {new}")

    def remove(self, path: str) -> None:
        self.files.delete(self.at(path), True)

    def read(self, path: str) -> str:
        stream = self.files.open(self.at(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str, overwrite: bool = True) -> None:
        """``text`` as a file; without ``overwrite`` an error where there is one."""
        out = self.files.create(self.at(path), overwrite)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()


def committed(spark: SparkSession, path: str, fill, append: bool = False) -> None:
    """What ``fill`` writes below the folder that it is given, at ``path`` when all of it is there.

    The old folder stands until one rename puts the new one in its place; a failed run
    leaves it as it was.  ``append``: the new folders' files go beside the old ones.
    """
    store, base = Store(spark, path), path.rstrip("/")
    parent, name = base.rsplit("/", 1) if "/" in base else (".", base)
    new, old = f"{parent}/_new-{name}-{uuid.uuid4().hex}", f"{parent}/_old-{name}-{uuid.uuid4().hex}"
    try:
        fill(new)
        if append and store.exists(base):
            for folder in store.names(new):
                if folder.startswith(("_", ".")):
                    continue
                store.make(f"{base}/{folder}")
                for file in store.names(f"{new}/{folder}"):
                    if not file.startswith(("_", ".")):
                        store.move(f"{new}/{folder}/{file}", f"{base}/{folder}/{file}")
            if store.exists(f"{new}/{MANIFEST}"):
                store.write(f"{base}/{MANIFEST}", store.read(f"{new}/{MANIFEST}"))
            return
        if store.exists(base):
            store.move(base, old)
        try:
            store.move(new, base)
        except Exception:
            if store.exists(old):
                store.move(old, base)
            raise
        store.remove(old)
    finally:
        store.remove(new)


def fan_out(df: DataFrame, path: str, targets: dict[str, Column], append: bool = False) -> dict[str, int]:
    """A folder below ``path`` for each of ``targets`` with the rows for which it holds, in one job; the rows of each.

    A row may go to several folders (a branch's, its split's, one for all).  Folders
    without rows are there, and empty.  ``_manifest.json`` holds the numbers of rows
    written in all; it is the last file, and all appear at once or not at all.
    """
    spark = df.sparkSession
    chosen = F.array_compact(F.array(*[F.when(F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in targets.items()]))
    counters = Counters("fan-out", {name: F.count_if(F.col("__to") == name) for name in targets})
    rows = counters.over(df.withColumn("__to", F.explode(chosen)))
    store, counts = Store(spark, path), {}

    def fill(new: str) -> None:
        rows.write.partitionBy("__to").json(new)
        counts.update({name: int(counters.read()[name]) for name in targets})
        for name in targets:
            if counts[name]:
                store.move(f"{new}/__to={name}", f"{new}/{name}")
            else:
                store.make(f"{new}/{name}")
        before = json.loads(store.read(f"{path}/{MANIFEST}")) if append and store.exists(f"{path}/{MANIFEST}") else {}
        store.write(f"{new}/{MANIFEST}", json.dumps({name: n + before.get(name, 0) for name, n in counts.items()}, indent=2))

    committed(spark, path, fill, append)
    return counts


def branch_targets(names: dict[str, str], everything: str | None = None, splits: list[str] | None = None, branch: str = "branch", split: str = "split") -> dict[str, Column]:
    """Targets of ``fan_out``: a folder for each branch, one for all rows, and ``selected_`` ones for splits."""
    out = {folder: F.col(branch) == value for value, folder in names.items()}
    if everything:
        out[everything] = F.lit(True)
    return out | {f"selected_{s}": F.col(split) == s for s in splits or []}
