"""Parquet tables to which several runs may append at once: a log of commits says which files count.

An append writes its files aside, then takes the next number of the log.  Only one
run can take a number; one that comes too late reads what was committed meanwhile,
leaves out the keys that are there by now, and tries again.  A batch that is in the log
already changes nothing.  Files without a commit don't count, so a failed run leaves
nothing that a reader sees.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.counters import Counters
from .folders import Store

LOG = "_log"


class AppendLog:
    """A table at ``path`` with rows of ``schema``."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
        self.store = Store(spark, path)

    def entries(self, after: int = -1) -> list[dict]:
        """The commits behind number ``after``, in order."""
        numbers = sorted(int(n.removesuffix(".json")) for n in self.store.names(f"{self.path}/{LOG}") if n.endswith(".json"))
        return [json.loads(self.store.read(self._entry(n))) | {"number": n} for n in numbers if n > after]

    def files(self, entries: list[dict] | None = None) -> list[str]:
        """Names of the files that count; files without any log are a first commit."""
        entries = self.entries() if entries is None else entries
        gone = {f for e in entries for f in e["removed"]}
        early = [] if entries and "early" not in entries[0] else [n for n in self.store.names(self.path) if n.endswith(".parquet")] if not entries else entries[0]["early"]
        return [f for f in [*early, *(f for e in entries for f in e["added"])] if f not in gone]

    def read(self, files: list[str] | None = None) -> DataFrame:
        names = self.files() if files is None else files
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{n}" for n in names])

    def append(self, df: DataFrame, batch: str | None = None, key: str | None = None) -> int:
        """The number of new rows; with ``key`` rows whose key is there, now or by the time of the commit, are left out."""
        seen = self.entries()
        if batch is not None and any(e["batch"] == batch for e in seen):
            return 0
        rows = df if key is None else df.dropDuplicates([key]).join(self.read(self.files(seen)).select(key), key, "left_anti")
        staged, count = self._staged(rows)
        while True:
            last = seen[-1]["number"] if seen else -1
            if self._commit(last + 1, staged, [], batch, self.files([]) if not seen else None):
                return count
            later = self.entries(last)
            if batch is not None and any(e["batch"] == batch for e in later):
                self.store.remove(f"{self.path}/{staged}")
                return 0
            added = [f for e in later for f in e["added"]]
            if key is not None and added:
                ours = self.spark.read.schema(self.schema).parquet(f"{self.path}/{staged}")
                again, count = self._staged(ours.join(self.read(added).select(key), key, "left_anti"))
                self.store.remove(f"{self.path}/{staged}")
                staged = again
            seen = seen + later

    def compact(self, merge: Callable[[DataFrame], DataFrame] = lambda df: df) -> bool:
        """All files of now as few, by way of ``merge``; False if another run compacted them first.

        Appends go on meanwhile.  The old files stay until ``vacuum``, for those who read them.
        """
        seen = self.entries()
        old = self.files(seen)
        if len(old) < 2:
            return False
        staged, _ = self._staged(merge(self.read(old)).coalesce(max(1, len(old) // 16)))
        while True:
            last = seen[-1]["number"] if seen else -1
            if self._commit(last + 1, staged, old, None, self.files([]) if not seen else None):
                return True
            later = self.entries(last)
            if any(set(e["removed"]) & set(old) for e in later):
                self.store.remove(f"{self.path}/{staged}")
                return False
            seen = seen + later

    def vacuum(self) -> None:
        """Remove the files of commits that were compacted, when nobody reads them."""
        for name in {f for e in self.entries() for f in e["removed"]}:
            self.store.remove(f"{self.path}/{name}")

    def _entry(self, number: int) -> str:
        return f"{self.path}/{LOG}/{number:020d}.json"

    def _staged(self, rows: DataFrame) -> tuple[str, int]:
        """Rows written to a folder that readers pass over, and their number, from the write itself."""
        folder, counters = f"_staged-{uuid.uuid4().hex}", Counters("append")
        counters.over(rows.select(*self.schema.names)).write.parquet(f"{self.path}/{folder}")
        return folder, int(counters.read()["rows"])

    def _commit(self, number: int, staged: str, removed: list[str], batch: str | None, early: list[str] | None) -> bool:
        """Take ``number`` of the log for the staged files; False if it is taken."""
        if self.store.exists(self._entry(number)):
            return False
        names = [n for n in self.store.names(f"{self.path}/{staged}") if n.endswith(".parquet")]
        added = {n: f"{staged.removeprefix('_staged-')}-{n}" for n in names}
        entry = {"batch": batch, "added": list(added.values()), "removed": removed} | ({} if early is None else {"early": early})
        for old, new in added.items():
            self.store.move(f"{self.path}/{staged}/{old}", f"{self.path}/{new}")
        if self._created(self._entry(number), json.dumps(entry)):
            self.store.remove(f"{self.path}/{staged}")
            return True
        for old, new in added.items():
            self.store.move(f"{self.path}/{new}", f"{self.path}/{staged}/{old}")
        return False

    def _created(self, path: str, text: str) -> bool:
        """Write a file that must not be there, with all its text at once."""
        self.store.make(f"{self.path}/{LOG}")
        aside = f"{self.path}/{LOG}/_{uuid.uuid4().hex}"
        self.store.write(aside, text)
        try:
            if str(self.store.files.getUri().getScheme()) == "file":
                # A link to a name that is taken fails, whoever took it.
                os.link(urlparse(aside).path, urlparse(path).path)
                return True
            options = self.store.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.store.at(path).toUri(), self.store.conf)
            none = self.spark.sparkContext._gateway.new_array(getattr(self.store.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            options.rename(self.store.at(aside), self.store.at(path), none)
            return True
        except Exception:
            if self.store.exists(path):
                return False
            raise
        finally:
            self.store.remove(aside)


def keyed(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """The rows of a log, one for each key."""
    return AppendLog(spark, path, schema).read().dropDuplicates([key])


def summed(key: str, value: str) -> Callable[[DataFrame], DataFrame]:
    """A merge for ``compact``: the values of each key added up."""
    return lambda df: df.groupBy(key).agg(F.sum(value).alias(value))
