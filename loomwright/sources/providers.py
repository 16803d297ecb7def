"""Asking a model: a seam for any provider, retries, and a cache of answers by content.

A provider is a function from a question (a dict) to an answer's text.  It runs in
tasks, on Arrow batches; nothing of it is known here, and no network is needed
without one.
"""

from __future__ import annotations

import json
import os
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.reports import cache_key
from ..operators.graph import ready_to_checkpoint
from .log import AppendLog

Provider = Callable[[dict], str]
ANSWERS = "key string, answer string, error string, attempts int"


def first_secret(names: list[str]) -> tuple[str, str]:
    """The first environment variable of ``names`` that isn't empty: (value, name)."""
    for name in names:
        if os.environ.get(name):
            return os.environ[name], name
    raise RuntimeError(f"set one of: {', '.join(names)}")


class Rate:
    """At most ``most`` calls a second, evenly, for all threads of a task."""

    def __init__(self, most: float | None):
        self.gap, self.next, self.lock = 1.0 / most if most else 0.0, 0.0, threading.Lock()

    def wait(self) -> None:
        with self.lock:
            at = max(time.monotonic(), self.next)
            self.next = at + self.gap
        time.sleep(max(0.0, at - time.monotonic()))


def _answer(provider: Provider, key: str, question: str, retries: int, pause: float, rate: Rate) -> tuple:
    answer = error = None
    for attempt in range(1, retries + 2):
        rate.wait()
        try:
            answer, error = provider(json.loads(question)), None
            break
        except Exception as problem:  # noqa: BLE001 - whatever the provider raises is the row's error
            error = f"{type(problem).__name__}: {problem}"
            if attempt <= retries:
                time.sleep(min(60.0, pause * 2 ** (attempt - 1)))
    return key, answer, error, attempt


def asked(questions: DataFrame, provider: Provider, retries: int = 2, pause: float = 0.0, workers: int = 1, rate: float | None = None) -> DataFrame:
    """``ANSWERS`` of ``questions`` (key, question as JSON); a failing one is asked ``retries`` times more.

    A task has up to ``workers`` calls under way, at most ``rate`` new ones a second,
    and gives answers out as they come: a slow one holds up no other, and no more
    questions are read than can be asked.  Waits between tries begin with ``pause``
    and double.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limit, columns = Rate(rate), ["key", "answer", "error", "attempts"]
        rows = ((k, q) for batch in batches for k, q in zip(batch["key"], batch["question"], strict=True))
        with ThreadPoolExecutor(workers) as pool:
            under_way: set = set()
            for key, question in rows:
                if len(under_way) >= workers:
                    done, under_way = wait(under_way, return_when=FIRST_COMPLETED)
                    yield pd.DataFrame([f.result() for f in done], columns=columns)
                under_way.add(pool.submit(_answer, provider, key, question, retries, pause, limit))
            while under_way:
                done, under_way = wait(under_way, return_when=FIRST_COMPLETED)
                yield pd.DataFrame([f.result() for f in done], columns=columns)

    return questions.select("key", "question").mapInPandas(run, ANSWERS)


def question_key(sample_id: Column, model: str, question: Column, images: Column, config: dict) -> Column:
    """What a cached answer depends on, as a key that begins with the sample's name."""
    of = cache_key(sample_id, F.lit(model), question, F.to_json(images), F.lit(json.dumps(config, sort_keys=True)))
    return F.concat(F.regexp_replace(sample_id, r"[^A-Za-z0-9_.-]+", "_"), F.lit("_"), of)


CACHE = "key string, answer string"


def with_cache(questions: DataFrame, path: str, provider: Provider | None, retries: int = 2, workers: int = 1, rate: float | None = None) -> DataFrame:
    """(key, answer, cached) of ``questions`` (key, question): from the cache at ``path``, else from the provider.

    The cache is a log of appends: several runs may add to it at once, and a key gets
    the answer that was committed first.  Without a provider, questions that the cache
    doesn't know have no answer.
    """
    spark = questions.sparkSession
    ready_to_checkpoint(spark)
    cache = AppendLog(spark, path, CACHE)
    known = cache.read()
    hits = questions.select("key").distinct().join(known.dropDuplicates(["key"]), "key").withColumn("cached", F.lit(True))
    misses = questions.dropDuplicates(["key"]).join(known.select("key").distinct(), "key", "left_anti")
    if provider is None:
        return hits.unionByName(misses.select("key", F.lit(None).cast("string").alias("answer"), F.lit(False).alias("cached")))
    fresh = f"{path.rstrip('/')}/_asked-{uuid.uuid4().hex}"
    asked(misses, provider, retries, workers=workers, rate=rate).write.parquet(fresh)
    new = spark.read.schema(ANSWERS).parquet(fresh)
    cache.append(new.filter("answer is not null").select("key", "answer"), key="key")
    asked_now = new.select("key", F.lit(False).alias("cached")).checkpoint()
    cache.store.remove(fresh)
    flagged = questions.select("key").distinct().join(asked_now, "key", "left").withColumn("cached", F.coalesce("cached", F.lit(True)))
    return flagged.join(cache.read().dropDuplicates(["key"]), "key", "left").select("key", "answer", "cached")
