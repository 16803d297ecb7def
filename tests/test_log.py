"""Appends of several runs at once, replayed batches, compaction, concurrent calls."""

import json
import threading
import time

from pyspark.sql import functions as F

from loomwright.sources import providers
from loomwright.sources.log import AppendLog, summed
from loomwright.streaming import resume

SCHEMA = "key long, value string"


def rows(spark, a, b, text):
    return spark.range(a, b).select(F.col("id").alias("key"), F.lit(text).alias("value"))


def test_two_runs_at_once(spark, tmp_path):
    path, errors = str(tmp_path / "t"), []

    def run(n):
        try:
            for i in range(3):
                AppendLog(spark, path, SCHEMA).append(rows(spark, 10 * i, 10 * i + 15, f"run{n}"), key="key")
        except Exception as problem:  # noqa: BLE001
            errors.append(problem)

    threads = [threading.Thread(target=run, args=(n,)) for n in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    log = AppendLog(spark, path, SCHEMA)
    assert not errors and sorted(r.key for r in log.read().collect()) == list(range(35))
    assert [e["number"] for e in log.entries()] == list(range(6))


def test_one_that_comes_too_late_leaves_out_what_is_there(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    early, late = AppendLog(spark, path, SCHEMA), AppendLog(spark, path, SCHEMA)
    staged = late._staged

    def between(df):
        out = staged(df)
        monkeypatch.setattr(late, "_staged", staged)
        early.append(rows(spark, 0, 8, "early"), key="key")
        return out

    monkeypatch.setattr(late, "_staged", between)
    assert late.append(rows(spark, 5, 12, "late"), key="key") == 4
    assert {r.key: r.value for r in late.read().collect()} == {k: "early" if k < 8 else "late" for k in range(12)}


def test_batches_and_compaction(spark, tmp_path):
    log = AppendLog(spark, str(tmp_path / "t"), "key long, n long")
    for i in range(5):
        df = spark.createDataFrame([(1, i), (i, 1)], "key long, n long")
        assert (log.append(df, f"b{i}"), log.append(df, f"b{i}")) == (2, 0)
    before, files = {r.key: r.n for r in summed("key", "n")(log.read()).collect()}, log.files()
    held = log.read()
    assert log.compact(summed("key", "n")) and {r.key: r.n for r in log.read().collect()} == before and len(log.files()) < len(files)
    assert held.count() == 10  # those who read the old files still can
    log.append(spark.createDataFrame([(1, 5)], "key long, n long"))
    log.vacuum()
    assert {r.key: r.n for r in summed("key", "n")(log.read()).collect()}[1] == before[1] + 5
    (tmp_path / "t" / "_staged-left").mkdir()
    assert log.read().count() == len(before) + 1
    spark.range(3).select(F.col("id").alias("key"), F.lit("x").alias("value")).write.parquet(str(tmp_path / "old"))
    old = AppendLog(spark, str(tmp_path / "old"), SCHEMA)
    assert old.append(rows(spark, 2, 5, "new"), key="key") == 2 and sorted(r.key for r in old.read().collect()) == [0, 1, 2, 3, 4]


def test_streams_hold_no_state(spark, tmp_path):
    schema, inbox = spark.range(1).schema, tmp_path / "in"
    for i in range(4):
        spark.range(i, i + 3).write.mode("append").parquet(str(inbox))
        for name, start in (("follow", resume.follow), ("counts", resume.running_counts)):
            query = start(spark, str(inbox), schema, "id", str(tmp_path / name), str(tmp_path / f"state-{name}"))
            query.awaitTermination(60)
            assert all(not p["stateOperators"] for p in query.recentProgress)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "follow")).collect()) == list(range(6))
    assert {r.id: r.n for r in resume.counts_so_far(spark, str(tmp_path / "counts"), schema, "id").collect()} == {0: 1, 1: 2, 2: 3, 3: 3, 4: 2, 5: 1}
    log = AppendLog(spark, str(tmp_path / "follow"), schema)
    assert log.append(spark.range(100), log.entries()[0]["batch"], "id") == 0


def questions(spark, n):
    return spark.createDataFrame([(f"k{i}", json.dumps({"n": i})) for i in range(n)], "key string, question string").coalesce(1)


def test_calls_at_once_give_the_same_answers(spark, tmp_path):
    log = tmp_path / "calls"

    def provider(question):
        begun = time.time()
        time.sleep(0.3 if question["n"] == 0 else 0.02)
        with log.open("a") as f:
            f.write(f"{begun} {time.time()}\n")
        if question["n"] % 7 == 3:
            raise ValueError("no")
        return f"a{question['n']}"

    one = sorted(map(repr, providers.asked(questions(spark, 24), provider, 1).collect()))
    log.write_text("")
    many = providers.asked(questions(spark, 24), provider, 1, workers=6).collect()
    assert sorted(map(repr, many)) == one and many[0].key != "k0"  # the slow one holds up no other
    spans = [tuple(map(float, x.split())) for x in log.read_text().splitlines()]
    at_once = max(sum(a <= t < b for a, b in spans) for t, _ in spans)
    assert 2 <= at_once <= 6


def test_rate_is_kept(spark, tmp_path):
    log = tmp_path / "calls"

    def provider(question):
        with log.open("a") as f:
            f.write(f"{time.time()}\n")
        return "a"

    assert providers.asked(questions(spark, 12), provider, workers=8, rate=20).count() == 12
    times = sorted(map(float, log.read_text().split()))
    assert times[-1] - times[0] >= 11 / 20 * 0.9


def test_runs_share_a_cache(spark, tmp_path):
    path, asked = str(tmp_path / "cache"), tmp_path / "asked"

    def provider(question):
        with asked.open("a") as f:
            f.write("x")
        return f"a{question['n']}"

    threads = [threading.Thread(target=lambda: providers.with_cache(questions(spark, 8), path, provider, workers=4).collect()) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(r.key for r in AppendLog(spark, path, providers.CACHE).read().collect()) == [f"k{i}" for i in range(8)]
    before = len(asked.read_text())
    again = providers.with_cache(questions(spark, 9), path, provider).collect()
    assert len(asked.read_text()) == before + 1 and sum(r.cached for r in again) == 8
