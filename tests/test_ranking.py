"""Ranks, quotas and samples against windows over whole groups, with hot groups."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomwright.functions.scalars import stable_score
from loomwright.operators import ranking, selection

ODD = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 1e-300, 1e300]


def some_rows(seed, n=3000, hot=0.9):
    """Nine tenths of the rows in one split; scores with ties, odd values and clusters."""
    rng = random.Random(seed)
    score = lambda: rng.choice([rng.random(), rng.gauss(5, 1e-6), float(rng.randint(0, 3)), rng.choice(ODD)])
    return [(i // 2 if i % 50 == 0 else i, "train" if rng.random() < hot else rng.choice(["val", "test", None]), rng.choice("abcd"), score()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "sample_id long, part string, kind string, score double").repartition(6)


@pytest.mark.parametrize(("bins", "most"), [(4, 10), (64, 50), (4096, 1_000_000)])
def test_quota_selection_equals_whole_windows(spark, bins, most):
    df = frame(spark, some_rows(bins))
    quotas = spark.createDataFrame([("train", 1234), ("val", 17), (None, 5), ("test", 10**9), ("other", 3)], "part string, quota long")
    order = [F.col("score"), stable_score(F.lit(1), F.col("sample_id"))]
    got = ranking.first_by_quota(df, ["part"], quotas, order, ["sample_id"], bins, most)
    number = F.row_number().over(Window.partitionBy("part").orderBy(*order, "sample_id"))
    joined = df.join(quotas, df["part"].eqNullSafe(quotas["part"])).select(df["*"], "quota").withColumn("r", number)
    want = joined.filter("r <= quota").select(df.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_few_rows_of_a_hot_group_are_ranked(spark):
    df = frame(spark, some_rows(3))
    quotas = spark.createDataFrame([("train", 1300)], "part string, quota long")
    order = [F.lit(0.0), stable_score(F.lit(1), F.col("sample_id"))]
    sided = ranking.beside_threshold(df, ["part"], quotas, order, 16, 100)
    sides = {r["__side"]: r["count"] for r in sided.groupBy("__side").count().collect()}
    assert 0 < sides[0] <= 100 and sides[-1] + sided.filter("__side = 0").first()["__need"] == 1300
    plan = ranking.first_by_quota(df, ["part"], quotas, order, ["sample_id"], 16, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1  # over the rows at the threshold


def test_equal_rows_are_counted(spark):
    df = frame(spark, [(1, "train", "a", 1.0)] * 500 + [(2, "train", "a", 2.0)] * 20)
    quotas = spark.createDataFrame([("train", 507)], "part string, quota long")
    got = ranking.first_by_quota(df, ["part"], quotas, [F.col("score")], ["sample_id"], 4, 10)
    assert {r.sample_id: r["count"] for r in got.groupBy("sample_id").count().collect()} == {1: 500, 2: 7}
    assert ranking.first_by_quota(df.limit(0), ["part"], quotas, [F.col("score")], ["sample_id"]).count() == 0
    assert ranking.first_by_quota(df, ["part"], quotas.limit(0), [F.col("score")], ["sample_id"]).count() == 0


def test_positions_are_even_over_tasks(spark):
    df = frame(spark, some_rows(9, 20_000) + [(7, "train", "a", 1.0)] * 9_000)
    placed = ranking.numbered(df, ["part", "kind", "sample_id"])
    rows = placed.orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, len(rows) + 1))
    key = lambda r: tuple((v is not None, v) for v in (r.part, r.kind, r.sample_id))
    assert [key(r) for r in rows] == sorted(map(key, rows))
    sizes = sorted(r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert ranking.numbered(df.limit(0), ["part"]).count() == 0


def test_balanced_downsample_takes_turns(spark):
    rows = [(i, "train", "abbbccccccc"[i % 11], 0.0) for i in range(400)] + [(1000 + i, "val", "ab"[i % 2], 0.0) for i in range(9)]
    limits = spark.createDataFrame([("train", 130), ("val", 5)], "part string, target long")
    tie = stable_score(F.lit(3), F.col("sample_id"))
    df = frame(spark, rows)
    got = selection.balanced_downsample(df, "part", "kind", limits, tie, stable_score(F.lit(3), F.col("kind")))
    of_kind = Window.partitionBy("part", "kind")
    turns = df.withColumn("i", F.row_number().over(of_kind.orderBy(tie, "sample_id"))).withColumn("size", F.count(F.lit(1)).over(of_kind))
    order = Window.partitionBy("part").orderBy("i", "size", stable_score(F.lit(3), F.col("kind")), "kind")
    want = turns.withColumn("r", F.row_number().over(order)).join(limits, "part").filter("r <= target")
    assert sorted(r.sample_id for r in got.collect()) == sorted(r.sample_id for r in want.collect())


@pytest.mark.parametrize("held", [5, 200_000])
def test_bounded_lists_equal_windows(spark, monkeypatch, held):
    monkeypatch.setattr(ranking, "HELD", held)
    df = frame(spark, [(i, p, k, s) for i, p, k, s in some_rows(4, 800) if s == s])
    order = [F.sha2(F.col("sample_id").cast("string"), 256), F.col("score"), F.col("sample_id")]
    got = ranking.bottom_k(df, ["part", "kind"], 7, order)
    number = F.row_number().over(Window.partitionBy("part", "kind").orderBy(*order))
    want = df.withColumn("r", number).filter("r <= 7").drop("r")
    assert got.columns == df.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert ranking.bottom_k(df.limit(0), ["part"], 3, order).count() == 0


def test_one_per_stratum_with_repeated_rows(spark):
    df = frame(spark, [(i % 40, "train", "ab"[i % 2], 0.0) for i in range(120)])
    fill = [F.sha2(F.col("sample_id").cast("string"), 256), F.col("sample_id")]
    got = selection.one_per_stratum(df, ["kind"], 100, [F.col("sample_id")], fill)
    number = F.row_number().over(Window.partitionBy("kind").orderBy("sample_id"))
    want = df.withColumn("is_first", number == 1).orderBy(F.desc("is_first"), *fill).limit(100)
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_branch_caps_keep_whole_branches(spark):
    df = frame(spark, some_rows(6, 500)).filter("part is not null").dropDuplicates(["sample_id"])
    tie = stable_score(F.lit(9), F.col("sample_id"))
    got = selection.branch_caps(df, "kind", {"a": 30, "b": None, "c": 10**6}, "part", [], tie, F.when(~F.isnan("score"), F.col("score")))
    n = {r.kind: r["count"] for r in df.groupBy("kind").count().collect()}
    assert {r.kind: r["count"] for r in got.groupBy("kind").count().collect()} == {"a": 30, "b": n["b"], "c": n["c"]}
