"""Merged summaries equal those of the whole run, however it is cut into chunks."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomwright.operators import summaries


def some_edits(seed, n=400):
    rng = random.Random(seed)
    reasons = [f"validation:r{int(rng.paretovariate(0.6)) % 60}" for _ in range(n)]
    return [
        (rng.choice(["v2_add", "v3_delete", "v4_replace", None]), rng.choice("xy"), rng.choice(["a", "b"]), f"s{i}", ok := rng.random() < 0.3, None if ok or rng.random() < 0.05 else reasons[i], rng.random())
        for i in range(n)
    ]


def frames(spark, rows, cut):
    edits = spark.createDataFrame([(cut(i), *r) for i, r in enumerate(rows)], summaries.EDITS)
    runs = spark.createDataFrame([(c, n, float(n) / 8) for c, n in Counter(cut(i) for i in range(len(rows))).items()], "chunk string, records long, elapsed double")
    return edits, runs


@pytest.mark.parametrize("most", [4, 1000])
def test_any_chunking_gives_the_whole_summary(spark, most):
    rows = some_edits(most)
    rng = random.Random(0)
    drawn = [f"c{min(3, int(rng.expovariate(1)))}" for _ in rows]
    edits, runs = frames(spark, rows, lambda i: drawn[i])
    parts = summaries.summarised(edits, runs, most=most)
    merged = summaries.merged(summaries.merged(parts.filter("chunk < 'c2'"), most).unionByName(parts.filter("chunk >= 'c2'")), most)
    whole = summaries.summarised(*frames(spark, rows, lambda i: "all"), most=most)
    got, want = merged.first(), whole.first()
    assert got.records == want.records == len(rows) and got.counts == want.counts and got.samples == want.samples
    assert got.elapsed_sum == len(rows) / 8 and got.elapsed_most == max(Counter(drawn).values()) / 8
    true = Counter((b, r) for b, _, _, _, ok, r, _ in rows if not ok and r is not None)
    for x in got.reasons:
        assert x.n <= true[x.branch, x.reason] <= x.n + x.over
    kept, unseen = {(x.branch, x.reason) for x in got.reasons}, {x.branch: x.n for x in got.unseen}
    assert all(n <= unseen[b] for (b, r), n in true.items() if (b, r) not in kept)
    if most == 1000:
        assert got.reasons == want.reasons and not got.unseen
    top = {(r.branch, r.reason): r.n for r in summaries.top_reasons(edits, merged, 3).collect()}
    for branch in {b for b, _ in true}:
        best = sorted(((-n, r) for (b, r), n in true.items() if b == branch))[:3]
        assert {r: n for (b, r), n in top.items() if b == branch} == {r: -n for n, r in best}


def test_empty_and_rates(spark):
    none = spark.createDataFrame([], summaries.EDITS)
    runs = spark.createDataFrame([("c", 5, 1.5)], "chunk string, records long, elapsed double")
    merged = summaries.merged(summaries.summarised(none, runs))
    row = merged.first()
    assert (row.records, row.elapsed_most, row.counts, row.reasons, row.samples) == (5, 1.5, [], [], [])
    assert summaries.rates(merged).count() == 0 and summaries.structural_ratio(merged).first().passes is False
    rows = [("v2_add", "x", "a", "1", i < 2, None, 0.5) for i in range(3)]
    made = summaries.summarised(*frames(spark, rows, lambda i: "c"))
    assert {(r.level, r.key): r.pass_rate for r in summaries.rates(made).filter(F.col("level") != "category").collect()} == {("branch", "v2_add"): 66.6667, ("edit_type", "a"): 66.6667}
