"""The inverted multi-index against brute force: recall, exact scores, order, edge cases."""

import numpy as np
import pytest

from loomwright.llm import multi_index

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, step, k):
    """True (score, id) lists of the queries."""
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids], "f8")
    out = {}
    for q in (i for i in ids if i % step == 0):
        s = x @ np.asarray(vectors[q], "f8")
        out[q] = sorted((-v, i) for v, i in zip(s.tolist(), ids, strict=True) if i != q)[:k]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def agreement(got, true, vectors, k):
    """The recall; ranks, order and scores must be right for what was found."""
    hits = total = 0
    assert set(got) == set(true)
    for q, rows in got.items():
        assert [r[0] for r in rows] == list(range(1, len(true[q]) + 1)) and len({r[1] for r in rows}) == len(rows)
        keys = [(-r[2], r[1]) for r in rows]
        assert keys == sorted(keys)
        for _, i, s in rows:
            assert abs(s - float(np.dot(np.asarray(vectors[i], "f8"), np.asarray(vectors[q], "f8")))) < 1e-9
        hits += len({r[1] for r in rows} & {i for _, i in true[q]})
        total += len(true[q])
    return hits / total


def frame(spark, vectors, parts=3):
    return spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in vectors.items()], SCHEMA).repartition(parts)


@pytest.mark.parametrize(("kind", "block"), [("clusters", 2048), ("random", 64), ("copies", 16)])
def test_recall_and_order(spark, monkeypatch, kind, block):
    """Small blocks cut cells into several and give hot blocks several tiles."""
    monkeypatch.setattr(multi_index, "BLOCK", block)
    rng = np.random.default_rng(len(kind))
    n, d = 1500, 12
    x = rng.normal(size=(n, d)).astype("f4")
    if kind == "clusters":
        x = (rng.normal(size=(30, d))[rng.integers(0, 30, n)] * 3 + x / 4).astype("f4")
    if kind == "copies":  # a third is one vector, a sixth is near to it
        x[: n // 3], x[n // 3 : n // 2] = x[0], x[0] + x[n // 3 : n // 2] * np.float32(0.001)
    vectors = {int(i): v for i, v in zip(rng.permutation(4 * n)[:n], x, strict=True)}
    got = found(multi_index.nearest(frame(spark, vectors), step=5, k=10))
    assert agreement(got, brute(vectors, 5, 10), vectors, 10) >= 0.9


def test_few_vectors_and_ties(spark):
    vectors = {i: v for i, v in enumerate([(1, 0), (0, 1), (1, 0), (2, 0), (-1, 0), (0, -3), (1, 0)])}
    got = found(multi_index.nearest(frame(spark, vectors), step=2, k=20))
    assert {q: [(-s, i) for _, i, s in r] for q, r in got.items()} == brute(vectors, 2, 20)
    assert found(multi_index.nearest(frame(spark, {0: (1.0,)}), step=1)) == {}
    assert found(multi_index.nearest(frame(spark, {0: (2.0,), 3: (-1.0,)}), step=3)) == {0: [(1, 3, -2.0)], 3: [(1, 0, -2.0)]}


def test_rows_that_take_no_part(spark):
    good = {i: [float(i % 7 + 1), float(i % 5), 1.0] for i in range(0, 60)}
    bad = [(100, None), (120, []), (140, [0.0, 0.0, 0.0]), (160, [1.0, None, 2.0]), (180, [float("nan"), 1.0, 1.0]), (200, [float("inf"), 1.0, 1.0]), (220, [9.0, 9.0]), (None, [50.0, 50.0, 50.0])]
    again = [(20, good[20]), (40, [99.0, 99.0, 99.0])]  # a repeated row, and a larger vector of the same id
    rows = [(i, v, "x", 1.0) for i, v in [*good.items(), *bad, *again]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, h string, cell double")
    got = found(multi_index.nearest(df, k=5))
    assert {q: [(-s, i) for _, i, s in r] for q, r in got.items()} == brute(good, 20, 5)
    assert multi_index.nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert multi_index.nearest(spark.createDataFrame([(1, None, 1)], SCHEMA)).columns == ["query_id", "rank", "vec_id", "score"]


def test_traversal_is_in_order_and_stops():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=9), rng.normal(size=7)
    filled = rng.integers(0, 4, 63)
    sums = (a[:, None] + b[None, :]).ravel()
    cells = [c for c in np.argsort(-sums) if filled[c]]
    assert list(multi_index.visited((a, b), filled.tolist(), 10**9)) == cells
    some = list(multi_index.visited((a, b), filled.tolist(), 25))
    assert some == cells[: len(some)] and filled[some].sum() >= 25 > filled[some[:-1]].sum()


def test_blocks_hold_runs_of_cells(monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 10)
    filled = np.array([4, 0, 5, 3, 35, 0, 10, 1, 9, 2])
    first, number = multi_index.blocks_of(filled)
    assert list(first[filled > 0]) == [0, 0, 1, 2, 6, 7, 7, 8] and list(number[filled > 0]) == [1, 1, 1, 4, 1, 1, 1, 1]
