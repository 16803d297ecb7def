"""Recall at the edge of the similarity, and the number of pairs of a family that isn't linked."""

import numpy as np

from loomwright.llm import near_dedup
from loomwright.llm.common import materialize


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_pairs_just_above_the_similarity_are_linked(spark):
    rng = np.random.default_rng(8)
    rows, pairs = [], []
    while len(pairs) < 400:
        n = int(rng.integers(60, 500))
        words = [f"p{len(pairs)}x{i}" for i in range(n)]
        other = list(words)
        for at in rng.choice(n, max(1, round(n * rng.uniform(0.04, 0.065))), replace=False):
            other[at] = f"q{len(pairs)}x{at}"
        texts = " ".join(words), " ".join(other)
        a, b = (set(near_dedup.shingles(t, 2).tolist()) for t in texts)
        if 0.80 <= jaccard(a, b) < 0.82:
            at = len(rows)
            rows += [(at, texts[0]), (at + 1, texts[1])]
            pairs.append(at)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, words=2).collect()}
    assert np.mean([got[i + 1] == i for i in pairs]) >= 0.99


def family(rng, members, least, most, n=160):
    """Sets of ``n`` that keep a base but for a share of their own elements."""
    base = np.arange(n)
    sets = []
    for i in range(members):
        own = rng.random(n) < rng.uniform(least, most)
        sets.append(np.where(own, 1_000_000 + i * n + base, base))
    return [np.unique(near_dedup.mix(s.astype(np.uint64))) for s in sets]


def rows_of(spark, sets):
    rows = [(i, len(s), i, 1, bytearray(s.view(np.int64).tobytes())) for i, s in enumerate(sets)]
    return materialize(spark.createDataFrame(rows, "node long, n long, component long, size long, hashes binary"), "test")[0]


def test_an_unlinked_family_gives_few_pairs(spark):
    # 60 to 79 % like their origin, each by elements of its own.
    sets = family(np.random.default_rng(3), 3000, 0.14, 0.25)
    assert near_dedup.open_pairs(rows_of(spark, sets), 80).count() < 10 * len(sets)


def test_open_pairs_leave_out_no_similar_pair(spark):
    rng = np.random.default_rng(4)
    sets = family(rng, 150, 0.0, 0.2) + family(rng, 60, 0.05, 0.13, n=37) + [np.unique(near_dedup.mix(rng.integers(0, 50, 30).astype(np.uint64))) for _ in range(60)]
    found = {(r.a, r.b) for r in near_dedup.open_pairs(rows_of(spark, sets), 80).collect()}
    whole = [set(s.tolist()) for s in sets]
    alike = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 5 * len(whole[i] & whole[j]) >= 4 * len(whole[i] | whole[j])}
    assert alike and alike <= found


def test_repeated_and_null_ids_and_very_long_texts(spark):
    long = " ".join(f"w{i % 5000}" for i in range(200_000))
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "x y"), (2, long), (3, long + " end"), (4, "z" * 2_000_000)]
    clashing = "doc_id long, text string, key string, node string, size string, component string"
    df = spark.createDataFrame([(*r, "k", "n", "s", "c") for r in rows], clashing)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in near_dedup.near_duplicates(df, words=2).collect())
    assert got == [(0, 1, 0, True), (0, 3, 1, False), (1, 3, 1, True), (1, 3, 1, True), (2, 5000, 2, True), (3, 5001, 2, False), (4, 1, 4, True)]
