import hashlib

import numpy as np
import pytest

from loomwright.llm import suffix_dedup as S


def brute(rows, length):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + length, dtype=bool)
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                gone[i : i + length] = True
            seen.add(w)
        gone = gone[: len(raw)]
        runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((doc_id, len(raw), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    pool = ["".join(rng.choice(list("abé \n"), 260)) for _ in range(4)] + ["x" * 300, "ab" * 200]
    rows = [(None, "tail"), (3, None), (4, "")]
    for i in range(40):
        parts = []
        for _ in range(rng.integers(0, 4)):
            p = pool[rng.integers(len(pool))]
            a = int(rng.integers(0, 150))
            parts.append(p[a : a + int(rng.integers(1, 250))] + "".join(rng.choice(list("cdef"), rng.integers(0, 5))))
        rows.append((10 + i % 35, "".join(parts)))
    rows += [rows[-1], rows[-1]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = S.without_repeats(df, 100, digest=True).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept).hex()) for r in got), key=repr) == sorted(brute(rows, 100), key=repr)


def test_names_and_minima():
    data = np.frombuffer(b"abcabcabcabc" * 9, dtype=np.uint8)
    n = S.names(data, (50, 100))
    assert (n[50][:20] == n[50][3:23]).all() and n[50][0] != n[50][1] and len(n[100]) == len(data) - 99
    values = np.array([5, 3, 3, 9, 1, 1, 7], dtype=np.uint64)
    assert S.first_minima(values, 3).tolist() == [1, 1, 4, 4, 4]


def test_empty_table(spark):
    assert S.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
