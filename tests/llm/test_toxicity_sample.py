import zlib

import numpy as np

from loomwright.llm import toxicity


def corpus(clean, toxic):
    rng = np.random.default_rng(2)
    plain, bad = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}a" for i in range(200)], ["idiotish", "idiotle", "scumlor"]
    texts, labels = [], []
    for y, n in ((0, clean), (1, toxic)):
        for _ in range(n):
            ws = list(rng.choice(plain, rng.integers(5, 60)))
            for _ in range(3 * y):
                ws.insert(int(rng.integers(0, len(ws))), bad[rng.integers(3)])
            texts.append(" ".join(ws))
            labels.append(y)
    return texts, labels


def collected(docs, marks, **more):
    rows = sorted(toxicity.training_rows(docs, marks, **more).collect(), key=lambda r: r.doc_id)
    return [r.text for r in rows], [r.toxic for r in rows]


def test_an_evened_sample_decides_like_all_rows(spark):
    texts, labels = corpus(1200, 150)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "unlabelled"])], "doc_id long, text string")
    marks = spark.createDataFrame([*enumerate(labels), (99_999, 1)], "doc_id long, toxic int")
    rows = docs.union(docs.filter("doc_id = 1"))
    counts = toxicity.training_counts(rows, marks)
    assert counts == np.bincount(collected(rows, marks)[1], minlength=2).tolist()
    some = collected(rows, marks, sample=100)
    assert min(np.bincount(some[1])) > 90 and len(some[1]) <= 200  # a label without a document, and a repeated row
    whole, even = toxicity.fit(*collected(rows, marks), counts), toxicity.fit(*some, counts)
    for model in (whole, even):
        blank = model.scores([None, "", "12 %%"])
        assert len(set(blank.tolist())) == 1 and abs(blank[0] - 1 / 9) < 0.02
    new, truth = corpus(100, 20)
    assert ((even.scores(new) >= 0.5) == np.array(truth)).mean() > 0.95
    # A word seen in both classes tells nothing: such a text is not near the evened sample's half.
    assert np.abs(even.scores(new[:100]) - whole.scores(new[:100])).mean() < 0.1


def test_query_learns_from_four_fifths_and_scores_all(spark, tmp_path):
    texts, labels = corpus(300, 60)
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(len(texts))]
    rows = [(i, t, "d", 0.5, i) for i, t in enumerate(texts)] + [(1000, None, "d", 0.5, 0), (1001, "", "d", 0.5, 0), (None, texts[310], "d", 0.5, 0), (2, texts[2], "d", 0.5, 0)]
    rows.append((1002, texts[301] + " " + "very" * 400_000, "d", 0.5, 0))
    clashing = "doc_id long, text string, source string, score double, toxic int"
    found = []
    for flip in (False, True):
        at = tmp_path / str(flip)
        marks = [(i, 0, 1 - y if flip and h else y) for i, (y, h) in enumerate(zip(labels, held, strict=True))]
        spark.createDataFrame(rows, clashing).repartition(3).write.parquet(f"{at}/documents.parquet")
        spark.createDataFrame([*marks, (5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        out = toxicity.op6_toxicity(spark, str(at))
        assert out.columns == ["doc_id", "held_out", "score", "predicted"]
        found.append(sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.score, r.predicted) for r in out.collect()))
    assert found[0] == found[1]  # held-out labels are never seen
    got = {r[0]: r for r in found[0]}
    assert len(found[0]) == len(rows) and all(got[i][1] == h for i, h in enumerate(held)) and not got[-1][1]
    assert all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.5) for r in found[0])
    # The same by hand: a model of the rows that training may see, applied to each text.
    seen = [i for i, h in enumerate(held) if not h]
    model = toxicity.fit([texts[i] for i in seen], [labels[i] for i in seen])
    assert np.allclose([got[i][2] for i in range(len(texts))], model.scores(texts), atol=1e-6)
    tested = [i for i, h in enumerate(held) if h]
    assert np.mean([got[i][3] == labels[i] for i in tested]) > 0.9
    assert got[-1][2] == got[310][2] and got[1002][3] == 1 and got[1000][2] == got[1001][2]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, toxicity.fitted(docs, marks)).count() == 0


def test_no_letter_of_a_long_run_is_left_out():
    tail = "abcdefghijklmnopqrstuvwxyz" * 9
    for n in (59, 60, 61, 66, 67, 114, 115, 234):
        run = tail[:n]
        parts = toxicity.words_of(run)
        assert max(map(len, parts)) <= toxicity.LONGEST
        assert all(any(run[i : i + 6] in p for p in parts) for i in range(n - 5))
    assert toxicity.words_of("one " + "b" * 60) == ["one", "b" * 60]
    clean, bad = toxicity.gram_cells(toxicity.words_of("x" * 70))[0], toxicity.gram_cells(toxicity.words_of("x" * 70 + "scum"))[0]
    assert set(bad.tolist()) - set(clean.tolist())
