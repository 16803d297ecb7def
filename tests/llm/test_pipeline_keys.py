import random

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_rows_without_an_id_or_with_a_shared_one_are_their_own_documents(spark):
    rng = random.Random(9)
    a, b, c, d, e = (" ".join(f"t{rng.randrange(5000)}" for _ in range(60)) for _ in range(5))
    texts = [(None, a), (None, b), (None, c + " more"), (1, c), (2, d), (2, e), (2, e), (3, d + " more"), (None, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], SCHEMA)
    want = [(None, a), (None, b), (1, c), (2, d), (2, e), (None, None), (4, "")]
    for n in (1, 5):
        out = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(n), "")
        assert out.columns == list(corpus_pipeline.COLUMNS)
        assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(want, key=repr)
