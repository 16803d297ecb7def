"""What a stage leaves to the next: no shuffle files, no other operator's caches, and small batches of samples."""

import time

import numpy as np
import pyarrow as pa
import pytest

from loomwright.llm import common, near_dedup, packing
from loomwright.llm import suffix_dedup as S

from test_suffix_dedup import brute


def shuffled(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles()
    return {x for x in files.mkString("\n").split("\n") if "/shuffle_" in x}


def test_shuffle_files_go_with_the_write(spark):
    before = shuffled(spark)
    rows = spark.range(5000).repartition(3).groupBy("id").count()
    written, _ = common.materialize(rows, "left-behind")
    for _ in range(50):  # they are removed in the background
        if not shuffled(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffled(spark) - before
    assert spark.conf.get(common.CLEANUP, "false") == "false"
    assert written.count() == rows.count() == 5000  # also what was shuffled is read again


def test_a_task_empties_the_caches_of_others():
    seen = []

    def run(batches):
        seen.append((len(packing._TOKENIZERS), len(near_dedup._WORDS)))
        yield from batches

    for cache in ("tokenizers", "words", None):
        packing._TOKENIZERS["none"] = object()
        near_dedup._WORDS[b"word"] = 1
        list(common.lean(run, cache)(iter([])))
        packing._TOKENIZERS.clear()
        near_dedup._WORDS.clear()
    assert seen == [(1, 0), (0, 1), (0, 0)]


def test_samples_leave_a_task_in_small_batches():
    """A text of 8 MB in pieces: its samples were one batch of 310,000."""

    class Held:
        def mapInArrow(self, run, schema):
            return run

    data = np.random.default_rng(0).integers(97, 123, 8_000_000, dtype=np.uint8).tobytes().decode()
    texts = [data[i : i + 4000] for i in range(0, len(data), 4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc", "text"])
    sizes = [x.num_rows for x in S._sampled(Held(), 50, 100)(iter([batch]))]
    assert sum(sizes) > 290_000 and max(sizes) < 260_000


@pytest.mark.parametrize("size", [1, 40])
def test_batches_of_samples_change_nothing(spark, monkeypatch, size):
    monkeypatch.setattr(S, "BATCH", size)
    rng = np.random.default_rng(5)
    pool = ["".join(rng.choice(list("abé "), 240)) for _ in range(3)] + ["y" * 250]
    rows = [(i, "".join(pool[rng.integers(4)][rng.integers(0, 90) :] for _ in range(3))) for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = S.without_repeats(df, 100, digest=True).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept).hex()) for r in got) == sorted(brute(rows, 100))


def test_repeats_go_with_one_worker_a_task(spark, capsys):
    """Cut texts came from two Python steps in a row, so that each core kept two workers."""
    import corpus_pipeline

    rows = [(1, "é" * 120, "en", "a", 120), (2, "x" + "é" * 60 + "z", "en", "a", 62), (3, None, "en", "a", 0), (4, "é" * 120, "en", "b", 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    cut = corpus_pipeline.drop_repeats(spark, docs, "")
    cut.explain()
    plan = capsys.readouterr().out
    assert plan.count("MapInArrow") == 1 and "EvalPython" not in plan
    # Of 120 times the same character all but the first repeat; the second text repeats but for its ends.
    assert sorted((r.doc_id, r.text, r.n_chars) for r in cut.collect()) == [(1, "é", 1), (2, "xz", 2), (3, "", 0)]
