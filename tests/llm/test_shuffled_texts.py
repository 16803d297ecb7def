"""Stages of the pipeline choose among texts without shuffling all of them."""

import random
import re

import corpus_pipeline
import pytest
from loomwright.llm import common, mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def few_broadcasts(spark):
    """Tables of some thousand keys are too large to broadcast unasked."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "12k")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffles(df):
    """What the shuffles of the plan are dealt by."""
    return re.findall(r"(?<!Broadcast)Exchange (\w+\(\w*)", df._jdf.queryExecution().executedPlan().toString())


def written(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "docs.parquet"))
    return spark.read.parquet(str(tmp_path / "docs.parquet"))


def test_mixing_shuffles_no_text(spark, tmp_path, few_broadcasts):
    rng = random.Random(5)
    rows = [(rng.randrange(1 << 60), "word " * rng.randrange(9), "en", f"s{i % 3}", 0) for i in range(3000)]
    assert shuffles(corpus_pipeline.mix_sources(spark, written(spark, tmp_path, rows), "")) == []


def test_most_texts_pass_a_filter_of_keys_unshuffled(spark, few_broadcasts):
    rng = random.Random(6)
    gone = [rng.randrange(-(1 << 62), 1 << 62) for _ in range(4000)]
    keys, _ = common.materialize(spark.createDataFrame([(k,) for k in [*gone, None]], "key long"), "gone")
    rows = [(k, "gone") for k in gone] + [(i, "stays") for i in range(20_000)] + [(None, "stays")]
    table, _ = common.materialize(spark.createDataFrame(rows, "key long, text string"), "rows")
    maybe, others = common.parted(table, keys, "key")
    assert [x for x in shuffles(others) if "__row" not in x] == []
    assert others.count() > 0.85 * 20_000 and others.filter("text = 'gone'").isEmpty()
    assert maybe.count() + others.count() == len(rows)
    assert {r.text for r in common.without(table, keys, "key").collect()} == {"stays"}
    assert common.without(table, keys, "key").count() == 20_001
    assert sorted(r.key for r in common.among(table, keys, "key").collect()) == sorted(gone)


def test_a_filter_without_keys_lets_all_pass(spark):
    none = spark.createDataFrame([], "key long")
    assert common.without(spark.range(9).toDF("key"), none, "key").count() == 9
    assert common.among(spark.range(9).toDF("key"), none, "key").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_ends_of_queues_give_each_document_its_copies(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, i, i]), rng.choice([None, "a", "b", "c"]), rng.choice([0, 1, 5, rng.randrange(300)])) for i in range(400)]
    docs, _ = common.materialize(spark.createDataFrame(rows, "doc_id long, source string, size long"), "sized")
    mixed, _ = common.materialize(mixing.fair_queue(docs).select("doc_id", "source", "size", "shuffle", "copies"), "mixed")
    key = lambda r: (r.doc_id, r.source, r.size)
    # Rows equal in all columns share the decision at an end.
    want: dict = {}
    for r in mixed.collect():
        want[key(r)] = max(r.copies, want.get(key(r), 0))
    got = mixing.with_copies(docs, mixing.queue_ends(mixed)).collect()
    assert len(got) == 400 and {key(r): r.copies for r in got} == want
