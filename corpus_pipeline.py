"""A corpus pipeline: five stages from ``documents`` to packed sequences.

Each stage takes what its predecessor kept.  Toxic documents go; of near
duplicates (five-word shingles, 80 %) one document stays; repeated 100-byte
strings go from the texts; sources are mixed to weights, a document once for each
copy that the mix takes; at last all texts are packed into sequences.

Edge cases are those of the operators; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwright.llm import mixing, near_dedup, packing, suffix_dedup, toxicity
from loomwright.llm.common import materialize, ordered_key, table, without

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't mark as toxic."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fitted(docs, labels)
    return toxicity.score_documents(docs.select(*COLUMNS), model).filter("score < 0.5").select(*COLUMNS)


def with_row_key(docs: DataFrame) -> DataFrame:
    """The distinct rows of ``docs`` with a ``key`` of their own, in the order of doc_id (null last), then text."""
    rows, own = ordered_key(docs.select(*COLUMNS), "key")
    # Where ids are unique no row is repeated.
    return rows if own else ordered_key(docs.select(*COLUMNS).distinct(), "key")[0]


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the row with the smallest doc_id (null last), then text.

    A repeated row, equal in all columns, is one row; rows that share a doc_id or
    have none are documents of their own.
    """
    rows = with_row_key(docs)
    found = near_dedup.near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"))
    dropped, _ = materialize(found.filter("not kept").select(F.col("doc_id").alias("key")), "dropped", short=True)
    return without(rows, dropped, "key").select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 100 bytes that also start earlier; texts left empty go.

    A character of which only some bytes are removed goes as a whole.
    """
    cut = suffix_dedup.without_repeats(docs.select(*COLUMNS), whole=True)
    out = cut.withColumn("n_chars", F.char_length("text").cast("long"))
    return out.filter("n_removed = 0 or n_bytes > n_removed").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the weighted mix takes it."""
    sized, _ = materialize(
        docs.select(*COLUMNS).select("doc_id", "source", mixing.word_count("text").alias("size")), "mix"
    )
    ends, _ = materialize(mixing.queue_ends(mixing.fair_queue(sized)), "ends")
    rows = mixing.with_copies(docs.select(*COLUMNS).withColumn("size", mixing.word_count("text")), ends).filter("copies > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a text in its sequence of at most 2048 tokens."""
    import public_tokenizers

    pieces = packing.cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    pieces, _ = materialize(pieces, "pieces")
    return packing.pack(pieces)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeats),
    ("fair_queue_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: The classifier, the byte strings and the tokenizer aren't SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn on ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
