"""Near-duplicate documents by one-permutation MinHash.

* A document is the set of its distinct word shingles, hashed to 64 bits.  Equal
  sets become one node, the smallest doc_id, so exact copies cost one row.
* One permutation: the hash range is cut into bins and each bin keeps its least
  hash.  Empty bins are densified optimally: bin i takes the value of the first
  non-empty bin in i's own random order, the same for all documents.
* Bins are banded; documents that share a band's key are in one bucket.
* Star-shaped edges: in each bucket one member is the centre and the others are
  compared with it alone, so a bucket costs one edge for each member.
* A bucket whose other members are then still in several components may hold a
  link that its star missed.  Its members are *open*, and all pairs of open nodes
  of different components are searched by an exact prefix filter
  (``open_pairs``), which makes few pairs where members differ by words of their
  own, however many they are.  So no pair that shares a bucket is left undecided.
* An edge becomes a link if the full sets pass the similarity exactly.

Edge cases: a text with fewer words than a shingle is one shingle; null, empty
and blank texts have none and link with nothing; rows with equal sets, repeated
rows too, are one node; rows of one doc_id or without one are documents of their
own, null after all others; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import among, discard, lean, materialize, ordered_key, table, worker_cache
from .graph import components

WORDS, PERCENT, BANDS, ROWS = 5, 80, 32, 5
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SALTS = 256
#: Ratio of neighbouring size classes in the prefix filter.
SIZE_STEP = 1.05
#: Words whose hashes are kept: so many, of so many bytes at most.
CACHED, LONGEST = 150_000, 64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection on 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words; at most ``CACHED``, and none of over ``LONGEST`` bytes, are kept."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONGEST:
            if len(self) >= CACHED:
                self.clear()
            self[word] = value
        return value


_WORDS = _Words()
worker_cache("words", _WORDS.clear)


def shingles(text: str | bytes | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text, A-Z lower-cased."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    raw = text if isinstance(text, bytes) else text.encode()
    tokens = raw.lower().split()
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    h = np.array(list(map(_WORDS.__getitem__, tokens)), dtype=np.uint64)
    size = min(words, len(h))
    out = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        out = mix(out * _C1 + h[i : len(h) - size + 1 + i])
    return np.unique(out)


@lru_cache(maxsize=4)
def probes(bins: int, tries: int) -> np.ndarray:
    """The order in which each empty bin looks for a non-empty one: (tries, bins)."""
    n = np.arange(tries * bins, dtype=np.uint64)
    return (mix(n * _C1 + _C3) % np.uint64(bins)).astype(np.int64).reshape(tries, bins)


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash of sorted hashes, densified; ``bins`` values."""
    at = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    out, full = np.zeros(bins, dtype=np.uint64), np.zeros(bins, dtype=bool)
    out[at[first]], full[at[first]] = hashes[first], True
    empty, source = np.flatnonzero(~full), np.arange(bins)
    for tries in (32, 2048):
        if not len(empty):
            break
        order = probes(bins, tries)[:, empty]
        hit = full[order]
        found = hit.any(axis=0)
        source[empty[found]] = order[hit.argmax(axis=0), np.arange(len(empty))][found]
        empty = empty[~found]
    if len(empty):  # practically never: the next non-empty bin to the right
        held = np.flatnonzero(full)
        source[empty] = held[np.searchsorted(held, empty) % len(held)]
    return out[source]


def band_keys(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band."""
    values = signature(hashes, bands * rows).reshape(bands, rows)
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        keys = mix(keys * _C1 + values[:, r])
    return keys.view(np.int64)


SIGNED = "key long, doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def signed(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """Set size, two hashes of the whole set and the band keys of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b, keys = [], [], [], []
            for text in batch.column(2).cast(pa.binary()):
                s = shingles(text.as_py(), words)
                n.append(len(s))
                a.append(int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                b.append(int(mix(s ^ _C3).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                keys.append(band_keys(s, bands, rows) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["key", "doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )

    return docs.select("key", "doc_id", "text").mapInArrow(lean(run, "words"), SIGNED)


def hashed(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, hashes as packed 64-bit words) of the documents in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [shingles(text.as_py(), words).tobytes() for text in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["node", "hashes"])

    texts = among(docs.select("key", "text"), wanted.select(F.col("node").alias("key")), "key")
    return texts.mapInArrow(lean(run, "words"), "node long, hashes binary")


def _joined(edges: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """``edges`` (a, b) with ``column`` of a as x and of b as y.

    A centre may have most of all edges, so it is salted: each salt in use gets
    the centre's value once.
    """
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    left = salted.select("a", "salt").distinct().join(sets.select(F.col("node").alias("a"), F.col(column).alias("x")), "a")
    right = salted.join(sets.select(F.col("node").alias("b"), F.col(column).alias("y")), "b")
    return right.join(left, ["a", "salt"])


def confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``edges`` (a, b) whose full sets have the similarity."""

    @F.pandas_udf("boolean")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(left, right, strict=True):
            a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            if len(a) > len(b):
                a, b = b, a
            at = np.searchsorted(b, a)
            common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
            out.append(100 * common >= percent * (len(a) + len(b) - common))
        return pd.Series(out, dtype=bool)

    return materialize(_joined(edges, sets, "hashes").filter(similar("x", "y")).select("a", "b").distinct(), "links", short=True)[0]


def exploded(sets: DataFrame) -> DataFrame:
    """(node, n, component, shingle) of ``sets`` (node, n, component, hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 64):  # a bounded number of sets at a time
                part = batch.slice(i, 64)
                values = [np.frombuffer(v.as_py(), dtype=np.int64) for v in part.column(3)]
                sizes = [len(v) for v in values]
                rows = [pa.array(np.repeat(part.column(k).to_numpy(zero_copy_only=False), sizes)) for k in range(3)]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(np.concatenate(values))], names=["node", "n", "component", "shingle"])

    return sets.select("node", "n", "component", "hashes").mapInArrow(lean(run), "node long, n long, component long, shingle long")


def open_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of different components that may have the similarity; none that has it is left out.

    ``sets``: written rows (node, n, component, size: of the component, hashes).
    Shingles are ordered from the rarest among the open nodes, so that the first
    that a pair has in common, at place i of n and j of m, tells that it has
    n - i and m - j in common at most: m is then at most (n - i) * (1 + 1/t) - n
    for the similarity t.  A shingle is sent once for each class of sizes that it
    can have a partner in, and not at all if no other node has it.  In each key,
    only members outside of its largest component look for partners.
    """
    rows = exploded(sets)
    common = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    rarest = Window.partitionBy("node").orderBy("c", "shingle")
    # Places of shingles that others have too: after all of the node's own.
    placed = rows.join(common, "shingle").withColumns(
        {"r": F.row_number().over(rarest), "shared": F.count(F.lit(1)).over(Window.partitionBy("node"))}
    )
    placed = placed.withColumn("at", F.col("n") - F.col("shared") + F.col("r") - 1)
    most = F.floor(((F.col("n") - F.col("at")) * (100 + percent) - F.col("n") * percent) / F.lit(percent))
    least = F.ceil(F.col("n") * percent / F.lit(100))
    of_size = lambda n: F.floor(F.log(n.cast("double")) / F.lit(float(np.log(SIZE_STEP)))).cast("int")
    placed = placed.withColumns({"least": least, "most": most}).filter("least <= most")
    keyed = placed.select(
        "shingle", of_size(F.col("n")).alias("own"),
        F.explode(F.sequence(of_size(F.col("least")), of_size(F.col("most")))).alias("other"),
        "node", "n", "most", "component",
    )
    keyed, keyed_at = materialize(keyed, "prefixes", short=True)
    sizes = sets.select("component", "size").distinct()
    largest = (
        keyed.groupBy("shingle", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "component")
        .agg(F.count(F.lit(1)).alias("here"))
        .join(sizes, "component")
        .groupBy("shingle", "low", "high")
        .agg(F.max(F.struct("size", "component")).alias("top"), F.count(F.lit(1)).alias("k"))
        .filter("k > 1")
        .select("shingle", "low", "high", F.col("top.component").alias("top"))
    )
    low, high = F.least("own", "other"), F.greatest("own", "other")
    asking = keyed.withColumns({"low": low, "high": high}).join(largest, ["shingle", "low", "high"]).filter("component <> top")
    asking, asking_at = materialize(
        asking.select("shingle", F.col("own").alias("x_own"), F.col("other").alias("x_other"), F.col("node").alias("x"), F.col("n").alias("x_n"),
                      F.col("most").alias("x_most"), F.col("component").alias("x_component")),
        "asking",
        short=True,
    )
    k, q = keyed.alias("k"), asking.alias("q")
    met = q.join(
        k,
        (F.col("q.shingle") == F.col("k.shingle")) & (F.col("q.x_own") == F.col("k.other")) & (F.col("q.x_other") == F.col("k.own"))
        & (F.col("q.x_component") != F.col("k.component")) & (F.col("k.n") <= F.col("q.x_most")) & (F.col("q.x_n") <= F.col("k.most")),
    )
    pairs, _ = materialize(met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct(), "pairs", short=True)
    discard(sets.sparkSession, keyed_at, asking_at)
    return pairs


def near_duplicates(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    docs, own = ordered_key(docs.select("doc_id", "text"), "key")
    signs, _ = materialize(signed(docs, words, bands, rows), "signed")
    nodes, nodes_at = materialize(
        signs.filter("n_shingles > 0").groupBy("n_shingles", "set_a", "set_b").agg(
            F.min("key").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")
        ),
        "nodes",
    )
    slots = nodes.select(F.explode("bands").alias("key"), "node", F.col("n_shingles").alias("n"))
    shared = slots.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    # A member's weight is the size of all its buckets: what others are copies of has the greatest.
    wanted, wanted_at = materialize(
        slots.join(shared, "key").groupBy("node", "n").agg(F.sum("c").alias("weight"), F.collect_list("key").alias("keys")), "wanted", short=True
    )
    sets, sets_at = materialize(hashed(docs, wanted, words), "sets")

    members = wanted.select("node", "n", "weight", F.explode("keys").alias("key"))
    centre = members.groupBy("key").agg(F.min_by(F.struct("node", "n"), F.struct(-F.col("weight"), "node")).alias("centre"))
    centre = centre.select("key", F.col("centre.node").alias("c_node"), F.col("centre.n").alias("c_n"))
    rest, rest_at = materialize(members.drop("weight").join(centre, "key").filter("node <> c_node"), "rest", short=True)
    able = F.least("n", "c_n") * 100 >= F.greatest("n", "c_n") * percent
    edges, edges_at = materialize(rest.filter(able).select(F.col("c_node").alias("a"), F.col("node").alias("b")).distinct(), "edges", short=True)
    labels, labels_at = components(confirmed(edges, sets, percent))

    # Open: members beside a centre, in a bucket where these are in several components.
    named = rest.select("key", "node").join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    named, named_at = materialize(named, "named", short=True)
    mixed = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("key")
    open_, open_at = materialize(named.join(mixed, "key", "left_semi").select("node", "component").distinct(), "open", short=True)
    size = open_.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    full = open_.join(size, "component").join(wanted.select("node", "n"), "node").join(sets, "node")
    full, full_at = materialize(full.select("node", "n", "component", "size", "hashes"), "full")
    further = confirmed(open_pairs(full, percent), full, percent)
    if not further.isEmpty():
        # Links between components make larger ones.
        part = full.select("node", "component")
        joined = further.join(part.toDF("a", "ca"), "a").join(part.toDF("b", "cb"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
        larger, larger_at = components(materialize(joined, "joined", short=True)[0])
        larger = larger.toDF("component", "larger")
        alone = larger.select(F.col("component").alias("node"), "component")  # also those that had no label yet
        both = labels.union(alone).distinct().join(larger, "component", "left")
        labels, newer_at = materialize(both.groupBy("node").agg(F.min(F.coalesce("larger", "component")).alias("component")), "labels", short=True)
        discard(spark, labels_at, larger_at)
        labels_at = newer_at
    discard(spark, wanted_at, sets_at, rest_at, edges_at, named_at, open_at, full_at)

    groups = nodes.select("n_shingles", "set_a", "set_b", "node", "copies")
    found = groups.join(labels, "node", "left").filter("copies > 1 or component is not null")
    found = found.withColumn("component", F.coalesce("component", "node"))
    found, _ = materialize(found.select("n_shingles", "set_a", "set_b", "component"), "components", short=True)
    discard(spark, nodes_at, labels_at)
    out = signs.select("key", "doc_id", "n_shingles", "set_a", "set_b").join(found, ["n_shingles", "set_a", "set_b"], "left")
    if own:
        out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    else:
        ids = docs.select(F.col("key").alias("component"), F.col("doc_id").alias("component_id"), F.lit(True).alias("there"))
        out = out.join(ids, "component", "left").select("doc_id", "n_shingles", F.when(F.col("there"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose two-word shingle sets are 80 % alike."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


#: All pairs by shared shingles, then the smallest reachable id.
OP10_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM t),
u AS (SELECT doc_id, len(s) AS n, list_sort(s) AS k FROM g),
r AS (SELECT min(doc_id) AS a, k, n FROM u WHERE n > 0 GROUP BY k, n),
e AS (SELECT a, n, unnest(k) AS x FROM r),
p AS (
  SELECT l.a, m.a AS b, count(*) AS c, any_value(l.n) AS na, any_value(m.n) AS nb
  FROM e l JOIN e m ON l.x = m.x AND l.a < m.a AND least(l.n, m.n) * 100 >= greatest(l.n, m.n) * 80
  GROUP BY l.a, m.a),
k AS (SELECT a, b FROM p WHERE 100 * c >= 80 * (na + nb - c)),
h AS (SELECT a, b FROM k UNION ALL SELECT b, a FROM k),
reach(a, b) AS (SELECT a, a FROM r UNION SELECT reach.a, h.b FROM reach JOIN h ON reach.b = h.a),
z AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT u.doc_id, u.n AS n_shingles, coalesce(z.c, u.doc_id) AS component_id, u.doc_id = coalesce(z.c, u.doc_id) AS kept
FROM u LEFT JOIN r ON u.k = r.k AND u.n > 0 LEFT JOIN z ON z.a = r.a
"""
