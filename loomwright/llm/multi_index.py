"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut into halves, each half is quantised by a codebook of its own, and a
cell of the index is a pair of centroids.  A query visits pairs in the order of the
summed distance of its halves to the two centroids (the negated inner product, as
nearness is one), taken from a heap, until the visited cells hold enough entries;
all entries of these cells are ranked by their exact scores.

How many entries are enough is measured on the index at hand: for ``PROBES`` queries
the true neighbours are searched among all vectors, and the number is the least one
with which the traversal finds ``RECALL`` of them.  Vectors without structure need
about half of all entries, clustered ones a few hundred.

At scale: the codebooks are fitted on at most about ``FIT_ROWS`` vectors chosen by a
hash and have at most ``MOST_CENTROIDS`` centroids, so what is sent to all tasks is
bounded.  Every vector is indexed.  Equal vectors are one entry with its ``k`` + 1
smallest ids, since others can't be among the ``k`` nearest of any query, and equal
queries are searched once; codebooks start from sampled vectors, so a region with a
third of all vectors gets a third of the centroids.  Runs of cells form blocks of
at most ``BLOCK`` entries (more only where a million blocks would not do), a larger
cell being several blocks; a block's entries meet its queries in tiles of at most
``BLOCK`` queries, so no task holds more than a tile, and a tile gives at most
``k`` + 1 rows for a query.

Edge cases: a vector that is null, empty, zero, of another length than most (the
longer length, if two are as common) or that holds a null or a non-finite component
takes no part, nor does a row without an id; of rows that share a vec_id the one with
the least vector, component by component, stands for all; equal scores go by the
smaller vec_id; with ``k`` other vectors or fewer all are returned; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WAVES, lean, materialize, table

NEAREST, QUERY_STEP = 20, 20
FIT_ROWS, FIT_ROUNDS, MOST_CENTROIDS = 20_000, 8, 1024
#: Entries in an average cell, while there are fewer than MOST_CENTROIDS centroids.
IN_CELL = 32
PROBES, RECALL = 128, 0.95
BLOCK, MOST_BLOCKS = 2048, 1 << 19

Halves = tuple[np.ndarray, np.ndarray]


def matrix_of(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def halves(vectors: np.ndarray) -> Halves:
    cut = (vectors.shape[1] + 1) // 2
    return vectors[:, :cut], vectors[:, cut:]


def nearest_centroid(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The centroid with the least Euclidean distance to each row."""
    norms = (book * book).sum(1)
    return np.concatenate([np.zeros(0, "i8"), *[(2 * x[i : i + 4096] @ book.T - norms).argmax(1) for i in range(0, len(x), 4096)]]).astype("i8")


def codebook(x: np.ndarray, size: int, seed: int) -> np.ndarray:
    """``size`` centroids (fewer, if fewer rows differ) by Lloyd's rounds from sampled rows."""
    distinct = np.unique(x, axis=0) if x.shape[1] else x[:1]
    rng = np.random.default_rng(seed)
    drawn = x[rng.permutation(len(x))]
    _, first = np.unique(drawn, axis=0, return_index=True) if x.shape[1] else (None, np.zeros(1, "i8"))
    book = drawn[np.sort(first)[: min(size, len(distinct))]].copy()
    for _ in range(FIT_ROUNDS):
        at = nearest_centroid(x, book)
        order = np.argsort(at, kind="stable")
        present, begins = np.unique(at[order], return_index=True)
        if x.shape[1]:
            book[present] = np.add.reduceat(x[order], begins) / np.bincount(at, minlength=len(book))[present, None]
    return book


def visited(scores: Halves, filled: np.ndarray, enough: int) -> Iterator[int]:
    """Cells with entries, best sum of the two halves' scores first, until they hold ``enough`` entries.

    A pair's successors are the next second centroid, and for pairs with the best
    second centroid the next first one: each pair enters the heap once.
    """
    one, two = (np.argsort(-s, kind="stable") for s in scores)
    a, b = (-scores[0][one]).tolist(), (-scores[1][two]).tolist()
    one, two, rows, columns = one.tolist(), two.tolist(), len(a), len(b)
    heap = [(a[0] + b[0], 0, 0)]
    held = 0
    while heap and held < enough:
        _, i, j = heap[0]
        if j + 1 < columns:
            heapq.heapreplace(heap, (a[i] + b[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < rows:
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        cell = one[i] * columns + two[j]
        if n := filled[cell]:
            held += n
            yield cell


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part: one for each id, all vectors of one length."""
    inf = float("inf")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).filter(
        F.col("vec_id").isNotNull() & F.forall("v", fine) & F.exists("v", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    rows = rows.filter(F.size("v") == (common["d"] if common else 0))
    twice = rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows if twice.isEmpty() else rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def fitted_books(rows: DataFrame, n: int) -> Halves:
    """Codebooks of both halves, fitted on about ``FIT_ROWS`` of the ``n`` rows, chosen by a hash of the id."""
    fit = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n)) < FIT_ROWS).select("vec_id", "v").toArrow().sort_by("vec_id")
    if not len(fit):  # a hash may leave out all of very few rows
        fit = rows.orderBy("vec_id").limit(1).select("v").toArrow()
    size = min(MOST_CENTROIDS, max(1, round((n / IN_CELL) ** 0.5)))
    one, two = halves(matrix_of(fit["v"].combine_chunks()))
    return codebook(one, size, 1), codebook(two, size, 2)


def coded(rows: DataFrame, books: Halves, k: int) -> DataFrame:
    """(h, cell, members, v): a row for each distinct vector, with its cell and its ``k`` + 1 smallest ids."""
    least = Window.partitionBy("h", "v").orderBy("vec_id")
    rows = rows.withColumn("h", F.xxhash64("v")).withColumn("r", F.row_number().over(least)).filter(F.col("r") <= k + 1)
    entries = rows.groupBy("h", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = halves(matrix_of(batch["v"]))
                cell = nearest_centroid(one, books[0]) * len(books[1]) + nearest_centroid(two, books[1])
                yield pa.RecordBatch.from_arrays([batch["h"], pa.array(cell.astype("i4")), batch["members"], batch["v"]], ["h", "cell", "members", "v"])

    shape = f"h long, cell int, members array<long>, v {rows.schema['v'].dataType.simpleString()}"
    return entries.mapInArrow(lean(run), shape)


def measured_need(index: DataFrame, queries: DataFrame, books: Halves, filled: np.ndarray, k: int) -> int:
    """The entries that the cells visited must hold to find ``RECALL`` of the true neighbours of ``PROBES`` queries."""
    probes = queries.orderBy(F.xxhash64("h"), "key").limit(PROBES).select("h", "v").toArrow()
    q, own = matrix_of(probes["v"].combine_chunks()), probes["h"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of this task's entries for each probe."""
        score, cell = np.full((len(q), k), -np.inf), np.zeros((len(q), k), "i4")
        for batch in batches:
            x, cells, h = matrix_of(batch["v"]), batch["cell"].to_numpy(), batch["h"].to_numpy()
            for i in range(0, len(x), 4096):
                here = q @ x[i : i + 4096].T
                here[own[:, None] == h[None, i : i + 4096]] = -np.inf
                both = np.hstack([score, here])
                cols = np.argpartition(-both, min(k, both.shape[1]) - 1, axis=1)[:, :k]
                of = np.hstack([cell, np.broadcast_to(cells[i : i + 4096], here.shape)])
                score, cell = np.take_along_axis(both, cols, 1), np.take_along_axis(of, cols, 1)
        p, c = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays([pa.array(p.astype("i4")), pa.array(score[p, c]), pa.array(cell[p, c])], ["p", "score", "cell"])

    best = index.select("h", "cell", "v").mapInArrow(lean(run), "p int, score double, cell int")
    top = Window.partitionBy("p").orderBy(F.desc("score"), "cell")
    true = best.withColumn("r", F.row_number().over(top)).filter(F.col("r") <= k).select("p", "cell").toArrow()  # at most PROBES * k rows
    p, cells = true["p"].to_numpy(), true["cell"].to_numpy()
    one, two = halves(q)
    needs = []
    for i in range(len(q)):
        sums = -((books[0] @ one[i])[:, None] + (books[1] @ two[i])[None, :]).ravel()
        order = np.argsort(sums, kind="stable")
        before = np.zeros(len(order), "i8")
        before[order] = np.cumsum(filled[order]) - filled[order]
        needs.append(before[cells[p == i]] + 1)
    needs = np.sort(np.concatenate(needs)) if needs else np.zeros(0, "i8")
    return max(k + 1, int(needs[int(np.ceil(RECALL * len(needs))) - 1])) if len(needs) else k + 1


def blocks_of(filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each cell its first block and its number of blocks; neighbouring small cells share one."""
    most = max(BLOCK, int(filled.sum()) // MOST_BLOCKS + 1)
    first, number, block, room = np.zeros(len(filled), "i4"), np.ones(len(filled), "i4"), 0, most
    for cell in np.nonzero(filled)[0]:
        n = int(filled[cell])
        if n > room:
            block, room = block + 1, most
        first[cell], number[cell] = block, -(-n // most)
        block += int(number[cell]) - 1
        room = room - n if number[cell] == 1 else 0
    return first, number


def visits(queries: DataFrame, books: Halves, filled: np.ndarray, enough: int) -> DataFrame:
    """(key, block, cells, v): the blocks that each query visits, and in each the cells."""
    first, number = blocks_of(filled)
    counts = filled.tolist()
    element = queries.schema["v"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                one, two = halves(matrix_of(part["v"]))
                one, two = one @ books[0].T, two @ books[1].T
                row, block, cells = [], [], []
                for i in range(len(one)):
                    found = np.fromiter(visited((one[i], two[i]), counts, enough), "i4")
                    several = number[found] > 1
                    at = np.concatenate([first[found], *[np.arange(first[c] + 1, first[c] + number[c], dtype="i4") for c in found[several]]])
                    of = np.concatenate([found, *[np.full(number[c] - 1, c, "i4") for c in found[several]]])
                    order = np.argsort(at, kind="stable")
                    which, begins = np.unique(at[order], return_index=True)
                    row += [i] * len(which)
                    block += which.tolist()
                    cells += np.split(of[order], begins[1:])
                pick = pa.array(row, "i4")
                yield pa.RecordBatch.from_arrays(
                    [part["key"].take(pick), pa.array(block, pa.int32()), pa.array(cells, pa.list_(pa.int32())), part["v"].take(pick)],
                    ["key", "block", "cells", "v"],
                )

    # A traversal takes far longer than reading a query: tasks by cores, not by bytes.
    tasks = WAVES * queries.sparkSession.sparkContext.defaultParallelism
    return queries.select("key", "v").repartition(tasks, "key").mapInArrow(lean(run), f"key long, block int, cells array<int>, v {element}")


class Tile:
    """The entries of a block."""

    def __init__(self, batch: pa.Table):
        self.x = matrix_of(batch["v"].combine_chunks())
        self.cells, self.cell_of = np.unique(batch["cell"].to_numpy(), return_inverse=True)
        members = batch["members"].combine_chunks()
        self.ids = members.flatten().to_numpy()
        self.begin = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(members).to_numpy())])

    def best(self, keys: pa.Array, cells: pa.Array, q: np.ndarray, k: int) -> pa.RecordBatch:
        """For each query the ``k`` best (score, id) among the entries of its cells."""
        seen = np.zeros((len(q), len(self.cells)), bool)
        of_query = np.repeat(np.arange(len(q)), pa.compute.list_value_length(cells).to_numpy())
        flat = cells.flatten().to_numpy()
        at = np.minimum(np.searchsorted(self.cells, flat), len(self.cells) - 1)
        there = self.cells[at] == flat  # a block of a large cell may be without entries of another
        seen[of_query[there], at[there]] = True
        score = np.where(seen[:, self.cell_of], q @ self.x.T, -np.inf)
        least = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(q), -np.inf)
        row, entry = np.nonzero((score >= least[:, None]) & (score > -np.inf))
        sizes = self.begin[entry + 1] - self.begin[entry]
        ids = self.ids[np.repeat(self.begin[entry] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())] if len(entry) else np.zeros(0, "i8")
        row, value = np.repeat(row, sizes), np.repeat(score[row, entry], sizes)
        order = np.lexsort((ids, -value, row))
        row, value, ids = row[order], value[order], ids[order]
        begins = np.searchsorted(row, np.arange(len(q)))
        kept = np.arange(len(row)) - begins[row] < k
        lengths = np.bincount(row[kept], minlength=len(q))
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype("i4"))
        return pa.RecordBatch.from_arrays(
            [keys, pa.ListArray.from_arrays(offsets, pa.array(value[kept])), pa.ListArray.from_arrays(offsets, pa.array(ids[kept]))],
            ["key", "scores", "ids"],
        )


def ranked(index: DataFrame, asked: DataFrame, filled: np.ndarray, k: int) -> DataFrame:
    """(key, found): the ``k`` best (score, vec_id) of each query among the cells that it visits."""
    spark = index.sparkSession
    first, number = blocks_of(filled)
    full = np.nonzero(filled)[0]
    # Bounded: a row for each cell with entries, at most MOST_CENTROIDS ** 2.
    place = spark.createDataFrame(pa.table({"cell": full.astype("i4"), "first": first[full], "number": number[full]}))
    entries = index.join(F.broadcast(place), "cell").withColumn("block", (F.col("first") + F.pmod("h", F.col("number"))).cast("int"))
    # Blocks with more than one tile's queries: their entries go to each tile.  Bounded: at most about MOST_BLOCKS rows.
    tiles = asked.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("tiles")).filter("tiles > 1")
    of = F.coalesce("tiles", F.lit(1))
    entries = entries.join(F.broadcast(tiles), "block", "left").select(
        "block", F.explode(F.sequence(F.lit(0), of - 1)).alias("tile"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("key"),
        F.lit(None).cast("array<int>").alias("cells"), "cell", "members", "v",
    )
    asked = asked.join(F.broadcast(tiles), "block", "left").select(
        "block", F.pmod(F.xxhash64("key"), of).cast("int").alias("tile"), F.lit(1).alias("kind"), "key", "cells",
        F.lit(None).cast("int").alias("cell"), F.lit(None).cast("array<long>").alias("members"), "v",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, waiting, tile = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            # Runs of one tile and kind, in the order of the sort.
            names = np.stack([batch[c].to_numpy() for c in ("block", "tile", "kind")])
            ends = [*(np.nonzero((names[:, 1:] != names[:, :-1]).any(0))[0] + 1).tolist(), batch.num_rows]
            start = 0
            for end in ends:
                part, name = batch.slice(start, end - start), tuple(names[:2, start])
                if name != current:
                    current, waiting, tile = name, [], None
                if names[2, start] == 0:
                    waiting.append(part)
                elif waiting or tile is not None:
                    if tile is None:
                        tile, waiting = Tile(pa.Table.from_batches(waiting)), []
                    for i in range(0, part.num_rows, 256):
                        some = part.slice(i, 256)
                        yield tile.best(some["key"], some["cells"], matrix_of(some["v"]), k)
                start = end

    both = entries.unionByName(asked).repartition("block", "tile").sortWithinPartitions("block", "tile", "kind")
    parts = both.mapInArrow(lean(run), "key long, scores array<double>, ids array<long>")
    pairs = F.transform(F.arrays_zip("scores", "ids"), lambda x: F.struct((-x["scores"]).alias("s"), x["ids"].alias("id")))
    # A query has at most k rows of each block that it visits.
    return parts.groupBy("key").agg(F.slice(F.sort_array(F.flatten(F.collect_list(pairs))), 1, k).alias("found"))


def nearest(embeddings: DataFrame, step: int = QUERY_STEP, k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by ``step`` the ``k`` nearest others found."""
    rows = usable(embeddings)
    n = rows.count()
    empty = embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if n == 0:
        return empty
    books = fitted_books(rows, n)
    index, _ = materialize(coded(rows, books, k), "op13-index")
    cells = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toArrow()  # at most MOST_CENTROIDS ** 2 rows
    filled = np.zeros(len(books[0]) * len(books[1]), "i8")
    filled[cells["cell"].to_numpy()] = cells["n"].to_numpy()

    asking = rows.filter(F.pmod("vec_id", F.lit(step)) == 0).select("vec_id", F.xxhash64("v").alias("h"), "v")
    queries, _ = materialize(asking.select("h", "v").distinct().withColumn("key", F.monotonically_increasing_id()), "op13-queries")
    enough = measured_need(index, queries, books, filled, k)
    asked, _ = materialize(visits(queries, books, filled, enough), "op13-visits")
    found = ranked(index, asked, filled, k + 1)
    keys = asking.join(queries, ["h", "v"]).select("vec_id", "key").withColumnRenamed("vec_id", "query_id")
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    listed = keys.join(found, "key").select("query_id", F.posexplode(others).alias("at", "x"))
    return listed.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.s")).alias("score"))


def op13_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest vectors of every twentieth one."""
    return nearest(table(spark, sf_dir, "embeddings"))
