"""Language-model scores: marginal likelihood of a subword lattice.

The pieces of an existing vocabulary, with a space in front where a piece begins
a word, are drawn independently.  A word's probability is the sum over all its
segmentations into pieces, by forward recursion in log space.  No piece spans two
words, so a text's lattice is a chain of its words' lattices and each distinct
word is solved once; words of one length are solved side by side.

Weights start from the vocabulary's own scores (a piece's rank, as a Zipf law)
and are fitted by expectation maximisation on the words of all training
documents, each as often as it occurs, with that law as prior.  ``score`` is of
the pieces alone.  ``word_edge_score`` has one more edge in a word's lattice, the
whole word, weighted by its count in the training documents; the pieces' paths
then keep the share of tokens that words seen once make up (Good and Turing's
estimate of what is unseen).  Words, or the end, sum to 1 in both.

* Words are counted in each task and summed by word; nothing of that is sampled.
* Words that make up more than 1 / ``HEAVY`` of all tokens are at most ``HEAVY``;
  their scores go to all tasks, under 64-bit hashes.  Every other word has, by the
  same bound, few rows, so the join that brings its score to its documents has no
  hot key.

Edge cases: a null, empty or blank text is the end symbol alone; unknown
characters fall back on byte pieces; repeated rows are scored each; a null doc_id
counts as training; if there are no training documents the prior alone scores
and base scores are those of one unseen word; a word of any length is scored
whole; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, lean, materialize, table

HEAVY = 400_000
#: Distinct words, and bytes of text, that a task counts before it passes on its sums.
FLUSH, FLUSH_BYTES = 200_000, 16_000_000
PASSES = 2
PRIOR = 2000.0  # how many drawn pieces the vocabulary's own weights count for
#: Words of more bytes are solved one by one; cells of a table that are filled at once.
LONGEST, CELLS = 64, 2_000_000
SIDE_BY_SIDE = 50_000
_TABLE_BITS = 18
_P1, _P2, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def vocabulary(path: str) -> tuple[list[bytes], list[float]]:
    """Pieces as bytes, a leading space for a word's start, and prior weights.

    Left out are pieces that no lower-cased text has and those of several spaces.
    The last pieces are the bytes that aren't pieces themselves; each gets the
    weight of the rarest piece.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ranks = [], []
    for i in range(model.get_piece_size()):
        if model.is_byte(i) or model.is_control(i) or model.is_unknown(i):
            continue
        text = model.id_to_piece(i)
        raw = (" " + text[1:] if text.startswith("▁") else text).encode()
        if "▁" in text[1:] or raw != raw.lower():
            continue
        pieces.append(raw)
        ranks.append(max(1.0, 3.0 - model.get_score(i)))
    weights = [1.0 / r for r in ranks]
    there = set(pieces)
    alone = [x for b in range(256) if (x := bytes([b])) not in there]
    weights += [min(weights, default=1.0)] * len(alone)
    total = sum(weights)
    return [*pieces, *alone], [w / total for w in weights]


class Lattice:
    """Pieces with log weights, for words as ``b" " + word``."""

    def __init__(self, pieces: list[bytes], log_weights: list[float]):
        # Each piece and prefix of one: (piece or -1, its log weight, whether longer ones follow).
        self.steps: dict[bytes, tuple[int, float, bool]] = {}
        longer = {p[:n] for p in pieces for n in range(1, len(p))}
        for prefix in longer:
            self.steps[prefix] = (-1, -math.inf, True)
        for i, (piece, weight) in enumerate(zip(pieces, log_weights, strict=True)):
            self.steps[piece] = (i, weight, piece in longer)
        self.weights = np.append(np.array(log_weights), -np.inf)  # piece -1: none
        self.longest = max(map(len, pieces))
        # Two hashes of each piece in a table with linear probing; -1 where it is empty.
        one, two = (np.zeros(len(pieces), np.uint64) for _ in range(2))
        by_length: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            by_length.setdefault(len(piece), []).append(i)
        for n, at in by_length.items():
            letters = np.frombuffer(b"".join(pieces[i] for i in at), np.uint8).reshape(-1, n).astype(np.uint64) + np.uint64(1)
            for k in range(n):
                one[at], two[at] = one[at] * _P1 + letters[:, k], two[at] * _P2 + letters[:, k]
        self.one, self.two = one, two
        size = 1 << _TABLE_BITS
        slots, self.table = self._slots(one).tolist(), np.full(size, -1, np.int32)
        taken: dict[int, int] = {}
        self.probes = 1
        for i, slot in enumerate(slots):
            probe = 1
            while slot in taken:
                slot, probe = (slot + 1) % size, probe + 1
            taken[slot] = i
            self.probes = max(self.probes, probe)
        self.table[list(taken)] = list(taken.values())

    @staticmethod
    def _slots(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _SPREAD) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def _find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The piece of each pair of hashes; -1 where there is none."""
        out, slot = np.full(len(one), -1, np.int32), self._slots(one)
        left = np.arange(len(one))
        for _ in range(self.probes):
            at = self.table[slot[left]]
            left, at = left[at >= 0], at[at >= 0]
            if not len(left):
                break
            same = (self.one[at] == one[left]) & (self.two[at] == two[left])
            out[left[same]] = at[same]
            left = left[~same]
            slot[left] = (slot[left] + 1) % len(self.table)
        return out

    def _solve(self, words: list[bytes]) -> tuple[list[list[np.ndarray]], list[list[np.ndarray]], list[np.ndarray]]:
        """For words of one length: pieces and weights by start and size less one, and log probabilities of prefixes."""
        n, size = len(words[0]) + 1, len(words)
        letters = np.empty((n, size), np.uint64)
        letters[0] = ord(" ") + 1
        letters[1:] = np.frombuffer(b"".join(words), np.uint8).reshape(size, n - 1).T.astype(np.uint64) + np.uint64(1)
        h1, h2, p1, p2 = [np.zeros(size, np.uint64)], [np.zeros(size, np.uint64)], [np.uint64(1)], [np.uint64(1)]
        with np.errstate(over="ignore"):
            for k in range(n):
                h1.append(h1[-1] * _P1 + letters[k])
                h2.append(h2[-1] * _P2 + letters[k])
                p1.append(p1[-1] * _P1)
                p2.append(p2[-1] * _P2)
            pieces = [
                [self._find(h1[j] - h1[i] * p1[j - i], h2[j] - h2[i] * p2[j - i]) for j in range(i + 1, min(n, i + self.longest) + 1)] for i in range(n)
            ]
        weights = [[self.weights[x] for x in row] for row in pieces]
        alpha = [np.zeros(size)]
        for j in range(1, n + 1):
            alpha.append(_log_sum([alpha[i] + weights[i][j - i - 1] for i in range(max(0, j - self.longest), j)]))
        return pieces, weights, alpha

    def _grouped(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """Places and words of one length each, at most ``CELLS`` cells; longer ones one by one."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        order = np.argsort(sizes, kind="stable")
        edges = np.flatnonzero(np.diff(sizes[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            length = int(sizes[order[a]])
            step = 1 if length > LONGEST else max(1, CELLS // ((length + 1) * self.longest))
            for i in range(a, b, step):
                at = order[i : min(b, i + step)]
                yield at, [words[k] for k in at.tolist()]

    def scores(self, words: list[bytes]) -> np.ndarray:
        """Natural-log probability of each word."""
        out = np.zeros(len(words))
        for at, group in self._grouped(words):
            out[at] = self.score(group[0]) if len(group[0]) > LONGEST else self._solve(group)[2][-1]
        return out

    def expect_all(self, words: list[bytes], times: np.ndarray, into: np.ndarray) -> None:
        """Add the expected uses of each piece in the words, each word ``times`` as often."""
        for at, group in self._grouped(words):
            if len(group[0]) > LONGEST:
                once = np.zeros(len(into))
                self.expect(group[0], once)
                into += once * times[at[0]]
                continue
            pieces, weights, alpha = self._solve(group)
            n, total = len(pieces), alpha[-1]
            beta: list = [None] * n + [np.zeros(len(group))]
            for i in range(n - 1, -1, -1):
                beta[i] = _log_sum([w + beta[i + k + 1] for k, w in enumerate(weights[i])])
            for i in range(n):
                used = np.concatenate(pieces[i])
                share = np.concatenate([np.exp(alpha[i] + w + beta[i + k + 1] - total) * times[at] for k, w in enumerate(weights[i])])
                there = used >= 0
                into += np.bincount(used[there], weights=share[there], minlength=len(into))

    def forward(self, text: bytes, edges: list[tuple[int, int, int, float]] | None = None) -> list[float]:
        """Log probability of each prefix over all its segmentations; the pieces in use go to ``edges``."""
        steps, n, log1p, exp, none = self.steps, len(text), math.log1p, math.exp, -math.inf
        alpha = [0.0] + [none] * n
        for i in range(n):
            at = alpha[i]
            if at == none:
                continue
            for j in range(i + 1, n + 1):
                step = steps.get(text[i:j])
                if step is None:
                    break
                piece, weight, more = step
                if piece >= 0:
                    value, known = at + weight, alpha[j]
                    if value > known:
                        alpha[j] = value + log1p(exp(known - value))
                    else:
                        alpha[j] = known + log1p(exp(value - known))
                    if edges is not None:
                        edges.append((i, j, piece, weight))
                if not more:
                    break
        return alpha

    def score(self, word: bytes) -> float:
        """Natural-log probability of a word."""
        return self.forward(b" " + word)[-1]

    def expect(self, word: bytes, into: np.ndarray | list[float]) -> None:
        """Add the expected uses of each piece in the word, by forward and backward sums."""
        edges: list[tuple[int, int, int, float]] = []
        alpha = self.forward(b" " + word, edges)
        exp, log1p, none, total = math.exp, math.log1p, -math.inf, alpha[-1]
        beta = [none] * len(alpha)
        beta[-1] = 0.0
        for i, j, piece, weight in reversed(edges):
            value = weight + beta[j]
            if value > none:
                into[piece] += exp(alpha[i] + value - total)
                known = beta[i]
                if value > known:
                    beta[i] = value + log1p(exp(known - value))
                else:
                    beta[i] = known + log1p(exp(value - known))


def _log_sum(terms: list[np.ndarray]) -> np.ndarray:
    """Logarithm of the sum of the terms' exponentials; -inf of nothing."""
    most = np.maximum.reduce(terms)
    floor = np.where(np.isfinite(most), most, 0.0)
    with np.errstate(divide="ignore"):
        return floor + np.log(sum(np.exp(t - floor) for t in terms))


COUNTED = "word binary, train long, seen long"


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, train, seen): counts in training documents and in all (text, held_out)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, other, size = Counter(), Counter(), 0

        def flush():
            words = list(train.keys() | other.keys())
            a = [train[w] for w in words]
            b = [x + other[w] for x, w in zip(a, words, strict=True)]
            train.clear()
            other.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["word", "train", "seen"])

        for batch in batches:
            for text, held in zip(batch.column(0).cast(pa.binary()), batch.column(1), strict=True):
                raw = (text.as_py() or b"").lower()
                (other if held.as_py() else train).update(raw.split())
                size += len(raw)
                if len(train) + len(other) > FLUSH or size > FLUSH_BYTES:
                    yield flush()
                    size = 0
        yield flush()

    rows = docs.select("text", "held_out").mapInArrow(lean(run), COUNTED)
    return rows.groupBy("word").agg(F.sum("train").alias("train"), F.sum("seen").alias("seen"))


def gathered(batches: Iterator[pa.RecordBatch], rows: int = SIDE_BY_SIDE) -> Iterator[pa.RecordBatch]:
    """Batches put together to ``rows`` rows at least, so that many words of a length are solved at once."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if size:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def fit(words: DataFrame, vocab: str, passes: int = PASSES) -> tuple[list[bytes], list[float]]:
    """Pieces and natural-log weights, from (word, train).

    What comes to the driver is one number for each piece of the vocabulary.
    """
    pieces, prior = vocabulary(vocab)
    weights = [math.log(p) for p in prior]
    used = words.filter("train > 0").select("word", "train")
    for _ in range(passes):
        shared = words.sparkSession.sparkContext.broadcast((pieces, weights))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice, into = Lattice(*shared.value), np.zeros(len(shared.value[0]))
            for batch in gathered(batches):
                lattice.expect_all(batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(float), into)
            at = np.flatnonzero(into)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(into[at])], names=["piece", "uses"])

        sums = used.mapInArrow(lean(run), "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
        uses = np.zeros(len(pieces))
        for row in sums:
            uses[row["piece"]] = row["uses"]
        posterior = uses + PRIOR * np.array(prior)
        weights = np.log(posterior / posterior.sum()).tolist()
        shared.unpersist()
    return pieces, weights


PARTS = "id long, doc_id long, held_out boolean, word long, times int, tokens long, known long, base double, score double, edge double"
_PART_TYPES = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
SOLVED = "word long, seen long, w_known int, w_base double, w_score double, w_edge double"
DOCUMENTS = 256


def _keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def score_documents(docs: DataFrame, vocab: str, passes: int = PASSES) -> DataFrame:
    """Scores of ``docs`` (doc_id, text, held_out); log10."""
    spark = docs.sparkSession
    counts, counts_at = materialize(word_counts(docs), "words")
    ends = docs.filter("not held_out").count()
    sums = counts.agg(F.sum("train").alias("n"), F.count(F.when(F.col("train") > 0, 1)).alias("v"), F.count(F.when(F.col("train") == 1, 1)).alias("once"), F.sum("seen").alias("s")).first()
    n, v = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    shared = spark.sparkContext.broadcast(fit(counts, vocab, passes))
    unit = n + 0.5 * (v + 1)
    stop = (ends + 0.5) / (n + 1)
    novel = min(0.5, (sums["once"] + 1) / (n - ends + 2)) if n > ends else 1.0

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        for batch in gathered(batches):
            c, words = batch.column(1).to_numpy(), batch.column(0).to_pylist()
            pieced = lattice.scores(words)
            with np.errstate(divide="ignore"):
                whole = np.log((1 - novel) * c / max(1, n - ends))
            ten = math.log(10)
            edge = (np.logaddexp(whole, pieced + math.log(novel)) + math.log(1 - stop)) / ten
            made = [pa.array(_keys(words)), batch.column(2), pa.array((c > 0).astype(np.int32)), pa.array(np.log10((c + 0.5) / unit)), pa.array((pieced + math.log(1 - stop)) / ten), pa.array(edge)]
            yield pa.RecordBatch.from_arrays(made, names=[x.split()[0] for x in SOLVED.split(", ")])

    solved, _ = materialize(counts.mapInArrow(lean(solve), SOLVED), "scores")
    discard(spark, counts_at)
    least = (sums["s"] or 0) // HEAVY + 1
    # At most HEAVY rows of five numbers.
    heavy = solved.filter(F.col("seen") >= least).select("word", "w_known", "w_base", "w_score", "w_edge").orderBy("word").toArrow()
    known_to_all = spark.sparkContext.broadcast([heavy.column(i).to_numpy() for i in range(5)])
    light = solved.filter(F.col("seen") < least).drop("seen")
    ten = math.log(10)
    own = (int(ends > 0), math.log10((ends + 0.5) / unit), math.log(stop) / ten, math.log(stop) / ten)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, *values = known_to_all.value
        number = TaskContext.get().partitionId() << 40
        fields = [x.split()[0] for x in PARTS.split(", ")]
        for batch in batches:
            for start in range(0, len(batch), DOCUMENTS):
                part = batch.slice(start, DOCUMENTS)
                size, flat, times, each, tokens = len(part), [], [], [], []
                for text in part.column(1).cast(pa.binary()):
                    found = Counter((text.as_py() or b"").lower().split())
                    flat.extend(found)
                    times.extend(found.values())
                    each.append(len(found))
                    tokens.append(sum(found.values()) + 1)
                owner, often, key = np.repeat(np.arange(size), each), np.array(times, dtype=np.int64), _keys(flat)
                at = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
                hit = keys[at] == key if len(keys) else np.zeros(len(key), dtype=bool)
                there, of = at[hit], owner[hit]
                sums_ = [np.bincount(of, weights=often[hit] * v[there], minlength=size) + o for v, o in zip(values, own, strict=True)]
                light_ = np.flatnonzero(~hit)
                ids = number + np.arange(size)
                number += size
                row = np.concatenate([owner[light_], np.arange(size)])
                none = np.zeros(len(light_))
                columns = [
                    ids[row], part.column(0).take(pa.array(row)), part.column(2).take(pa.array(row)),
                    np.concatenate([key[light_], -ids - 1]),  # a document's own row is used no times
                    np.concatenate([often[light_], np.zeros(size, np.int64)]).astype(np.int32), np.concatenate([none, tokens]).astype(np.int64),
                    np.concatenate([none, sums_[0]]).astype(np.int64), *(np.concatenate([none, x]) for x in sums_[1:]),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) if isinstance(c, np.ndarray) else c for c, t in zip(columns, _PART_TYPES, strict=True)], names=fields)

    rows = docs.select("doc_id", "text", "held_out").mapInArrow(lean(parts), PARTS).join(light, "word", "left")
    value = lambda c: F.col("times") * F.coalesce(F.col(c), F.lit(0))
    return rows.groupBy("id", "doc_id", "held_out").agg(
        F.sum("tokens").alias("n_tokens"),
        F.sum(F.col("known") + value("w_known")).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        F.sum(F.col("base") + value("w_base")).alias("base_score"),
        F.sum(F.col("score") + value("w_score")).alias("score"),
        F.sum(F.col("edge") + value("w_edge")).alias("word_edge_score"),
    ).drop("id")


def op9_lattice_lm(spark: SparkSession, sf_dir: str, vocab: str | None = None) -> DataFrame:
    """Base and lattice scores of all documents; the model learns from four fifths."""
    import public_tokenizers

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held_out"))
    return score_documents(docs, vocab or public_tokenizers.path("piece_bpe_32k.model"))
