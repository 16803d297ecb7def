"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Inputs for each word are of two kinds: of the word (how much likelier it is in
toxic documents, and a learned embedding) and of its characters (the same for its
character n-grams, greatest and mean).  Two gated recurrent layers, one in each
direction, run over windows of ``WINDOW`` words; attention pools a window's
states and a logistic unit scores it.  All overlapping windows of a text are
scored, and the text's score is the greatest.  All of it is numpy, trained here by
back-propagation through time.

The model is fitted on a bounded sample of labelled rows, ``sample`` of each
class at most, those with the least hash of their id; every document is scored.
Each class weighs as much as all its training rows, sampled or not, so that the
decisions don't depend on the size of the input.  One task fits it: it reads the
sample text by text, keeps words as numbers, and hands the driver the finished
model, a few megabytes.

Edge cases: a text without words (null, empty, junk) gets the toxic share of all
training rows; labels without a document or without a class are left out; of
training rows with one doc_id the text that sorts first is learnt from; with
one class only, or no labels, the score is that class's smoothed share; repeated
rows and rows without a doc_id are scored each; an empty table gives an empty
result; further columns are ignored, but score_documents passes on all that it
is given, whatever their names.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, lean, materialize, table

SAMPLE = 3000
WINDOW, STRIDE = 64, 48
HIDDEN, EMBEDDED, ATTENTION = 8, 4, 8
GRAM_BITS, WORD_CELLS = 18, 1 << 12
GRAMS, LONGEST = (3, 4, 5, 6), 60
EPOCHS, BATCH, RATE = 4, 256, 0.02
LEAST_STEPS, FOLDS = 240, 3
WORDS = re.compile(r"[^\W\d_]+")
CACHED = 80_000


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; longer ones as overlapping words of ``LONGEST`` letters, so that no n-gram is lost."""
    found = WORDS.findall(text.lower()) if text else []
    if max(map(len, found), default=0) <= LONGEST:
        return found
    step = LONGEST - max(GRAMS)
    return [w[i : i + LONGEST] for w in found for i in range(0, max(1, len(w) - max(GRAMS)), step)]


def gram_cells(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the n-grams, in bytes, of words with their ends marked; and where each word's begin."""
    marked = [f"^{w}$".encode() for w in words]
    sizes = np.array([len(m) for m in marked])
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(marked) + bytes(max(GRAMS)), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    total = int(sizes.sum())
    left = np.repeat(starts + sizes, sizes) - np.arange(total)
    cells, fits = np.empty((total, len(GRAMS)), dtype=np.int64), np.empty((total, len(GRAMS)), dtype=bool)
    value, n = np.zeros(total, dtype=np.uint64), 0
    for k, size in enumerate(GRAMS):
        while n < size:
            value = value * np.uint64(0x9E3779B97F4A7C15) + data[n : n + total]
            n += 1
        mixed = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        cells[:, k], fits[:, k] = (mixed >> np.uint64(64 - GRAM_BITS)).astype(np.int64), left >= size
    each = np.add.reduceat(fits.sum(axis=1), starts)
    return cells[fits], np.cumsum(each) - each


class Coded:
    """Texts as numbers of their words, and the n-grams' cells of each word."""

    def __init__(self, texts: Iterable[str | None]):
        numbers: dict[str, int] = {}
        self.texts = []
        for text in texts:
            ws = words_of(text)
            self.texts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in ws), np.int32, len(ws)))
        self.words = list(numbers)
        cells, starts, filled = [], [], 0
        for i in range(0, len(self.words), 20_000):  # a bounded number of words at a time
            some, at = gram_cells(self.words[i : i + 20_000])
            cells.append(some.astype(np.int32))
            starts.append(at + filled)
            filled += len(some)
        self.cells = np.concatenate([np.zeros(0, np.int32), *cells])
        self.starts = np.concatenate([np.zeros(0, np.int64), *starts])
        self.ends = np.append(self.starts[1:], filled)

    def cells_of(self, words: np.ndarray) -> np.ndarray:
        """The cells of some words in a row."""
        starts, sizes = self.starts[words], self.ends[words] - self.starts[words]
        before = np.cumsum(sizes) - sizes
        return self.cells[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


class Inputs:
    """Rows of inputs for words; the parts that are counted, not learned by gradient."""

    def __init__(self, word_odds: dict[str, float], gram_odds: np.ndarray):
        self.word_odds, self.gram_odds = word_odds, gram_odds

    @classmethod
    def counted(cls, coded: Coded, texts: list[int], toxic: np.ndarray) -> tuple[Inputs, np.ndarray]:
        """Log odds of words and n-grams by the documents of ``texts`` that have them; and the rows of all coded words."""
        grams, words = np.zeros((2, 1 << GRAM_BITS), np.int32), np.zeros((2, len(coded.words)), np.int32)
        for i in texts:
            distinct = np.unique(coded.texts[i])
            words[toxic[i], distinct] += 1
            grams[toxic[i], np.unique(coded.cells_of(distinct))] += 1
        n = np.bincount(toxic[texts], minlength=2)
        share = (n[1] + 0.5) / (n.sum() + 1)

        def odds(clean, bad):
            """Smoothed towards no evidence; few occurrences tell little."""
            return np.log((bad + 4 * share) / (clean + 4 * (1 - share))) - np.log(share / (1 - share))

        known = np.flatnonzero(words[1] >= 2)
        each = np.zeros(len(coded.words))
        each[known] = odds(words[0][known], words[1][known])
        made = cls({coded.words[i]: float(each[i]) for i in known.tolist()}, odds(grams[0], grams[1]).astype(np.float32))
        return made, made.combined(each, coded.cells, coded.starts)

    def combined(self, word_odds: np.ndarray, cells: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The word's odds, and the greatest and mean of its n-grams'."""
        out = np.zeros((len(word_odds), 3), dtype=np.float32)
        if len(word_odds):
            values = self.gram_odds[cells]
            out[:, 0] = word_odds
            out[:, 1] = np.maximum.reduceat(values, starts)
            out[:, 2] = np.add.reduceat(values, starts) / np.diff(np.append(starts, len(values)))
        return out / 4

    def rows(self, words: list[str]) -> np.ndarray:
        """The inputs of any words."""
        cells, starts = gram_cells(words)
        return self.combined(np.array([self.word_odds.get(w, 0.0) for w in words]), cells, starts)


def cell(word: str) -> int:
    """The embedding's cell of a word."""
    return xxhash.xxh3_64_intdigest(word.encode()) % WORD_CELLS


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Network:
    """The network; arrays are (windows, steps, ...), ``mask`` marks the words."""

    def __init__(self, seed: int = 7):
        rng, h, d = np.random.default_rng(seed), HIDDEN, 3 + EMBEDDED
        glorot = lambda *s: (rng.standard_normal(s) * np.sqrt(1 / s[0])).astype(np.float32)
        self.p = {"embed": (rng.standard_normal((WORD_CELLS, EMBEDDED)) * 0.02).astype(np.float32)}
        for way in "fb":
            self.p |= {f"w{way}": glorot(d, 3 * h), f"u{way}": glorot(h, 3 * h), f"b{way}": np.zeros(3 * h, np.float32)}
        self.p |= {"wa": glorot(2 * h, ATTENTION), "ba": np.zeros(ATTENTION, np.float32), "va": glorot(ATTENTION), "wo": glorot(2 * h), "bo": np.zeros(1, np.float32)}

    def _run(self, way: str, projected: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
        """States of one direction; ``projected``: steps first, (steps, windows, 3 * HIDDEN)."""
        steps, n, _ = projected.shape
        h, u = np.zeros((n, HIDDEN), np.float32), self.p[f"u{way}"]
        out = np.empty((steps, n, HIDDEN), np.float32)
        k = HIDDEN
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            before, recurrent, x = h, h @ u, projected[t]
            gates = _sigmoid(x[:, : 2 * k] + recurrent[:, : 2 * k])
            z, r = gates[:, :k], gates[:, k:]
            c = np.tanh(x[:, 2 * k :] + r * recurrent[:, 2 * k :])
            h = before + z * (c - before)
            if mask is not None:
                h = np.where(mask[:, t, None], h, before)
            out[t] = h
            if keep is not None:
                keep.append((t, before, z, r, c, recurrent[:, 2 * k :]))
        return out

    def project(self, rows: np.ndarray) -> np.ndarray:
        """Both directions' input parts of words, (words, 6 * HIDDEN)."""
        return np.concatenate([rows @ self.p["wf"] + self.p["bf"], rows @ self.p["wb"] + self.p["bb"]], axis=1).astype(np.float32)

    def inputs(self, counted: np.ndarray, cells: np.ndarray) -> np.ndarray:
        return np.concatenate([counted, self.p["embed"][cells]], axis=-1).astype(np.float32)

    def logits(self, projected: np.ndarray, mask: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
        """Scores of windows from (steps, windows, 6 * HIDDEN)."""
        p, k = self.p, 3 * HIDDEN
        tape_f, tape_b = ([], []) if keep is not None else (None, None)
        states = np.concatenate([self._run("f", projected[..., :k], mask, tape_f), self._run("b", projected[..., k:], mask, tape_b)], axis=2)
        hidden = np.tanh(states @ p["wa"] + p["ba"])
        weight = hidden @ p["va"]
        if mask is not None:
            weight = np.where(mask.T, weight, -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        if mask is not None:
            weight = weight * mask.T
        weight = weight / np.maximum(weight.sum(axis=0), 1e-9)
        pooled = (weight[..., None] * states).sum(axis=0)
        if keep is not None:
            keep |= {"f": tape_f, "b": tape_b, "states": states, "hidden": hidden, "weight": weight, "pooled": pooled}
        return pooled @ p["wo"] + p["bo"][0]

    def gradients(self, counted: np.ndarray, cells: np.ndarray, mask: np.ndarray, target: np.ndarray, importance: np.ndarray) -> dict:
        """Of the weighted cross entropy, by back-propagation through time."""
        p, h, tape = self.p, HIDDEN, {}
        rows = self.inputs(counted, cells)
        projected = self.project(rows.reshape(-1, rows.shape[-1])).reshape(*cells.shape, 6 * h).transpose(1, 0, 2)
        logit = self.logits(projected, mask, tape)
        d_logit = (_sigmoid(logit) - target) * importance / len(target)
        g = {"wo": tape["pooled"].T @ d_logit, "bo": np.array([d_logit.sum()])}
        d_pooled = d_logit[:, None] * p["wo"]
        states, weight, hidden = tape["states"], tape["weight"], tape["hidden"]
        d_states = weight[..., None] * d_pooled
        along = (states * d_pooled).sum(axis=2)
        d_weight = weight * (along - (weight * along).sum(axis=0))
        g["va"] = np.tensordot(d_weight, hidden, axes=([0, 1], [0, 1]))
        d_hidden = d_weight[..., None] * p["va"] * (1 - hidden**2)
        g["wa"] = np.tensordot(states, d_hidden, axes=([0, 1], [0, 1]))
        g["ba"] = d_hidden.sum(axis=(0, 1))
        d_states = d_states + d_hidden @ p["wa"].T
        d_rows = np.zeros_like(rows)
        for way, part in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            u, d_next = p[f"u{way}"], np.zeros((len(target), h), np.float32)
            g[f"u{way}"], d_projected = np.zeros_like(u), np.zeros((*cells.shape, 3 * h), np.float32)
            for t, before, z, r, c, recurrent in reversed(tape[way]):
                m = mask[:, t, None]
                d = d_next + d_states[t, :, part]
                d_h, d_pass = np.where(m, d, 0), np.where(m, 0, d)
                d_c = d_h * z * (1 - c**2)
                d_z = d_h * (c - before) * z * (1 - z)
                d_r = d_c * recurrent * r * (1 - r)
                d_projected[:, t] = np.concatenate([d_z, d_r, d_c], axis=1)
                d_rec = np.concatenate([d_z, d_r, d_c * r], axis=1)
                g[f"u{way}"] += before.T @ d_rec
                d_next = d_pass + d_h * (1 - z) + d_rec @ u.T
            flat, at = d_projected.reshape(-1, 3 * h), rows.reshape(-1, rows.shape[-1])
            g[f"w{way}"], g[f"b{way}"] = at.T @ flat, flat.sum(axis=0)
            d_rows += d_projected @ p[f"w{way}"].T
        g["embed"] = np.zeros_like(p["embed"])
        np.add.at(g["embed"], cells[mask], d_rows[mask][:, 3:])
        return g

    def train(self, counted, cells, mask, target, importance, epochs: int = EPOCHS, rate: float = RATE, seed: int = 11) -> None:
        """Adam on shuffled batches, with a falling rate."""
        rng, first, second, step = np.random.default_rng(seed), {}, {}, 0
        epochs = max(epochs, -(-LEAST_STEPS * BATCH // max(BATCH, len(target))))
        total = epochs * -(-len(target) // BATCH)
        for _ in range(epochs):
            order = rng.permutation(len(target))
            for i in range(0, len(order), BATCH):
                at = order[i : i + BATCH]
                g, step = self.gradients(counted[at], cells[at], mask[at], target[at], importance[at]), step + 1
                now = rate * (1 - 0.9 * step / total)
                for k, v in g.items():
                    v = np.clip(v, -1, 1)
                    first[k] = 0.9 * first.get(k, 0) + 0.1 * v
                    second[k] = 0.99 * second.get(k, 0) + 0.01 * v * v
                    move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
                    self.p[k] = (self.p[k] - now * move).astype(np.float32)


def window_starts(n: int) -> list[int]:
    """Starts of the overlapping windows over ``n`` words; the last one reaches the end."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


class Model:
    """Inputs, network and decision of a fitted classifier."""

    def __init__(self, inputs: Inputs | None, network: Network | None, share: float):
        self.inputs, self.network, self.share = inputs, network, share
        self.ids: dict[str, int] = {}
        self.projected = np.zeros((0, 6 * HIDDEN), np.float32)

    def _ids(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Numbers of words, with their input projections in ``projected``."""
        new = {w for ws in texts for w in ws if w not in self.ids}
        if len(self.ids) + len(new) > CACHED:
            self.ids, self.projected = {}, self.projected[:0]
            new = {w for ws in texts for w in ws}
        if new:
            words = sorted(new)
            rows = self.network.inputs(self.inputs.rows(words), np.array([cell(w) for w in words]))
            start = len(self.projected)
            self.projected = np.concatenate([self.projected, self.network.project(rows)])
            self.ids.update(zip(words, range(start, start + len(words)), strict=True))
        ids = self.ids
        return [np.array([ids[w] for w in ws], dtype=np.int64) for ws in texts]

    def scores(self, texts: list[str | None], chunk: int = 1024) -> np.ndarray:
        """The greatest window score of each text."""
        if self.network is None:
            return np.full(len(texts), self.share)
        out, i = np.zeros(len(texts)), 0
        while i < len(texts):  # a bounded number of words at a time
            group, size = [], 0
            while i + len(group) < len(texts) and size < 400_000:
                group.append(words_of(texts[i + len(group)]))
                size += len(group[-1])
            self._some(group, out[i : i + len(group)], chunk)
            i += len(group)
        return out

    def _some(self, texts: list[list[str]], out: np.ndarray, chunk: int) -> None:
        ids = self._ids(texts)
        flat = np.concatenate([*ids, np.zeros(WINDOW, dtype=np.int64)])
        if not len(self.projected):
            self.projected = np.zeros((1, 6 * HIDDEN), np.float32)
        at, owner, size, begin = [], [], [], 0
        for d, x in enumerate(ids):
            starts = window_starts(len(x))
            at.extend(begin + s for s in starts)
            owner.extend([d] * len(starts))
            size.extend([min(WINDOW, len(x))] * len(starts))
            begin += len(x)
        at, owner, size = np.array(at), np.array(owner), np.array(size)
        order = np.argsort(size, kind="stable")
        for j in range(0, len(order), chunk):
            rows = order[j : j + chunk]
            steps = max(1, int(size[rows].max()))
            index = at[rows][None, :] + np.arange(steps)[:, None]
            mask = None if size[rows[0]] == steps else np.arange(steps) < size[rows][:, None]
            score = _sigmoid(self.network.logits(self.projected[flat[index]], mask).astype(np.float64))
            np.maximum.at(out, owner[rows], score)
        out[[not len(x) for x in ids]] = self.share


def fit(texts: Iterable[str | None] | Coded, toxic: list[int], counts: list[int] | None = None) -> Model:
    """A model from labelled texts, a sample of ``counts`` clean and toxic ones (default: all of them)."""
    labels = np.array(toxic, dtype=np.int64)
    taken = np.bincount(labels, minlength=2)
    stands_for = np.array(counts if counts is not None else taken)
    share = float((stands_for[1] + 1) / (stands_for.sum() + 2))
    if not len(labels) or labels.min() == labels.max():
        return Model(None, None, share)
    coded = texts if isinstance(texts, Coded) else Coded(texts)
    inputs, _ = Inputs.counted(coded, list(range(len(labels))), labels)
    word_cells = np.array([cell(w) for w in coded.words], dtype=np.int64)
    # A text's own label isn't in the counts that it is trained with: others' folds give them.
    fold = np.zeros(len(labels), dtype=np.int64)
    for c in (0, 1):  # each fold with its part of either class
        fold[labels == c] = np.arange((labels == c).sum()) % FOLDS
    chosen: list[tuple[np.ndarray, int, np.ndarray]] = []
    for k in range(FOLDS):
        _, rows = Inputs.counted(coded, np.flatnonzero(fold != k).tolist(), labels)
        evidence = rows[:, 0] + rows[:, 1]
        for n in np.flatnonzero(fold == k).tolist():
            ws, label = coded.texts[n], int(labels[n])
            starts = np.array(window_starts(len(ws)))
            # Of toxic texts the window with the most evidence; of clean ones two such, and another.
            part = np.append(evidence[ws], np.full(WINDOW, -9.0))
            heat = np.sort(part[starts[:, None] + np.arange(WINDOW)], axis=1)[:, -3:]
            order = np.argsort(-np.where(heat > -9, heat, 0).sum(axis=1), kind="stable").tolist()
            for i in order[:1] if label else sorted({*order[:2], order[n % len(order)]}):
                part = ws[starts[i] : starts[i] + WINDOW]
                chosen.append((part, label, rows[part]))
    counted = np.zeros((len(chosen), WINDOW, 3), np.float32)
    cells, mask = np.zeros((len(chosen), WINDOW), dtype=np.int64), np.zeros((len(chosen), WINDOW), dtype=bool)
    for i, (ws, _, values) in enumerate(chosen):
        counted[i, : len(ws)], cells[i, : len(ws)], mask[i, : len(ws)] = values, word_cells[ws], True
    target = np.array([label for _, label, _ in chosen], dtype=np.float32)
    # Toxic windows for a clean one, as in all training rows; the loss evens out the root of that, as without sampling.
    sampled = stands_for / taken
    kept = sampled[1] / sampled[0]
    ratio = (target == 0).sum() / max(1, (target == 1).sum()) / kept
    importance = np.where(target == 1, kept * ratio**0.5, 1.0).astype(np.float32)
    network = Network()
    network.train(counted, cells, mask, target, importance)
    return Model(inputs, network, share)


def _known(labels: DataFrame) -> DataFrame:
    """Classes of the four fifths of labelled ids that training may see."""
    mod = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.filter(mod != 0)


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text and class of at most ``sample`` labelled documents of each class, in order."""
    known, ids = _known(labels), None
    for c in (0, 1):
        some = known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        ids = some if ids is None else ids.union(some)
    # At most 2 * sample ids, so the broadcast is bounded.
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return rows.select("doc_id", "text", "toxic")


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> bytes:
    """A model of ``training_rows``, fitted by one task and packed; see ``score_documents``."""
    counts = training_counts(docs, labels)
    found, at = materialize(training_rows(docs, labels, sample), "training")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: list[int] = []

        def texts():
            for batch in batches:
                for text, label in zip(batch.column(0), batch.column(1), strict=True):
                    toxic.append(label.as_py())
                    yield text.as_py()

        coded = Coded(texts())
        model = fit(coded, toxic, counts)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((model.inputs, model.network, model.share))], pa.binary())], names=["model"])

    in_order = found.orderBy("doc_id").select("text", "toxic").coalesce(1)
    packed = in_order.mapInArrow(lean(run), "model binary").first()
    discard(docs.sparkSession, at)
    if packed is None:  # no rows, no task
        model = fit([], [], counts)
        return pickle.dumps((model.inputs, model.network, model.share))
    return packed["model"]


def training_counts(docs: DataFrame, labels: DataFrame) -> list[int]:
    """Numbers of all clean and of all toxic documents to learn from, of which ``training_rows`` takes a sample."""
    rows = _known(labels).join(docs.select("doc_id").distinct(), "doc_id").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    found = {r["toxic"]: r["n"] for r in rows}
    return [found.get(c, 0) for c in (0, 1)]


def score_documents(docs: DataFrame, packed: bytes) -> DataFrame:
    """``docs`` with a last column, the score of each text by a model that ``fitted`` gave."""
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    text = docs.columns.index("text")
    size = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = Model(*pickle.loads(shared.value))
        for batch in batches:
            scores = np.concatenate([np.zeros(0), *(local.scores(batch.column(text).slice(i, 512).to_pylist()) for i in range(0, len(batch), 512))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:size], pa.array(scores)], names=[*batch.schema.names, "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lean(run), f"{schema}, score double")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; the model learns from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = fitted(docs, labels)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    scored = score_documents(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
