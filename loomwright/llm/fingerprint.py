"""Document fingerprints by locally consistent parsing.

A text is parsed level by level.  Runs of one symbol become one symbol.  Then
deterministic coin tossing: a symbol's label is the lowest bit in which it
differs from the symbol before, with that bit's value; four rounds of it leave
labels below six, of which neighbours differ, and phrases begin at the labels'
local maxima.  A phrase's name is a hash of its symbols, and the names are the
next level's symbols.  Where a phrase begins depends on a few neighbours only, so
equal substrings have equal phrases inside, whatever their offset.

The fingerprint is a one-permutation sketch of the phrase names of levels 2 to 4 and
of the pairs of neighbouring names of level 1, for texts of all lengths alike;
likeness is the share of equal cells.

Edge cases: null and empty texts have the fingerprint of nothing, like each
other and unlike any other; rows of one doc_id follow each other by text; a null
doc_id comes last; with one row the next document is itself; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .common import lean, ordered_key, table
from .near_dedup import mix, probes

CELLS = 64
LEVELS = 4
CHUNK = 300_000
BLOCKS = 3
_C = np.uint64(0x9E3779B97F4A7C15)
_LOWEST = np.array([0] + [(x & -x).bit_length() - 1 for x in range(1, 256)], dtype=np.uint8)


def _labels(names: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Four rounds of deterministic coin tossing; ``start`` marks each text's first symbol."""
    before = np.empty_like(names)
    before[1:] = names[:-1]
    before[start] = names[start] ^ np.uint64(1)
    differ = names ^ before
    place = np.frexp((differ & (~differ + np.uint64(1))).astype(np.float64))[1] - 1
    label = (2 * place + ((names >> place.astype(np.uint64)) & np.uint64(1)).astype(np.int64)).astype(np.uint8)
    for _ in range(3):
        before = np.empty_like(label)
        before[1:] = label[:-1]
        before[start] = label[start] ^ 1
        place = _LOWEST[label ^ before]
        label = 2 * place + ((label >> place) & 1)
    return label


def parse_level(names: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of one level: their names and texts, from symbols and their texts."""
    new = np.append(True, (names[1:] != names[:-1]) | (doc[1:] != doc[:-1]))
    heads = np.flatnonzero(new)
    runs = np.diff(np.append(heads, len(names))).astype(np.uint64)
    names, doc = np.where(runs > 1, mix(names[heads] ^ runs * _C), names[heads]), doc[heads]
    start = np.append(True, doc[1:] != doc[:-1])
    label = _labels(names, start).astype(np.int8)
    left, right = np.full(len(label), -1, np.int8), np.full(len(label), -1, np.int8)
    left[1:], right[:-1] = label[:-1], label[1:]
    right[np.append(start[1:], True)] = -1
    cut = (label > left) & (label > right) & ~np.append(False, start[:-1])
    cut |= start
    heads = np.flatnonzero(cut)
    inside = np.arange(len(names)) - np.repeat(heads, np.diff(np.append(heads, len(names))))
    return mix(np.add.reduceat(mix(names + (inside.astype(np.uint64) + np.uint64(1)) * _C), heads)), doc[heads]


def sketches(texts: list[str]) -> np.ndarray:
    """A row of ``CELLS`` 16-bit numbers for each text; 0 throughout for empty ones."""
    out = np.zeros((len(texts), CELLS), dtype=np.uint64)
    points = [np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) for t in texts]
    sizes = np.array([len(p) for p in points])
    doc = np.repeat(np.arange(len(texts)), sizes)
    if not len(doc):
        return out.astype(np.uint16)
    names = mix(np.concatenate(points).astype(np.uint64) * _C + np.uint64(1))
    kept, owners = [], []
    for level in range(1, LEVELS + 1):
        names, doc = parse_level(names, doc)
        if level == 1:
            # One name alone, some four characters, is in most texts; two that follow each other are in few.
            pair = doc[1:] == doc[:-1]
            kept.append(mix(mix(names[:-1][pair] + _C) + names[1:][pair]))
            owners.append(doc[1:][pair])
            continue
        kept.append(mix(names + np.uint64(level)))
        owners.append(doc)
    value, owner = np.concatenate(kept), np.concatenate(owners)
    cell = ((value >> np.uint64(32)) * np.uint64(CELLS) >> np.uint64(32)).astype(np.int64)
    key = owner * CELLS + cell
    order = np.lexsort((value, key))
    key, value = key[order], value[order]
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    full = np.zeros(out.shape, dtype=bool)
    out.ravel()[key[heads]], full.ravel()[key[heads]] = value[heads], True
    rows, cells = np.nonzero(~full & full.any(axis=1)[:, None])
    for try_ in probes(CELLS, 1024):
        if not len(rows):
            break
        at = try_[cells]
        hit = full[rows, at]
        out[rows[hit], cells[hit]] = out[rows[hit], at[hit]]
        rows, cells = rows[~hit], cells[~hit]
    low = (mix(out) & np.uint64(0xFFFF)).astype(np.uint16)
    low[~full.any(axis=1)] = 0
    return low


def fingerprints(texts: list[str]) -> list[bytes]:
    """Fingerprints of texts, some at a time so that memory stays bounded."""
    out: list[bytes] = []
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > CHUNK:
            out.extend(x.tobytes() for x in sketches(group))
            group, size = [], 0
        group.append(t)
        size += len(t)
    out.extend(x.tobytes() for x in sketches(group))
    return out


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal cells of two fingerprints."""
    return float((np.frombuffer(a, dtype=np.uint16) == np.frombuffer(b, dtype=np.uint16)).mean())


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())


def in_order_with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in blocks of ids, each followed by the next block's first row.

    Adds ``block`` and ``ahead`` (true for such a following row).  A block is a
    partition, of which there are ``BLOCKS`` for each of the input's; its rows are
    sorted by ahead, doc_id and text, and the last block is followed by the first.
    Only the blocks' limits, a few numbers for each, come to the driver.
    """
    parts = BLOCKS * max(1, docs.rdd.getNumPartitions())
    keyed, _ = ordered_key(docs, "__id")
    limits = sorted(set(keyed.stat.approxQuantile("__id", [i / parts for i in range(1, parts)], 1 / (8 * parts)))) if parts > 1 else []
    edges = np.array([int(x) for x in limits], dtype=np.int64)

    @F.pandas_udf(IntegerType())
    def block_of(ids):
        import pandas as pd

        return pd.Series(np.searchsorted(edges, ids.to_numpy(), side="right").astype("int32"))

    keyed = keyed.withColumn("block", block_of("__id"))
    firsts = sorted((r["block"], r["first"]) for r in keyed.groupBy("block").agg(F.min("__id").alias("first")).collect())
    ahead_of = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    ids = np.array(sorted(ahead_of), dtype=np.int64)
    blocks = np.array([ahead_of[i] for i in ids.tolist()], dtype=np.int32)

    @F.pandas_udf(IntegerType())
    def follows(values):
        import pandas as pd

        at = np.minimum(np.searchsorted(ids, values.to_numpy()), len(ids) - 1)
        return pd.Series(np.where(ids[at] == values.to_numpy(), blocks[at], -1).astype("int32"))

    here = F.struct(F.col("block"), F.lit(False).alias("ahead"))
    there = F.struct(F.col("follow").alias("block"), F.lit(True).alias("ahead"))
    placed = keyed.withColumn("follow", follows("__id")) if firsts else keyed.withColumn("follow", F.lit(-1))
    placed = placed.select("doc_id", "text", "__id", F.explode(F.filter(F.array(here, there), lambda x: x["block"] >= 0)).alias("at"))
    placed = placed.select("doc_id", "text", "__id", "at.*")
    return placed.repartitionById(parts, "block").sortWithinPartitions("block", "ahead", "__id", "text")


def compare_with_edit(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text), of their edited texts, and likenesses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (block, ahead, doc_id, text, fingerprint) whose next row isn't known yet

        def result(rows):
            """For rows (doc_id, text, fingerprint, next text, next fingerprint)."""
            edited = [t[: len(t) - len(t) // 4] + nxt[: len(t) // 4] for _, t, _, nxt, _ in rows]
            prints = fingerprints(edited)
            out = [
                (d, len(t), hashlib.sha256(e.encode()).hexdigest(), f.hex(), g.hex(), likeness(f, g), likeness(f, nf))
                for (d, t, f, _, nf), e, g in zip(rows, edited, prints, strict=True)
            ]
            names = [x.split()[0] for x in RESULT.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _TYPES, strict=True)], names=names)

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            prints, done = fingerprints(texts), []
            for doc_id, text, block, ahead, f in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist(), batch.column(3).to_pylist(), prints, strict=True):
                if held is not None and held[0] == block and not held[1]:
                    done.append((held[2], held[3], held[4], text, f))
                held = (block, ahead, doc_id, text, f)
            if done:
                yield result(done)

    return in_order_with_next(docs).select("doc_id", "text", "block", "ahead").mapInArrow(lean(run), RESULT)


def op8_parsing_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return compare_with_edit(table(spark, sf_dir, "documents").select("doc_id", "text"))
