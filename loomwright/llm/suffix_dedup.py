"""Removal of repeated byte strings by sorting sampled suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts earlier.
The suffixes that decide this are sorted as in the difference-cover method, with
a cover chosen by content instead of position:

* Names.  The name of 3m bytes is the triple of the names of its thirds, and so
  on from single bytes; two or three overlapping names name any k bytes.
* Cover.  Of each window of ``length`` bytes one position is sampled, that of the
  least k-byte name in it (the first of equal ones).  Equal windows are sampled
  at the same place in them, which is what a difference cover is for; but it
  takes 2 of length - k + 2 positions where a cover by position takes 2 of 3 (or 8
  of 57), and all of them have to be sorted.
* Sort.  Samples are sorted by name, then by the name of all windows that chose
  them, then by document and position.  Neighbours are compared: a sample whose
  windows read as an earlier one's repeats them all; a name that occurs once
  frees its windows.
* Merge.  What is left are windows of samples with one name and different
  surroundings, near the ends of repeats.  They go through the same again with
  longer names (``NAMES``), at last as long as the window itself, whose sort
  decides the rest.

Names are 64-bit hashes; a decision compares two of them (sample and
surroundings).  No pairs are formed.  Before the sort each task decides what its
own samples decide: those that read as an earlier one of the task are repeated,
wherever else the string occurs.  Where a task sees a name with several
surroundings, its samples are open in any case; they are sorted by name and
surroundings, and two of them go to the name's place to tell the others.  So a
string that very many documents have is a few rows of each task and is spread
over all of them.  What another task's samples would have decided earlier is then
decided by the next, longer names; in the last round a name has one surrounding.

Edge cases: null and empty texts lose nothing; texts shorter than ``length``
neither; rows with one doc_id are ordered by their text; a null doc_id comes
last; an empty table gives an empty result; further columns are kept aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, materialize, ordered_key, table
from .near_dedup import mix

LENGTH = 100
NAMES = (50, 90, 100)
_C = np.uint64(0x9E3779B97F4A7C15)
_BYTE_NAMES = mix(np.arange(1, 257, dtype=np.uint64) * _C)
#: Samples that a task sorts at once; each takes some 200 bytes meanwhile.
BATCH = 250_000


def names(data: np.ndarray, lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """For each k of ``lengths`` the names of all k-byte strings of ``data``."""
    known, m = {1: _BYTE_NAMES[data]}, 1
    while 3 * m <= max(lengths):
        x = known[m]
        known[3 * m] = mix(mix(x[: -2 * m] * _C + x[m:-m]) * _C + x[2 * m :]) if len(x) > 2 * m else x[:0]
        m *= 3
    out = {}
    for k in lengths:
        m = max(x for x in known if x <= k)
        starts = [0, k - m] if k <= 2 * m else [0, m, k - m]
        n = len(data) - k + 1
        value = known[m][:n]
        for s in starts[1:]:
            value = mix(value * _C + known[m][s : s + n])
        out[k] = value
    return out


def first_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of the least one, the first of equals."""
    at, best, have = np.arange(len(values)), values, 1
    def joined(shift):  # noqa: E306
        left, right = best[: len(best) - shift], best[shift:]
        take = left <= right
        return np.where(take, left, right), np.where(take, at[: len(at) - shift], at[shift:])
    while have * 2 <= width:
        best, at = joined(have)
        have *= 2
    if have < width:
        best, at = joined(width - have)
    return at


def samples(data: np.ndarray, spans: list[tuple[int, int]], k: int, length: int) -> tuple[np.ndarray, ...]:
    """(name, surroundings, first, last) of the samples of the windows that start in ``spans``.

    Each sample stands for the windows that start at first..last and chose it.
    """
    if not spans:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    # The whole text is named once, whatever the number of spans.
    named = names(data, (k, length))
    chosen = first_minima(named[k], length - k + 1)
    if len(spans) == 1:
        a, b = spans[0]
        starts, chosen = np.arange(a, b + 1), chosen[a : b + 1]
        head = np.flatnonzero(np.diff(chosen, prepend=-1))
    else:
        edges = np.array(spans)
        sizes = edges[:, 1] - edges[:, 0] + 1
        begin = np.cumsum(sizes) - sizes
        starts = np.arange(int(sizes.sum())) + np.repeat(edges[:, 0] - begin, sizes)
        chosen = chosen[starts]
        new = np.diff(chosen, prepend=-1) != 0
        new[begin] = True
        head = np.flatnonzero(new)
    tail = np.append(head[1:], len(chosen)) - 1
    at, first, last = chosen[head], starts[head], starts[tail]
    whole = named[length]
    inside = (at - first).astype(np.uint64) * np.uint64(1009) + (last - first).astype(np.uint64)
    return named[k][at], mix(mix(whole[first] * _C + whole[last]) * _C + inside), first, last


SAMPLES = "name long, around long, doc long, first int, last int, kind int"
FOUND = "doc long, first int, last int, repeated boolean"
_SCHEMA = pa.schema([("name", pa.int64()), ("around", pa.int64()), ("doc", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("kind", pa.int32())])
_FOUND = pa.schema([("doc", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("repeated", pa.bool_())])
#: Kinds of samples: to be decided, decided as repeated, open but for an equal earlier one, and copies that tell of such.
TO_DECIDE, REPEATED, OPEN, TELLING = range(4)
#: So many surroundings of a name in one batch make its samples open at once.
SEVERAL = 8


def _merged(spans: list[int]) -> list[tuple[int, int]]:
    """Packed (first << 32 | last) spans, joined where they touch."""
    out: list[tuple[int, int]] = []
    for x in sorted(spans):
        a, b = x >> 32, x & 0xFFFFFFFF
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def combined(rows: list[np.ndarray]) -> list[np.ndarray]:
    """Samples (name, around, doc, first, last) of one task, with their kinds; what they decide alone is decided."""
    name, around, doc, first, _ = rows
    order = np.lexsort((first, doc, around, name))
    rows = [x[order] for x in rows]
    name, around = rows[:2]
    new_name = np.append(True, name[1:] != name[:-1])
    new = new_name | np.append(True, around[1:] != around[:-1])
    kind = np.where(new, TO_DECIDE, REPEATED).astype(np.int32)
    heads = np.flatnonzero(new)
    start = np.flatnonzero(new_name[heads])
    each = np.diff(np.append(start, len(heads)))
    several = np.repeat(each >= SEVERAL, each)
    kind[heads[several]] = OPEN
    # The first two surroundings of such a name go to the name's place as well.
    told = start[each >= SEVERAL]
    tell = heads[np.concatenate([told, told + 1])]
    # Decided samples need no name any more.
    for x in rows[:2]:
        x[kind == REPEATED] = 0
    return [*(np.concatenate([x, x[tell]]) for x in rows), np.concatenate([kind, np.full(len(tell), TELLING, np.int32)])]


def _sampled(docs: DataFrame, k: int, length: int) -> DataFrame:
    """Samples of ``docs`` (doc, text[, spans: all windows where absent])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        size = 0

        def flush():
            rows = [np.concatenate(c) for c in out]
            for c in out:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in combined(rows)], schema=_SCHEMA)

        for batch in batches:
            spans = batch.column(2).to_pylist() if batch.num_columns > 2 else None
            for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True)):
                data = np.frombuffer(text.as_py() or b"", dtype=np.uint8)
                if len(data) < length:
                    continue
                rows = samples(data, [(0, len(data) - length)] if spans is None else _merged(spans[i]), k, length)
                n = len(rows[0])
                for column, value in zip(out, (rows[0].view(np.int64), rows[1].view(np.int64), np.full(n, doc), rows[2].astype(np.int32), rows[3].astype(np.int32)), strict=True):
                    column.append(value)
                size += n
                if size > BATCH:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    return docs.mapInArrow(lean(run), SAMPLES)


def _compared(found: DataFrame) -> DataFrame:
    """Decisions on samples: repeated, or open; freed windows give no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_name = last_around = None
        held: pa.RecordBatch | None = None  # the first sample of the last (name, around), while it isn't open
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.column(5).to_numpy()
            decided = kind == REPEATED
            rows = batch.select(["doc", "first", "last"])
            if decided.any():
                done = rows.filter(pa.array(decided))
                yield pa.RecordBatch.from_arrays([*done.columns, pa.array(np.ones(len(done), dtype=bool))], schema=_FOUND)
                rows, batch, kind = rows.filter(pa.array(~decided)), batch.filter(pa.array(~decided)), kind[~decided]
                if not batch.num_rows:
                    continue
            name, around = (batch.column(i).to_numpy() for i in (0, 1))
            new_name = np.append(last_name is None or name[0] != last_name, name[1:] != name[:-1])
            new = new_name | np.append(last_around is None or around[0] != last_around, around[1:] != around[:-1])
            heads = np.flatnonzero(new)
            # A head is open if the head before or after it has the same name, or its task says so.
            as_before = ~new_name[heads]
            as_after = np.append(as_before[1:], False)
            open_ = np.zeros(len(name), dtype=bool)
            open_[heads[as_before | as_after | (kind[heads] == OPEN)]] = True
            take = np.flatnonzero((open_ | ~new) & (kind != TELLING))
            parts, flags = [rows.take(pa.array(take))], [~open_[take]]
            if held is not None and len(heads) and as_before[0]:
                parts.append(held)
                flags.append(np.zeros(1, dtype=bool))
            if len(heads):
                at = int(heads[-1])
                held = None if open_[at] or kind[at] == TELLING else rows.slice(at, 1)
            last_name, last_around = name[-1], around[-1]
            for part, flag in zip(parts, flags, strict=True):
                if part.num_rows:
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(flag)], schema=_FOUND)

    place = F.when(F.col("kind") == REPEATED, F.xxhash64("doc", "first")).when(F.col("kind") == OPEN, F.xxhash64("name", "around")).otherwise(F.col("name"))
    ordered = found.repartition(place).sortWithinPartitions("name", "around", "doc", "first", "kind")
    return ordered.mapInArrow(lean(run), FOUND)


def _spans_of(found: DataFrame) -> DataFrame:
    packed = F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR(F.col("last").cast("long"))
    return found.groupBy("doc").agg(F.collect_list(packed).alias("spans"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, names_of: tuple[int, ...] = NAMES) -> tuple[DataFrame, list[str]]:
    """(doc, spans) of ``docs`` (doc, text): starts of repeated windows, packed."""
    texts = docs.select("doc", "text")
    todo, found, paths = texts, None, []
    for k in names_of:
        here, path = materialize(_compared(_sampled(todo, k, length)), "found")
        paths.append(path)
        repeated = here.filter("repeated")
        found = repeated if found is None else found.union(repeated)
        if k < length:
            left = _spans_of(here.filter("not repeated"))
            todo = texts.join(left, "doc").select("doc", "text", "spans")
    return _spans_of(found), paths


CUT = "n_bytes long, n_removed long, n_spans long, kept"


def without_repeats(docs: DataFrame, length: int = LENGTH, digest: bool = False, names_of: tuple[int, ...] = NAMES, whole: bool = False) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and kept (bytes; their SHA-256 with ``digest``).

    With ``whole`` what is kept takes the place of the text, without characters of
    which bytes are missing.
    """
    rows, _ = ordered_key(docs.drop("doc", "spans"), "doc")
    spans, _ = repeated_spans(rows, length, names_of)
    joined = rows.join(spans, "doc", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, runs, kept = [], [], [], []
            at = batch.schema.get_field_index("spans")
            for text, starts in zip(batch.column(batch.schema.get_field_index("text")).cast(pa.binary()), batch.column(at), strict=True):
                raw, starts = text.as_py() or b"", starts.values
                removed = n = 0
                rest = raw
                if starts is not None and len(starts):
                    x = np.sort(starts.to_numpy())
                    a, b = x >> 32, np.maximum.accumulate((x & 0xFFFFFFFF) + length)
                    new = np.append(True, a[1:] > b[:-1])
                    a, b = a[new], b[np.append(np.flatnonzero(new)[1:] - 1, len(b) - 1)]
                    removed, n = int((b - a).sum()), len(a)
                    edges = [0, *np.column_stack([a, b]).ravel().tolist(), len(raw)]
                    rest = b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                total.append(len(raw))
                gone.append(removed)
                runs.append(n)
                kept.append(hashlib.sha256(rest).digest() if digest else rest.decode("utf-8", "ignore") if whole else rest)
            columns = [c for c, f in zip(batch.columns, batch.schema, strict=True) if f.name in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.string() if whole else pa.binary())],
                names=[*keep, "n_bytes", "n_removed", "n_spans", "kept"],
            )

    keep = [c for c in docs.columns if c in ("doc_id", "lang", "source", "n_chars") or not digest and c != "text"]
    ordered = joined.select(*keep, *[c for c in ("text", "spans")])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    found = ordered.mapInArrow(lean(cut), f"{schema}, {CUT} {'string' if whole else 'binary'}")
    return found.withColumnRenamed("kept", "text") if whole else found


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without its repeated 100-byte strings."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = without_repeats(docs, LENGTH, digest=True)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256"))
