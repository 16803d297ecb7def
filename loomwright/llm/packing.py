"""Best-fit packing with exact-complement hashing.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens; only
longer documents are cut.  What is packed are lengths, of which there are at
most ``capacity`` distinct ones, so the driver plans on their histogram alone:

* Lengths, and sums of two present lengths, are indexed.  For each length, from
  the longest, the gap to a full sequence is looked up as a single length, as a
  pair and as a triple; a combination is used as often as the counts allow.
* What no combination fills is packed best-fit decreasing, again by counts.

The plan says which numbers of each length go where.  Pieces are numbered within
their length by distributed running counts and look up their place.

Edge cases: a null or empty text is the single id 0; ties and repeated rows are
packed as separate pieces; a very long text gives many pieces; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucketed_prefix, lean, materialize, table, worker_cache

CAPACITY = 2048
#: Bytes of words, ids and their places that a generation of the cache may have, and the longest word in it.
CACHED, LONGEST, PLACE = 80_000_000, 64, 176
#: Letters and digits before a last mark of a word, and such marks: the vocabulary always cuts between them.
BEFORE, MARKS = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789"), frozenset(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_TOKENIZERS: dict[str, "WordCache"] = {}
worker_cache("tokenizers", _TOKENIZERS.clear)


class WordCache:
    """Token ids of white-space-separated words, as little-endian bytes.

    The vocabulary drops white space, and no token, normalisation or special
    token of it spans white space, so a text's ids are its words' ids in a row.
    It lower-cases, and letters and marks are never one token, so words are
    looked up in lower case and without a last mark, unless a text has what may
    be a special token.
    Two generations of ``CACHED`` bytes bound the memory; words of over
    ``LONGEST`` bytes are never kept.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark, self.mark_id = next(
            (t.content, i) for i, t in sorted(self.tokenizer.get_added_tokens_decoder().items())
        )
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.size = 0

    def _learn(self, words: list[bytes], into: dict[bytes, bytes]) -> None:
        """The ids of ``words`` in ``into``."""
        texts = [w.decode() for w in words]
        odd = [i for i, t in enumerate(texts) if self.mark in t]
        for i in odd:
            texts[i] = ""
        joined = self.tokenizer.encode_batch_fast([self.mark.join(["", *texts])], add_special_tokens=False)[0]
        ids = np.array(joined.ids, dtype="<u4")
        ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
        raw = ids.tobytes()
        for word, a, b in zip(words, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            into[word] = raw[4 * a + 4 : 4 * b]
        for i in odd:
            one = self.tokenizer.encode(words[i].decode(), add_special_tokens=False)
            into[words[i]] = np.array(one.ids, dtype="<u4").tobytes()

    def ids(self, text: bytes) -> bytes:
        """The ids of a UTF-8 text."""
        words = (text if b"<|" in text else text.lower()).split()
        young = self.young
        try:
            return b"".join([young[w] for w in words])
        except KeyError:
            missing = {w for w in words if w not in young}
        if self.size > CACHED:
            self.old, self.young, self.size = young, {}, 0
            young, missing = self.young, set(words)
        old, new, cut, long = self.old, set(), [], {}
        for w in missing:
            if len(w) > LONGEST:
                long[w] = b""
            elif (known := old.get(w)) is not None:
                young[w] = known
                self.size += len(w) + len(known) + PLACE
            elif len(w) > 1 and w[-1] in MARKS and w[-2] in BEFORE:
                cut.append(w)
                new.update(x for x in (w[:-1], w[-1:]) if x not in young)
            else:
                new.add(w)
        if new:
            self._learn(list(new), young)
        for w in cut:
            young[w] = young[w[:-1]] + young[w[-1:]]
        self.size += sum(len(w) + len(young[w]) + PLACE for w in (*new, *cut))
        if not long:
            return b"".join([young[w] for w in words])
        self._learn(list(long), long)
        return b"".join([long[w] if len(w) > LONGEST else young[w] for w in words])


def cached_tokenizer(path: str) -> WordCache:
    """This worker's cache for the tokenizer file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordCache(path)
    return _TOKENIZERS[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of ``docs`` (doc_id, text), with the checksum of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = cached_tokenizer(tokenizer)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):  # one text at a time
                ids = memoryview(cache.ids(text.as_py() or b"") + b"\0\0\0\0")
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(out, (doc_id, n, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(lean(run, "tokenizers"), PIECES)


def _combination(gap: int, have: np.ndarray, pairs: np.ndarray) -> tuple[int, ...] | None:
    """One, two or three present lengths whose sum is ``gap``; long ones first.

    ``have``: the counts.  ``pairs[s]``: how many pairs of present lengths sum to s.
    """
    if have[gap]:
        return (gap,)
    if pairs[gap]:
        a = np.arange((gap + 1) // 2, gap)
        for x in a[(have[a] > 0) & (have[gap - a] > 0)][::-1]:
            if x != gap - x or have[x] >= 2:
                return int(x), int(gap - x)
    a = np.arange(max(1, (gap + 2) // 3), max(1, gap - 1))
    for x in a[(have[a] > 0) & (pairs[gap - a] > 0)][::-1]:
        rest = int(gap - x)
        b = np.arange((rest + 1) // 2, rest)
        for y in b[(have[b] > 0) & (have[rest - b] > 0)][::-1]:
            need = Counter((int(x), int(y), int(rest - y)))
            if all(have[k] >= v for k, v in need.items()):
                return int(x), int(y), int(rest - y)
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, how many such sequences) that use up ``counts``."""
    have = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        have[length] = n
    made: list[tuple[tuple[int, ...], int]] = []
    if have[capacity]:
        made.append(((capacity,), int(have[capacity])))
        have[capacity] = 0
    present = (have > 0).astype(np.int64)
    pairs = np.convolve(present, present)[: capacity + 1]  # ordered pairs; only their presence counts
    for length in range(capacity - 1, 0, -1):
        while have[length]:
            have[length] -= 1  # the seed isn't its own partner
            found = _combination(capacity - length, have, pairs)
            have[length] += 1
            if found is None:
                break
            need = Counter((length, *found))
            times = min(int(have[k]) // v for k, v in need.items())
            made.append((tuple(sorted((length, *found), reverse=True)), times))
            for k, v in need.items():
                have[k] -= v * times
                if not have[k]:
                    pairs[k:] -= 2 * present[: capacity + 1 - k]
                    if 2 * k <= capacity:
                        pairs[2 * k] += 1
                    present[k] = 0
    # Best fit, decreasing, on what is left: open sequences by their gap.
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    gaps = np.zeros(capacity + 1, dtype=bool)
    for length in range(capacity, 0, -1):
        left = int(have[length])
        while left:
            fits = np.flatnonzero(gaps[length:])
            if len(fits):
                gap = int(fits[0]) + length
                lengths, n = open_[gap].pop()
                use = min(n, left)
                if n > use:
                    open_[gap].append((lengths, n - use))
                gaps[gap] = bool(open_[gap])
            else:
                gap, lengths, use = capacity, (), -(-left // (capacity // length))
            each = min(gap // length, max(1, left // use))
            lengths = (*lengths, *[length] * each)
            left -= use * each
            open_[gap - length * each].append((lengths, use))
            gaps[gap - length * each] = True
    made.extend(x for group in open_.values() for x in group)
    return made


def places(made: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """For runs of numbers of each length: first number, sequence, pieces a sequence, offset."""
    rows, used, sequence = [], Counter(), 0
    for lengths, times in made:
        offset = 0
        for length, n in Counter(lengths).items():
            rows.append((length, used[length], sequence, n, offset))
            used[length] += n * times
            offset += n * length
        sequence += times
    frame = pd.DataFrame(rows, columns=["length", "first", "sequence", "each", "offset"], dtype="int64")
    return frame.sort_values(["length", "first"]).reset_index(drop=True)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length; materialised) with sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = places(plan(counts, capacity))
    keyed = pieces.withColumns(
        {"__bucket": F.pmod(F.xxhash64("doc_id", "piece"), F.lit(1024)), "__one": F.lit(1)}
    )
    numbered = bucketed_prefix(keyed, ["__bucket"], ["doc_id", "piece", "start"], {"number": "__one"}, group=["length"])

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def look_up(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        key = where["length"].to_numpy() << 44 | where["first"].to_numpy()
        ask = length.to_numpy().astype("int64") << 44 | number.to_numpy().astype("int64")
        row = where.iloc[np.searchsorted(key, ask, side="right") - 1]
        nth, each = number.to_numpy() - row["first"].to_numpy(), row["each"].to_numpy()
        return pd.DataFrame(
            {
                "sequence_id": row["sequence"].to_numpy() + nth // each,
                "offset": row["offset"].to_numpy() + nth % each * length.to_numpy(),
            }
        )

    placed = numbered.withColumn("__at", look_up("length", "number"))
    return placed.select(
        *[c for c in pieces.columns], F.col("__at.sequence_id").alias("sequence_id"), F.col("__at.offset").alias("offset")
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """A row for each piece of all documents, with its sequence and its place there."""
    import public_tokenizers

    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    pieces, _ = materialize(cut_pieces(table(spark, sf_dir, "documents"), tokenizer), "op7")
    return pack(pieces)
