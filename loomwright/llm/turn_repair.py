"""Cheapest repair of conversations by a scan of min-plus matrices.

The roles of a whole conversation follow an automaton of four states: nothing
yet, after the system turn, after a user's turn, after an assistant's turn.  A
turn is a 4x4 matrix of (cost, audit) elements: what it costs, and by which edits,
to go from one state to another over this turn, with the closure of inserts
after it.  Costs add and audits are joined; of two elements the cheaper one counts,
of equally cheap ones the audit that is least in ASCII order.  Equally cheap audits
of the same turns are never prefixes of each other (one more insert costs more),
so joining keeps their order and products of matrices may be grouped at will.

Turns are sorted over all partitions.  A conversation that lies within one
partition is reduced there; the turns of those that cross a border, or are longer
than ``STRETCH`` turns, are cut into stretches of ``STRETCH`` turns, each a task's
product, and a tree of products with ``FAN`` branches joins them.  A matrix holds
up to 16 audits, so a join needs memory in proportion to the audit that the result
returns.  Only the digest of a repaired conversation, which is one hash by
definition, is taken by one task, turn by turn.

Edge cases: a null role or text counts as one space, a null turn sorts first and
leaves gaps as they are; rows of one turn follow by role, then by the text's first
64 characters and its MD5; a null conv_id is a conversation of its own; repeated
rows are turns of their own (all but the first are duplicates); a role that starts
with another letter than s, u or a can't be kept; a conversation of which no row is
left has zeros, an empty audit and the digest of the empty string; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, materialize, table

#: Turns of a stretch, and stretches that are joined at once.
STRETCH, FAN = 4096, 16
#: Bytes of text that a conversation may hold in a task before its turns are passed on.
HELD_BYTES = 8 << 20
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"

Element = tuple[int, str]
Matrix = tuple[tuple[Element | None, ...], ...]

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: From which states a turn of this initial may follow, and where it leads.
ARCS = {"s": ([EMPTY], SYSTEM), "u": ([EMPTY, SYSTEM, ASSISTANT], USER), "a": ([USER], ASSISTANT)}
NAMES = {USER: "user", ASSISTANT: "assistant"}


def better(one: Element | None, other: Element | None) -> Element | None:
    return other if one is None else one if other is None else min(one, other)


def times(one: Matrix, other: Matrix) -> Matrix:
    """The min-plus product: first ``one``, then ``other``."""
    out = []
    for row in one:
        sums: list[Element | None] = [None] * 4
        for via, left in enumerate(row):
            if left is None:
                continue
            for to, right in enumerate(other[via]):
                if right is None:
                    continue
                cost, best = left[0] + right[0], sums[to]
                if best is None or cost < best[0] or cost == best[0] and left[1] + right[1] < best[1]:
                    sums[to] = (cost, left[1] + right[1])
        out.append(tuple(sums))
    return tuple(out)


def arcs(found: Iterable[tuple[int, int, Element]]) -> Matrix:
    """The matrix with the best of the given (from, to, element)."""
    rows: list[list[Element | None]] = [[None] * 4 for _ in STATES]
    for a, b, element in found:
        rows[a][b] = better(rows[a][b], element)
    return tuple(map(tuple, rows))


UNIT = arcs((s, s, (0, "")) for s in STATES)


@functools.cache
def inserts() -> Matrix:
    """Any number of inserted turns: powers of one insert until nothing gets better."""
    one = arcs([*((s, s, (0, "")) for s in STATES), *((a, to, (INSERT, "I")) for i, (start, to) in ARCS.items() if i != "s" for a in start)])
    closed = UNIT
    while (more := times(closed, one)) != closed:
        closed = more
    return closed


@functools.cache
def turn_matrix(initial: str, must_go: bool, cut_off: bool) -> Matrix:
    """What a turn can become, and inserts after it."""
    found = [(s, s, (DELETE, "D")) for s in STATES]
    more = CUT_OFF * cut_off
    for role, (start, to) in ARCS.items():
        if not must_go and role == initial:
            found += [(s, to, (KEEP + more, "K")) for s in start]
        if not must_go and role != "s":
            found += [(s, to, (REROLE + more, "R")) for s in start]
    return times(arcs(found), inserts())


class Run:
    """Consecutive turns of one conversation: their matrix and what counting needs at its ends."""

    __slots__ = ("matrix", "first", "last", "illegal", "low", "high", "turns", "blank", "duplicate", "truncated")

    def __init__(self, matrix: Matrix, first, last, illegal: int, low, high, turns: int, blank: int, duplicate: int, truncated: int):
        self.matrix, self.first, self.last, self.illegal = matrix, first, last, illegal
        self.low, self.high, self.turns = low, high, turns
        self.blank, self.duplicate, self.truncated = blank, duplicate, truncated

    @classmethod
    def of_turn(cls, turn: int | None, initial: str, blank: bool, duplicate: bool, truncated: bool) -> Run:
        truncated = truncated and not duplicate
        matrix = turn_matrix(initial if initial in ARCS else "", blank or duplicate, truncated)
        return cls(matrix, initial, initial, 0, turn, turn, int(turn is not None), int(blank), int(duplicate), int(truncated))

    def then(self, other: Run) -> Run:
        if self.first is None or other.first is None:  # no turn in one of them
            return other if self.first is None else self
        joint = self.last + other.first not in ("su", "ua", "au")
        low = other.low if self.low is None else self.low
        high = self.high if other.high is None else other.high
        same = self.high is not None and self.high == other.low
        return Run(
            times(self.matrix, other.matrix), self.first, other.last, self.illegal + other.illegal + joint, low, high,
            self.turns + other.turns - same, self.blank + other.blank, self.duplicate + other.duplicate, self.truncated + other.truncated,
        )

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns

    def solved(self) -> Element:
        whole = times(inserts(), self.matrix)[EMPTY]
        return better(whole[EMPTY], whole[ASSISTANT])

    def row(self) -> tuple:
        """As a row of ``RUN``."""
        flat = [x for r in self.matrix for x in r]
        return (
            [None if x is None else x[0] for x in flat], [None if x is None else x[1] for x in flat],
            self.first, self.last, self.illegal, self.low, self.high, self.turns, self.blank, self.duplicate, self.truncated,
        )

    @classmethod
    def of_row(cls, costs: list, audits: list, *rest) -> Run:
        flat = [None if c is None else (c, a) for c, a in zip(costs, audits, strict=True)]
        return cls(tuple(tuple(flat[4 * s : 4 * s + 4]) for s in STATES), *rest)


NO_TURN = Run(UNIT, None, None, 0, None, None, 0, 0, 0, 0)
RUN = (
    "costs array<long>, audits array<string>, first string, last string, illegal long, low long, high long, "
    "turns long, blank long, duplicate long, truncated long"
)


def joined(runs: list[Run]) -> Run:
    """The runs in turn as one, by a tree: neighbours in pairs, then pairs of these."""
    while len(runs) > 1:
        runs = [runs[i].then(runs[i + 1]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    return runs[0] if runs else NO_TURN


def edited(audit: Iterator[str], state: list[int], role: str | None, text: str | None, end: bool = False) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the inserts before a turn and of the turn itself; of the last inserts at the ``end``.

    ``audit`` gives letters one by one and ``state`` holds, from call to call, the
    number of turns given out and whether the first one is the system's.
    """
    for letter in audit:
        if letter == "D":
            yield "delete", role, text
            return
        here = USER if (state[0] + state[1]) % 2 == 0 else ASSISTANT
        state[0] += 1
        if letter == "I":
            yield "insert", NAMES[here], ""
            continue
        yield ("keep", role, text) if letter == "K" else ("rerole", NAMES[here], text)
        return


class Script:
    """Applies an audit to the turns of a conversation, in order."""

    def __init__(self, audit: str):
        # The system's turn is kept iff the number of turns that stay is odd.
        self.letters, self.state = iter(audit), [0, (len(audit) - audit.count("D")) % 2]

    def over(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        return edited(self.letters, self.state, role, text)

    def rest(self) -> Iterator[tuple[str, str, str]]:
        return edited(self.letters, self.state, None, None)


class Digest:
    """The row of a conversation: its counts, cost, audit and the SHA-256 of its repaired turns, fed turn by turn."""

    def __init__(self, conv, run: Run):
        self.cost, self.audit = run.solved()
        self.head = (conv, run.gaps, run.blank, run.duplicate, run.truncated, run.illegal, self.cost, self.audit)
        self.script, self.hash, self.any = Script(self.audit), hashlib.sha256(), False

    def _take(self, turns: Iterable[tuple[str, str, str]]) -> None:
        for edit, role, text in turns:
            if edit != "delete":
                self.hash.update(f"{chr(10) * self.any}{role}:{text}".encode())
                self.any = True

    def feed(self, role: str, text: str) -> list[tuple]:
        self._take(self.script.over(role, text))
        return []

    def end(self) -> list[tuple]:
        self._take(self.script.rest())
        return [(*self.head, self.hash.hexdigest())]


class Lines(Digest):
    """The edited turns of a conversation as rows: place (from 0, deleted turns counted), edit, role, text."""

    def __init__(self, conv, run: Run):
        super().__init__(conv, run)
        self.places = itertools.count()

    def _rows(self, turns: Iterable[tuple[str, str, str]]) -> list[tuple]:
        return [(self.head[0], next(self.places), *t) for t in turns]

    def feed(self, role: str, text: str) -> list[tuple]:
        return self._rows(self.script.over(role, text))

    def end(self) -> list[tuple]:
        return self._rows(self.script.rest())


def marked(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped with the first letter of the role and flags of the text."""
    space = SPACE.replace("\x0b", r"\u000b").replace("\x0c", r"\u000c").replace("\n", r"\n").replace("\r", r"\r").replace("\t", r"\t")
    end = F.expr(f"trim(trailing '{space}' from text)")
    return turns.withColumn("__end", end).select(
        "conv_id", "turn", "role", "text", "dropped", F.substring("role", 1, 1).alias("initial"),
        (F.col("__end") == "").alias("blank"),
        ((F.col("__end") != "") & ~F.right("__end", F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )


def columns_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def turns_with(conversations: DataFrame) -> DataFrame:
    """``conversations`` in the form that ``repair`` takes: nulls as one space, nothing dropped."""
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.lit(False).alias("dropped"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with the faults that a hash of conv_id and turn puts in; a dropped one stays as a mark of its conversation."""
    rows = turns_with(conversations)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumn("__k", F.crc32(name.cast("binary")) % 20)
    k = F.col("__k")
    text = F.when(k.isin(0, 1), "").when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select(
        "conv_id", "turn", F.when(k == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (k == 0).alias("dropped"),
        F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"),
    )
    return rows.drop("__copy")


def summary_type(conv: T.DataType) -> T.StructType:
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return T.StructType(
        [T.StructField("conv_id", conv), *[T.StructField(c, T.LongType()) for c in counts],
         T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    )


def lines_type(conv: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField("conv_id", conv), T.StructField("place", T.LongType()),
         *[T.StructField(c, T.StringType()) for c in ("edit", "role", "text")]]
    )


def repair(turns: DataFrame) -> DataFrame:
    """A row for each conversation of ``turns`` (conv_id, turn, role, text, dropped): counts, cost, audit, digest."""
    return _repaired(turns, summary_type(turns.schema["conv_id"].dataType), Digest)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The turns of each conversation in order with what became of them: keep, rerole, delete or insert."""
    return _repaired(turns, lines_type(turns.schema["conv_id"].dataType), Lines)


def _repaired(turns: DataFrame, summary: T.StructType, kind: type[Digest]) -> DataFrame:
    keys = ["conv_id", "turn", "role", "__head", "__md5", "__n"]
    rows = marked(turns).withColumns(
        {"__head": F.substring("text", 1, 64), "__md5": F.md5("text"), "__n": F.monotonically_increasing_id()}
    )
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys[3:]).withColumn("pos", F.monotonically_increasing_id())
    fields = ["conv_id", "pos", "turn", "role", "text", "dropped", "initial", "blank", "truncated"]
    state = T.StructType([T.StructField("whole", T.BooleanType()), *[T.StructField(f"s_{f.name}", f.dataType) for f in summary], *[T.StructField(f, rows.schema[f].dataType) for f in fields]])
    nothing = [None] * len(fields)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Solve what begins and ends in this partition; pass on the turns of the others."""
        held: list[tuple] = []
        size, inside, begun, current = 0, False, False, object()

        def passed() -> list[tuple]:
            out = [(False, *[None] * len(summary), *r) for r in held]
            held.clear()
            return out

        for batch in batches:
            out: list[tuple] = []
            for row in columns_of(batch, *fields):
                if row[0] != current:
                    if inside:
                        out += [(True, *r, *nothing) for r in solved(held, kind)]
                        held.clear()
                    else:
                        out += passed()
                    # The first conversation may have begun in another partition.
                    inside, begun, current, size = begun, True, row[0], 0
                held.append(row)
                size += len(row[4])
                if inside and (len(held) > STRETCH or size > HELD_BYTES):
                    inside = False
                if not inside:
                    out += passed()
            yield to_batch(out, state)
        yield to_batch(passed(), state)

    found, _ = materialize(rows.select(*fields).mapInArrow(lean(within), state), "op12-within")
    whole = found.filter("whole").select(*[F.col(f"s_{f.name}").alias(f.name) for f in summary])
    return whole.unionByName(repair_across(found.filter("not whole").select(*fields), summary, kind))


def solved(turns: list[tuple], kind: type[Digest]) -> list[tuple]:
    """What ``kind`` makes of all turns of a conversation."""
    seen: set[tuple[str, str]] = set()
    runs, conv = [], turns[0][0]
    left = [t for t in turns if not t[5]]
    for _, _, turn, role, text, _, initial, blank, truncated in left:
        again = not blank and (role, text) in seen
        seen.add((role, text))
        runs.append(Run.of_turn(turn, initial, blank, again, truncated))
    made = kind(conv, joined(runs))
    return [row for t in left for row in made.feed(t[3], t[4])] + made.end()


def to_batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = zip(*rows, strict=True) if rows else [[] for _ in arrow]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def numbered_runs(turns: DataFrame) -> DataFrame:
    """A run for each conversation and stretch of ``turns``, numbered from 0 in each conversation."""
    # The first place of each text in a conversation; the others repeat it.
    firsts = turns.filter("not dropped and not blank").groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("pos").alias("pos"))
    marks = turns.drop("text", "role").join(firsts.select("pos", F.lit(True).alias("is_first")), "pos", "left")
    marks = marks.withColumns({"again": ~F.col("blank") & F.col("is_first").isNull(), "stretch": F.expr(f"pos div {STRETCH}")})
    names = ["conv_id", "stretch", "dropped", "turn", "initial", "blank", "again", "truncated"]
    out = T.StructType([turns.schema["conv_id"], T.StructField("stretch", T.LongType()), *T._parse_datatype_string(RUN).fields])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, runs = None, []
        for batch in batches:
            done = []
            for conv, stretch, dropped, *turn in columns_of(batch, *names):
                if (conv, stretch) != current:
                    if current is not None:
                        done.append((*current, *joined(runs).row()))
                    current, runs = (conv, stretch), []
                if not dropped:
                    runs.append(Run.of_turn(*turn))
            yield to_batch(done, out)
        if current is not None:
            yield to_batch([(*current, *joined(runs).row())], out)

    runs = marks.select("pos", *names).repartition("stretch").sortWithinPartitions("stretch", "pos").mapInArrow(lean(products), out)
    in_order = Window.partitionBy("conv_id").orderBy("stretch")
    return runs.withColumn("place", (F.row_number().over(in_order) - 1).cast("long")).drop("stretch")


def repair_across(turns: DataFrame, summary: T.StructType, kind: type[Digest]) -> DataFrame:
    """What ``kind`` makes of each conversation whose sorted ``turns`` lie in more than one task."""
    runs, _ = materialize(numbered_runs(turns), "op12-runs", short=True)
    level = [f.name for f in T._parse_datatype_string(RUN).fields]
    most, shape = runs.agg(F.max("place")).first()[0] or 0, runs.schema

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []
        for batch in batches:
            done = []
            for conv, place, *rest in columns_of(batch, "conv_id", "place", *level):
                if (conv, place // FAN) != current:
                    if current is not None:
                        done.append((current[0], *joined(parts).row(), current[1]))
                    current, parts = (conv, place // FAN), []
                parts.append(Run.of_row(*rest))
            yield to_batch(done, shape)
        if current is not None:
            yield to_batch([(current[0], *joined(parts).row(), current[1])], shape)

    tree = runs
    while most > 0:
        tree = tree.repartition("conv_id", F.expr(f"place div {FAN}")).sortWithinPartitions("conv_id", "place").mapInArrow(lean(merged), shape)
        most //= FAN

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each conversation's run stands before its turns."""
        made = None
        for batch in batches:
            done = []
            for conv, pos, role, text, *rest in columns_of(batch, "conv_id", "pos", "role", "text", *level):
                if pos < 0:
                    done += made.end() if made else []
                    made = kind(conv, Run.of_row(*rest))
                else:
                    done += made.feed(role, text)
            yield to_batch(done, summary)
        if made:
            yield to_batch(made.end(), summary)

    heads = tree.select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit("").alias("role"), F.lit("").alias("text"), *level)
    nulls = [F.lit(None).cast(runs.schema[c].dataType).alias(c) for c in level]
    left = turns.filter("not dropped").select("conv_id", "pos", "role", "text", *nulls)
    return heads.unionByName(left).repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(lean(digests), summary)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage, and the cheapest repair of each conversation."""
    return repair(damaged(table(spark, sf_dir, "conversations")))


#: The same automaton, turn by turn, with a struct of (cost, audit) for each state; CRC-32 bit by bit.
OP12_SQL = r"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT)),
                lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                                         lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
                4294967295) % 20 AS k
  FROM raw),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, (VALUES (0), (1)) AS copies(copy) WHERE k <> 0 AND (copy = 0 OR k = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), md5(text)) AS i,
         left(role, 1) AS initial, regexp_replace(text, '[ 	-
]+$', '') AS body
  FROM damaged),
flagged AS (
  SELECT *, body = '' AS blank,
         body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM placed),
t AS (
  SELECT *, body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS truncated FROM flagged),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
         count_if(again) AS duplicate, count_if(truncated) AS truncated,
         count_if(pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM t GROUP BY conv_id),
scan AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, [{'c': 0::BIGINT, 'a': ''}, NULL, {'c': 5::BIGINT, 'a': 'I'}, {'c': 10::BIGINT, 'a': 'II'}] AS s
  FROM raw
  UNION ALL
  SELECT q.conv_id, q.i,
         [w[1], w[2],
          list_min([w[3], {'c': w[1].c + 5, 'a': w[1].a || 'I'}, {'c': w[2].c + 5, 'a': w[2].a || 'I'}, {'c': w[4].c + 5, 'a': w[4].a || 'I'}]),
          list_min([w[4], {'c': w[3].c + 5, 'a': w[3].a || 'I'}, {'c': w[1].c + 10, 'a': w[1].a || 'II'}, {'c': w[2].c + 10, 'a': w[2].a || 'II'}])] AS s
  FROM (
    SELECT conv_id, i,
           [list_min([{'c': s[1].c + 2, 'a': s[1].a || 'D'}]),
            list_min([{'c': s[2].c + 2, 'a': s[2].a || 'D'},
                      CASE WHEN NOT gone AND initial = 's' THEN {'c': s[1].c + more, 'a': s[1].a || 'K'} END]),
            list_min([{'c': s[3].c + 2, 'a': s[3].a || 'D'}, CASE WHEN NOT gone THEN list_min(list_transform([s[1], s[2], s[4]],
                      lambda x: {'c': x.c + more + u, 'a': x.a || CASE WHEN u = 0 THEN 'K' ELSE 'R' END})) END]),
            list_min([{'c': s[4].c + 2, 'a': s[4].a || 'D'},
                      CASE WHEN NOT gone THEN {'c': s[3].c + more + v, 'a': s[3].a || CASE WHEN v = 0 THEN 'K' ELSE 'R' END} END])] AS w
    FROM (SELECT scan.conv_id, t.i, scan.s, t.initial, t.blank OR t.again AS gone, CASE WHEN t.truncated THEN 5 ELSE 0 END AS more,
                 CASE WHEN t.initial = 'u' THEN 0 ELSE 1 END AS u, CASE WHEN t.initial = 'a' THEN 0 ELSE 1 END AS v
          FROM scan JOIN t ON scan.conv_id IS NOT DISTINCT FROM t.conv_id AND t.i = scan.i + 1)) AS q),
best AS (
  SELECT conv_id, list_min([s[1], s[4]]) AS e FROM scan
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
letters AS (
  SELECT conv_id, unnest(string_split(e.a, '')) AS letter, generate_subscripts(string_split(e.a, ''), 1) AS spot,
         (length(e.a) - length(replace(e.a, 'D', ''))) AS deleted, length(e.a) AS n
  FROM best WHERE e.a <> ''),
steps AS (
  SELECT *, count_if(letter <> 'I') OVER (PARTITION BY conv_id ORDER BY spot) AS i,
         count_if(letter <> 'D') OVER (PARTITION BY conv_id ORDER BY spot) - 1 + (n - deleted) % 2 AS place
  FROM letters),
repaired AS (
  SELECT steps.conv_id, string_agg(
           CASE letter WHEN 'K' THEN t.role WHEN 'D' THEN NULL ELSE CASE WHEN place % 2 = 0 THEN 'user' ELSE 'assistant' END END
           || ':' || CASE letter WHEN 'I' THEN '' ELSE t.text END, chr(10) ORDER BY spot) AS whole
  FROM steps LEFT JOIN t ON steps.conv_id IS NOT DISTINCT FROM t.conv_id AND steps.i = t.i
  WHERE letter <> 'D' GROUP BY steps.conv_id)
SELECT best.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, e.c::BIGINT AS cost, e.a AS audit,
       sha256(coalesce(whole, '')) AS repaired_sha256
FROM best LEFT JOIN counts ON best.conv_id IS NOT DISTINCT FROM counts.conv_id
LEFT JOIN repaired ON best.conv_id IS NOT DISTINCT FROM repaired.conv_id
"""
