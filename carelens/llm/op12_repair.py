"""Repair of conversation structure: the cheapest edits, by a Viterbi search that runs in parallel.

A conversation should read ``(s?(ua)+)?`` in role initials.  Walking its rows, the search is in one
of four states (nothing yet, after s, after u, after a); a row is kept, given the other role or
deleted, and empty user or assistant turns are put in, each at its cost.  Blank and repeated rows
must go; a truncated row that stays costs one more.

Rows are reduced to units: equal rows of one turn are one unit with a count (all but the first are
repeats), a unit is one byte and its count, and the units of a conversation, in order of turn, are
cut into chunks of ``CHUNK``.  A conversation with a third of all rows is thus many rows of a small
table, never one group:

* every chunk is folded backwards from a guessed vector of costs at its right border (only the last
  chunk knows its own);
* fix-up passes hand each chunk the vector that its right neighbour has found.  A chunk is folded
  again only if the vectors differ by more than a constant - the constants add up to the cost - and
  passes end when none is left.  The vectors of such searches soon differ by constants only;
* the final vectors give the costs to go at every row, along which each chunk traces the edits that
  are least in ASCII order, from each of its four possible states; the map from entry to exit state
  is then joined with the neighbours', doubling the reach each time, until every entry is known.

The repaired text is hashed once more over the rows of each conversation in order: a stream, with
nothing held but the audit, which is part of the result.

Defined cases: null conv_id is one conversation; null turns stand first; null role or text is one
blank; rows of one turn stand by role, then by a hash of the text, equal ones together; roles count
by their first character, unknown ones can't be kept; an empty table gives an empty result; other
columns are ignored.  A conversation without rows has no edits.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import ensure_checkpoint_dir
from .common import BLANKS, OWN, PLACE_BITS, WORD, equal_keys, in_order

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 256
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
NEXT = (USER, USER, ASSISTANT, USER)  # the state after the only turn that may be put in or made
DELETE, MAKE, INSERT, TRUNCATED = 3, 2, 2, 1
CLOSE = (0, 4, 2, 0)  # costs after the last row
#: Codes of a unit: role (0 s, 1 u, 2 a, 3 other) + 4 if truncated, or GONE if it must be deleted.
GONE = 8


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of the rows after damage (a table may come back with fewer or more)."""
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    text = F.when(how == 1, "").when(how == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    times = F.when(how == 0, 0).when(how == 3, 2).otherwise(1)
    return (rows.select("conv_id", "turn", F.when(how == 4, "user").otherwise(plain("role")).alias("role"), text.alias("text"), times.alias("times"))
            .select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("copy")).drop("copy"))


def _hashes() -> list[Column]:
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(77), "text").alias("h2")]


def _role(initial: Column) -> Column:
    return F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)


def units(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, h1, h2 (hash of the text), n, blank, truncated, repeated (seen in an earlier turn)."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    seen = rows.select("conv_id", "turn", "role", *_hashes(), (~F.col("text").rlike(WORD)).alias("blank"),
                       (~last.isin(".", "!", "?")).alias("truncated"))
    one = seen.groupBy("conv_id", "turn", "role", "h1", "h2", "blank", "truncated").agg(F.count(F.lit(1)).alias("n"))
    at = F.struct(F.col("turn").isNotNull(), "turn")
    keys = ["conv_id", "role", "h1", "h2"]
    first = one.groupBy(*keys).agg(F.min(at).alias("at")).select(*[F.col(k).alias(f"f_{k}") for k in keys], F.col("at.turn").alias("f_turn"))
    both = one.join(first, equal_keys(one, first, [(k, f"f_{k}") for k in keys]))
    return both.select(*one.columns, (~F.col("turn").eqNullSafe(F.col("f_turn"))).alias("repeated"))


# --- one chunk -----------------------------------------------------------------------------------

def _step(after: tuple[int, ...], code: int) -> tuple[int, ...]:
    """Costs to go before a unit, from those after it."""
    out = []
    for q in range(4):
        best = DELETE + after[q]
        if code < GONE:
            stays = TRUNCATED * (code >= 4)
            role = code % 4
            if role < 3 and (role == NEXT[q] - 1 or role == q == 0):
                best = min(best, stays + after[role + 1])
            best = min(best, MAKE + stays + after[NEXT[q]])
        out.append(best)
    return tuple(min(out[q], INSERT + out[NEXT[q]], 2 * INSERT + out[NEXT[NEXT[q]]]) for q in range(4))


def costs(codes: bytes, counts: list[int], after: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Costs to go before every unit, and after the last.  Copies beyond the first are deleted."""
    out = [tuple(after)]
    for code, n in zip(reversed(codes), reversed(counts)):
        out.append(_step(tuple(c + DELETE * (n - 1) for c in out[-1]), code))
    return out[::-1]


def trace(codes: bytes, counts: list[int], togo: list[tuple[int, ...]], q: int, last: bool) -> tuple[str, int]:
    """The least audit in ASCII order (D < I < K < R) among the cheapest, and the state after it."""
    audit = []
    for i, (code, n) in enumerate(zip(codes, counts)):
        after = tuple(c + DELETE * (n - 1) for c in togo[i + 1])
        role, stays = code % 4, TRUNCATED * (code >= 4)
        while True:
            left = togo[i][q]
            if left == DELETE + after[q]:
                audit.append("D")
            elif left == INSERT + togo[i][NEXT[q]]:
                audit.append("I")
                q = NEXT[q]
                continue
            elif role < 3 and (role == NEXT[q] - 1 or role == q == 0) and left == stays + after[role + 1]:
                audit.append("K")
                q = role + 1
            else:
                audit.append("R")
                q = NEXT[q]
            break
        audit.append("D" * (n - 1))
    while last and CLOSE[q]:
        audit.append("I")
        q = NEXT[q]
    return "".join(audit), q


def fold(codes: bytes, counts: list[int], after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """The vector before a chunk, less its least entry, and that entry."""
    before = costs(codes, counts, after)[0]
    return tuple(c - min(before) for c in before), min(before)


# --- chunks --------------------------------------------------------------------------------------

def chunks(found: DataFrame, size: int = CHUNK) -> DataFrame:
    """The units in order, cut into chunks: conv_id, part, j (place of the chunk in its range), codes,
    counts, lost (blank, repeated, truncated rows, unfit neighbours), first and last role."""
    placed = in_order(found, ["conv_id", "turn", "role", "h1", "h2"])
    initial = F.substring("role", 1, 1)
    gone = F.col("blank") | F.col("repeated")
    code = F.when(gone, GONE).otherwise(_role(initial) + F.when(F.col("truncated"), 4).otherwise(0))
    narrow = placed.select("conv_id", F.shiftright(f"{OWN}place", PLACE_BITS).cast("int").alias("part"), code.alias("code"), _role(initial).alias("role"),
                           "n", "blank", "repeated", "truncated")
    kind = found.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        out = []
        for conv_id, some in groupby(rows, key=lambda r: r[0]):
            j, held = 0, []
            for r in some:
                if len(held) == size:
                    out.append((conv_id, j, held))
                    j, held = j + 1, []
                held.append(r)
                if len(out) >= 2048:
                    yield made(out)
                    out = []
            out.append((conv_id, j, held))
        if out:
            yield made(out)

    def made(some: list[tuple]) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(8)]
        for conv_id, j, held in some:
            blank = sum(r[4] for r in held if r[5])
            again = sum(r[4] if r[6] else r[4] - 1 for r in held if not r[5])
            cut = sum(1 for r in held if r[7] and not r[5] and not r[6])
            pairs = sum(r[4] - 1 for r in held) + sum(not _fits(a[3], b[3]) for a, b in zip(held, held[1:]))
            for c, v in zip(cols, (conv_id, held[0][1], j, bytes(r[2] for r in held), [r[4] for r in held], [blank, again, cut, pairs], held[0][3], held[-1][3])):
                c.append(v)
        kinds = (None, pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) if k else pa.array(c, type_of) for c, k in zip(cols, kinds)],
                                          names=["conv_id", "part", "j", "codes", "counts", "lost", "first_role", "last_role"])

    type_of = to_arrow_type(found.schema["conv_id"].dataType)
    schema = f"conv_id {kind}, part int, j long, codes binary, counts array<long>, lost array<long>, first_role int, last_role int"
    cut = narrow.mapInArrow(work, schema).checkpoint(eager=True)
    # number the chunks of a conversation: its ranges are few, however many rows it has
    per = cut.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("m"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    per = per.select(F.col("conv_id").alias("p_conv"), F.col("part").alias("p_part"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("shift"),
                     F.sum("m").over(whole).alias("chunks"))
    both = cut.join(per, equal_keys(cut, per, [("conv_id", "p_conv"), ("part", "p_part")]))
    return both.select("conv_id", (F.col("j") + F.col("shift")).alias("k"), "chunks", "codes", "counts", "lost", "first_role", "last_role")


def _fits(a: int, b: int) -> bool:
    """Whether neighbouring roles are su, ua or au."""
    return (a, b) in ((0, 1), (1, 2), (2, 1))


def _folded(rows: DataFrame) -> DataFrame:
    """Chunks with ``after``: also ``before`` and ``constant``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            got = [fold(codes, counts, tuple(after)) for codes, counts, after in zip(
                *(batch.column(at[c]).to_pylist() for c in ("codes", "counts", "after")))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([list(v) for v, _ in got], pa.list_(pa.int64())), pa.array([c for _, c in got], pa.int64())],
                                             names=[*batch.schema.names, "before", "constant"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(work, f"{schema}, before array<long>, constant long")


def _vector(v: tuple[int, ...]) -> Column:
    return F.array(*[F.lit(x).cast("long") for x in v])


def _neighbour(rows: DataFrame, side: int, cols: list[str]) -> DataFrame:
    """The rows' keys moved by ``side``, so that a join on (conv_id, k) finds the neighbour."""
    return rows.select(F.col("conv_id").alias("n_conv"), (F.col("k") - side).alias("n_k"), *[F.col(c).alias(f"n_{c}") for c in cols])


BESIDE = [("conv_id", "n_conv"), ("k", "n_k")]


def converged(cut: DataFrame) -> DataFrame:
    """Chunks with their true border vectors, each up to a constant: ``after``, ``before``, ``constant``."""
    names = [*cut.columns, "after"]
    now = _folded(cut.withColumn("after", _vector(CLOSE))).checkpoint(eager=True)
    while True:
        inner = now.where(F.col("k") + 1 < F.col("chunks"))
        right = _neighbour(now.where(F.col("k") > 0), 1, ["before"])
        wrong = inner.join(right, equal_keys(inner, right, BESIDE)).where(F.col("n_before") != F.col("after"))
        wrong = wrong.withColumn("after", F.col("n_before")).select(*names).checkpoint(eager=True)
        if wrong.isEmpty():
            return now
        keys = wrong.select(F.col("conv_id").alias("w_conv"), F.col("k").alias("w_k"))
        kept = now.join(keys, equal_keys(now, keys, [("conv_id", "w_conv"), ("k", "w_k")]), "left_anti")
        now = kept.union(_folded(wrong)).checkpoint(eager=True)


def traced(cut: DataFrame) -> DataFrame:
    """conv_id, k, cost and audit part of every chunk, its entry state being settled."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, k, chunks_, codes, counts, after = (batch.column(i) for i in range(6))
            exits, audits = [], []
            for i, n, c, m, v in zip(k.to_pylist(), chunks_.to_pylist(), codes.to_pylist(), counts.to_pylist(), after.to_pylist()):
                togo = costs(c, m, tuple(v))
                got = [trace(c, m, togo, q, i + 1 == n) for q in ((0,) if i == 0 else range(4))]
                exits.append([q for _, q in got] * (4 // len(got)))
                audits.append([a for a, _ in got])
            yield pa.RecordBatch.from_arrays([conv, k, pa.array(exits, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))],
                                             names=["conv_id", "k", "exits", "audits"])

    kind = cut.schema["conv_id"].dataType.simpleString()
    done = (cut.select("conv_id", "k", "chunks", "codes", "counts", "after")
            .mapInArrow(work, f"conv_id {kind}, k long, exits array<long>, audits array<string>")).checkpoint(eager=True)
    # exits of the way through this chunk and the ``reach`` before it; a constant map is a known state
    inner = done.select("conv_id", "k", "exits").where(F.col("k") >= 0)
    reach = 1
    while True:
        open_ = inner.where(F.size(F.array_distinct("exits")) > 1)
        if open_.isEmpty():
            break
        left = _neighbour(inner, -reach, ["exits"])
        joined = inner.join(left, equal_keys(inner, left, BESIDE), "left")
        through = F.transform("n_exits", lambda q: F.get(F.col("exits"), q.cast("int")))
        inner = joined.select("conv_id", "k", F.when(F.col("n_exits").isNull() | (F.size(F.array_distinct("exits")) == 1), F.col("exits"))
                              .otherwise(through).alias("exits")).checkpoint(eager=True)
        reach *= 2
    entry = _neighbour(inner, -1, ["exits"])
    both = done.join(entry, equal_keys(done, entry, BESIDE), "left")
    state = F.coalesce(F.get("n_exits", F.lit(0)), F.lit(NOTHING)).cast("int")
    return both.select("conv_id", "k", F.get("audits", state).alias("audit"))


def repairs(rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """conv_id, counts of faults, cost and audit of every conversation among the (damaged) rows."""
    ensure_checkpoint_dir(rows.sparkSession)
    found = units(rows).checkpoint(eager=True)
    cut = converged(chunks(found, size).checkpoint(eager=True))
    nexts = _neighbour(cut.where(F.col("k") > 0), 1, ["first_role"])
    pair = F.struct(F.col("last_role").alias("a"), F.col("n_first_role").alias("b"))
    fit = pair.isin(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((0, 1), (1, 2), (2, 1))])
    counted = cut.join(nexts, equal_keys(cut, nexts, BESIDE), "left")
    faults = ["blank", "duplicate", "truncated", "illegal"]
    totals = counted.groupBy("conv_id").agg(
        *[F.sum(F.get("lost", F.lit(i))).alias(c) for i, c in enumerate(faults)],
        F.count_if(F.col("n_first_role").isNotNull() & ~fit).alias("borders"),
        (F.sum("constant") + F.max(F.when(F.col("k") == 0, F.get("before", F.lit(NOTHING))))).alias("cost"))
    parts = traced(cut).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("k", "audit"))).alias("parts")).select(
        F.col("conv_id").alias("a_conv"), F.array_join("parts.audit", "").alias("audit"))
    gaps = (found.select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
        .select(F.col("conv_id").alias("g_conv"), "gaps"))
    both = totals.join(parts, equal_keys(totals, parts, [("conv_id", "a_conv")]))
    both = both.join(gaps, equal_keys(both, gaps, [("conv_id", "g_conv")]))
    return both.select("conv_id", "gaps", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("borders")).alias("illegal"), "cost", "audit")


# --- repaired rows -------------------------------------------------------------------------------

def _edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Role and text of the repaired conversation."""
    q = NOTHING
    named = {USER: "user", ASSISTANT: "assistant"}
    for edit in audit:
        if edit == "I":
            q = NEXT[q]
            yield named[q], ""
            continue
        role, text = next(rows)
        if edit == "K":
            q = INITIALS.index(role[0]) + 1
            yield role, text
        elif edit == "R":
            q = NEXT[q]
            yield named[q], text


def _in_turn(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order."""
    text = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), F.lit(1).alias("row"), "turn", "role", *_hashes(), "text")
    none = lambda kind: F.lit(None).cast(kind)
    head = found.select("conv_id", "audit", F.lit(0).alias("row"), none(rows.schema["turn"].dataType).alias("turn"),
                        none("string").alias("role"), none("long").alias("h1"), none("long").alias("h2"), none("string").alias("text"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "row", "turn", "role", "h1", "h2")]
    return head.union(text).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "audit", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
    for conv_id, some in groupby(rows, key=lambda r: r[0]):
        audit = next(some)[1]
        yield conv_id, _edited(audit, ((r[2], r[3]) for r in some))


def repaired(rows: DataFrame, found: DataFrame | None = None, size: int = CHUNK) -> DataFrame:
    """The repaired conversations: conv_id, place, role, text."""
    found = repairs(rows, size) if found is None else found
    kind = rows.schema["conv_id"].dataType
    type_of = to_arrow_type(kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], k) for c, k in enumerate((type_of, pa.int64(), pa.string(), pa.string()))],
                                              names=["conv_id", "place", "role", "text"])
        for conv_id, rows_ in _conversations(batches):
            for place, (role, text) in enumerate(rows_):
                out.append((conv_id, place, role, text))
                if len(out) == 256:
                    yield batch()
                    out.clear()
        if out:
            yield batch()

    return _in_turn(rows, found).mapInArrow(work, f"conv_id {kind.simpleString()}, place long, role string, text string")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its repaired rows, ``role:text`` joined by line ends."""
    kind = rows.schema["conv_id"].dataType
    type_of = to_arrow_type(kind)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv_id, rows_ in _conversations(batches):
            sha, between = hashlib.sha256(), b""
            for role, text in rows_:
                sha.update(between + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                between = b"\n"
            out.append((conv_id, sha.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], type_of), pa.array([x[1] for x in out], pa.string())], names=["conv_id", "sha"])

    return _in_turn(rows, found).mapInArrow(work, f"conv_id {kind.simpleString()}, sha string")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = damage(given)
    found = repairs(rows).checkpoint(eager=True)
    hashed = digests(rows, found.select("conv_id", "audit")).select(F.col("conv_id").alias("h_conv"), "sha")
    full = found.join(hashed, equal_keys(found, hashed, [("conv_id", "h_conv")]))
    every = given.select(F.col("conv_id").alias("o_conv")).distinct()
    both = every.join(full, equal_keys(every, full, [("o_conv", "conv_id")]), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return both.select(F.col("o_conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
