"""Suffix-array dedup: every byte under a 100-byte string that also starts earlier is removed.

Whole suffix arrays of the corpus would have to live somewhere; equal windows only have to meet.
Each window of ``WIDTH`` bytes is owned by its minimiser, the ``GRAM``-byte string in it of
least hash (leftmost among equals): equal windows have equal owners at the same place in them.
A run of neighbouring windows with one owner is one row (about one per 35 bytes): hash of the
owner, hash of the run's bytes, place.  Rows with equal hashes are equal runs; all but the first
(smallest doc_id, start) are removed whole.  That settles copies and the inside of passages.
Copies within one batch of documents are settled in the task (a combine before the shuffle), so
that a passage of a third of all documents sends one row per batch.

What is left are edges: first runs whose owner also has other runs (owners are counted on the map
side and joined back, so no task holds all runs of one).  Only their bytes (up to
168) are fetched and meet by owner, in suffix order: prefix doubling ranks all suffixes by
their first 100 bytes, and the longest previous factor of a window reaches 100 exactly if its
previous smaller position in suffix order - ties standing by position - shares that rank.  A
task works through its owners in sorted pieces of bounded size, cut between owners.

An owner with more than ``CROWD`` runs (a phrase shorter than a window, with other text
around it each time) would be one large piece.  Its windows are dealt one by one, by a 128-bit
hash of their 100 bytes: equal windows still meet, the others spread.  Of equal windows only the
first of a batch of documents is sent on; all but the first by place are removed.

Rows are named by their file and place in it, which hold however a scan is split; ``docs`` that do
not come from files are written to the shared folder first.  (Rows that a join or an explode has
repeated have no place of their own: write such a table before.)

Defined cases: null or empty text has 0 bytes; rows with equal doc_id stand in an order of files and places, a
null doc_id before all others; an exact copy of at least 100 bytes is removed whole, shorter
documents keep all; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import OWN, documents, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH, GRAM = 100, 32
SLIDE = WIDTH - GRAM  # an owner starts 0..SLIDE bytes into its window
BATCH_BYTES = 4 << 20
BASE = 0x9E3779B97F4A7C15 | 1
PLACE = (1 << 24) - 1
CROWD = 20_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, windows, owner hash, content hash) of the runs in concatenated documents that end
    at ``ends``; data must be shorter than 2^24 bytes."""
    n = len(data)
    none = np.empty(0, np.int64)
    if n < WIDTH:
        return none, none, none, none
    h = _mix(data.astype(np.uint64) + np.uint64(1))
    power, width, at32 = BASE, 1, None
    while width < 64:  # h: hash of the next `width` bytes
        nxt = np.zeros_like(h)
        nxt[:n - width] = h[:n - width] * np.uint64(power) + h[width:]
        h, power, width = nxt, power * power % (1 << 64), width * 2
        if width == GRAM:
            at32 = h
    gram = _mix(at32)
    least = (gram & ~np.uint64(PLACE)) | np.arange(n, dtype=np.uint64)
    least[n - GRAM + 1:] = np.iinfo(np.uint64).max
    width = 1
    while width * 2 <= SLIDE + 1:
        least[:n - width] = np.minimum(least[:n - width], least[width:])
        width *= 2
    rest = SLIDE + 1 - width
    if rest:
        least[:n - rest] = np.minimum(least[:n - rest], least[rest:])
    owner = (least & np.uint64(PLACE)).astype(np.int64)
    end_of = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
    valid = np.arange(n) + WIDTH <= end_of
    owner[~valid] = -1
    new = np.empty(n, bool)
    new[0], new[1:] = True, (owner[1:] != owner[:-1]) | (end_of[1:] != end_of[:-1])
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, n))
    real = owner[start] >= 0
    start, length = start[real], length[real]
    size = length + WIDTH - 1
    content = _mix(h[start] ^ (size.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)))
    content = _mix(content + h[start + np.minimum(52, size - 64)])
    content = _mix(content + h[start + size - 64] + (owner[start] - start).astype(np.uint64))
    return start, length, gram[owner[start]].astype(np.int64), content.astype(np.int64)


RUNS = "h long not null, c long, doc_id long, f long, row long, lo int, n int"


def _batches(rows: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of (doc_id, (file, row), offset, bytes) of bounded size; a huge text comes in pieces that
    overlap by WIDTH - 1 bytes, so that every window is in exactly one."""
    some, size = [], 0
    for batch in rows:
        for doc_id, f, row, text in zip(*(c.to_pylist() for c in batch.columns)):
            data = text.encode("utf-8", "surrogatepass")
            for a in range(0, max(1, len(data) - WIDTH + 1), BATCH_BYTES):
                piece = data[a:a + BATCH_BYTES + WIDTH - 1]
                if len(piece) < WIDTH:
                    continue
                some.append((doc_id, (f, row), a, piece))
                size += len(piece)
                if size >= BATCH_BYTES:
                    yield some
                    some, size = [], 0
    if some:
        yield some


def find_runs(docs: DataFrame) -> DataFrame:
    """One row per run (c null: ``n`` windows from ``lo`` on already known to start earlier)."""

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _batches(rows):
            some.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
            ends = np.cumsum([len(x[3]) for x in some])
            start, n, h, c = runs(np.frombuffer(b"".join(x[3] for x in some), np.uint8), ends)
            which = np.searchsorted(ends, start, side="right")
            shift = np.array([x[2] for x in some]) - (ends - np.array([len(x[3]) for x in some]))
            lo = start + shift[which]
            order = np.lexsort((np.arange(len(c)), c, h))
            again = np.zeros(len(c), bool)
            again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (c[order[1:]] == c[order[:-1]])
            # neighbouring repeated runs of one document become one row
            joins = np.zeros(len(c), bool)
            joins[1:] = again[1:] & again[:-1] & (which[1:] == which[:-1]) & (lo[1:] == lo[:-1] + n[:-1])
            group = np.cumsum(~joins) - 1
            total = np.bincount(group, weights=n, minlength=group[-1] + 1 if len(group) else 0).astype(np.int32)
            head = np.flatnonzero(~joins)
            ids = pa.array([x[0] for x in some], pa.int64()).take(pa.array(which[head]))
            names = np.array([x[1] for x in some], np.int64)[which[head]].reshape(-1, 2)
            spread = _mix(names.sum(1).astype(np.uint64) + lo[head].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.where(again[head], spread, h[head])), pa.array(c[head], mask=again[head]), ids, pa.array(names[:, 0]), pa.array(names[:, 1]),
                pa.array(lo[head].astype(np.int32)), pa.array(total)], names=["h", "c", "doc_id", "f", "row", "lo", "n"])

    return docs.mapInArrow(work, RUNS)


def ranks(data: np.ndarray) -> np.ndarray:
    """Rank of every suffix by its first WIDTH bytes (beyond the end counts as smallest)."""
    n = len(data)
    wide = np.zeros(n + 8, np.uint64)
    wide[:n] = data.astype(np.uint64) + np.uint64(1)
    key = np.zeros(n, np.uint64)
    for k in range(4):
        key = key * np.uint64(512) + wide[k:n + k]
    rank = np.unique(key, return_inverse=True)[1].astype(np.uint64) + np.uint64(1)
    width = 4
    while width < WIDTH:
        step = min(width, WIDTH - width)
        later = np.zeros(n, np.uint64)
        later[:n - step] = rank[step:]
        rank = np.unique((rank << np.uint64(32)) | later, return_inverse=True)[1].astype(np.uint64) + np.uint64(1)
        width += step
    return rank


def longest_previous(pieces: list[bytes]) -> list[np.ndarray]:
    """Per piece, for each of its windows, whether an earlier piece (in list order) holds it."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    begins = np.cumsum(sizes) - sizes
    n = sizes - WIDTH + 1
    starts = np.repeat(begins - (np.cumsum(n) - n), n) + np.arange(n.sum())
    rank = ranks(data)[starts]
    order = np.argsort(rank, kind="stable")  # suffix order, ties by position
    found = np.zeros(len(starts), bool)
    found[order[1:]] = rank[order[1:]] == rank[order[:-1]]  # the previous smaller position has the same 100 bytes
    return np.split(found, np.cumsum(n)[:-1])


def _edges(rows: DataFrame) -> DataFrame:
    """rows (h, doc_id, f, row, lo, bytes) -> (f, row, lo, n) of windows that start earlier."""

    def settle(some: list[tuple]) -> pa.RecordBatch:
        out = []
        for (_, f, row, lo, _), found in zip(some, longest_previous([x[4] for x in some])):
            change = np.flatnonzero(np.diff(np.concatenate([[0], found.astype(np.int8), [0]])))
            out += [(f, row, lo + a, b - a) for a, b in zip(change[::2].tolist(), change[1::2].tolist())]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(
            (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["f", "row", "lo", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, size = [], 0
        for batch in batches:
            for h, f, row, lo, data in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= BATCH_BYTES // 4 and h != some[-1][0]:
                    yield settle(some)
                    some, size = [], 0
                some.append((h, f, row, lo, data))
                size += len(data)
        if some:
            yield settle(some)

    spread = rows.repartition("h").sortWithinPartitions("h", F.col("doc_id").asc_nulls_first(), "f", "row", "lo")
    return spread.select("h", "f", "row", "lo", "data").mapInArrow(work, "f long, row long, lo int, n int")


def _crowded(rows: DataFrame) -> DataFrame:
    """rows (doc_id, f, row, want, text), want: (h, lo, n) of runs of crowded owners -> (f, row, lo, n)
    of windows that start earlier."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, first, out = batch.slice(at, 512), {}, []
                few = list(zip(*(c.to_pylist() for c in part.columns)))
                few.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
                for doc_id, f, row, want, text in few:
                    data = text.encode("utf-8", "surrogatepass")
                    for lo in sorted(x for w in want for x in range(w["lo"], w["lo"] + w["n"])):
                        key = hashlib.blake2b(data[lo:lo + WIDTH], digest_size=16).digest()
                        out.append((None if key in first else key, doc_id, f, row, lo))
                        first.setdefault(key, True)
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(
                    (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()))], names=["key", "doc_id", "f", "row", "lo"])

    windows = rows.mapInArrow(work, "key binary, doc_id long, f long, row long, lo int").select(
        F.col("key").isNull().alias("again"), F.coalesce("key", F.concat_ws(" ", "f", "row", "lo").cast("binary")).alias("key"), "doc_id", "f", "row", "lo")
    same = Window.partitionBy("key").orderBy("again", F.col("doc_id").asc_nulls_first(), "f", "row", "lo")
    return (windows.withColumn("k", F.row_number().over(same)).where(F.col("again") | (F.col("k") > 1))
            .select("f", "row", "lo", F.lit(1).alias("n")))


def repeated(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(sf, sr, spans): per document with any, the (lo, n) window ranges that start earlier.
    ``docs``: doc_id, f, row, text."""
    found = find_runs(docs.select("doc_id", "f", "row", "text"))
    # one exchange, by (h, c), serves the three uses of ``marked``: all take the same columns of it
    same = Window.partitionBy("h", "c").orderBy(F.col("doc_id").asc_nulls_first(), "at")
    marked = (found.select("h", "c", "doc_id", F.struct("f", "row", "lo", "n").alias("at"))
              .withColumn("k", F.greatest(F.row_number().over(same), F.when(F.col("c").isNull(), 2).otherwise(1))))
    # a run that stands first meets its owner's other runs if there are any: counted on the map side,
    # joined (a join is split where an owner is hot, a window by owner would be one task)
    owners = (marked.groupBy("h").agg(F.count_if(F.col("k") == 1).alias("several"), F.count("c").alias("all")).where(F.col("several") > 1)
              .select(F.col("h").alias("oh"), (F.col("all") > crowd).alias("crowded")))
    firsts = marked.where(F.col("k") == 1).select("h", "doc_id", "at").join(owners, F.col("h") == F.col("oh"))
    known = marked.where(F.col("k") > 1).select("at.*", "doc_id", F.lit(1).alias("known"), F.lit(None).cast("long").alias("h"))
    kept = known.unionByName(firsts.select("at.*", "doc_id", F.when(F.col("crowded"), 2).otherwise(0).alias("known"), "h")).checkpoint(eager=True)
    wanted = F.struct("h", "lo", "n")
    open_ = kept.where(F.col("known") != 1).groupBy(F.col("f").alias("rf"), F.col("row").alias("r")).agg(
        F.collect_list(F.when(F.col("known") == 0, wanted)).alias("want"), F.collect_list(F.when(F.col("known") == 2, wanted)).alias("crowd"))
    # the same exchange of texts by row serves here and for the result: equal columns, equal order
    with_text = docs.join(open_, (F.col("f") == F.col("rf")) & (F.col("row") == F.col("r")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                f, row, doc_id, want, text = (c[k].as_py() for c in batch.columns)
                data = text.encode("utf-8", "surrogatepass")
                yield pa.RecordBatch.from_arrays([
                    pa.array([w["h"] for w in want], pa.int64()), pa.array([doc_id] * len(want), pa.int64()),
                    pa.array([f] * len(want), pa.int64()), pa.array([row] * len(want), pa.int64()), pa.array([w["lo"] for w in want], pa.int32()),
                    pa.array([data[w["lo"]:w["lo"] + w["n"] + WIDTH - 1] for w in want], pa.binary())],
                    names=["h", "doc_id", "f", "row", "lo", "data"])

    pieces = (with_text.where(F.size("want") > 0).select("f", "row", "doc_id", "want", "text")
              .mapInArrow(cut, "h long, doc_id long, f long, row long, lo int, data binary"))
    every = kept.where(F.col("known") == 1).select("f", "row", "lo", "n").union(_edges(pieces))
    if kept.where(F.col("known") == 2).limit(1).count():
        every = every.union(_crowded(with_text.where(F.size("crowd") > 0).select("doc_id", "f", "row", "crowd", "text")))
    return every.groupBy("f", "row").agg(F.sort_array(F.collect_list(F.struct("lo", "n"))).alias("spans")).select(
        F.col("f").alias("sf"), F.col("row").alias("sr"), "spans")


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, f, row (hash of the file, place in it) and text."""
    try:
        rows = docs.select("*", F.col("_metadata.file_path").alias(f"{OWN}file"), F.col("_metadata.row_index").alias(f"{OWN}row"))
    except AnalysisException:  # not a scan of files
        path = f"{ensure_checkpoint_dir(docs.sparkSession)}/texts-{uuid.uuid4().hex}"
        docs.select("doc_id", "text").write.parquet(path)
        return _named(docs.sparkSession.read.parquet(path))
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(f"{OWN}file").alias("f"), F.col(f"{OWN}row").alias("row"), text_of().alias("text"))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def without_repeats(docs: DataFrame, with_bytes: bool = True, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes (null without
    ``with_bytes``) of every document."""
    rows = _named(docs)
    spans = repeated(rows, crowd)
    both = rows.join(spans, (F.col("f") == F.col("sf")) & (F.col("row") == F.col("sr")), "left").select("doc_id", "text", "spans.lo", "spans.n")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 128):
                batch, out = whole.slice(at, 128), []
                for text, los, ns in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3))):
                    data = text.encode("utf-8", "surrogatepass")
                    merged: list[list[int]] = []
                    for a, n in zip(los or (), ns or ()):
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], a + n + WIDTH - 1)
                        else:
                            merged.append([a, a + n + WIDTH - 1])
                    ends = [0, *(x for m in merged for x in m), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2]))
                    out.append((len(data), len(data) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept if with_bytes else None))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[k] for x in out], kind) for k, kind in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())))],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return both.mapInArrow(work, RESULT)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir), with_bytes=False).drop("kept")
