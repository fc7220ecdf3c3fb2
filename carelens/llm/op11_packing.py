"""Best-fit packing of documents into sequences, by patterns fitted to the histogram of lengths.

Every document is its token ids and a closing 0; documents over ``LIMIT`` tokens are cut into
pieces of ``LIMIT``, the first taking the rest.  Packing works on the histogram of piece lengths,
at most ``LIMIT`` rows, whatever the number of documents:

* patterns of one, two or three lengths that fill a sequence exactly are listed (all pairs; of the
  triples those whose least length is on a grid, some 20,000 patterns);
* repeat counts x >= 0 with A x close to the histogram are fitted by accelerated projected gradient
  steps on the squares of the difference (non-negative least squares);
* the counts are rounded down, patterns with most repeats first, as far as pieces are left;
* what is left is packed best fit, longest first, again by length and count: a step fills either
  all pieces of a length or all sequences with the same room, so the number of steps depends on
  ``LIMIT`` alone.

The plan is a list of slots (length, first rank, last rank, sequence, offset), of a size bounded by
the patterns and steps (some MB at most), sent to every task; a piece finds its slot by its length
and its rank among the pieces of its length.  Ranks come from one range partitioning by length, so
a length that a third of all pieces have is spread.

Ids are those of the tokenizer file's library; very long texts are encoded in slices, cut before a
blank between other characters, where the tokenizer's own pattern must cut.

Defined cases: null text is empty: one piece of one id; documents with equal doc_id are packed each
for itself; ties of length are packed in the order of doc_id, then ids; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, numbered, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMIT, CLOSING = 2048, 0
SLICE = 1 << 20  # code points encoded at once
GRID, STEPS = 32, 300
#: Unicode white space, and the tokenizer's own pattern (fixed values).
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BETWEEN = re.compile(f"[^{WHITE}] (?=[^{WHITE}])")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _alphabet() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for what follows 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of texts, as the library for the file gives them without added special tokens.

    A byte-level file whose merges stand in the order of their ids is read as ranks of byte
    strings, which another library merges several times faster to the same ids; any other file,
    and its settings, are left to its own library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model, ahead = made["model"], made.get("pre_tokenizer") or {}
        vocab, added = model.get("vocab", {}), made.get("added_tokens") or []
        merged = [vocab.get("".join(m if isinstance(m, list) else m.split(" "))) for m in model.get("merges", [])]
        self.ranks = self.whole = None
        if (model.get("type") == "BPE" and ahead.get("type") == "ByteLevel" and ahead.get("use_regex") and not ahead.get("add_prefix_space")
                and not made.get("normalizer") and not made.get("truncation") and not made.get("padding")
                and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
                and None not in merged and all(a < b for a, b in zip(merged, merged[1:]))
                and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or " " in t["content"] for t in added)):
            import tiktoken

            byte, special = _alphabet(), {t["content"]: t["id"] for t in added}
            self.ranks = tiktoken.Encoding("merges", pat_str=PATTERN, special_tokens=special, mergeable_ranks={
                bytes(byte[c] for c in k): v for k, v in vocab.items() if k not in special})
        else:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(path)

    def __call__(self, text: str) -> np.ndarray:
        if self.whole:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.concatenate([self.ranks.encode_to_numpy(part, allowed_special="all") for part in slices(text)])


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """Parts of some ``size`` code points, cut before a blank between other characters."""
    at = 0
    while len(text) - at > size:
        cut = BETWEEN.search(text, at + size)
        if not cut:
            break
        yield text[at:cut.start() + 1]
        at = cut.start() + 1
    yield text[at:]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


def pieces(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, piece, start, length and checksum of every piece of every document."""
    path = path or default_tokenizer()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                part, out = whole.slice(k, 512), []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = np.append(encode(text.as_py()), np.uint32(CLOSING)).astype("<u4")
                    first = (len(ids) - 1) % limit + 1
                    for j, end in enumerate(range(first, len(ids) + 1, limit)):
                        start = max(0, end - limit) if j else 0
                        out.append((doc_id, j, start, end - start, zlib.crc32(ids[start:end].tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], kind) for c, kind in enumerate(
                    (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(work, PIECES)


def patterns(lengths: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Rows of up to three lengths (0: none) that fill a sequence and occur among ``lengths``."""
    there = np.zeros(limit + 1, bool)
    there[lengths] = there[0] = True
    made = [np.array([[limit, 0, 0]])]
    for c in [0, 1, *range(GRID, limit // 3 + 1, GRID)]:
        b = np.arange(max(c, 1), (limit - c) // 2 + 1)
        made.append(np.stack([limit - c - b, b, np.full_like(b, c)], 1))
    all_ = np.concatenate(made)
    return all_[there[all_].all(1)]


def fit(kinds: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeats x >= 0 of the patterns with least sum of squares of (A x - counts)."""
    wide, n = len(counts), len(kinds)
    if not n:
        return np.zeros(0)
    target = counts.astype(float).copy()
    target[0] = 0
    real = (kinds > 0).astype(float)

    def times(x: np.ndarray) -> np.ndarray:
        return np.bincount(kinds.ravel(), (real * x[:, None]).ravel(), wide)

    def back(y: np.ndarray) -> np.ndarray:
        return (real * y[kinds]).sum(1)

    v = np.ones(n)
    for _ in range(20):  # the largest eigenvalue bounds the step
        v = back(times(v))
        v /= np.linalg.norm(v)
    step = 1 / (1.05 * np.linalg.norm(back(times(v))))
    x = ahead = np.zeros(n)
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, ahead - step * back(times(ahead) - target))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def plan(counts: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, int]:
    """Slots for ``counts[length]`` pieces, and the number of sequences.  A slot row is (length,
    first rank, rank after the last, pieces to a sequence, first sequence, offset)."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    taken = np.zeros(limit + 1, np.int64)
    slots: list[tuple[int, ...]] = []
    sequences = 0

    def put(length: int, sets: int, each: int, first: int, offset: int) -> None:
        n = sets * each
        slots.append((length, taken[length], taken[length] + n, each, first, offset))
        taken[length] += n
        left[length] -= n

    kinds = patterns(np.flatnonzero(left), limit)
    x = np.floor(fit(kinds, left) + 1e-6).astype(np.int64)
    for k in np.argsort(-x, kind="stable"):
        need: dict[int, int] = defaultdict(int)
        for length in kinds[k].tolist():
            need[length] += length > 0
        n = min([int(x[k]), *(int(left[a]) // m for a, m in need.items() if m)])
        if n > 0:
            offset = 0
            for length, m in need.items():
                if m:
                    put(length, n, m, sequences, offset)
                    offset += length * m
            sequences += n
    # best fit, longest first: sequences of equal room stand together as (first, number, used)
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for length in range(limit, 0, -1):
        while left[length]:
            room = next((r for r in range(length, limit) if rooms.get(r)), None)
            if room is None:
                each = min(limit // length, int(left[length]))
                n = int(left[length]) // each
                first, free = sequences, limit
                sequences += n
            else:
                first, n = rooms[room].pop()
                each, free = min(room // length, int(left[length])), room
                some = min(n, int(left[length]) // each)
                if some < n:
                    rooms[room].append((first + some, n - some))
                n = some
            put(length, n, each, first, limit - free)
            if free > length * each:
                rooms[free - length * each].append((first, n))
    return np.array(slots, np.int64).reshape(-1, 6), sequences


def packed(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    found = pieces(docs, path, limit).checkpoint(eager=True).withColumn("copy", F.monotonically_increasing_id())
    made = numbered(found, ["length"], ["doc_id", "ids_crc32", "piece", "copy"], "rank").drop("copy").checkpoint(eager=True)
    counts = np.zeros(limit + 1, np.int64)
    for length, n in made.groupBy("length").agg(F.max("rank") + 1).collect():  # at most ``limit`` rows
        counts[length] = n
    slots, _ = plan(counts, limit)
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
    shared = docs.sparkSession.sparkContext.broadcast(slots)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        starts = (slots[:, 0].astype(np.int64) << 48) + slots[:, 1]
        for batch in batches:
            length, rank = batch.column(3).to_numpy().astype(np.int64), batch.column(5).to_numpy()
            at = slots[np.searchsorted(starts, (length << 48) + rank, side="right") - 1] if len(length) else slots[:0]
            k = rank - at[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(length), batch.column(4), pa.array(at[:, 4] + k // at[:, 3]), pa.array(at[:, 5] + k % at[:, 3] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return made.mapInArrow(work, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir))
