"""SentencePiece encoding and decoding over a word lattice.

The model file gives the piece table (normal pieces with scores, byte pieces, white space as
U+2581, a dummy blank in front).  A text falls into segments: a run of blanks with the word after
it.  No piece holds a blank after a non-blank, so segments are independent.  Per segment the
lattice holds every substring of bounded length that is a piece, keyed by its ends - the
equi-join of substrings and piece table.  The given model is of the BPE kind: its scores are
merge ranks, and the right result isn't the best-scoring path but the outcome of taking, again
and again, the best-ranked edge that joins two neighbours.  So the fold over the lattice applies
merges in that order where a unigram model would run Viterbi; ``kind="unigram"`` folds Viterbi.
Characters without a piece become their byte pieces.

The lattice is built in the tasks (Arrow batches, distinct segments remembered in a bounded
cache) rather than as rows: the README has the figures.  No shuffle, so nothing is skewed, and
a lost task is run again.

Defined cases: null or empty text has no pieces; repeated rows are encoded alike; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Callable, Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANK = "▁"
CACHE = 400_000
_LOADED: dict = {}
_SEGMENT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Folded(dict):
    """Segment -> ids, folded when first asked for; bounded, and only segments of usual length stay."""

    def __init__(self, fold: Callable[[str], list[int]]):
        self.fold = fold

    def __missing__(self, segment: str) -> tuple[int, ...]:
        ids = tuple(self.fold(segment))
        if len(self) >= CACHE:
            self.clear()
        if len(segment) <= 64:
            self[segment] = ids
        return ids


class Pieces:
    """The piece table of a model file, its segments' lattices and their folds."""

    def __init__(self, path: str, kind: str = "bpe"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)  # only read as a table
        self.fold = {"bpe": self._merge, "unigram": self._viterbi}[kind]
        size, special = model.get_piece_size(), {}
        self.table: dict[str, tuple[float, int]] = {}
        self.text: list[str] = [model.id_to_piece(i) for i in range(size)]
        self.byte: dict[int, int] = {}
        for i, p in enumerate(self.text):
            if model.is_byte(i):
                self.byte[int(p[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.table[p] = (model.get_score(i), i)
            else:
                special[i] = p
        self.of_byte = {i: b for b, i in self.byte.items()}
        self.special, self.unknown = special, model.unk_id()
        self.longest = max(map(len, self.table), default=1)
        self.shown = ["" if i in special else p for i, p in enumerate(self.text)]
        self.names = [str(i) for i in range(size)]
        self.cache = Folded(self.fold)

    def lattice(self, segment: str) -> dict[tuple[int, int], tuple[float, int]]:
        """(from, to) -> (score, id) of every substring that is a piece."""
        n, table = len(segment), self.table
        found = {}
        for a in range(n):
            for b in range(a + 1, min(n, a + self.longest) + 1):
                hit = table.get(segment[a:b])
                if hit:
                    found[a, b] = hit
        return found

    def _bytes(self, piece: str) -> list[int]:
        return [self.byte.get(b, self.unknown) for b in piece.encode("utf-8", "replace")]

    def _merge(self, segment: str) -> list[int]:
        """Best-scoring joining edge first, leftmost among equals.  In a short segment the edges
        are looked up as their two halves meet; a long one orders its lattice in a heap."""
        if len(segment) <= 24:
            return self._merge_short(segment)
        import heapq

        edges, n = self.lattice(segment), len(segment)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the symbol that starts at a place
        heap = [(-edges[a, a + 2][0], a, a + 1, a + 2) for a in range(n - 1) if (a, a + 2) in edges]
        heapq.heapify(heap)
        alive = [True] * n

        def offer(a: int) -> None:
            m = end[a]
            if m < n and (a, end[m]) in edges:
                heapq.heappush(heap, (-edges[a, end[m]][0], a, m, end[m]))

        while heap:
            _, a, m, b = heapq.heappop(heap)
            if not (alive[a] and end[a] == m and alive[m] and end[m] == b):
                continue
            alive[m], end[a] = False, b
            if b < n:
                before[b] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        out: list[int] = []
        a = 0
        while a < n:
            b = end[a]
            out += [edges[a, b][1]] if (a, b) in edges else self._bytes(segment[a:b])
            a = b
        return out

    def _merge_short(self, segment: str) -> list[int]:
        table, none = self.table, (float("-inf"), -1)
        parts = list(segment)
        score = [table.get(a + b, none)[0] for a, b in zip(parts, parts[1:])]
        while score:
            best = max(score)
            if best == none[0]:
                break
            i = score.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del score[i]
            if i:
                score[i - 1] = table.get(parts[i - 1] + parts[i], none)[0]
            if i < len(score):
                score[i] = table.get(parts[i] + parts[i + 1], none)[0]
        return [x for p in parts for x in ([table[p][1]] if p in table else self._bytes(p))]

    def _viterbi(self, segment: str) -> list[int]:
        """The path of the highest sum of scores; a character without a piece costs 10 below the least."""
        edges, n = self.lattice(segment), len(segment)
        worst = min((s for s, _ in self.table.values()), default=0.0) - 10
        best: list[tuple[float, int]] = [(0.0, -1)] + [(float("-inf"), -1)] * n
        by_end: dict[int, list[tuple[int, float]]] = {}
        for (a, b), (s, _) in edges.items():
            by_end.setdefault(b, []).append((a, s))
        for b in range(1, n + 1):
            for a, s in [*sorted(by_end.get(b, ())), *([] if (b - 1, b) in edges else [(b - 1, worst)])]:
                if best[a][0] + s > best[b][0]:
                    best[b] = (best[a][0] + s, a)
        out: list[list[int]] = []
        b = n
        while b > 0:
            a = best[b][1]
            out.append([edges[a, b][1]] if (a, b) in edges else self._bytes(segment[a:b]))
            b = a
        return [i for part in reversed(out) for i in part]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        segments = _SEGMENT.findall(BLANK + text.replace(" ", BLANK))
        return list(chain.from_iterable(map(self.cache.__getitem__, segments)))

    def digest(self, ids: list[int]) -> str:
        return hashlib.sha256(",".join(map(self.names.__getitem__, ids)).encode()).hexdigest()

    def decode(self, ids: list[int]) -> str:
        if self.of_byte.keys().isdisjoint(ids):
            text = "".join(map(self.shown.__getitem__, ids))
        else:
            out, run = [], bytearray()
            for i in ids:
                b = self.of_byte.get(i)
                if b is not None:
                    run.append(b)
                    continue
                if run:
                    out.append(run.decode("utf-8", "replace"))
                    run.clear()
                out.append(self.shown[i])
            out.append(run.decode("utf-8", "replace"))
            text = "".join(out)
        text = text.replace(BLANK, " ")
        return text[1:] if text.startswith(" ") else text


def pieces(path: str | None, kind: str) -> Pieces:
    path = path or default_model()
    if (path, kind) not in _LOADED:
        _LOADED[path, kind] = Pieces(path, kind)
    return _LOADED[path, kind]


SCHEMA = "doc_id long, n_bytes long, n_pieces long, ids array<int>, ids_sha256 string, round_trip boolean"


def encoded(docs: DataFrame, path: str | None = None, kind: str = "bpe", rows: int = 128) -> DataFrame:
    """doc_id, n_bytes, n_pieces, ids, ids_sha256 (of the ids joined by commas) and round_trip:
    whether decoding gives the text back (with U+2581 as a blank)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, kind)
        for whole in batches:
            for k in range(0, whole.num_rows, rows):
                batch = whole.slice(k, rows)
                texts = batch.column(1).to_pylist()
                ids = [model.encode(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                    pa.array([model.digest(x) for x in ids], pa.string()),
                    pa.array([model.decode(x) == t.replace(BLANK, " ") for x, t in zip(ids, texts)], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_pieces", "ids", "ids_sha256", "round_trip"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(work, SCHEMA)


def decoded(rows: DataFrame, path: str | None = None, ids: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with the text of the column of piece ids; null ids give the empty text."""
    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = pieces(path, "bpe")
        for batch in batches:
            yield pd.Series([model.decode([] if x is None else list(x)) for x in batch])

    return rows.withColumn(out, text(F.col(ids)))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(documents(spark, sf_dir))
