"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Training sees at most ``max_rows`` examples, an example being a different text of a doc_id with a
label of it (smallest seeded hash of doc_id, the documented bound, which holds after the join with
the documents however often a doc_id or a label repeats), never those whose crc32(doc_id) mod 4 is
2; of each the hashed counts of its 1- and 2-grams, made on the executors: 8 bytes a bucket that it
uses, so at most 2 MB an example at 2^18 buckets and some 4 kB for a page of 500 words.  FTRL-proximal needs its examples in
order, so that bounded sample is the one thing gathered; the result is one weight per bucket
(``2 ** bits`` floats, 1 MB), which goes to the tasks with the scoring function.  Scoring is a
map over all documents: a sparse dot product of a document's n-gram weights, no shuffle, one
Arrow batch at a time.

Features are lower-cased words and their neighbours, plus shape buckets of a word (capitals,
marks); a count c weighs log(1 + c), scaled to unit length.  The threshold and the parameters
are the same at every size.

Defined cases: null or empty text scores by the bias alone; different labels of one doc_id, and
different texts of it, count as several examples, equal ones as one, null labels or ids teach nothing; without any label all scores are 0.5;
repeated rows score alike; extra columns are ignored (``reject_low`` keeps them).
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import OWN, documents, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 18
MAX_ROWS = 6_000
EPOCHS = 6
THRESHOLD = 0.7
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.05, 0.1
SEED = 31
MOST_WORDS = 200_000  # words a task remembers the hashes of


class Hasher:
    """Text -> (bucket, value) arrays.  Words are remembered, as most repeat."""

    def __init__(self, bits: int):
        import re
        import zlib

        self.shift, self.mask, self.known = np.uint64(64 - bits), (1 << bits) - 1, {}
        self.words, self.crc = re.compile(r"[^\x20\x09-\x0D]+").finditer, zlib.crc32

    def _word(self, w: str) -> tuple[int, int]:
        low = w.lower()
        shape = "A" if w.isupper() and len(w) > 1 else "a" if w == low else "Aa"
        shape += "".join(sorted({c for c in w if not c.isalnum()}))[:4] + str(min(9, len(w)))
        out = (self.crc(low.encode("utf-8", "surrogatepass")) + 1, self.crc(("\0" + shape).encode("utf-8", "surrogatepass")) + 1)
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        self.known[w] = out
        return out

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        known, word = self.known, self._word
        pairs = [known.get(m[0]) or word(m[0]) for m in self.words(text or "")]
        if not pairs:
            return np.empty(0, np.int64), np.empty(0)
        ids = np.array(pairs, dtype=np.uint64)
        grams = np.concatenate([ids[:, 0], ids[:, 1], ids[:-1, 0] * np.uint64(31) + ids[1:, 0] + np.uint64(7),
                                ids[:-1, 1] * np.uint64(37) + ids[1:, 1] + np.uint64(11)])
        grams = (grams * np.uint64(0x9E3779B97F4A7C15)) >> self.shift
        bucket, count = np.unique(grams.astype(np.int64), return_counts=True)
        value = np.log1p(count)
        return bucket, value / np.sqrt((value * value).sum())


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """FTRL-proximal over the examples in the given order.  Returns weights and bias."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    if not examples:
        return np.zeros(size, np.float32), 0.0
    def weights(i: np.ndarray | slice) -> np.ndarray:
        zi = z[i]
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(epochs):
        for bucket, value, y in examples:
            i, x = np.append(bucket, size).astype(np.int64), np.append(value, 1.0).astype(float)
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(slice(None))
    return w[:-1].astype(np.float32), float(w[-1])


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS, max_rows: int = MAX_ROWS, seed: int = SEED) -> tuple[np.ndarray, float]:
    """Weights and bias from a bounded sample of the labelled documents."""
    own, label = f"{OWN}d", labels.select("doc_id", F.col("quality").alias("y"))
    marks = label.where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).distinct()
    order = [F.xxhash64(F.lit(seed), F.col("doc_id")), "doc_id", "y"]
    texts = docs.select(F.col("doc_id").alias(own), text_of().alias("text")).select(
        own, F.xxhash64("text").alias("a"), F.xxhash64(F.lit(seed), "text").alias("b"), "text")
    # no more labels than examples can be of use; then the examples themselves are cut, by narrow rows
    marks = marks.orderBy(*order).limit(max_rows)
    marked = texts.join(marks, F.col(own) == F.col("doc_id"))
    picked = marked.select("doc_id", "y", "a", "b").distinct().orderBy(*order, "a", "b").limit(max_rows).select(
        "doc_id", "y", F.col("a").alias("pa"), F.col("b").alias("pb"))
    rows = texts.join(picked, (F.col(own) == F.col("doc_id")) & (F.col("a") == F.col("pa")) & (F.col("b") == F.col("pb"))) \
        .dropDuplicates(["doc_id", "y", "a", "b"])

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Hasher(bits)
        for b in batches:
            both = [features(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "i": [x[0].astype(np.int32).tobytes() for x in both],
                                "x": [x[1].astype(np.float32).tobytes() for x in both]})

    made = rows.select("doc_id", "y", "text").mapInPandas(hashed, "doc_id long, y int, i binary, x binary")
    rng = np.random.default_rng(seed)
    got = sorted((r.doc_id, r.y, bytes(r.i), bytes(r.x)) for r in made.toLocalIterator())  # at most max_rows examples
    examples = [(np.frombuffer(i, np.int32), np.frombuffer(x, np.float32), y) for _, y, i, x in got]  # views, no copies
    return train([examples[k] for k in rng.permutation(len(examples))], bits)


def scorer(weights: np.ndarray, bias: float, bits: int = BITS) -> Callable[[pd.Series], pd.Series]:
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Hasher(bits)
        for batch in texts:
            out = np.empty(len(batch))
            for k, t in enumerate(batch):
                i, x = features(t)
                out[k] = weights[i] @ x + bias if len(i) else bias
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return score


def classify(docs: DataFrame, labels: DataFrame, score_as: str = "score", **options) -> DataFrame:
    """``docs`` with a score column."""
    weights, bias = fit(docs, labels, **options)
    return docs.withColumn(score_as, scorer(weights, bias)(text_of()))


def reject_low(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least ``threshold``, columns as given."""
    return classify(docs, labels, f"{OWN}score").where(F.col(f"{OWN}score") >= threshold).select(*docs.columns)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
