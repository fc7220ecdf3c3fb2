"""Token counts of whole texts by a given tokenizer, huge documents by overlap resynchronisation.

In a document up to ``chunk`` code points, ASCII white space is such a place throughout if the
tokenizer drops it: no pre-token, special token or normalisation reaches across it, so the count is
the sum over its words, and words seen before are remembered (bounded).  With a tokenizer that
keeps white space (byte-level ones) the document is encoded whole.  A longer document is encoded in
chunks that overlap; two neighbours are spliced where both have a token boundary at the same
place, proven stable: the boundary lies at white space (no pre-token, special token or
normalisation reaches across it), and the ``agree`` tokens on either side are the same in both.
Tokens left of the splice are counted in the left chunk, the others in the right one.  If no
boundary qualifies, the overlap is doubled, until the rest of the document is one chunk - then
nothing is left to splice.  Memory is bounded by a chunk (a document that never aligns excepted).

Everything happens in a map over Arrow batches: no shuffle, texts never leave their task, a lost
task is simply run again.

Defined cases: null or empty text has 0 bytes and 0 tokens; repeated rows count alike; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMIT = 2048
CHUNK = 32_768
CACHE = 400_000
OVERLAP = 256
AGREE = 2
_LOADED: dict = {}
_ASCII_WORD = re.compile(r"[^\x20\x09-\x0D]+").findall


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load(path: str):
    """The tokenizer without truncation and padding; one per worker."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _LOADED[path] = t
    return _LOADED[path]


def drops_blanks(tokenizer) -> bool:
    """Whether ASCII white space only parts pre-tokens and is in none of them."""
    words, text = [], ""
    for k, blank in enumerate(c * n for c in " \t\n\x0b\x0c\r" for n in (1, 2)):
        words.append("ab" if k % 2 else "cd")
        text += blank + words[-1]
    text += " \n"
    if tokenizer.normalizer is not None:
        text = tokenizer.normalizer.normalize_str(text)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return (tokenizer.pre_tokenizer is not None and not any(c.isspace() for t in added for c in t)
            and [w for w, _ in tokenizer.pre_tokenizer.pre_tokenize_str(text)] == words)


def _encode(tokenizer, text: str, start: int) -> list[tuple[int, int, int]]:
    """(id, from, to) with places in the whole document."""
    e = tokenizer.encode(text, add_special_tokens=False)
    return [(i, a + start, b + start) for i, (a, b) in zip(e.ids, e.offsets)]


def splice(left: list, right: list, text: str, agree: int = AGREE) -> tuple[int, int] | None:
    """(tokens of left that count, tokens of right that don't), or None if nothing is stable."""
    place = {t[1]: k for k, t in enumerate(right)}
    for i in range(len(left) - agree, agree - 1, -1):
        start = left[i][1]
        j = place.get(start)
        if j is None or j < agree or j + agree > len(right) or start == 0 or not text[start - 1].isspace():
            continue
        if left[i - 1][2] < start and right[j - 1][2] < start and left[i - agree:i + agree] == right[j - agree:j + agree]:
            return i, j
    return None


def count_long(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP, agree: int = AGREE) -> int:
    total, start, size, n = 0, 0, chunk, len(text)
    left, skip = _encode(tokenizer, text[:size], 0), 0
    while start + size < n:
        wide = overlap
        while True:
            begin = max(start, start + size - wide)
            step = max(chunk, 2 * wide)
            if begin <= start:  # the overlap has eaten the left chunk: encode both as one
                size *= 2
                left = _encode(tokenizer, text[start:start + size], start)
                # what was spliced off before stays off: find it again from the left
                skip = _skipped(left, mark) if start else 0
                break
            right = _encode(tokenizer, text[begin:begin + step], begin)
            at = splice(left, right, text, agree)
            if at and at[0] >= skip:
                total += at[0] - skip
                mark = right[at[1]][1]
                left, skip, start, size = right, at[1], begin, step
                break
            wide *= 2
    return total + len(left) - skip


def _skipped(tokens: list, mark: int) -> int:
    return next((k for k, t in enumerate(tokens) if t[1] >= mark), len(tokens))


class WordCounts:
    """Tokens per word, unseen words encoded together and told apart by their offsets."""

    def __init__(self, tokenizer, most: int = CACHE):
        self.tokenizer, self.most, self.known = tokenizer, most, {}

    def learn(self, words: list[str]) -> None:
        for k in range(0, len(words), 2000):
            part = words[k:k + 2000]
            starts = np.cumsum([0] + [len(w) + 1 for w in part])
            places = np.array([a for a, _ in self.tokenizer.encode(" ".join(part), add_special_tokens=False).offsets], dtype=np.int64)
            per_word = np.bincount(np.searchsorted(starts, places, side="right") - 1, minlength=len(part))
            self.known.update(zip(part, per_word.tolist()))

    def __call__(self, texts: list[str]) -> list[int]:
        split = [_ASCII_WORD(t) for t in texts]
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        self.learn(list({w for words in split for w in words if w not in known}))
        return [sum(map(known.__getitem__, words)) for words in split]


def counter(path: str | None = None, chunk: int = CHUNK):
    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = load(path or default_tokenizer())
        words = WordCounts(tokenizer) if drops_blanks(tokenizer) else lambda texts: [len(_encode(tokenizer, t, 0)) for t in texts]
        for texts in batches:
            out = []
            for k in range(0, len(texts), 256):
                part = list(texts.iloc[k:k + 256])
                sizes = words([t if len(t) <= chunk else "" for t in part])
                out += [n if len(t) <= chunk else count_long(tokenizer, t, chunk) for t, n in zip(part, sizes)]
            yield pd.Series(out, dtype="int64")

    return count


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, chunk: int = CHUNK) -> DataFrame:
    text = text_of()
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), counter(path, chunk)(text).alias("n_tokens"))
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
