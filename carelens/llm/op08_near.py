"""Near-duplicate documents: BagMinHash signatures, bands, exact check, components.

A document is the multiset of its five-word shingles (all its words as one shingle if fewer).
BagMinHash: for every shingle and every dyadic range of multiplicities (0,1], (1,2], (2,4], ...
below its count, a Poisson process of the range's width sends points, each with a time, a
signature component and a multiplicity inside the range; points above the shingle's count are
passed over.  A component keeps its earliest point, and two documents share it with probability
equal to their weighted Jaccard similarity.  A process stops once its time is past the latest
component, so a document costs about n + m log m points rather than n m.

Texts of equal words are one vertex (128-bit hash, smallest doc_id).  Bands of ``ROWS``
components collide; with 32 bands of 4, a pair at 0.8 misses all with probability 5e-8.  In each
bucket every member is paired with the smallest member and with the one that collides most
(the likely original of a group of copies): linear, never all pairs.  Pairs are checked exactly
on their texts, and linked vertices become components.  A bucket that still holds several
components is looked at again: members outside its largest component meet the members of other
components in blocks of bounded size; where signatures allow the threshold, texts decide in
place, and only the links found are sent on, one per vertex and component.  So a link between different components isn't lost to the stars, and
large groups, being one component by then, cost nothing more.

Components come from alternating large-star and small-star rounds on edges, checkpointed; no
vertex or edge goes to the driver.

Defined cases: a document without words is a class of its own; rows of null doc_id take the class
of the texts of equal words, or null; rows with equal doc_id and different texts are one vertex
with several texts; ties do not arise (the class is the smallest doc_id of its component); an
empty table gives an empty result; ``keep_first`` keeps extra columns.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import OWN, WORD, documents, release, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BANDS, ROWS, WIDTH = 32, 4, 5
PARTS = BANDS * ROWS
MAY_REACH = 0.66  # four standard errors of a signature of 128 below 0.8
BLOCK = 1024
MOST_WORDS = 100_000  # words a task remembers the hashes of
MOST_SHINGLES = 2_000_000  # shingles of the bags a task keeps at hand
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Text -> hashes of its shingles, with repetitions; words are remembered."""

    def __init__(self):
        import xxhash

        self.words, self.hash, self.known = re.compile(WORD).findall, xxhash.xxh3_64_intdigest, {}

    def __call__(self, text: str | None) -> np.ndarray:
        known, hashed = self.known, self.hash
        if len(known) > MOST_WORDS:
            known.clear()
        ids = []
        for w in self.words(text or ""):
            h = known.get(w)
            if h is None:
                h = known[w] = hashed(w.encode("utf-8", "surrogatepass"))
            ids.append(h)
        w = np.array(ids, dtype=np.uint64)
        n = min(WIDTH, len(w))
        if not n:
            return w
        s = np.full(len(w) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            s = _mix(s * GOLDEN + w[k:len(w) - n + 1 + k])
        return s


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], parts: int = PARTS) -> np.ndarray:
    """uint32 (bags, parts): BagMinHash of (elements, counts); a row of an empty bag is 0."""
    n = len(bags)
    doc = np.repeat(np.arange(n), [len(e) for e, _ in bags])
    elements = np.concatenate([e for e, _ in bags] or [np.empty(0, np.uint64)]).astype(np.uint64)
    counts = np.concatenate([c for _, c in bags] or [np.empty(0, np.int64)]).astype(np.int64)
    state, low, width, owner, top = [], [], [], [], []
    lo, w, level = 0, 1, 1
    while (some := counts > lo).any():
        state.append(_mix(elements[some] + np.uint64(level * 0xD1342543DE82EF95 % (1 << 64))))
        low.append(np.full(some.sum(), lo))
        width.append(np.full(some.sum(), w))
        owner.append(doc[some])
        top.append(counts[some])
        lo, w, level = lo + w, lo + w, level + 1
    first = np.full(n * parts, np.inf)
    ident = np.zeros(n * parts, dtype=np.uint32)
    if not state:
        return ident.reshape(n, parts)
    state, low, width, owner, top = map(np.concatenate, (state, low, width, owner, top))
    time = np.zeros(len(state))
    while len(state):
        state = state + GOLDEN
        a = _mix(state)
        time = time - np.log1p(-((a >> np.uint64(11)).astype(np.float64) * 2.0 ** -53)) / width
        b = _mix(a ^ np.uint64(0xA0761D6478BD642F))
        inside = low + 1 + ((b >> np.uint64(8)) % width.astype(np.uint64)).astype(np.int64) <= top
        at = (owner * parts + (b % np.uint64(parts)).astype(np.int64))[inside]
        t = time[inside]
        np.minimum.at(first, at, t)
        won = t == first[at]
        ident[at[won]] = (b[inside][won] >> np.uint64(32)).astype(np.uint32)
        alive = time < first.reshape(n, parts).max(1)[owner]
        state, low, width, owner, top, time = (x[alive] for x in (state, low, width, owner, top, time))
    return ident.reshape(n, parts)


SIGNED = "doc_id long, a long, b long, bands array<long>"


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the words (a, b) and the bands: a signature of 16 bits a component, ``ROWS``
    of them to a long, so that a band is its own key.  No words: null bands."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler()
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                part = whole.slice(k, 256)
                bags, a, b = [], [], []
                for text in part.column(1).to_pylist():
                    s = shingle(text)
                    order = np.arange(1, len(s) + 1, dtype=np.uint64)
                    a.append(np.bitwise_xor.reduce(_mix(s + order * GOLDEN), initial=np.uint64(len(s))))
                    b.append(np.add.reduce(_mix(_mix(s) ^ (order * np.uint64(0xE7037ED1A0B428DB))), initial=np.uint64(len(s))))
                    bags.append(np.unique(s, return_counts=True))
                sig = signatures(bags)
                band = sig.astype(np.uint16).view(np.int64).reshape(len(bags), BANDS)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.array(a, np.uint64).astype(np.int64)), pa.array(np.array(b, np.uint64).astype(np.int64)),
                    pa.array([x if len(e) else None for x, (e, _) in zip(band, bags)], pa.list_(pa.int64()))],
                    names=["doc_id", "a", "b", "bands"])

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # equal hashes of no words: each such row is alone, told apart by null bands
    return text.mapInArrow(work, SIGNED)


def bag_of(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    return (*np.unique(shingles, return_counts=True), len(shingles))


def similar(one: tuple, two: tuple, num: int = 4, den: int = 5) -> bool:
    """Whether the weighted Jaccard similarity of two bags is num / den or more, exactly."""
    (ex, cx, nx), (ey, cy, ny) = one, two
    if den * min(nx, ny) < num * max(nx, ny):
        return False
    at = np.searchsorted(ex, ey)
    at[at == len(ex)] = 0
    same = ex[at] == ey if len(ex) else np.zeros(len(ey), bool)
    shared = int(np.minimum(cx[at[same]], cy[same]).sum())
    return shared > 0 and den * shared >= num * (nx + ny - shared)


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The (x, y) of ``pairs`` whose texts are similar."""
    texts = docs.select(F.col("doc_id").cast("long").alias("i"), text_of().alias("t"))
    one = pairs.join(texts.select(F.col("i").alias("xi"), F.col("t").alias("tx")), F.col("x") == F.col("xi")).select("x", "y", "tx")
    both = one.join(texts.select(F.col("i").alias("yi"), F.col("t").alias("ty")), F.col("y") == F.col("yi")).select("x", "y", "tx", "ty")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, kept, held = Shingler(), {}, 0

        def bag(i: int, text: str) -> tuple:
            nonlocal held
            got = kept.get((i, len(text)))
            if got is None or got[0] != text:
                if held > MOST_SHINGLES:
                    kept.clear()
                    held = 0
                got = kept[i, len(text)] = (text, bag_of(shingle(text)))
                held += got[1][2]
            return got[1]

        for whole in batches:
            for k in range(0, whole.num_rows, 64):
                rows = zip(*(c.to_pylist() for c in whole.slice(k, 64).columns))
                out = [(x, y) for x, y, tx, ty in rows if similar(bag(x, tx), bag(y, ty))]
                yield pa.RecordBatch.from_arrays([pa.array([p[n] for p in out], pa.int64()) for n in (0, 1)], names=["x", "y"])

    return both.mapInArrow(check, "x long, y long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(v, c): every vertex of the edges (x, y) with the smallest vertex of its component."""
    now = edges.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("w")).distinct().checkpoint(eager=True)
    seen = None
    while True:
        # large star: larger neighbours go to the smallest neighbour; small star: the others do
        way = now.union(now.select(F.col("w").alias("u"), F.col("u").alias("w")))
        least = way.groupBy("u").agg(F.min("w").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (way.where(F.col("w") > F.col("u")).join(least, F.col("u") == F.col("k"))
                 .select(F.col("w").alias("u"), F.col("m").alias("w")).distinct())
        lowest = large.groupBy("u").agg(F.min("w").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(lowest, F.col("u") == F.col("k"))
        now = (small.select("u", F.col("m").alias("w")).union(small.where(F.col("w") != F.col("m")).select(F.col("w").alias("u"), F.col("m").alias("w")))
               .distinct().checkpoint(eager=True))
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "w").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        del way, least, large, lowest, small
        release(now.sparkSession)
    return now.select(F.col("u").alias("v"), F.col("w").alias("c")).union(now.select(F.col("w").alias("v"), F.col("w").alias("c"))).distinct()


def _across(members: DataFrame, sigs: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (x, y) between different components that share a bucket.

    Open buckets are taken together by their largest component, each vertex once.  In blocks of
    bounded size, the vertices outside it meet the others; signatures leave those that may reach
    the threshold, texts decide, and each vertex sends on one link per other component.
    """
    key = ["band", "h"]
    per = members.groupBy(*key, "c").agg(F.count(F.lit(1)).alias("n"))
    open_ = (per.groupBy(*key).agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("size"), F.max_by("c", F.struct("n", "c")).alias("main"))
             .where((F.col("parts") > 1) & (F.col("size") > 2))  # the pair of a bucket of two has been checked
             .select(F.col("band").alias("ob"), F.col("h").alias("oh"), "main"))
    group = (members.join(open_, (F.col("band") == F.col("ob")) & (F.col("h") == F.col("oh"))).select("main", "v", "c").distinct())
    blocks = group.groupBy("main").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.greatest(F.lit(1), F.count_if(F.col("c") != F.col("main"))) / BLOCK).cast("int").alias("rounds")).select(F.col("main").alias("bm"), "blocks", "rounds")
    texts = docs.select(F.col("doc_id").cast("long").alias("i"), text_of().alias("t"))
    rows = (group.join(blocks, F.col("main") == F.col("bm")).join(sigs, F.col("v") == F.col("sv"))
            .join(texts, F.col("v") == F.col("i")))
    cols = ["main", "v", "c", "sig", "t"]
    own = lambda n: F.pmod(F.xxhash64("v"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.where(F.col("c") != F.col("main")).select(*cols, own("rounds").alias("i"), every("blocks").alias("j")).toDF(*cols, "i", "j")
    right = rows.select(*cols, own("blocks").alias("j"), every("rounds").alias("i")).toDF(*cols, "j", "i")

    def meet(few: pd.DataFrame, all_: pd.DataFrame) -> pd.DataFrame:
        out, held = [], 0
        if len(few) and len(all_):
            shingle, bags = Shingler(), {}
            sig = np.stack(all_["sig"]).astype(np.int64).view(np.uint16)
            v, c, t = all_["v"].to_numpy(), all_["c"].to_numpy(), all_["t"].tolist()

            def bag(k: int) -> tuple:
                nonlocal held
                if k not in bags:
                    if held > MOST_SHINGLES:
                        bags.clear()
                        held = 0
                    bags[k] = bag_of(shingle(t[k]))
                    held += bags[k][2]
                return bags[k]

            for x, cx, s, text in zip(few["v"], few["c"], few["sig"], few["t"]):
                like = (sig == np.asarray(s, np.int64).view(np.uint16)).sum(1)
                near = np.flatnonzero((like >= MAY_REACH * PARTS) & (c != cx))
                mine, linked = None, set()
                for k in near[np.argsort(-like[near], kind="stable")]:
                    if c[k] in linked:
                        continue
                    mine = mine or bag_of(shingle(text))
                    if similar(mine, bag(k)):
                        linked.add(c[k])
                        out.append((min(x, v[k]), max(x, v[k])))
        return pd.DataFrame(list(dict.fromkeys(out)), columns=["x", "y"], dtype="int64")

    cell = ["main", "i", "j"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(meet, "x long, y long").distinct()


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, a, b (hash of the words), empty and class_id, one row per row of ``docs``."""
    release(docs.sparkSession)
    rows = signed(docs).checkpoint(eager=True)
    full = rows.where(F.col("bands").isNotNull())
    vertex = (full.where(F.col("doc_id").isNotNull()).groupBy("a", "b")
              .agg(F.min_by(F.struct("doc_id", "bands"), "doc_id").alias("r")).select("a", "b", "r.*"))
    vertex = vertex.select("a", "b", F.col("doc_id").alias("v"), "bands").checkpoint(eager=True)
    held = vertex.select("v", F.posexplode("bands").alias("band", "h"))
    buckets = held.groupBy("band", "h").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least")).where(F.col("n") > 1)
    buckets = buckets.select(F.col("band").alias("bb"), F.col("h").alias("bh"), "n", "least")
    member = held.join(buckets, (F.col("band") == F.col("bb")) & (F.col("h") == F.col("bh"))).select("v", "band", "h", "n", "least").checkpoint(eager=True)
    del held, buckets, full
    release(docs.sparkSession)
    reach = member.groupBy("v").agg(F.sum("n").alias("reach")).select(F.col("v").alias("rv"), "reach")
    known = member.join(reach, F.col("v") == F.col("rv"))
    hub = known.groupBy("band", "h").agg(F.max_by("v", F.struct("reach", -F.col("v"))).alias("hub")).select(
        F.col("band").alias("hb"), F.col("h").alias("hh"), "hub")
    starred = member.join(hub, (F.col("band") == F.col("hb")) & (F.col("h") == F.col("hh")))
    pairs = (starred.select("v", F.explode(F.array_distinct(F.array("least", "hub"))).alias("o")).where(F.col("v") != F.col("o"))
             .select(F.least("v", "o").alias("x"), F.greatest("v", "o").alias("y")).distinct())
    edges = verified(pairs, docs).checkpoint(eager=True)
    del reach, known, hub, starred, pairs
    release(docs.sparkSession)
    first = components(edges)
    label = first.select(F.col("v").alias("lv"), "c")
    sigs = vertex.select(F.col("v").alias("sv"), F.col("bands").alias("sig"))
    placed = (member.select("v", "band", "h").join(label, F.col("v") == F.col("lv"), "left")
              .select("v", "band", "h", F.coalesce("c", "v").alias("c")))
    more = edges.union(_across(placed, sigs, docs)).checkpoint(eager=True)
    del first, label, sigs, placed, member, edges
    release(docs.sparkSession)
    final = components(more).select(F.col("v").alias("fv"), F.col("c").alias("fc"))
    owner = vertex.join(final, F.col("v") == F.col("fv"), "left").select(
        F.col("a").alias("va"), F.col("b").alias("vb"), F.coalesce("fc", "v").alias("class_id"))
    out = rows.join(owner, (F.col("a") == F.col("va")) & (F.col("b") == F.col("vb")) & F.col("bands").isNotNull(), "left")
    return out.select("doc_id", "a", "b", F.col("bands").isNull().alias("empty"),
                      F.when(F.col("bands").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each class: the one whose doc_id names it.  Documents without words and
    without doc_id stay; of repeated rows one stays.  Columns as given."""
    found = classes(docs)
    gone = (found.where(F.col("doc_id").isNotNull() & (F.col("doc_id") != F.col("class_id")))
            .select(F.col("doc_id").alias(f"{OWN}gone")).distinct())
    rows = docs.join(gone, F.col("doc_id") == F.col(f"{OWN}gone"), "left_anti")
    once = rows.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    return once.union(rows.where(F.col("doc_id").isNull()))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(documents(spark, sf_dir))
    sizes = found.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size")).select(F.col("class_id").alias("k"), "class_size")
    return found.join(sizes, F.col("class_id") == F.col("k"), "left").select("doc_id", "class_id", "class_size")
