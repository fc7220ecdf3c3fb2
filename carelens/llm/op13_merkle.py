"""Merkle manifest of a dataset: content-addressed nodes, proofs of membership by descent.

A row's leaf is the SHA-256 of its fields, each with its length in front.  The leaves of a source,
by doc_id, are hashed up in runs of ``FAN`` to a subroot; the subroots, by source, to the root.
Records are found by content, the digest of their node, so equal subtrees are one record.

A leaf's proof is found by going down, not up: the requests start together at the root and go
down by the base-``FAN`` digits of their ranks.  A record keeps the children below its node for up to
``LEVELS`` heights, so a step is one join of the wanted digests with the records and passes as many
digits.  Requests with a common prefix travel as one row until their digits part, so no digest is
asked for by more rows than it has places in the trees.  What a step passes by (the children before
and after the chosen one) is a segment of the path; the segments reversed are the proof, and folding
a leaf with them must give the root.

Ranks come from one range partitioning by (source, doc_id), with offsets per range, so a source
with a third of all rows is many partitions and no task sees a whole group.  Trees grow
``FAN ** LEVELS`` leaves at a time: a row of work never holds more than 81 digests.

Defined cases: a null field is ``-``; null source is a source of its own, first; null doc_id
stands before all others; rows of equal doc_id stand by leaf digest, equal rows in any order
(each has its own place and proof); an empty table has no root, and every result is empty; columns
other than the hashed ones are ignored; a lone leaf is its own subroot, and a lone subroot the root.
The written records stay under ``folder``: they are the manifest.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import documents, numbered

FAN, LEVELS = 3, 4
BLOCK = FAN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
POWERS = [FAN ** k for k in range(39)]
SEGMENTS = "array<struct<before:binary,after:binary>>"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """Lowercase hex digest of a row."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def _joined(digests: Column) -> Column:
    """The hex texts of an array of digests, concatenated."""
    return F.array_join(F.transform(digests, _hex), "")


def _depth(n: Column) -> Column:
    """Levels above ``n`` leaves, until one node is left."""
    return F.size(F.filter(F.array(*[F.lit(p) for p in POWERS]), lambda p: p < n))


def _runs(digests: Column) -> Column:
    """The digests of the nodes over runs of ``FAN``."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / FAN).cast("int")),
                       lambda i: F.unhex(F.sha2(_joined(F.slice(digests, i * FAN + 1, F.lit(FAN))), 256)))


@dataclass
class Trees:
    """Grown trees: ``roots`` (tree, digest, depth) and per ``LEVELS`` heights, from the leaves up, the
    records (digest, levels): the children below a node, level by level, the lowest first."""

    roots: DataFrame
    records: list[DataFrame]


def grow(leaves: DataFrame, folder: str) -> Trees:
    """Trees over ``leaves`` (tree, idx from 0, digest binary, depth); records written to ``folder``."""
    spark = leaves.sparkSession
    deepest = leaves.agg(F.max("depth")).first()[0] or 0
    roots, records = leaves.where(F.col("depth") == 0).select("tree", "digest", "depth"), []
    level = leaves.select("tree", "idx", "digest", "depth")
    for height in range(0, deepest, LEVELS):
        rows = (level.where(F.col("depth") > height)
                .groupBy("tree", "depth", F.floor(F.col("idx") / BLOCK).alias("block"))
                .agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("some"))
                .select("tree", "depth", "block", F.col("some.digest").alias("a0")))
        for k in range(1, LEVELS + 1):
            rows = rows.withColumn(f"a{k}", _runs(F.col(f"a{k - 1}")))
        steps, out = F.least(F.lit(LEVELS), F.col("depth") - height), f"{folder}/{height}"
        every = F.array(*[F.col(f"a{k}") for k in range(LEVELS + 1)])
        rows.select("tree", "depth", F.col("block").alias("idx"), F.get(F.get(every, steps), F.lit(0)).alias("digest"),
                    F.slice(every, 1, steps).alias("levels")).write.parquet(out)
        level = spark.read.parquet(out)
        records.append(level.select("digest", "levels").distinct())
        roots = roots.union(level.where(F.col("depth") <= height + LEVELS).select("tree", "digest", "depth"))
    return Trees(roots, records)


def _passed(levels: Column, leaf: Column) -> Column:
    """Segments of the way down to place ``leaf`` of the lowest level: the children before and after the chosen one."""
    def segment(k: Column) -> Column:
        width = F.pow(F.lit(FAN), k)
        run, pos = F.floor(leaf / (width * FAN)).cast("int"), (F.floor(leaf / width) % FAN).cast("int")
        children = F.slice(F.get(levels, k), run * FAN + 1, F.lit(FAN))
        return F.struct(F.unhex(_joined(F.slice(children, F.lit(1), pos))).alias("before"),
                        F.unhex(_joined(F.slice(children, pos + 2, F.lit(FAN)))).alias("after"))
    return F.when(F.size(levels) > 0, F.transform(F.sequence(F.size(levels) - 1, F.lit(0), F.lit(-1)), segment)).otherwise(F.array().cast(SEGMENTS))


def proofs(requests: DataFrame, trees: Trees, above: DataFrame | None = None) -> DataFrame:
    """``requests`` (tree, rank, ...) with ``path``: what the way from the root passed by, root first.

    ``above``: (tree, path) of the segments already passed on the way to each tree's root."""
    start = trees.roots.withColumn("path", F.array().cast(SEGMENTS))
    if above is not None:
        known = above.select(F.col("tree").alias("above_tree"), "path")
        start = trees.roots.join(known, F.col("tree") == F.col("above_tree")).select("tree", "digest", "depth", "path")
    at_root = [F.col("tree"), F.lit(0).cast("long").alias("idx"), F.col("digest"), F.col("path")]
    last = start.where(F.col("depth") == 0).select(*at_root[:2], F.array().cast("array<array<binary>>").alias("levels"), "path")
    way = None
    for r in reversed(range(len(trees.records))):
        entering = start.where((F.col("depth") > r * LEVELS) & (F.col("depth") <= (r + 1) * LEVELS)).select(*at_root)
        way = entering if way is None else way.union(entering)
        records = trees.records[r].select(F.col("digest").alias("wanted"), "levels")
        met = way.join(records, F.col("digest") == F.col("wanted")).select("tree", "idx", "levels", "path")
        if r == 0:
            last = last.union(met)
            break
        way = met.select("tree", "idx", "path", "levels", F.posexplode(F.get("levels", F.lit(0))).alias("pos", "digest")).select(
            "tree", (F.col("idx") * BLOCK + F.col("pos")).alias("idx"), "digest",
            F.concat("path", _passed(F.col("levels"), F.col("pos"))).alias("path"))
    last = last.select(F.col("tree").alias("to_tree"), F.col("idx").alias("to_idx"), "levels", "path")
    found = requests.join(last, (F.col("tree") == F.col("to_tree")) & (F.floor(F.col("rank") / BLOCK) == F.col("to_idx")))
    return found.select(*requests.columns, F.concat("path", _passed(F.col("levels"), F.col("rank") % BLOCK)).alias("path"))


def proof_text(path: Column) -> Column:
    """The siblings' hex texts, from the leaf to the root, left to right."""
    return F.array_join(F.transform(F.reverse(path), lambda s: F.concat(_hex(s.before), _hex(s.after))), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(F.reverse(path), leaf, lambda at, s: F.sha2(F.concat(_hex(s.before), at, _hex(s.after)), 256))


@dataclass
class Manifest:
    """``leaves`` (doc_id, leaf, extra columns, tree, rank), ``sources`` (source, tree, n, subroot,
    path: from the root to the subroot) and the hex ``root`` (None for an empty table)."""

    leaves: DataFrame
    sources: DataFrame
    trees: Trees
    root: str | None


def manifest(rows: DataFrame, folder: str) -> Manifest:
    """Manifest of ``rows``: doc_id, source, leaf (hex) and any columns to carry."""
    spark = rows.sparkSession
    carried = [c for c in rows.columns if c not in ("doc_id", "source", "leaf")]
    # equal rows are told apart by their place, so that no key is more than one row wide
    narrow = rows.withColumn("copy", F.monotonically_increasing_id()).checkpoint(eager=True)
    counts = narrow.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    sources = numbered(counts, [], ["source"], "tree").checkpoint(eager=True)
    n_sources = sources.count()
    placed = numbered(narrow, ["source"], ["doc_id", "leaf", "copy"], "rank")
    named = sources.select(F.col("source").alias("in_source"), "tree", _depth(F.col("n")).alias("depth"))
    leaves = (placed.join(named, F.col("source").eqNullSafe(F.col("in_source")))
              .select("doc_id", "leaf", *carried, "tree", "rank", "depth")).checkpoint(eager=True)
    trees = grow(leaves.select("tree", F.col("rank").alias("idx"), F.unhex("leaf").alias("digest"), "depth"), f"{folder}/sources")
    top = grow(trees.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest",
                                  _depth(F.lit(n_sources)).alias("depth")), f"{folder}/top")
    requests = sources.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), "source", "n")
    subroots = trees.roots.select(F.col("tree").alias("of"), _hex(F.col("digest")).alias("subroot"))
    placed_sources = (proofs(requests, top).join(subroots, F.col("rank") == F.col("of"))
                      .select("source", F.col("rank").alias("tree"), "n", "subroot", "path")).checkpoint(eager=True)
    root = top.roots.select(_hex(F.col("digest"))).first()
    return Manifest(leaves.drop("depth"), placed_sources, trees, root[0] if root else None)


def with_proofs(made: Manifest) -> DataFrame:
    """The manifest's leaves with subroot, root and path."""
    found = proofs(made.leaves, made.trees, made.sources)
    subroots = made.sources.select(F.col("tree").alias("sub_tree"), "subroot")
    return found.join(subroots, F.col("tree") == F.col("sub_tree")).drop("sub_tree").withColumn("root", F.lit(made.root))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof, and the root folded from a copy that may have lost line ends."""
    folder = f"{ensure_checkpoint_dir(spark)}/merkle-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    values = {c: F.col(c) for c in FIELDS}
    damaged = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    shown = F.when(damaged, F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    rows = docs.select("doc_id", "source", leaf_digest(*values.values()).alias("leaf"),
                       leaf_digest(*({**values, "text": shown}).values()).alias("shown"))
    found = with_proofs(manifest(rows, folder)).withColumn("folded_root", fold(F.col("shown"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
