"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

Each source (by code point, null last) gets a weight; the mix holds as many words as the
corpus.  A source gives at most ``max_passes`` times its own words, and what it cannot give
is reshared by weight (water filling over one row per source).  The words are dealt out in
blocks of ``block_tokens``: the sources' quotas are the highest quotients w/(2k-1) of the
Sainte-Lague method, and each source's quota is dealt in the same way to its shards (about
``shard_tokens`` words each, documents hashed to shards), so that every shard has an integer
quota.  In a shard the documents stand in a seeded hash order; its word stream is cut into
blocks, quota div blocks whole passes are taken, and the rest is a run of blocks, circular,
from a seeded first block.  Because the order is a seeded shuffle the run is a random sample
of documents of which at most two are cut.

All is closed-form on (source, shard) rows; the only per-document work is one window inside
a shard of bounded size, so a source holding a third of the corpus is simply many shards.
The quotients are never listed in full: each part starts from its rounded share, and only the
few quotients around it (about six rows per part) are ranked.  One-task windows see one row
per source (twelve for ranking), never documents.

Defined cases: null or empty text has size 0 and nothing taken; a null source is a source of
its own, last; repeated rows each have their own place in the stream; an empty table gives an
empty result.  Documents keep their columns in ``mix_documents``, whatever their names: carried
columns go by numbers until the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import OWN, count_words, documents, equal_keys, text_of

SEED = 20240517
BLOCK_TOKENS = 64
SHARD_TOKENS = 1 << 20
MAX_PASSES = 3
WEIGHTS = (1, 2, 3)


def _water_level(weight: Column, cap: Column, total: Column, parts: list[str]) -> Column:
    """The level L with sum(min(cap, weight * L)) = total over the rows of a part."""
    by_ratio = Window.partitionBy(*parts).orderBy(cap / weight)
    before = F.coalesce(F.sum(cap).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum(weight).over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (total - before) / left
    return F.when(cap / weight >= level, level)


def apportion(parts: DataFrame, group: list[str], key: list[str], seats: str = "seats") -> DataFrame:
    """Sainte-Lague with caps.  ``parts`` has group and key columns, ``weight`` (> 0), ``cap``
    (whole seats) and ``total`` (seats of the group, at most the sum of caps).  Adds ``seats``."""
    one = Window.partitionBy(*group)
    t = parts.withColumn("_level", _water_level(F.col("weight").cast("double"), F.col("cap").cast("double"),
                                                F.col("total").cast("double"), group))
    t = t.withColumn("_level", F.max("_level").over(one))
    # a change of the level that moves the sum by the number of parts moves one part by at most this
    t = t.withColumn("_span", (2 + F.ceil(F.col("weight") * F.count(F.lit(1)).over(one)
                                          / F.sum("weight").over(one))).cast("long"))
    t = t.withColumn("_base", F.least("cap", F.greatest(F.lit(0), F.floor(F.col("weight") * F.col("_level") + 0.5)
                                                        - F.col("_span"))).cast("long"))
    t = t.withColumn("_open", F.col("total") - F.sum("_base").over(one))
    first, last = F.col("_base") + 1, F.least("cap", F.col("_base") + 2 * F.col("_span"))
    rows = (t.where(last >= first).withColumn("_k", F.explode(F.sequence(first, last)))
             .withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(
                 (F.col("weight") / (2 * F.col("_k") - 1)).desc(), *[F.col(k).asc_nulls_last() for k in key]))))
    won = (rows.where(F.col("_rank") <= F.col("_open")).groupBy(*group, *key).agg(F.count(F.lit(1)).alias("_won"))
           .select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate([*group, *key])], "_won"))
    out = t.join(won, equal_keys(t, won, [(c, f"_r{i}") for i, c in enumerate([*group, *key])]), "left")
    return out.select(*parts.columns, (F.col("_base") + F.coalesce("_won", F.lit(0))).alias(seats))


def _measured(docs: DataFrame, seed: int, carry: list[str]) -> DataFrame:
    text = text_of()
    return docs.select(F.col("doc_id").alias(f"{OWN}id"), F.col("source").alias(f"{OWN}source"),
                       count_words(text).alias(f"{OWN}size"),
                       F.xxhash64(F.lit(seed), F.col("doc_id"), text).alias(f"{OWN}order"),
                       *[F.col(c).alias(f"{OWN}c{i}") for i, c in enumerate(carry)])


def mix(docs: DataFrame, seed: int = SEED, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS,
        max_passes: int = MAX_PASSES, weights: tuple[int, ...] = WEIGHTS, carry: list[str] | None = None) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, passes (whole copies) and cuts (word
    ranges [from, to) of the partial pass), all under the OWN prefix, beside the ``carry`` columns."""
    o = {n: f"{OWN}{n}" for n in ("id", "source", "size", "order", "shard", "source_size", "target", "shards")}
    narrow = _measured(docs, seed, []).checkpoint(eager=True)
    totals = (narrow.groupBy(o["source"]).agg(F.sum(o["size"]).alias(o["source_size"]))
              .withColumn("_place", F.row_number().over(Window.orderBy(F.col(o["source"]).asc_nulls_last())))
              .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                                 ((F.col("_place") - 1) % len(weights) + 1).cast("int")))
              .withColumn("_all", F.sum(o["source_size"]).over(Window.partitionBy())))
    cap = F.col(o["source_size"]).cast("double") * max_passes
    totals = totals.withColumn("_level", _water_level(F.col("weight").cast("double"), cap,
                                                      F.col("_all").cast("double"), []))
    totals = (totals.withColumn("_level", F.max("_level").over(Window.partitionBy()))
              .withColumn(o["target"], F.least(cap, F.col("weight") * F.col("_level")))
              .withColumn(o["shards"], F.greatest(F.lit(1), F.ceil(F.col(o["source_size"]) / shard_tokens)).cast("long"))
              .select(F.col(o["source"]).alias("_s"), o["source_size"], o["target"], o["shards"], "weight", "_all"))

    def sharded(rows: DataFrame) -> DataFrame:
        return (rows.join(totals, equal_keys(rows, totals, [(o["source"], "_s")]))
                .withColumn(o["shard"], F.pmod(F.xxhash64(F.lit(seed + 1), F.col(o["order"])), F.col(o["shards"])))
                .drop("_s"))

    # whole blocks per shard, then seats per source, then seats per shard
    shards = (sharded(narrow).groupBy(o["source"], o["shard"])
              .agg(F.sum(o["size"]).alias("_words"), F.first("weight").alias("_w"),
                   F.first(o["target"]).alias("_t"), F.first(o["source_size"]).alias("_size"))
              .withColumn("_blocks", F.ceil(F.col("_words") / block_tokens).cast("long")))
    by_source = (shards.groupBy(o["source"])
                 .agg((F.sum("_blocks") * max_passes).alias("cap"), F.first("_w").alias("weight"),
                      F.first("_t").alias("_t"), F.first("_size").alias("_size")))
    # a source at its limit gives all its blocks, the last of a shard being short
    words = F.when(F.col("_t") >= max_passes * F.col("_size"), F.col("cap") * block_tokens).otherwise(F.col("_t"))
    by_source = by_source.select(o["source"], "cap", "weight", F.round(
        F.sum(words).over(Window.partitionBy()) / block_tokens).cast("long").alias("total"))
    seats = apportion(by_source, [], [o["source"]]).select(F.col(o["source"]).alias("_s"), F.col("seats").alias("_seats"))
    quota = apportion(
        shards.join(seats, equal_keys(shards, seats, [(o["source"], "_s")]))
        .where(F.col("_blocks") > 0)
        .select(o["source"], o["shard"], "_blocks", F.col("_blocks").alias("weight"),
                (F.col("_blocks") * max_passes).alias("cap"), F.col("_seats").alias("total")),
        [o["source"]], [o["shard"]], "quota")
    quota = quota.select(F.col(o["source"]).alias("_s"), F.col(o["shard"]).alias("_h"), F.col("_blocks").alias("_n"), "quota")

    base = narrow if carry is None else _measured(docs, seed, carry)
    in_shard = Window.partitionBy(o["source"], o["shard"])
    stream = in_shard.orderBy(o["order"], F.col(o["id"]).asc_nulls_first())
    rows = (sharded(base)
            .withColumn("_from", F.coalesce(F.sum(o["size"]).over(stream.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("_end", F.sum(o["size"]).over(in_shard)))
    rows = rows.join(quota, equal_keys(rows, quota, [(o["source"], "_s"), (o["shard"], "_h")]), "left")
    n, q = F.col("_n"), F.col("quota")
    rows = (rows.withColumn(f"{OWN}passes", F.when(n > 0, F.floor(q / n)).otherwise(F.lit(0)).cast("long"))
            .withColumn("_rest", F.when(n > 0, q % n).otherwise(F.lit(0)))
            .withColumn("_first", F.when(n > 0, F.pmod(F.xxhash64(F.lit(seed + 2), F.col(o["source"]), F.col(o["shard"])), n))
                        .otherwise(F.lit(0))))
    last = F.col("_first") + F.col("_rest")

    def cut(lo: Column, hi: Column) -> Column:
        a = F.greatest(lo, F.col("_from")) - F.col("_from")
        b = F.least(hi, F.col("_from") + F.col(o["size"])) - F.col("_from")
        return F.struct(a.cast("long").alias("a"), F.greatest(a, b).cast("long").alias("b"))

    cuts = F.filter(F.array(cut(F.lit(0), F.greatest(F.lit(0), last - n) * block_tokens),
                            cut(F.col("_first") * block_tokens, F.least(last * block_tokens, F.col("_end")))),
                    lambda c: c.b > c.a)
    rows = rows.withColumn(f"{OWN}cuts", F.when(n > 0, cuts).otherwise(F.filter(cuts, lambda c: F.lit(False))))
    rows = rows.withColumn(f"{OWN}taken", F.col(f"{OWN}passes") * F.col(o["size"]) + F.aggregate(
        f"{OWN}cuts", F.lit(0).cast("long"), lambda s, c: s + c.b - c.a))
    return rows.select(*[F.col(f"{OWN}c{i}").alias(c) for i, c in enumerate(carry or [])], o["id"], o["size"], o["source_size"], o["target"],
                       f"{OWN}passes", f"{OWN}cuts", f"{OWN}taken")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a row per whole pass, and a row with the words of each cut of the
    partial pass (words keep the blanks after them).  Columns are those of ``docs``."""
    rows = mix(docs, carry=docs.columns, **options)
    size = F.col(f"{OWN}size")
    whole = F.array_repeat(F.struct(F.lit(0).cast("long").alias("a"), size.alias("b")), F.col(f"{OWN}passes").cast("int"))
    pieces = rows.withColumn(f"{OWN}piece", F.explode(F.concat(whole, F.col(f"{OWN}cuts")))).where(f"{OWN}piece.b > {OWN}piece.a")
    a, b = F.col(f"{OWN}piece.a"), F.col(f"{OWN}piece.b")
    with_blanks = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    part = F.array_join(F.slice(with_blanks, (a + 1).cast("int"), (b - a).cast("int")), "")
    text = F.when((a == 0) & (b == size), F.col("text")).otherwise(part)
    extra = {"n_chars": F.length(text).cast("long")} if "n_chars" in docs.columns else {}
    made = {"text": text} | extra
    return pieces.select(*[made[c].alias(c) if c in made else F.col(c) for c in docs.columns])


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix(documents(spark, sf_dir))
    return rows.select(*[F.col(f"{OWN}{a}").alias(b) for a, b in (
        ("id", "doc_id"), ("size", "size"), ("source_size", "source_size"), ("target", "target"), ("taken", "taken"))])
