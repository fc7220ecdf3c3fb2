"""Line dedup: lines found in many documents stay only in the largest doc_id that holds them.

Lines are exploded, normalised and hashed to 128 bits; (key, document) pairs are made distinct
(partially before the shuffle), so counting documents per key is a plain count with map-side
combine and a line that a third of all documents hold is no hot task.  The documents' own list
of keys to drop comes back, sorted, by one join on doc_id, and each document is reassembled in
line order inside its row; a line finds its key there by bisection, so a text of n lines that
loses m keys takes n log m steps.

Defined cases: null or empty text is one empty line (never dropped, too short); rows with equal
doc_id are one document for counting and all lose the same keys; a null doc_id is one document,
smaller than any other; an empty table gives an empty result; other columns pass through
``dedup_lines`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, LOWER, OWN, UPPER, documents, let, text_of

MIN_CHARS = 40
MIN_DOCS = 5
SEED = 7919


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def key_hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(SEED), key).alias("b"))


def keys_to_drop(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, drops): the keys whose lines that document loses, ascending."""
    lines = docs.select("doc_id", F.explode(F.split(text_of(), "\n", -1)).alias("line"))
    keys = lines.select("doc_id", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    held = keys.select("doc_id", key_hash(F.col("key")).alias("k")).select("doc_id", "k.a", "k.b").distinct()
    common = (held.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("owner"))
              .where(F.col("n") >= min_docs).select(F.col("a").alias("ca"), F.col("b").alias("cb"), "owner"))
    lost = (held.join(common, (F.col("a") == F.col("ca")) & (F.col("b") == F.col("cb")))
            .where(~F.col("doc_id").eqNullSafe(F.col("owner"))))
    return lost.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("drops"))


def found_in(ascending: Column, key: Column) -> Column:
    """Whether an ascending array holds ``key``: the range [lo, hi) is halved until it is empty, which
    takes as many steps as the array's size has binary digits."""
    def halve(s: Column, _) -> Column:
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        less = F.coalesce(F.get(ascending, mid) < key, F.lit(False))
        return F.struct(F.when(less, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(less, s["hi"]).otherwise(mid).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.size(ascending).alias("hi"))
    steps = F.sequence(F.lit(1), F.length(F.bin(F.size(ascending))))
    return F.aggregate(steps, start, halve, lambda s: F.coalesce(F.get(ascending, s["lo"]) == key, F.lit(False)))


def _with_kept(docs: DataFrame, carry: list[str], min_chars: int, min_docs: int) -> DataFrame:
    drops = keys_to_drop(docs.select("doc_id", "text"), min_chars, min_docs).select(
        F.col("doc_id").alias(f"{OWN}doc"), F.col("drops").alias(f"{OWN}drops"))
    rows = docs.select(*carry).join(drops, docs["doc_id"].eqNullSafe(drops[f"{OWN}doc"]), "left")
    lines = F.split(text_of(), "\n", -1)
    kept = F.filter(lines, lambda line: (F.length(line_key(line)) < min_chars)
                    | ~let(key_hash(line_key(line)), lambda key: found_in(F.col(f"{OWN}drops"), key)))
    return (rows.withColumn(f"{OWN}kept", F.when(F.col(f"{OWN}drops").isNotNull(), kept))
            .withColumn(f"{OWN}n", F.size(lines).cast("long")))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Documents without their repeated lines; columns as given (n_chars, if there, counts anew)."""
    rows = _with_kept(docs, docs.columns, min_chars, min_docs)
    text = F.when(F.col(f"{OWN}kept").isNull(), F.col("text")).otherwise(F.array_join(f"{OWN}kept", "\n"))
    made = {"text": text}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(F.col(f"{OWN}kept").isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long"))
    return rows.select(*[made[c].alias(c) if c in made else F.col(c) for c in docs.columns])


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_kept(documents(spark, sf_dir), ["doc_id", "text"], MIN_CHARS, MIN_DOCS)
    kept = F.col(f"{OWN}kept")
    text = F.when(kept.isNull(), text_of()).otherwise(F.array_join(kept, "\n"))
    return rows.select("doc_id", F.col(f"{OWN}n").alias("n_lines"),
                       F.when(kept.isNull(), F.lit(0)).otherwise(F.col(f"{OWN}n") - F.size(kept)).cast("long").alias("n_dropped"),
                       F.sha2(text, 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, l, translate(trim(l, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
common AS (
  SELECT k, max(doc_id) AS owner FROM lines WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, i, l, c.k IS NOT NULL AND doc_id <> c.owner AS gone
  FROM lines LEFT JOIN common c ON lines.k = c.k)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
