"""Exact ranks and order statistics without funnelling a group into one task.

A window ``PARTITION BY g ORDER BY x`` puts every row of a group into one task;
with one group holding a third of the data that task is the job.  Instead:

1. collapse duplicates: ``(g, x) → cnt`` (partial aggregation, map-side);
2. range-partition the distinct rows on ``(g, x)`` so a hot group is spread over
   many partitions in sorted order, tag each row with its partition id and
   checkpoint (the tag must not change if a stage is recomputed);
3. per (g, partition) totals — a table of at most #groups × #partitions rows —
   give each partition's offset inside its group by a small running sum;
4. the running count inside one (partition, g) slice plus the offset is the
   global cumulative count, ``cum_before < k <= cum_incl`` locates rank k.

Only steps 1–2 move the data; 3 is tiny; 4 shuffles the distinct rows of the
slices that matter.  NULL values sort first (ascending), as in the reference.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

CNT, PID, OFF, PTOT, RUN, POS = "_cnt", "_pid", "_off", "_ptot", "_run", "_pos"
#: monotonically_increasing_id holds the partition above these bits, the place in it below.
PLACE_BITS = 33


def _range(df: DataFrame, order, num_partitions: int | None) -> DataFrame:
    """Range-partition; without an explicit count AQE may merge adjacent ranges of a
    small input (merged partitions stay in key order, so partition ids remain ordered)."""
    if num_partitions:
        return df.repartitionByRange(num_partitions, *order)
    return df.repartitionByRange(*order)


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """Rename every column (avoids ambiguous self-joins on shared lineage)."""
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def equal_by(left: DataFrame, right: DataFrame, cols: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[prefix + c])
    return cond


def ranged(counted: DataFrame, keys: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """Rows with their multiplicity, range-partitioned by ``keys`` and tagged with their range."""
    ensure_checkpoint_dir(counted.sparkSession)
    spread = _range(counted, [F.col(k).asc_nulls_first() for k in keys], num_partitions)
    return spread.withColumn(PID, F.spark_partition_id()).checkpoint(eager=True)


def ranged_counts(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                  num_partitions: int | None = None) -> DataFrame:
    """Distinct (group, order) rows with their multiplicity, range-partitioned and tagged."""
    keys = list(group_cols) + list(order_cols)
    return ranged(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(CNT)), keys, num_partitions)


def partition_offsets(ranged: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """(group, _pid, _off, _ptot): rows of the group in earlier partitions / in this one."""
    tot = ranged.groupBy(*group_cols, PID).agg(F.sum(CNT).alias(PTOT))
    w = Window.partitionBy(*group_cols).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    return tot.withColumn(OFF, F.coalesce(F.sum(PTOT).over(w), F.lit(0)))


def with_cumulative(ranged: DataFrame, offsets: DataFrame, group_cols: Sequence[str],
                    order_cols: Sequence[str]) -> DataFrame:
    """Add ``cum_before`` / ``cum_incl`` (rows of the group ordered strictly before / up to here)."""
    w = (Window.partitionBy(PID, *group_cols)
               .orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = ranged.withColumn(RUN, F.sum(CNT).over(w))
    o = prefixed(offsets.select(*group_cols, PID, OFF), "o")
    j = run.join(o, equal_by(run, o, list(group_cols) + [PID], "o"))
    return (j.withColumn("cum_incl", F.col("o" + OFF) + F.col(RUN))
             .withColumn("cum_before", F.col("cum_incl") - F.col(CNT))
             .select(*run.columns, "cum_incl", "cum_before").drop(RUN))


def rank_lookup(df: DataFrame, group_cols: Sequence[str], value_col: str,
                targets: Callable[[Column], list[tuple[str, Column]]],
                num_partitions: int | None = None) -> DataFrame:
    """Value at 1-based rank k of each group, for every (name, k) that ``targets(n)`` gives.

    Returns (group..., target, k, n, value) with n the group's row count.
    Ranks outside 1..n give no row.  All distinct values are shuffled; ``plans.quantiles`` has the
    form that shuffles only those near the wanted ranks.
    """
    group_cols = list(group_cols)
    placed = ranged_counts(df, group_cols, [value_col], num_partitions)
    totals = partition_offsets(placed, group_cols).groupBy(*group_cols).agg(F.sum(PTOT).alias("_n"))
    tgt = totals.select(*group_cols, F.explode(F.array(*[
        F.struct(F.lit(name).alias("target"), k.cast("long").alias("k"))
        for name, k in targets(F.col("_n"))
    ])).alias("_t"), "_n").select(*group_cols, "_t.target", "_t.k", "_n", F.col("_t.k").alias("inner"))
    return value_at_ranks(placed, group_cols, value_col, tgt)


def value_at_ranks(placed: DataFrame, group_cols: Sequence[str], value_col: str, tgt: DataFrame) -> DataFrame:
    """(group..., target, k, n, value): per row of ``tgt`` (group..., target, k, _n, inner) the value at
    the 1-based rank ``inner`` of the group's rows in ``placed`` (from ``ranged``); none beyond them."""
    offs = partition_offsets(placed, group_cols)
    # locate the partition holding the rank: small x small
    o = prefixed(offs, "o")
    tp = tgt.join(o, equal_by(tgt, o, group_cols, "o")
                  & (o["o" + OFF] < tgt["inner"]) & (tgt["inner"] <= o["o" + OFF] + o["o" + PTOT]))
    # at most #groups x #targets rows
    tp = tp.select(*group_cols, "target", "k", "_n", "inner", F.col("o" + PID).alias(PID))
    # running counts only inside the partitions that hold a target
    hit = _semi(placed, tp.select(*group_cols, PID).distinct(), [*group_cols, PID])
    cum = with_cumulative(hit, offs, group_cols, [value_col])
    t = prefixed(tp, "t")
    m = cum.join(t, equal_by(cum, t, [*group_cols, PID], "t")
                 & (cum["cum_before"] < t["tinner"]) & (t["tinner"] <= cum["cum_incl"]))
    return m.select(*[F.col("t" + c).alias(c) for c in group_cols],
                    F.col("ttarget").alias("target"), F.col("tk").alias("k"),
                    F.col("t_n").alias("n"), F.col(value_col).alias("value"))


def _semi(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    r = prefixed(right.select(*cols), "r")
    return left.join(r, equal_by(left, r, cols, "r"), "left_semi")


def number_rows(df: DataFrame, order_cols: Sequence[str], name: str,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1..n following ``order_cols`` (ties broken arbitrarily), all columns kept.

    Range partitioning spreads the rows in order over the partitions, where they are sorted
    and tagged with their place before the checkpoint, so they move once.  The counts (one
    row per range partition, a number set by the shuffle settings, hence broadcast) give
    each partition its starting number.  Never a single-partition window over the data.  A per-row id is the last range key, so
    even a third of the rows being identical copies is spread over many partitions
    (copies are interchangeable, so which copy gets which number does not matter).
    """
    ensure_checkpoint_dir(df.sparkSession)
    tie = "_tie"
    order = [F.col(c).asc_nulls_first() for c in order_cols] + [F.col(tie).asc()]
    ranged = (_range(df.withColumn(tie, F.monotonically_increasing_id()), order, num_partitions)
                .sortWithinPartitions(*order).withColumn(POS, F.monotonically_increasing_id()).checkpoint(eager=True)
                .withColumn(PID, F.shiftright(POS, PLACE_BITS)))
    counts = ranged.groupBy(PID).agg(F.count(F.lit(1)).alias(PTOT))
    w = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offs = prefixed(counts.withColumn(OFF, F.coalesce(F.sum(PTOT).over(w), F.lit(0))), "o")
    place = F.col(POS).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    j = ranged.join(F.broadcast(offs), F.col(PID) == F.col("o" + PID))
    return j.select(*df.columns, (F.col("o" + OFF) + place + 1).cast("long").alias(name))


def dense_sequence(df: DataFrame, order_cols: Sequence[str], name: str,
                   num_partitions: int | None = None) -> DataFrame:
    """Surrogate key 1..n over the distinct values of ``order_cols``, in that order."""
    return number_rows(df.select(*order_cols).distinct(), order_cols, name, num_partitions) \
        .select(name, *order_cols)


def dense_sequence_grouped(df: DataFrame, group_col: str, order_cols: Sequence[str],
                           name: str, num_partitions: int | None = None) -> DataFrame:
    """Per value of ``group_col``, number its distinct ``order_cols`` values 1..n in order.

    Several small key spaces (e.g. four name dimensions) are keyed in one pass and
    one range shuffle instead of one job each.
    """
    ranged = ranged_counts(df, [group_col], list(order_cols), num_partitions)
    ones = ranged.withColumn(CNT, F.lit(1).cast("long"))
    offs = partition_offsets(ones, [group_col])
    cum = with_cumulative(ones, offs, [group_col], list(order_cols))
    return cum.select(group_col, *order_cols, F.col("cum_incl").cast("long").alias(name))
