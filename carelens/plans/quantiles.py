"""Exact order statistics from two passes: a mergeable sketch brackets each wanted rank, the second
pass ranks only the values inside the brackets.

Pass 1 aggregates, per group, the counts, any further aggregates the caller wants and a KLL quantile
sketch (partial sketches are merged after the scan, so a group with a third of all rows costs no
more than another).  For a wanted rank the sketch gives two values with the rank between them, a
*band*; the bands hold a fixed small share of the rows.

Pass 2 maps each row to the number of bands that begin at or below its value.  Rows in no band are
counted by that number alone, rows in a band by their value; both are combined before the shuffle,
so that beside a handful of counts only band values are shuffled.  The count of the rows outside the
bands below a wanted rank turns it into a rank among the band values, and those are ranked exactly:
range-partitioned, with offsets per range, no group in one task.

The group and value columns are persisted between the passes (executor storage, spilling to disk),
so the input itself is read once.  The sketch's error is a matter of probability, so every value
found is held against its band; if one is missing or lies outside, pass 2 is repeated with wider
bands.  The result is exact always.  NULL sorts first and NaN last, as elsewhere in the library.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .ordering import CNT, equal_by, partition_offsets, prefixed, ranged, with_cumulative

#: Items a sketch keeps per level; with 2048 a rank is off by 0.24 % of the rows at most in 99 of 100 cases.
SKETCH = 2048
#: Half the width of a band as a share of the rows, three times that error.
EPS = 0.0075
#: The sketch is read at this many equal steps; a band ends on one.
GRID = 400

Targets = Callable[[Column], list[tuple[str, Column]]]
#: From the SQL names (begin, end) of the wanted ranks' bands to further (begin, end) SQL texts.
Fences = Callable[[dict[str, tuple[str, str]]], list[tuple[str, str]]]


def _axis(value: str, kind: str) -> str:
    """SQL of the value as a double that keeps the order (NaN, which sorts last, as infinity)."""
    x = f"CAST({value} AS DOUBLE)"
    return f"CASE WHEN isnan({x}) THEN CAST('Infinity' AS DOUBLE) ELSE {x} END" if kind in ("double", "float") else x


def sized(groups: DataFrame) -> DataFrame:
    """A row per group, persisted and counted, so that the planner knows its size and joins it to the rows
    by broadcast if it is small.  Otherwise it takes both sides for large and shuffles the rows by group -
    a handful of groups is a handful of tasks, and AQE keeps it so where most partitions are empty."""
    groups = groups.persist(StorageLevel.MEMORY_AND_DISK)
    groups.count()
    return groups


class Banded:
    """The outcome of the two passes over ``df`` for some wanted ranks of ``value_col`` per group.

    ``found``: group, target, k, n, value; ``stats``: group and the further aggregates; ``cells``: group,
    ``r`` (bands that begin at or below), ``inside`` (a band), ``value`` (if inside), count, and the
    ``least`` and ``most`` of the cell's values.  ``fences`` adds bands, see ``boxes``."""

    def __init__(self, df: DataFrame, group_cols: Sequence[str], value_col: str, targets: Targets,
                 also: Sequence[Column] = (), fences: Fences | None = None, eps: float = EPS, sketch: int = SKETCH):
        ensure_checkpoint_dir(df.sparkSession)
        self.groups, self.fences = list(group_cols), fences
        self.keys = [f"`{g}`" for g in group_cols]
        self.kind = df.schema[value_col].dataType.typeName()
        rows = df.select(*group_cols, F.col(value_col).alias("value")).persist(StorageLevel.MEMORY_AND_DISK)
        grid = F.kll_sketch_get_quantile_double("_sketch", F.expr(f"array({', '.join(f'{i / GRID!r}D' for i in range(GRID + 1))})"))
        wanted = targets(F.col("_n"))
        self.names = [name for name, _ in wanted]
        stats = rows.groupBy(*group_cols).agg(
            F.count(F.lit(1)).alias("_n"), F.count_if(F.col("value").isNull()).alias("_nulls"),
            F.kll_sketch_agg_double(F.expr(_axis("value", self.kind)), F.lit(sketch)).alias("_sketch"),
            *[a.alias(f"_also{i}") for i, a in enumerate(also)])
        ranks = [k.cast("long").alias(f"_k{i}") for i, (_, k) in enumerate(wanted)]
        self.stats = stats.select("*", F.when(F.col("_n") > F.col("_nulls"), grid).alias("_grid"), *ranks).drop("_sketch").checkpoint(eager=True)
        while True:
            self._pass(rows, eps)
            if self._complete():
                break
            eps *= 4
        rows.unpersist()

    def _pass(self, rows: DataFrame, eps: float) -> None:
        index, edges = range(len(self.names)), []
        for i in index:
            # a sketch of few values is exact; two rows more on each side cover its rounding
            real = f"_k{i} > _nulls AND _k{i} <= _n AND _k{i} >= 1"
            slack = f"({eps!r}D + 2 / (_n - _nulls))"
            edges += [f"CASE WHEN {real} THEN get(_grid, CAST(greatest(0, floor(((_k{i} - _nulls - 1) / (_n - _nulls) - {slack}) * {GRID})) AS INT)) END AS _lo{i}",
                      f"CASE WHEN {real} THEN get(_grid, CAST(least({GRID}, ceil(((_k{i} - _nulls) / (_n - _nulls) + {slack}) * {GRID})) AS INT)) END AS _hi{i}"]
        pairs = {name: (f"_lo{i}", f"_hi{i}") for i, name in enumerate(self.names)}
        every = [*pairs.values(), *(self.fences(pairs) if self.fences else [])]
        bands = ", ".join(f"struct({lo} AS lo, {hi} AS hi)" for lo, hi in every)
        # sorted by their beginnings; the ends made ascending, so one comparison tells if a value is in any band
        wide = (self.stats.selectExpr("*", *edges)
                .selectExpr("*", f"array_sort(filter(array({bands}), b -> b.lo IS NOT NULL AND b.hi IS NOT NULL)) AS _bands").drop("_grid")
                .selectExpr("*", "_bands.lo AS _begin", f"transform(sequence(1, {len(every)}), i -> array_max(slice(_bands.hi, 1, i))) AS _end")
                .drop("_bands").checkpoint(eager=True))
        side = sized(prefixed(wide.selectExpr(*self.keys, *[f"get(_begin, {i}) AS b{i}" for i in range(len(every))],
                                              *[f"get(_end, {i}) AS e{i}" for i in range(len(every))]), "_s"))
        data = rows.where("value IS NOT NULL").selectExpr("*", f"{_axis('value', self.kind)} AS _x")
        begun = " + ".join(f"CASE WHEN _x >= _sb{i} THEN 1 ELSE 0 END" for i in range(len(every)))
        end = " ".join(f"WHEN _x >= _sb{i} THEN _se{i}" for i in reversed(range(len(every))))
        cell = (data.join(side, equal_by(data, side, self.groups, "_s"))
                .selectExpr(*self.keys, "value AS _v", f"{begun} AS r", f"coalesce(_x <= CASE {end} END, false) AS inside")
                .selectExpr(*self.keys, "_v", "r", "inside", "CASE WHEN inside THEN _v END AS value"))
        self.cells = cell.groupBy(*self.groups, "r", "inside", "value").agg(
            F.count(F.lit(1)).alias(CNT), F.min("_v").alias("least"), F.max("_v").alias("most")).checkpoint(eager=True)
        side.unpersist()
        # rows outside the bands by r (at most a row per band), to turn ranks into ranks among the band values
        outside = prefixed(self.cells.where("NOT inside").groupBy(*self.groups).agg(F.collect_list(F.struct("r", F.col(CNT).alias("rows"))).alias("rows")), "_o")
        whole = wide.join(outside, equal_by(wide, outside, self.groups, "_o"), "left")
        inner = [f"_k{i} - _nulls - aggregate(coalesce(_orows, cast(array() as array<struct<r:int,rows:bigint>>)), 0L, (s, o) -> "
                 f"s + CASE WHEN o.r <= size(filter(_begin, b -> b < _lo{i})) THEN o.rows ELSE 0L END) AS _i{i}" for i in index]
        self.wide = whole.selectExpr(*self.keys, "_n", "_nulls", *[f"_{c}{i}" for c in ("k", "lo", "hi") for i in index], *inner)
        self.found = self._found()

    def _found(self) -> DataFrame:
        """group, target, k, n, value, and whether the value is ``real`` (lies in its band)."""
        placed = ranged(self.cells.where("inside").select(*self.groups, "value", CNT), [*self.groups, "value"])
        counted = with_cumulative(placed, partition_offsets(placed, self.groups), self.groups, ["value"])
        wanted = sized(prefixed(self.wide, "_w"))  # a row per group beside the band values
        met = counted.join(wanted, equal_by(counted, wanted, self.groups, "_w"))
        hit = [f"(cum_before < _w_i{i} AND _w_i{i} <= cum_incl)" for i in range(len(self.names))]
        hits = ", ".join(f"CASE WHEN {h} THEN struct('{name}' AS target, _w_k{i} AS k, coalesce(_x >= _w_lo{i} AND _x <= _w_hi{i}, false) AS real) END"
                         for i, (name, h) in enumerate(zip(self.names, hit)))
        real = (met.where(" OR ".join(hit)).selectExpr("*", f"{_axis('value', self.kind)} AS _x")
                .selectExpr(*[f"`_w{g}` AS `{g}`" for g in self.groups], "_w_n AS n", "value", f"explode(filter(array({hits}), t -> t IS NOT NULL)) AS t")
                .selectExpr(*self.keys, "t.target", "t.k", "n", "value", "t.real"))
        nulls = ", ".join(f"CASE WHEN _k{i} >= 1 AND _k{i} <= _nulls THEN struct('{name}' AS target, _k{i} AS k) END" for i, name in enumerate(self.names))
        kind = self.cells.schema["value"].dataType.simpleString()
        none = (self.wide.where("_nulls > 0").selectExpr(*self.keys, "_n AS n", f"explode(filter(array({nulls}), t -> t IS NOT NULL)) AS t")
                .selectExpr(*self.keys, "t.target", "t.k", "n", f"CAST(NULL AS {kind}) AS value", "true AS real"))
        found = real.union(none).checkpoint(eager=True)
        wanted.unpersist()
        return found

    def _complete(self) -> bool:
        """Whether every wanted rank has its value, in its band.  Such a value is right: no row outside
        the bands lies between the beginning of its band and it."""
        inside = " + ".join(f"CASE WHEN _k{i} >= 1 AND _k{i} <= _n THEN 1 ELSE 0 END" for i in range(len(self.names)))
        want = self.wide.selectExpr(*self.keys, f"{inside} AS want")
        got = prefixed(self.found.where("real").groupBy(*self.groups).agg(F.count(F.lit(1)).alias("got")), "_g")
        both = want.join(got, equal_by(want, got, self.groups, "_g"), "left")
        return both.where("want <> coalesce(_ggot, 0)").isEmpty()


def rank_lookup(df: DataFrame, group_cols: Sequence[str], value_col: str, targets: Targets, **options) -> DataFrame:
    """Value at 1-based rank k of each group for every (name, k) that ``targets(n)`` gives, as
    ``ordering.rank_lookup``: (group..., target, k, n, value)."""
    return Banded(df, group_cols, value_col, targets, **options).found.drop("real")


def _quantile_targets(ps: Sequence[tuple[str, str]]) -> Targets:
    """The two ranks (of the non-NULL values) around each quantile."""
    def targets(n: Column) -> list[tuple[str, Column]]:
        out = []
        for name, p in ps:
            lo = F.floor((n - 1) * F.expr(f"{p}BD")).cast("long")
            out += [(f"{name}__lo", lo + 1), (f"{name}__hi", F.least(lo + 2, n))]
        return out
    return targets


def _interpolated(found: DataFrame, group_cols: Sequence[str], ps: Sequence[tuple[str, str]]) -> DataFrame:
    """x[floor(h)] + (h - floor(h)) * (x[floor(h) + 1] - x[floor(h)]) at h = (n - 1) p; decimals stay exact."""
    wide = found.groupBy(*group_cols).agg(F.first("n").alias("n"), *[
        F.expr(f"max(CASE WHEN target = '{name}__{side}' THEN value END)").alias(f"_{side}_{name}") for name, _ in ps for side in ("lo", "hi")])
    return wide.selectExpr(*[f"`{g}`" for g in group_cols], "n", *[
        f"_lo_{name} + ((n - 1) * {p}BD - floor((n - 1) * {p}BD)) * (_hi_{name} - _lo_{name}) AS {name}" for name, p in ps])


def quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str, ps: Sequence[tuple[str, str]],
              also: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """Linear-interpolation quantiles (as NumPy and pandas) of the non-NULL values: (group..., n, a
    column per quantile), and the ``also`` aggregates (of the column ``value``) from the same pass."""
    group_cols = list(group_cols)
    made = Banded(df.where(F.col(value_col).isNotNull()), group_cols, value_col, _quantile_targets(ps), also=[c for _, c in also])
    out = _interpolated(made.found, group_cols, ps)
    if not also:
        return out
    stats = prefixed(made.stats.select(*group_cols, *[F.col(f"_also{i}").alias(name) for i, (name, _) in enumerate(also)]), "_a")
    both = out.join(stats, equal_by(out, stats, group_cols, "_a"))
    return both.select(*out.columns, *[F.col(f"_a{name}").alias(name) for name, _ in also])


def boxes(df: DataFrame, key: str, value_col: str, ps: Sequence[tuple[str, str]], reach: str = "1.5") -> DataFrame:
    """(key, n, q1, median, q3, iqr, whislo, whishi, fliers) of the non-NULL values.

    A fence lies ``reach`` interquartile ranges outside the box; where it can lie follows from the
    bands of the quartiles, so a band of its own holds it, and whiskers and fliers come from the
    same second pass: counts and extreme values outside the bands, values inside."""
    def fences(bands: dict[str, tuple[str, str]]) -> list[tuple[str, str]]:
        (a, b), (c, d) = [(bands[f"{q}__lo"][0], bands[f"{q}__hi"][1]) for q in ("q1", "q3")]
        wide, narrow = f"{reach}D * ({d} - {a})", f"{reach}D * greatest(0D, {c} - {b})"
        pad = f"1e-9D * (abs({a}) + abs({d}))"  # rounding of the products
        return [(f"{a} - {wide} - {pad}", f"{b} - {narrow} + {pad}"), (f"{c} + {narrow} - {pad}", f"{d} + {wide} + {pad}")]

    made = Banded(df.where(F.col(value_col).isNotNull()), [key], value_col, _quantile_targets(ps), fences=fences)
    q = _interpolated(made.found, [key], ps).withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.selectExpr("*", f"q1 - {reach}BD * iqr AS _below", f"q3 + {reach}BD * iqr AS _above")
    q, cells = sized(q), prefixed(made.cells, "_c")
    j = q.join(cells, equal_by(q, cells, [key], "_c"))
    # a cell outside the bands lies wholly on one side of each fence
    out = j.groupBy(*q.columns).agg(
        F.expr("least(min(CASE WHEN _cleast >= _below THEN _cleast END), q1)").alias("whislo"),
        F.expr("greatest(max(CASE WHEN _cmost <= _above THEN _cmost END), q3)").alias("whishi"),
        F.expr(f"CAST(coalesce(sum(CASE WHEN _cmost < _below OR _cleast > _above THEN _c{CNT} END), 0) AS BIGINT)").alias("fliers")).drop("_below", "_above").checkpoint(eager=True)
    q.unpersist()
    return out
