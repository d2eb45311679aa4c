"""Exact continuous percentiles per group (A10, M4).

``percentile_cont(p) within group (order by x)`` with linear interpolation
``lo + (hi - lo) * (pos - floor(pos))`` where ``pos = p * (n - 1)``, NULLs
ignored, NULL for a group with no values.

Plan: values are first counted per ``(group, measure, value)`` -- a
map-side-combined aggregate, so even a group holding a third of all rows
shrinks to one row per distinct value.  One more shuffle brings a group's
counted values together as a sorted list (as long as the value domain, e.g.
days, whatever the number of rows), in which the two ranks around ``pos`` are
found.

Counted values are mergeable: :func:`value_lists` keeps them per day, and
:func:`merge_value_lists` adds the lists of many days up to any longer period
without the rows that they were counted from.

The exact path suits the durations here (integer days: few distinct values
per group).  For a high-cardinality measure, ``approx=True`` switches to
``percentile_approx`` (a mergeable sketch with bounded memory per group).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_cells(df: DataFrame, group_cols: Sequence[str],
                measures: Mapping[str, str | Column]) -> DataFrame:
    """Rows ``(*group, measure, v)``: every non-null value of every measure."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"),
                 (F.col(col) if isinstance(col, str) else col).cast("double").alias("v"))
        for name, col in measures.items()
    ])).alias("cell")
    return (
        df.select(*group_cols, cells)
        .select(*group_cols, "cell.measure", "cell.v")
        .where(F.col("v").isNotNull())
    )


def value_counts(df: DataFrame, group_cols: Sequence[str],
                 measures: Mapping[str, str | Column]) -> DataFrame:
    """Rows ``(*group, measure, v, n)``: how often each non-null value occurs."""
    return (
        value_cells(df, group_cols, measures)
        .groupBy(*group_cols, "measure", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def percentiles(df: DataFrame, group_cols: Sequence[str], measures: Mapping[str, str | Column],
                outputs: Mapping[str, tuple[str, float]], approx: bool = False,
                accuracy: int = 10000, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Exact percentiles of several measures per group.

    ``measures`` maps a measure name to its value column; ``outputs`` maps an
    output column to ``(measure, p)``.  Returns one row per group that has at
    least one non-null value in some measure; add a constant measure
    (``F.lit(1)``) to keep every group.  ``approx=True`` is the opt-in sketch.

    ``extra`` adds aggregates over the counted cells ``(measure, v, n)`` to the
    final grouping -- e.g. ``sum(n)`` of a constant measure is ``count(*)`` --
    so counts and sums come from the same pass as the percentiles (see
    :func:`cell_count`, :func:`cell_sum`).
    """
    def as_col(c):
        return F.col(c) if isinstance(c, str) else c

    if approx:
        cells = value_cells(df, group_cols, measures).withColumn("n", F.lit(1))
        aggs = [e.alias(name) for name, e in (extra or {}).items()]
        aggs += [F.percentile_approx(F.when(F.col("measure") == m, F.col("v")), p, accuracy).alias(out)
                 for out, (m, p) in outputs.items()]
        return cells.groupBy(*group_cols).agg(*aggs)
    return from_counts(value_counts(df, group_cols, measures), group_cols, outputs, extra)


def from_counts(counts: DataFrame, group_cols: Sequence[str],
                outputs: Mapping[str, tuple[str, float]],
                extra: Mapping[str, Column] | None = None) -> DataFrame:
    """:func:`percentiles` from counted cells ``(*group, measure, v, n)``, each value once."""
    extra = dict(extra or {})
    wanted: dict[str, list[float]] = {}
    for measure, p in outputs.values():
        if p not in wanted.setdefault(measure, []):
            wanted[measure].append(p)
    position = {m: i for i, m in enumerate(wanted)}
    grouped = counts.groupBy(*group_cols).agg(
        *[F.collect_list(F.when(F.col("measure") == m, F.struct("v", "n"))).alias(f"_list{i}")
          for m, i in position.items()],
        *[F.sum(F.when(F.col("measure") == m, F.col("n"))).alias(f"_total{i}")
          for m, i in position.items()],
        *[e.alias(f"_x_{name}") for name, e in extra.items()])
    found = grouped.select(
        *group_cols, *[f"_x_{name}" for name in extra],
        *[located(F.col(f"_list{i}"), F.col(f"_total{i}"), wanted[m]).alias(f"_at{i}")
          for m, i in position.items()])
    return found.select(
        *group_cols, *[F.col(f"_x_{name}").alias(name) for name in extra],
        *[F.col(f"_at{position[m]}").getItem(wanted[m].index(p)).alias(out)
          for out, (m, p) in outputs.items()])


def located(cells: Column, total: Column, ps: Sequence[float]) -> Column:
    """The percentiles ``ps`` of a list of counted values ``(v, n)`` whose counts sum to
    ``total``, as an array; NULLs for an empty list.  The list is walked once, in order."""
    none = F.lit(None).cast("double")
    at = [(total - 1) * F.lit(float(p)) for p in ps]

    def step(state: Column, cell: Column) -> Column:
        upto = state["upto"] + cell["n"]

        def first(name: str, rank: Column) -> Column:
            return F.when(state[name].isNull() & (upto > rank), cell["v"]).otherwise(state[name])
        return F.struct(upto.alias("upto"),
                        *[first(f"lo{i}", F.floor(pos)).alias(f"lo{i}") for i, pos in enumerate(at)],
                        *[first(f"hi{i}", F.ceil(pos)).alias(f"hi{i}") for i, pos in enumerate(at)])

    def finish(state: Column) -> Column:
        return F.array(*[state[f"lo{i}"] + (state[f"hi{i}"] - state[f"lo{i}"]) * (pos - F.floor(pos))
                         for i, pos in enumerate(at)])
    start = F.struct(F.lit(0).cast("long").alias("upto"),
                     *[none.alias(f"{side}{i}") for side in ("lo", "hi") for i in range(len(ps))])
    return F.aggregate(F.array_sort(cells), start, step, finish)


def value_lists(df: DataFrame, group_cols: Sequence[str],
                measures: Mapping[str, str | Column]) -> DataFrame:
    """``(*group, measure, cells)``: the sorted distinct values of a measure with their counts,
    ``array<struct<v: double, n: bigint>>``, to be stored beside a daily mart."""
    return (value_counts(df, group_cols, measures).groupBy(*group_cols, "measure")
            .agg(F.array_sort(F.collect_list(F.struct("v", "n"))).alias("cells")))


def merge_value_lists(lists: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Stored lists added up to the groups ``group_cols``, as counted cells for
    :func:`from_counts`; equal to counting the rows of the longer period."""
    return (lists.select(*group_cols, "measure", F.explode("cells").alias("cell"))
            .groupBy(*group_cols, "measure", F.col("cell.v").alias("v"))
            .agg(F.sum("cell.n").alias("n")))


def cell_count(measure: str) -> Column:
    """Rows with a non-null value of ``measure`` (0 when none), from counted cells."""
    return F.coalesce(F.sum(F.when(F.col("measure") == measure, F.col("n"))), F.lit(0)).cast("long")


def cell_sum(measure: str) -> Column:
    """Exact sum of an integer-valued ``measure`` from counted cells (NULL when none)."""
    return F.sum(F.when(F.col("measure") == measure, (F.col("v") * F.col("n")).cast("long")))
