"""Order-aware features over groups of any size.

Rows carry a unique, ascending integer ``order`` column. It is cut into chunks of
``CHUNK_ROWS`` numbers and the wide rows are laid out once by (leading group keys, chunk), so a
window partition holds at most ``CHUNK_ROWS`` rows even when one group is a third of the table.

A group that lies in one chunk is finished by its window. For a group that spans chunks, what
each chunk needs from the others (whole-group minima, the last value of the chunk before) is
merged upwards from one stored summary of the finest groups and chunks, so the input is evaluated
twice however many groups there are: for the summary and for the rows themselves. In a log written in order only the
groups open at a chunk border span, so this carry table is small; its size is measured, and it
is broadcast under the bound and joined on (keys, chunk), which cannot be skewed, beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldcast.functions.expr import all_present, as_col
from foldcast.operators.joins import BROADCAST_BYTES, stored

CHUNK_ROWS = 1 << 18
#: Rows of a task on average: sorted rows take several KB each, and compress so well that the bytes
#: of a shuffle say little of them.
TASK_ROWS = 1 << 16
CHUNK = "_chunk"
_COMBINE = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
_MERGE = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.sum}


@dataclass
class Group:
    """What to compute per group.

    ``stats``: new column -> (min | max | sum | count, column) over the whole group.
    ``previous``: new column -> column, its value on the group's preceding row.
    """

    keys: Sequence[str]
    stats: dict[str, tuple[str, Column | str]] = field(default_factory=dict)
    previous: dict[str, Column | str] = field(default_factory=dict)

    def last_values(self) -> Column:
        return F.struct(*[as_col(c).alias(n) for n, c in self.previous.items()])


def _summary(flat: DataFrame, groups: Sequence[Group], order: str) -> DataFrame:
    """One row per chunk and finest group (all groups' keys together), stored: every group's
    statistics and last values, which the coarser groups merge. The input is read once for it."""
    finest = list(dict.fromkeys(k for g in groups for k in g.keys))
    parts = [F.max(order).alias("_last_order"), F.count(F.lit(1)).alias("_rows")]
    for i, group in enumerate(groups):
        parts += [_COMBINE[fn](as_col(c)).alias(f"_stat{i}_{n}") for n, (fn, c) in group.stats.items()]
        if group.previous:
            parts.append(F.max_by(group.last_values(), F.col(order)).alias(f"_tail{i}"))
    return stored(flat.groupBy(*finest, CHUNK).agg(*parts))[0]


def _carry(summary: DataFrame, i: int, group: Group) -> tuple[DataFrame, int]:
    """One row per chunk of every group that spans chunks, stored, with its bytes."""
    keys = list(group.keys)
    parts = [_MERGE[fn](f"_stat{i}_{n}").alias(n) for n, (fn, _) in group.stats.items()]
    if group.previous:
        parts.append(F.max_by(f"_tail{i}", "_last_order").alias("_chunk_tail"))
    pieces = summary.where(all_present(keys)).groupBy(*keys, CHUNK).agg(*parts)
    whole = Window.partitionBy(*keys)  # one row per chunk of the group
    cols = [_MERGE[fn](n).over(whole).alias(f"_whole_{n}") for n, (fn, _) in group.stats.items()]
    if group.previous:
        cols.append(F.lag("_chunk_tail").over(whole.orderBy(CHUNK)).alias("_chunk_before"))
    spanning = pieces.select(*keys, CHUNK, *cols, F.count(CHUNK).over(whole).alias("_chunk_count"))
    return stored(spanning.where("_chunk_count > 1").drop("_chunk_count"))


def along_groups(df: DataFrame, order: str, groups: Sequence[Group],
                 lead: Sequence[str] | None = None, chunk_rows: int | None = None) -> DataFrame:
    """Add each group's statistics and preceding values, with one shuffle of the wide rows.

    ``lead`` are the keys all groups share (default: those of the first group). Listing a finer
    group before a coarser one lets both use one sort.
    Rows with a NULL in a group's keys get NULL.
    """
    lead, chunk_rows = list(lead or groups[0].keys), chunk_rows or CHUNK_ROWS
    flat = df.withColumn(CHUNK, F.floor(F.col(order) / F.lit(chunk_rows)))
    summary = _summary(flat, groups, order)
    first, last, rows = summary.agg(F.min(CHUNK), F.max(CHUNK), F.sum("_rows")).first()
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-(rows or 0) // TASK_ROWS))
    out = flat.repartition(tasks, *lead, CHUNK)
    for i, group in enumerate(groups):
        inside = Window.partitionBy(*lead, CHUNK, *[k for k in group.keys if k not in lead])
        added = [
            _COMBINE[fn](as_col(c)).over(inside).alias(n) for n, (fn, c) in group.stats.items()
        ]
        if group.previous:
            before_it = F.lag(group.last_values()).over(inside.orderBy(order))
            added.append(before_it.alias("_chunk_prev"))
        before, out = out.columns, out.select("*", *added)
        carry, size = (None, 0) if first == last else _carry(summary, i, group)
        if size:
            carry = F.broadcast(carry) if size <= BROADCAST_BYTES else carry
            out = out.join(carry, [*group.keys, CHUNK], "left")
        known = all_present(group.keys)
        stats = {n: f"coalesce(`_whole_{n}`, `{n}`)" if size else f"`{n}`" for n in group.stats}
        prev = "coalesce(_chunk_prev, _chunk_before)" if size else "_chunk_prev"
        out = out.select(
            *before,
            *[F.when(known, F.expr(e)).alias(n) for n, e in stats.items()],
            *[F.when(known, F.expr(f"{prev}.`{n}`")).alias(n) for n in group.previous],
        )
    return out.drop(CHUNK)


def lag_diff(df: DataFrame, col: str, keys: Sequence[str], order: str, name: str,
             fill=None, boundary: Column | None = None, chunk_rows: int | None = None,
             ) -> DataFrame:
    """Difference to the group's preceding row.

    The first row gives NULL, or ``fill``; rows where ``boundary`` holds are set to NULL.
    """
    out = along_groups(df, order, [Group(keys, previous={"_before_value": col})],
                       chunk_rows=chunk_rows)
    diff = F.col(col) - F.col("_before_value")
    if fill is not None:
        diff = F.coalesce(diff, F.lit(fill))
    if boundary is not None:
        diff = F.when(~F.coalesce(boundary, F.lit(False)), diff)
    return out.withColumn(name, diff).drop("_before_value")
