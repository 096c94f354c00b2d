"""Exact NTILE over a whole table without moving it to one task.

``ntile(n)`` over an unpartitioned window sends every row to a single task. But a row's
tile is known once the ``n - 1`` rows that end a tile are known: it is one plus the number
of tile ends that sort before the row. So only those few *end keys* are looked up, and
assigning tiles is then a plain projection.

An end key is the row at a known rank of the order ``(value, tie)``. It is found by
narrowing: a small sample proposes two keys around the rank, one counting pass tells which
side of them the rank lies, and the range shrinks until it is small enough to sort. Samples
only steer how fast the range shrinks; the counts decide, so the answer is exact. Because
the tie column is part of the key, a value shared by a third of all rows narrows like any
other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

SORT_LIMIT = 200_000  # rows of one range that a single task may sort
SAMPLE_ROWS = 5_000   # rows per open range brought to the driver to choose two keys
IDLE_ROUNDS = 4       # passes without any progress after which the key can't be unique

Key = tuple  # (value, tie)


@dataclass
class _Range:
    """The rows with ``low < key <= high``; the wanted key is number ``rank`` of them."""

    column: str
    tile: int
    rank: int
    rows: int
    low: Key | None = None
    high: Key | None = None


def _after(value: Column, tie: Column, key: Key, kind: T.DataType, tie_kind: T.DataType) -> Column:
    """``(value, tie) > key``, NULL values first; never NULL itself."""
    kv, kt = key
    tie_after = tie > F.lit(kt).cast(tie_kind)
    if kv is None:
        return value.isNotNull() | tie_after
    bound = F.lit(kv).cast(kind)
    return F.coalesce((value > bound) | ((value == bound) & tie_after), F.lit(False))


def _order(key: Key):
    return (key[0] is not None, key)


class _Finder:
    def __init__(self, df: DataFrame, tie: str, sort_limit: int, sample_rows: int):
        self.df, self.tie = df, tie
        self.sort_limit, self.sample_rows = sort_limit, sample_rows
        self.kinds = {f.name: f.dataType for f in df.schema}

    def after(self, column: str, key: Key) -> Column:
        return _after(F.col(column), F.col(self.tie), key, self.kinds[column], self.kinds[self.tie])

    def inside(self, r: _Range) -> Column:
        cond = F.lit(True)
        if r.low is not None:
            cond = cond & self.after(r.column, r.low)
        if r.high is not None:
            cond = cond & ~self.after(r.column, r.high)
        return cond

    def tagged(self, ranges: list[_Range], keep=None, **extra) -> DataFrame:
        """Each row once per range it lies in: range number ``i``, value, tie and extra literals.

        One pass serves ranges of several columns; a column's value stands in its own
        field ``v<n>`` and the other value fields stay NULL.
        """
        columns = self.columns(ranges)
        entries = []
        for i, r in enumerate(ranges):
            cond = self.inside(r)
            if keep is not None:
                cond = cond & keep(i, r)
            values = [
                (F.col(c) if c == r.column else F.lit(None).cast(self.kinds[c])).alias(f"v{n}")
                for n, c in enumerate(columns)
            ]
            literals = [F.lit(get(r)).cast("bigint").alias(name) for name, get in extra.items()]
            entries.append(F.when(cond, F.struct(
                F.lit(i).alias("i"), *values, F.col(self.tie).alias("t"), *literals)))
        return self.df.select(F.inline(F.array_compact(F.array(*entries))))

    @staticmethod
    def columns(ranges: list[_Range]) -> list[str]:
        return list(dict.fromkeys(r.column for r in ranges))

    def read_keys(self, df: DataFrame, ranges: list[_Range]) -> list[tuple[int, Key]]:
        field = {c: f"v{n}" for n, c in enumerate(self.columns(ranges))}
        return [(row.i, (row[field[ranges[row.i].column]], row.t)) for row in df.collect()]

    def narrow(self, ranges: list[_Range], seed: int) -> None:
        """One sampling pass and one counting pass over all ranges that are still wide."""
        drawn: list[list[Key]] = [[] for _ in ranges]
        sample = self.tagged(ranges, lambda i, r: F.rand(seed + i) < min(1.0, self.sample_rows / r.rows))
        for i, key in self.read_keys(sample, ranges):
            drawn[i].append(key)

        tries: list[tuple[_Range, list[Key]]] = []
        for r, keys in zip(ranges, drawn, strict=True):
            keys.sort(key=_order)
            at = (r.rank / r.rows) * len(keys)
            slack = 3 * math.sqrt(len(keys)) / 2 + 1
            low, high = math.floor(at - slack), math.ceil(at + slack)
            tries.append((r, [keys[n] for n in (low, high) if 0 <= n < len(keys)]))
        counts = [
            F.count_if(self.inside(r) & ~self.after(r.column, key)) for r, picks in tries for key in picks
        ]
        if not counts:
            return
        upto = iter(self.df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first())
        for r, picks in tries:
            found = [(key, next(upto)) for key in picks]
            below = [(k, n) for k, n in found if n < r.rank]
            above = [(k, n) for k, n in found if n >= r.rank]
            if above:
                r.high, r.rows = above[0]
            if below:
                r.low, skipped = below[-1]
                r.rank, r.rows = r.rank - skipped, r.rows - skipped

    def pick(self, ranges: list[_Range]) -> list[Key]:
        """Sort each (now small) range in its own task and read off the wanted row."""
        order = [F.col(f"v{n}").asc_nulls_first() for n in range(len(self.columns(ranges)))]
        nth = F.row_number().over(W.partitionBy("i").orderBy(*order, "t"))
        wanted = self.tagged(ranges, want=lambda r: r.rank).withColumn("n", nth).filter(F.col("n") == F.col("want"))
        found = dict(self.read_keys(wanted, ranges))
        return [found[i] for i in range(len(ranges))]


def tile_end_keys(
    df: DataFrame,
    n: int,
    columns: list[str],
    tie: str,
    sort_limit: int = SORT_LIMIT,
    sample_rows: int = SAMPLE_ROWS,
) -> dict[str, list[Key]]:
    """For each column, the keys of the last row of tiles ``1 .. n-1``."""
    finder = _Finder(df, tie, sort_limit, sample_rows)
    total = df.count()
    if total == 0:
        return {c: [] for c in columns}
    size, extra = divmod(total, n)
    ranges = [
        _Range(c, b, rank=min(b * size + min(b, extra), total), rows=total)
        for c in columns for b in range(1, n)
    ]
    seed = idle = 0
    while wide := [r for r in ranges if r.rows > sort_limit]:
        before = sum(r.rows for r in wide)
        finder.narrow(wide, seed)
        seed += len(ranges)
        # a range of distinct keys shrinks sooner or later; one of a single repeated key never does
        idle = idle + 1 if sum(r.rows for r in wide) == before else 0
        if idle == IDLE_ROUNDS:
            raise ValueError(f"{tie} must be unique: one value of it repeats more than {sort_limit} times")
    keys = finder.pick(ranges)
    ends: dict[str, list[Key]] = {c: [] for c in columns}
    for r, key in zip(ranges, keys, strict=True):
        ends[r.column].append(key)
    return ends


def with_ntile(
    df: DataFrame,
    n: int,
    columns: dict[str, str],
    tie: str,
    sort_limit: int = SORT_LIMIT,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Add ``{new column: ordering column}`` tiles, ascending, NULLs first, ties by ``tie``.

    ``df`` is read several times, so pass a stored table. ``tie`` must be unique.
    """
    ends = tile_end_keys(df, n, list(dict.fromkeys(columns.values())), tie, sort_limit, sample_rows)
    kinds = {f.name: f.dataType for f in df.schema}
    tiles = {}
    for name, source in columns.items():
        tile = F.lit(1)
        for key in ends[source]:
            tile = tile + _after(F.col(source), F.col(tie), key, kinds[source], kinds[tie]).cast("int")
        tiles[name] = tile
    return df.withColumns(tiles)
