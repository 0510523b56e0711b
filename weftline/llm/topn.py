"""Top N rows of every group by merging sorted runs with a loser tree.

Each input partition becomes one run: its rows are sorted by group and order and only
the first N of each group are kept, so a group of millions leaves N rows a partition.
Runs are then bucketed by group, buckets cut in parts that stream in one after the other; in each
part a loser tree merges the runs, and after N outputs of a group every run seeks to its
next group without reading the rest. A task holds the runs' rows of one part of its groups.

Defined results: rows of a null group are left out; rows with an equal id and equal
order columns (copies) count once; in an order column numbers come before NaN, NaN before
null, whichever the direction; ties are settled by the id, ascending; a group with fewer
than N rows gives what it has; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Parts that a bucket's groups are merged in, one after the other.
PARTS = 64
#: Rows sorted at once while a run is built.
CHUNK = 200_000


def _ranked(t: pa.Table, group: str, order: list[tuple[str, bool]], key: str, n: int) -> pa.Table:
    """t sorted, without copies, cut to the first n of each group."""
    keys = [(group, "ascending"), *((c, "ascending" if up else "descending") for c, up in order), (key, "ascending")]
    t = t.take(pc.sort_indices(t, sort_keys=keys, null_placement="at_end")).combine_chunks()
    if not t.num_rows:
        return t
    codes = t[group].combine_chunks().dictionary_encode().indices.to_numpy()
    first = np.r_[True, codes[1:] != codes[:-1]]
    new = first.copy()
    for c in (key, *(c for c, _ in order)):
        new[1:] |= _unlike(t[c].combine_chunks())
    seen = np.cumsum(new)
    start = np.maximum.accumulate(np.where(first, seen - 1, 0))
    return t.filter(pa.array(new & (seen - start <= n)))


def _unlike(x: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before; null is like null, NaN like NaN."""
    null = x.is_null().to_numpy(zero_copy_only=False)
    v = x.fill_null(0).to_numpy(zero_copy_only=False)
    nan = np.isnan(v) if v.dtype.kind == "f" else np.zeros(len(v), bool)
    both = (null[1:] & null[:-1]) | (nan[1:] & nan[:-1])
    return ~both & ((null[1:] != null[:-1]) | (v[1:] != v[:-1]))


class LoserTree:
    """Tournament over the heads of runs; each inner node keeps the loser of its match."""

    def __init__(self, runs: list[list[tuple]], skip: list[np.ndarray]):
        self.runs, self.skip, self.at, self.k = runs, skip, [0] * len(runs), len(runs)
        self.loser = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def head(self, i: int) -> tuple | None:
        return self.runs[i][self.at[i]] if self.at[i] < len(self.runs[i]) else None

    def _play(self, i: int) -> None:
        """Run i plays from its leaf to the root; an empty place takes the first to come."""
        win, node = i, (i + self.k) >> 1
        mine = self.head(win)
        while node:
            other = self.loser[node]
            if other < 0:
                self.loser[node] = win
                return
            theirs = self.head(other)
            if mine is None or (theirs is not None and theirs < mine):
                self.loser[node], win, mine = win, other, theirs
            node >>= 1
        self.loser[0] = win

    def top(self, n: int) -> Iterator[tuple[int, int]]:
        """(run, row) of the first n distinct rows of each group."""
        group, count, last = None, 0, None
        while (row := self.head(i := self.loser[0])) is not None:
            if row[0] != group:
                group, count, last = row[0], 0, None
            if count == n:  # seek: the run's next group
                self.at[i] = int(self.skip[i][self.at[i]])
            else:
                if row != last:
                    yield i, self.at[i]
                    count, last = count + 1, row
                self.at[i] += 1
            self._play(i)


def _comparable(t: pa.Table, group: str, order: list[tuple[str, bool]], key: str) -> list[tuple]:
    """A tuple for each row whose order is that of the rows."""
    parts = [t[group].to_pylist()]
    for c, up in order:
        x = t[c] if pa.types.is_integer(t[c].type) else t[c].cast(pa.float64())
        null = x.is_null().to_numpy()
        if pa.types.is_integer(x.type):  # exact, however large
            parts += [np.where(null, 2, 0).tolist(), [v if up else -v for v in x.fill_null(0).to_pylist()]]
            continue
        v = x.fill_null(0.0).to_numpy()
        nan = np.isnan(v)
        parts += [np.where(null, 2, np.where(nan, 1, 0)).tolist(), np.where(null | nan, 0.0, v if up else -v).tolist()]
    return list(zip(*parts, t[key].to_pylist(), strict=True))


def top_n(df: DataFrame, group: str, order: list[tuple[str, bool]], key: str, n: int, keep: list[str] = ()) -> DataFrame:
    """Rows (group, key, *order columns, *keep, position) of each group's first n.

    order: numeric columns, each with True for ascending. key: an integer id.
    """
    columns = list(dict.fromkeys([group, *(c for c, _ in order), key, *keep]))
    src = df.where(F.col(group).isNotNull()).select(*columns)
    run_type = T.StructType([*src.schema.fields, T.StructField("_run", T.LongType()), T.StructField("_at", T.LongType())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        run, held, rows, done = TaskContext.get().partitionId(), [], 0, []
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= CHUNK:
                done.append(_ranked(pa.Table.from_batches(held), group, order, key, n))
                held, rows = [], 0
        if held:
            done.append(_ranked(pa.Table.from_batches(held), group, order, key, n))
        if done:
            t = _ranked(pa.concat_tables(done), group, order, key, n) if len(done) > 1 else done[0]
            t = t.append_column("_run", pa.array(np.full(t.num_rows, run, dtype=np.int64)))
            yield from t.append_column("_at", pa.array(np.arange(t.num_rows, dtype=np.int64))).to_batches(max_chunksize=50_000)

    out_type = T.StructType([*src.schema.fields, T.StructField("position", T.IntegerType())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Merge part by part as they stream in; only one part's rows are held."""
        held, now = [], None
        for b in batches:
            at = b["_part"].to_numpy()
            cuts = np.r_[0, np.flatnonzero(at[1:] != at[:-1]) + 1, len(at)] if len(at) else np.zeros(1, int)
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if now is not None and at[i] != now:
                    yield from merged(held)
                    held = []
                now = at[i]
                held.append(b.slice(i, j - i))
        if held:
            yield from merged(held)

    def merged(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).drop_columns(["_part"]).combine_chunks()
        runs = t["_run"].to_numpy()
        bounds = np.r_[0, np.flatnonzero(runs[1:] != runs[:-1]) + 1, len(runs)]
        t = t.drop_columns(["_run", "_at"])
        rows = _comparable(t, group, order, key)
        codes = t[group].combine_chunks().dictionary_encode().indices.to_numpy()
        cut_up, skip = [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            cut_up.append(rows[a:b])
            ends = np.r_[np.flatnonzero(codes[a + 1 : b] != codes[a : b - 1]) + 1, b - a]
            skip.append(ends[np.searchsorted(ends, np.arange(b - a), side="right")])
        picked, places, group_now, place = [], [], None, 0
        for i, j in LoserTree(cut_up, skip).top(n):
            place = place + 1 if (g := cut_up[i][j][0]) == group_now else 1
            group_now = g
            picked.append(int(bounds[i]) + j)
            places.append(place)
        out = t.take(pa.array(picked, pa.int64())).append_column("position", pa.array(places, pa.int32()))
        yield from out.to_batches(max_chunksize=50_000)

    part = F.pmod(F.xxhash64(F.col(group), F.lit(0)), F.lit(PARTS)).cast("int")
    bucketed = src.mapInArrow(build, run_type).withColumn("_part", part).repartition(F.col(group)).sortWithinPartitions("_part", "_run", "_at")
    return bucketed.mapInArrow(merge, out_type)
