"""Groups cut into blocks, groups of neighbouring rows in a sorted partition, and union-find for use in tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def blocked(df: DataFrame, size: str, by: str, block: int) -> DataFrame:
    """Give rows of a group of ``size`` members their block pairs (_i, _j), and their own block ``_own``.

    Any two members meet in some pair; a group of one block has just the pair (0, 0).
    """
    blocks = F.ceil(F.col(size) / block)
    return (
        df.withColumn("_own", F.pmod(F.xxhash64(by), blocks))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .drop("_other")
    )


def whole_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole groups of equal ``keys``, with each group's first row and the number of rows.

    Rows of a group must be neighbours. Only the group that a batch ends in is carried over.
    """
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        head = tuple(batch.column(batch.schema.get_field_index(k))[0].as_py() for k in keys)
        end = tuple(batch.column(batch.schema.get_field_index(k))[-1].as_py() for k in keys)
        if rest and head == last == end:
            rest.append(batch)
            continue
        table = pa.Table.from_batches([*rest, batch]).combine_chunks()
        starts = _starts(table, keys)
        cut = int(starts[-1])
        if cut:
            yield table.slice(0, cut), np.append(starts[:-1], cut)
        rest, last = table.slice(cut).to_batches(), end
    if rest:
        table = pa.Table.from_batches(rest).combine_chunks()
        yield table, np.append(_starts(table, keys), table.num_rows)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for k in keys:
        values = table.column(k).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


class Forest:
    """Union-find over positions 0..n-1."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def flatten(self) -> np.ndarray:
        while True:
            above = self.up[self.up]
            if (above == self.up).all():
                return self.up
            self.up = above

    def union(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b
