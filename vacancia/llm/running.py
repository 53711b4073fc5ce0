"""Running sums within ordered groups, without a task per group.

Rows are sorted by ranges of group and order, so a group of any size lies over as many
partitions as it fills. Every task sums what it holds. At most one group of a partition began
before it, so what is carried into the partitions is one short row for each, worked out
from one row for each, and added in a second pass over the saved rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacancia.llm.common import saved

_U = np.uint64


def _plain(x: pa.Scalar) -> object:
    return x.as_py()


def _with(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], *columns.values()], [*kept, *columns])


def _starts(keys: pa.Array) -> np.ndarray:
    """Where another group begins inside a sorted column without nulls; the first row does."""
    codes = keys.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.diff(codes, prepend=-1) != 0)


def _local(group: str, values: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, last, total = TaskContext.get().partitionId(), 0, None, np.zeros(len(values), _U)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = batch.column(group)
            starts = _starts(keys)
            goes_on = at > 0 and _plain(keys[0]) == last
            own = np.repeat(np.arange(starts.size), np.diff(np.append(starts, n)))
            out = {}
            for k, v in enumerate(values):
                x = batch.column(v).to_numpy(zero_copy_only=False).astype(np.int64).view(_U)
                run = np.cumsum(x)
                run = run - (run[starts] - x[starts])[own]
                if goes_on:
                    run[own == 0] += total[k]
                total[k] = run[-1]
                out[f"run_{v}"] = pa.array(run.view(np.int64))
            out |= {"part": pa.array(np.full(n, part, np.int32)), "at": pa.array(np.arange(at, at + n))}
            at, last = at + n, _plain(keys[n - 1])
            yield _with(batch, out)

    return run


def carries(edges: list[tuple]) -> dict[int, tuple[object, list[int]]]:
    """What goes into a partition: its first group, and the sums of that group so far.

    ``edges``: partition, first group, last group, and the last row's sums, in order.
    """
    out, group, sums = {}, None, []
    for part, first, last, ends in edges:
        if out or group is not None:
            if first == group:
                out[part] = (first, sums)
        whole = first == last and part in out
        group, sums = last, [(a + b) % (1 << 64) for a, b in zip(sums, ends)] if whole else [x % (1 << 64) for x in ends]
    return out


def _carried(group: str, values: list[str], into: dict[int, tuple[object, list[int]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("part").to_numpy(zero_copy_only=False)
            sums = {f"run_{v}": batch.column(f"run_{v}").to_numpy(zero_copy_only=False).view(_U).copy() for v in values}
            for part in np.unique(parts):
                if int(part) in into:
                    first, more = into[int(part)]
                    same = (parts == part) & np.array([x == first for x in batch.column(group).to_pylist()])
                    for v, x in zip(values, more):
                        sums[f"run_{v}"][same] += _U(x)
            kept = [n for n in batch.schema.names if n not in sums and n not in ("part", "at")]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], *[pa.array(x.view(np.int64)) for x in sums.values()]], [*kept, *sums])

    return run


def running(rows: DataFrame, group: str, order: list[str], values: list[str], name: str) -> DataFrame:
    """``rows`` with ``run_<value>`` (bigint): the sum over its group's rows up to this one, modulo 2**64.

    ``group`` is a column without nulls, ``values`` are bigint without nulls. Rows that are equal in
    ``order`` stand in any order and are spread by where they were read. Two names are taken:
    ``part`` and ``at``.
    """
    tied = rows.withColumn("at", F.monotonically_increasing_id())
    ordered = tied.repartitionByRange(group, *order, "at").sortWithinPartitions(group, *order, "at")
    sums = [T.StructField(f"run_{v}", T.LongType()) for v in values]
    plain = [f for f in rows.schema.fields]
    local = saved(ordered.mapInArrow(_local(group, values), T.StructType([*plain, *sums, T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType())])), name)
    ends = local.groupBy("part").agg(F.min(F.struct("at", group)).alias("first"), F.max(F.struct("at", group, *[f.name for f in sums])).alias("last")).orderBy("part")
    edges = [(r["part"], r["first"][1], r["last"][1], list(r["last"][2:])) for r in ends.collect()]  # one row for each partition
    return local.mapInArrow(_carried(group, values, carries(edges)), T.StructType([*plain, *sums]))
