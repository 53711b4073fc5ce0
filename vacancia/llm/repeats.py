"""Places that can hold repeated windows: minimisers, and the steps on them that are plain joins.

Of all short grams inside a window the least by name (leftmost of equal ones) is its anchor.
Equal windows have equal anchors at equal places, so only anchors need to be compared across
documents: about two for every window length. An anchor stands for the run of window starts
that chose it, and the text from the first of them to the end of the last is its region.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import same_document, saved

_U = np.uint64
PLACE = ["doc_id", "copy", "start"]


def minimisers(names: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` names the place of its least; ties go to the left."""
    n = names.size
    if n < width:
        return np.zeros(0, np.int64)
    least = (names & _U(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    out = n - width + 1
    return (np.minimum(least[:out], least[width - size : width - size + out]) & _U(0xFFFFFFFF)).astype(np.int64)


def anchor_runs(anchors: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive window starts with one anchor: the anchor, the first start, how many."""
    own = anchors[starts]
    new = np.flatnonzero((np.diff(own, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1))
    return own[new], starts[new], np.diff(np.append(new, starts.size))


def window_starts(first: np.ndarray, count: np.ndarray, window: int) -> np.ndarray:
    """All starts of windows that lie within one text; texts begin at ``first``."""
    total = int(count.sum())
    inside = np.ones(total + 1, bool)
    tails = np.minimum(count, window - 1)
    step = np.zeros(total + 2, np.int64)
    np.add.at(step, first + count - tails, 1)
    np.add.at(step, first + count, -1)
    inside = np.cumsum(step[:total]) == 0
    return np.flatnonzero(inside)


def repeated(rows: DataFrame, name: str) -> DataFrame:
    """Rows whose name occurs at least twice. A name's rows are counted before they move."""
    counts = rows.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(name)
    return rows.join(saved(counts, "names"), name, "left_semi")


def regions(rows: DataFrame, *names: str) -> DataFrame:
    """One row per distinct region: its first place, and whether it has another."""
    place = F.struct(*PLACE)
    return rows.groupBy(*names).agg(F.min(place).alias("least"), F.max(place).alias("most"))


def spans_by_document(spans: DataFrame) -> DataFrame:
    """Spans (start, size) of every document, as one row; as many as its text holds at most."""
    return spans.groupBy("doc_id", "copy").agg(F.collect_list(F.struct("start", "size")).alias("spans"))


def with_spans(docs: DataFrame, spans: DataFrame, how: str = "left") -> DataFrame:
    """Documents with their spans; ``docs`` has doc_id, copy and text."""
    by_doc = spans_by_document(spans)
    return docs.join(by_doc, same_document(docs, by_doc), how).select(docs["doc_id"], docs["copy"], "text", "spans")


def span_arrays(column: pa.Array) -> tuple[np.ndarray, ...]:
    """The row, and the fields, of every element of a column of lists of structs; null is none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = column.flatten()
    return (np.repeat(np.arange(len(column)), lengths), *[f.to_numpy(zero_copy_only=False) for f in flat.flatten()])
